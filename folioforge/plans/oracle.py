"""ANSI SQL for the registered queries, written independently of the Spark operators.

Built from named common table expressions; a query lists the ones it needs through the
last one.
"""

from __future__ import annotations

from .fixture import WIKI_SQL
from .queries import FIXED_QUERIES, TOP_K

# Box starts, section headings and the words that are not indexed.
BOX_START = r"(?i)\{\{(?:Infobox *(?:book|short story|film)|Navbox)"
HEADING = r"(?i)== *(works|bibliography) *=="
STOP = (
    "'Infobox','infobox','getArgs','args','listclass','|listclass','br','hlist',"
    "'autocollapse','imagesize','caption','|hlist','hlist|','listclass|'"
)


def fold(x: str) -> str:
    return f"strip_accents(replace({x}, 'ß', 'ss'))"


def normal(x: str, drop: bool = True) -> str:
    low = f"lower({fold(x)})"
    low = f"replace({low}, 'noinclude', '')" if drop else low
    return f"regexp_replace({low}, '[^a-z0-9|()*=]+', ' ', 'g')"


def cls(x: str) -> str:
    return (
        rf"CASE WHEN regexp_matches({x}, '(?i)\{{\{{Infobox *(book|short story|film)') THEN 'infobox' "
        rf"WHEN regexp_matches({x}, '(?i)\{{\{{Navbox') THEN 'navbox' "
        rf"WHEN regexp_matches({x}, '{HEADING}') THEN 'writer' END"
    )


def subtype(x: str, writer: bool = True) -> str:
    between = rf"WHEN regexp_matches({x}, '(?i)\{{\{{Infobox *writer') THEN 'writer' " if writer else ""
    return (
        rf"CASE WHEN regexp_matches({x}, '(?i)\{{\{{Infobox *(book|short story)') THEN 'book' "
        rf"{between}WHEN regexp_matches({x}, '(?i)\{{\{{Infobox *film') THEN 'film' END"
    )


def found(x: str, pattern: str) -> str:
    return f"array_to_string(regexp_extract_all({x}, '(?is){pattern}'), '')"


# Which fields of a box or section are extracted, and the words put before them.


def book(x: str) -> str:
    return (
        f"'book | ' || {found(x, r'name *=.*?\|')} || {found(x, r'author *=.*?\] *\|')}"
        f" || {found(x, r'genre *=.*?\] *\|')} || {found(x, r'pages *=.*?\|')}"
    )


def film(x: str) -> str:
    return (
        f"'film | ' || {found(x, r'name *=.*?\|')} || {found(x, r'director *=.*?\] *\|')}"
        f" || {found(x, r'based_on *=.*?\}\} *\|')}"
    )


def writer_box(x: str) -> str:
    return f"'writer | ' || {found(x, r'[ *|]name *=.*?\|')} || {found(x, r'pseudonym *=.*?\|')}"


def navbox(x: str) -> str:
    return (
        f"regexp_replace('navbox | ' || {found(x, r'name *=.*?\|')} || {found(x, r'group\d+ *=.*')},"
        r" '(?i)\{\{noitalic\|\(\d+\)\}\}', ' ', 'g')"
    )


def no_templates(x: str) -> str:
    return rf"regexp_replace({x}, '\{{[^}}]*(\}})', ' \1', 'g')"


def no_refs(x: str) -> str:
    return rf"regexp_replace({x}, '(?is)< *ref.*< */ *ref', ' ', 'g')"


def flat(x: str) -> str:
    return f"replace({x}, chr(10), ' ')"


def works(x: str) -> str:
    section = (
        rf"regexp_extract({flat(x)}, '(?is)(== *(?:works|bibliography) *==.*?) +==[a-zA-Z ]*==', 1)"
    )
    return f"'writer | ' || {no_refs(no_templates(section))}"


def works_at_start(x: str) -> str:
    section = (
        rf"regexp_extract({flat(x)}, '(?is)^(== *(?:works|bibliography) *==.*?) +==[a-zA-Z ]*==', 1)"
    )
    return (
        f"CASE WHEN {section} = '' THEN '' ELSE 'writer | ' || {no_refs(no_templates(section))} END"
    )


def kept_or_extracted(x: str) -> str:
    """Extraction that returns what it cannot extract unchanged."""
    return f"""CASE {cls(x)}
      WHEN 'infobox' THEN CASE {subtype(x)} WHEN 'book' THEN {book(x)}
        WHEN 'writer' THEN {writer_box(x)} WHEN 'film' THEN {film(x)} ELSE {x} END
      WHEN 'navbox' THEN {navbox(x)}
      WHEN 'writer' THEN {works_at_start(x)} ELSE {x} END"""


_BOX = r"s(?:[sbp]|o[sop]*[bc])*"
INSIDE = rf"^(?:[^s]*{_BOX}c)*[^s]*{_BOX}(?:o[sop]*)?$"

FIXED = ", ".join(f"({i}, '{raw}')" for i, raw in FIXED_QUERIES)

CTES: dict[str, str] = {
    "wiki": WIKI_SQL,
    # Lines, their kinds, and the lines inside boxes: a line belongs to a box if it starts
    # one, or if the kinds of all lines before it leave one open.
    "lines": r"""SELECT id, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM (
        SELECT id, string_split(regexp_replace(text, '\n$', ''), chr(10)) AS ls
        FROM wiki WHERE text IS NOT NULL) t""",
    "kinds": rf"""SELECT id, i, line, CASE WHEN regexp_matches(line, '{BOX_START}') THEN 's'
        WHEN contains(line, '{{{{') AND contains(line, '}}}}') THEN 'b'
        WHEN contains(line, '{{{{') THEN 'o' WHEN contains(line, '}}}}') THEN 'c'
        ELSE 'p' END AS kind FROM lines""",
    "kind_strings": "SELECT id, string_agg(kind, '' ORDER BY i) AS ks FROM kinds GROUP BY id",
    "in_box": rf"""SELECT id, i, line FROM kinds JOIN kind_strings USING (id)
        WHERE kind = 's' OR regexp_matches(substr(ks, 1, i - 1), '{INSIDE}')""",
    "box": """SELECT w.id, coalesce(string_agg(line, ' ' ORDER BY i), '') AS box
        FROM wiki w LEFT JOIN in_box b ON w.id = b.id WHERE w.text IS NOT NULL GROUP BY w.id""",
    "first_heading": rf"""SELECT id, min(i) AS h FROM lines
        WHERE regexp_matches(line, '{HEADING}') GROUP BY id""",
    "tail": """SELECT w.id, coalesce(string_agg(line, chr(10) ORDER BY i), '') AS tail
        FROM wiki w LEFT JOIN (SELECT l.id, i, line FROM lines l JOIN first_heading f
          ON l.id = f.id AND i >= h) t ON w.id = t.id
        WHERE w.text IS NOT NULL GROUP BY w.id""",
    "outer_heading": rf"""SELECT id, min(i) AS h FROM lines l
        WHERE regexp_matches(line, '{HEADING}')
          AND NOT EXISTS (SELECT 1 FROM in_box b WHERE b.id = l.id AND b.i = l.i) GROUP BY id""",
    "kept": f"""SELECT * FROM (SELECT *, {cls('text')} AS cls FROM wiki) c
        WHERE cls IS NOT NULL AND title IS NOT NULL""",
    "selected": """SELECT k.id, k.title, string_agg(line, ' ' ORDER BY i) AS body
        FROM kept k JOIN lines l ON k.id = l.id LEFT JOIN outer_heading o ON k.id = o.id
        WHERE i >= h OR EXISTS (SELECT 1 FROM in_box b WHERE b.id = l.id AND b.i = l.i)
        GROUP BY k.id, k.title""",
    "bodies": """SELECT k.id, title, cls, CASE WHEN cls = 'writer' THEN text ELSE box END AS body
        FROM kept k JOIN box ON k.id = box.id""",
    "extracts": f"""SELECT id, title, {normal(f'''CASE cls
        WHEN 'infobox' THEN CASE {subtype('body', writer=False)} WHEN 'book' THEN {book('body')}
          WHEN 'film' THEN {film('body')} ELSE body END
        WHEN 'navbox' THEN {navbox('body')} ELSE {works('body')} END''')} AS text FROM bodies""",
    "selected_extracts": f"""SELECT id, title, {normal(kept_or_extracted('body'), drop=False)} AS text
        FROM selected""",
    "fallback_extracts": f"""SELECT id, title, {normal(kept_or_extracted('body'), drop=False)} AS text
        FROM (SELECT id, title, {flat('text')} AS body FROM wiki WHERE text IS NOT NULL) t""",
    # Documents: the running count of '=' segments numbers the fields.
    "typed": r"""SELECT *, regexp_extract(replace(replace(text, '|', ' | '), '=', ' = '), '\S+')
        AS type FROM extracts""",
    "segments": """SELECT id, n, seg, i, i > 1 AND contains(seg, '=') AS begins FROM (
        SELECT id, len(gs) AS n, unnest(gs) AS seg, generate_subscripts(gs, 1) AS i
        FROM (SELECT id, string_split(text, '|') AS gs FROM extracts) t) u""",
    "numbered": """SELECT *, sum(CASE WHEN begins THEN 1 ELSE 0 END)
        OVER (PARTITION BY id ORDER BY i ROWS UNBOUNDED PRECEDING) AS pos FROM segments""",
    "field_parts": """SELECT id, CAST(pos AS BIGINT) AS pos, list_transform(
          string_split(string_agg(seg, '=' ORDER BY i), '='),
          lambda x: trim(regexp_replace(x, ' +', ' ', 'g'))) AS ps
        FROM numbered WHERE pos > 0 AND NOT (begins AND i = n) GROUP BY id, pos""",
    "fields": """SELECT id, pos, ps[1] AS name,
        array_to_string(list_filter(ps[2:], lambda x: x <> ''), ', ') AS value FROM field_parts""",
    "last_fields": """SELECT id, key, value FROM (
        SELECT id, CASE WHEN name = '' THEN 'none' ELSE name END AS key, value,
          row_number() OVER (PARTITION BY id, CASE WHEN name = '' THEN 'none' ELSE name END
            ORDER BY name = '' DESC, pos DESC) AS r FROM fields) t WHERE r = 1""",
    "docs": """SELECT t.id, title, type, coalesce(
          string_agg(key || '=' || value, ';' ORDER BY key), '') AS fields
        FROM typed t LEFT JOIN last_fields f ON t.id = f.id
        WHERE type <> '' GROUP BY t.id, title, type""",
    "odd_pages": """SELECT CASE WHEN p_partkey % 3 <> 1 THEN 'p' || p_partkey END AS id,
        CASE WHEN p_partkey % 3 <> 1 THEN p_name END AS title,
        CASE WHEN p_partkey % 3 <> 1 THEN p_type END AS text,
        CASE WHEN p_partkey % 3 = 1 THEN '<page><id>p' || p_partkey || '</id><title>' || p_name
          || '</title<revision><text>' || p_type || '</text></revision>' END AS reject FROM part""",
    "own_fields": """SELECT id, CASE WHEN key IN ('id', 'title', 'type') THEN '=' || key ELSE key
        END AS key, value FROM last_fields""",
    "entries": """SELECT id, key, value FROM own_fields WHERE id IN (SELECT id FROM docs)
        UNION ALL SELECT id, 'id', id FROM docs UNION ALL SELECT id, 'title', title FROM docs
        UNION ALL SELECT id, 'type', type FROM docs""",
    # Positional index of the documents table.
    "words": rf"""SELECT doc_id, list_filter(regexp_split_to_array(
        lower({fold('source || text')}), '\s+'), lambda w: w <> '' AND w NOT IN ({STOP})) AS ws
        FROM documents""",
    "tokens": """SELECT doc_id, term, pos FROM (SELECT doc_id, unnest(ws) AS term,
        generate_subscripts(ws, 1) - 1 AS pos FROM words) t
        WHERE regexp_matches(term, '^[a-z0-9]+$')""",
    "postings": """SELECT doc_id, term, count(*) AS tf,
        string_agg(CAST(pos AS VARCHAR), ',' ORDER BY pos) AS positions
        FROM tokens GROUP BY doc_id, term""",
    "dictionary": "SELECT term, count(*) AS df FROM postings GROUP BY term",
    "weights": """SELECT doc_id, term, greatest(tf * ln((SELECT count(*) FROM documents) / df)
        / ln(10), 0) AS tf_idf FROM postings JOIN dictionary USING (term)""",
    # TF-IDF search.
    "text_queries": f"""SELECT item_id AS query_id, text AS raw FROM benchmark
        UNION ALL SELECT * FROM (VALUES {FIXED}) v(query_id, raw)""",
    "query_words": r"""SELECT query_id, w AS term, count(*) AS qtf FROM (
        SELECT query_id, unnest(regexp_split_to_array(lower(raw), '\s+')) AS w FROM text_queries) t
        WHERE regexp_matches(w, '^[a-z0-9]+$') GROUP BY query_id, w""",
    "known": "SELECT query_id, term, qtf FROM query_words JOIN dictionary USING (term)",
    "known_counts": "SELECT query_id, count(*) AS n FROM known GROUP BY query_id",
    "totals": """SELECT k.query_id, doc_id, sum(qtf * tf_idf) AS total FROM known k
        JOIN weights w ON k.term = w.term JOIN known_counts c ON c.query_id = k.query_id
        GROUP BY k.query_id, doc_id, n HAVING count(*) = n""",
    "text_hits": """SELECT query_id, doc_id,
        total / count(*) OVER (PARTITION BY query_id) AS score FROM totals""",
    # Fielded index and search.
    "field_words": r"""SELECT id AS doc_id, key AS field,
        regexp_extract_all(lower(value), '[\p{L}\p{N}]+') AS ws FROM entries""",
    "field_postings": """SELECT doc_id, field, term, count(*) AS tf, field_len FROM (
        SELECT doc_id, field, unnest(ws) AS term, CAST(len(ws) AS BIGINT) AS field_len
        FROM field_words) t GROUP BY doc_id, field, term, field_len""",
    "field_stats": """SELECT field, count(*) AS n, avg(len(ws)) AS mean_len
        FROM field_words WHERE len(ws) > 0 GROUP BY field""",
    "field_dfs": "SELECT field, term, count(*) AS df FROM field_postings GROUP BY field, term",
}


def _clauses_sql(raw: str) -> dict[str, str]:
    """CTEs for the clauses of one query per different string ``raw`` made of a part."""
    return {
        "asked": f"SELECT DISTINCT {raw} AS query_id, {raw} AS raw FROM part",
        **_grammar_sql(),
    }


def _grammar_sql() -> dict[str, str]:
    return {
        "parsed": """SELECT query_id, CASE WHEN contains(raw, '-OR') THEN 'OR' ELSE 'AND' END AS op,
            replace(raw, ' -OR', '') AS q FROM asked""",
        "pieces": """SELECT query_id, op, list_filter(string_split(q, chr(39)),
            lambda x: x <> '' AND x <> ' ') AS ps FROM parsed WHERE contains(q, ':')""",
        "clauses": """SELECT query_id, CAST(0 AS BIGINT) AS clause_id, op, 'all' AS field, q AS value
            FROM parsed WHERE NOT contains(q, ':')
            UNION ALL SELECT query_id,
              row_number() OVER (PARTITION BY query_id ORDER BY j) - 1, op, ps[j - 1], ps[j + 1]
            FROM (SELECT *, unnest(range(2, len(ps))) AS j FROM pieces) t
            WHERE contains(ps[j], ':')""",
    }


SEARCH: dict[str, str] = {
    "clause_words": r"""SELECT query_id, clause_id, op, field, term, count(*) AS qtf FROM (
        SELECT *, unnest(regexp_extract_all(lower(value), '[\p{L}\p{N}]+')) AS term FROM clauses) t
        GROUP BY query_id, clause_id, op, field, term""",
    "clause_sizes": """SELECT query_id, clause_id, count(*) AS n_terms FROM clause_words
        GROUP BY query_id, clause_id""",
    "field_matches": """SELECT c.query_id, c.clause_id, p.doc_id, p.field, c.op,
          count(*) AS found,
          sum(qtf * ln(1 + (s.n - df + 0.5) / (df + 0.5))
            * tf / (tf + 1.2 * (0.25 + 0.75 * field_len / mean_len))) AS score
        FROM clause_words c JOIN field_postings p
          ON p.term = c.term AND (c.field = 'all' OR c.field = p.field)
        JOIN field_stats s ON s.field = p.field
        JOIN field_dfs d ON d.field = p.field AND d.term = p.term
        GROUP BY c.query_id, c.clause_id, p.doc_id, p.field, c.op""",
    "clause_matches": """SELECT m.query_id, m.clause_id, doc_id, max(score) AS score
        FROM field_matches m JOIN clause_sizes z
          ON m.query_id = z.query_id AND m.clause_id = z.clause_id
        WHERE op = 'OR' OR found = n_terms GROUP BY m.query_id, m.clause_id, doc_id""",
    "field_hits": """SELECT m.query_id, doc_id, sum(score) AS score FROM clause_matches m
        JOIN (SELECT query_id, count(*) AS n FROM clauses GROUP BY query_id) n
          ON n.query_id = m.query_id
        GROUP BY m.query_id, doc_id, n HAVING count(*) = n""",
}


def _depends(ctes: dict[str, str], sql: str) -> list[str]:
    """Names of the expressions ``sql`` needs, in definition order."""
    import re

    needed: set[str] = set()
    todo = [sql]
    while todo:
        mentioned = set(re.findall(r"\b[a-z_]+\b", todo.pop())) & ctes.keys()
        todo += [ctes[name] for name in mentioned - needed]
        needed |= mentioned
    return [name for name in ctes if name in needed]


def _with(select: str, more: dict[str, str] | None = None) -> str:
    ctes = {**CTES, **(more or {})}
    names = _depends(ctes, select)
    heads = ",\n".join(f"{name} AS MATERIALIZED ({ctes[name]})" for name in names)
    return f"WITH {heads}\n{select}" if heads else select


def _markup(expr_by_name: dict[str, str], flatten: bool) -> str:
    text = flat("text") if flatten else "text"
    cols = ", ".join(f"{expr} AS {name}" for name, expr in expr_by_name.items())
    return _with(
        f"""SELECT kind, id, {cols} FROM (SELECT kind, id, {text} AS t FROM (
          SELECT 'document' AS kind, CAST(doc_id AS VARCHAR) AS id, text FROM documents
          UNION ALL SELECT 'page', CAST(page_id AS VARCHAR), html FROM pages
          UNION ALL SELECT 'wiki', id, text FROM wiki) u) v"""
    )


NAME = "'''name'': ''' || p_name || ''''"
MUST = "'''name'': ''' || p_name || ''' ''all'': ''' || p_brand || ''''"


def _hits(raw: str, more: dict[str, str] | None = None) -> str:
    return _with(
        "SELECT query_id, doc_id, round(score, 6) AS score FROM field_hits",
        {**_clauses_sql(raw), **SEARCH, **(more or {})},
    )


# The documents' entries after an update of every third document, with copies of every sixth.
LIVE_ENTRIES = f"""SELECT id, key, CASE WHEN CAST(id AS BIGINT) % 3 = 0 AND key IN ('name', 'title')
          THEN 'revised ' || value ELSE value END AS value FROM ({CTES['entries']}) e
        UNION ALL SELECT 'n' || id, key, CASE WHEN key = 'id' THEN 'n' || id ELSE value END
        FROM ({CTES['entries']}) e WHERE CAST(id AS BIGINT) % 6 = 1"""
REVISED = f"""CASE WHEN p_partkey % 2 = 0 THEN '''name'': ''revised ' || p_name || '''' ELSE {NAME} END"""


def oracle_sql() -> dict[str, str]:
    box_fields = {
        "extract_book": (book, r"(?i)\{\{Infobox *(book|short story)"),
        "extract_film": (film, r"(?i)\{\{Infobox *film"),
        "extract_navbox": (navbox, r"(?i)\{\{Navbox"),
    }
    seconds = "value * 97"
    return {
        "xml_pages": _with("SELECT id, title, text FROM wiki"),
        "xml_rejects": _with(
            """SELECT id, title, text, NULL AS reject FROM wiki
            UNION ALL SELECT id, title, text, reject FROM odd_pages"""
        ),
        "xml_title_text": _with("SELECT title, text FROM wiki"),
        "page_text_project": _with(
            "SELECT id, title, text, '{' || text || '}' AS wrapped FROM wiki"
        ),
        "csv_roundtrip": _with("SELECT id, title, text FROM extracts"),
        "csv_append_chunks": _with(
            "SELECT id, title, text FROM extracts UNION ALL SELECT id, title, text FROM "
            "selected_extracts"
        ),
        "csv_line_breaks": (
            "SELECT CAST(doc_id AS VARCHAR) AS id, source AS title, text FROM documents"
        ),
        "stream_numbered_pages": _with(
            """SELECT row_number() OVER (ORDER BY 1 - CAST(id AS BIGINT) % 2, CAST(id AS BIGINT)) - 1
              AS page_no, id, title, text FROM extracts"""
        ),
        "stream_batch_counts": _with(
            """SELECT 1 - CAST(id AS BIGINT) % 2 AS batch, count(*) AS pages_read,
              count(text) AS pages_complete,
              sum(CASE WHEN id IN (SELECT id FROM kept) THEN 1 ELSE 0 END)::BIGINT AS pages_kept,
              0::BIGINT AS pages_rejected
            FROM wiki GROUP BY 1"""
        ),
        "json_docs_write": _with(
            "SELECT id, string_agg(key || '=' || value, ';' ORDER BY key) AS doc FROM entries "
            "GROUP BY id"
        ),
        "json_docs_read": _with(
            r"""SELECT d.id, title, type, coalesce(string_agg(key || '=' || value, ';' ORDER BY key),
              '') AS fields, NULL AS reject FROM docs d LEFT JOIN last_fields f ON d.id = f.id
            GROUP BY d.id, title, type
            UNION ALL SELECT NULL, NULL, NULL, NULL, reject FROM (
              SELECT regexp_replace(translate(line, '[]', ''), ',\s*$', '') AS reject FROM (
                SELECT unnest(string_split(regexp_replace(text, '\n$', ''), chr(10))) AS line
                FROM documents) l) r
            WHERE trim(reject) <> ''"""
        ),
        "docs_with_sentinel": _with(
            "SELECT id, title, type, fields FROM docs UNION ALL SELECT '0', 'test', 'test', ''"
        ),
        "docs_upsert_by_id": _with(
            """SELECT id, CASE WHEN type = 'book' THEN title ELSE upper(title) END AS title, type,
              fields FROM docs"""
        ),
        "index_build_if_absent": _with("SELECT term, df FROM dictionary"),
        "drop_null_pages": _with("SELECT id, title, text FROM wiki WHERE text IS NOT NULL"),
        "page_classify": _with(f"SELECT id, {cls('text')} AS page_class FROM wiki"),
        "page_class_counts": _with(
            f"SELECT coalesce({cls('text')}, 'none') AS page_class, count(*) AS n_pages FROM wiki "
            "GROUP BY 1"
        ),
        "pages_kept": _with("SELECT id, title, text FROM kept"),
        "box_lines": _with("SELECT id, box FROM box"),
        "writer_tail": _with("SELECT id, tail FROM tail"),
        "infobox_subtype": _with(f"SELECT id, {subtype('text')} AS subtype FROM wiki"),
        "dense_page_id": _with(
            "SELECT id, title, row_number() OVER (ORDER BY CAST(id AS BIGINT)) - 1 AS page_no "
            "FROM kept"
        ),
        "run_counters": _with(
            """SELECT (SELECT count(*) FROM wiki) + (SELECT count(*) FROM part) AS pages_read,
              (SELECT count(*) FROM wiki WHERE text IS NOT NULL)
                + (SELECT count(text) FROM odd_pages) AS pages_complete,
              (SELECT count(reject) FROM odd_pages) AS pages_rejected,
              (SELECT count(*) FROM kept) AS pages_kept,
              (SELECT count(*) FROM typed WHERE type <> '') AS docs_indexed,
              (SELECT count(*) FROM typed WHERE type = '') AS docs_failed"""
        ),
        "ascii_fold": f"SELECT doc_id, {fold('text')} AS folded FROM documents",
        "text_normalize": _markup(
            {"dropped": normal("t"), "kept": normal("t", drop=False)}, flatten=False
        ),
        "strip_templates": _markup({"stripped": no_templates("t")}, flatten=True),
        "strip_refs": _markup({"stripped": no_refs("t")}, flatten=True),
        "format_elapsed": (
            f"SELECT event_id, printf('%d:%02d:%05.2f', CAST(floor(({seconds}) / 3600) AS BIGINT), "
            f"CAST(floor((({seconds}) % 3600) / 60) AS BIGINT), ({seconds}) % 60) AS elapsed "
            "FROM events"
        ),
        **{
            name: _with(f"SELECT id, {fields('box')} AS extract FROM box "
                        f"WHERE regexp_matches(box, '{test}')")
            for name, (fields, test) in box_fields.items()
        },
        "extract_writer_infobox": _with(
            rf"SELECT id, {writer_box(flat('text'))} AS extract FROM wiki "
            rf"WHERE regexp_matches(text, '(?i)\{{\{{Infobox *writer')"
        ),
        "extract_works": _with(f"SELECT id, {works('text')} AS extract FROM wiki "
                               "WHERE text IS NOT NULL"),
        "extract_works_anchored": _with(f"SELECT id, {works_at_start('tail')} AS extract FROM tail"),
        "wiki_extract_all": _with("SELECT id, title, text FROM extracts"),
        "wiki_extract_selected": _with("SELECT id, title, text FROM selected_extracts"),
        "wiki_extract_fallback": _with("SELECT id, title, text FROM fallback_extracts"),
        "doc_type": _with(
            r"""SELECT id, type FROM typed UNION ALL SELECT 'd' || CAST(doc_id AS VARCHAR),
            regexp_extract(replace(replace(text, '|', ' | '), '=', ' = '), '\S+') FROM documents"""
        ),
        "doc_fields": _with("SELECT id, pos, name, value FROM fields"),
        "doc_map": _with("SELECT id, title, type, fields FROM docs"),
        "doc_overrides": _with(
            """SELECT d.id, key AS name, CASE key WHEN 'id' THEN d.id WHEN 'title' THEN title
              ELSE type END AS kept, value FROM docs d JOIN last_fields f ON d.id = f.id
            WHERE key IN ('id', 'title', 'type')"""
        ),
        "doc_fields_long": _with("SELECT id, key AS name, value FROM last_fields"),
        "hit_display": _with(
            r"""SELECT id, name, replace(regexp_extract(t, '^[^|]+\|'), '|', '') AS type,
              (SELECT string_agg(CASE WHEN contains(s, ':') AND j > first THEN chr(10) ELSE '' END
                 || ' ' || s, '' ORDER BY j) FROM (
                 SELECT s, j, min(CASE WHEN contains(s, ':') THEN j END) OVER () AS first FROM (
                   SELECT unnest(ss) AS s, generate_subscripts(ss, 1) AS j) a) b) AS body
            FROM (SELECT id, title AS name, t, string_split(
                regexp_replace(regexp_replace(t, '^[^|]+\|', ''), '^\s+', ''), '|') AS ss
              FROM (SELECT id, title, replace(replace(text, ' br ', ' '), '=', ':') AS t
                FROM extracts) x) y"""
        ),
        "hit_fields_long": _with("SELECT id, key, value FROM entries"),
        "index_tokens": _with("SELECT doc_id, term, pos FROM tokens"),
        "index_postings": _with("SELECT doc_id, term, tf, positions FROM postings"),
        "index_build": _with("SELECT doc_id, term, tf, positions FROM postings"),
        "index_doc_freq": _with("SELECT term, df FROM dictionary"),
        "index_tfidf": _with("SELECT doc_id, term, round(tf_idf, 6) AS tf_idf FROM weights"),
        "index_fields": _with("SELECT doc_id, field, term, tf, field_len FROM field_postings"),
        "query_clauses": _with(
            "SELECT query_id, clause_id, op, field, value FROM clauses",
            {
                "asked": f"""SELECT DISTINCT raw AS query_id, raw FROM (
                    SELECT p_type || ' -OR' AS raw FROM part UNION ALL SELECT {MUST} FROM part
                    UNION ALL SELECT ':''' || p_type || ''' :' FROM part) r
                  UNION ALL SELECT CAST(query_id AS VARCHAR), raw FROM text_queries""",
                **_grammar_sql(),
            },
        ),
        "search_match_and": _hits(NAME),
        "search_match_or": _hits(f"{NAME} || ' -OR'"),
        "search_all_fields_and": _hits("p_name || ' ' || p_type"),
        "search_all_fields_or": _hits("p_name || ' -OR'"),
        "search_bool_must": _hits(MUST),
        "search_after_upsert": _hits(REVISED, {"entries": LIVE_ENTRIES}),
        "search_after_compaction": _hits(REVISED, {"entries": LIVE_ENTRIES}),
        "search_topk": _with(
            f"""SELECT query_id, doc_id, round(score, 6) AS score, rank FROM (
              SELECT *, row_number() OVER (PARTITION BY query_id
                ORDER BY round(score, 9) DESC, doc_id) AS rank FROM field_hits) t
            WHERE rank <= {TOP_K}""",
            {**_clauses_sql(f"{NAME} || ' -OR'"), **SEARCH},
        ),
        "search_tfidf": _with("SELECT query_id, doc_id, round(score, 6) AS score FROM text_hits"),
        "search_tfidf_ranked": _with(
            """SELECT query_id, doc_id, round(score, 6) AS score, row_number() OVER (
              PARTITION BY query_id ORDER BY round(score, 9), doc_id) AS rank FROM text_hits"""
        ),
        "search_tfidf_docs": _with(
            """SELECT query_id, h.doc_id, round(score, 6) AS score, source AS title, text
            FROM text_hits h JOIN documents d ON d.doc_id = h.doc_id"""
        ),
        "search_phrases": _with(
            """SELECT query_id, doc_id, count(*) AS n_matches FROM (
              SELECT p.query_id, doc_id, pos - slot AS start FROM phrase_words p
              JOIN phrase_sizes s ON s.query_id = p.query_id JOIN tokens t ON t.term = p.term
              GROUP BY p.query_id, doc_id, pos - slot, n HAVING count(*) = n) m
            GROUP BY query_id, doc_id""",
            {
                "phrase_words": r"""SELECT query_id, w AS term, slot FROM (
                    SELECT query_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS slot FROM (
                      SELECT query_id, list_filter(regexp_split_to_array(lower(raw), '\s+'),
                        lambda w: w <> '') AS ws FROM text_queries) a) t
                    WHERE regexp_matches(w, '^[a-z0-9]+$')""",
                "phrase_sizes": "SELECT query_id, count(*) AS n FROM phrase_words GROUP BY query_id",
            },
        ),
        "search_hit_counts": _with(
            """SELECT q.query_id, count(doc_id) AS n_hits FROM text_queries q
            LEFT JOIN text_hits h ON h.query_id = q.query_id GROUP BY q.query_id"""
        ),
    }
