"""The registered queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    ann, common, decontaminate, licenses, lm, packing, quality, runs, sharding, simhash, spelling,
    suffix, tokenfile, urlfilter,
)

QUERY_EVERY = 20
URL_RULES = [
    urlfilter.site_rule("allow", "org", "/"),
    urlfilter.site_rule("block", "example.org", "/es/"),
    urlfilter.site_rule("block", "example.org", "/en/1"),
    urlfilter.site_rule("allow", "com", "/fr/"),
    urlfilter.site_rule("block", "com", "/de/"),
]


def op1_shard_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Whole documents by their source, so that one source may own a large share of the rows."""
    return sharding.assign(common.table(spark, folder, "documents"), ["source"])


def op2_pack_documents(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(common.table(spark, folder, "documents"))


def op3_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = common.table(spark, folder, "documents")
    return quality.score(docs, quality.train(docs, common.table(spark, folder, "labels")))


def op4_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.overlaps(
        common.table(spark, folder, "documents"), common.table(spark, folder, "benchmark"))


def op5_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(common.table(spark, folder, "documents"))


def op6_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix.summaries(common.table(spark, folder, "documents"))


def op7_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return urlfilter.judge_urls(common.table(spark, folder, "pages"), URL_RULES)


def op8_token_file(spark: SparkSession, folder: str) -> DataFrame:
    path = common.scratch_path(spark, "token-file")
    tokenfile.write_token_file(common.table(spark, folder, "documents"), path)
    return tokenfile.read_token_file(spark, path)


def op9_nearest(spark: SparkSession, folder: str) -> DataFrame:
    return ann.nearest(
        common.table(spark, folder, "embeddings"), F.col("vec_id") % QUERY_EVERY == 0)


def op10_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as files ``source/lang/hundred/id``."""
    path = F.concat_ws("/", "source", "lang", F.expr("doc_id div 100"), "doc_id")
    docs = common.table(spark, folder, "documents").select("doc_id", "text", path.alias("path"))
    return licenses.scan(docs)


def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(common.table(spark, folder, "documents"), prepare=spelling.misspelt)


def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return runs.periodic_runs(common.table(spark, folder, "documents"), prepare=runs.planted)


def op13_likelihoods(spark: SparkSession, folder: str) -> DataFrame:
    return lm.log_likelihoods(common.table(spark, folder, "documents"))


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_shard_documents, op2_pack_documents, op3_quality, op4_decontaminate, op5_simhash,
        op6_suffix_dedup, op7_url_filter, op8_token_file, op9_nearest, op10_license_scan,
        op11_spelling_variants, op12_periodic_runs, op13_likelihoods,
    )
}

# The rules of the query.
URL_SQL = """
WITH parts AS (
  SELECT page_id,
         coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), rules(verdict, rule_host, rule_path) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
         ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
), fits AS (
  SELECT parts.page_id, rule_host || rule_path AS rule, verdict,
         row_number() OVER (PARTITION BY parts.page_id
                            ORDER BY length(rule_host || rule_path) DESC) AS place
  FROM parts JOIN rules
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
)
SELECT parts.page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM parts LEFT JOIN fits ON parts.page_id = fits.page_id AND place = 1
"""


def _license_sql() -> str:
    quote = lambda text: "'" + text.replace("'", "''") + "'"
    values = ", ".join(
        f"({i}, {quote(name)}, {quote(text)})" for i, (name, text) in enumerate(licenses.TEMPLATES))
    plain = f"translate({{}}, '{licenses.UPPER}', '{licenses.LOWER}')"
    words = lambda text: f"regexp_extract_all({plain.format(text)}, '[a-z0-9]+')"
    different = lambda text: f"list_distinct({words(text)})"
    likely = lambda text: (
        f"coalesce(len(list_intersect({different(text)}, vocabulary)) >= {licenses.TEMPLATE_SHARE} "
        f"* nullif(len({different(text)}), 0), false)")

    def best(texts: str, key: str) -> str:
        """Names of expressions: terms, weights, norms, dots and the best template of texts."""
        return f"""{key}_terms AS (
  SELECT {key}, term, count(*) AS tf
  FROM (SELECT {key}, unnest({words(key)}) AS term FROM {texts}) GROUP BY ALL
), {key}_weighed AS (
  SELECT {key}, t.term, tf * coalesce(idf, ln(total + 1.0) + 1.0) AS w
  FROM {key}_terms t CROSS JOIN total LEFT JOIN idf ON idf.term = t.term
), {key}_norms AS (SELECT {key}, sqrt(sum(w * w)) AS norm FROM {key}_weighed GROUP BY {key}),
{key}_dots AS (
  SELECT {key}, template, sum(w * tw) AS dot FROM {key}_weighed JOIN phrases USING (term) GROUP BY ALL
), {key}_best AS (
  SELECT {key}, license, cosine FROM (
    SELECT {key}, license, round(dot / (norm * tn), 6) AS cosine,
           row_number() OVER (PARTITION BY {key}
                              ORDER BY round(dot / (norm * tn), 6) DESC, license) AS place
    FROM {key}_dots JOIN {key}_norms USING ({key}) JOIN phrase_norms USING (template)
    JOIN known USING (template))
  WHERE place = 1 AND cosine >= {licenses.COSINE}
)"""

    return f"""
WITH known(template, license, phrase) AS (VALUES {values}),
phrase_terms AS (
  SELECT template, term, count(*) AS tf
  FROM (SELECT template, unnest({words("phrase")}) AS term FROM known) GROUP BY ALL
), vocabularies AS (SELECT list(DISTINCT term) AS vocabulary FROM phrase_terms),
files AS (
  SELECT doc_id, coalesce(text, '') AS text,
         concat_ws('/', source, lang, doc_id // 100, doc_id) AS path
  FROM documents
), lines AS (
  SELECT path, text, line, i, vocabulary, {likely("line")} AS likely
  FROM (SELECT path, text, unnest(string_split(text, chr(10))) AS line,
               generate_subscripts(string_split(text, chr(10)), 1) AS i
        FROM files WHERE regexp_matches({plain.format("text")}, '{licenses.HEADER}')) s
  CROSS JOIN vocabularies
), starts AS (
  SELECT a.path, a.text, a.line, a.i, (
      SELECT coalesce(min(b.i), 1000000000) FROM lines b
      WHERE b.path = a.path AND b.i > a.i AND NOT b.likely) AS stop
  FROM lines a WHERE regexp_matches({plain.format("a.line")}, '{licenses.HEADER}')
), headers AS (
  SELECT DISTINCT path, text, line AS header FROM starts
  UNION SELECT s.path, any_value(s.text), string_agg(l.line, ' ' ORDER BY l.i)
  FROM starts s JOIN lines l ON l.path = s.path AND l.i >= s.i AND l.i < s.stop
  GROUP BY s.path, s.i HAVING count(*) > 1
), blocks AS (SELECT header, count(*) AS n FROM headers GROUP BY header),
total AS (SELECT coalesce(sum(n), 0) AS total FROM blocks),
idf AS (
  SELECT v.term, ln((total + 1.0) / (1.0 + coalesce(sum(n), 0))) + 1.0 AS idf
  FROM (SELECT DISTINCT term FROM phrase_terms) v CROSS JOIN total
  LEFT JOIN (SELECT n, unnest({different("header")}) AS term FROM blocks) t ON t.term = v.term
  GROUP BY v.term, total
), phrases AS (SELECT template, term, tf * idf AS tw FROM phrase_terms JOIN idf USING (term)),
phrase_norms AS (SELECT template, sqrt(sum(tw * tw)) AS tn FROM phrases GROUP BY template),
wholes AS (
  SELECT DISTINCT text AS whole FROM files CROSS JOIN vocabularies
  WHERE regexp_matches({plain.format("text")}, '{licenses.HEADER}') AND {likely("text")}
), {best("blocks", "header")}, {best("wholes", "whole")},
near AS (
  SELECT path, license, cosine, 0 AS kind,
         len({words("header")}) >= {licenses.FILE_SHARE} * len({words("text")})
         OR regexp_matches({plain.format("path")}, '{licenses.FILE_NAME}') AS is_file
  FROM headers JOIN header_best USING (header)
  UNION ALL SELECT path, license, cosine, 1, true FROM files JOIN whole_best ON whole = text
), own AS (
  SELECT path, license, cosine, kind, is_file FROM (
    SELECT path, license, cosine, kind, bool_or(is_file) OVER (PARTITION BY path) AS is_file,
           row_number() OVER (PARTITION BY path ORDER BY cosine DESC, license, kind) AS place
    FROM near)
  WHERE place = 1
), license_files AS (
  SELECT folder, license, cosine FROM (
    SELECT regexp_extract(path, '^(.*)/[^/]*$', 1) AS folder, license, cosine,
           row_number() OVER (PARTITION BY regexp_extract(path, '^(.*)/[^/]*$', 1)
                              ORDER BY cosine DESC, path) AS place
    FROM own WHERE is_file)
  WHERE place = 1
), nearest AS (
  SELECT dir, license, cosine FROM (
    SELECT dir, license, cosine, row_number() OVER (PARTITION BY dir ORDER BY length(folder) DESC) AS place
    FROM (SELECT DISTINCT regexp_extract(path, '^(.*)/[^/]*$', 1) AS dir FROM files)
    JOIN license_files ON dir = folder OR starts_with(dir, folder || '/'))
  WHERE place = 1
)
SELECT files.doc_id, files.path, coalesce(own.license, nearest.license) AS license,
       CASE WHEN own.license IS NOT NULL THEN CASE kind WHEN 1 THEN 'text' ELSE 'header' END
            WHEN nearest.license IS NOT NULL THEN 'directory' ELSE 'none' END AS basis,
       coalesce(own.cosine, nearest.cosine) AS similarity
FROM files LEFT JOIN own ON own.path = files.path
LEFT JOIN nearest ON dir = regexp_extract(files.path, '^(.*)/[^/]*$', 1)
"""


# The checksum is worked out byte by byte from its table; words one edit apart meet in what a
# deleted character leaves.
SPELLING_SQL = """
WITH RECURSIVE table_ AS (
  SELECT list(list_reduce([i] || [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda c, z:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM (SELECT unnest(range(256)) AS i)
), runs AS (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents)
  GROUP BY doc_id, run
), hashed AS (
  SELECT run, n, xor(list_reduce([4294967295::BIGINT] || list_transform(
      range(strlen(doc_id || ':' || run)),
      lambda k: ('0x' || substr(hex(encode(doc_id || ':' || run)), 2 * k + 1, 2))::BIGINT),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h
  FROM runs CROSS JOIN table_
), words AS (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2)
                ELSE run END AS word, n
    FROM hashed)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), less AS (
  SELECT word, place, substr(word, 1, place - 1) || substr(word, place + 1) AS rest
  FROM (SELECT word, unnest(range(1, length(word) + 1)) AS place FROM words)
), near AS (
  SELECT a.word, b.word AS other FROM less a JOIN less b
    ON a.place = b.place AND a.rest = b.rest AND a.word != b.word
  UNION SELECT rest, less.word FROM less JOIN words ON rest = words.word
  UNION SELECT less.word, rest FROM less JOIN words ON rest = words.word
), best AS (
  SELECT near.word, count(*) AS n_near, max(o.n) AS form_n,
         arg_min(o.word, (-o.n, o.word)) AS form
  FROM near JOIN words o ON o.word = other GROUP BY near.word
), forms AS (
  SELECT words.word, words.n, coalesce(n_near, 0) AS n_near,
         CASE WHEN form_n >= 2 * words.n THEN form END AS form,
         CASE WHEN form_n >= 2 * words.n THEN form_n END AS form_n
  FROM words LEFT JOIN best ON best.word = words.word
), chains AS (
  SELECT word, word AS root FROM forms WHERE form IS NULL
  UNION ALL SELECT forms.word, root FROM forms JOIN chains ON form = chains.word
)
SELECT forms.word, form, root, n, n_near, form_n FROM forms JOIN chains ON chains.word = forms.word
"""


ORACLE: dict[str, str] = {"op11_spelling_variants": SPELLING_SQL, "op7_url_filter": URL_SQL, "op10_license_scan": _license_sql()}
