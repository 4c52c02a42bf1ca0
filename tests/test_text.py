import random
import unicodedata

from pyspark.sql import functions as F

from folioforge.functions import text
from folioforge.functions.fold import ascii_fold, fold_table
from folioforge.functions.terms import index_words, positioned_terms, term_runs


def column(spark, values, *exprs):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, text string")
    rows = df.select("i", *exprs).collect()
    return [tuple(r)[1:] for r in sorted(rows)]


def test_fold_of_common_letters(spark):
    cases = {
        "Žižek Łódź Ærø straße": "Zizek Lodz AEro strasse",
        "Достоевский": "Dostoevskii",
        "Ὅμηρος": "Omeros",
        "“quoted” — it’s…": '"quoted" -- it\'s...',
        "ﬁn × ½ №5": "fin x 1/2 No5",
        "plain": "plain",
        "": "",
        "日本": "日本",  # not covered, left as it is
    }
    folded = column(spark, list(cases), ascii_fold(F.col("text")))
    assert [f for (f,) in folded] == list(cases.values())


def test_fold_covers_every_table_entry_alone_and_in_context(spark):
    table = fold_table()
    values = [f"a{c}z" for c in table]
    got = column(spark, values, ascii_fold(F.col("text")))
    assert [g for (g,) in got] == [f"a{s}z" for s in table.values()]


def test_accented_latin_letters_lose_their_accents():
    for c in "ÀÉÎÕÜçñāąčěłőřšůžÿ":
        base = unicodedata.normalize("NFD", c)[0]
        assert fold_table()[c] == ("l" if c == "ł" else base)


def test_latin_blocks_are_covered():
    table = fold_table()
    assert all(chr(cp) in table for cp in range(0xA0, 0x100))
    assert table["µ"] == "u" and table["ƀ"] == "b" and table["Ɠ"] == "G" and table["ɇ"] == "e"
    assert sum(chr(cp) not in table for cp in range(0x100, 0x250)) < 50


def test_normalize(spark):
    got = column(
        spark,
        ['A "B" [[C]]\n\n{d|e = f*} <noinclude>', " x ", "É.É", None],
        text.normalize_text(F.col("text")),
        text.normalize_text(F.col("text"), drop_noinclude=False),
    )
    assert got[0] == ("a b c d|e = f* ", "a b c d|e = f* noinclude ")
    assert got[1] == (" x ", " x ")
    assert got[2] == ("e e", "e e")
    assert got[3] == (None, None)


def test_normalize_twice_changes_nothing(spark):
    pool = "aZ09|()*=é ß\n\t{}[]<>\"'.,-_№日"
    rng = random.Random(3)
    values = ["".join(rng.choice(pool) for _ in range(40)) for _ in range(300)]
    once = text.normalize_text(F.col("text"), drop_noinclude=False)
    twice = text.normalize_text(once, drop_noinclude=False)
    for first, second in column(spark, values, once, twice):
        assert first == second
        assert set(first) <= set("abcdefghijklmnopqrstuvwxyz0123456789|()*= ")
        assert "  " not in first


def test_strip(spark):
    got = column(
        spark,
        ["a {b {c} d} e", "{}", "{open", "x <ref>1</ref> y < Ref z>2< / REF> t", "<ref/> </ref"],
        text.strip_templates(F.col("text")),
        text.strip_refs(F.col("text")),
    )
    assert [g[0] for g in got[:3]] == ["a  } d} e", " }", "{open"]
    assert [g[1] for g in got[3:]] == ["x  > t", " "]


def test_lines(spark):
    values = ["a\nb", "a\nb\n", "", "\n", "a\r\nb\x0bc d\x85e", "\n\n"]
    got = column(spark, values, text.split_lines(F.col("text")))
    assert [g for (g,) in got] == [v.splitlines() for v in values]


def test_elapsed_is_formatted_as_python_does(spark):
    rng = random.Random(1)
    values = [0.0, 0.125, 0.375, 1.005, 59.995, 59.999, 60.0, 3599.994, 3600.0, 90061.5]
    values += [rng.uniform(0, 100_000) for _ in range(300)]
    values += [rng.randrange(0, 10_000) / 8 for _ in range(200)]
    df = spark.createDataFrame([(v,) for v in values], "s double")
    for s, shown in df.select("s", text.format_elapsed(F.col("s"))).collect():
        expected = f"{int(s / 3600)}:{int(s % 3600 / 60):02d}:{s % 60:05.2f}"
        assert shown == expected, s


def test_positions_count_rejected_words_but_not_stop_words(spark):
    value = "The infobox  cat's br cat\tTHE Infobox |hlist dog. cat"
    ((words, terms, runs),) = column(
        spark, [value],
        index_words(F.col("text")), positioned_terms(F.col("text")),
        term_runs(positioned_terms(F.col("text"))),
    )
    assert words == ["the", "cat's", "cat", "the", "dog.", "cat"]
    assert [tuple(t) for t in terms] == [("the", 0), ("cat", 2), ("the", 3), ("cat", 5)]
    assert [tuple(r) for r in runs] == [("cat", 2, [2, 5]), ("the", 2, [0, 3])]


def test_runs_of_random_words(spark):
    rng = random.Random(5)
    values = [" ".join(rng.choice("a b c dd e! f").strip() or "z" for _ in range(n)) for n in range(60)]
    got = column(spark, values, term_runs(positioned_terms(F.col("text"))))
    for value, (runs,) in zip(values, got):
        expected = {}
        for pos, word in enumerate(value.split()):
            if word.isalnum():
                expected.setdefault(word, []).append(pos)
        assert {r.term: r.pos_list for r in runs} == expected
        assert all(r.tf == len(r.pos_list) for r in runs)


def test_hangul_syllables_fold_to_their_names(spark):
    syllables = [chr(cp) for cp in range(0xAC00, 0xD7A4)]
    names = [unicodedata.name(c).split()[-1].lower() for c in syllables]
    # All syllables in texts of sixty, and a few in context.
    texts = ["x".join(syllables[i : i + 60]) for i in range(0, len(syllables), 60)]
    wanted = ["x".join(names[i : i + 60]) for i in range(0, len(names), 60)]
    found = column(spark, [*texts, "한국어 é!", "a 안녕하세요"], ascii_fold(F.col("text")))
    assert [f for (f,) in found] == [*wanted, "hangugeo e!", "a annyeonghaseyo"]
