import random
import re

from pyspark.sql import functions as F

from folioforge.functions import boxes

LINES = {
    "s": "{{Navbox x", "b": "a {{t}} b", "o": "open {{t", "c": "close }}", "p": "plain",
}
BOX = "s(?:[sbp]|o[sop]*[bc])*"
INSIDE = re.compile(f"^(?:[^s]*{BOX}c)*[^s]*{BOX}(?:o[sop]*)?$")


def select(spark, texts, function):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    return [r[1] for r in sorted(df.select("i", function(F.col("text"))).collect())]


def test_random_line_kinds_against_a_regular_language(spark):
    rng = random.Random(11)
    cases = ["".join(rng.choice("sbocp") for _ in range(rng.randint(1, 14))) for _ in range(600)]
    texts = ["\n".join(f"{LINES[k]} {i}" for i, k in enumerate(case)) for case in cases]
    for case, text, got in zip(cases, texts, select(spark, texts, boxes.box_text)):
        lines = text.split("\n")
        kept = [
            lines[i] for i, k in enumerate(case) if k == "s" or INSIDE.match(case[:i])
        ]
        assert got == " ".join(kept), case


def test_edges(spark):
    cases = {
        "": "",
        "no box": "",
        "{{Navbox|a}}\nrest\n}}\nout": "{{Navbox|a}} rest }}",
        "x\n{{infobox   FILM\n|a\nb\n": "{{infobox   FILM |a b",
        "{{Infobox book\n{{x\n}}\n|a\n}}\nout\n{{Navbox\n}}": "{{Infobox book {{x }} |a }} {{Navbox }}",
        "{{Infobox writer\n}}": "",
        "{{Infobox person {{Navbox\n}}": "{{Infobox person {{Navbox }}",
    }
    assert select(spark, list(cases), boxes.box_text) == list(cases.values())


def test_tail(spark):
    cases = {
        "a\nb === Works ===\nc\n": "b === Works ===\nc",
        "a\n== bibliography==": "== bibliography==",
        "none": "",
    }
    assert select(spark, list(cases), boxes.writer_tail) == list(cases.values())


def test_box_and_tail(spark):
    cases = {
        "{{Navbox\n== Works ==\n}}\nx": "{{Navbox == Works == }}",
        "x\n== Works ==\na\n{{Navbox\n}}\nb": "== Works == a {{Navbox }} b",
        "{{Navbox\n}}\nx\n==Works==\ny": "{{Navbox }} ==Works== y",
        "nothing": "",
    }
    assert select(spark, list(cases), boxes.box_and_tail_text) == list(cases.values())
