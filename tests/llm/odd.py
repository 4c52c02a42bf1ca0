"""Small tables with everything that may go wrong, and the whole test tables' texts."""

from __future__ import annotations

import os
import random

SMALL = "/root/testdata/sf0.001"

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    # Names that operators use inside.
    "slot string, bits string, key string, d1 string, start string, part string, ids string, "
    "score string, label string, spans string, path string, root string, node string, "
    "own string, up string, license string, _id string, _key string, _spans string, _d1 string, "
    "dirty_key string, of_id string, of_text string, word string, n string"
)


def odd_rows() -> list[tuple]:
    draw = random.Random(5)
    words = ["".join(draw.choice("abcdefgh") for _ in range(draw.randint(2, 7))) for _ in range(400)]
    text = lambda n: " ".join(draw.choice(words) for _ in range(n))
    passage, base = text(90), text(120)
    near = base.split()
    near[60] = "changed"
    texts = [
        None, "", " \n\t ", "one", "Zürich – naïve\u00a0ß", "a" * 3000, text(20_000), base, base,
        " ".join(near), base.upper(), text(30) + "\n" + passage + "\n" + text(40),
        text(50) + " " + passage, "x  y   z\n\n\nw ", "<|endoftext|> it's  \r\n \x0b odd",
        passage[:500] * 3,
    ]
    rows = [(i, t, "en", "src0", None) for i, t in enumerate(texts)]
    rows += [(None, base, None, None, 3), (None, None, None, None, None), rows[7], rows[7], rows[11]]
    return [row + ("x",) * 25 for row in rows]


def odd_documents(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)


def rows_of(df) -> list[tuple]:
    return [tuple(r) for r in df.collect()]


def sql_table(con, folder: str, name: str) -> None:
    con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{os.path.join(folder, name)}.parquet'")
