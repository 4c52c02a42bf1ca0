"""One key with a third or more of the rows."""

import random

import pytest
from pyspark.sql import functions as F

from folioforge.operators import skew


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(6)
    return [(rng.choice(["hot", "hot", f"k{i % 50}"]), i, rng.randint(0, 9)) for i in range(3000)]


@pytest.fixture(scope="module")
def table(spark, rows):
    return spark.createDataFrame(rows, "k string, i bigint, v int").repartition(6)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
@pytest.mark.parametrize("broadcast", [True, False])
def test_salted_join_equals_the_plain_join(spark, table, how, broadcast):
    lookup = spark.createDataFrame([("hot", 1), ("k1", 2), ("k2", 3)], "k string, w int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m" if broadcast else "-1")
    try:
        salted = skew.salted_join(table, lookup, ["k"], "i", how).collect()
        plain = table.join(lookup, "k", how).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted(map(str, salted)) == sorted(map(str, plain))


@pytest.mark.parametrize("hot_keys", [1, 2, 100, 100_000])
def test_hot_join_equals_the_plain_join(spark, table, monkeypatch, hot_keys):
    monkeypatch.setattr(skew, "HOT_KEYS", hot_keys)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lookup = table.select("k").distinct().where("k != 'k3'").withColumn("w", F.length("k"))
        counts = table.groupBy("k").agg(F.count("*").alias("n"))
        joined = skew.hot_join(table, lookup, "k", "i", counts)
        got = joined.select("k", "i", "v", "w").collect()
        plain = table.join(lookup, "k").select("k", "i", "v", "w").collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted(map(tuple, got)) == sorted(map(tuple, plain))


@pytest.mark.parametrize("limit", [1, 7, 5000])
def test_top_per_group(rows, table, limit):
    got = skew.top_per_group(table, "k", [F.col("v").desc(), F.col("i")], limit, "i").collect()
    groups = {}
    for k, i, v in rows:
        groups.setdefault(k, []).append((-v, i))
    expected = {(k, n + 1, i) for k, g in groups.items() for n, (_, i) in enumerate(sorted(g)[:limit])}
    assert {(r.k, r["rank"], r.i) for r in got} == expected
    assert len(got) == len(expected)


def test_numbers_per_group_and_over_the_table(rows, table):
    got = skew.number_rows(table, [F.col("v"), F.col("i")], "n", group="k", start=1).collect()
    groups = {}
    for k, i, v in rows:
        groups.setdefault(k, []).append((v, i))
    expected = {(k, n + 1, i) for k, g in groups.items() for n, (_, i) in enumerate(sorted(g))}
    assert {(r.k, r.n, r.i) for r in got} == expected and len(got) == len(rows)

    whole = skew.number_rows(table, [F.col("v"), F.col("i")], "n").collect()
    ordered = [r.i for r in sorted(whole, key=lambda r: r.n)]
    assert [r.n for r in sorted(whole, key=lambda r: r.n)] == list(range(len(rows)))
    assert ordered == [i for _, i in sorted((v, i) for _, i, v in rows)]
