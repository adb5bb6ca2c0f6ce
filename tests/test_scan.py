"""Scans of ordered rows with hot keys, and spans of one row."""

import random

import pytest
from pyspark.sql import functions as F

from venuegrid.functions import text
from venuegrid.operators import scan, stats


def plain_merge(ranges, gap=1):
    out = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1] + gap:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


@pytest.mark.parametrize("partitions", ["1", "7"])
def test_ranges_of_a_hot_key(spark, partitions):
    """One key has most rows, one range reaches over many buckets, a key is null, and results are those of a plain merge."""
    before = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rng = random.Random(2)
        made = [("hot", a, a + rng.randrange(9)) for a in (rng.randrange(20_000) for _ in range(3000))] + [("hot", 5000, 9000), ("hot", 12_000, 12_000)] * 2
        made += [(k, a, a + rng.randrange(30)) for k in ("a", None, "b") for a in (rng.randrange(400) for _ in range(20))]
        rows = spark.createDataFrame(made, "k string, start long, end long")
        got = text.merge_ranges(rows, ["k"], gap=2)
        want = {(k, *r) for k in {x[0] for x in made} for r in plain_merge([x[1:] for x in made if x[0] == k], 2)}
        assert {(r.k, r.start, r.end) for r in got.collect()} == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before[1])


def test_ties_between_scans(spark, monkeypatch):
    """Rows that tie stay in one run, in whatever order the join between the two scans leaves them."""
    carried, orders = scan._carried, [F.asc("n"), F.desc("n")]
    monkeypatch.setattr(scan, "_carried", lambda *given: carried(*given).coalesce(1).sortWithinPartitions(orders.pop(0)))
    rows = spark.createDataFrame([("k", 0, 1, 1), ("k", 10, 12, 1), ("k", 10, 12, 2), ("k", 10, 12, 3)], "k string, start long, end long, n int").coalesce(1)
    found = scan.islands(rows, ["k"], ["start", "end"], F.col("end"), lambda far: F.col("start") > far + 1)
    assert sorted((r.start, r[scan.ISLAND]) for r in found.collect()) == [(0, 1), (10, 2), (10, 2), (10, 2)]


def test_no_task_scans_a_hot_key(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = spark.range(40_000).select(F.lit("hot").alias("k"), (F.col("id") * 3).alias("start"), (F.col("id") * 3).alias("end"))
        found = scan.islands(rows, ["k"], ["start", "end"], F.col("end"), lambda far: F.col("start") > far + 1)
        sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 40_000 and max(sizes) < 14_000  # 16 buckets, some of which meet in a task
        assert found.agg(F.countDistinct(scan.ISLAND)).first()[0] == 40_000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_empty_and_sessions(spark):
    rows = spark.createDataFrame([("u", 1, "2025-01-01 00:00:00"), ("u", 2, "2025-01-01 06:00:00"), ("u", 3, "2025-01-01 12:00:01"), ("v", 4, None)], "k string, id int, t string").withColumn("ts", F.col("t").cast("timestamp"))
    got = stats.sessions(rows, ["k"], "ts", ["id"], "6 hours")
    assert sorted((r.k, r.n) for r in got.collect()) == [("u", 1), ("u", 2), ("v", 1)]
    assert text.merge_ranges(spark.createDataFrame([], "k string, start long, end long"), ["k"]).count() == 0


def test_spans_of_one_row(spark):
    spans = lambda s: F.from_json(F.lit(s), "array<struct<start: int, end: int>>")
    said = lambda c: [tuple(x) for x in spark.range(1).select(c.alias("x")).first().x]
    some = spans('[{"start":0,"end":2},{"start":3,"end":3},{"start":6,"end":8},{"start":10,"end":11}]')
    assert said(text.merge_spans(some)) == [(0, 3), (6, 8), (10, 11)]
    assert said(text.merge_spans(text.widen_spans(some, 1, F.lit(11)))) == [(0, 11)]
    assert said(text.merge_spans(spans("[]"))) == []
    assert spark.range(1).select(text.merge_spans(spans("null")).alias("x")).first().x is None


def test_blocks_are_local(spark):
    rows = spark.createDataFrame([(1, "a\nb\n\n  c  d  e\n x\n\n\ny"), (2, ""), (3, None), (4, "only")], "doc_id int, text string")
    got = text.blocks(rows)
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    assert sorted(tuple(r) for r in got.collect()) == [(1, 0, 1, "paragraph", "a\nb"), (1, 3, 3, "tabular", "  c  d  e"), (1, 4, 4, "indented", " x"), (1, 7, 7, "paragraph", "y"), (4, 0, 0, "paragraph", "only")]
