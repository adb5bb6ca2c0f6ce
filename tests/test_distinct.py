"""Costly work by distinct input: what is joined back, how it is dealt, and the queries that do it so."""

import pytest
from pyspark.sql import functions as F

import venuegrid.plans.schedules  # noqa: F401  registers its queries with the catalog
from venuegrid.operators import distinct
from venuegrid.plans import catalog

D = "/root/testdata/sf0.001"
#: The query, and the distinct inputs for which something is made.
CASES = {
    "osm_slot_rows": 60,  # two notations have no slots
    "document_round_trip": 62,
    "typed_round_trip": 62,
    "schedule_document": 62,
    "evaluation_scores": 9,
    "typed_differences": 20,
    "sql_round_trip": 62,
    "sql_schedule_diff": 20,
    "document_differences": 20,
}


def test_rows_and_nulls(spark):
    rows = spark.createDataFrame([(k, *p) for k, p in enumerate([("a", None), ("a", "b"), (None, None), ("a", None), ("", None)] * 3)], "k int, x string, y string")
    dealt = []

    def made(each):
        dealt.append((each.count(), each.rdd.getNumPartitions()))
        return each.select("x", "y", F.concat(F.coalesce("x", F.lit("?")), F.coalesce("y", F.lit("?"))).alias("z"), F.explode(F.array(F.lit(1), F.lit(2))).alias("n"))

    got = distinct.once_each(rows, ["x", "y"], made)
    assert got.columns == ["k", "x", "y", "z", "n"]
    assert sorted(map(tuple, got.select("k", "z", "n").collect())) == sorted((r.k, (r.x if r.x is not None else "?") + (r.y or "?"), n) for r in rows.collect() for n in (1, 2))
    assert dealt == [(4, 2 * spark.sparkContext.defaultParallelism)]


@pytest.mark.parametrize("name", CASES)
def test_queries(spark, monkeypatch, name):
    made, kept = [], distinct.kept
    monkeypatch.setattr(distinct, "kept", lambda rows, what: made.append(kept(rows, what)) or made[-1])
    catalog.QUERIES[name](spark, D)
    inputs = [c for c in made[0].columns if c.startswith("__of_")]
    assert (made[0].select(inputs).distinct().count(), len(made)) == (CASES[name], 1)
