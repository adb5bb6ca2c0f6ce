"""The typed document against the JSON one, and what a stored column reads."""

import json

from pyspark.sql import functions as F
from test_documents import dates, day, weekly
from test_sql import TEXTS

from venuegrid.functions import documents, typed


def made():
    """JSON documents with the five periods in many states."""
    slots = [day(("09:00", "12:00")), day(("09:00", "12:00"), ("14:00", "18:00")), day(("10:00", "11:00", [1, 3])), day(ouvert=False), day(), {"source_found": False}]
    out = []
    for k in range(24):
        periods = {"hors_vacances_scolaires": weekly(k % 5 != 0, lundi=slots[k % 6], Mardi=slots[(k + 1) % 6], dimanche=slots[(k * 3) % 6]), "petites_vacances_scolaires": weekly(k % 3 == 0, jeudi=slots[(k + 2) % 6])}
        if k % 2:
            periods["jours_feries"] = dates(d2025_12_25="ferme", d2026_01_01=slots[k % 6]) | {"mode": "ferme"}
        if k % 4 == 0:
            periods["jours_speciaux"] = dates(d2025_12_25="ouvert", noel="ferme") | {"source_found": k % 8 == 0}
        if k % 7 == 0:
            periods["jours_feries"] = {"source_found": True, "mode": "ouvert", "condition": "PH"}
        out.append(json.dumps({"horaires_ouverture": {"periodes": periods, "extraction_info": {"permanently_closed": k == 3, "notes": f"n{k}"}}}))
    return [*out, "no json", "{}", None]


def test_printing_and_closure(spark):
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(made())], "k int, t string").withColumn("d", typed.from_json(F.col("t")))
    for r in rows.where("d IS NOT NULL").select("k", typed.to_osm(F.col("d")).alias("a"), documents.to_osm(F.col("t")).alias("b"), typed.permanently_closed(F.col("d")).alias("x"), documents.permanently_closed(F.col("t")).alias("y"), "d.notes", "d.permanently_closed").collect():
        assert (r.a, r.x) == (r.b, r.y), r.k
        assert r.k > 23 or (r.notes == f"n{r.k}" and r.permanently_closed == (r.k == 3))
    assert {r.k for r in rows.where("d IS NULL").collect()} == {24, 26}


def test_comparison(spark):
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(made()[:24])], "k int, t string")
    stored = rows.withColumn("d", typed.from_json(F.col("t")))
    pairs = stored.alias("p").join(stored.alias("q"), F.expr("(p.k * 5 + q.k) % 3 = 0")).select(F.col("p.t").alias("t1"), F.col("q.t").alias("t2"), F.col("p.d").alias("d1"), F.col("q.d").alias("d2"))
    for r in pairs.select("t1", "t2", typed.compare(F.col("d1"), F.col("d2")).alias("a"), documents.compare(F.col("t1"), F.col("t2")).alias("b")).collect():
        assert r.a == r.b, (r.t1, r.t2)


def test_documents_of_notations(spark):
    rows = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    both = rows.select("t", typed.from_osm(F.col("t")).alias("a"), documents.document(F.col("t")).alias("j")).select("t", "a", typed.from_json(F.col("j")).alias("b"))
    for r in both.collect():
        assert r.a == r.b, r.t


def test_only_the_periods_asked_for_are_read(spark, tmp_path):
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(made()[:24])], "k int, t string")
    stored = rows.select("k", typed.from_json(F.col("t")).alias("a"), typed.from_json(F.lit(made()[1])).alias("b"))
    stored.write.parquet(str(tmp_path / "documents"))
    again = spark.read.parquet(str(tmp_path / "documents"))
    asked = again.select("k", typed.week_changes(F.col("a"), F.col("b"), "petites_vacances_scolaires").alias("x"))
    scan = asked._jdf.queryExecution().executedPlan().toString().split("ReadSchema:")[1]
    assert "petites_vacances_scolaires" in scan and "hors_vacances" not in scan and "jours_feries" not in scan and "notes" not in scan
    assert sorted(map(tuple, asked.collect())) == sorted(map(tuple, stored.select("k", typed.week_changes(F.col("a"), F.col("b"), "petites_vacances_scolaires").alias("x")).collect()))
