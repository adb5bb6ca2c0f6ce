"""The SQL functions against the Column functions, and their plans."""

import pytest
from pyspark.sql import functions as F

from venuegrid.functions import hours, sql

TEXTS = [
    "Mo-Fr 09:00-12:00", "Mo-Fr 09:00-12:00,14:00-18:00; Sa[1,3] 10:00-12:00; Fr off", "Fr-Mo 8:00-9:30; We off; We 10:00-11:00", "closed", " Closed ", "", None, "Mo off; PH off", "ph open; Tu 09:00-10:00",
    "2024 Dec 25 closed; Mo 09:00-10:00", "2024 Dec 25 - 2025 Jan 02 closed", "2024 Foo 25 closed", "Mo 09:00-10:00; 2024 May 01 open \"fête\"; 2024 May 01 closed", "We 11:30-13:30, 16:30-19:40", "Mo, Tu 10:00-12:00",
    "Mo-Fr 09:00-17:00, Su off", "17:00 , Su off", "Mo,We-Fr,Xx 09:00-10:00,bad,24:00-25:00", "Mo[x] 09:00-10:00", "Mo[2,-1] 09:00 - 10:00; Tu closed", "; ;Mo 09:00-10:00;;", "Su-Mo 23:00-02:00", "l'été Mo 10:00-11:00", "Mo-Fr", "Mo 24/7", "a\nMo 09:00-10:00",
]


@pytest.fixture(scope="module")
def texts(spark):
    sql.register(spark)
    spark.createDataFrame([(k, t) for k, t in enumerate(TEXTS)], "k int, t string").createOrReplaceTempView("notations")
    return spark.table("notations")


def test_parse_and_format(spark, texts):
    got = spark.sql("SELECT k, osm_parse(t) AS p, osm_format(osm_parse(t).week) AS f FROM notations")
    want = texts.select("k", hours.parse_osm(F.col("t")).alias("p")).select("k", "p", hours.print_week(F.col("p.week")).alias("f"))
    assert got.orderBy("k").collect() == want.orderBy("k").collect()


def test_differences(spark, texts):
    pairs = spark.sql("SELECT a.k AS i, b.k AS j, a.t AS x, b.t AS y FROM notations a JOIN notations b ON (a.k * 7 + b.k) % 5 = 0")
    pairs.createOrReplaceTempView("notation_pairs")
    got = spark.sql("SELECT i, j, c.* FROM (SELECT i, j, schedule_diff(x, y) AS c FROM notation_pairs)")
    want = pairs.select("i", "j", hours.compare(hours.parse_osm(F.col("x")), hours.parse_osm(F.col("y"))).alias("c")).select("i", "j", "c.*")
    assert got.orderBy("i", "j").collect() == want.orderBy("i", "j").collect()


def test_slots_as_rows(spark, texts):
    got = spark.sql("SELECT k, s.* FROM notations, LATERAL osm_slots(t) AS s").collect()
    typed = texts.select("k", F.posexplode(hours.parse_osm(F.col("t"))["week"]).alias("day", "d"))
    want = typed.select("k", "day", F.element_at(F.array(*map(F.lit, hours.JOURS)), F.col("day") + 1).alias("jour"), F.inline("d.creneaux")).collect()
    assert sorted(got, key=repr) == sorted(want, key=repr) and len(got) > 30


def test_bodies_are_inlined(spark, texts):
    plan = lambda q: spark.sql(q)._jdf.queryExecution().executedPlan().toString()
    inlined = plan("SELECT osm_format(osm_parse(t).week) AS a, schedule_diff(t, t).identical AS b FROM notations")
    assert "EvalPython" not in inlined and "osm_parse" not in inlined and "transform(" in inlined
    assert "ArrowEvalPythonUDTF" in plan("SELECT s.* FROM notations, LATERAL osm_slots(t) AS s")
