"""The report: labels, pages without a cap, the summary; statistics kept up to date by execution; counters of the writing job."""

import pytest
from pyspark.sql import functions as F

from venuegrid.operators import stats
from venuegrid.plans import pipeline, report
from venuegrid.sources.tables import Store
from test_pipeline import make_provider


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    found = Store(spark, str(tmp_path_factory.mktemp("report") / "db"))
    listed = spark.createDataFrame([("mairie", k, f"<{k}>", f"https://{k}") for k in "abcd"], "type_lieu string, identifiant string, nom string, url string")
    refs = spark.createDataFrame([("a", "Mo-Fr 09:00-12:00"), ("b", "Mo-Th 09:00-12:00"), ("c", "Mo 09:00-10:00")], "identifiant string, horaires string")
    pipeline.run(found, listed, refs, make_provider(), "2025-01-02 03:04:05", delay=0.0)
    return found


def test_labels(spark):
    rows = [(None, None, ""), (None, "diff", ""), (None, "diff", "URL: x"), (True, "x", "y"), (False, "lundi: x", "y"), (False, None, None)]
    got = spark.createDataFrame(rows, "same boolean, d string, e string").coalesce(1).select(report.comparison_label(F.col("same"), F.col("d"), F.col("e")).alias("x")).collect()
    assert [r.x for r in got] == ["Non comparé", "diff", "Non comparé - URL: x", "IDENTIQUE - Aucune différence détectée", "DIFFÉRENT - lundi: x", "DIFFÉRENT - "]


def test_every_row_is_on_a_page(spark, store, tmp_path):
    results, venues = store.read(pipeline.RESULTS_TABLE), store.read("lieux")
    many = results.where("lieu_id = 'd'").crossJoin(spark.range(23).select(F.col("id").alias("n"))).withColumn("id_resultats_extraction", F.col("n") + 100).drop("n")
    every = results.unionByName(many)
    folder = str(tmp_path / "report")
    summary = report.write_report(every, venues, folder, size=5)
    pages = report.pages(report.rows(every, venues), 5).collect()
    assert sum(r.n for r in pages) == 27 and max(r.n for r in pages) == 5 and {r.pages for r in pages if r.status == "access_error"} == {5}
    html = "".join(r.html for r in pages)
    assert html.count("<tr><td>d</td><td>&lt;d&gt;</td>") == 24 and "<a>" not in html
    written = spark.read.option("basePath", folder).text(folder)
    assert written.where("value LIKE '<tr><td>%'").count() == 27
    assert "5 pages</a>" in summary and "Types de lieu" in summary and "mairie" in summary and "404" in summary


def test_statistics_by_execution_add_up(spark, store):
    results = store.read(pipeline.RESULTS_TABLE)
    full = stats.sections(store.read("executions"), results, "now")
    kept = pipeline.report_stats(store, "now")
    assert sorted(map(tuple, kept.collect()), key=str) == sorted(map(tuple, full.collect()), key=str)


def test_only_touched_parts_are_recomputed(spark, store, monkeypatch):
    results = store.read(pipeline.RESULTS_TABLE)
    other = results.withColumn("id_execution", F.lit(7).cast("long")).withColumn("id_resultats_extraction", F.col("id_resultats_extraction") + 500)
    store.rewrite(pipeline.RESULTS_TABLE, other, [7])
    asked = []
    read = Store.read
    monkeypatch.setattr(Store, "read", lambda self, name, parts=None: asked.append((name, parts)) or read(self, name, parts))
    before = store._current(pipeline.STATS_TABLE)[1]
    pipeline.refresh_stats(store, [7])
    after = store._current(pipeline.STATS_TABLE)[1]
    assert asked == [(pipeline.RESULTS_TABLE, [7])] and before["1"] == after["1"] and set(after) == {"1", "7"}
    monkeypatch.undo()
    full = stats.sections(store.read("executions"), store.read(pipeline.RESULTS_TABLE), "now")
    assert sorted(map(tuple, pipeline.report_stats(store, "now").collect()), key=str) == sorted(map(tuple, full.collect()), key=str)
    store.rewrite(pipeline.RESULTS_TABLE, other.limit(0), [7])
    pipeline.refresh_stats(store, [7])
    assert set(store._current(pipeline.STATS_TABLE)[1]) == {"1"}


def test_counters_come_from_the_job_that_writes(spark, tmp_path):
    store = Store(spark, str(tmp_path / "db"))
    listed = spark.createDataFrame([("mairie", k, k, f"https://{k}") for k in "abcd"], "type_lieu string, identifiant string, nom string, url string")
    execution = pipeline.setup(store, listed, spark.createDataFrame([], "identifiant string, horaires string"), "2025-01-02 03:04:05")
    pages = {"https://a": ("ok", 200, "", "<p>«é» *x* – y</p>"), "https://b": ("ok", 200, "", "<p>---</p>"), "https://c": ("ok", 200, "", "<p>rien</p>"), "https://d": ("erreur", 404, "introuvable", "")}
    assert pipeline.fetch_pages(store, execution, lambda url: pages[url], delay=0.0) == {"asked": 4, "failed": 1}
    assert pipeline.clean_pages(store) == {"texts_processed": 3, "texts_successful": 2, "chars_replaced": 5}
    assert pipeline.clean_pages(store)["texts_processed"] <= 1  # what is cleaned to nothing is still due


def test_calendars_are_bounded(spark):
    days = spark.range(400).select(F.date_format(F.date_add(F.lit("2025-01-01").cast("date"), F.col("id").cast("int")), "yyyy-MM-dd").alias("day"), F.lit("x").alias("name"))
    with pytest.raises(ValueError):
        pipeline._calendar(days)
    twice = spark.createDataFrame([("2025-01-01", "b"), ("2025-01-01", "a"), ("2025-05-01", "c")], "day string, name string")  # two zones in one calendar
    assert spark.range(1).select(pipeline._calendar(twice).alias("m")).first().m == {"2025-01-01": "a", "2025-05-01": "c"}
