"""State machine, statistics, sources and the streaming stage."""

import pytest
from pyspark.sql import functions as F

from venuegrid.operators import state, stats
from venuegrid.schema import RESULTS
from venuegrid.sources import csvfiles, providers
from venuegrid.sources.tables import Store
from venuegrid.streaming.incremental import absorb, clean_stream, cleaned


def result(k, **values):
    base = {f.name: None for f in RESULTS} | {"id_resultats_extraction": k, "lieu_id": "v", "id_execution": 1, "statut_url": "", "code_http": 0}
    base |= {c: "" for c in ("markdown_brut", "markdown_nettoye", "markdown_filtre", "llm_horaires_json", "llm_horaires_osm", "erreurs_pipeline")}
    return tuple((base | values)[f.name] for f in RESULTS)


@pytest.fixture
def rows(spark):
    return spark.createDataFrame(
        [
            result(1),
            result(2, statut_url="ok", markdown_brut="raw"),
            result(3, statut_url="ok", markdown_brut="raw", markdown_nettoye="c"),
            result(4, statut_url="ok", markdown_brut="raw", markdown_nettoye="c", markdown_filtre="f"),
            result(5, statut_url="ok", markdown_filtre="f", llm_horaires_json="{}", llm_horaires_osm="x"),
            result(6, statut_url="ok", markdown_filtre="f", llm_horaires_json="erreur llm: x", llm_horaires_osm="y"),
            result(7, statut_url="ok", llm_horaires_json="{}", llm_horaires_osm="x", horaires_identiques=True, code_http=200),
            result(8, statut_url=None),
        ],
        RESULTS,
    )


def test_pending(spark, rows):
    venues = spark.createDataFrame([("v", "n")], "identifiant string, nom string")
    ids = lambda df: sorted(r[0] for r in df.select(state.ID).collect())
    assert ids(state.pending_urls(rows, venues, F.lit(1))) == [1]
    assert ids(state.pending_cleaning(rows, F.lit(1))) == [2]
    assert ids(state.pending_filtering(rows, F.lit(1))) == [3]
    assert ids(state.pending_extraction(rows, venues, F.lit(1))) == [4]
    assert ids(state.pending_comparison(rows, venues)) == [5]
    moved = state.reassign(rows, F.lit(2).cast("long")).where("id_execution = 2")
    assert ids(moved) == [1, 2, 3, 4]


def test_upsert(spark):
    stored = spark.createDataFrame([(1, "old", "kept"), (2, "b", "kept")], "k int, x string, y string")
    batch = spark.createDataFrame([(1, "x", 1), (1, None, 2), (3, "z", 1)], "k int, x string, pos int")
    got = {r.k: (r.x, r.y) for r in state.upsert(stored, batch, "k", "pos", ["x"]).collect()}
    assert got == {1: (None, "kept"), 2: ("b", "kept"), 3: ("z", None)}


def test_errors(spark):
    df = spark.createDataFrame([("e1 | e2 | e3",), ("e1 | e2",), ("e1",), ("",), (None,)], "c string")
    assert [tuple(r[0]) for r in df.select(state.error_summary(F.col("c"))).collect()] == [(3, "e1 (et 2 autres)"), (2, "e1 (et 1 autre)"), (1, "e1"), (0, ""), (0, "")]
    stamp = F.lit("2025-01-01 10:11:12").cast("timestamp")
    twice = state.add_error(state.add_error(F.lit(""), "URL", F.lit("boom"), stamp), "URL", F.lit("boom"), stamp)
    assert spark.range(1).select(twice).first()[0] == "[10:11:12] URL: boom"


def test_keys_of_many_partitions(spark):
    """More rows than range boundaries are sampled from, in several partitions: no key twice, no gap, in order."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        rows = spark.range(200_000).select(F.xxhash64("id").alias("v"))
        got = state.number_from(rows, 100, ["v"], "k").toPandas().sort_values("v")["k"].tolist()
    finally:
        spark.conf.set(name, before)
    assert got == list(range(101, 200_101))


def test_status(spark):
    df = spark.createDataFrame(
        [(False, "erreur", 0, "", ""), (True, "ok", 200, "", ""), (None, "ok", 404, "x", "x"), (None, "ok", 200, "Erreur", "x"), (None, "ok", 200, "x", "x")],
        "horaires_identiques boolean, statut_url string, code_http int, llm_horaires_osm string, horaires_data_gl string",
    )
    assert [r[0] for r in df.select(stats.report_status()).collect()] == ["schedule_diff", "success", "access_error", "extraction_error", "compare_error"]


def test_stats_on_empty(spark, rows):
    none = rows.where("false")
    assert stats.url_stats(none).first()["success_rate"] == 0.0
    assert stats.comparison_stats(rows).first().asDict() == {"total": 8, "identical": 1, "different": 0, "not_compared": 7, "accuracy_rate": 100.0}
    assert stats.formatted(None) == "N/A" and stats.formatted(2.5, 0) == "2"


def test_csv(spark, tmp_path):
    def file(name, body):
        (tmp_path / name).write_text(body)
        return str(tmp_path / name)

    assert csvfiles.read_csv(spark, file("a.csv", "col1,col2,col3\n1,a,x\n2,b,y\n3,c,z\n"), ",").count() == 3
    auto = csvfiles.read_csv(spark, file("b.csv", "col1;col2;col3\n1;a;x\n2;b;y\n"))
    assert auto.columns == ["col1", "col2", "col3"] and auto.count() == 2
    assert csvfiles.read_csv(spark, file("c.csv", "1,a,x\n2,b,y\n"), ",", header=False).columns == ["column_1", "column_2", "column_3"]
    assert csvfiles.read_csv(spark, file("d.csv", "")).columns == []
    with pytest.raises(FileNotFoundError):
        csvfiles.read_csv(spark, str(tmp_path / "none.csv"))
    with pytest.raises(ValueError):
        csvfiles.read_csv(spark, " ")


@pytest.mark.parametrize(
    ("html", "wanted"),
    [
        ("<h1>Titre</h1><p>Ceci est un paragraphe.</p>", "Titre\n\nCeci est un paragraphe."),
        ('<p>Visitez <a href="https://www.example.com">notre site</a>.</p>', "Visitez notre site."),
        ("", ""),
        (None, ""),
        ("<div><p><span>Texte</span> important.</p></div>", "Texte important."),
        ("<p>Caractères spéciaux : & < ></p>", "Caractères spéciaux : & < >"),
        ("<head><title>x</title></head><p>a</p><script>b</script>", "a"),
    ],
)
def test_html(spark, html, wanted):
    assert spark.createDataFrame([(html,)], "h string").select(providers.html_to_text("h")).first()[0] == wanted


def test_fetch(spark):
    urls = spark.createDataFrame([("",), (None,), ("ftp://a",), ("https://a",)], "url string")
    got = providers.fetch(urls, lambda u: ("ok", 200, "", "<p>x</p>")).collect()
    assert sorted((r.statut_url, r.code_http, r.message_url) for r in got) == [("erreur", 0, "Format d'URL invalide")] + [("erreur", 0, "URL non fournie")] * 2 + [("ok", 200, "")]


def test_store_and_stream(spark, tmp_path, rows):
    store = Store(spark, str(tmp_path / "db"))
    assert not store.exists("lieux") and store.read("lieux").count() == 0
    rows.write.parquet(str(tmp_path / "in"))
    for _ in range(2):
        arrivals = spark.readStream.schema(RESULTS).parquet(str(tmp_path / "in"))
        clean_stream(arrivals, store, str(tmp_path / "ck")).awaitTermination(60)
    assert absorb(store) == rows.select("id_execution").distinct().count() and absorb(store) == 0
    got = {r[state.ID]: r.markdown_nettoye for r in store.read("resultats_extraction").collect()}
    assert len(got) == 8 and got[2] == "raw" and got[1] == ""
    assert cleaned(store.read("resultats_extraction")).count() == 0
    with pytest.raises(FileExistsError):
        store.write("resultats_extraction", rows, "fail")
    store.write("resultats_extraction", rows.limit(1), "skip")
    assert store.read("resultats_extraction").count() == 8
    assert store.sql("SELECT count(*) AS n FROM resultats_extraction WHERE id_execution = :e", e=1).first()["n"] == 8
