"""The store under interrupted writes, sources that fail, and what surrounds a run."""

import json

import pytest
from pyspark.sql import functions as F

from venuegrid.functions import text
from venuegrid.operators import state, stats
from venuegrid.plans import pipeline
from venuegrid.plans.prompt import Texts, prompt
from venuegrid.plans.settings import Settings, chosen
from venuegrid.schema import RESULTS
from venuegrid.sources import csvfiles, providers
from venuegrid.sources.tables import Store


def rows_of(spark, *of):
    """Results (id, execution, status)."""
    kinds = {"id_resultats_extraction": 0, "id_execution": 1, "statut_url": 2}
    made = [tuple(r[kinds[f.name]] if f.name in kinds else None for f in RESULTS) for r in of]
    return spark.createDataFrame(made, RESULTS)


def seen(frame):
    return sorted((r.id_resultats_extraction, r.id_execution, r.statut_url) for r in frame.collect())


def test_a_write_that_dies_leaves_the_table_as_it_was(spark, tmp_path, monkeypatch):
    store, name = Store(spark, str(tmp_path / "db")), "resultats_extraction"
    assert not store.exists(name) and seen(store.read(name)) == []
    store.write(name, rows_of(spark, (1, 1, "ok"), (2, 2, "ok")))
    with monkeypatch.context() as m:
        m.setattr(Store, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost between snapshot and commit")))
        with pytest.raises(RuntimeError):
            store.write(name, rows_of(spark, (9, 9, "x")))
    again = Store(spark, str(tmp_path / "db"))
    assert again.exists(name) and seen(again.read(name)) == [(1, 1, "ok"), (2, 2, "ok")]


def test_only_touched_parts_are_rewritten(spark, tmp_path):
    store, name = Store(spark, str(tmp_path / "db")), "resultats_extraction"
    store.write(name, rows_of(spark, (1, 1, "a"), (2, 2, "b"), (3, 2, "c")))
    before = store._current(name)[1]
    store.rewrite(name, rows_of(spark, (2, 2, "changed"), (3, 3, "moved")), [2, 3])
    after = store._current(name)[1]
    assert before["1"] == after["1"] and before["2"] != after["2"] and set(after) == {"1", "2", "3"}
    assert seen(store.read(name)) == [(1, 1, "a"), (2, 2, "changed"), (3, 3, "moved")] and seen(store.read(name, [2])) == [(2, 2, "changed")]
    store.rewrite(name, rows_of(spark), [1])
    assert seen(store.read(name)) == [(2, 2, "changed"), (3, 3, "moved")]
    assert store.update(name, {"statut_url": "moved", "id_execution": 3}, {"code_http": 404}) == 1 and store.update(name, {"statut_url": None}, {"code_http": 1}) == 0
    assert [r.code_http for r in store.read(name).orderBy("id_execution").collect()] == [None, 404]
    assert store.sql("SELECT count(*) AS n FROM resultats_extraction WHERE id_execution > ?", 2).first().n == 1
    with pytest.raises(FileExistsError):
        store.write(name, rows_of(spark), "fail")


def test_the_newest_commit_is_found_by_few_looks(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path / "db"))
    empty = spark.createDataFrame([], store.read("executions").schema)
    for _ in range(11):
        store.write("executions", empty)
    looks = []
    at = Store._commit_at
    monkeypatch.setattr(Store, "_commit_at", lambda self, name, n: looks.append(n) or at(self, name, n))
    assert Store(spark, store.root)._current("executions")[0] == 11 and len(looks) < 10
    looks.clear()
    assert store._current("executions")[0] == 11 and len(looks) == 2  # one for a newer one, one to read
    Store(spark, store.root).write("executions", empty)
    assert store._current("executions")[0] == 12  # written by another one


def test_lost_commits_are_no_empty_table(spark, tmp_path):
    store = Store(spark, str(tmp_path / "db"))
    store.write("executions", spark.createDataFrame([], store.read("executions").schema))
    store.write("executions", spark.createDataFrame([], store.read("executions").schema))
    (tmp_path / "db" / "executions" / "commits").rename(tmp_path / "elsewhere")
    with pytest.raises(FileNotFoundError):
        store.read("executions")


def test_keys_of_wide_rows_are_gapless(spark):
    wide = spark.range(200_000, numPartitions=7).select(F.sha2(F.col("id").cast("string"), 256).alias("k"), F.repeat(F.lit("x"), 192).alias("wide"))
    got = state.number_from(wide, 10, ["k"], "n").agg(F.min("n"), F.max("n"), F.countDistinct("n")).first()
    assert tuple(got) == (11, 200_010, 200_000)


def test_answers_of_failing_providers():
    def raising(error):
        def provider(url):
            raise error

        return providers.answer(provider, "https://x", tries=2, delay=0)

    import socket

    assert raising(socket.gaierror("x")) == raising(RuntimeError("net::ERR_NAME_NOT_RESOLVED")) == ("erreur", 0, "Domaine non résolu (DNS)", "")
    assert raising(TimeoutError("lent")) == ("warning", 0, "lent", "") and raising(ValueError("x")) == ("critical", 0, "x", "")
    calls = []

    def second(url):
        calls.append(url)
        if len(calls) < 2:
            raise ValueError
        return "ok", 503, "", "<p>"

    assert providers.answer(second, "u", delay=0) == ("warning", 503, "", "<p>") and len(calls) == 2


def test_csv_from_a_url(spark):
    got = csvfiles.read_csv(spark, "https://x/y.csv", get=lambda url: b"a;b\n1;2\n;\n3;4\n")
    assert [tuple(r) for r in got.collect()] == [("1", "2"), ("3", "4")] and got.columns == ["a", "b"]


def test_files_of_documents_and_truths(spark, tmp_path):
    day = {"source_found": True, "ouvert": True, "creneaux": [{"debut": "08:00", "fin": "18:00"}]}
    made = lambda **meta: {"horaires_ouverture": {"metadata": meta, "periodes": {"hors_vacances_scolaires": {"source_found": True, "horaires": {"lundi": day}}}}}
    (tmp_path / "list.json").write_text(json.dumps([made(identifiant="test_id"), made()]))
    (tmp_path / "one.json").write_text(json.dumps(made()))
    got = {r.identifiant: r.osm for r in csvfiles.convert_file(spark, str(tmp_path / "*.json")).collect()}
    assert set(got) == {"test_id", "item_1", "single_item"} and all(o == {"hors_vacances_scolaires": "Mo 08:00-18:00"} for o in got.values())
    (tmp_path / "truth.csv").write_text("url;ground_truth_osm\nhttps://a;Mo 08:00-18:00\nhttps://b;Tu off\n")
    truths = csvfiles.read_evaluation(spark, str(tmp_path / "truth.csv"))
    scored = pipeline.evaluate(truths, spark.createDataFrame([("https://a", "Mo 08:00-18:00")], "url string, osm string"))
    assert sorted((r.url, r.status, r.diff_count) for r in scored.collect()) == [("https://a", "Identique", 1), ("https://b", "Erreur de comparaison", 1)]
    assert stats.evaluation(scored).first().accuracy == 50.0


def test_filtering(spark):
    page = "menu\n\n\n\nMo-Fr 09:00-12:00\nsuite\n\nautre\n\n\n\nfin"
    rows = spark.createDataFrame([(1, page), (2, ""), (3, None), (4, "\n\n"), (5, "court")], "doc_id long, text string")
    phrases = spark.createDataFrame([("mo-fr 09:00-12:00",)], "p string").select(providers.hash_embedding("p").alias("vector"))
    got = {r.doc_id: r.filtered for r in text.filter_pages(rows, phrases, providers.hash_embedding, chunk_size=10, threshold=0.5, least=6).collect()}
    assert got == {1: "\nMo-Fr 09:00-12:00\nsuite\n", 2: "", 3: "", 4: "\n\n", 5: "court"}


def test_chunks_hand_blocks_on(spark):
    got = spark.createDataFrame([([60, 30, 30, 200, 5],), ([],)], "s array<int>").select(text.chunks(F.col("s"), 100, 50)).collect()
    assert [r[0] for r in got] == [[[0, 1], [1, 2], [2, 3], [3, 4]], []]


def test_settings_and_texts(spark):
    assert chosen({"LLM_API_KEY_MISTRAL": "k", "LLM_MODEL_LOCAL": "m"}, "LLM") == "MISTRAL" and chosen({}, "LLM") is None
    good = Settings("https://x/a.csv", {"mairies": "https://x/b.csv"}, "LOCAL", embedding_provider="LOCAL", phrases=["a"])
    assert good.problems() == [] and len(Settings("x", {"m": "y"}, "Z", threshold=3, chunk_overlap=100).problems()) == 7
    rows = [{"section": "urls", "item": "total", "value": 3, "formatted_value": "3"}, {"section": "urls", "item": "success_rate", "value": 66.667, "formatted_value": "66.7%"}]
    assert stats.custom_text("{urls.total} ({urls.success_rate}, {urls.success_rate_value}) {urls.none}", rows) == "3 (66.7%, 66.667) {urls.none}"
    messages = json.loads(spark.range(1).select(prompt(F.lit("mairie"), F.lit(None).cast("string"), F.lit("{year} x"), F.lit(2025), "{}")).first()[0])
    assert [m["role"] for m in messages] == ["system", "user"] and "sans année est de 2025." in messages[0]["content"] and "Établissement : Non renseigné\n" in messages[1]["content"] and "<<<\n{year} x\n>>>" in messages[1]["content"]
    own = Texts(system="{year}!", asked="{name}/{kind}/{text}", with_schema="|{schema}")
    assert [m["content"] for m in json.loads(spark.range(1).select(prompt(F.lit("k"), F.lit("n"), F.lit(None).cast("string"), F.lit(1), "s", own)).first()[0])] == ["1!", "n/k/Aucun contenu disponible|s"]
