"""The venue pipeline end to end, schedule documents and calendars."""

import json

from pyspark.sql import functions as F

from venuegrid.functions import documents, hours
from venuegrid.plans import pipeline, report
from venuegrid.sources import calendars
from venuegrid.sources.tables import Store

PAGES = {
    "https://a": ("ok", 200, "", "<p>Bienvenue</p><p>Mo-Fr 09:00-12:00</p>"),
    "https://b": ("ok", 200, "", "<p>Mo-Fr 09:00-12:00</p>"),
    "https://c": ("ok", 200, "", "<p>rien</p>"),
    "https://d": ("erreur", 404, "introuvable", ""),
}


def make_provider():
    return lambda url: PAGES[url]  # a nested function travels to the workers by value


def test_run_twice(spark, tmp_path):
    store, provider = Store(spark, str(tmp_path / "db")), make_provider()
    listed = spark.createDataFrame([("mairie", k, k.upper(), f"https://{k}") for k in "abcd"], "type_lieu string, identifiant string, nom string, url string")
    refs = spark.createDataFrame([("a", "Mo-Fr 09:00-12:00"), ("b", "Mo-Th 09:00-12:00"), ("c", "Mo 09:00-10:00")], "identifiant string, horaires string")
    assert pipeline.run(store, listed, refs, provider, "2025-01-02 03:04:05") == 1
    first = {r.lieu_id: r for r in store.read(pipeline.RESULTS_TABLE).collect()}
    assert first["a"].horaires_identiques is True and first["b"].horaires_identiques is False
    assert first["b"].differences_horaires == "HORS_VACANCES_SCOLAIRES: vendredi: fermé → ouvert | créneaux: ajoutés: 09:00-12:00"
    assert first["c"].horaires_identiques is None and first["d"].statut_url == "erreur" and "introuvable" in first["d"].erreurs_pipeline
    assert sorted(r.id_resultats_extraction for r in first.values()) == [1, 2, 3, 4]
    assert pipeline.run(store, listed, refs, provider, "2025-01-03 03:04:05") == 2
    again = {r.lieu_id: r for r in store.read(pipeline.RESULTS_TABLE).collect()}
    assert len(again) == 4 and again["a"] == first["a"] and again["d"].id_execution == 2
    page = report.render(store.read(pipeline.RESULTS_TABLE), store.read("lieux"))
    assert "Succès" in page and "25.0 %" in page


def document(**periods):
    return json.dumps({"horaires_ouverture": {"periodes": periods}})


def day(*slots, **more):
    return {"source_found": True, "ouvert": bool(slots), "creneaux": [dict(zip(("debut", "fin"), s.split("-"), strict=True)) | more for s in slots]}


def test_documents(spark):
    said = lambda d: spark.createDataFrame([(d,)], "d string").select(documents.print_document(F.col("d"))).first()[0]
    weekly = lambda **days: {"source_found": True, "horaires": days}
    assert said(document(hors_vacances_scolaires=weekly(lundi=day("09:00-12:00"), mardi=day("09:00-12:00"), mercredi=day()))) == "hors_vacances_scolaires: Mo-Tu 09:00-12:00; We off"
    assert said(document(hors_vacances_scolaires=weekly(lundi=day("10:00-12:00", occurence=[1, 3])))) == "hors_vacances_scolaires: Mo[1,3] 10:00-12:00"
    assert said(document(hors_vacances_scolaires=weekly(lundi=day("10:00-12:00", occurence=2)))) == "hors_vacances_scolaires: Mo[2] 10:00-12:00"
    assert said(document(jours_feries={"source_found": True, "mode": "ferme"})) == "jours_feries: PH off"
    assert said(document(jours_speciaux={"source_found": True, "horaires_specifiques": {"2023-12-25": {"ouvert": False}}})) == "jours_speciaux: 2023 Dec 25 off"
    assert said(document(hors_vacances_scolaires=weekly(**{j: day() for j in hours.JOURS}))) == "off"
    assert said("Erreur LLM: x") == "" and said(None) == "" and said("{") == "Erreur Conversion OSM: JSON invalide"


def test_guards(spark):
    rows = [(None, "{}"), ("Erreur conversion: x", "{}"), ("{", "{}"), ("{}", " "), ("{}", "{"), ("{}", '{"extraction_info": {"source_found": false}}'), ("{}", "{}")]
    got = [r[0] for r in spark.createDataFrame(rows, "a string, b string").select(documents.comparison_problem(F.col("a"), F.col("b"))).collect()]
    assert got == [documents.NO_REFERENCE, "Erreur dans les données GL: Erreur conversion: x", "Erreur parsing JSON data.grandlyon.com", documents.NO_EXTRACT, "Erreur parsing JSON LLM", f"Comparaison impossible: {documents.NO_SOURCE}", None]


def test_special_days(spark):
    dates = F.create_map(F.lit("2025-01-01"), F.lit("ouvert"), F.lit("2025-06-01"), F.lit("ferme"), F.lit("Th"), F.lit("x"))
    kept = documents.future_only(dates, F.lit("2025-01-01").cast("date"))
    more = documents.with_holidays(kept, F.create_map(F.lit("2025-06-01"), F.lit("a"), F.lit("2025-07-14"), F.lit("b")), F.lit("Mairie"))
    assert spark.range(1).select(kept, more).first()[:] == ({"2025-06-01": "ferme"}, {"2025-07-14": "ferme", "2025-06-01": "ferme"})


def test_calendars(spark, tmp_path):
    (tmp_path / "h.json").write_text('{"2025-01-01": "1er janvier",\n"2025-05-01": "Fête du travail"}')
    assert calendars.holidays(spark, str(tmp_path / "h.json")).count() == 2
    made = {"results": [{"description": "Noël", "start_date": "2023-12-23T00:00:00+01:00", "end_date": "2024-01-08T00:00:00+01:00", "location": "Lyon", "zones": "Zone A", "annee_scolaire": "2023-2024"}, {"description": "x", "start_date": "2020-01-01", "end_date": "2020-01-02", "location": "Lyon", "zones": "Zone A"}]}
    (tmp_path / "s.json").write_text(json.dumps(made))
    got = calendars.school_holidays(spark, str(tmp_path / "s.json"), "2023-01-01", "2025-12-31", location="Lyon", zone="Zone A", year="2023-2024").collect()
    assert [r.description for r in got] == ["Noël"]
