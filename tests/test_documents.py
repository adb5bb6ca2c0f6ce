"""The five-period document: made from OSM text, printed, compared, scored, and refreshed after an extraction."""

import json

import pytest
from pyspark.sql import functions as F

from venuegrid.functions import documents, hours

NONE = {"source_found": False, "ouvert": False, "creneaux": []}


@pytest.fixture(scope="module")
def one(spark):
    return spark.range(1)


def value(one, column):
    return one.select(column.alias("x")).first()[0]


def made(one, osm, metadata=None):
    return json.loads(value(one, documents.document(F.lit(osm), metadata)))["horaires_ouverture"]


def test_document_of_a_week(one):
    got = made(one, "Mo-Fr 09:00-17:00; Sa 10:00-14:00; PH off")
    week = got["periodes"]["hors_vacances_scolaires"]
    assert (week["source_found"], week["label"], week["condition"]) == (True, "Période hors vacances scolaires", "default")
    assert week["horaires"]["lundi"] == {"source_found": True, "ouvert": True, "creneaux": [{"debut": "09:00", "fin": "17:00"}]}
    assert week["horaires"]["samedi"]["creneaux"] == [{"debut": "10:00", "fin": "14:00"}] and week["horaires"]["dimanche"] == NONE
    for name in ("vacances_scolaires_ete", "petites_vacances_scolaires"):
        assert got["periodes"][name]["source_found"] is False and set(map(json.dumps, got["periodes"][name]["horaires"].values())) == {json.dumps(NONE)}
    holidays = got["periodes"]["jours_feries"]
    assert (holidays["source_found"], holidays["mode"], holidays["horaires_specifiques"]) == (True, "ferme", {})
    assert list(got["periodes"]) == ["hors_vacances_scolaires", "vacances_scolaires_ete", "petites_vacances_scolaires", "jours_feries", "jours_speciaux"]
    assert got["extraction_info"] == {"source_found": True, "permanently_closed": False, "notes": "Converti depuis format OSM"}
    assert got["metadata"] == documents.CONVERTED


def test_document_edges(one):
    got = made(one, "Mo[1,3] 10:00-12:00; 2024 Dec 25 closed; ph open", F.struct(F.lit("x1").alias("identifiant")))
    assert got["metadata"] == {"identifiant": "x1"}
    assert got["periodes"]["hors_vacances_scolaires"]["horaires"]["lundi"]["creneaux"] == [{"debut": "10:00", "fin": "12:00", "occurence": [1, 3]}]
    assert got["periodes"]["jours_feries"]["horaires_specifiques"] == {"2024-12-25": "ferme"} and got["periodes"]["jours_feries"]["mode"] == "ouvert"
    shut = made(one, " Closed ")
    assert shut["extraction_info"]["permanently_closed"] and all(d == {"source_found": True, "ouvert": False, "creneaux": []} for d in shut["periodes"]["hors_vacances_scolaires"]["horaires"].values())
    assert value(one, documents.document(F.lit(""))) is None and value(one, documents.document(F.lit(None).cast("string"))) is None


def test_printing_a_document_again(one):
    text = "Mo-We 08:30-12:00; Th[2] 14:00-18:00; Sa off"
    doc = documents.document(F.lit(text))
    assert value(one, documents.to_osm(doc)) == {"hors_vacances_scolaires": text}
    assert value(one, documents.to_osm(documents.document(F.lit("Mo-Su off; PH off")))) == {"hors_vacances_scolaires": "off", "jours_feries": "PH off"}
    assert value(one, documents.to_osm(documents.document(F.lit("closed")))) == {"general": "off"}
    assert value(one, documents.to_osm(F.lit("no json"))) == {}


def doc(**periods):
    return F.lit(json.dumps({"horaires_ouverture": {"periodes": periods}}, ensure_ascii=False))


def weekly(found=True, **days):
    return {"source_found": found, "horaires": days}


def day(*slots, ouvert=True):
    return {"source_found": True, "ouvert": ouvert, "creneaux": [dict(zip(("debut", "fin", "occurence"), s, strict=False)) for s in slots]}


def dates(**found):
    return {"source_found": True, "horaires_specifiques": {k.replace("d", "").replace("_", "-"): v for k, v in found.items()}}


def test_comparison_of_periods(one):
    a = doc(hors_vacances_scolaires=weekly(Lundi=day(("09:00", "12:00")), mardi=day(("09:00", "12:00", 1))), autre=weekly(jeudi=day(("10:00", "11:00"))), jours_feries=dates(d2025_12_25="ferme", d2025_12_26="ferme", d2026_01_01=day(("10:00", "12:00"))))
    b = doc(hors_vacances_scolaires=weekly(lundi=day(("09:00", "12:00"), ("14:00", "18:00")), mardi=day(("09:00", "12:00", [1]))), jours_speciaux=dates(d2025_12_26="ouvert", d2026_01_01=day(("10:00", "13:00")), d2026_05_01=day(("08:00", "09:00")), d2026_05_02="ferme"))
    got = value(one, documents.compare(a, b))
    assert not got["identical"]
    assert got["differences"].split("\n") == [
        "JOURS SPÉCIAUX ET FÉRIÉS: 2025-12-25: supprimé () | 2025-12-26: ferme → ouvert | 2026-01-01: créneaux: ajoutés: 10:00-13:00 | supprimés: 10:00-12:00 | 2026-05-01: ajouté (fermé → ouvert | créneaux: ajoutés: 08:00-09:00) | 2026-05-02: ajouté ()",
        "AUTRE: jeudi: ouvert → fermé | créneaux: supprimés: 10:00-11:00",
        "HORS_VACANCES_SCOLAIRES: lundi: créneaux: ajoutés: 14:00-18:00",
    ]
    same = value(one, documents.compare(a, a))
    assert same["identical"] and same["differences"] == hours.SAME


def test_comparison_of_closed_venues(one):
    shut, open_ = doc(hors_vacances_scolaires=weekly(lundi=day(ouvert=False))), doc(hors_vacances_scolaires=weekly(lundi=day(("09:00", "12:00"))))
    nothing = doc(hors_vacances_scolaires=weekly(found=False, lundi=day(("09:00", "12:00"))))
    assert value(one, documents.compare(shut, shut))["identical"]
    assert value(one, documents.compare(shut, open_))["differences"].split("\n")[0] == hours.ATTENTION_1
    assert value(one, documents.compare(open_, shut))["differences"].split("\n")[0] == hours.ATTENTION_2
    assert [value(one, documents.permanently_closed(d)) for d in (shut, open_, nothing, F.lit("{}"))] == [True, False, False, False]
    word_or_closed = doc(jours_feries=dates(d2026_01_01="ferme")), doc(jours_feries=dates(d2026_01_01=day(ouvert=False)))
    assert value(one, documents.compare(*word_or_closed))["identical"]


def test_scores(spark):
    cases = [
        ("Mo-Fr 09:00-12:00", "Mo,Tu,We,Th,Fr 09:00-12:00", ("Identique", 1, hours.SAME)),
        ("Mo 09:00-12:00,14:00-18:00", "Mo 09:00-12:00; Tu 10:00-11:00", ("Différent", 3, "HORS_VACANCES_SCOLAIRES: lundi: créneaux: ajoutés: 14:00-18:00 | mardi: ouvert → fermé | créneaux: supprimés: 10:00-11:00")),
        ("", None, ("Identique", 0, "")), ("Mo 09:00-12:00", "", ("Erreur de comparaison", 1, documents.NOT_CONVERTED)), ("closed", "Mo off", ("Identique", 1, hours.SAME)),
    ]
    rows = spark.createDataFrame([c[:2] for c in cases], "p string, t string").coalesce(1).select(documents.score(F.col("p"), F.col("t")).alias("s"))
    assert [tuple(r.s) for r in rows.collect()] == [c[2] for c in cases]


def test_sources_in_a_period(one):
    has = lambda p: value(one, documents.has_source(F.lit(json.dumps(p))))
    assert has({"source_found": True}) and not has({}) and not has(weekly(found=False, lundi=day()))
    assert has(weekly(lundi={"ouvert": True})) and not has(weekly(lundi={"source_found": False})) and not has(weekly())
    assert has(dates(d2026_01_01="ferme")) and not has(dates()) and not has({"source_found": True, "horaires_specifiques": {"2026-01-01": {"source_found": False}}})


def test_refreshing_special_dates(one):
    today, none = F.lit("2025-06-15").cast("date"), F.from_json(F.lit("{}"), "map<string,string>")
    coming = documents.holiday_dates(*(F.from_json(F.lit(json.dumps(m)), "map<string,string>") for m in ({"2025-05-01": "Fête", "2025-07-14": "Fête nationale"}, {"2026-01-01": "Jour de l'an"})), today)
    assert value(one, coming) == {"2025-07-14": "Fête nationale", "2026-01-01": "Jour de l'an"}
    source = {"note": 'a "b" é', "horaires_ouverture": {"metadata": {"n": 1.5, "vrai": True, "rien": None}, "periodes": {"hors_vacances_scolaires": weekly(lundi=day(("09:00", "12:00"))), "jours_speciaux": dates(d2025_06_15="ferme", d2025_06_16=day(("10:00", "12:00")), d2030_01_01="ferme")}}}
    fresh = lambda text, kind, holidays: json.loads(value(one, documents.refreshed(F.lit(text), F.lit(kind), holidays, today)))
    left = fresh(json.dumps(source), "Piscine", coming)
    source["horaires_ouverture"]["periodes"]["jours_speciaux"]["horaires_specifiques"].pop("2025-06-15")
    assert left == source
    town_hall = fresh(json.dumps(source), "Mairie", coming)
    added = town_hall["horaires_ouverture"]["periodes"].pop("jours_feries")
    assert town_hall == source and added["horaires_specifiques"] == {"2025-07-14": "ferme", "2026-01-01": "ferme"} and added["mode"] == "ferme"
    source["horaires_ouverture"]["periodes"]["jours_feries"] = {"source_found": False, "horaires_specifiques": {"2026-01-01": "ouvert"}}
    assert fresh(json.dumps(source), "mairie", coming)["horaires_ouverture"]["periodes"]["jours_feries"] == {"source_found": False, "horaires_specifiques": {"2025-07-14": "ferme", "2026-01-01": "ouvert"}}
    assert fresh("", "mairie", coming) == fresh("no json", "mairie", coming) == {}
    assert fresh("{}", "piscine", none) == {}


def test_extraction_outcomes(one):
    today, none = F.lit("2025-06-15").cast("date"), F.from_json(F.lit("{}"), "map<string,string>")

    def outcome(content, failure=None):
        return value(one, documents.outcome(F.lit(content).cast("string"), F.lit(failure).cast("string"), F.lit("parc"), none, today))

    assert tuple(outcome("x", "délai dépassé")) == ("Erreur LLM: délai dépassé",) * 2
    assert tuple(outcome(None)) == ("Erreur LLM: reçu 'None' - réponse vide",) * 2 and tuple(outcome("")) == ("Erreur LLM: reçu '' - réponse inattendue",) * 2
    assert tuple(outcome("Erreur quota")) == ("Erreur quota",) * 2
    assert tuple(outcome("not json")) == ("{}", "")
    good = outcome(value(one, documents.document(F.lit("Mo 09:00-12:00"))))
    assert good.osm == "hors_vacances_scolaires: Mo 09:00-12:00" and json.loads(good.json)["horaires_ouverture"]
    stamp, res = F.lit("2025-01-01 10:11:12").cast("timestamp"), lambda j, o: F.struct(F.lit(j).alias("json"), F.lit(o).alias("osm"))
    errors = lambda j, o: value(one, documents.outcome_errors(F.lit(""), res(j, o), stamp))
    assert errors("Erreur a", "Erreur a") == "[10:11:12] LLM: Erreur a" and errors("Erreur a", "Erreur b") == "[10:11:12] LLM: Erreur a | [10:11:12] OSM: Erreur b"
    assert errors("{}", "Mo 09:00-12:00") == "" and errors("{}", "Erreur c") == "[10:11:12] OSM: Erreur c"


def test_sorted_slots(one):
    text = json.dumps({"source_found": True, "ouvert": True, "creneaux": [{"debut": "14:00", "fin": "15:00"}, {"debut": "09:00", "fin": "10:00", "occurence": [3, 1]}, {"debut": "09:00", "fin": "11:00"}]})
    got = value(one, hours.sorted_slots(documents._day(F.lit(text))))
    assert [(s.debut, s.fin) for s in got] == [("09:00", "11:00"), ("09:00", "10:00"), ("14:00", "15:00")]
