"""Opening-hours parsing, printing and differences against hand-derived values."""

import pytest
from pyspark.sql import functions as F

from venuegrid.functions import hours


def values(spark, f, given):
    """f applied to each text, in one query."""
    rows = spark.createDataFrame(list(enumerate(given)), "i int, t string").select("i", f(F.col("t")).alias("x")).collect()
    return [r.x for r in sorted(rows)]


def parse(spark, *texts):
    return values(spark, hours.parse_osm, texts)


def slots(day):
    return [f"{s['debut']}-{s['fin']}" for s in day["creneaux"]]


WEEKS = [
    ("Mo-Fr 09:00-17:00; Sa 10:00-14:00", {0: ["09:00-17:00"], 1: ["09:00-17:00"], 2: ["09:00-17:00"], 3: ["09:00-17:00"], 4: ["09:00-17:00"], 5: ["10:00-14:00"]}),
    ("Sa-Mo 09:00-10:00", {5: ["09:00-10:00"], 6: ["09:00-10:00"], 0: ["09:00-10:00"]}),
    ("We 11:30-13:30, 16:30-19:40", {2: ["11:30-13:30"]}),
    ("Mo, Tu 10:00-12:00", {1: ["10:00-12:00"]}),
    ("Mo 09:00-12:00, 2025 Jul 05-2025 Aug 31 Mo 10:00-18:00", {}),
    ("Mo 08:00-10:00,14:00-15:00; Mo 20:00-21:00", {0: ["08:00-10:00", "14:00-15:00", "20:00-21:00"]}),
    ("Mo 08:00-10:00; Mo off", {}),
    ("", {}),
    (None, {}),
]


def test_parse_week(spark):
    for (text, open_days), s in zip(WEEKS, parse(spark, *(t for t, _ in WEEKS)), strict=True):
        assert {k: slots(d) for k, d in enumerate(s["week"]) if d["ouvert"]} == open_days, text


def test_parse_closed_and_special(spark):
    comma, both, dated, closed, off, ph, ph_open, nth = parse(spark, "Mo-Fr 09:00-17:00, Su off", "Mo-Fr 09:00-17:00; Sa-Su closed", "2024 Dec 25 closed", "closed", "Mo off", "Mo-Fr 08:00-18:00; PH off", "PH open", "Mo[1,3] 10:00-12:00")
    week = comma["week"]
    assert week[6]["source_found"] and not week[6]["ouvert"] and not week[5]["source_found"]
    assert [d["ouvert"] for d in week] == [True] * 5 + [False] * 2
    assert [d["source_found"] for d in both["week"]] == [True] * 7
    assert [(x["date"], x["status"]) for x in dated["special"]] == [("2024-12-25", "ferme")]
    assert closed["closed"] and not off["closed"]
    assert ph["ph_found"] and ph["ph_mode"] == "ferme" and slots(ph["week"][0]) == ["08:00-18:00"]
    assert ph_open["ph_mode"] == "ouvert" and nth["week"][0]["creneaux"][0]["occurence"] == [1, 3]


@pytest.mark.parametrize(("days", "said"), [([0, 1, 2], "Mo-We"), ([0, 2, 4], "Mo,We,Fr"), ([0, 1, 3, 4], "Mo-Tu,Th-Fr"), ([], ""), ([6, 0, 6], "Mo,Su")])
def test_compress(spark, days, said):
    assert spark.range(1).select(hours.compress_days(F.array(*map(F.lit, days)).cast("array<int>"))).first()[0] == said


PRINTED = {
    "Mo-Tu 09:00-12:00; We off": "Mo-Tu 09:00-12:00; We off",
    "Mo[1,3] 10:00-12:00": "Mo[1,3] 10:00-12:00",
    "Mo-Su off": "off",
    "": None,
    "Mo-Fr 08:00-12:00,14:00-18:00; Sa 08:00-12:00": "Mo-Sa 08:00-12:00; Mo-Fr 14:00-18:00",
}


def test_print(spark):
    assert values(spark, lambda t: hours.print_week(hours.parse_osm(t)["week"]), PRINTED) == list(PRINTED.values())


def test_dates_and_times(spark):
    assert values(spark, hours.print_date, ["25 decembre 2023", "1er janvier 2024", "2024-03-15", "invalid date"]) == ["2023 Dec 25", "2024 Jan 01", "2024 Mar 15", None]
    assert values(spark, hours.valid_time, ["09:00", "9:00", "25:00", "23:59"]) == [True, False, False, True]


def test_compare(spark):
    pairs = [
        ("Mo 09:00-12:00", "Mo 09:00-12:00"),
        ("Mo 09:00-12:00; Tu 08:00-09:00", "Mo 09:00-12:00,14:00-18:00; Tu 08:00-09:00"),
        ("Mo 09:00-12:00; Tu 08:00-09:00", "Mo off; Tu 08:00-09:00"),
        ("closed", "Mo off"),
        ("closed", "Mo 09:00-12:00"),
        ("Mo 09:00-12:00", "Mo 09:00-12:00; 2025 Dec 25 closed"),
    ]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a string, b string")
    got = [r.c for r in sorted(df.select("i", hours.compare(hours.parse_osm(F.col("a")), hours.parse_osm(F.col("b"))).alias("c")).collect())]
    assert tuple(got[0]) == tuple(got[3]) == (True, hours.SAME)
    assert tuple(got[1]) == (False, "HORS_VACANCES_SCOLAIRES: lundi: créneaux: ajoutés: 14:00-18:00")
    assert got[2]["differences"] == "HORS_VACANCES_SCOLAIRES: lundi: ouvert → fermé | créneaux: supprimés: 09:00-12:00"
    assert got[4]["differences"].startswith(hours.ATTENTION_1)
    assert got[5]["differences"] == f"{hours.SPECIAL}: 2025-12-25: ajouté ()"


def test_atomic(spark):
    given = ["", "lundi: ouvert → fermé | créneaux: supprimés: 09:00-12:00", "a\nb", "ajoutés: 1-2, 3-4 | supprimés: 5-6"]
    assert values(spark, hours.atomic_differences, given) == [0, 2, 2, 3]


AUGUST = "2025-08-31"
DATES = {
    "25 decembre 2023": "2023 Dec 25", "1er janvier 2024": "2024 Jan 01", "2024-03-15": "2024 Mar 15", "invalid date": None, "2024-3-5": "2024 Mar 05", "2024/03/15": "2024 Mar 15",
    "fév. 2024": "2024 Feb 29", "12 fév. 2024": "2024 Feb 12", "14 juil": "2025 Jul 14", "May 5": "2025 May 05", "5 May 24": "2024 May 05", "May 5, 96": "1996 May 05", "May 24": "2025 May 24", "May 2024": "2024 May 31",
    "sept 2024": "2024 Sep 30", "feb": "2025 Feb 28", "1st jan 2024": "2024 Jan 01", "on the 5th of May 2024 (public holiday)": "2024 May 05", "Fermé le lundi 5 mai 2025 toute la journée": "2025 May 05",
    "25 décembre 2023 de 10h30 à 12 h, puis 14:00": "2023 Dec 25", "mar. 3 juin 2025": "2025 Jun 03", "marseille mairie": None, "25/12/2024": "2024 Dec 25", "03/04/2024": "2024 Mar 04", "15.03.2024": "2024 Mar 15",
    "12.03.2024": "2024 Dec 03", "5-6-24": "2024 May 06", "25-6-24": "2024 Jun 25", "20240315": "2024 Mar 15", "2024-03": "2024 Mar 31", "03-2024": "2024 Mar 31", "25/12": "2025 Dec 25", "1/13": "2025 Jan 13",
    "2024": "2024 Aug 31", "12": "2025 Aug 12", "monday": "2025 Sep 01", "Sunday": "2025 Aug 31", "lundi": None, "monday 5 may": "2025 May 05", "31 February 2024": None, "2024-13-05": None, "10:30": None, "10h": None, "": None, None: None,
    "  14   JUILLET  2025 ": "2025 Jul 14", "3 halles et 4 salles": None, "00 mai 2024": None,
}


def test_dates_in_free_text(spark):
    rows = spark.createDataFrame([(t,) for t in DATES], "t string").coalesce(1)
    got = rows.select("t", hours.print_date(F.col("t"), F.lit(AUGUST).cast("date")).alias("d")).collect()
    assert {r.t: r.d for r in got} == DATES


def test_dates_as_a_public_parser_reads_them(spark):
    """Texts in which a common lenient parser finds a date, after month names are translated, give the same one."""
    import datetime

    parser = pytest.importorskip("dateutil.parser")
    months = dict(zip(["janvier", "février", "mars", "avril", "mai", "juin", "juillet", "août", "septembre", "octobre", "novembre", "décembre"], hours.ENGLISH_MONTHS, strict=True))
    made = [f"{d}{sep}{m}{sep}{y}" for d, y in ((1, 2024), (28, 1999), (30, 2030)) for m in months for sep in (" ", "  ")]
    made += [f"{p}{d:02}/{m:02}/{y}" for p in ("", "le ") for d, m, y in ((1, 2, 2024), (11, 12, 2025), (25, 6, 2023), (12, 12, 2012))] + [f"{m} {d}, 2024" for m in months for d in (3, 17)]
    today = datetime.datetime(2025, 8, 31)

    def expected(text):
        for french, english in months.items():
            text = text.replace(french, english)
        try:
            return parser.parse(text, fuzzy=True, default=today).strftime("%Y %b %d")
        except ValueError:  # a day that its month lacks
            return None

    rows = spark.createDataFrame([(t,) for t in made], "t string").select("t", hours.print_date(F.col("t"), F.lit(AUGUST).cast("date")).alias("d"))
    assert {r.t: r.d for r in rows.collect()} == {t: expected(t) for t in made}
