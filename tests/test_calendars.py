"""School holidays as a data source: which calendars are read, and what is left to Spark."""

import json

import pytest
from pyspark.sql import functions as F

from venuegrid.sources import calendars

ZONES, YEARS = ["Zone A", "Zone B"], ["2022-2023", "2023-2024", "2024-2025"]


@pytest.fixture
def service(tmp_path):
    """Six calendars and a reader that notes each one it reads, with the conditions it was given."""
    for zone in ZONES:
        (tmp_path / "data" / zone).mkdir(parents=True)
        for year in YEARS:
            first, last = year.split("-")
            rows = [(f"Noël {zone}", f"{first}-12-23T00:00:00+01:00", f"{last}-01-08T00:00:00+01:00", "Lyon", "Élèves"), ("Été", f"{last}-07-06", f"{last}-09-01", "Paris", None), (None, "never", None, "Lyon", "Élèves")]
            names = ["description", "start_date", "end_date", "location", "population"]
            made = [dict(zip(names, r, strict=True)) | {"zones": zone, "annee_scolaire": year} for r in rows]
            (tmp_path / "data" / zone / f"{year}.json").write_text(json.dumps({"results": made}))
    (tmp_path / "seen").mkdir()
    seen = str(tmp_path / "seen")

    def load(path, zone, year, where):
        with open(f"{seen}/{zone} {year}", "a") as note:
            note.write("\n".join(where))
        with open(f"{path}/{zone}/{year}.json") as file:
            return file.read()

    return str(tmp_path / "data"), load, tmp_path / "seen"


def read(seen):
    return sorted(p.name for p in seen.iterdir())


def test_only_wanted_calendars_are_read(spark, service):
    path, load, seen = service
    got = calendars.school_holidays(spark, path, "2023-09-01", "2024-12-31", location="Lyon", zone="Zone A", load=load).collect()
    assert [(r.description, r.start_date.isoformat()) for r in got] == [("Noël Zone A", "2023-12-22T23:00:00")]
    assert read(seen) == ["Zone A 2022-2023", "Zone A 2023-2024", "Zone A 2024-2025"]  # a school year's last holidays end in September
    assert "zones like 'Zone A'" in (seen / "Zone A 2023-2024").read_text()


def test_years_and_equality(spark, service):
    path, load, seen = service
    calendars.register(spark, load=load)
    rows = spark.read.format("school_holidays").load(path)
    got = rows.where("annee_scolaire = '2023-2024' AND zones IN ('Zone B', 'Zone C') AND end_date < TIMESTAMP '2024-02-01'")
    assert [r.description for r in got.collect()] == ["Noël Zone B"] and read(seen) == ["Zone B 2023-2024"]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BatchScan school_holidays" in plan and "Filter " not in plan  # the source takes all of them


def test_filters_that_stay_with_spark(spark, service):
    path, load, seen = service
    calendars.register(spark, load=load)
    rows = lambda: spark.read.format("school_holidays").load(path)
    assert rows().where(F.length("description") > 4).count() == 6 and len(read(seen)) == 6
    assert rows().where("zones = 'Zone X'").count() == 0 and rows().where("description IS NULL").count() == 6
    assert rows().where("start_date IS NOT NULL").count() == 12 and rows().count() == 18


def test_a_single_file(spark, service):
    path, _, _ = service
    got = calendars.school_holidays(spark, f"{path}/Zone A/2023-2024.json", "2023-01-01", "2025-12-31")
    assert [r.description for r in got.collect()] == ["Noël Zone A", "Été"]


def test_public_holidays(spark, tmp_path):
    """One zone and year is one calendar; days prune years too."""
    seen = tmp_path / "seen"
    seen.mkdir()
    for zone in ("metropole", "alsace-moselle"):
        (tmp_path / "data" / zone).mkdir(parents=True)
        for year in (2024, 2025, 2026):
            days = {f"{year}-01-01": "1er janvier", f"{year}-05-01": "1er mai"} | ({f"{year}-12-26": "2e jour de Noël"} if zone != "metropole" else {})
            (tmp_path / "data" / zone / f"{year}.json").write_text(json.dumps(days))
    noted = str(seen)

    def load(path, zone, year, where):
        open(f"{noted}/{zone} {year}", "w").close()
        return calendars.folder_load(path, zone, year, where)

    path = str(tmp_path / "data")
    got = calendars.public_holidays(spark, path, "alsace-moselle", 2025, load=load)
    assert [tuple(r) for r in got.collect()] == [("2025-01-01", "1er janvier"), ("2025-05-01", "1er mai"), ("2025-12-26", "2e jour de Noël")]
    assert read(seen) == ["alsace-moselle 2025"]
    rows = spark.read.format("public_holidays").load(path)
    assert rows.where("day >= '2025-12-01' AND day < '2026-01-01'").count() == 1
    assert read(seen) == ["alsace-moselle 2025", "metropole 2025"]
    assert spark.read.format("public_holidays").load(path).count() == 15  # loaded anew, see register
