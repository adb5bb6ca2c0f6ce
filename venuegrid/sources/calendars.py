"""Public and school holidays: files of days, and a data source of school calendars that takes filters down to its reads."""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from datetime import UTC, date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    LessThan,
    LessThanOrEqual,
    StringContains,
    StringEndsWith,
    StringStartsWith,
)

#: Name and columns of the data source.
SOURCE = "school_holidays"
SCHEMA = "description string, population string, start_date timestamp, end_date timestamp, location string, zones string, annee_scolaire string"
_COLUMNS = [c.split()[0] for c in SCHEMA.split(", ")]
#: Rows that the source serves at most.
SERVED = 100
#: The same of public holidays; days are ISO texts.
PUBLIC = "public_holidays"
PUBLIC_SCHEMA = "day string, name string, zone string, year string"


def holidays(spark: SparkSession, path: str) -> DataFrame:
    """``day`` (ISO text) and ``name`` from files that each hold one object of day to name."""
    raw = spark.read.text(path, wholetext=True)
    return raw.select(F.explode(F.from_json("value", "map<string,string>")).alias("day", "name"))


# -- calendars by zone and year -------------------------------------------------------------------------------------


@dataclass
class Calendar(InputPartition):
    """One zone's holidays of one school year: a partition of the source, read on its own."""

    zone: str
    year: str
    where: list[str] = field(default_factory=list)

    def span(self) -> tuple[datetime, datetime] | None:
        """Before and after which a school year's holidays begin and end; none for a name that is no school year."""
        first, _, last = self.year.partition("-")
        if not (first.isdecimal() and last.isdecimal()):
            return None
        return datetime(int(first), 7, 1, tzinfo=UTC), datetime(int(last), 9, 30, tzinfo=UTC)


#: Lists the calendars below a path, and reads one: a JSON text with the rows under ``results``. The second also gets
#: the filters as conditions, for services that take them.
Listing = Callable[[str], list[tuple[str, str]]]
Load = Callable[[str, str, str, list[str]], str]


def folder_listing(path: str) -> list[tuple[str, str]]:
    """(zone, year) of the files ``zone/year.json`` below a folder; a single file is a calendar without either."""
    if os.path.isfile(path):
        return [("", "")]
    return [(zone, name[: -len(".json")]) for zone in sorted(os.listdir(path)) for name in sorted(os.listdir(os.path.join(path, zone))) if name.endswith(".json")]


def folder_load(path: str, zone: str, year: str, where: list[str]) -> str:
    with open(os.path.join(path, zone, f"{year}.json") if zone else path, encoding="utf-8") as file:
        return file.read()


def _instant(value: object) -> datetime | None:
    """ISO text as an instant; a text without a zone, or a bare day, is in UTC."""
    if isinstance(value, datetime):
        return value if value.tzinfo else value.replace(tzinfo=UTC)
    if isinstance(value, date):
        return datetime(value.year, value.month, value.day, tzinfo=UTC)
    try:
        found = datetime.fromisoformat(str(value))
    except ValueError:
        return None
    return found if found.tzinfo else found.replace(tzinfo=UTC)


_TESTS: dict[type, Callable] = {
    EqualTo: lambda x, v: x == v, In: lambda x, v: x in v, GreaterThan: lambda x, v: x > v, GreaterThanOrEqual: lambda x, v: x >= v, LessThan: lambda x, v: x < v, LessThanOrEqual: lambda x, v: x <= v,
    StringContains: lambda x, v: v in x, StringStartsWith: lambda x, v: x.startswith(v), StringEndsWith: lambda x, v: x.endswith(v), IsNotNull: lambda x, v: True,
}
_SIGNS = {EqualTo: "=", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<=", StringContains: "like", StringStartsWith: "like", StringEndsWith: "like"}


def _holds(row: dict, f: Filter) -> bool:
    """Whether a row passes a filter; a null passes none."""
    (column,) = f.attribute
    value = row.get(column)
    wanted = getattr(f, "value", None)
    if column.endswith("_date"):
        wanted = [_instant(w) for w in wanted] if isinstance(f, In) else _instant(wanted)
    return value is not None and bool(_TESTS[type(f)](value, wanted))


def _can_hold(calendar: Calendar, f: Filter) -> bool:
    """Whether a calendar can have rows that pass a filter, by its zone and year alone."""
    (column,) = f.attribute
    known = {"zones": calendar.zone, "annee_scolaire": calendar.year, "zone": calendar.zone, "year": calendar.year}
    if column in known:
        return not known[column] or _holds(known, f)
    if column == "day" and calendar.year.isdecimal():
        first, last = f"{calendar.year}-01-01", f"{calendar.year}-12-31"
        if isinstance(f, EqualTo):
            return first <= f.value <= last
        if isinstance(f, GreaterThan | GreaterThanOrEqual | LessThan | LessThanOrEqual):  # the day of the year that passes most easily
            return _holds({"day": last if isinstance(f, GreaterThan | GreaterThanOrEqual) else first}, f)
    span = calendar.span()
    if span and column.endswith("_date") and isinstance(f, GreaterThan | GreaterThanOrEqual):
        return span[1] >= _instant(f.value)
    if span and column.endswith("_date") and isinstance(f, LessThan | LessThanOrEqual):
        return span[0] <= _instant(f.value)
    return True


def _school_rows(payload: dict, calendar: Calendar) -> Iterator[dict]:
    for found in payload.get("results") or []:
        yield {c: _instant(found.get(c)) if c.endswith("_date") else found.get(c) for c in _COLUMNS}


def _public_rows(payload: dict, calendar: Calendar) -> Iterator[dict]:
    for day, name in payload.items():
        yield {"day": day, "name": name, "zone": calendar.zone or None, "year": calendar.year or day[:4]}


class _Reader(DataSourceReader):
    """Reads calendars with their filters: those that a calendar as a whole fails keep it from being read."""

    def __init__(self, path: str, listing: Listing, load: Load, rows: Callable[[dict, Calendar], Iterator[dict]]) -> None:
        self.path, self.listing, self.load, self.rows = path, listing, load, rows
        self.filters: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802  the interface's name
        for f in filters:
            if type(f) in _TESTS and len(f.attribute) == 1:
                self.filters.append(f)
            else:
                yield f

    def partitions(self) -> list[Calendar]:
        """The calendars that can have wanted rows; no other one is read."""
        where = [f"{f.attribute[0]} {_SIGNS[type(f)]} '{f.value}'" for f in self.filters if type(f) in _SIGNS]
        every = (Calendar(zone, year, where) for zone, year in self.listing(self.path))
        return [c for c in every if all(_can_hold(c, f) for f in self.filters)] or [Calendar("", "", ["none"])]

    def read(self, partition: Calendar) -> Iterator[tuple]:
        if partition.where == ["none"]:
            return
        for row in self.rows(json.loads(self.load(self.path, partition.zone, partition.year, partition.where)), partition):
            if all(_holds(row, f) for f in self.filters):
                yield tuple(row.values())


def register(spark: SparkSession, listing: Listing = folder_listing, load: Load = folder_load) -> None:
    """Make ``spark.read.format`` know ``school_holidays`` and ``public_holidays``, with a service that lists and reads calendars.

    Load a frame anew for every read: Spark 4.1 keeps the filters that went down for a loaded frame, and uses them again
    where the same frame is then read without any.
    """

    class SchoolHolidays(DataSource):
        @classmethod
        def name(cls) -> str:
            return SOURCE

        def schema(self) -> str:
            return SCHEMA

        def reader(self, schema) -> DataSourceReader:  # noqa: ANN001
            return _Reader(self.options["path"], listing, load, _school_rows)

    class PublicHolidays(DataSource):
        @classmethod
        def name(cls) -> str:
            return PUBLIC

        def schema(self) -> str:
            return PUBLIC_SCHEMA

        def reader(self, schema) -> DataSourceReader:  # noqa: ANN001
            return _Reader(self.options["path"], listing, load, _public_rows)

    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(SchoolHolidays)
    spark.dataSource.register(PublicHolidays)


def public_holidays(spark: SparkSession, path: str, zone: str, year: int, listing: Listing = folder_listing, load: Load = folder_load) -> DataFrame:
    """``day`` and ``name`` of one zone's public holidays of a year, in date order; no other calendar is read."""
    register(spark, listing, load)
    rows = spark.read.format(PUBLIC).load(path)
    return rows.where((F.col("zone") == zone) & (F.col("year") == str(year))).select("day", "name").orderBy("day")


def school_holidays(
    spark: SparkSession, path: str, start: str, end: str, location: str | None = None, zone: str | None = None, population: str | None = None, year: str | None = None, listing: Listing = folder_listing, load: Load = folder_load
) -> DataFrame:
    """School holidays between two ISO days, filtered by substring, in date order, SERVED at most as the source serves.

    The filters go down to the source: calendars of other zones and years are not read.
    """
    register(spark, listing, load)
    rows = spark.read.format(SOURCE).load(path)
    kept = rows.where((F.col("start_date") >= F.lit(start).cast("timestamp")) & (F.col("end_date") <= F.lit(end).cast("timestamp")))
    for column, value in (("location", location), ("zones", zone), ("population", population), ("annee_scolaire", year)):
        if value:
            kept = kept.where(F.contains(F.col(column), F.lit(value)))
    return kept.orderBy("start_date", "end_date").limit(SERVED)
