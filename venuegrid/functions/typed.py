"""The five-period document as a typed column: parsed once, stored with its schema, read period by period.

A stored column of this type needs no JSON parsing, and a query that looks at one period reads only that period's
columns from Parquet.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from venuegrid.functions import documents, hours
from venuegrid.functions.text import let
from venuegrid.schema import DAY

WEEKLY = f"struct<source_found: boolean, week: array<{DAY}>>"
#: A special date has a word (``ferme``, ``ouvert``) or a day with slots.
SPECIAL = f"struct<source_found: boolean, condition: string, mode: string, dates: map<string, struct<word: string, day: {DAY}>>>"
DOCUMENT = "struct<" + ", ".join([*(f"{n}: {WEEKLY}" for n in documents.WEEKLY), *(f"{n}: {SPECIAL}" for n in documents.SPECIALS), "permanently_closed: boolean, notes: string"]) + ">"


def _unknown_week() -> Column:
    return F.array_repeat(F.from_json(F.lit('{"source_found":false,"ouvert":false,"creneaux":[]}'), DAY), 7)


def _no_dates() -> Column:
    return F.map_from_arrays(F.array().cast("array<string>"), F.array().cast(f"array<struct<word: string, day: {DAY}>>"))


def from_json(document: Column) -> Column:
    """A JSON document typed; null for null or what is no JSON. Other periods than the five are left out."""

    def weekly(text: Column) -> Column:
        return F.struct(documents._found(text).alias("source_found"), documents.week(text).alias("week"))

    def special(text: Column) -> Column:
        of = lambda v: F.struct(F.when(~v.startswith("{"), v).alias("word"), F.when(v.startswith("{"), documents._day(v)).alias("day"))
        dates = F.transform_values(documents._as_map(F.get_json_object(text, "$.horaires_specifiques")), lambda _, v: of(v))
        return F.struct(documents._found(text).alias("source_found"), F.get_json_object(text, "$.condition").alias("condition"), F.get_json_object(text, "$.mode").alias("mode"), dates.alias("dates"))

    def built(json: Column) -> Column:
        info = lambda k: F.get_json_object(json, f"$.horaires_ouverture.extraction_info.{k}")
        each = lambda ps: F.struct(
            *(let(ps[n], weekly).alias(n) for n in documents.WEEKLY), *(let(ps[n], special).alias(n) for n in documents.SPECIALS), info("permanently_closed").try_cast("boolean").alias("permanently_closed"), info("notes").alias("notes")
        )
        return F.when(F.try_parse_json(json).isNotNull(), let(documents.periods(json), each))

    return let(document, built).cast(DOCUMENT)


def from_osm(osm: Column) -> Column:
    """The typed document of an ``opening_hours`` text, as ``documents.document`` makes it; null for a null or empty one."""

    def built(p: Column) -> Column:
        none = F.struct(F.lit(False).alias("source_found"), _unknown_week().alias("week"))
        dates = F.transform_values(hours.dates_of(p["special"]), lambda _, v: F.struct(v.alias("word"), F.lit(None).cast(DAY).alias("day")))
        first, *other = documents.WEEKLY
        return F.struct(
            F.struct(F.lit(True).alias("source_found"), p["week"].alias("week")).alias(first), *(none.alias(n) for n in other),
            F.struct((p["ph_found"] | (F.size(p["special"]) > 0)).alias("source_found"), F.lit("PH").alias("condition"), F.when(p["ph_found"], p["ph_mode"]).otherwise("ferme").alias("mode"), dates.alias("dates")).alias("jours_feries"),
            F.struct(F.lit(False).alias("source_found"), F.lit(None).cast("string").alias("condition"), F.lit("ouvert").alias("mode"), _no_dates().alias("dates")).alias("jours_speciaux"),
            p["closed"].alias("permanently_closed"), F.lit(documents.CONVERTED_NOTE).alias("notes"),
        )

    return let(osm, lambda o: F.when(o != "", let(hours.parse_osm(o), built))).cast(DOCUMENT)


def _said(value: Column) -> Column:
    """A special date as a word or its slots."""
    slots = lambda d: F.array_join(F.transform(d["creneaux"], hours.slot_text), ",")
    return F.coalesce(value["word"], F.nullif(slots(value["day"]), F.lit("")), F.when(value["day"]["ouvert"], "ouvert").otherwise("ferme"))


def print_period(document: Column, name: str) -> Column:
    """One period in OSM notation; null if it has no source, or nothing to show."""
    period = document[name]
    if name in documents.WEEKLY:
        return F.when(period["source_found"], hours.print_week(period["week"]))
    off = lambda v: F.when(F.lower(v).isin("ferme", "fermé", "closed"), "off").when(v == "ouvert", "open").otherwise(v)
    stand_in = (lambda k: F.lit("PH")) if name == "jours_feries" else (lambda k: k)
    one = lambda e: F.concat(F.coalesce(hours.print_date(e["key"]), stand_in(e["key"])), F.lit(" "), let(_said(e["value"]), off))
    condition = F.coalesce(period["condition"], F.lit("PH" if name == "jours_feries" else None).cast("string"))
    bare = F.when(period["mode"] == "ferme", F.concat(condition, F.lit(" off"))).when(period["mode"] == "ouvert", F.concat(condition, F.lit(" open")))
    dated = F.array_join(F.transform(F.map_entries(period["dates"]), one), "; ")
    return F.when(period["source_found"], F.when(F.size(period["dates"]) > 0, dated).otherwise(bare))


def to_osm(document: Column) -> Column:
    """Period name to its OSM notation, as ``documents.to_osm``."""
    names = [*documents.WEEKLY, *documents.SPECIALS]
    printed = lambda d: F.array(*(F.struct(F.lit(n).alias("key"), F.nullif(print_period(d, n), F.lit("")).alias("value")) for n in names))
    shut = lambda es: (F.size(es) > 0) & F.forall(es, lambda e: (e["value"] == "off") & (e["key"] != "jours_feries"))
    mapped = lambda es: F.when(shut(es), F.create_map(F.lit("general"), F.lit("off"))).otherwise(F.map_from_entries(es))
    return let(document, lambda d: let(F.filter(printed(d), lambda e: e["value"].isNotNull()), mapped))


def permanently_closed(document: Column) -> Column:
    """Whether some period is sourced and none of the sourced ones has an open day, a slot or a date."""
    weekly = lambda p: F.exists(p["week"], lambda d: d["ouvert"] | (F.size(d["creneaux"]) > 0))
    sourced = [document[n]["source_found"] for n in [*documents.WEEKLY, *documents.SPECIALS]]
    opens = [*(weekly(document[n]) for n in documents.WEEKLY), *(F.size(document[n]["dates"]) > 0 for n in documents.SPECIALS)]
    some, open_ = sourced[0], sourced[0] & opens[0]
    for s, o in zip(sourced[1:], opens[1:], strict=True):
        some, open_ = some | s, open_ | (s & o)
    return some & ~open_


def week_changes(a: Column, b: Column, name: str) -> Column:
    """Changes of one weekly period, empty if there are none. Over stored columns nothing else is read."""
    return hours.week_diff(a[name]["week"], b[name]["week"])


def date_changes(a: Column, b: Column) -> Column:
    """Changes of all special dates, in date order (see ``documents.special_changes``)."""
    shut = F.from_json(F.lit('{"source_found":true,"ouvert":false,"creneaux":[]}'), DAY)
    day = lambda v: F.coalesce(v["day"], shut)

    def said(x: Column, y: Column, d: Column) -> Column:
        added = F.concat(F.lit("ajouté ("), hours.day_diff(shut, day(y)), F.lit(")"))
        gone = F.concat(F.lit("supprimé ("), hours.day_diff(day(x), shut), F.lit(")"))
        words = F.when(x["word"] != y["word"], F.concat(x["word"], F.lit(" → "), y["word"]))
        both = F.when(x["word"].isNotNull() & y["word"].isNotNull(), words).otherwise(F.nullif(hours.day_diff(day(x), day(y)), F.lit("")))
        return F.concat(d, F.lit(": "), F.when(x.isNull(), added).when(y.isNull(), gone).otherwise(both))

    dates = lambda p: documents.overlay(p["jours_feries"]["dates"], p["jours_speciaux"]["dates"])
    listed = lambda x, y: F.filter(F.transform(F.array_sort(F.array_union(F.map_keys(x), F.map_keys(y))), lambda d: said(x[d], y[d], d)), lambda t: t.isNotNull())
    return let(dates(a), lambda x: let(dates(b), lambda y: F.concat_ws(" | ", listed(x, y))))


def compare(a: Column, b: Column) -> Column:
    """``identical`` and ``differences`` of two typed documents, as ``documents.compare``."""

    def found(x: Column, y: Column, shut_x: Column, shut_y: Column) -> Column:
        weeks = [F.concat(F.lit(f"{n.upper()}: "), F.nullif(week_changes(x, y, n), F.lit(""))) for n in sorted(documents.WEEKLY)]
        attention = F.when(shut_x & ~shut_y, hours.ATTENTION_1).when(~shut_x & shut_y, hours.ATTENTION_2)
        lines = F.concat_ws("\n", attention, F.concat(F.lit(f"{hours.SPECIAL}: "), F.nullif(date_changes(x, y), F.lit(""))), *weeks)
        return F.when(shut_x & shut_y, "").otherwise(lines)

    text = let(a, lambda x: let(b, lambda y: let(permanently_closed(x), lambda p: let(permanently_closed(y), lambda q: found(x, y, p, q)))))
    return let(text, lambda t: F.struct((t == "").alias("identical"), F.when(t == "", hours.SAME).otherwise(t).alias("differences")))
