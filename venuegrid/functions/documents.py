"""The JSON schedule document: typed reading and writing, special days, comparison guards."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from venuegrid.functions import hours
from venuegrid.functions.text import let
from venuegrid.schema import DAY

# Periods with their labels and conditions, and texts stored for outcomes.
WEEKLY = {
    "hors_vacances_scolaires": ("Période hors vacances scolaires", "default"),
    "vacances_scolaires_ete": ("Grandes vacances scolaires", "SH"),
    "petites_vacances_scolaires": ("Petites vacances scolaires", "SH"),
}
SPECIALS = ["jours_feries", "jours_speciaux"]
NO_REFERENCE = "Pas d'horaires de référence data.grandlyon.com disponibles"
NO_EXTRACT = "Horaires LLM non disponibles (None ou vide)."
LABELS = {**{k: v for k, v in WEEKLY.items()}, "jours_feries": ("Jours fériés", "PH"), "jours_speciaux": ("Jours spéciaux", None)}
CONVERTED = {"identifiant": "converted_from_osm", "nom": "Lieu converti depuis OSM", "type_lieu": "Indéterminé", "url": "", "timezone": "Europe/Paris"}
CONVERTED_NOTE = "Converti depuis format OSM"
HOLIDAY_NOTE = "Jours fériés français - mairie généralement fermée"
IDENTICAL, DIFFERENT, ERROR = "Identique", "Différent", "Erreur de comparaison"
NOT_CONVERTED = "Erreur de conversion OSM->JSON pour la chaîne prédite ou la vérité terrain."
NO_SOURCE = "Aucune source d'horaires trouvée par le LLM."
HOLIDAY_TYPES = ["mairie", "bibliothèque"]

_MAP = "map<string,string>"
#: A day as JSON has it: an occurrence is a number or a list, flags may be texts.
_DAY_JSON = "struct<source_found: string, ouvert: string, creneaux: array<struct<debut: string, fin: string, occurence: string>>>"


def _as_map(json: Column) -> Column:
    return F.coalesce(F.from_json(json, _MAP), F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>")))


def periods(document: Column) -> Column:
    """Period name to its JSON text, in document order."""
    return _as_map(F.get_json_object(document, "$.horaires_ouverture.periodes"))


def _day(json: Column) -> Column:
    """A day's JSON typed, parsed in one go; slots that lack a time go."""
    flag = lambda c, default: F.coalesce(c.try_cast("boolean"), F.lit(default))
    numbers = lambda o: F.coalesce(F.from_json(o, "array<int>"), F.when(o.rlike("^[0-9]+$"), F.array(o.try_cast("int"))))

    def typed(d: Column) -> Column:
        good = F.filter(d["creneaux"], lambda s: s["debut"].isNotNull() & s["fin"].isNotNull())
        slots = F.transform(good, lambda s: F.struct(s["debut"].alias("debut"), s["fin"].alias("fin"), F.when(s["occurence"].isNotNull(), numbers(s["occurence"])).alias("occurence")))
        none = F.array().cast("array<struct<debut: string, fin: string, occurence: array<int>>>")
        return F.struct(flag(d["source_found"], True).alias("source_found"), flag(d["ouvert"], False).alias("ouvert"), F.coalesce(slots, none).alias("creneaux"))

    return let(F.from_json(json, _DAY_JSON), typed).cast(DAY)


def week(period: Column) -> Column:
    """Seven typed days of a weekly period's JSON; days it lacks have no source."""
    none = F.from_json(F.lit('{"source_found":false,"ouvert":false,"creneaux":[]}'), DAY)
    days = normal_days(_as_map(F.get_json_object(period, "$.horaires")))
    return let(days, lambda m: F.transform(F.array(*map(F.lit, hours.JOURS)), lambda j: F.when(m[j].isNotNull(), _day(m[j])).otherwise(none)))


def normal_days(days: Column) -> Column:
    """A map by day name with the names in lower case and without outer space; of equal ones the last wins."""
    entries = F.transform(F.map_entries(days), lambda e: F.struct(F.lower(F.trim(e["key"])).alias("key"), e["value"].alias("value")))
    last = let(entries, lambda es: F.filter(es, lambda e, i: ~F.exists(F.slice(es, i + 2, F.size(es)), lambda x: x["key"] == e["key"])))
    return F.map_from_entries(last)


def special(period: Column) -> Column:
    """Date to ``ferme``, ``ouvert`` or slot texts of a special period."""
    def said(_, v: Column) -> Column:
        slots = F.array_join(F.transform(_day(v)["creneaux"], hours.slot_text), ",")
        return F.when(~v.startswith("{"), v).when(slots != "", slots).when(_day(v)["ouvert"], "ouvert").otherwise("ferme")

    return F.transform_values(_as_map(F.get_json_object(period, "$.horaires_specifiques")), said)


def print_document(document: Column) -> Column:
    """Each period in OSM notation as ``period: osm`` joined by ``; ``, in document order.

    Weekly periods come from their weeks; special ones list dates, or say off or open by mode. An ``Erreur…`` text
    or a blank gives an empty text, text that is no JSON an error text; a document whose every sourced weekly
    period is closed, and that has no public holidays, is ``off``.
    """
    def shown(name: Column, text: Column) -> Column:
        off = lambda v: F.when(F.lower(v).isin("ferme", "fermé", "closed"), "off").when(v == "ouvert", "open").otherwise(v)
        dated = lambda entries: F.array_join(F.transform(entries, lambda e: F.concat(F.coalesce(hours.print_date(e["key"]), F.when(name == "jours_feries", "PH").otherwise(e["key"])), F.lit(" "), off(e["value"]))), "; ")
        condition = F.coalesce(F.get_json_object(text, "$.condition"), F.when(name == "jours_feries", "PH"))
        mode = F.get_json_object(text, "$.mode")
        bare = F.when(mode == "ferme", F.concat(condition, F.lit(" off"))).when(mode == "ouvert", F.concat(condition, F.lit(" open")))
        listed = let(F.map_entries(special(text)), lambda entries: F.when(F.size(entries) > 0, dated(entries)).otherwise(bare))
        return F.when(name.isin(SPECIALS), listed).otherwise(hours.print_week(week(text)))

    def printed(json: Column) -> Column:
        sourced = F.filter(F.map_entries(periods(json)), lambda e: _found(e["value"]))
        each = F.filter(F.transform(sourced, lambda e: F.struct(e["key"].alias("name"), shown(e["key"], e["value"]).alias("osm"))), lambda x: F.coalesce(x["osm"], F.lit("")) != "")
        joined = let(each, lambda es: F.when((F.size(es) > 0) & F.forall(es, lambda x: (x["osm"] == "off") & ~x["name"].contains("jours_feries")), "off").otherwise(F.array_join(F.transform(es, lambda x: F.concat(x["name"], F.lit(": "), x["osm"])), "; ")))
        blank = json.isNull() | (F.trim(json) == "") | json.startswith("Erreur")
        return F.when(blank, "").when(F.try_parse_json(json).isNull(), "Erreur Conversion OSM: JSON invalide").otherwise(joined)

    return let(document, printed)


def future_only(dates: Column, today: Column) -> Column:
    """The entries of a date map strictly after ``today``; keys that are no dates go."""
    return F.map_filter(dates, lambda k, v: F.coalesce(F.try_to_date(k, "yyyy-M-d") > today, F.lit(False)))


def with_holidays(dates: Column, holidays: Column, venue_type: Column) -> Column:
    """Holidays added as ``ferme`` where the venue type closes on them and the map has no entry."""
    missing = F.map_filter(F.transform_values(holidays, lambda k, v: F.lit("ferme")), lambda k, v: ~F.map_contains_key(dates, k))
    return F.when(F.lower(venue_type).isin(HOLIDAY_TYPES), F.map_concat(missing, dates)).otherwise(dates)


def comparison_problem(reference: Column, extracted: Column) -> Column:
    """Why two documents cannot be compared, or null; the first reason that holds."""
    blank = lambda c: c.isNull() | (F.trim(c) == "")
    bad = lambda c: F.try_parse_json(c).isNull()

    def reason(r: Column, x: Column) -> Column:
        found = F.get_json_object(x, "$.extraction_info.source_found").try_cast("boolean")
        notes = F.coalesce(F.get_json_object(x, "$.extraction_info.notes"), F.lit(NO_SOURCE))
        return (
            F.when(blank(r), NO_REFERENCE)
            .when(r.startswith("Erreur conversion:"), F.concat(F.lit("Erreur dans les données GL: "), r))
            .when(bad(r), "Erreur parsing JSON data.grandlyon.com")
            .when(blank(x), NO_EXTRACT)
            .when(bad(x), "Erreur parsing JSON LLM")
            .when(~F.coalesce(found, F.lit(True)), F.concat(F.lit("Comparaison impossible: "), notes))
        )

    return let(reference, lambda r: let(extracted, lambda x: reason(r, x)))


# -- the document of five periods ----------------------------------------------------------------------------------


def document(osm: Column, metadata: Column | None = None) -> Column:
    """The JSON document of an ``opening_hours`` text; null for a null or empty text.

    The week goes to the period outside school holidays, which always counts as sourced; special dates go to the public
    holidays, whose mode says open only if the last PH rule does. ``metadata`` is a struct (null or absent: a stated
    default).
    """
    default = F.struct(*(F.lit(v).alias(k) for k, v in CONVERTED.items()))
    about = F.to_json(default) if metadata is None else F.coalesce(F.to_json(metadata), F.to_json(default))
    slot = lambda s: F.struct(s["debut"].alias("debut"), s["fin"].alias("fin"), s["occurence"].alias("occurence"))
    shown = lambda d: F.struct(d["source_found"].alias("source_found"), d["ouvert"].alias("ouvert"), F.transform(d["creneaux"], slot).alias("creneaux"))
    unknown = F.from_json(F.lit('{"source_found":false,"ouvert":false,"creneaux":[]}'), DAY)
    no_dates = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))

    def period(name: str, found: Column, *more: Column) -> Column:
        label, condition = LABELS[name]
        said = [F.lit(condition).alias("condition")] if condition else []
        return F.struct(found.alias("source_found"), F.lit(label).alias("label"), *said, *more).alias(name)

    def built(p: Column) -> Column:
        days = F.struct(*(shown(p["week"][k]).alias(j) for k, j in enumerate(hours.JOURS)))
        none = F.struct(*(unknown.alias(j) for j in hours.JOURS))
        dates = hours.dates_of(p["special"])
        periods_ = F.struct(
            period("hors_vacances_scolaires", F.lit(True), days.alias("horaires")),
            *(period(k, F.lit(False), none.alias("horaires")) for k in list(WEEKLY)[1:]),
            period("jours_feries", p["ph_found"] | (F.size(p["special"]) > 0), F.when(p["ph_found"], p["ph_mode"]).otherwise("ferme").alias("mode"), dates.alias("horaires_specifiques")),
            period("jours_speciaux", F.lit(False), F.lit("ouvert").alias("mode"), no_dates.alias("horaires_specifiques")),
        )
        info = F.struct(F.lit(True).alias("source_found"), p["closed"].alias("permanently_closed"), F.lit(CONVERTED_NOTE).alias("notes"))
        # the metadata struct is of the caller's making, so it joins as text
        return F.concat(F.lit('{"horaires_ouverture":{"metadata":'), about, F.lit(',"periodes":'), F.to_json(periods_), F.lit(',"extraction_info":'), F.to_json(info), F.lit("}}"))

    return let(osm, lambda o: F.when(o != "", let(hours.parse_osm(o), built)))


def _found(json: Column) -> Column:
    return F.coalesce(F.get_json_object(json, "$.source_found").try_cast("boolean"), F.lit(False))


def has_source(period: Column) -> Column:
    """Whether a period's JSON is sourced and one of its days, or else of its dates, is; without either it is by itself."""
    days, dates = F.get_json_object(period, "$.horaires"), F.get_json_object(period, "$.horaires_specifiques")
    sourced = lambda v: F.coalesce(F.get_json_object(v, "$.source_found").try_cast("boolean"), F.lit(True))
    objects = lambda m: F.filter(F.map_values(_as_map(m)), lambda v: v.startswith("{"))
    said = F.exists(F.map_values(_as_map(dates)), lambda v: ~v.startswith("{") | sourced(v))
    return _found(period) & F.when(days.startswith("{"), F.exists(objects(days), sourced)).when(dates.startswith("{"), said).otherwise(True)


def to_osm(document: Column) -> Column:
    """Period name to its OSM notation; ``general`` to ``off`` where every sourced period is closed and none is of public holidays."""
    pair = lambda x: F.struct(F.substring_index(x, ": ", 1), F.regexp_extract(x, r"(?s)^[a-z_]+: (.*)$", 1))
    none = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))

    def cut(printed: Column) -> Column:
        each = F.map_from_entries(F.transform(F.split(printed, r"; (?=[a-z_]+: )"), pair))
        return F.when(printed == "off", F.create_map(F.lit("general"), F.lit("off"))).when((printed == "") | printed.startswith("Erreur"), none).otherwise(each)

    return let(print_document(document), cut)


def permanently_closed(document: Column) -> Column:
    """Whether some period is sourced and none of the sourced ones has an open day, a slot or a specific date."""

    def opens(name: Column, text: Column) -> Column:
        weekly = F.exists(week(text), lambda d: d["ouvert"] | (F.size(d["creneaux"]) > 0))
        dated = F.size(_as_map(F.get_json_object(text, "$.horaires_specifiques"))) > 0
        return F.when(name.isin(list(WEEKLY)), weekly).when(name.isin(SPECIALS), dated).otherwise(False)

    sourced = F.filter(F.map_entries(periods(document)), lambda e: _found(e["value"]))
    return let(sourced, lambda es: (F.size(es) > 0) & ~F.exists(es, lambda e: opens(e["key"], e["value"])))


def overlay(first: Column, then: Column) -> Column:
    """Both maps' entries; those of ``then`` win."""
    return let(then, lambda new: F.map_concat(F.map_filter(first, lambda k, v: ~F.map_contains_key(new, k)), new))


def _dates(document: Column) -> Column:
    """Date to its JSON of public holidays, then special days."""
    of = lambda name: _as_map(F.get_json_object(document, f"$.horaires_ouverture.periodes.{name}.horaires_specifiques"))
    return let(F.struct(of("jours_feries").alias("a"), of("jours_speciaux").alias("b")), lambda p: overlay(p["a"], p["b"]))


def special_changes(a: Column, b: Column) -> Column:
    """Changes of two maps of date to a word or a day's JSON, in date order.

    Two words that differ show both; a day that comes or goes shows what it is against a closed one, other pairs their
    differences, if any: a word counts as a closed day there.
    """
    shut = F.from_json(F.lit('{"source_found":true,"ouvert":false,"creneaux":[]}'), DAY)
    day = lambda v: F.when(v.startswith("{"), _day(v)).otherwise(shut)
    word = lambda v: ~v.startswith("{")

    def said(a: Column, b: Column, d: Column) -> Column:
        x, y = a[d], b[d]
        added, gone = F.concat(F.lit("ajouté ("), hours.day_diff(shut, day(y)), F.lit(")")), F.concat(F.lit("supprimé ("), hours.day_diff(day(x), shut), F.lit(")"))
        both = F.when(word(x) & word(y), F.when(x != y, F.concat(x, F.lit(" → "), y))).otherwise(F.nullif(hours.day_diff(day(x), day(y)), F.lit("")))
        return F.concat(d, F.lit(": "), F.when(x.isNull(), added).when(y.isNull(), gone).otherwise(both))

    def listed(a: Column, b: Column) -> Column:
        every = F.transform(F.array_sort(F.array_union(F.map_keys(a), F.map_keys(b))), lambda d: said(a, b, d))
        return F.concat_ws(" | ", F.filter(every, lambda x: x.isNotNull()))

    return let(a, lambda one: let(b, lambda two: listed(one, two)))


def compare(a: Column, b: Column) -> Column:
    """``identical`` and ``differences`` of two JSON documents: closure, special days, then each weekly period in name order."""

    def found(p: Column) -> Column:
        x, y = p["a"], p["b"]
        names = F.array_sort(F.array_except(F.array_union(F.map_keys(x["periods"]), F.map_keys(y["periods"])), F.array(*map(F.lit, SPECIALS))))
        weeks = lambda n: F.transform(F.array(x["periods"][n], y["periods"][n]), week)
        changed = lambda n: F.concat(F.upper(n), F.lit(": "), F.nullif(let(weeks(n), lambda w: hours.week_diff(w[0], w[1])), F.lit("")))
        lines = F.concat_ws(
            "\n",
            F.when(x["shut"] & ~y["shut"], hours.ATTENTION_1).when(~x["shut"] & y["shut"], hours.ATTENTION_2),
            F.concat(F.lit(f"{hours.SPECIAL}: "), F.nullif(special_changes(x["dates"], y["dates"]), F.lit(""))),
            F.filter(F.transform(names, changed), lambda t: t.isNotNull()),
        )
        return F.when(x["shut"] & y["shut"], "").otherwise(lines)

    side = lambda d: F.struct(permanently_closed(d).alias("shut"), _dates(d).alias("dates"), periods(d).alias("periods"))
    text = let(F.transform(F.array(a, b), side), lambda two: let(two[0], lambda x: let(two[1], lambda y: found({"a": x, "b": y}))))
    return let(text, lambda t: F.struct((t == "").alias("identical"), F.when(t == "", hours.SAME).otherwise(t).alias("differences")))


def score(predicted: Column, truth: Column) -> Column:
    """``status``, ``diff_count`` and ``differences`` of a predicted against a true OSM text.

    Of two texts without hours none is wrong; of one it is an error that counts one.
    """
    blank = lambda c: F.coalesce(c, F.lit("")) == ""

    def judged(p: Column, t: Column, c: Column) -> Column:
        same = blank(p) & blank(t)
        error = ~same & (blank(p) | blank(t))
        status = F.when(same | (~error & c["identical"]), IDENTICAL).when(error, ERROR).otherwise(DIFFERENT)
        text = F.when(same, "").when(error, NOT_CONVERTED).otherwise(c["differences"])
        count = F.when(same, 0).when(error, 1).otherwise(hours.atomic_differences(c["differences"]))
        return F.struct(status.alias("status"), count.cast("int").alias("diff_count"), text.alias("differences"))

    def compared(two: Column) -> Column:
        return let(F.transform(two, lambda osm: document(osm)), lambda docs: let(compare(docs[0], docs[1]), lambda c: judged(two[1], two[0], c)))

    return let(F.array(truth, predicted), compared)


# -- extraction ------------------------------------------------------------------------------------------------


def holiday_dates(this_year: Column, next_year: Column, today: Column) -> Column:
    """The coming holidays of this year, then all of the next, as one map of date to name."""
    return overlay(future_only(this_year, today), next_year)


def refreshed(json: Column, venue_type: Column, holidays: Column, today: Column) -> Column:
    """An extracted document without past special dates and, for venue types that close on them, with the coming holidays.

    ``{}`` for text that is empty or no JSON. ``holidays`` is a map of date to name (see ``holiday_dates``).
    """
    many = "map<string,variant>"
    entry = lambda v: F.try_variant_get(v, "$", many)
    new = F.struct(
        F.lit(True).alias("source_found"), F.lit("Jours fériés").alias("label"), F.lit("PH").alias("condition"), F.lit("ferme").alias("mode"), F.from_json(F.lit("{}"), "map<string,string>").alias("horaires_specifiques"), F.lit(HOLIDAY_NOTE).alias("description")
    )

    def dated(name: Column, period: Column, days: Column, closes: Column) -> Column:
        def joined(kept: Column) -> Column:
            missing = F.transform_values(F.map_filter(days, lambda k, v: ~F.map_contains_key(kept, k)), lambda k, v: F.parse_json(F.lit('"ferme"')))
            return F.when(closes & (name == "jours_feries"), F.map_concat(kept, missing)).otherwise(kept)

        dates = F.coalesce(F.try_variant_get(period["horaires_specifiques"], "$", many), F.from_json(F.lit("{}"), many))
        kept = F.map_filter(dates, lambda k, v: F.coalesce(F.try_to_date(k, "yyyy-M-d") > today, F.lit(False)))
        has = F.map_contains_key(period, "horaires_specifiques") | (closes & (name == "jours_feries"))
        return F.when(has, overlay(period, F.create_map(F.lit("horaires_specifiques"), F.parse_json(F.to_json(let(kept, joined)))))).otherwise(period)

    def listed(found: Column, days: Column, closes: Column) -> Column:
        more = F.when(closes & ~F.map_contains_key(found, "jours_feries"), F.map_concat(found, F.create_map(F.lit("jours_feries"), F.parse_json(F.to_json(new))))).otherwise(found)
        return F.transform_values(more, lambda k, v: let(entry(v), lambda p: F.coalesce(F.parse_json(F.to_json(dated(k, p, days, closes))), v)))

    def within(inner: Column, days: Column, closes: Column) -> Column:
        found = F.coalesce(F.try_variant_get(inner["periodes"], "$", many), F.from_json(F.lit("{}"), many))
        each = let(found, lambda p: listed(p, days, closes))
        changed = F.map_contains_key(inner, "periodes") | closes
        return F.when(changed, overlay(inner, F.create_map(F.lit("periodes"), F.parse_json(F.to_json(each))))).otherwise(inner)

    def rewritten(top: Column, days: Column, closes: Column) -> Column:
        inner = let(F.coalesce(entry(top["horaires_ouverture"]), F.from_json(F.lit("{}"), many)), lambda i: within(i, days, closes))
        whole = F.map_contains_key(top, "horaires_ouverture") | closes
        return F.to_json(F.when(whole, overlay(top, F.create_map(F.lit("horaires_ouverture"), F.parse_json(F.to_json(inner))))).otherwise(top))

    def given(top: Column) -> Column:
        closes = lambda days: F.lower(venue_type).isin(HOLIDAY_TYPES) & (F.size(days) > 0)
        return F.when(top.isNotNull(), let(holidays, lambda days: let(closes(days), lambda c: rewritten(top, days, c))))

    parsed = F.try_variant_get(F.try_parse_json(json), "$", many)
    return F.coalesce(let(parsed, given), F.lit("{}"))


def outcome(content: Column, failure: Column, venue_type: Column, holidays: Column, today: Column) -> Column:
    """``json`` and ``osm`` of a model's answer; a failed call, an empty or an error answer puts its error in both."""

    def settled(text: Column) -> Column:
        wrong = (
            F.when(failure.isNotNull(), F.concat(F.lit("Erreur LLM: "), failure))
            .when(text.isNull(), "Erreur LLM: reçu 'None' - réponse vide")
            .when(text == "", "Erreur LLM: reçu '' - réponse inattendue")
            .when(text.startswith("Erreur"), text)
        )
        good = let(refreshed(text, venue_type, holidays, today), lambda j: F.struct(j.alias("json"), print_document(j).alias("osm")))
        return let(wrong, lambda w: F.when(w.isNotNull(), F.struct(w.alias("json"), w.alias("osm"))).otherwise(good))

    return let(content, settled)


def outcome_errors(chain: Column, result: Column, stamp: Column) -> Column:
    """The error chain with an answer's LLM error and, where it is another text, its OSM error."""
    from venuegrid.operators.state import add_error

    llm = F.when(result["json"].startswith("Erreur"), result["json"])
    osm = F.when(result["osm"].startswith("Erreur") & (result["osm"] != result["json"]), result["osm"])
    return add_error(add_error(chain, "LLM", llm, stamp), "OSM", osm, stamp)
