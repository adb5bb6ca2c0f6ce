"""Opening hours: OSM notation to a typed week and back, and differences, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from venuegrid.functions.text import let, strip

# Week order in both notations, months, periods and texts of differences.
DAYS = ["Mo", "Tu", "We", "Th", "Fr", "Sa", "Su"]
JOURS = ["lundi", "mardi", "mercredi", "jeudi", "vendredi", "samedi", "dimanche"]
MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
FRENCH_MONTHS = {
    "janvier": 1, "jan": 1, "février": 2, "fév": 2, "fevrier": 2, "fev": 2, "mars": 3, "mar": 3, "avril": 4, "avr": 4, "mai": 5, "juin": 6,
    "juillet": 7, "juil": 7, "août": 8, "aout": 8, "septembre": 9, "sep": 9, "sept": 9, "octobre": 10, "oct": 10, "novembre": 11, "nov": 11,
    "décembre": 12, "déc": 12, "decembre": 12, "dec": 12,
}
ENGLISH_MONTHS = [
    "january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december",
]
ENGLISH_DAYS = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]
SAME = "Aucune différence détectée."
SPECIAL = "JOURS SPÉCIAUX ET FÉRIÉS"
ATTENTION_1 = "ATTENTION: L'établissement 1 (attendu) semble définitivement fermé, alors que l'établissement 2 (prédit) est ouvert."
ATTENTION_2 = "ATTENTION: L'établissement 1 (attendu) est ouvert, alors que l'établissement 2 (prédit) semble définitivement fermé."

# What counts as a day-and-time token, and as a date; both decide which rules are lost.
_TOKEN = r"([A-Z][a-z](?:\[[^\]]+\])?(?:[-,][A-Z][a-z])*)\s+([0-9:,-]+(?:\s*-\s*[0-9:]+)*)"
_DATE = r"\b\d{4}\s+[A-Za-z]{3}\s+\d{1,2}\b"
_SLOTS = "array<struct<debut: string, fin: string, occurence: array<int>>>"


def _no_slots() -> Column:
    return F.array().cast(_SLOTS)


def _day_index(name: Column) -> Column:
    """0 to 6, or null."""
    at = F.array_position(F.array(*map(F.lit, DAYS)), name)
    return F.when(at > 0, (at - 1).cast("int"))


def parse_days(text: Column) -> Column:
    """``Mo,We-Fr`` to day numbers in order of mention, each once; ranges wrap, unknown names are left out."""
    bare = F.regexp_replace(text, r"\[[^\]]*\]", "")

    def group(part: Column) -> Column:
        ends = F.split(part, "-", -1)
        a, b = _day_index(F.trim(ends[0])), _day_index(F.trim(F.try_element_at(ends, F.lit(2))))
        span = F.transform(F.sequence(F.lit(0), F.pmod(b - a, F.lit(7))), lambda k: F.pmod(a + k, F.lit(7)).cast("int"))
        one = F.when(a.isNotNull(), F.array(a)).otherwise(F.array().cast("array<int>"))
        return F.when(F.size(ends) == 1, one).when(a.isNotNull() & b.isNotNull(), span).otherwise(F.array().cast("array<int>"))

    return F.array_distinct(F.flatten(F.transform(F.split(bare, ","), lambda p: group(F.trim(p)))))


def parse_occurrence(text: Column) -> Column:
    """The numbers in the first brackets, or null."""
    inside = F.regexp_extract(text, r"\[([^\]]+)\]", 1)
    numbers = F.transform(F.split(inside, ","), lambda x: F.trim(x).try_cast("int"))
    return F.when((inside != "") & F.forall(numbers, lambda x: x.isNotNull()), numbers)


def parse_slots(text: Column, occurrence: Column) -> Column:
    """``09:00-12:00,14:00-18:00`` to slots; parts that are not two times are left out."""
    parts = F.transform(F.split(text, ","), lambda p: F.trim(p))
    good = F.filter(parts, lambda p: p.rlike(r"^\d{1,2}:\d{2}\s*-\s*\d{1,2}:\d{2}$"))
    slot = lambda p: F.struct(F.trim(F.substring_index(p, "-", 1)).alias("debut"), F.trim(F.substring_index(p, "-", -1)).alias("fin"), occurrence.alias("occurence"))
    return F.transform(good, slot).cast(_SLOTS)


def _segments(rule: Column) -> Column:
    """A rule's segments in order: day-and-time tokens, and what the gaps between them hold.

    Tokens are fenced by a control character; splitting there leaves gaps and tokens in turn. A gap that starts
    with a comma is skipped; another is cut where a comma comes before a day name.
    """
    cut = lambda g: F.transform(F.split(g, r",(?=\s*[A-Z][a-z])"), lambda s: F.regexp_replace(F.trim(s), r"\s*,\s*", ", "))

    def each(pieces: Column) -> Column:
        gap = lambda g: F.when((g == "") | (g.startswith(",") & (F.size(pieces) > 1)), F.array().cast("array<string>")).otherwise(cut(g))
        return F.flatten(F.transform(pieces, lambda p, i: F.when(i % 2 == 1, F.array(p)).otherwise(let(F.trim(p), gap))))

    return let(F.split(F.regexp_replace(rule, _TOKEN, "\u0001$0\u0001"), "\u0001", -1), each)


def _segment(text: Column) -> Column:
    def built(days: Column, rest: Column) -> Column:
        off = F.lower(rest).isin("off", "closed")
        slots = F.when(off, _no_slots()).otherwise(let(parse_occurrence(days), lambda o: parse_slots(rest, o)))
        return F.when((days != "") & (rest != ""), F.struct(parse_days(days).alias("days"), off.alias("off"), slots.alias("slots")))

    return let(F.regexp_extract(text, r"^(\S+)\s", 1), lambda d: let(F.trim(F.regexp_extract(text, r"^\S+\s+(.*)$", 1)), lambda r: built(d, r)))


def parse_osm(text: Column) -> Column:
    """An ``opening_hours`` string as a typed schedule.

    Fields: ``closed`` (the whole text says closed; then every day is), ``week`` (seven days from Monday:
    source_found, ouvert, creneaux), ``ph_found`` and ``ph_mode`` from the last PH rule in either case, ``special``
    (date to status). A rule holding a
    date is wholly a date rule: a range of dates is dropped, else its first date counts. Blank or null text has no rules.
    """
    holiday = lambda r: F.upper(r).startswith("PH")

    def day(k: Column, parts: Column) -> Column:
        """A day by the segments that name it: what follows the last one that says off, or nothing."""
        mine = F.filter(parts, lambda s: F.array_contains(s["days"], k))

        def said(of: Column) -> Column:
            last = F.size(of) - F.coalesce(F.array_position(F.transform(F.reverse(of), lambda s: s["off"]), True), F.lit(0)).cast("int")
            after = F.when(F.exists(of, lambda s: s["off"]), F.slice(of, last + 2, F.size(of))).otherwise(of)
            return let(after, lambda x: F.struct((F.size(of) > 0).alias("source_found"), (F.size(x) > 0).alias("ouvert"), F.flatten(F.transform(x, lambda s: s["slots"])).cast(_SLOTS).alias("creneaux")))

        return let(mine, said)

    def read(rules: Column, closed: Column) -> Column:
        weekly = F.filter(rules, lambda r: ~holiday(r) & ~r.rlike(_DATE))
        dated = F.filter(rules, lambda r: ~holiday(r) & r.rlike(_DATE) & ~r.rlike(_DATE + r"\s*-"))
        segments = F.filter(F.transform(F.flatten(F.transform(weekly, _segments)), _segment), lambda s: s.isNotNull())
        shut = F.struct(F.lit(True).alias("source_found"), F.lit(False).alias("ouvert"), _no_slots().alias("creneaux"))
        week = let(segments, lambda parts: F.transform(F.array(*map(F.lit, range(7))), lambda k: F.when(closed, shut).otherwise(day(k, parts))))
        ph = F.filter(rules, holiday)
        mode = lambda last: F.when(F.lower(last).contains("open"), "ouvert").otherwise("ferme")
        return let(ph, lambda found: F.struct(
            closed.alias("closed"), week.alias("week"), (F.size(found) > 0).alias("ph_found"), mode(F.try_element_at(found, F.lit(-1))).alias("ph_mode"), F.filter(F.transform(dated, _special), lambda s: s.isNotNull()).alias("special"),
        ))

    def cut(t: Column) -> Column:
        rules = F.filter(F.transform(F.split(t, ";"), lambda r: F.trim(r)), lambda r: r != "")
        return let(rules, lambda r: let(F.lower(F.trim(t)) == "closed", lambda closed: read(r, closed)))

    return let(F.coalesce(text, F.lit("")), cut)


def _special(rule: Column) -> Column:
    year, month, day = (F.regexp_extract(rule, r"\b(\d{4})\s+([A-Za-z]{3})\s+(\d{1,2})\b", k) for k in (1, 2, 3))
    number = F.array_position(F.array(*map(F.lit, MONTHS)), month)
    said = F.lower(F.regexp_extract(rule, r"(?i)\b\d{4}\s+[A-Za-z]{3}\s+\d{1,2}\s+(closed|open)", 1))
    status = F.when(said == "closed", "ferme").when(said == "open", "ouvert").when(F.lower(rule).contains("closed"), "ferme")
    date = F.concat_ws("-", year, F.lpad(number.cast("string"), 2, "0"), F.lpad(day, 2, "0"))
    return F.when((number > 0) & status.isNotNull(), F.struct(date.alias("date"), status.alias("status"), F.regexp_extract(rule, '"([^"]*)"', 1).alias("description")))


# -- printing -------------------------------------------------------------------------------------------------


def compress_days(days: Column) -> Column:
    """Day numbers as OSM ranges in week order: ``Mo-We,Fr``; two neighbours are a range too."""
    names = F.array(*map(F.lit, DAYS))

    def shown(d: Column) -> Column:
        start = F.filter(d, lambda x: ~F.array_contains(d, x - 1))
        end = F.filter(d, lambda x: ~F.array_contains(d, x + 1))
        one = lambda a, b: F.when(a == b, F.element_at(names, a + 1)).otherwise(F.concat(F.element_at(names, a + 1), F.lit("-"), F.element_at(names, b + 1)))
        return F.array_join(F.zip_with(start, end, one), ",")

    return let(F.array_sort(F.array_distinct(days)), shown)


def valid_time(text: Column) -> Column:
    """Exactly HH:MM from 00:00 to 23:59."""
    return text.rlike(r"^([01][0-9]|2[0-3]):[0-5][0-9]$")


def slot_text(slot: Column) -> Column:
    """``HH:MM-HH:MM`` with occurrences in brackets."""
    occurrence = F.when(F.size(slot["occurence"]) > 0, F.concat(F.lit("["), F.array_join(F.transform(slot["occurence"], lambda x: x.cast("string")), ","), F.lit("]"))).otherwise("")
    return F.concat(slot["debut"], F.lit("-"), slot["fin"], occurrence)


def print_week(week: Column) -> Column:
    """A week in OSM notation; null if no day has a source.

    All sourced days closed: ``off``. Else days that share a slot and occurrence are grouped, in the order in
    which the groups first appear, then the closed days.
    """
    entry = lambda occ, what: F.struct(occ.alias("occ"), what.alias("what"))

    def of_day(d: Column) -> Column:
        good = F.filter(d["creneaux"], lambda s: valid_time(s["debut"]) & valid_time(s["fin"]))
        said = F.transform(good, lambda s: entry(F.when(F.size(s["occurence"]) > 0, F.array_join(F.transform(s["occurence"], lambda x: x.cast("string")), ",")).otherwise(""), F.concat(s["debut"], F.lit("-"), s["fin"])))
        whole = lambda what: F.array(entry(F.lit(""), F.lit(what)))
        shown = lambda slots: F.when(F.size(slots) > 0, slots).when(d["ouvert"], whole("open")).otherwise(whole("off"))
        return F.when(~d["source_found"], F.array().cast("array<struct<occ: string, what: string>>")).otherwise(let(said, shown))

    def shown(entries: Column) -> Column:
        return let(F.array_distinct(F.flatten(entries)), lambda keys: grouped(entries, keys))

    def grouped(entries: Column, keys: Column) -> Column:
        open_ = F.filter(keys, lambda k: k["what"] != "off")

        def days(k: Column) -> Column:
            at = F.transform(entries, lambda e, i: F.when(F.array_contains(e, k), i.cast("int")))
            return compress_days(F.filter(at, lambda x: x.isNotNull()))

        part = lambda k: F.concat(days(k), F.when(k["occ"] != "", F.concat(F.lit("["), k["occ"], F.lit("]"))).otherwise(""), F.lit(" "), k["what"])
        closed = F.filter(keys, lambda k: k["what"] == "off")
        return F.when(F.size(keys) == 0, F.lit(None).cast("string")).when(F.size(open_) == 0, F.lit("off")).otherwise(F.array_join(F.transform(F.concat(open_, closed), part), "; "))

    return let(F.transform(week, of_day), shown)


# Parts of a text that are times of day, what a date is made of, and what stands between its parts.
_TIME = r"\d{1,2}\s*(?:h(?!\p{L})|:)\s*(?:\d{1,2})?"
_WORD = r"(\d+|\p{L}+)"
_BETWEEN = ["er", "st", "nd", "rd", "th", "e", "of", "de", "the", "le"]
_ISO, _MONTH_OF = r"(?<!\d)(\d{4})[-/. ](\d{1,2})[-/. ](\d{1,2})(?!\d)", r"(?<!\d)(\d{4})[-/.](\d{1,2})(?!\d)"
_SHORT, _COMPACT = r"(?<!\d)(\d{1,2})[-/.](\d{1,2})[-/.](\d{4}|\d{2})(?!\d)", r"(?<!\d)(\d{4})(\d{2})(\d{2})(?!\d)"
_OF_YEAR, _OF_MONTH, _YEAR, _DAY = r"(?<!\d)(\d{1,2})[-/.](\d{4})(?!\d)", r"(?<!\d)(\d{1,2})/(\d{1,2})(?!\d)", r"(?<!\d)([12]\d{3})(?!\d)", r"^(\d{1,2})$"
_YMD = "struct<y: int, m: int, d: int>"


def _month_numbers() -> Column:
    names = FRENCH_MONTHS | {"févr": 2, "fevr": 2, "juill": 7}  # abbreviations besides the fixed ones
    for k, name in enumerate(ENGLISH_MONTHS):
        names |= {name: k + 1, name[:3]: k + 1}
    return F.create_map(*(F.lit(x) for p in names.items() for x in p))


def _named_date(words: Column, year: Column) -> Column:
    """Year, month and day around the last month name among a text's words; null without one.

    The day is the number of at most two digits before the name, else the one after it. The year is the first number of
    four digits, else the number of two after the others, in the century nearest to ``year``.
    """
    small = lambda w: F.when(w.rlike(r"^\d{1,2}$"), w.try_cast("int"))
    at = lambda i: small(F.get(words, i))

    def near(k: Column, month: Column) -> Column:
        before, after, next_ = at(k - 1), at(k + 1), at(k + 2)
        four = F.get(F.filter(words, lambda w: w.rlike(r"^\d{4}$")), F.lit(0)).try_cast("int")
        two = F.when(before.isNotNull(), after).otherwise(next_)
        full = F.coalesce(four, _century(two, year))
        return F.struct(full.alias("y"), month.alias("m"), F.coalesce(before, after).alias("d")).cast(_YMD)

    months = F.transform(words, lambda w, i: F.struct(i.cast("int").alias("at"), _month_numbers()[w].alias("month")))
    return let(F.try_element_at(F.filter(months, lambda m: m["month"].isNotNull()), F.lit(-1)), lambda m: F.when(m.isNotNull(), near(m["at"], m["month"])))


def _century(two: Column, year: Column) -> Column:
    """A year of two digits within fifty years of ``year``; longer ones stay."""
    near = year - F.pmod(year, F.lit(100)) + two
    return F.when(two > 99, two).when(near >= year + 50, near - 100).when(near < year - 50, near + 100).otherwise(near)


def find_date(text: Column, today: Column | None = None) -> Column:
    """The date that a text names, or null.

    Looked for in this order: year-month-day; a French or English month name or abbreviation with the numbers near it;
    day, month and year in numbers; eight digits; year and month; month and day; a year; a text that is but a day. Of
    two numbers that could both be the month the first one is. Words around it, week days and times of day do not
    matter. What is lacking comes from ``today`` (the current date): its year, month, or day (at most the month's
    last). A text with an English week day alone is the next such day. A day that its month lacks is no date.
    """
    now = F.current_date() if today is None else today
    number = lambda t, pattern, k: F.regexp_extract(t, pattern, k).try_cast("int")
    none = F.lit(None).cast("int")

    def ymd(t: Column, pattern: str, y=none, m=none, d=none) -> Column:
        return F.when(t.rlike(pattern), F.struct(y.alias("y"), m.alias("m"), d.alias("d")).cast(_YMD))

    def month_first(t: Column, pattern: str, y: Column) -> Column:
        a, b = number(t, pattern, 1), number(t, pattern, 2)
        return ymd(t, pattern, y, F.when(a > 12, b).otherwise(a), F.when(a > 12, a).otherwise(b))

    def found(t: Column, year: Column) -> Column:
        words = F.filter(F.regexp_extract_all(t, F.lit(_WORD), 1), lambda w: ~w.isin(_BETWEEN))
        return F.coalesce(
            ymd(t, _ISO, *(number(t, _ISO, k) for k in (1, 2, 3))), let(words, lambda w: _named_date(w, year)), month_first(t, _SHORT, _century(number(t, _SHORT, 3), year)),
            ymd(t, _COMPACT, *(number(t, _COMPACT, k) for k in (1, 2, 3))), ymd(t, _MONTH_OF, number(t, _MONTH_OF, 1), number(t, _MONTH_OF, 2)), ymd(t, _OF_YEAR, number(t, _OF_YEAR, 2), number(t, _OF_YEAR, 1)),
            month_first(t, _OF_MONTH, none), ymd(t, _YEAR, number(t, _YEAR, 1)), ymd(t, _DAY, d=number(t, _DAY, 1)),
        )

    def dated(p: Column, day: Column) -> Column:
        y, m = F.coalesce(p["y"], F.year(day)), F.coalesce(p["m"], F.month(day))
        on = lambda d: F.try_to_date(F.concat_ws("-", F.lpad(y.cast("string"), 4, "0"), m.cast("string"), d.cast("string")), "yyyy-M-d")
        return F.when(p["d"].isNotNull(), on(p["d"])).otherwise(F.least(F.date_add(on(F.lit(1)), F.day(day) - 1), F.last_day(on(F.lit(1)))))

    def read(t: Column, day: Column) -> Column:
        coming = F.coalesce(*(F.when(t.rlike(rf"\b{name}\b|\b{name[:3]}\b"), F.next_day(F.date_sub(day, 1), name[:3])) for name in ENGLISH_DAYS))
        return let(found(t, F.year(day)), lambda p: F.when(p.isNotNull(), dated(p, day)).otherwise(coming))

    return let(now, lambda day: let(strip(F.regexp_replace(F.lower(text), _TIME, " ")), lambda t: read(t, day)))


def print_date(text: Column, today: Column | None = None) -> Column:
    """The date that a text names (see ``find_date``) as ``YYYY Mon DD``, or null."""
    shown = lambda d: F.concat(F.lpad(F.year(d).cast("string"), 4, "0"), F.lit(" "), F.element_at(F.array(*map(F.lit, MONTHS)), F.month(d)), F.lit(" "), F.lpad(F.day(d).cast("string"), 2, "0"))
    return let(find_date(text, today), shown)


# -- differences ----------------------------------------------------------------------------------------------


def slot_diff(a: Column, b: Column) -> Column:
    """``ajoutés: …`` and ``supprimés: …`` of two arrays of slot texts; empty if they hold the same."""
    part = lambda label, x: F.when(F.size(x) > 0, F.concat(F.lit(label), F.array_join(x, ", ")))
    return F.concat_ws(" | ", part("ajoutés: ", F.array_sort(F.array_except(b, a))), part("supprimés: ", F.array_sort(F.array_except(a, b))))


def day_diff(a: Column, b: Column) -> Column:
    """Change of one day: open state, then slots; a null day is closed without slots."""
    is_open = lambda d: F.coalesce(d["ouvert"], F.lit(False))
    texts = lambda d: F.coalesce(F.transform(d["creneaux"], slot_text), F.array().cast("array<string>"))
    word = lambda d: F.when(is_open(d), "ouvert").otherwise("fermé")
    slots = F.concat(F.lit("créneaux: "), F.nullif(let(F.struct(texts(a).alias("a"), texts(b).alias("b")), lambda t: slot_diff(t["a"], t["b"])), F.lit("")))
    return F.concat_ws(" | ", F.when(is_open(a) != is_open(b), F.concat(word(a), F.lit(" → "), word(b))), slots)


def week_diff(a: Column, b: Column) -> Column:
    """Changes of a week as ``jour: change`` joined by `` | ``."""
    days = F.zip_with(F.arrays_zip(a.alias("a"), b.alias("b")), F.array(*map(F.lit, JOURS)), lambda d, j: F.concat(j, F.lit(": "), F.nullif(day_diff(d["a"], d["b"]), F.lit(""))))
    return F.array_join(days, " | ")


def special_diff(a: Column, b: Column) -> Column:
    """Changes of special dates, maps of date to status, in date order."""
    dates = F.array_sort(F.array_union(F.map_keys(a), F.map_keys(b)))
    said = lambda d: F.when(a[d].isNull(), F.concat(d, F.lit(": ajouté ()"))).when(b[d].isNull(), F.concat(d, F.lit(": supprimé ()"))).when(a[d] != b[d], F.concat(d, F.lit(": "), a[d], F.lit(" → "), b[d]))
    return F.concat_ws(" | ", F.filter(F.transform(dates, said), lambda x: x.isNotNull()))


def compare(a: Column, b: Column) -> Column:
    """identical and differences of two schedules from ``parse_osm``: special dates first, then the week."""
    shut = lambda s: s["closed"] | (~F.exists(s["week"], lambda d: d["ouvert"] | (F.size(d["creneaux"]) > 0)) & (F.size(s["special"]) == 0))
    seen = lambda s: F.struct(shut(s).alias("shut"), dates_of(s["special"]).alias("dates"), s["week"].alias("week"))

    def found(p: Column) -> Column:
        x, y = p["a"], p["b"]
        labelled = lambda label, text: F.concat(F.lit(label), F.nullif(text, F.lit("")))
        return F.when(x["shut"] & y["shut"], "").otherwise(
            F.concat_ws(
                "\n",
                F.when(x["shut"] & ~y["shut"], ATTENTION_1).when(~x["shut"] & y["shut"], ATTENTION_2),
                labelled(f"{SPECIAL}: ", special_diff(x["dates"], y["dates"])),
                labelled("HORS_VACANCES_SCOLAIRES: ", week_diff(x["week"], y["week"])),
            )
        )

    text = let(F.struct(let(a, seen).alias("a"), let(b, seen).alias("b")), found)
    return let(text, lambda t: F.struct((t == "").alias("identical"), F.when(t == "", SAME).otherwise(t).alias("differences")))


def sorted_slots(day: Column) -> Column:
    """A day's slots by start, then occurrence (none first), then end."""
    keyed = F.transform(day["creneaux"], lambda s: F.struct(s["debut"].alias("debut"), F.coalesce(F.array_sort(s["occurence"]), F.array().cast("array<int>")).alias("by"), s["fin"].alias("fin"), s["occurence"].alias("occurence")))
    return F.transform(F.array_sort(keyed), lambda s: F.struct(s["debut"].alias("debut"), s["fin"].alias("fin"), s["occurence"].alias("occurence"))).cast(_SLOTS)


def dates_of(special: Column) -> Column:
    """Special dates as a map of date to status; of one date's entries the last wins."""
    return let(_last_wins(special), lambda some: F.map_from_entries(F.transform(some, lambda x: F.struct(x["date"], x["status"]))))


def _last_wins(special: Column) -> Column:
    return F.filter(special, lambda x, i: ~F.exists(F.slice(special, i + 2, F.size(special)), lambda y: y["date"] == x["date"]))


def atomic_differences(text: Column) -> Column:
    """How many single changes a difference text lists; its line count if it names none; 0 if empty."""
    items = lambda label: F.aggregate(F.regexp_extract_all(text, F.lit(label + r": (.*?)(?: \||$)"), 1), F.lit(0), lambda s, g: s + F.size(F.filter(F.split(g, ","), lambda x: F.trim(x) != "")))
    total = F.regexp_count(text, F.lit("→")) + items("ajoutés") + items("supprimés")
    return F.when(text == "", 0).when(total > 0, total).otherwise(F.size(F.split(text, "\n")))
