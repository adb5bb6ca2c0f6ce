"""The schedule functions for SQL: ``osm_parse``, ``osm_format``, ``schedule_diff`` and the table function ``osm_slots``.

The first three have SQL bodies, which the optimiser inlines like any expression: no Python runs. Their text is put
together here from the same parts as ``hours``. ``osm_slots`` is a Python table function over Arrow batches, for
lateral joins.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf

from venuegrid.functions import hours
from venuegrid.schema import DAY, SLOT

WEEK = f"array<{DAY}>"
SPECIAL = "array<struct<date: string, status: string, description: string>>"
PARSED = f"struct<closed: boolean, week: {WEEK}, ph_found: boolean, ph_mode: string, special: {SPECIAL}>"
CHANGES = "struct<identical: boolean, differences: string>"


def _text(value: str) -> str:
    """A string literal that takes every character as it is, quotes aside."""
    return " || ".join(f"r'{part}'" for part in value.split("'")).replace(" || ", " || \"'\" || ")


def _list(values: list[str]) -> str:
    return f"array({', '.join(map(_text, values))})"


def _let(name: str, value: str, body: str) -> str:
    """body with ``name`` for value, which is evaluated once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _either(*cases: tuple[str, str], other: str) -> str:
    return "CASE " + " ".join(f"WHEN {when} THEN {then}" for when, then in cases) + f" ELSE {other} END"


_NO_SLOTS = f"CAST(array() AS array<{SLOT}>)"
_NO_DAYS = "CAST(array() AS array<int>)"
_NO_TEXT = "CAST(array() AS array<string>)"
_DAY_NAMES = _list(hours.DAYS)


# -- notation to schedule ---------------------------------------------------------------------------------------


def _days(text: str) -> str:
    span = "transform(sequence(0, CAST(pmod(b - a, 7) AS int)), k -> CAST(pmod(a - 1 + k, 7) AS int))"
    found = _either(("size(ends) = 1", f"IF(a > 0, array(CAST(a - 1 AS int)), {_NO_DAYS})"), ("a > 0 AND b > 0", span), other=_NO_DAYS)
    second = f"coalesce(array_position({_DAY_NAMES}, trim(try_element_at(ends, 2))), 0)"
    group = _let("ends", "split(trim(p), '-', -1)", _let("a", f"array_position({_DAY_NAMES}, trim(ends[0]))", _let("b", second, found)))
    return f"array_distinct(flatten(transform(split(regexp_replace({text}, r'\\[[^\\]]*\\]', ''), ',', -1), p -> {group})))"


def _occurrence(days: str) -> str:
    inside = f"regexp_extract({days}, r'\\[([^\\]]+)\\]', 1)"
    numbers = _let("ns", "transform(split(inside, ',', -1), n -> try_cast(trim(n) AS int))", "IF(inside <> '' AND forall(ns, n -> n IS NOT NULL), ns, NULL)")
    return _let("inside", inside, numbers)


def _slots(text: str, occurrence: str) -> str:
    good = f"filter(transform(split({text}, ',', -1), p -> trim(p)), p -> p RLIKE r'^\\d{{1,2}}:\\d{{2}}\\s*-\\s*\\d{{1,2}}:\\d{{2}}$')"
    slot = "named_struct('debut', trim(substring_index(p, '-', 1)), 'fin', trim(substring_index(p, '-', -1)), 'occurence', occ)"
    return _let("occ", occurrence, f"CAST(transform({good}, p -> {slot}) AS array<{SLOT}>)")


def _segments(rule: str) -> str:
    """Day-and-time tokens and what lies between them; see ``hours``."""
    cut = "transform(split(g, r',(?=\\s*[A-Z][a-z])', -1), s -> regexp_replace(trim(s), r'\\s*,\\s*', ', '))"
    gap = _let("g", "trim(piece)", f"IF(g = '' OR (startswith(g, ',') AND size(pieces) > 1), {_NO_TEXT}, {cut})")
    fenced = f"regexp_replace({rule}, {_text(hours._TOKEN)}, concat(chr(1), '$0', chr(1)))"
    return _let("pieces", f"split({fenced}, chr(1), -1)", f"flatten(transform(pieces, (piece, i) -> IF(i % 2 = 1, array(piece), {gap})))")


def _segment(text: str) -> str:
    off = "lower(rest) IN ('off', 'closed')"
    found = f"named_struct('days', {_days('days')}, 'off', {off}, 'slots', IF({off}, {_NO_SLOTS}, {_slots('rest', _occurrence('days'))}))"
    kept = f"IF(days <> '' AND rest <> '', {found}, NULL)"
    return _let("days", f"regexp_extract({text}, r'^(\\S+)\\s', 1)", _let("rest", f"trim(regexp_extract({text}, r'^\\S+\\s+(.*)$', 1))", kept))


def _special(rule: str) -> str:
    part = lambda k: f"regexp_extract({rule}, r'\\b(\\d{{4}})\\s+([A-Za-z]{{3}})\\s+(\\d{{1,2}})\\b', {k})"
    said = f"lower(regexp_extract({rule}, r'(?i)\\b\\d{{4}}\\s+[A-Za-z]{{3}}\\s+\\d{{1,2}}\\s+(closed|open)', 1))"
    status = _let("said", said, _either(("said = 'closed'", "'ferme'"), ("said = 'open'", "'ouvert'"), (f"contains(lower({rule}), 'closed')", "'ferme'"), other="NULL"))
    date = f"concat_ws('-', {part(1)}, lpad(CAST(month AS string), 2, '0'), lpad({part(3)}, 2, '0'))"
    shown = f"IF(month > 0 AND status IS NOT NULL, named_struct('date', {date}, 'status', status, 'description', regexp_extract({rule}, '\"([^\"]*)\"', 1)), NULL)"
    return _let("month", f"array_position({_list(hours.MONTHS)}, {part(2)})", _let("status", status, shown))


def _parse(text: str) -> str:
    date = _text(hours._DATE)
    later = _text(hours._DATE + r"\s*-")
    weekly = f"filter(rules, r -> NOT startswith(upper(r), 'PH') AND NOT r RLIKE {date})"
    dated = f"filter(rules, r -> NOT startswith(upper(r), 'PH') AND r RLIKE {date} AND NOT r RLIKE ({later}))"
    segments = f"filter(transform(flatten(transform({weekly}, rule -> {_segments('rule')})), seg -> {_segment('seg')}), s -> s IS NOT NULL)"
    after = "IF(exists(mine, s -> s.off), slice(mine, size(mine) - CAST(array_position(transform(reverse(mine), s -> s.off), true) AS int) + 2, size(mine)), mine)"
    day = f"named_struct('source_found', size(mine) > 0, 'ouvert', size(live) > 0, 'creneaux', CAST(flatten(transform(live, s -> s.slots)) AS array<{SLOT}>))"
    day = _let("mine", "filter(parts, s -> array_contains(s.days, k))", _let("live", after, day))
    shut = f"named_struct('source_found', true, 'ouvert', false, 'creneaux', {_NO_SLOTS})"
    week = _let("parts", segments, f"transform(array(0, 1, 2, 3, 4, 5, 6), k -> IF(closed, {shut}, {day}))")
    mode = "IF(contains(lower(try_element_at(ph, -1)), 'open'), 'ouvert', 'ferme')"
    special = f"filter(transform({dated}, rule -> {_special('rule')}), s -> s IS NOT NULL)"
    whole = f"named_struct('closed', closed, 'week', {week}, 'ph_found', size(ph) > 0, 'ph_mode', {mode}, 'special', {special})"
    whole = _let("closed", "lower(trim(osm)) = 'closed'", _let("ph", "filter(rules, r -> startswith(upper(r), 'PH'))", whole))
    return _let("osm", f"coalesce({text}, '')", _let("rules", "filter(transform(split(osm, ';', -1), r -> trim(r)), r -> r <> '')", whole))


# -- schedule to notation ---------------------------------------------------------------------------------------


def _numbers(occurrence: str) -> str:
    return f"array_join(transform({occurrence}, x -> CAST(x AS string)), ',')"


def _compressed(days: str) -> str:
    name = lambda k: f"element_at({_DAY_NAMES}, {k} + 1)"
    ranges = f"zip_with(filter(ds, x -> NOT array_contains(ds, x - 1)), filter(ds, x -> NOT array_contains(ds, x + 1)), (x, y) -> IF(x = y, {name('x')}, concat({name('x')}, '-', {name('y')})))"
    return _let("ds", f"array_sort(array_distinct({days}))", f"array_join({ranges}, ',')")


def _format(week: str) -> str:
    valid = "s.debut RLIKE r'^([01][0-9]|2[0-3]):[0-5][0-9]$' AND s.fin RLIKE r'^([01][0-9]|2[0-3]):[0-5][0-9]$'"
    entry = lambda occ, what: f"named_struct('occ', {occ}, 'what', {what})"
    slot = entry(f"IF(size(s.occurence) > 0, {_numbers('s.occurence')}, '')", "concat(s.debut, '-', s.fin)")
    said = _either(("size(sl) > 0", "sl"), ("d.ouvert", f"array({entry(_text(''), _text('open'))})"), other=f"array({entry(_text(''), _text('off'))})")
    of_day = f"IF(NOT d.source_found, CAST(array() AS array<struct<occ: string, what: string>>), {_let('sl', f'transform(filter(d.creneaux, s -> {valid}), s -> {slot})', said)})"
    at = "filter(transform(entries, (e, i) -> IF(array_contains(e, key), CAST(i AS int), NULL)), x -> x IS NOT NULL)"
    part = f"concat({_compressed(at)}, IF(key.occ <> '', concat('[', key.occ, ']'), ''), ' ', key.what)"
    listed = f"array_join(transform(concat(filter(ks, k -> k.what <> 'off'), filter(ks, k -> k.what = 'off')), key -> {part}), '; ')"
    text = _either(("size(ks) = 0", "NULL"), ("NOT exists(ks, k -> k.what <> 'off')", "'off'"), other=listed)
    return _let("entries", f"transform({week}, d -> {of_day})", _let("ks", "array_distinct(flatten(entries))", text))


# -- differences ------------------------------------------------------------------------------------------------


def _week_changes(a: str, b: str) -> str:
    word = lambda d: f"IF(coalesce({d}.ouvert, false), 'ouvert', 'fermé')"
    shown = f"concat(s.debut, '-', s.fin, IF(size(s.occurence) > 0, concat('[', {_numbers('s.occurence')}, ']'), ''))"
    texts = lambda d: f"coalesce(transform({d}.creneaux, s -> {shown}), {_NO_TEXT})"
    part = lambda label, x, y: _let("gone", f"array_sort(array_except({x}, {y}))", f"IF(size(gone) > 0, concat('{label}: ', array_join(gone, ', ')), NULL)")
    slots = _let("t1", texts("d.a"), _let("t2", texts("d.b"), f"concat_ws(' | ', {part('ajoutés', 't2', 't1')}, {part('supprimés', 't1', 't2')})"))
    state = f"IF(coalesce(d.a.ouvert, false) <> coalesce(d.b.ouvert, false), concat({word('d.a')}, ' → ', {word('d.b')}), NULL)"
    change = f"concat_ws(' | ', {state}, concat('créneaux: ', nullif({slots}, '')))"
    days = f"transform({_list(hours.JOURS)}, (j, i) -> {_let('d', f'named_struct({_text("a")}, {a}[i], {_text("b")}, {b}[i])', f'concat(j, {_text(": ")}, nullif({change}, {_text("")}))')})"
    return f"array_join({days}, ' | ')"


def _diff(a: str, b: str) -> str:
    dates = lambda p: f"map_from_entries(transform(filter({p}.special, (x, i) -> NOT exists(slice({p}.special, i + 2, size({p}.special)), y -> y.date = x.date)), x -> struct(x.date, x.status)))"
    shut = lambda p: f"({p}.closed OR (NOT exists({p}.week, d -> d.ouvert OR size(d.creneaux) > 0) AND size({p}.special) = 0))"
    side = lambda p: f"named_struct('shut', {shut(p)}, 'dates', {dates(p)}, 'week', {p}.week)"
    of_date = _either(("x.dates[k] IS NULL", "concat(k, ': ajouté ()')"), ("y.dates[k] IS NULL", "concat(k, ': supprimé ()')"), ("x.dates[k] <> y.dates[k]", "concat(k, ': ', x.dates[k], ' → ', y.dates[k])"), other="NULL")
    special = f"concat_ws(' | ', filter(transform(array_sort(array_union(map_keys(x.dates), map_keys(y.dates))), k -> {of_date}), t -> t IS NOT NULL))"
    attention = _either(("x.shut AND NOT y.shut", _text(hours.ATTENTION_1)), ("NOT x.shut AND y.shut", _text(hours.ATTENTION_2)), other="NULL")
    lines = f"concat_ws(chr(10), {attention}, concat({_text(hours.SPECIAL + ': ')}, nullif({special}, '')), concat('HORS_VACANCES_SCOLAIRES: ', nullif({_week_changes('x.week', 'y.week')}, '')))"
    found = _let("t", f"IF(x.shut AND y.shut, '', {lines})", f"named_struct('identical', t = '', 'differences', IF(t = '', {_text(hours.SAME)}, t))")
    return _let("p", _parse(a), _let("x", side("p"), _let("q", _parse(b), _let("y", side("q"), found))))


# -- slots as a table -------------------------------------------------------------------------------------------

_PIECE = re.compile(hours._TOKEN)
_DATED = re.compile(hours._DATE)
_TIMES = re.compile(r"^\d{1,2}:\d{2}\s*-\s*\d{1,2}:\d{2}$", re.A)


def _named_days(text: str) -> list[int]:
    found: list[int] = []
    for part in re.sub(r"\[[^\]]*\]", "", text).split(","):
        ends = [hours.DAYS.index(e.strip(" ")) if e.strip(" ") in hours.DAYS else None for e in part.strip(" ").split("-")]
        if len(ends) == 1 and ends[0] is not None:
            found.append(ends[0])
        elif len(ends) > 1 and ends[0] is not None and ends[1] is not None:
            found += [(ends[0] + k) % 7 for k in range((ends[1] - ends[0]) % 7 + 1)]
    return list(dict.fromkeys(found))


def _pieces(rule: str) -> Iterator[str]:
    parts, at = [], 0
    for m in _PIECE.finditer(rule):
        parts += [rule[at : m.start()], m.group()]
        at = m.end()
    parts.append(rule[at:])
    for i, part in enumerate(parts):
        gap = part.strip(" ")
        if i % 2:
            yield part
        elif gap and not (gap.startswith(",") and len(parts) > 1):
            yield from (re.sub(r"\s*,\s*", ", ", s.strip(" "), flags=re.A) for s in re.split(r",(?=\s*[A-Z][a-z])", gap, flags=re.A))


def slots_of(text: str | None) -> Iterator[tuple[int, str, str, str, list[int] | None]]:
    """day (0 is Monday), jour, debut, fin and occurence of a notation's weekly slots, by day and in order of mention."""
    days: list[list[tuple[str, str, list[int] | None]]] = [[] for _ in hours.DAYS]
    rules = [r.strip(" ") for r in (text or "").split(";")]
    for rule in rules:
        if rule.upper().startswith("PH") or _DATED.search(rule):
            continue
        for piece in _pieces(rule):
            said = re.match(r"(\S+)\s+(.*)$", piece, re.A)
            rest = said.group(2).strip(" ") if said else ""
            if not rest:
                continue
            inside = re.search(r"\[([^\]]+)\]", said.group(1))
            numbers = [n.strip(" ") for n in inside.group(1).split(",")] if inside else []
            occurrence = [int(n) for n in numbers] if numbers and all(re.fullmatch(r"[+-]?[0-9]{1,9}", n) for n in numbers) else None
            slots = [tuple(t.strip(" ") for t in p.split("-")) for p in (p.strip(" ") for p in rest.split(",")) if _TIMES.match(p)]
            for k in _named_days(said.group(1)):
                if rest.lower() in ("off", "closed"):
                    days[k].clear()
                else:
                    days[k] += [(*s, occurrence) for s in slots]
    for k, slots in enumerate(days):
        yield from ((k, hours.JOURS[k], *s) for s in slots)


@lru_cache(1 << 16)
def _remembered(text: str | None) -> tuple:
    """As ``slots_of``; notations repeat a lot."""
    return tuple(slots_of(text))


@udtf(returnType="day: int, jour: string, debut: string, fin: string, occurence: array<int>", useArrow=True)
class osm_slots:  # noqa: N801  its name in SQL
    """The weekly slots of an ``opening_hours`` text, a row each; none for a null text or one without slots."""

    def eval(self, text: str) -> Iterator[tuple]:
        yield from _remembered(text)


def register(spark: SparkSession) -> None:
    """Make the four functions known to a session's SQL."""
    for head, kind, body in (
        ("osm_parse(notation string)", PARSED, _parse("notation")),
        (f"osm_format(week {WEEK})", "string", _format("week")),
        ("schedule_diff(expected string, found string)", CHANGES, _diff("expected", "found")),
    ):
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURNS {kind} RETURN {body}")
    spark.udtf.register("osm_slots", osm_slots)
