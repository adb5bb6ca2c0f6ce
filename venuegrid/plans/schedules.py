"""Registered queries of schedule documents, filtering, extraction outcomes, report, settings and the store, with their SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from venuegrid.functions import documents, hours, sql, text, typed
from venuegrid.operators import state, stats
from venuegrid.operators.distinct import once_each
from venuegrid.plans import pipeline, report
from venuegrid.plans.catalog import LINES_SQL, query
from venuegrid.plans.prompt import prompt
from venuegrid.plans.views import results, table, venues
from venuegrid.sources.tables import Store, shared_folder
from venuegrid.streaming import progress

# -- schedule documents ----------------------------------------------------------------------------------------

#: Opening hours of an order in five notations, and the two times in them.
OPENS, CLOSES = "lpad(CAST(o_orderkey % 4 + 7 AS VARCHAR), 2, '0')", "lpad(CAST(o_custkey % 5 + 12 AS VARCHAR), 2, '0')"
SPAN = f"{OPENS} || ':00-' || {CLOSES} || ':30'"


def _notated(spark: SparkSession, d: str) -> DataFrame:
    k, two = F.col("o_orderkey"), lambda c: F.lpad(c.cast("string"), 2, "0")
    span = F.concat(two(k % 4 + 7), F.lit(":00-"), two(F.col("o_custkey") % 5 + 12), F.lit(":30"))
    osm = (
        F.when(k % 5 == 0, F.concat(F.lit("Mo-Fr "), span, F.lit("; Sa 10:15-12:45; PH off")))
        .when(k % 5 == 1, F.concat(F.lit("Mo[1,3] "), span, F.lit("; ph open")))
        .when(k % 5 == 2, F.concat(F.lit("We-Su "), span, F.lit(",20:00-22:00; 2024 Dec 25 closed")))
        .when(k % 5 == 3, F.lit(" Closed"))
        .otherwise("")
    )
    return table(spark, d, "orders").select("o_orderkey", (k % 5).alias("k"), osm.alias("osm"), span.alias("span"))


@query(f"""SELECT o_orderkey, CASE WHEN o_orderkey % 5 IN (0, 1) THEN {OPENS} || ':00' END AS lundi, CASE o_orderkey % 5 WHEN 0 THEN '12:45' WHEN 2 THEN {CLOSES} || ':30' END AS samedi,
CASE o_orderkey % 5 WHEN 1 THEN '[1,3]' END AS occurence, CASE WHEN o_orderkey % 5 = 4 THEN NULL ELSE o_orderkey % 5 = 3 END AS ferme, CASE o_orderkey % 5 WHEN 1 THEN 'ouvert' WHEN 4 THEN NULL ELSE 'ferme' END AS feries,
CASE WHEN o_orderkey % 5 = 4 THEN NULL ELSE o_orderkey % 5 IN (0, 1, 2) END AS feries_connus, CASE o_orderkey % 5 WHEN 2 THEN 'ferme' END AS noel, CASE WHEN o_orderkey % 5 = 4 THEN NULL ELSE 'Période hors vacances scolaires' END AS periode FROM orders""")  # fmt: skip
def schedule_document(spark: SparkSession, d: str) -> DataFrame:
    """The five-period document of varied notations."""
    at = lambda path: F.get_json_object("doc", f"$.horaires_ouverture.{path}")
    week = "periodes.hors_vacances_scolaires"
    made = lambda notations: notations.withColumn("doc", documents.document(F.col("osm"))).select(
        "osm", at(f"{week}.horaires.lundi.creneaux[0].debut").alias("lundi"), at(f"{week}.horaires.samedi.creneaux[0].fin").alias("samedi"), at(f"{week}.horaires.lundi.creneaux[0].occurence").alias("occurence"),
        at("extraction_info.permanently_closed").cast("boolean").alias("ferme"), at("periodes.jours_feries.mode").alias("feries"), at("periodes.jours_feries.source_found").cast("boolean").alias("feries_connus"),
        at("periodes.jours_feries.horaires_specifiques.2024-12-25").alias("noel"), at(f"{week}.label").alias("periode"),
    )
    return once_each(_notated(spark, d).select("o_orderkey", "osm"), ["osm"], made).drop("osm")


ROUND_TRIP_SQL = f"""SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 'Mo-Fr ' || {SPAN} || '; Sa 10:15-12:45' WHEN 1 THEN 'Mo[1,3] ' || {SPAN} WHEN 2 THEN 'We-Su ' || {SPAN} || '; We-Su 20:00-22:00' END AS semaine,
CASE o_orderkey % 5 WHEN 0 THEN 'PH off' WHEN 1 THEN 'PH open' WHEN 2 THEN '2024 Dec 25 off' END AS feries, CASE o_orderkey % 5 WHEN 3 THEN 'off' END AS general FROM orders"""


def _printed_back(rows: DataFrame, printed: Callable[[Column], Column]) -> DataFrame:
    back = once_each(rows, ["osm"], lambda notations: notations.select("osm", printed(F.col("osm")).alias("back")))
    return back.select("o_orderkey", F.col("back")["hors_vacances_scolaires"].alias("semaine"), F.col("back")["jours_feries"].alias("feries"), F.col("back")["general"].alias("general"))


@query(ROUND_TRIP_SQL)
def typed_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """§1.3: notations to typed documents and back, by period; no JSON in between."""
    return _printed_back(_notated(spark, d), lambda osm: typed.to_osm(typed.from_osm(osm)))


@query(ROUND_TRIP_SQL)
def document_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Documents printed as OSM notation again, by period."""
    return _printed_back(_notated(spark, d), lambda osm: documents.to_osm(documents.document(osm)))


JOURS_SQL = "['lundi', 'mardi', 'mercredi', 'jeudi', 'vendredi']"


DIFFERENCES_SQL = f"""WITH p AS (SELECT p_partkey, p_partkey % 5 AS k, lpad(CAST(p_size % 4 + 7 AS VARCHAR), 2, '0') || ':00-12:00' AS s FROM part)
SELECT p_partkey, k = 0 AS identical, CASE k WHEN 0 THEN '{hours.SAME}' WHEN 1 THEN 'HORS_VACANCES_SCOLAIRES: vendredi: ouvert → fermé | créneaux: supprimés: ' || s
WHEN 2 THEN '{hours.SPECIAL}: 2025-05-01: ajouté ()' WHEN 3 THEN '{hours.ATTENTION_2.replace("'", "''")}' || chr(10) || 'HORS_VACANCES_SCOLAIRES: ' || array_to_string(list_transform({JOURS_SQL}, lambda j: j || ': ouvert → fermé | créneaux: supprimés: ' || s), ' | ')
ELSE 'HORS_VACANCES_SCOLAIRES: ' || array_to_string(list_transform({JOURS_SQL}, lambda j: j || ': créneaux: ajoutés: 14:00-18:00'), ' | ') END AS differences FROM p"""


def _part_pairs(spark: SparkSession, d: str) -> DataFrame:
    k, span = F.col("p_partkey") % 5, F.concat(F.lpad((F.col("p_size") % 4 + 7).cast("string"), 2, "0"), F.lit(":00-12:00"))
    said = lambda *parts: F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))
    other = F.when(k == 0, said("Mo,Tu,We,Th,Fr ", span)).when(k == 1, said("Mo-Th ", span)).when(k == 2, said("Mo-Fr ", span, "; 2025 May 01 closed")).when(k == 3, F.lit("closed")).otherwise(said("Mo-Fr ", span, ",14:00-18:00"))
    return table(spark, d, "part").select("p_partkey", said("Mo-Fr ", span).alias("a"), other.alias("b"))


@query(DIFFERENCES_SQL)
def typed_differences(spark: SparkSession, d: str) -> DataFrame:
    """§1.3, C1-C7: differences of typed documents."""
    made = lambda pairs: pairs.withColumns({"x": typed.from_osm(F.col("a")), "y": typed.from_osm(F.col("b"))}).select("a", "b", typed.compare(F.col("x"), F.col("y")).alias("c"))
    return once_each(_part_pairs(spark, d), ["a", "b"], made).select("p_partkey", "c.*")


@query(DIFFERENCES_SQL)
def document_differences(spark: SparkSession, d: str) -> DataFrame:
    """Differences of whole documents of five kinds."""
    made = lambda pairs: pairs.withColumns({"x": documents.document(F.col("a")), "y": documents.document(F.col("b"))}).select("a", "b", documents.compare(F.col("x"), F.col("y")).alias("c"))
    return once_each(_part_pairs(spark, d), ["a", "b"], made).select("p_partkey", "c.*")


@query(f"""SELECT s_suppkey, CASE s_suppkey % 5 WHEN 0 THEN 'Identique' WHEN 1 THEN 'Différent' WHEN 2 THEN 'Erreur de comparaison' WHEN 3 THEN 'Identique' ELSE 'Différent' END AS status,
CAST(CASE s_suppkey % 5 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 1 WHEN 3 THEN 0 ELSE 4 END AS INTEGER) AS diff_count FROM supplier""")  # fmt: skip
def evaluation_scores(spark: SparkSession, d: str) -> DataFrame:
    """Predicted against true hours."""
    k, hour = F.col("s_suppkey") % 5, F.concat(F.lpad((F.col("s_suppkey") % 10 + 8).cast("string"), 2, "0"), F.lit(":00"))
    truth = F.when(k == 3, "").otherwise(F.concat(F.lit("Tu "), hour, F.lit("-19:00")))
    guess = F.when(k.isin(2, 3), F.lit(None).cast("string")).when(k == 0, F.concat(F.lit("Tu[]  "), hour, F.lit("-19:00"))).when(k == 1, F.concat(F.lit("Tu "), hour, F.lit("-20:00"))).otherwise("Tu off; We 09:00-10:00")
    guess = F.when(k == 0, truth).otherwise(guess)
    rows = table(spark, d, "supplier").select("s_suppkey", guess.alias("p"), truth.alias("t"))
    made = lambda pairs: pairs.select("p", "t", documents.score(F.col("p"), F.col("t")).alias("s"))
    return once_each(rows, ["p", "t"], made).select("s_suppkey", "s.status", "s.diff_count")


@query("""SELECT p_partkey, array_to_string(list_sort([lpad(CAST(p_size % 12 + 6 AS VARCHAR), 2, '0') || ':00-23:00', '09:30-23:15', lpad(CAST(p_partkey % 10 + 8 AS VARCHAR), 2, '0') || ':15-23:30']), ',') AS slots, p_partkey % 3 = 0 AS sourced FROM part""")
def sorted_slots(spark: SparkSession, d: str) -> DataFrame:
    """A day's slots in order, and whether its period has a source."""
    at = lambda n, low, minutes: F.concat(F.lpad((F.col(n) % (12 if n == "p_size" else 10) + low).cast("string"), 2, "0"), F.lit(f":{minutes}"))
    slot = lambda a, b: F.struct(a.alias("debut"), F.lit(b).alias("fin"))
    day = F.struct((F.col("p_partkey") % 3 == 0).alias("source_found"), F.lit(True).alias("ouvert"), F.array(slot(at("p_size", 6, "00"), "23:00"), slot(F.lit("09:30"), "23:15"), slot(at("p_partkey", 8, "15"), "23:30")).alias("creneaux"))
    period = F.to_json(F.struct(F.lit(True).alias("source_found"), F.struct(day.alias(" Lundi")).alias("horaires")))
    rows = table(spark, d, "part").select("p_partkey", period.alias("period")).withColumn("day", documents.week(F.col("period"))[0])
    return rows.select("p_partkey", F.array_join(F.transform(hours.sorted_slots(F.col("day")), hours.slot_text), ",").alias("slots"), documents.has_source(F.col("period")).alias("sourced"))


# -- SQL functions, dates in words ------------------------------------------------------------------------------


def _by_sql(spark: SparkSession, rows: DataFrame, inputs: list[str], query_: str) -> DataFrame:
    """rows joined with what a query over the view ``notations`` of their distinct inputs gives."""
    sql.register(spark)

    def made(each: DataFrame) -> DataFrame:
        each.createOrReplaceTempView("notations")
        return spark.sql(query_)

    return once_each(rows, inputs, made)


@query(f"""SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 'Mo-Fr ' || {SPAN} || '; Sa 10:15-12:45' WHEN 1 THEN 'Mo[1,3] ' || {SPAN} WHEN 2 THEN 'We-Su ' || {SPAN} || '; We-Su 20:00-22:00' WHEN 3 THEN 'off' END AS semaine,
o_orderkey % 5 IN (0, 1) AS feries, CASE WHEN o_orderkey % 5 = 2 THEN '2024-12-25' END AS date FROM orders""")  # fmt: skip
def sql_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """§2.11: notations parsed and printed by SQL functions that the optimiser inlines."""
    read = "SELECT osm, osm_format(p.week) AS semaine, p.ph_found AS feries, get(p.special, 0).date AS date FROM (SELECT osm, osm_parse(osm) AS p FROM notations)"
    return _by_sql(spark, _notated(spark, d).select("o_orderkey", "osm"), ["osm"], read).drop("osm")


@query(DIFFERENCES_SQL)
def sql_schedule_diff(spark: SparkSession, d: str) -> DataFrame:
    """§2.11: differences of two notations in SQL."""
    compared = "SELECT a, b, c.identical, c.differences FROM (SELECT a, b, schedule_diff(a, b) AS c FROM notations)"
    return _by_sql(spark, _part_pairs(spark, d), ["a", "b"], compared).drop("a", "b")


@query(f"""WITH o AS (SELECT o_orderkey, o_orderkey % 5 AS k, {OPENS} || ':00' AS a, {CLOSES} || ':30' AS b FROM orders)
SELECT o_orderkey, CAST(day AS INTEGER) AS day, a AS debut, b AS fin, CASE k WHEN 1 THEN '1,3' ELSE '' END AS occurence FROM o, range(7) t(day) WHERE (k = 0 AND day < 5) OR (k = 1 AND day = 0) OR (k = 2 AND day > 1)
UNION ALL SELECT o_orderkey, 5, '10:15', '12:45', '' FROM o WHERE k = 0 UNION ALL SELECT o_orderkey, CAST(day AS INTEGER), '20:00', '22:00', '' FROM o, range(2, 7) t(day) WHERE k = 2""")  # fmt: skip
def osm_slot_rows(spark: SparkSession, d: str) -> DataFrame:
    """§2.11: the slots of notations as rows, by a table function in a lateral join."""
    slots = "SELECT osm, s.day, s.debut, s.fin, array_join(transform(coalesce(s.occurence, array()), x -> CAST(x AS string)), ',') AS occurence FROM notations, LATERAL osm_slots(osm) AS s"
    return _by_sql(spark, _notated(spark, d).select("o_orderkey", "osm"), ["osm"], slots).drop("osm")


MONTHS_SQL = "['janvier', 'février', 'mars', 'avril', 'mai', 'juin', 'juillet', 'août', 'septembre', 'octobre', 'novembre', 'décembre']"


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 4 AND strftime(o_orderdate, '%m-%d') = '02-29' THEN NULL WHEN o_orderkey % 7 = 6 THEN NULL
WHEN o_orderkey % 7 = 4 THEN '1998' || strftime(o_orderdate, ' %b %d') ELSE strftime(o_orderdate, '%Y %b %d') END AS printed FROM orders""")
def free_dates(spark: SparkSession, d: str) -> DataFrame:
    """Dates in words, numbers and mixtures, with other words around them, of seven kinds."""
    at, k = F.col("o_orderdate"), F.col("o_orderkey") % 7
    french = F.element_at(F.array(*(F.lit(m) for m in ("janvier", "Févr.", "mars", "avril", "mai", "juin", "juil.", "AOÛT", "sept.", "octobre", "novembre", "déc."))), F.month(at))
    english = F.date_format(at, "MMMM")
    day, year = F.day(at).cast("string"), F.year(at).cast("string")
    said = lambda *parts: F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))
    text_ = (
        F.when(k == 0, said("Fermé le lundi ", day, " ", french, " ", year, " de 10h30 à 12:00"))
        .when(k == 1, said("closed ", english, " ", day, "th, ", year))
        .when(k == 2, F.date_format(at, "MM/dd/yyyy"))
        .when(k == 3, said(day, " ", english, " ", F.date_format(at, "yy")))
        .when(k == 4, said("le ", day, " ", french))
        .when(k == 5, F.date_format(at, "yyyyMMdd"))
        .otherwise("ouvert de 10:00 à 12h")
    )
    return table(spark, d, "orders").select("o_orderkey", hours.print_date(text_, F.lit("1998-03-31").cast("date")).alias("printed"))


# -- filtering, prompts ----------------------------------------------------------------------------------------


#: Letters whose shares in a text are its vector in the query below, and the least inner product of a part that stays.
LETTERS, NEAR = "aeiou", 0.049


def _letter_shares(text_: Column | str) -> Column:
    content = F.lower(F.col(text_) if isinstance(text_, str) else text_)
    return F.transform(F.array(*map(F.lit, LETTERS)), lambda c: (F.length(content) - F.length(F.replace(content, c, F.lit("")))).cast("double") / F.length(content))


SHARES_SQL = f"list_transform({list(LETTERS)}, lambda c: CAST(length(lower(content)) - length(replace(lower(content), c, '')) AS DOUBLE) / length(content))"


@query(rf"""WITH {LINES_SQL}, b AS (SELECT *, CASE WHEN kind <> coalesce(lag(kind) OVER w, 'empty') THEN 1 ELSE 0 END AS new FROM k WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
s AS (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS block FROM b),
c AS (SELECT doc_id, min(i) AS a, max(i) AS z, string_agg(line, chr(10) ORDER BY i) AS content FROM s WHERE kind <> 'empty' GROUP BY doc_id, block),
p AS (SELECT {SHARES_SQL} AS q FROM (SELECT unnest(['horaires', 'ouvert le lundi']) AS content)), v AS (SELECT doc_id, a, z, {SHARES_SQL} AS e FROM c),
h AS (SELECT DISTINCT doc_id, unnest(range(greatest(a - 1, 0), z + 2)) AS i FROM v, p WHERE e[1] * q[1] + e[2] * q[2] + e[3] * q[3] + e[4] * q[4] + e[5] * q[5] >= {NEAR}),
g AS (SELECT k.doc_id, k.i, CASE WHEN k.i - lag(k.i) OVER (PARTITION BY k.doc_id ORDER BY k.i) > 1 THEN chr(10) || line ELSE line END AS shown FROM h JOIN k ON h.doc_id = k.doc_id AND h.i = k.i),
t AS (SELECT doc_id, string_agg(shown, chr(10) ORDER BY i) AS filtered FROM g GROUP BY 1)
SELECT d.doc_id, length(coalesce(filtered, '')) AS size, md5(coalesce(filtered, '')) AS digest FROM documents d LEFT JOIN t ON d.doc_id = t.doc_id""")  # fmt: skip
def page_filter(spark: SparkSession, d: str) -> DataFrame:
    """Of every text the blocks near a phrase by an embedding of letter shares, and the lines around them."""
    phrases = spark.createDataFrame([(p,) for p in text.phrase_list("horaires ;; ouvert le lundi;;")], "p string").select(_letter_shares("p").alias("vector"))
    found = text.filter_pages(table(spark, d, "documents"), phrases, _letter_shares, chunk_size=1, threshold=NEAR)
    return found.select("doc_id", F.length("filtered").cast("long").alias("size"), F.md5("filtered").alias("digest"))


@query("""SELECT c_custkey, 'Établissement : ' || c_name || chr(10) || 'Type : ' || c_mktsegment || chr(10) || chr(10) || 'Page :' || chr(10) || '<<<' || chr(10) || c_nationkey || chr(10) || '>>>' || chr(10) || chr(10)
|| CASE WHEN c_custkey % 2 = 0 THEN 'Le document suit ce schéma :' || chr(10) || '{"a": 1}' || chr(10) ELSE 'Le document a cinq périodes, comme décrit.' END AS asked, 1998 AS year, 'system,user' AS roles FROM customer""")  # fmt: skip
def prompts(spark: SparkSession, d: str) -> DataFrame:
    """The messages for a model."""
    made = lambda schema: prompt(F.col("c_mktsegment"), F.col("c_name"), F.col("c_nationkey").cast("string"), F.lit(1998), schema)
    rows = table(spark, d, "customer").select("c_custkey", F.when(F.col("c_custkey") % 2 == 0, made('{"a": 1}')).otherwise(made(None)).alias("m"))
    user, system = F.get_json_object("m", "$[1].content"), F.get_json_object("m", "$[0].content")
    roles = F.concat_ws(",", F.get_json_object("m", "$[0].role"), F.get_json_object("m", "$[1].role"))
    return rows.select("c_custkey", user.alias("asked"), F.regexp_extract(system, r"sans année est de (\d+)\.", 1).cast("int").alias("year"), roles.alias("roles"))


@query(r"""SELECT page_id, regexp_matches(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+') AS valid, regexp_extract(regexp_replace(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*', ''), '([^/?#]*)([?#].*)?$', 1) AS name FROM pages""")
def url_names(spark: SparkSession, d: str) -> DataFrame:
    """Valid urls and their file names."""
    return table(spark, d, "pages").select("page_id", text.valid_url(F.col("url")).alias("valid"), text.file_name(F.col("url")).alias("name"))


@query("""SELECT count(*) FILTER (props <> '') AS texts_processed, count(*) FILTER (props <> '' AND event_type <> 'error') AS texts_successful, CAST(sum(length(props) - length(translate(props, '_*`+', ''))) AS BIGINT) AS chars_replaced FROM events""")
def cleaning_counters(spark: SparkSession, d: str) -> DataFrame:
    """Counters of cleaning."""
    rows = table(spark, d, "events").withColumn("after", F.when(F.col("event_type") == "error", "").otherwise(F.col("props")))
    return text.cleaning_counters(rows, "props", "after")


# -- extraction outcomes ---------------------------------------------------------------------------------------


@query("""WITH e AS (SELECT event_id, event_id % 6 AS k FROM events), f AS (SELECT *, CASE k WHEN 0 THEN 'Erreur LLM: quota ' || event_id WHEN 1 THEN 'Erreur LLM: reçu ''None'' - réponse vide' WHEN 2 THEN 'Erreur LLM: reçu '''' - réponse inattendue' WHEN 3 THEN 'Erreur HTTP 500' END AS wrong FROM e)
SELECT event_id, coalesce(wrong, CASE k WHEN 4 THEN '{}' ELSE 'document' END) AS json, coalesce(wrong, CASE k WHEN 4 THEN '' ELSE 'hors_vacances_scolaires: Mo 09:00-12:00' END) AS osm, CASE WHEN wrong IS NULL THEN '' ELSE '[10:20:30] LLM: ' || wrong END AS errors FROM f""")  # fmt: skip
def extraction_outcomes(spark: SparkSession, d: str) -> DataFrame:
    """What a model's answer or its failure leaves in a result."""
    k = F.col("event_id") % 6
    content = F.when(k == 2, "").when(k == 3, "Erreur HTTP 500").when(k == 4, "pas de JSON").when(k == 5, documents.document(F.lit("Mo 09:00-12:00")))
    failure = F.when(k == 0, F.concat(F.lit("quota "), F.col("event_id").cast("string")))
    none = F.from_json(F.lit("{}"), "map<string,string>")
    answers = table(spark, d, "events").select("event_id", content.alias("content"), failure.alias("failure"))
    rows = answers.select("event_id", documents.outcome(F.col("content"), F.col("failure"), F.lit("parc"), none, F.lit("2025-01-01").cast("date")).alias("r"))
    errors = documents.outcome_errors(F.lit(""), F.col("r"), F.lit("2025-01-01 10:20:30").cast("timestamp"))
    json = F.when(F.col("r.json").startswith('{"horaires_ouverture"'), "document").otherwise(F.col("r.json"))
    return rows.select("event_id", json.alias("json"), F.col("r.osm").alias("osm"), errors.alias("errors"))


@query("""SELECT event_id, CASE event_id % 5 WHEN 0 THEN '[10:20:30] LLM: Erreur a' || event_id WHEN 1 THEN '[10:20:30] LLM: Erreur a | [10:20:30] OSM: Erreur b' || event_id WHEN 2 THEN '[09:00:00] URL: x | [10:20:30] OSM: Erreur c'
WHEN 3 THEN '[09:00:00] LLM: Erreur a' ELSE '' END AS errors FROM events""")
def outcome_error_pairs(spark: SparkSession, d: str) -> DataFrame:
    """An answer's two errors join the chain, an equal one once, one that is there already not again."""
    k, n = F.col("event_id") % 5, F.col("event_id").cast("string")
    json = F.when(k == 0, F.concat(F.lit("Erreur a"), n)).when(k.isin(1, 3), "Erreur a").otherwise("{}")
    osm = F.when(k == 0, F.concat(F.lit("Erreur a"), n)).when(k == 1, F.concat(F.lit("Erreur b"), n)).when(k == 2, "Erreur c").when(k == 3, "Erreur a").otherwise("Mo off")
    chain = F.when(k == 2, "[09:00:00] URL: x").when(k == 3, "[09:00:00] LLM: Erreur a").otherwise("")
    rows = table(spark, d, "events").select("event_id", chain.alias("chain"), F.struct(json.alias("json"), osm.alias("osm")).alias("r"))
    return rows.select("event_id", documents.outcome_errors(F.col("chain"), F.col("r"), F.lit("2025-01-01 10:20:30").cast("timestamp")).alias("errors"))


@query(f"""SELECT event_id, CASE event_id % 8 WHEN 0 THEN '{documents.NO_REFERENCE.replace("'", "''")}' WHEN 1 THEN 'Erreur dans les données GL: Erreur conversion: ' || event_id WHEN 2 THEN 'Erreur parsing JSON data.grandlyon.com'
WHEN 3 THEN '{documents.NO_EXTRACT.replace("'", "''")}' WHEN 4 THEN 'Erreur parsing JSON LLM' WHEN 5 THEN 'Comparaison impossible: note ' || event_id WHEN 6 THEN 'Comparaison impossible: {documents.NO_SOURCE.replace("'", "''")}' END AS problem FROM events""")  # fmt: skip
def comparison_problems(spark: SparkSession, d: str) -> DataFrame:
    """Why two documents cannot be compared."""
    k, n = F.col("event_id") % 8, F.col("event_id").cast("string")
    info = lambda *more: F.to_json(F.struct(F.struct(F.lit(False).alias("source_found"), *more).alias("extraction_info")))
    reference = F.when(k == 0, " ").when(k == 1, F.concat(F.lit("Erreur conversion: "), n)).when(k == 2, "{").otherwise("{}")
    found = F.when(k == 3, "").when(k == 4, F.concat(n, F.lit("{"))).when(k == 5, info(F.concat(F.lit("note "), n).alias("notes"))).when(k == 6, info()).otherwise('{"extraction_info": {"source_found": true}}')
    rows = table(spark, d, "events").select("event_id", reference.alias("a"), found.alias("b"))
    return rows.select("event_id", documents.comparison_problem(F.col("a"), F.col("b")).alias("problem"))


@query("""WITH r AS (SELECT CAST(o_custkey AS VARCHAR) AS identifiant, 'Mo ' || o_orderkey AS horaires, list_position(['P', 'O', 'F'], o_orderstatus) AS source FROM orders)
SELECT identifiant, arg_max(horaires, row(source, horaires)) AS horaires_data_gl FROM r GROUP BY 1""")
def last_sources(spark: SparkSession, d: str) -> DataFrame:
    """Reference hours of several sources; of a venue that many name the last source counts."""
    of = lambda s: table(spark, d, "orders").where(F.col("o_orderstatus") == s).select(F.col("o_custkey").cast("string").alias("identifiant"), F.concat(F.lit("Mo "), F.col("o_orderkey").cast("string")).alias("horaires"))
    return pipeline.last_source([of(s) for s in "POF"])


@query("""WITH o AS (SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day, o_custkey % 3 AS k FROM orders)
SELECT o_orderkey, array_to_string(list_sort(list_distinct(list_concat(CASE WHEN day > '1996-01-01' THEN [day] ELSE [] END, CASE WHEN k < 2 THEN ['1996-05-01', '1997-01-01', '1997-05-01'] ELSE [] END))), ',') AS dates,
CASE WHEN day > '1996-01-01' THEN 'ouvert' END AS own FROM o""")  # fmt: skip
def refreshed_dates(spark: SparkSession, d: str) -> DataFrame:
    """The special-day step of an extraction, F11, J5, U3, U4: past dates go, coming holidays join where the venue type closes."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    dated = F.struct(F.struct(F.struct(F.struct(F.lit(True).alias("source_found"), F.map_from_arrays(F.array(day), F.array(F.lit("ouvert"))).alias("horaires_specifiques")).alias("jours_feries")).alias("periodes")).alias("horaires_ouverture"))
    kind = F.element_at(F.array(F.lit("Mairie"), F.lit("bibliothèque"), F.lit("piscine")), (F.col("o_custkey") % 3 + 1).cast("int"))
    named = lambda *days: F.create_map(*(F.lit(x) for y in days for x in (y, "fête")))
    today = F.lit("1996-01-01").cast("date")
    coming = documents.holiday_dates(named("1995-12-25", "1996-05-01"), named("1997-01-01", "1997-05-01"), today)
    path = "$.horaires_ouverture.periodes.jours_feries.horaires_specifiques"
    rows = table(spark, d, "orders").select("o_orderkey", day.alias("day"), documents.refreshed(F.to_json(dated), kind, coming, today).alias("j"))
    dates = F.from_json(F.get_json_object("j", path), "map<string,string>")
    return rows.select("o_orderkey", "day", dates.alias("m")).select("o_orderkey", F.array_join(F.array_sort(F.map_keys("m")), ",").alias("dates"), F.col("m")[F.col("day")].alias("own"))


@query("""SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'Timeout LLM' WHEN 1 THEN 'Clé API invalide' WHEN 2 THEN 'Erreur de parsing des données' ELSE 'Données invalides' END AS solution,
CASE event_id % 4 WHEN 0 THEN 'Erreur Timeout LLM' WHEN 3 THEN '{"error":"Validation failed","details":"champ ' || event_id || '"}' END AS value FROM events""")  # fmt: skip
def error_outcomes(spark: SparkSession, d: str) -> DataFrame:
    """What an error of a category leads to."""
    k = F.col("event_id") % 4
    category = F.when(k < 2, "llm").when(k == 2, "parsing").otherwise("validation")
    message = F.when(k == 0, "Request TIMEOUT").when(k == 1, "bad API key").otherwise(F.concat(F.lit("champ "), F.col("event_id").cast("string")))
    return table(spark, d, "events").select("event_id", state.outcome(category, message).alias("o")).select("event_id", "o.*")


@query("SELECT user_id, round(sum(coalesce(CASE WHEN event_id % 3 = 0 THEN NULL ELSE value END, 0) + coalesce(CASE WHEN event_id % 5 = 0 THEN NULL ELSE value / 2 END, 0)), 4) AS used FROM events GROUP BY 1")
def running_emissions(spark: SparkSession, d: str) -> DataFrame:
    """Emissions added to what a result has already."""
    old, more = F.when(F.col("event_id") % 3 != 0, F.col("value")), F.when(F.col("event_id") % 5 != 0, F.col("value") / 2)
    return table(spark, d, "events").groupBy("user_id").agg(F.round(F.sum(state.added(old, more)), 4).alias("used"))


# -- report and statistics -------------------------------------------------------------------------------------


def _reported(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("id_resultats_extraction")
    told = results(spark, d).withColumns({
        "message_url": F.when(k % 4 == 0, "-").when(k % 4 == 1, "Délai dépassé").otherwise(""), "erreurs_pipeline": F.when(k % 3 == 0, "").when(k % 3 == 1, "[10:00:00] URL: x").otherwise("[10:00:00] LLM: a | [10:00:01] OSM: b | [10:00:02] OSM: c"),
        "differences_horaires": F.repeat(F.lit("lundi "), (k % 30).cast("int")),
    })
    return report.rows(told, venues(spark, d).withColumn("url", F.concat(F.lit("https://"), "identifiant")))


REPORTED_SQL = """r AS (SELECT *, CASE WHEN id_resultats_extraction % 4 = 0 THEN '-' WHEN id_resultats_extraction % 4 = 1 THEN 'Délai dépassé' ELSE '' END AS m,
  CASE WHEN id_resultats_extraction % 3 = 0 THEN '' WHEN id_resultats_extraction % 3 = 1 THEN '[10:00:00] URL: x' ELSE '[10:00:00] LLM: a | [10:00:01] OSM: b | [10:00:02] OSM: c' END AS e FROM results JOIN venues ON lieu_id = identifiant),
s AS (SELECT *, CASE WHEN horaires_identiques THEN 'success' WHEN NOT horaires_identiques THEN 'schedule_diff' WHEN NOT coalesce(statut_url = 'ok' AND code_http BETWEEN 200 AND 299, false) THEN 'access_error'
  WHEN llm_horaires_osm IS NULL OR trim(llm_horaires_osm) = '' OR llm_horaires_osm LIKE 'Erreur%' OR trim(horaires_data_gl) = '' THEN 'extraction_error' ELSE 'compare_error' END AS status FROM r)"""


@query(f""", {REPORTED_SQL} SELECT identifiant, code_http AS code, status, CASE status WHEN 'access_error' THEN CASE WHEN m NOT IN ('', '-') THEN m WHEN e <> '' THEN e ELSE 'Accès impossible' END
WHEN 'extraction_error' THEN CASE WHEN e <> '' THEN split_part(e, ' | ', 1) WHEN m IN ('', '-') THEN 'Extraction échouée' ELSE m END WHEN 'compare_error' THEN CASE WHEN m IN ('', '-') THEN 'Comparaison impossible' ELSE m END ELSE m END AS message,
CASE WHEN e = '' THEN 0 WHEN e LIKE '% | %' THEN 3 ELSE 1 END AS nombre_erreurs, CASE WHEN e LIKE '% | %' THEN '[10:00:00] LLM: a (et 2 autres)' ELSE e END AS erreurs_resume,
CASE WHEN 6 * (id_resultats_extraction % 30) > 80 THEN substr(repeat('lundi ', CAST(id_resultats_extraction % 30 AS INTEGER)), 1, 80) || '...' ELSE repeat('lundi ', CAST(id_resultats_extraction % 30 AS INTEGER)) END AS apercu,
round(llm_consommation_requete * 1000, 4) AS grammes, CASE WHEN llm_horaires_json = '' OR llm_horaires_json LIKE 'ERREUR%' THEN base64(CAST('"' || llm_horaires_json || '"' AS BLOB)) ELSE base64(CAST(llm_horaires_json AS BLOB)) END AS charge FROM s""", True)  # fmt: skip
def report_rows(spark: SparkSession, d: str) -> DataFrame:
    """The report table."""
    return _reported(spark, d).select("identifiant", F.col("code_http").alias("code"), "status", "message", F.col("nombre_erreurs").cast("int").alias("nombre_erreurs"), "erreurs_resume", F.col("apercu_differences").alias("apercu"), F.round("llm_consommation_requete", 4).alias("grammes"), F.col("horaires_base64").alias("charge"))


@query(f""", {REPORTED_SQL} SELECT count(*) AS total_urls, count(*) FILTER (status IN ('success', 'schedule_diff')) AS comparisons_done, count(*) FILTER (status = 'success') AS comparisons_identical, count(*) FILTER (status = 'schedule_diff') AS comparisons_different,
count(*) FILTER (status NOT IN ('success', 'schedule_diff')) AS comparisons_not_done FROM s""", True)  # fmt: skip
def outcome_counts(spark: SparkSession, d: str) -> DataFrame:
    """Counters of the whole report."""
    return stats.outcome_counts(_reported(spark, d))


@query(f""", {REPORTED_SQL} SELECT status, CAST(CASE status WHEN 'success' THEN 1 WHEN 'schedule_diff' THEN 2 WHEN 'compare_error' THEN 3 WHEN 'extraction_error' THEN 4 ELSE 5 END AS INTEGER) AS place, count(*) AS n, min(identifiant) AS first, max(identifiant) AS last FROM s GROUP BY 1""", True)
def report_groups(spark: SparkSession, d: str) -> DataFrame:
    """The report's rows by status in display order, with the first and last of each group."""
    rows = report.groups(_reported(spark, d))
    return rows.groupBy("status", "place").agg(F.count("*").alias("n"), F.min("identifiant").alias("first"), F.max("identifiant").alias("last"))


def _executions(spark: SparkSession, d: str) -> DataFrame:
    name = F.concat(F.lit("m"), (F.col("o_orderkey") % 7).cast("string"))
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("id_execution"), F.col("o_orderdate").alias("date_execution"), name.alias("llm_modele"), F.col("o_orderpriority").alias("llm_fournisseur"), (F.col("o_totalprice") / 1e6).alias("llm_consommation_execution"))


GLOBAL_SQL = """g AS (SELECT max(o_orderdate) AS execution_date, 'm' || CAST(arg_max(o_orderkey, row(o_orderdate, o_orderkey)) % 7 AS VARCHAR) AS llm_model, arg_max(o_orderpriority, row(o_orderdate, o_orderkey)) AS llm_provider, round(sum(o_totalprice / 1e6) * 1000, 4) AS total_co2_emissions FROM orders)"""


@query(f"""WITH {GLOBAL_SQL} SELECT count(*) AS total_records, count(*) FILTER (event_type = 'error') AS records_with_errors, any_value(execution_date) AS execution_date, any_value(llm_model) AS llm_model, any_value(llm_provider) AS llm_provider, any_value(total_co2_emissions) AS total_co2_emissions FROM events, g""")
def global_stats(spark: SparkSession, d: str) -> DataFrame:
    """A5: the latest execution, all emissions, records and those with errors."""
    rows = table(spark, d, "events").select(F.when(F.col("event_type") == "error", "x").otherwise("").alias("erreurs_pipeline"))
    return stats.global_stats(_executions(spark, d), rows)


@query("""SELECT section, item, label, CAST(v AS DOUBLE) AS value, unit FROM (
SELECT 'urls' AS section, 'total' AS item, 'Total des URLs' AS label, (SELECT count(*) FROM results) AS v, '' AS unit UNION ALL SELECT 'urls', 'successful', 'URLs réussies', (SELECT count(*) FROM results WHERE statut_url = 'ok'), ''
UNION ALL SELECT 'urls', 'success_rate', 'Taux de réussite', (SELECT round(100.0 * count(*) FILTER (statut_url = 'ok') / count(*), 4) FROM results), '%' UNION ALL SELECT 'urls', 'http_errors', 'Erreurs HTTP', (SELECT count(*) FROM results WHERE code_http >= 400), ''
UNION ALL SELECT 'markdown', 'cleaned', 'Documents nettoyés', (SELECT count(*) FROM results WHERE markdown_nettoye <> ''), '' UNION ALL SELECT 'llm', 'attempted', 'Extractions tentées', (SELECT count(*) FROM results WHERE llm_horaires_json <> ''), ''
UNION ALL SELECT 'comparisons', 'identical', 'Horaires identiques', (SELECT count(*) FROM results WHERE horaires_identiques), '' UNION ALL SELECT 'global', 'total_records', 'Total des enregistrements', (SELECT count(*) FROM results), '')""", True)  # fmt: skip
def stats_sections(spark: SparkSession, d: str) -> DataFrame:
    """Some items of the statistics' sections, in long form."""
    rows = stats.sections(_executions(spark, d), results(spark, d).withColumn("erreurs_pipeline", F.lit("")), "2025-01-01T00:00:00")
    wanted = ["urls.total", "urls.successful", "urls.success_rate", "urls.http_errors", "markdown.cleaned", "llm.attempted", "comparisons.identical", "global.total_records"]
    return rows.where(F.concat_ws(".", "section", "item").isin(wanted)).select("section", "item", "label", F.col("value").cast("double").alias("value"), "unit")


@query(""", s AS (SELECT count(*) AS n, count(*) FILTER (statut_url = 'ok') AS good, avg(CASE WHEN statut_url = 'ok' THEN length(markdown_brut) END) AS size, sum(llm_consommation_requete) * 1000 AS co2 FROM results)
SELECT 'urls.total' AS item, CAST(n AS VARCHAR) AS shown FROM s UNION ALL SELECT 'urls.success_rate', printf('%.1f%%', round_even(round(100.0 * good / n, 4), 1)) FROM s
UNION ALL SELECT 'urls.avg_content_length', printf('%.0f caractères', round_even(round(size, 4), 0)) FROM s UNION ALL SELECT 'llm.total_co2_emissions', printf('%.3fg', round_even(round(co2, 4), 3)) FROM s""", True)
def formatted_stats(spark: SparkSession, d: str) -> DataFrame:
    """Statistics as they are shown, made from sums and counts by execution that are then added up."""
    sums = stats.merged_stats(stats.partial_stats(results(spark, d).withColumn("erreurs_pipeline", F.lit(""))))
    rows = stats.sections_of(_executions(spark, d), sums, "2025-01-01T00:00:00").withColumn("name", F.concat_ws(".", "section", "item"))
    return rows.where(F.col("name").isin("urls.total", "urls.success_rate", "urls.avg_content_length", "llm.total_co2_emissions")).select(F.col("name").alias("item"), F.col("formatted_value").alias("shown"))


@query(f""", {REPORTED_SQL}, n AS (SELECT *, row_number() OVER (PARTITION BY status ORDER BY identifiant, id_resultats_extraction) - 1 AS i FROM s)
SELECT status, CAST(i // 50 AS BIGINT) + 1 AS page, count(*) AS n, (SELECT CAST(ceil(count(*) / 50) AS BIGINT) FROM s o WHERE o.status = n.status) AS pages, min(identifiant) AS first, max(identifiant) AS last FROM n GROUP BY status, i // 50""", True)  # fmt: skip
def report_pages(spark: SparkSession, d: str) -> DataFrame:
    """The full report in pages of 50 rows, all rows in display order."""
    found = report.pages(_reported(spark, d), 50)
    cell = lambda html: F.regexp_extract_all(html, F.lit("<tr><td>([^<]*)</td>"), 1)
    return found.select("status", "page", "n", "pages", F.get(cell(F.col("html")), F.lit(0)).alias("first"), F.try_element_at(cell(F.col("html")), F.lit(-1)).alias("last"))


# -- store -----------------------------------------------------------------------------------------------------


def _store(spark: SparkSession, d: str) -> Store:
    store = Store(spark, f"{shared_folder(spark)}/store-{uuid.uuid4().hex}")
    store.create_database()
    rows = _executions(spark, d).select("id_execution", F.col("date_execution").cast("timestamp_ntz").alias("date_execution"), "llm_modele", "llm_fournisseur", F.lit("").alias("llm_url"), "llm_consommation_execution")
    store.write("executions", rows)
    return store


@query("SELECT CASE WHEN o_orderkey % 7 = 3 AND o_orderpriority = '1-URGENT' THEN 'changed' ELSE '' END AS llm_url, count(*) AS n, (SELECT count(*) FROM orders WHERE o_orderkey % 7 = 3 AND o_orderpriority = '1-URGENT') AS updated FROM orders GROUP BY 1")
def updated_records(spark: SparkSession, d: str) -> DataFrame:
    """An update by equality, with its count."""
    store = _store(spark, d)
    n = store.update("executions", {"llm_modele": "m3", "llm_fournisseur": "1-URGENT"}, {"llm_url": "changed"})
    return store.read("executions").groupBy("llm_url").agg(F.count("*").alias("n")).withColumn("updated", F.lit(n).cast("long"))


@query("SELECT 'm' || CAST(o_orderkey % 7 AS VARCHAR) AS llm_modele, count(*) AS n FROM orders WHERE o_orderkey > 100 AND o_orderpriority = '2-HIGH' GROUP BY 1")
def positional_sql(spark: SparkSession, d: str) -> DataFrame:
    """SQL over the state tables with positional parameters."""
    return _store(spark, d).sql("SELECT llm_modele, count(*) AS n FROM executions WHERE id_execution > ? AND llm_fournisseur = ? GROUP BY llm_modele", 100, "2-HIGH")



@query("""SELECT 'fail' AS policy, 'FileExistsError' AS said, count(*) AS n FROM orders UNION ALL SELECT 'skip', 'kept', count(*) FROM orders UNION ALL SELECT 'replace', 'new', count(*) FROM orders WHERE o_orderkey % 2 = 0
UNION ALL SELECT 'exists', 'true,false', 0""")
def store_policies(spark: SparkSession, d: str) -> DataFrame:
    """What becomes of a table that exists, and whether a table does."""
    store, rows = _store(spark, d), _executions(spark, d)
    even = store.read("executions").where("id_execution % 2 = 0")
    try:
        store.write("executions", even, "fail")
        said = "written"
    except FileExistsError as e:
        said = type(e).__name__
    tables = [("fail", said, store.read("executions"))]
    store.write("executions", even, "skip")
    tables.append(("skip", "kept", store.read("executions")))
    store.write("executions", even, "replace")
    tables.append(("replace", "new", store.read("executions")))
    shown = [t.agg(F.count("*").alias("n")).select(F.lit(policy).alias("policy"), F.lit(what).alias("said"), "n") for policy, what, t in tables]
    there = f"{store.exists('executions')},{store.exists('none')}".lower()
    shown.append(rows.limit(1).select(F.lit("exists").alias("policy"), F.lit(there).alias("said"), F.lit(0).cast("long").alias("n")))
    return shown[0].unionByName(shown[1]).unionByName(shown[2]).unionByName(shown[3])


@query("SELECT o_orderpriority AS llm_fournisseur, count(*) AS n FROM orders WHERE o_orderkey % 7 = 3 AND o_orderkey <= 900 GROUP BY 1")
def named_sql(spark: SparkSession, d: str) -> DataFrame:
    """SQL over the state tables with named parameters."""
    return _store(spark, d).sql("SELECT llm_fournisseur, count(*) AS n FROM executions WHERE llm_modele = :model AND id_execution <= :last GROUP BY llm_fournisseur", model="m3", last=900)


@query("""WITH e AS (SELECT event_id % 997 AS id, event_id AS seq, ts, event_id < 997 AS arrived, event_type = 'purchase' AS ok FROM events), ends AS (SELECT id, min(seq) FILTER (NOT arrived AND ok) AS fin FROM e GROUP BY 1),
s AS (SELECT e.* FROM e JOIN ends ON e.id = ends.id WHERE fin IS NULL OR seq <= fin),
r AS (SELECT id, max(seq) AS seq, CAST(count(*) FILTER (NOT arrived AND NOT ok) AS INTEGER) AS tries, count(*) FILTER (NOT arrived) AS answers, coalesce(bool_or(NOT arrived AND ok), false) AS good, max(ts) FILTER (NOT arrived AND NOT ok) AS failed FROM s GROUP BY 1)
SELECT id, seq, tries, CASE WHEN answers = 0 THEN 'fetch' WHEN good THEN 'clean' WHEN tries >= 3 THEN 'failed' WHEN failed + INTERVAL 5 SECOND <= TIMESTAMP '2024-06-01 00:00:00' THEN 'retry' ELSE 'waiting' END AS step FROM r""")  # fmt: skip
def results_by_step(spark: SparkSession, d: str) -> DataFrame:
    """F1-F8 as state by key: where each result stands after all its events, as the stream of them leaves it."""
    k, kind = F.col("event_id"), F.col("event_type")
    arrived = k < 997
    status = F.when(~arrived, F.when(kind == "purchase", "ok").otherwise("critical"))
    none = F.lit(None).cast("string")
    events = table(spark, d, "events").select(
        (k % 997).alias(state.ID), k.alias("seq"), F.col("ts").alias("at"), F.when(arrived, "arrived").otherwise("answered").alias("kind"), F.lit(1).cast("long").alias("id_execution"), status.alias("statut_url"),
        F.lit(0).alias("code_http"), none.alias("message_url"), none.alias("markdown_brut"),
    )
    return progress.settled(events, "2024-06-01 00:00:00").select(F.col(state.ID).alias("id"), "seq", "tries", "step")
