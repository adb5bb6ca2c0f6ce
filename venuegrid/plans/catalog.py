"""The registered venue queries and the SQL to hold each against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from venuegrid.functions import documents, hours, text
from venuegrid.operators import state, stats
from venuegrid.plans import report
from venuegrid.plans.views import RESULTS_SQL, results, table, venues
from venuegrid.sources.providers import html_to_text
from venuegrid.streaming.incremental import event_counts

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None, views: bool = False):
    """Register a query under its name, with its SQL if there is any."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = (f"WITH {RESULTS_SQL} " if views else "") + sql
        return f

    return add


# -- statistics ------------------------------------------------------------------------------------------------


@query("""SELECT count(*) AS total, count(*) FILTER (statut_url = 'ok') AS successful, count(*) FILTER (statut_url <> 'ok') AS failed,
round(avg(CASE WHEN statut_url = 'ok' THEN length(markdown_brut) END), 4) AS avg_content_length, count(*) FILTER (code_http >= 400) AS http_errors,
count(*) FILTER (code_http = 0) AS timeout_errors, round(coalesce(100.0 * count(*) FILTER (statut_url = 'ok') / nullif(count(*), 0), 0.0), 4) AS success_rate FROM results""", True)  # fmt: skip
def url_stats(spark: SparkSession, d: str) -> DataFrame:
    """A1: fetch statistics."""
    return stats.url_stats(results(spark, d))


@query("""SELECT count(*) FILTER (markdown_brut <> '') AS processed, count(*) FILTER (markdown_nettoye <> '') AS cleaned, count(*) FILTER (markdown_filtre <> '') AS filtered,
round(avg(CASE WHEN markdown_filtre <> '' THEN length(markdown_filtre) END), 4) AS avg_filtered_length,
CAST(coalesce(sum(length(markdown_brut) - length(markdown_nettoye)), 0) AS BIGINT) AS chars_cleaned FROM results""", True)  # fmt: skip
def text_stats(spark: SparkSession, d: str) -> DataFrame:
    """A2: cleaning statistics."""
    return stats.text_stats(results(spark, d))


@query("""SELECT attempted, json_ok, osm_ok, avg_osm_length, co2_g, attempted - osm_ok AS failed, round(coalesce(100.0 * osm_ok / nullif(attempted, 0), 0.0), 4) AS success_rate FROM (
SELECT count(*) FILTER (llm_horaires_json <> '') AS attempted, count(*) FILTER (llm_horaires_json <> '' AND llm_horaires_json NOT ILIKE 'Erreur%') AS json_ok,
count(*) FILTER (llm_horaires_osm <> '' AND llm_horaires_osm NOT ILIKE 'Erreur%') AS osm_ok,
round(avg(CASE WHEN llm_horaires_osm <> '' AND llm_horaires_osm NOT ILIKE 'Erreur%' THEN length(llm_horaires_osm) END), 4) AS avg_osm_length,
round(sum(llm_consommation_requete) * 1000, 4) AS co2_g FROM results)""", True)  # fmt: skip
def extraction_stats(spark: SparkSession, d: str) -> DataFrame:
    """A3: extraction statistics and emissions."""
    return stats.extraction_stats(results(spark, d))


@query("""SELECT total, identical, different, not_compared, round(coalesce(100.0 * identical / nullif(identical + different, 0), 0.0), 4) AS accuracy_rate FROM (
SELECT count(*) AS total, count(*) FILTER (horaires_identiques) AS identical, count(*) FILTER (NOT horaires_identiques) AS different,
count(*) FILTER (horaires_identiques IS NULL) AS not_compared FROM results)""", True)  # fmt: skip
def comparison_stats(spark: SparkSession, d: str) -> DataFrame:
    """A4: comparison statistics."""
    return stats.comparison_stats(results(spark, d))


@query("""SELECT max(o_orderdate) AS latest, arg_max(o_orderpriority, (o_orderdate, o_orderpriority)) AS latest_o_orderpriority,
arg_max(o_orderstatus, (o_orderdate, o_orderstatus)) AS latest_o_orderstatus, count(*) AS executions FROM orders""")  # fmt: skip
def latest_execution(spark: SparkSession, d: str) -> DataFrame:
    """The latest execution's attributes in one scan."""
    return stats.latest(table(spark, d, "orders"), "o_orderdate", ["o_orderpriority", "o_orderstatus"])


@query("SELECT id_execution, round(sum(llm_consommation_requete) * 1000, 4) AS co2_g, count(*) AS n FROM results GROUP BY 1", True)
def execution_emissions(spark: SparkSession, d: str) -> DataFrame:
    """Emissions and comparisons by execution."""
    return stats.by_execution(results(spark, d))


STATUS_SQL = """rows AS (SELECT r.*, v.type_lieu, v.horaires_data_gl, CASE WHEN horaires_identiques THEN 'success' WHEN NOT horaires_identiques THEN 'schedule_diff'
WHEN NOT (statut_url = 'ok' AND code_http BETWEEN 200 AND 299) THEN 'access_error'
WHEN trim(llm_horaires_osm) = '' OR starts_with(llm_horaires_osm, 'Erreur') OR trim(horaires_data_gl) = '' OR starts_with(horaires_data_gl, 'Erreur') THEN 'extraction_error'
ELSE 'compare_error' END AS status FROM results r JOIN venues v ON r.lieu_id = v.identifiant)"""


def _reported(spark: SparkSession, d: str) -> DataFrame:
    return state.with_venue(results(spark, d), venues(spark, d)).withColumn("status", stats.report_status())


@query(f", {STATUS_SQL} SELECT id_resultats_extraction, status FROM rows", True)
def report_status(spark: SparkSession, d: str) -> DataFrame:
    """Each result's report status."""
    return _reported(spark, d).select("id_resultats_extraction", "status")


@query(f""", {STATUS_SQL} SELECT status, CAST(list_position(['success', 'schedule_diff', 'compare_error', 'extraction_error', 'access_error'], status) AS INTEGER) AS place,
count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 1) AS share FROM rows GROUP BY status""", True)  # fmt: skip
def status_counts(spark: SparkSession, d: str) -> DataFrame:
    """Report groups with counts and shares."""
    return stats.status_counts(_reported(spark, d))


@query(f", {STATUS_SQL} SELECT type_lieu, count(*) AS n, min(id_resultats_extraction) AS first_seen FROM rows GROUP BY 1", True)
def type_counts(spark: SparkSession, d: str) -> DataFrame:
    """Results by venue type in order of first appearance."""
    return stats.counts_by(_reported(spark, d), "type_lieu", "id_resultats_extraction")


@query("SELECT code_http, count(*) AS n, min(id_resultats_extraction) AS first_seen FROM results GROUP BY 1", True)
def http_counts(spark: SparkSession, d: str) -> DataFrame:
    """A10: results by HTTP code."""
    return stats.counts_by(results(spark, d), "code_http", "id_resultats_extraction")


@query(f""", {STATUS_SQL}, t AS (SELECT *, CASE id_resultats_extraction % 5 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE 'LUNDI: ' || id_resultats_extraction END AS d, CASE WHEN id_resultats_extraction % 7 = 0 THEN 'URL: x' ELSE '' END AS e FROM rows)
SELECT id_resultats_extraction, CASE WHEN horaires_identiques THEN 'IDENTIQUE - Aucune différence détectée' WHEN NOT horaires_identiques THEN 'DIFFÉRENT - ' || coalesce(d, '')
WHEN e <> '' THEN 'Non comparé - ' || e WHEN d <> '' THEN d ELSE 'Non comparé' END AS label, round(llm_consommation_requete * 1000, 4) AS co2_g FROM t""", True)  # fmt: skip
def comparison_labels(spark: SparkSession, d: str) -> DataFrame:
    """comparison labels and grams of CO2."""
    k = F.col("id_resultats_extraction")
    told = F.when(k % 5 == 0, "").when(k % 5 > 1, F.concat(F.lit("LUNDI: "), k.cast("string")))
    label = report.comparison_label(F.col("horaires_identiques"), told, F.when(k % 7 == 0, "URL: x").otherwise(""))
    return _reported(spark, d).select("id_resultats_extraction", label.alias("label"), F.round(report.grams(F.col("llm_consommation_requete")), 4).alias("co2_g"))


@query("""SELECT count(*) AS total, round(100.0 * avg(CASE WHEN status = 'Identique' THEN 1 ELSE 0 END), 4) AS accuracy, CAST(sum(diff_count) AS BIGINT) AS differences,
round(coalesce(avg(CASE WHEN status = 'Différent' THEN diff_count END), 0.0), 4) AS mean_differences FROM (
SELECT CASE event_type WHEN 'view' THEN 'Identique' WHEN 'error' THEN 'Erreur de comparaison' ELSE 'Différent' END AS status,
CASE event_type WHEN 'view' THEN 0 WHEN 'error' THEN 1 ELSE 1 + event_id % 5 END AS diff_count FROM events)""")  # fmt: skip
def eval_metrics(spark: SparkSession, d: str) -> DataFrame:
    """Evaluation metrics."""
    return stats.evaluation(_scores(spark, d))


def _scores(spark: SparkSession, d: str) -> DataFrame:
    kind, k = F.col("event_type"), F.col("event_id")
    status = F.when(kind == "view", "Identique").when(kind == "error", "Erreur de comparaison").otherwise("Différent")
    return table(spark, d, "events").select(status.alias("status"), F.when(kind == "view", 0).when(kind == "error", 1).otherwise(1 + k % 5).alias("diff_count"))


@query("SELECT 1 + event_id % 5 AS diff_count, count(*) AS n FROM events WHERE event_type NOT IN ('view', 'error') GROUP BY 1")
def diff_histogram(spark: SparkSession, d: str) -> DataFrame:
    """Histogram of difference counts."""
    return stats.difference_histogram(_scores(spark, d))


@query("SELECT event_type AS category, CASE WHEN value < 50 THEN 'low' WHEN value < 150 THEN 'medium' ELSE 'high' END AS severity, count(*) AS n FROM events GROUP BY 1, 2")
def error_summary(spark: SparkSession, d: str) -> DataFrame:
    """Errors by category and severity."""
    severity = F.when(F.col("value") < 50, "low").when(F.col("value") < 150, "medium").otherwise("high")
    return stats.error_counts(table(spark, d, "events").select(F.col("event_type").alias("category"), severity.alias("severity")))


@query("SELECT event_id, user_id, value FROM events WHERE event_type = 'error' ORDER BY ts DESC, event_id DESC LIMIT 5")
def recent_errors(spark: SparkSession, d: str) -> DataFrame:
    """The five latest errors."""
    return stats.last_errors(table(spark, d, "events").where("event_type = 'error'"), ["ts", "event_id"]).select("event_id", "user_id", "value")


@query("""SELECT 'urls' AS section, item, CAST(v AS DOUBLE) AS value FROM (SELECT count(*) AS total, count(*) FILTER (statut_url = 'ok') AS successful, count(*) FILTER (code_http >= 400) AS http_errors FROM results)
UNPIVOT (v FOR item IN (total, successful, http_errors))""", True)  # fmt: skip
def stats_long(spark: SparkSession, d: str) -> DataFrame:
    """Statistics in long form."""
    rows = stats.item_rows("urls", stats.url_stats(results(spark, d)))
    return rows.where(F.col("item").isin("total", "successful", "http_errors")).select("section", "item", F.col("value").cast("double").alias("value"))


# -- state -----------------------------------------------------------------------------------------------------


@query("SELECT id_resultats_extraction, nom FROM results JOIN venues ON lieu_id = identifiant WHERE id_execution = 1 AND statut_url <> 'ok'", True)
def pending_urls(spark: SparkSession, d: str) -> DataFrame:
    """Results to fetch."""
    return state.pending_urls(results(spark, d), venues(spark, d), F.lit(1)).select("id_resultats_extraction", "nom")


@query("SELECT id_resultats_extraction FROM results WHERE id_execution = 1 AND statut_url = 'ok' AND markdown_brut <> '' AND markdown_nettoye = ''", True)
def pending_cleaning(spark: SparkSession, d: str) -> DataFrame:
    """results to clean."""
    return state.pending_cleaning(results(spark, d), F.lit(1)).select("id_resultats_extraction")


@query("SELECT id_resultats_extraction FROM results WHERE id_execution = 1 AND markdown_nettoye <> '' AND markdown_filtre = ''", True)
def pending_filtering(spark: SparkSession, d: str) -> DataFrame:
    """results to filter."""
    return state.pending_filtering(results(spark, d), F.lit(1)).select("id_resultats_extraction")


@query("SELECT id_resultats_extraction, nom FROM results JOIN venues ON lieu_id = identifiant WHERE id_execution = 0 AND statut_url = 'ok' AND markdown_filtre <> '' AND llm_horaires_json = ''", True)
def pending_extract(spark: SparkSession, d: str) -> DataFrame:
    """results to extract."""
    return state.pending_extraction(results(spark, d), venues(spark, d), F.lit(0)).select("id_resultats_extraction", "nom")


@query("SELECT count(*) AS n, min(id_resultats_extraction) AS first FROM results WHERE llm_horaires_json <> ''", True)
def extracted(spark: SparkSession, d: str) -> DataFrame:
    """results with schedules."""
    return state.extracted(results(spark, d)).agg(F.count("*").alias("n"), F.min("id_resultats_extraction").alias("first"))


@query("""SELECT id_resultats_extraction, nom FROM results JOIN venues ON lieu_id = identifiant
WHERE llm_horaires_json <> '' AND llm_horaires_json NOT ILIKE 'Erreur LLM:%' AND horaires_identiques IS NULL""", True)  # fmt: skip
def pending_comparison(spark: SparkSession, d: str) -> DataFrame:
    """results to compare."""
    return state.pending_comparison(results(spark, d), venues(spark, d)).select("id_resultats_extraction", "nom")


@query("""SELECT step, count(*) AS n FROM (SELECT CASE WHEN statut_url <> 'ok' THEN 'url' WHEN llm_horaires_json = '' THEN 'llm' WHEN llm_horaires_osm = '' THEN 'osm' END AS step
FROM results WHERE id_execution <> 1) WHERE step IS NOT NULL GROUP BY 1""", True)  # fmt: skip
def incomplete_breakdown(spark: SparkSession, d: str) -> DataFrame:
    """Incomplete results by the step they lack."""
    found = results(spark, d).where("id_execution <> 1").select(state.missing_step().alias("step")).where("step IS NOT NULL")
    return found.groupBy("step").agg(F.count("*").alias("n"))


@query("""SELECT id_execution, count(*) AS n FROM (SELECT CASE WHEN id_execution <> 9 AND (statut_url <> 'ok' OR llm_horaires_json = '' OR llm_horaires_osm = '') THEN 9 ELSE id_execution END AS id_execution
FROM results) GROUP BY 1""", True)  # fmt: skip
def reassigned(spark: SparkSession, d: str) -> DataFrame:
    """Incomplete results moved to a new execution."""
    return state.reassign(results(spark, d), F.lit(9).cast("long")).groupBy("id_execution").agg(F.count("*").alias("n"))


@query("SELECT identifiant, nom FROM venues v WHERE NOT EXISTS (SELECT 1 FROM results r WHERE r.lieu_id = v.identifiant)", True)
def new_venues(spark: SparkSession, d: str) -> DataFrame:
    """Venues without any result."""
    return state.new_venues(venues(spark, d), results(spark, d)).select("identifiant", "nom")


@query("""SELECT coalesce(k, user_id) AS k, CASE WHEN user_id IS NULL THEN name ELSE event_type END AS name, segment FROM (
SELECT c_custkey AS k, c_name AS name, c_mktsegment AS segment FROM customer) FULL JOIN (
SELECT user_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1) ON k = user_id""")  # fmt: skip
def upsert_last_wins(spark: SparkSession, d: str) -> DataFrame:
    """Upsert by key; the last of a batch wins and unlisted columns stay."""
    stored = table(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    batch = table(spark, d, "events").select(F.col("user_id").alias("k"), F.col("event_type").alias("name"), F.struct("ts", "event_id").alias("at"))
    return state.upsert(stored, batch, "k", "at", ["name"])


@query("""SELECT c_custkey, coalesce(o.n, 0) AS n, coalesce(o.last, 'none') AS last FROM customer LEFT JOIN (
SELECT o_custkey, count(*) AS n, max(o_orderstatus) AS last FROM orders GROUP BY 1) o ON c_custkey = o_custkey""")  # fmt: skip
def reference_update(spark: SparkSession, d: str) -> DataFrame:
    """A reference delta joined onto the venues."""
    base = table(spark, d, "customer").select("c_custkey", F.lit(0).cast("long").alias("n"), F.lit("none").alias("last"))
    delta = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"), F.max("o_orderstatus").alias("last"))
    return state.apply_delta(base, delta, ["n", "last"], "c_custkey")


@query("SELECT o_orderkey, 100 + row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS id FROM orders")
def surrogate_keys(spark: SparkSession, d: str) -> DataFrame:
    """§1.1: gapless keys after the greatest one, without a single-task sort."""
    rows = table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    return state.number_from(rows, 100, ["o_orderdate", "o_orderkey"], "id").select("o_orderkey", "id")


@query("""SELECT user_id, string_agg('[' || strftime(ts, '%H:%M:%S') || '] URL: e' || event_id, ' | ' ORDER BY event_id) AS chain, count(*) AS errors,
CASE WHEN count(*) = 1 THEN '[' || min(strftime(ts, '%H:%M:%S')) || '] URL: e' || min(event_id) ELSE arg_min('[' || strftime(ts, '%H:%M:%S') || '] URL: e' || event_id, event_id) || ' (et ' || (count(*) - 1) || CASE WHEN count(*) > 2 THEN ' autres)' ELSE ' autre)' END END AS summary
FROM events WHERE event_type = 'error' GROUP BY 1""")  # fmt: skip
def error_chain(spark: SparkSession, d: str) -> DataFrame:
    """Error chains and their summaries."""
    one = F.concat(F.lit("["), F.date_format("ts", "HH:mm:ss"), F.lit("] URL: e"), F.col("event_id").cast("string"))
    errors = table(spark, d, "events").where("event_type = 'error'").select("user_id", F.struct("event_id", one.alias("t")).alias("e"))
    chains = errors.groupBy("user_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list("e")), lambda e: e["t"]), " | ").alias("chain"))
    return chains.select("user_id", "chain", state.error_summary(F.col("chain")).alias("s")).select("user_id", "chain", F.col("s.errors").cast("long").alias("errors"), "s.summary")


@query("SELECT event_id, CASE WHEN trim(url) = '' THEN 'URL non fournie' WHEN NOT regexp_matches(url, '^https?://') THEN 'Format d''URL invalide' END AS problem FROM (SELECT event_id, CASE event_id % 3 WHEN 0 THEN '' WHEN 1 THEN 'ftp://x' ELSE 'https://x' END AS url FROM events)")
def url_guards(spark: SparkSession, d: str) -> DataFrame:
    """Urls that never reach the fetch provider."""
    from venuegrid.sources.providers import checked_url

    url = F.when(F.col("event_id") % 3 == 0, "").when(F.col("event_id") % 3 == 1, "ftp://x").otherwise("https://x")
    return table(spark, d, "events").select("event_id", checked_url(url).alias("problem"))


@query("SELECT id_resultats_extraction, coalesce(nullif(markdown_filtre, ''), nullif(markdown_nettoye, ''), markdown_brut) AS best FROM results", True)
def best_text(spark: SparkSession, d: str) -> DataFrame:
    """the most refined text of each result."""
    return results(spark, d).select("id_resultats_extraction", state.best_text().alias("best"))


# -- text ------------------------------------------------------------------------------------------------------


@query("""SELECT doc_id, md5(regexp_replace(regexp_replace(t, '!\\[[^\\]]*\\]\\([^)]*\\)', '', 'g'), '\\[([^\\]]*)\\]\\([^)]*\\)', '', 'g')) AS digest
FROM (SELECT doc_id, '[l](http://a) ' || text || ' ![i](http://b)' AS t FROM documents)""")  # fmt: skip
def remove_links(spark: SparkSession, d: str) -> DataFrame:
    """Links removed with their text."""
    linked = F.concat(F.lit("[l](http://a) "), "text", F.lit(" ![i](http://b)"))
    return table(spark, d, "documents").select("doc_id", F.md5(text.remove_links(linked)).alias("digest"))


@query("""SELECT doc_id, md5(array_to_string(list_filter(string_split(text || chr(10) || '---' || chr(10) || chr(10) || '# (x)', chr(10)),
lambda x: x = '' OR NOT regexp_full_match(x, '[\\s#\\-"=_(\\[\\]).]+')), chr(10))) AS digest FROM documents""")  # fmt: skip
def drop_format_lines(spark: SparkSession, d: str) -> DataFrame:
    """Lines of formatting characters removed."""
    t = F.concat("text", F.lit("\n---\n\n# (x)"))
    return table(spark, d, "documents").select("doc_id", F.md5(text.drop_format_lines(t)).alias("digest"))


@query("SELECT doc_id, md5(translate(text || ' «a» b–c', '«»“”‘’–—*_`+\\', '\"\"\"\"''''--     ')) AS digest FROM documents")
def replace_characters(spark: SparkSession, d: str) -> DataFrame:
    """T4: typographic and formatting characters replaced."""
    return table(spark, d, "documents").select("doc_id", F.md5(text.replace_characters(F.concat("text", F.lit(" «a» b–c")))).alias("digest"))


@query("SELECT doc_id, md5(regexp_replace(replace(text, '.', chr(10) || chr(10)), '(\\r\\n|\\n|\\r){3,}', chr(10) || chr(10), 'g')) AS digest FROM documents")
def collapse_newlines(spark: SparkSession, d: str) -> DataFrame:
    """T5: runs of line ends shortened."""
    return table(spark, d, "documents").select("doc_id", F.md5(text.collapse_newlines(F.replace("text", F.lit("."), F.lit("\n\n")))).alias("digest"))


@query("""WITH l AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) AS i FROM (SELECT doc_id, text || chr(10) || 'A' || chr(10) || chr(10) || 'A' || chr(10) || 'B' AS t FROM documents)),
n AS (SELECT *, trim(line, ' ' || chr(9)) AS bare FROM l), p AS (SELECT *, lag(CASE WHEN bare <> '' THEN bare END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM n)
SELECT doc_id, count(*) FILTER (bare <> '' AND (before IS NULL OR before <> bare)) AS kept FROM p GROUP BY 1""")  # fmt: skip
def dedupe_lines(spark: SparkSession, d: str) -> DataFrame:
    """Non-blank lines left after consecutive duplicates go."""
    t = text.dedupe_lines(F.concat("text", F.lit("\nA\n\nA\nB")))
    return table(spark, d, "documents").select("doc_id", F.size(F.filter(F.split(t, "\n"), lambda x: text.strip(x) != "")).cast("long").alias("kept"))


@query(r"""WITH a AS (SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '\[!\[[^\]]*\]\([^)]*\)\]\([^)]*\)', '', 'g'), '!\[[^\]]*\]\([^)]*\)', '', 'g'), '\[[^\]]*\]\([^)]*\)', '', 'g'), '<https?://[^>]+>', '', 'g') AS t FROM documents),
b AS (SELECT doc_id, array_to_string(list_filter(string_split(t, chr(10)), lambda x: x = '' OR NOT regexp_full_match(x, '[\s#\-"=_(\[\]).]+')), chr(10)) AS t FROM a),
c AS (SELECT doc_id, regexp_replace(translate(t, '«»“”‘’–—' || chr(160) || chr(8201) || '*_`+\' || chr(8203), repeat(chr(34), 4) || repeat(chr(39), 2) || '--       '), '(\r\n|\n|\r){3,}', chr(10) || chr(10), 'g') AS t FROM b),
l AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) AS i FROM c), n AS (SELECT *, regexp_replace(line, '^\s+|\s+$', '', 'g') AS bare FROM l),
o AS (SELECT *, row_number() OVER w AS o, lag(bare) OVER w AS before FROM n WHERE bare <> '' WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
k AS (SELECT *, i - lag(i) OVER w > o - lag(o) OVER w AS gap FROM o WHERE before IS NULL OR before <> bare WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
t AS (SELECT doc_id, regexp_replace(string_agg(CASE WHEN gap THEN chr(10) || line ELSE line END, chr(10) ORDER BY i), '^\s+|\s+$', '', 'g') AS t FROM k GROUP BY 1)
SELECT d.doc_id, coalesce(t, '') AS cleaned FROM documents d LEFT JOIN t ON d.doc_id = t.doc_id""")  # fmt: skip
def clean_text(spark: SparkSession, d: str) -> DataFrame:
    """The whole cleaning chain."""
    return table(spark, d, "documents").select("doc_id", text.clean(F.col("text")).alias("cleaned"))


LINES_SQL = """l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i FROM documents),
k AS (SELECT *, CASE WHEN regexp_full_match(line, '[ \\t\\r\\n\\f]*') THEN 'empty' WHEN len(regexp_extract_all(line, '[ \\t\\r\\f]{2,}')) >= 2 THEN 'tabular' WHEN regexp_matches(line, '^[ \\t]') THEN 'indented' ELSE 'paragraph' END AS kind FROM l)"""


@query(f"WITH {LINES_SQL} SELECT kind, count(*) AS n FROM k GROUP BY 1")
def line_types(spark: SparkSession, d: str) -> DataFrame:
    """Lines by kind."""
    return text.lines(table(spark, d, "documents")).groupBy("kind").agg(F.count("*").alias("n"))


@query(f"""WITH {LINES_SQL}, b AS (SELECT *, CASE WHEN kind <> coalesce(lag(kind) OVER w, 'empty') THEN 1 ELSE 0 END AS new FROM k WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
s AS (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS block FROM b)
SELECT doc_id, CAST(min(i) AS INTEGER) AS start_line, CAST(max(i) AS INTEGER) AS end_line, any_value(kind) AS kind, string_agg(line, chr(10) ORDER BY i) AS content FROM s WHERE kind <> 'empty' GROUP BY doc_id, block""")  # fmt: skip
def blocks(spark: SparkSession, d: str) -> DataFrame:
    """Blocks of neighbouring lines of one kind."""
    return text.blocks(table(spark, d, "documents"))


@query("""WITH RECURSIVE s AS (SELECT doc_id, list_transform(string_split(text, chr(10)), lambda x: length(x)) AS z FROM documents),
r AS (SELECT doc_id, z, 1 AS i, 1 AS first, CAST(0 AS BIGINT) AS held, CAST(NULL AS INTEGER) AS a, CAST(NULL AS INTEGER) AS b FROM s UNION ALL
  SELECT doc_id, z, i + 1, begins, CAST((CASE WHEN closes THEN coalesce(list_sum(list_slice(z, begins, i - 1)), 0) ELSE held END) + z[i] AS BIGINT), CASE WHEN closes THEN first END, CASE WHEN closes THEN i - 1 END
  FROM (SELECT *, CASE WHEN closes THEN i - CAST(floor(15 / 100 * (i - first)) AS INTEGER) ELSE first END AS begins FROM (SELECT *, held + z[i] > 200 AND i > first AS closes FROM r WHERE i <= len(z)))),
c AS (SELECT doc_id, a, b FROM r WHERE a IS NOT NULL UNION ALL SELECT doc_id, first, i - 1 FROM r WHERE i = len(z) + 1)
SELECT doc_id, list(CAST(range(a - 1, b) AS INTEGER[]) ORDER BY a, b) AS chunks FROM c GROUP BY 1""")  # fmt: skip
def chunk_packing(spark: SparkSession, d: str) -> DataFrame:
    """Lines packed greedily into chunks with overlap."""
    sizes = F.transform(F.split("text", "\n"), lambda x: F.length(x))
    return table(spark, d, "documents").select("doc_id", text.chunks(sizes, 200, 15).alias("chunks"))


RANGES = "SELECT user_id, event_id % 200 AS start, event_id % 200 + CAST(floor(value / 20) AS BIGINT) AS \"end\" FROM events"


def _ranges(spark: SparkSession, d: str) -> DataFrame:
    start = F.col("event_id") % 200
    return table(spark, d, "events").select("user_id", start.alias("start"), (start + F.floor(F.col("value") / 20)).alias("end"))


@query(f"""WITH r AS ({RANGES}), p AS (SELECT *, max("end") OVER (PARTITION BY user_id ORDER BY start, "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM r),
i AS (SELECT *, sum(CASE WHEN start <= before + 1 THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY start, "end" ROWS UNBOUNDED PRECEDING) AS island FROM p)
SELECT user_id, min(start) AS start, max("end") AS "end" FROM i GROUP BY user_id, island""")  # fmt: skip
def merge_ranges(spark: SparkSession, d: str) -> DataFrame:
    """Ranges merged with a gap of one."""
    return text.merge_ranges(_ranges(spark, d), ["user_id"])


@query(f'SELECT user_id, greatest(start - 3, 0) AS start, least("end" + 3, 199) AS "end" FROM ({RANGES})')
def expand_ranges(spark: SparkSession, d: str) -> DataFrame:
    """Ranges widened and clamped."""
    span = F.struct("start", "end")
    return _ranges(spark, d).select("user_id", F.inline(text.widen_spans(F.array(span), 3, F.lit(199))))


@query("""WITH g AS (SELECT user_id, ts, event_id, CASE WHEN ts - lag(ts) OVER w <= INTERVAL 6 HOUR THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session FROM g) SELECT user_id, min(ts) AS first, max(ts) AS last, count(*) AS n FROM s GROUP BY user_id, session""")  # fmt: skip
def sessionise(spark: SparkSession, d: str) -> DataFrame:
    """Runs of events less than six hours apart."""
    return stats.sessions(table(spark, d, "events"), ["user_id"], "ts", ["event_id"], "6 hours")


@query("""SELECT e.vec_id, round(max(list_inner_product(CAST(e.embedding AS DOUBLE[]), CAST(p.embedding AS DOUBLE[]))), 6) AS similarity FROM embeddings e, embeddings p WHERE p.vec_id < 5
GROUP BY 1 HAVING max(list_inner_product(CAST(e.embedding AS DOUBLE[]), CAST(p.embedding AS DOUBLE[]))) >= 0.3""")  # fmt: skip
def relevant_chunks(spark: SparkSession, d: str) -> DataFrame:
    """Vectors near any of five phrases."""
    every = table(spark, d, "embeddings")
    found = text.relevant_chunks(every.select("vec_id", F.col("embedding").alias("vector")), every.where("vec_id < 5").select(F.col("embedding").alias("vector")), 0.3)
    return found.select("vec_id", F.round("similarity", 6).alias("similarity"))


BREAKS_SQL = r"""regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
regexp_replace(html, '<p>([^<]*(?:<(?:br|/?b|/a|a [^>]*)>[^<]*)*)</article>', '<p>\1</p></article>', 'g'),
'(?s)<head>.*?</head>', '', 'g'), '(?s)<!--.*?-->', '', 'g'), '[ \t\r\n\f]+', ' ', 'g'), '<li>', chr(2) || chr(5), 'g'), '</?(p|h1)>', chr(3), 'g'), '<br>', chr(4), 'g'),
'</?(nav|ul|li|div|article|footer|body|html)( [^>]*)?>', chr(2), 'g'), '<[^>]*>', '', 'g'), ' +', ' ', 'g'), ' *([\x02-\x05]) *', '\1', 'g')"""


@query(rf"""WITH b AS (SELECT page_id, {BREAKS_SQL} AS t FROM pages),
l AS (SELECT page_id, regexp_replace(regexp_replace(regexp_replace(t, '[\x02\x04]*\x03[\x02-\x04]*', chr(10) || chr(10), 'g'), '[\x02\x04]+\x04[\x02\x04]*', chr(10) || chr(10), 'g'), '[\x02\x04]+', chr(10), 'g') AS t FROM b)
SELECT page_id, replace(replace(replace(replace(replace(replace(replace(trim(t, chr(10) || ' '), chr(5), '  * '), '&middot;', '·'), '&copy;', '©'), '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&') AS text FROM l""")  # fmt: skip
def html_text(spark: SparkSession, d: str) -> DataFrame:
    """Visible text of pages, laid out."""
    return table(spark, d, "pages").select("page_id", html_to_text("html").alias("text"))


@query(r"""WITH c AS (SELECT page_id, split_part(url, '://', 1) AS scheme, regexp_extract(url, '://([^/?#]*)', 1) AS host, CAST(page_id AS VARCHAR) AS id, CAST(length(html) AS VARCHAR) AS size FROM pages),
w AS (SELECT *, CAST(greatest(length(id), length(size), 4) AS INTEGER) AS first, CAST(greatest(length(scheme), 5) AS INTEGER) AS second FROM c)
SELECT page_id, rpad('Page', first, ' ') || '  Adresse' || chr(10) || rpad(id, first, ' ') || '  ' || rpad(scheme, second, ' ') || '  ' || host || chr(10) || rpad(size, first, ' ') || '  ' || rpad('durée', second, ' ') || '  & suite' AS text, 2 AS tabular FROM w""")  # fmt: skip
def html_tables(spark: SparkSession, d: str) -> DataFrame:
    """A table of each page's facts, in aligned columns, and how many of its lines read as tabular."""
    cell = lambda *parts: F.concat(F.lit("<td>"), *(F.lit(p) if isinstance(p, str) else p for p in parts), F.lit("</td>"))
    first = F.concat(cell(F.col("page_id").cast("string")), cell(F.substring_index("url", "://", 1)), cell(F.regexp_extract("url", "://([^/?#]*)", 1)))
    second = F.concat(F.lit("<tr>"), cell(F.length("html").cast("string")), cell(" <b>dur&eacute;e</b>"), cell("&amp;\n suite"))
    made = F.concat(F.lit("<table><thead><tr><th>Page<th colspan='2'>Adresse</thead><tbody><tr>"), first, second, F.lit("</table>"))
    found = table(spark, d, "pages").select("page_id", html_to_text(made).alias("text"))
    tabular = F.size(F.filter(F.split("text", "\n"), lambda x: text.line_type(x) == "tabular"))
    return found.select("page_id", "text", tabular.cast("int").alias("tabular"))


# -- hours -----------------------------------------------------------------------------------------------------

WEEKDAYS = "['Mo','Tu','We','Th','Fr','Sa','Su']"


def _ordered(spark: SparkSession, d: str) -> DataFrame:
    a, b = F.col("o_orderkey") % 7, F.col("o_custkey") % 7
    names = F.array(*map(F.lit, hours.DAYS))
    days = F.concat(F.element_at(names, (a + 1).cast("int")), F.lit("-"), F.element_at(names, (b + 1).cast("int")))
    h = (F.col("o_orderkey") % 10 + 6).cast("string")
    return table(spark, d, "orders").select("o_orderkey", a.alias("a"), b.alias("b"), days.alias("days"), F.concat(F.lpad(h, 2, "0"), F.lit(":00-12:30,14:00-18:15")).alias("slots"))


@query(f"""SELECT o_orderkey, array_to_string(list_transform(range(0, 1 + (o_custkey % 7 - o_orderkey % 7 + 7) % 7), lambda k: CAST((o_orderkey % 7 + k) % 7 AS VARCHAR)), ',') AS days,
{WEEKDAYS}[1 + o_orderkey % 7] || '-' || {WEEKDAYS}[1 + o_custkey % 7] AS said FROM orders""")  # fmt: skip
def osm_parse_days(spark: SparkSession, d: str) -> DataFrame:
    """Day ranges, wrapping past Sunday."""
    return _ordered(spark, d).select("o_orderkey", F.array_join(F.transform(hours.parse_days(F.col("days")), lambda x: x.cast("string")), ",").alias("days"), F.col("days").alias("said"))


@query("SELECT o_orderkey, lpad(CAST(o_orderkey % 10 + 6 AS VARCHAR), 2, '0') || ':00-12:30;14:00-18:15' AS slots FROM orders")
def osm_parse_slots(spark: SparkSession, d: str) -> DataFrame:
    """Times to slots."""
    slots = hours.parse_slots(F.col("slots"), F.lit(None).cast("array<int>"))
    return _ordered(spark, d).select("o_orderkey", F.array_join(F.transform(slots, hours.slot_text), ";").alias("slots"))


@query(f"""WITH m AS (SELECT o_orderkey, o_orderkey % 128 AS mask FROM orders), d AS (SELECT o_orderkey, k FROM m, range(7) t(k) WHERE (mask >> k) & 1 = 1),
g AS (SELECT *, k - row_number() OVER (PARTITION BY o_orderkey ORDER BY k) AS island FROM d),
r AS (SELECT o_orderkey, min(k) AS a, max(k) AS b FROM g GROUP BY o_orderkey, island)
SELECT o_orderkey, string_agg(CASE WHEN a = b THEN {WEEKDAYS}[a + 1] ELSE {WEEKDAYS}[a + 1] || '-' || {WEEKDAYS}[b + 1] END, ',' ORDER BY a) AS days FROM r GROUP BY 1""")  # fmt: skip
def osm_compress(spark: SparkSession, d: str) -> DataFrame:
    """Day sets as ranges."""
    bits = F.filter(F.array(*map(F.lit, range(7))), lambda k: F.pmod(F.floor(F.col("o_orderkey") % 128 / F.pow(F.lit(2), k)), F.lit(2)) == 1)
    return table(spark, d, "orders").select("o_orderkey", hours.compress_days(bits).alias("days")).where("days <> ''")


@query(f"""SELECT o_orderkey, {WEEKDAYS}[1 + o_orderkey % 7] || ' ' || lpad(CAST(o_orderkey % 10 + 6 AS VARCHAR), 2, '0') || ':00-12:30; ' || {WEEKDAYS}[1 + o_orderkey % 7] || ' 14:00-18:15' AS printed FROM orders""")
def osm_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """One day parsed and printed."""
    names = F.array(*map(F.lit, hours.DAYS))
    said = F.concat(F.element_at(names, (F.col("a") + 1).cast("int")), F.lit(" "), "slots")
    parsed = _ordered(spark, d).select("o_orderkey", hours.parse_osm(said).alias("s"))
    return parsed.select("o_orderkey", hours.print_week(F.col("s.week")).alias("printed"))


SLOTS_SQL = "SELECT l_orderkey, list_distinct(list(lpad(CAST(l_linenumber + 6 AS VARCHAR), 2, '0') || ':00') FILTER (l_returnflag = 'A')) AS a, list_distinct(list(lpad(CAST(l_linenumber + 6 AS VARCHAR), 2, '0') || ':00') FILTER (l_returnflag <> 'A')) AS b FROM lineitem GROUP BY 1"


@query(f"""SELECT l_orderkey, concat_ws(' | ', CASE WHEN len(x) > 0 THEN 'ajoutés: ' || array_to_string(list_sort(x), ', ') END, CASE WHEN len(y) > 0 THEN 'supprimés: ' || array_to_string(list_sort(y), ', ') END) AS diff FROM (
SELECT l_orderkey, list_filter(coalesce(b, []), lambda v: NOT list_contains(coalesce(a, []), v)) AS x, list_filter(coalesce(a, []), lambda v: NOT list_contains(coalesce(b, []), v)) AS y FROM ({SLOTS_SQL}))""")  # fmt: skip
def slot_diff(spark: SparkSession, d: str) -> DataFrame:
    """Slots added and removed."""
    slot = F.concat(F.lpad((F.col("l_linenumber") + 6).cast("string"), 2, "0"), F.lit(":00"))
    a = F.collect_set(F.when(F.col("l_returnflag") == "A", slot)).alias("a")
    b = F.collect_set(F.when(F.col("l_returnflag") != "A", slot)).alias("b")
    return table(spark, d, "lineitem").groupBy("l_orderkey").agg(a, b).select("l_orderkey", hours.slot_diff(F.col("a"), F.col("b")).alias("diff"))


@query("""SELECT coalesce(a.k, b.k) AS k, coalesce(a.n, 0) AS expected, coalesce(b.n, 0) AS found FROM (SELECT o_custkey AS k, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) a
FULL JOIN (SELECT o_custkey AS k, count(*) AS n FROM orders WHERE o_orderstatus = 'O' GROUP BY 1) b ON a.k = b.k""")  # fmt: skip
def schedule_full_join(spark: SparkSession, d: str) -> DataFrame:
    """Full outer pairing by key."""
    of = lambda s, n: table(spark, d, "orders").where(F.col("o_orderstatus") == s).groupBy(F.col("o_custkey").alias("k")).agg(F.count("*").alias(n))
    return state.paired(of("F", "expected"), of("O", "found"), "k", {"expected": 0, "found": 0})


@query("SELECT o_custkey, count(*) AS n FROM (SELECT DISTINCT o_custkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders) WHERE day > '1998-06-15' GROUP BY 1")
def future_dates(spark: SparkSession, d: str) -> DataFrame:
    """dates of a map strictly after a given day."""
    days = table(spark, d, "orders").select("o_custkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day")).distinct()
    maps = days.groupBy("o_custkey").agg(F.map_from_entries(F.collect_list(F.struct("day", F.lit("ferme")))).alias("m"))
    kept = documents.future_only(F.col("m"), F.lit("1998-06-15").cast("date"))
    return maps.select("o_custkey", F.size(kept).cast("long").alias("n")).where("n > 0")


@query("""SELECT o_custkey, h AS day, coalesce(any_value(s) FILTER (day = h), 'ferme') AS status FROM (SELECT o_custkey, strftime(o_orderdate, '%Y-%m-%d') AS day, 'ouvert' AS s FROM orders),
(SELECT unnest(['1998-05-01', '1998-05-08', '1998-07-14']) AS h) GROUP BY 1, 2""")  # fmt: skip
def holiday_overlay(spark: SparkSession, d: str) -> DataFrame:
    """Holidays added where a map lacks them; the map's own value wins."""
    listed = ["1998-05-01", "1998-05-08", "1998-07-14"]
    days = table(spark, d, "orders").select("o_custkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day")).distinct()
    maps = days.groupBy("o_custkey").agg(F.map_from_entries(F.collect_list(F.struct("day", F.lit("ouvert")))).alias("m"))
    holidays = F.create_map(*(F.lit(x) for h in listed for x in (h, "ferme")))
    merged = documents.with_holidays(F.col("m"), holidays, F.lit("Bibliothèque"))
    return maps.select("o_custkey", F.explode(F.map_filter(merged, lambda k, v: k.isin(listed))).alias("day", "status"))


@query("""SELECT event_id, CAST(CASE event_id % 4 WHEN 0 THEN 0 WHEN 1 THEN 2 WHEN 2 THEN 1 + event_id % 5 ELSE 1 + event_id % 3 END AS INTEGER) AS n FROM events""")
def atomic_diffs(spark: SparkSession, d: str) -> DataFrame:
    """Single changes in a difference text, of varied length."""
    k = F.col("event_id")
    slots = lambda n: F.array_join(F.transform(F.sequence(F.lit(0), n), lambda i: F.concat(F.lpad((i + 6).cast("string"), 2, "0"), F.lit(":00-20:00"))), ", ")
    said = (
        F.when(k % 4 == 0, "")
        .when(k % 4 == 1, "lundi: ouvert → fermé | créneaux: supprimés: 09:00-12:00")
        .when(k % 4 == 2, F.concat(F.lit("lundi: créneaux: ajoutés: "), slots((k % 5).cast("int"))))
        .otherwise(F.array_join(F.array_repeat(F.lit("ligne"), (k % 3 + 1).cast("int")), "\n"))
    )
    return table(spark, d, "events").select("event_id", hours.atomic_differences(said).cast("int").alias("n"))


@query("""SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS value FROM events GROUP BY 1, 2""")
def windowed_events(spark: SparkSession, d: str) -> DataFrame:
    """Streaming extension: counts by hour and type; the same plan runs on a stream."""
    return event_counts(table(spark, d, "events")).withColumn("value", F.round("value", 4))
