"""Pipeline statistics, report classification and evaluation metrics."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from venuegrid.operators.scan import ISLAND, islands

# Report statuses in display order.
STATUS_ORDER = ["success", "schedule_diff", "compare_error", "extraction_error", "access_error"]
STATUS_NAMES = {"success": "Succès", "schedule_diff": "Différences horaires", "compare_error": "Erreurs de comparaison", "extraction_error": "Erreurs d'extraction", "access_error": "Erreurs d'accès"}

# Sections of the statistics: title, and per item its column, label, unit and decimals.
SECTIONS = {
    "header": ("Statistiques du pipeline", {"execution_id": ("execution_id", "ID d'exécution", "", None), "timestamp": ("timestamp", "Horodatage", "", None)}),
    "urls": ("URLs", {
        "total": ("total", "Total des URLs", "", None), "successful": ("successful", "URLs réussies", "", None), "failed": ("failed", "URLs échouées", "", None), "success_rate": ("success_rate", "Taux de réussite", "%", 1),
        "avg_content_length": ("avg_content_length", "Taille moyenne du contenu", " caractères", 0), "http_errors": ("http_errors", "Erreurs HTTP", "", None), "timeout_errors": ("timeout_errors", "Erreurs de timeout", "", None),
    }),
    "markdown": ("Markdown", {
        "processed": ("processed", "Documents traités", "", None), "cleaned": ("cleaned", "Documents nettoyés", "", None), "filtered": ("filtered", "Documents filtrés", "", None),
        "avg_filtered_length": ("avg_filtered_length", "Taille moyenne après filtrage", " caractères", 0), "chars_cleaned": ("chars_cleaned", "Caractères supprimés lors du nettoyage", "", None),
    }),
    "llm": ("LLM", {
        "attempted": ("attempted", "Extractions tentées", "", None), "successful_json": ("json_ok", "Extractions JSON réussies", "", None), "successful_osm": ("osm_ok", "Extractions OSM réussies", "", None), "failed": ("failed", "Extractions échouées", "", None),
        "success_rate": ("success_rate", "Taux de réussite", "%", 1), "avg_schedule_length": ("avg_osm_length", "Taille moyenne des horaires", " caractères", 0), "total_co2_emissions": ("co2_g", "Émissions totales de CO2", "g", 3),
    }),
    "comparisons": ("Comparaisons", {
        "total": ("total", "Total des comparaisons", "", None), "identical": ("identical", "Horaires identiques", "", None), "different": ("different", "Horaires différents", "", None), "not_compared": ("not_compared", "Non comparés", "", None),
        "accuracy_rate": ("accuracy_rate", "Taux de précision", "%", 1),
    }),
    "global": ("Global", {
        "total_records": ("total_records", "Total des enregistrements", "", None), "records_with_errors": ("records_with_errors", "Enregistrements avec erreurs", "", None), "execution_date": ("execution_date", "Date d'exécution", "", None),
        "llm_model": ("llm_model", "Modèle LLM", "", None), "llm_provider": ("llm_provider", "Fournisseur LLM", "", None), "total_co2_emissions": ("total_co2_emissions", "Émissions totales de CO2", "g", 3),
    }),
}


def count_of(condition: Column, name: str) -> Column:
    return F.count_if(condition).cast("long").alias(name)


def percent(part: str, whole: str, name: str, digits: int = 4) -> Column:
    """100 * part / whole; 0 for an empty whole."""
    return F.round(F.coalesce(F.try_divide(100.0 * F.col(part), F.col(whole)), F.lit(0.0)), digits).alias(name)


# Every statistic of the results is made from these sums and counts, so those of parts can be added up.


def _url_parts() -> dict[str, Column]:
    ok = F.col("statut_url") == "ok"
    size = F.when(ok, F.length("markdown_brut"))
    return {
        "url_total": F.count("*"), "url_ok": F.count_if(ok), "url_failed": F.count_if(F.col("statut_url") != "ok"), "url_chars": F.sum(size), "url_sized": F.count(size),
        "url_http": F.count_if(F.col("code_http") >= 400), "url_timeout": F.count_if(F.col("code_http") == 0),
    }


def _text_parts() -> dict[str, Column]:
    brut, nettoye, filtre = F.col("markdown_brut"), F.col("markdown_nettoye"), F.col("markdown_filtre")
    size = F.when(filtre != "", F.length(filtre))
    lost = F.sum(F.when(brut.isNotNull() & nettoye.isNotNull(), F.length(brut) - F.length(nettoye)))
    return {"text_processed": F.count_if(brut != ""), "text_cleaned": F.count_if(nettoye != ""), "text_filtered": F.count_if(filtre != ""), "text_chars": F.sum(size), "text_sized": F.count(size), "text_lost": lost}


def _extraction_parts() -> dict[str, Column]:
    json, osm = F.col("llm_horaires_json"), F.col("llm_horaires_osm")
    good = (osm != "") & ~osm.ilike("Erreur%")
    size = F.when(good, F.length(osm))
    return {
        "llm_attempted": F.count_if(json != ""), "llm_json": F.count_if((json != "") & ~json.ilike("Erreur%")), "llm_osm": F.count_if(good), "llm_chars": F.sum(size), "llm_sized": F.count(size),
        "llm_kg": F.sum("llm_consommation_requete"),
    }


def _comparison_parts() -> dict[str, Column]:
    same = F.col("horaires_identiques")
    return {"cmp_total": F.count("*"), "cmp_same": F.count_if(same), "cmp_other": F.count_if(~same), "cmp_none": F.count_if(same.isNull())}


def _record_parts() -> dict[str, Column]:
    return {"all_total": F.count("*"), "all_errors": F.count_if(F.coalesce(F.col("erreurs_pipeline"), F.lit("")) != "")}


def _mean(of: str) -> Column:
    """A rounded mean from its sum and count; null of nothing."""
    return F.round(F.try_divide(F.col(f"{of}_chars"), F.col(f"{of}_sized")), 4)


def _sums(results: DataFrame, parts: dict[str, Column], keys: tuple[str, ...] = ()) -> DataFrame:
    return results.groupBy(*keys).agg(*(c.alias(name) for name, c in parts.items()))


def _long(name: str, to: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0)).cast("long").alias(to)


def _url_shown(sums: DataFrame) -> DataFrame:
    named = sums.select(_long("url_total", "total"), _long("url_ok", "successful"), _long("url_failed", "failed"), _mean("url").alias("avg_content_length"), _long("url_http", "http_errors"), _long("url_timeout", "timeout_errors"))
    return named.select("*", percent("successful", "total", "success_rate"))


def _text_shown(sums: DataFrame) -> DataFrame:
    return sums.select(_long("text_processed", "processed"), _long("text_cleaned", "cleaned"), _long("text_filtered", "filtered"), _mean("text").alias("avg_filtered_length"), _long("text_lost", "chars_cleaned"))


def _extraction_shown(sums: DataFrame) -> DataFrame:
    named = sums.select(_long("llm_attempted", "attempted"), _long("llm_json", "json_ok"), _long("llm_osm", "osm_ok"), _mean("llm").alias("avg_osm_length"), F.round(F.col("llm_kg") * 1000, 4).alias("co2_g"))
    return named.select("*", (F.col("attempted") - F.col("osm_ok")).alias("failed"), percent("osm_ok", "attempted", "success_rate"))


def _comparison_shown(sums: DataFrame) -> DataFrame:
    named = sums.select(_long("cmp_total", "total"), _long("cmp_same", "identical"), _long("cmp_other", "different"), _long("cmp_none", "not_compared"))
    return named.withColumn("compared", F.col("identical") + F.col("different")).select("total", "identical", "different", "not_compared", percent("identical", "compared", "accuracy_rate"))


def url_stats(results: DataFrame) -> DataFrame:
    """Fetch outcomes in one pass."""
    return _url_shown(_sums(results, _url_parts()))


def text_stats(results: DataFrame) -> DataFrame:
    """Cleaning and filtering volumes in one pass."""
    return _text_shown(_sums(results, _text_parts()))


def extraction_stats(results: DataFrame) -> DataFrame:
    """Extraction outcomes and emissions in one pass."""
    return _extraction_shown(_sums(results, _extraction_parts()))


def comparison_stats(results: DataFrame) -> DataFrame:
    """Comparison outcomes in one pass; the flag has three values."""
    return _comparison_shown(_sums(results, _comparison_parts()))


def partial_stats(results: DataFrame) -> DataFrame:
    """One row per execution: the sums and counts behind all statistics of its results."""
    return _sums(results, _url_parts() | _text_parts() | _extraction_parts() | _comparison_parts() | _record_parts(), ("id_execution",))


def merged_stats(partials: DataFrame) -> DataFrame:
    """The sums and counts of all executions, in one row, from the rows of ``partial_stats``."""
    return partials.agg(*(F.sum(c).alias(c) for c in partials.columns if c != "id_execution"))


def latest(executions: DataFrame, date: str, columns: list[str]) -> DataFrame:
    """The latest date with the columns of that row, in one scan."""
    return executions.agg(F.max(date).alias("latest"), *(F.max_by(c, F.struct(date, c)).alias(f"latest_{c}") for c in columns), F.count("*").alias("executions"))


def report_status(source_found: Column | None = None) -> Column:
    """One of five statuses; the comparison outcome comes first, then access, then extraction."""
    same, code, osm, reference = (F.col(c) for c in ("horaires_identiques", "code_http", "llm_horaires_osm", "horaires_data_gl"))
    reached = (F.col("statut_url") == "ok") & code.between(200, 299)
    lacks = lambda c: c.isNull() | (F.trim(c) == "") | c.startswith("Erreur")
    unknown = F.lit(False) if source_found is None else ~F.coalesce(source_found, F.lit(True))
    return F.when(same, "success").when(~same, "schedule_diff").when(~F.coalesce(reached, F.lit(False)), "access_error").when(unknown | lacks(osm) | lacks(reference), "extraction_error").otherwise("compare_error")


def status_counts(rows: DataFrame) -> DataFrame:
    """Counts and shares of the statuses present, with their place in the report."""
    at = F.array_position(F.array(*map(F.lit, STATUS_ORDER)), F.col("status")).cast("int")
    counts = rows.groupBy("status").agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy())  # a row per status
    return counts.select("status", at.alias("place"), "n", F.round(100.0 * F.col("n") / total, 1).alias("share"))


def outcome_counts(rows: DataFrame) -> DataFrame:
    """Counters of the whole report from the column status: total, and comparisons done, identical, different, not done."""
    same, other = F.count_if(F.col("status") == "success"), F.count_if(F.col("status") == "schedule_diff")
    n = F.count("*")
    return rows.agg(n.alias("total_urls"), (same + other).alias("comparisons_done"), same.alias("comparisons_identical"), other.alias("comparisons_different"), (n - same - other).alias("comparisons_not_done"))


def global_stats(executions: DataFrame, results: DataFrame) -> DataFrame:
    """One row: records, records with errors, the latest execution's date, model and provider, and all emissions in grams."""
    return _global_shown(executions, _sums(results, _record_parts()))


def _global_shown(executions: DataFrame, sums: DataFrame) -> DataFrame:
    last = lambda c: F.max_by(c, F.struct("date_execution", "id_execution"))
    runs = executions.agg(F.max("date_execution").alias("execution_date"), last("llm_modele").alias("llm_model"), last("llm_fournisseur").alias("llm_provider"), F.round(F.coalesce(F.sum("llm_consommation_execution"), F.lit(0.0)) * 1000, 4).alias("total_co2_emissions"))
    rows = sums.select(_long("all_total", "total_records"), _long("all_errors", "records_with_errors"))
    # two rows of one: each side has exactly one
    return rows.withColumn("one", F.lit(1)).join(runs.withColumn("one", F.lit(1)), "one").drop("one")


def item_rows(section: str, stats: DataFrame) -> DataFrame:
    """A one-row frame of statistics in long form: section, title, item, label, value, formatted_value, unit."""
    title, items = SECTIONS[section]
    made = []
    for item, (column, label, unit, digits) in items.items():
        value = F.col(column)
        number = stats.schema[column].dataType.typeName() in ("double", "float", "long", "integer")
        shown = F.concat(F.format_string(f"%.{digits}f", F.bround(value.cast("double"), digits)), F.lit(unit)) if digits is not None and number else F.concat(value.cast("string"), F.lit(unit))
        made.append(F.struct(F.lit(section).alias("section"), F.lit(title).alias("title"), F.lit(item).alias("item"), F.lit(label).alias("label"), value.cast("string").alias("value"), F.coalesce(shown, F.lit("N/A")).alias("formatted_value"), F.lit(unit).alias("unit")))
    return stats.select(F.inline(F.array(*made)))


def sections(executions: DataFrame, results: DataFrame, stamp: str) -> DataFrame:
    """All sections of the statistics in long form: header, URLs, Markdown, extraction, comparison and global."""
    every = _url_parts() | _text_parts() | _extraction_parts() | _comparison_parts() | _record_parts()
    return sections_of(executions, _sums(results, every), stamp)


def sections_of(executions: DataFrame, sums: DataFrame, stamp: str) -> DataFrame:
    """As ``sections``, from one row of sums and counts (see ``merged_stats``)."""
    header = sums.sparkSession.range(1).select(F.lit("global").alias("execution_id"), F.lit(stamp).alias("timestamp"))
    each = {"header": header, "urls": _url_shown(sums), "markdown": _text_shown(sums), "llm": _extraction_shown(sums), "comparisons": _comparison_shown(sums), "global": _global_shown(executions, sums)}
    rows = [item_rows(name, frame) for name, frame in each.items()]
    out = rows[0]
    for more in rows[1:]:
        out = out.unionByName(more)
    return out


def custom_text(template: str, rows: list) -> str:
    """A template with ``{section.item}`` replaced by the formatted and ``{section.item_value}`` by the bare value.

    rows are those of ``sections``, a few dozen. Places that name nothing stay as they are.
    """
    said = {f"{r['section']}.{r['item']}": r["formatted_value"] for r in rows} | {f"{r['section']}.{r['item']}_value": str(r["value"]) for r in rows}
    return re.sub(r"\{([a-z_]+\.[a-z0-9_]+)\}", lambda m: said.get(m[1], m[0]), template)


def counts_by(rows: DataFrame, key: str, first: str) -> DataFrame:
    """Count per key with the first position it was seen at."""
    return rows.groupBy(key).agg(F.count("*").alias("n"), F.min(first).alias("first_seen"))


def by_execution(results: DataFrame) -> DataFrame:
    """Emissions in grams and results of each execution."""
    return results.groupBy("id_execution").agg(F.round(F.sum("llm_consommation_requete") * 1000, 4).alias("co2_g"), F.count("*").alias("n"))


def error_counts(errors: DataFrame) -> DataFrame:
    """Errors by ``category`` and ``severity``."""
    return errors.groupBy("category", "severity").agg(F.count("*").alias("n"))


def last_errors(errors: DataFrame, order: list[str], n: int = 5) -> DataFrame:
    """The ``n`` latest errors."""
    return errors.orderBy(*(F.desc(c) for c in order)).limit(n)


def sessions(events: DataFrame, keys: list[str], at: str, order: list[str], pause: str) -> DataFrame:
    """Runs of a key's events at most ``pause`` apart: the keys, ``first``, ``last`` and ``n``; no key is left to one task."""
    found = islands(events.select(*keys, at, *order), keys, [at, *order], F.col(at), lambda far: F.col(at) > far + F.expr(f"INTERVAL {pause}"))
    return found.groupBy(*keys, ISLAND).agg(F.min(at).alias("first"), F.max(at).alias("last"), F.count("*").alias("n")).drop(ISLAND)


def evaluation(scores: DataFrame) -> DataFrame:
    """Accuracy, differences and their mean over differing items (columns: status, diff_count)."""
    differing = F.when(F.col("status") == "Différent", F.col("diff_count"))
    return scores.agg(F.count("*").alias("total"), F.round(100.0 * F.avg((F.col("status") == "Identique").cast("int")), 4).alias("accuracy"), F.sum("diff_count").cast("long").alias("differences"), F.round(F.coalesce(F.avg(differing), F.lit(0.0)), 4).alias("mean_differences"))


def difference_histogram(scores: DataFrame) -> DataFrame:
    """How many differing items have each count of differences (columns: status, diff_count)."""
    return scores.where(F.col("status") == "Différent").groupBy("diff_count").agg(F.count("*").alias("n"))


def formatted(value: float | None, digits: int = 1, unit: str = "") -> str:
    """A statistic for display; N/A if there is none."""
    return "N/A" if value is None else f"{value:.{digits}f}{unit}"
