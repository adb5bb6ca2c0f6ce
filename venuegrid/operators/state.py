"""Incremental work selection and updates over the three state tables.

Work is chosen by column state: an empty column is to do, a filled one done, one that starts with ``Erreur`` done
with an error. Each stage reads what is pending, computes a delta keyed by result id and writes a new snapshot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from venuegrid.sources.tables import kept

ID = "id_resultats_extraction"


def pending_urls(results: DataFrame, venues: DataFrame, execution: Column) -> DataFrame:
    """Results of an execution not fetched yet, with their venue."""
    return with_venue(results.where((F.col("id_execution") == execution) & (F.col("statut_url") != "ok")), venues)


def pending_cleaning(results: DataFrame, execution: Column) -> DataFrame:
    """Fetched, with raw text, not cleaned."""
    return results.where((F.col("id_execution") == execution) & (F.col("statut_url") == "ok") & (F.col("markdown_brut") != "") & (F.col("markdown_nettoye") == ""))


def pending_filtering(results: DataFrame, execution: Column) -> DataFrame:
    """Cleaned, not filtered."""
    return results.where((F.col("id_execution") == execution) & (F.col("markdown_nettoye") != "") & (F.col("markdown_filtre") == ""))


def pending_extraction(results: DataFrame, venues: DataFrame, execution: Column) -> DataFrame:
    """Filtered, not extracted, with their venue."""
    todo = (F.col("id_execution") == execution) & (F.col("statut_url") == "ok") & (F.col("markdown_filtre") != "") & (F.col("llm_horaires_json") == "")
    return with_venue(results.where(todo), venues)


def pending_comparison(results: DataFrame, venues: DataFrame) -> DataFrame:
    """Extracted without an extraction error and not compared, of every execution."""
    json = F.col("llm_horaires_json")
    return with_venue(results.where((json != "") & ~json.ilike("Erreur LLM:%") & F.col("horaires_identiques").isNull()), venues)


def extracted(results: DataFrame) -> DataFrame:
    """Results that have a schedule."""
    return results.where(F.col("llm_horaires_json") != "")


def with_venue(results: DataFrame, venues: DataFrame) -> DataFrame:
    """Each result with the venue it belongs to."""
    return results.join(venues, F.col("lieu_id") == F.col("identifiant"))


def best_text() -> Column:
    """A result's most refined text: filtered, else cleaned, else raw."""
    return F.coalesce(*(F.nullif(F.col(c), F.lit("")) for c in ("markdown_filtre", "markdown_nettoye")), "markdown_brut")


def missing_step() -> Column:
    """The first step an incomplete result lacks: url, llm or osm; null if complete."""
    ok, json, osm = F.col("statut_url") == "ok", F.col("llm_horaires_json"), F.col("llm_horaires_osm")
    return F.when(~ok, "url").when(ok & (json == ""), "llm").when(ok & (json != "") & (osm == ""), "osm")


def reassign(results: DataFrame, execution: Column) -> DataFrame:
    """Incomplete results of other executions move to this one."""
    moved = (F.col("id_execution") != execution) & missing_step().isNotNull()
    return results.withColumn("id_execution", F.when(moved, execution).otherwise(F.col("id_execution")))


def new_venues(listed: DataFrame, results: DataFrame) -> DataFrame:
    """Listed venues without a result of any execution, each once."""
    return listed.join(results, F.col("identifiant") == F.col("lieu_id"), "left_anti").dropDuplicates(["identifiant"])


def paired(expected: DataFrame, found: DataFrame, key: str, absent: dict[str, object]) -> DataFrame:
    """Rows of both sides by key; columns that a side lacks for a key take the value stated in ``absent``."""
    both = expected.join(found, key, "full")
    return both.select(key, *(F.coalesce(c, F.lit(absent[c])).alias(c) if c in absent else F.col(c) for c in both.columns if c != key))


def upsert(stored: DataFrame, batch: DataFrame, key: str, order: str, columns: list[str]) -> DataFrame:
    """Insert or update by key: the batch's last row per key wins, by presence rather than by non-null values.

    Columns of stored that are not listed keep their value; a new key has null there.
    """
    last = Window.partitionBy(key).orderBy(F.desc(order))
    new = batch.withColumn("__n", F.row_number().over(last)).where("__n = 1").select(key, *(F.col(c).alias(f"__{c}") for c in columns), F.lit(True).alias("__new"))
    joined = stored.join(new, key, "full")
    return joined.select(key, *(F.when(F.col("__new"), F.col(f"__{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in stored.columns if c != key))


def apply_delta(results: DataFrame, delta: DataFrame, columns: list[str], key: str = ID) -> DataFrame:
    """A new snapshot in which rows named by delta take its columns."""
    new = delta.select(key, *(F.col(c).alias(f"__{c}") for c in columns), F.lit(True).alias("__new"))
    return results.join(new, key, "left").select(*(F.when(F.col("__new"), F.col(f"__{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in results.columns))


def number_from(rows: DataFrame, start: int, order: list[str], name: str) -> DataFrame:
    """Gapless surrogate keys after ``start``, by a stated order.

    Rows are range-partitioned by the order; each partition's count gives the next one's first number. They are
    written once with their partition and place: range boundaries come from a sample that every evaluation draws
    anew, so counts and keys have to come from the same rows.
    """
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumns({"__p": F.spark_partition_id(), "__m": F.monotonically_increasing_id()})
    dealt = kept(dealt, "numbered")
    counts = dealt.groupBy("__p").agg(F.count("*").alias("n"), F.min("__m").alias("__m0")).orderBy("__p").collect()  # a row per partition
    firsts, total = [], start
    for r in counts:
        firsts.append((r["__p"], total - r["__m0"]))
        total += r["n"]
    offset = F.create_map(*(F.lit(x) for p in firsts for x in p))[F.col("__p")] if firsts else F.lit(0)
    return dealt.withColumn(name, (F.col("__m") + offset + 1).cast("long")).drop("__p", "__m")


def add_error(old: Column, kind: str, message: Column, stamp: Column) -> Column:
    """The error chain with one more ``[HH:MM:SS] KIND: message``; an error it holds already is not repeated."""
    new = F.concat(F.lit("["), F.date_format(stamp, "HH:mm:ss"), F.lit(f"] {kind}: "), message)
    chain = F.concat_ws(" | ", F.nullif(old, F.lit("")), new)
    return F.when(message.isNull() | (message == ""), old).when(F.coalesce(old, F.lit("")).contains(F.concat(F.lit(f"] {kind}: "), message)), old).otherwise(chain)


def added(old: Column, more: Column) -> Column:
    """A running sum's new value; nulls count as nothing."""
    return F.coalesce(old, F.lit(0.0)) + F.coalesce(more, F.lit(0.0))


def settled(rows: DataFrame) -> DataFrame:
    """rows written once, for deltas that calls to the outside made: they must not be made again when a delta is read twice."""
    return kept(rows, "settled")


def outcome(category: Column, message: Column) -> Column:
    """What an error of a category leads to: ``solution`` for the log, and ``value``, which stands for the result (null: the default)."""
    said = F.lower(message)
    solution = (
        F.when((category == "llm") & said.contains("api key"), "Clé API invalide")
        .when((category == "llm") & said.contains("rate limit"), "Limite de taux atteinte")
        .when((category == "llm") & said.contains("timeout"), "Timeout LLM")
        .when(category == "parsing", "Erreur de parsing des données")
        .when(category == "validation", "Données invalides")
    )
    value = F.when((category == "llm") & (solution == "Timeout LLM"), "Erreur Timeout LLM").when(category == "validation", F.to_json(F.struct(F.lit("Validation failed").alias("error"), message.alias("details"))))
    return F.struct(solution.alias("solution"), value.alias("value"))


def error_summary(chain: Column) -> Column:
    """How many errors a chain has and its first with the number of others."""
    parts = F.filter(F.split(F.coalesce(chain, F.lit("")), r" \| "), lambda x: x != "")
    n = F.size(parts)
    more = F.concat(F.lit(" (et "), (n - 1).cast("string"), F.when(n > 2, " autres)").otherwise(" autre)"))
    return F.struct(n.alias("errors"), F.when(n > 1, F.concat(parts[0], more)).when(n == 1, parts[0]).otherwise("").alias("summary"))
