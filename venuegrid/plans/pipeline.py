"""The venue pipeline: each stage reads what is pending, makes a delta and rewrites the executions it touches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from venuegrid.functions import documents, text
from venuegrid.operators import state, stats
from venuegrid.plans.prompt import prompt
from venuegrid.schema import EXECUTIONS, RESULTS, VENUES
from venuegrid.sources.providers import Fetch, fetch, hash_embedding, html_to_text
from venuegrid.sources.tables import Store
from venuegrid.streaming.incremental import cleaned

RESULTS_TABLE, STATS_TABLE = "resultats_extraction", "statistiques"
#: Days that a year's calendar can have.
CALENDAR = 366
#: Reference phrases of the offline run; a deployment states its own.
PHRASES = "horaires d'ouverture;;ouvert fermé du lundi au dimanche;;Mo-Fr 09:00-12:00"


def last_source(references: list[DataFrame]) -> DataFrame:
    """``identifiant`` and ``horaires`` of several sources; of one venue's the last source that names it, there the greatest text."""
    every = [r.select("identifiant", "horaires", F.lit(k).alias("source")) for k, r in enumerate(references)]
    rows = every[0]
    for more in every[1:]:
        rows = rows.unionByName(more)
    return rows.groupBy("identifiant").agg(F.max_by("horaires", F.struct("source", "horaires")).alias("horaires_data_gl"))


def setup(store: Store, listed: DataFrame, references: DataFrame | list[DataFrame], now: str, model: str = "") -> int:
    """Upsert venues and reference hours, open an execution, take over incomplete results and add new ones.

    Of several rows for a venue the last one counts: the one with the greatest ``position`` if listed has that column,
    else the last in the order in which Spark reads them.
    """
    at = F.col("position") if "position" in listed.columns else F.monotonically_increasing_id()
    batch = listed.withColumn("__at", at).select("identifiant", "nom", "type_lieu", "url", "__at")
    venues = state.upsert(store.read("lieux"), batch, "identifiant", "__at", ["nom", "type_lieu", "url"])
    given = last_source(references if isinstance(references, list) else [references])
    given = given.withColumn("horaires_data_gl_json", documents.document(F.col("horaires_data_gl")))
    venues = state.apply_delta(venues, given, ["horaires_data_gl", "horaires_data_gl_json"], "identifiant")
    store.write("lieux", venues.select(*(F.col(f.name).cast(f.dataType) for f in VENUES)))
    executions, results = store.read("executions"), store.read(RESULTS_TABLE)
    execution = (executions.agg(F.max("id_execution")).first()[0] or 0) + 1
    row = store.spark.range(1).select(F.lit(execution).cast("long"), F.lit(now).cast("timestamp_ntz"), F.lit(model), F.lit(""), F.lit(""), F.lit(0.0)).toDF(*(f.name for f in EXECUTIONS))
    store.write("executions", executions.unionByName(row))
    last = results.agg(F.max(state.ID)).first()[0] or 0
    fresh = state.number_from(state.new_venues(store.read("lieux"), results).select("identifiant"), last, ["identifiant"], state.ID)
    blank = {"code_http": F.lit(0), "llm_consommation_requete": F.lit(0.0), "horaires_identiques": F.lit(None), "lieu_id": F.col("identifiant"), "id_execution": F.lit(execution), state.ID: F.col(state.ID)}
    fresh = fresh.select(*(blank.get(f.name, F.lit("")).cast(f.dataType).alias(f.name) for f in RESULTS))
    left = [r[0] for r in results.where(state.missing_step().isNotNull()).select("id_execution").distinct().collect()]  # executions
    touched = store.read(RESULTS_TABLE, left) if left else results.where("false")
    store.rewrite(RESULTS_TABLE, state.reassign(touched, F.lit(execution)).unionByName(fresh), [*left, execution])
    refresh_stats(store, [*left, execution])
    return execution


def _apply(store: Store, delta: DataFrame, columns: list[str]) -> list[int]:
    """Put a delta with the column id_execution into the parts of the results that it touches: these executions."""
    touched = [r[0] for r in delta.select("id_execution").distinct().collect()]
    if touched:
        store.rewrite(RESULTS_TABLE, state.apply_delta(store.read(RESULTS_TABLE, touched), delta, columns), touched)
    return touched


def counted(delta: DataFrame, **counts: Column) -> tuple[DataFrame, dict[str, int]]:
    """delta written once, and aggregates over its rows from the very job that writes it."""
    seen = Observation()
    written = state.settled(delta.observe(seen, *(c.cast("long").alias(name) for name, c in counts.items())))
    return written, {name: value or 0 for name, value in seen.get.items()}


def refresh_stats(store: Store, executions: list[int]) -> None:
    """Recompute the partial statistics of some executions; the other parts of the results are not read."""
    if not executions:
        return
    fresh = stats.partial_stats(store.read(RESULTS_TABLE, executions))
    if store.exists(STATS_TABLE):
        store.rewrite(STATS_TABLE, fresh, executions)
    else:
        store.write(STATS_TABLE, fresh)


def report_stats(store: Store, stamp: str) -> DataFrame:
    """The statistics' sections from the executions' partial statistics alone."""
    return stats.sections_of(store.read("executions"), stats.merged_stats(store.read(STATS_TABLE)), stamp)


def fetch_pages(store: Store, execution: int, provider: Fetch, tries: int = 3, delay: float = 5.0) -> dict[str, int]:
    """Fetch pending urls and keep their visible text; a failure joins the error chain. How many were asked, and how many failed."""
    due = state.pending_urls(store.read(RESULTS_TABLE, [execution]), store.read("lieux"), F.lit(execution)).select(state.ID, "id_execution", "url", "erreurs_pipeline")
    got = fetch(due, provider, tries=tries, delay=delay).withColumn("markdown_brut", html_to_text("html"))
    failed = F.when(F.col("statut_url") != "ok", F.col("message_url"))
    got = got.withColumn("erreurs_pipeline", state.add_error(F.col("erreurs_pipeline"), "URL", failed, F.current_timestamp()))
    delta, counts = counted(got, asked=F.count("*"), failed=F.count_if(failed.isNotNull()))
    refresh_stats(store, _apply(store, delta, ["statut_url", "code_http", "message_url", "markdown_brut", "erreurs_pipeline"]))
    return counts


def clean_pages(store: Store) -> dict[str, int]:
    """Clean fetched text; how many texts there were, how many are not empty after, and how many characters were replaced."""
    due = cleaned(store.read(RESULTS_TABLE)).withColumn("replaced", text.replaced_characters(F.col("markdown_brut")))
    delta, counts = counted(
        due, texts_processed=F.count_if(F.col("markdown_brut") != ""), texts_successful=F.count_if((F.col("markdown_brut") != "") & (F.col("markdown_nettoye") != "")), chars_replaced=F.sum("replaced")
    )
    refresh_stats(store, _apply(store, delta, ["markdown_nettoye"]))
    return counts


def filter_pages(store: Store, execution: int, phrases: str = PHRASES, embed=hash_embedding, threshold: float = 0.0, around: int = 1) -> None:
    """Keep of cleaned texts what lies near the reference phrases."""
    due = state.pending_filtering(store.read(RESULTS_TABLE, [execution]), F.lit(execution))
    listed = store.spark.createDataFrame([(p,) for p in text.phrase_list(phrases)], "phrase string").select(embed("phrase").alias("vector"))
    near = text.filter_pages(due, listed, embed, state.ID, "markdown_nettoye", threshold=threshold, around=around)
    delta = due.select(state.ID, "id_execution").join(near, state.ID).withColumnRenamed("filtered", "markdown_filtre")
    refresh_stats(store, _apply(store, delta, ["markdown_filtre"]))


Extractor = Callable[[Column], Column]


def extract(store: Store, execution: int, extractor: Extractor, holidays: tuple[DataFrame, DataFrame] | None = None, today: Column | None = None) -> None:
    """Hours from filtered text by an expression that stands in for a model.

    It takes the text and gives a struct of ``content`` (a JSON document), ``failure`` (why the call failed, or null)
    and ``co2``. ``holidays``: this year's and next year's calendars (``day``, ``name``).
    """
    due = state.pending_extraction(store.read(RESULTS_TABLE, [execution]), store.read("lieux"), F.lit(execution))
    day = F.current_date() if today is None else today
    calendars = [_calendar(c) for c in holidays] if holidays else [F.from_json(F.lit("{}"), "map<string,string>")] * 2
    coming = documents.holiday_dates(*calendars, day)
    best = F.coalesce(state.best_text(), F.lit(""))
    got = due.withColumn("answer", extractor(best)).withColumn("prompt_message", prompt(F.col("type_lieu"), F.col("nom"), best, F.year(day)))
    got = state.settled(got.withColumn("found", documents.outcome(F.col("answer.content"), F.col("answer.failure"), F.col("type_lieu"), coming, day)))
    delta = got.select(
        state.ID, "id_execution", "prompt_message", F.col("found.json").alias("llm_horaires_json"), F.col("found.osm").alias("llm_horaires_osm"),
        state.added(F.col("llm_consommation_requete"), F.col("answer.co2")).alias("llm_consommation_requete"), documents.outcome_errors(F.col("erreurs_pipeline"), F.col("found"), F.current_timestamp()).alias("erreurs_pipeline"),
    )
    refresh_stats(store, _apply(store, delta, [c for c in delta.columns if c not in (state.ID, "id_execution")]))
    used = store.read(RESULTS_TABLE, [execution]).agg(F.sum("llm_consommation_requete")).first()[0] or 0.0
    executions = store.read("executions")
    total = F.when(F.col("id_execution") == execution, F.lit(used)).otherwise(F.col("llm_consommation_execution"))
    store.write("executions", executions.withColumn("llm_consommation_execution", total))


def _calendar(days: DataFrame) -> Column:
    """A year's holidays as a map literal: a day once, with the least of its names. More than CALENDAR days are an error."""
    rows = days.groupBy("day").agg(F.min("name").alias("name")).limit(CALENDAR + 1).collect()
    if len(rows) > CALENDAR:
        raise ValueError(f"a year's calendar has more than {CALENDAR} days")
    return F.create_map(*(F.lit(x) for r in sorted(rows) for x in r)) if rows else F.from_json(F.lit("{}"), "map<string,string>")


def compare(store: Store) -> None:
    """Compare extracted with reference documents; pairs that cannot be compared keep a null flag and say why."""
    due = state.pending_comparison(store.read(RESULTS_TABLE), store.read("lieux"))
    reference, found = F.col("horaires_data_gl_json"), F.col("llm_horaires_json")
    both = due.withColumn("problem", documents.comparison_problem(reference, found)).withColumn("c", documents.compare(reference, found))
    both = state.settled(both.select(state.ID, "id_execution", "problem", "c", "erreurs_pipeline"))
    delta = both.select(
        state.ID, "id_execution", F.when(F.col("problem").isNull(), F.col("c.identical")).alias("horaires_identiques"), F.coalesce("problem", "c.differences").alias("differences_horaires"),
        state.add_error(F.col("erreurs_pipeline"), "COMPARAISON", F.col("problem"), F.current_timestamp()).alias("erreurs_pipeline"),
    )
    refresh_stats(store, _apply(store, delta, ["horaires_identiques", "differences_horaires", "erreurs_pipeline"]))


def first_hours(found: Column) -> Column:
    """An offline extractor: the document of the first line that reads like opening hours."""
    lines = F.filter(F.transform(F.split(found, "\n"), text.strip), lambda x: x.rlike(r"^(Mo|Tu|We|Th|Fr|Sa|Su)[^a-z].*[0-9]{2}:[0-9]{2}"))
    said = F.try_element_at(lines, F.lit(1))
    return F.struct(documents.document(said).alias("content"), F.when(said.isNull(), "aucun horaire").alias("failure"), F.lit(0.0).alias("co2"))


def run(store: Store, listed: DataFrame, references: DataFrame | list[DataFrame], provider: Fetch, now: str, tries: int = 3, delay: float = 5.0) -> int:
    """All stages once; the execution's number."""
    execution = setup(store, listed, references, now)
    fetch_pages(store, execution, provider, tries, delay)
    clean_pages(store)
    filter_pages(store, execution)
    extract(store, execution, first_hours)
    compare(store)
    return execution


def evaluate(truths: DataFrame, predictions: DataFrame) -> DataFrame:
    """One row per evaluated url: status, diff_count and differences (truths: url, ground_truth_osm; predictions: url, osm)."""
    both = truths.join(predictions.select("url", "osm"), "url", "left")
    return both.select("url", "ground_truth_osm", "osm", documents.score(F.col("osm"), F.col("ground_truth_osm")).alias("s")).select("url", "ground_truth_osm", "osm", "s.*")
