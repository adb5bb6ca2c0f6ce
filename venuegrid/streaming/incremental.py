"""A streaming run of the cleaning stage: micro-batches of new results become deltas on the state table."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from venuegrid.functions.text import clean
from venuegrid.operators.state import ID, apply_delta
from venuegrid.sources.tables import Store, kept

#: The table of results, and the folder beside it that holds what arrived.
RESULTS_TABLE, ARRIVALS = "resultats_extraction", "arrivees"


def cleaned(results: DataFrame) -> DataFrame:
    """Results with ``markdown_nettoye`` from their raw text, where it is due."""
    due = (F.col("statut_url") == "ok") & (F.col("markdown_brut") != "") & (F.col("markdown_nettoye") == "")
    return results.where(due).withColumn("markdown_nettoye", clean(F.col("markdown_brut")))


def clean_stream(arrivals: DataFrame, store: Store, checkpoint: str) -> StreamingQuery:
    """Write each micro-batch's results, cleaned, to a folder of its own beside the tables; a batch that runs twice writes the same.

    arrivals: a streaming frame with the results schema. ``absorb`` takes what was written into the table, once for
    many batches, so that no batch rewrites what others wrote.
    """

    def take(batch: DataFrame, number: int) -> None:
        apply_delta(batch, cleaned(batch), ["markdown_nettoye"]).write.mode("overwrite").parquet(f"{store.root}/{ARRIVALS}/batch={number}")

    return arrivals.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def absorb(store: Store) -> int:
    """Take arrived results that the table lacks into it, of a repeated id the first; how many parts were rewritten."""
    try:
        arrived = store.spark.read.option("basePath", f"{store.root}/{ARRIVALS}").parquet(f"{store.root}/{ARRIVALS}/batch=*")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return 0
        raise
    rows = [c for c in arrived.columns if c not in (ID, "batch")]
    order = F.struct("batch", F.xxhash64(*rows))
    first = arrived.groupBy(ID).agg(F.min_by(F.struct(*rows), order).alias("r")).select(ID, "r.*")
    fresh = kept(first.join(store.read(RESULTS_TABLE).select(ID), ID, "left_anti"), "arrived")
    touched = [r[0] for r in fresh.select("id_execution").distinct().collect()]  # executions, whose parts alone are rewritten
    if touched:
        store.rewrite(RESULTS_TABLE, store.read(RESULTS_TABLE, touched).unionByName(fresh), touched)
    return len(touched)


def event_counts(events: DataFrame, late: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """Counts and sums per window and event type; works on batch and, with a watermark, on streaming frames."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("value")).select(F.col("window.start").alias("start"), "event_type", "n", "value")
