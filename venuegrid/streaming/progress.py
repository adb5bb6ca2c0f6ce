"""Results by key on a stream: arrivals and answers move a result from step to step, timers bring failed ones back.

The state of a result is one row. Only rows that change are written, each micro-batch to a folder of its own; a batch
that runs again overwrites its folder, so the table read back from the folders is the same.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from venuegrid.functions.text import clean
from venuegrid.operators.state import ID
from venuegrid.sources.providers import DELAY, TRIES

#: What happens to a result: it arrives, or an answer to its page comes in. ``seq`` numbers a result's events.
EVENTS = f"{ID} long, seq long, at timestamp, kind string, id_execution long, statut_url string, code_http int, message_url string, markdown_brut string"
_KEPT = "seq long, version long, step string, tries int, id_execution long, statut_url string, code_http int, message_url string, markdown_brut string"
#: A result after a change. Steps: fetch (F1), waiting for its next try, retry (due again), failed, clean (F2).
CHANGES = f"{ID} long, {_KEPT}"
_NAMES = [c.split()[0] for c in _KEPT.split(", ")]


class Progress(StatefulProcessor):
    """One result's state; an event that is not newer than the last one seen changes nothing, nor does one after success."""

    def __init__(self, tries: int = TRIES, delay: float = DELAY) -> None:
        self.tries, self.delay = tries, timedelta(seconds=delay)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("result", _KEPT)

    def _read(self) -> dict:
        return dict(zip(_NAMES, self.state.get(), strict=True)) if self.state.exists() else {n: None for n in _NAMES} | {"seq": -1, "version": 0, "tries": 0}

    def _written(self, key: int, row: dict) -> Row:
        row["version"] += 1
        values = tuple(row[n] for n in _NAMES)
        self.state.update(values)
        return Row(**{ID: key}, **dict(zip(_NAMES, values, strict=True)))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: ANN001, N802, N803  the interface's names
        row, changed = self._read(), False
        for event in sorted(rows, key=lambda r: r.seq):
            if event.seq <= row["seq"] or row["step"] == "clean":
                continue
            row["seq"], changed = event.seq, True
            if event.kind == "arrived":
                row |= {"step": row["step"] or "fetch", "id_execution": event.id_execution}
                continue
            row |= {n: event[n] for n in ("statut_url", "code_http", "message_url", "markdown_brut")}
            if event.statut_url == "ok":
                row["step"] = "clean"
            else:
                row["tries"] += 1
                row["step"] = "waiting" if row["tries"] < self.tries else "failed"
                if row["step"] == "waiting":
                    self.handle.registerTimer(int((event["at"] + self.delay).timestamp() * 1000))
        if changed:
            yield self._written(key[0], row)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: ANN001, N802, N803
        row = self._read()
        if row["step"] == "waiting":
            row["step"] = "retry"
            yield self._written(key[0], row)

    def close(self) -> None:
        pass


def changes(events: DataFrame, tries: int = TRIES, delay: float = DELAY, late: str = "0 seconds") -> DataFrame:
    """The rows (CHANGES) that a stream of EVENTS changes; a failed result is due again ``delay`` seconds of event time later."""
    grouped = events.withWatermark("at", late).groupBy(ID)
    return grouped.transformWithState(Progress(tries, delay), CHANGES, "Append", "EventTime")


def write_changes(rows: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Write each micro-batch's changes, with cleaned texts, to its own folder below ``folder``."""

    def take(batch: DataFrame, number: int) -> None:
        done = F.when(F.col("step") == "clean", clean(F.col("markdown_brut")))
        batch.withColumn("markdown_nettoye", done).write.mode("overwrite").parquet(f"{folder}/batch={number}")

    return rows.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current(spark: SparkSession, folder: str) -> DataFrame:
    """Every result's newest row of those written; none before the first."""
    try:
        rows = spark.read.schema(f"{CHANGES}, markdown_nettoye string").parquet(f"{folder}/batch=*")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], f"{CHANGES}, markdown_nettoye string")
    every = F.struct("version", *(c for c in rows.columns if c not in (ID, "version")))
    return rows.groupBy(ID).agg(F.max_by(every, "version").alias("r")).select(ID, "r.*")


def pending(spark: SparkSession, folder: str, execution: int) -> DataFrame:
    """Results of an execution to fetch: new ones, and those due again (F1)."""
    return current(spark, folder).where((F.col("id_execution") == execution) & F.col("step").isin("fetch", "retry"))


def settled(events: DataFrame, until: str, tries: int = TRIES, delay: float = DELAY) -> DataFrame:
    """The same table from all events at once, as of the moment ``until``: what a stream of them comes to."""
    once = events.dropDuplicates([ID, "seq"])
    good = (F.col("kind") != "arrived") & (F.col("statut_url") == "ok")
    ends = once.groupBy(F.col(ID).alias("of")).agg(F.min(F.when(good, F.col("seq"))).alias("end"))
    seen = once.join(ends, F.col(ID) == F.col("of")).where(F.col("end").isNull() | (F.col("seq") <= F.col("end")))
    answer, bad = F.col("kind") != "arrived", (F.col("kind") != "arrived") & (F.col("statut_url") != "ok")
    last = lambda c: F.max_by(F.when(answer, F.col(c)), F.when(answer, F.col("seq"))).alias(c)
    rows = seen.groupBy(ID).agg(
        F.max("seq").alias("seq"), F.count_if(bad).cast("int").alias("tries"), F.max_by(F.when(~answer, F.col("id_execution")), F.when(~answer, F.col("seq"))).alias("id_execution"),
        *(last(c) for c in ("statut_url", "code_http", "message_url", "markdown_brut")), F.max(F.when(bad, F.col("at"))).alias("failed_at"),
    )
    due = F.col("failed_at") + F.make_dt_interval(secs=F.lit(delay)) <= F.lit(until).cast("timestamp")
    step = F.when(F.col("statut_url").isNull(), "fetch").when(F.col("statut_url") == "ok", "clean").when(F.col("tries") >= tries, "failed").when(due, "retry").otherwise("waiting")
    return rows.withColumn("step", step).withColumn("markdown_nettoye", F.when(F.col("step") == "clean", clean(F.col("markdown_brut")))).drop("failed_at")
