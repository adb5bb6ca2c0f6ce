"""Results by key on a stream against the batch run over the same events."""

import random
from datetime import datetime, timedelta

import pytest

from venuegrid.operators.state import ID
from venuegrid.streaming import progress

START = datetime(2025, 1, 1, 10, 0, 0)
COLUMNS = [ID, "seq", "step", "tries", "id_execution", "statut_url", "code_http", "message_url", "markdown_brut", "markdown_nettoye"]


@pytest.fixture(autouse=True)
def rocks(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    yield
    spark.conf.set(name, before)


def made(n=40):
    """Batches of events: arrivals, failures, recoveries, events told twice and after success."""
    rng = random.Random(4)
    batches = [[] for _ in range(5)]
    for k in range(n):
        at = START + timedelta(seconds=k % 7)
        batches[0].append((k, 0, at, "arrived", 1 + k % 2, None, None, None, None))
        seq = 1
        for b in range(1, 4):
            if rng.random() < 0.7:
                ok = rng.random() < 0.4
                batches[b].append((k, seq, START + timedelta(seconds=100 * b + k % 7), "answered", None, "ok" if ok else "critical", 200 if ok else 0, "" if ok else f"try {seq}", f"page **{k}**\n\n\n\nend" if ok else ""))
                seq += 1
        if k % 5 == 0 and batches[1] and batches[1][-1][0] == k:
            batches[3].append(batches[1][-1])  # told twice
    batches[4].append((10**6, 0, START + timedelta(seconds=1000), "arrived", 1, None, None, None, None))  # moves the watermark on
    return batches


def feed(spark, folder, batch, k):
    spark.createDataFrame(batch, progress.EVENTS).coalesce(1).write.mode("append").parquet(f"{folder}/in-{k}")


def stream(spark, tmp_path, **options):
    events = spark.readStream.schema(progress.EVENTS).parquet(f"{tmp_path}/in-*")
    query = progress.write_changes(progress.changes(events, **options), f"{tmp_path}/changes", f"{tmp_path}/checkpoint")
    query.awaitTermination(120)
    assert query.exception() is None


def shown(rows):
    return sorted((tuple(r[c] for c in COLUMNS) for r in rows.collect()), key=str)


def test_stream_ends_as_the_batch(spark, tmp_path):
    batches = made()
    for k, batch in enumerate(batches):
        feed(spark, tmp_path, batch, k)
        stream(spark, tmp_path, delay=5.0)
    every = spark.createDataFrame([e for b in batches for e in b], progress.EVENTS)
    want = progress.settled(every, "2025-01-01 10:16:40", delay=5.0)
    got = progress.current(spark, f"{tmp_path}/changes")
    assert shown(got) == shown(want)
    steps = {r.step for r in got.collect()}
    assert {"clean", "retry", "failed", "fetch"} <= steps
    due = {r[ID] for r in progress.pending(spark, f"{tmp_path}/changes", 1).collect()}
    assert due == {r[ID] for r in want.collect() if r.step in ("fetch", "retry") and r.id_execution == 1}
    # a batch that runs again writes the same folder
    number = max(int(p.name.split("=")[1]) for p in (tmp_path / "changes").iterdir())
    before = shown(got)
    again = spark.createDataFrame(spark.read.parquet(f"{tmp_path}/changes/batch={number}").collect(), f"{progress.CHANGES}, markdown_nettoye string")
    again.write.mode("overwrite").parquet(f"{tmp_path}/changes/batch={number}")
    assert shown(progress.current(spark, f"{tmp_path}/changes")) == before


def test_only_changed_rows_are_written(spark, tmp_path):
    arrived = [(k, 0, START, "arrived", 1, None, None, None, None) for k in range(50)]
    feed(spark, tmp_path, arrived, 0)
    stream(spark, tmp_path)
    feed(spark, tmp_path, [(7, 1, START + timedelta(seconds=1), "answered", None, "ok", 200, "", "x")], 1)
    stream(spark, tmp_path)
    sizes = sorted(spark.read.parquet(str(p)).count() for p in (tmp_path / "changes").iterdir())
    assert sum(sizes) == 51 and sizes[-1] == 50
    assert progress.pending(spark, f"{tmp_path}/changes", 1).count() == 49
    assert progress.current(spark, f"{tmp_path}/none").count() == 0
