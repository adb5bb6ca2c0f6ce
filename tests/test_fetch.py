"""Fetching: the queue of tries by an injected clock, and how rows are dealt."""

import socket
from collections import Counter

import pytest
from pyspark.sql import functions as F

from venuegrid.sources import providers


class FakeClock:
    """A clock that only moves when it is slept on, or by what a request takes."""

    def __init__(self, request=0.0):
        self.time, self.slept, self.request = 0.0, 0.0, request

    def now(self):
        return self.time

    def sleep(self, seconds):
        self.time += seconds
        self.slept += seconds


def flaky(clock, bad, error=RuntimeError):
    calls = Counter()

    def provider(url):
        clock.time += clock.request
        calls[url] += 1
        if bad(url, calls[url]):
            raise error(f"try {calls[url]} of {url}")
        return "ok", 200, "", f"<p>{url}</p>"

    return provider, calls


def run(queue, n):
    done = []
    for k in range(n):
        done += queue.ask(f"u{k}", k)
    return done + list(queue.rest())


def test_a_wait_stops_no_other_row():
    """Of 1,000 pages one in ten fails for good: all their waits together are those of one page."""
    clock = FakeClock()
    provider, calls = flaky(clock, lambda url, _: url.endswith("7"))
    done = run(providers.Queue(provider, 3, 5.0, clock), 1000)
    assert sorted(row for row, _ in done) == list(range(1000))
    assert clock.slept == pytest.approx(10.0)
    assert Counter(calls.values()) == {1: 900, 3: 100}
    by = dict(done)
    assert by[3] == ("ok", 200, "", "<p>u3</p>") and by[17] == ("critical", 0, "try 3 of u17", "")
    assert [row for row, _ in done[:900]] == [k for k in range(1000) if k % 10 != 7]


def test_requests_fill_the_waits():
    """Where requests take time, a page that failed is asked again between others, and nobody sleeps."""
    clock = FakeClock(request=0.1)
    provider, calls = flaky(clock, lambda url, turn: url == "u0" and turn < 3)
    done = run(providers.Queue(provider, 3, 5.0, clock), 200)
    assert clock.slept == 0 and calls["u0"] == 3 and dict(done)[0][0] == "ok"
    assert 50 < [row for row, _ in done].index(0) < 150


def test_waiting_pages_are_bounded(monkeypatch):
    monkeypatch.setattr(providers, "WAITING", 10)
    clock = FakeClock()
    provider, _ = flaky(clock, lambda url, _: True, TimeoutError)
    queue, most, done = providers.Queue(provider, 2, 5.0, clock), 0, []
    for k in range(100):
        done += queue.ask(f"u{k}", k)
        most = max(most, len(queue.due))
    done += list(queue.rest())
    assert most <= 11 and len(done) == 100 and {a[0] for _, a in done} == {"warning"}


def test_errors(monkeypatch):
    clock = FakeClock()
    ask = lambda error: dict(run(providers.Queue(flaky(clock, lambda *_: True, error)[0], 1, 5.0, clock), 1))[0]
    assert ask(socket.gaierror)[:3] == ("erreur", 0, "Domaine non résolu (DNS)")
    assert ask(TimeoutError)[0] == "warning" and ask(ValueError)[0] == "critical"
    moved = providers.Queue(lambda url: ("ok", 301, "", ""), clock=clock)
    assert run(moved, 1) == [(0, ("warning", 301, "", ""))]


def test_rows_are_dealt_by_host(spark):
    """Every row comes back once with its own columns; one host's rows meet in a bounded number of tasks."""
    rows = spark.range(400).select("id", F.when(F.col("id") < 300, F.concat(F.lit("https://Hot.example/"), F.col("id").cast("string"))).otherwise(F.concat(F.lit("http://h"), F.col("id").cast("string"))).alias("url"), F.lit("kept").alias("html0"))
    got = providers.fetch(rows, lambda u: ("ok", 200, "", u), per_host=3).withColumn("task", F.spark_partition_id())
    found = got.collect()
    assert sorted(r.id for r in found) == list(range(400)) and all(r.html == r.url and r.html0 == "kept" for r in found)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_COL" in plan
    assert len({r.task for r in found if r.id < 300}) <= 3
    assert providers.fetch(rows.limit(0), lambda u: ("ok", 200, "", u)).count() == 0
