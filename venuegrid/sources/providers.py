"""Side effects behind functions from Arrow-sized frames to frames, with deterministic offline versions."""

from __future__ import annotations

import hashlib
import heapq
import socket
import time
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from venuegrid.sources.markup import layout

@pandas_udf(T.StringType())
def html_to_text(html: pd.Series) -> pd.Series:
    """Visible text of pages, laid out (see ``markup``); empty for null or empty markup."""
    return html.map(layout, na_action=None)


def checked_url(url: Column) -> Column:
    """Why a url cannot be fetched, or null."""
    return F.when(F.coalesce(F.trim(url), F.lit("")) == "", "URL non fournie").when(~url.rlike("^https?://"), "Format d'URL invalide")


Fetch = Callable[[str], tuple[str, int, str, str]]
#: Tries for one page, and seconds between two.
TRIES, DELAY = 3, 5.0
#: Tasks that ask one host at a time, and rows of a task that wait for their next try at most.
PER_HOST, WAITING = 4, 10_000
_ANSWER = ("statut_url", "code_http", "message_url", "html")


class Clock:
    """What a queue of tries needs of time; tests bring their own."""

    now = staticmethod(time.monotonic)
    sleep = staticmethod(time.sleep)


def failed(error: Exception) -> tuple[str, int, str, str]:
    """What a page's last error leaves: a host without an address is ``erreur``, a time-out ``warning``, any other ``critical``."""
    if isinstance(error, socket.gaierror) or "ERR_NAME_NOT_RESOLVED" in str(error):
        return "erreur", 0, "Domaine non résolu (DNS)", ""
    return ("warning" if isinstance(error, TimeoutError) else "critical"), 0, str(error), ""


class Queue:
    """Tries of one task's pages, by the time they are due: a page that waits for its next try holds up no other.

    A provider that raises is asked again ``delay`` seconds later, ``tries`` times in all, and never ends the task. An
    ``ok`` with another code than 200 becomes ``warning``. At most WAITING pages wait at once; then the first of them
    is waited for.
    """

    def __init__(self, provider: Fetch, tries: int = TRIES, delay: float = DELAY, clock: type[Clock] = Clock) -> None:
        self.provider, self.tries, self.delay, self.clock = provider, tries, delay, clock
        self.due: list[tuple[float, int, int, str, object]] = []  # when, place, tries so far, url, row
        self.place = 0

    def _ask(self, url: str, row: object, before: int) -> Iterator[tuple[object, tuple]]:
        try:
            status, code, message, html = self.provider(url)
            yield row, (("warning" if status == "ok" and code != 200 else status), code, message, html)
        except Exception as e:  # whatever a provider raises is this page's outcome
            if before + 1 >= self.tries:
                yield row, failed(e)
            else:
                self.place += 1
                heapq.heappush(self.due, (self.clock.now() + self.delay, self.place, before + 1, url, row))

    def _again(self, wait: bool) -> Iterator[tuple[object, tuple]]:
        """The waiting pages that are due; with ``wait`` until the first one is."""
        if wait and self.due:
            self.clock.sleep(max(0.0, self.due[0][0] - self.clock.now()))
        while self.due and self.due[0][0] <= self.clock.now():
            _, _, before, url, row = heapq.heappop(self.due)
            yield from self._ask(url, row, before)

    def ask(self, url: str, row: object) -> Iterator[tuple[object, tuple]]:
        """Rows that are done, with their answers, after asking for one more page."""
        yield from self._ask(url, row, 0)
        yield from self._again(wait=len(self.due) > WAITING)

    def rest(self) -> Iterator[tuple[object, tuple]]:
        while self.due:
            yield from self._again(wait=True)


def answer(provider: Fetch, url: str, tries: int = TRIES, delay: float = DELAY) -> tuple[str, int, str, str]:
    """Status, code, message and html of one page (see ``Queue``)."""
    queue = Queue(provider, tries, delay)
    return [found for _, found in (*queue.ask(url, None), *queue.rest())][0]


def fetch(rows: DataFrame, provider: Fetch, url: str = "url", tries: int = TRIES, delay: float = DELAY, per_host: int = PER_HOST, clock: type[Clock] = Clock) -> DataFrame:
    """rows with statut_url, code_http, message_url and html; urls that fail the guards never reach the provider.

    Rows are dealt by host, each to ``per_host`` tasks at most, so a host is never asked by more of them at a time, and
    one that many rows name is not left to a single task.
    """
    bad = checked_url(F.col(url))
    host = F.lower(F.regexp_extract(F.col(url), "^[^:]+://([^/?#]*)", 1))
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue = Queue(provider, tries, delay, clock)
        for batch in batches:
            done: list[tuple[pa.RecordBatch, tuple]] = []
            for i, (u, why) in enumerate(zip(batch.column("__url").to_pylist(), batch.column("__bad").to_pylist(), strict=True)):
                row = batch.take(pa.array([i]))  # a copy, so that a waiting row holds no batch
                done += [(row, ("erreur", 0, why, ""))] if why else queue.ask(u, row)
            yield from shown(done)
        yield from shown(list(queue.rest()))

    def shown(done: list[tuple[pa.RecordBatch, tuple]]) -> Iterator[pa.RecordBatch]:
        if done:
            whole = pa.Table.from_batches([row.select(names) for row, _ in done]).combine_chunks()
            for name, values, kind in zip(_ANSWER, zip(*(got for _, got in done), strict=True), (pa.string(), pa.int32(), pa.string(), pa.string()), strict=True):
                whole = whole.append_column(name, pa.array(values, kind))
            yield from whole.to_batches()

    kinds = ", ".join([*(f"`{n}` {t}" for n, t in rows.dtypes), "statut_url string, code_http int, message_url string, html string"])
    marked = rows.withColumns({"__url": F.col(url).cast("string"), "__bad": F.coalesce(bad, F.lit(""))})
    return marked.repartition(host, F.pmod(F.xxhash64(url), F.lit(per_host))).mapInArrow(run, kinds)


@pandas_udf(T.ArrayType(T.FloatType()))
def hash_embedding(text: pd.Series) -> pd.Series:
    """A deterministic offline embedding: signed counts of hashed words in 64 dimensions, at unit length."""
    words = text.fillna("").str.lower().str.split()
    at = np.repeat(np.arange(len(words)), words.str.len())
    found, which = np.unique(np.array([w for ws in words for w in ws], object).astype(str), return_inverse=True) if len(at) else (np.zeros(0, str), np.zeros(0, int))
    hashes = np.array([int.from_bytes(hashlib.blake2b(w.encode(), digest_size=8).digest(), "big") for w in found], np.uint64)
    counts = np.zeros((len(words), 64))
    np.add.at(counts, (at, (hashes % np.uint64(64)).astype(int)[which]), np.where(hashes >> np.uint64(63), 1.0, -1.0)[which])
    norm = np.linalg.norm(counts, axis=1, keepdims=True)
    return pd.Series(list(np.divide(counts, norm, out=counts, where=norm > 0)), index=text.index)
