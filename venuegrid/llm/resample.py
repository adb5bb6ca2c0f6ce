"""Importance resampling towards a target: hashed n-gram features, array-scored weights, a draw by merged runs.

A text's features are its runs of one to three words, hashed into buckets. Two passes over the documents suffice: one
counts buckets (each task sends one histogram), one scores every text by an array of the buckets' gains. The draw is
the exact top by weight plus Gumbel noise. Partitions sort their eligible rows into runs, cut at score ranges of a few
thousand rows, and every range's slices are merged by a tournament tree of their own, so no task sees the whole draw:
counts of the ranges tell each merge the rank it begins at and where it stops.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from math import ceil, floor, log
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from venuegrid.llm.common import keep, text_batches

#: Rows of a score range to aim at, and ranges at most: beyond that they hold more rows each.
RANGE, RANGES = 2048, 1024
#: Rows of a run that travel together.
BLOCK = 4096

# ASCII letters in lower case, digits and every byte of other characters stay; what is left parts words
_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
_SCORED = "doc_id long, n_features long, n_words long, weight long, score long"


def features(text: bytes | None, buckets: int) -> tuple[np.ndarray, int]:
    """The buckets of all features of a text, repeats included, and how many words it has."""
    words = text.translate(_WORDS).split() if text else []
    out: list[int] = []
    one = two = 0
    for i, word in enumerate(words):
        # the checksum of a run goes on from that of the run without its last word
        more = b" " + word
        three = crc32(more, two)
        two = crc32(more, one)
        one = crc32(word)
        out.extend((one, two, three)[: i + 1])
    return np.array(out, np.uint32) % np.uint32(buckets), len(words)


def histogram(rows: DataFrame, buckets: int, text_col: str = "text") -> np.ndarray:
    """How many features of all rows fall into each bucket; the driver gets one row a bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(buckets, np.int64)
        for _, texts in text_batches(batches):
            for text in texts:
                seen += np.bincount(features(text, buckets)[0], minlength=buckets)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(seen[at])], names=["bucket", "n"])

    found = rows.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "bucket int, n long")
    out = np.zeros(buckets, np.int64)
    for r in found.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Each bucket's smoothed log ratio of target to source, in thousandths, rounded down."""
    k, s_all, t_all = len(source), int(source.sum()), int(target.sum())
    ratio = lambda s, t: (float(t + 1) * float(s_all + k)) / (float(s + 1) * float(t_all + k))
    return np.array([floor(1000 * log(ratio(int(s), int(t)))) for s, t in zip(source, target, strict=True)], np.int64)


def noise(doc_id: int | None, seed: int) -> int:
    """A document's Gumbel noise in thousandths, from a hash of its id (a null id: of no id)."""
    h = int(sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return floor(-1000 * log(-log((h + 0.5) / 4294967296)))


def scores(docs: DataFrame, gain: np.ndarray, seed: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """n_features, n_words, weight and score of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_batches(batches):
            ids = batch.column("doc_id")
            found = [features(t, len(gain)) for t in texts]
            weight = np.array([gain[b].sum() for b, _ in found], np.int64)
            score = weight + np.array([noise(i, seed) for i in ids.to_pylist()], np.int64)
            sizes = [np.array(c, np.int64) for c in ([len(b) for b, _ in found], [n for _, n in found])]
            yield pa.RecordBatch.from_arrays([ids, *map(pa.array, (*sizes, weight, score))], names=["doc_id", "n_features", "n_words", "weight", "score"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, _SCORED)


# -- the draw -----------------------------------------------------------------------------------------------------


class Tournament:
    """A tree of losers over sorted runs: each pop plays one path of matches, whatever the number of runs."""

    def __init__(self, runs: list[list[tuple]]) -> None:
        self.runs, self.at, k = runs, [0] * len(runs), max(len(runs), 1)
        self.k, self.loser = k, [-1] * k
        winner = [0] * k + list(range(k))
        for node in range(k - 1, 0, -1):
            a, b = winner[2 * node], winner[2 * node + 1]
            winner[node], self.loser[node] = (a, b) if self._before(a, b) else (b, a)
        self.first = winner[1] if k > 1 else 0

    def _before(self, a: int, b: int) -> bool:
        if self.at[a] >= len(self.runs[a]):
            return False
        return self.at[b] >= len(self.runs[b]) or self.runs[a][self.at[a]] <= self.runs[b][self.at[b]]

    def __iter__(self) -> Iterator[tuple]:
        while self.runs and self.at[self.first] < len(self.runs[self.first]):
            w = self.first
            yield self.runs[w][self.at[w]]
            self.at[w] += 1
            node = (w + self.k) // 2
            while node:
                if self._before(self.loser[node], w):
                    w, self.loser[node] = self.loser[node], w
                node //= 2
            self.first = w


def _range_of(score: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Range 0 holds the greatest scores; cuts ascend, and a score at a cut lies above it."""
    return len(cuts) - np.searchsorted(cuts, score, side="right")


def _counts(cuts: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(len(cuts) + 1, np.int64)
        for batch in batches:
            seen += np.bincount(_range_of(batch.column("score").to_numpy(), cuts), minlength=len(seen))
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(seen[at])], names=["range", "n"])

    return run


_VALUES = ["doc_id", "n_features", "weight", "score"]
_SLICES = "range int, run int, place int, " + ", ".join(f"{c} array<long>" for c in _VALUES)


def _slices(cuts: np.ndarray):
    """Sorted rows of one partition come in; yields its run in slices, none of them in two ranges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = 0
        for batch in batches:
            at = _range_of(batch.column("score").to_numpy(), cuts)
            for a in range(0, batch.num_rows, BLOCK):
                part, of = batch.slice(a, BLOCK), at[a : a + BLOCK]
                begins = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1])))
                offsets = pa.array(np.append(begins, len(of)).astype(np.int32))
                lists = [pa.ListArray.from_arrays(offsets, part.column(c)) for c in _VALUES]
                places = pa.array(np.arange(place, place + len(begins), dtype=np.int32))
                place += len(begins)
                yield pa.RecordBatch.from_arrays([pa.array(of[begins].astype(np.int32)), part.column("run").take(pa.array(begins)), places, *lists], names=["range", "run", "place", *_VALUES])

    return run


def _merged(begins: dict[int, int], draw: int):
    """Slices come by range, run and place; yields each range's rows, those within the draw with their ranks."""

    def out(at: int, slices: list[tuple]) -> pa.RecordBatch:
        runs: dict[int, list[tuple]] = {}
        for run, *columns in slices:
            runs.setdefault(run, []).extend((-s, i is None, i or 0, n, w) for i, n, w, s in zip(*columns, strict=True))
        merged, left = Tournament(list(runs.values())), draw - begins[at]
        rows = [(None if none else i, n, w, -s, begins[at] + k + 1 if k < left else None) for k, (s, none, i, n, w) in enumerate(merged)]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=[*_VALUES, "rank"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = -1, []
        for batch in batches:
            for at, *slice_ in zip(*(batch.column(c).to_pylist() for c in ("range", "run", *_VALUES)), strict=True):
                if at != now and held:
                    yield out(now, held)
                    held = []
                now = at
                held.append(slice_)
        if held:
            yield out(now, held)

    return run


def draw(scored: DataFrame, least_words: int, share: tuple[int, int]) -> DataFrame:
    """scored (written rows) with ``rank``: 1, 2, 3... for the floor(share) of the eligible rows with the greatest scores.

    Ties go to the smaller doc_id (null ids last), then to fewer features and the smaller weight.
    """
    eligible = scored.where(F.col("n_words") >= least_words)
    n = eligible.count()
    most = share[0] * n // share[1]
    none = F.lit(None).cast("long").alias("rank")
    if not most:
        return scored.select(*_VALUES, none)
    ranges = min(RANGES, ceil(most / RANGE))
    at = [max(0.0, 1 - most / n * i / ranges) for i in range(1, ranges + 2)]
    cuts = np.unique(np.array(eligible.agg(F.percentile_approx("score", at, 100 * ranges)).first()[0], np.int64))
    sizes = {r["range"]: r.n for r in eligible.select("score").mapInArrow(_counts(cuts), "range int, n long").groupBy("range").agg(F.sum("n").alias("n")).collect()}
    begins, so_far = {}, 0
    for r in sorted(sizes):
        if so_far < most:
            begins[r] = so_far
        so_far += sizes[r]
    last = max(begins)
    live = F.col("n_words") >= least_words if last == len(cuts) else (F.col("n_words") >= least_words) & (F.col("score") >= int(cuts[len(cuts) - 1 - last]))
    sorted_ = scored.where(live).select(F.spark_partition_id().alias("run"), *_VALUES).sortWithinPartitions(F.desc("score"), F.asc_nulls_last("doc_id"), "n_features", "weight")
    dealt = sorted_.mapInArrow(_slices(cuts), _SLICES).repartition(len(begins), "range").sortWithinPartitions("range", "run", "place")
    drawn = dealt.mapInArrow(_merged(begins, most), ", ".join(f"{c} long" for c in [*_VALUES, "rank"]))
    return scored.where(~live).select(*_VALUES, none).unionByName(drawn)


def resample(
    docs: DataFrame, target: DataFrame, buckets: int = 10_000, least_words: int = 20, share: tuple[int, int] = (5, 100), seed: int = 42, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id``, ``n_features``, ``weight``, ``score`` and ``rank`` (null where not drawn) of every row of docs.

    Words are runs of ASCII letters, in lower case, digits and non-ASCII characters. Null and wordless texts have no
    features, weight 0 and are never drawn while ``least_words`` is over 0; texts of any length are read whole. Rows
    with equal ids, or equal in all, are separate rows and can all be drawn; a null id is scored as an empty one and
    loses ties. An empty target gives every bucket the target's smoothing alone. An empty docs gives an empty result.
    Other columns are not read.
    """
    source, wanted = histogram(docs, buckets, text_col), histogram(target, buckets, text_col)
    return draw(keep(scores(docs, gains(source, wanted), seed, id_col, text_col), "scored"), least_words, share)
