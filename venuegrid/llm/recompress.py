"""Removal of word runs that repeat across documents, found by recompression.

Each round names runs and pairs of neighbouring symbols: a boundary between symbols x|y goes when x equals y (a
run) or when the round's coin gives x the left and y the right half of the alphabet (a pair). A symbol's name is a
64-bit hash of the words it spells, so names agree across all documents without a dictionary to shuffle. Whether a
boundary survives a round depends on its two neighbours alone; with every boundary we carry the span of words
that its survival has depended on so far. A symbol whose span lies inside a window therefore occurs, at the same
place, in every other copy of that window, whatever surrounds it.

A window stands under the smallest key among the interior symbols of the highest level at which it has any (key:
hash of level and dependence span); a window without any, such as one inside a long run, stands under the hash of
its own words. The choice is a function of the window's words alone, so equal windows always meet. Whole equal
texts (by SHA-256) are the top symbol: only their first document goes on. Keys seen in two documents reveal
candidates, which four polynomial hashes of the whole window, modulo primes and in bases of their own, then verify:
names only have to agree on equal words, but two different windows must not pass for one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from venuegrid.llm.common import Numbers, free_names, keep, mix, text_batches, words_of

#: Rounds of naming; symbols of the last spell about three words and depend on about sixteen.
ROUNDS = 4
#: Distinct words a task remembers before it starts anew.
VOCABULARY = 500_000
FAR = 1 << 60
BASE = np.uint64(0x9E3779B97F4A7C15 | 5)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
#: Primes under 2**31 and bases of the verifying hashes; products of two residues fit a signed 64-bit number.
PRIMES = [2147483647, 2147483629, 2147483587, 2147483579]
BASES = [1103515245, 1812433253, 1664525013, 1597334677]
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


class Powers:
    """Powers of the polynomials' bases and of their inverses, modulo 2**64 and modulo PRIMES, grown as needed."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)
        self.prime = [(np.ones(1, np.int64), np.ones(1, np.int64)) for _ in PRIMES]

    def reach(self, n: int) -> None:
        if n > len(self.up):
            size = max(n, 2 * len(self.up))
            self.up, self.down = (np.multiply.accumulate(np.concatenate(([np.uint64(1)], np.full(size - 1, b, np.uint64)))) for b in (BASE, INVERSE))

    def modulo(self, which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        prime, held = PRIMES[which], self.prime[which]
        if n > len(held[0]):
            bases = BASES[which], pow(BASES[which], -1, prime)
            grown = []
            for x, base in zip(held, bases, strict=True):
                while len(x) < n:
                    x = np.concatenate([x, x * pow(base, len(x), prime) % prime])
                grown.append(x)
            self.prime[which] = held = (grown[0], grown[1])
        return held


class Known:
    """The words a task has met, by number, with 128 bits of hash."""

    def __init__(self) -> None:
        self.numbers, self.hashes = Numbers(), np.zeros((0, 2), np.uint64)

    def learn(self) -> None:
        new = self.numbers.names[len(self.hashes) :]
        if new:
            self.hashes = np.concatenate([self.hashes, np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, new)), np.uint64).reshape(-1, 2)])


class Words:
    """The words of a slice of texts, as hashes in one array, with content hashes of any span."""

    def __init__(self, known: Known, powers: Powers, texts: list[list[bytes]]) -> None:
        numbers = known.numbers
        counts = [len(w) for w in texts]
        self.start = np.concatenate(([0], np.cumsum(counts, dtype=np.int64)))
        ids = np.fromiter((numbers[w] for words in texts for w in words), np.int64, int(self.start[-1]))
        known.learn()
        self.word = known.hashes[ids]
        powers.reach(len(ids) + 1)
        self.powers, self.down = powers, powers.down
        self.sums = np.concatenate(([np.uint64(0)], np.cumsum(self.word[:, 0] * powers.up[: len(ids)], dtype=np.uint64)))

    def span(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """A name for words a..b-1; equal spans at any two places have equal names."""
        return mix((self.sums[b] - self.sums[a]) * self.down[a] + (b - a).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))

    def verify(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Two 62-bit hashes of words a..b-1, each of two residues; different spans have different ones."""
        out = []
        for which, prime in enumerate(PRIMES):
            up, down = self.powers.modulo(which, len(self.word) + 1)
            terms = (self.word[:, which // 2] % np.uint64(prime)).astype(np.int64) * up[: len(self.word)] % prime
            sums = np.concatenate(([0], np.cumsum(terms)))  # under 2**31 terms of 31 bits each
            out.append((sums[b] - sums[a]) % prime * down[a] % prime)
        return out[0] << 31 | out[1], out[2] << 31 | out[3]


def levels(words: Words) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Per round (level, from, to, key) of the symbols whose dependence span [from, to) is inside their document."""
    sizes = np.diff(words.start)
    sizes = sizes[sizes > 0]
    if not len(sizes):
        return
    ends = np.cumsum(sizes)
    n = int(ends[-1])
    # n words and one closing boundary per document; where: word index of a boundary
    doc = np.repeat(np.arange(len(sizes)), sizes + 1)
    where = np.arange(n + len(sizes)) - doc
    edge = np.zeros(len(where), bool)
    edge[ends + np.arange(len(sizes))] = True
    edge[ends - sizes + np.arange(len(sizes))] = True
    low, high = where.copy(), where.copy()
    for level in range(1, ROUNDS + 1):
        name = words.span(where[:-1], np.maximum(where[1:], where[:-1]))
        coin = (mix(name + np.uint64(level)) & np.uint64(1)).astype(bool)
        gone = np.zeros(len(where), bool)
        gone[1:-1] = (name[:-1] == name[1:]) | (~coin[:-1] & coin[1:])
        stay = ~gone | edge
        new_low, new_high = np.full(len(where), -FAR), np.full(len(where), FAR)
        new_low[1:], new_high[:-1] = low[:-1], high[1:]
        new_low[edge], new_high[edge] = -FAR, FAR
        where, edge, low, high = where[stay], edge[stay], new_low[stay], new_high[stay]
        inside = np.flatnonzero((low[:-1] > -FAR) & (high[1:] < FAR) & (where[1:] > where[:-1]))
        a, b = low[inside], high[inside + 1]
        yield level, a, b, mix(words.span(a, b) + np.uint64(level))


def window_keys(words: Words, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, first word, key) of every window of every document in the slice."""
    counts = np.maximum(np.diff(words.start) - window + 1, 0)
    doc = np.repeat(np.arange(len(counts)), counts)
    first = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts) + words.start[:-1][doc]
    key = np.zeros(len(first), np.uint64)
    left = np.arange(len(first))
    for _, a, b, keys in reversed(list(levels(words))):
        if not len(left) or not len(keys):
            continue
        lo, hi = np.searchsorted(a, first[left]), np.searchsorted(b, first[left] + window, "right")
        held = hi > lo
        key[left[held]] = _least(keys, lo[held], hi[held])
        left = left[~held]
    key[left] = words.span(first[left], first[left] + window)
    return doc, first, key


def _least(keys: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """The least key of each range lo..hi-1, from a table of minima over powers of two."""
    out = np.zeros(len(lo), np.uint64)
    size = np.frexp((hi - lo).astype(np.float64))[1] - 1
    row, width = keys, 1
    for k in range(int(size.max(initial=0)) + 1):
        at = np.flatnonzero(size == k)
        out[at] = np.minimum(row[lo[at]], row[hi[at] - width])
        row, width = np.minimum(row[: len(row) - width], row[width:]), 2 * width
    return out


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[list[bytes]], Words]]:
    known, powers = Known(), Powers()
    for batch, texts in text_batches(batches):
        if len(known.numbers) > VOCABULARY:
            known = Known()
        split = [words_of(t) for t in texts]
        yield batch, split, Words(known, powers, split)


def _digests(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, split, words in _slices(batches):
            doc, _, key = window_keys(words, window)
            new = np.ones(len(key), bool)
            new[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])
            doc, key = doc[new], key[new].view(np.int64)
            cuts = np.searchsorted(doc, np.arange(batch.num_rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("uid"), batch.column("doc_id"), pa.array(np.diff(words.start)),
                    pa.array([hashlib.sha256(b" ".join(w)).hexdigest() for w in split]), pa.ListArray.from_arrays(pa.array(cuts), pa.array(key)),
                ],
                names=["uid", "doc_id", "n_words", "sha", "keys"],
            )

    return run


def _windows(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, words in _slices(batches):
            doc, first, key = window_keys(words, window)
            shared = batch.column("shared")
            cuts = np.searchsorted(doc, np.arange(batch.num_rows + 1))
            found = [cuts[i] + np.flatnonzero(np.isin(key[cuts[i] : cuts[i + 1]], shared[i].values.to_numpy().view(np.uint64))) for i in range(batch.num_rows)]
            at = np.concatenate(found)
            d = doc[at]
            for k in range(0, len(at), 1 << 16):
                some, ds = at[k : k + (1 << 16)], d[k : k + (1 << 16)]
                a = first[some]
                h1, h2 = words.verify(a, a + window)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("uid").take(pa.array(ds)), batch.column("doc_id").take(pa.array(ds)), pa.array((a - words.start[ds]).astype(np.int32)),
                        pa.array(h1), pa.array(h2),
                    ],
                    names=["uid", "doc_id", "pos", "h1", "h2"],
                )

    return run


def _kept(window: int, want_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_batches(batches):
            rows = []
            for text, at in zip(texts, batch.column("at"), strict=True):
                words = words_of(text)
                gone = np.zeros(len(words) + 1, np.int64)
                pos = at.values.to_numpy()
                np.add.at(gone, pos, 1)
                np.add.at(gone, pos + window, -1)
                stays = np.cumsum(gone[:-1]) == 0
                joined = b" ".join(w for w, s in zip(words, stays.tolist(), strict=True) if s)
                rows.append((len(words) - int(stays.sum()), hashlib.sha256(joined).hexdigest(), joined.decode() if want_text else None))
            yield pa.RecordBatch.from_arrays(
                [batch.column("uid"), batch.column("doc_id"), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows]), pa.array([r[2] for r in rows], pa.string())],
                names=["uid", "doc_id", "removed", "kept_sha", "kept"],
            )

    return run


#: What names a row: its doc_id, and a hash of its text should several rows have that id.
ROW = ["doc_id", "uid"]


def _find(docs: DataFrame, window: int, want_text: bool) -> tuple[DataFrame, DataFrame]:
    """(all, changed): a row per row of docs with its copy flag; a row per text that lost some words, by ROW."""
    rows = docs.select(F.xxhash64("text").alias("uid"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    digests = keep(rows.mapInArrow(_digests(window), "uid long, doc_id long, n_words long, sha string, keys array<long>"), "digests")
    long = digests.where((F.col("n_words") >= window) & F.col("doc_id").isNotNull())
    # small sides are written first: a join of two plain shuffles can be split where one key is hot
    firsts = keep(long.groupBy("sha").agg(F.min("doc_id").alias("first")), "firsts")
    copy = (F.col("doc_id") > F.col("first")) & (F.col("n_words") >= window)
    seen = digests.join(firsts, "sha", "left").withColumn("copy", F.coalesce(copy, F.lit(False)))
    seen = keep(seen.select(*ROW, "n_words", "sha", "copy", F.when(~F.col("copy") & F.col("doc_id").isNotNull(), F.col("keys")).alias("keys")), "texts")
    keys = seen.select(*ROW, F.explode("keys").alias("key"))
    shared = keep(keys.groupBy("key").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi").select("key"), "shared")
    marked = keys.join(shared, "key").groupBy(*ROW).agg(F.collect_set("key").alias("shared"))
    texts = keep(rows.join(marked, ROW), "candidates")
    windows = keep(texts.mapInArrow(_windows(window), "uid long, doc_id long, pos int, h1 long, h2 long"), "windows")
    lows = keep(windows.groupBy("h1", "h2").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi").select("h1", "h2", "lo"), "lows")
    hits = windows.join(lows, ["h1", "h2"]).where("doc_id > lo").groupBy(*ROW).agg(F.collect_set("pos").alias("at"))
    changed = texts.select(*ROW, "text").join(hits, ROW).mapInArrow(_kept(window, want_text), "uid long, doc_id long, removed long, kept_sha string, kept string")
    return seen.drop("keys"), changed.dropDuplicates(ROW)


def repeats(docs: DataFrame, window: int = 50) -> DataFrame:
    """What removing repeated windows leaves of each row of docs (columns ``doc_id`` and ``text``; others unread).

    A word goes when it lies in a window of ``window`` consecutive words whose sequence also starts in a document
    with a smaller doc_id; windows are judged on the input. Returns doc_id, n_words, n_removed, kept_sha256 (of
    the kept words joined by one space). Null texts count as empty; shorter texts lose nothing. Repeated rows and
    rows that share a doc_id are judged each by its own text; a row without doc_id is neither first nor removed.
    An empty table gives an empty result.
    """
    seen, changed = _find(docs, window, False)
    none = F.col("removed").isNull()
    return seen.join(changed, ROW, "left").select(
        "doc_id",
        "n_words",
        F.when(F.col("copy"), F.col("n_words")).when(none, F.lit(0)).otherwise(F.col("removed")).cast("long").alias("n_removed"),
        F.when(F.col("copy"), F.lit(EMPTY_SHA)).when(none, F.col("sha")).otherwise(F.col("kept_sha")).alias("kept_sha256"),
    )


def remove_repeats(docs: DataFrame, window: int = 50) -> DataFrame:
    """docs with every repeated window taken out of ``text``; all rows and columns stay.

    A text that loses words becomes its kept words joined by one space (empty if none is left); any other text,
    null included, stays as it is. See ``repeats`` for what counts as repeated.
    """
    seen, changed = _find(docs, window, True)
    edits = seen.where("copy").select(*ROW, F.lit("").alias("new")).union(changed.select(*ROW, F.col("kept").alias("new"))).dropDuplicates(ROW)
    id_, uid, new = free_names(docs.columns, "__id", "__uid", "__new")
    edits = edits.select(F.col("doc_id").alias(id_), F.col("uid").alias(uid), F.col("new").alias(new))
    joined = docs.join(edits, (F.col("doc_id").cast("long") == F.col(id_)) & (F.xxhash64("text") == F.col(uid)), "left")
    return joined.withColumn("text", F.coalesce(new, "text")).select(*docs.columns)
