"""Exact n-gram Jaccard join: a blocked sparse product of the incidence matrix of texts by n-grams.

Rows of the matrix are shingle sets, columns are shingles. Two sets whose similarity reaches ``num / den`` differ in at
most H = (|a| + |b|) * (den - num) / (den + num) shingles, and neither is larger than den / num times the other. So
sizes are cut into levels, and within a level the columns into H + 1 + SPARE blocks: sets that link agree on at least
1 + SPARE whole blocks. A set is filed under each of its blocks' contents; equal entries make sets candidates, and
what a path of candidates joins is multiplied out, tile by tile of rows and slab by slab of columns. Overlap counts
add up over the slabs; a pair is discarded as soon as its count and what is left of the smaller set cannot reach the
bound that the two sizes demand, and a tile with no pair left stops.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from venuegrid.llm.common import keep, mix, slices, text_batches
from venuegrid.llm.components import classes
from venuegrid.llm.copies import chunked, shingles, verified

#: Agreeing blocks more than the one that must agree; up to so many of a set's blocks may be empty and are not filed.
SPARE = 1
#: A level's greatest size over its least. Broader levels file fewer sets twice, but all of them under more blocks.
BROAD = 1.4
#: Rows of a tile, and columns of a slab.
TILE, SLAB = 64, 4096


class Levels:
    """Size levels of a similarity num / den.

    Level i holds the sizes from its cut to the next; cuts are some BROAD apart. Whatever links with a set of level i and
    is not smaller lies in level i too, or above it by less than den / num: such sizes are filed under both levels.
    """

    def __init__(self, num: int, den: int) -> None:
        self.num, self.den, self.cuts = num, den, [1]

    def _reach(self, size: int) -> int:
        """The greatest size that links with ``size``."""
        return size * self.den // self.num

    def _grow(self, n: int) -> None:
        while len(self.cuts) <= n:
            self.cuts.append(max(self._reach(self.cuts[-1]) + 1, int(self.cuts[-1] * BROAD)))

    def of(self, size: int) -> list[int]:
        """The levels that a set is filed under."""
        while self.cuts[-1] <= size:
            self._grow(len(self.cuts))
        top = int(np.searchsorted(self.cuts, size, side="right")) - 1
        return [top, top - 1] if top and size <= self._reach(self.cuts[top] - 1) else [top]

    def blocks(self, level: int) -> int:
        """Into how many blocks a level's columns are cut; 0 where only equal sets can link."""
        self._grow(level + 1)
        most = self.cuts[level + 1] - 1
        differ = (most + self._reach(most)) * (self.den - self.num) // (self.den + self.num)
        return differ + 1 + SPARE if differ else 0


def entries(hashes: np.ndarray, levels: Levels) -> np.ndarray:
    """What a set (sorted hashes) is filed under: the contents of its column blocks in each of its levels.

    Blocks are equal ranges of the hash, so a block's content is a run of the sorted set and its sum a difference of
    two running sums. Empty blocks are filed only where a set has more than SPARE of them: sets that agree on no other
    block have that many both.
    """
    if not len(hashes):
        return np.zeros(0, np.uint64)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(hashes + np.uint64(0x9E3779B97F4A7C15)), dtype=np.uint64)))
    out = []
    for level in levels.of(len(hashes)):
        n = levels.blocks(level)
        if n:
            edges = np.array([(i << 64) // n for i in range(1, n)], np.uint64)
            cut = np.concatenate(([0], np.searchsorted(hashes, edges), [len(hashes)]))
            empty = cut[1:] == cut[:-1]
            at = np.arange(n, dtype=np.uint64) + np.uint64(level << 32)
            filed = mix((sums[cut[1:]] - sums[cut[:-1]]) ^ mix(at + np.uint64(1)))
            out.append(filed if empty.sum() > SPARE else filed[~empty])
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _signed(docs: DataFrame, shingle: int, num: int, den: int) -> DataFrame:
    """(doc_id, h, same, n, filed) for every row; equal shingle sets have equal ``same``, h is a hash of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = Levels(num, den)
        for batch, texts in text_batches(batches):
            sets = [shingles(t, shingle) for t in texts]
            filed = [entries(s, levels) for s in sets]
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, filed)]).astype(np.int32)), pa.array(np.concatenate(filed).view(np.int64)))
            same = pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("h"), same, pa.array([len(s) for s in sets], pa.int64()), lists], names=["doc_id", "h", "same", "n", "filed"])

    return docs.mapInArrow(run, "doc_id long, h long, same binary, n long, filed array<long>")


# -- candidates -----------------------------------------------------------------------------------------------


def _pairs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distinct pairs of different ends, a row each."""
    return np.unique(np.stack([a, b], axis=1)[a != b], axis=0)


def _filed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(entry, a, b): of the sets of a batch under one entry the first, with b = -1, and an edge from each other one to it.

    However many sets share an entry, a slice of a batch sends on one row of it. Edges go along under a number of their own.
    """
    for batch in batches:
        sizes = batch.column("filed").value_lengths().to_numpy()
        for start, stop in slices((8 * sizes).tolist(), batch.num_rows):  # long texts have many entries
            key = np.repeat(batch.column("key").to_numpy()[start:stop], sizes[start:stop])
            entry = batch.column("filed").slice(start, stop - start).flatten().to_numpy()
            order = np.lexsort((key, entry))
            entry, key = entry[order], key[order]
            new = np.concatenate(([True], entry[1:] != entry[:-1]))
            edges = _pairs(key, key[new][np.cumsum(new) - 1])
            columns = [np.concatenate([entry[new], mix(edges[:, 0].view(np.uint64)).view(np.int64)]), np.concatenate([key[new], edges[:, 0]]), np.concatenate([np.full(int(new.sum()), -1), edges[:, 1]])]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["entry", "a", "b"])


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by entry; yields an edge from each set to the first one under its entry, and the edges that came along."""
    held = np.zeros((0, 2), np.int64)  # entry and first set of the run that may go on
    for batch in batches:
        entry, a, b = (batch.column(c).to_numpy() for c in ("entry", "a", "b"))
        known, own = b >= 0, b < 0
        entry, keys = np.concatenate([held[:, 0], entry[own]]), np.concatenate([held[:, 1], a[own]])
        new = np.concatenate(([True], entry[1:] != entry[:-1])) if len(entry) else np.zeros(0, bool)
        first = keys[new][np.cumsum(new) - 1] if len(entry) else keys
        edges = np.concatenate([_pairs(keys, first), np.stack([a[known], b[known]], axis=1)])
        if len(entry):
            held = np.array([[entry[-1], first[-1]]], np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(edges[:, k])) for k in (0, 1)], names=["a", "b"])


# -- the product -----------------------------------------------------------------------------------------------


def product(sets: list[np.ndarray], num: int, den: int) -> np.ndarray:
    """Which two of the sorted sets have a Jaccard similarity of at least num / den."""
    size = np.array([len(s) for s in sets], np.int64)
    linked = np.zeros((len(sets), len(sets)), bool)
    order = np.argsort(size, kind="stable")
    columns, member = np.unique(np.concatenate(sets) if sets else np.zeros(0, np.uint64), return_inverse=True)
    places = np.split(member, np.cumsum(size)[:-1])
    tiles = [order[a : a + TILE] for a in range(0, len(order), TILE)]
    for t, one in enumerate(tiles):
        for two in tiles[t:]:
            if den * size[one[-1]] < num * size[two[0]]:
                break  # every set of this tile and of those after it is too large
            hits = _tile([places[i] for i in one], [places[i] for i in two], len(columns), num, den)
            linked[np.ix_(one, two)] |= hits
            linked[np.ix_(two, one)] |= hits.T
    return linked


def _tile(one: list[np.ndarray], two: list[np.ndarray], columns: int, num: int, den: int) -> np.ndarray:
    """Overlaps of two tiles' rows (sorted column numbers), slab by slab; True where they reach the bound."""
    a, b = (np.array([len(s) for s in side], np.int64) for side in (one, two))
    need = -(-num * (a[:, None] + b[None, :]) // (num + den))  # of i >= num / den * (|a| + |b| - i), rounded up
    need = np.maximum(need, 1)
    count = np.zeros(need.shape, np.int64)
    for low in range(0, columns, SLAB):
        x, y = (_slab(side, low) for side in (one, two))
        count += (x @ y.T).astype(np.int64)
        done = [np.array([np.searchsorted(s, low + SLAB) for s in side]) for side in (one, two)]
        if not (count + np.minimum((a - done[0])[:, None], (b - done[1])[None, :]) >= need).any():
            return np.zeros(need.shape, bool)
    return count >= need


def _slab(rows: list[np.ndarray], low: int) -> np.ndarray:
    out = np.zeros((len(rows), SLAB), np.float32)
    for i, s in enumerate(rows):
        a, b = np.searchsorted(s, (low, low + SLAB))
        out[i, s[a:b] - low] = 1
    return out


def _hashed(shingle: int):
    names = ["root", "key", "chunks", "i"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_batches(batches):
            sets = pa.array([shingles(t, shingle).tobytes() for t in texts], pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), sets], names=[*names, "hashes"])

    return run


def join(docs: DataFrame, shingle: int = 3, num: int = 90, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` (the smallest doc_id reachable by links) of every row of docs.

    Rows link when den * |intersection| >= num * |union| of their shingle sets. Null and wordless texts have no
    shingles and link with nothing, so each is its own component; a text of fewer words than ``shingle`` has one.
    Repeated rows and rows of one id are rows of their own. A row without an id takes the component of its set, null
    if nobody there has an id. Texts of any length are read whole, other columns not at all. An empty table gives an
    empty result.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col).cast("string")).alias("h"), F.col(text_col).cast("string").alias("text"))
    signed = keep(_signed(texts, shingle, num, den).withColumn("key", F.monotonically_increasing_id()), "signed")
    filed = signed.where(F.size("filed") > 0).select("key", "filed").mapInArrow(_filed, "entry long, a long, b long")
    clusters = classes(filed.repartition("entry").sortWithinPartitions("entry").mapInArrow(_stars, "a long, b long")).withColumnRenamed("node", "key")
    # equal sets of a cluster are one from here on; a cluster of one set needs no comparison
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h")
    sets = clusters.join(signed.select("key", "same", "n", "doc_id", "h"), "key").groupBy("root", "same").agg(F.min(rank).alias("rep"), F.first("n").alias("n"))
    sets = keep(sets.select("root", "same", "n", "rep.doc_id", "rep.h", F.monotonically_increasing_id().alias("key")), "sets")
    dealt = keep(chunked(sets, 8 * F.col("n")).select("root", "same", "key", "chunks", "i", F.col("doc_id").alias("id"), F.col("h").alias("of")), "dealt")
    # members grow with the corpus, so they are never broadcast
    members = texts.join(dealt.drop("same").hint("merge"), F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("h") == F.col("of"))).select("root", "key", "chunks", "i", "text").dropDuplicates(["key"])
    hashes = keep(members.mapInArrow(_hashed(shingle), "root long, key long, chunks int, i int, hashes binary"), "hashes")
    roots = classes(verified(hashes, lambda s: product(s, num, den), dealt=True)).withColumnRenamed("node", "key")
    linked = keep(dealt.select("same", "key").join(roots, "key").select("same", "root"), "linked")
    least = keep(signed.where("n > 0").groupBy("same").agg(F.min("doc_id").alias("least")), "least")
    joined = least.join(linked, "same")
    components = keep(joined.groupBy("root").agg(F.min("least").alias("component_id")), "components")
    alone = least.join(linked, "same", "left_anti").select("same", F.col("least").alias("component_id"))
    known = keep(joined.join(components, "root").select("same", "component_id").unionByName(alone), "known")
    found = signed.where("n > 0").join(known, "same").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return found.unionByName(signed.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))
