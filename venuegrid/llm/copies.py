"""Verified near copies: SimHash candidates, whose shingle sets are then compared exactly.

Every distinct shingle set has SEEDS independent fingerprints. Sets within the radius by one of them (found by the
generalised pigeonhole of ``simhash.links``) and not too far apart by the two next ones are candidates. Candidates
that a path joins are a cluster; its sets are compared exactly, TEXTS at a time, by a product of their membership
matrices, and only links of a Jaccard similarity of ``alike`` or more join texts.

A cluster of more texts than that is not compared in all its pairs. Its chunks are joined within first, then one
text of each group found, until no more groups join; what is left is to compare the texts outside the cluster's
largest group with all others. For a cluster of true copies that is next to nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venuegrid.llm.common import free_names, keep, mix, text_batches, words_of
from venuegrid.llm.components import classes
from venuegrid.llm.simhash import SEED, links

#: Independent fingerprints. Two sets of a Jaccard of 0.8 lie within 8 bits by one of 8 with probability 0.97.
SEEDS = 8
#: Most differing bits, of 128, of the next two fingerprints: sets of a Jaccard of 0.8 differ in 19 with a deviation of 4, unlike ones in 64.
FAR = 42
#: Texts compared together, and bytes of their shingle sets; larger clusters are cut into chunks.
TEXTS, BYTES = 256, 16 << 20
#: Leaders are compared again while one in so many has joined another.
LEFT = 10
#: Shingles whose membership matrix is held at once.
SLAB = 8192

Near = Callable[[list[np.ndarray]], np.ndarray]


def shingles(text: bytes | None, shingle: int) -> np.ndarray:
    """The distinct XXH64 hashes of a text's shingles, sorted; a text of fewer words is one shingle, no words none."""
    words = words_of(text.lower()) if text else []
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= shingle:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[: -shingle])).tolist()
    stops = (ends[shingle - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, stops, strict=True)), np.uint64, len(starts)))


def seeded(hashes: np.ndarray) -> np.ndarray:
    """SEEDS independent fingerprints of a shingle set: majorities of the hashes mixed with each seed."""
    ones = np.zeros((SEEDS, 8, 8), np.int64)
    salts = mix(np.arange(1, SEEDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))[:, None]
    for at in range(0, len(hashes), 255 << 6):
        part = hashes[None, at : at + (255 << 6)]
        x = mix(part ^ salts)
        if x.shape[1] > 255:
            x = np.pad(x, ((0, 0), (0, -x.shape[1] % 255)))
        x = x.reshape(SEEDS, -1, min(255, x.shape[1]))
        for k in range(8):  # eight counters of a byte each, which 255 rows cannot overflow
            sums = ((x >> np.uint64(k)) & np.uint64(0x0101010101010101)).sum(axis=2, dtype=np.uint64)
            ones[:, :, k] += sums.view(np.uint8).reshape(SEEDS, -1, 8).sum(axis=1, dtype=np.int64)
    return np.packbits(2 * ones > len(hashes), axis=2, bitorder="little").reshape(SEEDS, 8).view(np.uint64)[:, 0]


def _signed(docs: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, h, same, fps) for every row; equal shingle sets have equal ``same``, h is a hash of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_batches(batches):
            sets = [shingles(t, shingle) for t in texts]
            same = pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary())
            fps = pa.array(np.concatenate([seeded(s) for s in sets]).view(np.int64))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1, dtype=np.int32) * SEEDS), fps)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("h"), same, lists], names=["doc_id", "h", "same", "fps"])

    return _texts(docs).mapInArrow(run, "doc_id long, h long, same binary, fps array<long>")


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("h"), F.col("text").cast("string").alias("text"))


def _shingled(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_batches(batches):
            sets = pa.array([shingles(t, shingle).tobytes() for t in texts], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("root"), batch.column("key"), sets], names=["root", "key", "hashes"])

    return run


# -- exact comparison ---------------------------------------------------------------------------------------------


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """How many members each two of the sorted sets share."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, member, count = np.unique(np.concatenate(sets) if sets else np.zeros(0, np.uint64), return_inverse=True, return_counts=True)
    common = count[member] > 1
    place = np.cumsum(count > 1) - 1
    owner, member = owner[common], place[member[common]]
    order = np.argsort(member, kind="stable")
    owner, member = owner[order], member[order]
    out = np.zeros((len(sets), len(sets)), np.float64)
    for base in range(0, int(member.max(initial=-1)) + 1, SLAB):
        a, b = np.searchsorted(member, (base, base + SLAB))
        x = np.zeros((len(sets), SLAB), np.float32)
        x[owner[a:b], member[a:b] - base] = 1
        out += x @ x.T
    return out


def _alike(sets: list[np.ndarray], alike: float) -> np.ndarray:
    """Which two sets have a Jaccard similarity of at least ``alike``; two empty ones do not meet here."""
    both, size = overlaps(sets), np.array([len(s) for s in sets], float)
    return (both > 0) & (both >= alike * (size[:, None] + size[None, :] - both) - 1e-9)


def _groups(linked: np.ndarray) -> np.ndarray:
    """The least index of each row's component in a symmetric matrix of links."""
    label = np.arange(len(linked))
    masked = linked | np.eye(len(linked), dtype=bool)
    while True:
        new = np.where(masked, label[None, :], len(label)).min(axis=1)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def _exact(near: Near):
    """Runs of equal (root, i, j) come sorted; yields an edge from each text to the first of its component in the run.

    Texts of different ``side`` are compared, or all where every side is null.
    """

    def out(held: list[tuple]) -> pa.RecordBatch:
        keys = np.array([k for k, _, _ in held], np.int64)
        linked = near([np.frombuffer(h, np.uint64) for _, _, h in held])
        if held[0][1] is not None:
            side = np.array([s for _, s, _ in held])
            linked &= side[:, None] != side[None, :]
        first = _groups(linked)
        new = first != np.arange(len(held))
        return pa.RecordBatch.from_arrays([pa.array(keys[new]), pa.array(keys[first[new]])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: tuple | None = None
        held: list[tuple] = []
        for batch in batches:
            for *at, key, side, hashes in zip(*(batch.column(c).to_pylist() for c in ("root", "i", "j", "key", "side", "hashes")), strict=True):
                if at != now:
                    if held:
                        yield out(held)
                    now, held = at, []
                held.append((key, side, hashes))
        if held:
            yield out(held)

    return run


def _compare(dealt: DataFrame, near: Near) -> DataFrame:
    """Edges of runs of dealt (root, i, j, key, side, hashes)."""
    runs = dealt.select("root", "i", "j", "key", "side", "hashes").repartition("root", "i", "j").sortWithinPartitions("root", "i", "j")
    return runs.mapInArrow(_exact(near), "a long, b long")


def _in_chunks(members: DataFrame, salt: int) -> DataFrame:
    """members with ``chunks``, how many their cluster needs, and ``i``, the one a text is dealt to; single texts go."""
    return chunked(members, F.length("hashes"), salt)


def chunked(members: DataFrame, size: Column, salt: int = 0) -> DataFrame:
    """As ``_in_chunks``, of rows (root, key) whose sets have ``size`` bytes."""
    sizes = members.groupBy("root").agg(F.count("*").alias("n"), F.sum(size).alias("bytes")).where("n > 1")
    chunks = F.greatest(F.ceil(F.col("n") / TEXTS), F.ceil(F.col("bytes") / BYTES)).cast("int")
    dealt = members.join(sizes.select("root", chunks.alias("chunks")), "root")
    return dealt.withColumn("i", F.pmod(F.xxhash64("key", F.lit(salt)), F.col("chunks")).cast("int"))


def _every(n: str | Column) -> Column:
    return F.explode(F.sequence(F.lit(0), F.col(n) - 1 if isinstance(n, str) else n - 1))


def verified(clusters: DataFrame, near: Near, dealt: bool = False) -> DataFrame:
    """Edges (a, b) that span the groups of texts in one cluster (columns root, key, hashes) that ``near`` links.

    ``near`` takes sorted sets and tells of each two whether they link. Any two texts of a cluster are compared or are in
    one group already; nothing is capped. With ``dealt`` clusters is a written table that has ``chunks`` and ``i`` (see
    ``chunked``).
    """
    alone = {"j": F.lit(0), "side": F.lit(None).cast("int")}
    dealt = clusters if dealt else keep(_in_chunks(clusters, 0), "dealt")
    edges = keep(_compare(dealt.withColumns(alone), near), "links")
    large = dealt.where("chunks > 1").drop("i")
    if large.isEmpty():
        return edges
    for turn in range(1, 64):
        grouped = keep(_grouped(large, edges), "grouped")
        leaders = keep(_in_chunks(grouped.where("key = part").select("root", "key", "hashes"), turn), "leaders")
        found = keep(_compare(leaders.withColumns(alone), near), "links")
        edges = keep(edges.unionByName(found), "links")
        if found.count() * LEFT < leaders.count() or leaders.where("chunks > 1").isEmpty():
            break
    return edges.unionByName(_outside(keep(_grouped(large, edges), "grouped"), near))


def _grouped(large: DataFrame, edges: DataFrame) -> DataFrame:
    """large with ``part``, a text that all of a group share."""
    found = keep(classes(edges), "parts")
    return large.join(found.select(F.col("node").alias("key"), F.col("root").alias("part")), "key", "left").withColumn("part", F.coalesce("part", "key"))


def _outside(grouped: DataFrame, near: Near) -> DataFrame:
    """Edges from texts outside the largest group of their cluster to texts of its other groups."""
    parts = grouped.groupBy("root", "part").agg(F.count("*").alias("n"), F.sum(F.length("hashes")).alias("bytes"))
    most = F.max(F.struct("n", "part"))["part"]
    small = parts.groupBy("root").agg(most.alias("most"), F.count("*").alias("parts"), F.sum("n").alias("n"), F.max("n").alias("top"), F.sum("bytes").alias("bytes")).where("parts > 1")
    small = small.select("root", "most", F.greatest(F.ceil((F.col("n") - F.col("top")) / TEXTS), F.ceil(F.col("bytes") / F.col("n") * (F.col("n") - F.col("top")) / BYTES)).cast("int").alias("blocks"))
    members = keep(grouped.join(small, "root").withColumn("mine", F.pmod(F.xxhash64("key", F.lit(-1)), F.col("chunks")).cast("int")), "members")
    block = F.pmod(F.xxhash64("key", F.lit(-2)), F.col("blocks")).cast("int")
    # side 0 is a block of texts outside the largest group, side 1 a chunk of all texts
    one = members.where("part <> most").select("root", block.alias("i"), _every("chunks").alias("j"), "key", F.lit(0).alias("side"), "hashes")
    two = members.select("root", _every("blocks").alias("i"), F.col("mine").alias("j"), "key", F.lit(1).alias("side"), "hashes")
    return _compare(one.unionByName(two), near)


# -- groups of copies -------------------------------------------------------------------------------------------


def copies(docs: DataFrame, shingle: int = 5, radius: int = 8, alike: float = 0.8) -> DataFrame:
    """The first document (``doc_id``, ``h`` a hash of its text) of each group of copies; rows without an id come last.

    Candidates are the shingle sets within ``radius`` bits of each other by any of SEEDS fingerprints. Those that
    a path of candidates joins are compared by their exact Jaccard similarity; links of ``alike`` or more join.
    """
    signed = keep(_signed(docs, shingle), "signed")
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h")
    sets = signed.groupBy("same").agg(F.min(rank).alias("rep"), F.first("fps").alias("fps"))
    sets = keep(sets.select(F.monotonically_increasing_id().alias("key"), "rep.doc_id", "rep.h", "fps"), "sets")
    after = lambda n: F.element_at("fps", F.pmod(F.col("seed") + n, F.lit(SEEDS)).cast("int") + 1)
    prints = sets.select("key", "fps", F.posexplode("fps").alias("seed", "fp")).select("key", "seed", "fp", after(1).alias("e1"), after(2).alias("e2"))
    least = prints.groupBy("seed", "fp").agg(F.min(F.struct(F.col("key").alias("node"), "e1", "e2")).alias("l"))
    least = keep(least.select("seed", "fp", "l.*"), "distinct")
    same = prints.join(least.select("seed", "fp", "node"), ["seed", "fp"]).where("key <> node").select(F.col("key").alias("a"), F.col("node").alias("b"))
    edges = keep(links(least, radius, SEEDS, FAR).unionByName(same), "candidates")
    clusters = keep(classes(edges).withColumnRenamed("node", "key").join(sets.drop("fps"), "key"), "clusters")
    of = clusters.select("root", "key", F.col("doc_id").alias("id"), F.col("h").alias("__h"))
    texts = _texts(docs).join(of, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("h") == F.col("__h"))).select("root", "key", "text").dropDuplicates(["key"])
    hashes = keep(texts.mapInArrow(_shingled(shingle), "root long, key long, hashes binary"), "hashes")
    roots = keep(classes(verified(hashes, lambda s: _alike(s, alike))), "roots")
    rooted = sets.join(roots, F.col("key") == F.col("node"), "left").select(F.coalesce("root", "key").alias("root"), "doc_id", "h")
    return rooted.groupBy("root").agg(F.min(rank).alias("first")).select("first.doc_id", "first.h")


def keep_one(docs: DataFrame, shingle: int = 5, radius: int = 8, alike: float = 0.8) -> DataFrame:
    """One row of docs for each group of copies (see ``copies``), with all columns: that of the smallest doc_id.

    Rows of one id but different texts are different documents. Rows without an id come after all others: one of
    them stays where its group has no row with an id. Of rows with equal id and text one stays. Null and wordless
    texts are copies of each other. An empty table gives an empty result; the other columns are not looked at.
    """
    id_, h = free_names(docs.columns, "__id", "__h")
    firsts = copies(docs, shingle, radius, alike).select(F.col("doc_id").alias(id_), F.col("h").alias(h))
    stay = docs.join(keep(firsts, "firsts"), F.col("doc_id").eqNullSafe(F.col(id_)) & (F.xxhash64("text") == F.col(h)))
    return stay.dropDuplicates([id_, h]).select(*docs.columns)
