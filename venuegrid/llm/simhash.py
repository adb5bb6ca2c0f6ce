"""SimHash near-duplicates by the generalised pigeonhole principle.

A fingerprint has 64 bits. Correlated bits are grouped into partitions; partition i gets a threshold t_i of its
own with sum(t_i + 1) = radius + 1, so two fingerprints within the radius differ by at most t_i bits in at least
one partition. The thresholds come from dynamic programming over candidate counts estimated on a bounded sample
of fingerprints (SAMPLE); the sample only steers the cost, never which pairs are found. Every distinct
fingerprint is indexed under its partition values and probes all values within t_i flipped bits; candidates are
verified on all 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from venuegrid.llm.common import keep, mix, text_batches, words_of
from venuegrid.llm.components import classes

BITS = 64
#: Distinct fingerprints that steer the layout (those with the smallest hashes).
SAMPLE = 2048
#: Rows of one signature handled together; larger signatures are parted by further bits, and what stays larger is cut into pairs of chunks of this size.
CHUNK = 16384
#: Signatures of up to so many rows are compared side by side, larger ones each from link to link, so many rows at once.
FEW, BLOCK = 64, 64
#: Links of one row, on average of a block, up to which its group is not followed.
MANY = 8
#: Cost of one shuffled signature row, counted in verified pairs.
ROW_COST = 300.0
SEED = 42


def fingerprint(text: bytes | None, shingle: int) -> int:
    """The unsigned 64-bit SimHash of a text: majority of the shingles' XXH64 bits, repeats included."""
    words = words_of(text.lower()) if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[: -shingle])).tolist()
    stops = (ends[shingle - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, stops, strict=True)), np.uint64, len(starts))
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 14):  # bounds the unpacked bits of a very long text
        ones += np.unpackbits(hashes[at : at + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp) for every row; fp is the fingerprint as a signed long. Null and wordless texts get 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_batches(batches):
            fp = np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fp)], names=["doc_id", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, fp long")


# -- layout ---------------------------------------------------------------------------------------------------


def plan(sample: np.ndarray, total: int, radius: int) -> list[tuple[list[int], int]]:
    """Partitions as (bits, threshold), -1 thresholds left out; every bit lies in exactly one partition."""
    bits = np.unpackbits(sample.astype(np.uint64).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little") if len(sample) else np.zeros((0, BITS), np.uint8)
    best: tuple[float, list[tuple[list[int], int]]] | None = None
    for parts in range(2, min(radius + 1, 8) + 1):
        groups = _correlated(bits, parts)
        cost = [_costs(bits, g, radius, total) for g in groups]
        found = _allocate(cost, radius + 1)
        if best is None or found[0] < best[0]:
            best = found[0], [(g, t) for g, t in zip(groups, found[1], strict=True) if t >= 0]
    if best is None:  # radius 0: equal fingerprints only
        return [(list(range(BITS)), 0)]
    return best[1]


def _correlated(bits: np.ndarray, parts: int) -> list[list[int]]:
    """Grow each partition around its first bit by the bits that correlate most with those it has."""
    if len(bits) > 2:
        x = bits - bits.mean(axis=0)
        norm = np.sqrt((x * x).sum(axis=0))
        with np.errstate(divide="ignore", invalid="ignore"):
            corr = np.nan_to_num(np.abs(x.T @ x) / np.outer(norm, norm))
    else:
        corr = np.zeros((BITS, BITS))
    left, groups = list(range(BITS)), []
    for p in range(parts):
        size = BITS // parts + (p < BITS % parts)
        group = [left.pop(0)]
        while len(group) < size:
            near = corr[np.ix_(group, left)].sum(axis=0)
            group.append(left.pop(int(near.argmax())))
        groups.append(sorted(group))
    return groups


def _costs(bits: np.ndarray, group: list[int], most: int, total: int) -> list[float]:
    """Signature rows plus estimated candidate pairs of one partition at thresholds -1 to ``most``."""
    share = np.zeros(len(group) + 1)
    n = len(bits)
    if n > 1:
        x = bits[:, group].astype(np.float32)
        ones = x.sum(axis=1)
        far = (ones[:, None] + ones[None, :] - 2 * (x @ x.T)).round().astype(np.int64).ravel()
        pairs = np.bincount(far, minlength=len(share))
        pairs[0] -= n
        share = pairs / (n * (n - 1))
    costs = [0.0]
    for t in range(most + 1):
        values = sum(comb(len(group), k) for k in range(min(t, len(group)) + 1))
        chance = max(values / 2.0 ** len(group), float(share[: t + 1].sum()))
        costs.append(total * (values + (t > 0)) * ROW_COST + total * total / 2 * chance)
    return costs


def _allocate(cost: list[list[float]], units: int) -> tuple[float, list[int]]:
    """Dynamic programming: spend ``units`` = sum(t_i + 1) over the partitions at least cost."""
    table: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for row in cost:
        after: dict[int, tuple[float, list[int]]] = {}
        for used, (so_far, ts) in table.items():
            for spend in range(min(units - used, len(row) - 1) + 1):
                new = so_far + row[spend]
                if used + spend not in after or new < after[used + spend][0]:
                    after[used + spend] = new, [*ts, spend - 1]
        table = after
    return table[units]


def _pick(fp: np.ndarray, group: list[int]) -> np.ndarray:
    """The bits of one partition, packed from bit 0."""
    out = np.zeros(len(fp), np.uint64)
    for k, bit in enumerate(group):
        out |= ((fp >> np.uint64(bit)) & np.uint64(1)) << np.uint64(k)
    return out


def _signatures(layout: list[tuple[list[int], int]], also: list[str]):
    flips = [[sum(1 << k for k in c) for n in range(t + 1) for c in combinations(range(len(g)), n)] for g, t in layout]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                fp = part.column("fp").to_numpy().view(np.uint64)
                for p, (group, t) in enumerate(layout):
                    own = _pick(fp, group)
                    for role, masks in ((0, [0]), *([(1, flips[p])] if t else [])):
                        sig = (own[:, None] ^ np.array(masks, np.uint64)[None, :]).ravel()
                        again = np.repeat(fp, len(masks))
                        n = len(sig)
                        made = {"part": np.full(n, p, np.int32), "sig": sig.view(np.int64), "fp": again.view(np.int64), "role": np.full(n, role, np.int32)}
                        if also:  # every seed has partitions of its own
                            made["part"] += np.repeat(part.column("seed").to_numpy() * len(layout), len(masks)).astype(np.int32)
                        for name in also:
                            made[name] = np.repeat(part.column(name).to_numpy(), len(masks))
                        yield pa.RecordBatch.from_arrays([pa.array(x) for x in made.values()], names=list(made))

    return run


def _parted(layout: list[tuple[list[int], int]], radius: int, also: list[str]):
    """Rows of large signatures filed anew, under the signature and each of radius + 1 parts of the bits outside its partition.

    Two rows within the radius differ in at most that many of these bits, so they agree on one of the parts at least.
    """
    others = []
    for group, _ in layout:
        rest = [bit for bit in range(BITS) if bit not in set(group)]
        others.append([part for part in (rest[k :: radius + 1] for k in range(radius + 1)) if part])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["fp", "role", *also]
        for batch in batches:
            partition = batch.column("part").to_numpy()
            for p, parts in enumerate(others):
                some = batch.filter(pa.array(partition % len(layout) == p))
                if not some.num_rows:
                    continue
                fp, sig = some.column("fp").to_numpy().view(np.uint64), some.column("sig").to_numpy().view(np.uint64)
                if len(parts) <= radius:  # too few bits are left to part by
                    yield some.select(["part", "sig", *names])
                    continue
                for k, bits in enumerate(parts):
                    new = mix(mix(sig + np.uint64(k + 1)) ^ _pick(fp, bits))
                    yield pa.RecordBatch.from_arrays([some.column("part"), pa.array(new.view(np.int64)), *(some.column(c) for c in names)], names=["part", "sig", *names])

    return run


# -- probing --------------------------------------------------------------------------------------------------


def _near(t: dict[str, np.ndarray], a: np.ndarray, b: np.ndarray, radius: int, far: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Of rows a against rows b, or pair by pair if ``b`` is as long and flat: the places (i, j) of those close enough to be linked."""
    fp = t["fp"].view(np.uint64)
    apart = np.bitwise_count(fp[a] ^ fp[b])
    # one comparison says both "over 0" and "at most radius", as bytes wrap around
    at = np.flatnonzero(apart - np.uint8(1) < radius)
    i, j = np.divmod(at, apart.shape[1]) if apart.ndim == 2 else (at, at)
    if far is not None and len(i):
        one, two = t["e1"].view(np.uint64), t["e2"].view(np.uint64)
        x, y = a.ravel()[i], b.ravel()[j]
        ok = np.bitwise_count(one[x] ^ one[y]).astype(int) + np.bitwise_count(two[x] ^ two[y]) <= far
        i, j = i[ok], j[ok]
    return i, j


def _spread(t: dict[str, np.ndarray], rows: np.ndarray, near) -> tuple[np.ndarray, np.ndarray]:
    """Links that span the groups of one signature: group by group, from the rows reached to those not reached yet.

    Index rows meet index rows and probes, probes index rows alone. Rows of one large group of near copies are reached
    from its first few, so they never meet in all their pairs.
    """
    us, vs = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    rows = rows[np.lexsort((t["role"][rows], t["fp"][rows]))]
    rows = rows[np.concatenate(([True], t["fp"][rows][1:] != t["fp"][rows][:-1]))]  # an index row before its own probe
    left = [rows[t["role"][rows] == 0], rows[t["role"][rows] != 0]]
    reached = [rows[:0], rows[:0]]

    def meet(block: np.ndarray, side: int) -> None:
        i, j = near(block[:, None], left[side][None, :])
        new, at = np.unique(j, return_index=True)
        us.append(block[i[at]])
        vs.append(left[side][new])
        reached[side] = np.concatenate([reached[side], left[side][new]])
        left[side] = np.delete(left[side], new)

    while len(left[0]):
        if len(reached[0]):
            block, reached[0] = reached[0][:BLOCK], reached[0][BLOCK:]
            meet(block, 0)
            meet(block, 1)
        elif len(reached[1]):
            block, reached[1] = reached[1][:BLOCK], reached[1][BLOCK:]
            meet(block, 0)
        else:
            some = left[0][:BLOCK]
            found = [near(some[:, None], side[None, :]) for side in left]
            hits = np.bincount(np.concatenate([i for i, _ in found]), minlength=len(some))
            if hits.sum() <= MANY * len(some):  # few links: they are all kept, and the block is done with
                for side, (i, j) in zip(left, found, strict=True):
                    us.append(some[i])
                    vs.append(side[j])
                left[0] = left[0][len(some) :]
            else:
                k = int(hits.argmax())
                reached[0], left[0] = some[k : k + 1], np.delete(left[0], k)
    while len(reached[0]):  # index rows reached last may meet probes
        block, reached[0] = reached[0][:BLOCK], reached[0][BLOCK:]
        meet(block, 1)
    return np.concatenate(us), np.concatenate(vs)


def _verify(radius: int, probing: list[bool], far: int | None = None):
    """Runs of equal (part, sig, i, j) come sorted; yields a spanning forest of each batch's verified links."""
    probed, node = np.array(probing), "fp" if far is None else "node"

    def links(t: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        near = lambda a, b: _near(t, a, b, radius, far)
        begins = np.flatnonzero(np.concatenate(([True], t["run"][1:] != t["run"][:-1])))
        ends = np.append(begins[1:], len(t["run"]))
        us, vs = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for a, b in zip(begins[ends - begins > FEW], ends[ends - begins > FEW], strict=True):
            u, v = _spread(t, np.arange(a, b), near)
            us.append(u)
            vs.append(v)
        few = np.repeat(ends - begins <= FEW, ends - begins)
        for shift in range(1, min(FEW, len(t["run"]))):
            at = np.flatnonzero((t["run"][shift:] == t["run"][:-shift]) & few[shift:])
            if not len(at):
                break
            # a partition with a threshold links probes with index rows, any other all rows
            at = at[(t["role"][at] != t["role"][at + shift]) | ~probed[t["part"][at]]]
            at = at[near(at, at + shift)[0]]
            us.append(at)
            vs.append(at + shift)
        return np.concatenate(us), np.concatenate(vs)

    def forest(t: dict[str, np.ndarray]) -> pa.RecordBatch:
        u, v = links(t)
        ids, flat = np.unique(np.concatenate([t[node][u], t[node][v]]), return_inverse=True)
        u, v = flat[: len(u)], flat[len(u) :]
        label = np.arange(len(ids))
        while len(u):
            low = np.minimum(label[u], label[v])
            new = label.copy()
            np.minimum.at(new, label[u], low)
            np.minimum.at(new, label[v], low)
            new = new[new]
            if np.array_equal(new, label):
                break
            label = new
        order = np.lexsort((np.arange(len(ids)), label))
        first = np.searchsorted(label[order], label[order])
        rank = np.arange(len(order)) - first
        child = rank > 0
        above = order[(first + (rank - 1) // 16)[child]]  # a tree of fan-out 16 has no hub and little depth
        return pa.RecordBatch.from_arrays([pa.array(ids[order[child]]), pa.array(ids[above])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["part", "sig", "i", "j", "fp", "role"] + (["node", "e1", "e2"] if far is not None else [])
        held = {k: np.zeros(0, np.int64) for k in names}

        def numbered(t: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
            new = np.zeros(len(t["fp"]), np.int64)
            for k in names[:4]:
                new[1:] |= t[k][1:] != t[k][:-1]
            return t | {"run": np.cumsum(new)}

        for batch in batches:
            t = numbered({k: np.concatenate([held[k], batch.column(k).to_numpy().astype(np.int64)]) for k in names})
            cut = int(np.searchsorted(t["run"], t["run"][-1])) if len(t["run"]) else 0
            held = {k: t[k][cut:] for k in names}
            if cut:
                yield forest({k: x[:cut] for k, x in t.items()})
        if len(held["fp"]):
            yield forest(numbered(held))

    return run


def links(distinct: DataFrame, radius: int, seeds: int = 1, far: int | None = None) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (column ``fp``): a spanning forest of each probed signature's links.

    Every pair within the radius is joined by a path of such edges, each of them itself within the radius' closure;
    no signature, however common, is capped: one with over CHUNK rows is parted by the bits outside its partition (see
    ``_parted``), and where that leaves over CHUNK together, each pair of chunks of them is its own small unit of work. With ``far``, distinct has also the columns ``seed`` (0 to ``seeds`` - 1), ``node``
    and two more fingerprints ``e1`` and ``e2``: only fingerprints of one seed are compared, linked rows also differ in
    at most ``far`` bits of e1 and e2, and the edges join nodes; the layout is planned once, on seed 0.
    """
    also = ["node", "e1", "e2"] if far is not None else []
    total = distinct.count() // seeds
    first = distinct.where("seed = 0") if also else distinct
    sample = first.orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).select("fp").toPandas()["fp"].to_numpy(np.int64).view(np.uint64)
    layout = plan(sample, total, radius)
    kinds = "part int, sig long, fp long, role int" + "".join(f", {c} long" for c in also)
    # signatures are made twice, once to count them: that is cheaper than to write them
    rows = distinct.mapInArrow(_signatures(layout, also), kinds)
    sizes = keep(_sizes(rows), "sizes")
    dealt = rows.join(sizes.where(F.col("n") <= CHUNK), ["part", "sig"])
    large = sizes.where(F.col("n") > CHUNK)
    if not large.isEmpty():
        parted = keep(rows.join(large.select("part", "sig"), ["part", "sig"]).mapInArrow(_parted(layout, radius, also), kinds), "parted")
        dealt = dealt.unionByName(parted.join(keep(_sizes(parted), "sizes"), ["part", "sig"]))
    dealt = dealt.withColumn("chunks", F.ceil(F.col("n") / CHUNK).cast("int"))
    dealt = dealt.withColumn("mine", F.pmod(F.xxhash64("fp", "role"), F.col("chunks")).cast("int"))
    others = F.sequence(F.lit(0), F.col("chunks") - 1)
    dealt = dealt.select("part", "sig", "fp", "role", *also, F.explode(F.transform(others, lambda o: F.struct(F.least(o, "mine").alias("i"), F.greatest(o, "mine").alias("j")))).alias("c"))
    dealt = dealt.select("part", "sig", "c.i", "c.j", "fp", "role", *also).repartition("part", "sig", "i", "j").sortWithinPartitions("part", "sig", "i", "j")
    return dealt.mapInArrow(_verify(radius, [t > 0 for _, t in layout] * seeds, far), "a long, b long")


def _sizes(rows: DataFrame) -> DataFrame:
    """Rows of each signature that has more than one, an index row among them."""
    found = rows.groupBy("part", "sig").agg(F.count("*").alias("n"), F.count_if(F.col("role") == 0).alias("own"))
    return found.where("n > 1 AND own > 0").select("part", "sig", "n")


def near_duplicates(docs: DataFrame, shingle: int = 5, radius: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``fp`` (signed long) and ``component_id``, the smallest doc_id reachable.

    Documents link when their fingerprints differ in at most ``radius`` bits; wordless and null texts share
    fingerprint zero and link like any other. Repeated rows and repeated ids each keep their row. A null doc_id
    keeps its row and takes the component of its fingerprint (null if nobody there has an id). Other columns of
    docs are not read. An empty table gives an empty result.
    """
    marked = keep(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    least = keep(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    roots = keep(classes(links(least.select("fp"), radius)), "roots")
    rooted = least.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    rooted = keep(rooted, "rooted")
    ids = keep(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "ids")
    member = keep(rooted.join(ids, "root").select("fp", "component_id"), "members")
    return marked.join(member, "fp").select("doc_id", "fp", "component_id")
