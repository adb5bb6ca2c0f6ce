"""Exact top-k inner-product search by pivot-table elimination.

Every distinct vector carries its distances to the origin and to PIVOTS fixed vectors, the pivots. By the triangle
inequality each pivot p gives a lower bound |d(q, p) - d(c, p)| on the distance of a query q and a candidate c; the
greatest of them, with the norms, is an upper bound on the inner product. Candidates lie in cells, neighbours by their
nearest pivot and distance to it, and a cell knows the range of its members' distances to every pivot: one bound holds
for all of a cell, so cells are skipped without a look at their members. Each query opens cells in the order of its own
bounds until no remaining one can hold a candidate for its top list: the result is exact. Queries open cells in rounds,
twice as many in each, so that those that open the same cell share a product.

Blocks of queries meet streams of candidates: rows are dealt by (query block, candidate stream), each task holds
one block of queries with its running top lists and takes candidates CHUNK at a time. Equal vectors are one
candidate with its smallest ids, so a vector that a third of all rows share costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from venuegrid.llm.common import keep

#: Pivots beside the origin, each the one of the SAMPLE vectors with the smallest hashes that is farthest from those before.
PIVOTS, SAMPLE = 64, 1024
#: Candidates met at once, queries bounded at once, candidates of a cell, cells that a query opens in its first round.
CHUNK, BATCH, CELL, OPEN = 8192, 128, 32, 4
#: Rows of a block of queries and of a stream of candidates: at least, at most.
QUERIES, STREAM = (1024, 16384), (16384, 1 << 20)
#: Above this, products of norms are too large for exact doubles and integer arithmetic is used.
EXACT = float(1 << 52)


def quantise(vector: Column, scale: int = 64) -> Column:
    """floor(scale * x) of every component, as long; null for vectors that are null or hold null or non-finite ones."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(good, F.transform(vector, lambda x: F.floor(x.cast("double") * scale)))


def _pivots(distinct: DataFrame) -> dict[int, np.ndarray]:
    """Pivots by dimension, the origin first."""
    rows = distinct.select("raw").orderBy(F.xxhash64("raw"), "raw").limit(SAMPLE).collect()
    by: dict[int, list[np.ndarray]] = {}
    for (raw,) in rows:
        by.setdefault(len(raw) // 8, []).append(np.frombuffer(raw, "<i8").astype(float))
    found = {}
    for dim, vectors in by.items():
        x = np.stack(vectors)
        chosen = [np.zeros(dim)]
        alone = np.linalg.norm(x, axis=1)
        while len(chosen) <= PIVOTS and alone.max(initial=0) > 0:
            chosen.append(x[int(alone.argmax())])
            alone = np.minimum(alone, np.linalg.norm(x - chosen[-1], axis=1))
        found[dim] = np.stack(chosen)
    return found


def _table(pivots: dict[int, np.ndarray]):
    """Adds ``far``: each vector's distances to the pivots of its dimension (to the origin alone if it has none)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            far = []
            for raw in batch.column("raw").to_pylist():
                v = np.frombuffer(raw, "<i8").astype(float)
                far.append(np.linalg.norm(pivots.get(len(v), np.zeros((1, len(v)))) - v, axis=1).tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(far, pa.binary())], names=[*batch.schema.names, "far"])

    return run


def _bound(square: np.ndarray | float, norm: np.ndarray | float, apart: np.ndarray, other: np.ndarray) -> np.ndarray:
    """The greatest inner product of a vector (norm and its square) with one of norm ``other`` that is at least ``apart`` away."""
    return np.minimum((square + other**2 - apart**2) / 2, norm * other) + 1e-9 * (square + other**2) + 0.5  # room for rounding


class Cells:
    """Candidates in cells of neighbours, with the range of each cell's distances to every pivot."""

    def __init__(self, table: np.ndarray) -> None:
        near = table[:, 1:].argmin(axis=1) + 1 if table.shape[1] > 1 else np.zeros(len(table), int)
        self.order = np.lexsort((table[np.arange(len(table)), near], near))
        self.begins = np.arange(0, len(table), CELL)
        self.low = np.minimum.reduceat(table[self.order], self.begins, axis=0)
        self.high = np.maximum.reduceat(table[self.order], self.begins, axis=0)


class Tops:
    """Running top lists of one block of queries.

    ``met`` counts pairs, ``evaluated`` those whose product was made, ``compared`` distances that bounds compared.
    """

    def __init__(self, raw: list[bytes], far: list[bytes], k: int) -> None:
        self.k, self.dim, n = k, len(raw[0]) // 8, len(raw)
        self.q = np.frombuffer(b"".join(raw), "<i8").reshape(n, self.dim)
        self.far = np.frombuffer(b"".join(far)).reshape(n, -1)
        self.score = np.full((n, k), -np.iinfo(np.int64).max)
        self.first = np.full((n, k), np.iinfo(np.int64).max)
        self.ids = np.full((n, k), None, object)
        self.met = self.evaluated = self.compared = 0

    def meet(self, raw: list[bytes], far: list[bytes], first: np.ndarray, ids: np.ndarray) -> None:
        c, table = np.frombuffer(b"".join(raw), "<i8").reshape(len(raw), self.dim), np.frombuffer(b"".join(far)).reshape(len(raw), -1)
        cells = Cells(table)
        exact = float(self.far[:, 0].max()) * float(table[:, 0].max()) < EXACT
        ct, qt = (c[cells.order].astype(float), self.q.astype(float)) if exact else (c[cells.order], self.q)
        first, ids = first[cells.order], ids[cells.order]
        self.met += len(self.q) * len(c)
        for at in range(0, len(self.q), BATCH):
            far_q = self.far[at : at + BATCH]
            apart = np.maximum(cells.low[None] - far_q[:, None], far_q[:, None] - cells.high[None]).max(axis=2).clip(0)
            bounds = _bound(far_q[:, :1] ** 2, far_q[:, :1], apart, cells.high[None, :, 0])
            self.compared += 2 * far_q.size * len(cells.begins)
            self._rounds(at, bounds, cells.begins, ct, qt, first, ids)

    def _rounds(self, at: int, bounds: np.ndarray, begins: np.ndarray, ct: np.ndarray, qt: np.ndarray, first: np.ndarray, ids: np.ndarray) -> None:
        """Queries from ``at`` on open cells in the order of their bounds until none that is left can hold a better candidate."""
        turn = np.argsort(-bounds, axis=1, kind="stable")
        rows, opened, more = np.arange(len(bounds)), 0, OPEN
        while len(rows) and opened < turn.shape[1]:
            some = turn[rows, opened : opened + more]
            good = bounds[rows[:, None], some] >= self.score[at + rows, -1:]
            rows, some, good = rows[good[:, 0]], some[good[:, 0]], good[good[:, 0]]  # bounds fall, so nobody comes back
            query, cell = np.repeat(rows, good.sum(axis=1)), some[good]
            order = np.argsort(cell, kind="stable")
            query, cell = query[order], cell[order]
            got = np.full((len(bounds), len(ct)), -np.iinfo(np.int64).max)
            cuts = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1]))) if len(cell) else []
            for asking, k in zip(np.split(query, cuts[1:]), cell[cuts], strict=True) if len(cell) else ():
                span = slice(begins[k], begins[k] + CELL)
                got[asking, span] = qt[at + asking] @ ct[span].T
                self.evaluated += len(asking) * len(ct[span])
            self._enter(at + rows, got[rows], first, ids)
            opened, more = opened + more, more * 2

    def _enter(self, rows: np.ndarray, got: np.ndarray, first: np.ndarray, ids: np.ndarray) -> None:
        least = np.maximum(self.score[rows, -1], 1 - np.iinfo(np.int64).max)  # what was not evaluated never enters
        better = (got >= least[:, None]).any(axis=1)
        for r, s, low in zip(rows[better], got[better], least[better], strict=True):
            at = np.flatnonzero(s >= low)
            if len(at) > self.k:
                at = at[s[at] >= np.partition(s[at], len(at) - self.k)[len(at) - self.k]]
            score, firsts = np.concatenate([self.score[r], s[at]]), np.concatenate([self.first[r], first[at]])
            best = np.lexsort((firsts, -score))[: self.k]
            self.score[r], self.first[r], self.ids[r] = score[best], firsts[best], np.concatenate([self.ids[r], ids[at]])[best]


def _search(k: int):
    def result(block: list[bytes], tops: Tops) -> Iterator[pa.RecordBatch]:
        held = tops.ids != None  # noqa: E711
        query, _ = np.nonzero(held)
        for at in range(0, len(query), 1 << 14):
            some = slice(at, at + (1 << 14))
            yield pa.RecordBatch.from_arrays([pa.array([block[i] for i in query[some]], pa.binary()), pa.array(tops.score[held][some]), pa.array(list(tops.ids[held][some]), pa.list_(pa.int64()))], names=["raw", "score", "ids"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, tops, block, parts = None, None, [], []

        def flush() -> None:
            if parts:
                raw, far, ids = (sum((p[i] for p in parts), []) for i in range(3))
                own = np.empty(len(ids), object)
                own[:] = ids
                tops.meet(raw, far, np.array([x[0] for x in ids], np.int64), own)
                parts.clear()

        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in ("dim", "qb", "sb", "role")])
            cuts = np.concatenate(([0], np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1, [batch.num_rows]))
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if a == b:
                    continue
                new, role = tuple(keys[:3, a]), keys[3, a]
                part = batch.slice(a, b - a)
                if new != key:
                    if tops is not None:
                        flush()
                        yield from result(block, tops)
                    key, tops, block, parts[:] = new, None, [], []
                    held: tuple[list, list] = ([], [])
                if role == 0:
                    held[0].extend(part.column("raw").to_pylist())
                    held[1].extend(part.column("far").to_pylist())
                    continue
                if tops is None and held[0]:
                    block, tops = held[0], Tops(*held, k)
                if tops is not None:
                    parts.append([part.column(c).to_pylist() for c in ("raw", "far", "ids")])
                    if sum(len(p[0]) for p in parts) >= CHUNK:
                        flush()
        if tops is not None:
            flush()
            yield from result(block, tops)

    return run


def search(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 64) -> DataFrame:
    """The k best rows for every query row: query_id, rank (from 1), vec_id, score (integer inner product).

    Vectors are quantised first; those that are null or hold null or non-finite components, and rows without an
    id, take no part. A query never finds its own id. Ties go to the smaller vec_id; fewer than k rows give all.
    Repeated rows of one id and vector count once; vectors meet only vectors of their own dimension. Scores are signed
    64-bit numbers: quantised vectors whose norms have a product over 2**63 wrap around. An empty table gives an empty
    result; other columns are not read.
    """
    rows = vectors.withColumn("__q", is_query).select(F.col(id_col).cast("long").alias("vec_id"), quantise(F.col(vector_col), scale).alias("v"), F.coalesce("__q", F.lit(False)).alias("is_query"))
    rows = keep(rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull()), "vectors")
    # k + 1 smallest ids of each vector, first within 64 parts of it
    part = F.pmod(F.xxhash64("vec_id"), F.lit(64))
    some = rows.select("v", "vec_id", part.alias("part")).distinct()
    for by in (["v", "part"], ["v"]):
        some = some.withColumn("n", F.row_number().over(Window.partitionBy(*by).orderBy("vec_id"))).where(F.col("n") <= k + 1)
    distinct = some.groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    asked = rows.where("is_query").select("v").distinct().withColumn("asked", F.lit(True))
    distinct = distinct.join(asked, "v", "left").select("v", "ids", F.coalesce("asked", F.lit(False)).alias("asked"))
    distinct = keep(distinct.mapInArrow(_packed, "raw binary, dim int, ids array<long>, asked boolean"), "distinct")
    pivots = _pivots(distinct)
    table = keep(distinct.mapInArrow(_table(pivots), "raw binary, dim int, ids array<long>, asked boolean, far binary"), "pivots")
    total, n_asked = table.agg(F.count("*"), F.count_if("asked")).first()
    blocks = -(-n_asked // min(max(QUERIES[0], -(-n_asked // 16)), QUERIES[1])) or 1
    streams = -(-total // min(max(STREAM[0], -(-total // 16)), STREAM[1])) or 1
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    asking = table.where("asked").withColumns({"qb": F.pmod(F.xxhash64("raw"), F.lit(blocks)).cast("int"), "role": F.lit(0)}).withColumn("sb", every(streams))
    answering = table.withColumns({"sb": F.pmod(F.xxhash64("raw", F.lit(1)), F.lit(streams)).cast("int"), "role": F.lit(1)}).withColumn("qb", every(blocks))
    columns = ["dim", "qb", "sb", "role", "raw", "far", "ids"]
    dealt = asking.select(*columns).unionByName(answering.select(*columns)).repartition("dim", "qb", "sb").sortWithinPartitions("dim", "qb", "sb", "role")
    found = dealt.mapInArrow(_search(k + 1), "raw binary, score long, ids array<long>")
    best = Window.partitionBy("raw").orderBy(F.desc("score"), F.col("ids")[0])
    found = keep(found.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1).select("raw", "score", F.explode("ids").alias("vec_id")), "found")
    queries = keep(rows.where("is_query").distinct().mapInArrow(_query_keys, "query_id long, raw binary"), "queries")
    pairs = queries.join(found, "raw").where(F.col("query_id") != F.col("vec_id"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return pairs.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _raw(column: pa.Array) -> pa.Array:
    return pa.array([np.asarray(v, "<i8").tobytes() for v in column.to_pylist()], pa.binary())


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import pyarrow.compute as pc

    for batch in batches:
        v = batch.column("v")
        yield pa.RecordBatch.from_arrays([_raw(v), pc.list_value_length(v).cast(pa.int32()), batch.column("ids"), batch.column("asked")], names=["raw", "dim", "ids", "asked"])


def _query_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), _raw(batch.column("v"))], names=["query_id", "raw"])
