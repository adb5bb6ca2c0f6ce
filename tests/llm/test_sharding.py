"""Best-fit-decreasing shards against a plain packing of single groups."""

import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from venuegrid.llm import queries, sharding

DOCS = "doc_id long, text string, shard string, slot string, `group` string, size string"


def plain_best_fit(sizes, capacity):
    """Bin loads after placing the groups one by one."""
    loads = []
    for size in sorted(sizes, reverse=True):
        fits = [(max(capacity, top) - load, at) for at, (load, top) in enumerate(loads) if max(capacity, top) - load >= size]
        if fits:
            at = min(fits)[1]
            loads[at] = loads[at][0] + size, loads[at][1]
        else:
            loads.append((size, size))
    return [load for load, _ in loads]


def loads_of(placed):
    loads = Counter()
    for size, n, at in placed:
        loads[at] += size * n
    return loads


def test_best_fit():
    assert sharding.best_fit([(5, 1), (4, 1), (3, 1), (2, 1)], 7) == [(5, 1, 0), (4, 1, 1), (3, 1, 1), (2, 1, 0)]
    assert sharding.best_fit([(5, 1), (4, 1)], 7, bins=1) is None
    assert sharding.best_fit([], 7) == []


@pytest.mark.parametrize("seed", range(6))
def test_best_fit_as_one_by_one(seed):
    rng = random.Random(seed)
    sizes = Counter(rng.choice([rng.randint(1, 100), 17, 50, 260]) for _ in range(400))
    placed = sharding.best_fit(list(sizes.items()), 250)
    assert Counter({s: sum(n for z, n, _ in placed if z == s) for s in sizes}) == sizes
    want = plain_best_fit(list(sizes.elements()), 250)
    assert [loads_of(placed)[k] for k in range(len(want))] == want


def test_even_bins():
    rng = random.Random(1)
    sizes = list(Counter(rng.randint(1, 100) for _ in range(800)).items())
    loads = loads_of(sharding.even_bins(sizes, 10))
    assert len(loads) == 10 and max(loads.values()) <= 1.01 * sum(loads.values()) / 10
    big = sharding.even_bins([(1_000_000, 1), *sizes], 4)
    own = next(at for s, _, at in big if s == 1_000_000)
    assert [s for s, _, at in big if at == own] == [1_000_000]
    assert sharding.even_bins([], 3) == []


def test_tree_finds_the_tightest():
    rng, rooms, held = random.Random(3), sharding.Rooms(), set()
    for k in range(2000):
        room = rng.randint(0, 300)
        rooms.add(room, k)
        held.add((room, k))
        if k % 3 == 2:
            size = rng.randint(0, 320)
            want = min((x for x in held if x[0] >= size), default=None)
            assert rooms.tightest(size) == want
            held.discard(want)


def check(rows, got, shards):
    """rows: (doc_id, text) of docs."""
    want = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == want
    slots, groups = defaultdict(list), defaultdict(set)
    for r in got:
        slots[r.shard].append(r.slot)
        groups[r["size"], r.text_crc32].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(shards))
    assert all(len(s) == 1 for s in groups.values())
    assert all(r.law == "bytes" and r.grown_shard is None for r in got)


def test_shards(spark, monkeypatch):
    monkeypatch.setattr(sharding, "UNIT", 200)
    rng = random.Random(7)
    rows = [(k, "w" * rng.randint(0, 400)) for k in range(600)] + [(None, None)] * 300 + [(5, "")] * 40 + [(9, "é" * 4000), (8, "x" * 300_000)]
    docs = spark.createDataFrame([(i, t, "s", "t", "g", "z") for i, t in rows], DOCS).repartition(4)
    check(rows, sharding.shard(docs, 5).collect(), 5)
    assert sharding.shard(docs.where("false"), 5).count() == 0


def test_query(spark):
    """The registered query packs the units of documents as a plain best fit of its capacity would, near-evenly."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = queries.QUERIES["op7_sharding"](spark, "/root/testdata/sf0.01").collect()
    check(rows, got, 24)
    loads = Counter()
    for r in got:
        loads[r.shard] += r["size"]
    assert len(loads) == 24 and max(loads.values()) <= 1.01 * sum(loads.values()) / 24
    groups = docs.groupBy(F.xxhash64(F.coalesce("text", F.lit(""))).alias("__group")).agg(F.sum(F.octet_length(F.coalesce("text", F.lit(""))) + 8).cast("long").alias("__n"))
    units = [r.n for r in sharding.units_of(groups, 24).groupBy("__small", "__pack").agg(F.sum("__n").alias("n")).collect()]
    assert sum(units) == sum(loads.values())
    assert any(sorted(plain_best_fit(units, c)) == sorted(loads.values()) for c in range(max(loads.values()), max(loads.values()) + 200))


def test_many_sizes_reach_the_driver_as_few(spark, monkeypatch):
    """Of 100,000 groups of different sizes the driver packs a bounded number of units, and shards come out even."""
    monkeypatch.setattr(sharding, "PARTS", 64)
    rows = spark.range(100_000).select(F.col("id").alias("g"), (F.col("id") * 7 + 11).alias("n"))
    seen = []
    pack = sharding.even_bins
    monkeypatch.setattr(sharding, "even_bins", lambda sizes, bins: seen.append(len(sizes)) or pack(sizes, bins))
    got = sharding.assign(rows, F.col("g"), F.col("n"), 8).groupBy("shard").agg(F.sum("n").alias("n"), F.count("*").alias("rows")).collect()
    assert seen[0] <= 2 * 64 * 8 and sum(r.rows for r in got) == 100_000
    mean = sum(r.n for r in got) / 8
    assert len(got) == 8 and max(r.n for r in got) <= 1.03 * mean
    large = sharding.units_of(rows.select(F.col("g").alias("__group"), F.col("n").alias("__n")), 8, 64)
    assert large.where("NOT __small AND __pack <> __group").count() == 0


def test_equal_rows_are_numbered_by_many_tasks(spark):
    rows = spark.createDataFrame([(0, None)] * 5000, "shard int, doc_id long").withColumn("__row", F.monotonically_increasing_id())
    got = sharding.numbered(rows.cache(), ["shard"], ["doc_id", "__row"], "slot")
    assert sorted(r.slot for r in got.collect()) == list(range(5000))
