"""Verified near copies against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from venuegrid.llm import copies, simhash

DOCS = "doc_id long, text string, lang string, key string, h string, root string"


def shingle_set(text, n=5):
    words = (text or "").lower().split()
    return {tuple(words[k : k + n]) for k in range(len(words) - n + 1)} or ({tuple(words)} if words else set())


def brute_groups(texts, alike=0.8):
    """The least index of each text's group by exact similarity of all pairs; empty sets are one group."""
    sets = [shingle_set(t) for t in texts]
    root = list(range(len(sets)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a, x in enumerate(sets):
        for b, y in enumerate(sets[:a]):
            if (not x and not y) or len(x & y) >= alike * len(x | y) > 0:
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return [find(k) for k in range(len(sets))]


def words(rng, n):
    return [f"w{rng.randrange(10**9)}" for _ in range(n)]


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(1)
    base = words(rng, 300)
    changed = [*base[:100], "else", *base[101:]]
    texts = [None, "", " \n\t", "one", "one", "ONE", " ".join(base), " ".join(base), " ".join(changed), "x" * 50_000, " ".join(words(rng, 9000))]
    rows = [(i, t) for i, t in enumerate(texts)] + [(6, " ".join(base)), (6, "quite another text under the same id"), (None, "one"), (None, "without an id"), (None, "without an id"), (900, None)]
    return spark.createDataFrame([(i, t, "en", "k", "h", "r") for i, t in rows], DOCS).repartition(3).cache()


def test_keep_one(docs):
    left = copies.keep_one(docs)
    assert left.columns == docs.columns
    got = sorted(((r.doc_id is None, r.doc_id or 0), (r.text or "")[:12]) for r in left.collect())
    assert [g[0] for g in got] == [(False, 0), (False, 3), (False, 6), (False, 6), (False, 9), (False, 10), (True, 0)]
    assert got[-1][1] == "without an i"
    assert copies.keep_one(docs.where("false")).count() == 0


def test_keep_one_at_a_similarity(spark, monkeypatch):
    """Copies of a Jaccard of 0.8 to 0.85 go, also in clusters of several chunks; other texts stay."""
    monkeypatch.setattr(copies, "TEXTS", 4)
    rng = random.Random(11)
    prose = lambda n: [f"w{rng.randrange(10**9)}" for _ in range(n)]
    made, pairs = [], 40
    for k in range(pairs):
        base = prose(204)
        other = list(base)
        for at in (9, 59, 109, 159):  # each changes five of 200 shingles: 180 of 220 stay
            other[at] = prose(1)[0]
        made += [(2 * k, " ".join(base)), (2 * k + 1, " ".join(other))]
    base = prose(204)
    for k in range(12):  # one large group whose copies are only like the first
        other = list(base)
        other[7 + 15 * k] = "x"
        made.append((1000 + k, " ".join(other)))
    made += [(2000 + k, " ".join(prose(100))) for k in range(10)]
    sets = {i: set(copies.shingles(t.encode(), 5).tolist()) for i, t in made}
    assert all(0.8 <= len(sets[2 * k] & sets[2 * k + 1]) / len(sets[2 * k] | sets[2 * k + 1]) < 0.85 for k in range(pairs))
    left = {r.doc_id for r in copies.keep_one(spark.createDataFrame(made, "doc_id long, text string")).collect()}
    assert {2 * k for k in range(pairs)} | {1000} | {2000 + k for k in range(10)} <= left
    assert len(left) - (pairs + 11) <= 2


def near():
    return lambda sets: copies._alike(sets, 0.8)  # a function made here travels to the workers by value


def sets_of(spark, rows):
    """(root, key, text) as (root, key, hashes)."""
    made = [(r, k, bytearray(copies.shingles(t.encode(), 5).tobytes())) for r, k, t in rows]
    return spark.createDataFrame(made, "root long, key long, hashes binary")


def test_verified_drops_false_candidates(spark):
    rows = [(1, 1, "a b c d e f g h"), (1, 2, "A b c d e f g h"), (1, 3, "a b c d e f x y"), (2, 4, "a b c d e f g h")]
    got = copies.verified(sets_of(spark, rows), near()).collect()
    assert [{r.a, r.b} for r in got] == [{1, 2}]


def test_large_clusters_lose_no_link(spark, monkeypatch):
    """Chains, stars and single texts in clusters of many chunks."""
    monkeypatch.setattr(copies, "TEXTS", 8)
    monkeypatch.setattr(copies, "SLAB", 64)
    rng = random.Random(4)
    texts = []
    for _ in range(3):
        now = words(rng, 120)
        for _ in range(20):  # each like its neighbours alone
            now = list(now)
            now[rng.randrange(10, 110)] = words(rng, 1)[0]
            texts.append(" ".join(now))
    star = words(rng, 104)
    texts += [" ".join(star[:k] + ["x"] + star[k + 1 :]) for k in range(5, 95, 3)]
    texts += [" ".join(words(rng, 40)) for _ in range(30)]
    rng.shuffle(texts)
    edges = copies.verified(sets_of(spark, [(7, k, t) for k, t in enumerate(texts)]), near()).collect()
    root = list(range(len(texts)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for e in edges:
        p, q = sorted((find(e.a), find(e.b)))
        root[q] = p
    want = brute_groups(texts)
    assert len(set(want)) < len(texts) - 60
    assert [find(k) for k in range(len(texts))] == want


def test_overlaps():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 90, rng.integers(0, 60)).astype(np.uint64)) for _ in range(40)]
    got = copies.overlaps(sets)
    for a, x in enumerate(sets):
        for b, y in enumerate(sets):
            if a != b:
                assert got[a, b] == len(np.intersect1d(x, y))


def test_common_signatures_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(simhash, "FEW", 4)
    monkeypatch.setattr(simhash, "BLOCK", 8)
    rng = random.Random(6)
    prints = set()
    for _ in range(5):
        now = rng.getrandbits(64)
        for _ in range(60):  # chains of single changes
            now ^= sum(1 << b for b in rng.sample(range(64), 3))
            prints.add(now)
    prints |= {rng.getrandbits(64) for _ in range(300)}
    prints = sorted(p - (1 << 64) if p >> 63 else p for p in prints)
    edges = simhash.links(spark.createDataFrame([(p,) for p in prints], "fp long"), 4).collect()
    root = {p: p for p in prints}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for e in edges:
        assert e.a != e.b
        root[find(e.a)] = find(e.b)
    for a in prints:
        for b in prints:
            if a < b and ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 4:
                assert find(a) == find(b)
    assert len({find(p) for p in prints}) >= 300


def test_recall_on_documents(spark):
    """All pairs of the smallest documents table: copies of 0.8 or more are found, others are left alone."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
    want = {rows[g][0] for g in brute_groups([t for _, t in rows])}
    got = {r.doc_id for r in copies.keep_one(docs.withColumn("extra", F.lit(1))).collect()}
    assert want <= got and len(got) - len(want) <= 0.1 * (len(rows) - len(want))
