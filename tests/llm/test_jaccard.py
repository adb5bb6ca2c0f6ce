"""The n-gram Jaccard join against all pairs."""

import random
import re

import numpy as np
import pytest

from venuegrid.llm import copies, jaccard, queries

SMALL = "/root/testdata/sf0.001"


def sets_of(text, n=3):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    return {tuple(words[k : k + n]) for k in range(len(words) - n + 1)} or ({tuple(words)} if words else set())


def plain(docs, num=90, den=100, n=3):
    sets = [sets_of(t, n) for _, t in docs]
    root = list(range(len(sets)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a, x in enumerate(sets):
        for b, y in enumerate(sets[:a]):
            if x and y and min(len(x), len(y)) * den >= num * max(len(x), len(y)) and den * len(x & y) >= num * len(x | y):
                root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(docs):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return sorted(((i, len(sets[k]), least.get(find(k)) if sets[k] else i) for k, (i, _) in enumerate(docs)), key=repr)


def rows(found):
    return sorted((tuple(r) for r in found.select("doc_id", "n_shingles", "component_id").collect()), key=repr)


def test_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    want = plain(docs)
    assert rows(queries.QUERIES["op11_ngram_join"](spark, SMALL)) == want
    assert any(i != c for i, _, c in want)


def near_copies(rng, n):
    """Families of texts around the threshold, of all lengths."""
    out = []
    for _ in range(n):
        words = [f"w{rng.randrange(10**6)}" for _ in range(rng.choice([3, 9, 11, 12, 13, 21, 22, 40, 90, 250]))]
        for _ in range(rng.randrange(2, 6)):
            now = list(words)
            for _ in range(rng.randrange(0, 1 + len(words) // 30 + 1)):
                k = rng.randrange(len(now))
                now[k : k + rng.randrange(0, 2)] = [f"v{rng.randrange(10**6)}"][: rng.randrange(0, 2)]
            out.append(" ".join(now).upper() if rng.random() < 0.3 else " ".join(now))
    return out


@pytest.mark.parametrize("num, den", [(90, 100), (3, 4), (1, 1)])
def test_around_the_threshold(spark, num, den):
    rng = random.Random(num)
    made = [(k, t, 0, 0) for k, t in enumerate(near_copies(rng, 60))]
    made += [(None, "a b c d", 0, 0), (None, None, 0, 0), (900, None, 0, 0), (901, "", 0, 0), (902, " \t", 0, 0), (903, "one", 0, 0), (904, "ONE", 0, 0), (905, "one two", 0, 0), (5, "another text of one id", 0, 0), (906, "a B c d", 0, 0), (906, "a B c d", 0, 0)]
    made += [(950 + k, "long text " * 4000 + t, 0, 0) for k, t in enumerate(["", "end", " "])]
    docs = spark.createDataFrame(made, "doc_id long, text string, h int, root int").repartition(3)
    want = plain([r[:2] for r in made], num, den)
    assert rows(jaccard.join(docs, 3, num, den)) == want
    assert rows(jaccard.join(docs.limit(0), 3, num, den)) == []


@pytest.mark.parametrize("num, den", [(90, 100), (4, 5)])
def test_linked_sets_share_an_entry(num, den):
    """The pigeonhole, on sets just above the bound, small and large, and with empty blocks."""
    rng, levels = np.random.default_rng(5), jaccard.Levels(num, den)
    for _ in range(3000):
        n = int(rng.integers(1, 400))
        common = rng.integers(0, 2**64, n, dtype=np.uint64)
        most = n * (den - num) // num
        extra = rng.integers(0, 2**64, most, dtype=np.uint64)
        cut = int(rng.integers(0, most + 1))
        a, b = np.unique(np.concatenate([common, extra[:cut]])), np.unique(np.concatenate([common, extra[cut:]]))
        assert den * n >= num * (n + most)
        assert np.array_equal(a, b) or np.intersect1d(jaccard.entries(a, levels), jaccard.entries(b, levels)).size


def test_product(monkeypatch):
    monkeypatch.setattr(jaccard, "TILE", 4)
    monkeypatch.setattr(jaccard, "SLAB", 16)
    rng = random.Random(9)
    sets = [copies.shingles(t.encode(), 3) for t in near_copies(rng, 12)]
    size = lambda x, y: len(np.intersect1d(x, y))
    want = [[100 * size(x, y) >= 90 * (len(x) + len(y) - size(x, y)) and size(x, y) > 0 for y in sets] for x in sets]
    assert jaccard.product(sets, 90, 100).tolist() == want
    assert jaccard.product([], 90, 100).shape == (0, 0)
