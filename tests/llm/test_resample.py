"""Importance resampling against a plain recomputation."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from venuegrid.llm import queries, resample

SMALL = "/root/testdata/sf0.001"


def plain_features(text, buckets):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    runs = [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    return words, [zlib.crc32(r.encode()) % buckets for r in runs]


def plain(docs, target, buckets=10_000, least=20, share=(5, 100), seed=42):
    """Rows of (doc_id, n_features, weight, score, rank)."""
    s = Counter(b for _, t in docs for b in plain_features(t, buckets)[1])
    t = Counter(b for x in target for b in plain_features(x, buckets)[1])
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log(((t[b] + 1) * (s_all + buckets)) / ((s[b] + 1) * (t_all + buckets)))) for b in range(buckets)]
    out = []
    for i, text in docs:
        words, found = plain_features(text, buckets)
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in found)
        out.append([i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words)])
    best = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    for k, r in enumerate(best[: share[0] * len(best) // share[1]]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in out), key=repr)


def rows(found):
    return sorted(((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in found.collect()), key=repr)


def test_query(spark):
    read = lambda n, *c: [tuple(r) for r in spark.read.parquet(f"{SMALL}/{n}.parquet").select(*c).collect()]
    want = plain(read("documents", "doc_id", "text"), [t for (t,) in read("benchmark", "text")])
    assert rows(queries.QUERIES["op13_resample"](spark, SMALL)) == want
    assert any(r[4] for r in want)


@pytest.mark.parametrize("share", [(1, 2), (1, 1), (0, 1), (5, 100)])
def test_many_ranges_and_odd_rows(spark, monkeypatch, share):
    monkeypatch.setattr(resample, "RANGE", 7)
    monkeypatch.setattr(resample, "BLOCK", 5)
    rng = random.Random(1)
    made = [(rng.randrange(90), " ".join(rng.choice(["The", "Ça", "x2", "a_b", "ÀB", "the"]) for _ in range(rng.randrange(12))), 1, 2) for _ in range(300)]
    made += [(None, "a b c d e", 1, 2)] * 3 + [(1000 + k, t, None, None) for k, t in enumerate([None, "", " -- ", "w " * 5000, "same text of five words", "same text of five words"])]
    made += [(5, "the x2 the x2 the", 1, 2)] * 4
    docs = spark.createDataFrame(made, "doc_id long, text string, rank int, score int").repartition(5)
    target = spark.createDataFrame([("the x2",), (None,), ("ça ça",)], "text string")
    got = rows(resample.resample(docs, target, buckets=50, least_words=5, share=share, seed=7))
    assert got == plain([r[:2] for r in made], ["the x2", None, "ça ça"], 50, 5, share, 7)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    assert resample.resample(docs.limit(0), docs).count() == 0
    assert rows(resample.resample(docs, docs.limit(0), 10, 1, (1, 1))) == plain([(1, "a b c")], [], 10, 1, (1, 1))


@pytest.mark.parametrize("k", [0, 1, 2, 3, 5, 8, 13])
def test_tournament(k):
    rng = random.Random(k)
    runs = [sorted((rng.randrange(20),) for _ in range(rng.randrange(6))) for _ in range(k)]
    assert list(resample.Tournament([list(r) for r in runs])) == sorted(x for r in runs for x in r)
