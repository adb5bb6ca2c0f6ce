"""Corpus operators against brute force on small fixtures: nulls, empty and long texts, ties, repeated rows, clashing columns, empty tables."""

import hashlib
import pathlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from venuegrid.llm import components, copies, licences, packing, pieces, quality, recompress, rules, simhash, topk

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, fp string, uid int, key string, score string, shard string, `group` string, label string"
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def corpus() -> list[tuple]:
    rng = random.Random(5)
    words = [a + b + c for a in ("th", "an", "er", "on", "Ka") for b in ("re", "in", "é", "ou") for c in ("", "s", "ly", "ed.", "nt,")]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    shared = prose(70)
    base = prose(400)
    texts = [None, "", "   \n\t ", "one", "a b c", prose(30), base, base, base.replace("the", "tha", 1), base + " more", prose(49), shared, prose(60) + " " + shared + "\n" + prose(80), shared.upper()]
    texts += ["same word " * 100, "same " * 300, "same " * 120 + prose(60), prose(20) + " " + "same " * 120]
    texts += [prose(rng.randint(5, 200)) for _ in range(25)]
    texts += [shared + " " + prose(10), prose(9000), "x" * 50_000, "Released under the MIT License.\nhello", "İ ß ﬁ \u00a0 x \u2028 y", "😀 日本 <|endoftext|> <s> ▁ \x02"]
    cut = base.split()
    texts += [" ".join(cut[k : k + 120]) for k in (0, 40, 77)] + ["\n".join(["line one", "line one", "", "line two"] * 9)]
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(6, base), (900, None), (901, base)]
    return [(i, t, "en" if i % 3 else None, "s", 0, "fp", 1, "k", "s", "h", "g", "l") for i, t in rows]


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(3).cache()


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("false")


# -- op3 -------------------------------------------------------------------------------------------------------


def brute_repeats(rows, window):
    split = [(i, WORD.findall(t or "")) for i, t in rows]
    low = {}
    for i, w in split:
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            low[key] = min(low.get(key, i), i)
    out = []
    for i, w in split:
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if low[tuple(w[k : k + window])] < i:
                gone[k : k + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return out


def test_repeats(spark, docs, rows, none):
    want = brute_repeats([r[:2] for r in rows], 50)
    assert sum(0 < w[2] < w[1] for w in want) >= 5
    got = sorted(tuple(r) for r in recompress.repeats(docs).collect())
    assert got == sorted(w[:4] for w in want)
    assert recompress.repeats(none).count() == 0
    left = recompress.remove_repeats(docs)
    assert left.columns == docs.columns
    cut = {(w[0], w[1]): w[4] for w in want if w[2]}
    expected = Counter((r[0], cut.get((r[0], len(WORD.findall(r[1] or ""))), r[1])) for r in rows)
    assert Counter((r.doc_id, r.text) for r in left.collect()) == expected
    assert recompress.remove_repeats(none).count() == 0


def test_texts_that_polynomials_modulo_two_to_the_64_confuse(spark):
    """Thue-Morse sequences of two words and their opposites are different texts, whatever the base."""
    turn = [k.bit_count() % 2 for k in range(1024)]
    head = " ".join(f"head{k}" for k in range(30))
    rows = [(1, head + " " + " ".join("ab"[x] * 2 for x in turn)), (2, head + " " + " ".join("ba"[x] * 2 for x in turn))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for window in (50, 1024):
        got = sorted(tuple(r) for r in recompress.repeats(docs, window).collect())
        assert got == sorted(w[:4] for w in brute_repeats(rows, window))
    assert {r[0]: r[2] for r in recompress.repeats(docs).collect()} == {1: 0, 2: 1024}


def test_recompression_reveals_every_shared_window():
    rng = random.Random(9)
    for letters, n in ((2, 400), (3, 300), (40, 300)):
        a = [b"w%d" % rng.randrange(letters) for _ in range(n)]
        for _ in range(15):
            start, size = rng.randrange(n - 120), rng.randint(50, 110)
            b = [b"w%d" % rng.randrange(letters) for _ in range(rng.randrange(30))] + a[start : start + size] + [b"w%d" % rng.randrange(letters) for _ in range(30)]
            words = recompress.Words(recompress.Known(), recompress.Powers(), [a, b])
            doc, first, key = recompress.window_keys(words, 50)
            by = defaultdict(set)
            for d, f, k in zip(doc.tolist(), first.tolist(), key.tolist(), strict=True):
                text = a if d == 0 else b
                by[tuple(text[f - words.start[d] : f - words.start[d] + 50])].add(k)
            assert all(len(ks) == 1 for ks in by.values())


# -- op5 -------------------------------------------------------------------------------------------------------


def brute_print(t, n):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    shingles = [" ".join(w[k : k + n]) for k in range(len(w) - n + 1)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, prints, radius):
    root = list(range(len(ids)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in range(len(ids)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= radius:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    least = {}
    for k, i in enumerate(ids):
        least[find(k)] = min(least.get(find(k), i), i)
    return [least[find(k)] for k in range(len(ids))]


@pytest.mark.parametrize(("shingle", "radius"), [(4, 4), (5, 6)])
def test_simhash(docs, rows, none, shingle, radius):
    ids, prints = [r[0] for r in rows], [brute_print(r[1], shingle) for r in rows]
    want = sorted(zip(ids, prints, brute_components(ids, prints, radius), strict=True))
    got = sorted((r.doc_id, r.fp % (1 << 64), r.component_id) for r in simhash.near_duplicates(docs, shingle, radius).collect())
    assert got == want
    assert simhash.near_duplicates(none).count() == 0


def test_links_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(simhash, "CHUNK", 8)
    rng = random.Random(3)
    prints = set()
    for _ in range(6):
        centre = rng.getrandbits(64)
        prints |= {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for _ in range(40)}
    prints |= {rng.getrandbits(64) for _ in range(100)}
    prints = sorted(p - (1 << 64) if p >> 63 else p for p in prints)
    edges = simhash.links(spark.createDataFrame([(p,) for p in prints], "fp long"), 4).collect()
    assert all(e.a != e.b for e in edges)
    found = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = brute_components(prints, [p % (1 << 64) for p in prints], 4)
    assert [found.get(p, p) for p in prints] == want


def test_plan_spends_the_radius():
    sample = np.random.default_rng(1).integers(0, 1 << 63, 300, dtype=np.uint64)
    for radius in (1, 3, 4, 6):
        layout = simhash.plan(sample, 10_000, radius)
        assert sum(t + 1 for _, t in layout) == radius + 1
        bits = [b for g, _ in layout for b in g]
        assert len(bits) == len(set(bits))


@pytest.mark.parametrize("small", [0, 30, 200_000])
def test_components(spark, monkeypatch, small):
    monkeypatch.setattr(components, "SMALL", small)
    edges = [(k, k + 1) for k in range(40)] + [(100, 101), (101, 100), (7, 7), (None, 3), (300, 200)] + [(1000, k) for k in range(1001, 1060)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(41)} | {100: 100, 101: 100, 200: 200, 300: 200} | {k: 1000 for k in range(1000, 1060)}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# -- op8, op4 --------------------------------------------------------------------------------------------------


def test_packing(docs, rows, none):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    want = Counter(tuple([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]) for _, t, *_ in rows)
    for fold in (False, True):
        got = packing.pack(docs, TOKENIZER, length=1024, open_windows=3, ids=True, fold=fold).collect()
        sequences, documents = defaultdict(list), defaultdict(list)
        for r in got:
            ids = np.frombuffer(r.ids, "<u4")
            assert len(ids) == r.length > 0 and zlib.crc32(r.ids) == r.ids_crc32
            sequences[r.sequence_id].append((r.offset, r.length))
            documents[r.doc_id, r.doc_tokens].append((r.start, ids.tolist()))
        for parts in sequences.values():
            at = 0
            for offset, length in sorted(parts):
                assert offset == at
                at += length
            assert at <= 1024 and at & (at - 1) == 0
        assert sum(r.length for r in got) == sum(len(k) * n for k, n in want.items())
        single = {k: v for k, v in documents.items() if sum(len(i) for _, i in v) == k[1]}
        assert len(single) > 40
        for parts in single.values():
            assert tuple(i for _, ids in sorted(parts) for i in ids) in want
    assert packing.pack(none, TOKENIZER).count() == 0


def test_pieces(docs, rows, none):
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    got = pieces.encode(docs, PIECES)
    assert sorted((r.doc_id, tuple(r.ids)) for r in got.collect()) == sorted((r[0], tuple(model.encode(r[1] or ""))) for r in rows)
    texts = Counter((r.doc_id, r.text) for r in pieces.decode(got, PIECES).collect())
    assert texts == Counter((r[0], (r[1] or "").replace("▁", " ")) for r in rows)
    assert all(r.round_trip for r in got.where("n_pieces < 40000").collect() if r.n_pieces and "▁" not in (dict((x[0], x[1]) for x in rows)[r.doc_id] or ""))
    assert pieces.encode(none, PIECES).count() == 0


def test_unigram_viterbi():
    rng = random.Random(4)
    letters = "abc"
    vocabulary = {c: (k, -5.0) for k, c in enumerate(letters)} | {"".join(rng.choice(letters) for _ in range(rng.randint(2, 4))): (k + 3, -rng.random() * 9) for k in range(25)}
    model = pieces.Vocabulary(vocabulary, {}, kind="unigram")

    def best(word):
        if not word:
            return 0.0
        return max(vocabulary[word[:k]][1] + best(word[k:]) for k in range(1, len(word) + 1) if word[:k] in vocabulary)

    words = sorted({"".join(rng.choice(letters) for _ in range(rng.randint(1, 9))) for _ in range(80)})
    for word, parts in model.segment(words):
        assert "".join(parts) == word
        assert abs(sum(vocabulary[p][1] for p in parts) - best(word)) < 1e-9


# -- op9 -------------------------------------------------------------------------------------------------------


def test_rules(docs, rows, none):
    def brute(t):
        t = t or ""
        w = WORD.findall(t)
        lines = [x for x in t.split("\n") if WORD.search(x)]
        seen = Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
        again = [False] * len(w)
        for k in range(len(w) - 7):
            if seen[tuple(w[k : k + 8])] > 1:
                again[k : k + 8] = [True] * 8
        n, r = len(w), sum(again)
        return n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), r, n < 20 or 100 * r > 30 * n

    got = rules.judge(docs).collect()
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got) == Counter((r[0], *brute(r[1])) for r in rows)
    assert not any(r.kept and r.base_failed for r in got)
    assert rules.judge(none).count() == 0
    kept = Counter(r.doc_id for r in got if r.kept)
    assert Counter(r.doc_id for r in rules.keep_sound(docs).collect()) == kept


def test_rules_judge_short_documents(spark):
    """Of 40 to 99 words: gibberish and another script go, prose of the language stays."""
    rng = random.Random(8)
    made_up = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6))
    word = lambda: rng.choice(rules.COMMON["en"]) if rng.random() < 0.4 else made_up()
    made = [(k, " ".join(word() for _ in range(40 + 3 * (k % 20) if k % 2 else 150))) for k in range(200)]
    made += [(1000 + k, " ".join(made_up() for _ in range(40 + 3 * k))) for k in range(20)]
    made += [(2000, " ".join("".join(rng.choice("абвгдежзик") for _ in range(6)) for _ in range(60)))]
    got = {r.doc_id: r for r in rules.judge(spark.createDataFrame([(i, t, "en") for i, t in made], "doc_id long, text string, lang string")).collect()}
    assert not any(got[1000 + k].kept for k in range(20))
    assert got[2000].char_distance > rules.CHAR_FAR and not got[2000].kept
    assert sum(not got[k].kept for k in range(200)) <= 4


def test_distance(spark):
    df = spark.createDataFrame([([1.0, 0.0], [0.0, 1.0]), ([0.5, 0.5], [0.5, 0.5]), (None, [1.0, 0.0])], "p array<double>, q array<double>")
    assert [r[0] for r in df.select(rules._distance("p", "q")).collect()] == [1.0, 0.0, None]


# -- op2 -------------------------------------------------------------------------------------------------------


def test_quality(spark, docs, none):
    rng = random.Random(2)
    make = lambda k: (" ".join(rng.choice(["the", "house", "river", "of", "stone."]) for _ in range(60)), 1) if k % 3 else (" ".join(rng.choice(["XX!!", "YY$$$", "ZZ###", "|"]) for _ in range(60)), 0)
    made = [(k, *make(k)) for k in range(300)]
    some = spark.createDataFrame(made, "doc_id long, text string, label int")
    got = {r.doc_id: r for r in quality.classify(some.select("doc_id", "text"), some.select("doc_id", "label")).collect()}
    assert all(got[k].held_out == (zlib.crc32(str(k).encode()) % 5 == 0) for k, _, _ in made)
    assert all(got[k].predicted == label for k, _, label in made) and all(0 <= r.score <= 1 for r in got.values())
    edge = quality.classify(docs, some.select("doc_id", "label")).collect()
    assert len(edge) == docs.count() and all(0 <= r.score <= 1 for r in edge)
    nobody = some.select("doc_id", "label").where("false")
    assert {r.score for r in quality.classify(docs, nobody).collect()} == {0.5}
    assert quality.classify(none, some.select("doc_id", "label")).count() == 0
    assert quality.keep_good(docs, nobody).count() == docs.count()
    good = quality.keep_good(some.select("doc_id", "text"), some.select("doc_id", "label"))
    assert {r.doc_id for r in good.collect()} == {k for k, _, label in made if label}


# -- op1 -------------------------------------------------------------------------------------------------------


def test_topk(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(120, 8)) / 3
    vectors = [(i, [float(x) for x in v]) for i, v in enumerate(base)] + [(i + 120, [float(x) for x in base[7]]) for i in range(60)]
    vectors += [(500, None), (501, [1.0, None] * 4), (502, [float("nan")] * 8), (503, [float("inf")] * 8), (None, [0.1] * 8), (520, [0.5, 0.5]), (540, [0.25, 0.5]), (7, [float(x) for x in base[7]]), (560, [1e9] * 8)]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in vectors], "vec_id long, embedding array<double>, raw string, qb int")
    good = {i: [int(np.floor(64 * x)) for x in v] for i, v in vectors if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    want = set()
    for q in (i for i in good if i % 20 == 0):
        found = sorted((-sum(a * b for a, b in zip(good[q], v, strict=True)), i) for i, v in good.items() if i != q and len(v) == len(good[q]))
        want |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(found[:20])}
    assert {tuple(r) for r in topk.search(df, F.col("vec_id") % 20 == 0).collect()} == want
    assert topk.search(df.where("false"), F.col("vec_id") % 20 == 0).count() == 0


def tops_of(vectors, queries, k):
    """Top lists of some vectors against all, as a task makes them."""
    raw = [v.astype("<i8").tobytes() for v in vectors]
    x = vectors.astype(float)
    pivots, alone = [np.zeros(x.shape[1])], np.linalg.norm(x[:1024], axis=1)
    while len(pivots) <= topk.PIVOTS:
        pivots.append(x[int(alone.argmax())])
        alone = np.minimum(alone, np.linalg.norm(x[:1024] - pivots[-1], axis=1))
    pivots = np.stack(pivots)
    far = [np.linalg.norm(pivots - v, axis=1).tobytes() for v in x]
    ids = np.empty(len(raw), object)
    ids[:] = [[i] for i in range(len(raw))]
    tops = topk.Tops([raw[i] for i in queries], [far[i] for i in queries], k)
    tops.meet(raw, far, np.arange(len(raw)), ids)
    return tops


@pytest.mark.parametrize(("clusters", "share"), [(0, 2.0), (10, 0.25), (100, 0.5)])
def test_pivots_eliminate(clusters, share):
    """None is missed; of clustered vectors bounds and products together cost a small share of all products' operations.

    Of independent ones in 64 dimensions the triangle inequality excludes next to none.
    """
    rng = np.random.default_rng(12)
    x = rng.normal(size=(3000, 64))
    if clusters:
        x = rng.normal(size=(clusters, 64))[rng.integers(0, clusters, 3000)] * 2 + 0.2 * x
    v = np.floor(8 * x).astype(np.int64)
    queries = list(range(0, 3000, 20))
    tops = tops_of(v, queries, 21)
    want = np.sort(v[queries] @ v.T, axis=1)[:, ::-1][:, :21]
    assert (np.sort(tops.score, axis=1)[:, ::-1] == want).all()
    assert tops.met == 3000 * len(queries)
    operations = (tops.compared + 64 * tops.evaluated) / (64 * tops.met)
    print(clusters, tops.evaluated / tops.met, operations)
    assert operations < share


def test_unlike_fingerprints_of_one_signature(spark):
    """50,000 fingerprints that share a partition's bits: parted by the others, no group is large, and no near pair is lost."""
    rng = np.random.default_rng(8)
    group = list(range(0, 64, 2))
    same = sum(1 << bit for bit in group[:20])
    other = rng.integers(0, 2**64, 50_000, dtype=np.uint64)
    mask = np.uint64(sum(1 << bit for bit in group))
    prints = (other & ~mask) | np.uint64(same)
    near = prints[:300].copy()
    for k in range(300):  # up to four bits away
        for bit in rng.choice([b for b in range(64) if b not in group], int(rng.integers(1, 5)), replace=False):
            near[k] ^= np.uint64(1 << int(bit))
    every = np.concatenate([prints, near]).view(np.int64).tolist()
    rows = spark.createDataFrame([(0, 77, f, 0) for f in every], "part int, sig long, fp long, role int")
    parted = rows.mapInArrow(simhash._parted([(group, 0)], 4, []), "part int, sig long, fp long, role int").cache()
    sizes = parted.groupBy("sig").count()
    assert parted.count() == 5 * len(every) and sizes.agg(F.max("count")).first()[0] < simhash.CHUNK // 4
    assert sizes.select(F.sum(F.col("count") * F.col("count"))).first()[0] < 0.15 * len(every) ** 2
    by = defaultdict(set)
    for r in parted.collect():
        by[r.fp].add(r.sig)
    assert all(by[int(a)] & by[int(b)] for a, b in zip(prints[:300].view(np.int64), near.view(np.int64), strict=True))


# -- op10 -------------------------------------------------------------------------------------------------


def test_licences(spark, none):
    mit = "Copyright (c) 2020 Someone\n\n" + licences.TEXTS["MIT"].upper().replace("SUBLICENSE", "SUBLICENCE")
    made = [(1, mit), (2, "x\n# Licensed under CC BY 4.0\nReleased under the MIT licence!"), (3, None), (4, ""), (5, licences.TEXTS["ISC"] + " more"), (1, mit)]
    df = spark.createDataFrame([(i, t, "d", "n") for i, t in made], "doc_id long, text string, digest string, license string")
    got = sorted((r.doc_id, r.license, tuple(r.notices)) for r in licences.scan(df).collect() if r.license or r.notices)
    assert got == [(1, "MIT", ()), (1, "MIT", ()), (2, None, ("CC-BY-4.0", "MIT"))]
    assert licences.scan(df).count() == 6 and licences.scan(df.where("false")).count() == 0


def test_licences_of_the_caller_and_by_digest(spark):
    df = spark.createDataFrame([(1, "x\n// Dedicated to the public domain!"), (2, "Organisation, programme")], "doc_id long, text string")
    got = {r.doc_id: r.notices for r in licences.scan(df, notices={"PD": ["Dedicated to the public domain."], "O": ["organization program"]}).collect()}
    assert got == {1: ["PD"], 2: ["O"]}
    found = {r.license for r in licences.known(spark).collect()}
    assert {"Apache-2.0", "GPL-2.0", "GPL-3.0", "MPL-2.0", "CC0-1.0", "MIT"} <= found


TITLES = {
    "MIT": ["MIT License", "The MIT License (MIT)", "# MIT License", "License: MIT", "Expat License"], "ISC": ["ISC License", "The ISC License", "ISC License (ISC)"], "0BSD": ["Zero-Clause BSD License", "0BSD License"],
    "Zlib": ["zlib License", "The zlib/libpng License"], "BSD-2-Clause": ["BSD 2-Clause License", "The 2-Clause BSD License", "Simplified BSD License", 'BSD 2-Clause "Simplified" License'], "BSD-3-Clause": ["BSD 3-Clause License", "The New BSD License", "BSD 3-Clause"],
}
OWNERS = ["Copyright (c) 2023 Jane Doe", "Copyright Jane Doe and contributors", "© 2019-2024 Société Générale. All rights reserved.", "Copyright (C) 2001 A\nCopyright (C) 2002 B\nAll Rights Reserved.", "SPDX-License-Identifier: x\n(c) someone"]


def test_whole_licence_files(spark):
    """Files of every listed short licence: with and without title, owners, list marks, comment marks and line breaks of their own."""
    made = []
    for name, body in licences.TEXTS.items():
        body = body.replace("COPYRIGHT HOLDERS", "COPYRIGHT OWNERS") if name == "BSD-2-Clause" else body
        bullets = body.replace("\n1. ", "\n * ").replace("\n2. ", "\n * ").replace("\n3. ", "\n - ")
        narrow = "\n".join(" ".join(body.split(" ")[k : k + 9]) for k in range(0, len(body.split(" ")), 9))
        for title in [*TITLES[name], ""]:
            for owner in [*OWNERS, ""]:
                head = "\n\n".join(x for x in (title, owner) if x)
                made += [(name, f"{head}\n\n{body}\n"), (name, f"\n{owner}\n{title}\n==========\n\n{bullets}"), (name, f"{head}\r\n\r\n{narrow}".replace("\n", "\n  "))]
    clause = licences.TEXTS["BSD-3-Clause"].replace("the name of the copyright holder nor", "the name of Example Inc., Ltd. nor")
    made.append(("BSD-3-Clause", f"Copyright 2008, Example Inc.\nAll rights reserved.\n\n{clause}"))
    df = spark.createDataFrame([(k, t) for k, (_, t) in enumerate(made)], "doc_id long, text string")
    got = {r.doc_id: r.license for r in licences.scan(df).collect()}
    assert [(n, t) for k, (n, t) in enumerate(made) if got[k] != n] == []


def test_what_is_no_licence_file(spark):
    mit = licences.TEXTS["MIT"]
    made = ["MIT License", "MIT License\nCopyright 2020 x", mit[:-1] + " more.", "Foreword.\n\n" + mit, mit + "\n\n" + licences.TEXTS["ISC"], "\n" * 30_000 + "x", "-" * 50_000 + "x", "(c) " * 20_000]
    df = spark.createDataFrame(list(enumerate(made)), "doc_id long, text string")
    assert {r.license for r in licences.scan(df).collect()} == {None}


@pytest.mark.parametrize(("file", "name"), [("Apache-2.0", "Apache-2.0"), ("GPL-3", "GPL-3.0"), ("GPL-2", "GPL-2.0"), ("LGPL-2.1", "LGPL-2.1"), ("MPL-2.0", "MPL-2.0"), ("CC0-1.0", "CC0-1.0"), ("Artistic", "Artistic-1.0-Perl"), ("GFDL-1.3", "GFDL-1.3")])
def test_long_licence_files(spark, file, name):
    path = pathlib.Path("/usr/share/common-licenses", file)
    if not path.exists():
        pytest.skip("no such file here")
    text = path.read_text(errors="replace")
    rows = [(0, text), (1, "Copyright 2024 Someone\n\n" + text.upper()), (2, text + "\nand more")]
    assert {r.doc_id: r.license for r in licences.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()} == {0: name, 1: name, 2: None}


# -- clashing names, ties, decoding -------------------------------------------------------------------------


def test_clashing_column_names(spark):
    rows = [(1, "a b c d e f g h " * 9, "en", 1, 2, 3, 4), (2, "a b c d e f g h " * 9, "en", 5, 6, 7, 8), (3, "x y", None, 9, 9, 9, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, __id int, __uid int, __new int, __h int")
    cut = {tuple(r) for r in recompress.remove_repeats(docs, 50).collect()}
    assert cut == {rows[0], (2, "", *rows[1][2:]), rows[2]}
    assert {tuple(r) for r in copies.keep_one(docs).collect()} == {rows[0], rows[2]}
    kept = rules.keep_sound(docs)
    assert kept.columns == docs.columns and {tuple(r) for r in kept.collect()} <= set(rows)


def test_ties_between_neighbours():
    """Of equally similar labelled documents the first count, whatever else is in the batch."""
    rng = np.random.default_rng(3)
    vectors = np.repeat(np.eye(4, dtype=np.float32), 20, axis=0)
    labels = (np.arange(80) % 20 < 15).astype(np.float64)
    model = quality.Model(np.zeros(0, np.uint64), np.zeros(0, np.float32), np.eye(4, dtype=np.float32), vectors, labels)
    some = np.abs(rng.standard_normal((50, 4))).astype(np.float32)
    some /= np.linalg.norm(some, axis=1, keepdims=True)
    whole = model.score(some)
    assert np.array_equal(whole, np.concatenate([model.score(some[k : k + 7]) for k in range(0, 50, 7)]))
    near = np.round(some @ vectors.T, 5)
    for row, got in zip(near, whole, strict=True):
        at = sorted(range(80), key=lambda k: (-row[k], k))[: quality.NEIGHBOURS]
        weight = row[at].astype(float) ** 4
        assert abs(got - (weight * labels[at]).sum() / weight.sum()) < 2e-6


def test_round_trip_is_computed():
    """A vocabulary that spells one piece wrongly is found out by decoding, for exactly the texts that have it."""
    path = PIECES
    texts = ["the house", " two  spaces ", "", "a\nb", "é漢字 \u0001", "mark ▁ here", "no such word"]
    encoder = pieces.Encoder(pieces.Vocabulary.load(path))
    ids, true = encoder.encode([t.encode() for t in texts])
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    assert [i.tolist() for i in ids] == [library.encode(t) for t in texts]
    assert true == [library.decode(i.tolist()) == t for i, t in zip(ids, texts, strict=True)] and true.count(False) == 1
    encoder.vocabulary.text[int(ids[0][-1])] = "HOUSE"
    encoder.forget()
    assert encoder.encode([t.encode() for t in texts])[1][0] is False
