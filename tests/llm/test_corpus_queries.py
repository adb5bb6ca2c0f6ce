"""Registered queries and the pipeline, with their own parameters, against plain recomputation."""

import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import xxhash
from test_copies import brute_groups
from test_corpus import brute_repeats
from tokenizers import Tokenizer

import corpus_pipeline
from venuegrid.llm import quality, queries, rules

SMALL = "/root/testdata/sf0.001"


def plain_terms(text):
    """Counts of a text's words, their shapes and repeated words, by hash."""
    words = (text or "").encode().split()
    kind = lambda c: "a" if "a" <= c <= "z" or ord(c) >= 128 else "A" if "A" <= c <= "Z" else "0" if "0" <= c <= "9" else c
    found = Counter()
    for k, w in enumerate(words):
        shape = re.sub(r"(.)\1+", r"\1", "".join(kind(c) for c in w.decode("latin-1")), flags=re.S)
        found[xxhash.xxh64_intdigest(w.lower(), 1)] += 1
        found[xxhash.xxh64_intdigest(shape.encode("latin-1"), 2)] += 1
        if k and words[k - 1] == w:
            found[xxhash.xxh64_intdigest(b"same word as before")] += 1
    return len(words), found


def test_quality_votes(spark):
    """Every score is the vote of the 25 nearest labelled documents, weighted by the fourth power of the cosine."""
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    labels = spark.read.parquet(f"{SMALL}/labels.parquet").selectExpr("doc_id", "quality AS label")
    model = quality.learn(spark.read.parquet(f"{SMALL}/documents.parquet"), labels.where(~quality.held_out()))
    taught = {r.doc_id: r.label for r in labels.where(~quality.held_out()).collect()}

    def vector(text):
        n, found = plain_terms(text)
        return np.sqrt(np.array([found[int(t)] for t in model.terms]) / max(n, 1)) * model.idf

    texts = dict(docs)
    ids = sorted(i for i in taught if i in texts)
    x = np.stack([vector(texts[i]) for i in ids])
    df = Counter(t for i in ids for t in plain_terms(texts[i])[1])
    assert {int(t) for t in model.terms} <= {t for t, n in df.items() if n > 1}
    assert np.allclose(model.idf, [np.log1p(len(ids) / (1 + df[int(t)])) for t in model.terms], rtol=1e-5)
    best = np.linalg.svd(x, compute_uv=False)[: model.axes.shape[1]]
    assert np.linalg.norm(x @ model.axes) >= 0.999 * np.linalg.norm(best) and np.allclose(model.axes.T @ model.axes, np.eye(model.axes.shape[1]), atol=1e-4)
    unit = lambda y: y / np.maximum(np.linalg.norm(y, axis=-1, keepdims=True), 1e-30)
    known, said = unit(x @ model.axes), np.array([taught[i] for i in ids], float)
    got = {r.doc_id: r for r in queries.QUERIES["op2_quality"](spark, SMALL).collect()}
    assert len(got) == len(docs)
    for i, text in docs:
        near = known @ unit(vector(text) @ model.axes)
        at = np.argsort(-near)[: quality.NEIGHBOURS]
        weight = np.maximum(near[at], 0) ** 4
        want = (weight * said[at]).sum() / weight.sum() if weight.sum() > 1e-9 else said.mean()
        assert abs(got[i].score - want) < 2e-3 and got[i].predicted == (got[i].score >= 0.3)


def test_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = [(truth[r.doc_id], r.predicted) for r in queries.QUERIES["op2_quality"](spark, sf).collect() if r.held_out and r.doc_id in truth]
    assert len(got) > 50 and sum(a == b for a, b in got) >= 0.95 * len(got)


def test_pipeline(spark):
    """Documents after each stage, recomputed, and the token ids that the last one packs."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    scores = {r.doc_id: r.score for r in queries.QUERIES["op2_quality"](spark, SMALL).collect()}
    left = [r for r in docs.collect() if scores[r.doc_id] >= 0.3]
    judged = {r.doc_id: r.kept for r in rules.judge(spark.createDataFrame(left, docs.schema)).collect()}
    left = sorted((r.doc_id, r.text) for r in left if judged[r.doc_id])
    left = [left[g] for g in sorted(set(brute_groups([t for _, t in left])))]
    kept = {w[0]: (w[4] if w[2] else t) for w, (_, t) in zip(brute_repeats(left, 50), left, strict=True)}
    assert 20 < len(kept) < docs.count()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for i, t in kept.items()}
    pieces, sequences = defaultdict(list), Counter()
    for r in corpus_pipeline.run(spark, SMALL).collect():
        pieces[r.doc_id].append((r.start, np.frombuffer(r.ids, "<u4").tolist()))
        sequences[r.sequence_id] += r.length
    assert {i: [t for _, ids in sorted(ps) for t in ids] for i, ps in pieces.items()} == want
    assert all(n == 4096 or n & (n - 1) == 0 for n in sequences.values()) and max(sequences.values()) <= 4096
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality classifier", "quality rules", "simhash near-dedup", "substring dedup", "packing"]
