"""Quality classification by similarity-weighted votes of nearest labelled documents.

Documents become tf-idf vectors over words and word shapes, reduced to a latent-semantic space by a truncated
singular value decomposition of labelled documents. The labelled vectors, at most LABELLED of them, are broadcast;
every document's cosines with all of them are computed exactly in blocks and its NEIGHBOURS nearest vote with
their labels, weighted by similarity.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from venuegrid.llm.common import Numbers, keep, text_batches, words_of

#: Most labelled documents learned from (those with the smallest hashes of their ids), terms, and dimensions.
LABELLED, TERMS, RANK = 4000, 2048, 48
#: Votes for one document.
NEIGHBOURS = 25
#: Distinct words a task remembers before it starts anew.
VOCABULARY = 300_000
_SHAPE = bytes(97 if 97 <= b <= 122 or b >= 128 else 65 if 65 <= b <= 90 else 48 if 48 <= b <= 57 else b for b in range(256))
_RUN = re.compile(rb"(.)\1+", re.S)
_TWICE = xxhash.xxh64_intdigest(b"same word as before")


def terms_of(word: bytes) -> tuple[int, int]:
    """Hashes of a word's two terms: the lower-cased word, and its shape with runs of one class as one."""
    shape = _RUN.sub(rb"\1", word.translate(_SHAPE))
    return xxhash.xxh64_intdigest(word.lower(), 1), xxhash.xxh64_intdigest(shape, 2)


class Terms:
    """Term counts of texts; only the given terms if there are any."""

    def __init__(self, chosen: np.ndarray | None = None) -> None:
        self.chosen = chosen
        self.forget()

    def forget(self) -> None:
        self.numbers, self.known = Numbers(), np.zeros((0, 2), np.uint64)

    def _place(self, hashes: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.chosen, hashes), len(self.chosen) - 1)
        return np.where(self.chosen[at] == hashes, at, len(self.chosen)).astype(np.uint64)

    def counts(self, texts: list[bytes | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Per text (terms, counts) when no terms are chosen, else (words, counts by place)."""
        if len(self.numbers) > VOCABULARY:
            self.forget()
        each = [np.fromiter((self.numbers[w] for w in words), np.int64, len(words)) for words in map(words_of, texts)]
        new = self.numbers.names[len(self.known) :]
        if new:
            found = np.array([terms_of(w) for w in new], np.uint64)
            self.known = np.concatenate([self.known, found if self.chosen is None else self._place(found)])
        twice = np.array([_TWICE], np.uint64)
        if self.chosen is not None:
            twice = self._place(twice)
        for ids in each:
            all_terms = np.concatenate([self.known[ids].ravel(), np.repeat(twice, int((ids[1:] == ids[:-1]).sum()))])
            if self.chosen is None:
                yield np.unique(all_terms, return_counts=True)
            else:
                yield np.array([len(ids)]), np.bincount(all_terms.astype(np.int64), minlength=len(self.chosen) + 1)[:-1]


def weighted(counts: np.ndarray, words: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Turns a float32 matrix of term counts, in place, into weighted terms."""
    counts /= np.maximum(words, 1).astype(np.float32)[:, None]
    np.sqrt(counts, out=counts)
    counts *= idf
    return counts


@dataclass
class Model:
    """What is learned: sorted term hashes, their weights, the projection, labelled unit vectors and labels."""

    terms: np.ndarray
    idf: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray

    def embed(self, counts: np.ndarray, words: np.ndarray) -> np.ndarray:
        return self.place(weighted(counts.astype(np.float32), words, self.idf))

    def place(self, x: np.ndarray) -> np.ndarray:
        """Unit vectors, in the latent-semantic space, of rows of weighted terms."""
        y = x @ self.axes
        norm = np.linalg.norm(y, axis=1, keepdims=True)
        return np.divide(y, norm, out=np.zeros_like(y), where=norm > 0)

    def score(self, vectors: np.ndarray) -> np.ndarray:
        """The weighted share of label 1 among each row's nearest; the overall share where nothing is similar.

        Similarities count to five places, as products round differently from batch to batch; of equally similar
        labelled documents those of the smaller ids are nearer.
        """
        near = np.round(vectors @ self.vectors.T, 5)
        k = min(NEIGHBOURS, near.shape[1])
        last = np.partition(near, near.shape[1] - k, axis=1)[:, near.shape[1] - k, None]
        above, level = near > last, near == last
        chosen = above | (level & (np.cumsum(level, axis=1) <= k - above.sum(axis=1, keepdims=True)))
        weight = np.where(chosen, np.maximum(near, 0.0), 0.0).astype(np.float64) ** 4
        total = weight.sum(axis=1)
        return np.round(np.divide(weight @ self.labels, total, out=np.full(len(total), self.labels.mean()), where=total > 1e-9), 6)


def learn(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED, most_terms: int = TERMS) -> Model | None:
    """Fit on at most ``labelled`` rows of labels (doc_id, label 0 or 1); None without a usable row.

    ``labelled`` bounds the sample that is learned from, those with the smallest hashes of their ids; ``most_terms``
    how many terms, those in most of its documents, a vector has. Null ids and labels are left out; an id labelled or
    present more than once counts once.
    """
    chosen = labels.where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1)).groupBy("doc_id").agg(F.max("label").alias("label"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(labelled)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = Terms()
        for batch, texts in text_batches(batches):
            found = list(terms.counts(texts))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), pa.array([t.view(np.int64) for t, _ in found], pa.list_(pa.int64())), pa.array([c for _, c in found], pa.list_(pa.int64())), pa.array([len(words_of(t)) for t in texts], pa.int64())],
                names=["doc_id", "label", "terms", "counts", "words"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = rows.join(F.broadcast(chosen.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("label").cast("int").alias("label"))), "doc_id")
    bags = found.mapInArrow(run, "doc_id long, label int, terms array<long>, counts array<long>, words long")
    bags = keep(bags.groupBy("doc_id").agg(F.min(F.struct("label", "words", "terms", "counts")).alias("b")).select("doc_id", "b.*"), "bags")
    top = bags.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).where("df > 1").orderBy(F.desc("df"), "term").limit(most_terms).toPandas()
    if not len(top):
        return None
    terms = np.sort(top["term"].to_numpy(np.int64).view(np.uint64))
    chosen = bags.sparkSession.createDataFrame(list(enumerate(terms.view(np.int64).tolist())), "at int, term long")
    each = bags.select("doc_id", F.explode(F.arrays_zip("terms", "counts")).alias("t")).select("doc_id", F.col("t.terms").alias("term"), F.col("t.counts").alias("n"))
    each = each.join(F.broadcast(chosen), "term").groupBy("doc_id").agg(F.collect_list(F.struct("at", "n")).alias("seen"))
    # ``labelled`` rows of at most ``most_terms`` counts, however long the texts
    sample = bags.select("doc_id", "label", "words").join(each, "doc_id", "left").select("doc_id", "label", "words", F.col("seen.at").alias("at"), F.col("seen.n").alias("n")).orderBy("doc_id").toPandas()
    dense = np.zeros((len(sample), len(terms)), np.float32)
    for i, (at, n) in enumerate(zip(sample["at"], sample["n"], strict=True)):
        if at is not None:
            dense[i, np.asarray(at, np.int64)] = np.asarray(n)
    idf = np.log1p(len(sample) / (1.0 + (dense > 0).sum(axis=0))).astype(np.float32)
    model = Model(terms, idf, np.zeros((len(terms), 0), np.float32), np.zeros((0, 0), np.float32), sample["label"].to_numpy(np.float64))
    words = sample["words"].to_numpy()
    del sample
    x = weighted(dense, words, idf)
    model.axes = _axes(x, min(RANK, *x.shape))
    model.vectors = model.place(x)
    return model


def _axes(x: np.ndarray, rank: int) -> np.ndarray:
    """The leading right singular vectors, by subspace iteration from a fixed start."""
    basis = np.linalg.qr(x.T @ (x @ np.random.default_rng(7).standard_normal((x.shape[1], min(rank + 16, *x.shape))).astype(np.float32)))[0]
    for _ in range(4):
        basis = np.linalg.qr(x.T @ (x @ basis))[0]
    _, _, v = np.linalg.svd(x @ basis, full_matrices=False)
    return (basis @ v.T[:, :rank]).astype(np.float32)


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, score) for every row of docs; 0.5 for all without a model. Null texts count as empty."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    if model is None:
        return rows.select("doc_id", F.lit(0.5).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # LABELLED * RANK and TERMS * RANK floats at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        terms = Terms(model.terms)
        for batch, texts in text_batches(batches):
            words, counts = zip(*terms.counts(texts), strict=True)
            vectors = model.embed(np.stack(counts), np.concatenate(words))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.score(vectors))], names=["doc_id", "score"])

    return rows.mapInArrow(run, "doc_id long, score double")


def held_out(doc_id: str = "doc_id"):
    """Whether a row's label must not be learned from: crc32 of the id as text is a multiple of 5, or there is no id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, labelled: int = LABELLED, most_terms: int = TERMS) -> DataFrame:
    """One row per row of docs: doc_id, held_out, score (0 to 1, higher: label 1 likelier), predicted.

    Ties between neighbours go to the smaller id (see ``Model.score``).

    labels: doc_id, label. Only rows whose id is not held out are learned from, at most ``labelled`` of them (see
    ``learn``). Repeated rows each get their row; null texts score as empty ones; without labels every score is 0.5;
    an empty table gives an empty result.
    """
    model = learn(docs, labels.where(~held_out()), labelled, most_terms)
    scored = score(docs, model)
    return scored.select("doc_id", held_out().alias("held_out"), "score", F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, labelled: int = LABELLED, most_terms: int = TERMS) -> DataFrame:
    """The rows of docs whose score reaches the threshold, with all columns; see ``classify``."""
    model = learn(docs, labels.where(~held_out()), labelled, most_terms)
    if model is None:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        terms = Terms(model.terms)
        for batch, texts in text_batches(batches):
            words, counts = zip(*terms.counts(texts), strict=True)
            yield batch.filter(pa.array(model.score(model.embed(np.stack(counts), np.concatenate(words))) >= threshold))

    return docs.mapInArrow(run, docs.schema)
