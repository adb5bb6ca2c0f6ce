"""Shared helpers of the corpus operators: words, scratch tables, text batches."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Documents handled together inside a task; bounds what a Python worker holds at once.
DOCS_AT_ONCE = 256
BYTES_AT_ONCE = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; one of our own only where the session names none."""
    found = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="venuegrid-"))
        found = spark.sparkContext.getCheckpointDir()
    return found


def keep(df: DataFrame, what: str) -> DataFrame:
    """Write df as Parquet to the shared folder and read it back: cuts lineage and survives lost executors."""
    path = f"{scratch_dir(df.sparkSession)}/{what}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_names(columns: list[str], *wanted: str) -> list[str]:
    """The wanted names, with underscores after those that the columns have already (case aside)."""
    taken, out = {c.lower() for c in columns}, []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def slices(sizes: list[int], most_rows: int = DOCS_AT_ONCE, most_bytes: int = BYTES_AT_ONCE) -> Iterator[tuple[int, int]]:
    """Cut a run of texts into spans of bounded row count and bytes (a longer single text stands alone)."""
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and (i - start >= most_rows or total + size > most_bytes):
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def text_batches(batches: Iterator[pa.RecordBatch], text: str = "text") -> Iterator[tuple[pa.RecordBatch, list[bytes | None]]]:
    """Bounded slices of Arrow batches with the text column as UTF-8 bytes."""
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(text)
        column = column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary())
        sizes = [len(x) if x is not None else 0 for x in column.to_pylist()] if batch.num_rows <= 1 else _lengths(column)
        for a, b in slices(sizes):
            yield batch.slice(a, b - a), column.slice(a, b - a).to_pylist()


def _lengths(column: pa.Array) -> list[int]:
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(column), 0).to_pylist()


def words_of(text: bytes | None) -> list[bytes]:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text: bytes.split() cuts at exactly these six characters."""
    return text.split() if text else []


class Numbers(dict):
    """Gives each new key the next number; ``names`` holds the keys in that order."""

    def __init__(self) -> None:
        super().__init__()
        self.names: list[bytes] = []

    def __missing__(self, key: bytes) -> int:
        self[key] = n = len(self.names)
        self.names.append(key)
        return n


class Ragged:
    """Growing rows of ids of unequal length in one array."""

    def __init__(self) -> None:
        self.flat, self.cut, self.used = np.zeros(1 << 16, np.uint32), np.zeros(1, np.int64), 0

    def __len__(self) -> int:
        return len(self.cut) - 1

    def add(self, ids: np.ndarray, counts: np.ndarray) -> None:
        if self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(len(self.flat) + len(ids), np.uint32)])
        self.flat[self.used : self.used + len(ids)] = ids
        self.used += len(ids)
        self.cut = np.concatenate([self.cut, self.cut[-1] + np.cumsum(counts)])

    def gather(self, at: np.ndarray, each: int = 1) -> tuple[np.ndarray, np.ndarray]:
        """The ids of rows ``at`` in turn, and how many every ``each`` of them have."""
        a = self.cut[at]
        n = self.cut[at + 1] - a
        total = int(n.sum())
        return self.flat[np.repeat(a - (np.cumsum(n) - n), n) + np.arange(total)], n.reshape(-1, each).sum(axis=1)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64) over a uint64 array."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
