"""State tables as snapshots in a folder that every executor reaches."""

from __future__ import annotations

import tempfile
import uuid
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from venuegrid.schema import PARTS, TABLES


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share; one of our own only in local mode where the session names none."""
    found = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="venuegrid-"))
        found = spark.sparkContext.getCheckpointDir()
    return found


def kept(rows: DataFrame, what: str) -> DataFrame:
    """rows written as Parquet to the folder that driver and executors share, and reread."""
    path = f"{shared_folder(rows.sparkSession)}/{what}-{uuid.uuid4().hex}"
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


class Store:
    """Tables below a root, each of one or more parts; every write is a new snapshot of the parts it touches.

    A table's numbered commits list its parts and their snapshots. A commit is a new folder, nothing is overwritten,
    so a run that dies between a snapshot and its commit leaves the commit before as it was. Tables in ``PARTS`` are
    cut by that column, and only the parts that change are written again.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self.seen: dict[str, int] = {}  # the newest commit seen of each table

    def _read_or_none(self, read):
        try:
            return read()
        except AnalysisException as e:
            if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return None
            raise

    def _commit_at(self, name: str, commit: int) -> DataFrame | None:
        return self._read_or_none(lambda: self.spark.read.text(f"{self.root}/{name}/commits/{commit:012d}"))

    def _newest(self, name: str) -> int:
        """The newest commit's number, 0 before the first: numbers have no gaps, so a few looks at folders find it."""
        low, step = self.seen.get(name, 0), 1
        while self._commit_at(name, low + step) is not None:
            low, step = low + step, step * 2
        high = low + step
        while high - low > 1:
            middle = (low + high) // 2
            low, high = (middle, high) if self._commit_at(name, middle) is not None else (low, middle)
        self.seen[name] = low
        return low

    def _current(self, name: str) -> tuple[int, dict[str, str]]:
        """The newest commit's number and its snapshots by part; 0 and none before the first. No older commit is read."""
        commit = self._newest(name)
        listed = self._commit_at(name, commit) if commit else None
        if listed is None:
            if self._read_or_none(lambda: self.spark.read.parquet(f"{self.root}/{name}/snapshot-*-2-*")) is not None:
                raise FileNotFoundError(f"{self.root}/{name} has snapshots but its commits are lost")
            return 0, {}
        rows = (r.value.split("\t", 2) for r in listed.collect())  # a row per part
        return commit, {part: at for _, part, at in rows if at}

    def exists(self, name: str) -> bool:
        return self._current(name)[0] > 0

    def read(self, name: str, parts: list | None = None) -> DataFrame:
        """A table, or only those of its parts; a state table that was never written is empty."""
        commit, found = self._current(name)
        if not commit and name not in TABLES:
            raise FileNotFoundError(f"{self.root}/{name}")
        paths = [at for part, at in found.items() if parts is None or part in map(str, parts)]
        if not paths:
            if name in TABLES:
                return self.spark.createDataFrame([], TABLES[name])
            return self.spark.read.parquet(next(iter(found.values()))).where(F.lit(False))
        rows = self.spark.read.parquet(*paths)
        return rows.select(*(rows[f.name].cast(f.dataType) for f in TABLES[name])) if name in TABLES else rows

    def _commit(self, name: str, commit: int, parts: dict[str, str]) -> None:
        rows = [(f"{commit}\t{part}\t{at}",) for part, at in parts.items()] or [(f"{commit}\t\t",)]
        self.spark.createDataFrame(rows, "value string").coalesce(1).write.text(f"{self.root}/{name}/commits/{commit:012d}")
        self.seen[name] = commit

    def write(self, name: str, rows: DataFrame, if_exists: str = "replace") -> None:
        """if_exists: fail (FileExistsError), skip or replace; readers see the new table only once it is whole."""
        if if_exists not in ("fail", "skip", "replace"):
            raise ValueError(if_exists)
        commit, _ = self._current(name)
        if commit and if_exists != "replace":
            if if_exists == "fail":
                raise FileExistsError(f"{self.root}/{name}")
            return
        by = PARTS.get(name)
        values = [r[0] for r in rows.select(by).distinct().collect()] if by else [None]
        self._commit(name, commit + 1, self._snapshots(name, commit + 1, rows, by, values))

    def rewrite(self, name: str, rows: DataFrame, values: list) -> None:
        """Replace the parts ``values`` of a table by rows; all its other parts stay as they are."""
        commit, found = self._current(name)
        new = self._snapshots(name, commit + 1, rows, PARTS[name], values)
        stay = {part: at for part, at in found.items() if part not in set(map(str, values))}
        self._commit(name, commit + 1, stay | new)

    def _snapshots(self, name: str, commit: int, rows: DataFrame, by: str | None, values: list) -> dict[str, str]:
        """Write one snapshot of rows; the folder of each part. Folders of parts hold no column ``by``, so it is kept twice."""
        at = f"{self.root}/{name}/snapshot-{commit}-{1 if commit == 1 else 2}-{uuid.uuid4().hex}"
        if by is None:
            rows.write.parquet(at)
            return {"": at}
        rows.where(F.col(by).isin(values)).withColumn("part", F.col(by)).write.partitionBy("part").parquet(at)
        made = self._read_or_none(lambda: self.spark.read.parquet(at))  # none if there were no rows
        there = made.select("part").distinct().collect() if made is not None else []
        return {str(r[0]): f"{at}/part={r[0]}" for r in there}

    def create_database(self) -> None:
        """Every state table that does not exist yet, empty."""
        for name, schema in TABLES.items():
            self.write(name, self.spark.createDataFrame([], schema), "skip")

    def update(self, name: str, where: dict, to: dict) -> int:
        """Set columns of the rows whose columns equal all of ``where``; how many there were. A null equals nothing."""
        rows = self.read(name)
        hit = reduce(lambda a, b: a & b, (F.col(c) == F.lit(v) for c, v in where.items()), F.lit(True))
        hit = F.coalesce(hit, F.lit(False))
        n = rows.where(hit).count()
        if n:
            self.write(name, rows.select(*(F.when(hit, F.lit(to[c]).cast(t)).otherwise(F.col(c)).alias(c) if c in to else F.col(c) for c, t in rows.dtypes)))
        return n

    def load(self, name: str, query: str | None = None) -> DataFrame:
        """A whole table, or what a query over the tables gives."""
        return self.read(name) if query is None else self.sql(query)

    def sql(self, text: str, *args, **named) -> DataFrame:
        """SQL over the state tables with positional (``?``) or named (``:name``) parameters."""
        for name in TABLES:
            self.read(name).createOrReplaceTempView(name)
        return self.spark.sql(text, args=list(args) if args else named)
