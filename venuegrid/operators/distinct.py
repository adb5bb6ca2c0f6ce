"""Costly work on inputs that repeat, done once for each distinct input."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from venuegrid.sources.tables import kept


def once_each(rows: DataFrame, inputs: list[str], made: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """rows, each joined with all that ``made`` gives for its ``inputs``, which may be null.

    ``made`` gets the distinct inputs and keeps their columns; its others are to have names that rows lack. Distinct
    inputs are dealt evenly to all cores: costly rows may be a file of a few megabytes, which one task would read. What
    is made is written once, so that it is broadcast only where its size is known to be small.
    """
    tasks = 2 * rows.sparkSession.sparkContext.defaultParallelism
    of = {c: f"__of_{c}" for c in inputs}
    each = kept(made(rows.select(*inputs).distinct().repartition(tasks)).withColumnsRenamed(of), "each")
    same = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(o)) for c, o in of.items()))
    return rows.join(each, same).drop(*of.values())
