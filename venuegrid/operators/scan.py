"""Scans of ordered rows by key that leave no key to one task.

Rows are range-partitioned by key and order, so a key with many rows lies in many buckets. Each bucket is scanned by
itself; what it hands on (how far it reaches, how many runs it begins) is a row, and only these rows meet by key.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from venuegrid.sources.tables import kept

ISLAND = "__island"


def _carried(rows: DataFrame, keys: list[str], value: Column, fold: Callable[[Column], Column], name: str) -> DataFrame:
    """rows with ``name``: the fold of value over the earlier buckets of a row's key, null in the first."""
    each = rows.groupBy(*keys, "__bucket").agg(fold(value).alias("__v"))
    earlier = Window.partitionBy(*keys).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = each.select(*(F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)), F.col("__bucket").alias("__of"), fold(F.col("__v")).over(earlier).alias(name))
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)), F.col("__bucket") == F.col("__of"))
    return rows.join(before, same).drop("__of", *(f"__k{i}" for i in range(len(keys))))


def islands(rows: DataFrame, keys: list[str], order: list[str], reach: Column, begins: Callable[[Column], Column]) -> DataFrame:
    """rows with ``__island``, the number from 1 of the run that a row belongs to within its key.

    In the stated order, a row begins a run if ``begins`` says so of the greatest ``reach`` of all earlier rows of its
    key (null in the first row). Keys may be null. Rows are written once: the boundaries of buckets come from a sample
    that every evaluation would draw anew. So is each row's place, which settles ties of ``order`` alike in both scans.
    """
    dealt = rows.repartitionByRange(*keys, *order).withColumn("__bucket", F.spark_partition_id()).withColumn("__place", F.monotonically_increasing_id())
    dealt = kept(dealt, "dealt")
    here = Window.partitionBy(*keys, "__bucket").orderBy(*order, "__place")
    earlier = here.rowsBetween(Window.unboundedPreceding, -1)
    reached = _carried(dealt.withColumn("__reach", reach), keys, F.col("__reach"), F.max, "__far")
    marked = reached.withColumn("__far", F.greatest("__far", F.max("__reach").over(earlier)))
    marked = marked.withColumn("__new", F.when(F.col("__far").isNull() | F.coalesce(begins(F.col("__far")), F.lit(True)), 1).otherwise(0))
    counted = _carried(marked.drop("__reach", "__far"), keys, F.col("__new"), F.sum, "__runs")
    run = F.coalesce("__runs", F.lit(0)) + F.sum("__new").over(here.rowsBetween(Window.unboundedPreceding, 0))
    return counted.withColumn(ISLAND, run).drop("__bucket", "__place", "__new", "__runs")
