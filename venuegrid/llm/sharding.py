"""Sharding of indivisible groups by best-fit-decreasing bin packing.

Groups of equal text stay whole. They are packed largest first, each into the bin with the least remaining capacity
that still holds it, found in a balanced tree of the bins by remaining capacity. Groups under a PARTS-th of a shard are
first put together, by a hash, in units of about that size, so that there are at most some PARTS units a shard, however
many groups and sizes of groups there are. Best fit puts units of one size into the same bin until it is too full for
the next, so it needs only how many units of each size there are: Spark counts them, the packing runs over (size, count)
pairs, and the units of a size are then dealt to the bins by their number within that size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from venuegrid.llm.common import keep

#: Units of a shard at most, about: what the driver packs is bounded by PARTS times the shards.
PARTS = 4096
#: Rows that one slot-numbering unit is meant to hold.
UNIT = 20_000


class Rooms:
    """Bins ordered by (remaining capacity, bin) in a treap whose priorities are a mix of the key, so it stays balanced."""

    def __init__(self) -> None:
        self.root: list | None = None  # [key, priority, left, right]

    @staticmethod
    def _priority(key: tuple[int, int]) -> int:
        return ((key[0] * 0x9E3779B1 + key[1] + 1) * 0x85EBCA6B) & 0xFFFFFFFF

    def _split(self, node: list | None, key: tuple[int, int]) -> tuple[list | None, list | None]:
        """Nodes under ``key``, and the others."""
        if node is None:
            return None, None
        if node[0] < key:
            node[3], right = self._split(node[3], key)
            return node, right
        left, node[2] = self._split(node[2], key)
        return left, node

    def _join(self, a: list | None, b: list | None) -> list | None:
        if a is None or b is None:
            return a or b
        if a[1] >= b[1]:
            a[3] = self._join(a[3], b)
            return a
        b[2] = self._join(a, b[2])
        return b

    def add(self, room: int, name: int) -> None:
        key = room, name
        left, right = self._split(self.root, key)
        self.root = self._join(self._join(left, [key, self._priority(key), None, None]), right)

    def tightest(self, size: int) -> tuple[int, int] | None:
        """The least (room, bin) with room for ``size``, taken out; None if no bin has."""
        node, best = self.root, None
        while node is not None:
            if node[0][0] >= size:
                best, node = node[0], node[2]
            else:
                node = node[3]
        if best is not None:
            left, right = self._split(self.root, best)
            _, right = self._split(right, (best[0], best[1] + 1))
            self.root = self._join(left, right)
        return best


def best_fit(sizes: list[tuple[int, int]], capacity: int, bins: int | None = None) -> list[tuple[int, int, int]] | None:
    """Best-fit-decreasing of ``sizes``, pairs (size, how many groups): (size, groups, bin) in the order of placing.

    Of equally tight bins the lowest is taken. Groups above the capacity get a bin each. None if more than ``bins``
    bins would be needed.
    """
    rooms, used, placed = Rooms(), 0, []
    for size, n in sorted(sizes, reverse=True):
        while n:
            found = rooms.tightest(size)
            if found is None:
                used += 1
                if bins is not None and used > bins:
                    return None
                found = max(capacity, size), used - 1
            room, name = found
            take = min(n, room // size) if size else n
            placed.append((size, take, name))
            n -= take
            rooms.add(room - take * size, name)
    return placed


def even_bins(sizes: list[tuple[int, int]], bins: int) -> list[tuple[int, int, int]]:
    """``sizes`` in at most ``bins`` bins of near-equal size, as (size, groups, bin).

    A group above the mean of what is left takes a bin alone; the rest is packed by best-fit-decreasing at the
    smallest capacity (to 1/1024 of the mean) found to need no more than the bins left.
    """
    left, placed, total, own = dict(sizes), [], sum(s * n for s, n in sizes), 0
    while left and bins - own > 1 and (size := max(left)) * (bins - own) > total:
        placed.append((size, 1, own))
        own, total = own + 1, total - size
        left[size] -= 1
        if not left[size]:
            del left[size]
    rest = list(left.items())
    low, high = -(-total // (bins - own)), max(total, 1)
    step = max(1, low // 1024)
    found = best_fit(rest, low, bins - own)
    if found is None:
        over = low + step  # the capacity needed is seldom far above the mean
        while over < high and (found := best_fit(rest, over, bins - own)) is None:
            low, over = over, low + 2 * (over - low)
        high = min(over, high)
        found = found or best_fit(rest, high, bins - own)
        while high - low > step:
            at = (low + high) // 2
            tried = best_fit(rest, at, bins - own)
            low, high, found = (at, high, found) if tried is None else (low, at, tried)
    return placed + [(s, n, b + own) for s, n, b in found or []]


def numbered(rows: DataFrame, within: list[str], order: list[str], name: str) -> DataFrame:
    """rows with ``name``: gapless numbers from 0 for rows of equal ``within``; rows should be a written table.

    Rows are cut by a hash of ``order`` into units of about equal row count (UNIT at most). The unit sizes give each
    unit its first number, and the rows are numbered by ``order`` inside their unit, so no task holds all rows of one
    ``within``. ``order`` has to tell rows apart if many are to be equal in it.
    """
    units = rows.groupBy(*within).agg(F.count("*").alias("__rows"))
    total = rows.count()
    each = min(UNIT, max(UNIT // 40, total // 512))
    many = keep(units.where(F.col("__rows") > each).select(*within, F.ceil(F.col("__rows") / each).alias("__units")), "units")
    cut = rows.join(many, within, "left").withColumn("__unit", F.pmod(F.xxhash64(*order), F.coalesce("__units", F.lit(1))).cast("int"))
    before = Window.partitionBy(*within).orderBy("__unit").rowsBetween(Window.unboundedPreceding, -1)
    firsts = cut.groupBy(*within, "__unit").agg(F.count("*").alias("n")).select(*within, "__unit", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__first"))
    place = F.row_number().over(Window.partitionBy(*within, "__unit").orderBy(*order))
    placed = cut.withColumn("__place", place).join(firsts, [*within, "__unit"])
    return placed.withColumn(name, (F.col("__first") + F.col("__place") - 1).cast("long")).drop("__units", "__unit", "__place", "__first")


def units_of(groups: DataFrame, shards: int, parts: int = PARTS) -> DataFrame:
    """groups (``__group``, ``__n`` bytes) with ``__small`` and ``__pack``: small groups share units, any other is one alone."""
    total = groups.agg(F.sum("__n")).first()[0] or 0
    small = F.col("__n") * shards * parts < total
    held = groups.where(small).agg(F.sum("__n")).first()[0] or 0
    units = max(1, -(-held * shards * parts // max(total, 1)))
    return groups.withColumn("__small", small).withColumn("__pack", F.when(small, F.pmod(F.xxhash64("__group"), F.lit(units))).otherwise(F.col("__group")))


def assign(rows: DataFrame, group: Column, size: Column, shards: int) -> DataFrame:
    """rows with a column ``shard``: groups stay whole and shard sizes come out near-equal.

    ``group`` is a long that names a row's group, ``size`` its non-negative size. A group that alone exceeds a
    shard's fair share gets a shard to itself and the others share what is left.
    """
    marked = rows.withColumn("__group", group).withColumn("__size", size)
    groups = keep(marked.groupBy("__group").agg(F.sum("__size").alias("__n")), "groups")
    groups = units_of(groups, shards, PARTS)
    units = keep(groups.groupBy("__small", "__pack").agg(F.sum("__n").alias("__n")), "packed")
    counts = [(r[0], r[1]) for r in units.groupBy("__n").agg(F.count("*")).collect()]  # no more rows than units
    upto: dict[int, list[tuple[int, int]]] = {}  # by size: units up to which number go to which bin
    for n, count, at in even_bins(counts, shards):
        cuts = upto.setdefault(n, [])
        cuts.append(((cuts[-1][0] if cuts else 0) + count, at))
    bins = rows.sparkSession.createDataFrame(list(upto.items()), "__n long, __bins array<struct<upto: long, at: int>>")
    dealt = numbered(units, ["__n"], ["__small", "__pack"], "__number").join(bins, "__n")
    first = F.filter("__bins", lambda b: b["upto"] > F.col("__number"))[0]["at"]
    placed = groups.join(dealt.select("__small", "__pack", first.alias("shard")), ["__small", "__pack"]).select("__group", "shard")
    return marked.join(placed, "__group").drop("__group", "__size")


def shard(docs: DataFrame, shards: int) -> DataFrame:
    """Every row of docs in one of ``shards`` shards of near-equal bytes, rows of equal text together.

    Reads ``doc_id`` and ``text``. Returns doc_id, size (UTF-8 bytes plus 8), text_crc32, law (``bytes``), shard,
    slot (gapless from 0 in its shard) and grown_shard (null under this law). A null text counts as the empty
    text and shares its group; repeated rows and null ids keep a slot each; an empty table gives an empty result.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + F.lit(8)).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("group"))
    # the number of a row tells equal rows apart; it is written, so it stays the same
    rows = keep(rows.withColumn("__row", F.monotonically_increasing_id()), "sizes")
    dealt = keep(assign(rows, F.col("group"), F.col("size"), shards), "dealt")
    slotted = numbered(dealt, ["shard"], ["doc_id", "__row"], "slot")
    return slotted.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
