"""Prefix trie of conversations: distributed MSD radix partitioning over dictionary-encoded turns.

Turns (role and text) get dictionary numbers; conversations equal in all turns become one sequence with a multiplicity.
Each Spark round deals the sequences of every large bucket (a trie node) by their next number, and each new bucket is
a node. Buckets of at most LOCAL turns, or of a single sequence, leave the rounds: small ones are finished in tasks by
multikey quicksort, whose recursion emits their nodes, long single sequences as one row a turn. At last leaves and
savings are added up from the deepest round to the root. Rounds go as deep as more than LOCAL turns are left below a
prefix that different conversations share.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from venuegrid.llm.common import keep

#: Turns of a bucket that is finished in one task.
LOCAL = 2000
#: Turn numbers, and conversation ids, that are numbered or listed together.
SPAN = 1024
NO_ENDS = sha256(b"").hexdigest()

_FIELDS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]


def ordered(turns: DataFrame) -> DataFrame:
    """(conv, pos from 1, id, words): every turn in its place, with its dictionary number and its word count.

    Turns come by number, null first; those of one number by the MD5 of role and text. Rows without a conv_id belong
    to no conversation and go. A long conversation is numbered by many tasks, SPAN turn numbers each.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)))
    rows = turns.select(F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"), digest.alias("digest"), F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).alias("words"))
    rows = keep(rows.where("conv IS NOT NULL").withColumn("span", F.coalesce(F.floor(F.col("turn") / SPAN), F.lit(-(2**62)))), "turns")
    sizes = rows.groupBy("conv", "span").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("conv").orderBy("span").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("conv", "span", F.coalesce(before, F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy("conv", "span").orderBy(F.asc_nulls_first("turn"), "digest"))
    placed = rows.withColumn("place", place).join(starts, ["conv", "span"]).select("conv", (F.col("place") + F.col("before")).alias("pos"), "digest", "words")
    dictionary = keep(rows.groupBy("digest").agg(F.count("*").alias("n")).select("digest", F.monotonically_increasing_id().alias("id")), "dictionary")
    return placed.join(dictionary, "digest").select("conv", "pos", "id", "words")


def rebuilt(turns: DataFrame, conversations: DataFrame, every: int = 20, most: int = 4) -> DataFrame:
    """Turns (see ``ordered``) of each conversation c after its first h are put behind the first h of c - c % every.

    h is the CRC-32 of the decimal c modulo ``most``; a conversation that is absent or shorter gives what it has.
    """
    sizes = turns.groupBy(F.col("conv").alias("base")).agg(F.count("*").alias("n"))
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % most
    convs = conversations.select("conv", (F.col("conv") - F.col("conv") % every).alias("base"), h.alias("h"))
    convs = keep(convs.join(sizes, "base", "left").select("conv", "base", "h", F.least("h", F.coalesce("n", F.lit(0))).alias("taken")), "grafts")
    head = turns.where(F.col("pos") < most).withColumnRenamed("conv", "base")
    grafted = convs.where("taken > 0").join(head, "base").where("pos <= h").select("conv", "pos", "id", "words")
    own = turns.join(convs, "conv").where("pos > h").select("conv", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "id", "words")
    return grafted.unionByName(own)


def _ends(members: DataFrame) -> DataFrame:
    """(rep, sha): the SHA-256 of the comma-joined ids of each group of equal conversations, in numerical order.

    Ids are listed SPAN at a time by many tasks; only those lists meet in the task that hashes them one after the other.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest = None, sha256()
        for batch in batches:
            out: list[tuple[int, str]] = []
            for rep, ids in zip(batch.column("rep").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if rep != now:
                    if now is not None:
                        out.append((now, digest.hexdigest()))
                    now, digest = rep, sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            yield _batch(out, ["rep", "sha"], [pa.int64(), pa.string()])
        if now is not None:
            yield _batch([(now, digest.hexdigest())], ["rep", "sha"], [pa.int64(), pa.string()])

    listed = members.groupBy("rep", F.floor(F.col("conv") / SPAN).alias("span")).agg(F.array_join(F.transform(F.array_sort(F.collect_list("conv")), lambda c: c.cast("string")), ",").alias("ids"))
    return listed.repartition("rep").sortWithinPartitions("rep", "span").select("rep", "ids").mapInArrow(run, "rep long, sha string")


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


# -- one bucket -----------------------------------------------------------------------------------------------


def bucket_nodes(sequences: list[tuple[int, int, list[int], list[int], str]], depth: int, conv: int) -> tuple[list[list], tuple[int, int, int]]:
    """Nodes below a node of ``depth`` and smallest member ``conv``, and its own (children, leaves, saved below).

    sequences: (rep, multiplicity, ids after ``depth``, their words, digest of the ends), all different and not empty.
    Multikey quicksort: a group is parted in three by one number at its depth; the equal part is a node, whose longer
    sequences go on one turn deeper. A node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved, sha.
    """
    nodes: list[list] = []
    above: list[int] = []
    work = [(sequences, 0, -1)]
    while work:
        group, d, parent = work.pop()
        if not group:
            continue
        pivot = group[len(group) // 2][2][d]
        equal = [s for s in group if s[2][d] == pivot]
        if len(equal) < len(group):
            work.append(([s for s in group if s[2][d] < pivot], d, parent))
            work.append(([s for s in group if s[2][d] > pivot], d, parent))
        n, first, words = sum(s[1] for s in equal), min(s[0] for s in equal), equal[0][3][d]
        sha = next((s[4] for s in equal if len(s[2]) == d + 1), NO_ENDS)
        above.append(parent)
        nodes.append([first, depth + d + 1, conv if parent < 0 else nodes[parent][0], n, 0, 0, (n - 1) * words, sha])
        work.append(([s for s in equal if len(s[2]) > d + 1], d + 1, len(nodes) - 1))
    top = [0, 0, 0]
    for node, parent in zip(reversed(nodes), reversed(above), strict=True):  # children come after their parents
        node[5] = node[5] or 1
        to = top if parent < 0 else nodes[parent][4:7]
        to = [to[0] + 1, to[1] + node[5], to[2] + node[6]]
        if parent < 0:
            top = to
        else:
            nodes[parent][4:7] = to
    return nodes, (top[0], top[1], top[2])


_NODES = "level int, node long, " + ", ".join(f"{c} long" for c in _FIELDS) + ", ends_sha256 string"
_NODE_TYPES = [pa.int32(), *[pa.int64()] * 8, pa.string()]


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by bucket, sequence and place; yields each bucket's nodes and, with ``node`` set, its own sums."""
    names = ["level", "node", *_FIELDS, "ends_sha256"]
    now: tuple | None = None
    held: list[tuple] = []

    def out() -> list[tuple]:
        nodes, (children, leaves, saved) = bucket_nodes(held, now[0], now[2])
        return [*((None, None, *n) for n in nodes), (now[0], now[1], None, None, None, None, children, leaves, saved, None)]

    for batch in batches:
        rows: list[tuple] = []
        for level, node, conv, rep, mult, id_, words, sha in zip(*(batch.column(c).to_pylist() for c in ("level", "node", "conv", "rep", "mult", "id", "words", "sha")), strict=True):
            if (level, node, conv) != now:
                if held:
                    rows += out()
                now, held = (level, node, conv), []
            if not held or held[-1][0] != rep:
                held.append((rep, mult, [], [], NO_ENDS))
            held[-1][2].append(id_)
            held[-1][3].append(words)
            if sha is not None:
                held[-1] = (*held[-1][:4], sha)
        yield _batch(rows, names, _NODE_TYPES)
    if held:
        yield _batch(out(), names, _NODE_TYPES)


# -- rounds -----------------------------------------------------------------------------------------------------


def trie(turns: DataFrame, conversations: DataFrame, local: int = LOCAL) -> DataFrame:
    """One row per node: a distinct sequence of the first ``depth`` turns of some conversation, the empty one included.

    turns: (conv, pos from 1 without gaps, id, words); conversations: every ``conv``, also those without turns. Columns:
    conv_id (smallest member), depth, parent_conv_id (its parent's conv_id, null at the root), n_convs, n_children,
    n_leaves, saved_tokens and ends_sha256. No conversations, no nodes.
    """
    turns = keep(turns, "sequences")
    shape = turns.groupBy("conv").agg(F.count("*").alias("len"), *(F.bit_xor(F.xxhash64("pos", "id", F.lit(k))).alias(f"x{k}") for k in (1, 2)))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    shape = keep(conversations.join(shape, "conv", "left").select("conv", zero("len"), zero("x1"), zero("x2")), "shapes")
    groups = keep(shape.groupBy("len", "x1", "x2").agg(F.min("conv").alias("rep"), F.count("*").alias("mult")), "groups")
    reps = keep(groups.select("rep", "len", "mult").join(_ends(shape.join(groups, ["len", "x1", "x2"]).select("rep", "conv")), "rep"), "reps")
    last = F.when(F.col("pos") == F.col("len"), F.col("sha")).alias("sha")
    rows = keep(turns.withColumnRenamed("conv", "rep").join(reps, "rep").select("rep", "pos", "id", "words", "mult", "len", last), "rows")

    def bucket(by: list[Column], depth: int, members: DataFrame) -> DataFrame:
        left = F.sum(F.col("len") - depth)
        return members.groupBy(*by).agg(F.min("rep").alias("conv"), F.sum("mult").alias("n"), F.first("words").alias("words"), F.max("sha").alias("sha"), left.alias("left"), ((left > local) & (F.count("*") > 1)).alias("large"))

    top = reps.select("rep", "mult", "len", F.lit(0).alias("words"), F.when(F.col("len") == 0, F.col("sha")).alias("sha"))
    levels = [keep(bucket([], 0, top).where("n IS NOT NULL").select(F.lit(0).cast("long").alias("node"), F.lit(None).cast("long").alias("parent"), "*"), "level")]
    members = top.select(F.lit(0).cast("long").alias("node"), "rep", "mult", "len")
    finished: list[DataFrame] = []
    while True:
        depth, level = len(levels) - 1, levels[-1]
        of = members.where(F.col("len") > depth).join(level.select("node", "conv", "left", "large"), "node")
        finished.append(of.where("NOT large").select(F.lit(depth).alias("level"), "node", "conv", "rep", "left"))
        if level.where("large").isEmpty():
            break
        here = rows.where(F.col("pos") == depth + 1).select("rep", "mult", "len", "id", "words", "sha")
        step = keep(of.where("large").select(F.col("node").alias("parent"), "rep").join(here, "rep"), "step")
        found = bucket(["parent", "id"], depth + 1, step)
        found = keep(found.select(F.monotonically_increasing_id().alias("node"), "parent", "id", "conv", "n", "words", "sha", "left", "large"), "level")
        members = keep(step.join(found.select("node", "parent", "id"), ["parent", "id"]).select("node", "rep", "mult", "len"), "members")
        levels.append(found)
    done = finished[0]
    for more in finished[1:]:
        done = done.unionByName(more)
    done = keep(done, "finished")
    small = done.where(F.col("left") <= local).join(rows, "rep").where(F.col("pos") > F.col("level"))
    small = small.select("level", "node", "conv", "rep", "pos", "mult", "id", "words", "sha").repartition("level", "node").sortWithinPartitions("level", "node", "rep", "pos")
    nodes = keep(small.mapInArrow(_finish, _NODES), "nodes")
    chains, sums = _chains(done.where(F.col("left") > local), rows)
    below = keep(nodes.where("node IS NOT NULL").select("level", "node", *_FIELDS[4:]).unionByName(sums), "below")
    every = nodes.where("node IS NULL").select(*_FIELDS, "ends_sha256").unionByName(chains)
    under: DataFrame | None = None
    for depth in range(len(levels) - 1, -1, -1):
        known = below.where(F.col("level") == depth).drop("level")
        if under is not None:
            known = known.unionByName(under)
        own = (F.col("n") - 1) * F.col("words")
        total = levels[depth].join(known, "node", "left").select(
            "node", "parent", F.col("conv").alias("conv_id"), F.lit(depth).cast("long").alias("depth"), F.col("n").alias("n_convs"), F.coalesce("n_children", F.lit(0)).alias("n_children"),
            F.coalesce("n_leaves", F.lit(1)).alias("n_leaves"), (own + F.coalesce("saved_tokens", F.lit(0))).alias("saved_tokens"), F.coalesce("sha", F.lit(NO_ENDS)).alias("ends_sha256"),
        )
        total = keep(total, "totals")
        if depth:
            parents = levels[depth - 1].select(F.col("node").alias("parent"), F.col("conv").alias("parent_conv_id"))
            shown = total.join(parents, "parent")
            under = total.groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
        else:
            shown = total.withColumn("parent_conv_id", F.lit(None).cast("long"))
        every = every.unionByName(shown.select(*_FIELDS, "ends_sha256"))
    return every


def _chains(done: DataFrame, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes of buckets that hold one long sequence, a row each, and the buckets' sums."""
    at = done.join(rows, "rep").where(F.col("pos") > F.col("level"))
    after = F.sum("words").over(Window.partitionBy("rep").orderBy(F.desc("pos")))
    saved = F.when(F.col("mult") > 1, (F.col("mult") - 1) * F.col("after")).otherwise(0)
    chain = at.withColumn("after", after).select(
        F.col("rep").alias("conv_id"), "pos", F.col("rep").alias("parent_conv_id"), F.col("mult").alias("n_convs"), (F.col("pos") < F.col("len")).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"),
        saved.cast("long").alias("saved_tokens"), F.coalesce("sha", F.lit(NO_ENDS)).alias("ends_sha256"),
    )
    below = (F.col("mult") - 1) * F.col("words")
    sums = at.groupBy("level", "node").agg(F.lit(1).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"), F.sum(below).alias("saved_tokens"))
    return chain.withColumnRenamed("pos", "depth").select(*_FIELDS, "ends_sha256"), sums


def prefix_trie(conversations: DataFrame, every: int = 20, most: int = 4, local: int = LOCAL) -> DataFrame:
    """The trie (see ``trie``) of conversations (conv_id, turn, role, text), rebuilt by ``rebuilt``.

    A null role or text is empty, a null turn number comes first, and rows without a conv_id go. Repeated rows are
    turns of their own. Texts of any length are hashed and counted whole. Other columns are not read.
    """
    turns = keep(ordered(conversations), "ordered")
    ids = keep(turns.select("conv").distinct(), "ids")
    return trie(rebuilt(turns, ids, every, most), ids, local)
