"""The prefix trie against a plain one."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from venuegrid.llm import queries, trie

SMALL = "/root/testdata/sf0.001"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain(rows, every=20, most=4):
    """Nodes of (conv_id, turn, role, text) rows."""
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()
            by[conv].append(((turn is not None, turn or 0), tie, (role, text)))
    by = {c: [x for _, _, x in sorted(t)] for c, t in by.items()}
    members = defaultdict(list)
    for c, own in by.items():
        h = zlib.crc32(str(c).encode()) % most
        turns = by.get(c - c % every, [])[:h] + own[h:]
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append((c, d == len(turns)))
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, saved, out = {}, {}, []
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[q] for q in children[p]) or 1
        own = (len(members[p]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        saved[p] = own + sum(saved[q] for q in children[p])
        ends = ",".join(map(str, sorted(c for c, end in members[p] if end)))
        least = min(c for c, _ in members[p])
        out.append((least, len(p), min(c for c, _ in members[p[:-1]]) if p else None, len(members[p]), len(children[p]), leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def rows(found):
    return sorted((tuple(r) for r in found.select(*COLUMNS).collect()), key=repr)


def test_query(spark):
    read = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert rows(queries.QUERIES["op12_prefix_trie"](spark, SMALL)) == plain(read)


@pytest.mark.parametrize("local", [2, 12, 10_000])
def test_recursion_copies_and_odd_rows(spark, monkeypatch, local):
    monkeypatch.setattr(trie, "SPAN", 3)
    rng = random.Random(local)
    made = [(c, t, rng.choice(["user", "bot"]), rng.choice(["a b", "c", ""])) for c in range(60) for t in range(rng.randrange(7))]
    made += [(100 + c, t, "user", f"x {t}") for c in range(12) for t in range(5)]  # copies, but for what the rebuilding does
    made += [(200, t, "user", f"long {t}") for t in range(40)] + [(220, t, "user", f"long {t}") for t in range(40)] + [(221, t, "user", f"long {t}") for t in range(39)]
    made += [(300, None, None, None), (300, None, "user", "z"), (300, 1, "user", None), (300, 1, "user", None), (None, 1, "user", "lost"), (319, 0, "user", "own"), (341, 0, "user", "turnless?")]
    made += [(400, 0, "u", "w " * 3000), (401, 5, "u", "  é \x1c")]
    frame = spark.createDataFrame([(*r, 7) for r in made], "conv_id long, turn long, role string, text string, depth int").repartition(3)
    assert rows(trie.prefix_trie(frame, local=local)) == plain(made)


def test_empty(spark):
    assert trie.prefix_trie(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0
    one = [(3, 0, "user", "a")]
    assert rows(trie.prefix_trie(spark.createDataFrame(one, "conv_id long, turn long, role string, text string"))) == plain(one)
