"""Cleaning and segmenting against hand-derived values and plain-Python forms."""

import random

import pytest
from pyspark.sql import functions as F

from venuegrid.functions import text


def one(spark, f, value):
    return spark.createDataFrame([(value,)], "t string").select(f(F.col("t"))).first()[0]


def test_links(spark):
    left = one(spark, text.remove_links, "This is a [link](http://example.com) and an ![image](http://example.com/img.png). [![a](b)](c) <http://x.y>")
    assert left == "This is a  and an .  "


@pytest.mark.parametrize(
    ("f", "given", "wanted"),
    [
        (text.collapse_newlines, "Line 1\n\n\n\nLine 2", "Line 1\n\nLine 2"),
        (text.drop_format_lines, "Hello\n---\nWorld", "Hello\nWorld"),
        (text.dedupe_lines, "Line 1\nLine 1\nLine 2\nLine 2", "Line 1\nLine 2"),
        (text.dedupe_lines, "A\n\nA\n\nB", "A\n\nB"),
        (text.replace_characters, "«a» b​c–d", '"a" bc-d'),
        (lambda c: text.replace_characters(c, {"\\n": " ", "  ": " ", "&nbsp;": " "}), "Hello&nbsp;world\\nThis is a test.", "Hello world This is a test."),
        (text.clean, "# [t](u)\n\nWelcome\nWelcome\n---\n", "Welcome"),
        (text.clean, None, None),
        (text.clean, "", ""),
    ],
)
def test_cleaning(spark, f, given, wanted):
    assert one(spark, f, given) == wanted


@pytest.mark.parametrize(("line", "kind"), [("", "empty"), ("a  b  c", "tabular"), (" x", "indented"), ("x", "paragraph"), ("\t", "empty")])
def test_kinds(spark, line, kind):
    assert one(spark, text.line_type, line) == kind


def test_dedupe_random(spark):
    rng = random.Random(1)
    given = ["\n".join(rng.choice(["", "a", "b", " a"]) for _ in range(rng.randint(0, 9))) for _ in range(300)]

    def plain(t):
        kept, last = [], ""
        for line in t.split("\n"):
            bare = line.strip()
            if not bare:
                if kept and kept[-1]:
                    kept.append("")
            elif bare != last:
                kept.append(line)
                last = bare
        while kept and not kept[-1]:
            kept.pop()
        return "\n".join(kept)

    rows = spark.createDataFrame(list(enumerate(given)), "i int, t string").select("i", text.dedupe_lines(F.col("t")).alias("x")).collect()
    assert {r.i: r.x for r in rows} == {i: plain(t) for i, t in enumerate(given)}


def test_blocks(spark):
    rows = spark.createDataFrame([(1, "a\nb\n\nc\n")], "doc_id int, text string")
    assert sorted((r.start_line, r.end_line, r.kind) for r in text.blocks(rows).collect()) == [(0, 1, "paragraph"), (3, 3, "paragraph")]


def test_ranges(spark):
    rows = spark.createDataFrame([(1, 0, 1), (1, 2, 3), (1, 5, 6)], "k int, start int, end int")
    assert sorted((r.start, r.end) for r in text.merge_ranges(rows, ["k"]).collect()) == [(0, 3), (5, 6)]


def test_chunks(spark):
    def plain(sizes, limit, overlap):
        done, held = [], []
        size = 0
        for i, s in enumerate(sizes):
            if size + s > limit and held:
                done.append(held)
                n = int(overlap / 100 * len(held))
                held = held[len(held) - n :] if n else []
                size = sum(sizes[k] for k in held)
            held = [*held, i]
            size += s
        return [*done, held] if held else done

    rng = random.Random(2)
    for limit, overlap in ((100, 15), (60, 50)):
        sizes = [[rng.randint(1, 40) for _ in range(rng.randint(0, 20))] for _ in range(50)]
        rows = spark.createDataFrame([(i, s) for i, s in enumerate(sizes)], "i int, s array<int>").select("i", text.chunks(F.col("s"), limit, overlap).alias("c")).collect()
        assert {r.i: [list(x) for x in r.c] for r in rows} == {i: plain(s, limit, overlap) for i, s in enumerate(sizes)}


def test_relevant(spark):
    chunks = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], "i int, vector array<double>")
    phrases = spark.createDataFrame([([0.9, 0.1],)], "vector array<double>")
    assert [r.i for r in text.relevant_chunks(chunks, phrases, 0.5).collect()] == [1]
    assert text.relevant_chunks(chunks, phrases.where("false"), 0.5).count() == 0
