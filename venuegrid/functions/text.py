"""Cleaning and segmenting of page text, as Column expressions."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from venuegrid.operators.scan import ISLAND, islands

# Characters replaced in page text.
CHARACTERS = {
    "«": '"', "»": '"', "“": '"', "”": '"', "‘": "'", "’": "'", "–": "-", "—": "-",
    "\u00a0": " ", "\u2009": " ", "\u200b": "", "*": " ", "_": " ", "`": " ", "+": " ", "\\": " ",
}
#: Numbers in the vectors of all reference phrases at most: 32 MB in each task.
PHRASES = 4 << 20
# What the parts of links look like: a text in brackets, and a target in parentheses, which may have a quoted title.
_TEXT, _TARGET = r"\[[^\]]*\]", r"\([^)]*\)"
_LINKS = [rf"\[!{_TEXT}{_TARGET}\]{_TARGET}", rf"!{_TEXT}{_TARGET}", rf"{_TEXT}{_TARGET}", r"<https?://[^>]+>"]
#: Characters that mark up and say nothing by themselves.
_MARKS = " \t\x0B\f\r#-\"=_([]).\u001c\u001d\u001e\u001f"


def let(value: Column, body) -> Column:
    """body(value) with value evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def strip(text: Column) -> Column:
    """Without white space at either end."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def remove_links(text: Column) -> Column:
    """Linked images, images, links and bare links go, their text too."""
    for pattern in _LINKS:
        text = F.regexp_replace(text, pattern, "")
    return text


def drop_format_lines(text: Column) -> Column:
    """Lines made of formatting characters go; empty lines stay."""
    lines = F.filter(F.split(text, "\n", -1), lambda x: (x == "") | (F.translate(x, _MARKS, "") != ""))
    return F.array_join(lines, "\n")


def replace_characters(text: Column, table: dict[str, str] = CHARACTERS) -> Column:
    """Replace by ``table``; longer keys take three ordered passes, single characters one translation."""
    if all(len(k) == 1 and len(v) <= 1 for k, v in table.items()) and not set(table) & set(table.values()):
        kept = {k: v for k, v in table.items() if v}
        return F.translate(text, "".join([*kept, *(k for k, v in table.items() if not v)]), "".join(kept.values()))
    for _ in range(3):
        for key, value in table.items():
            text = F.replace(text, F.lit(key), F.lit(value))
    return text


def collapse_newlines(text: Column) -> Column:
    """Three or more line ends become two."""
    return F.regexp_replace(text, r"(\r\n|\n|\r){3,}", "\n\n")


def dedupe_lines(text: Column) -> Column:
    """A line equal to the last non-blank one goes; at most one blank stays between lines, none at the ends.

    Non-blank lines carry their place among all lines and among each other: between two that stay there was a blank
    line where the one grew by more than the other. Every line is looked at a bounded number of times.
    """
    tagged = F.transform(F.split(text, "\n", -1), lambda x, i: F.struct(i.alias("i"), strip(x).alias("bare"), x.alias("line")))
    said = let(tagged, lambda all_: F.filter(all_, lambda x: x["bare"] != ""))
    numbered = F.transform(said, lambda x, o: F.struct(x["i"].alias("i"), o.alias("o"), x["bare"].alias("bare"), x["line"].alias("line")))
    stay = let(numbered, lambda all_: F.filter(all_, lambda x, o: (o == 0) | (x["bare"] != F.get(all_, o - 1)["bare"])))

    def shown(left: Column) -> Column:
        gap = lambda x, k: (x["i"] - F.get(left, k - 1)["i"]) > (x["o"] - F.get(left, k - 1)["o"])
        return F.array_join(F.transform(left, lambda x, k: F.when((k > 0) & gap(x, k), F.concat(F.lit("\n"), x["line"])).otherwise(x["line"])), "\n")

    return let(stay, shown)


def clean(text: Column, table: dict[str, str] = CHARACTERS) -> Column:
    """Links, format-only lines, characters, newlines, repeated lines, outer space: in this order."""
    return strip(dedupe_lines(collapse_newlines(replace_characters(drop_format_lines(remove_links(text)), table))))


def line_type(line: Column) -> Column:
    """empty, tabular (two or more runs of two or more white spaces), indented or paragraph."""
    return (
        F.when(strip(line) == "", "empty")
        .when(F.regexp_count(line, F.lit(r"\s{2,}")) >= 2, "tabular")
        .when(line.rlike(r"^[ \t]"), "indented")
        .otherwise("paragraph")
    )


def lines(rows: DataFrame, text: str = "text", keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per line: the keys, ``i`` from 0, ``line`` and ``kind``."""
    return rows.select(*keys, F.posexplode(F.split(text, "\n", -1)).alias("i", "line")).withColumn("kind", line_type(F.col("line")))


def block_array(text: Column) -> Column:
    """Maximal runs of neighbouring non-blank lines of one kind: an array of start_line, end_line, kind and content."""
    tagged = lambda t: F.transform(F.split(t, "\n", -1), lambda x, i: F.struct(i.cast("int").alias("i"), line_type(x).alias("kind"), x.alias("line")))

    def found(lines_: Column) -> Column:
        differs = lambda x, i: F.coalesce(F.get(lines_, i)["kind"] != x["kind"], F.lit(True))
        said = lambda x: x["kind"] != "empty"
        firsts = F.filter(lines_, lambda x, i: said(x) & differs(x, i - 1))
        lasts = F.filter(lines_, lambda x, i: said(x) & differs(x, i + 1))
        content = lambda a, b: F.array_join(F.transform(F.slice(lines_, a["i"] + 1, b["i"] - a["i"] + 1), lambda x: x["line"]), "\n")
        return F.zip_with(firsts, lasts, lambda a, b: F.struct(a["i"].alias("start_line"), b["i"].alias("end_line"), a["kind"].alias("kind"), content(a, b).alias("content")))

    return let(tagged(text), found)


def blocks(rows: DataFrame, text: str = "text", keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per block (see ``block_array``): the keys, start_line, end_line, kind, content. Nothing is shuffled."""
    return rows.select(*keys, F.inline(block_array(F.col(text))))


def merge_ranges(rows: DataFrame, keys: list[str], start: str = "start", end: str = "end", gap: int = 1) -> DataFrame:
    """Union of closed ranges per key; ranges at most ``gap`` apart become one. A key with many ranges is cut into buckets."""
    found = islands(rows.select(*keys, start, end), keys, [start, end], F.col(end), lambda far: F.col(start) > far + gap)
    return found.groupBy(*keys, ISLAND).agg(F.min(start).alias(start), F.max(end).alias(end)).drop(ISLAND)


def merge_spans(spans: Column, gap: int = 1) -> Column:
    """Union of one row's closed spans, structs of start and end that both grow from one to the next, as in ``merge_ranges``."""

    def joined(of: Column) -> Column:
        firsts = F.filter(of, lambda x, i: F.coalesce(x["start"] > F.get(of, i - 1)["end"] + gap, F.lit(True)))
        lasts = F.filter(of, lambda x, i: F.coalesce(F.get(of, i + 1)["start"] > x["end"] + gap, F.lit(True)))
        return F.zip_with(firsts, lasts, lambda a, b: F.struct(a["start"].alias("start"), b["end"].alias("end")))

    return let(spans, joined)


def widen_spans(spans: Column, around: int, last: Column) -> Column:
    """Spans with ``around`` more on both sides, between 0 and ``last``."""
    return F.transform(spans, lambda x: F.struct(F.greatest(F.lit(0), x["start"] - around).alias("start"), F.least(last, x["end"] + around).alias("end")))


def chunks(sizes: Column, chunk_size: int = 100, overlap: int = 15) -> Column:
    """Greedy packing of block sizes: arrays of block numbers; a full chunk hands its last share of blocks on.

    Chunks are runs of neighbouring blocks, so a pass over the sizes that keeps where the open one begins is enough.
    """
    most, share = chunk_size or 100, overlap or 15

    @pandas_udf("array<struct<first: int, last: int>>")
    def runs(of: pd.Series) -> pd.Series:
        def one(found) -> list[tuple[int, int]]:
            out, first, held = [], 0, 0
            for i, size in enumerate(found if found is not None else ()):
                if held + size > most and i > first:
                    out.append((first, i - 1))
                    kept = int(share / 100 * (i - first))
                    first = i - kept
                    held = int(sum(found[first:i]))
                held += int(size)
            return [*out, (first, len(found) - 1)] if found is not None and len(found) else []

        return of.map(one)

    return F.transform(runs(sizes), lambda r: F.sequence(r["first"], r["last"]))


def dot(a: Column, b: Column) -> Column:
    """Inner product in double."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def relevant_chunks(chunked: DataFrame, phrases: DataFrame, threshold: float, vector: str = "vector") -> DataFrame:
    """Chunks whose greatest dot product with any phrase vector reaches the threshold, with ``similarity``.

    phrases is a stated list, whose vectors go to every task as one matrix of PHRASES numbers at most (else ValueError);
    a batch of chunks is compared with all of them by one matrix product. A null vector, or one of another length than
    the phrases', is near none.
    """
    size = F.sum(F.size("vector")).alias("n")
    if (phrases.select("vector").agg(size).first().n or 0) > PHRASES:
        raise ValueError(f"phrase vectors of more than {PHRASES} numbers")
    listed = [np.array(r.vector, float) for r in phrases.select("vector").where("vector IS NOT NULL").collect()]
    if not listed:
        return chunked.withColumn("similarity", F.lit(None).cast("double")).where(F.lit(False))
    matrix = np.stack(listed)

    @pandas_udf("double")
    def best(of: pd.Series) -> pd.Series:
        fits = of.map(lambda v: v is not None and len(v) == matrix.shape[1])
        out = pd.Series(np.nan, index=of.index)
        if fits.any():
            out[fits] = (np.stack(of[fits].to_numpy()).astype(float) @ matrix.T).max(axis=1)
        return out

    return chunked.withColumn("similarity", best(F.col(vector).cast("array<double>"))).where(F.col("similarity") >= threshold)


def phrase_list(text: str) -> list[str]:
    """Reference phrases of a setting: cut at ``;;``, without outer space and empty ones."""
    return [p.strip() for p in text.split(";;") if p.strip()]


def filter_pages(
    rows: DataFrame, phrases: DataFrame, embed, key: str = "doc_id", text: str = "text", least: int = 0, chunk_size: int = 100, overlap: int = 15, threshold: float = 0.0, around: int = 1
) -> DataFrame:
    """``key`` and ``filtered``: of each text the parts near the reference phrases, with ``around`` lines on both sides.

    Texts shorter than ``least`` stay as they are. Lines form blocks, blocks chunks; ``embed`` turns a chunk's content
    into a vector, and the lines of chunks like any phrase (vectors in ``phrases``) are merged, widened and merged
    again; parts are joined by a blank line. A text without such a chunk, blocks or any text gives an empty one. Keys
    are to be unique.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = rows.select(key, body.alias("__text"))
    long = rows.where(F.length("__text") >= least)
    found = long.select(key, block_array(F.col("__text")).alias("blocks"))
    found = found.withColumn("chunks", chunks(F.transform("blocks", lambda b: F.length(b["content"])), chunk_size, overlap))
    # an outer explode: for an inner one the optimiser infers a filter on the chunks, which no Python function may be part of
    chunked = found.select(key, "blocks", F.explode_outer("chunks").alias("of")).where("of IS NOT NULL")
    at = lambda i: F.get("blocks", i)
    chunked = chunked.select(key, F.array_join(F.transform("of", lambda i: at(i)["content"]), "\n").alias("content"), F.transform("of", lambda i: F.struct(at(i)["start_line"].alias("start"), at(i)["end_line"].alias("end"))).alias("lines"))
    near = relevant_chunks(chunked.where(strip(F.col("content")) != "").withColumn("vector", embed("content")), phrases, threshold)
    spans = near.groupBy(key).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("lines")))).alias("spans"))
    lines_ = F.split("__text", "\n", -1)
    joined = long.join(spans, key, "left").select(key, "spans", lines_.alias("lines"))
    parts = merge_spans(widen_spans(merge_spans(F.col("spans")), around, F.size("lines") - 1))
    part = lambda p: F.array_join(F.slice("lines", p["start"] + 1, p["end"] - p["start"] + 1), "\n")
    kept = joined.select(key, F.coalesce(F.array_join(F.transform(parts, part), "\n\n"), F.lit("")).alias("filtered"))
    return kept.unionByName(rows.where(F.length("__text") < least).select(key, F.col("__text").alias("filtered")))


def preview(text: Column, most: int) -> Column:
    """The first ``most`` characters, and dots where there are more."""
    return F.when(F.length(text) > most, F.concat(F.substring(text, 1, most), F.lit("..."))).otherwise(text)


def payload(text: Column) -> Column:
    """Base64 of JSON: of the text itself if it is JSON, else of the text as a JSON string; null for null."""
    quoted = F.regexp_replace(F.to_json(F.struct(text.alias("t"))), r'^\{"t":|\}$', "")
    return F.base64(F.encode(F.when(F.try_parse_json(text).isNotNull(), text).otherwise(quoted), "UTF-8"))


def replaced_characters(text: Column, table: dict[str, str] = CHARACTERS) -> Column:
    """How many characters of ``table`` a text has once links and marks are gone."""
    kinds = "".join(k for k in table if len(k) == 1)
    return let(drop_format_lines(remove_links(F.coalesce(text, F.lit("")))), lambda body: F.length(body) - F.length(F.translate(body, kinds, "")))


def cleaning_counters(rows: DataFrame, before: str, after: str, table: dict[str, str] = CHARACTERS) -> DataFrame:
    """Texts processed, texts cleaned to something, and characters of ``table`` that were in the texts without links and marks."""
    replaced = replaced_characters(F.col(before), table)
    return rows.agg(
        F.count_if(F.col(before) != "").cast("long").alias("texts_processed"), F.count_if((F.col(before) != "") & (F.col(after) != "")).cast("long").alias("texts_successful"), F.coalesce(F.sum(replaced), F.lit(0)).cast("long").alias("chars_replaced"),
    )


def valid_url(url: Column) -> Column:
    """Whether a URL has a scheme and a host."""
    return F.coalesce(url.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+"), F.lit(False))


def file_name(url: Column) -> Column:
    """What follows the last slash of a URL's path."""
    return F.regexp_extract(F.regexp_replace(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", ""), r"([^/?#]*)(?:[?#].*)?$", 1)
