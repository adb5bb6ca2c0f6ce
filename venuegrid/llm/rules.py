"""Document quality rules with DataFrame functions only.

Base rules count words, symbols, repeated lines and repeated 8-word windows. Documents that pass are compared
with their language: the Jensen-Shannon distance (base 2, square root of the divergence) between a document's
histogram of character classes, or of common words, and the mean histogram of all sufficiently long documents of
that language that pass the base rules.
"""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venuegrid.llm.common import free_names, keep

SPACES = "[ \\t-\\r]+"
WINDOW = 8
#: Fewest words for which a histogram of character classes, or of common words, is judged.
CHAR_WORDS, COMMON_WORDS = 40, 40
#: Greatest distances from the language reference; for common words that of FULL words or more.
CHAR_FAR, COMMON_FAR, FULL = 0.30, 0.25, 100
#: Character classes counted by pattern; a-z and all else in ASCII are what is left. Symbols are SYMBOLS, and
#: the classes from WIDE on (accented Latin letters, then other scripts and signs) lie outside ASCII.
CLASSES = ["[A-Z]", "[0-9]", "[.,;:!?'\"()-]", "[#*$%&|<>]", "[\u00C0-\u024F]", "[^\\x00-\\x7F\u00C0-\u024F]"]
SYMBOLS, WIDE = 3, 4
# Very common words of four languages.
COMMON = {
    "en": ["the", "of", "and", "to", "in", "a", "is", "that", "for", "it"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une"],
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich"],
    "es": ["de", "la", "que", "el", "en", "y", "a", "los", "se", "del"],
}


def _paired(column: str, step: int) -> Column:
    """Hash each element of an array of hashes with the one ``step`` places on."""
    left = F.greatest(F.size(column) - step, F.lit(0))
    return F.zip_with(F.slice(column, 1, left), F.slice(column, step + 1, left), lambda a, b: F.xxhash64(a, b))


def _repeat_words() -> Column:
    """Words covered by windows (column ``__h8``: their hashes in order) that occur twice or more."""
    tagged = F.array_sort(F.transform("__h8", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    # the sorted tags beside themselves shifted one place both ways: equal hashes are neighbours
    n = F.size("__h8")
    same = lambda s: F.filter(
        F.zip_with(
            F.zip_with(s, F.concat(F.array(F.lit(None).cast("long")), F.transform(F.slice(s, 1, n - 1), lambda x: x["h"])), lambda x, before: F.struct(x["i"].alias("i"), x["h"].alias("h"), before.alias("b"))),
            F.concat(F.transform(F.slice(s, 2, n - 1), lambda x: x["h"]), F.array(F.lit(None).cast("long"))),
            lambda x, after: F.when((x["h"] == x["b"]) | (x["h"] == after), x["i"]),
        ),
        lambda i: i.isNotNull(),
    )
    places = lambda p: F.aggregate(
        p, F.struct(F.lit(0).cast("long").alias("sum"), F.lit(-WINDOW).alias("last")), lambda acc, i: F.struct((acc["sum"] + F.least(F.lit(WINDOW), i - acc["last"])).cast("long").alias("sum"), i.alias("last")), lambda acc: acc["sum"]
    )
    let = lambda value, f: F.element_at(F.transform(F.array(value), f), 1)
    found = let(tagged, lambda s: let(F.array_sort(same(s)), places))
    return F.when(F.size(F.array_distinct("__h8")) < n, found).otherwise(F.lit(0)).cast("long")


def _one_of(words: list[str]):
    return lambda w: F.lower(w).isin(words)


def _seen(i: int, pattern: str) -> Column:
    """Characters of one class; a text of as many bytes as characters is ASCII and has none of the wide ones."""
    found = F.regexp_count("__t", F.lit(pattern))
    return found if i < WIDE else F.when(F.octet_length("__t") > F.char_length("__t"), found).otherwise(0)


def _counts(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"), text.alias("__t"))
    rows = rows.withColumn("__w", F.filter(F.split("__t", SPACES, -1), lambda w: w != ""))
    rows = rows.withColumn("__h1", F.transform("__w", lambda w: F.xxhash64(w)))
    for name, before, step in (("__h2", "__h1", 1), ("__h4", "__h2", 2), ("__h8", "__h4", 4)):
        rows = rows.withColumn(name, _paired(before, step))
    lines = F.filter(F.split("__t", "\n", -1), lambda x: x.rlike("[^ \\t-\\r]"))
    rows = rows.withColumn("__l", lines)
    common = listed = F.lit(None)
    for lang, words in COMMON.items():
        common = F.when(F.col("lang") == lang, F.filter("__w", _one_of(words))).otherwise(common)
        listed = F.when(F.col("lang") == lang, F.array(*map(F.lit, words))).otherwise(listed)
    rows = rows.withColumn("__c", F.transform(common, lambda w: F.lower(w)))
    seen = F.transform(listed, lambda w: F.size(F.filter("__c", lambda c: c == w)).cast("double"))
    word_chars = F.char_length(F.array_join("__w", ""))
    rows = rows.select(
        "doc_id", "lang", F.size("__w").cast("long").alias("n_words"), word_chars.cast("long").alias("word_chars"), *(_seen(i, p).cast("long").alias(f"__k{i}") for i, p in enumerate(CLASSES)),
        (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long").alias("n_dup_lines"), _repeat_words().alias("n_repeat_words"), F.char_length("__t").alias("__chars"), seen.alias("__seen"), F.size("__c").alias("__common"),
    )
    other = F.col("word_chars") - sum((F.col(f"__k{i}") for i in range(len(CLASSES))), F.lit(0))
    chars = F.array(*(F.col(f"__k{i}").cast("double") for i in range(len(CLASSES))), other.cast("double"))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return rows.select(
        "doc_id", "lang", "n_words", "word_chars", F.col(f"__k{SYMBOLS}").alias("n_symbols"), "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
        chars.alias("chars"), F.concat("__seen", F.array((F.col("n_words") - F.col("__common")).cast("double"))).alias("common"),
    )


def _shares(counts: str, least: int) -> Column:
    """A histogram as shares; null where the document has fewer than ``least`` words."""
    total = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)
    return F.when((F.col("n_words") >= least) & (total > 0), F.transform(counts, lambda x: x / total))


def _distance(p: str, q: str) -> Column:
    part = lambda a, b: F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(0.0)
    terms = F.zip_with(p, q, lambda a, b: (part(a, b) + part(b, a)) / 2)
    total = F.aggregate(terms, F.lit(0.0), lambda s, x: s + x)
    return F.when(total > 0, F.sqrt(total)).when(total.isNotNull(), 0.0)


def _limit(far: float) -> Column:
    """The greatest common-word distance by length: under FULL words it grows as sampling alone parts a histogram more.

    The divergence of n draws over k classes from their source is (k - 1) / (8 n ln 2) bits on average. Divergences
    add, so what a document has on average beyond one of FULL words joins the square of the limit.
    """
    free = len(COMMON["en"]) / (8 * log(2))
    return F.sqrt(F.lit(far * far) + F.greatest(F.lit(0.0), F.lit(free) / F.col("n_words") - F.lit(free / FULL)))


def judge(docs: DataFrame, char_far: float = CHAR_FAR, common_far: float = COMMON_FAR) -> DataFrame:
    """One row per row of docs (columns doc_id, lang, text): the base counts, both distances and ``kept``.

    Words are ``[^\\x20\\x09-\\x0D]+``. ``base_failed``: under 20 words, or over 30 % of the words inside repeated
    8-word windows. ``kept``: base rules passed and no judged distance over its limit (that of common words
    grows under FULL words, see ``_limit``); a distance is null, and
    not judged, under the minimum length or without a reference. Null and empty texts have no words and fail.
    A null lang is a language of its own, without common words. Repeated rows each get their row; other columns
    are not read; an empty table gives an empty result.
    """
    counts = keep(_counts(docs), "counts")
    shares = counts.withColumns({"chars": _shares("chars", CHAR_WORDS), "common": _shares("common", COMMON_WORDS)})
    sound = shares.where(~F.col("base_failed"))
    width = len(CLASSES) + 1, len(COMMON["en"]) + 1
    means = [F.array(*(F.avg(F.col(c)[i]) for i in range(n))).alias(f"of_{c}") for c, n in zip(("chars", "common"), width, strict=True)]
    references = sound.groupBy("lang").agg(*means)
    far = shares.join(references, "lang", "left").withColumns({"char_distance": _distance("chars", "of_chars"), "common_distance": _distance("common", "of_common")})
    odd = (F.coalesce("char_distance", F.lit(0.0)) > char_far) | (F.coalesce("common_distance", F.lit(0.0)) > _limit(common_far))
    return far.withColumn("kept", ~F.col("base_failed") & ~odd).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "char_distance", "common_distance"
    )


def keep_sound(docs: DataFrame) -> DataFrame:
    """The rows of docs that ``judge`` keeps, with all columns. Rows of equal id, lang and text share a verdict."""
    uid = F.xxhash64("doc_id", "lang", "text")
    named = docs.select(uid.alias("doc_id"), "lang", "text")
    (own,) = free_names(docs.columns, "__uid")
    kept = judge(named).where("kept").select(F.col("doc_id").alias(own)).distinct()
    return docs.withColumn(own, uid).join(kept, own, "left_semi").drop(own)
