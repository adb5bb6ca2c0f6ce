"""URL filtering by host and path rules and by a ratio of character language models, with DataFrame functions only.

URLs that a rule decides are the labelled ones: rejected where the rule blocks, accepted where it allows; a caller
may label them otherwise. Two variable-order Markov models over the characters of whole URLs are fitted to them.
A context is used in its full length of up to ORDER characters where it is common enough, else it backs off to a
shorter one; every context's distribution is blended with the shorter one's by Witten-Bell weights. URLs that no
rule decides are blocked when their log-likelihood difference per character reaches a threshold: the least, 0 or more,
that next to no accepted URL reaches of those that the models were not fitted to.

The contexts kept are the states of an automaton, so a URL is scored by one walk over its characters. A context
needs a CONTEXTS-th part (a parameter) of its model's characters to be kept, so there are at most CONTEXTS of each length and
class, however many URLs there are; the automaton goes into the plan as two literals, and scoring needs no shuffle.
"""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from venuegrid.llm.common import keep

#: Characters told apart; digits count as one character, 0 stands for any other and for what is before the start.
ALPHABET = "abcdefghijklmnopqrstuvwxyz0./-_:?=&#%+~@"
SIZE = len(ALPHABET) + 1
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Longest contexts, and the inverse of the share of its model's characters that a context needs.
ORDER, CONTEXTS = 4, 400
#: One in so many labelled URLs calibrates the threshold and teaches no model.
HELD_OUT = 5
#: Bins of a hundredth of a nat in which the threshold is calibrated, and the share of accepted URLs it may block.
BINS, WRONG = 2000, 0.01


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise("")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.regexp_extract(_after_scheme(url), "^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(_after_scheme(url), "^[^/?#]*([^?#]*)", 1)


def rule_of(rules: list[tuple[str, str]], host: Column, path: Column) -> tuple[Column, Column]:
    """(rule, verdict) of the longest of ``rules`` (verdict, rule) that fits; nulls if none does.

    A rule such as ``example.net/de/8`` fits its host and all subdomains if the path starts with its path.
    """
    rule = verdict = F.lit(None).cast("string")
    for says, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


def _codes(url: Column) -> Column:
    """Every character's number in ALPHABET from 1, or 0."""
    numbers = [0] * 128
    for i, c in enumerate(ALPHABET, 1):
        numbers[ord(c)] = numbers[ord(c.upper())] = i
    for c in "0123456789":
        numbers[ord(c)] = numbers[ord("0")]
    table = F.array(*map(F.lit, [*numbers, 0]))
    return F.transform(F.split(url, "(?!^)(?!$)"), lambda c: F.element_at(table, F.least(F.ascii(c), F.lit(128)) + 1))


def _grams(codes: str) -> Column:
    """The number of every character together with the ORDER before it."""
    padded = F.concat(F.array(*[F.lit(0)] * ORDER), codes)
    return F.transform(codes, lambda c, i: sum((F.element_at(padded, i + k + 1) * F.lit(SIZE ** (ORDER - k)) for k in range(ORDER)), c.cast("long")))


Counts = dict[tuple[int, ...], dict[int, int]]


def _counts(grams: DataFrame, contexts: int) -> tuple[Counts, Counts]:
    """Per class (accepted, rejected), how often each character follows each context that is common enough.

    grams: ``rejected``, ``gram``, ``n``. At most ``contexts`` contexts of each length and class, so a bounded number of
    rows, come to the driver.
    """
    found: tuple[Counts, Counts] = ({}, {})
    least = {r: -(-n // contexts) for r, n in grams.groupBy("rejected").agg(F.sum("n")).collect()}
    enough = F.when(F.col("rejected"), least.get(True, 0)).otherwise(least.get(False, 0))
    same = Window.partitionBy("rejected", "context")  # SIZE rows at most
    for order in range(ORDER + 1):
        by = grams.groupBy("rejected", (F.col("gram") % SIZE ** (order + 1)).alias("gram")).agg(F.sum("n").alias("n"))
        by = by.withColumn("context", F.floor(F.col("gram") / SIZE)).withColumn("of", F.sum("n").over(same))
        for rejected, gram, n in by.where(F.col("of") >= enough).select("rejected", "gram", "n").collect():
            number, after = divmod(gram, SIZE)
            context = tuple(number // SIZE ** (order - 1 - k) % SIZE for k in range(order))
            found[rejected].setdefault(context, {})[after] = n
    return found


def probability(counts: Counts, context: tuple[int, ...]) -> list[float]:
    """Witten-Bell: of every character after a context, blended with that after the context less its first character."""
    lower = probability(counts, context[1:]) if context else [1 / SIZE] * SIZE
    seen = counts.get(context)
    if not seen:
        return lower
    total, kinds = sum(seen.values()), len(seen)
    return [(seen.get(c, 0) + kinds * lower[c]) / (total + kinds) for c in range(SIZE)]


def automaton(accepted: Counts, rejected: Counts) -> tuple[list[int], list[float]]:
    """(next state, log p(rejected) - log p(accepted)) by state * SIZE + character; the walk starts in state 0."""
    kept = {()} | set(accepted) | set(rejected)
    kept = {c for c in kept if all(c[:k] in kept for k in range(len(c)))}  # a context is walked into through its beginnings
    states = [(), *sorted(kept - {()}, key=lambda c: (len(c), c))]
    number = {c: i for i, c in enumerate(states)}
    start = max((tuple([0] * k) for k in range(ORDER + 1) if tuple([0] * k) in number), key=len)
    order = [start, *(c for c in states if c != start)]
    number = {c: i for i, c in enumerate(order)}
    after, ratio = [], []
    for context in order:
        p, q = probability(rejected, context), probability(accepted, context)
        ratio += [log(a) - log(b) for a, b in zip(p, q, strict=True)]
        for c in range(SIZE):
            now = (*context, c)[-ORDER:]
            while now not in number:
                now = now[1:]
            after.append(number[now])
    return after, ratio


def _score(after: list[int], ratio: list[float], codes: str) -> Column:
    """The mean log ratio per character; 0 for no characters."""
    step = F.split(F.lit(" ".join(map(str, after))), " ").cast("array<int>")
    gain = F.split(F.lit(" ".join(f"{x:.5f}" for x in ratio)), " ").cast("array<double>")

    def walk(acc: Column, c: Column) -> Column:
        at = acc["state"] * SIZE + c + 1
        return F.struct(F.element_at(step, at).alias("state"), (acc["sum"] + F.element_at(gain, at)).alias("sum"))

    begin = F.struct(F.lit(0).alias("state"), F.lit(0.0).alias("sum"))
    return F.when(F.size(codes) > 0, F.aggregate(codes, begin, walk, lambda acc: acc["sum"]) / F.size(codes)).otherwise(0.0)


def threshold(bins: list[tuple[int, int]], share: float = WRONG) -> float:
    """The least score from which to block, 0 or more, so that at most ``share`` of the accepted URLs are blocked.

    bins: (bin of a hundredth, accepted) of held-out URLs; the topmost bin is open above.
    """
    room, cut = share * sum(n for _, n in bins), 0
    for b, n in sorted(bins, reverse=True):
        room -= n
        if room < 0:
            cut = b + 1
            break
    return max(cut, 0) / 100


def judge(pages: DataFrame, rules: list[tuple[str, str]], label: Column | None = None, contexts: int = CONTEXTS) -> DataFrame:
    """One row per row of pages (columns page_id, url): host, path, rule, verdict and score.

    The models see whole URLs, scheme, query and fragment included; rules see host and path only. ``label``, over the
    columns url, host and path, says ``block`` or ``allow`` of the URLs that teach the models (null: none); by default
    it is what the rules say. Each distinct URL teaches once; one in HELD_OUT calibrates instead. A context needs a
    ``contexts``-th part of its model's characters to be kept, others back off to shorter ones: that bounds the models.

    A URL under a rule gets the rule's verdict. Any other is blocked if its score reaches the calibrated threshold;
    without labelled URLs of both kinds none is. Null urls, urls without ``://`` and empty ones have an empty host and
    path and are allowed unless a rule says otherwise. Repeated rows each get their row; very long urls are scored
    whole; an empty table gives an empty result.
    """
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), url.alias("url"), host_of(url).alias("host"), path_of(url).alias("path"), _codes(url).alias("codes"))
    rule, verdict = rule_of(rules, F.col("host"), F.col("path"))
    rows = rows.withColumns({"rule": rule, "said": verdict}).withColumn("label", F.col("said") if label is None else label)
    # the characters' numbers are written, since counting and scoring both need them
    rows = keep(rows.select("page_id", "host", "path", "rule", "said", "label", F.when(F.col("url") != "", F.col("codes")).otherwise(F.array().cast("array<int>")).alias("codes"), F.xxhash64("url").alias("h")), "urls")
    taught = rows.where(F.col("label").isin("block", "allow")).groupBy("h").agg(F.min_by("codes", "label").alias("codes"), (F.max("label") == "block").alias("rejected"))
    teaching = F.pmod("h", F.lit(HELD_OUT)) > 0
    grams = taught.where(teaching).select("rejected", F.explode(_grams("codes")).alias("gram"))
    accepted, rejected = _counts(keep(grams.groupBy("rejected", "gram").agg(F.count("*").alias("n")), "grams"), contexts)
    if not accepted or not rejected:
        return rows.select("page_id", "host", "path", "rule", F.coalesce("said", F.lit("allow")).alias("verdict"), F.lit(0.0).alias("score"))
    walk = automaton(accepted, rejected)
    scored = keep(rows.withColumn("score", _score(*walk, "codes")).drop("codes"), "scored")
    hundredth = F.least(F.greatest(F.floor(F.col("score") * 100), F.lit(-BINS // 2)), F.lit(BINS // 2))
    held = scored.where((F.col("label") == "allow") & ~teaching).groupBy("h").agg(F.first("score").alias("score"))
    bins = held.groupBy(hundredth.alias("bin")).agg(F.count("*")).collect()  # BINS rows at most
    cut = threshold([tuple(b) for b in bins])
    own = F.when((F.col("host") != "") & (F.col("score") >= cut), "block").otherwise("allow")
    return scored.select("page_id", "host", "path", "rule", F.coalesce("said", own).alias("verdict"), "score")
