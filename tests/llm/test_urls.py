"""URL rules and character models against plain Python."""

import re
from collections import Counter, defaultdict
from math import log

from pyspark.sql import functions as F

from venuegrid.llm import queries, urls


def plain_parts(url):
    rest = url.partition("://")[2] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    return low, re.match(r"[^?#]*", rest[len(host) :])[0]


def plain_rule(rules, host, path):
    best = (None, None)
    for says, text in rules:
        name, slash, rest = text.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith(slash + rest) and len(text) > len(best[0] or ""):
            best = text, says
    return best


def plain_codes(url):
    place = {c: i for i, c in enumerate(urls.ALPHABET, 1)}
    return [place.get("0" if c in "0123456789" else c.lower() if c.isascii() else c, 0) for c in url]


def plain_probability(codes_of, total, context, c, contexts=urls.CONTEXTS):
    """Witten-Bell with contexts of a share of all characters, from the counts of every context of up to ORDER."""
    if context and sum(codes_of[context].values()) * contexts < total:
        return plain_probability(codes_of, total, context[1:], c, contexts)
    lower = plain_probability(codes_of, total, context[1:], c, contexts) if context else 1 / urls.SIZE
    seen = codes_of[context]
    return (seen[c] + len(seen) * lower) / (sum(seen.values()) + len(seen))


def plain_models(teaching):
    """Per class the counts after every context, and all characters; teaching: (rejected, url) of distinct URLs."""
    counts, totals = [defaultdict(Counter), defaultdict(Counter)], [0, 0]
    for rejected, url in teaching:
        codes = [0] * urls.ORDER + plain_codes(url)
        for i in range(urls.ORDER, len(codes)):
            totals[rejected] += 1
            for k in range(urls.ORDER + 1):
                counts[rejected][tuple(codes[i - k : i])][codes[i]] += 1
    return counts, totals


def plain_score(models, url):
    counts, totals = models
    codes, total = [0] * urls.ORDER + plain_codes(url), 0.0
    for i in range(urls.ORDER, len(codes)):
        context = tuple(codes[i - urls.ORDER : i])
        total += log(plain_probability(counts[1], totals[1], context, codes[i])) - log(plain_probability(counts[0], totals[0], context, codes[i]))
    return total / (len(codes) - urls.ORDER) if url else 0.0


def test_rules_and_edges(spark):
    said = [("block", "com/en/"), ("allow", "example.com/en/7"), ("block", "org/es/"), ("block", "casino-win.net/"), ("allow", "quiet-river.net/")]
    made = [
        (1, "http://A.Example.com/en/7?q#x"), (2, "https://example.com/en/8"), (3, "https://xcom/en/8"), (4, None), (5, "nothing"), (6, "x://Shop.ORG/es/1#en"), (7, "http://h?x/y"), (8, "http://"), (9, ""), (1, "http://A.Example.com/en/7?q#x"),
        (None, "http://é.日本.net/😀?ü"), (10, "http://h/" + "x" * 100_000), *((100 + k, f"https://www.casino-win.net/fr/{k}") for k in range(60)), *((200 + k, f"https://blog.quiet-river.net/fr/{k}") for k in range(90)),
        (300, "https://casino-wins.org/fr/1"), (301, "https://quiet-rivers.org/fr/1"), (302, "https://x.org/fr/?to=casino-win"), (303, "https://x.org/fr/?to=quiet-river"),
    ]
    df = spark.createDataFrame([(i, u, "h", "p", "c", 0.0) for i, u in made], "page_id long, url string, host string, html string, codes string, score double")
    rows = urls.judge(df, said).collect()
    assert Counter((r.page_id, r.host, r.path, r.rule) for r in rows) == Counter((i, *plain_parts(u), plain_rule(said, *plain_parts(u))[0]) for i, u in made)
    got = {r.page_id: r for r in rows}
    assert all(r.verdict == plain_rule(said, r.host, r.path)[1] for r in rows if r.rule)
    assert all(got[k].verdict == "allow" and got[k].host == "" for k in (4, 5, 8, 9))
    assert got[300].score > got[301].score and got[302].score > got[303].score
    taught = {r.page_id: r.verdict for r in urls.judge(df, said[3:]).collect()}
    assert (taught[300], taught[301]) == ("block", "allow")
    own = urls.judge(df, [], F.when(F.col("host").contains("casino"), "block").when(F.col("host").contains("quiet"), "allow"))
    assert {r.verdict for r in own.collect() if r.page_id in range(100, 160)} == {"block"}
    assert urls.judge(df.where("false"), said).count() == 0
    assert {r.verdict for r in urls.judge(df, []).collect()} == {"allow"}


def test_query_against_plain_python(spark):
    """Every rule, score and verdict of the registered query."""
    pages = [(r.page_id, r.url) for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "url").collect()]
    hashes = {r.url: r.h for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").selectExpr("url", "xxhash64(url) AS h").collect()}
    got = {r.page_id: r for r in queries.QUERIES["op6_url_filter"](spark, "/root/testdata/sf0.01").collect()}
    label = {u: plain_rule(queries.URL_RULES, *plain_parts(u))[1] for _, u in pages}
    labelled = [(says == "block", u) for u, says in label.items() if says]
    models = plain_models([x for x in labelled if hashes[x[1]] % urls.HELD_OUT])
    scores = {u: plain_score(models, u) for u in label}
    held = sorted((scores[u] for r, u in labelled if not r and not hashes[u] % urls.HELD_OUT), reverse=True)
    wrong = int(urls.WRONG * len(held))
    blocked = {u for i, u in pages if got[i].rule is None and got[i].verdict == "block"}
    others = {u for i, u in pages if got[i].rule is None and got[i].verdict == "allow"}
    for i, u in pages:
        assert (got[i].host, got[i].path) == plain_parts(u) and got[i].rule == plain_rule(queries.URL_RULES, got[i].host, got[i].path)[0]
        assert abs(got[i].score - scores[u]) < 1e-4
        assert got[i].rule is None or got[i].verdict == label[u]
    assert blocked and others and min(scores[u] for u in blocked) > max(scores[u] for u in others) - 1e-4
    cut = max(0.0, held[wrong])  # blocked is what reaches the next hundredth over the first accepted URL too many
    assert max(scores[u] for u in others) < cut + 0.0101 and min(scores[u] for u in blocked) > cut - 1e-4


def test_threshold():
    assert urls.threshold([(10, 90), (20, 9), (30, 1)], 0.01) == 0.21
    assert urls.threshold([(10, 90), (20, 10)], 0.1) == 0.11
    assert urls.threshold([(-30, 90), (-20, 10)], 0.01) == urls.threshold([]) == 0


def test_more_contexts_say_little_more(spark):
    """Held-out accepted URLs: what a model of ten times as many contexts adds in likelihood, and that judge takes the number."""
    pages = [r.url for r in spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select("url").distinct().collect() if r.url]
    allowed = sorted(u for u in pages if plain_rule(queries.URL_RULES, *plain_parts(u))[1] == "allow")
    counts, totals = plain_models((0, u) for k, u in enumerate(allowed) if k % 5)

    def likelihood(contexts):
        """Nats a character, over held-out URLs."""
        found = [log(plain_probability(counts[0], totals[0], tuple(codes[i - urls.ORDER : i]), codes[i], contexts)) for u in allowed[::50] for codes in [[0] * urls.ORDER + plain_codes(u)] for i in range(urls.ORDER, len(codes))]
        return sum(found) / len(found)

    usual, more = likelihood(urls.CONTEXTS), likelihood(10 * urls.CONTEXTS)
    print(usual, more)
    assert abs(more - usual) < 0.15
    df = spark.createDataFrame([(k, u) for k, u in enumerate(pages[:800])], "page_id long, url string")
    few, many = (urls.judge(df, queries.URL_RULES, contexts=n).select("page_id", "score").collect() for n in (20, 2000))
    assert len(few) == len(many) == 800 and {r.page_id: r.score for r in few} != {r.page_id: r.score for r in many}
