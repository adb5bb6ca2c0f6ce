"""DuckDB SQL of the corpus queries that SQL can express."""

from __future__ import annotations

from math import log

from venuegrid.llm import licences, rules

TOPK = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS c FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, o.vec_id, CAST(list_inner_product(CAST(q.c AS DOUBLE[]), CAST(o.c AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v o ON q.vec_id <> o.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20"""


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _canonical(lower: str) -> str:
    """SQL of a lower-cased text's canonical form."""
    form = rf"trim(regexp_replace({lower}, '[^\p{{L}}\p{{N}}]+', ' ', 'g'))"
    for said, meant in licences.SPELLINGS.items():
        form = rf"regexp_replace({form}, '\b{said}\b', '{meant}', 'g')"
    return form


def licence_scan() -> str:
    """Digests, licences by whole text, and notices by line."""
    texts = ", ".join(f"({_text(name)}, {_text(text)})" for name, text in licences.TEXTS.items())
    digests = ", ".join(f"({_text(name)}, {_text(digest)})" for name, digest in licences.DIGESTS.items())
    notices = ", ".join(f"({_text(name)}, {_text(text)})" for name, listed in licences.NOTICES.items() for text in listed)
    body = f"regexp_replace(regexp_replace(regexp_replace(lower(text), {_text(licences._HEAD)}, ''), {_text(licences._COPYRIGHT)}, ' ', 'g'), {_text(licences._ITEMS)}, ' ', 'g')"
    whole = f"regexp_replace({_canonical(body)}, {_text(licences._NAMED)}, {_text(licences._ANYBODY)}, 'g')"
    return rf"""
WITH k AS (SELECT min(license) AS license, digest FROM (
    SELECT col0 AS license, sha256({whole.replace("lower(text)", "lower(col1)")}) AS digest FROM (VALUES {texts}) UNION ALL SELECT col0, col1 FROM (VALUES {digests})) GROUP BY digest),
n AS (SELECT col0 AS name, {_canonical("lower(col1)")} AS form FROM (VALUES {notices})),
l AS (SELECT doc_id, unnest(string_split(lower(text), chr(10))) AS line FROM documents),
f AS (SELECT doc_id, {_canonical("line")} AS form FROM l WHERE regexp_matches(line, 'licen[cs]e|\bcc\b|cc0|public|mozilla|released|permission|copyright')),
s AS (SELECT doc_id, list_sort(list_distinct(list(name))) AS notices FROM f JOIN n ON f.form = n.form GROUP BY 1),
d AS (SELECT doc_id, sha256({whole}) AS digest FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents))
SELECT d.doc_id, d.digest, k.license, coalesce(s.notices, []) AS notices FROM d LEFT JOIN k ON d.digest = k.digest LEFT JOIN s ON d.doc_id = s.doc_id"""


def quality_rules() -> str:
    """Base counts, both distances (to six places) and the verdict."""
    word = r"'[^\x20\x09-\x0D]+'"
    classes = [f"len(regexp_extract_all(t, {_text(p)}))" for p in rules.CLASSES]
    listed = " ".join(f"WHEN {_text(lang)} THEN [{', '.join(map(_text, words))}]" for lang, words in rules.COMMON.items())
    free = len(rules.COMMON["en"]) / (8 * log(2))
    distance = lambda p, q: (
        f"sqrt(list_sum(list_transform(list_zip({p}, {q}), lambda z: (CASE WHEN z[1] > 0 THEN z[1] * log2(2 * z[1] / (z[1] + z[2])) ELSE 0 END + CASE WHEN z[2] > 0 THEN z[2] * log2(2 * z[2] / (z[1] + z[2])) ELSE 0 END) / 2)))"
    )
    means = lambda c, n: ", ".join(f"avg({c}[{i}])" for i in range(1, n + 1))
    return rf"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS lang, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, {word}) AS w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, {word})) AS lines FROM d),
g AS (SELECT doc_id, i, list_slice(w, i, i + {rules.WINDOW - 1}) AS gram FROM w, unnest(range(1, len(w) - {rules.WINDOW - 2})) u(i)),
r AS (SELECT doc_id, unnest(range(i, i + {rules.WINDOW})) AS place FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM g) WHERE n > 1),
a AS (SELECT doc_id, count(DISTINCT place) AS again FROM r GROUP BY 1),
c AS (SELECT w.*, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS word_chars, {classes[rules.SYMBOLS]} AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
  coalesce(again, 0) AS n_repeat_words, [{", ".join(classes)}] AS k, CASE lang {listed} END AS known FROM w LEFT JOIN a ON w.doc_id = a.doc_id),
s AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed, CASE WHEN n_words >= {rules.CHAR_WORDS} THEN list_transform(list_append(k, word_chars - list_sum(k)), lambda x: x / word_chars) END AS chars,
  CASE WHEN n_words >= {rules.COMMON_WORDS} AND known IS NOT NULL THEN list_transform(known, lambda x: len(list_filter(w, lambda y: lower(y) = x))) END AS hits FROM c),
p AS (SELECT *, list_transform(list_append(hits, n_words - list_sum(hits)), lambda x: x / n_words) AS common FROM s),
m AS (SELECT lang, [{means("chars", len(rules.CLASSES) + 1)}] AS of_chars, [{means("common", len(rules.COMMON["en"]) + 1)}] AS of_common FROM p WHERE NOT base_failed GROUP BY 1),
j AS (SELECT p.*, CASE WHEN chars IS NOT NULL AND of_chars[1] IS NOT NULL THEN {distance("chars", "of_chars")} END AS cd, CASE WHEN common IS NOT NULL AND of_common[1] IS NOT NULL THEN {distance("common", "of_common")} END AS md
  FROM p LEFT JOIN m ON p.lang = m.lang)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
NOT base_failed AND NOT (coalesce(cd, 0) > {rules.CHAR_FAR} OR coalesce(md, 0) > sqrt({rules.COMMON_FAR**2} + greatest(0.0, {free} / n_words - {free / rules.FULL}))) AS kept, round(cd, 6) AS char_distance, round(md, 6) AS common_distance FROM j"""
