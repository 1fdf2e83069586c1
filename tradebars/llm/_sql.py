"""DuckDB SQL of the queries that SQL can say, over the registered tables."""

from __future__ import annotations

import string

_LOWER = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
_WORDS = r"'[^\x20\x09-\x0D]+'"


def jaccard_components(docs: str = "documents", suffix: str = "") -> str:
    """CTEs that end in groups(doc_id, n_shingles, component_id) of a relation with unique doc_id."""
    return f"""
w{suffix} AS (SELECT doc_id, regexp_extract_all({_LOWER}, {_WORDS}) AS ws FROM {docs}),
sh{suffix} AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN CAST([] AS VARCHAR[]) WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS s
  FROM w{suffix}),
sizes{suffix} AS (SELECT doc_id, count(*) AS n FROM sh{suffix} GROUP BY doc_id),
common{suffix} AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh{suffix} a JOIN sh{suffix} b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
links{suffix} AS (SELECT a, b FROM common{suffix} JOIN sizes{suffix} x ON x.doc_id = a JOIN sizes{suffix} y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
edges{suffix} AS (SELECT a, b FROM links{suffix} UNION ALL SELECT b, a FROM links{suffix}),
reach{suffix}(doc_id, other) AS (SELECT doc_id, doc_id FROM {docs} UNION SELECT r.doc_id, e.b FROM reach{suffix} r JOIN edges{suffix} e ON e.a = r.other),
groups{suffix} AS (
  SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, r.component_id
  FROM {docs} d LEFT JOIN sizes{suffix} s USING (doc_id) JOIN (SELECT doc_id, min(other) AS component_id FROM reach{suffix} GROUP BY 1) r USING (doc_id))"""


JACCARD = f"WITH RECURSIVE {jaccard_components()} SELECT doc_id, n_shingles, component_id FROM groups"


def _bucket(x: str) -> str:
    return f"CASE WHEN {x} < 1e-3 THEN 0 ELSE 1 + CAST(floor(ln(({x}) / 1e-3) / ln(1.02)) AS INT) END"


def quality(docs: str = "documents") -> str:
    """CTEs that end in judged(doc_id, counts, base_failed, kept)."""
    metrics = {"symbol_share": "n_symbols / greatest(word_chars, 1)", "word_length": "word_chars / greatest(n_words, 1)", "dup_line_share": "n_dup_lines / greatest(n_lines, 1)"}
    least = "CASE metric WHEN 'symbol_share' THEN 0.005 WHEN 'word_length' THEN 0.2 ELSE 0.02 END"
    tail = "CASE metric WHEN 'symbol_share' THEN 0.2 WHEN 'word_length' THEN 0.5 ELSE 3.0 END"
    spread = f"6.0 * greatest(q75 - q25, {least})"
    fence = {"low": f"q25 - {spread}", "high": f"q75 + greatest({spread}, {tail} * (q98 - q50))"}
    quartile = lambda q: f"min(CASE WHEN upto >= {q} * total THEN bucket END)"
    middle = lambda b: f"CASE WHEN {b} <= 0 THEN 0.0 ELSE 1e-3 * pow(1.02, {b} - 0.5) END"

    def level(name: str, keys: str) -> str:
        comma = f"{keys}, " if keys else ""
        return f"""
{name} AS (
  SELECT {comma}metric, max(total) AS total, {", ".join(f"{middle(quartile(q))} AS q{round(100 * q)}" for q in (0.25, 0.5, 0.75, 0.98))}
  FROM (SELECT {comma}metric, bucket, sum(n) OVER (PARTITION BY {comma}metric) AS total, sum(n) OVER (PARTITION BY {comma}metric ORDER BY bucket) AS upto
        FROM (SELECT {comma}metric, bucket, count(*) AS n FROM metered GROUP BY {comma}metric, bucket))
  GROUP BY {comma}metric)"""

    pick = lambda q: f"CASE WHEN a.total >= 200 THEN a.{q} WHEN b.total >= 200 THEN b.{q} ELSE c.{q} END AS {q}"
    beyond = {m: f"({x}) > f.{m}_high" + (f" OR ({x}) < f.{m}_low" if m == "word_length" else "") for m, x in metrics.items()}
    return f"""
q_words AS (SELECT doc_id, lang, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), {_WORDS}) AS ws FROM {docs}),
q_grams AS (SELECT doc_id, unnest(range(1, len(ws) - 6)) AS i, unnest(list_transform(range(1, len(ws) - 6), lambda i: array_to_string(ws[i:i + 7], ' '))) AS g FROM q_words WHERE len(ws) >= 8),
q_twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM q_grams) WHERE c > 1),
q_repeat AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM q_twice) GROUP BY doc_id),
q_lines AS (SELECT doc_id, CAST(sum(c - 1) AS BIGINT) AS n, CAST(sum(c) AS BIGINT) AS lines FROM (SELECT doc_id, line, count(*) AS c FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM q_words)
  WHERE regexp_matches(line, {_WORDS}) GROUP BY doc_id, line) GROUP BY doc_id),
counted AS (
  SELECT d.doc_id, lang, source, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, coalesce(l.n, 0) AS n_dup_lines, coalesce(l.lines, 0) AS n_lines, coalesce(r.n, 0) AS n_repeat_words
  FROM q_words d LEFT JOIN q_lines l USING (doc_id) LEFT JOIN q_repeat r USING (doc_id)),
passed AS (SELECT * FROM counted WHERE NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words)),
metered AS ({" UNION ALL ".join(f"SELECT lang, source, '{m}' AS metric, {_bucket(x)} AS bucket FROM passed" for m, x in metrics.items())}),
{level("own", "lang, source")}, {level("of_lang", "lang")}, {level("of_all", "")},
picked AS (SELECT a.lang, a.source, a.metric, {", ".join(pick(q) for q in ("q25", "q50", "q75", "q98"))}
  FROM own a JOIN of_lang b ON a.lang IS NOT DISTINCT FROM b.lang AND a.metric = b.metric JOIN of_all c ON a.metric = c.metric),
fences AS (SELECT lang, source, {", ".join(f"max(CASE WHEN metric = '{m}' THEN {fence[e]} END) AS {m}_{e}" for m in metrics for e in ("low", "high"))}
  FROM picked GROUP BY lang, source),
judged AS (
  SELECT c.*, (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed,
    NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND NOT coalesce({" OR ".join(beyond.values())}, false) AS kept
  FROM counted c LEFT JOIN fences f ON c.lang IS NOT DISTINCT FROM f.lang AND c.source IS NOT DISTINCT FROM f.source)"""


QUALITY = f"WITH {quality()} SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept FROM judged"


def resampling(docs: str = "documents", target: str = "benchmark") -> str:
    """CTEs that end in placed(doc_id, n_features, weight, score, rank); CRC-32 goes byte by byte through its table."""
    words = r"regexp_extract_all(" + _LOWER + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    step = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    table = "SELECT 0 AS k, range AS byte, range AS c FROM range(256) UNION ALL SELECT k + 1, byte, " + step + " FROM bits WHERE k < 8"
    hexes = "list_transform(range(0, octet_length(encode(w))), lambda i: CAST('0x' || substr(hex(encode(w)), 1 + 2 * CAST(i AS INT), 2) AS BIGINT))"
    return f"""
bits AS ({table}),
crc AS (SELECT list(c ORDER BY byte) AS t FROM bits WHERE k = 8),
r_docs AS (SELECT doc_id, unnest({words}) AS w FROM {docs}),
r_target AS (SELECT unnest({words}) AS w FROM {target}),
hashed AS (
  SELECT w, xor(list_reduce(list_prepend(4294967295, {hexes}), lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)])), 4294967295) % 10000 AS bucket
  FROM (SELECT w FROM r_docs UNION SELECT w FROM r_target), crc),
s_counts AS (SELECT bucket, count(*) AS n FROM r_docs JOIN hashed USING (w) GROUP BY bucket),
t_counts AS (SELECT bucket, count(*) AS n FROM r_target JOIN hashed USING (w) GROUP BY bucket),
sums AS (SELECT (SELECT coalesce(sum(n), 0) FROM s_counts) AS s, (SELECT coalesce(sum(n), 0) FROM t_counts) AS t),
gains AS (
  SELECT range AS bucket, CAST(floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * (sums.s + 10000)::DOUBLE / ((coalesce(s.n, 0) + 1)::DOUBLE * (sums.t + 10000)::DOUBLE))) AS BIGINT) AS gain
  FROM range(10000) LEFT JOIN s_counts s ON s.bucket = range LEFT JOIN t_counts t ON t.bucket = range, sums),
weights AS (
  SELECT d.doc_id, coalesce(x.n, 0) AS n_features, coalesce(CAST(floor(x.total / x.n) AS BIGINT), 0) AS weight
  FROM {docs} d LEFT JOIN (SELECT doc_id, count(*) AS n, sum(gain) AS total FROM r_docs JOIN hashed USING (w) JOIN gains USING (bucket) GROUP BY doc_id) x USING (doc_id)),
scored AS (
  SELECT *, weight + CAST(floor(-1000 * ln(-ln((CAST('0x' || left(sha256('2024:' || doc_id), 8) AS BIGINT) + 0.5) / 4294967296))) AS BIGINT) AS score FROM weights),
ordered AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, 10 * count(*) OVER () // 100 AS drawn FROM scored WHERE n_features >= 20),
placed AS (SELECT s.*, CASE WHEN o.rank <= o.drawn THEN o.rank END AS rank FROM scored s LEFT JOIN ordered o USING (doc_id))"""


RESAMPLING = f"WITH RECURSIVE {resampling()} SELECT doc_id, n_features, weight, score, rank FROM placed"

NEGATIVES = """
WITH v AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (SELECT a.id AS anchor_id, b.id AS other, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score FROM v a JOIN v b ON a.id % 100 = 0 AND a.id <> b.id),
positives AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM scores WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) AS INT) AS rank, other AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scores USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) <= 10"""
