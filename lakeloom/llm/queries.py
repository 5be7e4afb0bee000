"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lakeloom.tables import load

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@_query
def op10_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakeloom.llm.mixing import mix_report

    return mix_report(load(spark, sf_dir, "documents"))


@_query
def op2_repair_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakeloom.llm import repair
    from lakeloom.session import scratch_path

    path = scratch_path(spark, "repair")
    repair.write(load(spark, sf_dir, "documents"), path)
    return repair.read(spark, path)


@_query
def op7_kk_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakeloom.llm.packing import pack

    return pack(load(spark, sf_dir, "documents"))


@_query
def op1_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakeloom.llm.simhash import near_duplicates

    return near_duplicates(load(spark, sf_dir, "documents"))


@_query
def op5_toxicity_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakeloom.llm import toxicity

    docs = load(spark, sf_dir, "documents")
    return toxicity.scores(docs, toxicity.train(docs, load(spark, sf_dir, "labels")))


@_query
def op6_line_cleaning(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakeloom.llm.lines import judge

    return judge(load(spark, sf_dir, "documents"))


@_query
def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakeloom.llm.licenses import scan

    return scan(load(spark, sf_dir, "documents"))


@_query
def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakeloom.llm.substrings import report

    return report(load(spark, sf_dir, "documents"))


@_query
def op9_dual_tree_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakeloom.llm.covertree import top_k

    return top_k(load(spark, sf_dir, "embeddings"))


ORACLES["op9_dual_tree_topk"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
  SELECT q.vec_id AS query_id, d.vec_id,
         CAST(list_sum(list_transform(list_zip(q.e, d.e), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v q JOIN v d ON q.vec_id <> d.vec_id AND len(q.e) = len(d.e)
  WHERE q.vec_id % 100 = 0
),
r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank,
         vec_id, score
  FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""


@_query
def op3_cross_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target: the documents marked as good quality, outside the held-out fold."""
    from lakeloom.llm import xent

    labels = load(spark, sf_dir, "labels").where("quality = 1")
    return xent.score(load(spark, sf_dir, "documents"), labels.where(xent.training_fold(labels["doc_id"])))


ORACLES["op4_substring_dedup"] = r"""
WITH w AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
),
k AS (
  SELECT doc_id, s, array_to_string(ws[s + 1:s + 20], ' ') AS k
  FROM (SELECT doc_id, ws, unnest(range(0, greatest(len(ws) - 19, 0))) AS s FROM w)
),
again AS (
  SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY k ORDER BY doc_id, s) AS n FROM k)
  WHERE n > 1
),
gone AS MATERIALIZED (SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS p FROM again),
kept AS (
  SELECT x.doc_id, string_agg(x.word, ' ' ORDER BY x.p) AS text, count(*) AS n
  FROM (SELECT doc_id, unnest(ws) AS word, unnest(range(0, len(ws))) AS p FROM w) x
  ANTI JOIN gone g ON x.doc_id = g.doc_id AND x.p = g.p
  GROUP BY x.doc_id
)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN kept ON w.doc_id = kept.doc_id
"""


def _license_sql() -> str:
    from lakeloom.llm.licenses import PHRASES, STRETCH, TEMPLATES, THRESHOLD

    values = lambda rows: ", ".join(f"('{label}', '{text}')" for label, text in rows)
    return rf"""
WITH w AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
),
phrases AS (SELECT label, string_split(phrase, ' ') AS ps FROM (VALUES {values((b, a) for a, b in PHRASES)}) t(label, phrase)),
places AS (
  SELECT doc_id, s, label
  FROM (SELECT doc_id, ws, unnest(range(0, len(ws))) AS s FROM w) x JOIN phrases p ON ws[s + 1] = ps[1]
  WHERE ws[s + 1:s + len(ps)] = ps
),
base AS (
  SELECT doc_id, count(*) AS n_base, min(s) AS first_word, max(s) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels
  FROM places GROUP BY doc_id
),
templates AS (
  SELECT label, list_distinct(string_split(t, ' ')) AS ts, {STRETCH} * len(string_split(t, ' ')) AS width
  FROM (VALUES {values(TEMPLATES)}) t(label, t)
),
able AS (
  SELECT doc_id, ws, label, ts, width FROM (SELECT *, list_distinct(ws) AS own FROM w) d, templates
  WHERE len(list_intersect(own, ts)) >= {THRESHOLD - 1e-9!r} * len(ts)
),
noticed AS (
  SELECT doc_id, label, max(CAST(len(list_intersect(list_distinct(ws[s + 1:s + width]), ts)) AS DOUBLE) / len(ts)) AS share
  FROM (SELECT *, unnest(range(0, len(ws))) AS s FROM able) GROUP BY doc_id, label HAVING share >= {THRESHOLD - 1e-9!r}
),
every AS (
  SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS best
  FROM (SELECT doc_id, label, share FROM noticed UNION ALL SELECT doc_id, label, 1.0 FROM places)
  GROUP BY doc_id
)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(best, 0.0) AS score
FROM w LEFT JOIN base ON w.doc_id = base.doc_id LEFT JOIN every ON w.doc_id = every.doc_id
"""


ORACLES["op8_license_scan"] = _license_sql()


@_query
def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakeloom.llm.secretscan import scan

    return scan(load(spark, sf_dir, "documents"))


def _secret_sql() -> str:
    """The same rules as regular expressions: a text's pieces between matches
    and the matches alternate, so their lengths add up to the places."""
    import re

    from lakeloom.llm.secretscan import ADDED, BASE

    parts = []
    for k, r in enumerate(BASE + ADDED):
        head = re.sub(r"\((?!\?)", "(?:", r.head).replace("'", "''")
        value = re.sub(r"\((?!\?)", "(?:", r.value)
        if r.any_case:  # the ASCII letters alone: other alphabets' look-alikes do not count
            head = re.sub(r"(?<![\\x0-9])[a-z]", lambda m: f"[{m[0].upper()}{m[0]}]", head)
        pattern = f"{head}({value})"
        parts.append(f"""
  SELECT doc_id, {k} AS k, '{r.kind}' AS kind, {r.least} AS least, string_split_regex(t, '{pattern}') AS between,
    regexp_extract_all(t, '{pattern}', 0) AS hit, regexp_extract_all(t, '{pattern}', 1) AS val FROM d""")
    return f"""
WITH d AS MATERIALIZED (SELECT doc_id, coalesce(text, '') AS t FROM documents),
found AS ({" UNION ALL ".join(parts)}
),
each AS (SELECT *, unnest(range(1, len(hit) + 1)) AS i FROM found),
spans AS (
  SELECT doc_id, k, kind, s, s + length(hit[i]) AS e
  FROM (SELECT *, CAST(list_sum(list_transform(between[1:i], lambda x: length(x)))
               + coalesce(list_sum(list_transform(hit[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS s FROM each)
  WHERE length(val[i]) >= least
),
per AS (
  SELECT doc_id, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k) FILTER (k < {len(BASE)}) AS base,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k) AS spans
  FROM spans GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN per ON d.doc_id = per.doc_id
"""


ORACLES["op11_secret_scan"] = _secret_sql()


@_query
def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakeloom.llm.lexical import rank

    return rank(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


ORACLES["op12_lexical_search"] = r"""
WITH w AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents
),
q AS MATERIALIZED (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
),
c AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(len(ws)) AS BIGINT) AS total FROM w WHERE len(ws) > 0),
tf AS MATERIALIZED (
  SELECT r, doc_id, n, term, CAST(count(*) AS BIGINT) AS tf
  FROM (SELECT r, doc_id, CAST(len(ws) AS BIGINT) AS n, unnest(ws) AS term FROM w)
  WHERE term IN (SELECT term FROM q) GROUP BY ALL
),
weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS weight
  FROM tf, c GROUP BY term, docs
),
s AS (
  SELECT q.item_id, tf.r, tf.doc_id,
    CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // total)))) AS BIGINT) AS score
  FROM q JOIN tf ON q.term = tf.term JOIN weights ON weights.term = tf.term, c
  GROUP BY q.item_id, tf.r, tf.doc_id
),
k AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank, doc_id, score
  FROM s WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 10
"""


@_query
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakeloom.llm.phrases import collocations

    return collocations(load(spark, sf_dir, "documents"))


ORACLES["op13_collocations"] = r"""
WITH p AS MATERIALIZED (
  SELECT row_number() OVER () AS p, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents)
),
total AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM p GROUP BY lang),
f AS MATERIALIZED (
  SELECT lang, m, phrase, CAST(count(*) AS BIGINT) AS a
  FROM (SELECT lang, m, unnest(list_transform(range(1, len(ws) - m + 2), lambda s: array_to_string(ws[s:s + m - 1], ' '))) AS phrase
        FROM p, (SELECT unnest(range(1, 4)) AS m) WHERE len(ws) >= m)
  GROUP BY ALL HAVING count(*) >= 10
),
cuts AS (
  SELECT lang, m, phrase, a, k, array_to_string(ws[1:k], ' ') AS head, array_to_string(ws[k + 1:m], ' ') AS tail
  FROM (SELECT *, string_split(phrase, ' ') AS ws, unnest(range(1, m)) AS k FROM f WHERE m > 1)
),
scored AS (
  SELECT c.lang, c.m, c.phrase, c.a, c.k, h.a AS l, t.a AS r,
    CAST((CAST(c.a AS HUGEINT) * c.a * 1000000) // (CAST(h.a AS HUGEINT) * t.a) AS BIGINT) AS score
  FROM cuts c JOIN f h ON c.lang = h.lang AND c.head = h.phrase JOIN f t ON c.lang = t.lang AND c.tail = t.phrase
),
best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
),
inside AS (
  SELECT lang, unnest([array_to_string(ws[1:2], ' '), array_to_string(ws[2:3], ' ')]) AS phrase, a
  FROM (SELECT *, string_split(phrase, ' ') AS ws FROM f WHERE m = 3)
),
around AS (SELECT lang, phrase, max(a) AS a FROM inside GROUP BY ALL),
kept AS (
  SELECT b.* FROM best b LEFT JOIN around x ON b.lang = x.lang AND b.phrase = x.phrase
  WHERE x.a IS NULL OR 100 * x.a < 50 * b.a
)
SELECT kept.lang, row_number() OVER (PARTITION BY kept.lang ORDER BY score DESC, kept.a DESC, phrase) AS rank,
  phrase, a, l, r, n, score
FROM kept JOIN total ON kept.lang = total.lang QUALIFY rank <= 2000
"""
