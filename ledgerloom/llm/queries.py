"""Registered queries of the training-data operators, with oracle SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import (
    dart_minhash,
    decontaminate,
    exact_dedup,
    fill_middle,
    hidden_markov,
    langid,
    packing,
    pfor,
    pii,
    resample,
    secret_ledger,
    token_counts,
    wrappers,
)
from ledgerloom.llm.common import prepare


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items that documents hold, one row per document and item."""
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents, packed into sequences of 1024 tokens."""
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts, a row per document."""
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return wrappers.extract_text(table(spark, sf_dir, "pages"))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, learned from four fifths of them."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    model = langid.learn(docs.filter(~held_out))
    found = langid.identify(docs, model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, from a ledger that starts empty."""
    return secret_ledger.digest(secret_ledger.scan_secrets(table(spark, sf_dir, "documents")))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data and disclosing terms of every document."""
    return pii.digest(pii.sanitise(table(spark, sf_dir, "documents")))


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of near duplicates of every document."""
    return dart_minhash.near_duplicates(table(spark, sf_dir, "documents")).drop("text_hash")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document."""
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document as read back from patched frame-of-reference segments."""
    return pfor.round_trip(table(spark, sf_dir, "documents"))


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fill-in-the-middle form of every document."""
    return fill_middle.digest(fill_middle.fill_in_middle(table(spark, sf_dir, "documents")))


def op12_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights of all documents towards the benchmark, and the ranks of those drawn."""
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram and hidden Markov scores of all documents, learned from those not held out."""
    return hidden_markov.learn_and_score(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_decontaminate,
        op2_pack,
        op3_exact_dedup,
        op4_main_text,
        op5_language,
        op6_secrets,
        op7_pii,
        op8_near_dedup,
        op9_token_counts,
        op10_token_files,
        op11_fill_middle,
        op12_resample,
        op13_lm_score,
    )
}

_OP3 = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text,
                  regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS n
           FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER (PARTITION BY n ORDER BY length(text) DESC, doc_id) AS keep_id,
       count(*) OVER (PARTITION BY n) AS group_size,
       row_number() OVER (PARTITION BY n ORDER BY length(text) DESC, doc_id) = 1 AS kept,
       sha256(n) AS text_sha256
FROM t
"""


def _spans_sql(kind: str, rank: int, pattern: str, group: int, least: int) -> str:
    """Spans of one kind: the lengths of the pieces between matches and of the matches, summed up."""
    quoted = pattern.replace("'", "''")
    return f"""
SELECT doc_id, '{kind}' AS kind, {rank} AS k, e - l AS s, e AS e FROM (
  SELECT doc_id, length(m[i]) AS l, length(p[i]) AS size,
         list_sum(list_transform(g[:i], lambda x: length(x))) + list_sum(list_transform(m[:i], lambda x: length(x))) AS e
  FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM (
    SELECT doc_id, regexp_extract_all(t, '{quoted}') AS m, regexp_extract_all(t, '{quoted}', {group}) AS p,
           string_split_regex(t, '{quoted}') AS g
    FROM d WHERE regexp_matches(t, '{quoted}')))) WHERE size >= {least}"""


_OP6 = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
s AS ({' UNION ALL '.join(_spans_sql(r.kind, k, r.pattern, r.group, r.least) for k, r in enumerate(secret_ledger.RULES))}),
a AS (SELECT doc_id, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k) AS spans,
             count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
             count(*) FILTER (kind = 'hex') AS n_hex
      FROM s GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN a USING (doc_id)
"""

_OP11 = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS x FROM documents),
k AS (SELECT *, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') AS u, ('0x' || x[1:8])::UBIGINT AS h1,
             ('0x' || x[9:16])::UBIGINT AS h2, ('0x' || x[17:24])::UBIGINT AS h3, ('0x' || x[25:32])::UBIGINT AS h4
      FROM d),
c AS (SELECT *, len(u) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1))::BIGINT AS a,
             greatest(h1 % (len(u) + 1), h2 % (len(u) + 1))::BIGINT AS b,
             t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 AS plain
      FROM k),
p AS (SELECT *, coalesce(array_to_string(u[1:a], ''), '') AS pre, coalesce(array_to_string(u[a + 1:b], ''), '') AS mid,
             coalesce(array_to_string(u[b + 1:], ''), '') AS suf
      FROM c)
SELECT doc_id, n::BIGINT AS n, CASE WHEN plain THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form,
       CASE WHEN NOT plain THEN length(pre) END AS prefix_chars, CASE WHEN NOT plain THEN length(mid) END AS middle_chars,
       sha256(CASE WHEN plain THEN t WHEN h4 % 100 < 20 THEN '<S>' || suf || '<P>' || pre || '<M>' || mid
                   ELSE '<P>' || pre || '<S>' || suf || '<M>' || mid END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""

# crc32 of a feature: fold of its UTF-8 bytes over the 256 table entries, which SQL makes by rule
_OP12 = rf"""
WITH RECURSIVE z AS (
  SELECT list(list_reduce([n] || range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY n) AS t
  FROM range(256) r(n)),
a AS (SELECT 0 AS side, row_number() OVER () AS row, doc_id, text FROM documents
      UNION ALL SELECT 1, row_number() OVER (), NULL, text FROM benchmark),
w AS (SELECT side, row, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{resample.WORD}') AS w
      FROM a),
f AS (SELECT side, row, doc_id, w[i] AS f FROM w, range(1, len(w) + 1) r(i)
      UNION ALL SELECT side, row, doc_id, w[i] || ' ' || w[i + 1] FROM w, range(1, len(w)) r(i)),
u AS (SELECT f, hex(encode(f)) AS h FROM (SELECT DISTINCT f FROM f)),
b AS (SELECT f, xor(list_reduce([4294967295] || list_transform(range(len(h) // 2), lambda i: ('0x' || h[2 * i + 1:2 * i + 2])::BIGINT),
                                lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % {resample.BUCKETS} AS k
      FROM u, z),
n AS (SELECT k, count(*) FILTER (side = 0) AS s, count(*) FILTER (side = 1) AS t FROM f JOIN b USING (f) GROUP BY k),
m AS (SELECT sum(s) AS ss, sum(t) AS tt FROM n),
g AS (SELECT k, floor(1000 * ln((t + 1) * (ss + {resample.BUCKETS}) / ((s + 1) * (tt + {resample.BUCKETS})))) AS g FROM n, m),
e AS (SELECT row, count(*) AS n_features, floor(sum(g) / count(*))::BIGINT AS weight
      FROM f JOIN b USING (f) JOIN g USING (k) WHERE side = 0 GROUP BY row),
s AS (SELECT w.row, w.doc_id, len(w) >= {resample.LEAST_WORDS} AS ok, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
             coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('{resample.SEED}:' || coalesce(w.doc_id::VARCHAR, ''))[1:8])::UBIGINT + 0.5)
               / 4294967296)))::BIGINT AS score
      FROM w LEFT JOIN e ON w.row = e.row WHERE side = 0),
o AS (SELECT *, row_number() OVER (PARTITION BY ok ORDER BY score DESC, doc_id NULLS FIRST, row) AS r, count(*) OVER (PARTITION BY ok) AS c FROM s)
SELECT doc_id, n_features, weight, score, CASE WHEN ok AND r <= {resample.DRAWN} * c // 100 THEN r END AS rank FROM o
"""

ORACLES: dict[str, str] = {"op3_exact_dedup": _OP3, "op6_secrets": _OP6, "op11_fill_middle": _OP11, "op12_resample": _OP12}
