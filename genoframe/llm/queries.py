"""Registered queries of the numbered operators: production parameters, whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genoframe.llm.frames import table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def all_queries() -> tuple[dict, dict[str, str]]:
    """The operators' queries and the staged pipeline, with their SQL."""
    import corpus_pipeline
    queries = {**QUERIES, "pipeline": corpus_pipeline.run}
    oracles = dict(ORACLES)
    if corpus_pipeline.ORACLE_SQL is not None:
        oracles["pipeline"] = corpus_pipeline.ORACLE_SQL
    return queries, oracles


@query("op1_suffix_array_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    from genoframe.llm import suffix_dedup
    out = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), keep_bytes=False)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query("op3_license_scan")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from genoframe.llm import license_scan
    return license_scan.scan(table(spark, sf_dir, "documents")).drop("places")


@query("op4_simhash_near_dedup")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    from genoframe.llm import simhash
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, max_bits=4)


_DUCK_WORDS = ("regexp_extract_all(translate(coalesce({t}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
               "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')")

OP8_SQL = f"""
WITH item AS (SELECT item_id, {_DUCK_WORDS.format(t='text')} AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, least(len(w), 10) AS m, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS key
       FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM item WHERE len(w) > 0)),
doc AS (SELECT doc_id, {_DUCK_WORDS.format(t='text')} AS w FROM documents),
len_m AS (SELECT DISTINCT m FROM iw),
dw AS (SELECT doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') AS key
       FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM doc, len_m WHERE len(w) >= m)),
hit AS (SELECT doc_id, i, dw.m AS m, item_id FROM dw JOIN iw USING (key, m)),
cov AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM hit) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS items
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hit) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN cov USING (doc_id) LEFT JOIN its USING (doc_id)
"""


@query("op8_benchmark_decontamination", OP8_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    from genoframe.llm import decontaminate
    out = decontaminate.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                      (F.col("n_hit") > 0).alias("contaminated"))


@query("op9_byte_level_bpe")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from genoframe.llm import bpe
    return bpe.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                      public_tokenizers.PATTERN, keep_ids=False)


@query("op10_language_id")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    from genoframe.llm import langid
    docs = table(spark, sf_dir, "documents")
    out = langid.predict(docs, langid.fit(docs))
    return out.select("doc_id", F.coalesce(~langid.learnable(), F.lit(False)).alias("held_out"), "lang_pred", "score")


@query("op7_html_extraction")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    from genoframe.llm import html_template
    return html_template.extract(table(spark, sf_dir, "pages"))


@query("op5_embedding_near_dedup")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    from genoframe.llm import multi_index
    return multi_index.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.95)


OP6_SQL = f"""
WITH doc AS (SELECT doc_id, {_DUCK_WORDS.format(t='text')} AS w FROM documents),
tok AS (SELECT doc_id, i, w[i] AS a, CASE WHEN i > 1 THEN w[i - 1] END AS p FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM doc)),
u AS (SELECT a, count(*) AS n FROM tok GROUP BY a), ud AS (SELECT doc_id, a, count(*) AS n FROM tok GROUP BY doc_id, a),
b AS (SELECT p, a, count(*) AS n FROM tok WHERE p IS NOT NULL GROUP BY p, a),
bd AS (SELECT doc_id, p, a, count(*) AS n FROM tok WHERE p IS NOT NULL GROUP BY doc_id, p, a),
tot AS (SELECT count(*) AS n FROM tok),
x AS (SELECT tok.doc_id, tok.p IS NOT NULL AS two, u.n - ud.n AS cu, coalesce(b.n - bd.n, 0) AS cb, up.n - upd.n AS cp,
             greatest(tot.n - len(doc.w), 1) AS n
      FROM tok JOIN doc USING (doc_id) CROSS JOIN tot JOIN u ON u.a = tok.a JOIN ud ON ud.doc_id = tok.doc_id AND ud.a = tok.a
      LEFT JOIN b ON b.p = tok.p AND b.a = tok.a LEFT JOIN bd ON bd.doc_id = tok.doc_id AND bd.p = tok.p AND bd.a = tok.a
      LEFT JOIN u up ON up.a = tok.p LEFT JOIN ud upd ON upd.doc_id = tok.doc_id AND upd.a = tok.p),
s AS (SELECT doc_id, count(*) AS n_words, count(*) FILTER (WHERE NOT (two AND cb > 0) AND (two OR cu = 0)) AS n_backoff,
             sum(CASE WHEN two AND cb > 0 THEN ln(cb) - ln(cp) WHEN cu > 0 THEN ln(cu) - ln(n) + CASE WHEN two THEN ln(0.4) ELSE 0 END
                      ELSE -ln(n) + ln(0.4) * CASE WHEN two THEN 2 ELSE 1 END END) AS t
      FROM x GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(n_words, 0) AS BIGINT) AS n_words, CAST(coalesce(n_backoff, 0) AS BIGINT) AS n_backoff,
       round(coalesce(t, 0), 4) AS log_score, round(t / n_words, 4) AS mean_log_score
FROM doc LEFT JOIN s USING (doc_id)
"""


@query("op6_lm_scoring", OP6_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    from genoframe.llm import ngram_lm
    out = ngram_lm.score(table(spark, sf_dir, "documents"), order=2)
    return out.select("doc_id", "n_words", "n_backoff", F.round("log_score", 4).alias("log_score"),
                      F.round("mean_log_score", 4).alias("mean_log_score"))


OP6_ORDER3_SQL = f"""
WITH doc AS (SELECT doc_id, {_DUCK_WORDS.format(t='text')} AS w FROM documents),
tok AS (SELECT doc_id, least(i, 3) AS m, w[i] AS a, CASE WHEN i > 1 THEN w[i - 1] END AS p, CASE WHEN i > 2 THEN w[i - 2] END AS q
        FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM doc)),
u AS (SELECT a, count(*) AS n FROM tok GROUP BY a), ud AS (SELECT doc_id, a, count(*) AS n FROM tok GROUP BY doc_id, a),
b AS (SELECT p, a, count(*) AS n FROM tok WHERE m > 1 GROUP BY p, a),
bd AS (SELECT doc_id, p, a, count(*) AS n FROM tok WHERE m > 1 GROUP BY doc_id, p, a),
t AS (SELECT q, p, a, count(*) AS n FROM tok WHERE m > 2 GROUP BY q, p, a),
td AS (SELECT doc_id, q, p, a, count(*) AS n FROM tok WHERE m > 2 GROUP BY doc_id, q, p, a),
tot AS (SELECT count(*) AS n FROM tok),
x AS (SELECT tok.doc_id, tok.m, u.n - ud.n AS cu, coalesce(b.n - bd.n, 0) AS cb, up.n - upd.n AS cp, coalesce(t.n - td.n, 0) AS ct,
             bp.n - bpd.n AS cq, greatest(tot.n - len(doc.w), 1) AS n
      FROM tok JOIN doc USING (doc_id) CROSS JOIN tot JOIN u ON u.a = tok.a JOIN ud ON ud.doc_id = tok.doc_id AND ud.a = tok.a
      LEFT JOIN b ON b.p = tok.p AND b.a = tok.a LEFT JOIN bd ON bd.doc_id = tok.doc_id AND bd.p = tok.p AND bd.a = tok.a
      LEFT JOIN u up ON up.a = tok.p LEFT JOIN ud upd ON upd.doc_id = tok.doc_id AND upd.a = tok.p
      LEFT JOIN t ON t.q = tok.q AND t.p = tok.p AND t.a = tok.a
      LEFT JOIN td ON td.doc_id = tok.doc_id AND td.q = tok.q AND td.p = tok.p AND td.a = tok.a
      LEFT JOIN b bp ON bp.p = tok.q AND bp.a = tok.p LEFT JOIN bd bpd ON bpd.doc_id = tok.doc_id AND bpd.p = tok.q AND bpd.a = tok.p),
l AS (SELECT *, CASE WHEN m > 2 AND ct > 0 THEN 3 WHEN m > 1 AND cb > 0 THEN 2 WHEN cu > 0 THEN 1 ELSE 0 END AS k FROM x),
s AS (SELECT doc_id, count(*) AS n_words, count(*) FILTER (WHERE k < m) AS n_backoff,
             sum((m - k) * ln(0.4) + CASE k WHEN 3 THEN ln(ct) - ln(cq) WHEN 2 THEN ln(cb) - ln(cp) WHEN 1 THEN ln(cu) - ln(n) ELSE -ln(n) END) AS t
      FROM l GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(n_words, 0) AS BIGINT) AS n_words, CAST(coalesce(n_backoff, 0) AS BIGINT) AS n_backoff,
       round(coalesce(s.t, 0), 4) AS log_score, round(s.t / n_words, 4) AS mean_log_score
FROM doc LEFT JOIN s USING (doc_id)
"""


@query("op6_lm_scoring_order3", OP6_ORDER3_SQL)
def op6_order3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from genoframe.llm import ngram_lm
    out = ngram_lm.score(table(spark, sf_dir, "documents"), order=3)
    return out.select("doc_id", "n_words", "n_backoff", F.round("log_score", 4).alias("log_score"),
                      F.round("mean_log_score", 4).alias("mean_log_score"))


@query("op2_substring_dedup")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    from genoframe.llm import compact_windows
    return compact_windows.near_duplicate_passages(table(spark, sf_dir, "documents"))


@query("op13_bpe_encoding")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from genoframe.llm import spec_bpe
    return spec_bpe.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), keep_ids=False)


@query("op11_cross_tokenizer_alignment")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from genoframe.llm import token_align
    return token_align.align(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                             public_tokenizers.path("piece_bpe_32k.model"), keep_groups=False)


OP12_SQL = """
WITH v AS (SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(CAST(embedding AS DOUBLE[]), lambda x: floor(256 * x)) AS x
           FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.id AS anchor_id, r.id, r.label = a.label AS same, CAST(list_inner_product(a.x, r.x) AS BIGINT) AS score
      FROM v a JOIN v r ON a.id % 100 = 0 AND a.id <> r.id AND len(a.x) = len(r.x)),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""


@query("op12_hard_negatives", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    from genoframe.llm import hard_negatives
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings").withColumn("label", moved))
