"""The operators as queries over the tables of a folder."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from quillspan.llm import clusters, decontam, html_extract, lexical, mixing, ppm, quality, secret_scan, sharding, simhash, terms, token_counts, token_files, toxicity


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_read(spark, sf_dir, "documents"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards(_read(spark, sf_dir, "documents"), 16)


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op4_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.main_texts(_read(spark, sf_dir, "pages"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, copies = mixing.mix(_read(spark, sf_dir, "documents"))
    return copies.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_files(_read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2)


def op7_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.scores(_read(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secrets(_read(spark, sf_dir, "documents"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=1024)


def op11_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.clusters(_read(spark, sf_dir, "embeddings"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


QUERIES = {
    f.__name__: f
    for f in (op1_simhash, op2_sharding, op3_quality_rules, op4_html, op5_mixing, op6_token_files, op7_ppm, op8_decontamination, op9_secrets, op10_token_counts, op11_clusters, op12_ranked_search, op13_toxicity)
}


def _lloyd_sql(rounds: int = 10, k: int = 8) -> str:
    """Plain Lloyd rounds, one common table expression each."""
    distance = "list_sum([(v.p[i] - c.p[i]) * (v.p[i] - c.p[i]) for i in range(1, 65)])"
    near = f"(SELECT rid, cluster, d FROM (SELECT v.rid, c.cluster, {distance} AS d, row_number() OVER (PARTITION BY v.rid ORDER BY {distance}, c.cluster) AS o FROM v, c{{0}} c) WHERE o = 1)"
    parts = [
        "v AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS p FROM embeddings"
        " WHERE len(embedding) = 64 AND len([x for x in embedding if x IS NOT NULL AND isfinite(x)]) = 64)",
        f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, p) - 1 AS cluster, p FROM (SELECT sha256('3:' || vec_id) AS h, p FROM v ORDER BY h, p LIMIT {k}))",
    ]
    for r in range(rounds):
        parts += [
            f"a{r} AS MATERIALIZED {near.format(r)}",
            f"m{r} AS MATERIALIZED (SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY i) AS p FROM (SELECT a.cluster, i, sum(v.p[i])::BIGINT AS s, count(*) AS n FROM a{r} a JOIN v USING (rid), range(1, 65) t(i) GROUP BY a.cluster, i) GROUP BY cluster)",
            f"c{r + 1} AS MATERIALIZED (SELECT c.cluster, coalesce(m.p, c.p) AS p FROM c{r} c LEFT JOIN m{r} m USING (cluster))",
        ]
    return (
        f"WITH {', '.join(parts)}, f AS MATERIALIZED {near.format(rounds)}"
        " SELECT v.vec_id, f.cluster::INTEGER AS cluster, f.d::BIGINT AS distance, (sum(f.d) OVER (PARTITION BY f.cluster))::BIGINT AS cluster_inertia, (sum(f.d) OVER ())::BIGINT AS inertia,"
        f" sha256(array_to_string(c.p, ',')) AS centroid_sha256 FROM f JOIN v USING (rid) JOIN c{rounds} c USING (cluster)"
    )


_TERMS = rf"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{terms.TERM}')"
ORACLES: dict[str, str] = {
    "op11_clusters": _lloyd_sql(),
    "op12_ranked_search": f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS ts FROM documents), i AS MATERIALIZED (SELECT row_number() OVER () AS q, item_id, {_TERMS} AS ts FROM benchmark),
g AS (SELECT count(*) AS rows, sum(len(ts))::BIGINT AS total FROM d WHERE len(ts) > 0),
t AS MATERIALIZED (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(ts) AS term FROM d) GROUP BY r, term),
w AS MATERIALIZED (SELECT term, CAST(floor(1000 * ln((2 * rows + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT) AS w FROM (SELECT term, count(*) AS df FROM t GROUP BY term), g),
a AS (SELECT q, term, count(*) AS times FROM (SELECT q, unnest(ts) AS term FROM i) GROUP BY q, term),
s AS (SELECT a.q, t.r, sum(a.times * w.w * ((1000000000 * t.tf) // (1000 * t.tf + 12 * (75 + (25 * len(d.ts) * g.rows) // g.total))))::BIGINT AS score
 FROM a JOIN w USING (term) JOIN t USING (term) JOIN d USING (r), g GROUP BY a.q, t.r),
o AS (SELECT s.q, d.doc_id, s.score, row_number() OVER (PARTITION BY s.q ORDER BY s.score DESC, d.doc_id) AS rank FROM s JOIN d USING (r) WHERE s.score > 0)
SELECT i.item_id, o.rank::INTEGER AS rank, o.doc_id, o.score FROM o JOIN i USING (q) WHERE o.rank <= 20""",
}
