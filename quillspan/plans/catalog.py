"""Queries over the driver tables, each with the SQL that gives the same rows.

Tables stand for the engine's own: documents are sections and chunks, embeddings the vector index, labels optional
metadata, conversations the chat store, events a run log, region / nation / customer / supplier registries.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quillspan.functions import text as T
from quillspan.operators import answer as A, buckets as B, chunk as C, coverage as V, quality as Q, retrieval as R, store as S
from quillspan.operators.control import Control
from quillspan.plans import families, pipelines, providers as P, registry
from quillspan.sources import blocks as K, crawl as W, fetch, files, html as H, markdown as M, objects as O, shared, xml as X
from quillspan.streaming import ingest as I

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def by_lang(lang: Column, values: tuple[str, str, str, str]) -> Column:
    en, de, fr, rest = values
    return F.when(lang == "en", en).when(lang == "de", de).when(lang == "fr", fr).otherwise(rest)


JURISDICTIONS = ("US", "TX", "TX-48201", "TX-houston")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    cite = F.when(F.col("doc_id") % 10 == 0, "").otherwise(F.concat("source", F.lit(" § "), F.col("doc_id").cast("string")))
    return d.withColumns({
        "jurisdiction": by_lang(F.col("lang"), JURISDICTIONS), "source_type": by_lang(F.col("lang"), Q.SOURCE_TYPES), "citation": cite,
        "tokens": T.tokens(F.col("text")), "chunk_id": F.concat(F.lit("doc-"), F.col("doc_id").cast("string"), F.lit("-0")),
    })


def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents with the optional metadata that labels stand for."""
    one = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    d = documents(spark, sf_dir).join(one, "doc_id", "left")
    return d.withColumns({"category": F.when(F.col("quality") == 1, "food-safety").when(F.col("quality") == 0, ""), "title": F.when(F.col("quality").isNotNull(), F.col("source"))})


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = table(spark, sf_dir, "embeddings")
    j = F.when(F.col("label") <= 3, "US").when(F.col("label") <= 6, "TX").when(F.col("label") <= 8, "TX-48201").otherwise("TX-houston")
    return v.withColumns({"jurisdiction": j, "last_updated": F.expr("date_sub(date'2025-01-01', cast(vec_id % 730 as int))")})


def query_vector(spark: SparkSession, sf_dir: str, vec_id: int = 0) -> list[float]:
    """One vector, on the driver."""
    return list(table(spark, sf_dir, "embeddings").where(F.col("vec_id") == vec_id).select("embedding").first()[0])



def now() -> Column:
    return F.lit("2025-01-01").cast("timestamp")


_DOCS = """d AS (SELECT *, CASE lang WHEN 'en' THEN 'US' WHEN 'de' THEN 'TX' WHEN 'fr' THEN 'TX-48201' ELSE 'TX-houston' END AS jurisdiction,
 CASE lang WHEN 'en' THEN 'federal' WHEN 'de' THEN 'state' WHEN 'fr' THEN 'county' ELSE 'municipal' END AS source_type,
 CASE WHEN doc_id % 10 = 0 THEN '' ELSE source || ' § ' || doc_id END AS citation,
 CASE WHEN length(text) = 0 THEN 0 ELSE CAST(ceil(ceil(length(text) / 4.0) * 1.1::DOUBLE) AS BIGINT) END AS tokens, 'doc-' || doc_id || '-0' AS chunk_id FROM documents)"""
_CHUNKS = _DOCS + """, c AS (SELECT d.*, CASE quality WHEN 1 THEN 'food-safety' WHEN 0 THEN '' END AS category, CASE WHEN quality IS NOT NULL THEN source END AS title
 FROM d LEFT JOIN (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY doc_id) l USING (doc_id))"""
_COS = "round(list_dot_product(e.embedding::DOUBLE[], q.v) / (sqrt(list_dot_product(e.embedding::DOUBLE[], e.embedding::DOUBLE[])) * sqrt(list_dot_product(q.v, q.v))), 6)"
_VEC = f"""q AS (SELECT embedding::DOUBLE[] AS v FROM embeddings WHERE vec_id = 0),
e AS (SELECT *, CASE WHEN label <= 3 THEN 'US' WHEN label <= 6 THEN 'TX' WHEN label <= 8 THEN 'TX-48201' ELSE 'TX-houston' END AS jurisdiction,
 DATE '2025-01-01' - CAST(vec_id % 730 AS INTEGER) AS last_updated FROM embeddings),
s AS (SELECT e.*, {_COS} AS score FROM e, q)"""

# --- retrieval -----------------------------------------------------------------------------------------------------


@query("WITH " + _VEC + " SELECT vec_id, score FROM s ORDER BY score DESC, vec_id LIMIT 10")
def vector_topk(spark, sf_dir):
    return R.top_k(vectors(spark, sf_dir), query_vector(spark, sf_dir), 10).select("vec_id", "score")


@query("WITH " + _VEC + " SELECT vec_id, jurisdiction, score FROM s WHERE jurisdiction IN ('TX', 'TX-48201') ORDER BY score DESC, vec_id LIMIT 20")
def vector_topk_filtered(spark, sf_dir):
    where = {"$or": [{"jurisdiction": {"$eq": "TX"}}, {"jurisdiction": {"$in": ["TX-48201"]}}]}
    return R.top_k(vectors(spark, sf_dir), query_vector(spark, sf_dir), 20, where).select("vec_id", "jurisdiction", "score")


@query("WITH " + _VEC + " SELECT * FROM (SELECT vec_id, score FROM s WHERE jurisdiction IN ('US', 'TX') ORDER BY score DESC, vec_id LIMIT 50) WHERE score >= 0.2")
def retrieve_threshold(spark, sf_dir):
    got = R.retrieve(vectors(spark, sf_dir), query_vector(spark, sf_dir), ["US", "TX"], now(), final=50, min_score=0.2, recency=False)
    return got.select("vec_id", "score")


_RERANK = f"""WITH {_VEC}, t AS (SELECT * FROM s WHERE jurisdiction IN ('US', 'TX') ORDER BY score DESC, vec_id LIMIT 50),
w AS (SELECT vec_id, jurisdiction, score, round(score * 0.8 + CASE WHEN date_diff('day', last_updated, DATE '2025-01-01') < 365 THEN 0.2 ELSE 0 END, 6) AS weighted FROM t WHERE score >= 0.2)
SELECT * FROM w ORDER BY weighted DESC, score DESC, vec_id LIMIT 10"""


@query(_RERANK)
def rerank_recency(spark, sf_dir):
    got = R.retrieve(vectors(spark, sf_dir), query_vector(spark, sf_dir), ["US", "TX"], now(), min_score=0.2)
    return got.select("vec_id", "jurisdiction", "score", "weighted")


@query(f"""WITH {_VEC}, {_DOCS}, t AS (SELECT * FROM s ORDER BY score DESC, vec_id LIMIT 50), k AS (SELECT t.vec_id, t.score, t.jurisdiction, d.citation FROM t JOIN d ON d.doc_id = t.vec_id WHERE score >= 0.2),
m AS (SELECT coalesce(avg(score), 0) AS a, count(DISTINCT jurisdiction) AS r, coalesce(count(*) FILTER (citation <> '') / count(*), 0) AS c FROM k),
z AS (SELECT *, r / 4 AS j, a * 0.5 + r / 4 * 0.3 + c * 0.2 AS x FROM m), l AS (SELECT *, CASE WHEN x > 0.8 AND j = 1 THEN 'High' WHEN x > 0.6 THEN 'Medium' ELSE 'Low' END AS level FROM z)
SELECT level, round(x, 6) AS score, printf('%s: %d/%d jurisdictions covered, avg similarity %.2f, %.0f%% chunks have citations', level, r, 4, a, c * 100) AS reason,
round(a, 6) AS avg_similarity, round(j, 6) AS jurisdiction_coverage, round(c, 6) AS citation_coverage FROM l""")
def confidence_score(spark, sf_dir):
    found = R.top_k(vectors(spark, sf_dir), query_vector(spark, sf_dir)).where("score >= 0.2").select("vec_id", "score", "jurisdiction")
    cites = documents(spark, sf_dir).select(F.col("doc_id").alias("vec_id"), "citation")
    return R.confidence(found.join(cites, "vec_id"), JURISDICTIONS)


# --- scalar functions ----------------------------------------------------------------------------------------------


@query(f"WITH {_DOCS} SELECT doc_id, tokens, tokens <= 1500 AS fits, tokens <= 7500 AS within_model FROM d")
def token_estimate(spark, sf_dir):
    n = F.col("tokens")
    return documents(spark, sf_dir).select("doc_id", "tokens", (n <= 1500).alias("fits"), (n <= 7500).alias("within_model"))


@query(f"WITH {_DOCS} SELECT source, CAST(sum(ceil(tokens / 1500)) AS BIGINT) AS chunks, CAST(sum(tokens) AS BIGINT) AS tokens FROM d GROUP BY source")
def chunk_count_estimate(spark, sf_dir):
    return documents(spark, sf_dir).groupBy("source").agg(F.sum(T.chunk_count(F.col("tokens"))).alias("chunks"), F.sum("tokens").alias("tokens"))


_SECTIONS = "s AS (SELECT p_partkey, p_size % 50 AS title, CASE WHEN p_partkey % 7 = 0 THEN 'abc' ELSE (p_size + 100) || '.' || p_partkey END AS section, p_size + 100 AS part FROM part)"


def sections(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    number = F.concat((F.col("p_size") + 100).cast("string"), F.lit("."), F.col("p_partkey").cast("string"))
    return p.select("p_partkey", (F.col("p_size") % 50).alias("title"), F.when(F.col("p_partkey") % 7 == 0, "abc").otherwise(number).alias("section"), (F.col("p_size") + 100).alias("part"))


@query(f"""WITH {_SECTIONS} SELECT p_partkey, CASE WHEN ok THEN title || ' C.F.R. § ' || section || '(a)' END AS citation, CASE WHEN ok THEN part END AS part,
'https://www.ecfr.gov/current/title-' || title || '/part-' || part || '/section-' || section AS url FROM (SELECT *, section <> 'abc' AS ok FROM s)""")
def citation_build(spark, sf_dir):
    t, s = F.col("title"), F.col("section")
    return sections(spark, sf_dir).select("p_partkey", T.federal_citation(t, s, F.lit("(a)")).alias("citation"), T.section_part(s).alias("part"), T.federal_url(t, F.col("part"), s).alias("url"))


@query(f"""WITH {_SECTIONS} SELECT p_partkey, 'cfr-' || title || '-' || part || '-' || section || '-0' AS federal, 'cfr-title-' || title AS federal_source,
'tx-statute-HS-' || part || '-' || section || '-1' AS statute, 'county-fort-bend-' || part || '-' || section || '-2' AS county, 'municipal-fort_worth-' || part || '-' || section || '-3' AS city FROM s""")
def chunk_id_build(spark, sf_dir):
    p, s, lit = F.col("part"), F.col("section"), F.lit
    return sections(spark, sf_dir).select(
        "p_partkey", T.chunk_id("cfr", F.col("title"), p, s, lit(0)).alias("federal"), T.source_id("cfr", F.col("title")).alias("federal_source"),
        T.chunk_id("tx-statute", lit("HS"), p, s, lit(1)).alias("statute"), T.chunk_id("county", lit("Fort Bend"), p, s, lit(2)).alias("county"), T.chunk_id("municipal", lit("fort_worth"), p, s, lit(3)).alias("city"),
    )


@query(f"""WITH {_SECTIONS} SELECT p_partkey, 'Title ' || title || ' > Chapter I > Part ' || part || ' > Section ' || section AS federal,
'Texas Counties > Harris County > Chapter ' || part || ' > Section ' || section AS county FROM s""")
def hierarchy_build(spark, sf_dir):
    p, s = F.col("part").cast("string"), F.col("section")
    return sections(spark, sf_dir).select("p_partkey", F.array_join(T.federal_breadcrumb(F.col("title"), F.lit("I"), p, s), " > ").alias("federal"), F.array_join(T.state_breadcrumb("county", F.lit("Harris"), p, s), " > ").alias("county"))


@query(r"""SELECT s_suppkey, regexp_replace(lower(s_name || ' of ' || n_name), '\s+', '-', 'g') AS slug, regexp_replace(regexp_replace(lower(s_name || ' of ' || n_name), '\s+', '-', 'g'), '[^a-z0-9-]', '', 'g') AS city_key
FROM supplier JOIN nation ON s_nationkey = n_nationkey""")
def slug_normalize(spark, sf_dir):
    j = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    name = F.concat("s_name", F.lit(" of "), "n_name")
    return j.select("s_suppkey", T.slug(name).alias("slug"), T.city_key(name).alias("city_key"))


@query("SELECT doc_id, sha256(text) AS digest FROM documents")
def content_hash(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("digest"))


@query(r"""SELECT doc_id, CASE WHEN length(f) > 500 THEN f[1:500] || '...' ELSE f END AS summary, CASE WHEN length(text) > 200 THEN text[1:200] || '...' ELSE text END AS excerpt
FROM (SELECT doc_id, text, split_part(text, chr(10) || chr(10), 1) AS f FROM documents)""")
def summary_excerpt(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.summary(F.col("text")).alias("summary"), T.excerpt(F.col("text")).alias("excerpt"))


@query(f"""WITH {_DOCS} SELECT doc_id, CASE jurisdiction WHEN 'US' THEN 'federal/' WHEN 'TX' THEN 'texas/' WHEN 'TX-48201' THEN 'counties/48201/' ELSE 'municipal/houston/' END AS prefix,
source_type AS inferred, CASE WHEN doc_id % 2 = 0 THEN 'application/xml' ELSE 'text/html' END AS content_type FROM d""")
def storage_keys(spark, sf_dir):
    key = F.concat(F.lit("raw/"), F.col("doc_id").cast("string"), F.when(F.col("doc_id") % 2 == 0, ".xml").otherwise(".html"))
    return documents(spark, sf_dir).select("doc_id", T.storage_prefix(F.col("jurisdiction")).alias("prefix"), T.source_type(F.col("jurisdiction")).alias("inferred"), T.content_type(key).alias("content_type"))


@query("""SELECT event_id, round((epoch_ms(TIMESTAMP '2024-01-31') - epoch_ms(ts)) / 3600000, 1) AS age_hours, epoch_ms(TIMESTAMP '2024-01-31') - epoch_ms(ts) < 7 * 86400000 AS fresh FROM events""")
def cache_age(spark, sf_dir):
    e, now = table(spark, sf_dir, "events"), F.lit("2024-01-31").cast("timestamp")
    ts = F.col("ts").cast("timestamp")
    return e.select("event_id", T.age_hours(ts, now).alias("age_hours"), T.is_fresh(ts, now).alias("fresh"))


# --- token reports -------------------------------------------------------------------------------------------------

_PCT = "list_sort(list(tokens))[CAST(least(floor(count(*) * {p} / 100), count(*) - 1) AS BIGINT) + 1] AS p{p}"
_DIST = "min(tokens) AS min, max(tokens) AS max, CAST(round(avg(tokens)) AS BIGINT) AS avg, " + ", ".join(_PCT.format(p=p) for p in (50, 95, 99)) + ", count(*) AS count"


@query(f"WITH {_DOCS} SELECT {_DIST} FROM d")
def token_distribution(spark, sf_dir):
    return Q.distribution(documents(spark, sf_dir).select("tokens"))


@query(f"WITH {_DOCS} SELECT lang, 'Tokens: avg=' || avg || ', range=[' || min || '-' || max || '], p95=' || p95 AS summary FROM (SELECT lang, {_DIST} FROM d GROUP BY lang)")
def token_summary(spark, sf_dir):
    return Q.distribution_summary(Q.distribution(documents(spark, sf_dir).select("lang", "tokens"), by=["lang"])).select("lang", "summary")


@query(f"WITH {_DOCS} SELECT source_type, {_PCT.format(p=50)}, {_PCT.format(p=95)}, {_PCT.format(p=99)} FROM d GROUP BY source_type")
def floor_percentiles(spark, sf_dir):
    return Q.floor_percentiles(documents(spark, sf_dir).select("source_type", "tokens"), "tokens", by=["source_type"])


@query(f"WITH {_DOCS} SELECT doc_id, tokens, CASE WHEN tokens > 8192 THEN 'hard' ELSE 'soft' END AS severity FROM d WHERE tokens > 1500")
def token_limit_violations(spark, sf_dir):
    return Q.limit_violations(documents(spark, sf_dir).select("doc_id", "tokens"))


@query(f"WITH {_DOCS}, m AS (SELECT avg(tokens) AS a, stddev_pop(tokens) AS s FROM d) SELECT doc_id, tokens, round(abs(tokens - a) / s, 6) AS deviation FROM d, m WHERE s > 0 AND abs(tokens - a) / s > 2")
def token_outliers(spark, sf_dir):
    return Q.outliers(documents(spark, sf_dir).select("doc_id", "tokens"))


# --- chunking ------------------------------------------------------------------------------------------------------

#: Driver texts have single line breaks only; these stand for paragraph breaks here.
PARAGRAPH = r"\n+"


@query(f"WITH {_DOCS} SELECT CASE WHEN tokens <= 1500 THEN 'whole' ELSE 'paragraphs' END AS tier, count(*) AS sections, CAST(sum(tokens) AS BIGINT) AS tokens FROM d GROUP BY 1")
def chunk_tier_dispatch(spark, sf_dir):
    d = documents(spark, sf_dir)
    return d.groupBy(C.tier(F.col("text")).alias("tier")).agg(F.count(F.lit(1)).alias("sections"), F.sum("tokens").alias("tokens"))


_PACK = f"""WITH RECURSIVE {_DOCS}, p AS (SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS INTEGER) AS i, para, CAST(ceil(ceil(length(para) / 4.0) * 1.1::DOUBLE) AS BIGINT) AS tok FROM
 (SELECT doc_id, unnest(parts) AS para, generate_subscripts(parts, 1) AS pos FROM (SELECT doc_id, regexp_split_to_array(text, chr(10) || '+') AS parts FROM d WHERE tokens > 1500)) WHERE length(trim(para)) > 0),
cum AS (SELECT *, sum(tok) OVER (PARTITION BY doc_id ORDER BY i) AS upto, count(*) OVER (PARTITION BY doc_id) AS n FROM p),
st(doc_id, i, s, held, closed) AS (SELECT doc_id, 1, 1, CAST(tok AS HUGEINT), 0 FROM cum WHERE i = 1 UNION ALL
 SELECT c.doc_id, c.i, CASE WHEN st.held + c.tok > 1500 THEN coalesce((SELECT min(x.i) FROM cum x WHERE x.doc_id = c.doc_id AND x.i >= st.s AND x.i < c.i AND c.upto - c.tok - (x.upto - x.tok) <= 225), c.i) ELSE st.s END,
 CASE WHEN st.held + c.tok > 1500 THEN c.upto - coalesce((SELECT max(x.upto - x.tok) FILTER (x.i = (SELECT min(y.i) FROM cum y WHERE y.doc_id = c.doc_id AND y.i >= st.s AND y.i < c.i AND c.upto - c.tok - (y.upto - y.tok) <= 225)) FROM cum x WHERE x.doc_id = c.doc_id), c.upto - c.tok) ELSE st.held + c.tok END,
 CASE WHEN st.held + c.tok > 1500 THEN st.s ELSE 0 END FROM st JOIN cum c ON c.doc_id = st.doc_id AND c.i = st.i + 1),
runs AS (SELECT doc_id, closed AS first, i - 1 AS last FROM st WHERE closed > 0 UNION ALL SELECT st.doc_id, st.s, st.i FROM st JOIN cum c USING (doc_id, i) WHERE c.i = c.n)
SELECT r.doc_id, r.first, r.last, CAST(row_number() OVER (PARTITION BY r.doc_id ORDER BY r.last) - 1 AS INTEGER) AS chunk_index, (SELECT md5(string_agg(para, chr(10) || chr(10) ORDER BY i)) FROM p WHERE p.doc_id = r.doc_id AND p.i BETWEEN r.first AND r.last) AS digest FROM runs r"""


@query(_PACK)
def chunk_paragraph_overlap(spark, sf_dir):
    d = documents(spark, sf_dir).where("tokens > 1500")
    rows = d.select("doc_id", F.posexplode(C.split_with_overlap(F.col("text"), pattern=PARAGRAPH)).alias("chunk_index", "c"))
    return rows.select("doc_id", F.col("c.first").alias("first"), F.col("c.last").alias("last"), "chunk_index", F.md5("c.text").alias("digest"))


def _marked(d: DataFrame) -> DataFrame:
    """Line starts become (1), (2) ... markers, as the driver texts have none."""
    lines = F.split("text", "\n")
    marked = F.transform(lines, lambda x, i: F.when(i % 3 == 1, F.concat(F.lit("("), (i + 1).cast("string"), F.lit(") "), x)).otherwise(x))
    return d.withColumn("text", F.array_join(marked, "\n"))


@query(r"""WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents),
m AS (SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS i FROM l), g AS (SELECT *, CASE WHEN i % 3 = 2 THEN i END AS mark, max(CASE WHEN i % 3 = 2 THEN i END) OVER (PARTITION BY doc_id ORDER BY i) AS owner FROM m),
t AS (SELECT doc_id, owner, trim(string_agg(line, chr(10) ORDER BY i), ' ' || chr(10) || chr(13) || chr(9)) AS body FROM g WHERE owner IS NOT NULL GROUP BY doc_id, owner)
SELECT doc_id, '(' || owner || ')' AS id, length(body) AS n_chars FROM t WHERE body <> ''""")
def chunk_subsections(spark, sf_dir):
    d = _marked(table(spark, sf_dir, "documents"))
    return d.select("doc_id", F.inline(C.subsections(F.col("text")))).select("doc_id", "id", F.length("text").cast("long").alias("n_chars"))


_STATS = _PACK[: _PACK.rindex("SELECT r.doc_id")] + """, w AS (SELECT d.doc_id, d.source_type, d.tokens, 1 AS total, 0 AS idx FROM d WHERE d.tokens <= 1500 UNION ALL
SELECT d.doc_id, d.source_type, CAST(ceil(ceil((SELECT sum(length(para)) + 2 * (count(*) - 1) FROM p WHERE p.doc_id = r.doc_id AND p.i BETWEEN r.first AND r.last) / 4.0) * 1.1::DOUBLE) AS BIGINT),
 count(*) OVER (PARTITION BY r.doc_id), row_number() OVER (PARTITION BY r.doc_id ORDER BY r.last) - 1 FROM runs r JOIN d USING (doc_id))
SELECT source_type, count(*) AS total_chunks, CAST(sum(tokens) AS BIGINT) AS total_tokens, round(avg(tokens), 6) AS avg_tokens, min(tokens) AS min_tokens, max(tokens) AS max_tokens, count(*) FILTER (total > 1 AND idx = 0) AS split_sections FROM w GROUP BY source_type"""


@query(_STATS)
def chunk_stats(spark, sf_dir):
    d = documents(spark, sf_dir).select("doc_id", "source_type", "text")
    return C.stats(C.chunk(d, pattern=PARAGRAPH), "source_type").withColumn("avg_tokens", F.round("avg_tokens", 6))


# --- metadata quality ----------------------------------------------------------------------------------------------

_LACK = "list_filter([{}], lambda x: x IS NOT NULL)"


@query(f"""WITH {_CHUNKS} SELECT doc_id, CASE WHEN citation = '' THEN 'citation' ELSE '' END AS missing,
array_to_string({_LACK.format("CASE WHEN coalesce(title, '') = '' THEN 'title' END, CASE WHEN coalesce(category, '') = '' THEN 'category' END")}, ',') AS absent, citation <> '' AS is_valid FROM c""")
def metadata_validate(spark, sf_dir):
    rows = Q.validate(chunks(spark, sf_dir), ("chunk_id", "source", "source_type", "jurisdiction", "text", "citation"), ("title", "category"))
    return rows.select("doc_id", F.array_join("missing", ",").alias("missing"), F.array_join("absent", ",").alias("absent"), "is_valid")


@query(f"WITH {_CHUNKS} SELECT source_type, count(*) FILTER (coalesce(title, '') <> '') AS with_title, count(*) FILTER (coalesce(category, '') <> '') AS with_category, count(*) AS total FROM c GROUP BY source_type")
def metadata_completeness(spark, sf_dir):
    c = chunks(spark, sf_dir)
    return c.groupBy("source_type").agg(F.count_if(Q.has("title")).alias("with_title"), F.count_if(Q.has("category")).alias("with_category"), F.count(F.lit(1)).alias("total"))


@query(f"WITH {_DOCS} SELECT source, count(*) FILTER (citation <> '') AS with_citation, count(*) AS total, round(count(*) FILTER (citation <> '') / count(*) * 100, 2) AS percentage FROM d GROUP BY source")
def citation_coverage(spark, sf_dir):
    n, k = F.count(F.lit(1)), F.count_if(Q.has("citation"))
    return documents(spark, sf_dir).groupBy("source").agg(k.alias("with_citation"), n.alias("total"), F.round(k / n * 100, 2).alias("percentage"))


@query(f"WITH {_DOCS} SELECT chunk_id FROM d WHERE citation = ''")
def citation_missing(spark, sf_dir):
    return documents(spark, sf_dir).where(~Q.has("citation")).select("chunk_id")


@query(f"WITH {_DOCS} SELECT " + ", ".join(f"count(*) FILTER (source_type = '{s}') AS {s}" for s in Q.SOURCE_TYPES) + " FROM d")
def source_distribution(spark, sf_dir):
    return Q.source_distribution(documents(spark, sf_dir))


_REPORT = f"""WITH {_CHUNKS}, r AS (SELECT source_type, count(*) AS chunks, CAST(round(avg(tokens)) AS BIGINT) AS avg_tokens, max(tokens) AS max_tokens, round(count(*) FILTER (citation <> '') / count(*) * 100, 1) AS citation_coverage,
round(count(*) FILTER (coalesce(title, '') <> '') / count(*) * 100, 1) AS title_coverage, round(count(*) FILTER (coalesce(category, '') <> '') / count(*) * 100, 1) AS category_coverage, count(*) FILTER (citation = '') AS missing_citations FROM c GROUP BY source_type)"""


@query(_REPORT + " SELECT * FROM r")
def quality_report(spark, sf_dir):
    return Q.report(chunks(spark, sf_dir), "source_type")


@query(_REPORT + " SELECT CAST(sum(chunks) AS BIGINT) AS chunks, CAST(round(sum(chunks * avg_tokens) / sum(chunks)) AS BIGINT) AS avg_tokens, round(count(*) FILTER (chunks > 0) / 4 * 100, 1) AS source_coverage, sum(chunks) > 0 AS has_chunks, sum(missing_citations) = 0 AS success FROM r")
def full_validation_rollup(spark, sf_dir):
    return Q.full_report(Q.report(chunks(spark, sf_dir), "source_type"))


# --- coverage ------------------------------------------------------------------------------------------------------


@query("""SELECT n_nationkey, n_name, coalesce(k, 0) AS vectors, CASE WHEN k IS NULL THEN 'pending' WHEN low < 0 THEN 'error' ELSE 'active' END AS status FROM nation
LEFT JOIN (SELECT s_nationkey, count(*) AS k, min(s_acctbal) AS low FROM supplier WHERE s_suppkey % 3 = 0 GROUP BY 1) ON s_nationkey = n_nationkey""")
def registry_status_left_join(spark, sf_dir):
    return _statuses(spark, sf_dir)


def _statuses(spark, sf_dir):
    done = table(spark, sf_dir, "supplier").where("s_suppkey % 3 = 0").groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(F.count(F.lit(1)).alias("k"), F.min("s_acctbal").alias("low"))
    n = table(spark, sf_dir, "nation").join(done, "n_nationkey", "left")
    status = F.when(F.col("k").isNull(), "pending").when(F.col("low") < 0, "error").otherwise("active")
    return n.select("n_nationkey", "n_name", F.coalesce("k", F.lit(0)).alias("vectors"), status.alias("status"))


@query("""WITH n AS (SELECT n_nationkey, r_name, coalesce(k, 0) AS vectors, CASE WHEN k IS NULL THEN 'pending' WHEN low < 0 THEN 'error' ELSE 'active' END AS status FROM nation JOIN region ON n_regionkey = r_regionkey
LEFT JOIN (SELECT s_nationkey, count(*) AS k, min(s_acctbal) AS low FROM supplier WHERE s_suppkey % 3 = 0 GROUP BY 1) ON s_nationkey = n_nationkey)
SELECT count(*) FILTER (status = 'active') AS active, count(*) FILTER (status = 'error') AS errors, 25 - count(*) + count(*) FILTER (status = 'pending') AS pending, CAST(sum(vectors) AS BIGINT) AS vectors, CAST(round(count(*) FILTER (status = 'active') / 25 * 100) AS BIGINT) AS percentage FROM n""")
def coverage_summary(spark, sf_dir):
    return V.summary(_statuses(spark, sf_dir), F.lit(25).cast("long"))


_EXPECTED = """x AS (SELECT CASE n_regionkey WHEN 0 THEN 'federal' WHEN 1 THEN 'state' WHEN 2 THEN 'county' ELSE 'municipal' END AS source_type, n_name AS name,
CASE n_regionkey WHEN 0 THEN 'US' WHEN 1 THEN 'TX' WHEN 2 THEN 'TX-48' || (200 + n_nationkey) ELSE 'TX-houston' END AS jurisdiction FROM nation)"""


def expected(spark, sf_dir):
    r = F.col("n_regionkey")
    kind = F.when(r == 0, "federal").when(r == 1, "state").when(r == 2, "county").otherwise("municipal")
    j = F.when(r == 0, "US").when(r == 1, "TX").when(r == 2, F.concat(F.lit("TX-48"), (F.col("n_nationkey") + 200).cast("string"))).otherwise("TX-houston")
    return table(spark, sf_dir, "nation").select(kind.alias("source_type"), F.col("n_name").alias("name"), j.alias("jurisdiction"))


@query(f"WITH {_DOCS}, {_EXPECTED}, i AS (SELECT DISTINCT jurisdiction AS j FROM d) SELECT source_type, count(*) AS expected, count(j) AS indexed, round(count(j) / count(*) * 100, 2) AS percentage FROM x LEFT JOIN i ON i.j = x.jurisdiction GROUP BY source_type")
def coverage_by_source(spark, sf_dir):
    return V.by_source(V.flags(expected(spark, sf_dir), V.indexed(documents(spark, sf_dir))))


@query(f"WITH {_DOCS}, {_EXPECTED} SELECT jurisdiction, source_type, name, 'No vectors indexed for ' || name AS reason FROM x WHERE jurisdiction NOT IN (SELECT jurisdiction FROM d)")
def coverage_gaps_anti(spark, sf_dir):
    return V.gaps(expected(spark, sf_dir), V.indexed(documents(spark, sf_dir)))


@query("""WITH a AS (SELECT c_nationkey AS k, count(*) AS v FROM customer WHERE c_nationkey <> 3 GROUP BY 1), b AS (SELECT s_nationkey AS k, count(*) * 15 AS v FROM supplier WHERE s_nationkey <> 7 GROUP BY 1)
SELECT * FROM (SELECT coalesce(a.k, b.k) AS nation, a.v AS want, b.v AS have, CASE WHEN b.v IS NULL THEN 'missing' WHEN a.v IS NULL THEN 'stale' WHEN abs(a.v - b.v) > 0.1 * a.v THEN 'mismatch' END AS issue FROM a FULL JOIN b ON a.k = b.k) WHERE issue IS NOT NULL""")
def sync_validation(spark, sf_dir):
    a = table(spark, sf_dir, "customer").where("c_nationkey <> 3").groupBy(F.col("c_nationkey").alias("nation")).agg(F.count(F.lit(1)).alias("vectors"))
    b = table(spark, sf_dir, "supplier").where("s_nationkey <> 7").groupBy(F.col("s_nationkey").alias("nation")).agg((F.count(F.lit(1)) * 15).alias("vectors"))
    return V.sync_issues(a, b, "nation")


@query(f"WITH {_DOCS} SELECT DISTINCT jurisdiction FROM d WHERE jurisdiction NOT IN ('US', 'TX-48201')")
def storage_gaps(spark, sf_dir):
    d = documents(spark, sf_dir)
    keys = d.where(F.col("jurisdiction").isin("US", "TX-48201")).select(F.concat(T.storage_prefix(F.col("jurisdiction")), F.col("doc_id").cast("string"), F.lit(".xml")).alias("key"))
    return V.missing_storage(d.select("jurisdiction").distinct(), keys).select("jurisdiction")


# --- parsing -------------------------------------------------------------------------------------------------------


@query("""SELECT page_id, list_aggregate(list_sort(list_distinct(regexp_extract_all(html, 'href="/([^"]*)"', 1))), 'string_agg', ' ') AS links, len(regexp_extract_all(html, 'href="/([^"]*)"', 1)) AS n_links FROM pages""")
def html_links(spark, sf_dir):
    found = F.regexp_extract_all("html", F.lit('href="/([^"]*)"'), F.lit(1))
    return table(spark, sf_dir, "pages").select("page_id", F.array_join(F.array_sort(F.array_distinct(found)), " ").alias("links"), F.size(found).cast("long").alias("n_links"))


@query(r"""WITH a AS (SELECT page_id, regexp_extract(html, '(?s)<article>(.*)</article>', 1) AS t FROM pages) SELECT page_id, regexp_extract(t, '(?s)<h1>(.*?)</h1>', 1) AS heading,
trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(t, '(?s)^.*?</h1>', ''), '</?(p|br)[^>]*>', chr(10), 'g'), '<[^>]*>', '', 'g'), '[ ' || chr(9) || ']+', ' ', 'g'), ' ' || chr(10)) AS body FROM a""")
def html_section_text(spark, sf_dir):
    p = table(spark, sf_dir, "pages").select("page_id", F.regexp_extract("html", "(?s)<article>(.*)</article>", 1).alias("t"))
    body = F.regexp_replace(F.regexp_replace(F.regexp_replace("t", "(?s)^.*?</h1>", ""), "</?(p|br)[^>]*>", "\n"), "<[^>]*>", "")
    return p.select("page_id", F.regexp_extract("t", "(?s)<h1>(.*?)</h1>", 1).alias("heading"), F.trim(F.regexp_replace(body, r"[ \t]+", " "), F.lit(" \n")).alias("body"))


_ANY = r"(?i)\([a-z0-9]+\)(?:\([a-z0-9]+\))?(?:\([a-z0-9]+\))?"


@query(rf"""WITH m AS (SELECT doc_id, regexp_extract_all(text, '{_ANY}') AS ids, string_split_regex(text, '{_ANY}')[2:] AS bodies FROM documents),
u AS (SELECT doc_id, unnest(ids) AS id, regexp_replace(unnest(bodies), '^\s+|\s+$', '', 'g') AS body, generate_subscripts(ids, 1) AS i FROM m)
SELECT doc_id, count(*) AS markers, string_agg(id, ' ' ORDER BY i) AS ids, CAST(sum(length(body)) AS BIGINT) AS n_chars FROM u WHERE length(body) > 5 GROUP BY doc_id""")
def subsection_markers(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", C.subsections(F.col("text"), anchored=False, least=5).alias("s")).where(F.size("s") > 0)
    n_chars = F.aggregate("s", F.lit(0).cast("long"), lambda acc, x: acc + F.length(x["text"]))
    return d.select("doc_id", F.size("s").cast("long").alias("markers"), F.array_join(F.transform("s", lambda x: x["id"]), " ").alias("ids"), n_chars.alias("n_chars"))


def _joined(rows: DataFrame, by: str, order: str, *parts: Column) -> DataFrame:
    """One text for each value of `by`: its rows' parts in order."""
    each = F.sort_array(F.collect_list(F.struct(F.col(order), F.concat(*parts).alias("x"))))
    return rows.groupBy(by).agg(F.array_join(F.transform(each, lambda s: s["x"]), "").alias("page"))


@query("SELECT p_brand, p_brand AS chapter, p_partkey || '.' AS section, p_name AS heading, p_type || chr(10) || chr(10) || '- ' || p_size || chr(10) || '> ' || p_name AS text FROM part")
def markdown_sections(spark, sf_dir):
    p, lit = table(spark, sf_dir, "part"), F.lit
    size = F.col("p_size").cast("string")
    body = _joined(p, "p_brand", "p_partkey", lit("## Sec. "), F.col("p_partkey").cast("string"), lit(". "), "p_name", lit("\n"), "p_type", lit("\n\n\n* "), size, lit("\n> "), "p_name", lit("\n\n"))
    number = F.regexp_extract("p_brand", r"(\d+)$", 1)
    pages = body.select("p_brand", F.concat(lit("# Chapter "), number, lit(" Of brands\nLost text\n\n"), "page").alias("markdown"))
    return M.ordinances(pages, "p_brand").withColumn("chapter", F.concat(lit("Brand#"), "chapter"))


@query("SELECT p_brand, array_to_string(list_sort(list_distinct(list(p_size))), ',') AS chapters, array_to_string(list_transform(list_sort(list_distinct(list(p_partkey % 97))), lambda x: '12.' || x), ',') AS sections FROM part GROUP BY p_brand")
def statute_links(spark, sf_dir):
    size, n = F.col("p_size").cast("string"), (F.col("p_partkey") % 97).cast("string")
    html = _joined(table(spark, sf_dir, "part"), "p_brand", "p_partkey", F.lit('<a href="/HS/htm/HS.'), size, F.lit('.htm">c</a><a href="HS.12.'), n, F.lit('.htm">s</a><a href="HS.13.1.htm">o</a>'))
    page = F.col("page")
    return html.select("p_brand", F.array_join(H.code_chapters(page, "HS"), ",").alias("chapters"), F.array_join(H.chapter_sections(page, "HS", "12"), ",").alias("sections"))


@query("SELECT p_brand, array_to_string(list_sort(list_distinct(list(p_size))), ',') AS chapters, array_to_string(list_transform(list_sort(list_distinct(list(p_partkey % 89 + 100))), lambda x: '5.' || x), ',') AS rules FROM part GROUP BY p_brand")
def rule_links(spark, sf_dir):
    size, n = F.col("p_size").cast("string"), (F.col("p_partkey") % 89 + 100).cast("string")
    chapter = F.when(F.col("p_size") % 2 == 0, F.concat(F.lit('<a href="?ti=1&ch='), size, F.lit('">'))).otherwise(F.concat(F.lit("<b>Chapter "), size, F.lit("</b>")))
    rule = F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit('<a href="?x=1&rl=5.'), n, F.lit('">'))).otherwise(F.concat(F.lit("<i>§ 5."), n, F.lit("</i>")))
    html = _joined(table(spark, sf_dir, "part"), "p_brand", "p_partkey", chapter, rule)
    return html.select("p_brand", F.array_join(H.rule_chapters(F.col("page")), ",").alias("chapters"), F.array_join(H.chapter_rules(F.col("page"), "5"), ",").alias("rules"))


@query("SELECT p_partkey, p_name AS heading, '(a) ' || p_type || ' (b)(1) ' || p_brand || ' tail (c) x' AS text, CASE WHEN length(p_type) > 5 THEN '(a)=' || p_type || '|' ELSE '' END || '(b)(1)=' || p_brand || ' tail' AS subsections FROM part")
def statute_pages(spark, sf_dir):
    html = F.concat(F.lit('<html><body><h2 class="section-heading">'), "p_name", F.lit('</h2><div class="section-text">(a) '), "p_type", F.lit(" (b)(1) "), "p_brand", F.lit(" tail (c) x</div></body></html>"))
    rows = H.parse_statutes(table(spark, sf_dir, "part").select("p_partkey", html.alias("html")))[0]
    return rows.select("p_partkey", "heading", "text", _pairs("subsections"))


@query("SELECT p_partkey, p_name AS heading, '(a)=First ' || p_type || '|(b)(1)(A)=Second ' || p_brand || '|(c)=third' AS subsections FROM part")
def rule_pages(spark, sf_dir):
    html = F.concat(F.lit('<div class="rule-title">§5.31 - '), "p_name", F.lit('</div><div class="rule-text"><p>(a) First '), "p_type", F.lit(" </p><p>(b)(1)(A) Second "), "p_brand", F.lit(" (c)(B) third</p></div>"))
    rows = H.parse_rules(table(spark, sf_dir, "part").select("p_partkey", html.alias("html")))[0]
    return rows.select("p_partkey", "heading", _pairs("subsections"))


def _pairs(name: str) -> Column:
    return F.array_join(F.transform(name, lambda s: F.concat(s["id"], F.lit("="), s["text"])), "|").alias(name)


@query("""SELECT 1 AS title, 'General' AS title_name, p_size AS part, 'Rules of ' || p_size AS part_name, p_size || '.' || p_partkey AS section, p_name AS heading, p_type || chr(10) || chr(10) || p_brand AS text FROM part""")
def regulation_xml(spark, sf_dir):
    p, lit, size = table(spark, sf_dir, "part"), F.lit, F.col("p_size").cast("string")
    number = F.concat(size, lit("."), F.col("p_partkey").cast("string"))
    body = _joined(p, "p_size", "p_partkey", lit('<DIV8 TYPE="SECTION" N="'), number, lit('"><HEAD>§ '), number, lit(" "), "p_name", lit("</HEAD><FP>"), "p_brand", lit("</FP><P>"), "p_type", lit("</P></DIV8>"))
    head = F.concat(lit('<ECFR><DIV1 N="1" TYPE="TITLE"><HEAD>Title 1—General</HEAD><DIV3 TYPE="CHAPTER"><DIV5 TYPE="PART" N="'), size, lit('"><HEAD>PART '), size, lit("—Rules of "), size, lit("</HEAD>"))
    files_ = body.select(F.concat(head, "page", lit("</DIV5></DIV3></DIV1></ECFR>")).alias("xml"))
    return X.parse(files_)[0]


@query("""SELECT p_partkey, 'https://statutes.capitol.texas.gov/Docs/HS/htm/HS.' || p_size || '.' || p_partkey || '.htm' AS statute,
'https://texreg.sos.state.tx.us/public/readtac$ext.TacPage?sl=R&app=9&p_dir=&p_rloc=' || p_size || '&p_tloc=&p_ploc=&pg=1&p_tac=&ti=' || p_size || '&pt=&ch=5&rl=5.' || p_partkey AS rule FROM part""")
def source_urls(spark, sf_dir):
    n = F.col("p_partkey").cast("string")
    return table(spark, sf_dir, "part").select("p_partkey", T.statute_url(F.lit("HS"), F.concat(F.col("p_size").cast("string"), F.lit("."), n)).alias("statute"), T.rule_url(F.col("p_size"), F.lit("5"), F.concat(F.lit("5."), n)).alias("rule"))


@query("SELECT vec_id, (len(embedding) - CASE WHEN vec_id % 5 = 0 THEN 1 ELSE 0 END) || ' dimensions, the index has 64' AS reason FROM embeddings WHERE vec_id % 5 = 0")
def index_dimensions(spark, sf_dir):
    v = table(spark, sf_dir, "embeddings")
    cut = F.when(F.col("vec_id") % 5 == 0, F.slice("embedding", 1, 63)).otherwise(F.col("embedding"))
    return S.dimension_checked(v.select("vec_id", cut.alias("embedding")), 64)[1].select("vec_id", "reason")


# --- answers -------------------------------------------------------------------------------------------------------

_ANSWERS = "a AS (SELECT conv_id, turn, text || ' [' || (turn % 4 + 1) || '] [' || (turn + 1) || ']' AS answer FROM conversations WHERE role = 'assistant')"


def answers(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").where("role = 'assistant'")
    ref = lambda x: F.concat(F.lit(" ["), x.cast("string"), F.lit("]"))
    return c.select("conv_id", "turn", F.concat("text", ref(F.col("turn") % 4 + 1), ref(F.col("turn") + 1)).alias("answer"))


@query(f"""WITH {_DOCS} SELECT doc_id, source, CAST(row_number() OVER (PARTITION BY source ORDER BY doc_id) AS INTEGER) AS position, citation FROM d""")
def prompt_numbering(spark, sf_dir):
    return A.numbered(documents(spark, sf_dir), [F.col("doc_id")], "source").select("doc_id", "source", F.col("position").cast("int").alias("position"), "citation")


@query("""WITH n AS (SELECT conv_id, role || ' ' || turn AS citation, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS position FROM conversations)
SELECT conv_id, string_agg('[' || position || '] ' || citation || ' (US, federal)', chr(10) ORDER BY position) AS citations FROM n GROUP BY conv_id""")
def citation_list(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.concat("role", F.lit(" "), F.col("turn").cast("string")).alias("citation"), F.lit("US").alias("jurisdiction"), F.lit("federal").alias("source_type"))
    return A.citation_list(A.numbered(c, [F.col("turn")], "conv_id"), "conv_id")


_REFS = "r AS (SELECT conv_id, turn, list_transform(regexp_extract_all(answer, '\\[(\\d+)\\]', 1), lambda x: CAST(x AS INTEGER)) AS refs FROM a)"


@query(f"""WITH {_ANSWERS}, {_REFS}, {_DOCS}, x AS (SELECT DISTINCT conv_id, turn, unnest(refs) AS position FROM r)
SELECT conv_id, turn, position, citation, CASE WHEN length(text) > 200 THEN text[1:200] || '...' ELSE text END AS excerpt FROM x JOIN d ON d.doc_id = x.conv_id * 5 + position - 1 WHERE position BETWEEN 1 AND 5""")
def citation_extract(spark, sf_dir):
    docs = documents(spark, sf_dir)
    sources = docs.select(F.expr("doc_id div 5").alias("conv_id"), (F.col("doc_id") % 5 + 1).cast("int").alias("position"), "citation", "text")
    return A.cited(answers(spark, sf_dir), sources, "conv_id", "turn").select("conv_id", "turn", "position", "citation", "excerpt")


@query(f"""WITH {_ANSWERS}, {_REFS} SELECT conv_id, turn, array_to_string(list_sort(list_distinct(list_filter(refs, lambda x: x BETWEEN 1 AND 4))), ',') AS valid, array_to_string(list_distinct(list_filter(refs, lambda x: x < 1 OR x > 4)), ',') AS invalid FROM r""")
def citation_validate(spark, sf_dir):
    n, t = F.lit(4), F.col("answer")
    join = lambda x: F.array_join(x.cast("array<string>"), ",")
    return answers(spark, sf_dir).select("conv_id", "turn", join(A.valid_references(t, n)).alias("valid"), join(A.invalid_references(t, n)).alias("invalid"))


@query("""SELECT conv_id, turn, unnest(['federal', 'state']) AS level, unnest(['Federal', 'Texas']) AS name, unnest([trim(regexp_replace(replace(text, '#', ''), '\\s+', ' ', 'g')), 'See above.']) AS content FROM conversations WHERE role = 'assistant'""")
def answer_sections(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").where("role = 'assistant'")
    text = F.concat(F.lit("### Federal Requirements\n"), F.regexp_replace(F.replace("text", F.lit("#"), F.lit("")), r"\s+", " "), F.lit("\n### State Texas Requirements\nSee above.\n"))
    return A.sections(c.select(F.struct("conv_id", "turn").alias("k"), text.alias("answer")), "k").select("k.conv_id", "k.turn", "level", "name", "content")


# --- keyed tables --------------------------------------------------------------------------------------------------


@query("SELECT user_id, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def upsert_last_write_wins(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "value")
    return S.upsert(e.where("event_id % 2 = 0"), e.where("event_id % 2 = 1"), ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "value")


@query("SELECT event_id, event_type FROM events WHERE NOT (event_type IN ('error', 'click') AND user_id < 75)")
def delete_by_filter(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return S.delete_where(e, R.compile_filter({"event_type": {"$in": ["error", "click"]}}) & (F.col("user_id") < 75)).select("event_id", "event_type")


@query("SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 'new' WHEN doc_id % 3 = 0 THEN 'changed' ELSE 'unchanged' END AS state FROM documents")
def change_detection(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("digest"))
    cached = d.where("doc_id % 5 <> 0").withColumn("digest", F.when(F.col("doc_id") % 3 == 0, F.lit("old")).otherwise(F.col("digest")))
    return S.changed(d, cached, ["doc_id"]).select("doc_id", "state")


@query("SELECT event_id, user_id FROM events WHERE event_id > (SELECT max(event_id) / 2 FROM events) AND user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'purchase' AND value > 90)")
def resume_after_checkpoint(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    last = e.agg(F.max("event_id") / 2).first()[0]
    return S.remaining(S.after(e, "event_id", last), e.where("event_type = 'purchase' and value > 90"), "user_id").select("event_id", "user_id")


@query("""WITH o AS (SELECT s_nationkey AS k, 'active' AS status, count(*) AS v FROM supplier GROUP BY 1), n AS (SELECT n_nationkey AS k, CASE WHEN n_nationkey % 3 = 0 THEN 'partial' ELSE 'pending' END AS status, CASE WHEN n_nationkey % 2 = 0 THEN 0 ELSE n_nationkey * 10 END AS v FROM nation WHERE n_nationkey > 4)
SELECT coalesce(o.k, n.k) AS nation, coalesce(CASE n.status WHEN 'partial' THEN 'error' ELSE n.status END, o.status) AS status, CAST(coalesce(nullif(n.v, 0), o.v, 0) AS BIGINT) AS vectors FROM o FULL JOIN n ON o.k = n.k""")
def status_upsert(spark, sf_dir):
    o = table(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("nation")).agg(F.lit("active").alias("status"), F.count(F.lit(1)).alias("vectors"))
    k = F.col("n_nationkey")
    n = table(spark, sf_dir, "nation").where(k > 4).select(k.alias("nation"), F.when(k % 3 == 0, "partial").otherwise("pending").alias("status"), F.when(k % 2 == 0, 0).otherwise(k * 10).cast("long").alias("vectors"))
    return S.merge_status(o, n, "nation")


# --- conversations -------------------------------------------------------------------------------------------------


def _threads(spark, sf_dir):
    m = table(spark, sf_dir, "conversations")
    return m.groupBy("conv_id").agg(F.max("turn").alias("updated"), F.count(F.lit(1)).alias("messages")), m


@query("""SELECT conv_id, updated, messages, preview[1:100] AS preview FROM (SELECT conv_id, max(turn) AS updated, count(*) AS messages, arg_min(text, turn) AS preview FROM conversations GROUP BY 1) ORDER BY updated DESC, conv_id DESC LIMIT 20""")
def conversation_history(spark, sf_dir):
    threads, messages = _threads(spark, sf_dir)
    return S.history(threads, messages, "conv_id")


@query("SELECT conv_id, turn, role, length(text) AS n_chars, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS position FROM conversations")
def conversation_messages(spark, sf_dir):
    rows = S.batches(table(spark, sf_dir, "conversations"), ["turn"], 100, ["conv_id"])
    return rows.select("conv_id", "turn", "role", F.length("text").cast("long").alias("n_chars"), (F.col("position") + 1).cast("long").alias("position"))


@query("SELECT role, max(conv_id) AS conv_id, CASE WHEN length(arg_max(text, conv_id * 1000 + turn)) > 50 THEN arg_max(text, conv_id * 1000 + turn)[1:50] || '...' ELSE arg_max(text, conv_id * 1000 + turn) END AS title FROM conversations GROUP BY role")
def latest_conversation(spark, sf_dir):
    m = table(spark, sf_dir, "conversations").select("role", "conv_id", "turn", "text")
    return S.last_write(m, ["role"], ["conv_id", "turn"]).select("role", "conv_id", S.new_conversation_title(F.col("text")).alias("title"))


@query("SELECT conv_id, turn FROM conversations WHERE conv_id NOT IN (SELECT conv_id FROM conversations WHERE role = 'system')")
def cascade_delete(spark, sf_dir):
    threads, messages = _threads(spark, sf_dir)
    gone = messages.where("role = 'system'").select("conv_id")
    return S.cascade_delete(threads, messages, gone, "conv_id")[1].select("conv_id", "turn")


# --- batches -------------------------------------------------------------------------------------------------------


@query("SELECT source, CAST((rn - 1) // 64 AS BIGINT) AS batch, count(*) AS rows, CAST(min(doc_id) AS BIGINT) AS first_doc FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn FROM documents) GROUP BY 1, 2")
def embed_batches(spark, sf_dir):
    d = S.batches(table(spark, sf_dir, "documents").select("source", "doc_id"), ["doc_id"], 64, ["source"])
    return d.groupBy("source", "batch").agg(F.count(F.lit(1)).alias("rows"), F.min("doc_id").alias("first_doc"))


@query("SELECT source, CAST((rn - 1) // 100 AS BIGINT) AS batch, count(*) AS rows, count(vec_id) AS with_vector, count(*) - count(vec_id) AS missing FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn FROM documents) LEFT JOIN embeddings ON vec_id = doc_id GROUP BY 1, 2")
def upsert_batch_join(spark, sf_dir):
    d = S.batches(table(spark, sf_dir, "documents").select("source", "doc_id"), ["doc_id"], 100, ["source"])
    j = d.join(table(spark, sf_dir, "embeddings").select("vec_id"), F.col("vec_id") == F.col("doc_id"), "left")
    return j.groupBy("source", "batch").agg(F.count(F.lit(1)).alias("rows"), F.count("vec_id").alias("with_vector"), (F.count(F.lit(1)) - F.count("vec_id")).alias("missing"))


@query("SELECT user_id, count(*) AS runs, round(sum(value), 4) AS value, bool_and(event_type <> 'error') AS success, count(*) FILTER (event_type = 'error') AS failed FROM events GROUP BY user_id")
def batch_rollup(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.groupBy("user_id").agg(F.count(F.lit(1)).alias("runs"), F.round(F.sum("value"), 4).alias("value"), F.bool_and(F.col("event_type") != "error").alias("success"), F.count_if(F.col("event_type") == "error").alias("failed"))


# --- families, lookups and lists -----------------------------------------------------------------------------------


@query(f"""WITH {_SECTIONS}, n AS (SELECT s.*, p_name FROM s JOIN part USING (p_partkey)) SELECT 'tx-statute-HS-' || part || '-' || section || '-0' AS chunk_id, 'tx-statute-HS' AS source_id, 'Tex. Health & Safety Code Ann. § ' || section || ' (West 2026)' AS citation, 0 AS chunk_index, 1 AS total_chunks FROM n
UNION ALL SELECT 'county-fort-bend-' || part || '-' || section || '-0', 'county-fort-bend', 'Fort Bend County, Tex., Code of Ordinances sect. ' || section || ' (2026)', 0, 1 FROM n
UNION ALL SELECT 'cfr-' || title || '-' || part || '-' || section || '-0', 'cfr-title-' || title, CASE WHEN section <> 'abc' THEN title || ' C.F.R. § ' || section END, 0, 1 FROM n""")
def family_chunks(spark, sf_dir):
    s = sections(spark, sf_dir).join(table(spark, sf_dir, "part").select("p_partkey", F.col("p_name").alias("text")), "p_partkey")
    part = F.col("part").cast("string")
    code = s.select(F.lit("HS").alias("code"), F.lit("Health & Safety Code").alias("code_name"), F.lit("Health & Safety Code").alias("cited_as"), part.alias("chapter"), "section", "text")
    county = s.select(F.lit("Fort Bend").alias("county"), F.lit("Code of Ordinances").alias("code_name"), part.alias("chapter"), "section", "text")
    federal = s.select(F.col("title").cast("string").alias("title"), F.lit("I").alias("chapter"), part.alias("part"), "section", "text")
    each = [C.family_chunks(d, f, 2026).select("chunk_id", "source_id", "citation", "chunk_index", "total_chunks") for d, f in ((code, "tx-statute"), (county, "county"), (federal, "cfr"))]
    return each[0].unionByName(each[1]).unionByName(each[2])


def _tokens_sql(x: str) -> str:
    return f"(CASE WHEN length({x}) = 0 THEN 0 ELSE CAST(ceil(ceil(length({x}) / 4.0) * 1.1::DOUBLE) AS BIGINT) END)"


@query(f"""WITH RECURSIVE {_DOCS}, q AS (SELECT doc_id, string_split_regex(replace(text, chr(10), chr(10) || chr(10)), '\\n\\n+') AS p FROM d WHERE {_tokens_sql("replace(text, chr(10), chr(10) || chr(10))")} > 1500),
z AS (SELECT doc_id, p, list_transform(p, lambda x: {_tokens_sql("x")}) AS n FROM q),
r AS (SELECT doc_id, p, n, 1 AS i, 1 AS start, '' AS head, n[1] AS held, CAST(NULL AS INTEGER) AS first, CAST(NULL AS INTEGER) AS last, '' AS before FROM z
 UNION ALL SELECT doc_id, p, n, i + 1, CASE WHEN full_ THEN i + 1 ELSE start END, CASE WHEN full_ THEN fresh ELSE head END, CASE WHEN full_ THEN {_tokens_sql("fresh")} ELSE held END + n[i + 1], CASE WHEN full_ THEN start END, CASE WHEN full_ THEN i END, head
 FROM (SELECT *, held + n[i + 1] > 1500 AS full_, array_to_string(list_concat(CASE WHEN j0 = start AND head <> '' AND list_sum(n[start:i]) + {_tokens_sql("head")} <= 225 THEN [head] ELSE [] END,
  CASE WHEN j0 IS NULL THEN [] ELSE list_filter(p[j0:i], lambda x: x <> '') END), chr(10) || chr(10)) AS fresh
  FROM (SELECT *, list_filter(range(start, i + 1), lambda j: list_sum(n[j:i]) <= 225)[1] AS j0 FROM r WHERE i < len(p)))),
c AS (SELECT doc_id, p, first, last, before FROM r WHERE first IS NOT NULL UNION ALL SELECT doc_id, p, start, len(p), head FROM r WHERE i = len(p))
SELECT CAST(doc_id AS VARCHAR) AS section, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY last) - 1 AS INTEGER) AS chunk_index, CAST(count(*) OVER (PARTITION BY doc_id) AS INTEGER) AS total_chunks,
md5(array_to_string(list_concat(CASE WHEN before <> '' THEN [before] ELSE [] END, p[first:last]), chr(10) || chr(10))) AS digest FROM c""")
def family_long_chunks(spark, sf_dir):
    double = F.regexp_replace("text", "\n", "\n\n")
    none = F.array().cast("array<struct<id:string,text:string>>")
    d = documents(spark, sf_dir).select(F.lit("Harris").alias("county"), F.lit("Code").alias("code_name"), F.lit("1").alias("chapter"), F.col("doc_id").cast("string").alias("section"), double.alias("text"), none.alias("subsections"))
    return C.family_chunks(d.where(T.tokens(F.col("text")) > 1500), "county", 2026).select("section", "chunk_index", "total_chunks", F.md5("chunk_text").alias("digest"))


@query(_STATS[: _STATS.rindex("SELECT source_type")] + " SELECT doc_id, 'chunk of ' || tokens || ' tokens is above the limit of 1500' AS reason FROM w WHERE tokens > 1500")
def chunk_rejects(spark, sf_dir):
    d = documents(spark, sf_dir).select("doc_id", "source_type", "text")
    return C.oversize(C.chunk(d, pattern=PARAGRAPH))[1].select("doc_id", "reason")


@query(f"WITH {_DOCS} SELECT doc_id, tokens || ' tokens are above the limit of 8191' AS reason FROM d WHERE tokens > 8191")
def embedding_rejects(spark, sf_dir):
    return P.embeddable(table(spark, sf_dir, "documents"))[1].select("doc_id", "reason")


@query(r"""SELECT page_id, array_to_string(list_sort(list_distinct(list_transform(regexp_extract_all(html, 'href="[^"]*?(\d+)"', 1), lambda x: CAST(x AS INTEGER)))), ',') AS numbers FROM pages""")
def discovered_numbers(spark, sf_dir):
    found = H.discovered(F.col("html"), r'href="[^"]*?(\d+)"')
    return table(spark, sf_dir, "pages").select("page_id", F.array_join(F.transform(found, lambda x: x.cast("int").cast("string")), ",").alias("numbers"))


@query(f"""WITH {_SECTIONS} SELECT p_partkey, array_to_string(list_filter([CASE WHEN length(p_name) < 10 THEN 'short text' END, CASE WHEN p_brand = 'Brand#11' THEN 'missing heading' END], lambda x: x IS NOT NULL), ',') AS issues,
length(p_name) >= 10 AS is_valid FROM s JOIN part USING (p_partkey)""")
def section_issues(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", F.col("p_name").alias("text"), F.when(F.col("p_brand") != "Brand#11", F.col("p_brand")).alias("heading"))
    rows = M.issues(sections(spark, sf_dir).join(p, "p_partkey"))
    return rows.select("p_partkey", F.array_join("issues", ",").alias("issues"), "is_valid")


@query("SELECT user_id AS title, count(DISTINCT event_id) AS parts, round((epoch_ms(TIMESTAMP '2024-01-31') - epoch_ms(max(ts))) / 3600000, 1) AS age_hours, epoch_ms(TIMESTAMP '2024-01-31') - epoch_ms(max(ts)) >= 2 * 86400000 AS stale FROM events GROUP BY 1")
def cache_status(spark, sf_dir):
    held = table(spark, sf_dir, "events").select(F.col("user_id").alias("title"), F.col("event_id").alias("part"), F.col("ts").cast("timestamp").alias("stored_at"))
    return pipelines.cache_status(held, F.lit("2024-01-31").cast("timestamp"), 2)


@query("SELECT c_mktsegment AS platform, count(*) AS sources FROM customer WHERE c_acctbal > 0 GROUP BY 1")
def platform_stats(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("platform"), (F.col("c_acctbal") > 0).alias("enabled"))
    return registry.platform_stats(c, enabled_only=True)


@query("SELECT source, count(*) AS files, CAST(sum(strlen(text)) AS BIGINT) AS bytes FROM documents GROUP BY source")
def storage_stats(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("source", F.octet_length("text").cast("long").alias("size"))
    return files.storage_stats(d, "source")


@query("SELECT n_nationkey, n_name FROM nation WHERE lower(n_name) = lower('France') OR n_nationkey = 7")
def registry_lookup(spark, sf_dir):
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return registry.lookup(n, "n_name", "france", ignore_case=True).union(registry.lookup(n, "n_nationkey", 7)).distinct()


@query("SELECT conv_id, turn FROM conversations WHERE role = 'user' AND turn = 2")
def filtered_list(spark, sf_dir):
    return S.matching(table(spark, sf_dir, "conversations"), role="user", turn=2, conv_id=None).select("conv_id", "turn")


@query("SELECT coalesce(c_custkey, s_suppkey) AS key, coalesce(CASE WHEN s_suppkey % 2 = 0 THEN s_name END, c_name) AS name, coalesce(s_nationkey, c_nationkey) AS nation FROM customer FULL JOIN supplier ON c_custkey = s_suppkey")
def patched_rows(spark, sf_dir):
    old = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"))
    new = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("key"), F.when(F.col("s_suppkey") % 2 == 0, F.col("s_name")).alias("name"), F.col("s_nationkey").alias("nation"))
    return S.patched(old, new, "key")


@query(f"WITH {_DOCS} SELECT jurisdiction, count(*) AS vectors FROM d GROUP BY 1")
def indexed_jurisdictions(spark, sf_dir):
    return V.indexed(documents(spark, sf_dir))


@query("SELECT 'supplier' AS family, s_suppkey AS key, NULL AS segment FROM supplier UNION ALL SELECT 'customer', c_custkey, c_mktsegment FROM customer")
def source_union(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").select(F.lit("supplier").alias("family"), F.col("s_suppkey").alias("key"))
    c = table(spark, sf_dir, "customer").select(F.lit("customer").alias("family"), F.col("c_custkey").alias("key"), F.col("c_mktsegment").alias("segment"))
    return s.unionByName(c, allowMissingColumns=True)


# --- citations, links, crawls and runs -----------------------------------------------------------------------------


@query("""SELECT o_orderkey, 'Harris County Commissioners Court Order No. ' || o_custkey || ' (' || strftime(o_orderdate, '%b. %-d, %Y') || ')' AS court_order, o_custkey || ' Tex. Admin. Code § 5.' || o_orderkey || ' (2026)' AS rule,
'Plano, Tex., Code of Ordinances sect. ' || o_orderkey || ' (2026)' AS ordinance FROM orders""")
def local_citations(spark, sf_dir):
    key, n = F.col("o_orderkey").cast("string"), F.col("o_custkey")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", T.order_citation(F.lit("Harris"), n.cast("string"), F.col("o_orderdate")).alias("court_order"), T.rule_citation(n, F.concat(F.lit("5."), key), 2026).alias("rule"), T.city_citation(F.lit("Plano"), key, 2026).alias("ordinance")
    )


@query("""WITH c AS (SELECT c_custkey, CASE c_nationkey % 3 WHEN 0 THEN 'municode' WHEN 1 THEN 'amlegal' ELSE 'elaws' END AS platform, CASE WHEN c_custkey % 7 > 0 THEN c_custkey || ' ' || c_name END AS section FROM customer)
SELECT c_custkey, 'http://h' || CASE WHEN section IS NULL THEN '' ELSE CASE platform WHEN 'municode' THEN '?nodeId=' WHEN 'amlegal' THEN '/codes/overview?nodeId=' ELSE '#' END || url_encode(section) END AS county,
'http://h' || CASE WHEN section IS NULL THEN '' ELSE CASE platform WHEN 'municode' THEN '?nodeId=' ELSE '#' END || url_encode(section) END AS city FROM c""")
def ordinance_links(spark, sf_dir):
    at = F.col("c_nationkey") % 3
    platform = F.when(at == 0, "municode").when(at == 1, "amlegal").otherwise("elaws")
    section = F.when(F.col("c_custkey") % 7 > 0, F.concat(F.col("c_custkey").cast("string"), F.lit(" "), "c_name"))
    links = [T.ordinance_url(family, platform, F.lit("http://h"), section).alias(name) for family, name in (("county", "county"), ("municipal", "city"))]
    return table(spark, sf_dir, "customer").select("c_custkey", *links)


@query(r"""WITH p AS (SELECT page_id, chr(9) || ' ' || replace(html, '<', chr(10) || chr(10) || '<') || chr(13) || chr(10) AS t FROM pages)
SELECT page_id, trim(regexp_replace(regexp_replace(replace(t, chr(13) || chr(10), chr(10)), '[ \t]+', ' ', 'g'), '\n{3,}', chr(10) || chr(10), 'g'), ' ' || chr(10)) AS cleaned FROM p""")
def cleaned_markdown(spark, sf_dir):
    text = F.concat(F.lit("\t "), F.replace(F.col("html"), F.lit("<"), F.lit("\n\n<")), F.lit("\r\n"))
    return table(spark, sf_dir, "pages").select("page_id", T.clean_markdown(text).alias("cleaned"))


@query("""WITH f AS (SELECT o_orderkey, o_orderkey % 6 AS k FROM orders) SELECT o_orderkey, CASE k WHEN 0 THEN 404 WHEN 1 THEN 429 WHEN 2 THEN 401 WHEN 3 THEN 500 WHEN 4 THEN 204 ELSE 200 END AS http FROM f""")
def fetch_codes(spark, sf_dir):
    k = F.col("o_orderkey") % 6
    error = F.when(k == 0, "not found").when(k == 1, "Error: Rate limit").when(k == 2, "HTTP 403").when(k == 3, "TimeoutError: ")
    status = F.when(k == 0, "missing").when(k < 4, "failed").otherwise("ok")
    pages = table(spark, sf_dir, "orders").select("o_orderkey", status.alias("status"), error.alias("error"), F.when(k == 4, " \n").when(k == 5, "text").alias("body"))
    return fetch.typed(pages).select("o_orderkey", "http")


@query("""WITH s AS (SELECT c_nationkey AS nation, count(*) AS n, count(*) FILTER (c_acctbal > 5000) AS k FROM customer WHERE c_nationkey > 2 GROUP BY 1),
w AS (SELECT n_nationkey AS nation, CASE WHEN n IS NULL THEN 'no sections' WHEN k = 0 THEN 'all ' || n || ' sections failed' WHEN k < n * 0.5 THEN 'only ' || k || ' of ' || n || ' sections are valid' END AS warning FROM nation LEFT JOIN s ON n_nationkey = nation)
SELECT nation, warning FROM w WHERE warning IS NOT NULL""")
def section_warnings(spark, sf_dir):
    c = table(spark, sf_dir, "customer").where("c_nationkey > 2")
    rows = c.select(F.col("c_nationkey").alias("nation"), F.lit("1").alias("section"), F.lit("h").alias("heading"), F.when(F.col("c_acctbal") > 5000, "text that is long enough").otherwise("short").alias("text"))
    return M.warnings(table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("nation")), M.issues(rows), "nation")


@query(f"WITH {_DOCS} SELECT source_type, count(*) AS total_chunks, CAST(sum(tokens) AS BIGINT) AS total_tokens, CAST(floor(avg(tokens) + 0.5) AS BIGINT) AS avg_tokens, min(tokens) AS min_tokens, max(tokens) AS max_tokens, count(DISTINCT (source, lang)) AS sections, count(*) FILTER (doc_id % 3 = 0) AS split_sections FROM d GROUP BY 1")
def chunk_section_stats(spark, sf_dir):
    d = documents(spark, sf_dir).withColumns({"chunk_text": F.col("text"), "total_chunks": F.lit(2), "chunk_index": (F.col("doc_id") % 3).cast("int")})
    return C.stats(d, "source_type", section=("source", "lang"), rounded=True)


@query("""WITH c AS (SELECT c_nationkey AS id, count(*) AS chunks FROM customer GROUP BY 1), v AS (SELECT c_nationkey AS id, count(*) AS vectors FROM customer WHERE c_acctbal > 0 AND c_nationkey <> 4 GROUP BY 1),
f AS (SELECT c_nationkey AS id, count(*) AS failed FROM customer WHERE (c_acctbal <= 0 AND c_nationkey % 2 = 0) OR c_nationkey = 4 GROUP BY 1),
r AS (SELECT CAST(n_nationkey AS VARCHAR) AS source_id, coalesce(chunks, 0) AS chunks, coalesce(vectors, 0) AS vectors, coalesce(failed, 0) AS failed FROM nation LEFT JOIN c ON c.id = n_nationkey LEFT JOIN v ON v.id = n_nationkey LEFT JOIN f ON f.id = n_nationkey)
SELECT *, CASE WHEN failed = 0 THEN 'active' WHEN vectors > 0 THEN 'partial' ELSE 'error' END AS status FROM r""")
def run_rollup(spark, sf_dir):
    c = table(spark, sf_dir, "customer").withColumn("source_id", F.col("c_nationkey").cast("string"))
    sources = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("string").alias("source_id"))
    lost = c.where("(c_acctbal <= 0 AND c_nationkey % 2 = 0) OR c_nationkey = 4")
    return pipelines.rollup(c, c.where("c_acctbal > 0 AND c_nationkey <> 4"), lost, sources)[0]


@query("SELECT conv_id, turn, CASE WHEN length(text) > 50 THEN substr(text, 1, 50) || '...' ELSE text END AS title FROM conversations WHERE role = 'user'")
def conversation_titles(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").where("role = 'user'")
    return c.select("conv_id", "turn", S.new_conversation_title(F.col("text")).alias("title"))


@query("""WITH e AS (SELECT event_id, user_id FROM events) SELECT event_id FROM e WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey < 20)""")
def remaining_after_done(spark, sf_dir):
    done = table(spark, sf_dir, "customer").where("c_nationkey < 20").select(F.col("c_custkey").alias("user_id"))
    return S.remaining(table(spark, sf_dir, "events").select("event_id", "user_id"), done, "user_id").select("event_id")


_RUNS = "regexp_extract_all(section, '[0-9]+|[^0-9]+')"


_DIGITS = "coalesce(nullif(ltrim(x, '0'), ''), '0')"


@query(f"""WITH p AS (SELECT p_partkey, (p_size % 7) || '.' || (p_partkey % 113) || lower(substr(p_type, 1, p_size % 3)) AS section FROM part)
SELECT p_partkey, section, array_to_string([CASE WHEN regexp_matches(x, '^[0-9]') THEN '0' || lpad(CAST(length({_DIGITS}) AS VARCHAR), 6, '0') || {_DIGITS} ELSE '1' || x || chr(1) END for x in {_RUNS}], '') AS place,
rank() OVER (ORDER BY split_part(section, '.', 1)::INT, regexp_extract(split_part(section, '.', 2), '^[0-9]+')::INT, regexp_extract(section, '[a-z]*$')) AS position FROM p""")
def natural_order(spark, sf_dir):
    """Section numbers by their keys, and each row's place among all of them."""
    section = F.concat((F.col("p_size") % 7).cast("string"), F.lit("."), (F.col("p_partkey") % 113).cast("string"), F.lower(F.substring(F.col("p_type"), F.lit(1), (F.col("p_size") % 3).cast("int"))))
    rows = table(spark, sf_dir, "part").select("p_partkey", section.alias("section")).withColumn("place", T.natural_key(F.col("section")))
    return S.ranked(rows, "place").select("p_partkey", "section", "place", F.col("rank").alias("position"))


# --- stores, joins of many questions, streams ----------------------------------------------------------------------

_HOST = "regexp_extract(url, '^[a-z]+://([^/]+)', 1)"


@query(f"WITH p AS (SELECT page_id, {_HOST} AS host, html FROM pages), n AS (SELECT host FROM p GROUP BY host ORDER BY count(*) DESC, host LIMIT 3) SELECT host, page_id, CAST(length(html) AS BIGINT) AS n_chars, host || '/' || page_id || '.html' AS key FROM p JOIN n USING (host)")
def stored_pages(spark, sf_dir):
    """Pages written as objects by host; those of the three largest hosts read back by filters that reach the listing."""
    p = table(spark, sf_dir, "pages").select("page_id", F.parse_url("url", F.lit("HOST")).alias("host"), F.col("html").alias("body"))
    root, template = shared.folder(spark, "pages"), "{host}/{page_id}.html"
    O.put(p, root, template)
    most = [r[0] for r in p.groupBy("host").count().orderBy(F.desc("count"), "host").limit(3).collect()]
    rows = O.stored(spark, root, template).where(F.col("host").isin(*most))
    return rows.select("host", F.col("page_id").cast("long").alias("page_id"), F.length("body").cast("long").alias("n_chars"), "key")


_JOINED = f"""WITH e AS (SELECT *, CASE WHEN label <= 3 THEN 'US' WHEN label <= 6 THEN 'TX' WHEN label <= 8 THEN 'TX-48201' ELSE 'TX-houston' END AS jurisdiction,
 DATE '2025-01-01' - CAST(vec_id % 730 AS INTEGER) AS last_updated FROM embeddings),
s AS (SELECT a.vec_id AS question_id, b.vec_id, b.last_updated, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS score FROM e a, e b WHERE b.jurisdiction IN ('US', a.jurisdiction)),
r AS (SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY score DESC, vec_id) AS rank FROM s)"""


def _questions(v: DataFrame) -> DataFrame:
    return v.select(F.col("vec_id").alias("question_id"), F.col("embedding").alias("vector"), F.array_distinct(F.array(F.lit("US"), F.col("jurisdiction"))).alias("may"))


@query(_JOINED + " SELECT question_id, vec_id, score, rank::INTEGER AS rank FROM r WHERE rank <= 10")
def question_top_k(spark, sf_dir):
    """Every vector as a question over its own jurisdiction and the federal one."""
    v = vectors(spark, sf_dir)
    return R.top_k_join(v, _questions(v), 10, allowed="may")


@query(_JOINED + """, w AS (SELECT question_id, vec_id, score, round(score * 0.8 + CASE WHEN DATE '2025-01-01' - last_updated < 365 THEN 0.2 ELSE 0.0 END, 6) AS weighted FROM r WHERE rank <= 50 AND score >= 0.2),
o AS (SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY weighted DESC, score DESC, vec_id) AS position FROM w) SELECT question_id, vec_id, score, weighted, position::INTEGER AS position FROM o WHERE position <= 10""")
def question_retrieval(spark, sf_dir):
    """Threshold, recency and the final ten for a table of questions."""
    v = vectors(spark, sf_dir)
    return R.retrieve_join(v, _questions(v), now(), min_score=0.2, allowed="may").select("question_id", "vec_id", "score", "weighted", "position")


@query(f"""WITH {_DOCS}, e AS (SELECT *, CASE WHEN label <= 3 THEN 'US' WHEN label <= 6 THEN 'TX' WHEN label <= 8 THEN 'TX-48201' ELSE 'TX-houston' END AS jurisdiction, DATE '2025-01-01' - CAST(vec_id % 730 AS INTEGER) AS last_updated FROM embeddings),
x AS (SELECT e.vec_id, e.embedding, e.jurisdiction, e.last_updated, d.citation, d.source_type, d.text FROM e JOIN d ON d.doc_id = e.vec_id),
s AS (SELECT a.vec_id AS question_id, b.*, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS score FROM e a, x b WHERE b.jurisdiction IN ('US', a.jurisdiction)),
r AS (SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY score DESC, vec_id) AS rank FROM s),
w AS (SELECT *, round(score * 0.8 + CASE WHEN DATE '2025-01-01' - last_updated < 365 THEN 0.2 ELSE 0.0 END, 6) AS weighted FROM r WHERE rank <= 50 AND score >= 0.2),
o AS (SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY weighted DESC, score DESC, vec_id) AS position FROM w),
b AS (SELECT question_id, string_agg('[' || position || '] ' || citation || ' (' || jurisdiction || ', ' || source_type || ')' || chr(10) || chr(10) || text, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY position) AS sources FROM o WHERE position <= 5 GROUP BY question_id)
SELECT e.vec_id AS question_id, md5('Question: What holds for ' || e.vec_id || '?' || chr(10) || 'Relevant jurisdictions: US' || CASE WHEN e.jurisdiction = 'US' THEN '' ELSE ', ' || e.jurisdiction END || chr(10) || chr(10) || '## Sources (cite as [N])' || chr(10) || chr(10) || coalesce(b.sources, '')
|| chr(10) || chr(10) || '## Task' || chr(10) || 'Answer from the sources above only, by jurisdiction level, and list required permits and licenses.') AS digest FROM e LEFT JOIN b ON b.question_id = e.vec_id""")
def question_prompts(spark, sf_dir):
    """A prompt for every vector as a question, with its nearest documents as numbered sources."""
    v = vectors(spark, sf_dir)
    index = v.join(documents(spark, sf_dir).select(F.col("doc_id").alias("vec_id"), "citation", "source_type", "text"), "vec_id").withColumn("title", F.lit(None).cast("string"))
    asked = _questions(v).withColumns({"question": F.concat(F.lit("What holds for "), F.col("question_id").cast("string"), F.lit("?"))})
    return pipelines.prompts(index, asked, now(), allowed="may", min_score=0.2, final=5).select("question_id", F.md5("prompt").alias("digest"))


@query("SELECT user_id, event_id, ts, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS o FROM events) WHERE o = 1")
def bucket_upsert(spark, sf_dir):
    """Users' last events: a stored table of those before the last day, then a change with that day's, which rewrites its users' buckets."""
    e = table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type", "value")
    day = e.select((F.max("ts") - F.expr("interval 1 day")).alias("day"))
    split = e.join(F.broadcast(day))
    stored = B.Buckets(spark, shared.folder(spark, "events"), ["user_id"], 64)
    stored.create(S.last_write(split.where("ts < day").drop("day"), ["user_id"], ["ts", "event_id"]))
    stored.upsert(split.where("ts >= day").drop("day"), ["ts", "event_id"])
    return stored.rows().drop("bucket")


@query("SELECT o_orderkey, 'changed' AS kind FROM orders WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders) UNION ALL SELECT o_orderkey, 'removed' FROM orders WHERE o_orderdate = (SELECT min(o_orderdate) FROM orders)")
def bucket_changes(spark, sf_dir):
    """Orders against a copy whose last day has other prices and whose first day is gone: digests first, then rows of differing buckets."""
    o = table(spark, sf_dir, "orders")
    ends = o.agg(F.min("o_orderdate").alias("first"), F.max("o_orderdate").alias("last"))
    both = o.join(F.broadcast(ends))
    old, new = (B.Buckets(spark, shared.folder(spark, name), ["o_orderkey"], 64) for name in ("old", "new"))
    old.create(o)
    price = F.when(F.col("o_orderdate") == F.col("last"), F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    new.create(both.where("o_orderdate <> first").withColumn("o_totalprice", price).select(*o.columns))
    return old.changes(new)


@query("SELECT doc_id, CASE WHEN lang = 'de' THEN 2 ELSE 1 END::BIGINT AS version, sha256(CASE WHEN lang = 'de' THEN text || ' v2' ELSE text END) AS digest FROM documents")
def ingest_versions(spark, sf_dir):
    """Documents, a second version of the German ones among all others again, and that batch once more: a stream with a digest a key."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    second = d.withColumn("text", F.when(F.col("lang") == "de", F.concat("text", F.lit(" v2"))).otherwise(F.col("text")))
    root = shared.folder(spark, "versions")
    for rows in (d, second, second):
        rows.write.mode("append").parquet(f"{root}/in")
        I.ingest_keyed(I.read_sections(spark, f"{root}/in", "doc_id long, text string, lang string"), f"{root}/out", f"{root}/state").awaitTermination()
    return I.latest(spark, f"{root}/out").select("doc_id", "version", "digest").distinct()


@query("SELECT p_size::VARCHAR AS chapter, p_size || '.' || p_partkey AS section, p_name AS heading, p_type || ' is sold as ' || p_brand || ' throughout.' AS text FROM part")
def crawled_statutes(spark, sf_dir):
    """A code's site made of parts, kept as objects by URL, crawled from its contents over chapters to sections."""
    p, lit = table(spark, sf_dir, "part"), F.lit
    size, key, root = F.col("p_size").cast("string"), F.col("p_partkey").cast("string"), shared.folder(spark, "site")
    at = lambda *rest: F.concat(lit(f"{W.STATUTES}PE/htm/PE."), *rest, lit(".htm"))
    top = _joined(p.select("p_size").distinct().withColumn("one", lit(1)), "one", "p_size", lit('<a href="PE.'), size, lit('.htm">c</a>')).select(at(lit("toc")).alias("url"), F.col("page").alias("body"))
    middle = _joined(p, "p_size", "p_partkey", lit('<a href="PE.'), size, lit("."), key, lit('.htm">s</a>')).select(at(size).alias("url"), F.col("page").alias("body"))
    text = F.concat(lit("<h2>"), "p_name", lit("</h2><article>"), "p_type", lit(" is sold as "), "p_brand", lit(" throughout.</article>"))
    O.put(top.unionByName(middle).unionByName(p.select(at(size, lit("."), key).alias("url"), text.alias("body"))), root, "{url}")
    crawl = W.Crawl(Control(spark, shared.folder(spark, "control")), "pe", O.Fetcher(root), spacing=0.0)
    return W.statutes(families.sources(spark, "tx-statute", ["PE"]), crawl)[0].select("chapter", "section", "heading", "text")


@query("SELECT '21' AS title, p_size::VARCHAR AS part, p_size || '.' || p_partkey AS section, p_name AS heading, p_type AS text FROM part")
def stored_regulations(spark, sf_dir):
    """Parts of two titles kept as objects under the family's keys; the sections of one title, whose folder alone is listed."""
    p, lit = table(spark, sf_dir, "part"), F.lit
    size, root = F.col("p_size").cast("string"), shared.folder(spark, "regulations")
    number = F.concat(size, lit("."), F.col("p_partkey").cast("string"))
    body = _joined(p, "p_size", "p_partkey", lit('<DIV8 N="'), number, lit('" TYPE="SECTION"><HEAD>§ '), number, lit(" "), "p_name", lit("</HEAD><P>"), "p_type", lit("</P></DIV8>"))
    page = F.concat(lit('<DIV5 N="'), size, lit('" TYPE="PART"><HEAD>PART '), size, lit("—GOODS</HEAD>"), "page", lit("</DIV5>"))
    O.put(body.select(F.explode(F.array(lit("21"), lit("7"))).alias("title"), size.alias("part"), page.alias("body")), root, O.KEYS["cfr"])
    found, _ = W.from_store(spark, root, "cfr", families.sources(spark, "cfr"), title="21")
    return found.select("title", "part", "section", "heading", "text")


@query(f"WITH {_DOCS} SELECT doc_id, CASE WHEN NOT regexp_matches(text, '\\S') THEN 'BLANK' WHEN tokens > 8191 THEN 'TOKEN_LIMIT' ELSE 'OK' END AS outcome, CASE WHEN NOT regexp_matches(text, '\\S') OR tokens > 8191 THEN 0 ELSE 16 END AS dimensions FROM d")
def embedding_outcomes(spark, sf_dir):
    """Every document through the embedding rounds: its vector, or the code it was refused with before any call."""
    good, bad = P.embedded(documents(spark, sf_dir), P.HashEmbedder(16), Control(spark, shared.folder(spark, "control")), "documents")
    kept = good.select("doc_id", F.lit("OK").alias("outcome"), F.size("embedding").alias("dimensions"))
    return kept.unionByName(bad.select("doc_id", F.col("error_code").alias("outcome"), F.lit(0).alias("dimensions")))


@query("""SELECT p_partkey, 'IV' AS chapter, p_partkey || '.' AS section, p_name AS heading, p_type || chr(10) || 'goes on' || chr(10) || chr(10) || '- ' || p_brand || chr(10) || '- nested ' || p_size || chr(10) || chr(10) || '> ' || p_name || chr(10) || 'more' || chr(10) || chr(10)
|| 'code ' || p_size || chr(10) || chr(10) || 'Two lines on ' || p_type || chr(10) || 'and more' || chr(10) || chr(10) || '- one' || chr(10) || '- two' || chr(10) || chr(10) || '# not ' || p_brand AS text FROM part""")
def markdown_blocks(spark, sf_dir):
    """A page a part: headings underlined over two lines, nested and numbered lists, quotes, indented and fenced code."""
    size, lit = F.col("p_size").cast("string"), F.lit
    page = F.concat(
        lit("Part IV\n of goods\n===\n\nlost\n\n## Sec. "), F.col("p_partkey").cast("string"), lit(". "), "p_name", lit(" ##\n"), "p_type", lit("\n  goes on\n* "), "p_brand", lit("\n  - nested "), size, lit("\n\n> "), "p_name",
        lit("\n> more\n\n    code "), size, lit("\n\nTwo lines on "), "p_type", lit("\nand more\n---\n\n1. one\n2. two\n\n```\n# not "), "p_brand", lit("\n```\n***\n"),
    )
    return K.ordinances(table(spark, sf_dir, "part").select("p_partkey", page.alias("markdown")), "p_partkey")
