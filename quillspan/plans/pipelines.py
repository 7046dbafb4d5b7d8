"""Whole runs: sections of all sources to an index, and a question to a structured answer.

A run is one plan over all sources, not a loop: what fails leaves as rows with a stage and a reason, and the rollup by
source is an aggregation. Spark's own task retries stand for step retries.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quillspan.functions import text as T
from quillspan.operators import answer as A, chunk as C, retrieval as R, store as S
from quillspan.operators.control import Control
from quillspan.plans import providers as P

SYSTEM_PROMPT = "You answer questions about regulations from numbered sources. Cite every claim as [N]. Answer by jurisdiction level under headings such as ### Federal Requirements, and list permits under ### Required Permits and Licenses."


@dataclass
class Run:
    #: Vectors to upsert, rows that left with stage and reason, one row a source, and whether all of them succeeded.
    index: DataFrame
    rejected: DataFrame
    by_source: DataFrame
    total: DataFrame


def build_index(sections: DataFrame, embedder: P.Embedder, control: Control, run: str, wanted: list[str] | None = None, resume: bool = True) -> Run:
    """Chunk, check and embed sections (section_id, source_id, text and metadata) of all sources.

    wanted: only these sources. Steps are tables under the run's name: one that is there already is read instead of made
    again, so a run that stopped goes on after its last whole step. They hold for the rows they were made of: if the
    sections have changed, by count and hashes over all columns, the run's steps are removed and made anew.
    """
    chosen = sections.where(F.col("source_id").isin(*wanted)) if wanted else sections
    row = F.xxhash64(F.to_json(F.struct(*chosen.columns), {"ignoreNullFields": "false"})).cast("decimal(38,0)")
    state = {"rows": (found := chosen.agg(F.count(F.lit(1)), F.sum(row)).first())[0], "digest": str(found[1])}
    if control.get(f"inputs/{run}") != state:  # runs/ holds the run's status
        control.clear(run)
        control.put(f"inputs/{run}", state)

    def step(name: str, make) -> DataFrame:
        held = control.load_step(run, name) if resume else None
        return control.save_step(run, name, make()) if held is None else held

    chunks = step("chunks", lambda: C.chunk(chosen).withColumn("chunk_id", F.concat_ws("-", "source_id", "section_id", F.col("chunk_index").cast("string"))))
    accepted, oversize = C.oversize(chunks)
    vectors, refused = embedded_steps(step, accepted, embedder, control, run)
    bad = [(oversize, "chunk", F.col("reason")), (refused, "embed", F.concat_ws(": ", "error_code", "reason"))]
    rejected = reduce(DataFrame.unionByName, [d.select("source_id", "chunk_id", F.lit(stage).alias("stage"), why.alias("reason")) for d, stage, why in bad])
    by_source, total = rollup(chunks, vectors, rejected, chunks.select("source_id").distinct())
    return Run(vectors, rejected, by_source, total)


def embedded_steps(step, accepted: DataFrame, embedder: P.Embedder, control: Control, run: str, **options) -> tuple[DataFrame, DataFrame]:
    """Steps vectors and refused of chunks. The rounds between them are removed at the end."""
    made: list[DataFrame] = []

    def both(i: int) -> DataFrame:
        if not made:
            made.extend(P.embedded(accepted, embedder, control, f"{run}/rounds", "chunk_text", **options))
        return made[i]

    vectors, refused = step("vectors", lambda: both(0)), step("refused", lambda: both(1))
    control.clear(f"{run}/rounds")
    return vectors, refused


def rollup(chunks: DataFrame, vectors: DataFrame, rejected: DataFrame, sources: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(one row a source, totals): counts before any join, so none multiplies rows. A source that lost rows is partial,
    one without any vector then an error."""
    made = chunks.groupBy("source_id").agg(F.count(F.lit(1)).alias("chunks"))
    kept = vectors.groupBy("source_id").agg(F.count(F.lit(1)).alias("vectors"))
    failed = rejected.groupBy("source_id").agg(F.count(F.lit(1)).alias("failed"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    out = reduce(lambda d, part: d.join(part, "source_id", "left"), [made, kept, failed], sources)
    out = out.select("source_id", zero("chunks"), zero("vectors"), zero("failed"))
    out = out.withColumn("status", F.when(F.col("failed") == 0, "active").when(F.col("vectors") > 0, "partial").otherwise("error"))
    ok = F.coalesce(F.bool_and(F.col("failed") == 0), F.lit(True))
    return out, out.agg(F.count(F.lit(1)).alias("sources"), F.sum("chunks").alias("chunks"), F.sum("vectors").alias("vectors"), ok.alias("success"))


def joined(runs: list[Run]) -> Run:
    """Several runs as one: their rows together, and one row of totals."""
    index, rejected, by_source = (reduce(DataFrame.unionByName, parts) for parts in zip(*((r.index, r.rejected, r.by_source) for r in runs), strict=True))
    ok = F.coalesce(F.bool_and(F.col("failed") == 0), F.lit(True))
    total = by_source.agg(F.count(F.lit(1)).alias("sources"), F.sum("chunks").alias("chunks"), F.sum("vectors").alias("vectors"), ok.alias("success"))
    return Run(index, rejected, by_source, total)


def sync_status(statuses: DataFrame, run: Run, log=print) -> DataFrame:
    """Statuses after a run. Best effort: a failure is logged and the old statuses stay."""
    try:
        return S.merge_status(statuses, run.by_source.select("source_id", "status", "vectors"), "source_id")
    except Exception as e:  # noqa: BLE001
        log(f"status sync failed: {e}")
        return statuses


def refresh(spark: SparkSession, parts: DataFrame, cache: str, now: Column) -> DataFrame:
    """Store parts (title, part, xml) whose digest is new or has changed, and return all with their state."""
    from quillspan.streaming.ingest import absent

    new = parts.withColumn("digest", F.sha2("xml", 256))
    try:
        held = spark.read.parquet(cache)
    except Exception as e:
        if not absent(e):
            raise
        held = None
    known = S.last_write(held.select("title", "part", "digest", "stored_at"), ["title", "part"], ["stored_at"]) if held is not None else new.limit(0)
    states = S.changed(new, known, ["title", "part"])
    states.where("state <> 'unchanged'").select("title", "part", "xml", "digest", now.alias("stored_at")).write.mode("append").parquet(cache)
    after = spark.read.parquet(cache).groupBy("title", "part").agg(F.max("stored_at").alias("stored_at"))
    return after.withColumn("state", F.when(F.col("stored_at") == now, "stored").otherwise("unchanged"))


def cache_status(cache: DataFrame, now: Column, days: float = 7) -> DataFrame:
    """title, parts, age_hours and stale of each cached title."""
    newest = F.max("stored_at")
    return cache.groupBy("title").agg(F.countDistinct("part").alias("parts"), T.age_hours(newest, now).alias("age_hours"), (~T.is_fresh(newest, now, days)).alias("stale"))


def prompts(index: DataFrame, questions: DataFrame, now: Column, allowed: str = "jurisdictions", question: str = "question", **options) -> DataFrame:
    """question_id and prompt of a table of questions (question_id, question, vector, jurisdictions): each over its own jurisdictions'
    nearest chunks, numbered from 1. options: of retrieve_join. A question without chunks has a prompt without sources."""
    rows = R.retrieve_join(index, questions, now, allowed=allowed, **options)
    asked = questions.select("question_id", F.col(question).alias("_question"), F.coalesce(F.col(allowed), F.array().cast("array<string>")).alias("_may"))
    text = A.user_prompt(F.col("_question"), F.col("_may"), F.coalesce("sources", F.lit("")))
    return asked.join(A.source_block(rows, "question_id"), "question_id", "left").select("question_id", text.alias("prompt"))


def answer_question(
    spark: SparkSession, index: DataFrame, question: str, now: Column, embedder: P.Embedder, generate: P.Generator, address: str | None = None, geocode: P.Geocoder | None = None, min_score: float = R.MIN_SCORE, final: int = 15
) -> dict:
    """A question's answer: jurisdictions, retrieved chunks, confidence, summary, sections, permits, citations, warnings.

    index has vec_id, embedding, jurisdiction, source_type, citation, title, text and last_updated. At most `final` chunks
    reach the driver. An address that can't be placed falls back to the federal level. A failed generation is a
    providers.ProviderError with its code.
    """
    try:
        where = P.jurisdictions(geocode(address)) if address and geocode else ["US"]
    except Exception:  # noqa: BLE001
        where = ["US"]
    vector = [float(x) for x in embedder([question])[0]]
    found = A.numbered(R.retrieve(index, vector, where, now, final=final, min_score=min_score), [F.desc("weighted"), F.desc("score"), F.asc("vec_id")])
    columns = ["vec_id", "position", "score", "weighted", "jurisdiction", "source_type", "citation", "title", "text"]
    rows = [r.asDict() for r in found.select(*columns).collect()]  # at most `final`
    chunks = spark.createDataFrame([tuple(r[c] for c in columns) for r in rows], found.select(*columns).schema)
    confidence = R.confidence(chunks, where).first().asDict()
    block = A.source_block(chunks.withColumn("q", F.lit(0)), "q")
    prompt = spark.range(1).join(block, F.col("id") == F.col("q"), "left").select(A.user_prompt(F.lit(question), F.array(*[F.lit(w) for w in where]), F.coalesce("sources", F.lit("")))).first()[0]
    raw = P.generated(generate, SYSTEM_PROMPT + "\n\n" + prompt)
    one = spark.createDataFrame([(0, raw)], "q int, answer string")
    t, n = F.col("answer"), F.lit(len(rows))
    parsed = one.select(T.summary(t).alias("summary"), A.permits(t).alias("permits"), A.valid_references(t, n).alias("cited"), A.warnings(t, n).alias("warnings")).first()
    by_position = {r["position"]: r for r in rows}
    cite = lambda p: {"id": p, "citation": by_position[p]["citation"], "jurisdiction": by_position[p]["jurisdiction"], "source_type": by_position[p]["source_type"], "text": by_position[p]["text"][:200] + ("..." if len(by_position[p]["text"]) > 200 else "")}
    return {
        "question": question, "jurisdictions": where, "chunks": rows, "confidence": confidence, "answer": raw, "summary": parsed["summary"],
        "sections": [r.asDict() for r in A.sections(one, "q").drop("q").collect()], "permits": [p.asDict() for p in parsed["permits"]],
        "citations": [cite(p) for p in parsed["cited"]], "warnings": list(parsed["warnings"]),
    }
