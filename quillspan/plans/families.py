"""Whole runs of a family of sources: crawled pages to sections, chunks, vectors, an index table and a status a source.

All sources of a family are one plan. The crawl's levels, the sections, the chunks and the vectors are tables under the
run's name, so a run that stopped goes on after the last of them. control.clear(run) removes them, once
its index is merged.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quillspan.functions import text as T
from quillspan.operators import chunk as C, store as S
from quillspan.operators.control import Control
from quillspan.plans import providers as P, registry
from quillspan.plans.graph import RunGraph
from quillspan.plans.pipelines import Run, embedded_steps, rollup
from quillspan.sources import crawl as W

TYPES = {"cfr": "federal", "tx-statute": "state", "tx-tac": "state", "county": "county", "municipal": "municipal"}
VECTOR = ("vec_id", "embedding", "source_id", "source_type", "jurisdiction", "citation", "title", "text", "url", "category", "chunk_index", "total_chunks", "last_updated")


def sources(spark: SparkSession, family: str, wanted: list[str] | None = None) -> DataFrame:
    """Enabled registry rows of a family with source_id, jurisdiction and category (the first of a source's); wanted: only
    these, by key or name."""
    rows, key = {
        "cfr": (registry.titles, "number"), "tx-statute": (registry.codes, "code"), "tx-tac": (registry.rules, "number"), "county": (registry.counties, "name"), "municipal": (registry.cities, "city_id"),
    }[family]
    out = rows(spark).where("enabled")
    if wanted:
        out = out.where(F.col(key).cast("string").isin(*wanted) | F.col("name").isin(*wanted))
    place = {"cfr": F.lit("US"), "county": F.concat(F.lit("TX-"), F.col("fips")), "municipal": F.concat(F.lit("TX-"), F.col("city_id"))}.get(family, F.lit("TX"))
    category = F.get("categories", F.lit(0)) if "categories" in out.columns else F.lit("municipal-ordinance")
    return out.withColumns({"source_id": T.source_id(family, F.col(key)), "jurisdiction": place, "category": category})


def crawled(family: str, chosen: DataFrame, crawl: W.Crawl, date: str, parts: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(sections, rejected) of a family's chosen sources; parts (number, part): of titles these alone."""
    if family == "cfr":
        return W.regulations(chosen, crawl, date, parts)
    return {"tx-statute": W.statutes, "tx-tac": W.rules, "county": W.counties, "municipal": W.cities}[family](chosen, crawl)


def index_family(
    spark: SparkSession, family: str, get: Callable[[str], str], embedder: P.Embedder, control: Control, now: Column, year: int, date: str, wanted: list[str] | None = None, run: str | None = None, parts: list[tuple[int, int]] | None = None, limit: int = T.MAX_CHUNK, **fetching
) -> Run:
    """Crawl, chunk and embed a family's sources. The run's index has a row a vector (VECTOR), to be merged by merge_index.

    A source whose pages, sections or chunks were partly lost has status partial, or error without any vector; rejected
    says what was lost and where. parts (number, part): these parts of federal titles alone. fetching: options of Crawl and fetch().
    Steps after the crawl hold for their options: another year, date, list of sources or parts, limit or embedder makes them anew.
    """
    run = run or family
    chosen = sources(spark, family, wanted)
    crawl = W.Crawl(control, run, get, **fetching)
    state = {"year": year, "date": date, "wanted": sorted(wanted or []), "parts": sorted([list(p) for p in parts or []]), "limit": limit, "embedder": [type(embedder).__name__, getattr(embedder, "model", ""), embedder.dimensions]}
    named = spark.createDataFrame(parts, "number int, part int") if parts else None
    found, lost = crawled(family, chosen, crawl, date, named)
    if control.get(f"inputs/{run}") != state:
        for name in ("lost", "chunks", "vectors", "refused", "rounds"):
            control.clear(f"{run}/{name}")
        control.put(f"inputs/{run}", state)

    def step(name: str, make: Callable[[], DataFrame]) -> DataFrame:
        held = None if crawl.anew else control.load_step(run, name)
        if held is None:
            crawl.anew = True
            held = control.save_step(run, name, make())
        return held

    lost = step("lost", lambda: lost)
    chunks = step("chunks", lambda: C.family_chunks(found, family, year, limit))
    accepted, oversize = C.oversize(chunks)
    whole, refused = embedded_steps(step, accepted, embedder, control, run)
    vectors = whole.select("chunk_id", "embedding")
    known = chosen.select("source_id", "jurisdiction", "category", F.col("name").alias("source_name"))
    title = F.concat("source_name", F.lit(" Code of Ordinances - "), "section") if family == "municipal" else F.col("heading")
    index = accepted.join(vectors, "chunk_id").join(known, "source_id").withColumns({
        "vec_id": F.col("chunk_id"), "source_type": F.lit(TYPES[family]), "title": title, "text": F.col("chunk_text"), "last_updated": now,
    }).select(*VECTOR)
    at = lambda d, stage, why: d.select("source_id", F.col("chunk_id").alias("item"), F.lit(stage).alias("stage"), why.alias("reason"))
    parts = [lost.select("source_id", F.col("url").alias("item"), "stage", "reason"), at(oversize, "chunk", F.col("reason")), at(refused, "embed", F.concat_ws(": ", "error_code", "reason"))]
    rejected = reduce(DataFrame.unionByName, parts)
    by_source, total = rollup(chunks, index, rejected, chosen.select("source_id"))
    return Run(index, rejected, by_source, total)


def merge_index(index: DataFrame | None, runs: list[Run], dimensions: int) -> tuple[DataFrame, DataFrame]:
    """(index, rejected) after runs: a vector's newest row stays; vectors of another length are rejected."""
    news = reduce(DataFrame.unionByName, [r.index for r in runs])
    good, bad = S.dimension_checked(news, dimensions)
    return S.upsert(index if index is not None else good.limit(0), good, ["vec_id"], ["last_updated"]), bad


def index_all(spark: SparkSession, families: list[str], control: Control, resume: bool = True, together: int = 1, run: str = "all", **options) -> tuple[dict[str, Run], dict[str, str]]:
    """(runs, errors) by family. A family that fails as a whole costs the others nothing; options go to index_family.

    resume: go on with what earlier runs left; without it their tables are removed first. together: families that run at
    once (graph.RunGraph).
    """
    graph = all_families(spark, families, control, resume, together, run, **options).start()
    graph.wait()
    return graph.results(), graph.errors()


def all_families(spark: SparkSession, families: list[str], control: Control, resume: bool = True, together: int = 4, run: str = "all", **options) -> RunGraph:
    """A graph of the families' runs, not started: each can be waited for, and cancelled alone."""
    graph = RunGraph(spark, control, run, together)

    def one(family: str) -> Run:
        if not resume:
            control.clear(family)
        return index_family(spark, family, control=control, **options)

    for family in families:
        graph.add(family, lambda family=family: one(family), [family, f"inputs/{family}.json"])
    return graph
