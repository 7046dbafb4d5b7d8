"""The service's routes as functions: each returns (status, DataFrame or dict), without a web server.

Statuses: 200 done, 202 started, 207 some sources failed, 404 unknown, 500 all failed, 501 not offered (a Spark job can't
be paused; it is cancelled through its job tag and resumed by running it again).
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quillspan.operators import coverage as V, quality as Q
from quillspan.operators.control import Control
from quillspan.plans import families, pipelines, registry
from quillspan.plans.providers import Embedder
from quillspan.sources import files, platforms

Reply = tuple[int, "DataFrame | dict"]
#: The runs that a family of routes starts.
RUNS = {"federal": ["cfr"], "texas": ["tx-statute", "tx-tac"], "counties": ["county"], "municipal": ["municipal"]}
FAMILIES = {"federal": "federal", "texas": "state", "counties": "county", "municipal": "municipal"}


@dataclass
class Service:
    """Tables the routes read: sections (source_type, source_id, jurisdiction, section_id, text), chunks (index metadata
    with tokens), cache (title, part, digest, stored_at), and the folder of stored documents."""

    spark: SparkSession
    control: Control
    embedder: Embedder
    now: Column
    sections: DataFrame
    chunks: DataFrame
    documents: str
    cache: str
    fetch_parts: Callable[[int | None], DataFrame]
    pages: Callable[[DataFrame], DataFrame] | None = None
    #: With a fetcher, starting a pipeline crawls its family; without one it indexes the sections that are there.
    get: Callable[[str], str] | None = None
    year: int = 2026
    date: str = ""
    fetching: dict = field(default_factory=dict)
    runs: dict[str, pipelines.Run] = field(default_factory=dict)

    def call(self, method: str, path: str) -> Reply:
        for verb, pattern, handler in ROUTES:
            if verb == method and (m := re.fullmatch(pattern, path)):
                return handler(self, **m.groupdict())
        return 404, {"error": f"no route {method} {path}"}

    # --- status ---

    def health(self) -> Reply:
        return 200, {"status": "ok", "spark": self.spark.version, "routes": [f"{v} {p}" for v, p, _ in ROUTES]}

    def stored(self) -> Reply:
        return 200, files.documents(self.spark, self.documents).select("key", "size", "content_type")

    def cached(self) -> Reply:
        return 200, pipelines.cache_status(self.spark.read.parquet(self.cache), self.now)

    def refresh(self, title: str | None = None) -> Reply:
        states = pipelines.refresh(self.spark, self.fetch_parts(int(title) if title else None), self.cache, self.now)
        return 200, states.groupBy("title", "state").agg(F.count(F.lit(1)).alias("parts"))

    # --- pipelines ---

    def start(self, family: str, kind: str | None = None, source: str | None = None) -> Reply:
        """Run a family's sources, those of a kind, or one source, from crawl to vectors; running it again goes on where it stopped.

        Without a fetcher the sections that are there are indexed. The run's status is kept under its name.
        """
        name = "-".join(x for x in (family, kind, source and re.sub(r"\W+", "-", source.lower())) if x)
        if self.get is not None:
            kinds = [k for k in RUNS[family] if not kind or k == f"tx-{kind.removesuffix('s')}"]
            runs = []
            for k in kinds:
                wanted = [source] if source else None
                if families.sources(self.spark, k, wanted).isEmpty():
                    continue
                runs.append(families.index_family(self.spark, k, self.get, self.embedder, self.control, self.now, self.year, self.date, wanted, f"{name}-{k}", **self.fetching))
            if not runs:
                return 404, {"error": "no such source"}
        else:
            rows = self.sections.where(F.col("source_type") == FAMILIES[family])
            if kind:
                rows = rows.where(F.col("source_id").startswith({"statutes": "tx-statute", "tac": "tx-tac"}[kind]))
            if source:
                key = re.sub(r"\s+", "-", source.lower())
                rows = rows.where(F.lower(F.col("source_id")).isin(key, f"cfr-title-{key}", f"tx-statute-{key}", f"tx-tac-{key}", f"county-{key}", f"municipal-{key}"))
            if rows.isEmpty():
                return 404, {"error": "no such source"}
            runs = [pipelines.build_index(rows, self.embedder, self.control, name)]
        totals = [r.total.first().asDict() for r in runs]
        total = {k: sum(t[k] or 0 for t in totals) for k in ("sources", "chunks", "vectors")} | {"success": all(t["success"] for t in totals)}
        self.runs[name] = runs[0] if len(runs) == 1 else pipelines.joined(runs)
        self.control.put(f"runs/{name}", {"status": "complete" if total["success"] else "partial", **total})
        return (200 if total["success"] else 207 if total["vectors"] else 500), self.runs[name].by_source

    def coverage_of(self, family: str) -> Reply:
        kind = F.col("source_type") == FAMILIES[family]
        expected = registry.expected_jurisdictions(self.spark).where(kind)
        return 200, V.flags(expected, V.indexed(self.chunks.where(kind)))

    def reset(self, family: str) -> Reply:
        names = [k for k in self.control.keys("runs") if k.split("/")[-1].split("-")[0] == family]
        for key in names:
            self.control.delete(key)
            for own in (key.split("/")[-1], *(f"{key.split('/')[-1]}-{k}" for k in RUNS[family])):
                self.control.clear(own)
                self.control.delete(f"inputs/{own}")
            self.runs.pop(key.split("/")[-1], None)
        return 200, {"cleared": len(names)}

    def check_sources(self) -> Reply:
        if self.pages is None:
            return 501, {"error": "no fetcher"}
        return 200, platforms.checked(self.pages(platforms.readable(registry.counties(self.spark)))).select("name", "accessible", "error")

    # --- runs ---

    def run_status(self, run: str) -> Reply:
        found = self.control.get(f"runs/{run}")
        return (200, found) if found else (404, {"error": f"no run {run}"})

    def not_offered(self, run: str) -> Reply:
        return 501, {"error": "not offered"}

    # --- validation ---

    def coverage(self) -> Reply:
        return 200, V.by_source(V.flags(registry.expected_jurisdictions(self.spark), V.indexed(self.chunks)))

    def gaps(self) -> DataFrame:
        return V.gaps(registry.expected_jurisdictions(self.spark), V.indexed(self.chunks))

    def quality(self) -> Reply:
        return 200, Q.report(self.chunks, "source_type")

    def report(self) -> Reply:
        by_type = Q.report(self.chunks, "source_type").join(Q.distribution(self.chunks.select("source_type", "tokens"), by=["source_type"]).select("source_type", "min", "max", "p50", "p95", "p99"), "source_type")
        return 200, by_type

    def summary(self) -> Reply:
        total = Q.full_report(Q.report(self.chunks, "source_type")).first().asDict()
        return 200, {**total, "gaps": self.gaps().count()}


_ID = r"(?P<run>[^/]+)"
ROUTES: list[tuple[str, str, Callable[..., Reply]]] = [
    ("GET", "/health", Service.health),
    ("GET", "/documents", Service.stored),
    ("GET", "/cache/federal/status", Service.cached),
    ("POST", r"/cache/federal/refresh(?:/(?P<title>\d+))?", Service.refresh),
    ("GET", "/pipeline/(?P<family>counties|municipal)/status", Service.coverage_of),
    ("POST", "/pipeline/counties/validate", Service.check_sources),
    ("POST", "/pipeline/(?P<family>municipal)/reset", Service.reset),
    ("POST", r"/pipeline/(?P<family>texas)/(?P<kind>statutes|tac)(?:/(?P<source>\w+))?", Service.start),
    ("POST", r"/pipeline/(?P<family>texas)", Service.start),
    ("POST", r"/pipeline/(?P<family>federal)(?:/(?P<source>\d+))?", Service.start),
    ("POST", r"/pipeline/(?P<family>counties|municipal)(?:/(?P<source>[\w -]+))?", Service.start),
    ("GET", rf"/workflows/{_ID}/status", Service.run_status),
    ("POST", rf"/workflows/{_ID}/(?:pause|resume|cancel)", Service.not_offered),
    ("GET", "/validation/coverage", Service.coverage),
    ("GET", "/validation/quality", Service.quality),
    ("GET", "/validation/report", Service.report),
    ("GET", "/validation/summary", Service.summary),
]
