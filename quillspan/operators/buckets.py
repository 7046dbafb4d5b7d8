"""Keyed tables in hash buckets: a change rewrites the buckets that its keys fall into, and no other.

A row's bucket is a hash of its key. Rows are stored by bucket, and beside them a digest of each bucket, so that two tables are
compared by digests first and by rows only where these differ. A bucket's digest is removed before its rows change and
written after them: one that is missing means that the rows must be compared. Changes are upserts and deletes by key, so one
that was interrupted is simply repeated.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quillspan.operators.store import last_write

_DYNAMIC = {"partitionOverwriteMode": "dynamic"}


class Buckets:
    """A table under path: rows/bucket=N and digests/bucket=N. A key should be unique; null keys are a value like any other."""

    def __init__(self, spark: SparkSession, path: str, key: Sequence[str], buckets: int = 256):
        self.spark, self.path, self.key, self.buckets = spark, path.rstrip("/"), list(key), buckets

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.key, F.lit(self.buckets)), F.lit(self.buckets)).cast("int")

    def create(self, rows: DataFrame) -> None:
        """The table anew."""
        self._remove("")
        named = rows.withColumn("bucket", self.bucket())
        named.limit(0).write.parquet(f"{self.path}/columns")  # a table without rows keeps them
        self._write(named)

    def rows(self, only: Sequence[int] | None = None) -> DataFrame:
        """All rows, or those of some buckets, whose folders alone are listed and read."""
        found = self.spark.read.schema(self.spark.read.parquet(f"{self.path}/columns").schema).parquet(f"{self.path}/rows")
        return found if only is None else found.where(F.col("bucket").isin(*only) if only else F.lit(False))

    def touched(self, keys: DataFrame) -> list[int]:
        """Buckets of keys: numbers below `buckets`."""
        return sorted(r[0] for r in keys.select(self.bucket()).distinct().collect())

    def upsert(self, changes: DataFrame, version: Sequence[str]) -> list[int]:
        """Rows of greatest version stay; the buckets that were rewritten."""
        named = changes.withColumn("bucket", self.bucket())
        own = self.touched(changes)
        if own:
            self._forget(own)
            self._write(last_write(self.rows(own).unionByName(named), [*self.key, "bucket"], version), own)
        return own

    def delete(self, keys: DataFrame) -> list[int]:
        """Remove the rows of keys, null keys too; the buckets that were rewritten."""
        own = self.touched(keys)
        if own:
            self._forget(own)
            gone = keys.select(*[F.col(k).alias(f"_{k}") for k in self.key]).distinct()
            same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in self.key]
            on = same[0]
            for more in same[1:]:
                on = on & more
            left = self.rows(own).join(gone, on, "left_anti")
            full = {r[0] for r in left.select("bucket").distinct().collect()}
            self._write(left, own)
            for n in {*own} - full:  # a bucket without rows isn't written, so its old rows are still there
                self._remove(f"rows/bucket={n}")
                self._remove(f"digests/bucket={n}")
        return own

    def digests(self) -> DataFrame:
        """bucket, rows and digest of the buckets that have one."""
        return self.spark.read.schema("rows long, digest string, bucket int").parquet(f"{self.path}/digests")

    def differing(self, other: Buckets) -> list[int]:
        """Buckets whose digests differ, are missing, or are in one table only."""
        if (self.key, self.buckets) != (other.key, other.buckets):
            raise ValueError("tables of other keys or buckets")
        a, b = ({r["bucket"]: (r["rows"], r["digest"]) for r in t.digests().collect()} for t in (self, other))  # one row a bucket
        known = {r[0] for t in (self, other) for r in t.rows().select("bucket").distinct().collect()}
        return sorted(n for n in known | {*a} | {*b} if a.get(n) is None or a.get(n) != b.get(n))

    def changes(self, other: Buckets) -> DataFrame:
        """Keys with kind: added or removed in other, or changed; only differing buckets are read."""
        own = self.differing(other)
        rest = [c for c in self.rows().columns if c not in (*self.key, "bucket")]
        digest = _digest(rest).alias("digest")
        a, b = (t.rows(own).select(*[F.col(k).alias(f"{n}_{k}") for k in self.key], digest.alias(f"{n}_digest"), F.lit(True).alias(n)) for n, t in (("a", self), ("b", other)))
        on = F.col(f"a_{self.key[0]}").eqNullSafe(F.col(f"b_{self.key[0]}"))
        for k in self.key[1:]:
            on = on & F.col(f"a_{k}").eqNullSafe(F.col(f"b_{k}"))
        kind = F.when(F.col("a").isNull(), "added").when(F.col("b").isNull(), "removed").when(F.col("a_digest") != F.col("b_digest"), "changed")
        both = a.join(b, on, "full_outer").withColumn("kind", kind).where("kind is not null")
        return both.select(*[F.when(F.col("a").isNull(), F.col(f"b_{k}")).otherwise(F.col(f"a_{k}")).alias(k) for k in self.key], "kind")

    def _write(self, rows: DataFrame, own: Sequence[int] | None = None) -> None:
        rows.repartition("bucket").write.options(**_DYNAMIC).mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/rows")
        left = self.rows(own)
        whole = [c for c in left.columns if c != "bucket"]
        sums = left.groupBy("bucket").agg(F.count(F.lit(1)).alias("rows"), F.sum(F.conv(_digest(whole), 16, 10).cast("decimal(38,0)")).cast("string").alias("digest"))
        sums.coalesce(1).write.options(**_DYNAMIC).mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/digests")

    def _forget(self, own: Sequence[int]) -> None:
        for n in own:
            self._remove(f"digests/bucket={n}")

    def _remove(self, name: str) -> None:
        at = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}".rstrip("/"))  # noqa: SLF001
        at.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(at, True)  # noqa: SLF001


def _digest(columns: Sequence[str]) -> Column:
    """64 bits of a SHA-256 over the columns with their nulls, as hexadecimal digits."""
    return F.substring(F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256), 1, 15)
