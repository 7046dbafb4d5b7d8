"""Control state: small JSON documents in a shared folder, for resume points, manifests and workflow steps.

A write goes to a new file that is then renamed, so a reader sees the old state or the new one; what can't be read
counts as absent. Step results are tables, since they grow with the data.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession


class Control:
    """State under a folder that driver and executors share."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        jvm = spark._jvm  # noqa: SLF001
        self._path = lambda p: jvm.org.apache.hadoop.fs.Path(f"{self.root}/{p}")
        self._fs = self._path("x").getFileSystem(spark._jsc.hadoopConfiguration())  # noqa: SLF001
        self._jvm = jvm

    def put(self, key: str, state: dict) -> None:
        """Replace a document."""
        target, fresh = self._path(f"{key}.json"), self._path(f"{key}.{uuid.uuid4().hex}.tmp")
        out = self._fs.create(fresh, True)
        try:
            out.write(bytearray(json.dumps(state, sort_keys=True).encode()))
        finally:
            out.close()
        # One step that replaces the target: a crash leaves the old document or the new one.
        files = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri() if target.toUri().getScheme() else self._fs.getUri(), self.spark._jsc.hadoopConfiguration())  # noqa: SLF001
        how = self.spark._sc._gateway.new_array(getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename"), 1)  # noqa: SLF001
        how[0] = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename").OVERWRITE
        files.rename(self._fs.makeQualified(fresh), self._fs.makeQualified(target), how)

    def get(self, key: str) -> dict | None:
        path = self._path(f"{key}.json")
        if not self._fs.exists(path):
            return None
        stream = self._fs.open(path)
        try:
            raw = bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
        finally:
            stream.close()
        try:
            found = json.loads(raw)
        except ValueError:
            return None
        return found if isinstance(found, dict) else None

    def required(self, key: str) -> dict:
        found = self.get(key)
        if found is None:
            raise KeyError(key)
        return found

    def exists(self, key: str) -> bool:
        return self._fs.exists(self._path(f"{key}.json"))

    def delete(self, key: str) -> bool:
        """Whether there was one."""
        return bool(self._fs.delete(self._path(f"{key}.json"), False))

    def keys(self, prefix: str = "") -> list[str]:
        """Keys under a folder of the root."""
        at = self._path(prefix or ".")
        if not self._fs.exists(at):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(at)]
        return sorted((f"{prefix.rstrip('/')}/" if prefix else "") + n[:-5] for n in names if n.endswith(".json"))

    def clear(self, prefix: str) -> bool:
        """Remove all documents and step tables under a folder."""
        return bool(self._fs.delete(self._path(prefix), True))

    def save_step(self, run: str, step: str, rows: DataFrame) -> DataFrame:
        """A step's rows as a table; a repeated step replaces it."""
        path = f"{self.root}/{run}/{step}"
        rows.write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)

    def load_step(self, run: str, step: str) -> DataFrame | None:
        """None before the step has been written as a whole."""
        if not self._fs.exists(self._path(f"{run}/{step}/_SUCCESS")):
            return None
        return self.spark.read.parquet(f"{self.root}/{run}/{step}")

    def checkpoint(self, family: str, key: str, last: object, failed: list[str] | None = None) -> None:
        """The last item done, and those that failed so far."""
        self.put(f"checkpoints/{family}/{key}", {"last": last, "failed": failed or []})

    def resume(self, family: str, key: str) -> dict | None:
        return self.get(f"checkpoints/{family}/{key}")

    def finish(self, family: str, key: str) -> bool:
        """Clear the checkpoint, but only if nothing failed; whether it was cleared."""
        found = self.resume(family, key)
        return bool(found is not None and not found["failed"] and self.delete(f"checkpoints/{family}/{key}"))

    def manifest(self, name: str, key: str, entry: dict) -> list[dict]:
        """Replace or add a manifest's entry; entries stay sorted by their key. One entry a title: small."""
        held = [e for e in (self.get(f"manifests/{name}") or {}).get("entries", []) if e[key] != entry[key]]
        entries = sorted([*held, entry], key=lambda e: e[key])
        self.put(f"manifests/{name}", {"entries": entries})
        return entries
