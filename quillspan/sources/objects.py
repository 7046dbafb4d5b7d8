"""Raw documents as objects under keys of a template, as a Spark data source.

A key such as `federal/cfr/title-{title}/part-{part}.xml` names its document's columns. Reading lists only the folders that filters on
those columns leave (`pushFilters`), deals their objects into partitions by bytes, folder by folder, and reads bodies in the
tasks. Writing puts each row's body under its key, whole or not at all, so a task that is repeated
leaves the same objects. Any file system that Arrow opens will do, as long as driver and executors share it.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, EqualNullSafe, EqualTo, Filter, In, InputPartition, IsNotNull, StringStartsWith, WriterCommitMessage
from pyspark.sql.types import StructType

from quillspan.functions import retry

# Where each family's documents are kept.
KEYS = {
    "cfr": "federal/cfr/title-{title}/part-{part}.xml",
    "tx-statute": "texas/statutes/{code}/chapter-{chapter}/{section}.html",
    "tx-tac": "texas/tac/title-{title}/chapter-{chapter}/{section}.html",
    "county": "counties/{fips}/chapter-{chapter}/{section}.html",
    "municipal": "municipal/{city_id}/raw/page.md",
}
#: Bytes of a partition, and of an Arrow batch.
PARTITION, BATCH = 32 << 20, 4 << 20
#: Tasks a core that objects are written by.
SPREAD = 4
NAME = "quillspan_objects"


def columns(template: str) -> list[str]:
    return re.findall(r"{(\w+)}", template)


def key_of(template: str, row: dict) -> str:
    """The key of a row's object; values are percent-encoded, so that none makes a folder of its own."""
    return template.format(**{c: quote(str(row[c]), safe=" ,;:()§") for c in columns(template)})


def _segment(part: str) -> re.Pattern:
    return re.compile(re.sub(r"\\{(\w+)\\}", r"(?P<\1>.+)", re.escape(part)))


@dataclass
class Objects(InputPartition):
    """Paths with the values that their keys hold, sizes and times."""

    found: list[tuple[str, dict, int, object]]


class ObjectSource(DataSource):
    """Options: path, template; partition_bytes. Columns: the template's, key, body, size, stored_at."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return ", ".join([*(f"{c} string" for c in columns(self.options["template"])), "key string, body string, size long, stored_at timestamp"])

    def reader(self, schema: StructType) -> DataSourceReader:
        return ObjectReader(self.options, schema)

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        if overwrite:
            raise ValueError("objects are replaced one by one: use mode append")
        return ObjectWriter(self.options, schema)


class ObjectReader(DataSourceReader):
    def __init__(self, options: dict, schema: StructType):
        self.path, self.template = options["path"], options["template"]
        self.bytes = int(options.get("partition_bytes", PARTITION))
        self.names, self.columns = schema.names, columns(self.template)
        self.values: dict[str, set] = {}
        self.heads: dict[str, list[str]] = {}

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        for f in filters:
            name = f.attribute[0] if hasattr(f, "attribute") and len(f.attribute) == 1 else None
            if name == "key" and isinstance(f, IsNotNull):
                continue
            if name not in self.columns:
                yield f
            elif isinstance(f, (EqualTo, EqualNullSafe)):
                self._only(name, {f.value})
            elif isinstance(f, In):
                self._only(name, set(f.value))
            elif isinstance(f, StringStartsWith):
                self.heads.setdefault(name, []).append(f.value)
            elif not isinstance(f, IsNotNull):  # no key lacks a value
                yield f

    def _only(self, name: str, values: set) -> None:
        self.values[name] = self.values.get(name, values) & values

    def _asked(self, found: dict) -> bool:
        return all(v in self.values.get(c, {v}) and all(v.startswith(h) for h in self.heads.get(c, [])) for c, v in found.items())

    def partitions(self) -> Sequence[InputPartition]:
        """Objects folder by folder, up to a partition's bytes; a level is only listed where filters don't name its folders."""
        store, root = opened(self.path)
        *folders, last = self.template.split("/")
        level: list[tuple[str, dict]] = [(root, {})]
        for part in folders:
            own, pattern = columns(part), _segment(part)
            below = []
            for at, held in level:
                if len(own) == 1 and own[0] in self.values:
                    named = [(part.format(**{own[0]: quote(str(v), safe=" ,;:()§")}), {own[0]: v}) for v in sorted(self.values[own[0]], key=str) if v is not None]
                elif not own:
                    named = [(part, {})]
                else:
                    named = [(i.base_name, {c: unquote(v) for c, v in m.groupdict().items()}) for i in _listed(store, at, fs.FileType.Directory) if (m := pattern.fullmatch(i.base_name))]
                below += [(f"{at}/{name}", held | new) for name, new in named if self._asked(new)]
            level = below
        out, pattern, files, size = [], _segment(last), [], 0
        for at, held in level:
            for i in _listed(store, at, fs.FileType.File):
                m = pattern.fullmatch(i.base_name)
                new = {c: unquote(v) for c, v in m.groupdict().items()} if m else {}
                if m and self._asked(new):
                    if files and size + i.size > self.bytes:
                        out.append(Objects(files))
                        files, size = [], 0
                    files.append((i.path, held | new, i.size, i.mtime))
                    size += i.size
        return [*out, Objects(files)]

    def read(self, partition: Objects) -> Iterator[pa.RecordBatch]:
        store, root = opened(self.path)
        held, size = [], 0
        for path, found, length, time in partition.found:
            with store.open_input_stream(path) as f:
                body = f.read().decode("utf-8", "replace")
            held.append(found | {"key": path[len(root.rstrip("/")) + 1 :], "body": body, "size": length, "stored_at": time})
            size += length
            if size >= BATCH:
                yield self._batch(held)
                held, size = [], 0
        if held:
            yield self._batch(held)

    def _batch(self, rows: list[dict]) -> pa.RecordBatch:
        kinds = {"size": pa.int64(), "stored_at": pa.timestamp("us", "UTC")}
        return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], kinds.get(n, pa.string())) for n in self.names], names=self.names)


def opened(path: str) -> tuple[fs.FileSystem, str]:
    store, root = fs.FileSystem.from_uri(path)
    return store, root.rstrip("/")


def _listed(store: fs.FileSystem, at: str, kind: fs.FileType) -> list[fs.FileInfo]:
    found = store.get_file_info(fs.FileSelector(at, allow_not_found=True))
    return sorted((i for i in found if i.type == kind and not i.base_name.startswith(("_", "."))), key=lambda i: i.base_name)


@dataclass
class Written(WriterCommitMessage):
    objects: int


class ObjectWriter(DataSourceWriter):
    def __init__(self, options: dict, schema: StructType):
        self.path, self.template = options["path"], options["template"]
        missing = {*columns(self.template), "body"} - set(schema.names)
        if missing:
            raise ValueError(f"no column {', '.join(sorted(missing))}")

    def write(self, rows: Iterator) -> Written:
        """Each object goes to a name of its own first and is then moved: readers see the old body or the new one."""
        store, root = opened(self.path)
        made, n = set(), 0
        for r in rows:
            row = r.asDict()
            if row["body"] is None or any(row[c] in (None, "") for c in columns(self.template)):
                continue  # no document, or no place for it
            target = f"{root}/{key_of(self.template, row)}"
            folder = target.rpartition("/")[0]
            if folder not in made:
                store.create_dir(folder, recursive=True)
                made.add(folder)
            fresh = f"{folder}/.{uuid.uuid4().hex}.tmp"
            with store.open_output_stream(fresh) as f:
                f.write(row["body"].encode())
            store.move(fresh, target)
            n += 1
        return Written(n)


class Fetcher:
    """Bodies by URL from objects under "{url}" keys: a mirror of sites for crawls without a network. What isn't there is not found."""

    def __init__(self, root: str):
        self.root, self._opened = root, None

    def __getstate__(self) -> dict:
        return {"root": self.root, "_opened": None}

    def __call__(self, url: str) -> str:
        if self._opened is None:  # once a task
            self._opened = opened(self.root if "://" in self.root or self.root.startswith("file:") else f"file://{self.root}")
        store, root = self._opened
        try:
            with store.open_input_stream(f"{root}/{key_of('{url}', {'url': url})}") as f:
                return f.read().decode("utf-8", "replace")
        except FileNotFoundError:
            raise retry.NotFound(url) from None


def _ready(spark: SparkSession, root: str) -> str:
    spark.dataSource.register(ObjectSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return root if "://" in root or root.startswith("file:") else f"file://{root}"


def put(rows: DataFrame, root: str, template: str) -> None:
    """Write each row's body under its key. Of rows with one key any one stays: take the last write before. Rows without a body, or with a
    null or empty value in the key, are left out. Rows are dealt to all cores by their keys: an object costs more than its shuffle, and
    a task holds few large bodies."""
    path = _ready(rows.sparkSession, root)
    names = columns(template)
    there = reduce(lambda a, b: a & b, (F.col(c).cast("string") != "" for c in names), F.col("body").isNotNull())
    dealt = rows.select(*names, "body").where(there).repartition(SPREAD * rows.sparkSession.sparkContext.defaultParallelism, *names)
    dealt.write.format(NAME).option("path", path).option("template", template).mode("append").save()


def stored(spark: SparkSession, root: str, template: str, partition_bytes: int = PARTITION) -> DataFrame:
    """The objects under root whose keys fit the template. Equality, IN and prefixes on the template's columns never list or read
    other folders and objects; a missing root has no rows.

    Spark keeps a frame's last pushed filters for plans that push none; the filter that every object passes makes it push each
    time. Frames are not to be planned from two threads at once.
    """
    path = _ready(spark, root)
    rows = spark.read.format(NAME).option("path", path).option("template", template).option("partition_bytes", str(partition_bytes)).load()
    return rows.where("key is not null")
