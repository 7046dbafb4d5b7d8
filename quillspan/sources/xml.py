"""Regulation XML: titles or single parts to one row for each section."""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import from_arrow_schema
from pyspark.sql.types import StringType, StructField, StructType

SECTION = pa.schema([("title", pa.int32()), ("title_name", pa.string()), ("part", pa.int32()), ("part_name", pa.string()), ("section", pa.string()), ("heading", pa.string()), ("text", pa.string())])
#: Sections of a batch.
ROWS = 5000


def _head(e: ET.Element) -> str:
    h = e.find("HEAD")
    return (h.text or "").strip() if h is not None else ""


def _number(e: ET.Element) -> int:
    m = re.match(r"\s*(\d+)", e.get("N") or "")
    return int(m[1]) if m else 0


def _divs(e: ET.Element, kind: str):
    """Descendants by DIV elements of that type; what is inside one of them isn't searched."""
    for child in e:
        if child.tag.startswith("DIV"):
            if child.get("TYPE") == kind:
                yield child
            else:
                yield from _divs(child, kind)


def _paragraphs(e: ET.Element):
    """Own text of P, then of FP elements, then of other children's: that order is part of the result."""
    for tag in ("P", "FP"):
        for p in e.findall(tag):
            own = "".join([p.text or "", *((c.tail or "") for c in p)]).strip()
            if own:
                yield own
    for child in e:
        if child.tag not in ("P", "FP"):
            yield from _paragraphs(child)


def sections_of(xml: str | None) -> list[dict]:
    """Sections of a title or part document; ValueError for any other root."""
    return list(_sections(*_parts(xml)))


def _parts(xml: str | None) -> tuple[int, str, list[ET.Element]]:
    """A document's title, its name and its parts."""
    root = ET.fromstring(xml or "<none/>")
    if root.tag == "DIV5" and root.get("TYPE") == "PART":
        return 0, "", [root]
    top = root.find("DIV1") if root.tag == "ECFR" else None
    if top is None:
        raise ValueError("neither a title nor a part")
    title = _number(top)
    return title, re.sub(r"^Title \d+[—-]", "", _head(top)).strip() or f"Title {title}", list(_divs(top, "PART"))


def _sections(title: int, name: str, parts: list[ET.Element]) -> Iterator[dict]:
    """Rows of the sections of parts, whose elements are emptied as they are read."""
    for p in parts:
        part_name = re.sub(r"^PART \d+[—-]?", "", _head(p)).strip() or f"Part {_number(p)}"
        for s in _divs(p, "SECTION"):
            row = {
                "title": title, "title_name": name, "part": _number(p), "part_name": part_name, "section": (s.get("N") or "").strip(),
                "heading": re.sub(r"^§\s*[\d.]+\s*", "", _head(s)).strip(), "text": "\n\n".join(_paragraphs(s)).strip(),
            }
            s.clear()
            if row["section"] or row["heading"] or row["text"]:
                yield row


def parse(files: DataFrame, xml: str = "xml") -> tuple[DataFrame, DataFrame]:
    """(sections, rejected): one row for each section; documents that can't be parsed leave with a reason. A task holds one document's
    tree at a time and gives sections back in batches of ROWS."""
    rest = [c for c in files.columns if c != xml]
    given = files.select(*rest, xml)

    def read(batches: Iterator[pa.RecordBatch], wanted: bool) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            for i in range(rb.num_rows):
                kept = lambda n, rb=rb, i=i: [c.take(pa.array([i] * n, pa.int32())) for c in rb.columns[:-1]]
                try:
                    found = _sections(*_parts(rb.column(len(rest))[i].as_py()))
                except (ET.ParseError, ValueError) as e:
                    if not wanted:
                        yield pa.RecordBatch.from_arrays([*kept(1), pa.array([str(e)])], names=[*rest, "reason"])
                    continue
                while wanted and (rows := list(islice(found, ROWS))):
                    yield pa.RecordBatch.from_arrays([*kept(len(rows)), *(pa.array([r[f.name] for r in rows], f.type) for f in SECTION)], names=[*rest, *(f.name for f in SECTION)])

    own = [f for f in given.schema.fields if f.name != xml]
    rows = given.mapInArrow(lambda b: read(b, True), StructType([*own, *from_arrow_schema(SECTION).fields]))
    return rows, given.mapInArrow(lambda b: read(b, False), StructType([*own, StructField("reason", StringType())]))
