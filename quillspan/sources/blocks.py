"""Markdown blocks: a fold over a document's lines, and the ordinance sections that its blocks make.

A document is one row before and its sections after: no window, no shuffle, and a heading may be underlined over several lines.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from quillspan.sources.markdown import CHAPTER, PART, SECTION

_FENCE = re.compile(r" {0,3}(`{3,}(?=[^`]*$)|~{3,})")
_HEADING = re.compile(r" {0,3}(#{1,6})(?:[ \t]+(.*?))??(?:[ \t]+#+)?[ \t]*$")
_BREAK = re.compile(r" {0,3}(?:(?:-[ \t]*){3,}|(?:\*[ \t]*){3,}|(?:_[ \t]*){3,})$")
_QUOTE = re.compile(r" {0,3}> ?")
_ITEM = re.compile(r"( {0,3})([-+*]|\d{1,9}[.)])(?:( +)|$)")
_UNDER = re.compile(r" {0,3}(=+|-+)[ \t]*$")
_HTML = re.compile(r" {0,3}<[A-Za-z/!?]")
_COLUMNS = re.compile(r" {0,3}\|?[ \t]*:?-+:?[ \t]*(?:\|[ \t]*:?-+:?[ \t]*)+\|?[ \t]*$")


def _opens(line: str) -> bool:
    """Whether a line ends the paragraph before it."""
    item = _ITEM.match(line)
    listed = item and line[item.end() :].strip() and (not item[2][0].isdigit() or item[2][:-1] == "1")
    return bool(_FENCE.match(line) or _HEADING.match(line) or _BREAK.match(line) or _QUOTE.match(line) or listed)


def blocks(text: str | None) -> Iterator[tuple[str, int, str]]:
    """(kind, depth, text) of each block at the top level. A list's text has an item a "- " with what it holds, nested lists too; a
    quote's and an item's own markers and indents are taken off once. Breaks and tables have no text."""
    lines = (text or "").replace("\r\n", "\n").replace("\t", "    ").split("\n")
    i, n = 0, len(lines)
    while i < n:
        line, start = lines[i], i
        if not line.strip():
            i += 1
        elif m := _FENCE.match(line):
            close, indent = re.compile(rf" {{0,3}}{m[1][0]}{{{len(m[1])},}} *$"), len(line) - len(line.lstrip())
            i += 1
            while i < n and not close.match(lines[i]):
                i += 1
            yield "code", 0, "\n".join(re.sub(rf"^ {{0,{indent}}}", "", x) for x in lines[start + 1 : i])
            i += 1
        elif line.startswith("    "):
            while i < n and (lines[i].startswith("    ") or not lines[i].strip()):
                i += 1
            yield "code", 0, "\n".join(x[4:] for x in lines[start:i]).rstrip("\n")
        elif m := _HEADING.match(line):
            yield "heading", len(m[1]), (m[2] or "").strip()
            i += 1
        elif _BREAK.match(line):
            yield "break", 0, ""
            i += 1
        elif _QUOTE.match(line):
            while i < n and (_QUOTE.match(lines[i]) or (lines[i].strip() and lines[i - 1].lstrip("> ") and not _opens(lines[i]))):
                i += 1  # a line without a sign goes on with the quote's paragraph
            yield "quote", 0, "> " + "\n".join(_QUOTE.sub("", x, count=1) for x in lines[start:i])
        elif _ITEM.match(line):
            i, items = _list(lines, i)
            yield "list", 0, "\n".join(f"- {x}" for x in items)
        elif "|" in line and i + 1 < n and _COLUMNS.match(lines[i + 1]):
            while i < n and lines[i].strip():
                i += 1
            yield "table", 0, ""
        elif _HTML.match(line):
            while i < n and lines[i].strip():
                i += 1
            yield "html", 0, "\n".join(lines[start:i])
        else:
            i += 1
            while i < n and lines[i].strip() and not _UNDER.match(lines[i]) and not _opens(lines[i]):
                i += 1
            own = "\n".join(x.strip() for x in lines[start:i])
            if i < n and (m := _UNDER.match(lines[i])):
                yield "heading", 1 if m[1][0] == "=" else 2, own
                i += 1
            else:
                yield "paragraph", 0, own


def _list(lines: list[str], i: int) -> tuple[int, list[str]]:
    """(line after the list, its items). Lines that are indented as far as an item's text are the item's, blank lines between them too."""
    items, sign = [], _ITEM.match(lines[i])[2][-1]
    while i < len(lines) and (m := _ITEM.match(lines[i])) and m[2][-1] == sign and not _BREAK.match(lines[i]):
        spaces = len(m[3] or " ")
        indent = len(m[1]) + len(m[2]) + (spaces if spaces <= 4 else 1)
        held, i = [lines[i][indent:]], i + 1
        while i < len(lines):
            line = lines[i]
            if not line.strip():
                after = next((x for x in lines[i:] if x.strip()), "")
                if len(after) - len(after.lstrip()) < indent:
                    break
                held.append("")
            elif len(line) - len(line.lstrip()) >= indent:
                held.append(line[indent:])
            elif held[-1].strip() and not _opens(line) and not _ITEM.match(line):
                held.append(line.strip())  # goes on with the item's paragraph
            else:
                break
            i += 1
        items.append("\n".join(held).rstrip())
        at = i
        while at < len(lines) and not lines[at].strip():
            at += 1
        if at < len(lines) and (m := _ITEM.match(lines[at])) and m[2][-1] == sign:
            i = at
    return i, items


def sections_of(text: str | None) -> Iterator[dict]:
    """Chapters are headings of depth 1 or 2, sections of depth 2 to 4; an article or part heading of depth 1 or 2 counts as a chapter. Any
    other block is text of the section it stands in, other headings too; text before the first section is dropped."""
    chapter, open_, held = "1", None, []
    for kind, depth, own in blocks(text):
        if kind == "heading":
            found = re.search(CHAPTER, own) if depth <= 2 else None
            named = re.search(SECTION, own) if not found and 2 <= depth <= 4 else None
            part = re.search(PART, own) if not found and not named and depth <= 2 else None
            if found or named or part:
                if open_:
                    yield open_ | {"text": "\n\n".join(held).strip()}
                held = []
                open_ = {"chapter": chapter, "section": named[1], "heading": named[2].strip()} if named else None
                chapter = (found or part)[1] if found or part else chapter
                continue
        if open_ and own:
            held.append(own)
    if open_:
        yield open_ | {"text": "\n\n".join(held).strip()}


def ordinances(pages: DataFrame, key: str, markdown: str = "markdown") -> DataFrame:
    """key, chapter, section, heading, text of every section of every page, in the page's order; a null page has none."""
    kind = pa.list_(pa.struct([(c, pa.string()) for c in ("chapter", "section", "heading", "text")]))

    @F.arrow_udf("array<struct<chapter:string,section:string,heading:string,text:string>>")
    def of(col: pa.Array) -> pa.Array:
        return pa.array([list(sections_of(x)) for x in col.to_pylist()], kind)

    return pages.select(key, F.inline(of(F.col(markdown))))
