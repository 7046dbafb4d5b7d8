"""Markdown blocks by a fold over lines, and the sections they make."""

import pytest

from quillspan.sources import blocks as K

CASES = [
    ("", []),
    (None, []),
    ("a\nb\n\nc", [("paragraph", 0, "a\nb"), ("paragraph", 0, "c")]),
    ("One\nof two\n===\nx\n---\ny", [("heading", 1, "One\nof two"), ("heading", 2, "x"), ("paragraph", 0, "y")]),
    ("# A #\n####### b\n#c", [("heading", 1, "A"), ("paragraph", 0, "####### b\n#c")]),
    ("- a\n  b\n\n  - c\n\n    d\n- e\n* f", [("list", 0, "- a\nb\n\n- c\n\n  d\n- e"), ("list", 0, "- f")]),
    ("10. a\n11. b\n1) c", [("list", 0, "- a\n- b"), ("list", 0, "- c")]),
    ("a\n2. b\n\n2. c", [("paragraph", 0, "a\n2. b"), ("list", 0, "- c")]),
    ("> a\nb\n>> c\n\nd", [("quote", 0, "> a\nb\n> c"), ("paragraph", 0, "d")]),
    ("    x\n\n      y\nz", [("code", 0, "x\n\n  y"), ("paragraph", 0, "z")]),
    ("~~~\n```\n# no\n~~~~\nx", [("code", 0, "```\n# no"), ("paragraph", 0, "x")]),
    ("```\nnever closed", [("code", 0, "never closed")]),
    ("* * *\n---\n- - a", [("break", 0, ""), ("break", 0, ""), ("list", 0, "- - a")]),
    ("a | b\n--|--\n1 | 2\n\n<p>\nx</p>", [("table", 0, ""), ("html", 0, "<p>\nx</p>")]),
    ("-\n- a", [("list", 0, "- \n- a")]),
]


@pytest.mark.parametrize(("text", "want"), CASES)
def test_blocks(text, want):
    assert list(K.blocks(text)) == want


def test_sections(spark):
    rows = [
        ("a", "Chapter 3\n=========\n\n1.01 Set\n--------\ntext a\n\n```\n# 9.9 not a heading\n- raw\n```\n\n---\n\n* item\n\n## Part IV\n\n### Sec. 4.01 Next\n\nbody long enough\n## Article General\nmore"),
        ("b", "no heading"), ("c", None), ("d", "## Sec. 1-1. A\n" + "line\n" * 50_000 + "# Chapter 2\ngone\n## Sec. 2-1. B\n"),
    ]
    got = {(r["id"], r["section"]): (r["chapter"], r["heading"], r["text"]) for r in K.ordinances(spark.createDataFrame(rows, "id string, markdown string"), "id").collect()}
    assert got == {
        ("a", "1.01"): ("3", "Set", "text a\n\n# 9.9 not a heading\n- raw\n\n- item"), ("a", "4.01"): ("IV", "Next", "body long enough\n\nArticle General\n\nmore"),
        ("d", "1-1."): ("1", "A", "\n".join(["line"] * 50_000)), ("d", "2-1."): ("2", "B", ""),
    }
