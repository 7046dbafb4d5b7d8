"""Main text of web pages by wrappers: union-free regular expressions inferred from pages of one host.

A page becomes a stream of block tags and text slots (inline markup, comments, scripts and styles are left out). Adjacent
repeats of a sequence collapse to a repeated group. Streams of one host are aligned one after the other: where they
agree the wrapper stays, what only one of them has becomes optional, and a slot whose text differs between pages becomes a
variable one. A page's slots find their place in its host's wrapper by the same alignment.

A slot's symbol says whether it is inside an article or main element, and whether inside a menu, header, footer,
sidebar, notice, advert, form or reader comments (by tag, role, class or id), so slots of unlike places never stand for
each other. A slot belongs to the main text by its place in the wrapper: inside the article if the wrapper has one
with text, and not inside any of the others. Without an article, slots that are mostly links and texts that are the
same on all of several pages are left out too. Slots that the wrapper doesn't cover, as on pages unlike the host's
others, go by the page's own structure and links.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterator
from difflib import SequenceMatcher
from functools import reduce
from hashlib import blake2b
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from quillspan.llm.common import materialise

#: Elements whose content is never text, inline elements, void elements, and what marks boilerplate.
_RAW = "script style noscript template iframe svg math select textarea object canvas video audio"
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr br input".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BOILERPLATE_TAGS = frozenset("nav aside form dialog head title button menu fieldset footer".split())
_BOILERPLATE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
_BOILERPLATE_NAMES = frozenset(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus menu modal nav navbar navigation "
    "newsletter notice notices popup promo promoted related share sharing sidebar social sponsor sponsored subscribe widget".split()
)
_OUTER_NAMES = frozenset("header footer masthead".split())

_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({'|'.join(_RAW.split())})\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</\1\s*>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>",
    re.S | re.I,
)
_NAMED = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORD = re.compile(r"[a-z0-9]+")


def _kind(name: str, attributes: str) -> str:
    """A tag's letter for its part in a page: - boilerplate, ~ outer header or footer, + main, or none."""
    if name in _BOILERPLATE_TAGS:
        return "-"
    if name in ("article", "main"):
        return "+"
    mark = "~" if name == "header" else ""
    for m in _NAMED.finditer(attributes) if attributes else ():
        value = (m[2] or m[3] or m[4] or "").lower()
        words = set(_WORD.findall(value))
        if m[1].lower() == "role":
            if words & _BOILERPLATE_ROLES:
                return "-"
            mark = "+" if words & {"main", "article"} else mark
        elif words & _BOILERPLATE_NAMES:
            return "-"
        elif words & _OUTER_NAMES:
            mark = mark or "~"
    return mark


def _inside(outer: str, kind: str) -> str:
    """The place of what an element holds: "-" in boilerplate, "+" in main text, "-+" both. A header inside an article is no page header."""
    boilerplate = "-" in outer or kind == "-" or kind == "~" and "+" not in outer
    return ("-" if boilerplate else "") + ("+" if "+" in outer or kind == "+" else "")


def stream(html: str) -> tuple[list[str], list[tuple[str, int]]]:
    """Symbols of a page, and for each slot ("#" and its place) the text and how many of its characters are in links."""
    symbols: list[str] = []
    slots: list[tuple[str, int]] = []
    parts: list[str] = []
    stack: list[str] = []
    places = [""]  # of the page, and of what each open element holds
    at = linked = in_link = 0

    def text(piece: str) -> None:
        nonlocal linked
        if piece:
            piece = unescape(piece)
            parts.append(piece)
            linked += len(piece) if in_link else 0

    def block(symbol: str) -> None:
        nonlocal linked
        whole = " ".join("".join(parts).split())
        parts.clear()
        if whole:
            symbols.append("#" + places[-1])
            slots.append((whole, linked))
        linked = 0
        if symbol.startswith("/"):
            own = next((k for k in range(len(stack) - 1, -1, -1) if stack[k].rstrip("+-~") == symbol[1:]), None)
            if own is None:
                return
            symbol = "/" + stack[own]  # an element's end is that of its own kind
            del stack[own:], places[own + 1 :]
        elif symbol and symbol.rstrip("+-~") not in _VOID:
            stack.append(symbol)
            places.append(_inside(places[-1], symbol[-1]))
        if symbol:
            symbols.append(symbol)

    for m in _TOKEN.finditer(html):
        text(html[at : m.start()])
        at = m.end()
        name = (m[3] or m[6] or "").lower()
        if not name:
            continue
        close, attributes = m[2] or m[5], m[4] or m[7] or ""
        if name in _INLINE:
            if name == "a":
                in_link = 0 if close else 1
            elif name == "br":
                parts.append("\n")
            continue
        block(f"/{name}" if close else name + _kind(name, attributes))
    text(html[at:])
    block("")
    return symbols, slots


def _widths(symbols: list[str], short: int = 12) -> list[int]:
    """Lengths of sequences that may repeat: the short ones, and distances between equal symbols that occur often enough."""
    last: dict[str, int] = {}
    apart: Counter[int] = Counter()
    for i, s in enumerate(symbols):
        apart[i - last.get(s, i)] += 1
        last[s] = i
    return [*range(1, short + 1), *sorted(w for w, n in apart.items() if w > short and 4 * n >= w)]


def collapse(symbols: list[str]) -> tuple[tuple[str, ...], list[int]]:
    """The stream with adjacent repeats as groups "(", ..., ")+", and each symbol's place in it."""
    items = [(s, [[i]]) for i, s in enumerate(symbols)]
    for w in _widths(symbols):
        out, i, n = [], 0, len(items)
        keys = [k for k, _ in items]
        while i < n:
            r = 1
            if keys[i] == keys[i + w] if i + 2 * w <= n else False:
                while i + (r + 1) * w <= n and keys[i + r * w : i + (r + 1) * w] == keys[i : i + w]:
                    r += 1
            if r > 1:
                members: list[list[int]] = [[]]
                for k in range(w):
                    own = [items[i + j * w + k][1] for j in range(r)]
                    members += [[x for part in column for x in part] for column in zip(*own)]
                out.append(("\x01".join(["(", *keys[i : i + w], ")+"]), [*members, []]))
                i += r * w
            else:
                out.append(items[i])
                i += 1
        items = out
    flat = tuple(s for k, _ in items for s in k.split("\x01"))
    place = [0] * len(symbols)
    at = 0
    for _, members in items:
        for own in members:
            for x in own:
                place[x] = at
            at += 1
    return flat, place


#: A wrapper is a list of [symbol, pages it is on, characters, linked characters, the length and hash of the text if it is the same on all
#: pages, then hashes of up to DIFFERENT different pages that have this text].
Wrapper = list
#: A text is a site's, not a page's, if so many different pages have it; copies of a page count as one.
DIFFERENT = 3


def _digest(text: str) -> str:
    return f"{len(text)}:{blake2b(text.encode('utf-8', 'surrogatepass'), digest_size=16).hexdigest()}"


def of_page(flat: tuple[str, ...], place: list[int], symbols: list[str], slots: list[tuple[str, int]]) -> Wrapper:
    out = [[s, 1, 0, 0, None] for s in flat]
    texts = iter(slots)
    page = _digest("\x01".join([*symbols, *(t for t, _ in slots)]))
    for i, s in enumerate(symbols):
        if s[0] == "#":
            text, linked = next(texts)
            e = out[place[i]]
            e[4:] = [_digest(text), page] if e[2] == 0 else [""]
            e[2] += len(text)
            e[3] += linked
    return out


def align(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Pairs of places of a and b that stand for each other."""
    if a == b:
        return list(zip(range(len(a)), range(len(b))))
    return [(m.a + i, m.b + i) for m in SequenceMatcher(None, a, b, autojunk=False).get_matching_blocks() for i in range(m.size)]


def merge(a: Wrapper, b: Wrapper) -> Wrapper:
    """The wrapper that generalises both."""
    out, i, j = [], 0, 0
    for x, y in [*align([e[0] for e in a], [e[0] for e in b]), (len(a), len(b))]:
        out += a[i:x] + b[j:y]  # only one has it: optional
        if x < len(a):
            p, q = a[x], b[y]
            same = p[4] == q[4]
            out.append([p[0], p[1] + q[1], p[2] + q[2], p[3] + q[3], *([p[4], *sorted({*p[5:], *q[5:]})[:DIFFERENT]] if same else [""])])
        i, j = x + 1, y + 1
    return bounded(out)


def bounded(w: Wrapper, most: int = 4000) -> Wrapper:
    """The wrapper without its least supported places, if it has over `most`: of pages unlike all others no trace stays.

    Their slots go by their pages' own structure; only texts repeated on few pages of a large, uneven host are then kept.
    """
    least = 1
    while len(w) > most:
        w, least = [e for e in w if e[1] > least] or w[:most], least + 1
    return w


def has_article(wrapper: Wrapper) -> bool:
    return any(e[0] == "#+" for e in wrapper)


def main_slots(wrapper: Wrapper) -> list[bool]:
    """Which places of a wrapper hold main text."""
    if has_article(wrapper):
        return [e[0] == "#+" for e in wrapper]
    return [e[0] == "#" and 2 * e[3] <= e[2] and not (len(e) >= 5 + DIFFERENT and bool(e[4])) for e in wrapper]


def _host(url: str | None) -> str:
    m = re.match(r"(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", url or "")
    return m[1].lower() if m else ""


def _dump(w: Wrapper) -> str:
    return json.dumps(w, ensure_ascii=True, separators=(",", ":"))


def _infer(batches: Iterator[pa.RecordBatch], most: int = 20_000) -> Iterator[pa.RecordBatch]:
    """Wrappers of the task's pages, by host. Pages of one stream are summed; only different streams are aligned."""
    held: dict[str, dict[tuple[str, ...], Wrapper]] = {}

    def out() -> pa.RecordBatch:
        whole = [_dump(reduce(merge, sorted(own.values(), key=lambda w: -w[0][1] if w else 0))) for own in held.values()]
        rb = pa.RecordBatch.from_arrays([pa.array(list(held)), pa.array(whole)], names=["host", "wrapper"])
        held.clear()
        return rb

    for rb in batches:
        for host, html in zip(rb.column(0).to_pylist(), rb.column(1).to_pylist()):
            symbols, slots = stream(html or "")
            flat, place = collapse(symbols)
            own, of_host = of_page(flat, place, symbols, slots), held.setdefault(host, {})
            of_host[flat] = merge(of_host[flat], own) if flat in of_host else own
        if sum(map(len, held.values())) > most:
            yield out()
    if held:
        yield out()


def _join_wrappers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All rows of a host are in one task and follow each other; there are no more of them than tasks made."""
    last, held = None, None

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([last]), pa.array([_dump(held)])], names=["host", "wrapper"])

    for rb in batches:
        for host, raw in zip(rb.column(0).to_pylist(), rb.column(1).to_pylist()):
            if host != last and held is not None:
                yield out()
                held = None
            last, held = host, json.loads(raw) if held is None else merge(held, json.loads(raw))
    if held is not None:
        yield out()


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    roles: dict[str, tuple[list[str], list[bool], bool]] = {}
    places: dict[tuple[str, tuple[str, ...]], list[bool | None]] = {}
    for rb in batches:
        texts = []
        for host, html, raw in zip(*(rb.column(i).to_pylist() for i in (2, 3, 4))):
            symbols, slots = stream(html or "")
            flat, place = collapse(symbols)
            if len(roles) > 5000 or len(places) > 20_000:
                roles.clear()
                places.clear()
            if host not in roles:
                wrapper = json.loads(raw)
                roles[host] = [e[0] for e in wrapper], main_slots(wrapper), has_article(wrapper)
            names, main, article = roles[host]
            own = places.get((host, flat))
            if own is None:
                own = [None] * len(flat)  # what the wrapper doesn't cover
                for x, y in align(names, list(flat)):
                    own[y] = main[x]
                places[host, flat] = own
            at = [i for i, s in enumerate(symbols) if s[0] == "#"]
            # A page without an article of its own is not the kind of page that the host's articles tell about.
            if article and not any(symbols[i] == "#+" for i in at):
                own, article = [None] * len(flat), False
            chosen = []
            for i, (t, linked) in zip(at, slots):
                role = own[place[i]]
                if role if role is not None else symbols[i] == ("#+" if article else "#") and (article or 2 * linked <= len(t)):
                    chosen.append(t)
            texts.append("\n".join(chosen))
        yield pa.RecordBatch.from_arrays([rb.column(0), rb.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def main_texts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Main text of every page: page_id, url, text and n_chars (code points).

    Null html is empty and gives an empty text; pages without a host in their url (or a null one) share one wrapper; null
    ids stay; repeated pages each give a row, and count as one page where texts that pages share are told from their own; an empty table gives an empty result; other columns are not read.
    """
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")), r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))
    own = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), host.alias("host"), F.col(html_col).alias("html"))
    parts = own.select("host", "html").mapInArrow(_infer, "host string, wrapper string")
    width = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wrappers = materialise(parts.repartition(width, "host").sortWithinPartitions("host", F.xxhash64("wrapper")).mapInArrow(_join_wrappers, "host string, wrapper string"), "wrappers")
    # Pages of one host may be very many: the join's other side has one row a host, so Spark can split them.
    return own.join(wrappers, "host", "left").select("page_id", "url", "host", "html", "wrapper").mapInArrow(_apply, "page_id long, url string, text string, n_chars long")
