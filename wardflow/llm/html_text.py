"""Main text of web pages by wrappers: union-free regular expressions inferred from pages of the same host.

A page becomes a stream of tags and text slots (inline markup is not structure, missing end tags are supplied). Equal neighbours
fold into repeated groups. Streams of one host are aligned one after another: what both have is matched, what only one has
becomes an optional group, what one has once and the other several times becomes a repeated group, and differing text is a slot.
The wrapper keeps how much text its slots held, so the part of the template that holds the articles is found for the
host as a whole and then cut out of every page.

Every page takes part. Each task aligns the pages it has and hands on one wrapper per host, so that the pages of a hot host are
never brought together; only those partial wrappers are aligned across tasks.
"""

from __future__ import annotations

import html
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.session import settle

MOST_HOSTS = 2_000
ROWS_AT_ONCE = 64
CONTAINER_SHARE = 0.8

# Element classes of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script|style|noscript|template|title|textarea|iframe"
BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
                  "h1 h2 h3 h4 h5 h6 head header hgroup html legend li main menu nav ol p pre section summary table tbody td tfoot th "
                  "thead tr ul".split())
LEAF = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre blockquote td th figcaption ul ol dl table tr tbody".split())
CLOSED_BY = {"p": BLOCK, "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
             "tr": frozenset(["tr", "tbody", "tfoot"]), "td": frozenset(["td", "th", "tr", "tbody", "tfoot"]), "th": frozenset(["td", "th", "tr", "tbody", "tfoot"])}
# Names of parts of a page that are not its article.
EMBEDDED = frozenset("svg object canvas select video audio".split())
APART_TAGS = EMBEDDED | frozenset("nav footer aside form head menu dialog button label legend fieldset".split())
APART_NAMES = frozenset("ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr "
                        "notice notices alert popup modal overlay newsletter subscribe subscription signup paywall menu navbar nav navigation "
                        "breadcrumb breadcrumbs sidebar widget related recommended share sharing social comment comments reply replies "
                        "respond discussion disqus footer header masthead login search pagination pager toolbar skip".split())

_ATTRIBUTES = r"""(?:"[^"]*"|'[^']*'|[^'">])*+"""
_TOKEN = re.compile(rf"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(?P<raw>{RAW})(?=[\s/>])(?:{_ATTRIBUTES}>|[^>]*>).*?(?:</(?P=raw)\s*>|\Z)"
                    rf"|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attributes>{_ATTRIBUTES}|[^>]*)>|<[!?/][^>]*(?:>|\Z)|<[a-zA-Z][^>]*\Z", re.S | re.I)
_NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_WORD = re.compile(r"[a-z]+|[0-9]+")
_WHITE = re.compile(r"\s+")
_VALUE_WITH_SLASH = re.compile(r"""=\s*[^\s"'=]*/\Z""")


class Page:
    """The events of a page: ``(path, text, in a link)`` pieces grouped by block, in page order, and its element tree."""

    def __init__(self, source: str | None):
        self.blocks: list[list[tuple[tuple[str, ...], str]]] = [[]]
        self.tree = _entry("")
        stack: list[tuple[str, str, dict, int]] = [("", "", self.tree, -1)]  # tag, key, entry, place of an inline tag
        path: tuple[str, ...] = ()
        pairs: dict[int, int] | None = None
        at, links, source = 0, 0, source or ""

        def leave(depth: int) -> None:
            nonlocal path
            del stack[depth:]
            path = path[:depth - 1]
            self.blocks.append([])

        def text(piece: str) -> None:
            if piece and (words := html.unescape(piece)):
                self.blocks[-1].append((path, words))
                if (n := len(words.strip())):
                    top = stack[-1][2]
                    top["t"] += n
                    top["l"] += n if links else 0

        for m in _TOKEN.finditer(source):
            text(source[at:m.start()])
            at = m.end()
            tag = m.group("tag")
            if tag is None:
                continue
            tag = tag.lower()
            if tag == "a":
                links = max(0, links + (-1 if m.group("end") else 1))
            if tag == "br":
                self.blocks.append([])
            elif tag not in BLOCK:
                if m.group("end"):
                    start = pairs.get(m.start()) if pairs else None
                    depth = next((k for k in range(len(stack) - 1, 0, -1) if stack[k][3] == start), 0) if start is not None else 0
                    if depth:  # blocks left open in it go on without it
                        del stack[depth]
                        path = path[:depth - 1] + path[depth:]
                elif tag not in VOID and apart(key := _key(tag, m.group("attributes"))) and not _empty(m.group("attributes")):
                    pairs = _closed(source) if pairs is None else pairs
                    if m.start() in pairs:
                        stack.append((tag, key, _entry(key), m.start()))
                        path = (*path, key)
            elif m.group("end"):
                depth = next((k for k in range(len(stack) - 1, 0, -1) if stack[k][0] == tag), 0)
                if depth:
                    leave(depth)
            else:
                while len(stack) > 1 and tag in CLOSED_BY.get(stack[-1][0], ()):
                    leave(len(stack) - 1)
                key, entry = _key(tag, m.group("attributes")), None
                entry = _entry(key)
                stack[-1][2]["e"].append(entry)
                stack.append((tag, key, entry, -1))
                path = (*path, key)
                self.blocks.append([])
                if tag in ("div", "section", "article", "body"):
                    links = 0
        text(source[at:])

    def text(self, main: tuple[str, ...]) -> str:
        """Blocks under ``main`` that are not apart, one per line."""
        depth, out = len(main), []
        for block in self.blocks:
            words = "".join([t for path, t in block if path[:depth] == main and not any(map(apart, path[depth:]))])
            if words := _WHITE.sub(" ", words).strip():
                out.append(words)
        return "\n".join(out)


def _empty(attributes: str | None) -> bool:
    """Whether a tag ends in ``/>``; a slash that ends an unquoted value does not count."""
    return bool(attributes) and attributes.endswith("/") and not _VALUE_WITH_SLASH.search(attributes)


def _closed(source: str) -> dict[int, int]:
    """Places of the inline tags that are closed inside the block they stand in, and of their end tags, each by the other."""
    pairs: dict[int, int] = {}
    stack: list[tuple[str, int]] = []
    count: dict[str, int] = {}
    for m in _TOKEN.finditer(source):
        tag = (m.group("tag") or "").lower()
        if not tag or tag in VOID:
            continue
        if not m.group("end"):
            if tag in BLOCK or not _empty(m.group("attributes")):
                stack.append((tag, m.start()))
                count[tag] = count.get(tag, 0) + 1
        elif count.get(tag):
            depth = next(k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == tag)
            if tag not in BLOCK:
                pairs[stack[depth][1]], pairs[m.start()] = m.start(), stack[depth][1]
            for gone, _ in stack[depth:] if tag in BLOCK else stack[depth:depth + 1]:
                count[gone] -= 1
            del stack[depth:len(stack) if tag in BLOCK else depth + 1]
    return pairs


def _key(tag: str, attributes: str) -> str:
    """Tag and the words of its class, id and role; numbers in them are not structure."""
    if not attributes or "=" not in attributes:
        return tag
    words = [w for m in _NAMED.finditer(attributes) for w in _WORD.findall(m.group(1).lower()) if w.isalpha()]
    return ".".join([tag, *dict.fromkeys(words)])


_APART: dict[str, bool] = {}


def apart(key: str) -> bool:
    """Whether an element is a part that is not the article: by its tag, or a word of its class, id, role or custom tag."""
    known = _APART.get(key)
    if known is None:
        if len(_APART) > 10_000:
            _APART.clear()
        tag, *names = key.split(".")
        names += tag.split("-") if "-" in tag else []
        body = tag in ("html", "body", "main", "article")
        known = _APART[key] = tag in APART_TAGS or not body and not APART_NAMES.isdisjoint(names)
    return known


# ---- wrappers: entries {k: key, c: cardinality, n: pages, t: text characters, l: of them in links, e: inner entries} ----

def _entry(key: str, kids: list[dict] | None = None) -> dict:
    return {"k": key, "c": "1", "n": 1, "t": 0, "l": 0, "e": kids or []}


def _joined(a: str, b: str) -> str:
    """The narrowest cardinality that covers both."""
    several, none = bool({a, b} & {"+", "*"}), bool({a, b} & {"?", "*"})
    return {(False, False): "1", (False, True): "?", (True, False): "+", (True, True): "*"}[several, none]


def _merge(a: dict, b: dict, card: str, pages: int) -> dict:
    return {"k": a["k"], "c": card, "n": pages, "t": a["t"] + b["t"], "l": a["l"] + b["l"], "e": align(a["e"], b["e"])}


def fold(entries: list[dict]) -> list[dict]:
    """Equal neighbours become one repeated group; so do neighbouring runs of up to four different elements."""
    out: list[dict] = []
    for e in entries:
        e["e"] = fold(e["e"])
        if out and out[-1]["k"] == e["k"]:
            out[-1] = _merge(out[-1], e, "+", 1)
        else:
            out.append(e)
    for width in (2, 3, 4):
        k = 0
        while k + 2 * width <= len(out):
            run = out[k:k + width]
            count = 1
            while [e["k"] for e in out[k + count * width:k + (count + 1) * width]] == [e["k"] for e in run]:
                count += 1
            if count > 1:
                for c in range(1, count):
                    run = [_merge(a, b, _joined(a["c"], b["c"]), 1) for a, b in zip(run, out[k + c * width:k + (c + 1) * width], strict=True)]
                out[k:k + count * width] = [{**_entry("(" + " ".join(e["k"] for e in run) + ")", run), "c": "+"}]
            k += 1
    return out


def align(a: list[dict], b: list[dict]) -> list[dict]:
    """One list of entries that covers both: matched along a longest common subsequence, the rest optional."""
    if [e["k"] for e in a] == [e["k"] for e in b]:
        return [_merge(x, y, _joined(x["c"], y["c"]), x["n"] + y["n"]) for x, y in zip(a, b, strict=True)]
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if a[i]["k"] == b[j]["k"] else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < len(a) or j < len(b):
        if i < len(a) and j < len(b) and a[i]["k"] == b[j]["k"]:
            out.append(_merge(a[i], b[j], _joined(a[i]["c"], b[j]["c"]), a[i]["n"] + b[j]["n"]))
            i, j = i + 1, j + 1
        elif j == len(b) or i < len(a) and best[i + 1][j] >= best[i][j + 1]:
            out.append({**a[i], "c": _joined(a[i]["c"], "?")})
            i += 1
        else:
            out.append({**b[j], "c": _joined(b[j]["c"], "?")})
            j += 1
    return _neighbours(out)


def _neighbours(entries: list[dict]) -> list[dict]:
    """Equal neighbours that an alignment left side by side are one repeated group."""
    out: list[dict] = []
    for e in entries:
        if out and out[-1]["k"] == e["k"]:
            out[-1] = _merge(out[-1], e, "*" if {out[-1]["c"], e["c"]} <= {"?", "*"} else "+", max(out[-1]["n"], e["n"]))
        else:
            out.append(e)
    return out


def page_wrapper(page: Page) -> dict:
    page.tree["e"] = fold(page.tree["e"])
    return page.tree


def merged(a: dict, b: dict) -> dict:
    return {**_merge(a, b, "1", a["n"] + b["n"])}


def expression(entries: list[dict]) -> str:
    """A wrapper as a union-free regular expression over tags and text slots."""
    parts = []
    for e in entries:
        inner = ("#" if e["t"] else "") + expression(e["e"])
        whole = inner if e["k"].startswith("(") else f"<{e['k']}>{inner}</{e['k'].split('.')[0]}>"
        parts.append(whole if e["c"] == "1" else f"({whole}){e['c']}")
    return "".join(parts)


def _mass(entry: dict) -> int:
    """Characters that may be article text: not in links, not in parts that are apart."""
    return 0 if apart(entry["k"]) else entry["t"] - entry["l"] + sum(map(_mass, entry["e"]))


def main_path(wrapper: dict) -> tuple[str, ...]:
    """Path of the element that holds the articles of a host.

    An ``article`` (else a ``main``) that is not apart is taken where there is one; else the way down from the root goes on while a single
    container holds most of the text.
    """
    def ways(entry: dict, path: tuple[str, ...]) -> Iterator[tuple[dict, tuple[str, ...]]]:
        for e in entry["e"]:
            if apart(e["k"]):
                continue
            if e["k"].startswith("("):
                yield from ways(e, path)
            else:
                yield e, (*path, e["k"])
                yield from ways(e, (*path, e["k"]))

    every = list(ways(wrapper, ()))
    for tag in ("article", "main"):
        named = [(e, p) for e, p in every if e["k"].split(".")[0] == tag and _mass(e)]
        if named:
            return max(named, key=lambda x: (_mass(x[0]), -len(x[1])))[1]
    path, here = (), wrapper
    while True:
        inner = [(e, p) for e, p in ways(here, path) if len(p) == len(path) + 1 and e["k"].split(".")[0] not in LEAF]
        e, p = max(inner, key=lambda x: _mass(x[0]), default=(None, None))
        if e is None or _mass(e) < CONTAINER_SHARE * max(1, _mass(here)):
            return path
        here, path = e, p


# ---- Spark ----

def host(url):
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def wrappers(pages: DataFrame) -> DataFrame:
    """``host, pages, wrapper, expression, main`` of every host; pages without a url have the host ''."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, dict] = {}

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_pydict({"host": list(known), "wrapper": [json.dumps(w) for w in known.values()]})
            known.clear()
            return batch

        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                for name, source in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    one = page_wrapper(Page(source))
                    known[name] = merged(known[name], one) if name in known else one
                if len(known) > MOST_HOSTS:
                    yield out()
        if known:
            yield out()

    def whole(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        total = None
        for raw in rows.column("wrapper").to_pylist():
            total = json.loads(raw) if total is None else merged(total, json.loads(raw))
        return pa.table({"host": [key[0].as_py()], "pages": [total["n"]], "wrapper": [json.dumps(total)],
                         "expression": [expression(total["e"])], "main": [json.dumps(main_path(total))]})

    parts = pages.select(host(F.col("url")).alias("host"), F.col("html").alias("html")).mapInArrow(partial, "host string, wrapper string")
    return parts.groupBy("host").applyInArrow(whole, "host string, pages long, wrapper string, expression string, main string")


def main_texts(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page.

    Null or empty html has an empty text. A page that lacks its host's main element is cut by its own wrapper. Repeated rows
    are extracted each; a null page_id stays null; columns other than page_id, url and html are not read; no pages, no rows.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part, texts = batch.slice(at, ROWS_AT_ONCE), []
                for source, main in zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True):
                    page = Page(source)
                    text = page.text(tuple(json.loads(main))) if main else ""
                    texts.append(text or page.text(main_path(page_wrapper(page))))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()),
                                                  pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    found = settle(wrappers(pages).select(F.col("host").alias("_host"), "main"))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").alias("url"), F.col("html").alias("html"))
    return (rows.join(found, host(F.col("url")) == F.col("_host"), "left").select("page_id", "url", "html", "main")
            .mapInArrow(cut, "page_id long, url string, text string, n_chars long"))
