"""Main text of web pages by nearest-URL page differencing.

A page is read as text lines, one per block of markup.  Pages are sorted by host and URL
path, and each is paired with the neighbour of its host whose path shares the longer
prefix (the one before it on a tie).  The lines of the pair are aligned by longest common
subsequence and shared lines are deleted: what neighbouring pages repeat is template.

Two rules keep the result right where the difference alone is wrong.  Lines in elements whose
tag, role, class or id says what they are (menus, headers, footers, sidebars, notices, adverts, forms,
scripts, styles, comments) go even if the pair does not share them.  Lines inside an
article element (or ``main`` without one) stay even if the pair shares them, as two pages may carry one
article; lines outside it go.  What an article stands in says nothing about it, unless the page has another one
outside all such elements (teasers in a sidebar).  A page of which nothing would be left keeps its lines.

Defined cases: null and empty html give an empty text; a null or relative URL has no neighbour; equal
rows and null ids are ordinary rows; broken or cut-off markup is closed as it ends; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import html
import json
import re
import zlib
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import stored
from tessera.sources.tables import table

# Element names and the words of class, id and role that mark what is not the article.
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "select", "button"}
BOILERPLATE_TAGS = {"head", "nav", "footer", "aside", "form", "menu", "dialog"}
BOILERPLATE_WORDS = {
    "ad", "ads", "advert", "adverts", "advertisement", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "consent", "cookie", "cookies",
    "disqus", "footer", "header", "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "popup", "promo",
    "related", "search", "share", "sharing", "sidebar", "skip", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget",
}
STATES = {"has", "no", "with", "without", "is", "not"}  # "has-sidebar" is no sidebar
CONTENTS = {"layout", "page", "result", "results"}  # "search-results" are no search form
BLOCK = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "div", "dl", "dt", "fieldset", "figcaption",
    "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "p",
    "pre", "section", "summary", "table", "tbody", "tfoot", "thead", "tr", "ul",
}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
NESTING = (BLOCK - {"p", "h1", "h2", "h3", "h4", "h5", "h6", "hr"}) | {"span", "td", "th"}

MAY_STAY_OPEN = {"noscript", "svg", "select", "button"}  # without an end of their own they hold nothing
UNCLOSED = re.compile(r"<(?:article|main|section|h[1-6]|select|button|/?body)\b", re.I)

STEP = 64  # pages whose lines are Python objects at one time
TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)""", re.S)
NAMED = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
URL = re.compile(r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)(?::\d*)?([^?#]*)")


def _marked(attributes: str, inside: bool) -> bool:
    """Whether a name in class, id or role starts or ends with a listed word; a header inside an article belongs to it."""
    words = BOILERPLATE_WORDS - {"header"} if inside else BOILERPLATE_WORDS
    for m in NAMED.finditer(attributes):
        for name in "".join(m.groups("")).split():
            parts = [x for x in re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", name).lower()) if x]
            if parts and parts[0] not in STATES and parts[-1] not in CONTENTS and (parts[0] in words or parts[-1] in words):
                return True
    return False


def lines(page: str | None) -> list[tuple[str, bool, bool]]:
    """(text, in boilerplate, in article or main) of every non-empty block, in page order."""
    out: list[tuple[str, bool, bool, str]] = []  # text, in boilerplate, in boilerplate of its own article, container
    text: list[str] = []
    open_: list[tuple[str, bool]] = []  # element, boilerplate
    at = 0
    page = page or ""

    def flush():
        said = " ".join(html.unescape("".join(text)).split())
        text.clear()
        if said:
            names = [x[0] for x in open_]
            own = max((k for k, x in enumerate(names) if x in ("article", "main")), default=0)
            out.append((said, any(x[1] for x in open_), any(x[1] for x in open_[own:]), "article" if "article" in names else "main" if "main" in names else ""))

    while m := TOKEN.search(page, at):
        text.append(page[at:m.start()])
        at = m.end()
        closing, name, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not name:
            continue
        name = name.lower()
        if closing:
            if name in BLOCK:
                flush()
            for k in range(len(open_) - 1, -1, -1):
                if open_[k][0] == name:
                    del open_[k:]
                    break
                if open_[k][0] == "article":  # a stray end tag does not close the article around it
                    break
            continue
        if name in RAW:
            if not attributes.endswith("/"):
                end = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I).search(page, at)
                if name not in MAY_STAY_OPEN:
                    at = end.end() if end else len(page)
                elif end and not UNCLOSED.search(page, at, end.start()):
                    at = end.end()
            text.append(" ")
            continue
        if name in BLOCK:
            flush()
        elif name in ("br", "td", "th", "img"):
            text.append(" ")
        if name in NESTING and not attributes.endswith("/"):
            inside = any(x[0] in ("article", "main") for x in open_)
            open_.append((name, name in BOILERPLATE_TAGS or name == "header" and not inside or bool(attributes) and name not in ("html", "body") and _marked(attributes, inside)))
    text.append(page[at:])
    flush()
    for mark in (1, 2):
        for container in ("article", "main"):
            if any(x[3] == container and not x[mark] for x in out):
                return [(x[0], x[mark] if x[3] == container else x[1], x[3] == container) for x in out]
    return [(x[0], x[1], x[3] == "main") for x in out]


def shared_lines(a: list, b: list) -> list[int]:
    """Positions of ``a`` in a longest common subsequence with ``b`` (bit-parallel rows, then traced back)."""
    places: dict = {}
    for j, x in enumerate(b):
        places[x] = places.get(x, 0) | 1 << j
    full = (1 << len(b)) - 1
    v, rows = full, [full]
    for x in a:
        u = v & places.get(x, 0)
        v = ((v + u) | (v - u)) & full
        rows.append(v)
    out, i, j = [], len(a), len(b)
    length = lambda i, j: j - (rows[i] & ((1 << j) - 1)).bit_count()
    while i and j:
        if a[i - 1] == b[j - 1]:
            i, j = i - 1, j - 1
            out.append(i)
        elif length(i - 1, j) >= length(i, j - 1):
            i -= 1
        else:
            j -= 1
    return out[::-1]


def _common_prefix(a: str, b: str) -> int:
    n = min(len(a), len(b))
    return next((k for k in range(n) if a[k] != b[k]), n)


#: Identity of a page's row; equal rows share it and have equal lines.
KEY = ["key", "key2"]


def _keyed(pages: DataFrame) -> DataFrame:
    own = ["page_id", "url", "html"]
    return pages.select(F.xxhash64(*own).alias("key"), F.hash(*own).alias("key2"), *own)


def _marks(pages: DataFrame) -> DataFrame:
    """(key, key2, host, path, marks) of every page with a host; ``marks`` are line hashes."""
    def mark(text):
        return int.from_bytes(blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)

    def read(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, STEP):
                part = batch.slice(at, STEP)
                where = [URL.match(x or "") for x in part.column(3).to_pylist()]
                marks = [[mark(x[0]) for x in lines(page)] if m else [] for page, m in zip(part.column(4).to_pylist(), where, strict=True)]
                yield pa.RecordBatch.from_arrays([
                    part.column(0), part.column(1), pa.array([m[1].lower() if m else None for m in where], pa.string()),
                    pa.array([m[2] if m else None for m in where], pa.string()), pa.array(marks, pa.list_(pa.int64()))],
                    names=[*KEY, "host", "path", "marks"])

    return _keyed(pages).mapInArrow(read, "key long, key2 int, host string, path string, marks array<long>").where("host is not null")


def _shared(pages: DataFrame) -> DataFrame:
    """(key, key2, shared): positions of the lines that a page shares with its nearest page.

    Pages are sorted by range partitions, so a host with a third of all pages spreads over
    many tasks; the first and last page of every partition are handed to its neighbours.
    """
    at = ["host", "path", *KEY]
    keyed = stored(_marks(pages).repartitionByRange(*at).withColumn("part", F.spark_partition_id()), "page-order")
    page = F.struct(*at, "marks")
    in_part, over_parts = Window.partitionBy("part").orderBy(*at), Window.orderBy("part")
    ends = keyed.groupBy("part").agg(F.min(page).alias("first"), F.max(page).alias("last"))  # one row per partition
    ends = ends.select("part", F.lag("last").over(over_parts).alias("above"), F.lead("first").over(over_parts).alias("below"))
    near = (keyed.withColumn("before", F.lag(page).over(in_part)).withColumn("after", F.lead(page).over(in_part)).join(ends, "part")
            .select(*at, "marks", F.coalesce("before", "above").alias("before"), F.coalesce("after", "below").alias("after")))

    def align(batches):
        for batch in batches:
            out = []
            for host, path, marks, *two in zip(*(batch.column(x).to_pylist() for x in ("host", "path", "marks", "before", "after")), strict=True):
                two = [x for x in two if x and x["host"] == host]
                best = max(two, key=lambda x: _common_prefix(path, x["path"]), default=None)
                out.append(shared_lines(marks, best["marks"]) if best else [])
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("key2"), pa.array(out, pa.list_(pa.int32()))], names=[*KEY, "shared"])

    return near.mapInArrow(align, "key long, key2 int, shared array<int>").dropDuplicates(KEY)


def candidates(page: list) -> list[tuple[int, str]]:
    """(position, text) of the lines that may be main text; lines of an article have position -1, as sharing does not remove them."""
    article = [(-1, t) for t, drop, inside in page if inside and not drop]
    kept = article or [(k, t) for k, (t, drop, _) in enumerate(page) if not drop]
    return kept or [(k, t) for k, (t, _, _) in enumerate(page)]


def main_text(found: list, shared: list[int]) -> str:
    """The candidate lines that are not shared, or all of them if none is left."""
    gone = set(shared)
    return "\n\n".join([t for k, t in found if k not in gone] or [t for _, t in found])


def extract(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, text, n_chars, n_lines, n_shared (lines shared with the nearest page).

    The lines travel to the join compressed; they are read from the pages a second time instead of being stored.
    """
    kind = pages.schema["page_id"].dataType.simpleString()

    def read(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, STEP):
                part = batch.slice(at, STEP)
                read_lines = [lines(x) for x in part.column(4).to_pylist()]
                got = [zlib.compress(json.dumps(candidates(x), ensure_ascii=False).encode("utf-8", "surrogatepass"), 6) for x in read_lines]
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in range(4)), pa.array(got, pa.binary()), pa.array([len(x) for x in read_lines], pa.int64())],
                                                 names=[*KEY, "page_id", "url", "lines", "n_lines"])

    def write(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, STEP):
                part = batch.slice(at, STEP)
                got = [json.loads(zlib.decompress(x).decode("utf-8", "surrogatepass")) for x in part.column("lines").to_pylist()]
                shared = [x or [] for x in part.column("shared").to_pylist()]
                text = [main_text(found, gone) for found, gone in zip(got, shared, strict=True)]
                yield pa.RecordBatch.from_arrays([
                    part.column("page_id"), part.column("url"), pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64()),
                    part.column("n_lines"), pa.array([len(x) for x in shared], pa.int64())],
                    names=["page_id", "url", "text", "n_chars", "n_lines", "n_shared"])

    packed = _keyed(pages).mapInArrow(read, f"key long, key2 int, page_id {kind}, url string, lines binary, n_lines long")
    both = packed.join(_shared(pages), KEY, "left").select("page_id", "url", "lines", "n_lines", "shared")
    return both.mapInArrow(write, f"page_id {kind}, url string, text string, n_chars long, n_lines long, n_shared long")


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
