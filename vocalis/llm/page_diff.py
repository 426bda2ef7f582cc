"""Main text of pages by differencing with the nearest URL of the same host.

A page is read into lines (its text blocks), each with the kind of place it
stands in: ``main`` (inside an article or main element), ``chrome`` (menus,
headers, footers, sidebars, notices, adverts, forms, comments, by element name
or class) or ``open`` (neither).  Chrome never is text, and on a page with a
main element only the lines inside of it can be.

Within each host, the distinct contents (pages with the same lines are one, at
the smallest path) are sorted by URL path, and the lines of each are aligned by
longest common subsequence with those of up to ten others: the contents
``STEPS`` places before and after.  Copies thus never stand in each other's way.

* Template of the host are lines aligned with more than half of at least two.
* What is left of the page tells copies: a neighbour that shares more than
  ``COPY_SHARE`` of the shorter one's rest is a copy and says nothing.  Of the
  others, the one with the longest common path prefix (then the nearer) adds
  the lines it shares, if a second one that is no copy shares them as well or
  there is none.
* A single neighbour is judged by all lines: over ``COPY_SHARE`` it is a copy.
* Inside a main element a line goes only if at least ``MAIN_VOTES`` neighbours
  were compared and every one of them has it: articles quote licence lines and
  passages of each other, which are not template.

What no comparison of lines can tell: more than about eight near copies in a row look
like a template with short texts, and a menu of fewer than about nine pages that
fills over ``COPY_SHARE`` of them looks like near copies (it stays).

Only line hashes (eight bytes a line) travel to find and read the neighbours.
They are range-partitioned by (host, path) and numbered, one row per partition
carrying the count across; chunks of ``CHUNK`` numbers with a rim are aligned in
parallel, so a host with a third of all pages spreads over many tasks.  Texts
move once, to meet the deletions by host and lines.

Defined cases: null html gives an empty text; null url, or one without ``://``,
counts as host and path ``''``; rows with equal (page_id, url, html) get equal
results; a page alone on its host has no neighbour; an unclosed comment, script
or tag ends with the page; other columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import html as html_lib
import re
from collections.abc import Iterator
from os.path import commonprefix

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vocalis.llm.common import materialize
from vocalis.llm.host_reputation import url_parts

#: A pair sharing more than this of the shorter page's lines that are not template is a copy.
COPY_SHARE = 0.8
#: Places before and after a page, among its host's distinct contents, of the pages it is compared with.
STEPS = (1, 2, 4, 8, 64)
#: Lines inside a main element are template if so many neighbours or more were compared and all have them.
MAIN_VOTES = 4
CHUNK = 1024
#: Cells of an alignment table held at once.
CELLS = 1 << 20

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|template|noscript|textarea|select|svg|iframe|title)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<[!?/][^>]*(?:>|\Z)"
    r"|<[a-z](?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*\Z"
    r"|[^<]+|<", re.S | re.I)
_ATTRIBUTE = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_SPACE = re.compile(r"\s+")

_BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary table "
    "tbody td tfoot th thead tr ul".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_CHROME = frozenset("aside button dialog footer form head header menu nav search".split())
_CHROME_NAME = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert\w*|alert|banner\w*|breadcrumbs?|comments?|comment-?list|consent|cookies?|disqus|footer|"
    r"header|masthead|menu|modal|nav\w*|newsletter|notices?|popup|promo\w*|related|replies|respond|share|sharing|sidebar|"
    r"skip|social|sponsor\w*|subscribe|toolbar|widgets?|complementary|contentinfo|navigation)(?:[\s_-]|$)", re.I)
_MAIN = frozenset(("article", "main"))
_MAIN_NAME = re.compile(
    r"(?:^|\s)(?:article|article-?body|article-?content|content|entry-?content|main|main-?content|post-?body|post-?content|"
    r"story|story-?body)(?:\s|$)", re.I)

OPEN, MAIN, CHROME = 0, 1, 2


def read_lines(page: str | None) -> list[tuple[str, int]]:
    """(text, kind) of a page's blocks in page order; empty blocks are left out."""
    out: list[tuple[str, int]] = []
    stack: list[tuple[str, int]] = []
    kind, buf = OPEN, []

    def flush() -> None:
        text = _SPACE.sub(" ", html_lib.unescape("".join(buf))).strip()
        buf.clear()
        if text:
            out.append((text, kind))

    for m in _TOKEN.finditer(page or ""):
        tag = m.group(3)
        if tag is None:
            token = m.group()
            if token[0] != "<" or len(token) == 1:
                buf.append(token)
            continue
        tag = tag.lower()
        if tag == "br":
            buf.append(" ")
            continue
        if tag in _BLOCK:
            flush()
        if m.group(2):
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    if tag not in _BLOCK and stack[k][1] != kind:
                        flush()
                    kind = stack[k][1]
                    del stack[k:]
                    break
            continue
        if tag in _VOID:
            continue
        if tag in _BLOCK:  # an open paragraph, item or cell ends where the next begins
            closes = {"li": ("li", "p"), "dd": ("dd", "dt", "p"), "dt": ("dd", "dt", "p"), "td": ("td", "th", "p"),
                      "th": ("td", "th", "p"), "tr": ("td", "th", "tr", "p")}.get(tag, ("p",))
            while stack and stack[-1][0] in closes:
                kind = stack.pop()[1]
        own = kind
        if kind != CHROME:
            names = " ".join("".join(g) for g in _ATTRIBUTE.findall(m.group(4))) if "=" in m.group(4) else ""
            if tag in _CHROME or (names and tag not in ("html", "body") and _CHROME_NAME.search(names)):
                own = CHROME
            elif tag in _MAIN or (names and tag in _BLOCK and _MAIN_NAME.search(names)):
                own = MAIN
        if own != kind and tag not in _BLOCK:
            flush()
        if tag in _BLOCK or own != kind:
            stack.append((tag, kind))
        kind = own
    flush()
    return out


def candidate_lines(lines: list[tuple[str, int]]) -> tuple[list[str], bool]:
    """(lines that may be main text, whether a main element marks them)."""
    main = [t for t, k in lines if k == MAIN]
    return (main, True) if main else ([t for t, k in lines if k == OPEN], False)


def compared_lines(lines: list[tuple[str, int]]) -> tuple[list[str], bool, np.ndarray]:
    """(lines outside of chrome, whether a main element marks some, mask of those that may be main text)."""
    kinds = np.array([k for _, k in lines if k != CHROME], dtype=np.int8)
    marked = bool((kinds == MAIN).any())
    return [t for t, k in lines if k != CHROME], marked, kinds == (MAIN if marked else OPEN)


def _rows(a: np.ndarray, b: np.ndarray) -> Iterator[np.ndarray]:
    """Rows of the table of longest common subsequences of ``a``'s beginnings with ``b``'s."""
    prev = np.zeros(len(b) + 1, dtype=np.int32)
    for x in a:
        step = prev.copy()
        match = np.flatnonzero(b == x) + 1
        step[match] = np.maximum(step[match], prev[match - 1] + 1)
        prev = np.maximum.accumulate(step)
        yield prev


def _aligned(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Indices of ``a`` in a longest common subsequence with ``b``: halves of ``a`` until a table fits in CELLS."""
    n, m = len(a), len(b)
    if n == 0 or m == 0:
        return np.zeros(0, dtype=np.int64)
    if n == 1:
        return np.flatnonzero(a == b[b == a[0]][0]) if (b == a[0]).any() else np.zeros(0, dtype=np.int64)
    if n * m > CELLS:
        half = n // 2
        for head in _rows(a[:half], b):
            pass
        for tail in _rows(a[:half - 1:-1], b[::-1]):
            pass
        cut = int((head + tail[::-1]).argmax())
        return np.concatenate([_aligned(a[:half], b[:cut]), half + _aligned(a[half:], b[cut:])])
    came = np.zeros((n + 1, m + 1), dtype=bool)  # length grew against the row above
    prev = np.zeros(m + 1, dtype=np.int32)
    for i, cur in enumerate(_rows(a, b), 1):
        came[i] = cur > prev
        prev = cur
    out, i, j = [], n, m
    while i and j:  # walk back: leave a row that adds nothing, else find where it matched
        if not came[i, j]:
            i -= 1
            continue
        while not (b[j - 1] == a[i - 1]):
            j -= 1
        out.append(i - 1)
        i, j = i - 1, j - 1
    return np.array(out[::-1], dtype=np.int64)


def shared_lines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Mask of ``a``'s entries in a longest common subsequence with ``b``, in memory linear in both."""
    n, m = len(a), len(b)
    keep = np.zeros(n, dtype=bool)
    lo = 0
    while lo < min(n, m) and a[lo] == b[lo]:
        lo += 1
    hi = 0
    while hi < min(n, m) - lo and a[n - 1 - hi] == b[m - 1 - hi]:
        hi += 1
    keep[:lo] = True
    keep[n - hi:] = True
    a, b = a[lo:n - hi], b[lo:m - hi]
    if len(a) == 0 or len(b) == 0 or set(a.tolist()).isdisjoint(b.tolist()):
        return keep
    common = np.intersect1d(a, b)
    ia, ib = np.flatnonzero(np.isin(a, common)), np.flatnonzero(np.isin(b, common))
    keep[lo + ia[_aligned(a[ia], b[ib])]] = True
    return keep


def template(own: np.ndarray, marked: bool, near: list[np.ndarray]) -> np.ndarray:
    """Mask of ``own``'s lines that are template by its neighbours, those most telling first."""
    none = np.zeros(len(own), dtype=bool)
    if not near or not len(own):
        return none
    masks = [shared_lines(own, other) for other in near]
    if marked:
        return np.logical_and.reduce(masks) if len(masks) >= MAIN_VOTES else none
    if len(masks) == 1:
        return masks[0] if masks[0].sum() <= COPY_SHARE * min(len(own), len(near[0])) else none
    common = 2 * np.sum(masks, axis=0) > len(masks)
    rest = []
    for mask, other in zip(masks, near):
        left = min((~common).sum(), len(other) - (mask & common).sum())
        if (mask & ~common).sum() <= COPY_SHARE * left:
            rest.append(mask)
    if not rest:
        return common
    return common | (rest[0] & np.logical_or.reduce(rest[1:]) if len(rest) > 1 else rest[0])


def _line_hashes(pages: DataFrame) -> DataFrame:
    """host, path, content (hash of marked and lines), marked and line hashes of the pages."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            read = [compared_lines(read_lines(page)) for page in batch["html"]]
            yield batch[["key", "host", "path"]].assign(lines=[r[0] for r in read], marked=[r[1] for r in read])

    found = pages.mapInPandas(run, "key string, host string, path string, lines array<string>, marked boolean")
    found = found.select("key", "host", "path", "marked", F.transform("lines", lambda s: F.xxhash64(s)).alias("lines"))
    content = F.md5(F.concat(F.col("marked").cast("string"), F.lit(" "), F.array_join(F.col("lines").cast("array<string>"), " ")))
    return found.withColumn("content", content)


def numbered(hashed: DataFrame) -> DataFrame:
    """The distinct contents of each host with their number ``at`` in the order of (host, path).

    The order inside a range partition comes from a window per partition; one row per partition carries the
    count across.
    """
    n = int(hashed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    first = hashed.where(F.size("lines") > 0).groupBy("host", "content").agg(F.min(F.struct("path", "key")).alias("f")) \
        .select("f.key")
    rows = hashed.join(first, "key", "left_semi").dropDuplicates(["key"])
    placed = materialize(
        rows.repartitionByRange(n, "host", "path", "content").withColumn("part", F.spark_partition_id()), "page-lines")
    inside = Window.partitionBy("part").orderBy("host", "path", "content")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy("part").agg(F.count(F.lit(1)).alias("many")) \
        .select("part", F.coalesce(F.sum("many").over(before), F.lit(0)).alias("before"))  # one row per partition
    return placed.withColumn("k", F.row_number().over(inside)).join(F.broadcast(counts), "part") \
        .select((F.col("before") + F.col("k") - 1).alias("at"), "host", "path", "content", "marked", "lines")


def deletions(hashed: DataFrame) -> DataFrame:
    """host, content, deleted (numbers of lines outside of chrome) of contents with template lines."""
    rim = max(STEPS)
    rows = numbered(hashed)
    parts = int(hashed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = F.array_distinct(F.array(*(F.floor((F.col("at") + F.lit(d)) / F.lit(CHUNK)) for d in (0, -rim, rim))))
    spread = rows.withColumn("chunk", F.explode(chunks)).where("chunk >= 0") \
        .repartition(parts, "chunk").sortWithinPartitions("chunk", "at")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        window: dict[int, tuple] = {}
        chunk, todo, last = None, 0, -1

        def judged(at: int) -> tuple | None:
            host, path, content, marked, lines = window[at]
            near = []
            for d in STEPS:
                for k in (at - d, at + d):
                    if k in window and window[k][0] == host:
                        near.append((-len(commonprefix([path, window[k][1]])), d, window[k][4]))
            near.sort(key=lambda x: x[:2])
            gone = np.flatnonzero(template(lines, marked, [x[2] for x in near]))
            return (host, content, gone.astype(np.int32)) if len(gone) else None

        def ready(until: int) -> list[tuple]:
            nonlocal todo
            out = []
            while todo <= until:
                if todo in window and (found := judged(todo)):
                    out.append(found)
                window.pop(todo - rim, None)
                todo += 1
            return out

        def frame(out: list[tuple]) -> pd.DataFrame:
            return pd.DataFrame(out, columns=["host", "content", "deleted"])

        for batch in batches:
            out: list[tuple] = []
            for c, at, host, path, content, marked, lines in zip(*(batch[x] for x in (
                    "chunk", "at", "host", "path", "content", "marked", "lines"))):
                if c != chunk:
                    if chunk is not None:
                        out.extend(ready(min(last, (chunk + 1) * CHUNK - 1)))
                    window.clear()
                    chunk, todo = c, c * CHUNK
                window[at] = host, path, content, marked, np.asarray(lines, dtype=np.int64)
                last = at
                out.extend(ready(min(at - rim, (c + 1) * CHUNK - 1)))
            if out:
                yield frame(out)
        if chunk is not None and (out := ready(min(last, (chunk + 1) * CHUNK - 1))):
            yield frame(out)

    return spread.mapInPandas(run, "host string, content string, deleted array<int>")


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text for every row of ``pages`` (page_id, url, html)."""
    host, path = url_parts(F.col("url"))
    key = F.md5(F.concat_ws("\x00", F.col("page_id").cast("string"), F.col("url"), F.col("html")))
    rows = pages.select("page_id", "url", "html", key.alias("key"), host.alias("host"), path.alias("path"))
    hashed = materialize(_line_hashes(rows.select("key", "host", "path", "html")), "page-hashes")
    gone = hashed.select("key", "host", "content").distinct().join(deletions(hashed), ["host", "content"]).select("key", "deleted")
    schema = f"page_id {pages.schema['page_id'].dataType.simpleString()}, url string, text string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = []
            for page, deleted in zip(batch["html"], batch["deleted"]):
                lines, _, keep = compared_lines(read_lines(page))
                if deleted is not None:
                    keep[np.asarray(deleted, dtype=np.int64)] = False
                texts.append("\n".join(t for t, k in zip(lines, keep) if k))
            yield batch[["page_id", "url"]].assign(text=texts)

    return rows.join(gone, "key", "left").select("page_id", "url", "html", "deleted").mapInPandas(run, schema)
