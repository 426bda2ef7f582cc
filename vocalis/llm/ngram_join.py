"""N-gram Jaccard join: documents whose shingle sets have Jaccard similarity >= 3/4, found through prefix trees.

A document's set is its distinct five-word shingles (the whole word sequence as
one when it has fewer words).  Equal sets are one class from the start, so
copies are never paired.

1. Sets.  One pass gives each document its class and size, and a fixed-size
   sketch of how often shingles repeat within a few MB of text.  The sketch,
   summed over all tasks, ranks shingles: the global order is (sketch count,
   hash), so shingles that many documents share come last.
2. Prefixes.  In any fixed order, the first ``e`` shingles that two linking sets
   share lie among each set's first ``n - ceil(3n/4) + e``; here e is 1 + n/8.
   These prefixes travel as packed arrays to one task per hash range; classes
   that share a prefix shingle and whose sizes allow a link become a group,
   named after its smallest class (its hub).  A class that shares fewer prefix
   shingles with others than any link needs is left out, and so are the
   rarest of its hubs as long as they hold under half of that number: then two
   linking sets still meet at one hub at least (``kept``).  Most copies of one text
   share one hub, so a class joins few groups however many shingles it shares.
3. Prefix trees.  The sets of the grouped classes meet by hub, in blocks of about
   ``BLOCK`` classes.  Each block's sets, in global order, form a trie; a set
   traverses it with shared partial overlaps and leaves a subtree as soon as
   the overlap so far and the lengths remaining cannot reach the threshold.
   Sets already connected need no probe, so a block of near copies takes a few
   probes instead of all pairs.
4. Components.  Verified links are joined by alternating large-star and
   small-star rounds over edge tables in the shared folder.

Groups larger than a block are joined block-wise first, then through one
set per component and block (again in blocks), and at last every block of sets
outside a group's largest component meets every block of the group, a pair of
blocks a task.  No link is lost, no task holds more than two blocks at once, and a
group of near copies, of which nearly all end in one component, costs in
proportion to its size.  Blocks are dealt by hash, so ``BLOCK`` is their mean.

The sketch (``2 ** SKETCH_BITS`` counters, 4 MB) and the filter of wanted
documents (``2 ** FILTER_BITS`` bits, 4 MB) are all that is broadcast; both are of
fixed size and only sort or save work, the result does not depend on them.
Classes and shingles are 64-bit hashes.

Defined cases: null, empty or blank texts have an empty set and link with
nothing; rows without doc_id get their set size, no component, and take no part;
repeated rows and equal sets share a component; other columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vocalis.llm.common import materialize, text_or_empty

WORDS = 5
SKETCH_BITS = 20
FILTER_BITS = 25
#: Classes per block (its mean at most); a trie holds two blocks at most.
BLOCK = 4096
#: Bytes of text hashed at once, shingles counted at once.
TEXT_BYTES = 1 << 22
COUNTED = 1 << 22
_SLICES = 64

_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[[32, *range(9, 14)]] = True
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += 32
_ODD = np.array([pow(0x9E3779B97F4A7C15, 2 * k + 1, 1 << 64) for k in range(WORDS)], dtype=np.uint64)


def _mix(h: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit multiplicative generator (published constants)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _power_table(n: int) -> np.ndarray:
    out = np.ones(1, dtype=np.uint64)
    step = 0x9E3779B97F4A7C15
    while len(out) < n:
        out = np.concatenate([out, out * np.uint64(step)])
        step = step * step % (1 << 64)
    return out


_POWERS = _power_table(1 << 12)


def word_hashes(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, words per text) of texts that lie one after the other as UTF-8 bytes."""
    global _POWERS
    word = ~_SEPARATOR[data]
    if not word.any():
        return np.zeros(0, np.uint64), np.zeros(len(ends), np.int64)
    begin = word.copy()
    begin[1:] &= ~word[:-1]
    bounds = ends[:-1][(ends[:-1] < len(data))]
    begin[bounds] |= word[bounds]
    begin[0] = word[0]
    starts = np.flatnonzero(begin)
    inner = np.flatnonzero(word)
    first = np.searchsorted(inner, starts)
    length = np.diff(np.append(first, len(inner)))
    if length.max() > len(_POWERS):
        _POWERS = _power_table(int(length.max()))
    place = np.arange(len(inner)) - np.repeat(first, length)
    total = np.add.reduceat((_LOWER[data[inner]] + np.uint64(1)) * _POWERS[place], first)
    count = np.diff(np.concatenate([[0], np.searchsorted(starts, ends)]))
    return _mix(total + length.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)), count


def shingle_sets(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingle hashes, text by text; set sizes)."""
    words, count = word_hashes(data, ends)
    at = np.concatenate([[0], np.cumsum(count)])
    owner = np.repeat(np.arange(len(count)), count)
    n = len(words)
    long = np.flatnonzero(owner[:max(0, n - WORDS + 1)] == owner[WORDS - 1:]) if n >= WORDS else np.zeros(0, np.int64)
    total = np.zeros(len(long), dtype=np.uint64)
    for k in range(WORDS):
        total += words[long + k] * _ODD[k]
    short = np.flatnonzero((count > 0) & (count < WORDS))
    whole = np.zeros(len(short), dtype=np.uint64)
    for k in range(WORDS - 1):
        has = count[short] > k
        whole[has] += words[at[short[has]] + k] * _ODD[k]
    whole += count[short].astype(np.uint64) * np.uint64(0xA0761D6478BD642F)
    text = np.concatenate([owner[long], short])
    hashes = _mix(np.concatenate([total, whole]))
    order = np.argsort(text, kind="stable")
    text, hashes = text[order], hashes[order]
    size = np.bincount(text, minlength=len(count)).astype(np.int64)
    edge = np.concatenate([[0], np.cumsum(size)])
    for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
        hashes[a:b].sort()
    keep = np.ones(len(hashes), dtype=bool)
    keep[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    return hashes[keep], np.bincount(text[keep], minlength=len(count)).astype(np.int64)


def set_classes(hashes: np.ndarray, size: np.ndarray) -> np.ndarray:
    """One 64-bit hash per set; 0 for empty sets."""
    out = np.zeros(len(size), dtype=np.uint64)
    busy = size > 0
    if busy.any():
        first = np.concatenate([[0], np.cumsum(size)])[:-1][busy]
        out[busy] = _mix(np.add.reduceat(_mix(hashes ^ np.uint64(0x2545F4914F6CDD1D)), first) + size[busy].astype(np.uint64))
    return out


def _blocks(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row, bytes, ends) of a batch's texts, about ``TEXT_BYTES`` at once."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + TEXT_BYTES, side="right")) - 1)
        yield i, j, data[offsets[i]:offsets[j]], offsets[i + 1:j + 1] - offsets[i]
        i = j


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return ((hashes * np.uint64(0x9FB21C651E98DF25)) >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def _extra(n: np.ndarray) -> np.ndarray:
    return 1 + n // 8


def prefix_length(n: np.ndarray) -> np.ndarray:
    """Each set's first so many shingles hold the first ``_extra(n)`` that it shares with any set it links with."""
    return n - (3 * n + 3) // 4 + _extra(n)


def needed(n: np.ndarray) -> np.ndarray:
    """Shingles that a set of size ``n`` and any set it links with have in both prefixes, at least."""
    return _extra((3 * n + 3) // 4)


def kept(hub: np.ndarray, cls: np.ndarray, shared: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hub, cls) to compare, from the number of prefix shingles that each class shares in groups of each hub.

    Two linking sets share ``needed`` prefix shingles, so a class with fewer in all has no link.  If each of the two
    drops hubs with under half of its ``needed`` shingles in all, one shared shingle's hub stays with both.
    """
    order = np.lexsort((hub, cls))
    hub, cls, shared, n = hub[order], cls[order], shared[order], n[order]
    first = np.ones(len(cls), dtype=bool)
    first[1:] = (hub[1:] != hub[:-1]) | (cls[1:] != cls[:-1])
    shared = np.add.reduceat(shared, np.flatnonzero(first)) if len(cls) else shared
    hub, cls, n = hub[first], cls[first], n[first]
    order = np.lexsort((shared, cls))
    hub, cls, shared, n = hub[order], cls[order], shared[order], n[order]
    start = np.ones(len(cls), dtype=bool)
    start[1:] = cls[1:] != cls[:-1]
    begin = np.flatnonzero(start)
    many = np.diff(np.append(begin, len(cls)))
    running = np.cumsum(shared)
    running -= np.repeat(running[begin] - shared[begin], many) if len(begin) else 0
    total = np.repeat(running[begin + many - 1], many) if len(begin) else running
    need = needed(n)
    keep = (total >= need) & (2 * running > need - 1)
    return hub[keep], cls[keep]


def order_keys(hashes: np.ndarray, sketch: np.ndarray) -> np.ndarray:
    """Place in the global order (sketch count, hash); ties keep hash order under a stable sort."""
    count = np.minimum(sketch[_bucket(hashes)], 0xFFFF).astype(np.uint64)
    return (count << np.uint64(48)) | (hashes >> np.uint64(16))


# ------------------------------------------------------------------ 1: sets and sketch
def describe(docs: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """(doc_id, cls, n) per row, written to the shared folder, and the sketch."""
    rows = docs.select("doc_id", text_or_empty().alias("text"))
    names = ["doc_id", "cls", "n", "slice", "counts"]
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, cls long, n long, slice int, counts binary"
    size = (1 << SKETCH_BITS) // _SLICES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SKETCH_BITS, dtype=np.int64)
        pending: list[np.ndarray] = []
        kind = None

        def count_repeats() -> None:
            h = np.sort(np.concatenate(pending))
            pending.clear()
            first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
            times = np.diff(np.append(first, len(h)))
            counts[:] += np.bincount(_bucket(h[first[times > 1]]), weights=times[times > 1],
                                     minlength=len(counts)).astype(np.int64)

        for batch in batches:
            ids, kind = batch.column("doc_id"), batch.column("doc_id").type
            for i, j, data, ends in _blocks(batch.column("text")):
                hashes, n = shingle_sets(data, ends)
                cls = set_classes(hashes, n)
                seen, at = np.unique(cls, return_index=True)  # copies count once
                if len(seen) < len(cls):
                    mine = np.zeros(len(cls), dtype=bool)
                    mine[at] = True
                    hashes = hashes[np.repeat(mine, n)]
                if len(hashes):
                    pending.append(hashes)
                if sum(map(len, pending)) >= COUNTED:
                    count_repeats()
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(i, j - i), pa.array(cls.view(np.int64)), pa.array(n), pa.nulls(j - i, pa.int32()),
                     pa.nulls(j - i, pa.binary())], names=names)
        if pending:
            count_repeats()
        busy = [k for k in range(_SLICES) if counts[k * size:(k + 1) * size].any()]
        if busy:
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(len(busy), kind), pa.nulls(len(busy), pa.int64()), pa.nulls(len(busy), pa.int64()),
                 pa.array(busy, pa.int32()),
                 pa.array([np.minimum(counts[k * size:(k + 1) * size], 0xFFFF).astype("<u2").tobytes() for k in busy],
                          pa.binary())], names=names)

    both = materialize(rows.mapInArrow(run, schema), "ngram-sets")

    def add(key: tuple, part: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(size, dtype=np.int64)
        for pdf in part:
            for c in pdf["counts"]:
                total += np.frombuffer(c, dtype="<u2")
        yield pd.DataFrame({"slice": [key[0]], "counts": [np.minimum(total, 0xFFFFFFFF).astype("<u4").tobytes()]})

    sketch = np.zeros(1 << SKETCH_BITS, dtype=np.uint32)
    for r in both.where(F.col("slice").isNotNull()).select("slice", "counts").groupBy("slice") \
            .applyInPandas(add, "slice int, counts binary").collect():  # fixed size
        sketch[r["slice"] * size:(r["slice"] + 1) * size] = np.frombuffer(r["counts"], dtype="<u4")
    return both.where(F.col("slice").isNull()).select("doc_id", "cls", "n"), sketch


# ------------------------------------------------------------------ 2: prefixes and groups
def groups(docs: DataFrame, sketch: np.ndarray) -> DataFrame:
    """Distinct (hub, cls): the classes to compare, each group under its smallest class."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shared = spark.sparkContext.broadcast(sketch)
    rows = docs.where(F.col("doc_id").isNotNull()).select(text_or_empty().alias("text"))
    names = ["part", "shingles", "owners", "classes", "sizes"]
    kinds = {"hubs": "<u8", "classes": "<u8", "shared": "<u4", "sizes": "<u4"}

    def packed(hashes: np.ndarray, n: np.ndarray, cls: np.ndarray) -> pa.RecordBatch:
        part = ((hashes >> np.uint64(40)) * np.uint64(parts) >> np.uint64(24)).astype(np.int64)
        owner = np.repeat(np.arange(len(n)), prefix_length(n))
        order = np.argsort(part, kind="stable")
        part, hashes, owner = part[order], hashes[order], owner[order]
        edge = np.searchsorted(part, np.arange(parts + 1))
        cols: list[list] = [[], [], [], [], []]
        for p in np.flatnonzero(np.diff(edge)):
            h, o = hashes[edge[p]:edge[p + 1]], owner[edge[p]:edge[p + 1]]
            mine, o = np.unique(o, return_inverse=True)
            for col, v in zip(cols, (int(p), h.astype("<u4").tobytes(), o.astype("<u4" if len(mine) > 0xFFFF else "<u2").tobytes(),
                                     cls[mine].astype("<u8").tobytes(), n[mine].astype("<u4").tobytes())):
                col.append(v)
        return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), *(pa.array(c, pa.binary()) for c in cols[1:])],
                                          names=names)

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def flush() -> pa.RecordBatch:
            cls = np.concatenate([g[2] for g in got])
            n = np.concatenate([g[1] for g in got])
            hashes = np.concatenate([g[0] for g in got])
            got.clear()
            _, at = np.unique(cls, return_index=True)
            mine = np.zeros(len(cls), dtype=bool)
            mine[at] = True
            return packed(hashes[np.repeat(mine, prefix_length(n))], n[mine], cls[mine])

        for batch in batches:
            for _, _, data, ends in _blocks(batch.column("text")):
                hashes, n = shingle_sets(data, ends)
                cls = set_classes(hashes, n)
                key = order_keys(hashes, shared.value)
                edge = np.concatenate([[0], np.cumsum(n)])
                busy = np.flatnonzero(n)
                take = prefix_length(n)
                first = [a + np.argsort(key[a:b], kind="stable")[:t]
                         for a, b, t in zip(edge[busy].tolist(), edge[busy + 1].tolist(), take[busy].tolist())]
                if first:
                    got.append((hashes[np.concatenate(first)], n[busy], cls[busy]))
                if sum(len(g[0]) for g in got) >= COUNTED:
                    yield flush()
        if got:
            yield flush()

    def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, classes, sizes = [], [], []
        for batch in batches:
            for s, o, c, n in zip(*(batch.column(k).to_pylist() for k in range(1, 5))):
                c, n = np.frombuffer(c, "<u8"), np.frombuffer(n, "<u4")
                o = np.frombuffer(o, "<u4" if len(c) > 0xFFFF else "<u2")
                shingles.append(np.frombuffer(s, "<u4"))
                classes.append(c[o])
                sizes.append(n[o])
        if not shingles:
            return
        s, c, n = (np.concatenate(x) for x in (shingles, classes, sizes))
        order = np.argsort(s, kind="stable")
        s = s[order]
        lone = np.ones(len(s), dtype=bool)  # shingles of one entry go first: most of them
        lone[1:] &= s[1:] != s[:-1]
        lone[:-1] &= s[1:] != s[:-1]
        s, c, n = s[~lone], c[order][~lone], n[order][~lone].astype(np.int64)
        order = np.lexsort((c, n, s))
        s, c, n = s[order], c[order], n[order]
        fresh = np.ones(len(s), dtype=bool)
        fresh[1:] = (s[1:] != s[:-1]) | (4 * n[:-1] < 3 * n[1:])  # sizes too far apart to link
        again = np.zeros(len(s), dtype=bool)
        again[1:] = ~fresh[1:] & (c[1:] == c[:-1])
        c, n, fresh = c[~again], n[~again], fresh[~again]
        first = np.flatnonzero(fresh)
        if not len(first):
            return
        many = np.diff(np.append(first, len(c)))
        hub = np.repeat(np.minimum.reduceat(c, first), many)
        keep = np.repeat(many > 1, many)
        hub, c, n = hub[keep], c[keep], n[keep]
        order = np.lexsort((hub, c))
        hub, c, n = hub[order], c[order], n[order]
        new = np.ones(len(c), dtype=bool)
        new[1:] = (hub[1:] != hub[:-1]) | (c[1:] != c[:-1])
        at = np.flatnonzero(new)
        shared_here = np.diff(np.append(at, len(c)))
        hub, c, n = hub[at], c[at], n[at]
        part = ((_mix(c) >> np.uint64(40)) * np.uint64(parts) >> np.uint64(24)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        edge = np.searchsorted(part[order], np.arange(parts + 1))
        cols: list[list] = [[], [], [], [], []]
        for p in np.flatnonzero(np.diff(edge)):
            mine = order[edge[p]:edge[p + 1]]
            for col, v in zip(cols, (int(p), hub[mine].astype("<u8").tobytes(), c[mine].astype("<u8").tobytes(),
                                     shared_here[mine].astype("<u4").tobytes(), n[mine].astype("<u4").tobytes())):
                col.append(v)
        if cols[0]:
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int32()), *(pa.array(x, pa.binary()) for x in cols[1:])],
                names=["part", "hubs", "classes", "shared", "sizes"])

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: dict[str, list[np.ndarray]] = {name: [] for name in kinds}
        for batch in batches:
            for name, kind in kinds.items():
                got[name].extend(np.frombuffer(x, kind) for x in batch.column(name).to_pylist())
        if got["hubs"]:
            hub, c, times, n = (np.concatenate(got[name]) for name in kinds)
            hub, c = kept(hub, c, times.astype(np.int64), n.astype(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(hub.view(np.int64)), pa.array(c.view(np.int64))], names=["hub", "cls"])

    posted = rows.mapInArrow(prefixes, "part int, shingles binary, owners binary, classes binary, sizes binary")
    counted = posted.repartitionById(parts, F.col("part")) \
        .mapInArrow(grouped, "part int, hubs binary, classes binary, shared binary, sizes binary")
    return counted.repartitionById(parts, F.col("part")).mapInArrow(chosen, "hub long, cls long")


# ------------------------------------------------------------------ 3: prefix trees
class Trie:
    """Sets of shingles in one global order, as a tree of token runs with shared beginnings.

    Only shingles of two sets or more are in it.  A run holds at most ``RUN`` shingles and knows the longest
    and the smallest set below it.
    """

    RUN = 32

    def __init__(self, sets: list[np.ndarray], sketch: np.ndarray):
        self.size = np.array([len(s) for s in sets], dtype=np.int64)
        kinds, inv, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        order = np.lexsort((kinds, sketch[_bucket(kinds)]))[::-1]  # common shingles first: longest shared beginnings
        rank = np.empty(len(kinds), dtype=np.int64)
        rank[order] = np.arange(len(kinds))
        self.kinds = len(kinds)
        edge = np.concatenate([[0], np.cumsum(self.size)])
        common = times > 1
        self.sets = []
        for a, b in zip(edge[:-1], edge[1:]):
            mine = inv[a:b]
            self.sets.append(np.sort(rank[mine[common[mine]]]))
        paths = sorted(range(len(sets)), key=lambda k: self.sets[k].astype(">u4").tobytes())
        begin, end, parent, cut, depth, member, tokens = [], [], [], [], [], [], []
        stack: list[int] = []
        at = 0
        last = np.zeros(0, dtype=np.int64)
        for k in paths:
            own = self.sets[k]
            m = min(len(own), len(last))
            differ = np.flatnonzero(own[:m] != last[:m])
            same = int(differ[0]) if len(differ) else m
            while stack and depth[stack[-1]] >= same and not (depth[stack[-1]] == same == 0 and same == len(own)):
                if depth[stack[-1]] < same:
                    break
                stack.pop()
            d = same
            while True:
                stop = min(len(own), d + self.RUN)
                begin.append(at)
                at += stop - d
                end.append(at)
                tokens.append(own[d:stop])
                parent.append(stack[-1] if stack else -1)
                cut.append(d - depth[stack[-1]] if stack else 0)
                depth.append(d)
                member.append(-1)
                stack.append(len(begin) - 1)
                d = stop
                if d == len(own):
                    break
            member[-1] = k
            last = own
        self.begin, self.end, self.parent, self.cut, self.depth, self.member = (
            np.array(x, dtype=np.int64) for x in (begin, end, parent, cut, depth, member))
        self.tokens = np.concatenate(tokens)
        longest = np.array([len(self.sets[k]) if k >= 0 else 0 for k in member], dtype=np.int64)
        smallest = np.array([self.size[k] if k >= 0 else np.iinfo(np.int64).max for k in member], dtype=np.int64)
        level = np.zeros(len(begin), dtype=np.int64)
        for r in range(len(begin)):
            if parent[r] >= 0:
                level[r] = level[parent[r]] + 1
        for r in range(len(begin) - 1, -1, -1):
            if (p := parent[r]) >= 0:
                longest[p] = max(longest[p], longest[r])
                smallest[p] = min(smallest[p], smallest[r])
        self.longest, self.smallest = longest, smallest
        by_level = np.argsort(level, kind="stable")
        self.levels = np.split(by_level, np.flatnonzero(np.diff(level[by_level])) + 1)
        self._mark = np.zeros(self.kinds, dtype=bool)
        self._so_far = np.zeros(len(self.tokens) + 1, dtype=np.int64)
        self._at_start = np.zeros(len(begin), dtype=np.int64)
        self._alive = np.zeros(len(begin), dtype=bool)

    def probe(self, k: int) -> np.ndarray:
        """Members whose sets link with set ``k``'s (itself left out)."""
        own, size = self.sets[k], self.size[k]
        self._mark[own] = True
        found = []
        for runs in self.levels:
            up = self.parent[runs]
            child = up >= 0
            here = np.zeros(len(runs), dtype=np.int64)
            if child.any():
                ok = np.ones(len(runs), dtype=bool)
                ok[child] = self._alive[up[child]]
                self._alive[runs] = False
                runs, up = runs[ok], up[ok]
                if not len(runs):
                    break
                child = up >= 0
                cut = self.cut[runs]
                here = np.where(child, self._at_start[up], 0)
                inside = child & (cut > 0)
                here[inside] += self._so_far[self.begin[up[inside]] + cut[inside] - 1]
            reach = here + np.minimum(self.longest[runs] - self.depth[runs], len(own) - here)
            ok = 7 * reach >= 3 * (size + self.smallest[runs])  # else no set below can reach the threshold
            self._alive[runs] = ok
            runs, here = runs[ok], here[ok]
            if not len(runs):
                break
            self._at_start[runs] = here
            length = self.end[runs] - self.begin[runs]
            total = int(length.sum())
            ends = np.cumsum(length)
            flat = np.arange(total) + np.repeat(self.begin[runs] - (ends - length), length)
            hits = np.cumsum(self._mark[self.tokens[flat]])
            before = np.where(ends > length, hits[np.maximum(ends - length, 1) - 1], 0) if total else np.zeros(len(runs), np.int64)
            if total:
                self._so_far[flat] = hits - np.repeat(before, length)
            reached = here + np.where(length > 0, (hits[np.maximum(ends, 1) - 1] if total else 0) - before, 0)
            leaf = self.member[runs] >= 0
            who = self.member[runs[leaf]]
            found.append(who[7 * reached[leaf] >= 3 * (size + self.size[who])])
        self._mark[own] = False
        self._alive[:] = False
        hit = np.concatenate(found) if found else np.zeros(0, dtype=np.int64)
        return hit[hit != k]


def connect_some(sets: list[np.ndarray], sketch: np.ndarray, asking: np.ndarray) -> np.ndarray:
    """Component number of each set under the links that the sets ``asking`` have; each of them is probed."""
    root = np.arange(len(sets))
    if len(sets) > 1:
        trie = Trie(sets, sketch)
        for k in np.flatnonzero(asking).tolist():
            joined = np.unique(root[np.append(trie.probe(k), k)])
            if len(joined) > 1:
                root[np.isin(root, joined)] = joined[0]
    return root


def connect(sets: list[np.ndarray], sketch: np.ndarray) -> np.ndarray:
    """Component number (its smallest index) of each set under links; equal to joining all linked pairs.

    Pairs of sets that were never probed lie in the largest component, so no link is lost.
    """
    root = np.arange(len(sets))
    if len(sets) < 2:
        return root
    trie = Trie(sets, sketch)
    done = np.zeros(len(sets), dtype=bool)
    while True:
        main = np.bincount(root).argmax()
        open_ = np.flatnonzero(~done & (root != main)) if done.any() else np.array([int(trie.size.argmax())])
        if not len(open_):
            return root
        k = int(open_[0])
        done[k] = True
        joined = np.unique(root[np.append(trie.probe(k), k)])
        if len(joined) > 1:
            root[np.isin(root, joined)] = joined[0]


def _link_groups(members: DataFrame, sets: DataFrame, sketch: np.ndarray) -> DataFrame:
    """Edges (a, b) that connect the linked classes of each group; ``members`` has (hub, block, cls, rep).

    With a column ``asking``, only links of the classes for which it holds.
    """
    some = "asking" in members.columns
    spark = members.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shared = spark.sparkContext.broadcast(sketch)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, classes, own, asks = None, [], [], []

        def edges() -> list[tuple[int, int]]:
            order = np.argsort(np.array(classes, dtype=np.int64).view(np.uint64), kind="stable")
            names = [classes[k] for k in order]
            sets_ = [own[k] for k in order]
            root = connect_some(sets_, shared.value, np.array(asks)[order]) if some else connect(sets_, shared.value)
            return [(names[k], names[r]) for k, r in enumerate(root.tolist()) if k != r]

        def out(found: list[tuple[int, int]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)], names=["a", "b"])

        for batch in batches:
            found: list[tuple[int, int]] = []
            for hub, block, cls, ask, blob in zip(*(batch.column(c).to_pylist() for c in columns)):
                if (hub, block) != key:
                    if len(classes) > 1:
                        found.extend(edges())
                    key, classes, own, asks = (hub, block), [], [], []
                classes.append(cls)
                asks.append(ask)
                own.append(np.frombuffer(blob, "<u8"))
            if found:
                yield out(found)
        if len(classes) > 1 and (found := edges()):
            yield out(found)

    columns = ["hub", "block", "cls", "asking", "shingles"]
    joined = (members if some else members.withColumn("asking", F.lit(True))).join(sets, "rep").select(*columns)
    return joined.repartition(parts, "hub", "block").sortWithinPartitions("hub", "block").mapInArrow(run, "a long, b long")


def _wanted(ids: DataFrame) -> np.ndarray:
    """Bits of the hashes of some document ids: a filter of fixed size."""
    low = 15
    at = F.pmod(F.xxhash64("rep"), F.lit(1 << FILTER_BITS))
    bits = ids.select(at.alias("at")).distinct().select(
        F.shiftright("at", low).cast("int").alias("slice"), F.col("at").bitwiseAND(F.lit((1 << low) - 1)).cast("int").alias("bit"))

    def mark(pdf: pd.DataFrame) -> pd.DataFrame:
        own = np.zeros(1 << low, dtype=bool)
        own[pdf["bit"].to_numpy()] = True
        return pd.DataFrame({"slice": [pdf["slice"].iloc[0]], "bits": [np.packbits(own).tobytes()]})

    out = np.zeros((1 << FILTER_BITS) // 8, dtype=np.uint8)
    size = (1 << low) // 8
    for r in bits.groupBy("slice").applyInPandas(mark, "slice int, bits binary").collect():  # fixed size
        out[r["slice"] * size:(r["slice"] + 1) * size] = np.frombuffer(r["bits"], dtype=np.uint8)
    return out


def _sets_of(docs: DataFrame, wanted: np.ndarray) -> DataFrame:
    """(rep, shingles) of the documents that pass the filter."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(wanted)
    rows = docs.where(F.col("doc_id").isNotNull()).select(
        F.col("doc_id").alias("rep"), F.pmod(F.xxhash64("doc_id"), F.lit(1 << FILTER_BITS)).alias("at"),
        text_or_empty().alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            at = batch.column("at").to_numpy(zero_copy_only=False)
            rows = np.flatnonzero(bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1)
            if not len(rows):
                continue
            batch = batch.take(pa.array(rows))
            ids = batch.column("rep")
            for i, j, data, ends in _blocks(batch.column("text")):
                hashes, n = shingle_sets(data, ends)
                edge = np.concatenate([[0], np.cumsum(n)])
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(i, j - i), pa.array([hashes[a:b].tobytes() for a, b in zip(edge[:-1], edge[1:])], pa.binary())],
                    names=["rep", "shingles"])

    return rows.mapInArrow(run, f"rep {docs.schema['doc_id'].dataType.simpleString()}, shingles binary")


# ------------------------------------------------------------------ 4: components
def components(edges: DataFrame, name: str = "ngram-edges") -> DataFrame:
    """(cls, root) of every node of ``edges`` (a, b): root is the component's smallest node.

    Alternating large-star and small-star rounds; each round's edges go to the shared folder.
    """
    def smallest(e: DataFrame) -> DataFrame:
        return e.groupBy("a").agg(F.min("b").alias("m"))

    def fingerprint(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    e = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    seen = fingerprint(e)
    while seen[0]:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        m = smallest(both).select("a", F.least("a", "m").alias("m"))
        large = both.join(m, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")) \
            .where("a <> b").distinct()
        m = smallest(large)
        small = large.join(m, "a")
        star = small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")) \
            .unionByName(m.select("a", F.col("m").alias("b"))).where("a <> b") \
            .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        e = materialize(star, name)
        now = fingerprint(e)
        if now == seen:
            break
        seen = now
    return e.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "cls") \
        .unionByName(e.select(F.col("b").alias("cls"), F.col("b").alias("root")).distinct())


def _linked_edges(docs: DataFrame, described: DataFrame, sketch: np.ndarray, block: int) -> DataFrame:
    """Edges over classes whose components are those of all links."""
    found = materialize(groups(docs, sketch), "ngram-groups")
    reps = described.where(F.col("doc_id").isNotNull() & (F.col("n") > 0)).groupBy("cls").agg(F.min("doc_id").alias("rep"))
    sizes = found.groupBy("hub").agg(F.count(F.lit(1)).alias("many")).where(F.col("many") > 1)
    members = materialize(
        found.join(sizes, "hub").join(reps, "cls")
        .select("hub", "cls", "rep", F.ceil(F.col("many") / block).cast("int").alias("blocks"))
        .withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int")), "ngram-members")
    sets = _sets_of(docs, _wanted(members.select("rep")))
    large = members.where("blocks > 1")
    edges = materialize(_link_groups(members, sets, sketch), "ngram-links")
    if large.limit(1).count() == 0:
        return edges

    # groups of several blocks: one set per component and block, then all sets outside the largest component
    def labelled(e: DataFrame) -> DataFrame:
        return large.join(components(e), "cls", "left").withColumn("root", F.coalesce("root", "cls"))

    one = labelled(edges).groupBy("hub", "block", "root").agg(F.min(F.struct("cls", "rep")).alias("s")) \
        .select("hub", "root", "s.cls", "s.rep")
    ones = one.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / block).alias("ones"))
    one = one.join(ones, "hub").withColumn("block", F.pmod(F.xxhash64("root"), "ones").cast("long"))
    edges = materialize(edges.unionByName(_link_groups(one.select("hub", "block", "cls", "rep"), sets, sketch)), "ngram-links")
    now = materialize(labelled(edges), "ngram-labelled")
    counted = now.groupBy("hub", "root").agg(F.count(F.lit(1)).alias("many"))
    main = counted.groupBy("hub").agg(
        F.max_by("root", F.struct("many", "root")).alias("main"),
        F.ceil((F.sum("many") - F.max("many")) / block).cast("long").alias("asked"))
    marked = now.join(main.where("asked > 0"), "hub") \
        .withColumn("asks", F.when(F.col("root") != F.col("main"), F.pmod(F.xxhash64("cls", F.lit(1)), "asked").cast("long")))
    if marked.limit(1).count() == 0:
        return edges
    # a task per block of sets outside and block of all sets
    to_all = marked.withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("asked") - 1))) \
        .where(F.col("asks").isNull() | (F.col("asks") != F.col("k"))) \
        .select("hub", (F.col("k") * F.col("blocks") + F.col("block")).alias("block"), "cls", "rep", F.lit(False).alias("asking"))
    asking = marked.where("asks IS NOT NULL").withColumn("k", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))) \
        .select("hub", (F.col("asks") * F.col("blocks") + F.col("k")).alias("block"), "cls", "rep", F.lit(True).alias("asking"))
    return materialize(edges.unionByName(_link_groups(to_all.unionByName(asking), sets, sketch)), "ngram-links")


def join_documents(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``docs``."""
    described, sketch = describe(docs)
    roots = components(_linked_edges(docs, described, sketch, block))
    known = described.where(F.col("doc_id").isNotNull() & (F.col("n") > 0))
    lowest = known.groupBy("cls").agg(F.min("doc_id").alias("low")).join(roots, "cls", "left") \
        .withColumn("root", F.coalesce("root", "cls"))
    low = lowest.groupBy("root").agg(F.min("low").alias("component_id"))
    of_class = lowest.join(low, "root").select("cls", "component_id")
    busy = F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("cls"))
    return described.withColumn("cls", busy).join(of_class, "cls", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """``docs`` with one row per component: the one with the smallest doc_id, of several rows with that id one.

    Rows are told apart by a number of their own, not by doc_id: rows that share a doc_id but not their text are different
    documents.  Rows without doc_id and rows without words stay.  Columns of any name are passed through.
    """
    number = F.when(F.col("row")["doc_id"].isNotNull(), F.monotonically_increasing_id())
    rows = materialize(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
                       .withColumn("number", number), "ngram-rows")
    found = join_documents(rows.select(F.col("number").alias("doc_id"), F.col("row")["text"].alias("text")), block)
    linked = materialize(
        found.where(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0)).select(F.col("doc_id").alias("number"), "component_id")
        .join(rows.select("number", F.col("row")["doc_id"].alias("doc_id")), "number"), "ngram-linked")
    lowest = linked.groupBy("component_id").agg(F.min("doc_id").alias("doc_id"))
    first = linked.join(lowest, ["component_id", "doc_id"]).groupBy("component_id").agg(F.min("number").alias("first"))
    gone = linked.join(first, "component_id").where(F.col("number") != F.col("first")).select("number")
    return rows.join(gone, "number", "left_anti").select(*[F.col("row")[c].alias(c) for c in docs.columns])
