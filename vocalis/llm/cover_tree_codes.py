"""Vector codes by Lloyd's algorithm over cover trees.

Vectors of whole numbers are cut into equal parts, and each part position has a
codebook of ``ENTRIES`` entries.  The table is read once into blocks of ``BLOCK``
vectors, where they lie; in each block, every part position gets a cover tree: a node
is a ball around one of its points, its children are a net of points farther apart than
half its radius, and the points of a node lie next to each other, so that cumulative sums
give any node's sum and count by one subtraction.  The blocks are written to the shared
folder.

In a round, each tree is walked from its root.  A node of radius r around p goes to the
nearest entry c as a whole when every other entry is farther from p than c by more than
2 r, by the triangle inequality; entries that far are dropped for all below.  Only nodes for which
this stays open go on to their children, and leaves compare their points exactly, in whole
numbers.  A round returns one sum and count per entry, part and block, which Spark adds up.

Defined cases: a null vector, or one with a null or non-finite component, is dropped, and
so is one whose length is not that of the vector with the smallest id; a null id is kept and counts as the
largest; repeated ids and vectors count each, and the smaller vector comes first among equal
ids; fewer vectors than entries give fewer entries; a length that is no multiple of the
parts is filled up with zeros; an entry nearest to nothing stays; ties go to the lower entry;
numbers too large for 64-bit squares are compared as Python integers, and an error beyond 64
bits is given as the largest long; columns other than
the named ones are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vocalis.llm.common import materialize

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
#: Vectors of a block; points below which a node is not split.
BLOCK = 8192
LEAF = 24
#: Label totals are broadcast up to this many, beyond that joined with a shuffle.
MAX_BROADCAST_LABELS = 1 << 16

_SAFE = 1 << 62
_MOST = (1 << 63) - 1
#: Sums travel as two numbers, high * _BASE + low, so that no sum of finite components is too long for a decimal.
_BASE = 10 ** 30


def _wide(values: np.ndarray, width: int) -> np.ndarray:
    """``values`` as 64-bit integers if squared distances of ``width`` components fit, else as Python integers."""
    most = max((abs(int(values.max())), abs(int(values.min())))) if values.size else 0
    return values if 4 * most * most * max(width, 1) < _SAFE else values.astype(object)


def scaled(vectors: np.ndarray) -> np.ndarray:
    """floor(SCALE * x) as integers."""
    big = np.floor(vectors.astype(np.float64) * SCALE)
    if not big.size or np.abs(big).max() < 2.0 ** 53:
        return big.astype(np.int64)
    whole = [int(b) if np.isfinite(b) else int(x) * SCALE for b, x in zip(big.ravel(), vectors.ravel())]
    return np.array(whole, dtype=object).reshape(big.shape)


def distances(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of all points to all entries."""
    diff = points[:, None, :] - entries[None, :, :]
    return (diff * diff).sum(axis=2)


# ------------------------------------------------------------------ trees
class Tree:
    """A cover tree over points: nodes in breadth-first order, the points of each next to each other in ``order``."""

    def __init__(self, order, centre, radius, begin, end, child, children):
        self.order, self.centre, self.radius = order, centre, radius
        self.begin, self.end, self.child, self.children = begin, end, child, children

    FIELDS = (("order", "<i4"), ("centre", "<i4"), ("radius", "<f8"), ("begin", "<i4"), ("end", "<i4"), ("child", "<i4"),
              ("children", "<i4"))

    def to_bytes(self) -> bytes:
        parts = [np.ascontiguousarray(getattr(self, name), dtype=kind).tobytes() for name, kind in self.FIELDS]
        return np.array([len(self.order), len(self.centre)], dtype="<i4").tobytes() + b"".join(parts)

    @classmethod
    def from_bytes(cls, data: bytes) -> Tree:
        points, nodes = np.frombuffer(data, "<i4", 2).tolist()
        at, out = 8, []
        for name, kind in cls.FIELDS:
            n = points if name == "order" else nodes
            out.append(np.frombuffer(data, kind, n, at))
            at += n * np.dtype(kind).itemsize
        return cls(*out)


def net(points: np.ndarray, centre: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Points of a net, the first being ``centre``; for every point, which of them is nearest and how far.

    The farthest point joins until none is farther than half of the first radius.
    """
    away = np.sqrt(((points - points[centre]) ** 2).sum(axis=1))
    owner = np.zeros(len(points), dtype=np.int32)
    chosen, goal = [centre], away.max() / 2
    while True:
        far = int(away.argmax())
        if away[far] <= goal:
            return np.array(chosen), owner, away
        d = np.sqrt(((points - points[far]) ** 2).sum(axis=1))
        near = d < away
        owner[near], away[near] = len(chosen), d[near]
        chosen.append(far)


def build_tree(points: np.ndarray, leaf: int = LEAF) -> Tree:
    """The cover tree of ``points``; distances are rounded only here, and radii are rounded up."""
    real = points.astype(np.float64)
    n = len(real)
    order = np.arange(n)
    first = int(((real - real.mean(axis=0)) ** 2).sum(axis=1).argmin())
    centre, begin, end, child, children = [first], [0], [n], [0], [0]
    radius = [float(np.sqrt(((real - real[first]) ** 2).sum(axis=1).max()))]
    k = 0
    while k < len(centre):
        b, e = begin[k], end[k]
        if e - b > leaf and radius[k] > 0:
            inside = order[b:e].copy()
            chosen, owner, away = net(real[inside], int(np.flatnonzero(inside == centre[k])[0]))
            by_owner = np.argsort(owner, kind="stable")
            sizes = np.bincount(owner, minlength=len(chosen))
            order[b:e] = inside[by_owner]
            ends = b + np.cumsum(sizes)
            child[k], children[k] = len(centre), len(chosen)
            centre += inside[chosen].tolist()
            begin += (ends - sizes).tolist()
            end += ends.tolist()
            radius += np.maximum.reduceat(away[by_owner], np.cumsum(sizes) - sizes).tolist()
            child += [0] * len(chosen)
            children += [0] * len(chosen)
        k += 1
    # rounded up by far more than the rounding of a distance
    return Tree(order, np.array(centre), np.array(radius) * (1 + 1e-9), np.array(begin), np.array(end), np.array(child), np.array(children))


def assign(tree: Tree, points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    """The nearest entry of each point in tree order, -1 where whole nodes say it; (begin, end, entry) of such nodes."""
    found = np.full(len(points), -1, dtype=np.int64)
    whole = []
    nodes = np.zeros(1 if len(points) else 0, dtype=np.int64)
    open_entries = np.ones((len(nodes), len(entries)), dtype=bool)
    while len(nodes):
        exact = distances(points[tree.centre[nodes]], entries)
        away = np.where(open_entries, np.sqrt(exact.astype(np.float64)), np.inf)
        best = away.min(axis=1)
        open_entries = away - best[:, None] <= 2 * tree.radius[nodes][:, None] + 1e-9 * (1 + best[:, None])
        alone = open_entries.sum(axis=1) == 1
        point = ~alone & (tree.radius[nodes] == 0)  # equal points: compared once, exactly
        closest = _first_least(exact, open_entries)
        done = alone | point
        if done.any():
            whole.append((tree.begin[nodes[done]], tree.end[nodes[done]], closest[done]))
        leaves = ~done & (tree.children[nodes] == 0)
        if leaves.any():
            size = (tree.end - tree.begin)[nodes[leaves]]
            at = np.arange(size.sum()) + np.repeat(tree.begin[nodes[leaves]] - (np.cumsum(size) - size), size)
            found[at] = _first_least(distances(points[tree.order[at]], entries), np.repeat(open_entries[leaves], size, axis=0))
        down = np.flatnonzero(~done & ~leaves)
        width = tree.children[nodes[down]]
        below = np.arange(width.sum()) + np.repeat(tree.child[nodes[down]] - (np.cumsum(width) - width), width)
        open_entries = np.repeat(open_entries[down], width, axis=0)
        nodes = below
    return found, whole


def _first_least(exact: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Index of the least allowed distance of each row, the lower one of equals."""
    least = np.where(among, exact, exact.max(axis=1, keepdims=True) + 1) if exact.size else exact
    return least.argmin(axis=1).astype(np.int64)


def totals(tree: Tree, points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum and number of the points nearest to each entry."""
    found, whole = assign(tree, points, entries)
    inner = points[tree.order]
    sums = np.zeros(entries.shape, dtype=object)
    counts = np.zeros(len(entries), dtype=np.int64)
    at = np.flatnonzero(found >= 0)
    for k in np.unique(found[at]):
        mine = at[found[at] == k]
        sums[k] += inner[mine].sum(axis=0)
        counts[k] += len(mine)
    if whole:
        cumulative = np.concatenate([np.zeros((1, inner.shape[1]), dtype=inner.dtype), np.cumsum(inner, axis=0)])
        begin, end, entry = (np.concatenate(x) for x in zip(*whole))
        np.add.at(counts, entry, end - begin)
        for k in np.unique(entry):
            mine = entry == k
            sums[k] += (cumulative[end[mine]] - cumulative[begin[mine]]).sum(axis=0)
    return sums, counts


def codes(tree: Tree, points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry and exact squared distance of each point, in the points' own order."""
    found, whole = assign(tree, points, entries)
    for begin, end, entry in whole:
        size = end - begin
        found[np.arange(size.sum()) + np.repeat(begin - (np.cumsum(size) - size), size)] = np.repeat(entry, size)
    out = np.empty(len(points), dtype=np.int64)
    out[tree.order] = found
    diff = points - entries[out]
    return out, (diff * diff).sum(axis=1)


# ------------------------------------------------------------------ blocks
def finite_vectors(vectors: DataFrame) -> DataFrame:
    """Rows whose vector has no null and no non-finite component; (vec_id, label, v) with v as doubles."""
    v = F.col("embedding").cast("array<double>")
    good = F.col("embedding").isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vectors.where(F.coalesce(good, F.lit(False))).select("vec_id", "label", v.alias("v"))


def first_entries(kept: DataFrame, entries: int = ENTRIES) -> np.ndarray:
    """The whole-number vectors with the smallest ids, ascending, of the length of the first; a bounded number."""
    order = [F.col("vec_id").asc_nulls_last(), F.col("v")]
    first = kept.select("vec_id", "v").orderBy(*order).limit(1).collect()
    if not first:
        return np.zeros((0, 0), dtype=np.int64)
    size = len(first[0]["v"])
    rows = kept.select("vec_id", "v").where(F.size("v") == size).orderBy(*order).limit(entries).collect()
    return scaled(np.array([r["v"] for r in rows], dtype=np.float64).reshape(len(rows), size))


def cut(vectors: np.ndarray, parts: int) -> np.ndarray:
    """(vectors, parts, width), filled up with zeros if need be."""
    width = -(-vectors.shape[1] // parts)
    fill = np.zeros((len(vectors), width * parts - vectors.shape[1]), dtype=vectors.dtype)
    return np.concatenate([vectors, fill], axis=1).reshape(len(vectors), parts, width)


def build_blocks(kept: DataFrame, size: int, parts: int = PARTS, block: int = BLOCK) -> DataFrame:
    """Blocks of vectors with a tree for each part position, written to the shared folder.

    Whole numbers beyond 64 bits are kept as text.
    """
    id_type, label_type = kept.schema["vec_id"].dataType.simpleString(), kept.schema["label"].dataType.simpleString()

    def block_row(rows: pa.Table) -> pa.RecordBatch:
        flat = rows.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        points = cut(scaled(flat.reshape(rows.num_rows, size)), parts)
        trees = [build_tree(points[:, p]).to_bytes() for p in range(parts)]
        wide = points.dtype == object
        return pa.RecordBatch.from_arrays([
            pa.array([rows.column(c).to_pylist()], pa.list_(rows.schema.field(c).type)) for c in ("vec_id", "label")] + [
            pa.array([None if wide else points.astype("<i8").tobytes()], pa.binary()),
            pa.array([[str(x) for x in points.ravel()] if wide else None], pa.list_(pa.string())),
            pa.array([trees], pa.list_(pa.binary()))], names=["vec_ids", "labels", "numbers", "large", "trees"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            rows = pa.Table.from_batches(held)
            while rows.num_rows >= block:
                yield block_row(rows.slice(0, block))
                rows = rows.slice(block)
            held = rows.to_batches()
        rows = pa.Table.from_batches(held) if held else None
        if rows is not None and rows.num_rows:
            yield block_row(rows)

    return materialize(kept.where(F.size("v") == size).mapInArrow(
        run, f"vec_ids array<{id_type}>, labels array<{label_type}>, numbers binary, large array<string>, trees array<binary>"),
        "cover-trees")


def _points(row: dict, parts: int) -> np.ndarray:
    if row["numbers"] is not None:
        flat = np.frombuffer(row["numbers"], dtype="<i8")
    else:
        flat = np.array([int(x) for x in row["large"]], dtype=object)
    return flat.reshape(len(row["vec_ids"]), parts, -1)


def _ready(points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as 64-bit integers where that is exact."""
    most = _wide(np.concatenate([points, entries]), points.shape[1])
    return (points, entries) if most.dtype != object else (points.astype(object), entries.astype(object))


def lloyd_round(blocks: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks (parts, entries, width) after one round; only sums and counts per entry reach the driver."""
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                points = _points(row, parts)
                out = []
                for p in range(parts):
                    sums, counts = totals(Tree.from_bytes(row["trees"][p]), *_ready(points[:, p], books[p]))
                    out += [(p, k, -1, int(counts[k])) for k in range(entries) if counts[k]]
                    out += [(p, k, j, int(sums[k, j])) for k in range(entries) if counts[k] for j in range(width)]
                p, k, j, v = zip(*out)
                high, low = zip(*(divmod(x, _BASE) for x in v))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, pa.int32()) for x in (p, k, j)] + [pa.array(map(str, x), pa.string()) for x in (high, low)],
                    names=["p", "k", "j", "high", "low"])

    def add_up(name: str):
        return F.sum(F.col(name).cast("decimal(38,0)")).alias(name)

    rows = blocks.select("vec_ids", "numbers", "large", "trees") \
        .mapInArrow(run, "p int, k int, j int, high string, low string") \
        .groupBy("p", "k", "j").agg(add_up("high"), add_up("low")).collect()
    got = {(r["p"], r["k"], r["j"]): int(r["high"]) * _BASE + int(r["low"]) for r in rows}
    new = [[[got[p, k, j] // got[p, k, -1] if (p, k, -1) in got else int(books[p, k, j]) for j in range(width)]
            for k in range(entries)] for p in range(parts)]
    return _as_integers(new).reshape(parts, entries, width)


def _as_integers(values) -> np.ndarray:
    out = np.array(values, dtype=object)
    return out.astype(np.int64) if all(abs(x) < _SAFE for x in out.ravel()) else out


def book_digest(books: np.ndarray) -> str:
    """SHA-256 of all components in order of part, entry and position."""
    return hashlib.sha256(",".join(str(int(x)) for x in books.ravel()).encode()).hexdigest()


def encode(blocks: DataFrame, books: np.ndarray) -> DataFrame:
    """(vec_id, label, code, error) of every vector of the blocks."""
    parts = len(books)
    id_type, label_type = (blocks.schema[c].dataType.elementType.simpleString() for c in ("vec_ids", "labels"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            types = [batch.schema.field(c).type.value_type for c in ("vec_ids", "labels")]
            for row in batch.to_pylist():
                points = _points(row, parts)
                found = [codes(Tree.from_bytes(row["trees"][p]), *_ready(points[:, p], books[p])) for p in range(parts)]
                names = ["".join(f"{k:02x}" for k in ks) for ks in zip(*(f[0].tolist() for f in found))]
                error = [min(int(x), _MOST) for x in sum(f[1].astype(object) for f in found)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["vec_ids"], types[0]), pa.array(row["labels"], types[1]), pa.array(names, pa.string()),
                     pa.array(error, pa.int64())], names=["vec_id", "label", "code", "error"])

    return blocks.mapInArrow(run, f"vec_id {id_type}, label {label_type}, code string, error long")


def fit(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """(blocks of the table's vectors, codebooks after ``rounds`` rounds)."""
    kept = finite_vectors(vectors)
    first = first_entries(kept, entries)
    blocks = build_blocks(kept, first.shape[1], parts)
    books = cut(first, parts).transpose(1, 0, 2) if len(first) else np.zeros((parts, 0, 0), dtype=np.int64)
    for _ in range(rounds if books.size else 0):
        books = lloyd_round(blocks, books)
    return blocks, books


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every kept row of ``vectors`` (vec_id, embedding, label)."""
    blocks, books = fit(vectors, parts, entries, rounds)
    coded = materialize(encode(blocks, books), "cover-codes")
    by_label = materialize(coded.groupBy("label").agg(F.least(
        F.sum(F.col("error").cast("decimal(38,0)")), F.lit(_MOST).cast("decimal(38,0)")).cast("long").alias("label_error")), "cover-labels") \
        .withColumnRenamed("label", "_label")
    if by_label.count() <= MAX_BROADCAST_LABELS:
        by_label = F.broadcast(by_label)
    return coded.join(by_label, F.col("label").eqNullSafe(F.col("_label"))) \
        .select("vec_id", "code", "error", "label_error", F.lit(book_digest(books)).alias("codebooks_sha256"))
