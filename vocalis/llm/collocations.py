"""Phrase collocations from one FM-index per shard over word ids, summed across shards.

Texts are split into pieces and words.  Every task cuts its part of the table into
shards of one language and at most ``SHARD_WORDS`` words and builds, once, a
bidirectional FM-index per shard: the Burrows-Wheeler transforms of the shard's
word ids and of their reversal, both sorted to ``DEPTH`` words only, which is all
that phrases of that length need.  The shards are written to the shared folder.

In each shard a phrase is an interval in both transforms; the words found in the
interval are its extensions (to the left in the forward transform, to the right in
the reversed one) and each extension's interval follows by one LF step on the one
side and by counting smaller words on the other.  Counts are summed over all shards:
first those of words, then length by length those of phrases whose two parts one
word shorter are frequent, that is, found ``min_count`` times or more in the whole table.
Shards learn this from a bit table of bounded size in which every frequent phrase has its
bit, so a wrong bit costs a row and never a count.  Pairs, by far the most, travel as one
row per first word and shard, of words found everywhere as several rows.

A phrase's score is that of its weakest cut into two parts.  A phrase that lies
inside a longer one with nearly its count is dropped; a phrase one word longer
decides this, as any longer one has at most its count.

Defined cases: null or empty text has no words; a null ``lang`` is ``und``; very long
texts are spread over shards, and a piece of more than ``PIECE_WORDS`` words is cut into
parts that share ``DEPTH - 1`` words, whose own phrases are taken off once again; repeated
rows count each; ties of scores go to the shortest first part, ties in the order to the
smaller phrase; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vocalis.llm.common import materialize

#: Words of the longest phrase.
DEPTH = 4
MIN_COUNT = 30
#: A phrase goes if a longer one around it has at least this share (per cent) of its count.
INSIDE_PERCENT = 80
SCALE = 2_000_000
TOP = 2000
NO_LANGUAGE = "und"

#: Words of a shard, words a task holds in unfinished shards, words of a piece that are indexed together.
SHARD_WORDS = 1 << 20
HELD_WORDS = 1 << 21
PIECE_WORDS = 1 << 18
#: Bits of the table of frequent phrases: about 32 a phrase, within these bounds (as powers of two).
LEAST_BITS, MOST_BITS = 20, 27

#: Bytes that end a piece; all are turned into the first of them.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
_TABLE = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t" + PIECE_ENDS,
                         b"abcdefghijklmnopqrstuvwxyz " + b"." * len(PIECE_ENDS))
_ROWS = 1 << 16


# ------------------------------------------------------------------ the index of one shard
def context_order(ids: np.ndarray, step: int) -> np.ndarray:
    """Positions sorted by the ``DEPTH`` ids met in direction ``step``; beyond an end there are zeros."""
    rank, reach = ids.astype(np.int64), 1
    while True:
        other = np.zeros_like(rank)
        if reach < len(rank):
            if step > 0:
                other[:-reach] = rank[reach:]
            else:
                other[reach:] = rank[:-reach]
        key = rank * (int(rank.max()) + 1) + other
        order = np.argsort(key)
        reach *= 2
        if reach >= DEPTH:
            return order
        sorted_key = key[order]
        rank[order] = np.concatenate([[0], np.cumsum(sorted_key[1:] != sorted_key[:-1])])


def transforms(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The transform of ``ids`` (the id before each context) and of their reversal (the id after it).

    ``ids`` begin and end with 0, which also lies between pieces.
    """
    left = ids[context_order(ids, 1) - 1]
    right = ids[(context_order(ids, -1) + 1) % len(ids)]
    return left, right


class Phrases:
    """Phrases of one length in a shard: their words, and where their interval begins in either transform."""

    def __init__(self, words: np.ndarray, at_left: np.ndarray, at_right: np.ndarray, count: np.ndarray):
        self.words, self.at_left, self.at_right, self.count = words, at_left, at_right, count

    def where(self, keep: np.ndarray) -> Phrases:
        return Phrases(self.words[keep], self.at_left[keep], self.at_right[keep], self.count[keep])


class ShardIndex:
    """A bidirectional FM-index: extends phrases by a word on either side."""

    def __init__(self, left: np.ndarray, right: np.ndarray):
        self._symbols = {"left": left, "right": right}
        self._steps: dict[str, np.ndarray] = {}
        self._n = int(left.max(initial=0)) + 1
        counts = np.bincount(left, minlength=self._n)
        first = np.concatenate([[0], np.cumsum(counts)[:-1]])
        self.words = Phrases(np.arange(1, self._n, dtype=np.int32)[:, None], first[1:], first[1:], counts[1:])

    def _step(self, side: str) -> np.ndarray:
        """Where each entry of the transform lies among all contexts that begin with its id."""
        if side not in self._steps:
            symbols = self._symbols[side].astype(np.int64)
            order = np.argsort(symbols * len(symbols) + np.arange(len(symbols)))
            self._steps[side] = np.empty(len(order), dtype=np.int64)
            self._steps[side][order] = np.arange(len(order))
        return self._steps[side]

    def extend(self, phrases: Phrases, side: str) -> Phrases:
        """All phrases one word longer on ``side`` ("left" or "right")."""
        here, there = (phrases.at_left, phrases.at_right)[::1 if side == "left" else -1]
        total = np.cumsum(phrases.count)
        if not len(total):
            return Phrases(np.zeros((0, phrases.words.shape[1] + 1), np.int32), *(np.zeros(0, np.int64) for _ in range(3)))
        owner = np.repeat(np.arange(len(total)), phrases.count)
        entry = np.arange(total[-1]) + np.repeat(here - (total - phrases.count), phrases.count)
        key = owner * self._n + self._symbols[side][entry]
        order = np.argsort(key)
        key = key[order]
        begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        count = np.diff(np.append(begin, len(key)))
        first = np.minimum.reduceat(entry[order], begin)
        owner, word = np.divmod(key[begin], self._n)
        before = begin - (total - phrases.count)[owner]  # entries of the interval with a smaller id
        near, far = self._step(side)[first], there[owner] + before
        word = word.astype(np.int32)[:, None]
        longer = (word, phrases.words[owner]) if side == "left" else (phrases.words[owner], word)
        out = Phrases(np.hstack(longer), *((near, far) if side == "left" else (far, near)), count)
        return out.where(word[:, 0] > 0)


# ------------------------------------------------------------------ shards
class _Words(dict):
    """Word -> id in order of first sight, from 1; 0 ends a piece."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


class _Shard:
    """A shard that is being filled."""

    def __init__(self):
        self.ids = _Words({b".": 0})
        self.parts: list[np.ndarray] = [np.zeros(1, dtype=np.int32)]
        self.twice: list[np.ndarray] = []  # words indexed in two parts of a long piece
        self.size = 0

    def add(self, words: list[bytes]) -> None:
        ids = np.fromiter(map(self.ids.__getitem__, words), dtype=np.int32, count=len(words))
        self.parts.append(ids)
        self.size += len(ids)

    def row(self, lang: str) -> dict:
        left, right = transforms(np.concatenate([*self.parts, np.zeros(1, dtype=np.int32)]))
        twice = np.concatenate([*self.twice, np.zeros(0, dtype=np.int32)])
        words = list(self.ids)[1:]
        return {"lang": lang, "words": words, "left": pack_ids(left), "right": pack_ids(right),
                "twice": np.array([*map(self.ids.get, twice)], dtype="<i4").tobytes() if len(twice) else b""}


def pack_ids(ids: np.ndarray) -> bytes:
    """Ids as compressed byte planes."""
    import zstandard

    planes = ids.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpack_ids(data: bytes) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int32)


def parts_of(words: list[bytes], size: int, overlap: int = DEPTH - 1) -> Iterator[tuple[list[bytes], list[bytes]]]:
    """A text's words (b"." ends a piece) in parts of at most about ``size`` words, with the words a part shares with the one before."""
    at = 0
    while at < len(words):
        end = at + size
        if end >= len(words):
            yield words[at:], []
            return
        cut = next((k for k in range(end, max(end - size // 2, at), -1) if words[k - 1] == b"."), 0)
        if cut:
            yield words[at:cut], []
            at = cut
        else:
            shared = words[end - overlap:end]
            yield words[at:end], shared
            at = end - overlap


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("lang", pa.string()), ("words", pa.list_(pa.binary())), ("left", pa.binary()),
                        ("right", pa.binary()), ("twice", pa.binary())])
    open_shards: dict[str, _Shard] = {}

    def close(lang: str) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([open_shards.pop(lang).row(lang)], schema=schema)

    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
            words = text.as_py().translate(_TABLE).replace(b".", b" . ").split()
            for part, shared in parts_of(words, PIECE_WORDS):
                shard = open_shards.setdefault(lang, _Shard())
                shard.add(part)
                shard.add([b"."])
                if shared:
                    shard.twice.append(np.array(shared, dtype=object))
                if shard.size > SHARD_WORDS:
                    yield close(lang)
            if sum(s.size for s in open_shards.values()) > HELD_WORDS:
                yield close(max(open_shards, key=lambda k: open_shards[k].size))
    for lang in list(open_shards):
        yield close(lang)


def index_shards(docs: DataFrame) -> DataFrame:
    """Shards of ``docs`` (text, lang) with their transforms, written to the shared folder."""
    texts = docs.select(F.coalesce("lang", F.lit(NO_LANGUAGE)).alias("lang"),
                        F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"))
    return materialize(texts.mapInArrow(
        _shards, "lang string, words array<binary>, left binary, right binary, twice binary"), "collocation-shards")


# ------------------------------------------------------------------ phrases of a shard
def word_hashes(words: list[bytes]) -> np.ndarray:
    import xxhash

    return np.array([xxhash.xxh3_64_intdigest(w) for w in words], dtype=np.uint64)


def phrase_hashes(parts: list[np.ndarray]) -> np.ndarray:
    """One hash a phrase from its words' hashes; the order of the words counts."""
    h = np.zeros(len(parts[0]), dtype=np.uint64)
    for part in parts:
        h = (h ^ part) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h


class Frequent:
    """Bit table of the frequent phrases of one length; may say yes for others."""

    def __init__(self, bits: int, table: bytes):
        self.bits, self._table = bits, np.frombuffer(table, dtype=np.uint8)

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes >> np.uint64(64 - self.bits)
        return (self._table[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def live_phrases(index: ShardIndex, hashes: np.ndarray, length: int, frequent: dict[int, Frequent]) -> Phrases:
    """The shard's phrases of ``length`` words whose parts one word shorter are all frequent.

    ``hashes``: by word id, that of the piece end included.
    """
    def hold(words: np.ndarray) -> np.ndarray:
        return frequent[words.shape[1]].holds(phrase_hashes([hashes[words[:, k]] for k in range(words.shape[1])]))

    out = index.words
    for size in range(2, length + 1):
        out = out.where(hold(out.words))
        side = "right" if size % 2 == 0 else "left"
        out = index.extend(out, side)
        out = out.where(hold(out.words[:, 1:] if side == "right" else out.words[:, :-1]))
    return out


def taken_off(twice: np.ndarray, length: int, overlap: int = DEPTH - 1) -> np.ndarray:
    """Phrases of ``length`` words inside the words that two parts of a piece share, one row for each."""
    groups = twice.reshape(-1, overlap)
    return np.concatenate([groups[:, k:k + length] for k in range(overlap - length + 1)]
                          or [np.zeros((0, length), dtype=np.int32)])


#: Rows of a shard that share a first word of at least one in ``COMMON`` of all words are split in so many.
COMMON, SPLIT = 2000, 64


def _phrase_rows(length: int, frequent: dict[int, Frequent], common: frozenset):
    """Rows (lang, head, part, tail, a): the counts of phrases of ``length`` words.

    ``head`` is the phrase and ``tail`` is empty, but for pairs: there ``tail`` holds all second words.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                yield from shard_rows(batch.slice(at, 1).to_pylist()[0])
                pa.default_memory_pool().release_unused()

    def shard_rows(row: dict) -> Iterator[pa.RecordBatch]:
        words = row["words"]
        index = ShardIndex(unpack_ids(row["left"]), unpack_ids(row["right"]))
        hashes = np.concatenate([np.zeros(1, np.uint64), word_hashes(words) if frequent else np.zeros(len(words), np.uint64)])
        found = live_phrases(index, hashes, length, frequent)
        extra = taken_off(np.frombuffer(row["twice"], dtype="<i4"), length)
        names = pa.array(words, pa.binary()).cast(pa.string())
        ids = np.concatenate([found.words, extra])
        count = np.concatenate([found.count, np.full(len(extra), -1, dtype=np.int64)])
        part = np.zeros(len(ids), dtype=np.int32)
        if length == 2:
            often = np.array([False, *((row["lang"], w) in common for w in words)])
            split = often[ids[:, 0]]
            part[split] = (hashes[ids[split, 1]] % np.uint64(SPLIT)).astype(np.int32)
            order = np.lexsort((part, ids[:, 0]))
            ids, count, part = ids[order], count[order], part[order]
            begins = np.flatnonzero(np.concatenate([[True], (ids[1:, 0] != ids[:-1, 0]) | (part[1:] != part[:-1])])) if len(ids) else part
        else:
            begins = np.arange(len(ids))
        ends = np.append(begins[1:], len(ids))
        for k in range(0, len(begins), _ROWS):
            b, e = begins[k:k + _ROWS], ends[k:k + _ROWS]
            offsets = pa.array(np.append(b, e[-1]) - b[0], pa.int32())
            inside = slice(b[0], e[-1])
            if length == 2:
                head = names.take(pa.array(ids[b, 0] - 1))
                tail = pc.binary_join(pa.ListArray.from_arrays(offsets, names.take(pa.array(ids[inside, 1] - 1))), " ")
            else:
                columns = [names.take(pa.array(ids[b, j] - 1)) for j in range(length)]
                head = pc.binary_join_element_wise(*columns, " ") if length > 1 else columns[0]
                tail = pa.array([""] * len(b), pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["lang"]] * len(b), pa.string()), head, pa.array(part[b]), tail,
                 pa.ListArray.from_arrays(offsets, pa.array(count[inside], pa.int32()))], names=["lang", "head", "part", "tail", "a"])
    return run


def _summed(rows: DataFrame, length: int) -> DataFrame:
    """(lang, phrase, n_words, a) from the shards' rows, which meet by head and part; a shard has each phrase once, so
    counts are not added up before."""
    one = rows.repartition("lang", "head", "part")
    if length == 2:
        one = one.select("lang", "head", "part", F.explode(F.arrays_zip(F.split("tail", " ", -1).alias("tail"), "a")).alias("x")) \
            .select("lang", "head", "part", F.col("x.tail").alias("tail"), F.col("x.a").alias("a"))
    else:
        one = one.withColumn("a", F.col("a")[0])
    phrase = F.concat_ws(" ", "head", "tail") if length == 2 else F.col("head")
    return one.groupBy("lang", "head", "part", "tail").agg(F.sum(F.col("a").cast("long")).alias("a")) \
        .select("lang", phrase.alias("phrase"), F.lit(length).alias("n_words"), "a")


def _bits(phrases: DataFrame, n: int) -> Frequent:
    """The bit table of ``phrases``; its size is bounded whatever their number ``n``."""
    bits = min(max(LEAST_BITS, (32 * n).bit_length()), MOST_BITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [p.encode().split(b" ") for p in batch.column("phrase").to_pylist()]
            if words:
                at = phrase_hashes([word_hashes([w[k] for w in words]) for k in range(len(words[0]))]) >> np.uint64(64 - bits)
                yield pa.RecordBatch.from_arrays([pa.array((at >> np.uint64(6)).astype(np.int64)),
                                                  pa.array((at & np.uint64(63)).astype(np.int32))], names=["cell", "bit"])

    cells = phrases.select("phrase").mapInArrow(run, "cell long, bit int") \
        .groupBy("cell").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("word")).toArrow()
    table = np.zeros(1 << (bits - 6), dtype="<i8")
    table[cells["cell"].to_numpy()] = cells["word"].to_numpy()
    return Frequent(bits, table.tobytes())


def count_phrases(docs: DataFrame, depth: int = DEPTH, min_count: int = MIN_COUNT) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, n_words, a) of every phrase of up to ``depth`` words found ``min_count`` times or more; (lang, n).

    The texts are read once; later passes work on the shards.
    """
    if not 1 <= depth <= DEPTH:
        raise ValueError(f"phrases have 1 to {DEPTH} words")
    shards = index_shards(docs)
    out, words, frequent, common = [], None, {}, frozenset()
    for length in range(1, depth + 1):
        rows = shards.mapInArrow(_phrase_rows(length, dict(frequent), common),
                                 "lang string, head string, part int, tail string, a array<int>")
        counted = _summed(rows, length)
        if length == 1:
            counted = materialize(counted, "collocation-words")
            words = counted.groupBy("lang").agg(F.sum("a").alias("n"))
            total = counted.agg(F.coalesce(F.sum("a"), F.lit(0)).alias("n")).first()["n"]
            common = frozenset((r["lang"], r["phrase"].encode()) for r in counted.where(
                F.col("a") * COMMON >= F.greatest(F.lit(total), F.lit(1))).select("lang", "phrase").collect())
        counted = materialize(counted.where(F.col("a") >= min_count), f"collocation-{length}")
        if length < depth:
            frequent[length] = _bits(counted, counted.count())
        out.append(counted)
    return functools.reduce(DataFrame.unionByName, out), words


# ------------------------------------------------------------------ scores
def _joined(words: Column, start: int | Column, size: int | Column) -> Column:
    return F.array_join(F.slice(words, start, size), " ")


def _wide(col: Column | str) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast("decimal(20,0)")


def score_phrases(counts: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, score) of the phrases of two words or more that no longer one stands for."""
    words = F.split("phrase", " ", -1)
    longer = counts.where("n_words > 1")
    cuts = longer.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("n_words") - 1))).select(
        "lang", "phrase", "a", "k", _joined(words, 1, F.col("k")).alias("head"),
        _joined(words, F.col("k") + 1, F.col("n_words") - F.col("k")).alias("tail"))
    part = counts.select("lang", F.col("phrase").alias("head"), F.col("a").alias("l"))
    rest = counts.select("lang", F.col("phrase").alias("tail"), F.col("a").alias("r"))
    scored = cuts.join(part, ["lang", "head"]).join(rest, ["lang", "tail"]).withColumn(
        "score", F.expr(f"cast({SCALE}L as decimal(10,0)) * cast(a as decimal(20,0)) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))"))
    best = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    inside = longer.where("n_words > 2").select("lang", F.col("a").alias("outer"), F.explode(F.array(
        _joined(words, 1, F.col("n_words") - 1), _joined(words, 2, F.col("n_words") - 1))).alias("phrase")) \
        .groupBy("lang", "phrase").agg(F.max("outer").alias("outer"))
    return best.join(inside, ["lang", "phrase"], "left") \
        .where(F.col("outer").isNull() | (100 * _wide("outer") < INSIDE_PERCENT * _wide("a"))) \
        .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def collocations(docs: DataFrame, top: int = TOP, depth: int = DEPTH, min_count: int = MIN_COUNT) -> DataFrame:
    """Each language's first ``top`` phrases: lang, rank, phrase, a, l, r, n, score."""
    counts, words = count_phrases(docs, depth, min_count)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    best = score_phrases(counts).withColumn("_part", F.pmod(F.xxhash64("phrase"), F.lit(SPLIT)))
    for keys in (["lang", "_part"], ["lang"]):  # a language's first ones are among the first ones of its parts
        best = best.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= top)
    return best.join(words, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
