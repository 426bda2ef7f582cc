"""Benchmark decontamination: hash set of test windows, scan of training windows, verified hits.

Words are runs of characters other than ASCII non-alphanumerics, with A-Z
lower-cased.  A window is 13 consecutive words of a benchmark item, or the
whole item when it has fewer.  Every window of a document is hashed in place
and tested against a bitmap of the benchmark's window hashes, carried in the
plan; only the few that pass leave the row, as text, and meet the benchmark's
windows in an equi-join on the window itself, which is the verification.

The bitmap and the broadcast hold only while the benchmark has at most
``MAX_SET_WINDOWS`` distinct windows (counted first): about 2 MB of bitmap and,
at 13 words each, under 100 MB of windows.  A larger benchmark takes the same
join without bitmap and without broadcast, so both sides shuffle on the window.

Defined cases: null or wordless texts have no words and are never hit; null
item_id windows hit words but add no name; items with equal windows all count;
repeated documents are each reported; an empty benchmark hits nothing; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vocalis.llm.common import ascii_lower, let, materialize, text_or_empty

WINDOW = 13
#: Benchmarks up to this many distinct windows are broadcast.
MAX_SET_WINDOWS = 1 << 18
#: Bits of the bitmap per window, at least; a window passes by chance at most once in so many.
BITS_PER_WINDOW = 32
#: A document is contaminated when one of its words in this many is hit.
MAX_CLEAN_SHARE = 20
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: What lies between words: the same class, not negated.
GAP = WORD.replace("^", "", 1)


def words(text: Column) -> Column:
    """The runs of ``WORD``; cutting at the gaps costs a tenth of matching word by word."""
    return F.array_remove(F.split(text, GAP), "")


def _window_text(ws: Column, at: Column, size: Column) -> Column:
    return F.array_join(F.slice(ws, at, size), " ")


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct windows: win (words joined by a blank), size, hash, items (item_ids as strings)."""
    return (
        benchmark.select(F.col("item_id").cast("string").alias("item"),
                         words(ascii_lower(text_or_empty())).alias("ws"))
        .where(F.size("ws") > 0)
        .select("item", "ws", F.least(F.size("ws"), F.lit(window)).alias("size"))
        .select("item", "ws", "size", F.explode(F.sequence(F.lit(1), F.size("ws") - F.col("size") + 1)).alias("at"))
        .select("item", "size", F.slice("ws", F.col("at"), F.col("size")).alias("ws"))
        .select("item", "size", F.array_join("ws", " ").alias("win"), _hash("ws").alias("hash"))
        .groupBy("win", "size", "hash").agg(F.array_sort(F.collect_set("item")).alias("items")))


def _hash(ws: Column | str) -> Column:
    """Hash of the Unicode-lower-cased window: equal windows have equal hashes, the join compares the words."""
    return F.xxhash64(F.transform(ws, lambda w: F.lower(w)))


def _bitmap(hashes: list[int]) -> tuple[np.ndarray, int]:
    """Bits set at the top bits of the hashes, as longs, and how far to shift a hash."""
    bits = max(12, int(np.ceil(np.log2(max(1, len(hashes)) * BITS_PER_WINDOW))))
    at = np.array(hashes, dtype=np.int64).view(np.uint64) >> np.uint64(64 - bits)
    out = np.zeros(1 << (bits - 6), dtype=np.uint64)
    np.bitwise_or.at(out, (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
    return out.view(np.int64), 64 - bits


def _passing(ws: Column, size: int, bitmap: tuple[np.ndarray, int] | None) -> Column:
    """Positions (from 1) of the windows of ``size`` words in the lower-cased words ``ws`` that may be hits."""
    at = F.when(F.size(ws) >= size, F.sequence(F.lit(1), F.size(ws) - size + 1)) \
        .otherwise(F.array().cast("array<int>"))
    if bitmap is None:
        return at
    bits, shift = F.lit(bitmap[0]), bitmap[1]
    return F.filter(at, lambda i: let(
        F.shiftrightunsigned(F.xxhash64(F.slice(ws, i, F.lit(size))), shift),
        lambda h: F.getbit(F.get(bits, F.shiftright(h, 6).cast("int")), h.bitwiseAND(F.lit(63)).cast("int")) == 1))


def _sized(positions: Column, size: int) -> Column:
    return F.transform(positions, lambda i: F.struct(i.alias("at"), F.lit(size).alias("size")))


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per row of ``docs``: doc_id, text_hash, n_words, spans (word start from 0, words), items (names, sorted).

    ``spans`` are the verified window occurrences.  Rows are told apart by their place in the scan, so
    repeated rows stay apart.
    """
    wins = materialize(benchmark_windows(benchmark, window), "benchmark-windows")
    sizes = sorted(r["size"] for r in wins.select("size").distinct().collect())  # at most ``window`` rows
    small = wins.limit(MAX_SET_WINDOWS + 1).count() <= MAX_SET_WINDOWS
    maps: dict[int, tuple[np.ndarray, int] | None] = dict.fromkeys(sizes)
    if small:
        for s in sizes:
            maps[s] = _bitmap([r["hash"] for r in wins.where(F.col("size") == s).select("hash").distinct().collect()])
    text = text_or_empty()
    split = docs.select(
        F.monotonically_increasing_id().alias("_row"), "doc_id", F.xxhash64(text).alias("text_hash"),
        text.alias("_text"), words(F.lower(text)).alias("_lower"))
    at = F.concat(*[_sized(_passing(F.col("_lower"), s, maps[s]), s) for s in sizes]) \
        if sizes else F.array().cast("array<struct<at:int,size:int>>")
    found = split.select("_row", "doc_id", "text_hash", F.size("_lower").alias("n_words"), "_text", at.alias("_at"))
    hits = found.select(
        "_row", "doc_id", "text_hash", "n_words",
        F.when(F.size("_at") > 0, let(words(ascii_lower(F.col("_text"))), lambda ws: F.transform(
            F.col("_at"), lambda p: F.struct(
                (p["at"] - 1).alias("start"), p["size"].alias("size"),
                _window_text(ws, p["at"], p["size"]).alias("win"))))).alias("_hits")) \
        .select("_row", "doc_id", "text_hash", "n_words", F.explode_outer("_hits").alias("h")) \
        .select("_row", "doc_id", "text_hash", "n_words", F.col("h.start").alias("start"),
                F.col("h.size").alias("size"), F.col("h.win").alias("win"))
    names = wins.select("win", "items", F.lit(True).alias("_hit"))
    joined = hits.join(F.broadcast(names) if small else names, "win", "left")
    return joined.groupBy("_row", "doc_id", "text_hash", "n_words").agg(
        F.array_sort(F.collect_set(F.when(F.col("_hit"), F.struct("start", "size")))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items")).drop("_row")


def n_hit(spans: Column) -> Column:
    """Words covered by the union of sorted spans."""
    return F.aggregate(
        spans, F.struct(F.lit(0).alias("to"), F.lit(0).alias("n")),
        lambda acc, s: F.struct(
            F.greatest(acc["to"], s["start"] + s["size"]).alias("to"),
            (acc["n"] + F.greatest(F.lit(0), s["start"] + s["size"] - F.greatest(acc["to"], s["start"]))).alias("n")),
        lambda acc: acc["n"])


def contaminated(n_hit_words: Column, n_words: Column) -> Column:
    return (n_hit_words > 0) & (MAX_CLEAN_SHARE * n_hit_words >= n_words)


def judge(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, text_hash, n_words, n_hit, items, contaminated per row of ``docs``."""
    return scan(docs, benchmark, window).withColumn("n_hit", n_hit(F.col("spans"))) \
        .withColumn("contaminated", contaminated(F.col("n_hit"), F.col("n_words")))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` without contaminated documents; the match back is null-safe on (doc_id, text)."""
    bad = judge(docs, benchmark, window).where("contaminated") \
        .select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct()
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["_id"]) & (F.xxhash64(text_or_empty(docs["text"])) == bad["_hash"]),
                     "left_anti")
