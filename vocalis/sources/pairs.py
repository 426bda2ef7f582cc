"""Transcript pair files (S9): ``[("model output", "correct"), ...]``."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vocalis.functions.text import unescape_quotes
from vocalis.session import scratch_path

# One tuple of two double-quoted strings in which a quote may be escaped as
# \".  Each string is "any non-quote character or an escaped quote",
# written as runs of plain characters between backslashes: Java's regex
# engine recurses once per loop iteration, so a per-character alternation
# overflows the stack on long lines while this form recurses per backslash.
_STR = r'([^"\\]*(?:\\"?[^"\\]*)*)'
PAIR_PATTERN = r'\(\s*"' + _STR + r'"\s*,\s*"' + _STR + r'"\s*\)'


def parse_pairs(text_df: DataFrame, col: str = "value") -> DataFrame:
    """Every ``("a", "b")`` tuple in the text column -> one row, quotes
    unescaped.  Text that holds no tuple yields no row."""
    a = F.regexp_extract_all(F.col(col), F.lit(PAIR_PATTERN), 1)
    b = F.regexp_extract_all(F.col(col), F.lit(PAIR_PATTERN), 2)
    z = text_df.select(F.explode(F.arrays_zip(a.alias("a"), b.alias("b"))).alias("p"))
    return z.select(unescape_quotes("p.a").alias("model_output"),
                    unescape_quotes("p.b").alias("correct_transcription"))


# ------------------------------------------------------------------ files of any size
#: Characters of a chunk, about.
CHUNK_CHARS = 1 << 20

_TO_QUOTE = re.compile(r'[^"\\]*(?:\\.[^"\\]*)*"', re.DOTALL)
_STRING = r'"([^"\\]*(?:\\.[^"\\]*)*)"'
_PAIR = re.compile(rf"\(\s*{_STRING}\s*,\s*{_STRING}\s*\)", re.DOTALL)


def scan(text: str, inside: bool) -> tuple[bool, int, int]:
    """Whether ``text`` ends inside a string, given whether it begins in one, and the places just after the first and
    the last closing bracket outside strings (-1 if there is none)."""
    at, first, last = 0, -1, -1
    while at < len(text):
        if inside:
            m = _TO_QUOTE.match(text, at)
            if m is None:
                return True, first, last
            at, inside = m.end(), False
        else:
            quote = text.find('"', at)
            end = len(text) if quote < 0 else quote
            close = text.rfind(")", at, end)
            if close >= 0:
                first = text.find(")", at, end) + 1 if first < 0 else first
                last = close + 1
            if quote < 0:
                return False, first, last
            at, inside = quote + 1, True
    return inside, first, last


def _pairs_in(text: str) -> list[tuple[str, str]]:
    return [tuple(s.replace('\\"', '"') for s in m.groups()) for m in _PAIR.finditer(text)]


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fragments of one file split, in order, as chunks with what each does to either state of its beginning."""
    held: list[str] = []
    where, size, bytes_, seq = None, 0, 0, 0

    def chunk() -> pa.RecordBatch:
        text = ")".join(held) + ")"
        (to_outside, close_outside, _), (to_inside, close_inside, _) = scan(text, False), scan(text, True)
        return pa.RecordBatch.from_pylist([{
            "file": where[0], "block": where[1], "file_size": where[2], "seq": seq, "text": text, "bytes": bytes_,
            "out_inside": to_outside, "out_close": close_outside >= 0, "in_inside": to_inside, "in_close": close_inside >= 0}])

    for batch in batches:
        places = zip(*(batch.column(c).to_pylist() for c in ("file", "block", "file_size")))
        for fragment, place in zip(batch.column("value").to_pylist(), places):
            if held and (place != where or size > CHUNK_CHARS):
                yield chunk()
                held, size, bytes_, seq = [], 0, 0, seq + 1
            where = place
            held.append(fragment)
            size += len(fragment) + 1
            bytes_ += len(fragment.encode()) + 1
    if held:
        yield chunk()


_CHUNK = ("file string, block long, file_size long, seq long, text string, bytes long, "
          "out_inside boolean, out_close boolean, in_inside boolean, in_close boolean")


def _join_states(chunks: pd.DataFrame) -> pd.DataFrame:
    """The small pass over one file's chunks: the state each begins in, and the number of the tuple that reaches over
    its beginning and over its end."""
    chunks = chunks.sort_values(["block", "seq"])
    inside, tuple_no, out = False, 0, []
    for row in chunks.itertuples():
        closes = row.in_close if inside else row.out_close
        out.append((row.file, row.block, row.seq, inside, tuple_no, tuple_no + closes))
        inside, tuple_no = row.in_inside if inside else row.out_inside, tuple_no + closes
    made = pd.DataFrame(out, columns=["_file", "_block", "_seq", "inside", "head", "tail"])
    # every fragment is counted with its bracket; one too many means that the file does not end with a bracket
    made["unclosed"] = False
    made.loc[made.index[-1], "unclosed"] = chunks["bytes"].sum() > chunks["file_size"].iloc[0]
    return made


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            text = row["text"][:-1] if row["unclosed"] else row["text"]
            _, first, last = scan(text, row["inside"])
            out = [{"a": a, "b": b} for a, b in (_pairs_in(text[first:last]) if first >= 0 else ())]
            pieces = [(row["head"], text)] if first < 0 else [(row["head"], text[:first]), (row["tail"], text[last:])]
            out += [{"piece": p, "tuple_no": n} for n, p in pieces if p]
            for r in out:
                r |= {"file": row["file"], "block": row["block"], "seq": row["seq"]}
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([
                ("a", pa.string()), ("b", pa.string()), ("piece", pa.string()), ("tuple_no", pa.int64()), ("file", pa.string()),
                ("block", pa.int64()), ("seq", pa.int64())]))


def _parse_borders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [p for text in batch.column("text").to_pylist() for p in _pairs_in(text)]
        a, b = zip(*found) if found else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.string()), pa.array(b, pa.string())], names=["a", "b"])


def read_pair_files(spark: SparkSession, path: str) -> DataFrame:
    """(model_output, correct_transcription) of every tuple in the pair files under ``path``.

    A tuple may span lines and a file may be one huge line: files are read in splits whose records end at a closing
    bracket.  A bracket or quote means something only if it stands outside or inside a string, which a split cannot know, so
    each chunk of a split tells what it does in both cases; one small pass over a file's chunks finds the case that holds.
    Chunks are then parsed in parallel, and the tuples that reach over their borders are put together from the few
    characters on either side.  Backslashes escape as in source code; ``\\"`` becomes ``"``.
    """
    fragments = spark.read.option("lineSep", ")").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_size").alias("file_size"))
    folder = scratch_path(spark, "pair-chunks")
    fragments.mapInArrow(_chunks, _CHUNK).write.mode("overwrite").parquet(folder)
    chunks = spark.read.schema(_CHUNK).parquet(folder)
    states = chunks.drop("text").groupBy("file").applyInPandas(
        _join_states, "_file string, _block long, _seq long, inside boolean, head long, tail long, unclosed boolean")
    known = chunks.select("file", "block", "seq", "text").join(states, (F.col("file") == F.col("_file")) & (
        F.col("block") == F.col("_block")) & (F.col("seq") == F.col("_seq"))).drop("_file", "_block", "_seq")
    done = scratch_path(spark, "pair-rows")
    schema = "a string, b string, piece string, tuple_no long, file string, block long, seq long"
    known.mapInArrow(_parse, schema).write.mode("overwrite").parquet(done)
    rows = spark.read.schema(schema).parquet(done)
    borders = rows.where("piece IS NOT NULL").groupBy("file", "tuple_no").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("block", "seq", "piece"))), lambda s: s["piece"]), "").alias("text")) \
        .select("text").mapInArrow(_parse_borders, "a string, b string")
    return rows.where("piece IS NULL").select("a", "b").unionByName(borders) \
        .select(F.col("a").alias("model_output"), F.col("b").alias("correct_transcription"))


def pairs_to_text(pairs: DataFrame) -> DataFrame:
    """Render pairs in the file format, one tuple per line."""
    def q(c):
        return F.replace(F.col(c), F.lit('"'), F.lit('\\"'))
    return pairs.select(F.concat(F.lit('("'), q("model_output"), F.lit('", "'), q("correct_transcription"),
                                 F.lit('"),')).alias("value"))
