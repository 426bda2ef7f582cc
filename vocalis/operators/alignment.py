"""Token alignment (F3), whole-document error counts (F1) and mined phrase pairs (G1) as Arrow-batched jobs.

Distances and paths come from furthest-reaching diagonals (``diagonals.py``); the path is the same at every
size: match or substitution first, then deletion, then insertion.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vocalis.functions.text import tokenize
from vocalis.operators.diagonals import align, distance
from vocalis.operators.relational import spread

__all__ = ["align", "align_tokens", "distance", "document_alignment", "document_errors", "edit_ops", "phrase_pairs"]

#: Alignment steps written in one batch.
_ROWS = 1 << 15


def _tokens(batch: pa.RecordBatch, name: str) -> Iterator[list[str]]:
    """The token lists of a batch one by one: as Python strings they take several times the batch."""
    return (x.as_py() or [] for x in batch.column(name))


def _words(batch: pa.RecordBatch, name: str) -> Iterator[list[str]]:
    """The tokens of a batch's texts, joined by blanks, one text after the other: a list of strings takes many times as long to
    come over."""
    return (text.split(" ") if (text := x.as_py()) else [] for x in batch.column(name))


def _joined(tokens: str) -> Column:
    """A token array as text; tokens hold no white space and are not empty."""
    return F.array_join(tokens, " ").alias(tokens)


def align_tokens(df: DataFrame, carry: list[str], partitions: int | None = None) -> DataFrame:
    """Alignment steps for a frame holding ``carry`` columns plus token
    arrays ``_r`` (reference) and ``_h`` (hypothesis)."""
    def steps(batch: pa.RecordBatch, owner: list, op: list, at_r: list, at_h: list, tok_r: list, tok_h: list):
        columns = [batch.column(c).take(pa.array(owner, pa.int32())) for c in carry]
        arrays = [pa.array(op, pa.string()), pa.array(at_r, pa.int32()), pa.array(at_h, pa.int32()),
                  pa.array(tok_r, pa.string()), pa.array(tok_h, pa.string())]
        return pa.RecordBatch.from_arrays(columns + arrays, names=[*carry, "op", "ref_pos", "hyp_pos", "ref_tok", "hyp_tok"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(6)]
            for k, (r, h) in enumerate(zip(_tokens(batch, "_r"), _tokens(batch, "_h"))):
                for op, i, j in align(r, h):
                    for column, value in zip(out, (k, op, i, j, None if i is None else r[i], None if j is None else h[j])):
                        column.append(value)
                if len(out[0]) >= _ROWS:
                    yield steps(batch, *out)
                    out = [[] for _ in range(6)]
            yield steps(batch, *out)

    fields = [df.schema[c].simpleString() for c in carry]
    schema = ", ".join(fields + ["op string", "ref_pos int", "hyp_pos int", "ref_tok string", "hyp_tok string"])
    return spread(df.select(*carry, "_r", "_h"), partitions).mapInArrow(run, schema)


def edit_ops(df: DataFrame, key: str, ref: str, hyp: str, partitions: int | None = None) -> DataFrame:
    """one row per alignment step (hit / sub / del / ins) of every pair."""
    toks = df.select(F.col(key).cast("long").alias("pair_id"), tokenize(ref).alias("_r"), tokenize(hyp).alias("_h"))
    return align_tokens(toks, ["pair_id"], partitions)


def document_errors(pairs: DataFrame, key: str = "pair_id", ref: str = "correct_transcription", hyp: str = "model_output",
                    partitions: int | None = None) -> DataFrame:
    """F1 for whole documents: (key, ref_words, errors, wer).

    The built-in distance of ``pair_wer`` fills a matrix, which suits utterances; here a pair costs its length plus the
    square of its errors, or a few operations on long bit rows per word.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            errors = [distance(r, h) for r, h in zip(_words(batch, "_r"), _words(batch, "_h"))]
            yield pa.RecordBatch.from_arrays([batch.column(key), batch.column("ref_words"), pa.array(errors, pa.int32())],
                                             names=[key, "ref_words", "errors"])

    toks = spread(pairs, partitions).select(key, tokenize(ref).alias("_r"), tokenize(hyp).alias("_h")) \
        .withColumn("ref_words", F.size("_r"))
    n = F.col("ref_words")
    return toks.select(key, "ref_words", _joined("_r"), _joined("_h")) \
        .mapInArrow(run, f"{toks.schema[key].simpleString()}, ref_words int, errors int") \
        .withColumn("wer", F.when(n == 0, F.lit(0.0)).otherwise(F.round(F.col("errors") / n, 4)))


def document_alignment(pairs: DataFrame, key: str = "pair_id", ref: str = "correct_transcription", hyp: str = "model_output",
                       partitions: int | None = None) -> DataFrame:
    """F3 for whole documents, one row each: (key, hits, subs, dels, ins, rebuilt).

    ``rebuilt`` is the hypothesis as the path makes it from the reference: words of hits come from the reference, those
    of substitutions and insertions from the hypothesis.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, rebuilt = [], []
            for r, h in zip(_words(batch, "_r"), _words(batch, "_h")):
                ops = align(r, h)
                n = Counter(op for op, _, _ in ops)
                counts.append([n[op] for op in ("hit", "sub", "del", "ins")])
                rebuilt.append(" ".join(r[i] if op == "hit" else h[j] for op, i, j in ops if op != "del"))
            columns = zip(*counts) if counts else ((),) * 4
            yield pa.RecordBatch.from_arrays([batch.column(key), *(pa.array(c, pa.int64()) for c in columns), pa.array(rebuilt, pa.string())],
                                             names=[key, "hits", "subs", "dels", "ins", "rebuilt"])

    toks = spread(pairs, partitions).select(key, tokenize(ref).alias("_r"), tokenize(hyp).alias("_h"))
    return toks.select(key, _joined("_r"), _joined("_h")).mapInArrow(run, f"{toks.schema[key].simpleString()}, hits long, subs long, dels long, ins long, rebuilt string")


# ------------------------------------------------------------------ G1: phrase pairs
#: Words on either side of a mined phrase pair, and words around it in its hint.
PHRASE_WORDS = 4
HINT_WORDS = 3
#: A run of changed words longer than this (both sides together) is cut word by word.
RUN_WORDS = 64


def changed_runs(ops: list, n_ref: int, n_hyp: int) -> Iterator[tuple[int, int, int, int]]:
    """(ref begin, ref end, hyp begin, hyp end) of every run of steps without a hit."""
    i = j = 0
    for op, at_r, at_h in [*ops, ("hit", n_ref, n_hyp)]:
        if op == "hit":
            if i < at_r or j < at_h:
                yield i, at_r, j, at_h
            i, j = at_r + 1, at_h + 1


def cut_run(ref: list[str], hyp: list[str]) -> list[tuple[int, int, int, int]]:
    """Phrase pairs (ref begin, ref end, hyp begin, hyp end) of a run of changed words, left to right.

    The cheapest cut of both sides into pieces of up to ``PHRASE_WORDS`` words each: a pair of pieces costs twice the
    letters that differ when both are written without blanks, plus one for every word beyond one on each side; words
    without a counterpart cost twice their letters and two each, and are no pair.  Among equals the last piece has the
    fewest reference words, then the fewest hypothesis words.
    """
    n, m = len(ref), len(hyp)
    if n + m > RUN_WORDS:
        return [(k, k + 1, k, k + 1) for k in range(min(n, m))]
    best: dict[tuple[int, int], tuple[int, int, int]] = {(0, 0): (0, 0, 0)}
    for i in range(n + 1):
        for j in range(m + 1):
            if not i and not j:
                continue
            found = None
            for x in range(min(i, PHRASE_WORDS) + 1):
                for y in range(min(j, PHRASE_WORDS) + 1):
                    if x and y:
                        cost = 2 * distance("".join(ref[i - x:i]), "".join(hyp[j - y:j])) + x + y - 2
                    elif x + y == 1:
                        cost = 2 * len((ref[i - 1] if x else hyp[j - 1])) + 2
                    else:
                        continue
                    option = (best[i - x, j - y][0] + cost, x, y)
                    if found is None or option < found:
                        found = option
            best[i, j] = found
    i, j, out = n, m, []
    while i or j:
        _, x, y = best[i, j]
        if x and y:
            out.append((i - x, i, j - y, j))
        i, j = i - x, j - y
    return out[::-1]


def corrections_of(ref: list[str], hyp: list[str]) -> Iterator[tuple[str, str, str]]:
    """(wrong phrase, right phrase, hint) of every changed phrase of a pair of token lists."""
    for i0, i1, j0, j1 in changed_runs(align(ref, hyp), len(ref), len(hyp)):
        for a, b, c, d in cut_run(ref[i0:i1], hyp[j0:j1]):
            wrong, right = " ".join(hyp[j0 + c:j0 + d]), " ".join(ref[i0 + a:i0 + b])
            if wrong != right:
                before = " ".join(hyp[max(0, j0 + c - HINT_WORDS):j0 + c])
                after = " ".join(hyp[j0 + d:j0 + d + HINT_WORDS])
                yield wrong, right, f"...{before} [{wrong} → {right}] {after}..."


def phrase_pairs(df: DataFrame, key: str, partitions: int | None = None) -> DataFrame:
    """(key, stt_output, intended, n, hint) of a frame with token arrays ``_r`` and ``_h``, counted within each batch;
    ``hint`` is the smallest of the batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            count: Counter = Counter()
            hints: dict = {}
            for who, r, h in zip(batch.column(key).to_pylist(), _tokens(batch, "_r"), _tokens(batch, "_h")):
                for wrong, right, hint in corrections_of(r, h):
                    k = (who, wrong, right)
                    count[k] += 1
                    hints[k] = min(hints.get(k, hint), hint)
            who, wrong, right = zip(*count) if count else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(who, batch.schema.field(key).type), pa.array(wrong, pa.string()), pa.array(right, pa.string()),
                 pa.array(count.values(), pa.int64()), pa.array([hints[k] for k in count], pa.string())],
                names=[key, "stt_output", "intended", "n", "hint"])

    return spread(df.select(key, "_r", "_h"), partitions).mapInArrow(
        run, f"{df.schema[key].simpleString()}, stt_output string, intended string, n long, hint string")
