"""Document fingerprints: a Merkle tree over pieces, paragraphs and sections.

A paragraph is a line.  Its leaves are pieces of at most ``PIECE`` code points,
cut from the paragraph's start, so an edit moves no leaf of another paragraph
and none before it.  Eight paragraphs make a section.  A section's node hashes
its leaf hashes, the root hashes the section nodes: equal roots mean equal
texts, differing sections and leaves locate the edits.

The fingerprint is one string, ``root|node:leaves;node:leaves...``, a
section's paragraphs separated by ``/`` and leaves by a blank.

Defined cases: null text is empty (one empty paragraph, no leaves); the next
document of a row is the one with the largest smaller ``doc_id``, of the
smallest the one with the largest (itself when alone); of several rows with
that id the smallest text counts; rows without ``doc_id`` have an empty next
document; repeated rows are each reported; an empty table gives an empty
result; doc_id is an integer; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vocalis.llm.common import let, text_or_empty

PIECE = 32
SECTION = 8
LEAF_HEX = 8
NODE_HEX = 16


def _short(text: Column, n: int) -> Column:
    return F.left(F.sha2(text, 256), F.lit(n))


def fingerprint(text: Column) -> Column:
    """The tree of ``text`` as a string."""
    def paragraph(line: Column) -> Column:
        pieces = F.regexp_extract_all(line, F.lit("(?s).{1,%d}" % PIECE), F.lit(0))
        return F.array_join(F.transform(pieces, lambda p: _short(p, LEAF_HEX)), " ")

    def sections(ps: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(ps), F.lit(SECTION))
        return F.transform(starts, lambda i: F.array_join(F.slice(ps, i, F.lit(SECTION)), "/"))

    def tree(ss: Column) -> Column:
        nodes = F.transform(ss, lambda s: F.concat(_short(s, NODE_HEX), F.lit(":"), s))
        return F.concat(F.sha2(F.array_join(F.transform(ss, lambda s: F.sha2(s, 256)), ";"), 256), F.lit("|"),
                        F.array_join(nodes, ";"))

    return let(sections(F.transform(F.split(text, "\n", -1), paragraph)), tree)


def root(fp: Column) -> Column:
    return F.substring_index(fp, "|", 1)


def leaves(fp: Column) -> Column:
    """Distinct leaf hashes of a fingerprint."""
    return F.array_distinct(F.regexp_extract_all(F.substring_index(fp, "|", -1), F.lit(r"\b[0-9a-f]{%d}\b" % LEAF_HEX),
                                                 F.lit(0)))


def likeness(a: Column, b: Column) -> Column:
    """1 for equal roots, else twice the shared distinct leaves over all distinct leaves of both (0 if none)."""
    both = let(F.struct(leaves(a).alias("x"), leaves(b).alias("y")), lambda z: F.coalesce(
        F.try_divide(2.0 * F.size(F.array_intersect(z["x"], z["y"])), F.size(z["x"]) + F.size(z["y"])), F.lit(0.0)))
    return F.when(root(a) == root(b), F.lit(1.0)).otherwise(both)


def differing_sections(a: Column, b: Column) -> Column:
    """Numbers (from 0) of the sections whose nodes differ, with those only one side has."""
    def nodes(fp: Column) -> Column:
        return F.transform(F.split(F.substring_index(fp, "|", -1), ";", -1), lambda s: F.substring_index(s, ":", 1))

    return let(F.arrays_zip(nodes(a).alias("x"), nodes(b).alias("y")), lambda zs: F.filter(
        F.transform(zs, lambda z, i: F.when(z["x"].eqNullSafe(z["y"]), F.lit(-1)).otherwise(i)), lambda i: i >= 0))


def _bounds(docs: DataFrame, parts: int) -> list[int]:
    """Approximate quantiles of doc_id that cut the table into ``parts``: one number per part, read on the driver."""
    shares = [k / parts for k in range(1, parts)]
    return sorted(set(docs.agg(F.percentile_approx("doc_id", shares, 10_000)).first()[0] or [])) if shares else []


def _part(doc_id: Column, bounds: list[int]) -> Column:
    """How many bounds are not above ``doc_id``, by runs of about the square root of their number."""
    if not bounds:
        return F.lit(0)
    width = math.isqrt(len(bounds)) + 1
    runs = [bounds[k:k + width] for k in range(0, len(bounds), width)]

    def upto(values: Column) -> Column:
        return F.size(F.filter(values, lambda b: b <= doc_id))

    run = upto(F.lit(np.array([r[0] for r in runs])))
    return F.when(run == 0, 0).otherwise(
        (run - 1) * width + upto(F.get(F.array(*[F.lit(np.array(r)) for r in runs]), run - 1)))


def next_documents(docs: DataFrame) -> DataFrame:
    """doc_id, text, next (doc_id, text) for every row: the document with the largest smaller doc_id.

    Rows are cut into parts at quantiles of doc_id, and a text moves once, to its part.  Inside a part the next
    document comes from a window; the first one of a part finds it in a table of one row per part, the last
    document of each.
    """
    n = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    known = F.col("doc_id").isNotNull()
    part = F.when(known, _part(F.col("doc_id"), _bounds(docs.select("doc_id"), n))) \
        .otherwise(-1 - F.pmod(F.xxhash64("text"), F.lit(n)).cast("int"))
    rows = docs.select("doc_id", text_or_empty().alias("text")).select("doc_id", "text", part.alias("part"))

    tops = rows.where(known).groupBy("part").agg(F.max("doc_id").alias("top"))
    order = Window.orderBy("part")  # one row per part
    below = tops.select("part", F.coalesce(
        F.lag("top").over(order),
        F.max("top").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("below"))
    edges = rows.select(F.col("doc_id").alias("below"), "text") \
        .join(F.broadcast(below), "below").groupBy("part", "below").agg(F.min("text").alias("text")) \
        .select(F.col("part").alias("_part"), F.struct(F.col("below").alias("doc_id"), "text").alias("edge"))

    inside = Window.partitionBy("part").orderBy("doc_id", "text")
    marked = rows.withColumn("_first", F.coalesce(F.lag("doc_id").over(inside) != F.col("doc_id"), F.lit(True)))
    before = F.last(F.when(F.col("_first"), F.struct("doc_id", "text")), ignorenulls=True)
    marked = marked.withColumn("_before", before.over(inside.rowsBetween(Window.unboundedPreceding, -1)))
    same = Window.partitionBy("part", "doc_id").orderBy("text").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    marked = marked.withColumn("_next", F.first("_before").over(same))  # repeated rows share the first one's
    return marked.join(edges, F.col("part") == F.col("_part"), "left").select(
        "doc_id", "text", F.when(known, F.coalesce("_next", "edge")).alias("next"))


def edited_text(text: Column, next_text: Column) -> Column:
    """The last third (rounded down) of the code points replaced by the first as many of the next document."""
    cut = F.floor(F.char_length(text) / 3).cast("int")
    return F.concat(F.left(text, F.char_length(text) - cut), F.left(next_text, cut))


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited, fingerprint, edited_fingerprint, near_edited, near_next for every row."""
    next_text = F.coalesce("next.text", F.lit(""))
    pairs = next_documents(docs).select(
        "doc_id", F.char_length("text").cast("long").alias("n_chars"), fingerprint(F.col("text")).alias("fingerprint"),
        edited_text(F.col("text"), next_text).alias("edited"), fingerprint(next_text).alias("next_fingerprint"))
    prints = pairs.select("doc_id", "n_chars", "edited", "fingerprint",
                          fingerprint(F.col("edited")).alias("edited_fingerprint"), "next_fingerprint")
    return prints.select("doc_id", "n_chars", "edited", "fingerprint", "edited_fingerprint",
                         likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
                         likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"))
