"""Per-utterance WER over text pairs and reports on top of it.

``pair_wer`` stays in the JVM: tokens, the per-pair code mapping and the
Levenshtein DP are built-in expressions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vocalis.functions.text import cer, token_edit_distance, tokenize
from vocalis.operators.relational import spread


def pair_wer(pairs: DataFrame, ref: str = "correct_transcription", hyp: str = "model_output",
             partitions: int | None = None) -> DataFrame:
    """Adds ``ref_words``, ``errors`` (token edit distance) and ``wer``.

    ``partitions`` spreads a table of few splits over that many tasks.
    """
    # the pair's distinct tokens are bound once per row inside the
    # expression (a lambda variable keeps them as an object array; reading
    # them back from a row column would allocate on every element access)
    df = spread(pairs, partitions).withColumn("_r", tokenize(ref)).withColumn("_h", tokenize(hyp)) \
        .withColumn("errors", token_edit_distance(F.col("_r"), F.col("_h")))
    n = F.size("_r")
    return (df.withColumn("ref_words", n)
              .withColumn("wer", F.when(n == 0, F.lit(0.0)).otherwise(F.round(F.col("errors") / n, 4)))
              .drop("_r", "_h"))


def wer_by_user(scored: DataFrame, key: str = "username") -> DataFrame:
    """Mean utterance WER and corpus WER (sum of errors / sum of reference
    words) per user: one partial + final aggregate."""
    return scored.groupBy(key).agg(
        F.count(F.lit(1)).alias("samples"),
        F.round(F.avg("wer") * 100, 2).alias("avg_WER_pct"),
        F.sum("errors").alias("errors"),
        F.sum("ref_words").alias("ref_words"),
        F.round(F.try_divide(F.sum("errors"), F.sum("ref_words")) * 100, 2).alias("corpus_WER_pct"),
    )


def pair_cer(pairs: DataFrame, ref: str = "correct_transcription", hyp: str = "model_output",
             partitions: int | None = None) -> DataFrame:
    """Adds ``cer`` (F2) per pair."""
    return spread(pairs, partitions).withColumn("cer", cer(ref, hyp))
