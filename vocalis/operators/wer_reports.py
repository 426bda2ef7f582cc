"""WER breakdown reports over an inference-results table.

``pct(x) = round(avg(x) * 100, 2)``; the improvement is a ratio of
averages, ``round((avg(b) - avg(f)) / avg(b) * 100, 2)``, NULL when the
baseline average is 0.  Each report is one partial+final hash aggregate;
``wer_all_dimensions`` answers all of them from a single scan with
GROUPING SETS.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BASE, FINE = "baseline_wer", "finetuned_wer"


def pct(c: Column | str) -> Column:
    return F.round(F.avg(c) * 100, 2)


def improvement_pct(base: Column, fine: Column) -> Column:
    """(b - f) / b * 100 rounded to 2 dp; NULL when b = 0."""
    return F.round(F.try_divide(base - fine, base) * 100, 2)


def _imp() -> Column:
    return improvement_pct(F.avg(BASE), F.avg(FINE)).alias("improvement_pct")


def wer_overall(results: DataFrame) -> DataFrame:
    """A1: one row with both percentages and the improvement."""
    return results.agg(
        pct(BASE).alias("baseline_WER_pct"),
        pct(FINE).alias("finetuned_WER_pct"),
        _imp(),
    )


def wer_by(results: DataFrame, keys: Sequence[str], improvement: bool = False,
           baseline: bool = True, order: Sequence[Column] | None = None,
           naming: str = "root") -> DataFrame:
    """Generic grouped report: samples, percentages, optional improvement.

    ``naming="root"`` gives ``baseline_WER_pct / finetuned_WER_pct``;
    ``naming="pipeline"`` gives ``baseline_pct / finetuned_pct``.
    """
    b_name, f_name = (("baseline_WER_pct", "finetuned_WER_pct") if naming == "root"
                      else ("baseline_pct", "finetuned_pct"))
    aggs = [F.count(F.lit(1)).alias("samples")]
    if baseline:
        aggs.append(pct(BASE).alias(b_name))
    aggs.append(pct(FINE).alias(f_name))
    if improvement:
        aggs.append(_imp())
    out = results.groupBy(*keys).agg(*aggs)
    return out.orderBy(*order) if order else out


def wer_by_severity(results: DataFrame, naming: str = "root") -> DataFrame:
    """A2: by severity, ordered by fine-tuned WER ascending."""
    f_name = "finetuned_WER_pct" if naming == "root" else "finetuned_pct"
    return wer_by(results, ["severity"], improvement=True, naming=naming,
                  order=[F.col(f_name).asc(), F.col("severity")])


def wer_by_noise(results: DataFrame) -> DataFrame:
    """A3: by noise condition, ascending fine-tuned WER."""
    return wer_by(results, ["noise_type"], order=[F.col("finetuned_WER_pct").asc(), F.col("noise_type")])


def wer_by_augmentation(results: DataFrame) -> DataFrame:
    """A4: by augmentation technique, improvement descending."""
    return wer_by(results, ["augmentation"], improvement=True,
                  order=[F.col("improvement_pct").desc(), F.col("augmentation")])


def wer_by_gender(results: DataFrame) -> DataFrame:
    """A5: by gender, ordered by gender."""
    return wer_by(results, ["gender"], order=[F.col("gender")])


def topk(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """O2: ORDER BY ... LIMIT k (planned as TakeOrderedAndProject)."""
    return df.orderBy(*order).limit(k)


def wer_by_speaker(results: DataFrame, k: int | None = 10) -> DataFrame:
    """Per (speaker, gender, severity) fine-tuned WER, best k.

    The sort key is rounded, so ties are broken by the group columns to
    keep the top-k deterministic.
    """
    out = results.groupBy("speaker", "gender", "severity").agg(
        F.count(F.lit(1)).alias("samples"), pct(FINE).alias("avg_WER_pct"))
    order = [F.col("avg_WER_pct").asc(), F.col("speaker"), F.col("gender"), F.col("severity")]
    return topk(out, order, k) if k else out.orderBy(*order)


def wer_summary(results: DataFrame) -> DataFrame:
    """Severity x noise x gender x augmentation cells, raw averages."""
    return results.groupBy("severity", "noise_type", "gender", "augmentation").agg(
        F.avg(BASE).alias("avg_baseline_wer"),
        F.avg(FINE).alias("avg_finetuned_wer"),
        F.count(F.lit(1)).alias("sample_count"),
    )


# Report name per grouping set; the order fixes grouping_id values.
DIMENSIONS = ("severity", "noise_type", "gender", "augmentation", "speaker")
REPORT_SETS: dict[str, tuple[str, ...]] = {
    "overall": (),
    "severity": ("severity",),
    "noise_type": ("noise_type",),
    "augmentation": ("augmentation",),
    "gender": ("gender",),
    "speaker": ("speaker", "gender", "severity"),
    "summary": ("severity", "noise_type", "gender", "augmentation"),
}


def grouping_id_of(keys: Sequence[str]) -> int:
    """grouping_id over DIMENSIONS: bit set = column aggregated away."""
    gid = 0
    for i, d in enumerate(DIMENSIONS):
        if d not in keys:
            gid |= 1 << (len(DIMENSIONS) - 1 - i)
    return gid


def wer_all_dimensions(results: DataFrame, sets: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """Every report of A1-A7 from one scan (GROUPING SETS).

    One ``Expand`` feeds one partial aggregate, so the input is read once
    and shuffled once, however many reports are asked for.  Output keeps
    sums and counts so callers can derive any further ratio without
    averaging rounded averages.
    """
    sets = sets or REPORT_SETS
    gid = F.grouping_id(*DIMENSIONS)
    report = F.lit(None).cast("string")
    for name, keys in reversed(list(sets.items())):
        report = F.when(gid == grouping_id_of(keys), F.lit(name)).otherwise(report)
    b, f = F.avg(BASE), F.avg(FINE)
    out = results.groupingSets([list(v) for v in sets.values()], *DIMENSIONS).agg(
        report.alias("report"),
        F.count(F.lit(1)).alias("samples"),
        F.sum(BASE).alias("sum_baseline_wer"),
        F.sum(FINE).alias("sum_finetuned_wer"),
        F.round(b * 100, 2).alias("baseline_WER_pct"),
        F.round(f * 100, 2).alias("finetuned_WER_pct"),
        improvement_pct(b, f).alias("improvement_pct"),
    )
    return out.select("report", *DIMENSIONS, "samples", "sum_baseline_wer", "sum_finetuned_wer",
                      "baseline_WER_pct", "finetuned_WER_pct", "improvement_pct")
