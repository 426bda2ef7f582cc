"""Query catalogue: one Spark callable and (where an exact twin exists) one
DuckDB SQL string per operator key of the survey.

Every callable takes ``(spark, sf_dir)``, builds its fixture from the whole
driver tables and returns a DataFrame whose column names equal the SQL
twin's.  Keys without an SQL twin are property-tested in ``tests/``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vocalis.operators import wer_reports as R
from vocalis.plans import fixtures as X

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return deco


def with_cte(sql: str, **ctes: str) -> str:
    if not ctes:
        return sql
    body = ",\n".join(f"{name} AS (\n{text}\n)" for name, text in ctes.items())
    return f"WITH {body}\n{sql}"


_PCT = "round(avg({c}) * 100, 2)"
_IMP = ("round((avg(baseline_wer) - avg(finetuned_wer)) / nullif(avg(baseline_wer), 0) * 100, 2)")


def _res(sql: str) -> str:
    return with_cte(sql, results=X.RESULTS_SQL)


# ------------------------------------------------------------ WER reports
@register("wer_overall", _res(
    f"SELECT {_PCT.format(c='baseline_wer')} AS baseline_WER_pct, {_PCT.format(c='finetuned_wer')} AS finetuned_WER_pct, "
    f"{_IMP} AS improvement_pct FROM results"))
def q_wer_overall(spark, sf_dir):
    return R.wer_overall(X.results(spark, sf_dir))


@register("wer_by_severity", _res(
    f"SELECT severity, count(*) AS samples, {_PCT.format(c='baseline_wer')} AS baseline_WER_pct, "
    f"{_PCT.format(c='finetuned_wer')} AS finetuned_WER_pct, {_IMP} AS improvement_pct "
    "FROM results GROUP BY severity ORDER BY finetuned_WER_pct, severity"))
def q_wer_by_severity(spark, sf_dir):
    return R.wer_by_severity(X.results(spark, sf_dir))


@register("wer_by_noise", _res(
    f"SELECT noise_type, count(*) AS samples, {_PCT.format(c='baseline_wer')} AS baseline_WER_pct, "
    f"{_PCT.format(c='finetuned_wer')} AS finetuned_WER_pct FROM results GROUP BY noise_type "
    "ORDER BY finetuned_WER_pct, noise_type"))
def q_wer_by_noise(spark, sf_dir):
    return R.wer_by_noise(X.results(spark, sf_dir))


@register("wer_by_augmentation", _res(
    f"SELECT augmentation, count(*) AS samples, {_PCT.format(c='baseline_wer')} AS baseline_WER_pct, "
    f"{_PCT.format(c='finetuned_wer')} AS finetuned_WER_pct, {_IMP} AS improvement_pct "
    "FROM results GROUP BY augmentation ORDER BY improvement_pct DESC, augmentation"))
def q_wer_by_augmentation(spark, sf_dir):
    return R.wer_by_augmentation(X.results(spark, sf_dir))


@register("wer_by_gender", _res(
    f"SELECT gender, count(*) AS samples, {_PCT.format(c='baseline_wer')} AS baseline_WER_pct, "
    f"{_PCT.format(c='finetuned_wer')} AS finetuned_WER_pct FROM results GROUP BY gender ORDER BY gender"))
def q_wer_by_gender(spark, sf_dir):
    return R.wer_by_gender(X.results(spark, sf_dir))


@register("wer_by_speaker_top10", _res(
    f"SELECT speaker, gender, severity, count(*) AS samples, {_PCT.format(c='finetuned_wer')} AS avg_WER_pct "
    "FROM results GROUP BY speaker, gender, severity ORDER BY avg_WER_pct, speaker, gender, severity LIMIT 10"))
def q_wer_by_speaker_top10(spark, sf_dir):
    return R.wer_by_speaker(X.results(spark, sf_dir), k=10)


@register("topk", _res(
    f"SELECT speaker, gender, severity, count(*) AS samples, {_PCT.format(c='finetuned_wer')} AS avg_WER_pct "
    "FROM results GROUP BY speaker, gender, severity ORDER BY avg_WER_pct DESC, speaker, gender, severity LIMIT 5"))
def q_topk(spark, sf_dir):
    per = R.wer_by_speaker(X.results(spark, sf_dir), k=None)
    return R.topk(per, [F.col("avg_WER_pct").desc(), "speaker", "gender", "severity"], 5)


@register("wer_summary", _res(
    "SELECT severity, noise_type, gender, augmentation, round(avg(baseline_wer), 12) AS avg_baseline_wer, "
    "round(avg(finetuned_wer), 12) AS avg_finetuned_wer, count(*) AS sample_count "
    "FROM results GROUP BY severity, noise_type, gender, augmentation"))
def q_wer_summary(spark, sf_dir):
    out = R.wer_summary(X.results(spark, sf_dir))
    return out.select("severity", "noise_type", "gender", "augmentation",
                      F.round("avg_baseline_wer", 12).alias("avg_baseline_wer"),
                      F.round("avg_finetuned_wer", 12).alias("avg_finetuned_wer"), "sample_count")


def _a8_sql() -> str:
    dims = ", ".join(R.DIMENSIONS)
    case = " ".join(f"WHEN {R.grouping_id_of(v)} THEN '{k}'" for k, v in R.REPORT_SETS.items())
    gsets = ", ".join("(" + ", ".join(v) + ")" for v in R.REPORT_SETS.values())
    return _res(
        f"SELECT CASE grouping_id({dims}) {case} END AS report, {dims}, count(*) AS samples, "
        f"{_PCT.format(c='baseline_wer')} AS baseline_WER_pct, {_PCT.format(c='finetuned_wer')} AS finetuned_WER_pct, "
        f"{_IMP} AS improvement_pct FROM results GROUP BY GROUPING SETS ({gsets})")


@register("wer_all_dimensions", _a8_sql())
def q_wer_all_dimensions(spark, sf_dir):
    out = R.wer_all_dimensions(X.results(spark, sf_dir))
    return out.drop("sum_baseline_wer", "sum_finetuned_wer")


@register("order_results", _res(
    "SELECT augmentation, gender, count(*) AS samples FROM results GROUP BY augmentation, gender "
    "ORDER BY augmentation, gender"))
def q_order_results(spark, sf_dir):
    from vocalis.operators.relational import order_by
    res = X.results(spark, sf_dir)
    return order_by(res.groupBy("augmentation", "gender").agg(F.count(F.lit(1)).alias("samples")),
                    "augmentation", "gender")


_SUBMODULES = ("text_queries", "kb_queries", "order_queries", "audio_queries", "stream_queries", "misc_queries")


def load_all() -> None:
    """Import every catalogue module so all keys are registered."""
    import importlib
    for name in _SUBMODULES:
        importlib.import_module(f"vocalis.plans.{name}")
