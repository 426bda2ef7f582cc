"""Inference-result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

RESULTS_SCHEMA = T.StructType([
    T.StructField("filename", T.StringType()),
    T.StructField("speaker", T.StringType()),
    T.StructField("gender", T.StringType()),
    T.StructField("severity", T.StringType()),
    T.StructField("noise_type", T.StringType()),
    T.StructField("augmentation", T.StringType()),
    T.StructField("baseline_wer", T.DoubleType()),
    T.StructField("finetuned_wer", T.DoubleType()),
])


def read_results(spark: SparkSession, path: str, schema: T.StructType = RESULTS_SCHEMA) -> DataFrame:
    """CSV with a header, explicit schema (no inference pass over the data)."""
    return spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").csv(path)


def write_results_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def register(df: DataFrame, name: str = "results") -> DataFrame:
    """S3: expose a table to SQL under ``name``."""
    df.createOrReplaceTempView(name)
    return df


def write_summary(df: DataFrame, path: str) -> None:
    """Overwrite the analytics summary as Parquet."""
    df.write.mode("overwrite").parquet(path)


def write_wer_by_severity(df: DataFrame, path: str) -> None:
    """Results partitioned by severity, so a severity filter prunes
    whole directories at read time."""
    df.write.mode("overwrite").partitionBy("severity").parquet(path)


def read_severity(spark: SparkSession, path: str, severity: str) -> DataFrame:
    return spark.read.parquet(path).filter(f"severity = '{severity}'")


# The results generator's distributions.
# (mean, sd) of the WER per severity, baseline then fine-tuned; additive noise penalties.
BASELINE_WER = {"mild": (0.22, 0.05), "moderate": (0.35, 0.07), "severe": (0.55, 0.10)}
FINETUNED_WER = {"mild": (0.10, 0.03), "moderate": (0.18, 0.05), "severe": (0.28, 0.08)}
NOISE_PENALTY = {"clean": 0.00, "gaussian": 0.05, "babble": 0.08, "reverb": 0.04}
AUGMENTATIONS = {
    "pipeline": ["gaussian_noise", "pitch_shift", "time_stretch", "time_shift"],
    "root": ["none", "pitch_shift", "time_stretch", "time_shift"],
}
GENDERS = ["M", "F"]
N_SPEAKERS = 15


def synth_results(spark: SparkSession, n: int, seed: int = 42, variant: str = "pipeline",
                  partitions: int | None = None) -> DataFrame:
    """Seeded inference-results generator, generated on the executors.

    Uniform severity / noise / augmentation / gender / speaker (hash of
    seed and row id), ``wer = round(max(0, N(mean, sd) + penalty), 4)``;
    filename ``speaker_NN_IIIII.wav``.  Reproducible for a given seed and
    partition count.
    """
    from pyspark.sql import functions as F

    def pick(values, salt):
        arr = F.array(*[F.lit(v) for v in values])
        return F.element_at(arr, (F.pmod(F.xxhash64(F.lit(seed), F.lit(salt), F.col("id")), F.lit(len(values))) + 1)
                            .cast("int"))

    sev = list(BASELINE_WER)
    df = spark.range(0, n, numPartitions=partitions or spark.sparkContext.defaultParallelism)
    df = df.select(
        "id",
        pick(sev, "severity").alias("severity"),
        pick(list(NOISE_PENALTY), "noise").alias("noise_type"),
        pick(AUGMENTATIONS[variant], "aug").alias("augmentation"),
        pick(GENDERS, "gender").alias("gender"),
        (F.pmod(F.xxhash64(F.lit(seed), F.lit("spk"), F.col("id")), F.lit(N_SPEAKERS)) + 1).alias("spk"),
        F.randn(seed).alias("z1"), F.randn(seed + 1).alias("z2"),
    )

    def lookup(d, key, idx):
        out = F.lit(None).cast("double")
        for k, v in d.items():
            out = F.when(F.col(key) == k, F.lit(v[idx] if isinstance(v, tuple) else v)).otherwise(out)
        return out

    pen = lookup(NOISE_PENALTY, "noise_type", 0)
    base = F.round(F.greatest(F.lit(0.0), lookup(BASELINE_WER, "severity", 0) + lookup(BASELINE_WER, "severity", 1)
                              * F.col("z1") + pen), 4)
    fine = F.round(F.greatest(F.lit(0.0), lookup(FINETUNED_WER, "severity", 0) + lookup(FINETUNED_WER, "severity", 1)
                              * F.col("z2") + pen), 4)
    speaker = F.concat(F.lit("speaker_"), F.lpad(F.col("spk").cast("string"), 2, "0"))
    return df.select(
        F.concat(speaker, F.lit("_"), F.lpad(F.col("id").cast("string"), 5, "0"), F.lit(".wav")).alias("filename"),
        speaker.alias("speaker"), "gender", "severity", "noise_type", "augmentation",
        base.alias("baseline_wer"), fine.alias("finetuned_wer"))
