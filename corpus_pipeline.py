"""Training-data pipeline over ``documents``: from raw documents to packed token windows.

Each stage takes (spark, docs, sf_dir) and returns what the next one works on; all but the last keep the columns
of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vocalis.llm import decontaminate, ngram_join, packing, queries, secret_index, toxicity
from vocalis.llm.common import materialize, ready, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go."""
    ready(spark)
    model = toxicity.train(docs.select("doc_id", "text"), table(spark, sf_dir, "labels").select("doc_id", "toxic"),
                           queries.fold() != 0)
    return toxicity.remove_toxic(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked documents stays, the one with the smallest id."""
    ready(spark)
    return ngram_join.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark passages go."""
    ready(spark)
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the text; every document stays."""
    ready(spark)
    return secret_index.redact_documents(docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The remaining documents as pieces of token windows."""
    ready(spark)
    return packing.pack(docs, queries.tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_join", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("secrets", mask_secrets),
    ("packing", pack_windows),
]

#: The toxicity model, the tokenizer and the cuts have no SQL form; tests compare the stages with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; the output of each earlier stage is written to the shared folder and read again."""
    ready(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
