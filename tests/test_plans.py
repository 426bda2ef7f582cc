"""Physical-plan shape: one scan for all reports, no shuffle for J1,
pushdown and pruning at the Parquet scan, one Python stage for T1."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from vocalis.operators import features as FE
from vocalis.operators import wer_reports as R
from vocalis.plans import fixtures as X
from vocalis.streaming import features as SF


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_all_dimensions_single_scan(spark):
    p = plan(R.wer_all_dimensions(X.results(spark, SF_SMALL)))
    assert p.count("FileScan parquet") == 1 and "Expand" in p


def test_file_x_technique_no_shuffle(spark):
    p = plan(FE.explode_techniques(X.manifest(spark, SF_SMALL)))
    assert "Exchange" not in p and "Generate" in p


def test_pushdown_and_pruning(spark):
    df = X.table(spark, SF_SMALL, "lineitem").filter(F.col("l_quantity") > 10).select("l_orderkey")
    p = plan(df)
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,10.0)]" in p
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in p


def test_stream_features_one_python_stage(spark):
    msgs = spark.createDataFrame([], "key binary, value binary, timestamp timestamp")
    p = plan(SF.stream_features(msgs))
    assert p.count("MapInPandas") == 1 and "BatchEvalPython" not in p


def test_wer_stays_in_jvm(spark):
    p = plan(X.pairs(spark, SF_SMALL).select(__import__("vocalis.functions.text", fromlist=["wer"]).wer(
        "correct_transcription", "model_output")))
    assert "Python" not in p and "Exchange" not in p


def test_epoch_micros_ignores_session_time_zone(spark):
    from vocalis.operators.relational import epoch_micros
    df = spark.sql("SELECT TIMESTAMP_NTZ '2024-01-01 00:00:01' AS ts")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        ny = df.select(epoch_micros(df, "ts")).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert ny == df.select(epoch_micros(df, "ts")).first()[0] == 1704067201000000


def test_spread_is_explicit(spark):
    from vocalis.operators.relational import spread
    small = spark.range(0, 10, numPartitions=1)
    assert spread(small, None) is small and spread(small, 6).rdd.getNumPartitions() == 6


def test_first_rows_use_hash_aggregates(spark):
    from vocalis.operators import kb as K
    rules, vocab, log = (f(spark, SF_SMALL) for f in (X.rules_raw, X.vocab_raw, X.mapping_log))
    batches = spark.createDataFrame([("u", 1, None)], "username string, batch_no long, speaker_info struct<domain:string>")
    stored = spark.createDataFrame([], "username string, stt_output string, intended string, confidence double, source string, "
                                       "context_hint string, occurrences long, created_at timestamp, last_seen timestamp, seq long")
    for df in (K.upsert_rules(stored, stored), K.dedupe_rules(rules), K.dedupe_vocab(vocab), K.latest_mapping(log), K.merge_batches(batches)):
        assert "SortAggregate" not in plan(df)


def test_no_local_folder_on_a_cluster(spark, monkeypatch):
    """Without a shared folder only local mode makes one of its own."""
    import types

    import pytest

    from vocalis import session

    def fake(master):
        conf = types.SimpleNamespace(get=lambda key, default=None: default)
        return types.SimpleNamespace(conf=conf, sparkContext=types.SimpleNamespace(getConf=lambda: conf, master=master))
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]", "k8s://x"):
        with pytest.raises(RuntimeError, match="checkpoint"):
            session.ensure_checkpoint_dir(fake(master))
    assert session.ensure_checkpoint_dir(spark)
