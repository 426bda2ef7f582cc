"""Every operator with an SQL twin: Spark result == DuckDB result (sf0.001)."""

import math

import pandas as pd
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

ORACLE = E.oracle_sql()
QUERIES = E.queries()


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return round(v, 9) + 0.0
    if hasattr(v, "tolist"):
        v = v.tolist()
    if hasattr(v, "asDict"):
        v = v.asDict(recursive=True)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    return v


def _rows(df: pd.DataFrame):
    cols = sorted(df.columns)
    return sorted((tuple(_norm(r[c]) for c in cols) for r in df.to_dict("records")), key=repr)


def test_every_twin_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_twin(spark, duck, key):
    sdf = QUERIES[key](spark, SF_SMALL)
    got = pd.DataFrame([r.asDict(recursive=True) for r in sdf.collect()], columns=sdf.columns)
    want = duck.execute(ORACLE[key]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert _rows(got) == _rows(want)


def test_entry(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert [f.name for f in df.schema.fields] == ["severity", "samples", "baseline_WER_pct", "finetuned_WER_pct",
                                                   "improvement_pct"]
    assert len(rows) == 3
    assert [r.finetuned_WER_pct for r in rows] == sorted(r.finetuned_WER_pct for r in rows)
