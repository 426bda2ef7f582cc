"""WER/CER and text functions against plain-Python brute force."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vocalis.functions import text as T
from vocalis.operators import alignment as AL
from vocalis.operators.wer import pair_wer


def brute_distance(a, b):
    n, m = len(a), len(b)
    dp = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n + 1):
        dp[i][0] = i
    for j in range(m + 1):
        dp[0][j] = j
    for i in range(1, n + 1):
        for j in range(1, m + 1):
            dp[i][j] = dp[i - 1][j - 1] if a[i - 1] == b[j - 1] else 1 + min(dp[i - 1][j], dp[i][j - 1], dp[i - 1][j - 1])
    return dp[n][m]


def dp_distance(a, b):
    """The same distance one anti-diagonal at a time."""
    code = {t: k for k, t in enumerate(dict.fromkeys([*a, *b]))}
    x, y = np.array([code[t] for t in a], dtype=int), np.array([code[t] for t in b], dtype=int)
    n, m = len(x), len(y)
    far = n + m + 1
    before, last = np.full(n + 1, far), np.full(n + 1, far)
    for d in range(n + m + 1):
        i = np.arange(max(0, d - m), min(n, d) + 1)
        now = np.full(n + 1, far)
        j = d - i
        now[i[j == 0]] = i[j == 0]
        now[i[i == 0]] = j[i == 0]
        k = i[(i > 0) & (j > 0)]
        if len(k):
            now[k] = np.minimum(before[k - 1] + (x[k - 1] != y[d - k - 1]), 1 + np.minimum(last[k - 1], last[k]))
        before, last = last, now
    return int(last[n])


def sql_round(x, digits):
    """SQL ROUND, half away from zero on the decimal form of the value."""
    from decimal import ROUND_HALF_UP, Decimal
    return float(Decimal(repr(x)).quantize(Decimal(1).scaleb(-digits), rounding=ROUND_HALF_UP))


def brute_wer(ref, hyp):
    r, h = ref.lower().split(), hyp.lower().split()
    return 0.0 if not r else sql_round(brute_distance(r, h) / len(r), 4)


EDGE = [
    ("", ""), ("", "extra words"), ("a b c", ""), ("Hello  World", "hello world"),
    ("tab\tseparated\nlines", "tab separated lines"), ("nbsp here", "nbsp here"),
    ("café résumé", "cafe resume"), ("東京 大阪 名古屋", "東京 名古屋"), ("x " * 50, "y " * 60),
    (" ".join(f"w{i}" for i in range(300)), " ".join(f"w{i}" for i in range(0, 300, 2))),
]


def test_wer_edge_cases(spark):
    df = spark.createDataFrame(EDGE, "ref string, hyp string")
    got = [r.w for r in df.select(T.wer("ref", "hyp").alias("w")).collect()]
    assert got == [brute_wer(r, h) for r, h in EDGE]


def test_wer_many_distinct_tokens(spark):
    rng = random.Random(3)
    words = [f"tok{i}" for i in range(2000)]
    ref = " ".join(rng.choice(words) for _ in range(1500))
    hyp = " ".join(rng.choice(words) if rng.random() < 0.2 else w for w in ref.split())
    df = spark.createDataFrame([(ref, hyp)], "ref string, hyp string")
    assert df.select(T.wer("ref", "hyp")).first()[0] == brute_wer(ref, hyp)


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.lists(st.sampled_from(list("abcdeXY")), max_size=12),
                          st.lists(st.sampled_from(list("abcdeXY")), max_size=12)), min_size=1, max_size=8))
def test_wer_property(spark, pairs):
    data = [(" ".join(r), " ".join(h)) for r, h in pairs]
    df = spark.createDataFrame(data, "ref string, hyp string")
    got = [r.w for r in df.select(T.wer("ref", "hyp").alias("w")).collect()]
    assert got == [brute_wer(r, h) for r, h in data]


def test_pair_wer(spark):
    df = spark.createDataFrame([("a b c d", "a x c"), ("", "z")], "correct_transcription string, model_output string")
    out = pair_wer(df).collect()
    assert [r.errors for r in out] == [2, 1] and [r.wer for r in out] == [0.5, 0.0]


def test_wer_beyond_one_plane_of_characters(spark):
    """Over 70,000 distinct tokens in a pair: codes pass the surrogates and the first plane."""
    ref = [f"t{i}" for i in range(70_000)]
    hyp = ref[:100] + ["x"] + ref[101:69_990] + ["y"]
    df = spark.createDataFrame([(" ".join(ref[60_000:]), " ".join(hyp[60_000:])), (" ".join(ref[:300]), " ".join(hyp[:300]))],
                               "correct_transcription string, model_output string")
    assert [r.errors for r in pair_wer(df).collect()] == [10, 1]
    wide = spark.createDataFrame([(ref, ref[:3])], "r array<string>, h array<string>")
    assert wide.select(T.token_edit_distance(F.col("r"), F.col("h"))).first()[0] == 69_997


def test_cer(spark):
    data = [("kitten", "sitting"), ("", "abc"), ("é", "e")]
    df = spark.createDataFrame(data, "r string, h string")
    got = [x.c for x in df.select(T.cer("r", "h").alias("c")).collect()]
    assert got == [round(3 / 6, 4), 0.0, 1.0]


@pytest.mark.parametrize("n,m", [(0, 5), (5, 0), (40, 37), (2100, 2050)])
def test_alignment_is_optimal(n, m):
    rng = np.random.default_rng(n + m)
    a, b = rng.integers(0, 30, n), rng.integers(0, 30, m)
    ops = AL.align(a, b)
    subs = sum(o == "sub" for o, _, _ in ops)
    dels = sum(o == "del" for o, _, _ in ops)
    ins = sum(o == "ins" for o, _, _ in ops)
    hits = sum(o == "hit" for o, _, _ in ops)
    assert subs + dels + ins == AL.distance(a, b)
    assert subs + dels + hits == n and subs + ins + hits == m
    if n * m < 10_000:
        assert AL.distance(a, b) == brute_distance(list(a), list(b))


def test_edit_ops_job(spark):
    df = spark.createDataFrame([(1, "the cat sat", "the hat sat down"), (2, "", "a")],
                               "pair_id long, r string, h string")
    ops = AL.edit_ops(df, "pair_id", "r", "h").collect()
    one = [(o.op, o.ref_tok, o.hyp_tok) for o in ops if o.pair_id == 1]
    assert one == [("hit", "the", "the"), ("sub", "cat", "hat"), ("hit", "sat", "sat"), ("ins", None, "down")]
    assert [(o.op, o.hyp_tok) for o in ops if o.pair_id == 2] == [("ins", "a")]


def test_text_helpers(spark):
    df = spark.createDataFrame([('```json\n{"a": 1}\n```  ',), ('"  quoted "',), ("'x'",), ('say \\"hi\\"',),
                                ("um so like you  know it works uh",)], "t string")
    out = df.select(T.strip_fences("t").alias("f"), T.strip_quotes("t").alias("q"),
                    T.unescape_quotes("t").alias("u"), T.remove_fillers("t").alias("r")).collect()
    assert out[0].f == '{"a": 1}'
    assert out[1].q == "quoted" and out[2].q == "x"
    assert out[3].u == 'say "hi"'
    assert out[4].r == "so it works"
    assert df.select(T.tokenize(F.lit(" A\tb  c "))).first()[0] == ["a", "b", "c"]
    assert df.select(T.word_list(F.lit("a  b"))).first()[0] == ["a", "", "b"]


def test_wer_documents_against_numpy_dp(spark):
    """Whole documents (the longest have thousands of tokens) vs a DP of its own."""
    import __spark_entry__ as E
    from conftest import SF_SMALL
    from vocalis.plans import fixtures as X
    got = {r.pair_id: (r.errors, r.wer) for r in E.queries()["wer_documents"](spark, SF_SMALL).collect()}
    pairs = X.document_pairs(spark, SF_SMALL).collect()
    assert len(got) == len(pairs) > 0
    for p in pairs:
        r, h = p.correct_transcription.split(), p.model_output.split()
        d = dp_distance(r, h)
        assert got[p.pair_id] == (d, 0.0 if not r else sql_round(d / len(r), 4)), p.pair_id


def test_alignment_path_is_canonical():
    """The path that the whole matrix gives under one tie rule, at any number of kept rows."""
    rng = np.random.default_rng(8)
    for _ in range(150):
        a, b = rng.integers(0, 4, rng.integers(0, 14)), rng.integers(0, 4, rng.integers(0, 14))
        dp = np.zeros((len(a) + 1, len(b) + 1), dtype=int)
        dp[0], dp[:, 0] = np.arange(len(b) + 1), np.arange(len(a) + 1)
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                dp[i, j] = min(dp[i - 1, j - 1] + (a[i - 1] != b[j - 1]), dp[i - 1, j] + 1, dp[i, j - 1] + 1)
        i, j, want = len(a), len(b), []
        while i or j:
            if i and j and dp[i, j] == dp[i - 1, j - 1] + (a[i - 1] != b[j - 1]):
                i, j = i - 1, j - 1
                want.append(("hit" if a[i] == b[j] else "sub", i, j))
            elif i and dp[i, j] == dp[i - 1, j] + 1:
                i -= 1
                want.append(("del", i, None))
            else:
                j -= 1
                want.append(("ins", None, j))
        assert AL.align(a, b) == want[::-1]


def test_strip_fences_leading_whitespace(spark):
    df = spark.createDataFrame([("\n  ```json\n{}\n```",), ("\n {} ",)], "t string")
    assert [r[0] for r in df.select(T.strip_fences("t")).collect()] == ["{}", "{}"]


def test_reaches_equal_the_matrix(monkeypatch):
    """Lists, arrays and bit rows of any block size give the matrix's distance and path."""
    from vocalis.operators import diagonals as D
    rng = np.random.default_rng(4)
    for lists, bits in ((0, 5), (3, 16), (48, 1 << 14)):
        monkeypatch.setattr(D, "LIST_ERRORS", lists)
        monkeypatch.setattr(D, "BIT_BLOCK", bits)
        for _ in range(300):
            a, b = (rng.integers(0, rng.integers(1, 7), rng.integers(0, 40)).tolist() for _ in range(2))
            want = D.matrix_path(np.array(a, dtype=int), np.array(b, dtype=int))
            errors = sum(op != "hit" for op, _, _ in want)
            assert D.align(a, b) == want
            assert D.distance(a, b) == D.bit_distance(a, b) == errors
            assert len(D.reaches(a, b)) - 1 == errors and D.reaches(a, b, errors - 1) is None


def test_paths_from_bits_equal_the_matrix(monkeypatch):
    """Blocks of any height give the matrix's path; a pair of many errors never comes to the matrix or to long diagonals."""
    from vocalis.operators import diagonals as D
    rng = np.random.default_rng(8)
    for rows in (1, 3, 16, 1 << 10):
        monkeypatch.setattr(D, "PATH_ROWS", rows)
        monkeypatch.setattr(D, "PATH_BYTES", 1)
        for _ in range(300):
            a, b = (rng.integers(0, rng.integers(1, 7), rng.integers(0, 40)).tolist() for _ in range(2))
            assert D.bit_path(a, b) == D.matrix_path(np.array(a, dtype=int), np.array(b, dtype=int))
    a = [f"w{x}" for x in rng.integers(0, 300, 1500)]
    b = [("uh" if i % 7 == 0 else t) for i, t in enumerate(a, 1) if i % 13]
    want = D.matrix_path(np.array(a), np.array(b))
    monkeypatch.setattr(D, "matrix_path", None)
    monkeypatch.setattr(D, "_next_array", None)
    for rows in (64, 1 << 10):
        monkeypatch.setattr(D, "PATH_ROWS", rows)
        assert D.align(a, b) == want
    assert D.distance(a, b) == sum(op != "hit" for op, _, _ in want)


def test_long_texts_of_many_and_few_errors():
    from vocalis.operators import diagonals as D
    rng = random.Random(6)
    a = [f"w{rng.randrange(500)}" for _ in range(3000)]
    for share in (0.002, 0.3, 1.0):
        b = [t if rng.random() > share else "x" for t in a if rng.random() > share / 3]
        ops = D.align(a, b)
        assert D.distance(a, b) == D.bit_distance(a, b) == sum(op != "hit" for op, _, _ in ops)
        assert [h for op, i, j in ops for h in ([] if j is None else [b[j]])] == b
        assert sum(op != "ins" for op, _, _ in ops) == len(a)
    assert len(D.reaches(a, a[:1500] + ["x"] + a[1500:])) == 2


def test_document_errors_defined_cases(spark):
    from vocalis.operators.alignment import document_errors
    rows = [(1, "a b c", "a x c"), (2, "", "z z"), (3, "A  b", "a b"), (4, None, "a"), (5, "a b", None)]
    df = spark.createDataFrame(rows, "pair_id long, correct_transcription string, model_output string")
    got = {r.pair_id: (r.ref_words, r.errors, r.wer) for r in document_errors(df).collect()}
    assert got[1] == (3, 1, 0.3333) and got[2] == (0, 2, 0.0) and got[3] == (2, 0, 0.0) and got[5][1] == 2
    assert document_errors(df.limit(0)).count() == 0


def test_token_lists_come_one_by_one():
    import pyarrow as pa
    from vocalis.operators import alignment as AL
    batch = pa.RecordBatch.from_arrays([pa.array([["a", "b"], None, [], ["c"]], pa.list_(pa.string()))], names=["_r"])
    tokens = AL._tokens(batch, "_r")
    assert not isinstance(tokens, list) and next(tokens) == ["a", "b"]
    assert list(tokens) == [[], [], ["c"]]


def test_documents_cross_as_text(spark):
    """Tokens come over joined by blanks, not as lists; nulls, empty texts and every kind of white space stay as they were."""
    import pyarrow as pa
    batch = pa.RecordBatch.from_arrays([pa.array(["a b", None, "", "c\u00e9"])], names=["_r"])
    assert list(AL._words(batch, "_r")) == [["a", "b"], [], [], ["c\u00e9"]]
    rows = [(1, " A\tb\u2003c ", "a\u00a0x c"), (2, "", "z z"), (3, None, "a"), (4, "a b", None), (None, " ", "")]
    df = spark.createDataFrame(rows, "pair_id long, correct_transcription string, model_output string")
    for out in (AL.document_alignment(df), AL.document_errors(df)):
        sent = out._jdf.queryExecution().analyzed().toString()
        assert "array_join" in sent
    got = {r.pair_id: tuple(r)[1:] for r in AL.document_alignment(df).collect()}
    assert got == {1: (2, 1, 0, 0, "a x c"), 2: (0, 0, 0, 2, "z z"), 3: (0, 0, 0, 1, "a"), 4: (0, 0, 2, 0, ""), None: (0, 0, 0, 0, "")}
