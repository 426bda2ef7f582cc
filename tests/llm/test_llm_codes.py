"""Cover-tree codes, framed token files and collocations: against brute force, the tokenizer, and on their defined cases."""

import collections
import random
import re
import struct
import zlib

import numpy as np
import pytest
import zstandard
from conftest import SF_SMALL
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vocalis.llm import collocations, cover_tree_codes, token_frames
from vocalis.llm.queries import QUERIES, word_tokenizer_path
from vocalis.session import scratch_path

CLASHES = ("code", "error", "label_error", "_label", "v", "_row", "ids", "width", "shard", "base", "n", "a", "rank", "phrase")


# ------------------------------------------------------------------ op11
def brute_lloyd(rows, parts=8, entries=16, rounds=6):
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    size = len(rows[0][1])
    pts = [[[int(np.floor(float(np.float32(x)) * 4096)) for x in v[p * size // parts:(p + 1) * size // parts]] for p in range(parts)]
           for _, v, _ in rows]
    books = [[list(pts[k][p]) for k in range(min(entries, len(pts)))] for p in range(parts)]

    def near(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            mine = collections.defaultdict(list)
            for x in pts:
                mine[near(p, x[p])[1]].append(x[p])
            for k, xs in mine.items():
                books[p][k] = [sum(c) // len(xs) for c in zip(*xs)]
    out, by_label = [], collections.Counter()
    for (i, _, label), x in zip(rows, pts):
        got = [near(p, x[p]) for p in range(parts)]
        out.append([i, "".join(f"{k:02x}" for _, k in got), sum(d for d, _ in got), label])
        by_label[label] += out[-1][2]
    return sorted((i is None, i or 0, c, e, by_label[label]) for i, c, e, label in out)


def vectors(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    for c in CLASHES:
        df = df.withColumn(c, F.lit(1))
    return df.repartition(3)


def coded(df):
    return sorted((r["vec_id"] is None, r["vec_id"] or 0, r["code"], r["error"], r["label_error"]) for r in df.collect())


@pytest.mark.parametrize("block", [37, 8192])
def test_codes_equal_brute_force(spark, monkeypatch, block):
    rng = random.Random(block)
    rows = [(k, [rng.gauss(k % 5, 0.4) for _ in range(16)], rng.choice([None, 1, 2])) for k in range(300)]
    rows += [(1000 + k, rows[7][1], 3) for k in range(60)]  # copies
    rows += [(None, [0.5] * 16, None), (5, [-2.0] * 16, 1), (5, [-2.0] * 16, 1)]
    monkeypatch.setattr(cover_tree_codes.build_blocks, "__defaults__", (8, block))
    assert coded(cover_tree_codes.compress(vectors(spark, rows))) == brute_lloyd(rows)


def test_codes_defined_cases(spark):
    good = [(1, [0.0] * 8, None), (2, [1.0] * 8, 4), (2, [1.0] * 8, 4)]
    bad = [(0, None, 1), (3, [1.0] * 7 + [None], 1), (4, [float("nan")] + [0.0] * 7, 1), (5, [float("-inf")] * 8, 1), (6, [1.0], 1)]
    assert coded(cover_tree_codes.compress(vectors(spark, good + bad))) == brute_lloyd(good)
    assert cover_tree_codes.compress(vectors(spark, bad[:4])).count() == 0
    assert cover_tree_codes.compress(vectors(spark, good).limit(0)).count() == 0
    odd = cover_tree_codes.compress(vectors(spark, [(1, [0.0, 1.0, 2.0], 1), (2, [5.0, 1.0, 2.0], 1)])).collect()
    assert {r["code"] for r in odd} == {"00" * 8, "01" + "00" * 7} and {r["label_error"] for r in odd} == {0}
    large = [(k, [float(10 ** (k % 4 * 12)) * (-1) ** k] * 8, 1) for k in range(30)]
    out = cover_tree_codes.compress(vectors(spark, large))
    assert [r[:3] for r in coded(out)] == [r[:3] for r in brute_lloyd(large)]


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 400), st.integers(1, 16), st.integers(1, 4), st.sampled_from([1, 3, 50, 10 ** 5]), st.integers(0, 10 ** 6))
def test_tree_assigns_like_brute_force(n, entries, width, spread, seed):
    rng = np.random.default_rng(seed)
    points = rng.integers(-spread, spread + 1, (n, width))
    book = rng.integers(-spread, spread + 1, (entries, width))
    tree = cover_tree_codes.Tree.from_bytes(cover_tree_codes.build_tree(points, leaf=4).to_bytes())
    want = cover_tree_codes.distances(points, book).argmin(axis=1)
    code, error = cover_tree_codes.codes(tree, points, book)
    assert (code == want).all() and (error == cover_tree_codes.distances(points, book).min(axis=1)).all()
    sums, counts = cover_tree_codes.totals(tree, points, book)
    assert (counts == np.bincount(want, minlength=entries)).all()
    assert all((sums[k] == points[want == k].sum(axis=0)).all() for k in range(entries) if counts[k])


def test_tree_covers_and_prunes():
    rng = np.random.default_rng(5)
    points = np.concatenate([rng.normal(c, 40, (500, 3)) for c in (0, 5000, 20_000)]).astype(np.int64)
    tree = cover_tree_codes.build_tree(points)
    for k in range(len(tree.centre)):
        inside = points[tree.order[tree.begin[k]:tree.end[k]]]
        assert np.sqrt(((inside - points[tree.centre[k]]) ** 2).sum(axis=1)).max() <= tree.radius[k]
    book = np.array([[0] * 3, [5000] * 3, [20_000] * 3])
    found, whole = cover_tree_codes.assign(tree, points, book)
    assert (found < 0).all() and sum(len(w[0]) for w in whole) <= 6  # whole subtrees, no point compared


# ------------------------------------------------------------------ op12
@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(word_tokenizer_path())


@pytest.fixture(scope="module")
def ids():
    with open(word_tokenizer_path(), encoding="utf-8") as f:
        return token_frames.Ids(f.read())


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(
    st.text(max_size=8), st.sampled_from([
        "Word,", "d'Or...", "don't", "ÉTÉ?!", "ß$$$", "x1y2", "\x0b", "\x0c", "µª²½", "''re", "'LL've'", "it's", "'sam", "<|", "<|endoftext|>", "a<|startoftext|>.b", "\x1c", "\x85", "\xa0", " ", "é",
        "́", "İ", "Σς", "ﬁ", "가", "가", "12,34", " ", "\n", "\t ", "(word)", "w'", "'s", "–", "naïve."])), max_size=12))
def test_word_ids_equal_the_tokenizer(ids, tokenizer, strings):
    for text in ("".join(strings), " ".join(strings)):
        got = np.frombuffer(ids.of([text])[0], f"<u{ids.width}").tolist()
        assert got == tokenizer.encode(text, add_special_tokens=False).ids


def test_word_ids_of_long_strings(ids, tokenizer):
    rng = random.Random(2)
    for text in ("".join(rng.choice("abcDEF0123456789+/=") for _ in range(40_000)), "x" * 9000 + "<|endoftext|>" + "7" * 9000):
        assert np.frombuffer(ids.of([text])[0], "<u2").tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    known = len(ids._known)
    ids.of(["y9" * 9000])
    assert len(ids._known) == known


ROWS = [(3, "Hello there, general reader. " * 5000), (1, None), (2, ""), (None, "no id"), (7, " \n\t"), (5, "same text"), (5, "same text"),
        (-4, "below zero"), (9, "Ünïcode – “quotes” 123 " * 40)]


def stored(tokenizer, rows):
    """(doc_id, start, n, crc) as the contract says, equal ids in any order."""
    out, at = [], 0
    coded = [(d, np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], dtype="<u4")) for d, t in rows]
    for d, x in sorted(coded, key=lambda r: (r[0] is not None, r[0] or 0, zlib.crc32(r[1].tobytes()))):
        out.append((d, at, len(x), zlib.crc32(x.tobytes())))
        at += len(x)
    return out


def with_clashes(df):
    for c in CLASHES:
        df = df.withColumn(c, F.lit(1))
    return df


@pytest.mark.parametrize("frame_ids,shard_ids", [(1 << 16, 1 << 23), (100, 5000), (7, 30_000)])
def test_token_files_round_trip(spark, tokenizer, monkeypatch, frame_ids, shard_ids):
    monkeypatch.setattr(token_frames, "FRAME_IDS", frame_ids)
    docs = with_clashes(spark.createDataFrame(ROWS, "doc_id long, text string")).repartition(3)
    path = scratch_path(spark, "frames")
    token_frames.write_files(docs, path, word_tokenizer_path(), "rows", shard_ids)
    got = token_frames.read_files(spark, path).withColumn("crc", F.crc32("tokens")).join(token_frames.file_starts(token_frames.file_sizes(spark, path)), "shard")
    rows = sorted(((r["doc_id"], r["base"] + r["start_in_file"], r["n_tokens"], r["crc"]) for r in got.collect()), key=lambda r: r[1])
    assert rows == stored(tokenizer, ROWS)


def test_token_query_on_whole_table(spark, tokenizer):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = sorted(map(tuple, QUERIES["op12_token_frames"](spark, SF_SMALL).collect()), key=lambda r: r[1])
    assert got == stored(tokenizer, [tuple(r) for r in docs])
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert token_frames.store_tokens(empty, word_tokenizer_path()).count() == 0


def file_of(docs, width=2, frame_ids=50):
    old, token_frames.FRAME_IDS = token_frames.FRAME_IDS, frame_ids
    try:
        writer = token_frames.FileWriter(3, width)
        out = [f for d, x in docs for f in writer.add(d, np.array(x, dtype=f"<u{width}").tobytes())] + list(writer.close())
    finally:
        token_frames.FRAME_IDS = old
    return b"".join(f + token_frames.EMPTY_FRAME for f in out)


@pytest.mark.parametrize("width", [2, 4])
def test_files_are_plain_zstandard_and_seekable(width):
    rng = random.Random(1)
    docs = [(k * 10, [rng.randrange(60_000) for _ in range(rng.choice([0, 1, 40, 333]))]) for k in range(40)]
    data = file_of(docs, width)
    plain = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
    assert np.frombuffer(plain, f"<u{width}").tolist() == [i for _, x in docs for i in x]
    reader = token_frames.FileReader(data)
    assert reader.doc_ids == [d for d, _ in docs] and reader.shard == 3
    long = next(k for k, (_, x) in enumerate(docs) if len(x) == 40)
    ((_, one),) = reader.documents([long])
    assert one.tolist() == docs[long][1] and reader.frames_read <= 2  # of over a hundred
    assert [x.tolist() for _, x in reader.documents(range(40))] == [x for _, x in docs]


def test_damage_is_found():
    docs = [(k, list(range(k, k + 60))) for k in range(20)]
    data = bytearray(file_of(docs))
    reader = token_frames.FileReader(bytes(data))
    start = int(reader._at[reader._data[5]])
    swapped = bytes(data[:start]) + data[start + int(reader._entries[5, 0]):] + data[start:start + int(reader._entries[5, 0])]
    for broken in (bytes(data[:-1]), bytes(data[:-30]), swapped, b"short"):
        with pytest.raises((ValueError, struct.error, zstandard.ZstdError)):
            list(token_frames.FileReader(broken).documents(range(20)))
    data[start + 12] ^= 0x41
    reader = token_frames.FileReader(bytes(data))
    assert [i for i, _ in reader.documents([0, 1])] == [0, 1]  # other frames still read
    with pytest.raises((ValueError, zstandard.ZstdError)):
        list(reader.documents(range(20)))


def test_only_chosen_documents(spark):
    path = scratch_path(spark, "frames")
    token_frames.write_files(spark.createDataFrame(ROWS, "doc_id long, text string"), path, word_tokenizer_path(), "rows", 10_000)
    got = token_frames.read_files(spark, path, [5, 9, 1000]).collect()
    assert sorted(r["doc_id"] for r in got) == [5, 5, 9]


# ------------------------------------------------------------------ op13
def brute_phrases(rows, min_count, depth=4):
    count, n = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n-\r]", lower):
            ws = re.findall("[^ \t]+", piece)
            n[lang] += len(ws)
            for size in range(1, depth + 1):
                for i in range(len(ws) - size + 1):
                    count[lang, tuple(ws[i:i + size])] += 1
    return count, n


def brute_collocations(rows, min_count=30, top=2000):
    count, n = brute_phrases(rows, min_count)
    found = {k: a for k, a in count.items() if a >= min_count and len(k[1]) > 1}
    out = collections.defaultdict(list)
    for (lang, p), a in found.items():
        cuts = [(2_000_000 * a // (count[lang, p[:k]] + count[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        if not any(q_lang == lang and len(q) > len(p) and 100 * b >= 80 * a and
                   any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1)) for (q_lang, q), b in found.items()):
            out[lang].append((-score, -a, " ".join(p).encode(), count[lang, p[:k]], count[lang, p[k:]]))
    return sorted((lang, rank + 1, p.decode(), -a, left, right, n[lang], -score) for lang, ps in out.items()
                  for rank, (score, a, p, left, right) in enumerate(sorted(ps)[:top]))


def phrase_rows(seed, n=150):
    rng = random.Random(seed)
    vocab = ["a", "b", "C", "d", "é", "Zz", "the", "of", "x\x0b", " "]
    rows = []
    for _ in range(n):
        ws = [rng.choice(vocab[:rng.choice([2, 4, 10])]) for _ in range(rng.randint(0, 60))]
        if rng.random() < 0.3:
            ws[3:3] = ["once", "upon", "a", "time"]
        rows.append((rng.choice(["en", "en", "fr", None]), "".join(w + rng.choice([" ", " ", " ", "\t", ", ", ".", "\r\n"]) for w in ws)))
    return rows + [("en", None), ("en", ""), (None, " \n ,;"), ("xx", "lonely words here")] + rows[:3]


@pytest.mark.parametrize("sizes", [(1 << 21, 1 << 22, 1 << 18), (60, 100, 10), (20, 30, 4)])
def test_collocations_equal_brute_force(spark, monkeypatch, sizes):
    for name, value in zip(("SHARD_WORDS", "HELD_WORDS", "PIECE_WORDS"), sizes):
        monkeypatch.setattr(collocations, name, value)
    rows = phrase_rows(sizes[0])
    docs = with_clashes(spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "doc_id long, lang string, text string")).repartition(4)
    got = sorted(map(tuple, collocations.collocations(docs).collect()))
    assert got == brute_collocations(rows) and len(got) > 10
    few = collocations.collocations(docs, top=3).groupBy("lang").count().collect()
    assert all(r["count"] <= 3 for r in few)
    assert collocations.collocations(docs.limit(0)).count() == 0


def test_collocations_of_a_crowded_bit_table(spark, monkeypatch):
    """Wrong bits cost rows, never counts."""
    monkeypatch.setattr(collocations, "LEAST_BITS", 6)
    monkeypatch.setattr(collocations, "MOST_BITS", 6)
    rows = phrase_rows(8)
    docs = spark.createDataFrame(rows, "lang string, text string")
    assert sorted(map(tuple, collocations.collocations(docs).collect())) == brute_collocations(rows)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=60), st.lists(st.sampled_from(["left", "right"]), min_size=3, max_size=3))
def test_index_extends_both_ways(ids, sides):
    text = [0, *ids, 0]
    index = collocations.ShardIndex(*collocations.transforms(np.array(text, dtype=np.int32)))
    found = index.words
    for size in range(2, 5):
        found = index.extend(found, sides[size - 2])
        want = collections.Counter(tuple(text[i:i + size]) for i in range(len(text) - size + 1) if 0 not in text[i:i + size])
        assert dict(zip(map(tuple, found.words.tolist()), found.count.tolist())) == want


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b", b"."]), max_size=50), st.integers(4, 12))
def test_parts_count_shared_words_once(words, size):
    parts = list(collocations.parts_of(words, size))
    for n in range(1, 5):
        def phrases(ws):
            return collections.Counter(tuple(ws[i:i + n]) for i in range(len(ws) - n + 1) if b"." not in ws[i:i + n])
        total = collections.Counter()
        for part, shared in parts:
            total.update(phrases(part))
            total.subtract(phrases(shared) if n < 4 else {})
        assert {k: v for k, v in total.items() if v} == dict(phrases(words))
