"""Knowledge-base tables on small hand-checked inputs."""

import datetime as dt

from pyspark.sql import functions as F

from vocalis.operators import kb as K
from vocalis.sources import pairs as SP


def test_dedupe_rules_cap_and_order(spark):
    rows = [("u", i, "Cube Netties" if i % 2 else "cube netties", "Kubernetes", "medium", f"h{i}") for i in range(6)]
    rows += [("u", 10, "  ", "x", "high", None), ("u", 11, "jason", "JSON", None, "j"), ("u", 12, "jason", "json", "low", "j2")]
    raw = spark.createDataFrame(rows, "username string, seq long, stt_output string, intended string, "
                                      "frequency string, explanation string")
    out = K.rules_by_confidence(K.dedupe_rules(raw)).collect()
    assert [(r.stt_output, r.intended, r.confidence) for r in out] == [
        ("cube netties", "Kubernetes", 1.0), ("jason", "JSON", 0.8)]
    assert out[0].context_hint == "h0" and out[0].occurrences == 1


def test_dedupe_vocab_aliases(spark):
    rows = [("u", 1, "Kubernetes", None, "k8s orchestrator", ["cube netties", "Cube Netties", "k eights"]),
            ("u", 2, "kubernetes ", "proper_noun", "other", ["K Eights", "cooper netties"]),
            ("u", 3, " ", "x", "y", ["z"])]
    raw = spark.createDataFrame(rows, "username string, seq long, term string, category string, definition string, "
                                      "misheard_as array<string>")
    (r,) = K.dedupe_vocab(raw).collect()
    assert (r.term, r.category, r.definition) == ("Kubernetes", "general", "k8s orchestrator")
    assert r.aliases == ["cube netties", "k eights", "cooper netties"]


def test_apply_rules_phrases(spark):
    rules = spark.createDataFrame([("u", "cube netties", "Kubernetes", 0.9, 1), ("u", "a.b", "A$B", 0.5, 2)],
                                  "username string, stt_output string, intended string, confidence double, first_seq long")
    texts = spark.createDataFrame([("u", "deploy CUBE  netties now, cube nettiesx a.b axb"), ("v", "cube netties")],
                                  "username string, model_output string")
    out = {r.username: r.corrected for r in K.apply_rules(texts, rules).collect()}
    assert out["u"] == "deploy Kubernetes now, cube nettiesx A$B axb"
    assert out["v"] == "cube netties"


def test_upsert_rules(spark):
    t0, t1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
    old = spark.createDataFrame([("u", "teh", "the", 0.7, "manual", "h", 2, t0, t0, 1)],
                                "username string, stt_output string, intended string, confidence double, source string, "
                                "context_hint string, occurrences long, created_at timestamp, last_seen timestamp, seq long")
    new = spark.createDataFrame([("u", "TEH", "The", 0.9, None, None, 1, t1, t1, 5),
                                 ("u", "adn", "and", 0.5, None, None, 1, t1, t1, 6),
                                 ("u", "adn", "and", 0.9, None, None, 1, t1, t1, 7)], old.schema)
    out = {r.stt_output: r for r in K.upsert_rules(old, new).collect()}
    assert out["teh"].occurrences == 3 and out["teh"].confidence == 0.8 and out["teh"].source == "manual"
    assert out["teh"].last_seen == t1 and out["teh"].created_at == t0
    assert out["adn"].source == "auto_feedback" and out["adn"].confidence == 0.6 and out["adn"].occurrences == 2


def test_parse_pairs_and_extraction(spark):
    text = spark.createDataFrame([('[("hello wrld", "hello world"), ("say \\"hi\\"", "say \\"hi\\" there"),',),
                                  ('  ( "a" , "b" ) ]',), ("no tuples here",)], "value string")
    got = [tuple(r) for r in SP.parse_pairs(text).collect()]
    assert got == [("hello wrld", "hello world"), ('say "hi"', 'say "hi" there'), ("a", "b")]
    resp = spark.createDataFrame([('```json\n{"speaker_info": {"domain": "tech"}, "corrections": '
                                   '[{"stt_output": "a", "intended": "b"}]}\n```',), ("oops",)], "response string")
    p = K.parse_extraction(resp).collect()
    assert p[0].parsed and p[0].speaker_info.domain == "tech" and len(p[0].corrections) == 1 and p[0].vocabulary == []
    assert not p[1].parsed and p[1].corrections == []


def test_mine_corrections_unequal_lengths(spark):
    pairs = spark.createDataFrame([("u", "the cube netties cluster", "the kubernetes cluster"),
                                   ("u", "cube the cluster", "cube a cluster")],
                                  "username string, model_output string, correct_transcription string")
    got = {(r.stt_output, r.intended): r["count"] for r in K.mine_corrections(pairs).collect()}
    assert got[("the", "a")] == 1
    assert sum(got.values()) == 2


def test_valid_and_append_pairs(spark):
    df = spark.createDataFrame([("a", "b"), (" \t", "b"), ("", "")], "model_output string, correct_transcription string")
    assert K.valid_pairs(df).count() == 1
    assert K.append_pairs(df, df.limit(1)).count() == 3
    assert K.alias_top3(spark.createDataFrame([(["a", "b", "c", "d"],)], "aliases array<string>")).first()[0] == \
        ["a", "b", "c"]


def test_synth_results_means(spark):
    from vocalis.operators import wer_reports as R
    from vocalis.sources.results import synth_results
    res = synth_results(spark, 100_000, seed=42)
    overall = R.wer_overall(res).first()
    assert abs(overall.baseline_WER_pct - 41.58) < 1 and abs(overall.finetuned_WER_pct - 22.92) < 1
    sev = {r.severity: r for r in R.wer_by_severity(res).collect()}
    assert abs(sev["severe"].baseline_WER_pct - 59.25) < 1 and abs(sev["mild"].finetuned_WER_pct - 14.25) < 1
    noise = {r.noise_type: r.finetuned_WER_pct for r in R.wer_by_noise(res).collect()}
    assert abs(noise["clean"] - 18.67) < 1 and abs(noise["babble"] - 26.67) < 1
    assert res.select("speaker").distinct().count() == 15
    assert sorted(r[0] for r in synth_results(spark, 1000, variant="root").select("augmentation").distinct()
                  .collect()) == sorted(["none", "pitch_shift", "time_stretch", "time_shift"])


RULES = "username string, stt_output string, intended string, confidence double, first_seq long"


def test_apply_rules_is_sequential(spark):
    """Chains, multi-word replacements, phrases, letter case: as if the rules ran one after the other."""
    import random
    import re
    rng = random.Random(11)
    vocab = ["a", "b", "c", "d", "e", "F", "g", "É", "a b", "c d e"]
    rules = []
    for u in ("u", "v", "w"):
        for i in range(12):
            stt = rng.choice(vocab[:7] if u == "u" else vocab)
            rules.append((u, stt, rng.choice([*vocab, "b a", "$1 x"]), round(rng.random(), 2), i))
    texts = [(i, rng.choice("uvwx"), "".join(rng.choice(vocab + ["A", "x", "é"]) + rng.choice([" ", "  ", "\t"])
                                              for _ in range(rng.randint(0, 12)))) for i in range(120)]
    out = K.apply_rules(spark.createDataFrame(texts, "id long, username string, model_output string"),
                        spark.createDataFrame(rules, RULES)).collect()

    def sequential(user, text):
        for _, stt, rep, _, _ in sorted((r for r in rules if r[0] == user), key=lambda r: (-r[3], r[4])):
            pattern = r"\s+".join(map(re.escape, stt.split(" ")))
            text = re.sub(r"(?i)(?<!\S)" + pattern + r"(?!\S)", lambda m: rep, text)
        return text
    assert {r.id: r.corrected for r in out} == {i: sequential(u, t) for i, u, t in texts}


def test_unrelated_rule_changes_nothing(spark):
    rules = [("u", "gonna", "going to", 0.9, 1), ("u", "to", "two", 0.8, 2)]
    texts = spark.createDataFrame([("u", "gonna é É")], "username string, model_output string")
    plain = K.apply_rules(texts, spark.createDataFrame(rules, RULES)).first().corrected
    more = K.apply_rules(texts, spark.createDataFrame([*rules, ("u", "some phrase", "x", 0.5, 3)], RULES)).first().corrected
    assert plain == more == "going two é É"
    accents = K.apply_rules(texts, spark.createDataFrame([("u", "É", "x", 0.5, 3)], RULES)).first().corrected
    assert accents == "gonna x x"


def test_mining_aligns_shifted_pairs(spark):
    pairs = spark.createDataFrame([("u", "b c d e x", "a b c d e")],
                                  "username string, model_output string, correct_transcription string")
    assert K.mine_corrections(pairs).count() == 0


def test_extraction_after_whitespace_and_merge_without_info(spark):
    rows = [("u", 1, '\n{"speaker_info": {"domain": "tech"}, "corrections": [{"stt_output": "a", "intended": "b"}]}'),
            ("u", 2, '  ```json\n{"corrections": [{"stt_output": "A", "intended": "B"}, {"stt_output": "c", "intended": "d"}]}\n```')]
    p = K.parse_extraction(spark.createDataFrame(rows, "username string, batch_no long, response string"), "response")
    assert [r.parsed for r in p.collect()] == [True, True]
    merged = K.merge_batches(p).first()
    assert merged.speaker_info.domain == "tech" and merged.last_batch == 2 and merged.batches == 2
    assert [(r.stt_output, r.intended) for r in K.dedupe_rules(K.batch_rules(p)).orderBy("first_seq").collect()] == \
        [("a", "b"), ("c", "d")]


def test_pair_files_over_lines(spark, tmp_path):
    (tmp_path / "p.txt").write_text('[("a", "b"),\n ("c",\n   "d")]\n')
    assert sorted(map(tuple, SP.read_pair_files(spark, str(tmp_path)).collect())) == [("a", "b"), ("c", "d")]


def test_rendered_rules_are_sorted(spark):
    rule = "struct<stt_output:string,intended:string,confidence:double>"
    doc = spark.createDataFrame([("u", "s", [("x", "1", 0.5), ("y", "2", 0.9)], [], ("en",))],
                                f"name string, speaker_id string, corrections array<{rule}>, "
                                "vocabulary array<struct<term:string,aliases:array<string>>>, style struct<preferred_spelling:string>")
    assert K.render_rules(doc).first().corrections_table.endswith("| y | 2 |\n| x | 1 |")


def test_rules_too_many_to_share(spark, monkeypatch):
    """Texts and rules meeting by user, a busy user in several groups, give the shared result."""
    from vocalis.operators import rule_matching as M
    rules = spark.createDataFrame([("u", "a b", "c", 0.9, 1), ("u", "c", "d e", 0.8, 2), ("v", "É", "x", 0.5, 3), ("w", " ", "y", 0.5, 4),
                                   ("u", "zz", None, 0.4, 5)], RULES)
    texts = spark.createDataFrame([("u", "A  b c"), ("v", "é a b"), (None, "a b"), ("w", "a"), ("u", None), ("z", "a b")] + [("u", "a b")] * 50,
                                  "username string, model_output string")
    want = sorted(map(str, K.apply_rules(texts, rules).collect()))
    assert str(want).count("corrected='d e d e'") == 1 and str(want).count("corrected='d e'") == 50 and "corrected='x a b'" in str(want)
    monkeypatch.setattr(M, "MAX_SHARED_RULES", 1)
    monkeypatch.setattr(M, "GROUP_TEXTS", 7)
    assert sorted(map(str, K.apply_rules(texts, rules).collect())) == want
    assert K.apply_rules(texts.limit(0), rules).count() == 0 and K.apply_rules(texts, rules.limit(0)).count() == len(want)


def test_trie_equals_one_rule_after_the_other():
    import random
    import re
    from vocalis.operators.rule_matching import RuleTrie
    rng = random.Random(5)
    for _ in range(400):
        words = ["a", "B", "c", "É", "ß", "aa"]
        rules = [(" ".join(rng.choices(words, k=rng.randint(1, 3))), " ".join(rng.choices([*words, "q", ""], k=rng.randint(1, 3))))
                 for _ in range(rng.randint(0, 8))]
        text = "".join(rng.choice([*words, "A", "b", "é"]) + rng.choice([" ", "  ", "\t", "\n "]) for _ in range(rng.randint(0, 14)))
        want = text
        for phrase, new in rules:
            pattern = r"[ \t\n\x0b\f\r]+".join(map(re.escape, phrase.split()))
            want = re.sub(r"(?i)(?<![^ \t\n\x0b\f\r])" + pattern + r"(?![^ \t\n\x0b\f\r])", lambda m: new, want)
        assert RuleTrie(rules).apply(text) == want, (rules, text)


def test_mined_phrases_and_hints(spark):
    pairs = spark.createDataFrame([
        ("u", "deploy the new micro surface to the cube netties cluster and make it so", "deploy the new microservice to the kubernetes cluster and make it so"),
        ("u", "to day we ship", "today we ship"), ("u", "the alot of work", "the a lot of work"),
        ("u", "one two three", "one too tree"), ("v", "cube netties", "kubernetes"), ("v", None, "x"), ("v", "x", None)],
        "username string, model_output string, correct_transcription string")
    out = {(r.username, r.stt_output, r.intended): r for r in K.mine_corrections(pairs).collect()}
    assert set(out) == {("u", "micro surface", "microservice"), ("u", "cube netties", "kubernetes"), ("u", "to day", "today"),
                        ("u", "alot", "a lot"), ("u", "two", "too"), ("u", "three", "tree"), ("v", "cube netties", "kubernetes")}
    assert out["u", "cube netties", "kubernetes"].context_hint == "...surface to the [cube netties → kubernetes] cluster and make..."
    assert out["u", "to day", "today"].context_hint == "... [to day → today] we ship..."
    assert out["u", "two", "too"].frequency == "low"


def test_cuts_of_changed_runs_are_cheapest():
    """The segment table against all ways to cut both sides."""
    import random
    from vocalis.operators.alignment import cut_run
    from vocalis.operators.diagonals import matrix_path
    import numpy as np

    def price(ref, hyp):
        a, b = (np.array([ord(c) for c in "".join(x)], dtype=int) for x in (ref, hyp))
        return 2 * sum(op != "hit" for op, _, _ in matrix_path(a, b)) + len(ref) + len(hyp) - 2

    def cheapest(ref, hyp):
        if not ref and not hyp:
            return 0
        ways = [price(ref[:x], hyp[:y]) + cheapest(ref[x:], hyp[y:]) for x in range(1, min(4, len(ref)) + 1) for y in range(1, min(4, len(hyp)) + 1)]
        ways += [2 * len(ref[0]) + 2 + cheapest(ref[1:], hyp)] if ref else []
        ways += [2 * len(hyp[0]) + 2 + cheapest(ref, hyp[1:])] if hyp else []
        return min(ways)

    rng = random.Random(9)
    for _ in range(120):
        ref, hyp = (["".join(rng.choices("ab", k=rng.randint(1, 4))) for _ in range(rng.randint(0, 4))] for _ in range(2))
        cuts = cut_run(ref, hyp)
        used_r = {k for a, b, _, _ in cuts for k in range(a, b)}
        used_h = {k for _, _, c, d in cuts for k in range(c, d)}
        total = sum(price(ref[a:b], hyp[c:d]) for a, b, c, d in cuts) + sum(
            2 * len(t) + 2 for side, used in ((ref, used_r), (hyp, used_h)) for k, t in enumerate(side) if k not in used)
        assert total == cheapest(ref, hyp)


def test_pair_files_in_splits(spark, tmp_path, monkeypatch):
    """Brackets, quotes, escapes and line ends in strings; splits and chunks that cut tuples anywhere; one huge line."""
    import random
    from vocalis.sources import pairs as P
    rng = random.Random(12)
    bits = ["a", ")", "(", "\\\"", "\\\\", ", ", "\n", "é", '), ("', "word "]

    def string():
        return "".join(b.replace('"', '\\"') if b == '), ("' else b for b in rng.choices(bits, k=rng.randint(0, 12)))

    want = []
    for k, gap in enumerate((",", ",\n", " ,  \r\n ")):
        pairs = [(string(), string()) for _ in range(400)]
        want += [tuple(s.replace('\\"', '"') for s in p) for p in pairs]
        body = gap.join(f'( "{a}" , "{b}" )' for a, b in pairs)
        (tmp_path / f"f{k}.txt").write_text(("[" if k else "") + body + ("]" if k else ""), newline="")
    (tmp_path / "open.txt").write_text('[("cut", "off"')
    (tmp_path / "empty.txt").write_text("")
    (tmp_path / "none.txt").write_text("no tuples (here) \"or there")
    for split, chunk in ((1 << 27, 1 << 20), (700, 50), (64, 1)):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        monkeypatch.setattr(P, "CHUNK_CHARS", chunk)
        try:
            got = P.read_pair_files(spark, str(tmp_path))
            assert sorted(map(tuple, got.collect())) == sorted(want)
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")


def test_order_of_long_lists(spark):
    """Places in lists of over 2 ** 20 items, and batch numbers near the largest long, keep their order."""
    big = (1 << 62) + 5
    small = spark.createDataFrame([("u", big + 1, [("w7", "7", "high", "late"), ("x", "y", "low", None)])],
                                  "username string, batch_no long, corrections array<struct<stt_output:string,intended:string,"
                                  "frequency:string,explanation:string>>")
    late = K.batch_rules(small)
    assert [(r.seq, r.pos) for r in late.orderBy("pos").collect()] == [(big + 1, 0), (big + 1, 1)]
    items = spark.range(1_200_000).select(
        F.lit("u").alias("username"), F.lit(big).alias("seq"), F.col("id").cast("int").alias("pos"),
        F.concat(F.lit("w"), F.pmod("id", F.lit(1_100_000)).cast("string")).alias("stt_output"), F.col("id").cast("string").alias("intended"),
        F.lit("low").alias("frequency"), F.lit(None).cast("string").alias("explanation"))
    rules = K.dedupe_rules(items.unionByName(late))
    got = rules.where("stt_output in ('w0', 'w7', 'w1099999')").select("stt_output", "intended", "first_seq", "first_pos", "confidence")
    assert sorted(map(tuple, got.collect()))[:5] == [("w0", "0", big, 0, 0.5), ("w0", "1100000", big, 1_100_000, 0.5),
                                                     ("w1099999", "1099999", big, 1_099_999, 0.5), ("w7", "1100007", big, 1_100_007, 0.5),
                                                     ("w7", "7", big, 7, 0.6)]
    assert rules.where("stt_output = 'x'").first().first_pos == 1
    vocab = spark.createDataFrame([("u", big, "Term", None, None, [f"a{k}" for k in range(30)]), ("u", big + 1, "term", None, None, ["zz", "A3"])],
                                  "username string, seq long, term string, category string, definition string, misheard_as array<string>")
    assert K.dedupe_vocab(vocab).first().aliases == [f"a{k}" for k in range(30)] + ["zz"]


def test_upsert_touches_only_its_buckets(spark, tmp_path):
    import datetime as dt
    from vocalis.sources import profiles as P
    names = [f.name for f in P.PROFILE_SCHEMA.fields]

    def docs(*rows):
        return spark.createDataFrame([tuple({"speaker_id": s, "domain": d, "updated_at": t}.get(n) for n in names) for s, d, t in rows],
                                     P.PROFILE_SCHEMA)
    t0, t1, now = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1), dt.datetime(2025, 1, 1)
    path = str(tmp_path / "store")
    P.write_profile_store(docs(*[(f"s{k}", "old", t0) for k in range(200)]), path)

    def files():
        return {f: f.stat().st_mtime_ns for f in (tmp_path / "store").rglob("part-*")}
    before = files()
    new = docs(("s1", "b", t1), ("s1", "a", t1), ("s1", "c", t0), ("fresh", "x", None))
    P.upsert_profile_store(spark, path, new, F.lit(now))
    got = {r.speaker_id: (r.domain, r.updated_at) for r in P.read_profile_store(spark, path).collect()}
    assert len(got) == 201 and got["s1"] == ("b", now) and got["fresh"] == ("x", now) and got["s7"] == ("old", t0)
    after = files()
    touched = {f.parent.name for f in before.keys() ^ after.keys()}
    assert 1 <= len(touched) <= 2 and all(after[f] == t for f, t in before.items() if f.parent.name not in touched)
    once = sorted(map(str, P.read_profile_store(spark, path).collect()))
    P.upsert_profile_store(spark, path, new, F.lit(now))
    P.upsert_profile_store(spark, path, new.limit(0), F.lit(now))
    assert sorted(map(str, P.read_profile_store(spark, path).collect())) == once


def test_kb_jobs_read_events_once(spark, monkeypatch):
    """Parsed responses and built documents are written once; what works on them reads no events."""
    from conftest import SF_SMALL
    from vocalis.plans import kb_queries as KQ
    from vocalis.sources import profiles as SP
    seen = []
    monkeypatch.setattr(KQ.K, "build_profiles", lambda m, r, v, i, f=KQ.K.build_profiles: (seen.extend([r, v, i]), f(m, r, v, i))[1])
    KQ.q_kb_build(spark, SF_SMALL)
    assert len(seen) == 3
    monkeypatch.undo()
    monkeypatch.setattr(SP, "upsert_profile_store", lambda s, p, new, now, f=SP.upsert_profile_store: (seen.append(new), f(s, p, new, now))[1])
    KQ.q_upsert_profiles(spark, SF_SMALL)
    assert len(seen) == 5
    assert not [f for df in seen for f in df.inputFiles() if "events" in f.rsplit("/", 2)[-1] or "events.parquet" in f]
