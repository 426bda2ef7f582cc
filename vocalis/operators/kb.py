"""Knowledge-base tables: correction rules and vocabulary per speaker.

Everything is keyed by user (or speaker id).  Which row comes first is found
by hash aggregates that combine map-side (a user holding a third of all rows
shuffles one partial row per map task and key); the rows themselves are then
fetched by equi-joins that adaptive execution can split.
Rule/vocabulary collections are built only after de-duplication, so their
size is bounded by the distinct rules of a speaker, not by raw rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vocalis.functions.formatting import freq_to_confidence
from vocalis.operators.relational import first_rows, spread
from vocalis.functions.text import DEFAULT_FILLERS, is_blank, strip_ws, tokenize

# Rule sources and speaking-style defaults of a profile.
SOURCE_LLM, SOURCE_FEEDBACK, SOURCE_MANUAL = "llm_suggested", "auto_feedback", "manual"
FORMALITIES = ["casual", "professional", "academic", "mixed"]
DEFAULT_FORMALITY = "professional"
DEFAULT_DOMAIN = "general"
DEFAULT_LANGUAGES = ["en"]
DEFAULT_SPELLING = "en-US"

# The format of rendered rules and vocabulary.
RULE_TABLE_HEAD = "| STT Error | Correct |\n|---|---|\n"
ALIASES_OPEN, ALIASES_CLOSE = " (STT may say: ", ")"
NOTHING = "(none)"


def _keys(key: Sequence[str] | str) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _same_keys(keys: Sequence[str]) -> Column:
    """Null-safe equality with the columns of the same names behind ``n``."""
    same = F.lit(True)
    for c in keys:
        same = same & F.col(c).eqNullSafe(F.col(f"n{c}"))
    return same


def _order(df: DataFrame, prefix: str = "") -> list[str]:
    """The columns that tell which row came first: ``seq`` and, where rows come from lists, their place ``pos``."""
    return [f"{prefix}{c}" for c in ("seq", "pos") if f"{prefix}{c}" in df.columns]


def _first_seen(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key in the order of several columns, one hash aggregate and join after the other."""
    for column in order:
        df = first_rows(df, keys, column)
    return df


# ------------------------------------------------------------------ P6 / P9 / U1
def valid_pairs(df: DataFrame, a: str = "model_output", b: str = "correct_transcription") -> DataFrame:
    """Both sides non-blank after trimming all whitespace."""
    return df.filter(~is_blank(a) & ~is_blank(b))


def append_pairs(existing: DataFrame, new: DataFrame, a: str = "model_output",
                 b: str = "correct_transcription") -> DataFrame:
    """Existing pairs with at least one non-blank side, then the new
    pairs; duplicates kept (bag union, no shuffle)."""
    keep = existing.filter(~is_blank(a) | ~is_blank(b))
    return keep.unionByName(new, allowMissingColumns=True)


def clean_rules(raw: DataFrame) -> DataFrame:
    """Strip both sides; drop a rule with a blank side."""
    r = raw.withColumn("stt_output", strip_ws("stt_output")).withColumn("intended", strip_ws("intended"))
    return r.filter((F.col("stt_output") != "") & (F.col("intended") != ""))


def clean_vocab(raw: DataFrame) -> DataFrame:
    """Strip the term; drop blank terms."""
    return raw.withColumn("term", strip_ws("term")).filter(F.col("term") != "")


# ------------------------------------------------------------------ A13
def dedupe_rules(raw: DataFrame, key: Sequence[str] | str = ("username",)) -> DataFrame:
    """One rule per ``lower(stt) -> lower(intended)`` per key.

    The first occurrence (smallest ``seq``, then ``pos`` if there is one) supplies text, hint and base
    confidence; each repeat adds 0.1, capped at 1.0, rounded to 4 dp.
    """
    k = _keys(key)
    keys = [*k, "_ks", "_ki"]
    r = clean_rules(raw).withColumn("_ks", F.lower("stt_output")).withColumn("_ki", F.lower("intended"))
    first = _first_seen(r, keys, _order(r))
    n = r.groupBy(*[F.col(c).alias(f"n{c}") for c in keys]).agg(F.count(F.lit(1)).alias("repeats"))
    conf = F.round(F.least(F.lit(1.0), freq_to_confidence("frequency") + F.lit(0.1) * (F.col("repeats") - 1)), 4)
    return first.join(n, _same_keys(keys)).select(
        *k, "stt_output", "intended", conf.alias("confidence"), F.lit(1).alias("occurrences"),
        F.lit(SOURCE_LLM).alias("source"), F.col("explanation").alias("context_hint"),
        *[F.col(c).alias(f"first_{c}") for c in _order(r)])


def rules_by_confidence(rules: DataFrame) -> DataFrame:
    """O3: confidence descending, first-seen order among ties."""
    return rules.orderBy(F.col("confidence").desc(), *[F.col(f"first_{c}").asc() for c in ("seq", "pos") if f"first_{c}" in rules.columns])


# ------------------------------------------------------------------ A14
def dedupe_vocab(raw: DataFrame, key: Sequence[str] | str = ("username",)) -> DataFrame:
    """One entry per ``lower(term)`` per key.

    The first row supplies term, category (``general`` when missing) and
    definition.  Aliases are merged in arrival order, case-insensitively
    new only (the first row's own list is de-duplicated as well, a
    deliberate tightening).
    """
    k = _keys(key)
    v = clean_vocab(raw).withColumn("_kt", F.lower("term"))
    order = _order(v)
    aliases = v.select(*k, "_kt", *order, F.posexplode("misheard_as").alias("_place", "alias")) \
        .where(F.col("alias").isNotNull()).withColumn("_ka", F.lower("alias"))
    heard = _first_seen(aliases, [*k, "_kt", "_ka"], [*order, "_place"]).groupBy(*[F.col(c).alias(f"n{c}") for c in [*k, "_kt"]]).agg(
        F.transform(F.array_sort(F.collect_list(F.struct(*order, "_place", "alias"))), lambda s: s["alias"]).alias("aliases"))
    return _first_seen(v, [*k, "_kt"], order).join(heard, _same_keys([*k, "_kt"]), "left").select(
        *k, "term", F.coalesce("category", F.lit("general")).alias("category"), "definition",
        F.coalesce("aliases", F.array().cast("array<string>")).alias("aliases"), *[F.col(c).alias(f"first_{c}") for c in order])


def alias_top3(vocab: DataFrame) -> DataFrame:
    """The first three aliases of each term."""
    return vocab.withColumn("aliases", F.slice("aliases", 1, 3))


# ------------------------------------------------------------------ S11 / A16
def latest_mapping(log: DataFrame, key: str = "username", value: str = "speaker_id",
                   ts: str = "updated_at", tie: str = "seq") -> DataFrame:
    """Username -> speaker id, last write wins (ties by ``tie``)."""
    latest = first_rows(log, [key], ts, largest=True)
    return first_rows(latest, [key], tie, largest=True).select(key, value, ts)


def list_users(mapping: DataFrame, key: str = "username") -> DataFrame:
    """Distinct usernames, sorted."""
    return mapping.select(key).distinct().orderBy(key)


# ------------------------------------------------------------------ profiles (S10 shape)
RULE_TYPE = T.StructType([
    T.StructField("id", T.StringType()), T.StructField("stt_output", T.StringType()),
    T.StructField("intended", T.StringType()), T.StructField("occurrences", T.IntegerType()),
    T.StructField("confidence", T.DoubleType()), T.StructField("source", T.StringType()),
    T.StructField("context_hint", T.StringType()), T.StructField("created_at", T.TimestampType()),
    T.StructField("last_seen", T.TimestampType()),
])
VOCAB_TYPE = T.StructType([
    T.StructField("term", T.StringType()), T.StructField("category", T.StringType()),
    T.StructField("definition", T.StringType()), T.StructField("aliases", T.ArrayType(T.StringType())),
    T.StructField("added_at", T.TimestampType()),
])
STYLE_TYPE = T.StructType([
    T.StructField("formality", T.StringType()), T.StructField("remove_fillers", T.BooleanType()),
    T.StructField("filler_words", T.ArrayType(T.StringType())), T.StructField("languages", T.ArrayType(T.StringType())),
    T.StructField("common_phrases", T.ArrayType(T.StringType())), T.StructField("preferred_spelling", T.StringType()),
    T.StructField("notes", T.StringType()),
])
PROFILE_SCHEMA = T.StructType([
    T.StructField("speaker_id", T.StringType()), T.StructField("name", T.StringType()),
    T.StructField("domain", T.StringType()), T.StructField("topics", T.ArrayType(T.StringType())),
    T.StructField("vocabulary", T.ArrayType(VOCAB_TYPE)), T.StructField("corrections", T.ArrayType(RULE_TYPE)),
    T.StructField("style", STYLE_TYPE), T.StructField("created_at", T.TimestampType()),
    T.StructField("updated_at", T.TimestampType()),
])


def _lit_array(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def with_style_defaults(info: DataFrame) -> DataFrame:
    """speaker-info fields with profile defaults filled in.

    Unknown or missing formality -> professional; domain -> general;
    languages -> [en]; spelling -> en-US; fillers on with the default list.
    """
    f = F.lower(F.col("formality"))
    return info.select(
        "*",
        F.when(f.isin(FORMALITIES), f).otherwise(F.lit(DEFAULT_FORMALITY)).alias("style_formality"),
        F.coalesce("domain", F.lit(DEFAULT_DOMAIN)).alias("style_domain"),
        F.coalesce("languages", _lit_array(DEFAULT_LANGUAGES)).alias("style_languages"),
        F.coalesce("preferred_spelling", F.lit(DEFAULT_SPELLING)).alias("style_spelling"),
        F.lit(True).alias("style_remove_fillers"),
        _lit_array(DEFAULT_FILLERS).alias("style_filler_words"),
    )


def build_profiles(mapping: DataFrame, rules: DataFrame, vocab: DataFrame, info: DataFrame,
                   key: str = "username") -> DataFrame:
    """Assemble one profile document per mapped speaker (S10 shape).

    ``rules``/``vocab`` are already de-duplicated (A13/A14), so the arrays
    collected per user are bounded by that user's distinct rules.
    """
    r = rules.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(
        (-F.col("confidence")).alias("_o1"), F.struct(*_order(rules, "first_")).alias("_o2"),
        F.struct(F.concat(F.lit("r"), F.concat_ws("-", *[F.col(c).cast("string") for c in _order(rules, "first_")])).alias("id"),
                 "stt_output", "intended",
                 F.col("occurrences").cast("int").alias("occurrences"), "confidence", "source", "context_hint",
                 F.lit(None).cast("timestamp").alias("created_at"),
                 F.lit(None).cast("timestamp").alias("last_seen")).alias("rule")))).alias("_r"))
    v = vocab.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(
        F.struct(*_order(vocab, "first_")).alias("_o"),
        F.struct("term", "category", "definition", "aliases",
                 F.lit(None).cast("timestamp").alias("added_at")).alias("entry")))).alias("_v"))
    styled = with_style_defaults(info)
    prof = (mapping.join(styled, key, "left").join(r, key, "left").join(v, key, "left"))
    return prof.select(
        F.col("speaker_id"),
        F.col(key).alias("name"),
        F.col("style_domain").alias("domain"),
        F.coalesce("topics", F.array().cast("array<string>")).alias("topics"),
        F.coalesce(F.transform("_v", lambda s: s["entry"]), F.array().cast(T.ArrayType(VOCAB_TYPE))).alias("vocabulary"),
        F.coalesce(F.transform("_r", lambda s: s["rule"]), F.array().cast(T.ArrayType(RULE_TYPE))).alias("corrections"),
        F.struct(F.col("style_formality").alias("formality"), F.col("style_remove_fillers").alias("remove_fillers"),
                 F.col("style_filler_words").alias("filler_words"), F.col("style_languages").alias("languages"),
                 F.array().cast("array<string>").alias("common_phrases"),
                 F.col("style_spelling").alias("preferred_spelling"), F.col("notes").alias("notes")).alias("style"),
        F.col("updated_at").alias("created_at"),
        F.col("updated_at").alias("updated_at"),
    )


# ------------------------------------------------------------------ A15 / J2
def summarise_profiles(profiles: DataFrame) -> DataFrame:
    """Counts of stored profile documents, as ``kb_status`` takes them."""
    return profiles.select("speaker_id", "name", "domain", "topics",
                           F.size("corrections").cast("long").alias("n_corrections"),
                           F.size("vocabulary").cast("long").alias("n_vocabulary"))


def profile_summaries(mapping: DataFrame, rules: DataFrame, vocab: DataFrame, info: DataFrame,
                      key: str = "username") -> DataFrame:
    """The same counts from the de-duplicated tables, without building documents."""
    r = rules.groupBy(key).agg(F.count(F.lit(1)).alias("n_corrections"))
    v = vocab.groupBy(key).agg(F.count(F.lit(1)).alias("n_vocabulary"))
    return mapping.join(info.select(key, "domain", "topics"), key, "left").join(r, key, "left").join(v, key, "left").select(
        "speaker_id", F.col(key).alias("name"), F.coalesce("domain", F.lit(DEFAULT_DOMAIN)).alias("domain"),
        F.coalesce("topics", F.array().cast("array<string>")).alias("topics"),
        F.coalesce("n_corrections", F.lit(0)).alias("n_corrections"),
        F.coalesce("n_vocabulary", F.lit(0)).alias("n_vocabulary"))


def kb_status(usernames: DataFrame, mapping: DataFrame, summaries: DataFrame, key: str = "username") -> DataFrame:
    """Per username: exists, speaker id, domain, rule/vocabulary counts,
    topics; a user without mapping or profile gets exists=false, zeros."""
    prof = summaries.select(F.col("speaker_id").alias("_sid"), "domain", "topics", "n_corrections", "n_vocabulary")
    j = usernames.select(key).join(mapping.select(key, "speaker_id"), key, "left") \
        .join(prof, F.col("speaker_id") == F.col("_sid"), "left")
    exists = F.col("_sid").isNotNull()
    return j.select(
        key, exists.alias("exists"),
        F.when(exists, F.col("speaker_id")).alias("speaker_id"),
        F.when(exists, F.col("domain")).alias("domain"),
        F.coalesce("n_corrections", F.lit(0)).alias("n_corrections"),
        F.coalesce("n_vocabulary", F.lit(0)).alias("n_vocabulary"),
        F.coalesce("topics", F.array().cast("array<string>")).alias("topics"),
    )


def attach_profile(requests: DataFrame, mapping: DataFrame, profiles: DataFrame, key: str = "username") -> DataFrame:
    """Request -> mapping -> profile by two left equi-joins; ``used_kb``
    is true only when both hops resolve.  AQE picks broadcast when the
    mapping/profile side is small and splits skewed user keys otherwise."""
    prof = profiles.withColumnRenamed("speaker_id", "_sid")
    j = requests.join(mapping.select(key, "speaker_id"), key, "left") \
        .join(prof, F.col("speaker_id") == F.col("_sid"), "left")
    return j.withColumn("used_kb", F.col("_sid").isNotNull()).drop("_sid")


# ------------------------------------------------------------------ J3
def apply_rules(texts: DataFrame, rules: DataFrame, text_col: str = "model_output",
                key: str = "username", out_col: str = "corrected", partitions: int | None = None) -> DataFrame:
    """Apply a speaker's rules to raw text, highest confidence first.

    One semantics for all rules: they run one after the other (confidence
    descending, then first seen), each on what the earlier ones left, so
    replacements chain.  A rule replaces its phrase, in any letter case,
    where it stands between whitespace or the text's ends; blanks inside a
    phrase match any whitespace; a blank phrase matches nothing.  A user's
    rules are one token trie, built once per task (``rule_matching.py``).
    """
    from vocalis.operators.rule_matching import apply_tries
    return apply_tries(spread(texts, partitions), rules, text_col, key, out_col)


def profile_rules(profiles: DataFrame, key: str = "name") -> DataFrame:
    """The stored corrections of profile documents as a rule table for ``apply_rules``."""
    return profiles.select(F.col(key).alias("username"), F.posexplode("corrections").alias("first_seq", "r")).select(
        "username", F.col("r.stt_output").alias("stt_output"), F.col("r.intended").alias("intended"),
        F.col("r.confidence").alias("confidence"), "first_seq")


# ------------------------------------------------------------------ F15
def render_rules(profiles: DataFrame) -> DataFrame:
    """Markdown rule table (confidence descending, stored order among
    ties) and vocabulary lines with at most three aliases; ``(none)`` when
    empty."""
    ordered = F.transform(F.array_sort(F.transform("corrections", lambda r, i: F.struct(
        (-F.coalesce(r["confidence"], F.lit(0.0))).alias("o"), i.alias("i"), r.alias("r")))), lambda s: s["r"])
    rows = F.transform(ordered, lambda r: F.concat(F.lit("| "), r["stt_output"], F.lit(" | "),
                                                         r["intended"], F.lit(" |")))
    table = F.when(F.size("corrections") > 0, F.concat(F.lit(RULE_TABLE_HEAD),
                                                      F.array_join(rows, "\n"))).otherwise(F.lit(NOTHING))

    def vline(e):
        al = F.array_join(F.slice(F.coalesce(e["aliases"], F.array().cast("array<string>")), 1, 3), ", ")
        return F.concat(F.lit("- **"), e["term"], F.lit("**"),
                        F.when(al != "", F.concat(F.lit(ALIASES_OPEN), al, F.lit(ALIASES_CLOSE))).otherwise(F.lit("")))
    vocab = F.when(F.size("vocabulary") > 0, F.array_join(F.transform("vocabulary", vline), "\n")).otherwise(F.lit(NOTHING))
    return profiles.select(F.col("name").alias("username"), "speaker_id",
                           F.col("style.preferred_spelling").alias("spelling"),
                           table.alias("corrections_table"), vocab.alias("vocabulary_list"))


# ------------------------------------------------------------------ F8
EXTRACTION_SCHEMA = T.StructType([
    T.StructField("speaker_info", T.StructType([
        T.StructField("domain", T.StringType()), T.StructField("topics", T.ArrayType(T.StringType())),
        T.StructField("formality", T.StringType()), T.StructField("languages", T.ArrayType(T.StringType())),
        T.StructField("preferred_spelling", T.StringType()), T.StructField("style_notes", T.StringType())])),
    T.StructField("corrections", T.ArrayType(T.StructType([
        T.StructField("stt_output", T.StringType()), T.StructField("intended", T.StringType()),
        T.StructField("frequency", T.StringType()), T.StructField("explanation", T.StringType())]))),
    T.StructField("vocabulary", T.ArrayType(T.StructType([
        T.StructField("term", T.StringType()), T.StructField("category", T.StringType()),
        T.StructField("definition", T.StringType()), T.StructField("misheard_as", T.ArrayType(T.StringType()))]))),
])


def parse_extraction(df: DataFrame, col: str = "response") -> DataFrame:
    """F8: parse an extraction response (fences stripped first).  A response
    that is not a JSON object marks the batch as skipped (``parsed`` false);
    missing lists become empty arrays."""
    from vocalis.functions.text import strip_fences
    txt = strip_fences(col)
    parsed = F.from_json(txt, EXTRACTION_SCHEMA, {"mode": "PERMISSIVE"})
    ok = F.coalesce(F.ltrim(txt).startswith("{") & F.get_json_object(txt, "$").isNotNull(), F.lit(False))
    out = df.withColumn("_p", F.when(ok, parsed)).withColumn("parsed", ok)
    return out.select(
        "*",
        F.col("_p.speaker_info").alias("speaker_info"),
        F.coalesce("_p.corrections", F.array().cast(EXTRACTION_SCHEMA["corrections"].dataType)).alias("corrections"),
        F.coalesce("_p.vocabulary", F.array().cast(EXTRACTION_SCHEMA["vocabulary"].dataType)).alias("vocabulary"),
    ).drop("_p")


# ------------------------------------------------------------------ U2
def merge_batches(batches: DataFrame, key: Sequence[str] | str = ("username",), batch: str = "batch_no") -> DataFrame:
    """Speaker info of the last batch that has any, per key (rule and
    vocabulary lists: ``batch_rules``, ``batch_vocab``)."""
    k = _keys(key)
    has = F.when(F.col("speaker_info").isNotNull(), F.col(batch))
    counts = batches.groupBy(*k).agg(F.max(has).alias("_info"), F.max(batch).alias("last_batch"),
                                     F.count(F.lit(1)).alias("batches"))
    info = batches.where(F.col("speaker_info").isNotNull()).select(
        *k, F.col(batch).alias("_info"), "speaker_info")
    return counts.join(info, [*k, "_info"], "left").select(*k, "speaker_info", "last_batch", "batches")


def _batch_items(batches: DataFrame, items: str, key: Sequence[str] | str, batch: str) -> DataFrame:
    k = _keys(key)
    return batches.select(*k, F.col(batch).cast("long").alias("seq"), F.posexplode(items).alias("pos", "_item")).select(
        *k, "seq", "pos", "_item.*")


def batch_rules(batches: DataFrame, key: Sequence[str] | str = ("username",), batch: str = "batch_no") -> DataFrame:
    """The rules of all batches in batch order, as ``dedupe_rules`` takes them."""
    return _batch_items(batches, "corrections", key, batch)


def batch_vocab(batches: DataFrame, key: Sequence[str] | str = ("username",), batch: str = "batch_no") -> DataFrame:
    """The vocabulary of all batches in batch order, as ``dedupe_vocab`` takes it."""
    return _batch_items(batches, "vocabulary", key, batch)


# ------------------------------------------------------------------ A19
def upsert_rules(old: DataFrame, new: DataFrame, key: Sequence[str] | str = ("username",)) -> DataFrame:
    """Fold new sightings of rules into the stored rules.

    Same key as A13 (lower stt -> lower intended).  The stored row wins for
    text and hint (else the earliest new sighting, by ``created_at`` then
    ``seq``); ``occurrences`` sums; ``last_seen`` is the latest;
    confidence grows 0.1 per new sighting beyond the row that supplied it,
    capped at 1.0; a rule that only exists in the new sightings is
    ``auto_feedback``, otherwise the stored source is kept.
    """
    k = _keys(key)
    both = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    keys = [*k, "_ks", "_ki"]
    both = both.withColumn("_ks", F.lower("stt_output")).withColumn("_ki", F.lower("intended")) \
        .withColumn("_at", F.coalesce("created_at", F.lit(0).cast("timestamp").cast(both.schema["created_at"].dataType)))
    first = both
    for order in ("_new", "_at", "seq"):  # stored before new, then the earliest
        first = first_rows(first, keys, order)
    sums = both.groupBy(*[F.col(c).alias(f"n{c}") for c in keys]).agg(
        F.sum("occurrences").alias("_occurrences"), F.max("last_seen").alias("_last_seen"),
        F.sum("_new").alias("_n_new"), (F.min("_new") == 0).alias("_has_old"))
    g = first.join(sums, _same_keys(keys))
    extra = F.when(F.col("_has_old"), F.col("_n_new")).otherwise(F.col("_n_new") - 1)
    conf = F.round(F.least(F.lit(1.0), F.col("confidence") + F.lit(0.1) * extra), 4)
    src = F.when(F.col("_has_old"), F.col("source")).otherwise(F.lit(SOURCE_FEEDBACK))
    return g.select(*k, "stt_output", "intended", F.col("_occurrences").cast("int").alias("occurrences"),
                    conf.alias("confidence"), src.alias("source"), "context_hint", "created_at",
                    F.col("_last_seen").alias("last_seen"))


# ------------------------------------------------------------------ G1
GRADE_HIGH, GRADE_MEDIUM = 5, 2


def grade(count: Column) -> Column:
    """Frequency grade of a mined substitution (our thresholds)."""
    return F.when(count >= GRADE_HIGH, F.lit("high")).when(count >= GRADE_MEDIUM, F.lit("medium")).otherwise(F.lit("low"))


def mine_corrections(pairs: DataFrame, min_count: int = 1, key: str = "username", ref: str = "correct_transcription",
                     hyp: str = "model_output", partitions: int | None = None) -> DataFrame:
    """G1: recurring corrections per user, graded by count, in the
    extraction ``corrections`` shape so they feed ``dedupe_rules``.

    A correction is a phrase pair: runs of changed words of the F3 alignment,
    cut so that words split, joined or misheard together stay together.
    ``context_hint`` shows it between the words around it (of several
    occurrences the smallest one).
    """
    from vocalis.operators.alignment import phrase_pairs
    t = pairs.select(key, tokenize(ref).alias("_r"), tokenize(hyp).alias("_h"))
    g = phrase_pairs(t, key, partitions).groupBy(key, "stt_output", "intended").agg(
        F.sum("n").alias("n"), F.min("hint").alias("context_hint")).filter(F.col("n") >= min_count)
    return g.select(key, "stt_output", "intended", grade(F.col("n")).alias("frequency"), F.col("n").alias("count"),
                    F.concat(F.lit("seen "), F.col("n").cast("string"), F.lit(" times")).alias("explanation"), "context_hint")
