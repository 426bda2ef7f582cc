"""Catalogue: knowledge-base tables (A13-A16, A19, F8, F14, F15, G1, J2, J3,
O3, O4, P9, S9-S11, U1, U2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from vocalis.functions.formatting import freq_to_confidence
from vocalis.operators import kb as K
from vocalis.plans import clips as C
from vocalis.plans import fixtures as X
from vocalis.plans.catalog import register, with_cte
from vocalis.plans.text_queries import duck_strip, duck_tokens

_DCONF = ("CASE {f} WHEN 'high' THEN 0.9::double WHEN 'medium' THEN 0.7::double WHEN 'low' THEN 0.5::double "
          "ELSE 0.7::double END")

# ------------------------------------------------------------------ SQL twins of the building blocks
DEDUPE_RULES_SQL = f"""SELECT username, stt_output, intended,
    round(least(1.0::double, {_DCONF.format(f='frequency')} + 0.1::double * (repeats - 1)), 4) AS confidence,
    1 AS occurrences, 'llm_suggested' AS source, context_hint, first_seq
  FROM (SELECT username, stt_output, intended, frequency, explanation AS context_hint, seq AS first_seq,
          count(*) OVER (PARTITION BY username, lower(stt_output), lower(intended)) AS repeats,
          row_number() OVER (PARTITION BY username, lower(stt_output), lower(intended) ORDER BY seq) AS rn
        FROM (SELECT username, seq, {duck_strip('stt_output')} AS stt_output, {duck_strip('intended')} AS intended,
                     frequency, explanation FROM rules_raw)
        WHERE stt_output <> '' AND intended <> '')
  WHERE rn = 1"""

_VOCAB_CLEAN = (f"SELECT username, seq, {duck_strip('term')} AS term, lower({duck_strip('term')}) AS kt, "
                "coalesce(category, 'general') AS category, definition, misheard_as FROM vocab_raw "
                f"WHERE {duck_strip('term')} <> ''")

DEDUPE_VOCAB_SQL = f"""SELECT f.username, f.term, f.category, f.definition,
    coalesce(a.aliases, []::VARCHAR[]) AS aliases, f.first_seq
  FROM (SELECT username, kt, term, category, definition, seq AS first_seq
        FROM (SELECT *, row_number() OVER (PARTITION BY username, kt ORDER BY seq) AS rn FROM ({_VOCAB_CLEAN})) WHERE rn = 1) f
  LEFT JOIN (SELECT username, kt, list(alias ORDER BY seq, pos) AS aliases
             FROM (SELECT *, row_number() OVER (PARTITION BY username, kt, lower(alias) ORDER BY seq, pos) AS rn
                   FROM (SELECT username, kt, seq, unnest(misheard_as) AS alias, unnest(range(len(misheard_as))) AS pos
                         FROM ({_VOCAB_CLEAN})) WHERE alias IS NOT NULL)
             WHERE rn = 1 GROUP BY username, kt) a USING (username, kt)"""

LATEST_MAPPING_SQL = """SELECT username, speaker_id, updated_at FROM (
    SELECT *, row_number() OVER (PARTITION BY username ORDER BY updated_at DESC, seq DESC) AS rn FROM mapping_log)
  WHERE rn = 1"""

def _profile_counts_sql(gaps: bool) -> str:
    """One row per profile with its counts; ``gaps``: without the missing profile and with an empty one."""
    empty = f"m.username = '{X.EMPTY_PROFILE_USER}'" if gaps else "false"
    where = f"WHERE m.username <> '{X.MISSING_PROFILE_USER}'" if gaps else ""
    return f"""SELECT m.username AS name, m.speaker_id, coalesce(i.domain, 'general') AS domain,
    coalesce(i.topics, []::VARCHAR[]) AS topics,
    CASE WHEN {empty} THEN 0 ELSE (SELECT count(*) FROM rules r WHERE r.username = m.username) END AS n_corrections,
    CASE WHEN {empty} THEN 0 ELSE (SELECT count(*) FROM vocab v WHERE v.username = m.username) END AS n_vocabulary,
    coalesce(i.preferred_spelling, 'en-US') AS spelling
  FROM latest m LEFT JOIN info i USING (username) {where}"""


_UNMAPPED_SQL = ", ".join(f"'{u}'" for u in X.UNMAPPED_USERS)


def _kb_ctes(gaps: bool = False, **extra: str) -> dict[str, str]:
    mapped = f" AND username NOT IN ({_UNMAPPED_SQL})" if gaps else ""
    base = dict(rules_raw=X.RULES_RAW_SQL, vocab_raw=X.VOCAB_RAW_SQL, mapping_log=X.MAPPING_LOG_SQL,
                rules=DEDUPE_RULES_SQL, vocab=DEDUPE_VOCAB_SQL, latest=LATEST_MAPPING_SQL + mapped,
                info=X.SPEAKER_INFO_SQL, profiles=_profile_counts_sql(gaps))
    base.update(extra)
    return base


# ------------------------------------------------------------------ Spark building blocks
def _rules(spark, sf_dir):
    return K.dedupe_rules(X.rules_raw(spark, sf_dir))


def _vocab(spark, sf_dir):
    return K.dedupe_vocab(X.vocab_raw(spark, sf_dir))


def _mapping(spark, sf_dir):
    return K.latest_mapping(X.mapping_log(spark, sf_dir))


def profiles(spark, sf_dir):
    """Profile documents built from the de-duplicated tables (S10 shape)."""
    return K.build_profiles(_mapping(spark, sf_dir), _rules(spark, sf_dir), _vocab(spark, sf_dir),
                            X.speaker_info(spark, sf_dir))


def _with_gaps(spark, sf_dir):
    """Mapping and profile counts of the lookup queries: some users have no mapping, one has no profile."""
    mapping = _mapping(spark, sf_dir).filter(~F.col("username").isin(X.UNMAPPED_USERS))
    counts = K.profile_summaries(
        mapping.filter(F.col("username") != X.MISSING_PROFILE_USER),
        _rules(spark, sf_dir).filter(F.col("username") != X.EMPTY_PROFILE_USER),
        _vocab(spark, sf_dir).filter(F.col("username") != X.EMPTY_PROFILE_USER), X.speaker_info(spark, sf_dir))
    return mapping, counts


# ------------------------------------------------------------------ A13 / O3 / P9
@register("dedupe_rules", with_cte("SELECT * FROM rules", rules_raw=X.RULES_RAW_SQL, rules=DEDUPE_RULES_SQL))
def q_dedupe_rules(spark, sf_dir):
    return _rules(spark, sf_dir)


@register("rules_by_confidence", with_cte(
    "SELECT username, stt_output, intended, confidence, first_seq FROM rules "
    "ORDER BY confidence DESC, first_seq", rules_raw=X.RULES_RAW_SQL, rules=DEDUPE_RULES_SQL))
def q_rules_by_confidence(spark, sf_dir):
    return K.rules_by_confidence(_rules(spark, sf_dir)).select(
        "username", "stt_output", "intended", "confidence", "first_seq")


@register("nonempty_rules", with_cte(
    f"SELECT seq, {duck_strip('stt_output')} AS stt_output, {duck_strip('intended')} AS intended FROM rules_raw "
    f"WHERE {duck_strip('stt_output')} <> '' AND {duck_strip('intended')} <> ''", rules_raw=X.RULES_RAW_SQL))
def q_nonempty_rules(spark, sf_dir):
    return K.clean_rules(X.rules_raw(spark, sf_dir)).select("seq", "stt_output", "intended")


# ------------------------------------------------------------------ A14 / O4
@register("dedupe_vocab", with_cte("SELECT * FROM vocab", vocab_raw=X.VOCAB_RAW_SQL, vocab=DEDUPE_VOCAB_SQL))
def q_dedupe_vocab(spark, sf_dir):
    return _vocab(spark, sf_dir)


@register("alias_top3", with_cte("SELECT username, term, aliases[1:3] AS aliases FROM vocab",
                                 vocab_raw=X.VOCAB_RAW_SQL, vocab=DEDUPE_VOCAB_SQL))
def q_alias_top3(spark, sf_dir):
    return K.alias_top3(_vocab(spark, sf_dir)).select("username", "term", "aliases")


# ------------------------------------------------------------------ S11 / A16
@register("user_mapping", with_cte("SELECT * FROM latest", mapping_log=X.MAPPING_LOG_SQL, latest=LATEST_MAPPING_SQL))
def q_user_mapping(spark, sf_dir):
    return _mapping(spark, sf_dir)


@register("list_users", with_cte("SELECT DISTINCT username FROM mapping_log ORDER BY username",
                                 mapping_log=X.MAPPING_LOG_SQL))
def q_list_users(spark, sf_dir):
    return K.list_users(X.mapping_log(spark, sf_dir))


# ------------------------------------------------------------------ A15
@register("kb_status", with_cte(
    "SELECT u.username, p.speaker_id IS NOT NULL AS exists, p.speaker_id, p.domain, "
    "coalesce(p.n_corrections, 0) AS n_corrections, coalesce(p.n_vocabulary, 0) AS n_vocabulary, "
    "coalesce(p.topics, []::VARCHAR[]) AS topics "
    "FROM (SELECT DISTINCT username FROM rules_raw) u LEFT JOIN latest m USING (username) "
    "LEFT JOIN profiles p ON p.speaker_id = m.speaker_id", **_kb_ctes(gaps=True)))
def q_kb_status(spark, sf_dir):
    users = X.rules_raw(spark, sf_dir).select("username").distinct()
    return K.kb_status(users, *_with_gaps(spark, sf_dir))


# ------------------------------------------------------------------ J2
@register("profile_lookup", with_cte(
    "SELECT q.pair_id, q.username, p.speaker_id, p.speaker_id IS NOT NULL AS used_kb, "
    "coalesce(p.n_corrections, 0) AS n_rules FROM pairs q LEFT JOIN latest m USING (username) "
    "LEFT JOIN profiles p ON p.speaker_id = m.speaker_id", **_kb_ctes(gaps=True, pairs=X.PAIRS_SQL)))
def q_profile_lookup(spark, sf_dir):
    req = X.pairs(spark, sf_dir).select("pair_id", "username")
    j = K.attach_profile(req, *_with_gaps(spark, sf_dir))
    return j.select("pair_id", "username", F.when(F.col("used_kb"), F.col("speaker_id")).alias("speaker_id"),
                    "used_kb", F.coalesce("n_corrections", F.lit(0)).cast("bigint").alias("n_rules"))


# ------------------------------------------------------------------ F15 / F14 / S10
@register("render_rules", with_cte(
    "SELECT p.name AS username, p.speaker_id, p.spelling, "
    f"CASE WHEN p.n_corrections = 0 THEN '{K.NOTHING}' ELSE concat('{K.RULE_TABLE_HEAD}', "
    "(SELECT string_agg(concat('| ', r.stt_output, ' | ', r.intended, ' |'), chr(10) ORDER BY r.confidence DESC, r.first_seq) "
    " FROM rules r WHERE r.username = p.name)) END AS corrections_table, "
    f"CASE WHEN p.n_vocabulary = 0 THEN '{K.NOTHING}' ELSE (SELECT string_agg(concat('- **', v.term, '**', "
    f"CASE WHEN array_to_string(v.aliases[1:3], ', ') <> '' THEN concat('{K.ALIASES_OPEN}', array_to_string(v.aliases[1:3], ', '), '{K.ALIASES_CLOSE}') "
    "ELSE '' END), chr(10) ORDER BY v.first_seq) FROM vocab v WHERE v.username = p.name) END AS vocabulary_list "
    "FROM profiles p", **_kb_ctes()))
def q_render_rules(spark, sf_dir):
    return K.render_rules(profiles(spark, sf_dir))


@register("style_defaults", with_cte(
    "SELECT username, CASE WHEN lower(formality) IN ('casual', 'professional', 'academic', 'mixed') THEN lower(formality) "
    "ELSE 'professional' END AS formality, coalesce(domain, 'general') AS domain, "
    "coalesce(languages, ['en']) AS languages, coalesce(preferred_spelling, 'en-US') AS preferred_spelling, "
    "true AS remove_fillers, ['um', 'uh', 'like', 'you know'] AS filler_words FROM info",
    mapping_log=X.MAPPING_LOG_SQL, info=X.SPEAKER_INFO_SQL))
def q_style_defaults(spark, sf_dir):
    s = K.with_style_defaults(X.speaker_info(spark, sf_dir))
    return s.select("username", F.col("style_formality").alias("formality"), F.col("style_domain").alias("domain"),
                    F.col("style_languages").alias("languages"), F.col("style_spelling").alias("preferred_spelling"),
                    F.col("style_remove_fillers").alias("remove_fillers"),
                    F.col("style_filler_words").alias("filler_words"))


@register("read_profiles", with_cte(
    "SELECT speaker_id, name, domain, n_corrections, n_vocabulary FROM profiles", **_kb_ctes()))
def q_read_profiles(spark, sf_dir):
    """S10 round trip: write the profile documents as JSON, read them back
    with the explicit profile schema."""
    from vocalis.session import scratch_path
    from vocalis.sources.profiles import read_profiles, write_profiles
    path = scratch_path(spark, "profiles")
    write_profiles(profiles(spark, sf_dir), path)
    back = read_profiles(spark, path)
    return back.select("speaker_id", "name", "domain",
                       F.size("corrections").cast("bigint").alias("n_corrections"),
                       F.size("vocabulary").cast("bigint").alias("n_vocabulary"))


def _kept(spark, df, name: str):
    """``df`` written to the shared folder once and read back, for jobs that use it in many places."""
    from vocalis.session import scratch_path
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


_UPSERT_AT = "TIMESTAMP '2030-01-01 00:00:00'"


@register("upsert_profiles", with_cte(
    "SELECT speaker_id, name, CASE WHEN u % 3 = 0 THEN 'updated' ELSE domain END AS domain, n_corrections, n_vocabulary, "
    "u % 3 = 0 AS refreshed FROM numbered UNION ALL SELECT concat('new-', speaker_id), name, domain, n_corrections, n_vocabulary, true "
    "FROM numbered WHERE u % 5 = 0", **_kb_ctes(numbered="SELECT *, CAST(substr(name, 6) AS INTEGER) AS u FROM profiles")))
def q_upsert_profiles(spark, sf_dir):
    """Some stored documents changed, some new ones, upserted into the bucketed store; a second time changes nothing."""
    from vocalis.session import scratch_path
    from vocalis.sources.profiles import read_profile_store, upsert_profile_store, write_profile_store
    path = scratch_path(spark, "profile-store")
    number = F.substring("name", 6, 9).cast("int")
    stored = _kept(spark, profiles(spark, sf_dir), "profiles-built")
    write_profile_store(stored, path)
    new = stored.where(number % 3 == 0).withColumn("domain", F.lit("updated")) \
        .unionByName(stored.where(number % 5 == 0).withColumn("speaker_id", F.concat(F.lit("new-"), "speaker_id")))
    for _ in range(2):
        upsert_profile_store(spark, path, new, F.expr(_UPSERT_AT))
    return read_profile_store(spark, path).select(
        "speaker_id", "name", "domain", F.size("corrections").cast("bigint").alias("n_corrections"),
        F.size("vocabulary").cast("bigint").alias("n_vocabulary"), (F.col("updated_at") == F.expr(_UPSERT_AT)).alias("refreshed"))


# ------------------------------------------------------------------ J3
# the rules one after the other on text whose blanks are doubled, so that every word has its own
@register("apply_rules", with_cte(
    """SELECT text_id, username, model_output, replace(trim(s), '  ', ' ') AS corrected
       FROM done WHERE k = coalesce((SELECT max(k) FROM ordered o WHERE o.username = done.username), 0)""",
    rules_raw=X.RULES_RAW_SQL, rules=DEDUPE_RULES_SQL, texts=X.RULE_TEXTS_SQL, phrases=X.PHRASE_RULES_SQL,
    ordered="SELECT username, stt_output, intended, row_number() OVER (PARTITION BY username ORDER BY confidence DESC, first_seq) AS k "
            "FROM (SELECT username, stt_output, intended, confidence, first_seq FROM rules UNION ALL SELECT * FROM phrases)",
    done="SELECT text_id, username, model_output, concat(' ', replace(model_output, ' ', '  '), ' ') AS s, 0::BIGINT AS k FROM texts "
         "UNION ALL SELECT text_id, d.username, model_output, regexp_replace(s, concat('(?i) ', replace(stt_output, ' ', '  '), ' '), "
         "concat(' ', replace(intended, ' ', '  '), ' '), 'g'), o.k FROM done d JOIN ordered o ON d.username = o.username AND o.k = d.k + 1"
).replace("WITH ", "WITH RECURSIVE ", 1))
def q_apply_rules(spark, sf_dir):
    """One-word rules as mined, and rules over several words that chain with them."""
    rules = _rules(spark, sf_dir).select("username", "stt_output", "intended", "confidence", "first_seq") \
        .unionByName(X.phrase_rules(spark, sf_dir))
    return K.apply_rules(X.rule_texts(spark, sf_dir), rules, partitions=C.partitions(spark)).select("text_id", "username", "model_output", "corrected")


# ------------------------------------------------------------------ G1
@register("mine_corrections", with_cte(
    "SELECT username, wrong AS stt_output, right_ AS intended, CASE WHEN n >= 5 THEN 'high' WHEN n >= 2 THEN 'medium' "
    "ELSE 'low' END AS frequency, n AS count, concat('seen ', cast(n AS varchar), ' times') AS explanation, hint AS context_hint "
    "FROM (SELECT username, wrong, right_, count(*) AS n, min(concat('...', before_, ' [', wrong, ' → ', right_, '] ', after_, '...')) AS hint "
    "FROM changes GROUP BY username, wrong, right_)", changes=X.SPLIT_CHANGES_SQL))
def q_mine_corrections(spark, sf_dir):
    return K.mine_corrections(X.split_pairs(spark, sf_dir), partitions=C.partitions(spark))


# ------------------------------------------------------------------ A19
_STORED_SQL = f"""SELECT username, stt_output, intended, {_DCONF.format(f='frequency')} AS confidence,
    'llm_suggested' AS source, explanation AS context_hint, occurrences, created_at, last_seen, seq
  FROM (SELECT *, count(*) OVER w AS occurrences, min(ts) OVER w AS created_at, max(ts) OVER w AS last_seen,
               row_number() OVER (PARTITION BY username, lower(stt_output), lower(intended) ORDER BY seq) AS rn
        FROM (SELECT username, seq, {duck_strip('stt_output')} AS stt_output, {duck_strip('intended')} AS intended,
                     frequency, explanation, ts FROM rules_raw WHERE seq % 2 = 0)
        WHERE stt_output <> '' AND intended <> ''
        WINDOW w AS (PARTITION BY username, lower(stt_output), lower(intended)))
  WHERE rn = 1"""

_SIGHTINGS_SQL = f"""SELECT username, {duck_strip('stt_output')} AS stt_output, {duck_strip('intended')} AS intended,
    {_DCONF.format(f='frequency')} AS confidence, NULL::VARCHAR AS source, explanation AS context_hint, 1 AS occurrences,
    ts AS created_at, ts AS last_seen, seq FROM rules_raw
  WHERE seq % 2 = 1 AND {duck_strip('stt_output')} <> '' AND {duck_strip('intended')} <> ''"""

_UPSERT_SQL = """SELECT username, stt_output, intended, CAST(occurrences AS INTEGER) AS occurrences,
    round(least(1.0::double, confidence + 0.1::double * CASE WHEN has_old THEN n_new ELSE n_new - 1 END), 4) AS confidence,
    CASE WHEN has_old THEN source ELSE 'auto_feedback' END AS source, context_hint, created_at, last_seen
  FROM (SELECT *, sum(occ) OVER w AS occurrences, max(ls) OVER w AS last_seen, sum(is_new) OVER w AS n_new,
               min(is_new) OVER w = 0 AS has_old,
               row_number() OVER (PARTITION BY username, lower(stt_output), lower(intended) ORDER BY is_new, created_at, seq) AS rn
        FROM (SELECT username, stt_output, intended, confidence, source, context_hint, occurrences AS occ, created_at,
                     last_seen AS ls, seq, 0 AS is_new FROM stored
              UNION ALL
              SELECT username, stt_output, intended, confidence, source, context_hint, occurrences, created_at,
                     last_seen, seq, 1 FROM sightings)
        WINDOW w AS (PARTITION BY username, lower(stt_output), lower(intended)))
  WHERE rn = 1"""


@register("rule_feedback_upsert", with_cte(_UPSERT_SQL, rules_raw=X.RULES_RAW_SQL, stored=_STORED_SQL,
                                           sightings=_SIGHTINGS_SQL))
def q_rule_feedback_upsert(spark, sf_dir):
    raw = X.rules_raw(spark, sf_dir)
    clean = K.clean_rules(raw)
    old_raw = clean.filter(F.col("seq") % 2 == 0)
    stored = old_raw.groupBy("username", F.lower("stt_output").alias("_ks"), F.lower("intended").alias("_ki")).agg(
        F.min_by(F.struct("seq", "stt_output", "intended", "frequency", "explanation"), "seq").alias("f"),
        F.count(F.lit(1)).alias("occurrences"), F.min("ts").alias("created_at"), F.max("ts").alias("last_seen")
    ).select("username", F.col("f.stt_output").alias("stt_output"), F.col("f.intended").alias("intended"),
             freq_to_confidence("f.frequency").alias("confidence"), F.lit(K.SOURCE_LLM).alias("source"),
             F.col("f.explanation").alias("context_hint"), "occurrences", "created_at", "last_seen",
             F.col("f.seq").alias("seq"))
    sightings = clean.filter(F.col("seq") % 2 == 1).select(
        "username", "stt_output", "intended", freq_to_confidence("frequency").alias("confidence"),
        F.lit(None).cast("string").alias("source"), F.col("explanation").alias("context_hint"),
        F.lit(1).cast("bigint").alias("occurrences"), F.col("ts").alias("created_at"),
        F.col("ts").alias("last_seen"), "seq")
    return K.upsert_rules(stored, sightings)


# ------------------------------------------------------------------ U1 / U2 / F8
@register("append_pairs", with_cte(
    f"SELECT pair_id, model_output, correct_transcription FROM edge WHERE {duck_strip('model_output')} <> '' "
    f"OR {duck_strip('correct_transcription')} <> '' UNION ALL SELECT pair_id, model_output, correct_transcription "
    "FROM sub_pairs", pairs=X.PAIRS_SQL, sub_pairs=X.SUB_PAIRS_SQL,
    edge="SELECT pair_id, CASE WHEN pair_id % 9 = 0 THEN '   ' ELSE model_output END AS model_output, "
         "CASE WHEN pair_id % 9 = 0 OR pair_id % 7 = 0 THEN '' ELSE correct_transcription END AS correct_transcription FROM pairs"))
def q_append_pairs(spark, sf_dir):
    p = X.pairs(spark, sf_dir)
    existing = p.select("pair_id",
                        F.when(F.col("pair_id") % 9 == 0, F.lit("   ")).otherwise(F.col("model_output")).alias("model_output"),
                        F.when((F.col("pair_id") % 9 == 0) | (F.col("pair_id") % 7 == 0), F.lit(""))
                        .otherwise(F.col("correct_transcription")).alias("correct_transcription"))
    new = X.sub_pairs(spark, sf_dir).select("pair_id", "model_output", "correct_transcription")
    return K.append_pairs(existing, new)


# every 7th response is fenced, every 13th of the rest begins with blank lines, every 9th has no speaker info
_EXTRACT = ("CASE WHEN event_id % 11 = 0 THEN 'not json at all' "
            "WHEN event_id % 7 = 0 THEN concat('  ```json', chr(10), '{\"speaker_info\": {\"domain\": \"', event_type, '\"}}', chr(10), '```') "
            "WHEN event_id % 9 = 0 THEN '{\"corrections\": [{\"stt_output\": \"no info\", \"intended\": \"x\"}]}' "
            "ELSE concat(CASE WHEN event_id % 13 = 0 THEN concat(' ', chr(10)) ELSE '' END, '{\"speaker_info\": {\"domain\": \"', event_type, '\", \"topics\": [\"t', cast(user_id % 3 AS string), "
            "'\"]}, \"corrections\": [{\"stt_output\": \"', event_type, '\", \"intended\": \"term', cast(user_id % 7 AS string), "
            "'\", \"frequency\": \"high\"}], \"vocabulary\": []}') END")


_EVENT_TWIN = ("SELECT concat('user_', cast(user_id % 20 AS string)) AS username, event_id AS batch_no, event_type, user_id, "
               "event_id % 11 <> 0 AS ok, event_id % 11 <> 0 AND event_id % 7 <> 0 AND event_id % 9 = 0 AS bare, "
               "event_id % 11 <> 0 AND event_id % 7 = 0 AS fenced FROM events")


@register("parse_extraction", with_cte(
    "SELECT username, batch_no, ok AS parsed, CASE WHEN ok AND NOT bare THEN event_type END AS domain, "
    "CASE WHEN ok AND NOT fenced THEN 1 ELSE 0 END AS n_corrections, 0 AS n_vocabulary FROM ev", ev=_EVENT_TWIN))
def q_parse_extraction(spark, sf_dir):
    ev = X.table(spark, sf_dir, "events").selectExpr(
        "concat('user_', cast(user_id % 20 AS string)) AS username", "event_id AS batch_no",
        _EXTRACT.replace("chr(10)", "char(10)") + " AS response")
    p = K.parse_extraction(ev, "response")
    return p.select("username", "batch_no", "parsed", F.col("speaker_info.domain").alias("domain"),
                    F.size("corrections").alias("n_corrections"), F.size("vocabulary").alias("n_vocabulary"))


@register("merge_batches", with_cte(
    "SELECT username, arg_max(event_type, batch_no) FILTER (WHERE NOT bare) AS domain, max(batch_no) AS last_batch, "
    "count(*) AS batches FROM ev WHERE ok GROUP BY username", ev=_EVENT_TWIN))
def q_merge_batches(spark, sf_dir):
    ev = X.table(spark, sf_dir, "events").selectExpr(
        "concat('user_', cast(user_id % 20 AS string)) AS username", "event_id AS batch_no",
        _EXTRACT.replace("chr(10)", "char(10)") + " AS response")
    ok = K.parse_extraction(ev, "response").filter("parsed")
    m = K.merge_batches(ok, "username", "batch_no")
    return m.select("username", F.col("speaker_info.domain").alias("domain"), "last_batch", "batches")


# ------------------------------------------------------------------ composed jobs
def _extracted(spark, sf_dir):
    ev = X.table(spark, sf_dir, "events").selectExpr(
        "concat('user_', cast(user_id % 20 AS string)) AS username", "event_id AS batch_no",
        _EXTRACT.replace("chr(10)", "char(10)") + " AS response")
    return K.parse_extraction(ev, "response").filter("parsed")


@register("kb_build", with_cte(
    "SELECT m.speaker_id, m.username AS name, i.domain, (SELECT count(DISTINCT (lower(event_type), user_id % 7)) FROM ev e "
    "WHERE e.username = m.username AND ok AND NOT fenced AND NOT bare) + (SELECT count(DISTINCT bare) FROM ev e "
    "WHERE e.username = m.username AND bare) AS n_corrections, 0::BIGINT AS n_vocabulary "
    "FROM latest m JOIN (SELECT username, arg_max(event_type, batch_no) FILTER (WHERE NOT bare) AS domain FROM ev WHERE ok "
    "GROUP BY username) i USING (username)", mapping_log=X.MAPPING_LOG_SQL, latest=LATEST_MAPPING_SQL, ev=_EVENT_TWIN))
def q_kb_build(spark, sf_dir):
    """Extraction responses to stored profiles: parse, merge, de-duplicate, assemble, write, read back."""
    from vocalis.session import scratch_path
    from vocalis.sources.profiles import read_profiles, write_profiles
    ok = _kept(spark, _extracted(spark, sf_dir).drop("response"), "kb-extracted")
    info = K.merge_batches(ok).select("username", "speaker_info.*").withColumnRenamed("style_notes", "notes")
    built = K.build_profiles(_mapping(spark, sf_dir).join(info.select("username"), "username"),
                             K.dedupe_rules(K.batch_rules(ok)), K.dedupe_vocab(K.batch_vocab(ok)), info)
    path = scratch_path(spark, "kb-build")
    write_profiles(built, path)
    return K.summarise_profiles(read_profiles(spark, path)).drop("topics")


@register("corrected_requests", with_cte(
    "SELECT t.text_id, t.username, m.speaker_id IS NOT NULL AS used_kb, "
    "CASE WHEN m.speaker_id IS NULL THEN t.model_output ELSE "
    "(SELECT string_agg(coalesce(b.intended, w.tok), ' ' ORDER BY w.pos) FROM "
    " (SELECT unnest(string_split(t.model_output, ' ')) AS tok, unnest(range(len(string_split(t.model_output, ' ')))) AS pos) w "
    " LEFT JOIN best b ON b.username = t.username AND b.k = lower(w.tok)) END AS corrected "
    f"FROM texts t LEFT JOIN (SELECT * FROM latest WHERE username NOT IN ({_UNMAPPED_SQL}, '{X.MISSING_PROFILE_USER}')) m "
    "USING (username)",
    rules_raw=X.RULES_RAW_SQL, rules=DEDUPE_RULES_SQL, texts=X.RULE_TEXTS_SQL, mapping_log=X.MAPPING_LOG_SQL,
    latest=LATEST_MAPPING_SQL,
    best="SELECT username, k, intended FROM (SELECT username, lower(stt_output) AS k, intended, row_number() OVER "
         "(PARTITION BY username, lower(stt_output) ORDER BY confidence DESC, first_seq) AS rn FROM rules) WHERE rn = 1"))
def q_corrected_requests(spark, sf_dir):
    """Request to mapping to profile to corrected text, with the rules stored in the profile."""
    mapping = _mapping(spark, sf_dir).filter(~F.col("username").isin(X.UNMAPPED_USERS))
    docs = profiles(spark, sf_dir).join(
        mapping.filter(F.col("username") != X.MISSING_PROFILE_USER).select("speaker_id"), "speaker_id", "left_semi")
    req = K.attach_profile(X.rule_texts(spark, sf_dir), mapping, docs.select("speaker_id", "style")) \
        .select("text_id", "username", "model_output", "used_kb")
    return K.apply_rules(req, K.profile_rules(docs), partitions=C.partitions(spark)).select("text_id", "username", "used_kb", "corrected")
