"""The opN_<name> queries: each applies its operator to its whole table, with a DuckDB twin where SQL can say it."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vocalis.llm import (
    collocations,
    cover_tree_codes,
    decontaminate,
    host_reputation,
    language_id,
    merkle,
    ngram_join,
    packing,
    page_diff,
    preference,
    secret_index,
    token_frames,
    toxicity,
)
from vocalis.llm.common import ready, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ready(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _lower(col: str) -> str:
    return f"translate({col}, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"


def fold(doc_id: str = "doc_id"):
    """crc32 of the id as text modulo 5; 0 is the held-out fold."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(5))


# ------------------------------------------------------------------ op1
@register("op1_toxicity")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"), fold() != 0)
    return toxicity.score(docs, model, "doc_id").select(
        "doc_id", F.coalesce(fold() == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


# ------------------------------------------------------------------ op2
@register("op2_ngram_join")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))


# ------------------------------------------------------------------ op3
@register("op3_page_diff")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_diff.extract(table(spark, sf_dir, "pages")) \
        .withColumn("n_chars", F.char_length("text").cast("long"))


# ------------------------------------------------------------------ op4
_RULE_SQL = " UNION ALL ".join(f"SELECT '{k}' AS kind, '{h}' AS rhost, '{p}' AS rpath" for k, h, p in host_reputation.RULES)
_OP4_SQL = f"""
WITH rules AS ({_RULE_SQL}),
rest AS (SELECT page_id, regexp_extract(coalesce(url, ''), '^.*?://(.*)$', 1, 's') AS r FROM pages),
split AS (
  SELECT page_id, {_lower("regexp_extract(r, '^[^/?#]*', 0)")} AS host, regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rest),
known AS (SELECT doc_id AS page_id, max(1 - quality) AS bad FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
judged AS (SELECT s.page_id, host, path, bad FROM split s LEFT JOIN known k ON s.page_id = k.page_id),
{host_reputation.REPUTATION_CTES.format(domain="regexp_extract(host, '([^.]*[.])?[^.]*$', 0)",
                                        suffix="regexp_extract(host, '[^.]*$', 0)").strip()}
SELECT s.page_id, s.host, s.path,
  (SELECT arg_max(rhost || rpath, length(rhost || rpath)) FROM rules
   WHERE (s.host = rhost OR suffix(s.host, '.' || rhost)) AND starts_with(s.path, rpath)) AS rule,
  coalesce((SELECT arg_max(kind, length(rhost || rpath)) FROM rules
   WHERE (s.host = rhost OR suffix(s.host, '.' || rhost)) AND starts_with(s.path, rpath)),
   CASE WHEN bad_bound > {host_reputation.CUTOFF} THEN 'block' ELSE 'allow' END) AS verdict
FROM split s JOIN reputation r ON s.host = r.host
"""


@register("op4_host_reputation", _OP4_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's outcome is the quality label of the same number: 0 is a bad page."""
    outcomes = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), (1 - F.col("quality")).alias("bad"))
    return host_reputation.judge_urls(table(spark, sf_dir, "pages"), outcomes) \
        .select("page_id", "host", "path", "rule", "verdict")


# ------------------------------------------------------------------ op5
def _words_sql(col: str) -> str:
    return f"regexp_extract_all({_lower(f'coalesce({col}, {chr(39) * 2})')}, '{decontaminate.WORD}')"


_OP5_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_words_sql('text')} AS ws FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_words_sql('text')} AS ws FROM benchmark),
bw AS (
  SELECT DISTINCT item, sz, array_to_string(ws[i:i + sz - 1], ' ') AS win
  FROM (SELECT item, ws, sz, unnest(range(1, len(ws) - sz + 2)) AS i
        FROM (SELECT item, ws, least(len(ws), {decontaminate.WINDOW}) AS sz FROM b WHERE len(ws) > 0) x) y),
dw AS (
  SELECT rid, i, sz, array_to_string(ws[i:i + sz - 1], ' ') AS win
  FROM (SELECT rid, ws, sz, unnest(range(1, len(ws) - sz + 2)) AS i
        FROM d, (SELECT DISTINCT sz FROM bw) s WHERE len(ws) >= sz) y),
hit AS (SELECT rid, i, dw.sz, item FROM dw JOIN bw ON dw.win = bw.win AND dw.sz = bw.sz),
pos AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + sz)) AS p FROM hit) x GROUP BY rid),
its AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
        FROM (SELECT DISTINCT rid, item FROM hit WHERE item IS NOT NULL) x GROUP BY rid)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND {decontaminate.MAX_CLEAN_SHARE} * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN pos ON d.rid = pos.rid LEFT JOIN its ON d.rid = its.rid
"""


@register("op5_decontamination", _OP5_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = decontaminate.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return judged.select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"), F.col("n_hit").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


# ------------------------------------------------------------------ op6
_TURN_SQL = f"'{preference.START}' || role || chr(10) || text || '{preference.END.strip()}' || chr(10)"
_OP6_SQL = f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, 'unknown'), coalesce(text, '')) AS k
  FROM conversations),
last AS (
  SELECT conv_id, max(turn) AS last_turn, arg_max(text, (turn, text)) AS t FROM c WHERE role = 'assistant' GROUP BY conv_id),
ans AS (SELECT l.conv_id, l.last_turn, o.t FROM last l JOIN last o ON o.conv_id = l.conv_id + 1),
r0 AS (
  SELECT c.conv_id, turn, role, text FROM c JOIN ans a ON a.conv_id = c.conv_id WHERE turn < last_turn
  UNION ALL SELECT conv_id, last_turn, 'assistant', t FROM ans),
r AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS k FROM r0),
n AS (
  SELECT c.conv_id, coalesce(min(CASE WHEN r.k IS NULL OR r.role <> c.role OR r.text <> c.text THEN c.k END) - 1,
                             count(*)) AS n_common
  FROM c LEFT JOIN r ON c.conv_id = r.conv_id AND c.k = r.k GROUP BY c.conv_id),
rc AS (SELECT conv_id, count(*) AS n FROM r GROUP BY conv_id),
side AS (
  SELECT 'a' AS side, c.conv_id, k, role, {_TURN_SQL} AS s, length({_TURN_SQL}) AS len, k <= n_common AS shared
  FROM c JOIN n ON n.conv_id = c.conv_id
  UNION ALL
  SELECT 'b', r.conv_id, k, role, {_TURN_SQL}, length({_TURN_SQL}), k <= n_common FROM r JOIN n ON n.conv_id = r.conv_id),
offs AS (
  SELECT *, coalesce(sum(len) OVER (PARTITION BY side, conv_id, shared ORDER BY k
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off FROM side),
agg AS (
  SELECT conv_id,
    coalesce(string_agg(s, '' ORDER BY k) FILTER (WHERE side = 'a' AND shared), '') AS prompt,
    coalesce(string_agg(s, '' ORDER BY k) FILTER (WHERE side = 'a' AND NOT shared), '') AS chosen,
    coalesce(string_agg(s, '' ORDER BY k) FILTER (WHERE side = 'b' AND NOT shared), '') AS rejected,
    coalesce(string_agg((off + {len(preference.START + preference.SEP)} + length(role)) || ':' || (off + len), ',' ORDER BY k)
      FILTER (WHERE side = 'a' AND NOT shared AND role = 'assistant'), '') AS chosen_mask,
    coalesce(string_agg((off + {len(preference.START + preference.SEP)} + length(role)) || ':' || (off + len), ',' ORDER BY k)
      FILTER (WHERE side = 'b' AND NOT shared AND role = 'assistant'), '') AS rejected_mask
  FROM offs GROUP BY conv_id)
SELECT a.conv_id, rc.n IS NOT NULL AS paired,
  CAST(CASE WHEN rc.n IS NULL THEN (SELECT count(*) FROM c WHERE c.conv_id = a.conv_id) ELSE n_common END AS INT) AS n_common,
  CASE WHEN rc.n IS NULL THEN chosen ELSE prompt END AS prompt,
  CASE WHEN rc.n IS NOT NULL THEN chosen END AS chosen, CASE WHEN rc.n IS NOT NULL THEN rejected END AS rejected,
  CASE WHEN rc.n IS NOT NULL THEN chosen_mask END AS chosen_mask,
  CASE WHEN rc.n IS NOT NULL THEN rejected_mask END AS rejected_mask
FROM agg a JOIN n ON n.conv_id = a.conv_id LEFT JOIN rc ON rc.conv_id = a.conv_id
"""


@register("op6_preference_format", _OP6_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each conversation against itself with the last answer taken from the next conversation."""
    convs = table(spark, sf_dir, "conversations")

    def mask(name: str):
        return F.when(F.col(name).isNotNull(), F.array_join(F.transform(name, lambda s: F.concat_ws(
            ":", s["start"].cast("string"), s["end"].cast("string"))), ",")).alias(name)

    return preference.format_preferences(convs, preference.regenerated(convs)).select(
        "conv_id", "paired", "n_common", "prompt", "chosen", "rejected", mask("chosen_mask"), mask("rejected_mask"))


# ------------------------------------------------------------------ op7
@register("op7_language_id")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    dictionaries = language_id.train(docs.where(fold() != 0).select("lang", "text"))
    return language_id.identify(docs, dictionaries, "doc_id").select(
        "doc_id", F.coalesce(fold() == 0, F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected")


# ------------------------------------------------------------------ op8
def _print_sql(col: str) -> str:
    leaf = (f"array_to_string(list_transform(regexp_extract_all(l, '(?s).{{1,{merkle.PIECE}}}'), "
            f"lambda p: left(sha256(p), {merkle.LEAF_HEX})), ' ')")
    paras = f"list_transform(string_split({col}, chr(10)), lambda l: {leaf})"
    secs = (f"list_transform(range(0, len(ps), {merkle.SECTION}), "
            f"lambda i: array_to_string(ps[i + 1:i + {merkle.SECTION}], '/'))")
    return (f"(SELECT sha256(array_to_string(list_transform(ss, lambda s: sha256(s)), ';')) || '|' || "
            f"array_to_string(list_transform(ss, lambda s: left(sha256(s), {merkle.NODE_HEX}) || ':' || s), ';') "
            f"FROM (SELECT {secs} AS ss FROM (SELECT {paras} AS ps) a) b)")


def _near_sql(a: str, b: str) -> str:
    def lv(x: str) -> str:
        return f"list_distinct(regexp_extract_all(split_part({x}, '|', 2), '\\b[0-9a-f]{{{merkle.LEAF_HEX}}}\\b'))"
    return (f"CASE WHEN split_part({a}, '|', 1) = split_part({b}, '|', 1) THEN 1.0 ELSE coalesce("
            f"2.0 * len(list_intersect({lv(a)}, {lv(b)})) / nullif(len({lv(a)}) + len({lv(b)}), 0), 0) END")


_OP8_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
nx AS (SELECT doc_id, coalesce(lag(doc_id) OVER (ORDER BY doc_id), max(doc_id) OVER ()) AS nid
       FROM (SELECT DISTINCT doc_id FROM d WHERE doc_id IS NOT NULL) x),
p AS (SELECT d.doc_id, d.t, coalesce(n.t, '') AS nt
      FROM d LEFT JOIN nx ON d.doc_id = nx.doc_id
      LEFT JOIN (SELECT doc_id, min(t) AS t FROM d GROUP BY doc_id) n ON n.doc_id = nx.nid),
e AS (SELECT doc_id, t, nt, left(t, length(t) - length(t) // 3) || left(nt, length(t) // 3) AS ed FROM p),
f AS (SELECT doc_id, length(t) AS n_chars, sha256(ed) AS edited_sha256, {_print_sql('t')} AS fingerprint,
        {_print_sql('ed')} AS edited_fingerprint, {_print_sql('nt')} AS nf FROM e)
SELECT doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
  CAST({_near_sql('fingerprint', 'edited_fingerprint')} AS DOUBLE) AS near_edited,
  CAST({_near_sql('fingerprint', 'nf')} AS DOUBLE) AS near_next
FROM f
"""


@register("op8_merkle_fingerprint", _OP8_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.fingerprint_edits(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
        "near_edited", "near_next")


# ------------------------------------------------------------------ op9
def _any_case(pattern: str) -> str:
    """Letters of the keyword group in either case, spelled out (the last group stays)."""
    head, tail = pattern[:pattern.index(")") + 1], pattern[pattern.index(")") + 1:]
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in head) + tail


def _spans_sql(rule: secret_index.Rule, order: int) -> str:
    pat = (_any_case(rule.pattern) if rule.ignore_case else rule.pattern).replace("'", "''")
    return f"""
SELECT rid, s.b AS b, {order} AS ord, '{rule.kind}' AS kind, s.b + s.n AS e FROM (
  SELECT rid, unnest(list_transform(range(1, len(m) + 1), lambda i: {{
    'b': CAST(list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS INT),
    'n': length(m[i]), 'j': length(j[i])}})) AS s
  FROM (SELECT rid, regexp_extract_all(t, '{pat}', 0) AS m, regexp_extract_all(t, '{pat}', {rule.group}) AS j,
          string_split_regex(t, '{pat}') AS g FROM d) x) y
WHERE s.j >= {rule.min_length}"""


_OP9_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
spans AS ({" UNION ALL ".join(_spans_sql(r, k) for k, r in enumerate(secret_index.RULES))}),
agg AS (
  SELECT rid, count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access,
    count(*) FILTER (WHERE kind = 'hex') AS n_hex,
    string_agg(kind || ':' || b || ':' || e, ',' ORDER BY b, ord) FILTER (WHERE ord < {len(secret_index.BASE_RULES)}) AS base,
    string_agg(kind || ':' || b || ':' || e, ',' ORDER BY b, ord) AS spans
  FROM spans GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN agg ON d.rid = agg.rid
"""


@register("op9_secret_index", _OP9_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_index.find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("spans", lambda s: s["ord"] < len(secret_index.BASE_RULES))
    return found.select(
        "row.doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(secret_index.span_text(base), 256).alias("base_sha256"),
        secret_index.span_text(F.col("spans")).alias("spans"))


# ------------------------------------------------------------------ op10
def tokenizer_path() -> str:
    """The public byte-level vocabulary; read on the driver."""
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


@register("op10_packing")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


# ------------------------------------------------------------------ op11
def _lloyd_sql() -> str:
    """Plain Lloyd rounds in SQL: an assignment of every part to every entry, then floored means."""
    parts, entries = cover_tree_codes.PARTS, cover_tree_codes.ENTRIES
    ctes = [f"""
kept AS (SELECT row_number() OVER () AS rid, vec_id, label, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * {cover_tree_codes.SCALE}) AS BIGINT)) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND list_count(embedding) = len(embedding)
    AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0),
parts AS MATERIALIZED (SELECT rid, p, v[p * (len(v) // {parts}) + 1:(p + 1) * (len(v) // {parts})] AS c FROM kept, range({parts}) t(p)),
book0 AS MATERIALIZED (SELECT p, k - 1 AS k, c FROM parts JOIN (
  SELECT rid, row_number() OVER (ORDER BY vec_id, v) AS k FROM kept) f ON parts.rid = f.rid AND k <= {entries})"""]
    near = """
near{0} AS MATERIALIZED (SELECT rid, p, min((d, k)) AS best FROM (
  SELECT rid, a.p, k, list_sum(list_transform(list_zip(a.c, b.c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
  FROM parts a JOIN book{0} b ON a.p = b.p) x GROUP BY rid, p)"""
    for r in range(cover_tree_codes.ROUNDS):
        ctes.append(near.format(r))
        ctes.append(f"""
book{r + 1} AS MATERIALIZED (SELECT b.p, b.k, coalesce(m.c, b.c) AS c FROM book{r} b LEFT JOIN (
  SELECT p, k, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY j) AS c FROM (
    SELECT a.p, best[2] AS k, j, sum(a.c[j]) AS s, count(*) AS n
    FROM near{r} a0 JOIN parts a ON a0.rid = a.rid AND a0.p = a.p, range(1, len(a.c) + 1) t(j) GROUP BY ALL) y
  GROUP BY p, k) m ON b.p = m.p AND b.k = m.k)""")
    last = cover_tree_codes.ROUNDS
    ctes.append(near.format(last))
    return f"""
WITH {",".join(ctes)},
coded AS (SELECT rid, string_agg(printf('%02x', best[2]), '' ORDER BY p) AS code, CAST(sum(best[1]) AS BIGINT) AS error
  FROM near{last} GROUP BY rid),
digest AS (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY p, k, j)) AS d
  FROM (SELECT p, k, unnest(c) AS x, unnest(range(len(c))) AS j FROM book{last}) z)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT d FROM digest) AS codebooks_sha256
FROM kept JOIN coded ON kept.rid = coded.rid
"""


@register("op11_cover_tree_codes", _lloyd_sql())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree_codes.compress(table(spark, sf_dir, "embeddings"))


# ------------------------------------------------------------------ op12
def word_tokenizer_path() -> str:
    """The public word vocabulary; read on the driver."""
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


@register("op12_token_frames")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_frames.store_tokens(table(spark, sf_dir, "documents").select("doc_id", "text"), word_tokenizer_path())


# ------------------------------------------------------------------ op13
_N = collocations.DEPTH
_OP13_SQL = f"""
WITH pieces AS (SELECT coalesce(lang, '{collocations.NO_LANGUAGE}') AS lang,
    unnest(string_split_regex({_lower("coalesce(text, '')")}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces),
n AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM w GROUP BY lang),
f AS MATERIALIZED (SELECT lang, size, phrase, count(*) AS a FROM (
  SELECT lang, size, unnest(list_transform(range(1, len(ws) - size + 2), lambda i: array_to_string(ws[i:i + size - 1], ' '))) AS phrase
  FROM w, range(1, {_N + 1}) s(size)) x GROUP BY ALL HAVING count(*) >= {collocations.MIN_COUNT}),
cuts AS (SELECT lang, size, phrase, a, k, array_to_string(string_split(phrase, ' ')[1:k], ' ') AS head,
    array_to_string(string_split(phrase, ' ')[k + 1:], ' ') AS tail
  FROM f, range(1, {_N}) t(k) WHERE k < size),
scored AS (SELECT c.lang, c.size, c.phrase, c.a, min(({collocations.SCALE}::HUGEINT * c.a // (h.a + t.a), k, h.a, t.a)) AS cut
  FROM cuts c JOIN f h ON c.lang = h.lang AND c.head = h.phrase JOIN f t ON c.lang = t.lang AND c.tail = t.phrase GROUP BY ALL),
longer AS (SELECT lang, array_to_string(string_split(phrase, ' ')[i:i + s - 1], ' ') AS phrase, max(a) AS outer_a
  FROM f, range(2, {_N}) t(s), range(1, {_N}) u(i) WHERE s < size AND i + s - 1 <= size GROUP BY ALL),
kept AS (SELECT s.lang, s.phrase, a, cut[3] AS l, cut[4] AS r, CAST(cut[1] AS BIGINT) AS score
  FROM scored s LEFT JOIN longer g ON s.lang = g.lang AND s.phrase = g.phrase
  WHERE outer_a IS NULL OR 100::HUGEINT * outer_a < {collocations.INSIDE_PERCENT}::HUGEINT * a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT ranked.lang, rank, phrase, a, l, r, n, score FROM ranked JOIN n ON ranked.lang = n.lang WHERE rank <= {collocations.TOP}
"""


@register("op13_collocations", _OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))
