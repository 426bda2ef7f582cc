"""Secret scan over a trigram inverted index.

Each rule's regular expression is turned into a Boolean query over trigrams
that every match must contain (``trigram_query``).  The index lists, for each
trigram that some query needs, the documents whose lower-cased text has it.
A rule's candidates are the documents whose postings satisfy its query; only
they are scanned with the rule's expression.  Rules without a mandatory
trigram (plain hex runs) scan every document.

Spans are code-point offsets, found without leaving the JVM: the text between
matches (``split``) and the matches themselves (``regexp_extract_all``) give
all offsets by running sums.

Defined cases: null text is empty; null ``doc_id`` rows are matched null-safe
and keep their own spans; repeated rows are each reported; matches of one rule
are leftmost and do not overlap, spans of different rules may; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from re import _constants as sre  # type: ignore[attr-defined]
from re import _parser as sre_parse  # type: ignore[attr-defined]

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vocalis.llm.common import let, text_or_empty


@dataclass(frozen=True)
class Rule:
    """``min_length`` holds for group ``group``; shorter matches are dropped after matching."""
    kind: str
    pattern: str
    ignore_case: bool = False
    group: int = 0
    min_length: int = 1

    @property
    def java(self) -> str:
        return ("(?i)" if self.ignore_case else "") + self.pattern


#: The stated base rules, in their order.
BASE_RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         ignore_case=True, group=2, min_length=12),
    # a run of one character class: the minimum length stands in the expression
    Rule("access", r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", r"[0-9a-f]{16,}"),
)
#: Published token formats that the base rules miss.
MORE_RULES = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", min_length=40),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+[.]eyJ[A-Za-z0-9_-]+[.][A-Za-z0-9_-]+", min_length=40),
)
RULES = BASE_RULES + MORE_RULES

#: A literal run with more alternatives than this is cut, which only widens the candidates.
MAX_ALTERNATIVES = 64
MASK = "[SECRET]"


def _literals(item) -> set[str] | None:
    """All strings an item can match, lower-cased, or None when they are not few."""
    op, arg = item
    if op is sre.LITERAL:
        return {chr(arg).lower()}
    if op is sre.IN and all(o is sre.LITERAL for o, _ in arg) and len(arg) <= 8:
        return {chr(a).lower() for _, a in arg}
    if op is sre.SUBPATTERN:
        return _sequence_literals(arg[-1])
    if op is sre.BRANCH:
        parts = [_sequence_literals(b) for b in arg[1]]
        return None if any(p is None for p in parts) else set().union(*parts)
    if op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and arg[1] == 1:
        one = _sequence_literals(arg[2])
        return None if one is None else one | {""} if arg[0] == 0 else one
    return None


def _sequence_literals(items) -> set[str] | None:
    out = {""}
    for item in items:
        nxt = _literals(item)
        if nxt is None or len(out) * len(nxt) > MAX_ALTERNATIVES:
            return None
        out = {a + b for a in out for b in nxt}
    return out


def trigram_query(pattern: str) -> list[list[list[str]]]:
    """AND of ORs of ANDs of lower-case trigrams that each match must satisfy; empty: no mandatory trigram."""
    groups: list[set[str]] = []
    run = {""}

    def flush() -> None:
        nonlocal run
        if all(len(s) >= 3 for s in run):
            groups.append(run)
        run = {""}

    for item in sre_parse.parse(pattern):
        nxt = _literals(item)
        if nxt is None:
            flush()
            op, arg = item
            if op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and arg[0] >= 1 and (one := _sequence_literals(arg[2])):
                groups.extend([one] if all(len(s) >= 3 for s in one) else [])
            continue
        if len(run) * len(nxt) > MAX_ALTERNATIVES:
            flush()
        run = {a + b for a in run for b in nxt}
    flush()
    query = []
    for g in groups:
        alts = {frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in g}
        query.append(sorted(sorted(a) for a in alts if not any(b < a for b in alts)))  # a wider alternative covers it
    return query


def needed_trigrams(rules: Sequence[Rule]) -> list[str]:
    return sorted({t for r in rules for group in trigram_query(r.pattern) for alt in group for t in alt})


def build_index(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Postings (trigram, doc_id) of the trigrams that some rule's query needs."""
    wanted = F.array(*[F.lit(t) for t in needed_trigrams(rules)])
    found = let(F.lower(text_or_empty()), lambda t: F.filter(wanted, lambda g: F.contains(t, g)))
    return docs.select("doc_id", F.explode(found).alias("trigram"))


def _choice(col: Column, values: dict[str, int]) -> Column:
    out = F.lit(0).cast("long")
    for k, v in values.items():
        out = F.when(col == k, F.lit(v).cast("long")).otherwise(out)
    return out


def candidates(index: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """doc_id, kinds: the rules whose trigram query the document's postings satisfy.

    Postings are intersected as bits of a few longs per document, combined before the shuffle.
    """
    trigrams = needed_trigrams(rules)
    words = [trigrams[k:k + 62] for k in range(0, len(trigrams), 62)]
    have = index.groupBy("doc_id").agg(F.lit(True).alias("_any"), *[
        F.bit_or(_choice(F.col("trigram"), {t: 1 << i for i, t in enumerate(w)})).alias(f"_have{k}")
        for k, w in enumerate(words)])
    kinds = []
    for r in rules:
        query = trigram_query(r.pattern)
        if not query:
            continue
        ok = F.lit(True)
        for group in query:
            one = F.lit(False)
            for alt in group:
                has_all = F.lit(True)
                for k, w in enumerate(words):
                    if need := sum(1 << i for i, t in enumerate(w) if t in alt):
                        has_all = has_all & (F.col(f"_have{k}").bitwiseAND(F.lit(need).cast("long")) == need)
                one = one | has_all
            ok = ok & one
        kinds.append(F.when(ok, F.lit(r.kind)))
    return have.select("doc_id", F.array_compact(F.array(*kinds)).alias("kinds")).where(F.size("kinds") > 0)


_SPAN = "array<struct<start:int,ord:int,kind:string,end:int>>"


def _spans(text: Column, rule: Rule, order: int) -> Column:
    """Spans of one rule: running sums over the pieces between matches and the matches."""
    found = F.regexp_extract_all(text, F.lit(f"({rule.java})"), F.lit(0))
    judged = F.regexp_extract_all(text, F.lit(f"({rule.java})"), F.lit(rule.group + 1)) if rule.group else found
    lengths = F.transform(F.arrays_zip(
        F.transform(F.split(text, rule.java, -1), lambda s: F.char_length(s)).alias("gap"),
        F.transform(found, lambda s: F.char_length(s)).alias("len"),
        F.transform(judged, lambda s: F.char_length(s)).alias("judged")),
        lambda z: F.struct(z["gap"].alias("gap"), F.coalesce(z["len"], F.lit(0)).alias("len"),
                           F.coalesce(z["judged"], F.lit(0)).alias("judged")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("out"))

    def step(acc: Column, z: Column) -> Column:
        begin, end = acc["at"] + z["gap"], acc["at"] + z["gap"] + z["len"]
        span = F.struct(begin.alias("start"), F.lit(order).alias("ord"), F.lit(rule.kind).alias("kind"),
                        end.alias("end"))
        keep = F.when(z["judged"] >= rule.min_length, F.array(span)).otherwise(F.array().cast(_SPAN))
        return F.struct(end.alias("at"), F.concat(acc["out"], keep).alias("out"))

    return F.when(F.rlike(text, F.lit(rule.java)), F.aggregate(lengths, start, step)["out"]) \
        .otherwise(F.array().cast(_SPAN))


def find_secrets(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """row (all columns of ``docs``) and spans: (start, ord, kind, end), sorted by start and rule order."""
    found = candidates(build_index(docs, rules), rules)
    rows = docs.select(F.struct(*docs.columns).alias("row"))
    joined = rows.join(found, rows["row.doc_id"].eqNullSafe(found["doc_id"]), "left")
    text = text_or_empty("row.text")
    none = F.array().cast(_SPAN)
    per_rule = [F.when(F.array_contains("kinds", r.kind), _spans(text, r, k)).otherwise(none)
                if trigram_query(r.pattern) else _spans(text, r, k) for k, r in enumerate(rules)]
    return joined.select("row", F.sort_array(F.concat(*per_rule)).alias("spans"))


def span_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(text: Column, spans: Column, mask: str = MASK) -> Column:
    """``text`` with every span replaced by ``mask``; overlapping spans become one mask."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        return F.when(s["start"] >= acc["at"], F.struct(
            s["end"].alias("at"),
            F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mask)).alias("out"))) \
            .otherwise(F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["out"].alias("out")))

    return F.when(F.size(spans) == 0, text).otherwise(
        F.aggregate(spans, start, step, lambda a: F.concat(
            a["out"], F.substring(text, a["at"] + 1, F.greatest(F.char_length(text) - a["at"], F.lit(0))))))


def redact_documents(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """``docs`` with secrets masked in ``text``; ``n_chars`` follows the new text where the column is there."""
    text = F.col("row.text")
    out = find_secrets(docs, rules).select(
        "row", F.size("spans").alias("found"), F.when(text.isNotNull(), redact(text, F.col("spans"))).alias("clean"))
    new = {"text": F.col("clean")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("found") == 0, F.col("row.n_chars")).otherwise(
            F.char_length("clean").cast(docs.schema["n_chars"].dataType))
    return out.select(*[new.get(c, F.col("row")[c]).alias(c) for c in docs.columns])
