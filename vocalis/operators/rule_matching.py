"""Applying a user's correction rules to text with a token trie.

A user's phrases lie in one trie over folded tokens, with failure links, so a single pass over a text finds every phrase
that stands in it, however many rules there are.  The rules then run in their order: the first one found is
replaced wherever it stands, and the changed text is searched again for later rules, as a replacement can make or break
their phrases.  Rules that are not in the text cost nothing.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vocalis.session import scratch_path

#: Rules, and letters of all rules, up to which every task gets all of them; beyond that texts and rules meet by user.
MAX_SHARED_RULES = 100_000
MAX_SHARED_LETTERS = 8_000_000
#: Texts of a user that are handled together when rules are not shared.
GROUP_TEXTS = 20_000

#: The blanks between tokens: ASCII white space.
_BLANKS = re.compile("([ \t\n\x0b\f\r]+)")


def _fold_letter(c: str) -> str:
    """Letter case removed as a case-insensitive pattern does: upper, then lower, where that is one letter."""
    if c == "İ":
        return "i"
    up = c.upper()
    up = up if len(up) == 1 else c
    low = up.lower()
    return low if len(low) == 1 else up


@lru_cache(maxsize=1 << 16)
def fold(token: str) -> str:
    return token.lower() if token.isascii() else "".join(map(_fold_letter, token))


class RuleTrie:
    """One user's rules in the order in which they run: (phrase, replacement)."""

    def __init__(self, rules: list[tuple[str, str]]):
        self._rules = []
        self._next: list[dict[str, int]] = [{}]
        self._ends: list[list[int]] = [[]]
        for phrase, replacement in rules:
            tokens = [fold(t) for t in _BLANKS.split(phrase)[::2] if t]
            if not tokens:
                continue
            node = 0
            for t in tokens:
                if t not in self._next[node]:
                    self._next[node][t] = len(self._next)
                    self._next.append({})
                    self._ends.append([])
                node = self._next[node][t]
            self._ends[node].append(len(self._rules))
            self._rules.append((tokens, replacement))
        self._link()

    def _link(self) -> None:
        """Failure links, breadth first; a node also ends the rules that its failure node ends."""
        self._fail = [0] * len(self._next)
        queue = deque(self._next[0].values())
        while queue:
            node = queue.popleft()
            for token, child in self._next[node].items():
                queue.append(child)
                back = self._fail[node]
                while back and token not in self._next[back]:
                    back = self._fail[back]
                self._fail[child] = self._next[back].get(token, 0)
                self._ends[child] = sorted({*self._ends[child], *self._ends[self._fail[child]]})

    def _first_after(self, tokens: list[str], last: int) -> int | None:
        """The first rule after ``last`` whose phrase is in the text."""
        node, found = 0, None
        following, ends, fail = self._next, self._ends, self._fail
        for t in tokens:
            while node and t not in following[node]:
                node = fail[node]
            node = following[node].get(t, 0)
            for rule in ends[node]:
                if rule > last:
                    if found is None or rule < found:
                        found = rule
                    break
        return found

    def apply(self, text: str) -> str:
        last = -1
        while True:
            parts = _BLANKS.split(text)  # token, blanks, token, ..., token
            folded = [fold(t) for t in parts[::2]]
            last = self._first_after(folded, last)
            if last is None:
                return text
            phrase, replacement = self._rules[last]
            out, k = [], 0
            while k < len(folded):
                if folded[k:k + len(phrase)] == phrase:
                    out.append(replacement)
                    k += len(phrase)
                else:
                    out.append(parts[2 * k])
                    k += 1
                if k < len(folded):
                    out.append(parts[2 * k - 1])
            text = "".join(out)


def _ordered(rules: DataFrame, key: str) -> DataFrame:
    """(key, rules) with the rules of a user in running order: confidence descending, then first seen."""
    seen = [c for c in ("first_seq", "first_pos") if c in rules.columns]
    return rules.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct(
        (-F.col("confidence")).alias("o1"), *seen, "stt_output", "intended"))),
        lambda r: F.struct(r["stt_output"].alias("phrase"), r["intended"].alias("replacement"))).alias("_rules"))


def _pairs(rules: list | None) -> list[tuple[str, str]]:
    return [(r["phrase"], r["replacement"]) for r in rules or () if r["phrase"] is not None and r["replacement"] is not None]


def apply_tries(texts: DataFrame, rules: DataFrame, text_col: str, key: str, out_col: str) -> DataFrame:
    """``texts`` with ``out_col``: the text after its user's rules; unchanged without a user or rules, null if null."""
    folder = scratch_path(texts.sparkSession, "ordered-rules")
    ordered = _ordered(rules, key)
    ordered.write.mode("overwrite").parquet(folder)
    ordered = texts.sparkSession.read.schema(ordered.schema).parquet(folder)
    size = ordered.agg(F.coalesce(F.sum(F.size("_rules")), F.lit(0)).alias("n"), F.sum(F.aggregate(
        "_rules", F.lit(0).cast("long"), lambda n, r: n + F.coalesce(F.char_length(r["phrase"]) + F.char_length(r["replacement"]), F.lit(0))))
        .alias("letters")).first()
    texts = texts.drop(out_col) if out_col in texts.columns else texts
    names = texts.columns
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in texts.schema), f"`{out_col}` string"])
    if size["n"] <= MAX_SHARED_RULES and (size["letters"] or 0) <= MAX_SHARED_LETTERS:
        shared = texts.sparkSession.sparkContext.broadcast({r[key]: _pairs(r["_rules"]) for r in ordered.collect()})

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tries: dict = {}
            for batch in batches:
                out = []
                for who, text in zip(batch.column(key).to_pylist(), batch.column(text_col).to_pylist()):
                    if text is None or who not in shared.value:
                        out.append(text)
                        continue
                    if who not in tries:
                        tries[who] = RuleTrie(shared.value[who])
                    out.append(tries[who].apply(text))
                yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(out, pa.string())], names=[*names, out_col])

        return texts.mapInArrow(run, schema)

    # a user with many texts is several groups, each with the user's rules
    parts = texts.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).select(
        F.col(key).alias("_user"), F.ceil(F.col("_n") / GROUP_TEXTS).cast("int").alias("_parts"))
    dealt = texts.join(parts, F.col(key).eqNullSafe(F.col("_user"))) \
        .withColumn("_part", F.floor(F.rand(1) * F.col("_parts")).cast("int")).drop("_user", "_parts")
    copies = ordered.join(parts, F.col(key) == F.col("_user")) \
        .select(F.col(key).alias("_user"), F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)).alias("_part"), "_rules")

    def group(left: pa.Table, right: pa.Table) -> pa.Table:
        trie = RuleTrie(_pairs(right.column("_rules")[0].as_py() if right.num_rows else None))
        out = [None if t is None else trie.apply(t) for t in left.column(text_col).to_pylist()]
        return left.select(names).append_column(out_col, pa.array(out, pa.string()))

    return dealt.groupBy(key, "_part").cogroup(copies.groupBy("_user", "_part")).applyInArrow(group, schema)
