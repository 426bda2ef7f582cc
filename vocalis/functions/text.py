"""Text Column functions: tokenisation, WER/CER, quote and fence handling.

Everything here is a built-in Spark expression (JVM side, whole-stage
codegen friendly); nothing crosses into Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The whitespace characters Python's ``str.split()`` splits on,
# written as a regex class both Java and RE2 accept.
PY_WHITESPACE = (
    r"[\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)
WS_RUN = PY_WHITESPACE + "+"

# Token codes are characters from U+0100 on without the surrogate block, so
# one pair may hold this many distinct tokens; more is an error.
_CODE_BASE = 0x100
_SURROGATES, _N_SURROGATES = 0xD800, 0x800
MAX_DISTINCT_TOKENS = 0x110000 - _N_SURROGATES - _CODE_BASE


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokenize(c: Column | str) -> Column:
    """lower-case, split on whitespace runs, drop empty tokens."""
    return F.array_remove(F.split(F.lower(_c(c)), WS_RUN), "")


def word_list(c: Column | str) -> Column:
    """split on a single space, keeping empty words."""
    return F.split(_c(c), " ", -1)


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once per row and pass it to ``body`` as a lambda
    variable (a one-element ``transform``), so an expensive sub-expression
    used several times inside other lambdas is not recomputed."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _encode(tokens: Column, vocab: Column) -> Column:
    """Map every token to one character (its index in ``vocab``)."""
    def code(x: Column) -> Column:
        return let(F.array_position(vocab, x) + F.lit(_CODE_BASE - 1), lambda c: F.lpad(F.hex(
            F.when(c >= _SURROGATES, c + _N_SURROGATES).otherwise(c)), 8, "0"))
    return F.decode(F.unhex(F.array_join(F.transform(tokens, code), "")), "UTF-32")


def token_edit_distance(ref_tokens: Column, hyp_tokens: Column) -> Column:
    """Levenshtein distance over token arrays, computed by the built-in
    character ``levenshtein`` after encoding each distinct token of the
    pair as one character.  A pair with more distinct tokens than there are
    characters (over a million) raises an error.
    """
    def body(p):
        vocab = F.array_distinct(F.concat(p["r"], p["h"]))
        return let(vocab, lambda v: F.when(
            F.size(v) <= MAX_DISTINCT_TOKENS,
            F.levenshtein(_encode(p["r"], v), _encode(p["h"], v)))
            .otherwise(F.raise_error(F.lit("too many distinct tokens in one pair")).cast("int")))
    return let(F.struct(ref_tokens.alias("r"), hyp_tokens.alias("h")), body)


def wer_from_tokens(ref_tokens: Column, hyp_tokens: Column, distance: Column | None = None) -> Column:
    d = token_edit_distance(ref_tokens, hyp_tokens) if distance is None else distance
    n = F.size(ref_tokens)
    return F.when(n == 0, F.lit(0.0)).otherwise(F.round(d / n, 4))


def wer(ref: Column | str, hyp: Column | str) -> Column:
    """word error rate = token edit distance / reference length, 4 dp.

    0.0 when the reference has no tokens (even if the hypothesis has some);
    may exceed 1.0.
    """
    return let(F.struct(tokenize(ref).alias("r"), tokenize(hyp).alias("h")),
               lambda p: wer_from_tokens(p["r"], p["h"]))


def cer(ref: Column | str, hyp: Column | str) -> Column:
    """character error rate = char edit distance / reference length, 4 dp."""
    r, h = _c(ref), _c(hyp)
    n = F.char_length(r)
    return F.when(n == 0, F.lit(0.0)).otherwise(F.round(F.levenshtein(r, h) / n, 4))


def strip_ws(c: Column | str) -> Column:
    """Trim every whitespace character (JS/Python ``trim``), not only spaces."""
    return F.regexp_replace(_c(c), f"^{WS_RUN}|{WS_RUN}$", "")


def is_blank(c: Column | str) -> Column:
    return F.coalesce(strip_ws(c) == F.lit(""), F.lit(True))


def strip_fences(c: Column | str) -> Column:
    """trim; if the text starts with a code fence, drop the first line and
    a trailing fence and trim again."""
    x = strip_ws(c)
    body = F.regexp_replace(x, r"^[^\n]*(\n|$)", "")
    body = F.regexp_replace(body, r"```" + PY_WHITESPACE + r"*$", "")
    return F.when(x.startswith("```"), strip_ws(body)).otherwise(x)


def strip_quotes(c: Column | str) -> Column:
    """if the text is wrapped in double (else single) quotes, drop one
    pair and trim what is inside; otherwise return it unchanged."""
    x = _c(c)
    wrapped = (x.startswith('"') & x.endswith('"')) | (x.startswith("'") & x.endswith("'"))
    inner = x.substr(F.lit(2), F.greatest(F.char_length(x) - 2, F.lit(0)))
    return F.when(wrapped, strip_ws(inner)).otherwise(x)


def unescape_quotes(c: Column | str) -> Column:
    """``\\"`` becomes ``"``."""
    return F.replace(_c(c), F.lit('\\"'), F.lit('"'))


# Default filler words of a speaking style.
DEFAULT_FILLERS = ["um", "uh", "like", "you know"]


def filler_pattern(fillers: Column) -> Column:
    """Case-insensitive alternation of the filler phrases, longest first,
    regex metacharacters escaped, inner spaces matching any whitespace run."""
    by_length = F.sort_array(F.transform(fillers, lambda w: F.struct((-F.char_length(w)).alias("k"), w.alias("w"))))
    escaped = F.transform(
        by_length,
        lambda s: F.regexp_replace(F.regexp_replace(s["w"], r"([\\.^$|?*+()\[\]{}])", r"\\$1"), " +", r"\\s+"),
    )
    return F.concat(F.lit(r"(?i)(^|\s)("), F.array_join(escaped, "|"), F.lit(r")(\s|$)"))


def remove_fillers(text: Column | str, fillers: Column | None = None) -> Column:
    """drop whole-word filler words/phrases (case-insensitive) and
    normalise the whitespace left behind to single spaces.

    Separators are doubled first so that back-to-back fillers each keep a
    space of their own; no look-around is needed, which keeps the same
    pattern valid for RE2 engines.
    """
    words = fillers if fillers is not None else F.array(*[F.lit(w) for w in DEFAULT_FILLERS])
    doubled = F.regexp_replace(_c(text), WS_RUN, "  ")
    out = F.regexp_replace(doubled, filler_pattern(words), F.lit(" "))
    return strip_ws(F.regexp_replace(out, WS_RUN, " "))
