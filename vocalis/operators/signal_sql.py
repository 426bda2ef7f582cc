"""Array-expression forms of simple signal operators.

These run as built-in higher-order functions on ``array<float>`` columns,
for signals already decoded into arrays; the numpy versions in
``vocalis.operators.signal`` are used inside the Arrow audio jobs.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vocalis.functions.text import let

SHIFT = 6  # samples rolled by the registered check
AMIN, TOP_DB = 1e-10, 80.0  # fixed values: power_to_db floor and dynamic range


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def roll(a: Column | str, shift: int | Column) -> Column:
    """Circular roll to the right by ``shift`` samples (numpy ``roll``)."""
    x = _c(a)
    n = F.size(x)
    s = F.pmod(F.lit(shift) if isinstance(shift, int) else shift, F.greatest(n, F.lit(1)))
    head = F.slice(x, n - s + 1, s)
    tail = F.slice(x, F.lit(1), n - s)
    return F.when(s == 0, x).otherwise(F.concat(head, tail))


def power_to_db(power: Column | str, amin: float = AMIN, top_db: float = TOP_DB, digits: int | None = None) -> Column:
    """10*log10(max(amin, S)) relative to the array maximum, floored
    ``top_db`` below the peak."""
    p = _c(power)

    def with_ref(p_arr):
        ref_db = F.lit(10.0) * F.log10(F.greatest(F.lit(amin), F.array_max(p_arr)))
        return let(ref_db, lambda ref: F.transform(
            p_arr, lambda x: F.lit(10.0) * F.log10(F.greatest(F.lit(amin), x)) - ref))

    def floor_it(db):
        return let(F.array_max(db) - F.lit(top_db), lambda lo: F.transform(
            db, lambda x: F.round(F.greatest(x, lo), digits) if digits is not None else F.greatest(x, lo)))
    return let(let(p, with_ref), floor_it)


def pcm16_samples(a: Column | str) -> Column:
    """D13 sample mapping: clamp to [-1, 1]; negative x 32768, else x 32767,
    truncated to a 16-bit integer."""
    def one(x):
        c = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), x.cast("double")))
        return F.when(c < 0, c * 32768).otherwise(c * 32767).cast("int")
    return F.transform(_c(a), one)
