"""Edit distance and alignment from furthest-reaching diagonals.

For e = 0, 1, 2, ... errors and every diagonal k (hypothesis position minus reference position), ``reach[e][k]``
is the furthest reference position that e errors can get to on k.  An error moves one step from the neighbouring
diagonals or along its own, and equal tokens cost nothing, so a pair of n tokens with d errors takes O(n + d * d)
steps in the usual case and O(n * d) in the worst, where the full matrix takes n * m.  Few errors are counted with
plain lists, many with one array operation per error.

The distance at (i, j) is the least e with ``reach[e][j - i] >= i``, so the stored reaches answer every question the
matrix would, and the path is the one the matrix gives under its tie rule: hit or substitution first, then deletion,
then insertion.  Memory is the text plus d * d.

For a pair of many errors the diagonals hand over to the matrix in bits: the vertical differences of a column are two
whole numbers of ``BIT_BLOCK`` bits, so a token costs a few operations on them whatever the number of errors.  The path
reads two bits a cell, whether the step along the diagonal is free and whether the one down costs; they are kept for one
block of rows at a time, made again from the differences that enter it from above, so memory stays near ``PATH_BYTES``
plus a byte a column and block.
"""

from __future__ import annotations

import math

import numpy as np

#: Errors up to which reaches are stored (4 bytes each, about MAX_ERRORS ** 2 of them).
MAX_ERRORS = 6000
#: Errors up to which lists are quicker than arrays.
LIST_ERRORS = 48

#: Errors after which a pair is judged: one that would need more errors than allowed at this rate is not followed further.
PROBE_ERRORS = 8

#: Reference tokens held in one number.
BIT_BLOCK = 1 << 14
#: Bytes of cells that a path keeps, where its blocks have at least ``PATH_ROWS`` rows.
PATH_BYTES = 64 << 20
PATH_ROWS = 1 << 10

_NOWHERE = -(1 << 30)


def _common_prefix(a, b, i: int, j: int) -> int:
    n, m = len(a), len(b)
    while i < n and j < m and a[i] == b[j]:
        i, j = i + 1, j + 1
    return i


def _next_list(prev: list[int], e: int, a, b) -> list[int]:
    n, m = len(a), len(b)
    cur = []
    for k in range(-e, e + 1):
        at = k + e - 1  # where diagonal k lies in prev
        best = max(prev[at] + 1 if 0 <= at < len(prev) else _NOWHERE, prev[at - 1] if 0 < at <= len(prev) else _NOWHERE,
                   prev[at + 1] + 1 if -2 < at < len(prev) - 1 else _NOWHERE)
        best = min(best, n, m - k)
        cur.append(_common_prefix(a, b, best, best + k) if best >= max(0, -k) else _NOWHERE)
    return cur


def _slide(reach: np.ndarray, k: np.ndarray, a: np.ndarray, b: np.ndarray, n: int, m: int) -> None:
    """Move every reach along its equal tokens; ``a`` and ``b`` are padded with unlike values."""
    live = np.flatnonzero(reach >= 0)
    live = live[a[reach[live]] == b[reach[live] + k[live]]]  # most do not move
    reach[live] += 1
    step, most = 4, len(a) - n
    while len(live):
        span = np.arange(step)
        at = reach[live][:, None] + span
        unlike = a[at] != b[at + k[live][:, None]]
        stop = unlike.any(axis=1)
        reach[live] += np.where(stop, unlike.argmax(axis=1), step).astype(reach.dtype)
        live = live[~stop]
        step = min(step * 4, most)


def _next_array(prev: np.ndarray, e: int, a: np.ndarray, b: np.ndarray, n: int, m: int) -> np.ndarray:
    wide = np.full(2 * e + 3, _NOWHERE, dtype=np.int32)
    wide[2:-2] = prev
    k = np.arange(-e, e + 1, dtype=np.int32)
    cur = np.minimum(np.maximum(np.maximum(wide[1:-1], wide[2:]) + 1, wide[:-2]), np.minimum(n, m - k))
    cur[cur < np.maximum(0, -k)] = _NOWHERE
    _slide(cur, k, a, b, n, m)
    return cur


_PAD = 256


def reaches(a, b, most: int = MAX_ERRORS, probe: bool = False) -> list | None:
    """The reaches for 0, 1, ... errors up to those that align all of ``a`` and ``b``; None beyond ``most`` errors.

    With ``probe`` also None for a pair that is not likely to get there: the errors went on at the rate of the first."""
    n, m = len(a), len(b)
    goal = m - n
    if abs(goal) > most:
        return None
    rows: list = [[_common_prefix(a, b, 0, 0)]]
    arrays = None
    while not (abs(goal) < len(rows) and rows[-1][goal + len(rows) - 1] >= n):
        e = len(rows)
        if e > most or probe and e == PROBE_ERRORS and most * max(rows[-1]) < e * min(n, m):
            return None
        if e <= LIST_ERRORS:
            rows.append(_next_list(rows[-1], e, a, b))
            continue
        if arrays is None:
            numbers: dict = {}
            arrays = [np.array([*(numbers.setdefault(t, len(numbers)) for t in x), *[pad] * _PAD], dtype=np.int32)
                      for x, pad in ((a, -1), (b, -2))]
            rows = [np.array(r, dtype=np.int32) for r in rows]
        rows.append(_next_array(rows[-1], e, *arrays, n, m))
    return rows


# ------------------------------------------------------------------ the matrix
def _next_row(prev: np.ndarray, i: int, ai: int, b: np.ndarray, ramp: np.ndarray) -> np.ndarray:
    """With d[j] = min(prev[j] + 1, prev[j-1] + cost) the insertions are a prefix minimum of d[k] - k."""
    d = np.empty_like(prev)
    d[0] = i
    np.minimum(prev[1:] + 1, prev[:-1] + (b != ai), out=d[1:])
    return np.minimum.accumulate(d - ramp) + ramp


def _bit_block(block, b, into: list[int] | None, cells: list | None = None) -> tuple[int, int]:
    """Columns of a block of rows from its vertical differences in bits; those of the last column are returned, rows that
    cost one more than the row above and rows that cost one less.

    ``into``, the horizontal differences that enter the block from above, become those that leave it; None: all are one and
    none is asked for.  ``cells`` gets per column the rows reached free of cost along the diagonal and those that cost one
    more than the row above.
    """
    top, full = len(block) - 1, (1 << len(block)) - 1
    where: dict = {}
    for row, token in enumerate(block):
        where[token] = where.get(token, 0) | 1 << row
    more, less, find = full, 0, where.get
    for j, token in enumerate(b):
        equal = find(token, 0)
        vertical = equal | less
        if into is None:
            free = (((equal & more) + more) ^ more) | vertical
            fall, level = (more & free) << 1, ((free | more) ^ less) << 1  # one less than, and not more than to the left
        else:
            above = into[j]
            if above < 0:
                equal |= 1
            free = ((((equal & more) + more) ^ more) | equal | less) & full
            fall, level = more & free, (free | more) ^ less
            into[j] = 1 - (level >> top) - (fall >> top)
            fall, level = fall << 1 | (above < 0), level << 1 | (above <= 0)
        both = vertical & level
        less = vertical ^ both
        more = (fall | level ^ both) & full
        if cells is not None:
            cells.append((free, more))
    return more, less


def bit_distance(a, b) -> int:
    """Number of errors, from columns of vertical differences in bits; ``a`` is cut into blocks of rows."""
    if not len(a) or not len(b):
        return len(a) + len(b)
    if len(a) <= BIT_BLOCK:
        more, less = _bit_block(a, b, None)
        return len(b) + more.bit_count() - less.bit_count()
    into = [1] * len(b)
    for at in range(0, len(a), BIT_BLOCK):
        _bit_block(a[at:at + BIT_BLOCK], b, into)
    return len(a) + sum(into)


def bit_path(a, b) -> list:
    """The matrix's path from bits, block by block from the last rows; each block's columns are made when the path gets there."""
    height = min(BIT_BLOCK, max(PATH_ROWS, 4 * PATH_BYTES // max(1, len(b))))
    tops = range(0, len(a), height)
    into, entering = [1] * len(b), []
    for top in tops:
        entering.append(bytes(x + 1 for x in into))
        if top != tops[-1]:
            _bit_block(a[top:top + height], b, into)
    i, j, ops = len(a), len(b), []
    for top in reversed(tops):
        cells: list = []
        above = entering.pop()
        _bit_block(a[top:top + height], b[:j], [x - 1 for x in above] if top else None, cells)
        while i > top:
            if j and a[i - 1] == b[j - 1]:
                i, j = i - 1, j - 1
                ops.append(("hit", i, j))
                continue
            free, costs = cells[j - 1] if j else (-1, -1)
            row = i - 1 - top
            if not free >> row & 1:
                i, j = i - 1, j - 1
                ops.append(("sub", i, j))
            elif costs >> row & 1:
                i -= 1
                ops.append(("del", i, None))
            else:
                j -= 1
                ops.append(("ins", None, j))
    ops.extend(("ins", None, at) for at in range(j - 1, -1, -1))
    return ops[::-1]


def matrix_path(a: np.ndarray, b: np.ndarray) -> list:
    n, m = len(a), len(b)
    ramp = np.arange(m + 1, dtype=np.int64)
    step = max(1, math.isqrt(n))
    row, kept = ramp, [ramp]
    for i in range(1, n + 1):
        row = _next_row(row, i, a[i - 1], b, ramp)
        if i % step == 0:
            kept.append(row)
    i, j, ops, base, rows = n, m, [], -1, []
    while i > 0 or j > 0:
        if i and (i - 1) // step * step != base:
            base = (i - 1) // step * step
            rows = [kept[base // step]]
            for r in range(base + 1, i + 1):
                rows.append(_next_row(rows[-1], r, a[r - 1], b, ramp))
        if i and j and rows[i - base][j] == rows[i - base - 1][j - 1] + (a[i - 1] != b[j - 1]):
            ops.append(("hit" if a[i - 1] == b[j - 1] else "sub", i - 1, j - 1))
            i, j = i - 1, j - 1
        elif i and rows[i - base][j] == rows[i - base - 1][j] + 1:
            ops.append(("del", i - 1, None))
            i -= 1
        else:
            ops.append(("ins", None, j - 1))
            j -= 1
    return ops[::-1]


# ------------------------------------------------------------------ results
def _worth(a, b) -> int:
    """Errors up to which diagonals cost less than bits."""
    short, long = sorted((len(a), len(b)))
    return math.isqrt(short * (1 + long // 1000)) + 2


def distance(a, b) -> int:
    """Number of errors between two sequences of tokens (of whole numbers from 0, or of strings)."""
    if len(a) > len(b):
        a, b = b, a
    rows = reaches(a, b, _worth(a, b), probe=True)
    return len(rows) - 1 if rows is not None else bit_distance(a, b)


def align(a, b) -> list:
    """Optimal alignment as (op, ref_pos, hyp_pos) triples."""
    a, b = (x.tolist() if isinstance(x, np.ndarray) else x for x in (a, b))
    rows = reaches(a, b, min(MAX_ERRORS, _worth(a, b)), probe=True)
    if rows is None:
        return bit_path(a, b)
    i, j, e, ops = len(a), len(b), len(rows) - 1, []

    def within(i: int, k: int, e: int) -> bool:
        return abs(k) <= e and rows[e][k + e] >= i

    while i or j:
        if i and j and a[i - 1] == b[j - 1]:
            i, j = i - 1, j - 1
            ops.append(("hit", i, j))
        elif i and j and within(i - 1, j - i, e - 1):
            i, j, e = i - 1, j - 1, e - 1
            ops.append(("sub", i, j))
        elif i and within(i - 1, j - i + 1, e - 1):
            i, e = i - 1, e - 1
            ops.append(("del", i, None))
        else:
            j, e = j - 1, e - 1
            ops.append(("ins", None, j))
    return ops[::-1]
