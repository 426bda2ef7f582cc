"""Frames of bounded size for Python stages whose rows hold audio or features.

Spark cuts what goes into such a stage by bytes, but sends on whatever frame the stage yields; a frame of all the rows
of one input batch would hold gigabytes of features.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping, Sequence

import pandas as pd

#: Bytes of audio or features and rows of a frame that a stage hands on.
FRAME_BYTES = 4 << 20
FRAME_ROWS = 4096


def frames(rows: Iterable[tuple], columns: Sequence[str], payload: int | None = None,
           dtypes: Mapping[str, type] | None = None) -> Iterator[pd.DataFrame]:
    """``rows`` as data frames; one ends with the row whose ``payload`` field (an array or bytes) fills it."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        if payload is not None and row[payload] is not None:
            size += memoryview(row[payload]).nbytes
        if size >= FRAME_BYTES or len(held) >= FRAME_ROWS:
            yield _frame(held, columns, dtypes)
            held, size = [], 0
    if held:
        yield _frame(held, columns, dtypes)


def _frame(rows: list[tuple], columns: Sequence[str], dtypes: Mapping[str, type] | None) -> pd.DataFrame:
    frame = pd.DataFrame(dict(zip(columns, map(list, zip(*rows)))), columns=list(columns))
    return frame.astype(dtypes) if dtypes else frame
