"""Sliding-window admission of one client's requests (used by W4 and T4)."""

from __future__ import annotations

import numpy as np


def admit(ts: np.ndarray, limit: int, window: int, recent: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(allowed, wait) of time-sorted requests; ``recent`` holds the last admitted times and is brought up to date.

    A request is admitted when fewer than ``limit`` admitted ones are younger than the window.  While the window is
    full, nothing is admitted before its oldest entry ends, so a binary search jumps there and the requests in
    between are refused together.
    """
    allowed = np.zeros(len(ts), dtype=bool)
    wait = np.zeros(len(ts), dtype=np.int64)
    i = 0
    while i < len(ts):
        if len(recent) >= limit:
            free = recent[-limit] + window
            j = i + int(np.searchsorted(ts[i:], free))
            wait[i:j] = free - ts[i:j]
            i = j
            if i == len(ts):
                break
        allowed[i] = True
        recent.append(int(ts[i]))
        i += 1
    del recent[:-limit]
    return allowed, wait
