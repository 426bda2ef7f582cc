"""Order-preserving packing of documents into fixed windows by dynamic programming.

Documents are tokenized whole, each followed by an end id, and laid one after
the other in table order.  Windows of at most ``WINDOW`` tokens are cut from that
stream at document ends and sentence ends (and, where no sentence ends for
longer than ``HARD_EVERY`` tokens, in between).  A cut costs nothing at a document end,
``SENTENCE_COST`` inside a document and ``HARD_COST`` inside a sentence, in tokens; a
window costs its padding.  The cheapest cuts come from one pass over the
candidates: the best predecessor within a window's reach is kept by a monotone
queue, so the pass is linear.

Every task packs its own part of the table as a stream of bounded blocks,
carrying the last window of a block into the next, so nothing is shuffled and
only the last window of a task can be poorly filled.  ``sequence_id`` is the
task's partition number (upper bits) and a counter, so a repeated task gives
the same rows.

Tokenizing.  The byte-level vocabulary is read from the public tokenizer file.
A block's text is split into the vocabulary's pre-tokens with array operations
over Unicode classes; each distinct pre-token is encoded once and remembered in
a direct-mapped table by its 64-bit hash, so a worker's memory stays bounded.
The file's added tokens (such as its end-of-text string) are split off first and get
their ids, as the tokenizer does.

Defined cases: null or empty text gives the end id alone; texts longer than a
block are tokenized in parts, cut where white space begins, which changes no id;
repeated rows are packed each; null doc_id is kept; other columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

import json
import re
import unicodedata
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_type

from vocalis.llm.common import text_or_empty

WINDOW = 2048
END_ID = 1
SENTENCE_COST = 4
HARD_COST = 32
#: A candidate cut is added inside sentences at least every so many tokens.
HARD_EVERY = 64
#: Code points tokenized at once, tokens packed at once.
TEXT_BLOCK = 1 << 21
TOKEN_BLOCK = 1 << 19

#: The published pre-token expression of the vocabulary (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Code points with the White_Space property (fixed value).
WHITE_SPACE = (*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)

_LETTER, _NUMBER, _SPACE, _OTHER = 0, 1, 2, 3
_SLOTS = 20
_STORE = 1 << 23


def byte_ranks(path: str) -> dict[bytes, int]:
    """Byte string -> id of a byte-level vocabulary file; printable stand-ins of bytes as published for such files."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    byte_of = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    special = {t["content"] for t in spec.get("added_tokens", [])}
    return {bytes(byte_of[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}


def added_ids(path: str) -> dict[str, int]:
    """String -> id of a vocabulary file's added tokens; they are found anywhere in a text, just as they stand."""
    with open(path, encoding="utf-8") as f:
        tokens = json.load(f).get("added_tokens", [])
    if any(t.get(flag) for t in tokens for flag in ("single_word", "lstrip", "rstrip")):
        raise ValueError("added tokens that depend on their neighbours are not supported")
    return {t["content"]: t["id"] for t in tokens}


class Encoder:
    """Ids of whole texts, with a bounded memory of pre-tokens."""

    def __init__(self, ranks: dict[bytes, int], added: dict[str, int] | None = None):
        import tiktoken

        self._added = added or {}
        self._split = re.compile("|".join(map(re.escape, sorted(self._added, key=len, reverse=True))))

        self._bpe = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._classes = np.full(0x110000, _OTHER, dtype=np.uint8)
        for cp in range(0x110000):
            c = unicodedata.category(chr(cp))[0]
            if c == "L":
                self._classes[cp] = _LETTER
            elif c == "N":
                self._classes[cp] = _NUMBER
        self._classes[list(WHITE_SPACE)] = _SPACE
        base = 0x9E3779B97F4A7C15
        n = TEXT_BLOCK + 1
        self._base, self._inverse = base, pow(base, -1, 1 << 64)
        self._powers, self._back = self._series(base, n), self._series(self._inverse, n)
        self.ends_sentence = np.zeros(max(*ranks.values(), *self._added.values()) + 1, dtype=bool)
        for token, i in ranks.items():
            tail = token.rstrip(b"\"')]")
            self.ends_sentence[i] = tail.endswith((b".", b"!", b"?", b"\n"))
        self._reset()

    @staticmethod
    def _series(base: int, n: int) -> np.ndarray:
        """Powers of an odd number modulo 2 ** 64, by doubling."""
        out = np.ones(1, dtype=np.uint64)
        step = base
        while len(out) < n:
            out = np.concatenate([out, out * np.uint64(step)])
            step = step * step % (1 << 64)
        return out

    def _reset(self) -> None:
        self._hash = np.zeros(1 << _SLOTS, dtype=np.uint64)
        self._at = np.zeros(1 << _SLOTS, dtype=np.int32)
        self._count = np.zeros(1 << _SLOTS, dtype=np.int32)
        self._store = np.zeros(_STORE, dtype=np.uint16)
        self._used = 0

    def pre_tokens(self, points: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Starts of the pre-tokens of texts that lie one after the other in ``points``; ``ends`` are the texts' ends."""
        n = len(points)
        cls = self._classes[points]
        fresh = np.zeros(n + 1, dtype=bool)  # a text begins here
        fresh[0] = fresh[ends] = True
        new = fresh[:n].copy()
        new[1:] |= cls[1:] != cls[:-1]
        start = new.copy()
        runs = np.flatnonzero(new)
        after = np.append(runs[1:], n)
        spaces = cls[runs] == _SPACE
        inner = spaces & ~fresh[after]  # white space followed by something else in the same text
        last = after[inner] - 1
        start[last] = True
        glued = points[last] == 32  # the blank before a word belongs to it
        start[after[inner][glued]] = False
        # contractions: an apostrophe that begins a pre-token, before s, t, m, d, re, ve or ll
        q = np.flatnonzero((points == 39) & start)
        q = q[q + 1 < n]
        q = q[~fresh[q + 1]]
        if len(q):
            a = points[q + 1]
            b = np.where((q + 2 < n) & ~fresh[np.minimum(q + 2, n)], points[np.minimum(q + 2, n - 1)], 0)
            one = np.isin(a, [ord(c) for c in "stmd"])
            two = ((a == ord("r")) | (a == ord("v"))) & (b == ord("e")) | (a == ord("l")) & (b == ord("l"))
            for hit, size in ((one, 2), (two & ~one, 3)):
                start[q[hit] + 1] = False
                nxt = q[hit] + size
                start[nxt[nxt < n]] = True
        return np.flatnonzero(start)

    def _ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the texts one after the other, number of ids of each text); at most about TEXT_BLOCK code points."""
        size = np.array([len(t) for t in texts], dtype=np.int64)
        joined = "".join(texts)
        if not joined:
            return np.zeros(0, dtype=np.uint16), np.zeros(len(texts), dtype=np.int64)
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        n = len(points)
        ends = np.cumsum(size)
        start = self.pre_tokens(points, ends)
        stop = np.append(start[1:], n)
        sums = np.zeros(n + 1, dtype=np.uint64)
        if n >= len(self._powers):
            self._powers, self._back = self._series(self._base, n + 1), self._series(self._inverse, n + 1)
        np.cumsum((points.astype(np.uint64) + np.uint64(0x5851F42D)) * self._powers[:n], out=sums[1:])
        key = (sums[stop] - sums[start]) * self._back[start]
        key ^= key >> np.uint64(29)
        key *= np.uint64(0xBF58476D1CE4E5B9)
        key ^= key >> np.uint64(32)
        key |= np.uint64(1)
        slot = (key >> np.uint64(64 - _SLOTS)).astype(np.int64)
        at, count = self._at[slot], self._count[slot]
        missed = np.flatnonzero(self._hash[slot] != key)
        if len(missed):
            if self._used > _STORE // 2:
                self._reset()
                missed = np.arange(len(key))
            fresh, first, which = np.unique(key[missed], return_index=True, return_inverse=True)
            f_at, f_count = np.empty(len(fresh), np.int32), np.empty(len(fresh), np.int32)
            begin, end = start[missed[first]], stop[missed[first]]
            encode = self._bpe.encode_ordinary
            for k in range(len(fresh)):
                ids = encode(joined[begin[k]:end[k]])
                if self._used + len(ids) > len(self._store):
                    self._store = np.concatenate([self._store, np.zeros(max(len(ids), _STORE), np.uint16)])
                f_at[k], f_count[k] = self._used, len(ids)
                self._store[self._used:self._used + len(ids)] = ids
                self._used += len(ids)
            at[missed], count[missed] = f_at[which], f_count[which]
            s = (fresh >> np.uint64(64 - _SLOTS)).astype(np.int64)
            self._hash[s], self._at[s], self._count[s] = fresh, f_at, f_count
        total = np.concatenate([[0], np.cumsum(count, dtype=np.int64)])
        ids = self._store[np.repeat(at - total[:-1], count) + np.arange(total[-1])]
        return ids, np.diff(np.concatenate([[0], total[np.searchsorted(start, ends)]]))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(all ids one after the other, number of ids of each text); added tokens are split off first."""
        if not any(token in text for token in self._added for text in texts):
            return self._ordinary(texts)
        pieces, owner, closing = [], [], []  # closing: the added token's id after a piece, -1 at a text's end
        for k, text in enumerate(texts):
            at = 0
            for m in self._split.finditer(text):
                pieces.append(text[at:m.start()])
                closing.append(self._added[m.group()])
                owner.append(k)
                at = m.end()
            pieces.append(text[at:])
            closing.append(-1)
            owner.append(k)
        ids, n = self._ordinary(pieces)
        closing = np.array(closing)
        held = closing >= 0
        ids = np.insert(ids, np.cumsum(n)[held], closing[held].astype(ids.dtype))
        counts = np.zeros(len(texts), dtype=np.int64)
        np.add.at(counts, owner, n + held)
        return ids, counts

    def _ordinary(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for texts without added tokens."""
        parts, counts = [], []
        i = 0
        while i < len(texts):
            j, chars = i, 0
            while j < len(texts) and (j == i or chars + len(texts[j]) <= TEXT_BLOCK):
                chars += len(texts[j])
                j += 1
            if chars > TEXT_BLOCK:
                pieces = [self._ids([p])[0] for p in _safe_parts(texts[i])]
                parts.extend(pieces)
                counts.append(np.array([sum(map(len, pieces))]))
            else:
                ids, n = self._ids(texts[i:j])
                parts.append(ids)
                counts.append(n)
            i = j
        return (np.concatenate(parts) if parts else np.zeros(0, np.uint16),
                np.concatenate(counts) if counts else np.zeros(0, np.int64))


def _safe_parts(text: str, size: int = TEXT_BLOCK) -> Iterator[str]:
    """Parts of a long text, cut where a run of white space begins: no pre-token spans such a place."""
    i = 0
    while i < len(text):
        j = i + size
        while j < len(text) and not (text[j] in " \n\t" and ord(text[j - 1]) not in WHITE_SPACE):
            j += 1
        yield text[i:j]
        i = j


def best_cuts(at: list[int], cost: list[float], window: int = WINDOW) -> list[int]:
    """Indices of the chosen cuts, first and last included: least padding plus cut costs.

    ``at`` are increasing token positions, neighbours at most ``window`` apart.  With f(i) the cost up to cut i,
    f(j) = cost(j) + window - at(j) + min over at(i) >= at(j) - window of f(i) + at(i): a sliding minimum.
    """
    best = [0.0] * len(at)
    back = [0] * len(at)
    queue: deque[tuple[float, int, int]] = deque([(float(at[0]), at[0], 0)])
    pop, popleft, push = queue.pop, queue.popleft, queue.append
    for j in range(1, len(at)):
        p = at[j]
        while queue[0][1] < p - window:
            popleft()
        value, _, i = queue[0]
        back[j] = i
        value = value + window + cost[j]  # f(j) + at(j)
        best[j] = value - p
        while queue and queue[-1][0] >= value:
            pop()
        push((value, p, j))
    cuts = [len(at) - 1]
    while cuts[-1]:
        cuts.append(back[cuts[-1]])
    return cuts[::-1]


def candidates(ids: np.ndarray, doc_ends: np.ndarray, ends_sentence: np.ndarray,
               window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(positions, costs) of possible cuts in a stream of ids, 0 and its end included."""
    soft = np.flatnonzero(ends_sentence[ids]) + 1
    at = np.union1d(np.concatenate([[0], doc_ends]), soft)
    gap = np.diff(at)
    every = min(HARD_EVERY, window)
    wide = np.flatnonzero(gap > every)
    hard = [np.arange(at[k] + every, at[k + 1], every) for k in wide]
    cost = np.full(len(at), float(SENTENCE_COST))
    cost[np.searchsorted(at, doc_ends)] = 0.0
    cost[0] = 0.0
    if hard:
        more = np.concatenate(hard)
        order = np.argsort(np.concatenate([at, more]), kind="stable")
        at = np.concatenate([at, more])[order]
        cost = np.concatenate([cost, np.full(len(more), float(HARD_COST))])[order]
    return at, cost


class Packer:
    """Packs a stream of (doc, ids); gives the pieces of finished windows:
    doc, start, length, ids_crc32, doc_tokens, sequence_id, offset."""

    def __init__(self, ends_sentence: np.ndarray, first_sequence: int, window: int = WINDOW, block: int = TOKEN_BLOCK):
        self._ends, self._next, self._window, self._block = ends_sentence, first_sequence, window, block
        self._ids: list[np.ndarray] = []
        self._docs: list[tuple[object, int, int, int]] = []  # doc, ids before those here, ids here, all ids
        self._size = 0

    def add(self, doc: object, ids: np.ndarray) -> Iterator[tuple]:
        """One document's ids; a long one is taken in parts."""
        for i in range(0, len(ids), self._block):
            part = ids[i:i + self._block]
            self._ids.append(part)
            self._docs.append((doc, i, len(part), len(ids)))
            self._size += len(part)
            if self._size >= self._block:
                yield from self._flush(False)

    def finish(self) -> Iterator[tuple]:
        yield from self._flush(True)

    def _flush(self, last: bool) -> Iterator[tuple]:
        if not self._size:
            return
        ids = np.concatenate(self._ids)
        doc_end = np.cumsum([d[2] for d in self._docs])
        true_end = doc_end[[d[1] + d[2] == d[3] for d in self._docs]]
        at, cost = candidates(ids, true_end, self._ends, self._window)
        if at[-1] != len(ids):
            at, cost = np.append(at, len(ids)), np.append(cost, 0.0)
        cuts = at[best_cuts(at.tolist(), cost.tolist(), self._window)]
        if not last and len(cuts) > 2:  # the last window goes on into the next block
            cuts = cuts[:-1]
        done = int(cuts[-1])
        points = np.union1d(cuts, doc_end[doc_end < done])
        which = np.searchsorted(doc_end, points[:-1], side="right")
        seq = np.searchsorted(cuts, points[:-1], side="right") - 1
        begin = doc_end - np.array([d[2] for d in self._docs])
        wide = ids.astype("<u4")
        for p, q, d, s in zip(points[:-1].tolist(), points[1:].tolist(), which.tolist(), seq.tolist()):
            doc, before, _, total = self._docs[d]
            yield (doc, before + p - int(begin[d]), q - p, zlib.crc32(wide[p:q].tobytes()), total,
                   self._next + s, p - int(cuts[s]))
        self._next += len(cuts) - 1
        keep = int(np.searchsorted(doc_end, done, side="right"))
        rest = []
        for d in range(keep, len(self._docs)):
            doc, before, here, total = self._docs[d]
            cut = max(0, done - int(begin[d]))
            rest.append((doc, before + cut, here - cut, total))
        self._docs, self._ids, self._size = rest, [ids[done:]], len(ids) - done


def pack(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    rows = docs.select("doc_id", text_or_empty().alias("text"))
    ranks = docs.sparkSession.sparkContext.broadcast(byte_ranks(tokenizer_path))  # one vocabulary
    added = added_ids(tokenizer_path)
    schema = (f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, start long, length long, ids_crc32 long, "
              "doc_tokens long, sequence_id long, offset long")

    kind = docs.schema["doc_id"].dataType
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = Encoder(ranks.value, added)
        packer = Packer(enc.ends_sentence, TaskContext.get().partitionId() << 32, window)
        end = np.array([end_id], dtype=np.uint16)

        def batch_of(out: list[tuple]) -> pa.RecordBatch:
            cols = list(zip(*out))
            return pa.RecordBatch.from_arrays(
                [pa.array(cols[0], to_arrow_type(kind)), *(pa.array(c, pa.int64()) for c in cols[1:])], names=names)

        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            out: list[tuple] = []
            i = 0
            while i < len(texts):  # a few MB of text at once
                j, chars = i, 0
                while j < len(texts) and (j == i or chars + len(texts[j]) <= TEXT_BLOCK):
                    chars += len(texts[j])
                    j += 1
                flat, counts = enc.encode(texts[i:j])
                at = 0
                for doc, n in zip(ids[i:j], counts.tolist()):
                    out.extend(packer.add(doc, np.concatenate([flat[at:at + n], end])))
                    at += n
                i = j
            if out:
                yield batch_of(out)
        if out := list(packer.finish()):
            yield batch_of(out)

    return rows.mapInArrow(run, schema)
