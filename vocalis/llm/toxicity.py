"""Toxicity: a support vector machine over a subsequence string kernel with Nyström landmarks.

Kernel.  Two words are compared by the four-character subsequences they share,
each occurrence weighted by ``DECAY`` to the power of its gaps, spans of at
most six characters.  So ``idiot`` and ``idxiot`` still share most of theirs.
Words are lower-cased, stripped of everything but letters (digits and ``@`` that
stand for letters count as those), given start and end marks, and cut into
units of at most 24 characters; runs of single letters (``i d i o t``) count as
one word.  The kernel is scaled by a norm that depends on the length alone,
which keeps it positive semidefinite and lets scores be sums over positions.

Model.  Landmark words give the Nyström features; a linear squared-hinge SVM
is trained on them.  Labels belong to whole texts, so sentences of a toxic text
are weak positives: its most telling words are the positives, chosen again
after each fit (multiple-instance learning); the words of clean texts are the
negatives.  A text's margin is that of its most toxic word, its score a
logistic function of the margin.

Scoring.  SVM weights and landmarks fold into one table over four-character
subsequences (``ALPHABET ** 4`` floats, 10 MB, whatever the data), which is
broadcast; scoring is a streaming pass without shuffle over whole texts.

Fit on a bounded sample: at most ``SAMPLE_DOCS`` labelled texts per class (those
with the smallest hash), at most ``SAMPLE_SENTENCES`` sentences of each, at most
``SENTENCE_CHARS`` code points per sentence, gathered in one task.

Defined cases: null, empty or wordless text has no toxic word and gets the
lowest score; null labels are ignored, of several labels the highest counts;
with one class only every text gets that class; repeated rows are each scored;
other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import itertools
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vocalis.llm.common import text_or_empty, with_columns_from_text

SAMPLE_DOCS = 800
SAMPLE_SENTENCES = 100
SENTENCE_CHARS = 300
LANDMARKS = 128
UNIT_CHARS = 24
DECAY = 0.6
MAX_SPAN = 6
#: Clean units in one fit at most, a third each of the most frequent, the hardest so far and a random sample: half of this.
MAX_UNITS = 60_000
#: Characters scored at once.
CHUNK = 1 << 21

LETTERS = "abcdefghijklmnopqrstuvwxyzéèêçñóíáäöüß"
ALPHABET = len(LETTERS) + 2
_START, _END = len(LETTERS), len(LETTERS) + 1
#: Digits and signs read as letters.
LOOK_ALIKE = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a"}
_SPACE, _TEXT_END, _DROP = 255, 254, 253

#: Offsets of the three later characters of a subsequence, by span.
PATTERNS = [p for p in itertools.combinations(range(1, MAX_SPAN), 3)]


def _symbols() -> np.ndarray:
    """Code point -> symbol."""
    out = np.full(0x110000, _DROP, dtype=np.uint8)
    for cp in range(0x3000):
        c = chr(cp)
        if c.isspace():
            out[cp] = _SPACE
        elif c in LETTERS:
            out[cp] = LETTERS.index(c)
        elif c in LOOK_ALIKE:
            out[cp] = LETTERS.index(LOOK_ALIKE[c])
        elif c.isalpha():
            base = unicodedata.normalize("NFKD", c)[0]
            out[cp] = LETTERS.index(base) if base in LETTERS else cp % 26
    out[0x3000] = _SPACE
    out[0x3001:] = np.arange(0x3001, 0x110000) % 26
    return out


_TABLE: np.ndarray | None = None


def _norms() -> np.ndarray:
    """Norm of a unit by its length with marks."""
    n = np.zeros(UNIT_CHARS + 3)
    for length in range(len(n)):
        n[length] = sum(DECAY ** (2 * (p[2] - 3)) * max(0, length - p[2]) for p in PATTERNS)
    return np.sqrt(np.maximum(n, 1.0)).astype(np.float32)


def units(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(stream of symbols, unit starts, text number of each unit) of some texts."""
    global _TABLE
    if _TABLE is None:
        _TABLE = _symbols()
    lowered = [t.lower() for t in texts]
    points = np.frombuffer("".join(lowered).encode("utf-32-le"), dtype=np.uint32)
    flat = np.insert(_TABLE[points], np.cumsum([len(t) for t in lowered]), _TEXT_END)
    flat = flat[flat != _DROP]

    def runs(s: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        word = s < _DROP
        edge = np.flatnonzero(np.diff(np.concatenate([[False], word, [False]]).view(np.int8)))
        return word, edge[::2], edge[1::2]

    word, begin, end = runs(flat)
    single = end - begin == 1
    if len(begin) > 1:
        joined = single[:-1] & single[1:] & (begin[1:] - end[:-1] == 1)
        gaps = end[:-1][joined]
        gaps = gaps[flat[gaps] == _SPACE]
        if len(gaps):
            flat = np.delete(flat, gaps)
            word, begin, end = runs(flat)
    owner = np.searchsorted(np.flatnonzero(flat == _TEXT_END), begin)
    length = end - begin
    pieces = -(-length // UNIT_CHARS)
    size = np.full(int(pieces.sum()), UNIT_CHARS)
    if len(size):
        size[np.cumsum(pieces) - 1] = length - (pieces - 1) * UNIT_CHARS
    start = np.concatenate([[0], np.cumsum(size + 2)]).astype(np.int64)
    stream = np.empty(start[-1], dtype=np.uint8)
    inner = np.ones(start[-1], dtype=bool)
    inner[start[:-1]] = inner[start[1:] - 1] = False
    stream[start[:-1]], stream[start[1:] - 1] = _START, _END
    stream[inner] = flat[word]
    return stream, start, np.repeat(owner, pieces)


def subsequences(stream: np.ndarray, start: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """(position, code, weight) of all occurrences inside units, pattern by pattern."""
    s = stream.astype(np.int32)
    room = np.repeat(start[1:], np.diff(start)) - np.arange(len(s))
    for a, b, c in PATTERNS:
        n = len(s) - c
        if n <= 0:
            continue
        at = np.flatnonzero(room[:n] > c)
        code = ((s[at] * ALPHABET + s[at + a]) * ALPHABET + s[at + b]) * ALPHABET + s[at + c]
        yield at, code, DECAY ** (c - 3)


@dataclass
class Model:
    """``weights``: code -> contribution to the margin before the norm; score = logistic(slope * margin + shift)."""
    weights: np.ndarray = field(repr=False)
    bias: float
    slope: float
    shift: float

    def unit_margins(self, stream: np.ndarray, start: np.ndarray) -> np.ndarray:
        s = stream.astype(np.int32)
        room = (np.repeat(start[1:], np.diff(start)) - np.arange(len(s))).astype(np.int16)
        total = np.zeros(len(s), dtype=np.float32)
        first = s * (ALPHABET ** 3)
        for a, b, c in PATTERNS:
            n = len(s) - c
            if n > 0:
                code = first[:n] + s[a:a + n] * (ALPHABET ** 2) + s[b:b + n] * ALPHABET + s[c:]
                value = self.weights[code]
                value *= np.float32(DECAY ** (c - 3))
                value[room[:n] <= c] = 0
                total[:n] += value
        size = np.diff(start)
        return np.add.reduceat(total, start[:-1]) / _norms()[size] + self.bias if len(size) else np.zeros(0)

    def margins(self, texts: list[str]) -> np.ndarray:
        """Margin of each text's most toxic unit; without units the margin of an empty unit."""
        out = np.full(len(texts), min(self.bias, -1.0))
        stream, start, owner = units(texts)
        if len(owner):
            m = self.unit_margins(stream, start)
            first = np.flatnonzero(np.diff(np.concatenate([[-1], owner])))
            out[owner[first]] = np.maximum.reduceat(m, first)
        return out

    def scores(self, texts: list[str]) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * self.margins(texts) + self.shift, -30, 30)))


def _distinct(a: np.ndarray) -> np.ndarray:
    a = np.sort(a)
    return a[np.concatenate([[True], a[1:] != a[:-1]])] if len(a) else a


def _svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, reg: float = 1e-3, steps: int = 12) -> np.ndarray:
    """Linear squared-hinge SVM by Newton steps on the active rows; the last column of ``x`` is constant."""
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        active = y * (x @ w) < 1
        xa = x[active]
        hess = (xa * weight[active, None]).T @ xa + reg * np.eye(len(w))
        nxt = np.linalg.solve(hess, xa.T @ (weight[active] * y[active]))
        if np.abs(nxt - w).max() < 1e-4:
            return nxt
        w = nxt
    return w


def _logistic(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the score, fitted to smoothed targets (Platt)."""
    pos = max(1, int(y.sum()))
    neg = max(1, int((1 - y).sum()))
    target = np.where(y == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    rows = np.where(y == 1, 0.5 / pos, 0.5 / neg)
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        g = rows * (p - target)
        h = rows * np.maximum(p * (1 - p), 1e-6)
        x = np.stack([margin, np.ones_like(margin)])
        step = np.linalg.solve((x * h) @ x.T + 1e-4 * np.eye(2), x @ g + 1e-4 * np.array([a - 4.0, 0.0]))
        a, b = a - step[0], b - step[1]
    return max(a, 0.1), b


def fit(sentences: list[str], text_of: np.ndarray, toxic: np.ndarray, landmarks: int = LANDMARKS,
        rounds: int = 4, seed: int = 7) -> Model:
    """Model from sentences, the text number of each sentence and the 0/1 label of each text."""
    none = np.zeros(ALPHABET ** 4, dtype=np.float32)
    if len(toxic) == 0 or toxic.min() == toxic.max():
        return Model(none, 0.0, 0.0, 4.0 if len(toxic) and toxic[0] else -4.0)
    rng = np.random.default_rng(seed)
    stream, start, owner = units(sentences)
    # equal units of one text count once
    width = UNIT_CHARS + 2
    size = np.diff(start)
    padded = np.full((len(size), width), 255, dtype=np.uint8)
    col = np.arange(len(stream)) - np.repeat(start[:-1], size)
    padded[np.repeat(np.arange(len(size)), size), col] = stream
    kinds, kind = np.unique(padded.view(f"S{width}").ravel(), return_inverse=True)
    pair = _distinct(text_of[owner] * np.int64(len(kinds)) + kind)
    text, kind = pair // len(kinds), pair % len(kinds)
    rows = np.frombuffer(kinds.tobytes().ljust(len(kinds) * width, b"\0"), dtype=np.uint8).reshape(len(kinds), width)
    length = (rows != 255).sum(axis=1)
    kstart = np.concatenate([[0], np.cumsum(length)]).astype(np.int64)
    kstream = rows[rows != 255]
    unit_at = np.repeat(np.arange(len(kinds)), length)
    norm = _norms()[length]

    # how much more often a subsequence is in toxic texts than in clean ones, in standard errors
    found = [(unit_at[at].astype(np.int32), code, np.full(len(at), w, np.float32))
             for at, code, w in subsequences(kstream, kstart)]
    cu, cc, cw = (np.concatenate(x) for x in zip(*found))
    del found
    seen, inv = np.unique(cc, return_inverse=True)
    order = np.argsort(cu, kind="stable")
    inv, cw = inv[order].astype(np.int32), cw[order]
    bounds = np.searchsorted(cu[order], np.arange(len(kinds) + 1))
    cu = cu[order]
    del cc, order

    def places(ks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position in ``ks``, place in ``inv``) of all subsequences of some units."""
        reps = np.diff(bounds)[ks]
        first = bounds[:-1][ks] - np.concatenate([[0], np.cumsum(reps)[:-1]])
        return np.repeat(np.arange(len(ks)), reps), np.repeat(first, reps) + np.arange(reps.sum())

    count = np.zeros((2, len(seen)))
    edge = np.searchsorted(text, np.arange(len(toxic) + 1))
    for t, (i, j) in enumerate(zip(edge[:-1], edge[1:])):
        if i < j:
            count[toxic[t], _distinct(inv[places(kind[i:j])[1]])] += 1
    n1, n0 = toxic.sum(), (1 - toxic).sum()
    f1, f0 = count[1] / n1, count[0] / n0
    lift = (f1 - f0) / np.sqrt((f1 + 1 / n1) / n1 + (f0 + 1 / n0) / n0)
    score = np.bincount(cu, weights=lift[inv] * cw, minlength=len(kinds)) / norm

    # landmarks: telling words unlike one another, then words of clean texts
    clean = np.bincount(kind, weights=1 - toxic[text], minlength=len(kinds))
    telling = [k for k in np.argsort(-score)[:20 * landmarks] if clean[k] == 0]
    common = list(np.argsort(-clean)[:landmarks // 4]) + list(rng.permutation(np.flatnonzero(clean > 0))[:landmarks // 4])

    chosen: list[int] = []
    sets: list[set] = []
    for k in telling:
        own = set(inv[bounds[k]:bounds[k + 1]].tolist())
        if own and all(len(own & s) < 0.6 * min(len(own), len(s)) for s in sets):
            chosen.append(int(k))
            sets.append(own)
        if len(chosen) >= landmarks - landmarks // 2:
            break
    chosen = list(dict.fromkeys(chosen + [int(k) for k in common]))
    row, at = places(np.array(chosen))
    used, column = np.unique(inv[at], return_inverse=True)
    marks = np.zeros((len(chosen), len(used)), dtype=np.float32)
    np.add.at(marks, (row, column), cw[at] / norm[np.array(chosen)][row])
    slot = np.full(len(seen), -1, dtype=np.int32)
    slot[used] = np.arange(len(used))
    columns = marks.T.copy()

    def kernel(ks: np.ndarray) -> np.ndarray:
        """Kernel of units against the landmarks, from the subsequences that some landmark has."""
        out = np.zeros((len(ks), len(chosen)), dtype=np.float32)
        row, at = places(ks)
        s = slot[inv[at]]
        row, s, weight = row[s >= 0], s[s >= 0], cw[at][s >= 0]
        if len(row):
            first = np.flatnonzero(np.diff(np.concatenate([[-1], row])))
            out[row[first]] = np.add.reduceat(columns[s] * weight[:, None], first)
        return out / norm[ks][:, None]

    gram = marks @ columns
    val, vec = np.linalg.eigh(gram.astype(np.float64))
    keep = val > 1e-3 * val.max()
    whiten = vec[:, keep] / np.sqrt(val[keep])

    def features(ks: np.ndarray) -> np.ndarray:
        blocks = [kernel(ks[i:i + 4000]) @ whiten for i in range(0, len(ks), 4000)]
        x = np.concatenate(blocks) if blocks else np.zeros((0, keep.sum()))
        return np.concatenate([x, np.ones((len(x), 1))], axis=1)

    in_toxic = toxic[text] == 1
    toxic_text, toxic_kind = text[in_toxic], kind[in_toxic]
    pure = clean[toxic_kind] == 0
    negative = np.flatnonzero(clean > 0)
    frequent = negative[np.argsort(-clean[negative])[:MAX_UNITS // 6]]
    margin = score
    weights, bias = none, 0.0
    for _ in range(rounds):
        # each toxic text's telling words: its best and others nearly as good, never one of a clean text
        m = np.where(pure & (margin[toxic_kind] > 0), margin[toxic_kind], -np.inf)
        top = np.full(len(toxic), -np.inf)
        np.maximum.at(top, toxic_text, m)
        telling_pair = np.isfinite(m) & (m >= 0.8 * top[toxic_text])
        if not telling_pair.any():
            break
        share = 1.0 / np.bincount(toxic_text[telling_pair], minlength=len(toxic))[toxic_text[telling_pair]]
        positive, which = np.unique(toxic_kind[telling_pair], return_inverse=True)
        mass = np.bincount(which, weights=share)
        hard = negative[np.argsort(-margin[negative])[:MAX_UNITS // 6]]
        neg = np.unique(np.concatenate([frequent, hard, rng.permutation(negative)[:MAX_UNITS // 6]]))
        x = np.concatenate([features(positive), features(neg)])
        y = np.concatenate([np.ones(len(positive)), -np.ones(len(neg))])
        gone = np.log1p(clean[neg])
        w = _svm(x, y, np.concatenate([mass / mass.sum(), 4.0 * gone / gone.sum()]), reg=1e-3)
        weights = none.copy()
        weights[seen[used]] = (whiten @ w[:-1]) @ marks
        bias = float(w[-1])
        margin = Model(weights, bias, 1.0, 0.0).unit_margins(kstream, kstart)
    model = Model(weights, bias, 1.0, 0.0)
    per_text = np.full(len(toxic), min(model.bias, -1.0))
    sent_margin = model.margins(sentences)
    np.maximum.at(per_text, text_of, sent_margin)
    model.slope, model.shift = _logistic(per_text, toxic.astype(float))
    return model


def training_sentences(docs: DataFrame, labels: DataFrame, trainable: Column, max_docs: int = SAMPLE_DOCS,
                       max_sentences: int = SAMPLE_SENTENCES) -> DataFrame:
    """(doc_id, toxic, sentences) of the bounded training sample; ``trainable`` is a condition on doc_id."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()) \
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic")).where(trainable)
    picked = None
    for kind in (0, 1):
        one = known.where(F.col("toxic") == kind).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs)
        picked = one if picked is None else picked.unionByName(one)
    sentence = F.filter(F.flatten(F.transform(
        F.split(text_or_empty(), r"[.!?\n]+"),
        lambda s: F.regexp_extract_all(s, F.lit("(?s).{1,%d}" % SENTENCE_CHARS), F.lit(0)))), lambda s: F.trim(s) != "")
    # at most 2 * max_docs ids: a bounded broadcast
    return docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id") \
        .select("doc_id", "toxic", F.slice(sentence, 1, max_sentences).alias("sentences"))


def train(docs: DataFrame, labels: DataFrame, trainable: Column) -> Model:
    """Fit on the bounded sample, in one task; the driver sees the weights that are not zero."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((r["doc_id"], r["toxic"], r["sentences"]) for batch in batches for r in batch.to_pylist())
        text_of = np.repeat(np.arange(len(rows)), [len(r[2]) for r in rows]).astype(np.int64)
        model = fit([s for r in rows for s in r[2]], text_of, np.array([r[1] for r in rows], dtype=np.int64))
        code = np.flatnonzero(model.weights)
        yield pa.RecordBatch.from_pydict({
            "codes": [code.astype("<i4").tobytes()], "weights": [model.weights[code].astype("<f4").tobytes()],
            "bias": [float(model.bias)], "slope": [float(model.slope)], "shift": [float(model.shift)]})

    sample = training_sentences(docs, labels, trainable).repartition(1)
    got = sample.mapInArrow(run, "codes binary, weights binary, bias double, slope double, shift double").first()
    if got is None:  # no labelled row at all
        return fit([], np.zeros(0, np.int64), np.zeros(0, np.int64))
    weights = np.zeros(ALPHABET ** 4, dtype=np.float32)
    weights[np.frombuffer(got["codes"], "<i4")] = np.frombuffer(got["weights"], "<f4")
    return Model(weights, got["bias"], got["slope"], got["shift"])


def score(docs: DataFrame, model: Model, *keep: str | Column) -> DataFrame:
    """``keep`` columns with ``score`` (0 to 1) for every row of ``docs`` (needs ``text``)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        def judge(texts: list[str]) -> list[pa.Array]:
            out: list[np.ndarray] = []
            i = 0
            while i < len(texts):  # bounded memory: a few MB of text at once
                j, chars = i, 0
                while j < len(texts) and (j == i or chars + len(texts[j]) <= CHUNK):
                    chars += len(texts[j])
                    j += 1
                out.append(_long_scores(shared.value, texts[i]) if j == i + 1 else shared.value.scores(texts[i:j]))
                i = j
            return [pa.array(np.concatenate(out) if out else np.zeros(0), pa.float64())]

        return judge

    return with_columns_from_text(docs.select(*keep, text_or_empty().alias("_text")), make, "score double")


def remove_toxic(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """``docs`` without the rows that score ``threshold`` or more."""
    scored = score(docs, model, F.struct(*docs.columns).alias("row"))
    return scored.where(F.col("score") < threshold).select(*[F.col("row")[c].alias(c) for c in docs.columns])


def _long_scores(model: Model, text: str) -> np.ndarray:
    """One text of any length, cut at white space into chunks; the highest score counts."""
    parts, i = [], 0
    while i < len(text):
        j = min(len(text), i + CHUNK)
        if j < len(text):
            k = max(text.rfind(" ", i, j), text.rfind("\n", i, j))
            j = k if k > i else j
        parts.append(text[i:j])
        i = j
    return np.array([max((model.scores([p])[0] for p in parts), default=model.scores([""])[0])])
