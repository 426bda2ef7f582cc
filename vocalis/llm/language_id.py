"""Language identification by compression with per-language zstandard dictionaries.

Each language gets a raw-content dictionary of sample text.  A text is brought
to lower-case letters separated by single blanks, cut into blocks of a few KB,
and each block is compressed with every language's dictionary; the language
with the fewest bytes over all blocks wins.  Blocks keep the dictionary inside
the compressor's window, so very long texts are judged whole and alike.

Dictionaries come from a bounded sample: per language at most
``SAMPLE_DOCS`` texts (those with the smallest hash, of over ``SHORT`` code
points first, shorter ones where these are too few) and ``SAMPLE_CHARS`` code
points of each, so a dictionary has at most ``SAMPLE_DOCS * SAMPLE_CHARS`` code
points; they are the only thing collected and broadcast, a few hundred KB per
language.

Defined cases: null text and text without a letter give ``und`` with score 0;
ties go to the alphabetically first language; with no labelled row every text
is ``und``; a margin under ``min_margin`` of the best size sets ``rejected``
while ``lang_pred`` stays the best guess; repeated rows are each reported;
other columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vocalis.llm.common import with_columns_from_text

SAMPLE_DOCS = 160
SAMPLE_CHARS = 800
#: Texts of at most so many code points are sampled only where longer ones are too few.
SHORT = 100
BLOCK_BYTES = 8192
LEVEL = 3
MIN_MARGIN = 0.01
#: Bits of size difference that count as one bit of evidence in the score.
BITS_PER_EVIDENCE = 16.0
UNDETERMINED = "und"

_NOT_LETTERS = re.compile(r"[\W\d_]+")


def normalised(text: str | None) -> str:
    """Lower-case letters, other runs as one blank; empty if there is no letter."""
    s = _NOT_LETTERS.sub(" ", (text or "").lower()).strip()
    return s if any(c.isalpha() for c in s) else ""


def sample(labelled: DataFrame, docs: int = SAMPLE_DOCS, chars: int = SAMPLE_CHARS) -> DataFrame:
    """(lang, text): per language the texts with the smallest hashes, cut to ``chars`` code points.

    Texts of over ``SHORT`` code points go first and shorter ones fill up; texts without a letter say nothing.
    The ranking runs on (lang, hash, cut text); Spark keeps only ``docs`` rows per language and task before the shuffle.
    """
    rows = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        "lang", F.xxhash64("text").alias("_h"), F.substring("text", 1, chars).alias("text")).where(F.col("text").rlike(r"\p{L}"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.length("text") <= SHORT, "_h", "text"))
    return rows.withColumn("_k", rank).where(F.col("_k") <= docs).select("lang", "_h", "text")


def train(labelled: DataFrame, docs: int = SAMPLE_DOCS, chars: int = SAMPLE_CHARS) -> dict[str, bytes]:
    """language -> dictionary bytes, from (lang, text) rows."""
    out: dict[str, list[str]] = {}
    for r in sample(labelled, docs, chars).orderBy("lang", "_h", "text").collect():
        out.setdefault(r["lang"], []).append(normalised(r["text"]))
    return {lang: " ".join(dict.fromkeys(texts)).encode() for lang, texts in sorted(out.items())}


def compressors(dictionaries: dict[str, bytes], level: int = LEVEL):
    import zstandard as zstd

    out = []
    for data in dictionaries.values():
        d = zstd.ZstdCompressionDict(data, dict_type=zstd.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(level=level)
        out.append(zstd.ZstdCompressor(level=level, dict_data=d, write_checksum=False, write_content_size=False,
                                       write_dict_id=False))
    return out


def sizes(text: str, comps: list, block: int = BLOCK_BYTES) -> np.ndarray:
    """Compressed bytes of a normalised text under each dictionary."""
    data = text.encode()
    return np.array([sum(len(c.compress(data[i:i + block])) for i in range(0, len(data), block)) for c in comps])


def decide(total: np.ndarray, min_margin: float = MIN_MARGIN) -> tuple[int, float, bool]:
    """(index of the smallest, score 0 to 1, rejected for a narrow margin)."""
    best = int(total.argmin())
    weights = np.exp2(np.maximum(-(total - total[best]) * 8.0 / BITS_PER_EVIDENCE, -1000.0))
    score = float(1.0 / weights.sum())
    margin = np.partition(total, 1)[1] / total[best] - 1 if len(total) > 1 else 1.0
    return best, score, bool(margin < min_margin)


def identify(docs: DataFrame, dictionaries: dict[str, bytes], *keep: str | Column,
             min_margin: float = MIN_MARGIN) -> DataFrame:
    """``keep`` columns with lang_pred, score and rejected for every row of ``docs`` (needs ``text``)."""
    langs = list(dictionaries)

    def make():
        comps = compressors(dictionaries)

        def judge(texts: list[str | None]) -> list[pa.Array]:
            found = []
            for text in texts:
                s = normalised(text)
                if not s or not comps:
                    found.append((UNDETERMINED, 0.0, True))
                    continue
                best, score, rejected = decide(sizes(s, comps), min_margin)
                found.append((langs[best], score, rejected))
            return [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64()),
                    pa.array([f[2] for f in found], pa.bool_())]

        return judge

    return with_columns_from_text(docs.select(*keep, F.col("text").alias("_text")), make,
                                  "lang_pred string, score double, rejected boolean")
