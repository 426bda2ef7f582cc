"""Token ids in files of independent zstandard frames with a trailing seek table.

A file is a zstandard stream that any decoder reads whole:

* data frames: the ids of the file's documents one after the other, little-endian, two or
  four bytes each as the vocabulary needs, ``FRAME_IDS`` ids a frame (the last has fewer).
  Every frame is compressed for itself;
* skippable frames with the document table, up to ``TABLE_DOCS`` documents each: the shard number, the id
  width, and each document's id and number of ids, in the order of the data;
* the seek table, the last skippable frame: compressed size, decompressed size and checksum (low half of
  the content's XXH64) of every frame before it, the number of frames and the closing
  magic number, as the published seekable zstandard format lays them out;
* after every frame, the last one too, an empty skippable frame of eight bytes.  It counts to the
  frame before it.

The empty frame is what allows Spark's own text writer to write the files: a frame is a row
and the empty frame is the line separator.  So files appear through Spark's commit protocol,
on whatever store the path names, and a lost or repeated task leaves nothing behind.

Documents are encoded once, written as rows of ids to the shared folder, dealt by ranges of
doc_id and sorted there, so file after file holds ascending ids.  Readers take a file's tail,
find the frames that hold the ids of the documents asked for, check those frames' checksums and decompress only
those.  The place of a document among all ids comes from the files' sizes by a two-level
prefix sum.

Encoding.  The vocabulary's rules lower-case a text and part it into words, single digits, runs of signs and
contractions.  Texts of Latin-1 characters are parted so by array operations, a block at a time; each part is looked up by
its 64-bit hash in a direct-mapped table, and the parts not found are encoded by the tokenizers library, many in one
call.  Other texts, and those with one of the file's added tokens, are split at white space only, which the rules never
join over, and the library encodes each distinct string, of which the last ones are remembered; strings longer than
``LONG`` are cut between an ASCII digit and a following ASCII character, where the rules cut as well, unless they hold
an added token's first character.

Defined cases: null or empty text has only the end id; null doc_ids come first; equal doc_ids follow one
another in the order of their ids' checksum and then as read; documents of any length run over as many
frames as they need; a document is never in two files, so a file holds about ``SHARD_IDS`` ids and at least one document; other
columns are ignored; an empty table gives no rows; a frame whose checksum or size is
wrong raises an error.
"""

from __future__ import annotations

import json
import os
import re
import struct
import unicodedata
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vocalis.llm.common import materialize, text_or_empty
from vocalis.llm.packing import Encoder
from vocalis.session import scratch_path

END_ID = 1
#: Ids of a data frame, documents of a table frame, ids of a file (on average).
FRAME_IDS = 1 << 16
TABLE_DOCS = 1 << 16
SHARD_IDS = 1 << 22
#: Strings remembered in a generation, and code points beyond which a string is cut or not remembered.
CACHED = 1 << 16
LONG = 1 << 12
#: Code points of the texts encoded together (a longer text is encoded alone).
TOGETHER = 1 << 19
#: Files whose sizes are added up in one task.
FILE_GROUP = 1024

#: Magic numbers of the published formats (fixed values).
SKIPPABLE = 0x184D2A50
SEEK_TABLE = 0x184D2A5E
SEEK_END = 0x8F92EAB1
DOCUMENTS = 0x184D2A51
_CHECKSUMS = 0x80
#: The expression of the vocabulary by which a lower-cased text is parted (fixed value).
PARTS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

EMPTY_FRAME = struct.pack("<II", SKIPPABLE, 0)
_FOOTER = struct.Struct("<IBI")


# ------------------------------------------------------------------ encoding
class Ids:
    """Ids of texts; a white-space-free string's are asked of the tokenizers library when it is first met."""

    _CUT = re.compile(r"(?<=[0-9])(?=[!-~])")
    #: Letters, perhaps followed by marks: two groups of the vocabulary's rules that are encoded apart.
    _PLAIN = re.compile(r"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([!\"#$%&()*+,\-./:;=?@\[\\\]^_`{}~]*)")

    def __init__(self, spec: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
        from tokenizers import Tokenizer

        self._encoder = Tokenizer.from_str(spec)
        self.width = 2 if self._encoder.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
        added = [t["content"] for t in json.loads(spec).get("added_tokens", [])]
        self._opens = {t[0] for t in added if t}
        self._words = None if any(self._PLAIN.fullmatch(t) for t in added) else self._word_encoder(json.loads(spec))
        self._added = added
        self._parts = PartTable(self._ask_words, self.width)
        self._known: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}

    def _word_encoder(self, spec: dict):
        """The same vocabulary for parted text, where the last id of a part is marked as such."""
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        suffix = spec["model"].get("end_of_word_suffix")
        steps = [n.get("type") for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        cut = ((spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
        if not suffix or steps != ["NFC", "Replace", "Lowercase"] or cut.get("pattern") != {"Regex": PARTS}:
            return None
        words = Tokenizer.from_str(json.dumps(spec))
        words.normalizer = normalizers.Sequence([])
        words.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self._closes = np.zeros(self._encoder.get_vocab_size(with_added_tokens=True), dtype=bool)
        self._closes[[i for token, i in spec["model"]["vocab"].items() if token.endswith(suffix)]] = True
        return words

    def _ask(self, strings: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype=f"<u{self.width}").tobytes()
                for e in self._encoder.encode_batch_fast(strings, add_special_tokens=False)]

    def _ask_words(self, words: list[str]) -> list[bytes]:
        """The same for lower-case words of letters, in one call."""
        if not words or self._words is None:
            return self._ask(words)
        ids = np.array(self._words.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids)
        ends = np.flatnonzero(self._closes[ids]) + 1
        if len(ends) != len(words):
            return self._ask(words)
        data = ids.astype(f"<u{self.width}").tobytes()
        cuts = [0, *(ends * self.width).tolist()]
        return [data[a:b] for a, b in zip(cuts, cuts[1:])]

    def _learn(self, strings: Iterable[str]) -> list[str]:
        """Have the ids of all ``strings`` at hand; those returned are not to be kept."""
        known, older, plain = self._known, self._older, self._PLAIN.fullmatch
        words, other, joined, long = set(), set(), [], []
        for s in strings:
            if s in older:
                known[s] = older[s]
            elif len(s) > LONG:
                long.append(s)
            elif m := plain(s):
                word, marks = m[1].lower(), m[2]
                joined.append((s, word, marks))
                for part, unknown in ((word, words), (marks, other)):
                    if part in older:
                        known[part] = older[part]
                    elif part and part not in known:
                        unknown.add(part)
            else:
                other.add(s)
        for ask, unknown in ((self._ask_words, list(words)), (self._ask, list(other))):
            known.update(zip(unknown, ask(unknown)))
        for s, word, marks in joined:
            known[s] = known[word] + known[marks] if marks else known[word]
        for s in long:
            known[s] = b"".join(self._ask([s] if any(c in s for c in self._opens) else self._CUT.split(s)))
        return long

    def _strings_of(self, texts: list[str]) -> list[bytes]:
        if len(self._known) > CACHED:
            self._known, self._older = {}, self._known
        strings = [split(t) for t in texts]
        long = self._learn(set().union(*strings).difference(self._known))
        out = [b"".join(map(self._known.__getitem__, s)) for s in strings]
        for s in long:
            del self._known[s]
        return out

    def of(self, texts: list[str]) -> list[bytes]:
        """Ids of several texts."""
        out: list[bytes] = [b""] * len(texts)
        plain, held, other = [], 0, []
        for k, text in enumerate(texts):
            if self._words is None or len(text) > TOGETHER or any(a in text for a in self._added) or not is_latin(text):
                other.append(k)
                continue
            if held + len(text) > TOGETHER:
                self._fill(out, plain, self._parts.ids([texts[i] for i in plain]))
                plain, held = [], 0
            plain.append(k)
            held += len(text) + 1
        if plain:
            self._fill(out, plain, self._parts.ids([texts[i] for i in plain]))
        if other:
            self._fill(out, other, self._strings_of([texts[i] for i in other]))
        return out

    @staticmethod
    def _fill(out: list[bytes], where: list[int], what: list[bytes]) -> None:
        for k, ids in zip(where, what):
            out[k] = ids


def is_latin(text: str) -> bool:
    """Whether all characters are below U+0100."""
    if text.isascii():
        return True
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class PartTable:
    """Ids of Latin-1 texts, parted by array operations; a direct-mapped table remembers the parts."""

    _SLOTS, _STORE = 20, 1 << 22
    _SPACE, _LETTER, _DIGIT, _SIGN = range(4)

    def __init__(self, ask, width: int):
        self._ask, self._kind = ask, np.dtype(f"<u{width}")
        self._lower = np.array([ord(chr(c).lower()) if len(chr(c).lower()) == 1 else c for c in range(256)], dtype=np.uint8)
        self._class = np.array([self._SPACE if c in (9, 10, 11, 12, 13, 32, 0x85, 0xA0) else
                                {"L": self._LETTER, "N": self._DIGIT}.get(unicodedata.category(chr(c))[0], self._SIGN)
                                for c in range(256)], dtype=np.uint8)
        n, base = TOGETHER + 2, 0x9E3779B97F4A7C15
        self._powers, self._back = Encoder._series(base, n), Encoder._series(pow(base, -1, 1 << 64), n)
        self._reset()

    def _reset(self) -> None:
        self._hash = np.zeros(1 << self._SLOTS, dtype=np.uint64)
        self._at = np.zeros(1 << self._SLOTS, dtype=np.int32)
        self._count = np.zeros(1 << self._SLOTS, dtype=np.int32)
        self._store = np.zeros(self._STORE, dtype=self._kind)
        self._used = 0

    def _part(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Begins and ends of the parts of lower-cased text that ends with white space."""
        cls = self._class[points]
        begin = cls != self._SPACE
        begin[1:] &= (cls[1:] != cls[:-1]) | (cls[1:] == self._DIGIT)
        quote = np.flatnonzero(begin & (points == 39))  # never last
        if len(quote):
            a = points[quote + 1]
            b = points[np.minimum(quote + 2, len(points) - 1)]
            one = np.isin(a, [ord(c) for c in "stmd"])
            two = ((a == ord("r")) | (a == ord("v"))) & (b == ord("e")) | (a == ord("l")) & (b == ord("l"))
            for hit, size in ((one, 2), (two & ~one, 3)):
                begin[quote[hit] + 1] = False
                after = quote[hit] + size
                begin[after] = cls[after] != self._SPACE
        end = cls != self._SPACE
        end[:-1] &= begin[1:] | (cls[1:] == self._SPACE)
        return np.flatnonzero(begin), np.flatnonzero(end) + 1

    def ids(self, texts: list[str]) -> list[bytes]:
        points = self._lower[np.frombuffer(("\n".join(texts) + "\n").encode("latin-1"), dtype=np.uint8)]
        begin, end = self._part(points)
        sums = np.zeros(len(points) + 1, dtype=np.uint64)
        np.cumsum((points.astype(np.uint64) + np.uint64(0x5851F42D)) * self._powers[:len(points)], out=sums[1:])
        key = (sums[end] - sums[begin]) * self._back[begin]
        key ^= key >> np.uint64(29)
        key *= np.uint64(0xBF58476D1CE4E5B9)
        key ^= key >> np.uint64(32)
        key |= np.uint64(1)
        slot = (key >> np.uint64(64 - self._SLOTS)).astype(np.int64)
        at, count = self._at[slot], self._count[slot]
        missed = np.flatnonzero(self._hash[slot] != key)
        if len(missed):
            if self._used > self._STORE // 2:
                self._reset()
                missed = np.arange(len(key))
            fresh, first, which = np.unique(key[missed], return_index=True, return_inverse=True)
            text = points.tobytes().decode("latin-1")
            found = self._ask([text[b:e] for b, e in zip(begin[missed[first]].tolist(), end[missed[first]].tolist())])
            sizes = np.array([len(x) // self._kind.itemsize for x in found], dtype=np.int32)
            new = np.frombuffer(b"".join(found), dtype=self._kind)
            places = (self._used + np.cumsum(sizes) - sizes).astype(np.int32)
            if self._used + len(new) > len(self._store):
                self._store = np.concatenate([self._store, np.zeros(len(new), dtype=self._kind)])
            self._store[self._used:self._used + len(new)] = new
            self._used += len(new)
            at[missed], count[missed] = places[which], sizes[which]
            s = (fresh >> np.uint64(64 - self._SLOTS)).astype(np.int64)
            self._hash[s], self._at[s], self._count[s] = fresh, places, sizes
        total = np.concatenate([[0], np.cumsum(count, dtype=np.int64)])
        out = self._store[np.repeat(at - total[:-1], count) + np.arange(total[-1])]
        ends = np.cumsum([len(t) + 1 for t in texts])
        cuts = np.concatenate([[0], total[np.searchsorted(begin, ends)]]).tolist()
        return [out[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]


#: Parts a text where both Python and the vocabulary's rules see white space.
_CONTROLS = re.compile("[\x1c-\x1f]")


def split(text: str) -> list[str]:
    """Strings of a text between white space; Python also parts at four controls that are no white space to the rules."""
    return re.split(r"[ \n\t\r]+", text.strip(" \n\t\r")) if _CONTROLS.search(text) else text.split()


_ENCODERS: dict[int, Ids] = {}


def encode(docs: DataFrame, path: str, end_id: int = END_ID) -> DataFrame:
    """(doc_id, ids, n_tokens, ids_crc32) of every row; ids as little-endian bytes with the end id."""
    with open(path, encoding="utf-8") as f:
        spec = f.read()
    if any(t.get(flag) for t in json.loads(spec).get("added_tokens", []) for flag in ("single_word", "lstrip", "rstrip")):
        raise ValueError("added tokens that depend on their neighbours are not supported")
    key = zlib.crc32(spec.encode())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _ENCODERS:  # a worker's later tasks find what its earlier ones remembered
            _ENCODERS[key] = Ids(spec)
        ids = _ENCODERS[key]
        end = np.array([end_id], dtype=f"<u{ids.width}").tobytes()

        def rows(part: pa.RecordBatch, texts: list[str]) -> pa.RecordBatch:
            out = [x + end for x in ids.of(texts)]
            crc = [zlib.crc32(np.frombuffer(x, f"<u{ids.width}").astype("<u4").tobytes()) for x in out]
            return pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(out, pa.binary()), pa.array([len(x) // ids.width for x in out], pa.int64()),
                 pa.array(crc, pa.int64()), pa.array([ids.width] * len(out), pa.int32())],
                names=["doc_id", "ids", "n_tokens", "ids_crc32", "width"])

        for batch in batches:
            begin, held, texts = 0, 0, []
            for k, text in enumerate(batch.column("text")):
                texts.append(text.as_py())
                held += len(texts[-1])
                if held >= TOGETHER:
                    yield rows(batch.slice(begin, k + 1 - begin), texts)
                    begin, held, texts = k + 1, 0, []
            if texts:
                yield rows(batch.slice(begin), texts)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text_or_empty().alias("text")) \
        .mapInArrow(run, f"doc_id {kind}, ids binary, n_tokens long, ids_crc32 long, width int")


# ------------------------------------------------------------------ files
def frame(magic: int, payload: bytes) -> bytes:
    return struct.pack("<II", magic, len(payload)) + payload


def checksum(data: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(data) & 0xFFFFFFFF


class FileWriter:
    """The frames of one file, in order, from documents as they come."""

    def __init__(self, shard: int, width: int):
        import zstandard

        self._shard, self._width = shard, width
        self._compress = zstandard.ZstdCompressor(level=3, write_checksum=True, write_content_size=True).compress
        self._data = bytearray()
        self._docs: list[tuple[int | None, int]] = []
        self._tables: list[bytes] = []
        self._entries: list[tuple[int, int, int]] = []

    def _data_frame(self, data: bytes) -> bytes:
        out = self._compress(data)
        self._entries.append((len(out) + len(EMPTY_FRAME), len(data), checksum(data)))
        return out

    def _close_table(self) -> None:
        ids = np.array([0 if d is None else d for d, _ in self._docs], dtype="<i8")
        known = np.packbits([d is not None for d, _ in self._docs])
        sizes = np.array([n for _, n in self._docs], dtype="<i8")
        body = self._compress(ids.tobytes() + sizes.tobytes() + known.tobytes())
        self._tables.append(frame(DOCUMENTS, struct.pack("<qIIII", self._shard, self._width, len(self._docs), checksum(body), 0) + body))
        self._docs = []

    def add(self, doc_id: int | None, ids: bytes) -> Iterator[bytes]:
        self._docs.append((doc_id, len(ids) // self._width))
        if len(self._docs) == TABLE_DOCS:
            self._close_table()
        self._data += ids
        size = FRAME_IDS * self._width
        if len(self._data) >= size:
            at = 0
            while at + size <= len(self._data):
                yield self._data_frame(bytes(self._data[at:at + size]))
                at += size
            del self._data[:at]

    def close(self) -> Iterator[bytes]:
        if self._data:
            yield self._data_frame(bytes(self._data))
        if self._docs:
            self._close_table()
        for table in self._tables:
            self._entries.append((len(table) + len(EMPTY_FRAME), 0, 0))
            yield table
        body = b"".join(struct.pack("<III", *e) for e in self._entries)
        yield frame(SEEK_TABLE, body + _FOOTER.pack(len(self._entries), _CHECKSUMS, SEEK_END))


def write_files(docs: DataFrame, path: str, tokenizer: str, folder: str, shard_ids: int = SHARD_IDS) -> None:
    """Encode ``docs`` (doc_id, text) and write the files in ascending order of doc_id under ``path``.

    ``folder``: a name for the rows of ids in the shared folder.
    """
    coded = materialize(encode(docs, tokenizer).withColumn("_row", F.monotonically_increasing_id()), folder)
    total = coded.agg(F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("n")).first()["n"]
    order = [F.col("doc_id").asc_nulls_first(), "ids_crc32", "_row"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = None
        for batch in batches:
            for doc_id, ids, width in zip(batch.column("doc_id").to_pylist(), batch.column("ids"), batch.column("width").to_pylist()):
                writer = writer or FileWriter(TaskContext.get().partitionId(), width)
                for out in writer.add(doc_id, ids.as_py()):
                    yield pa.RecordBatch.from_arrays([pa.array([out], pa.binary())], names=["frame"])
        for out in writer.close() if writer else ():
            yield pa.RecordBatch.from_arrays([pa.array([out], pa.binary())], names=["frame"])

    shards = max(1, -(-total // shard_ids))
    rows = coded.repartitionByRange(shards, *order).sortWithinPartitions(*order).select("doc_id", "ids", "width") \
        .mapInArrow(run, "frame binary")
    rows.select(F.col("frame").cast("string").alias("value")).write.mode("overwrite") \
        .option("lineSep", EMPTY_FRAME.decode("ascii")).option("compression", "none").option("maxRecordsPerFile", 0).text(path)


class FileReader:
    """One file's bytes: its document table, and any document's ids from the frames that hold them."""

    def __init__(self, content: bytes):
        import zstandard

        self._content = content
        self._decompress = zstandard.ZstdDecompressor().decompress
        self.frames_read = 0
        tail = len(content) - len(EMPTY_FRAME)
        if tail < _FOOTER.size or content[tail:] != EMPTY_FRAME:
            raise ValueError("the file does not end as it should")
        n, flags, magic = _FOOTER.unpack_from(content, tail - _FOOTER.size)
        start = tail - _FOOTER.size - 12 * n
        if magic != SEEK_END or flags != _CHECKSUMS or start < 8 or \
                struct.unpack_from("<II", content, start - 8) != (SEEK_TABLE, 12 * n + _FOOTER.size):
            raise ValueError("no seek table")
        entries = np.frombuffer(content, "<u4", 3 * n, start).reshape(n, 3).astype(np.int64)
        self._at = np.concatenate([[0], np.cumsum(entries[:, 0])])
        self._entries = entries
        tables = [self._table(k) for k in np.flatnonzero(entries[:, 1] == 0)]
        self.shard, self.width = tables[0][0], tables[0][1]
        self.doc_ids = [d for t in tables for d in t[2]]
        sizes = np.concatenate([t[3] for t in tables])
        #: First id of each document in the file, and the file's number of ids.
        self.starts = np.concatenate([[0], np.cumsum(sizes)])
        self._data = np.flatnonzero(entries[:, 1] > 0)
        self._ends = np.cumsum(entries[self._data, 1])
        if (self._ends[-1] if len(self._ends) else 0) != self.starts[-1] * self.width:
            raise ValueError("the document table does not fit the data")

    def _table(self, k: int):
        at = self._at[k]
        magic, size = struct.unpack_from("<II", self._content, at)
        if magic != DOCUMENTS:
            raise ValueError("no document table")
        shard, width, n, check, _ = struct.unpack_from("<qIIII", self._content, at + 8)
        body = self._content[at + 32:at + 8 + size]
        if checksum(body) != check:
            raise ValueError("a document table's checksum is wrong")
        raw = self._decompress(body)
        ids = np.frombuffer(raw, "<i8", n)
        known = np.unpackbits(np.frombuffer(raw, np.uint8, offset=16 * n), count=n)
        return shard, width, [d if k else None for d, k in zip(ids.tolist(), known)], np.frombuffer(raw, "<i8", n, 8 * n)

    def _frame(self, k: int) -> bytes:
        entry = self._data[k]
        size, content = self._entries[entry, :2]
        data = self._decompress(self._content[self._at[entry]:self._at[entry] + size - len(EMPTY_FRAME)], max_output_size=int(content))
        if len(data) != content or checksum(data) != self._entries[entry, 2]:
            raise ValueError("a frame's checksum is wrong")
        self.frames_read += 1
        return data

    def documents(self, wanted: Iterable[int]) -> Iterator[tuple[int, np.ndarray]]:
        """(index, ids) of the documents at the ascending indexes ``wanted``; each frame needed is decompressed once."""
        last, held = -1, b""
        for i in wanted:
            begin, end = int(self.starts[i]) * self.width, int(self.starts[i + 1]) * self.width
            parts, at = [], begin
            k = int(np.searchsorted(self._ends, begin, side="right"))
            while at < end:
                if k != last:
                    last, held = k, self._frame(k)
                base = int(self._ends[k]) - len(held)
                parts.append(held[at - base:end - base])
                at, k = min(end, base + len(held)), k + 1
            yield i, np.frombuffer(b"".join(parts), f"<u{self.width}")


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).where("length > 0").select("content")


def read_files(spark: SparkSession, path: str, doc_ids: Iterable[int] | None = None) -> DataFrame:
    """(shard, doc_id, start_in_file, n_tokens, tokens) from the files; of some documents only, if ``doc_ids`` is given.

    Frames without a requested document stay compressed.
    """
    chosen = None if doc_ids is None else frozenset(doc_ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                reader = FileReader(content.as_py())
                wanted = [i for i, d in enumerate(reader.doc_ids) if chosen is None or d in chosen]
                rows: list[tuple] = []
                held = 0
                for i, ids in reader.documents(wanted):
                    rows.append((reader.doc_ids[i], int(reader.starts[i]), len(ids), ids))
                    held += len(ids)
                    if held > FRAME_IDS:
                        yield as_batch(reader.shard, rows)
                        rows, held = [], 0
                if rows:
                    yield as_batch(reader.shard, rows)

    def as_batch(shard: int, rows: list[tuple]) -> pa.RecordBatch:
        doc, start, n, ids = zip(*rows)
        return pa.RecordBatch.from_arrays(
            [pa.array([shard] * len(rows), pa.int64()), pa.array(doc, pa.int64()), pa.array(start, pa.int64()),
             pa.array(n, pa.int64()), pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary())],
            names=["shard", "doc_id", "start_in_file", "n_tokens", "tokens"])

    return _files(spark, path).mapInArrow(
        run, "shard long, doc_id long, start_in_file long, n_tokens long, tokens binary")


def file_starts(sizes: DataFrame) -> DataFrame:
    """(shard, base): how many ids lie in the files before each one; ``sizes``: (shard, n) of each file."""
    sizes = sizes.withColumn("grp", F.floor(F.col("shard") / FILE_GROUP))
    before = Window.orderBy("grp").rowsBetween(Window.unboundedPreceding, -1)
    groups = sizes.groupBy("grp").agg(F.sum("n").alias("n")) \
        .select("grp", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("group_base"))
    within = Window.partitionBy("grp").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.withColumn("inside", F.coalesce(F.sum("n").over(within), F.lit(0))).join(groups, "grp") \
        .select("shard", (F.col("group_base") + F.col("inside")).alias("base"))


def file_sizes(spark: SparkSession, path: str) -> DataFrame:
    """(shard, n): the number of ids in each file; only tails and document tables are decoded."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            readers = [FileReader(c.as_py()) for c in batch.column("content")]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r.shard for r in readers], pa.int64()), pa.array([int(r.starts[-1]) for r in readers], pa.int64())],
                names=["shard", "n"])

    return _files(spark, path).mapInArrow(run, "shard long, n long")


def store_tokens(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from files written to the shared folder and read back."""
    spark = docs.sparkSession
    path = scratch_path(spark, "token-files")
    write_files(docs, path, tokenizer, "token-rows")
    found = materialize(read_files(spark, path).withColumn("ids_crc32", F.crc32("tokens")).drop("tokens"), "token-found")
    sizes = found.groupBy("shard").agg(F.max(F.col("start_in_file") + F.col("n_tokens")).alias("n"))
    return found.join(file_starts(sizes), "shard") \
        .select("doc_id", (F.col("base") + F.col("start_in_file")).alias("start"), "n_tokens", "ids_crc32")
