"""Token ids of documents in files of directly addressable codes.

Documents are put in the order of their ids by a range partitioning and a sort within partitions.
Every task tokenises its range, appends the end id to each document and packs documents into
segments of about ``SEGMENT`` ids (a longer document is a segment of its own).  A segment is one row of
a Parquet file: ``part`` and ``seq`` give its place, ``base`` the ids before it in its part, then the
ids of its documents, their lengths, and the codes (see ``dac``).  Parquet's statistics of
``first_id`` and ``last_id`` find the segment of a document, the codes give any of its tokens.

The tokenizer's split never crosses white space and its normaliser does not look across it, so a text
is encoded word by word and the ids of a word are remembered (a bounded memory per worker).  Texts are
never cut.

Defined results: null and empty texts have the end id only; null ids come first; rows that repeat an
id are documents of their own, ordered by a hash of the text; an empty table writes no segment and
gives no rows; further columns are ignored.
"""

from __future__ import annotations

import json
import re
import sys
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyhouse.llm.dac import Codes, encode
from tallyhouse.llm.base import remembers, small_frame, tidy
from tallyhouse.session import scratch_path

VOCABULARY = "word_bpe_49k.json"
END = 1
SEGMENT = 1 << 20
#: Ids that are decoded at once where whole documents are read back (a longer document alone).
READ = 1 << 15
#: Words and parts of words whose ids a worker remembers, those of the texts in hand aside.
REMEMBERED = 300_000
#: Bytes of texts that are encoded at once; a longer text is encoded alone.
PIECE = 1 << 20

FILE_SCHEMA = "part int, seq int, base long, n_tokens long, first_id long, last_id long, doc_ids array<long>, lengths array<long>, codes binary"

_loaded: dict[str, tuple] = {}
remembers("tokens", _loaded.clear)


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


#: The split of the vocabulary's pre-tokenizer (fixed value).  It never crosses white space.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: The same for lower-case words of printable ASCII and the Latin letters from U+00C0 to U+00FF, none of
#: which the normaliser changes but to lower case.
_PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[^a-z0-9\u00df-\u00f6\u00f8-\u00ff]+")
_PLAIN = re.compile("[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
#: Both for words of ASCII alone, in bytes, and the marks that may end such a word.
_ASCII_PARTS = re.compile(rb"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")
_ASCII = bytes(range(0x21, 0x7F))
_MARKS = bytes(b for b in _ASCII if not chr(b).isalnum())


def _byte_characters() -> dict[int, str]:
    """The character that stands for each byte: itself where it is printable, else the next one from 256."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(others)}


_BYTE_CHARACTERS = _byte_characters()


def _ids(values) -> bytes:
    return array("I", values).tobytes()


class Encoder:
    """Ids of texts as little-endian 32-bit words.

    With the split above, ids are remembered by word and, for plain words, by the parts that the split
    makes of them.  A part is a word whose split is itself, so one memory serves both; its older half is
    dropped when the newer one is full.  With any other split whole texts go through the tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        steps = [x.get("type") for x in (told.get("normalizer") or {}).get("normalizers", [])]
        cuts = (told.get("pre_tokenizer") or {}).get("pretokenizers", [])
        self.by_word = (
            steps == ["NFC", "Replace", "Lowercase"]
            and [x.get("type") for x in cuts] == ["Split", "ByteLevel"]
            and cuts[0].get("pattern") == {"Regex": SPLIT}
            and not cuts[1].get("add_prefix_space")
            and sys.byteorder == "little"
        )
        self.special = [x["content"].encode() for x in told.get("added_tokens", [])]
        self.words: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    @classmethod
    def of(cls, path: str) -> Encoder:
        if path not in _loaded:
            _loaded.clear()
            _loaded[path] = cls(path)
        return _loaded[path]

    def _part(self, part: bytes) -> bytes:
        ids = self.words.get(part)
        if ids is None:
            ids = self.words[part] = self.older.get(part) or self._encode_part(part)
        return ids

    def _encode_part(self, part: bytes) -> bytes:
        said = part.decode() if part.isascii() else part.decode("latin-1").translate(_BYTE_CHARACTERS)
        return _ids([t.id for t in self.model.tokenize(said)])

    def _learn(self, new: list[bytes]) -> None:
        words, older, rest = self.words, self.older, []
        for w in new:
            known = older.get(w)
            if known is None:
                letters = w.rstrip(_MARKS)
                if letters.isalpha():  # of ASCII
                    known = self._part(letters)
                    if len(letters) < len(w):
                        known += self._part(w[len(letters) :])
                elif not w.translate(None, _ASCII):
                    known = b"".join(map(self._part, _ASCII_PARTS.findall(w)))
                else:
                    word = w.decode("utf-8", "replace")
                    if not _PLAIN.fullmatch(word):
                        rest.append(w)
                        continue
                    known = b"".join([self._part(part.encode()) for part in _PARTS.findall(word.lower())])
            words[w] = known
        for lo in range(0, len(rest), 20_000):
            some = rest[lo : lo + 20_000]
            found = self.tokenizer.encode_batch_fast([w.decode("utf-8", "replace") for w in some], add_special_tokens=False)
            words.update(zip(some, [_ids(e.ids) for e in found], strict=True))

    def encode(self, texts: list[bytes | None]) -> list[bytes]:
        data = [t or b"" for t in texts]
        out: list[bytes | None] = [None] * len(data)
        # special tokens are found before the normaliser runs: such texts go whole
        whole = [k for k, d in enumerate(data) if not self.by_word or any(x in d for x in self.special)]
        found = self.tokenizer.encode_batch_fast([data[k].decode() for k in whole], add_special_tokens=False) if whole else []
        for k, e in zip(whole, found, strict=True):
            out[k] = np.array(e.ids, "<u4").tobytes()
        cut = {k: d.lower().split() for k, d in enumerate(data) if out[k] is None}  # lower(): ASCII only
        self._learn([w for w in set().union(*cut.values()) if w not in self.words])
        get = self.words.__getitem__
        for k, words in cut.items():
            out[k] = b"".join(map(get, words))
        if len(self.words) > REMEMBERED // 2:  # what is used again comes back from the older half
            self.words, self.older = {}, self.words
        return out


def _text_pieces(texts: list[bytes | None]) -> Iterator[tuple[int, list[bytes | None]]]:
    """``row, texts``: the texts from ``row`` on that are encoded at once."""
    first = size = 0
    for k, text in enumerate(texts):
        size += len(text or b"")
        if k > first and size > PIECE:
            yield first, texts[first:k]
            first, size = k, len(text or b"")
    if texts:
        yield first, texts[first:]


def _write_pass(path: str, end: int, segment: int):
    names = [c.split()[0] for c in FILE_SCHEMA.split(", ")]
    types = [pa.int32(), pa.int32(), *[pa.int64()] * 4, pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
    tail = np.array([end], "<u4").tobytes()

    def run(batches):
        encoder, part = Encoder.of(path), TaskContext.get().partitionId()
        seq = base = held = 0
        ids: list = []
        parts: list[bytes] = []

        def close():
            lengths = [len(p) // 4 for p in parts]
            known = [i for i in ids if i is not None]
            row = (part, seq, base, sum(lengths), min(known, default=None), max(known, default=None), ids, lengths, encode(np.frombuffer(b"".join(parts), "<u4")))
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types, strict=True)], names), sum(lengths)

        for batch in batches:
            found = batch.column(0).to_pylist()
            for lo, texts in _text_pieces(batch.column(1).cast(pa.binary()).to_pylist()):
                for k, data in enumerate(encoder.encode(texts)):
                    ids.append(found[lo + k])
                    parts.append(data + tail)
                    held += len(data) // 4 + 1
                    if held >= segment:
                        out, n = close()
                        yield out
                        seq, base, held, ids, parts = seq + 1, base + n, 0, [], []
        if parts:
            yield close()[0]

    return run


def write_tokens(docs: DataFrame, folder: str, text="text", doc_id="doc_id", path: str | None = None, end: int = END, segment: int = SEGMENT) -> None:
    """Token files of ``docs`` in ``folder`` (which must not exist)."""
    base = docs.select(F.col(doc_id).cast("bigint").alias("id"), F.col(text).alias("text"), F.xxhash64(text).alias("tie"))
    order = [F.col("id").asc_nulls_first(), F.col("tie").asc_nulls_first()]
    rows = base.repartitionByRange(*order).sortWithinPartitions(*order).select("id", "text")
    rows.mapInArrow(tidy(_write_pass(path or vocabulary_path(), end, segment), "tokens"), FILE_SCHEMA).write.parquet(folder)


def _part_bases(spark: SparkSession, folder: str) -> DataFrame:
    """Ids before each part; a row for each task that wrote (so many parts as partitions)."""
    sums = spark.read.schema(FILE_SCHEMA).parquet(folder).groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect()
    bases, total = [], 0
    for r in sums:
        bases.append((r["part"], total))
        total += r["n"]
    return small_frame(spark, bases, part=pa.int32(), part_base=pa.int64())


def _read_pass(batches):
    for batch in batches:
        for row in batch.to_pylist():
            codes, at = Codes(row["codes"]), 0
            out = []
            held, first, stop = memoryview(b""), 0, 0  # ids in hand, and their places
            for i, n in zip(row["doc_ids"], row["lengths"], strict=True):
                if at + n > stop:
                    first, stop = at, min(max(at + n, at + READ), len(codes))
                    held = memoryview(codes.read(first, stop).astype("<u4").tobytes())
                out.append((i, row["part_base"] + row["base"] + at, n, zlib.crc32(held[4 * (at - first) : 4 * (at + n - first)])))
                at += n
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in zip(*out, strict=True)], ["doc_id", "start", "n_tokens", "ids_crc32"]
            )


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, out of the files."""
    files = spark.read.schema(FILE_SCHEMA).parquet(folder)
    rows = files.join(F.broadcast(_part_bases(spark, folder)), "part").select("part_base", "base", "doc_ids", "lengths", "codes")
    return rows.mapInArrow(tidy(_read_pass, "tokens"), "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_tokens(spark: SparkSession, folder: str, doc_id: int, start: int = 0, stop: int | None = None) -> DataFrame:
    """``doc_id, position, token`` of part of one document; only its segments are read."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                codes, at = Codes(row["codes"]), 0
                for i, n in zip(row["doc_ids"], row["lengths"], strict=True):
                    if i == doc_id:
                        hi = n if stop is None else min(stop, n)
                        ids = codes.read(at + start, at + max(start, hi)).astype(np.int64)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(ids), i)), pa.array(np.arange(start, start + len(ids))), pa.array(ids)], ["doc_id", "position", "token"]
                        )
                    at += n

    files = spark.read.schema(FILE_SCHEMA).parquet(folder)
    some = files.where((F.col("first_id") <= doc_id) & (F.col("last_id") >= doc_id)).select("doc_ids", "lengths", "codes")
    return some.mapInArrow(run, "doc_id long, position long, token long")


def op8(spark, docs: DataFrame) -> DataFrame:
    folder = scratch_path(spark, "tokens")
    write_tokens(docs, folder)
    return read_documents(spark, folder)
