"""Token ids as binary blocks in files: write a corpus in the order of doc_id, read any of it back.

A file holds segments, each of whole documents. A segment is a row: its documents and their lengths, and its ids cut into
blocks of equal length, coded by ``range_coder`` (up to ``2 * LANES`` together) and followed by the crc32 of their ids.
The container is Parquet, so files are committed by Spark's writer and live wherever Spark can write.
"""

from __future__ import annotations

import functools
import json
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.range_coder import decode_blocks, encode_blocks

#: Ids after which a segment is closed (a longer document has a segment of its own), and the most ids of a block.
SEGMENT_IDS = 4_000_000
BLOCK_IDS = 512
#: A small segment has shorter blocks rather than few.
LANES = 4096
SEGMENT = (
    "file int, segment int, doc_ids array<long>, lengths array<int>, block_ids int, blocks array<binary>, checks array<long>"
)
ROW = pa.schema([
    ("file", pa.int32()), ("segment", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int32())),
    ("block_ids", pa.int32()), ("blocks", pa.list_(pa.binary())), ("checks", pa.list_(pa.int64())),
])
#: Bytes of texts that are encoded at a time; a longer text is taken alone.
SLICE_BYTES = 8 << 20
#: Pieces, and bytes of them, after which a generation of remembered pieces ends; the one before it is dropped then.
KNOWN_PIECES, KNOWN_BYTES = 400_000, 8 << 20


def _cuts() -> bytes:
    """By the kinds of two neighbouring bytes (8 times the first's and the second's): whether a pre-token ends between.

    Letters, digits, white space and other signs: a pre-token is a run of one kind, to which a space before it may belong.
    An apostrophe may begin a pre-token of letters. Bytes beyond ASCII tell nothing.
    """
    cut = bytearray(256)
    for a, then in {LETTER: (DIGIT, SPACE, SIGN, QUOTE), DIGIT: (LETTER, SPACE, SIGN, QUOTE), SIGN: (LETTER, DIGIT, SPACE), QUOTE: (SPACE,)}.items():
        for b in then:
            cut[a * 8 + b] = 1
    return bytes(cut)


LETTER, DIGIT, SPACE, SIGN, QUOTE = range(1, 6)
KIND = bytes(
    (0 if c > 127 else LETTER if chr(c).isalpha() else DIGIT if chr(c).isdigit() else SPACE if c in b" \t\n\v\f\r" else QUOTE if c == 39 else SIGN if 32 < c < 127 else 0)
    for c in range(256)
)
CUTS = _cuts()
#: By kind: whether it is known and no white space.
SOLID = np.array([k in (LETTER, DIGIT, SIGN, QUOTE) for k in range(6)])
#: The character that stands for a byte in a byte-level vocabulary: its own if that is printable, else one from 256 on.
_OWN = {*range(33, 127), *range(161, 173), *range(174, 256)}
BYTE_CHARS = {c: 256 + n for n, c in enumerate(c for c in range(256) if c not in _OWN)}
#: Stands for a byte that no UTF-8 text has, so no pair with it is ever merged; and how many words it joins.
BREAK, JOINED = "\u00ff", 400


def _cut(data: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Where pieces of the texts in ``data`` (UTF-8, a text begins at each ``begin``) begin or end."""
    kinds = np.frombuffer(data.tobytes().translate(KIND), np.uint8)
    at = np.zeros(len(data) + 1, bool)
    at[begin] = at[-1] = True
    if len(data) > 1:
        at[1:-1] |= np.frombuffer((kinds[:-1] * 8 + kinds[1:]).tobytes().translate(CUTS), bool)
        # after a character of two bytes: a letter from U+00C0 to U+00FF (but the two signs there), or at least no white space
        after = np.flatnonzero((data[1:-1] >= 0x80) & (kinds[2:] >= DIGIT))
        lead, last, then = data[after], data[after + 1], kinds[after + 2]
        letter = (lead == 0xC3) & (last != 0x97) & (last != 0xB7)
        at[after[letter | ((lead >= 0xC3) & (lead <= 0xDF) & (then == SPACE))] + 2] = True
        # after a line end and the like that stands alone, which no letter joins
        alone = np.flatnonzero((kinds[1:-1] == SPACE) & (data[1:-1] != 32)) + 1
        then = data[alone + 1]
        solid = SOLID[kinds[alone + 1]] | ((then >= 0xC3) & (then <= 0xDF))
        at[alone[SOLID[kinds[alone - 1]] & solid] + 1] = True
    return np.flatnonzero(at)


class Ids:
    """Ids of texts by the tokenizers library, as unsigned 16-bit integers.

    Texts are cut where pre-tokens of a byte-level tokenizer end, and each distinct piece is encoded once while it is
    remembered; for another tokenizer a piece is a whole text.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        if self.tokenizer.get_vocab_size() > 65_536:
            raise ValueError("ids must be below 65536")
        split = self.tokenizer.pre_tokenizer
        kind = json.loads(split.__getstate__()) if split else {}
        self.byte_level = (
            kind.get("type") == "ByteLevel" and kind.get("use_regex", True) and not kind["add_prefix_space"]
            and self.tokenizer.normalizer is None
            and all(t.special for t in self.tokenizer.get_added_tokens_decoder().values())
        )
        self.words = Tokenizer(self.tokenizer.model)  # the same model without the steps before it
        self.end = self.words.token_to_id(BREAK)
        self.byte_level &= self.end is not None and sum(BREAK in token for token in self.words.get_vocab()) == 1
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.known_bytes = 0

    def _encode(self, pieces: list[bytes]) -> list[bytes]:
        found: list[bytes] = [b""] * len(pieces)
        texts = [p.decode() for p in pieces]
        # a word after one space or none is one pre-token: the model's input
        single = [self.byte_level and (t.isalpha() or (t[0] == " " and t[1:].isalpha())) for t in texts]
        words, others = [k for k, one in enumerate(single) if one], [k for k, one in enumerate(single) if not one]
        chars = [t if t.isascii() else t.encode().decode("latin-1").translate(BYTE_CHARS) for t in map(texts.__getitem__, words)]
        for k in range(0, len(words), JOINED):
            joined = BREAK.join(chars[k : k + JOINED]).replace(" ", chr(BYTE_CHARS[32]))
            ids = np.array(self.words.encode_batch_fast([joined], add_special_tokens=False)[0].ids, "<u2")
            each = ids.tobytes()
            ends = [*(np.flatnonzero(ids == self.end) * 2).tolist(), len(each)]
            for at, a, b in zip(words[k : k + JOINED], [-2, *ends], ends, strict=False):
                found[at] = each[a + 2 : b]
        for at, e in zip(others, self.tokenizer.encode_batch_fast([texts[k] for k in others], add_special_tokens=False), strict=True):
            found[at] = np.array(e.ids, "<u2").tobytes()
        return found

    def of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and how many each has."""
        texts = texts.cast(pa.large_binary())
        begin = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[begin[0] : begin[-1]]
        begin = begin - begin[0]
        at = _cut(data, begin) if self.byte_level else np.unique(begin)
        pieces = pa.Array.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at), pa.py_buffer(data)])
        pieces = pieces.dictionary_encode()
        distinct = pieces.dictionary.to_pylist()
        if len(self.known) > KNOWN_PIECES or self.known_bytes > KNOWN_BYTES:
            self.known, self.older, self.known_bytes = {}, self.known, 0
        ids = list(map(self.known.get, distinct))
        absent = [k for k, i in enumerate(ids) if i is None]
        wanted = [distinct[k] for k in absent]
        remembered = list(map(self.older.get, wanted))
        new = iter(self._encode([p for p, i in zip(wanted, remembered, strict=True) if i is None]))
        for k, i in zip(absent, remembered, strict=True):
            ids[k] = i or next(new)
        self.known.update(zip(wanted, map(ids.__getitem__, absent), strict=True))
        self.known_bytes += sum(map(len, wanted))
        found = pa.array(ids, pa.large_binary()).take(pieces.indices)
        ends = np.frombuffer(found.buffers()[1], np.int64)[: len(found) + 1] // 2
        flat = np.frombuffer(found.buffers()[2] or b"", "<u2")[: ends[-1]]
        return flat, np.diff(ends[np.searchsorted(at, begin)])


@functools.cache
def _ids(path: str) -> Ids:
    """One for each worker, so that it knows the pieces of its tasks before."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    return Ids(path)


def _slices(texts: pa.Array) -> Iterator[slice]:
    """Texts in turn, of about ``SLICE_BYTES`` together."""
    size = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    ends = np.flatnonzero(np.diff(size // SLICE_BYTES, append=-1)) + 1
    yield from (slice(a, b) for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True))


def _segments(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        file, serial, encoder = TaskContext.get().partitionId(), 0, _ids(path)
        docs: list[int | None] = []
        lengths: list[int] = []
        parts: list[np.ndarray] = []
        size = 0

        def close() -> pa.RecordBatch:
            nonlocal docs, lengths, parts, size, serial
            ids = np.concatenate(parts)
            length = min(BLOCK_IDS, max(64, -(-len(ids) // LANES)))
            rows = -(-len(ids) // length)
            padded = np.zeros(rows * length, "<u2")
            padded[: len(ids)] = ids
            blocks, checks = [], []
            for at in range(0, rows, 2 * LANES):  # a long document's segment has many blocks
                some = padded.reshape(rows, length)[at : at + 2 * LANES]
                blocks += encode_blocks(some)
                checks += [zlib.crc32(b) for b in some]
            row = (file, serial, docs, lengths, length, blocks, checks)
            docs, lengths, parts, size, serial = [], [], [], 0, serial + 1
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, ROW, strict=True)], schema=ROW)

        for batch in batches:
            every, doc_ids = pc.fill_null(batch.column("text"), ""), batch.column("doc_id").to_pylist()
            for some in _slices(every):
                ids, counts = encoder.of(every[some])
                ids = np.insert(ids, np.cumsum(counts), end_id)
                ends = np.cumsum(counts + 1)
                begin, done = 0, 0
                while begin < len(ends):
                    # up to the first document that fills the segment
                    end = min(int(np.searchsorted(ends, SEGMENT_IDS - size + done)) + 1, len(ends))
                    docs += doc_ids[some][begin:end]
                    lengths += (counts[begin:end] + 1).tolist()
                    parts.append(ids[done : ends[end - 1]])
                    size += int(ends[end - 1]) - done
                    begin, done = end, int(ends[end - 1])
                    if size >= SEGMENT_IDS:
                        yield close()
        if docs:
            yield close()

    return run


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int) -> None:
    """Writes the ids of ``docs`` (doc_id, text) below ``path``, in ascending doc_id order over the files by number.

    Each document ends with ``end_id``; null and empty texts have that id alone. Rows without doc_id come first, rows
    that repeat a doc_id in the order of their texts' hashes. An empty table writes no segment.
    """
    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    ordered.mapInArrow(_segments(tokenizer, end_id), SEGMENT).write.parquet(path)


def segment_ids(blocks: list[bytes], checks: list[int], length: int, total: int) -> np.ndarray:
    """The ids of a segment. Raises if a block does not match its checksum."""
    found = []
    for at in range(0, len(blocks), 2 * LANES):
        some = decode_blocks([bytes(b) for b in blocks[at : at + 2 * LANES]], length).astype("<u2")
        for ids, check in zip(some, checks[at : at + 2 * LANES], strict=True):
            if zlib.crc32(ids.tobytes()) != check:
                raise ValueError("a block of token ids is damaged")
        found.append(some.reshape(-1))
    return np.concatenate(found)[:total] if found else np.zeros(0, "<u2")


def _documents(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for row in batch.itertuples(index=False):
            lengths = np.asarray(row.lengths, np.int64)
            ids = segment_ids(list(row.blocks), [int(c) for c in row.checks], row.block_ids, int(lengths.sum()))
            parts = np.split(ids, np.cumsum(lengths)[:-1])
            yield pd.DataFrame({
                "doc_id": pd.array([None if d is None or d != d else int(d) for d in row.doc_ids], "Int64"),
                "start": row.origin + np.cumsum(lengths) - lengths, "ids": [p.astype("<u4").tobytes() for p in parts],
            })


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Documents of the files below ``path``: doc_id, start (ids of all documents before it), ids as little-endian
    unsigned 32-bit integers. Every block is checked against its checksum.

    The starts come from the segments' sizes alone: one narrow row for each segment, of ``SEGMENT_IDS`` ids or the last of
    its file, is summed in order and sent to the segments.
    """
    stored = spark.read.schema(SEGMENT).parquet(path)
    size = F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)
    sizes = stored.select("file", "segment", size.alias("n"))
    files = sizes.groupBy("file").agg(F.sum("n").alias("n"))
    in_order = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # one row for each file
    files = files.select("file", F.coalesce(F.sum("n").over(in_order), F.lit(0)).alias("file_start"))
    in_file = Window.partitionBy("file").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.join(files, "file").select(
        "file", "segment", (F.col("file_start") + F.coalesce(F.sum("n").over(in_file), F.lit(0))).alias("origin")
    )
    placed = stored.join(F.broadcast(starts), ["file", "segment"])
    return placed.mapInPandas(_documents, "doc_id long, start long, ids binary")
