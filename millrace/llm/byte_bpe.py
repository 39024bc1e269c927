"""Byte-level BPE by a global shuffle of distinct words: every distinct pre-token is encoded once.

Documents are cut into pre-tokens in blocks. Within a block the positions of pre-tokens are numbers of the block's own
distinct words, so that each distinct word of a block goes into the shuffle once, not each occurrence. Words meet by
parts of their hash over all blocks, each is encoded once, its ids go back to the blocks, and each block puts its
documents together again by position. Decoding looks ids up in the token-byte table, which every worker has.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import give_back

#: Bytes of text after which a block is closed; a longer text is a block of its own.
BLOCK_BYTES = 6_000_000
#: Chunks between spaces that a block remembers with their pre-tokens before it is closed.
CHUNKS = 300_000
#: Parts that the words of all blocks are divided into by hash, for each split of the input, and at least; a block sends
#: the words of one part in one row.
PARTS_PER_SPLIT, LEAST_PARTS = 2, 64
#: Documents whose word numbers travel together.
PACK = 500


@lru_cache(maxsize=2)
def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Pretokens:
    """Numbers of the pre-tokens of texts, by a pattern that gives a word at most one space before it.

    A text is first split at single spaces. Such a chunk, with its space, has the same pre-tokens wherever it stands if
    it neither begins nor ends with white space, so each distinct chunk meets the pattern once. Texts with other white
    space around a space go through the pattern whole.
    """

    def __init__(self, pattern: str) -> None:
        import regex

        self.find = regex.compile(pattern).findall
        self.words: dict[str, int] = {}
        self.chunks: dict[str, list[int]] = {}

    def of(self, text: str) -> list[int]:
        number = self.words.setdefault
        first, *rest = text.split(" ")
        if any(not c or c[0].isspace() or c[-1].isspace() for c in rest) or first[-1:].isspace():
            return [number(w, len(self.words)) for w in self.find(text)]
        out = [number(w, len(self.words)) for w in self.find(first)]
        known = self.chunks
        for c in rest:
            found = known.get(c)
            if found is None:
                found = known[c] = [number(w, len(self.words)) for w in self.find(f" {c}")]
            out += found
        return out


def _pack(data: bytes) -> bytes:
    import zstandard

    return zstandard.compress(data, 3)


def _unpack(data: bytes) -> bytes:
    import zstandard

    return zstandard.decompress(bytes(data))


def _join_words(words: list[str]) -> bytes:
    """Lengths first, then the words: any character may be in a word."""
    lengths = np.array([len(words), *map(len, words)], "<u4")
    return lengths.tobytes() + "".join(words).encode("utf-8", "surrogatepass")


def _split_words(data: bytes) -> list[str]:
    n = int(np.frombuffer(data[:4], "<u4")[0])
    ends = np.cumsum(np.frombuffer(data[4 : 4 + 4 * n], "<u4")).tolist()
    text = data[4 + 4 * n :].decode("utf-8", "surrogatepass")
    return [text[a:b] for a, b in zip([0, *ends], ends, strict=False)]


def _parts(words: list[str], parts: int) -> np.ndarray:
    return np.fromiter((zlib.crc32(w.encode("utf-8", "surrogatepass")) % parts for w in words), np.int64, len(words))


def _digest(words: list[str]) -> int:
    """A number for the words in their order."""
    import xxhash

    return xxhash.xxh64_intdigest(_join_words(words)) - (1 << 63)


def _blocks(pattern: str, parts: int, want_words: bool):
    """Blocks of documents: their distinct words by part, or their documents as word numbers. Both come from the same
    walk over the same rows, so a block has the same number and the same words in either; a digest tells if not."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        task, serial = TaskContext.get().partitionId(), 0
        cutter, size, ids, codes = Pretokens(pattern), 0, [], []

        def close() -> Iterator[pd.DataFrame]:
            nonlocal cutter, size, ids, codes, serial
            block, words = (task << 24) + serial, list(cutter.words)
            part, digest = _parts(words, parts), _digest(words)
            order = np.argsort(part, kind="stable")  # a word's place in this order is its number in the block
            if want_words:
                ends = np.searchsorted(part[order], np.arange(parts + 1))
                rows = [
                    (block, p, digest, _pack(_join_words([words[k] for k in order[a:b]])))
                    for p, (a, b) in enumerate(zip(ends, ends[1:], strict=False)) if b > a
                ]
                if rows:
                    yield pd.DataFrame(rows, columns=["block", "part", "digest", "words"])
            else:
                place = np.empty(len(words), np.uint32)
                place[order] = np.arange(len(words))
                kind = np.uint16 if len(words) <= 65_536 else np.uint32
                rows = []
                for at in range(0, len(ids), PACK):
                    some = codes[at : at + PACK]
                    flat = place[np.concatenate(some)].astype(kind) if sum(map(len, some)) else np.zeros(0, kind)
                    rows.append((block, digest if words else None, flat.itemsize, ids[at : at + PACK], [len(c) for c in some], _pack(flat.tobytes())))
                if rows:
                    yield pd.DataFrame(rows, columns=["block", "digest", "width", "doc_ids", "lengths", "codes"])
            cutter, size, ids, codes, serial = Pretokens(pattern), 0, [], [], serial + 1

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                text = text or ""
                found = cutter.of(text)
                size += len(text.encode("utf-8", "surrogatepass"))
                if not want_words:
                    ids.append(None if pd.isna(doc_id) else int(doc_id))
                    codes.append(np.array(found, np.uint32))
                if size >= BLOCK_BYTES or len(cutter.chunks) >= CHUNKS:
                    yield from close()
        yield from close()
        cutter = None
        give_back()

    return run


def _encode_words(path: str, pattern: str):
    """The ids of the words of each row, and how many each word has. The rows of a part come one after another, so every
    word is encoded once over all blocks and only one part's words are remembered."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import tiktoken

        encode = tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=load_ranks(path), special_tokens={}).encode_ordinary
        known: dict[str, list[int]] = {}
        of = None
        for batch in batches:
            rows = []
            for block, part, digest, packed in zip(batch["block"], batch["part"], batch["digest"], batch["words"], strict=True):
                if part != of:
                    known.clear()
                    of = part
                found = []
                for word in _split_words(_unpack(packed)):
                    ids = known.get(word)
                    if ids is None:
                        ids = known[word] = encode(word)
                    found.append(ids)
                n = np.array([len(x) for x in found], np.uint32)
                flat = np.array([i for x in found for i in x], np.uint32)
                rows.append((block, part, digest, _pack(n.tobytes()), _pack(flat.tobytes())))
            if rows:
                yield pd.DataFrame(rows, columns=["block", "part", "digest", "counts", "ids"])
        known.clear()
        give_back()

    return run


def _reassemble(key, words: pd.DataFrame, docs: pd.DataFrame) -> pd.DataFrame:
    """All ids of each document of a block, from the ids of its words by part and its documents as word numbers."""
    words = words.sort_values("part")
    join = lambda column: np.frombuffer(b"".join(_unpack(x) for x in words[column]), np.uint32)
    lengths, flat = join("counts").astype(np.int64), join("ids")
    starts = np.cumsum(lengths) - lengths
    doc_ids, out = [], []
    for row in docs.itertuples(index=False):
        if set(words["digest"]) != ({row.digest} if row.digest == row.digest else set()):
            raise ValueError("the input was cut into blocks in two ways; write it to storage first")
        codes = np.frombuffer(_unpack(row.codes), f"<u{row.width}")
        at = 0
        for doc_id, size in zip(row.doc_ids, row.lengths, strict=True):
            code = codes[at : at + size]
            at += size
            n = lengths[code]
            ends = np.cumsum(n)
            total = int(ends[-1]) if size else 0
            place = np.arange(total) + np.repeat(starts[code] - (ends - n), n)
            doc_ids.append(None if doc_id is None or doc_id != doc_id else int(doc_id))
            out.append(flat[place].astype("<u4").tobytes() if total else b"")
    return pd.DataFrame({"doc_id": pd.array(doc_ids, "Int64"), "ids": out})


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, ids) of every row of ``docs`` (doc_id, text): ids as little-endian unsigned 32-bit integers.

    Every match of ``pattern`` is encoded separately by the ranks in ``path``, without special tokens. Null and empty
    texts have no ids. Repeated rows and rows without doc_id get a row each; an empty table gives an empty result.
    A block holds ``BLOCK_BYTES`` of text or one longer text, and its words, whatever the size of the table. The input
    is walked twice, so it has to be a stored table or a narrow derivation of one; a result of shuffles is to be written
    first, or the blocks may differ, which raises. A part's words are those of some splits of the input.
    """
    narrow = docs.select("doc_id", "text")
    parts = max(LEAST_PARTS, PARTS_PER_SPLIT * narrow.rdd.getNumPartitions())
    words = narrow.mapInPandas(_blocks(pattern, parts, True), "block long, part int, digest long, words binary")
    codes = narrow.mapInPandas(
        _blocks(pattern, parts, False), "block long, digest long, width int, doc_ids array<long>, lengths array<int>, codes binary"
    )
    encoded = words.repartition("part").sortWithinPartitions("part").mapInPandas(
        _encode_words(path, pattern), "block long, part int, digest long, counts binary, ids binary"
    )
    return encoded.groupBy("block").cogroup(codes.groupBy("block")).applyInPandas(_reassemble, "doc_id long, ids binary")


def token_bytes(spark: SparkSession, path: str) -> DataFrame:
    """The token-byte table: (id, bytes). Its size is the vocabulary's, not the input's."""
    rows = [(rank, token) for token, rank in load_ranks(path).items()]
    return spark.createDataFrame(rows, T.StructType([T.StructField("id", T.IntegerType()), T.StructField("bytes", T.BinaryType())]))


def decode(encoded: DataFrame, table: DataFrame) -> DataFrame:
    """(doc_id, ids, decoded) of every row of ``encoded`` (doc_id, ids), by a hash join with ``table`` (id, bytes).

    The table is sent to every worker once and the join is a lookup of all ids of a text at a time. An id that is not
    in the table raises. Rows without ids decode to nothing.
    """
    rows = table.toPandas().sort_values("id")  # one row for each token of the vocabulary
    sent = encoded.sparkSession.sparkContext.broadcast(
        (rows["id"].to_numpy(), np.array([len(b) for b in rows["bytes"]], np.int64), b"".join(rows["bytes"]))
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, lengths, joined = sent.value
        flat, starts = np.frombuffer(joined, np.uint8), np.cumsum(lengths) - lengths
        place = np.full(int(known[-1]) + 1 if len(known) else 0, -1, np.int64)
        place[known] = np.arange(len(known))

        def one(ids: bytes | None) -> bytes:
            found = np.frombuffer(ids or b"", "<u4")
            if not len(found):
                return b""
            if found.max() >= len(place) or (row := place[found]).min() < 0:
                raise ValueError("an id is not in the token-byte table")
            n = lengths[row]
            ends = np.cumsum(n)
            return flat[np.arange(int(ends[-1])) + np.repeat(starts[row] - (ends - n), n)].tobytes()

        for batch in batches:
            yield batch.assign(decoded=[one(x) for x in batch["ids"]])

    return encoded.select("doc_id", "ids").mapInPandas(run, "doc_id long, ids binary, decoded binary")


def digest(decoded: DataFrame) -> DataFrame:
    """n_tokens and sha256 digests of ids and decoded bytes of each document."""
    return decoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
