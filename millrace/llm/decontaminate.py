"""Benchmark decontamination by spaced-seed hashing, as in homology search (Ma, Tromp and Li, 2002).

Fixed masks choose some words of a window and ignore the rest, so a window still meets its origin when words at ignored
places were replaced. Seeds of documents and benchmark items meet in a join by hash; the texts around each hit are
aligned without gaps and compared word by word.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from fractions import Fraction
from functools import lru_cache
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import HASH_TABLE_SIZE, MOST_BITS, ROW_BITS, cut, each_batch, join_split, mix, n_bits_for, without_ids

#: Windows of 11 words of which a mask reads those marked 1. Fixed masks: wherever a fifth of the words of a stretch of 13 or
#: more were replaced, or of a whole item of 11 or 12, one of them reads a window without replaced words.
MASKS = (
    "11101001101", "11010110011", "10110011101", "11001101011", "10111100011", "10001011111", "11110101001", "11100111010",
    "11111000011", "11001110101", "10111111000",
)
SPAN = len(MASKS[0])
#: An overlap counts if so many of its words agree ...
SIMILARITY = 0.8
#: ... and it has so many words, or the whole item if that is shorter.
MIN_WORDS = 13
#: Each seed sets three bits of the bitmap, from these places of its hash on.
BIT_SHIFTS = (0, 18, 36)
#: Texts are hashed together up to about so many words, as many short array steps would cost more than the work.
GROUP_WORDS = 16_384
WORD = re.compile(r"\w+")


class _Numbers(dict):
    def __missing__(self, word: str) -> int:
        import xxhash

        value = self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return value


def word_hashes(text: str | None, numbers: _Numbers) -> np.ndarray:
    """Hashes of the words of a whole text in order; words are runs of letters and digits in lower case."""
    if len(numbers) > HASH_TABLE_SIZE:
        numbers.clear()
    words = WORD.findall((text or "").lower())
    return np.fromiter(map(numbers.__getitem__, words), np.uint64, len(words))


@lru_cache(maxsize=SPAN)
def short_masks(size: int) -> list[list[int]]:
    """The words that each mask of a run of ``size`` words below a window reads. A fifth of the words may be replaced, not
    the first or last: the inner words are put in twice as many groups as that, and each mask ignores half of the groups."""
    replaced = size // 5
    groups = [set(range(1 + g, size - 1, 2 * replaced)) for g in range(2 * replaced)]
    ignored = [set().union(*some) for some in combinations(groups, replaced)]
    return [[k for k in range(size) if k not in some] for some in ignored]


def seeds(words: np.ndarray) -> list[np.ndarray]:
    """For each mask the hash of every window. A text shorter than a window has seeds of its whole length."""
    if 0 < len(words) < SPAN:
        return [h for _, h in _short_seeds(words, np.array([len(words)]))]
    n = len(words) - SPAN + 1
    out = []
    for number, mask in enumerate(MASKS):
        if n < 1:
            break
        h = np.full(n, number + SPAN, np.uint64)
        for at in np.flatnonzero(np.array([*mask]) == "1"):
            h = h * np.uint64(0x5851F42D4C957F2D) + words[at : at + n]
        out.append(mix(h))
    return out


def _short_seeds(words: np.ndarray, lengths: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """Hashes of the runs that may agree with a whole short item, by run length."""
    out = []
    for size in map(int, lengths):
        n = len(words) - size + 1
        for number, mask in enumerate(short_masks(size) if n > 0 else []):
            h = np.full(n, size + 64 * number, np.uint64)
            for k in mask:
                h = h * np.uint64(0x5851F42D4C957F2D) + words[k : k + n]
            out.append((size, mix(h)))
    return out


def _item_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The seeds of each item; its words stand beside the first one alone, so rows grow as its length does."""
    numbers = _Numbers()

    def batch(items: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for item_id, text in zip(items["item_id"], items["text"], strict=True):
            words = word_hashes(text, numbers)
            first = len(rows)
            for h in seeds(words):
                rows += [(item_id, len(words), at, x, None) for at, x in enumerate(h.view(np.int64).tolist())]
            if len(rows) > first:
                rows[first] = (*rows[first][:-1], words.view(np.int64))
        return pd.DataFrame(rows, columns=["item_id", "n_words", "item_at", "seed", "item_words"])

    return each_batch(batches, batch)


def _held(bits: np.ndarray, seed: np.ndarray) -> np.ndarray:
    """Places of the seeds whose bits are all set."""
    place, mask = np.arange(len(seed)), np.uint64(len(bits) * 8 - 1)
    for shift in BIT_SHIFTS:
        bit = (seed[place] >> np.uint64(shift)) & mask
        place = place[(bits[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1]
    return place


def _seeds_of_many(words: np.ndarray, ends: np.ndarray, bits: np.ndarray, short: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and seeds that the bitmap may hold, in order, of texts laid end to end; ``ends`` is where each place's text
    ends. Windows that reach into the next text are left out."""
    found = [(SPAN, h) for h in (seeds(words) if len(words) >= SPAN else [])] + _short_seeds(words, short)
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    places, hashes = [], []
    for size, h in found:
        at = _held(bits, h)
        at = at[at + size <= ends[at]]
        places.append(at)
        hashes.append(h[at])
    at, seed = np.concatenate(places), np.concatenate(hashes)
    order = np.argsort(at, kind="stable")
    return at[order], seed[order]


def _groups(docs: pd.DataFrame, numbers: _Numbers) -> Iterator[list[tuple[int, np.ndarray]]]:
    """Documents and their words, some ``GROUP_WORDS`` words at a time."""
    group, size = [], 0
    for doc_id, text in zip(docs["doc_id"], docs["text"], strict=True):
        group.append((doc_id, word_hashes(text, numbers)))
        size += len(group[-1][1])
        if size >= GROUP_WORDS:
            yield group
            group, size = [], 0
    if group:
        yield group


def _hit_regions(bits: np.ndarray, longest: int, short: np.ndarray):
    """Stretches of a document around seeds that the benchmark may hold: their words, and the seeds with their places."""

    def regions(group: list[tuple[int, np.ndarray]]) -> Iterator[tuple]:
        lengths = np.array([len(words) for _, words in group])
        ends = np.cumsum(lengths)
        at, seed = _seeds_of_many(np.concatenate([words for _, words in group]), np.repeat(ends, lengths), bits, short)
        if not len(at):
            return
        owner = np.searchsorted(ends, at, side="right")
        breaks = np.flatnonzero((np.diff(at) > 2 * longest) | (np.diff(owner) > 0)) + 1
        for where, what, who in zip(np.split(at, breaks), np.split(seed, breaks), owner[np.concatenate([[0], breaks])], strict=True):
            doc_id, words = group[who]
            where = where - (ends[who] - lengths[who])
            low, high = max(0, int(where[0]) - longest), int(where[-1]) + longest
            yield doc_id, low, words[low:high].view(np.int64), (where - low).astype(np.int32), what.view(np.int64)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        numbers = _Numbers()
        for docs in batches:
            rows = [row for group in _groups(docs, numbers) for row in regions(group)]
            if rows:
                yield pd.DataFrame(rows, columns=["doc_id", "region", "words", "at", "seed"])

    return run


def _best_overlap(item: np.ndarray, region: np.ndarray, start: int, similarity: float, min_words: int) -> tuple[int, int, int]:
    """Of the words of ``item`` laid on ``region`` from ``start``: first place, length and agreeing words of the longest
    stretch that begins and ends with agreeing words and reaches ``similarity``; zeros if none is long enough."""
    low, high = max(0, -start), min(len(item), len(region) - start)
    same = item[low:high] == region[start + low : start + high]
    places = np.flatnonzero(same)
    if not len(places):
        return 0, 0, 0
    # agree >= similarity * length in whole numbers: a stretch from a to b will do if after[b] >= before[a]
    ratio = Fraction(similarity).limit_denominator(1000)
    rank = np.arange(len(places))
    before, after = (ratio.denominator * (rank + k) - ratio.numerator * (places + k) for k in (0, 1))
    best_after = np.maximum.accumulate(after[::-1])[::-1]  # never rises, so each start's farthest end is found by bisection
    last = np.searchsorted(-best_after, -before, side="right") - 1
    length = np.where(last >= rank, places[last] - places + 1, 0)
    a = int(np.argmax(length))
    if length[a] < min(min_words, len(item)):
        return 0, 0, 0
    return int(places[a] + low), int(length[a]), int(last[a] - a + 1)


def _verify(similarity: float, min_words: int):
    def batch(hits: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for h in hits.itertuples(index=False):
            first, length, agree = _best_overlap(h.item_words, h.words, h.diagonal, similarity, min_words)
            if length:
                rows.append((h.doc_id, h.item_id, h.region + h.diagonal + first, length, agree, h.n_words))
        return pd.DataFrame(rows, columns=["doc_id", "item_id", "first_word", "n_overlap", "n_agree", "n_words"])

    return lambda batches: each_batch(batches, batch)


def find_overlaps(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, min_words: int = MIN_WORDS) -> DataFrame:
    """Pairs (doc_id, item_id) with their longest overlap: first_word, n_overlap, n_agree, n_words (of the item), coverage.

    A document overlaps an item where the two, laid on each other without gaps, agree in ``similarity`` or more of the
    words of a stretch of ``min_words`` words, or of the whole item if that is shorter. Words are runs of letters and
    digits in lower case. Wherever the replaced words stand, one of the masks reads only words that agree. Ties go to the first place. Null and empty texts overlap
    nothing, null ids neither; repeated rows count once. Empty tables give an empty result.

    Seeds of the documents leave the scan only if their bits are set in a bitmap of the benchmark's seeds: 1 to 32 MiB, by
    their number. A benchmark of more than 33 million seeds has fewer bits for each, so more windows leave for nothing. All
    else meets in shuffled joins, so a benchmark may be of any size.
    """
    spark = docs.sparkSession
    items = cut(
        benchmark.where("item_id is not null").select("item_id", "text").mapInPandas(
            _item_rows, "item_id long, n_words int, item_at int, seed long, item_words array<long>"
        ),
        "benchmark-seeds",
    )
    sizes = items.groupBy("n_words").agg(F.count("*").alias("n")).toPandas()  # at most one row for each item length
    longest = max([SPAN, *sizes["n_words"]])
    short = np.array(sorted(n for n in sizes["n_words"] if n < SPAN), np.int64)
    n_bits = min(MOST_BITS, n_bits_for(items.count()))
    bit = lambda shift: F.shiftrightunsigned("seed", shift).bitwiseAND(F.lit(n_bits - 1)) + 1  # noqa: E731  from 1
    at = F.col("bit")
    rows = items.select(F.explode(F.array(*map(bit, BIT_SHIFTS))).alias("bit")).groupBy(F.bitmap_bucket_number(at).alias("row")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits"))
    bits = np.zeros(n_bits // 8, np.uint8)
    for row, part in rows.collect():  # at most MOST_BITS / ROW_BITS rows of 4 KiB
        bits[(row - 1) * ROW_BITS // 8 : row * ROW_BITS // 8] = np.frombuffer(bytes(part), np.uint8)
    sent = spark.sparkContext.broadcast((bits, longest, short))
    regions = cut(
        docs.where("doc_id is not null").select("doc_id", "text").mapInPandas(
            lambda batches: _hit_regions(*sent.value)(batches),
            "doc_id long, region int, words array<long>, at array<int>, seed array<long>",
        ),
        "hit-regions",
    )
    hits = regions.select("doc_id", "region", F.explode(F.arrays_zip("at", "seed")).alias("hit"))
    hits = hits.select("doc_id", "region", F.col("hit.at").alias("at"), F.col("hit.seed").alias("seed"))
    placed = items.select("item_id", "item_at", "seed")
    met = join_split(hits, placed, ["seed"]).select("doc_id", "region", "item_id", (F.col("at") - F.col("item_at")).alias("diagonal"))
    texts = items.where("item_words is not null").select("item_id", "n_words", "item_words").dropDuplicates(["item_id", "item_words"])
    whole = met.distinct().join(regions.select("doc_id", "region", "words"), ["doc_id", "region"]).join(texts, "item_id")
    kind = "doc_id long, item_id long, first_word int, n_overlap int, n_agree int, n_words int"
    overlaps = whole.mapInPandas(_verify(similarity, min_words), kind)
    best = overlaps.groupBy("doc_id", "item_id").agg(
        F.max(F.struct("n_overlap", "n_agree", (-F.col("first_word")).alias("before"), "n_words")).alias("best")
    )
    return best.select(
        "doc_id", "item_id", (-F.col("best.before")).alias("first_word"), "best.n_overlap", "best.n_agree", "best.n_words",
        (F.col("best.n_agree") / F.col("best.n_words")).alias("coverage"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` without the documents that overlap a benchmark item. All columns stay."""
    return without_ids(docs, cut(find_overlaps(docs, benchmark, similarity, min_words).select("doc_id").distinct(), "contaminated"))

