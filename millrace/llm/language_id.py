"""Language identification: a bit-sliced Bloom filter tells for each n-gram all languages that contain it."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import cut, mix

#: Labels of rows with this remainder of crc32(doc_id as text) are never learnt from.
FOLDS, HELD_OUT = 4, 2
#: About so many rows of each language are learnt from, those with the smallest hash of their doc_id.
SAMPLE_ROWS = 2_000
#: An n-gram belongs to a language if it is in this share of its sample, and in this part of the share that it has in
#: any other language, as texts hold passages of other languages; the most frequent ones only, if there are more.
MIN_SHARE, RELATIVE, MAX_NGRAMS = 0.002, 0.2, 50_000
#: Letters in an n-gram; a word's ends count as one.
SIZES = (2, 3, 4)
HASHES = 3
#: Places of the filter for each n-gram of the largest language.
PLACES = 16
#: Letters that are looked up at a time; a longer run of letters counts as several words.
CHUNK = 1 << 18
UNKNOWN = "und"
_LETTERS: list[np.ndarray] = []


def held_out(doc_id: Column | str) -> Column:
    """True where crc32(doc_id as text) mod 4 is 2, and for a null doc_id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(True))


def _is_letter() -> np.ndarray:
    """Whether each code point is a letter; made once a worker."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _LETTERS[0]


def _pieces(text: str) -> Iterator[str]:
    """``text`` in pieces of at most twice ``CHUNK``, cut where no letter is if there is such a place."""
    start = 0
    while len(text) - start > 2 * CHUNK:
        gap = re.compile(r"[\W\d_]").search(text, start + CHUNK, start + 2 * CHUNK)
        end = gap.start() if gap else start + 2 * CHUNK
        yield text[start:end]
        start = end
    yield text[start:]


def ngrams(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hashes of the n-grams of ``texts``, and for each the number of its text.

    Text is lower-cased, words are runs of letters. An n-gram lies within a word or takes in its ends.
    """
    codes = np.frombuffer("\n".join(["", *texts, ""]).lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.array([len(t.lower()) + 1 for t in texts], np.int64)
    owner = np.concatenate([[0], np.repeat(np.arange(len(texts)), lengths)])
    letter = _is_letter()[codes]
    letter[1:] |= letter[:-1].copy()  # of a run of other characters, the first one stays
    letter[0] = True
    codes, owner = np.where(_is_letter()[codes], codes, 0)[letter].astype(np.uint64), owner[letter]
    inside = codes != 0
    for size in SIZES:
        n = len(codes) - size + 1
        if n < 1:
            continue
        hashed, whole = np.full(n, size, np.uint64), np.ones(n, bool)
        for k in range(size):
            hashed = hashed * np.uint64(0x5851F42D4C957F2D) + codes[k : k + n]
            if 0 < k < size - 1:
                whole &= inside[k : k + n]
        if size == 2:
            whole &= inside[:-1] | inside[1:]
        yield mix(hashed[whole]), owner[1 : n + 1][whole]


def _batches(texts: pd.Series) -> Iterator[tuple[np.ndarray, list[str]]]:
    """Row numbers and pieces of the texts, of about ``CHUNK`` letters at a time."""
    rows, pieces, size = [], [], 0
    for row, text in enumerate(texts):
        for piece in _pieces(text) if text else ():
            rows.append(row)
            pieces.append(piece)
            size += len(piece)
            if size >= CHUNK:
                yield np.array(rows), pieces
                rows, pieces, size = [], [], 0
    if pieces:
        yield np.array(rows), pieces


@dataclass(frozen=True)
class NgramFilter:
    """A row of language bits for each place; an n-gram's languages are what the rows at its places have in common."""

    languages: list[str]
    places: np.ndarray  # (places, bytes of language bits)
    by_chance: np.ndarray  # for each language, the chance that it claims an n-gram that it does not contain
    fallback: str

    def languages_of(self, hashes: np.ndarray) -> np.ndarray:
        """(n-grams, languages) of 0 and 1."""
        bits = None
        for at in _places(hashes, len(self.places)):
            bits = self.places[at] if bits is None else bits & self.places[at]
        return np.unpackbits(bits, axis=1, count=len(self.languages))

    def decide(self, texts: pd.Series) -> pd.DataFrame:
        if not self.languages:
            return pd.DataFrame({"lang_pred": [UNKNOWN] * len(texts), "score": 0.0})
        found = np.zeros((len(texts), len(self.languages)))
        total = np.zeros(len(texts))
        for rows, pieces in _batches(texts):
            for hashes, owner in ngrams(pieces):
                if not len(hashes):
                    continue
                starts = np.flatnonzero(np.diff(owner, prepend=-1))
                at = rows[owner[starts]]
                np.add.at(total, at, np.diff(np.append(starts, len(owner))))
                np.add.at(found, at, np.add.reduceat(self.languages_of(hashes), starts, axis=0, dtype=np.int64))
        share = (found / np.maximum(total, 1)[:, None] - self.by_chance) / (1 - self.by_chance)
        share = np.clip(share, 0, 1)
        best = share.argmax(axis=1)
        top, known = share.max(axis=1), share.sum(axis=1)
        names = np.array([*self.languages, self.fallback, UNKNOWN], object)
        chosen = np.where(total == 0, len(names) - 1, np.where(top > 0, best, len(names) - 2))
        return pd.DataFrame({"lang_pred": names[chosen], "score": top / np.where(known > 0, known, 1)})


def _places(hashes: np.ndarray, n: int) -> Iterator[np.ndarray]:
    step = (hashes >> np.uint64(32)) | np.uint64(1)
    for k in range(HASHES):
        yield (hashes + np.uint64(k) * step) & np.uint64(n - 1)


def build_filter(found: pd.DataFrame, rows: dict[str, int]) -> NgramFilter:
    """The filter of n-grams (lang, gram); ``rows`` are the sampled rows of every language."""
    languages = sorted(rows)
    per_language = found.groupby("lang").size()
    places = 1 << max(10, int(PLACES * per_language.max() - 1).bit_length() if len(per_language) else 0)
    bits = np.zeros((places, -(-len(languages) // 8)), np.uint8)
    filled = np.zeros(len(languages))
    for k, language in enumerate(languages):
        hashes = found["gram"].to_numpy()[found["lang"].to_numpy() == language].view(np.uint64)
        at = np.unique(np.concatenate([*_places(hashes, places)])) if len(hashes) else hashes
        bits[at, k // 8] |= np.uint8(128 >> k % 8)
        filled[k] = len(at) / places
    return NgramFilter(languages, bits, filled**HASHES, max(languages, key=lambda x: (rows[x], x), default=UNKNOWN))


def _document_ngrams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """For each batch and language, the n-grams of its documents and in how many documents each one is."""
    for batch in batches:
        langs, texts = batch["lang"].to_numpy(object), batch["text"]
        for language in pd.unique(langs):
            mine = texts[langs == language].reset_index(drop=True)
            for rows, pieces in _batches(mine):
                seen = {}
                for hashes, owner in ngrams(pieces):
                    for text in np.unique(owner):
                        seen.setdefault(rows[text], []).append(hashes[owner == text])
                each = [np.unique(np.concatenate(parts)) for parts in seen.values()]
                if each:
                    gram, n = np.unique(np.concatenate(each), return_counts=True)
                    yield pd.DataFrame({"lang": language, "gram": gram.view(np.int64), "n": n})


def learn(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> NgramFilter:
    """The filter of ``docs`` (doc_id, text, lang) outside the held-out fold, from about ``sample_rows`` rows a language.

    The sample is chosen by a hash of doc_id, so it is the same on every run. N-grams are counted by documents, in
    Spark; at most ``MAX_NGRAMS`` a language come to the driver. A very long text counts once for each of its pieces.
    """
    spark = docs.sparkSession
    known = docs.where(F.col("lang").isNotNull() & ~held_out("doc_id"))
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return build_filter(pd.DataFrame({"lang": [], "gram": np.zeros(0, np.int64)}), {})
    share = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, sample_rows / n))])
    chosen = F.pmod(F.xxhash64("doc_id", F.lit(29)), F.lit(1 << 20)) < share[F.col("lang")] * (1 << 20)
    sample = known.where(chosen).select("lang", "text")
    counts = cut(
        sample.mapInPandas(_document_ngrams, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")), "ngrams"
    )
    taken = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, float(min(n, sample_rows)))])
    shares = counts.withColumn("share", F.col("n") / taken[F.col("lang")]).where(F.col("share") >= MIN_SHARE)
    most = F.max("share").over(Window.partitionBy("gram"))  # a row per language
    often = shares.withColumn("most", most).where(F.col("share") >= F.col("most") * RELATIVE)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    kept = often.withColumn("rank", rank).where(F.col("rank") <= MAX_NGRAMS).select("lang", "gram").toPandas()
    return build_filter(kept, {lang: min(n, sample_rows) for lang, n in sizes.items()})


def identify_languages(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row of ``docs`` (doc_id, text, lang).

    The language that contains most of a text's n-grams, after those that its filter claims by chance are taken off;
    the score is its share among all languages' counts. A null text or one without a letter is ``und`` with score 0,
    a text of which no language knows anything gets the most frequent one with score 0, equal counts the first by name.
    Repeated rows get a row each, an empty table an empty result; without any labelled row all is ``und``.
    """
    model = learn(docs, sample_rows)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most MAX_NGRAMS a language: some bytes for each

    @F.pandas_udf("lang_pred string, score double")
    def decide(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield shared.value.decide(texts)

    decided = docs.select("doc_id", held_out("doc_id").alias("held_out"), decide("text").alias("decided"))
    return decided.select("doc_id", "held_out", "decided.lang_pred", "decided.score")
