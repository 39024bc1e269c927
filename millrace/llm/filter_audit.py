"""How quality filters interact: every order of the filters, enumerated by a recursive query over mask cells."""

from __future__ import annotations

from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import cut, join_split

#: A word ends at ASCII white space only.
SPACES = r"[\x20\x09-\x0D]+"
LETTERS = "ABCDE"
MAX_LETTERS = 7


def _conditions() -> dict[str, Column]:
    """Failure conditions of the filters that look at one row (columns text and words); E needs the whole table."""
    n_words, distinct = F.size("words"), F.size(F.array_distinct("words"))
    capitals = F.octet_length("text") - F.octet_length(F.regexp_replace("text", "[A-Z]+", ""))
    return {
        "A": n_words < 200,
        "B": 100 * distinct < 50 * n_words,
        "C": 100 * capitals > 2 * F.char_length("text"),
        "D": F.col("text").rlike(r"[#$%&*|]"),
    }


def _bit(letter: str) -> int:
    return 1 << LETTERS.index(letter)


def document_masks(docs: DataFrame) -> DataFrame:
    """doc_id, part and mask of every row: bit k is set where the row fails filter k of ``LETTERS``.

    One scan leaves a digest and four bits of each text; the copies are found on the digests, so no text is shuffled.
    A row fails E if a row with a smaller doc_id has the same text; a row without doc_id neither fails E nor makes
    others fail it, and rows that share a doc_id are not each other's copies.
    """
    texts = docs.select(
        "doc_id", F.coalesce("source", F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text")
    ).withColumn("words", F.array_remove(F.split("text", SPACES, -1), ""))
    mask = sum((F.when(fails, _bit(k)).otherwise(0) for k, fails in _conditions().items()), F.lit(0))
    facts = cut(
        texts.select("doc_id", "part", mask.alias("mask"), F.unhex(F.sha2("text", 256)).alias("digest")), "filter-facts"
    )
    copies = facts.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    is_copy = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))
    return join_split(facts, copies, ["digest"], "left").select(
        "doc_id", "part", (F.col("mask") + F.when(is_copy, _bit("E")).otherwise(0)).alias("mask")
    )


def mask_cells(masks: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of each part and mask: part, mask, n, good (labelled quality 1), toxic (labelled toxic 1).

    A doc_id with several labels counts as 1 if any label is 1. At most 32 cells a part.
    """
    marks = labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("long")).alias("good"), F.max((F.col("toxic") == 1).cast("long")).alias("toxic")
    )
    marked = join_split(masks, marks.where("good = 1 or toxic = 1"), ["doc_id"], "left")
    return marked.groupBy("part", "mask").agg(
        F.count("*").alias("n"),
        F.sum(F.coalesce("good", F.lit(0).cast("long"))).alias("good"),
        F.sum(F.coalesce("toxic", F.lit(0).cast("long"))).alias("toxic"),
    )


def enumerate_prefixes(cells: DataFrame, letters: str = LETTERS) -> DataFrame:
    """Every prefix of every order of ``letters``, joined with each mask of ``cells`` that occurs.

    prefix, step, letter, mask and the step's outcome for the rows of that mask as 0 or 1: kept, removed, redundant,
    unique_fails. A recursive query extends each prefix by its unused letters and carries the bits applied so far; each
    of its levels emits one step. Its size depends on the number of letters alone: at most 325 prefixes of five
    letters times 32 masks, however many rows and parts there are.
    """
    if not 0 < len(letters) <= MAX_LETTERS or len(set(letters)) < len(letters):
        raise ValueError(f"1 to {MAX_LETTERS} different letters, not {letters!r}: every order of them is listed")
    filters = ", ".join(f"named_struct('letter', '{x}', 'bit', {1 << k})" for k, x in enumerate(letters))
    return cells.sparkSession.sql(
        f"""
        WITH RECURSIVE trail(prefix, step, letter, applied, mask, kept, removed, redundant, unique_fails) AS (
          SELECT '', 0, '', 0, mask, 1, 0, 0, 0 FROM {{masks}}
          UNION ALL
          SELECT concat(prefix, f.letter), step + 1, f.letter, applied | f.bit, mask,
            CAST(mask & (applied | f.bit) = 0 AS INT),
            CAST(mask & f.bit <> 0 AND mask & applied = 0 AS INT),
            CAST(mask & f.bit <> 0 AND mask & applied <> 0 AS INT),
            CAST(mask = f.bit AS INT)
          FROM trail LATERAL VIEW explode(filter(array({filters}), x -> applied & x.bit = 0)) unused AS f)
        SELECT prefix, step, letter, mask, kept, removed, redundant, unique_fails FROM trail WHERE step > 0""",
        masks=cells.select("mask").distinct(),
    )


def audit_orders(cells: DataFrame, letters: str = LETTERS) -> DataFrame:
    """One row per part, order of ``letters`` and step, from counts by part and mask (part, mask, n, good, toxic).

    kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley as in the module's query. A prefix is
    counted once for all orders that begin with it. The tables that meet the cells have a fixed number of rows.
    """
    steps = cut(enumerate_prefixes(cells, letters), "filter-prefixes")
    orders_of = F.element_at(F.array(*[F.lit(factorial(len(letters) - s)) for s in range(1, len(letters) + 1)]), F.col("step"))
    here = lambda flag, weight: F.sum(F.col(flag) * F.col(weight)).alias
    counted = cells.join(F.broadcast(steps), "mask").groupBy("part", "prefix", "step", "letter").agg(
        here("kept", "n")("kept"),
        here("removed", "n")("removed"),
        here("redundant", "n")("redundant"),
        here("unique_fails", "n")("unique_fails"),
        here("removed", "good")("good_lost"),
        here("removed", "toxic")("toxic_lost"),
    )
    counted = cut(counted.withColumn("orders", orders_of.cast("long")), "filter-steps")  # at most 325 rows a part
    shares = counted.groupBy("part", "letter").agg(F.sum(F.col("removed") * F.col("orders")).alias("shapley"))
    whole = steps.where(F.col("step") == len(letters)).select(F.col("prefix").alias("filter_order")).distinct()
    at = whole.select("filter_order", F.explode(F.sequence(F.lit(1), F.lit(len(letters)))).alias("step"))
    at = at.select("filter_order", F.substring("filter_order", F.lit(1), F.col("step")).alias("prefix"))
    return counted.join(shares, ["part", "letter"]).join(F.broadcast(at), "prefix").select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"
    )


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Part, filter_order, step and the step's counts for all 120 orders of five filters over ``docs``.

    ``docs`` has doc_id, text and source, ``labels`` doc_id, quality and toxic; other columns are ignored. A null text
    counts as empty, a null source as the part ''. Repeated rows each count. Empty documents give an empty result,
    empty labels only zeros in good_lost and toxic_lost.
    """
    return audit_orders(cut(mask_cells(document_masks(docs), labels), "filter-cells"))
