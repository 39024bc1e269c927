"""Which folders of a stream's table count, once days of it have been compacted.

``<table>/_generations/ingest_date=D/through=N`` says that the folder of generation N holds all rows of day D up to
micro-batch N. Such a pointer is one empty file, made when the generation is complete, so a reader sees a day either
before or after its compaction. Spark itself passes by folders with this name.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from millrace.files import delete, exists, matching, touch

DAY = "ingest_date"
MICRO_BATCH = "_micro_batch"


def _pointers(path: str) -> str:
    return f"{path}/_generations"


def generation(through: int) -> int:
    """The micro-batch number of the folder that holds all up to ``through``; real numbers begin at 0, -1 is a closed day."""
    return -(through + 2)


def covered_days(spark: SparkSession, path: str) -> dict[str, int] | None:
    """The last micro-batch in the generation of each compacted day; None if no compaction has ever begun."""
    if not exists(spark, _pointers(path)):
        return None
    found: dict[str, int] = {}
    for name in matching(spark, f"{_pointers(path)}/{DAY}=*/through=*"):
        day, through = name.rsplit("/", 2)[1:]
        day, number = day.split("=", 1)[1], int(through.split("=", 1)[1])
        found[day] = max(number, found.get(day, number))
    return found


def is_visible(covered: dict[str, int], day: str = DAY, number: str = MICRO_BATCH) -> Column:
    """Whether a folder counts, from its partition values alone, so that Spark prunes the others."""
    batch = F.col(number).cast("long")  # text where a session doesn't infer the types of folders
    if not covered:
        return batch >= -1
    of_days = F.create_map(*[F.lit(x) for pair in covered.items() for x in pair])
    through = F.try_element_at(of_days, F.col(day))
    newer = (batch > through) | (batch == -(through + 2))
    return F.when(through.isNull(), batch >= -1).otherwise(newer)


def begin(spark: SparkSession, path: str) -> None:
    """From now on readers pass by generations without a pointer."""
    touch(spark, f"{_pointers(path)}/begun")


def publish(spark: SparkSession, path: str, day: str, through: int) -> None:
    """The day's generation is complete; older pointers go after the new one is there."""
    touch(spark, f"{_pointers(path)}/{DAY}={day}/through={through}")
    for name in matching(spark, f"{_pointers(path)}/{DAY}={day}/through=*"):
        if int(name.rsplit("=", 1)[1]) < through:
            delete(spark, name)


def forget(spark: SparkSession, path: str, day: str) -> None:
    """The day is about to be written as a whole and has no generation from now on."""
    delete(spark, f"{_pointers(path)}/{DAY}={day}")
