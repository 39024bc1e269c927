"""Raw newline-JSON export."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import open_writers
from millrace.sources.jsonl import RAW_DAY

# Zone-less ISO text with every digit kept; the default format stops at milliseconds.
ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def write_day_jsonl(
    df: DataFrame,
    root: str,
    day_column: str,
    mode: str = "overwrite",
    gather: bool = True,
    compression: str = "none",
    lines_per_file: int = 0,
) -> None:
    """Replace the raw lines of every day in ``df`` below ``root``; other days stay. Mode ``append`` adds files instead.

    With ``gather`` a rebalance brings each day into few files and still splits a day too big for one task; without it
    there is no shuffle, and a file per task and day. A task keeps the files of its days open instead of sorting its rows.
    As compressed files can't be split by readers, ``lines_per_file`` bounds them.
    """
    rows = df.withColumnRenamed(day_column, RAW_DAY)
    if gather:
        rows = rows.hint("rebalance", F.col(RAW_DAY))
    with open_writers(df.sparkSession):
        (
            rows.write.mode(mode)
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(RAW_DAY)
            .option("timestampFormat", ISO_MICROS)
            .option("timestampNTZFormat", ISO_MICROS)
            .option("compression", compression)
            .option("zlib.compress.level", "BEST_SPEED")  # of gzip, if that is chosen: less time, more bytes
            .option("maxRecordsPerFile", lines_per_file)
            .json(root)
        )
