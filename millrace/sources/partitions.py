"""Partition values from the names of folders alone."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import SparkSession

from millrace.files import folders


def partition_values(spark: SparkSession, root: str, column: str) -> list[str]:
    """The values that the folders right below ``root`` name for a partition column, ascending; none without ``root``.

    One listing of one folder: no file is listed or opened, however many the partitions hold. Spark writes signs that
    a folder's name can't have as percent codes.
    """
    lead = f"{column}="
    return sorted(unquote(name[len(lead) :]) for name in folders(spark, root) if name.startswith(lead))
