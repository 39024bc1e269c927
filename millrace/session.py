"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import ExitStack, contextmanager
from threading import Lock

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

PARTITION_BYTES = 256 * 1024 * 1024
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
#: What a task reads of files at most: their rows take many times as much in a sort, of which several run at a time.
SPLIT_BYTES = 32 * 1024 * 1024
SPLITS = "spark.sql.files.maxPartitionBytes"
ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
#: Within ``small_sorts``: what a task reads of files, what AQE merges shuffled rows up to (compressed, some four times as
#: much in a sort), and shuffle partitions for one that ``size_shuffles`` asked for.
SORT_SPLIT_BYTES = 8 * 1024 * 1024
SORT_ADVISORY_BYTES = 16 * 1024 * 1024
SORT_PARTS = 4
#: Files of different days that a task writes at a time; beyond that it sorts its rows by day.
WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
OPEN_DAYS = 400
#: Whether the shuffle files of a query go when it ends, instead of when the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Bytes of rows in memory for a byte of a file, by the end of its name; 1 for all others. A rough guess, not a measure.
EXPANDS = {".gz": 10, ".parquet": 10, ".orc": 10}
#: State outside the heap, within one bound for all stores of an executor, of which only changes are written.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def settings(input_bytes: int | None = None) -> dict[str, str]:
    """Settings every job wants; ``input_bytes`` sizes the first shuffle of one run.

    AQE merges small shuffle partitions and splits hot ones, so the first number only has to be
    large enough that a partition fits in an executor core's share of memory. It may do so in
    cached plans too; otherwise a day would be written in as many files as the shuffle has parts.
    """
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        ADVISORY: str(PARTITION_BYTES // 2),
        SPLITS: str(SPLIT_BYTES),
        "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
        **STATE_STORE,
        "spark.ui.enabled": "false",
    }
    if input_bytes is not None:
        conf[INITIAL_PARTITIONS] = str(initial_partitions(input_bytes))
    return conf


def initial_partitions(input_bytes: int) -> int:
    """Partitions of the first shuffle of an input: each of ``PARTITION_BYTES``, 8 at least."""
    return max(8, -(-input_bytes // PARTITION_BYTES))


def size_shuffles(spark: SparkSession, *paths: str, only_up: bool = False) -> None:
    """Size the session's first shuffles by the files below ``paths``; absent ones count as empty.

    Only names and lengths are listed; compressed files count as the rows they hold. A larger size that was set before,
    for jobs that run beside this one, stays; with ``only_up`` also the session's own number of shuffle partitions, if that
    is enough. Reads are sized as well.
    """
    size_reads(spark)
    weight = F.lit(1)
    for ending, factor in EXPANDS.items():
        weight = F.when(F.col("path").endswith(ending), factor).otherwise(weight)
    total = 0
    for path in paths:
        try:
            files = spark.read.format("binaryFile").load(path)
            total += files.agg(F.sum(F.col("length") * weight)).first()[0] or 0
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    wanted, before = initial_partitions(total), spark.conf.get(INITIAL_PARTITIONS, None)
    if only_up and before is None and wanted <= int(spark.conf.get("spark.sql.shuffle.partitions")):
        return
    spark.conf.set(INITIAL_PARTITIONS, str(max(wanted, int(before or 1))))


def size_reads(spark: SparkSession) -> None:
    """From now on a task reads ``SPLIT_BYTES`` of files at most; a smaller size that was set before stays."""
    if _bytes_of(spark, SPLITS) > SPLIT_BYTES:
        spark.conf.set(SPLITS, str(SPLIT_BYTES))


def _bytes_of(spark: SparkSession, key: str) -> int:
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key))


def size_state(spark: SparkSession) -> None:
    """State of the streams that start from now on is kept as ``STATE_STORE`` says, unless the session says otherwise."""
    for key, value in STATE_STORE.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)


#: Of settings that blocks hold now, by session and key: how many blocks, and the value before the first of them.
_HELD: dict[tuple[str, str], tuple[int, str | None]] = {}
_HOLDING = Lock()


@contextmanager
def setting(spark: SparkSession, key: str, value: object) -> Iterator[None]:
    """A setting of the session for as long as the block runs.

    Jobs side by side share the session: the value before comes back when the last block that holds the key ends.
    """
    held = (spark._jsparkSession.sessionUUID(), key)
    with _HOLDING:
        blocks, before = _HELD.get(held, (0, None))
        own = spark.conf.get(key, None)
        _HELD[held] = (blocks + 1, before if blocks else own)
        spark.conf.set(key, str(value))
    try:
        yield
    finally:
        with _HOLDING:
            blocks, before = _HELD[held]
            if blocks > 1:
                _HELD[held] = (blocks - 1, before)
                if own is not None:
                    spark.conf.set(key, own)  # of the block around this one, or of one beside it
            else:
                del _HELD[held]
                spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def _unheld(spark: SparkSession, key: str) -> str | None:
    """A setting as it is outside of all blocks."""
    with _HOLDING:
        blocks, before = _HELD.get((spark._jsparkSession.sessionUUID(), key), (0, None))
        return before if blocks else spark.conf.get(key, None)


def open_writers(spark: SparkSession):
    """Within the block, tasks that write rows of many days keep a file of each open instead of sorting by day."""
    return setting(spark, WRITERS, OPEN_DAYS)


def brief_shuffles(spark: SparkSession):
    """Within the block, the shuffle files of a write are deleted when it ends."""
    return setting(spark, CLEANUP, "true")


@contextmanager
def small_sorts(spark: SparkSession) -> Iterator[None]:
    """Within the block, what a task sorts of wide rows stays small, whatever the input's size: more tasks, no spill.

    Smaller sizes that were set before stay.
    """
    parts = _unheld(spark, INITIAL_PARTITIONS) or spark.conf.get("spark.sql.shuffle.partitions")
    with ExitStack() as held:
        for key, most in ((SPLITS, SORT_SPLIT_BYTES), (ADVISORY, SORT_ADVISORY_BYTES)):
            held.enter_context(setting(spark, key, min(most, _bytes_of(spark, key))))
        held.enter_context(setting(spark, INITIAL_PARTITIONS, SORT_PARTS * int(parts)))
        yield


def build_session(
    app_name: str,
    master: str | None = None,
    input_bytes: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**settings(input_bytes), **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, which every executor can reach.

    Only a local master may go without the setting; it then gets a temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="run-")
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"
