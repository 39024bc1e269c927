"""Headline timings as one JSON line.

``queries`` holds our times. ``baseline`` holds the same two jobs in the shape the daily jobs are
usually written in: every count and write evaluates its input anew, and the surviving copy of a
key is left to chance. Both shapes run on the same rows, session and settings.
"""

from __future__ import annotations

import json
import os
import time
from functools import partial

from pyspark.sql import functions as F

from millrace.entities import PAYMENTS
from millrace.functions.predicates import all_hold
from millrace.lake import Lake, day_path
from millrace.operators.stamps import with_audit, with_quarantine_reason, with_silver_stamp
from millrace.plans import cleanse, ingest
from millrace.registry import all_queries
from millrace.registry.lakes import batched, filled_lake
from millrace.session import build_session, scratch_dir
from millrace.sinks import write_day_jsonl
from millrace.sources import on_day, read_jsonl, read_table

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
DAY = "2001-01-01"
JOB_REPEATS, QUERY_REPEATS = 3, 2
HEADLINE = (
    "dedupe_payments",
    "silver_payments_valid",
    "silver_payments_quarantine",
    "rule_counts",
    "violations",
    "lost_keys",
    "missing_rows",
    "extra_rows",
    "orphan_payments",
    "dup_keys",
    "cardinality",
    "metric_diff",
    "recon_counts_payments",
    "recon_row_counts",
    "distance_audit",
    "lifecycle",
    "fare_band",
    "payment_arith",
    "time_bounds",
    "tag_counts",
    "demand_15min",
    "demand_trips",
    "daily_volume",
    "jsonl_typed",
    "recon_raw_bronze",
    "backfill_payments_valid",
)


def best_of(action, repeats: int = JOB_REPEATS) -> float:
    times = []
    for _ in range(repeats):
        start = time.perf_counter()
        action()
        times.append(time.perf_counter() - start)
    return round(min(times), 3)


def drain(spark, run) -> None:
    run(spark, SF_DIR).write.format("noop").mode("overwrite").save()


def plain_ingest(spark, lake: Lake) -> None:
    raw = read_jsonl(spark, day_path(lake.raw, "payments", DAY), PAYMENTS.schema)
    raw.count()
    if raw.count():
        append_rows(with_audit(raw, DAY), lake.bronze("payments"))


def plain_cleanse(spark, lake: Lake, bronze: str) -> None:
    rows = on_day(read_table(spark, bronze, PAYMENTS.bronze_schema), DAY)
    rows = rows.dropDuplicates(["payment_id"])
    rule = all_hold(PAYMENTS.rules)
    valid, invalid = rows.filter(rule), rows.filter(~rule | rule.isNull())
    rows.count(), valid.count(), invalid.count()
    append_rows(with_silver_stamp(valid), lake.silver("payments"))
    append_rows(
        with_quarantine_reason(with_silver_stamp(invalid)), lake.quarantine("payments")
    )


def append_rows(df, path: str) -> None:
    df.write.mode("append").partitionBy("ingest_date").parquet(path)


def main() -> None:
    spark = build_session(
        "bench",
        master=f"local[{CPUS}]",
        extra={"spark.sql.shuffle.partitions": CPUS, "spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered = all_queries()

    # One raw day with every payment row, landed once for the cleanse.
    base = scratch_dir(spark, "bench")
    ours = Lake(root=f"{base}/ours", raw=f"{base}/raw")
    theirs = Lake(root=f"{base}/plain", raw=f"{base}/raw")
    day = batched(spark, SF_DIR, "payments").withColumn("batch_day", F.lit(DAY))
    write_day_jsonl(day, ours.raw_entity("payments"), "batch_day")
    filled_lake(spark, SF_DIR, "payments")

    times = {
        "ingest_day": best_of(partial(ingest, spark, ours, PAYMENTS, DAY)),
        "cleanse_day": best_of(partial(cleanse, spark, ours, PAYMENTS, DAY)),
    }
    baseline = {
        "ingest_day": best_of(partial(plain_ingest, spark, theirs)),
        "cleanse_day": best_of(
            partial(plain_cleanse, spark, theirs, ours.bronze("payments"))
        ),
    }
    for name in HEADLINE:
        times[name] = best_of(partial(drain, spark, registered[name].run), QUERY_REPEATS)
    print(
        json.dumps(
            {
                "metric": "headline queries, total of best times",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "baseline": baseline,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
