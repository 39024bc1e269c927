from millrace.sinks.jsonl import write_day_jsonl
from millrace.sinks.runlog import log_run
from millrace.sinks.tables import (
    append_partitioned,
    replace_day,
    replace_days,
    replace_micro_batch,
    sample_rows,
    withdraw_rows,
)

__all__ = [
    "append_partitioned",
    "log_run",
    "replace_day",
    "replace_days",
    "replace_micro_batch",
    "sample_rows",
    "withdraw_rows",
    "write_day_jsonl",
]
