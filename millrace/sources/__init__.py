from millrace.sources.jsonl import list_days, raw_days, read_days, read_jsonl
from millrace.sources.tables import empty_table, latest_runs, on_day, read_table, read_table_day, read_table_days

__all__ = [
    "empty_table",
    "latest_runs",
    "list_days",
    "on_day",
    "raw_days",
    "read_days",
    "read_jsonl",
    "read_table",
    "read_table_day",
    "read_table_days",
]
