from millrace.streaming.compaction import compact_days, compact_stream, vacuum, vacuum_stream
from millrace.streaming.jobs import (
    demand_stream,
    ingest_stream,
    silver_stream,
    start_closed_days,
    start_demand,
    start_ingest,
    start_silver,
)
from millrace.streaming.late import demand_with_late, late_rows, start_demand_late

__all__ = [
    "compact_days",
    "compact_stream",
    "demand_stream",
    "demand_with_late",
    "ingest_stream",
    "late_rows",
    "silver_stream",
    "start_closed_days",
    "start_demand",
    "start_demand_late",
    "start_ingest",
    "start_silver",
    "vacuum",
    "vacuum_stream",
]
