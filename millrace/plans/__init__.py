from millrace.plans.medallion import (
    CleanseCounts,
    IngestCounts,
    backfill_entity,
    cleanse,
    ingest,
    line_counts,
    run_day,
    run_range,
)
from millrace.plans.reconciliation import (
    RowDifferences,
    recon_filter,
    reconcile_counts,
    reconcile_digests,
    reconcile_layers,
    reconcile_raw,
    reconcile_raw_rows,
    reconcile_rows,
)

__all__ = [
    "CleanseCounts",
    "IngestCounts",
    "RowDifferences",
    "recon_filter",
    "backfill_entity",
    "cleanse",
    "ingest",
    "line_counts",
    "reconcile_counts",
    "reconcile_digests",
    "reconcile_layers",
    "reconcile_raw",
    "reconcile_raw_rows",
    "reconcile_rows",
    "run_day",
    "run_range",
]
