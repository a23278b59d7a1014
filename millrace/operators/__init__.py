"""Operators over data frames."""

from millrace.operators.dedup import dedup_latest, dedup_latest_grouped
from millrace.operators.envelope import (
    decode_envelope,
    decode_tagged,
    encode_envelope,
    event_frame,
    explode_records,
    quarantine,
)
from millrace.operators.layout import preview_rows, rechunk_csv
from millrace.operators.merge import (
    DuplicateSourceKeyError,
    merge_into,
    merge_update_insert,
    upsert_latest,
)
from millrace.operators.profile import profile
from millrace.operators.quality import (
    Check,
    run_metrics,
    run_verification,
    verification_metrics,
    verify,
    violating_rows,
)
from millrace.operators.ranges import as_of_join, interval_join
from millrace.operators.stamp import stamp_load_time
from millrace.operators.states import merge_states, metric_states, metrics_of
from millrace.operators.suggest import suggest_checks

__all__ = [
    "Check",
    "DuplicateSourceKeyError",
    "as_of_join",
    "decode_envelope",
    "decode_tagged",
    "dedup_latest",
    "dedup_latest_grouped",
    "encode_envelope",
    "event_frame",
    "explode_records",
    "interval_join",
    "merge_into",
    "merge_states",
    "merge_update_insert",
    "metric_states",
    "metrics_of",
    "preview_rows",
    "profile",
    "quarantine",
    "rechunk_csv",
    "run_metrics",
    "run_verification",
    "stamp_load_time",
    "suggest_checks",
    "upsert_latest",
    "verification_metrics",
    "verify",
    "violating_rows",
]
