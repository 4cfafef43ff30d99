"""Shapes of the registry, the run logs and the per-day key counts."""

from __future__ import annotations

REGISTRY = (
    "source string, key string, sub_field string, column_name string, column_type string, "
    "first_seen date, last_seen date, n_seen bigint, updated_at timestamp"
)

KEY_COUNTS = "source string, key string, sub_field string, n bigint, _run_id string, _dt date"

KEY_MONTHS = (
    "source string, key string, sub_field string, first_seen date, last_seen date, "
    "n_seen bigint, _dt date"
)

USER_DAYS = "user_pseudo_id string, active int, fresh int, _dt date"

RUN_LOG = (
    "event_date date, source_table string, is_intraday int, strategy string, "
    "source_row_count bigint, files_read bigint, bytes_read bigint, rows_inserted bigint, "
    "run_id string, started_at timestamp, finished_at timestamp, duration_sec bigint, "
    "status string, error_message string"
)

DAILY_LOG = (
    "event_date date, run_id string, status string, stage string, message string, "
    "warnings string, started_at timestamp, finished_at timestamp"
)
