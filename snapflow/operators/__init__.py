"""DataFrame operators: staging, latest row per key, dimension, metrics, trends, rank, history, checks."""

from snapflow.operators.checks import Check, DEFAULT_CHECKS, assert_checks, check_accepted, check_not_null, \
    check_unique, run_checks
from snapflow.operators.dimension import build_dimension
from snapflow.operators.history import history_rows, latest_rows, merge_frame, rebuild_history, sync_columns, \
    upsert, upsert_with_latest
from snapflow.operators.latest import latest_per_key
from snapflow.operators.metrics import build_metrics
from snapflow.operators.ranking import rank_desc, rank_table
from snapflow.operators.staging import stage_packages, stage_repos
from snapflow.operators.trends import build_trends

__all__ = [
    "Check", "DEFAULT_CHECKS", "assert_checks", "check_accepted", "check_not_null", "check_unique", "run_checks",
    "build_dimension", "history_rows", "latest_rows", "merge_frame", "rebuild_history", "sync_columns", "upsert",
    "upsert_with_latest", "latest_per_key", "build_metrics", "rank_desc", "rank_table", "stage_packages",
    "stage_repos", "build_trends",
]
