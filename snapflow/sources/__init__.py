"""Sources, landing and sinks."""

from snapflow.sources.raw import land_raw, landing_path, prepare_landing, read_raw, read_rejected
from snapflow.sources.responses import flatten_package, flatten_repo
from snapflow.sources.freshness import assert_fresh, fresh_counts
from snapflow.sources.sinks import as_view, qualify, write_table

__all__ = ["land_raw", "landing_path", "prepare_landing", "read_raw", "read_rejected", "flatten_package", "flatten_repo", "assert_fresh", "fresh_counts", "as_view",
           "qualify", "write_table"]
