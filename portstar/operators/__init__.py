"""Relational operators built from DataFrame calls."""

from portstar.operators.columns import (
    drop_sparse_columns,
    rename_by_name,
    rename_columns,
    sparse_columns,
)
from portstar.operators.dedup import dedup_by_key, dedup_repeated, duplicate_keys
from portstar.operators.joins import bounded_broadcast, join_on_keys, unmatched_rows
from portstar.operators.profile import (
    has_nulls,
    missing_profile,
    missing_profile_wide,
    null_check,
    null_counts,
    null_rows,
    null_rows_union,
)
from portstar.operators.setops import union_all
from portstar.operators.surrogate import dense_key, hash_key

__all__ = [
    "drop_sparse_columns", "rename_by_name", "rename_columns", "sparse_columns",
    "dedup_by_key", "dedup_repeated", "duplicate_keys", "bounded_broadcast", "join_on_keys", "unmatched_rows",
    "has_nulls", "missing_profile", "missing_profile_wide", "null_check", "null_counts", "null_rows",
    "null_rows_union", "union_all", "dense_key", "hash_key",
]
