"""Column-set operators: positional rename, renaming by name, dropping sparse columns."""

from __future__ import annotations

from pyspark.sql import DataFrame


def rename_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """Give every column a new name, by position. A length mismatch is an error, not a truncation."""
    if len(names) != len(df.columns):
        raise ValueError(f"{len(df.columns)} columns but {len(names)} names: {names}")
    if len(set(names)) != len(names):
        raise ValueError(f"duplicate target names: {names}")
    return df.toDF(*names)


def rename_by_name(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename the named columns, keep the rest; every source name must exist."""
    absent = [c for c in mapping if c not in df.columns]
    if absent:
        raise ValueError(f"no such columns: {absent}")
    return df.withColumnsRenamed(mapping)


def sparse_columns(df: DataFrame, max_missing_pct: float) -> list[str]:
    """Columns whose missing share is above ``max_missing_pct``, from one aggregate pass.

    Only the one-row profile (one number per column) reaches the driver.
    """
    from portstar.operators.profile import missing_profile_wide

    row = missing_profile_wide(df).first()
    if row is None:
        return []
    return [c for c in df.columns if row[c] is not None and row[c] > max_missing_pct]


def drop_sparse_columns(df: DataFrame, max_missing_pct: float = 90.0) -> DataFrame:
    """Drop the columns that are mostly missing (null, or NaN for floating types).

    Deciding which columns to drop reads the data once and the result reads it again, so call
    it on a written (or persisted) frame rather than on an expensive lazy plan.
    """
    return df.drop(*sparse_columns(df, max_missing_pct))
