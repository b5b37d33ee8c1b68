"""Table writes.

Every write goes through ``write_table`` with a ``TableSpec``. Partitioned writes first
``rebalance`` on the partition columns: rows of one partition value land in few tasks (few
files per directory) while adaptive execution still splits a value that holds a large share of
the rows. Rows that come dealt out already (``TableSpec.dealt``: read from files of the same layout, or
rebalanced before columns were added) are written as they lie. A write's shuffle files go when it ends, and
a table can be written in parts, so that those of one part at a time are on disk. A failed write raises; it
is never printed and skipped.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from portstar.session import shuffles_freed

PACKED = {"compression": "zstd"}     # options of the warehouse's and the store's tables


@dataclass(frozen=True)
class TableSpec:
    name: str
    path: str
    partition_by: tuple[str, ...] = ()
    mode: str = "overwrite"
    fmt: str = "parquet"
    options: dict = field(default_factory=dict)
    dealt: bool = False


@dataclass(frozen=True)
class WriteResult:
    table: str
    path: str
    rows: int | None
    ok: bool

    def status_line(self) -> str:
        rows = "" if self.rows is None else f", {self.rows} rows"
        return f"{self.table} written to {self.path}{rows}"


def write_table(df: DataFrame, spec: TableSpec, count_rows: bool = False) -> WriteResult:
    """Write ``df`` as ``spec`` says; optionally count the rows of this write while they pass."""
    out, seen = df, Observation()
    if count_rows:
        out = out.observe(seen, F.count(F.lit(1)).alias("rows"))
    if spec.partition_by and not spec.dealt:
        out = out.hint("rebalance", *spec.partition_by)
    writer = out.write.mode(spec.mode).format(spec.fmt).options(**spec.options)
    if spec.partition_by:
        writer = writer.partitionBy(*spec.partition_by)
    with shuffles_freed(df.sparkSession):
        writer.save(spec.path)
    rows = None
    if count_rows:
        rows = seen.get["rows"]
    return WriteResult(spec.name, spec.path, rows, True)


def write_parts(parts: DataFrame | Iterable[DataFrame], spec: TableSpec) -> WriteResult:
    """Write one table from parts of one schema, one after another."""
    result = None
    for part in [parts] if isinstance(parts, DataFrame) else parts:
        result = write_table(part, spec)
        spec = replace(spec, mode="append")
    if result is None:
        raise ValueError(f"no parts for {spec.name}")
    return result


def write_csv(df: DataFrame, path: str, sep: str = ",", header: bool = True) -> str:
    """Delimited text with a header line (used for round trips of the raw inputs)."""
    df.write.mode("overwrite").option("sep", sep).option("header", str(header).lower()).csv(path)
    return path


def preview(df: DataFrame, n: int = 5):
    """First ``n`` rows as pandas: the limit runs on the executors, only n rows travel."""
    return df.limit(n).toPandas()
