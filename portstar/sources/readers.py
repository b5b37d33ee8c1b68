"""Readers for the raw inputs and for written tables.

``read_arrivals`` takes any Spark source (CSV, Parquet, or a third-party format whose reader is
on the classpath) and returns the 13 source columns with the SAS types. ``read_demographics``
reads the ';' separated city file. Text files are read by their own header line, as strings, and
cast after; rows with a malformed cell, and lines with too few or too many fields, can be listed. ``read_table`` reads written Parquet
back with a schema, so partition values such as state code '07' stay strings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from portstar.sources.schemas import ARRIVALS_SCHEMA, DEMOGRAPHICS_SCHEMA

CORRUPT = "_corrupt_record"


def _conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Keep the schema's columns, in its order, cast to its types (column pruning reaches the scan)."""
    return df.select([F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])


def _read_text(spark: SparkSession, path: str, options: dict) -> DataFrame:
    """A delimited file with its own header line, every column as a string, and each line that does not
    have one field for each column of the header in ``CORRUPT``. All files of a folder need one header."""
    options = {"header": "true", "mode": "PERMISSIVE", **options}
    if "inferSchema" in options or options["mode"] != "PERMISSIVE":
        return spark.read.options(**options).csv(path)
    names = spark.read.options(**options).csv(path).schema
    # without pruning, as the parser counts the fields of the columns it is asked for only
    reader = spark.read.options(**{**options, "enforceSchema": "false", "columnPruning": "false",
                                   "columnNameOfCorruptRecord": CORRUPT})
    return reader.schema(with_corrupt_record(names)).csv(path)


def with_corrupt_record(schema: T.StructType) -> T.StructType:
    """A text schema with the column that takes whole malformed lines."""
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


def _require(df: DataFrame, schema: T.StructType, what: str) -> None:
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks columns {missing}")


def _bad_cell(field: T.StructField):
    """Whether a text cell holds something that is not a value of the field's type."""
    c = F.col(f"`{field.name}`")
    return c.isNotNull() & (F.trim(c) != "") & c.try_cast(field.dataType).isNull()


def typed_text(df: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """``(typed, rejects)`` of an all-string frame: the schema's columns picked by name.

    ``typed`` holds the rows in which every cell is a value of its column's type (blank numeric
    cells are null); ``rejects`` the other rows as text, with the names of the ``bad_columns``.
    Lines with too few or too many fields are rejects too: their bad column is ``CORRUPT``, and
    ``line`` has them as they stand. Each row is in exactly one of the two.
    """
    casts = [f for f in schema.fields if not isinstance(f.dataType, T.StringType)]
    line = F.col(CORRUPT) if CORRUPT in df.columns else F.lit(None).cast("string")
    torn = [F.when(line.isNotNull(), F.lit(CORRUPT))]
    bad = F.filter(F.array(*torn, *[F.when(line.isNull() & _bad_cell(f), F.lit(f.name)) for f in casts]),
                   lambda name: name.isNotNull())
    picked = df.select(*[F.col(f"`{f.name}`") for f in schema.fields], bad.alias("bad_columns"), line.alias("line"))
    good = picked.where(F.size("bad_columns") == 0).select(
        *[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema.fields])
    return good, picked.where(F.size("bad_columns") > 0)


def read_arrivals(spark: SparkSession, path: str, fmt: str = "parquet",
                  options: dict | None = None) -> DataFrame:
    """Arrival records from ``path``; ``fmt`` is any Spark source name.

    The 13 columns are picked by name, whatever else the source holds and in whatever order; a
    missing one raises. Text rows with a malformed cell are left to :func:`rejected_arrivals`.
    """
    options = dict(options or {})
    if fmt == "csv":
        df = _read_text(spark, path, options)
        _require(df, ARRIVALS_SCHEMA, "arrival source")
        return typed_text(df, ARRIVALS_SCHEMA)[0]
    df = spark.read.format(fmt).options(**options).load(path)
    _require(df, ARRIVALS_SCHEMA, "arrival source")
    return _conform(df, ARRIVALS_SCHEMA)


def rejected_arrivals(spark: SparkSession, path: str, options: dict | None = None) -> DataFrame:
    """The rows of an arrivals CSV that ``read_arrivals`` leaves out, as text, with their bad columns."""
    df = _read_text(spark, path, dict(options or {}))
    _require(df, ARRIVALS_SCHEMA, "arrival source")
    return typed_text(df, ARRIVALS_SCHEMA)[1]


def read_demographics(spark: SparkSession, path: str, sep: str = ";", infer_schema: bool = False,
                      mode: str = "PERMISSIVE") -> DataFrame:
    """City demographics from a delimited text file with a header line; columns picked by name."""
    options = {"sep": sep, "mode": mode}
    if infer_schema:
        return _read_text(spark, path, {**options, "inferSchema": "true"})
    df = _read_text(spark, path, options)
    _require(df, DEMOGRAPHICS_SCHEMA, "demographics source")
    return typed_text(df, DEMOGRAPHICS_SCHEMA)[0]


def rejected_demographics(spark: SparkSession, path: str, sep: str = ";") -> DataFrame:
    """The rows of a demographics file that ``read_demographics`` leaves out."""
    df = _read_text(spark, path, {"sep": sep})
    _require(df, DEMOGRAPHICS_SCHEMA, "demographics source")
    return typed_text(df, DEMOGRAPHICS_SCHEMA)[1]


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Written Parquet, optionally with a declared schema (then in the schema's column order)."""
    if schema is None:
        return spark.read.parquet(path)
    df = spark.read.schema(schema).parquet(path)
    return df.select([f.name for f in schema.fields])


def read_testdata(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's test tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register_views(tables: dict[str, DataFrame]) -> None:
    """Name DataFrames as SQL relations (session-scoped temp views)."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
