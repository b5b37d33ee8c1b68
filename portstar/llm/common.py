"""Small helpers shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from portstar.session import checkpoint_root, scratch_path


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """Read one table; only the named columns reach the scan."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*cols) if cols else df


def packed(df: DataFrame, name: str = "__row") -> DataFrame:
    """The whole row as one struct column, so that helper columns can never clash with its names."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name)) if df.columns \
        else df.select(F.struct(F.lit(None).alias("_")).alias(name))


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder ``spark.checkpoint.dir``.

    The rows are computed once and stored where every executor can read them again, so that a
    lost executor costs a re-read and no other outcome of a non-repeatable step. Spark removes the
    files when the frame is no longer used (``spark.cleaner.referenceTracking.cleanCheckpoints``).
    """
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def unit(*parts: Column | str | int) -> Column:
    """A uniform number in (0, 1) that depends only on ``parts`` (53 bits of xxhash64)."""
    cols = [p if isinstance(p, Column) else F.lit(p) for p in parts]
    return (F.shiftrightunsigned(F.xxhash64(*cols), 11).cast("double") + 0.5) / float(1 << 53)


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write a frame as Parquet below ``spark.checkpoint.dir`` and read it back.

    For rows with whole texts, where the compressed columns are much smaller than a checkpoint and
    later reads can prune columns. The files go when the application ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, purpose)
    df.write.parquet(path)
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(conf).deleteOnExit(target)
    return spark.read.schema(df.schema).parquet(path)
