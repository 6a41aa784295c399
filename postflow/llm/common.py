"""What the operators share: reading texts, and cutting lineage in the shared folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postflow.session import new_folder
from postflow.sources.tables import test_table

# White space of the contracts, and words between it.
WHITE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return test_table(spark, sf_dir, name)


def filled(name: str) -> Column:
    """A text column whose nulls count as empty texts."""
    return F.coalesce(F.col(name), F.lit(""))


def whole_row(docs: DataFrame) -> Column:
    """All columns of a row as one, so that none clashes with an operator's own."""
    return F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("whole_row")


def named(key: str) -> Column:
    """An id as a text that is never null, so that plain equality joins and groups by it, and the
    shuffle of a join serves a window over the same ids."""
    return F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit(""))


def drawn(rows: DataFrame, key: str, size: int, total: int) -> DataFrame:
    """A sample of ``size`` rows by hash of their key, from about ``total``. Each task passes on
    only what falls below a bound that about twice the sample does, so that what meets in the end
    does not grow with the number of tasks."""
    share = min(1.0, (2 * size + 100) / max(1, total))
    draw = F.shiftrightunsigned(F.xxhash64(key), 11)  # 53 bits
    return rows.filter(draw <= int(share * (1 << 53))).orderBy(draw, key).limit(size)


def saved(frame: DataFrame, name: str) -> DataFrame:
    """The frame written to the cluster's shared folder and read again: a lost executor costs
    nothing that was computed before."""
    spark = frame.sparkSession
    folder = new_folder(spark, name)
    frame.write.parquet(folder)
    return spark.read.schema(frame.schema).parquet(folder)
