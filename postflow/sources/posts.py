"""Posts from CSV files and from the driver's event table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postflow.functions.text import event_time, plain_newlines
from postflow.schemas import CSV_COLUMNS, CSV_SCHEMA

# Quotes inside a quoted field are doubled, as CSV writers commonly do.
CSV_OPTIONS = {"quote": '"', "escape": '"'}

POST_COLUMNS = ("tweet_id", "username", "text", "retweets", "likes", "timestamp")


def csv_records(spark: SparkSession, path: str, record_sep: str | None = None,
                streaming: bool = False, **options: str) -> DataFrame:
    """CSV rows as text columns, taken by the names in the header, in any order.

    The names come from the first file; a file whose header differs is an error, as its columns
    could be mistaken for others. A stream takes its columns as ``CSV_COLUMNS`` has them, with the
    same check. A quoted text may span lines, so Spark cannot split such a file and one task reads
    each file: right for many files of moderate size. Large files are split over many tasks if
    records end in a ``record_sep`` of one or two characters that no text holds, such as CR LF
    against LF.
    """
    shape = {"multiLine": "true"} if record_sep is None else {"lineSep": record_sep}
    options = {"header": "true", "enforceSchema": "false", **shape, **CSV_OPTIONS, **options}
    if streaming:
        return spark.readStream.schema(CSV_SCHEMA).options(**options).csv(path)
    records = spark.read.options(**options).csv(path)
    if lacking := set(CSV_COLUMNS) - set(records.columns):
        raise ValueError(f"{path}: no column {sorted(lacking)} among {records.columns}")
    return records.select(*CSV_COLUMNS)


def typed_posts(records: DataFrame) -> DataFrame:
    """CSV columns renamed and typed; a value that does not convert gives null."""
    return records.select(
        F.col("Tweet_ID").try_cast("long").alias("tweet_id"),
        F.col("Username").alias("username"),
        plain_newlines("Text").alias("text"),
        F.col("Retweets").try_cast("int").alias("retweets"),
        F.col("Likes").try_cast("int").alias("likes"),
        event_time("Timestamp").alias("timestamp"),
    )


def csv_posts(spark: SparkSession, path: str, record_sep: str | None = None,
              streaming: bool = False, limit: int | None = None,
              **options: str) -> DataFrame:
    """Typed posts of a CSV; ``limit`` caps whole records, never lines."""
    records = csv_records(spark, path, record_sep, streaming, **options)
    if limit is not None:
        records = records.limit(limit)
    return typed_posts(records)


def event_posts(events: DataFrame) -> DataFrame:
    """The event table seen as posts."""
    k: Column = F.get_json_object("props", "$.k")
    return events.select(
        F.col("event_id").alias("tweet_id"),
        F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("username"),
        F.concat(F.lit("saw #"), F.col("event_type"), F.lit(" #k"), k).alias("text"),
        k.cast("int").alias("retweets"),
        F.floor("value").cast("int").alias("likes"),
        F.col("ts").alias("timestamp"),
    )
