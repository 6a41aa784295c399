"""Stored tables: Parquet, catalog or JDBC scans, and the seed rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postflow.schemas import TABLES


def test_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_table(spark: SparkSession, name: str, fmt: str | None = None, **options: str) -> DataFrame:
    """A table from the catalog, or from ``fmt`` (``parquet`` with ``path``, ``jdbc`` with ``url``).

    For a large JDBC table give ``partitionColumn``, ``lowerBound``,
    ``upperBound`` and ``numPartitions``; without them one task reads it.
    """
    if fmt is None:
        return spark.table(name)
    if fmt == "jdbc":
        options = {"dbtable": name, **options}
        return spark.read.format(fmt).options(**options).load()
    return spark.read.format(fmt).schema(TABLES[name]).options(**options).load()


# The rows the tables are seeded with.
SEED_TWEETS = [
    (1, "user1", "This is a #test tweet about #technology", 5, 10),
    (2, "user2", "Another #test tweet about #politics", 8, 15),
    (3, "user1", "A third tweet about #sports", 12, 20),
    (4, "user3", "Fourth tweet about #technology and #business", 7, 25),
    (5, "user2", "Fifth tweet about #news", 9, 18),
]
SEED_HASHTAGS = [
    ("technology", 25),
    ("politics", 18),
    ("sports", 15),
    ("business", 12),
    ("news", 10),
    ("test", 8),
]
SEED_USERS = [
    ("user1", 10, 150, 80),
    ("user2", 8, 120, 60),
    ("user3", 5, 90, 40),
]


def seed_tables(spark: SparkSession, at: datetime | None = None) -> dict[str, DataFrame]:
    """The seed rows as tables; ``at`` takes the place of the current time."""
    now: Column = F.current_timestamp() if at is None else F.lit(at).cast("timestamp")

    def table(name: str, rows: list[tuple], times: tuple[str, ...]) -> DataFrame:
        schema = TABLES[name]
        plain = [field for field in schema.fields if field.name not in times]
        frame = spark.createDataFrame(rows, type(schema)(plain))
        return frame.withColumns({time: now for time in times}).select(*schema.names)

    return {
        "tweets": table("tweets", SEED_TWEETS, ("timestamp",)),
        "hashtag_counts": table("hashtag_counts", SEED_HASHTAGS, ("window_end", "last_updated")),
        "user_activity": table("user_activity", SEED_USERS, ("window_end", "last_updated")),
    }
