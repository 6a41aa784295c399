"""Topics, message schemas, table schemas and merge rules, each stated once."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import types as T

# Topic names.
TWEETS_TOPIC = "tweets_topic"
HASHTAGS_TOPIC = "hashtags_topic"
USER_ACTIVITY_TOPIC = "user_activity_topic"
# Windowed results that are sent on get topics of their own: on the input
# topics the jobs would read their own output as posts.
HASHTAG_WINDOWS_TOPIC = "hashtag_windows_topic"
USER_WINDOWS_TOPIC = "user_windows_topic"

# Event-time settings.
WINDOW = "15 minutes"
SLIDE = "5 minutes"
LATENESS = "20 minutes"
TRIGGER = "30 seconds"


STRING, INT, LONG = T.StringType(), T.IntegerType(), T.LongType()
DOUBLE, TIME, BINARY = T.DoubleType(), T.TimestampType(), T.BinaryType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# Columns of files, fields of messages, columns of tables.
CSV_COLUMNS = ("Tweet_ID", "Username", "Text", "Retweets", "Likes", "Timestamp")
CSV_SCHEMA = _struct(**dict.fromkeys(CSV_COLUMNS, STRING))

TWEET_MESSAGE = _struct(
    tweet_id=LONG, username=STRING, text=STRING, retweets=INT, likes=INT, timestamp=STRING)
HASHTAG_MESSAGE = _struct(
    tweet_id=LONG, hashtag=STRING, username=STRING, timestamp=STRING)
ACTIVITY_MESSAGE = _struct(
    username=STRING, tweet_count=INT, hashtag_count=INT, retweets=INT, likes=INT,
    timestamp=STRING)

MESSAGES = {
    TWEETS_TOPIC: TWEET_MESSAGE,
    HASHTAGS_TOPIC: HASHTAG_MESSAGE,
    USER_ACTIVITY_TOPIC: ACTIVITY_MESSAGE,
}

# Fields a record cannot do without; the others may be null.
REQUIRED = {
    TWEETS_TOPIC: ("tweet_id", "username", "text", "retweets", "likes", "timestamp"),
    HASHTAGS_TOPIC: ("hashtag", "timestamp"),
    USER_ACTIVITY_TOPIC: ("username", "tweet_count", "retweets", "likes", "timestamp"),
}

# A record as Spark's Kafka source gives it.
TRANSPORT = _struct(
    key=BINARY, value=BINARY, topic=STRING, partition=INT, offset=LONG, timestamp=TIME,
    timestampType=INT)

_POSTS = _struct(
    tweet_id=LONG, username=STRING, tweet_text=STRING, retweets=INT, likes=INT, timestamp=TIME)
_HASHTAGS = _struct(hashtag=STRING, count=LONG, processed_at=TIME)
_USERS = _struct(
    username=STRING, tweet_count=LONG, total_likes=LONG, total_retweets=LONG,
    processed_at=TIME)

TABLES = {
    "tweets": _POSTS,
    "hashtag_counts": _struct(
        hashtag=STRING, count=LONG, window_end=TIME, last_updated=TIME),
    "user_activity": _struct(
        username=STRING, tweet_count=LONG, total_likes=LONG, total_retweets=LONG, window_end=TIME,
        last_updated=TIME),
    "stream_hashtags": _HASHTAGS,
    "stream_users": _USERS,
    "batch_hashtags": _HASHTAGS,
    "batch_users": _USERS,
    "raw_tweets": _POSTS,
    "performance_metrics": _struct(
        query_id=STRING, execution_mode=STRING, execution_time=DOUBLE, window_size=STRING,
        records_processed=LONG, execution_timestamp=TIME),
    # A row per micro-batch that ran to its end; a batch that runs again has another run.
    "stream_metrics": _struct(
        run_id=STRING, batch_id=LONG, query_id=STRING, execution_mode=STRING,
        execution_time=DOUBLE, window_size=STRING, records_processed=LONG, accepted=LONG,
        rejected=LONG, late=LONG, execution_timestamp=TIME),
    # Posts that came after the watermark had passed a window of theirs, a row per such window.
    "late_posts": _struct(
        tweet_id=LONG, username=STRING, tweet_text=STRING, retweets=INT, likes=INT,
        timestamp=TIME, window_end=TIME, watermark=TIME),
}


@dataclass(frozen=True)
class MergeSpec:
    """How rows that meet on ``keys`` combine.

    ``policy`` is ``ignore`` (first row stays), ``overwrite`` (last row stays)
    or ``increment`` (``measures`` add up; ``stamp`` is the last one, or with
    ``latest`` the greatest one whatever the order of arrival).
    ``day_of`` names the key column whose (UTC) date partitions the stored table,
    ``span`` the width of the key ranges that do where the key is a number.
    """

    keys: tuple[str, ...]
    policy: str
    measures: tuple[str, ...] = ()
    stamp: str | None = None
    day_of: str | None = None
    latest: bool = False
    span: int | None = None


# One policy per table. Routing is by table name.
MERGES = {
    "tweets": MergeSpec(("tweet_id",), "ignore", span=10_000_000),
    "hashtag_counts": MergeSpec(
        ("hashtag", "window_end"), "overwrite", ("count",), "last_updated", "window_end"),
    "user_activity": MergeSpec(
        ("username", "window_end"), "overwrite",
        ("tweet_count", "total_likes", "total_retweets"), "last_updated", "window_end"),
    "stream_metrics": MergeSpec(
        ("run_id", "batch_id"), "overwrite",
        ("query_id", "execution_mode", "execution_time", "window_size", "records_processed",
         "accepted", "rejected", "late"), "execution_timestamp"),
    "late_posts": MergeSpec(("tweet_id", "window_end"), "ignore", day_of="window_end"),
}

# Names that differ between a result and the table it is stored in.
SINK_NAMES = {
    "tweets": {"text": "tweet_text"},
    "stream_metrics": {},
    "late_posts": {"text": "tweet_text"},
    "hashtag_counts": {"timestamp": "last_updated"},
    "user_activity": {"timestamp": "last_updated"},
}


def table_of(columns: Iterable[str]) -> str:
    """The table that rows with these columns belong to."""
    names = set(columns)
    if "hashtag" in names:
        return "hashtag_counts"
    if {"username", "tweet_count"} <= names:
        return "user_activity"
    if "tweet_id" in names:
        return "tweets"
    raise ValueError(f"no table takes rows with columns {sorted(names)}")


def create_tables(spark: SparkSession, location: str) -> None:
    """Declare every table in the session catalog, stored as Parquet under ``location``."""
    for name, schema in TABLES.items():
        spark.catalog.createTable(name, path=f"{location.rstrip('/')}/{name}",
                                  source="parquet", schema=schema)
