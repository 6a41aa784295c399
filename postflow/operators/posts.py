"""Row-wise operators over posts: tags, activity rows and outgoing messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postflow.functions.text import hashtag_count, hashtags, iso_text
from postflow.schemas import (
    HASHTAG_WINDOWS_TOPIC, HASHTAGS_TOPIC, TWEETS_TOPIC, USER_ACTIVITY_TOPIC, USER_WINDOWS_TOPIC,
    table_of)


def hashtag_rows(posts: DataFrame) -> DataFrame:
    """One row per tag occurrence; posts without a tag give none."""
    return posts.select("tweet_id", F.explode(hashtags("text")).alias("hashtag"),
                        "username", "timestamp")


def activity_rows(posts: DataFrame, at: Column | None = None) -> DataFrame:
    """One activity row per post, stamped with the processing time unless ``at`` is given."""
    return posts.select(
        "username",
        F.lit(1).alias("tweet_count"),
        hashtag_count("text").alias("hashtag_count"),
        "retweets",
        "likes",
        (F.current_timestamp() if at is None else at).alias("timestamp"),
    )


def _json(**fields: Column) -> Column:
    return F.to_json(F.struct(*[value.alias(name) for name, value in fields.items()]),
                     {"ignoreNullFields": "false"})


def message_rows(posts: DataFrame, at: Column | None = None) -> DataFrame:
    """Every message of every post as (topic, value): the post, each tag, the activity.

    One projection per topic: each reads only the columns it sends and stays in
    generated code. Building all messages of a post as one array reads the posts
    once, but measured two to three times slower, as writing JSON outweighs the
    scan. A filter on ``topic`` leaves only that topic's projection.
    """
    c = F.col
    time_text = c("timestamp").cast("string")

    def messages(rows: DataFrame, topic: str, **fields: Column) -> DataFrame:
        return rows.select(F.lit(topic).alias("topic"), _json(**fields).alias("value"))

    post = messages(
        posts, TWEETS_TOPIC, tweet_id=c("tweet_id"), username=c("username"), text=c("text"),
        retweets=c("retweets"), likes=c("likes"), timestamp=time_text)
    tags = messages(
        hashtag_rows(posts), HASHTAGS_TOPIC, tweet_id=c("tweet_id"), hashtag=c("hashtag"),
        username=c("username"), timestamp=time_text)
    activity = messages(
        activity_rows(posts, at), USER_ACTIVITY_TOPIC, username=c("username"),
        tweet_count=c("tweet_count"), hashtag_count=c("hashtag_count"),
        retweets=c("retweets"), likes=c("likes"), timestamp=iso_text("timestamp"))
    return post.unionByName(tags).unionByName(activity)


def window_messages(windows: DataFrame, sender: str | None = None,
                    epoch: int | None = None) -> DataFrame:
    """Windowed counts or windowed activity as (topic, value) messages; with ``sender`` and
    ``epoch`` also ``key``, an id that is the same when the batch is sent again."""
    if table_of(windows.columns) == "hashtag_counts":
        topic, fields = HASHTAG_WINDOWS_TOPIC, ("hashtag", "count")
    else:
        topic, fields = USER_WINDOWS_TOPIC, (
            "username", "tweet_count", "total_likes", "total_retweets")
    times = {name: iso_text(name) for name in ("window_end", "timestamp")}
    value = _json(**{name: F.col(name) for name in fields}, **times).alias("value")
    if sender is None:
        return windows.select(F.lit(topic).alias("topic"), value)
    named = F.to_json(F.struct(F.lit(sender).alias("sender"), F.lit(epoch).alias("epoch"),
                               F.col(fields[0]).alias("name"), F.col("window_end")))
    return windows.select(F.lit(topic).alias("topic"), F.sha2(named, 256).cast("binary")
                          .alias("key"), value)
