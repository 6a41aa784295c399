"""Sliding event-time aggregates, for tables and for streams alike.

Streams aggregate straight into the overlapping windows, which is what the
state store and the watermark need. For a table of hashtags the rows are first
counted per slide (a pane), and only those few rows are spread over the windows:
the tag set is small against the rows, so the first step shrinks the data and
each row is hashed once and not three times. Users are many and post rarely, so
panes would not shrink anything and the rows go straight into the windows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postflow.schemas import LATENESS, SLIDE, WINDOW

_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def seconds(duration: str) -> int:
    """``'15 minutes'`` as a number of seconds."""
    amount, unit = duration.split()
    return int(amount) * _SECONDS[unit.rstrip("s")]


def with_lateness(rows: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """A watermark on streams; a table has no late rows."""
    return rows.withWatermark("timestamp", lateness) if rows.isStreaming else rows


def _windowed(rows: DataFrame, key: str, measures: dict, window: str, slide: str) -> DataFrame:
    groups = with_lateness(rows).groupBy(F.window("timestamp", window, slide), key)
    names = [key, *measures, "window_end", "timestamp"]
    return (groups.agg(*[how.alias(name) for name, how in measures.items()],
                       F.max("timestamp").alias("timestamp"))
            .withColumn("window_end", F.col("window.end")).select(*names))


def _by_panes(rows: DataFrame, key: str, measures: dict, window: str, slide: str) -> DataFrame:
    step = seconds(slide)
    spread = F.explode(F.sequence(F.lit(0), F.lit(seconds(window) // step - 1)))
    panes = (rows.groupBy(F.window("timestamp", slide).alias("pane"), key)
             .agg(*[how.alias(name) for name, how in measures.items()],
                  F.max("timestamp").alias("timestamp")))
    ends = F.col("pane.end") + F.make_dt_interval(secs=F.col("shift") * F.lit(step))
    return (panes.withColumn("shift", spread)
            .groupBy(ends.alias("window_end"), key)
            .agg(*[F.sum(name).alias(name) for name in measures],
                 F.max("timestamp").alias("timestamp"))
            .select(key, *measures, "window_end", "timestamp"))


def windowed_hashtags(tags: DataFrame, window: str = WINDOW, slide: str = SLIDE) -> DataFrame:
    """Tag occurrences and the last event time, by (window, hashtag)."""
    measures = {"count": F.count(F.lit(1))}
    if not tags.isStreaming and seconds(window) % seconds(slide) == 0:
        return _by_panes(tags, "hashtag", measures, window, slide)
    return _windowed(tags, "hashtag", measures, window, slide)


def chained_hashtags(tags: DataFrame, window: str = WINDOW, slide: str = SLIDE) -> DataFrame:
    """As ``windowed_hashtags``, by two aggregates after one another, for streams too: a pane per
    slide, then the finished panes into the windows.

    On a stream (append mode) each post updates one pane in place of three windows, and a window
    comes out once, when the watermark has passed its end; it never changes after that.
    """
    pane = (with_lateness(tags).groupBy(F.window("timestamp", slide).alias("pane"), "hashtag")
            .agg(F.count(F.lit(1)).alias("count"), F.max("timestamp").alias("timestamp")))
    at = F.window(F.window_time("pane"), window, slide)
    return (pane.groupBy(at.alias("window"), "hashtag")
            .agg(F.sum("count").alias("count"), F.max("timestamp").alias("timestamp"))
            .select("hashtag", "count", F.col("window.end").alias("window_end"), "timestamp"))


def windows_of(rows: DataFrame, window: str = WINDOW, slide: str = SLIDE) -> DataFrame:
    """Each row once for each window that it lies in, with ``window_end``."""
    step = seconds(slide)
    last = F.floor(F.unix_seconds(F.col("timestamp").cast("timestamp")) / step) * step + step
    ends = F.transform(F.sequence(F.lit(0), F.lit(seconds(window) // step - 1)),
                       lambda n: F.timestamp_seconds(last + n * step))
    return rows.withColumn("window_end", F.explode(ends))


def windowed_posts(posts: DataFrame, window: str = WINDOW, slide: str = SLIDE) -> DataFrame:
    """Posts, likes, retweets and the last event time, by (window, username)."""
    return _windowed(posts, "username", {
        "tweet_count": F.count(F.lit(1)),
        "total_likes": F.sum("likes"),
        "total_retweets": F.sum("retweets"),
    }, window, slide)


def windowed_activity(activity: DataFrame, window: str = WINDOW, slide: str = SLIDE) -> DataFrame:
    """As ``windowed_posts`` from activity rows, which carry a post count of their own."""
    return _windowed(activity, "username", {
        "tweet_count": F.sum("tweet_count"),
        "total_likes": F.sum("likes"),
        "total_retweets": F.sum("retweets"),
    }, window, slide)


def tiling_windows(windows: DataFrame, window: str = WINDOW) -> DataFrame:
    """The windows that lie end to end, so that each event counts once."""
    end = F.unix_timestamp(F.col("window_end").cast("timestamp"))
    return windows.filter(end % F.lit(seconds(window)) == 0)
