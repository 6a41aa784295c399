"""The top-10 reports over stored counts and stored activity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postflow.functions.text import now_second, ratio, two_digits

# Fixed value: rows per report.
TOP = 10


def _top(rows: DataFrame, measure: str, key: str, n: int) -> DataFrame:
    """Highest first with nulls ahead; the key settles ties."""
    return rows.orderBy(F.desc_nulls_first(measure), F.asc_nulls_last(key)).limit(n)


def hashtag_totals(counts: DataFrame) -> DataFrame:
    return counts.groupBy("hashtag").agg(F.sum("count").alias("total_count"))


def user_totals(activity: DataFrame) -> DataFrame:
    return activity.groupBy("username").agg(F.sum("tweet_count").alias("total_tweets"))


def user_ratios(activity: DataFrame) -> DataFrame:
    """Likes per post as a ratio of sums."""
    sums = activity.groupBy("username").agg(
        F.sum("total_likes").alias("sum_likes"), F.sum("tweet_count").alias("sum_tweets"))
    return sums.withColumn("avg_likes_per_tweet", ratio("sum_likes", "sum_tweets"))


def row_ratios(activity: DataFrame) -> DataFrame:
    """Likes per post of each stored row."""
    return activity.select("username", "total_likes", "tweet_count").withColumn(
        "avg_likes_per_tweet", ratio("total_likes", "tweet_count"))


def top_hashtags(counts: DataFrame, n: int = TOP) -> DataFrame:
    """Summed over stored rows: overlapping windows count a post once each."""
    return _top(hashtag_totals(counts), "total_count", "hashtag", n)


def top_users(activity: DataFrame, n: int = TOP) -> DataFrame:
    return _top(user_totals(activity), "total_tweets", "username", n)


def top_average_likes(activity: DataFrame, n: int = TOP) -> DataFrame:
    return _top(user_ratios(activity), "avg_likes_per_tweet", "username", n)


def top_rows(table: DataFrame, measure: str, key: str, n: int = TOP) -> DataFrame:
    """The largest stored rows whole; the key and the window settle ties."""
    return table.orderBy(F.desc_nulls_first(measure), F.asc_nulls_last(key),
                         F.asc_nulls_last("window_end")).limit(n)


def top_hashtag_rows(counts: DataFrame, n: int = TOP) -> DataFrame:
    return top_rows(counts, "count", "hashtag", n).select("hashtag", "count")


def top_user_rows(activity: DataFrame, n: int = TOP) -> DataFrame:
    return top_rows(activity, "tweet_count", "username", n).select("username", "tweet_count")


def top_ratio_rows(activity: DataFrame, n: int = TOP) -> DataFrame:
    rows = activity.withColumn("avg_likes_per_tweet", ratio("total_likes", "tweet_count"))
    return top_rows(rows, "avg_likes_per_tweet", "username", n).select(
        "username", "total_likes", "tweet_count", "avg_likes_per_tweet")


def processed_hashtags(counts: DataFrame) -> DataFrame:
    """Totals in the shape of the tables that set batch results beside streaming results."""
    return counts.groupBy("hashtag").agg(F.sum("count").alias("count")).withColumn(
        "processed_at", now_second())


def processed_users(activity: DataFrame) -> DataFrame:
    names = ("tweet_count", "total_likes", "total_retweets")
    return activity.groupBy("username").agg(
        *[F.sum(name).alias(name) for name in names]).withColumn("processed_at", now_second())


def hashtag_lines(report: DataFrame) -> DataFrame:
    return report.select(F.format_string("#%s: %d", "hashtag", "total_count").alias("line"))


def user_lines(report: DataFrame) -> DataFrame:
    return report.select(F.format_string("%s: %d tweets", "username", "total_tweets").alias("line"))


def average_lines(report: DataFrame) -> DataFrame:
    return report.select(F.format_string(
        "%s: %s avg likes (%d total likes over %d tweets)",
        F.col("username"), two_digits("avg_likes_per_tweet"),
        F.col("sum_likes"), F.col("sum_tweets")).alias("line"))


def batch_reports(counts: DataFrame, activity: DataFrame, n: int = TOP) -> dict[str, DataFrame]:
    """The three reports by the id under which their runs are logged, in running order."""
    return {
        "batch_top_hashtags": top_hashtags(counts, n),
        "batch_top_users": top_users(activity, n),
        "batch_avg_likes": top_average_likes(activity, n),
    }


REPORT_LINES = {
    "batch_top_hashtags": hashtag_lines,
    "batch_top_users": user_lines,
    "batch_avg_likes": average_lines,
}


def report_lines(reports: dict[str, DataFrame]) -> DataFrame:
    """All reports as printable lines."""
    lines = None
    for name, report in reports.items():
        part = REPORT_LINES[name](report).withColumn("report", F.lit(name))
        lines = part if lines is None else lines.unionByName(part)
    return lines.select("report", "line")
