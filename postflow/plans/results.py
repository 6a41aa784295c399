"""Batch and streaming results side by side, in tables of their own."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from postflow.operators.compare import parity
from postflow.operators.merge import unseen
from postflow.operators.posts import hashtag_rows
from postflow.operators.windows import windowed_hashtags, windowed_posts
from postflow.plans.reports import processed_hashtags, processed_users
from postflow.plans.views import stored_tables
from postflow.schemas import MERGES
from postflow.session import path_exists
from postflow.sources.tables import read_table

RESULTS = ("stream_hashtags", "stream_users", "batch_hashtags", "batch_users")


def store_results(spark: SparkSession, root: str) -> None:
    """Totals of the streaming tables, and the same computed anew from the stored posts.

    The tables are plain Parquet under their names, where ``create_tables`` declares them; so is a
    copy of the posts they come from, as ``raw_tweets``. Posts never change, so the copy gets only
    those that it lacks, also after a run that died while it copied.
    """
    root = root.rstrip("/")
    tables = stored_tables(spark, root)
    stored = tables["tweets"].current()
    posts = stored.withColumnRenamed("tweet_text", "text")
    copied = stored_result(spark, root, "raw_tweets") if path_exists(
        spark, f"{root}/raw_tweets") else None
    fresh = stored if copied is None else unseen(copied, stored, MERGES["tweets"])
    fresh.write.mode("append").parquet(f"{root}/raw_tweets")
    frames = {
        "stream_hashtags": processed_hashtags(tables["hashtag_counts"].current()),
        "stream_users": processed_users(tables["user_activity"].current()),
        "batch_hashtags": processed_hashtags(windowed_hashtags(hashtag_rows(posts))),
        "batch_users": processed_users(windowed_posts(posts)),
    }
    for name, frame in frames.items():
        frame.write.mode("overwrite").parquet(f"{root}/{name}")


def stored_result(spark: SparkSession, root: str, name: str) -> DataFrame:
    return read_table(spark, name, "parquet", path=f"{root.rstrip('/')}/{name}")


def results_parity(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """For hashtags and users: how many rows both sides have, and how many only one has."""
    return {what: parity(*[stored_result(spark, root, f"{side}_{what}").drop("processed_at")
                           for side in ("stream", "batch")]) for what in ("hashtags", "users")}
