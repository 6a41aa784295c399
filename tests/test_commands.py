from __future__ import annotations

import glob
import os

import pytest
from conftest import rows_of
from pyspark.errors import StreamingQueryException

from postflow.__main__ import main
from postflow.operators.posts import message_rows
from postflow.plans import metrics, reports
from postflow.schemas import (
    HASHTAGS_TOPIC, TABLES, TWEETS_TOPIC, USER_ACTIVITY_TOPIC, table_of)
from postflow.sources.tables import seed_tables
from postflow.streaming import jobs
from postflow.streaming.table import EpochTable


def send_seeds(spark, topics):
    posts = seed_tables(spark)["tweets"].withColumnRenamed("tweet_text", "text")
    messages = message_rows(posts.withColumn("tweet_id", posts["tweet_id"] + 1000))
    jobs.message_writer("parquet", path=topics)(
        messages.withColumn("value", messages["value"].cast("binary")))


def test_produce_stream_report_compare(spark, post_csv, root, capsys):
    topics, tables = f"{root}/topics", f"{root}/tables"
    main(["produce", "--csv", post_csv, "--record-sep", "\\r\\n", "--topics", topics,
          "--root", tables])
    assert rows_of(spark.read.parquet(f"{tables}/rejects/topic=csv"), "tweet_id") == [(81,)]
    send_seeds(spark, topics)
    for mode in ("complete", "update"):
        where = ["--root", f"{tables}-{mode}"]
        main(["stream", "--once", "--topics", topics, "--mode", mode, *where])
        main(["report", *where])
        out = capsys.readouterr().out
        assert "#technology: 6" in out and "user1: 6 tweets" in out
        main(["sql", "--query", "SELECT username, SUM(total_likes)::double / SUM(tweet_count) AS a "
              "FROM user_activity WHERE username = 'user3' GROUP BY username", *where])
        assert "|user3|25.0|" in capsys.readouterr().out
        main(["sql", "--query", "SELECT count(*) AS runs FROM performance_metrics "
              "WHERE execution_mode = 'batch'", *where])
        assert "|3|" in capsys.readouterr().out
        main(["compact", "--expire", *where])
        main(["compare", *where])
        assert "batch_top_hashtags" in capsys.readouterr().out
        stored = EpochTable.named(spark, f"{tables}-{mode}", "tweets").current()
        assert stored.count() == 85


def bad_records(spark, topics):
    for topic in (TWEETS_TOPIC, HASHTAGS_TOPIC, USER_ACTIVITY_TOPIC):
        spark.createDataFrame([(b"oops",)], "value binary").write.mode("append").parquet(
            f"{topics}/topic={topic}")


@pytest.mark.parametrize("mode", [[], ["--mode", "update"], ["--mode", "update", "--republish"]])
def test_nothing_is_lost(spark, post_csv, root, capsys, mode):
    """Rejects of the topics that are read, and a logged record for each one sent."""
    topics, tables = f"{root}/topics", f"{root}/tables"
    main(["produce", "--csv", post_csv, "--topics", topics])
    bad_records(spark, topics)
    main(["stream", "--once", "--topics", topics, "--rate", "1", "--root", tables, *mode])
    bad = spark.read.parquet(f"{tables}/rejects")
    read = (TWEETS_TOPIC, HASHTAGS_TOPIC, USER_ACTIVITY_TOPIC) if mode else (TWEETS_TOPIC,)
    assert rows_of(bad, "topic", "raw") == sorted((topic, "oops") for topic in read)
    logged = spark.read.parquet(f"{tables}/performance_metrics").groupBy("query_id").sum(
        "records_processed")
    name = "tweets" if mode else "shared"
    assert (f"spark_streaming_{name}", 81) in rows_of(logged)
    assert f"81 {name}" in capsys.readouterr().out
    sent = "hashtag_windows_topic", "user_windows_topic"
    assert ("--republish" in mode) == os.path.isdir(f"{topics}/topic={sent[1]}")
    main(["sql", "--root", tables, "--query", "SELECT username, window_end FROM user_activity"])
    assert capsys.readouterr().out.count("|author") == 240
    main(["sql", "--root", tables, "--query", "SELECT * FROM user_activity", "--out", f"{root}/o"])
    assert spark.read.parquet(f"{root}/o").count() == 240
    main(["results", "--root", tables])
    out = capsys.readouterr().out
    assert "hashtags" in out and "|80|80|0|0|" in out
    main(["sql", "--root", tables, "--query", "SELECT count(*) FROM raw_tweets"])
    assert "|80|" in capsys.readouterr().out
    main(["compact", "--expire", "--root", tables])
    assert not glob.glob(f"{tables}/*/*/log/epoch=*")


def test_results_copy_only_new_posts(spark, post_csv, root, capsys):
    topics, tables = f"{root}/topics", f"{root}/tables"
    main(["produce", "--csv", post_csv, "--topics", topics])
    main(["stream", "--once", "--topics", topics, "--root", tables])
    main(["results", "--root", tables])
    files = set(glob.glob(f"{tables}/raw_tweets/part-*"))
    send_seeds(spark, topics)
    main(["stream", "--once", "--topics", topics, "--root", tables])
    for _ in range(2):
        main(["results", "--root", tables])
        copied = spark.read.parquet(f"{tables}/raw_tweets")
        assert (copied.count(), copied.select("tweet_id").distinct().count()) == (85, 85)
    added = set(glob.glob(f"{tables}/raw_tweets/part-*")) - files
    assert files < files | added and spark.read.parquet(*added).count() == 5
    assert "|83|83|0|0|" in capsys.readouterr().out


def test_sql_leaves_the_catalog_as_it_was(spark, post_csv, root, capsys):
    """Views of stored tables hide no catalog table of the same name, in this session or later."""
    topics, tables = f"{root}/topics", f"{root}/tables"
    main(["produce", "--csv", post_csv, "--topics", topics])
    main(["stream", "--once", "--topics", topics, "--root", tables])
    before = spark.catalog.listTables()
    spark.catalog.createTable("hashtag_counts", path=f"{root}/own", source="parquet",
                              schema=TABLES["hashtag_counts"])
    try:
        main(["sql", "--root", tables, "--query", "SELECT count(*) > 9 AS n FROM user_activity"])
        assert "|True|" in capsys.readouterr().out
        main(["results", "--root", tables])
        assert spark.table("hashtag_counts").count() == 0
    finally:
        spark.sql("DROP TABLE hashtag_counts")
    assert spark.catalog.listTables() == before


def test_metrics_of_a_failed_run_are_kept(spark, post_csv, root, monkeypatch):
    topics, tables = f"{root}/topics", f"{root}/tables"
    main(["produce", "--csv", post_csv, "--topics", topics])
    bad_records(spark, topics)
    real, written = EpochTable.write, []

    def write(self, rows, epoch, *args, **kwargs):
        if self.path.endswith("/user_activity"):
            written.append(epoch)
            if len(written) == 2:
                raise ValueError("broken sink")
        return real(self, rows, epoch, *args, **kwargs)

    monkeypatch.setattr(EpochTable, "write", write)
    run = ["stream", "--once", "--topics", topics, "--rate", "1", "--root", tables]
    with pytest.raises(StreamingQueryException):
        main(run)
    first = EpochTable.stored(spark, tables, "stream_metrics").current()
    assert first.count() == 1 and spark.read.parquet(f"{tables}/performance_metrics").count() == 1
    main(run)
    log = EpochTable.stored(spark, tables, "stream_metrics").current()
    assert log.select("run_id").distinct().count() == 2
    sums = log.groupBy().sum("records_processed", "accepted", "rejected").first()
    assert tuple(sums) == (81, 80, 1)
    # Batches without a reject leave no folder.
    assert len(glob.glob(f"{tables}/rejects/topic={TWEETS_TOPIC}/epoch=*")) == 1


def test_numbers_are_never_cut(spark):
    rows = spark.createDataFrame(
        [("q", "s", 1.7e12, 0.5, 1699999999999.5, "Batch", 3.4e12)], "query_type string, "
        "stream_id string, stream_avg double, batch_avg double, difference double, faster string, "
        "factor double")
    line = metrics.comparison_lines(rows).first()["line"]
    assert "1699999999999.50 Batch" in line and "1700000000000.00 " in line


def test_load(spark, post_csv, root):
    main(["produce", "--csv", post_csv, "--topics", f"{root}/topics", "--limit", "20"])
    send_seeds(spark, f"{root}/topics")
    main(["load", "--once", "--root", f"{root}/tables", "--topics", f"{root}/topics"])
    users = EpochTable.stored(spark, f"{root}/tables", "user_activity").current()
    assert users.select("username").distinct().count() == 23


def test_rows_are_routed_by_their_columns():
    assert table_of(["hashtag", "count", "window_end", "timestamp"]) == "hashtag_counts"
    assert table_of(["username", "tweet_count"]) == "user_activity"
    assert table_of(["tweet_id", "username", "text"]) == "tweets"
    with pytest.raises(ValueError):
        table_of(["x"])


def test_comparison_tables(spark):
    seeds = seed_tables(spark)
    tags = reports.processed_hashtags(seeds["hashtag_counts"])
    users = reports.processed_users(seeds["user_activity"])
    assert tags.columns == TABLES["batch_hashtags"].names
    assert users.columns == TABLES["batch_users"].names
    assert rows_of(users, "username", "tweet_count") == [("user1", 10), ("user2", 8), ("user3", 5)]
