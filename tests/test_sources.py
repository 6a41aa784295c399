from __future__ import annotations

import csv
from contextlib import contextmanager
from types import SimpleNamespace

import pytest
from conftest import csv_rows, rows_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from postflow import session
from postflow.operators import windows
from postflow.schemas import CSV_COLUMNS, HASHTAGS_TOPIC, TABLES, TWEETS_TOPIC, create_tables
from postflow.sources.messages import (
    accepted, parse, rejected, split_rows, topic_batch, topic_stream)
from postflow.sources.posts import csv_posts, csv_records
from postflow.sources.tables import read_table


@pytest.mark.parametrize("how", [{}, {"record_sep": "\r\n"}])
def test_csv_has_one_cut_record(spark, post_csv, how):
    posts = csv_posts(spark, post_csv, **how)
    good, bad = split_rows(posts)
    assert (posts.count(), good.count(), bad.count()) == (81, 80, 1)
    assert [tuple(row) for row in good.orderBy("tweet_id").collect()] == csv_rows()
    assert windows.windowed_posts(good).count() == 240
    assert bad.first()["tweet_id"] == 81


@contextmanager
def split_size(spark, size):
    had = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    try:
        yield
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", had)


@pytest.mark.parametrize("size", [100, 1000, 4096, 1 << 27])
def test_split_reader_agrees_with_the_whole_file(spark, post_csv, size):
    want = rows_of(csv_posts(spark, post_csv).filter("tweet_id < 81"))
    with split_size(spark, size):
        posts = csv_posts(spark, post_csv, "\r\n")
        assert rows_of(posts.filter("tweet_id < 81")) == want
        assert posts.count() == 81


@pytest.mark.parametrize("how", [{}, {"record_sep": "\r\n"}])
def test_columns_are_taken_by_name(spark, root, how):
    header = "Timestamp,Likes,Extra,Retweets,Text,Tweet_ID,Username"
    for name, number in (("a", 1), ("b", 3_000_000_000)):
        with open(f"{root}/{name}.csv", "w", newline="") as file:
            file.write(f'{header}\r\n2024-01-01 00:00:00,9,x,5,"5"" of, it",{number},size 5"\r\n')
    assert rows_of(csv_posts(spark, root, **how), "tweet_id", "username", "text", "retweets",
                   "likes") == [(n, 'size 5"', '5" of, it', 5, 9) for n in (1, 3_000_000_000)]


def test_a_file_with_another_header_is_an_error(spark, root):
    for name, header in (("a", "Tweet_ID,Username,Text,Retweets,Likes,Timestamp"),
                         ("b", "Tweet_ID,Username,Text,Likes,Retweets,Timestamp")):
        with open(f"{root}/{name}.csv", "w") as file:
            file.write(f"{header}\n1,u,t,5,9,2024-01-01 00:00:00\n")
    with pytest.raises(Exception, match="header"):
        csv_posts(spark, root).collect()
    with open(f"{root}/c.csv", "w") as file:
        file.write("Tweet_ID,Username\n1,u\n")
    with pytest.raises(ValueError, match="Likes"):
        csv_posts(spark, f"{root}/c.csv")


def test_split_reader_uses_many_tasks(spark, post_csv):
    with split_size(spark, 4096):
        assert csv_posts(spark, post_csv, "\r\n").rdd.getNumPartitions() > 3
        places = spark.read.text(post_csv).select("_metadata.file_block_start").distinct()
        assert places.count() > 3


FIELD = st.text(st.sampled_from('ab,"\n\r é#'), max_size=30)


@settings(max_examples=6, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(FIELD, FIELD), min_size=1, max_size=25), st.integers(8, 200))
def test_split_reader_gives_back_what_was_written(spark, tmp_path_factory, texts, size):
    folder = tmp_path_factory.mktemp("csv")
    rows = [(i, user, text, i, 2 * i, "2024-01-01 00:00:00") for i, (user, text) in enumerate(texts)]
    for number, part in enumerate((rows[::2], rows[1::2])):
        with open(folder / f"{number}.csv", "w", encoding="utf-8", newline="") as file:
            writer = csv.writer(file, quoting=csv.QUOTE_ALL, lineterminator="\x1e")
            file.write(",".join(CSV_COLUMNS) + "\x1e")
            writer.writerows(part)
    want = [(i, user, text) for i, (user, text) in enumerate(texts)]
    with split_size(spark, size):
        got = csv_records(spark, str(folder), "\x1e")
        got = [(int(row["Tweet_ID"]), row["Username"] or "", row["Text"] or "") for row in got.collect()]
    assert sorted(got) == sorted(want)


def test_row_cap_counts_records(spark, post_csv):
    assert csv_posts(spark, post_csv, limit=50).filter("timestamp is not null").count() == 50


def test_csv_stream(spark, post_csv, root, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_bytes(open(post_csv, "rb").read())
    query = (csv_posts(spark, str(folder), streaming=True).writeStream.format("parquet")
             .option("checkpointLocation", f"{root}/cp").trigger(availableNow=True)
             .start(f"{root}/out"))
    query.awaitTermination()
    assert spark.read.parquet(f"{root}/out").count() == 81


BAD = [
    (b"not json", "tweet_id,username,text,retweets,likes,timestamp"),
    (None, "tweet_id,username,text,retweets,likes,timestamp"),
    (b'{"tweet_id":1,"username":"u","text":"t","retweets":1,"likes":99999999999,'
     b'"timestamp":"2024-01-01 00:00:00"}', "likes"),
    (b'{"tweet_id":1,"username":"u","text":"t","retweets":"x","likes":1,'
     b'"timestamp":"2024-01-01 00:00:00"}', "retweets"),
    (b'{"tweet_id":1,"username":"u","text":"t","likes":1,"timestamp":"2024-01-01 00:00:00"}',
     "retweets"),
    (b'{"tweet_id":1,"username":"u","text":"t","retweets":1,"likes":1,"timestamp":"soon"}',
     "timestamp"),
    (b'{"tweet_id":1,"username":"u","text":null,"retweets":1,"likes":1,'
     b'"timestamp":"2024-01-01 00:00:00"}', "text"),
]
GOOD = (b'{"tweet_id":2,"username":"u","text":"t","retweets":1,"likes":1,"more":true,'
        b'"timestamp":"2024-01-01T00:00:00.5"}')


def test_messages_part_into_good_and_bad(spark):
    rows = spark.createDataFrame([(value,) for value, _ in BAD] + [(GOOD,)], "value binary")
    parsed = parse(rows, TWEETS_TOPIC)
    assert rows_of(accepted(parsed, TWEETS_TOPIC), "tweet_id") == [(2,)]
    bad = rejected(parsed, TWEETS_TOPIC)
    assert [row["raw"] for row in bad.collect()] == [v and v.decode() for v, _ in BAD]
    assert [",".join(row["missing"]) for row in bad.collect()] == [m for _, m in BAD]


def test_hashtag_messages_need_tag_and_time_only(spark):
    rows = spark.createDataFrame(
        [(b'{"hashtag":"a","timestamp":"2024-01-01 00:00:00"}',),
         (b'{"tweet_id":1,"username":"u","timestamp":"2024-01-01 00:00:00"}',)], "value binary")
    parsed = parse(rows, HASHTAGS_TOPIC)
    assert rows_of(accepted(parsed, HASHTAGS_TOPIC), "hashtag") == [("a",)]
    assert rejected(parsed, HASHTAGS_TOPIC).first()["missing"] == ["hashtag"]


def test_topic_as_a_table(spark, root):
    (spark.createDataFrame([(b"x", TWEETS_TOPIC), (b"y", HASHTAGS_TOPIC)],
                           "value binary, topic string")
     .write.partitionBy("topic").parquet(f"{root}/topics"))
    rows = topic_batch(spark, TWEETS_TOPIC, "parquet", f"{root}/topics")
    assert [bytes(row["value"]) for row in rows.collect()] == [b"x"]


def test_declared_tables(spark, root):
    create_tables(spark, root)
    try:
        for name, schema in TABLES.items():
            assert read_table(spark, name).schema.names == schema.names
        spark.createDataFrame([("a", 1, None, None)], TABLES["hashtag_counts"]).write.insertInto(
            "hashtag_counts")
        assert read_table(spark, "hashtag_counts").count() == 1
        assert read_table(spark, "hashtag_counts", "parquet",
                          path=f"{root}/hashtag_counts").count() == 1
    finally:
        for name in TABLES:
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def stub(master, setting=None):
    """A session of which only the settings are asked for."""
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: None)
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: setting or default),
                           sparkContext=context)


def test_shared_dir_is_the_one_the_cluster_names():
    named = stub("spark://host:7077", "hdfs://shared/folder")
    assert session.shared_dir(named) == "hdfs://shared/folder"


def test_a_cluster_without_a_shared_dir_is_an_error():
    with pytest.raises(RuntimeError):
        session.shared_dir(stub("spark://host:7077"))


def test_local_shared_dir_is_kept(spark):
    assert session.shared_dir(spark) == session.shared_dir(spark)
    first, second = (session.new_folder(spark, "x") for _ in range(2))
    assert first != second and first.startswith(session.shared_dir(spark))


class Recorder:
    """Stands for a reader and keeps the calls made to it."""

    def __init__(self):
        self.calls = {}

    def format(self, name):
        self.calls["format"] = name
        return self

    def options(self, **options):
        self.calls.update(options)
        return self

    def load(self):
        return self.calls


def test_kafka_options():
    stub_session = SimpleNamespace(readStream=Recorder(), read=Recorder())
    options = {"kafka.bootstrap.servers": "h:9092"}
    assert topic_stream(stub_session, TWEETS_TOPIC, maxOffsetsPerTrigger="9", **options) == {
        "format": "kafka", "subscribe": "tweets_topic", "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "9", "kafka.bootstrap.servers": "h:9092"}
    assert topic_batch(stub_session, TWEETS_TOPIC, **options) == {
        "format": "kafka", "subscribe": "tweets_topic", "startingOffsets": "earliest",
        "endingOffsets": "latest", "kafka.bootstrap.servers": "h:9092"}
