from __future__ import annotations

import re
from datetime import datetime

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from postflow.functions import text as t
from postflow.operators.posts import activity_rows, hashtag_rows, message_rows
from postflow.plans import reports
from postflow.sources.tables import seed_tables


def tags(spark, texts):
    frame = spark.createDataFrame([(value,) for value in texts], "text string")
    return [row[0] for row in frame.select(t.hashtags("text")).collect()]


def test_hashtags_follow_unicode_words(spark):
    line = "#café ##x #a-b #a_b9 #日本 # #É1 #a #a &#39; a#b"
    assert tags(spark, [line, None, "", "none"]) == [
        ["café", "x", "a", "a_b9", "日本", "É1", "a", "a", "39", "b"], [], [], []]


# Letters, digits, '_', marks of punctuation and space from several scripts.
ALPHABET = st.sampled_from("#aZ9_ -.'é日ßЖ²½٣\n\t!@😀한")


@settings(max_examples=5, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(ALPHABET, max_size=40), min_size=50, max_size=80))
def test_hashtags_equal_python_words(spark, texts):
    assert tags(spark, texts) == [re.findall(r"#(\w+)", value) for value in texts]


def test_scalar_functions(spark):
    row = spark.createDataFrame(
        [("it's 'x'", "2024-01-02 03:04:05", "2024-01-02T03:04:05.120000", "zzz")],
        "q string, a string, b string, c string").select(
        t.double_quotes("q"), t.event_time("a"), t.event_time("b"), t.event_time("c"),
        t.iso_text(t.event_time("a")), t.iso_text(t.event_time("b")),
        t.ratio(F.lit(3), F.lit(2)), t.ratio(F.lit(3), F.lit(0)),
        t.two_digits(F.lit(2.345678)), t.plain_newlines(F.lit("a\r\nb\rc\n"))).first()
    assert tuple(row) == (
        "it''s ''x''", datetime(2024, 1, 2, 3, 4, 5), datetime(2024, 1, 2, 3, 4, 5, 120000), None,
        "2024-01-02T03:04:05", "2024-01-02T03:04:05.120000", 1.5, 0.0, "2.35", "a\nb\nc\n")


def test_now_has_whole_seconds(spark):
    assert spark.range(1).select(t.now_second()).first()[0].microsecond == 0


def test_seed_reports(spark):
    seeds = seed_tables(spark)
    tops = [tuple(r) for r in reports.top_hashtags(seeds["hashtag_counts"]).collect()]
    assert tops == [("technology", 25), ("politics", 18), ("sports", 15), ("business", 12),
                    ("news", 10), ("test", 8)]
    assert [r["hashtag"] for r in reports.top_hashtag_rows(seeds["hashtag_counts"], 2).collect()] \
        == ["technology", "politics"]
    users = seeds["user_activity"]
    assert [tuple(r) for r in reports.top_users(users).collect()] == [
        ("user1", 10), ("user2", 8), ("user3", 5)]
    averages = reports.top_average_likes(users)
    assert [tuple(r) for r in averages.collect()] == [
        ("user3", 90, 5, 18.0), ("user1", 150, 10, 15.0), ("user2", 120, 8, 15.0)]
    assert [r["username"] for r in reports.top_ratio_rows(users).collect()] == [
        "user3", "user1", "user2"]
    lines = reports.report_lines(reports.batch_reports(seeds["hashtag_counts"], users, 1))
    assert [r["line"] for r in lines.collect()] == [
        "#technology: 25", "user1: 10 tweets",
        "user3: 18.00 avg likes (90 total likes over 5 tweets)"]


def test_reports_put_null_sums_first_and_zero_counts_at_zero(spark):
    rows = spark.createDataFrame(
        [("a", None, 5), ("b", 0, 5), ("c", 2, None), ("d", 2, 4)],
        "username string, tweet_count long, total_likes long")
    assert [r["username"] for r in reports.top_users(rows).collect()] == ["a", "c", "d", "b"]
    got = {r["username"]: r["avg_likes_per_tweet"] for r in reports.user_ratios(rows).collect()}
    assert got == {"a": 0.0, "b": 0.0, "c": None, "d": 2.0}


def test_seed_posts_give_tags_activity_and_messages(spark):
    posts = seed_tables(spark, datetime(2024, 1, 1, 12))["tweets"].withColumnRenamed(
        "tweet_text", "text")
    counts = {r["hashtag"]: r["count"] for r in hashtag_rows(posts).groupBy("hashtag").count().collect()}
    assert counts == {"test": 2, "technology": 2, "politics": 1, "sports": 1, "business": 1,
                      "news": 1}
    assert [r["hashtag_count"] for r in activity_rows(posts).collect()] == [2, 2, 1, 2, 1]
    messages = message_rows(posts, F.col("timestamp"))
    assert {r["topic"]: r["count"] for r in messages.groupBy("topic").count().collect()} == {
        "tweets_topic": 5, "hashtags_topic": 8, "user_activity_topic": 5}
    assert messages.filter("topic = 'user_activity_topic'").first()["value"] == (
        '{"username":"user1","tweet_count":1,"hashtag_count":2,"retweets":5,"likes":10,'
        '"timestamp":"2024-01-01T12:00:00"}')


def test_message_keeps_null_fields_and_quotes(spark):
    posts = spark.createDataFrame(
        [(1, 'a"b', None, 1, 2, "2024-01-01 00:00:00")],
        "tweet_id int, username string, text string, retweets int, likes int, timestamp string")
    first = message_rows(posts, F.lit(datetime(2024, 1, 1))).first()
    assert first["value"] == (
        '{"tweet_id":1,"username":"a\\"b","text":null,"retweets":1,"likes":2,'
        '"timestamp":"2024-01-01 00:00:00"}')
