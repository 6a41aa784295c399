from __future__ import annotations

from collections import defaultdict
from datetime import datetime, timedelta, timezone

from conftest import at, rows_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from postflow.operators import compare, windows

TAGS = "hashtag string, timestamp timestamp"


def test_three_windows_per_event(spark):
    tags = spark.createDataFrame([("a", at(5))], TAGS)
    ends = [row["window_end"] for row in windows.windowed_hashtags(tags).orderBy("window_end").collect()]
    assert [end.strftime("%H:%M") for end in ends] == ["11:10", "11:15", "11:20"]


def brute(rows, window=15, slide=5):
    counts = defaultdict(list)
    for key, when in rows:
        minutes = int(when.timestamp()) // 60
        first = minutes - minutes % slide + slide
        for end in range(first, first + window, slide):
            counts[key, end].append(when)
    return sorted((key, len(times), end, max(times)) for (key, end), times in counts.items())


@settings(max_examples=8, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 7200)), min_size=1, max_size=40))
def test_panes_equal_windows_and_brute_force(spark, drawn):
    start = datetime(2024, 1, 1, 23, 0, tzinfo=timezone.utc)
    rows = [(key, start + timedelta(seconds=second)) for key, second in drawn]
    tags = spark.createDataFrame(rows, TAGS)
    by_panes = windows.windowed_hashtags(tags)
    direct = windows._windowed(tags, "hashtag", {"count": F.count(F.lit(1))}, "15 minutes", "5 minutes")
    assert rows_of(by_panes) == rows_of(direct)
    got = sorted((r["hashtag"], r["count"], int(r["window_end"].replace(tzinfo=timezone.utc).timestamp()) // 60,
                  r["timestamp"].replace(tzinfo=timezone.utc)) for r in by_panes.collect())
    assert got == brute(rows)


def test_activity_sums_its_own_counts(spark):
    rows = spark.createDataFrame(
        [("u", 2, 1, 10, at(1)), ("u", 3, 2, 20, at(2)), ("v", 1, None, 5, at(2))],
        "username string, tweet_count int, retweets int, likes int, timestamp timestamp")
    got = {r["username"]: tuple(r)[1:4] for r in windows.windowed_activity(rows).collect()}
    assert got == {"u": (5, 30, 3), "v": (1, 5, None)}


def test_windows_that_do_not_divide_evenly(spark):
    tags = spark.createDataFrame([("a", at(5))], TAGS)
    assert windows.windowed_hashtags(tags, "15 minutes", "10 minutes").count() in (1, 2)


def test_tiling_windows_count_each_event_once(spark):
    tags = spark.createDataFrame([("a", at(minute)) for minute in range(60)], TAGS)
    tiled = windows.tiling_windows(windows.windowed_hashtags(tags))
    assert tiled.agg(F.sum("count")).first()[0] == 60


def test_contains_join_is_the_substring_test(spark):
    parts = ["", "a", "ab", "top_users", "b" * 5, "é"]
    wholes = ["", "ab", "cabd", "spark_top_users_x", "b" * 9, "aéa"]
    left = spark.createDataFrame([(p,) for p in parts], "part string")
    right = spark.createDataFrame([(w,) for w in wholes], "whole string")
    got = rows_of(compare.contains_join(left, right, "part", "whole"), "part", "whole")
    assert got == sorted(((p, w) for p in parts for w in wholes if p in w), key=repr)


def test_substrings_common_to_all_texts_are_not_made(spark):
    """Parts of 6 to 8 characters: what all names share is shorter, so no key holds them all."""
    names = spark.range(200).selectExpr("concat('user_', id) AS name")
    made = names.select("name", F.explode(compare.substrings("name", 6, 8)).alias("part"))
    assert made.groupBy("part").count().agg(F.max("count")).first()[0] <= 111
    assert made.filter("length(part) < 6 OR length(part) > 8").count() == 0
    plan = compare.contains_join(
        names.withColumnRenamed("name", "part"), names, "part", "name")
    assert plan.count() == sum(str(b).startswith(str(a)) for a in range(200) for b in range(200))


def test_contains_join_without_parts(spark):
    none = spark.createDataFrame([], "part string")
    whole = spark.createDataFrame([("a",), ("",)], "whole string")
    assert compare.contains_join(none, whole, "part", "whole").count() == 0
    empty = spark.createDataFrame([("",)], "part string")
    assert compare.contains_join(empty, whole, "part", "whole").count() == 2


def test_contains_join_needs_no_nested_loop(spark):
    left = spark.createDataFrame([("a",)], "part string")
    right = spark.createDataFrame([("ab",)], "whole string")
    plan = compare.contains_join(left, right, "part", "whole")._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_row_difference_and_parity(spark):
    left = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "k int, v string")
    right = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "k int, v string")
    assert rows_of(compare.row_difference(left, right)) == [(1, "a", 1), (3, "c", -1)]
    assert tuple(compare.parity(left, right).first()) == (3, 3, 1, 1)
    assert tuple(compare.parity(left.limit(0), right.limit(0)).first()) == (0, 0, 0, 0)
