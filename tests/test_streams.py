from __future__ import annotations

import json
import os
import shutil
from datetime import timedelta
from types import SimpleNamespace

import pytest
from conftest import DATA, at, rows_of
from pyspark.errors import StreamingQueryException
from pyspark.sql import Window
from pyspark.sql import functions as F

from postflow.operators import compare, windows
from postflow.operators.posts import activity_rows, hashtag_rows, message_rows, window_messages
from postflow.plans import metrics, registry, reports
from postflow.schemas import HASHTAGS_TOPIC, TWEETS_TOPIC, USER_ACTIVITY_TOPIC
from postflow.sources.messages import once, topic_stream
from postflow.sources.posts import event_posts
from postflow.streaming import jobs
from postflow.streaming.late import Clock, late_posts
from postflow.streaming.state import held_windows, state_operators
from postflow.streaming.table import EpochTable

NOW = {"availableNow": True}
SLICES = 4


@pytest.fixture(scope="module")
def posts(spark):
    events = spark.read.parquet(str(DATA / "sf0.001" / "events.parquet"))
    return event_posts(events).withColumn("timestamp", F.col("timestamp").cast("timestamp"))


@pytest.fixture(scope="module")
def slices(spark, posts, tmp_path_factory):
    """One transport file per topic and quarter of the time span, in a folder per quarter."""
    folder = tmp_path_factory.mktemp("slices")
    quarter = F.ntile(SLICES).over(Window.orderBy("timestamp"))
    parted = posts.withColumn("quarter", quarter).persist()
    for i in range(SLICES):
        rows = parted.filter(F.col("quarter") == i + 1)
        (message_rows(rows, F.col("timestamp"))
         .select("topic", F.col("value").cast("binary").alias("value"))
         .coalesce(1).write.partitionBy("topic").parquet(str(folder / str(i))))
    parted.unpersist()
    return folder


def arrange(slices, target, order):
    """Copy slices so that they arrive in ``order``; returns a source of them."""
    for place, number in enumerate(order):
        for topic in (TWEETS_TOPIC, HASHTAGS_TOPIC, USER_ACTIVITY_TOPIC):
            folder = target / f"topic={topic}"
            folder.mkdir(parents=True, exist_ok=True)
            part = next((slices / str(number) / f"topic={topic}").glob("*.parquet"))
            copy = folder / f"{place}-{number}.parquet"
            shutil.copy(part, copy)
            os.utime(copy, (1_700_000_000 + 60 * place,) * 2)


def source(spark, folder):
    return lambda topic: topic_stream(spark, topic, "parquet", str(folder), maxFilesPerTrigger="1")


def batch_users(posts):
    return windows.windowed_posts(posts).withColumnRenamed("timestamp", "last_updated")


ORDERED, REVERSED = (0, 1, 2, 3), (3, 2, 1, 0)


@pytest.mark.parametrize("order", [ORDERED, REVERSED, (0, 1, 1, 2, 3, 3)])
def test_complete_equals_batch_at_any_order(spark, posts, slices, tmp_path, order):
    arrange(slices, tmp_path / "in", order)
    stream = windows.windowed_posts(jobs.good(source(spark, tmp_path / "in"), TWEETS_TOPIC))
    table = EpochTable.named(spark, str(tmp_path), "user_activity", complete=True)
    jobs.finish([jobs.start_merge(stream, table, "complete", NOW)])
    assert table.next_epoch() == len(order)
    quarter = F.ntile(SLICES).over(Window.orderBy("timestamp"))
    parted = posts.withColumn("part", quarter - 1)
    arrived = spark.createDataFrame([(n,) for n in order], "part int").join(parted, "part")
    assert tuple(compare.parity(table.current(), batch_users(arrived)).first())[2:] == (0, 0)


def test_update_equals_batch_in_time_order(spark, posts, slices, tmp_path):
    arrange(slices, tmp_path / "in", ORDERED)
    stream = windows.windowed_posts(jobs.good(source(spark, tmp_path / "in"), TWEETS_TOPIC))
    table = EpochTable.named(spark, str(tmp_path), "user_activity")
    jobs.finish([jobs.start_merge(stream, table, "update", NOW)])
    assert tuple(compare.parity(table.current(), batch_users(posts)).first())[2:] == (0, 0)
    table.compact()
    assert tuple(compare.parity(table.current(), batch_users(posts)).first())[2:] == (0, 0)


def test_update_drops_what_is_later_than_the_watermark(spark, posts, slices, tmp_path):
    arrange(slices, tmp_path / "in", REVERSED)
    stream = windows.windowed_posts(jobs.good(source(spark, tmp_path / "in"), TWEETS_TOPIC))
    table = EpochTable.named(spark, str(tmp_path), "user_activity")
    query = jobs.start_merge(stream, table, "update", NOW)
    jobs.finish([query])
    progress = metrics.ProgressLog()
    for done in query.recentProgress:
        progress.onQueryProgress(SimpleNamespace(progress=done))
    dropped = sum(progress.late.values())
    assert f"{dropped} late in" in progress.line()
    left = tuple(compare.parity(table.current(), batch_users(posts)).first())
    assert dropped > 0 and left[0] < left[1] and left[2] == 0


def test_increment_replays_a_batch_that_was_not_committed(spark, posts, slices, tmp_path):
    """The sink finished epoch 3, the query did not log it: the batch runs again."""
    arrange(slices, tmp_path / "in", ORDERED)
    table = EpochTable.named(spark, str(tmp_path), "user_activity", "increment")

    def run():
        rows = jobs.activity_shape(jobs.good(source(spark, tmp_path / "in"), USER_ACTIVITY_TOPIC))
        jobs.finish([jobs.start_merge(rows, table, "append", NOW)])

    run()
    before = rows_of(table.current())
    for name in ("3", ".3.crc"):
        commit = tmp_path / "user_activity" / "_checkpoint" / "commits" / name
        if commit.exists():
            commit.unlink()
    run()
    assert rows_of(table.current()) == before
    assert table.current().agg(F.sum("tweet_count")).first()[0] == posts.count()


def test_a_failing_sink_fails_the_query_and_the_restart_heals(spark, posts, slices, tmp_path):
    arrange(slices, tmp_path / "in", ORDERED)
    table = EpochTable.named(spark, str(tmp_path), "tweets")
    rows = jobs.good(source(spark, tmp_path / "in"), TWEETS_TOPIC)
    save = jobs.table_sink(table, ("timestamp",))

    def break_at_two(batch, epoch):
        save(batch, epoch)
        if epoch == 2:
            raise RuntimeError("lost executor")

    with pytest.raises(Exception, match="lost executor"):
        jobs.finish([jobs.start(rows, break_at_two, table.checkpoint, trigger=NOW)])
    spark.streams.resetTerminated()
    jobs.finish([jobs.start(rows, save, table.checkpoint, trigger=NOW)])
    assert table.current().count() == posts.count()
    assert table.current().select("tweet_id").distinct().count() == posts.count()


def test_all_jobs_with_progress_and_comparison(spark, posts, slices, tmp_path):
    arrange(slices, tmp_path / "in", ORDERED)
    progress = metrics.ProgressLog()
    spark.streams.addListener(progress)
    try:
        queries = jobs.start_analysis(spark, str(tmp_path), source(spark, tmp_path / "in"),
                                      mode="update", trigger=NOW, raw_trigger=NOW)
        jobs.finish(queries.values())
        assert len(queries) == 8
        assert progress.settle(queries.values())
    finally:
        spark.streams.removeListener(progress)
    tables = {name: EpochTable.named(spark, str(tmp_path), name.replace("_direct", ""),
                                     folder=name).current()
              for name in queries if not name.startswith("rejects")}
    assert tables["late_posts"].count() == 0
    assert tables["tweets"].count() == posts.count()
    assert rows_of(tables["hashtag_counts"]) == rows_of(tables["hashtag_counts_direct"])
    assert rows_of(tables["user_activity"]) == rows_of(tables["user_activity_direct"])
    assert tuple(compare.parity(tables["user_activity"], batch_users(posts)).first())[2:] == (0, 0)
    assert progress.counts["tweets"] == posts.count()
    assert progress.counts["hashtag_counts_direct"] == 2 * posts.count()
    assert f"{posts.count()} tweets" in progress.line()

    log = str(tmp_path / "performance_metrics")
    metrics.append_metrics(spark, progress.drain(), log)
    assert progress.drain() == []
    runs = metrics.run_reports(spark, reports.batch_reports(
        tables["hashtag_counts"], tables["user_activity"]), log)
    assert [run[4] for run in runs] == [10, 10, 10]
    stored = spark.read.parquet(log)
    assert {row["execution_mode"] for row in stored.collect()} == {"batch", "streaming"}
    compared = metrics.compare_families(stored)
    assert {row["query_family"] for row in compared.collect()} == {"hashtags", "users"}
    assert metrics.compare(stored).count() == 0  # no batch type is part of a streaming id


def test_loads_keep_rejects(spark, root):
    good = {"tweet_id": 1, "username": "u", "text": "#a", "retweets": 1, "likes": 2,
            "timestamp": "2024-01-01 11:05:00"}
    lines = [json.dumps(good).encode(), json.dumps({**good, "likes": 9}).encode(), b"oops"]
    tags = [json.dumps({"hashtag": "a", "timestamp": good["timestamp"]}).encode()] * 3 + [b"{}"]
    activity = [json.dumps({"username": "u", "tweet_count": n, "retweets": 1, "likes": 2,
                            "timestamp": "2024-01-01T11:05:00"}).encode() for n in (1, 4)]
    rows = [(value, topic) for topic, values in (
        (TWEETS_TOPIC, lines), (HASHTAGS_TOPIC, tags), (USER_ACTIVITY_TOPIC, activity))
        for value in values]
    spark.createDataFrame(rows, "value binary, topic string").coalesce(1).write.partitionBy(
        "topic").parquet(f"{root}/in")
    for _ in range(2):
        jobs.finish(jobs.start_loads(spark, f"{root}/out", source(spark, f"{root}/in"),
                                     NOW).values())
    read = {name: EpochTable.named(spark, f"{root}/out", name, policy).current()
            for name, policy, _, _ in jobs.LOADS.values()}
    assert rows_of(read["tweets"], "tweet_id", "likes") == [(1, 2)]
    assert rows_of(read["hashtag_counts"], "hashtag", "count") == [("a", 3)]
    assert rows_of(read["user_activity"], "username", "tweet_count", "total_likes",
                   "total_retweets") == [("u", 5, 4, 2)]
    bad = spark.read.parquet(*[f"{root}/out/rejects/topic={t}/epoch=0" for t, _ in (
        (TWEETS_TOPIC, 0), (HASHTAGS_TOPIC, 0))])
    assert rows_of(bad, "raw") == [("oops",), ("{}",)]


def test_the_first_offset_wins(spark, root):
    lines = [json.dumps({"tweet_id": 1, "username": "u", "text": text, "retweets": 0, "likes": 0,
                         "timestamp": f"2024-01-01 11:0{minute}:00"}).encode()
             for text, minute in (("second", 1), ("first", 9), ("third", 0))]
    spark.createDataFrame(
        [(lines[n], offset, 0, TWEETS_TOPIC) for n, offset in ((0, 8), (1, 7), (2, 9))],
        "value binary, offset long, partition int, topic string").coalesce(1).write.partitionBy(
        "topic").parquet(f"{root}/in")
    jobs.finish([jobs.start_shared(spark, f"{root}/out", source(spark, f"{root}/in"), NOW)])
    tweets = EpochTable.stored(spark, f"{root}/out", "tweets").current()
    assert rows_of(tweets, "tweet_text") == [("first",)]


def test_republished_windows_follow_the_table(spark, posts, slices, tmp_path):
    arrange(slices, tmp_path / "in", ORDERED)
    tags = hashtag_rows(jobs.good(source(spark, tmp_path / "in"), TWEETS_TOPIC))
    table = EpochTable.named(spark, str(tmp_path), "hashtag_counts")
    out = str(tmp_path / "out")
    jobs.finish([jobs.start_merge(windows.windowed_hashtags(tags), table, "update", NOW,
                                  send=jobs.message_writer("parquet", path=out))])
    sent = spark.read.parquet(out)
    assert sent.count() >= table.current().count()
    fields = json.loads(sent.first()["value"])
    assert list(fields) == ["hashtag", "count", "window_end", "timestamp"]


def test_stop_and_run_until_stopped(spark, tmp_path, slices):
    arrange(slices, tmp_path / "in", ORDERED)
    rows = source(spark, tmp_path / "in")(TWEETS_TOPIC)
    queries = [rows.writeStream.format("noop").option(
        "checkpointLocation", str(tmp_path / f"cp{i}")).trigger(availableNow=True).start()
        for i in range(2)]
    jobs.run_until_stopped(spark, queries)
    assert not any(query.isActive for query in queries)


def test_timed_counts_records_on_the_way(spark):
    row = metrics.timed("batch_x", spark.range(7))
    assert row[0] == "batch_x" and row[1] == "batch" and row[2] > 0 and row[4] == 7


def test_comparison_takes_the_last_mode_and_skips_zero_times(spark, posts):
    rows = spark.createDataFrame(
        [("batch_q", "batch", 2.0), ("batch_q", "manual", 4.0), ("s_q_x", "streaming", 1.0),
         ("s_q_x", "streaming_b", 8.0), ("batch_z", "batch", 0.0), ("s_z", "streaming", 1.0)],
        "query_id string, execution_mode string, execution_time double")
    assert [tuple(row) for row in metrics.compare(rows).collect()] == [
        ("q", "s_q_x", 8.0, 4.0, 4.0, "Batch", 2.0)]
    assert metrics.total_time(rows).first()[0] == 16.0
    assert [r["query_id"] for r in metrics.sorted_summary(rows).collect()] == [
        "batch_q", "batch_q", "batch_z", "s_q_x", "s_q_x", "s_z"]


def test_activity_rows_are_stamped_now_by_default(spark, posts):
    stamped = activity_rows(posts).select("timestamp").distinct().collect()
    assert len(stamped) == 1 and stamped[0][0] > at(0).replace(tzinfo=None)


def state_sizes(query) -> int:
    """Most rows that the query held in state after a batch."""
    return max(sum(x["numRowsTotal"] for x in p["stateOperators"]) for p in query.recentProgress)


def test_chained_windows_equal_batch_and_hold_less_state(spark, posts, slices, tmp_path):
    arrange(slices, tmp_path / "in", ORDERED)
    tags = hashtag_rows(jobs.good(source(spark, tmp_path / "in"), TWEETS_TOPIC))
    held, newest = {}, posts.agg(F.max("timestamp")).first()[0]
    for name, rows, mode in (("chained", windows.chained_hashtags(tags), "append"),
                             ("plain", windows.windowed_hashtags(tags), "update")):
        table = EpochTable.named(spark, str(tmp_path), "hashtag_counts", folder=name)
        query = jobs.start_merge(rows, table, mode, NOW)
        jobs.finish([query])
        held[name] = state_sizes(query)
        if name == "chained":
            passed = F.col("window_end") <= F.lit(newest) - F.expr("INTERVAL 20 MINUTES")
            want = windows.windowed_hashtags(hashtag_rows(posts)).withColumnRenamed(
                "timestamp", "last_updated").filter(passed)
            assert tuple(compare.parity(table.current(), want).first())[2:] == (0, 0)
            names = state_operators(spark, table.checkpoint).select("operatorName").distinct()
            assert names.count() == 1 and state_operators(
                spark, table.checkpoint).select("operatorId").distinct().count() == 2
        else:
            ends = held_windows(spark, table.checkpoint).agg(F.min("window_end")).first()[0]
            assert ends > newest - timedelta(minutes=20)
    assert held["chained"] < held["plain"]
    batch = windows.chained_hashtags(hashtag_rows(posts))
    assert tuple(compare.parity(batch, windows.windowed_hashtags(hashtag_rows(posts)))
                 .first())[2:] == (0, 0)


def test_windows_of_a_row(spark, posts):
    spread = windows.windows_of(posts).groupBy("username", "window_end").agg(
        F.count(F.lit(1)).alias("tweet_count"))
    want = windows.windowed_posts(posts).select("username", "window_end", "tweet_count")
    assert tuple(compare.parity(spread, want).first())[2:] == (0, 0)


def test_late_posts_of_an_epoch_that_runs_again(spark, posts, root):
    clock = Clock(spark, f"{root}/clock")
    assert clock.before(0) is None
    clock.set(0, at(10))
    clock.set(1, at(50))
    clock.set(2, at(55))
    for _ in range(2):  # the last epoch again: the one before it is still known
        assert clock.before(2) == at(50).replace(tzinfo=None)
        clock.set(2, at(55))
    assert len(os.listdir(f"{root}/clock")) <= 3
    rows = spark.createDataFrame([(1, at(29, 59)), (2, at(30)), (3, at(14))], "tweet_id long, timestamp timestamp")
    found = late_posts(rows, at(50))
    assert rows_of(found, "tweet_id", "window_end") == sorted(
        [(1, at(30).replace(tzinfo=None))]
        + [(3, at(m).replace(tzinfo=None)) for m in (15, 20, 25)], key=repr)
    assert late_posts(rows, None).count() == 0


def test_queries_have_pools_of_their_own(spark, slices, tmp_path):
    arrange(slices, tmp_path / "in", ORDERED)
    queries = jobs.start_analysis(spark, str(tmp_path / "t"), source(spark, tmp_path / "in"),
                                  "update", NOW, NOW)
    jobs.finish(queries.values())
    context = spark.sparkContext
    assert context.getLocalProperty("spark.scheduler.pool") is None
    pools = {name for name in queries if context._jsc.sc().getPoolForName(name).isDefined()}
    assert pools >= set(queries)


def test_the_first_failure_stops_all_queries(spark, slices, tmp_path):
    arrange(slices, tmp_path / "in", ORDERED)
    rows = jobs.good(source(spark, tmp_path / "in"), TWEETS_TOPIC)

    def broken(batch, epoch):
        raise ValueError("broken")

    running = jobs.start(rows, lambda batch, epoch: None, str(tmp_path / "a"), name="running",
                         trigger={"processingTime": "1 second"})
    failing = jobs.start(rows, broken, str(tmp_path / "b"), name="failing", trigger=NOW)
    with pytest.raises(StreamingQueryException):
        jobs.finish([failing, running])
    assert not running.isActive and not failing.isActive


def event_folder(spark, root, minutes):
    """An event table with a post at each of these minutes."""
    rows = [(number, minute, number % 7) for number, minute in enumerate(minutes)]
    start = "TIMESTAMP_NTZ'2024-01-01 00:00:00'"
    (spark.createDataFrame(rows, "event_id long, minute long, user_id long").selectExpr(
        "event_id", f"{start} + make_dt_interval(0, 0, minute) AS ts", "user_id",
        "'click' AS event_type", "event_id * 1.5D AS value", """'{"k": "5"}' AS props""")
     .write.parquet(f"{root}/events.parquet"))
    return root


def test_files_of_topics_grow_in_number_and_not_in_size(spark, root, monkeypatch):
    """A task sorts about ``FILE_MESSAGES``, and the stream still reads them in two batches."""
    monkeypatch.setattr(registry, "FILE_MESSAGES", 100, raising=False)
    folder = registry.topic_files(spark, event_folder(spark, root, range(1000)))
    written = spark.read.schema("value binary, topic string").parquet(folder)
    sizes = written.groupBy(F.regexp_extract(F.input_file_name(), "part-([0-9]+)", 1)).count()
    assert written.count() == 4000
    assert sizes.count() == 40 and sizes.agg(F.max("count")).first()[0] <= 150
    posts = jobs.good(registry.replay(spark, folder), TWEETS_TOPIC)
    table = EpochTable.named(spark, f"{root}/tables", "tweets")
    jobs.finish([jobs.start_merge(posts, table, trigger=NOW, order=("timestamp",))])
    assert table.next_epoch() == 2 and table.current().count() == 1000


def test_slices_of_time_have_equally_many_files(spark, root, monkeypatch):
    """Also one with a single post: each micro-batch is a slice, so no post comes too late."""
    monkeypatch.setattr(registry, "FILE_MESSAGES", 100, raising=False)
    minutes = [*range(250), 300, *range(500, 1000)]
    folder = event_folder(spark, root, minutes)
    found = spark.read.schema("value binary, topic string").parquet(
        registry.timed_files(spark, folder)).inputFiles()
    for topic in (TWEETS_TOPIC, HASHTAGS_TOPIC, USER_ACTIVITY_TOPIC):
        assert sum(f"/topic={topic}/" in path for path in found) == 10 * registry.SLICES
    stream = registry.stream_update_merge_users(spark, folder)
    batch = registry.without_zone(batch_users(registry.posts_of(spark, folder)))
    assert rows_of(stream) == rows_of(batch, *stream.columns)


def test_files_of_topics_are_so_many_at_most_and_even(spark, root, monkeypatch):
    """A shuffle into more parts holds a task's messages in memory. All messages are written, and
    the stream still reads them in two batches."""
    monkeypatch.setattr(registry, "FILE_MESSAGES", 10)
    monkeypatch.setattr(registry, "MOST_FILES", 8, raising=False)
    folder = registry.topic_files(spark, event_folder(spark, root, range(1000)))
    for topic, rows in ((TWEETS_TOPIC, 1000), (HASHTAGS_TOPIC, 2000), (USER_ACTIVITY_TOPIC, 1000)):
        sizes = spark.read.parquet(f"{folder}/topic={topic}").groupBy(F.input_file_name()).count()
        found = [row["count"] for row in sizes.collect()]
        assert len(found) == 8 and sum(found) == rows and max(found) - min(found) <= 8
    posts = jobs.good(registry.replay(spark, folder), TWEETS_TOPIC)
    table = EpochTable.named(spark, f"{root}/tables", "tweets")
    jobs.finish([jobs.start_merge(posts, table, trigger=NOW, order=("timestamp",))])
    assert table.next_epoch() == 2 and table.current().count() == 1000
    monkeypatch.undo()
    assert registry.file_count(10**9) <= 200 >= registry.file_count(10**9, 2)


def test_a_reader_deals_only_ids_and_values(spark, root, monkeypatch):
    """The other columns of transport rows would go through the shuffle by id; each message still
    comes once, and the last of each window is among them."""
    dealt = []

    def noted(messages):
        dealt.append(messages.columns)
        return once(messages)

    monkeypatch.setattr(registry, "once", noted)
    folder = event_folder(spark, root, range(0, 400, 4))
    read = rows_of(registry.stream_republish_once(spark, folder), "topic", "value")
    assert dealt == [["key", "value"]]
    assert len(read) == len(set(read))
    assert set(rows_of(window_messages(registry.user_windows_of(spark, folder)))) <= set(read)
