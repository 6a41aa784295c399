from __future__ import annotations

import os
import random
from dataclasses import replace
from datetime import date

import pyarrow.parquet as pq
import pytest
from conftest import at, rows_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from postflow.operators import merge
from postflow.schemas import MERGES, TABLES, MergeSpec
from postflow.streaming import table as table_module
from postflow.streaming.table import EpochTable

COUNTS = MERGES["hashtag_counts"]
INCREMENT = replace(COUNTS, policy="increment")
TWEETS = MERGES["tweets"]
FIRST = ("timestamp",)


def counts(spark, rows):
    return spark.createDataFrame(rows, TABLES["hashtag_counts"])


def tweets(spark, rows):
    return spark.createDataFrame(
        [(key, "u", text, 0, 0, when) for key, text, when in rows], TABLES["tweets"])


def test_ignore_keeps_the_first(spark):
    target = tweets(spark, [(1, "old", at(9))])
    source = tweets(spark, [(1, "new", at(1)), (2, "late", at(5)), (2, "early", at(2)),
                            (None, "no key", at(1))])
    merged = merge.insert_ignore(target, source, TWEETS, FIRST)
    assert rows_of(merged, "tweet_id", "tweet_text") == [(1, "old"), (2, "early")]


def test_overwrite_keeps_the_last(spark):
    target = counts(spark, [("a", 1, at(5), at(1)), ("b", 1, at(5), at(1))])
    source = counts(spark, [("a", 7, at(5), at(2)), ("a", 9, at(5), at(3)), ("c", 2, at(5), at(1))])
    merged = merge.overwrite(target, source, COUNTS, ("last_updated",))
    assert rows_of(merged, "hashtag", "count") == [("a", 9), ("b", 1), ("c", 2)]


def test_increment_adds_repeats_and_stored_counts(spark):
    target = counts(spark, [("a", 1, at(5), at(1)), ("b", 1, at(5), at(1))])
    source = counts(spark, [("a", 1, at(5), at(2)), ("a", 1, at(5), at(3)), ("c", 1, at(5), at(1)),
                            ("c", 1, None, at(1))])
    merged = merge.increment(target, source, INCREMENT)
    assert [(r["hashtag"], r["count"], r["last_updated"].minute)
            for r in merged.orderBy("hashtag").collect()] == [("a", 3, 3), ("b", 1, 1), ("c", 1, 1)]


def test_unknown_policy(spark):
    with pytest.raises(ValueError):
        merge.merge(None, None, MergeSpec(("k",), "upsert"))


ROWS = st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 3), st.integers(0, 2)),
                min_size=1, max_size=25)


@settings(max_examples=5, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ROWS, st.integers(0, 25))
def test_increment_is_the_same_for_any_batch_split(spark, drawn, cut):
    rows = [(tag, 1, at(5, day=day + 1), at(minute)) for tag, minute, day in drawn]
    whole = merge.deltas(counts(spark, rows), INCREMENT)
    split = merge.increment(merge.deltas(counts(spark, rows[:cut]), INCREMENT),
                            counts(spark, rows[cut:]), INCREMENT)
    columns = ("hashtag", "count", "window_end")
    assert rows_of(whole, *columns) == rows_of(split, *columns)


# The stored table ---------------------------------------------------------------

def test_epochs_fold_by_policy_with_and_without_compaction(spark, root):
    """Random epochs against a dictionary, compacting in between or not."""
    draw = random.Random(5)
    epochs = [{(draw.choice("abcdef"), draw.randint(1, 4)): draw.randint(1, 9) for _ in range(8)}
              for _ in range(6)]
    for policy in ("overwrite", "increment"):
        for compacting in (False, True):
            table = EpochTable.named(spark, root, "hashtag_counts", policy,
                                     folder=f"{policy}-{compacting}")
            want = {}
            for epoch, batch in enumerate(epochs):
                rows = [(tag, n, at(5, day=day), at(epoch)) for (tag, day), n in batch.items()]
                assert table.write(counts(spark, rows), epoch) == len(batch)
                for key, n in batch.items():
                    want[key] = (n if policy == "overwrite" else want.get(key, (0,))[0] + n, epoch)
                if compacting and epoch in (1, 3, 5):
                    table.compact()
                got = {(r["hashtag"], r["window_end"].day): (r["count"], r["last_updated"].minute)
                       for r in table.current().collect()}
                assert got == want
                assert len(got) == table.current().count()
            assert table.next_epoch() == len(epochs)


def test_replayed_epoch_replaces_itself(spark, root):
    table = EpochTable.named(spark, root, "hashtag_counts", "increment")
    for _ in range(3):
        table.write(counts(spark, [("a", 1, at(5), at(1))]), 0)
    table.write(counts(spark, [("a", 1, at(5), at(2))]), 1)
    assert rows_of(table.current(), "hashtag", "count") == [("a", 2)]
    table.compact()
    table.write(counts(spark, [("a", 1, at(5), at(2))]), 1)
    assert rows_of(table.current(), "hashtag", "count") == [("a", 2)]


def test_unfinished_epoch_is_not_read(spark, root):
    table = EpochTable.named(spark, root, "hashtag_counts")
    table.write(counts(spark, [("a", 1, at(5), at(1))]), 0)
    (counts(spark, [("a", 9, at(5), at(1))]).withColumn("day", F.to_date("window_end"))
     .write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
     .partitionBy("day").parquet(f"{table.data}/log/epoch=1"))
    assert rows_of(table.current(), "hashtag", "count") == [("a", 1)]


def bases(table) -> list[int]:
    return sorted(map(int, table._folders(f"{table.data}/base", "epoch")))


def test_compaction_leaves_out_what_finishes_meanwhile(spark, root):
    class Busy(EpochTable):
        def _merged(self, warm, log):
            merged = super()._merged(warm, log)
            self.write(counts(spark, [("a", 5, at(5), at(3))]), 2)
            return merged

    busy = Busy.named(spark, root, "hashtag_counts", "increment")
    for epoch in range(2):
        busy.write(counts(spark, [("a", 1, at(5), at(1))]), epoch)
    busy.compact()
    table = EpochTable.stored(spark, root, "hashtag_counts")
    assert bases(table) == [1]
    assert rows_of(table.current(), "hashtag", "count") == [("a", 7)]


def test_days_without_news_are_read_without_a_shuffle(spark, root):
    table = EpochTable.named(spark, root, "hashtag_counts", "overwrite")
    table.write(counts(spark, [("a", 1, at(5, day=day), at(1)) for day in range(1, 6)]), 0)
    table.compact()
    plan = table.current()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    table.write(counts(spark, [("a", 2, at(5, day=3), at(1))]), 1)
    table.compact()
    stored = table._folders(f"{table.data}/base/epoch=1", "day")
    assert list(stored) == ["2024-01-03"]
    assert [r["count"] for r in table.current().orderBy("window_end").collect()] == [1, 1, 2, 1, 1]


def test_a_batch_reads_only_the_key_ranges_it_touches(spark, root):
    """Also with one very old id in it, and the same however large the table has grown."""
    table = EpochTable.named(spark, root, "tweets")
    read = []
    for epoch in range(6):
        fresh = [(epoch * 10**9 + n, "a", at(1)) for n in range(3)]
        old = [(2, "again", at(0))] if epoch else []
        plan = table._plan(epoch, {str(row[0] // 10_000_000) for row in fresh + old}.__contains__)
        read.append(sum(map(len, plan)))
        assert table.write(tweets(spark, fresh + old), epoch, FIRST) == 3
    assert read == [0, 1, 1, 1, 1, 1]
    assert table.current().count() == 18
    table.compact()
    assert table.current().count() == 18


def test_old_ids_read_few_row_groups(spark, root):
    """One old id in a batch: of its part only the row groups that can hold it are read."""
    table = EpochTable.named(spark, root, "tweets")
    table.write(spark.range(0, 400_000, 2).selectExpr(
        "id AS tweet_id", "'u' AS username", "'a' AS tweet_text", "0 AS retweets", "0 AS likes",
        "timestamp_seconds(id) AS timestamp"), 0, FIRST)
    spark.conf.set("parquet.block.size", "200000")
    hadoop = spark._jsc.hadoopConfiguration()
    hadoop.set("parquet.block.size", "200000")
    try:
        table.compact()
    finally:
        hadoop.unset("parquet.block.size")
        spark.conf.unset("parquet.block.size")
    files = table.current().inputFiles()
    groups = sum(pq.ParquetFile(f.removeprefix("file://")).num_row_groups for f in files)
    assert groups > 4
    batch = [(1234, "again", at(0)), (1235, "new", at(0)), (10**9, "b", at(1))]
    fresh = table._new_rows(table._shaped(tweets(spark, batch)), 1, FIRST)
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThanOrEqual(tweet_id,1234)" in plan
    assert sorted(r.tweet_id for r in fresh.collect()) == [1235, 10**9]
    assert table.write(tweets(spark, batch), 1, FIRST) == 2


def test_upkeep_bounds_the_folders(spark, root):
    for name, rows in (("tweets", lambda n: tweets(spark, [(n, "a", at(1))])),
                       ("hashtag_counts", lambda n: counts(spark, [("a", n, at(5), at(1))]))):
        table = EpochTable.named(spark, root, name, "increment" if name != "tweets" else None)
        most = 0
        for epoch in range(13):
            table.write(rows(epoch + 1), epoch, *([FIRST] if name == "tweets" else []))
            table.upkeep(epoch, every=3)
            most = max(most, len(table._epochs()) + len(bases(table)))
        assert most <= 9
        assert table.current().count() == (13 if name == "tweets" else 1)
    assert table.current().first()["count"] == sum(range(1, 14))
    whole = EpochTable.named(spark, root, "hashtag_counts", folder="whole", complete=True)
    for epoch in range(9):
        whole.replace(counts(spark, [("a", epoch, at(5), at(1))]), epoch)
        whole.upkeep(epoch, every=3)
    assert len(bases(whole)) < 7 and whole.current().first()["count"] == 8


def test_calls_do_not_grow_with_the_bases(spark, root, monkeypatch):
    """Ids that grow, so that every folding leaves a base with the newest copy of some part."""
    calls = []
    for name in ("path_exists", "hadoop_path"):
        real = getattr(table_module, name)
        monkeypatch.setattr(table_module, name, lambda *a, real=real: calls.append(a) or real(*a))
    table = EpochTable.named(spark, root, "tweets")
    counted = []
    for epoch in range(36):
        calls.clear()
        table.write(tweets(spark, [(epoch * 10**8, "a", at(1)), (3, "old", at(1))]), epoch, FIRST)
        counted.append(len(calls))
        table.upkeep(epoch, every=2)
    assert len(bases(table)) > 15
    assert max(counted[24:]) <= max(counted[6:12])
    assert table.current().count() == 37
    table.expire()
    assert table.current().count() == 37


def test_a_base_without_its_index_does_not_count(spark, root):
    table = EpochTable.named(spark, root, "hashtag_counts", "increment")
    for epoch in range(4):
        table.write(counts(spark, [("a", 1, at(5, day=d), at(1)) for d in (1, epoch + 1)]), epoch)
        if epoch % 2:
            table.compact()
    want = rows_of(table.current())
    os.remove(f"{table.data}/base/epoch=3/_parts".removeprefix("file:"))
    assert table._base() == 1 and rows_of(table.current()) == want
    table.compact()
    assert table._base() == 3 and rows_of(table.current()) == want


def test_empty_batches_leave_no_epoch(spark, root):
    table = EpochTable.named(spark, root, "hashtag_counts")
    assert table.write(counts(spark, [("a", 1, at(5), at(1))]), 0) == 1
    assert table.write(counts(spark, []), 1) == 0
    assert list(table._epochs()) == [0]


def test_ignore_table(spark, root):
    table = EpochTable.named(spark, root, "tweets")
    assert table.write(tweets(spark, [(1, "a", at(1)), (1, "b", at(0)), (2, "c", at(1))]), 0, FIRST) == 2
    assert table.write(tweets(spark, [(2, "x", at(0)), (3, "d", at(1)), (None, "n", at(1))]), 1, FIRST) == 1
    table.compact()
    assert table.write(tweets(spark, [(3, "x", at(0)), (4, "e", at(1))]), 2, FIRST) == 1
    assert table.write(tweets(spark, [(3, "x", at(0)), (4, "e", at(1))]), 2, FIRST) == 1
    table.write(tweets(spark, []), 3, FIRST)
    want = [(1, "u", "b"), (2, "u", "c"), (3, "u", "d"), (4, "u", "e")]
    assert rows_of(table.current(), "tweet_id", "username", "tweet_text") == want
    table.compact()
    assert rows_of(table.current(), "tweet_id", "username", "tweet_text") == want


def test_complete_table_reads_the_newest_epoch_only(spark, root):
    table = EpochTable.named(spark, root, "hashtag_counts", complete=True)
    table.replace(counts(spark, [("a", 1, at(5), at(1)), ("b", 1, at(5, day=2), at(1))]), 0)
    table.replace(counts(spark, [("a", 2, at(5), at(1))]), 1)
    assert rows_of(table.current(), "hashtag", "count") == [("a", 2)]


def test_days_bound_what_is_read(spark, root):
    table = EpochTable.named(spark, root, "hashtag_counts", "increment")
    for epoch in range(2):
        table.write(counts(spark, [("a", 1, at(5, day=day), at(1)) for day in (1, 2, 3)]), epoch)
        if epoch == 0:
            table.compact()
    some = table.current(first=date(2024, 1, 2), last=date(2024, 1, 2))
    assert rows_of(some, "hashtag", "count") == [("a", 2)]
    assert all("day=2024-01-02" in name for name in some.inputFiles())


def test_expire_keeps_the_table(spark, root):
    table = EpochTable.named(spark, root, "hashtag_counts", "increment")
    for epoch in range(4):
        table.write(counts(spark, [("a", 1, at(5, day=d), at(1)) for d in (1, epoch + 1)]), epoch)
        if epoch < 3:
            table.compact()
    want = rows_of(table.current())
    table.expire()
    assert list(table._epochs()) == [3]
    assert rows_of(table.current()) == want
    assert sum(row[1] for row in want) == 7 + 1
    whole = EpochTable.named(spark, root, "user_activity", complete=True)
    for epoch in range(3):
        whole.replace(spark.createDataFrame([("u", epoch, 1, 1, at(5), at(1))],
                                            TABLES["user_activity"]), epoch)
    whole.expire()
    assert bases(whole) == [2]
    assert rows_of(whole.current(), "tweet_count") == [(2,)]


def test_latest_stamp_ignores_the_order_of_arrival(spark, root):
    table = EpochTable.named(spark, root, "hashtag_counts", "increment", latest=True)
    for epoch, minute in enumerate((3, 9, 4)):
        table.write(counts(spark, [("a", 1, at(5), at(minute))]), epoch)
        if epoch == 1:
            table.compact()
    row = table.current().first()
    assert (row["count"], row["last_updated"].minute) == (3, 9)


def test_a_table_is_opened_as_it_was_written(spark, root):
    row = counts(spark, [("a", 2, at(5), at(1))])
    writers = {"plain": {}, "sums": {"policy": "increment"}, "whole": {"complete": True},
               "latest": {"policy": "increment", "latest": True}}
    for folder, how in writers.items():
        table = EpochTable.named(spark, root, "hashtag_counts", folder=folder, **how)
        for epoch in range(2):
            table.replace(row, epoch) if table.complete else table.write(row, epoch)
        opened = EpochTable.stored(spark, root, "hashtag_counts", folder)
        assert opened.kind == table.kind
        want = 4 if "policy" in how else 2
        assert rows_of(opened.current(), "hashtag", "count") == [("a", want)]
    with pytest.raises(ValueError, match="nothing"):
        EpochTable.stored(spark, root, "hashtag_counts", "none")
    EpochTable.named(spark, root, "hashtag_counts", folder="sums").write(row, 2)
    with pytest.raises(ValueError, match="one kind"):
        EpochTable.stored(spark, root, "hashtag_counts", "sums")


def test_empty_table(spark, root):
    for name in MERGES:
        table = EpochTable.named(spark, root, name)
        assert table.current().count() == 0
        assert table.current().columns == TABLES[name].names
        table.compact()
        assert table.next_epoch() == 0


def test_hot_key_is_combined_before_the_shuffle(spark):
    """A key with a third of all rows reaches the shuffle as one row per task."""
    rows = spark.range(0, 9000, 1, 6).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('t', id % 50) END AS hashtag", "1L AS count",
        "timestamp '2024-01-01 00:00:00' AS window_end",
        "timestamp '2024-01-01 00:00:00' AS last_updated")
    folded = merge.deltas(rows, INCREMENT)
    plan = folded._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan and "SortAggregate" not in plan
    assert folded.filter("hashtag = 'hot'").first()["count"] == 3000


def test_a_day_with_most_rows_is_written_by_several_tasks(spark, root):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20k")
    try:
        table = EpochTable.named(spark, root, "hashtag_counts", "overwrite")
        rows = spark.range(0, 20000, 1, 8).selectExpr(
            "concat('t', id) AS hashtag", "1L AS count",
            "timestamp '2024-01-01 10:00:00' AS window_end",
            "timestamp '2024-01-01 10:00:00' AS last_updated")
        few = counts(spark, [(f"t{day}", 1, at(5, day=day), at(1)) for day in range(2, 9)])
        assert table.write(rows.unionByName(few), 0) == 20007
        files = [name for name in table.current().inputFiles()]
        assert sum("day=2024-01-01" in name for name in files) > 2
        assert sum("day=2024-01-05" in name for name in files) == 1
        assert table.current().count() == 20007
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
