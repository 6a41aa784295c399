"""Stored tables as other sessions see them."""

from __future__ import annotations

import pytest
from conftest import at, rows_of

from postflow.__main__ import main
from postflow.plans import catalog
from postflow.schemas import TABLES
from postflow.session import separate
from postflow.streaming.table import EpochTable


@pytest.fixture()
def database(spark, root):
    spark.sql(f"CREATE DATABASE live LOCATION '{root}/live'")
    yield "live"
    spark.sql("DROP DATABASE live CASCADE")


def counts(spark, *rows):
    return spark.createDataFrame([(tag, n, end, end) for tag, n, end in rows],
                                 TABLES["hashtag_counts"])


def shown(spark, name="live.hashtag_counts"):
    return rows_of(separate(spark).table(name), "hashtag", "count")


def statements(spark, monkeypatch):
    """Texts of the statements that change a table's partitions."""
    seen, real = [], type(spark).sql

    def sql(self, text, *args, **kwargs):
        if " PARTITION " in text:
            seen.append(text)
        return real(self, text, *args, **kwargs)

    monkeypatch.setattr(type(spark), "sql", sql)
    return seen


def test_a_published_table_follows_the_folding(spark, root, database, monkeypatch):
    table = EpochTable.named(spark, root, "hashtag_counts", "increment", latest=True)
    name = catalog.table_name(database, "hashtag_counts")
    catalog.publish(table, name)
    assert shown(spark) == []
    table.write(counts(spark, ("a", 1, at(5)), ("b", 2, at(5, day=2))), 0)
    catalog.publish(table, name)
    assert shown(spark) == []  # not folded yet
    table.compact()
    catalog.publish(table, name)
    assert shown(spark) == [("a", 1), ("b", 2)]
    seen = statements(spark, monkeypatch)
    table.write(counts(spark, ("a", 4, at(5)), ("c", 3, at(5, day=3))), 1)
    table.compact()
    assert shown(spark) == [("a", 1), ("b", 2)]  # as published, whole
    catalog.publish(table, name)
    table.expire()
    assert shown(spark) == [("a", 5), ("b", 2), ("c", 3)]
    # One day moved, one is new; the third is left alone.
    assert len(seen) == 2 and not any("2024-01-02" in text for text in seen)
    catalog.publish(table, name)
    assert len(seen) == 2


def test_a_filter_on_the_part_reads_no_other(spark, root, database):
    table = EpochTable.named(spark, root, "tweets")
    posts = spark.createDataFrame(
        [(1, "u", "x", 0, 0, at(1)), (25_000_000, "v", "y", 0, 0, at(1))], TABLES["tweets"])
    table.write(posts, 0)
    table.compact()
    assert catalog.publish_all(spark, root, database) == ["`live`.`tweets`"]
    rows = spark.table("live.tweets")
    assert rows.columns == [*TABLES["tweets"].names, "key_range"]
    assert len(rows.inputFiles()) == 2
    plan = rows.filter("key_range = 2")._jdf.queryExecution().executedPlan().toString()
    assert "InMemoryFileIndex(1 paths)" in plan
    assert rows_of(rows.filter("key_range = 2"), "tweet_id") == [(25_000_000,)]


def test_an_interrupted_publishing_is_done_again(spark, root, database, monkeypatch):
    table = EpochTable.named(spark, root, "hashtag_counts", "increment", latest=True)
    name = catalog.table_name(database, "hashtag_counts")
    monkeypatch.setattr(catalog, "BATCH", 1)
    table.write(counts(spark, *[(f"t{day}", day, at(5, day=day)) for day in (1, 2, 3)]), 0)
    table.compact()
    real, calls = type(spark).sql, []

    def sql(self, text, *args, **kwargs):
        if " ADD IF NOT EXISTS " in text:
            calls.append(text)
            if len(calls) == 2:
                raise OSError("lost")
        return real(self, text, *args, **kwargs)

    with monkeypatch.context() as patch:
        patch.setattr(type(spark), "sql", sql)
        with pytest.raises(OSError):
            catalog.publish(table, name)
    assert shown(spark) == [("t1", 1)]
    catalog.publish(table, name)
    assert shown(spark) == [("t1", 1), ("t2", 2), ("t3", 3)]


def test_days_that_a_complete_table_lost_are_dropped(spark, root, database):
    table = EpochTable.named(spark, root, "hashtag_counts", complete=True)
    name = catalog.table_name(database, "hashtag_counts")
    table.replace(counts(spark, ("a", 1, at(5)), ("b", 2, at(5, day=2))), 0)
    catalog.publish(table, name)
    table.replace(counts(spark, ("b", 7, at(5, day=2))), 1)
    catalog.publish(table, name)
    assert shown(spark) == [("b", 7)]


def test_a_table_of_somebody_else_is_left_alone(spark, root, database):
    name = catalog.table_name(database, "hashtag_counts")
    spark.sql(f"CREATE TABLE {name} (x INT) USING parquet LOCATION '{root}/own'")
    table = EpochTable.named(spark, root, "hashtag_counts")
    with pytest.raises(ValueError, match="another table"):
        catalog.publish(table, name)
    assert spark.table(name).columns == ["x"]


def test_paths_with_quotes(spark, root, database):
    table = EpochTable.named(spark, f"{root}/it's", "hashtag_counts")
    table.write(counts(spark, ("a", 1, at(5))), 0)
    table.compact()
    catalog.publish(table, catalog.table_name(database, "hashtag_counts"))
    assert shown(spark) == [("a", 1)]


def test_jobs_keep_the_catalog_fresh(spark, post_csv, root, database, capsys):
    topics, tables = f"{root}/topics", f"{root}/tables"
    where = ["--root", tables, "--database", database]
    main(["produce", "--csv", post_csv, "--topics", topics])
    main(["stream", "--once", "--topics", topics, *where])
    own = separate(spark)
    assert own.table("live.tweets").count() == 80
    assert own.table("live.user_activity").count() == 240
    assert own.table("live.stream_metrics").select("accepted").collect()[0][0] == 80
    assert own.table("live.performance_metrics").count() == 1
    main(["report", "--root", tables])
    main(["results", "--root", tables])
    main(["compact", "--expire", *where])
    assert own.table("live.user_activity").count() == 240
    own.catalog.refreshTable("live.performance_metrics")
    assert own.table("live.performance_metrics").count() == 4
    assert own.table("live.batch_users").count() == 80
    with pytest.raises(SystemExit):
        main(["catalog", "--root", tables])
    main(["catalog", *where])
    assert own.table("live.raw_tweets").count() == 80
    assert not [x for x in spark.catalog.listTables("live") if x.isTemporary]
