"""Every query by name: each takes a session and a folder of test tables."""

from __future__ import annotations

from collections import Counter
from dataclasses import replace
from functools import reduce
from math import ceil

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postflow.functions.text import (
    double_quotes, hashtag_count, hashtags, iso_text)
from postflow.operators import compare as matching
from postflow.operators import merge, windows
from postflow.operators.posts import activity_rows, hashtag_rows, message_rows, window_messages
from postflow.plans import catalog, metrics, reports, results
from postflow.plans.views import register_views
from postflow.schemas import (
    HASHTAGS_TOPIC, MERGES, MESSAGES, TWEETS_TOPIC, USER_ACTIVITY_TOPIC, USER_WINDOWS_TOPIC,
    MergeSpec)
from postflow.session import new_folder
from postflow.sources.messages import accepted, once, parse, rejected, topic_stream
from postflow.sources.posts import csv_posts, event_posts, typed_posts
from postflow.sources.tables import read_table, test_table
from postflow.streaming import jobs
from postflow.streaming.state import held_windows
from postflow.streaming.table import EpochTable

NOW = {"availableNow": True}
# Arrival batches that the posts are split into: for one merge, and for a stored table.
BATCHES, EPOCHS = 2, 3
# Files per topic that the streams read, or a multiple of them; half of them make a micro-batch.
FILES = 4
# Messages of all topics that go to one file of each, about, while there are no more than so many
# files per topic: a shuffle into up to 200 parts streams its rows, one into more holds them.
FILE_MESSAGES, MOST_FILES = 500_000, 200
# Slices of the time span, for streams in time order.
SLICES = 4


# Inputs ----------------------------------------------------------------------

def posts_of(spark: SparkSession, sf: str) -> DataFrame:
    return event_posts(test_table(spark, sf, "events"))


def tags_of(spark: SparkSession, sf: str) -> DataFrame:
    return hashtag_rows(posts_of(spark, sf))


def without_zone(frame: DataFrame) -> DataFrame:
    """Times as the test tables hold them."""
    return frame.select(*[
        F.col(name).cast("timestamp_ntz").alias(name) if kind == "timestamp" else F.col(name)
        for name, kind in frame.dtypes])


def messages_of(spark: SparkSession, sf: str) -> DataFrame:
    return message_rows(posts_of(spark, sf), F.col("timestamp"))


def topic_of(spark: SparkSession, sf: str, topic: str) -> DataFrame:
    rows = messages_of(spark, sf).filter(F.col("topic") == topic)
    return accepted(parse(rows, topic), topic)


def hashtag_windows_of(spark: SparkSession, sf: str) -> DataFrame:
    return windows.windowed_hashtags(tags_of(spark, sf))


def user_windows_of(spark: SparkSession, sf: str) -> DataFrame:
    return windows.windowed_posts(posts_of(spark, sf))


# Text, projections, messages ---------------------------------------------------

def hashtag_extract(spark, sf):
    return posts_of(spark, sf).select(
        "tweet_id", F.array_join(hashtags("text"), " ").alias("hashtags"))


def hashtag_explode(spark, sf):
    return tags_of(spark, sf)


def hashtag_count_per_post(spark, sf):
    return posts_of(spark, sf).select("tweet_id", hashtag_count("text").alias("hashtag_count"))


def url_fragments(spark, sf):
    return test_table(spark, sf, "pages").select(
        "page_id", F.explode(hashtags("url")).alias("fragment"))


def page_hashtags(spark, sf):
    """Tags in whole pages: the first word of each paragraph is made one."""
    tagged = F.replace("html", F.lit("<p>"), F.lit("<p>#"))
    tags = test_table(spark, sf, "pages").select(F.explode(hashtags(tagged)).alias("hashtag"))
    return tags.groupBy("hashtag").agg(F.count(F.lit(1)).alias("count"))


def document_hashtag_counts(spark, sf):
    """Tags in texts of four languages: the first word of each sentence is made one."""
    tagged = F.replace("text", F.lit(". "), F.lit(". #"))
    return test_table(spark, sf, "documents").select(
        "doc_id", hashtag_count(tagged).alias("hashtag_count"))


def escape_quotes(spark, sf):
    """Texts with apostrophes, which these get in place of a letter."""
    quoted = F.replace("text", F.lit("e"), F.lit("'"))
    return test_table(spark, sf, "documents").select("doc_id", double_quotes(quoted).alias("text"))


def iso_times(spark, sf):
    posts = posts_of(spark, sf)
    return posts.select("tweet_id", iso_text("timestamp").alias("iso"),
                        iso_text(F.date_trunc("minute", "timestamp")).alias("iso_minute"))


def post_project_cast(spark, sf):
    """Text columns to typed posts; retweets of error events do not convert."""
    posts = posts_of(spark, sf)
    records = posts.select(
        F.col("tweet_id").cast("string").alias("Tweet_ID"),
        F.col("username").alias("Username"),
        F.col("text").alias("Text"),
        F.when(F.col("text").contains("#error"), F.concat(F.lit("n"), F.col("retweets")))
        .otherwise(F.col("retweets").cast("string")).alias("Retweets"),
        F.col("likes").cast("string").alias("Likes"),
        F.col("timestamp").cast("string").alias("Timestamp"))
    return without_zone(typed_posts(records))


def user_activity_rows(spark, sf):
    return activity_rows(posts_of(spark, sf), F.col("timestamp"))


# Columns of the files, in another order than posts have them.
FILE_COLUMNS = ("Timestamp", "Likes", "Text", "Username", "Tweet_ID", "Retweets")


def document_csv(spark: SparkSession, sf: str, record_sep: str = "\n") -> str:
    """Documents written as post CSV files: long texts with newlines, quotes and commas, and names
    with a quote that is not quoted. Spark's CSV writer would put its separator into the texts."""
    folder = new_folder(spark, "csv")
    second = F.make_dt_interval(secs=F.col("doc_id"))
    fields = {
        "Tweet_ID": F.col("doc_id").cast("string"),
        "Username": F.concat("source", F.when(F.col("doc_id") % 3 == 0, ' 5"').otherwise("")),
        "Text": F.concat(F.lit('"'), F.replace("text", F.lit('"'), F.lit('""')), F.lit('"')),
        "Retweets": (F.col("n_chars") % 100).cast("string"),
        "Likes": F.when(F.col("lang") == "en", F.col("n_chars").cast("string")).otherwise("n/a"),
        "Timestamp": (F.lit("2023-01-01 00:00:00").cast("timestamp_ntz") + second).cast("string"),
    }
    line = F.concat_ws(",", *[fields[name] for name in FILE_COLUMNS])
    # A header stands before the first row of each task, which writes one file.
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    header = F.lit(",".join(FILE_COLUMNS) + record_sep)
    (test_table(spark, sf, "documents").select(F.when(first, F.concat(header, line)).otherwise(line))
     .write.option("lineSep", record_sep).text(folder))
    return folder


def csv_scan(spark, sf):
    return without_zone(csv_posts(spark, document_csv(spark, sf)))


def csv_record_sep_scan(spark, sf):
    """Records end in CR LF and texts hold only LF, so files are split over tasks."""
    folder = document_csv(spark, sf, "\r\n")
    return without_zone(csv_posts(spark, folder, record_sep="\r\n"))


def post_sample(spark, sf):
    """The source's row cap: 200 whole records in id order."""
    return posts_of(spark, sf).orderBy("tweet_id").limit(200)


def json_roundtrip(spark, sf):
    return without_zone(topic_of(spark, sf, TWEETS_TOPIC))


def json_wide_ids(spark, sf):
    """Ids beyond 32 bits through messages and a stored table."""
    posts = posts_of(spark, sf).withColumn("tweet_id", F.col("tweet_id") + 3_000_000_000)
    rows = message_rows(posts, F.col("timestamp")).filter(F.col("topic") == TWEETS_TOPIC)
    table = EpochTable.named(spark, new_folder(spark, "tables"), "tweets")
    table.write(accepted(parse(rows, TWEETS_TOPIC), TWEETS_TOPIC), 0, ("timestamp",))
    return without_zone(table.current())


def broken_messages(spark: SparkSession, sf: str) -> DataFrame:
    """Post messages of which some are cut, mistyped, out of range or without a field."""
    rows = messages_of(spark, sf).filter(F.col("topic") == TWEETS_TOPIC)
    kind = F.pmod(F.get_json_object("value", "$.tweet_id").cast("int"), F.lit(10))
    likes = F.concat(F.lit('"likes":'), F.get_json_object("value", "$.likes"))
    return rows.withColumn(
        "value",
        F.when(kind == 1, F.expr("substr(value, 1, char_length(value) - 9)"))
        .when(kind == 3, F.replace("value", likes, F.lit('"likes":99999999999')))
        .when(kind == 5, F.replace("value", likes, F.lit('"likes":null')))
        .when(kind == 7, F.replace("value", F.lit('"timestamp":"2024'), F.lit('"timestamp":"x')))
        .otherwise(F.col("value")))


def json_rejects(spark, sf):
    bad = rejected(parse(broken_messages(spark, sf), TWEETS_TOPIC), TWEETS_TOPIC)
    return bad.select("topic", "raw", F.array_join("missing", ",").alias("missing"))


def json_accepted(spark, sf):
    return without_zone(accepted(parse(broken_messages(spark, sf), TWEETS_TOPIC), TWEETS_TOPIC))


def message_fanout(spark, sf):
    return messages_of(spark, sf)


def window_republish(spark, sf):
    return window_messages(hashtag_windows_of(spark, sf)).unionByName(
        window_messages(user_windows_of(spark, sf)))


# Windows ---------------------------------------------------------------------

def hashtag_windows(spark, sf):
    return hashtag_windows_of(spark, sf)


def hashtag_windows_direct(spark, sf):
    return without_zone(windows.windowed_hashtags(topic_of(spark, sf, HASHTAGS_TOPIC)))


def user_windows(spark, sf):
    return user_windows_of(spark, sf)


def user_windows_direct(spark, sf):
    return without_zone(windows.windowed_activity(topic_of(spark, sf, USER_ACTIVITY_TOPIC)))


# Reports ---------------------------------------------------------------------

def top_hashtags(spark, sf):
    return reports.top_hashtags(hashtag_windows_of(spark, sf))


def top_users(spark, sf):
    return reports.top_users(user_windows_of(spark, sf))


def avg_likes_per_user(spark, sf):
    return reports.top_average_likes(user_windows_of(spark, sf))


def top_hashtags_exact(spark, sf):
    """Each post once: only windows that lie end to end."""
    return reports.top_hashtags(windows.tiling_windows(hashtag_windows_of(spark, sf)))


def top_users_exact(spark, sf):
    return reports.top_users(windows.tiling_windows(user_windows_of(spark, sf)))


def top_hashtag_rows(spark, sf):
    return reports.top_hashtag_rows(hashtag_windows_of(spark, sf))


def top_user_rows(spark, sf):
    return reports.top_user_rows(user_windows_of(spark, sf))


def avg_likes_rows(spark, sf):
    return reports.top_ratio_rows(user_windows_of(spark, sf))


def stored_hashtag_rows(spark, sf):
    return reports.top_rows(hashtag_windows_of(spark, sf), "count", "hashtag")


def stored_user_rows(spark, sf):
    return reports.top_rows(user_windows_of(spark, sf), "tweet_count", "username")


def row_ratios(spark, sf):
    return reports.row_ratios(user_windows_of(spark, sf))


def report_lines(spark, sf):
    return reports.report_lines(reports.batch_reports(
        hashtag_windows_of(spark, sf), user_windows_of(spark, sf)))


def sql_reports(spark, sf):
    """The first two reports as SQL text over views of stored tables."""
    root = new_folder(spark, "tables")
    for name, rows in (("hashtag_counts", hashtag_windows_of(spark, sf)),
                       ("user_activity", user_windows_of(spark, sf))):
        EpochTable.named(spark, root, name).write(rows, 0)
    names = register_views(spark, root, "sql_reports_")
    return spark.sql(f"""
        (SELECT hashtag AS name, SUM(count) AS total FROM {names['hashtag_counts']}
         GROUP BY hashtag ORDER BY total DESC NULLS FIRST, name LIMIT 10)
        UNION ALL
        (SELECT username AS name, SUM(tweet_count) AS total FROM {names['user_activity']}
         GROUP BY username ORDER BY total DESC NULLS FIRST, name LIMIT 10)""")


# Merges ----------------------------------------------------------------------

def batches(posts: DataFrame, n: int = BATCHES) -> list[DataFrame]:
    """All posts as arrival batches."""
    return [posts.filter(F.pmod("retweets", F.lit(n)) == i) for i in range(n)]


def user_posts(posts: DataFrame) -> DataFrame:
    """Posts keyed by their user, so that keys repeat within and across batches."""
    return posts.withColumn("tweet_id", F.substring_index("username", "_", -1).cast("bigint"))


def hourly_tags(posts: DataFrame) -> DataFrame:
    return hashtag_rows(posts).select(
        "hashtag", F.lit(1).cast("bigint").alias("count"),
        F.date_trunc("hour", "timestamp").cast("timestamp_ntz").alias("window_end"),
        F.col("timestamp").alias("last_updated"))


def hourly_activity(posts: DataFrame) -> DataFrame:
    return posts.select(
        "username", F.lit(1).cast("bigint").alias("tweet_count"),
        F.col("likes").cast("bigint").alias("total_likes"),
        F.col("retweets").cast("bigint").alias("total_retweets"),
        F.date_trunc("hour", "timestamp").cast("timestamp_ntz").alias("window_end"),
        F.col("timestamp").alias("last_updated"))


def user_results(posts: DataFrame) -> DataFrame:
    return windows.windowed_posts(posts).withColumnRenamed("timestamp", "last_updated")


def as_policy(name: str, policy: str) -> MergeSpec:
    return replace(MERGES[name], policy=policy)


def merge_insert_ignore(spark, sf):
    stored, new = batches(user_posts(posts_of(spark, sf)))
    spec = MERGES["tweets"]
    target = merge.first_per_key(stored, spec.keys, ("timestamp",))
    return merge.insert_ignore(target, new, spec, ("timestamp",))


def merge_overwrite(spark, sf):
    target, new = [user_results(batch) for batch in batches(posts_of(spark, sf))]
    return merge.overwrite(target, new, MERGES["user_activity"])


def merge_increment_hashtags(spark, sf):
    spec = as_policy("hashtag_counts", "increment")
    stored, new = [hourly_tags(batch) for batch in batches(posts_of(spark, sf))]
    return merge.increment(merge.deltas(stored, spec), new, spec)


def merge_increment_users(spark, sf):
    spec = as_policy("user_activity", "increment")
    stored, new = [hourly_activity(batch) for batch in batches(posts_of(spark, sf))]
    return merge.increment(merge.deltas(stored, spec), new, spec)


def table_epochs(spark, name, policy, parts, order=()):
    """Batches written as epochs of a stored table, folded once on the way."""
    table = EpochTable.named(spark, new_folder(spark, "tables"), name, policy)
    for epoch, part in enumerate(parts):
        table.write(part, epoch, order)
        if epoch == 1:
            table.compact()
    return without_zone(table.current())


def table_insert_ignore(spark, sf):
    parts = batches(user_posts(posts_of(spark, sf)), EPOCHS)
    return table_epochs(spark, "tweets", "ignore", parts, ("timestamp",))


def table_overwrite(spark, sf):
    parts = [user_results(batch) for batch in batches(posts_of(spark, sf), EPOCHS)]
    return table_epochs(spark, "user_activity", "overwrite", parts)


def table_increment(spark, sf):
    parts = [hourly_activity(batch) for batch in batches(posts_of(spark, sf), EPOCHS)]
    return table_epochs(spark, "user_activity", "increment", parts)


# Metrics ---------------------------------------------------------------------

def metric_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Events as runs: even ids as batch runs, odd ids as streaming runs."""
    batch = F.pmod("event_id", F.lit(2)) == 0
    return test_table(spark, sf, "events").select(
        F.when(batch, F.concat(F.lit("batch_"), "event_type"))
        .otherwise(F.concat(F.lit("spark_streaming_"), "event_type", F.lit("_counts")))
        .alias("query_id"),
        F.when(batch, "batch").otherwise("streaming").alias("execution_mode"),
        F.col("value").alias("execution_time"))


def rounded(frame: DataFrame) -> DataFrame:
    return frame.select(*[
        F.round(name, 4).alias(name) if kind == "double" else F.col(name)
        for name, kind in frame.dtypes])


def metrics_summary(spark, sf):
    return rounded(metrics.sorted_summary(metric_rows(spark, sf)))


def metrics_total(spark, sf):
    return rounded(metrics.total_time(metric_rows(spark, sf)))


def metrics_compare(spark, sf):
    return rounded(metrics.compare(metric_rows(spark, sf)))


def metrics_compare_lines(spark, sf):
    return metrics.comparison_lines(metrics.compare(metric_rows(spark, sf)))


def user_name_matches(spark, sf):
    """Substring join on user names: ``user_1`` is part of ``user_10``."""
    names = posts_of(spark, sf).select("username").distinct()
    pairs = matching.contains_join(
        names.select(F.col("username").alias("part")),
        names.select(F.col("username").alias("whole")), "part", "whole")
    return pairs.select("part", "whole")


def metrics_logged(spark, sf):
    """The three reports run, timed, logged and read back, without the times themselves."""
    log = new_folder(spark, "metrics")
    metrics.run_reports(spark, reports.batch_reports(
        hashtag_windows_of(spark, sf), user_windows_of(spark, sf)), log)
    return read_table(spark, "performance_metrics", "parquet", path=log).select(
        "query_id", "execution_mode", "window_size", "records_processed")


def stream_metrics_logged(spark, sf):
    """Records that the progress events of a streaming load tell, by query."""
    log, progress = new_folder(spark, "metrics"), metrics.ProgressLog()
    source = replay(spark, topic_files(spark, sf))
    spark.streams.addListener(progress)
    try:
        queries = list(jobs.start_loads(
            spark, new_folder(spark, "tables"), source, NOW).values())
        jobs.finish(queries)
        progress.settle(queries)
    finally:
        spark.streams.removeListener(progress)
    metrics.append_metrics(spark, progress.drain(), log)
    return read_table(spark, "performance_metrics", "parquet", path=log).groupBy(
        "query_id", "execution_mode", "window_size").agg(
        F.sum("records_processed").alias("records"))


def metrics_compare_families(spark, sf):
    """Events as runs whose names meet only by what they work on."""
    kinds = F.create_map(*[F.lit(x) for pair in (
        ("click", "hashtag"), ("view", "user"), ("purchase", "tweets")) for x in pair])
    rows = metric_rows(spark, sf)
    kind = F.regexp_extract("query_id", "(click|view|purchase)", 1)
    named = rows.withColumn("query_id", F.concat(
        F.col("execution_mode"), F.lit("_of_"), F.coalesce(kinds[kind], F.lit("others"))))
    return rounded(metrics.compare_families(named))


def processed_results(spark, sf):
    """The tables that set results side by side, without the time of processing."""
    tags = reports.processed_hashtags(hashtag_windows_of(spark, sf)).select(
        F.lit("hashtags").alias("result"), F.col("hashtag").alias("name"), F.col("count"),
        F.lit(None).cast("bigint").alias("likes"), F.lit(None).cast("bigint").alias("retweets"))
    users = reports.processed_users(user_windows_of(spark, sf)).select(
        F.lit("users").alias("result"), F.col("username").alias("name"),
        F.col("tweet_count").alias("count"), F.col("total_likes").alias("likes"),
        F.col("total_retweets").alias("retweets"))
    return tags.unionByName(users)


# Streams ---------------------------------------------------------------------

def file_count(messages: int, least: int = FILES) -> int:
    """Files per topic for that many messages: a multiple of ``least``, ``MOST_FILES`` at most."""
    return least * max(1, min(MOST_FILES // least, ceil(messages / (least * FILE_MESSAGES))))


def write_topics(messages: DataFrame, folder: str, files: int) -> None:
    """Messages as transport rows, one folder per topic with so many more files, or fewer if there
    are fewer messages.

    No task sorts: rows are dealt by their number, as ``repartition(files)`` sorts a scan task's
    messages first, and topics are written one after the other, as ``partitionBy`` sorts by topic.
    """
    dealt = F.pmod(F.monotonically_increasing_id(), F.lit(files)).cast("int")
    for topic in MESSAGES:
        (messages.filter(F.col("topic") == topic)
         .select(F.col("value").cast("binary").alias("value"), dealt.alias("file"))
         .repartitionById(files, "file").drop("file")
         .write.mode("append").parquet(f"{folder}/topic={topic}"))


def topic_files(spark: SparkSession, sf: str, messages: DataFrame | None = None) -> str:
    """The posts' messages, or those given, as transport rows, one folder per topic."""
    folder = new_folder(spark, "topics")
    messages = messages_of(spark, sf) if messages is None else messages
    write_topics(messages, folder, file_count(messages.count()))
    return folder


def files_by_topic(spark: SparkSession, folder: str) -> dict[str, int]:
    paths = spark.read.schema("value binary, topic string").parquet(folder).inputFiles()
    return Counter(path.split("/topic=")[1].split("/")[0] for path in paths)


def replay(spark: SparkSession, folder: str, batches: int | None = 2) -> jobs.Source:
    """Topic files in so many micro-batches, each of ``FILES / batches`` files at least; all in one
    if none are named."""
    if batches is None:
        return lambda topic: topic_stream(spark, topic, "parquet", folder)
    files = files_by_topic(spark, folder)
    return lambda topic: topic_stream(spark, topic, "parquet", folder, maxFilesPerTrigger=str(
        max(FILES // batches, ceil(files[topic] / batches))))


def run_merge(spark, name, rows, mode, policy=None, order=()) -> DataFrame:
    """Run one bounded stream into a new table and read the table."""
    table = EpochTable.named(spark, new_folder(spark, "tables"), name, policy,
                             complete=mode == "complete")
    jobs.finish([jobs.start_merge(rows, table, mode, NOW, order=order)])
    return without_zone(table.current())


def stream_append_raw(spark, sf):
    source = replay(spark, topic_files(spark, sf))
    return run_merge(spark, "tweets", jobs.good(source, TWEETS_TOPIC), "append",
                     order=("timestamp",))


def stream_complete_hashtags(spark, sf):
    posts = jobs.good(replay(spark, topic_files(spark, sf)), TWEETS_TOPIC)
    return run_merge(spark, "hashtag_counts", windows.windowed_hashtags(hashtag_rows(posts)),
                     "complete")


def stream_complete_users(spark, sf):
    posts = jobs.good(replay(spark, topic_files(spark, sf)), TWEETS_TOPIC)
    return run_merge(spark, "user_activity", windows.windowed_posts(posts), "complete")


def stream_complete_hashtags_direct(spark, sf):
    tags = jobs.good(replay(spark, topic_files(spark, sf)), HASHTAGS_TOPIC)
    return run_merge(spark, "hashtag_counts", windows.windowed_hashtags(tags), "complete")


def stream_complete_users_direct(spark, sf):
    activity = jobs.good(replay(spark, topic_files(spark, sf)), USER_ACTIVITY_TOPIC)
    return run_merge(spark, "user_activity", windows.windowed_activity(activity), "complete")


def timed_files(spark: SparkSession, sf: str, order=range(SLICES)) -> str:
    """Topic files that arrive in the order of the posts' times, or in another ``order`` of slices:
    a slice of the time span after the other, each in as many files as a micro-batch reads."""
    folder = new_folder(spark, "topics")
    posts = posts_of(spark, sf)
    seconds = F.unix_seconds(F.col("timestamp").cast("timestamp"))
    first, last = posts.agg(F.min(seconds), F.max(seconds)).first()
    width = (last - first) // SLICES + 1
    slice_of = F.floor((seconds - first) / width)
    # A post makes a message, its activity another, and so does each of its tags.
    messages = F.sum(F.coalesce(hashtag_count("text"), F.lit(0)) + 2)
    largest = posts.groupBy(slice_of.alias("slice")).agg(messages.alias("n")).agg(F.max("n"))
    files = file_count(largest.first()[0], FILES // 2)
    for done, number in enumerate(order, 1):
        part = posts.filter(slice_of == number)
        write_topics(message_rows(part, F.col("timestamp")), folder, files)
        fill_topics(spark, folder, done * files)
    return folder


def fill_topics(spark: SparkSession, folder: str, files: int) -> None:
    """Empty files where a topic has fewer than ``files``: a micro-batch that reads on into the
    next slice moves the watermark past posts of that slice which come after it."""
    found = files_by_topic(spark, folder)
    empty = spark.createDataFrame([], "value binary")
    for topic in MESSAGES:
        for _ in range(files - found[topic]):
            empty.write.mode("append").parquet(f"{folder}/topic={topic}")


def stream_update_merge_hashtags(spark, sf):
    """A micro-batch per slice of time: windows at the slices' edges are overwritten."""
    posts = jobs.good(replay(spark, timed_files(spark, sf), SLICES), TWEETS_TOPIC)
    return run_merge(spark, "hashtag_counts", windows.windowed_hashtags(hashtag_rows(posts)),
                     "update")


def stream_update_merge_users(spark, sf):
    posts = jobs.good(replay(spark, timed_files(spark, sf), SLICES), TWEETS_TOPIC)
    return run_merge(spark, "user_activity", windows.windowed_posts(posts), "update")


def stream_increment_hashtags(spark, sf):
    tags = jobs.good(replay(spark, topic_files(spark, sf)), HASHTAGS_TOPIC)
    return run_merge(spark, "hashtag_counts", jobs.tag_shape(tags), "append", "increment")


def stream_increment_users(spark, sf):
    activity = jobs.good(replay(spark, topic_files(spark, sf)), USER_ACTIVITY_TOPIC)
    return run_merge(spark, "user_activity", jobs.activity_shape(activity), "append", "increment")


def stream_republish(spark, sf):
    """Changed windows of each micro-batch sent on as messages; the last message of each key."""
    out = new_folder(spark, "messages")
    source = replay(spark, timed_files(spark, sf), SLICES)
    table = EpochTable.named(spark, new_folder(spark, "tables"), "user_activity")
    jobs.finish([jobs.start_merge(
        windows.windowed_posts(jobs.good(source, TWEETS_TOPIC)), table, "update", NOW,
        send=jobs.message_writer("parquet", path=out))])
    sent = spark.read.schema("value string, topic string").parquet(out)
    fields = F.json_tuple("value", "username", "window_end", "tweet_count").alias("u", "w", "n")
    # A window's count only grows, so the greatest is the last.
    return sent.select("topic", "value", fields).groupBy("topic", "u", "w").agg(
        F.max_by("value", F.col("n").cast("long")).alias("value")).select("topic", "value")


def stream_rejects(spark, sf):
    """Rejected records of all three topics of the analysis job, of which some are cut."""
    root = new_folder(spark, "tables")
    number = F.get_json_object("value", "$.likes").cast("int")
    cut = F.expr("substr(value, 1, char_length(value) - 9)")
    rows = messages_of(spark, sf).withColumn("value", F.when(
        (F.col("topic") == HASHTAGS_TOPIC) & F.contains("value", F.lit('"hashtag":"k1')), cut)
        .when((F.col("topic") != HASHTAGS_TOPIC) & (F.pmod(number, F.lit(10)) == 3), cut)
        .otherwise(F.col("value")))
    folder = topic_files(spark, sf, rows)
    jobs.finish(jobs.start_analysis(
        spark, root, replay(spark, folder, None), "update", NOW, NOW).values())
    return spark.read.parquet(f"{root}/rejects").groupBy("topic", "raw").agg(
        F.count(F.lit(1)).alias("n"))


def event_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The event table itself as a stream; the pattern names a folder's one file."""
    schema = test_table(spark, sf, "events").schema
    return spark.readStream.schema(schema).parquet(f"{sf.rstrip('/')}/event[s].parquet")


def stream_fanout(spark, sf):
    out = new_folder(spark, "messages")
    jobs.finish([jobs.start_fanout(
        event_posts(event_stream(spark, sf)), jobs.message_writer("parquet", path=out),
        new_folder(spark, "checkpoint"), NOW, F.col("timestamp"))])
    return spark.read.schema("value string, topic string").parquet(out).select("topic", "value")


def sizes(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows and summed measure of each table."""
    parts = [frame.agg(F.count(F.lit(1)).alias("n_rows"), F.sum(measure).alias("total"))
             .select(F.lit(name).alias("table_name"), "n_rows", "total")
             for name, (frame, measure) in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def stream_analysis(spark, sf):
    """All five analysis queries at once."""
    root = new_folder(spark, "tables")
    source = replay(spark, topic_files(spark, sf))
    jobs.finish(jobs.start_analysis(
        spark, root, source, "complete", trigger=NOW, raw_trigger=NOW).values())

    def table(name: str, folder: str) -> DataFrame:
        return EpochTable.named(spark, root, name, folder=folder,
                                complete=name != "tweets").current()

    return sizes({
        "tweets": (table("tweets", "tweets"), "likes"),
        "hashtag_counts": (table("hashtag_counts", "hashtag_counts"), "count"),
        "hashtag_counts_direct": (table("hashtag_counts", "hashtag_counts_direct"), "count"),
        "user_activity": (table("user_activity", "user_activity"), "total_likes"),
        "user_activity_direct": (table("user_activity", "user_activity_direct"), "total_likes"),
    })


def stream_loads(spark, sf):
    """All three topic loads at once."""
    root = new_folder(spark, "tables")
    jobs.finish(jobs.start_loads(
        spark, root, replay(spark, topic_files(spark, sf)), NOW).values())
    measure = {"tweets": "likes", "hashtag_counts": "count", "user_activity": "total_likes"}
    return sizes({name: (EpochTable.named(spark, root, name, policy).current(), measure[name])
                  for name, policy, _, _ in jobs.LOADS.values()})


def run_shared(spark, sf) -> str:
    root = new_folder(spark, "tables")
    jobs.finish([jobs.start_shared(spark, root, replay(spark, topic_files(spark, sf)), NOW)])
    return root


def stream_shared_hashtags(spark, sf):
    table = EpochTable.named(spark, run_shared(spark, sf), "hashtag_counts", "increment",
                             latest=True)
    return without_zone(table.current())


def stream_shared_users(spark, sf):
    table = EpochTable.named(spark, run_shared(spark, sf), "user_activity", "increment",
                             latest=True)
    return without_zone(table.current())


def catalog_hashtags(spark, sf):
    """A stored table as the catalog shows it by day: published empty, after a first folding and
    after a second one, which moves the days that got news."""
    root = new_folder(spark, "tables")
    table = EpochTable.named(spark, root, "hashtag_counts", "increment", latest=True)
    database = f"stored_{root.split('-')[-1].split('/')[0]}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{root}/_database'")
    name = catalog.table_name(database, "hashtag_counts")
    posts = posts_of(spark, sf)
    slice_of = F.pmod(F.xxhash64("tweet_id"), F.lit(BATCHES))
    for epoch in range(BATCHES):
        catalog.publish(table, name)
        rows = windows.windowed_hashtags(hashtag_rows(posts.filter(slice_of == epoch)))
        table.write(rows, epoch, unique=True)
        table.compact()
    catalog.publish(table, name)
    table.expire()
    return spark.table(name).groupBy("day", "hashtag").agg(
        F.count(F.lit(1)).alias("n_windows"), F.sum("count").alias("n_tags"))


class Broken(RuntimeError):
    """What a sink raises that is meant to fail."""


def failing(save: jobs.Save, at: int) -> jobs.Save:
    """A sink that fails once its epoch ``at`` is done, the first time."""
    failed = []

    def broken(rows: DataFrame, epoch: int) -> None:
        save(rows, epoch)
        if epoch == at and not failed:
            failed.append(epoch)
            raise Broken(f"epoch {epoch}")

    return broken


def run_twice(start) -> list:
    """Runs a query that fails, and again from its checkpoint; both runs."""
    runs = [start()]
    try:
        jobs.finish(runs)
    except StreamingQueryException:
        pass
    else:
        raise RuntimeError("the first run was to fail")
    runs.append(start())
    jobs.finish(runs[1:])
    return runs


def stream_metrics_keyed(spark, sf):
    """Metrics of two runs on one checkpoint, the first of which fails: every batch that ended is
    logged once, with its accepted and rejected records, flushed several times, and folded."""
    root, progress = new_folder(spark, "tables"), metrics.ProgressLog()
    source, users = replay(spark, topic_files(spark, sf), FILES), USER_ACTIVITY_TOPIC
    table = EpochTable.named(spark, root, "user_activity", "increment")
    save = failing(jobs.load_sink(table, users, jobs.rejects_folder(root, users),
                                  jobs.activity_shape), FILES // 2)
    spark.streams.addListener(progress)
    try:
        runs = run_twice(lambda: jobs.start(jobs.parsed_arrivals(source, users), save,
                                            table.checkpoint, trigger=NOW, name="keyed"))
        progress.settle(runs)
    finally:
        spark.streams.removeListener(progress)
    log = EpochTable.named(spark, root, "stream_metrics")
    rows = progress.drain_keyed()
    for epoch, some in enumerate((rows[:2], rows[1:], rows)):  # what is sent again counts once
        log.write(spark.createDataFrame(some, metrics.KEYED), epoch)
    log.compact()
    return log.current().groupBy("query_id").agg(
        F.count_distinct("run_id").alias("n_runs"), F.count(F.lit(1)).alias("n_batches"),
        F.sum("records_processed").alias("records"), F.sum("accepted").alias("accepted"),
        F.sum("rejected").alias("rejected"))


def stream_observed(spark, sf):
    """Accepted and rejected posts as the progress tells them, and as they were stored."""
    root = new_folder(spark, "tables")
    number = F.get_json_object("value", "$.likes").cast("int")
    rows = messages_of(spark, sf).withColumn("value", F.when(
        F.pmod(number, F.lit(10)) == 3, F.lit("{")).otherwise(F.col("value")))
    folder = topic_files(spark, sf, rows)
    progress = metrics.ProgressLog()
    spark.streams.addListener(progress)
    try:
        query = jobs.start_shared(spark, root, replay(spark, folder), NOW)
        jobs.finish([query])
        progress.settle([query])
    finally:
        spark.streams.removeListener(progress)
    told = spark.createDataFrame(progress.drain_keyed(), metrics.KEYED).agg(
        F.sum("accepted").alias("accepted"), F.sum("rejected").alias("rejected"))
    stored = EpochTable.named(spark, root, "tweets").current().agg(
        F.count(F.lit(1)).alias("stored"))
    kept = spark.read.parquet(jobs.rejects_folder(root, TWEETS_TOPIC)).agg(
        F.count(F.lit(1)).alias("kept"))
    return told.crossJoin(stored).crossJoin(kept)  # a row each


def stream_late_rows(spark, sf):
    """Posts in reversed slices of time: those behind the watermark, with the windows missed."""
    root = new_folder(spark, "tables")
    source = replay(spark, timed_files(spark, sf, reversed(range(SLICES))), SLICES)
    jobs.finish([jobs.start_late(spark, root, source, NOW)])
    late = EpochTable.named(spark, root, "late_posts").current()
    return without_zone(late.select("tweet_id", "window_end"))


def stream_chained_windows(spark, sf):
    """Two aggregates in one stream: the windows that the watermark has passed at the end."""
    posts = jobs.good(replay(spark, timed_files(spark, sf), SLICES), TWEETS_TOPIC)
    return run_merge(spark, "hashtag_counts", windows.chained_hashtags(hashtag_rows(posts)),
                     "append")


def stream_state_rows(spark, sf):
    """The windows that an update job still holds when its data ends, from its state."""
    posts = jobs.good(replay(spark, timed_files(spark, sf), SLICES), TWEETS_TOPIC)
    table = EpochTable.named(spark, new_folder(spark, "tables"), "user_activity")
    jobs.finish([jobs.start_merge(windows.windowed_posts(posts), table, "update", NOW)])
    return without_zone(held_windows(spark, table.checkpoint))


def stream_republish_once(spark, sf):
    """Windows sent on by a job that failed and sent a batch again, read as a stream: each message
    once, of every micro-batch."""
    out, root = new_folder(spark, "messages"), new_folder(spark, "tables")
    source = replay(spark, timed_files(spark, sf), SLICES)
    table = EpochTable.named(spark, root, "user_activity")
    write = jobs.message_writer("parquet", path=out)
    save = failing(jobs.table_sink(table, send=write), SLICES // 2)
    run_twice(lambda: jobs.start(windows.windowed_posts(jobs.good(source, TWEETS_TOPIC)), save,
                                 table.checkpoint, "update", NOW))
    # Ids and values alone go through the shuffle by id.
    read = once(topic_stream(spark, USER_WINDOWS_TOPIC, "parquet", out).select("key", "value"))
    seen = new_folder(spark, "seen")

    def keep(rows: DataFrame, epoch: int) -> None:
        rows.select(F.col("value").cast("string")).write.mode("overwrite").parquet(
            f"{seen}/epoch={epoch}")

    jobs.finish([jobs.start(read, keep, f"{root}/_reader", trigger=NOW)])
    return spark.read.schema("value string, epoch int").parquet(seen).select(
        F.lit(USER_WINDOWS_TOPIC).alias("topic"), "value")


def stored_results(spark, sf):
    """Streaming and batch totals as stored side by side, without the time of processing."""
    root = run_shared(spark, sf)
    results.store_results(spark, root)
    parts = []
    for name in results.RESULTS:
        rows = results.stored_result(spark, root, name).drop("processed_at")
        measures = [F.col(x) if x in rows.columns else F.lit(None).cast("bigint").alias(x)
                    for x in ("total_likes", "total_retweets")]
        parts.append(rows.select(
            F.lit(name).alias("result"), F.col(rows.columns[0]).alias("name"),
            F.col(rows.columns[1]).alias("count"), *measures))
    return reduce(DataFrame.unionByName, parts)


def stream_batch_parity(spark, sf):
    """The same aggregate as a stream and as a batch, compared row by row."""
    return matching.parity(stream_complete_users(spark, sf), user_results(posts_of(spark, sf)))


QUERIES = {query.__name__: query for query in (
    hashtag_extract, hashtag_explode, hashtag_count_per_post, url_fragments, page_hashtags,
    document_hashtag_counts, escape_quotes, iso_times, post_project_cast, user_activity_rows,
    csv_scan, csv_record_sep_scan, post_sample, json_roundtrip, json_wide_ids, json_rejects,
    json_accepted,
    message_fanout, window_republish,
    hashtag_windows, hashtag_windows_direct, user_windows, user_windows_direct,
    top_hashtags, top_users, avg_likes_per_user, top_hashtags_exact, top_users_exact,
    top_hashtag_rows, top_user_rows, avg_likes_rows, stored_hashtag_rows, stored_user_rows,
    row_ratios, report_lines, sql_reports,
    merge_insert_ignore, merge_overwrite, merge_increment_hashtags, merge_increment_users,
    table_insert_ignore, table_overwrite, table_increment,
    metrics_summary, metrics_total, metrics_compare, metrics_compare_lines,
    metrics_compare_families, metrics_logged, stream_metrics_logged, processed_results,
    user_name_matches,
    stream_append_raw, stream_complete_hashtags, stream_complete_users,
    stream_complete_hashtags_direct, stream_complete_users_direct,
    stream_update_merge_hashtags, stream_update_merge_users,
    stream_increment_hashtags, stream_increment_users, stream_republish, stream_fanout,
    stream_analysis, stream_loads, stream_shared_hashtags, stream_shared_users,
    stream_batch_parity, stream_rejects, stored_results,
    stream_metrics_keyed, stream_observed, stream_late_rows,
    stream_chained_windows, stream_state_rows, stream_republish_once, catalog_hashtags,
)}
