"""The streaming jobs: windowed analysis of the topics, and the plain topic loads."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from postflow.operators.posts import hashtag_rows, message_rows, window_messages
from postflow.operators.windows import windowed_activity, windowed_hashtags, windowed_posts
from postflow.plans.metrics import ARRIVALS
from postflow.schemas import HASHTAGS_TOPIC, TRIGGER, TWEETS_TOPIC, USER_ACTIVITY_TOPIC
from postflow.sources.messages import accepted, arrivals, parse, rejected
from postflow.streaming.late import late_sink
from postflow.streaming.table import EpochTable

Save = Callable[[DataFrame, int], None]
Source = Callable[[str], DataFrame]


# The first of several posts with one id: by offset, or by time where there is none.
ARRIVAL = ("offset", "timestamp")


# Sinks -----------------------------------------------------------------------

def table_sink(table: EpochTable, order: tuple[str, ...] = (),
               send: Callable[[DataFrame], None] | None = None) -> Save:
    """A ``foreachBatch`` function that merges each micro-batch into ``table``.

    Rows stay on the executors. An error fails the query, and the restart
    replays the batch into the same epoch. With ``send`` the rows also go out as
    messages, after the table has them.
    """
    twice = send is not None or table.spec.policy == "ignore"

    def save(rows: DataFrame, epoch: int) -> None:
        if twice:
            rows = rows.persist()
        try:
            # An empty batch leaves no epoch: the table counts rows as it writes them.
            stored = (table.replace(rows, epoch) if table.complete
                      else table.write(rows, epoch, order))
            if send is not None and stored:
                send(window_messages(rows, table.path.rsplit("/", 1)[-1], epoch))
            table.upkeep(epoch)
        finally:
            if twice:
                rows.unpersist()

    return save


def keep_rejects(bad: DataFrame, rejects: str, epoch: int) -> None:
    """Rejected records of a stored batch; one without any leaves no folder."""
    if not bad.isEmpty():
        bad.write.mode("overwrite").parquet(f"{rejects}/epoch={epoch}")


def reject_sink(rejects: str) -> Save:
    """Keeps rejected records; batches without any leave nothing."""

    def save(rows: DataFrame, epoch: int) -> None:
        rows = rows.persist()
        try:
            keep_rejects(rows, rejects, epoch)
        finally:
            rows.unpersist()

    return save


def rejects_folder(root: str, topic: str) -> str:
    return f"{root.rstrip('/')}/rejects/topic={topic}"


def load_sink(table: EpochTable, topic: str, rejects: str, shape: Callable[[DataFrame], DataFrame],
              order: tuple[str, ...] = ()) -> Save:
    """Merges the good records of a topic and keeps the others under ``rejects``."""

    def save(parsed: DataFrame, epoch: int) -> None:
        parsed = parsed.persist()
        try:
            if parsed.isEmpty():
                return
            keep_rejects(rejected(parsed, topic), rejects, epoch)
            table.write(shape(accepted(parsed, topic)), epoch, order)
            table.upkeep(epoch)
        finally:
            parsed.unpersist()

    return save


def shared_sink(spark: SparkSession, root: str) -> Save:
    """Posts of one micro-batch into all three tables, from one reading.

    Window counts add up over batches, so each batch's windows are merged as
    increments: no state is held between batches and no row is too late.
    """
    tweets = EpochTable.named(spark, root, "tweets")
    counts = EpochTable.named(spark, root, "hashtag_counts", "increment", latest=True)
    users = EpochTable.named(spark, root, "user_activity", "increment", latest=True)
    rejects = rejects_folder(root, TWEETS_TOPIC)

    def save(parsed: DataFrame, epoch: int) -> None:
        parsed = parsed.persist()
        try:
            if parsed.isEmpty():
                return
            keep_rejects(rejected(parsed, TWEETS_TOPIC), rejects, epoch)
            posts = accepted(parsed, TWEETS_TOPIC)
            tweets.write(posts, epoch, ARRIVAL)
            counts.write(windowed_hashtags(hashtag_rows(posts)), epoch, unique=True)
            users.write(windowed_posts(posts), epoch, unique=True)
            for table in (tweets, counts, users):
                table.upkeep(epoch)
        finally:
            parsed.unpersist()

    return save


def message_writer(fmt: str = "kafka", **options: str) -> Callable[[DataFrame], None]:
    """Writes (topic, value) rows; file formats get one folder per topic."""

    def send(messages: DataFrame) -> None:
        writer = messages.write.format(fmt).options(**options).mode("append")
        if fmt != "kafka":
            writer = writer.partitionBy("topic")
        writer.save()

    return send


# Queries ---------------------------------------------------------------------

def start(rows: DataFrame, save: Save, checkpoint: str, mode: str = "append",
          trigger: dict | None = None, name: str | None = None) -> StreamingQuery:
    writer = (rows.writeStream.foreachBatch(save).outputMode(mode)
              .option("checkpointLocation", checkpoint))
    if trigger:
        writer = writer.trigger(**trigger)
    if name:
        writer = writer.queryName(name)
    # The query's thread inherits the pool, so the queries of a session share its cores evenly.
    context = rows.sparkSession.sparkContext
    context.setLocalProperty("spark.scheduler.pool", name)
    try:
        return writer.start()
    finally:
        context.setLocalProperty("spark.scheduler.pool", None)


def start_merge(rows: DataFrame, table: EpochTable, mode: str = "append",
                trigger: dict | None = None, name: str | None = None, **sink) -> StreamingQuery:
    return start(rows, table_sink(table, **sink), table.checkpoint, mode, trigger, name)


def parsed_arrivals(source: Source, topic: str) -> DataFrame:
    """Parsed records, of which the progress tells how many are accepted and rejected. For sinks
    that keep the batch: it must be computed once."""
    return arrivals(parse(source(topic), topic), topic, ARRIVALS)


def good(source: Source, topic: str) -> DataFrame:
    return accepted(parse(source(topic), topic), topic)


def tag_shape(tags: DataFrame) -> DataFrame:
    """Each tag message counts one, at its own time."""
    return tags.selectExpr("hashtag", "1L AS count", "timestamp AS window_end", "timestamp")


def activity_shape(activity: DataFrame) -> DataFrame:
    return activity.selectExpr(
        "username", "tweet_count", "likes AS total_likes", "retweets AS total_retweets",
        "timestamp AS window_end", "timestamp")


def start_analysis(spark: SparkSession, root: str, source: Source, mode: str = "update",
                   trigger: dict | None = None,
                   raw_trigger: dict | None = None,
                   send: Callable[[DataFrame], None] | None = None) -> dict[str, StreamingQuery]:
    """Raw posts and four windowed aggregates, each a query with its own table, and the rejects
    of all three topics.

    ``complete`` emits every window each time and keeps late rows, with state
    that only grows: for comparing streams with batches, not for long runs. ``update`` emits the windows that changed and drops state
    behind the watermark; the merge into the table then gives the same rows as
    long as no row is later than the watermark allows. The aggregates of the
    hashtag and activity topics get tables of their own, so that no two queries
    write to one table.
    """
    trigger = trigger or {"processingTime": TRIGGER}
    posts = good(source, TWEETS_TOPIC)
    results = {
        "hashtag_counts": ("hashtag_counts", windowed_hashtags(hashtag_rows(posts))),
        "user_activity": ("user_activity", windowed_posts(posts)),
        "hashtag_counts_direct": (
            "hashtag_counts", windowed_hashtags(good(source, HASHTAGS_TOPIC))),
        "user_activity_direct": (
            "user_activity", windowed_activity(good(source, USER_ACTIVITY_TOPIC))),
    }
    tweets = EpochTable.named(spark, root, "tweets")
    sink = load_sink(tweets, TWEETS_TOPIC, rejects_folder(root, TWEETS_TOPIC),
                     lambda rows: rows, ARRIVAL)
    queries = {"tweets": start(parsed_arrivals(source, TWEETS_TOPIC), sink,
                               tweets.checkpoint, trigger=raw_trigger, name="tweets")}
    if mode == "update":
        queries["late_posts"] = start_late(spark, root, source, trigger)
    for folder, (name, result) in results.items():
        table = EpochTable.named(spark, root, name, folder=folder, complete=mode == "complete")
        queries[folder] = start_merge(result, table, mode, trigger, folder, send=send)
    # An aggregation has one output, so bad records of its topic take a query of their own.
    for topic in (HASHTAGS_TOPIC, USER_ACTIVITY_TOPIC):
        folder = rejects_folder(root, topic)
        queries[f"rejects_{topic}"] = start(
            rejected(parse(source(topic), topic), topic), reject_sink(folder),
            f"{root.rstrip('/')}/_rejects/{topic}", trigger=raw_trigger, name=f"rejects_{topic}")
    return queries


def start_late(spark: SparkSession, root: str, source: Source,
               trigger: dict | None = None) -> StreamingQuery:
    """The posts that the windowed queries drop, kept as ``late_posts``."""
    table = EpochTable.named(spark, root, "late_posts")
    return start(parse(source(TWEETS_TOPIC), TWEETS_TOPIC), late_sink(table), table.checkpoint,
                 trigger=trigger, name="late_posts")


def start_shared(spark: SparkSession, root: str, source: Source,
                 trigger: dict | None = None) -> StreamingQuery:
    """Raw posts, tag windows and user windows from one query over the post topic."""
    return start(parsed_arrivals(source, TWEETS_TOPIC), shared_sink(spark, root),
                 f"{root.rstrip('/')}/_checkpoint", trigger=trigger, name="shared")


LOADS = {
    TWEETS_TOPIC: ("tweets", "ignore", lambda rows: rows, ARRIVAL),
    HASHTAGS_TOPIC: ("hashtag_counts", "increment", tag_shape, ()),
    USER_ACTIVITY_TOPIC: ("user_activity", "increment", activity_shape, ()),
}


def start_loads(spark: SparkSession, root: str, source: Source,
                trigger: dict | None = None) -> dict[str, StreamingQuery]:
    """Each topic straight into its table, with increments in place of windows."""
    queries = {}
    for topic, (name, policy, shape, order) in LOADS.items():
        table = EpochTable.named(spark, root, name, policy)
        sink = load_sink(table, topic, rejects_folder(root, topic), shape, order)
        queries[name] = start(parsed_arrivals(source, topic), sink, table.checkpoint,
                              trigger=trigger, name=f"load_{name}")
    return queries


def start_fanout(posts: DataFrame, send: Callable[[DataFrame], None], checkpoint: str,
                 trigger: dict | None = None, at: Column | None = None) -> StreamingQuery:
    """A stream of posts out to the three topics; a replayed batch is sent again."""

    def save(batch: DataFrame, epoch: int) -> None:
        batch = batch.persist()
        try:
            send(message_rows(batch, at))
        finally:
            batch.unpersist()

    return start(posts, save, checkpoint, trigger=trigger, name="fanout")


def finish(queries: Iterable[StreamingQuery]) -> None:
    """Wait until bounded queries end; the first failure stops them all."""
    queries = list(queries)
    try:
        for query in queries:
            query.awaitTermination()
    finally:
        stop(queries)


def run_until_stopped(spark: SparkSession, queries: Iterable[StreamingQuery],
                      every: Callable[[], None] = lambda: None, seconds: int = 5) -> None:
    """Wait until any query ends or the user interrupts, then stop all in order.

    ``every`` is called about every ``seconds`` meanwhile, to show progress.
    """
    queries = list(queries)
    try:
        while not spark.streams.awaitAnyTermination(seconds):
            every()
    except KeyboardInterrupt:
        pass
    finally:
        stop(queries)


def stop(queries: Iterable[StreamingQuery]) -> None:
    for query in queries:
        query.stop()
