"""Command line: ``python -m postflow <command> ...``, the commands being those of ``COMMANDS``."""

from __future__ import annotations

import argparse
import time

from pyspark.sql import DataFrame, SparkSession

from postflow.operators.posts import message_rows
from postflow.plans import catalog as published
from postflow.plans import metrics, reports
from postflow.plans.results import results_parity, store_results
from postflow.plans.views import register_views, stored_tables
from postflow.session import build_session, separate
from postflow.sources.messages import split_rows, topic_stream
from postflow.sources.posts import csv_posts
from postflow.sources.tables import read_table
from postflow.streaming import jobs
from postflow.streaming.table import EpochTable

LOG_SECONDS = 60


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="postflow", description=__doc__)
    top.add_argument("command",
                     choices=("produce", "stream", "load", "report", "compare", "results", "sql",
                              "compact", "catalog"))
    top.add_argument("--root", help="folder of the stored tables and of rejects")
    top.add_argument("--brokers", help="Kafka bootstrap servers")
    top.add_argument("--topics", help="folder of topic files, in place of Kafka")
    top.add_argument("--csv", help="post file or folder (produce)")
    top.add_argument("--record-sep", help="separator of CSV records, to split large files")
    top.add_argument("--limit", type=int, help="records to send (produce)")
    top.add_argument("--mode", choices=("shared", "update", "complete"), default="shared",
                     help="stream: one query that reads posts once and holds no state (shared), "
                     "windows behind a watermark (update), or all windows each time, for parity "
                     "with batches only (complete)")
    top.add_argument("--republish", action="store_true",
                     help="send changed windows on as messages (stream; not with shared)")
    top.add_argument("--rate", type=int, help="offsets or files per micro-batch")
    top.add_argument("--once", action="store_true", help="stop at the end of the present data")
    top.add_argument("--query", help="SQL text over the stored tables (sql)")
    top.add_argument("--out", help="folder for the result, as Parquet (sql, compare)")
    top.add_argument("--expire", action="store_true", help="delete what is folded (compact)")
    top.add_argument("--database", help="database of the catalog that shows the stored tables "
                     "(catalog; stream, load and compact keep it fresh)")
    top.add_argument("--master", help="Spark master, if not set elsewhere")
    return top


def source_of(spark: SparkSession, args) -> jobs.Source:
    if args.topics:
        limit = {"maxFilesPerTrigger": str(args.rate)} if args.rate else {}
        return lambda topic: topic_stream(spark, topic, "parquet", args.topics, **limit)
    options = {"kafka.bootstrap.servers": args.brokers}
    if args.rate:
        options["maxOffsetsPerTrigger"] = str(args.rate)
    return lambda topic: topic_stream(spark, topic, **options)


def produce(spark: SparkSession, args) -> None:
    separator = args.record_sep and args.record_sep.encode().decode("unicode_escape")
    # Read and cut to the limit once, so that all topics tell of the same records.
    records = csv_posts(spark, args.csv, separator, limit=args.limit).persist()
    posts, cut = split_rows(records)
    sender(args)(message_rows(posts))
    if args.root:
        cut.write.mode("append").parquet(jobs.rejects_folder(args.root, "csv"))
    records.unpersist()


def sender(args):
    """Messages to Kafka, or to the folder of topic files."""
    if not args.topics:
        return jobs.message_writer(**{"kafka.bootstrap.servers": args.brokers})
    write = jobs.message_writer("parquet", path=args.topics)
    return lambda messages: write(
        messages.withColumn("value", messages["value"].cast("binary")))


def watch(spark: SparkSession, args, start) -> None:
    """Run queries until stopped, showing their progress and logging it once a minute by run and
    batch; the log of all runs gets the rows of this one when it ends."""
    progress = metrics.ProgressLog()
    spark.streams.addListener(progress)
    logged = time.monotonic()
    keyed = EpochTable.named(spark, args.root, "stream_metrics")

    def flush() -> None:
        """New rows of runs and batches; a log of many flushes is folded on the way."""
        rows = progress.drain_keyed()
        if rows:
            epoch = keyed.next_epoch()
            keyed.write(spark.createDataFrame(rows, metrics.KEYED).coalesce(1), epoch)
            keyed.upkeep(epoch)

    def every() -> None:
        nonlocal logged
        print(progress.line())
        if time.monotonic() - logged >= LOG_SECONDS:
            flush()
            publish(spark, args)
            logged = time.monotonic()

    queries = []
    try:
        queries = list(start().values())
        if args.once:
            jobs.finish(queries)
        else:
            jobs.run_until_stopped(spark, queries, every)
    finally:
        # Also of a run that failed: what its batches did before is in the tables.
        progress.settle(queries)
        print(progress.line())
        flush()
        metrics.append_metrics(spark, progress.drain(), f"{args.root}/performance_metrics")
        spark.streams.removeListener(progress)
    if args.database:  # the queries have ended, so all they stored can be folded and shown
        compact(spark, args)


def publish(spark: SparkSession, args) -> None:
    """What is folded by now, into the catalog, if a database is named."""
    if args.database:
        published.publish_all(spark, args.root, args.database)


def stream(spark: SparkSession, args) -> None:
    now = {"availableNow": True} if args.once else None
    source = source_of(spark, args)
    if args.mode == "shared":
        if args.republish:
            raise SystemExit("--republish needs windows that are whole: --mode update")
        watch(spark, args, lambda: {"shared": jobs.start_shared(spark, args.root, source, now)})
    else:
        send = sender(args) if args.republish else None
        watch(spark, args, lambda: jobs.start_analysis(
            spark, args.root, source, args.mode, now, now, send))


def load(spark: SparkSession, args) -> None:
    now = {"availableNow": True} if args.once else None
    watch(spark, args, lambda: jobs.start_loads(spark, args.root, source_of(spark, args), now))


def report(spark: SparkSession, args) -> None:
    """Each report is run and timed once; its ten rows are kept for printing."""
    counts, activity = [EpochTable.stored(spark, args.root, name).current()
                        for name in ("hashtag_counts", "user_activity")]
    runs = []
    for name, frame in reports.batch_reports(counts, activity).items():
        kept = []
        runs.append(metrics.timed(name, frame, lambda rows, kept=kept: kept.extend(rows.collect())))
        lines = reports.REPORT_LINES[name](spark.createDataFrame(kept, frame.schema))
        print(f"{name} ({runs[-1][2]:.2f} ms)")
        for row in lines.collect():
            print(f"  {row['line']}")
    metrics.append_metrics(spark, runs, f"{args.root}/performance_metrics")
    print(f"Total: {sum(run[2] for run in runs):.2f} ms")


def compare(spark: SparkSession, args) -> None:
    log = read_table(spark, "performance_metrics", "parquet",
                     path=f"{args.root}/performance_metrics")
    by_name = metrics.compare(log)
    for name, frame in (("summary", metrics.sorted_summary(log)),
                        ("by_name", metrics.comparison_lines(by_name)),
                        ("by_family", metrics.compare_families(log))):
        give(frame, args.out and f"{args.out.rstrip('/')}/{name}")


def give(frame: DataFrame, folder: str | None) -> None:
    """A whole result: to a folder, written by all tasks, or row by row to the console."""
    if folder:
        frame.write.mode("error").parquet(folder)
        return
    print("|" + "|".join(frame.columns) + "|")
    for row in frame.toLocalIterator(prefetchPartitions=True):
        print("|" + "|".join("NULL" if value is None else str(value) for value in row) + "|")


def results(spark: SparkSession, args) -> None:
    """Store batch and streaming results side by side and tell how they differ."""
    store_results(spark, args.root)
    for name, frame in results_parity(spark, args.root).items():
        print(name)
        give(frame, args.out and f"{args.out.rstrip('/')}/{name}")


def sql(spark: SparkSession, args) -> None:
    """In a session of its own, so that its views hide no table of the catalog."""
    own = separate(spark)
    register_views(own, args.root)
    give(own.sql(args.query), args.out)


def compact(spark: SparkSession, args) -> None:
    tables = stored_tables(spark, args.root).values()
    for table in tables:
        table.compact()
    publish(spark, args)  # before the files that the catalog pointed to are deleted
    if args.expire:
        for table in tables:
            table.expire()


def catalog(spark: SparkSession, args) -> None:
    """Show all that is stored in the catalog, folded first."""
    if not args.database:
        raise SystemExit("catalog needs --database")
    compact(spark, args)


COMMANDS = {"produce": produce, "stream": stream, "load": load, "report": report,
            "compare": compare, "results": results, "sql": sql, "compact": compact, "catalog": catalog}


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    COMMANDS[args.command](build_session(master=args.master), args)


if __name__ == "__main__":
    main()
