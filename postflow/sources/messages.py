"""Message topics as batch or streaming DataFrames, and their JSON payloads as columns."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postflow.functions.text import event_time
from postflow.schemas import LATENESS, MESSAGES, REQUIRED, TRANSPORT


def topic_stream(spark: SparkSession, topic: str, fmt: str = "kafka", path: str | None = None,
                 **options: str) -> DataFrame:
    """A topic as a stream of transport rows.

    ``kafka`` subscribes from the earliest offset; the checkpoint keeps the
    position after that. Any other format reads transport rows from files under
    ``path/topic=<topic>``. The rate is limited by ``maxOffsetsPerTrigger`` or
    ``maxFilesPerTrigger`` among the options.
    """
    if fmt == "kafka":
        return (spark.readStream.format("kafka")
                .options(subscribe=topic, startingOffsets="earliest").options(**options).load())
    return (spark.readStream.format(fmt).schema(TRANSPORT).options(**options)
            .load(f"{path}/topic={topic}"))


def topic_batch(spark: SparkSession, topic: str, fmt: str = "kafka", path: str | None = None,
                **options: str) -> DataFrame:
    """The same rows as one bounded table."""
    if fmt == "kafka":
        return (spark.read.format("kafka")
                .options(subscribe=topic, startingOffsets="earliest", endingOffsets="latest")
                .options(**options).load())
    return (spark.read.format(fmt).schema(TRANSPORT).options(**options)
            .load(f"{path}/topic={topic}"))


def _complete(columns) -> Column:
    return reduce(and_, [F.col(name).isNotNull() for name in columns])


def parse(rows: DataFrame, topic: str) -> DataFrame:
    """Payload fields as flat columns, and ``raw``, the text of a row that lacks a required field.

    Where the rows have a partition and an offset, these stay, as they tell the
    order of arrival.

    Text that is not JSON, or a field of the wrong type, gives nulls;
    ``accepted`` and ``rejected`` then part the rows. The struct is opened with
    ``inline``: a filter does not move below it, where each tested field would
    parse the text once more.
    """
    payload = F.from_json("raw", MESSAGES[topic])
    place = [name for name in ("partition", "offset") if name in rows.columns]
    return (rows.select(*place, F.col("value").cast("string").alias("raw"))
            .select(*place, "raw", F.inline(F.array(payload)))
            .withColumn("timestamp", event_time("timestamp"))
            .withColumn("raw", F.when(~_complete(REQUIRED[topic]), F.col("raw"))))


def arrivals(parsed: DataFrame, topic: str, name: str) -> DataFrame:
    """The rows, with accepted and rejected ones counted on the way, under ``name`` in a stream's
    progress."""
    good = _complete(REQUIRED[topic])
    return parsed.observe(name, F.count_if(good).alias("accepted"),
                          F.count_if(~good).alias("rejected"))


def once(messages: DataFrame, within: str = LATENESS) -> DataFrame:
    """A stream of window messages, each once however often it was sent.

    A batch that runs again sends its messages again, with the same ids as keys. Ids are kept until
    the watermark, by the time in the message, is ``within`` past them.
    """
    field = F.get_json_object(F.col("value").cast("string"), "$.timestamp")
    return (messages.withColumn("sent_for", event_time(field))
            .withWatermark("sent_for", within).dropDuplicatesWithinWatermark(["key"])
            .drop("sent_for"))


def accepted(parsed: DataFrame, topic: str) -> DataFrame:
    """Rows with every required field."""
    return parsed.filter(_complete(REQUIRED[topic])).drop("raw")


def rejected(parsed: DataFrame, topic: str) -> DataFrame:
    """Rows that lack a required field, with the text they came from."""
    needed = REQUIRED[topic]
    missing = F.array_compact(F.array(
        *[F.when(F.col(name).isNull(), F.lit(name)) for name in needed]))
    return parsed.filter(~_complete(needed)).select(
        F.lit(topic).alias("topic"), "raw", missing.alias("missing"))


def split_rows(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Complete rows, and rows with a null in any column (a cut CSV record)."""
    test = _complete(rows.columns)
    return rows.filter(test), rows.filter(~test)
