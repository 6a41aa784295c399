"""Run metrics: timing batch queries, logging streaming progress, comparing the two."""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from postflow.functions.text import two_digits
from postflow.operators.compare import contains_join
from postflow.schemas import TABLES, WINDOW

METRICS = TABLES["performance_metrics"]
KEYED = TABLES["stream_metrics"]
# Name of the counts that a job observes in its batches.
ARRIVALS = "arrivals"


def metric_row(query_id: str, mode: str, millis: float, window: str, records: int,
               at: datetime | None = None) -> tuple:
    at = at or datetime.now(timezone.utc)
    return (query_id, mode, float(millis), window, int(records), at.replace(microsecond=0))


def append_metrics(spark: SparkSession, rows: list[tuple], path: str) -> None:
    """Log rows of runs; a run gives one row, so the list is small."""
    if rows:
        spark.createDataFrame(rows, METRICS).coalesce(1).write.mode("append").parquet(path)


def discard(frame: DataFrame) -> None:
    """Run a query whole and keep nothing."""
    frame.write.format("noop").mode("overwrite").save()


def timed(query_id: str, frame: DataFrame,
          action: Callable[[DataFrame], None] = discard) -> tuple:
    """Run ``action`` on a query; its metrics row, with the records counted on the way."""
    seen = Observation()
    watched = frame.observe(seen, F.count(F.lit(1)).alias("records"))
    start = time.perf_counter()
    action(watched)
    millis = (time.perf_counter() - start) * 1000
    return metric_row(query_id, "batch", millis, "all", seen.get["records"])


def run_reports(spark: SparkSession, reports: dict[str, DataFrame], path: str | None = None,
                action: Callable[[DataFrame], None] = discard) -> list[tuple]:
    """Time each report in order and log the rows under ``path``."""
    rows = [timed(name, report, action) for name, report in reports.items()]
    if path is not None:
        append_metrics(spark, rows, path)
    return rows


class ProgressLog(StreamingQueryListener):
    """Keeps a metrics row per micro-batch, and by query name how many rows came in and how many
    of them came too late for their windows (an aggregate's rows, after map-side combination)."""

    def __init__(self, window: str = WINDOW) -> None:
        self.window = window
        self.counts: Counter[str] = Counter()
        self.late: Counter[str] = Counter()
        self._rows: list[tuple] = []
        self._keyed: dict[tuple[str, int], tuple] = {}
        self._seen: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        name = progress.name or str(progress.id)
        late = sum(x.numRowsDroppedByWatermark for x in progress.stateOperators)
        self.late[name] += late
        if progress.numInputRows == 0:
            return
        self.counts[name] += progress.numInputRows
        row = metric_row(
            f"spark_streaming_{name}", "streaming", progress.durationMs["triggerExecution"],
            self.window, progress.numInputRows)
        self._rows.append(row)
        key = str(progress.runId), progress.batchId
        self._seen[key[0]] = key[1]
        seen = progress.observedMetrics.get(ARRIVALS)
        counts = (seen["accepted"], seen["rejected"]) if seen else (None, None)
        self._keyed[key] = (*key, *row[:-1], *counts, late, row[-1])

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def drain(self) -> list[tuple]:
        """The rows since the last call, to be written with ``append_metrics``."""
        rows, self._rows = self._rows, []
        return rows

    def drain_keyed(self) -> list[tuple]:
        """Rows for ``stream_metrics`` since the last call, one per run and batch."""
        rows, self._keyed = list(self._keyed.values()), {}
        return rows

    def settle(self, queries, seconds: float = 20) -> bool:
        """Wait until the events of ended queries are here, as Spark delivers them on a thread of
        its own; whether all came in time."""
        wanted = {}
        for query in queries:
            batches = [p["batchId"] for p in query.recentProgress if p["numInputRows"]]
            if batches:
                wanted[str(query.runId)] = max(batches)
        until = time.monotonic() + seconds
        while True:
            if all(self._seen.get(run, -1) >= batch for run, batch in wanted.items()):
                return True
            if time.monotonic() > until:
                return False
            time.sleep(0.05)

    def line(self) -> str:
        parts = [f"{n} {name}" for name, n in sorted(self.counts.items())]
        parts += [f"{n} late in {name}" for name, n in sorted(self.late.items()) if n]
        return "Progress: " + ", ".join(parts)


def total_time(metrics: DataFrame) -> DataFrame:
    """Time of all runs together."""
    return metrics.agg(F.sum("execution_time").alias("total_time"))


def summary(metrics: DataFrame) -> DataFrame:
    """Mean time and runs by (query, mode)."""
    return metrics.groupBy("query_id", "execution_mode").agg(
        F.avg("execution_time").alias("avg_time"), F.count(F.lit(1)).alias("executions"))


def sorted_summary(metrics: DataFrame) -> DataFrame:
    return summary(metrics).orderBy("query_id", "execution_mode")


def _sides(metrics: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Mean times of the batch and of the streaming runs of each query id, from one aggregation
    that both sides share; of several modes on a side the last in sort order counts."""
    streaming = F.col("execution_mode").startswith("streaming")

    def last(test: Column, name: str) -> Column:
        return F.max_by(F.when(test, F.col("avg_time")),
                        F.when(test, F.col("execution_mode"))).alias(name)

    both = summary(metrics).groupBy("query_id").agg(
        last(~streaming, "batch_avg"), last(streaming, "stream_avg"))
    return tuple(both.filter(F.col(f"{name}_avg").isNotNull()).select(
        F.col("query_id").alias(f"{name}_id"), f"{name}_avg") for name in ("batch", "stream"))


def _verdict(pairs: DataFrame) -> DataFrame:
    stream, batch = F.col("stream_avg"), F.col("batch_avg")
    return (pairs.filter((batch > 0) & (stream > 0))
            .withColumn("difference", F.abs(stream - batch))
            .withColumn("faster", F.when(stream < batch, "Streaming").otherwise("Batch"))
            .withColumn("factor", F.greatest(stream, batch) / F.least(stream, batch)))


def compare(metrics: DataFrame) -> DataFrame:
    """Batch runs against streaming runs whose id contains the batch query's type."""
    batch, stream = _sides(metrics)
    batch = batch.withColumn("query_type", F.replace("batch_id", F.lit("batch_"), F.lit("")))
    pairs = contains_join(batch, stream, "query_type", "stream_id")
    return _verdict(pairs).select("query_type", "stream_id", "stream_avg", "batch_avg",
                                  "difference", "faster", "factor")


def query_family(query_id: str):
    """What a run works on, so that differently named runs can meet."""
    name = F.col(query_id)
    return (F.when(name.contains("hashtag"), "hashtags")
            .when(name.contains("user") | name.contains("likes"), "users")
            .when(name.contains("tweets"), "tweets"))


def compare_families(metrics: DataFrame) -> DataFrame:
    """As ``compare``, with runs matched by what they work on and not by their names."""
    batch, stream = _sides(metrics)
    batch = batch.withColumn("query_family", query_family("batch_id"))
    stream = stream.withColumn("query_family", query_family("stream_id"))
    return _verdict(batch.join(stream, "query_family")).select(
        "query_family", "batch_id", "stream_id", "stream_avg", "batch_avg",
        "difference", "faster", "factor")


def _padded(text: Column, width: int) -> Column:
    """A text filled up to a width, never cut."""
    return F.rpad(text, F.greatest(F.lit(width), F.char_length(text)), F.lit(" "))


def comparison_lines(compared: DataFrame) -> DataFrame:
    """Fixed-width lines of the comparison table; longer numbers widen theirs."""
    return compared.select(F.concat(
        _padded(F.col("query_type"), 25), F.lit(" "),
        _padded(two_digits("stream_avg"), 20), F.lit(" "),
        _padded(two_digits("batch_avg"), 20), F.lit(" "),
        _padded(two_digits("difference"), 15), F.lit(" "),
        F.format_string("%s is %.2fx faster", "faster", "factor")).alias("line"))
