"""State of streaming queries, read back from their checkpoints as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def state_operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The stateful operators of a query, and the batches that their state is kept of."""
    return spark.read.format("state-metadata").load(checkpoint).select(
        "operatorId", "operatorName", "stateStoreName", "numPartitions", "minBatchId",
        "maxBatchId")


def state_rows(spark: SparkSession, checkpoint: str, operator: int = 0) -> DataFrame:
    """Keys and values of one operator, as its last finished batch left them."""
    return spark.read.format("statestore").option("operatorId", operator).load(checkpoint)


def held_windows(spark: SparkSession, checkpoint: str, operator: int = 0) -> DataFrame:
    """The windows that an aggregate still holds behind its watermark: window_end, and how many
    keys each has."""
    rows = state_rows(spark, checkpoint, operator)
    window = next(f.name for f in rows.schema["key"].dataType
                  if f.dataType.typeName() == "struct")
    return rows.groupBy(F.col(f"key.`{window}`.end").alias("window_end")).agg(
        F.count(F.lit(1)).alias("n_keys"))
