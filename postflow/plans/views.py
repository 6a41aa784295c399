"""Stored tables under their names, for SQL text."""

from __future__ import annotations

from pyspark.sql import SparkSession

from postflow.schemas import MERGES, TABLES
from postflow.session import path_exists
from postflow.sources.tables import read_table
from postflow.streaming.table import EpochTable


def stored_tables(spark: SparkSession, root: str) -> dict[str, EpochTable]:
    """What lies under ``root``, the tables of the hashtag and activity topics included."""
    folders = {folder: name for name in MERGES for folder in (name, f"{name}_direct")}
    return {folder: EpochTable.stored(spark, root, name, folder)
            for folder, name in folders.items()
            if path_exists(spark, f"{root.rstrip('/')}/{folder}")}


def register_views(spark: SparkSession, root: str, prefix: str = "") -> dict[str, str]:
    """Temporary views of what is stored under ``root``; view names by table name.

    A view shows the epochs that were finished when it was made.
    """
    root = root.rstrip("/")
    frames = {name: table.current() for name, table in stored_tables(spark, root).items()}
    for name in sorted(set(TABLES) - set(MERGES)):
        if path_exists(spark, f"{root}/{name}"):
            frames[name] = read_table(spark, name, "parquet", path=f"{root}/{name}")
    for name, frame in frames.items():
        frame.createOrReplaceTempView(prefix + name)
    return {name: prefix + name for name in frames}
