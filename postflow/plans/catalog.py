"""Stored tables in the catalog, for every session that shares it.

A keyed table becomes an external table whose partitions are the parts of the stored one, each at
the place where the newest folding has it; the part (``day`` or ``key_range``) is its last column,
so a filter on it reads no other part. What came in since the folding is not shown. Publishing
again touches only parts that moved since, and each part moves at once: as parts share no key, a
reader never sees a key twice.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from postflow.plans.views import stored_tables
from postflow.schemas import MERGES, TABLES
from postflow.session import path_exists
from postflow.streaming.table import DAY, EpochTable

# Properties of a published table: the data it shows, and the folding that its partitions are of.
SOURCE, FOLDING = "postflow.source", "postflow.folding"
# Partitions named in one statement.
BATCH = 500


def quoted(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def table_name(database: str, name: str) -> str:
    return f"`{database}`.`{name}`"


def properties(spark: SparkSession, name: str) -> dict[str, str] | None:
    """Of a table of the catalog; None if there is none of that name."""
    if not spark.catalog.tableExists(name):
        return None
    return {row["key"]: row["value"] for row in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}


def claim(spark: SparkSession, name: str, source: str, columns: str, rest: str) -> dict[str, str]:
    """The properties of a published table, which is declared if it is not there. A table that
    shows something else is left alone."""
    known = properties(spark, name)
    if known is None:
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet {rest} "
                  f"TBLPROPERTIES ({quoted(SOURCE)} = {quoted(source)})")
        return {SOURCE: source}
    if known.get(SOURCE) != source:
        raise ValueError(f"{name} is another table than that of {source}")
    return known


def columns_of(table: str) -> str:
    return ", ".join(f"`{field.name}` {field.dataType.simpleString()}"
                     for field in TABLES[table].fields)


def publish(table: EpochTable, name: str) -> None:
    """Show the newest folding of a stored table as ``name``; one without any is empty."""
    spark, part = table.spark, table.part
    base, now = table.folded()
    columns = ", ".join(f"`{field.name}` {field.dataType.simpleString()}"
                        for field in table.schema.fields)
    place = f"{table.data}/base/epoch={base}"
    if part is None:
        known = claim(spark, name, table.data, columns, f"LOCATION {quoted(place)}")
    else:
        kind = "date" if part == DAY else "bigint"
        known = claim(spark, name, table.data, f"{columns}, `{part}` {kind}",
                      f"PARTITIONED BY (`{part}`) LOCATION {quoted(table.data + '/published')}")
    shown = int(known.get(FOLDING, -1))
    if base == shown:
        return
    if part is None:
        spark.sql(f"ALTER TABLE {name} SET LOCATION {quoted(place)}")
    else:
        move_parts(spark, name, part, table.folded_as_of(shown), now)
    # Last, so that a publishing that ended half-way is done again.
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({quoted(FOLDING)} = '{base}')")


def move_parts(spark: SparkSession, name: str, part: str, before: dict[str, str],
               now: dict[str, str]) -> None:
    """Partitions of a table to where its parts lie now, given where they lay before as far as
    that is known."""
    held = {row["partition"].split("=", 1)[1]
            for row in spark.sql(f"SHOW PARTITIONS {name}").collect()}

    def spec(value: str) -> str:
        return f"PARTITION (`{part}` = {quoted(value)})"

    for value in sorted(held & now.keys()):
        if before.get(value) != now[value]:
            spark.sql(f"ALTER TABLE {name} {spec(value)} SET LOCATION {quoted(now[value])}")
    added, gone = sorted(now.keys() - held), sorted(held - now.keys())
    for at in range(0, len(added), BATCH):
        listed = " ".join(f"{spec(x)} LOCATION {quoted(now[x])}" for x in added[at:at + BATCH])
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {listed}")
    for at in range(0, len(gone), BATCH):
        listed = ", ".join(spec(x) for x in gone[at:at + BATCH])
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {listed}")


def publish_all(spark: SparkSession, root: str, database: str) -> list[str]:
    """All that lies under ``root``, in a database that is made if it is not there; the names."""
    root = root.rstrip("/")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    names = []
    for folder, table in stored_tables(spark, root).items():
        names.append(table_name(database, folder))
        publish(table, names[-1])
    for plain in sorted(set(TABLES) - set(MERGES)):
        path = f"{root}/{plain}"
        if path_exists(spark, path):
            names.append(table_name(database, plain))
            claim(spark, names[-1], path, columns_of(plain), f"LOCATION {quoted(path)}")
            spark.catalog.refreshTable(names[-1])
    return names
