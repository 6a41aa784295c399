"""Exact duplicates by skew-safe combining.

Rows with equal content are combined three times, and each time the whole normalised text is part
of the grouping key, so that a digest alone never makes two texts equal: within a task (Spark's
map-side combination), within a salted digest group, and over the salts of a digest. A group with
a third of all rows therefore reaches the first shuffle as one row per task and salt, and the
second one as one row per salt.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from postflow.llm.common import WHITE, filled, named, whole_row

SALTS = 8


def digested(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Each row's id, length and content, with the digests that name the content."""
    rows = docs.select(
        F.col(key).alias("doc_id"), F.char_length(filled(text)).cast("long").alias("points"),
        F.regexp_replace(filled(text), WHITE, "").alias("content"))
    return rows.select("doc_id", "points", "content",
                       F.sha2("content", 256).alias("text_sha256"),
                       F.xxhash64("content").alias("second"))


def content_groups(rows: DataFrame, salts: int = SALTS) -> DataFrame:
    """A row for each distinct content: its digests, its number of rows and the row that stays."""
    content = ["text_sha256", "second", "content"]
    salted = (rows
              .withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(salts)))
              .groupBy(*content, "points", "salt")
              .agg(F.count(F.lit(1)).alias("rows"), F.min("doc_id").alias("first_id")))
    # One exchange by digest serves both steps below.
    winners = (salted.repartition("text_sha256")
               .groupBy(*content, "points")
               .agg(F.sum("rows").alias("rows"), F.min("first_id").alias("first_id"))
               .groupBy(*content)
               .agg(F.sum("rows").alias("group_size"),
                    F.max_by("first_id", "points").alias("keep_id")))
    return winners.select("text_sha256", "second", "group_size", "keep_id")


def exact_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text",
                     salts: int = SALTS) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal if they are identical without white space ``[\\x20\\x09-\\x0D]``. The longest
    original (code points) stays, then the smallest id. A null text counts as empty, and all empty
    texts are one group; an empty table gives an empty result. Rows that repeat both id and
    content are one document on several rows: each is reported with the same decision. A null id
    stays only if no other row of the group, of the same length, has an id. Other columns of
    ``docs`` are not read.
    """
    rows = digested(docs, key, text)
    # A decision for many rows is told by several tasks, as a third of all rows may ask for it.
    one = F.pmod(F.xxhash64("keep_id"), F.lit(salts)).cast("int")
    groups = content_groups(rows, salts).withColumn("salt", F.explode(
        F.when(F.col("group_size") == 1, F.array(one))
        .otherwise(F.sequence(F.lit(0), F.lit(salts - 1)))))
    asked = rows.select("doc_id", "text_sha256", "second",
                        F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int").alias("salt"))
    return asked.join(groups, ["text_sha256", "second", "salt"]).select(
        "doc_id", "keep_id", "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def without_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; of a repeated row one stays."""
    decided = exact_duplicates(docs, key, text).filter("kept").select(
        named("doc_id").alias("name"), F.col("text_sha256").alias("sha")).distinct()
    rows = docs.select(
        whole_row(docs), named(key).alias("name"), F.char_length(filled(text)).alias("points"),
        F.sha2(F.regexp_replace(filled(text), WHITE, ""), 256).alias("sha"))
    chosen = rows.join(decided, ["name", "sha"], "left_semi")
    order = Window.partitionBy("name", "sha").orderBy(F.desc("points"))
    return (chosen.withColumn("row", F.row_number().over(order)).filter("row = 1")
            .select("whole_row.*"))


QUERY_SQL = r"""
WITH rows AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER best AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = first_value(doc_id) OVER best AS kept,
       text_sha256
FROM rows
WINDOW best AS (PARTITION BY text_sha256 ORDER BY points DESC, doc_id)
"""
