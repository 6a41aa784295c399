"""Matching by substring, and comparing two tables row by row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def substrings(text: str, least: int = 0, most: int | None = None) -> Column:
    """Every distinct substring of a short text with ``least`` to ``most`` characters."""
    length = F.char_length(text)
    longest = length if most is None else F.least(length, F.lit(most))
    sizes = F.when(longest >= max(least, 1), F.sequence(F.lit(max(least, 1)), longest))
    parts = F.flatten(F.transform(
        F.coalesce(sizes, F.array().cast("array<int>")),
        lambda size: F.transform(
            F.sequence(F.lit(1), length - size + F.lit(1)),
            lambda start: F.substring(F.col(text), start, size))))
    empty = F.array(F.lit("")) if least == 0 else F.array().cast("array<string>")
    return F.array_distinct(F.concat(empty, parts))


def contains_join(outer: DataFrame, inner: DataFrame, part: str, whole: str) -> DataFrame:
    """Pairs where ``inner.whole`` contains ``outer.part``.

    A text contains a part exactly when the part is among its substrings, so
    the test becomes an equality and the join a sort-merge join;
    only true pairs come out. Meant for identifiers: a text of n characters
    gives at most n(n+1)/2 + 1 substrings. Only those as long as some part are
    made (two numbers of the parts are read for that), as short ones are common
    to all texts and match nothing. Their number is not in Spark's size estimate,
    so the spread side must not be broadcast on its strength.
    """
    length = F.char_length(part)
    least, most = outer.agg(F.min(length), F.max(length)).first()
    # Without any part there is nothing to find: no substring is as long as this.
    bounds = (least, most) if least is not None else (1, 0)
    spread = inner.withColumn("_part", F.explode(substrings(whole, *bounds))).hint("merge")
    return outer.join(spread, outer[part] == spread["_part"]).drop("_part")


def row_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows that one side has more often, with ``extra``: above 0 on the left, below on the right.

    One aggregation over both sides, where two ``exceptAll`` would take two.
    """
    names = left.columns
    both = left.withColumn("_side", F.lit(1)).unionByName(right.withColumn("_side", F.lit(-1)))
    return both.groupBy(*names).agg(F.sum("_side").alias("extra")).filter("extra <> 0")


def parity(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: the size of both tables and how many rows only one of them has."""
    names = left.columns
    both = left.withColumn("_side", F.lit(1)).unionByName(right.withColumn("_side", F.lit(-1)))
    rows = both.groupBy(*names).agg(
        F.sum("_side").alias("extra"), F.sum(F.when(F.col("_side") == 1, 1)).alias("n_left"),
        F.sum(F.when(F.col("_side") == -1, 1)).alias("n_right"))
    return rows.agg(
        F.coalesce(F.sum("n_left"), F.lit(0)).alias("left_rows"),
        F.coalesce(F.sum("n_right"), F.lit(0)).alias("right_rows"),
        F.coalesce(F.sum(F.greatest("extra", F.lit(0))), F.lit(0)).alias("only_left"),
        F.coalesce(F.sum(F.greatest(-F.col("extra"), F.lit(0))), F.lit(0)).alias("only_right"))
