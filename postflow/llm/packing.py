"""Best-two-fit packing of documents into sequences.

How many bins are needed depends only on how many pieces there are of each length, so the packing
is planned on that histogram (one number per length up to the size of a sequence, whatever the
input) and then carried out by all tasks. The plan fills a bin with the longest pieces that fit,
then replaces its smallest piece by two unpacked ones that fit the expanded gap more tightly; bins
alike are planned at once, as many as the histogram holds.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from postflow.llm.byte_tokens import pieces
from postflow.llm.common import saved

SIZE = 1024


def one_bin(free: np.ndarray, size: int) -> list[int]:
    """Lengths in one bin, longest first, from ``free[length]`` unpacked pieces of each length."""
    left, gap, chosen = free.copy(), size, []
    length = size
    while gap and length:
        length = min(length, gap)
        if left[length]:
            taken = min(int(left[length]), gap // length)
            chosen += [length] * taken
            left[length] -= taken
            gap -= taken * length
        length -= 1
    if gap and chosen:
        smallest, wide = chosen[-1], gap + chosen[-1]
        pair = best_two(left, wide)
        if sum(pair) > smallest:
            chosen = sorted([*chosen[:-1], *pair], reverse=True)
    return chosen


def best_two(free: np.ndarray, gap: int) -> tuple[int, int]:
    """Two unpacked lengths with the greatest sum up to ``gap``; (0, 0) if there are none."""
    sizes = np.arange(min(gap, len(free) - 1) + 1)
    below = np.maximum.accumulate(np.where(free[sizes] > 0, sizes, 0))
    best = (0, 0)
    for first in sizes[free[sizes] > 0][::-1].tolist():
        limit = min(gap - first, first if free[first] > 1 else first - 1)
        second = int(below[limit]) if limit > 0 else 0
        if second and first + second > sum(best):
            best = (first, second)
        if 2 * first <= sum(best):
            break
    return best


def planned(histogram: dict[int, int], size: int = SIZE) -> list[tuple[list[int], int]]:
    """Bins as (lengths, how many bins alike). Every piece is in exactly one bin."""
    free = np.zeros(size + 1, dtype=np.int64)
    for length, count in histogram.items():
        free[length] = count
    plan = []
    while free.any():
        chosen = one_bin(free, size)
        need = Counter(chosen)
        times = min(int(free[length]) // count for length, count in need.items())
        for length, count in need.items():
            free[length] -= times * count
        plan.append((chosen, times))
    return plan


def places(plan: list[tuple[list[int], int]]) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length, in order of rank: first rank, first sequence, pieces per sequence, and
    the place in a sequence of the first of them (those of one length stand side by side)."""
    by_length = defaultdict(list)
    used, sequence = Counter(), 0
    for chosen, times in plan:
        at = 0
        for length, count in Counter(chosen).items():
            by_length[length].append((used[length], sequence, count, at))
            used[length] += times * count
            at += length * count
        sequence += times
    return {length: tuple(np.array(x, dtype=np.int64) for x in zip(*rows))
            for length, rows in by_length.items()}


def ranked(cut: DataFrame) -> DataFrame:
    """The pieces with their rank among those of their length. Ranks are counted within salted
    groups and shifted by the sizes of the groups before, so no length meets in one task."""
    salts = max(64, int(cut.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = cut.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(
        Window.unboundedPreceding, -1)
    shifts = rows.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n")).select(
        "length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    inside = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    return (rows.withColumn("row", F.row_number().over(inside) - 1)
            .join(shifts, ["length", "salt"])
            .withColumn("rank", F.col("row") + F.col("shift")).drop("salt", "row", "shift"))


def placed(cut: DataFrame, plan: list[tuple[list[int], int]]) -> DataFrame:
    """Each ranked piece with its sequence and its offset there."""
    table = places(plan)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rank, length = (batch.column(x).to_numpy() for x in ("rank", "length"))
            sequence, offset = np.zeros((2, len(rank)), dtype=np.int64)
            for one in np.unique(length).tolist():
                first, base, count, at = table[one]
                rows = np.flatnonzero(length == one)
                entry = np.searchsorted(first, rank[rows], side="right") - 1
                bin_, slot = np.divmod(rank[rows] - first[entry], count[entry])
                sequence[rows] = base[entry] + bin_
                offset[rows] = at[entry] + slot * one
            kept = [x for x in batch.schema.names if x != "rank"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(x) for x in kept), pa.array(sequence), pa.array(offset)],
                [*kept, "sequence_id", "offset"])

    kind = cut.schema["doc_id"].dataType.simpleString()
    return cut.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(
        place, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, "
               "sequence_id long, offset long")


def pack(docs: DataFrame, path: str, size: int = SIZE, key: str = "doc_id",
         text: str = "text") -> DataFrame:
    """A row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its ids and an end id; only documents longer than ``size`` are cut, the first
    piece being the short one. A null text counts as empty and is the end id alone; repeated rows
    are packed each; an empty table gives an empty result; a null id is carried like any other.
    Other columns are not read. Texts are encoded once; the pieces, not the ids, are stored.
    """
    cut = saved(pieces(docs, path, size, key, text), "pieces")
    histogram = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}
    return placed(ranked(cut), planned(histogram, size))
