"""Quality by compression: zstandard dictionaries of good and of bad texts.

A text is compressed in blocks with either dictionary. The difference of the two sizes, divided by
the text's length, is calibrated by logistic regression on labelled texts that neither dictionary
holds. A short text tells little, so its difference is drawn towards that of good texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postflow.llm.common import drawn, filled, whole_row

# The model is fitted on a bounded sample: at most so many labelled documents of each class for the
# dictionaries and as many for the calibration, and so many blocks of each, from its whole length.
SAMPLE_DOCS, SAMPLE_BLOCKS = 1500, 8
BLOCK, DICTIONARY_BYTES, LEVEL = 1024, 112_640, 3
# Weight, in bytes, of what is assumed of a text before it is read.
PRIOR_BYTES = 200
THRESHOLD = 0.7
# zstandard cannot train a dictionary on next to nothing.
LEAST_BLOCKS = 20
FOLDS, HELD_OUT = 4, 2


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    usual: float  # difference per byte of good texts
    slope: float
    shift: float
    constant: float | None = None  # the score of every text, if there was nothing to learn from


def as_bytes(text: str | bytes) -> bytes:
    return text.encode() if isinstance(text, str) else text


def blocks(data: bytes) -> list[bytes]:
    return [data[i:i + BLOCK] for i in range(0, len(data), BLOCK)]


def spread(key: Column, text: Column) -> Column:
    """At most ``SAMPLE_BLOCKS`` blocks of a text's bytes, as scoring cuts them, in their order: all
    of them, or as many chosen by hash over the whole text."""
    data = F.encode(text, "utf-8")
    count = F.ceil(F.octet_length(text) / BLOCK).cast("int")
    at = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))
    drawn_at = F.slice(F.array_sort(F.transform(at, lambda n: F.struct(
        F.xxhash64(key, n).alias("draw"), n.alias("at")))), 1, SAMPLE_BLOCKS)
    return F.transform(F.array_sort(F.transform(drawn_at, lambda x: x["at"])),
                       lambda n: F.substring(data, n * BLOCK + 1, F.lit(BLOCK)))


def compressors(model: Model) -> tuple[zstandard.ZstdCompressor, zstandard.ZstdCompressor]:
    made = []
    for data in (model.good, model.bad):
        held = zstandard.ZstdCompressionDict(data)
        held.precompute_compress(level=LEVEL)
        made.append(zstandard.ZstdCompressor(
            level=LEVEL, dict_data=held, write_content_size=False, write_checksum=False,
            write_dict_id=False))
    return made[0], made[1]


def difference(pair, text: str | bytes) -> tuple[int, int]:
    """Compressed size with the good dictionary less that with the bad one, and bytes of text."""
    data, total = as_bytes(text), 0
    for block in blocks(data):
        total += len(pair[0].compress(block)) - len(pair[1].compress(block))
    return total, len(data)


def per_byte(found: list[tuple[int, int]], usual: float) -> np.ndarray:
    sizes = np.array(found, dtype=float).reshape(-1, 2)
    return (sizes[:, 0] + usual * PRIOR_BYTES) / (sizes[:, 1] + PRIOR_BYTES)


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and shift by Newton steps, with a small ridge that keeps separable samples finite."""
    features = np.stack([x, np.ones_like(x)], axis=1)
    found = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(features @ found, -30, 30)))
        curve = (features.T * (weight * p * (1 - p))) @ features + 1e-3 * np.eye(2)
        step = np.linalg.solve(curve, features.T @ (weight * (y - p)) - 1e-3 * found)
        found += step
        if np.abs(step).max() < 1e-9:
            break
    return float(found[0]), float(found[1])


def sample(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> list:
    """Rows (part, quality, bytes of text, number of such labels) of the bounded sample. Chosen by hash among
    the labelled ids outside the held-out fold; ids with contradictory labels are left out. Of several
    rows of one id one is taken, by hash of its text."""
    known = labels.select(F.col("doc_id").alias("id"), "quality").filter(
        (F.crc32(F.col("id").cast("string")) % FOLDS != HELD_OUT)
        & F.col("quality").isin(0, 1)).groupBy("id").agg(
        F.min("quality").alias("quality"), F.max("quality").alias("other")).filter(
        "quality = other").select("id", "quality")
    shares = {r["quality"]: r["count"] for r in known.groupBy("quality").count().collect()}
    chosen = [drawn(known.filter(F.col("quality") == quality), "id", 2 * SAMPLE_DOCS,
                    shares.get(quality, 0)) for quality in (0, 1)]
    # Bounded: at most 4 * SAMPLE_DOCS rows of two numbers.
    ids = F.broadcast(chosen[0].unionByName(chosen[1]))
    # One text per id, however many rows it stands on, so that what is collected is bounded too.
    rows = docs.select(F.col(key).alias("id"), filled(text).alias("body")).join(ids, "id").select(
        "id", "quality", F.xxhash64("body").alias("draw"),
        spread(F.col("id"), F.col("body")).alias("body")).groupBy("id", "quality").agg(
        F.min_by("body", "draw").alias("body")).select(
        F.pmod(F.xxhash64("id", F.lit("part")), F.lit(2)).alias("part"), "quality", "body")
    return sorted((r["part"], r["quality"], b"".join(map(bytes, r["body"])), shares[r["quality"]])
                  for r in rows.collect())


def dealt(rows: list) -> dict[tuple[int, int], list]:
    """The rows by part and label; those of a label that all fell into one part are dealt in turn."""
    split = {}
    for quality in (0, 1):
        parts = [[r for r in rows if r[:2] == (part, quality)] for part in (0, 1)]
        if not all(parts) and len(both := parts[0] + parts[1]) > 1:
            parts = [both[::2], both[1::2]]
        split[0, quality], split[1, quality] = parts
    return split


def dictionary(pieces: dict[int, list[bytes]]) -> dict[int, bytes]:
    """A dictionary by label: trained, or the blocks themselves where there are too few to train on.
    Both are of one kind, as their sizes are compared."""
    if min(len(p) for p in pieces.values()) >= LEAST_BLOCKS:
        try:
            return {q: zstandard.train_dictionary(DICTIONARY_BYTES, p).as_bytes()
                    for q, p in pieces.items()}
        except zstandard.ZstdError:  # too little to learn from
            pass
    most = DICTIONARY_BYTES // BLOCK
    return {q: b"".join(p[::max(1, -(-len(p) // most))]) for q, p in pieces.items()}


def fitted(rows: list) -> Model:
    """A model of (part, quality, text, number of such labels); part 0 makes the dictionaries."""
    split = dealt(rows)
    counts = {r[1]: r[3] for r in rows}
    pieces = {q: [b for r in split[0, q] for b in blocks(as_bytes(r[2]))] for q in (0, 1)}
    if not all(split.values()) or not all(pieces.values()):
        return Model(b"", b"", 0, 0, 0, counts.get(1, 1) / max(1, sum(counts.values()) or 1)
                     if counts else 1.0)
    trained = dictionary(pieces)
    draft = Model(trained[1], trained[0], 0, 0, 0)
    pair = compressors(draft)
    found = {q: [difference(pair, r[2]) for r in split[1, q]] for q in (0, 1)}
    usual = float(sum(d for d, _ in found[1]) / max(1, sum(n for _, n in found[1])))
    x = np.concatenate([per_byte(found[q], usual) for q in (0, 1)])
    y = np.repeat([0.0, 1.0], [len(found[0]), len(found[1])])
    weight = np.where(y == 1, counts[1] / len(found[1]), counts[0] / len(found[0]))
    slope, shift = logistic(x, y, weight * len(y) / weight.sum())
    return Model(trained[1], trained[0], usual, slope, shift)


def trained(docs: DataFrame, labels: DataFrame) -> Model:
    return fitted(sample(docs, labels))


def scores(model: Model, texts: list[str]) -> np.ndarray:
    if model.constant is not None:
        return np.full(len(texts), model.constant)
    pair = compressors(model)
    return scored(model, pair, texts)


def scored(model: Model, pair, texts: list[str]) -> np.ndarray:
    x = per_byte([difference(pair, t) for t in texts], model.usual)
    return 1 / (1 + np.exp(-np.clip(model.slope * x + model.shift, -30, 30)))


def score(model: Model, text: str) -> Column:
    """The score of a text column; a null counts as empty."""
    @F.pandas_udf("double")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        pair = None if model.constant is not None else compressors(model)
        for texts in batches:
            yield pd.Series(scores(model, list(texts)) if pair is None
                            else scored(model, pair, list(texts)))

    return of(filled(text))


def quality_scores(docs: DataFrame, model: Model, key: str = "doc_id",
                   text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted.

    Whole texts are scored, in blocks. An empty or null text gets the score that the calibration
    gives to a text of which nothing is known; repeated rows are scored alike; an empty table gives
    an empty result; a null id is in no fold. With few blocks of a class the sampled texts
    themselves are the dictionaries. With fewer than two sampled texts of a class, or only empty ones
    for its dictionary, every score is the share of label 1 among the labels, or 1 without any.
    Other columns are not read.
    """
    rows = docs.select(F.col(key).alias("doc_id"), score(model, text).alias("score"))
    fold = F.crc32(F.col("doc_id").cast("string")) % FOLDS
    return rows.select("doc_id", F.coalesce(fold == HELD_OUT, F.lit(False)).alias("held_out"),
                       "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are predicted good, with all their columns."""
    rows = docs.select(whole_row(docs), score(model, text).alias("score"))
    return rows.filter(F.col("score") >= THRESHOLD).select("whole_row.*")
