"""SimHash near-duplicates by pigeonring filtering.

Fingerprints are split into segments on a ring. If two differ in at most ``bits`` bits, there is a
segment from which every chain of consecutive segments stays within its share of the bits: 0 of 3
in one segment, 1 in two, 2 in three. So for each segment as start, a fingerprint is stored under
the first two segments and looked up under these and all their variants with one bit changed in the
second: 32 bits that must meet. The chain of three is checked next, the whole distance last. Equal
fingerprints are one node, so copies never form pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from postflow.llm.batches import slices, texts_of
from postflow.llm.common import named, saved, whole_row

SHINGLE, MOST_BITS = 3, 3
SEGMENTS, WIDTH = 4, 16
HASH_SEED = 42


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """64 bits, as a signed number: each is 1 if set in over half of the shingles' hashes."""
    words = text.encode().lower().split()  # both know only ASCII here
    if not words:
        return 0
    if len(words) <= shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    hashes = np.array(list(map(xxhash.xxh64_intdigest, grams, repeat(HASH_SEED))), dtype="<u8")
    set_ = np.zeros(64, dtype=np.int64)
    for begin in range(0, len(hashes), 4096):
        part = hashes[begin:begin + 4096].view(np.uint8).reshape(-1, 8)
        set_ += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_ > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text",
                 shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fp and text_hash of each row."""
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                found = [fingerprint(x, shingle) for x in texts_of(batch, "text")]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(found, pa.int64()),
                     batch.column("text_hash")], ["doc_id", "fp", "text_hash"])

    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"),
                       F.xxhash64(text).alias("text_hash"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(hashed, f"doc_id {kind}, fp long, text_hash long")


def budgets(bits: int = MOST_BITS) -> list[int]:
    """Differing bits that a chain of 1, 2, ... segments may hold."""
    return [length * bits // SEGMENTS for length in range(1, SEGMENTS + 1)]


def turned(fp: Column, start: int) -> Column:
    """The ring of segments, turned so that segment ``start`` holds the lowest bits."""
    if not start:
        return fp
    down = F.shiftrightunsigned(fp, start * WIDTH)
    return down.bitwiseOR(F.shiftleft(fp, 64 - start * WIDTH))


def chain_key(fp: Column, start: int) -> Column:
    """The first two segments from ``start``, and which start it is."""
    low = turned(fp, start).bitwiseAND(F.lit((1 << 2 * WIDTH) - 1))
    return low.bitwiseOR(F.lit(start << 2 * WIDTH))


def links(distinct: DataFrame, bits: int = MOST_BITS) -> DataFrame:
    """Pairs a < b of different fingerprints (column ``fp``) with at most ``bits`` differing bits."""
    if not 0 < bits < SEGMENTS:
        raise ValueError(f"the first segment must be equal: 1 to {SEGMENTS - 1} bits")
    allowed = budgets(bits)
    variants = [0] if not allowed[1] else [0, *(1 << WIDTH + i for i in range(WIDTH))]
    starts = range(SEGMENTS)
    stored = distinct.select(F.col("fp").alias("b"), F.explode(
        F.array(*[chain_key(F.col("fp"), s) for s in starts])).alias("key"))
    asked = distinct.select(F.col("fp").alias("a"), F.explode(
        F.array(*[chain_key(F.col("fp"), s) for s in starts])).alias("own")).select(
        "a", F.explode(F.array(*[F.lit(v).cast("long") for v in variants])).alias("change"),
        "own").select("a", F.col("own").bitwiseXOR(F.col("change")).alias("key"))
    differing = F.col("a").bitwiseXOR(F.col("b"))
    start = F.shiftrightunsigned("key", 2 * WIDTH)
    three = F.lit(None).cast("long")
    for s in starts:
        chain = turned(differing, s).bitwiseAND(F.lit((1 << 3 * WIDTH) - 1))
        three = F.when(start == s, chain).otherwise(three)
    # Spark's size estimate does not know how many variants a fingerprint has: without the hint it
    # would broadcast them where the fingerprints themselves are few.
    met = asked.join(stored.hint("merge"), "key").filter(
        (F.col("a") < F.col("b")) & (F.bit_count(three) <= allowed[2])
        & (F.bit_count(differing) <= bits))
    return met.select("a", "b").distinct()


def components(pairs: DataFrame) -> DataFrame:
    """node and root (the least node that it reaches) for every node of the pairs but the roots.

    Alternating stars: each node hands its greater neighbours, then its smaller ones, to the least
    node it knows, until nothing changes. Each round is stored, so none is ever computed twice.
    """
    edges = saved(pairs.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root"))
                  .filter("node <> root").distinct(), "edges")
    state = None
    while True:
        both = edges.select(F.col("node").alias("x"), F.col("root").alias("y")).unionByName(
            edges.select(F.col("root").alias("x"), F.col("node").alias("y")))
        least = both.groupBy("x").agg(F.min("y").alias("m")).select(
            "x", F.least("x", "m").alias("m"))
        large = both.join(least, "x").filter("y > x").select(
            F.col("y").alias("node"), F.col("m").alias("root"))
        large = saved(large.filter("node <> root").distinct(), "edges")
        low = large.groupBy("node").agg(F.min("root").alias("m"))
        small = large.join(low, "node").select(
            F.col("root").alias("node"), F.col("m").alias("root")).unionByName(
            low.select("node", F.col("m").alias("root")))
        edges = saved(small.filter("node <> root").distinct(), "edges")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("node", "root").cast("decimal(38,0)"))
                        ).first()
        if now == state:
            return edges
        state = now


def rooted(rows: DataFrame, bits: int) -> DataFrame:
    """fp, root and first (the least row: ids before none, then by id and text) of each distinct
    fingerprint of ``rows``."""
    least = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "text_hash"))
    distinct = saved(rows.groupBy("fp").agg(least.alias("first")), "distinct")
    roots = components(links(distinct.select("fp"), bits)).select(
        F.col("node").alias("fp"), "root")
    return distinct.join(roots, "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text",
                    shingle: int = SHINGLE, bits: int = MOST_BITS) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (hex), component_id.

    The component is the smallest doc_id that links of at most ``bits`` differing bits reach. Null,
    empty and blank texts have fingerprint zero and link like others; a text with fewer words than a
    shingle is one shingle; repeated rows share a component; an empty table gives an empty result;
    a null id gets its component but never names one, unless all ids there are null. Other columns
    are not read.
    """
    rows = saved(fingerprints(docs, key, text, shingle), "fingerprints")
    found = rooted(rows, bits)
    least = found.groupBy("root").agg(F.min("first").alias("least"))
    of = found.join(least, "root").select("fp", F.col("least.doc_id").alias("component_id"))
    return rows.join(of, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text",
                shingle: int = SHINGLE, bits: int = MOST_BITS) -> DataFrame:
    """One row of each component, with all its columns: that of the least id (of those with equal
    ids, the one whose text has the least hash; of equal rows any).

    Ids may repeat or be null, also within a component: one row stays all the same, a row without
    an id only where no row of the component has one. An empty table gives an empty result.
    """
    rows = saved(fingerprints(docs, key, text, shingle), "fingerprints")
    first = rooted(rows, bits).groupBy("root").agg(F.min("first").alias("least")).select(
        named("least.doc_id").alias("name"), F.col("least.text_hash").alias("text_hash"))
    rows = docs.select(whole_row(docs), named(key).alias("name"),
                       F.xxhash64(text).alias("text_hash"))
    chosen = rows.join(first, ["name", "text_hash"], "left_semi")
    # The join has sorted the rows this way already.
    same = Window.partitionBy("name", "text_hash").orderBy("text_hash")
    return (chosen.withColumn("row", F.row_number().over(same)).filter("row = 1")
            .select("whole_row.*"))
