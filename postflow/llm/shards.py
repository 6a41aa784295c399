"""Token ids as binary shards in training order.

Every document is cut into sequences of at most ``stride`` ids. A sequence's number among all of
them is permuted by a keyed Feistel network (numbers outside the range walk the cycle until they
fall inside), which gives its slot in training order without sorting anything. A partition holds a
range of slots and writes it as some shard files of records of equal length, so slot k lies at a
place that can be computed, and a reader resumes anywhere. The manifest is written last: a folder
without it is not whole.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from postflow.llm.batches import slices, texts_of
from postflow.llm.byte_tokens import END_ID, cuts, encoded, encoding, token_ids
from postflow.llm.common import saved
from postflow.session import new_folder

STRIDE = 256
SLOTS_PER_SHARD = 1 << 15
SHARDS_PER_TASK = 16
# Groups in which the file blocks are numbered and looked up.
GROUPS = 256
ROUNDS = 6
SEED = 20240607


def mixed(values: np.ndarray, key: int) -> np.ndarray:
    """A keyed hash of 64-bit numbers: two rounds of multiply and shift."""
    with np.errstate(over="ignore"):
        x = (values + np.uint64(key & 0xFFFFFFFFFFFFFFFF)) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def permuted(numbers: np.ndarray, total: int, seed: int = SEED) -> np.ndarray:
    """The slot of each number in ``range(total)``: a bijection of that range."""
    half = max(1, (max(total - 1, 1).bit_length() + 1) // 2)
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> shift, x & mask
        for turn in range(ROUNDS):
            left, right = right, left ^ (mixed(right, seed + turn * 0x1F3D5B79) & mask)
        return (left << shift) | right

    slots = once(numbers.astype(np.uint64))
    while (outside := slots >= np.uint64(total)).any():
        slots[outside] = once(slots[outside])
    return slots.astype(np.int64)


def file_system(uri: str) -> tuple[pa.fs.FileSystem, str]:
    """The store that a folder lies in, and the folder's path there."""
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri.removeprefix("file:")
    return pa.fs.FileSystem.from_uri(uri)


def blocks_of(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Ids and texts with the file block that holds the row, and the group that the block is in. A
    block is read by one task, in order, so its rows can be numbered by counting."""
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"),
                       F.input_file_name().alias("file"),
                       F.input_file_block_start().alias("block"))
    return rows.withColumn("grp", F.pmod(F.xxhash64("file", "block"), F.lit(GROUPS)).cast("int"))


def counted(rows: DataFrame, path: str, stride: int) -> DataFrame:
    """grp, file, block and n, the number of sequences, of each file block."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, str, int], int] = {}
        bpe = encoding(path)
        for whole in batches:
            for batch in slices(whole, "text"):
                places = zip(*(batch.column(x).to_pylist() for x in ("grp", "file", "block")))
                for place, text in zip(places, texts_of(batch, "text")):
                    held[place] = held.get(place, 0) - (-1 - len(encoded(bpe, text))) // stride
        columns = list(zip(*held)) or [()] * 3
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.string()),
             pa.array(columns[2], pa.int64()), pa.array(list(held.values()), pa.int64())],
            ["grp", "file", "block", "n"])

    return rows.mapInArrow(count, "grp int, file string, block long, n long").groupBy(
        "grp", "file", "block").agg(F.sum("n").alias("n"))


def numbered_blocks(counts: DataFrame) -> DataFrame:
    """The blocks with ``first``, the number of the first sequence: within their group, and then
    after all groups before, of which there are few."""
    totals = counts.groupBy("grp").agg(F.sum("n").alias("all"))
    before = Window.orderBy("grp").rowsBetween(Window.unboundedPreceding, -1)
    shifts = totals.select("grp", F.coalesce(F.sum("all").over(before), F.lit(0)).alias("shift"))
    inside = Window.partitionBy("grp").orderBy("file", "block").rowsBetween(
        Window.unboundedPreceding, -1)
    return counts.withColumn("own", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(
        shifts, "grp").select("grp", "file", "block", (F.col("own") + F.col("shift")).alias("first"))


@lru_cache(maxsize=8)
def firsts_of(folder: str, group: int) -> dict[tuple[str, int], int]:
    """The first number of each block of a group. A task reads the groups of its own blocks."""
    store, root = file_system(folder)
    selected = pa.fs.FileSelector(f"{root}/grp={group}", allow_not_found=True)
    found = {}
    for info in store.get_file_info(selected):
        if info.path.endswith(".parquet"):
            with store.open_input_file(info.path) as file:
                part = pq.read_table(file, columns=["file", "block", "first"]).to_pydict()
            found.update(zip(zip(part["file"], part["block"]), part["first"]))
    return found


def sequences(rows: DataFrame, path: str, stride: int, firsts: str, total: int,
              seed: int) -> DataFrame:
    """Every sequence with its slot and its ids as 16-bit numbers. ``firsts`` is the folder of the
    numbered blocks."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        following: dict[tuple[str, int], int] = {}
        for whole in batches:
            for batch in slices(whole, "text"):
                doc, piece, numbers, bodies = [], [], [], []
                groups, files, blocks = (
                    batch.column(x).to_pylist() for x in ("grp", "file", "block"))
                texts = token_ids(path, texts_of(batch, "text"))
                for row, (group, file, block, ids) in enumerate(zip(groups, files, blocks, texts)):
                    place = file, block
                    if place not in following:
                        following[place] = firsts_of(firsts, group)[place]
                    short = ids.astype("<u2").tobytes()
                    for part, (start, length) in enumerate(cuts(len(ids), stride)):
                        doc.append(row)
                        piece.append(part)
                        bodies.append(short[2 * start:2 * (start + length)])
                        numbers.append(following[place])
                        following[place] += 1
                slots = permuted(np.array(numbers, dtype=np.int64), total, seed)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(slots), batch.column("doc_id").take(pa.array(doc, pa.int64())),
                     pa.array(piece, pa.int32()), pa.array(bodies, pa.binary())],
                    ["slot", "doc_id", "piece", "ids"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(cut, f"slot long, doc_id {kind}, piece int, ids binary")


def written(ordered: DataFrame, folder: str, stride: int, per_shard: int) -> DataFrame:
    """Writes each partition, sorted by slot, as shards; a row per sequence says where it is.
    A file gets its name when it is whole, and a task that runs again writes the same bytes."""
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = file_system(folder)
        filler = np.full(stride, END_ID, dtype="<u2").tobytes()
        shard = out = draft = None

        def finish() -> None:
            if out is not None:
                out.close()
                store.move(draft, shard_path(root, shard))

        for batch in batches:
            slots = batch.column("slot").to_numpy()
            bodies = batch.column("ids").to_pylist()
            begins = np.flatnonzero(np.diff(slots // per_shard, prepend=-1))
            for begin, end in zip(begins.tolist(), [*begins[1:].tolist(), len(slots)]):
                if (of := int(slots[begin]) // per_shard) != shard:
                    finish()
                    shard, draft = of, f"{root}/{DRAFTS}/{uuid.uuid4().hex}"
                    out = store.open_output_stream(draft)
                out.write(b"".join(x + filler[len(x):] for x in bodies[begin:end]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("slot"), pa.array(slots // per_shard),
                 pa.array(slots % per_shard * (2 * stride)), batch.column("doc_id"),
                 batch.column("piece"), pa.array([len(b) // 2 for b in bodies], pa.int32()),
                 pa.array([zlib.crc32(b) for b in bodies], pa.int64())],
                ["slot", "shard", "byte_offset", "doc_id", "piece", "length", "ids_crc32"])
        finish()

    kind = ordered.schema["doc_id"].dataType.simpleString()
    return ordered.mapInArrow(
        write, f"slot long, shard long, byte_offset long, doc_id {kind}, piece int, length int, "
               "ids_crc32 long")


DRAFTS = "_drafts"


def shard_path(root: str, shard: int) -> str:
    return f"{root}/shard-{shard:06d}.bin"


def materialise(docs: DataFrame, path: str, folder: str, *, stride: int = STRIDE,
                per_shard: int = SLOTS_PER_SHARD, per_task: int = SHARDS_PER_TASK,
                seed: int = SEED, key: str = "doc_id", text: str = "text",
                stored: bool = False) -> DataFrame:
    """Writes all documents as shards under ``folder``, and returns a row per sequence: slot,
    shard, byte_offset, doc_id, piece, length, ids_crc32 (of the 16-bit ids).

    Only the first sequence of a document may be short; it is filled up with end ids. A null text
    counts as empty and gives one sequence with the end id; repeated rows are written each; a null
    id is carried; an empty table gives no shards and an empty result. Other columns are not read.
    ``stored`` says that ``docs`` comes straight from files; else it is stored first, as its rows
    are read twice (counted, then written) and must come in the same order. The shuffle holds each
    id once; a task writes ``per_task`` shards of ``per_shard`` slots. A vocabulary that 16 bits
    cannot number is an error.
    """
    if encoding(path).n_vocab > 1 << 16:
        raise ValueError(f"{path}: ids do not fit into 16 bits")
    rows = blocks_of(docs if stored else saved(docs.select(key, text), "texts"), key, text)
    counts = saved(counted(rows, path, stride), "counts")
    total = counts.agg(F.sum("n")).first()[0] or 0
    firsts = new_folder(docs.sparkSession, "firsts")
    numbered_blocks(counts).write.partitionBy("grp").parquet(firsts)
    store, root = file_system(folder)
    store.create_dir(f"{root}/{DRAFTS}", recursive=True)
    cut = sequences(rows, path, stride, firsts, total, seed)
    wide = per_shard * per_task
    ordered = cut.repartitionById(max(1, -(-total // wide)),
                                  F.floor(F.col("slot") / wide).cast("int"))
    placed = saved(written(ordered.sortWithinPartitions("slot"), folder, stride, per_shard),
                   "placements")
    store.delete_dir(f"{root}/{DRAFTS}")
    with store.open_output_stream(f"{root}/manifest.json") as out:
        out.write(json.dumps({"sequences": total, "stride": stride, "per_shard": per_shard,
                              "shards": -(-total // per_shard), "seed": seed,
                              "dtype": "<u2"}).encode())
    return placed


def read_slots(folder: str, first: int, count: int) -> np.ndarray:
    """``count`` sequences from slot ``first`` on, a row each: at most one seek per shard."""
    store, root = file_system(folder)
    with store.open_input_stream(f"{root}/manifest.json") as file:
        about = json.loads(file.read())
    stride, per_shard, parts = about["stride"], about["per_shard"], []
    last = min(first + count, about["sequences"])
    while first < last:
        take = min(last - first, per_shard - first % per_shard)
        with store.open_input_file(shard_path(root, first // per_shard)) as file:
            file.seek(first % per_shard * 2 * stride)
            parts.append(file.read(take * 2 * stride))
        first += take
    return np.frombuffer(b"".join(parts), dtype=about["dtype"]).reshape(-1, stride)
