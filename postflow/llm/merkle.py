"""Merkle manifest of a dataset: a SHA midstate tree.

Each group's leaves are numbered in order, and every parent keeps a copy of its hash state before
each child slot. To prove a row, its leaf is folded: the state before its slot goes on with the
leaf that is to be proved and with its right siblings only; what lies to the left is in the state.

A block of 4,096 consecutive nodes is one unit of work, whatever the size of a group: blocks
become nodes of the tier above, until one node is left. Paths then come down tier by tier.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from postflow.llm import sha_midstate as sha
from postflow.llm.common import named, saved

FANOUT = 2
LEVELS = 12  # of a block: 4,096 nodes
TAMPERED = 7  # the contract tampers with rows whose hash this divides


def hashed(columns: list[Column]) -> Column:
    """The leaf of these values: each as its length in UTF-8 bytes, a colon and itself."""
    texts = [c.cast("string") for c in columns]
    return F.unhex(F.sha2(F.concat(*[
        F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-"))
        for t in texts]), 256))


def leaves(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """grp (the lang), doc_id, leaf, and changed: the leaf that is folded where a row was tampered
    with (n_chars is one more), else null."""
    values = [F.col(x) for x in ("doc_id", "source", "lang", "n_chars", "text")]
    other = [*values[:3], F.col("n_chars") + 1, values[4]]
    wrong = F.lit(False) if tampered is None else tampered
    return docs.select(named("lang").alias("grp"), "doc_id", hashed(values).alias("leaf"),
                       F.when(wrong, hashed(other)).alias("changed"),
                       F.monotonically_increasing_id().alias("row"))


def contract_tampering() -> Column:
    told = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return F.col("doc_id").isNotNull() & (F.crc32(told) % TAMPERED == 0)


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """The rows with ``idx`` (from 0, within their ``grp``, by ``order``) and ``n`` (rows of the
    group). Ranges of all rows are sorted side by side, so a group may span any number of tasks;
    each range counts its rows, and the counts of the ranges before are added."""
    columns = rows.columns

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, following = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            at = np.arange(batch.num_rows, dtype=np.int64)
            groups = batch.column("grp").to_pylist()
            begins = [i for i in range(len(groups)) if i == 0 or groups[i] != groups[i - 1]]
            for begin, end in zip(begins, [*begins[1:], len(groups)]):
                first = following if groups[begin] == last else 0
                at[begin:end] += first - begin
                last, following = groups[begin], first + end - begin
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(batch.num_rows, part, np.int32)), pa.array(at)],
                [*columns, "part", "at"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    keys = ["grp", *order]
    placed = saved(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(
        count, f"{schema}, part int, at long"), "ranges")
    before = Window.partitionBy("grp").orderBy("part")
    sizes = placed.groupBy("grp", "part").agg(F.count(F.lit(1)).alias("size")).select(
        "grp", "part", F.sum("size").over(Window.partitionBy("grp")).alias("n"),
        (F.sum("size").over(before) - F.col("size")).alias("shift"))
    return placed.join(sizes, ["grp", "part"]).withColumn(
        "idx", F.col("at") + F.col("shift")).drop("part", "at", "shift")


class Forest:
    """The trees over some blocks of nodes, level by level, with the states of every parent."""

    def __init__(self, digests: np.ndarray, block: np.ndarray, place: np.ndarray,
                 levels: np.ndarray, fanout: int = FANOUT):
        """``place`` is a node's number within its block; ``levels`` how many levels a node's
        block has."""
        self.fanout, self.levels = fanout, []
        for level in range(int(levels.max(initial=0))):
            active = levels > level
            slot = np.where(active, place % fanout, 0)
            up = np.cumsum(slot == 0) - 1
            heads = np.flatnonzero(slot == 0)
            state = sha.initial(len(heads))
            states = np.zeros((len(heads), fanout, 8), dtype=np.uint32)
            count = np.bincount(up, minlength=len(heads))
            for s in range(fanout):
                states[:, s] = state
                rows = np.flatnonzero(active & (slot == s))
                if len(rows):
                    state[up[rows]] = sha.compressed(state[up[rows]], sha.hex_blocks(digests[rows]))
            above = digests[heads].copy()
            parents = np.flatnonzero(active[heads])
            above[parents] = sha.finished(state[parents], count[parents])
            self.levels.append((digests, active, slot, up, count, states))
            digests, block, levels = above, block[heads], levels[heads]
            place = np.where(active[heads], place[heads] // fanout, place[heads])
        self.tops = digests  # one node per block, in order
        self.block = block

    def siblings(self, level: int, node: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(distance, lanes, nodes) of siblings, left to right."""
        _, active, _, up, _, _ = self.levels[level]
        for distance in range(1 - self.fanout, self.fanout):
            other = node + distance
            inside = (other >= 0) & (other < len(up)) & active[node] & (distance != 0)
            lanes = np.flatnonzero(inside)
            lanes = lanes[up[other[lanes]] == up[node[lanes]]]
            yield distance, lanes, other[lanes]

    def folded(self, changed: np.ndarray) -> np.ndarray:
        """For each node at the bottom, the top of its block if that node were ``changed``."""
        current, node = changed.copy(), np.arange(len(changed))
        for level, (digests, active, slot, up, count, states) in enumerate(self.levels):
            state = states[up[node], slot[node]]  # a copy: where the parent's hash resumes
            state = sha.compressed(state, sha.hex_blocks(current))
            for distance, lanes, others in self.siblings(level, node):
                if distance > 0 and len(lanes):
                    state[lanes] = sha.compressed(
                        state[lanes], sha.hex_blocks(digests[others]))
            lanes = np.flatnonzero(active[node])
            current[lanes] = sha.finished(state[lanes], count[up[node[lanes]]])
            node = up[node]
        return current

    def paths(self) -> list[list[tuple[bytes, bytes, bytes]]]:
        """For each node at the bottom, level by level: the state before its slot, the siblings to
        the left, and those to the right (raw digests, one after another)."""
        size = len(self.levels[0][0]) if self.levels else len(self.tops)
        found: list[list] = [[] for _ in range(size)]
        node = np.arange(size)
        for level, (digests, active, slot, up, _, states) in enumerate(self.levels):
            sides = [[b""] * size, [b""] * size]
            for distance, lanes, others in self.siblings(level, node):
                side = sides[distance > 0]
                for lane, data in zip(lanes.tolist(), sha.raw(digests[others])):
                    side[lane] += data.tobytes()
            state = sha.raw(states[up[node], slot[node]])
            for lane in np.flatnonzero(active[node]).tolist():
                found[lane].append((state[lane].tobytes(), sides[0][lane], sides[1][lane]))
            node = up[node]
        return found

    def proofs(self) -> list[bytes]:
        """For each node at the bottom, its siblings in hexadecimal, level by level."""
        size = len(self.levels[0][0]) if self.levels else len(self.tops)
        width = 2 * self.fanout - 1
        text = np.zeros((size, len(self.levels) * width, 64), dtype=np.uint8)
        held = np.zeros((size, len(self.levels) * width), dtype=bool)
        node = np.arange(size)
        for level, (digests, _, _, up, _, _) in enumerate(self.levels):
            hexed = sha.hex_bytes(digests)
            for column, (_, lanes, others) in enumerate(self.siblings(level, node)):
                text[lanes, level * width + column] = hexed[others]
                held[lanes, level * width + column] = True
            node = up[node]
        return [text[lane][held[lane]].tobytes() for lane in range(size)]


def written_path(path: list[tuple[bytes, bytes, bytes]]) -> list[dict]:
    return [{"state": s, "left": left, "right": right} for s, left, right in path]


PATH = "array<struct<state: binary, left: binary, right: binary>>"


def resumed(current: np.ndarray, lane_path: np.ndarray, paths: list[list[dict]]) -> np.ndarray:
    """The roots of digests that lie below the blocks of ``paths``; ``lane_path`` says which."""
    current = current.copy()
    lengths = np.array([len(p) for p in paths], dtype=np.int64)
    for level in range(int(lengths.max(initial=0))):
        lanes = np.flatnonzero(lengths[lane_path] > level)
        of = lane_path[lanes]
        steps = [p[level] if len(p) > level else None for p in paths]
        states = np.stack([sha.INITIAL if s is None else sha.words_of([s["state"]])[0]
                           for s in steps])
        rights = [[] if s is None else digests_in(s["right"]) for s in steps]
        count = np.array([0 if s is None else 1 + (len(s["left"]) + len(s["right"])) // 32
                          for s in steps])
        state = sha.compressed(states[of], sha.hex_blocks(current[lanes]))
        for turn in range(max(map(len, rights))):
            more = np.array([len(r) > turn for r in rights])
            there = np.flatnonzero(more[of])
            blocks = sha.hex_blocks(sha.words_of([r[turn] if len(r) > turn else bytes(32)
                                                  for r in rights]))
            state[there] = sha.compressed(state[there], blocks[of[there]])
        current[lanes] = sha.finished(state, count[of])
    return current


def digests_in(data: bytes) -> list[bytes]:
    return [data[i:i + 32] for i in range(0, len(data), 32)]


def proof_text(path: list[dict]) -> bytes:
    return b"".join((step["left"] + step["right"]).hex().encode() for step in path)


def level_count(size: int, most: int = LEVELS, fanout: int = FANOUT) -> int:
    """Levels of a block in a tier of ``size`` nodes: all of them if more blocks stand beside it."""
    levels = 0
    while size > 1 and levels < most:
        size, levels = -(-size // fanout), levels + 1
    return levels


class Blocks:
    """Some whole blocks of one tier, read from sorted rows; ``heads`` are their path rows."""

    def __init__(self, rows: list[dict], heads: list[dict], levels: int):
        self.rows, self.heads = rows, heads
        of = np.empty(len(rows), dtype=np.int64)
        last, number = None, -1
        for i, row in enumerate(rows):
            if (key := (row["grp"], row["block"])) != last:
                last, number = key, number + 1
            of[i] = number
        self.of = of
        places = np.array([r["idx"] for r in rows], dtype=np.int64) % FANOUT ** levels
        self.forest = Forest(
            sha.words_of([r["digest"] for r in rows]), of, places,
            np.array([level_count(r["n"], levels) for r in rows], dtype=np.int64))


def blocks_of(batches: Iterator[pa.RecordBatch], levels: int) -> Iterator[Blocks]:
    """The blocks of a sorted partition, enough of them at a time to hash side by side."""
    rows: list[dict] = []
    heads: list[dict] = []
    last = None
    for batch in batches:
        for row in batch.to_pylist():
            if (key := (row["grp"], row["block"])) != last:
                if len(rows) >= sha.LANES:
                    yield Blocks(rows, heads, levels)
                    rows, heads = [], []
                last = key
            (heads if row["head"] else rows).append(row)
    if rows:
        yield Blocks(rows, heads, levels)


def by_block(nodes: DataFrame, levels: int, paths: DataFrame | None = None) -> DataFrame:
    """A tier's nodes, each block in one task, in order; before them the block's path, if known."""
    rows = nodes.withColumn("block", F.shiftright(
        F.col("idx"), levels)).withColumn(
        "head", F.lit(False))
    if paths is not None:
        heads = paths.withColumnRenamed("idx", "block").withColumn("head", F.lit(True))
        rows = heads.unionByName(rows, allowMissingColumns=True)
    return rows.repartition("grp", "block").sortWithinPartitions(
        "grp", "block", F.desc("head"), "idx")


def tops(nodes: DataFrame, levels: int) -> DataFrame:
    """The tier above: a node per block (grp, idx, n, digest)."""
    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for blocks in blocks_of(batches, levels):
            firsts = [blocks.rows[i] for i in np.unique(blocks.of, return_index=True)[1]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r["grp"] for r in firsts], pa.string()),
                 pa.array([r["block"] for r in firsts], pa.int64()),
                 pa.array([-(-r["n"] // FANOUT ** levels) for r in firsts], pa.int64()),
                 pa.array([d.tobytes() for d in sha.raw(blocks.forest.tops)], pa.binary())],
                ["grp", "idx", "n", "digest"])

    return by_block(nodes.select("grp", "idx", "n", "digest"), levels).mapInArrow(
        reduce, "grp string, idx long, n long, digest binary")


def tiers(nodes: DataFrame, levels: int) -> list[DataFrame]:
    """The nodes (grp, idx, n, digest) and the tiers above, the last with one node per group."""
    found = [nodes]
    while (found[-1].agg(F.max("n")).first()[0] or 0) > 1:
        found.append(saved(tops(found[-1], levels), "tier"))
    return found


HEAD = f"path {PATH}, subroot binary, root binary"


def lower_paths(nodes: DataFrame, paths: DataFrame, levels: int) -> DataFrame:
    """The paths (grp, idx, path, subroot, root) of a tier's nodes, from those of the tier above."""
    def lower(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for blocks in blocks_of(batches, levels):
            rows, heads = blocks.rows, [blocks.heads[b] for b in blocks.of.tolist()]
            paths = [written_path(own) + head["path"]
                     for own, head in zip(blocks.forest.paths(), heads)]
            for at in range(0, len(rows), 512):
                some = slice(at, at + 512)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["grp"] for r in rows[some]], pa.string()),
                     pa.array([r["idx"] for r in rows[some]], pa.int64()),
                     pa.array(paths[some], PATH_TYPE),
                     pa.array([h["subroot"] for h in heads[some]], pa.binary()),
                     pa.array([h["root"] for h in heads[some]], pa.binary())],
                    ["grp", "idx", "path", "subroot", "root"])

    return by_block(nodes.select("grp", "idx", "n", "digest"), levels, paths).mapInArrow(
        lower, f"grp string, idx long, {HEAD}")


PATH_TYPE = pa.list_(pa.struct([(x, pa.binary()) for x in ("state", "left", "right")]))


def descended(found: list[DataFrame], paths: DataFrame, levels: int) -> DataFrame:
    """Paths of the second tier's nodes (those of a leaf tier's blocks) from those of the last."""
    for nodes in reversed(found[1:-1]):
        paths = saved(lower_paths(nodes, paths, levels), "paths")
    return paths


def proved(rows: DataFrame, paths: DataFrame, levels: int) -> DataFrame:
    """Every leaf's row: folds ``changed`` (or the leaf itself) to the root."""
    kind = rows.schema["doc_id"].dataType.simpleString()

    def prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for blocks in blocks_of(batches, levels):
            rows, upper = blocks.rows, [h["path"] for h in blocks.heads]
            start = sha.words_of([r["changed"] or r["digest"] for r in rows])
            folded = resumed(blocks.forest.folded(start), blocks.of, upper)
            texts = [proof_text(p) for p in upper]
            proofs = [hashlib.sha256(own + texts[b]).hexdigest()
                      for own, b in zip(blocks.forest.proofs(), blocks.of.tolist())]
            told = [d.tobytes().hex() for d in sha.raw(folded)]
            heads = [blocks.heads[b] for b in blocks.of.tolist()]
            root = [h["root"].hex() for h in heads]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r["doc_id"] for r in rows], doc_type),
                 pa.array([r["digest"].hex() for r in rows]),
                 pa.array([h["subroot"].hex() for h in heads]), pa.array(root),
                 pa.array(proofs), pa.array(told),
                 pa.array([a == b for a, b in zip(told, root)])],
                ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])

    doc_type = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]
    return by_block(rows, levels, paths).mapInArrow(
        prove, f"doc_id {kind}, leaf string, subroot string, root string, proof_sha256 string, "
               "folded_root string, verified boolean")


def grown(docs: DataFrame, tampered: Column | None, levels: int) -> tuple[DataFrame, DataFrame]:
    """The numbered leaves, and the paths (grp, idx, path, subroot, root) of their blocks."""
    stored = saved(leaves(docs, tampered), "leaves")
    rows = saved(numbered(stored, ["doc_id", "leaf", "row"]).withColumnRenamed("leaf", "digest"),
                 "numbered")
    below = tiers(rows.select("grp", "idx", "n", "digest"), levels)
    # The subroots are the leaves of one more tree, in order of their groups.
    subroots = below[-1].select(F.lit("").alias("grp"), F.col("grp").alias("lang"), "digest")
    subroots = saved(numbered(subroots, ["lang"]), "subroots")
    above = tiers(subroots.select("grp", "idx", "n", "digest"), levels)
    paths = above[-1].select(
        "grp", "idx", F.array().cast(PATH).alias("path"),
        F.lit(None).cast("binary").alias("subroot"), F.col("digest").alias("root"))
    if len(above) > 1:
        paths = lower_paths(above[0], descended(above, paths, levels), levels)
    paths = saved(subroots.select("idx", F.col("lang").alias("grp"), "digest").join(
        paths.drop("grp"), "idx").select(
            "grp", F.lit(0).cast("long").alias("idx"), "path", F.col("digest").alias("subroot"),
            "root"), "paths")
    return rows, descended(below, paths, levels)


def manifest(docs: DataFrame, tampered: Column | None = None, levels: int = LEVELS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, source, lang, n_chars, text): doc_id, leaf, subroot,
    root, proof_sha256, folded_root, verified.

    The leaves of a lang stand by doc_id (nulls first); rows with the same id by leaf, and repeated
    rows are leaves of their own. A null lang is a group like any other, and the first. Nulls in
    other columns count as nulls, not as empty texts; texts are hashed whole; an empty table gives
    an empty result; other columns are not read. ``tampered`` says which rows are folded with an
    n_chars one greater than the one in the tree; a block has 2 ** ``levels`` nodes. Texts are read once and never shuffled.
    """
    return proved(*grown(docs, tampered, levels), levels)


def block_paths(docs: DataFrame, levels: int = LEVELS) -> DataFrame:
    """The manifest to keep: of every block of leaves (lang, idx) its path to the root, with the
    state before each slot and the siblings on both sides, its subroot and the root. ``resumed``
    verifies a block from its row alone."""
    return grown(docs, None, levels)[1].withColumn("lang", F.expr("substring(grp, 2)")).withColumn(
        "lang", F.when(F.col("grp") != "", F.col("lang"))).drop("grp")


QUERY_SQL = r"""
WITH RECURSIVE
bytes AS (
  SELECT doc_id, list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
                                lambda c: CAST(ord(c) AS BIGINT)) AS codes
  FROM documents WHERE doc_id IS NOT NULL GROUP BY ALL),
crcs AS (
  SELECT doc_id, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), codes),
    lambda crc, c: list_reduce(list_prepend(xor(crc, c), CAST(range(8) AS BIGINT[])),
      lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)),
    4294967295) AS crc
  FROM bytes),
parts AS (
  SELECT d.doc_id, lang, crc % 7 = 0 AS bad,
    coalesce(strlen(CAST(d.doc_id AS VARCHAR)) || ':' || d.doc_id, '-')
      || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') AS head,
    coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS own,
    coalesce(strlen(CAST(n_chars + 1 AS VARCHAR)) || ':' || (n_chars + 1), '-') AS other,
    coalesce(strlen(text) || ':' || text, '-') AS body
  FROM documents d LEFT JOIN crcs USING (doc_id)),
leaves AS (
  SELECT doc_id, lang, coalesce('=' || lang, '') AS grp, sha256(head || own || body) AS leaf,
         sha256(head || CASE WHEN bad THEN other ELSE own END || body) AS folded
  FROM parts),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
         count(*) OVER (PARTITION BY grp) AS n
  FROM leaves),
tree AS (
  SELECT 0 AS lvl, grp, idx, leaf AS h, n FROM placed
  UNION ALL
  SELECT lvl + 1, grp, idx // 2, sha256(string_agg(h, '' ORDER BY idx)), (any_value(n) + 1) // 2
  FROM tree WHERE n > 1 GROUP BY lvl, grp, idx // 2),
subs AS (
  SELECT grp, lvl AS depth, h AS subroot,
         row_number() OVER (ORDER BY encode(grp)) - 1 AS idx, count(*) OVER () AS n
  FROM tree WHERE n = 1),
tops AS (
  SELECT 0 AS lvl, idx, subroot AS h, n FROM subs
  UNION ALL
  SELECT lvl + 1, idx // 2, sha256(string_agg(h, '' ORDER BY idx)), (any_value(n) + 1) // 2
  FROM tops WHERE n > 1 GROUP BY lvl, idx // 2),
-- A step per leaf and level: the left sibling, the right one, or neither.
steps AS (
  SELECT p.grp, p.idx, t.lvl AS step, t.h, t.idx < (p.idx >> t.lvl) AS is_left
  FROM placed p JOIN tree t ON t.grp = p.grp AND t.idx = xor(p.idx >> t.lvl, 1)
  WHERE t.n > 1
  UNION ALL
  SELECT p.grp, p.idx, s.depth + t.lvl, t.h, t.idx < (s.idx >> t.lvl)
  FROM placed p JOIN subs s USING (grp) JOIN tops t ON t.idx = xor(s.idx >> t.lvl, 1)
  WHERE t.n > 1),
heights AS (SELECT max(lvl) AS height FROM tops),
folds AS (
  SELECT 0 AS step, p.grp, p.idx, p.folded AS h, s.depth + height AS last
  FROM placed p JOIN subs s USING (grp), heights
  UNION ALL
  SELECT f.step + 1, f.grp, f.idx,
         sha256(coalesce(CASE WHEN is_left THEN s.h END, '') || f.h
                || coalesce(CASE WHEN NOT is_left THEN s.h END, '')), f.last
  FROM folds f LEFT JOIN steps s ON s.grp = f.grp AND s.idx = f.idx AND s.step = f.step
  WHERE f.step < f.last),
proofs AS (
  SELECT grp, idx, sha256(string_agg(h, '' ORDER BY step)) AS proof FROM steps GROUP BY grp, idx)
SELECT p.doc_id, p.leaf, s.subroot, r.h AS root,
       coalesce(q.proof, sha256('')) AS proof_sha256, f.h AS folded_root,
       f.h = r.h AS verified
FROM placed p JOIN subs s USING (grp) JOIN tops r ON r.n = 1
JOIN folds f ON f.grp = p.grp AND f.idx = p.idx AND f.step = f.last
LEFT JOIN proofs q ON q.grp = p.grp AND q.idx = p.idx
"""
