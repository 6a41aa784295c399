"""Repeated passages by an FM-index per shard.

Sharding. A window of ``length`` words belongs to the shard of its minimizer, the least hash of the
groups of ``GRAM`` words inside. Equal windows have equal minimizers, so they meet in one shard and
no document has to visit the others. A run of windows with one minimizer is one segment, a few
words longer than a window; segments whose minimizer stands nowhere else go nowhere.

Search. Each shard builds an FM-index over its distinct segments (two copies of those that occur
more than once), and streams the segments through it by backward search: where the matching
statistics reach ``length`` with two occurrences, the interval is reported. Groups of words that
are frequent in a sample come last in the order of hashes, so boilerplate does not draw all that
stands beside it into one shard; the sample steers the sharding only, never the result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from postflow.llm.batches import slices
from postflow.llm.common import filled, saved
from postflow.llm.fm_index import KNOWN, FMIndex

LENGTH = 35
GRAM = 8
MOST_WINDOWS = 64  # of a segment: longer runs are cut
SHARD_WORDS = 300_000
SALTS = 8
SAMPLE_DOCS, FREQUENT = 4000, 0.005
MOST_FREQUENT = 1 << 20

BASE, WORD_BASE, GRAM_BASE = (np.uint64(x) for x in (
    0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F))
TOP = np.uint64(1 << 63)
WHITE = np.zeros(256, dtype=bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True


def stirred(x: np.ndarray) -> np.ndarray:
    """A keyless hash of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of an odd number and of its inverse modulo 2 ** 64, as many as were asked for."""

    def __init__(self, base: np.uint64):
        self.bases = base, np.uint64(pow(int(base), -1, 1 << 64))
        self.tables = np.ones((2, 1), dtype=np.uint64)

    def upto(self, count: int) -> np.ndarray:
        if count > self.tables.shape[1]:
            size = 1 << (count - 1).bit_length()
            self.tables = np.stack([
                np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(size - 1, b)]))
                for b in self.bases])
        return self.tables

    def hashes(self, values: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A hash of ``values[begin:end]`` for each pair."""
        up, down = self.upto(len(values) + 1)
        sums = np.concatenate([[np.uint64(0)], np.cumsum(values * up[:len(values)])])
        lengths = (ends - begins).astype(np.uint64)
        return stirred((sums[ends] - sums[begins]) * down[begins] + lengths)


BYTES, WORDS = Powers(BASE), Powers(WORD_BASE)


def word_places(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all texts at once: the bytes, begin and end of each word, and its text's number."""
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[
        texts.offset:texts.offset + len(texts) + 1]
    held = texts.buffers()[2]
    data = np.frombuffer(held if held is not None else b"", dtype=np.uint8)[offsets[0]:offsets[-1]]
    offsets = offsets - offsets[0]
    inside = ~WHITE[data]
    edge = np.zeros(len(data) + 1, dtype=bool)  # a text begins here
    edge[offsets] = True
    before = np.concatenate([[False], inside[:-1]])
    begins = np.flatnonzero(inside & (~before | edge[:-1])) if len(data) else np.zeros(0, np.int64)
    after = np.concatenate([inside[1:], [False]])
    ends = 1 + np.flatnonzero(inside & (~after | edge[1:])) if len(data) else begins
    return data, begins, ends, np.searchsorted(offsets, begins, side="right") - 1


def gram_hashes(words: np.ndarray, gram: int) -> np.ndarray:
    """A hash of every ``gram`` neighbouring words, below 2 ** 63."""
    total = np.zeros(max(0, len(words) - gram + 1), dtype=np.uint64)
    for step in range(gram):
        total = total * GRAM_BASE + words[step:step + len(total)]
    return stirred(total) >> np.uint64(1)


def running_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours."""
    have, least = 1, values
    while 2 * have <= width:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    return np.minimum(least[:len(least) - (width - have)], least[width - have:])


def segments_of(texts: pa.Array, length: int, gram: int, frequent: np.ndarray):
    """Segments of all texts at once: text number, first word there, words, minimizer, content
    hash, and how often the minimizer occurs in the segment (1, or 2 for more)."""
    data, begins, ends, of = word_places(texts)
    empty = (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2 + (np.zeros(0, np.int64),)
    if len(begins) < length:
        return empty
    words = BYTES.hashes(data.astype(np.uint64) + np.uint64(1), begins, ends)
    grams = gram_hashes(words, gram)
    if len(frequent):
        known = np.searchsorted(frequent, grams)
        hit = frequent[np.minimum(known, len(frequent) - 1)] == grams
        grams = np.where(hit, grams | TOP, grams)
    width = length - gram + 1
    least = running_least(grams, width)
    inside = of[:len(least)] == of[length - 1:]  # the window lies in one text
    new = inside.copy()
    new[1:] &= ~inside[:-1] | (least[1:] != least[:-1])
    first = np.flatnonzero(new)
    if not len(first):
        return empty
    last = inside.copy()
    last[:-1] &= ~inside[1:] | new[1:]
    windows = np.flatnonzero(last) - first + 1
    # Long runs are cut, so that a search has many short queries in place of a long one.
    pieces = -(-windows // MOST_WINDOWS)
    number = np.arange(int(pieces.sum())) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    first = np.repeat(first, pieces) + number * MOST_WINDOWS
    windows = np.minimum(np.repeat(windows, pieces) - number * MOST_WINDOWS, MOST_WINDOWS)
    spans = windows + width - 1
    at = np.arange(int(spans.sum())) + np.repeat(first - (np.cumsum(spans) - spans), spans)
    same = grams[at] == np.repeat(least[first], spans)
    times = np.minimum(np.add.reduceat(same, np.cumsum(spans) - spans, dtype=np.int64), 2)
    count = windows + length - 1
    content = WORDS.hashes(words, first, first + count)
    begin = first - np.searchsorted(of, of[first])
    return of[first], begin, count, least[first], content, times


def identity(key: str, text: str) -> list[Column]:
    """What names a document wherever it is read: its id, and a hash of id and text."""
    return [F.col(key).alias("doc_id"), F.xxhash64(key, text).alias("uid"),
            filled(text).alias("text")]


def frequent_grams(docs: DataFrame, text: str, gram: int) -> np.ndarray:
    """Hashes of the groups of words that stand in many texts of a sample by hash (of about
    ``SAMPLE_DOCS`` texts). At most ``MOST_FREQUENT``: 8 MB."""
    total = docs.count()
    share = min(1.0, SAMPLE_DOCS / max(1, total))
    drawn = docs.filter(F.shiftrightunsigned(F.xxhash64(text, F.lit(7)), 11)
                        <= int(share * (1 << 53))).select(filled(text).alias("text"))

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                data, begins, ends, of = word_places(batch.column("text"))
                words = BYTES.hashes(data.astype(np.uint64) + np.uint64(1), begins, ends)
                held = gram_hashes(words, gram)
                of = of[:len(held)]
                order = np.lexsort((held, of))
                held, of = held[order], of[order]
                once = np.ones(len(held), dtype=bool)
                once[1:] = (held[1:] != held[:-1]) | (of[1:] != of[:-1])
                found, counts = np.unique(held[once], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found.view(np.int64)), pa.array(counts.astype(np.int64))],
                    ["gram", "n"])

    least = max(20, int(FREQUENT * min(total, SAMPLE_DOCS)))
    rows = (drawn.mapInArrow(grams, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
            .filter(F.col("n") >= least).orderBy(F.desc("n"), "gram").limit(MOST_FREQUENT))
    return np.sort(np.array([r["gram"] for r in rows.collect()], dtype=np.uint64))


def references(docs: DataFrame, key: str, text: str, length: int, gram: int,
               frequent: np.ndarray) -> DataFrame:
    """doc_id, uid, start, words, minimizer, content and times of every segment."""
    rows = docs.select(*identity(key, text))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                of, begin, count, least, content, times = segments_of(
                    batch.column("text"), length, gram, frequent)
                row = pa.array(of)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(row), batch.column("uid").take(row),
                     pa.array(begin.astype(np.int32)), pa.array(count.astype(np.int32)),
                     pa.array(least.view(np.int64)), pa.array(content.view(np.int64)),
                     pa.array(times.astype(np.int32))],
                    ["doc_id", "uid", "start", "words", "minimizer", "content", "times"])

    return rows.mapInArrow(
        cut, f"doc_id {kind}, uid long, start int, words int, minimizer long, content long, "
             "times int")


def candidates(refs: DataFrame) -> DataFrame:
    """The distinct segments whose minimizer occurs more than once: minimizer, content, words, n
    (occurrences), at (one of them: doc_id, uid, start) and group_words (of the minimizer)."""
    distinct = refs.groupBy("minimizer", "content", "words").agg(
        F.count(F.lit(1)).alias("n"), F.sum("times").alias("times"),
        F.min(F.struct("uid", "doc_id", "start")).alias("at"))
    of = Window.partitionBy("minimizer")
    return distinct.select(
        "minimizer", "content", "words", "n", "at", F.sum("times").over(of).alias("met"),
        F.sum("words").over(of).alias("group_words")).filter("met > 1").drop("met")


def read_segments(texts: DataFrame, asked: DataFrame, length: int, shards: int,
                  shard_words: int) -> DataFrame:
    """The words of the candidates, from the documents that hold them, each with its shard. The
    windows of a minimizer with more words than a shard holds go where their own hash says."""
    lists = asked.select("at.uid", "at.doc_id", F.struct(
        "at.start", "words", "minimizer", "content", F.least("n", F.lit(2)).alias("copies"),
        (F.col("group_words") > shard_words).alias("spread")).alias("one")).groupBy(
            "doc_id", "uid").agg(F.collect_list("one").alias("asked"))
    rows = joined(texts, lists, "inner").select("text", "asked")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                out: list[tuple] = []
                for text, asked in zip(batch.column("text"), batch.column("asked").to_pylist()):
                    words = text.as_py().encode().split()
                    for one in asked:
                        begin, end = one["start"], one["start"] + one["words"]
                        named = one["minimizer"], one["content"]
                        if not one["spread"]:
                            out.append((one["minimizer"] % shards, *named, 0, one["copies"],
                                        b" ".join(words[begin:end])))
                            continue
                        for at in range(begin, end - length + 1):
                            body = b" ".join(words[at:at + length])
                            shard = int.from_bytes(hashlib.md5(body).digest()[:7]) % shards
                            out.append((shard, *named, at - begin, one["copies"], body))
                    if len(out) > 5000:
                        yield packed(out)
                        out = []
                if out:
                    yield packed(out)

    return rows.mapInArrow(read, SEGMENT)


SEGMENT = "shard int, minimizer long, content long, begin int, copies int, body binary"
SEGMENT_TYPES = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
SEGMENT_NAMES = ["shard", "minimizer", "content", "begin", "copies", "body"]


def packed(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(column, kind) for column, kind in zip(zip(*rows), SEGMENT_TYPES)], SEGMENT_NAMES)


def intervals_in(bodies: list[bytes], copies: list[int], length: int) -> list[list[tuple]]:
    """Of each distinct segment of a shard, the intervals of words that lie in windows with two or
    more occurrences among all of them. ``copies`` is 2 for what occurs more than once."""
    numbers: dict[bytes, int] = {}
    parts, begins, ends, at = [], [], [], 0
    zero = np.zeros(1, dtype=np.int64)
    for body in bodies:
        words = body.split()
        ids = np.fromiter((numbers.setdefault(w, len(numbers) + 1) for w in words), np.int64,
                          len(words))
        begins.append(at)
        ends.append(at + len(ids))
        parts += [ids, zero]
        at += len(ids) + 1
    for number in [i for i, c in enumerate(copies) if c > 1]:
        parts += [parts[2 * number], zero]
    text = np.concatenate(parts)
    begins, ends = np.array(begins), np.array(ends)
    known = FMIndex(text).matching_statistics(text, begins, ends)[:at]
    hits = np.flatnonzero(known >= length)
    found: list[list[tuple]] = [[] for _ in bodies]
    for hit, of in zip(hits.tolist(), (np.searchsorted(begins, hits, side="right") - 1).tolist()):
        begin = hit - int(begins[of])
        if found[of] and found[of][-1][1] >= begin:
            begin = found[of].pop()[0]
        found[of].append((begin, hit - int(begins[of]) + length))
    return found


def searched(segments: DataFrame, length: int, shards: int) -> DataFrame:
    """minimizer, content and the repeated intervals of each candidate that has any."""
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, names, bodies, copies, answers = None, [], [], [], []

        def solved() -> pa.RecordBatch:
            intervals = intervals_in(bodies, copies, length)
            rows = [(*name, begin + low, begin + high) for name, begin, which in names
                    for low, high in intervals[which]]
            columns = list(zip(*rows)) or [()] * 4
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()),
                 pa.array(columns[2], pa.int32()), pa.array(columns[3], pa.int32())],
                ["minimizer", "content", "low", "high"])

        for batch in batches:
            columns = [batch.column(x).to_pylist() for x in SEGMENT_NAMES]
            for shard, minimizer, content, begin, times, body in zip(*columns):
                if shard != last:
                    if bodies:
                        yield solved()
                    last, names, bodies, copies = shard, [], [], []
                name = (minimizer, content)
                if bodies and bodies[-1] == body:
                    # The same words again: rows of one segment from rows that repeat as a whole,
                    # or one window of several segments, which then occurs twice at least.
                    if names[-1][:2] == (name, begin):
                        continue
                    copies[-1] = 2
                else:
                    bodies.append(body)
                    copies.append(times)
                names.append((name, begin, len(bodies) - 1))
        if bodies:
            yield solved()

    return segments.repartitionById(shards, F.col("shard")).sortWithinPartitions(
        "shard", "body", "minimizer", "content", "begin").mapInArrow(
            search, "minimizer long, content long, low int, high int")


def joined(docs: DataFrame, other: DataFrame, how: str) -> DataFrame:
    """Documents with what is known of them. Ids may be null; the shuffle of the texts is the same
    wherever they are joined, so Spark makes it once."""
    other = other.withColumnsRenamed({"doc_id": "other_id", "uid": "other_uid"})
    return docs.join(other, F.col("uid").eqNullSafe(F.col("other_uid"))
                     & F.col("doc_id").eqNullSafe(F.col("other_id")), how).drop(
                         "other_id", "other_uid")


def repeated_spans(docs: DataFrame, key: str = "doc_id", text: str = "text",
                   length: int = LENGTH, gram: int = GRAM,
                   shard_words: int = SHARD_WORDS) -> DataFrame:
    """Documents (doc_id, uid, text) with ``spans``: the intervals of words (low, high) that lie in
    a window of ``length`` words whose sequence also starts elsewhere, in order, null if none.

    Words are ``[^\\x20\\x09-\\x0D]+``, unchanged; a null text has none; windows of the same document
    count, and so do those of repeated rows. Texts of any length are read whole; an empty table
    gives an empty result; a null id is carried; other columns are not read.
    """
    if not 2 * gram <= length <= KNOWN:
        raise ValueError(f"windows of {2 * gram} to {KNOWN} words")
    refs = saved(references(docs, key, text, length, gram, frequent_grams(docs, text, gram)),
                 "references")
    asked = saved(candidates(refs), "candidates")
    total = asked.agg(F.sum(F.col("words") * F.least("n", F.lit(2)))).first()[0] or 0
    shards = max(1, -(-total // shard_words))
    texts = docs.select(*identity(key, text))
    hits = searched(read_segments(texts, asked, length, shards, shard_words), length, shards)
    answers = hits.groupBy("minimizer", "content").agg(
        F.collect_list(F.struct("low", "high")).alias("hits"))
    # A segment that very many documents share is answered to them by several tasks.
    answers = answers.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = refs.select("doc_id", "uid", "start", "minimizer", "content",
                         F.pmod(F.xxhash64("uid", "start"), F.lit(SALTS)).cast("int").alias("salt"))
    spans = salted.join(answers, ["minimizer", "content", "salt"]).select(
        "doc_id", "uid", F.transform("hits", lambda h: F.struct(
            (F.col("start") + h["low"]).alias("low"),
            (F.col("start") + h["high"]).alias("high"))).alias("part"))
    spans = spans.groupBy("doc_id", "uid").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("part")))).alias("spans"))
    return joined(texts, spans, "left")


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text",
                    length: int = LENGTH, **options: int) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, and kept, the words outside all
    repeated windows, joined by one space. See ``repeated_spans``."""
    rows = repeated_spans(docs, key, text, length, **options).select("doc_id", "text", "spans")
    kind = rows.schema["doc_id"].dataType.simpleString()

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                counts, removed, kept = [], [], []
                for text, spans in zip(batch.column("text"), batch.column("spans").to_pylist()):
                    words, left, at = text.as_py().encode().split(), [], 0
                    for span in spans or ():
                        left += words[at:span["low"]]
                        at = max(at, span["high"])
                    left += words[at:]
                    counts.append(len(words))
                    removed.append(len(words) - len(left))
                    kept.append(b" ".join(left).decode())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(counts, pa.int64()),
                     pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                    ["doc_id", "n_words", "n_removed", "kept"])

    return rows.mapInArrow(keep, f"doc_id {kind}, n_words long, n_removed long, kept string")


def digests(kept: DataFrame) -> DataFrame:
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


QUERY_SQL = r"""
WITH split AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS list
  FROM documents),
words AS (
  SELECT doc_id, unnest(list) AS word, unnest(range(len(list))) AS place, len(list) AS n FROM split),
hashed AS (
  SELECT doc_id, place, md5(array_to_string(list_slice(list, place + 1, place + 35), ' ')) AS body
  FROM (SELECT doc_id, list, unnest(range(len(list) - 34)) AS place FROM split)),
repeated AS (
  SELECT doc_id, place FROM hashed
  WHERE body IN (SELECT body FROM hashed GROUP BY body HAVING count(*) > 1)),
covered AS (
  SELECT w.doc_id, w.place, w.word, w.n,
         max(r.place) OVER (PARTITION BY w.doc_id ORDER BY w.place) >= w.place - 34 AS gone
  FROM words w LEFT JOIN repeated r ON r.doc_id = w.doc_id AND r.place = w.place),
kept AS (
  SELECT doc_id, count(*) AS n_words, count(*) FILTER (WHERE gone) AS n_removed,
         string_agg(word, ' ' ORDER BY place) FILTER (WHERE gone IS NOT TRUE) AS kept
  FROM covered GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM documents d LEFT JOIN kept k USING (doc_id)
"""
