"""Byte-level BPE ids of whole texts, and documents cut into pieces of bounded length.

The ids are those of the tokenizers library for the same file. They come from tiktoken, which is
twice as fast with the same vocabulary: the file's tokens in order of their merges are its ranks.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postflow.llm.batches import slices, texts_of
from postflow.llm.bpe import byte_symbols

# Fixed value: how a byte-level tokenizer file of this kind splits texts.
PATTERN = (r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
END_ID = 2
# Unicode's white space. The pattern's look-ahead backtracks through a run of it and fails beyond a
# million characters, so runs in texts of this length are cut beforehand, as the pattern does.
SPACE_RUN = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
LONG_RUN = 100_000


@lru_cache(maxsize=2)
def encoding(path: str) -> tiktoken.Encoding:
    """One per Python worker."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    byte_of = {symbol: byte for byte, symbol in enumerate(byte_symbols())}
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    ranks = {bytes(byte_of[x] for x in token): number
             for token, number in spec["model"]["vocab"].items() if token not in special}
    merged = [spec["model"]["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)]
              for m in spec["model"]["merges"]]
    if merged != sorted(merged):
        raise ValueError(f"{path}: ids do not follow the order of the merges")
    return tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)


def long_runs(text: str) -> Iterator[tuple[int, int]]:
    """Begin and end of long runs of white space."""
    if len(text) >= LONG_RUN:
        for run in SPACE_RUN.finditer(text):
            if run.end() - run.start() >= LONG_RUN:
                yield run.span()


def encoded(bpe: tiktoken.Encoding, text: str) -> np.ndarray:
    """The ids of a text. A long run of white space is one word, less its last character where
    another word follows, as that goes with the word."""
    parts, at = [], 0
    for begin, end in long_runs(text):
        ends_there = end == len(text) or text.startswith(tuple(bpe.special_tokens_set), end)
        cut = end if ends_there else end - 1
        parts += [bpe.encode_to_numpy(text[at:begin], allowed_special="all"),
                  np.array(bpe._encode_single_piece(text[begin:cut]), dtype=np.uint32)]
        at = cut
    rest = bpe.encode_to_numpy(text[at:], allowed_special="all")
    return np.concatenate([*parts, rest]) if parts else rest


def token_ids(path: str, texts: list[str], end_id: int | None = END_ID) -> Iterator[np.ndarray]:
    """The ids of each text and the end id, as 32-bit numbers. Strings of special tokens become
    those tokens, as the tokenizers library has it. Texts may have any length and content."""
    bpe = encoding(path)
    tail = np.array([] if end_id is None else [end_id], dtype=np.uint32)
    for text in texts:
        yield np.append(encoded(bpe, text), tail).astype("<u4")


def cuts(length: int, size: int) -> list[tuple[int, int]]:
    """Start and length of pieces of ``size``; only the first may be shorter."""
    first = length % size or min(length, size)
    return [(0, first), *((at, size) for at in range(first, length, size))]


def pieces(docs: DataFrame, path: str, size: int, key: str = "doc_id",
           text: str = "text") -> DataFrame:
    """doc_id, piece, start, length and ids_crc32 of every piece of every document."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                rows, columns = [], ([], [], [], [])
                for row, ids in enumerate(token_ids(path, texts_of(batch, "text"))):
                    for piece, (start, length) in enumerate(cuts(len(ids), size)):
                        rows.append(row)
                        crc = zlib.crc32(ids[start:start + length].tobytes())
                        for column, value in zip(columns, (piece, start, length, crc)):
                            column.append(value)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(rows, pa.int64())),
                     pa.array(columns[0], pa.int32()),
                     *(pa.array(x, pa.int64()) for x in columns[1:])],
                    ["doc_id", "piece", "start", "length", "ids_crc32"])

    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        cut, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")
