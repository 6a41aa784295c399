"""BPE encoding and decoding with word ends, by a contiguous rank array per word.

The vocabulary file is read, never copied: lower-cased words and single digits, each a sequence of
byte symbols of which the last carries the word end. Merging holds a word's part boundaries and the
rank of each adjacent pair; it scans for the least rank, deletes that boundary and refreshes the
two neighbouring ranks. Words of more than ``SCAN_LIMIT`` parts use a heap instead of the scan,
with the same result in n log n steps.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, normalizers, pre_tokenizers

from postflow.llm.batches import slices, texts_of

NO_RANK = 1 << 60
SCAN_LIMIT = 64
# Distinct words that a task remembers; beyond that it begins anew.
CACHE_WORDS = 150_000
# No combining mark, and no letter without a name, comes before.
FIRST_DOUBTFUL = "\u0300"


def byte_symbols() -> list[str]:
    """One printable character for each byte: itself if it is visible Latin-1, else from 256 up."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return [chr(b) if b in visible else chr(next(others)) for b in range(256)]


class WordBpe:
    """Encoder and decoder for a tokenizer file of this kind."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, steps = spec["model"], spec["pre_tokenizer"]["pretokenizers"]
        if model["type"] != "BPE" or not steps[0]["invert"] or spec["decoder"]:
            raise ValueError(f"{path}: not a BPE file with word ends")
        ids, end = model["vocab"], model["end_of_word_suffix"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        # Ranks by the ids of two adjacent parts, and the part that each rank makes.
        self.ranks = {(ids[a], ids[b]): rank for rank, (a, b) in enumerate(pairs)}
        self.made = [ids[a + b] for a, b in pairs]
        symbols = byte_symbols()
        self.inner = [ids[x] for x in symbols]
        self.final = [ids[x + end] for x in symbols]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.marks = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        self.words = regex.compile(steps[0]["pattern"]["Regex"])
        self.doubtful = regex.compile(f"[{newer_letters()}\\p{{M}}]")
        # The library's own steps, for texts whose characters its Unicode tables and this Python's
        # may take differently: newer letters, and marks that combine and change places.
        self.library_normal = normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()])
        self.library_words = pre_tokenizers.Split(
            Regex(steps[0]["pattern"]["Regex"]), "removed", invert=True)
        names = {**ids, **self.special}
        self.names = np.full(max(names.values()) + 1, None, dtype=object)
        for name, number in names.items():
            self.names[number] = name
        self.gaps = len(set(names.values())) < len(self.names)
        self.known: dict[str, bytes] = {}

    def encode(self, text: str) -> bytes:
        """The text's ids as little-endian 32-bit numbers."""
        if "<|" not in text:
            return b"".join(map(self.word, self.split(text))) if text else b""
        return b"".join(
            array("i", [self.special[part]]).tobytes() if part in self.special
            else b"".join(map(self.word, self.split(part)))
            for part in self.marks.split(text))

    def split(self, text: str) -> list[str]:
        """Words of a text, normalised."""
        if text.isascii() or max(text) < FIRST_DOUBTFUL or not self.doubtful.search(text):
            return self.words.findall(normal(text))
        text = self.library_normal.normalize_str(text)
        return [word for word, _ in self.library_words.pre_tokenize_str(text)]

    def word(self, word: str) -> bytes:
        found = self.known.get(word)
        if found is None:
            if len(self.known) >= CACHE_WORDS:
                self.known.clear()
            raw = word.encode()
            parts = [self.inner[x] for x in raw]
            parts[-1] = self.final[raw[-1]]
            merged = self.scanned(parts) if len(parts) <= SCAN_LIMIT else self.heaped(parts)
            found = self.known[word] = array("i", merged).tobytes()
        return found

    def scanned(self, parts: list[int]) -> list[int]:
        """The parts after all merges. ``ranks[i]`` belongs to the boundary between parts i and
        i + 1; the boundary of the least rank goes, and its neighbours' ranks are refreshed."""
        rank_of, made = self.ranks.get, self.made
        ranks = [rank_of(pair, NO_RANK) for pair in zip(parts, parts[1:])]
        while ranks:
            least = min(ranks)
            if least == NO_RANK:
                break
            at = ranks.index(least)
            parts[at] = made[least]
            del parts[at + 1], ranks[at]
            if at:
                ranks[at - 1] = rank_of((parts[at - 1], parts[at]), NO_RANK)
            if at < len(ranks):
                ranks[at] = rank_of((parts[at], parts[at + 1]), NO_RANK)
        return parts

    def heaped(self, parts: list[int]) -> list[int]:
        """The same for long words: boundaries in a heap by rank and place, outdated ones skipped."""
        count = len(parts)
        after, before = list(range(1, count + 1)), list(range(-1, count - 1))
        heap = []

        def push(at: int) -> None:
            if at >= 0 and after[at] < count:
                rank = self.ranks.get((parts[at], parts[after[at]]), NO_RANK)
                if rank < NO_RANK:
                    heapq.heappush(heap, (rank, at, parts[at], parts[after[at]]))

        for at in range(count - 1):
            push(at)
        while heap:
            rank, at, left, right = heapq.heappop(heap)
            gone = after[at]
            if parts[at] != left or gone >= count or parts[gone] != right:
                continue
            parts[at], parts[gone] = self.made[rank], -1
            after[at] = after[gone]
            if after[at] < count:
                before[after[at]] = at
            push(before[at])
            push(at)
        return [x for x in parts if x >= 0]

    def decode(self, ids: np.ndarray) -> str:
        """Tokens joined by spaces, as a file without a decoder means; unknown ids are left out."""
        if len(ids) and (self.gaps or ids.min() < 0 or ids.max() >= len(self.names)):
            names = self.names[ids[(ids >= 0) & (ids < len(self.names))]]
            return " ".join(x for x in names.tolist() if x is not None)
        return " ".join(self.names[ids].tolist())


@lru_cache(maxsize=1)
def newer_letters() -> str:
    """Letters and numbers of the regex module that this Python's (older) Unicode tables lack, so
    that libraries may differ about them, as ranges of a character class."""
    both = regex.compile(r"[\p{L}\p{N}]")
    ranges: list[list[int]] = []
    for code in range(ord(FIRST_DOUBTFUL), 0x110000):
        if not 0xD800 <= code < 0xE000 and unicodedata.category(chr(code)) == "Cn" \
                and both.match(chr(code)):
            if ranges and ranges[-1][1] == code - 1:
                ranges[-1][1] = code
            else:
                ranges.append([code, code])
    return "".join(f"{chr(a)}-{chr(b)}" for a, b in ranges)


def normal(text: str) -> str:
    """Composed, and lower-cased letter by letter: a sigma at a word's end is no special case."""
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


@lru_cache(maxsize=2)
def loaded(path: str) -> WordBpe:
    """One per Python worker: workers serve many tasks."""
    return WordBpe(path)


def encode_texts(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and ids (array of int) for each row of ``docs``.

    Whole texts of any length are encoded; a null counts as empty and an empty text has no ids;
    strings of special tokens become those tokens; repeated rows are encoded each; an empty table
    gives an empty result. Other columns are not read.
    """
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path)
        for whole in batches:
            for batch in slices(whole, "text"):
                parts = [bpe.encode(x) for x in texts_of(batch, "text")]
                ends = np.cumsum([0, *(len(x) // 4 for x in parts)], dtype=np.int32)
                ids = pa.array(np.frombuffer(b"".join(parts), dtype="<i4"))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(ends), ids)],
                    ["doc_id", "ids"])

    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(encode, f"doc_id {kind}, ids array<int>")


def decode_ids(encoded: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """doc_id, ids and decoded text of each row; null ids count as none."""
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path)
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                part = batch.slice(begin, 256)
                texts = [bpe.decode(x.values.to_numpy(zero_copy_only=False)) if x.is_valid else ""
                         for x in part.column("ids")]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("ids"), pa.array(texts, pa.string())],
                    ["doc_id", "ids", "decoded"])

    rows = encoded.select(F.col(key).alias("doc_id"), F.col(ids).alias("ids"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(decode, f"doc_id {kind}, ids array<int>, decoded string")


def digests(decoded: DataFrame) -> DataFrame:
    """The contract's figures, from ids and decoded texts."""
    written = F.array_join(F.col("ids").cast("array<string>"), " ")
    return decoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(written, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
