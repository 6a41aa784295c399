from __future__ import annotations

import json
from pathlib import Path
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pytest
from cases import TEXTS, documents, words
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from postflow.llm import shards
from postflow.llm.shards import materialise, numbered_blocks, permuted, read_slots

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("total", [1, 2, 3, 4, 5, 16, 17, 1000, 4096, 4097])
def test_permutation_is_a_bijection(total):
    slots = permuted(np.arange(total), total)
    assert sorted(slots.tolist()) == list(range(total))
    assert total < 1000 or (slots != permuted(np.arange(total), total, seed=7)).any()


def test_shards_hold_every_sequence_at_its_slot(spark, root):
    library = Tokenizer.from_file(PATH)
    docs = documents(spark, TEXTS + [words(i, 300) for i in range(30)])
    folder = f"file://{root}/shards"
    rows = materialise(docs, PATH, folder, stride=64, per_shard=50).collect()
    total = len(rows)
    assert sorted(r.slot for r in rows) == list(range(total))
    whole = read_slots(folder, 0, total + 9)
    assert whole.shape == (total, 64)
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    ids = {k: library.encode(t, add_special_tokens=False).ids + [2] for k, t in texts.items()}
    for r in rows:
        first = len(ids[r.doc_id]) % 64 or 64
        start = 0 if r.piece == 0 else first + 64 * (r.piece - 1)
        want = ids[r.doc_id][start:start + r.length]
        assert whole[r.slot].tolist() == want + [2] * (64 - r.length)
        assert (r.shard, r.byte_offset) == (r.slot // 50, r.slot % 50 * 128)
    assert sum(r.length for r in rows) == sum(len(ids[r.doc_id]) for r in docs.collect())
    assert (read_slots(folder, 45, 120) == whole[45:165]).all()


def test_running_again_writes_the_same_bytes(spark, root):
    path = f"{root}/docs"
    documents(spark).select("doc_id", "text").write.parquet(path)
    stored = spark.read.parquet(path)
    reads = []
    for name in ("a", "b"):
        frame = materialise(stored, PATH, f"file://{root}/{name}", stored=True)
        count = frame.count()
        frame.collect()
        reads.append(read_slots(f"file://{root}/{name}", 0, count))
    assert (reads[0] == reads[1]).all() and len(reads[0])


def test_shards_of_a_task_and_the_manifest(spark, root):
    """However many shards a task writes, they are the same; no draft stays."""
    docs = documents(spark, TEXTS + [words(i, 200) for i in range(30)])
    reads = []
    for per_task in (1, 3, 100):
        folder = f"{root}/{per_task}"
        rows = materialise(docs, PATH, f"file://{folder}", stride=64, per_shard=20,
                           per_task=per_task)
        about = json.loads((Path(folder) / "manifest.json").read_text())
        names = sorted(x.name for x in Path(folder).iterdir())
        assert names == ["manifest.json"] + [f"shard-{i:06d}.bin" for i in range(about["shards"])]
        assert rows.count() == about["sequences"]
        reads.append(sorted(read_slots(f"file://{folder}", 0, about["sequences"]).tolist()))
    assert reads[0] == reads[1] == reads[2]


def test_blocks_are_numbered_without_gaps(spark):
    rows = [(i % 7, f"f{i % 40}", i, 1 + i % 5) for i in range(300)]
    counts = spark.createDataFrame(rows, "grp int, file string, block long, n long")
    sizes = {(r[1], r[2]): r[3] for r in rows}
    found = sorted((r.first, sizes[r.file, r.block]) for r in numbered_blocks(counts).select(
        "file", "block", F.col("first")).collect() for r in [SimpleNamespace(**r.asDict())])
    at = 0
    for first, n in found:
        assert first == at
        at += n
    assert at == sum(sizes.values())


def test_vocabulary_beyond_16_bits(spark, root, monkeypatch):
    monkeypatch.setattr(shards, "encoding", lambda path: SimpleNamespace(n_vocab=70_000))
    with pytest.raises(ValueError, match="16 bits"):
        materialise(documents(spark), PATH, f"file://{root}/x")


def test_empty_table(spark, root):
    assert materialise(documents(spark, []), PATH, f"file://{root}/none").count() == 0
    assert read_slots(f"file://{root}/none", 0, 5).shape == (0, 256)
