from __future__ import annotations

import math
import zlib

import zstandard
from cases import DATA, TEXTS, documents

from postflow.llm import quality_model
from postflow.llm.quality_model import fitted, keep_good, quality_scores, sample, scores, trained


def read(spark, name, size="sf0.1"):
    return spark.read.parquet(str(DATA / size / f"{name}.parquet"))


def test_accuracy_on_the_held_out_fold(spark):
    docs, labels = read(spark, "documents"), read(spark, "labels")
    scores = quality_scores(docs, trained(docs, labels))
    rows = scores.join(labels, "doc_id").filter("held_out").collect()
    assert all((zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    good, bad = ([r for r in rows if r.quality == q] for q in (1, 0))
    assert len(good) > 400 and len(bad) > 50
    assert sum(r.predicted for r in good) / len(good) > 0.97
    assert sum(r.predicted for r in bad) / len(bad) < 0.15


def test_every_kind_of_text(spark):
    docs, labels = read(spark, "documents", "sf0.01"), read(spark, "labels", "sf0.01")
    model = trained(docs, labels)
    mixed = documents(spark)
    rows = quality_scores(mixed, model).collect()
    assert len(rows) == len(TEXTS) + 2
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    by_id = {r.doc_id: r.score for r in rows}
    assert by_id[0] == by_id[1]
    kept = keep_good(mixed, model)
    assert kept.columns == mixed.columns
    assert kept.count() == sum(r.predicted for r in rows)
    assert quality_scores(documents(spark, []), model).count() == 0


def test_nothing_to_learn_from(spark):
    labels = read(spark, "labels", "sf0.001")
    model = trained(documents(spark), labels.limit(0))
    assert {r.score for r in quality_scores(documents(spark), model).collect()} == {1.0}
    assert fitted([(0, 1, "a", 3), (1, 0, "b", 1)]).constant == 0.75


def test_one_text_per_sampled_id(spark):
    ids = [i for i in range(40) if zlib.crc32(str(i).encode()) % 4 != 2]
    labels = spark.createDataFrame([(i, i % 2) for i in ids], "doc_id long, quality int")
    rows = [(i, f"text {i}") for i in ids] + [(ids[0], f"copy {n % 3}") for n in range(500)]
    found = sample(spark.createDataFrame(rows, "doc_id long, text string"), labels)
    assert len(found) == len(ids)


def test_sampled_blocks_come_from_the_whole_text(spark):
    ids = [i for i in range(40) if zlib.crc32(str(i).encode()) % 4 != 2]
    labels = spark.createDataFrame([(i, i % 2) for i in ids], "doc_id long, quality int")
    long = {i: "".join(f"{n:07d}é" for n in range(5000)) for i in ids}  # 45,000 bytes
    short = {i: f"é{i} " * 1500 for i in ids[:5]}  # at most 7,500 bytes: whole
    texts = {**long, **short}
    found = sample(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), labels)
    assert len(found) == len(ids)
    whole = {t.encode() for t in short.values()}
    assert whole <= {r[2] for r in found}
    data = long[ids[-1]].encode()
    cut = {data[i:i + 1024]: i for i in range(0, len(data), 1024)}
    begins = []
    for r in found:
        if r[2] not in whole:
            places = [i for b, i in cut.items() if b in r[2]]
            assert len(places) == 8 and places == sorted(places)
            begins += places
    assert len(set(begins)) > 35 and max(begins) > 43_000


def test_few_labels_still_tell_texts_apart():
    """Too few blocks to train on: the texts themselves are the dictionaries, also where the hash
    put all texts of a class into one part."""
    good = [f"The committee met on day {i} and agreed on the plan for the new library." for i in range(6)]
    bad = [f"WIN CASH NOW!!! click {i} here for cheap pills and free bets $$$ casino" for i in range(6)]
    for parts in ((0, 1), (0, 0), (1, 1)):
        model = fitted([(parts[i % 2], q, t, 6) for q, texts in ((1, good), (0, bad))
                        for i, t in enumerate(texts)])
        assert model.constant is None
        found = scores(model, ["The committee met on day 9 and agreed on the plan for the new park.",
                               "WIN CASH NOW!!! click 9 here for cheap pills and free bets $$$ poker"])
        assert found[0] > 0.6 > 0.4 > found[1]


def test_texts_that_cannot_be_trained_on():
    assert fitted([(p, q, t, 2) for p in (0, 1) for q, t in ((0, "a"), (1, "b"))]).constant is None
    assert fitted([(p, q, "", 2) for p in (0, 1) for q in (0, 1)]).constant == 0.5
    same = fitted([(i % 2, q, f"{q}" * 900, 60) for q in (0, 1) for i in range(60)])
    assert same.constant is None


def test_a_score_from_its_parts(spark):
    """Scores computed anew from the model's dictionaries, slope and shift, byte by byte."""
    docs = spark.read.parquet(str(DATA / "sf0.01/documents.parquet"))
    model = quality_model.trained(docs, spark.read.parquet(str(DATA / "sf0.01/labels.parquet")))
    packers = []
    for data in (model.good, model.bad):
        held = zstandard.ZstdCompressionDict(data)
        held.precompute_compress(level=quality_model.LEVEL)
        packers.append(zstandard.ZstdCompressor(
            level=quality_model.LEVEL, dict_data=held, write_content_size=False,
            write_checksum=False, write_dict_id=False))
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    for row in quality_model.quality_scores(docs, model).collect():
        data, sizes = texts[row.doc_id].encode(), [0, 0]
        for at in range(0, len(data), quality_model.BLOCK):
            for side, packer in enumerate(packers):
                sizes[side] += len(packer.compress(data[at:at + quality_model.BLOCK]))
        prior = quality_model.PRIOR_BYTES
        x = (sizes[0] - sizes[1] + model.usual * prior) / (len(data) + prior)
        z = max(-30.0, min(30.0, model.slope * x + model.shift))
        assert abs(row.score - 1 / (1 + math.exp(-z))) < 1e-9
        assert row.predicted == int(row.score >= 0.7)
