from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from cases import LONG, TEXTS, documents, rows_of, words

from postflow.llm import fm_index, substring_dedup
from postflow.llm.substring_dedup import LENGTH, digests, without_repeats


def brute(rows, length=LENGTH):
    split = [(key, (text or "").encode().split()) for key, text in rows]
    seen = Counter(tuple(w[i:i + length]) for _, w in split for i in range(len(w) - length + 1))
    out = []
    for key, w in split:
        gone = set()
        for i in range(len(w) - length + 1):
            if seen[tuple(w[i:i + length])] > 1:
                gone.update(range(i, i + length))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((key, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def passages(seed: int, count: int) -> list[str]:
    """Texts with shared passages of 20 to 90 words, copies, repeats inside and periodic stretches."""
    draw = random.Random(seed)
    shared = [words(1000 + seed + i, draw.choice([20, 34, 35, 36, 60, 90])) for i in range(6)]
    texts = []
    for i in range(count):
        parts = [words(seed * 7919 + 31 * i + j, draw.randint(0, 60)) for j in range(3)]
        parts += draw.sample(shared, draw.randint(0, 2))
        if draw.random() < 0.1:
            parts.append(" ".join(["a b c"] * draw.randint(1, 60)))
        if draw.random() < 0.1:
            parts += [parts[0], parts[0]]
        draw.shuffle(parts)
        texts.append(draw.choice([" ", "\n", " \t "]).join(parts))
        if draw.random() < 0.1:
            texts.append(texts[-1])
    return texts


def check(spark, docs, **options):
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert sorted(rows_of(digests(without_repeats(docs, **options))), key=repr) == want


def test_index_equals_plain_search():
    draw = random.Random(3)
    for _ in range(60):
        parts = []
        for _ in range(draw.randint(1, 10)):
            most = draw.choice([1, 2, 9])
            parts.append([draw.randint(1, most) for _ in range(draw.choice([1, 7, 30, 90]))])
        text = np.array(sum([p + [0] for p in parts], []), dtype=np.int64)
        ends = np.flatnonzero(text == 0)
        begins = np.concatenate([[0], ends[:-1] + 1])
        index = fm_index.FMIndex(text)
        for least in (1, 2):
            found = index.matching_statistics(text, begins, ends, least)
            for part, begin in zip(parts, begins):
                for i in range(len(part)):
                    best = max((n for n in range(1, len(part) - i + 1) if sum(
                        q[j:j + n] == part[i:i + n] for q in parts
                        for j in range(len(q) - n + 1)) >= least), default=0)
                    got = int(found[begin + i])
                    assert got == best or fm_index.KNOWN <= got <= best


def test_every_kind_of_text(spark):
    check(spark, documents(spark))
    check(spark, documents(spark, [LONG + words(1, 40), *TEXTS, "one " * 20_000, " \n" * 50_000]))


@pytest.mark.parametrize("options", [{}, {"shard_words": 500}, {"gram": 2}, {"shard_words": 60}])
def test_passages_equal_brute_force(spark, options):
    texts = passages(len(options), 150)
    check(spark, documents(spark, texts, random.Random(1).sample(range(10_000), len(texts))),
          **options)


def test_frequent_passage_in_a_third_of_all(spark):
    line = words(9, 45)
    texts = [f"{words(2 * i, 30)} {line if i % 3 == 0 else ''} {words(2 * i + 1, 30)}"
             for i in range(600)]
    docs = documents(spark, texts)
    assert len(substring_dedup.frequent_grams(docs, "text", substring_dedup.GRAM)) == 38
    check(spark, docs)
    check(spark, docs, shard_words=1000)


def test_length_is_a_parameter(spark):
    texts = passages(5, 40)
    docs = documents(spark, texts)
    want = brute([(r.doc_id, r.text) for r in docs.collect()], 20)
    assert sorted(rows_of(digests(without_repeats(docs, length=20))), key=repr) == want


def test_empty_table(spark):
    assert without_repeats(documents(spark, [])).count() == 0
