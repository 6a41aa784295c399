from __future__ import annotations

import random

import numpy as np
import xxhash
from cases import TEXTS, documents, words

from postflow.llm.simhash import components, fingerprint, links, near_duplicates, one_of_each


def slow_fingerprint(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    split = [w for w in "".join(" " if c in " \t\n\x0b\f\r" else c for c in low).split(" ") if w]
    grams = [" ".join(split[i:i + 3]) for i in range(max(1, len(split) - 2))] if split else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows):
    """doc_id, fingerprint and component of (doc_id, text)."""
    prints = [(key, slow_fingerprint(text)) for key, text in rows]
    groups = [{i} for i in range(len(prints))]
    for i, (_, a) in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j][1]).bit_count() <= 3 and groups[i] is not groups[j]:
                groups[j] |= groups[i]
                for k in groups[i]:
                    groups[k] = groups[j]
    def name(group):
        return min((prints[k][0] for k in group if prints[k][0] is not None), default=None)
    return sorted(((key, f"{p:016x}", name(groups[i])) for i, (key, p) in enumerate(prints)), key=repr)


def near_copies(seed, count):
    draw = random.Random(seed)
    base = words(seed, 120).split()
    out = []
    for _ in range(count):
        copy = base[:]
        for _ in range(draw.randrange(3)):
            copy[draw.randrange(len(copy))] = "changed"
        out.append(" ".join(copy))
    return out


def test_tables(spark):
    docs = documents(spark, TEXTS + near_copies(1, 40) + near_copies(2, 9) + [words(9, 50)] * 12)
    got = near_duplicates(docs).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(
        [(r.doc_id, r.text) for r in docs.collect()])


def test_links_lose_no_pair(spark):
    draw = random.Random(3)
    cloud = set()
    for _ in range(25):
        center = draw.getrandbits(64)
        for _ in range(50):
            cloud.add(center ^ sum(1 << b for b in draw.sample(range(64), draw.randrange(5))))
    prints = np.array(sorted(cloud), dtype=np.uint64)
    frame = spark.createDataFrame([(int(x),) for x in prints.view(np.int64)], "fp long")
    near = np.bitwise_count(prints[:, None] ^ prints[None, :])
    for bits in (1, 2, 3):
        want = {tuple(sorted((int(a), int(b)))) for a, b in zip(
            *(prints.view(np.int64)[i] for i in np.nonzero(np.triu(near <= bits, 1))))}
        assert {tuple(r) for r in links(frame, bits).collect()} == want


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 140)] + [(7, 9), (200, 201)]
    frame = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.root for r in components(frame).collect()}
    want = {i: 0 for i in range(1, 61)} | {i: 100 for i in range(101, 140)} | {201: 200}
    assert got == want


def test_one_of_each_and_no_rows(spark):
    docs = documents(spark, near_copies(4, 30) + [words(8, 90)])
    kept = one_of_each(docs)
    assert kept.columns == docs.columns
    names = {c for _, _, c in brute([(r.doc_id, r.text) for r in docs.collect()])}
    assert {r.doc_id for r in kept.collect()} == names
    assert near_duplicates(documents(spark, [])).count() == 0
    assert fingerprint("") == 0


def test_one_row_of_each_component_where_ids_repeat(spark):
    """Ids that repeat, also with other texts, and ids that are null."""
    a, b, c = (words(seed, 60) for seed in (11, 12, 13))
    rows = [(3, a), (7, b), (7, a), (None, c), (None, c), (None, a), (7, b)]
    draw = random.Random(6)
    texts = [words(seed, 40) for seed in range(20, 40)]
    many = [(draw.choice([None, 1, 2, 3]), draw.choice(texts)) for _ in range(300)]
    for table, stay in ((rows, {(3, a), (7, b), (None, c)}), (many, None)):
        frame = spark.createDataFrame(table, "doc_id long, text string")
        kept = [tuple(r) for r in one_of_each(frame).collect()]
        if stay is None:
            stay = {(min((i for i, x in table if x == t and i is not None), default=None), t)
                    for _, t in table}
        assert len(kept) == len(stay) and set(kept) == stay
