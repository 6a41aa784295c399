from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from cases import LONG, documents, rows_of

from postflow.llm import merkle, sha_midstate

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def told(*values) -> str:
    return hashlib.sha256("".join(values).encode()).hexdigest()


def leaf(row) -> str:
    return told(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def climbed(nodes, proofs):
    """The root over ``nodes``; each proof list (one per node) grows by the node's siblings."""
    under = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        above, held = [], []
        for at in range(0, len(nodes), 2):
            run = nodes[at:at + 2]
            for slot, members in enumerate(under[at:at + 2]):
                for i in members:
                    proofs[i].append((run[:slot], run[slot + 1:]))
            above.append(told(*run))
            held.append(sum(under[at:at + 2], []))
        nodes, under = above, held
    return nodes[0]


def brute(rows, tamper=True):
    groups = defaultdict(list)
    for row in rows:
        doc, source, lang, chars, text = row
        bad = tamper and doc is not None and zlib.crc32(str(doc).encode()) % 7 == 0
        other = (doc, source, lang, chars + 1 if bad and chars is not None else chars, text)
        groups[lang].append((doc, leaf(row), leaf(other)))
    order = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    proofs, subroots = {}, []
    for lang in order:
        groups[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        proofs[lang] = [[] for _ in groups[lang]]
        subroots.append(climbed([r[1] for r in groups[lang]], proofs[lang]))
    upper = [[] for _ in order]
    root = climbed(subroots, upper)
    out = []
    for lang, subroot, rest in zip(order, subroots, upper):
        for (doc, own, folded), path in zip(groups[lang], proofs[lang]):
            siblings = "".join("".join(a + b) for a, b in path + rest)
            for left, right in path + rest:
                folded = told(*left, folded, *right)
            out.append((doc, own, subroot, root, told(siblings), folded, folded == root))
    return sorted(out, key=repr)


def found(spark, rows, levels=merkle.LEVELS):
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS grp", "1 AS digest", "2 AS idx")
    return sorted(rows_of(merkle.manifest(frame, merkle.contract_tampering(),
                                           levels)), key=repr)


def test_states_resume():
    digests = [hashlib.sha256(bytes([i])).digest() for i in range(9)]
    words = sha_midstate.words_of(digests)
    state = sha_midstate.compressed(sha_midstate.initial(9), sha_midstate.hex_blocks(words))
    both = sha_midstate.compressed(state, sha_midstate.hex_blocks(words[::-1]))
    for blocks, held, text in ((1, state, lambda i: digests[i].hex()),
                               (2, both, lambda i: digests[i].hex() + digests[8 - i].hex())):
        ends = sha_midstate.raw(sha_midstate.finished(held, np.full(9, blocks)))
        assert [e.tobytes() for e in ends] == [
            hashlib.sha256(text(i).encode()).digest() for i in range(9)]


@pytest.mark.parametrize("fanout", [2, 3, 5])
def test_forest_folds_any_fanout(fanout):
    draw = random.Random(fanout)
    sizes = [1, 2, 3, fanout, fanout + 1, 40]
    digests = [draw.randbytes(32) for _ in range(sum(sizes))]
    block = np.repeat(np.arange(len(sizes)), sizes)
    place = np.concatenate([np.arange(s) for s in sizes])
    levels = np.array([merkle.level_count(sizes[b], fanout=fanout) for b in block])
    forest = merkle.Forest(sha_midstate.words_of(digests), block, place, levels, fanout)
    assert len(forest.tops) == len(sizes)
    same = forest.folded(sha_midstate.words_of(digests))
    assert (same == forest.tops[block]).all()
    paths = [merkle.written_path(p) for p in forest.paths()]
    again = merkle.resumed(sha_midstate.words_of(digests), np.arange(len(digests)), paths)
    assert (again == same).all()
    assert [merkle.proof_text(p) for p in paths] == forest.proofs()
    other = forest.folded(sha_midstate.words_of([bytes(32)] * len(digests)))
    assert (other != same).any(axis=1).all()


def test_every_kind_of_row(spark):
    rows = [(i, "s", x, i, t) for i, (x, t) in enumerate(
        [("en", "a"), ("en", None), (None, "b"), ("", "c"), ("é", LONG), ("zz", ""), ("\U0001f642", "d"),
         ("￮", "e"), ("en", "f\n\x00")])]
    rows += [(None, None, None, None, None), (7, None, "en", None, "n"), rows[0], rows[0],
             (-5, "s", "en", 3, "minus"), (None, "x", "en", 1, "y")]
    rows += [(draw, "s", "de", draw, f"t{draw}") for draw in random.Random(1).sample(range(10_000), 300)]
    assert found(spark, rows) == brute(rows)


@pytest.mark.parametrize("size", [1, 2, 7, 8, 9, 64, 65, 200])
def test_blocks_meet_in_tiers(spark, size):
    """Blocks of eight leaves, so that some groups need three tiers."""
    rows = [(i, "s", "en", i, str(i)) for i in range(size)]
    rows += [(1000 + i, "s", f"l{i}", i, str(i)) for i in range(size // 4)]
    assert found(spark, rows, 3) == brute(rows)


def test_clashing_columns_and_no_rows(spark):
    docs = documents(spark)
    want = brute(rows_of(docs.select("doc_id", "source", "lang", "n_chars", "text")), tamper=False)
    assert sorted(rows_of(merkle.manifest(docs)), key=repr) == want
    assert all(r[6] for r in want)
    assert merkle.manifest(documents(spark, [])).count() == 0


def test_kept_manifest_verifies_blocks(spark):
    rows = [(i, "s", "en" if i % 2 else None, i, str(i)) for i in range(50)]
    kept = merkle.block_paths(spark.createDataFrame(rows, SCHEMA)).collect()
    root = brute(rows, tamper=False)[0][3]
    assert {r.lang for r in kept} == {"en", None}
    for row in kept:
        top = merkle.resumed(sha_midstate.words_of([row.subroot]), np.array([0]),
                             [[s.asDict() for s in row.path]])
        assert sha_midstate.raw(top)[0].tobytes().hex() == root == row.root.hex()
