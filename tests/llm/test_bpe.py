from __future__ import annotations

import random
import unicodedata

import numpy as np
import public_tokenizers
import pytest
from cases import TEXTS, documents
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from postflow.llm.bpe import WordBpe, decode_ids, digests, encode_texts

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def both():
    return WordBpe(PATH), Tokenizer.from_file(PATH)


def same(both, text):
    own, library = both
    want = library.encode(text, add_special_tokens=False).ids
    got = np.frombuffer(own.encode(text), dtype="<i4")
    assert got.tolist() == want
    assert own.decode(got) == library.decode(want, skip_special_tokens=False)


@given(text=st.text(max_size=60))
@settings(max_examples=400, deadline=None)
def test_any_text(both, text):
    same(both, text)


def test_words_of_every_length(both):
    draw = random.Random(3)
    for length in (1, 2, 63, 64, 65, 66, 200, 5000):
        same(both, "".join(draw.choices("abcdeé", k=length)))
        same(both, "a" * length + " " + "ing" * length)
    for code in [*range(0x3100), *range(0x3100, 0x110000, 997)]:
        if not 0xD800 <= code < 0xE000:
            same(both, f"a{chr(code)}b 1{chr(code)}2")


def test_combining_marks_in_pairs(both):
    """Every mark beside others, in both orders: the library knows other tables than Python."""
    marks = [chr(c) for c in range(0x110000) if unicodedata.category(chr(c)).startswith("M")]
    assert len(marks) > 2000
    for other in ("\u0301", "\u07fd", "\u0323"):
        for mark in marks:
            same(both, f"a{mark}{other}b a{other}{mark}b")


def test_scan_and_heap_agree(both):
    draw = random.Random(4)
    for _ in range(300):
        parts = [both[0].inner[draw.randrange(97, 104)] for _ in range(draw.randint(1, 70))]
        parts[-1] = both[0].final[100]
        assert both[0].scanned(parts[:]) == both[0].heaped(parts[:])


def test_tables(spark, both):
    docs = documents(spark)
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    rows = decode_ids(encode_texts(docs, PATH), PATH).collect()
    assert len(rows) == len(TEXTS) + 2
    for r in rows:
        want = both[1].encode(texts[r.doc_id], add_special_tokens=False).ids
        assert (list(r.ids), r.decoded) == (want, both[1].decode(want, skip_special_tokens=False))
    empty = documents(spark, [])
    assert digests(decode_ids(encode_texts(empty, PATH), PATH)).count() == 0
    unknown = spark.createDataFrame([(1, [-1, 5, 10**6]), (2, None)], "doc_id long, ids array<int>")
    assert [r.decoded for r in decode_ids(unknown, PATH).orderBy("doc_id").collect()] == [
        both[1].decode([5], skip_special_tokens=False), ""]
