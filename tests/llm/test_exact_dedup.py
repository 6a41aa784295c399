from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict

from cases import TEXTS, documents, rows_of

from postflow.llm.exact_dedup import exact_duplicates, without_duplicates


def brute(rows):
    groups = defaultdict(list)
    for key, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((key, len(text or "")))
    out = []
    for content, members in groups.items():
        keep = min(members, key=lambda m: (-m[1], m[0] is None, m[0] or 0))[0]
        sha = hashlib.sha256(content.encode()).hexdigest()
        out += [(key, keep, len(members), key == keep, sha) for key, _ in members]
    return sorted(out, key=repr)


def test_every_kind_of_text(spark):
    docs = documents(spark)
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert sorted(rows_of(exact_duplicates(docs)), key=repr) == want


def test_empty_table(spark):
    assert exact_duplicates(documents(spark, [])).count() == 0
    assert without_duplicates(documents(spark, [])).count() == 0


def test_a_third_in_one_group(spark):
    draw = random.Random(5)
    texts = ["copy of one" if i % 3 == 0 else " ".join(draw.choices("ab \n", k=5))
             for i in range(600)]
    docs = documents(spark, texts, draw.sample(range(10_000), 600))
    assert sorted(rows_of(exact_duplicates(docs)), key=repr) == brute(
        [(r.doc_id, r.text) for r in docs.collect()])


def test_rows_that_stay_keep_their_columns(spark):
    docs = documents(spark)
    stay = without_duplicates(docs)
    assert stay.columns == docs.columns
    kept = {k for k, keep, *_ in brute([(r.doc_id, r.text) for r in docs.collect()]) if k == keep}
    found = [r.doc_id for r in stay.collect()]
    assert sorted(found, key=repr) == sorted(kept, key=repr)
    assert len(found) < len(TEXTS) + 2
