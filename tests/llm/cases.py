"""Small tables with everything that operators must bear."""

from __future__ import annotations

import random
from pathlib import Path

DATA = Path("/root/testdata")
CLASHES = ("fp", "rank", "salt", "body", "words", "windows", "length", "file", "block", "content",
           "points", "key", "score", "whole_row", "kept", "id", "task", "__id", "ids")
LONG = "Ein langer Text, of the und the. " * 3000
TEXTS = [None, "", " \t\n\x0b\f\r", "a", "a b", "A  b", "a b c", "a\tb\nc", "abc", LONG, LONG, LONG + " ",
         "x<|endoftext|> y", "<|im_end|>\n<|im_start|>assistant\nhi", "Σίσυφος ΟΔΥΣΣΕΥΣ İ ǅ é é",
         "日本語 テキスト 123 ½", "it's they'LL 've 2nd", "\x00\x01 nul", "🙂🙂 🙂", "a b c a b c a b c"]


def documents(spark, texts=TEXTS, ids=None):
    """Documents with columns that clash with the operators' own, a repeated row and a null id."""
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, "en", "s", 0 if t is None else len(t)) for i, t in zip(ids, texts)]
    if texts:
        rows += [rows[-1], (None, "no id of the row", None, None, None)]
    frame = spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long")
    for number, name in enumerate(CLASHES):
        frame = frame.selectExpr("*", f"'{number}' AS `{name}`")
    return frame


def words(seed: int, count: int) -> str:
    draw = random.Random(seed)
    return " ".join("".join(draw.choices("abcdefgh", k=draw.randint(1, 7))) for _ in range(count))


def rows_of(frame):
    return [tuple(r) for r in frame.collect()]
