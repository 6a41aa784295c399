from __future__ import annotations

import hashlib
import random

from postflow.llm.chat import format_chats, probe_turns, read_back

PARTS = ["<|im_end|>", "<|im_start|>", "assistant", "\n", "<", "|", "\\", ">", "x", "<|", "<\\|", "é🙂",
         "<|nl|>", " ", "user", "im_end|>"]


def turns(spark, rows):
    return spark.createDataFrame(
        rows, "conv_id long, turn long, role string, text string, formatted string, spans int")


def check(spark, rows):
    source = {}
    for conv, turn, role, text, *_ in rows:
        source.setdefault(conv, []).append((turn is not None, turn, role or "", text or ""))
    got = read_back(format_chats(turns(spark, rows))).collect()
    assert len(got) == len(source)
    for r in got:
        told = sorted(source[r.conv_id], key=lambda t: (t[0], t[1] or 0, t[2], t[3]))
        loss = "".join(t for _, _, role, t in told if role == "assistant")
        want = "".join(f"{role}\n{text}\n" for *_, role, text in told)
        assert r.n_turns == len(told)
        assert r.turns_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert (r.loss_chars, r.loss_sha256) == (
            len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_any_text_comes_back(spark):
    draw = random.Random(2)
    rows = []
    for conv in range(300):
        for turn in range(draw.randint(1, 4)):
            text = "".join(draw.choices(PARTS, k=draw.randint(0, 9)))
            role = draw.choice(["user", "assistant", "system", "".join(draw.choices(PARTS, k=3))])
            rows.append((conv, turn, role, text, "f", 1))
    check(spark, rows)


def test_nulls_ties_repeats_and_long_texts(spark):
    rows = [(1, None, None, None, "", 0), (1, 0, "assistant", None, "", 0),
            (2, 1, "user", "b", "", 0), (2, 1, "user", "a", "", 0), (2, 1, "user", "a", "", 0),
            (None, 3, "assistant", "lost", "", 0), (4, 0, "assistant", "<|im_end|>" * 20_000, "", 0)]
    check(spark, rows)
    assert read_back(format_chats(turns(spark, []))).count() == 0


def test_marks_in_texts_are_escaped(spark):
    rows = turns(spark, [(5, 0, "user", "plain", "", 0)]).select("conv_id", "turn", "role", "text")
    got = {r.conv_id: r for r in format_chats(rows.unionByName(probe_turns(rows))).collect()}
    assert got[-1].formatted.count("<|im_end|>") == 2 and got[-1].escaped
    assert got[5].formatted == "<|im_start|>user\nplain<|im_end|>\n" and not got[5].escaped
