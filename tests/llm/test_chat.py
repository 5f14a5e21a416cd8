"""Chat formatting: expansion and exact reading back."""

import random

from starlattice.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, example string"


def test_round_trip_with_control_strings(spark):
    rng = random.Random(1)
    bits = ["\\", "### ", "</turn>", "</turn>\n", "\n", "#", "<", "assistant: ", "\\### Assistant: </turn> ok", "é😀", "", ":", " "]
    rows = [(c, t, rng.choice(["user", "assistant", "system", None, "a: b", "x\\:"]), rng.choice([None, "".join(rng.choices(bits, k=rng.randint(0, 8)))]), "x")
            for c in range(40) for t in range(rng.randint(1, 7))]
    rows += [(None, 1, "assistant", "of no conversation", "x"), (50, None, "user", "null turn", "x"), (50, 1, "assistant", "a" * 50_000, "x")]
    rows += [(51, 1, "assistant", "tie", "x")] * 2
    examples = chat.expand(spark.createDataFrame(rows, SCHEMA))
    back = {r.conv_id: r for r in chat.read_back(examples).collect()}
    for conv in {r[0] for r in rows}:
        turns = sorted(((r[1] is not None, r[1] or 0, r[2] or "", r[3] or "") for r in rows if r[0] == conv))
        assert [(t.role, t.text) for t in back[conv].turns] == [(r, x) for *_, r, x in turns]
        assert back[conv].replies[: sum(r == "assistant" for *_, r, _ in turns)] == [x for *_, r, x in turns if r == "assistant"]
        assert "".join(back[conv].replies) == "".join(x for *_, r, x in turns if r == "assistant")


def test_only_the_last_reply_is_trained_on(spark):
    rows = [(1, 0, "user", "q1", ""), (1, 1, "assistant", "a1", ""), (1, 2, "user", "q2", ""), (1, 3, "assistant", "a2", ""), (1, 4, "user", "q3", "")]
    got = sorted(chat.expand(spark.createDataFrame(rows, SCHEMA)).collect(), key=lambda r: r.example)
    first, second, rest = got
    assert first.text == "### user: q1</turn>\n### assistant: a1</turn>\n"
    assert [r.text[r.loss_start : r.loss_start + r.loss_length] for r in got] == ["a1", "a2", ""]
    assert second.text.startswith(first.text) and rest.text.startswith(second.text)
    assert [r["last"] for r in got] == [False, False, True]


def test_no_rows(spark):
    assert chat.read_back(chat.expand(spark.createDataFrame([], SCHEMA))).count() == 0
