from __future__ import annotations

from tapeline.llm import chat

EVENTS = "conv_id bigint, seq bigint, kind string, turn bigint, role string, text string"
ROWS = "conv_id bigint, turn bigint, role string, text string, seq string"


def slow_fold(events):
    convs = {}
    for conv, _, kind, turn, role, text in sorted(events, key=lambda e: (e[0], e[1], e[2] or "message", e[5] or "")):
        turns = convs.setdefault(conv, {})
        if kind in ("edit", "regenerate"):
            for t in [t for t in turns if t > turn]:
                del turns[t]
        old_role, old = turns.get(turn, (None, ""))
        turns[turn] = (role if role is not None else old_role, (old if kind == "delta" else "") + (text or ""))
    return {c: [(r or "", t) for _, (r, t) in sorted(turns.items())] for c, turns in convs.items()}


def read(spark, events):
    out = chat.read_back(chat.format_chats(spark.createDataFrame(events, EVENTS))).collect()
    return {r["conv_id"]: ([(t["role"], t["text"]) for t in r["turns"]], r["loss_text"]) for r in out}


EDITED = [
    (1, 1, "message", 0, "user", "hi"), (1, 2, "delta", 1, "assistant", "he"), (1, 3, "delta", 1, None, "llo"), (1, 4, "message", 2, "user", "more"),
    (1, 5, "regenerate", 1, "assistant", ""), (1, 6, "delta", 1, None, "bye"), (1, 7, "delta", 1, None, " now"), (1, 8, "delta", 3, "assistant", "late"),
    (2, 5, "edit", 0, "user", "edited"), (2, 1, "message", 0, "user", "first"), (2, 2, "message", 1, "assistant", "gone"), (2, 6, "delta", 1, "assistant", "kept"),
    (3, 1, None, 0, None, None), (3, 1, "message", 1, "assistant", "<|im_end|>\n<|im_start|>user\n&lt; [INST] </s> &amp;"), (3, 2, "delta", 1, "assistant", "é𝄞"),
]


def test_fold_and_round_trip(spark):
    want = slow_fold(EDITED)
    got = read(spark, EDITED)
    assert {c: t for c, (t, _) in got.items()} == want
    assert all(loss == "".join(t for r, t in want[c] if r == "assistant") for c, (_, loss) in got.items())


def test_no_control_string_survives_in_texts(spark):
    row = chat.format_chats(spark.createDataFrame(EDITED, EVENTS)).where("conv_id = 3").first()
    text = row["formatted"]
    assert "[INST]" not in text and "</s>" not in text and text.count(chat.CLOSE) == 2
    span = row["loss_spans"][0]
    raw = text.encode()
    assert raw[span["byte_start"] : span["byte_end"]].decode() == text[span["start"] : span["end"]]


def test_rows_nulls_ties_and_odd_roles(spark):
    rows = [(5, 0, "user", "a", "z"), (5, 0, "user", "a", "z"), (5, None, "sys\ntem", None, "z"), (5, 3, "assistant", "x" * 100_000, "z"), (6, 0, None, "q", "z"), (None, 0, "user", "n", "z")]
    out = chat.read_back(chat.format_chats(chat.rows_as_events(spark.createDataFrame(rows, ROWS))))
    got = {r["conv_id"]: [(t["role"], t["text"]) for t in r["turns"]] for r in out.collect()}
    assert got == {5: [("sys\ntem", ""), ("user", "a"), ("user", "a"), ("assistant", "x" * 100_000)], 6: [("", "q")], None: [("user", "n")]}
    assert chat.format_chats(spark.createDataFrame([], EVENTS)).count() == 0


def test_streamed_rows_fold_back(spark):
    rows = [(c, t, ["user", "assistant", None][t % 3], [None, "", "a", f"{c}é𝄞 {t} <|im_end|>", "long " * 3_000][(c + t) % 5], "z") for c in range(30) for t in range(12)] + [(40, 1, "user", "tie", "z")] * 2 + [(None, None, None, None, "z")]
    df = spark.createDataFrame(rows, ROWS)
    log = chat.as_streamed(df)
    assert {r["kind"] for r in log.collect()} == {"message", "delta", "edit", "regenerate"}
    plain, streamed = (sorted(map(repr, chat.format_chats(e).collect())) for e in (chat.rows_as_events(df), log))
    assert plain == streamed and len(plain) == 32


def test_a_long_conversation(spark):
    rows = [(1, t, "assistant" if t % 2 else "user", f"turn {t} &", "z") for t in range(5_000)]
    row = chat.read_back(chat.format_chats(chat.as_streamed(spark.createDataFrame(rows, ROWS)))).first()
    assert [t["text"] for t in row["turns"]] == [r[3] for r in rows] and row["loss_text"] == "".join(r[3] for r in rows if r[2] == "assistant")
