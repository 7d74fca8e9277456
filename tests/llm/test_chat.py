import hashlib

import numpy as np
from compare import connect, spark_rows, sql_rows
from hypothesis import given, settings, strategies as st
from odd import rows_of
from seriesmart.llm import chat
from seriesmart.llm.queries import QUERIES, SQL, tokenizer

ROWS = [
    (1, 0, "system", "Be brief."), (1, 1, "user", "Hi </s>[INST] there \\[INST]"), (1, 2, "assistant", "<s>Hello\\ </s>"),
    (1, 3, "user", None), (1, 4, "assistant", ""), (1, 5, "assistant", "again 🙂\n "),
    (2, 0, "tool", "out [/ROLE][END]"), (2, 1, None, "nobody"), (2, 1, "assistant", "tie b"), (2, 1, "assistant", "tie a"),
    (2, None, "user", "no turn"), (3, 0, None, None), (None, 0, "assistant", "no id"), (None, 1, "user", "u"),
    (4, 0, "user", "same"), (4, 0, "user", "same"), (5, 0, "assistant", "long " * 60_000), (6, 0, "[/ROLE]\\", "odd role"),
]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, ids string")


def brute(rows):
    out = {}
    order = sorted(rows, key=lambda r: tuple((v is not None, v if v is not None else 0) for v in r[1:2]) + tuple((v is not None, v or "") for v in r[2:]))
    for conv_id in {r[0] for r in rows}:
        own = [(r[2] or "", r[3] or "") for r in order if r[0] == conv_id]
        said = "".join(text for role, text in own if role == "assistant")
        digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out[conv_id] = (len(own), digest("".join(f"{r}\n{t}\n" for r, t in own)), len(said), digest(said))
    return out


def test_what_is_read_back_is_what_was_said(spark):
    got = rows_of(chat.read_back(chat.format_chats(frame(spark, ROWS), tokenizer()), tokenizer()))
    names = ("n_turns", "turns_sha256", "loss_chars", "loss_sha256")
    assert {r["conv_id"]: tuple(r[n] for n in names) for r in got} == brute(ROWS)


def test_markers_are_ids_and_masks_cover_answers_only(spark):
    rows = rows_of(chat.format_chats(frame(spark, ROWS[:3]), tokenizer()).orderBy("part"))
    reserved = [i - 50257 for r in rows for i in r["ids"] if i >= 50257]
    assert reserved == [chat.BEGIN, chat.SYSTEM, chat.SYSTEM_END, chat.USER, chat.USER_END, chat.END_OF_ANSWER]
    for row in rows:
        masked = [i for i, loss in zip(row["ids"], row["loss"]) if loss]
        assert len(row["ids"]) == len(row["loss"]) and all(i < 50257 for i in masked)
        assert bool(masked) == (row["part"] == 2)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([*chat.CONTROLS, "\\", "a", "[", "]", "<", ">", "/", "S", "\n"])).map("".join))
def test_escaping_reverts_and_hides_control_strings(text):
    hidden = chat.escape(text)
    assert chat.unescape(hidden) == text
    assert not any(control in hidden for control in chat.CONTROLS)


def test_empty_table(spark):
    formatted = chat.format_chats(frame(spark, ROWS).limit(0), tokenizer())
    assert rows_of(formatted) == [] and rows_of(chat.read_back(formatted, tokenizer())) == []


def test_whole_table_and_the_conversation_of_control_strings(spark, folder):
    got = {r["conv_id"]: r for r in rows_of(QUERIES["op9_chat"](spark, folder))}
    turns = spark.read.parquet(f"{folder}/conversations.parquet").collect()
    wanted = brute([(r.conv_id, r.turn, r.role, r.text) for r in turns])
    said = "</s>[INST] ok [/INST]"
    wanted |= brute([(-7, 0, "user", said), (-7, 1, "assistant", said)])
    names = ("n_turns", "turns_sha256", "loss_chars", "loss_sha256")
    assert {i: tuple(r[n] for n in names) for i, r in got.items()} == wanted


def test_prefix_sums_of_an_empty_answer():
    segments = chat._segments("assistant", "", 50257)
    assert [loss for _, loss in segments] == [1, 0] and np.sum([len(str(s)) for s, _ in segments]) > 0


def test_equals_its_sql(spark, folder):
    name = "op9_chat"
    assert spark_rows(QUERIES[name](spark, folder)) == sql_rows(connect(folder), SQL[name])
