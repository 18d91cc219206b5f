import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from ticketflow.llm import chat_format as op

SCHEMA = "conv_id long, turn long, role string, text string"
CONTROL = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE 61]", "[/ROLE]", "[ROLE ", "\\", "<", "[", "]", ">",
           "a", "\n", "é", "\U0001f600", "/s>", "INST]", "\\<"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def slow(rows):
    """Digests from the rows themselves; the rendered length from the template's rule."""
    out = {}
    for conv in {r[0] for r in rows}:
        turns = sorted(((t is not None, t or 0), role or "", text or "") for c, t, role, text in rows if c == conv)
        learned = [x for _, role, x in turns if role == "assistant"]
        size = 0
        for _, role, x in turns:
            marks = {"assistant": 7, "user": 13, "system": 15}.get(role, 14 + 2 * len(role.encode()))
            x = x.replace("\\", "\\\\")
            size += marks + len(re.sub(r"<(?=/?s>|</?SYS>>)|\[(?=/?INST\]|/?ROLE[ \]])", r"\g<0>\\", x))
        out[conv] = (len(turns), sha("".join(f"{r}\n{x}\n" for _, r, x in turns)), sum(map(len, learned)),
                     sha("".join(learned)), size)
    return out


def got(df):
    rows = df.collect()
    out = {r["conv_id"]: tuple(r[1:]) for r in rows}
    assert len(out) == len(rows)
    return out


def conversations(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_planted_conversation(spark):
    found = op.format_events(op.turns_as_events(op.planted(spark))).first()
    assert found["formatted"] == r"[INST]<\/s>[\INST] ok [\/INST][/INST]<s><\/s>[\INST] ok [\/INST]</s>"
    assert found["loss"][0] is None and found["starts"] == [0, 37]
    span = found["loss"][1]
    assert found["formatted"][span["start"]:span["end"]] == r"<\/s>[\INST] ok [\/INST]"
    text = "</s>[INST] ok [/INST]"
    assert got(op.format_conversations(op.planted(spark))) == slow([(-7, 0, "user", text), (-7, 1, "assistant", text)])


@pytest.mark.parametrize("seed", range(3))
def test_any_text_comes_back(spark, seed):
    rng = np.random.default_rng(seed)
    roles = ["user", "assistant", "system", "tool", "", None, "a]b", "[ROLE ", "Ünï"]
    rows = [(int(c), int(t), roles[rng.integers(len(roles))], "".join(rng.choice(CONTROL, rng.integers(0, 30))))
            for c in range(12) for t in range(rng.integers(1, 12))]
    assert got(op.format_conversations(conversations(spark, rows))) == slow(rows)
    read = op.read_back(op.format_events(op.turns_as_events(conversations(spark, rows)))).collect()
    assert {(r["conv_id"], r["turn"]): (r["role"], r["text"]) for r in read} == {
        (c, t): (role or "", x) for c, t, role, x in rows}
    assert all((r["learned"] is not None) == (r["role"] == "assistant") for r in read)
    assert all(r["learned"] == r["text"] for r in read if r["role"] == "assistant")


def test_no_text_holds_a_control_string(spark):
    rng = np.random.default_rng(5)
    rows = [("".join(rng.choice(CONTROL, rng.integers(0, 40))),) for _ in range(400)]
    found = spark.createDataFrame(rows, "t string").select("t", op.escaped(F.col("t")).alias("e"),
                                                           op.unescaped(op.escaped(F.col("t"))).alias("back")).collect()
    control = re.compile(r"</?s>|<</?SYS>>|\[/?INST\]|\[/?ROLE[ \]]")
    assert all(r["back"] == r["t"] and not control.search(r["e"]) for r in found)


EVENTS = "conv_id long, message long, seq long, event string, role string, text string"


def test_fold_of_deltas_edits_and_regenerations(spark):
    log = [(1, 1, 10, "open", "user", None), (1, 1, 11, "delta", None, "Hel"), (1, 1, 14, "delta", None, "lo"),
           (1, 2, 12, "open", "assistant", None), (1, 2, 13, "delta", None, "first try"),
           (1, 2, 15, "regenerate", None, None), (1, 2, 16, "delta", None, "sec"), (1, 2, 17, "delta", None, "ond"),
           (1, 3, 20, "open", "user", "typed at once"), (1, 3, 21, "edit", None, "edited"), (1, 3, 22, "delta", None, " more"),
           (1, 3, 19, "note", None, "of an unknown kind"), (1, 4, 30, "delta", None, "never opened"),
           (2, 1, 1, "open", None, None), (2, 2, 2, "regenerate", None, "x")]
    rng = np.random.default_rng(1)
    frame = spark.createDataFrame([log[i] for i in rng.permutation(len(log))], EVENTS).repartition(4)
    found = {(r["conv_id"], r["message"]): (r["role"], r["text"]) for r in op.final_messages(frame).collect()}
    assert found == {(1, 1): ("user", "Hello"), (1, 2): ("assistant", "second"), (1, 3): ("user", "edited more"),
                     (1, 4): ("", "never opened"), (2, 1): ("", ""), (2, 2): ("", "")}
    text = {r["conv_id"]: r["formatted"] for r in op.format_events(frame).collect()}
    assert text[1] == "[INST]Hello[/INST]<s>second</s>[INST]edited more[/INST][ROLE ]never opened[/ROLE]"


def test_fold_equals_a_loop_over_drawn_logs(spark):
    rng = np.random.default_rng(7)
    log, want, seq = [], {}, 0
    for _ in range(600):
        key, seq = (int(rng.integers(4)), int(rng.integers(5))), seq + 1
        kind = "open" if key not in want else str(rng.choice(["delta", "delta", "delta", "edit", "regenerate"]))
        text = "".join(rng.choice(list("ab <s>"), 3))
        log.append((*key, seq, kind, "user" if kind == "open" else None, text))
        want[key] = text if kind in ("open", "edit") else "" if kind == "regenerate" else want[key] + text
    found = op.final_messages(spark.createDataFrame(log, EVENTS).repartition(5))
    assert {(r["conv_id"], r["message"]): r["text"] for r in found.collect()} == want


def test_awkward_rows(spark):
    rows = [(1, 0, "user", None), (1, 1, "assistant", ""), (2, 0, None, "x"), (None, 0, "user", "no id"), (None, 1, "assistant", "too"),
            (3, None, "user", "no turn"), (3, 0, "assistant", "after"), (4, 0, "assistant", "twice"), (4, 0, "assistant", "twice"),
            (4, 0, "assistant", "a tie"), (5, 0, "user", "ß\U0001f600" * 40_000), (5, 1, "assistant", "\\" * 30_000)]
    frame = conversations(spark, rows).withColumns({c: F.lit("x") for c in ("place", "message", "seq", "event", "starts", "loss")})
    assert got(op.format_conversations(frame)) == slow(rows)
    assert op.format_conversations(conversations(spark, [])).count() == 0


def test_a_very_long_conversation(spark):
    rows = [(1, t, ("user", "assistant")[t % 2], f"turn {t} [INST]") for t in range(5000)] + [(2, 0, "system", "s")]
    assert got(op.format_conversations(conversations(spark, rows))) == slow(rows)
