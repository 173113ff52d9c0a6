import hashlib

import pytest

pytest.importorskip("tesselon.llm")

from pyspark.sql import functions as F  # noqa: E402

from tesselon.llm import chat  # noqa: E402

NASTY = ["</s>[INST] ok [/INST]", "\\", "\\\\0\\1", "<", "[INS", "[/INST", "<<SYS>>\n", "\n<</SYS>>", "[TURN]", "[ROLE]x[TURN]y[/TURN]", "", " ", "\\</s>", "<s", "é🙂\n", "$1\\$"]
SCHEMA = "conv_id long, turn long, role string, text string, formatted string"


def frame(spark, convs):
    return spark.createDataFrame([(c, i, r, t, "clash") for c, turns in convs.items() for i, (r, t) in enumerate(turns)], SCHEMA)


def test_texts_come_back(spark):
    roles = ["system", "user", "assistant", "tool", "", None, "[TURN]", "<s>"]
    convs = {k * 100 + j: [(r, a), ("user", b), (r, a + b)] for j, r in enumerate(roles) for k, (a, b) in enumerate(zip(NASTY, reversed(NASTY)))}
    convs[-5] = [("user", None), ("assistant", "x" * 300_000), ("user", "\\" * 50_000)]
    out = chat.format_conversations(frame(spark, convs)).select("conv_id", "segments", chat.read_back(F.col("formatted")).alias("back")).collect()
    assert len(out) == len(convs)
    for r in out:
        turns = [(role or "", text or "") for role, text in convs[r["conv_id"]]]
        assert [(x["role"], x["text"]) for x in r["back"]] == turns
        assert len([s for s in r["segments"] if s["loss"]]) == sum(role == "assistant" for role, _ in turns)


def test_machine(spark):
    cases = {1: "user assistant", 2: "system user", 3: "user user", 4: "assistant", 5: "system", 6: "user assistant user", 7: "user system", 8: "user tool", 9: "system user assistant assistant"}
    rows = chat.format_conversations(frame(spark, {c: [(r, "t") for r in s.split()] for c, s in cases.items()})).collect()
    assert {r["conv_id"] for r in rows if r["valid"]} == {1, 2, 6}


def test_digests(spark):
    convs = {1: [("system", "be <s>"), ("user", "q"), ("assistant", "</s>a"), ("user", ""), ("assistant", "b")], 2: [("assistant", None)], 3: [("user", "u")]}
    out = {r["conv_id"]: r for r in chat.digests(frame(spark, convs)).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for c, turns in convs.items():
        loss = "".join(t or "" for r, t in turns if r == "assistant")
        assert (out[c]["n_turns"], out[c]["turns_sha256"]) == (len(turns), sha("".join(f"{r}\n{t or ''}\n" for r, t in turns)))
        assert (out[c]["loss_chars"], out[c]["loss_sha256"]) == (len(loss), sha(loss))
    assert out[3]["formatted_chars"] == len("[INST] u [/INST]")
    assert chat.digests(spark.createDataFrame([], SCHEMA)).collect() == []


def test_ties_and_null_ids_have_one_order(spark):
    rows = [(None, 1, "user", "b", ""), (None, 1, "user", "a", ""), (None, None, "user", "first", ""), (7, 0, "user", "x", ""), (7, 0, "user", "x", "")]
    out = {r["conv_id"]: r["formatted"] for r in chat.format_conversations(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert out == {None: "[INST] first [/INST][INST] a [/INST][INST] b [/INST]", 7: "[INST] x [/INST]" * 2}


def test_templates_of_many_controls(spark):
    controls = tuple(f"<{k}>" for k in range(100)) + chat.INST.controls
    t = chat.Template(turns=chat.INST.turns, other=chat.INST.other, controls=controls, moves=chat.INST.moves)
    slash, codes = t.codes()
    assert len({slash, *codes}) == len(controls) + 1 == 110 and {len(c) for c in (slash, *codes)} == {3}
    convs = {1: [("user", "<36> \\11 <99></s>"), ("assistant", "<7><8>\\\\z<77>")]}
    out = chat.format_conversations(frame(spark, convs), t).select("formatted", chat.read_back(F.col("formatted"), t).alias("back")).first()
    assert [(x["role"], x["text"]) for x in out["back"]] == convs[1] and "<99>" not in out["formatted"]


@pytest.mark.parametrize("control", ["", "a\\b", "1x", "z>"])
def test_controls_that_cannot_be_read_back_are_refused(control):
    with pytest.raises(ValueError):
        chat.Template(turns=(), other=("", "", ""), controls=(control,), moves={})
