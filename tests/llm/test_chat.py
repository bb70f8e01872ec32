import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from idweave.llm import chat

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def turns(spark):
    return spark.read.parquet(f"{SF}/conversations.parquet")


@pytest.fixture(scope="module")
def model(turns):
    return chat.fit(turns)


def parsed(spark, model, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "conv_id long, text string")
    out = chat.recover(chat.lines_of(df), model).collect()
    return [[(r.role, r.text) for r in sorted(out, key=lambda r: (r.chunk, r.at)) if r.conv == i]
            for i in range(len(texts))]


def test_round_trip(spark, turns, model):
    out = chat.recover(chat.lines_of(chat.transcript(turns), part="turn"), model).collect()
    got = sorted((r.conv, r.chunk, r.at, r.role, r.text) for r in out)
    want = [(r.conv_id, r.turn, r.role, r.text) for r in turns.distinct().collect()]
    assert sorted((c, r, t) for c, _, _, r, t in got) == sorted((c, r, t) for c, _, r, t in want)


def test_markers_and_names(spark, model):
    got = parsed(spark, model, [
        "User: how are you?\nI mean it.\nAssistant: fine.\n\n- one\n- two\nUser: ok",
        "### Instruction:\nbe nice\n### Human: hi\n### Assistant:\nhello\nthere",
        "Ann: what is it?\nBob: It is this.\nAnn: thanks a lot\nBob: Welcome.",
        "**Q:** why?\n**A:** because", "", "just one line of text without a speaker"])
    assert got[0] == [("user", "how are you?\nI mean it."), ("assistant", "fine.\n\n- one\n- two"), ("user", "ok")]
    assert got[1] == [("system", "be nice"), ("user", "hi"), ("assistant", "hello\nthere")]
    assert [r for r, _ in got[2]] == ["user", "assistant"] * 2
    assert got[3] == [("user", "why?"), ("assistant", "because")]
    assert len(got[4]) == 1 and got[4][0][1] == ""
    assert len(got[5]) == 1


def test_viterbi_against_all_paths(model):
    rng = np.random.default_rng(2)
    for n in (1, 2, 3, 5):
        emit = model.emit(rng.integers(0, 7, n), rng.integers(0, chat.N_FEATURES, n))
        value = lambda p: model.start[p[0]] + emit[0, p[0]] + sum(
            model.step[a, b] + emit[t + 1, b] for t, (a, b) in enumerate(zip(p, p[1:])))
        best = max(value(p) for p in itertools.product(range(6), repeat=n))
        assert value(list(model.decode(emit, -1, -1))) == pytest.approx(best)


def test_chunks_change_nothing(spark, turns, model, monkeypatch):
    said = chat.transcript(turns)
    lines = chat.lines_of(said, part="turn")
    whole = chat.recover(lines, model).collect()
    monkeypatch.setattr(chat, "PARTS", 2)
    pieces = chat.recover(lines, model).collect()
    assert max(r.chunk for r in pieces) > 1
    join = lambda rows: {c: "".join(f"{r.role}:{r.text}\n" for r in sorted(
        (r for r in rows if r.conv == c), key=lambda r: (r.chunk, r.at))) for c in {r.conv for r in rows}}
    assert join(whole) == join(pieces)


def test_defined_cases(spark, model):
    odd = spark.createDataFrame(
        [(1, 0, "user", None), (1, 0, "user", None), (None, 0, "user", "User: a"), (None, 0, "user", "User: a"),
         (None, None, None, None), (2, 1, "tool", "x " * 20000), (3, None, "user", "User: b")],
        "conv_id long, turn long, role string, text string").withColumn("key", F.lit(1)).withColumn("mark", F.lit(2))
    out = chat.recover(chat.lines_of(odd, part="turn"), chat.fit(odd)).collect()
    assert len(out) == 5 and sum(r.conv is None for r in out) == 2
    assert chat.recover(chat.lines_of(odd.where("false"), part="turn"), model).count() == 0
    assert chat.fit(odd.where("false")) is not None


def test_render(spark):
    row = spark.range(1).select(chat.render(F.lit("user"), F.lit("hi")).alias("x")).first()
    assert row.x == "<|user|>\nhi\n<|end|>\n"


def test_fit_of_equal_turn_numbers_makes_no_pairs(spark):
    """Rows that share a turn number are counted before they are joined."""
    rows = [(1, i % 2, "user" if i % 2 == 0 else "assistant", f"t{i}") for i in range(4000)]
    model = chat.fit(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string"))
    assert model.step[1].argmax() == 2
