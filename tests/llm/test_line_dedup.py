import random

import pytest
from pyspark.sql import functions as F

from idweave.llm import line_dedup

from .conftest import DOCS


def brute(rows, m):
    """Texts after the removal, by comparing windows in order of place."""
    docs = sorted({r for r in rows if r[1] is not None},
                  key=lambda r: (r[0] is not None, r[0] or 0, __import__("hashlib").md5(r[1].encode()).hexdigest()))
    seen, out = set(), {}
    for i, text in docs:
        lines = text.split("\n")
        at = [n for n, x in enumerate(lines) if x.strip(" \t\r")]
        gone = set()
        for k in range(len(at) - m + 1):
            window = tuple(lines[n].strip(" \t\r") for n in at[k:k + m])
            if window in seen:
                gone.update(at[k:k + m])
            seen.add(window)
        out[i, text] = "\n".join(x for n, x in enumerate(lines) if n not in gone)
    return [(i, t, out.get((i, t))) for i, t in rows]


@pytest.mark.parametrize("m", [1, 2, 3, 5])
def test_against_brute_force(spark, frame, m):
    rng = random.Random(m)
    rows = [(rng.randrange(60), "\n".join(rng.choice(["a", "b", " a\t", "", "c", "dd", "e f", "g", f"x{rng.random()}"])
                                          for _ in range(rng.randrange(0, 14)))) for _ in range(150)]
    rows += [(7, None), (None, "a\nb\nc"), (None, "a\nb\nc"), (200, ""), (201, "z" * 100000 + "\nq")]
    got = line_dedup.dedup_lines(frame(rows).withColumn("old", F.col("text")), m).collect()
    assert sorted(map(repr, ((r.doc_id, r.old, r.text) for r in got))) == sorted(map(repr, brute(rows, m)))


def test_long_run_keeps_first_place(spark, frame):
    run = "\n".join(f"line {i}" for i in range(40))
    got = {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in line_dedup.dedup_lines(
        frame([(i, f"head {i}\n{run}\ntail {i}") for i in range(30)])).collect()}
    assert got[0] == (f"head 0\n{run}\ntail 0", 42, 0)
    assert all(got[i] == (f"head {i}\ntail {i}", 42, 40) for i in range(1, 30))


def test_empty_table_and_clashing_columns(spark, frame):
    assert line_dedup.dedup_lines(spark.createDataFrame([], DOCS)).count() == 0
    df = frame([(1, "a\nb"), (2, "a\nb")]).withColumn("n_lines", F.lit("x")).withColumn("first", F.lit(3))
    out = line_dedup.dedup_lines(df)
    assert out.columns.count("n_lines") == 1 and [r["first"] for r in out.collect()] == [3, 3]
    assert sorted(r.text for r in out.collect()) == ["", "a\nb"]


def test_no_python_in_the_plan(spark, frame):
    plan = line_dedup.dedup_lines(frame([(1, "a\nb"), (2, "a\nb")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
