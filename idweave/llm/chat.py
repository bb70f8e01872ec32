"""Chat formatting: a hidden Markov model over the lines of transcripts.

Hidden states: which of three roles speaks, and whether the line begins a
turn. Observed of a line: its speaker marker (a word for a role, a first,
second or later unknown name, or none) and its features (length class,
question, bullet or code). Viterbi recovers the states; lines from one
beginning to the next are a turn, its marker is cut off and the turn is
rendered in one canonical form.

What roles write and how turns follow each other is counted over all labelled
turns by aggregates; how reliable markers are is given (``MARKED``).

Long conversations are cut into chunks of ``PARTS`` consecutive parts (turns
of a source table; a transcript in one row is one part). A chunk becomes its
max-plus transfer matrix (state in, state out, best score); the matrices of
a conversation, 36 numbers each, are multiplied in order, which gives the
states at all seams of the best path; then each chunk is decoded between
its seams. The result is that of one Viterbi pass, but no task needs more than
a chunk of lines.

Defined cases: a null conversation id names no conversation, each such row
is one by itself (rows that are equal in all columns give equal turns); null
parts come first; a null or empty text is one empty line; of parts with
equal numbers the texts are taken in order, equal rows once; roles other
than the three are not learned from; an empty table gives an empty table;
extra columns of the tables are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from idweave.llm.common import Scratch, ship

ROLES = ("system", "user", "assistant")
PARTS = 64
#: Speaker words by role (fixed values).
MARKERS = {
    "system": ("system", "instruction", "instructions", "context"),
    "user": ("user", "human", "question", "customer", "prompter", "me", "q", "u", "h"),
    "assistant": ("assistant", "ai", "bot", "answer", "agent", "model", "gpt", "a"),
}
CLASSES = ("none", *ROLES, "name1", "name2", "name3")
#: P(marker class | beginning by system, user, assistant), in the order of CLASSES.
MARKED = np.array([[0.10, 0.80, 0.02, 0.02, 0.02, 0.02, 0.02],
                   [0.10, 0.01, 0.60, 0.01, 0.24, 0.02, 0.02],
                   [0.10, 0.01, 0.01, 0.60, 0.02, 0.24, 0.02]])
#: The same of lines that go on.
GOING_ON = np.array([0.982] + [0.003] * 6)
SIZES = (4, 10, 20, 40, 80)
N_FEATURES = (len(SIZES) + 1) * 4
_KNOWN = {w: r for r, words in MARKERS.items() for w in words}
_WORDS = "|".join(sorted(_KNOWN, key=len, reverse=True))
#: <|user|> or [USER] or ### User: or **User:** or User: or Anna:
MARKER = (r"^\s*(?:<\|(?:im_start\|>)?\s*(?i:(" + _WORDS + r"))\s*(?:\|>)?|\[(?i:(" + _WORDS + r"))\]:?"
          r"|#{1,4} *(?i:(" + _WORDS + r"))\s*:?(?=\s|$)|(?:\*\*)?(?i:(" + _WORDS + r")) ?:(?:\*\*)?"
          r"|(\p{Lu}[\p{L}\d_]{1,23}):)[ \t]*")


def marker(line: Column) -> tuple[Column, Column, Column]:
    """(role of the marker word, unknown name, line without marker); the first
    two are empty where there is none."""
    word = F.concat(*[F.regexp_extract(line, MARKER, k) for k in (1, 2, 3, 4)])
    role = F.lit("")
    for r, words in MARKERS.items():
        role = F.when(F.lower(word).isin(*words), r).otherwise(role)
    return role, F.regexp_extract(line, MARKER, 5), F.regexp_replace(line, MARKER, "")


def feature(line: Column) -> Column:
    """Length class, question, bullet or code as one number."""
    words = F.size(F.array_remove(F.split(line, r"\s+"), ""))
    size = sum(((words >= n).cast("int") for n in SIZES), F.lit(0))
    return (size * 4 + F.rtrim(line).endswith("?").cast("int") * 2
            + line.rlike(r"^\s*(?:[-*•] |\d+[.)] |```|    )").cast("int")).cast("int")


def lines_of(table: DataFrame, conv: str = "conv_id", part: str | None = None, text: str = "text",
             keep: tuple[str, ...] = ()) -> DataFrame:
    """(conv, key, part, n, line): the lines of every part in order."""
    kind = table.schema[conv].dataType.simpleString()
    number = F.col(part).cast("long") if part else F.lit(0).cast("long")
    rows = table.select(F.col(conv).cast(kind).alias("conv"), number.alias("part"),
                        F.coalesce(F.col(text), F.lit("")).alias("text"), *keep).distinct()
    alone = F.concat(F.lit("?"), F.md5(F.concat_ws("|", F.col("part").cast("string"), "text").cast("binary")))
    rows = rows.withColumn("key", F.coalesce(F.concat(F.lit("#"), F.col("conv").cast("string")), alone))
    return rows.select("conv", "key", "part", F.md5(F.col("text").cast("binary")).alias("th"), *keep,
                       F.posexplode(F.split("text", "\n")).alias("n", "line"))


class Model:
    """Log probabilities: start (3), follow (3 x 3), goes_on (3), and what
    lines of a role look like (3 x N_FEATURES)."""

    def __init__(self, first: np.ndarray, follow: np.ndarray, turns: np.ndarray, lines: np.ndarray,
                 looks: np.ndarray):
        norm = lambda x: np.log(x / x.sum(-1, keepdims=True))
        start = norm(first + np.array([1.0, 1.0, 0.2]))
        follow = norm(follow + np.array([[0.1, 2.0, 0.2], [0.1, 0.2, 2.0], [0.1, 2.0, 0.2]]))
        on = (np.maximum(lines - turns, 0) + 1.0) / (lines + 2.0)
        looks = norm(looks + 1.0)
        self.looks = np.vstack([looks, looks])
        self.marks = np.log(np.vstack([MARKED, np.tile(GOING_ON, (3, 1))]))
        # states 0-2 begin a turn of the role, 3-5 go on with it
        self.start = np.concatenate([start, np.full(3, -np.inf)])
        self.step = np.full((6, 6), -np.inf)
        for a in range(6):
            r = a % 3
            self.step[a, :3] = np.log1p(-on[r]) + follow[r]
            self.step[a, 3 + r] = np.log(on[r])

    def emit(self, mark: np.ndarray, look: np.ndarray) -> np.ndarray:
        return self.marks[:, mark].T + self.looks[:, look].T

    def transfer(self, emit: np.ndarray) -> np.ndarray:
        """Best score from the state before the lines to the state of the last."""
        best = self.step + emit[0]
        for e in emit[1:]:
            best = (best[:, :, None] + self.step[None]).max(1) + e
        return best

    def decode(self, emit: np.ndarray, before: int, last: int) -> np.ndarray:
        """States of the lines; before: state ahead of them or -1 at the start
        of a conversation; last: the state to end in or -1 for the best."""
        value = (self.start if before < 0 else self.step[before]) + emit[0]
        back = np.zeros((len(emit), 6), int)
        for t in range(1, len(emit)):
            through = value[:, None] + self.step
            back[t] = through.argmax(0)
            value = through.max(0) + emit[t]
        path = np.empty(len(emit), int)
        path[-1] = value.argmax() if last < 0 else last
        for t in range(len(emit) - 1, 0, -1):
            path[t - 1] = back[t, path[t]]
        return path

    def seams(self, first: np.ndarray, others: list[np.ndarray]) -> list[int]:
        """The best path's state at the end of every chunk."""
        values, choices = [first], []
        for m in others:
            through = values[-1][:, None] + m
            choices.append(through.argmax(0))
            values.append(through.max(0))
        out = [int(values[-1].argmax())]
        for choice in reversed(choices):
            out.append(int(choice[out[-1]]))
        return out[::-1]


def fit(turns: DataFrame) -> Model:
    """Count over all labelled turns (conv_id, turn, role, text)."""
    known = turns.where(F.col("role").isin(*ROLES)).select(
        "conv_id", F.col("turn").cast("long").alias("turn"), "role", F.coalesce("text", F.lit("")).alias("text"))
    looks = np.zeros((3, N_FEATURES))
    lines = np.zeros(3)
    for r in (known.select("role", F.explode(F.split("text", "\n")).alias("line"))
              .groupBy("role", feature(F.col("line")).alias("f")).agg(F.count(F.lit(1)).alias("n")).collect()):
        looks[ROLES.index(r.role), r.f] += r.n
        lines[ROLES.index(r.role)] += r.n
    count = np.zeros(3)
    first, follow = np.zeros(3), np.zeros((3, 3))
    for r in known.groupBy("role").agg(F.count(F.lit(1)).alias("n")).collect():
        count[ROLES.index(r.role)] = r.n
    # counted by turn number first: rows that share one number never meet in pairs
    by_turn = known.groupBy("conv_id", "turn", "role").agg(F.count(F.lit(1)).alias("n"))
    ahead = by_turn.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("role").alias("before"))
    for r in (by_turn.join(ahead, ["conv_id", "turn"], "left").groupBy("before", "role")
              .agg(F.sum("n").alias("n")).collect()):
        if r.before is None:
            first[ROLES.index(r.role)] += r.n
        else:
            follow[ROLES.index(r.before), ROLES.index(r.role)] += r.n
    return Model(first, follow, count, lines, looks)


def observe(lines: DataFrame) -> DataFrame:
    """Lines with chunk, marker class (0 none, 1-3 roles, 4-6 names in the
    order of their first use in the conversation), feature and bare line."""
    role, name, bare = marker(F.col("line"))
    seen = lines.withColumn("role_word", role).withColumn("name", F.when(role == "", name).otherwise("")).withColumn(
        "bare", F.when((role != "") | (F.col("name") != ""), bare).otherwise(F.col("line")))
    order = F.struct("part", "th", "n")
    firsts = seen.where("name <> ''").groupBy("key", "name").agg(F.min(order).alias("at"))
    # how many names of the conversation came before it: at most two matter
    early = firsts.groupBy("key").agg(F.min(F.struct("at", "name")).alias("one"))
    second = (firsts.join(early, "key").where(F.col("name") != F.col("one.name"))
              .groupBy("key").agg(F.min(F.struct("at", "name")).alias("two")))
    names = early.join(second, "key", "left").select(
        "key", F.col("one.name").alias("name1"), F.col("two.name").alias("name2"))
    mark = F.lit(0)
    for k, r in enumerate(ROLES):
        mark = F.when(F.col("role_word") == r, k + 1).otherwise(mark)
    mark = F.when(F.col("name") == "", mark).when(F.col("name") == F.col("name1"), 4).when(
        F.col("name") == F.col("name2"), 5).otherwise(6)
    return seen.join(names, "key", "left").select(
        "conv", "key", F.floor(F.coalesce("part", F.lit(-1)) / PARTS).cast("long").alias("chunk"), "part", "th", "n",
        mark.cast("int").alias("mark"), feature(F.col("bare")).alias("look"), "bare")


def recover(lines: DataFrame, model: Model) -> DataFrame:
    """(conv, key, chunk, at, role, text): the turns of every conversation;
    (chunk, at) orders them. A turn that runs across a seam is one row per
    chunk, ``goes_on`` marking the later ones."""
    scratch = Scratch(lines.sparkSession, "chat")
    seen = scratch.save(observe(lines))
    kind = lines.schema["conv"].dataType.simpleString()
    chunks = scratch.save(seen.groupBy("key", "chunk").agg(F.count(F.lit(1)).alias("lines")))
    cut = scratch.save(chunks.groupBy("key").agg(F.count(F.lit(1)).alias("k"), F.min("chunk").alias("first"))
                       .where("k > 1"))

    def ordered(rows: pd.DataFrame) -> pd.DataFrame:
        return rows.sort_values(["part", "th", "n"], na_position="first", kind="stable")

    def matrix(rows: pd.DataFrame) -> pd.DataFrame:
        rows = ordered(rows)
        emit = model.emit(rows["mark"].to_numpy(), rows["look"].to_numpy())
        if rows["chunk"].iloc[0] == rows["first"].iloc[0]:
            best = model.start + emit[0]
            out = best if len(emit) == 1 else (best[:, None] + model.transfer(emit[1:])).max(0)
            out = np.tile(out, (6, 1))
        else:
            out = model.transfer(emit)
        return pd.DataFrame({"key": [rows["key"].iloc[0]], "chunk": [rows["chunk"].iloc[0]], "m": [out.ravel()]})

    def join_up(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("chunk")
        each = [np.array(m).reshape(6, 6) for m in rows["m"]]
        ends = model.seams(each[0][0], each[1:])
        return pd.DataFrame({"key": rows["key"], "chunk": rows["chunk"], "before": [-1, *ends[:-1]], "last": ends})

    long = seen.drop("bare", "conv").join(cut.select("key", "first"), "key")
    matrices = scratch.save(long.groupBy("key", "chunk").applyInPandas(
        matrix, "key string, chunk long, m array<double>"))
    seams = scratch.save(matrices.groupBy("key").applyInPandas(
        join_up, "key string, chunk long, before int, last int"))

    def decode(rows: pd.DataFrame) -> pd.DataFrame:
        rows = ordered(rows)
        emit = model.emit(rows["mark"].to_numpy(), rows["look"].to_numpy())
        path = model.decode(emit, int(rows["before"].iloc[0]), int(rows["last"].iloc[0]))
        begins = path < 3
        begins[0] = True
        turn = np.cumsum(begins) - 1
        bare = rows["bare"].to_numpy(object)
        starts = np.flatnonzero(begins)
        # a marker on a line of its own is no line of the text
        alone = (rows["mark"].to_numpy() > 0) & (bare == "")
        texts = ["\n".join(bare[a + int(alone[a] and b > a + 1):b])
                 for a, b in zip(starts, [*starts[1:], len(path)])]
        return pd.DataFrame({
            "conv": rows["conv"].iloc[0], "key": rows["key"].iloc[0], "chunk": rows["chunk"].iloc[0],
            "at": turn[starts], "goes_on": path[starts] > 2, "role": [ROLES[path[a] % 3] for a in starts],
            "text": texts}, columns=["conv", "key", "chunk", "at", "goes_on", "role", "text"])

    between = seen.join(seams, ["key", "chunk"], "left").fillna(-1, ["before", "last"])
    return between.groupBy("key", "chunk").applyInPandas(
        decode, f"conv {kind}, key string, chunk long, at long, goes_on boolean, role string, text string")


def render(role: Column, text: Column) -> Column:
    """One turn in canonical form."""
    return F.concat(F.lit("<|"), role, F.lit("|>\n"), text, F.lit("\n<|end|>\n"))


#: Ways to write a speaker (fixed values), by style: system, user, assistant.
STYLES = (("System: ", "User: ", "Assistant: "), ("### Instruction:\n", "### Human:\n", "### Assistant:\n"),
          ("<|system|>\n", "<|user|>\n", "<|assistant|>\n"), ("[SYSTEM] ", "[USER] ", "[BOT] "),
          ("Context: ", "Q: ", "A: "), ("System: ", "Anna: ", "Ravi: "))


def transcript(turns: DataFrame) -> DataFrame:
    """Labelled turns as people write them down: the speaker in one of
    ``STYLES`` (by the conversation), roles otherwise forgotten."""
    style = F.pmod(F.crc32(F.coalesce(F.col("conv_id").cast("string"), F.lit("")).cast("binary")), F.lit(len(STYLES)))
    said = F.lit("")
    for k, words in enumerate(STYLES):
        for r, w in zip(ROLES, words):
            said = F.when((style == k) & (F.col("role") == r), w).otherwise(said)
    return turns.select("conv_id", "turn", F.concat(said, F.coalesce("text", F.lit(""))).alias("text"))


ship(__name__)
