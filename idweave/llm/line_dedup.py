"""Line dedup: winnowing over line hashes, in DataFrame functions alone.

A document is the sequence of its lines, trimmed, blank lines left out. A
run is ``min_lines`` or more consecutive lines; a run is repeated if the
same lines also follow each other at an earlier place, an earlier document
or further up in the same one (order: doc_id, md5 of the text, line). The
lines of later repeated runs go, the first place stays whole unless a run
that begins in it is itself later than another.

1. Winnowing: of every ``min_lines`` consecutive line hashes the least is a
   fingerprint. Equal runs choose equal fingerprints, so every repeated run
   holds a fingerprint that occurs twice; all others are left behind after
   one count per hash.
2. Positions of the fingerprints that occur again are joined to the windows
   that chose them. Such windows reach up to ``min_lines - 1`` lines to each
   side of the fingerprint; longer runs are chains of them, so a match is
   extended both ways as far as windows go on repeating.
3. Each window's first place is an aggregate by its 128-bit identity, and
   every other place of it is deleted. Places are compared with the first
   one only: thousands of copies make thousands of rows, not pairs.

Defined cases: null texts stay null; rows with the same id and text are
one document and get the same result; a null id sorts first; empty and
one-line texts are never changed; a document of which nothing else is left
gets the empty text; an empty table gives an empty table; extra columns
pass through (``n_lines`` and ``n_removed`` replace any of that name).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from idweave.llm.common import Scratch, free_names

MIN_LINES = 2
BLANK = " \t\r"


def line_table(text: Column) -> Column:
    """The non-blank lines as structs of place in the text and trimmed line."""
    lines = F.transform(F.split(text, "\n"),
                        lambda x, i: F.struct(i.alias("at"), F.btrim(x, F.lit(BLANK)).alias("line")))
    return F.filter(lines, lambda s: s["line"] != "")


def windows(docs: DataFrame, min_lines: int) -> DataFrame:
    """(doc_id, th, first, fp, w1, w2): every window of a text with the
    fingerprint it chooses and its identity."""
    lines = docs.where("text is not null").select(
        "doc_id", F.md5(F.col("text").cast("binary")).alias("th"), line_table(F.col("text")).alias("lines"))
    hashed = lines.where(F.size("lines") >= min_lines).select(
        "doc_id", "th",
        F.transform("lines", lambda s: F.xxhash64(s["line"])).alias("h"),
        F.transform("lines", lambda s: F.xxhash64(F.lit("second"), s["line"])).alias("g"))
    each = hashed.select("doc_id", "th", "h", "g", F.explode(
        F.sequence(F.lit(0), F.size("h") - min_lines)).alias("first"))
    h, g = (F.slice(F.col(c), F.col("first") + 1, F.lit(min_lines)) for c in "hg")
    return each.select("doc_id", "th", "first", F.array_min(h).alias("fp"),
                       (F.col("first") + F.array_position(h, F.array_min(h)).cast("int") - 1).alias("fp_at"),
                       F.xxhash64(h).alias("w1"), F.xxhash64(F.lit("second"), g).alias("w2"))


def later_windows(docs: DataFrame, min_lines: int, scratch: Scratch) -> DataFrame:
    """(doc_id, th, first): windows that also occur at an earlier place."""
    every = scratch.save(windows(docs, min_lines))
    chosen = every.select("fp", "doc_id", "th", "fp_at").distinct()
    again = scratch.save(chosen.groupBy("fp").agg(F.count(F.lit(1)).alias("n"))
                         .where("n > 1").select("fp"))
    matched = scratch.save(every.join(again, "fp").select("doc_id", "th", "first", "w1", "w2"))
    place = F.struct("doc_id", "th", "first")
    firsts = scratch.save(matched.groupBy("w1", "w2")
                          .agg(F.min(place).alias("a"), F.max(place).alias("b"))
                          .where(~F.col("a").eqNullSafe(F.col("b"))).select("w1", "w2", "a"))
    later = matched.join(firsts, ["w1", "w2"]).where(~place.eqNullSafe(F.col("a")))
    later = scratch.save(later.select("doc_id", "th", "first").distinct())
    scratch.drop(every, again, matched, firsts)
    return later


def dedup_lines(docs: DataFrame, min_lines: int = MIN_LINES) -> DataFrame:
    """``docs`` with the lines of later repeated runs taken out of ``text``,
    + n_lines, n_removed (of the non-blank lines)."""
    if min_lines < 1:
        raise ValueError("min_lines must be at least 1")
    scratch = Scratch(docs.sparkSession, "line-dedup")
    own_id, own_hash, firsts, lines, th = free_names(docs, "_id", "_th", "_firsts", "_lines", "_md5")
    later = (later_windows(docs, min_lines, scratch)
             .groupBy(F.col("doc_id").alias(own_id), F.col("th").alias(own_hash))
             .agg(F.collect_list("first").alias(firsts)))
    later = scratch.save(later)
    keyed = docs.withColumn(th, F.md5(F.col("text").cast("binary")))
    same = F.col("doc_id").eqNullSafe(F.col(own_id)) & (F.col(th) == F.col(own_hash))
    joined = keyed.join(later, same, "left").withColumn(lines, line_table(F.col("text")))
    covered = F.array_distinct(F.flatten(F.transform(
        firsts, lambda i: F.sequence(i, i + (min_lines - 1)))))
    split = F.split("text", "\n")
    gone = picked(F.transform(lines, lambda s: s["at"]), covered)
    # array_except is a hash set: linear in the lines, also of very long texts
    left = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), gone)
    out = (joined
           .withColumn("n_lines", F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).cast("long"))
           .withColumn("n_removed", F.when(F.col(firsts).isNull(), 0).otherwise(F.size(covered))
                       .cast("long"))
           .withColumn("text", F.when(F.col(firsts).isNull(), F.col("text")).otherwise(
               F.array_join(picked(split, left), "\n"))))
    names = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    return out.select(*names, "n_lines", "n_removed")


def picked(values: Column, at: Column) -> Column:
    """The elements of ``values`` at the places ``at``. ``values`` is bound
    by a lambda of its own: named inside the inner one, it would be computed
    again for every place."""
    bound = F.array(F.struct(values.alias("values"), at.alias("at")))
    return F.get(F.transform(bound, lambda b: F.transform(b["at"], lambda i: F.get(b["values"], i))), F.lit(0))


#: The same in DuckDB's SQL for min_lines = 2, from the definition: windows of
#: two lines, numbered by place. Gives every row's text after the removal.
LINE_SQL = """
WITH d AS (SELECT DISTINCT doc_id, text, md5(text) AS th FROM {documents} WHERE text IS NOT NULL),
l AS (SELECT doc_id, th, unnest(string_split(text, chr(10))) AS line,
        generate_subscripts(string_split(text, chr(10)), 1) AS n FROM d),
c AS (SELECT doc_id, th, n, trim(line, chr(32) || chr(9) || chr(13)) AS t,
        row_number() OVER (PARTITION BY doc_id, th ORDER BY n) AS i
      FROM l WHERE trim(line, chr(32) || chr(9) || chr(13)) <> ''),
w AS (SELECT doc_id, th, n, t || chr(10) || lead(t) OVER p AS run, lead(n) OVER p AS n2,
        i FROM c WINDOW p AS (PARTITION BY doc_id, th ORDER BY i)),
r AS (SELECT *, row_number() OVER (PARTITION BY run ORDER BY doc_id NULLS FIRST, th, i) AS place
      FROM w WHERE run IS NOT NULL),
gone AS (SELECT doc_id, th, n FROM r WHERE place > 1 UNION SELECT doc_id, th, n2 FROM r WHERE place > 1),
kept AS (SELECT l.doc_id, l.th, string_agg(CASE WHEN g.th IS NULL THEN line END, chr(10) ORDER BY l.n) AS kept,
           count(g.th) AS n_removed,
           sum((trim(line, chr(32) || chr(9) || chr(13)) <> '')::INT) AS n_lines
         FROM l LEFT JOIN gone g ON l.doc_id IS NOT DISTINCT FROM g.doc_id AND l.th = g.th AND l.n = g.n
         GROUP BY l.doc_id, l.th)
SELECT {columns}
FROM {documents} o LEFT JOIN kept k ON o.doc_id IS NOT DISTINCT FROM k.doc_id AND md5(o.text) = k.th
"""
