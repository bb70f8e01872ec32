"""Mixing sources to target weights by systematic sampling.

Targets: sources in code-point order (null last) weigh 5, 2, 1, repeating,
and share the words of all documents by weight; a source stops at
``max_repeat`` times its own words and what it would have got beyond that
is shared anew by weight. The fixed point of that resharing is
``min(max_repeat * size, level * weight)`` for the one ``level`` at which the
targets add up to all words, found from running sums over the sources
ordered by the level at which each one fills up.

Copies: a source's documents all expect ``rate = target / source size``
copies. Put in a row, with one random offset for the source, a document is
emitted once for every integer that the running sum of expected copies
crosses on it. As the rate is one number per source, the running sum is
``rate * rank``. The row is ordered by size class, then by a hash, so each
class of similar sizes gets its even share and the words taken come close
to the target.

Equal rows (in all columns) are one row with their number from the start.
Ranks are made in two levels: counts of (source, size class, hash bucket)
cells, running sums over a source's cells, then a running sum within each
cell. No task holds a source: a hot source is spread over all of its cells.
Only ids, sizes and hashes are ranked. Texts, if they are wanted, are
shuffled once, to meet what their row was given; equal rows are told apart
again there, ``MOST`` at a time, by as many tasks as it takes.

Defined cases: a null or empty text has size 0; null is a source of its
own; rows with the same id and text are separate rows and share out the
copies; documents of a source of size 0 get target 0 and no copies; an
empty table gives an empty table; extra columns are carried along (the
names the operator adds, ``ADDED`` and ``copy`` in ``mix``, replace any of
that name).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from idweave.functions.ids import key_hash
from idweave.llm.common import Scratch, n_words

WEIGHTS = (5, 2, 1)
MAX_REPEAT = 3
BUCKETS = 256
#: Equal rows that one task tells apart.
MOST = 256
ADDED = ("size", "source_size", "target", "copies", "taken")


def unit_hash(*parts: Column) -> Column:
    """32 bits of an md5 over the parts as a long."""
    text = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long")


def size_class(size: Column) -> Column:
    """Sizes that agree in their bit length and three bits after the first."""
    bits = F.length(F.bin(size))
    low = F.greatest(bits - 4, F.lit(0))
    return (bits * 16 + F.floor(size / F.pow(F.lit(2.0), low))).cast("int")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS,
            max_repeat: int = MAX_REPEAT) -> DataFrame:
    """(source, source_size) -> + target, rate. One row per source goes
    through one sort; the documents never do."""
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (F.pmod(F.col("n") - 1, F.lit(len(weights))) + 1).cast("int"))
    whole = Window.partitionBy(F.lit(0))
    fills = whole.orderBy("fill", "n").rowsBetween(Window.unboundedPreceding, -1)
    cap = (F.col("source_size") * max_repeat).cast("double")
    level = ((F.col("total") - F.coalesce(F.sum("cap").over(fills), F.lit(0.0)))
             / (F.col("all_weight") - F.coalesce(F.sum("weight").over(fills), F.lit(0.0))))
    return (sizes
            .withColumn("n", F.row_number().over(whole.orderBy(F.col("source").asc_nulls_last())))
            .withColumn("weight", weight).withColumn("cap", cap)
            .withColumn("fill", F.col("cap") / F.col("weight"))
            .withColumn("total", F.sum(F.col("source_size").cast("double")).over(whole))
            .withColumn("all_weight", F.sum("weight").over(whole))
            # the level if every source that fills up earlier is at its cap: it
            # rises as long as the next source is below it, and falls from there
            .withColumn("level", level)
            .withColumn("level", F.max("level").over(whole))
            .withColumn("target", F.least("cap", F.col("level") * F.col("weight")))
            .select("source", "source_size", "target",
                    F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size"))
                    .otherwise(F.lit(0.0)).alias("rate")))


def mix_plan(docs: DataFrame, seed: int = 0, buckets: int = BUCKETS,
             weights: tuple[int, ...] = WEIGHTS, max_repeat: int = MAX_REPEAT,
             keep: list[str] | None = None) -> DataFrame:
    """Each document with size, source_size, target, copies and taken.
    ``keep``: the columns of ``docs`` to carry (all by default; texts are not
    shuffled unless they are kept)."""
    scratch = Scratch(docs.sparkSession, "mixing")
    carried = [c for c in docs.columns if c in (keep or docs.columns) and c not in ADDED]
    whole = "text" in carried
    row = F.struct(*[F.col(c) for c in carried]).alias("row")
    same = [c for c in docs.columns if c in {*carried, "doc_id", "text", "source"}]
    ids = [key_hash(same, 0).alias("d0"), key_hash(same, 1).alias("d1")]
    h = unit_hash(F.lit(seed), F.col("doc_id"), F.md5(F.coalesce("text", F.lit(""))))
    narrow = docs.select(
        *ids, F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("of"), h.alias("h"), "doc_id",
        n_words(F.col("text")).alias("size"), *([] if whole else [row]))
    groups = scratch.save(
        narrow.groupBy("of", "size", "h", "doc_id", "d0", "d1")
        .agg(F.count(F.lit(1)).alias("m"), *([] if whole else [F.first("row").alias("row")]))
        .withColumn("class", size_class(F.col("size")))
        .withColumn("cell", F.pmod("h", F.lit(buckets)).cast("int")))
    cell = ["of", "class", "cell"]
    cells = scratch.save(groups.groupBy(*cell).agg(
        F.sum("m").alias("n"), F.sum(F.col("m") * F.col("size")).alias("words")))
    source = F.when(F.col("of") != "", F.expr("substring(of, 2)")).alias("source")
    plan = targets(cells.groupBy(source).agg(F.sum("words").alias("source_size")), weights, max_repeat)
    offset = unit_hash(F.lit(seed), F.lit("offset"), F.col("source")) / F.lit(4294967296.0)
    plan = plan.select(F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("of"), "source_size", "target",
                       "rate", offset.alias("offset"))
    before = Window.partitionBy("of").orderBy("class", "cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = (cells.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n", "words")
              .join(plan, "of"))
    within = (Window.partitionBy(*cell).orderBy("h", F.col("doc_id").asc_nulls_first(), "d0", "d1")
              .rowsBetween(Window.unboundedPreceding, -1))
    ranked = (groups.withColumn("ahead", F.coalesce(F.sum("m").over(within), F.lit(0)))
              .join(scratch.save(starts), cell)
              .withColumn("before", F.col("before") + F.col("ahead")).drop("of", "h", "doc_id", "class", "cell", "ahead"))
    if whole:
        texts = docs.select(*ids, row).groupBy("d0", "d1").agg(F.first("row").alias("row"))
        ranked = texts.join(scratch.save(ranked), ["d0", "d1"])
    at = F.col("before") + F.col("j")
    copies = F.floor(F.col("offset") + F.col("rate") * at) - F.floor(F.col("offset") + F.col("rate") * (at - 1))
    out = _each_row(ranked).withColumn("copies", copies.cast("int")).withColumn("taken", F.col("copies") * F.col("size"))
    return out.select("row.*", *ADDED)


def _each_row(groups: DataFrame) -> DataFrame:
    """Every one of a group's ``m`` equal rows, numbered by ``j`` from 1.
    Large groups are dealt out in parts of ``MOST`` rows."""
    few = groups.where(F.col("m") <= MOST).withColumn("j", F.explode(F.sequence(F.lit(1).cast("long"), "m")))
    parts = F.sequence(F.lit(0).cast("long"), F.floor((F.col("m") - 1) / MOST))
    first = F.col("part") * MOST + 1
    many = (groups.where(F.col("m") > MOST).withColumn("part", F.explode(parts)).repartition("d0", "d1", "part")
            .withColumn("j", F.explode(F.sequence(first, F.least(F.col("m"), first + (MOST - 1))))).drop("part"))
    return few.unionByName(many)


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each document emitted ``copies`` times, numbered by
    ``copy`` from 0 (which replaces a column of that name), with the plan's
    columns."""
    plan = mix_plan(docs, **options).where("copies > 0")
    return plan.withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))


#: What mix_plan takes, in DuckDB's SQL (a rank over a source in one window).
MIX_SQL = """
WITH sized AS (
  SELECT *, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
    ('0x' || substr(md5('0|' || coalesce(doc_id::VARCHAR, '') || '|' || md5(coalesce(text, ''))), 1, 8))::BIGINT AS h
  FROM {documents}),
classed AS (
  SELECT *, length(bin(size)) * 16
      + floor(size / pow(2.0, greatest(length(bin(size)) - 4, 0)))::INT AS k, h % 256 AS c
  FROM sized),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY k, c, h, doc_id NULLS FIRST) AS place,
    sum(size) OVER (PARTITION BY source)::BIGINT AS source_size
  FROM classed),
sources AS (
  SELECT source, source_size, row_number() OVER (ORDER BY source NULLS LAST) AS n
  FROM (SELECT DISTINCT source, source_size FROM ranked)),
weighed AS (
  SELECT *, CASE (n - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0 ELSE 1.0 END AS weight,
    (3 * source_size)::DOUBLE AS cap
  FROM sources),
levels AS (
  SELECT *, (sum(source_size::DOUBLE) OVER () - coalesce(sum(cap) OVER earlier, 0))
      / (sum(weight) OVER () - coalesce(sum(weight) OVER earlier, 0)) AS l
  FROM weighed
  WINDOW earlier AS (ORDER BY cap / weight, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
aims AS (
  SELECT source, least(cap, weight * (SELECT max(l) FROM levels)) AS target
  FROM levels),
rated AS (
  SELECT r.*, a.target, CASE WHEN source_size > 0 THEN a.target / source_size ELSE 0 END AS rate,
    ('0x' || substr(md5('0|offset|' || coalesce(r.source, '')), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS o
  FROM ranked r JOIN aims a ON r.source IS NOT DISTINCT FROM a.source)
SELECT {columns}
FROM (SELECT *, (floor(o + rate * place) - floor(o + rate * (place - 1)))::INT AS copies FROM rated)
"""
