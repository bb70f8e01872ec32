"""MinHash near-dedup by an inverted join over signature coordinates.

1. ``sign``: each text's set of five-word shingles, its size, a 128-bit
   digest of the set and a signature of ``COORDS`` minima. Equal sets become
   one class, so copies cost one row from here on.
2. Posting lists: a class is posted under (coordinate, value). Two classes
   are candidates if at least ``MATCHES`` coordinates agree; at 0.75
   similarity 24 of 32 do on average, and fewer than 12 about three times in
   a million. Values that one class alone has cannot agree with anything.
   Prefix merging: of a class's m shared values only the m - MATCHES + 1
   rarest are posted, as two classes that agree in MATCHES places must meet
   in one of those. Skip merging: the longer lists are not merged at all,
   the coordinates behind them are compared in the two signatures.
3. Links: the candidates are compared on their full shingle sets.
4. A list is first worked through as a star: every member against the
   member that shares the most of its signature, the likeliest original of
   the list. Members of one component are done with each other, so a group of
   n near copies costs about n comparisons, not n * n.
5. What stars leave are pairs in one list and in different components. They
   are compared one by one, except where counts prove that they cannot link:
   of a class's n shingles only s occur anywhere else, so with a partner of
   n' shingles it must hold that 7 * min(s, s') >= 3 * (n + n'). Lists are
   joined on buckets of n and of the largest n' that s allows, so pairs
   that fail this are not made. The s shingles are also counted by ``PARTS``
   hash parts: two sets share at most the sum of the lesser counts, which
   rules out copies that were changed in different places. Two classes may
   share many lists; the pair is made in the first of them alone. No
   candidate pair is dropped otherwise.

Defined cases: null and empty texts have no shingles and link with nothing,
each is a component of its own; a text of fewer than five words is one
shingle; every row is a document of its own, also with a repeated id, and
equal rows get equal results; a null id never names a component unless all
ids in it are null (kept compares null-safely); an empty table gives an
empty table; extra columns pass through ``dedup``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from idweave.llm.common import Scratch, free_names, ship, window_hashes, word_hashes, words_of
from idweave.llm.components import components

WORDS = 5
PERCENT = 75
COORDS = 32
MATCHES = 12
#: Ratio of the bounds of a length bucket.
BUCKET = 1.1
#: Hash parts by which shared shingles are counted.
PARTS = 64
_SEEDS = np.random.default_rng(20240229).integers(1, 2 ** 63, (2, COORDS), dtype=np.uint64)
_SEEDS[0] |= np.uint64(1)


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's shingles."""
    found = words_of(text or "", lower=True)
    if not found:
        return np.empty(0, np.uint64)
    return np.unique(window_hashes(word_hashes(found), min(words, len(found))))


def signature(of: np.ndarray) -> np.ndarray:
    """The minimum of the set under each of the hash functions, 32 bits."""
    out = np.empty(COORDS, np.uint64)
    for k in range(COORDS):
        out[k] = (of * _SEEDS[0, k] + _SEEDS[1, k]).min()
    return (out >> np.uint64(32)).astype(np.int64)


def _sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        sets = [shingles(t) for t in batch["text"]]
        yield pd.DataFrame({
            "doc_id": batch["doc_id"], "th": batch["th"], "n_shingles": [len(s) for s in sets],
            "digest": [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets],
            "sig": [signature(s) if len(s) else None for s in sets]})


def sign(docs: DataFrame) -> DataFrame:
    """(doc_id, th, n_shingles, digest, sig); ``th`` tells texts of one id
    apart."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", F.xxhash64("text").alias("th")).mapInPandas(
        _sign, f"doc_id {kind}, th long, n_shingles long, digest binary, sig array<long>")


def postings(classes: DataFrame, scratch: Scratch) -> DataFrame:
    """(key, class_no, shared): the prefixes of shared signature values, and
    how many of its values a class shares."""
    rows = classes.select("class_no", F.posexplode("sig").alias("at", "value")).select(
        "class_no", (F.col("at") * F.lit(1 << 32) + F.col("value")).alias("key"))
    often = scratch.save(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    mine = rows.join(often, "key").groupBy("class_no").agg(
        F.sort_array(F.collect_list(F.struct("n", "key"))).alias("values"))
    posted = (mine.where(F.size("values") >= MATCHES)
              .select("class_no", F.size("values").alias("shared"),
                      F.explode(F.slice("values", F.lit(1), F.size("values") - (MATCHES - 1))).alias("v"))
              .select(F.col("v.key").alias("key"), "class_no", "shared"))
    out = scratch.save(posted)
    scratch.drop(often)
    return out


def _compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    last, mine = None, np.empty(0, np.uint64)
    for batch in batches:
        linked = []
        for a, x, y in zip(batch["a"], batch["x"], batch["y"]):
            if a != last:
                last, mine = a, shingles(x)
            other = shingles(y)
            both = len(np.intersect1d(mine, other, assume_unique=True))
            linked.append(100 * both >= PERCENT * (len(mine) + len(other) - both))
        yield batch.loc[linked, ["a", "b"]]


def confirm(pairs: DataFrame, classes: DataFrame, texts: DataFrame, scratch: Scratch) -> DataFrame:
    """Of pairs (a, b) those that agree in MATCHES coordinates and whose
    full sets reach the similarity."""
    sig = classes.select("class_no", "sig")
    agree = F.size(F.filter(F.zip_with("sa", "sb", lambda p, q: p == q), lambda same: same))
    likely = scratch.save(
        pairs.join(sig.select(F.col("class_no").alias("a"), F.col("sig").alias("sa")), "a")
        .join(sig.select(F.col("class_no").alias("b"), F.col("sig").alias("sb")), "b")
        .where(agree >= MATCHES).select("a", "b"))
    full = (likely.join(texts.select(F.col("class_no").alias("b"), F.col("text").alias("y")), "b")
            .join(texts.select(F.col("class_no").alias("a"), F.col("text").alias("x")), "a")
            .select("a", "b", "x", "y"))
    out = scratch.save(full.mapInPandas(_compare, "a long, b long"))
    scratch.drop(likely)
    return out


def star_pairs(posted: DataFrame, scratch: Scratch) -> DataFrame:
    """(a, b): the members of every list with the list's leader."""
    leaders = scratch.save(
        posted.groupBy("key").agg(F.min(F.struct(-F.col("shared"), F.col("class_no"))).alias("l"),
                                  F.count(F.lit(1)).alias("n"))
        .where("n > 1").select("key", F.col("l.class_no").alias("leader")))
    return scratch.save(posted.join(leaders, "key").where("class_no <> leader").select(
        F.least("class_no", "leader").alias("a"), F.greatest("class_no", "leader").alias("b")).distinct())


def _shingle_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for a in range(0, len(batch), 500):
            part = batch.iloc[a:a + 500]
            sets = [shingles(t) for t in part["text"]]
            yield pd.DataFrame({"class_no": np.repeat(part["class_no"].to_numpy(), [len(s) for s in sets]),
                                "shingle": np.concatenate(sets).view(np.int64)})


def _profile(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        parts = [np.bincount((shingles(t) % np.uint64(PARTS)).astype(int), minlength=PARTS) for t in batch["text"]]
        yield pd.DataFrame({"class_no": batch["class_no"], "parts": parts})


def rest_pairs(posted: DataFrame, known: DataFrame, classes: DataFrame, texts: DataFrame,
               scratch: Scratch) -> DataFrame:
    """(a, b): pairs that share a list, are in different components and may
    link by their counts."""
    here = scratch.save(posted.join(known.withColumnRenamed("node", "class_no"), "class_no", "left").select(
        "key", "class_no", F.coalesce("component", "class_no").alias("c")))
    mixed_ = here.groupBy("key").agg(F.min("c").alias("x"), F.max("c").alias("y")).where("x <> y").select("key")
    open_ = scratch.save(here.join(scratch.save(mixed_), "key"))
    members = scratch.save(open_.select("class_no").distinct())
    theirs = scratch.save(texts.join(members, "class_no"))
    at = F.shiftright("key", 32)
    # as an unsigned number modulo PARTS, a power of two: the low bits
    part = F.col("shingle").bitwiseAND(F.lit(PARTS - 1)).cast("int")
    alone = (theirs.mapInPandas(_shingle_rows, "class_no long, shingle long")
             .groupBy("shingle").agg(F.count(F.lit(1)).alias("n"), F.min("class_no").alias("class_no"))
             .where("n = 1").groupBy("class_no").agg(*[
                 F.count(F.when(part == k, 1)).cast("int").alias(f"p{k}") for k in range(PARTS)])
             .select("class_no", F.array(*[f"p{k}" for k in range(PARTS)]).alias("alone")))
    sized = (theirs.mapInPandas(_profile, "class_no long, parts array<int>")
             .join(classes.select("class_no", F.col("n_shingles").alias("n")), "class_no")
             .join(alone, "class_no", "left")
             .withColumn("v", F.when(F.col("alone").isNull(), F.col("parts")).otherwise(
                 F.zip_with("parts", "alone", lambda p, q: p - q)))
             .withColumn("s", F.aggregate("v", F.lit(0), lambda a, x: a + x).cast("long"))
             .withColumn("most", F.floor(F.col("s") * 7 / 3).cast("long") - F.col("n"))
             .where("4 * most >= 3 * n")
             .join(open_.groupBy("class_no").agg(*[
                 F.max(F.when(at == k, F.col("key"))).alias(f"k{k}") for k in range(COORDS)]), "class_no")
             .select("class_no", "n", "most", "v", *[f"k{k}" for k in range(COORDS)]))
    rows = open_.join(scratch.save(sized), "class_no")
    bucket = lambda x: F.floor(F.log(x.cast("double")) / F.log(F.lit(BUCKET)) + 1e-9).cast("int")
    # a class's lists by coordinate; a number for none that no other side has
    lists = lambda none: F.array(*[F.coalesce(f"k{k}", F.lit(none).cast("long")) for k in range(COORDS)])
    least, most = F.ceil(F.col("n") * 3 / 4), F.least("most", F.floor(F.col("n") * 4 / 3))
    long = rows.withColumn("short", F.explode(F.sequence(bucket(least), bucket(F.least("most", "n"))))).select(
        "key", "short", bucket(F.col("n")).alias("long"), F.col("class_no").alias("a"), F.col("c").alias("ca"),
        F.col("n").alias("na"), F.col("most").alias("ma"), F.col("v").alias("va"), lists(-1).alias("ka"))
    short = rows.where("most >= n").withColumn("long", F.explode(F.sequence(bucket(F.col("n")), bucket(most)))).select(
        "key", bucket(F.col("n")).alias("short"), "long", F.col("class_no").alias("b"), F.col("c").alias("cb"),
        F.col("n").alias("nb"), F.col("most").alias("mb"), F.col("v").alias("vb"), lists(-2).alias("kb"))
    shared = F.aggregate(F.zip_with("va", "vb", lambda x, y: F.least(x, y)), F.lit(0), lambda x, y: x + y)
    # ends at the first coordinate in common: similar classes have one early on
    first = reduce(lambda x, y: x & y, [(at <= k) | (F.get("ka", F.lit(k)) != F.get("kb", F.lit(k))) for k in range(COORDS - 1)])
    met = (scratch.save(long).join(scratch.save(short), ["key", "short", "long"])
           .where("ca <> cb and nb <= na and nb <= ma and na <= mb and (nb < na or a < b)").where(first)
           .where(7 * shared >= 3 * (F.col("na") + F.col("nb"))))
    return scratch.save(met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())


def link_components(classes: DataFrame, posted: DataFrame, texts: DataFrame,
                    scratch: Scratch) -> DataFrame:
    """(node, component) of the classes that link with another."""
    links = confirm(star_pairs(posted, scratch), classes, texts, scratch)
    known = components(links, scratch)
    rest = confirm(rest_pairs(posted, known, classes, texts, scratch), classes, texts, scratch)
    if not rest.limit(1).count():
        return known
    return components(links.union(rest), scratch)


def labelled(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, th and c (one row per row);
    ``c`` is the component's own key, null for texts without words."""
    scratch = Scratch(docs.sparkSession, "minhash")
    signed = scratch.save(sign(docs))
    classes = scratch.save(
        signed.where("n_shingles > 0").groupBy("digest")
        .agg(F.first("sig").alias("sig"), F.first("n_shingles").alias("n_shingles"), F.min("doc_id").alias("least_id"),
             F.min(F.struct("doc_id", "th")).alias("one"))
        .withColumn("class_no", F.monotonically_increasing_id()))
    posted = postings(classes, scratch)
    wanted = (classes.join(posted.select("class_no").distinct(), "class_no")
              .select("class_no", F.col("one.doc_id").alias("_id"), F.col("one.th").alias("_th")))
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("th"))
    texts = scratch.save(
        keyed.join(wanted, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("th") == F.col("_th")))
        .select("class_no", "text").dropDuplicates(["class_no"]))
    known = link_components(classes, posted, texts, scratch)
    scratch.drop(posted, texts)
    label = classes.select("class_no", "digest", "least_id")
    label = label.join(known.withColumnRenamed("node", "class_no"), "class_no", "left").withColumn(
        "c", F.coalesce("component", "class_no"))
    least = label.groupBy("c").agg(F.min("least_id").alias("component_id"))
    label = scratch.save(label.join(least, "c").select("digest", "component_id", "c"))
    out = signed.join(label, "digest", "left").withColumn(
        "component_id", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")))
    return out.select("doc_id", "n_shingles", "component_id",
                      F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "th", "c")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept (one row per row) + th."""
    return labelled(docs).drop("c")


def dedup(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component: the one of the smallest id,
    of the texts under that id the one of least hash, of equal rows any.
    Texts without words all stay."""
    alone = F.col("c").isNull()
    each = labelled(docs).where("kept").groupBy("c", "doc_id", "th").agg(F.count(F.lit(1)).alias("n"))
    own_id, own_hash, of, again = free_names(docs, "_id", "_th", "_c", "_again")
    found = (each.groupBy("c", F.when(alone, F.struct("doc_id", "th")).alias("own"))
             .agg(F.min(F.struct("doc_id", "th", "n")).alias("l"))
             .select(F.col("l.doc_id").alias(own_id), F.col("l.th").alias(own_hash), F.col("c").alias(of),
                     (~alone & (F.col("l.n") > 1)).alias(again)))
    found = Scratch(docs.sparkSession, "minhash").save(found)
    joined = docs.join(found, F.col("doc_id").eqNullSafe(F.col(own_id)) & (F.xxhash64("text") == F.col(own_hash)))
    # only rows that repeat id and text need to meet, map sides first
    one = joined.where(F.col(again)).groupBy(of).agg(F.first(F.struct(*docs.columns)).alias("row"))
    return joined.where(~F.col(again)).select(*docs.columns).unionAll(one.select("row.*"))


#: ``near_duplicates`` in DuckDB's SQL, from the definition: shingles in common
#: counted for all pairs that have any, then reachability. For small tables.
MINHASH_SQL = """
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\\x20\\x09-\\x0D]+') AS w FROM {documents}),
words AS (SELECT r, len(w) AS total, generate_subscripts(w, 1) AS p, unnest(w) AS word FROM d),
runs AS (SELECT r, p, total, string_agg(word, ' ') OVER f AS k, count(*) OVER f AS n FROM words
         WINDOW f AS (PARTITION BY r ORDER BY p ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING)),
sets AS MATERIALIZED (SELECT DISTINCT r, md5(k) AS k FROM runs WHERE n = 5 OR (total < 5 AND p = 1)),
sizes AS (SELECT r, count(*) AS n FROM sets GROUP BY r),
common AS (SELECT x.r AS a, y.r AS b, count(*) AS n FROM sets x JOIN sets y ON x.k = y.k AND x.r <> y.r GROUP BY ALL),
links AS MATERIALIZED (SELECT a, b FROM common c JOIN sizes x ON x.r = a JOIN sizes y ON y.r = b
                       WHERE 100 * c.n >= 75 * (x.n + y.n - c.n)),
reach(a, b) AS (SELECT r, r FROM d UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least AS (SELECT reach.a AS r, min(o.doc_id) AS component_id FROM reach JOIN d o ON o.r = reach.b GROUP BY reach.a)
SELECT d.doc_id, coalesce(sizes.n, 0)::BIGINT AS n_shingles, component_id,
  d.doc_id IS NOT DISTINCT FROM component_id AS kept
FROM d JOIN least USING (r) LEFT JOIN sizes USING (r)
"""


ship(__name__)
