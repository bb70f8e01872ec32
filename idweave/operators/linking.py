"""Linking vendors: pair files, cross-vendor matches, residual population.

Skew and fan-out rules used throughout:

* blank keys are not person keys: non-e-mail pair rows with a blank B key
  are dropped before the join to the history (a placeholder key would
  otherwise link every blank-key history row to every blank-key pair, the
  hot-group product); e-mail-only pairs keep them, since only their A key
  is used and the anti join against the history cannot multiply rows;
* lookup sides are reduced to distinct rows before the shuffle, and joined
  by ``keyed_join``, so that AQE can split a hot key of the other side;
* the residual anti join with an OR of two composite keys (a nested-loop
  join in Spark) is one hash-partitioned anti join against both keys of
  every matched row;
* ranking inside a block group is an expression over one row of flags per
  group: no group is sorted or gathered in one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from idweave.functions.demographics import attribute_count
from idweave.functions.ids import person_id, split_part
from idweave.functions.meta import meta_literal
from idweave.functions.text import non_blank
from idweave.operators.history import HistorySpec
from idweave.operators.joins import keyed_join


def _pairs(pairs: DataFrame, keys: Sequence[str], pair_col: str, flag_col: str, email: bool) -> DataFrame:
    flag = F.col(flag_col)
    if email:
        cond = flag == "Y"
    else:
        cond = (flag != "Y") & reduce(lambda a, b: a & b, [non_blank(F.col(k)) for k in keys])
    return pairs.where(cond).select(*keys, pair_col).distinct()


def link_non_email(history: DataFrame, pairs: DataFrame, spec: HistorySpec = HistorySpec(),
                   pair_col: str = "A_PAIR", flag_col: str = "EMAIL_FLAG",
                   meta: Mapping | None = None) -> DataFrame:
    """Every history row, with the A persons paired to its B key by a
    non-e-mail match (flag not 'Y'; a null flag is not a match). A B key
    paired to several A persons gives one row each, same person id."""
    p = _pairs(pairs, spec.keys, pair_col, flag_col, email=False)
    out = keyed_join(history, p, list(spec.keys), how="left")
    base = [c for c in history.columns if c != spec.meta]
    return out.select(
        *[F.col(c) for c in base], F.col(pair_col),
        split_part(F.col(pair_col), 0).alias("A_HHID"),
        split_part(F.col(pair_col), 1).alias("A_INDID"),
        meta_literal(meta).alias(spec.meta),
    )


def link_email_only(history: DataFrame, pairs: DataFrame, quarter: str, created,
                    spec: HistorySpec = HistorySpec(), pair_col: str = "A_PAIR",
                    flag_col: str = "EMAIL_FLAG", meta: Mapping | None = None,
                    a_namespace: str = "A",
                    weights: Sequence[str] = ("PERSON_WGT", "HOUSEHOLD_WGT")) -> DataFrame:
    """People known only through an e-mail pair (flag 'Y') whose B key is
    not in the history. Their respondent and B key are blank and those of
    ``weights`` that the history has are 0 in the history's type; the person
    id is minted from the A key they are known by, or from the whole pair
    where that is no key of two parts."""
    p = _pairs(pairs, spec.keys, pair_col, flag_col, email=True)
    known = history.select(*spec.keys).where(spec.key_not_null()).distinct()
    fresh = keyed_join(p, known, list(spec.keys), how="left_anti")
    a_hh, a_ind = split_part(F.col(pair_col), 0), split_part(F.col(pair_col), 1)
    return fresh.select(
        F.lit("").alias(spec.resp), *[F.lit("").alias(k) for k in spec.keys],
        F.coalesce(person_id(a_hh, a_ind, namespace=a_namespace),
                   person_id(F.coalesce(pair_col, F.lit("")), namespace=f"{a_namespace}-PAIR")).alias(spec.person),
        *[F.lit("0").cast(history.schema[w].dataType).alias(w) for w in weights if w in history.columns],
        F.lit(quarter).cast("string").alias(spec.quarter), F.lit(created).alias(spec.created),
        F.col(pair_col), a_hh.alias("A_HHID"), a_ind.alias("A_INDID"),
        meta_literal(meta).alias(spec.meta),
    )


def linked_history(non_email: DataFrame, email_only: DataFrame) -> DataFrame:
    """Both link passes in one relation (name-aligned, missing columns null)."""
    return non_email.unionByName(email_only, allowMissingColumns=True)


def vendor_match(norm_a: DataFrame, norm_b: DataFrame, resp: str = "RESP_ID",
                 a_keys: Sequence[str] = ("A_HHID", "A_INDID"),
                 b_keys: Sequence[str] = ("B_HHID", "B_INDID"),
                 previous: DataFrame | None = None) -> DataFrame:
    """Persons of both vendors resolved to the same respondent, one row per
    distinct (respondent, B person, A person) with the B person's id.

    Both sides are reduced to distinct (respondent, key) first and blank
    respondents are dropped (a blank id is not a respondent). ``previous``
    (an earlier result of this function) is unioned in before the final
    distinct, so earlier links are kept."""
    a = norm_a.where(non_blank(F.col(resp))).select(resp, *a_keys).distinct()
    b = norm_b.where(non_blank(F.col(resp))).select(resp, *b_keys).distinct()
    out = keyed_join(a, b, [resp]).select(
        resp, *b_keys, *a_keys, person_id(*b_keys).alias("PERSON_ID"))
    if previous is not None:
        out = out.unionByName(previous.select(*out.columns)).distinct()
    return out


def residual_population(everyone: DataFrame, matched: DataFrame,
                        b_keys: Sequence[str] = ("B_HHID", "B_INDID"),
                        a_keys: Sequence[str] = ("A_HHID", "A_INDID"),
                        keys: Sequence[str] = ("HHID", "INDID")) -> DataFrame:
    """Everyone whose key is in the match under neither vendor's key (keys
    compared across vendors, as in the reference).

    The reference's anti join on ``(B key) OR (A key)`` plans as a
    broadcast nested-loop join. Here both keys of every matched row are
    exploded into one key set (one pass over ``matched``, reduced map-side)
    and removed with a single hash-partitioned anti join."""
    both = F.explode(F.array(
        F.struct(*[F.col(c).alias(k) for c, k in zip(b_keys, keys)]),
        F.struct(*[F.col(c).alias(k) for c, k in zip(a_keys, keys)]))).alias("_k")
    key_set = matched.select(both).select(*[F.col(f"_k.{k}").alias(k) for k in keys]).distinct()
    return keyed_join(everyone, key_set, list(keys), how="left_anti").select(*everyone.columns)


def residual_within_source(everyone: DataFrame, matched: DataFrame, source: str = "DATA_SOURCE",
                           sides: Mapping[str, Sequence[str]] | None = None,
                           keys: Sequence[str] = ("HHID", "INDID")) -> DataFrame:
    """As ``residual_population``, but a vendor's rows are compared with the
    match's keys of that vendor alone, so that a person of one vendor is not
    taken for matched because the other vendor has matched an equal key.
    ``sides``: value of ``source`` -> key columns in ``matched``. Rows of any
    other source all stay."""
    sides = sides or {"A": ("A_HHID", "A_INDID"), "B": ("B_HHID", "B_INDID")}
    both = F.explode(F.array(*[
        F.struct(F.lit(name).alias(source), *[F.col(c).alias(k) for c, k in zip(columns, keys)])
        for name, columns in sides.items()])).alias("_k")
    known = matched.select(both).select("_k.*").distinct()
    return keyed_join(everyone, known, [source, *keys], how="left_anti").select(*everyone.columns)


def with_attribute_count(df: DataFrame, col: str = "ATTRIBUTE_COUNT") -> DataFrame:
    return df.withColumn(col, attribute_count())


def rank_completeness(df: DataFrame, group: str = "BLOCK_GROUP", score: str = "ATTRIBUTE_COUNT",
                      out: str = "DENSE_RANK", most: int = 4) -> DataFrame:
    """Dense rank of ``score`` (an integer from 0 to ``most``, highest first)
    inside each ``group`` (a null group is one group). Each group is reduced
    to a flag per score; a row's rank is one more than the flags set above
    its score. The flags of a group are one row, joined by ``keyed_join``, so
    the rows of a huge group stay spread over tasks."""
    flags = df.groupBy(group).agg(*[
        F.max((F.col(score) == s).cast("int")).alias(f"_has{s}") for s in range(1, most + 1)])
    above = sum((F.when(F.col(score) < s, F.coalesce(F.col(f"_has{s}"), F.lit(0))).otherwise(0)
                 for s in range(1, most + 1)), F.lit(0))
    joined = keyed_join(df, flags, [group], how="left", null_safe=True)
    return joined.select(*df.columns, (above + 1).cast("int").alias(out))


def panel_crosswalk(pop: DataFrame, id_res: DataFrame, quarter: str, created,
                    keys: Sequence[str] = ("B_HHID", "B_INDID"), resp: str = "RESP_ID") -> DataFrame:
    """Every population person with its respondent (null when unresolved)
    and a person id."""
    p = pop.select(*keys)
    r = id_res.select(*keys, resp)
    return keyed_join(p, r, list(keys), how="left").select(
        resp, *keys, person_id(*keys).alias("PERSON_ID"),
        F.lit(quarter).cast("string").alias("QUARTER_CREATED"), F.lit(created).alias("CREATED"))


def append_attributes(resolution: DataFrame, pop: DataFrame, left_key: str, right_key: str,
                      suffix: str = "_R") -> DataFrame:
    """``resolution.*`` plus every population column, joined on one key
    with different names; clashing right-side names get ``suffix``."""
    lnames = {c.upper() for c in resolution.columns}
    renamed = {c: (c + suffix if c.upper() in lnames else c) for c in pop.columns}
    right = pop.select(*[F.col(c).alias(renamed[c]) for c in pop.columns])
    right = right.withColumn("_on", F.col(renamed[right_key]))
    joined = keyed_join(resolution, right, [left_key], ["_on"], "left")
    return joined.select(*resolution.columns, *renamed.values())


def vendor_members(norm_a: DataFrame, norm_b: DataFrame, resp: str = "RESP_ID",
                   a_keys: Sequence[str] = ("A_HHID", "A_INDID"), b_keys: Sequence[str] = ("B_HHID", "B_INDID"),
                   keys: Sequence[str] = ("HHID", "INDID")) -> DataFrame:
    """``vendor_match`` without its products: the match as a graph.

    A respondent whom a persons of vendor A and b persons of vendor B resolve
    to makes a * b rows there and a + b rows here: one per distinct person,
    with ``SIDE`` ('A' or 'B'), the key, whether it is the respondent's
    representative of its side (the least key), and the ``PERSON_ID`` of the
    B representative, which every member is linked to. Respondents known to
    one vendor alone and blank ones are left out. One aggregate per
    respondent, joined back so that a hot respondent's rows stay spread."""
    def side(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
        known = df.where(non_blank(F.col(resp)))
        return known.select(resp, F.lit(name).alias("SIDE"), *[F.col(c).alias(k) for c, k in zip(columns, keys)])

    members = side(norm_a, a_keys, "A").unionByName(side(norm_b, b_keys, "B")).distinct()
    key = F.struct(*keys)
    ends = members.groupBy(resp).agg(
        F.min(F.when(F.col("SIDE") == "A", key)).alias("_a"), F.min(F.when(F.col("SIDE") == "B", key)).alias("_b"))
    ends = ends.where(F.col("_a").isNotNull() & F.col("_b").isNotNull())
    joined = keyed_join(members, ends, [resp])
    least = F.when(F.col("SIDE") == "A", F.col("_a")).otherwise(F.col("_b"))
    return joined.select(resp, "SIDE", *keys, key.eqNullSafe(least).alias("IS_REPRESENTATIVE"),
                         person_id(*[F.col("_b")[k] for k in keys]).alias("PERSON_ID"))


def expand_members(members: DataFrame, resp: str = "RESP_ID", a_keys: Sequence[str] = ("A_HHID", "A_INDID"),
                   b_keys: Sequence[str] = ("B_HHID", "B_INDID"),
                   keys: Sequence[str] = ("HHID", "INDID")) -> DataFrame:
    """The rows of ``vendor_match`` again, for readers that want all pairs."""
    a, b = (members.where(F.col("SIDE") == name).select(resp, *[F.col(k).alias(c) for k, c in zip(keys, columns)])
            for name, columns in (("A", a_keys), ("B", b_keys)))
    return keyed_join(a, b, [resp]).select(resp, *b_keys, *a_keys, person_id(*b_keys).alias("PERSON_ID"))


def residual_of_members(everyone: DataFrame, members: DataFrame,
                        keys: Sequence[str] = ("HHID", "INDID")) -> DataFrame:
    """``residual_population`` straight from the members: no pair is made."""
    return keyed_join(everyone, members.select(*keys).distinct(), list(keys), how="left_anti").select(*everyone.columns)
