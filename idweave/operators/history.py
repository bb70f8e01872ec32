"""Append-only identity history ("crosswalk").

A *match snapshot* is one matching run: rows of (respondent id, vendor
person key, payload). The history keeps every version of every person:

* the **initial** load stamps each snapshot row with a person id;
* every later snapshot adds **new** rows (person key never seen) and
  **changed** rows (known person, respondent id not yet recorded for that
  person), the latter keeping the person id from the history;
* the **latest** view keeps, per person key, the rows with the newest
  ``CREATED`` value; **members_of** keeps the history rows of the persons
  in a given snapshot.

Scale notes (history ~ 10^9 rows, snapshot ~ 3*10^8):

``advance_delta`` stacks the history and the snapshot and reduces both in one
aggregate per (key, respondent), map-side first; a second aggregate makes
one summary row per key, which is joined back. Each input is scanned once
and four exchanges run in all. Every join has a side of one row per key and
goes through ``keyed_join``, so a person with many versions, or a hot
placeholder key, never multiplies rows and never fills one task.

Null key parts: such a key is a person by its null pattern, compared
null-safely with what is recorded, with an id minted from the pattern; it is
new once, never changed, and never in the latest view.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from idweave.functions.ids import null_person_id, person_id
from idweave.functions.meta import meta_literal
from idweave.operators import sketches
from idweave.operators.joins import keyed_join


@dataclass(frozen=True)
class HistorySpec:
    """Column roles of one vendor's history."""

    keys: tuple[str, ...] = ("B_HHID", "B_INDID")
    resp: str = "RESP_ID"
    person: str = "PERSON_ID"
    quarter: str = "QUARTER_CREATED"
    created: str = "CREATED"
    meta: str = "META"
    namespace: str | None = None

    def payload(self, df: DataFrame) -> list[str]:
        fixed = set(self.keys) | {self.resp}
        return [c for c in df.columns if c not in fixed]

    def key_not_null(self, df: DataFrame | None = None) -> Column:
        cols = [F.col(k) if df is None else df[k] for k in self.keys]
        return reduce(lambda a, b: a & b, [c.isNotNull() for c in cols])

    def new_id(self) -> Column:
        return F.coalesce(person_id(*self.keys, namespace=self.namespace),
                          null_person_id(*self.keys, namespace=self.namespace))


def _stamp(df: DataFrame, spec: HistorySpec, payload: Sequence[str], quarter: str,
           created, meta: Mapping | None, pid: Column | None = None,
           extra: Sequence[Column] = ()) -> DataFrame:
    return df.select(
        F.col(spec.resp), *[F.col(k) for k in spec.keys],
        (pid if pid is not None else spec.new_id()).alias(spec.person),
        *[F.col(c) for c in payload],
        F.lit(quarter).cast("string").alias(spec.quarter),
        F.lit(created).alias(spec.created),
        meta_literal(meta).alias(spec.meta),
        *extra,
    )


def _min_row(df: DataFrame, group: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One deterministic survivor per ``group``: the row with the smallest
    ``order`` tuple (nulls first). A map-side partial aggregate, so a hot
    group is reduced before the shuffle instead of landing in one task."""
    if not order:
        return df.select(*group).distinct()
    packed = F.min(F.struct(*[F.col(c) for c in order])).alias("_s")
    return df.groupBy(*group).agg(packed).select(*group, *[F.col("_s")[c].alias(c) for c in order])


def dedup_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """Keep one row per key; the survivor is the smallest by ``order``
    (default: all other columns in their order). Deterministic, unlike
    ``dropDuplicates(keys)``."""
    order = list(order) if order is not None else [c for c in df.columns if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in order]
    out = _min_row(df, keys, list(order) + rest)
    return out.select(*df.columns)


def initial_history(match: DataFrame, spec: HistorySpec, quarter: str, created,
                    meta: Mapping | None = None, dedupe: bool = False) -> DataFrame:
    """First load: every snapshot row becomes a history row with a fresh id.
    ``dedupe=True`` keeps one row per key, as the incremental step does."""
    payload = spec.payload(match)
    src = dedup_by_key(match, spec.keys, [spec.resp, *payload]) if dedupe else match
    return _stamp(src, spec, payload, quarter, created, meta)


def new_records(match: DataFrame, history: DataFrame, spec: HistorySpec, quarter: str,
                created, meta: Mapping | None = None) -> DataFrame:
    """Snapshot rows whose key is not in the history, one per key (null
    parts compared null-safely)."""
    payload = spec.payload(match)
    known = history.select(*spec.keys).distinct()
    fresh = keyed_join(match, known, spec.keys, how="left_anti", null_safe=True)
    fresh = dedup_by_key(fresh.select(spec.resp, *spec.keys, *payload), spec.keys,
                         [spec.resp, *payload])
    return _stamp(fresh, spec, payload, quarter, created, meta)


def changed_records(match: DataFrame, history: DataFrame, spec: HistorySpec, quarter: str,
                    created, meta: Mapping | None = None) -> DataFrame:
    """Changed-record step: snapshot rows of a known person whose respondent
    is not yet recorded for that person (some recorded version differs),
    keeping the history's person id; one row per (key, respondent)."""
    d = advance_delta(history, match, spec, quarter, created, meta, with_kind=True)
    return d.where(F.col("KIND") == "changed").drop("KIND")


def advance_delta(history: DataFrame, match: DataFrame, spec: HistorySpec, quarter: str,
                  created, meta: Mapping | None = None, partitions: int | None = None,
                  compare_to: str = "all", with_kind: bool = False) -> DataFrame:
    """Rows one snapshot adds to the history: new persons, then changed
    respondents, with the same rows as the reference's new-then-changed
    sequence (changed rows deduplicated).

    A snapshot row ``a`` with key ``k`` is
    * NEW when ``k`` is not in the history (one survivor per key, the
      smallest by (respondent, payload));
    * CHANGED when ``k`` is known, ``a.resp`` is not null, the history has a
      non-null respondent for ``k`` and none equal to ``a.resp`` (so some
      recorded version differs). Also when ``k`` is new and ``a.resp`` differs
      from the NEW survivor's respondent (the reference appends new rows
      before looking for changes). A key with a null part is never CHANGED.

    ``compare_to="latest"`` judges a change against the key's latest
    recorded respondent only (newest ``created``, ties to the larger id),
    so a person who returns to an earlier respondent (A -> B -> A) is
    appended again and the latest view stays current; the default
    ``"all"`` keeps the reference's behaviour.

    ``with_kind`` adds ``KIND`` ('new' / 'changed') to every row.

    ``partitions``: when the history is a table bucketed by the person key
    into that many buckets, hash-partition the snapshot the same way; the
    recorded versions and the summary are then made on the buckets and the
    history is not shuffled at all (``HistoryStore(bucketed=...)``).
    """
    if compare_to not in ("all", "latest"):
        raise ValueError("compare_to must be 'all' or 'latest'")
    K, R = list(spec.keys), spec.resp
    payload = spec.payload(match)
    packed = F.struct(*[F.col(c) for c in payload]) if payload else F.struct(F.lit(0).alias("none"))
    if partitions:
        # the few keys with null parts go the other way: buckets join on equality
        odd = advance_delta(history.where(~spec.key_not_null(history)), match.where(~spec.key_not_null(match)),
                            spec, quarter, created, meta, compare_to=compare_to, with_kind=with_kind)
        versions, summary = _bucketed_versions(history.where(spec.key_not_null(history)),
                                               match.where(spec.key_not_null(match)), spec, packed, partitions)
        rows = versions.join(summary, _same(versions, summary, K), "left").select(
            *[versions[c] for c in versions.columns], *[summary[c] for c in SUMMARY])
    else:
        versions = _stacked_versions(history, match, spec, packed)
        rows = keyed_join(versions, _summary(versions, K, R), K, how="left", null_safe=True)
    rows = rows.where(F.col("_row").isNotNull())
    r, first = F.col(R), F.col("_first")[R]
    fresh = F.col("_pid").isNull()
    has_key = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in K])
    is_new = fresh & r.eqNullSafe(first)
    changed_new = fresh & has_key & r.isNotNull() & first.isNotNull() & (r != first)
    if compare_to == "latest":
        # no version is newer than the newest; naming _at here lets both uses of
        # the versions share one exchange
        newest = F.col("_at").isNull() | (F.col("_at") <= F.col("_last")["_at"])
        changed_old = ~fresh & has_key & r.isNotNull() & (r != F.col("_last")[R]) & newest
    else:
        changed_old = (~fresh & has_key & r.isNotNull() & (F.col("_recorded") > 0)
                       & F.col("_vpid").isNull())
    kept = rows.where(F.coalesce(is_new | changed_new | changed_old, F.lit(False)))
    # a version's own id is one of those that the key's id is the least of
    pid = F.when(fresh, spec.new_id()).otherwise(F.least("_pid", "_vpid"))
    kind = [F.when(is_new, "new").otherwise("changed").alias("KIND")] if with_kind else []
    out = kept.select(*K, R, pid.alias("_id"), *[F.col("_row")[c].alias(c) for c in payload], *kind)
    out = _stamp(out, spec, payload, quarter, created, meta, pid=F.col("_id"),
                 extra=[F.col("KIND")] if with_kind else ())
    return out.unionByName(odd) if partitions else out


def advance_delta_pruned(history: DataFrame, match: DataFrame, spec: HistorySpec, quarter: str, created,
                         meta: Mapping | None = None, bits: int = sketches.BITS, compare_to: str = "all",
                         with_kind: bool = False) -> DataFrame:
    """``advance_delta`` of the history rows whose person may be in the
    snapshot. What is recorded of other persons decides nothing, so a Bloom
    filter of the snapshot's keys (``bits / 8`` bytes, null parts included)
    keeps these rows out of the shuffle; the advance itself stays exact. The
    snapshot is read once more for the filter."""
    return advance_delta(concerned(history, match, spec, bits), match, spec, quarter, created, meta,
                         compare_to=compare_to, with_kind=with_kind)


def concerned(history: DataFrame, match: DataFrame, spec: HistorySpec, bits: int = sketches.BITS) -> DataFrame:
    """The history rows of persons that may be in the snapshot."""
    return sketches.maybe_in(history, sketches.key_filter(match, spec.keys, bits), spec.keys, bits)


#: What ``_summary`` knows of a key: its recorded id, recorded respondents,
#: newest recorded (created, respondent) and least snapshot row.
SUMMARY = ("_pid", "_recorded", "_last", "_first")


def _stacked_versions(history: DataFrame, match: DataFrame, spec: HistorySpec, packed: Column) -> DataFrame:
    """One row per (key, respondent) of either input: the recorded id and
    newest created, the snapshot's smallest payload."""
    K, R = list(spec.keys), spec.resp
    created = history.schema[spec.created].dataType
    person = history.schema[spec.person].dataType
    kind = match.select(packed.alias("_row")).schema["_row"].dataType
    old = history.select(*K, R, F.col(spec.person).alias("_vpid"), F.col(spec.created).alias("_at"),
                         F.lit(None).cast(kind).alias("_row"))
    new = match.select(*K, R, F.lit(None).cast(person).alias("_vpid"), F.lit(None).cast(created).alias("_at"),
                       packed.alias("_row"))
    return old.unionByName(new).groupBy(*K, R).agg(
        F.min("_vpid").alias("_vpid"), F.max("_at").alias("_at"), F.min("_row").alias("_row"))


def _summary(versions: DataFrame, K: list[str], R: str) -> DataFrame:
    """One row per key: see ``SUMMARY``."""
    recorded = F.col("_vpid").isNotNull()
    return versions.groupBy(*K).agg(
        F.min("_vpid").alias("_pid"), F.count(F.when(recorded, F.col(R))).alias("_recorded"),
        F.max(F.when(recorded, F.struct("_at", R))).alias("_last"),
        F.min(F.when(F.col("_row").isNotNull(), F.struct(R, "_row"))).alias("_first"))


def _bucketed_versions(history: DataFrame, match: DataFrame, spec: HistorySpec, packed: Column,
                       partitions: int) -> tuple[DataFrame, DataFrame]:
    """As ``_stacked_versions`` and ``_summary`` for a history bucketed by
    the person key: nothing but the snapshot is shuffled."""
    K, R = list(spec.keys), spec.resp
    snap = match.repartition(partitions, *K).groupBy(*K, R).agg(F.min(packed).alias("_row"))
    old = history.groupBy(*K, R).agg(F.min(spec.person).alias("_vpid"), F.max(spec.created).alias("_at"))
    versions = snap.join(old, _same(snap, old, K) & snap[R].eqNullSafe(old[R]), "left").select(
        *[snap[c] for c in [*K, R]], old["_vpid"], old["_at"], snap["_row"])
    known = _summary(old.withColumn("_row", F.lit(None).cast(versions.schema["_row"].dataType)), K, R).drop("_first")
    least = snap.groupBy(*K).agg(F.min(F.struct(R, "_row")).alias("_first"))
    summary = least.join(known, _same(least, known, K), "left").select(
        *[least[k] for k in K], *[known[c] for c in SUMMARY[:3]], least["_first"])
    return versions, summary


def _same(a: DataFrame, b: DataFrame, columns: Sequence[str]) -> Column:
    return reduce(lambda x, y: x & y, [a[c] == b[c] for c in columns])


def advance(history: DataFrame, match: DataFrame, spec: HistorySpec, quarter: str,
            created, meta: Mapping | None = None, partitions: int | None = None,
            compare_to: str = "all") -> DataFrame:
    """History after one snapshot (append only)."""
    delta = advance_delta(history, match, spec, quarter, created, meta, partitions, compare_to)
    return history.unionByName(delta.select(*history.columns))


def latest(history: DataFrame, spec: HistorySpec, bucketed: bool = False) -> DataFrame:
    """Per person key, the rows with the newest ``created`` (ties kept).

    Rows with a null key part or null ``created`` are dropped, as the
    reference's correlated ``IN (max ...)`` does. Computed as a partial
    max per key plus a semi join: no window, so no group is buffered in one
    task, and the join splits hot keys. The scan behind the maxima reads the
    key and ``created`` only. ``bucketed``: the history is a table bucketed by
    the key; the join runs on the buckets, without any shuffle."""
    K, T = list(spec.keys), spec.created
    h = history.where(spec.key_not_null(history))
    newest = h.groupBy(*K).agg(F.max(T).alias("_newest"))
    if bucketed:
        return h.join(newest, _same(h, newest, K) & (h[T] >= newest["_newest"]), "left_semi")
    return keyed_join(h, newest, K, how="left_semi", also=lambda: F.col(T) == F.col("_newest"))


def members_of(history: DataFrame, snapshot: DataFrame, spec: HistorySpec,
               snapshot_keys: Sequence[str] | None = None) -> DataFrame:
    """History rows whose person key appears in ``snapshot`` (tuple IN)."""
    sk = list(snapshot_keys or spec.keys)
    ks = snapshot.select(*[F.col(s).alias(k) for s, k in zip(sk, spec.keys)]).distinct()
    return keyed_join(history, ks, list(spec.keys), how="left_semi")


def person_history(history: DataFrame, key: Mapping[str, str]) -> DataFrame:
    """All versions of one person. On a stored history the filter is pushed
    to the scan; a history still to be advanced should have its snapshots
    filtered first, as aggregates let key filters through."""
    cond = reduce(lambda a, b: a & b, [F.col(k) == F.lit(v) for k, v in key.items()])
    return history.where(cond)


def stale_latest(history: DataFrame, snapshot: DataFrame, spec: HistorySpec) -> DataFrame:
    """Persons whose latest recorded respondent differs from the snapshot's
    (the effect of comparing against *all* versions: A -> B -> A is never
    re-appended)."""
    lt = latest(history, spec).select(*spec.keys, F.col(spec.resp).alias("LATEST_RESP_ID"),
                                      spec.created)
    cur = snapshot.select(*spec.keys, F.col(spec.resp).alias("SNAPSHOT_RESP_ID")).distinct()
    return keyed_join(lt.distinct(), cur, list(spec.keys),
                      also=lambda: F.col("LATEST_RESP_ID") != F.col("SNAPSHOT_RESP_ID"))


def confirmed_by(history: DataFrame, snapshot: DataFrame, spec: HistorySpec,
                 prefix: str = "SNAPSHOT_") -> DataFrame:
    """History rows whose (key, respondent) version appears in ``snapshot``,
    with the snapshot's payload columns (prefixed). The snapshot is reduced
    to one row per (key, respondent) first (smallest payload), so the join
    never multiplies a group: at most one output row per history row."""
    K = [*spec.keys, spec.resp]
    payload = spec.payload(snapshot)
    s = _min_row(snapshot, K, payload)
    s = s.select(*K, *[F.col(c).alias(prefix + c) for c in payload])
    return keyed_join(history, s, K).select(*history.columns, *[c for c in s.columns if c not in K])


def rows_of_respondents(history: DataFrame, snapshot: DataFrame, spec: HistorySpec) -> DataFrame:
    """History rows of the respondents that the snapshot names, whatever
    their key: a semi join on the distinct respondents, never pairwise."""
    named = snapshot.select(spec.resp).distinct()
    return keyed_join(history, named, [spec.resp], how="left_semi")
