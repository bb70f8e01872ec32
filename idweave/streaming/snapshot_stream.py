"""Advance the person history as match snapshots arrive.

The reference loads an ordered list of snapshot files and then runs the
incremental job by hand for each. The Spark-native form is a file stream
over the landing folder with ``foreachBatch``: each micro-batch holds the
rows of newly arrived snapshot files; every snapshot in it (identified by
a version column, or the whole batch) is applied in order with
``advance_delta`` and appended to the history store as one write, under the
snapshot's own number. ``foreachBatch`` may run a batch again after a
failure; a snapshot whose version is already stored is then skipped, so
each is applied once. ``availableNow`` turns the stream into a batch run over
whatever has arrived.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from idweave.operators.history import HistorySpec, advance_delta, initial_history
from idweave.sources.history_store import HistoryStore


def advance_batch(batch: DataFrame, store: HistoryStore, spec: HistorySpec, quarter: str,
                  created, meta: Mapping | None = None, version: int | None = None) -> int:
    """Apply one snapshot to the store: initial load when the store is
    empty, else the delta against the whole stored history. A ``version``
    that is already stored is left as it is."""
    if version is not None and store.exists() and store.has_version(version):
        return version
    if not store.exists():
        return store.append(initial_history(batch, spec, quarter, created, meta), version)
    delta = advance_delta(store.read(), batch, spec, quarter, created, meta,
                          partitions=store.buckets if store.bucketed else None)
    return store.append(delta, version)


def advance_from_stream(spark: SparkSession, landing: str, schema: StructType, store_root: str,
                        checkpoint: str, spec: HistorySpec = HistorySpec(),
                        version_col: str | None = "v", quarter_of=None, fmt: str = "parquet",
                        available_now: bool = True, table: str | None = None,
                        buckets: int | None = None):
    """Start the stream; returns the ``StreamingQuery``.

    ``quarter_of(version) -> str`` names the quarter stamped on rows of a
    snapshot (default ``Q<version>``); ``created`` is the version number."""
    store = HistoryStore(spark, store_root, table=table, keys=spec.keys, buckets=buckets)
    quarter_of = quarter_of or (lambda v: f"Q{v}")

    def apply(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            if version_col and version_col in batch.columns:
                # the few version numbers present in this batch (not the rows)
                versions = sorted(r[0] for r in batch.select(version_col).distinct().collect())
                for v in versions:
                    snap = batch.where(F.col(version_col) == v).drop(version_col)
                    advance_batch(snap, store, spec, quarter_of(v), int(v), {"snapshot": int(v)},
                                  version=int(v))
            else:
                # the batch number is the version: a batch run again has the same
                advance_batch(batch, store, spec, quarter_of(batch_id), batch_id,
                              {"snapshot": batch_id}, version=batch_id)
        finally:
            batch.unpersist()

    reader = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    stream = reader.load(landing)
    writer = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
