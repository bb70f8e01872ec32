"""Session settings and lineage cutting.

The settings below are the ones the operators are designed around:

* AQE on, with partition coalescing and skew-join splitting, so a hot key
  (blank or placeholder ids can hold a large share of a vendor file) is
  split across tasks at run time instead of landing in one task.
* ANSI mode stays on (Spark 4 default); operators use ``try_cast`` where
  the input is free text.
* No UI server.

``materialise`` cuts lineage by writing the DataFrame as Parquet into the
shared folder named by ``spark.checkpoint.dir`` and reading it back (one
pass, unlike ``checkpoint()`` which computes an unpersisted plan twice, and
the re-read gets column pruning and filter pushdown). It never uses a
local checkpoint or a machine-local folder on a cluster.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SESSION_DEFAULTS: dict[str, str] = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # Small lookups are broadcast by their size (this threshold, or AQE's
    # runtime sizes); nothing is broadcast by hint.
    "spark.sql.autoBroadcastJoinThreshold": str(10 * 1024 * 1024),
    # remove checkpoint files once their DataFrame is garbage collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}

# Runtime SQL settings the operators rely on; ``configure`` applies them to
# a session built elsewhere. A join on (person key, respondent) may reuse a
# partitioning on the person key alone (the history is bucketed by person
# key), instead of re-shuffling the history on the longer key.
RUNTIME_SQL_CONF: dict[str, str] = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    for k, v in RUNTIME_SQL_CONF.items():
        spark.conf.set(k, v)
    return spark


def get_session(
    app: str = "idweave",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the settings above."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    configure(spark)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``. Where it is unset, a fresh
    folder in local mode (tests); on a cluster an error, as a folder of one
    machine is not seen by the others."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="idweave-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/idweave-tables/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and return a scan of
    it: survives executor loss, cuts the lineage."""
    spark = df.sparkSession
    path = scratch_path(spark, name or "df")
    df.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)
