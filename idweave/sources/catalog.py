"""Catalog side: managed tables and the views readers use.

The reference publishes a "latest" view and one "members of snapshot N"
view per matching run over its history table. ``publish_views`` makes them
as temporary views over DataFrames built by the operators,
``publish_stored_views`` as persistent views in SQL. Both join on one struct
of the key, which lets AQE split a hot key (see ``operators.joins``); the
tuple ``IN`` of the reference leaves all of its rows in one task.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from idweave.operators.history import HistorySpec, latest, members_of


def save_table(df: DataFrame, name: str, mode: str = "overwrite", path: str | None = None,
               fmt: str = "parquet") -> str:
    """Managed table (no ``path``) or external table at ``path``."""
    w = df.write.mode(mode).format(fmt)
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)
    return name


def publish_views(spark: SparkSession, history: DataFrame, name: str,
                  snapshots: Mapping[str, DataFrame] | None = None,
                  spec: HistorySpec = HistorySpec()) -> list[str]:
    """Temp views ``<name>``, ``<name>_latest`` and ``<name>_<label>`` (members
    of each snapshot); returns the view names."""
    history.createOrReplaceTempView(name)
    latest(history, spec).createOrReplaceTempView(f"{name}_latest")
    made = [name, f"{name}_latest"]
    for label, snap in (snapshots or {}).items():
        members_of(history, snap, spec).createOrReplaceTempView(f"{name}_{label}")
        made.append(f"{name}_{label}")
    return made


def publish_stored_views(spark: SparkSession, table: str, name: str,
                         snapshots: Mapping[str, str] | None = None,
                         spec: HistorySpec = HistorySpec()) -> list[str]:
    """Persistent views over a stored history table, for other sessions:
    ``<name>_latest`` (rows with the newest version of their person) and
    ``<name>_<label>`` (history of the persons in each stored snapshot table).
    They hold no rows and follow the table."""
    keys = ", ".join(f"`{k}`" for k in spec.keys)
    whole = " AND ".join(f"`{k}` IS NOT NULL" for k in spec.keys)
    key = lambda of: "struct(" + ", ".join(f"{of}.`{k}` AS k{i}" for i, k in enumerate(spec.keys)) + ")"
    rows = f"SELECT h.* FROM (SELECT * FROM {table} WHERE {whole}) h LEFT SEMI JOIN"
    made = {f"{name}_latest": f"{rows} (SELECT {key('t')} AS k, max(`{spec.created}`) AS newest FROM {table} t "
                              f"WHERE {whole} GROUP BY {keys}) m ON {key('h')} = m.k AND h.`{spec.created}` = m.newest"}
    for label, stored in (snapshots or {}).items():
        made[f"{name}_{label}"] = (f"{rows} (SELECT DISTINCT {key('t')} AS k FROM {stored} t WHERE {whole}) m "
                                   f"ON {key('h')} = m.k")
    for view, query in made.items():
        spark.sql(f"CREATE OR REPLACE VIEW {view} AS {query}")
    return list(made)
