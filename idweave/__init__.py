"""idweave: person identity crosswalks on Spark.

Every operator is a pure ``DataFrame -> DataFrame`` function built from
Spark's own joins, aggregates, windows, set operations and column
expressions (no Python UDFs), so Catalyst can prune, push down and
code-generate the whole plan.

Sub-packages
------------
functions   column expressions (ids, text, demographics, geo, metadata)
operators   relational operators (columns, lookups, history, linking, audit,
            normalisation)
sources     readers, writers, versioned snapshots, test fixtures
plans       the registered queries and their SQL oracles
streaming   micro-batch driver that advances the history as snapshots arrive
"""

from idweave.session import get_session, materialise

__all__ = ["get_session", "materialise"]
