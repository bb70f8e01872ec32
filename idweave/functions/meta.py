"""Run metadata stamped on history rows."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def meta_json(meta: Mapping[str, object] | None) -> str:
    """Stable JSON text (sorted keys, compact) for a metadata dict."""
    return json.dumps(dict(meta or {}), sort_keys=True, separators=(",", ":"))


def meta_literal(meta: Mapping[str, object] | None) -> Column:
    """A string literal column; readable with ``get_json_object``."""
    return F.lit(meta_json(meta)).cast("string")
