"""Activity code → text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strider.schemas import ACTIVITY_LABELS, UNKNOWN_ACTIVITY


def activity_text(code: Column | str, labels: dict[int, str] | None = None,
                  unknown: str = UNKNOWN_ACTIVITY) -> Column:
    """Text of an activity code; codes missing from ``labels`` (and null) are ``unknown``."""
    code = F.col(code) if isinstance(code, str) else code
    table = ACTIVITY_LABELS if labels is None else labels
    expr = None
    for value, text in table.items():
        expr = F.when(code == value, text) if expr is None else expr.when(code == value, text)
    return F.lit(unknown) if expr is None else expr.otherwise(unknown)
