"""Shape a result for cross-engine comparison.

Two engines agree on scalars but not on how arrays or processing-time
columns come back, so a checked query (a) drops processing-time columns and
(b) renders arrays as '|'-joined text, in the order the array holds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SEP = "|"
PROCESSING_TIME_COLUMNS = ("alert_ts",)


def checkable(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if f.name in PROCESSING_TIME_COLUMNS:
            continue
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.ArrayType):
            c = F.array_join(c.cast("array<string>"), SEP)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def sql_text(expr: str) -> str:
    """DuckDB counterpart of the array rendering above."""
    return f"array_to_string({expr}, '{SEP}')"
