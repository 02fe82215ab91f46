"""Broadcasts behind a check of size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes that a table may take in memory to be sent to all tasks, and what a row and a column take besides strings.
BROADCAST_BYTES = 32 << 20
ROW_BYTES, COLUMN_BYTES = 32, 16


def broadcast_if_small(df: DataFrame, most: int = BROADCAST_BYTES) -> DataFrame:
    """df, marked for a broadcast if its rows, strings included, take at most so many bytes; else left to a shuffle.

    df is computed once for the check, up to the number of rows that could fit.
    """
    fixed = ROW_BYTES + COLUMN_BYTES * len(df.columns)
    strings = [F.coalesce(F.octet_length(f"`{f.name}`"), F.lit(0)) for f in df.schema.fields if f.dataType.typeName() == "string"]
    each = sum(strings, F.lit(fixed)).cast("long")
    taken = df.limit(most // fixed + 1).agg(F.sum(each)).first()[0] or 0
    return F.broadcast(df) if taken <= most else df


def few_rows(df: DataFrame, row_bytes: int, most: int = BROADCAST_BYTES) -> bool:
    """Do tables with a row of row_bytes for each row of df fit a broadcast? Counts df no further than that."""
    return df.limit(most // row_bytes + 1).count() <= most // row_bytes
