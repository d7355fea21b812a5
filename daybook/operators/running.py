"""Running totals per segment (replaces the reference's session-variable loop)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running_sum(df: DataFrame, partition: list[str], order: str, value: str, out: str, offset: Column | None = None) -> DataFrame:
    """``out = offset + sum(value)`` over rows ``<= order`` within ``partition``.

    Run it on data already aggregated to (day, segment): a window partition
    then holds one row per calendar day, whatever the member volume.
    """
    w = Window.partitionBy(*partition).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = F.sum(F.col(value)).over(w)
    if offset is not None:
        total = total + offset
    return df.withColumn(out, total)
