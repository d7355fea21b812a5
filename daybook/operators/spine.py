"""Dense calendar spines without cross joins.

Several reference metrics report a dense grid (report day x segment) where a
cell exists even with a zero measure. The grid is built by exploding a
*bounded* date sequence on each segment row, so its size is exactly the output
size and no pairwise join is planned. Day lists that are broadcast are bounded
by the calendar length of the window, which the driver knows from the config
before any data is read.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.functions.calendar import date_sequence


def bounded_days(days: DataFrame) -> DataFrame:
    """Hint a broadcast for a distinct day list of a report window.

    It has a row of 4 bytes per calendar day at most, whatever the data volume.
    """
    return F.broadcast(days)


def expand_days(df: DataFrame, lo_inclusive: date, hi_exclusive: date, name: str = "day") -> DataFrame:
    """Repeat every row of ``df`` once per calendar day in ``[lo, hi)``."""
    return df.withColumn(name, F.explode(date_sequence(lo_inclusive, hi_exclusive)))
