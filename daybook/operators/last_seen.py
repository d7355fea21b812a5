"""Last-seen state of returning members: per member the newest day of a first login.

A member returns on a day if no earlier day of theirs lies within the gap. All
that earlier runs have to hand down for that is the newest day of each member up
to the day before the first report day. States are merged by ``max``; a member
last seen longer ago than the gap gives the same result as one never seen, so a
state may start from a look-back of the gap alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def last_seen(first_days: DataFrame, state: DataFrame | None = None) -> DataFrame:
    """``member_id, last_day`` from (member_id, day) rows and an earlier state (an aggregate that combines map-side)."""
    rows = first_days.select("member_id", F.col("day").alias("last_day"))
    if state is not None:
        rows = state.select("member_id", "last_day").unionByName(rows)
    return rows.groupBy("member_id").agg(F.max("last_day").alias("last_day"))


def returning_after(first_days: DataFrame, state: DataFrame, gap_days: int = 7) -> DataFrame:
    """Of (member_id, day) rows after the state's days those with no earlier day of the member within ``gap_days``."""
    before = Window.partitionBy("member_id").orderBy("day")
    joined = first_days.join(state.select("member_id", "last_day"), "member_id", "left")
    seen = joined.withColumn("seen", F.coalesce(F.lag("day").over(before), F.col("last_day")))
    return seen.filter(F.col("seen").isNull() | (F.datediff("day", "seen") > gap_days)).select("member_id", "day")
