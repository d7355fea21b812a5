"""Reductions of the logs to member grain, and small column helpers.

Every log is reduced to one row per (member, day[, segment]) with a partial
aggregate *before* it meets a member-keyed join or window. A member holding a
third of all log rows then contributes at most one row per day to any
shuffle after the map side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEG = ["os_type", "country_code"]


# Raw log rows that a row of a reduced log stands for. Only the runner's
# reductions carry it; sources are projected to their schemas when read.
LOG_ROWS = "_daybook_log_rows"


def row_weight(df: DataFrame) -> Column:
    """Raw log rows a row stands for: ``LOG_ROWS`` on reduced logs, else 1."""
    return F.col(LOG_ROWS) if LOG_ROWS in df.columns else F.lit(1)


def with_game(df: DataFrame, game_code: str) -> DataFrame:
    """Insert ``game_code`` as the first column."""
    return df.select(F.lit(game_code).alias("game_code"), *df.columns)


def seg_not_null() -> Column:
    return F.col("os_type").isNotNull() & F.col("country_code").isNotNull()


def profile_segment(profile: DataFrame, prefix: str = "p_") -> DataFrame:
    return profile.select(
        "member_id",
        F.col("os_type").alias(f"{prefix}os_type"),
        F.col("country_code").alias(f"{prefix}country_code"),
    )


def returning_days(first_days: DataFrame, gap_days: int = 7) -> DataFrame:
    """Keep (member_id, day) rows with no earlier day of the member within ``gap_days``.

    ``first_days`` holds (member_id, day) rows; a repeated (member, day) row
    has a gap of 0 to its twin, so at most one copy is kept. "No activity in
    [day - gap, day - 1]" is "previous active day is missing or more than
    ``gap`` days back", so one ``lag`` per member replaces the anti join. The
    window partitions by member over distinct days only, so a member's
    partition is bounded by the number of days scanned.
    """
    w = Window.partitionBy("member_id").orderBy("day")
    prev = F.lag("day").over(w)
    return (
        first_days.withColumn("prev_day", prev)
        .filter(F.col("prev_day").isNull() | (F.datediff(F.col("day"), F.col("prev_day")) > gap_days))
        .drop("prev_day")
    )


def pick_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per ``keys``: the smallest ``order`` tuple (NULLs first).

    A ``min`` over a struct is an ordinary aggregate, so it combines map-side
    (unlike ``row_number`` over a window, which sorts each group in one task).
    """
    m = F.min(F.struct(*[F.col(c) for c in order])).alias("_pick")
    return df.groupBy(*keys).agg(m).select(*keys, *[F.col(f"_pick.{c}").alias(c) for c in order])
