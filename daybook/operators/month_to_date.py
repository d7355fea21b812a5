"""Daily and month-to-date distinct members per segment.

The reference joins a (report day x segment) spine to member activity on
"same month and activity day <= report day" and counts members per cell. That
range join multiplies every member-day by the days left in its month. Here:

1. *Month masks*: per (month, logged segment, member) the active days as the
   bits of one integer, an aggregate that combines map-side, so a member with
   any share of the log reaches the shuffle as one row a month and segment.
   Masks can be stored and merged with those of new or late days by ``bit_or``.
   A log of one row a member and day may enter as single bits;
2. the masks meet the profile, which gives the segment to report; masks that
   don't count (no profile, or a NULL segment) stay in, marked, since their days
   are report days all the same. So one scan of the log gives both;
3. each mask's set bits become rows, summed per (month, segment, day): members
   active that day and members whose first day of the month it is (partial
   aggregation before the shuffle). What is left has at most 31 rows a month
   and segment, whatever the number of members;
4. one shuffle by month serves both windows over these rows: the days on which
   any row of the month, counted or not, is active (the report days), and the
   running sum of new members per segment, which holds until the segment's next
   active day.

A month's masks cover all its days before the report-day filter, so a report
starting mid-month still counts members first seen earlier in the month.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEG = ["os_type", "country_code"]
LOG_SEG = ["l_os_type", "l_country_code"]


def month_bits(days: DataFrame, day: Column, seg: list[str]) -> DataFrame:
    """``member_id, month, *seg, days``: a row a row, with the bit of its day of the month (bit k for day k + 1)."""
    named = days.select("member_id", day.alias("_day"), *seg)
    return named.select("member_id", F.trunc("_day", "month").alias("month"), *seg, F.expr("shiftleft(1, dayofmonth(_day) - 1)").alias("days"))


def month_masks(days: DataFrame, day: Column, seg: list[str]) -> DataFrame:
    """The bits of ``month_bits`` put together: a row a member, month and segment."""
    return month_bits(days, day, seg).groupBy("member_id", "month", *seg).agg(F.bit_or("days").alias("days"))


def merge_masks(old: DataFrame, new: DataFrame, anew: int = 0) -> DataFrame:
    """Masks of both by ``bit_or``: ``new`` may hold new days, and late rows of old ones.

    ``anew`` has the bits of days that ``new`` holds whole: what ``old`` says of them is dropped.
    """
    keys = [c for c in old.columns if c != "days"]
    old = old.withColumn("days", F.col("days").bitwiseAND(F.lit(~anew & 0x7FFFFFFF))).filter("days <> 0") if anew else old
    return old.unionByName(new.select(*old.columns)).groupBy(*keys).agg(F.bit_or("days").alias("days"))


def month_to_date_masks(
    masks: DataFrame,
    report_lo: date | None,
    report_hi: date,
    daily_name: str,
    mtd_name: str,
    day_name: str = "division_date",
    one_per_member: bool = False,
    report_days: DataFrame | None = None,
) -> DataFrame:
    """Per report day and segment: members active that day and month-to-date.

    ``masks`` has columns (month, os_type, country_code, counted, member_id, days)
    covering the month window up to ``report_hi`` (exclusive); segments of
    counted rows must be non-null. ``one_per_member`` says that no member has two
    rows of one month and segment. Report days are those after ``report_lo`` on
    which a mask, counted or not, has its bit, or those given by
    ``report_days`` (one column ``day``, safe to broadcast). Rows exist where the
    month-to-date count is positive; the daily count may be zero.
    """
    keys = ["month", *SEG, "counted"]
    if not one_per_member:
        masks = masks.groupBy(*keys, "member_id").agg(F.bit_or("days").alias("days"))
    bits = range(31)
    set_bits = F.filter(F.sequence(F.lit(0), F.lit(30)), lambda b: F.col("days").bitwiseAND(F.call_function("shiftleft", F.lit(1), b)) != 0)
    per_day = (
        masks.select(*keys, F.posexplode(set_bits).alias("nth", "bit"))
        .groupBy(*keys, "bit")
        .agg(F.count(F.lit(1)).alias("daily"), F.sum((F.col("nth") == 0).cast("int")).alias("new_members"))
    )
    per_seg = Window.partitionBy(*keys).orderBy("bit")
    days = F.expr("sequence(bit, until)")
    if report_days is None:
        reported = F.expr("(anyone >> bit) & 1 = 1") & (F.col("day") > F.lit(report_lo))
    else:
        reported = F.lit(True)
    spans = (
        per_day.withColumn("anyone", F.bit_or(F.expr("shiftleft(1, bit)")).over(Window.partitionBy("month")))
        .withColumn("mtd", F.sum("new_members").over(per_seg.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("until", F.coalesce(F.lead("bit").over(per_seg) - 1, F.lit(30)))
        .filter("counted")
        .select("month", *SEG, "anyone", "mtd", "daily", F.col("bit").alias("active"), F.explode(days).alias("bit"))
        .withColumn("day", F.date_add("month", F.col("bit")))
        .filter((F.col("day") <= F.last_day("month")) & (F.col("day") < F.lit(report_hi)) & reported)
    )
    if report_days is not None:
        spans = spans.join(report_days, "day")
    return spans.select(
        F.col("day").alias(day_name),
        *SEG,
        F.when(F.col("bit") == F.col("active"), F.col("daily")).otherwise(F.lit(0)).cast("bigint").alias(daily_name),
        F.col("mtd").cast("bigint").alias(mtd_name),
    )


def month_to_date_distinct(
    active: DataFrame,
    report_days: DataFrame,
    report_hi: date,
    daily_name: str,
    mtd_name: str,
    day_name: str = "division_date",
) -> DataFrame:
    """``month_to_date_masks`` of plain activity.

    ``active`` has columns (day, os_type, country_code, member_id) covering the
    month window up to ``report_hi`` (exclusive); segments must be non-null.
    ``report_days`` has one column ``day``: the days to report (already
    restricted to the report window and safe to broadcast).
    """
    masks = month_masks(active, F.col("day"), SEG).withColumn("counted", F.lit(True))
    return month_to_date_masks(masks, None, report_hi, daily_name, mtd_name, day_name, one_per_member=True, report_days=report_days)
