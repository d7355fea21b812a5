"""Naive forms of ``dau_day`` and ``rau_day``, written from their definitions.

For comparison only; the library never plans these. Both join every member-day
with every day that it counts for: month-to-date by a range join of report days
and distinct counts, returning users by looking each of the seven days before a
login up in the log.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.config import KpiConfig
from daybook.sources.tables import Sources


def _first_logins(src: Sources, lo, hi) -> DataFrame:
    day = F.col("login_ts").cast("date")
    return src.login.where((F.col("login_day_seq") == 1) & (day >= F.lit(lo)) & (day < F.lit(hi))).withColumn("day", day)


def dau_day_literal(spark: SparkSession, src: Sources, cfg: KpiConfig) -> DataFrame:
    logins = _first_logins(src, cfg.month_lo, cfg.day_hi)
    report = logins.where(F.col("day") > F.lit(cfg.day_lo)).select(F.col("day").alias("division_date")).distinct()
    p = src.profile.select("member_id", F.col("os_type").alias("p_os"), F.col("country_code").alias("p_cc"))
    known = logins.join(p, "member_id").select(
        "member_id", "day", F.coalesce("p_os", "os_type").alias("os_type"), F.coalesce("p_cc", "country_code").alias("country_code")
    )
    counted = known.dropna(subset=["os_type", "country_code"]).join(
        report, (F.col("day") <= F.col("division_date")) & (F.col("day") >= F.trunc("division_date", "month"))
    )
    out = counted.groupBy("division_date", "os_type", "country_code").agg(
        F.count_distinct(F.when(F.col("day") == F.col("division_date"), F.col("member_id"))).alias("dau"),
        F.count_distinct("member_id").alias("sum_month_dau"),
    )
    return out.select(F.lit(cfg.game_code).alias("game_code"), "*")


def rau_day_literal(spark: SparkSession, src: Sources, cfg: KpiConfig) -> DataFrame:
    days = _first_logins(src, cfg.rau_scan_lo, cfg.day_hi).select("member_id", "day").distinct()
    gap = days.withColumn("back", F.explode(F.sequence(F.lit(1), F.lit(7)))).withColumn("before", F.expr("date_sub(day, back)"))
    seen = gap.join(days.select("member_id", F.col("day").alias("before")), ["member_id", "before"]).select("member_id", "day").distinct()
    fresh = days.where(F.col("day") > F.lit(cfg.day_lo)).join(seen, ["member_id", "day"], "left_anti")
    reg = (F.col("reg_utc") + F.expr(f"INTERVAL '{int(cfg.tz_offset_hours)}' HOUR")).cast("date")
    old = fresh.join(src.member.select("member_id", reg.alias("reg")), "member_id").where(F.datediff("day", "reg") > 7)
    named = old.join(src.profile, "member_id", "left").select(
        F.col("day").alias("division_date"), F.coalesce("os_type", F.lit(0)).cast("int").alias("os_type"), F.coalesce("country_code", F.lit("00")).alias("country_code")
    )
    out = named.groupBy("division_date", "os_type", "country_code").agg(F.count(F.lit(1)).alias("rau"))
    return out.select(F.lit(cfg.game_code).alias("game_code"), "*")
