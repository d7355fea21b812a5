"""Weekly KPI metrics (W1-W6) as lazy DataFrame -> DataFrame functions.

Weeks start on Sunday. Report weeks are ``cfg.week_lo < w < cfg.week_hi``:
strictly after the bookmark's week and strictly before the current,
unfinished week.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.config import KpiConfig
from daybook.functions.calendar import local_date, scan_days, week_range, week_start
from daybook.operators.activity import SEG, pick_first, row_weight, with_game
from daybook.plans.daily import _defaulted_seg, _sales
from daybook.sources.tables import Sources


def _week_scan(cfg: KpiConfig, df: DataFrame, ts: str) -> DataFrame:
    return scan_days(df, ts, cfg.week_lo + timedelta(days=7), cfg.week_hi)


def _new_members_week(cfg: KpiConfig, src: Sources) -> DataFrame:
    tz = cfg.tz_offset_hours
    return src.member.filter(week_range("reg_utc", cfg.week_lo, cfg.week_hi, tz)).select(
        "member_id", local_date("reg_utc", tz).alias("reg_date"), "member_name"
    )


# W1 nru_week: as nru_day by week, but profile LEFT join (defaults 0 / '00')
def nru_week(cfg: KpiConfig, src: Sources) -> DataFrame:
    m = _new_members_week(cfg, src).join(src.profile.select("member_id", *SEG), "member_id", "left")
    out = m.groupBy(week_start("reg_date").alias("division_week"), *_defaulted_seg()).agg(
        F.sum(F.when(F.col("member_name") != "", 1).otherwise(0)).cast("bigint").alias("nru1"),
        F.sum(F.when(F.col("member_name") == "", 1).otherwise(0)).cast("bigint").alias("nru2"),
    )
    return with_game(out, cfg.game_code)


# W2 wau_week: distinct members per week and login-log segment (all logins;
# a member seen on two segments counts in both; NULL seg is a group)
def wau_week(cfg: KpiConfig, src: Sources) -> DataFrame:
    rows = _week_scan(cfg, src.login, "login_ts").select(
        week_start(F.to_date("login_ts")).alias("division_week"), *SEG, "member_id"
    )
    out = (
        rows.distinct()
        .groupBy("division_week", *SEG)
        .agg(F.count(F.lit(1)).alias("wau"))
    )
    return with_game(out, cfg.game_code)


# W3 pu_week: payers per week, each counted once on one billing-log segment.
# The reference keeps an arbitrary segment; this picks the smallest
# (os_type, country_code), NULLs first, so the result is deterministic.
def pu_week(cfg: KpiConfig, src: Sources) -> DataFrame:
    rows = _week_scan(cfg, src.billing, "log_ts").select(
        "member_id", week_start(F.to_date("log_ts")).alias("division_week"), *SEG
    )
    # The struct minimum sorts its input, so reduce by hash first. The always-true filter on the
    # count keeps that step: a plain distinct below a minimum is optimised away.
    segments = rows.groupBy("member_id", "division_week", *SEG).agg(F.count(F.lit(1)).alias("n")).where("n > 0")
    one = pick_first(segments, ["member_id", "division_week"], SEG)
    out = one.groupBy("division_week", *SEG).agg(F.count(F.lit(1)).alias("pu"))
    return with_game(out, cfg.game_code)


# W4 eru_week: tutorial-end *rows* logged on the member's local registration
# day, per week and log segment (no member dedupe)
def eru_week(cfg: KpiConfig, src: Sources) -> DataFrame:
    te = (
        _week_scan(cfg, src.tutorial_end, "log_ts")
        .groupBy("member_id", F.to_date("log_ts").alias("day"), *SEG)
        .agg(F.sum(row_weight(src.tutorial_end)).alias("n"))
    )
    mi = _new_members_week(cfg, src).select("member_id", F.col("reg_date").alias("day"))
    out = (
        te.join(mi, ["member_id", "day"], "inner")
        .groupBy(week_start("day").alias("division_week"), *SEG)
        .agg(F.sum("n").cast("bigint").alias("eru"))
    )
    return with_game(out, cfg.game_code)


# W5 rau_week: weekly roll-up of the stored rau_day
def rau_week(cfg: KpiConfig, rau_day: DataFrame) -> DataFrame:
    day = F.col("division_date")
    rd = rau_day.filter(
        (F.col("game_code") == cfg.game_code) & (day >= F.lit(cfg.week_lo + timedelta(days=7))) & (day < F.lit(cfg.week_hi))
    )
    out = rd.groupBy(week_start("division_date").alias("division_week"), *SEG).agg(F.sum("rau").cast("bigint").alias("rau"))
    return with_game(out, cfg.game_code)


# W6 sales_week: reference form. Its inner grouping omits the member, so
# user_count is 1 on every row; sales_count and real_cash_kr are exact.
def sales_week(cfg: KpiConfig, src: Sources) -> DataFrame:
    bill = _week_scan(cfg, src.billing, "log_ts")
    out = _sales(bill, week_start(F.to_date("log_ts")), per_member=False).withColumnRenamed("period", "division_week")
    return with_game(out, cfg.game_code)


# sales_week with user_count = distinct buyers (the daily definition)
def sales_week_members(cfg: KpiConfig, src: Sources) -> DataFrame:
    bill = _week_scan(cfg, src.billing, "log_ts")
    out = _sales(bill, week_start(F.to_date("log_ts")), per_member=True).withColumnRenamed("period", "division_week")
    return with_game(out, cfg.game_code)
