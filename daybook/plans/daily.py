"""Daily KPI metrics (D1-D8) as lazy DataFrame -> DataFrame functions.

Each function takes the run config and the five sources and returns the
summary rows the reference writes to its ``*_day`` table, ``game_code`` first.
Report days are local dates ``cfg.day_lo < d < cfg.day_hi``. ``seg`` below is
(os_type, country_code); the NULL-segment policy of each metric follows the
reference and is stated per function.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.config import KpiConfig
from daybook.functions.calendar import day_range, day_range_incl, local_date, scan_days
from daybook.operators.activity import SEG, profile_segment, returning_days, row_weight, seg_not_null, with_game
from daybook.operators.last_seen import returning_after
from daybook.operators.month_to_date import LOG_SEG, month_bits, month_masks, month_to_date_masks
from daybook.operators.running import running_sum
from daybook.operators.spine import bounded_days, expand_days
from daybook.sources.tables import Sources

MONEY_SUM = T.DecimalType(38, 2)
RETENTION_DAYS = 30
RAU_GAP = 7  # days without a login before a returning day


def _new_members(cfg: KpiConfig, src: Sources, lo_exclusive=None, hi_exclusive=None) -> DataFrame:
    """Members whose local registration day lies in the report window."""
    lo = cfg.day_lo if lo_exclusive is None else lo_exclusive
    hi = cfg.day_hi if hi_exclusive is None else hi_exclusive
    tz = cfg.tz_offset_hours
    return src.member.filter(day_range("reg_utc", lo, hi, tz)).select(
        "member_id", local_date("reg_utc", tz).alias("reg_date"), "member_name"
    )


def _defaulted_seg(os_col="os_type", cc_col="country_code"):
    return [
        F.coalesce(F.col(os_col), F.lit(0)).cast("int").alias("os_type"),
        F.coalesce(F.col(cc_col), F.lit("00")).alias("country_code"),
    ]


# --------------------------------------------------------------------------
# D1 nru_day: new members per day; profile INNER join; NULL seg -> 0 / '00'
# --------------------------------------------------------------------------
def nru_day(cfg: KpiConfig, src: Sources) -> DataFrame:
    m = _new_members(cfg, src).join(src.profile.select("member_id", *SEG), "member_id", "inner")
    out = m.groupBy(F.col("reg_date").alias("division_date"), *_defaulted_seg()).agg(
        F.sum(F.when(F.col("member_name") != "", 1).otherwise(0)).cast("bigint").alias("nru1"),
        F.sum(F.when(F.col("member_name") == "", 1).otherwise(0)).cast("bigint").alias("nru2"),
    )
    return with_game(out, cfg.game_code)


def nru_backup_rows(cfg: KpiConfig, src: Sources) -> DataFrame:
    """Member-level rows behind ``nru_day`` (the reference's CSV backup)."""
    m = _new_members(cfg, src).join(src.profile.select("member_id", *SEG), "member_id", "inner")
    return m.select(F.col("reg_date").alias("division_date"), "member_id", *_defaulted_seg(), "member_name")


# --------------------------------------------------------------------------
# D2 dau_day: daily + month-to-date active members
# seg = COALESCE(profile, login log) with profile INNER; still-NULL seg vanishes
# --------------------------------------------------------------------------
def _first_logins(cfg: KpiConfig, src: Sources, lo: date | None) -> DataFrame:
    first = scan_days(src.login.filter(F.col("login_day_seq") == 1), "login_ts", cfg.month_lo if lo is None else lo, cfg.day_hi)
    return first.select("member_id", "login_ts", F.col("os_type").alias("l_os_type"), F.col("country_code").alias("l_country_code"))


def login_masks(cfg: KpiConfig, src: Sources, lo: date | None = None) -> DataFrame:
    """Month masks of members' first logins from ``lo`` (default: the month window's first day) on, by logged segment."""
    return month_masks(_first_logins(cfg, src, lo), F.to_date("login_ts"), LOG_SEG)


def billing_masks(cfg: KpiConfig, src: Sources, lo: date | None = None) -> DataFrame:
    """Month masks of members' purchases from ``lo`` (default: the month window's first day) on."""
    bill = scan_days(src.billing, "log_ts", cfg.month_lo if lo is None else lo, cfg.day_hi)
    return month_masks(bill, F.to_date("log_ts"), [])


def _counted(masks: DataFrame, src: Sources, seg: list) -> DataFrame:
    """Masks with the segment to report; those without a profile or with a NULL segment don't count."""
    # without a profile there is no row to join: its segment doesn't count, whatever was logged
    profile = profile_segment(src.profile).withColumn("has_profile", F.lit(True))
    joined = masks.join(profile, "member_id", "left").select("month", *seg, "member_id", "days", "has_profile")
    counted = F.coalesce(F.col("has_profile"), F.lit(False)) & seg_not_null()
    named = joined.withColumn("counted", counted)
    # one segment for all that don't count
    return named.select("month", *(F.when(F.col("counted"), F.col(c)).alias(c) for c in SEG), "counted", "member_id", "days")


def dau_day(cfg: KpiConfig, src: Sources, masks: DataFrame | None = None) -> DataFrame:
    """``masks``, where given, are the month window's ``login_masks``, kept from earlier runs; no log is read then."""
    if masks is None and src.masks:
        masks = src.masks["login"]
    if masks is None:  # a member's first login of a day is one row already: the join may take them as they are
        masks = month_bits(_first_logins(cfg, src, None), F.to_date("login_ts"), LOG_SEG)
    seg = [F.coalesce(f"p_{c}", f"l_{c}").alias(c) for c in SEG]
    out = month_to_date_masks(_counted(masks, src, seg), cfg.day_lo, cfg.day_hi, "dau", "sum_month_dau")
    return with_game(out, cfg.game_code)


# --------------------------------------------------------------------------
# D3 pu_day: daily + month-to-date payers; seg from profile only (INNER);
# NULL seg vanishes
# --------------------------------------------------------------------------
def pu_day(cfg: KpiConfig, src: Sources, masks: DataFrame | None = None) -> DataFrame:
    """``masks``, where given, are the month window's ``billing_masks``, kept from earlier runs; no log is read then."""
    if masks is None:
        masks = src.masks["billing"] if src.masks else billing_masks(cfg, src)
    seg = [F.col(f"p_{c}").alias(c) for c in SEG]
    out = month_to_date_masks(_counted(masks, src, seg), cfg.day_lo, cfg.day_hi, "pu", "sum_month_pu", one_per_member=True)
    return with_game(out, cfg.game_code)


# --------------------------------------------------------------------------
# D4 eru_day: members finishing the tutorial on their local registration day;
# seg from profile (INNER); NULL seg is an ordinary group
# --------------------------------------------------------------------------
def eru_day(cfg: KpiConfig, src: Sources) -> DataFrame:
    lo, hi = cfg.day_lo, cfg.day_hi
    te = (
        scan_days(src.tutorial_end, "log_ts", lo + timedelta(days=1), hi)
        .select("member_id", F.to_date("log_ts").alias("division_date"))
        .distinct()
    )
    mi = _new_members(cfg, src).join(src.profile.select("member_id", *SEG), "member_id", "inner")
    j = te.join(
        mi.select("member_id", F.col("reg_date").alias("division_date"), *SEG),
        ["member_id", "division_date"],
        "inner",
    )
    out = (
        j.select("division_date", "member_id", *SEG)
        .distinct()
        .groupBy("division_date", *SEG)
        .agg(F.count(F.lit(1)).alias("eru"))
    )
    return with_game(out, cfg.game_code)


# --------------------------------------------------------------------------
# D5 rau_day: returning members (first login of the day, registered before
# D-7, no first login in [D-7, D-1]); profile LEFT with defaults 0 / '00'
# --------------------------------------------------------------------------
def first_login_days(cfg: KpiConfig, src: Sources, lo: date, hi: date) -> DataFrame:
    """(member_id, day) of first logins of local days ``[lo, hi)``: one row a member and day."""
    return scan_days(src.login.filter(F.col("login_day_seq") == 1), "login_ts", lo, hi).select("member_id", F.to_date("login_ts").alias("day"))


def rau_day(cfg: KpiConfig, src: Sources, state: DataFrame | None = None) -> DataFrame:
    """``state``, where given, is the members' ``last_seen`` of all days before ``cfg.rau_scan_lo``; no earlier log is read then."""
    lo, hi, tz = cfg.day_lo, cfg.day_hi, cfg.tz_offset_hours
    # a duplicate row could not qualify anyway (its gap to the previous row is 0), and the distinct below stays
    first_days = first_login_days(cfg, src, cfg.rau_scan_lo, hi)
    back = returning_days(first_days, gap_days=RAU_GAP) if state is None else returning_after(first_days, state, RAU_GAP)
    reg = src.member.select("member_id", local_date("reg_utc", tz).alias("reg_date"))
    back = back.filter(F.col("day") > F.lit(lo)).join(reg, "member_id", "inner").filter(F.col("reg_date") < F.date_sub(F.col("day"), RAU_GAP))
    out = (
        back.select(F.col("day").alias("division_date"), "member_id")
        .distinct()
        .join(src.profile.select("member_id", *SEG), "member_id", "left")
        .groupBy("division_date", *_defaulted_seg())
        .agg(F.count(F.lit(1)).alias("rau"))
    )
    return with_game(out, cfg.game_code)


def rau_day_first_run(cfg: KpiConfig, src: Sources) -> DataFrame:
    """The reference's first run: logins before the bookmark aren't looked at, so members seen just before it count as returning."""
    return rau_day(cfg.first_run(), src)


# --------------------------------------------------------------------------
# D6 sales_day: buyers, purchases and money per day, seg (from the billing
# log), market, product. NULL seg is an ordinary group.
# --------------------------------------------------------------------------
SALES_KEYS = ["os_type", "country_code", "market", "product_idx"]


def _sales(bill: DataFrame, period: F.Column, per_member: bool) -> DataFrame:
    rows = bill.select(
        period.alias("period"),
        "member_id",
        "os_type",
        "country_code",
        "market",
        F.col("product_id").alias("product_idx"),
        "amount",
        row_weight(bill).alias("n"),
    )
    inner_keys = ["period", *SALES_KEYS] + (["member_id"] if per_member else [])
    inner = rows.groupBy(*inner_keys).agg(
        F.sum("n").alias("sales_count"), F.sum("amount").alias("real_cash_kr")
    )
    return inner.groupBy("period", *SALES_KEYS).agg(
        F.count(F.lit(1)).alias("user_count"),
        F.sum("sales_count").cast("bigint").alias("sales_count"),
        F.sum("real_cash_kr").cast(MONEY_SUM).alias("real_cash_kr"),
    )


def sales_day(cfg: KpiConfig, src: Sources) -> DataFrame:
    lo, hi = cfg.day_lo, cfg.day_hi
    bill = scan_days(src.billing, "log_ts", lo + timedelta(days=1), hi)
    out = _sales(bill, F.to_date("log_ts"), per_member=True).withColumnRenamed("period", "division_date")
    return with_game(out, cfg.game_code)


# --------------------------------------------------------------------------
# D7 ru_day: sign-ups per day and running total per profile segment over a
# dense (sign-up day x profile segment) spine. NULL segments stay with zeros.
# --------------------------------------------------------------------------
def _ru_parts(cfg: KpiConfig, src: Sources, spine_lo_inclusive):
    """Dense (sign-up day x profile segment) grid from ``spine_lo_inclusive``,
    and the sign-up counts per (day, segment) of the report window."""
    hi, tz = cfg.day_hi, cfg.tz_offset_hours
    signup_days = (
        src.member.filter(day_range_incl("reg_utc", spine_lo_inclusive, hi, tz))
        .select(local_date("reg_utc", tz).alias("day"))
        .distinct()
    )
    segs = src.profile.select(*SEG).distinct()
    grid = expand_days(segs, spine_lo_inclusive, hi).join(bounded_days(signup_days), "day")
    counts = (
        _new_members(cfg, src)
        .join(src.profile.select("member_id", *SEG), "member_id", "inner")
        .groupBy(F.col("reg_date").alias("day"), *SEG)
        .agg(F.count(F.lit(1)).alias("cnt"))
    )
    return grid, counts


def ru_day(cfg: KpiConfig, src: Sources, prior: DataFrame | None = None) -> DataFrame:
    """Reference form. ``prior`` is the stored ``ru_day``; its row at the seed
    day ``start - before_days`` re-enters as that day's count (so the seed
    row is re-emitted with ``date_count`` = carried total, and a seed day
    without sign-ups loses the carry, as in the reference)."""
    lo = cfg.day_lo
    grid, counts = _ru_parts(cfg, src, lo)
    if prior is not None:
        seed = prior.filter(
            (F.col("game_code") == cfg.game_code) & (F.col("division_date") == F.lit(lo))
        ).select(F.col("division_date").alias("day"), *SEG, F.col("sum_date_count").alias("cnt"))
        counts = counts.unionByName(seed)
    cells = grid.join(counts, ["day", *SEG], "left").select(
        "day", *SEG, F.coalesce(F.col("cnt"), F.lit(0)).cast("bigint").alias("date_count")
    )
    out = running_sum(cells, SEG, "day", "date_count", "sum_date_count").select(
        F.col("day").alias("division_date"), *SEG, "date_count", F.col("sum_date_count").cast("bigint")
    )
    return with_game(out, cfg.game_code)


def ru_day_incremental(cfg: KpiConfig, src: Sources, prior: DataFrame) -> DataFrame:
    """Corrected incremental form: days after the seed day only, each segment
    carrying its latest stored total at or before the seed day (so a seed day
    without sign-ups keeps the carry)."""
    lo = cfg.day_lo
    grid, counts = _ru_parts(cfg, src, lo + timedelta(days=1))
    seed = (
        prior.filter(
            (F.col("game_code") == cfg.game_code) & (F.col("division_date") <= F.lit(lo)) & seg_not_null()
        )
        .groupBy(*SEG)
        .agg(F.max_by("sum_date_count", "division_date").alias("seed"))
    )
    cells = (
        grid.join(counts, ["day", *SEG], "left")
        .join(seed, SEG, "left")
        .select(
            "day",
            *SEG,
            F.coalesce(F.col("cnt"), F.lit(0)).cast("bigint").alias("date_count"),
            F.coalesce(F.col("seed"), F.lit(0)).cast("bigint").alias("seed"),
        )
    )
    out = running_sum(cells, SEG, "day", "date_count", "sum_date_count", offset=F.col("seed")).select(
        F.col("day").alias("division_date"), *SEG, "date_count", F.col("sum_date_count").cast("bigint")
    )
    return with_game(out, cfg.game_code)


# --------------------------------------------------------------------------
# D8 retention_day: cohort (local reg day, profile seg; INNER) size, members
# logging in on day k = 1..30 and cohort money on day k = 0..30. A cohort
# with a NULL segment keeps user_count; its other measures are NULL.
# --------------------------------------------------------------------------
def _cohort_days(cohort: DataFrame, src: Sources, lo: date, hi: date) -> DataFrame:
    """``cohort`` with ``day, login, amount``: a row for each of a member's days with logins or purchases in ``[lo, hi)``.

    A member without any keeps one row of NULLs. A member has at most a row a
    day and log, so what is gathered of one is bounded by the calendar.
    """
    keys = ["member_id", "day"]
    logins = scan_days(src.login, "login_ts", lo, hi).select("member_id", F.to_date("login_ts").alias("day"))
    sales = scan_days(src.billing, "log_ts", lo, hi).select("member_id", F.to_date("log_ts").alias("day"), F.col("amount").cast(MONEY_SUM).alias("amount"))
    total = F.sum("amount").cast(MONEY_SUM).alias("amount")
    nothing = F.lit(None).cast(MONEY_SUM).alias("amount")
    if not src.colocated:
        both = logins.select(*keys, F.lit(True).alias("login"), nothing).unionByName(sales.select(*keys, F.lit(False).alias("login"), "amount"))
        return cohort.join(both.groupBy(*keys).agg(F.max("login").alias("login"), total), "member_id", "left")
    # all sides are partitioned by member already; left joins of a list a member keep that, a union would not
    rows = cohort
    for name, days in (
        ("logins", logins.distinct().select(*keys, F.lit(True).alias("login"), nothing)),
        ("sales", sales.groupBy(*keys).agg(total).select(*keys, F.lit(False).alias("login"), "amount")),
    ):
        lists = days.groupBy("member_id").agg(F.collect_list(F.struct("day", "login", "amount")).alias(name))
        rows = rows.join(lists, "member_id", "left")
    none = F.array().cast("array<struct<day:date,login:boolean,amount:decimal(38,2)>>")
    both = F.concat(F.coalesce("logins", none), F.coalesce("sales", none))
    return rows.select(*cohort.columns, F.explode_outer(both).alias("_at")).select(*cohort.columns, "_at.*")


def retention_day(cfg: KpiConfig, src: Sources) -> DataFrame:
    """One cohort join: member-days of both logs meet the cohort once; per member logins are bits and money is by offset."""
    lo, hi = cfg.retention_day_lo, cfg.day_hi
    cohort = (
        _new_members(cfg, src, lo_exclusive=lo)
        .join(src.profile.select("member_id", *SEG), "member_id", "inner")
        .select("member_id", "reg_date", *SEG)
    )
    k = F.datediff("day", "reg_date")
    rows = _cohort_days(cohort, src, lo + timedelta(days=1), hi).select("member_id", "reg_date", *SEG, k.alias("k"), "login", "amount")
    # per member: logins as the bits 1..30 of one integer, money by offset
    offsets = range(RETENTION_DAYS + 1)
    seen = F.when(F.col("login") & F.col("k").between(1, RETENTION_DAYS), F.expr("shiftleft(1, k)"))
    per_member = rows.groupBy("member_id", "reg_date", *SEG).agg(
        F.coalesce(F.bit_or(seen), F.lit(0)).alias("mask"), *(F.sum(F.when(F.col("k") == i, F.col("amount"))).alias(f"s{i}") for i in offsets)
    )
    counts = [F.sum(F.expr(f"(mask >> {i}) & 1")).alias(f"user_{i}") for i in offsets if i]
    money = [F.sum(f"s{i}").alias(f"sales_{i}") for i in offsets]
    wide = per_member.groupBy("reg_date", *SEG).agg(F.count(F.lit(1)).alias("user_count"), *counts, *money)

    def measure(name: str, kind):
        return F.when(seg_not_null(), F.coalesce(F.col(name), F.lit(0))).cast(kind).alias(name)

    out = wide.select(
        F.col("reg_date").alias("division_date"),
        *SEG,
        "user_count",
        *(measure(f"user_{i}", "bigint") for i in offsets if i),
        *(measure(f"sales_{i}", MONEY_SUM) for i in offsets),
    )
    return with_game(out, cfg.game_code)
