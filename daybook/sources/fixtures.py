"""Fixture adapter: the five KPI sources derived from ``events`` + ``customer``.

The given test tables are a generic event stream; this adapter maps them onto
the game tables (FIXTURES.md section 3) as an ordinary Spark job, so every
metric's work grows with ``events``. The mapping deliberately creates the
cases the metrics must handle: members without a profile, NULL profile
segments, log segments that differ from the profile, repeat purchases.

Base: ``events`` joined to ``customer`` on ``user_id = c_custkey``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.sources.tables import MONEY, Sources

# Fixed values of the fixture mapping (FIXTURES.md section 3).
# Segment code os0 by market segment: AUTOMOBILE 1, BUILDING 2, FURNITURE 3,
# HOUSEHOLD 4, any other 5. Country code cc0: c_nationkey + 1, left-padded to
# two digits ('00' stays reserved for "unknown").
OS_BY_MKTSEGMENT = {"AUTOMOBILE": 1, "BUILDING": 2, "FURNITURE": 3, "HOUSEHOLD": 4}
OS_OTHER = 5
LOG_OS_OVERRIDE = 9  # log os_type where event_id % 7 = 0
NAMELESS_MOD = 10  # member_name = '' where member_id % 10 = 0
NO_PROFILE_MOD, NO_PROFILE_REM = 20, 19  # no profile row where id % 20 = 19
NULL_OS_MOD = 17  # profile os_type NULL where id % 17 = 0
MARKETS = 3  # market = product_id % 3


def _os0(seg: Column) -> Column:
    expr = None
    for name, code in OS_BY_MKTSEGMENT.items():
        expr = (F.when(seg == name, F.lit(code)) if expr is None else expr.when(seg == name, F.lit(code)))
    return expr.otherwise(F.lit(OS_OTHER)).cast("int")


def customer_segments(customer: DataFrame) -> DataFrame:
    """(member_id, c_name, os0, cc0) per customer."""
    return customer.select(
        F.col("c_custkey").alias("member_id"),
        "c_name",
        _os0(F.col("c_mktsegment")).alias("os0"),
        F.lpad((F.col("c_nationkey") + 1).cast("string"), 2, "0").alias("cc0"),
    )


def _events_of(events: DataFrame, kind: str, cust: DataFrame) -> DataFrame:
    e = events.filter(F.col("event_type") == kind).select(
        "event_id", "ts", F.col("user_id").alias("member_id"), "value", "props"
    )
    return e.join(cust, "member_id")


def _log_segment(df: DataFrame) -> list[Column]:
    return [
        F.when(F.col("event_id") % 7 == 0, F.lit(LOG_OS_OVERRIDE)).otherwise(F.col("os0")).cast("int").alias("os_type"),
        F.col("cc0").alias("country_code"),
    ]


def fixture_sources(spark: SparkSession, sf_dir: str, tz_offset_hours: int = 9) -> Sources:
    sf_dir = sf_dir.rstrip("/")
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    return sources_from_events(events, customer, tz_offset_hours)


def sources_from_events(events: DataFrame, customer: DataFrame, tz_offset_hours: int = 9) -> Sources:
    cust = customer_segments(customer)

    # member: first signup per user; stored in UTC, so shift back by the offset.
    first_signup = (
        events.filter(F.col("event_type") == "signup")
        .groupBy(F.col("user_id").alias("member_id"))
        .agg(F.min("ts").alias("first_ts"))
    )
    member = first_signup.join(cust, "member_id").select(
        "member_id",
        (F.col("first_ts") - F.expr(f"INTERVAL {int(tz_offset_hours)} HOURS")).alias("reg_utc"),
        F.when(F.col("member_id") % NAMELESS_MOD == 0, F.lit("")).otherwise(F.col("c_name")).alias("member_name"),
    )

    profile = cust.filter(F.col("member_id") % NO_PROFILE_MOD != NO_PROFILE_REM).select(
        "member_id",
        F.when(F.col("member_id") % NULL_OS_MOD == 0, F.lit(None)).otherwise(F.col("os0")).cast("int").alias("os_type"),
        F.col("cc0").alias("country_code"),
    )

    clicks = _events_of(events, "click", cust)
    # First login of each member-day, found with a partial aggregate (a hot
    # member collapses map-side) and marked back by the unique event_id.
    # Later logins of the day carry 2: the jobs only ever test for 1, and a
    # full row number would sort each member-day inside a single task.
    firsts = (
        clicks.groupBy("member_id", F.to_date("ts").alias("day"))
        .agg(F.min(F.struct("ts", "event_id")).alias("first"))
        .select(F.col("first.event_id").alias("event_id"), F.lit(1).alias("is_first"))
    )
    login = clicks.join(firsts, "event_id", "left").select(
        "member_id",
        F.col("ts").alias("login_ts"),
        *_log_segment(clicks),
        F.when(F.col("is_first") == 1, F.lit(1)).otherwise(F.lit(2)).cast("int").alias("login_day_seq"),
    )

    purchases = _events_of(events, "purchase", cust)
    k = F.get_json_object(F.col("props"), "$.k").cast("int")
    billing = purchases.select(
        "member_id",
        F.col("ts").alias("log_ts"),
        *_log_segment(purchases),
        (k % MARKETS).cast("int").alias("market"),
        k.alias("product_id"),
        F.col("value").cast(MONEY).alias("amount"),
    )

    views = _events_of(events, "view", cust)
    tutorial_end = views.select("member_id", F.col("ts").alias("log_ts"), *_log_segment(views))

    return Sources(member=member, profile=profile, login=login, billing=billing, tutorial_end=tutorial_end)


# Fixed values of the second fixture (orders + customer), which spans month and
# year boundaries: every order is a login at its order date; finished orders
# (status 'F') are purchases of product = leading digit of the priority, market
# = product % 3, amount = total price; '1-URGENT' orders are tutorial ends. The
# log os_type is 9 where o_orderkey % 7 = 0. A member registers at the first
# order (stored in UTC, so shifted back by the offset).
PURCHASE_STATUS = "F"
TUTORIAL_PRIORITY = "1-URGENT"


def fixture_sources_orders(spark: SparkSession, sf_dir: str, tz_offset_hours: int = 9) -> Sources:
    sf_dir = sf_dir.rstrip("/")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    return sources_from_orders(orders, customer, tz_offset_hours)


def sources_from_orders(orders: DataFrame, customer: DataFrame, tz_offset_hours: int = 9) -> Sources:
    cust = customer_segments(customer)
    o = orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("member_id"),
        F.col("o_orderdate").alias("ts"),
        "o_orderstatus",
        "o_orderpriority",
        "o_totalprice",
    ).join(cust, "member_id")
    seg = [
        F.when(F.col("order_id") % 7 == 0, F.lit(LOG_OS_OVERRIDE)).otherwise(F.col("os0")).cast("int").alias("os_type"),
        F.col("cc0").alias("country_code"),
    ]

    member = (
        o.groupBy("member_id")
        .agg(F.min("ts").alias("first_ts"), F.first("c_name").alias("c_name"))
        .select(
            "member_id",
            (F.col("first_ts") - F.expr(f"INTERVAL {int(tz_offset_hours)} HOURS")).alias("reg_utc"),
            F.when(F.col("member_id") % NAMELESS_MOD == 0, F.lit("")).otherwise(F.col("c_name")).alias("member_name"),
        )
    )
    profile = cust.filter(F.col("member_id") % NO_PROFILE_MOD != NO_PROFILE_REM).select(
        "member_id",
        F.when(F.col("member_id") % NULL_OS_MOD == 0, F.lit(None)).otherwise(F.col("os0")).cast("int").alias("os_type"),
        F.col("cc0").alias("country_code"),
    )
    firsts = (
        o.groupBy("member_id", F.to_date("ts").alias("day"))
        .agg(F.min(F.struct("ts", "order_id")).alias("first"))
        .select(F.col("first.order_id").alias("order_id"), F.lit(1).alias("is_first"))
    )
    login = o.join(firsts, "order_id", "left").select(
        "member_id",
        F.col("ts").alias("login_ts"),
        *seg,
        F.when(F.col("is_first") == 1, F.lit(1)).otherwise(F.lit(2)).cast("int").alias("login_day_seq"),
    )
    product = F.substring("o_orderpriority", 1, 1).cast("int")
    billing = o.filter(F.col("o_orderstatus") == PURCHASE_STATUS).select(
        "member_id",
        F.col("ts").alias("log_ts"),
        *seg,
        (product % MARKETS).cast("int").alias("market"),
        product.alias("product_id"),
        F.col("o_totalprice").cast(MONEY).alias("amount"),
    )
    tutorial_end = o.filter(F.col("o_orderpriority") == TUTORIAL_PRIORITY).select(
        "member_id", F.col("ts").alias("log_ts"), *seg
    )
    return Sources(member=member, profile=profile, login=login, billing=billing, tutorial_end=tutorial_end)
