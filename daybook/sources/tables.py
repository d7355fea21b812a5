"""Source tables of the KPI jobs and their readers.

The jobs read five operational tables. In production they are parquet
datasets; the three logs are partitioned by a local-date column ``dt`` so the
day windows of the metrics prune whole partitions.

=============  ==============================================================
table          columns
=============  ==============================================================
member         member_id bigint, reg_utc timestamp_ntz (UTC), member_name string
profile        member_id bigint, os_type int, country_code string
login          member_id, login_ts (local), os_type, country_code, login_day_seq int
billing        member_id, log_ts (local), os_type, country_code, market int,
               product_id int, amount decimal(18,2)
tutorial_end   member_id, log_ts (local), os_type, country_code
=============  ==============================================================

``login_day_seq = 1`` marks a member's first login of a day.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from daybook.functions.calendar import LAYOUT_COLUMNS

MONEY = T.DecimalType(18, 2)

SCHEMAS: dict[str, T.StructType] = {
    "member": T.StructType(
        [
            T.StructField("member_id", T.LongType()),
            T.StructField("reg_utc", T.TimestampNTZType()),
            T.StructField("member_name", T.StringType()),
        ]
    ),
    "profile": T.StructType(
        [
            T.StructField("member_id", T.LongType()),
            T.StructField("os_type", T.IntegerType()),
            T.StructField("country_code", T.StringType()),
        ]
    ),
    "login": T.StructType(
        [
            T.StructField("member_id", T.LongType()),
            T.StructField("login_ts", T.TimestampNTZType()),
            T.StructField("os_type", T.IntegerType()),
            T.StructField("country_code", T.StringType()),
            T.StructField("login_day_seq", T.IntegerType()),
        ]
    ),
    "billing": T.StructType(
        [
            T.StructField("member_id", T.LongType()),
            T.StructField("log_ts", T.TimestampNTZType()),
            T.StructField("os_type", T.IntegerType()),
            T.StructField("country_code", T.StringType()),
            T.StructField("market", T.IntegerType()),
            T.StructField("product_id", T.IntegerType()),
            T.StructField("amount", MONEY),
        ]
    ),
    "tutorial_end": T.StructType(
        [
            T.StructField("member_id", T.LongType()),
            T.StructField("log_ts", T.TimestampNTZType()),
            T.StructField("os_type", T.IntegerType()),
            T.StructField("country_code", T.StringType()),
        ]
    ),
}

LOG_TABLES = ("login", "billing", "tutorial_end")


@dataclass(frozen=True)
class Sources:
    """The five inputs of the KPI jobs as (lazy) DataFrames."""

    member: DataFrame
    profile: DataFrame
    login: DataFrame
    billing: DataFrame
    tutorial_end: DataFrame
    colocated: bool = False  # every table is partitioned alike by member, and logs are reduced to member-days
    masks: dict[str, DataFrame] | None = None  # stored month masks by log, covering the run's month window

    def replace(self, **kw) -> "Sources":
        return replace(self, **kw)

    def items(self):
        return {
            "member": self.member,
            "profile": self.profile,
            "login": self.login,
            "billing": self.billing,
            "tutorial_end": self.tutorial_end,
        }.items()


def read_sources(spark: SparkSession, root: str) -> Sources:
    """Read ``root/<table>`` parquet datasets.

    Logs may be partitioned by local date in any of ``calendar.LAYOUTS`` (``dt``,
    ``yyyy/mm/dd``, ``yyyy/mm``, ``ym``); partition discovery exposes the columns
    and the metric windows filter on them. Tables are projected to ``SCHEMAS``
    (and these) with its types, so other columns of theirs have no effect.
    """
    frames = {}
    for name, schema in SCHEMAS.items():
        df = spark.read.parquet(f"{root.rstrip('/')}/{name}")
        columns = [df[f.name].cast(f.dataType).alias(f.name) for f in schema.fields]
        frames[name] = df.select(*columns, *(c for c in LAYOUT_COLUMNS if name in LOG_TABLES and c in df.columns))
    return Sources(**frames)


def write_sources(src: Sources, root: str, partition_logs: bool = True, tasks_per_day: int = 16) -> None:
    """Materialize sources as parquet (logs partitioned by local ``dt``, a day dealt to ``tasks_per_day`` tasks by member)."""
    from pyspark.sql import functions as F

    ts_col = {"login": "login_ts", "billing": "log_ts", "tutorial_end": "log_ts"}
    for name, df in src.items():
        path = f"{root.rstrip('/')}/{name}"
        if partition_logs and name in LOG_TABLES and "dt" not in df.columns:
            (
                df.withColumn("dt", F.to_date(ts_col[name]))
                .repartition("dt", F.pmod(F.xxhash64("member_id"), F.lit(tasks_per_day)))
                .write.mode("overwrite")
                .partitionBy("dt")
                .parquet(path)
            )
        else:
            df.write.mode("overwrite").parquet(path)
