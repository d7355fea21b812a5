"""Command line: run the daily or weekly jobs of one game (e.g. via spark-submit).

    python -m daybook daily  --sources s3://bucket/game --store s3://bucket/kpi \\
        --game g1 --tz-offset-hours 9 --before-days 1 --as-of "2024-01-31 00:00" \\
        [--start 2024-01-01] [--backup s3://bucket/kpi-backup] [--buckets 4000]
    python -m daybook weekly --sources ... --store ... --game g1 [--week-start 2023-12-24]

``--start`` / ``--week-start`` are the defaults used when a job has no
bookmark yet. The session comes from the environment (``getOrCreate``), so the
cluster's settings apply, including ``spark.checkpoint.dir``. Prints one JSON
object: job table -> new bookmark (null when the job produced nothing).
"""

from __future__ import annotations

import argparse
import json
import sys
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import SparkSession

from daybook.config import KpiConfig
from daybook.plans import runner
from daybook.sources.sinks import TableStore
from daybook.sources.tables import read_sources


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="python -m daybook", description=__doc__.split("\n")[0])
    p.add_argument("kind", choices=["daily", "weekly"])
    p.add_argument("--sources", required=True, help="root of member, profile, login, billing, tutorial_end")
    p.add_argument("--store", required=True, help="root of the versioned summary tables")
    p.add_argument("--game", required=True)
    p.add_argument("--tz-offset-hours", type=int, default=9)
    p.add_argument("--before-days", type=int, default=1)
    p.add_argument("--as-of", default=None, help="local report time (default: now)")
    p.add_argument("--start", default="2024-01-01", help="daily bookmark default")
    p.add_argument("--week-start", default="2023-12-24", help="weekly bookmark default")
    p.add_argument("--backup", default=None, help="CSV snapshot root (daily only)")
    p.add_argument("--buckets", type=int, default=None, help="co-location buckets (default: shuffle partitions)")
    p.add_argument(
        "--rescan",
        choices=["window", "recent"],
        default="window",
        help="reduce the whole look-back window from raw logs (default), or only recent days over stored reductions",
    )
    return p


def main(argv: list[str] | None = None) -> dict[str, str | None]:
    a = _parser().parse_args(argv)
    as_of = datetime.fromisoformat(a.as_of) if a.as_of else datetime.now(timezone.utc).replace(tzinfo=None) + timedelta(hours=a.tz_offset_hours)
    cfg = KpiConfig(
        game_code=a.game,
        tz_offset_hours=a.tz_offset_hours,
        before_days=a.before_days,
        start=date.fromisoformat(a.start),
        week_start=date.fromisoformat(a.week_start),
        as_of=as_of,
    )
    spark = SparkSession.builder.appName(f"daybook-{a.kind}-{a.game}").getOrCreate()
    src = read_sources(spark, a.sources)
    store = TableStore(spark, a.store)
    if a.kind == "daily":
        out = runner.run_daily(spark, store, src, cfg, backup_root=a.backup, buckets=a.buckets, rescan=a.rescan)
    else:
        out = runner.run_weekly(spark, store, src, cfg, buckets=a.buckets, rescan=a.rescan)
    print(json.dumps(out, sort_keys=True))
    return out


if __name__ == "__main__":
    main(sys.argv[1:])
