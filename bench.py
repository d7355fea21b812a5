"""Benchmark: every KPI metric at one scale factor.

1. Derive the five game sources from ``events`` + ``customer`` (Spark job)
   and store them as parquet in a fresh scratch folder, logs partitioned by
   local date ``dt`` -- the layout the production jobs read.
2. Time each metric over the stored sources: one warm-up, then the median of
   ``BENCH_RUNS`` runs, each a full execution into Spark's ``noop`` sink (no
   driver collect).

3. Time the reference's literal shapes of ``dau_day`` and ``rau_day``
   (month range join over a cross-joined spine; NOT EXISTS) the same way,
   beside the rewritten forms (``reference_shape_sec``; comparison only).
4. Time the production path once: a first daily and weekly run through the
   incremental runner (one scan per log, member-bucketed co-location,
   checkpoints, versioned commits, bookmarks) into a fresh store, then a
   daily rerun (bookmarks at the last day: the incremental steady state).

Prints ONE JSON line. ``value`` is the sum of the per-metric medians.
Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (default 5).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from daybook.config import FIXTURE_CONFIG  # noqa: E402
from daybook.plans import catalog, runner  # noqa: E402
from daybook.session import checkpoint_dir, local_session  # noqa: E402
from daybook.sources.sinks import TableStore  # noqa: E402
from daybook.sources.fixtures import fixture_sources  # noqa: E402
from daybook.sources.tables import read_sources, write_sources  # noqa: E402
from scripts.reference_shapes import dau_day_literal, rau_day_literal  # noqa: E402


def _timed(fn):
    t = time.perf_counter()
    fn()
    return time.perf_counter() - t


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None

    scratch = tempfile.mkdtemp(prefix="daybook-bench-")
    spark = local_session(cores=cpus, shuffle_partitions=cpus, app="daybook-bench")
    cfg = FIXTURE_CONFIG

    src_root = f"{scratch}/sources"
    build = _timed(lambda: write_sources(fixture_sources(spark, sf_dir, cfg.tz_offset_hours), src_root))
    src = read_sources(spark, src_root)

    def warm_median(make_df) -> float:
        def run():
            make_df().write.format("noop").mode("overwrite").save()

        run()  # warm-up
        return round(statistics.median(_timed(run) for _ in range(runs)), 4)

    times = {name: warm_median(lambda name=name: catalog.metric(name, cfg, src)) for name in catalog.METRICS}
    literal = {
        "dau_day_literal": warm_median(lambda: dau_day_literal(spark, src, cfg)),
        "rau_day_literal": warm_median(lambda: rau_day_literal(spark, src, cfg)),
    }

    checkpoint_dir(spark, fallback=f"{scratch}/checkpoints")
    store = TableStore(spark, f"{scratch}/store")
    run_times = {
        "daily_first_run": _timed(lambda: runner.run_daily(spark, store, src, cfg)),
        "weekly_first_run": _timed(lambda: runner.run_weekly(spark, store, src, cfg)),
        "daily_rerun": _timed(lambda: runner.run_daily(spark, store, src, cfg)),
    }

    total = round(sum(times.values()), 4)
    print(
        json.dumps(
            {
                "metric": "kpi_metrics_total_median",
                "value": total,
                "unit": "sec",
                "queries": times,
                "sf": sf,
                "cpus": cpus,
                "runs": runs,
                "sources_build_sec": round(build, 4),
                "runner_sec": {k: round(v, 4) for k, v in run_times.items()},
                "reference_shape_sec": literal,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
