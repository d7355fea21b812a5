"""Upstream arrival tracking with Structured Streaming.

The reference jobs read an upstream high-water mark per log ("dms" bookmarks
of the login, billing and tutorial logs) to know what has landed. Here a file
stream over the log directory plays that role: its checkpoint records which
files were processed, and an ``availableNow`` trigger processes exactly the
files that arrived since the last call, then stops. Each micro-batch is
reduced on the executors to one row (first and last local day touched), so
the driver learns which days need recomputing without seeing any log rows.

``refresh`` chains this to the batch runner: when new log files arrived, the
daily and weekly jobs run; late files that touch days before a job's
bookmark rewind that bookmark so the affected days are recomputed. What has
arrived is committed to the store's ``arrivals`` table inside the micro-batch,
before the stream's checkpoint moves; after the jobs only the arrivals that they
saw are cleared, so neither a crash in between nor an arrival during the run
loses a late day. Arrivals also mark the days they touch as stale in the ledger
(``plans.ledger``) and move the log's upstream mark (kind ``dms``) to the newest
timestamp that has landed.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.config import KpiConfig
from daybook.operators.incremental import BOOKMARK_SCHEMA, bookmark_values, bookmarks_frame
from daybook.plans import ledger
from daybook.sources.sinks import TableStore
from daybook.sources.tables import Sources


@dataclass(frozen=True)
class Arrival:
    """Local days that new rows of a log touch, and the newest timestamp among them."""

    first: date
    last: date
    newest: datetime


def arrivals(
    spark: SparkSession,
    log_path: str,
    schema: T.StructType,
    ts_col: str,
    checkpoint_location: str,
    record: Callable[[Arrival], None] | None = None,
) -> tuple[date, date] | None:
    """(first, last) local day among rows of log files new since the last call.

    Returns None when nothing arrived. ``checkpoint_location`` must be on
    shared storage; it is the arrival bookmark. ``record`` gets what each batch
    brought before the bookmark moves.
    """
    span: dict[str, date | None] = {"lo": None, "hi": None}

    def on_batch(batch: DataFrame, epoch_id: int) -> None:
        r = batch.agg(F.min("day").alias("lo"), F.max("day").alias("hi"), F.max("ts").alias("newest")).first()
        if r is None or r["lo"] is None:
            return
        if record is not None:
            record(Arrival(r["lo"], r["hi"], r["newest"]))
        span["lo"] = r["lo"] if span["lo"] is None else min(span["lo"], r["lo"])
        span["hi"] = r["hi"] if span["hi"] is None else max(span["hi"], r["hi"])

    stream = spark.readStream.schema(schema).parquet(log_path).select(F.to_date(F.col(ts_col)).alias("day"), F.col(ts_col).alias("ts"))
    query = (
        stream.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint_location)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if span["lo"] is None:
        return None
    return span["lo"], span["hi"]


def rewind_bookmarks(bookmarks: DataFrame, game_code: str, kind: str, earliest: date, before_days: int) -> DataFrame:
    """Move (game, *, kind) bookmarks back so their window reaches ``earliest``.

    A daily job recomputes days after ``bookmark - before_days``, so the
    bookmark becomes ``earliest + before_days - 1`` where it is later; a
    weekly job recomputes weeks after the bookmark's week, so its bookmark
    becomes the day before ``earliest``'s week.
    """
    if kind == "day":
        target = earliest + timedelta(days=before_days - 1)
    else:
        sunday = earliest - timedelta(days=(earliest.weekday() + 1) % 7)
        target = sunday - timedelta(days=1)
    value = F.lit(target.isoformat())
    hit = (F.col("game_code") == game_code) & (F.col("kind") == kind) & (F.col("value") > value)
    return bookmarks.select(
        "game_code", "job", "kind", F.when(hit, value).otherwise(F.col("value")).alias("value")
    )


PENDING_SCHEMA = T.StructType(
    [
        T.StructField("game_code", T.StringType()),
        T.StructField("log", T.StringType()),
        T.StructField("first", T.DateType()),
        T.StructField("last", T.DateType()),
        T.StructField("newest", T.TimestampNTZType()),
        T.StructField("batch", T.StringType()),
    ]
)


def pending(store: TableStore, game_code: str) -> list:
    """What has arrived for a game and isn't computed yet: a row a micro-batch."""
    return store.read("arrivals", PENDING_SCHEMA, game=game_code).collect()


def _put_pending(spark: SparkSession, store: TableStore, game_code: str, rows: list) -> None:
    store.replace_game("arrivals", spark.createDataFrame(rows, PENDING_SCHEMA), game_code)


def upstream_marks(marks: dict[tuple[str, str, str], str], rows: list) -> dict[tuple[str, str, str], str]:
    """``marks`` with the logs' upstream marks moved to the newest of ``rows``; they never move back."""
    out = dict(marks)
    for r in rows:
        key = (r["game_code"], r["log"], ledger.UPSTREAM)
        out[key] = max(out.get(key, ""), r["newest"].isoformat(sep=" "))
    return out


def refresh(
    spark: SparkSession,
    store: TableStore,
    src: Sources,
    base: KpiConfig,
    watched: dict[str, tuple[str, T.StructType, str]],
    checkpoint_root: str,
    rescan: str = "window",
    landed_only: bool = False,
) -> dict[str, str | None] | None:
    """Run the daily and weekly jobs if any watched log received files, or did before a failed call.

    ``watched`` maps a log name to (path, schema, timestamp column); ``rescan``
    and ``landed_only`` are those of the runner. By default the whole look-back
    window is read, so also rows that vanished or came by unwatched ways count.
    Returns the runner's new bookmarks, or None when nothing arrived.
    """
    from daybook.plans import runner

    game = base.game_code
    for name, (path, schema, ts) in watched.items():

        def record(a: Arrival, name: str = name) -> None:
            _put_pending(spark, store, game, [*pending(store, game), (game, name, a.first, a.last, a.newest, uuid.uuid4().hex)])

        arrivals(spark, path, schema, ts, f"{checkpoint_root.rstrip('/')}/{name}", record)
    rows = pending(store, game)
    if not rows:
        return None
    for r in rows:
        ledger.mark_stale(spark, store, game, r["log"], r["first"], r["last"])
    earliest = min(r["first"] for r in rows)
    store.adopt("bookmark", None)
    marks = store.read("bookmark", BOOKMARK_SCHEMA, game=game)
    for kind in ("day", "week"):
        marks = rewind_bookmarks(marks, game, kind, earliest, base.before_days)
    store.commit("bookmark", marks, partitions=1)
    landed = upstream_marks(bookmark_values(store.read(ledger.UPSTREAM, BOOKMARK_SCHEMA, game=game)), rows)
    store.replace_game(ledger.UPSTREAM, bookmarks_frame(spark, landed), game)
    out = runner.run_daily(spark, store, src, base, rescan=rescan, landed_only=landed_only)
    out.update(runner.run_weekly(spark, store, src, base, rescan=rescan, landed_only=landed_only))
    seen = {r["batch"] for r in rows}
    _put_pending(spark, store, game, [r for r in pending(store, game) if r["batch"] not in seen])
    return out
