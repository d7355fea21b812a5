"""Incremental-load operators: keyed range replacement and bookmarks.

The reference deletes a game's rows from a cutoff date on, then upserts the
new result with REPLACE INTO (equal keys overwritten, also below the cutoff),
and finally moves a per-(game, job, kind) bookmark to the largest date it
produced. Here both are pure DataFrame transformations; ``daybook.sources.sinks``
commits their output as a new table version.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BOOKMARK_SCHEMA = T.StructType(
    [
        T.StructField("game_code", T.StringType()),
        T.StructField("job", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("value", T.StringType()),
    ]
)
BOOKMARK_KEYS = ["game_code", "job", "kind"]


def rows_kept(existing: DataFrame, new: DataFrame, game_code: str, cutoff, keys: list[str], date_col: str) -> DataFrame:
    """``existing`` minus this game's rows at/after ``cutoff`` minus rows whose key reappears in ``new``.

    Key equality is NULL-safe: a NULL segment is a key value like any other,
    so a re-computed NULL-segment row replaces its stale copy.
    """
    # as a DELETE does, keep rows for which the comparison is unknown
    gone = (F.col("game_code") == F.lit(game_code)) & (F.col(date_col) >= F.lit(cutoff))
    kept = existing.filter(~F.coalesce(gone, F.lit(False)))
    new_keys = new.select(*[F.col(k).alias(f"_new_{k}") for k in keys])
    cond = reduce(lambda a, b: a & b, [kept[k].eqNullSafe(new_keys[f"_new_{k}"]) for k in keys])
    return kept.join(new_keys, cond, "left_anti")


def replace_range(existing: DataFrame, new: DataFrame, game_code: str, cutoff, keys: list[str], date_col: str) -> DataFrame:
    """The rows kept of ``existing`` (see ``rows_kept``) plus ``new``."""
    kept = rows_kept(existing, new, game_code, cutoff, keys, date_col)
    return kept.unionByName(new.select(*existing.columns))


def empty_bookmarks(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], BOOKMARK_SCHEMA)


def read_bookmark(bookmarks: DataFrame, game_code: str, job: str, kind: str, default: str) -> str:
    """The stored value for (game, job, kind), or ``default`` (one-row lookup)."""
    row = (
        bookmarks.filter(
            (F.col("game_code") == game_code) & (F.col("job") == job) & (F.col("kind") == kind)
        )
        .select("value")
        .limit(1)
        .collect()
    )
    return row[0]["value"] if row and row[0]["value"] is not None else default


def advance_bookmark(bookmarks: DataFrame, game_code: str, job: str, kind: str, result: DataFrame, date_col: str) -> DataFrame:
    """Set (game, job, kind) to the largest ``date_col`` in ``result``.

    An empty result leaves the bookmark untouched (the reference skips the
    whole write then). Only one aggregated row leaves the executors.
    """
    latest = (
        result.agg(F.max(F.col(date_col)).cast("string").alias("value"))
        .filter(F.col("value").isNotNull())
        .select(F.lit(game_code).alias("game_code"), F.lit(job).alias("job"), F.lit(kind).alias("kind"), "value")
    )
    kept = bookmarks.join(latest.select(*BOOKMARK_KEYS), BOOKMARK_KEYS, "left_anti")
    return kept.unionByName(latest)


def bookmark_values(bookmarks: DataFrame) -> dict[tuple[str, str, str], str]:
    """The bookmark table as {(game, job, kind): value}.

    A control table with one row per game, job and kind, so collecting it is
    bounded by the number of jobs, not by data volume.
    """
    return {(r["game_code"], r["job"], r["kind"]): r["value"] for r in bookmarks.collect()}


def bookmarks_frame(spark: SparkSession, values: dict[tuple[str, str, str], str]) -> DataFrame:
    rows = [(g, j, k, v) for (g, j, k), v in sorted(values.items())]
    return spark.createDataFrame(rows, BOOKMARK_SCHEMA)
