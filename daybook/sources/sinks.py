"""Sinks: partitioned summary tables, versioned control tables and CSV snapshots.

The reference deletes a date range and upserts into MySQL over separate
connections, so a failure in between leaves a hole. Here:

* **Summary tables** (``TableStore.replace``) are parquet, partitioned by game
  and month. A run stages its result and the rows of the touched months that
  it leaves alone, claims the next commit number of the table (an exclusive
  create, so no two writers hold one number), and renames the staged folder to
  that number: the commit. Then each touched partition is swapped for its new
  content by two renames, the old one going to the commit's snapshot folder.
  What a crash leaves unswapped is swapped by the next writer of the table.
  Untouched partitions keep their files; two games touch different ones, so
  both survive when they commit at once. A reader of one game and range lists
  and reads only its partitions.
* **Control tables** of a few rows (``replace_game``) work alike, with one
  partition a game.
  Both lie below ``<root>/<table>/parts``.
* **Whole tables** (``commit``) are written as ``<root>/<table>/v=<n>/<attempt>``
  by one Spark job, whose committer marks the attempt with ``_SUCCESS``. Only
  marked attempts count; readers take the newest version.

Snapshots and older versions stay until ``vacuum`` removes all but the newest.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import date

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.operators.incremental import rows_kept

# Partition columns; values carry a letter in front, so none reads as a number.
PART_GAME, PART_MONTH = "part_game", "part_month"
ALL_MONTHS = "m-all"  # of control tables


def month_part(day: date) -> str:
    return f"m-{day.year:04d}-{day.month:02d}"


@dataclass(frozen=True)
class Landed:
    """What a replacement wrote: rows of the new result, its newest date, the commit's number."""

    rows: int
    latest: date
    version: int


class TableStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def parts(self, table: str) -> str:
        """Folder of a partitioned table's current partitions."""
        return f"{self.root}/{table}/parts"

    # ---- whole tables ---------------------------------------------------
    def versions(self, table: str) -> list[int]:
        """Committed version numbers, from folder listings (no job)."""
        claimed = [_number(p) for p in list_path(self.spark, self._commits(table))]
        whole = [_number(p) for p in list_path(self.spark, self.path(table))]
        return sorted({n for n in claimed if n} | {n for n in whole if n and self._attempt(table, n)})

    def _attempt(self, table: str, version: int) -> str | None:
        """Folder of a version's committed attempt, if it has one."""
        attempts = sorted(list_path(self.spark, f"{self.path(table)}/v={version}"))
        return next((a for a in attempts if not _name(a).startswith("_") and path_exists(self.spark, f"{a}/_SUCCESS")), None)

    def _newest(self, table: str) -> str | None:
        """Folder of the newest committed version; older ones aren't opened."""
        numbers = sorted((n for p in list_path(self.spark, self.path(table)) if (n := _number(p))), reverse=True)
        return next((a for n in numbers if (a := self._attempt(table, n))), None)

    def exists(self, table: str) -> bool:
        return self._partitioned(table) or self._newest(table) is not None

    def commit(self, table: str, df: DataFrame, partitions: int | None = None) -> int:
        """Write ``df`` as the table's next version; returns its number.

        The number is claimed by an exclusive create: of two writers at once,
        one takes the next number, and none adds to a version already read.
        """
        if self._partitioned(table):  # of a control table, the partitions of the games in ``df``
            staged = self.staging(table)
            parts = {PART_GAME: F.concat(F.lit("g-"), "game_code"), PART_MONTH: F.lit(ALL_MONTHS)}
            df.coalesce(1).withColumns(parts).write.partitionBy(PART_GAME, PART_MONTH).parquet(staged)
            return self.swap(table, staged)
        v = max(self.versions(table), default=0) + 1
        while not create_file(self.spark, f"{self.path(table)}/v={v}/_claim"):
            v += 1
        out = df.coalesce(partitions) if partitions else df
        try:
            out.write.mode("errorifexists").parquet(f"{self.path(table)}/v={v}/{uuid.uuid4().hex}")
        except BaseException:
            delete_path(self.spark, f"{self.path(table)}/v={v}/_claim")
            raise
        return v

    # ---- partitioned tables ---------------------------------------------
    def _commits(self, table: str) -> str:
        return f"{self.root}/_commits/{table}"

    def _partitioned(self, table: str) -> bool:
        return any(_name(p).startswith(f"{PART_GAME}=") for p in list_path(self.spark, self.parts(table)))

    def _months(self, table: str, game_code: str) -> set[str]:
        """Months of a game that the table holds, from the folder listing."""
        folder = f"{self.parts(table)}/{PART_GAME}={self._escaped('g-' + game_code)}"
        return {_name(p).split("=", 1)[1] for p in list_path(self.spark, folder)}

    def _escaped(self, value: str) -> str:
        """A partition value as Spark writes it into a path."""
        return self.spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(value)

    def read(
        self,
        table: str,
        schema: T.StructType | None = None,
        version: int | None = None,
        game: str | None = None,
        lo: date | None = None,
        hi: date | None = None,
    ) -> DataFrame:
        """The table's rows; of partitioned tables those of ``game`` in the months of ``lo`` to ``hi``, both included.

        Months hold whole months: filter days as well where a month is too much.
        """
        if version is None and self._partitioned(table):
            reader = self.spark.read
            if schema is not None:
                parts = [T.StructField(c, T.StringType()) for c in (PART_GAME, PART_MONTH)]
                reader = reader.schema(T.StructType([*schema.fields, *parts]))
            df = reader.parquet(self.parts(table))
            if game is not None:
                df = df.filter(F.col(PART_GAME) == f"g-{game}")
            if lo is not None:
                df = df.filter(F.col(PART_MONTH) >= month_part(lo))
            if hi is not None:
                df = df.filter(F.col(PART_MONTH) <= month_part(hi))
            return df.drop(PART_GAME, PART_MONTH)
        found = self._newest(table) if version is None else self._attempt(table, version)
        if found is None:
            if schema is None:
                raise FileNotFoundError(f"no committed version of {table}")
            return self.spark.createDataFrame([], schema)
        df = self.spark.read.parquet(found)
        return df if game is None else df.filter(F.col("game_code") == game)

    def replace(self, table: str, result: DataFrame, game_code: str, cutoff: date, keys: list[str], date_col: str) -> Landed | None:
        """Replace this game's rows from ``cutoff`` on, and rows of equal keys, by ``result``; None if that is empty.

        The job that stages the result also observes its number of rows and
        newest date, so neither the guard against empty results nor the
        bookmark takes another pass. Rows without a date are never written.
        Only months of the result, and later ones than the cutoff, are touched.
        """
        self.adopt(table, date_col)
        seen, staged = Observation(), self.staging(table)
        named = result.filter(F.col(date_col).isNotNull())
        rows = named.observe(seen, F.count(F.lit(1)).alias("rows"), F.max(date_col).cast("string").alias("latest"))
        self._stage(rows, staged, date_col)
        months = self._staged_months(staged)
        if not months:  # nothing was observed, or the optimiser saw that there is nothing
            delete_path(self.spark, staged)
            return None
        touched = months | {m for m in self._months(table, game_code) if m >= month_part(cutoff)}
        if old := touched & self._months(table, game_code):
            new = self.spark.read.schema(_with_parts(result.schema)).parquet(staged)
            stored = self.read(table, result.schema, game=game_code, lo=_first_day(min(old)), hi=_first_day(max(old)))
            kept = rows_kept(stored, new, game_code, cutoff, keys, date_col)
            # months in between that aren't touched have no row in the range nor of an equal key: they stay as they are
            self._stage(kept, staged, date_col, only=sorted(touched))
            self._empty(staged, game_code, touched)
        return Landed(seen.get["rows"], date.fromisoformat(seen.get["latest"]), self.swap(table, staged))

    def replace_game(self, table: str, rows: DataFrame, game_code: str, part: str = ALL_MONTHS, few: bool = True) -> int:
        """Put ``rows``, all of one game, in place of what a control or state table holds of it under ``part``."""
        self.adopt(table, None)
        staged = self.staging(table)
        parts = {PART_GAME: F.lit(f"g-{game_code}"), PART_MONTH: F.lit(part)}
        (rows.coalesce(1) if few else rows).withColumns(parts).write.partitionBy(PART_GAME, PART_MONTH).parquet(staged)
        self._empty(staged, game_code, {part})
        return self.swap(table, staged)

    def read_part(self, table: str, schema: T.StructType, game_code: str, part: str) -> DataFrame:
        rows = self.spark.read.schema(_with_parts(schema)).parquet(self.parts(table))
        return rows.filter((F.col(PART_GAME) == f"g-{game_code}") & (F.col(PART_MONTH) == part)).drop(PART_GAME, PART_MONTH)

    def part_names(self, table: str, game_code: str) -> set[str]:
        """What a table holds of a game: months, or the parts of a state table (a folder listing, no job)."""
        return self._months(table, game_code)

    def drop_part(self, table: str, game_code: str, part: str) -> None:
        delete_path(self.spark, f"{self.parts(table)}/{PART_GAME}={self._escaped('g-' + game_code)}/{PART_MONTH}={part}")

    def adopt(self, table: str, date_col: str | None) -> None:
        """A table kept as whole versions until now becomes a partitioned one, once."""
        if self._partitioned(table) or (whole := self._newest(table)) is None:
            return
        staged = self.staging(table)
        df = self.spark.read.parquet(whole)
        month = F.lit(ALL_MONTHS) if date_col is None else F.date_format(date_col, "'m-'yyyy-MM")
        df.withColumns({PART_GAME: F.concat(F.lit("g-"), "game_code"), PART_MONTH: month}).write.partitionBy(PART_GAME, PART_MONTH).parquet(staged)
        self.swap(table, staged)

    def staging(self, table: str) -> str:
        """A folder of its own for a table's partitions before they are swapped in."""
        return f"{self.root}/_staged/{table}/{uuid.uuid4().hex}"

    def _stage(self, rows: DataFrame, staged: str, date_col: str, only: list[str] | None = None) -> None:
        month = F.date_format(date_col, "'m-'yyyy-MM")
        out = rows.withColumns({PART_GAME: F.concat(F.lit("g-"), "game_code"), PART_MONTH: month})
        if only is not None:
            out = out.filter(F.col(PART_MONTH).isin(only))
        # a month's rows in few files, large months split by their size
        out.hint("rebalance", PART_GAME, PART_MONTH).write.mode("append").partitionBy(PART_GAME, PART_MONTH).parquet(staged)

    def _empty(self, staged: str, game_code: str, months: set[str]) -> None:
        """Empty folders for those of ``months`` that have no row left: they take the place of the old partitions."""
        for m in months - self._staged_months(staged):
            make_folder(self.spark, f"{staged}/{PART_GAME}={self._escaped('g-' + game_code)}/{PART_MONTH}={m}")

    def _staged_months(self, staged: str) -> set[str]:
        return {_name(m).split("=", 1)[1] for g in list_path(self.spark, staged) if "=" in _name(g) for m in list_path(self.spark, g)}

    def swap(self, table: str, staged: str) -> int:
        """Put a staged folder's partitions (``column=value`` folders, nested or not) in place of the table's; the commit's number.

        Renaming the staged folder to its number is the commit. Partitions are
        then swapped one by one; every step can be done again by another writer.
        """
        for left in list_path(self.spark, f"{self.root}/_pending/{table}"):  # of writers that died, or still swap
            self._apply(table, left)
        v = max((_number(p) or 0 for p in list_path(self.spark, self._commits(table))), default=0) + 1
        while not create_file(self.spark, f"{self._commits(table)}/v={v}"):
            v += 1
        pending = f"{self.root}/_pending/{table}/v={v}"
        move(self.spark, staged, pending)
        self._apply(table, pending)
        return v

    def _apply(self, table: str, pending: str) -> None:
        for leaf in leaf_partitions(self.spark, pending):
            inside = leaf.split(f"/{_name(pending)}/", 1)[1]
            target = f"{self.parts(table)}/{inside}"
            while path_exists(self.spark, leaf):
                move(self.spark, target, f"{self.root}/_replaced/{table}/{_name(pending)}/{inside}")
                if move(self.spark, leaf, target):
                    break
        delete_path(self.spark, pending)

    def vacuum(self, table: str, keep: int) -> list[int]:
        """Delete all but the newest ``keep`` versions or snapshots; returns the deleted ones.

        Only what is older than the current state is touched, so its readers
        are unaffected.
        """
        vs = self.versions(table)
        old = vs[:-keep] if keep > 0 else vs[:-1]
        for v in old:
            for folder in (self.path(table), self._commits(table), f"{self.root}/_replaced/{table}"):
                delete_path(self.spark, f"{folder}/v={v}")
        return old


def _with_parts(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, *(T.StructField(c, T.StringType()) for c in (PART_GAME, PART_MONTH))])


def _first_day(month: str) -> date:
    return date.fromisoformat(f"{month[2:]}-01")


def _name(path: str) -> str:
    return path.rstrip("/").rsplit("/", 1)[-1]


def _number(path: str) -> int | None:
    """n of a path that ends in v=<n>."""
    name = _name(path)
    return int(name[2:]) if name.startswith("v=") and name[2:].isdigit() else None


# PySpark has no public file-system API; the Hadoop ``FileSystem`` reached
# through the session's JVM gateway is the usual way for housekeeping.
def _fs(spark: SparkSession, path: str):
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jpath, jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def delete_path(spark: SparkSession, path: str) -> bool:
    """Recursively delete ``path`` on its (Hadoop-compatible) file system."""
    jpath, fs = _fs(spark, path)
    return bool(fs.exists(jpath) and fs.delete(jpath, True))


def path_exists(spark: SparkSession, path: str) -> bool:
    jpath, fs = _fs(spark, path)
    return bool(fs.exists(jpath))


def create_file(spark: SparkSession, path: str) -> bool:
    """Create an empty file; False if it is there already (made by whoever was first)."""
    jpath, fs = _fs(spark, path)
    try:
        fs.create(jpath, False).close()
    except Py4JJavaError as e:
        if path_exists(spark, path):
            return False
        raise e
    return True


def make_folder(spark: SparkSession, path: str) -> None:
    jpath, fs = _fs(spark, path)
    fs.mkdirs(jpath)


def move(spark: SparkSession, source: str, target: str) -> bool:
    """Rename a folder; False if the source isn't there or the target is."""
    source_path, fs = _fs(spark, source)
    target_path, _ = _fs(spark, target)
    if not fs.exists(source_path) or fs.exists(target_path):  # a rename onto a folder would move into it
        return False
    fs.mkdirs(target_path.getParent())
    try:
        return bool(fs.rename(source_path, target_path))
    except Py4JJavaError:
        if fs.exists(source_path):
            raise
        return False


def list_path(spark: SparkSession, path: str) -> list[str]:
    """The paths in a folder; none if it isn't there."""
    jpath, fs = _fs(spark, path)
    if not fs.exists(jpath):
        return []
    return [s.getPath().toString() for s in fs.listStatus(jpath)]


def leaf_partitions(spark: SparkSession, path: str) -> list[str]:
    """Folders ``column=value`` below ``path`` that hold no further such folder."""
    out = []
    for p in list_path(spark, path):
        if "=" in _name(p) and not _name(p).startswith("_"):
            out += leaf_partitions(spark, p) or [p]
    return out


def backup_csv(df: DataFrame, path: str) -> None:
    """Snapshot rows as CSV with a header, replacing what is at ``path``."""
    df.write.mode("overwrite").option("header", True).csv(path)
