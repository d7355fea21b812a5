"""Shared helpers: reading tables, cutting lineage, ranking in classes, connected components."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from daybook.session import checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table by folder and name, through Spark's own reader."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared checkpoint folder and read it back.

    Cuts lineage on storage that all executors share, so a lost executor costs
    only its running tasks; later plans see the file sizes, so joins with
    small tables are chosen by a checked size.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def slices(batches: Iterator, rows: int = 2048) -> Iterator:
    """Arrow batches in parts of at most ``rows`` rows; at the end freed memory goes back to the system.

    Python workers outlive their tasks, and would otherwise hold their largest
    size while later stages need the executor's memory.
    """
    import pyarrow as pa

    for b in batches:
        for k in range(0, max(1, b.num_rows), rows):
            yield b.slice(k, rows)
        del b
    pa.default_memory_pool().release_unused()
    trimmed()


def trimmed() -> None:
    """Give freed memory back to the system."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the C library may not have it
    if trim is not None:
        trim(0)


def reused(yes: bool) -> None:
    """Let this worker keep freed arrays of up to 32 MB, rather than map fresh pages for each; or no longer (the C library's own limits)."""
    option = getattr(ctypes.CDLL(None), "mallopt", None)
    if option is not None:
        option(-3, 1 << (25 if yes else 17))  # M_MMAP_THRESHOLD
        option(-1, 1 << (28 if yes else 17))  # M_TRIM_THRESHOLD
    if not yes:
        trimmed()


def bucket_of(*cols: Column | str, buckets: int) -> Column:
    """A stable bucket number from the values of ``cols``."""
    return F.pmod(F.xxhash64(*cols), F.lit(buckets)).cast("int")


def bucket_count(rows: int, per_bucket: int = 50_000) -> int:
    """As many buckets as keep each near ``per_bucket`` rows."""
    return max(8, -(-rows // per_bucket))


def ranked(df: DataFrame, cls: list[str], order: list[str], buckets: int, name: str = "rank") -> DataFrame:
    """Add ``name``: a gapless number from 0 of each row within its class.

    A class may hold any share of the rows: rows are numbered inside
    (class, hash bucket) and the bucket's offset is added, so no task ever
    sees more than one bucket of one class. ``df`` should be materialised,
    as it is read twice; equal rows are interchangeable.
    """
    b = df.withColumn("_b", bucket_of(*order, buckets=buckets))
    sizes = b.groupBy(*cls, "_b").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*cls).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    inside = Window.partitionBy(*cls, "_b").orderBy(*order)
    numbered = b.withColumn("_r", F.row_number().over(inside) - 1)
    on = [numbered[c].eqNullSafe(offsets[c]) for c in cls] + [numbered["_b"] == offsets["_b"]]
    cond = on[0]
    for c in on[1:]:
        cond = cond & c
    joined = numbered.join(offsets, cond)
    keep = [numbered[c] for c in df.columns]
    return joined.select(*keep, (F.col("_off") + F.col("_r")).cast("long").alias(name))


def components(edges: DataFrame, label: str = "cc") -> DataFrame:
    """Connected components of ``edges(a long, b long)``: rows ``(node, component)``, component = smallest node.

    Alternates large-star and small-star steps (Kiveris et al., "Connected
    Components in MapReduce and Beyond") as joins with map-side-combined minima:
    no neighbour list is gathered, and Spark may split the join of a hot node.
    Each round is written to the shared folder; rounds go on until one changes nothing. Self loops are ignored; an
    empty input gives an empty result.
    """
    e = materialise(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), label
    )
    while True:
        # large star: every larger neighbour of u points to the smallest of u and its neighbours
        both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: u and its smaller neighbours point to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x"))
        new = materialise(small.select("x.u", "x.v").where("u <> v").distinct(), label)
        # a star forest is a fixed point: no node is both a leaf and a centre, and no leaf has two centres
        stats = new.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        old = e.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        e = new
        if stats == old:
            return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                e.select(F.col("v").alias("node"), F.col("v").alias("component"))
            ).distinct()
