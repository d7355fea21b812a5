"""K-d tree sharding by bytes.

Every document has coordinates measured on its text: bytes, share of
characters that are not ASCII, lines. A node of the tree owns a number of
shards and is split along its widest dimension (largest weighted deviation) at
the distributed weighted quantile that divides its bytes as its shards divide,
until each leaf holds one shard's target bytes.

A quantile is found by radix refinement: rows get a 52-bit key (20 bits of the
coordinate, 32 of the text's CRC), and each pass sums the bytes of the next
``BITS`` key bits of all nodes of a level, with map-side combining, into a
table of a row per node. Equal texts have equal keys and stay in one shard,
unless a border falls into a group of copies too heavy to lie on either side:
then 32 more bits, of the id, split that group. Rows meet their node's border
by a join with that table, which Spark broadcasts below its size threshold;
slots are given out by offset buckets.

Defined results: a null text has no bytes and counts 1 like an empty one; rows
repeated with the same id stay together; an id may be null; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.common import bucket_count, materialise, ranked

BITS = 13  # key bits that one pass resolves
KEY_BITS, ID_BITS = 52, 32
TOLERANCE = 0.002  # of a shard's bytes: a border this near to its target doesn't cut a group of copies
DIMS = ("x_bytes", "x_wide", "x_lines")


def measured(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    raw = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    text = F.coalesce(F.col(text_col), F.lit(""))
    size = F.octet_length(raw)
    return docs.select(
        F.col(id_col).alias("doc_id"),
        (size + 1).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"),
        F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")).alias("id_hash"),
        F.log2(size + F.lit(1.0)).alias("x_bytes"),
        (F.lit(1.0) - F.length(text) / F.greatest(size, F.lit(1))).alias("x_wide"),
        F.log2(size - F.octet_length(F.replace(text, F.lit("\n"), F.lit(""))) + F.lit(1.0)).alias("x_lines"),
    )


def _key(dim: Column) -> Column:
    """The 52-bit key of a row along the dimension numbered ``dim`` (from 1)."""
    return F.shiftleft(F.element_at(F.array(*DIMS), dim), 32) + F.col("text_crc32")


def _borders(rows: DataFrame, value: str, bits: int, wanted: DataFrame) -> DataFrame:
    """For each node the smallest value v with bytes(value <= v) >= want: ``node, want, v, before, here``.

    ``rows`` has ``node, size`` and ``value`` of ``bits`` bits, ``wanted`` has
    ``node, want``; ``before`` and ``here`` are the bytes below v and at v.
    """
    zero = F.lit(0).cast("long")
    found, at = wanted.select("node", "want", zero.alias("v"), zero.alias("before"), zero.alias("here")), bits
    while at > 0:
        step = min(BITS, at)
        at -= step
        inside = rows.join(found, "node").where(F.shiftright(value, at + step) == F.col("v"))
        bins = inside.groupBy("node", "want", "before", F.shiftright(value, at).alias("bin")).agg(F.sum("size").alias("w"))
        run = Window.partitionBy("node").orderBy("bin")  # at most 2**BITS bins a node
        bins = bins.withColumn("upto", F.col("before") + F.sum("w").over(run.rowsBetween(Window.unboundedPreceding, 0)))
        last = F.col("bin") == F.max("bin").over(Window.partitionBy("node"))
        hit = bins.withColumn("last", last).where((F.col("upto") >= F.col("want")) | F.col("last"))
        first = hit.groupBy("node", "want").agg(F.min_by(F.struct("bin", "w", "upto"), "bin").alias("b"))
        found = first.select("node", "want", F.col("b.bin").alias("v"), (F.col("b.upto") - F.col("b.w")).alias("before"), F.col("b.w").alias("here"))
        found = materialise(found, "shard-borders")
    return found


def _cuts(rows: DataFrame) -> DataFrame:
    """``node, dim, key, id_key`` of every node in ``rows`` that has more than one shard."""
    w = F.col("size").cast("double")
    sums = [F.sum("size").alias("w")] + [f.alias(f"{k}_{d}") for d in DIMS for k, f in (("s", F.sum(w * F.col(d))), ("q", F.sum(w * F.col(d) * F.col(d))))]
    spread = F.array(*(F.col(f"q_{d}") / F.col("w") - F.pow(F.col(f"s_{d}") / F.col("w"), F.lit(2.0)) for d in DIMS))
    half = F.expr("shards div 2")
    level = rows.where("shards > 1").groupBy("node", "shards").agg(*sums).select(
        "node",
        F.array_position(spread, F.array_max(spread)).cast("int").alias("dim"),
        half.alias("half"),
        (F.col("w") * half / F.col("shards")).alias("want"),
    )
    level = materialise(level, "shard-level")
    keyed = rows.join(level.select("node", "dim"), "node").select("node", "size", "id_hash", _key(F.col("dim")).alias("value"))
    near = F.lit(TOLERANCE) * F.greatest(F.lit(1.0), F.col("want") / F.col("half"))
    low, high = F.col("want") - F.col("before") <= near, F.col("before") + F.col("here") - F.col("want") <= near
    cut = level.join(_borders(keyed, "value", KEY_BITS, level.select("node", "want")).drop("want"), "node")
    cut = materialise(
        cut.select("node", "dim", "want", "before", (~low & ~high).alias("split"), F.when(~low & high, F.col("v") + 1).otherwise(F.col("v")).alias("key")),
        "shard-cuts",
    )
    tied = cut.where("split").select("node", (F.col("want") - F.col("before")).alias("want"), "key")
    if tied.isEmpty():
        return cut.select("node", "dim", "key", F.lit(0).cast("long").alias("id_key"))
    copies = keyed.join(tied.select("node", "key"), "node").where("value = key").select("node", "size", "id_hash")
    ids = _borders(copies, "id_hash", ID_BITS, tied.select("node", "want")).select("node", (F.col("v") + 1).alias("id_key"))
    return materialise(cut.join(ids, "node", "left").select("node", "dim", "key", F.coalesce("id_key", F.lit(0)).alias("id_key")), "shard-cuts")


def kd_tree(slim: DataFrame, shards: int) -> DataFrame:
    """``slim`` (``measured``) with ``node``, the shard of each row; the tree grows a level of nodes at a time.

    A node is named by its first shard. A level's borders are a table of a row
    per node, joined to the rows by its checked size, and the rows' new nodes
    are written down, so neither plans nor the driver grow with the tree.
    """
    ends = slim.agg(*(f(d).alias(f"{n}_{d}") for d in DIMS for n, f in (("lo", F.min), ("hi", F.max)))).first()
    scaled = []
    for d in DIMS:
        lo, hi = ends[f"lo_{d}"] or 0.0, ends[f"hi_{d}"] or 0.0
        unit = (F.col(d) - F.lit(lo)) / F.lit(hi - lo) if hi > lo else F.lit(0.0)
        scaled.append(F.floor(unit * F.lit((1 << 20) - 1)).cast("long").alias(d))
    start = [F.lit(0).cast("long").alias("node"), F.lit(shards).cast("long").alias("shards")]
    rows = materialise(slim.select("doc_id", "size", "text_crc32", "id_hash", *scaled, *start), "shard-grid")
    widest = shards  # shards of the level's largest node
    while widest > 1:
        key = _key(F.col("dim"))
        before = (key < F.col("key")) | ((key == F.col("key")) & (F.col("id_hash") < F.col("id_key")))
        half = F.expr("shards div 2")
        leaf, left = F.col("shards") <= 1, F.coalesce(before, F.lit(True))
        node = F.when(leaf | left, F.col("node")).otherwise(F.col("node") + half)
        size = F.when(leaf, F.col("shards")).when(left, half).otherwise(F.col("shards") - half)
        kept = [c for c in rows.columns if c not in ("node", "shards")]
        rows = materialise(rows.join(_cuts(rows), "node", "left").select(*kept, node.alias("node"), size.alias("shards")), "shard-grid")
        widest -= widest // 2
    return rows


def kd_shards(
    docs: DataFrame, shards: int | None = None, target_bytes: int | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard``; give ``shards`` or ``target_bytes`` of a shard."""
    slim = materialise(measured(docs, id_col, text_col), "shard-rows")
    total, n = slim.agg(F.sum("size"), F.count(F.lit(1))).first()
    if shards is None:
        shards = max(1, -(-(total or 0) // target_bytes))
    put = materialise(kd_tree(slim, shards).select("doc_id", "size", "text_crc32", F.col("node").alias("shard")), "shard-placed")
    slots = ranked(put, ["shard"], ["doc_id", "text_crc32", "size"], bucket_count(n), "slot")
    return slots.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"), "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
