"""Temperature mixing of sources (DataFrame operations only).

Weights are token shares raised to an exponent: w_s = p_s^a / sum p^a. The
exponent is bisected to ``LEVELS`` binary places, to the largest one whose
weights still reach a target entropy (a fraction of the entropy of equal
weights), or to the smallest one under which no source is read more than
``max_epochs`` times as often as the largest one; of both, the repetition
limit goes first. Each pass aggregates the midpoints of several bisection
levels over the source table at once; only those sums reach the driver.

The weights are realised as budgeted block permutations. Documents fall into
hashed blocks of about ``block_tokens`` tokens within their source. A source
whose budget is f whole epochs and a rest gets f permutations of all its
blocks, and of one more permutation the prefix that the rest pays for; the
block on that border is filled document by document, in hash order, while the
budget is not exceeded. Prefix sums run over blocks, and over documents only
inside border blocks (one per source), so a hot source is never sorted whole.

Without a budget the largest source is read exactly once and the others more
often, by their weights: no document is left out.

Tokens of a document: its words plus one. Defined results: a null source is a
source of its own, a null or empty text has one token, rows repeated with the
same id and text are scheduled each on their own, an empty table gives an
empty schedule, other columns pass through untouched.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.common import materialise

LEVELS = 20  # binary places of the exponent
PER_PASS = 5  # bisection levels whose midpoints one aggregation tests


def source_key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("s:"), source.cast("string")), F.lit("null"))


def n_tokens(text: Column) -> Column:
    return (F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")) + 1).cast("long")


def _place(text: Column) -> Column:
    """28 hash bits of a text, the same in any engine."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 7), 16, 10).cast("long")


def _meets(sums: DataFrame, target_entropy: float | None, max_epochs: float | None, ks: list[int], stats: dict) -> dict[int, bool]:
    """For exponents k / 2**LEVELS: whether the wanted property holds. Bounded rows reach the driver."""
    grid = F.explode(F.array(*(F.lit(k) for k in ks))).alias("k")
    e = sums.select("tokens", grid).withColumn("p", F.col("tokens") / F.lit(float(stats["total"])))
    z = F.pow("p", F.col("k") / F.lit(float(2**LEVELS)))
    rows = e.groupBy("k").agg(F.sum(z).alias("z"), F.sum(z * F.log("p")).alias("zl")).collect()
    out = {}
    for r in rows:
        a = r["k"] / 2**LEVELS
        if target_entropy is not None:
            h = math.log(r["z"]) - a * r["zl"] / r["z"]
            out[r["k"]] = h >= target_entropy * math.log(stats["n"]) - 1e-12
        else:
            out[r["k"]] = (stats["low"] / stats["high"]) ** (a - 1) > max_epochs
    return out


def exponent(sums: DataFrame, target_entropy: float | None, max_epochs: float | None, stats: dict) -> float:
    """Largest k / 2**LEVELS in [0, 1] whose entropy reaches the target, or smallest that keeps the repetition limit."""
    if stats["n"] < 2 or stats["low"] == stats["high"]:
        return 1.0
    lo, width = 0, 2**LEVELS  # the property holds at lo and fails from lo + width on
    ends = _meets(sums, target_entropy, max_epochs, [0, width], stats)
    if target_entropy is not None and ends[width]:
        return 1.0
    if not ends[0]:
        return 0.0
    while width > 1:
        step = max(1, width >> PER_PASS)
        ks = list(range(lo + step, lo + width, step))
        ok = _meets(sums, target_entropy, max_epochs, ks, stats)
        while width > step:  # the bisection proper, over the tested midpoints
            width //= 2
            lo = lo + width if ok[lo + width] else lo
    return (lo if target_entropy is not None else lo + 1) / 2**LEVELS


def mix(
    docs: DataFrame,
    target_entropy: float | None = None,
    max_epochs: float | None = None,
    budget_tokens: int | None = None,
    block_tokens: int = 1 << 22,
    seed: str = "mix",
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """The columns of ``docs`` with a struct ``_mix``, one row per scheduled reading of a document.

    ``_mix``: n_tokens, epoch, block, slot (place of the block in that epoch's
    permutation), start (tokens of the source's stream before the block),
    budget (tokens of the source) and exponent.
    """
    if target_entropy is None and max_epochs is None:
        raise ValueError("give target_entropy, max_epochs or both")
    id_text = F.coalesce(F.col(id_col).cast("string"), F.lit("null"))
    keyed = docs.select(
        F.struct(*(F.col(c) for c in docs.columns)).alias("row"),
        source_key(F.col(source_col)).alias("skey"),
        n_tokens(F.col(text_col)).alias("n_tokens"),
        F.md5(F.concat(F.lit(f"{seed}:"), id_text).cast("binary")).alias("u"),
    )
    sums = materialise(keyed.groupBy("skey").agg(F.sum("n_tokens").alias("tokens")), "mix-sources")
    s = sums.agg(F.sum("tokens").alias("total"), F.count(F.lit(1)).alias("n"), F.min("tokens").alias("low"), F.max("tokens").alias("high")).first()
    if not s["n"]:
        return docs.withColumn("_mix", _mix_struct(*(F.lit(0) for _ in range(6)), F.lit(0.0))).limit(0)
    wanted = [(target_entropy, None)] * (target_entropy is not None) + [(None, max_epochs)] * (max_epochs is not None)
    a = max(exponent(sums, h, r, s.asDict()) for h, r in wanted)
    if budget_tokens is None:
        share = F.col("tokens") * F.pow(F.col("tokens") / F.lit(float(s["high"])), F.lit(a - 1))
    else:
        z = sums.agg(F.sum(F.pow(F.col("tokens") / F.lit(float(s["total"])), F.lit(a)))).first()[0]
        share = F.lit(float(budget_tokens)) * F.pow(F.col("tokens") / F.lit(float(s["total"])), F.lit(a)) / F.lit(z)
    plan = materialise(
        sums.withColumn("budget", F.floor(share).cast("long"))
        .withColumn("full", F.expr("budget div tokens"))
        .withColumn("rest", F.expr("budget % tokens"))
        .withColumn("blocks", F.ceil(F.col("tokens") / F.lit(float(block_tokens))).cast("long")),
        "mix-plan",
    )
    placed = keyed.join(plan.select("skey", "blocks"), "skey").withColumn(
        "block", _place(F.concat(F.lit(f"{seed}:block:"), F.col("u"))) % F.col("blocks")
    )
    sizes = materialise(placed.groupBy("skey", "block").agg(F.sum("n_tokens").alias("block_size")), "mix-blocks")

    # one permutation of a source's blocks per epoch, the last one for the rest
    name = F.concat_ws(":", F.lit(seed), "skey", F.col("epoch").cast("string"), F.col("block").cast("string"))
    turns = sizes.join(plan.drop("blocks"), "skey").withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("full"))))
    turns = turns.withColumn("order", F.md5(name.cast("binary")))
    perm = Window.partitionBy("skey", "epoch").orderBy("order")
    turns = turns.withColumn("slot", (F.row_number().over(perm) - 1).cast("long")).withColumn(
        "before", F.coalesce(F.sum("block_size").over(perm.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    )
    whole = (F.col("epoch") < F.col("full")) | (F.col("before") + F.col("block_size") <= F.col("rest"))
    turns = turns.where((F.col("epoch") < F.col("full")) | (F.col("before") < F.col("rest"))).select(
        "skey", "block", "epoch", "slot", "budget",
        (F.col("epoch") * F.col("tokens") + F.col("before")).alias("start"),
        F.when(whole, F.lit(None).cast("long")).otherwise(F.col("rest") - F.col("before")).alias("pays"),
    )
    turns = materialise(turns, "mix-schedule")
    extra = _mix_struct(*(F.col(c) for c in ("n_tokens", "epoch", "block", "slot", "start", "budget")), F.lit(a)).alias("_mix")
    taken = placed.join(turns.where("pays is null"), ["skey", "block"]).select("row", extra)
    border = placed.join(turns.where("pays is not null"), ["skey", "block"])
    inner = Window.partitionBy("skey", "epoch", "block").orderBy("u", "n_tokens", F.xxhash64(f"row.`{text_col}`"))
    paid = border.withColumn("paid", F.sum("n_tokens").over(inner.rowsBetween(Window.unboundedPreceding, 0)))
    paid = paid.where("paid <= pays").select("row", extra)
    return taken.unionByName(paid).select("row.*", "_mix")


def _mix_struct(n_tokens, epoch, block, slot, start, budget, exponent) -> Column:
    longs = {"n_tokens": n_tokens, "epoch": epoch, "block": block, "slot": slot, "start": start, "budget": budget}
    return F.struct(*(c.cast("long").alias(k) for k, c in longs.items()), exponent.cast("double").alias("exponent"))


def schedule(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """``doc_id, source`` and the fields of ``_mix`` per scheduled reading; see ``mix``."""
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(source_col).alias("source"))
    return mix(narrow, **options).select("doc_id", "source", "_mix.*")


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, each as often as scheduled; its columns may have any names."""
    names = docs.columns
    own = {k: f"c{names.index(options.pop(k, d))}" for k, d in (("id_col", "doc_id"), ("text_col", "text"), ("source_col", "source"))}
    flat = docs.toDF(*(f"c{k}" for k in range(len(names))))
    return mix(flat, **own, **options).select(*flat.columns).toDF(*names)
