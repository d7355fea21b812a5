"""Exact deduplication with a heavy-hitter split (DataFrame operations only).

1. One pass over the texts leaves a narrow table: id, code points, SHA-256 of
   the text without white space. It is written to the shared folder.
2. A Misra-Gries summary (Spark's frequent-items sketch: a bounded number of
   counters, merged by slice and then once more) names the frequent digests.
   At most ``heavy`` of them are used, whatever the corpus size.
3. The rows of those digests are counted exactly, with map-side combining, and
   their verified winners (at most one row per full digest) are broadcast:
   copies of hot texts are settled map-side and never meet in one task.
4. The remaining digests are shuffled once, by digest.

Defined results: a null text counts as empty, and all texts of white space
only form one group; of equal texts the row with the most code points stays,
then the smallest id, ids that are null last. Rows repeated with the same id
and text all count in ``group_size`` and share one decision, so every repeat
of the winner is marked kept (``drop_copies`` leaves one). Empty tables give
empty results; other columns are never touched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.common import bucket_of, materialise

WHITE = " \t\n\x0b\x0c\r"  # [\x20\x09-\x0D]


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_code, digest)`` of every row: code points and SHA-256 of the normalised text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    norm = F.translate(text, WHITE, "")
    return docs.select(
        F.col(id_col).alias("doc_id"),
        F.length(text).alias("n_code"),
        F.unhex(F.sha2(norm.cast("binary"), 256)).alias("digest"),
    )


def frequent(slim: DataFrame, counters: int, heavy: int, slices: int) -> DataFrame:
    """At most ``heavy`` digest prefixes seen more than once, from Misra-Gries summaries of ``counters`` counters."""
    prefix = F.hex(F.substring("digest", 1, 8))
    part = slim.select(prefix.alias("p"), bucket_of("doc_id", buckets=slices).alias("slice"))
    part = part.groupBy("slice").agg(F.expr(f"approx_top_k_accumulate(p, {counters})").alias("s"))
    # grouped, as an ungrouped merge also starts a summary, without a type, in every empty partition
    one = part.groupBy((F.col("slice") * 0).alias("all")).agg(F.expr(f"approx_top_k_combine(s, {counters})").alias("s"))
    items = one.select(F.explode(F.expr(f"approx_top_k_estimate(s, {heavy})")).alias("x"))
    return items.where("x.count > 1").select(F.col("x.item").alias("p"))


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = 2048, heavy: int = 512, slices: int = 64
) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256`` (see module text)."""
    slim = materialise(digests(docs, id_col, text_col), "exact-digests")
    if slim.isEmpty():
        hot = slim.select(F.lit("").alias("p")).limit(0)
    else:
        hot = materialise(frequent(slim, counters, heavy, slices), "exact-frequent")
    keyed = slim.withColumn("p", F.hex(F.substring("digest", 1, 8)))
    best = F.min(F.struct((-F.col("n_code")).alias("n"), F.col("doc_id").isNull().alias("z"), F.col("doc_id").alias("id")))
    winners = (
        keyed.join(F.broadcast(hot), "p", "left_semi")  # hot: at most `heavy` rows
        .groupBy("digest")
        .agg(F.count(F.lit(1)).alias("group_size"), best.alias("w"))
        .select("digest", "group_size", F.col("w.id").alias("keep_id"))
    )
    winners = materialise(winners, "exact-winners")
    settled = keyed.join(F.broadcast(winners), "digest").select("doc_id", "n_code", "digest", "keep_id", "group_size")
    rest = keyed.join(F.broadcast(hot), "p", "left_anti")
    group = Window.partitionBy("digest")
    first = group.orderBy(F.col("n_code").desc(), F.col("doc_id").asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    rest = rest.select(
        "doc_id",
        "n_code",
        "digest",
        F.first("doc_id").over(first).alias("keep_id"),
        F.count(F.lit(1)).over(first).alias("group_size"),
    )
    return settled.unionByName(rest).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, one per group of equal texts, with their own columns (of any names).

    What goes is decided on (id, digest) rows. Texts are only joined with the
    few that go or repeat: where Spark finds those small, no text is shuffled,
    else each once, and only where rows repeat once more for these. Repeats of
    a staying row (same id, equal text) are merged with map-side combining: the
    longest stays, of those the greatest text.
    """
    names = docs.columns
    flat = docs.toDF(*(f"c{k}" for k in range(len(names))))
    own_id, own_text = (f"c{names.index(c)}" for c in (id_col, text_col))
    decided = exact_dedup(docs, id_col, text_col).groupBy(F.col("doc_id").alias("on_id"), F.col("text_sha256").alias("on_sha"))
    decided = decided.agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n"))
    special = materialise(decided.where("NOT kept OR n > 1").select("on_id", "on_sha", "kept"), "exact-special")
    text = F.coalesce(F.col(own_text), F.lit(""))
    marked = flat.withColumn("sha", F.sha2(F.translate(text, WHITE, "").cast("binary"), 256))
    same = marked[own_id].eqNullSafe(F.col("on_id")) & (F.col("sha") == F.col("on_sha"))
    single = marked.join(special.select("on_id", "on_sha"), same, "left_anti").select(*flat.columns)
    if special.where("kept").isEmpty():  # else Spark would shuffle all texts before it sees that none are asked for
        return single.toDF(*names)
    repeats = marked.join(special.where("kept"), same, "left_semi")
    one = repeats.groupBy(own_id, "sha").agg(F.max_by(F.struct(*flat.columns), F.struct(F.length(text), text)).alias("row"))
    return single.unionByName(one.select("row.*")).toDF(*names)
