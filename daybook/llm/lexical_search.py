"""Ranked lexical search over document FP-trees.

For each item the documents of highest score, where a term's weight is
w = floor(1000 ln((2N + 2) / (2 df + 1))), a document's length measure is
m = 100 - B + ((B n N) div L) with B = 50, and the score sums
w * ((10^9 tf) div (1000 tf + 20 m)) over the item's distinct terms.

1. Items are taken in blocks of a bounded number of terms, so what a task holds
   of them is bounded however many there are. For a block every document is
   read once and cut down to its *restricted vector*: (term, tf) of the block's
   terms. The vectors, with the documents' lengths, are written to the shared
   folder; N, L and df are aggregates over them.
2. Tasks take some thousand vectors at a time. For an item, their terms among
   the item's, most frequent in the corpus first, are paths of a trie: sorted
   by the terms they hold, documents below one node lie next to each other.
   For each term the largest tf below a node, and the smallest m, give an upper
   bound of the scores below it, since a score grows with tf and falls with m.
   The trie is searched depth first, best bound first; nodes whose bound is
   below the item's k-th best score so far are left out with all below them.
3. That k-th score starts from the one among a sample of the documents, which
   is a lower bound of the true one, so nothing is lost by it. Equal scores are
   never left out before ids decide.
4. Each task returns at most k rows an item; Spark ranks these.

Defined results: null texts have no terms, as have texts without a letter or
digit; documents without a term don't count in N; rows repeated with the same
id are documents of their own; null ids come last among equal scores; items
that share an id are one item with all their terms; items without terms, or
with none that a document holds, give no rows; empty tables give an empty
result; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.llm.common import materialise, slices

TOP = 50
B = 50
ITEM_TERMS = 1_000_000  # distinct (item, term) pairs in a block of items
BLOCK_DOCS = 8192  # vectors whose tries a task holds at a time
CELLS = 1 << 22  # and of these at most so many (vector, item term) cells
LEAF_PATHS = 16  # below so many distinct paths documents are scored at once
DEPTH = 63  # terms that part paths; further ones of an item count in bounds and scores alike
SAMPLE_DOCS = 20_000  # the least sample that first bounds come from
# What terms consist of, on UTF-8 bytes with A-Z lower-cased and as a pattern of characters.
TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
TERM_CHARS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Distinct ``item_id, term``."""
    lower = F.translate(F.coalesce(F.col(text_col), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    terms = F.explode(F.regexp_extract_all(lower, F.lit(TERM_CHARS), F.lit(0)))
    return items.select(F.col(id_col).alias("item_id"), terms.alias("term")).distinct()


def vectors(docs: DataFrame, terms: list[str], id_col: str, text_col: str) -> DataFrame:
    """``doc_id, n, terms, tfs``: a document's number of terms, and its restricted vector."""
    place = {t.encode(): k for k, t in enumerate(terms)}
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ints = T.ArrayType(T.IntegerType(), False)
    schema = T.StructType([T.StructField("doc_id", rows.schema["doc_id"].dataType), T.StructField("n", T.LongType()), T.StructField("terms", ints), T.StructField("tfs", ints)])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        from pyspark.sql.pandas.types import to_arrow_schema

        out_schema, found, known = to_arrow_schema(schema), TERM.findall, place.get
        for b in slices(batches, 1024):
            sizes, ks, tfs, bounds = [], [], [], [0]
            for text in b.column(1).to_pylist():
                words = found(text.encode().lower())  # bytes lower A-Z alone
                counts = Counter(map(known, words))
                counts.pop(None, None)
                sizes.append(len(words))
                ks.extend(counts.keys())
                tfs.extend(counts.values())
                bounds.append(len(ks))
            at = pa.array(bounds, pa.int32())
            lists = [pa.ListArray.from_arrays(at, pa.array(v, pa.int32())) for v in (ks, tfs)]
            yield pa.RecordBatch.from_arrays([b.column(0).cast(out_schema.field(0).type), pa.array(sizes, pa.int64()), *(x.cast(f.type) for x, f in zip(lists, list(out_schema)[2:], strict=True))], schema=out_schema)

    return rows.mapInArrow(run, schema)


def gain(tf: np.ndarray, m: np.ndarray | int) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


class Best:
    """An item's k best documents so far."""

    def __init__(self, top: int, floor: int):
        self.top, self.least, self.rows = top, max(floor, 1), []  # rows: (score, id)

    def add(self, scores: np.ndarray, ids: Iterator) -> None:
        self.rows.extend(zip(scores.tolist(), ids, strict=True))
        if len(self.rows) >= 4 * self.top:
            self.cut()

    def cut(self) -> None:
        self.rows.sort(key=lambda x: (-x[0], x[1] is None, x[1]))
        del self.rows[self.top :]
        if len(self.rows) == self.top:
            self.least = max(self.least, self.rows[-1][0])


class Tries:
    """Restricted vectors of some documents, by term."""

    def __init__(self, ids: list, m: np.ndarray, sizes: np.ndarray, terms: np.ndarray, tfs: np.ndarray, n_terms: int):
        self.ids, self.m = ids, m
        order = np.argsort(terms, kind="stable")
        self.rows = np.repeat(np.arange(len(ids)), sizes)[order]
        self.tfs = tfs[order].astype(np.int64)
        self.bounds = np.searchsorted(terms[order], np.arange(n_terms + 1))

    def search(self, terms: np.ndarray, weights: np.ndarray, best: Best) -> None:
        """Put the item's best documents into ``best``; ``terms`` are the item's, most frequent first."""
        step = max(1, CELLS // max(1, len(terms)))
        for lo in range(0, len(self.ids), step):
            self.trie(terms, weights, best, lo, min(lo + step, len(self.ids)))

    def trie(self, terms: np.ndarray, weights: np.ndarray, best: Best, lo: int, hi: int) -> None:
        tf = np.zeros((len(terms), hi - lo), np.int64)
        for k, t in enumerate(terms):
            rows, tfs = self.rows[self.bounds[t] : self.bounds[t + 1]], self.tfs[self.bounds[t] : self.bounds[t + 1]]
            if lo or hi < len(self.ids):
                a, b = np.searchsorted(rows, (lo, hi))
                rows, tfs = rows[a:b] - lo, tfs[a:b]
            tf[k, rows] = tfs
        depth = min(len(terms), DEPTH)
        path = np.zeros(hi - lo, np.int64)  # a binary digit for each term, the most frequent one highest
        for k in range(depth):
            path |= (tf[k] > 0).astype(np.int64) << (depth - 1 - k)
        order = np.argsort(path, kind="stable")
        if not tf[depth:].any():
            order = order[np.searchsorted(path[order], 1) :]  # those with none of the terms
        if not len(order):
            return
        path, tf, m = path[order], tf[:, order], self.m[lo:hi][order]
        starts = np.flatnonzero(np.r_[True, path[1:] != path[:-1]])
        ends = np.r_[starts[1:], len(path)]
        paths, most, least_m = path[starts], np.maximum.reduceat(tf, starts, axis=1), np.minimum.reduceat(m, starts)
        column = weights[:, None]
        bound = int((weights * gain(most.max(axis=1), least_m.min())).sum())
        stack = [(bound, 0, 0, len(paths))]  # bound, terms decided, and the paths below a node
        while stack:
            bound, done, a, b = stack.pop()
            if bound < best.least:
                continue
            if b - a <= LEAF_PATHS or done >= depth:
                s, e = starts[a], ends[b - 1]
                scores = (column * gain(tf[:, s:e], m[s:e])).sum(axis=0)
                at = np.flatnonzero(scores >= best.least)
                best.add(scores[at], (self.ids[lo + order[s + k]] for k in at))
                continue
            # children: the next term that a path holds; paths are sorted, so those of a child lie together
            prefix = paths[a] >> (depth - done) << (depth - done) if done else 0
            heads = prefix + (np.int64(1) << np.arange(depth - done, dtype=np.int64))  # of the last term first
            cuts = np.r_[a, a + np.searchsorted(paths[a:b], heads), b]
            kids = np.flatnonzero(cuts[1:] > cuts[:-1])
            first = cuts[kids]
            tops = (column * gain(np.maximum.reduceat(most[:, a:b], first - a, axis=1), np.minimum.reduceat(least_m[a:b], first - a))).sum(axis=0)
            for k in np.argsort(tops, kind="stable"):  # the best bound is popped first
                kid = int(kids[k])
                # kid 0 holds no further term; kid j holds the one whose digit is depth - done - j from the left
                stack.append((int(tops[k]), depth if kid == 0 else depth - kid + 1, int(cuts[kid]), int(cuts[kid + 1])))


def search(vecs: DataFrame, items: list[tuple[object, np.ndarray, np.ndarray]], n_terms: int, measure: tuple[int, int], top: int, floors: dict[int, int], kind: T.DataType) -> DataFrame:
    """``item, item_id, doc_id, score``: each task's ``top`` best of each item, none below the item's floor."""
    schema = T.StructType([T.StructField("item", T.IntegerType()), T.StructField("item_id", kind), T.StructField("doc_id", vecs.schema["doc_id"].dataType), T.StructField("score", T.LongType())])
    docs, total = measure

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        from pyspark.sql.pandas.types import to_arrow_schema

        out_schema = to_arrow_schema(schema)
        found = [Best(top, floors.get(k, 0)) for k in range(len(items))]

        def take(held: list) -> None:
            table = pa.Table.from_batches(held).combine_chunks()
            n = table.column("n").to_numpy()
            m = 100 - B + (B * n * docs) // total
            lists = table.column("terms").combine_chunks()
            tfs = table.column("tfs").combine_chunks()
            sizes = lists.value_lengths().to_numpy()
            tries = Tries(table.column("doc_id").to_pylist(), m, sizes, lists.flatten().to_numpy(), tfs.flatten().to_numpy(), n_terms)
            for best, (_, terms, weights) in zip(found, items, strict=True):
                tries.search(terms, weights, best)
                best.cut()

        held, rows = [], 0
        for b in slices(batches, BLOCK_DOCS):
            if rows and rows + b.num_rows > BLOCK_DOCS:
                take(held)
                held, rows = [], 0
            if b.num_rows:
                held.append(b)
                rows += b.num_rows
        if rows:
            take(held)
        out = [(k, items[k][0], i, s) for k, best in enumerate(found) for s, i in best.rows]
        for lo in range(0, len(out), 1 << 16):
            cols = list(zip(*out[lo : lo + (1 << 16)], strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, out_schema, strict=True)], schema=out_schema)

    return vecs.select("doc_id", "n", "terms", "tfs").mapInArrow(run, schema)


def ranked(rows: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def block_search(docs: DataFrame, pairs: list, kind: T.DataType, top: int, id_col: str, text_col: str) -> DataFrame | None:
    """``item_id, rank, doc_id, score`` for the items of a block, given as (item_id, term)."""
    names = sorted({t for _, t in pairs})
    vecs = materialise(vectors(docs, names, id_col, text_col), "search-vectors")
    n, total = vecs.where("n > 0").agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    # at most ITEM_TERMS rows
    df = {r["t"]: r["df"] for r in vecs.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df")).collect()}
    place = {t: k for k, t in enumerate(names)}
    held: dict = {}
    for i, t in pairs:
        if place[t] in df:
            held.setdefault(i, []).append(place[t])
    items = []
    for i, ks in held.items():
        ks.sort(key=lambda k: (-df[k], k))  # names are sorted: equal frequencies in the order of terms
        items.append((i, np.array(ks, np.int64), np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * df[k] + 1))) for k in ks], np.int64)))
    if not items:
        return None
    at = (vecs, items, len(names), (n, total), top)
    sample, floors = max(SAMPLE_DOCS, 40 * math.isqrt(n)), {}
    if n > 2 * sample:
        some = vecs.where(F.pmod(F.xxhash64("doc_id", "n", "terms"), F.lit(1 << 20)) < (sample << 20) // n)
        first = ranked(search(some, *at[1:], {}, kind), top)
        floors = {r["item"]: r["score"] for r in first.where(F.col("rank") == top).select("item", "score").collect()}  # a row an item
    return ranked(search(*at, floors, kind), top).select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def lexical_search(docs: DataFrame, items: DataFrame, top: int = TOP, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", block_terms: int = ITEM_TERMS) -> DataFrame:
    """``item_id, rank, doc_id, score``: each item's ``top`` documents of highest score above 0, equal scores by id."""
    terms = materialise(item_terms(items, item_col, item_text), "search-items")
    kind = terms.schema["item_id"].dataType
    blocks = max(1, -(-terms.count() // block_terms))
    found = None
    for k in range(blocks):
        own = terms if blocks == 1 else terms.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == k)
        part = block_search(docs, [tuple(r) for r in own.select("item_id", "term").collect()], kind, top, id_col, text_col)
        if part is not None:
            found = part if found is None else found.unionByName(part)
    if found is None:
        schema = T.StructType([T.StructField("item_id", kind), T.StructField("rank", T.IntegerType()), T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("score", T.LongType())])
        return docs.sparkSession.createDataFrame([], schema)
    return found

