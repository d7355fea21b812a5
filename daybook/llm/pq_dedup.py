"""Near-duplicate embeddings by product quantisation.

1. Equal vectors of a label become one class (map-side combined), so copies
   are settled by counting.
2. On a bounded sample of classes (``max_train``) numpy fits coarse centroids
   and, for the residuals, a codebook per subspace. Every class is assigned to
   the inverted list of its nearest centroid and coded.
3. Each class queries the lists that can hold a neighbour: two unit vectors of
   cosine c are sqrt(2 - 2c) apart, so a list whose border with the own list is
   farther away than that holds none. These probes lose nothing.
4. Products with the coded vectors come from lookup tables per query
   (asymmetric: exact query against coded vector), in whole numbers rounded
   towards a link. The angle between a vector and what its code stands for is
   known, and a neighbour's angle to the latter is at most larger by that of
   the wanted cosine, so a cut there loses nothing either; what passes is
   ranked again by exact cosine, in double precision wherever single precision
   could err.
5. The lists of a label, one after the other, are cut into blocks of a bounded
   size, so a hot list or label is spread over tasks. Two blocks meet in one
   task, each unordered pair of vectors once, and a vector is sent to a block
   once, however many of its lists it queries; one that queries no list of a
   block isn't sent there. A pair of blocks returns link counts and a spanning
   forest of its links, never all pairs; connected components follow on the
   forests.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components, and vectors without a label, link with nothing and are their own
component; vectors of different length never link; rows repeated with the same
id and vector count as other vectors of it; a null id takes part, and a
component of null ids only has a null id; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import cached_property

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.llm.common import components, materialise, slices, trimmed

MAX_TRAIN = 20_000  # classes that the quantisers are fitted on
LIST_SIZE, MAX_LISTS = 400, 1024  # wanted classes of a label in a list; centroids at most
SUBSPACES, CODES = 8, 32
ROUNDS = 12
BLOCK_BYTES = 32 << 20  # of a block's vectors; a task holds two blocks
QUERIES, CODED = 256, 1024  # queries and coded vectors whose table products are held at once
LINKS = 1 << 18  # links held before they are counted and joined to the forest
SLACK = 1e-6  # for rounding


def nearest(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared distances of all rows to all centroids, and the nearest centroid."""
    d = np.maximum((x * x).sum(1)[:, None] - 2 * x @ c.T + (c * c).sum(1), 0)
    return d, d.argmin(1)


def k_means(x: np.ndarray, k: int, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(ROUNDS):
        at = np.concatenate([nearest(x[lo : lo + 2048], c)[1] for lo in range(0, len(x), 2048)])
        n = np.bincount(at, minlength=len(c))
        sums = np.zeros_like(c)
        np.add.at(sums, at, x)
        c[n > 0] = sums[n > 0] / n[n > 0, None]
    return c


class Quantiser:
    """Coarse centroids and residual codebooks of unit vectors."""

    def __init__(self, x: np.ndarray, lists: int):
        self.dim = x.shape[1]
        self.coarse = k_means(x, lists, 1)
        at = np.concatenate([nearest(x[lo : lo + 2048], self.coarse)[1] for lo in range(0, len(x), 2048)])
        m = min(SUBSPACES, self.dim)
        self.parts = [slice(p[0], p[-1] + 1) for p in np.array_split(np.arange(self.dim), m)]
        self.books = [k_means(x[:, p] - self.coarse[:, p][at], CODES, 2 + k) for k, p in enumerate(self.parts)]
        # no partial sum of a unit vector's table products is longer than this, so scaled ones fit 16 bits
        most = math.sqrt((self.coarse**2).sum(1).max()) + math.sqrt(sum((b * b).sum(1).max() for b in self.books))
        self.scale = 32_000 / max(most, 1e-3)

    def code(self, x: np.ndarray, at: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the residuals, and the least table product of a query whose cosine with the vector is ``cosine`` or more."""
        rest = x - self.coarse[at]
        codes = np.column_stack([nearest(rest[:, p], b)[1] for p, b in zip(self.parts, self.books, strict=True)]).astype(np.uint8)
        back = self.coarse[at] + np.concatenate([b[codes[:, k]] for k, b in enumerate(self.books)], axis=1)
        along = (x * back).sum(1)
        angle = np.arctan2(np.sqrt(((back - along[:, None] * x) ** 2).sum(1)), along) + math.acos(min(1.0, max(-1.0, cosine)))
        cut = np.sqrt((back * back).sum(1)) * np.cos(np.minimum(angle, np.pi)) - SLACK
        # each of the products summed is off by half a unit at most
        return codes, np.clip(np.floor(cut * self.scale - (len(self.books) + 1) / 2), -32_768, 32_767).astype(np.int16)

    @cached_property
    def between(self) -> np.ndarray:
        """Distances of the centroids, 1 of each to itself."""
        d = np.sqrt(nearest(self.coarse, self.coarse)[0])
        np.fill_diagonal(d, 1.0)
        return d

    def probes(self, x: np.ndarray, radius: float) -> np.ndarray:
        """For each row and list whether it can hold a neighbour within ``radius``; the own list always can."""
        d, own = nearest(x, self.coarse)
        # distance of x to the plane between its own centroid and another one
        plane = (d - d[np.arange(len(x)), own][:, None]) / (2 * np.maximum(self.between[own], 1e-12))
        return plane <= radius + SLACK

    def tables(self, x: np.ndarray) -> list[np.ndarray]:
        """Products of each query with each centroid, and per subspace with each code, scaled; a query's are a column."""
        books = [self.coarse @ x.T, *(b @ x[:, p].T for p, b in zip(self.parts, self.books, strict=True))]
        return [np.rint(t * self.scale).astype(np.int16) for t in books]


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect what the links (a, b) connect, one per node at most: smallest label spreads."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    far = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[far], nodes[label[far]]


def unit(raw: np.ndarray, dim: int) -> np.ndarray:
    """Unit vectors in double precision; shorter vectors get zeros, as they only meet their like."""
    x = np.zeros((len(raw), dim))
    x[:, : raw.shape[1]] = raw
    x /= np.abs(x).max(1)[:, None]
    x /= np.sqrt((x * x).sum(1))[:, None]
    return x


class Block:
    """Vectors of a block in the order of their lists; ``at`` are their rows in the columns, ``raw`` the matrices of a chunked column."""

    def __init__(self, q: Quantiser, at, raw, ids, size, lists, codes, cuts):
        order = at[np.argsort(lists[at], kind="stable")]
        self.dim, self.raw, self.order = q.dim, raw, order
        self.starts = np.cumsum([0, *(len(m) for m in raw)])
        self.ids, self.size, self.lists = ids[order], size[order].astype(np.float64), lists[order]
        self.codes, self.cuts = np.ascontiguousarray(codes[order].T), cuts[order]
        self.units = np.empty((len(order), q.dim), np.float32)
        for lo in range(0, len(order), 4096):
            self.units[lo : lo + 4096] = self.exact(slice(lo, lo + 4096))

    def __len__(self) -> int:
        return len(self.order)

    def exact(self, at) -> np.ndarray:
        rows = self.order[at]
        chunk, x = np.searchsorted(self.starts, rows, side="right") - 1, np.empty((len(rows), self.raw[0].shape[1]))
        for k in np.unique(chunk):
            here = chunk == k
            x[here] = self.raw[k][rows[here] - self.starts[k]]
        return unit(x, self.dim)


def links_in(q: Quantiser, ask: Block, base: Block, cosine: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links of ``ask`` with ``base``, exact, as index pairs in parts; of a block with itself each pair once."""
    radius = math.sqrt(max(0.0, 2 - 2 * cosine))
    err = SLACK + (q.dim + 8) * 1.2e-7  # more than single precision can be off
    for lo in range(0, len(ask), QUERIES):
        x = ask.exact(slice(lo, lo + QUERIES))
        n, first = len(x), lo if ask is base else 0
        asked = q.probes(x, radius).any(0)
        tables, single = q.tables(x), ask.units[lo : lo + QUERIES]
        near = np.flatnonzero(asked[base.lists[first:]]) + first
        total, term = np.empty((CODED, n), np.int16), np.empty((CODED, n), np.int16)
        for at in range(0, len(near), CODED):
            y = near[at : at + CODED]
            s, t = total[: len(y)], term[: len(y)]
            np.take(tables[0], base.lists[y], axis=0, out=s, mode="clip")
            for table, codes in zip(tables[1:], base.codes, strict=True):
                np.take(table, codes[y], axis=0, out=t, mode="clip")
                np.add(s, t, out=s)
            hit = np.flatnonzero(s >= base.cuts[y][:, None])
            if len(hit) > s.size // 16:  # many pass: all products at once are cheaper than pair by pair
                product = (base.units[y] @ single.T).ravel()
                hit = np.flatnonzero(product >= cosine - err)
                product = product[hit]
                j, i = np.divmod(hit, n)
            else:
                j, i = np.divmod(hit, n)
                product = np.einsum("ij,ij->i", single[i], base.units[y[j]])
            i, j = i + lo, y[j]
            good = product >= cosine + err
            unsure = np.flatnonzero(~good & (product >= cosine - err))
            for k in range(0, len(unsure), 4096):
                u = unsure[k : k + 4096]
                good[u] = np.einsum("ij,ij->i", ask.exact(i[u]), base.exact(j[u])) >= cosine
            if ask is base:
                good &= j > i
            if good.any():
                yield i[good], j[good]


def linked(q: Quantiser, ask: Block, base: Block, cosine: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids that have links, the vectors linked to each, and the id its forest edge leads to (its own: none)."""
    same = ask is base
    ids = ask.ids if same else np.concatenate([ask.ids, base.ids])
    root, n, off = np.arange(len(ids)), np.zeros(len(ids)), 0 if same else len(ask)
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def settled() -> None:
        nonlocal root
        x, y = (np.concatenate(v) for v in zip(*held, strict=True))
        n[: len(ask)] += np.bincount(x, base.size[y], len(ask))
        n[off:] += np.bincount(y, ask.size[x], len(base))
        a, b = root[x], root[y + off]
        far, to = forest(a[a != b], b[a != b])
        moved = np.arange(len(ids))
        moved[far] = to
        root = moved[root]
        held.clear()

    for pair in links_in(q, ask, base, cosine):
        held.append(pair)
        if sum(len(x) for x, _ in held) >= LINKS:
            settled()
    if held:
        settled()
    some = n > 0
    return ids[some], n[some].astype(np.int64), ids[root[some]]


def width(vectors: DataFrame, vector_col: str) -> str:
    """Single precision is kept as it is; all else is read in double precision."""
    return "f4" if vectors.select(vector_col).schema[0].dataType.simpleString() == "array<float>" else "f8"


def usable(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """``vec_id, label, dim, cid, vector``: ``cid`` names a label's vector, null where the row links with nothing; ``vector`` are its bytes."""
    v = F.col(vector_col)
    if width(vectors, vector_col) == "f8":
        v = v.cast("array<double>")
    read = vectors.select(F.col(id_col).alias("vec_id"), F.col(label_col).cast("string").alias("label"), v.alias("vector"))

    def named(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in slices(batches):
            given, labels = b.column("vector"), b.column("label").to_pylist()
            at = given.offsets.to_numpy()
            flat = given.values[at[0] : at[-1]].fill_null(math.nan).to_numpy(zero_copy_only=False)
            at = at - at[0]
            count = lambda yes: np.concatenate([[0], np.cumsum(yes)])[at]
            bad, some = np.diff(count(~np.isfinite(flat))), np.diff(count(flat != 0))
            good = (bad == 0) & (some > 0) & given.is_valid().to_numpy(zero_copy_only=False)
            data = [flat[at[k] : at[k + 1]].tobytes() if good[k] and name is not None else None for k, name in enumerate(labels)]
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("vec_id"),
                    pa.array([None if d is None else name for name, d in zip(labels, data, strict=True)], pa.string()),
                    pa.array([None if d is None else len(d) // flat.itemsize for d in data], pa.int32()),
                    pa.array([None if d is None else hashlib.blake2b(f"{len(name)}|{name}|".encode() + d, digest_size=16).digest() for name, d in zip(labels, data, strict=True)], pa.binary()),
                    pa.array(data, pa.binary()),
                ],
                ["vec_id", "label", "dim", "cid", "vector"],
            )

    fields = (("label", T.StringType()), ("dim", T.IntegerType()), ("cid", T.BinaryType()), ("vector", T.BinaryType()))
    schema = T.StructType([T.StructField("vec_id", read.schema["vec_id"].dataType), *(T.StructField(*f) for f in fields)])
    return read.mapInArrow(named, schema)


def _matrix(column, kind: str) -> np.ndarray:
    """The numbers of a binary array without nulls, whose values have one length, a row for each; not copied."""
    at = np.frombuffer(column.buffers()[1], np.int64 if str(column.type) == "large_binary" else np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[at[0] : at[-1]].view(kind).reshape(len(column), -1)


def near_duplicates(
    vectors: DataFrame, cosine: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", max_train: int = MAX_TRAIN
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row."""
    kind = width(vectors, vector_col)
    rows = materialise(usable(vectors, id_col, vector_col, label_col).withColumn("node", F.monotonically_increasing_id()), "pq-rows")
    classes = rows.where("cid IS NOT NULL").groupBy("cid", "label", "dim").agg(
        F.min("node").alias("node"), F.count(F.lit(1)).alias("size"), F.min("vec_id").alias("first_id")
    )
    classes = materialise(classes, "pq-classes")
    stats = classes.agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("rows"), F.approx_count_distinct("label").alias("labels"), F.max("dim").alias("dim")).first()
    none = classes.select("node", F.lit(0).cast("long").alias("n"), F.col("node").alias("component")).limit(0)
    found = _searched(_members(rows, classes, stats), stats, kind, cosine, max_train) if stats["n"] else none
    named = classes.join(found, "node", "left").select("cid", "size", "first_id", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("component", "node").alias("component"))
    low = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = named.join(low, "component").select("cid", (F.col("n") + F.col("size") - 1).alias("n_links"), "component_id")
    out = rows.select("vec_id", "cid").join(named, "cid", "left")
    component = F.when(F.col("cid").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.cast("long").alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )


def _members(rows: DataFrame, classes: DataFrame, stats) -> DataFrame:
    """``node, cid, kind, dim, size, vector`` of each class; without repeated vectors the rows are the classes."""
    some = rows.where("cid IS NOT NULL")
    if stats["rows"] > stats["n"]:
        twice = classes.where("size > 1").select("cid", F.col("node").alias("lowest"), "size")
        some = some.join(twice, "cid", "left").where("lowest IS NULL OR lowest = node")
    else:
        some = some.withColumn("size", F.lit(1))
    some = some.select("node", "cid", F.concat_ws("|", "label", "dim").alias("kind"), "dim", F.coalesce("size", F.lit(1)).cast("long").alias("size"), "vector")
    return materialise(some, "pq-members") if stats["rows"] > stats["n"] else some


class Layout:
    """Blocks of the kinds that are too large for one: the lists one after the other, cut into ``k`` even parts."""

    def __init__(self, k: int, sizes: np.ndarray):
        self.k, self.sizes, self.total = k, sizes, int(sizes.sum())
        self.start = np.cumsum(sizes) - sizes
        low, high = self.at(self.start), self.at(self.start + sizes)
        self.holds = (np.arange(k) >= low[:, None]) & (np.arange(k) <= high[:, None])  # an empty list's place too: a tie may fall to it in another batch

    def at(self, place: np.ndarray) -> np.ndarray:
        return np.minimum(place * self.k / self.total, self.k - 1).astype(np.int64)

    def block(self, lists: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        """A list's classes are dealt by hash over the blocks that it lies in."""
        u = (nodes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(11)) / float(1 << 53)
        return self.at(self.start[lists] + u * self.sizes[lists])


def _searched(members: DataFrame, stats, kind: str, cosine: float, max_train: int) -> DataFrame:
    """``node, n, component``: vectors of other classes linked directly, and the smallest class reachable."""
    spark, dim = members.sparkSession, stats["dim"]
    pick = members.where(F.pmod(F.xxhash64("cid"), F.lit(1 << 30)) < F.lit(int((1 << 30) * min(1.0, max_train / stats["n"]))))
    train = pick.select("cid", "vector").collect() or members.select("cid", "vector").limit(1).collect()
    sample = np.empty((len(train), dim))
    for k, r in enumerate(sorted(train, key=lambda r: bytes(r["cid"]))):
        sample[k] = unit(np.frombuffer(r["vector"], kind)[None], dim)
    lists = int(min(MAX_LISTS, max(1, stats["n"] // (LIST_SIZE * max(1, stats["labels"])))))
    del train
    quantiser = Quantiser(sample, lists)
    del sample
    sent = spark.sparkContext.broadcast(quantiser)  # centroids and codebooks: MAX_LISTS + CODES rows of a vector's size
    radius = math.sqrt(max(0.0, 2 - 2 * cosine))

    def units(b) -> np.ndarray:
        import pyarrow as pa

        x, lengths = np.empty((b.num_rows, dim)), b.column("dim").to_numpy()
        for d in np.unique(lengths):
            at = np.flatnonzero(lengths == d)
            x[at] = unit(_matrix(b.column("vector").take(pa.array(at)), kind), dim)
        return x

    def counted(batches: Iterator) -> Iterator:
        import pandas as pd
        import pyarrow as pa

        for b in slices(batches):
            own = nearest(units(b), sent.value.coarse)[1]
            n = pd.DataFrame({"kind": b.column("kind").to_pandas(), "list": own.astype(np.int32)}).value_counts().rename("n").reset_index()
            yield pa.RecordBatch.from_pandas(n, preserve_index=False)

    # kinds that need several blocks, fewer than there are blocks
    held = F.count(F.lit(1)) * F.col("dim") * np.dtype(kind).itemsize
    several = members.groupBy("kind", "dim").agg(held.alias("bytes")).where(F.col("bytes") > BLOCK_BYTES)
    large = {r["kind"]: -(-r["bytes"] // BLOCK_BYTES) for r in several.collect()}
    layouts = {}
    if large:
        sizes = {k: np.zeros(len(quantiser.coarse), np.int64) for k in large}
        of = members.select("kind", "dim", "vector").join(F.broadcast(several.select("kind")), "kind", "left_semi").mapInArrow(counted, "kind string, list int, n long")
        for r in of.groupBy("kind", "list").agg(F.sum("n").alias("n")).collect():
            sizes[r["kind"]][r["list"]] = r["n"]
        layouts = {k: Layout(large[k], n) for k, n in sizes.items()}
    placed = spark.sparkContext.broadcast(layouts)  # for each large kind a number per list and block

    def dealt(batches: Iterator) -> Iterator:
        """A class once for each block that holds a list it queries; in (a, b) ``later`` are those of b, if not a."""
        import pyarrow as pa

        q, layouts = sent.value, placed.value
        for b in slices(batches):
            if not b.num_rows:
                continue
            x, kinds, nodes = units(b), np.array(b.column("kind").to_pylist(), object), b.column("node").to_numpy()
            own = nearest(x, q.coarse)[1]
            codes, cuts = q.code(x, own, cosine)
            here = {k: np.flatnonzero(kinds == k) for k in set(kinds) & set(layouts)}
            block, asks = np.zeros(len(x), np.int64), np.zeros((len(x), max([1, *(layouts[k].k for k in here)])), bool)
            asks[:, 0] = True
            for k, at in here.items():
                block[at] = layouts[k].block(own[at], nodes[at])
                asks[at, : layouts[k].k] = q.probes(x[at], radius).astype(np.float32) @ layouts[k].holds.astype(np.float32) > 0
            coded = [pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(cuts), pa.array(own.astype(np.int32))]
            whole = pa.RecordBatch.from_arrays([b.column("kind"), b.column("node"), b.column("size"), *coded, b.column("vector")], ["kind", "node", "size", "codes", "cut", "list", "vector"])
            for j in range(asks.shape[1]):
                at = np.flatnonzero(asks[:, j])
                if len(at):
                    places = (np.minimum(block[at], j), np.maximum(block[at], j))
                    part = whole.take(pa.array(at))
                    yield pa.RecordBatch.from_arrays([*(pa.array(p.astype(np.int32)) for p in places), pa.array(block[at] > j), *part.columns], ["a", "b", "later", *part.schema.names])

    schema = "a int, b int, later boolean, kind string, node long, size long, codes binary, cut short, list int, vector binary"

    def block(table):
        import pyarrow as pa

        q, later, same = sent.value, table["later"].to_numpy(), table["a"][0].as_py() == table["b"][0].as_py()
        parts = lambda c, kind: [_matrix(a, kind) for a in table[c].chunks if len(a)]
        columns = [parts("vector", kind), *(table[c].to_numpy() for c in ("node", "size", "list")), np.concatenate(parts("codes", "u1")), table["cut"].to_numpy()]
        found = (np.zeros(0, np.int64),) * 3
        if same or 0 < later.sum() < len(later):
            ask = Block(q, np.flatnonzero(~later), *columns)
            found = linked(q, ask, ask if same else Block(q, np.flatnonzero(later), *columns), cosine)
            del ask
        if len(later) > 1024:
            trimmed()
        return pa.table([pa.array(v) for v in found], ["node", "n", "to"])

    got = members.select("kind", "dim", "node", "size", "vector").mapInArrow(dealt, schema)
    got = materialise(got.groupBy("kind", "a", "b").applyInArrow(block, "node long, n long, to long"), "pq-links")
    counts = got.groupBy("node").agg(F.sum("n").alias("n"))
    comp = components(got.where("to <> node").select(F.col("node").alias("a"), F.col("to").alias("b")), "pq-cc")
    return counts.withColumnRenamed("node", "_id").join(comp, F.col("_id") == F.col("node"), "left").select(F.col("_id").alias("node"), "n", F.coalesce("component", "_id").alias("component"))
