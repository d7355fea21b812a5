"""Jaccard self-join on word shingles by universe partition and pigeonhole.

Two sets with J >= 0.8 whose smaller one has n members differ in at most
H(n) = n // 4 of them. The hashed shingles ("the universe") are partitioned
into segments, by size band. If the wanted differences of the segments, v + 1
each, sum to more than H(n), some segment must differ in at most v members:

* v = 0: both sets have the same subset of the segment;
* v = 1: their subsets differ by one deletion at most, so each set also
  indexes its one-deletion neighbourhood.

How many segments a band has and which of them get v = 1 is decided by cost,
from the sizes of all sets: index rows plus expected false candidates. A match
on two empty subsets says nothing, so it isn't indexed; instead the sums carry
some slack, and a set with more empty subsets than the slack repeats its index
under further partitions, the last of which indexes empty subsets too. A pair
can only be missed under a partition if both of its sets are such, hence none
is missed.

Flow: (1) one pass over the texts leaves a row per document: set size, set id,
two short profiles; equal sets become one class. (2) A second pass emits index
rows (signature, class), shuffled once; only signatures of two or more
classes are kept. (3) Each class is verified against the most similar-looking
leader (smallest class) of its signatures: linear in the index, however large
a group of near copies is. (4) Only pairs that share a signature and are still
in different components are verified one by one, after exact lower bounds by
size and both profiles, which the task that pairs them applies itself. A signature of more than ``CELL`` sets is cut into cells,
and each pair of cells that may hold such a pair is a task's work of its own.
At first a task only names pairs that would join its components, fewer than it
has sets; the sets of all its other pairs are kept by signature, and the pairs
of them that are still apart after that verification are verified one by one.
Verification ships the two texts and compares whole sets.
Hashes have 64 bits; equal hashes count as equal shingles and sets.

Defined results: null, empty and white-space texts have no shingles and link
with nothing; fewer than five words are one shingle; rows that share an id
count as one document; a row without id has a null component; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.common import components, materialise, slices

WORDS = 5
COARSE, FINE = 256, 1024  # buckets of the profiles that bound a difference from below; powers of two
SALTS = 3  # partitions for sets with many empty subsets
RATIO = 1.5  # between the lower ends of bands; above 1.25, so a pair spans two bands at most
ALIKE = 1e-4  # share of pairs in a band taken to have half of their members in common, for the cost only
BLOCK = 256  # members verified against a leader in one group
CELL = 4096  # sets of one signature that a task compares with each other or with as many others

M1, M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)  # fixed values: a public 64-bit mixer
ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * M1
    x = (x ^ (x >> np.uint64(27))) * M2
    return x ^ (x >> np.uint64(31))


SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True  # [\x20\x09-\x0D]
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32  # A-Z only
LONG_WORD = 64  # bytes; longer words are hashed one by one


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words data[start:end], all words a byte further in each step."""
    import xxhash

    size = ends - starts
    h = size.astype(np.uint64) * ODD[4]
    at = np.flatnonzero(size <= LONG_WORD)
    for k in range(int(size[at].max(initial=0))):
        at = at[size[at] > k]
        h[at] = (h[at] + data[starts[at] + k]) * ODD[0]
    h = mix(h)
    for k in np.flatnonzero(size > LONG_WORD):
        h[k] = xxhash.xxh3_64_intdigest(data[starts[k] : ends[k]].tobytes())
    return h


def shingle_sets(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text data[bounds[k]:bounds[k+1]], and their own bounds."""
    docs = len(bounds) - 1
    base, data = bounds[0], LOWER[data[bounds[0] : bounds[-1]]]
    bounds = bounds - base
    word = ~SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1] | edge[1:-1]
    last[:-1] &= ~word[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    w = word_hashes(data, starts, ends)
    upto = np.searchsorted(starts, bounds)  # words before each text
    n = np.diff(upto)
    h = np.zeros(len(w), np.uint64)
    short = (n > 0) & (n < WORDS)
    owner = np.repeat(np.arange(docs), n)
    for k in range(WORDS):
        span = max(0, len(w) - k)
        h[:span] += w[k:] * ODD[k]
    h = mix(h + np.uint64(WORDS))
    place = np.arange(len(w)) - upto[owner]
    keep = place <= n[owner] - WORDS
    for d in np.flatnonzero(short):  # the whole sequence as one shingle
        lo, m = upto[d], n[d]
        h[lo] = mix((w[lo : lo + m] * ODD[:m]).sum(dtype=np.uint64, keepdims=True) + np.uint64(m))[0]
        keep[lo] = True
    h, owner = h[keep], owner[keep]
    count = np.bincount(owner, minlength=docs)
    at = np.concatenate([[0], np.cumsum(count)])
    for lo, hi in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        h[lo:hi].sort()
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    h, owner = h[new], owner[new]
    return h, np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=docs))])


def column_sets(column) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``shingle_sets`` of a text column, some megabytes at a time; nulls count as empty."""
    import pyarrow as pa

    column = column.fill_null("").cast(pa.large_string())
    if not len(column):
        return
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(bounds, bounds[lo] + (1 << 21), side="right")) - 1)
        yield shingle_sets(data, bounds[lo : hi + 1])
        lo = hi


def shingles(text: str | None) -> np.ndarray:
    """The sorted distinct shingle hashes of one text."""
    data = np.frombuffer((text or "").encode(), np.uint8)
    return shingle_sets(data, np.array([0, len(data)]))[0]


def set_id(s: np.ndarray) -> int:
    import xxhash

    return int(np.uint64(xxhash.xxh3_64_intdigest(s.tobytes())).view(np.int64))


def set_ids(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.array([set_id(h[lo:hi]) for lo, hi in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)], np.int64)


def profiles(h: np.ndarray, at: np.ndarray, buckets: int) -> list[bytes]:
    """Per set how many members fall into each of the buckets, modulo 16, two buckets to a byte."""
    docs = len(at) - 1
    bucket = (h >> np.uint64(65 - buckets.bit_length())).astype(np.int64)
    cell = np.repeat(np.arange(docs), np.diff(at)) * buckets + bucket
    count = (np.bincount(cell, minlength=docs * buckets) & 15).astype(np.uint8).reshape(docs, buckets)
    return [x.tobytes() for x in count[:, ::2] | count[:, 1::2] << 4]


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    if 100 * min(len(a), len(b)) < 80 * max(len(a), len(b)) or not len(a):
        return False
    inter = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * inter >= 80 * (len(a) + len(b) - inter)


@dataclass(frozen=True)
class Band:
    """Sizes lo..hi-1 and its partition; ``deep``: v of all segments."""

    number: int
    lo: int
    hi: int
    segments: int
    deep: int
    slack: int

    def used(self, n: np.ndarray) -> np.ndarray:
        """How many of the first segments sets of n members use: their sums exceed H(n) by the slack."""
        return np.minimum(-(-(n // 4 + 1 + self.slack) // (self.deep + 1)), self.segments)


def band_edges(largest: int) -> list[int]:
    edges = [4, 8, 12, 16]
    while edges[-1] <= largest:
        edges.append(math.ceil(edges[-1] * RATIO))
    return edges


def allocation(number: int, lo: int, hi: int, sets: int) -> Band:
    """The cheapest of exact and one-deletion segments, with more or less slack, for ``sets`` sets of lo..hi-1 members.

    Cost of a set: its index rows, more of them with the chance that empty
    subsets use up the slack, plus the false candidates expected of the sets
    that have half of their members in common with it.
    """
    sums, mean, options = (hi - 1) // 4 + 1, (lo + hi) / 2, []
    for deep in (1, 0):
        for slack in sorted({*range(6), *(round(sums * k / 40) for k in range(1, 25))}):
            m = -(-(sums + slack) // (deep + 1))
            lam = mean / m
            empty = m * math.exp(-lam) * (1 + lam * deep) if m > 1 else 0.0
            term = tail = math.exp(-empty)  # Poisson: chance of at most slack / (deep + 1) empty subsets
            for k in range(1, slack // (deep + 1) + 1):
                term *= empty / k
                tail += term
            risk = max(0.0, 1 - tail)
            rows = (m + deep * mean) * (1 + 2 * risk)
            false = m * math.exp(-lam) * (1 + lam * deep) * sets * ALIKE
            options.append((rows + false, deep, m, slack))
    _, deep, m, slack = min(options)
    return Band(number, lo, hi, m, deep, slack)


def bands(sizes: dict[int, int]) -> list[Band]:
    """From the number of sets of each size (rounded sizes do)."""
    edges = band_edges(max(sizes, default=0))
    ends = list(zip(edges[:-1], edges[1:], strict=True))
    return [allocation(k, lo, hi, sum(c for n, c in sizes.items() if lo <= n < hi)) for k, (lo, hi) in enumerate(ends)]


def signatures(h: np.ndarray, at: np.ndarray, plan: list[Band]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index signatures and the numbers of their sets.

    A set is indexed in its own band, and in the next one where it may be the
    smaller partner of a set there.
    """
    n = np.diff(at)
    for band in plan:
        left = np.flatnonzero((n >= band.lo) & (n < band.hi) | (n < band.lo) & (n * 5 // 4 >= band.lo))
        for salt in range(SALTS):
            if not len(left):
                break
            size, use = n[left], band.used(n[left])
            local = np.repeat(np.arange(len(left)), size)
            own = h[np.arange(size.sum()) + np.repeat(at[left] - np.cumsum(size) + size, size)]
            name = mix(np.array([band.number * 16 + salt + 1], np.uint64) * ODD[0])
            g = mix(own ^ name)
            seg = (((g >> np.uint64(32)) * np.uint64(band.segments)) >> np.uint64(32)).astype(np.int64)
            inside = seg < use[local]
            g, seg, local = g[inside], seg[inside], local[inside]
            cell, cells = local * band.segments + seg, len(left) * band.segments
            count = np.bincount(cell, minlength=cells)
            # sums modulo 2**64 from exact sums of 32-bit halves
            high, low = (np.bincount(cell, x.astype(np.float64), cells).astype(np.uint64) for x in (g >> np.uint64(32), g & np.uint64(0xFFFFFFFF)))
            sums = (high << np.uint64(32)) + low
            space = mix((np.arange(band.segments, dtype=np.uint64) + np.uint64(1)) * ODD[1] + name)
            last = salt == SALTS - 1
            used = (np.arange(band.segments) < use[:, None]).ravel()
            pick = np.flatnonzero(used if last else count > 0)
            yield mix(sums[pick] + space[pick % band.segments]), left[pick // band.segments]
            if band.deep:
                drop = np.ones(len(g), bool) if last else count[cell] > 1
                yield mix(sums[cell[drop]] - g[drop] + space[seg[drop]]), left[local[drop]]
            bare = (used & (count <= band.deep)).reshape(len(left), -1).sum(1) * (band.deep + 1)
            left = left[bare > band.slack]  # too many empty subsets: once more, under another partition


def measure(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, n, cid, coarse, fine`` of every row; ``cid`` names the set."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = rows.select("doc_id").schema.add("n", "long").add("cid", "long").add("coarse", "binary").add("fine", "binary")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in slices(batches):
            n, ids, coarse, fine = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [], []
            for h, at in column_sets(b.column(1)):
                n.append(np.diff(at))
                ids.append(set_ids(h, at))
                coarse += profiles(h, at, COARSE)
                fine += profiles(h, at, FINE)
            cols = [pa.array(np.concatenate(n)), pa.array(np.concatenate(ids)), pa.array(coarse, pa.binary()), pa.array(fine, pa.binary())]
            yield pa.RecordBatch.from_arrays([b.column(0), *cols], names=schema.names)

    return rows.mapInArrow(run, schema)


def index(docs: DataFrame, plan: list[Band], id_col: str, text_col: str) -> DataFrame:
    """``sig, cid``; a task emits a set once, however many copies it reads."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        seen: set[int] = set()
        for b in slices(batches):
            for h, at in column_sets(b.column(0)):
                ids = set_ids(h, at)
                fresh = np.zeros(len(ids), bool)
                for k in np.flatnonzero(np.diff(at) >= 4).tolist():  # smaller sets are similar only if equal
                    if ids[k] not in seen:
                        fresh[k] = True
                        seen.add(ids[k])
                if len(seen) > 500_000:
                    seen.clear()
                h, at = h[np.repeat(fresh, np.diff(at))], np.concatenate([[0], np.cumsum(np.diff(at)[fresh])])
                ids = ids[fresh]
                for sig, owner in signatures(h, at, plan):
                    yield pa.RecordBatch.from_arrays([pa.array(sig.view(np.int64)), pa.array(ids[owner])], names=["sig", "cid"])

    return docs.where(F.col(id_col).isNotNull()).select(F.col(text_col)).mapInArrow(run, "sig long, cid long")


def shared(rows: DataFrame) -> DataFrame:
    """The distinct ``(sig, cid)`` whose signature has two or more sets: one pass over sorted rows, nothing gathered."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        sig = cid = np.zeros(0, np.int64)  # rows of the last signature so far: at most the last two

        def emit(sig, cid, closed):
            first = np.r_[True, (sig[1:] != sig[:-1]) | (cid[1:] != cid[:-1])] if len(sig) else np.zeros(0, bool)
            sig, cid = sig[first], cid[first]
            near = np.r_[False, sig[1:] == sig[:-1]] if len(sig) else np.zeros(0, bool)
            both = near | np.r_[near[1:], False] if len(sig) else near
            if closed:
                return sig, cid, both, len(sig)
            # the last row waits for its successor, unless its predecessor has settled it already
            return sig, cid, both, max(0, len(sig) - 1)

        held = 0  # of the rows kept over, how many were emitted before
        for b in batches:
            s, c = (np.concatenate([k, b.column(j).to_numpy()]) for j, k in enumerate((sig, cid)))
            s, c, both, upto = emit(s, c, False)
            pick = both.copy()
            pick[:held] = False
            pick[upto:] = False
            if pick.any():
                yield pa.RecordBatch.from_arrays([pa.array(s[pick]), pa.array(c[pick])], names=["sig", "cid"])
            back = 1 if len(s) < 2 else 2
            sig, cid, held = s[-back:], c[-back:], back - 1 if len(s) > 1 else 0
        s, c, both, _ = emit(sig, cid, True)
        both[:held] = False
        if both.any():
            yield pa.RecordBatch.from_arrays([pa.array(s[both]), pa.array(c[both])], names=["sig", "cid"])

    return rows.repartition("sig").sortWithinPartitions("sig", "cid").mapInArrow(run, "sig long, cid long")


def _bounded(na, nb, pa_, pb_):
    """Where sizes and profiles leave J >= 0.8 possible: exact lower bounds of the difference.

    Two counts differ by no less than the way around between them modulo 16.
    """
    ok = 100 * np.minimum(na, nb) >= 80 * np.maximum(na, nb)
    apart = (pa_ - pb_) & 15
    gap = np.minimum(apart, 16 - apart).sum(axis=-1, dtype=np.int64)
    return ok & (9 * gap <= na + nb), gap


def _profiles(column) -> np.ndarray:
    rows = np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)
    return np.concatenate([rows & 15, rows >> 4], axis=1)


def folded(fine: np.ndarray) -> np.ndarray:
    """Coarse profiles from fine ones, whose even buckets come before the odd ones."""
    if fine.shape[1] <= COARSE:
        return fine
    half, each = fine.shape[1] // 2, FINE // COARSE // 2
    two = fine[:, :half] + fine[:, half:]
    return two.reshape(len(fine), -1, each).sum(axis=2, dtype=np.uint8) & 15


def plausible(pairs: DataFrame, classes: DataFrame, profile: str) -> DataFrame:
    """``a, b, gap`` of the pairs that the bounds by size and ``profile`` leave."""
    for side in "ab":
        pairs = pairs.join(classes.select(F.col("cid").alias(side), F.col("n").alias(f"n{side}"), F.col(profile).alias(f"p{side}")), side)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in slices(batches):
            if not b.num_rows:
                continue
            na, nb = (b.column(k).to_numpy() for k in (2, 3))
            ok, gap = _bounded(na, nb, _profiles(b.column(4)), _profiles(b.column(5)))
            keep = pa.array(ok)
            yield pa.RecordBatch.from_arrays([b.column(0).filter(keep), b.column(1).filter(keep), pa.array(gap[ok].astype(np.int64))], names=["a", "b", "gap"])

    return pairs.select("a", "b", "na", "nb", "pa", "pb").mapInArrow(run, "a long, b long, gap long")


def dealt(placed: DataFrame, classes: DataFrame, cell: int, kind: str = "coarse") -> DataFrame:
    """``sig, pair, side, cid, comp, n, profile`` (of that kind): the sets of each signature with two components, dealt to pairs of cells.

    ``placed`` has ``sig, cid, comp``, and ``n`` where it is at hand. A set without any of another component
    near its size under the signature is left out before profiles are sent.
    A signature of at most ``cell`` sets is one cell. Others are cut by size,
    so that links stay within a size or reach the next one, then by component
    where one has more than ``cell`` sets, then by hash. A cell meets itself
    (side 2) and others (sides 0 and 1), unless both belong to one component.
    """
    if "n" not in placed.columns:
        placed = placed.join(classes.select("cid", "n"), "cid")
    groups = placed.groupBy("sig").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("sets"))
    groups = groups.where("lo <> hi").select("sig", "sets")
    hot = materialise(groups.where(F.col("sets") > cell), "join-hot")
    rows = placed.join(groups.where(F.col("sets") <= cell).select("sig"), "sig")
    reach = math.ceil(math.log(1.25) * 1e6) + 1  # sizes of linked sets, as logarithms
    near = Window.partitionBy("sig").orderBy(F.floor(F.log(F.col("n").cast("double")) * 1e6)).rangeBetween(-reach, reach)
    rows = rows.withColumn("lo", F.min("comp").over(near)).withColumn("hi", F.max("comp").over(near)).where("lo <> hi")
    rows = rows.drop("n").join(classes.select("cid", "n", F.col(kind).alias("profile")), "cid")
    rows = rows.select("sig", F.lit(0).cast("long").alias("pair"), F.lit(2).alias("side"), "cid", "comp", "n", "profile")
    if hot.isEmpty():
        return rows
    size = F.floor(F.log(F.col("n").cast("double")) / math.log(RATIO)).cast("int")
    members = placed.join(hot.select("sig"), "sig").select("sig", "cid", "comp", "n", size.alias("s"))
    members = materialise(members, "join-members")
    large = members.groupBy("sig", "s", "comp").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") > cell)
    large = materialise(large.select("sig", "s", "comp", F.col("comp").alias("own")), "join-large")
    members = members.join(large, ["sig", "s", "comp"], "left").withColumn("whole", F.col("own").isNotNull()).withColumn("own", F.coalesce("own", F.lit(0).cast("long")))
    part = ["sig", "s", "whole", "own"]
    parts = materialise(members.groupBy(*part).agg(F.ceil(F.count(F.lit(1)) / F.lit(float(cell))).cast("long").alias("cells")), "join-parts")
    members = members.join(parts, part).withColumn("h", F.pmod(F.xxhash64("cid"), F.col("cells")))
    cells = parts.select(*part, F.explode(F.sequence(F.lit(0).cast("long"), F.col("cells") - 1)).alias("h"))
    one, two = (cells.select("sig", *(F.col(c).alias(c + k) for c in ("s", "whole", "own", "h"))) for k in "12")
    two = two.select("*", F.explode(F.array(F.col("s2"), F.col("s2") - 1)).alias("s1"))  # links reach the next size at most
    later = F.struct("whole1", "own1", "h1") <= F.struct("whole2", "own2", "h2")
    inside = F.col("whole1") & F.col("whole2") & (F.col("own1") == F.col("own2"))
    met = one.join(two, ["sig", "s1"]).where(((F.col("s1") < F.col("s2")) | later) & ~inside)
    name = F.xxhash64("s1", "whole1", "own1", "h1", "s2", "whole2", "own2", "h2").alias("pair")  # equal hashes only add comparisons
    same = (F.col("s1") == F.col("s2")) & (F.col("whole1") == F.col("whole2")) & (F.col("own1") == F.col("own2")) & (F.col("h1") == F.col("h2"))
    met = met.withColumn("same", same)
    at = [met.select("sig", *(F.col(c + k).alias(c) for c in ("s", "whole", "own", "h")), name, F.when(F.col("same"), 2).otherwise(side).alias("side")) for side, k in enumerate("12")]
    seats = materialise(at[0].unionByName(at[1].where("side <> 2")), "join-cells")
    members = members.join(classes.select("cid", F.col(kind).alias("profile")), "cid").join(seats, [*part, "h"])
    return rows.unionByName(members.select(rows.columns))


def across(groups: DataFrame, spanning: bool = False) -> DataFrame:
    """``a, b`` of sets that meet in ``groups`` (see ``dealt``), lie in different components and pass the bounds.

    With ``spanning`` only the pairs that would join the components that meet, nearest sets first, and
    ``sig, a`` (no ``b``) of every set with another such pair: in a group of near copies the pairs grow with
    the square of its sets, these rows don't.

    The fine profile decides inside the cell, where a coarse one made of it has
    not yet: a pair that isn't linked shares many signatures, and would be
    emitted once for each. A task holds two cells at a time: some 1.3 KB a set.
    """

    def by_size(cols):
        order = np.argsort(cols[2], kind="stable")
        return [c[order] for c in cols]

    def pairs_of(one, two):
        """Of the sets of ``one`` and ``two``: columns cid, comp, n, profile; the pairs inside ``one`` if ``two`` is None.

        Yields the ids of both, their components and the lower bound of their difference.
        """
        inner = two is None
        cid, comp, n, fine = by_size(one)
        cid2, comp2, n2, fine2 = (cid, comp, n, fine) if inner else by_size(two)
        prof = folded(fine)
        prof2 = prof if inner else folded(fine2)
        for k in range(0, len(cid), BLOCK):
            end = min(k + BLOCK, len(cid))
            lo, hi = (int(np.searchsorted(n2, x, side=side)) for x, side in ((-(-n[k] * 4 // 5), "left"), (n[end - 1] * 5 // 4, "right")))  # others can't link
            lo = max(lo, k) if inner else lo
            differ = (comp[k:end, None] != comp2[None, lo:hi]) & (100 * np.minimum(n[k:end, None], n2[None, lo:hi]) >= 80 * np.maximum(n[k:end, None], n2[None, lo:hi]))
            if inner:
                differ &= np.arange(k, end)[:, None] < np.arange(lo, hi)[None, :]
            x, y = np.nonzero(differ)
            for at in range(0, len(x), 50_000):
                xx, yy = x[at : at + 50_000] + k, y[at : at + 50_000] + lo
                ok, _ = _bounded(n[xx], n2[yy], prof[xx], prof2[yy])
                xx, yy = xx[ok], yy[ok]
                for sub in range(0, len(xx), 10_000):
                    x1, y1 = xx[sub : sub + 10_000], yy[sub : sub + 10_000]
                    ok, gap = _bounded(n[x1], n2[y1], fine[x1], fine2[y1])
                    if ok.any():
                        a, b = cid[x1[ok]], cid2[y1[ok]]
                        yield np.minimum(a, b), np.maximum(a, b), comp[x1[ok]], comp2[y1[ok]], gap[ok]

    def joining(pairs):
        """The pairs that join components not joined before, and the sets of the others, each once."""
        root: dict[int, int] = {}
        left = np.zeros(0, np.int64)

        def find(c):
            while (up := root.get(c, c)) != c:
                root[c] = c = root.get(up, up)
            return c

        for a, b, one, two, gap in pairs:
            names, at = np.unique(np.concatenate([one, two]), return_inverse=True)
            now = np.array([find(c) for c in names.tolist()], np.int64)[at].reshape(2, -1)
            pick = np.zeros(len(a), bool)
            for k in (k for k in np.lexsort((b, a, gap)).tolist() if now[0, k] != now[1, k]):
                x, y = find(int(now[0, k])), find(int(now[1, k]))
                if x != y:
                    root[max(x, y)] = min(x, y)
                    pick[k] = True
            if pick.any():
                yield a[pick], b[pick]
            left = np.unique(np.concatenate([left, a[~pick], b[~pick]]))
        if len(left):
            yield left, None

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def batch(got):
            cols = [pa.array(np.concatenate([g[j] for g in got])) for j in (0, 1)]
            return pa.RecordBatch.from_arrays([pa.nulls(len(cols[0]), pa.int64()), *cols] if spanning else cols, names=names)

        rest: tuple | None = None
        got: list = []
        for b in _and_end(batches):
            if b is None:
                done, rest = rest, None
            else:
                cols = [b.column(k).to_numpy() for k in range(6)] + [_profiles(b.column(6))]
                cols = cols if rest is None else [np.concatenate(p) for p in zip(rest, cols, strict=True)]
                cut = 0
                if len(cols[0]):  # the last pair of cells may go on
                    cut = int(np.searchsorted(cols[0], cols[0][-1]))
                    cut += int(np.searchsorted(cols[1][cut:], cols[1][-1]))
                done, rest = tuple(c[:cut] for c in cols), tuple(c[cut:] for c in cols)
            if done is None or not len(done[0]):
                continue
            edge = np.flatnonzero(np.r_[True, (done[0][1:] != done[0][:-1]) | (done[1][1:] != done[1][:-1]), True])
            for lo, hi in zip(edge[:-1], edge[1:], strict=True):
                sets = [c[lo:hi] for c in done[2:]]
                left, right, own = ([c[sets[0] == k] for c in sets[1:]] for k in (0, 1, 2))
                met = (p for x, y in ((left, right), (own, None)) if len(x[0]) for p in pairs_of(x, y))
                for pair in joining(met) if spanning else met:
                    if pair[1] is None:
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(pair[0]), done[0][lo])), pa.array(pair[0]), pa.nulls(len(pair[0]), pa.int64())], names=names)
                        continue
                    got.append(pair)
                    if len(got) >= 64 or len(pair[0]) >= 10_000:
                        yield batch(got)
                        got = []
        if got:
            yield batch(got)

    names = ["sig", "a", "b"] if spanning else ["a", "b"]
    groups = groups.repartition("sig", "pair").sortWithinPartitions("sig", "pair")
    return groups.select("sig", "pair", "side", "cid", "comp", "n", "profile").mapInArrow(run, ", ".join(f"{x} long" for x in names))


def _and_end(batches: Iterator) -> Iterator:
    yield from slices(batches, 4096)
    yield None


def verify(pairs: DataFrame, classes: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs ``(a, b)`` that are linked, by their whole texts. A leader ``a`` is sent to every block of its partners."""
    size = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / F.lit(float(BLOCK))).cast("long").alias("blocks"))
    blocks = size.select("a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"))
    members = pairs.join(size, "a").select("a", F.pmod(F.xxhash64("b"), F.col("blocks")).alias("block"), F.col("b").alias("cid"), F.lit(1).alias("role"))
    wanted = members.unionByName(blocks.select("a", "block", F.col("a").alias("cid"), F.lit(0).alias("role")))
    wanted = wanted.join(classes.select("cid", "rep"), "cid")
    sent = wanted.join(texts, F.col("rep") == F.col("t_id")).select("a", "block", "role", "cid", "text")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        key, leader = None, np.zeros(0, np.uint64)
        for b in slices(batches, 256):
            found: list[tuple[int, int]] = []
            for a, block, role, cid, text in zip(*(b.column(k).to_pylist() for k in range(5)), strict=True):
                s = shingles(text)
                if set_id(s) != cid:
                    continue  # another text under the same id
                if role == 0:
                    key, leader = (a, block), s
                elif key == (a, block) and linked(leader, s):
                    found.append((a, cid))
            yield pa.RecordBatch.from_arrays([pa.array([f[j] for f in found], pa.int64()) for j in (0, 1)], names=["a", "b"])

    return sent.repartition("a", "block").sortWithinPartitions("a", "block", "role").mapInArrow(run, "a long, b long")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row."""
    rows = materialise(measure(docs, id_col, text_col), "join-rows")
    classes = rows.where("n > 0 AND doc_id IS NOT NULL").groupBy("cid").agg(
        F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("coarse").alias("coarse"), F.first("fine").alias("fine")
    )
    classes = materialise(classes, "join-classes")
    # sizes rounded to three digits: a bounded histogram
    digits = F.greatest(F.floor(F.log10(F.col("n").cast("double"))) - 2, F.lit(0))
    rounded = (F.floor(F.col("n") / F.pow(F.lit(10.0), digits)) * F.pow(F.lit(10.0), digits)).cast("long")
    sizes = {r["s"]: r["c"] for r in classes.groupBy(rounded.alias("s")).agg(F.count(F.lit(1)).alias("c"), F.max("n").alias("m")).collect()}
    if sizes:
        sizes.setdefault(classes.agg(F.max("n")).first()[0], 0)
    plan = bands(sizes)
    groups = materialise(shared(index(docs, plan, id_col, text_col)), "join-groups")
    texts = docs.select(F.col(id_col).alias("t_id"), F.col(text_col).alias("text"))

    lead = groups.groupBy("sig").agg(F.min("cid").alias("a"))
    stars = groups.join(lead, "sig").where("a <> cid").select("a", F.col("cid").alias("b")).distinct()
    stars = plausible(plausible(stars, classes, "coarse").select("a", "b"), classes, "fine")
    best = stars.groupBy("b").agg(F.min("gap").alias("gap"), F.min_by("a", F.col("gap")).alias("a"))
    first = materialise(best.select("a", "b"), "join-stars")
    links = materialise(verify(first, classes, texts), "join-links")

    def placed(groups: DataFrame) -> DataFrame:
        comp = components(links, "join-cc").select(F.col("node").alias("cid"), F.col("component").alias("comp"))
        sized = classes.select("cid", "n").join(comp, "cid", "left").select("cid", "n", F.coalesce("comp", "cid").alias("comp"))
        return groups.join(sized, "cid").select("sig", "cid", "comp", "n")

    def untried(pairs: DataFrame) -> DataFrame:
        # written first: Spark would move the join below the distinct, to a row for each signature of a pair
        return materialise(materialise(pairs.select("a", "b").distinct(), "join-pairs").join(tried, ["a", "b"], "left_anti"), "join-rest")

    tried = first.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    some = materialise(across(dealt(placed(groups), classes, CELL, "fine"), spanning=True), "join-spanning")
    rest = untried(some.where("b IS NOT NULL"))
    links = links.unionByName(materialise(verify(rest, classes, texts), "join-links"))
    left = some.where("b IS NULL").select("sig", F.col("a").alias("cid")).distinct()
    if not left.isEmpty():
        tried = tried.unionByName(rest)
        rest = untried(across(dealt(placed(left), classes, CELL, "fine")))
        links = links.unionByName(materialise(verify(rest, classes, texts), "join-links"))

    # rows that share an id are one document: their sets are one component
    same = rows.where("n > 0 AND doc_id IS NOT NULL").select("doc_id", "cid").distinct()
    many = same.groupBy("doc_id").agg(F.min("cid").alias("a"), F.max("cid").alias("z")).where("a <> z").select("doc_id", "a")
    links = links.unionByName(same.join(many, "doc_id").select("a", F.col("cid").alias("b")).where("a <> b"))
    comp = components(links, "join-cc")
    whole = classes.join(comp, classes["cid"] == comp["node"], "left").select("cid", "rep", F.coalesce("component", "cid").alias("comp"))
    name = whole.groupBy("comp").agg(F.min("rep").alias("component_id"))
    named = materialise(whole.join(name, "comp").select("cid", "component_id"), "join-named")
    out = rows.select("doc_id", "n", "cid").join(named, "cid", "left")
    component = F.when(F.col("n") > 0, F.when(F.col("doc_id").isNotNull(), F.col("component_id"))).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


def one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` of which one stays per group: the smallest id. Rows without shingles stay."""
    stays = jaccard_components(docs, id_col, text_col).where("doc_id <=> component_id").select(F.col("doc_id").alias("_stays")).distinct()
    return docs.join(stays, docs[id_col].eqNullSafe(stays["_stays"]), "left_semi")
