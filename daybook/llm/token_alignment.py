"""Cross-tokenizer alignment by inverted pair bitmaps.

Two tokenizers cut the same bytes (a blank and the text): A is a byte-level
vocabulary, B a SentencePiece model, which adds the blank itself. Byte offsets
where both have a token's end cut the text into groups; the two tokens that
end there are linked.

1. Each task encodes its documents and numbers them inside blocks (at most
   65,536 documents and ``BLOCK_LINKS`` links or one document). A block's links
   are kept inverted: for each pair of ids a compressed bitmap of the block's
   documents that link it, and one bitmap for each binary digit of how often
   they link it beyond once (multiplicity planes). A bitmap is a sorted list of
   16-bit numbers, or 8 KB of bits from 4,096 documents on. Bitmaps of parts of
   a block are merged by OR. All rows are written to the shared folder.
2. Document counts of a pair are popcounts of its bitmaps, link counts those
   of documents and planes weighted by two's powers: an aggregate of bit counts
   which runs in Spark without moving any bitmap.
3. Bitmaps meet their pair's link count (a join that Spark may split: a pair
   that all documents hold has one row a block), and their postings return
   it, block by block, to the documents, where counts are added up.

Defined results: texts that are null or empty, or whose tokens' bytes differ
from the blank and the text (one that holds U+2581, say), have no tokens: zeros
and an empty string in place of a digest. Strings of control tokens inside
texts are plain text. Rows repeat as they come, also with equal or null ids; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.llm import packing, sentencepiece_bpe
from daybook.llm.common import materialise, slices

BLOCK_DOCS = 1 << 16
BLOCK_LINKS = 3_000_000  # links a block may hold before it is closed: some 100 MB while it is sorted
DENSE = 4096  # documents from which a bitmap is kept as bits
BITS = BLOCK_DOCS // 8
CACHE_WORDS = 600_000  # words a worker remembers; emptied beyond that
CACHE_CHARS = 64  # longer ones aren't remembered
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"  # fixed values: Unicode's white space


# One word's or text's alignment: A's and B's tokens, groups as text (None: other bytes than the text's), linked pairs
# (A id, B id in 32 bits each) as bytes.
Aligned = tuple[int, int, str | None, bytes]


def joined(parts: list[Aligned]) -> Aligned:
    n_a, n_b, groups, pairs = zip(*parts, strict=True)
    return sum(n_a), sum(n_b), None if None in groups else ";".join(groups), b"".join(pairs)


class Words(dict):
    """Alignments of words after ``lead``, found once."""

    def __init__(self, owner: Aligner, lead: str):
        self.owner, self.lead = owner, lead

    def __missing__(self, word: str) -> Aligned:
        own = self.owner
        if "\n" in word:
            first, *rest = own.lines.split(word)
            if rest:
                return joined([self[first], *(x for w in rest for x in (own.line, own.bare[w]))])
        if len(word) > 1 and word[-1] in ".,!?;:" and word[-2].isalpha() and word[-2:] not in own.b.together:
            found = joined([self[word[:-1]], own.bare[word[-1]]])  # a letter and a sign are one token in neither
        else:
            found = own.align(self.lead + word)
        if len(word) <= CACHE_CHARS:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[word] = found
        return found


class Aligner:
    """Alignments of whole texts.

    Neither tokenizer joins a blank to a character before it that isn't white
    space, nor a single line break to its neighbours, so texts are cut there.
    Tokens' bytes joined are the text's by the way both are made, but for B's
    mark of blanks inside a text, which stands for a blank, and unknown ids.
    """

    def __init__(self, a_path: str, b_path: str):
        self.a = packing.encoder(a_path).merge.__self__
        self.b = sentencepiece_bpe.model(b_path)
        self.a_size = [len(self.a.decode_single_token_bytes(i)) for i in range(self.a.n_vocab)]
        self.b_size = {i: len(p.replace(sentencepiece_bpe.BLANK, " ").encode()) for i, p in self.b.text.items()} | dict.fromkeys(self.b.raw, 1)
        self.cuts = re.compile(f"(?<=[^{WHITE}]) ")
        self.lines = re.compile(f"(?<=[^{WHITE}])\n(?=[^{WHITE}])") if self.b.lines else re.compile(r"(?!)")
        self.spaced, self.bare = Words(self, " "), Words(self, "")
        self.line = self.align("\n")

    def align(self, raw: str) -> Aligned:
        """The alignment of ``raw`` as it stands, no blank added."""
        a = self.a.encode_ordinary(raw)
        b = self.b.ids_of(raw.replace(" ", sentencepiece_bpe.BLANK))
        if sentencepiece_bpe.BLANK in raw or self.b.unknown in b:
            return 0, 0, None, b""
        a_size, b_size, groups, pairs = self.a_size, self.b_size, [], array("q")
        left, start, a_end, b_end, k = 0, 0, 0, 0, -1
        for n, i in enumerate(a):
            a_end += a_size[i]
            while b_end < a_end:
                k += 1
                b_end += b_size[b[k]]
            if b_end == a_end:
                own_a = str(i) if left == n else ",".join(map(str, a[left : n + 1]))
                groups.append(f"{own_a}|{b[k]}" if start == k else f"{own_a}|{','.join(map(str, b[start : k + 1]))}")
                pairs.append(i << 32 | b[k])
                left, start = n + 1, k + 1
        return len(a), len(b), ";".join(groups), pairs.tobytes()

    def text(self, text: str) -> Aligned:
        """The alignment of a whole text after a blank; zeros and no group if it has no tokens."""
        if not text or sentencepiece_bpe.BLANK in text:
            return 0, 0, None, b""
        words = text.split()
        single = len(" ".join(words)) == len(text) and text.count(" ") + text.count("\n") == len(words) - 1
        # with single blanks and line breaks between words every blank is a cut
        found = joined(list(map(self.spaced.__getitem__, text.split(" ") if single else self.cuts.split(text))))
        return found if found[2] is not None else (0, 0, None, b"")


@lru_cache(maxsize=2)
def aligner(a_path: str, b_path: str) -> Aligner:
    return Aligner(a_path, b_path)


class Block:
    """Links of a block's documents, inverted."""

    def __init__(self) -> None:
        self.docs = self.links = 0
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def add(self, places: list[int], pairs: list[bytes]) -> None:
        """One part: each document's place in the block and its linked pairs."""
        sizes = np.array([len(p) // 8 for p in pairs], np.int64)
        pair = np.frombuffer(b"".join(pairs), np.int64)
        place = np.repeat(np.array(places, np.int64), sizes)
        distinct, code = np.unique(pair, return_inverse=True)
        key, times = np.unique(code.astype(np.int64) << 16 | place, return_counts=True)
        self.parts.append((distinct[key >> 16], (key & 0xFFFF).astype(np.uint16), times.astype(np.int32)))
        self.links += len(pair)

    def bitmaps(self) -> Iterator[tuple[np.ndarray, int, np.ndarray, np.ndarray]]:
        """``(pairs, plane, bounds, places)``: each plane's sorted places, from bounds[k] to bounds[k + 1] those of pairs[k].

        Plane -1 holds all documents of a pair; plane k those whose number of
        links less one has the k-th binary digit. Parts hold other documents
        each, so their bitmaps are merged by OR.
        """
        if not self.parts:
            return
        pair, place, times = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        order = np.lexsort((place, pair))
        pair, place, more = pair[order], place[order], times[order] - 1
        for plane in range(-1, int(more.max(initial=0)).bit_length()):
            at = slice(None) if plane < 0 else np.flatnonzero(more >> plane & 1)
            p = pair[at]
            first = np.flatnonzero(np.r_[True, p[1:] != p[:-1]]) if len(p) else np.zeros(0, np.int64)
            yield p[first], plane, np.r_[first, len(p)], place[at]


def packed(bounds: np.ndarray, places: np.ndarray):
    """Bitmaps as an Arrow array: sorted 16-bit numbers, or bits where there are many."""
    import pyarrow as pa

    sizes = np.diff(bounds)
    dense = np.flatnonzero(sizes >= DENSE)
    if not len(dense):
        return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer((2 * bounds).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(places))])
    out = []
    for k in range(len(sizes)):
        own = places[bounds[k] : bounds[k + 1]]
        if sizes[k] >= DENSE:
            bits = np.zeros(BLOCK_DOCS, np.uint8)
            bits[own] = 1
            out.append(np.packbits(bits, bitorder="little").tobytes())
        else:
            out.append(own.tobytes())
    return pa.array(out, pa.binary())


def places_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places of bitmaps that lie one after the other in ``data``, and how many each has."""
    sizes = np.diff(offsets)
    if not (sizes == BITS).any():
        return data[offsets[0] : offsets[-1]].view(np.uint16) if len(sizes) else np.zeros(0, np.uint16), sizes // 2
    out = []
    for lo, hi in zip(offsets[:-1], offsets[1:], strict=True):
        out.append(np.flatnonzero(np.unpackbits(data[lo:hi], bitorder="little")).astype(np.uint16) if hi - lo == BITS else data[lo:hi].view(np.uint16))
    return np.concatenate(out), np.array([len(x) for x in out])


def popcount(bits: Column) -> Column:
    return F.when(F.length(bits) == BITS, F.bitmap_count(bits)).otherwise(F.length(bits) / 2).cast("long")


DOC_FIELDS = ["n_a", "n_b", "n_groups", "n_links"]


def inverted(docs: DataFrame, a_path: str, b_path: str, id_col: str, text_col: str) -> DataFrame:
    """Rows of two kinds: ``doc_id, place, n_a, ..., groups_sha256`` of documents, ``pair, plane, bits`` of pairs; both with ``block``."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    schema = T.StructType(
        [
            T.StructField("doc_id", rows.schema["doc_id"].dataType),
            T.StructField("block", T.LongType()),
            T.StructField("place", T.IntegerType()),
            *(T.StructField(n, T.LongType()) for n in DOC_FIELDS),
            T.StructField("groups_sha256", T.StringType()),
            T.StructField("pair", T.LongType()),
            T.StructField("plane", T.IntegerType()),
            T.StructField("bits", T.BinaryType()),
        ]
    )

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        from pyspark.sql.pandas.types import to_arrow_schema

        own, out_schema = aligner(a_path, b_path), to_arrow_schema(schema)
        base = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 32
        block, number = Block(), 0

        def rows_of(n: int, **cols) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([cols[f.name].cast(f.type) if f.name in cols else pa.nulls(n, f.type) for f in out_schema], schema=out_schema)

        def close() -> Iterator:
            for pair, plane, bounds, places in block.bitmaps():
                for lo in range(0, len(pair), 1 << 16):
                    hi = min(lo + (1 << 16), len(pair))
                    part = bounds[lo : hi + 1]
                    bits = packed(part - part[0], places[part[0] : part[-1]])
                    n = hi - lo
                    yield rows_of(n, block=pa.array(np.full(n, base + number)), pair=pa.array(pair[lo:hi]), plane=pa.array(np.full(n, plane, np.int32)), bits=bits)

        for b in slices(batches, 256):
            cols: dict[str, list] = {n: [] for n in (*DOC_FIELDS, "groups_sha256", "place", "block")}
            places, pairs = [], []
            for text in b.column(1).to_pylist():
                n_a, n_b, names, linked = own.text(text)
                if block.docs >= BLOCK_DOCS or block.links + sum(map(len, pairs)) // 8 + len(linked) // 8 > BLOCK_LINKS and block.docs:
                    if places:
                        block.add(places, pairs)
                        places, pairs = [], []
                    yield from close()
                    block, number = Block(), number + 1
                groups = len(linked) // 8
                for n, v in zip(DOC_FIELDS, (n_a, n_b, groups, groups), strict=True):
                    cols[n].append(v)
                cols["groups_sha256"].append("" if names is None else hashlib.sha256(names.encode()).hexdigest())
                cols["place"].append(block.docs)
                cols["block"].append(base + number)
                if linked:
                    places.append(block.docs)
                    pairs.append(linked)
                block.docs += 1
            if places:
                block.add(places, pairs)
            yield rows_of(b.num_rows, doc_id=b.column(0), **{n: pa.array(v, pa.string() if n == "groups_sha256" else pa.int64()) for n, v in cols.items()})
        yield from close()

    return rows.mapInArrow(run, schema)


def pair_counts(bitmaps: DataFrame) -> DataFrame:
    """``pair, n_docs, n_links, best`` over all documents; best: no pair of the same B id has more links."""
    n = popcount(F.col("bits"))
    counts = bitmaps.groupBy("pair").agg(
        F.sum(F.when(F.col("plane") < 0, n).otherwise(0)).alias("n_docs"),
        F.sum(F.when(F.col("plane") < 0, n).otherwise(F.expr("shiftleft(1L, plane)") * n)).alias("n_links"),
    )
    high = counts.groupBy(F.col("pair").bitwiseAND(0xFFFFFFFF).alias("b")).agg(F.max("n_links").alias("high"))
    return counts.join(high, counts["pair"].bitwiseAND(0xFFFFFFFF) == high["b"]).select("pair", "n_docs", "n_links", (F.col("n_links") == F.col("high")).alias("best"))


def returned(scored: DataFrame) -> DataFrame:
    """``block, place, n_best, count_sum`` from bitmaps with their pair's ``n_links`` and ``best``."""
    schema = "block long, place int, n_best long, count_sum long"

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        block, total, best = None, np.zeros(BLOCK_DOCS, np.int64), np.zeros(BLOCK_DOCS, np.int64)

        def out() -> Iterator:
            at = np.flatnonzero(total)
            if block is not None and len(at):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), block)), pa.array(at.astype(np.int32)), pa.array(best[at]), pa.array(total[at])], names=["block", "place", "n_best", "count_sum"])

        for b in slices(batches, 1 << 16):
            if not b.num_rows:
                continue
            blocks = b.column(0).to_numpy()
            times = np.left_shift(1, np.maximum(b.column(1).to_numpy(), 0)).astype(np.int64)
            counts, good, bits = b.column(3).to_numpy(), b.column(4).to_numpy(zero_copy_only=False), b.column(2)
            offsets = np.frombuffer(bits.buffers()[1], np.int32)[bits.offset : bits.offset + len(bits) + 1]
            data = np.frombuffer(bits.buffers()[2], np.uint8)
            cuts = np.r_[0, np.flatnonzero(blocks[1:] != blocks[:-1]) + 1, len(blocks)]
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                if blocks[lo] != block:
                    yield from out()
                    block = int(blocks[lo])
                    total[:], best[:] = 0, 0
                places, sizes = places_of(data, offsets[lo : hi + 1])
                weight = np.repeat(times[lo:hi] * counts[lo:hi], sizes)
                # sums of doubles below 2^53 are exact: high and low halves apart
                for part, shift in ((weight >> 24, 24), (weight & 0xFFFFFF, 0)):
                    total += np.bincount(places, part, BLOCK_DOCS).astype(np.int64) << shift
                best += np.bincount(places, np.repeat(times[lo:hi] * good[lo:hi], sizes), BLOCK_DOCS).astype(np.int64)
        yield from out()

    rows = scored.select("block", "plane", "bits", "n_links", "best").repartition("block").sortWithinPartitions("block")
    return rows.mapInArrow(run, schema)


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every document."""
    rows = materialise(inverted(docs, a_path, b_path, id_col, text_col), "align-inverted")
    bitmaps = rows.where("bits IS NOT NULL").select("block", "pair", "plane", "bits")
    counts = materialise(pair_counts(bitmaps), "align-counts")
    scores = returned(bitmaps.join(counts, "pair"))
    own = rows.where("bits IS NULL").select("doc_id", "block", "place", *DOC_FIELDS, "groups_sha256")
    return own.join(scores, ["block", "place"], "left").select(
        "doc_id", *DOC_FIELDS, F.coalesce("n_best", F.lit(0)).cast("long").alias("n_best"), F.coalesce("count_sum", F.lit(0)).cast("long").alias("count_sum"), "groups_sha256"
    )
