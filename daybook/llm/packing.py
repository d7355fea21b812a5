"""Best-fit packing of tokenised documents with large-item matching.

1. Tasks turn texts into token ids, cut long documents into pieces and keep a
   narrow row per piece: place, length and a checksum of its ids. The rows are
   written to the shared folder.
2. Only the histogram of piece lengths (at most ``capacity`` rows) reaches the
   driver. There whole classes of equal lengths are packed at once:
   pieces above half the capacity open a bin each; pieces above a third, at
   most two of which fit a bin with any other large piece, are matched to the
   tightest bin that holds a larger one, most constrained first, and the rest
   pair among themselves; smaller pieces fill remaining gaps best-fit
   decreasing. Each step uses up a length or a group of equal bins, so the
   plan is a few thousand rows at any corpus size, and is broadcast.
3. Pieces are numbered within their length by offset buckets (no class is ever
   sorted in one task) and look up their bin and offset in the plan.

Defined results: a null or empty text is one piece holding only the end
token; rows repeated with the same id are packed each on their own; an id may
be null; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.llm.common import bucket_count, materialise, ranked, slices

CAPACITY = 1024
END_ID = 2
CACHE_WORDS = 600_000  # words a worker remembers; emptied beyond that


class Words(dict):
    """Ids of words as little-endian 32-bit bytes, found once; ``lead`` is what stands before them."""

    def __init__(self, owner: Encoder, lead: str):
        self.owner, self.lead = owner, lead

    def __missing__(self, word: str) -> bytes:
        if "\n" in word:  # a line break between two words
            first, *rest = word.split("\n")
            return self[first] + b"".join(self.owner.newline + self.owner.bare[x] for x in rest)
        if not word and not self.lead:
            return b""
        if len(word) > 1 and word[-1] in ".,!?;:" and word[-2].isalpha():  # letters and signs are never one piece
            found = self[word[:-1]] + self.owner.bare[word[-1]]
        else:
            found = array("I", self.owner.merge(self.lead + word)).tobytes()
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = found
        return found


class Encoder:
    """Token ids of texts as little-endian 32-bit bytes, by the vocabulary file ``path``.

    A byte-level pre-tokenizer never joins characters across the start of a
    white-space run, so a text may be encoded in pieces cut there, and words
    that come again need not be encoded again. Single words are merged by
    tiktoken with the ranks of the same file, the faster of two equal ways.
    """

    RUNS = re.compile(r"(?<=\S)(?=\s)")

    def __init__(self, path: str):
        import tiktoken
        from public_tokenizers import PATTERN
        from tokenizers import Tokenizer, pre_tokenizers

        self.tok = Tokenizer.from_file(path)
        added = {x.content for x in self.tok.get_added_tokens_decoder().values()}
        self.special = sorted(added)
        letters = sorted(pre_tokenizers.ByteLevel.alphabet(), key=ord)  # printable stand-ins of the 256 bytes
        own = {c: ord(c) for c in letters if ord(c) < 256}
        other = iter(c for c in letters if ord(c) >= 256)
        own |= {next(other): b for b in range(256) if b not in own.values()}
        ranks = {bytes(own[c] for c in word): i for word, i in self.tok.get_vocab().items() if word not in added}
        self.merge = tiktoken.Encoding("words", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.bare, self.spaced = Words(self, ""), Words(self, " ")
        self.newline = self.whole("\n")

    def whole(self, text: str) -> bytes:
        return array("I", self.tok.encode(text, add_special_tokens=False).ids).tobytes()

    def ids(self, text: str) -> bytes:
        if any(x in text for x in self.special):
            return self.whole(text)
        words = text.split()
        single = len(" ".join(words)) == len(text) and text.count(" ") + text.count("\n") == len(words) - 1
        if not single:  # other white space, or runs of it
            return b"".join(map(self.bare_run, self.RUNS.split(text))) if text else b""
        first, *rest = text.split(" ")
        return self.bare[first] + b"".join(map(self.spaced.__getitem__, rest))

    def bare_run(self, piece: str) -> bytes:
        return array("I", self.merge(piece)).tobytes()


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """``(start, length)`` of the pieces of ``n`` ids: whole pieces, the first one may be shorter."""
    first = n % capacity or capacity
    return [(0, min(n, first))] + [(s, capacity) for s in range(first, n, capacity)]


def pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of every piece of every text."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = rows.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("doc_id", kind), *(T.StructField(n, T.LongType()) for n in ("piece", "start", "length", "ids_crc32"))])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        from pyspark.sql.pandas.types import to_arrow_schema

        enc, out_schema, end = encoder(vocabulary), to_arrow_schema(schema), END_ID.to_bytes(4, "little")
        for b in slices(batches, 512):
            at, cols = [], ([], [], [], [])
            for row, text in enumerate(b.column(1).to_pylist()):
                data = enc.ids(text) + end
                for k, (start, length) in enumerate(cut(len(data) // 4, capacity)):
                    at.append(row)
                    for c, v in zip(cols, (k, start, length, zlib.crc32(data[4 * start : 4 * (start + length)])), strict=True):
                        c.append(v)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int64())).cast(out_schema.field(0).type), *(pa.array(c, pa.int64()) for c in cols)], schema=out_schema)

    return rows.mapInArrow(run, schema).withColumn("piece", F.col("piece").cast("int"))


def pack_histogram(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """The plan: ``(length, lo, hi, base, each, offset)``.

    Pieces of a length with ranks lo..hi-1 go ``each`` to a bin, into bins
    base, base + 1, ..., from ``offset`` on.
    """
    by_gap: dict[int, list[list]] = {}  # gap -> groups [bins, ((length, each), ...)]

    def put(bins: int, items: tuple) -> None:
        if bins:
            by_gap.setdefault(capacity - sum(n * k for n, k in items), []).append([bins, items])

    def tightest(size: int) -> int | None:
        return min((g for g in by_gap if g >= size), default=None)

    def take(gap: int, bins: int) -> tuple[int, tuple]:
        group = by_gap[gap][-1]
        used = min(bins, group[0])
        group[0] -= used
        if not group[0]:
            by_gap[gap].pop()
            if not by_gap[gap]:
                del by_gap[gap]
        return used, group[1]

    sizes = sorted((n for n, c in counts.items() if c), reverse=True)
    for n in sizes:
        if 2 * n > capacity:
            put(counts[n], ((n, 1),))
    alone: int | None = None  # a large piece that still waits for a partner
    waiting: list[tuple[int, int]] = []
    for n in (n for n in sizes if 2 * n <= capacity < 3 * n):
        left = counts[n]
        while left and (gap := tightest(n)) is not None:
            used, items = take(gap, left)
            put(used, (*items, (n, 1)))
            left -= used
        if left:
            waiting.append((n, left))
    for n, left in waiting:
        if alone is not None:
            put(1, ((alone, 1), (n, 1)))
            alone, left = None, left - 1
        put(left // 2, ((n, 2),))
        if left % 2:
            alone = n
    if alone is not None:
        put(1, ((alone, 1),))
    for n in (n for n in sizes if 3 * n <= capacity):
        left = counts[n]
        while left:
            gap = tightest(n)
            room = capacity if gap is None else gap
            each = min(room // n, left)
            if gap is None:
                put(left // each, ((n, each),))
                left %= each
            else:
                used, items = take(gap, left // each)
                put(used, (*items, (n, each)))
                left -= used * each

    plan, base, seen = [], 0, dict.fromkeys(sizes, 0)
    for _, groups in sorted(by_gap.items()):
        for bins, items in groups:
            offset = 0
            for n, each in items:
                plan.append((n, seen[n], seen[n] + bins * each, base, each, offset))
                seen[n] += bins * each
                offset += n * each
            base += bins
    return plan


def pack(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every piece with its ``sequence_id`` and ``offset``."""
    spark = docs.sparkSession
    cut_up = materialise(pieces(docs, vocabulary, capacity, id_col, text_col), "pack-pieces")
    # at most `capacity` rows
    counts = {r["length"]: r["n"] for r in cut_up.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = spark.createDataFrame(
        pack_histogram(counts, capacity), "p_length long, lo long, hi long, base long, each long, at long"
    )
    numbered = ranked(cut_up, ["length"], ["doc_id", "piece", "start", "ids_crc32"], bucket_count(sum(counts.values())))
    hit = (F.col("length") == F.col("p_length")) & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi"))
    inside = F.col("rank") - F.col("lo")
    return numbered.join(F.broadcast(plan), hit).select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        (F.col("base") + F.floor(inside / F.col("each"))).cast("long").alias("sequence_id"),
        (F.col("at") + (inside % F.col("each")) * F.col("length")).cast("long").alias("offset"),
    )
