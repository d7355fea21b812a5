"""SentencePiece encoding and decoding by a table of each prefix's last piece.

The encoding that merging yields is unique, and so is the last piece of the
encoding of every prefix of a text. A text is read once from the left:

1. an automaton over all pieces names those that end at each character;
2. of these, the one that is compatible with the last piece before it is the
   last piece of the prefix. Two pieces are compatible if merging their joined
   characters gives back these two. That holds for neighbours alone and yet
   proves the whole: a merge across a border would be the first of its kind in
   the text exactly if it were in the two pieces. Tests are remembered;
3. from the end of the text the last pieces are followed backwards, which
   recovers the pieces and so their ids.

The work is linear in the length of a text, also without any white space.
No piece holds a pair of characters that isn't in some piece's string, so text
may be cut between such characters; blanks are such places (checked when the
model is loaded), and words that come again are looked up.

Defined results: a null text counts as empty and gives the end id only (no ids
without one); characters in no piece become byte ids, or the unknown id if the
model has none; control strings inside a text are ordinary characters; rows
repeat as they come, also with equal or null ids; an empty table gives an empty
result; other columns are ignored. Decoding turns bytes that aren't UTF-8 into
U+FFFD each, as the library does.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.llm.common import slices

BLANK = "▁"
CACHE_WORDS = 600_000  # words a worker remembers; emptied beyond that
CACHE_CHARS = 64  # longer runs aren't remembered
CACHE_PAIRS = 1_000_000  # compatibility tests remembered; emptied beyond that


class Pieces:
    """The pieces of a model file, and encoding and decoding with them.

    Only models that merge (type BPE), add a blank in front, keep all blanks
    and don't change characters are taken.
    """

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(sp.get_piece_size())
        normal = [i for i in ids if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))]
        if any(sp.is_unused(i) for i in normal):
            raise ValueError("models with unused pieces aren't supported")
        self.id = {sp.id_to_piece(i): i for i in normal}
        self.score = {sp.id_to_piece(i): sp.get_score(i) for i in normal}
        self.byte = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.unknown, self.end = sp.unk_id(), sp.eos_id()
        self.bytes_known = all(sp.is_byte(i) for i in self.byte)
        self.text = {i: p for p, i in self.id.items()}
        self.raw = {i: b for b, i in enumerate(self.byte)} if self.bytes_known else {}
        sample = f"{BLANK} a  b ①ﬁ"
        if sp.decode(sp.encode(sample)) != sample.replace(BLANK, " ") or sp.encode("", out_type=str) or sp.encode("a", out_type=str)[0][0] != BLANK:
            raise ValueError("only models that keep every character and add a blank in front are supported")
        self.matches = ahocorasick.Automaton()
        for p in self.id:
            self.matches.add_word(p, p)
        self.matches.make_automaton()
        if any(BLANK in p.lstrip(BLANK) for p in self.id):  # a blank could then join what stands before it
            raise ValueError("a piece with a blank behind another character")
        # a merge across two characters makes a piece that holds both: where no piece does, text may be cut
        self.together = {p[k : k + 2] for p in self.id for k in range(len(p) - 1)}
        self.lines = not any("\n" in pair for pair in self.together)  # line breaks stand alone
        self.words = re.compile(rf"{BLANK}*[^{BLANK}]+|{BLANK}+")
        self._pairs: dict[str, dict[str, bool]] = {}  # first piece, second piece
        self._tested = 0

    def merge(self, text: str) -> list[str]:
        """Pieces of a short ``text`` by merging: always the pair of highest score, of equals the first."""
        parts, score = list(text), self.score.get
        joined = [score(a + b) for a, b in zip(parts, parts[1:], strict=False)]
        while True:
            best = max((s for s in joined if s is not None), default=None)
            if best is None:
                return parts
            k = joined.index(best)
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
            del joined[k]
            if k:
                joined[k - 1] = score(parts[k - 1] + parts[k])
            if k < len(joined):
                joined[k] = score(parts[k] + parts[k + 1])

    def follows(self, before: str, piece: str) -> bool:
        """Whether merging the characters of both gives both; ``before`` is empty at the start of a text."""
        row = self._pairs.get(before)
        if row is None:
            row = self._pairs[before] = {}
        known = row.get(piece)
        if known is None:
            if self._tested >= CACHE_PAIRS:
                row = {}
                self._pairs, self._tested = {before: row}, 0
            self._tested += 1
            known = row[piece] = self.merge(before + piece) == ([before, piece] if before else [piece])
        return known

    def last_pieces(self, text: str) -> list[str]:
        """At k: the last piece of the encoding of the first k characters."""
        last, done, follows, pairs, none = [""] * (len(text) + 1), 0, self.follows, self._pairs, {}
        for end, piece in self.matches.iter(text):
            if done > end:
                continue
            while done < end:  # a character that ends no compatible piece stands alone
                last[done + 1] = text[done]
                done += 1
            before = last[end + 1 - len(piece)]
            known = pairs.get(before, none).get(piece)
            if known or known is None and follows(before, piece):
                last[end + 1] = piece
                done = end + 1
            if pairs is not self._pairs:
                pairs = self._pairs
        while done < len(text):
            last[done + 1] = text[done]
            done += 1
        return last

    def pieces(self, text: str) -> list[str]:
        """Pieces of ``text`` as it is, found backwards from the last one."""
        last, at, found = self.last_pieces(text), len(text), []
        while at:
            found.append(last[at])
            at -= len(last[at])
        return found[::-1]

    def ids_of(self, text: str) -> list[int]:
        pieces = self.pieces(text)
        try:
            return [self.id[p] for p in pieces]
        except KeyError:  # characters in no piece
            pass
        found: list[int] = []
        for p in pieces:
            i = self.id.get(p)
            if i is not None:
                found.append(i)
            elif self.bytes_known:
                found.extend(self.byte[b] for b in p.encode())
            elif not found or found[-1] != self.unknown:  # neighbours in no piece are one unknown
                found.append(self.unknown)
        return found

    def marked(self, text: str) -> list[str]:
        """``text`` with its blanks marked and one in front, cut where no piece reaches over."""
        return self.words.findall((BLANK + text).replace(" ", BLANK)) if text else []

    def encode(self, text: str) -> list[int]:
        """Ids of a whole text, without an end id."""
        return [i for w in self.marked(text) for i in self.ids_of(w)]

    def decode(self, ids: list[int]) -> str:
        """The text of ``ids``: control ids are silent, and so is the blank in front."""
        first = next((i for i in ids if i in self.text or i in self.raw or i == self.unknown), None)
        return self.decode_inner(ids)[self.text.get(first, "")[:1] == BLANK :]

    def decode_inner(self, ids: list[int]) -> str:
        """As ``decode`` inside a text, where a blank in front counts."""
        try:
            return "".join([self.text[i] for i in ids]).replace(BLANK, " ")
        except KeyError:  # bytes, control or unknown ids
            pass
        out, raw = [], bytearray()
        for i in ids:
            b = self.raw.get(i)
            if b is not None:
                raw.append(b)
                continue
            if raw:
                out.append(utf8(raw))
                raw.clear()  # control ids, too, end a run of bytes
            p = self.text.get(i)
            if p is not None:
                out.append(p.replace(BLANK, " "))
            elif i == self.unknown:
                out.append(" ⁇ ")
        if raw:
            out.append(utf8(raw))
        return "".join(out)


def utf8(raw: bytearray) -> str:
    """Bytes as text; each byte that is in no UTF-8 character is one U+FFFD."""
    try:
        return raw.decode()
    except UnicodeDecodeError:
        out, rest = [], bytes(raw)
        while rest:
            try:
                out.append(rest.decode())
                break
            except UnicodeDecodeError as e:
                out.append(rest[: e.start].decode() + "�")
                rest = rest[e.start + 1 :]
        return "".join(out)


@lru_cache(maxsize=2)
def model(path: str) -> Pieces:
    return Pieces(path)


class Words(dict):
    """For a word: number of ids, ids in decimals with a blank before each, the text decoded from them.

    ``lead`` stands before each word (a blank, or nothing).
    """

    def __init__(self, pieces: Pieces, lead: str, bare: Words | None = None):
        self.pieces, self.lead, self.bare = pieces, lead, self if bare is None else bare
        self.line = self.found("\n")

    def found(self, marked: str) -> tuple[int, str, str]:
        ids = self.pieces.ids_of(marked)
        return len(ids), "".join([f" {i}" for i in ids]), self.pieces.decode_inner(ids)

    def __missing__(self, word: str) -> tuple[int, str, str]:
        pieces = self.pieces
        if "\n" in word and pieces.lines:
            first, *rest = word.split("\n")
            found = [self[first]] if first or self.lead else []
            for x in rest:
                found.append(self.line)
                if x:
                    found.append(self.bare[x])
            return joined(found)
        if len(word) > 1 and word[-2:] not in pieces.together:  # no piece holds the last two characters
            return self.cut(word)
        found = self.found(self.lead + word)
        if len(word) <= CACHE_CHARS:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[word] = found
        return found

    def cut(self, word: str) -> tuple[int, str, str]:
        """A word whose last characters are in no piece with what stands before them."""
        at, together = len(word) - 1, self.pieces.together
        while at > 1 and word[at - 2 : at] not in together:
            at -= 1
        return joined([self[word[:at]], *(self.bare[c] for c in word[at:])])


def joined(parts: list[tuple] | tuple) -> tuple[int, str, str]:
    n, ids, texts = zip(*parts, strict=True)
    return sum(n), "".join(ids), "".join(texts)


class Encoder:
    """Whole texts by remembered words."""

    def __init__(self, path: str):
        self.pieces = model(path)
        self.bare = Words(self.pieces, "")
        self.spaced = Words(self.pieces, BLANK, self.bare)

    def words(self, text: str) -> list[tuple[int, str, str]]:
        if not text:
            return []
        parts = text.split(" ")
        if "" in parts or BLANK in text:  # blanks in a row, or the mark of blanks itself
            return [self.bare[w] for w in self.pieces.marked(text)]
        return list(map(self.spaced.__getitem__, parts))


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


SCHEMA = [("n_tokens", T.LongType()), ("ids_sha256", T.StringType()), ("decoded_sha256", T.StringType())]


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: every whole text encoded with an end id, and decoded again.

    Characters of one text are cut into words only where no piece reaches over,
    and a character's bytes are never parted, so ids and decoded texts of its
    words, joined, are those of the text.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    schema = T.StructType([T.StructField("doc_id", rows.schema["doc_id"].dataType), *(T.StructField(n, t) for n, t in SCHEMA)])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        from pyspark.sql.pandas.types import to_arrow_schema

        known, out_schema = encoder(path), to_arrow_schema(schema)
        end, sha = f" {known.pieces.end}", hashlib.sha256
        for b in slices(batches, 512):
            n, ids, decoded = [], [], []
            for text in b.column(1).to_pylist():
                count, numbers, again = joined(found) if (found := known.words(text)) else (0, "", "")
                n.append(count + 1)
                ids.append(sha((numbers + end)[1:].encode()).hexdigest())
                decoded.append(sha(again[1:].encode()).hexdigest())  # without the blank in front
            yield pa.RecordBatch.from_arrays([b.column(0).cast(out_schema.field(0).type), pa.array(n, pa.int64()), pa.array(ids), pa.array(decoded)], schema=out_schema)

    return rows.mapInArrow(run, schema)


def encoded(docs: DataFrame, path: str, text_col: str = "text", end: bool = True, name: str = "ids") -> DataFrame:
    """All rows with a column ``name``: the ids of their texts, as an array of ints."""
    schema = T.StructType([*(f for f in docs.schema.fields if f.name != name), T.StructField(name, T.ArrayType(T.IntegerType(), False))])
    keep = [f.name for f in docs.schema.fields if f.name != name]
    rows = docs.select(*(F.col(f"`{c}`") for c in keep), F.coalesce(F.col(text_col), F.lit("")).alias(name))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        from pyspark.sql.pandas.types import to_arrow_schema

        pieces, out_schema = model(path), to_arrow_schema(schema)
        for b in slices(batches, 512):
            ids = [array("i", pieces.encode(t) + [pieces.end] * end) for t in b.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b.column(k).cast(out_schema.field(k).type) for k in range(len(keep))), pa.array(ids, out_schema.field(len(keep)).type)], schema=out_schema)

    return rows.mapInArrow(run, schema)


def decoded(rows: DataFrame, path: str, ids_col: str = "ids", name: str = "decoded") -> DataFrame:
    """All rows with a column ``name``: the text of their ids; null ids give a null text."""
    schema = T.StructType([*(f for f in rows.schema.fields if f.name != name), T.StructField(name, T.StringType())])
    keep = [f.name for f in rows.schema.fields if f.name != name]
    given = rows.select(*(F.col(f"`{c}`") for c in keep), F.col(ids_col).alias(name))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        from pyspark.sql.pandas.types import to_arrow_schema

        pieces, out_schema = model(path), to_arrow_schema(schema)
        for b in slices(batches, 512):
            texts = [None if ids is None else pieces.decode([i for i in ids if i is not None]) for ids in b.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b.column(k).cast(out_schema.field(k).type) for k in range(len(keep))), pa.array(texts, pa.string())], schema=out_schema)

    return given.mapInArrow(run, schema)
