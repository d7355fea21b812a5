"""SentencePiece encoding, lexical search and cross-tokenizer alignment against the libraries and brute force."""

import hashlib
import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from daybook.llm import lexical_search, sentencepiece_bpe, token_alignment
from daybook.llm.queries import QUERIES, pieces_model, vocabulary
from tests.llm.helpers import MESSY, empty, messy

ALPHABET = [*"ab \n\t▁éß한😀\x00<>|/0'sA1　\xa0\x1c!.,", "ing", " the", "\n\n", "<|endoftext|>", "</s>", "don't", "<0x0A>", "é", "Ünï"]
ODD = ["", " ", "\n", "  two  blanks ", "a" * 3000, "ing" * 500, " " * 33 + "the", " </s> <s> <unk> <pad>", "foo\n bar\n\nbaz\r\n qux", "word,word. word!\nword", "x…"]


def odd_texts(n, seed=7):
    pick = random.Random(seed)
    return ODD + ["".join(pick.choice(ALPHABET) for _ in range(pick.randint(0, 50))) for _ in range(n)]


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=pieces_model())


def test_encoding_and_decoding_as_the_library(library):
    own, words = sentencepiece_bpe.model(pieces_model()), sentencepiece_bpe.Encoder(pieces_model())
    for text in odd_texts(3000):
        ids = library.encode(text)
        assert own.encode(text) == ids, text
        assert own.decode(ids) == library.decode(ids), text
        found = words.words(text)
        n, numbers, again = sentencepiece_bpe.joined(found) if found else (0, "", "")
        assert (n, numbers, again[1:]) == (len(ids), "".join(f" {i}" for i in ids), library.decode(ids)), text


def test_decoding_of_any_ids(library):
    own, pick = sentencepiece_bpe.model(pieces_model()), random.Random(3)
    common = [own.id["▁"], own.id["▁the"], own.id["▁▁"], 0, 1, 2]
    for _ in range(3000):
        ids = [pick.choice([pick.randrange(len(library)), pick.choice(own.byte), pick.choice(common)]) for _ in range(pick.randint(0, 8))]
        assert own.decode(ids) == library.decode(ids), ids


def test_pairs_are_compatible_only_as_merged(library):
    own = sentencepiece_bpe.model(pieces_model())
    pick, names = random.Random(5), sorted(own.id)
    for _ in range(3000):
        a, b = pick.choice(names), pick.choice(names)
        assert own.follows(a, b) == (own.merge(a + b) == [a, b])
    assert sentencepiece_bpe.utf8(bytearray("é".encode() + b"\xff\xc3a")) == "é��a"


def test_sentencepiece_query_on_all_documents(spark, sf01_dir, library):
    want = {}
    for r in spark.read.parquet(f"{sf01_dir}/documents.parquet").select("doc_id", "text").collect():
        ids = library.encode(r["text"] or "") + [library.eos_id()]
        want[r["doc_id"]] = (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest())
    got = QUERIES["op11_sentencepiece"](spark, sf01_dir).collect()
    assert {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in got} == want and len(got) == len(want)


def test_sentencepiece_messy(spark, library):
    rows = sentencepiece_bpe.digests(messy(spark), pieces_model()).collect()
    assert len(rows) == len(MESSY)
    by = {r["doc_id"]: r for r in rows}
    assert by[3]["n_tokens"] == by[4]["n_tokens"] == 1 and by[3]["decoded_sha256"] == hashlib.sha256(b"").hexdigest()
    assert None in by and sum(r["doc_id"] == 9 for r in rows) == 2
    assert sentencepiece_bpe.digests(empty(spark), pieces_model()).count() == 0
    there = sentencepiece_bpe.decoded(sentencepiece_bpe.encoded(messy(spark), pieces_model()), pieces_model())
    assert there.columns == [*messy(spark).columns, "ids", "decoded"]
    for r in there.collect():
        assert r["ids"] == library.encode(r["text"] or "") + [library.eos_id()] and r["decoded"] == library.decode(r["ids"])


TERM = re.compile(lexical_search.TERM_CHARS)


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def ranking(docs, items, top):
    """Brute force; docs, items: (id, text)."""
    held = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs]
    n, total = sum(x[2] > 0 for x in held), sum(x[2] for x in held)
    df = Counter(t for _, c, _ in held for t in c)
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, set()).update(terms(t))
    out = []
    for i, words in wanted.items():
        rows = []
        for d, c, size in held:
            score = 0
            if size:
                m = 100 - 50 + (50 * size * n) // total
                score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * m)) for t in words if t in c)
            if score > 0:
                rows.append((score, d))
        rows.sort(key=lambda x: (-x[0], x[1] is None, x[1] or 0))
        out += [(i, k + 1, d, s) for k, (s, d) in enumerate(rows[:top])]
    return sorted(out, key=str)


@pytest.mark.parametrize("small", [False, True])
def test_lexical_search_brute_force(spark, monkeypatch, small):
    """Ties, repeats, nulls, long items; also with first bounds from a sample and several blocks of items."""
    pick = random.Random(11)
    words = [f"w{k}" for k in range(90)] + ["Éa", "éa", "x", "X"]
    text = lambda: " ".join(pick.choice(words[: pick.randint(2, len(words))]) for _ in range(pick.randint(1, 40)))
    docs = [(k, text()) for k in range(500)] + [(k, "same words w1 w2 w3") for k in range(500, 700)] + [(None, "w1 w2"), (None, "w1 w2"), (7, "w1"), (701, None), (702, ""), (703, " .,; "), (704, "w5 " * 3000)]
    items = [(1, "W1, w2? w3!"), (2, "x X éa Éa"), (3, None), (4, ""), (5, "nowhere"), (6, " ".join(words)), (6, "w1 more"), (None, "w80 w81"), (8, "same")]
    if small:
        monkeypatch.setattr(lexical_search, "SAMPLE_DOCS", 1)
        monkeypatch.setattr(lexical_search.math, "isqrt", lambda n: 2)
    got = lexical_search.lexical_search(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string"), top=10, block_terms=40 if small else 10**6)
    assert sorted(map(tuple, got.collect()), key=str) == ranking(docs, items, 10)


@pytest.mark.parametrize(("cells", "leaf", "depth"), [(1 << 22, 16, 63), (1 << 22, 1, 63), (900, 1, 63), (1 << 22, 1, 3), (5000, 2, 1)])
def test_trie_search_keeps_all_of_the_best(monkeypatch, cells, leaf, depth):
    import numpy as np

    for name, value in (("CELLS", cells), ("LEAF_PATHS", leaf), ("DEPTH", depth)):
        monkeypatch.setattr(lexical_search, name, value)
    rng = np.random.default_rng(4)
    tf = rng.poisson(0.4, (600, 12)) * rng.integers(0, 2, (600, 12))
    m = rng.integers(50, 90, 600)
    ids = [None if k % 97 == 0 else int(k) // 2 for k in range(600)]
    at, term = np.nonzero(tf)
    tries = lexical_search.Tries(ids, m, (tf > 0).sum(axis=1), term, tf[at, term], 12)
    for _ in range(20):
        own = rng.permutation(12)[: rng.integers(1, 13)]
        weights = rng.integers(0, 9000, len(own))
        best = lexical_search.Best(10, 0)
        tries.search(own, weights, best)
        best.cut()
        scores = (weights * lexical_search.gain(tf[:, own], m[:, None])).sum(axis=1)
        want = sorted(((int(s), i) for s, i in zip(scores, ids, strict=True) if s > 0), key=lambda x: (-x[0], x[1] is None, x[1] or 0))[:10]
        assert best.rows == want


def test_lexical_search_empty_and_clashing(spark):
    items = messy(spark).select(F.col("doc_id").alias("item_id"), "text", "rank", "block")
    rows = lexical_search.lexical_search(messy(spark), items).collect()
    assert rows and {r["rank"] for r in rows if r["item_id"] == 0} >= {1}
    assert lexical_search.lexical_search(empty(spark), items).count() == 0
    assert lexical_search.lexical_search(messy(spark), items.limit(0)).count() == 0


def aligned(text, library, tok, raw_a):
    if not text:
        return None
    a, b = tok.encode(" " + text, add_special_tokens=False).ids, library.encode(text)
    a_bytes = [raw_a(i) for i in a]
    b_bytes = [bytes([int(p[3:5], 16)]) if library.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, library.id_to_piece(i)) for i in b)]
    whole = (" " + text).encode()
    if b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
        return None

    def ends(parts):
        at, out = 0, {}
        for k, p in enumerate(parts):
            at += len(p)
            out[at] = k
        return out

    at_a, at_b = ends(a_bytes), ends(b_bytes)
    groups, links, i, j = [], [], 0, 0
    for end in sorted(at_a.keys() & at_b.keys()):
        groups.append(",".join(map(str, a[i : at_a[end] + 1])) + "|" + ",".join(map(str, b[j : at_b[end] + 1])))
        links.append((a[at_a[end]], b[at_b[end]]))
        i, j = at_a[end] + 1, at_b[end] + 1
    return len(a), len(b), groups, links


def alignments(docs, library):
    from tokenizers import Tokenizer

    from daybook.llm import packing

    tok = Tokenizer.from_file(vocabulary())
    tok.encode_special_tokens = True
    raw_a = packing.encoder(vocabulary()).merge.__self__.decode_single_token_bytes
    found = [(i, aligned(t, library, tok, raw_a)) for i, t in docs]
    counts = Counter(x for _, r in found if r for x in r[3])
    high = Counter()
    for (_, b), n in counts.items():
        high[b] = max(high[b], n)
    out = []
    for i, r in found:
        if r is None:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        own = [counts[x] for x in r[3]]
        out.append((i, r[0], r[1], len(r[2]), len(own), sum(n == high[x[1]] for n, x in zip(own, r[3], strict=True)), sum(own), hashlib.sha256(";".join(r[2]).encode()).hexdigest()))
    return sorted(out, key=str)


def test_alignment_brute_force(spark, library, sf001_dir):
    """Odd texts and all documents."""
    docs = [(k, t if k % 3 else t.replace("▁", "")) for k, t in enumerate(odd_texts(800))]
    docs += [(5, None), (None, "hello world"), (None, "hello world"), (9, "the same words again and again"), *((k, "the cat") for k in range(3000, 3100))]
    docs += [tuple(r) for r in spark.read.parquet(f"{sf001_dir}/documents.parquet").select("doc_id", "text").collect()]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = token_alignment.align(df, vocabulary(), pieces_model()).collect()
    assert sorted(map(tuple, got), key=str) == alignments(docs, library)


def test_alignment_blocks_and_dense_bitmaps():
    import numpy as np

    block, pick = token_alignment.Block(), random.Random(2)
    rows = {k: [pick.randrange(6) for _ in range(pick.randint(0, 30))] for k in range(9000)}
    for lo in range(0, 9000, 700):
        own = [k for k in range(lo, min(lo + 700, 9000)) if rows[k]]
        block.add(own, [np.array(rows[k], np.int64).tobytes() for k in own])
    got = Counter()
    for pairs, plane, bounds, places in block.bitmaps():
        bits = token_alignment.packed(bounds, places)
        offsets = np.frombuffer(bits.buffers()[1], np.int32)
        back, sizes = token_alignment.places_of(np.frombuffer(bits.buffers()[2], np.uint8), offsets)
        assert (back == places).all() and (sizes == np.diff(bounds)).all()
        assert plane >= 0 or max(np.diff(offsets)) == token_alignment.BITS  # the documents are dense here
        for p, n in zip(pairs, sizes, strict=True):
            got[p] += int(n) << max(plane, 0)
    assert got == Counter(p for r in rows.values() for p in r)


def test_alignment_counts_and_messy(spark, library):
    rows = token_alignment.align(messy(spark), vocabulary(), pieces_model()).collect()
    assert sorted(map(tuple, rows), key=str) == alignments([(r[0], r[1]) for r in MESSY], library)
    assert token_alignment.align(empty(spark), vocabulary(), pieces_model()).count() == 0
    bitmaps = token_alignment.inverted(messy(spark), vocabulary(), pieces_model(), "doc_id", "text").where("bits IS NOT NULL")
    counts = token_alignment.pair_counts(bitmaps).collect()
    assert max(r["n_docs"] for r in counts) <= len(MESSY) and all(r["n_links"] >= r["n_docs"] > 0 for r in counts)
