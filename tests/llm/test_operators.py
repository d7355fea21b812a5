"""Each operator: null, empty and long texts, ties, repeats, empty tables, clashing columns; and brute force or SQL."""

import hashlib
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from daybook.llm import chat_format, exact_dedup, html_extract, jaccard_join, language_id, mixing, packing, pq_dedup, quality, sharding
from daybook.llm.common import components
from daybook.llm.queries import QUERIES, SQL, vocabulary
from tests.conftest import duck_for
from tests.llm.helpers import MESSY, empty, messy, similar_components


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql_agrees(spark, sf001_dir, name):
    got = QUERIES[name](spark, sf001_dir)
    cols = sorted(got.columns)
    want = duck_for(sf001_dir).sql(f"SELECT {', '.join(cols)} FROM ({SQL[name]})").fetchall()
    assert sorted(map(str, map(tuple, got.select(*cols).collect()))) == sorted(map(str, want))


def test_exact_dedup_messy(spark):
    rows = exact_dedup.exact_dedup(messy(spark)).collect()
    assert len(rows) == len(MESSY)
    by = {r["doc_id"]: r for r in rows}
    assert by[0]["keep_id"] == by[2]["keep_id"] == 0 and by[1]["keep_id"] == 1  # case counts, white space does not
    assert {by[k]["keep_id"] for k in (3, 4, 5)} == {5} and by[3]["group_size"] == 3  # longest original text
    assert by[9]["group_size"] == 2 and by[9]["kept"]
    assert by[3]["text_sha256"] == hashlib.sha256(b"").hexdigest()
    kept = exact_dedup.drop_copies(messy(spark))
    assert kept.columns == messy(spark).columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert ids.count(9) == 1 and 5 in ids and 3 not in ids and None in ids
    assert exact_dedup.exact_dedup(empty(spark)).count() == 0


def test_exact_dedup_hot_group(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "same text").otherwise(F.concat(F.lit("t"), "id")).alias("text"))
    out = exact_dedup.exact_dedup(docs, counters=64, heavy=8)
    assert out.where("kept").count() == 2001 and out.where("group_size = 1000 AND keep_id = 0").count() == 1000


def test_chat_layouts(spark):
    rows = [
        (1, '{"messages":[{"role":"user","content":"hi"},{"role":"assistant","content":"yo"}]}'),
        (2, '{"prompt":"hi","completion":"yo"}'),
        (3, '{"instruction":"hi","input":"","output":"yo"}'),
        (4, '{"conversations":[{"from":"human","value":"hi"},{"from":"gpt","value":"yo"}]}'),
        (5, '{"question":"hi","answer":null}'),
        (6, '{"odd":1}'),
        (7, "not json"),
    ]
    records = spark.createDataFrame(rows, "id long, j string")
    turns = chat_format.record_turns(records, "id", "j")
    got = {}
    for r in turns.orderBy("conv_id", "turn").collect():
        got.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    assert all(got[k] == [("user", "hi"), ("assistant", "yo")] for k in (1, 2, 3, 4))
    assert got[5] == [("user", "hi"), ("assistant", "")] and 6 not in got
    assert {r["conv_id"] for r in chat_format.unknown_records(records, "id", "j").collect()} == {6, 7}


def test_chat_round_trip(spark):
    texts = ["\\", "</turn>\n", "<turn user>\n", "\\</turn", "<\\turn", "<\\/turn>", "<", "é🙂", "", None, "\\\\<turn"]
    rows = [(k % 2, k, ["user", "assistant", None, "a>b\n"][k % 4], t, "x") for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, layout string")
    chats = chat_format.format_chats(chat_format.table_turns(df))
    for r in chats.select("conv_id", chat_format.read_back(F.col("formatted")).alias("t")).collect():
        want = [(x[2] or "", x[3] or "") for x in rows if x[0] == r["conv_id"]]
        assert [tuple(t) for t in r["t"]] == want
    assert chat_format.digest(chat_format.format_chats(chat_format.table_turns(df.limit(0)))).count() == 0


def test_mixing(spark):
    out = mixing.mix(messy(spark), target_entropy=0.99, max_epochs=3.0)
    assert out.columns == [*messy(spark).columns, "_mix"]
    rows = out.collect()
    assert {r["doc_id"] for r in rows} == {r[0] for r in MESSY}  # nothing is left out
    assert mixing.mix(empty(spark), max_epochs=2.0).count() == 0
    few = mixing.mix(messy(spark), target_entropy=0.5, budget_tokens=200).collect()
    spent = {}
    for r in few:
        spent.setdefault(r["source"], [0, r["_mix"]["budget"]])[0] += r["_mix"]["n_tokens"]
    assert all(s <= b for s, b in spent.values()) and sum(b for _, b in spent.values()) <= 200


def test_packing(spark):
    path = vocabulary()
    rows = packing.pack(messy(spark), path, capacity=64).collect()
    bins = {}
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for items in bins.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= 64
    from tokenizers import Tokenizer

    tok, want = Tokenizer.from_file(path), []
    for i, t, *_ in MESSY:
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 2]
        for k, (start, n) in enumerate(packing.cut(len(ids), 64)):
            want.append((i, k, start, n, zlib.crc32(struct.pack(f"<{n}I", *ids[start : start + n]))))
    assert sorted(map(str, want)) == sorted(str(tuple(r[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32"))) for r in rows)
    assert packing.pack(empty(spark), path).count() == 0


def test_words_equal_whole_texts():
    e = packing.Encoder(vocabulary())
    rng = np.random.default_rng(3)
    parts = ["a", "Ab", "é", " ", "  ", "\n", "\n\n", "\t", "\r\n", ".", ",", "!!", "23", "'s", "\xa0", "\u3000", "日本", "🙂", "\x1c", "<|endoftext|>", "bar's"]
    for _ in range(3000):
        t = "".join(rng.choice(parts, rng.integers(0, 12)))
        assert e.ids(t) == e.whole(t)


def test_histogram_packing_is_tight():
    rng = np.random.default_rng(5)
    for _ in range(20):
        counts = {int(n): int(c) for n, c in zip(rng.integers(1, 1025, 200), rng.integers(1, 2000, 200), strict=True)}
        plan = packing.pack_histogram(counts, 1024)
        assert all(sum(hi - lo for n, lo, hi, *_ in plan if n == m) == c for m, c in counts.items())
        used = max(base + (hi - lo) // each for _, lo, hi, base, each, _ in plan)
        big = sum(c for n, c in counts.items() if n > 512)
        lower = max(big, -(-sum(n * c for n, c in counts.items()) // 1024))
        assert used <= 1.08 * lower + 2


def test_sharding(spark):
    rows = sharding.kd_shards(messy(spark), shards=3).collect()
    assert len(rows) == len(MESSY)
    slots = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.kd_shards(empty(spark), shards=8).count() == 0
    hot = spark.range(4000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 1500, "copy").otherwise(F.repeat(F.lit("x "), (F.col("id") % 50).cast("int"))).alias("text"))
    sizes = [r["b"] for r in sharding.kd_shards(hot, shards=8).groupBy("shard").agg(F.sum("size").alias("b")).collect()]
    assert len(sizes) == 8 and max(sizes) <= 1.02 * sum(sizes) / 8


def test_language(spark, sf01_dir):
    docs = spark.read.parquet(f"{sf01_dir}/documents.parquet")
    r = language_id.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    assert r.where("lang = lang_pred").count() / r.count() > 0.97
    got = language_id.identify(messy(spark)).collect()
    assert len(got) == len(MESSY)
    assert all(x["lang_pred"] == "und" and x["score"] == 0 for x in got if x["doc_id"] in (3, 4, 5, 6))
    kept = language_id.accepted(messy(spark))
    assert kept.columns == messy(spark).columns and {x["doc_id"] for x in kept.collect()} == {0, 1, 2, 7, 8, 9, 10, 11, None}
    assert language_id.identify(empty(spark)).count() == 0 and language_id.accepted(empty(spark)).count() == 0


def test_network_gradients():
    net = language_id.ByteNetwork(["a", "b", "c"], hidden=4)
    net.p = {k: v.astype(float) for k, v in net.p.items()}
    rng = np.random.default_rng(1)
    x, y = rng.integers(0, 256, (9, 5)), rng.integers(0, 3, 5)
    x[6:, 0] = language_id.PAD

    def loss():
        q, real = net.labels(x), x != language_id.PAD
        return -(np.log(q[:, y, np.arange(5)]) * real).sum() / real.sum()

    grads = net.gradients(x, y)
    for k, at in (("wf", (x[2, 1], 3)), ("wb", (x[7, 2], 9)), ("uf", (0, 8)), ("ub", (1, 6)), ("v", (3, 1)), ("c", (1,))):
        old, e = net.p[k][at], 1e-2
        net.p[k][at] = old + e
        up = loss()
        net.p[k][at] = old - e
        down = loss()
        net.p[k][at] = old
        assert abs((up - down) / (2 * e) - grads[k][at]) < 1e-4


def test_quality(spark, sf01_dir):
    docs, labels = (spark.read.parquet(f"{sf01_dir}/{t}.parquet") for t in ("documents", "labels"))
    r = quality.quality(docs, labels).join(labels, "doc_id").where("held_out")
    assert r.where("quality = predicted").count() / r.count() > 0.95
    out = quality.quality(messy(spark), labels.withColumn("quality", F.when(F.col("doc_id") % 7 != 0, F.col("quality")))).collect()
    assert len(out) == len(MESSY) and all(0 <= x["score"] <= 1 for x in out)
    assert quality.quality(empty(spark), labels.limit(0)).count() == 0


def test_jaccard(spark):
    rng = np.random.default_rng(2)
    words = [f"w{k}" for k in range(60)]
    docs = [(r[0], r[1]) for r in MESSY if r[0] is not None]
    for k in range(60):  # families of near copies of many sizes
        base = list(rng.choice(words, rng.integers(4, 120)))
        for c in range(4):
            t = list(base)
            for _ in range(rng.integers(0, 3)):
                t[rng.integers(len(t))] = "new" + str(rng.integers(5))
            docs.append((100 + 4 * k + c, " ".join(t) + " tail" * int(rng.integers(0, 2))))
    got = jaccard_join.jaccard_components(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == similar_components(docs)
    assert len(got) == len(docs)
    out = jaccard_join.one_per_group(messy(spark))
    assert out.columns == messy(spark).columns and {r["doc_id"] for r in out.collect()} >= {0, 3, 4, 5, 6, 10}
    assert jaccard_join.jaccard_components(empty(spark)).count() == 0


@pytest.mark.parametrize("deep", [0, 1])
def test_pigeonhole_loses_no_pair(deep):
    rng = np.random.default_rng(4)
    sums = 47 // 4 + 1
    for slack in (0, 2):
        band = jaccard_join.Band(0, 16, 48, -(-(sums + slack) // (deep + 1)), deep, slack)
        for _ in range(150):
            n = int(rng.integers(16, 47))
            a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
            most = n // 9
            drop = int(rng.integers(0, most + 1))
            b = np.unique(np.concatenate([rng.permutation(a)[drop:], rng.integers(0, 2**63, most - drop).astype(np.uint64)]))
            if not jaccard_join.linked(a, b) or not 16 <= len(b) < 48:
                continue
            found = []
            for s in (a, b):
                found.append(set(np.concatenate([x for x, _ in jaccard_join.signatures(s, np.array([0, len(s)]), [band])]).tolist()))
            assert found[0] & found[1]


def test_embeddings_messy(spark):
    v = [0.6, 0.8, 0.0]
    rows = [(0, v, 1), (1, v, 1), (2, [1.2, 1.6, 0.01], 1), (3, v, 2), (4, None, 1), (5, [0.0, 0.0, 0.0], 1), (6, [1.0, None, 0.0], 1), (7, [float("nan"), 1.0, 0.0], 1), (8, v, None), (9, [0.6, 0.8], 1), (10, [], 1), (1, v, 1), (None, [0.0, 0.0, 1.0], 1)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, label int, cid string")
    out = sorted(map(str, ((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in pq_dedup.near_duplicates(df).collect())))
    alone = [(k, 0, k, True) for k in (3, 4, 5, 6, 7, 8, 9, 10, None)]
    assert out == sorted(map(str, [(0, 3, 0, True), (1, 3, 0, False), (1, 3, 0, False), (2, 3, 0, False), *alone]))
    assert pq_dedup.near_duplicates(df.limit(0)).count() == 0


def test_embeddings_clusters(spark):
    rng = np.random.default_rng(6)
    base = rng.normal(size=(40, 16))
    x = np.repeat(base, 12, axis=0) + rng.normal(scale=0.12, size=(480, 16))
    label = np.repeat(np.arange(40) % 3, 12)
    df = spark.createDataFrame([(k, v.tolist(), int(c)) for k, (v, c) in enumerate(zip(x, label, strict=True))], "vec_id long, embedding array<double>, label int")
    u = x / np.linalg.norm(x, axis=1)[:, None]
    link = (u @ u.T >= 0.93) & (label[:, None] == label[None, :]) & ~np.eye(480, dtype=bool)
    got = {r["vec_id"]: r["n_links"] for r in pq_dedup.near_duplicates(df, max_train=200).collect()}
    assert [got[k] for k in range(480)] == link.sum(1).tolist() and link.sum() > 500


def test_html():
    page = """<html><head><title>T</title><script>x("</p>")</script></head><body><nav><a href=/>Menu</a></nav>
    <div class="sidebar">Side</div><article><h1>Head&amp;line</h1><p>One <b>two<br>three</b>&nbsp;four<p>Five &lt;six&gt; and quite some more text here.
    <div class="comments"><p>First!</p></div><form><input> Send</form><ul><li>a<li>b</ul></article><footer>&copy; F</footer></body>"""
    assert html_extract.main_text(page) == "Head&line\nOne two three four\nFive <six> and quite some more text here.\na\nb"
    assert html_extract.main_text("") == html_extract.main_text(None) == ""
    assert html_extract.main_text("just text") == "just text"
    body = "<body><div><a href=x>l</a><a href=y>m</a></div><div><p>A long enough paragraph of words, many of them.</p><p>And another one, long as well, with words.</p></div></body>"
    assert html_extract.main_text(body).startswith("A long enough paragraph") and "another one" in html_extract.main_text(body)
    assert html_extract.main_text("<div>" * 3000 + "deep" + "</div>" * 3000) == "deep"
    assert html_extract.main_text("<p class='a>broken <b>x") is not None


def test_html_table(spark):
    df = spark.createDataFrame([(1, "u", None, "z"), (None, None, "<p>x</p>", "z"), (2, "u", "", "z"), (2, "u", "", "z")], "page_id long, url string, html string, text string")
    rows = html_extract.extract(df).collect()
    assert sorted((r["n_chars"], r["text"]) for r in rows) == [(0, ""), (0, ""), (0, ""), (1, "x")]
    assert html_extract.extract(df.limit(0)).count() == 0


def test_components(spark):
    edges = [(k, k + 1) for k in range(100, 140)] + [(1, k) for k in range(2, 60)] + [(7, 7), (200, 201), (201, 200)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[k] == 100 for k in range(100, 141)) and all(got[k] == 1 for k in range(1, 60)) and got[201] == 200
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


PROSE = "".join(f"<p>Paragraph {k} of the article has a good many words, so it is clearly text.</p>" for k in range(6))


@pytest.mark.parametrize(
    "page",
    [
        "<div class='site has-sidebar'>{}</div>",
        "<div class='site has-sidebar'><article><h1>T</h1>{}</article><div class='sidebar'>Side words</div></div>",
        "<article class='post category-social'>{}</article>",
        "<article class='post comments-open social'>{}</article>",
        "<main class='form'>{}</main>",
        "<form id='aspnetForm'><nav><a href=/>Menu</a></nav><div class='sidebar'>Side words</div><div>{}</div></form>",
        "<form id='form'><article>{}</article></form>",
        "<div id='social'><article>{}</article></div><section class='comments'>Side words</section>",
        "<div class='share'>{}</div><div class='search-form'>Side words</div>",
        "<div class='share'><p>Side words too</p></div><div class='hidden'>{}</div>",
    ],
)
def test_html_marks_around_the_text(page):
    got = html_extract.main_text(f"<html><body>{page.format(PROSE)}</body></html>")
    assert all(f"Paragraph {k} of" in got for k in range(6)) and "Side words" not in got and "Menu" not in got


def test_html_marked_headings():
    got = html_extract.main_text(f"<body><article><header class='header'><h1 id='search'>Top</h1></header>{PROSE}<h2 id='discussion'>Discussion</h2>{PROSE}<h3 class='form'>Form</h3>{PROSE}</article></body>")
    assert {"Top", "Discussion", "Form"} <= set(got.split("\n"))


def test_html_marks_beside_the_text():
    longer = "A reader wrote a long comment, much longer than the article. " * 40
    for mark in ("class='comments'", "id='comments'", "class='x social-share'", "role='complementary'", "class='cookie-banner'"):
        got = html_extract.main_text(f"<body><header><h1>Site</h1></header><article>{PROSE}</article><div {mark}><h2>Replies</h2><article><p>{longer}</p></article></div></body>")
        assert "Paragraph 5 of" in got and "reader" not in got and "Site" not in got
    got = html_extract.main_text(f"<body><article>{PROSE}<article class='comment'><p>First!</p></article><div class='related'><h3>More</h3>Else</div></article></body>")
    assert "Paragraph 5 of" in got and "First!" not in got and "More" not in got
    assert html_extract.main_text("<body><nav><a href=/>Menu</a> and more</nav></body>") == ""
    two = "<div class='share'><p>One half of words.</p></div><div class='social'><p>The other half too.</p></div>"
    assert "half" in html_extract.main_text(f"<body>{two}</body>")  # nothing else on the page


def _hot_signature(spark):
    """One signature of 900 sets: a component of 600, 240 sets of a component each, two of 30; sizes 20 to 59."""
    rng = np.random.default_rng(9)
    sets = [(1, k, 10_000 if k < 600 else k if k < 840 else 20_000 + k % 2, 20 + k % 40) for k in range(900)]
    sets += [(2, k, k, 20) for k in range(5)] + [(3, k, 7, 20) for k in range(50)]  # a small one, and one of a single component
    placed = spark.createDataFrame([x[:3] for x in sets], "sig long, cid long, comp long")
    code = {k: rng.integers(0, 2**63, 20 + k % 40).astype(np.uint64) for k in range(900)}
    made = [(k, len(h), jaccard_join.profiles(h, np.array([0, len(h)]), jaccard_join.COARSE)[0]) for k, h in code.items()]
    return sets, placed, spark.createDataFrame([(k, n, bytearray(p)) for k, n, p in made], "cid long, n long, coarse binary")


def test_jaccard_hot_signature_is_cut(spark):
    sets, placed, classes = _hot_signature(spark)
    groups = jaccard_join.dealt(placed, classes, 50)
    rows = groups.collect()
    cells = {}
    for r in rows:
        cells.setdefault((r["sig"], r["pair"]), []).append(r)
    assert max(map(len, cells.values())) <= 2 * 2 * 50  # hashed cells vary
    assert all(len({r["comp"] for r in c}) > 1 for c in cells.values() if len({r["side"] for r in c}) > 1)
    met = set()
    for c in cells.values():
        for a in c:
            met |= {(a["sig"], min(a["cid"], b["cid"]), max(a["cid"], b["cid"])) for b in c if a["comp"] != b["comp"] and (a["side"], b["side"]) in ((0, 1), (2, 2))}
    size = {k: 20 + k % 40 for _, k, _, _ in sets}
    wanted = {(s, a, b) for s, a, x, _ in sets for t, b, y, _ in sets if s == t and a < b and x != y and 5 * min(size[a], size[b]) >= 4 * max(size[a], size[b])}
    assert wanted <= met
    whole = {tuple(r) for r in jaccard_join.across(jaccard_join.dealt(placed, classes, 10**6)).collect()}
    assert {tuple(r) for r in jaccard_join.across(groups).collect()} == whole


def test_jaccard_template_over_the_cell(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "CELL", 12)
    rng = np.random.default_rng(12)
    base = [f"t{k}" for k in range(80)]
    docs = []
    for k in range(120):  # a third of near copies, the others from the template but below 0.8
        t = list(base)
        for _ in range(1 if k % 3 == 0 else int(rng.integers(2, 6))):
            t[rng.integers(len(t))] = f"n{rng.integers(40)}"
        docs.append((k, " ".join(t)))
    got = jaccard_join.jaccard_components(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    want = similar_components(docs)
    assert {r["doc_id"]: r["component_id"] for r in got} == want and len(set(want.values())) > 1


def test_jaccard_pairs_verified_follow_the_sets(spark, monkeypatch):
    rng = np.random.default_rng(5)
    docs = []
    for k in range(300):  # near copies of one text, some 4,200 linked pairs that share no leader
        t = [f"t{j}" for j in range(100)]
        for _ in range(2):
            t[int(rng.integers(0, 25))] = f"n{k}_{rng.integers(9)}"
        docs.append((k, " ".join(t)))
    counts, verify = [], jaccard_join.verify
    monkeypatch.setattr(jaccard_join, "verify", lambda pairs, *rest: (counts.append(pairs.count()), verify(pairs, *rest))[1])
    got = jaccard_join.jaccard_components(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == similar_components(docs)
    assert sum(counts) <= 3 * len(docs)


def test_jaccard_spanning_pairs_leave_no_set_out(spark):
    sets, placed, classes = _hot_signature(spark)
    comp = {(s, k): c for s, k, c, _ in sets}
    groups = jaccard_join.dealt(placed, classes, 50)
    whole = {tuple(r) for r in jaccard_join.across(groups).collect()}
    some = jaccard_join.across(groups, spanning=True).collect()
    pairs = {(r["a"], r["b"]) for r in some if r["b"] is not None}
    left = {(r["sig"], r["a"]) for r in some if r["b"] is None}
    assert pairs <= whole
    for a, b in whole - pairs:
        assert any({(s, a), (s, b)} <= left and comp[s, a] != comp[s, b] for s in (1, 2, 3) if (s, a) in comp and (s, b) in comp)
