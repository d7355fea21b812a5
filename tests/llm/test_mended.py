"""Cases that reviews found: marked boxes on pages without an article, broken markup, names that clash, whole training texts."""

import math
import pickle
import time
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from daybook.llm import chat_format, exact_dedup, html_extract, language_id, mixing, pq_dedup, quality
from daybook.llm.common import components
from daybook.session import checkpoint_dir
from tests.llm.helpers import SCHEMA, messy

PARAGRAPHS = "".join(f"<p>Paragraph {k} says something of some length about the matter at hand.</p>" for k in range(6))
REMARKS = "".join(f"<div>Reader {k} says a lot more than all that stands above, at considerable length, again and again.</div>" for k in range(12))
BOXES = ['<div class="comments">{}</div>', '<div id="comments">{}</div>', "<footer>{}</footer>", "<aside>{}</aside>", "<form>{}</form>"]


@pytest.mark.parametrize("box", BOXES)
@pytest.mark.parametrize("title", ["<h1>Title</h1>", ""])
def test_longer_marked_boxes_never_replace_the_text(box, title):
    text = html_extract.main_text(f"<html><body><div class='page'>{title}{PARAGRAPHS}</div>{box.format(REMARKS)}</body></html>")
    assert text.count("Paragraph") == 6 and "Reader" not in text and text.startswith("Title" if title else "Paragraph")


def test_what_holds_all_is_kept():
    inside = f"<h1>Title</h1>{PARAGRAPHS}"
    for page in (f"<form id='aspnetForm'>{inside}</form><p>Copyright</p>", f"<div class='sidebar'>{PARAGRAPHS}</div>"):
        assert html_extract.main_text(f"<html><body>{page}</body></html>").count("Paragraph") == 6


def test_text_directly_on_the_path_is_kept():
    page = "<html><body>An opening sentence stands directly in the body.<div>Lead text directly in the outer node.<section><p>One paragraph of text.</p><p>Another one follows here.</p></section></div></body></html>"
    assert html_extract.main_text(page).split("\n") == [
        "An opening sentence stands directly in the body.", "Lead text directly in the outer node.", "One paragraph of text.", "Another one follows here.",
    ]


@pytest.mark.parametrize("piece", ["<a ", "x</b>", "<b>x</i>", "<textarea>x", '<a ">', "<li>x", "<!-- x ", "<span>", "<script>x", "<td>x", "<a '"])
def test_broken_markup_takes_linear_time(piece):
    began = time.process_time()
    html_extract.main_text("<p>" + piece * (2_000_000 // len(piece)))
    assert time.process_time() - began < 10


def test_all_given_pages_hold_their_article(spark, sf01_dir):
    """Every page's text is that of its article element, tags dropped, whatever stands around it."""
    import re

    pages = spark.read.parquet(f"{sf01_dir}/pages.parquet")
    got = {r["page_id"]: r["text"] for r in html_extract.extract(pages).collect()}
    for r in pages.collect():
        article = re.search(r"<article.*?>(.*)</article>", r["html"] or "", re.S)
        if article is None:
            continue
        inner = re.sub(r"<(script|style|aside|nav|form|footer)\b.*?</\1>", " ", article[1], flags=re.S)
        words = re.findall(r"[A-Za-z]{4,}", re.sub(r"<[^>]*>|&#?\w+;", " ", got[r["page_id"]]))
        plain = re.sub(r"<[^>]*>|&#?\w+;", " ", inner)
        assert words and set(words) <= set(re.findall(r"[A-Za-z]{4,}", plain)), r["page_id"]


def clashing(spark):
    rows = [(*r, *"abcdefg") for r in (x[:4] for x in [(0, "one two", "en", "a"), (1, "onetwo", "en", "a"), (2, "three four five", "en", "b")])]
    extra = ["_len", "_sha", "_one", "_mix", "c0", "keep_id", "sha"]
    return spark.createDataFrame(rows, [f.name for f in SCHEMA.fields[:4]] + extra)


def test_any_column_names_pass_through(spark):
    docs = clashing(spark)
    for out in (exact_dedup.drop_copies(docs), mixing.mixed(docs, target_entropy=0.9, max_epochs=1.0), language_id.accepted(docs)):
        assert out.columns == docs.columns
        for r in out.collect():
            assert tuple(r)[4:] == tuple("abcdefg")
    assert sorted(r["doc_id"] for r in exact_dedup.drop_copies(docs).collect()) == [0, 2]


def test_roles_of_turn_rows_stay(spark):
    rows = spark.createDataFrame([(1, 0, "human", "hi"), (1, 1, "bot", "yo"), (1, 2, "assistant", "ok")], "conv_id long, turn long, role string, text string")
    out = chat_format.digest(chat_format.format_chats(chat_format.table_turns(rows))).collect()[0]
    import hashlib

    assert out["loss_chars"] == 2
    assert out["turns_sha256"] == hashlib.sha256(b"human\nhi\nbot\nyo\nassistant\nok\n").hexdigest()


def test_language_sample_is_whole_texts_within_its_bound(spark):
    """Null and repeated ids: the bound holds exactly, copies count once, texts come whole; ids play no part."""
    rows = [(None, f"le texte {k} " * 30, "fr") for k in range(300)] + [(7, "same text " * 50, "en")] * 300 + [(k, f"english text {k}", "en") for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = language_id.sample(docs, 25)
    by = {x: [t for lang, t in got if lang == x] for x in ("fr", "en")}
    assert 0 < len(by["fr"]) <= 25 and 0 < len(by["en"]) <= 25 and len(set(by["en"])) == len(by["en"])
    texts = {t.encode() for _, t, _ in rows}
    assert all(t in texts for _, t in got)
    ids = docs.withColumn("doc_id", F.lit(None).cast("long"))
    assert {t for lang, t in language_id.sample(ids, 25) if lang == "fr"} == set(by["fr"])


def test_least_probability_keeps_clean_texts(spark, sf01_dir):
    docs = spark.read.parquet(f"{sf01_dir}/documents.parquet")
    net = language_id.fit(docs)
    assert 1 / len(net.languages) <= net.least < 1
    kept = language_id.accepted(docs)
    spoken = docs.where(F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    assert spoken.count() - kept.count() <= 0.01 * spoken.count()


def test_quality_sample_is_bounded(spark):
    docs = spark.createDataFrame([(None if k % 3 else 1, f"text {k} " * (k % 17 + 1)) for k in range(600)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (None, 0)], "doc_id long, quality int")
    assert quality.quality(docs, labels, max_train=50).count() == 600


def test_components_of_a_long_chain(spark):
    chain = spark.range(400).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert components(chain).select("component").distinct().collect()[0][0] == 0
    assert messy(spark).columns  # the helper's names stay as they are


def many_texts() -> list[tuple[int, str, str]]:
    words = {"en": "the house and a tree with some water", "fr": "la maison et un arbre avec de l'eau", "de": "das Haus und ein Baum mit etwas Wasser"}
    return [(k, " ".join([words[x].split()[(k * j) % 7] for j in range(1, 40)]) + f" {k}", x) for k in range(360) for x in (list(words)[k % 3],)]


def test_pipeline_language_learns_from_every_text(spark):
    """A text that the start isn't chosen from moves the weights, too; the gradient doesn't hang on the partitions."""
    schema = "doc_id long, text string, lang string"
    docs = spark.createDataFrame(many_texts(), schema).cache()
    start = {t for _, t in language_id.sample(docs, 20)}
    learned = language_id.labelled(docs).select("lang", "text")
    seen = learned.where(~F.col("text").isin([t.decode() for t in start]))
    assert seen.count() > 150
    first, again = language_id.fit(docs, 20, every=True), language_id.fit(docs.repartition(7), 20, every=True)
    assert all(np.allclose(first.p[k], again.p[k], atol=1e-4) for k in first.p)
    one = seen.orderBy("text").first()["text"]
    other = docs.withColumn("text", F.when(F.col("text") == one, F.lit("~~~~ zzzz " * 30)).otherwise(F.col("text")))
    net = language_id.fit(other, 20, every=True)  # of the tenth that calibrates, it moves the least probability
    assert net.least != first.least or any(not np.allclose(net.p[k], first.p[k], atol=1e-4) for k in net.p)
    kept = language_id.accepted(docs, per_language=20)
    assert kept.count() >= 0.99 * docs.count()


def test_gradient_over_all_rows_is_the_plain_one(spark):
    net = language_id.ByteNetwork(["de", "en", "fr"])
    rows = many_texts()[:60]
    total: dict[str, int] = {}
    for _, t, x in rows:
        total[x] = total.get(x, 0) + len(t.encode())
    want = {k: np.zeros(a.shape) for k, a in net.p.items()}
    for x in net.languages:
        parts = [w for _, t, y in rows if x == y for w in language_id.windows(t.encode())]
        for k, g in net.gradients(language_id.padded(parts), np.full(len(parts), net.languages.index(x))).items():
            want[k] += g / 3
    for parts in (1, 5):
        got = language_id.gradient(net, spark.createDataFrame([(x, t) for _, t, x in rows], "lang string, text string").repartition(parts), total)
        assert all(np.allclose(got[k], want[k], atol=1e-5) for k in want)


def test_gradients_cost_a_task_no_more_than_the_driver():
    """A task gets an unpickled network; the dtypes of its arrays are other objects than numpy's own, which np.add.at takes a slow path for."""
    net = language_id.ByteNetwork(["de", "en", "fr"])
    sent = pickle.loads(pickle.dumps(net))
    x, y = np.random.default_rng(3).integers(97, 123, (128, 512)), np.zeros(512, int)

    def seconds(one):
        began = time.process_time()
        one.gradients(x, y)
        return time.process_time() - began

    here, there = (min(seconds(one) for _ in range(7)) for one in (net, sent))
    assert there < 2 * here
    own, other = net.gradients(x, y), sent.gradients(x, y)
    assert all(np.array_equal(own[k], other[k]) for k in own)


def test_the_driver_gives_the_memory_of_the_sample_back(spark, monkeypatch):
    done, learn = [], language_id.learn
    monkeypatch.setattr(language_id, "learn", lambda net, rows: done.append("learn") or learn(net, rows))
    monkeypatch.setattr(language_id, "trimmed", lambda: done.append("trimmed"))
    docs = spark.createDataFrame(many_texts(), "doc_id long, text string, lang string")
    language_id.fit(docs, 20, every=True)
    assert done == ["learn", "trimmed"]


def embedding_links(x, label, cosine=0.93):
    """Links of each row and the smallest row reachable by links, all pairs compared."""
    u = x / np.linalg.norm(x, axis=1)[:, None]
    link = (u @ u.T >= cosine) & (label[:, None] == label[None, :])
    low = np.arange(len(x))
    while True:
        new = np.where(link, low[None, :], len(x)).min(1)
        if (new == low).all():
            return link.sum(1) - 1, low
        low = new


def embedded(spark, x, label, kind):
    return spark.createDataFrame([(k, v.tolist(), int(c)) for k, (v, c) in enumerate(zip(x, label, strict=True))], f"vec_id long, embedding array<{kind}>, label int")


def links_of(out):
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in out.collect()}
    return [[got[k][i] for k in sorted(got)] for i in (0, 1)]


def test_embeddings_are_not_written_for_each_list_they_query(spark, monkeypatch):
    """Spread vectors query most lists: a copy for each once took more memory than an executor has."""
    monkeypatch.setattr(pq_dedup, "LIST_SIZE", 10)
    rng = np.random.default_rng(4)
    x = rng.normal(size=(2000, 32))
    x[100:160] = x[100] + rng.normal(scale=0.1, size=(60, 32))
    x, label = x.astype(np.float32).astype(float), np.ones(2000, int)
    there = Path(checkpoint_dir(spark).removeprefix("file:"))
    before = set(there.iterdir())
    n, low = links_of(pq_dedup.near_duplicates(embedded(spark, x, label, "float")))
    written = sum(f.stat().st_size for d in set(there.iterdir()) - before for f in d.rglob("*.parquet"))
    assert written < 6 * x.size * 4
    want, lowest = embedding_links(x, label)
    assert n == want.tolist() and low == lowest.tolist() and want.sum() > 3000


@pytest.mark.parametrize("kind", ["float", "double"])
def test_embeddings_of_a_label_in_several_blocks(spark, monkeypatch, kind):
    monkeypatch.setattr(pq_dedup, "BLOCK_BYTES", 8192)
    monkeypatch.setattr(pq_dedup, "LIST_SIZE", 20)
    rng = np.random.default_rng(5)
    x = np.concatenate([np.repeat(rng.normal(size=(60, 16)), 10, axis=0) + rng.normal(scale=0.12, size=(600, 16)), rng.normal(size=16) + rng.normal(scale=0.05, size=(500, 16)), rng.normal(size=(100, 16))])
    x = x.astype(np.float32).astype(float)[rng.permutation(len(x))]
    x[-40:] = x[:40]  # equal vectors
    label = rng.choice(3, len(x), p=[0.8, 0.15, 0.05])
    label[-40:] = label[:40]
    n, low = links_of(pq_dedup.near_duplicates(embedded(spark, x, label, kind), max_train=300))
    want, lowest = embedding_links(x, label)
    assert n == want.tolist() and low == lowest.tolist() and want.max() > 300


def test_embeddings_on_the_border_are_told_in_double_precision(spark):
    """Cosines of 0.93 less or more than single precision can tell, on which one group's many pairs and single pairs depend."""
    rng = np.random.default_rng(6)
    axes = np.linalg.qr(rng.normal(size=(24, 24)))[0]
    x, label = [], []
    for k in range(12):
        for c, off in ((axes[0], 1e-9), (axes[1], -1e-9)):
            at = 0.93 + off
            x += [c * (k + 1), (at * c + math.sqrt(1 - at * at) * axes[2 + k]) * 3]
            label += [k, k]
    x, label = np.array(x), np.array(label)
    n, _ = links_of(pq_dedup.near_duplicates(embedded(spark, x, label, "double")))
    assert n == [1, 1, 0, 0] * 12


def test_each_list_is_held_by_the_blocks_of_its_classes():
    sizes = np.array([0, 5, 0, 0, 100, 3, 0])
    layout = pq_dedup.Layout(4, sizes)
    for k in range(len(sizes)):
        blocks = layout.block(np.full(300, k), np.arange(300) << 33)
        assert layout.holds[k, blocks].all()
    assert set(layout.block(np.full(300, 4), np.arange(300))) == {0, 1, 2, 3}
