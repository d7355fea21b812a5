"""Methods against plain Python: the k-d tree, block permutations, additive scores, byte labels, copies that go."""

import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from daybook.llm import exact_dedup, language_id, mixing, quality, queries, sharding
from tests.conftest import duck_for
from tests.llm.helpers import empty, messy


def tree_shards(rows, shards, first=0):
    """(id, shard) of each row by recursion over lists; rows: dicts of ``measured`` with scaled coordinates."""
    if shards == 1 or not rows:
        return [(r["doc_id"], first) for r in rows]
    total, half = sum(r["size"] for r in rows), shards // 2

    def spread(d):
        mean = sum(r["size"] * r[d] for r in rows) / total
        return sum(r["size"] * (r[d] - mean) ** 2 for r in rows) / total

    dim = max(sharding.DIMS, key=spread)
    key = {id(r): (r[dim] << 32) + r["text_crc32"] for r in rows}
    want = total * half / shards

    def border(part, value, goal):
        before = 0
        for v in sorted({value(r) for r in part}):
            here = sum(r["size"] for r in part if value(r) == v)
            if before + here >= goal:
                break
            before += here
        return v, before, here

    v, before, here = border(rows, lambda r: key[id(r)], want)
    near, cut = 0.002 * max(1.0, want / half), (v, 0)
    if want - before > near:
        if before + here - want <= near:
            cut = (v + 1, 0)
        else:
            copies = [r for r in rows if key[id(r)] == v]
            cut = (v, border(copies, lambda r: r["id_hash"], want - before)[0] + 1)
    left = [r for r in rows if (key[id(r)], r["id_hash"]) < cut]
    right = [r for r in rows if (key[id(r)], r["id_hash"]) >= cut]
    return tree_shards(left, half, first) + tree_shards(right, shards - half, first + half)


@pytest.mark.parametrize("shards", [5])
def test_tree_equals_recursion(spark, sf001_dir, shards):
    docs = spark.read.parquet(f"{sf001_dir}/documents.parquet").select("doc_id", "text")
    hot = spark.range(150).select((F.col("id") + 10**6).alias("doc_id"), F.repeat(F.lit("one copy of many "), 300).alias("text"))
    docs = docs.unionByName(hot)  # a group of copies too heavy for any border
    rows = [r.asDict() for r in sharding.measured(docs, "doc_id", "text").collect()]
    for d in sharding.DIMS:
        lo, hi = min(r[d] for r in rows), max(r[d] for r in rows)
        for r in rows:
            r[d] = int((r[d] - lo) / (hi - lo) * ((1 << 20) - 1))
    want = sorted(tree_shards(rows, shards))
    got = sharding.kd_shards(docs, shards=shards).collect()
    assert sorted((r["doc_id"], r["shard"]) for r in got) == want
    assert {k for _, k in want} == set(range(shards))


def test_shards_of_target_bytes(spark, sf001_dir):
    docs = spark.read.parquet(f"{sf001_dir}/documents.parquet")
    total = docs.select(F.sum(F.octet_length(F.coalesce("text", F.lit(""))) + 1)).first()[0]
    out = sharding.kd_shards(docs, target_bytes=-(-total // 3)).groupBy("shard").agg(F.sum("size").alias("b")).collect()
    assert sorted(r["shard"] for r in out) == list(range(3))


def test_tree_plan_does_not_grow_with_the_shards(spark):
    rows = sharding.measured(spark.range(300).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text")), "doc_id", "text")
    few, many = (sharding.kd_tree(rows, n)._jdf.queryExecution().toString() for n in (2, 6))
    assert len(many) < 1.2 * len(few)


def test_block_permutations_agree_with_sql(spark, sf001_dir):
    small = 256
    sql = queries.mix_sql(small)
    got = mixing.schedule(queries.table(spark, sf001_dir, "documents"), target_entropy=queries.MIX_ENTROPY, max_epochs=queries.MIX_EPOCHS, block_tokens=small)
    cols = sorted(got.columns)
    rows = list(map(tuple, got.select(*cols).collect()))
    want = duck_for(sf001_dir).sql(f"SELECT {', '.join(cols)} FROM ({sql})").fetchall()
    assert sorted(map(str, rows)) == sorted(map(str, want))
    slots = {(r["source"], r["epoch"]): set() for r in got.select("source", "epoch").distinct().collect()}
    orders = {k: {} for k in slots}
    for r in got.select("source", "epoch", "slot", "block", "start").distinct().collect():
        slots[r["source"], r["epoch"]].add(r["slot"])
        orders[r["source"], r["epoch"]][r["slot"]] = r["block"]
    assert max(len(s) for s in slots.values()) > 5  # many blocks a source
    for (source, epoch), order in orders.items():  # each epoch has its own order of the blocks it shares
        if epoch and len(order) > 5:
            assert [order[k] for k in sorted(order)] != [orders[source, 0][k] for k in sorted(order)]


def test_scores_equal_table_look_ups(spark, sf001_dir):
    docs = spark.read.parquet(f"{sf001_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf001_dir}/labels.parquet")
    measured = docs.select("doc_id", quality.held_out(F.col("doc_id"), 5, 0).alias("held_out"), *quality.features(F.col("text")))
    model = quality.train(measured, labels)
    got = {r["doc_id"]: r for r in quality.quality(docs, labels).collect()}
    assert model.pairs and any(np.any(t) for t in model.tables)
    for r in measured.collect():
        x = [float(r[f]) for f in quality.FEATURES]
        total = model.base
        for v, edges, values in zip(x, model.edges, model.tables, strict=True):
            total += values[sum(1 for e in edges if e <= v)]
        for i, j, values in model.pairs:
            total += values[sum(1 for e in model.coarse[i] if e <= x[i]), sum(1 for e in model.coarse[j] if e <= x[j])]
        score = 1 / (1 + np.exp(-total))
        assert got[r["doc_id"]]["score"] == pytest.approx(score, abs=1e-9)
        assert got[r["doc_id"]]["predicted"] == int(score >= 0.3)
        assert got[r["doc_id"]]["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)


def read(net, data, side):
    """States after each byte, one scalar at a time, from the equations of the unit."""
    n, w, u = net.h, net.p[f"w{side}"].astype(float), net.p[f"u{side}"].astype(float)
    h, out = [0.0] * n, []
    for byte in data:
        a = [w[byte][k] + sum(h[m] * u[m][k] for m in range(n)) for k in range(2 * n)]
        gate = [min(1.0, max(0.0, v / 4 + 0.5)) for v in a]
        c = [w[byte][2 * n + k] + gate[n + k] * sum(h[m] * u[m][2 * n + k] for m in range(n)) for k in range(n)]
        h = [gate[k] * h[k] + (1 - gate[k]) * c[k] / (1 + abs(c[k])) for k in range(n)]
        out.append(h)
    return out


def test_labels_equal_plain_recurrence(spark, sf001_dir):
    docs = spark.read.parquet(f"{sf001_dir}/documents.parquet")
    net = language_id.fit(docs)
    schema = docs.select("doc_id").schema.add("lang_pred", "string").add("score", "double")
    some = docs.where("length(text) between 1 and 900").orderBy("doc_id").limit(12)
    spoken = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("spoken")
    got = {r["doc_id"]: r for r in language_id.predict(some.select("doc_id", "text", spoken), net, schema).collect()}
    v, c = net.p["v"].astype(float), net.p["c"].astype(float)
    for r in some.collect():
        if not re.search(r"[^\W\d_]", r["text"]):
            continue
        data, sums = r["text"].encode(), np.zeros(len(net.languages))
        for part in language_id.windows(data):
            forwards, backwards = read(net, part, "f"), read(net, part[::-1], "b")[::-1]
            for f, b in zip(forwards, backwards, strict=True):
                y = np.exp(np.array(f + b) @ v + c)
                sums += y / y.sum()
        p = sums / len(data)
        assert got[r["doc_id"]]["lang_pred"] == net.languages[int(p.argmax())]
        assert got[r["doc_id"]]["score"] == pytest.approx(p.max(), abs=1e-4)


@pytest.mark.parametrize("threshold", ["10485760", "-1"])
def test_copies_that_go(spark, threshold):
    """Repeats of one id and text, copies under a null id, hot copies; with and without broadcasts."""
    rows = [(1, "a b", "x"), (1, "a  b", "y"), (2, "ab", "z"), (None, "c", "n"), (None, "c", "m"), (3, " c", "k"), (4, None, "e"), (5, "", "f"), (6, "alone", "g")]
    rows += [(100 + k % 40, "hot  copy" if k == 77 else "hot copy", str(k)) for k in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, on_id string")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        got = sorted(map(tuple, exact_dedup.drop_copies(docs).collect()), key=str)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert [r for r in got if r[0] == 1] == [(1, "a  b", "y")]
    assert [r for r in got if r[1] and "hot" in r[1]] == [(100 + 77 % 40, "hot  copy", "77")]
    assert (3, " c", "k") in got and not [r for r in got if r[0] is None]
    assert (4, None, "e") in got and (6, "alone", "g") in got and len(got) == 5
    assert exact_dedup.drop_copies(empty(spark)).count() == 0
    assert sorted(exact_dedup.drop_copies(messy(spark)).columns) == sorted(messy(spark).columns)
