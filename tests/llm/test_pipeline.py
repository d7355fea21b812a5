"""The pipeline against its stages' definitions."""

import corpus_pipeline
from daybook.llm.common import materialise
from tests.llm.helpers import empty, messy, similar_components


def test_stages(spark, sf001_dir):
    docs = spark.read.parquet(f"{sf001_dir}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, sf001_dir), f"test-{name}")
        seen[name] = docs
        if name != "sequences":
            assert docs.columns == columns
    texts = [(r["doc_id"], r["text"]) for r in seen["language"].collect()]
    assert len(texts) == spark.read.parquet(f"{sf001_dir}/documents.parquet").count()  # all have letters
    best = {}
    for i, t in texts:
        key = "".join(t.split())
        best[key] = min(best.get(key, (0, i)), (-len(t), i))
    once = {i for _, i in best.values()}
    assert {r["doc_id"] for r in seen["exact_copies"].collect()} == once
    comp = similar_components([(i, t) for i, t in texts if i in once])
    near = {i for i, c in comp.items() if i == c}
    assert {r["doc_id"] for r in seen["near_copies"].collect()} == near
    assert {r["doc_id"] for r in seen["mixture"].collect()} == near
    assert {r["doc_id"] for r in seen["sequences"].collect()} == near


def test_messy_and_empty(spark, sf001_dir):
    for docs in (messy(spark), empty(spark)):
        docs = docs.withColumn("n_chars", docs["doc_id"])
        for name, stage in corpus_pipeline.STAGES:
            docs = materialise(stage(spark, docs, sf001_dir), f"test-{name}")
    assert docs.count() == 0
