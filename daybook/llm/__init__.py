"""Training-data operators (deduplication, scoring, formatting, mixing, packing, sharding) as Spark jobs.

Nothing outside this subpackage, ``corpus_pipeline.py`` and ``tests/llm`` imports it.
"""
