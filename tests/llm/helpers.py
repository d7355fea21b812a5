"""Brute-force models and small messy tables."""

import re
from collections import defaultdict

from pyspark.sql import types as T

MESSY = [
    (0, "The quick brown fox jumps over the lazy dog again and again today.", "en", "a"),
    (1, "the QUICK brown fox jumps over the lazy dog again and again today.", "en", "a"),
    (2, "Thequickbrown fox jumps over the lazy dog again and again today.", None, None),
    (3, None, "en", "b"),
    (4, "", "fr", "b"),
    (5, " \n\t ", "fr", "b"),
    (6, "123 456 !!", "en", "c"),
    (7, "mot", "fr", "c"),
    (8, "x" * 5000, "en", "a"),
    (9, "le chat est sur la table et il dort très bien " * 300, "fr", "d"),
    (9, "le chat est sur la table et il dort très bien " * 300, "fr", "d"),
    (10, "a b c d e f g h i j k l m n o p q r s t", "en", "a"),
    (11, "a b c d e f g h i j k l m n o p q r s t u", "en", "a"),
    (None, "no id here but some words", "en", None),
]
SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        *(T.StructField(n, T.StringType()) for n in ("digest", "rank", "block", "row", "cid")),  # names that operators use inside
    ]
)


def messy(spark):
    return spark.createDataFrame([(*r, *"vwxyz") for r in MESSY], SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()


def similar_components(docs):
    """Smallest id reachable by links of J >= 0.8, all pairs compared; docs: (id, text) with ids."""
    sets, parent = defaultdict(list), {}
    for i, t in docs:
        sets[i].append(shingle_set(t))
        parent[i] = i

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[n:]:
            if any(a and b and 100 * len(a & b) >= 80 * len(a | b) for a in sets[i] for b in sets[j]):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}
