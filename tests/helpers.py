"""Row comparison helpers shared by the tests."""

import math
from datetime import date, datetime

from pyspark.sql import SparkSession

from daybook.sources.tables import SCHEMAS, Sources


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if hasattr(v, "item"):
        return norm(v.item())
    try:
        import pandas as pd

        if v is pd.NA:
            return None
    except Exception:
        pass
    return v


def rows(pdf):
    cols = sorted(pdf.columns)
    out = [tuple(norm(x) for x in r) for r in pdf[cols].itertuples(index=False)]
    return cols, sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def spark_rows(df, cols=None):
    cols = cols or df.columns
    out = [tuple(norm(r[c]) for c in cols) for r in df.select(*cols).collect()]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def make_sources(spark: SparkSession, member=(), profile=(), login=(), billing=(), tutorial_end=()) -> Sources:
    """Small hand-built sources for policy tests (row tuples in schema order)."""

    def df(name, data):
        return spark.createDataFrame(list(data), SCHEMAS[name])

    return Sources(
        member=df("member", member),
        profile=df("profile", profile),
        login=df("login", login),
        billing=df("billing", billing),
        tutorial_end=df("tutorial_end", tutorial_end),
    )


def ts(s: str) -> datetime:
    return datetime.fromisoformat(s)


def d(s: str) -> date:
    return date.fromisoformat(s)
