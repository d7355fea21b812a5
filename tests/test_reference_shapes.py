"""The reference's literal query shapes (Spark SQL, comparison only) give the
same rows as the library's rewrites."""

import pytest

from daybook.config import FIXTURE_CONFIG as CFG
from daybook.plans import daily
from daybook.sources.fixtures import fixture_sources
from helpers import spark_rows
from scripts.reference_shapes import dau_day_literal, rau_day_literal


@pytest.fixture(scope="module")
def src(spark):
    return fixture_sources(spark, "/root/testdata/sf0.01")


@pytest.mark.parametrize("start", ["2024-01-01", "2024-01-15"])
def test_dau_literal_equals_rewrite(spark, src, start):
    cfg = CFG.replace(start=start)
    assert spark_rows(dau_day_literal(spark, src, cfg)) == spark_rows(daily.dau_day(cfg, src))


def test_rau_literal_equals_rewrite(spark, src):
    assert spark_rows(rau_day_literal(spark, src, CFG)) == spark_rows(daily.rau_day(CFG, src))
