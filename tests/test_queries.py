"""Every registered query against its SQL."""

from __future__ import annotations

import pytest
from compare import differences, oracle

from __spark_entry__ import entry, oracle_sql, queries


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle(sf_dir)


@pytest.mark.parametrize("name", list(queries()))
def test_query(spark, sf_dir, con, name):
    df = queries()[name](spark, sf_dir)
    if name in oracle_sql():
        assert differences(df, con, oracle_sql()[name]) == []
    else:
        assert df.count() > 0


def test_entry(spark):
    assert {r.reason for r in entry(spark).collect()} >= {"ok", "duplicate_sha1"}


def test_the_comparison_sees_differences(spark, con):
    df = spark.createDataFrame([(1, 0.5)], "a bigint, b double")
    assert differences(df, con, "SELECT 1::BIGINT AS a, 0.5::DOUBLE AS b") == []
    assert differences(df, con, "SELECT 1::BIGINT AS a, 0.6::DOUBLE AS b")
    assert differences(df, con, "SELECT 1::INTEGER AS a, 0.5::DOUBLE AS b")
    assert differences(df, con, "SELECT 1::BIGINT AS a, 0.5::DOUBLE AS c")
    assert differences(df, con, "SELECT 1::BIGINT AS a, 0.5::DOUBLE AS b UNION ALL SELECT 1, 0.5")
