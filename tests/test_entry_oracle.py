"""Driver contract and the oracle comparison of every registered query (sf0.001)."""

import os

import pytest

import __spark_entry__ as E
from tests.oracle_compare import compare

SF = "/root/testdata/sf0.001"


def test_contract_keys():
    qs, sqls = E.queries(), E.oracle_sql()
    assert qs and set(sqls) <= set(qs)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "technology_name" in df.columns


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
def test_all_queries_match_oracle(spark):
    res = compare(spark, SF, verbose=False)
    bad = {k: v for k, v in res.items() if v[0] not in ("ok", "no-oracle")}
    assert not bad, bad
