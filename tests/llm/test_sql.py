"""Queries against their SQL on the smallest tables."""

import pytest
from oracle import arrow, database, differences

from labelweave.llm.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, name):
    got = arrow(QUERIES[name](spark, SF))
    assert differences(got, database(SF).sql(ORACLES[name]).to_arrow_table()) == []


def test_names():
    wanted = [f"op{n}_" for n in range(1, 14)]
    assert [q.split("_")[0] + "_" for q in QUERIES if q != "pipeline"] == wanted
    assert "pipeline" in QUERIES
