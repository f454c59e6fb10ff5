"""Every registered query against its SQL on the smallest tables."""

import html

import pytest

from __spark_entry__ import entry
from labelweave.queries import ORACLES, QUERIES
from oracle import arrow, database, differences

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return database(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, con, name):
    got = arrow(QUERIES[name](spark, SF))
    want = con.sql(ORACLES[name]).to_arrow_table()
    assert differences(got, want) == []


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0


def test_html_unescape_on_awkward_entities(spark):
    from pyspark.sql import functions as F

    from labelweave.functions import html_unescape

    texts = [
        "a &amp; b", "&amp;lt;", "&amp;amp;", "&lt;b&gt; &eacute; &#233; &#xE9;", "AT&T &copy 1",
        "&notit; &ampx", "fish & chips &", "&#39;x&#39; &quot;", "&é", "&1;", None, "",
    ]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(html_unescape(F.col("t"))).collect()]
    assert got == [None if t is None else html.unescape(t) for t in texts]
