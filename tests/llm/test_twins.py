"""Queries of the operators beside their SQL twins."""

from collections import Counter

import pytest

from clipwire.checks.compare import connect
from clipwire.llm.queries import llm_queries
from clipwire.llm.sql import llm_sql


@pytest.mark.parametrize("name", sorted(llm_sql()))
def test_same_rows(spark, name):
    sf = "/root/testdata/sf0.001"
    df = llm_queries()[name](spark, sf)
    columns = sorted(df.columns)
    con = connect(sf)
    rel = con.sql(llm_sql()[name])
    assert sorted(rel.columns) == columns
    assert Counter(map(tuple, df.select(*columns).collect())) == Counter(rel.project(", ".join(columns)).fetchall())
    con.close()
