import os

import pytest

from punctual.llm.queries import oracle_sql, queries

SMALL = "/root/testdata/sf0.001"


def test_registry():
    assert {"p1_percentiles", "p7_ids", "p8_found", "p9_found"} <= set(queries()) and set(oracle_sql()) <= set(queries())


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")
@pytest.mark.parametrize("name", list(queries()))
def test_runs(spark, name):
    df = queries()[name](spark, SMALL)
    assert df.count() >= 0
    if name == "p7_ids":
        assert df.columns == ["doc_id", "ids"]
