import os

import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) > 120


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")
def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["ImageID", "MaskPath", "tier", "message"]
    assert df.count() == 6000
