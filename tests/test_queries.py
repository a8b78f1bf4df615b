"""Every registered query against its SQL."""

from __future__ import annotations

import pytest

from vidlake.checks import compare
from vidlake.checks.oracles import ORACLES
from vidlake.checks.queries import QUERIES, _dated
from vidlake.operators.cleaning import drop_incomplete

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SF_DIR)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    assert compare.difference(spark, duck, SF_DIR, name) == ""


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.oracle_sql().keys() <= entry.queries().keys()
    assert QUERIES.keys() <= entry.oracle_sql().keys()
    top = entry.entry(spark)
    assert top.columns == ["channel_title", "total_views"] and 0 < top.count() <= 10


def test_row_counts_of_the_fixture(spark):
    """Counts measured when the fixture was laid down, at the next scale."""
    sf_dir = "/root/testdata/sf0.01"
    assert QUERIES["row_count"](spark, sf_dir).first().n_rows == 60_000
    complete = drop_incomplete(_dated(spark, sf_dir))
    assert complete.count() == 57_656
    assert QUERIES["clean_videos"](spark, sf_dir).count() == 44_512
    assert QUERIES["channel_rollup"](spark, sf_dir).count() == 100
    assert QUERIES["daily_rollup"](spark, sf_dir).count() == 2_499
    ties = complete.groupBy("video_id", "extraction_date", "published_date").count()
    assert ties.filter("count > 1").count() == 8
