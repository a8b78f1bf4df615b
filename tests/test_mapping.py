from __future__ import annotations

import datetime as dt

import pytest
from pyspark.errors import AnalysisException

from vidlake.operators import mapping
from vidlake.schemas import CANONICAL, CSV_NAMES


def historical(spark, columns=tuple(CSV_NAMES) + ("tags",)):
    row = {
        "video_id": "v1",
        "trending_date": "17.14.11",
        "title": "t",
        "channel_title": "c",
        "category_id": "10",
        "publish_time": "2017-11-13T00:00:00Z",
        "views": "5",
        "likes": "x",
        "comment_count": "2",
        "description": None,
        "tags": "ignored",
    }
    schema = ", ".join(f"{c} string" for c in columns)
    return spark.createDataFrame([tuple(row[c] for c in columns)], schema)


def bronze(spark):
    row = ("b1", "t", "ch", "c", "2024-01-05T00:00:00Z", 7, 1, 0, "2024-02-01")
    return spark.createDataFrame(
        [row],
        "video_id string, title string, channel_id string, channel_title string,"
        " published_date string, views bigint, likes bigint, comments bigint,"
        " extraction_date string",
    )


def test_mapping_renames_and_drops_the_rest(spark):
    mapped = mapping.apply_mapping(historical(spark), CSV_NAMES)
    assert mapped.columns == list(CSV_NAMES.values())
    row = mapped.first()
    assert (row.extraction_date, row.channel_id, row.comments) == ("17.14.11", "10", "2")


def test_mapping_leaves_absent_columns_out(spark):
    mapped = mapping.apply_mapping(bronze(spark), {"video_id": "video_id", "nope": "other"})
    assert mapped.columns == ["video_id"]


def test_fill_text_fills_absent_and_null(spark):
    assert mapping.fill_text(bronze(spark), "description").first().description == ""
    frame = spark.createDataFrame([("a",), (None,)], "description string")
    assert [r.description for r in mapping.fill_text(frame, "description").collect()] == ["a", ""]


def test_align_orders_and_refuses_absent_columns(spark):
    shuffled = mapping.unified(historical(spark)).select(*reversed(CANONICAL))
    assert mapping.align(shuffled).columns == list(CANONICAL)
    with pytest.raises(AnalysisException):
        mapping.align(shuffled.drop("views")).collect()


def test_silver_rows(spark):
    rows = mapping.silver_rows(historical(spark), bronze(spark))
    assert dict(rows.dtypes)["views"] == "bigint"
    assert dict(rows.dtypes)["year"] == "int"
    got = {r.video_id: r for r in rows.collect()}
    assert (got["v1"].views, got["v1"].likes, got["v1"].comments) == (5, None, 2)
    assert got["v1"].description is None and got["b1"].description == ""
    assert (got["v1"].year, got["v1"].month, got["v1"].day) == (2017, 11, 13)


def test_unreadable_date_keeps_its_row(videos):
    row = mapping.silver_rows(bronze=videos({"published_date": "junk"})).first()
    assert (row.published_date, row.year, row.month, row.day) == ("junk", None, None, None)


def test_nothing_to_unify():
    with pytest.raises(ValueError):
        mapping.unified()


def test_stamp_run_date(spark):
    stamped = mapping.stamp_run_date(spark.range(1), dt.date(2024, 2, 3))
    assert stamped.first().extraction_date == "2024-02-03"
