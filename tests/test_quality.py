from __future__ import annotations

import pytest

from vidlake.operators.cleaning import clean_videos
from vidlake.operators.mapping import silver_rows
from vidlake.operators.quality import (
    QualityError,
    duplicate_keys,
    enforce,
    failed_rules,
    failures_in,
    missing_columns,
    null_counts,
    quality_report,
)


def counts(frame):
    return {r.rule: r.violations for r in quality_report(frame).collect()}


def test_report_counts_every_rule(videos):
    silver = silver_rows(
        bronze=videos(
            {"title": None},
            {"title": ""},
            {"views": "n/a"},
            {"views": "-5"},
            {"published_date": "junk", "video_id": "v2"},
            {"likes": "101", "comments": "102", "video_id": "v3"},
        )
    )
    got = counts(silver)
    assert got["rows"] == 6
    assert got["null_title"] == 1 and got["blank_title"] == 1
    assert got["null_views"] == 1 and got["negative_views"] == 1
    assert got["null_partition"] == 1
    # The negative view count is under its likes and comments as well.
    assert got["likes_over_views"] == 2 and got["comments_over_views"] == 2
    assert got["duplicate_snapshot"] == 3
    assert got["empty_table"] == 0 and got["missing_columns"] == 0


def test_clean_table_passes(videos):
    silver = silver_rows(bronze=videos({"likes": "500"}, {"views": "-5"}, {"title": None}))
    cleaned = clean_videos(silver)
    assert failed_rules(quality_report(cleaned)).isEmpty()
    enforce(cleaned)


def test_empty_table_fails(videos):
    empty = clean_videos(silver_rows(bronze=videos({"title": None})))
    assert [r.rule for r in failed_rules(quality_report(empty)).collect()] == ["empty_table"]
    with pytest.raises(QualityError) as caught:
        enforce(empty)
    assert caught.value.failures == ["empty_table: 1"]


def test_all_failures_come_at_once(videos):
    silver = silver_rows(bronze=videos({"title": None}, {"views": "-1"}))
    with pytest.raises(QualityError) as caught:
        enforce(silver)
    rules = {failure.split(":")[0] for failure in caught.value.failures}
    assert {"null_title", "negative_views", "duplicate_snapshot"} <= rules


def test_missing_columns(videos):
    silver = silver_rows(bronze=videos({}))
    short = silver.drop("title", "month")
    assert missing_columns(short) == ["title", "month"]
    assert counts(short)["missing_columns"] == 2
    with pytest.raises(QualityError, match="missing column title; missing column month"):
        enforce(short)
    upper = silver.withColumnRenamed("year", "Year")
    assert missing_columns(upper) == []


def test_null_counts_and_duplicates(videos):
    silver = silver_rows(bronze=videos({"title": None}, {"title": None, "views": "x"}))
    nulls = {r.column_name: r.nulls for r in null_counts(silver).collect()}
    assert nulls["title"] == 2 and nulls["views"] == 1 and nulls["likes"] == 0
    assert [tuple(r) for r in duplicate_keys(silver).collect()] == [("v1", "2024-02-01", 2)]
    nameless = silver_rows(bronze=videos({"extraction_date": None}, {"extraction_date": None}))
    assert duplicate_keys(nameless).first().n_rows == 2


def test_failures_in_skips_what_only_informs():
    assert failures_in({"rows": 5, "blank_title": 2, "null_title": 0, "x": 1}) == ["x: 1"]
