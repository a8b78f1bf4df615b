from __future__ import annotations

import datetime as dt

import pytest

from vidlake.operators.cleaning import (
    ROLLUP_COLUMNS,
    clean_videos,
    clamp_to_views,
    drop_incomplete,
    keep_latest,
    trim_text,
)
from vidlake.operators.mapping import silver_rows
from vidlake.operators.rollups import channel_rollup, daily_rollup


def clean(frame, **options):
    return clean_videos(silver_rows(bronze=frame), **options)


def test_trim_takes_spaces_only(videos):
    rows = trim_text(videos({"title": "  a b "}, {"title": " \ta \n "}, {"title": "   "}))
    assert [r.title for r in rows.collect()] == ["a b", "\ta \n", ""]


def test_trim_skips_absent_columns(videos):
    assert "description" not in trim_text(videos({}).drop("description")).columns


@pytest.mark.parametrize(
    "change",
    [
        {"title": None},
        {"video_id": None},
        {"channel_title": None},
        {"published_date": None},
        {"published_date": "junk"},
        {"views": None},
        {"views": "n/a"},
        {"likes": "12.7"},
        {"comments": None},
    ],
)
def test_incomplete_rows_go(videos, change):
    assert clean(videos(change, {"video_id": "kept"})).count() == 1


@pytest.mark.parametrize("change", [{"title": "   "}, {"description": None}, {"channel_id": None}])
def test_these_rows_stay(videos, change):
    assert clean(videos(change)).count() == 1


def test_drop_incomplete_matches_dropna(videos):
    frame = videos({"title": None}, {"views": None}, {"channel_id": None}, {})
    assert drop_incomplete(frame).collect() == frame.dropna(subset=[
        "video_id", "title", "channel_title", "published_date", "views", "likes", "comments"
    ]).collect()


@pytest.mark.parametrize(
    "given, wanted",
    [
        (("-1", "5", "5"), (0, 0, 0)),
        (("5", "10", "20"), (5, 5, 5)),
        (("5", "-10", "-20"), (5, 0, 0)),
        (("5", "4", "3"), (5, 4, 3)),
    ],
)
def test_metrics_are_repaired(videos, given, wanted):
    row = clean(videos(dict(zip(("views", "likes", "comments"), given)))).first()
    assert (row.views, row.likes, row.comments) == wanted


def test_clamp_leaves_null(spark):
    frame = spark.sql("SELECT CAST(NULL AS BIGINT) views, 5L likes, CAST(NULL AS BIGINT) comments")
    assert tuple(clamp_to_views(frame).first()) == (None, 5, None)


def test_latest_publish_date_wins(videos):
    rows = clean(
        videos(
            {"published_date": "2024-01-05T00:00:00Z", "title": "old", "views": "900"},
            {"published_date": "2024-01-06T00:00:00Z", "title": "new"},
        )
    ).collect()
    assert [r.title for r in rows] == ["new"]
    assert rows[0].published_date == dt.date(2024, 1, 6)
    assert (rows[0].year, rows[0].month, rows[0].day) == (2024, 1, 6)


def test_ties_are_settled_by_value(videos):
    changes = [
        {"views": "100", "title": "b"},
        {"views": "200", "title": "z"},
        {"views": "200", "title": "a", "channel_title": "d"},
        {"views": "200", "title": "a"},
    ]
    for order in (changes, changes[::-1]):
        row = clean(videos(*order).repartition(3)).first()
        assert (row.views, row.channel_title, row.title) == (200, "c", "a")


def test_text_dates_order_as_text(videos):
    frame = silver_rows(bronze=videos({"published_date": "2024-01-05"}, {"published_date": "junk"}))
    assert keep_latest(frame).first().published_date == "junk"


def test_null_extraction_dates_are_one_group(videos):
    assert clean(videos({"extraction_date": None}, {"extraction_date": None})).count() == 1


def test_two_days_of_a_video_both_count(videos):
    frame = clean(videos({}, {"extraction_date": "2024-02-02", "views": "150"}))
    row = channel_rollup(frame).first()
    assert (row.total_videos, row.total_views) == (2, 250)


def test_channels_with_one_title_merge(videos):
    frame = clean(videos({"channel_id": "x"}, {"channel_id": "y", "video_id": "v2"}))
    assert channel_rollup(frame).count() == 1


def test_text_variant_keeps_unreadable_dates_in_a_null_day(videos):
    frame = videos({"published_date": "junk"}, {"video_id": "v2"})
    kept = clean(frame, published_as="text")
    assert dict(kept.dtypes)["published_date"] == "string"
    days = {r.year: r.total_videos for r in daily_rollup(kept).collect()}
    assert days == {None: 1, 2024: 1}
    assert daily_rollup(clean(frame)).count() == 1


def test_text_variant_types_after_dropping(videos):
    raw = videos({"views": "n/a"})
    silver = silver_rows(bronze=raw).drop("views", "likes", "comments")
    mixed = silver.join(raw.select("video_id", "views", "likes", "comments"), "video_id")
    kept = clean_videos(mixed, published_as="text").first()
    assert kept.views is None and kept.likes == 10
    assert clean_videos(mixed).count() == 0


def test_unknown_variant(videos):
    with pytest.raises(ValueError):
        clean(videos({}), published_as="timestamp")


@pytest.mark.parametrize("published_as", ["date", "text"])
def test_narrow_cleaning_gives_the_same_rollups(videos, published_as):
    changes = [
        {"title": t, "channel_title": c, "channel_id": i, "views": v, "description": d}
        for t in ("a", "b")
        for c in ("x", "y")
        for i in ("1", None)
        for v in ("5", "7")
        for d in ("p", None)
    ]
    wide = clean(videos(*changes), published_as=published_as)
    narrow = clean(videos(*changes), published_as=published_as, for_rollups=True)
    assert set(ROLLUP_COLUMNS) <= set(narrow.columns) and "description" not in narrow.columns
    assert channel_rollup(wide).collect() == channel_rollup(narrow).collect()
    assert daily_rollup(wide).collect() == daily_rollup(narrow).collect()
