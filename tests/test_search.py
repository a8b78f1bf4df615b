from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from vidlake.operators import lookup, responses, search
from vidlake.operators.mapping import silver_rows
from vidlake.schemas import DETAILS_RESPONSE, SEARCH_RESPONSE

RUN = dt.date(2024, 2, 24)


def test_recent_includes_the_first_day(videos):
    dates = ["2024-01-04T23:59:59Z", "2024-01-05T00:00:00Z", "2024-02-24", "junk", None]
    silver = silver_rows(bronze=videos(*({"published_date": d, "video_id": str(d)} for d in dates)))
    got = {r.video_id for r in search.recent_videos(silver, RUN).collect()}
    assert got == {"2024-01-05T00:00:00Z", "2024-02-24"}
    without_parts = silver.drop("year", "month", "day")
    assert {r.video_id for r in search.recent_videos(without_parts, RUN).collect()} == got


def test_keywords_in_title_or_description(videos):
    frame = videos(
        {"video_id": "a", "title": "AI technology"},
        {"video_id": "b", "title": None, "description": "on Technology."},
        {"video_id": "c", "title": "maine", "description": None},
    )
    got = {(r.video_id, r.keyword) for r in search.keyword_matches(frame).collect()}
    assert got == {("a", "AI"), ("a", "technology"), ("b", "technology")}


def test_whole_text_is_searched(videos):
    frame = videos({"description": "x " * 200_000 + "AI"})
    assert search.keyword_matches(frame).count() == 1


def test_top_pages_against_brute_force(spark):
    # One keyword holds almost everything, with many ties.
    hits = spark.range(4000).select(
        F.when(F.col("id") % 100 == 0, "rare").otherwise("hot").alias("keyword"),
        F.col("id").cast("string").alias("video_id"),
        (F.col("id") * 7919 % 50).alias("views"),
    )
    wanted = []
    for keyword in ("hot", "rare"):
        mine = [r for r in hits.collect() if r.keyword == keyword]
        mine.sort(key=lambda r: (-r.views, r.video_id))
        for i, r in enumerate(mine[:150]):
            wanted.append((keyword, r.video_id, r.views, i + 1, i // 30 + 1))
    got = [tuple(r) for r in search.top_pages(hits.repartition(7)).collect()]
    assert sorted(got) == sorted(wanted)


def test_null_views_rank_last(spark):
    hits = spark.createDataFrame(
        [("k", "a", None), ("k", "b", 1)], "keyword string, video_id string, views bigint"
    )
    assert [r.video_id for r in search.top_pages(hits).orderBy("rank").collect()] == ["b", "a"]


def test_snapshot_cap(spark):
    frame = spark.range(200).select(
        F.col("id").cast("string").alias("video_id"), F.col("id").alias("views")
    )
    got = search.snapshot_cap(frame).collect()
    assert [r.views for r in got] == list(range(199, 149, -1))


@pytest.fixture
def details(spark):
    texts = [
        '{"items": [{"id": "a", "snippet": {"title": "t", "channelId": "ch", "channelTitle": "c",'
        ' "publishedAt": "2024-01-05T00:00:00Z"}, "statistics": {"viewCount": "5",'
        ' "likeCount": 3}}, {"id": "b"}]}',
        '{"items": [{"id": "c", "statistics": {"viewCount": "n/a"}}]}',
        '{"items": []}',
        "{}",
    ]
    frame = spark.createDataFrame([(t,) for t in texts], "response string")
    parsed = responses.parse_responses(frame, "response", DETAILS_RESPONSE)
    return responses.flatten_details(parsed, RUN)


def test_flatten_details(details):
    got = {r.video_id: r for r in details.collect()}
    assert set(got) == {"a", "b", "c"}
    assert (got["a"].views, got["a"].likes, got["a"].comments) == (5, 3, 0)
    assert (got["a"].title, got["a"].channel_id, got["a"].channel_title) == ("t", "ch", "c")
    assert (got["b"].title, got["b"].views, got["b"].likes) == (None, 0, 0)
    assert got["c"].views is None and got["c"].likes == 0
    assert {r.extraction_date for r in got.values()} == {"2024-02-24"}


def test_search_ids(spark):
    texts = [
        '{"items": [{"id": {"videoId": "a"}}, {"id": {"videoId": "b"}}], "nextPageToken": "n"}',
        '{"items": [{"id": {"videoId": "a"}}]}',
        "{}",
    ]
    frame = spark.createDataFrame([(t,) for t in texts], "response string")
    found = responses.search_ids(responses.parse_responses(frame, "response", SEARCH_RESPONSE))
    assert sorted(r.video_id for r in found.collect()) == ["a", "a", "b"]
    assert tuple(lookup.count_ids(found).first()) == (3, 2)
    more = spark.createDataFrame([("c",), ("a",)], "video_id string")
    union = lookup.distinct_ids(found, more)
    assert sorted(r.video_id for r in union.collect()) == ["a", "b", "c"]


@pytest.mark.parametrize("limit, join", [(2, "BroadcastHashJoin"), (1, "SortMergeJoin"), (0, "SortMergeJoin")])
def test_lookup_broadcasts_only_what_it_has_counted(spark, details, plan, limit, join):
    ids = spark.createDataFrame([("a",), ("zz",), ("a",)], "video_id string")
    found = lookup.lookup_details(details, ids, broadcast_up_to=limit)
    assert [r.video_id for r in found.collect()] == ["a"]
    assert join in plan(found)


@pytest.mark.parametrize("rows, digits", [(0, 3), (1, 3), (50, 1), (51, 2), (1234, 1), (1234, 3)])
def test_id_batches_are_full_and_whole(spark, rows, digits):
    ids = spark.range(rows).select(F.col("id").cast("string").alias("video_id"))
    batches = lookup.id_batches(ids.union(ids), bucket_digits=digits)
    got = batches.collect()
    assert len(got) == rows and len({r.video_id for r in got}) == rows
    lists = lookup.batch_lists(batches).orderBy("batch").collect()
    assert [r.batch for r in lists] == list(range(-(-rows // 50)))
    assert all(r.n_ids == 50 for r in lists[:-1])
    assert all(r.ids.split(",") == sorted(r.ids.split(",")) for r in lists)


def test_id_batches_do_not_depend_on_layout(spark):
    ids = spark.range(500).select(F.col("id").cast("string").alias("video_id"))
    one = {tuple(r) for r in lookup.id_batches(ids.coalesce(1)).collect()}
    many = {tuple(r) for r in lookup.id_batches(ids.repartition(13), bucket_digits=2).collect()}
    assert one == many


def test_lookup_does_not_broadcast_long_texts(spark, details, plan, monkeypatch):
    monkeypatch.setattr(lookup, "BROADCAST_BYTES", 10)
    ids = spark.createDataFrame([("a",), ("z" * 20,)], "video_id string")
    assert "SortMergeJoin" in plan(lookup.lookup_details(details, ids))


def test_lookup_beyond_the_limit_leaves_rows_out_before_the_shuffle(spark, plan):
    """Same rows as with a broadcast; few of the others reach the exchange."""
    from pyspark.sql import functions as F

    from vidlake.operators import lookup

    details = spark.range(200_000).select(
        F.when(F.col("id") % 1000 != 0, F.concat(F.lit("v"), F.col("id") % 50_000)).alias("video_id"), F.col("id").alias("views")
    )
    ids = spark.range(0, 50_000, 25).select(F.concat(F.lit("v"), "id").alias("video_id")).union(
        spark.createDataFrame([(None,), ("gone",)], "video_id string")
    )
    wanted = lookup.distinct_ids(ids)
    few, many = (lookup.lookup_details(details, ids, broadcast_up_to=n) for n in (10**6, 10))
    assert many.columns == few.columns == ["video_id", "views"]
    assert sorted(map(tuple, many.collect())) == sorted(map(tuple, few.collect())) and many.count() > 7_000
    kept = lookup.maybe_wanted(details, wanted, 2_002)
    assert kept.filter("video_id is not null").count() < 1.3 * many.count() + 200_000 / lookup.BITS_PER_ID
    text = plan(many)
    # The bit map is tested below the exchange of the details.
    assert text.index("SortMergeJoin") < text.index("Exchange hashpartitioning(video_id") < text.index("BroadcastHashJoin")
    # However small the map, no wanted row is lost.
    assert lookup.maybe_wanted(details, wanted, 1).join(wanted, "video_id", "left_semi").count() == many.count()
