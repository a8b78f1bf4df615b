"""What Catalyst makes of the operators."""

from __future__ import annotations

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from vidlake.operators import lookup, responses, search
from vidlake.operators.cleaning import clean_videos
from vidlake.operators.mapping import silver_rows
from vidlake.operators.quality import quality_report
from vidlake.operators.rollups import channel_rollup
from vidlake.plans.reports import top_channels
from vidlake.schemas import DETAILS_RESPONSE
from vidlake.sources import readers
from vidlake.sources.writers import gathered, replace_table


@pytest.fixture(scope="module")
def silver(spark, videos, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("silver") / "t")
    changes = [
        {"video_id": f"v{n}", "published_date": f"2024-01-{n % 28 + 1:02}"} for n in range(200)
    ]
    replace_table(silver_rows(bronze=videos(*changes)), path, "year", "month", "day")
    return spark.read.parquet(path)


def exchanges(text):
    return re.findall(r"(?<!Reused)(?<!Broadcast)Exchange (\w+)\(?([^)]*)", text)


def test_dedupe_cuts_groups_before_the_shuffle(silver, plan):
    text = plan(clean_videos(silver))
    final, before = text.index("WindowGroupLimit"), text.rindex("WindowGroupLimit")
    assert final < text.index("Exchange hashpartitioning") < before
    assert len(exchanges(text)) == 1


def test_rollups_leave_texts_out_of_the_shuffle(silver, plan):
    text = plan(channel_rollup(clean_videos(silver, for_rollups=True)))
    assert "description" not in re.search(r"ReadSchema: (.*)", text).group(1)
    assert "partial_sum" in text and len(exchanges(text)) == 2


def test_required_columns_are_tested_at_the_files(silver, plan):
    text = plan(clean_videos(silver))
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", text).group(1)
    for column in ("video_id", "title", "channel_title", "views", "likes", "comments"):
        assert f"IsNotNull({column})" in pushed


def test_quality_of_a_deduplicated_table_adds_no_keyed_shuffle(silver, plan):
    text = plan(quality_report(clean_videos(silver)))
    assert [kind for kind, _ in exchanges(text)].count("hashpartitioning") == 1


def test_recent_videos_prune_partitions(silver, plan):
    text = plan(search.recent_videos(silver, dt.date(2024, 3, 10)))
    pruned = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", text).group(1)
    assert "make_date" in pruned


def test_top_channels_sorts_only_the_top(silver, plan):
    assert "TakeOrderedAndProject" in plan(top_channels(channel_rollup(silver)))


def test_keyword_search_reads_each_text_once(silver, plan):
    assert len(re.findall("RLIKE", plan(search.keyword_matches(silver)))) == 4


def test_responses_are_parsed_once(spark, plan):
    texts = spark.range(5).select(F.concat(F.lit('{"items": [{"id": "'), "id", F.lit('"}]}')).alias("r"))
    parsed = responses.parse_responses(texts, "r", DETAILS_RESPONSE)
    details = responses.flatten_details(parsed, dt.date(2024, 1, 1))
    assert details.count() == 5 and plan(details).count("from_json") == 1


def test_split_csv_reads_lines_once(spark, tmp_path, plan):
    (tmp_path / "a.csv").write_text("video_id,title\nv1,t\n")
    text = plan(readers.read_split_csv(spark, str(tmp_path)))
    assert "ReusedExchange" in text and text.count("FileScan text") == 1


def test_top_pages_cut_salted_pieces_before_the_shuffle(silver, plan):
    text = plan(search.top_pages(silver.withColumn("keyword", F.col("title"))))
    assert text.count("WindowGroupLimit") >= 3 and "_salt" in text


def test_id_batches_share_the_reading_of_the_ids(silver, plan):
    text = plan(lookup.id_batches(silver))
    assert "ReusedExchange" in text and text.count("FileScan") == 1


def test_oversized_lookup_id_is_split(spark, plan):
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50k",
    }
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        rows = spark.range(0, 60_000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("video_id"),
            F.md5(F.col("id").cast("string")).alias("title"),
        )
        ids = rows.select("video_id").distinct()
        found = lookup.lookup_details(rows, ids, broadcast_up_to=0)
        assert "skew=true" in plan(found)
        assert found.count() == 60_000
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_lookup_measures_without_a_single_task(spark, silver, plan):
    """The ids are stored once; neither measuring nor joining runs them in one task."""
    found = lookup.lookup_details(silver, silver.select("video_id"))
    text = plan(found)
    assert "SinglePartition" not in text and "GlobalLimit" not in text
    assert text.count("HashAggregate") == 0


def test_large_day_is_split_before_the_write(spark, plan):
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "100k")
    try:
        rows = spark.range(0, 60_000, 1, 8).select(
            F.md5(F.col("id").cast("string")).alias("title"), F.lit(2024).alias("year")
        )
        spread = gathered(rows, "year")
        assert "skewed" in plan(spread)
        assert spread.count() == 60_000
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
