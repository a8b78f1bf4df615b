"""Landed provider responses to flat rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from vidlake.functions.numbers import lenient_long
from vidlake.operators.mapping import stamp_run_date


def parse_responses(df: DataFrame, column: str, schema: StructType) -> DataFrame:
    """JSON text, one response per row, to the fields of the response."""
    return df.select(F.from_json(F.col(column), schema).alias("_r")).select("_r.*")


def _counter(name: str) -> Column:
    # A missing counter, or missing statistics, means 0; junk becomes NULL.
    return lenient_long(F.coalesce(F.col(f"item.statistics.{name}"), F.lit("0")))


def _items(responses: DataFrame, field: Column, name: str) -> DataFrame:
    """One row per element. An outer explode with the empty ones dropped after:
    before an inner one Spark tests the array, and parses the JSON again for it."""
    return responses.select(F.explode_outer(field).alias(name)).filter(F.col(name).isNotNull())


def flatten_details(responses: DataFrame, run_date: dt.date) -> DataFrame:
    """One flat record per item of the details responses, stamped with the run
    date. Missing objects give NULL texts and zero counters."""
    records = _items(responses, F.col("items"), "item").select(
        F.col("item.id").alias("video_id"),
        F.col("item.snippet.title").alias("title"),
        F.col("item.snippet.channelId").alias("channel_id"),
        F.col("item.snippet.channelTitle").alias("channel_title"),
        F.col("item.snippet.publishedAt").alias("published_date"),
        _counter("viewCount").alias("views"),
        _counter("likeCount").alias("likes"),
        _counter("commentCount").alias("comments"),
    )
    return records.transform(stamp_run_date, run_date)


def search_ids(responses: DataFrame) -> DataFrame:
    """One row per result of the search responses, duplicates included."""
    return _items(responses, F.col("items.id.videoId"), "video_id")
