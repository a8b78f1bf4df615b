"""Report queries over the two rollups. Only what a report shows leaves Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from vidlake.functions.dates import day_label
from vidlake.functions.numbers import thousands
from vidlake.plans.jobs import gold_table
from vidlake.schemas import DATE_PARTS, TOP_CHANNELS


def kpi_totals(channels: DataFrame) -> DataFrame:
    """Number of channels and the grand totals, in one row."""
    names = ("total_videos", "total_views", "total_likes")
    sums = [F.coalesce(F.sum(name), F.lit(0)).cast("bigint").alias(name) for name in names]
    return channels.agg(F.count(F.lit(1)).alias("channels"), *sums)


def kpi_formatted(channels: DataFrame) -> DataFrame:
    """The same as display text."""
    totals = kpi_totals(channels)
    shown = [thousands(F.col(c)).alias(c) for c in totals.columns if c != "channels"]
    return totals.select(F.col("channels").cast("string").alias("channels"), *shown)


def top_channels(channels: DataFrame, rows: int = TOP_CHANNELS) -> DataFrame:
    """Most viewed channels; titles settle ties."""
    top = channels.orderBy(F.col("total_views").desc_nulls_last(), F.col("channel_title").asc())
    return top.limit(rows).select("channel_title", "total_views")


def likes_vs_comments(channels: DataFrame) -> DataFrame:
    """Likes against comments, sized by views."""
    return channels.select("channel_title", "total_likes", "total_comments", "total_views")


def channel_table(channels: DataFrame) -> DataFrame:
    """All channels, most viewed first."""
    return channels.orderBy(F.col("total_views").desc_nulls_last(), F.col("channel_title").asc())


def _by_day(days: DataFrame, measure: str) -> DataFrame:
    ordered = days.orderBy(*(F.col(part).asc_nulls_last() for part in DATE_PARTS))
    return ordered.select(day_label().alias("date"), measure)


def daily_views(days: DataFrame) -> DataFrame:
    """Views per publication day, in calendar order."""
    return _by_day(days, "total_views")


def daily_uploads(days: DataFrame) -> DataFrame:
    """Videos per publication day, in calendar order."""
    return _by_day(days, "total_videos")


# Report name to the gold table it reads and the query on it.
REPORTS = {
    "kpi_totals": ("channel_analysis", kpi_totals),
    "kpi_formatted": ("channel_analysis", kpi_formatted),
    "top_channels": ("channel_analysis", top_channels),
    "likes_vs_comments": ("channel_analysis", likes_vs_comments),
    "channel_table": ("channel_analysis", channel_table),
    "daily_views": ("daily_analysis", daily_views),
    "daily_uploads": ("daily_analysis", daily_uploads),
}


def report(spark: SparkSession, gold_path: str, name: str) -> DataFrame:
    """A report over published gold tables."""
    table, query = REPORTS[name]
    return query(gold_table(spark, gold_path, table))
