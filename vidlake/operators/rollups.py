"""Gold rollups.

Both count snapshots, not distinct videos: a video seen on three days adds
three rows and its cumulative counters three times. Both combine map-side, so
a channel or a day that owns a third of the table still shuffles one row per
map task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from vidlake.schemas import DATE_PARTS


def channel_rollup(videos: DataFrame) -> DataFrame:
    """Snapshots and summed counters per channel title. Channels that share a
    title share a row."""
    totals = [F.sum(name).alias(f"total_{name}") for name in ("views", "likes", "comments")]
    return videos.groupBy("channel_title").agg(F.count("video_id").alias("total_videos"), *totals)


def daily_rollup(videos: DataFrame) -> DataFrame:
    """Snapshots and summed views per day of publication."""
    return videos.groupBy(*DATE_PARTS).agg(
        F.count("video_id").alias("total_videos"), F.sum("views").alias("total_views")
    )
