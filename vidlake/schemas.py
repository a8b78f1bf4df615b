"""Column names and declared schemas of every layer. Nothing is inferred."""

from __future__ import annotations

from pyspark.sql.types import ArrayType, StringType, StructField, StructType

# Names, order and numbers every layer agrees on.
CANONICAL = (
    "video_id",
    "extraction_date",
    "title",
    "channel_title",
    "channel_id",
    "published_date",
    "views",
    "likes",
    "comments",
    "description",
)
METRICS = ("views", "likes", "comments")
DATE_PARTS = ("year", "month", "day")
REQUIRED = (
    "video_id",
    "title",
    "channel_title",
    "published_date",
    "views",
    "likes",
    "comments",
)
TRIMMED = ("video_id", "title", "channel_title", "description")
SNAPSHOT_KEY = ("video_id", "extraction_date")
CSV_NAMES = {
    "video_id": "video_id",
    "trending_date": "extraction_date",
    "title": "title",
    "channel_title": "channel_title",
    "category_id": "channel_id",
    "publish_time": "published_date",
    "views": "views",
    "likes": "likes",
    "comment_count": "comments",
    "description": "description",
}
BRONZE_NAMES = {name: name for name in CANONICAL}
KEYWORDS = ("technology", "AI")
SEARCH_DAYS = 50
SEARCH_PAGE_ROWS = 30
SEARCH_PAGES = 5
LOOKUP_BATCH = 50
SNAPSHOT_ROWS = 50
TOP_CHANNELS = 10

CORRUPT = "_corrupt_record"


def _strings(*names: str) -> StructType:
    return StructType([StructField(name, StringType()) for name in names])


def _items(item: StructType, *more: StructField) -> StructType:
    return StructType([StructField("items", ArrayType(item)), *more])


# Metrics are read as text so that one junk value costs one cell, not the row.
BRONZE = _strings(
    "video_id",
    "title",
    "channel_id",
    "channel_title",
    "published_date",
    "views",
    "likes",
    "comments",
    "extraction_date",
    "description",
)

DETAILS_RESPONSE = _items(
    StructType(
        [
            StructField("id", StringType()),
            StructField(
                "snippet", _strings("title", "channelId", "channelTitle", "publishedAt")
            ),
            StructField("statistics", _strings("viewCount", "likeCount", "commentCount")),
        ]
    )
)

SEARCH_RESPONSE = _items(
    StructType([StructField("id", _strings("videoId"))]),
    StructField("nextPageToken", StringType()),
)


def with_corrupt_column(schema: StructType) -> StructType:
    """The schema plus the column where Spark puts text it could not parse."""
    return StructType([*schema.fields, StructField(CORRUPT, StringType())])
