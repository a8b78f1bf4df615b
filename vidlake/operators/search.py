"""Video selection: recent, by keyword, most viewed."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from vidlake.functions.dates import days_before, publish_date
from vidlake.functions.text import mentions
from vidlake.schemas import (
    DATE_PARTS,
    KEYWORDS,
    SEARCH_DAYS,
    SEARCH_PAGE_ROWS,
    SEARCH_PAGES,
    SNAPSHOT_ROWS,
)


def recent_videos(df: DataFrame, run_date: dt.date, days: int = SEARCH_DAYS) -> DataFrame:
    """Videos published on or after the day ``days`` before the run date. Where
    the table has the day partition columns, old partitions are not read."""
    since = days_before(run_date, days)
    recent = df.filter(publish_date(df) >= since)
    if set(DATE_PARTS) <= set(df.columns):
        recent = recent.filter(F.make_date(*DATE_PARTS) >= since)
    return recent


def keyword_matches(
    df: DataFrame,
    keywords: Sequence[str] = KEYWORDS,
    columns: Sequence[str] = ("title", "description"),
) -> DataFrame:
    """One row per (keyword, video) where the whole text holds the word."""
    # One slot per keyword, empty ones dropped after: dropping them inside the
    # explode makes Spark search every text twice, once to see if any is left.
    hits = [F.when(mentions(word, columns), F.lit(word)) for word in keywords]
    slots = df.withColumn("keyword", F.explode(F.array(*hits)))
    return slots.filter(F.col("keyword").isNotNull())


def top_per_group(
    df: DataFrame, group: str, order: Sequence[Column], rows: int, spread_by: str, salts: int = 64
) -> DataFrame:
    """The first ``rows`` rows of every group, exact, as column ``rank``.

    A group may be a large part of the table, so it is cut down in two steps:
    within salted pieces first, then over what is left of the pieces, at most
    ``salts * rows`` rows per group.
    """
    salt = F.pmod(F.xxhash64(spread_by), F.lit(salts))
    piece = F.row_number().over(Window.partitionBy(group, "_salt").orderBy(*order))
    whole = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    cut = df.withColumn("_salt", salt).withColumn("_piece", piece).filter(F.col("_piece") <= rows)
    ranked = cut.drop("_salt", "_piece").withColumn("rank", whole)
    return ranked.filter(F.col("rank") <= rows)


def top_pages(
    hits: DataFrame, page_rows: int = SEARCH_PAGE_ROWS, pages: int = SEARCH_PAGES
) -> DataFrame:
    """Per keyword the most viewed videos, cut into result pages."""
    order = [F.col("views").desc_nulls_last(), F.col("video_id").asc()]
    top = top_per_group(hits, "keyword", order, page_rows * pages, spread_by="video_id")
    page = F.floor((F.col("rank") - 1) / page_rows).cast("int") + 1
    return top.withColumn("page", page)


def snapshot_cap(df: DataFrame, rows: int = SNAPSHOT_ROWS) -> DataFrame:
    """The most viewed rows of a snapshot, at most ``rows`` of them."""
    keys = [name for name in ("video_id", "extraction_date") if name in df.columns]
    return df.orderBy(F.col("views").desc_nulls_last(), *keys).limit(rows)
