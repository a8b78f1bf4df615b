"""Cleaning rules and the chain that applies them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from vidlake.functions.dates import date_parts, publish_date
from vidlake.functions.numbers import at_least_zero, at_most
from vidlake.operators.mapping import type_metrics
from vidlake.schemas import CANONICAL, DATE_PARTS, METRICS, REQUIRED, SNAPSHOT_KEY, TRIMMED

# Which of two snapshots with the same key and publish date survives. Columns
# that the rollups read come first, so cutting the tail off the list cannot
# change what a rollup sees.
TIE_BREAKERS = (
    ("views", "desc"),
    ("likes", "desc"),
    ("comments", "desc"),
    ("channel_title", "asc"),
    ("channel_id", "asc"),
    ("title", "asc"),
    ("description", "asc"),
)
ROLLUP_COLUMNS = (*SNAPSHOT_KEY, "channel_title", "published_date", *METRICS)


def trim_text(df: DataFrame, columns: Sequence[str] = TRIMMED) -> DataFrame:
    """Strip spaces (not tabs, newlines or NBSP) off the text columns at hand."""
    return df.withColumns({c: F.trim(F.col(c)) for c in columns if c in df.columns})


def drop_incomplete(df: DataFrame, columns: Sequence[str] = REQUIRED) -> DataFrame:
    """Drop rows with a NULL in any required column. One test per column, other
    than dropna, so that those on stored columns reach the files."""
    present = [F.col(c).isNotNull() for c in columns]
    return df.filter(reduce(lambda left, right: left & right, present))


def clamp_negative(df: DataFrame) -> DataFrame:
    """Negative counters become 0."""
    return df.withColumns({name: at_least_zero(F.col(name)) for name in METRICS})


def clamp_to_views(df: DataFrame) -> DataFrame:
    """Likes and comments cannot exceed views."""
    views = F.col("views")
    return df.withColumns({name: at_most(F.col(name), views) for name in ("likes", "comments")})


def _ordered(name: str, direction: str) -> Column:
    column = F.col(name)
    return column.desc_nulls_last() if direction == "desc" else column.asc_nulls_first()


def keep_latest(
    df: DataFrame,
    keys: Sequence[str] = SNAPSHOT_KEY,
    latest_by: str = "published_date",
) -> DataFrame:
    """One row per key: the one published last, ties settled by a total order.

    Rank-1 over a window lets Spark put a group limit on each map task before
    the exchange, so however many copies of a key there are, a task sends at
    most one of them. NULL keys form a group like any other.
    """
    order = [F.col(latest_by).desc_nulls_last()]
    order += [_ordered(name, way) for name, way in TIE_BREAKERS if name in df.columns]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def clean_videos(
    df: DataFrame, published_as: str = "date", for_rollups: bool = False
) -> DataFrame:
    """Trim, type, drop incomplete rows, clamp, keep the latest snapshot.

    ``published_as="date"`` types the publish date before incomplete rows are
    dropped, so an unreadable date drops the row, and recomputes the partition
    columns. ``published_as="text"`` leaves the date as text, orders it as text,
    drops rows before typing the counters and keeps the partition columns the
    input has, so unreadable dates survive in a NULL day.

    ``for_rollups`` keeps only what the rollups read, which keeps the long texts
    out of the de-duplication shuffle.
    """
    if published_as not in ("date", "text"):
        raise ValueError("published_as must be 'date' or 'text'")
    as_text = published_as == "text"
    rows = df.select(*CANONICAL, *(DATE_PARTS if as_text else ()))
    # Trimming neither makes nor removes a NULL, so NULLs can go first, by tests
    # on the stored columns.
    rows = rows.transform(drop_incomplete).transform(trim_text).transform(type_metrics)
    if not as_text:
        rows = rows.withColumn("published_date", publish_date(rows))
        rows = rows.transform(drop_incomplete, ("published_date", *METRICS))
    rows = rows.transform(clamp_negative).transform(clamp_to_views)
    if for_rollups:
        rows = rows.select(*ROLLUP_COLUMNS, *(DATE_PARTS if as_text else ()))
    rows = rows.transform(keep_latest)
    return rows if as_text else rows.withColumns(date_parts(F.col("published_date")))
