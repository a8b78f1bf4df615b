"""The driver's tables in the shapes the sources have, defects included.

Defects are put in by fixed arithmetic, so that SQL can make the same rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from vidlake.operators.mapping import silver_rows

RUN_DATE = dt.date(2000, 6, 30)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(value: Column | str) -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast("string")


def _unless(column: str, divisor: int, otherwise: str | None, value: Column) -> Column:
    hit = F.col(column) % divisor == 0
    return F.when(hit, F.lit(otherwise)).otherwise(value)


def _iso(timestamp: str) -> Column:
    return F.concat(F.col(timestamp).cast("date").cast("string"), F.lit("T00:00:00Z"))


def _line_metrics() -> dict[str, Column]:
    views = _text(F.floor("l_extendedprice") - 20000)
    return {
        "views": _unless("l_partkey", 89, "n/a", views),
        "likes": _text(F.floor("l_quantity") * 1500 - 6000),
        "comments": _text((F.col("l_partkey") % 97) * 900 - 3000),
    }


def historical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as the historical CSV: its column names, all text."""
    metrics = _line_metrics()
    title = F.concat(F.lit("  t"), _text("l_partkey"), F.lit(" "))
    flags = F.concat(F.lit("  "), "l_returnflag", F.lit("/"), "l_linestatus", F.lit(" "))
    return table(spark, sf_dir, "lineitem").select(
        _text("l_orderkey").alias("video_id"),
        _text("l_linenumber").alias("trending_date"),
        _unless("l_partkey", 53, None, title).alias("title"),
        F.concat(F.lit(" Supplier "), _text("l_suppkey"), F.lit("  ")).alias("channel_title"),
        _text("l_suppkey").alias("category_id"),
        _unless("l_partkey", 101, "junk", _iso("l_shipdate")).alias("publish_time"),
        metrics["views"].alias("views"),
        metrics["likes"].alias("likes"),
        metrics["comments"].alias("comment_count"),
        _unless("l_partkey", 11, None, flags).alias("description"),
    )


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as landed snapshots: nine fields, seven extraction days."""
    key = F.col("o_orderkey")
    extracted = F.date_add(F.lit(dt.date(2024, 1, 1)), (key % 7).cast("int"))
    return table(spark, sf_dir, "orders").select(
        _text("o_orderkey").alias("video_id"),
        F.concat(F.lit("é "), "o_orderpriority").alias("title"),
        _text("o_custkey").alias("channel_id"),
        F.concat(F.lit("Customer "), _text("o_custkey")).alias("channel_title"),
        _iso("o_orderdate").alias("published_date"),
        F.floor("o_totalprice").alias("views"),
        (key * 3).alias("likes"),
        (F.col("o_custkey") * 5).alias("comments"),
        _text(extracted).alias("extraction_date"),
    )


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The historical table as silver rows."""
    return silver_rows(historical(spark, sf_dir))


def details_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as JSON details responses, one item each, with objects and
    counters missing here and there."""
    metrics = _line_metrics()
    snippet = F.struct(
        F.concat(F.lit('é "t'), _text("l_partkey"), F.lit('"')).alias("title"),
        _text("l_suppkey").alias("channelId"),
        F.concat(F.lit("Supplier "), _text("l_suppkey")).alias("channelTitle"),
        _iso("l_shipdate").alias("publishedAt"),
    )
    statistics = F.struct(
        metrics["views"].alias("viewCount"),
        _unless("l_partkey", 13, None, metrics["likes"]).alias("likeCount"),
        metrics["comments"].alias("commentCount"),
    )
    item = F.struct(
        _text("l_orderkey").alias("id"),
        F.when(F.col("l_partkey") % 37 != 0, snippet).alias("snippet"),
        F.when(F.col("l_partkey") % 31 != 0, statistics).alias("statistics"),
    )
    response = F.to_json(F.struct(F.array(item).alias("items")))
    return table(spark, sf_dir, "lineitem").select(response.alias("response"))


def search_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as JSON search result pages of two results each."""
    results = [
        F.struct(F.struct(_text(name).alias("videoId")).alias("id"))
        for name in ("event_id", "user_id")
    ]
    page = F.struct(F.array(*results).alias("items"), F.col("event_type").alias("nextPageToken"))
    return table(spark, sf_dir, "events").select(F.to_json(page).alias("response"))


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as videos with long descriptions."""
    return table(spark, sf_dir, "documents").select(
        _text("doc_id").alias("video_id"),
        F.concat_ws(" ", "lang", "source").alias("title"),
        F.col("text").alias("description"),
        F.col("n_chars").alias("views"),
    )
