"""Gold kept up with a fed table, without cleaning all of it again.

A version of gold remembers the version of the ledger it stands for. The next run asks the
ledger which files have come to count and which no longer do, and finds the snapshot keys
of their rows. Only these are cleaned again, from all their rows that count; the clean
table gets their new rows as a layer that replaces the keys, and both rollups change by
the difference between the new rows and those the table had before. After MAX_LAYERS
layers, or when the ledger can no longer tell the difference, a run makes everything anew.

Layers and rollups are in the folder of a new version, which one file publishes, as in a
full run.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from vidlake.operators.cleaning import clean_videos
from vidlake.operators.quality import ROWS, QualityError, duplicate_keys, failures_in, rule_counts
from vidlake.operators.rollups import channel_rollup, daily_rollup
from vidlake.plans.jobs import (
    KEPT_VERSIONS,
    Published,
    gold_videos,
    published_state,
    publish_gold,
    register_gold,
    retire_gold,
)
from vidlake.schemas import DATE_PARTS
from vidlake.sources.writers import current_version, discard, gathered, new_version, publish_version, replace_table
from vidlake.streaming.ledger import TAKING, Ledger, read_silver

MAX_LAYERS = 8
# Days of extraction that are named in a filter on the files; more are not.
MAX_DAYS = 1_000
_FILE = ("file", "modified", "length")


@dataclass(frozen=True)
class Kept:
    """Whether everything was made anew, and how many snapshot keys were cleaned."""

    whole: bool
    keys: int


def maintain_gold(
    spark: SparkSession,
    silver_path: str,
    gold_path: str,
    published_as: str = "date",
    keep: int = KEPT_VERSIONS,
    catalog_prefix: str | None = None,
) -> Kept:
    """Bring gold up to the fed table as it is now."""
    ledger = Ledger(spark, silver_path)
    now = ledger.version()
    state = published_state(spark, gold_path)
    if (
        state is None
        or state.ledger is None
        or state.published_as != published_as
        or state.ledger < ledger.swept()
        or len(state.layers) > MAX_LAYERS
    ):
        silver = read_silver(spark, silver_path, now)
        mark = Published(now, published_as)
        return Kept(True, publish_gold(silver, gold_path, published_as, keep, catalog_prefix, mark))
    if state.ledger == now:
        return Kept(False, 0)

    before, after = ledger.live(state.ledger), ledger.live(now)
    changed = after.join(before, list(_FILE), "left_anti").unionByName(before.join(after, list(_FILE), "left_anti"))
    silver = spark.read.parquet(silver_path)
    mine = F.trim("video_id").alias("video_id"), F.col("extraction_date")
    rows = silver.join(changed.select(F.col("taking").alias(TAKING)), TAKING, "left_semi")
    version = new_version(gold_path)
    published = False
    try:
        rows.select(*mine).distinct().write.parquet(f"{version}/touched")
        touched = spark.read.parquet(f"{version}/touched")
        keys = touched.count()
        days = [row[0] for row in touched.select("extraction_date").distinct().limit(MAX_DAYS + 1).collect()]
        fresh = _of_keys(read_silver(spark, silver_path, now), touched, days, F.trim("video_id"))
        videos = clean_videos(fresh, published_as)
        observed = Observation()
        # Not by day, as a layer is small, and may have no row at all.
        checked = gathered(videos, *DATE_PARTS).observe(observed, *rule_counts(videos.columns))
        checked.write.parquet(f"{version}/videos")
        found = dict(observed.get)
        if published_as == "text":
            found.pop("null_partition", None)
        failures = failures_in(found)
        new = spark.read.schema(videos.schema).parquet(f"{version}/videos")
        if not failures and not duplicate_keys(new).isEmpty():
            failures = ["duplicate_snapshot"]
        old = _of_keys(gold_videos(spark, gold_path), touched, days, F.col("video_id"))
        last = current_version(spark, gold_path)
        for name, rollup, names in (
            ("channel_analysis", channel_rollup, ["channel_title"]),
            ("daily_analysis", daily_rollup, list(DATE_PARTS)),
        ):
            table = spark.read.parquet(f"{last}/{name}")
            replace_table(_changed_by(table, rollup(new), rollup(old), names), f"{version}/{name}")
        if not failures and found[ROWS] == 0 and spark.read.parquet(f"{version}/channel_analysis").isEmpty():
            failures = ["empty_table"]
        if failures:
            raise QualityError(failures)
        folder = version.rpartition("/")[2]
        publish_version(spark, version, Published(now, published_as, (*state.layers, folder)).text())
        published = True
    finally:
        if not published:
            discard(spark, version)
    if catalog_prefix is not None:
        register_gold(spark, gold_path, catalog_prefix)
    retire_gold(spark, gold_path, keep)
    return Kept(False, keys)


def _of_keys(rows: DataFrame, keys: DataFrame, days: list[str | None], video_id: Column) -> DataFrame:
    """Rows of some snapshot keys. The days of extraction go to the scan as values, so
    that files and row groups of other days are not read."""
    if len(days) <= MAX_DAYS:
        there = F.col("extraction_date").isin([d for d in days if d is not None])
        rows = rows.filter(there | F.col("extraction_date").isNull() if None in days else there)
    wanted = keys.select(F.col("video_id").alias("_id"), F.col("extraction_date").alias("_day"))
    same = video_id.eqNullSafe(F.col("_id")) & F.col("extraction_date").eqNullSafe(F.col("_day"))
    return rows.join(wanted, same, "left_semi")


def _changed_by(table: DataFrame, more: DataFrame, less: DataFrame, names: list[str]) -> DataFrame:
    """A rollup with what was added and without what was taken away."""
    sums = [name for name in table.columns if name not in names]
    taken = less.select(*names, *(-F.col(name).alias(name) for name in sums))
    taken = taken.toDF(*names, *sums)
    both = reduce(DataFrame.unionByName, [table, more, taken])
    totals = [F.sum(name).alias(name) for name in sums]
    return both.groupBy(*names).agg(*totals).filter(F.col("total_videos") > 0).select(*table.columns)
