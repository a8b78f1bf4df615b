"""The batch jobs: land, unify, clean, publish."""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from vidlake.operators.cleaning import clean_videos
from vidlake.operators.lookup import lookup_details
from vidlake.operators.mapping import silver_rows
from vidlake.operators.quality import (
    DUPLICATES,
    EMPTY,
    ROWS,
    QualityError,
    duplicate_keys,
    failures_in,
    missing_columns,
    rule_counts,
)
from vidlake.operators.responses import flatten_details, search_ids
from vidlake.operators.rollups import channel_rollup, daily_rollup
from vidlake.operators.search import snapshot_cap
from vidlake.schemas import DATE_PARTS
from vidlake.sources.readers import (
    quarantined,
    read_bronze,
    read_csv,
    read_details,
    read_search,
    read_split_csv,
    readable,
)
from vidlake.sources.writers import (
    Outcome,
    append_table,
    current_version,
    discard,
    gathered,
    land_by_date,
    land_by_day,
    mark_of,
    new_version,
    publish_version,
    published_versions,
    replace_table,
    replace_view,
    retire_versions,
    run_report,
    watched,
    write_csv,
)
from vidlake.streaming.ledger import TAKING, Ledger, read_silver


def land_chart(
    spark: SparkSession,
    details_path: str,
    bronze_root: str,
    feed: str,
    run_date: dt.date,
    form: str = "any",
    rows: int | None = None,
) -> DataFrame:
    """Landed responses of the popularity chart to the day's snapshot; with ``rows``,
    only so many of the most viewed. Returns the run report."""

    def write() -> Outcome:
        landed, broken = watched(read_details(spark, details_path, form))
        chart = flatten_details(readable(landed), run_date)
        if rows is not None:
            chart = snapshot_cap(chart, rows)
        written = land_by_date(chart, bronze_root, feed, run_date)
        return Outcome(written.get["records"], broken.get["broken"])

    return run_report(spark, "chart snapshot", f"{bronze_root}/{feed}", write)


def land_search(
    spark: SparkSession,
    search_path: str,
    details_path: str,
    bronze_root: str,
    run_date: dt.date,
    form: str = "any",
) -> DataFrame:
    """Landed search pages and details responses to the day's snapshot: the
    details of the distinct ids found. Returns the run report."""

    def write() -> Outcome:
        pages, broken_pages = watched(read_search(spark, search_path, form))
        landed, broken = watched(read_details(spark, details_path, form))
        ids = search_ids(readable(pages))
        details = flatten_details(readable(landed), run_date)
        written = land_by_day(lookup_details(details, ids), bronze_root, run_date)
        return Outcome(written.get["records"], broken_pages.get["broken"] + broken.get["broken"])

    return run_report(spark, "search snapshot", bronze_root, write)


def split_history(spark: SparkSession, csv_path: str, out_path: str) -> Observation:
    """Large CSV files to many small ones, for the readers that take a file as
    one task, such as incremental ingest."""
    return write_csv(read_split_csv(spark, csv_path), out_path)


def bronze_to_silver(
    spark: SparkSession,
    silver_path: str,
    bronze_path: str | None = None,
    csv_path: str | None = None,
    table: str | None = None,
    quarantine_path: str | None = None,
    form: str = "any",
    split_csv: bool = False,
) -> Outcome:
    """Unify both sources and add them to the silver table. Reads everything
    there is; streaming.ingest reads only what is new. What does not parse is counted
    and, if a quarantine path is given, kept there under this run. ``split_csv``
    reads a CSV file in many tasks and refuses files that are not strict about
    quotes (see read_split_csv)."""
    sources: list[DataFrame] = []
    counts: list[Observation] = []

    def taken(landed: DataFrame) -> DataFrame:
        sources.append(landed)
        seen, broken = watched(landed)
        counts.append(broken)
        return readable(seen)

    bronze = csv = None
    if bronze_path is not None:
        bronze = taken(read_bronze(spark, bronze_path, form=form))
    if csv_path is not None:
        csv = read_split_csv(spark, csv_path) if split_csv else taken(read_csv(spark, csv_path))
    written = append_table(silver_rows(csv, bronze), silver_path, table)
    broken = sum(int(count.get["broken"]) for count in counts)
    if broken and quarantine_path is not None:
        run = uuid.uuid4().hex
        for landed in sources:
            bad = quarantined(landed).withColumn("run", F.lit(run))
            bad.write.mode("append").partitionBy("run").parquet(quarantine_path)
    return Outcome(written.get["records"], broken)


def silver_to_clean(silver: DataFrame, clean_path: str, published_as: str = "date") -> Observation:
    """The clean table on its own, without the gate."""
    return replace_table(clean_videos(silver, published_as), clean_path, *DATE_PARTS)


# Published versions of gold that stay, for readers that are still at work.
KEPT_VERSIONS = 2


@dataclass(frozen=True)
class Published:
    """What a version's mark says: the ledger's version it stands for, how it was
    cleaned, and the folders of its layers, the first of which is whole."""

    ledger: int | None = None
    published_as: str = "date"
    layers: tuple[str, ...] = ()

    def text(self) -> str:
        return json.dumps({"ledger": self.ledger, "published_as": self.published_as, "layers": self.layers})


def _state_of(spark: SparkSession, version: str) -> Published:
    said = mark_of(spark, version)
    found = json.loads(said) if said else {}
    layers = tuple(found.get("layers") or [version.rpartition("/")[2]])
    return Published(found.get("ledger"), found.get("published_as", "date"), layers)


def published_state(spark: SparkSession, gold_path: str) -> Published | None:
    """What the version that was published last says of itself."""
    found = published_versions(spark, gold_path)
    return _state_of(spark, found[-1]) if found else None


def _layered(gold_path: str, layers: Sequence[str]) -> str:
    """The clean table as SQL: rows of each layer but for keys of later ones."""
    parts = []
    for at, layer in enumerate(layers):
        later = " UNION ALL ".join(f"SELECT * FROM parquet.`{gold_path}/{x}/touched`" for x in layers[at + 1 :])
        part = f"SELECT * FROM parquet.`{gold_path}/{layer}/videos` r"
        if later:
            part += (
                f" LEFT ANTI JOIN ({later}) t ON r.video_id <=> t.video_id"
                " AND r.extraction_date <=> t.extraction_date"
            )
        parts.append(part)
    return " UNION ALL ".join(parts)


def gold_videos(spark: SparkSession, gold_path: str) -> DataFrame:
    """The clean table as published last."""
    layers = _state_of(spark, current_version(spark, gold_path)).layers
    if len(layers) == 1:
        return spark.read.parquet(f"{gold_path}/{layers[0]}/videos")
    return spark.sql(_layered(gold_path, layers))


def retire_gold(spark: SparkSession, gold_path: str, keep: int) -> None:
    """Delete published versions but the last ones and their layers."""
    last = published_versions(spark, gold_path)[-max(1, keep) :]
    needed = {f"{gold_path}/{layer}" for version in last for layer in _state_of(spark, version).layers}
    retire_versions(spark, gold_path, keep, needed)


GOLD_TABLES = ("videos", "channel_analysis", "daily_analysis")


def register_gold(spark: SparkSession, gold_path: str, prefix: str) -> list[str]:
    """Views ``<prefix>videos`` and so on in the catalog over the tables as published
    last; a view is replaced in one step. Returns their names."""
    version = current_version(spark, gold_path)
    replace_view(spark, f"{prefix}videos", _layered(gold_path, _state_of(spark, version).layers))
    for name in GOLD_TABLES[1:]:
        replace_view(spark, f"{prefix}{name}", f"SELECT * FROM parquet.`{version}/{name}`")
    return [f"{prefix}{name}" for name in GOLD_TABLES]


def register_silver(spark: SparkSession, silver_path: str, name: str) -> None:
    """A view in the catalog over a table fed by ingest. It follows the ledger by itself,
    so it is made once."""
    columns = ", ".join(f"`{c}`" for c in read_silver(spark, silver_path).columns)
    live = Ledger(spark, silver_path).sql()
    replace_view(
        spark, name, f"SELECT {columns} FROM parquet.`{silver_path}` LEFT SEMI JOIN ({live}) USING ({TAKING})"
    )


def publish_gold(
    silver: DataFrame,
    gold_path: str,
    published_as: str = "date",
    keep: int = KEPT_VERSIONS,
    catalog_prefix: str | None = None,
    mark: Published | None = None,
) -> int:
    """Clean, validate, and publish the three gold tables.

    They are written to the folder of a new version. The clean table is computed
    once, and its write counts the rule violations on its way; the gate is decided on
    those counts, on the columns that silver has and on a check for duplicate keys.
    Both rollups read the written files. Only then is the version marked, which
    switches all three tables in one step; before that a failure of any kind leaves
    gold as it was, and nothing behind. With a prefix, the catalog's views over the three
    tables then move to the new version. Returns the clean rows.
    """
    spark = silver.sparkSession
    absent = missing_columns(silver)
    if absent:
        raise QualityError([f"missing column {name}" for name in absent])
    version = new_version(gold_path)
    published = False
    try:
        videos = clean_videos(silver, published_as)
        # After the last shuffle, so that the counts are those of the writing stage.
        observed = Observation()
        checked = gathered(videos, *DATE_PARTS).observe(observed, *rule_counts(videos.columns))
        checked.write.partitionBy(*DATE_PARTS).parquet(f"{version}/videos")
        found = dict(observed.get)
        if published_as == "text":
            # Unreadable dates are kept here, in a NULL day, as a matter of design.
            found.pop("null_partition", None)
        found[EMPTY] = int(found[ROWS] == 0)
        failures = failures_in(found)
        written = spark.read.schema(videos.schema).parquet(f"{version}/videos")
        if not failures and not duplicate_keys(written).isEmpty():
            failures = [DUPLICATES]
        if failures:
            raise QualityError(failures)
        replace_table(channel_rollup(written), f"{version}/channel_analysis")
        replace_table(daily_rollup(written), f"{version}/daily_analysis")
        publish_version(spark, version, mark.text() if mark else "")
        published = True
    finally:
        if not published:
            discard(spark, version)
    if catalog_prefix is not None:
        register_gold(spark, gold_path, catalog_prefix)
    retire_gold(spark, gold_path, keep)
    return int(found[ROWS])


def gold_table(spark: SparkSession, gold_path: str, name: str) -> DataFrame:
    """A gold table as published last."""
    if name == "videos":
        return gold_videos(spark, gold_path)
    return spark.read.parquet(f"{current_version(spark, gold_path)}/{name}")
