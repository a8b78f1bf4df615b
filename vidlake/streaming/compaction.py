"""Upkeep of a fed table: few large files instead of many, and nothing that no longer
counts.

compact() writes the rows of takings that count once more, in files of the advisory size
sorted by day of extraction and id, under new numbers, and one commit makes those count
instead of the old ones. Readers of an earlier state still find the old rows. A run that
dies leaves rows without a number, which nobody sees. Files that a feeder replaced or
withdrew in the meantime stay as the feeder said.

sweep() deletes what nobody can see any more: data files none of whose takings counted at
any time since ``older_than``, those of runs that died before then, and ledger entries
that a later compaction of everything has made superfluous. It may be repeated at any
time. Feeders and readers must not take longer than that.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from vidlake.schemas import DATE_PARTS
from vidlake.session import size_shuffles, stored_bytes
from vidlake.sources.writers import counted, delete, gathered, times_in
from vidlake.streaming.ingest import commit_over
from vidlake.streaming.ledger import ROWS, TAKING, Ledger

WEEK = 7 * 24 * 3600.0


@dataclass(frozen=True)
class Compacted:
    """Takings and rows written once more, and the version that made them count."""

    files: int
    records: int
    version: int


@dataclass(frozen=True)
class Swept:
    data_files: int
    ledger_entries: int


def compact(spark: SparkSession, silver_path: str, everything: bool = False) -> Compacted:
    """Rewrite what was taken since the last compaction, or everything, which also lets
    sweep() shorten the ledger."""
    ledger = Ledger(spark, silver_path)
    version = ledger.version()
    if not version:
        raise ValueError(f"{silver_path} is not fed by incremental ingest")
    live = ledger.live(version)
    chosen = live if everything else live.filter(~F.col("compacted"))
    files = chosen.count()
    if not files:
        return Compacted(0, 0, version)
    # The same on every use: a hash of the file's name and of this run, of 62 bits.
    run = uuid.uuid4().hex
    number = F.shiftrightunsigned(F.xxhash64(F.lit(run), "file", "taking"), 2)
    renewed = chosen.withColumns({"old": F.col("taking"), "taking": number, "compacted": F.lit(True)})
    size_shuffles(spark, stored_bytes(spark, silver_path))
    rows = spark.read.parquet(silver_path)
    names = [name for name in rows.columns if name != TAKING]
    known = renewed.select(F.col("old").alias(TAKING), F.col("taking").alias("_new"))
    moved = rows.join(known, TAKING).select(*names, F.col("_new").alias(TAKING))
    moved, written = counted(gathered(moved, *DATE_PARTS).sortWithinPartitions(*DATE_PARTS, "extraction_date", "video_id"))
    moved.write.mode("append").partitionBy(*DATE_PARTS).option("compression", "snappy").parquet(silver_path)
    records = int(written.get["records"])

    def still(now: DataFrame | None) -> DataFrame:
        if now is not None:
            same = now.select("file", F.col("taking").alias("old"))
            return renewed.join(same, ["file", "old"], "left_semi")
        return renewed

    made = commit_over(ledger, version, still, version if everything else 0)
    return Compacted(files, records, made)


def sweep(spark: SparkSession, silver_path: str, older_than: float = WEEK) -> Swept:
    """Delete what has not counted for so many seconds."""
    ledger = Ledger(spark, silver_path)
    before = int((time.time() - older_than) * 1000)
    made = ledger.times()
    old = [version for version, at in made.items() if at < before]
    if not old:
        return Swept(0, 0)
    # What counted then, and what has come to count since.
    entries = spark.read.schema(f"{ROWS}, version bigint, entry string").parquet(f"{ledger.entries}/*")
    committed = entries.join(ledger.committed(), F.col("entry") == F.col("value"), "left_semi")
    since = committed.filter((F.col("version") > max(old)) & F.col("taking").isNotNull()).select("taking")
    needed = ledger.live(max(old)).select("taking").union(since).distinct()
    rows = spark.read.parquet(silver_path).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_modification_time").alias("written"), TAKING
    )
    takings = rows.distinct().join(needed.withColumn("seen", F.lit(1)), F.col(TAKING) == F.col("taking"), "left")
    unseen = takings.groupBy("path").agg(F.max("seen").alias("seen"), F.max("written").alias("written"))
    unseen = unseen.filter(F.col("seen").isNull() & (F.unix_millis("written") < before)).select("path")
    # Said before anything is deleted.
    ledger.mark_swept(max(old))
    data_files = 0
    # Names of files to delete, a partition of them at a time.
    for row in unseen.toLocalIterator():
        delete(spark, row["path"])
        data_files += 1
    return Swept(data_files, _shortened(ledger, made, before))


def _shortened(ledger: Ledger, made: dict[int, int], before: int) -> int:
    """Drop commits that a compaction of everything stands for, the oldest first, so that
    no withdrawal goes before what it withdraws, and then entries without a commit."""
    spark = ledger.spark
    names = {row["value"] for row in ledger.committed().collect()}
    over = [
        (int(name.rpartition("-over-")[2]), int(name[:20])) for name in names if "-over-" in name
    ]
    # Only once readers have had the time to move on to it.
    base = max((covered for covered, version in over if made[version] < before), default=0)
    for version in sorted(v for v in made if v <= base):
        delete(spark, f"{ledger.commits}/{version:020d}")
    kept = {name for name in names if int(name[:20]) > base}
    entries = times_in(spark, ledger.entries)
    gone = [name for name, at in entries.items() if name not in kept and at < before]
    for name in gone:
        delete(spark, f"{ledger.entries}/{name}", whole=True)
    return len(gone)
