"""Incremental ingest: each run takes only the files no run has taken before.

A run lists what there is, writes the list down, anti-joins it with the ledger and takes
the rest in batches, whatever its age. Rows carry the number of the taking of their file,
and count when the ledger's commit names it, so a run that died leaves nothing visible
and no row of the table is ever changed.

A folder named by a day (``day=`` or ``date=`` in the last place) holds one snapshot.
Landing the day again replaces its files, whose names are new then; when new files are
found in such a folder, files of it that are gone are withdrawn in the same commit, and
an empty re-run, which leaves a file without records beside it, withdraws them all. Files that
vanish by themselves, as when a day is put away, keep their rows.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from vidlake.operators.mapping import silver_rows
from vidlake.schemas import DATE_PARTS
from vidlake.session import scratch_dir, size_shuffles
from vidlake.sources.readers import FILE, as_paths, quarantined, read_bronze, read_csv
from vidlake.sources.writers import EMPTY_DAY, counted, discard, exists, gathered, watched
from vidlake.streaming.ledger import ROWS, TAKING, Conflict, Ledger, read_silver

__all__ = ["FILES_PER_BATCH", "Taken", "ingest", "read_silver"]

# Files read by one job, about, so that a large backlog is taken in steps. Files of one
# day stay together.
FILES_PER_BATCH = 10_000
# Times a commit is tried again after another writer was faster.
ATTEMPTS = 100
_DAY_FOLDER = r"^(.*/(?:day|date)=[^/]*)/[^/]*$"
_EMPTY_DAY = rf"^(.*/){EMPTY_DAY}((?:day|date)=[^/]*)\.json$"


@dataclass(frozen=True)
class Taken:
    """Files taken, records read of them and, among these, those that did not parse;
    files withdrawn because their day was landed again."""

    files: int
    rows_read: int
    rows_broken: int
    files_withdrawn: int = 0


def _listed(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Files below a path; none is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    file = F.col("_metadata.file_path")
    empty = F.concat(*(F.regexp_extract(file, _EMPTY_DAY, n) for n in (1, 2)))
    day = F.concat(F.regexp_extract(file, _DAY_FOLDER, 1), empty)
    return files.select(
        F.lit(kind).alias("kind"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_modification_time").alias("modified"),
        F.col("_metadata.file_size").alias("length"),
        F.when(day != "", day).alias("day"),
    )


def _changes(there: DataFrame, live: DataFrame) -> DataFrame:
    """Files to take, and files to withdraw with the taking they have."""
    new = there.join(live, ["file", "modified", "length"], "left_anti")
    landed = new.filter(F.col("day").isNotNull()).select("day").distinct()
    gone = live.join(landed, "day", "left_semi").join(there, "file", "left_anti")
    names = ["kind", "file", "modified", "length", "day"]
    return new.select(*names, F.lit(None).cast("bigint").alias("withdrawn")).unionByName(
        gone.select(*names, F.col("taking").alias("withdrawn"))
    )


def ingest(
    spark: SparkSession,
    silver_path: str,
    bronze_path: str | None = None,
    csv_path: str | None = None,
    form: str = "any",
    files_per_batch: int = FILES_PER_BATCH,
    quarantine_path: str | None = None,
) -> Taken:
    """Take the new and the changed files of both sources into the silver table.

    A file that was replaced replaces its rows, a day that was landed again those of the
    day. The batch job does not write to a table fed this way, nor the other way round.
    Runs may meet: of two that took a file at once, the rows of one count. Files that
    change without a change of time and length go unnoticed.
    """
    if bronze_path is None and csv_path is None:
        raise ValueError("at least one input is needed")
    ledger = Ledger(spark, silver_path)
    if exists(spark, silver_path) and not ledger.exists():
        raise ValueError(f"{silver_path} was written by the batch job, whose rows this would hide")
    ledger.create()
    version = ledger.version()
    scratch = scratch_dir(spark)
    try:
        sources = [(bronze_path, "bronze"), (csv_path, "csv")]
        listed = [_listed(spark, path, kind) for path, kind in sources if path is not None]
        there = listed[0] if len(listed) == 1 else listed[0].unionByName(listed[1])
        there.write.parquet(f"{scratch}/there")
        there = spark.read.schema(there.schema).parquet(f"{scratch}/there")
        changes = _changes(there, ledger.live(version))
        changes.write.parquet(f"{scratch}/changes")
        changes = spark.read.schema(changes.schema).parquet(f"{scratch}/changes")
        new = F.col("withdrawn").isNull()
        size = changes.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.when(new, F.col("length"))), F.lit(0))).first()
        size_shuffles(spark, size[1])
        batches = -(-size[0] // files_per_batch)
        if not batches:
            return Taken(0, 0, 0)
        # Ranges of days and of other files' names; a day is in one of them.
        ranged = changes.repartitionByRange(batches, "kind", F.coalesce("day", "file"))
        ranged = ranged.withColumn("batch", F.spark_partition_id())
        ranged.write.partitionBy("batch").parquet(f"{scratch}/batches")
        schema = f"{ranged.drop('batch')._jdf.schema().toDDL()}, batch int"
        planned = spark.read.schema(schema).parquet(f"{scratch}/batches")
        done = [Taken(0, 0, 0)]
        for number in range(batches):
            batch = planned.filter(F.col("batch") == number).drop("batch").collect()
            if batch:
                done.append(_take(ledger, batch, form, version, quarantine_path))
    finally:
        discard(spark, scratch)
    return Taken(*(sum(counts) for counts in zip(*((t.files, t.rows_read, t.rows_broken, t.files_withdrawn) for t in done))))


def _take(ledger: Ledger, batch: list[Row], form: str, version: int, quarantine_path: str | None) -> Taken:
    """Write the rows of a batch's files, then make them count."""
    spark = ledger.spark
    new = [row for row in batch if row["withdrawn"] is None]
    gone = [row for row in batch if row["withdrawn"] is not None]
    takings = {row["file"]: uuid.uuid4().int >> 66 for row in new}
    n_written = n_broken = 0
    if new:
        n_written, n_broken = _write(ledger, new, takings, form, quarantine_path)
    names = [part.split()[0] for part in ROWS.split(", ")]
    rows = [tuple({**row.asDict(), "taking": takings.get(row["file"]), "compacted": False}[n] for n in names) for row in new + gone]
    mine = spark.createDataFrame(rows, ROWS)
    seen = spark.createDataFrame([(row["file"], row["withdrawn"]) for row in gone], "file string, seen bigint")
    commit_over(ledger, version, lambda now: mine if now is None else _still(mine, seen, now))
    return Taken(len(new), n_written + n_broken, n_broken, len(gone))


def _still(mine: DataFrame, seen: DataFrame, now: DataFrame) -> DataFrame:
    """What is still to be said after other commits: takings of files that nobody took
    since in the same or a later form, and withdrawals of what is as it was."""
    now = now.select("file", F.col("modified").alias("_modified"), F.col("taking").alias("_taking"))
    rows = mine.join(now, "file", "left").join(seen, "file", "left")
    newer = F.coalesce(F.col("modified") > F.col("_modified"), F.lit(True)) | F.col("_taking").isNull()
    keep = F.when(F.col("taking").isNotNull(), newer).otherwise(F.col("seen") == F.col("_taking"))
    return rows.filter(keep)


def commit_over(ledger: Ledger, version: int, rows_for, over: int = 0) -> int:
    """Commit rows that were made from the state at a version; once others have
    committed, from what ``rows_for`` makes of the state by then."""
    for _ in range(ATTEMPTS):
        last = ledger.version()
        rows = rows_for(None if last == version else ledger.state(last))
        try:
            ledger.commit(rows, last + 1, over)
            return last + 1
        except Conflict:
            continue
    raise Conflict(f"{ledger.table}: other writers were faster {ATTEMPTS} times")


def _write(ledger: Ledger, new: list[Row], takings: dict[str, int], form: str, quarantine_path: str | None) -> tuple[int, int]:
    """Rows written and rows refused of some files."""
    spark = ledger.spark
    sources, counts = {}, []
    for kind, name in (("bronze", "bronze"), ("csv", "historical")):
        paths = as_paths([row["file"] for row in new if row["kind"] == kind])
        if paths:
            source = read_csv(spark, paths) if kind == "csv" else read_bronze(spark, paths, form=form)
            landed, refused = watched(source)
            sources[name] = source, landed.filter(F.col("_corrupt_record").isNull())
            counts.append(refused)
    rows = silver_rows(**{name: good for name, (_, good) in sources.items()}, keep=(FILE,))
    # As many rows as the batch has files.
    known = F.broadcast(spark.createDataFrame(list(takings.items()), f"{FILE} string, {TAKING} bigint"))
    rows, written = counted(gathered(rows.join(known, FILE).drop(FILE), *DATE_PARTS))
    rows.write.mode("append").partitionBy(*DATE_PARTS).option("compression", "snappy").parquet(ledger.table)
    n_broken = sum(int(refused.get["broken"]) for refused in counts)
    if quarantine_path is not None and n_broken:
        run = uuid.uuid4().hex
        for source, _ in sources.values():
            bad = quarantined(source).withColumn("run", F.lit(run))
            bad.write.mode("append").partitionBy("run").parquet(quarantine_path)
    return int(written.get["records"]), n_broken
