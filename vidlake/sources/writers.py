"""Writers and the run report."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Container
from dataclasses import dataclass
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from vidlake.functions.dates import lenient_date, path_parts
from vidlake.schemas import CORRUPT, DATE_PARTS

# Where incremental ingest keeps its ledger, inside the table's folder.
LEDGER = "_ledger"
# Names of files that stand for a day without records.
EMPTY_DAY = "empty-"
# A published version has this file in it.
_MARK = "_PUBLISHED"


def gathered(df: DataFrame, *columns: str) -> DataFrame:
    """Bring the rows of a partition together before a partitioned write, so
    that files are few. It is a hint: Spark splits a large day over many tasks
    and puts small days together, by the advisory partition size."""
    return df.hint("rebalance", *(F.col(name) for name in columns))


def counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """The rows with an Observation that counts them as they are written. Apply
    it after the last shuffle: Spark may run an earlier stage twice after losing
    an executor and would then count its rows twice, but it takes the result of
    each task of the writing stage once."""
    observed = Observation()
    return df.observe(observed, F.count(F.lit(1)).alias("records")), observed


@dataclass(frozen=True)
class Outcome:
    """What a job wrote and refused, in the shape of an Observation."""

    records: int
    broken: int

    @property
    def get(self) -> dict[str, int]:
        return {"records": self.records, "broken": self.broken}


def watched(landed: DataFrame) -> tuple[DataFrame, Observation]:
    """Landed rows with an Observation of those that did not parse. It stands before
    a shuffle, so a stage that Spark repeats counts them again."""
    observed = Observation()
    return landed.observe(observed, F.count_if(F.col(CORRUPT).isNotNull()).alias("broken")), observed


def land_by_day(
    records: DataFrame, root: str, run_date: dt.date | None = None, **options: object
) -> Observation:
    """Snapshot as JSON lines under year=/month=/day= of the extraction date.
    Days in the input replace what the root holds for them; others stay. The day of
    the run, if given, is replaced also when there is no record for it. Options are
    those of Spark's writer, as ``compression``; a compressed file is one task later,
    and files are no larger than the advisory partition size makes them."""
    extracted = lenient_date(F.col("extraction_date"))
    rows = gathered(records.withColumns(path_parts(extracted)), *DATE_PARTS)
    day = run_date and f"year={run_date:%Y}/month={run_date:%m}/day={run_date:%d}"
    return _land(rows, root, day, *DATE_PARTS, **options)


def land_by_date(
    records: DataFrame, root: str, feed: str, run_date: dt.date | None = None, **options: object
) -> Observation:
    """The same under <feed>/date=yyyy-MM-dd, with non-ASCII text escaped."""
    rows = gathered(records.withColumn("date", F.col("extraction_date")), "date")
    day = run_date and f"date={run_date:%Y-%m-%d}"
    return _land(rows, f"{root}/{feed}", day, "date", writeNonAsciiCharacterAsCodePoint=True, **options)


def _land(
    rows: DataFrame, path: str, day: str | None, *partitions: str, **options: object
) -> Observation:
    rows, observed = counted(rows)
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.options(**options).partitionBy(*partitions).json(path)
    if day and not observed.get["records"]:
        discard(rows.sparkSession, f"{path}/{day}")
        # A file without records beside it, so that a reader of what is new can tell an
        # empty day from one that was put away.
        parent, _, name = f"{path}/{day}".rpartition("/")
        discard(rows.sparkSession, f"{parent}/{EMPTY_DAY}{name}.json")
        create_file(rows.sparkSession, f"{parent}/{EMPTY_DAY}{name}.json", "[]")
    return observed


def append_table(df: DataFrame, path: str, table: str | None = None) -> Observation:
    """Add rows to the day-partitioned snappy Parquet table. With a name, the
    table and its new partitions are registered in the catalog as well."""
    if exists(df.sparkSession, f"{path}/{LEDGER}"):
        raise ValueError(f"{path} is fed by incremental ingest, which would hide these rows")
    rows, observed = counted(gathered(df, *DATE_PARTS))
    writer = rows.write.mode("append").format("parquet")
    writer = writer.partitionBy(*DATE_PARTS).option("compression", "snappy")
    if table is None:
        writer.save(path)
    else:
        writer.option("path", path).saveAsTable(table)
    return observed


def write_csv(df: DataFrame, path: str, spread: bool = True, **options: object) -> Observation:
    """Rows as CSV files with a header, in the form the CSV readers take; the
    files are about as large as the advisory partition size. Rows of even tasks need
    not be spread; their files are those of the tasks, for which Spark's writer has the
    option ``maxRecordsPerFile``."""
    rows, observed = counted(df.hint("rebalance") if spread else df)
    keep = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    rows.write.options(header=True, quote='"', escape='"', **keep, **options).csv(path)
    return observed


def replace_table(df: DataFrame, path: str, *partitions: str) -> Observation:
    """Replace a Parquet table as a whole, partitioned or not. The path must not
    be one the rows are read from."""
    rows, observed = counted(gathered(df, *partitions) if partitions else df)
    rows.write.mode("overwrite").partitionBy(*partitions).parquet(path)
    return observed


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    """Is there a file or folder of this name?"""
    fs, target = _file_system(spark, path)
    return fs.exists(target)


def create_file(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file unless there is one of this name; of several writers at once
    one succeeds, where the store creates files exclusively."""
    fs, target = _file_system(spark, path)
    if fs.exists(target):
        return False
    try:
        out = fs.create(target, False)
    except Py4JJavaError as error:
        if "FileAlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    out.write(bytearray(text, "utf-8"))
    out.close()
    return True


def times_in(spark: SparkSession, path: str) -> dict[str, int]:
    """Names in a folder with their modification times in milliseconds."""
    fs, target = _file_system(spark, path)
    if not fs.exists(target):
        return {}
    return {s.getPath().getName(): s.getModificationTime() for s in fs.listStatus(target)}


def new_version(root: str) -> str:
    """A fresh folder for the next version of the tables under the root; folders
    sort by the time they were named."""
    now = dt.datetime.now(dt.timezone.utc)
    return f"{root}/v{now:%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"


def publish_version(spark: SparkSession, version: str, text: str = "") -> None:
    """Make a complete version the current one. Creating one small file does it, in
    any store, so readers find either all of the new tables or all of the old."""
    if not create_file(spark, f"{version}/{_MARK}", text):
        raise FileExistsError(f"{version} is published already")


def mark_of(spark: SparkSession, version: str) -> str:
    """What the mark of a published version says."""
    fs, mark = _file_system(spark, f"{version}/{_MARK}")
    stream = fs.open(mark)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def published_versions(spark: SparkSession, root: str) -> list[str]:
    """Published versions, the current one last."""
    fs, pattern = _file_system(spark, f"{root}/v*/{_MARK}")
    found = fs.globStatus(pattern) or []
    return sorted(f"{root}/{status.getPath().getParent().getName()}" for status in found)


def current_version(spark: SparkSession, root: str) -> str:
    """The folder of the tables as published last."""
    found = published_versions(spark, root)
    if not found:
        raise FileNotFoundError(f"nothing is published under {root}")
    return found[-1]


def retire_versions(spark: SparkSession, root: str, keep: int, needed: Container[str] = ()) -> None:
    """Delete all published versions but the last ones, and those still needed."""
    for version in published_versions(spark, root)[: -max(1, keep)]:
        if version not in needed:
            discard(spark, version)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder of ours, if it is there."""
    delete(spark, path, whole=True)


def delete(spark: SparkSession, path: str, whole: bool = False) -> None:
    """Delete a file, named as in a metadata column or by its path, or a whole folder."""
    fs, target = _file_system(spark, unquote(path) if "://" in path or path.startswith("file:") else path)
    fs.delete(target, whole)


def run_report(
    spark: SparkSession, message: str, path: str, write: Callable[[], Observation | Outcome]
) -> DataFrame:
    """Run a write and tell in one row how it went: records written, and input that
    was refused, if the write counts that. A failure is reported, not raised."""
    try:
        done = write().get
        row = ("succeeded", message, int(done["records"]), done.get("broken"), path, None)
    except Exception as error:
        row = ("failed", message, None, None, path, str(error))
    schema = "outcome string, message string, records bigint, broken bigint, output_path string, error string"
    return spark.createDataFrame([row], schema)


_RUN = (
    "run_id string, command string, outcome string, message string, records bigint, broken bigint, "
    "output_path string, error string, started timestamp, ended timestamp"
)


def log_run(
    spark: SparkSession,
    log_path: str,
    run_id: str,
    command: str,
    started: dt.datetime,
    done: Outcome | None = None,
    path: str | None = None,
    error: str | None = None,
) -> None:
    """Keep how a run went, as one row in a table with a folder per run; a run that is
    repeated under its id replaces its row."""
    outcome = "succeeded" if error is None else "failed"
    message = f"{command} {outcome}"
    counts = (done.records, done.broken) if done else (None, None)
    row = (run_id, command, outcome, message, *counts, path, error, started, dt.datetime.now(dt.timezone.utc))
    frame = spark.createDataFrame([row], _RUN).coalesce(1)
    frame.drop("run_id").write.mode("overwrite").parquet(f"{log_path}/run_id={run_id}")


def read_runs(spark: SparkSession, log_path: str) -> DataFrame:
    """All runs that were kept."""
    return spark.read.schema(_RUN).parquet(log_path)


def replace_view(spark: SparkSession, name: str, query: str) -> None:
    """A view of this name in the catalog, in place of the one there was."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {query}")
