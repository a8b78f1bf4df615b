"""The ledger of a fed table: which files were taken, and which rows count.

An entry is a small Parquet table: a row per file with the number of its taking, or no
number once the file was withdrawn. It counts from the moment its commit exists, a file
named by the next version and created exclusively, which holds the entry's name. So
there is one order of commits, a reader sees whole commits or nothing of them, and of two
writers at the same version one is refused and has to look at the table again.

The rows that count are those whose taking is the last one of its file. All of this can
be said in SQL over the files, which is how it is read, also by the catalog's view.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F

from vidlake.sources.writers import LEDGER, create_file, exists, times_in

TAKING = "_taking"
# What a file's row says. "day" is the folder of its day's snapshot, if it is in one.
ROWS = "file string, day string, kind string, modified timestamp, length bigint, taking bigint, compacted boolean"
_ENTRY = f"{ROWS}, version bigint, entry string"


class Conflict(Exception):
    """Another writer has made the version that was to be made."""


@dataclass(frozen=True)
class Ledger:
    spark: SparkSession
    table: str

    @property
    def entries(self) -> str:
        return f"{self.table}/{LEDGER}/entries"

    @property
    def commits(self) -> str:
        return f"{self.table}/{LEDGER}/commits"

    def exists(self) -> bool:
        return exists(self.spark, self.commits)

    def create(self) -> None:
        """An empty ledger; nothing happens if there is one."""
        if not self.exists():
            try:
                self.commit(self.spark.createDataFrame([], ROWS), 1)
            except Conflict:
                pass

    def times(self) -> dict[int, int]:
        """When each commit was made, in milliseconds, by version."""
        return {int(name): made for name, made in times_in(self.spark, self.commits).items()}

    def version(self) -> int:
        """The last version."""
        return max(self.times(), default=0)

    def committed(self) -> DataFrame:
        """Names of the entries that count. By a pattern, as Spark takes two readings of
        one folder in a query for the same, also if the folder has changed in between."""
        return self.spark.read.text(f"{self.commits}/*")

    def state(self, version: int | None = None) -> DataFrame:
        """The last row of every file up to a version, withdrawn ones included."""
        entries = self.spark.read.schema(_ENTRY).parquet(f"{self.entries}/*")
        rows = entries.join(self.committed(), F.col("entry") == F.col("value"), "left_semi")
        if version is not None:
            rows = rows.filter(F.col("version") <= version)
        names = [part.split()[0] for part in ROWS.split(", ")] + ["version"]
        last = F.max_by(F.struct(*names), "version").alias("last")
        return rows.groupBy("file").agg(last).select("last.*")

    def live(self, version: int | None = None) -> DataFrame:
        """The takings that count."""
        return self.state(version).filter(F.col("taking").isNotNull())

    def swept(self) -> int:
        """Up to this version, rows that no longer count may have been deleted."""
        return max(map(int, times_in(self.spark, f"{self.table}/{LEDGER}/swept")), default=0)

    def mark_swept(self, version: int) -> None:
        create_file(self.spark, f"{self.table}/{LEDGER}/swept/{version:020d}", "")

    def commit(self, rows: DataFrame, version: int, over: int = 0) -> None:
        """Make rows count, as the given version, which must be the next one. With
        ``over``, they say all that still counts of the versions up to that one. The
        entry of a refused commit stays, as a reader may be at it; sweep() takes it."""
        entry = f"{version:020d}-{uuid.uuid4().hex}" + (f"-over-{over:020d}" if over else "")
        names = [part.split()[0] for part in ROWS.split(", ")]
        labelled = rows.select(*names, F.lit(version).cast("bigint").alias("version"), F.lit(entry).alias("entry"))
        labelled.coalesce(1).write.parquet(f"{self.entries}/{entry}")
        if version != self.version() + 1 or not create_file(self.spark, f"{self.commits}/{version:020d}", entry):
            raise Conflict(f"version {version} of {self.table} was made by another writer")

    def sql(self) -> str:
        """The takings that count, as SQL over the files."""
        return (
            f"SELECT max_by(taking, version) AS {TAKING} FROM parquet.`{self.entries}/*` "
            f"WHERE entry IN (SELECT value FROM text.`{self.commits}`) GROUP BY file "
            f"HAVING max_by(taking, version) IS NOT NULL"
        )


def read_silver(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The silver table, whichever job feeds it; partition columns prune as usual. A fed
    table can be read as it was at an earlier version of its ledger, while the files of
    that version are there."""
    ledger = Ledger(spark, path)
    if not ledger.exists():
        return spark.read.parquet(path)
    try:
        rows = spark.read.parquet(path)
    except PySparkException:
        # No file of the table is there yet.
        from vidlake.operators.mapping import silver_rows
        from vidlake.schemas import BRONZE

        return silver_rows(bronze=spark.createDataFrame([], BRONZE))
    takings = ledger.live(version).select(F.col("taking").alias(TAKING))
    return rows.join(takings, TAKING, "left_semi").drop(TAKING)
