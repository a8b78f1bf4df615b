"""The jobs as commands: spark-submit vidlake_job.py gold --silver ... --gold ..."""

from __future__ import annotations

import argparse
import datetime as dt
import uuid
from collections.abc import Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from vidlake.operators.quality import enforce, quality_report
from vidlake.plans import jobs
from vidlake.plans.reports import REPORTS, report
from vidlake.plans.upkeep import maintain_gold
from vidlake.session import size_shuffles, stored_bytes
from vidlake.sources.readers import FORMS, read_table
from vidlake.sources.writers import Outcome, log_run
from vidlake.streaming.compaction import WEEK, compact, sweep
from vidlake.streaming.ingest import FILES_PER_BATCH, ingest, read_silver


def _arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="vidlake")
    commands = parser.add_subparsers(dest="command", required=True)

    def command(
        name: str,
        about: str,
        *required: str,
        optional: Sequence[str] = (),
        flags: Sequence[str] = (),
    ) -> argparse.ArgumentParser:
        sub = commands.add_parser(name, help=about)
        for option in required:
            sub.add_argument(f"--{option}", required=True)
        for option in optional:
            sub.add_argument(f"--{option}")
        for flag in flags:
            sub.add_argument(f"--{flag}", action="store_true")
        return sub

    chart = command("land-chart", "chart responses to a snapshot", "details", "bronze", "feed")
    search = command("land-search", "search responses to a snapshot", "search", "details", "bronze")
    for sub in (chart, search):
        sub.add_argument("--date", type=dt.date.fromisoformat, required=True)
    chart.add_argument("--rows", type=int, help="keep only so many of the most viewed")
    command("split-history", "large CSV files to small ones", "csv", "out")
    silver = command(
        "to-silver",
        "all of both sources to silver",
        "silver",
        optional=("bronze", "csv", "table", "quarantine"),
    )
    silver.add_argument("--split-csv", action="store_true")
    new = command(
        "ingest", "new files to silver", "silver", optional=("bronze", "csv", "quarantine")
    )
    for sub in (chart, search, silver, new):
        sub.add_argument("--form", choices=FORMS, default="any", help="of JSON files")
    new.add_argument("--files-per-batch", type=int, default=FILES_PER_BATCH)
    command("clean", "silver to the clean table", "silver", "clean", flags=("text-dates",))
    gold = command("gold", "silver to gold, behind the gate", "silver", "gold", flags=("text-dates",))
    command("quality", "rule violations of a table", "table", flags=("enforce",))
    gold.add_argument("--incremental", action="store_true", help="only what changed in a fed silver table")
    gold.add_argument("--catalog", help="prefix of the catalog's views over the gold tables")
    new.add_argument("--view", help="name of the catalog's view over the silver table")
    command("compact", "rewrite what was fed into large files", "silver", flags=("everything",))
    command("sweep", "delete what nobody can see any more", "silver").add_argument(
        "--older-than", type=float, default=WEEK, help="seconds; a week if not given"
    )
    shown = command("report", "show a report", "gold")
    shown.add_argument("name", choices=sorted(REPORTS))
    shown.add_argument("--rows", type=int, help="rows to show, all if not given")
    shown.add_argument("--out", help="write the report there as CSV instead")
    for sub in commands.choices.values():
        sub.add_argument("--run-log", help="table that keeps how each run went")
        sub.add_argument("--run-id", help="name of this run; a repeated run has the same")
    return parser


def _tell(done: DataFrame) -> Outcome:
    done.show(truncate=False)
    row = done.first()
    if row.outcome == "failed":
        raise SystemExit(1) from RuntimeError(row.error)
    return Outcome(row.records, row.broken)


def run(spark: SparkSession, argv: Sequence[str] | None = None) -> None:
    """A command; with --run-log, how it went is kept there, also if it failed."""
    args = _arguments().parse_args(argv)
    if not args.run_log:
        _perform(spark, args)
        return
    started = dt.datetime.now(dt.timezone.utc)
    kept = partial(log_run, spark, args.run_log, args.run_id or uuid.uuid4().hex, args.command, started)
    paths = [getattr(args, name, None) for name in _OUTPUTS[args.command]]
    path = next((p for p in paths if p), None)
    try:
        done = _perform(spark, args)
    except (Exception, SystemExit) as error:
        kept(path=path, error=str(error.__cause__ or error))
        raise
    kept(done, path)


# Options that name what a command writes, or what it looks at.
_OUTPUTS = {
    "land-chart": ("bronze",), "land-search": ("bronze",), "split-history": ("out",), "to-silver": ("silver",),
    "ingest": ("silver",), "compact": ("silver",), "sweep": ("silver",), "clean": ("clean",), "gold": ("gold",),
    "quality": ("table",), "report": ("out", "gold"),
}


def _perform(spark: SparkSession, args: argparse.Namespace) -> Outcome | None:
    inputs = [getattr(args, name, None) for name in ("details", "search", "csv")]
    if args.command == "to-silver":
        inputs.append(args.bronze)
    if args.command == "ingest":
        inputs = []  # sized by its new files
    if args.command in ("clean", "gold"):
        inputs.append(args.silver)
    if args.command == "quality":
        inputs.append(args.table)
    size_shuffles(spark, stored_bytes(spark, *(path for path in inputs if path)))
    dates = "text" if getattr(args, "text_dates", False) else "date"

    if args.command == "land-chart":
        return _tell(jobs.land_chart(
            spark, args.details, args.bronze, args.feed, args.date, args.form, args.rows))
    elif args.command == "land-search":
        return _tell(jobs.land_search(
            spark, args.search, args.details, args.bronze, args.date, args.form))
    elif args.command == "split-history":
        records = jobs.split_history(spark, args.csv, args.out).get["records"]
        print(records, "records")
        return Outcome(records, 0)
    elif args.command == "to-silver":
        written = jobs.bronze_to_silver(
            spark,
            args.silver,
            args.bronze,
            args.csv,
            args.table,
            args.quarantine,
            form=args.form,
            split_csv=args.split_csv,
        )
        print(written.records, "records,", written.broken, "broken")
        return written
    elif args.command == "ingest":
        taken = ingest(
            spark,
            args.silver,
            args.bronze,
            args.csv,
            form=args.form,
            files_per_batch=args.files_per_batch,
            quarantine_path=args.quarantine,
        )
        if args.view:
            jobs.register_silver(spark, args.silver, args.view)
        gone = f", {taken.files_withdrawn} files withdrawn" if taken.files_withdrawn else ""
        print(f"{taken.files} files, {taken.rows_read} rows read, {taken.rows_broken} broken{gone}")
        return Outcome(taken.rows_read - taken.rows_broken, taken.rows_broken)
    elif args.command == "compact":
        done = compact(spark, args.silver, args.everything)
        print(done.files, "files,", done.records, "records, version", done.version)
        return Outcome(done.records, 0)
    elif args.command == "sweep":
        swept = sweep(spark, args.silver, args.older_than)
        print(swept.data_files, "files,", swept.ledger_entries, "ledger entries deleted")
    elif args.command == "clean":
        written = jobs.silver_to_clean(read_silver(spark, args.silver), args.clean, dates)
        print(written.get["records"], "records")
        return Outcome(written.get["records"], 0)
    elif args.command == "gold":
        if args.incremental:
            kept = maintain_gold(spark, args.silver, args.gold, dates, catalog_prefix=args.catalog)
            print("everything," if kept.whole else "changes,", kept.keys, "records" if kept.whole else "keys")
            return Outcome(kept.keys, 0)
        records = jobs.publish_gold(
            read_silver(spark, args.silver), args.gold, dates, catalog_prefix=args.catalog
        )
        print(records, "records")
        return Outcome(records, 0)
    elif args.command == "quality":
        table = read_table(spark, args.table)
        quality_report(table).show(100, truncate=False)
        if args.enforce:
            enforce(table)
    else:
        shown = report(spark, args.gold, args.name)
        if args.out:
            shown.write.option("header", True).csv(args.out)
        else:
            shown.show(args.rows or max(1, shown.count()), truncate=False)
    return None


if __name__ == "__main__":
    run(SparkSession.builder.appName("vidlake").getOrCreate())
