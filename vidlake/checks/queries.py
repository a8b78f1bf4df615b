"""One query per operator, over the driver's tables as a whole."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F

from vidlake.checks.samples import (
    RUN_DATE,
    bronze,
    corpus,
    details_text,
    historical,
    search_text,
    silver,
)
from vidlake.functions.dates import path_parts, publish_date
from vidlake.operators import cleaning, lookup, mapping, quality, responses, rollups, search
from vidlake.plans import jobs, reports
from vidlake.plans.upkeep import maintain_gold
from vidlake.schemas import CSV_NAMES, DETAILS_RESPONSE, KEYWORDS, SEARCH_RESPONSE
from vidlake.session import scratch_dir
from vidlake.sources import readers, writers
from vidlake.streaming.compaction import compact, sweep
from vidlake.streaming.ingest import Taken, ingest, read_silver

# A keyword that only matches with the case of all letters ignored.
MORE_KEYWORDS = ("éTRE",)
CSV_ROWS_PER_FILE = 250_000

Query = Callable[[SparkSession, str], DataFrame]


def _apply_mapping(spark: SparkSession, sf: str) -> DataFrame:
    return mapping.apply_mapping(historical(spark, sf), CSV_NAMES)


def _unified(spark: SparkSession, sf: str) -> DataFrame:
    return mapping.unified(historical(spark, sf), bronze(spark, sf))


def _typed(spark: SparkSession, sf: str) -> DataFrame:
    return mapping.type_metrics(mapping.unified(historical(spark, sf)))


def _publish_parts(spark: SparkSession, sf: str) -> DataFrame:
    return mapping.add_publish_parts(mapping.unified(historical(spark, sf)))


def _trimmed(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.trim_text(mapping.unified(historical(spark, sf)))


def _complete(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.drop_incomplete(silver(spark, sf))


def _clamp_negative(spark: SparkSession, sf: str) -> DataFrame:
    return silver(spark, sf).transform(cleaning.clamp_negative)


def _clamp_to_views(spark: SparkSession, sf: str) -> DataFrame:
    return silver(spark, sf).transform(cleaning.clamp_to_views)


def _dated(spark: SparkSession, sf: str) -> DataFrame:
    rows = silver(spark, sf)
    return rows.withColumn("published_date", publish_date(rows))


def _dedupe(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.keep_latest(_dated(spark, sf))


def _dedupe_text(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.keep_latest(silver(spark, sf))


def clean(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.clean_videos(silver(spark, sf))


def _clean_text(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.clean_videos(silver(spark, sf), published_as="text")


def channels(spark: SparkSession, sf: str) -> DataFrame:
    return rollups.channel_rollup(cleaning.clean_videos(silver(spark, sf), for_rollups=True))


def days(spark: SparkSession, sf: str, published_as: str = "date") -> DataFrame:
    rows = cleaning.clean_videos(silver(spark, sf), published_as, for_rollups=True)
    return rollups.daily_rollup(rows)


def _on_channels(report: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: report(channels(spark, sf))


def _on_days(report: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: report(days(spark, sf))


def _row_count(spark: SparkSession, sf: str) -> DataFrame:
    return silver(spark, sf).agg(F.count(F.lit(1)).alias("n_rows"))


def _null_counts(spark: SparkSession, sf: str) -> DataFrame:
    return quality.null_counts(silver(spark, sf))


def _duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return quality.duplicate_keys(silver(spark, sf))


def _before(spark: SparkSession, sf: str) -> DataFrame:
    return quality.quality_report(cleaning.trim_text(silver(spark, sf)))


def _after(spark: SparkSession, sf: str) -> DataFrame:
    return quality.quality_report(clean(spark, sf))


def _gate(spark: SparkSession, sf: str) -> DataFrame:
    return quality.failed_rules(_before(spark, sf)).select("rule")


def details(spark: SparkSession, sf: str) -> DataFrame:
    parsed = responses.parse_responses(details_text(spark, sf), "response", DETAILS_RESPONSE)
    return responses.flatten_details(parsed, RUN_DATE)


def found_ids(spark: SparkSession, sf: str) -> DataFrame:
    parsed = responses.parse_responses(search_text(spark, sf), "response", SEARCH_RESPONSE)
    return responses.search_ids(parsed)


def _distinct_found(spark: SparkSession, sf: str) -> DataFrame:
    return lookup.distinct_ids(found_ids(spark, sf))


def _id_counts(spark: SparkSession, sf: str) -> DataFrame:
    return lookup.count_ids(found_ids(spark, sf))


def _all_ids(spark: SparkSession, sf: str) -> DataFrame:
    return lookup.distinct_ids(historical(spark, sf), bronze(spark, sf), found_ids(spark, sf))


def _lookup(spark: SparkSession, sf: str) -> DataFrame:
    return lookup.lookup_details(details(spark, sf), found_ids(spark, sf))


def _id_batches(spark: SparkSession, sf: str) -> DataFrame:
    return lookup.batch_lists(lookup.id_batches(historical(spark, sf)))


def _recent(spark: SparkSession, sf: str) -> DataFrame:
    return search.recent_videos(silver(spark, sf), RUN_DATE)


def _keywords(spark: SparkSession, sf: str) -> DataFrame:
    return search.keyword_matches(corpus(spark, sf), (*KEYWORDS, *MORE_KEYWORDS))


def _top_pages(spark: SparkSession, sf: str) -> DataFrame:
    return search.top_pages(_keywords(spark, sf))


def _cap(spark: SparkSession, sf: str) -> DataFrame:
    return search.snapshot_cap(clean(spark, sf))


def _day_paths(spark: SparkSession, sf: str) -> DataFrame:
    rows = bronze(spark, sf)
    parts = path_parts(F.col("extraction_date").cast("date"))
    return rows.withColumns(parts)


def _json_text(spark: SparkSession, sf: str) -> DataFrame:
    rows = bronze(spark, sf)
    text = rows.select(F.to_json(F.struct(*rows.columns)).alias("record"))
    return responses.parse_responses(text, "record", rows.schema)


def _csv_scan(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark)
    writers.write_csv(historical(spark, sf), path)
    return readers.readable(readers.read_csv(spark, path))


def _csv_malformed(spark: SparkSession, sf: str) -> DataFrame:
    """Some records end after two columns: all rows that are kept, and the text of those
    that are not."""
    path = scratch_dir(spark)
    rows = historical(spark, sf)
    whole = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    cut = F.when(F.col("video_id").cast("long") % 5 == 0, F.concat_ws(",", *rows.columns[:2]))
    lines = rows.select(cut.otherwise(F.to_csv(F.struct(*rows.columns), whole)).alias(",".join(rows.columns)))
    # A line is one cell here, written as it is.
    as_is = {**whole, "quote": "\u0000", "header": True, "sep": "\t"}
    lines.write.options(**as_is).csv(path)
    landed = readers.read_csv(spark, path)
    good, bad = readers.readable(landed), readers.quarantined(landed)
    return good.unionByName(bad.select("text"), allowMissingColumns=True)


def _csv_texts(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark)
    writers.write_csv(corpus(spark, sf), path)
    return readers.readable(readers.read_csv(spark, path))


def _csv_split(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark)
    writers.write_csv(corpus(spark, sf), path)
    return readers.read_split_csv(spark, path)


def _early(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("extraction_date") < "2024-01-04")


def _late(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("extraction_date") >= "2024-01-04")


def _land_both(spark: SparkSession, sf: str, **options: object) -> str:
    """Every snapshot, the early days in one directory layout, the rest in the
    other."""
    path = scratch_dir(spark)
    rows = bronze(spark, sf)
    writers.land_by_day(_early(rows), path, **options)
    writers.land_by_date(_late(rows), path, "chart", **options)
    return path


def _json_scan(spark: SparkSession, sf: str) -> DataFrame:
    landed = readers.read_bronze(spark, _land_both(spark, sf))
    return readers.readable(landed)


def _sql_scan(spark: SparkSession, sf: str) -> DataFrame:
    return readers.read_table_sql(spark, f"{sf}/lineitem.parquet")


def _table_scan(spark: SparkSession, sf: str) -> DataFrame:
    """All of orders, from a table partitioned by a column of it."""
    path = scratch_dir(spark)
    orders = readers.read_table(spark, f"{sf}/orders.parquet")
    writers.replace_table(orders, path, "o_orderstatus")
    return readers.read_table(spark, path)


def _land_texts(spark: SparkSession, texts: DataFrame, per_file: int) -> str:
    """Responses as files of both forms, named alike: lines, and one text per file of
    a pretty-printed response; one line in 50 of the former is cut."""
    path = scratch_dir(spark)
    key = F.pmod(F.xxhash64("response"), F.lit(100))
    lines = texts.filter(key >= 1)
    lines = lines.unionAll(lines.filter(key >= 98).select(F.concat(F.lit("{"), F.substring("response", 1, 9))))
    lines.write.option("lineSep", "\n").text(f"{path}/a")
    # Responses of one file are one response with all their items.
    whole = texts.filter(key < 1)
    pieces = whole.select(F.from_json("response", "items array<string>")["items"].alias("items"))
    merged = pieces.withColumn("file", F.pmod(F.xxhash64("items"), F.lit(per_file)))
    merged = merged.groupBy("file").agg(F.flatten(F.collect_list("items")).alias("items"))
    text = F.concat(F.lit('{\n "items": [\n'), F.array_join("items", ",\n"), F.lit("\n ]\n}"))
    merged.select("file", text.alias("text")).write.partitionBy("file").option("lineSep", "\n").text(f"{path}/b")
    return path


def _details_scan(spark: SparkSession, sf: str) -> DataFrame:
    texts = details_text(spark, sf)
    landed = readers.read_details(spark, _land_texts(spark, texts, 3))
    return responses.flatten_details(readers.readable(landed), RUN_DATE)


def _search_scan(spark: SparkSession, sf: str) -> DataFrame:
    landed = readers.read_search(spark, _land_texts(spark, search_text(spark, sf), 3))
    return responses.search_ids(readers.readable(landed))


def _day_overwrite(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark)
    rows = bronze(spark, sf)
    writers.land_by_day(rows, path)
    writers.land_by_day(_early(rows).withColumn("views", F.col("views") + 1), path)
    return readers.readable(readers.read_bronze(spark, path))


def _day_overwrite_empty(spark: SparkSession, sf: str) -> DataFrame:
    """A second run of one day finds nothing; its day is empty after it."""
    path = scratch_dir(spark)
    rows = bronze(spark, sf)
    writers.land_by_day(rows, path)
    day = dt.date(2024, 1, 3)
    nothing = rows.filter(F.col("extraction_date") == str(day)).filter("views < 0 and views > 0")
    writers.land_by_day(nothing, path, day)
    return readers.readable(readers.read_bronze(spark, path, form="lines"))


def _run_report(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark)
    rows = bronze(spark, sf)
    report = writers.run_report(spark, "landed", path, lambda: writers.land_by_day(rows, path))
    return report.select("outcome", "message", "records", "broken", "error")


def _silver_publish(spark: SparkSession, sf: str) -> DataFrame:
    """Both sources land compressed. The tasks of a scan are even, so the CSV is written
    from them as they are; a file, which is a task later, holds so many rows."""
    root = scratch_dir(spark)
    small = {"compression": "gzip", "maxRecordsPerFile": CSV_ROWS_PER_FILE}
    writers.write_csv(historical(spark, sf), f"{root}/csv", spread=False, **small)
    name = "silver_" + root.rsplit("-", 1)[1]
    jobs.bronze_to_silver(
        spark,
        f"{root}/silver",
        bronze_path=_land_both(spark, sf, compression="gzip"),
        csv_path=f"{root}/csv",
        table=name,
    )
    return spark.table(name)


def _clean_publish(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark)
    jobs.silver_to_clean(silver(spark, sf), path)
    return readers.read_table(spark, path)


def _gold(spark: SparkSession, sf: str) -> str:
    path = scratch_dir(spark)
    jobs.publish_gold(silver(spark, sf), path)
    return path


def _gold_videos(spark: SparkSession, sf: str) -> DataFrame:
    return jobs.gold_table(spark, _gold(spark, sf), "videos")


def _gold_rollups(spark: SparkSession, sf: str) -> DataFrame:
    path = _gold(spark, sf)
    per_channel = jobs.gold_table(spark, path, "channel_analysis")
    per_day = jobs.gold_table(spark, path, "daily_analysis")
    return per_channel.unionByName(per_day, allowMissingColumns=True)


def _lacking(spark: SparkSession, sf: str) -> DataFrame:
    return quality.quality_report(silver(spark, sf).drop("title", "description"))


def _empty(spark: SparkSession, sf: str) -> DataFrame:
    return quality.quality_report(silver(spark, sf).filter("views < 0 and views > 0"))


def _ingest_twice(spark: SparkSession, sf: str) -> tuple[DataFrame, list[int]]:
    root = scratch_dir(spark)
    landing, table_path = f"{root}/bronze", f"{root}/silver"

    def run() -> int:
        return ingest(spark, table_path, bronze_path=landing).rows_read

    rows = bronze(spark, sf)
    writers.land_by_day(_early(rows), landing)
    taken = [run(), run()]
    writers.land_by_day(_late(rows), landing)
    taken.append(run())
    return read_silver(spark, table_path), taken


def _incremental(spark: SparkSession, sf: str) -> DataFrame:
    return _ingest_twice(spark, sf)[0]


def _incremental_runs(spark: SparkSession, sf: str) -> DataFrame:
    taken = _ingest_twice(spark, sf)[1]
    return spark.createDataFrame(list(enumerate(taken, 1)), "run int, rows_read bigint")


def _aged(spark: SparkSession, path: str, days: int) -> None:
    """Set the files' time back."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    files = fs.listFiles(where, True)
    while files.hasNext():
        status = files.next()
        fs.setTimes(status.getPath(), status.getModificationTime() - days * 86_400_000, -1)


def _incremental_late(spark: SparkSession, sf: str) -> DataFrame:
    """Files a month older than those taken before are taken as well."""
    root = scratch_dir(spark)
    landing, table_path = f"{root}/bronze", f"{root}/silver"
    rows = bronze(spark, sf)
    writers.land_by_day(_late(rows), f"{landing}/new")
    ingest(spark, table_path, bronze_path=landing, form="lines")
    writers.land_by_day(_early(rows), f"{landing}/old")
    _aged(spark, f"{landing}/old", 30)
    ingest(spark, table_path, bronze_path=landing, form="lines")
    return read_silver(spark, table_path)


def _incremental_replaced(spark: SparkSession, sf: str) -> DataFrame:
    """A day landed again under the same file names replaces its rows."""
    root = scratch_dir(spark)
    landing, table_path = f"{root}/bronze", f"{root}/silver"
    rows = bronze(spark, sf)
    hadoop = spark._jvm.org.apache.hadoop.fs

    def land(day: DataFrame) -> None:
        """A day's files are named by their number. Should the day have come to fewer of
        them, those left over go with it, as ever when a day is landed again."""
        writers.land_by_date(day, f"{root}/next", "chart")
        written = hadoop.Path(f"{root}/next/chart/*/part-*")
        fs = written.getFileSystem(spark._jsc.hadoopConfiguration())
        parts: dict[str, list[str]] = {}
        for found in fs.globStatus(written):
            path = found.getPath()
            parts.setdefault(path.getParent().getName(), []).append(path.toString())
        for name, paths in parts.items():
            target = hadoop.Path(f"{landing}/{name}")
            fs.delete(target, True)
            fs.mkdirs(target)
            for number, path in enumerate(sorted(paths)):
                fs.rename(hadoop.Path(path), hadoop.Path(target, f"{number:05d}.json"))

    for changed in (rows, rows.filter(F.col("extraction_date") == "2024-01-02").withColumn("views", F.col("views") + 1)):
        land(changed)
        ingest(spark, table_path, bronze_path=landing)
    return read_silver(spark, table_path)


def _incremental_counts(spark: SparkSession, sf: str) -> DataFrame:
    """More batches than a stream's progress keeps, broken lines among them."""
    root = scratch_dir(spark)
    landing = f"{root}/bronze"
    text = bronze(spark, sf).select(F.to_json(F.struct("*")).alias("value"), "video_id")
    key = F.col("video_id").cast("long")
    cut = F.when(key % 100 == 0, F.substring("value", 1, 20)).otherwise(F.col("value"))
    lines = text.select(cut.alias("value"), (key % 12).alias("part")).hint("rebalance", "part")
    lines.write.partitionBy("part").text(landing)
    done: Taken = ingest(spark, f"{root}/silver", bronze_path=landing, form="lines", files_per_batch=1)
    kept = read_silver(spark, f"{root}/silver").count()
    return spark.createDataFrame(
        [(done.rows_read, done.rows_broken, kept)], "rows_read bigint, rows_broken bigint, rows_kept bigint"
    )


def _fed(spark: SparkSession, sf: str, *landings: Callable[[DataFrame, str], object]) -> str:
    """A silver table fed after each of some landings; the folder it is in."""
    root = scratch_dir(spark)
    rows = bronze(spark, sf)
    for land in landings:
        land(rows, f"{root}/bronze")
        ingest(spark, f"{root}/silver", bronze_path=f"{root}/bronze", form="lines")
    return root


def _land_second_day_again(rows: DataFrame, path: str) -> None:
    """The second day once more, with other views, and without every second video."""
    day = rows.filter("extraction_date = '2024-01-02' and cast(video_id as long) % 2 = 0")
    writers.land_by_day(day.withColumn("views", F.col("views") + 1), path)


def _land_empty_day(rows: DataFrame, path: str) -> None:
    writers.land_by_day(rows.filter("views < 0 and views > 0"), path, dt.date(2024, 1, 3))


def _land_early(rows: DataFrame, path: str) -> None:
    writers.land_by_day(_early(rows), path)


def _land_late(rows: DataFrame, path: str) -> None:
    writers.land_by_day(_late(rows), path)


def _incremental_relanded(spark: SparkSession, sf: str) -> DataFrame:
    """A day landed again through the sink replaces its rows, those it lacks included."""
    root = _fed(spark, sf, writers.land_by_day, _land_second_day_again)
    return read_silver(spark, f"{root}/silver")


def _incremental_emptied(spark: SparkSession, sf: str) -> DataFrame:
    """A day landed again without records leaves none."""
    root = _fed(spark, sf, writers.land_by_day, _land_empty_day)
    return read_silver(spark, f"{root}/silver")


def _compacted(spark: SparkSession, sf: str) -> DataFrame:
    """The rows of a fed table after a compaction and a sweep of all that was before."""
    root = _fed(spark, sf, _land_early, _land_late, _land_second_day_again)
    compact(spark, f"{root}/silver", everything=True)
    sweep(spark, f"{root}/silver", older_than=-60)
    return read_silver(spark, f"{root}/silver")


def _kept_gold(spark: SparkSession, sf: str) -> str:
    """Gold made after a first landing, and kept up over two more."""
    root = scratch_dir(spark)
    rows = bronze(spark, sf)
    for land in (_land_early, _land_late, _land_second_day_again):
        land(rows, f"{root}/bronze")
        ingest(spark, f"{root}/silver", bronze_path=f"{root}/bronze", form="lines")
        maintain_gold(spark, f"{root}/silver", f"{root}/gold")
    return f"{root}/gold"


def _incremental_gold(spark: SparkSession, sf: str) -> DataFrame:
    return jobs.gold_table(spark, _kept_gold(spark, sf), "videos")


def _incremental_rollups(spark: SparkSession, sf: str) -> DataFrame:
    path = _kept_gold(spark, sf)
    per_channel = jobs.gold_table(spark, path, "channel_analysis")
    per_day = jobs.gold_table(spark, path, "daily_analysis")
    return per_channel.unionByName(per_day, allowMissingColumns=True)


def _gold_catalog(spark: SparkSession, sf: str) -> DataFrame:
    """The catalog's views after a second version took the place of a first one: rows
    by the number of the version and the name of the table."""
    path = scratch_dir(spark)
    prefix = f"gold_{path.rsplit('-', 1)[1]}_"
    rows = silver(spark, sf)
    counts = []
    for version, part in ((1, _early(rows)), (2, rows)):
        jobs.publish_gold(part, path, keep=1, catalog_prefix=prefix)
        for name in jobs.GOLD_TABLES:
            found = spark.sql(f"SELECT count(*) FROM {prefix}{name}").first()[0]
            counts.append((version, name, found))
    return spark.createDataFrame(counts, "version int, name string, n_rows bigint")


def _fed_catalog(spark: SparkSession, sf: str) -> DataFrame:
    """A fed table by name, through a view made before its last landing."""
    root = _fed(spark, sf, _land_early)
    name = "fed_" + root.rsplit("-", 1)[1]
    jobs.register_silver(spark, f"{root}/silver", name)
    _land_late(bronze(spark, sf), f"{root}/bronze")
    ingest(spark, f"{root}/silver", bronze_path=f"{root}/bronze", form="lines")
    return spark.table(name)


def _run_log(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs of a command, one of them repeated under its id, and a failed one."""
    root = scratch_dir(spark)
    writers.land_by_day(bronze(spark, sf), f"{root}/bronze")
    log = ["--run-log", f"{root}/runs", "--run-id"]
    feed = ["ingest", "--silver", f"{root}/silver", "--bronze", f"{root}/bronze", "--form", "lines", *log]
    for run_id in ("first", "second", "second"):
        command([*feed, run_id])(spark)
    try:
        command(["clean", "--silver", f"{root}/none", "--clean", f"{root}/clean", *log, "third"])(spark)
    except Exception as error:
        failed = type(error).__name__
    kept = writers.read_runs(spark, f"{root}/runs").filter(F.lit(bool(failed)))
    path = F.replace("output_path", F.lit(root), F.lit("")).alias("output_path")
    return kept.select(
        "run_id", "command", "outcome", "records", "broken", path, F.col("error").isNotNull().alias("has_error")
    )


def command(argv: list[str]) -> Callable[[SparkSession], None]:
    """A command as it is given to spark-submit."""
    from vidlake.__main__ import run

    return partial(run, argv=argv)


QUERIES: dict[str, Query] = {
    "apply_mapping": _apply_mapping,
    "align_union": _unified,
    "cast_metrics": _typed,
    "publish_date_parts": _publish_parts,
    "silver_rows": silver,
    "trim_text": _trimmed,
    "drop_incomplete": _complete,
    "clamp_negative": _clamp_negative,
    "clamp_to_views": _clamp_to_views,
    "dedupe_latest": _dedupe,
    "dedupe_latest_text_order": _dedupe_text,
    "clean_videos": clean,
    "clean_videos_text_dates": _clean_text,
    "channel_rollup": channels,
    "daily_rollup": days,
    "daily_rollup_text_dates": partial(days, published_as="text"),
    "kpi_totals": _on_channels(reports.kpi_totals),
    "kpi_formatted": _on_channels(reports.kpi_formatted),
    "top_channels": _on_channels(reports.top_channels),
    "likes_vs_comments": _on_channels(reports.likes_vs_comments),
    "channel_table": _on_channels(reports.channel_table),
    "daily_views": _on_days(reports.daily_views),
    "daily_uploads": _on_days(reports.daily_uploads),
    "row_count": _row_count,
    "null_counts": _null_counts,
    "duplicate_keys": _duplicates,
    "quality_report_before": _before,
    "quality_report_after": _after,
    "quality_gate": _gate,
    "quality_missing_columns": _lacking,
    "quality_empty": _empty,
    "flatten_details": details,
    "search_ids": _distinct_found,
    "id_counts": _id_counts,
    "distinct_ids": _all_ids,
    "lookup_details": _lookup,
    "id_batches": _id_batches,
    "recent_videos": _recent,
    "keyword_matches": _keywords,
    "keyword_top_pages": _top_pages,
    "snapshot_cap": _cap,
    "day_paths": _day_paths,
    "json_text": _json_text,
    "csv_scan": _csv_scan,
    "csv_scan_malformed": _csv_malformed,
    "csv_scan_texts": _csv_texts,
    "csv_scan_split": _csv_split,
    "json_scan": _json_scan,
    "details_scan": _details_scan,
    "search_scan": _search_scan,
    "parquet_scan": _table_scan,
    "parquet_sql_scan": _sql_scan,
    "bronze_day_overwrite": _day_overwrite,
    "bronze_day_overwrite_empty": _day_overwrite_empty,
    "run_report": _run_report,
    "silver_publish": _silver_publish,
    "clean_publish": _clean_publish,
    "gold_publish": _gold_videos,
    "gold_publish_rollups": _gold_rollups,
    "incremental_ingest": _incremental,
    "incremental_runs": _incremental_runs,
    "incremental_late_file": _incremental_late,
    "incremental_replaced_file": _incremental_replaced,
    "incremental_counts": _incremental_counts,
    "incremental_relanded_day": _incremental_relanded,
    "incremental_relanded_empty": _incremental_emptied,
    "incremental_compacted": _compacted,
    "incremental_gold": _incremental_gold,
    "incremental_gold_rollups": _incremental_rollups,
    "gold_catalog": _gold_catalog,
    "silver_catalog": _fed_catalog,
    "run_log": _run_log,
}
