from __future__ import annotations

import datetime as dt
import json
import uuid

import pytest
from pyspark.sql import functions as F

from vidlake.__main__ import run
from vidlake.checks import queries
from vidlake.operators.cleaning import clean_videos
from vidlake.operators.mapping import silver_rows
from vidlake.operators.quality import QualityError
from vidlake.plans import jobs, reports
from vidlake.sources import readers, writers
from vidlake.streaming.ingest import ingest, read_silver

RUN = dt.date(2024, 2, 24)


def details_file(path, ids):
    items = [
        {
            "id": i,
            "snippet": {"title": f"t {i}", "channelId": "ch", "channelTitle": "c",
                        "publishedAt": "2024-02-05T00:00:00Z"},
            "statistics": {"viewCount": str(n * 10), "likeCount": "1"},
        }
        for n, i in enumerate(ids)
    ]
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps({"items": items}, indent=2))


def search_file(path, ids):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps({"items": [{"id": {"videoId": i}} for i in ids]}, indent=2))


def test_from_responses_to_reports(spark, tmp_path):
    """Every layer in turn, on files."""
    details_file(tmp_path / "chart/1.json", [f"c{n}" for n in range(60)])
    search_file(tmp_path / "search/1.json", ["s0", "s1", "gone"])
    search_file(tmp_path / "search/2.json", ["s1", "s2"])
    details_file(tmp_path / "details/1.json", ["s0", "s1", "s2", "unasked"])
    bronze = str(tmp_path / "bronze")

    chart = jobs.land_chart(spark, str(tmp_path / "chart"), bronze, "chart", RUN).first()
    assert (chart.outcome, chart.records, chart.broken) == ("succeeded", 60, 0)
    capped = jobs.land_chart(spark, str(tmp_path / "chart"), bronze, "chart", RUN, rows=50).first()
    assert capped.records == 50
    found = jobs.land_search(spark, str(tmp_path / "search"), str(tmp_path / "details"), bronze, RUN)
    assert (found.first().outcome, found.first().records) == ("succeeded", 3)
    # Once more: the day is replaced.
    jobs.land_search(spark, str(tmp_path / "search"), str(tmp_path / "details"), bronze, RUN)

    (tmp_path / "csv").mkdir()
    (tmp_path / "csv/old.csv").write_text(
        "video_id,trending_date,title,channel_title,category_id,publish_time,tags,views,likes,"
        'comment_count,description\nold,17.14.11,"a, b",k,10,2017-11-13T00:00:00Z,x,7,9,1,"d\nd"\n'
    )
    bad = tmp_path / "bronze/chart/date=2024-02-24/part-cut.json"
    bad.write_text('{"video_id": "x", \n')
    silver_path, gold = str(tmp_path / "silver"), str(tmp_path / "gold")
    written = jobs.bronze_to_silver(
        spark, silver_path, bronze, str(tmp_path / "csv"), "vidlake_job_test",
        str(tmp_path / "quarantine"),
    )
    assert (written.records, written.broken) == (54, 1)
    assert spark.read.parquet(str(tmp_path / "quarantine")).count() == 1
    # The next run does not wipe it out.
    again = jobs.bronze_to_silver(spark, str(tmp_path / "s2"), bronze, quarantine_path=str(tmp_path / "quarantine"))
    assert again.broken == 1 and spark.read.parquet(str(tmp_path / "quarantine")).count() == 2
    assert spark.table("vidlake_job_test").count() == 54
    spark.sql("DROP TABLE vidlake_job_test")

    silver = readers.read_table(spark, silver_path)
    jobs.silver_to_clean(silver, str(tmp_path / "clean"))
    assert readers.read_table(spark, str(tmp_path / "clean")).count() == 54
    assert jobs.publish_gold(silver, gold) == 54
    videos = jobs.gold_table(spark, gold, "videos")
    assert videos.filter("video_id = 'old'").select("likes", "description").first() == (7, "d\nd")
    channels = jobs.gold_table(spark, gold, "channel_analysis")
    days = jobs.gold_table(spark, gold, "daily_analysis")
    assert [tuple(r) for r in reports.daily_uploads(days).collect()] == [("2017-11-13", 1), ("2024-2-5", 53)]
    totals = sum(range(10, 60)) * 10 + 30
    assert [tuple(r) for r in reports.top_channels(channels).collect()] == [("c", totals), ("k", 7)]
    assert len(list((tmp_path / "gold").iterdir())) == 1


def test_landing_reports_failure(spark, tmp_path):
    row = jobs.land_chart(spark, str(tmp_path / "nothing"), str(tmp_path / "b"), "chart", RUN).first()
    assert (row.outcome, row.records) == ("failed", None) and "PATH_NOT_FOUND" in row.error
    row = jobs.land_search(spark, "/no", "/no", str(tmp_path / "b"), RUN).first()
    assert row.outcome == "failed" and not (tmp_path / "b").exists()


def test_gate_leaves_gold_alone(spark, videos, tmp_path):
    gold = str(tmp_path / "gold")
    jobs.publish_gold(silver_rows(bronze=videos({})), gold)
    with pytest.raises(QualityError) as caught:
        jobs.publish_gold(silver_rows(bronze=videos({"title": None})), gold)
    assert caught.value.failures == ["empty_table: 1"]
    assert jobs.gold_table(spark, gold, "videos").count() == 1
    assert len(list((tmp_path / "gold").iterdir())) == 1


def test_gate_catches_what_cleaning_lets_through(spark, videos, tmp_path, monkeypatch):
    gold = str(tmp_path / "gold")

    def careless(df, published_as="date"):
        return df

    monkeypatch.setattr(jobs, "clean_videos", careless)
    broken = silver_rows(bronze=videos({"title": None}, {"likes": "900"}, {"views": "-1"}))
    with pytest.raises(QualityError) as caught:
        jobs.publish_gold(broken, gold)
    rules = {f.split(":")[0] for f in caught.value.failures}
    assert {"null_title", "likes_over_views", "negative_views"} <= rules
    with pytest.raises(QualityError, match="duplicate_snapshot"):
        jobs.publish_gold(silver_rows(bronze=videos({}, {})), gold)
    assert not (tmp_path / "gold").exists() or not list((tmp_path / "gold").iterdir())
    with pytest.raises(QualityError, match="missing column year"):
        jobs.publish_gold(silver_rows(bronze=videos({})).drop("year"), gold)


def test_missing_columns_are_all_named(spark, videos, tmp_path):
    silver = silver_rows(bronze=videos({})).drop("title", "description", "day")
    with pytest.raises(QualityError) as caught:
        jobs.publish_gold(silver, str(tmp_path / "gold"))
    assert caught.value.failures == ["missing column title", "missing column description", "missing column day"]


@pytest.mark.parametrize("step", ["clean_videos", "duplicate_keys", "channel_rollup", "daily_rollup", "publish_version"])
def test_failure_at_any_step_leaves_gold_alone(spark, videos, tmp_path, monkeypatch, step):
    gold = str(tmp_path / "gold")
    jobs.publish_gold(silver_rows(bronze=videos({})), gold)

    def broken(*_args, **_options):
        raise RuntimeError("lost")

    monkeypatch.setattr(jobs, step, broken)
    with pytest.raises(RuntimeError):
        jobs.publish_gold(silver_rows(bronze=videos({}, {"video_id": "v2"})), gold)
    for name in ("videos", "channel_analysis", "daily_analysis"):
        assert jobs.gold_table(spark, gold, name).count() == 1
    assert len(list((tmp_path / "gold").iterdir())) == 1


def test_old_versions_are_retired(spark, videos, tmp_path):
    gold = str(tmp_path / "gold")
    for n in range(4):
        jobs.publish_gold(silver_rows(bronze=videos({"views": str(n + 100)})), gold)
    assert len(list((tmp_path / "gold").iterdir())) == 2
    assert jobs.gold_table(spark, gold, "videos").first().views == 103


def test_file_size_does_not_decide(spark, tmp_path):
    """A stray quote is read the same in a file of any size."""
    rows = [f"v{n},17.14.11,say \"hi\" now,c,10,2017-11-13,5,1,2,d" for n in range(3000)]
    header = "video_id,trending_date,title,channel_title,category_id,publish_time,views,likes,comment_count,description"
    for name, some in (("small", rows[:3]), ("large", rows)):
        (tmp_path / name).mkdir()
        (tmp_path / name / "a.csv").write_text("\n".join([header, *some]) + "\n")
        done = jobs.bronze_to_silver(spark, str(tmp_path / f"s_{name}"), csv_path=str(tmp_path / name))
        assert (done.records, done.broken) == (len(some), 0)


def test_gold_is_replaced_as_a_whole(spark, videos, tmp_path):
    gold = str(tmp_path / "gold")
    for ids in (["a", "b", "c"], ["d"]):
        jobs.publish_gold(silver_rows(bronze=videos(*({"video_id": i} for i in ids))), gold)
    assert [r.video_id for r in jobs.gold_table(spark, gold, "videos").collect()] == ["d"]
    assert jobs.gold_table(spark, gold, "daily_analysis").first().total_videos == 1


def test_gold_with_text_dates_has_a_null_day(spark, videos, tmp_path):
    gold = str(tmp_path / "gold")
    silver = silver_rows(bronze=videos({}, {"video_id": "v2", "published_date": "junk"}))
    assert jobs.publish_gold(silver, gold, published_as="text") == 2
    days = jobs.gold_table(spark, gold, "daily_analysis")
    assert {(r.year, r.total_videos) for r in days.collect()} == {(None, 1), (2024, 1)}
    labels = [r.date for r in reports.daily_views(days).collect()]
    assert labels == ["2024-1-5", None]
    kept = jobs.gold_table(spark, gold, "videos")
    assert dict(kept.dtypes)["published_date"] == "string"


def test_reports(spark):
    channels = spark.createDataFrame(
        [(f"c{n:02}", 1, v, 2, 3) for n, v in enumerate([5, 5, 9, None] + [1] * 8)],
        "channel_title string, total_videos bigint, total_views bigint, total_likes bigint,"
        " total_comments bigint",
    )
    assert tuple(reports.kpi_totals(channels).first()) == (12, 12, 27, 24)
    assert tuple(reports.kpi_formatted(channels.withColumn("total_views", F.lit(1000000))).first()) == (
        "12", "12", "12,000,000", "24")
    top = [r.channel_title for r in reports.top_channels(channels).collect()]
    assert top == ["c02", "c00", "c01"] + [f"c{n:02}" for n in range(4, 11)]
    assert [r.channel_title for r in reports.channel_table(channels).collect()][-1] == "c03"
    assert reports.likes_vs_comments(channels).columns == [
        "channel_title", "total_likes", "total_comments", "total_views"]
    assert tuple(reports.kpi_totals(channels.limit(0)).first()) == (0, 0, 0, 0)


def test_one_hot_snapshot(videos):
    """A third of all rows is one snapshot of one video."""
    silver = silver_rows(
        bronze=videos(
            {"views": "1"}, {"video_id": "v2"}, {"video_id": "v3"}, repeat=500
        ).unionByName(videos({"views": "2"})).repartition(16)
    )
    rows = clean_videos(silver).collect()
    assert sorted((r.video_id, r.views) for r in rows) == [("v1", 2), ("v2", 100), ("v3", 100)]


def test_catalog_follows_versions(spark, tmp_path, videos):
    gold = str(tmp_path / "gold")
    one = silver_rows(bronze=videos({"video_id": "a"}, {"video_id": "b"}))
    jobs.publish_gold(one, gold, catalog_prefix="cat_", keep=1)
    ids = lambda: sorted(r.video_id for r in spark.sql("SELECT video_id FROM cat_videos").collect())
    assert ids() == ["a", "b"]
    two = silver_rows(bronze=videos({"video_id": "c"}))
    jobs.publish_gold(two, gold, catalog_prefix="cat_", keep=1)
    assert ids() == ["c"] and spark.table("cat_channel_analysis").first().total_videos == 1
    assert spark.sql("SELECT sum(total_views) FROM cat_daily_analysis").first()[0] == 100
    with pytest.raises(QualityError):
        jobs.publish_gold(one.filter("views < 0 and views > 0"), gold, catalog_prefix="cat_")
    assert ids() == ["c"]


def test_catalog_of_a_fed_table_follows_its_ledger(spark, tmp_path, videos):
    bronze, silver = (str(tmp_path / n) for n in ("bronze", "silver"))
    writers.land_by_day(videos({"video_id": "a"}, {"video_id": "b"}), bronze)
    ingest(spark, silver, bronze_path=bronze)
    jobs.register_silver(spark, silver, "fed_silver")
    assert spark.sql("SELECT count(*) FROM fed_silver").first()[0] == 2
    assert spark.table("fed_silver").columns == read_silver(spark, silver).columns
    writers.land_by_day(videos({"video_id": "c"}), bronze)
    ingest(spark, silver, bronze_path=bronze)
    assert [r.video_id for r in spark.sql("SELECT video_id FROM fed_silver").collect()] == ["c"]


def test_runs_are_kept_once(spark, tmp_path, videos, capsys):
    bronze, silver, log = (str(tmp_path / n) for n in ("bronze", "silver", "log"))
    writers.land_by_day(videos({"video_id": "a"}, {"video_id": "b"}), bronze)
    for run_id in ("one", "two", "two"):
        run(spark, ["ingest", "--bronze", bronze, "--silver", silver, "--run-log", log, "--run-id", run_id])
    with pytest.raises(Exception):
        run(spark, ["gold", "--silver", str(tmp_path / "none"), "--gold", "g", "--run-log", log, "--run-id", "three"])
    (tmp_path / "taken").write_text("a file where the folder should go")
    (tmp_path / "1.json").write_text('{"items": [{"id": "v"}]}')
    with pytest.raises(SystemExit):
        run(spark, ["land-chart", "--details", str(tmp_path / "1.json"), "--bronze", str(tmp_path / "taken"), "--feed", "c",
                    "--date", "2024-02-06", "--run-log", log])
    rows = {r.run_id: r for r in writers.read_runs(spark, log).collect()}
    assert len(rows) == 4
    kept = {i: (r.command, r.outcome, r.records, r.broken, r.output_path) for i, r in rows.items()}
    assert kept["one"] == ("ingest", "succeeded", 2, 0, silver) and kept["two"] == ("ingest", "succeeded", 0, 0, silver)
    assert kept["three"] == ("gold", "failed", None, None, "g") and "none" in rows["three"].error
    last = next(r for i, r in rows.items() if i not in ("one", "two", "three"))
    assert last.outcome == "failed" and last.error and last.error != "1" and last.ended >= last.started


def test_silver_is_published_from_compressed_landings(spark, tmp_path, monkeypatch):
    """CSV from the tasks of the scan, in files of so many rows; all rows of both sources."""
    lines = spark.range(4_000).selectExpr(
        "id as l_orderkey", "id % 40 + 1 as l_partkey", "id % 9 as l_suppkey", "cast(id % 4 as int) as l_linenumber",
        "cast(id % 50 as double) as l_quantity", "cast(20000 + id as double) as l_extendedprice",
        "'A' as l_returnflag", "'F' as l_linestatus", "date '1995-01-01' + cast(id % 9 as int) as l_shipdate",
    )
    lines.repartition(2).write.parquet(str(tmp_path / "sf/lineitem.parquet"))
    orders = spark.range(700).selectExpr(
        "id + 4000 as o_orderkey", "id % 50 as o_custkey", "'1-URGENT' as o_orderpriority",
        "date '1995-01-01' + cast(id % 9 as int) as o_orderdate", "cast(id as double) as o_totalprice",
    )
    orders.write.parquet(str(tmp_path / "sf/orders.parquet"))
    made = []

    def scratch(spark):
        made.append(tmp_path / f"made-{uuid.uuid4().hex}")
        return str(made[-1])

    monkeypatch.setattr(queries, "scratch_dir", scratch)
    monkeypatch.setattr(queries, "CSV_ROWS_PER_FILE", 500)
    rows = queries.QUERIES["silver_publish"](spark, str(tmp_path / "sf")).select("video_id", "views").collect()
    wanted = [(n, n) for n in range(4_000)] + [(n + 4_000, n) for n in range(700)]
    assert sorted((int(r.video_id), r.views) for r in rows) == wanted
    landed = [path for root in made for path in root.rglob("part-*") if "silver" not in path.parts]
    assert all(path.name.endswith(".gz") for path in landed)
    assert len([path for path in landed if path.parent.name == "csv"]) == 8
