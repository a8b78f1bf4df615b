from __future__ import annotations

import datetime as dt
import json
import os
import shutil
import time

import pytest

from vidlake.checks import queries
from vidlake.operators.cleaning import clean_videos
from vidlake.plans import jobs
from vidlake.sources import writers
from vidlake.streaming.ingest import Taken, ingest, read_silver
from vidlake.streaming.ledger import ROWS, Conflict, Ledger

RECORD = {
    "title": "t",
    "channel_id": "ch",
    "channel_title": "c",
    "published_date": "2024-01-05T00:00:00Z",
    "views": 5,
    "likes": 1,
    "comments": 0,
    "extraction_date": "2024-02-01",
}


def land(path, *ids):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps([{"video_id": i, **RECORD} for i in ids], indent=4))


def land_csv(path, *ids):
    path.parent.mkdir(parents=True, exist_ok=True)
    header = "video_id,trending_date,title,channel_title,category_id,publish_time,views,likes"
    rows = [f'{i},17.14.11,"a, ""b""\nc",c,10,2017-11-13,5,1,2,d' for i in ids]
    path.write_text("\n".join([header + ",comment_count,description", *rows]) + "\n")


def ids_in(spark, path):
    return sorted(r.video_id for r in read_silver(spark, path).collect())


def test_each_run_takes_only_new_files(spark, tmp_path):
    bronze, silver = (str(tmp_path / n) for n in ("bronze", "silver"))

    def run():
        return ingest(spark, silver, bronze_path=bronze).rows_read

    land(tmp_path / "bronze/year=2024/month=02/day=01/a.json", "v1", "v2")
    land(tmp_path / "bronze/chart/date=2024-02-01/a b.json", "v3")
    assert run() == 3
    assert run() == 0
    assert ids_in(spark, silver) == ["v1", "v2", "v3"]
    land(tmp_path / "bronze/chart/date=2024-02-02/a.json", "v4")
    assert run() == 1
    assert run() == 0
    assert ids_in(spark, silver) == ["v1", "v2", "v3", "v4"]
    row = read_silver(spark, silver).filter("video_id = 'v4'").first()
    assert (row.year, row.month, row.day, row.views, row.description) == (2024, 1, 5, 5, "")


def test_late_files_are_taken(spark, tmp_path):
    bronze, silver = (str(tmp_path / n) for n in ("bronze", "silver"))
    land(tmp_path / "bronze/a.json", "v1")
    ingest(spark, silver, bronze_path=bronze)
    land(tmp_path / "bronze/b.json", "v2")
    old = time.time() - 60 * 86_400
    os.utime(tmp_path / "bronze/b.json", (old, old))
    assert ingest(spark, silver, bronze_path=bronze).files == 1
    assert ids_in(spark, silver) == ["v1", "v2"]


def test_replaced_files_replace_their_rows(spark, tmp_path):
    bronze, silver = (str(tmp_path / n) for n in ("bronze", "silver"))
    land(tmp_path / "bronze/a.json", "v1", "v2")
    land(tmp_path / "bronze/b.json", "v3")
    ingest(spark, silver, bronze_path=bronze)
    land(tmp_path / "bronze/a.json", "v1", "w2", "w3")
    assert ingest(spark, silver, bronze_path=bronze).rows_read == 3
    assert ids_in(spark, silver) == ["v1", "v3", "w2", "w3"]
    (tmp_path / "bronze/a.json").unlink()
    ingest(spark, silver, bronze_path=bronze)
    assert ids_in(spark, silver) == ["v1", "v3", "w2", "w3"]


def test_both_sources_feed_one_table(spark, tmp_path):
    bronze, csv, silver = (str(tmp_path / n) for n in ("bronze", "csv", "silver"))
    land(tmp_path / "bronze/a.json", "v1")
    land_csv(tmp_path / "csv/a.csv", "old")
    ingest(spark, silver, bronze_path=bronze, csv_path=csv)
    land_csv(tmp_path / "csv/b.csv", "older")
    ingest(spark, silver, bronze_path=bronze, csv_path=csv)
    assert ids_in(spark, silver) == ["old", "older", "v1"]
    assert read_silver(spark, silver).filter("video_id = 'old'").first().title == 'a, "b"\nc'


def test_arrays_and_lines_are_both_taken(spark, tmp_path):
    land(tmp_path / "bronze/a.json", "v1", "v2")
    lines = "".join(json.dumps({"video_id": f"w{n}", **RECORD}) + "\n" for n in range(3))
    (tmp_path / "bronze/snap.json").write_text(lines)
    taken = ingest(spark, str(tmp_path / "s"), bronze_path=str(tmp_path / "bronze"))
    assert taken == Taken(2, 5, 0)
    assert ids_in(spark, str(tmp_path / "s")) == ["v1", "v2", "w0", "w1", "w2"]


def test_broken_file_stays_out(spark, tmp_path):
    bronze, silver = (str(tmp_path / n) for n in ("bronze", "silver"))
    land(tmp_path / "bronze/a.json", "v1")
    (tmp_path / "bronze/b.json").write_text('[{"video_id": "x", "tit')
    taken = ingest(spark, silver, bronze_path=bronze, quarantine_path=str(tmp_path / "q"))
    assert ids_in(spark, silver) == ["v1"]
    assert (taken.rows_read, taken.rows_broken) == (2, 1)
    assert spark.read.parquet(str(tmp_path / "q")).first().text.startswith("[{")


def test_a_run_that_died_is_repeated_whole(spark, tmp_path):
    """Take away the ledger rows of the last batch, as if the run had died after
    writing its files: the repeat must not show them twice."""
    bronze, silver = (str(tmp_path / n) for n in ("bronze", "silver"))
    land(tmp_path / "bronze/a.json", "v1")
    ingest(spark, silver, bronze_path=bronze)
    land(tmp_path / "bronze/b.json", "v2", "v3")
    ingest(spark, silver, bronze_path=bronze)
    max((tmp_path / "silver/_ledger/commits").glob("0*")).unlink()
    assert ids_in(spark, silver) == ["v1"]
    assert ingest(spark, silver, bronze_path=bronze).rows_read == 2
    assert ids_in(spark, silver) == ["v1", "v2", "v3"]


def test_backlog_in_steps_counts_everything(spark, tmp_path):
    bronze, silver = (str(tmp_path / n) for n in ("bronze", "silver"))
    for n in range(5):
        land(tmp_path / f"bronze/{n}.json", f"v{n}")
    (tmp_path / "bronze/x.json").write_text("[{")
    taken = ingest(spark, silver, bronze_path=bronze, files_per_batch=2)
    assert taken == Taken(6, 6, 1)
    assert ids_in(spark, silver) == [f"v{n}" for n in range(5)]


def test_a_table_has_one_feeder(spark, tmp_path):
    bronze = str(tmp_path / "bronze")
    land(tmp_path / "bronze/a.json", "v1")
    ingest(spark, str(tmp_path / "stream"), bronze_path=bronze)
    with pytest.raises(ValueError, match="incremental"):
        jobs.bronze_to_silver(spark, str(tmp_path / "stream"), bronze)
    jobs.bronze_to_silver(spark, str(tmp_path / "batch"), bronze)
    with pytest.raises(ValueError, match="batch job"):
        ingest(spark, str(tmp_path / "batch"), bronze_path=bronze)
    assert ids_in(spark, str(tmp_path / "batch")) == ["v1"]


def test_large_history_goes_through_small_files(spark, tmp_path):
    land_csv(tmp_path / "csv/a.csv", *(f"v{n}" for n in range(50)))
    parts = str(tmp_path / "parts")
    assert jobs.split_history(spark, str(tmp_path / "csv"), parts).get["records"] == 50
    ingest(spark, str(tmp_path / "silver"), csv_path=parts)
    jobs.bronze_to_silver(spark, str(tmp_path / "batch"), csv_path=str(tmp_path / "csv"), split_csv=True)
    for table in ("silver", "batch"):
        rows = read_silver(spark, str(tmp_path / table))
        assert rows.count() == 50 and {r.title for r in rows.collect()} == {'a, "b"\nc'}


def test_no_source(spark, tmp_path):
    with pytest.raises(ValueError):
        ingest(spark, str(tmp_path / "s"))


def videos_of_day(videos, views, *ids):
    return videos(*({"video_id": i, "views": str(views)} for i in ids))


def states(spark, path):
    return sorted((r.video_id, r.views) for r in read_silver(spark, path).collect())


@pytest.mark.parametrize("by_date", [False, True])
def test_a_day_landed_again_replaces_its_rows(spark, tmp_path, videos, by_date):
    """Through the sink itself, which names its files anew."""
    bronze, silver = (str(tmp_path / n) for n in ("bronze", "silver"))
    day = dt.date(2024, 2, 1)

    def take(rows):
        if by_date:
            writers.land_by_date(rows, bronze, "chart", day)
        else:
            writers.land_by_day(rows, bronze, day)
        return ingest(spark, silver, bronze_path=bronze)

    land(tmp_path / "bronze/other.json", "w")
    take(videos_of_day(videos, 500, "v0", "v1"))
    assert states(spark, silver) == [("v0", 500), ("v1", 500), ("w", 5)]
    assert take(videos_of_day(videos, 300, "v0")).files_withdrawn >= 1
    assert states(spark, silver) == [("v0", 300), ("w", 5)]
    assert clean_videos(read_silver(spark, silver)).filter("video_id = 'v0'").first().views == 300
    take(videos_of_day(videos, 1, "v0").limit(0))
    assert states(spark, silver) == [("w", 5)]
    assert ingest(spark, silver, bronze_path=bronze) == Taken(0, 0, 0)
    take(videos_of_day(videos, 9, "v1"))
    take(videos_of_day(videos, 1, "v0").limit(0))
    assert states(spark, silver) == [("w", 5)]


def test_a_day_put_away_keeps_its_rows(spark, tmp_path, videos):
    bronze, silver = (str(tmp_path / n) for n in ("bronze", "silver"))
    writers.land_by_day(videos_of_day(videos, 5, "v0"), bronze)
    ingest(spark, silver, bronze_path=bronze)
    shutil.rmtree(tmp_path / "bronze/year=2024")
    land(tmp_path / "bronze/year=2024/month=02/day=02/a.json", "v1")
    ingest(spark, silver, bronze_path=bronze)
    assert ids_in(spark, silver) == ["v0", "v1"]


def test_two_runs_over_the_same_file(spark, tmp_path, monkeypatch):
    """The second run commits while the first one is between its rows and its commit."""
    bronze, silver = (str(tmp_path / n) for n in ("bronze", "silver"))
    land(tmp_path / "bronze/a.json", "v1")
    ingest(spark, silver, bronze_path=bronze)
    land(tmp_path / "bronze/a.json", "v2", "v3")
    land(tmp_path / "bronze/b.json", "v4")
    commit, meeting = Ledger.commit, []

    def commit_late(self, rows, version, over=0):
        if not meeting:
            meeting.append(None)
            meeting[0] = ingest(spark, silver, bronze_path=bronze)
            land(tmp_path / "bronze/c.json", "v5")
            meeting.append(ingest(spark, silver, bronze_path=bronze))
        commit(self, rows, version, over)

    monkeypatch.setattr(Ledger, "commit", commit_late)
    ingest(spark, silver, bronze_path=bronze)
    assert [t.files for t in meeting] == [2, 1]
    assert ids_in(spark, silver) == ["v2", "v3", "v4", "v5"]
    assert Ledger(spark, silver).version() == 5
    monkeypatch.undo()
    assert ingest(spark, silver, bronze_path=bronze) == Taken(0, 0, 0)


def test_a_late_withdrawal_spares_what_was_landed_since(spark, tmp_path, videos, monkeypatch):
    bronze, silver = (str(tmp_path / n) for n in ("bronze", "silver"))
    writers.land_by_day(videos_of_day(videos, 1, "v0"), bronze)
    ingest(spark, silver, bronze_path=bronze)
    writers.land_by_day(videos_of_day(videos, 2, "v0"), bronze)
    commit, done = Ledger.commit, []

    def commit_late(self, rows, version, over=0):
        if not done:
            done.append(True)
            writers.land_by_day(videos_of_day(videos, 3, "v0", "v1"), bronze)
            ingest(spark, silver, bronze_path=bronze)
        commit(self, rows, version, over)

    monkeypatch.setattr(Ledger, "commit", commit_late)
    ingest(spark, silver, bronze_path=bronze)
    ingest(spark, silver, bronze_path=bronze)
    monkeypatch.undo()
    # The first run's files are gone by now; landing the day once more withdraws them.
    writers.land_by_day(videos_of_day(videos, 4, "v1"), bronze)
    ingest(spark, silver, bronze_path=bronze)
    assert states(spark, silver) == [("v1", 4)]


def test_versions_are_made_once(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "t"))
    ledger.create()
    ledger.create()
    assert ledger.version() == 1
    none = spark.createDataFrame([], ROWS)
    ledger.commit(none, 2)
    for version in (1, 2, 4):
        with pytest.raises(Conflict):
            ledger.commit(none, version)
    assert ledger.version() == 2 and ledger.state().count() == 0


def test_days_landed_again_in_files_of_any_number(spark, tmp_path, monkeypatch):
    """No task writes all days, or a large day, alone; the second landing comes to fewer files."""
    orders = spark.range(14_000).selectExpr(
        "id as o_orderkey", "id % 50 as o_custkey", "'1-URGENT' as o_orderpriority",
        "date '1995-01-01' + cast(id % 30 as int) as o_orderdate", "cast(id as double) as o_totalprice",
    )
    orders.repartition(8).write.parquet(str(tmp_path / "sf/orders.parquet"))
    day, found = tmp_path / "run/bronze/date=2024-01-02", []

    def watched(*args, **kwargs):
        found.append(len(list(day.glob("*.json"))))
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64m")
        return ingest(*args, **kwargs)

    monkeypatch.setattr(queries, "scratch_dir", lambda spark: str(tmp_path / "run"))
    monkeypatch.setattr(queries, "ingest", watched)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16k")
    try:
        rows = queries.QUERIES["incremental_replaced_file"](spark, str(tmp_path / "sf")).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert found[0] > found[1] >= 1
    assert sorted((int(r.video_id), r.views) for r in rows) == [(n, n + (n % 7 == 1)) for n in range(14_000)]
