from __future__ import annotations

import random

import pytest

from vidlake.operators.cleaning import clean_videos
from vidlake.operators.quality import QualityError
from vidlake.operators.rollups import channel_rollup, daily_rollup
from vidlake.plans import jobs, upkeep
from vidlake.plans.upkeep import Kept, maintain_gold
from vidlake.sources import writers
from vidlake.streaming.compaction import compact, sweep
from vidlake.streaming.ingest import ingest, read_silver


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr)


def assert_kept_up(spark, silver, gold, published_as="date"):
    wanted = clean_videos(read_silver(spark, silver), published_as)
    assert rows_of(jobs.gold_table(spark, gold, "videos")) == rows_of(wanted)
    assert rows_of(jobs.gold_table(spark, gold, "channel_analysis")) == rows_of(channel_rollup(wanted))
    assert rows_of(jobs.gold_table(spark, gold, "daily_analysis")) == rows_of(daily_rollup(wanted))


@pytest.mark.parametrize("published_as", ["date", "text"])
def test_random_batches_equal_full_runs(spark, tmp_path, videos, published_as):
    bronze, silver, gold = (str(tmp_path / n) for n in ("bronze", "silver", "gold"))
    dice = random.Random(published_as)
    for turn in range(4):
        changes = [
            {"video_id": f" v{dice.randrange(12)} ", "extraction_date": f"2024-02-0{dice.randrange(1, 5)}", "views": str(dice.randrange(-5, 99)),
             "channel_title": dice.choice("abc"), "published_date": dice.choice(["2024-01-05", "2024-01-06T01:00:00Z", "junk"]),
             "likes": dice.choice(["1", "x", "500"])}
            for _ in range(25)
        ]
        # Days of earlier turns are landed again.
        writers.land_by_day(videos(*changes), bronze)
        ingest(spark, silver, bronze_path=bronze)
        done = maintain_gold(spark, silver, gold, published_as, catalog_prefix=f"kept_{published_as}_")
        assert done.whole == (turn == 0) and done.keys > 0
        assert_kept_up(spark, silver, gold, published_as)
        assert rows_of(spark.table(f"kept_{published_as}_videos")) == rows_of(jobs.gold_table(spark, gold, "videos"))
    assert maintain_gold(spark, silver, gold, published_as) == Kept(False, 0)
    # A compaction changes no row.
    compact(spark, silver, everything=True)
    assert maintain_gold(spark, silver, gold, published_as) == Kept(False, 0)
    assert_kept_up(spark, silver, gold, published_as)


def test_withdrawn_rows_leave_gold_and_layers_end(spark, tmp_path, videos, monkeypatch):
    bronze, silver, gold = (str(tmp_path / n) for n in ("bronze", "silver", "gold"))
    monkeypatch.setattr(upkeep, "MAX_LAYERS", 2)

    def run(*changes):
        writers.land_by_day(videos(*changes), bronze)
        ingest(spark, silver, bronze_path=bronze)
        done = maintain_gold(spark, silver, gold, keep=1)
        assert_kept_up(spark, silver, gold)
        return done

    day = "2024-02-02"
    assert run({"video_id": "a"}, {"video_id": "b", "extraction_date": day}) == Kept(True, 2)
    assert run({"video_id": "b", "views": "700"}) == Kept(False, 2)
    assert run({"video_id": "c", "extraction_date": day}) == Kept(False, 2)
    # Three layers by now: all but the current versions of their kind are gone after this.
    assert run({"video_id": "d", "extraction_date": day}).whole
    assert len(list((tmp_path / "gold").iterdir())) == 1
    # What a sweep has deleted cannot be told any more.
    writers.land_by_day(videos({"video_id": "e", "extraction_date": day}), bronze)
    ingest(spark, silver, bronze_path=bronze)
    sweep(spark, silver, older_than=-60)
    assert maintain_gold(spark, silver, gold).whole
    assert_kept_up(spark, silver, gold)
    before = rows_of(jobs.gold_table(spark, gold, "videos"))
    for date in ("2024-02-01", day):
        writers.land_by_day(videos({"video_id": "x", "extraction_date": date, "views": "junk"}), bronze)
    ingest(spark, silver, bronze_path=bronze)
    with pytest.raises(QualityError, match="empty"):
        maintain_gold(spark, silver, gold)
    assert rows_of(jobs.gold_table(spark, gold, "videos")) == before


def test_only_touched_days_are_read(spark, tmp_path, videos, plan):
    path = str(tmp_path / "t")
    changes = [{"video_id": f"v{n}", "extraction_date": f"2024-02-{n % 20 + 1:02}"} for n in range(100)]
    writers.replace_table(videos(*changes), path)
    keys = spark.createDataFrame([("v3", "2024-02-04"), ("v4", "2024-02-05")], "video_id string, extraction_date string")
    some = upkeep._of_keys(spark.read.parquet(path), keys, ["2024-02-04", "2024-02-05"], upkeep.F.col("video_id"))
    assert sorted(r.video_id for r in some.collect()) == ["v3", "v4"]
    assert "PushedFilters: [In(extraction_date, [2024-02-04,2024-02-05])" in plan(some)
