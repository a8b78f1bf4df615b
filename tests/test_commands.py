from __future__ import annotations

import json
from types import SimpleNamespace

import pytest

from vidlake.__main__ import run
from vidlake.session import BYTES_PER_PARTITION, MAX_PARTITIONS, scratch_dir, size_shuffles, stored_bytes


def test_commands_end_to_end(spark, tmp_path, capsys):
    paths = {n: str(tmp_path / n) for n in ("details", "search", "bronze", "silver", "gold", "clean")}
    items = [
        {"id": f"v{n}", "snippet": {"title": "t", "channelTitle": "c", "publishedAt": "2024-02-05"},
         "statistics": {"viewCount": "1000"}}
        for n in range(3)
    ]
    for name, found in (("details", items), ("search", [{"id": {"videoId": "v1"}}])):
        (tmp_path / name).mkdir()
        (tmp_path / name / "1.json").write_text(json.dumps({"items": found}))
    run(spark, ["land-chart", "--details", paths["details"], "--bronze", paths["bronze"],
                "--feed", "chart", "--date", "2024-02-06"])
    run(spark, ["land-search", "--search", paths["search"], "--details", paths["details"],
                "--bronze", paths["bronze"], "--date", "2024-02-07"])
    assert "succeeded" in capsys.readouterr().out
    run(spark, ["to-silver", "--silver", paths["silver"], "--bronze", paths["bronze"]])
    assert "4 records" in capsys.readouterr().out
    run(spark, ["ingest", "--silver", str(tmp_path / "stream"), "--bronze", paths["bronze"]])
    assert "4 rows read" in capsys.readouterr().out
    run(spark, ["clean", "--silver", paths["silver"], "--clean", paths["clean"]])
    run(spark, ["gold", "--silver", paths["silver"], "--gold", paths["gold"]])
    run(spark, ["gold", "--silver", paths["silver"], "--gold", paths["gold"], "--text-dates"])
    assert capsys.readouterr().out.count("4 records") == 3
    run(spark, ["quality", "--table", paths["silver"]])
    assert "likes_over_views" in capsys.readouterr().out
    run(spark, ["report", "kpi_formatted", "--gold", paths["gold"]])
    assert "4,000" in capsys.readouterr().out
    run(spark, ["report", "daily_uploads", "--gold", paths["gold"]])
    assert "2024-2-5" in capsys.readouterr().out
    run(spark, ["report", "channel_table", "--gold", paths["gold"], "--out", str(tmp_path / "out")])
    assert spark.read.option("header", True).csv(str(tmp_path / "out")).count() == 1
    run(spark, ["gold", "--silver", str(tmp_path / "stream"), "--gold", paths["gold"]])
    spark.range(3).write.parquet(str(tmp_path / "other"))
    with pytest.raises(ValueError, match="missing column"):
        run(spark, ["quality", "--table", str(tmp_path / "other"), "--enforce"])


def test_split_history_command(spark, tmp_path, capsys):
    (tmp_path / "a.csv").write_text('video_id,title\nv1,"a\nb"\n')
    run(spark, ["split-history", "--csv", str(tmp_path / "a.csv"), "--out", str(tmp_path / "out")])
    assert "1 records" in capsys.readouterr().out


def test_a_failed_landing_fails_the_command(spark, tmp_path, capsys):
    (tmp_path / "1.json").write_text('{"items": [{"id": "v"}]}')
    (tmp_path / "taken").write_text("a file where the folder should go")
    with pytest.raises(SystemExit):
        run(spark, ["land-chart", "--details", str(tmp_path / "1.json"), "--bronze",
                    str(tmp_path / "taken"), "--feed", "chart", "--date", "2024-02-06"])
    assert "failed" in capsys.readouterr().out


def test_unknown_command(spark):
    with pytest.raises(SystemExit):
        run(spark, ["nothing"])


def test_shuffles_grow_with_the_input_only(spark, tmp_path):
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    try:
        assert size_shuffles(spark, 10) == int(before)
        assert size_shuffles(spark, 1000 * BYTES_PER_PARTITION) == 1000
        assert size_shuffles(spark, 10) == 1000
        with pytest.warns(UserWarning, match="accurateBlockSkewedFactor"):
            assert size_shuffles(spark, 100 * 2**40) == MAX_PARTITIONS
    finally:
        spark.conf.set(key, before)
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x").write_bytes(b"12345")
    assert stored_bytes(spark, str(tmp_path / "a"), str(tmp_path / "a" / "x")) == 10


def session_like(master, settings):
    return SimpleNamespace(
        conf=SimpleNamespace(get=settings.get), sparkContext=SimpleNamespace(master=master)
    )


def test_scratch_needs_a_shared_folder_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_dir(session_like("yarn", {}))
    named = session_like("yarn", {"spark.checkpoint.dir": "hdfs://n/shared/"})
    assert scratch_dir(named).startswith("hdfs://n/shared/vidlake-")
    assert scratch_dir(session_like("local[2]", {})) != scratch_dir(session_like("local[2]", {}))


def test_scratch_is_fresh_and_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    one, two = scratch_dir(spark), scratch_dir(spark)
    assert one != two
    if shared:
        assert one.startswith(shared.rstrip("/"))
