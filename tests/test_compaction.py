from __future__ import annotations

import json
import os

import pytest

from vidlake.sources import writers
from vidlake.streaming import compaction
from vidlake.streaming.compaction import Compacted, compact, sweep
from vidlake.streaming.ingest import Taken, ingest, read_silver
from vidlake.streaming.ledger import Conflict, Ledger

RECORD = {"title": "t", "channel_id": "ch", "channel_title": "c", "published_date": "2024-01-05T00:00:00Z",
          "views": 5, "likes": 1, "comments": 0, "extraction_date": "2024-02-01"}


@pytest.fixture
def fed(spark, tmp_path):
    """A table fed in four runs, with a file replaced and one of another day."""
    bronze = tmp_path / "a b/bronze"
    bronze.mkdir(parents=True)

    def land(name, **changes):
        (bronze / name).write_text(json.dumps([{**RECORD, "video_id": i, **own} for i, own in changes.items()]))
        return ingest(spark, str(tmp_path / "a b/silver"), bronze_path=str(bronze))

    land("a.json", v1={}, v2={})
    land("b.json", v3={}, v4={"published_date": "2024-01-06"})
    land("a.json", v1={"views": 7})
    land("c.json", v5={})
    return str(tmp_path / "a b/silver"), land


def rows(spark, path, version=None):
    return sorted((r.video_id, r.views, r.day) for r in read_silver(spark, path, version).collect())


def data_files(path):
    return {os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet") and "_ledger" not in d}


WANTED = [("v1", 7, 5), ("v3", 5, 5), ("v4", 5, 6), ("v5", 5, 5)]


def test_compacted_rows_are_the_same_in_fewer_files(spark, fed):
    path, land = fed
    assert rows(spark, path) == WANTED
    before = data_files(path)
    done = compact(spark, path, everything=True)
    assert (done.files, done.records) == (3, 4) and rows(spark, path) == WANTED
    # A reader of the state before still finds all of it.
    assert rows(spark, path, done.version - 1) == WANTED
    assert sweep(spark, path).data_files == 0 and before <= data_files(path)
    swept = sweep(spark, path, older_than=-60)
    assert swept.data_files == len(before) and swept.ledger_entries == 5
    assert data_files(path).isdisjoint(before) and len(data_files(path)) == 2
    assert rows(spark, path) == WANTED and Ledger(spark, path).version() == done.version
    assert sweep(spark, path, older_than=-60) == compaction.Swept(0, 0)
    # What was taken stays taken, and what changes is taken.
    assert land("d.json", v6={}).files == 1 and land("a.json", v9={}).files == 1
    assert [r[0] for r in rows(spark, path)] == ["v3", "v4", "v5", "v6", "v9"]
    assert compact(spark, path) == Compacted(2, 2, done.version + 3)
    assert compact(spark, path) == Compacted(0, 0, done.version + 3)


@pytest.mark.parametrize("step", ["write", "entry", "commit"])
def test_a_compaction_that_dies(spark, fed, monkeypatch, step):
    path, _ = fed
    before = data_files(path)

    def die(*_args, **_options):
        raise RuntimeError("died")

    with monkeypatch.context() as patched:
        if step == "write":
            patched.setattr(compaction, "commit_over", die)
        elif step == "entry":
            patched.setattr("vidlake.streaming.ledger.create_file", die)
        else:
            # Dies just after its commit.
            commit = Ledger.commit
            patched.setattr(Ledger, "commit", lambda *a: (commit(*a), die()))
        with pytest.raises(RuntimeError):
            compact(spark, path, everything=True)
    assert rows(spark, path) == WANTED
    sweep(spark, path, older_than=-60)
    assert rows(spark, path) == WANTED
    left = data_files(path)
    if step == "commit":
        assert left.isdisjoint(before)
    else:
        # The first state of a.json is gone as well.
        assert left < before
    compact(spark, path, everything=True)
    sweep(spark, path, older_than=-60)
    assert rows(spark, path) == WANTED and len(data_files(path)) == 2


def test_a_sweep_that_dies_is_repeated(spark, fed, monkeypatch):
    path, _ = fed
    compact(spark, path, everything=True)
    deleted = []

    def some(session, name, whole=False):
        if len(deleted) == 3:
            raise RuntimeError("died")
        deleted.append(name)
        writers.delete(session, name, whole)

    for _ in range(4):
        deleted.clear()
        with monkeypatch.context() as patched:
            patched.setattr(compaction, "delete", some)
            try:
                sweep(spark, path, older_than=-60)
            except RuntimeError:
                pass
        assert rows(spark, path) == WANTED
    sweep(spark, path, older_than=-60)
    assert rows(spark, path) == WANTED and len(data_files(path)) == 2


def test_a_feeder_during_a_compaction(spark, fed, monkeypatch):
    """What was replaced while the rows were rewritten stays replaced."""
    path, land = fed
    commit, done = Ledger.commit, []

    def commit_late(self, entry, version, over=0):
        if not done:
            done.append(True)
            land("a.json", v1={"views": 9})
        commit(self, entry, version, over)

    monkeypatch.setattr(Ledger, "commit", commit_late)
    compact(spark, path, everything=True)
    monkeypatch.undo()
    wanted = [("v1", 9, 5), *WANTED[1:]]
    assert rows(spark, path) == wanted
    sweep(spark, path, older_than=-60)
    assert rows(spark, path) == wanted
    compact(spark, path, everything=True)
    sweep(spark, path, older_than=-60)
    assert rows(spark, path) == wanted
    assert land("c.json", v5={}) == Taken(1, 1, 0)


def test_rows_of_a_feeder_at_work_are_not_swept(spark, fed, monkeypatch):
    path, land = fed
    commit, done = Ledger.commit, []

    def commit_late(self, entry, version, over=0):
        if not done:
            done.append(sweep(spark, path, older_than=60))
        commit(self, entry, version, over)

    monkeypatch.setattr(Ledger, "commit", commit_late)
    land("n.json", v8={})
    assert ("v8", 5, 5) in rows(spark, path)


def test_only_fed_tables(spark, tmp_path):
    with pytest.raises(ValueError, match="not fed"):
        compact(spark, str(tmp_path / "t"))
    with pytest.raises(Conflict):
        Ledger(spark, str(tmp_path / "t")).commit(spark.createDataFrame([], "file string, day string, kind string, modified timestamp, length bigint, taking bigint, compacted boolean"), 3)
