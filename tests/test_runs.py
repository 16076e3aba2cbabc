"""The store of whole runs: publication, conflicts, listing without data files, cleaning."""
from pathlib import Path

import pytest

from panelcast.sources import runs, store


def snap(spark, refresh, value, model="M"):
    return spark.createDataFrame([("2021Q1", "S", value, value, model, None, None, None, None, "Jan'21", refresh, "S")],
                                 store.SNAPSHOT_SCHEMA)


def put(spark, root, refresh, value, run, publish=True):
    runs.stage(snap(spark, refresh, value), root, "snapshots", run)
    if publish:
        return runs.publish(spark, root, run, [refresh])


def values(spark, root):
    return sorted((r.refresh_date, r.rev) for r in store.read_snapshots(spark, f"{root}/snapshots").collect())


def test_only_published_runs_are_read(spark, scratch):
    assert runs.manifest(spark, scratch) is None and values(spark, scratch) == []
    assert put(spark, scratch, "2021Q1", 1.0, "a") == 1
    put(spark, scratch, "2021Q2", 9.0, "b", publish=False)
    assert values(spark, scratch) == [("2021Q1", 1.0)]
    assert runs.publish(spark, scratch, "b", ["2021Q2"]) == 2
    put(spark, scratch, "2021Q1", 5.0, "c")  # a rerun replaces its refresh
    assert values(spark, scratch) == [("2021Q1", 5.0), ("2021Q2", 9.0)]
    assert [r.rev for r in store.latest_snapshot(spark, f"{scratch}/snapshots").collect()] == [9.0]
    assert [r.rev for r in store.earliest_snapshot(spark, f"{scratch}/snapshots").collect()] == [5.0]
    assert [r.rev for r in store.history_before(spark, f"{scratch}/snapshots", "2021Q2").collect()] == [5.0]
    assert runs.models_path(spark, scratch, "2021Q1").endswith("models/run=c")
    with pytest.raises(FileNotFoundError):
        runs.models_path(spark, scratch, "1999Q1")


def test_a_reader_keeps_its_state_and_a_refresh_may_be_empty(spark, scratch):
    put(spark, scratch, "2021Q1", 1.0, "a")
    before = store.read_snapshots(spark, f"{scratch}/snapshots")
    put(spark, scratch, "2021Q1", 2.0, "b")
    assert [r.rev for r in before.collect()] == [1.0]
    runs.stage(snap(spark, "2021Q1", 1.0).limit(0), scratch, "snapshots", "none")
    runs.publish(spark, scratch, "none", ["2021Q1"])
    assert values(spark, scratch) == []


def test_two_publications_at_once_both_count(spark, scratch, monkeypatch):
    put(spark, scratch, "2021Q1", 1.0, "a")
    for run, refresh in (("b", "2021Q2"), ("c", "2021Q3")):
        put(spark, scratch, refresh, 2.0, run, publish=False)
    listed = runs._versions
    stale = [listed(runs._Files(spark, scratch), scratch)]  # what the other run saw before

    def versions(files, root):
        return stale.pop() if stale else listed(files, root)

    runs.publish(spark, scratch, "b", ["2021Q2"])
    monkeypatch.setattr(runs, "_versions", versions)
    assert runs.publish(spark, scratch, "c", ["2021Q3"]) == 3
    assert set(runs.manifest(spark, scratch)) == {"2021Q1", "2021Q2", "2021Q3"}
    assert not [n for n in runs._Files(spark, scratch).names(f"{scratch}/manifest") if n.startswith(".b") or n.startswith(".c")]


def spoil(folder):
    for f in Path(folder).rglob("part-*"):
        f.write_bytes(b"no parquet")
        f.with_name(f".{f.name}.crc").unlink(missing_ok=True)


def test_the_newest_refresh_is_found_without_opening_a_file(spark, scratch):
    plain, whole = f"{scratch}/plain", f"{scratch}/store"
    for k, refresh in enumerate(("2021Q1", "2021Q2", "2021Q3")):
        store.append_snapshot(snap(spark, refresh, float(k)), plain)
        put(spark, whole, refresh, float(k), f"r{k}")
    for old in ("refresh_date=2021Q1", "refresh_date=2021Q2"):
        spoil(f"{plain}/{old}")
    spoil(f"{whole}/snapshots/run=r0")
    spoil(f"{whole}/snapshots/run=r1")
    for path in (plain, f"{whole}/snapshots"):
        latest = store.latest_snapshot(spark, path)
        assert [r.rev for r in latest.collect()] == [2.0]  # no file of another refresh is touched
    spoil(plain)
    assert runs.refreshes(spark, plain) == ["2021Q1", "2021Q2", "2021Q3"]
    assert store.latest_snapshot(spark, f"{scratch}/absent").count() == 0


def test_vacuum_keeps_what_is_published_or_young(spark, scratch):
    for k in range(4):
        put(spark, scratch, "2021Q1", float(k), f"r{k}")
    put(spark, scratch, "2021Q2", 7.0, "staged", publish=False)
    assert runs.vacuum(spark, scratch) == []  # all are young
    assert runs.vacuum(spark, scratch, keep_versions=2, min_age_s=-1.0) == ["r0", "r1", "staged"]
    assert values(spark, scratch) == [("2021Q1", 3.0)]
    assert len(runs._versions(runs._Files(spark, scratch), scratch)) == 2
