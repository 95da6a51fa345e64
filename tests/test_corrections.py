"""Rewritten and deleted files, interrupted runs and compaction: always the tables of a full rebuild."""

import os

import pytest
from test_incremental import HEADER, run, sample  # noqa: F401

from stridelake.plans.build import build_marts
from stridelake.plans.ingest import ingest
from stridelake.plans.load import stored_mart
from stridelake.schema import ACTIVITY_COUNTS, EVENT_DATE, ROLLUP, SUMMARY, WRIST_COUNTS
from stridelake.sources import manifest as manifests
from stridelake.sources.lake import read_lake
from stridelake.sources.manifest import latest_manifest, vacuum
from stridelake.streaming import compaction, incremental
from stridelake.streaming.compaction import compact


def remove(run, name):  # noqa: F811
    os.remove(os.path.join(run.raw, name))


def rows(df):
    return sorted(map(str, df.collect()))


def assert_like_a_full_run(spark, run, at):  # noqa: F811
    """Lake and marts as a full run over the files that are there would make them."""
    full = {k: at(f"full-{k}-{os.urandom(4).hex()}") for k in ("lake", "marts")}
    ingest(spark, run.raw, full["lake"])
    build_marts(spark, full["lake"], full["marts"])
    lake, whole = read_lake(spark, run.lake), read_lake(spark, full["lake"])
    assert set(lake.columns) >= set(whole.columns)
    assert rows(lake.select(sorted(whole.columns))) == rows(whole.select(sorted(whole.columns)))
    assert {f.name: f.dataType for f in whole.schema}.items() <= {f.name: f.dataType for f in lake.schema}.items()
    for name in (SUMMARY, ACTIVITY_COUNTS, WRIST_COUNTS):
        assert run.mart(name) == rows(stored_mart(spark, name, full["marts"])), name


def test_rewritten_and_deleted_files(spark, run, at):  # noqa: F811
    run.add("a.csv", sample("2024-1-30", "u", 0, 1, 3.0), sample("2024-2-1", "v", 1, 0, 4.0))
    run.add("b.csv", sample("2024-1-30", "u", 1, 1, 4.0), sample("", "w", 0, 0, 1.0))
    run.add("with + and ü.csv", sample("2024-4-1", "x", 1, 1, 4.0))
    assert run.go() == 5
    # another month, another user, more rows; a month and a user that lose all they have
    run.add("a.csv", sample("2024-3-30", "u", 0, 1, 3.5), sample("2024-2-1", "new", 1, 0, 4.0), sample("2024-2-1", "new", 1, 0, 5.0))
    remove(run, "with + and ü.csv")
    assert run.go() == 3
    assert_like_a_full_run(spark, run, at)
    assert run.go() == 0
    remove(run, "b.csv")
    run.add("c.csv", sample("2024-1-30", "z", 1, 1, 4.0))
    assert run.go() == 1
    assert_like_a_full_run(spark, run, at)
    # a deleted file comes back, and is rewritten at once after that
    run.add("b.csv", sample("2024-1-30", "back", 1, 1, 4.0))
    assert run.go() == 1
    assert_like_a_full_run(spark, run, at)
    run.add("b.csv", sample("2024-1-30", "back again", 1, 1, 4.0))
    assert run.go() == 1
    assert_like_a_full_run(spark, run, at)


def test_a_file_moved_over_another_is_read_again(spark, run, at, tmp_path):  # noqa: F811
    """Same name and length, another time."""
    run.add("a.csv", sample("2024-1-30", "u", 0, 1, 3.0))
    run.go()
    path = tmp_path / "raw" / "a.csv"
    run.add("a.csv", sample("2024-1-30", "v", 0, 1, 3.0))
    os.utime(path, (path.stat().st_mtime + 5,) * 2)
    assert run.go() == 1
    assert_like_a_full_run(spark, run, at)


def test_only_touched_partitions_are_written_again(spark, run):  # noqa: F811
    run.add("a.csv", sample("2024-1-30", "u", 0, 1, 3.0), sample("2024-1-31", "u", 0, 1, 3.0))
    run.add("b.csv", sample("2024-1-31", "u", 0, 1, 3.0), sample("2024-2-1", "u", 0, 1, 3.0))
    run.go()
    before = latest_manifest(spark, run.lake).parts("")
    remove(run, "b.csv")
    run.go()
    after = latest_manifest(spark, run.lake).parts("")
    assert after[f"{EVENT_DATE}=2024-01-30/batch_id=0"] == before[f"{EVENT_DATE}=2024-01-30/batch_id=0"]
    assert after[f"{EVENT_DATE}=2024-01-31/batch_id=0"] != before[f"{EVENT_DATE}=2024-01-31/batch_id=0"]
    assert f"{EVENT_DATE}=2024-02-01/batch_id=0" not in after
    assert not [p for p in latest_manifest(spark, run.marts).parts(SUMMARY) if "2024-02" in p]


def test_empty_folder_changes_nothing(spark, run):  # noqa: F811
    run.add("a.csv", sample("2024-1-30", "u", 0, 1, 3.0))
    run.go()
    before = run.everything()
    remove(run, "a.csv")
    assert run.go() == 0
    assert run.everything() == before


def test_foreign_marts_are_refused(spark, run, at):  # noqa: F811
    """Marts of a full build know nothing of the files: taking them in beside would count them twice."""
    run.add("a.csv", sample("2024-1-30", "u", 0, 1, 3.0), sample("2024-1-30", "u", 0, 1, 4.0))
    ingest(spark, run.raw, at("full-lake"))
    build_marts(spark, at("full-lake"), run.marts)
    before = run.mart(SUMMARY)
    for _ in range(2):
        with pytest.raises(ValueError, match="read twice|not made"):
            run.go()
    assert run.mart(SUMMARY) == before and not os.path.exists(run.lake)


class Died(Exception):
    pass


@pytest.mark.parametrize("fails_at", range(2))
def test_interrupted_runs_are_made_good(spark, run, at, monkeypatch, fails_at):  # noqa: F811
    """Dies before the lake's manifest, and between lake and marts, of a correction."""
    run.add("a.csv", sample("2024-1-30", "u", 0, 1, 3.0), sample("2024-2-1", "v", 1, 0, 4.0))
    run.add("b.csv", sample("2024-1-30", "u", 1, 1, 4.0))
    run.go()
    before = run.everything()
    run.add("a.csv", sample("2024-1-30", "u", 0, 0, 9.0))
    remove(run, "b.csv")
    run.add("c.csv", sample("2024-2-7", "u", 0, 0, 9.0))
    commits, commit = [], incremental.commit

    def dying(spark, manifest):
        commits.append(manifest.root)
        if len(commits) > fails_at:
            raise Died
        commit(spark, manifest)

    monkeypatch.setattr(incremental, "commit", dying)
    with pytest.raises(Exception, match="Died"):
        run.go()
    assert {n: run.mart(n) for n in (SUMMARY, ACTIVITY_COUNTS)} == {n: before[n] for n in (SUMMARY, ACTIVITY_COUNTS)}
    monkeypatch.setattr(incremental, "commit", commit)
    run.go()
    assert_like_a_full_run(spark, run, at)
    assert vacuum(spark, run.lake) or fails_at
    assert_like_a_full_run(spark, run, at)


def test_compaction(spark, run, at):  # noqa: F811
    for i in range(12):
        run.add(f"f{i}.csv", sample(f"2024-1-{1 + i % 2}", "u", i % 2, i % 3, i), sample("2024-2-1", "v", 0, 0, i) if i < 4 else sample("", "w", 0, 0, i))
    run.go(max_files_per_batch=1)
    run.add("f3.csv", sample("2024-1-1", "rewritten", 0, 0, 1.0))
    run.go()
    before = run.everything()
    marts = latest_manifest(spark, run.marts).parts(SUMMARY)
    assert compact(spark, run.lake, run.marts, more_than=20) == []
    assert compact(spark, run.lake, run.marts, more_than=5) == ["2024-01-01", "__HIVE_DEFAULT_PARTITION__"]
    assert run.everything() == before and latest_manifest(spark, run.marts).parts(SUMMARY) == marts
    lake = latest_manifest(spark, run.lake).parts("")
    assert sum("event_date=2024-01" in p for p in lake) == 2 and sum("event_date=2024-02" in p for p in lake) == 3
    assert sum("=2024-01" in p for p in latest_manifest(spark, run.marts).parts(ROLLUP)) == 1
    assert run.go() == 0 and run.everything() == before
    # files of merged batches are still known
    run.add("f5.csv", sample("2024-1-2", "rewritten too", 0, 0, 1.0))
    remove(run, "f0.csv")
    run.add("g.csv", sample("2024-1-2", "u", 0, 0, 1.0))
    assert run.go() == 2
    assert_like_a_full_run(spark, run, at)
    assert compact(spark, run.lake, run.marts, more_than=1) == ["2024-01-01", "2024-02-01"]
    assert_like_a_full_run(spark, run, at)
    run.assert_like_a_rebuild()


def test_batch_run_again_after_compaction(spark, run):  # noqa: F811
    for name in "ab":
        run.add(f"{name}.csv", sample("2024-1-30", name, 0, 1, 3.0), sample("2024-1-31", name, 0, 1, 3.0))
        run.go()
    compact(spark, run.lake, run.marts, more_than=1)
    before = run.everything()
    assert incremental.add_files(spark, [os.path.join("file:" + run.raw, "b.csv")], 1, run.lake, run.marts) == 2
    assert run.everything() == before


def test_interrupted_compaction(spark, run, at, monkeypatch):  # noqa: F811
    for name in "abc":
        run.add(f"{name}.csv", sample("2024-1-30", name, 0, 1, 3.0))
        run.go()
    monkeypatch.setattr(compaction, "write_rollup", lambda *_: (_ for _ in ()).throw(Died()))
    with pytest.raises(Died):
        compact(spark, run.lake, run.marts, more_than=1)
    run.assert_like_a_rebuild()
    run.add("d.csv", sample("2024-1-30", "d", 0, 1, 3.0))
    assert run.go() == 1
    assert_like_a_full_run(spark, run, at)


def test_old_folders_are_deleted_once_nobody_needs_them(spark, run):  # noqa: F811
    for i in range(6):
        run.add("a.csv", sample("2024-1-30", f"u{i}", 0, 1, float(i)))
        run.go()
    folders = [d for d, _, files in os.walk(run.marts) if "build=" in d and SUMMARY in d]
    assert len(folders) == manifests.KEPT and len(os.listdir(f"{run.marts}/_manifests")) <= 2 * manifests.KEPT + 2
    assert vacuum(spark, run.marts) == []


def test_a_second_writer_is_refused(spark, run):  # noqa: F811
    run.add("a.csv", sample("2024-1-30", "u", 0, 1, 3.0))
    run.go()
    now = latest_manifest(spark, run.marts)
    manifests.commit(spark, now.following({}))
    with pytest.raises(RuntimeError, match="something else writes"):
        manifests.commit(spark, now.following({}))


def test_many_files_of_one_batch(spark, run, at):  # noqa: F811
    for i in range(40):
        run.add(f"f{i}.csv", sample(f"2024-1-{1 + i % 9}", f"u{i}", 0, i % 3, 1.0))
    assert run.go() == 40
    for i in range(0, 40, 3):
        run.add(f"f{i}.csv", sample(f"2024-1-{1 + i % 5}", f"u{i}", 1, i % 3, 2.0), sample("2024-6-1", "u", 0, 0, 1.0))
    for i in range(1, 40, 7):
        if i % 3:
            remove(run, f"f{i}.csv")
    run.go()
    assert_like_a_full_run(spark, run, at)
    assert HEADER


def test_types_of_undeclared_columns_widen(spark, run, at):  # noqa: F811
    """Every step has the types of a full run: wider with a new batch, narrower where values leave."""
    header = f"{HEADER},steps,ok,empty,code"

    def add(name, steps, ok, code, empty=""):
        run.add(name, f'{sample("2024-1-30", name, 0, 1, 3.0)},{steps},{ok},{empty},{code}', header=header)
        run.go()
        assert_like_a_full_run(spark, run, at)
        return dict(read_lake(spark, run.lake).select("steps", "ok", "empty", "code").dtypes)

    assert add("a.csv", 5, "true", 7) == {"steps": "bigint", "ok": "boolean", "empty": "double", "code": "bigint"}
    assert add("b.csv", 5.5, "", "1e3") == {"steps": "double", "ok": "boolean", "empty": "double", "code": "double"}
    assert add("c.csv", "NA", 1, "12345678901234567890") == {"steps": "double", "ok": "string", "empty": "double", "code": "string"}
    assert add("d.csv", "five", "", 1, empty=0)["steps"] == "string"
    compact(spark, run.lake, run.marts, more_than=1)
    assert_like_a_full_run(spark, run, at)
    assert add("d.csv", 5, "", 1) == {"steps": "double", "ok": "string", "empty": "double", "code": "string"}
    remove(run, "c.csv")
    assert add("e.csv", "", "false", 2) == {"steps": "double", "ok": "boolean", "empty": "double", "code": "double"}


def test_jobs(spark, run, monkeypatch, capsys):  # noqa: F811
    from stridelake.__main__ import _parser, main

    monkeypatch.delenv("DEFAULT_RAW", raising=False)
    monkeypatch.delenv("DEFAULT_OUT", raising=False)
    parsed = _parser().parse_args(["ingest"])
    assert (parsed.raw_dir, parsed.lake) == ("data/raw", "lake/parquet/runs.parquet")
    monkeypatch.setenv("DEFAULT_RAW", run.raw)
    monkeypatch.setenv("DEFAULT_OUT", run.lake)
    rest = ["--marts", run.marts]
    for name in "ab":
        run.add(f"{name}.csv", sample("2024-1-30", name, 0, 1, 3.0))
        assert main(["incremental", "--checkpoint", run.checkpoint, *rest]) == 0
    assert main(["compact", "--more-than", "1", *rest]) == 0 and main(["vacuum", *rest]) == 0
    assert capsys.readouterr().out.splitlines() == ["1 new rows", "1 new rows", "1 months: 2024-01-01", "0 folders"]
    run.assert_like_a_rebuild()
