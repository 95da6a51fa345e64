import os

import pytest

from stridelake import run_incremental
from stridelake.operators import marts
from stridelake.plans.build import build_marts
from stridelake.plans.ingest import ingest
from stridelake.plans.load import stored_mart
from stridelake.schema import ACTIVITY_COUNTS, ROLLUP, SUMMARY, WRIST_COUNTS
from stridelake.sources.lake import read_lake
from stridelake.sources.tables import read_table
from stridelake.streaming.incremental import add_files

HEADER = "date,time,username,wrist,activity,acceleration_x,acceleration_y,acceleration_z,gyro_x,gyro_y,gyro_z"


def sample(date, user, wrist, activity, x, rest="0.1,0.2,0.3,0.4,0.5"):
    return f"{date},12:00:00,{user},{wrist},{activity},{x},{rest}"


@pytest.fixture
def run(spark, at, tmp_path):
    os.mkdir(at("raw"))

    class Run:
        raw, lake, marts, checkpoint = at("raw"), at("lake"), at("marts"), at("checkpoint")

        def add(self, name, *lines, header=HEADER):
            (tmp_path / "raw" / name).write_text("\n".join([header, *lines]) + "\n")

        def go(self, **options):
            return run_incremental(spark, self.raw, self.lake, self.marts, self.checkpoint, **options)

        def mart(self, name):
            return sorted(map(str, stored_mart(spark, name, self.marts).collect()))

        def everything(self):
            return {n: self.mart(n) for n in (SUMMARY, ACTIVITY_COUNTS, WRIST_COUNTS)} | {
                "lake": sorted(map(str, read_lake(spark, self.lake).collect()))
            }

        def assert_like_a_rebuild(self):
            build_marts(spark, self.lake, at("rebuilt"))
            for name in (SUMMARY, ACTIVITY_COUNTS, WRIST_COUNTS):
                rebuilt = sorted(map(str, stored_mart(spark, name, at("rebuilt")).collect()))
                assert self.mart(name) == rebuilt, name
            direct = marts.daily_user_summary_direct(read_lake(spark, self.lake))
            assert self.mart(SUMMARY) == sorted(map(str, direct.collect()))

    return Run()


def test_waves_equal_a_rebuild(spark, run, at):
    run.add("a.csv", sample("2024-1-30", "u", 0, 1, 3.0), sample("2024-2-1", "v", 1, 0, 4.0))
    assert run.go() == 2
    first = run.everything()
    # a late row for a day already built, rows without a day, another header with a new column
    run.add("b.csv", sample("2024-1-30", "u", 1, 0, 9.0), sample("", "w", 0, 0, 1.0), sample("", "w", 0, 2, 2.0))
    run.add("c.csv", '2024-3-5,u,"a ""note"",\nin two lines"', header="date,username,note")
    assert run.go() == 4
    run.assert_like_a_rebuild()
    assert run.mart(SUMMARY) != first[SUMMARY]
    before = run.everything()
    assert run.go() == 0
    assert run.everything() == before
    lake = read_lake(spark, run.lake)
    assert lake.count() == 6
    assert [r.note for r in lake.where("note IS NOT NULL").collect()] == ['a "note",\nin two lines']
    assert "batch_id" not in lake.columns


def test_replayed_batch_changes_nothing(spark, run):
    run.add("a.csv", sample("2024-1-30", "u", 0, 1, 3.0))
    run.go()
    run.add("b.csv", sample("2024-1-30", "u", 0, 1, 5.0), sample("", "u", 0, 1, 5.0))
    run.go()
    before = run.everything()
    files = [os.path.join("file:" + run.raw, "b.csv")]
    assert add_files(spark, files, 1, run.lake, run.marts) == 2
    assert run.everything() == before
    run.assert_like_a_rebuild()


def test_untouched_months_are_not_rewritten(spark, run):
    run.add("a.csv", sample("2024-1-30", "u", 0, 1, 3.0), sample("2024-2-1", "v", 1, 0, 4.0))
    run.go()

    def files(month):
        folder = f"{run.marts}/{SUMMARY}/event_month={month}"
        return {n: os.path.getmtime(f"{folder}/{n}") for n in os.listdir(folder)}

    january, february = files("2024-01-01"), files("2024-02-01")
    run.add("b.csv", sample("2024-2-2", "v", 1, 0, 4.0))
    run.go()
    assert files("2024-01-01") == january
    assert files("2024-02-01") != february


def test_several_batches_in_one_run(spark, run):
    for i in range(5):
        run.add(f"f{i}.csv", sample("2024-1-1", "u", i % 2, i % 3, i), sample(f"2024-1-{i + 1}", "v", 0, 0, 1))
    assert run.go(max_files_per_batch=2) == 10
    run.assert_like_a_rebuild()
    assert read_table(spark, f"{run.marts}/{ROLLUP}").select("batch_id").distinct().count() == 3


def test_full_build_can_take_over_and_hand_back(spark, run):
    run.add("a.csv", sample("2024-1-1", "u", 0, 0, 1.0))
    run.go()
    build_marts(spark, run.lake, run.marts)
    run.add("b.csv", sample("2024-1-1", "u", 0, 0, 2.0))
    run.go()
    run.assert_like_a_rebuild()


def test_refusals(spark, run, at):
    assert run.go() == 0
    run.add("a.csv", sample("2024-1-1", "u", 0, 0, 1.0))
    run.go()
    before = run.everything()
    run.add("_late.csv", sample("2024-1-1", "u", 0, 0, 1.0))
    with pytest.raises(ValueError, match="rename"):
        run.go()
    os.remove(os.path.join(run.raw, "_late.csv"))
    run.add("b.csv", sample("2024-1-1", "u", 0, "jumping", 1.0))
    with pytest.raises(Exception, match="does not fit bigint: jumping"):
        run.go()
    assert run.everything() == before
    # once the file is put right, the same batch goes through
    run.add("b.csv", sample("2024-1-1", "u", 0, 2, 1.0))
    assert run.go() == 1
    run.assert_like_a_rebuild()
    with pytest.raises(ValueError, match="read twice"):
        run_incremental(spark, run.raw, run.lake, run.marts, at("other-checkpoint"))


def test_old_files_and_odd_folders(spark, run, at, tmp_path):
    run.raw = at("raw[1]")
    os.mkdir(run.raw)

    def add(name, text, age):
        path = tmp_path / "raw[1]" / name
        path.write_text(f"{HEADER}\n{text}\n")
        os.utime(path, (path.stat().st_mtime - age * 86_400,) * 2)

    add("a.csv", sample("2024-1-30", "u", 0, 1, 3.0), 0)
    assert run.go() == 1
    add("b.csv", sample("2024-1-30", "u", 1, 1, 4.0), 400)
    assert run.go() == 1
    run.assert_like_a_rebuild()
    assert read_lake(spark, run.lake).count() == 2


def test_tables_that_do_not_belong_together_are_refused(spark, run, at, tmp_path):
    run.add("a.csv", sample("2024-1-30", "u", 0, 1, 3.0))
    run.go()
    run.add("b.csv", sample("2024-1-30", "u", 1, 1, 4.0))
    before = run.everything()
    marts_dir, lake = run.marts, run.lake
    run.marts = at("other-marts")
    with pytest.raises(ValueError, match="is gone"):
        run.go()
    run.marts, run.lake = marts_dir, at("other-lake")
    with pytest.raises(ValueError, match="is gone"):
        run.go()
    run.lake = lake
    assert run.everything() == before
    assert run.go() == 1
    run.assert_like_a_rebuild()
    ingest(spark, run.raw, run.lake)
    run.add("c.csv", sample("2024-1-30", "u", 1, 1, 4.0))
    with pytest.raises(ValueError, match="was not made by this run"):
        run.go()
    assert read_lake(spark, run.lake).count() == 2


def test_undeclared_columns_take_whatever_comes(spark, run):
    for i, value in enumerate(("5", "5.5", "five")):
        run.add(f"{i}.csv", f'{sample("2024-1-30", "u", 0, 1, 3.0)},{value}', header=f"{HEADER},steps")
        assert run.go() == 1
    assert sorted(r.steps for r in read_lake(spark, run.lake).collect()) == ["5", "5.5", "five"]
    run.assert_like_a_rebuild()


def test_files_without_sensor_columns(spark, run):
    run.add("a.csv", "2024-1-1,u,5", header="date,username,steps")
    # lacks sensor columns: the lake takes it, the marts cannot be built
    with pytest.raises(Exception, match="activity|UNRESOLVED"):
        run.go()
