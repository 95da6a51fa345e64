"""Marts that change at one instant, are known to be whole, and are kept while they stay as they are."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from stridelake.operators import marts
from stridelake.operators.selection import select_rows
from stridelake.plans import build
from stridelake.plans.build import build_marts
from stridelake.plans.cache import ResultCache
from stridelake.plans.load import check_mart, load_activity_counts, load_mart, load_summary, stored_mart
from stridelake.plans.serve import query, query_or_error
from stridelake.schema import ACTIVITY_COUNTS, MART_SCHEMAS, ROLLUP, SUMMARY, WRIST_COUNTS
from stridelake.sources.lake import read_lake
from stridelake.sources.manifest import latest_manifest
from stridelake.sources.sample import generated_runs, sample_runs
from stridelake.sources.tables import read_parts

SHORT = ["date", "username", "samples", "avg_accel_magnitude"]


def rows(df):
    return sorted(map(str, df.collect()))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def totals(spark, path, manifest):
    """Samples in the roll-up and in each mart."""
    rolled = read_parts(spark, path, ROLLUP, manifest.tables[ROLLUP]).agg(F.sum("n")).first()[0]
    summed = stored_mart(spark, SUMMARY, path, manifest=manifest).agg(F.sum("samples")).first()[0]
    counted = [stored_mart(spark, n, path, manifest=manifest).agg(F.sum("cnt")).first()[0] for n in (ACTIVITY_COUNTS, WRIST_COUNTS)]
    return {rolled, summed, *counted}


@pytest.fixture
def built(spark, at):
    generated_runs(spark, 3_000, users=5, days=80).write.parquet(at("lake"))
    build_marts(spark, at("lake"), at("marts"))
    return at("marts")


def test_readers_see_one_state(spark, at, built):
    before = latest_manifest(spark, built)
    generated_runs(spark, 1_000, users=5, days=80).write.mode("append").parquet(at("lake"))
    build_marts(spark, at("lake"), built)
    assert totals(spark, built, before) == {3_000}
    assert totals(spark, built, latest_manifest(spark, built)) == {4_000}


def test_readers_while_marts_are_written(spark, at, built, monkeypatch):
    """At every step of a build a new reader sees marts and roll-up of one build."""
    generated_runs(spark, 1_000, users=5, days=80).write.mode("append").parquet(at("lake"))
    seen, lock = [], threading.Lock()

    def watched(step):
        def run(*args, **how):
            with lock:
                seen.append(totals(spark, built, latest_manifest(spark, built)))
            out = step(*args, **how)
            with lock:
                seen.append(totals(spark, built, latest_manifest(spark, built)))
            return out

        return run

    for name in ("write_parts", "sealed", "commit"):
        monkeypatch.setattr(build, name, watched(getattr(build, name)))
    build_marts(spark, at("lake"), built)
    assert all(s == {3_000} for s in seen[:-1]) and seen[-1] == {4_000} and len(seen) > 10


def _files(path, name):
    return sorted(os.path.join(d, f) for d, _, found in os.walk(os.path.join(path, name)) for f in found if f.endswith(".parquet"))


def _damage_a_page(files):
    with open(files[0], "r+b") as f:
        f.seek(12)
        f.write(bytes(40))


def _other_rows(files):
    """A readable file of the same length in another's place."""
    with open(files[1], "rb") as f:
        other = f.read()
    with open(files[0], "wb") as f:
        f.write(other)


def _footer_gone(files):
    os.truncate(files[0], os.path.getsize(files[0]) - 4)


def _extra(files):
    with open(files[0], "rb") as f, open(os.path.join(os.path.dirname(files[0]), "part-extra.parquet"), "wb") as g:
        g.write(f.read())


@pytest.mark.parametrize("harm", [_damage_a_page, _other_rows, _footer_gone, _extra, lambda files: os.remove(files[0])])
@pytest.mark.parametrize("name, load", [(SUMMARY, load_summary), (ACTIVITY_COUNTS, load_activity_counts)])
def test_marts_that_are_not_whole_lead_to_the_lake(spark, at, built, name, load, harm):
    whole = load(spark, built, at("lake"))
    assert whole.columns == MART_SCHEMAS[name].names and "build=" in whole.inputFiles()[0]
    files = _files(built, name)
    for path in files:  # the checksums of the local file system would tell as well
        crc = os.path.join(os.path.dirname(path), f".{os.path.basename(path)}.crc")
        if os.path.exists(crc):
            os.remove(crc)
    harm(files)
    found = load(spark, built, at("lake"))
    assert all("/lake/" in f for f in found.inputFiles())
    if name == SUMMARY:
        assert found.columns == SHORT
    else:
        assert rows(found) == rows(marts.daily_activity_counts(read_lake(spark, at("lake"))))
    with pytest.raises(Exception):
        check_mart(spark, name, built)
    # months without the harm are still served
    months = sorted({f.split("event_month=")[1][:10] for f in files})
    other = load(spark, built, at("lake"), start=months[1], end=f"{months[1][:8]}28")
    assert other.columns == MART_SCHEMAS[name].names


def test_cache(spark, at, built):
    cache = ResultCache()
    first = load_summary(spark, built, at("lake"), cache=cache)
    second = load_summary(spark, built, at("lake"), cache=cache)
    assert rows(first) == rows(second) == rows(load_summary(spark, built)) and second.schema == load_summary(spark, built).schema
    assert "FileScan" not in plan_of(second) and "FileScan" in plan_of(load_summary(spark, built))
    of_user = load_summary(spark, built, cache=cache, user="user_1", start="2017-07-05")
    assert rows(of_user) == rows(select_rows(load_summary(spark, built), "user_1", "2017-07-05")) and len(cache) == 2
    generated_runs(spark, 1_000, users=5, days=80).write.mode("append").parquet(at("lake"))
    build_marts(spark, at("lake"), built)
    assert cache.find(latest_manifest(spark, built), "anything") is None and len(cache) == 0
    again = load_summary(spark, built, cache=cache)
    assert rows(again) == rows(load_summary(spark, built)) != rows(first)
    assert again.agg(F.sum("samples")).first()[0] == 4_000


def test_cache_is_bounded(spark, at, built):
    cache = ResultCache(max_entries=2, max_rows=20)
    large = load_summary(spark, built, cache=cache)
    assert len(cache) == 0 and "FileScan" in plan_of(large) and large.count() > 20
    for day in ("2017-07-01", "2017-07-02", "2017-07-03"):
        load_summary(spark, built, cache=cache, start=day, end=day)
    assert len(cache) == 2
    assert load_mart(spark, SUMMARY, at("none"), at("lake"), cache=cache).columns == SHORT and len(cache) == 2


def test_large_results_are_held_on_executors(spark, at, built, monkeypatch):
    expected, schema = rows(load_summary(spark, built)), load_summary(spark, built).schema
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    cache = ResultCache(max_rows=10_000, max_driver_rows=20)
    with monkeypatch.context() as patch:
        patch.setattr(type(spark.range(0)), "toArrow", lambda self: pytest.fail("rows sent to the driver"))
        first, second = (load_summary(spark, built, cache=cache) for _ in range(2))
    assert len(cache) == 1 and spark.sparkContext._jsc.getPersistentRDDs().size() == before + 1
    assert "InMemoryTableScan" in plan_of(second) and second.schema == schema
    assert "InMemoryTableScan" not in plan_of(load_summary(spark, built))
    for path in _files(built, SUMMARY):
        os.remove(path)
    assert rows(first) == rows(second) == expected
    build_marts(spark, at("lake"), built)
    other = load_summary(spark, built, cache=cache, user="user_1", start="2017-07-05", end="2017-07-08")
    assert other.count() <= 4 and len(cache) == 1 and spark.sparkContext._jsc.getPersistentRDDs().size() == before
    assert rows(load_summary(spark, built, cache=cache)) == expected and len(cache) == 2
    cache.clear()
    assert len(cache) == 0 and spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_queries_leave_the_callers_views_alone(spark, at, built):
    spark.range(7).createOrReplaceTempView("runs")
    spark.range(8).createOrReplaceTempView(SUMMARY)
    for lake in (at("missing"), at("lake")):
        assert query(spark, f"SELECT sum(samples) FROM {SUMMARY}", built, lake).first()[0] == 3_000
    assert query(spark, "SELECT count(*) FROM runs", built, at("lake")).first()[0] == 3_000
    with pytest.raises(Exception, match="runs"):
        query(spark, "SELECT * FROM runs", built)
    assert spark.table("runs").count() == 7 and spark.table(SUMMARY).count() == 8
    spark.catalog.dropTempView("runs"), spark.catalog.dropTempView(SUMMARY)
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        assert query(spark, "SELECT current_timezone()", built).first()[0] == "Asia/Tokyo"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_marts_that_cannot_be_opened_give_an_error_row(spark, at, built):
    sql = f"SELECT count(*) AS n FROM {WRIST_COUNTS}"
    assert query_or_error(spark, sql, built).columns == ["n"]
    with pytest.raises(Exception, match="no_such_column"):
        query_or_error(spark, "SELECT no_such_column", built)
    assert query_or_error(spark, sql, at("none")).isEmpty()
    os.remove(_files(built, WRIST_COUNTS)[0])
    (row,) = query_or_error(spark, sql, built).collect()
    assert row.asDict().keys() == {"error"} and row["error"].startswith("Could not open the marts")


def test_nanosecond_lakes_leave_the_session_as_it_is(spark, at):
    frame = sample_runs(spark).toPandas()
    frame["date"] = frame["date"].astype("datetime64[ns]")
    frame.to_parquet(at("lake.parquet"), index=False)
    setting = "spark.sql.legacy.parquet.nanosAsLong"
    for before in ("false", "true"):
        spark.conf.set(setting, before)
        try:
            runs = read_lake(spark, at("lake.parquet"))
            assert spark.conf.get(setting) == before
            assert marts.daily_user_summary(runs).count() == 3
            plain = sample_runs(spark).withColumn("date", F.to_timestamp("date").cast("timestamp_ntz"))
            assert plain.select("date").unionAll(runs.select("date")).count() == 8
        finally:
            spark.conf.set(setting, "false")
