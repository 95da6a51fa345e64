import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from stridelake import exports, session
from stridelake.operators import marts
from stridelake.plans import build
from stridelake.plans.build import build_marts, publish_marts, roll_up, write_marts, write_rollup
from stridelake.plans.load import load_activity_counts, load_mart, load_summary, stored_mart
from stridelake.proxies import runs_from_events
from stridelake.schema import ACTIVITY_COUNTS, MART_SCHEMAS, ROLLUP, RUNS_SCHEMA, SUMMARY, WRIST_COUNTS
from stridelake.sources import tables
from stridelake.sources.lake import read_lake, register_runs
from stridelake.sources.sample import generated_runs, sample_runs
from stridelake.sources.tables import read_table

D = dt.date


def run_row(date, user, activity=0, wrist=0, a=(0.0, 0.0, 0.0), g=(0.0, 0.0, 0.0)):
    return (date, "12:00:00", user, wrist, activity, *a, *g)


def runs_of(spark, *rows):
    return spark.createDataFrame(list(rows), RUNS_SCHEMA)


def as_rows(df, digits=9):
    def plain(v):
        return round(v, digits) if isinstance(v, float) and not math.isnan(v) else v

    return sorted((tuple(plain(v) for v in r) for r in df.collect()), key=str)


def assert_close(a, b):
    a, b = (sorted(map(tuple, df.collect()), key=lambda r: str(r[:2])) for df in (a, b))
    assert len(a) == len(b)
    for left, right in zip(a, b):
        assert left == pytest.approx(right, abs=1e-9) if None not in left else left == right


def test_sample_summary(spark):
    expected = [
        (D(2017, 7, 1), "viktor", 0, 0, 2, 0.161803, 0.223607, 0.015, 0.0025, 0.0),
        (D(2017, 7, 2), "viktor", 0, 0, 1, 0.158114, 0.158114, -0.01, -0.002, 0.0),
        (D(2017, 7, 3), "viktor", 1, 1, 1, 0.122066, 0.122066, 0.0, 0.001, 0.0),
    ]
    for build in (marts.daily_user_summary, marts.daily_user_summary_direct):
        summary = build(sample_runs(spark))
        assert summary.schema.names == MART_SCHEMAS[SUMMARY].names
        assert [f.dataType for f in summary.schema] == [f.dataType for f in MART_SCHEMAS[SUMMARY]]
        assert as_rows(summary, 6) == expected


def test_sample_counts(spark):
    expected = [
        (D(2017, 7, 1), "viktor", 0, 1),
        (D(2017, 7, 1), "viktor", 1, 1),
        (D(2017, 7, 2), "viktor", 0, 1),
        (D(2017, 7, 3), "viktor", 1, 1),
    ]
    runs = sample_runs(spark)
    assert as_rows(marts.daily_activity_counts(runs)) == expected
    assert as_rows(marts.daily_wrist_counts(runs)) == expected


def test_missing_values(spark):
    runs = runs_of(
        spark,
        run_row("2020-1-1", None, None, 1, (3.0, 4.0, None), (1.0, None, float("nan"))),
        run_row("2020-1-1", None, None, None, (3.0, 4.0, 0.0), (2.0, None, 5.0)),
        run_row(None, "u", 1, 0, (float("nan"), 0.0, 0.0), (None, None, None)),
    )
    assert as_rows(marts.daily_user_summary(runs)) == [
        (None, "u", 1, 0, 1, None, None, None, None, None),
        (D(2020, 1, 1), None, None, 1, 2, 5.0, 5.0, 1.5, None, 5.0),
    ]
    assert as_rows(marts.daily_activity_counts(runs)) == [
        (None, "u", 1, 1),
        (D(2020, 1, 1), None, None, 2),
    ]
    assert as_rows(marts.fallback_summary(runs)) == [(None, "u", 1, None), (D(2020, 1, 1), None, 2, 5.0)]


def test_most_common_code(spark):
    codes = [(5, 2), (-3, 2), (-3, 1), (5, 1), (None, 0), (None, 0), (None, 0), (7, 0)]
    runs = runs_of(spark, *(run_row("2020-1-1", "u", a, w) for a, w in codes))
    # a tie of -3 and 5, and of NULL-heavier rows, gives the smallest; wrist 0 has four
    assert as_rows(marts.most_common_code(runs, "activity")) == [(D(2020, 1, 1), "u", -3)]
    assert as_rows(marts.daily_user_summary(runs).select("top_activity", "top_wrist")) == [(-3, 0)]
    text = runs.withColumn("activity", F.concat(F.lit("code"), "activity"))
    assert as_rows(marts.daily_user_summary(text).select("top_activity")) == [("code-3",)]


def test_largest_codes(spark):
    low, high = -(2**63), 2**63 - 1
    runs = runs_of(spark, *(run_row("2020-1-1", "u", a) for a in (high, low)))
    assert as_rows(marts.daily_user_summary(runs).select("top_activity")) == [(low,)]


def test_bad_date_strict_and_lenient(spark):
    runs = runs_of(spark, run_row("2020-1-1", "u"), run_row("soon", "u"))
    with pytest.raises(Exception, match="unreadable date: soon"):
        marts.daily_user_summary(runs).collect()
    assert [r[0] for r in as_rows(marts.daily_user_summary(runs, on_bad_date="null"))] == [None, D(2020, 1, 1)]


@pytest.mark.parametrize("hot_share", [0.0, 0.4])
def test_roll_up_equals_direct_form(spark, hot_share):
    runs = generated_runs(spark, 40_000, users=60, days=12, hot_share=hot_share)
    summary = marts.daily_user_summary(runs)
    assert_close(summary, marts.daily_user_summary_direct(runs))
    assert summary.agg(F.sum("samples")).first()[0] == 40_000


def test_hot_user_day_is_combined_before_the_shuffle(spark):
    runs = generated_runs(spark, 200_000, users=5, days=2, hot_share=0.5)
    plan = marts.rollup(runs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "partial_count" in plan and "SortAggregate" not in plan and "ObjectHashAggregate" not in plan
    assert marts.rollup(runs).count() <= 5 * 2 * 2 * 3


def test_build_load_and_rebuild(spark, at):
    runs = generated_runs(spark, 5_000, users=9, days=40)
    runs.write.parquet(at("lake"))
    paths = build_marts(spark, at("lake"), at("marts"))
    assert set(paths) == {ROLLUP, SUMMARY, ACTIVITY_COUNTS, WRIST_COUNTS}
    for _ in range(2):
        assert_close(load_summary(spark, at("marts"), at("lake")), marts.daily_user_summary_direct(runs))
        assert as_rows(load_activity_counts(spark, at("marts"))) == as_rows(marts.daily_activity_counts(runs))
        assert as_rows(load_mart(spark, WRIST_COUNTS, at("marts"))) == as_rows(marts.daily_wrist_counts(runs))
        build_marts(spark, at("lake"), at("marts"))
    assert stored_mart(spark, SUMMARY, at("marts")).columns == MART_SCHEMAS[SUMMARY].names
    # the stored roll-up adds up to the number of samples
    assert read_table(spark, paths[ROLLUP]).agg(F.sum("n")).first()[0] == 5_000


def test_build_reads_the_marts_own_folder_while_replacing_it(spark, at):
    sample_runs(spark).write.parquet(at("lake"))
    build_marts(spark, at("lake"), at("marts"))
    before = load_summary(spark, at("marts"))
    generated_runs(spark, 100, users=3, days=3).write.mode("append").parquet(at("lake"))
    build_marts(spark, at("lake"), at("marts"))
    assert load_summary(spark, at("marts")).count() > 3
    assert before.columns == MART_SCHEMAS[SUMMARY].names


def test_failed_build_keeps_the_old_marts(spark, at):
    sample_runs(spark).write.parquet(at("lake"))
    build_marts(spark, at("lake"), at("marts"))
    runs_of(spark, run_row("never", "u")).write.mode("append").parquet(at("lake"))
    with pytest.raises(Exception, match="unreadable date"):
        build_marts(spark, at("lake"), at("marts"))
    assert load_summary(spark, at("marts")).count() == 3
    build_marts(spark, at("lake"), at("marts"), on_bad_date="null")
    assert load_summary(spark, at("marts")).count() == 4


def test_missing_lake(spark, at):
    with pytest.raises(FileNotFoundError):
        build_marts(spark, at("nothing"), at("marts"))
    with pytest.raises(FileNotFoundError):
        read_lake(spark, at("nothing"))


def test_load_falls_back(spark, at):
    runs = sample_runs(spark)
    runs.write.parquet(at("lake"))
    short = load_summary(spark, at("none"), at("lake"))
    assert short.columns == ["date", "username", "samples", "avg_accel_magnitude"]
    assert as_rows(short, 6)[0] == (D(2017, 7, 1), "viktor", 2, 0.161803)
    assert as_rows(load_activity_counts(spark, None, at("lake"))) == as_rows(marts.daily_activity_counts(runs))
    for name, schema in MART_SCHEMAS.items():
        empty = load_mart(spark, name, at("none"), at("none"))
        assert empty.isEmpty() and empty.schema == schema
    with pytest.raises(KeyError):
        load_mart(spark, "other")


def test_unreadable_mart_falls_back(spark, at, tmp_path):
    sample_runs(spark).write.parquet(at("lake"))
    broken = tmp_path / "marts" / SUMMARY
    broken.mkdir(parents=True)
    (broken / "part-0.parquet").write_text("not parquet")
    assert load_summary(spark, at("marts"), at("lake")).count() == 3


def test_mart_with_a_broken_file_falls_back(spark, at, tmp_path):
    sample_runs(spark).write.parquet(at("lake"))
    build_marts(spark, at("lake"), at("marts"))
    assert (tmp_path / "marts" / "_manifests").exists()
    for path in (tmp_path / "marts" / SUMMARY).rglob("*.parquet"):
        (path.parent / f".{path.name}.crc").unlink(missing_ok=True)
        path.write_text("not parquet")
    assert load_summary(spark, at("marts"), at("lake")).count() == 3


def test_numbers_are_not_dates(spark, at):
    spark.range(3).selectExpr("20170630L AS date", "'u' AS username").write.parquet(at("numbers"))
    with pytest.raises(ValueError, match="is a number"):
        read_lake(spark, at("numbers"))


def test_empty_lake(spark, at):
    sample_runs(spark).limit(0).write.parquet(at("lake"))
    build_marts(spark, at("lake"), at("marts"))
    assert load_summary(spark, at("marts")).isEmpty()


def test_catalog_tables(spark, at):
    sample_runs(spark).write.parquet(at("lake"))
    build_marts(spark, at("lake"), at("marts"))
    spark.sql(f"CREATE DATABASE IF NOT EXISTS published LOCATION '{at('database')}'")
    publish_marts(spark, at("marts"), "published")
    tables = {t.name for t in spark.catalog.listTables("published")}
    assert set(MART_SCHEMAS) <= tables
    assert spark.table(f"published.{SUMMARY}").count() == 3
    described = {c.name for c in spark.catalog.listColumns(f"published.{SUMMARY}")}
    assert set(MART_SCHEMAS[SUMMARY].names) <= described
    publish_marts(spark, at("marts"), "published")
    assert spark.table(f"published.{ACTIVITY_COUNTS}").count() == 4


def test_runs_relation(spark, at):
    sample_runs(spark).write.parquet(at("lake"))
    register_runs(spark, at("lake"), "samples_on_disk")
    register_runs(spark, sample_runs(spark), "samples_in_memory")
    for view in ("samples_on_disk", "samples_in_memory"):
        assert spark.sql(f"SELECT count(*), max(wrist) FROM {view}").first() == (4, 1)


def test_nanosecond_lake(spark, at):
    import pandas as pd

    frame = sample_runs(spark).toPandas()
    frame["date"] = pd.to_datetime(frame["date"]).astype("datetime64[ns]")
    frame.to_parquet(at("lake.parquet"), index=False)
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for name in ("UTC", "America/Los_Angeles"):
            spark.conf.set("spark.sql.session.timeZone", name)
            runs = read_lake(spark, at("lake.parquet"))
            assert as_rows(marts.daily_user_summary(runs).select("date", "samples")) == [
                (D(2017, 7, 1), 2),
                (D(2017, 7, 2), 1),
                (D(2017, 7, 3), 1),
            ]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_timestamp_dates(spark):
    runs = sample_runs(spark).withColumn("date", F.col("date").cast("timestamp"))
    assert marts.daily_user_summary(runs).count() == 3
    assert roll_up(runs).columns[-1] == "event_month"


def test_partitions_of_a_build_hold_bounded_rows(spark, at, monkeypatch):
    """However many rows there are and however few partitions are set, no task sorts or aggregates many of them."""
    monkeypatch.setattr(session, "ROWS_A_TASK", 500)
    made = []
    monkeypatch.setattr(build, "write_rollup", lambda rolled, *how: made.append(rolled) or write_rollup(rolled, *how))
    monkeypatch.setattr(build, "write_marts", lambda rolled, *how: made.append(rolled) or write_marts(rolled, *how))
    settings = {"spark.sql.shuffle.partitions": "2", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1g", "spark.sql.adaptive.enabled": "false"}
    few = session.session_like(spark, **settings)
    runs = generated_runs(few, 10_000, users=100, days=30)
    runs.write.parquet(at("lake"))
    build_marts(few, at("lake"), at("marts"))
    rolled, stored = made
    sizes = [*rolled.rdd.glom().map(len).collect(), *marts.summary_of(stored).rdd.glom().map(len).collect()]
    assert len(sizes) == 40 and max(sizes) < 1_000
    for frame in made:
        assert frame.sparkSession.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == f"{32 << 20}b"
        assert frame.sparkSession.conf.get("spark.sql.adaptive.enabled") == "false"
    assert few.conf.get("spark.sql.shuffle.partitions") == "2"
    assert stored_mart(few, SUMMARY, at("marts")).count() == marts.daily_user_summary(runs).count()


def test_scans_of_a_build_take_bounded_rows(spark, at, monkeypatch):
    """Files that we write hold no more rows than a task should aggregate, however well these compress."""
    monkeypatch.setattr(tables, "ROWS_A_FILE", 700)
    events = generated_runs(spark, 3_000, users=5, days=2).selectExpr(
        "monotonically_increasing_id() AS event_id", "timestamp'2024-01-01 00:00:00' AS ts", "1L AS user_id",
        "'view' AS event_type", "1.0D AS value", """'{"k": 1}' AS props""",
    )
    events.coalesce(1).write.parquet(at("in", "events.parquet"))
    plain = exports.plain_lake(spark, at("in"))
    tables.write_table(runs_from_events(spark, at("in")).coalesce(1), at("table"), partition_by=["date"], rebalance=False)
    for path in (plain, at("table")):
        found = spark.read.parquet(path).groupBy("_metadata.file_path").count().collect()
        assert sum(r["count"] for r in found) == 3_000 and max(r["count"] for r in found) <= 700
    build_marts(spark, plain, at("marts"))
    assert [r["samples"] for r in stored_mart(spark, SUMMARY, at("marts")).collect()] == [3_000]
