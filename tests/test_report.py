import datetime as dt
import json
import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stridelake import label_codes, latest_summary, query, report, rows_as_dicts, run_batch
from stridelake.__main__ import main
from stridelake.operators import figures, marts
from stridelake.operators.selection import by_day_and_user, by_day_user_and_count, select_rows
from stridelake.plans.build import build_marts
from stridelake.plans.load import load_activity_counts, load_summary
from stridelake.plans.serve import iterate_dicts, latest_stored_summary, json_rows, write_json
from stridelake.schema import ACTIVITY_COUNTS, MART_SCHEMAS, SUMMARY
from stridelake.sources.sample import generated_runs, sample_runs

D = dt.date


@pytest.fixture(scope="module")
def sample(spark):
    runs = sample_runs(spark)
    return marts.daily_user_summary(runs).cache(), marts.daily_activity_counts(runs).cache()


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_labels(spark):
    df = spark.createDataFrame(
        [(0, 0, "u1"), (1, 1, "u2"), (2, 3, "u3"), (None, -1, "u4")], "activity bigint, wrist int, username string"
    )
    assert rows(label_codes(df)) == [
        ("walking", "left", "u1"),
        ("running", "right", "u2"),
        ("2", "3", "u3"),
        (None, "-1", "u4"),
    ]


def test_only_integer_columns_are_labelled(spark):
    df = spark.createDataFrame([(1.0, "1")], "activity double, wrist string")
    assert rows(label_codes(df)) == [(1.0, "1")]
    assert label_codes(df.select("wrist")).columns == ["wrist"]


def test_key_figures(sample):
    days, users, samples, mean = figures.key_figures(sample[0]).first()
    assert (days, users, samples) == (3, 1, 4)
    assert round(mean, 6) == 0.147328


def test_range_includes_both_ends(sample):
    for start, end in (("2017-07-01", "2017-07-02"), (D(2017, 7, 1), dt.datetime(2017, 7, 2, 9))):
        chosen = select_rows(sample[0], "All", start, end)
        assert figures.key_figures(chosen).select("days", "samples").first() == (2, 3)
    assert select_rows(sample[0], start="2017-07-03").count() == 1
    assert select_rows(sample[0], end="2017-07-01").count() == 1


def test_empty_selection(sample):
    assert rows(figures.key_figures(select_rows(sample[0], "nobody"))) == [(0, 0, 0, None)]
    assert rows(figures.share(select_rows(sample[1], "nobody"))) == []


def test_distribution_and_share(sample):
    assert sorted(rows(figures.distribution(sample[1]))) == [("running", 2), ("walking", 2)]
    assert sorted(rows(figures.share(sample[1]))) == [("running", 2, 0.5), ("walking", 2, 0.5)]


def test_distribution_drops_missing_and_keeps_unknown_codes(spark):
    counts = spark.createDataFrame([(0, 3), (7, 2), (None, 9), (0, 1)], "activity bigint, cnt bigint")
    assert sorted(rows(figures.distribution(counts))) == [("7", 2), ("walking", 4)]
    raw = counts.withColumn("activity", F.col("activity").cast("double"))
    assert sorted(rows(figures.distribution(raw))) == [(0.0, 4), (7.0, 2)]


def test_share_of_nothing(spark):
    counts = spark.createDataFrame([(0, 0)], "activity bigint, cnt bigint")
    assert rows(figures.share(counts)) == [("walking", 0, None)]


def test_missing_users_and_dates_are_not_counted(spark):
    summary = spark.createDataFrame(
        [(None, None, 1, 2.0), (D(2020, 1, 1), "b", 2, None), (D(2020, 1, 1), "a", 3, 4.0)],
        "date date, username string, samples bigint, avg_accel_magnitude double",
    )
    assert rows(figures.key_figures(summary)) == [(1, 2, 6, 3.0)]
    assert rows(figures.user_list(summary)) == [("a",), ("b",)]
    assert rows(figures.date_bounds(summary)) == [(D(2020, 1, 1), D(2020, 1, 1))]
    assert [r.username for r in by_day_and_user(summary).collect()] == ["a", "b", None]
    assert rows(figures.daily_series(summary, per_user=False)) == [(D(2020, 1, 1), 5), (None, 1)]


def test_count_order(spark):
    day = D(2020, 1, 1)
    counts = spark.createDataFrame(
        [(day, "u", 1, 5), (day, "u", 0, 5), (day, "u", 2, 9), (None, "u", 0, 1)], MART_SCHEMAS[ACTIVITY_COUNTS]
    )
    assert [r.activity for r in by_day_user_and_count(counts, "activity").collect()] == [2, 0, 1, 0]


def test_report(sample):
    tables = report(*sample, user="viktor", start="2017-07-01", end="2017-07-02")
    assert rows(tables["users"]) == [("viktor",)]
    assert rows(tables["bounds"]) == [(D(2017, 7, 1), D(2017, 7, 3))]
    assert rows(tables["figures"])[0][:3] == (2, 1, 3)
    assert rows(tables["series"]) == [(D(2017, 7, 1), "viktor", 2), (D(2017, 7, 2), "viktor", 1)]
    assert rows(tables["daily_total"]) == [(D(2017, 7, 1), 2), (D(2017, 7, 2), 1)]
    assert sorted(rows(tables["distribution"])) == [("running", 1), ("walking", 2)]
    assert {r[0]: round(r[2], 6) for r in rows(tables["share"])} == {"running": 0.333333, "walking": 0.666667}
    assert [tuple(r)[2:4] for r in tables["table"].collect()] == [("walking", "left"), ("walking", "left")]


def many_days(spark, n, users=1):
    days = [D(2020, 1, 1) + dt.timedelta(d) for d in range(n)]
    return spark.createDataFrame(
        [(d, f"u{u:03}", None, None, 1, 1.0, 1.0, 0.0, 0.0, 0.0) for d in days for u in range(users)],
        MART_SCHEMAS[SUMMARY],
    )


def test_latest_is_stable(spark):
    summary = many_days(spark, 3, users=70).orderBy(F.rand(1))
    got = [(r.date.day, r.username) for r in latest_summary(summary).collect()]
    assert got == [(3, f"u{u:03}") for u in range(70)] + [(2, f"u{u:03}") for u in range(30)]


def test_latest_of_few_rows_and_missing_dates(spark):
    few = many_days(spark, 2).union(
        spark.createDataFrame([(None, "x", None, None, 1, 1.0, 1.0, 0.0, 0.0, 0.0)], MART_SCHEMAS[SUMMARY])
    )
    assert [r.date and r.date.day for r in latest_summary(few).collect()] == [2, 1, None]
    assert [r.date.day for r in latest_summary(few, 1).collect()] == [2]
    assert latest_summary(few.limit(0)).isEmpty()


def test_latest_of_stored_marts_reads_the_newest_months(spark, at):
    generated_runs(spark, 4_000, users=8, days=400).write.parquet(at("lake"))
    build_marts(spark, at("lake"), at("marts"))
    summary = load_summary(spark, at("marts"))
    want = sorted(rows(summary.select("date", "username")), key=lambda r: (-r[0].toordinal(), r[1]))
    for n in (1, 100, 2_000, 10_000):
        latest = latest_stored_summary(spark, at("marts"), n)
        assert latest.columns == summary.columns and rows(latest.select("date", "username")) == want[:n]
    latest = latest_stored_summary(spark, at("marts"))
    months = {f.split("event_month=")[1][:7] for f in latest.inputFiles()}
    assert len(months) < 5 and max(months) == max(f.split("event_month=")[1][:7] for f in summary.inputFiles())
    plan = latest_summary(summary)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and plan.count("FileScan") == 1


def test_report_prunes_months(spark, at):
    generated_runs(spark, 2_000, users=4, days=200).write.parquet(at("lake"))
    build_marts(spark, at("lake"), at("marts"))
    summary = load_summary(spark, at("marts"), keep_month=True)
    counts = load_activity_counts(spark, at("marts"), keep_month=True)
    found = report(summary, counts, start="2017-08-20", end="2017-09-03")
    plain = report(load_summary(spark, at("marts")), load_activity_counts(spark, at("marts")), start="2017-08-20", end="2017-09-03")
    for name in ("figures", "series", "daily_total", "distribution", "share", "table"):
        assert found[name].columns == plain[name].columns and sorted(rows(found[name]), key=str) == sorted(rows(plain[name]), key=str)
        plan = found[name]._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(event_month" in plan, name


def test_query_over_runs_and_whole_results(spark, at):
    generated_runs(spark, 2_000, users=4, days=200).write.parquet(at("lake[1]"))
    build_marts(spark, at("lake[1]"), at("marts[1]"))
    runs = query(spark, "SELECT count(*) AS n FROM runs", at("marts[1]"), at("lake[1]"))
    assert rows_as_dicts(runs) == [{"n": 2_000}]
    everything = query(spark, "SELECT * FROM daily_user_summary", at("marts[1]"))
    assert len(rows_as_dicts(everything)) == everything.count() > 100
    assert len(rows_as_dicts(everything, 7)) == 7
    assert rows_as_dicts(query(spark, "SELECT count(*) AS n FROM runs", at("none"), at("lake[1]"))) == [{"n": 2_000}]


def test_query(spark, at):
    assert rows(query(spark, "SELECT 1", at("none"))) == []
    assert query(spark, "SELECT 1", at("none")).columns == []
    sample_runs(spark).write.parquet(at("lake"))
    build_marts(spark, at("lake"), at("marts"))
    found = query(spark, "SELECT date, samples FROM daily_user_summary ORDER BY date DESC LIMIT 2", at("marts"))
    assert rows_as_dicts(found) == [
        {"date": D(2017, 7, 3), "samples": 1},
        {"date": D(2017, 7, 2), "samples": 1},
    ]
    assert list(iterate_dicts(found)) == rows_as_dicts(found)
    both = query(
        spark,
        "SELECT count(*) AS n FROM daily_activity_counts JOIN daily_wrist_counts USING (date, username)",
        at("marts"),
    )
    assert rows(both) == [(6,)]
    with pytest.raises(Exception, match="no_such_table"):
        query(spark, "SELECT * FROM no_such_table", at("marts"))


def test_json(spark, at):
    schema = T.StructType([T.StructField("date", T.DateType()), T.StructField("v", T.DoubleType())])
    df = spark.createDataFrame([(D(2026, 1, 1), 0.12), (None, float("nan")), (None, math.inf)], schema)
    assert [json.loads(r.value) for r in json_rows(df.limit(2)).collect()] == [
        {"date": "2026-01-01", "v": 0.12},
        {},
    ]
    write_json(df.limit(1), at("out"))
    assert rows(spark.read.schema(schema).json(at("out"))) == [(D(2026, 1, 1), 0.12)]


def test_served_row(spark):
    served = spark.createDataFrame(
        [(D(2026, 1, 1), "alice", 10, 0.12)],
        "date date, username string, samples int, avg_accel_magnitude double",
    )
    assert json.loads(json_rows(latest_summary(served)).first().value) == {
        "date": "2026-01-01",
        "username": "alice",
        "samples": 10,
        "avg_accel_magnitude": 0.12,
    }


def write_sample_csv(spark, path):
    sample_runs(spark).coalesce(1).write.csv(path, header=True)


def test_batch_run(spark, at, tmp_path):
    with pytest.raises(FileNotFoundError):
        run_batch(spark, at("raw"), at("lake"), at("marts"))
    write_sample_csv(spark, at("raw"))
    run_batch(spark, at("raw"), at("lake"), at("marts"))
    assert load_summary(spark, at("marts")).count() == 3
    (tmp_path / "no-files").mkdir()
    # no raw files: the marts come from the lake that is there
    run_batch(spark, at("no-files"), at("lake"), at("marts-again"))
    assert load_summary(spark, at("marts-again")).count() == 3


def test_jobs(spark, at, capsys, tmp_path):
    write_sample_csv(spark, at("raw"))
    (tmp_path / "empty").mkdir()
    assert main(["ingest", "--raw-dir", at("empty"), "--lake", at("lake")]) == 0
    assert "No CSV files found" in capsys.readouterr().out
    assert main(["ingest", "--raw-dir", at("raw"), "--lake", at("lake"), "--multi-line", "no"]) == 0
    assert "4 rows" in capsys.readouterr().out
    assert main(["marts", "--lake", at("lake"), "--marts", at("marts")]) == 0
    assert main(["batch", "--raw-dir", at("raw"), "--lake", at("lake"), "--marts", at("marts")]) == 0
    assert main(["latest", "--marts", at("marts"), "--out", at("latest")]) == 0
    assert spark.read.json(at("latest")).count() == 3
    out = ["--out", at("report"), "--user", "viktor", "--start", "2017-07-02"]
    assert main(["report", "--marts", at("marts"), "--lake", at("lake"), *out]) == 0
    assert spark.read.json(at("report", "figures")).first().samples == 2
    incremental = ["--lake", at("lake2"), "--marts", at("marts2"), "--checkpoint", at("checkpoint")]
    assert main(["incremental", "--raw-dir", at("raw"), *incremental]) == 0
    assert "4 new rows" in capsys.readouterr().out
    with pytest.raises(SystemExit):
        main(["unknown"])


def test_day_range_reads_only_its_months(spark, at):
    generated_runs(spark, 2_000, users=4, days=200).write.parquet(at("lake"))
    build_marts(spark, at("lake"), at("marts"))
    whole, chosen = (
        load_summary(spark, at("marts"), **days) for days in ({}, {"start": "2017-08-20", "end": D(2017, 9, 3)})
    )
    assert sorted(rows(chosen)) == sorted(rows(select_rows(whole, start="2017-08-20", end="2017-09-03")))
    assert {f.split("event_month=")[1][:7] for f in whole.inputFiles()} > {"2017-08", "2017-09"}
    scan = chosen._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_month" in scan
    assert "PushedFilters: [IsNotNull(date), GreaterThanOrEqual(date,2017-08-20)" in scan
    # the same range over the lake, where the day is computed
    short = load_summary(spark, None, at("lake"), start="2017-08-20", end="2017-09-03")
    assert short.count() == chosen.count()
