import pandas as pd
from pyspark.sql import functions as F

from stridelake.llm.shared import bounded, free_name, labelled_rows, learnt_rows, slices


def test_slices_keep_order_and_bounds():
    texts = ["a" * 5, None, "b" * 30, "", "c" * 9, "d", "e", "f"]
    got = [list(s) for s in slices(iter([pd.Series(texts, dtype=object), pd.Series([], dtype=object)]), rows=3, characters=10)]
    assert [t for s in got for t in s] == texts
    assert all(len(s) == 1 or sum(len(t or "") for t in s) <= 10 and len(s) <= 3 for s in got)


def test_free_name(spark):
    assert free_name(spark.createDataFrame([(1, 2)], "Score int, score_ int"), "score") == "score__"


def test_bound_only_ever_falls(spark):
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(setting)
    try:
        spark.conf.set(setting, "64m")
        bounded(spark.range(1))
        assert spark.conf.get(setting) == str(8 << 20)
        spark.conf.set(setting, "1m")
        bounded(spark.range(1))
        assert spark.conf.get(setting) == "1m"
    finally:
        spark.conf.set(setting, before)


def test_samples_are_bounded_spread_and_stable(spark):
    docs = spark.range(4_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), "id").alias("text"))
    docs = docs.unionByName(spark.range(3_000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("t7").alias("text")))
    labels = spark.range(4_000).select(F.col("id").alias("doc_id"), (F.col("id") % 10 == 0).cast("int").alias("quality"))
    rows, counts = labelled_rows(docs, labels, "quality", F.lit(True), 200)
    assert counts == {0: 3_600, 1: 400} and len(rows) == len(set(rows))
    ones = sum(t for _, t in rows)
    assert 150 < ones < 250 and 150 < len(rows) - ones < 260
    assert labelled_rows(docs.repartition(5), labels, "quality", F.lit(True), 200)[0] == rows
    few, _ = learnt_rows(docs.withColumn("target", F.lit("x")).where("doc_id < 50 AND doc_id <> 7"), 1_000)
    assert len(few) == 49
