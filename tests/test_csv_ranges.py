"""Files with line breaks in values, read in ranges: the rows that pandas reads."""

import random

import pandas as pd
import pytest

from stridelake.plans.ingest import ingest
from stridelake.sources.csv_folder import files_with_open_quotes, header_groups, read_csv_files
from stridelake.sources.csv_records import lines_of, ranges_of
from stridelake.sources.files import list_csv_files

SPLIT = "spark.sql.files.maxPartitionBytes"


@pytest.fixture
def in_ranges(spark):
    """Ranges of so many bytes."""

    def of(size):
        spark.conf.set(SPLIT, str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")

    yield of
    spark.conf.unset(SPLIT)
    spark.conf.unset("spark.sql.files.openCostInBytes")


def value(rng):
    plain = "".join(rng.choices(["a", "é", "1", " ", "-", "'"], k=rng.randrange(5)))
    kind = rng.random()
    if kind < 0.5:
        return plain
    inner = "".join(rng.choices(["a", ",", "\n", '""', "b\n\nc", '"",\n""', " ", "ü", "\r\n", "\r"], k=rng.randrange(6)))
    return f'"{inner}"'


def text_of(rng, rows, end="\n", columns=4):
    lines = [",".join(f"c{k}" for k in range(columns)) if rng.random() < 0.8 else 'c0,"c1",c2,"c\n3"']
    for _ in range(rows):
        lines.append(",".join([f"r{rng.randrange(10**6)}", *(value(rng) for _ in range(columns - 1))]))
        if rng.random() < 0.1:
            lines.append(rng.choice(["", "  "]))
    return (2 * end if rng.random() < 0.3 else "") + end.join(lines) + (end if rng.random() < 0.7 else "")


def shown(frame):
    return sorted((tuple(None if pd.isna(v) or v == "" else v for v in row) for row in frame.itertuples(index=False)), key=str)


def read(spark, raw, multi_line=None):
    paths = [e.path for e in list_csv_files(spark, raw)]
    return read_csv_files(spark, paths, multi_line).toPandas()


@pytest.mark.parametrize("size", (37, 200, 1500))
def test_like_pandas(spark, tmp_path, in_ranges, size):
    rng = random.Random(size)
    raw = tmp_path / "raw"
    raw.mkdir()
    want = []
    for k in range(6):
        end = {3: "\r", 4: "\r\n"}.get(k, "\n")
        text = ("﻿" if k == 5 else "") + text_of(rng, rng.randrange(1, 60), end)
        (raw / f"f{k} +.csv").write_bytes(text.encode())
        frame = pd.read_csv(raw / f"f{k} +.csv", dtype=str, keep_default_na=False)
        want += shown(frame.set_axis([c.replace("\n", " ") for c in frame.columns], axis=1))
    in_ranges(size)
    got = read(spark, str(raw)).drop(columns="__too_long__")
    united = shown(got)

    def filled(row):  # files name their last column differently
        return tuple(v for v in row if v is not None)

    assert sorted(map(filled, united), key=str) == sorted(map(filled, want), key=str)
    in_ranges(1 << 27)  # some of the files go to Spark's own reader now
    assert shown(read(spark, str(raw)).drop(columns="__too_long__")) == united


def test_stray_quotes_and_long_lines(spark, tmp_path, in_ranges):
    raw = tmp_path / "raw"
    raw.mkdir()
    text = 'a,b\n5" pipe,x\n"one\ntwo",y"\n"he said ""a"",\n\n""b""",z\n"",\n' + f'"{"long " * 20_000}\n{"more," * 20_000}",w\n' + "k,l\n" * 50
    text += '"' + '""\n' * 300 + '",m\n' + ",".join(['"q"'] * 2) + "\n"
    (raw / "a.csv").write_text(text)
    want = shown(pd.read_csv(raw / "a.csv", dtype=str, keep_default_na=False))
    for size in (64, 5_000):
        in_ranges(size)
        assert shown(read(spark, str(raw)).drop(columns="__too_long__")) == want
        assert shown(read(spark, str(raw), True).drop(columns="__too_long__")) == want


def test_rows_with_too_many_fields(spark, tmp_path, at, in_ranges):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "a.csv").write_text('x,y\n1,"2\n"\n3,4,"5\n6"\n7\n')
    in_ranges(8)
    frame = read(spark, str(raw))
    assert frame.sort_values("x")["__too_long__"].tolist() == [False, True, False]
    with pytest.raises(Exception, match="more fields than its header"):
        ingest(spark, str(raw), at("lake"))


def test_as_many_tasks_as_without_line_breaks(spark, tmp_path, in_ranges):
    raw = tmp_path / "raw"
    raw.mkdir()
    row = "some text to fill the row with, and again"
    for name, text in (("plain", f'"{row}",1\n'), ("broken", f'"{row[:20]}\n{row[21:]}",1\n')):
        (raw / f"{name}.csv").write_text("a,b\n" + text * 20_000)
    in_ranges(64_000)
    paths = [e.path for e in list_csv_files(spark, str(raw))]
    assert {p.rsplit("/")[-1] for p in files_with_open_quotes(spark, paths)} == {"broken.csv"}
    groups = {g.paths[0].rsplit("/")[-1]: g for g in header_groups(spark, paths)}
    assert groups["broken.csv"].multi_line and not groups["plain.csv"].multi_line
    broken, plain = (lines_of(spark, [p]) for p in paths)
    assert broken.rdd.getNumPartitions() == plain.rdd.getNumPartitions() > 10
    assert ranges_of(broken).count() >= broken.rdd.getNumPartitions()
    assert read_csv_files(spark, paths[:1]).where("b = 1").count() == 20_000
    # every second line begins inside a value, and so do about half of the ranges
    assert ranges_of(broken).where("starts = 1").count() > 3
