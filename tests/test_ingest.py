import math
import os

import pandas as pd
import pytest

from stridelake.plans.ingest import ingest
from stridelake.sources.csv_folder import (
    column_names,
    files_with_open_quotes,
    first_record,
    header_groups,
    read_csv_files,
    read_headers,
)
from stridelake.sources.files import list_csv_files
from stridelake.sources.lake import read_lake


@pytest.fixture
def folder(tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()

    def make(**files):
        for name, text in files.items():
            (raw / name.replace("__", ".")).write_bytes(text if isinstance(text, bytes) else text.encode())
        return str(raw)

    return make


def paths_in(spark, raw):
    return [e.path for e in list_csv_files(spark, raw)]


def lake_rows(spark, path):
    return sorted((r.asDict() for r in read_lake(spark, path).collect()), key=str)


def test_two_files(spark, folder, at):
    raw = folder(a__csv="x,y\n1,2\n3,4\n", b__csv="x,y\n5,6\n")
    assert ingest(spark, raw, at("lake")) == 3
    lake = read_lake(spark, at("lake"))
    assert [(f.name, f.dataType.simpleString()) for f in lake.schema] == [("x", "bigint"), ("y", "bigint")]
    assert sorted(map(tuple, lake.collect())) == [(1, 2), (3, 4), (5, 6)]


def test_no_files_writes_nothing(spark, folder, at):
    raw = folder(readme__txt="no data")
    assert ingest(spark, raw, at("lake")) == 0
    assert ingest(spark, at("absent"), at("lake")) == 0
    assert not os.path.exists(at("lake"))


def test_union_by_name_missing_tokens_and_types(spark, folder, at):
    raw = folder(
        a__csv="date,time,activity,ax\n2017-6-30,13:51:15:847724020,0,0.5\n"
        "2017-6-30,13:51:16:246945023,1,NaN\n2017-7-1,1:1:1,,NA\n",
        b__csv="ax,date,activity,extra\n0.25,2017-7-2,1,z\n",
        c__csv="date,time,activity,ax\n",
    )
    assert ingest(spark, raw, at("lake")) == 4
    lake = read_lake(spark, at("lake"))
    kinds = {f.name: f.dataType.simpleString() for f in lake.schema}
    assert kinds == {
        "date": "string",
        "time": "string",
        "activity": "bigint",
        "ax": "double",
        "extra": "string",
        "event_date": "date",
    }
    rows = [(r.date, r.time, r.activity, r.ax, r.extra, str(r.event_date)) for r in lake.collect()]
    assert sorted(rows, key=str) == [
        ("2017-6-30", "13:51:15:847724020", 0, 0.5, None, "2017-06-30"),
        ("2017-6-30", "13:51:16:246945023", 1, None, None, "2017-06-30"),
        ("2017-7-1", "1:1:1", None, None, None, "2017-07-01"),
        ("2017-7-2", None, 1, 0.25, "z", "2017-07-02"),
    ]


TRICKY = {
    "plain": "a,b\n1,x\n2,y\n",
    "quoted_commas": 'a,b\n1,"x, y"\n2,"z"\n',
    "doubled_quotes": 'a,b\n1,"say ""hi"", twice"\n2,""\n',
    "line_break": 'a,b\n1,"first\nsecond"\n2,"x"\n',
    "break_in_last": 'a,b\n1,"end\n"\n2,y\n',
    "crossing_commas": 'a,b,c\n1,2,"p\nx,y,z"\n3,4,q\n',
    "stray_quote": 'a,b\n1,5" pipe\n2,7" pipe\n',
    "blank_lines": "\n  \na,b\n\n1,x\n   \n2,y\n\n",
    "crlf": "a,b\r\n1,x\r\n2,y\r\n",
    "short_rows": "a,b,c\n1,x\n2,y,0.5\n",
    "repeated_names": "x,x,,x\n1,2,3,4\n",
    "repeat_taken": "x,x.1,x\n1,2,3\n",
    "tokens": "a,b\nNA,n/a\nnull,None\n1,<NA>\n",
    "all_missing": "a,b\n,NA\n,\n",
    "booleans": "a,b\nTrue,true\nFalse,\n",
    "floats": "a,b\n1,1e3\n2.5,.5\n-inf,1.\n",
    "signed": "a,b\n+1,-1\n 2, 3\n",
    "long_digits": "a,b\n123456789012345678901234567890,1\n1,2\n",
    "letter_suffix": "a,b\n1d,1f\n2d,2f\n",
    "quoted_header": '"a","b, c"\n1,2\n',
    "bom": b"\xef\xbb\xbfa,b\n1,x\n",
    "no_final_newline": "a,b\n1,x\n2,y",
    "data_like_header": "a,b\na,b\n1,x\n",
    "dotted": "a.b,c`d\n1,2\n",
    "unicode": "näme,b\nzoë,1\n",
}


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)) or value is pd.NA:
        return None
    return value.item() if hasattr(value, "item") else value


@pytest.mark.parametrize("case", TRICKY)
def test_same_as_pandas(spark, folder, at, case):
    raw = folder(t__csv=TRICKY[case])
    expected = pd.read_csv(os.path.join(raw, "t.csv"))
    rows = ingest(spark, raw, at("lake"))
    lake = read_lake(spark, at("lake"))
    assert rows == len(expected)
    assert lake.columns == list(expected.columns)
    got = sorted((tuple(r) for r in lake.collect()), key=str)
    want = sorted((tuple(_plain(v) for v in r) for r in expected.itertuples(index=False)), key=str)
    assert got == want
    for field, dtype in zip(lake.schema, expected.dtypes):
        if pd.api.types.is_bool_dtype(dtype):
            assert field.dataType.simpleString() == "boolean"
        elif pd.api.types.is_integer_dtype(dtype):
            assert field.dataType.simpleString() == "bigint"


def test_several_headers_same_as_pandas(spark, folder, at):
    raw = folder(
        a__csv="date,username,wrist,v\n2020-1-1,u,0,1\n",
        b__csv='v,username,date,note\n2.5,w,2020-1-2,"two\nlines, and ""quotes"""\n',
        c__csv="date,username,wrist,v\n2020-1-3,,1,\n",
    )
    files = sorted(os.path.join(raw, n) for n in os.listdir(raw))
    expected = pd.concat([pd.read_csv(f) for f in files], ignore_index=True)
    ingest(spark, raw, at("lake"))
    lake = read_lake(spark, at("lake")).drop("event_date")
    assert lake.columns == list(expected.columns)
    want = sorted((tuple(_plain(v) for v in r) for r in expected.itertuples(index=False)), key=str)
    assert sorted((tuple(r) for r in lake.collect()), key=str) == [
        tuple(int(v) if n == "wrist" and v is not None else v for n, v in zip(lake.columns, row)) for row in want
    ]


def test_only_files_that_need_it_are_read_whole(spark, folder):
    raw = folder(a__csv='x,y\n1,"a, b"\n', b__csv='x,y\n1,"a\nb"\n', c__csv="x,y\n1,2\n")
    groups = header_groups(spark, paths_in(spark, raw))
    assert [(g.multi_line, [p[-5:] for p in g.paths]) for g in groups] == [
        (False, ["a.csv", "c.csv"]),
        (True, ["b.csv"]),
    ]
    groups = header_groups(spark, paths_in(spark, raw), multi_line=True)
    assert [g.multi_line for g in groups] == [True]


def test_open_quote_rule(spark, folder):
    closed = ['a,"b""c",d', '"",x', '"a","b"', "a,b", '"a,b"', '""""']
    open_ = ['a,"b', 'b",c', 'a"b,"x', '""x', '"a"b']
    files = {f"f{i}__csv": f"x,y\n{line}\n" for i, line in enumerate([*closed, *open_])}
    raw = folder(**files)
    names = {int(p.rsplit("/f", 1)[1][:-4]) for p in files_with_open_quotes(spark, paths_in(spark, raw))}
    assert names == set(range(len(closed), len(closed) + len(open_)))


def test_header_names():
    assert column_names("x,x,,x") == ("x", "x.1", "Unnamed: 2", "x.2")
    assert column_names('"a, b",c') == ("a, b", "c")


def test_first_record():
    assert first_record("\n \r\na,b\r\n1", whole=False) == "a,b"
    assert first_record("a,b", whole=False) is None
    assert first_record("a,b", whole=True) == "a,b"
    assert first_record('"a\n', whole=False) is None
    assert first_record('"a\nb",c\n1', whole=False) == '"a\nb",c'
    assert first_record(" \n\n", whole=True) is None


def test_headers_of_many_files(spark, folder):
    texts = {
        "a": "x,y\n1,2\n",
        "b": "\n \t\nx,y\n3,4\n",
        "c": b"\xef\xbb\xbfx,y\n",
        "d": "y,x\r\nx,y\r\n",
        "e": '"x\none",y\n1,2\n',
        "f": '"x\ntwo",y\n1,2\n',
        "g": "x,y",
    }
    raw = folder(**{f"{name}__csv": text for name, text in texts.items()})
    paths = paths_in(spark, raw)
    opened = read_headers(spark, paths)
    assert [opened[p] for p in paths] == ["x,y", "x,y", "x,y", "y,x", '"x\none",y', '"x\ntwo",y', "x,y"]


def test_header_longer_than_the_first_read(spark, folder, at):
    names = [f"column_{i}_{'x' * 40}" for i in range(1500)]
    raw = folder(a__csv=",".join(names) + "\n" + ",".join("1" * 1500) + "\n")
    assert column_names(read_headers(spark, paths_in(spark, raw))[paths_in(spark, raw)[0]]) == tuple(names)


def test_header_over_two_lines(spark, folder, at):
    raw = folder(a__csv='"two\nlines",y\n1,2\n')
    assert list(read_headers(spark, paths_in(spark, raw)).values()) == ['"two\nlines",y']
    assert ingest(spark, raw, at("lake")) == 1
    assert read_lake(spark, at("lake")).columns == ["two\nlines", "y"]


def test_names_with_special_characters(spark, folder, at):
    raw = folder(**{"a[1] b%20*{c}__csv": "x\n1\n", "ordinary__csv": "x\n2\n"})
    assert ingest(spark, raw, at("lake")) == 2


def test_refused_files(spark, folder, at):
    raw = folder(a__csv="x\n1\n")
    for name, text, message in (
        ("_b.csv", "x\n1\n", "rename"),
        ("empty.csv", "", "is empty"),
        ("blank.csv", "\n \n", "no header line"),
    ):
        path = os.path.join(raw, name)
        with open(path, "w") as f:
            f.write(text)
        with pytest.raises(ValueError, match=message):
            ingest(spark, raw, at("lake"))
        os.remove(path)
    os.mkdir(os.path.join(raw, "sub.csv"))
    with pytest.raises(ValueError, match="folder"):
        ingest(spark, raw, at("lake"))
    assert not os.path.exists(at("lake"))


def test_dot_files_and_sub_folders_are_left_out(spark, folder, at):
    raw = folder(a__csv="x\n1\n")
    for path in (".hidden.csv", "x=1/b.csv", "deep/c.csv"):
        os.makedirs(os.path.dirname(os.path.join(raw, path)), exist_ok=True)
        with open(os.path.join(raw, path), "w") as f:
            f.write("x\n9\n")
    assert ingest(spark, raw, at("lake")) == 1


def test_too_many_fields_fail_and_keep_the_old_lake(spark, folder, at):
    raw = folder(a__csv="x,y\n1,2\n")
    ingest(spark, raw, at("lake"))
    folder(a__csv='x,y\n1,2\n3,4,"5"\n')
    with pytest.raises(Exception, match="more fields than its header"):
        ingest(spark, raw, at("lake"))
    assert lake_rows(spark, at("lake")) == [{"x": 1, "y": 2}]
    assert os.listdir(os.path.dirname(at("lake"))).count("lake") == 1
    assert not [n for n in os.listdir(os.path.dirname(at("lake"))) if "staging" in n or "retired" in n]


def test_case_twins(spark, folder, at):
    raw = folder(a__csv="x,X\n1,2\n")
    with pytest.raises(ValueError, match="differ only by case"):
        ingest(spark, raw, at("lake"))


def test_bad_dates(spark, folder, at):
    raw = folder(a__csv="date,username\n2020-1-1,u\nsoon,u\n")
    with pytest.raises(Exception, match="unreadable date: soon"):
        ingest(spark, raw, at("lake"))
    assert ingest(spark, raw, at("lake"), on_bad_date="null") == 2
    days = [(r["date"], r["event_date"]) for r in lake_rows(spark, at("lake"))]
    assert ("soon", None) in days and len(days) == 2
    with pytest.raises(ValueError, match="on_bad_date"):
        ingest(spark, raw, at("lake"), on_bad_date="skip")


@pytest.mark.parametrize(
    ("values", "kind", "expected"),
    [
        (["0", "", "1"], "bigint", [None, 0, 1]),
        (["0", "1.5", ""], "double", [None, 0.0, 1.5]),
        (["run", "1", ""], "string", [None, "1", "run"]),
    ],
)
def test_codes_take_the_type_they_need(spark, folder, at, values, kind, expected):
    raw = folder(a__csv="date,activity\n" + "".join(f"2020-1-1,{v}\n" for v in values))
    assert ingest(spark, raw, at("lake")) == 3
    lake = read_lake(spark, at("lake"))
    assert lake.schema["activity"].dataType.simpleString() == kind
    assert sorted((r.activity for r in lake.collect()), key=lambda v: (v is not None, str(v))) == expected


def test_text_in_one_file_numbers_in_another(spark, folder, at):
    raw = folder(a__csv="k\n1\n", b__csv="k\nabc\n")
    assert ingest(spark, raw, at("lake")) == 2
    assert sorted(r.k for r in read_lake(spark, at("lake")).collect()) == ["1", "abc"]


def test_header_only_files(spark, folder, at):
    raw = folder(a__csv="date,username,activity\n")
    assert ingest(spark, raw, at("lake")) == 0
    lake = read_lake(spark, at("lake"))
    assert lake.columns == ["date", "username", "activity", "event_date"]
    assert lake.isEmpty()


def test_reserved_column(spark, folder, at):
    raw = folder(a__csv="date,event_date\n2020-1-1,x\n")
    with pytest.raises(ValueError, match="reserved"):
        ingest(spark, raw, at("lake"))


def test_without_rebalance_gives_the_same_rows(spark, folder, at):
    raw = folder(a__csv="date,x\n2020-1-1,1\n2020-1-2,2\n", b__csv="date,x\n2020-1-1,3\n")
    ingest(spark, raw, at("one"))
    ingest(spark, raw, at("two"), rebalance=False)
    assert lake_rows(spark, at("one")) == lake_rows(spark, at("two"))


def test_file_that_arrives_while_reading(spark, folder, monkeypatch):
    raw = folder(a__csv="x,y\n1,2\n", b__csv="x,y\n3,4\n")
    paths = paths_in(spark, raw)
    assert read_csv_files(spark, paths, folder=raw).count() == 2
    folder(c__csv="y,x\n5,6\n")  # not listed, other header
    late = read_csv_files(spark, paths, folder=raw)
    assert sorted((r.x, r.y) for r in late.collect()) == [("1", "2"), ("3", "4")]


def test_hot_day_is_written_by_several_tasks(spark, tmp_path, at):
    raw = tmp_path / "raw"
    raw.mkdir()
    for part in range(6):
        with open(raw / f"{part}.csv", "w") as f:
            f.write("date,username,v\n")
            f.writelines(f"2020-1-{1 if i % 3 else 1 + i % 28},u{i * 7919 % 1000003},{i}\n" for i in range(20_000))
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, str(1 << 18))
    try:
        assert ingest(spark, str(raw), at("lake")) == 120_000
    finally:
        spark.conf.set(key, before)
    days = [d for d in os.listdir(at("lake")) if "=" in d]
    files = {d: sum(n.endswith("parquet") for n in os.listdir(at("lake", d))) for d in days}
    assert files.pop("event_date=2020-01-01") > 2
    # days that share the hot day's shuffle partition are split with it; the others are not
    assert sorted(files.values())[len(files) // 2] == 1
    assert read_lake(spark, at("lake")).count() == 120_000


def test_splittable_read_of_one_large_file(spark, tmp_path):
    path = tmp_path / "large.csv"
    with open(path, "w") as f:
        f.write("x,y\n")
        f.writelines(f"{i},{i % 7}\n" for i in range(300_000))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 18))
    try:
        rows = read_csv_files(spark, paths_in(spark, str(tmp_path)))
        assert rows.rdd.getNumPartitions() > 4
        assert rows.selectExpr("sum(CAST(x AS BIGINT))").first()[0] == sum(range(300_000))
        assert rows.count() == 300_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("n", [2, 620])
def test_few_and_many_files_are_read_alike(spark, folder, at, n):
    texts = {f"f{i}__csv": ("\x0c\nx,y\n1,2\n" if i % 2 else "\x0c\ny,x\n10,20\n") for i in range(n)}
    assert ingest(spark, folder(**texts), at("lake")) == n
    counts = {(r.x, r.y): r["count"] for r in read_lake(spark, at("lake")).groupBy("x", "y").count().collect()}
    assert counts == {(1, 2): n // 2, (20, 10): n // 2}


def test_glob_characters_in_folder_names(spark, tmp_path, at):
    raw = tmp_path / "raw[1]"
    raw.mkdir()
    (raw / "a.csv").write_text("x,y\n1,2\n")
    assert ingest(spark, str(raw), at("lake{1}")) == 1
    assert read_lake(spark, at("lake{1}")).count() == 1


@pytest.mark.parametrize("text", ["2017-6", "2017", "2017/6", "2017-6/30", "6/30/2017x", "20170630"])
def test_half_dates_are_not_dates(spark, folder, at, text):
    raw = folder(a__csv=f"date,x\n{text},1\n")
    with pytest.raises(Exception, match="unreadable date"):
        ingest(spark, raw, at("lake"))
    ingest(spark, raw, at("lake"), on_bad_date="null")
    assert [r.event_date for r in read_lake(spark, at("lake")).collect()] == [None]


@pytest.mark.parametrize("text", ["2017/6/30", "2017-6-30", "2017-06-30", " 2017/06/30", "2017-06-30 12:00:00"])
def test_dates(spark, folder, at, text):
    ingest(spark, folder(a__csv=f"date,x\n{text},1\n"), at("lake"))
    assert [str(r.event_date) for r in read_lake(spark, at("lake")).collect()] == ["2017-06-30"]
