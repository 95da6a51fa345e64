"""Records of CSV files whose quoted values may hold line breaks, read in ranges.

A line may begin inside a quoted value or not, and ends inside one or not; so it is a function from the state
before it to the state after it, one of four: keep, change, always outside, always inside. Functions of lines
compose to those of ranges, and those give the state in which each range of a file begins; from there it is
known for every line. A line that begins outside quotes begins a record. Lines that are whole records go on as
they are; the others are brought together by record, across ranges too.

A range is what the text scan gives to a task, so a large file takes as many tasks as one without line breaks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stridelake.sources.files import literal_path

# A quoted run up to its end, two quotes standing for one; a field; a quoted value that the line does not close.
_INSIDE = r'[^"]*+(?:""[^"]*+)*+'
_FIELD = rf'(?:"{_INSIDE}"[^,]*+|(?!")[^,]*+)'
_OPEN = rf'"{_INSIDE}\z'
_FROM_OUTSIDE = rf"^(?:{_FIELD},)*+{_OPEN}"
_FROM_INSIDE = rf'^{_INSIDE}(?:\z|"[^,]*+(?:,{_FIELD})*+,{_OPEN})'

# A function as two bits: the state after, coming from outside (low) and from inside (high); 1 is inside.
ALWAYS_OUTSIDE, CHANGE, KEEP, ALWAYS_INSIDE = 0, 1, 2, 3
_LINE_FUNCTION = f"""
CASE WHEN NOT contains(value, '"') THEN {KEEP}
     ELSE CASE WHEN value RLIKE r'{_FROM_OUTSIDE}' THEN 1 ELSE 0 END
        + CASE WHEN value RLIKE r'{_FROM_INSIDE}' THEN 2 ELSE 0 END END"""


def _after(function: str, state: str) -> str:
    return f"(shiftright({function}, {state}) & 1)"


def lines_of(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Rows (path, range, line, value, end): ``line`` orders the lines of a range, ``range`` is where it begins.

    A line ends with a line feed, a carriage return or both, which ``end`` has. The scan knows the first, which
    also divides ranges; the others are found in what lies between.
    """
    text = spark.read.option("lineSep", "\n").text([literal_path(p) for p in paths])
    pieces = F.when(F.contains("value", F.lit("\r")), F.split("value", "\r", -1)).otherwise(F.array("value"))
    text = text.select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("range"), pieces.alias("pieces")
    )
    found = text.select("*", F.posexplode("pieces").alias("k", "value")).where("k = 0 OR k < size(pieces) - 1 OR value <> ''")
    end = F.expr(
        r"""CASE WHEN k = size(pieces) - 1 THEN '\n'
                 WHEN k = size(pieces) - 2 AND element_at(pieces, -1) = '' THEN '\r\n' ELSE '\r' END"""
    )
    rows = found.select("path", "range", F.monotonically_increasing_id().alias("line"), "value", end.alias("end"))
    return rows.withColumn("function", F.expr(_LINE_FUNCTION))


_STEPS = f"""
aggregate(steps, {KEEP}, (f, s) -> {_after('s.function', '(f & 1)')} | shiftleft({_after('s.function', 'shiftright(f, 1)')}, 1))"""
# Whether a line of the range begins outside: the first one, or one after a line that ends outside.
_BEGINS = f"""
starts = 0 OR aggregate(steps, named_struct('state', starts, 'found', false), (a, s) ->
    named_struct('state', {_after('s.function', 'a.state')},
                 'found', a.found OR ({_after('s.function', 'a.state')} = 0 AND s.line < last_line)), a -> a.found)"""


def _with_state(rows: DataFrame, partition: str, order: str, first: str) -> DataFrame:
    """Adds ``state`` before each row, from the rows' functions and the state ``first`` before the first of them."""
    over = f"(PARTITION BY {partition} ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    changed = rows.withColumn("changes", F.expr(f"coalesce(sum(CASE WHEN function = {CHANGE} THEN 1 ELSE 0 END) OVER {over}, 0)"))
    fixed = f"CASE WHEN function IN ({ALWAYS_OUTSIDE}, {ALWAYS_INSIDE}) THEN struct(function & 1 AS state, changes) END"
    known = changed.withColumn("fixed", F.expr(f"last({fixed}, true) OVER {over}"))
    state = f"CAST((coalesce(fixed.state, {first}) + changes - coalesce(fixed.changes, 0)) % 2 AS INT)"
    return known.withColumn("state", F.expr(state)).drop("changes", "fixed")


def ranges_of(lines: DataFrame) -> DataFrame:
    """One row for each range: the state in which it begins, the range before it that holds the beginning of
    what it begins with, and the file's first line with text, if that is here.

    A range is known by its few lines whose function is not ``KEEP``; a file by its ranges.
    """
    step = F.expr(f"CASE WHEN function <> {KEEP} THEN struct(line, function) END")
    found = lines.groupBy("path", "range").agg(
        F.sort_array(F.collect_list(step)).alias("steps"),
        F.max("line").alias("last_line"),
        F.expr("min(CASE WHEN trim(translate(value, '\\uFEFF', '')) <> '' THEN line END) AS first_filled"),
    )
    found = _with_state(found.withColumn("function", F.expr(_STEPS)), "path", "range", "0").withColumnRenamed("state", "starts")
    found = found.withColumn("begins", F.expr(_BEGINS))
    before = "(PARTITION BY path ORDER BY range ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    return found.select(
        "path",
        "range",
        "starts",
        F.expr(f"last(CASE WHEN begins THEN range END, true) OVER {before}").alias("owner"),
        F.expr(f"CASE WHEN count(first_filled) OVER {before} = 0 THEN first_filled END").alias("header_line"),
    )


def records_of(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Rows (path, record), without headers and blank lines; a record holds its line breaks as they are in the file."""
    lines = lines_of(spark, paths)
    known = _with_state(lines.join(ranges_of(lines), ["path", "range"]), "path, range", "line", "starts")
    known = known.withColumn("begin", F.expr("CASE WHEN state = 0 THEN line END")).selectExpr(
        "*",
        "last(begin, true) OVER (PARTITION BY path, range ORDER BY line) AS own",
        "max(begin) OVER (PARTITION BY path, range) AS last_own",
        f"state = 0 AND {_after('function', 'state')} = 0 AS whole",
    )
    # The record that a range ends with may go on in the next ones; it has no line of its own here.
    known = known.selectExpr(
        "path",
        "value",
        "end",
        "whole",
        "struct(range, line) AS place",
        "coalesce(own = header_line, false) AS header",
        "CASE WHEN own IS NULL THEN owner ELSE range END AS of_range",
        "CASE WHEN own IS NULL OR own = last_own THEN NULL ELSE own END AS of_line",
    )
    single = known.where("whole AND NOT header").select("path", F.col("value").alias("record"))
    several = (
        known.where("NOT whole")
        .groupBy("path", "of_range", "of_line")
        .agg(F.bool_or("header").alias("header"), F.sort_array(F.collect_list(F.struct("place", "value", "end"))).alias("lines"))
        .where("NOT header")
        .select("path", F.array_join(F.transform("lines", lambda x: F.concat(x["value"], x["end"])), "").alias("record"))
        .select("path", F.regexp_replace("record", r"(\r\n|\r|\n)\z", "").alias("record"))
    )
    return single.unionAll(several).where("trim(record) <> ''")
