"""CSV folder to lake."""

from __future__ import annotations

import logging

from pyspark.sql import SparkSession

from stridelake.functions.inference import infer_types
from stridelake.sources.csv_folder import read_csv_files
from stridelake.sources.files import is_flat, list_csv_files, write_swapped
from stridelake.sources.lake import Misfit, column_types, write_lake

log = logging.getLogger(__name__)


def ingest(
    spark: SparkSession,
    raw_dir: str,
    lake_path: str,
    *,
    multi_line: bool | None = None,
    on_bad_date: str = "error",
    rebalance: bool = True,
) -> int:
    """Replace the lake by the rows of all CSV files directly in ``raw_dir``.

    Returns the number of rows; without CSV files it returns 0 and leaves the lake alone.
    Sensor columns are written with their declared types. If the data does not fit, the
    columns concerned are typed from the data and written again; the new lake is
    swapped in only once it is whole.
    """
    paths = [e.path for e in list_csv_files(spark, raw_dir)]
    log.info("found %d CSV files in %s", len(paths), raw_dir)
    if not paths:
        log.warning("No CSV files found in %s", raw_dir)
        return 0
    raw = read_csv_files(spark, paths, multi_line, raw_dir if is_flat(spark, raw_dir) else None)
    types = column_types(raw)

    def write(staging: str) -> int:
        try:
            return write_lake(raw, staging, types, on_bad_date=on_bad_date, rebalance=rebalance)
        except Misfit as e:
            types.update(infer_types(raw, e.names))
            return write_lake(raw, staging, types, on_bad_date=on_bad_date, rebalance=rebalance)

    rows = write_swapped(spark, {lake_path: write})[lake_path]
    log.info("wrote %d rows to %s", rows, lake_path)
    return rows
