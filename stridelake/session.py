"""Session set-up and shared scratch space."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and benches; jobs on a cluster bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("stridelake")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def session_like(spark: SparkSession, **settings: str) -> SparkSession:
    """A session of the same application with the settings of ``spark``, and others on top; views are its own."""
    session = spark.newSession()
    for name, value in {**spark.conf.getAll, **settings}.items():
        if spark.conf.isModifiable(name):
            session.conf.set(name, value)
    return session


# Rows of a shuffle's partition, MB of a partition that adaptive execution joins or splits, and MB of a file's range. The
# last is small as rows of Parquet files can be a few bytes each.
ROWS_A_TASK = 250_000
_MB_A_TASK = 32
_MB_A_RANGE = 8


def sized_session(spark: SparkSession, rows: int) -> SparkSession:
    """A session like ``spark`` for jobs over so many rows: with more rows come more tasks, not larger ones, whatever
    the number of shuffle partitions and the sizes set are. Adaptive execution joins partitions that turn out small."""
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // ROWS_A_TASK))
    in_bytes = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    sizes = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": _MB_A_TASK,
        "spark.sql.files.maxPartitionBytes": _MB_A_RANGE,
    }
    most = {name: f"{min(in_bytes(spark.conf.get(name)), mb << 20)}b" for name, mb in sizes.items()}
    return session_like(spark, **{"spark.sql.shuffle.partitions": str(partitions)}, **most)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the folder all executors share (``spark.checkpoint.dir``)."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="stridelake-")
    return f"{base.rstrip('/')}/stridelake-{label}-{uuid.uuid4().hex}"
