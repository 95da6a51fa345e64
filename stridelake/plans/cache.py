"""Results of the loaders, kept while the marts stay as they are."""

from __future__ import annotations

import threading
from collections import OrderedDict
from collections.abc import Hashable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stridelake.sources.manifest import Manifest

# Makes a persisted plan one of the cache's own, so that loads without a cache still read storage.
_OWN = "__result_cache__"


class ResultCache:
    """Rows of loaded marts, by mart folder, version of the marts and filter.

    Up to ``max_driver_rows`` rows of a result are held on the driver. One that has more is persisted on the
    executors (memory, then their disks), and none of its rows come to the driver. A result that has more than
    ``max_rows`` rows is not kept but read from storage each time. What is held is bounded by these and
    ``max_entries``; the entry used longest ago leaves first. Entries go as soon as their marts have another version,
    so what is served is never older than the marts. ``clear`` lets go of all of them.
    """

    def __init__(self, max_entries: int = 16, max_rows: int = 100_000, max_driver_rows: int = 100_000):
        self.max_entries, self.max_rows, self.max_driver_rows = max_entries, max_rows, max_driver_rows
        self._kept: OrderedDict[tuple, tuple[int, tuple[pa.Table, T.StructType] | DataFrame]] = OrderedDict()
        self._lock = threading.Lock()

    def __len__(self) -> int:
        return len(self._kept)

    def find(
        self, manifest: Manifest, wanted: Hashable, spark: SparkSession | None = None
    ) -> tuple[pa.Table, T.StructType] | DataFrame | None:
        """Rows and their schema, or a frame over persisted rows if they are those of ``spark``."""
        with self._lock:
            root = manifest.root.rstrip("/")
            for key, (version, _) in list(self._kept.items()):
                if key[0] == root and version != manifest.version:
                    self._let_go(key)
            if (root, wanted) not in self._kept:
                return None
            self._kept.move_to_end((root, wanted))
            held = self._kept[root, wanted][1]
        if isinstance(held, DataFrame):
            return held.drop(_OWN) if held.sparkSession is spark else None
        return held

    def through(self, manifest: Manifest, wanted: Hashable, mart: DataFrame) -> DataFrame:
        """The rows of ``mart`` from now on held, or ``mart`` itself if they are too many."""
        rows = mart.count()
        if rows > self.max_rows:
            return mart
        if rows <= self.max_driver_rows:
            held = mart.toArrow(), mart.schema
        else:
            held = mart.withColumn(_OWN, F.lit(True)).persist()
            held.count()
        with self._lock:
            self._kept[manifest.root.rstrip("/"), wanted] = (manifest.version, held)
            while len(self._kept) > self.max_entries:
                self._let_go(next(iter(self._kept)))
        return held.drop(_OWN) if isinstance(held, DataFrame) else mart.sparkSession.createDataFrame(*held)

    def clear(self) -> None:
        with self._lock:
            for key in list(self._kept):
                self._let_go(key)

    def _let_go(self, key: tuple) -> None:
        _, held = self._kept.pop(key)
        if isinstance(held, DataFrame):  # frames already handed out read storage again
            held.unpersist()
