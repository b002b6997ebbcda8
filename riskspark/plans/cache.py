"""Per-application memo of shared intermediate results.

The cleaned table and fitted models are used by many queries of one
application; they are computed once per (application, data folder).
"""

from __future__ import annotations

import gc
import threading
from collections.abc import Callable
from typing import Any

from pyspark.sql import SparkSession

_LOCK = threading.RLock()
_MEMO: dict[tuple[str, str, str], Any] = {}
_BUILDING: dict[tuple[str, str, str], threading.RLock] = {}


def memoized(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], Any],
             dispose: Callable[[Any], None] | None = None) -> Any:
    """``build()`` once per application and folder; ``dispose`` undoes it in ``forget``.

    Builds of different names do not wait for each other.
    """
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), name)
    with _LOCK:
        own = _BUILDING.setdefault(key, threading.RLock())
    with own:
        if key not in _MEMO:
            _MEMO[key] = (build(), dispose)
        return _MEMO[key][0]


def forget(spark: SparkSession | None = None) -> None:
    """Drop what is memoized, with the cached blocks and files it made."""
    with _LOCK:
        app = spark.sparkContext.applicationId if spark else None
        gone = [_MEMO.pop(key) for key in [k for k in _MEMO if app in (None, k[0])]]
    for value, dispose in reversed(gone):
        if dispose and spark:
            dispose(value)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared file system."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(conf).delete(target, True)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner delete the shuffle files that nothing refers to any more.

    It does so when the driver collects its garbage, which is otherwise left
    to chance: the files of a finished step would stay beside the next one's.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
