"""Indexes that several registered queries read: built once per session and state of the source files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import SparkSession

_BUILT: dict[tuple, object] = {}


def files_state(spark: SparkSession, path: str) -> tuple:
    """(path, bytes, modification time) of the files of a table."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    it = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(root, True)
    out = []
    while it.hasNext():
        s = it.next()
        out.append((s.getPath().toString(), s.getLen(), s.getModificationTime()))
    return tuple(sorted(out))


def shared(spark: SparkSession, sf_dir: str, tables: list[str], settings: tuple, build: Callable[[], object]):
    """What ``build`` returned for these settings and this state of the tables; an index that it wrote is read, not built, again
    as long as its folder (its ``path``, or itself if a string) is there."""
    state = tuple(files_state(spark, f"{sf_dir.rstrip('/')}/{t}.parquet") for t in tables)
    key = (spark.sparkContext.applicationId, state, settings)
    if key not in _BUILT or not _there(spark, _BUILT[key]):
        _BUILT[key] = build()
    return _BUILT[key]


def _there(spark: SparkSession, built: object) -> bool:
    path = built if isinstance(built, str) else getattr(built, "path", None)
    if path is None:
        return True
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)
