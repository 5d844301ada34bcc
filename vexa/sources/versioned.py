"""Atomic publish for plain Parquet tables: version directories + commit markers.

Layout under ``root``::

    root/v-000001/part-*.parquet
    root/v-000002/...
    root/_commits/v-000001      (empty marker files, created once, never rewritten)
    root/_commits/v-000002

A writer writes the full new version directory, then creates its commit
marker with ``overwrite=False`` (put-if-absent).  The current version is
the highest committed marker, resolved once per read, so a reader sees
either the old or the new version, never a mix, and a version whose write
died before its marker is invisible.  Two writers racing for the same
version number cannot both commit it; one writer at a time is the
documented use.  All file access goes through the Hadoop FileSystem of
the session, so the folder can be on any shared store.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

COMMITS = "_commits"


class SchemaViolation(ValueError):
    """Rows to be published break the table's declared schema."""


class VersionedTable:
    """With ``declared`` every published version is held against the schema (``schema.validate``, strict)."""

    def __init__(self, spark: SparkSession, root: str, declared: T.StructType | None = None):
        self.spark, self.declared = spark, declared
        self.root = root.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._Path = jvm.org.apache.hadoop.fs.Path
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._Path(self.root).getFileSystem(conf)

    # -- commit markers ------------------------------------------------------
    def _committed(self) -> list[str]:
        d = self._Path(f"{self.root}/{COMMITS}")
        if not self._fs.exists(d):
            return []
        return sorted(st.getPath().getName() for st in self._fs.listStatus(d)
                      if st.getPath().getName().startswith("v-"))

    def current(self) -> str | None:
        c = self._committed()
        return c[-1] if c else None

    def _commit(self, version: str) -> None:
        out = self._fs.create(self._Path(f"{self.root}/{COMMITS}/{version}"), False)  # fails if present
        out.close()

    def versions(self) -> list[str]:
        root = self._Path(self.root)
        if not self._fs.exists(root):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(root)
                      if s.isDirectory() and s.getPath().getName().startswith("v-"))

    # -- read / write --------------------------------------------------------
    def read(self, version: str | None = None) -> DataFrame:
        v = version or self.current()
        if v is None:
            raise FileNotFoundError(f"no version published under {self.root}")
        return self.spark.read.parquet(f"{self.root}/{v}")

    def publish(self, df: DataFrame, max_records_per_file: int | None = None) -> str:
        vs = self.versions()
        nxt = f"v-{(int(vs[-1][2:]) + 1) if vs else 1:06d}"
        w = df.write.mode("errorifexists")
        if max_records_per_file:
            w = w.option("maxRecordsPerFile", max_records_per_file)
        w.parquet(f"{self.root}/{nxt}")
        self._hold_to_schema(nxt)
        self._commit(nxt)
        return nxt

    def _hold_to_schema(self, version: str) -> None:
        """The rows as written are checked, so they are computed once; a version that fails stays without its marker."""
        if self.declared is None:
            return
        from vexa.sources.schema import validate
        bad = (validate(self.spark.read.parquet(f"{self.root}/{version}"), self.declared).filter(~F.col("valid"))
               .groupBy("reason").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "reason").first())
        if bad is not None:
            raise SchemaViolation(f"{bad.n} rows: {bad.reason}")

    def publish_if(self, df: DataFrame, ok: bool) -> str | None:
        """Atomic batch: publish only when the batch validated."""
        return self.publish(df) if ok else None
