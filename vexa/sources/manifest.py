"""Tables made of files that stay where they are.

A published version of such a table is a manifest: one row per data file with its path, size, row count
and schema digest.  Importing files reads their footers (``footers``), and publishes a new manifest if every file has exactly the
declared columns and types; no data byte is read or written.  Readers resolve the current manifest once
and read its files, so an import is seen as a whole or not at all, and an older version stays readable.

The set is accepted or rejected together: one file with another type, a missing or an extra column, or no footer rejects
it, and nothing is published.  Files that the manifest already holds are not added again; one whose size or
schema differs from its entry has been replaced since, and rejects the set.

The list of paths reaches the driver, as it does for any Spark read of files; nothing else does.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vexa.sources.footers import footers
from vexa.sources.versioned import VersionedTable

ENTRY = "path string, file_bytes long, num_rows long, schema_digest string"


@dataclass(frozen=True)
class ImportResult:
    accepted: bool
    added_files: int
    added_rows: int
    version: str | None     # the version that holds the files; None if none was ever published
    reasons: DataFrame      # (path, reason) of the files that reject the set


def declared_columns(declared: T.StructType) -> list[tuple[str, str]]:
    return sorted((f.name, f.dataType.simpleString()) for f in declared.fields)


def _named(name: str):
    return lambda f: f["name"] == name


def mismatch(declared: T.StructType) -> Column:
    """Why a file's columns (``fields``) are not the declared ones; null if they are.  The order of columns is free."""
    want = declared_columns(declared)
    names = F.transform("fields", lambda f: f["name"])
    reason = F.lit(None).cast("string")
    for name, kind in reversed(want):
        has = F.get(F.filter("fields", _named(name)), 0)["type"]
        reason = (F.when(has.isNull(), F.lit(f"missing field {name}"))
                  .when(has != kind, F.concat(F.lit(f"field {name} is "), has, F.lit(f", declared {kind}"))).otherwise(reason))
    extra = F.array_sort(F.array_except(names, F.array(*[F.lit(n) for n, _ in want])))
    undeclared = F.when(F.size(extra) > 0, F.concat(F.lit("undeclared field "), F.element_at(extra, 1)))
    return F.coalesce(F.col("problem"), F.when(F.size(names) != F.size(F.array_distinct(names)), F.lit("a field twice")), reason, undeclared)


def digest(fields: Column) -> Column:
    return F.md5(F.to_json(F.array_sort(fields)))


class ManifestTable:
    """A table over files that are imported as they are; ``declared`` is its schema."""

    def __init__(self, spark: SparkSession, root: str, declared: T.StructType):
        self.spark, self.declared = spark, declared
        self.log = VersionedTable(spark, root)

    def entries(self, version: str | None = None) -> DataFrame:
        if version is None and self.log.current() is None:
            return self.spark.createDataFrame([], ENTRY)
        return self.log.read(version)

    def plan(self, files: DataFrame) -> tuple[DataFrame, DataFrame]:
        """What importing ``files`` (path, file_bytes; see ``footers.data_files``) would add, as manifest entries, and
        (path, reason) of the files that reject the set."""
        found = footers(files.dropDuplicates(["path"])).withColumn("reason", mismatch(self.declared))
        found = found.select("path", "file_bytes", "num_rows", digest(F.col("fields")).alias("schema_digest"), "reason")
        known = self.entries().select("path", F.col("file_bytes").alias("was_bytes"), F.col("schema_digest").alias("was_digest"))
        joined = found.join(known, "path", "left").checkpoint()
        replaced = (F.col("was_bytes") != F.col("file_bytes")) | (F.col("was_digest") != F.col("schema_digest"))
        reasons = joined.select("path", F.coalesce("reason", F.when(replaced, F.lit("replaced since its import"))).alias("reason"))
        return (joined.filter("was_bytes IS NULL").select("path", "file_bytes", "num_rows", "schema_digest"),
                reasons.filter("reason IS NOT NULL"))

    def add(self, new: DataFrame) -> str:
        """Publish the manifest with the entries of ``new``."""
        return self.log.publish(self.entries().unionByName(new).coalesce(1))

    def import_files(self, files: DataFrame) -> ImportResult:
        new, reasons = self.plan(files)
        if reasons.limit(1).count():
            return ImportResult(False, 0, 0, self.log.current(), reasons)
        n = new.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("num_rows"), F.lit(0)).alias("rows")).first()
        return ImportResult(True, n.files, n.rows, self.add(new) if n.files else self.log.current(), reasons)

    def read(self, version: str | None = None) -> DataFrame:
        """The rows of a version, by default the current one, with the declared columns."""
        paths = [r.path for r in self.entries(version).select("path").orderBy("path").collect()]
        if not paths:
            return self.spark.createDataFrame([], self.declared)
        return self.spark.read.schema(self.declared).parquet(*paths)

    def count(self, version: str | None = None) -> int:
        """Rows of a version, from the manifest."""
        return self.entries(version).agg(F.coalesce(F.sum("num_rows"), F.lit(0))).first()[0]
