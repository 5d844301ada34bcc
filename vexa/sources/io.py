"""Readers, conforming writers, profiles and generators.

Everything stays a DataFrame: no pandas frame or per-row loop on the driver.
Listing files goes through the session's Hadoop FileSystem, so the same
code works on local disk, HDFS or an object store.
"""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

GIB = 1024 ** 3
UNITS = {"B": 1, "KB": 1024, "MB": 1024 ** 2, "GB": GIB}
# Fixed row widths (bytes) of the supported field types for size estimates.
TYPE_WIDTH = {"INT64": 8, "DOUBLE": 8}


def scan_parquet_dir(spark: SparkSession, path: str, columns: list[str] | None = None,
                     glob: str = "*.parquet") -> DataFrame:
    df = spark.read.option("pathGlobFilter", glob).parquet(path)
    return df.select(*columns) if columns else df


def conform(df: DataFrame, target: T.StructType) -> DataFrame:
    """Cast every column to the declared type; vectors element-wise."""
    cols = []
    for f in target.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.ArrayType):
            cols.append(F.transform(c, _caster(f.dataType.elementType)).alias(f.name))
        else:
            cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols)


def _caster(dt: T.DataType):
    return lambda x: x.cast(dt)


def write_sized(df: DataFrame, path: str, max_records: int = 10_000, mode: str = "overwrite",
                fmt: str = "parquet") -> None:
    """Bounded files: at most ``max_records`` rows per file; REBALANCE lets
    AQE even out task sizes (``advisoryPartitionSizeInBytes``) before writing."""
    (df.hint("rebalance").write.mode(mode).option("maxRecordsPerFile", max_records).format(fmt).save(path))


def list_files(spark: SparkSession, path: str, suffix: str = ".parquet") -> list[str]:
    """Data files directly under ``path`` (names only reach the driver)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(s.getPath().toString() for s in fs.listStatus(p)
                  if s.isFile() and s.getPath().getName().endswith(suffix))


def bulk_import(spark: SparkSession, files: list[str], target: str, declared: T.StructType) -> bool:
    """Copy prepared files into ``target`` when every one has exactly the declared columns and types; the whole
    set is accepted or rejected (O04).

    The footers are checked first (``manifest``).  A ledger below ``target`` names the files imported so far: a file
    that is given again adds nothing.  Each import writes a slice of its own, named after its new files, and the ledger last, so that an
    import that broke off and is repeated replaces its slice."""
    from vexa.sources.footers import listed
    from vexa.sources.manifest import ManifestTable
    if not files:
        return True
    ledger = ManifestTable(spark, f"{target}/_imports", declared)
    new, reasons = ledger.plan(listed(spark, files))
    if reasons.limit(1).count():
        return False
    paths = [r.path for r in new.select("path").orderBy("path").collect()]
    if paths:
        slice_id = hashlib.md5("\n".join(paths).encode()).hexdigest()[:16]
        rows = spark.read.schema(declared).parquet(*paths)
        rows.write.mode("overwrite").parquet(f"{target}/import_id={slice_id}")
        ledger.add(new)
    return True


def read_imported(spark: SparkSession, target: str) -> DataFrame:
    """The rows of a table filled by ``bulk_import``."""
    return spark.read.parquet(target).drop("import_id")


def per_file_counts(df: DataFrame) -> DataFrame:
    return df.groupBy(F.col("_metadata.file_path").alias("file_path")).agg(
        F.count(F.lit(1)).alias("num_rows"), F.max("_metadata.file_size").alias("file_bytes"))


def write_key_text(df: DataFrame, path: str, key: str, seg: str) -> None:
    """One key per line, one folder per segment."""
    df.select(F.col(key).cast("string").alias("value"), seg).write.mode("overwrite").partitionBy(seg).text(path)


def read_key_text(spark: SparkSession, path: str, key: str = "pk") -> DataFrame:
    df = spark.read.text(path)
    return df.select(F.trim("value").cast("long").alias(key), *[c for c in df.columns if c != "value"])


def uniform(seed: Column, *parts: Column) -> Column:
    """Deterministic uniform double in [0, 1) from md5 of ``seed-part-...``:
    independent of partitioning, repeatable, identical in any SQL engine."""
    h = F.md5(F.concat_ws("-", seed.cast("string"), *[p.cast("string") for p in parts]))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("long") / F.lit(4294967296.0)


def generate_rows(keys: DataFrame, key_col: str, seed: int, dim: int) -> DataFrame:
    """Synthetic rows for every key: a uniform double and a uniform vector."""
    s = F.lit(seed)
    vec = F.transform(F.sequence(F.lit(1), F.lit(dim)), lambda i: uniform(s, F.col(key_col), i))
    return keys.select(F.col(key_col).alias("pk"), uniform(s, F.col(key_col)).alias("random"), vec.alias("vector"))


def hashed_long(seed: Column, *parts: Column) -> Column:
    """60 bits of the md5 of ``seed-part-...`` as a non-negative long."""
    h = F.md5(F.concat_ws("-", seed.cast("string"), *[p.cast("string") for p in parts]))
    return F.conv(F.substring(h, 1, 15), 16, 10).cast("long")


def normal(seed: Column, *parts: Column) -> Column:
    """Standard normal double by Box-Muller from two uniforms; the first is taken from (0, 1]."""
    u = F.lit(1.0) - uniform(seed, *parts, F.lit("u"))
    return F.sqrt(F.lit(-2.0) * F.log(u)) * F.cos(F.lit(2 * math.pi) * uniform(seed, *parts, F.lit("v")))


def generate_table(keys: DataFrame, key_col: str, fields: list[tuple], seed: int) -> DataFrame:
    """Synthetic rows, one per key, with a column for each of ``fields`` (name, kind, parameters...):

    ``sequence`` start, step: start + step * key; ``string_key`` length (up to 32): hexadecimal digits, different for different keys as
    far as the length allows; ``long`` below; ``uniform`` low, high; ``normal`` mean, deviation; ``uniform_vector`` and ``normal_vector``
    dim: of unit scale.  Each value is a function of (seed, column, key) alone: the rows do not depend on partitions or on
    other columns."""
    k = F.col(key_col)

    def value(name: str, kind: str, *args):
        s, c = F.lit(seed), F.lit(name)
        if kind == "sequence":
            return F.lit(args[0]) + F.lit(args[1]) * k
        if kind == "string_key":
            return F.substring(F.md5(F.concat_ws("-", s.cast("string"), c, k.cast("string"))), 1, args[0])
        if kind == "long":
            return F.pmod(hashed_long(s, c, k), F.lit(args[0]).cast("long"))
        if kind == "uniform":
            return F.lit(float(args[0])) + F.lit(float(args[1]) - float(args[0])) * uniform(s, c, k)
        if kind == "normal":
            return F.lit(float(args[0])) + F.lit(float(args[1])) * normal(s, c, k)
        if kind in ("uniform_vector", "normal_vector"):
            draw = uniform if kind == "uniform_vector" else normal
            return F.transform(F.sequence(F.lit(1), F.lit(args[0])), lambda i: draw(s, c, k, i))
        raise ValueError(f"no generator for {kind}")

    return keys.select(k, *[value(*f).alias(f[0]) for f in fields])


def row_width(fields: list[tuple[str, int]]) -> int:
    """Bytes per row: INT64 / DOUBLE 8, VARCHAR max_length, FLOAT_VECTOR 4 x dim."""
    w = 0
    for kind, n in fields:
        if kind in TYPE_WIDTH:
            w += TYPE_WIDTH[kind]
        elif kind == "VARCHAR":
            w += n
        elif kind == "FLOAT_VECTOR":
            w += 4 * n
        else:
            raise ValueError(f"no size rule for {kind}")
    return w


def estimate_batches(spec: DataFrame, size_col: str, unit: str, width: int,
                     batch_bytes: int = 5 * 1024 ** 2) -> DataFrame:
    """Rows for a byte size, split into ``batch_bytes`` batches plus a tail."""
    total = F.floor(F.col(size_col) * F.lit(UNITS[unit]) / F.lit(width)).cast("long")
    per = max(1, batch_bytes // width)
    d = spec.withColumn("est_rows", total)
    d = d.withColumn("batch_no", F.explode(F.sequence(F.lit(0).cast("long"),
                                                      F.greatest(F.ceil(F.col("est_rows") / per) - 1, F.lit(0)).cast("long"))))
    return d.withColumn("batch_rows", F.least(F.lit(per).cast("long"), F.col("est_rows") - F.col("batch_no") * per))
