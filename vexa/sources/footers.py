"""Parquet footers as a DataFrame: schema, row groups and column statistics of each file.

Tasks read the footers of a list of files (the tail of each file, never its data).  A path that the tasks'
file systems cannot open, such as one of a mount table that only Spark's configuration knows, has its tail read through the
session's Hadoop FileSystem by a few threads of the driver, and is parsed by the tasks like the others.  A file that is
no Parquet file is not an error here: its row says so in ``problem``.
"""

from __future__ import annotations

import io
import json
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FILES_PER_TASK = 64
#: Where Spark's writer keeps its own schema in a footer.
SPARK_SCHEMA = b"org.apache.spark.sql.parquet.row.metadata"

FOOTER = ("path string, file_bytes long, num_rows long, problem string, fields array<struct<name: string, type: string>>, "
          "row_groups array<struct<row_group: int, num_rows: long, columns: array<struct<name: string, compressed_bytes: long, "
          "num_nulls: long, min: string, max: string>>>>")


def data_files(spark: SparkSession, path: str, suffix: str = ".parquet") -> DataFrame:
    """(path, file_bytes) of a file, or of all data files below a folder; names that begin with ``_`` or ``.`` are no data."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    base = fs.getFileStatus(root).getPath().toString()
    found, it = [], fs.listFiles(root, True)
    while it.hasNext():
        s = it.next()
        name = s.getPath().toString()
        below = name[len(base):].split("/")
        if not any(p.startswith(("_", ".")) for p in below) and (name == base or name.endswith(suffix)):
            found.append((name, s.getLen()))
    return spark.createDataFrame(sorted(found), "path string, file_bytes long")


def listed(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, file_bytes) of files named by the caller; a missing one is an error."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    found = []
    for name in paths:
        p = jvm.org.apache.hadoop.fs.Path(name)
        s = p.getFileSystem(conf).getFileStatus(p)
        found.append((s.getPath().toString(), s.getLen()))
    return spark.createDataFrame(found, "path string, file_bytes long")


def _opened(uri: str):
    """The file of a Hadoop path in a task."""
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    fs, path = pyarrow.fs.FileSystem.from_uri(uri)
    return fs.open_input_file(path)


def _text(value) -> str | None:
    """A statistic as text that Spark casts back to the column's type."""
    if value is None:
        return None
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, float):
        return repr(value + 0.0)  # writers keep the least zero as -0.0
    if isinstance(value, bytes):
        return value.decode("utf-8", "replace")
    return str(value)


def _fields(meta: pq.FileMetaData) -> list[dict]:
    """Names and Spark types of the columns: those that Spark wrote, else those that its reader would take."""
    kept = (meta.metadata or {}).get(SPARK_SCHEMA)
    if kept:
        fields = [(f.name, f.dataType) for f in T.StructType.fromJson(json.loads(kept)).fields]
    else:
        from pyspark.sql.pandas.types import from_arrow_type
        fields = [(f.name, from_arrow_type(f.type, prefer_timestamp_ntz=True)) for f in meta.schema.to_arrow_schema()]
    return [{"name": n, "type": t.simpleString()} for n, t in fields]


def _row_groups(meta: pq.FileMetaData) -> list[dict]:
    """Statistics of the flat columns; a nested column has its bytes added up and no values."""
    out = []
    for g in range(meta.num_row_groups):
        group = meta.row_group(g)
        columns: dict[str, dict] = {}
        for c in range(group.num_columns):
            chunk = group.column(c)
            name = chunk.path_in_schema.split(".")[0]
            flat = chunk.path_in_schema == name
            stats = chunk.statistics if flat and chunk.is_stats_set else None
            held = columns.setdefault(name, {"name": name, "compressed_bytes": 0, "num_nulls": None, "min": None, "max": None})
            held["compressed_bytes"] += chunk.total_compressed_size
            if stats is not None:
                held["num_nulls"] = stats.null_count if stats.has_null_count else None
                if stats.has_min_max:
                    held["min"], held["max"] = _text(stats.min), _text(stats.max)
        out.append({"row_group": g, "num_rows": group.num_rows, "columns": list(columns.values())})
    return out


def _footer_row(path: str, size: int, meta: pq.FileMetaData) -> dict:
    return {"path": path, "file_bytes": size, "num_rows": meta.num_rows, "problem": None, "fields": _fields(meta),
            "row_groups": _row_groups(meta)}


def _tail(spark: SparkSession, path: str, size: int) -> bytes | None:
    """The footer's bytes through the session's Hadoop FileSystem; None where the file cannot hold one."""
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    stream = p.getFileSystem(sc._jsc.hadoopConfiguration()).open(p)
    try:
        def last(n: int) -> bytes:
            stream.seek(size - n)
            return bytes(stream.readAllBytes())

        if size < 12:
            return None
        length = int.from_bytes(last(8)[:4], "little")
        return last(length + 8) if length + 8 <= size else None
    finally:
        stream.close()


def footers(files: DataFrame) -> DataFrame:
    """One row per file of ``files`` (path, file_bytes): columns ``FOOTER``."""
    from pyspark.sql.pandas.types import to_arrow_schema
    spark = files.sparkSession
    schema = spark.createDataFrame([], FOOTER).schema
    arrow = to_arrow_schema(schema)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                try:
                    if r["tail"] is not None:
                        row = _footer_row(r["path"], r["file_bytes"], pq.read_metadata(io.BytesIO(r["tail"])))
                    else:
                        with _opened(r["path"]) as f:
                            row = _footer_row(r["path"], r["file_bytes"], pq.read_metadata(f))
                except (OSError, pa.ArrowException) as e:
                    row = {"path": r["path"], "file_bytes": r["file_bytes"], "problem": str(e).split("\n")[0][:200]}
                yield pa.RecordBatch.from_pylist([row], schema=arrow)

    def spread(df: DataFrame, n: int) -> DataFrame:
        return df.repartition(max(1, -(-n // FILES_PER_TASK))).mapInArrow(read, schema)

    n = files.count()
    got = spread(files.withColumn("tail", F.lit(None).cast("binary")), n).checkpoint()
    unread = got.filter("problem IS NOT NULL").select("path", "file_bytes").collect()
    if not unread:
        return got
    with ThreadPoolExecutor(16) as pool:
        tails = list(pool.map(lambda r: _tail(spark, r.path, r.file_bytes), unread))
    again = spark.createDataFrame([(r.path, r.file_bytes, t or b"") for r, t in zip(unread, tails)], "path string, file_bytes long, tail binary")
    return got.filter("problem IS NULL").unionByName(spread(again, len(unread)))


def row_groups(found: DataFrame) -> DataFrame:
    """One row per file, row group and column."""
    groups = found.select("path", "file_bytes", F.explode("row_groups").alias("g"))
    columns = groups.select("path", "file_bytes", "g.row_group", "g.num_rows", F.explode("g.columns").alias("c"))
    return columns.select("path", "file_bytes", "row_group", "num_rows", F.col("c.name").alias("column_name"), "c.compressed_bytes", "c.num_nulls",
                          F.col("c.min").alias("min_value"), F.col("c.max").alias("max_value"))


def column_profile(found: DataFrame, schema: T.StructType) -> DataFrame:
    """Per column of ``schema``: type, rows, files, row groups, bytes, nulls and extremes, from footers alone.

    Extremes are compared in the column's own type; they are null where a row group with values has no statistics, as
    for nested columns."""
    rows = row_groups(found)
    simple = [f for f in schema.fields if not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.BinaryType, T.VariantType))]
    types = F.create_map(*[x for f in schema.fields for x in (F.lit(f.name), F.lit(f.dataType.simpleString()))])

    def extreme(agg, col):
        out = F.lit(None).cast("string")
        for f in simple:
            out = F.when(F.col("column_name") == f.name, agg(F.when(F.col("column_name") == f.name, F.col(col).cast(f.dataType))).cast("string")).otherwise(out)
        return out

    unknown = F.bool_or((F.col("num_nulls").isNull() | (F.col("num_nulls") < F.col("num_rows"))) & F.col("min_value").isNull())
    out = rows.groupBy("column_name").agg(
        F.sum("num_rows").alias("num_rows"), F.count_distinct("path").alias("num_files"), F.count(F.lit(1)).alias("num_row_groups"),
        F.sum("compressed_bytes").alias("compressed_bytes"),
        F.when(F.count("num_nulls") == F.count(F.lit(1)), F.sum("num_nulls")).alias("num_nulls"),
        F.when(~unknown, extreme(F.min, "min_value")).alias("min_value"), F.when(~unknown, extreme(F.max, "max_value")).alias("max_value"))
    return out.withColumn("data_type", F.element_at(types, F.col("column_name")))
