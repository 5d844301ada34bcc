"""Content-addressed WARC archive (operator 6).

``write`` makes one WARC record per row.  Payload bytes are stored once, under their SHA-256
digest, in one table; the exact record headers are stored in another.  Of records with equal
payloads of at least ``min_bytes`` bytes, that of the smallest id is the ``response`` and the others
are ``revisit`` records that refer to it; smaller payloads are all responses.
``read`` joins the headers with the payloads on the digest and gives back every original
record, header and full payload, after checking each payload against its digest.
``export`` writes standard ``.warc`` text files (a revisit has no block there) and ``import_files`` reads
such files, so archives can be exchanged with other tools.

Payloads are UTF-8 bytes (null: empty).  Rows of one payload with a null id count after all ids, and a revisit that refers to one of
them has a null ``refers_to``; repeated ids are separate records, the first of them by url is the response, and of
repeated rows one.  Line ends in a url, also Unicode's own, become blanks.  A payload may be as long as a row may be.  An empty
table gives an empty archive.  Other columns are ignored.  A digest
that stands for two payloads, or a stored payload that does not match its digest, is an error.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vexa.llm.common import save
from vexa.session import scratch_path

CRLF = "\r\n"
DATE = "1970-01-01T00:00:00Z"  # pages carry no date; a constant keeps archives reproducible


def _clean(col):
    """A header value: no line ends, also not those that only Unicode knows."""
    return F.regexp_replace(F.coalesce(col.cast("string"), F.lit("")), "[\\r\\n\\u000B\\u000C\\u0085\\u2028\\u2029]+", " ")


def _base(pages: DataFrame, id_col: str, url_col: str, payload_col: str) -> DataFrame:
    """(id, url, payload, digest, size, check): ``check`` is a second hash, to verify that equal digests are equal bytes."""
    base = pages.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(url_col).cast("string"), F.lit("")).alias("url"),
                        F.encode(F.coalesce(payload_col, F.lit("")), "UTF-8").alias("payload"))
    return base.select("*", F.sha2("payload", 256).alias("digest"), F.octet_length("payload").cast("long").alias("size"),
                       F.xxhash64("payload").alias("check"))


#: Records of one payload above which its first record is broadcast instead of joined: such payloads are few.
HOT_RECORDS = 1 << 16


def _records(base: DataFrame, min_bytes: int) -> DataFrame:
    """(id, url, digest, size, type, refers_to) of every row, without any payload.

    Rows of one payload, id and url differ in nothing, so they are counted and given out again: of the first of all by (id,
    nulls last; url) one row is the response."""
    order = F.struct(F.col("id").isNull().alias("null"), "id", "url")
    groups = base.groupBy("digest", "id", "url").agg(
        F.count(F.lit(1)).alias("n"), F.min("size").alias("low"), F.max("size").alias("high"), F.min("check").alias("c1"),
        F.max("check").alias("c2"))
    groups = save(groups, "warc-groups")
    firsts = groups.groupBy("digest").agg(F.min(order).alias("f"), F.sum("n").alias("records"), F.min("low").alias("low"),
                                          F.max("high").alias("high"), F.min("c1").alias("c1"), F.max("c2").alias("c2"))
    one = (F.col("low") == F.col("high")) & (F.col("c1") == F.col("c2"))
    checked = F.when(one, F.col("f")).otherwise(F.raise_error(F.concat(F.lit("two payloads share the digest "), "digest")))
    firsts = save(firsts.select("digest", "records", checked.alias("f")), "warc-firsts")
    hot = firsts.filter(F.col("records") > HOT_RECORDS).select("digest", F.col("f").alias("hot"))  # at most rows / HOT_RECORDS
    rows = groups.select("digest", "id", "url", "n", F.col("low").alias("size")).join(F.broadcast(hot), "digest", "left")
    cold = rows.filter("hot IS NULL").drop("hot").join(firsts.filter(F.col("records") <= HOT_RECORDS).select("digest", "f"), "digest")
    every = cold.unionByName(rows.filter("hot IS NOT NULL").withColumnRenamed("hot", "f"))
    every = every.withColumn("at", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    first = F.col("id").eqNullSafe(F.col("f.id")) & (F.col("url") == F.col("f.url")) & (F.col("at") == 1)
    kind = F.when((F.col("size") < min_bytes) | first, "response").otherwise("revisit")
    return every.withColumn("type", kind).select("id", "url", "digest", "size", "type", F.when(F.col("type") == "revisit", F.col("f.id")).alias("refers_to"))


def _header():
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    revisit = F.col("type") == "revisit"
    lines = [F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), "type"), F.concat(F.lit("WARC-Record-ID: "), name(F.col("id"))),
             F.concat(F.lit("WARC-Target-URI: "), _clean(F.col("url"))), F.lit(f"WARC-Date: {DATE}"),
             F.concat(F.lit("WARC-Payload-Digest: sha256:"), "digest"),
             F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), name(F.col("refers_to")))),
             F.when(revisit, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
             F.lit("Content-Type: text/html; charset=utf-8"),
             F.concat(F.lit("Content-Length: "), F.when(revisit, F.lit(0)).otherwise(F.col("size")).cast("string"))]
    return F.concat(F.concat_ws(CRLF, *lines), F.lit(CRLF + CRLF))


def write(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
          min_bytes: int = 100) -> str:
    """Write the archive under ``path``: ``headers`` and ``payloads``.

    Which row is a response is settled on digests alone; a task then sends one copy of each payload that it holds."""
    base = _base(pages, id_col, url_col, payload_col)
    _records(base, min_bytes).select(_header().alias("header"), "digest").write.option("compression", "zstd").parquet(f"{path}/headers")
    (base.groupBy("digest").agg(F.first("payload").alias("payload"))
     .write.option("compression", "zstd").parquet(f"{path}/payloads"))
    return path


def read(spark: SparkSession, path: str) -> DataFrame:
    """(header, payload, digest): every original record, with its full verified payload."""
    headers = spark.read.parquet(f"{path}/headers")
    payloads = spark.read.parquet(f"{path}/payloads")
    whole = payloads.withColumn("payload", F.when(F.sha2("payload", 256) == F.col("digest"), F.col("payload")).otherwise(
        F.raise_error(F.concat(F.lit("stored payload does not match "), "digest")).cast("binary")))
    return headers.join(whole, "digest", "left").select(
        "header", F.when(F.col("payload").isNotNull(), F.col("payload")).otherwise(
            F.raise_error(F.concat(F.lit("no payload for "), "digest")).cast("binary")).alias("payload"), "digest")


def field(name: str, header: str = "header"):
    """The value of a header line, or null."""
    value = F.regexp_extract(header, f"(?:^|\\r\\n){re.escape(name)}: ([^\\r\\n]*)", 1)
    return F.when(value != "", value)


def described(recs: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of read records."""
    page = lambda c: F.regexp_extract(c, r"^<urn:page:(-?\d+)>$", 1)
    number = lambda c: F.when(page(c) != "", page(c)).cast("long")
    return recs.select(number(field("WARC-Record-ID")).alias("page_id"), F.octet_length("payload").cast("long").alias("payload_bytes"),
                       F.sha2("payload", 256).alias("payload_digest"), field("WARC-Type").alias("record_type"),
                       number(field("WARC-Refers-To")).alias("refers_to"))


def export(spark: SparkSession, path: str, out: str, file_bytes: int = 32 << 20) -> None:
    """Standard WARC files of about ``file_bytes``: header, block (empty for revisits), two line ends."""
    recs = read(spark, path).withColumn("block", F.when(field("WARC-Type") == "revisit", F.lit("")).otherwise(
        F.decode("payload", "UTF-8")))
    mean = recs.agg(F.avg(F.octet_length("block") + F.octet_length("header"))).first()[0] or 1.0
    (recs.select(F.concat("header", "block").alias("value")).write.option("lineSep", CRLF + CRLF)
     .option("maxRecordsPerFile", max(1, int(file_bytes / mean))).text(out))


def import_files(spark: SparkSession, path: str) -> DataFrame:
    """(header, block) of every record of the WARC files under ``path``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content in b.column(0):
                raw, at, heads, blocks = content.as_py(), 0, [], []
                while at < len(raw):
                    stop = raw.index(b"\r\n\r\n", at) + 4
                    head = raw[at:stop]
                    size = int(re.search(rb"(?im)^content-length:\s*(\d+)", head)[1])
                    heads.append(head.decode())
                    blocks.append(raw[stop:stop + size])
                    at = stop + size + 4
                    if len(heads) == 256:
                        yield pa.RecordBatch.from_arrays([pa.array(heads), pa.array(blocks, pa.binary())], ["header", "block"])
                        heads, blocks = [], []
                if heads:
                    yield pa.RecordBatch.from_arrays([pa.array(heads), pa.array(blocks, pa.binary())], ["header", "block"])

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(run, "header string, block binary")


def archive_report(pages: DataFrame) -> DataFrame:
    """Write an archive of ``pages`` to the shared scratch folder, read it back and describe its records."""
    path = write(pages, scratch_path(pages.sparkSession, "warc"))
    return described(read(pages.sparkSession, path))
