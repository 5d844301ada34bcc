"""Declared schemas with strict or dynamic modes.

A declared field carries its limits in the StructField metadata:
``{"pk": true}``, ``{"dim": 64}`` for vectors, ``{"max_length": 200}`` for
strings.  ``validate`` returns every input row with ``valid`` and a
``reason``; rows are never silently dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def field(name: str, dtype: T.DataType, **meta) -> T.StructField:
    return T.StructField(name, dtype, True, meta)


def validate(df: DataFrame, declared: T.StructType, dynamic: bool = False) -> DataFrame:
    """Add ``valid`` and ``reason`` (first failing rule) for every row.

    Strict mode rejects the whole input when it has undeclared columns;
    dynamic mode accepts them (they go to the ``$meta`` JSON column via
    ``pack_dynamic``).  Missing declared columns always reject."""
    names = set(df.columns)
    missing = [f.name for f in declared.fields if f.name not in names]
    extra = [c for c in df.columns if c not in {f.name for f in declared.fields}]
    checks: list[tuple[Column, str]] = []
    if missing:
        checks.append((F.lit(True), "missing field " + ",".join(missing)))
    if extra and not dynamic:
        checks.append((F.lit(True), "undeclared field " + ",".join(extra)))
    types = {f.name: f.dataType for f in df.schema.fields}
    for f in declared.fields:
        if f.name not in names:
            continue
        c = F.col(f"`{f.name}`")
        if types[f.name].simpleString() != f.dataType.simpleString():
            checks.append((F.lit(True), f"field {f.name} is {types[f.name].simpleString()}"))
            continue
        md = f.metadata or {}
        if md.get("pk"):
            checks.append((c.isNull(), f"null key {f.name}"))
        if "dim" in md:
            checks.append((c.isNull(), f"null vector {f.name}"))
            checks.append((F.size(c) != md["dim"], f"wrong dim {f.name}"))
        if "max_length" in md:
            checks.append((F.length(c) > md["max_length"], f"too long {f.name}"))
    reason = F.lit(None).cast("string")
    for cond, why in reversed(checks):
        reason = F.when(F.coalesce(cond, F.lit(False)), F.lit(why)).otherwise(reason)
    return df.withColumn("reason", reason).withColumn("valid", F.col("reason").isNull())


def pack_dynamic(df: DataFrame, declared: T.StructType, meta_col: str = "meta") -> DataFrame:
    """Keep declared columns, fold every other column into one JSON object column."""
    decl = [f.name for f in declared.fields if f.name in df.columns]
    extra = [c for c in df.columns if c not in decl]
    meta = F.to_json(F.struct(*extra)) if extra else F.lit("{}")
    return df.select(*decl, meta.alias(meta_col))


def dynamic_value(meta_col: str, name: str, type_: str) -> Column:
    """Read a dynamic field by name (VARIANT path), null when absent."""
    return F.try_variant_get(F.try_parse_json(F.col(meta_col)), f"$.{name}", type_)
