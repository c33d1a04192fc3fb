"""Lookup joins against small dimension tables and FK checks.

Broadcast is only ever taken behind a size check, two ways:

* default: no hint. AQE measures the *materialised* size of the lookup side
  at run time and converts the shuffled join to a broadcast only when it is
  under ``spark.sql.adaptive.autoBroadcastJoinThreshold`` (set in
  ``session.BASE_CONF``); above it the sort-merge join stays. This costs no
  extra job and works when the lookup is itself derived (deduplicated) in
  the same plan.
* ``max_bytes=N`` for stored tables: ``bounded`` hints ``broadcast`` only for a
  table of at most ``N`` bytes, else leaves the shuffled join. The bytes are
  those of the values, so a few wide rows count as what they are. A table whose
  plan statistics are above the bound is not read for it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A lookup with more bytes than this is joined by shuffle instead.
BROADCAST_MAX_BYTES = 32 << 20
#: Tasks among which rows without a key are spread.
NULL_SPREAD = 256
#: What a row and its key cost in the hashed relation beside their values.
ROW_OVERHEAD = 32


def row_bytes(schema: T.StructType) -> Column:
    """Bytes of a row's values: texts and binaries by length, nested values by their JSON, the rest 16 each."""
    total = F.lit(ROW_OVERHEAD).cast("bigint")
    for f in schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            total = total + F.coalesce(F.octet_length(c), F.lit(0)) + 8
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            total = total + F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0)) + 8
        else:
            total = total + 16
    return total


def fits(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """Whether ``df`` takes at most ``max_bytes``: by its files when they are larger already, else measured in one aggregate."""
    files = sum_of_files(df)
    if files is not None and files > max_bytes:
        return False
    return (df.agg(F.sum(row_bytes(df.schema))).first()[0] or 0) <= max_bytes


def sum_of_files(df: DataFrame) -> int | None:
    """Bytes that Spark's plan statistics give the scanned columns; None where they know nothing (no file scan)."""
    stats = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return stats if stats < 1 << 62 else None


def bounded(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """``broadcast(df)`` if it takes at most ``max_bytes``, else ``df``."""
    return F.broadcast(df) if fits(df, max_bytes) else df


def lookup(left: DataFrame, dim: DataFrame, left_key: Column, dim_key: Column,
           take: list[str], max_bytes: int | None = None,
           key_name: str = "_lk") -> DataFrame:
    """LEFT join ``left`` to ``dim`` on computed keys, adding ``take`` columns.

    The dimension is reduced to one row per key first (smallest values win),
    so a duplicated dimension entry can never multiply fact rows.
    """
    d = (dim.select(dim_key.alias(key_name), *take)
            .filter(F.col(key_name).isNotNull())
            .groupBy(key_name).agg(*[F.min(c).alias(c) for c in take]))
    d = bounded(d, max_bytes) if max_bytes is not None else d
    joined = left.withColumn(key_name, left_key).join(d, on=key_name, how="left")
    return joined.drop(key_name)


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose non-NULL FK has no parent row (left anti join)."""
    p = parent.select(F.col(parent_key).alias("_pk")).filter(F.col("_pk").isNotNull()).distinct()
    c = child.filter(F.col(child_key).isNotNull())
    return c.join(p, c[child_key] == p["_pk"], "left_anti")


def fk_flag(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str,
            flag: str) -> DataFrame:
    """Adds ``flag`` = parent exists for the FK (NULL FK -> FALSE)."""
    # rows without the key (bot tickets have no agent) never match; a salt spreads them instead of hashing them to one task
    p = (parent.select(F.col(parent_key).alias("_pk")).filter(F.col("_pk").isNotNull())
               .distinct().withColumn("_hit", F.lit(True)).withColumn("_ps", F.hash("_pk") * 0))
    spread = F.when(F.col(child_key).isNull(), F.pmod(F.hash(*child.columns), F.lit(NULL_SPREAD))).otherwise(F.lit(0))
    out = child.withColumn("_cs", spread)
    out = out.join(p, (out[child_key] == p["_pk"]) & (out["_cs"] == p["_ps"]), "left")
    return out.withColumn(flag, F.coalesce(F.col("_hit"), F.lit(False))).drop("_pk", "_hit", "_ps", "_cs")
