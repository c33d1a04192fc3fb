"""Batch-aware reads over an append-only bronze history.

* ``latest_batch``: rows of the newest batch, as a scalar-subquery filter
  (no driver round trip; on a batch-partitioned table Spark prunes
  directories with the subquery result at run time).
* ``as_of``: the table as it looked after batch ``t`` (latest row per key
  among batches <= t) — the data side of time travel.
* ``batch_diff``: insert / update / delete rows between two batches by key,
  one full outer join and null-safe compares.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callstar.operators.dedup import keep_latest
from callstar.sources.ingest import STAMP_COL


def latest_batch(df: DataFrame, stamp_col: str = STAMP_COL) -> DataFrame:
    """Rows whose stamp equals the newest stamp; the whole frame if unstamped."""
    if stamp_col not in df.columns:
        return df
    spark = df.sparkSession
    return spark.sql(
        f"SELECT * FROM {{src}} WHERE `{stamp_col}` = (SELECT max(`{stamp_col}`) FROM {{src}})",
        src=df)


def as_of(df: DataFrame, keys: list[str], upto, stamp_col: str = STAMP_COL) -> DataFrame:
    """Latest row per key among batches stamped at or before ``upto``."""
    visible = df.filter(F.col(stamp_col) <= F.lit(upto).cast("timestamp"))
    return keep_latest(visible, keys, [stamp_col])


def batch_diff(old: DataFrame, new: DataFrame, keys: list[str], compare: list[str]) -> DataFrame:
    """Change rows from ``old`` to ``new`` (both unique on ``keys``).

    Output: keys, change_type in (INSERT, UPDATE, DELETE), then the new
    values (old values for deletes). Unchanged keys produce no row.

    NULL keys never match, so NULL-keyed rows are emitted directly as
    DELETE (old side) or INSERT (new side) instead of entering the full
    outer join, where all of them would hash to one task (AQE splits skewed
    partitions for inner/left joins, not for full outer joins).
    """
    keyed = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    o = old.filter(keyed).select(*keys, F.lit(True).alias("_old"),
                                 *[F.col(c).alias(f"_o_{c}") for c in compare])
    n = new.filter(keyed).select(*keys, F.lit(True).alias("_new"),
                                 *[F.col(c).alias(f"_n_{c}") for c in compare])
    j = o.join(n, on=keys, how="full_outer")
    same = reduce(lambda a, b: a & b, [F.col(f"_o_{c}").eqNullSafe(F.col(f"_n_{c}")) for c in compare], F.lit(True))
    change = (F.when(F.col("_old").isNull(), F.lit("INSERT"))
               .when(F.col("_new").isNull(), F.lit("DELETE"))
               .when(~same, F.lit("UPDATE")))
    out = j.select(*keys, change.alias("change_type"),
                   *[F.when(F.col("_new").isNull(), F.col(f"_o_{c}"))
                      .otherwise(F.col(f"_n_{c}")).alias(c) for c in compare])
    deleted = old.filter(~keyed).select(*keys, F.lit("DELETE").alias("change_type"), *compare)
    inserted = new.filter(~keyed).select(*keys, F.lit("INSERT").alias("change_type"), *compare)
    return out.filter(F.col("change_type").isNotNull()).unionByName(deleted).unionByName(inserted)
