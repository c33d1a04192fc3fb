"""Landing -> bronze: lineage stamp, multi-table ingest, append sink."""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callstar.session import CODEC

BATCH_COL = "batch_id"
PART_COL = "part"
STAMP_COL = "ingestion_timestamp"
ORIGIN_COL = "origem"
WITHDRAWN = "_withdrawn"

# Batch stamp used by single-batch driver queries (explicit, never "now").
DEFAULT_BATCH = "2024-03-01 02:00:00"


def bronze_schema(landing_schema: T.StructType) -> T.StructType:
    """Landing schema plus the two lineage fields (read from metadata only)."""
    return T.StructType(list(landing_schema.fields) + [
        T.StructField(STAMP_COL, T.TimestampType(), True),
        T.StructField(ORIGIN_COL, T.StringType(), True),
    ])


def stamp(df: DataFrame, batch_ts: str | datetime = DEFAULT_BATCH, origin: str = "landing") -> DataFrame:
    """Add the batch stamp (one explicit value per load) and the origin."""
    ts = F.to_timestamp(F.lit(str(batch_ts)))
    return df.select("*", ts.alias(STAMP_COL), F.lit(origin).alias(ORIGIN_COL))


def stamp_from(df: DataFrame, batch_col: str, origin: str = "landing") -> DataFrame:
    """Stamp a multi-batch frame from its own batch column."""
    return df.select("*", F.col(batch_col).cast("timestamp").alias(STAMP_COL),
                     F.lit(origin).alias(ORIGIN_COL))


def ingest_status(frames: dict[str, DataFrame], batch_ts: str = DEFAULT_BATCH) -> DataFrame:
    """Multi-table ingest report: one (table, rows, status) row per table.

    A table whose plan cannot be built (missing columns, bad source) gets a
    FAILED row instead of stopping the others. All counts run as one job.
    """
    spark = next(iter(frames.values())).sparkSession
    out = None
    for name, df in frames.items():
        try:
            part = (stamp(df, batch_ts, f"landing.{name}").agg(F.count(F.lit(1)).alias("row_count"))
                    .select(F.lit(name).alias("table_name"), "row_count", F.lit("LOADED").alias("status")))
        except Exception:  # plan-time failure of this table only
            part = spark.createDataFrame([(name, None, "FAILED")],
                                         "table_name string, row_count bigint, status string")
        out = part if out is None else out.unionByName(part)
    return out


def batch_id(batch_ts: str | datetime) -> str:
    """Partition value of a batch: the digits of its whole stamp."""
    return re.sub(r"[^0-9]", "", str(batch_ts))


def append_batch(df: DataFrame, path: str, batch_ts: str | datetime, part: int = 0) -> None:
    """Write one stamped batch as its own partition ``batch_id=.../part=...``.

    Loading the same batch again replaces it. Batches come from the daily
    load (part 0) and from the stream (a part for each micro-batch), in one
    layout; a batch filter prunes whole directories.
    """
    df.write.mode("overwrite").option("compression", CODEC).parquet(f"{path}/{BATCH_COL}={batch_id(batch_ts)}/{PART_COL}={part}")


def read_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All stored batches of a bronze table, with a declared schema (an empty table has no file to infer from)."""
    fields = [*schema.fields, T.StructField(BATCH_COL, T.StringType()), T.StructField(PART_COL, T.IntegerType())]
    return spark.read.schema(T.StructType(fields)).parquet(path)


def withdrawn(spark: SparkSession, bronze_root: str) -> set[str]:
    """Ids of the batches that were taken back (see ``plans.replay``): a mark file each, beside the bronze tables."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{bronze_root}/{WITHDRAWN}")
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return {f.getPath().getName() for f in fs.listStatus(p)} if fs.exists(p) else set()
