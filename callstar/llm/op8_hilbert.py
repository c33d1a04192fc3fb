"""Hilbert-curve sharding: order rows along a space-filling curve, cut equal runs.

Several metadata dimensions (language, source, text size, id) are quantised by
their own quantiles to ``2**BITS`` steps each; the Hilbert index of the cell is
the main sort key, so each shard covers a compact region of all dimensions and
its min/max statistics prune files on any of them. The sorted rows are cut into
``shards`` runs whose row counts differ by at most one (law ``rows``).

Defined cases: null text has size 1 and the CRC of the empty text; null
metadata sorts into step 0; rows with equal keys (ties, repeated rows) are
ordered by id and then by a row id, so every row gets its own slot; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from callstar.llm.common import stage, with_row_id

BITS = 4


def hilbert_index(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Hilbert index of integer points, one row each (axes to transpose form, then bits interleaved)."""
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    for level in range(bits - 1, 0, -1):  # undo excess work from the top bit down
        high, low = 1 << level, (1 << level) - 1
        for d in range(dims):
            inverts = (x[d] & high) != 0
            swap = np.where(inverts, 0, (x[0] ^ x[d]) & low)
            x[0] = np.where(inverts, x[0] ^ low, x[0] ^ swap)
            x[d] ^= swap
    for d in range(1, dims):  # Gray code
        x[d] ^= x[d - 1]
    flip = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        flip ^= np.where(x[dims - 1] & (1 << level), (1 << level) - 1, 0)
    x ^= flip
    out = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for d in range(dims):
            out = (out << 1) | ((x[d] >> level) & 1)
    return out


def leading_number(text: Column) -> Column:
    """First seven UTF-8 bytes of a text as a number that keeps their order."""
    raw = F.substring(F.rpad(F.hex(F.encode(F.coalesce(text, F.lit("")), "UTF-8")), 14, "0"), 1, 14)
    return F.conv(raw, 16, 10).cast("long")


def quantiles(df: DataFrame, dims: list[str], bits: int = BITS) -> dict[str, list[float]]:
    """Cut points of each dimension: one aggregate over all rows, ``2**bits - 1`` numbers a dimension come back."""
    steps = 1 << bits
    at = [i / steps for i in range(1, steps)]
    row = df.agg(*(F.percentile_approx(d, at, 1000).alias(d) for d in dims)).first()
    return {d: sorted(row[d] or []) for d in dims}


def hilbert_shards(df: DataFrame, dims: dict[str, Column], shards: int, tie: Column) -> DataFrame:
    """Add ``hilbert``, ``shard`` and ``slot`` to the columns of ``df`` (which should be a file scan).

    No global window: rows are range-partitioned and sorted, staged, numbered
    within their partition, and shifted by the sizes of the partitions before
    (one row per partition). Partition bounds include the tie-break and a row
    id, so even rows that agree in all dimensions split.
    """
    names = [f"dim_{i}" for i in range(len(dims))]
    base = with_row_id(df, "uid").select("*", tie.alias("tie"), *(c.cast("double").alias(n) for n, c in zip(names, dims.values())))
    cuts = quantiles(base, names)

    def cell(name: str) -> Column:
        if not cuts[name]:
            return F.lit(0)
        return F.size(F.filter(F.array(*(F.lit(float(c)) for c in cuts[name])), lambda cut: cut <= F.col(name)))

    cells = [cell(n).cast("int") for n in names]

    @F.pandas_udf("long")
    def index(*axes: pd.Series) -> pd.Series:
        return pd.Series(hilbert_index(np.stack([a.fillna(0).clip(0).to_numpy() for a in axes], axis=1)))

    placed = base.select("*", index(*cells).alias("hilbert")).drop(*names)
    parts = max(shards, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    order = ["hilbert", "tie", "uid"]
    placed = stage(placed.repartitionByRange(parts, *order).sortWithinPartitions(*order)
                   .withColumn("run", F.spark_partition_id())
                   .withColumn("at", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)), "hilbert")
    runs = placed.groupBy("run").agg(F.count("*").alias("n"))  # a row per partition
    before = Window.orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.select("run", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    total = placed.agg(F.count("*").alias("total"))
    ranked = (placed.join(F.broadcast(starts), "run").join(F.broadcast(total))
              .withColumn("rank", F.col("start") + F.col("at")))
    # shard s holds ranks ceil(s*total/shards) up to ceil((s+1)*total/shards): sizes differ by at most one
    shard = F.expr(f"cast((rank * {shards}) div total as int)")
    first = F.expr("(shard * total + %d) div %d" % (shards - 1, shards))
    return (ranked.withColumn("shard", shard).withColumn("slot", F.col("rank") - first)
            .drop("run", "at", "start", "total", "rank", "tie", "uid"))


def shard_documents(documents: DataFrame, shards: int = 16) -> DataFrame:
    """Shards of ``documents``: doc_id, size, text_crc32, law, shard, slot, grown_shard, hilbert."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = documents.select("doc_id", "lang", "source", (F.octet_length(text) + 1).cast("long").alias("size"),
                            F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"))
    dims = {"lang": leading_number(F.col("lang")), "source": leading_number(F.col("source")),
            "size": F.col("size"), "doc_id": F.col("doc_id")}
    out = hilbert_shards(rows, dims, shards, F.col("doc_id"))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"), "hilbert")
