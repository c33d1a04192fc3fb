"""Keyed de-duplication.

``keep_latest`` is the deterministic variant (row_number over the key,
ordered newest first with a full tie-break). Spark plans ``row_number() = 1``
with a partial ``WindowGroupLimit`` *before* the shuffle, so a hot key is
cut to one row per map task before it moves: a key holding a third of the
rows costs no more shuffle than any other key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _desc(c) -> Column:
    if isinstance(c, Column):
        return c
    return F.col(c).desc_nulls_last()


_UNORDERABLE = tuple(t for t in (getattr(T, "MapType", None), getattr(T, "VariantType", None)) if t)


def _orderable(t: T.DataType) -> bool:
    """Whether Spark can sort by a column of this type (maps cannot)."""
    if isinstance(t, _UNORDERABLE):
        return False
    if isinstance(t, T.ArrayType):
        return _orderable(t.elementType)
    if isinstance(t, T.StructType):
        return all(_orderable(f.dataType) for f in t.fields)
    return True


def keep_latest(df: DataFrame, keys: list[str], order: list, tie_break_all: bool = True) -> DataFrame:
    """One row per key: the first by ``order`` (names sort DESC NULLS LAST).

    With ``tie_break_all`` every other column is appended to the order so
    the survivor never depends on task timing.
    """
    order_cols = [_desc(c) for c in order]
    if tie_break_all:
        named = {c for c in order if isinstance(c, str)}
        order_cols += [F.col(f.name).desc_nulls_last() for f in df.schema.fields
                       if f.name not in named and f.name not in keys and _orderable(f.dataType)]
    w = Window.partitionBy(*keys).orderBy(*order_cols)
    return (df.withColumn("_rn", F.row_number().over(w))
              .filter(F.col("_rn") == 1)
              .drop("_rn"))


def drop_duplicates_any(df: DataFrame, keys: list[str]) -> DataFrame:
    """Plain ``dropDuplicates``: an arbitrary survivor per key; NULL is one key.

    Planned as an aggregate with partial (map-side) combine.
    """
    return df.dropDuplicates(keys)
