"""Sinks: audit overwrite, flagged write-once, upserts, views.

Two upsert layouts:

* ``upsert_partitioned`` for large tables: the table is partitioned (hash
  bucket of the key, or a date) and an upsert rewrites only the partitions
  the batch touches;
* ``upsert_table`` for small tables (dimensions, per-agent facts): each
  upsert writes a full new ``_version``.

Tables live as parquet directories under the root that the conf
``callstar.warehouse`` names. A versioned table has a folder for each
``_version``; each upsert writes the next one and readers take the newest that
was finished. Durable tables never fall back to a scratch
folder: the warehouse must be named. Writing a new version instead of overwriting
in place avoids reading and writing the same files in one job, and a failed
write leaves the previous version untouched. A partitioned table is changed by
staging whole partitions beside it and moving their folders in behind a written
intent, so a swap that fails half way is finished by the next run.
"""

from __future__ import annotations

import json
import os
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callstar.operators import quality as Q
from callstar.operators.upsert import upsert
from callstar.session import CODEC, checkpoint_root

VERSION_COL = "_version"
BUCKET_COL = "_bucket"
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
#: Folder beside a table's partitions that holds the swaps under way.
INTENTS = "_intents"
#: Folder beside them in which the next ones are written (in the table's file system, so that they can be moved in).
STAGED = "_staged"
#: Rows of at most so many partitions are written where they are: a task then opens so many files at most.
FEW = 4
#: Folders that the driver moves at once.
MOVES = 8


def warehouse_root(spark: SparkSession) -> str:
    root = spark.conf.get("callstar.warehouse", None)
    if not root:
        raise RuntimeError("set callstar.warehouse to the folder that holds the stored tables")
    return root


def table_path(spark: SparkSession, layer: str, table: str) -> str:
    return os.path.join(warehouse_root(spark), layer, table)


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p)


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _children(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    return sorted(str(f.getPath()) for f in fs.listStatus(p)) if fs.exists(p) else []


def _has_data(spark: SparkSession, path: str) -> bool:
    """Whether a table holds files or partitions (its notes, and what a failed first write left, do not count)."""
    names = (os.path.basename(c) for c in _children(spark, path))
    return any("=" in n or not n.startswith(("_", ".")) for n in names)


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, whole or not at all."""
    fs, p = _fs(spark, path)
    part = p.suffix(".part")
    out = fs.create(part, True)
    out.write(bytearray(text.encode()))
    out.close()
    fs.rename(part, p)


def _read_text(spark: SparkSession, path: str) -> str | None:
    """Text of a small file; None for one that was not finished."""
    fs, p = _fs(spark, path)
    if path.endswith(".part"):
        return None
    stream = fs.open(p)
    text = bytes(stream.readAllBytes()).decode()
    stream.close()
    return text


def overwrite(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    w = df.write.mode("overwrite").option("compression", CODEC)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_flagged(flagged: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """Compute a flagged frame once, split by verdict on disk.

    Returns (valid, rejected) frames read back from the written dataset, so
    later writes and counters do not re-run the cleaning lineage.
    """
    overwrite(flagged, path, [Q.VERDICT])
    spark = flagged.sparkSession
    back = spark.read.schema(flagged.schema).parquet(path)  # explicit: an empty batch writes no files
    return (back.filter(F.col(Q.VERDICT) == Q.OK).drop(Q.VERDICT),
            back.filter(F.col(Q.VERDICT) != Q.OK))


def _versions(spark: SparkSession, path: str) -> list[int]:
    """Versions of a versioned table, oldest first. A version without its success mark was not finished and does not count."""
    folders = [c for c in _children(spark, path) if os.path.basename(c).startswith(f"{VERSION_COL}=")]
    whole = [f for f in folders if _exists(spark, os.path.join(f, "_SUCCESS"))]
    return sorted(int(os.path.basename(f).split("=", 1)[1]) for f in whole or folders)


def _write_version(rows: DataFrame, path: str) -> None:
    """Write ``rows`` (also none) as the next version, in a folder of its own."""
    versions = _versions(rows.sparkSession, path)
    rows.write.mode("overwrite").option("compression", CODEC).parquet(os.path.join(path, f"{VERSION_COL}={(versions or [0])[-1] + 1}"))


def read_current(spark: SparkSession, path: str) -> DataFrame | None:
    """Current rows of a stored table (None if never written): the newest whole
    ``_version`` of a versioned table, or a partitioned table without its
    internal bucket column."""
    if not _has_data(spark, path):
        return None
    versions = _versions(spark, path)
    if versions:
        return spark.read.parquet(os.path.join(path, f"{VERSION_COL}={versions[-1]}"))
    return spark.read.parquet(path).drop(BUCKET_COL)


def _staged(source: DataFrame, keys: list[str]) -> tuple[DataFrame, str]:
    """``source`` computed once into the shared staging folder; two rows of one key are refused, as a MERGE does."""
    spark = source.sparkSession
    path = os.path.join(checkpoint_root(spark), "_staging", "source", uuid.uuid4().hex)
    source.write.option("compression", CODEC).parquet(path)
    back = spark.read.schema(source.schema).parquet(path)
    try:
        _refuse_twice(back, keys)
    except ValueError:
        _delete(spark, path)
        raise
    return back, path


def _refuse_twice(source: DataFrame, keys: list[str]) -> None:
    keyed = source.dropna(subset=keys)
    if any(isinstance(source.schema[k].dataType, T.StringType) for k in keys):  # a number of 64 bits moves for each row; texts only where one comes twice
        hashed = keyed.groupBy(F.xxhash64(*keys).alias("hash")).agg(F.count(F.lit(1)).alias("rows"))
        if not hashed.filter(F.col("rows") > 1).limit(1).collect():
            return
    twice = keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 1).limit(1).collect()
    if twice:
        raise ValueError(f"the source holds a key twice: {twice[0].asDict()}")


def _layout(spark: SparkSession, path: str, layout: str | None, create: bool) -> None:
    """Keep the layout (bucket count or width) beside a table and refuse another one later."""
    if layout is None:
        return
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(os.path.join(path, "_layout"))
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if create or not fs.exists(p):
        out = fs.create(p, True)
        out.writeUTF(layout)
        out.close()
        return
    stream = fs.open(p)
    stored = stream.readUTF()
    stream.close()
    if stored != layout:
        raise ValueError(f"{path} is laid out as {stored}, not as {layout}")


def upsert_table(source: DataFrame, path: str, keys: list[str], remove: DataFrame | None = None) -> DataFrame:
    """MERGE ``source`` into the table at ``path`` by writing a new version; rows that match ``remove`` go first."""
    spark = source.sparkSession
    source, staged = _staged(source, keys)
    current = read_current(spark, path)
    if current is not None and remove is not None:
        current = current.join(remove, remove.columns, "left_anti")
    _write_version(source if current is None else upsert(current, source, keys), path)
    _delete(spark, staged)
    return read_current(spark, path)


def replace_table(rows: DataFrame, path: str) -> DataFrame:
    """Write ``rows`` as the new version of a versioned table: nothing of the version before stays."""
    _write_version(rows, path)
    return read_current(rows.sparkSession, path)


# -- partitioned upsert --------------------------------------------------------


@dataclass
class Swap:
    """Partitions of a table that wait, merged, in a staging folder to take the place of the stored ones."""

    path: str
    staging: str
    partition_col: str
    values: list  # partition values as text; None is the NULL partition
    staged: list | None = None  # names of the partition folders in ``staging`` when it was whole
    schema: str | None = None  # of the staged rows, in intents of older runs, whose staging may lie in another file system


def prepare_upsert(source: DataFrame, path: str, keys: list[str], partition_col: str, partition_expr=None,
                   key_determines_partition: bool = False, layout: str | None = None,
                   remove: DataFrame | None = None, live: list | None = None,
                   stored: bool = False, replaces: bool = False) -> Swap | None:
    """Merge ``source`` into the partitions it touches, in a staging folder; the table stays as it is.

    Touched partitions = partitions of the incoming rows, plus (unless the
    partition is a function of the key, e.g. a hash bucket) the partitions
    where the incoming keys, and the rows to ``remove``, currently live, so a
    row whose partition value changed is removed from its old partition. That
    second set is ``live`` (from an index), or found by scanning only the key
    and partition columns. The touched values, at most one per partition, are
    the only thing brought to the driver; they become a static partition
    filter on the target. ``remove`` holds values of some target columns:
    stored rows that have them go; with ``replaces`` every stored row of an
    incoming key is among them. The source is computed once (``stored``: it is
    a projection of written files and not written again); two rows of
    one key raise; ``layout`` names the bucket rule and is kept with the table.
    None if there is nothing to do.
    """
    spark = source.sparkSession
    source_path = None
    if stored:
        _refuse_twice(source, keys)
    else:
        source, source_path = _staged(source, keys)
    src = source if partition_expr is None else source.withColumn(partition_col, partition_expr)
    staging = os.path.join(path, STAGED, uuid.uuid4().hex)
    as_text = F.col(partition_col).cast("string").alias("value")
    touched = src.select(as_text)
    if not _has_data(spark, path):
        values, merged, gathered = [r[0] for r in touched.distinct().collect()], src, False
    else:
        _layout(spark, path, layout, create=False)
        target = spark.read.parquet(path)
        if live is None and not key_determines_partition:
            touched = touched.unionByName(target.join(src.select(*keys).distinct(), keys, "left_semi").select(as_text))
        if live is None and remove is not None:
            touched = touched.unionByName(target.join(remove, remove.columns, "left_semi").select(as_text))
        values = [r[0] for r in touched.distinct().collect()]  # bounded by the number of partitions
        values += [v for v in live or [] if v not in values]
        old = target.filter(_in_partitions(target, partition_col, values))
        src = src.select(*target.columns)
        gathered = key_determines_partition and partition_expr is not None and (remove is None or remove.columns == keys)
        if gathered:
            merged = _merged(old, src, keys, partition_col, None if remove is None else remove.withColumn(partition_col, partition_expr))
        else:
            if remove is not None:
                old = old.join(remove, remove.columns, "left_anti")
            merged = old.unionByName(src) if replaces else upsert(old, src, keys)
    if not values:
        if source_path is not None:
            _delete(spark, source_path)
        return None
    values = [None if v is None else _path_value(v) for v in values]
    if not _has_data(spark, path):
        _layout(spark, path, layout, create=True)
    overwrite(merged if gathered or len(values) <= FEW else _by_partition(merged, partition_col), staging, [partition_col])
    if source_path is not None:
        _delete(spark, source_path)
    return Swap(path, staging, partition_col, values, _partitions(spark, staging))


def _partitions(spark: SparkSession, path: str) -> list[str]:
    """Names of the partition folders in a folder."""
    return [n for n in map(os.path.basename, _children(spark, path)) if "=" in n]


def _merged(old: DataFrame, src: DataFrame, keys: list[str], partition_col: str, gone: DataFrame | None) -> DataFrame:
    """``upsert`` of whole partitions that the key determines, without the rows of the keys in ``gone``, for one shuffle of each row.

    Old, incoming and removed rows of a partition meet in one task and are
    told by a mark; of a key, an old row stays if nothing else has come.
    Rows with a NULL in the key match nothing and stay.
    """
    rows = old.withColumn("_mark", F.lit(0)).unionByName(src.withColumn("_mark", F.lit(1)))
    if gone is not None:
        rows = rows.unionByName(gone.withColumn("_mark", F.lit(2)), allowMissingColumns=True)
    newest = F.max("_mark").over(Window.partitionBy(partition_col, *keys))
    unkeyed = F.lit(False)
    for k in keys:
        unkeyed = unkeyed | F.col(k).isNull()
    rows = rows.repartition(partition_col).withColumn("_newest", newest)
    return rows.filter((F.col("_mark") == 1) | ((F.col("_mark") == 0) & (unkeyed | (F.col("_newest") == 0)))).select(*old.columns)


def commit(spark: SparkSession, swaps: list[Swap | None]) -> None:
    """Put staged partitions in their places: all of ``swaps``, or after a failure whatever ``recover`` finds left of them.

    The intent (tables, staging folders, partition values) is written first
    and removed last, beside the first table. Every step can be done again:
    a staged partition that is no longer in its staging folder is in its place.
    """
    swaps = [s for s in swaps if s is not None]
    if not swaps:
        return
    intent = os.path.join(swaps[0].path, INTENTS, f"{uuid.uuid4().hex}.json")
    _write_text(spark, intent, json.dumps([asdict(s) for s in swaps]))
    _finish(spark, intent, swaps)


def recover(spark: SparkSession, path: str) -> int:
    """Finish the swaps that an earlier run began beside ``path``; returns their number."""
    done = 0
    for intent in _children(spark, os.path.join(path, INTENTS)):
        text = _read_text(spark, intent)
        if text is None:  # the run ended while it wrote the intent: no partition has been touched
            _delete(spark, intent)
            continue
        _finish(spark, intent, [Swap(**s) for s in json.loads(text)])
        done += 1
    return done


def _finish(spark: SparkSession, intent: str, swaps: list[Swap]) -> None:
    for swap in swaps:
        _swap(spark, swap)
    _delete(spark, intent)
    for swap in swaps:
        _delete(spark, swap.staging)


def _swap(spark: SparkSession, swap: Swap) -> None:
    """Move the staged partitions of ``swap`` to the places of the stored ones; partitions that the merge emptied go."""
    left = set(_partitions(spark, swap.staging))
    folders = {f"{swap.partition_col}={NULL_PARTITION if v is None else v}" for v in swap.values}
    if swap.staged is None:  # an older run's: written again, which leaves the staging whole
        if left:
            data = spark.read.schema(T.StructType.fromJson(json.loads(swap.schema))).parquet(swap.staging)
            (_by_partition(data, swap.partition_col).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy(swap.partition_col).parquet(swap.path))
        for folder in folders - left:
            _delete(spark, os.path.join(swap.path, folder))
        return

    def move(folder: str) -> None:
        fs, place = _fs(spark, os.path.join(swap.path, folder))
        fs.delete(place, True)
        if not fs.rename(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(os.path.join(swap.staging, folder)), place):
            raise OSError(f"{folder} could not be moved from {swap.staging} to {swap.path}")

    with ThreadPoolExecutor(MOVES) as pool:
        list(pool.map(move, [f for f in swap.staged if f in left]))
    for folder in folders - set(swap.staged):
        _delete(spark, os.path.join(swap.path, folder))
    spark.catalog.refreshByPath(swap.path)


def upsert_partitioned(source: DataFrame, path: str, keys: list[str], partition_col: str, partition_expr=None,
                       key_determines_partition: bool = False, layout: str | None = None,
                       remove: DataFrame | None = None, live: list | None = None, stored: bool = False) -> DataFrame | None:
    """MERGE ``source`` into a partitioned parquet table, rewriting only the partitions it touches.

    The merged partitions are staged beside the table (lineage cut), then
    their folders are moved in. A failure before the swap
    leaves the table untouched; one during the swap leaves an intent, which
    the next upsert (or ``recover``) finishes first. See ``prepare_upsert``.
    """
    spark = source.sparkSession
    recover(spark, path)
    commit(spark, [prepare_upsert(source, path, keys, partition_col, partition_expr, key_determines_partition, layout, remove, live, stored)])
    return spark.read.parquet(path) if _has_data(spark, path) else None


def _in_partitions(table: DataFrame, partition_col: str, values: list):
    """A static partition filter from values as text."""
    kind = table.schema[partition_col].dataType
    cond = F.col(partition_col).isin([F.lit(v).cast(kind) for v in values if v is not None])
    return cond | F.col(partition_col).isNull() if None in values else cond


# -- where the rows of a ticket live ---------------------------------------------


def index_add(spark: SparkSession, path: str, rows: DataFrame, key: str, place: str, width: int) -> None:
    """Note in the index at ``path`` that rows of ``key`` live in partition ``place`` (columns of ``rows``).

    The index is partitioned by range of the key. It only grows, and only by
    pairs it does not hold: a row that moved leaves its old pair behind, which
    costs a reader one more partition and never a row. Write it before the
    table, so that no row is stored without its pair.
    """
    pairs = rows.select(F.col(key), F.col(place).cast("string").alias("place"), range_bucket(key, width)).filter(F.col(key).isNotNull())
    if _has_data(spark, path):  # new pairs and known ones meet in one aggregation
        known = spark.read.schema(_index_schema(rows, key)).parquet(path)
        known = known.filter(F.col(BUCKET_COL).isin(_buckets(pairs)))
        both = pairs.withColumn("known", F.lit(False)).unionByName(known.withColumn("known", F.lit(True)))
        pairs = both.groupBy(pairs.columns).agg(F.bool_or("known").alias("known")).filter("NOT known").drop("known")
    else:
        pairs = pairs.distinct()
    _by_partition(pairs, BUCKET_COL).write.mode("append").option("compression", CODEC).partitionBy(BUCKET_COL).parquet(path)


def _index_schema(rows: DataFrame, key: str) -> T.StructType:
    return T.StructType([rows.schema[key], T.StructField("place", T.StringType()), T.StructField(BUCKET_COL, T.LongType())])


def _buckets(rows: DataFrame) -> list:
    return [r[0] for r in rows.select(BUCKET_COL).distinct().collect()]  # at most one value per partition of the index


def places(spark: SparkSession, path: str, keys: DataFrame, width: int) -> list[str | None]:
    """Partitions in which rows of ``keys`` (one column) may live, by the index at ``path``."""
    key = keys.columns[0]
    if not _has_data(spark, path):
        return []
    index = spark.read.schema(_index_schema(keys, key)).parquet(path)
    index = index.filter(F.col(BUCKET_COL).isin(_buckets(keys.select(range_bucket(key, width)))))
    return [r[0] for r in index.join(keys, key, "left_semi").select("place").distinct().collect()]  # at most one per partition


def rows_of(spark: SparkSession, path: str, found: list[str | None], keys: DataFrame, partition_col: str) -> DataFrame | None:
    """Stored rows of ``keys``, read from the partitions ``found`` (by the index) and from no other."""
    if not _has_data(spark, path):
        return None
    table = spark.read.parquet(path)
    return table.filter(_in_partitions(table, partition_col, found)).join(keys, keys.columns[0], "left_semi").drop(BUCKET_COL)


def _by_partition(df: DataFrame, partition_col: str) -> DataFrame:
    """Rows of a partition together, so that a write opens few files; Spark splits large partitions."""
    return df.hint("rebalance", partition_col)


def in_buckets(spark: SparkSession, path: str, buckets: DataFrame) -> DataFrame | None:
    """Stored rows of the partitions that ``buckets`` lists (one value per partition comes to the driver); None without a table."""
    if not _has_data(spark, path):
        return None
    values = [r[0] for r in buckets.distinct().collect()]
    return spark.read.parquet(path).filter(F.col(BUCKET_COL).isin(values)).drop(BUCKET_COL)


def vacuum_versions(spark: SparkSession, path: str, keep: int = 2) -> list[int]:
    """Remove all but the newest ``keep`` versions of a versioned table."""
    versions = _versions(spark, path)
    old = versions[:-keep] if keep > 0 else versions
    for v in old:
        _delete(spark, os.path.join(path, f"{VERSION_COL}={v}"))
    return old


def _path_value(v) -> str:
    text = str(v)
    if not all(ch.isalnum() or ch in "-_." for ch in text):
        raise ValueError(f"partition value needs path escaping: {text!r}")
    return text


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(p):
        fs.delete(p, True)


def range_bucket(key: str, width: int):
    """Bucket id = key // width, for ever-increasing ids: a batch of new
    records lands in the newest buckets, so an upsert rewrites only those."""
    return F.floor(F.col(key) / F.lit(width)).cast("long").alias(BUCKET_COL)


def hash_bucket(keys: list[str], buckets: int):
    """Bucket id as a pure function of the key (for ``upsert_partitioned``)."""
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int").alias(BUCKET_COL)


def publish_views(spark: SparkSession, views: dict[str, DataFrame]) -> None:
    """One-to-one published views (session scope)."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)
