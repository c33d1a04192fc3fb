"""Helpers shared by the operators of this package: staging, Arrow text views, word hashes."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callstar.session import checkpoint_root

#: Bytes of text that the vectorised word hasher handles at once.
SLICE = 1 << 20
#: Bytes of an Arrow batch between Spark and a worker, beside its last row.
BATCH_BYTES = 4 << 20


def bounded_batches(spark: SparkSession) -> None:
    """From now on Arrow batches are cut by bytes as well as by rows, so that long texts do not add up in a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    This cuts the lineage: a lost executor recomputes from these files, and
    values that depend on the row order of one evaluation (row ids) stay fixed.
    """
    spark = df.sparkSession
    path = f"{checkpoint_root(spark).rstrip('/')}/llm/{tag}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unstage(df: DataFrame) -> None:
    """Remove what ``stage`` wrote for ``df`` (its direct result), once all that was read from it is written."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: Bytes of file names up to which the list of files is broadcast (about 200,000 files).
FILE_LIST_BYTES = 32 << 20
#: Bits of a row id that hold the row's place in its file.
ROW_BITS = 36


def with_row_id(df: DataFrame, name: str) -> DataFrame:
    """A unique row number that is data: the file's rank by name, and the row's place in the file.

    It does not depend on how Spark splits the scan, so every job and every
    retry sees the same numbers, whatever the cluster's size at that moment.
    Use it on scans, also with filters and projections, not on joins, which
    repeat rows. A frame that is not a Parquet scan, or one of more files than
    ``FILE_LIST_BYTES`` allows, is written once with its numbers and read back.
    """
    bounded_batches(df.sparkSession)
    place = fresh(df, name + "_file")
    try:
        files = df.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index")).select("file").distinct()
        few = files.agg(F.coalesce(F.sum(F.length("file")), F.lit(0))).first()[0] <= FILE_LIST_BYTES
    except AnalysisException:
        few = False
    if not few:
        return stage(df.withColumn(name, F.monotonically_increasing_id()), "rows")
    ranks = [(path, k) for k, path in enumerate(sorted(r[0] for r in files.collect()))]
    ranks = df.sparkSession.createDataFrame(ranks, f"{place} string, {name} long")
    row = fresh(df, name + "_row")
    rows = df.select("*", F.col("_metadata.file_path").alias(place), F.col("_metadata.row_index").alias(row))
    if name in df.columns:
        rows = rows.drop(name)
    rows = rows.join(F.broadcast(ranks), place)
    return rows.withColumn(name, F.shiftleft(F.col(name), ROW_BITS) + F.col(row)).drop(place, row)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name += "_"
    return name


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a text column without copying values; null counts as empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return offsets, data


def spans(offsets: np.ndarray, size: int, most: int = 1 << 62) -> Iterator[tuple[int, int]]:
    """Ranges of at most ``most`` rows, of at most ``size`` bytes together (a longer row stands alone)."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + size, side="right")) - 1)
        hi = min(hi, n, lo + most)
        yield lo, hi
        lo = hi


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply rounds)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


#: Bits of a Bloom filter that a key sets.
PROBES = 4


def probes(key: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    """Places of the keys in a Bloom filter of ``bits`` (a power of two)."""
    a, b = key, mix(key) | np.uint64(1)
    for k in range(PROBES):
        yield (a + np.uint64(k) * b) & np.uint64(bits - 1)


def passes(table: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Which keys the Bloom filter ``table`` lets through."""
    ok = np.ones(len(key), bool)
    for bit in probes(key, len(table) << 6):
        ok &= (table[bit >> np.uint64(6)] >> (bit & np.uint64(63))) & np.uint64(1) == 1
    return ok


_STEP = 0x9E3779B97F4A7C15
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_STEP))
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: For plain words: every ASCII character but letters and digits is a gap.
PUNCTUATION = np.array([b < 128 and not (48 <= b < 58 or 65 <= b < 91 or 97 <= b < 123) for b in range(256)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}
BASE = 0xD6E8FEB86659FD93


def _power(n: int, base: int = BASE) -> tuple[np.ndarray, np.ndarray]:
    if base not in _powers or len(_powers[base][0]) < n:
        both = []
        for r in (base, pow(base, -1, 1 << 64)):
            steps = np.full(max(n, SLICE + 4096), r, np.uint64)
            steps[0] = 1
            both.append(np.cumprod(steps, dtype=np.uint64))
        _powers[base] = tuple(both)
    return _powers[base]


def word_hashes(data: np.ndarray, gap: np.ndarray = _SPACE, base: int = BASE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and 64-bit hash of each word of a byte run.

    Words are maximal runs of bytes other than blank, tab, newline, vertical
    tab, form feed and return (or those that ``gap`` marks); A-Z count as a-z. Runs are cut at white space
    into slices, so memory does not grow with the length of a text.
    """
    out, at, n = [], 0, len(data)
    while at < n:
        to = min(n, at + SLICE)
        while to < n:  # on to the next white space
            found = np.flatnonzero(gap[data[to:to + 65536]])
            if len(found):
                to += int(found[0])
                break
            to = min(n, to + 65536)
        low = _LOWER[data[at:to]]
        inside = np.zeros(len(low) + 2, np.int8)
        inside[1:-1] = ~gap[low]
        edge = np.diff(inside)
        start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        up, down = _power(len(low) + 1, base)
        total = np.zeros(len(low) + 1, np.uint64)
        np.cumsum(_BYTE[low] * up[:len(low)], out=total[1:])
        h = mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))
        out.append((start + at, end + at, h))
        at = to
    if not out:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*out))


def blank_joined(offsets: np.ndarray, data: np.ndarray, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of rows ``lo`` to ``hi`` with a blank after each, and where each row ends in them."""
    lens = np.diff(offsets[lo:hi + 1])
    ends = np.cumsum(lens + 1)
    keep = np.ones(int(ends[-1]), bool)
    keep[ends - 1] = False
    buf = np.full(len(keep), 32, np.uint8)
    buf[keep] = data[offsets[lo]:offsets[hi]]
    return buf, ends


def row_words(offsets: np.ndarray, data: np.ndarray, gap: np.ndarray = _SPACE, size: int = SLICE) -> Iterator[tuple[int, list[np.ndarray]]]:
    """For ranges of rows: the first row, and the word hashes of each row in it.

    A row's end is a word's end, so words never join across rows.
    """
    for lo, hi in spans(offsets, size):
        if hi - lo == 1:
            yield lo, [word_hashes(data[offsets[lo]:offsets[hi]], gap)[2]]
            continue
        buf, ends = blank_joined(offsets, data, lo, hi)
        start, _, h = word_hashes(buf, gap)
        cut = np.searchsorted(start, ends)
        yield lo, np.split(h, cut[:-1])
