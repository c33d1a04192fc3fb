"""Exact dedup with composable polynomial fingerprints.

A text's fingerprint is the polynomial of its UTF-8 bytes in two bases modulo
two primes, plus its length. Chunks combine by a length shift
(``f(AB) = f(A) + r**len(A) * f(B)``), so the chunks of a huge text are hashed
as rows of their own, anywhere, and a plain sum combines them. Rows with equal
fingerprints are then compared with the group's representative, chunk by
chunk, on the real bytes; a row that differs (a collision) is grouped by its
whole text instead, so the result never rests on the hash.

Defined cases: null text equals the empty text; the row with the largest
doc_id of a group stays (null ids are smallest); of repeated rows with that id
exactly one stays; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callstar.llm.common import SLICE, spans, stage, utf8, with_row_id

#: Bytes of a chunk; texts above it are hashed as several rows.
CHUNK = 1 << 16
#: Rows of a group that are compared in one task with one copy of the representative.
COMPARED_TOGETHER = 256
MODULI = ((2147483647, 1103515245), (2147483629, 69069069))
_tables: dict[int, np.ndarray] = {}


def powers(base: int, modulus: int, n: int) -> np.ndarray:
    have = _tables.get(modulus)
    if have is None or len(have) < n:
        size = 1 << max(16, (n - 1).bit_length())
        have = np.ones(1, np.uint64)
        while len(have) < size:  # doubling
            have = np.concatenate([have, have * np.uint64(pow(base, len(have), modulus)) % np.uint64(modulus)])
        _tables[modulus] = have
    return have


def chunk_hashes(offsets: np.ndarray, data: np.ndarray, shift: np.ndarray) -> list[np.ndarray]:
    """Polynomial hash of each byte run, times ``base**shift``: one array per modulus."""
    out = [np.zeros(len(shift), np.int64) for _ in MODULI]
    for lo, hi in spans(offsets, 2 * SLICE):
        lens = np.diff(offsets[lo:hi + 1])
        run = data[offsets[lo]:offsets[hi]].astype(np.uint64) + np.uint64(1)
        begin = offsets[lo:hi] - offsets[lo]
        place = np.arange(len(run)) - np.repeat(begin, lens)
        full = lens > 0
        for k, (p, r) in enumerate(MODULI):
            term = run * powers(r, p, int(lens.max(initial=1)) + 1)[place] % np.uint64(p)
            h = np.zeros(hi - lo, np.uint64)
            if full.any():
                h[full] = np.add.reduceat(term, begin[full])
            moved = np.fromiter((pow(r, int(s), p) if s else 1 for s in shift[lo:hi]), np.uint64, hi - lo)
            out[k][lo:hi] = (h % np.uint64(p) * moved % np.uint64(p)).astype(np.int64)
    return out


def _hash_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        offsets, data = utf8(b.column("bytes"))
        h = chunk_hashes(offsets, data, b.column("start").to_numpy(zero_copy_only=False))
        keep = [n for n in b.schema.names if n not in ("bytes", "start")]
        yield pa.RecordBatch.from_arrays([b.column(n) for n in keep] + [pa.array(x) for x in h], [*keep, "f1", "f2"])


def _chunks(size: Column, chunk: int) -> Column:
    """Start of each chunk; one for the empty text."""
    return F.sequence(F.lit(0).cast("long"), F.greatest(F.ceil(size / chunk) - 1, F.lit(0)).cast("long"))


def fingerprints(rows: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """uid, doc_id, n_bytes, sha, f1, f2 for rows of uid, doc_id, bytes."""
    rows = rows.select("uid", "doc_id", F.octet_length("bytes").cast("long").alias("n_bytes"), "bytes")
    schema = "uid long, doc_id long, n_bytes long, sha string, f1 long, f2 long"
    sha = F.sha2("bytes", 256).alias("sha")
    short = (rows.filter(F.col("n_bytes") <= chunk)
             .select("uid", "doc_id", "n_bytes", sha, "bytes", F.lit(0).cast("long").alias("start"))
             .mapInArrow(_hash_batches, schema))
    pieces = (rows.filter(F.col("n_bytes") > chunk)
              .select("uid", "doc_id", "n_bytes", sha, "bytes", F.explode(_chunks(F.col("n_bytes"), chunk)).alias("k"))
              .select("uid", "doc_id", "n_bytes", "sha", (F.col("k") * chunk).alias("start"),
                      F.expr(f"substring(bytes, cast(k * {chunk} + 1 as int), {chunk})").alias("bytes"))
              .repartition("uid", "start").mapInArrow(_hash_batches, schema))
    (p1, _), (p2, _) = MODULI
    long = pieces.groupBy("uid", "doc_id", "n_bytes", "sha").agg((F.sum("f1") % p1).alias("f1"), (F.sum("f2") % p2).alias("f2"))
    return short.unionByName(long)


def exact_groups(documents: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """One row per row of ``documents`` (a file scan): uid, doc_id, keep_id, group_size, kept, text_sha256."""
    rows = with_row_id(documents.select("doc_id", F.encode(F.coalesce(F.col("text"), F.lit("")), "UTF-8").alias("bytes")), "uid")
    print_key = ["n_bytes", "f1", "f2"]
    prints = stage(fingerprints(rows, chunk), "prints")
    # staged, so that the join below reads plain exchanges, which Spark splits where a group is hot
    groups = stage(prints.groupBy(*print_key).agg(F.count("*").alias("size"), F.max(F.struct("doc_id", "uid")).alias("top")), "groups")
    tagged = stage(prints.join(groups, print_key)
                   .select("uid", "doc_id", "n_bytes", "sha", "size", F.col("top.doc_id").alias("keep_id"), F.col("top.uid").alias("keep_uid")), "tagged")
    several = tagged.filter("size > 1").drop("doc_id")
    # bytes of those rows only; uid is unique on both sides, so no key is hot
    members = stage(rows.select("uid", "bytes").join(several.select("uid", "keep_uid", "size", "n_bytes"), "uid"), "members")
    parts = F.ceil(F.col("size") / COMPARED_TOGETHER).cast("int")
    at = F.explode(_chunks(F.col("n_bytes"), chunk))
    piece = F.expr(f"substring(bytes, cast(k * {chunk} + 1 as int), {chunk})").alias("piece")
    left = (members.filter("uid != keep_uid")
            .select("uid", "keep_uid", F.pmod(F.xxhash64("uid"), parts).cast("int").alias("part"), "bytes", at.alias("k"))
            .select("uid", "keep_uid", "part", "k", piece))
    right = (members.filter("uid = keep_uid")
             .select("keep_uid", "bytes", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"), "n_bytes")
             .select("keep_uid", "part", "bytes", at.alias("k")).select("keep_uid", "part", "k", piece.alias("model")))
    compared = (left.join(right, ["keep_uid", "part", "k"])
                .groupBy("uid").agg(F.min(F.col("piece") == F.col("model")).alias("same")))
    differs = stage(compared.filter(~F.col("same")).select("uid"), "differs")
    out = tagged.select("uid", "doc_id", "keep_id", "keep_uid", "size", "sha")
    if not differs.isEmpty():  # equal fingerprints, different texts: count them apart and group them by the text itself
        lost = tagged.join(differs, "uid").groupBy("keep_uid").agg(F.count("*").alias("lost"))
        agreed = (out.join(differs, "uid", "left_anti").join(lost, "keep_uid", "left")
                  .withColumn("size", F.col("size") - F.coalesce("lost", F.lit(0))).drop("lost"))
        apart = members.select("uid", "bytes").join(differs, "uid").join(out.select("uid", "doc_id", "sha"), "uid")
        own = apart.groupBy("bytes").agg(F.count("*").alias("size"), F.max(F.struct("doc_id", "uid")).alias("top"))
        apart = apart.join(own, "bytes").select("uid", "doc_id", F.col("top.doc_id").alias("keep_id"),
                                                F.col("top.uid").alias("keep_uid"), "size", "sha")
        out = agreed.unionByName(apart)
    return out.select("uid", "doc_id", "keep_id", F.col("size").alias("group_size"),
                      (F.col("uid") == F.col("keep_uid")).alias("kept"), F.col("sha").alias("text_sha256"))
