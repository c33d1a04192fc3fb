"""Merkle dataset manifest: leaves, subroots, root and proofs built by aligned appends with incremental witnesses.

Each row is a leaf, each group (language) a binary tree over its leaves by
``doc_id``, and a tree over the groups gives the root. A block is
``2**LEVELS`` neighbouring nodes, aligned on their position. Its nodes are
appended in order: an append that completes a subtree extends the witness of
every member of both halves by the other half's digest, so no node is visited
again. The root of a block is one further append to the tier above, where
blocks of blocks are built the same way, on other executors, until one node
is left. A row's witness is its block's part, then the parts of the blocks
above it, looked up by position.

Memory is one block a task; a group of any size is spread over many blocks.

Defined cases: a null field is ``-`` (another one than the empty text); null
groups come first and are a group of their own; null ids sort first; rows that
agree in all fields are leaves of their own, in any order; an empty table gives
no row; columns that are not leaf fields are ignored. A changed row is folded
with the siblings of the unchanged data; ``n_chars`` beyond 64 bits counts on
in decimal.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from callstar.llm.common import stage

#: Levels of a block: 256 nodes.
LEVELS = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf(fields: dict[str, Column]) -> Column:
    """Digest of a row: every field with its length, so that no two rows share an encoding."""
    parts = []
    for value in fields.values():
        text = value.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def tampered() -> Column:
    """Rows whose n_chars a tamperer raises by one."""
    return F.coalesce(F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 7 == 0, F.lit(False))


def leaves(documents: DataFrame) -> DataFrame:
    """group, doc_id, leaf, changed: the leaf of each row, and of its tampered form where it is tampered with."""
    fields = {name: F.col(name) for name in FIELDS}
    more = fields | {"n_chars": F.col("n_chars").cast("decimal(20,0)") + 1}
    # the first character keeps null apart from every text and keeps the order of the bytes
    group = F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit("")).alias("group")
    return documents.select(group, "doc_id", leaf(fields).alias("leaf"), F.when(tampered(), leaf(more)).alias("changed"))


# -- positions ---------------------------------------------------------------

def _numbered(names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, k = None, 0
        for b in batches:
            numbers = []
            for g in b.column("group").to_pylist():
                k = k + 1 if g == group else 0
                group = g
                numbers.append(k)
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in names), pa.array(numbers, pa.int64())], [*names, "k"])
    return run


def positions(nodes: DataFrame, order: list[str]) -> DataFrame:
    """Adds position (from 0 in its group, by ``order``) and total (nodes of the group) to staged ``nodes``.

    Rows are dealt by ranges of group and order, so a group of any size is
    spread over many tasks; end ``order`` with a random column to spread rows
    that agree in all else.
    """
    keys = ["group", *order]
    dealt = nodes.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("run", F.spark_partition_id())
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in dealt.schema) + ", k long"
    ranked = stage(dealt.mapInArrow(_numbered(dealt.columns), schema), "ranked")
    runs = ranked.groupBy("group", "run").agg((F.max("k") + 1).alias("size"))  # a row for each group and partition
    before = Window.partitionBy("group").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = stage(runs.select("group", "run", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"),
                             F.sum("size").over(Window.partitionBy("group")).alias("total")), "runs")
    return (ranked.join(runs, ["group", "run"])
            .select(*nodes.columns, (F.col("base") + F.col("k")).alias("position"), "total"))


# -- one block ----------------------------------------------------------------

def _h(hexes: str) -> str:
    return sha256(hexes.encode()).hexdigest()


def height(total: int) -> int:
    """Levels from ``total`` nodes up to one."""
    return (total - 1).bit_length()


class Block:
    """Aligned append: open subtrees by level, each with the members whose witnesses still grow."""

    def __init__(self) -> None:
        self.witness: list[list[str]] = []
        self.open: list[tuple[int, int, str]] = []  # level, first member, digest

    def append(self, digest: str) -> None:
        level, first = 0, len(self.witness)
        self.witness.append([])
        while self.open and self.open[-1][0] == level:
            digest, first = self._join(self.open.pop(), digest, first)
            level += 1
        self.open.append((level, first, digest))

    def _join(self, left: tuple[int, int, str], digest: str, first: int) -> tuple[str, int]:
        """Both halves are complete: each member's witness gets the other half."""
        for k in range(left[1], first):
            self.witness[k].append(digest)
        for k in range(first, len(self.witness)):
            self.witness[k].append(left[2])
        return _h(left[2] + digest), left[1]

    def close(self, levels: int) -> str:
        """The digest ``levels`` above the members; the last run's lone node is hashed alone."""
        level, first, digest = self.open.pop()
        while level < levels:
            if self.open and self.open[-1][0] == level:
                digest, first = self._join(self.open.pop(), digest, first)
            else:
                digest = _h(digest)
            level += 1
        return digest


def _append_blocks(keep: list[str]):
    """Nodes sorted by group and position, block by block; a block's last member carries the block's root."""
    names = ["group", "position", "total", "digest", *keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows, block = None, [], Block()

        def finished() -> pa.RecordBatch:
            group, _, total = rows[0][:3]
            top = block.close(min(LEVELS, height(total)))
            columns = [pa.array(x, t) for x, t in zip(zip(*rows), types)]
            part = pa.array([bytes.fromhex("".join(w)) for w in block.witness], pa.binary())
            return pa.RecordBatch.from_arrays([*columns, part, pa.array([None] * (len(rows) - 1) + [top], pa.string())], [*names, "part", "top"])

        for b in batches:
            types = [b.schema.field(n).type for n in names]
            for row in zip(*(b.column(n).to_pylist() for n in names)):
                if (row[0], row[1] >> LEVELS) != key:
                    if rows:
                        yield finished()
                    key, rows, block = (row[0], row[1] >> LEVELS), [], Block()
                rows.append(row)
                block.append(row[3])
        if rows:
            yield finished()
    return run


def append_tiers(nodes: DataFrame, keep: list[str]) -> tuple[list[DataFrame], DataFrame]:
    """The tiers of blocks over ``nodes`` (group, position, total, digest and ``keep``), and group, digest at the top.

    A tier holds its nodes with ``part``, the witness inside the block; it is
    ``2**LEVELS`` times smaller than the tier below.
    """
    tiers = []
    while True:
        kept = keep if not tiers else []
        columns = ["group", "position", "total", "digest", *kept]
        block = F.shiftright("position", LEVELS)
        dealt = nodes.select(columns).repartition("group", block).sortWithinPartitions("group", "position")
        schema = ", ".join(f"`{n}` {dealt.schema[n].dataType.simpleString()}" for n in columns) + ", part binary, top string"
        tiers.append(stage(dealt.mapInArrow(_append_blocks(kept), schema), "blocks"))
        # a group that has come down to one node stays as it is: no level above, no sibling
        nodes = tiers[-1].filter("top is not null").select(
            "group", block.alias("position"), F.shiftright(F.col("total") + ((1 << LEVELS) - 1), LEVELS).alias("total"), F.col("top").alias("digest"))
        if nodes.filter("total > 1").isEmpty():
            return tiers, nodes.select("group", "digest")


def descend(tiers: list[DataFrame], top: DataFrame) -> DataFrame:
    """The lowest tier's nodes with their whole witness: siblings as raw bytes, lowest level first.

    ``top`` has a row for each group: group, witness (what continues above the
    group) and more columns, which every node of the group gets.
    """
    more = [c for c in top.columns if c not in ("group", "witness")]
    above = top.withColumn("up", F.lit(0).cast("long"))
    for tier in reversed(tiers):
        own = [c for c in tier.columns if c not in ("part", "top")]
        here = (tier.withColumn("up", F.shiftright("position", LEVELS)).join(above, ["group", "up"])
                .select(*own, F.concat("part", "witness").alias("witness"), *more))
        if tier is not tiers[0]:
            above = stage(here.select("group", F.col("position").alias("up"), "witness", *more), "witnesses")
    return here


# -- the manifest ---------------------------------------------------------------

def fold(digest: str, siblings: str, position: int, total: int) -> tuple[str, str]:
    """The digest that a tree of ``total`` nodes comes down to, and the siblings (hex, 64 digits each) not used."""
    while total > 1:
        if position ^ 1 < total:
            other, siblings = siblings[:64], siblings[64:]
            digest = _h(other + digest if position & 1 else digest + other)
        else:
            digest = _h(digest)
        position, total = position >> 1, (total + 1) >> 1
    return digest, siblings


#: Columns of the manifest.
OUT = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean, position long, witness binary"


def _proofs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        names = ("digest", "changed", "witness", "position", "total", "rank", "groups")
        proof, folded = [], []
        for digest, changed, witness, position, total, rank, groups in zip(*(b.column(n).to_pylist() for n in names)):
            siblings = witness.hex()
            proof.append(_h(siblings))
            subroot, rest = fold(changed or digest, siblings, position, total)
            folded.append(fold(subroot, rest, rank, groups)[0])
        folded = pa.array(folded, pa.string())
        columns = [b.column("doc_id"), b.column("digest"), b.column("subroot"), b.column("root"), pa.array(proof, pa.string()),
                   folded, pc.equal(folded, b.column("root")), b.column("position"), b.column("witness")]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified", "position", "witness"])


def manifest(documents: DataFrame) -> DataFrame:
    """One row per row: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified, position, witness."""
    rows = stage(leaves(documents).withColumn("spread", F.rand()), "leaves")
    nodes = positions(rows, ["doc_id", "leaf", "spread"]).withColumnRenamed("leaf", "digest")
    tiers, subroots = append_tiers(nodes, ["doc_id", "changed"])
    subroots = stage(subroots.select(F.lit("").alias("group"), F.col("group").alias("name"), "digest"), "subroots")
    over, root = append_tiers(positions(subroots, ["name"]), ["name"])
    root = root.select("group", F.lit(b"").alias("witness"), F.col("digest").alias("root"))
    top = descend(over, root).select(F.col("name").alias("group"), "witness", F.col("digest").alias("subroot"), "root",
                                     F.col("position").alias("rank"), F.col("total").alias("groups"))
    return descend(tiers, stage(top, "top")).mapInArrow(_proofs, OUT)


ORACLE = """
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce('=' || lang, '') AS g, n_chars, source, lang, text FROM documents),
enc AS (
  SELECT rid, doc_id, g, n_chars, list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
      lambda c, b: list_reduce(list_concat([xor(c, b)], range(8)), lambda v, k: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)) AS crc,
    coalesce(octet_length(encode(doc_id::VARCHAR))::VARCHAR || ':' || doc_id::VARCHAR, '-')
      || coalesce(octet_length(encode(source))::VARCHAR || ':' || source, '-') || coalesce(octet_length(encode(lang))::VARCHAR || ':' || lang, '-') AS head,
    coalesce(octet_length(encode(text))::VARCHAR || ':' || text, '-') AS tail FROM d),
leaves AS (
  SELECT rid, doc_id, g, sha256(head || coalesce(length(n_chars::VARCHAR)::VARCHAR || ':' || n_chars::VARCHAR, '-') || tail) AS leaf,
    CASE WHEN xor(crc, 4294967295) % 7 = 0
      THEN sha256(head || coalesce(length((n_chars + 1)::VARCHAR)::VARCHAR || ':' || (n_chars + 1)::VARCHAR, '-') || tail) END AS changed FROM enc),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY g) AS n FROM leaves),
tree(g, level, i, n, h) AS (
  SELECT g, 0, i, n, leaf FROM placed
  UNION ALL
  SELECT g, level + 1, i // 2, (any_value(n) + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM tree WHERE n > 1 GROUP BY g, level, i // 2),
subroots AS (
  SELECT g, h, row_number() OVER (ORDER BY encode(g)) - 1 AS i, count(*) OVER () AS n FROM tree WHERE n = 1),
crown(level, i, n, h) AS (
  SELECT 0, i, n, h FROM subroots
  UNION ALL
  SELECT level + 1, i // 2, (any_value(n) + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM crown WHERE n > 1 GROUP BY level, i // 2),
steps AS (
  SELECT p.rid, t.level, p.i >> t.level AS at, o.h AS other FROM placed p JOIN (SELECT DISTINCT g, level FROM tree WHERE n > 1) t ON t.g = p.g
    LEFT JOIN tree o ON o.g = p.g AND o.level = t.level AND o.i = xor(p.i >> t.level, 1)
  UNION ALL
  SELECT p.rid, 1000 + t.level, s.i >> t.level, o.h FROM placed p JOIN subroots s ON s.g = p.g CROSS JOIN (SELECT DISTINCT level FROM crown WHERE n > 1) t
    LEFT JOIN crown o ON o.level = t.level AND o.i = xor(s.i >> t.level, 1)),
numbered AS (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY level) AS step FROM steps),
folding(rid, step, h) AS (
  SELECT rid, 0, coalesce(changed, leaf) FROM placed
  UNION ALL
  SELECT f.rid, f.step + 1, sha256(CASE WHEN s.other IS NULL THEN f.h WHEN s.at % 2 = 1 THEN s.other || f.h ELSE f.h || s.other END)
  FROM folding f JOIN numbered s ON s.rid = f.rid AND s.step = f.step + 1),
folded AS (SELECT rid, arg_max(h, step) AS h FROM folding GROUP BY rid),
proofs AS (SELECT rid, sha256(coalesce(string_agg(other, '' ORDER BY step), '')) AS proof FROM numbered GROUP BY rid)
SELECT p.doc_id, p.leaf, s.h AS subroot, r.h AS root, coalesce(x.proof, sha256('')) AS proof_sha256, f.h AS folded_root, f.h = r.h AS verified
FROM placed p JOIN subroots s ON s.g = p.g CROSS JOIN (SELECT h FROM crown WHERE n = 1) r JOIN folded f ON f.rid = p.rid LEFT JOIN proofs x ON x.rid = p.rid
"""
