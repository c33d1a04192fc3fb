"""Multi-party perspective rotation of dialogues.

For every participant of a conversation the dialogue is rendered with that
speaker as the assistant and the others as named users; the mask marks what a
model is to learn: the assistant's words and its closing mark. System turns
are instructions, kept as they are in every rendering and rotated for nobody.

One row holds at most a block of turns, so a conversation of any length never
meets in one row or task: blocks follow the turn numbers (``BLOCK`` each), and
a block in which many rows share turn numbers is split further. Putting the
blocks of a rendering together in order gives the whole rendering.

Defined cases: a null text is empty, a null role is the speaker ``unknown``; a
null turn sorts first; repeated rows (same conversation, turn, role and text)
are rendered once; rows with the same turn are ordered by role and text; a
conversation with system turns only has no participant and gives no row; marks
inside a text are broken up; very long texts are rendered whole; other columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Turn numbers that share a block.
BLOCK = 64
#: Rows of a block above which it is split by turn and hash.
BLOCK_ROWS = 1024
SYSTEM = "system"


def rotate(conversations: DataFrame, block: int = BLOCK, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """conv_id, perspective, block, part, n_turns, rendered, mask, n_masked."""
    turns = (conversations.select(
        "conv_id", "turn", F.coalesce("role", F.lit("unknown")).alias("role"),
        F.regexp_replace(F.coalesce("text", F.lit("")), r"<\|", "< |").alias("text")).distinct())
    turns = turns.withColumn("block", F.floor(F.coalesce(F.col("turn"), F.lit(-1)) / block).cast("long"))
    counts = (turns.groupBy("conv_id", "block").agg(F.count("*").alias("rows")).filter(F.col("rows") > block_rows)
              .select(F.col("conv_id").alias("c"), F.col("block").alias("b"), "rows"))
    # crowded blocks are rare: the left side splits when one of them is hot
    split = turns.join(counts, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("block") == F.col("b")), "left").drop("c", "b")
    high = F.expr("(cast(conv(substring(hex(encode(concat(role, char(1), text), 'UTF-8')), 1, 8), 16, 10) as double) / 4294967296)")
    split = split.withColumn("part", F.when(F.col("rows").isNull(), F.lit(0)).otherwise(
        (F.pmod(F.coalesce(F.col("turn"), F.lit(-1)), F.lit(block)) * 65536 + F.floor(high * F.least(F.ceil(F.col("rows") / block_rows), F.lit(65536)))).cast("long")).cast("long"))
    people = (turns.filter(F.col("role") != SYSTEM).select("conv_id", F.col("role").alias("perspective")).distinct()
              .withColumnRenamed("conv_id", "c"))
    seen = split.join(people, F.col("conv_id").eqNullSafe(F.col("c"))).drop("c", "rows")
    own = F.col("role") == F.col("perspective")
    head = (F.when(F.col("role") == SYSTEM, F.lit("<|im_start|>system\n")).when(own, F.lit("<|im_start|>assistant\n"))
            .otherwise(F.concat(F.lit("<|im_start|>user name="), F.regexp_replace("role", r"\s+|<\|", "_"), F.lit("\n"))))
    item = F.struct("turn", "role", "text", head.alias("head"), own.alias("own"))
    tail = "<|im_end|>\n"
    grouped = (seen.groupBy("conv_id", "perspective", "block", "part").agg(F.sort_array(F.collect_list(item)).alias("items")))
    # spans as an array of {start, end}; position runs along the rendering
    walk = F.expr(f"""aggregate(items, struct(cast(0 as long) as at, cast(array() as array<struct<a:long,b:long>>) as masked),
        (s, x) -> struct(s.at + char_length(x.head) + char_length(x.text) + {len(tail)} as at,
          if(x.own, array_append(s.masked, struct(s.at + char_length(x.head) as a,
             s.at + char_length(x.head) + char_length(x.text) + {len(tail) - 1} as b)), s.masked) as masked))""")
    rendered = F.expr("concat_ws('', transform(items, x -> concat(x.head, x.text, '<|im_end|>\\n')))")
    out = grouped.select("conv_id", "perspective", "block", "part", F.size("items").cast("long").alias("n_turns"),
                         rendered.alias("rendered"), walk.alias("walk"))
    return out.select("conv_id", "perspective", "block", "part", "n_turns", "rendered",
                      F.expr("concat_ws(',', transform(walk.masked, m -> concat(m.a, ':', m.b)))").alias("mask"),
                      F.expr("aggregate(walk.masked, cast(0 as long), (s, m) -> s + m.b - m.a)").alias("n_masked"))


ORACLE = f"""
WITH t AS (SELECT DISTINCT conv_id, turn, coalesce(role, 'unknown') AS role, replace(coalesce(text, ''), '<|', '< |') AS text FROM conversations),
p AS (SELECT DISTINCT conv_id, role AS perspective FROM t WHERE role <> '{SYSTEM}'),
s AS (SELECT t.conv_id, p.perspective, cast(floor(coalesce(turn, -1) / {BLOCK}.0) AS BIGINT) AS block, turn, t.role, text, t.role = p.perspective AS own,
  CASE WHEN t.role = '{SYSTEM}' THEN '<|im_start|>system' || chr(10) WHEN t.role = p.perspective THEN '<|im_start|>assistant' || chr(10)
  ELSE '<|im_start|>user name=' || regexp_replace(t.role, '\\s+|<\\|', '_', 'g') || chr(10) END AS head
  FROM t JOIN p ON t.conv_id IS NOT DISTINCT FROM p.conv_id),
w AS (SELECT *, sum(length(head) + length(text) + 11) OVER (PARTITION BY conv_id, perspective, block ORDER BY turn NULLS FIRST, role, text) - length(text) - 11 AS a FROM s)
SELECT conv_id, perspective, block, cast(0 AS BIGINT) AS part, count(*) AS n_turns,
  string_agg(head || text || '<|im_end|>' || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS rendered,
  coalesce(string_agg(cast(cast(a AS BIGINT) AS VARCHAR) || ':' || cast(cast(a + length(text) + 10 AS BIGINT) AS VARCHAR), ',' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE own), '') AS mask,
  cast(coalesce(sum(length(text) + 10) FILTER (WHERE own), 0) AS BIGINT) AS n_masked
FROM w GROUP BY conv_id, perspective, block
"""
