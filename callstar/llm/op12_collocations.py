"""Phrase collocations by set-oriented relational mining (SETM).

The relation of length 1 holds every word occurrence, sorted by piece and
position; it is written once. For each next length: the occurrences are
counted by group (phrase), the relation is semi-joined with the frequent
groups, and what is left is merge-joined with itself by piece and adjacent
position: two occurrences of length k that begin at neighbouring places and
share k-1 words are one occurrence of length k+1. That relation is written,
sorted again, and counted in turn. Rows of a relation are clustered by
document: a row holds one document's occurrences as sorted lists, so both
sides of the merge join are at hand wherever the row goes, and it needs no
shuffle. A place is a number that rises by one from word to word and by two
where a piece ends, so places are adjacent in one piece only.

Counts are combined in the task, then by Spark. The semi-join is a Bloom
filter of the frequent groups, of bounded size (``FILTER_BITS``): it may let a
rare group through, never lose a frequent one, and what it lets through falls
below the count of the next length, since a phrase is never more frequent
than its parts. Words travel as 64-bit hashes; the dictionary is checked, and
another hash base is taken if two words ever share a hash, so results are
exact.

Defined cases: null text is the empty text; null lang is "und"; null ids and
repeated rows count like others; a language without a candidate gives no row;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from callstar.llm.common import BATCH_BYTES, blank_joined, bounded_batches, mix, passes, probes, spans, stage, utf8, word_hashes

LEAST, LONGEST, REPORTED = 10, 3, 2000
#: A longer phrase this frequent, relative to a candidate inside it, replaces it.
COVERED_NUM, COVERED_DEN = 50, 100
#: Bits of a filter for each frequent group, and the most that a filter has (32 MB).
BITS_EACH, FILTER_BITS = 16, 1 << 28
#: Occurrences that a task counts at once.
COUNTED_TOGETHER = 1 << 22
#: Words (of a few documents each) that a task holds before it adds up their counts and passes them on.
HELD_WORDS = 1 << 19
#: Tasks' share of a language's ranking.
RANK_PARTS = 64
BREAKS = b".,;:!?\x0a\x0b\x0c\x0d"
_BREAK = np.zeros(256, bool)
_BREAK[list(BREAKS)] = True
_GAP = _BREAK.copy()
_GAP[[9, 32]] = True
#: Hash bases to go through until no two words of the corpus share a hash.
BASES = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3)


def _lists(values: np.ndarray, ends: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column, and where each row ends in them."""
    offsets = column.offsets.to_numpy()
    return column.flatten().to_numpy(zero_copy_only=False), (offsets[1:] - offsets[0]).astype(np.int64)


def _codes(column: pa.Array) -> tuple[np.ndarray, list]:
    coded = column.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False), coded.dictionary.to_pylist()


# -- the first relation -------------------------------------------------------------

FIRST = "lang string, at array<int>, w1 array<long>, word binary, h long, n long"


def _occurrences(base: int):
    """Documents to the relation of length 1, with rows of (lang, word, h, n) between: the words of many documents, counted."""
    names = ["lang", "at", "w1", "word", "h", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[pa.Array, np.ndarray, np.ndarray]]] = {}
        for b in batches:
            offsets, data = utf8(b.column("text"))
            langs, known = _codes(b.column("lang"))
            for lo, hi in spans(offsets, BATCH_BYTES):
                buf, ends = blank_joined(offsets, data, lo, hi)
                start, end, h = word_hashes(buf, _GAP, base)
                cut = np.searchsorted(start, ends)
                # a document's places: words before, plus pieces ended before
                pieces = np.cumsum(_BREAK[buf], dtype=np.int32)[start] if len(start) else start
                first = np.concatenate([[0], cut[:-1]])
                here = np.repeat(np.arange(hi - lo), np.diff(np.concatenate([[0], cut])))
                step = np.ones(len(start), np.int64)
                step[1:] += np.diff(pieces) > 0
                place = np.cumsum(step)
                place -= np.concatenate([place, [0]])[first][here] if len(start) else 0
                own = langs[lo:hi]
                lang = pa.array([known[k] for k in own], pa.string())
                none = pa.nulls(hi - lo, pa.int64())
                yield pa.RecordBatch.from_arrays([lang, _lists(place.astype(np.int32), cut, pa.int32()), _lists(h.view(np.int64), cut, pa.int64()),
                                                  pa.nulls(hi - lo, pa.binary()), none, none], names)
                for lang, part in counted(h, start, end, buf, own[here], known):
                    held.setdefault(lang, []).append(part)
                if sum(len(p[1]) for parts in held.values() for p in parts) > HELD_WORDS:
                    for lang in list(held):
                        yield from added(lang, held.pop(lang))
        for lang, parts in held.items():
            yield from added(lang, parts)

    def counted(h, start, end, buf, lang, known) -> Iterator[tuple[str, tuple[pa.Array, np.ndarray, np.ndarray]]]:
        """By language: words, hashes, counts."""
        if not len(h):
            return
        low = np.where((buf >= 65) & (buf <= 90), buf + 32, buf).astype(np.uint8)
        _, at, of = np.unique(h, return_index=True, return_inverse=True)
        for code in np.unique(lang):
            n = np.bincount(of[lang == code], minlength=len(at))
            have = np.flatnonzero(n)
            yield known[code], (words(low, start[at[have]], end[at[have]]), h[at[have]], n[have])
        odd = differing(low, start, end, at[of])[:1]
        if len(odd):  # another word than the one shown for its hash: shown too, so that the dictionary sees both
            yield known[lang[odd[0]]], (words(low, start[odd], end[odd]), h[odd], np.zeros(1, np.int64))

    def added(lang: str, parts: list[tuple[pa.Array, np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        word, h, n = pa.concat_arrays([p[0] for p in parts]), np.concatenate([p[1] for p in parts]), np.concatenate([p[2] for p in parts])
        _, at, of = np.unique(h, return_index=True, return_inverse=True)
        yield shown(lang, word.take(pa.array(at)), h[at], np.bincount(of, weights=n).astype(np.int64))
        same = pc.equal(word, word.take(pa.array(at[of]))).to_numpy(zero_copy_only=False)
        odd = np.flatnonzero(~same)[:1]
        if len(odd):
            yield shown(lang, word.take(pa.array(odd)), h[odd], np.zeros(1, np.int64))

    def words(low, start, end) -> pa.Array:
        size, lens = len(start), end - start
        ends = np.cumsum(lens)
        letters = low[np.arange(int(ends[-1])) + np.repeat(start - (ends - lens), lens)]
        return pa.Array.from_buffers(pa.binary(), size, [None, pa.py_buffer(np.concatenate([[0], ends]).astype(np.int32)), pa.py_buffer(letters)])

    def shown(lang: str, word: pa.Array, h: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        size, none = len(h), np.zeros(len(h), np.int64)
        return pa.RecordBatch.from_arrays([pa.array([lang] * size, pa.string()), _lists([], none, pa.int32()), _lists([], none, pa.int64()),
                                           word, pa.array(h.view(np.int64)), pa.array(n.astype(np.int64))], names)
    return run


def differing(low: np.ndarray, start: np.ndarray, end: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Words whose bytes are not those of word ``other``."""
    lens = end - start
    odd = np.flatnonzero(lens != lens[other])
    if len(odd):
        return odd
    ends = np.cumsum(lens)
    own = np.arange(int(ends[-1])) + np.repeat(start - (ends - lens), lens)
    unlike = np.flatnonzero(low[own] != low[own + np.repeat(start[other] - start, lens)])
    return np.unique(np.searchsorted(ends, unlike, side="right"))


def _dictionary(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The relation of length 1 (lang, at, w1) and its counts (lang, w1, word, n), under a base that keeps all words apart."""
    bounded_batches(documents.sparkSession)
    texts = documents.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    for base in BASES:
        both = stage(texts.mapInArrow(_occurrences(base), FIRST), "occurrences")
        words = stage(both.filter("word is not null").groupBy("lang", F.col("h").alias("w1")).agg(
            F.min("word").alias("word"), F.max("word").alias("other"), F.sum("n").alias("n")), "words")
        if words.filter("word != other").isEmpty():
            return both.filter("word is null").select("lang", "at", "w1"), words.drop("other")
    raise RuntimeError("two words share a hash under every base")


# -- semi-join ------------------------------------------------------------------------

def group_key(lang: str, words: list[np.ndarray]) -> np.ndarray:
    """A 64-bit key of (lang, words): for the filter and for sorting, never for equality."""
    seed = np.frombuffer(lang.encode().ljust(8, b"\0"), np.uint8)
    h = np.full(len(words[0]), np.uint64(int(np.dot(seed.astype(np.uint64), np.uint64(31) ** np.arange(len(seed), dtype=np.uint64)))), np.uint64)
    for k, w in enumerate(words):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + w.view(np.uint64) + np.uint64(k + 1))
    return h


def _bit_rows(names: list[str], bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            langs, known = _codes(b.column("lang"))
            words = [b.column(n).to_numpy(zero_copy_only=False) for n in names]
            for code in np.unique(langs):
                mine = langs == code
                bit = np.concatenate(list(probes(group_key(known[code], [w[mine] for w in words]), bits)))
                slot = (bit >> np.uint64(6)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array((np.uint64(1) << (bit & np.uint64(63))).view(np.int64))], ["slot", "bits"])
    return run


def frequent_filter(groups: DataFrame, k: int) -> np.ndarray:
    """A Bloom filter of the groups, built in Spark: at most ``FILTER_BITS`` bits reach the driver, whatever the input."""
    names = [f"w{i + 1}" for i in range(k)]
    bits = 1 << 16
    while bits < min(FILTER_BITS, BITS_EACH * groups.count()):
        bits *= 2
    slots = (groups.select("lang", *names).mapInArrow(_bit_rows(names, bits), "slot long, bits long")
             .groupBy("slot").agg(F.expr("bit_or(bits)").alias("bits")))
    out = np.zeros(bits >> 6, np.int64)
    got = slots.toArrow()
    out[got.column("slot").to_numpy()] = got.column("bits").to_numpy()
    return out.view(np.uint64)


# -- merge join and counts ---------------------------------------------------------------

def merge_join(at: np.ndarray, words: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Occurrences of length k+1 from those of length k, sorted by place: the next row must begin one place on.

    Sorted and unique places make the merge a comparison of neighbours; what
    the two share (all but one word each) is equal, being the same places.
    """
    on = np.flatnonzero(at[1:] == at[:-1] + 1)
    return at[on], [w[on] for w in words] + [words[-1][on + 1]]


def _extend(k: int, filter_of):
    """Relation of length k to that of length k+1: semi-join with the frequent groups, then merge join."""
    names = [f"w{i + 1}" for i in range(k)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = filter_of.value
        for b in batches:
            at, ends = _flat(b.column("at"))
            words = [_flat(b.column(n))[0] for n in names]
            langs, known = _codes(b.column("lang"))
            row = np.repeat(np.arange(len(ends)), np.diff(np.concatenate([[0], ends])))
            of = langs[row]
            keep = np.zeros(len(at), bool)
            for code in np.unique(langs):
                mine = np.flatnonzero(of == code)
                if len(mine):
                    keep[mine] = passes(table, group_key(known[code], [w[mine] for w in words]))
            # places of different rows never touch: each row's are moved behind those of the row before
            reach = at.max(initial=0) + 2
            place = at.astype(np.int64) + row * np.int64(reach)
            place, found = merge_join(place[keep], [w[keep] for w in words])
            cut = np.searchsorted(place, (np.arange(len(ends)) + 1) * np.int64(reach))
            back = place - np.repeat(np.arange(len(ends)), np.diff(np.concatenate([[0], cut]))) * np.int64(reach)
            lists = [_lists(back.astype(np.int32), cut, pa.int32())] + [_lists(w, cut, pa.int64()) for w in found]
            yield pa.RecordBatch.from_arrays([b.column("lang"), *lists], ["lang", "at", *names, f"w{k + 1}"])
    return run


def _counts(k: int):
    """Rows of a relation to (lang, words, n), combined over many documents."""
    names = [f"w{i + 1}" for i in range(k)]

    def flush(lang: str, words: list[np.ndarray]) -> pa.RecordBatch:
        key = group_key(lang, words)
        order = np.argsort(key)
        words = [w[order] for w in words]
        new = np.ones(len(order), bool)
        new[1:] = False
        for w in words:
            new[1:] |= w[1:] != w[:-1]
        first = np.flatnonzero(new)
        n = np.diff(np.concatenate([first, [len(order)]]))
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(first), pa.string()), *(pa.array(w[first]) for w in words), pa.array(n.astype(np.int64))],
                                          ["lang", *names, "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        for b in batches:
            words = [_flat(b.column(n)) for n in names]
            ends = words[0][1]
            langs, known = _codes(b.column("lang"))
            of = np.repeat(langs, np.diff(np.concatenate([[0], ends])))
            for code in np.unique(of):
                mine = of == code
                held.setdefault(known[code], []).append([w[mine] for w, _ in words])
            while held and sum(len(p[0]) for parts in held.values() for p in parts) > COUNTED_TOGETHER:
                lang = max(held, key=lambda x: sum(len(p[0]) for p in held[x]))
                yield flush(lang, [np.concatenate(x) for x in zip(*held.pop(lang))])
        for lang, parts in held.items():
            yield flush(lang, [np.concatenate(x) for x in zip(*parts)])
    return run


# -- candidates -----------------------------------------------------------------------------

def _names(k: int) -> list[str]:
    return [f"w{i + 1}" for i in range(k)]


def frequent(documents: DataFrame, least: int = LEAST, longest: int = LONGEST) -> tuple[DataFrame, list[DataFrame]]:
    """Words of each language in all (lang, total), and the frequent groups by length (lang, w1.., n; length 1 has word too)."""
    spark = documents.sparkSession
    relation, words = _dictionary(documents)
    totals = stage(words.groupBy("lang").agg(F.sum("n").alias("total")), "totals")
    groups = [stage(words.filter(F.col("n") >= least), "groups")]
    for k in range(1, longest):
        table = spark.sparkContext.broadcast(frequent_filter(groups[-1], k))
        lists = ", ".join(f"{n} array<long>" for n in _names(k + 1))
        relation = stage(relation.mapInArrow(_extend(k, table), f"lang string, at array<int>, {lists}"), "occurrences")
        longs = ", ".join(f"{n} long" for n in _names(k + 1))
        counts = relation.select("lang", *_names(k + 1)).mapInArrow(_counts(k + 1), f"lang string, {longs}, n long")
        groups.append(stage(counts.groupBy("lang", *_names(k + 1)).agg(F.sum("n").alias("n")).filter(F.col("n") >= least), "groups"))
    return totals, groups


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 * a * a / (left * right)); decimals of 38 digits hold the products for counts below 10**16."""
    wide = "decimal(20,0)"
    top = F.lit(1_000_000).cast("decimal(7,0)") * a.cast("decimal(15,0)") * a.cast("decimal(15,0)")
    return F.call_function("div", top, left.cast(wide) * right.cast("decimal(18,0)"))


def candidates(groups: list[DataFrame]) -> DataFrame:
    """lang, phrase, a, l, r, score of all phrases of two words and more, with the words inside longer ones dropped."""
    longest = len(groups)
    out = None
    for k in range(2, longest + 1):
        now = groups[k - 1].withColumnRenamed("n", "a")
        word = groups[0].select("lang", "w1", F.col("word").cast("string").alias("word"))
        for i, name in enumerate(_names(k)):
            now = now.join(word.withColumnRenamed("w1", name).withColumnRenamed("word", f"s{i}"), ["lang", name])
        cuts = []
        for cut in range(1, k):
            for side, (lo, hi) in (("l", (0, cut)), ("r", (cut, k))):
                part = groups[hi - lo - 1].select("lang", *(F.col(f"w{i + 1}").alias(f"w{lo + i + 1}") for i in range(hi - lo)), F.col("n").alias(f"{side}{cut}"))
                now = now.join(part, ["lang", *_names(k)[lo:hi]])
            cuts.append(F.struct(_score(F.col("a"), F.col(f"l{cut}"), F.col(f"r{cut}")).alias("score"), F.lit(cut).alias("cut"),
                                 F.col(f"l{cut}").alias("l"), F.col(f"r{cut}").alias("r")))
        now = now.withColumn("best", F.least(*cuts) if len(cuts) > 1 else cuts[0])
        for longer in range(k + 1, longest + 1):  # the most frequent longer phrase around each
            around = None
            for lo in range(longer - k + 1):
                part = groups[longer - 1].select("lang", *(F.col(f"w{lo + i + 1}").alias(f"w{i + 1}") for i in range(k)), "n")
                around = part if around is None else around.unionByName(part)
            around = around.groupBy("lang", *_names(k)).agg(F.max("n").alias(f"in{longer}"))
            now = now.join(around, ["lang", *_names(k)], "left").filter(
                F.coalesce(F.col(f"in{longer}"), F.lit(0)).cast("decimal(20,0)") * COVERED_DEN < F.col("a").cast("decimal(20,0)") * COVERED_NUM)
        now = now.select("lang", F.concat_ws(" ", *(f"s{i}" for i in range(k))).alias("phrase"), "a", "best.l", "best.r", "best.score")
        out = now if out is None else out.unionByName(now)
    return out


def collocations(documents: DataFrame, least: int = LEAST, longest: int = LONGEST, reported: int = REPORTED) -> DataFrame:
    """The best ``reported`` phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    totals, groups = frequent(documents, least, longest)
    found = stage(candidates(groups), "candidates")
    order = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    # ranked in parts first, so that a language's ranking in one task holds a bounded number of rows
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))
    first = found.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
    last = first.filter(F.col("rank") <= reported).withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    return (last.filter(F.col("rank") <= reported).join(totals, "lang")
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("total").alias("n"), F.col("score").cast("long").alias("score")))


ORACLE = """
WITH pieces AS (
  SELECT row_number() OVER () AS piece, lang, words FROM (
    SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(regexp_split_to_array(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')), '[^ \\x09]+') AS words FROM documents)
  WHERE len(words) > 0),
occ AS (SELECT piece, lang, unnest(words) AS w, generate_subscripts(words, 1) AS pos FROM pieces),
f1 AS (SELECT lang, w, count(*) AS f FROM occ GROUP BY lang, w),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM f1 GROUP BY lang),
o2 AS (SELECT x.piece, x.lang, x.pos, x.w AS a1, y.w AS a2 FROM occ x JOIN occ y ON x.piece = y.piece AND y.pos = x.pos + 1),
f2 AS (SELECT lang, a1, a2, count(*) AS f FROM o2 GROUP BY ALL HAVING count(*) >= 10),
o3 AS (SELECT x.lang, x.a1, x.a2, y.w AS a3 FROM o2 x JOIN occ y ON x.piece = y.piece AND y.pos = x.pos + 2),
f3 AS (SELECT lang, a1, a2, a3, count(*) AS f FROM o3 GROUP BY ALL HAVING count(*) >= 10),
around AS (SELECT lang, p1, p2, max(f) AS f FROM (SELECT lang, a1 AS p1, a2 AS p2, f FROM f3 UNION ALL SELECT lang, a2, a3, f FROM f3) GROUP BY ALL),
c2 AS (SELECT c.lang, c.a1 || ' ' || c.a2 AS phrase, c.f AS a, l.f AS l, r.f AS r, 1 AS k FROM f2 c
  JOIN f1 l ON l.lang = c.lang AND l.w = c.a1 JOIN f1 r ON r.lang = c.lang AND r.w = c.a2
  LEFT JOIN around x ON x.lang = c.lang AND x.p1 = c.a1 AND x.p2 = c.a2 WHERE coalesce(x.f, 0) * 100 < 50 * c.f),
c3 AS (SELECT c.lang, c.a1 || ' ' || c.a2 || ' ' || c.a3 AS phrase, c.f AS a, l.f AS l, r.f AS r, 1 AS k FROM f3 c
    JOIN f1 l ON l.lang = c.lang AND l.w = c.a1 JOIN f2 r ON r.lang = c.lang AND r.a1 = c.a2 AND r.a2 = c.a3
  UNION ALL SELECT c.lang, c.a1 || ' ' || c.a2 || ' ' || c.a3, c.f, l.f, r.f, 2 FROM f3 c
    JOIN f2 l ON l.lang = c.lang AND l.a1 = c.a1 AND l.a2 = c.a2 JOIN f1 r ON r.lang = c.lang AND r.w = c.a3),
scored AS (SELECT *, ((1000000::HUGEINT * a * a) // (l::HUGEINT * r))::BIGINT AS score FROM (SELECT * FROM c2 UNION ALL SELECT * FROM c3)),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM best)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
