"""Benchmark decontamination by edit distance.

A document holds an item if some stretch of it is within ``EDITS`` of the item's
characters in edit distance. Candidates come from shared grams of characters:
each gram that an item and a document share votes for the diagonal (place in the
document less place in the item) that it lies on. A copy with edits keeps many
grams on few neighbouring diagonals, chance scatters them over all. For each
item the gram length and the votes asked for are chosen by a model of random
substitutions, insertions and deletions, so that a copy with the full ``EDITS``
of its characters edited is a candidate with chance ``RECALL``; an item too short
for that takes the grams of the pigeonhole bound, which miss nothing.

Every candidate is verified: first many at a time by bit-parallel columns on
characters folded to a byte (which can only lower a distance), then the ones
left exactly.

The benchmark is a stated query set: it comes to the workers in blocks of at
most ``BLOCK`` items, each against all documents.

Defined cases: null or empty texts match nothing; an item too short for any edit
is found as whole words; words are lower-cased runs of letters and digits, so
markup and white space do not count; an item without any of them is found nowhere;
other columns are ignored; repeated rows are reported once each; an
item that occurs several times in a document is reported with its best place; an
item longer than ``PIECE`` is looked up by its pieces; very long texts are read
whole, in slices; empty tables give no hits.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callstar.llm.common import SLICE, bounded_batches, spans, utf8

#: Share of an item's characters that may be edited.
EDITS = 0.2
#: Chance that a copy with ``EDITS`` of its characters edited is a candidate.
RECALL = 0.995
#: Lengths of grams, longest first, and the least votes for which one is taken.
GRAMS = (8, 6, 5, 4)
VOTES = 6
#: Trials of the model for one item length.
TRIALS = 1000
#: Diagonals of a bucket; votes count over two neighbouring buckets.
BUCKET = 16
#: Characters of an item that vote together.
PIECE = 512
#: Characters of the text that vote at once.
SEGMENT = 1 << 15
#: Candidates that are verified at once.
BATCH = 4096
#: Benchmark items that go to the workers at once.
BLOCK = 20_000
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_BITS = 20


def allowed(m: int) -> int:
    """Edits that an item of m characters may have."""
    return int(EDITS * m)


def gram_plan(m: int) -> tuple[int, int]:
    """Gram length and votes for m characters: the longest gram that leaves ``VOTES`` votes to all but 1 - ``RECALL`` of the copies."""
    k = allowed(m)
    rng = np.random.default_rng(m)
    at = rng.random((TRIALS, m)).argsort(axis=1)[:, :k]  # edited places
    kind = rng.integers(0, 3, at.shape)
    edited, drift = np.zeros((TRIALS, m), np.int64), np.zeros((TRIALS, m), np.int64)
    np.put_along_axis(edited, at, 1, axis=1)
    np.put_along_axis(drift, at, kind - 1, axis=1)  # deletion, substitution, insertion
    bucket = (drift.cumsum(axis=1) + rng.integers(0, BUCKET, (TRIALS, 1)) + 64 * BUCKET) // BUCKET
    before = np.concatenate([np.zeros((TRIALS, 1), np.int64), edited.cumsum(axis=1)], axis=1)
    for gram in GRAMS:
        if gram >= m:
            continue
        whole = before[:, gram:] == before[:, :-gram]
        where = bucket[:, :m - gram + 1]
        first = where.min(axis=1, keepdims=True)
        votes = np.zeros(TRIALS, np.int64)
        for b in range(int((where - first).max()) + 1):
            votes = np.maximum(votes, (whole & (where - first >= b) & (where - first <= b + 1)).sum(axis=1))
        least = int(np.quantile(votes, 1 - RECALL, method="lower"))
        if least >= VOTES:
            return gram, least
    return max(1, min(8, m // (k + 1))), 1  # one of k + 1 pieces is without edits


def best_fit(item: str, text: str) -> tuple[int, int]:
    """Least edit distance between ``item`` and a stretch of ``text``, and where that stretch ends (bit-parallel columns)."""
    m = len(item)
    masks: dict[str, int] = defaultdict(int)
    for i, c in enumerate(item):
        masks[c] |= 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score = full, 0, m
    best, end = m, 0
    for j, c in enumerate(text, 1):
        eq = masks.get(c, 0)
        diagonal = (((eq & up) + up) ^ up) | eq | down
        right_up = down | (full & ~(diagonal | up))
        right_down = up & diagonal
        if right_up & top:
            score += 1
        elif right_down & top:
            score -= 1
        right_up = (right_up << 1) & full  # free start: the first row stays 0
        right_down = (right_down << 1) & full
        up = right_down | (full & ~((eq | down) | right_up))
        down = right_up & (eq | down)
        if score < best:
            best, end = score, j
    return best, end


def pieces(m: int) -> list[tuple[int, int]]:
    """Where the pieces of an item of m characters begin and end."""
    n = -(-m // PIECE)
    return [(m * i // n, m * (i + 1) // n) for i in range(n)]


def make_plans(texts: list[str]) -> dict[int, tuple[int, int]]:
    """``gram_plan`` for the lengths of all pieces of the items: at most ``PIECE`` of them."""
    lengths = {len(" ".join(plain(t))) for t in texts}
    return {n: gram_plan(n) for n in sorted({b - a for m in lengths for a, b in pieces(m)})}


def grams_at(codes: np.ndarray, gram: int) -> np.ndarray:
    """The grams that begin at each place; ``codes`` ends in 8 bytes of padding."""
    every = np.ndarray((len(codes) - 8,), "<u8", codes.tobytes(), strides=(1,))
    return every & np.uint64((1 << 8 * gram) - 1) if gram < 8 else every


def slots(grams: np.ndarray) -> np.ndarray:
    return ((grams * _GOLD) >> np.uint64(64 - _BITS)).view(np.int64)


class Index:
    """Grams of benchmark items."""

    def __init__(self, ids: list, texts: list[str], plans: dict[int, tuple[int, int]]):
        self.ids, self.texts = ids, [" ".join(plain(t)) for t in texts]
        self.codes = [fold(points(t)) for t in self.texts]
        self.owner, self.offset, self.need = [], [], []
        found = defaultdict(list)
        for k, codes in enumerate(self.codes):
            for a, b in pieces(len(codes)):
                gram, need = plans[b - a]
                padded = np.concatenate([codes[a:b], np.zeros(8, np.uint8)])
                grams = grams_at(padded, gram)[:b - a - gram + 1]
                found[gram].append((grams, np.full(len(grams), len(self.owner)), np.arange(len(grams))))
                self.owner.append(k)
                self.offset.append(a)
                self.need.append(need)
        self.need = np.array(self.need, np.int64)
        self.longest = PIECE + allowed(PIECE) + BUCKET  # of a copy of a piece
        self.buckets = (SEGMENT + 2 * self.longest) // BUCKET + 4
        self.tables = []
        for gram, parts in found.items():
            grams, piece, place = (np.concatenate(x) for x in zip(*parts))
            slot = slots(grams)
            order = np.argsort(slot, kind="stable")
            starts = np.searchsorted(slot[order], np.arange((1 << _BITS) + 1)).astype(np.int32)
            # a vote's bucket is (place in the segment + shift) // BUCKET
            shift = piece * self.buckets * BUCKET + self.longest - place
            self.tables.append((gram, starts[1:] > starts[:-1], starts, shift[order]))

    def candidates(self, codes: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(item, first and last place where it would begin); ``codes`` ends in 8 bytes of padding."""
        n, step = len(codes) - 8, SEGMENT
        for lo in range(0, max(n, 1), step):
            part = codes[lo:lo + step + self.longest + 8]  # a copy that crosses the border is whole in one segment
            votes = []
            for gram, used, starts, shift in self.tables:
                slot = slots(grams_at(part, gram))
                at = np.flatnonzero(used[slot])
                slot = slot[at]
                first = starts[slot].astype(np.int64)
                count = starts[slot + 1] - first
                which = np.arange(int(count.sum())) + np.repeat(first - (np.cumsum(count) - count), count)
                votes.append((np.repeat(at, count) + shift[which]) // BUCKET)
            if not votes:
                return
            cell, count = np.unique(np.concatenate(votes), return_counts=True)
            both = count.copy()
            both[:-1] += np.where(cell[1:] == cell[:-1] + 1, count[1:], 0)
            cell = cell[both >= self.need[cell // self.buckets]]
            if not len(cell):
                continue
            piece, bucket = cell // self.buckets, cell % self.buckets
            new = np.flatnonzero(np.concatenate([[True], (np.diff(piece) != 0) | (np.diff(bucket) != 1)]))
            last = np.concatenate([new[1:], [len(piece)]]) - 1
            for p, a, b in zip(piece[new].tolist(), bucket[new].tolist(), bucket[last].tolist()):
                base = lo - self.longest - self.offset[p]
                yield self.owner[p], base + a * BUCKET, base + (b + 2) * BUCKET


def points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")


def fold(chars: np.ndarray) -> np.ndarray:
    """Characters as bytes; a few rare ones share a byte. 0 is none of them."""
    return np.where(chars < 256, chars, chars % 251 + 1).astype(np.uint8)


def least_distances(items: list[np.ndarray], stretches: list[np.ndarray]) -> np.ndarray:
    """Least edit distance between each item and a part of its stretch: ``best_fit`` on folded characters, for many pairs."""
    c, width = len(items), -(-max(map(len, items)) // 64)
    known = {id(x): x for x in items}
    number = {i: k for k, i in enumerate(known)}
    masks = np.zeros((width, len(known) * 256), np.uint64)
    for i, x in known.items():
        at = np.arange(len(x))
        np.bitwise_or.at(masks, (at // 64, number[i] * 256 + x.astype(np.int64)), np.uint64(1) << (at % 64).astype(np.uint64))
    row = np.array([number[id(x)] for x in items]) * 256
    m = np.array([len(x) for x in items])
    top_word, top_bit, one = (m - 1) // 64, ((m - 1) % 64).astype(np.uint64), np.uint64(1)
    text = np.zeros((max(map(len, stretches)), c), np.uint8)
    for k, x in enumerate(stretches):
        text[:len(x), k] = x
    up, down = np.full((width, c), ~np.uint64(0)), np.zeros((width, c), np.uint64)
    score = m.copy()
    best, each = m.copy(), np.arange(c)
    for codes in text:
        eq = masks[:, row + codes]
        added, carry = np.empty_like(up), np.zeros(c, np.uint64)
        for w in range(width):
            both = eq[w] & up[w]
            total = both + up[w]
            over = total < both
            added[w] = total + carry
            carry = (over | (added[w] < carry)).astype(np.uint64)
        diagonal = (added ^ up) | eq | down
        right_up = down | ~(diagonal | up)
        right_down = up & diagonal
        score += ((right_up[top_word, each] >> top_bit) & one).astype(np.int64)
        score -= ((right_down[top_word, each] >> top_bit) & one).astype(np.int64)
        for x in (right_up, right_down):
            high = x[:-1] >> np.uint64(63)
            x <<= one
            x[1:] |= high
        up = right_down | ~(eq | down | right_up)
        down = right_up & (eq | down)
        np.minimum(best, score, out=best)
    return best


def plain(text: str) -> list[str]:
    """Words of a text: lower-cased runs of letters, digits and other non-ASCII characters."""
    return "".join(c if c.isalnum() or ord(c) > 127 else " " for c in text).lower().split()


_GAPS = np.array([c for c in range(0x3001) if c < 128 and not chr(c).isalnum() or chr(c).isspace()], np.uint32)
_GAP = np.zeros(0x3002, bool)
_GAP[_GAPS] = True


def plain_rows(offsets: np.ndarray, data: np.ndarray, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    """``" ".join(plain(text))`` of rows, each with a blank after it, as characters, and where each row ends in them."""
    parts = [points(data[offsets[r]:offsets[r + 1]].tobytes().decode("utf-8", "replace").lower()) for r in range(lo, hi)]
    blank = np.full(1, 32, np.uint32)
    chars = np.concatenate([x for p in parts for x in (p, blank)])
    ends = np.cumsum([len(p) + 1 for p in parts])
    starts = np.concatenate([[0], ends[:-1]])
    gap = _GAP[np.minimum(chars, 0x3001)]
    keep = ~gap
    keep[1:] |= ~gap[:-1]  # the first gap after a word
    keep[ends - 1] = True
    return np.where(gap, np.uint32(32), chars)[keep], np.cumsum(np.add.reduceat(keep, starts, dtype=np.int64))


def exact(index: Index, k: int, stretch: str) -> tuple[int, int]:
    """Distance between an item and its best place in the stretch, and where that begins."""
    item = index.texts[k]
    distance, end = best_fit(item, stretch)
    return distance, end - best_fit(item[::-1], stretch[:end][::-1])[1]


def scan(offsets: np.ndarray, data: np.ndarray, index: Index) -> Iterator[tuple[int, list[tuple]]]:
    """Rows with hits: (item_id, distance, similarity, first word)."""
    for lo, hi in spans(offsets, 2 * SLICE):
        if offsets[hi] == offsets[lo]:
            continue
        chars, row_ends = plain_rows(offsets, data, lo, hi)
        codes = np.concatenate([fold(chars), np.zeros(8, np.uint8)])
        todo = set()
        for k, first, last in index.candidates(codes):
            m = len(index.codes[k])
            room = allowed(m)
            a, b = max(0, first - room), min(len(chars), last + m + room)
            for r in range(int(np.searchsorted(row_ends, a, side="right")), int(np.searchsorted(row_ends, max(a, b - 1), side="right")) + 1):
                if r < len(row_ends):
                    c, d = max(a, int(row_ends[r - 1]) if r else 0), min(b, int(row_ends[r]) - 1)
                    if d - c >= m - room:
                        todo.add((1 << (m // 64).bit_length(), d - c, k, r, c, d))
        best: dict[int, dict[int, tuple]] = defaultdict(dict)
        for some in batches_of(sorted(todo)):
            near = least_distances([index.codes[t[2]] for t in some], [codes[t[4]:t[5]] for t in some])
            for (_, _, k, r, c, d), distance in zip(some, near.tolist()):
                most, begin = allowed(len(index.codes[k])), int(row_ends[r - 1]) if r else 0
                if distance > most:
                    continue
                found, start = exact(index, k, chars[c:d].tobytes().decode("utf-32-le", "replace"))
                if found > most or not most and not whole_words(index.texts[k], chars[begin:row_ends[r]]):
                    continue
                word = int((chars[begin:c + start + 1] == 32).sum())
                if k not in best[r] or (found, word) < best[r][k]:
                    best[r][k] = (found, word)
        for r in sorted(best):
            if best[r]:
                yield lo + r, [(index.ids[k], d, 1 - d / len(index.texts[k]), w) for k, (d, w) in sorted(best[r].items())]


def batches_of(tasks: list[tuple]) -> Iterator[list[tuple]]:
    """Runs of tasks of one width, of at most ``BATCH``; sorted by the length of the stretch."""
    for _, same in groupby(tasks, itemgetter(0)):
        same = list(same)
        yield from (same[i:i + BATCH] for i in range(0, len(same), BATCH))


def whole_words(item: str, chars: np.ndarray) -> bool:
    return f" {item} " in " " + chars.tobytes().decode("utf-32-le", "replace")


def blocks(benchmark: DataFrame, size: int = BLOCK) -> Iterator[tuple[list, list[str]]]:
    """The benchmark items, a bounded block at a time."""
    ids, texts = [], []
    for r in benchmark.select("item_id", "text").orderBy("item_id").toLocalIterator():
        if r["text"]:
            ids.append(r["item_id"])
            texts.append(r["text"])
        if len(ids) == size:
            yield ids, texts
            ids, texts = [], []
    if ids:
        yield ids, texts


def finder(documents: DataFrame, ids: list, texts: list[str]):
    """A column function: text to an array of (item_id, distance, similarity)."""
    bounded_batches(documents.sparkSession)
    shared = documents.sparkSession.sparkContext.broadcast((ids, texts, make_plans(texts)))

    @F.pandas_udf("array<struct<item_id:long,distance:int,similarity:double,word:int>>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        index = Index(*shared.value)
        for column in batches:
            offsets, data = utf8(pa.array(column, pa.large_string(), from_pandas=True))
            out = [[] for _ in range(len(column))]
            for r, hits in scan(offsets, data, index):
                out[r] = [{"item_id": i, "distance": d, "similarity": s, "word": w} for i, d, s, w in hits]
            yield pd.Series(out)

    return run


def contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, distance, similarity: one row for each item that a document holds."""
    out = None
    for ids, texts in blocks(benchmark):
        part = (documents.select("doc_id", F.explode(finder(documents, ids, texts)("text")).alias("hit"))
                .select("doc_id", "hit.item_id", "hit.distance", "hit.similarity", F.col("hit.word").alias("first_word")))
        out = part if out is None else out.unionByName(part)
    if out is None:
        return documents.select("doc_id", F.lit(None).cast("long").alias("item_id"), F.lit(None).cast("int").alias("distance"),
                                F.lit(None).cast("double").alias("similarity"), F.lit(None).cast("int").alias("first_word")).limit(0)
    return out


def clean(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``documents`` that hold no benchmark item."""
    out = documents
    for ids, texts in blocks(benchmark):
        out = out.filter(F.size(finder(documents, ids, texts)("text")) == 0)
    return out
