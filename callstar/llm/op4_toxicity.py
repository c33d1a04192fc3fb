"""Toxicity from class-conditional Kneser-Ney word bigram models.

Two bigram models, of toxic and of ordinary text, are smoothed by absolute
discounting: bigram -> class unigram by continuation counts -> one continuation
distribution that both classes share. An expression whose class counts are too
small to tell the classes apart (``EVIDENCE`` standard deviations) gets the
shared estimate in both, so rare expressions add no noise. A text's score comes
from the difference of the two length-normalised log-likelihoods, calibrated by
a logistic fit on a bounded sample of labelled rows, scored by models that did
not count that sample; the models that score the documents count it as well.

Counts cover all labelled rows that may be learned from and all words and bigrams in
them, which are counted once a text, per task, and summed by key; they stay Spark tables. The
model is what is left of them after the evidence test. ``WORDS`` and ``BIGRAMS`` are how
many of its most frequent expressions go to the workers; the rest is joined, by key, to the
occurrences that a Bloom filter of it lets through. ``CALIBRATION`` bounds the rows of
the logistic fit.

Defined cases: null or empty text scores as a text without words; labels that
are null or whose document is missing are not learned from; contradicting
labels of a document count in both classes; without labels of both classes every
score is 0.5 less a hair (predicted 0); repeated rows count as often as they
occur; a very long text is read whole, in slices; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callstar.llm.common import PUNCTUATION, mix, passes, probes, row_words, stage, utf8, with_row_id
from callstar.llm.op5_langid import part

#: Words and bigrams of the model that go to the workers; the others are joined.
WORDS = 1 << 16
BIGRAMS = 1 << 17
#: Most bits of the filter of the others (32 MB), and bits for each.
FILTER_BITS, BITS_EACH = 1 << 28, 16
#: Labelled rows of the logistic fit.
CALIBRATION = 20_000
DISCOUNT = 0.75
#: Standard deviations by which class counts must differ from chance.
EVIDENCE = 3.0
FEATURES = 5
#: Label rows (16 bytes each) up to which they are broadcast to the texts; beyond, both are shuffled.
BROADCAST_ROWS = 1 << 20
#: Keys that a task counts before it passes them on.
HELD = 1 << 18

CLASSES = ["ordinary", "toxic", "drawn_ordinary", "drawn_toxic"]
COUNTS = "first long, word long, " + ", ".join(f"{c} long" for c in CLASSES)


class Counter:
    """Sums of the class counts by key (a word, or a word after another), handed on when there are many keys."""

    def __init__(self):
        self.keys, self.first, self.word, self.counts, self.n = [], [], [], [], 0

    def add(self, keys: np.ndarray, first: np.ndarray, word: np.ndarray, kind: np.ndarray) -> None:
        u, at, of = np.unique(keys, return_index=True, return_inverse=True)
        self.keys.append(u)
        self.first.append(first[at])
        self.word.append(word[at])
        self.counts.append(np.array([np.bincount(of[kind == k], minlength=len(u)) for k in range(len(CLASSES))], np.int32))
        self.n += len(u)

    def batches(self) -> Iterator[pa.RecordBatch]:
        if not self.n:
            return
        u, at, of = np.unique(np.concatenate(self.keys), return_index=True, return_inverse=True)
        first, word = np.concatenate(self.first)[at], np.concatenate(self.word)[at]
        sums = [np.bincount(of, weights=np.concatenate([c[k] for c in self.counts]), minlength=len(u)).astype(np.int64) for k in range(len(CLASSES))]
        self.__init__()
        for i in range(0, len(u), 100_000):
            j = slice(i, i + 100_000)
            yield pa.RecordBatch.from_arrays([pa.array(first[j].view(np.int64)), pa.array(word[j].view(np.int64)), *(pa.array(x[j]) for x in sums)],
                                             ["first", "word", *CLASSES])


def _tokens(batch: pa.RecordBatch) -> Iterator[tuple[int, list[np.ndarray]]]:
    offsets, data = utf8(batch.column(0))
    yield from row_words(offsets, data, PUNCTUATION)


def _count(rows: DataFrame, shared: Broadcast | None) -> DataFrame:
    """Counts of all words (``shared``: none), or of all bigrams (codes of both words by ``shared``), once a text: bursts are no evidence."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter()
        for b in batches:
            kind = b.column(1).to_numpy(zero_copy_only=False) + 2 * b.column(2).to_numpy(zero_copy_only=False).astype(np.int64)
            for lo, texts in _tokens(b):
                found = []
                for w in texts:
                    word = w if shared is None else encode(w, shared.value)
                    first = np.zeros(len(w), np.uint64) if shared is None else before(word)
                    u, at = np.unique(word if shared is None else _code_keys(first, word), return_index=True)
                    found.append((u, first[at], word[at]))
                counter.add(*(np.concatenate(x) for x in zip(*found)), np.repeat(kind[lo:lo + len(texts)], [len(u) for u, _, _ in found]))
                if counter.n > HELD:
                    yield from counter.batches()
        yield from counter.batches()

    counts = rows.select("text", "toxic", "drawn").mapInArrow(run, COUNTS)
    return counts.groupBy("first", "word").agg(*(F.sum(c).alias(c) for c in CLASSES))


def encode(words: np.ndarray, frequent: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Rank from 1 of the frequent words (sorted, with their ranks), the hash itself of all others: short numbers for what is shuffled most."""
    known, rank = frequent
    at = np.searchsorted(known, words).clip(0, len(known) - 1)
    return np.where(known[at] == words, rank[at], words)


def decode(codes: np.ndarray, frequent: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    known, rank = frequent
    by_rank = np.zeros(len(known) + 1, np.uint64)
    by_rank[rank] = known
    return np.where(codes <= len(known), by_rank[codes.clip(0, len(known))], codes)


def _code_keys(first: np.ndarray, word: np.ndarray) -> np.ndarray:
    """A key of two codes; those of two ranks sort by the first."""
    both = np.maximum(first, word) < np.uint64(1 << 31)
    return np.where(both, first << np.uint64(32) | word, bigram_keys(word, first) | np.uint64(1 << 63))


def word_ids(words: np.ndarray, vocabulary: np.ndarray) -> np.ndarray:
    """Place in the sorted vocabulary from 1; 0 for others."""
    at = np.searchsorted(vocabulary, words).clip(0, max(0, len(vocabulary) - 1))
    return np.where(vocabulary[at] == words, at + 1, 0) if len(vocabulary) else np.zeros(len(words), np.int64)


def before(words: np.ndarray) -> np.ndarray:
    """The word before each; a text begins after word 0."""
    return np.concatenate([np.zeros(1, np.uint64), words[:-1]]) if len(words) else words


def bigram_keys(words: np.ndarray, first: np.ndarray | None = None) -> np.ndarray:
    """A 64-bit key of each word with the one before it."""
    first = before(words) if first is None else first
    return mix(mix(first + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) + words)


@dataclass
class Model:
    vocabulary: np.ndarray  # sorted words whose classes differ: the most frequent ones
    word: np.ndarray  # log ratio of toxic to ordinary probability of each, 0 first for other words
    keys: np.ndarray  # sorted bigrams whose classes differ: the most frequent ones
    bigram: np.ndarray  # what their log ratio has more than their last word's
    filter: np.ndarray | None = None  # lets the keys of ``rest`` through
    rest: DataFrame | None = None  # key, value of the other words and bigrams whose classes differ
    weights: np.ndarray | None = None

    def arrays(self) -> tuple:
        return self.vocabulary, self.word, self.keys, self.bigram, self.filter

    def difference(self, words: np.ndarray) -> np.ndarray:
        """Log-likelihood ratio (toxic over ordinary) of each word after the one before it, without ``rest``."""
        out = self.word[word_ids(words, self.vocabulary)]
        if len(self.keys):
            key = bigram_keys(words)
            at = np.searchsorted(self.keys, key).clip(0, len(self.keys) - 1)
            out = out + np.where(self.keys[at] == key, self.bigram[at], 0)
        return out

    def others(self, words: np.ndarray) -> np.ndarray:
        """Keys of the words and bigrams that may be in ``rest``."""
        key = np.concatenate([_word_keys(words), bigram_keys(words)])
        return key[passes(self.filter, key)]


def _word_keys(words: np.ndarray) -> np.ndarray:
    return mix(words ^ np.uint64(0xA0761D6478BD642F))


def differs(ordinary: Column, toxic: Column, share: Column) -> Column:
    """Whether the toxic count is further from its share of both than chance brings it."""
    expected = (ordinary + toxic) * share
    return F.abs(toxic - expected) > EVIDENCE * F.sqrt(expected + 1)


def train(documents: DataFrame, labels: DataFrame) -> Model | None:
    marks = labels.filter(F.coalesce(part(5) != 0, F.lit(False)))
    marks = stage(marks.select(F.col("doc_id").alias("label_id"), F.col("toxic").cast("int").alias("toxic")).filter("toxic in (0, 1)"), "marks")
    marks = F.broadcast(marks) if marks.count() <= BROADCAST_ROWS else marks
    rows = with_row_id(documents.select("doc_id", "text"), "uid").filter(F.coalesce(part(5) != 0, F.lit(False)))
    rows = stage(rows.join(marks, rows["doc_id"] == marks["label_id"]).select("text", "toxic", part(5).alias("fold"), "uid"), "labelled")

    # calibration rows are spread over all of fold 4
    n = rows.filter("fold = 4").count()
    drawn = (F.col("fold") == 4) & (F.pmod(F.xxhash64("uid"), F.lit(1 << 20)) < int(min(1.0, CALIBRATION / max(n, 1)) * (1 << 20)))
    counted = rows.select("text", "toxic", drawn.alias("drawn"))
    words = stage(_count(counted, None), "words")
    often = words.select("word", sum(F.col(c) for c in CLASSES).alias("n")).orderBy(F.desc("n"), "word").limit(WORDS).toPandas()
    if not len(often):
        return None
    often = often["word"].to_numpy(np.int64).view(np.uint64)
    by_hash = np.argsort(often)
    frequent = rows.sparkSession.sparkContext.broadcast((often[by_hash], (by_hash + 1).astype(np.uint64)))

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            code = encode(b.column("word").to_numpy(zero_copy_only=False).view(np.uint64), frequent.value)
            yield b.set_column(b.schema.names.index("word"), "word", pa.array(code.view(np.int64)))

    # sorted rows take less room: equal first words stand together
    words, pairs = words.mapInArrow(coded, words.schema), stage(_count(counted, frequent).sortWithinPartitions("first", "word"), "bigrams")
    model = fit(words, pairs, frequent, F.col("ordinary") + F.col("drawn_ordinary"), F.col("toxic") + F.col("drawn_toxic"))
    if model is None:
        return None
    apart = fit(words, pairs, frequent, F.col("ordinary"), F.col("toxic")) if n else None
    if apart is None:
        model.weights = logistic(np.zeros((0, FEATURES)), np.zeros(0))
        return model
    frame = totals(rows.filter(drawn), apart, "toxic").select("total", "n", "toxic").toPandas()  # about CALIBRATION rows
    model.weights = logistic(features(frame["total"].to_numpy(float), frame["n"].to_numpy(float)), frame["toxic"].to_numpy(float))
    return model


def fit(words: DataFrame, pairs: DataFrame, frequent: Broadcast, ordinary: Column, toxic: Column) -> Model | None:
    """The model by two of the counts of ``words`` and ``pairs`` (in codes), without weights; None if a class has no words."""
    words, pairs = (x.select("first", "word", ordinary.alias("o"), toxic.alias("t")).filter("o + t > 0") for x in (words, pairs))
    o, t = F.col("o"), F.col("t")
    total = words.agg(F.sum("o"), F.sum("t")).first()
    if not total[0] or not total[1]:
        return None
    rate = F.greatest(o / total[0], t / total[1])

    after = stage(pairs.groupBy("word").agg(F.count_if(o > 0).alias("n0"), F.count_if(t > 0).alias("n1"), F.count("*").alias("n")), "tails")
    s = after.agg(F.sum("n0"), F.sum("n1"), F.sum("n"), F.count_if(F.col("n0") > 0), F.count_if(F.col("n1") > 0), F.count("*")).first()
    common = (F.col("n") + 0.5) / (s[2] + 0.5 * (s[5] + 1))
    after = after.select("word", *(((F.greatest(F.col(f"n{k}") - DISCOUNT, F.lit(0.0)) + DISCOUNT * s[3 + k] * common) / max(s[k], 1)).alias(f"u{k}") for k in (0, 1)))
    single = words.filter(differs(o, t, F.lit(total[1] / (total[0] + total[1])))).join(after, "word")
    single = stage(single.select("word", F.log(F.col("u1") / F.col("u0")).alias("value"), rate.alias("rate")), "words")

    # bigrams whose classes differ after their first word, by the same test, which smaller counts never pass
    heads = stage(pairs.groupBy(F.col("first")).agg(F.sum("o").alias("c0"), F.sum("t").alias("c1"),
                                                    F.count_if(o > 0).alias("t0"), F.count_if(t > 0).alias("t1")), "heads")
    many = (t > EVIDENCE) | (o + t > EVIDENCE ** 2)
    double = pairs.filter(many).join(heads, "first").filter(differs(o, t, F.col("c1") / (F.col("c0") + F.col("c1")))).join(after, "word")
    p = []
    for k, c in enumerate((o, t)):
        context, types = F.greatest(F.col(f"c{k}"), F.lit(1)), F.col(f"t{k}")
        backoff = F.when(F.col(f"c{k}") > 0, DISCOUNT * types / context).otherwise(1.0)
        p.append(F.greatest(c - DISCOUNT, F.lit(0.0)) / context + backoff * F.col(f"u{k}"))
    double = double.join(single.select("word", "value"), "word", "left").select(
        "first", "word", (F.log(p[1] / p[0]) - F.coalesce("value", F.lit(0.0))).alias("value"), rate.alias("rate"))
    double = stage(double, "bigrams")

    word, own, rest = _most(single.withColumn("first", F.lit(0).cast("long")), WORDS, False, frequent)
    keys, more, others = _most(double, BIGRAMS, True, frequent)
    rests = [r for r in (rest, others) if r is not None]
    rest = rests[0] if len(rests) == 1 else rests[0].unionByName(rests[1]) if rests else None
    if rest is not None:
        rest = stage(rest, "rest")
    return Model(word, np.concatenate([[0.0], own]), keys, more, None if rest is None else _filter(rest), rest)


def _most(entries: DataFrame, most: int, pair: bool, frequent: Broadcast) -> tuple[np.ndarray, np.ndarray, DataFrame | None]:
    """Sorted keys and values of the ``most`` most frequent entries (staged), and the others as (key, value)."""
    order = (F.desc("rate"), "first", "word")
    got = entries.orderBy(*order).limit(most).toPandas()  # at most WORDS or BIGRAMS
    first, word = (decode(got[c].to_numpy(np.int64).view(np.uint64), frequent.value) for c in ("first", "word"))
    keys = bigram_keys(word, first) if pair else word
    by_key = np.argsort(keys)
    rest = None
    if len(got) == most:
        last = {c: got[c].iloc[-1] for c in ("rate", "first", "word")}
        end = (F.lit(-float(last["rate"])).alias("rate"), F.lit(int(last["first"])).cast("long").alias("first"), F.lit(int(last["word"])).cast("long").alias("word"))
        at = F.struct((-F.col("rate")).alias("rate"), "first", "word") > F.struct(*end)
        rest = entries.filter(at).select("first", "word", "value").mapInArrow(_keyed(pair, frequent), "key long, value double")
    return keys[by_key], got["value"].to_numpy(float)[by_key], rest


def _keyed(pair: bool, frequent: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            first, word = (decode(b.column(k).to_numpy(zero_copy_only=False).view(np.uint64), frequent.value) for k in (0, 1))
            key = bigram_keys(word, first) if pair else _word_keys(word)
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), b.column(2)], ["key", "value"])
    return run


def _filter(rest: DataFrame) -> np.ndarray:
    """A Bloom filter of the keys, built in Spark: at most ``FILTER_BITS`` bits reach the driver, whatever the input."""
    bits, n = 1 << 16, rest.count()
    while bits < min(FILTER_BITS, BITS_EACH * n):
        bits *= 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bit = np.concatenate(list(probes(b.column(0).to_numpy(zero_copy_only=False).view(np.uint64), bits)))
            yield pa.RecordBatch.from_arrays([pa.array((bit >> np.uint64(6)).astype(np.int64)), pa.array((np.uint64(1) << (bit & np.uint64(63))).view(np.int64))], ["slot", "bits"])

    got = rest.select("key").mapInArrow(run, "slot long, bits long").groupBy("slot").agg(F.expr("bit_or(bits)").alias("bits")).toArrow()
    out = np.zeros(bits >> 6, np.int64)
    out[got.column("slot").to_numpy()] = got.column("bits").to_numpy()
    return out.view(np.uint64)


def logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Newton steps with a small ridge."""
    if not len(y) or y.min() == y.max():
        return np.array([0.0, 1.0, 1.0, 0.0, 0.0])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-(x @ w).clip(-30, 30)))
        grad = x.T @ (y - p) - 1e-3 * w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(len(w)), grad)
        w += step.clip(-5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return w


def features(total: np.ndarray, n: np.ndarray) -> np.ndarray:
    """1, the normalised difference, the same in units of a text of this length and in total, the length."""
    mean = total / np.maximum(n, 1)
    return np.stack([np.ones(len(n)), mean, mean * np.sqrt(n), (mean * n).clip(-20, 20), np.log1p(n)], axis=1).reshape(-1, FEATURES)


def totals(rows: DataFrame, model: Model, *columns: str) -> DataFrame:
    """For rows of uid, text: ``columns``, total (the sum of the text's log-likelihood ratios) and n (its words)."""
    shared = rows.sparkSession.sparkContext.broadcast(model.arrays())

    @F.pandas_udf("total double, n long")
    def known(texts: pd.Series) -> pd.DataFrame:
        m = Model(*shared.value)
        offsets, data = utf8(pa.array(texts, pa.large_string(), from_pandas=True))
        found = [(float(m.difference(w).sum()), len(w)) for _, words in row_words(offsets, data, PUNCTUATION) for w in words]
        return pd.DataFrame(found, columns=["total", "n"])

    if model.rest is None:
        return rows.select(*columns, known("text").alias("p")).select(*columns, "p.total", "p.n")

    def occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(*shared.value)
        for b in batches:
            for lo, words in _tokens(b):
                for i, w in enumerate(words):
                    key, times = np.unique(m.others(w), return_counts=True)
                    if len(key):
                        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(b.column(1)[lo + i].as_py(), len(key))), pa.array(key.view(np.int64)), pa.array(times)],
                                                         ["uid", "key", "times"])

    found = rows.select("text", "uid").mapInArrow(occurrences, "uid long, key long, times long").join(model.rest, "key")
    more = stage(found.groupBy("uid").agg(F.sum(F.col("times") * F.col("value")).alias("more")), "more")
    out = rows.select("uid", *columns, known("text").alias("p")).join(more, "uid", "left")
    return out.select(*columns, (F.col("p.total") + F.coalesce("more", F.lit(0.0))).alias("total"), F.col("p.n").alias("n"))


def score(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted: one row per document."""
    model = train(documents, labels)
    held = F.coalesce(part(5) == 0, F.lit(False)).alias("held_out")
    if model is None:
        out = documents.select("doc_id", held, F.lit(float(np.nextafter(0.5, 0))).alias("score"))
        return out.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
    rows = documents.select("doc_id", "text") if model.rest is None else with_row_id(documents.select("doc_id", "text"), "uid")
    found = totals(rows, model, "doc_id")

    @F.pandas_udf("double")
    def likely(total: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series(1 / (1 + np.exp(-(features(total.to_numpy(float), n.to_numpy(float)) @ weights).clip(-30, 30))))

    weights = model.weights
    out = found.select("doc_id", held, likely("total", "n").alias("score"))
    return out.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
