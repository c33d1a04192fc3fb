"""Language ID by nearest centroid.

A text becomes a normalised TF-IDF vector of its byte 2- and 3-grams (letters
only, hashed to ``DIMS`` places). Each language has several centroids, found by
spherical k-means on its labelled rows; a text gets the
language of the centroid with the largest cosine. A text too far from every
centroid for its length is rejected: the threshold of a length class is
``SLACK`` of the smallest cosine that a learned text of that length or more
reached (one in ``OUTLIERS`` of a language's left out), and a text of few n-grams is never too far.

Document frequencies, centroids and thresholds cover all rows that may be
learned from: each round of the clustering adds up all of them, per task and
then by centroid and place. Only the centroids that the first round begins with
come from about ``SAMPLE`` rows a language. The model (languages x ``CLUSTERS`` x
``DIMS`` floats) is what goes to the workers.

Defined cases: null text or one without letters is ``und``, score 0, rejected;
rows with null lang or null doc_id are predicted but not learned from; with
nothing to learn from, everything is ``und``; a very long text is read whole,
in slices; ties go to the first language by name; repeated rows count as often
as they occur; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callstar.llm.common import SLICE, blank_joined, spans, utf8, with_row_id

DIMS = 4096
#: Labelled rows of a language that its first centroids come from.
SAMPLE = 400
CLUSTERS = 3
#: Most rounds of the clustering, and the change of a centroid's place that ends it.
ROUNDS = 8
STILL = 1e-3
#: Sums travel as whole numbers of this unit, so that they do not depend on the order of adding.
UNIT = 2.0 ** -24
#: One row of a language in so many may be further from its centroids than the threshold tells, which is read off so many bins of the cosine.
OUTLIERS = 400
BINS = 1000
UNKNOWN = "und"
#: Rows whose vectors a task holds at once (16 kB each, several times over).
ROWS = 256
#: Share of the smallest learned cosine that a text must reach, if it has 2**SHORT n-grams or more.
SLACK = 0.4
SHORT = 7

_FOLD = np.full(256, 32, np.uint8)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def _places(low: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For widths 2 and 3: the width, the place of the n-gram that begins at each byte, and whether it holds two letters."""
    code, letter = low.astype(np.uint32), low != 32
    two = letter[:-1] & letter[1:]
    good = {2: two, 3: two[:-1] | letter[2:] & (letter[:-2] | letter[1:-1])}
    for width in (2, 3):
        code = code[:-1] * np.uint32(257) + low[width - 1:]
        at = (code * np.uint32(2654435761) + np.uint32(width)) * np.uint32(2246822519) >> np.uint32(20)
        yield width, at % np.uint32(DIMS) if DIMS < 1 << 12 else at, good[width]


def gram_counts(offsets: np.ndarray, data: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """For ranges of rows: the first row, and a row of n-gram counts for each."""
    for lo, hi in spans(offsets, SLICE // 4, ROWS):
        out = np.zeros((hi - lo) * DIMS, np.float32)
        buf, ends = blank_joined(offsets, data, lo, hi)
        first = np.repeat(np.arange(hi - lo) * DIMS, np.diff(ends, prepend=0)) if hi - lo > 1 else None  # of each byte's row
        for at in range(0, len(buf), SLICE):  # several slices only for a very long row, which stands alone
            low = _FOLD[buf[at:at + SLICE + 2]]
            keys = []
            for width, place, good in _places(low):
                good = good[:SLICE]
                if width == 3:  # no gram across two rows
                    over = np.concatenate([ends - 2, ends - 1]) - at
                    good[over[(over >= 0) & (over < len(good))]] = False
                begin = np.flatnonzero(good)
                key = place[begin].astype(np.int64)
                keys.append(key if first is None else key + first[begin])  # rows that share a range fit one slice
            out += np.bincount(np.concatenate(keys), minlength=len(out))
        yield lo, out.reshape(hi - lo, DIMS)


def tf_idf(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.log1p(counts) * idf
    norm = np.linalg.norm(v, axis=1, keepdims=True)
    return v / np.where(norm > 0, norm, 1)


def length_class(counts: np.ndarray) -> np.ndarray:
    return np.log2(1 + counts.sum(axis=1)).astype(int).clip(0, 31)


@dataclass
class Model:
    idf: np.ndarray
    langs: list[str]
    owner: np.ndarray  # language of each centroid
    centroids: np.ndarray
    least: np.ndarray  # rejection threshold by length class


def vectors(texts: pd.Series) -> Iterator[tuple[int, np.ndarray]]:
    offsets, data = utf8(pa.array(texts, pa.large_string(), from_pandas=True))
    yield from gram_counts(offsets, data)


def cluster(v: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means; the first centre is the row nearest the mean, the next are the farthest rows."""
    centres = v[[int(np.argmax(v @ v.mean(axis=0)))]]
    while len(centres) < min(k, len(v)):
        centres = np.vstack([centres, v[int(np.argmin((v @ centres.T).max(axis=1)))]])
    for _ in range(ROUNDS):
        near = np.argmax(v @ centres.T, axis=1)
        centres = np.stack([v[near == j].mean(axis=0) if (near == j).any() else c for j, c in enumerate(centres)])
        norm = np.linalg.norm(centres, axis=1, keepdims=True)
        centres = centres / np.where(norm > 0, norm, 1)
    return centres.astype(np.float32)


def fit(documents: DataFrame, learn: Column, sample: int = SAMPLE, clusters: int = CLUSTERS) -> Model:
    """Fit on the rows of ``documents`` (a file scan) where ``learn`` holds and lang is not null."""
    rows = with_row_id(documents, "uid").filter(learn & F.col("lang").isNotNull()).select("uid", "lang", "text")

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, n = np.zeros(DIMS, np.int64), 0
        for b in batches:
            offsets, data = utf8(b.column(0))
            for _, counts in gram_counts(offsets, data):
                seen += (counts > 0).sum(axis=0)
            n += len(b)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(DIMS + 1)), pa.array(np.append(seen, n))], ["place", "n"])

    totals = rows.select("text").mapInArrow(frequencies, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).collect()  # DIMS + 1 rows
    df = np.zeros(DIMS + 1)
    for r in totals:
        df[r["place"]] = r["n"]
    idf = (np.log((1 + df[-1]) / (1 + df[:-1])) + 1).astype(np.float32)

    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # a row per language, as the model has
    if not sizes:
        return Model(idf, [], np.zeros(0, int), np.zeros((0, DIMS), np.float32), np.zeros(32))
    share = F.create_map(*(x for lang, n in sizes.items() for x in (F.lit(lang), F.lit(min(1.0, sample / n)))))
    chosen = rows.filter(F.pmod(F.xxhash64("uid"), F.lit(1 << 20)) < share[F.col("lang")] * (1 << 20))

    def first_centres(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("uid")
        counts = np.vstack([c for _, c in vectors(frame["text"])])
        counts = counts[counts.sum(axis=1) > 0]
        c = cluster(tf_idf(counts, idf), clusters) if len(counts) else []
        return pd.DataFrame({"lang": [frame["lang"].iloc[0]] * len(c), "centroid": [x.tobytes() for x in c]}, columns=["lang", "centroid"])

    found = chosen.groupBy("lang").applyInPandas(first_centres, "lang string, centroid binary").collect()
    found.sort(key=lambda r: (r["lang"], bytes(r["centroid"])))
    langs = sorted({r["lang"] for r in found})
    owner = np.array([langs.index(r["lang"]) for r in found], int)
    centroids = np.array([np.frombuffer(r["centroid"], np.float32) for r in found]).reshape(-1, DIMS)
    if not langs:
        return Model(idf, langs, owner, centroids, np.zeros(32))
    learned = rows.filter(F.col("lang").isin(langs)).select("text", "lang")
    for _ in range(ROUNDS):
        moved = _moved(learned, idf, langs, owner, centroids)
        change, centroids = np.abs(moved - centroids).max(), moved
        if change < STILL:
            break
    return Model(idf, langs, owner, centroids, _least(learned, idf, langs, owner, centroids))


def _own(batch: pa.RecordBatch, idf: np.ndarray, langs: list[str], owner: np.ndarray, centroids: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """For ranges of rows (text, lang) that have n-grams: language, vector, n-gram counts, and nearest centroid of the own language with its cosine."""
    offsets, data = utf8(batch.column(0))
    lang = np.array([langs.index(x) for x in batch.column(1).to_pylist()], int)
    for lo, counts in gram_counts(offsets, data):
        some = counts.sum(axis=1) > 0
        counts, own = counts[some], lang[lo:lo + len(counts)][some]
        v = tf_idf(counts, idf)
        cosine = np.where(owner[None] == own[:, None], v @ centroids.T, -np.inf)
        near = cosine.argmax(axis=1) if len(v) else own
        yield own, v, counts, near, cosine[np.arange(len(v)), near]


def _moved(learned: DataFrame, idf: np.ndarray, langs: list[str], owner: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """One round of the clustering over all rows: the mean direction of each centroid's rows; one without rows stays."""
    shared = learned.sparkSession.sparkContext.broadcast((idf, langs, owner, centroids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shared.value[3].shape)
        for b in batches:
            for _, v, _, near, _ in _own(b, *shared.value):
                for j in np.unique(near):
                    total[j] += v[near == j].sum(axis=0, dtype=np.float64)
        flat = np.rint(total.ravel() / UNIT).astype(np.int64)
        at = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(flat[at])], ["place", "total"])

    sums = learned.mapInArrow(run, "place long, total long").groupBy("place").agg(F.sum("total").alias("total")).toArrow()  # as many rows as the model has numbers
    out = np.zeros(centroids.size)
    out[sums.column("place").to_numpy()] = sums.column("total").to_numpy()
    out = out.reshape(centroids.shape)
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    return np.where(norm > 0, out / np.where(norm > 0, norm, 1), centroids).astype(np.float32)


def _least(learned: DataFrame, idf: np.ndarray, langs: list[str], owner: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Rejection threshold of each length class, from the cosines of all rows, counted by language, class and bin."""
    shared = learned.sparkSession.sparkContext.broadcast((idf, langs, owner, centroids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(len(langs) * 32 * BINS, np.int64)
        for b in batches:
            for own, _, counts, _, cosine in _own(b, *shared.value):
                bin_ = (cosine * BINS).astype(int).clip(0, BINS - 1)
                n += np.bincount((own * 32 + length_class(counts)) * BINS + bin_, minlength=len(n))
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n[at])], ["place", "n"])

    got = learned.mapInArrow(run, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).toArrow()
    n = np.zeros(len(langs) * 32 * BINS, np.int64)
    n[got.column("place").to_numpy()] = got.column("n").to_numpy()
    reaching = n.reshape(-1, 32, BINS)[:, ::-1].cumsum(axis=1)[:, ::-1].cumsum(axis=2)  # rows of that length or more, up to each bin
    size = reaching[:, :, -1:]
    least = np.where(size[..., 0] > 0, (reaching > size // OUTLIERS).argmax(axis=2) / BINS, 2.0).min(axis=0)
    reached = least[least < 2]
    least = np.where(least < 2, least, reached.max(initial=0)) * SLACK
    least[:SHORT] = -1
    return least


def predictor(documents: DataFrame, model: Model):
    """A column function: text to struct(lang_pred, score, rejected)."""
    shared = documents.sparkSession.sparkContext.broadcast(vars(model))

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def predict(texts: pd.Series) -> pd.DataFrame:
        m = Model(**shared.value)
        lang, score, rejected = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts)), np.ones(len(texts), bool)
        if len(m.centroids):
            for lo, counts in vectors(texts):
                cosine = tf_idf(counts, m.idf) @ m.centroids.T
                best = cosine.argmax(axis=1)
                top = cosine[np.arange(len(best)), best]
                lang[lo:lo + len(best)] = [m.langs[m.owner[b]] for b in best]
                score[lo:lo + len(best)] = top.clip(0, 1)
                rejected[lo:lo + len(best)] = top < m.least[length_class(counts)]
        blank = np.array([t is None or t != t or not any(map(str.isalpha, t)) for t in texts], bool)
        lang[blank], score[blank], rejected[blank] = UNKNOWN, 0.0, True
        return pd.DataFrame({"lang_pred": lang, "score": score, "rejected": rejected})

    return predict


def part(modulus: int) -> Column:
    return F.pmod(F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")), F.lit(modulus))


def identify(documents: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected: one row per document."""
    held = F.coalesce(part(3) == 1, F.lit(False))
    model = fit(documents, part(3) != 1)
    out = documents.select("doc_id", held.alias("held_out"), predictor(documents, model)(F.col("text")).alias("p"))
    return out.select("doc_id", "held_out", "p.lang_pred", "p.score", "p.rejected")
