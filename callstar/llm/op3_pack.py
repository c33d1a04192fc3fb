"""Hierarchical multi-length packing.

Each task tokenises and packs its own rows in one pass, without a shuffle:

* a document is cut into full windows of the longest tier; its remainder goes
  to the smallest tier (context size) that holds it;
* each tier is packed by best fit, longest first, over a pool of remainders, kept
  by length; a gap in a window is filled from the pieces of this and the
  shorter tiers, longest fitting one first, and closed by cutting one piece;
* what is left at the end of the task is laid end to end and split into
  windows of falling powers of two, so no position is padded;
* windows of one tier form step groups of ``STEP_TOKENS`` positions each, so
  every step has the same shape and work; the last windows of a task share one.

Sizes of windows are powers of two, the longest ``WINDOW``. The pool holds at
most ``POOL`` tokens, so memory is bounded; the order of rows within a file
split fixes the result, and a repeated task gives the same rows.

Defined cases: null or empty text is the closing id alone; a very long text
becomes many full windows; repeated rows are packed once each, under the same
doc_id; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import os
import re
import zlib
from bisect import bisect_right, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TIERS = (128, 256, 512, 1024)
WINDOW = TIERS[-1]
STEP_TOKENS = 8 * WINDOW
#: Tokens of remainders that a task keeps to choose from.
POOL = 1 << 18
END = 0
SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
          "sequence_length int, tier int, step_group long")
#: Texts of each task whose ids are compared with those of the tokenizer file.
CHECKED = 16


class Encoder:
    """Ids of whole texts, as the library ``tokenizers`` gives them.

    The same vocabulary as rank file gives the same ids several times faster
    through ``tiktoken``; the first texts of each task are encoded by both, and
    a difference stops the job. A text that holds one of the tokenizer's added
    tokens (such as ``<|endoftext|>``) is left to ``tokenizers``, which takes
    it for that token.
    """

    def __init__(self, path: str, ranks: str, pattern: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks already share out the cores
        import tiktoken
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        added = [t.content for t in self.model.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        with open(ranks, "rb") as lines:
            merges = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=merges, special_tokens={})
        self.unchecked = CHECKED

    def encode(self, text: str) -> np.ndarray:
        if self.added and self.added.search(text):
            return np.array([*self.model.encode(text, add_special_tokens=False).ids, END], "<u4")
        ids = self.fast.encode_ordinary(text)
        if self.unchecked > 0 and len(text) < 10_000:
            self.unchecked -= 1
            if ids != self.model.encode(text, add_special_tokens=False).ids:
                raise ValueError("the rank file and the tokenizer file give different ids")
        return np.array([*ids, END], "<u4")


class Packer:
    """Packs the pieces of one task; ``rows`` collects finished ones."""

    def __init__(self, task: int, tiers: tuple[int, ...] = TIERS, step_tokens: int = STEP_TOKENS, pool: int = POOL):
        self.task, self.tiers, self.step_tokens, self.pool = task, tiers, step_tokens, pool
        self.by_length: dict[int, list] = defaultdict(list)  # length -> pieces (doc_id, start, ids, doc_tokens)
        self.held, self.sequences, self.groups = 0, 0, 0
        self.open: dict[int, tuple[int, int]] = {}  # tier -> its step group and the positions in it
        self.loose: tuple[int, int] = (-1, 0)
        self.rows: list[tuple] = []

    def _group(self, size: int, last: bool) -> int:
        group, used = self.loose if last else self.open.get(size, (-1, 0))
        if group < 0 or used + size > self.step_tokens:
            group, used = (self.task << 32) + self.groups, 0
            self.groups += 1
        if last:
            self.loose = (group, used + size)
        else:
            self.open[size] = (group, used + size)
        return group

    def emit(self, size: int, pieces: list, last: bool = False) -> None:
        sequence, at = (self.task << 40) + self.sequences, 0
        self.sequences += 1
        total = sum(len(p[2]) for p in pieces)
        group = self._group(size, last)
        for doc, start, ids, doc_tokens in pieces:
            self.rows.append((doc, start, len(ids), zlib.crc32(ids.tobytes()), doc_tokens, sequence, at, total, size, group))
            at += len(ids)

    def add(self, doc, ids: np.ndarray) -> None:
        n, at = len(ids), 0
        while n - at >= self.tiers[-1]:
            self.emit(self.tiers[-1], [(doc, at, ids[at:at + self.tiers[-1]], n)])
            at += self.tiers[-1]
        if at < n:
            self.by_length[n - at].append((doc, at, ids[at:], n))
            self.held += n - at
            if self.held > self.pool:
                self.pack()

    def _pop(self, at: int):
        """A piece of the length at this place of the sorted lengths."""
        size = self.lengths[at]
        piece = self.by_length[size].pop()
        if not self.by_length[size]:
            del self.by_length[size], self.lengths[at]
        return piece

    def pack(self) -> None:
        """Fill windows from the longest tier down while enough is left to fill one."""
        self.lengths = sorted(self.by_length)
        for k in range(len(self.tiers) - 1, -1, -1):
            tier, below = self.tiers[k], self.tiers[k - 1] if k else 0
            while self.held >= tier:
                at = bisect_right(self.lengths, tier) - 1
                if at < 0 or self.lengths[at] <= below:
                    break
                pieces, gap = [], tier
                while gap:
                    at = bisect_right(self.lengths, gap) - 1  # the longest that fits
                    if at >= 0:
                        pieces.append(self._pop(at))
                    else:  # cut the shortest: its head fills the gap, its tail returns
                        doc, start, ids, doc_tokens = self._pop(0)
                        left = len(ids) - gap
                        if left not in self.by_length:
                            insort(self.lengths, left)
                        self.by_length[left].append((doc, start + gap, ids[gap:], doc_tokens))
                        pieces.append((doc, start, ids[:gap], doc_tokens))
                    gap -= len(pieces[-1][2])
                self.held -= tier
                self.emit(tier, pieces)

    def close(self) -> None:
        self.pack()
        rest = [p for n in sorted(self.by_length, reverse=True) for p in self.by_length[n]]
        self.by_length.clear()
        while self.held:
            size = min(self.tiers[-1], 1 << (self.held.bit_length() - 1))
            pieces, gap = [], size
            while gap:
                doc, start, ids, doc_tokens = rest.pop()
                if len(ids) > gap:
                    rest.append((doc, start + gap, ids[gap:], doc_tokens))
                    ids = ids[:gap]
                pieces.append((doc, start, ids, doc_tokens))
                gap -= len(ids)
            self.held -= size
            self.emit(size, pieces, last=True)


def pack_documents(documents: DataFrame, tokenizer_path: str | None = None, ranks_path: str | None = None,
                   pattern: str | None = None) -> DataFrame:
    """Pieces of all rows of ``documents`` (columns doc_id, text)."""
    import public_tokenizers

    tokenizer_path = tokenizer_path or public_tokenizers.path("byte_bpe_50k.json")
    ranks_path = ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    pattern = pattern or public_tokenizers.PATTERN
    types = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()),
             ("sequence_id", pa.int64()), ("offset", pa.int64()), ("sequence_length", pa.int32()), ("tier", pa.int32()), ("step_group", pa.int64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, packer = Encoder(tokenizer_path, ranks_path, pattern), Packer(TaskContext.get().partitionId())

        def flush() -> pa.RecordBatch:
            columns = list(zip(*packer.rows)) or [()] * len(types)
            packer.rows = []
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, types)], [n for n, _ in types])

        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for doc, text in zip(ids, texts):
                packer.add(doc.as_py(), encoder.encode(text.as_py() or ""))
                if len(packer.rows) >= 10_000:
                    yield flush()
        packer.close()
        yield flush()

    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, SCHEMA)
