"""WARC archives, phrase collocations and the Merkle manifest against brute force; row ids."""

import os
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from callstar.llm import op2_exact, op9_pii, op11_warc, op12_collocations, op13_merkle
from callstar.llm.common import with_row_id

from .conftest import LONG, ODD, PARA


def same(a, b):
    return sorted(map(repr, a)) == sorted(map(repr, b))


# -- row ids -------------------------------------------------------------------

def test_row_ids_do_not_depend_on_the_splits(spark, odd):
    before = with_row_id(odd.select("doc_id", "text"), "uid").select("uid", F.xxhash64("doc_id", "text")).collect()
    spark.conf.set("spark.sql.leafNodeDefaultParallelism", "1")
    try:
        after = with_row_id(odd.select("doc_id", "text"), "uid").select("uid", F.xxhash64("doc_id", "text")).collect()
    finally:
        spark.conf.unset("spark.sql.leafNodeDefaultParallelism")
    assert same(before, after) and len({r["uid"] for r in before}) == len(ODD)
    own = with_row_id(spark.range(7).withColumnRenamed("id", "uid"), "uid")  # no file scan: written once
    assert len({r["uid"] for r in own.collect()}) == 7


@pytest.mark.parametrize("run", [lambda d: op2_exact.exact_groups(d).drop("uid", "keep_uid"), op9_pii.find])
def test_results_survive_a_change_of_the_cluster_between_stages(spark, run, tmp_path, monkeypatch):
    """Every staged step sees another number of cores, as when executors come and go."""
    path = str(tmp_path / "docs")
    texts = [f"text {k % 40} mail a{k % 7}@b.org ip 10.0.0.{k % 9}" for k in range(400)]
    spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string").repartition(8).write.parquet(path)
    want = run(spark.read.parquet(path)).collect()
    from callstar.llm import common
    plain, calls = common.stage, []

    def moved(df, tag):
        calls.append(tag)
        spark.conf.set("spark.sql.leafNodeDefaultParallelism", str(1 + len(calls) % 7))
        return plain(df, tag)
    monkeypatch.setattr(run.__globals__["op2_exact"] if run.__name__ == "<lambda>" else op9_pii, "stage", moved)
    try:
        got = run(spark.read.parquet(path)).collect()
    finally:
        spark.conf.unset("spark.sql.leafNodeDefaultParallelism")
    assert calls and same(got, want)


# -- WARC ------------------------------------------------------------------------

PAGES = [(1, "http://a/", "<p>" + "x" * 200), (2, "http://b/\r\nX: y", "<p>" + "x" * 200), (3, None, None), (4, "u", ""), (5, "u", "short"), (6, "u", "short"),
         (7, "http://é/", "é" * 50), (8, "v", "é" * 50), (9, "v", "é" * 49), (None, "w", "<p>" + "x" * 200), (None, None, "n" * 100), (None, None, "n" * 100),
         (10, "v", "WARC/1.1\r\nWARC-Type: response\r\n\r\n" + "z" * 120), (11, "v", "a\r\n\r\nb\0c" * 40), (1, "v", "<p>" + "x" * 200), (12, "big", LONG)]


@pytest.fixture(scope="module")
def pages(spark, tmp_path_factory):
    path = os.path.join(str(tmp_path_factory.mktemp("pages")), "pages.parquet")
    rows = [(*r, 1, "x", 5, "k") for r in PAGES]
    spark.createDataFrame(rows, "page_id long, url string, html string, uid int, digest string, n int, kind string").repartition(3).write.parquet(path)
    return spark.read.parquet(path)


def warc_truth():
    first, out = {}, []
    for i, _, html in sorted(PAGES, key=lambda r: (r[0] is None, r[0] or 0)):
        body = (html or "").encode()
        head = None
        if len(body) >= 100:
            if body in first:
                head = first[body]
            else:
                first[body] = (i,)
        out.append((i, len(body), sha256(body).hexdigest(), "revisit" if head else "response", head[0] if head else None))
    return out


@pytest.mark.parametrize("compress", [True, False])
def test_warc_round_trip(pages, compress):
    got = op11_warc.round_trip(pages, compress)
    assert same([(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got.collect()], warc_truth())
    assert "http://b/%0D%0AX: y" in {r["url"] for r in got.collect()}


def test_warc_of_no_pages(spark, pages, tmp_path):
    path = str(tmp_path / "none")
    pages.limit(0).write.parquet(path)
    assert op11_warc.round_trip(spark.read.schema(pages.schema).parquet(path)).collect() == []


def records(n, compress):
    out = []
    for k in range(n):
        payload = (f"payload {k} " * (20 + k)).encode()
        one = op11_warc.record(k, k, "http://x/", payload, sha256(payload).hexdigest(), None, None)
        out.append(zlib.compress(one, 6, 31) if compress else one)
    return out


def salvaged(data):
    got = list(op11_warc.salvage(data))
    spans = sorted({(at, at + n) for _, at, n, _ in got})
    assert not data or spans[0][0] == 0 and spans[-1][1] == len(data) and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))  # nothing unaccounted for
    return [int(r["head"]["x-page-id"]) for what, _, _, r in got if what == "record"], [(at, n, why) for what, at, n, why in got if what == "gap"]


@pytest.mark.parametrize("compress", [True, False])
def test_salvage_goes_on_after_damage(compress):
    parts = records(8, compress)
    starts = [sum(map(len, parts[:k])) for k in range(9)]
    whole = b"".join(parts)
    assert salvaged(whole) == (list(range(8)), [])
    for k in range(8):  # one byte near the end of each record (of a plain one: in its block, as digests do not cover the header)
        at = starts[k + 1] - 10
        ids, gaps = salvaged(whole[:at] + bytes([whole[at] ^ 0x55]) + whole[at + 1:])
        assert ids == [x for x in range(8) if x != k]
        assert [g[:2] for g in gaps] == [(starts[k], len(parts[k]))] and gaps[0][2]
    ids, gaps = salvaged(whole[:starts[3] + 15] + whole[starts[4] - 2:])  # most of one record lost: its neighbours stay
    assert ids == [0, 1, 2, 4, 5, 6, 7] and len(gaps) == 1
    junk = b"\x1f\x8b\x08junk WARC/1.1\r\nWARC/1.0 \x1f\x8b"
    ids, gaps = salvaged(junk + b"".join(parts[:2]) + junk + b"".join(parts[2:]) + junk)
    assert ids == list(range(8)) and [g[1] for g in gaps] == [len(junk)] * 3
    ids, gaps = salvaged(whole[:-9])
    assert ids == list(range(7)) and len(gaps) == 1
    assert salvaged(b"") == ([], []) and salvaged(b"nothing here")[0] == []


@pytest.mark.parametrize("compress", [True, False])
def test_damaged_archives_are_read_and_logged(spark, pages, tmp_path, compress):
    path = str(tmp_path / "warc")
    op11_warc.write_archives(pages, path, compress, archive_bytes=2000)
    files = sorted(f for f in os.listdir(path) if f.startswith("part"))
    assert sum(os.path.getsize(os.path.join(path, f)) > 0 for f in files) > 1
    os.makedirs(tmp_path / "hurt")
    for f in files:
        data = bytearray(open(os.path.join(path, f), "rb").read())
        if data:
            data[len(data) // 3] ^= 0xFF
        open(tmp_path / "hurt" / f, "wb").write(data)
    got = op11_warc.read_archives(spark, str(tmp_path / "hurt")).collect()
    gaps = [r for r in got if r["what"] == "gap"]
    assert gaps and all(r["reason"] and r["length"] > 0 for r in gaps)
    whole = {r["record_id"] for r in op11_warc.read_archives(spark, path).collect()}
    kept = [r for r in got if r["what"] == "record"]
    assert len(whole) == len(PAGES) and len(kept) >= len(PAGES) - len(gaps) and {r["record_id"] for r in kept} <= whole
    assert all(sha256(r["payload"]).hexdigest() == r["payload_digest"] for r in kept if r["kind"] == "response")


def test_records_beyond_the_length_byte():
    """A member of 16 MiB and more ends in another byte than 0; an empty member follows it."""
    payload = b"y" * (17 << 20)
    import pyarrow as pa
    row = pa.RecordBatch.from_pylist([{"uid": 5, "page_id": 5, "url": None, "payload": payload, "digest": sha256(payload).hexdigest(), "response": None, "response_page": None}])
    value = next(op11_warc._values(True)(iter([row]))).column("value")[0].as_py()
    got = list(op11_warc.salvage(value + b"\0"))
    assert [(what, r["payload"] == payload) for what, _, _, r in got] == [("record", True)]


# -- collocations -----------------------------------------------------------------

def collocation_truth(rows, least, longest, reported=2000):
    n, f = Counter(), defaultdict(Counter)
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                f[lang].update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        found = []
        for p, a in counts.items():
            if len(p) < 2 or a < least:
                continue
            if any(len(q) > len(p) and c >= least and 100 * c >= 50 * a and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, c in counts.items()):
                continue
            score, _, left, right = min((1_000_000 * a * a // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            found.append((" ".join(p), a, left, right, score))
        found.sort(key=lambda x: (-x[4], -x[1], x[0].encode()))
        out += [(lang, i + 1, p, a, left, right, n[lang], s) for i, (p, a, left, right, s) in enumerate(found[:reported])]
    return out


WORDY = [("en", "The cat sat. the CAT sat on the mat, the cat ran"), (None, "a b a b a b a b"), ("und", "a b\ta b"), ("fr", "l'été é b; É b é b é b"), ("en", "the cat sat on"),
         ("en", None), ("de", ""), ("en", "on the mat on the mat on the mat x y z x y z"), ("en", "the cat sat. the CAT sat on the mat"), ("fr", "b\x0bé b\x0cé b \xa0é b")] * 2


@pytest.mark.parametrize("least,longest,reported", [(2, 3, 2000), (3, 2, 2000), (2, 4, 3)])
def test_collocations(spark, tmp_path, least, longest, reported):
    path = str(tmp_path / "wordy")
    spark.createDataFrame([(k, lang, text, 1, 2, "w") for k, (lang, text) in enumerate(WORDY)], "doc_id long, lang string, text string, n int, at int, w1 string").repartition(3).write.parquet(path)
    got = [tuple(r) for r in op12_collocations.collocations(spark.read.parquet(path), least, longest, reported).collect()]
    assert same(got, collocation_truth(WORDY, least, longest, reported))
    assert any(r[0] == "und" for r in got)


def test_collocations_of_odd_documents(odd, empty):
    rows = [(r["lang"], r["text"]) for r in odd.select("lang", "text").collect()]
    rows = [(lang, text) for lang, text in rows if text is None or len(text) < 10_000]
    got = op12_collocations.collocations(odd.filter("text is null or length(text) < 10000"), 2)
    assert same(map(tuple, got.collect()), collocation_truth(rows, 2, 3))
    assert op12_collocations.collocations(empty).collect() == []


def test_collocations_are_exact_under_a_shared_hash(spark, tmp_path, monkeypatch):
    """A base under which words collide is noticed, and the next one taken."""
    monkeypatch.setattr(op12_collocations, "BASES", (1, *op12_collocations.BASES))  # base 1: a word's hash is the sum of its bytes
    path = str(tmp_path / "sums")
    rows = [("en", "ab cd. ba dc. ab cd. ba dc")]
    spark.createDataFrame(rows, "lang string, text string").write.parquet(path)
    got = [tuple(r) for r in op12_collocations.collocations(spark.read.parquet(path), 2).collect()]
    assert same(got, collocation_truth(rows, 2, 3)) and len(got) == 2


def test_score_beyond_64_bits(spark):
    a, left, right = 123_456_789_012, 999_999_999_999, 234_567_890_123
    got = spark.range(1).select(op12_collocations._score(F.lit(a), F.lit(left), F.lit(right)).alias("s")).first()["s"]
    assert got == 1_000_000 * a * a // (left * right)


def test_a_full_filter_changes_nothing(spark, tmp_path, monkeypatch):
    """Every group passes a saturated filter: the counts alone still give the result."""
    path = str(tmp_path / "wordy")
    spark.createDataFrame([(k, lang, text) for k, (lang, text) in enumerate(WORDY)], "doc_id long, lang string, text string").write.parquet(path)
    plain = op12_collocations.frequent_filter
    monkeypatch.setattr(op12_collocations, "frequent_filter", lambda g, k: plain(g, k) | ~plain(g, k))
    assert same(map(tuple, op12_collocations.collocations(spark.read.parquet(path), 2).collect()), collocation_truth(WORDY, 2, 3))


# -- Merkle manifest -----------------------------------------------------------------

def h(*x):
    return sha256("".join(x).encode()).hexdigest()


def merkle_truth(rows):
    def leaf(values):
        return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))

    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([h(*out[-1][i:i + 2]) for i in range(0, len(out[-1]), 2)])
        return out

    def path(tree, i):
        for level in tree[:-1]:
            yield (level[i ^ 1] if i ^ 1 < len(level) else None), i & 1
            i >>= 1
    groups = defaultdict(list)
    for r in rows:
        changed = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[3] is not None
        groups[r[2]].append((r[0] is not None, r[0] or 0, leaf(r), leaf((*r[:3], r[3] + 1, r[4])) if changed else None, r[0]))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: levels([x[2] for x in sorted(groups[g], key=lambda x: x[:3])]) for g in names}
    crown = levels([trees[g][-1][0] for g in names])
    out = []
    for k, g in enumerate(names):
        for i, (_, _, own, changed, doc) in enumerate(sorted(groups[g], key=lambda x: x[:3])):
            steps = [*path(trees[g], i), *path(crown, k)]
            now = changed or own
            for other, odd in steps:
                now = h(now) if other is None else h(other, now) if odd else h(now, other)
            out.append((doc, own, trees[g][-1][0], crown[-1][0], h(*(o for o, _ in steps if o)), now, now == crown[-1][0]))
    return out


@pytest.mark.parametrize("levels", [8, 1, 2])
def test_manifest(odd, levels, monkeypatch):
    """Blocks of every size give the same tree; several tiers with small blocks."""
    monkeypatch.setattr(op13_merkle, "LEVELS", levels)
    rows = [tuple(r) for r in odd.select(*op13_merkle.FIELDS).collect()]
    got = [tuple(r) for r in op13_merkle.manifest(odd).drop("position", "witness").collect()]
    assert same(got, merkle_truth(rows))


@pytest.mark.parametrize("n", [1, 2, 3, 5, 8, 9, 17])
def test_ragged_trees(spark, tmp_path, n, monkeypatch):
    monkeypatch.setattr(op13_merkle, "LEVELS", 2)
    path = str(tmp_path / "docs")
    rows = [(k * 7, "s", None if k % 5 == 4 else "x", None if k % 3 else k, PARA[:k]) for k in range(n)]
    spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(4).write.parquet(path)
    got = [tuple(r) for r in op13_merkle.manifest(spark.read.parquet(path)).drop("position", "witness").collect()]
    assert same(got, merkle_truth(rows))


def test_empty_manifest(empty):
    assert op13_merkle.manifest(empty).collect() == []


def test_collocation_tasks_hold_few_words_at_once():
    text = " ".join(f"w{i % 5000}" for i in range(350))
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * 7000), pa.array([text] * 7000)], ["lang", "text"])
    tracemalloc.start()
    out = [b.num_rows for b in op12_collocations._occurrences(op12_collocations.BASES[0])(iter([batch]))]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(out) == 7000 + 350
    assert peak < 250 << 20


def test_collocation_words_of_one_hash_are_seen_across_batches():
    batches = [pa.RecordBatch.from_arrays([pa.array(["en"]), pa.array([t])], ["lang", "text"]) for t in ("ab ab", "ba")]
    shown = pa.Table.from_batches(list(op12_collocations._occurrences(1)(iter(batches)))).filter(pc.is_valid(pc.field("word")))
    assert sorted(zip(shown["word"].to_pylist(), shown["n"].to_pylist())) == [(b"ab", 3), (b"ba", 0)]  # base 1: a word's hash is the sum of its bytes
