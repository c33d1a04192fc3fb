"""Operators on documents: defined cases against brute force."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from callstar.llm import op2_exact, op3_pack, op8_hilbert, op9_pii, op10_jaccard

from .conftest import ODD


def same(a, b):
    return sorted(map(repr, a)) == sorted(map(repr, b))


# -- exact dedup ------------------------------------------------------------

def exact_truth(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    out = []
    for i, t in rows:
        ids = groups[t or ""]
        keep = max((x for x in ids if x is not None), default=None)
        out.append((i, keep, len(ids), hashlib.sha256((t or "").encode()).hexdigest()))
    return out


@pytest.mark.parametrize("chunk", [op2_exact.CHUNK, 7])
def test_exact_groups(odd, chunk):
    rows = ODD if chunk > 7 else [r for r in ODD if len(r[1] or "") < 1000]
    docs = odd if chunk > 7 else odd.filter("text is null or length(text) < 1000")
    got = op2_exact.exact_groups(docs, chunk).collect()
    assert same([(r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got], exact_truth(rows))
    kept = [r for r in got if r["kept"]]
    assert len(kept) == len({t or "" for _, t in rows})
    assert all(r["doc_id"] == r["keep_id"] for r in kept)


def test_exact_collisions_are_told_apart(odd, monkeypatch):
    """Fingerprints that see the length only: the comparison of the bytes still gives the right groups."""
    monkeypatch.setattr(op2_exact, "chunk_hashes", lambda offsets, data, shift: [np.zeros(len(shift), np.int64)] * 2)
    got = op2_exact.exact_groups(odd).collect()
    assert same([(r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got], exact_truth(ODD))


def test_fingerprint_composes():
    data = np.frombuffer(bytes(range(256)) * 3, np.uint8)
    whole = op2_exact.chunk_hashes(np.array([0, len(data)]), data, np.array([0]))
    parts = op2_exact.chunk_hashes(np.array([0, 100, 500, len(data)]), data, np.array([0, 100, 500]))
    for (p, _), w, x in zip(op2_exact.MODULI, whole, parts):
        assert w[0] == x.sum() % p


# -- packing -----------------------------------------------------------------

def test_packing_round_trip(odd):
    import public_tokenizers
    from tokenizers import Tokenizer
    model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert model.encode("a <|endoftext|> b", add_special_tokens=False).ids == [64, 220, 50256, 275]
    truth = Counter()
    for i, t in ODD:
        truth[(i, tuple(model.encode(t or "", add_special_tokens=False).ids) + (0,))] += 1
    pieces = op3_pack.pack_documents(odd).collect()
    for (doc, ids), copies in truth.items():
        whole = np.array(ids, "<u4")
        mine = sorted((p["start"], p["length"], p["ids_crc32"]) for p in pieces if p["doc_id"] == doc and p["doc_tokens"] == len(ids))
        same_size = sum(c for (d, x), c in truth.items() if d == doc and len(x) == len(ids))
        if same_size == copies:
            assert sum(n for _, n, _ in mine) == len(ids) * copies
            assert all(zlib.crc32(whole[s:s + n].tobytes()) == c for s, n, c in mine)
    by_sequence = defaultdict(list)
    for p in pieces:
        by_sequence[p["sequence_id"]].append(p)
    for ps in by_sequence.values():
        ps.sort(key=lambda p: p["offset"])
        assert [p["offset"] for p in ps] == list(np.cumsum([0] + [p["length"] for p in ps])[:-1])
        total = sum(p["length"] for p in ps)
        assert total <= 1024 and total & (total - 1) == 0  # a power of two: no padding


def test_packer_cuts_nothing_away():
    rng = np.random.default_rng(0)
    packer = op3_pack.Packer(0, pool=5_000)
    docs = [rng.integers(0, 9, n).astype("<u4") for n in rng.integers(1, 3000, 300)]
    for i, d in enumerate(docs):
        packer.add(i, d)
    packer.close()
    for i, d in enumerate(docs):
        mine = sorted(r for r in packer.rows if r[0] == i)
        assert np.cumsum([0] + [r[2] for r in mine])[:-1].tolist() == [r[1] for r in mine] and sum(r[2] for r in mine) == len(d)
    groups = defaultdict(dict)
    for r in packer.rows:
        groups[r[9]][r[5]] = r[8]
    full = [sum(g.values()) for g in groups.values()]
    assert max(full) == op3_pack.STEP_TOKENS and sum(f == op3_pack.STEP_TOKENS for f in full) >= len(full) - 5


# -- sharding -----------------------------------------------------------------

def test_shards(odd):
    got = op8_hilbert.shard_documents(odd).collect()
    text = lambda t: (t or "").encode()
    assert same([(r["doc_id"], r["size"], r["text_crc32"]) for r in got], [(i, len(text(t)) + 1, zlib.crc32(text(t))) for i, t in ODD])
    counts = Counter(r["shard"] for r in got)
    assert set(counts) <= set(range(16)) and max(counts.values()) - min(counts[s] for s in range(16)) <= 1
    for s, n in counts.items():
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(n))
    order = [r["hilbert"] for r in sorted(got, key=lambda r: (r["shard"], r["slot"]))]
    assert order == sorted(order)


def test_hilbert_neighbours():
    grid = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), -1).reshape(-1, 3)
    index = op8_hilbert.hilbert_index(grid, 3)
    assert sorted(index) == list(range(512))
    assert (np.abs(np.diff(grid[np.argsort(index)], axis=0)).sum(axis=1) == 1).all()


# -- n-gram join ----------------------------------------------------------------

def link_truth(rows):
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[j:j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    least = defaultdict(list)
    for k, (i, _) in enumerate(rows):
        least[find(k)].append(i)
    return [(rows[k][0], len(sets[k]), min((i for i in least[find(k)] if i is not None), default=None)) for k in range(len(rows))]


def test_jaccard_groups(odd):
    got = op10_jaccard.jaccard_groups(odd).collect()
    assert same([(r["doc_id"], r["n_shingles"], r["component_id"]) for r in got], link_truth(ODD))


@pytest.mark.parametrize("few,tile,tested,each", [(64, 2048, 1 << 18, 256), (2, 3, 4, 1 << 30), (4, 8, 50, 0)])
def test_jaccard_families_and_common_passages(spark, tmp_path, monkeypatch, few, tile, tested, each):
    """Chains of near copies, a passage in many texts, the order that puts its shingles last, and columns cut into many tiles."""
    for name, value in {"COMMON": 4, "FEW": few, "TILE": tile, "TESTED": tested, "HELD": 2 * tested, "PAIRS_EACH": each}.items():
        monkeypatch.setattr(op10_jaccard, name, value)
    rng = np.random.default_rng(3)
    word = lambda: f"v{rng.integers(0, 5000)}"
    passage = [word() for _ in range(30)]
    rows = []
    for i in range(60):  # share the passage, nothing else
        rows.append((i, " ".join([word() for _ in range(rng.integers(1, 60))] + passage + [word() for _ in range(rng.integers(0, 40))])))
    base = [word() for _ in range(120)]
    for i in range(60, 100):  # a drifting chain: neighbours are similar, the ends are not
        base[int(rng.integers(0, 120))] = word()
        rows.append((i, " ".join(base)))
    for i in range(100, 130):  # short texts
        rows.append((i, " ".join(passage[:int(rng.integers(3, 12))])))
    path = str(tmp_path / "d.parquet")
    spark.createDataFrame(rows, "doc_id long, text string").repartition(4).write.parquet(path)
    got = op10_jaccard.jaccard_groups(spark.read.parquet(path)).collect()
    truth = link_truth(rows)
    assert len({t[2] for t in truth}) < 120
    assert same([(r["doc_id"], r["n_shingles"], r["component_id"]) for r in got], truth)
    assert sorted(r["doc_id"] for r in got if r["kept"]) == sorted({t[2] for t in truth})


@pytest.mark.parametrize("whole", [1 << 12, 140, 20])
def test_jaccard_verifies_few_pairs_of_a_family(spark, tmp_path, monkeypatch, whole):
    """Near copies about as similar as a link asks for: few of their pairs are verified, in one row each unless sets are long, and every link counts."""
    rng = np.random.default_rng(11)
    base, rows = [f"v{k}" for k in range(150)], []
    for i in range(150):
        text = list(base)
        for at in rng.integers(5, 145, 2):
            text[at] = f"u{i}x{at}"
        rows.append((i, " ".join(text[:150 - int(rng.integers(0, 8))])))
    path = str(tmp_path / "d.parquet")
    spark.createDataFrame(rows, "doc_id long, text string").repartition(4).write.parquet(path)
    stage, seen = op10_jaccard.stage, Counter()

    def counting(df, tag):
        out = stage(df, tag)
        seen[tag] += out.count() if tag in ("pairs", "counts") else 0
        return out

    for name, value in {"stage": counting, "COMMON": 4, "WHOLE": whole}.items():
        monkeypatch.setattr(op10_jaccard, name, value, raising=name != "WHOLE")
    got = op10_jaccard.jaccard_groups(spark.read.parquet(path)).collect()
    truth = link_truth(rows)
    assert 1 < len({t[2] for t in truth}) < 75
    assert same([(r["doc_id"], r["n_shingles"], r["component_id"]) for r in got], truth)
    assert seen["pairs"] < 10 * len(rows) and seen["counts"] < 10 * len(rows)


def test_whole_rows_and_cut_rows(monkeypatch):
    """A set has the rows that its pairs ask for: whole up to ``WHOLE``, in blocks if one of its pairs may be longer."""
    monkeypatch.setattr(op10_jaccard, "WHOLE", 100)
    texts = [" ".join(f"w{k}" for k in range(n + 4)) for n in (50, 79, 80, 100, 101, 300)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(texts)], ["uid", "text"])
    got = pa.Table.from_batches(op10_jaccard._blocks(iter([batch]))).to_pylist()
    sizes = {(c, cut): sum(len(r["row"]) for r in got if r["c"] == c and (r["block"] >= 0) == cut) for c in range(6) for cut in (False, True)}
    assert [sizes[c, False] for c in range(6)] == [50, 79, 80, 100, 0, 0]
    assert [sizes[c, True] for c in range(6)] == [0, 0, 80, 100, 101, 300]


def test_jaccard_sql():
    """The SQL of the query on the odd documents."""
    db = duckdb.connect()
    db.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    db.executemany("INSERT INTO documents VALUES (?, ?)", ODD)
    assert same(db.execute(op10_jaccard.ORACLE).fetchall(), link_truth(ODD))


@pytest.mark.parametrize("size", [1, 7, 300])
def test_tile_nearest_by_parity(monkeypatch, size):
    """The nearest classes of each class, in tiles of odd sizes in batches of odd lengths, against all pairs."""
    monkeypatch.setattr(op10_jaccard, "TESTED", 16)
    rng = np.random.default_rng(6)
    column, bits = np.sort(rng.integers(0, 12, 300)), rng.integers(0, 1 << 16, (40, 4))
    c = rng.integers(0, 40, 300)
    table = pa.table({"s": column, "c": c, "n": np.full(300, 300), "root": c // 2, **{p: bits[c, k] for k, p in enumerate(op10_jaccard.PARITY)},
                      **{k: np.zeros(300, np.int32) for k in ("low", "i", "j", "side")}})
    truth = defaultdict(set)
    for s in range(12):
        for x in c[column == s]:
            for y in c[column == s]:
                far = sum(int(a ^ b).bit_count() for a, b in zip(bits[x], bits[y]))
                if x // 2 != y // 2 and far * 180 <= 600 * 20:
                    truth[int(x)].add((far / 600, int(y)))
    got = defaultdict(set)
    for b in op10_jaccard._tile_nearest(iter(table.to_batches(size))):
        for r in b.to_pylist():
            got[r["c"]].add((r["far"], r["other"]))
    assert got == {x: set(sorted(v)[:op10_jaccard.NEAREST]) for x, v in truth.items()}


@pytest.mark.parametrize("held", [1 << 20, 5])
def test_tile_counts_are_the_product(monkeypatch, held):
    """Tiles of odd sizes in batches of odd lengths against all pairs, counted column by column."""
    monkeypatch.setattr(op10_jaccard, "TESTED", 16)
    monkeypatch.setattr(op10_jaccard, "HELD", held)
    rng = np.random.default_rng(5)
    column = np.sort(rng.integers(0, 12, 300))
    rows = {"s": column, "c": rng.integers(0, 40, 300), "n": rng.integers(90, 130, 300)}
    rows["n"], rows["root"] = 90 + rows["c"], rows["c"] // 2
    table = pa.table({**rows, **{p: np.zeros(300, np.int64) for p in op10_jaccard.PARITY}, **{k: np.zeros(300, np.int32) for k in ("low", "i", "j", "side")}})
    truth = Counter()
    for s in range(12):
        at = rows["c"][column == s]
        for k, x in enumerate(at):
            for y in at[k + 1:]:
                if x // 2 != y // 2 and min(x, y) + 90 >= 0.8 * (max(x, y) + 90):
                    truth[min(x, y), max(x, y)] += 1
    for size in (1, 7, 300):
        got = Counter()
        for b in op10_jaccard._tile_counts(iter(table.to_batches(size))):
            for r in b.to_pylist():
                assert held == 5 or (r["x"], r["y"]) not in got
                got[r["x"], r["y"]] += r["k"]
        assert got == truth


@pytest.mark.parametrize("held", [1 << 20, 5])
def test_tile_counts_drop_pairs_that_share_too_little(monkeypatch, held):
    """Sixty long sets share a passage of 20 columns, two of them 60 columns more under two leads: only that pair is passed on, with all of its columns."""
    monkeypatch.setattr(op10_jaccard, "TESTED", 16)
    monkeypatch.setattr(op10_jaccard, "HELD", held)
    rows = [(1, s, c) for s in range(20) for c in range(60)] + [(2 + s % 2, 20 + s, c) for s in range(60) for c in (3, 4)]
    rows.sort()
    lead, s, c = (np.array(x, np.int64) for x in zip(*rows))
    rest = np.array([(c == x).sum() - ((c == x) & (lead == y)).sum() for x, y in zip(c, lead)])
    table = pa.table({"s": s, "c": c, "n": np.full(len(c), 800), "root": c, "lead": lead, **{p: np.zeros(len(c), np.int64) for p in op10_jaccard.PARITY},
                      "rest": rest, **{k: np.zeros(len(c), np.int32) for k in ("low", "i", "j", "side")}})
    for size in (1, 7, 5000):
        got, others = Counter(), 0
        for b in op10_jaccard._tile_counts(iter(table.to_batches(size))):
            for r in b.to_pylist():
                got[r["x"], r["y"]] += r["k"]
                others += (r["x"], r["y"]) != (3, 4)
        assert got[3, 4] == 80 and (others == 0 or held == 5)  # 800 and 800 need 72 of them


# -- personal data ----------------------------------------------------------------

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def passes(kind, found):
    digits = [int(c) for c in re.sub("[^0-9]", "", found)]
    if kind == "ip":
        return all(int(x) <= 255 for x in found.split("."))
    if kind == "card":
        total = sum(d if k % 2 == 0 else d * 2 - 9 if d > 4 else d * 2 for k, d in enumerate(reversed(digits)))
        return 13 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def base_spans(text):
    return [f"{k}:{m.start()}:{m.end()}" for k, p in PATTERNS.items() for m in re.finditer(p, text) if passes(k, m[0])]


NASTY = ["a@b.co", "a@b.c.d_x@y.zz", "é a.b+c@d-e.f.g, ü", "1.2.3.4.5.6.7.8", "001.2.3.255 256.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1112 x",
         "4111111111111111 4111111111111111", "+1 (017) 555-7713", "++33 1 23 45 67 89.", "+1", "1 " * 3000, "1.1" * 4000, "a." * 20000 + "@x", "x@" + "b." * 5000 + "c",
         "call 555-123-4567 now", "card: 4111.1111.1111.1111", "joe [at] site [dot] com", "tel +49 30 1234567, ip 10.0.0.1", "5" * 30, "", "12 3456789012345 67"]


def test_personal_data(spark, odd, tmp_path):
    rows = [(i, t) for i, t in enumerate(NASTY)] + [(100 + i, t) for i, (_, t) in enumerate(ODD)]
    path = str(tmp_path / "p.parquet")
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(path)
    got = {r["doc_id"]: r for r in op9_pii.find(spark.read.parquet(path)).collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        truth = base_spans(t or "")
        assert got[i]["base_sha256"] == hashlib.sha256(",".join(truth).encode()).hexdigest(), (i, truth, got[i])
        assert [got[i][f"n_{k}"] for k in op9_pii.KINDS] == [sum(s.startswith(k) for s in truth) for k in op9_pii.KINDS]
        every = got[i]["spans"].split(",") if got[i]["spans"] else []
        assert set(truth) <= set(every) and len(every) == len(truth) + got[i]["n_added"]


def test_personal_data_is_native(spark, odd):
    plan = op9_pii.find(odd)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_reliabilities_follow_the_votes():
    patterns = [("phone", 1, 1, 1, 0, 0, 50), ("phone", -1, -1, 0, 0, -1, 50), ("phone", 0, 1, 1, 1, 0, 5)]
    prior, odds = op9_pii.reliabilities(patterns)
    assert odds[0][1] > 1 > -1 > odds[0][-1] and odds[1][1] > 0


def test_empty_tables(empty):
    assert op2_exact.exact_groups(empty).count() == 0
    assert op3_pack.pack_documents(empty).count() == 0
    assert op8_hilbert.shard_documents(empty).count() == 0
    assert op9_pii.find(empty).count() == 0
    assert op10_jaccard.jaccard_groups(empty).count() == 0
