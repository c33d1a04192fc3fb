"""Page extraction, toxicity, language ID, decontamination, dialogues, the pipeline and the SQL oracles."""

import random
import tracemalloc
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from callstar.llm import op1_wrapper, op4_toxicity, op5_langid, op6_decontaminate, op7_rotate
from callstar.llm.common import BATCH_BYTES, table, utf8, with_row_id, word_hashes

from .conftest import ODD, PARA

TABLES = ("documents", "labels", "benchmark", "pages", "conversations")


def crc(i):
    return zlib.crc32(str(i).encode())


# -- pages ----------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style><script>var a="</p>";</script></head><body class="has-sidebar">
<header><h2>Site</h2></header><nav><ul><li><a href="/">{nav}</a><li>b</ul></nav><div class="cookie-notice">We use cookies</div>
<div id="wrap"><div class="post"><h1>{title}</h1><p>Fish &amp; chips &copy; &eacute; &unknown; {a}<br>next<p><b>{b}</b> <i>more</i></p>
<div class="share-box">Share</div><blockquote>{c}</blockquote><p>Printed on recycled electrons.</p></div></div>
<div class="comments"><p>Reader says {a}{a}{a}{b}{b}{c}{c}</p></div><aside>Links</aside><form><p>Name</p></form><footer>&copy; all</footer></body></html>"""


PROSE = "a quiet river ran past the mill and the old town slept"


def test_deeply_nested_pages():
    """100,000 levels, closed and not: the text stays, roles below the deepest level go, and texts stay apart."""
    n = 100_000
    deep = "<html><body><article><p>" + PROSE + "</p>" + "<div>" * n + "one<nav>menu</nav>two" + "</div>" * n + "<p>" + PROSE[::-1] + "</p></article></body></html>"
    got = op1_wrapper.extract(deep, None).split("\n\n")
    assert got == [PROSE, "one", "two", PROSE[::-1]]
    assert op1_wrapper.extract("<body><p>" + PROSE + "</p>" + "<div><section>" * n + "last", None).split("\n\n") == [PROSE, "last"]
    tree, path = op1_wrapper.json.loads(op1_wrapper.induce([deep.replace("one", w) for w in ("one", "uno", "eins")]))
    assert op1_wrapper.extract(deep, (op1_wrapper.restore(tree), path)).split("\n\n") == got


def test_main_text(spark, tmp_path):
    rng = random.Random(1)
    words = lambda n: " ".join(f"w{rng.randint(0, 999)}" for _ in range(n))
    rows, truth = [], {}
    for i in range(20):
        v = {"nav": words(2), "title": words(4), "a": words(30), "b": words(20), "c": words(25)}
        rows.append((i, "http://Site.example/x?p=%d" % i, PAGE.format(**v), "clash"))
        truth[i] = "\n\n".join([v["title"], f"Fish & chips © é &unknown; {v['a']} next", f"{v['b']} more", v["c"]])
    rows += [(100, "http://one.example/", "<p>lone <b>page</b>\n text<p>two", ""), (101, None, None, ""), (102, "http://two.example", "", ""), (103, "odd url", "plain text &lt;x&gt;", ""),
             (104, "http://three.example", "<article><h1>T</h1>" + "<p>para para</p>" * 3000 + "</article><nav>n</nav>", ""), (0, *rows[0][1:])]
    path = str(tmp_path / "pages.parquet")
    spark.createDataFrame(rows, "page_id long, url string, html string, host string").repartition(3).write.parquet(path)
    got = op1_wrapper.main_texts(spark.read.parquet(path)).collect()
    assert len(got) == len(rows) and all(r["n_chars"] == len(r["text"]) for r in got)
    text = {r["page_id"]: r["text"] for r in got}
    for i, t in truth.items():
        assert text[i] == t  # the constant line went with the template
    assert text[100] == "lone page text\n\ntwo" and text[101] == "" and text[102] == "" and text[103] == "plain text <x>"
    assert text[104] == "\n\n".join(["T"] + ["para para"] * 3000)
    assert op1_wrapper.main_texts(spark.read.parquet(path).limit(0)).count() == 0


@pytest.mark.parametrize("body", [
    "<div class=post><h1>{t}</h1><div class=entry><p>{a}</p><p>{b}</p></div></div>",  # the title beside the box of the text
    "<div class=intro><h1>{t}</h1><p>{a}</p></div><div class=body><p>{b}</p><p>{b} too</p></div>",  # a first section of a third
])
def test_text_in_sister_containers(body):
    rng = random.Random(9)
    words = lambda n: " ".join(f"w{rng.randint(0, 999)}" for _ in range(n))
    values = [{"t": words(4), "a": words(40), "b": words(60)} for _ in range(8)]
    pages = ["<body><nav>n</nav><div class=page>" + body.format(**v) + "<p>the same line on each page</p></div><footer>f</footer></body>" for v in values]
    tree, path = op1_wrapper.json.loads(op1_wrapper.induce(pages))
    for v, page in zip(values, pages):
        want = "\n\n".join([v["t"], v["a"], v["b"]] + [f"{v['b']} too"] * ("intro" in body))
        assert op1_wrapper.extract(page, (op1_wrapper.restore(tree), path)) == want
        alone = op1_wrapper.extract(page, None)  # a page without template keeps them as well
        assert alone.startswith(want)


def test_tree_match():
    a, b = (op1_wrapper.shape([op1_wrapper.parse(h)]) for h in ("<div><p>x</p><ul></ul><h2>y</h2></div>", "<div><p>z</p><h2>w</h2></div>"))
    assert op1_wrapper.tree_match(a, b)[0] == 4  # html, div, p, h2


# -- language and toxicity ----------------------------------------------------------

def test_language_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = op5_langid.identify(docs).toPandas()
    truth = docs.select("doc_id", "lang").toPandas()
    both = got.merge(truth, on="doc_id")
    assert (both["held_out"] == both["doc_id"].map(lambda i: crc(i) % 3 == 1)).all()
    held = both[both["held_out"]]
    assert (held["lang"] == held["lang_pred"]).mean() >= 0.98 and both["rejected"].sum() <= 2
    assert got["score"].between(0, 1).all()


def test_language_odd_rows(odd, empty):
    got = op5_langid.identify(odd).collect()
    assert len(got) == len(ODD)
    blank = {t for _, t in ODD if not t or not any(c.isalpha() for c in t)}
    undetermined = [r for r in got if r["lang_pred"] == "und"]
    assert len(undetermined) == sum(t in blank for _, t in ODD) and all(r["score"] == 0 for r in undetermined)
    assert {r["lang_pred"] for r in got} == {"en", "und"}
    assert op5_langid.identify(empty).count() == 0


def test_far_texts_are_rejected(spark, tmp_path):
    path = str(tmp_path / "d.parquet")
    rows = [(i, " ".join([PARA] * 3) + f" {i}", "en") for i in range(40)] + [(99, "żółć " * 200, None), (98, PARA, None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(2).write.parquet(path)
    got = {r["doc_id"]: r["rejected"] for r in op5_langid.identify(spark.read.parquet(path)).collect()}
    assert got[99] and not got[98] and sum(got.values()) == 1


def test_centroids_and_thresholds_come_from_all_rows(spark, tmp_path):
    """Each centroid is the mean of all rows nearest to it, however few it began with."""
    rng = random.Random(6)
    speak = lambda letters: " ".join("".join(rng.choice(letters) for _ in range(5)) for _ in range(60))
    rows = [(i, speak("abcde" if i % 6 else "uvwxyz"), "en") for i in range(1200)] + [(i, speak("ghijk"), "de") for i in range(2000, 2400)]
    path = str(tmp_path / "d.parquet")
    spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3).write.parquet(path)
    docs = spark.read.parquet(path)
    model = op5_langid.fit(docs, op5_langid.part(3) != 1, sample=12)
    learned = [r for r in rows if crc(r[0]) % 3 != 1]
    counts = np.vstack([c for _, c in op5_langid.vectors(op5_langid.pd.Series([t for _, t, _ in learned]))])
    v = op5_langid.tf_idf(counts, model.idf)
    own = np.array([model.langs.index(lang) for _, _, lang in learned])
    cosine = np.where(model.owner[None] == own[:, None], v @ model.centroids.T, -1)
    near = cosine.argmax(axis=1)
    for j in range(len(model.owner)):  # each centroid is the mean of all of its rows
        mean = v[near == j].mean(axis=0)
        assert np.abs(mean / np.linalg.norm(mean) - model.centroids[j]).max() < 0.01
    got = op5_langid.identify(docs).toPandas()
    assert not got["rejected"].any() and (got["lang_pred"] == [lang for i in got["doc_id"] for lang in ["de" if i >= 2000 else "en"]]).all()


def test_grams_do_not_cross_rows():
    alone = [next(op5_langid.vectors(op5_langid.pd.Series([t])))[1][0] for t in ("abc def", "ghi", "", "jk l")]
    together = next(op5_langid.vectors(op5_langid.pd.Series(["abc def", "ghi", "", "jk l"])))[1]
    assert np.abs(np.array(alone)[:, 1:] - together[:, 1:]).sum() <= 4  # only first words lack the gram with the blank before them


def test_toxicity_held_out(spark):
    read = lambda n: spark.read.parquet(f"/root/testdata/sf0.1/{n}.parquet")
    got = op4_toxicity.score(read("documents"), read("labels")).toPandas()
    assert (got["held_out"] == got["doc_id"].map(lambda i: crc(i) % 5 == 0)).all()
    both = got.merge(read("labels").toPandas(), on="doc_id")
    held = both[both["held_out"]]
    pos, neg = held[held["toxic"] == 1]["score"].to_numpy(), held[held["toxic"] == 0]["score"].to_numpy()
    assert (pos[:, None] > neg[None]).mean() > 0.85
    assert ((got["score"] >= 0.5) == (got["predicted"] == 1)).all() and got["score"].between(0, 1).all()


def test_toxicity_counts_every_fold(spark, tmp_path):
    rng = random.Random(8)
    fold = lambda i: crc(i) % 5
    rows, labels = [], []
    for i in range(1500):
        toxic = fold(i) and i % 3 == 0
        bad = ["foe", "foe only"][fold(i) == 4]  # a word that is toxic in fold 4 and in no other learnable fold
        rows.append((i, " ".join([f"w{rng.randint(0, 40)}" for _ in range(12)] + [bad] * toxic)))
        labels.append((i, int(bool(toxic))))
    probes = [(i, f"w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11 {'only' if i % 2 else 'w12'}") for i in range(2000, 2040)]
    path = str(tmp_path / "d.parquet")
    spark.createDataFrame(rows + probes, "doc_id long, text string").repartition(3).write.parquet(path)
    docs, marks = spark.read.parquet(path), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = op4_toxicity.train(docs, marks)
    word = word_hashes(np.frombuffer(b"only", np.uint8))[2]
    assert op4_toxicity.word_ids(word, model.vocabulary)[0] > 0 and model.difference(word)[0] > 0
    score = {r["doc_id"]: r["score"] for r in op4_toxicity.score(docs, marks).collect()}
    assert min(score[i] for i, _ in probes if i % 2) > max(score[i] for i, _ in probes if not i % 2)


def test_toxicity_expressions_beyond_the_bounds_count(spark, tmp_path, monkeypatch):
    """Scores are the same when nearly all of the model is joined, not sent to the workers."""
    rng = random.Random(18)
    rows, labels = [], []
    for i in range(1200):
        toxic = i % 3 == 0
        words = [f"w{rng.randint(0, 30)}" for _ in range(14)] + [f"foe{rng.randint(0, 11)}" if toxic else f"pal{rng.randint(0, 11)}"]
        words += "left right up down".split() if toxic else "left down up right".split()  # only the bigrams tell
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    rows += [(2000, None), (2001, "foe3"), (2002, "w1 left right"), (2002, "w1 left right"), (2003, "unheard of"), (None, "pal4 foe5")]
    path = str(tmp_path / "d.parquet")
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(path)
    docs, marks = spark.read.parquet(path), spark.createDataFrame(labels, "doc_id long, toxic int")
    scores = lambda: sorted((str(r["doc_id"]), round(r["score"], 5)) for r in op4_toxicity.score(docs, marks).collect())
    want = scores()
    monkeypatch.setattr(op4_toxicity, "WORDS", 3)
    monkeypatch.setattr(op4_toxicity, "BIGRAMS", 2)
    assert scores() == want and len(want) == len(rows)
    score = dict(want)
    assert score["2001"] > score["2003"] and score["2002"] > score["2003"]


def test_toxicity_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(1, 1), (2, 0), (8, 1), (8, 0), (3, None), (None, 1), (777, 1)], "doc_id long, toxic int")
    assert len(op4_toxicity.score(odd, labels).collect()) == len(ODD)
    none = op4_toxicity.score(odd, labels.limit(0)).collect()
    assert len(none) == len(ODD) and not any(r["predicted"] for r in none)
    assert op4_toxicity.score(empty, labels).count() == 0


# -- decontamination -----------------------------------------------------------------

def plain_distance(p, t):
    row = [0] * (len(t) + 1)
    for i, a in enumerate(p, 1):
        new = [i]
        for j, b in enumerate(t, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


def test_best_fit():
    rng = random.Random(2)
    text = lambda n: "".join(rng.choice("abc") for _ in range(n))
    for _ in range(300):
        p, t = text(rng.randint(1, 12)), text(rng.randint(0, 20))
        assert op6_decontaminate.best_fit(p, t)[0] == plain_distance(p, t)


def test_planted_items_are_found(spark, tmp_path):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8)))
    items = [(i, " ".join(word() for _ in range(rng.randint(16, 60)))) for i in range(60)] + [(60, "three words only"), (61, None), (62, "")]
    docs, truth = [], set()
    for i in range(120):
        filler = [word() for _ in range(rng.randint(5, 400))]
        if i % 2 == 0:
            k = rng.randrange(61)
            words = items[k][1].split()
            if len(words) > 20:
                for _ in range(len(words) // 20):  # 5 % of the words edited
                    words[rng.randrange(len(words))] = word()
            at = rng.randint(0, len(filler))
            filler[at:at] = " , ".join(words).upper().split() if i % 4 else words
            truth.add((i, k))
        docs.append((i, " ".join(filler)))
    docs += [(1000, None), (1001, ""), (1002, " ".join(word() for _ in range(300_000)) + " " + items[0][1])]
    truth.add((1002, 0))
    path = str(tmp_path / "d.parquet")
    spark.createDataFrame(docs, "doc_id long, text string").repartition(4).write.parquet(path)
    frame, bench = spark.read.parquet(path), spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in op6_decontaminate.contaminated(frame, bench).collect()}
    assert not got - truth and len(truth - got) <= 1
    left = {r["doc_id"] for r in op6_decontaminate.clean(frame, bench).collect()}
    assert left == {i for i, _ in docs} - {d for d, _ in got}
    assert op6_decontaminate.contaminated(frame, bench.limit(0)).count() == 0 and op6_decontaminate.contaminated(frame.limit(0), bench).count() == 0


def edited(rng, text, n):
    """n random substitutions, insertions and deletions of characters."""
    out = list(text)
    for _ in range(n):
        i, c = rng.randrange(len(out)), rng.choice("abcdefghij ")
        out[i:i + 1] = rng.choice(([c], [c, out[i]], []))
    return "".join(out)


def test_character_edits_are_found(spark, tmp_path):
    """Recall against brute force, with 5, 10 and 20 % of the characters edited, spread over all words."""
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    items = [(i, " ".join(word() for _ in range((16, 27, 38, 59, 120)[i % 5]))) for i in range(40)]
    items += [(40, "short one here"), (41, "abc"), (42, "\u00c0 la carte \u4f60\u597d \u00e9t\u00e9")]
    docs, truth = [], {}
    for share in (0.05, 0.1, 0.2):
        for k, item in items:
            filler = [word() for _ in range(100)]
            copy = edited(rng, item, int(share * len(item)))
            text = " ".join(filler[:40] + [copy.upper() if k % 2 else copy.replace(" ", " ;\u00a0")] + filler[40:])
            plain = " ".join(op6_decontaminate.plain(text))
            distance = op6_decontaminate.best_fit(" ".join(op6_decontaminate.plain(item)), plain)[0]
            if distance <= 0.2 * len(item):
                truth[len(docs), k] = (share, distance)
            docs.append((len(docs), text))
    docs.append((900, "xabcx " * 9))  # no whole word
    path = str(tmp_path / "d.parquet")
    spark.createDataFrame(docs, "doc_id long, text string").repartition(3).write.parquet(path)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r for r in op6_decontaminate.contaminated(spark.read.parquet(path), bench).collect()}
    for share in (0.05, 0.1, 0.2):
        want = {x for x, (s, _) in truth.items() if s == share}
        assert len(want) >= 40 and len(want - set(got)) <= 1, share
    assert not set(got) - set(truth) and all(got[x]["distance"] == truth[x][1] for x in got)
    assert all(abs(got[x]["first_word"] - 40) <= 3 for x in got)


def test_batched_distances():
    rng = random.Random(7)
    text = lambda n: "".join(rng.choice("abc") for _ in range(n))
    pairs = [(text(rng.randint(1, 200)), text(rng.randint(1, 300))) for _ in range(100)]
    codes = [tuple(op6_decontaminate.fold(op6_decontaminate.points(x)) for x in p) for p in pairs]
    got = op6_decontaminate.least_distances([a for a, _ in codes], [b for _, b in codes])
    assert got.tolist() == [op6_decontaminate.best_fit(*p)[0] for p in pairs]


def test_benchmark_blocks(spark, monkeypatch):
    bench = spark.createDataFrame([(i, f"text {i}") for i in range(7)], "item_id long, text string")
    sizes = [len(ids) for ids, _ in op6_decontaminate.blocks(bench, 3)]
    assert sizes == [3, 3, 1]


def test_word_hashes_do_not_depend_on_slices():
    text = (" ".join(f"a{i % 977}b" for i in range(400_000)) + "  tail").encode()
    data = np.frombuffer(text, np.uint8)
    start, end, h = word_hashes(data)
    assert len(h) == 400_001 and text[start[-1]:end[-1]] == b"tail"
    assert len(set(h[:977].tolist())) == 977 and (h[:-1] == np.resize(h[:977], 400_000)).all()
    offsets, _ = utf8(pa.array(["é", None, "x"]).slice(1))
    assert np.diff(offsets).tolist() == [0, 1]


# -- dialogues -----------------------------------------------------------------------

def test_rotation(spark):
    rows = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi <|im_end|>"), (1, 2, "bob b", None), (1, 2, "bob b", None), (1, None, None, "first"), (2, 0, "system", "alone"), (None, 0, "x", "y")]
    got = {(r["conv_id"], r["perspective"]): r for r in op7_rotate.rotate(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect() if r["block"] == 0}
    assert set(got) == {(1, "ann"), (1, "bob b"), (1, "unknown"), (None, "x")}
    r = got[(1, "ann")]
    assert r["rendered"] == ("<|im_start|>system\nbe kind<|im_end|>\n<|im_start|>assistant\nhi < |im_end|><|im_end|>\n<|im_start|>user name=bob_b\n<|im_end|>\n")
    a, b = map(int, r["mask"].split(":"))
    assert r["rendered"][a:b] == "hi < |im_end|><|im_end|>" and r["n_masked"] == b - a


def test_rotation_of_no_rows_and_beside_other_columns(spark):
    rows = [(1, 0, "ann", "hi"), (1, 1, "bob", ""), (1, 1, "bob", "x" * 300_000), (None, None, None, None)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert op7_rotate.rotate(frame.limit(0)).count() == 0
    beside = frame.select("*", *(F.lit("other").alias(c) for c in ("block", "part", "rows", "c", "b", "perspective", "rendered", "mask", "n_turns", "n_masked")))
    plainly, clashing = ({tuple(r) for r in op7_rotate.rotate(f).collect()} for f in (frame, beside))
    assert plainly == clashing and {r[1] for r in plainly} == {"ann", "bob", "unknown"}


def test_benchmark_items_beside_other_columns(spark, tmp_path):
    """Columns named like those of the result, an item of marks only (found nowhere) and an empty one."""
    item = "the quick brown fox jumps over the lazy dog near the river bank"
    path = str(tmp_path / "d.parquet")
    spark.createDataFrame([(1, f"before {item} after"), (2, "nothing of the kind ?! ..."), (3, None)], "doc_id long, text string").select(
        "*", *(F.lit("other").alias(c) for c in ("item_id", "hit", "distance", "word", "first_word"))).write.parquet(path)
    docs = spark.read.parquet(path)
    bench = spark.createDataFrame([(7, item, "other"), (8, "?! ...", "other"), (9, "", "other")], "item_id long, text string, doc_id string")
    assert [(r["doc_id"], r["item_id"], r["distance"]) for r in op6_decontaminate.contaminated(docs, bench).collect()] == [(1, 7, 0)]
    left = op6_decontaminate.clean(docs, bench)
    assert left.columns == docs.columns and {r["doc_id"] for r in left.collect()} == {2, 3}


def test_crowded_blocks_are_split(spark):
    rows = [(1, t, f"p{k % 2}", f"text {k}") for t in range(130) for k in range(20)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = op7_rotate.rotate(frame, block_rows=50).collect()
    assert max(r["n_turns"] for r in got) <= 40 and sum(r["n_turns"] for r in got) == 2 * len(rows)
    whole = op7_rotate.rotate(frame, block_rows=10_000, block=1000).filter("perspective = 'p0'").collect()
    parts = sorted((r["block"], r["part"], r["rendered"]) for r in got if r["perspective"] == "p0")
    assert sorted("".join(p for *_, p in parts).split("<|im_end|>")) == sorted(whole[0]["rendered"].split("<|im_end|>"))


# -- pipeline and oracles ---------------------------------------------------------------

def test_pipeline_stages(spark, odd, empty, tmp_path):
    spark.createDataFrame([(0, PARA)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs, sizes = odd, [len(ODD)]
    for name, step in corpus_pipeline.STAGES[:-1]:
        out = step(spark, docs, str(tmp_path))
        assert out.columns == odd.columns, name
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        sizes.append(docs.count())
    texts = [r["text"] for r in docs.collect()]
    assert sizes == sorted(sizes, reverse=True) and not any(PARA in t.lower() for t in texts)
    assert sum(t.startswith("alpha beta") for t in texts) == 1 and sum(len(t) > 50_000 for t in texts) == 1 and "word" in [t.lower() for t in texts]
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path))
    assert {r["doc_id"] for r in pieces.collect()} == {r["doc_id"] for r in docs.collect()}
    for _, step in corpus_pipeline.STAGES:
        assert step(spark, empty, str(tmp_path)).count() == 0


@pytest.mark.parametrize("name", ["op2_exact_dedup", "op7_perspectives"])
def test_oracle(spark, name):
    sf = "/root/testdata/sf0.001"
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    want = db.execute(entry.oracle_sql()[name]).df()
    got = entry.queries()[name](spark, sf).toPandas()
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    assert sorted(map(repr, got[cols].values.tolist())) == sorted(map(repr, want[cols].values.tolist()))


def test_language_vectors_of_few_rows_at_once():
    offsets, data = utf8(pa.array(["ab cd"] * 2000, pa.large_string()))
    parts = list(op5_langid.gram_counts(offsets, data))
    assert sum(len(c) for _, c in parts) == 2000 and [lo for lo, _ in parts] == sorted(lo for lo, _ in parts)
    assert max(len(c) for _, c in parts) <= op5_langid.ROWS


def test_decontamination_holds_few_texts_at_once():
    item = "seven wizards boldly quiz a jumbo vixen near the old stone bridge"
    index = op6_decontaminate.Index([1], [item], op6_decontaminate.make_plans([item]))
    offsets, data = utf8(pa.array([PARA * 10 if k % 100 else item for k in range(6000)], pa.large_string()))
    plain = utf8(pa.array(["other words of no item " * 50] * 6000 + [item], pa.large_string()))
    tracemalloc.start()
    hits = [r for r, _ in op6_decontaminate.scan(*plain, index)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert hits == [6000] and peak < 80 << 20
    assert [r for r, _ in op6_decontaminate.scan(offsets[:102], data, index)] == list(range(101))


def test_batches_are_cut_by_bytes(spark, tmp_path):
    path = str(tmp_path / "documents.parquet")
    spark.range(0, 3000, 1, 1).select(F.col("id").alias("doc_id"), F.expr("repeat('some words ', 2000)").alias("text")).write.parquet(path)
    docs = spark.read.parquet(path)

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"])

    for bound in (lambda: table(spark, str(tmp_path), "documents"), lambda: with_row_id(docs, "uid"), lambda: docs.filter(op6_decontaminate.finder(docs, [1], ["a b"])("text").isNull())):
        spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
        bound()
        assert max(r.n for r in docs.select("text").mapInArrow(sizes, "n long").collect()) < 2 * BATCH_BYTES


def test_toxicity_bigrams_are_staged_sorted(spark, monkeypatch):
    """The largest staged table lies sorted, which is what keeps it small."""
    stage, found = op4_toxicity.stage, []
    monkeypatch.setattr(op4_toxicity, "stage", lambda df, tag: (found.append((tag, stage(df, tag))), found[-1][1])[1])
    op4_toxicity.train(*(spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels")))
    rows = next(df for tag, df in found if tag == "bigrams" and "drawn_toxic" in df.columns)
    for file in rows.inputFiles():
        keys = [(r["first"], r["word"]) for r in spark.read.parquet(file).coalesce(1).select("first", "word").collect()]
        assert keys and keys == sorted(keys)


def test_grams_against_a_plain_count():
    """Counts of odd rows and of one of several slices, without a search for each byte's row."""
    rng = np.random.default_rng(1)
    letters = list("abC é漢 .1")
    texts = ["".join(rng.choice(letters, int(rng.integers(0, 9)))) for _ in range(200)] + ["ab cd " * 300_000, None, "x"]
    offsets, data = utf8(pa.array(texts, pa.large_string()))
    for lo, counts in op5_langid.gram_counts(offsets, data):
        for t, row in zip(texts[lo:lo + len(counts)], counts):
            low = [b if b >= 128 or chr(b).isalpha() else 32 for b in (t or "").lower().encode()[:2000]] + [32]
            want = np.zeros(op5_langid.DIMS)
            for width in (2, 3):
                for k in range(len(low) - width + 1):
                    gram = low[k:k + width]
                    if sum(b != 32 for b in gram) > 1:
                        code = 0
                        for b in gram:
                            code = (code * 257 + b) % (1 << 32)
                        want[((code * 2654435761 + width) * 2246822519 % (1 << 32) >> 20) % op5_langid.DIMS] += 1
            if len(t or "") < 2000:
                assert (row == want).all()
            else:
                assert row.sum(dtype=float) == 300_000 * 8 - 2 and ((row > 0) == (want > 0)).all()
