"""Touched-partition upsert: only affected partitions are rewritten."""
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from callstar.sources import sinks


def _files(path):
    out = {}
    for root, _, files in os.walk(path):
        for f in files:
            if f.endswith(".parquet"):
                out[os.path.join(root, f)] = os.path.getmtime(os.path.join(root, f))
    return out


def test_upsert_partitioned_moves_rows_and_keeps_untouched_partitions(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="callstar-sink-"), "t")
    first = spark.createDataFrame([(1, "a", "2024-01-01"), (2, "b", "2024-01-01"), (3, "c", "2024-01-02"),
                                   (4, "d", "2024-01-03")], "k int, v string, d string")
    sinks.upsert_partitioned(first, path, ["k"], "d")
    before = _files(path)
    # key 1 changes value, key 3 moves from 01-02 to 01-04, key 5 is new
    batch = spark.createDataFrame([(1, "A", "2024-01-01"), (3, "C", "2024-01-04"), (5, "e", "2024-01-04")],
                                  "k int, v string, d string")
    out = sinks.upsert_partitioned(batch, path, ["k"], "d")
    got = sorted((r["k"], r["v"], str(r["d"])) for r in out.collect())
    assert got == [(1, "A", "2024-01-01"), (2, "b", "2024-01-01"), (3, "C", "2024-01-04"),
                   (4, "d", "2024-01-03"), (5, "e", "2024-01-04")]
    after = _files(path)
    untouched = [f for f in before if "d=2024-01-03" in f]
    assert untouched and all(after.get(f) == before[f] for f in untouched)


def test_upsert_partitioned_hash_buckets(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="callstar-sink-"), "b")
    df = spark.range(0, 1000).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    sinks.upsert_partitioned(df, path, ["k"], "_bucket", sinks.hash_bucket(["k"], 8), key_determines_partition=True)
    upd = spark.createDataFrame([(5, "y"), (2000, "z")], "k long, v string")
    out = sinks.upsert_partitioned(upd, path, ["k"], "_bucket", sinks.hash_bucket(["k"], 8),
                                   key_determines_partition=True)
    assert out.count() == 1001
    assert out.filter("k = 5").first()["v"] == "y"
    assert out.select("k").distinct().count() == 1001


def test_range_buckets_rewrite_only_newest(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="callstar-sink-"), "r")
    old = spark.range(0, 300).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    sinks.upsert_partitioned(old, path, ["k"], "_bucket", sinks.range_bucket("k", 100),
                             key_determines_partition=True)
    before = _files(path)
    new = spark.range(290, 330).select(F.col("id").alias("k"), F.lit("y").alias("v"))
    out = sinks.upsert_partitioned(new, path, ["k"], "_bucket", sinks.range_bucket("k", 100),
                                   key_determines_partition=True)
    assert out.count() == 330 and out.filter("v = 'y'").count() == 40
    after = _files(path)
    for bucket in ("_bucket=0", "_bucket=1"):
        kept = [f for f in before if bucket + "/" in f]
        assert kept and all(after.get(f) == before[f] for f in kept)


def test_a_null_partition_that_empties_is_removed(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="callstar-sink-"), "n")
    sinks.upsert_partitioned(spark.createDataFrame([(1, "a", None), (2, "b", "x")], "k int, v string, d string"), path, ["k"], "d")
    out = sinks.upsert_partitioned(spark.createDataFrame([(1, "A", "x")], "k int, v string, d string"), path, ["k"], "d")
    assert sorted((r["k"], r["v"], r["d"]) for r in out.collect()) == [(1, "A", "x"), (2, "b", "x")]


def test_a_source_with_one_key_twice_is_refused(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="callstar-sink-"), "u")
    twice = spark.createDataFrame([(1, "a", "x"), (1, "b", "x")], "k int, v string, d string")
    with pytest.raises(ValueError, match="twice"):
        sinks.upsert_partitioned(twice, path, ["k"], "d")
    with pytest.raises(ValueError, match="twice"):
        sinks.upsert_table(twice, path, ["k"])
    nulls = spark.createDataFrame([(None, "a", "x"), (None, "b", "x")], "k int, v string, d string")
    assert sinks.upsert_partitioned(nulls, path, ["k"], "d").count() == 2


def test_another_bucket_count_is_refused(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="callstar-sink-"), "l")
    df = spark.range(0, 100).select(F.col("id").alias("k"), F.lit("x").alias("v"))

    def load(n):
        return sinks.upsert_partitioned(df, path, ["k"], "_bucket", sinks.hash_bucket(["k"], n), key_determines_partition=True, layout=f"hash k {n}")

    load(8)
    with pytest.raises(ValueError, match="laid out"):
        load(16)
    assert load(8).count() == 100


def test_a_table_grows_after_it_was_read(spark):
    from callstar.sources.landing import read_table
    root = tempfile.mkdtemp(prefix="callstar-landing-")
    spark.range(5).write.parquet(os.path.join(root, "t.parquet"))
    assert read_table(spark, root, "t").count() == 5
    spark.range(7).write.mode("append").parquet(os.path.join(root, "t.parquet"))
    assert read_table(spark, root, "t").count() == 12


def test_durable_tables_need_a_named_warehouse(spark):
    before = spark.conf.get("callstar.warehouse")
    spark.conf.unset("callstar.warehouse")
    try:
        with pytest.raises(RuntimeError, match="callstar.warehouse"):
            sinks.table_path(spark, "silver", "t")
    finally:
        spark.conf.set("callstar.warehouse", before)


# -- swaps that fail half way ----------------------------------------------------

def _rows(spark, path):
    return sorted((r["k"], r["v"], str(r["d"])) for r in spark.read.parquet(path).collect())


@pytest.mark.parametrize("first", [True, False])
def test_a_swap_that_fails_half_way_is_finished_by_the_next_run(spark, monkeypatch, first):
    """One partition is already gone and the new one not yet there: nothing is lost."""
    path = os.path.join(tempfile.mkdtemp(prefix="callstar-sink-"), "t")
    old = spark.createDataFrame([(1, "a", "x"), (2, "b", "x"), (3, "c", "y"), (4, "d", "z")], "k int, v string, d string")
    sinks.upsert_partitioned(old, path, ["k"], "d")
    new = spark.createDataFrame([(1, "A", "x"), (3, "C", "w")], "k int, v string, d string")
    plain = sinks._swap

    def broken(session, swap):
        if not first:
            plain(session, swap)  # the swap is done, its intent still there
        else:
            sinks._delete(session, os.path.join(swap.path, "d=x"))
        raise RuntimeError("executor and driver lost")
    monkeypatch.setattr(sinks, "_swap", broken)
    with pytest.raises(RuntimeError, match="lost"):
        sinks.upsert_partitioned(new, path, ["k"], "d")
    monkeypatch.setattr(sinks, "_swap", plain)
    want = [(1, "A", "x"), (2, "b", "x"), (3, "C", "w"), (4, "d", "z")]
    assert (_rows(spark, path) == want) == (not first)
    assert sinks.recover(spark, path) == 1
    assert _rows(spark, path) == want and sinks.recover(spark, path) == 0
    assert sinks.upsert_partitioned(new, path, ["k"], "d").count() == 4


def test_several_tables_are_swapped_as_one(spark, monkeypatch):
    """A failure between the first and the second table: the recovery does both."""
    root = tempfile.mkdtemp(prefix="callstar-sink-")
    paths = [os.path.join(root, n) for n in "ab"]
    row = spark.createDataFrame([(1, "a", "x")], "k int, v string, d string")
    for p in paths:
        sinks.upsert_partitioned(row, p, ["k"], "d")
    new = spark.createDataFrame([(1, "b", "x"), (2, "c", "y")], "k int, v string, d string")
    plain = sinks._swap
    monkeypatch.setattr(sinks, "_swap", lambda s, w: plain(s, w) if w.path == paths[0] else (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):
        sinks.commit(spark, [sinks.prepare_upsert(new, p, ["k"], "d") for p in paths])
    monkeypatch.setattr(sinks, "_swap", plain)
    assert _rows(spark, paths[1]) == [(1, "a", "x")]
    sinks.recover(spark, paths[0])
    assert _rows(spark, paths[0]) == _rows(spark, paths[1]) == [(1, "b", "x"), (2, "c", "y")]


def test_an_intent_that_was_not_finished_changes_nothing(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="callstar-sink-"), "t")
    sinks.upsert_partitioned(spark.createDataFrame([(1, "a", "01")], "k int, v string, d string"), path, ["k"], "d")
    os.makedirs(os.path.join(path, sinks.INTENTS), exist_ok=True)
    open(os.path.join(path, sinks.INTENTS, "x.json.part"), "w").write("[{")
    assert sinks.recover(spark, path) == 0
    out = sinks.upsert_partitioned(spark.createDataFrame([(2, "b", "01")], "k int, v string, d string"), path, ["k"], "d")
    assert sorted(r["k"] for r in out.collect()) == [1, 2]


def test_rows_are_removed_by_another_column(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="callstar-sink-"), "t")
    sinks.upsert_partitioned(spark.createDataFrame([(1, "a", "x"), (2, "a", "y"), (3, "b", "x")], "k int, v string, d string"), path, ["k"], "d")
    gone = spark.createDataFrame([("a",)], "v string")
    sinks.upsert_partitioned(spark.createDataFrame([(9, "n", "z")], "k int, v string, d string"), path, ["k"], "d", remove=gone)
    assert _rows(spark, path) == [(3, "b", "x"), (9, "n", "z")]
    assert not os.path.exists(os.path.join(path, "d=y"))


def test_versions(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="callstar-sink-"), "v")
    first = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    sinks.upsert_table(first, path, ["k"])
    assert sinks.replace_table(first.limit(0), path).count() == 0  # an empty version is a version
    assert sinks.upsert_table(first, path, ["k"], remove=first.select("k")).count() == 2
    os.makedirs(os.path.join(path, "_version=4"))  # a write that did not finish
    assert sinks.read_current(spark, path).count() == 2
    assert sinks.vacuum_versions(spark, path, keep=1) == [1, 2]


# -- what a load moves ---------------------------------------------------------

def test_staged_partitions_are_moved_not_written_again(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="callstar-sink-"), "t")
    first = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k int, v string, d string")
    swap = sinks.prepare_upsert(first, path, ["k"], "d")
    staged = sorted(os.path.basename(f) for f in _files(swap.staging))
    assert staged and sinks.read_current(spark, path) is None
    sinks.commit(spark, [swap])
    assert sorted(os.path.basename(f) for f in _files(path)) == staged and not os.path.exists(swap.staging)


def test_a_swap_that_moved_some_partitions_keeps_them(spark, monkeypatch):
    """The second partition cannot be moved at first: the recovery must not take the first one, no longer staged, for an emptied one."""
    path = os.path.join(tempfile.mkdtemp(prefix="callstar-sink-"), "t")
    sinks.upsert_partitioned(spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (3, "c", "z")], "k int, v string, d string"), path, ["k"], "d")
    swap = sinks.prepare_upsert(spark.createDataFrame([(1, "A", "x"), (3, "C", "y")], "k int, v string, d string"), path, ["k"], "d")
    plain = sinks._fs

    def broken(session, place):
        if place == os.path.join(path, "d=y"):
            raise RuntimeError("lost")
        return plain(session, place)
    monkeypatch.setattr(sinks, "_fs", broken)
    with pytest.raises(RuntimeError, match="lost"):
        sinks.commit(spark, [swap])
    monkeypatch.setattr(sinks, "_fs", plain)
    assert os.path.exists(os.path.join(path, "d=x")) and not os.path.exists(os.path.join(swap.staging, "d=x"))
    assert sinks.recover(spark, path) == 1
    assert _rows(spark, path) == [(1, "A", "x"), (2, "b", "y"), (3, "C", "y")] and not os.path.exists(os.path.join(path, "d=z"))


def test_a_merge_of_whole_buckets_shuffles_each_row_once(spark):
    """Replaced, removed, new and NULL keys; one exchange for the target, the source and the removed keys together."""
    path = os.path.join(tempfile.mkdtemp(prefix="callstar-sink-"), "b")
    bucket = sinks.hash_bucket(["k"], 4)
    old = spark.createDataFrame([(k, "old") for k in range(8)] + [(None, "old"), (None, "older")], "k long, v string")
    sinks.upsert_partitioned(old, path, ["k"], "_bucket", bucket, key_determines_partition=True)
    new = spark.createDataFrame([(0, "new"), (1, "new"), (9, "new"), (None, "new")], "k long, v string")
    gone = spark.createDataFrame([(1,), (2,), (2,), (77,)], "k long")
    out = sinks.upsert_partitioned(new, path, ["k"], "_bucket", bucket, key_determines_partition=True, remove=gone)
    got = sorted((str(r["k"]), r["v"]) for r in out.collect())
    assert got == sorted([("0", "new"), ("1", "new"), ("9", "new"), ("None", "new"), ("None", "old"), ("None", "older")] + [(str(k), "old") for k in range(3, 8)])
    src = new.withColumn("_bucket", bucket.cast("int"))
    plan = sinks._merged(out, src, ["k"], "_bucket", gone.withColumn("_bucket", bucket))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_rows_of_few_partitions_are_not_shuffled_for_the_write(spark, monkeypatch):
    plain, asked = sinks._by_partition, []
    monkeypatch.setattr(sinks, "_by_partition", lambda df, c: asked.append(c) or plain(df, c))
    root = tempfile.mkdtemp(prefix="callstar-sink-")
    days = spark.range(40).select(F.col("id").alias("k"), (F.col("id") % 2).cast("string").alias("d"))
    assert sinks.upsert_partitioned(days, os.path.join(root, "few"), ["k"], "d").count() == 40 and not asked
    assert sinks.upsert_partitioned(days.withColumn("d", F.col("k").cast("string")), os.path.join(root, "many"), ["k"], "d").count() == 40 and asked == ["d"]


def test_an_index_takes_new_pairs_by_one_shuffle(spark, tmp_path, monkeypatch):
    path, kind = str(tmp_path / "index"), "k bigint, d string"
    sinks.index_add(spark, path, spark.createDataFrame([(1, "a"), (2, "a"), (2, "b"), (2, "b"), (None, "a"), (3, None)], kind), "k", "d", 10)
    seen, plain = [], sinks._by_partition
    monkeypatch.setattr(sinks, "_by_partition", lambda df, c: seen.append(df) or plain(df, c))
    sinks.index_add(spark, path, spark.createDataFrame([(2, "b"), (2, "c"), (2, "c"), (3, None), (4, None), (11, "a")], kind), "k", "d", 10)
    pairs = [tuple(r) for r in spark.read.parquet(path).select("k", "place").collect()]
    assert sorted(pairs, key=str) == sorted([(1, "a"), (2, "a"), (2, "b"), (3, None), (2, "c"), (4, None), (11, "a")], key=str)
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_a_text_key_twice_is_refused_and_named(spark, tmp_path):
    twice = spark.createDataFrame([("x", 1), ("y", 2), ("x", 3), (None, 4), (None, 5)], "k string, v int")
    with pytest.raises(ValueError, match="'k': 'x'"):
        sinks._refuse_twice(twice, ["k"])
    sinks._refuse_twice(twice.filter("v <> 3"), ["k"])
