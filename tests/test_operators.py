"""Validation, dedup, upsert and lookup operators on literal frames."""
from pyspark.sql import functions as F

from callstar.operators import quality as Q
from callstar.operators.dedup import drop_duplicates_any, keep_latest
from callstar.operators.lookup import fits, fk_flag, lookup, orphans
from callstar.operators.upsert import upsert
from callstar.plans import silver as S
from callstar.sources.batches import as_of, batch_diff, latest_batch


def test_validate_null_flag_rejects(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (None, 1)], "id int, lvl int")
    out = Q.validate(df, [("f_id", F.col("id").isNotNull()), ("f_lvl", F.col("lvl").between(1, 2))])
    got = {r["id"]: r[Q.VERDICT] for r in out.collect()}
    assert got == {1: "ERRO", 2: "ERRO", None: "ERRO"}
    ok = Q.validate(spark.createDataFrame([(1, 2)], "id int, lvl int"),
                    [("f", F.col("lvl").between(1, 2))]).first()[Q.VERDICT]
    assert ok == "OK"


def test_golden_agent_999_level_3(spark):
    bronze = spark.createDataFrame([(999, "Ana Souza", 3)], "id_agent long, agent_name string, support_level int")
    bronze = bronze.select("*", F.to_timestamp(F.lit("2024-01-01 00:00:00")).alias("ingestion_timestamp"),
                           F.lit("t").alias("origem"))
    row = S.silver_agent(bronze).flagged.first()
    assert row["flag_nivel_valido"] is False and row["flag_qualidade"] == "ERRO"


def test_rejection_text_and_first_failure(spark):
    df = spark.createDataFrame([(None, "")], "id int, name string")
    rules = [Q.Rule("f_id", F.col("id").isNotNull(), "missing id"),
             Q.Rule("f_name", F.col("name") != "", "blank name")]
    out = Q.validate(df, rules).select(Q.rejection_text(rules).alias("t"), Q.first_failure(rules).alias("f")).first()
    assert out["t"] == "missing id; blank name" and out["f"] == "missing id"


def test_keep_latest_is_deterministic_and_unique(spark):
    df = spark.createDataFrame([(1, 10, "a"), (1, 20, "b"), (1, 20, "c"), (None, 1, "x"), (None, 2, "y")],
                               "k int, ts int, v string")
    out = {(r["k"], r["ts"], r["v"]) for r in keep_latest(df, ["k"], ["ts"]).collect()}
    assert out == {(1, 20, "c"), (None, 2, "y")}


def test_drop_duplicates_null_is_one_key(spark):
    df = spark.createDataFrame([(None,), (None,), (1,), (1,)], "k int")
    assert drop_duplicates_any(df, ["k"]).count() == 2


def test_upsert_semantics_and_idempotence(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n1")], "k int, v string")
    source = spark.createDataFrame([(2, "B"), (3, "C"), (None, "n2")], "k int, v string")
    once = upsert(target, source, ["k"])
    got = sorted((r["k"] if r["k"] is not None else -1, r["v"]) for r in once.collect())
    assert got == [(-1, "n1"), (-1, "n2"), (1, "a"), (2, "B"), (3, "C")]
    # NULL keys never match, so they accumulate; keyed rows are idempotent
    twice = upsert(once, source, ["k"])
    assert twice.filter(F.col("k").isNotNull()).count() == 3


def test_lookup_never_multiplies_rows(spark):
    facts = spark.createDataFrame([("x",), ("y",)], "name string")
    dim = spark.createDataFrame([(" X ", 1), ("x", 2)], "n string, id int")
    out = lookup(facts, dim, F.lower(F.trim("name")), F.lower(F.trim("n")), ["id"])
    got = sorted((r["name"], r["id"]) for r in out.collect())
    assert got == [("x", 1), ("y", None)]


def test_fk_checks(spark):
    child = spark.createDataFrame([(1, 10), (2, 99), (3, None)], "id int, fk int")
    parent = spark.createDataFrame([(10,)], "pk int")
    assert [r["id"] for r in orphans(child, parent, "fk", "pk").collect()] == [2]
    flags = {r["id"]: r["ok"] for r in fk_flag(child, parent, "fk", "pk", "ok").collect()}
    assert flags == {1: True, 2: False, 3: False}
    many = spark.range(5000).select("id", F.when(F.col("id") % 5 == 0, F.lit(10)).cast("int").alias("fk"))  # most rows have no key
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = fk_flag(many, parent, "fk", "pk", "ok")
        sizes = [r["n"] for r in out.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
        assert out.filter("ok").count() == 1000 and out.count() == 5000 and len(sizes) > 1 and max(sizes) < 4000
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_broadcast_is_decided_by_bytes(spark, tmp_path):
    narrow = spark.range(2000).select(F.col("id").cast("string").alias("n"), "id")
    wide = spark.range(20).select(F.repeat(F.col("id").cast("string"), 100_000).alias("n"), "id")
    assert fits(narrow, 1 << 20) and not fits(wide, 1 << 20) and fits(wide, 8 << 20)  # twenty rows, two megabytes
    wide.write.parquet(str(tmp_path / "wide"))
    assert not fits(spark.read.parquet(str(tmp_path / "wide")), 1 << 20)
    assert fits(narrow.limit(0), 0)
    facts = spark.createDataFrame([("1",), ("x",)], "name string")
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plans = [lookup(facts, narrow, F.col("name"), F.col("n"), ["id"], max_bytes=b)._jdf.queryExecution().executedPlan().toString() for b in (1 << 20, 1000)]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert "BroadcastHashJoin" in plans[0] and "SortMergeJoin" in plans[1]


def _stamped(spark, rows):
    df = spark.createDataFrame(rows, "k int, v string, d string")
    return df.select("k", "v", F.to_timestamp("d").alias("ingestion_timestamp"))


def test_latest_batch_asof_and_diff(spark):
    b = _stamped(spark, [(1, "a", "2024-01-01"), (2, "b", "2024-01-01"), (1, "A", "2024-01-02"), (3, "c", "2024-01-02")])
    assert sorted(r["k"] for r in latest_batch(b).collect()) == [1, 3]
    assert latest_batch(b.drop("ingestion_timestamp")).count() == 4   # fallback: unstamped -> whole table
    snap = {r["k"]: r["v"] for r in as_of(b, ["k"], "2024-01-01 12:00:00").collect()}
    assert snap == {1: "a", 2: "b"}
    old = b.filter(F.to_date("ingestion_timestamp") == "2024-01-01").select("k", "v")
    new = b.filter(F.to_date("ingestion_timestamp") == "2024-01-02").select("k", "v")
    d = {r["k"]: (r["change_type"], r["v"]) for r in batch_diff(old, new, ["k"], ["v"]).collect()}
    assert d == {1: ("UPDATE", "A"), 2: ("DELETE", "b"), 3: ("INSERT", "c")}


def test_batch_diff_null_keys_bypass_the_join(spark):
    old = spark.createDataFrame([(None, "x"), (1, "a")], "k int, v string")
    new = spark.createDataFrame([(None, "y"), (1, "a"), (2, "b")], "k int, v string")
    got = sorted((r["k"] if r["k"] is not None else -1, r["change_type"], r["v"])
                 for r in batch_diff(old, new, ["k"], ["v"]).collect())
    assert got == [(-1, "DELETE", "x"), (-1, "INSERT", "y"), (2, "INSERT", "b")]


def test_silver_ticket_hot_key_dedups_before_join(spark):
    rows = [(1, 10, "Card block", "URA", "Sim", str(i % 7)) for i in range(30)]
    rows += [(2, 11, "App problem", "chat bot", "nao", None), (3, 12, "x", "y", "", " ")]
    bronze = spark.createDataFrame(rows, "id_ticket long, id_client long, reason string, channel string, "
                                         "resolved string, id_agent string")
    bronze = bronze.select("*", F.to_timestamp(F.lit("2024-01-01 00:00:00")).alias("ingestion_timestamp"),
                           F.lit("t").alias("origem"))
    reasons = spark.createDataFrame([(7, "Card block"), (8, "App problem")], "cd_motivo long, ds_motivo string")
    channels = spark.createDataFrame([(70, "URA"), (80, "CHATBOT")], "cd_canal long, nm_canal string")
    times = spark.createDataFrame([], "cd_chamado long, dh_abertura timestamp, dh_inicio timestamp, dh_fim timestamp")
    s = S.silver_ticket(bronze, reasons, channels, times)
    got = {r["cd_chamado"]: r for r in s.flagged.collect()}
    assert sorted(got) == [1, 2, 3]
    assert got[1]["cd_atendente"] == 6 and got[1]["cd_motivo"] == 7 and got[1]["cd_canal"] == 70
    assert got[2]["cd_canal"] == 80 and got[2]["st_resolvido"] is False and got[2]["cd_atendente"] is None
    assert got[3]["flag_qualidade"] == "ERRO"
    plan = s.flagged._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_left_fanout_equals_left_join_with_hot_key(spark):
    from callstar.plans.gold import _left_fanout
    left = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n"), (4, "d")], "k int, l string")
    right_rows = [(1, i) for i in range(50)] + [(2, 7), (None, 9), (3, 5)]
    right = spark.createDataFrame(right_rows, "k int, r int")
    want = sorted(map(tuple, left.join(right, "k", "left").select("k", "l", "r").collect()), key=str)
    got = sorted(map(tuple, _left_fanout(left, right, "k").select("k", "l", "r").collect()), key=str)
    assert got == want and len(got) == 53


def test_fanout_reads_its_left_side_once(spark, tmp_path):
    """The rows of the left outer join (keys without a match, null keys, a hot key, repeated rows), with the left side once in the plan."""
    from callstar.plans import gold
    path = str(tmp_path / "left.parquet")
    spark.sql("SELECT CASE WHEN id % 7 > 0 THEN id % 40 END AS cd_chamado, id % 3 AS v FROM range(300)").write.parquet(path)
    left = spark.read.parquet(path)
    right = spark.sql("SELECT CASE WHEN id % 5 > 0 THEN IF(id % 3 = 0, 1, id % 25) END AS cd_chamado, nullif(id % 4, 0) AS w FROM range(200)")
    got = gold._left_fanout(left, right, "cd_chamado")
    want = left.join(right, "cd_chamado", "left").select(got.columns)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Relation [cd_chamado") == 1
