"""Undo of a batch, kept aggregates and pruned reads of the stored star."""
import re
import uuid

import pytest
from pyspark.sql import functions as F

from callstar.plans import aggregates, daily_load, replay, schemas
from callstar.plans import gold as G
from callstar.plans.lake import Lake, StoredLake
from callstar.sources import sinks
from callstar.sources.landing import LANDING

DAYS = ["2024-03-01 02:00:00", "2024-03-02 02:00:00", "2024-03-03 02:00:00"]
TABLES = ([("silver", t) for t in ("tb_atendente", "tb_canal", "tb_cliente", "tb_chamado_log", "tb_custo_chamado", "tb_motivo", "tb_pesquisa", "tb_chamado")]
          + [("gold", t) for t in daily_load.GOLD_KEYS])


def _fresh(spark):
    path = f"{spark.conf.get('spark.checkpoint.dir')}/wh-{uuid.uuid4().hex}"
    spark.conf.set("callstar.warehouse", path)
    spark.conf.set("callstar.silver.range_width", "5000")
    return path


@pytest.fixture(autouse=True)
def _width(spark):
    yield
    spark.conf.unset("callstar.silver.range_width")


def _days(spark, sf):
    """Three batches: later ids, late times, changed tickets, a reason and agents of their own, costs that change ticket."""
    land = {n: Lake(spark, sf).landing(n) for n in LANDING}
    first = {"l_tickets": "id_ticket % 3 <> 0", "l_ticket_times": "id_ticket % 2 = 0", "l_costs": "id_ticket % 5 <> 0", "l_surveys": "id_ticket % 7 <> 0",
             "l_reasons": "id_reason <> 3", "l_agents": "id_agent > 2"}
    day1 = {n: df.filter(first[n]) if n in first else df for n, df in land.items()}
    rest = {n: df.filter(f"not coalesce({c}, false)") for n, c in first.items() for df in [land[n]]}
    again = land["l_tickets"].filter("id_ticket % 3 = 1 and id_ticket % 4 = 0").withColumn("id_agent", F.lit("4"))
    moved = land["l_costs"].filter("id_ticket % 5 = 1").withColumn("id_ticket", F.col("id_ticket") + F.expr("CASE WHEN id_ticket % 2 = 0 THEN 1 ELSE 0 END"))
    day2 = {**rest, "l_tickets": rest["l_tickets"].unionByName(again), "l_costs": rest["l_costs"].unionByName(moved),
            "l_clients": land["l_clients"].filter("id_client % 4 = 0").withColumn("region", F.lit("Elsewhere")), "l_channels": land["l_channels"].limit(0)}
    day3 = {"l_tickets": land["l_tickets"].filter("id_ticket % 9 = 0").withColumn("resolved", F.lit("Sim")), "l_agents": land["l_agents"].limit(0),
            "l_surveys": land["l_surveys"].filter("id_ticket % 4 = 0").withColumn("score", F.lit("5"))}
    return [day1, day2, day3]


def _state(spark, tables=TABLES):
    out = {}
    for layer, t in tables:
        df = sinks.read_current(spark, sinks.table_path(spark, layer, t))
        out[t] = None if df is None else sorted(map(str, df.select(sorted(df.columns)).collect()))
    pending = sinks.read_current(spark, sinks.table_path(spark, "silver", "_pending_tickets"))
    out["pending"] = sorted(map(str, pending.collect()))
    for kept in aggregates.KEPT:
        out[kept.name] = sorted(map(str, kept.read(spark).collect()))
    return out


def _rejects(spark):
    return {t: sorted(map(str, spark.read.parquet(sinks.table_path(spark, "silver", f"{t}_invalidos")).collect())) for _, t in TABLES[:8]}


def _load(spark, landing, stamp):
    bad = [r for r in daily_load.run(spark, landing, stamp).collect() if r["status"] == "FAILED" and r["error"] != "no landing table"]
    assert not bad, bad


def _differences(a, b):
    return {t: (len(a[t] or []), len(b[t] or []), sorted(set(a[t] or []) ^ set(b[t] or []))[:2]) for t in a if a[t] != b[t]}


def _whole_aggregates(spark):
    """The aggregates of the stored facts, from nothing."""
    stored = StoredLake(spark)
    facts = {"ft_custo_operacional": stored.fact_cost, "ft_atendimento_geral": stored.fact_service}
    return {k.name: sorted(map(str, k.of(facts[k.fact]).collect())) for k in aggregates.KEPT}


def test_withdrawn_batches_leave_no_trace(spark, sf_small, monkeypatch):
    """Three batches without the second equal a replay of the first and the third; without the third, the state after the first."""
    path = _fresh(spark)
    days = _days(spark, sf_small)
    schemas = {n: df.schema for n, df in days[0].items()}
    _load(spark, days[0], DAYS[0])
    first, rejects = _state(spark), _rejects(spark)
    for day, stamp in zip(days[1:], DAYS[1:]):
        _load(spark, day, stamp)
    whole = _state(spark)
    assert len(_differences(first, whole)) > 10  # the batches change most tables
    for name, groups in _whole_aggregates(spark).items():  # kept by differences over three batches
        assert whole[name] == groups, name

    # a first attempt that fails on the way: the second one does the rest
    plain = daily_load.load_gold
    monkeypatch.setattr(daily_load, "load_gold", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):
        replay.withdraw(spark, schemas, DAYS[1])
    monkeypatch.setattr(daily_load, "load_gold", plain)
    report = replay.withdraw(spark, schemas, DAYS[1]).collect()
    assert {r["status"] for r in report} == {"REPLAYED"}, [r for r in report if r["error"]]
    now = _state(spark)
    assert replay.rebuild(spark, schemas, path + "-again") == ["20240301020000", "20240303020000"]
    spark.conf.set("callstar.warehouse", path + "-again")
    assert _differences(_state(spark), now) == {}

    spark.conf.set("callstar.warehouse", path)
    replay.withdraw(spark, schemas, DAYS[2])
    assert replay.batches(spark, "l_tickets") == ["20240301020000"]
    assert _differences(first, _state(spark)) == {}
    assert {t for t, r in _rejects(spark).items() if r != rejects[t]} == set()


def test_gold_reads_only_the_partitions_of_touched_tickets(spark, sf_small):
    """Costs and surveys are stored by their own ids: the index names their buckets, and the plan scans no other."""
    _fresh(spark)
    day = _days(spark, sf_small)[0]
    _load(spark, day, DAYS[0])
    ids = spark.createDataFrame([(i,) for i in [r[0] for r in StoredLake(spark).fact_cost.select("cd_chamado").orderBy("cd_chamado").limit(3).collect()]], "cd_chamado bigint")
    for layer, table, place in (("silver", "tb_custo_chamado", sinks.BUCKET_COL), ("silver", "tb_pesquisa", sinks.BUCKET_COL),
                                ("gold", "ft_custo_operacional", "dt_referencia"), ("gold", "ft_atendimento_geral", "dt_referencia")):
        path = sinks.table_path(spark, layer, table)
        whole = spark.read.parquet(path)
        rows = daily_load._tickets_rows(spark, layer, table, ids, place)
        want = whole.join(ids, "cd_chamado", "left_semi").drop(sinks.BUCKET_COL)
        assert sorted(map(str, rows.select(want.columns).collect())) == sorted(map(str, want.collect())), table
        named = sinks.places(spark, daily_load._index(spark, layer, table), ids, 5000)
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert re.search(rf"PartitionFilters: \[[^\]]*{place}#\d+L? (=|IN)", plan) and "dynamicpruning" not in plan, table
        if place == sinks.BUCKET_COL and table == "tb_custo_chamado":
            assert 0 < len(named) < whole.select(place).distinct().count()
            assert set(named) == {str(r[0]) for r in whole.join(ids, "cd_chamado", "left_semi").select(place).distinct().collect()}


    # a warehouse of before the indexes and aggregates: the next load makes them
    for layer, table in (("silver", "tb_custo_chamado"), ("silver", "tb_pesquisa"), ("gold", "ft_custo_operacional"), ("gold", "ft_atendimento_geral")):
        sinks._delete(spark, daily_load._index(spark, layer, table))
    for kept in aggregates.KEPT:
        sinks._delete(spark, sinks.table_path(spark, "gold", kept.name))
    _load(spark, _days(spark, sf_small)[1], DAYS[1])
    state = _state(spark, [])
    for name, groups in _whole_aggregates(spark).items():
        assert state[name] == groups, name
    silver = {t: sinks.read_current(spark, sinks.table_path(spark, "silver", t)) for t in daily_load.TICKET_TABLES}
    full = schemas.enforce(G.fact_service(*silver.values()), schemas.GOLD["ft_atendimento_geral"])
    gold = StoredLake(spark).fact_service.select(*full.columns)
    assert gold.exceptAll(full).count() == 0 and full.exceptAll(gold).count() == 0
