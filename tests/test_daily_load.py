"""Write path: bronze append, silver flagged-once + versioned upsert, gold, views."""
import uuid

from pyspark.sql import functions as F

from callstar.plans import daily_load, kpi
from callstar.plans import gold as G
from callstar.plans import schemas
from callstar.plans.lake import Lake, StoredLake
from callstar.sources import sinks
from callstar.sources.landing import LANDING


def test_daily_load_twice_is_idempotent(spark, sf_small):
    lake = Lake(spark, sf_small)
    landing = {n: lake.landing(n) for n in LANDING}
    report = daily_load.run(spark, landing, "2024-03-01 02:00:00").collect()
    assert {r["status"] for r in report} == {"LOADED"}
    first = {r["table_name"]: r["valid_rows"] for r in report if r["layer"] == "silver"}
    expected = {s.name: s.valid().count() for s in lake.all_silver()}
    assert first == expected

    # the same batch loaded again replaces its partition: nothing is stored twice
    def bronze_rows(name):
        return daily_load.bronze_batch(spark, name, landing[name].schema, "2024-03-01 02:00:00").count()
    before = bronze_rows("l_tickets")
    daily_load.run(spark, landing, "2024-03-01 02:00:00")
    assert bronze_rows("l_tickets") == before == landing["l_tickets"].count()
    for table, n in expected.items():
        cur = sinks.read_current(spark, sinks.table_path(spark, "silver", table))
        assert cur.count() == n, table
    fact = sinks.read_current(spark, sinks.table_path(spark, "gold", "ft_atendimento_geral"))
    assert fact.count() == expected["tb_chamado"]
    assert fact.select("cd_chamado").distinct().count() == fact.count()
    versions = spark.read.parquet(sinks.table_path(spark, "gold", "dm_atendente")) \
                    .select(F.max("_version")).first()[0]
    assert versions == 2
    assert "dt_referencia=" in " ".join(
        p.name for p in __import__("pathlib").Path(sinks.table_path(spark, "gold", "ft_atendimento_geral")).iterdir())
    assert spark.sql("SELECT count(*) AS n FROM vw_ft_atendimento_geral").first()["n"] == fact.count()
    status = {r["table_name"]: r["loaded"] for r in daily_load.layer_status(spark).collect()}
    assert all(status.values()) and len(status) == 8
    audit = spark.read.parquet(sinks.table_path(spark, "silver", "tb_motivo_invalidos"))
    assert "motivo_rejeicao" in audit.columns

    # KPIs over the stored star equal those over the raw files
    stored = StoredLake(spark)
    for name in ("cost_by_reason", "waste", "csat_by_wait", "overflow_by_age", "load_by_level", "resolution_by_agent"):
        a, b = (sorted(map(str, getattr(kpi, name)(x).collect())) for x in (lake, stored))
        assert a == b, name


def test_two_batches_upsert_stored_silver(spark, sf_small):
    """Day 1 then day 2 of the client feed through the stored write path."""
    from callstar.plans import silver as S
    from callstar.sources.ingest import stamp
    from callstar.operators.upsert import upsert

    spark.conf.set("callstar.warehouse", f"{spark.conf.get('spark.checkpoint.dir')}/wh-{uuid.uuid4().hex}")
    lake = Lake(spark, sf_small)
    feed = lake.landing("b_clients")
    cols = [c for c in feed.columns if c != "batch_day"]
    day1 = feed.filter(F.col("batch_day") == F.lit("2024-02-01").cast("date")).select(*cols)
    day2 = feed.filter(F.col("batch_day") == F.lit("2024-02-02").cast("date")).select(*cols)
    landing = {n: lake.landing(n) for n in LANDING}
    daily_load.run(spark, {**landing, "l_clients": day1}, "2024-02-01 02:00:00")
    daily_load.run(spark, {**landing, "l_clients": day2}, "2024-02-02 02:00:00")
    stored = sinks.read_current(spark, sinks.table_path(spark, "silver", "tb_cliente"))

    # expected: in-memory upsert of the two validated batches
    v1 = S.silver_client(stamp(day1, "2024-02-01 02:00:00")).valid()
    v2 = S.silver_client(stamp(day2, "2024-02-02 02:00:00")).valid()
    expected = upsert(v1, v2, ["cd_cliente"])
    key = ["cd_cliente", "nm_regiao", "nu_idade", "ds_email"]
    assert stored.count() == expected.count()
    assert stored.select(*key).exceptAll(expected.select(*key)).count() == 0
    assert stored.select("cd_cliente").distinct().count() == stored.count()

    # incremental gold equals a full rebuild from the final silver tables
    def silver(t):
        return sinks.read_current(spark, sinks.table_path(spark, "silver", t))
    full = schemas.enforce(G.fact_service(silver("tb_chamado"), silver("tb_chamado_log"),
                                          silver("tb_custo_chamado"), silver("tb_pesquisa")),
                           schemas.GOLD["ft_atendimento_geral"])
    gold = sinks.read_current(spark, sinks.table_path(spark, "gold", "ft_atendimento_geral")).select(*full.columns)
    assert gold.count() == full.count()
    assert gold.exceptAll(full).count() == 0 and full.exceptAll(gold).count() == 0


def test_incremental_gold_with_partial_batch(spark, sf_small):
    spark.conf.set("callstar.warehouse", f"{spark.conf.get('spark.checkpoint.dir')}/wh-{uuid.uuid4().hex}")
    lake = Lake(spark, sf_small)
    landing = {n: lake.landing(n) for n in LANDING}
    split = {"l_tickets": "id_ticket", "l_ticket_times": "id_ticket", "l_costs": "id_ticket", "l_surveys": "id_ticket"}
    cut = landing["l_tickets"].agg(F.expr("percentile_disc(0.8) WITHIN GROUP (ORDER BY id_ticket)")).first()[0]
    day1 = {**landing, **{n: landing[n].filter(F.col(c) < cut) for n, c in split.items()}}
    day2 = {**landing, **{n: landing[n].filter(F.col(c) >= cut) for n, c in split.items()}}
    daily_load.run(spark, day1, "2024-03-01 02:00:00")
    daily_load.run(spark, day2, "2024-03-02 02:00:00")
    touched = daily_load.touched_tickets(spark, "2024-03-02 02:00:00").count()
    all_tickets = sinks.read_current(spark, sinks.table_path(spark, "silver", "tb_chamado")).count()
    assert 0 < touched < all_tickets

    def silver(t):
        return sinks.read_current(spark, sinks.table_path(spark, "silver", t))
    for name, build in [("ft_atendimento_geral", lambda: G.fact_service(silver("tb_chamado"), silver("tb_chamado_log"),
                                                                        silver("tb_custo_chamado"), silver("tb_pesquisa"))),
                        ("ft_custo_operacional", lambda: G.fact_cost(silver("tb_chamado"), silver("tb_custo_chamado"))),
                        ("dm_chamado", lambda: G.dim_ticket(silver("tb_chamado")))]:
        full = schemas.enforce(build(), schemas.GOLD[name])
        gold = sinks.read_current(spark, sinks.table_path(spark, "gold", name)).select(*full.columns)
        assert gold.exceptAll(full).count() == 0 and full.exceptAll(gold).count() == 0, name


def _fresh(spark):
    spark.conf.set("callstar.warehouse", f"{spark.conf.get('spark.checkpoint.dir')}/wh-{uuid.uuid4().hex}")


def _silver(spark, t):
    return sinks.read_current(spark, sinks.table_path(spark, "silver", t))


def test_late_times_and_lookups_equal_a_rebuild(spark, sf_small):
    """Half of the times, and two reasons, arrive a day after their tickets."""
    _fresh(spark)
    lake = Lake(spark, sf_small)
    landing = {n: lake.landing(n) for n in LANDING}
    parts = {"l_ticket_times": "id_ticket % 2 = 0", "l_reasons": "id_reason > 2"}
    day1 = {n: df.filter(parts[n]) if n in parts else df for n, df in landing.items()}
    none = {n: df.limit(0) for n, df in landing.items()}
    day2 = {**none, **{n: landing[n].filter(f"not ({c})") for n, c in parts.items()}}
    daily_load.run(spark, day1, "2024-03-01 02:00:00")
    waiting = _silver(spark, "_pending_tickets").count()
    before = _silver(spark, "tb_chamado").count()
    report = daily_load.run(spark, day2, "2024-03-02 02:00:00").collect()
    assert {r["status"] for r in report} == {"LOADED"}, [r for r in report if r["error"]]
    assert waiting > _silver(spark, "_pending_tickets").count()
    want = lake.tickets.valid()
    assert before < _silver(spark, "tb_chamado").count() == want.count()
    cols = ["cd_chamado", "cd_motivo", "cd_canal", "tm_espera", "tm_duracao"]
    assert _silver(spark, "tb_chamado").select(*cols).exceptAll(want.select(*cols)).count() == 0
    gold, whole = StoredLake(spark).fact_service, lake.fact_service
    total = lambda df: df.agg(F.sum("val_tempo_espera"), F.sum("fl_experiencia_negativa"), F.sum("val_custo"), F.count("*")).first()
    assert total(gold) == total(whole)
    agents = ["cd_atendente", "qtd_chamados_atendidos", "val_tempo_trabalhado_seg", "val_nota_media"]
    assert StoredLake(spark).fact_agent.select(*agents).exceptAll(lake.fact_agent.select(*agents)).count() == 0


def test_failing_and_empty_tables_do_not_stop_the_others(spark, sf_small):
    _fresh(spark)
    lake = Lake(spark, sf_small)
    landing = {n: lake.landing(n) for n in LANDING}
    boom = F.raise_error(F.lit("bad source")).cast("string")
    broken = landing["l_costs"].withColumn("amount", boom) if "amount" in landing["l_costs"].columns else landing["l_costs"].withColumn("x", boom)
    report = daily_load.run(spark, {**landing, "l_costs": broken, "l_surveys": landing["l_surveys"].limit(0)}, "2024-03-01 02:00:00").collect()
    silver = {r["table_name"]: r for r in report if r["layer"] == "silver"}
    assert silver["tb_custo_chamado"]["status"] == "FAILED" and "bad source" in silver["tb_custo_chamado"]["error"]
    assert {t: r["status"] for t, r in silver.items() if t != "tb_custo_chamado"} == {t: "LOADED" for t in silver if t != "tb_custo_chamado"}
    assert silver["tb_pesquisa"]["valid_rows"] == 0 and silver["tb_chamado"]["valid_rows"] == lake.tickets.valid().count()
    assert {r["table_name"] for r in report if r["layer"] == "gold" and r["status"] == "FAILED"} >= {"ft_custo_operacional"}
    again = daily_load.run(spark, landing, "2024-03-02 02:00:00").collect()
    assert {r["status"] for r in again} == {"LOADED"}
    assert StoredLake(spark).fact_cost.count() == lake.fact_cost.count()


def test_streamed_records_reach_the_daily_load(spark, sf_small, tmp_path):
    from callstar.plans import silver as S
    from callstar.streaming.ingest_stream import stream_to_bronze
    _fresh(spark)
    batch = "2024-03-05 02:00:00"
    agents = Lake(spark, sf_small).landing("l_agents")
    agents.write.parquet(str(tmp_path / "in"))
    schema = spark.read.parquet(str(tmp_path / "in")).schema
    stream_to_bronze(spark, str(tmp_path / "in"), schema, sinks.table_path(spark, "bronze", "l_agents"), f"agents_{uuid.uuid4().hex}", batch).awaitTermination()
    bronze = daily_load.bronze_batch(spark, "l_agents", schema, batch)
    assert bronze.count() == agents.count()
    assert daily_load.load_silver(spark, {"l_agents": schema}, batch) == {}
    assert _silver(spark, "tb_atendente").count() == S.silver_agent(bronze, batch=batch).valid().count()


def test_a_load_keeps_large_key_sets_off_the_driver(spark, monkeypatch):
    """Ids of 10 MB, less than a query's runtime broadcast bound, are joined by shuffle while a load or its undo runs."""
    from callstar.plans import replay

    def joined():
        ids = spark.range(600_000).withColumnRenamed("id", "k").distinct()
        df = spark.range(900_000).withColumnRenamed("id", "k").join(ids, "k", "left_semi").agg(F.count("k"))
        assert df.collect()[0][0] == 600_000
        return df._jdf.queryExecution().executedPlan().toString()

    spark.conf.set("callstar.warehouse", f"{spark.conf.get('spark.checkpoint.dir')}/wh-{uuid.uuid4().hex}")
    assert "BroadcastHashJoin" in joined()
    seen = []
    monkeypatch.setattr(daily_load, "recover", lambda s: seen.append(joined()))
    daily_load.run(spark, {}, "2024-03-01 02:00:00")
    replay.withdraw(spark, {}, "2024-03-01 02:00:00")
    assert len(seen) == 2 and not any("BroadcastHashJoin" in plan for plan in seen)
    assert "BroadcastHashJoin" in joined()
