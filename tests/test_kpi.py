"""KPIs on a hand-built star with values computed by hand."""
from decimal import Decimal
from types import SimpleNamespace

from callstar.plans import kpi


def _star(spark):
    fact = spark.createDataFrame([
        # cd_chamado, cd_motivo, cd_canal, cd_atendente, cd_cliente, wait, handling, cost, score, negative, resolved, hour
        (1, 1, 10, None, "c1", 0, 60, Decimal("10.0"), 5, 0, 1, 9),
        (2, 1, 10, 7, "c1", 119, 60, Decimal("20.0"), 2, 1, 0, 9),
        (3, 2, 20, 7, "c2", 120, 30, Decimal("30.0"), None, 0, 1, 10),
        (4, 2, 20, 8, "c2", 299, 30, Decimal("40.0"), 4, 0, 1, 10),
        (5, 3, 20, None, "c3", 300, 10, Decimal("0.0"), 1, 1, 0, 11),
        (6, 3, 20, 8, "c3", 600, 10, Decimal("0.0"), 3, 1, 0, 11),
    ], "cd_chamado long, cd_motivo long, cd_canal long, cd_atendente long, cd_cliente string, "
       "val_tempo_espera long, val_tempo_atendimento long, val_custo decimal(22,10), val_nota_csat smallint, "
       "fl_experiencia_negativa smallint, st_resolvido smallint, nu_hora_dia smallint")
    dim_channel = spark.createDataFrame([(10, "CHATBOT", True, "Automatizado"), (20, "ATENDIMENTO INICIAL", True,
                                                                               "Humanizado")],
                                        "cd_canal long, nm_canal string, st_ativo boolean, ds_tipo_interacao string")
    dim_reason = spark.createDataFrame([(1, "Card block", "CARD", "ALTA"), (2, "App problem", "SERVICE", "BAIXA"),
                                        (3, "Branch transfer", "REGISTRATION", "BAIXA")],
                                       "cd_motivo long, ds_motivo string, ds_categoria string, ds_criticidade string")
    dim_agent = spark.createDataFrame([(7, "Ana", 1), (8, "Bia", 2)], "cd_atendente long, nm_atendente string, nu_nivel smallint")
    dim_client = spark.createDataFrame([("c1", "SUL", "Geração Z (Até 24)"), ("c2", "NORTE", "Adulto (41-60)"),
                                        ("c3", "SUL", "Adulto (41-60)")],
                                       "cd_cliente string, nm_regiao string, ds_faixa_etaria string")
    fact_cost = spark.createDataFrame([(1, Decimal("10.0")), (1, Decimal("20.0")), (2, Decimal("70.0"))],
                                      "cd_motivo long, val_custo_total decimal(12,10)")
    fact_agent = spark.createDataFrame([(7, 2, 90, Decimal("2.00")), (8, 2, 40, Decimal("3.50"))],
                                       "cd_atendente long, qtd_chamados_atendidos long, val_tempo_trabalhado_seg long, "
                                       "val_nota_media decimal(3,2)")
    return SimpleNamespace(fact_service=fact, dim_channel=dim_channel, dim_reason=dim_reason, dim_agent=dim_agent,
                           dim_client=dim_client, fact_cost=fact_cost, fact_agent=fact_agent)


def test_wait_buckets_edges(spark):
    got = {r["wait_bucket"]: (r["n_tickets"], r["n_rated"]) for r in kpi.csat_by_wait(_star(spark)).collect()}
    assert got == {"0-2 min": (2, 2), "2-5 min": (2, 1), "5-10 min": (1, 1), "10+ min": (1, 1)}


def test_overflow_and_waste(spark):
    lake = _star(spark)
    o = kpi.overflow_rate(lake).first()
    assert (o["automated_tickets"], o["overflow_tickets"], o["overflow_pct"]) == (2, 1, 50.0)
    assert o["agent_share_pct"] == round(4 * 100 / 6, 6)
    w = kpi.waste(lake).first()          # BAIXA reasons on human channels: tickets 3..6
    assert (w["waste_tickets"], w["waste_cost"], w["total_cost"]) == (4, 70.0, 100.0)
    assert w["waste_cost_pct"] == 70.0


def test_pareto_and_ranking(spark):
    lake = _star(spark)
    p = {r["cd_motivo"]: (r["total_cost"], r["share_pct"], r["cum_share_pct"]) for r in kpi.cost_by_reason(lake).collect()}
    assert p == {2: (70.0, 70.0, 70.0), 1: (30.0, 30.0, 100.0)}
    rank = {r["cd_atendente"]: r["rank"] for r in kpi.agent_ranking(lake).collect()}
    assert rank == {8: 1, 7: 2}   # same volume, higher score first


def test_profile_kpis_preaggregate_per_client(spark):
    lake = _star(spark)
    by_age = {r["ds_faixa_etaria"]: (r["automated_tickets"], r["overflow_tickets"])
              for r in kpi.overflow_by_age(lake).collect()}
    assert by_age == {"Geração Z (Até 24)": (2, 1)}
    prof = {(r["ds_faixa_etaria"], r["nm_regiao"], r["ds_categoria"]): r["n_tickets"]
            for r in kpi.problems_by_profile(lake).collect()}
    assert prof == {("Geração Z (Até 24)", "SUL", "CARD"): 2, ("Adulto (41-60)", "NORTE", "SERVICE"): 2,
                    ("Adulto (41-60)", "SUL", "REGISTRATION"): 2}
