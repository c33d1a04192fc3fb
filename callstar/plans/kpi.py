"""Operational KPIs over the star schema.

Every KPI first reduces the fact to one row per dimension key it needs (the
partial aggregation leaves a few rows per task, so a hot key never gathers
fact rows) and joins the dimensions to that. ``lake`` is anything with the
star's frames as attributes: a ``Lake`` over raw files or a ``StoredLake`` over
the tables the daily load keeps. Windows (Pareto share, ranking, lag) run only over the
*aggregated* rows, so an un-partitioned window sees tens of rows, never
the fact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from callstar.functions import rules as R
from callstar.plans.lake import Lake, StoredLake

LOW_CRITICALITY = "BAIXA"


def _r(c: Column, n: int = 6) -> Column:
    return F.round(c.cast("double"), n)


def _rate(num: Column, den: Column) -> Column:
    return _r(num.cast("double") * 100.0 / den)


def _with_dims(lake: Lake | StoredLake, fact: DataFrame, *dims: str) -> DataFrame:
    out = fact
    for d in dims:
        if d == "reason":
            out = out.join(lake.dim_reason.select("cd_motivo", "ds_motivo", "ds_categoria", "ds_criticidade"),
                           "cd_motivo", "left")
        elif d == "channel":
            out = out.join(lake.dim_channel.select("cd_canal", "nm_canal", "ds_tipo_interacao"),
                           "cd_canal", "left")
        elif d == "agent":
            out = out.join(lake.dim_agent.select("cd_atendente", "nm_atendente", "nu_nivel"),
                           "cd_atendente", "left")
        elif d == "client":
            out = out.join(lake.dim_client.select("cd_cliente", "nm_regiao", "ds_faixa_etaria"),
                           "cd_cliente", "left")
    return out


def cost_by_reason(lake: Lake | StoredLake) -> DataFrame:
    """K-1 Pareto: total cost per reason, share and cumulative share, dearest first."""
    per_key = lake.fact_cost.groupBy("cd_motivo").agg(
        F.sum("val_custo_total").alias("total_cost"), F.count(F.lit(1)).alias("n_costs"))
    g = _with_dims(lake, per_key, "reason")
    everything = Window.partitionBy()
    running = Window.orderBy(F.col("total_cost").desc(), F.col("cd_motivo")).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return g.select(
        "cd_motivo", "ds_motivo", "n_costs", F.col("total_cost").cast("double").alias("total_cost"),
        _rate(F.col("total_cost"), F.sum("total_cost").over(everything)).alias("share_pct"),
        _rate(F.sum("total_cost").over(running), F.sum("total_cost").over(everything)).alias("cum_share_pct"),
    ).orderBy(F.col("total_cost").desc(), "cd_motivo")


def _per_key(fact: DataFrame, *keys: str) -> DataFrame:
    """The service fact reduced to one row per combination of dimension keys."""
    return fact.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.sum("val_custo").alias("cost"),
        F.sum("val_tempo_espera").alias("wait"), F.sum("val_tempo_atendimento").alias("handling"),
        F.sum(F.col("st_resolvido").cast("bigint")).alias("resolved"),
        F.count("cd_atendente").alias("with_agent"))


def _waste_flag(df: DataFrame) -> Column:
    return (F.col("ds_criticidade") == LOW_CRITICALITY) & (F.col("ds_tipo_interacao") == R.CHANNEL_HUMAN)


def waste(lake: Lake | StoredLake) -> DataFrame:
    """K-2 cost and volume of low-criticality reasons served by humans."""
    df = _with_dims(lake, _per_key(lake.fact_service, "cd_motivo", "cd_canal"), "reason", "channel")
    w = F.coalesce(_waste_flag(df), F.lit(False))
    none = F.lit(0).cast("bigint")
    return df.agg(
        F.sum(F.when(w, F.col("cost"))).cast("double").alias("waste_cost"),
        F.coalesce(F.sum(F.when(w, F.col("n"))), none).alias("waste_tickets"),
        F.sum("cost").cast("double").alias("total_cost"),
        F.coalesce(F.sum("n"), none).alias("total_tickets"),
    ).withColumn("waste_cost_pct", _rate(F.col("waste_cost"), F.col("total_cost"))) \
     .withColumn("waste_ticket_pct", _rate(F.col("waste_tickets"), F.col("total_tickets")))


def top_avoidable(lake: Lake | StoredLake, k: int = 3) -> DataFrame:
    """K-3 top-k avoidable reasons by cost, with their share of all waste."""
    df = _with_dims(lake, _per_key(lake.fact_service, "cd_motivo", "cd_canal"), "reason", "channel")
    g = (df.filter(_waste_flag(df)).groupBy("cd_motivo", "ds_motivo")
           .agg(F.sum("cost").alias("waste_cost"), F.sum("n").alias("waste_tickets")))
    everything = Window.partitionBy()
    ranked = g.withColumn("share_pct", _rate(F.col("waste_cost"), F.sum("waste_cost").over(everything)))
    return (ranked.orderBy(F.col("waste_cost").desc(), F.col("cd_motivo")).limit(k)
                  .withColumn("waste_cost", F.col("waste_cost").cast("double")))


def mean_csat(lake: Lake | StoredLake) -> DataFrame:
    """K-4 mean satisfaction score (unrated tickets skipped)."""
    return lake.fact_service.agg(
        _r(F.avg("val_nota_csat")).alias("avg_csat"),
        F.count("val_nota_csat").alias("n_rated"),
        F.count(F.lit(1)).alias("n_tickets"))


def negative_experience(lake: Lake | StoredLake) -> DataFrame:
    """K-5 share of tickets with a negative experience."""
    return lake.fact_service.agg(
        F.sum("fl_experiencia_negativa").cast("bigint").alias("n_negative"),
        F.count(F.lit(1)).alias("n_tickets"),
    ).withColumn("negative_pct", _rate(F.col("n_negative"), F.col("n_tickets")))


def wait_bucket(col: Column) -> Column:
    expr = None
    for upper, label in R.WAIT_BUCKETS:
        expr = F.when(col < upper, F.lit(label)) if expr is None else expr.when(col < upper, F.lit(label))
    return expr.otherwise(F.lit(R.WAIT_BUCKET_ELSE))


def csat_by_wait(lake: Lake | StoredLake) -> DataFrame:
    """K-6 mean CSAT per waiting-time bucket (the flagship query)."""
    return (lake.fact_service
            .groupBy(wait_bucket(F.col("val_tempo_espera")).alias("wait_bucket"))
            .agg(F.count(F.lit(1)).alias("n_tickets"),
                 F.count("val_nota_csat").alias("n_rated"),
                 _r(F.avg("val_nota_csat")).alias("avg_csat")))


def wait_score_corr(lake: Lake | StoredLake) -> DataFrame:
    """K-7 correlation between waiting time and score (rated tickets)."""
    f = lake.fact_service.filter(F.col("val_nota_csat").isNotNull())
    return f.agg(_r(F.corr(F.col("val_tempo_espera").cast("double"),
                           F.col("val_nota_csat").cast("double"))).alias("corr_wait_score"),
                 F.count(F.lit(1)).alias("n_rated"))


def wait_by_channel_type(lake: Lake | StoredLake) -> DataFrame:
    """K-8 mean wait per interaction type, plus the all-channel mean (one rollup of the per-channel sums)."""
    df = _with_dims(lake, _per_key(lake.fact_service, "cd_canal"), "channel")
    g = df.rollup("ds_tipo_interacao").agg(F.sum("wait").alias("wait"), F.sum("n").alias("n_tickets"),
                                           F.grouping("ds_tipo_interacao").alias("all"))
    return g.select(F.when(F.col("all") == 1, F.lit("ALL")).otherwise(F.col("ds_tipo_interacao")).alias("ds_tipo_interacao"),
                    _r(F.col("wait") / F.col("n_tickets")).alias("avg_wait_sec"), "n_tickets")


def specialist_low_criticality(lake: Lake | StoredLake) -> DataFrame:
    """K-9 handling time of level-2 agents spent on low-criticality reasons."""
    served = _per_key(lake.fact_service.filter(F.col("cd_atendente").isNotNull()), "cd_atendente", "cd_motivo")
    df = _with_dims(lake, served, "agent", "reason").filter(F.col("nu_nivel") == 2)
    low = F.col("ds_criticidade") == LOW_CRITICALITY
    none = F.lit(0).cast("bigint")
    return df.agg(
        F.sum("handling").cast("bigint").alias("total_sec"),
        F.coalesce(F.sum(F.when(low, F.col("handling"))), none).alias("low_crit_sec"),
        F.coalesce(F.sum("n"), none).alias("n_tickets"),
        F.coalesce(F.sum(F.when(low, F.col("n"))), none).alias("n_low_crit"),
    ).withColumn("low_crit_pct", _rate(F.col("low_crit_sec"), F.col("total_sec")))


def overflow_rate(lake: Lake | StoredLake) -> DataFrame:
    """K-10 bot -> human overflow: automated-channel tickets that carry an agent."""
    df = _with_dims(lake, _per_key(lake.fact_service, "cd_canal"), "channel")
    auto = F.col("ds_tipo_interacao") == R.CHANNEL_AUTOMATED
    none = F.lit(0).cast("bigint")
    return df.agg(
        F.coalesce(F.sum(F.when(auto, F.col("n"))), none).alias("automated_tickets"),
        F.coalesce(F.sum(F.when(auto, F.col("with_agent"))), none).alias("overflow_tickets"),
        F.coalesce(F.sum("n"), none).alias("all_tickets"),
        F.coalesce(F.sum("with_agent"), none).alias("tickets_with_agent"),
    ).withColumn("overflow_pct", _rate(F.col("overflow_tickets"), F.col("automated_tickets"))) \
     .withColumn("agent_share_pct", _rate(F.col("tickets_with_agent"), F.col("all_tickets")))


def _clients(lake: Lake | StoredLake) -> DataFrame:
    return lake.dim_client.select("cd_cliente", "nm_regiao", "ds_faixa_etaria")


def overflow_by_age(lake: Lake | StoredLake) -> DataFrame:
    """K-11 overflow volume and rate per age band.

    The fact is first reduced to one row per client and channel, so the joins
    move that, never a ticket.
    """
    df = _with_dims(lake, _per_key(lake.fact_service, "cd_cliente", "cd_canal"), "channel")
    per_client = (df.filter(F.col("ds_tipo_interacao") == R.CHANNEL_AUTOMATED)
                    .groupBy("cd_cliente").agg(F.sum("n").alias("n"), F.sum("with_agent").alias("n_overflow")))
    g = per_client.join(_clients(lake), "cd_cliente", "left").groupBy("ds_faixa_etaria").agg(
        F.sum("n").cast("bigint").alias("automated_tickets"),
        F.sum("n_overflow").cast("bigint").alias("overflow_tickets"))
    return g.withColumn("overflow_pct", _rate(F.col("overflow_tickets"), F.col("automated_tickets")))


def peak_hours(lake: Lake | StoredLake) -> DataFrame:
    """K-12 tickets and mean wait per hour of day."""
    return lake.fact_service.groupBy("nu_hora_dia").agg(
        F.count(F.lit(1)).alias("n_tickets"), _r(F.avg("val_tempo_espera")).alias("avg_wait_sec"))


def _resolution(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({"n": "n_tickets", "resolved": "n_resolved"}).withColumn(
        "resolved_pct", _rate(F.col("n_resolved"), F.col("n_tickets")))


def resolution_by_channel(lake: Lake | StoredLake) -> DataFrame:
    """K-13 resolution rate per channel."""
    df = _with_dims(lake, _per_key(lake.fact_service, "cd_canal"), "channel")
    return _resolution(df.select("cd_canal", "nm_canal", "n", "resolved"))


def resolution_by_agent(lake: Lake | StoredLake) -> DataFrame:
    """K-13 resolution rate per agent (tickets without agent left out)."""
    served = _per_key(lake.fact_service.filter(F.col("cd_atendente").isNotNull()), "cd_atendente")
    return _resolution(_with_dims(lake, served, "agent").select("cd_atendente", "nm_atendente", "n", "resolved"))


def _unit_cost(df: DataFrame, *by: str) -> DataFrame:
    g = df.groupBy(*by).agg(F.sum("cost").alias("cost"), F.sum("n").alias("n_tickets"))
    return g.select(*by, F.col("cost").cast("double").alias("total_cost"), "n_tickets",
                    _r(F.col("cost").cast("double") / F.col("n_tickets")).alias("avg_cost_per_ticket"))


def cost_per_ticket_by_type(lake: Lake | StoredLake) -> DataFrame:
    """K-14 cost per ticket, human vs automated channels."""
    return _unit_cost(_with_dims(lake, _per_key(lake.fact_service, "cd_canal"), "channel"), "ds_tipo_interacao")


def cost_per_ticket_by_channel(lake: Lake | StoredLake) -> DataFrame:
    """K-14 cost per ticket and channel."""
    return _unit_cost(_with_dims(lake, _per_key(lake.fact_service, "cd_canal"), "channel"), "cd_canal", "nm_canal")


def csat_over_time(lake: Lake | StoredLake) -> DataFrame:
    """K-15 mean CSAT per day."""
    return lake.fact_service.groupBy("dt_referencia").agg(
        _r(F.avg("val_nota_csat")).alias("avg_csat"), F.count("val_nota_csat").alias("n_rated"),
        F.count(F.lit(1)).alias("n_tickets"))


def agent_ranking(lake: Lake | StoredLake) -> DataFrame:
    """K-16 agents ranked by volume, then score, then id."""
    df = lake.fact_agent.join(lake.dim_agent.select("cd_atendente", "nm_atendente", "nu_nivel"),
                              "cd_atendente", "left")
    order = Window.orderBy(F.col("qtd_chamados_atendidos").desc(),
                           F.col("val_nota_media").desc_nulls_last(), F.col("cd_atendente"))
    return df.select("cd_atendente", "nm_atendente", "nu_nivel", "qtd_chamados_atendidos",
                     "val_tempo_trabalhado_seg", F.col("val_nota_media").cast("double").alias("val_nota_media"),
                     F.row_number().over(order).cast("bigint").alias("rank"))


def load_by_level(lake: Lake | StoredLake) -> DataFrame:
    """K-17 tickets and handling time per agent level, with their shares of the total."""
    served = _per_key(lake.fact_service.filter(F.col("cd_atendente").isNotNull()), "cd_atendente")
    g = _with_dims(lake, served, "agent").groupBy("nu_nivel").agg(
        F.sum("n").alias("n_tickets"), F.sum("handling").cast("bigint").alias("handling_sec"))
    everything = Window.partitionBy()
    return (g.withColumn("ticket_share_pct", _rate(F.col("n_tickets"), F.sum("n_tickets").over(everything)))
             .withColumn("handling_share_pct", _rate(F.col("handling_sec"), F.sum("handling_sec").over(everything))))


def _by_profile(lake: Lake | StoredLake, *by: str) -> DataFrame:
    """Tickets per age band x region x ``by`` (reason columns), reduced per client before the client join."""
    df = _with_dims(lake, _per_key(lake.fact_service, "cd_cliente", "cd_motivo"), "reason")
    per_client = df.groupBy("cd_cliente", *by).agg(F.sum("n").alias("n"))
    return (per_client.join(_clients(lake), "cd_cliente", "left").groupBy("ds_faixa_etaria", "nm_regiao", *by)
                      .agg(F.sum("n").cast("bigint").alias("n_tickets")))


def problems_by_profile(lake: Lake | StoredLake) -> DataFrame:
    """K-18 tickets per age band x region x reason category."""
    return _by_profile(lake, "ds_categoria")


def reasons_by_profile(lake: Lake | StoredLake) -> DataFrame:
    """K-18 tickets per age band x region x reason."""
    return _by_profile(lake, "cd_motivo", "ds_motivo")
