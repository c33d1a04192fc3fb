"""Gold layer: five dimensions and three facts (plus two documented
aggregate variants).

Facts join on ``cd_chamado`` only. The N-side tables (cost, survey) are
reduced to one row per ticket *before* the join — a partial+final hash
aggregate (cost) and a keep-latest window with a pre-shuffle group limit
(survey) — so a ticket with many costs or surveys neither multiplies fact
rows nor sends a hot ticket's rows through the join. Every reduced side is
hash-partitioned on ``cd_chamado`` already, so the left-join chain reuses
that partitioning instead of re-shuffling the fact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callstar.functions import keys as K
from callstar.functions import rules as R
from callstar.operators.dedup import keep_latest

MONEY_SUM = "decimal(22,10)"


def _bands(col: Column, bands, otherwise) -> Column:
    expr = None
    for upper, label in bands:
        expr = F.when(col <= upper, F.lit(label)) if expr is None else expr.when(col <= upper, F.lit(label))
    return expr.otherwise(F.lit(otherwise))


def dim_agent(agents: DataFrame, specialist_level: int = 2) -> DataFrame:
    return agents.select(
        "cd_atendente", "nm_atendente", F.col("nu_nivel").cast("smallint").alias("nu_nivel"),
        F.when(F.col("nu_nivel") == specialist_level, F.lit(R.PROFILE_SPECIALIST))
         .otherwise(F.lit(R.PROFILE_GENERALIST)).alias("ds_perfil"))


def automated(name: Column, patterns=R.AUTOMATED_CHANNEL_LIKE) -> Column:
    up = F.upper(name)
    cond = None
    for pat in patterns:
        cond = up.like(pat) if cond is None else (cond | up.like(pat))
    return cond


def dim_channel(channels: DataFrame, patterns=R.AUTOMATED_CHANNEL_LIKE) -> DataFrame:
    return channels.select(
        "cd_canal", "nm_canal", "st_ativo",
        F.when(automated(F.col("nm_canal"), patterns), F.lit(R.CHANNEL_AUTOMATED))
         .otherwise(F.lit(R.CHANNEL_HUMAN)).alias("ds_tipo_interacao"))


def dim_client(clients: DataFrame, bands=R.AGE_BANDS, otherwise: str = R.AGE_BAND_ELSE) -> DataFrame:
    """Age bands are a parameter: (inclusive upper bound, label) in order."""
    return clients.select(
        "cd_cliente", "nm_cliente", "ds_email", "nm_regiao",
        F.col("nu_idade").cast("smallint").alias("nu_idade"),
        _bands(F.col("nu_idade"), bands, otherwise).alias("ds_faixa_etaria"))


def dim_reason(reasons: DataFrame, potential=R.AUTOMATION_POTENTIAL,
               otherwise: str = R.AUTOMATION_POTENTIAL_ELSE) -> DataFrame:
    up = F.upper(F.col("ds_criticidade"))
    expr = None
    for pat, label in potential:
        expr = F.when(up.like(pat), F.lit(label)) if expr is None else expr.when(up.like(pat), F.lit(label))
    return reasons.select("cd_motivo", "ds_motivo", "ds_categoria", "ds_criticidade",
                          expr.otherwise(F.lit(otherwise)).alias("ds_potencial_automacao"))


def dim_ticket(tickets: DataFrame) -> DataFrame:
    return tickets.select(
        "cd_chamado",
        F.coalesce("tm_espera", F.lit(0)).cast("bigint").alias("tm_espera"),
        F.coalesce("tm_duracao", F.lit(0)).cast("bigint").alias("tm_duracao"))


def cost_per_ticket(costs: DataFrame) -> DataFrame:
    return (costs.groupBy("cd_chamado")
                 .agg(F.sum("vl_custo").cast(MONEY_SUM).alias("vl_custo_total"),
                      F.count(F.lit(1)).alias("qt_custos")))


def survey_per_ticket(surveys: DataFrame) -> DataFrame:
    """The latest survey of each ticket."""
    return keep_latest(surveys.select("cd_chamado", "cd_pesquisa", "nu_nota", "dt_ingestion"),
                       ["cd_chamado"], ["dt_ingestion", "cd_pesquisa"]).select("cd_chamado", "nu_nota")


FACT_SERVICE_COLS = ["pk", "cd_cliente", "cd_motivo", "cd_canal", "cd_atendente", "cd_chamado",
                     "dt_referencia", "nu_hora_dia", "val_tempo_espera", "val_tempo_atendimento",
                     "val_custo", "val_nota_csat", "fl_experiencia_negativa", "st_resolvido"]


def fact_service(tickets: DataFrame, times: DataFrame, costs: DataFrame, surveys: DataFrame) -> DataFrame:
    """One row per valid ticket (upsert key: ``cd_chamado``)."""
    t = tickets.alias("c")
    j = (t.join(times.select("cd_chamado", "dh_inicio"), "cd_chamado", "left")
          .join(cost_per_ticket(costs), "cd_chamado", "left")
          .join(survey_per_ticket(surveys), "cd_chamado", "left"))
    ref = F.coalesce(F.col("dh_inicio"), F.col("dt_ingestion"))
    negative = (F.col("tm_espera") > R.NEGATIVE_WAIT_SECONDS) | (F.col("nu_nota") <= R.NEGATIVE_SCORE_MAX)
    return j.select(
        K.surrogate("cd_cliente", "cd_motivo", "cd_canal", "cd_atendente", "cd_chamado").alias("pk"),
        "cd_cliente", "cd_motivo", "cd_canal", "cd_atendente", "cd_chamado",
        F.to_date(ref).alias("dt_referencia"),
        F.hour(ref).cast("smallint").alias("nu_hora_dia"),
        F.coalesce("tm_espera", F.lit(0)).cast("bigint").alias("val_tempo_espera"),
        F.coalesce("tm_duracao", F.lit(0)).cast("bigint").alias("val_tempo_atendimento"),
        F.coalesce("vl_custo_total", F.lit(0)).cast(MONEY_SUM).alias("val_custo"),
        F.col("nu_nota").cast("smallint").alias("val_nota_csat"),
        F.when(negative, F.lit(1)).otherwise(F.lit(0)).cast("smallint").alias("fl_experiencia_negativa"),
        F.when(F.col("st_resolvido"), F.lit(1)).otherwise(F.lit(0)).cast("smallint").alias("st_resolvido"))


#: Empty right rows among which a fan-out deals the left rows without a match.
UNMATCHED = 64


def _left_fanout(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """``left LEFT JOIN right`` for a right side that may hold a hot key.

    Written as an inner join, whose both sides AQE can split where a partition
    is skewed (the right side of a left outer join cannot be split), and with
    ``left`` in it once: rows whose key the right side lacks, told by its distinct keys,
    are joined to one of ``UNMATCHED`` empty right rows instead. Same rows as the outer join.
    """
    others = [f for f in right.schema.fields if f.name != key]
    right = right.filter(F.col(key).isNotNull())
    found = left.join(right.select(key, F.col(key).alias("_found")).distinct(), key, "left")
    salt = F.when(F.col("_found").isNull(), F.pmod(F.xxhash64(*left.columns), F.lit(UNMATCHED))).otherwise(0)
    empty = right.sparkSession.range(UNMATCHED).select(
        F.lit(None).cast(right.schema[key].dataType).alias("_key"), F.col("id").alias("_row"), *(F.lit(None).cast(f.dataType).alias(f.name) for f in others))
    rows = right.select(F.col(key).alias("_key"), F.lit(0).cast("long").alias("_row"), *(f.name for f in others)).unionByName(empty)
    return (found.withColumn("_salt", salt.cast("long"))
            .join(rows, F.col("_found").eqNullSafe(F.col("_key")) & (F.col("_salt") == F.col("_row")), "inner")
            .select(*left.columns, *(f.name for f in others)))


def fact_service_fanout(tickets: DataFrame, times: DataFrame, costs: DataFrame, surveys: DataFrame) -> DataFrame:
    """Service fact as the source has it: every cost and every survey row joined
    as is, so a ticket with n costs and m surveys yields n x m rows, under the
    source's key (kept for parity; ``fact_service`` is the de-duplicated fact)."""
    j = tickets.join(times.select("cd_chamado", "dh_inicio"), "cd_chamado", "left")
    j = _left_fanout(j, costs.select("cd_chamado", "vl_custo"), "cd_chamado")
    j = _left_fanout(j, surveys.select("cd_chamado", "nu_nota"), "cd_chamado")
    ref = F.coalesce(F.col("dh_inicio"), F.col("dt_ingestion"))
    negative = (F.col("tm_espera") > R.NEGATIVE_WAIT_SECONDS) | (F.col("nu_nota") <= R.NEGATIVE_SCORE_MAX)
    return j.select(
        K.surrogate("cd_cliente", "cd_motivo", "cd_canal", "cd_atendente", "cd_chamado", sep="", null="0").alias("pk"),
        "cd_cliente", "cd_motivo", "cd_canal", "cd_atendente", "cd_chamado",
        F.to_date(ref).alias("dt_referencia"),
        F.hour(ref).cast("smallint").alias("nu_hora_dia"),
        F.coalesce("tm_espera", F.lit(0)).cast("bigint").alias("val_tempo_espera"),
        F.coalesce("tm_duracao", F.lit(0)).cast("bigint").alias("val_tempo_atendimento"),
        F.coalesce("vl_custo", F.lit(0)).cast("decimal(12,10)").alias("val_custo"),
        F.col("nu_nota").cast("smallint").alias("val_nota_csat"),
        F.when(negative, F.lit(1)).otherwise(F.lit(0)).cast("smallint").alias("fl_experiencia_negativa"),
        F.when(F.col("st_resolvido"), F.lit(1)).otherwise(F.lit(0)).cast("smallint").alias("st_resolvido"))


def fact_agent_fanout(tickets: DataFrame, surveys: DataFrame) -> DataFrame:
    """Agent fact as the source has it: tickets joined to every survey row, under the source's key."""
    j = _left_fanout(tickets.filter(F.col("cd_atendente").isNotNull()),
                     surveys.select("cd_chamado", "nu_nota"), "cd_chamado")
    g = j.groupBy("cd_atendente").agg(
        F.count(F.lit(1)).alias("qtd_chamados_atendidos"),
        F.sum("tm_duracao").cast("bigint").alias("val_tempo_trabalhado_seg"),
        F.sum("nu_nota").alias("_s"), F.count("nu_nota").alias("_n"))
    return g.select(
        F.md5(F.col("cd_atendente").cast("string")).alias("pk_performance"),
        "cd_atendente", "qtd_chamados_atendidos", "val_tempo_trabalhado_seg",
        mean_2dp("_s", "_n").alias("val_nota_media"))


def fact_cost(tickets: DataFrame, costs: DataFrame) -> DataFrame:
    """One row per valid cost of a valid ticket (inner join)."""
    c = costs.select("cd_custo", "cd_chamado", "vl_custo")
    t = tickets.select("cd_chamado", "cd_motivo", "cd_canal", "dt_ingestion")
    return c.join(t, "cd_chamado", "inner").select(
        K.surrogate("cd_chamado", "cd_custo").alias("pk_custo"),
        "cd_custo", "cd_chamado", "cd_motivo", "cd_canal",
        F.col("vl_custo").alias("val_custo_total"),
        F.to_date("dt_ingestion").alias("dt_referencia"))


def fact_cost_source_key(tickets: DataFrame, costs: DataFrame) -> DataFrame:
    """The cost fact under the source's own key, md5 of ticket id and 'CUSTO': the costs of one ticket share it."""
    return fact_cost(tickets, costs).withColumn("pk_custo", F.md5(F.concat(F.col("cd_chamado").cast("string"), F.lit("CUSTO"))))


def _served(tickets: DataFrame, surveys: DataFrame) -> DataFrame:
    """Tickets handled by a person (agent not NULL) with their survey score."""
    return (tickets.filter(F.col("cd_atendente").isNotNull())
                   .join(survey_per_ticket(surveys), "cd_chamado", "left"))


def fact_agent(tickets: DataFrame, surveys: DataFrame) -> DataFrame:
    """All-time agent performance (one row per agent)."""
    g = _served(tickets, surveys).groupBy("cd_atendente").agg(
        F.count(F.lit(1)).alias("qtd_chamados_atendidos"),
        F.sum("tm_duracao").cast("bigint").alias("val_tempo_trabalhado_seg"),
        F.sum("nu_nota").alias("_s"), F.count("nu_nota").alias("_n"))
    return g.select(
        F.md5(F.col("cd_atendente").cast("string")).alias("pk_performance"),
        "cd_atendente", "qtd_chamados_atendidos", "val_tempo_trabalhado_seg",
        mean_2dp("_s", "_n").alias("val_nota_media"))


def mean_2dp(total: str, n: str) -> Column:
    """sum/n rounded half-up to 2 places, in exact integer arithmetic
    (no binary-double rounding surprises), as DECIMAL(3,2)."""
    s, c = F.col(total).cast("bigint"), F.col(n).cast("bigint")
    cents = F.when(c > 0, F.call_function("div", s * 200 + c, c * 2))
    return (cents.cast("decimal(20,0)") / 100).cast("decimal(3,2)")


def fact_cost_agg(fact_cost_df: DataFrame) -> DataFrame:
    """Documented cost fact: by reason, channel and date."""
    return fact_cost_df.groupBy("cd_motivo", "cd_canal", "dt_referencia").agg(
        F.sum("val_custo_total").cast(MONEY_SUM).alias("val_custo_total"),
        F.count(F.lit(1)).alias("qtd_custos"),
        F.round(F.avg(F.col("val_custo_total").cast("double")), 6).alias("val_custo_medio"))


def fact_agent_daily(tickets: DataFrame, times: DataFrame, surveys: DataFrame) -> DataFrame:
    """Documented agent fact: per agent and day, with resolution rate."""
    s = _served(tickets, surveys).join(times.select("cd_chamado", "dh_inicio"), "cd_chamado", "left")
    day = F.to_date(F.coalesce(F.col("dh_inicio"), F.col("dt_ingestion")))
    g = s.groupBy("cd_atendente", day.alias("dt_referencia")).agg(
        F.count(F.lit(1)).alias("qtd_chamados_atendidos"),
        F.sum("tm_duracao").cast("bigint").alias("val_tempo_trabalhado_seg"),
        F.round(F.avg("nu_nota"), 6).alias("val_nota_media"),
        F.count_if(F.col("st_resolvido")).alias("qtd_resolvidos"))
    return g.withColumn("pct_resolvidos",
                        F.round(F.col("qtd_resolvidos") * 100.0 / F.col("qtd_chamados_atendidos"), 6))
