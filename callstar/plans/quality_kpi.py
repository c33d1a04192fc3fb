"""Data-quality KPIs: rates, SLA status, error histogram, batch-over-batch
growth, recurrence, time-to-fix, reconciliation and freshness.

All are aggregates over flagged frames; windows (lag) run only over the
per-batch aggregated rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from callstar.functions import normalize as N
from callstar.functions import rules as R
from callstar.operators import quality as Q
from callstar.plans import oracle as O
from callstar.plans import silver as S
from callstar.plans.lake import Lake
from callstar.sources.batches import latest_batch

_SILVER_SQL = [("tb_atendente", "f_agents", "br_agents"), ("tb_canal", "f_channels", "br_channels"),
               ("tb_cliente", "f_clients", "br_clients"), ("tb_chamado_log", "f_times", "br_ticket_times"),
               ("tb_custo_chamado", "f_costs", "br_costs"), ("tb_motivo", "f_reasons", "br_reasons"),
               ("tb_pesquisa", "f_surveys", "br_surveys"), ("tb_chamado", "f_tickets", "br_tickets")]
_BRONZE = {"tb_atendente": "l_agents", "tb_canal": "l_channels", "tb_cliente": "l_clients",
           "tb_chamado_log": "l_ticket_times", "tb_custo_chamado": "l_costs", "tb_motivo": "l_reasons",
           "tb_pesquisa": "l_surveys", "tb_chamado": "l_tickets"}


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def quality_rate(lake: Lake) -> DataFrame:
    c = _union([s.counts() for s in lake.all_silver()])
    return c.withColumn("valid_pct", F.round(F.col("valid_rows") * 100.0 / F.col("total_rows"), 6))


def quality_sla(lake: Lake) -> DataFrame:
    q = quality_rate(lake)
    status = (F.when(F.col("valid_pct") < R.SLA_CRITICAL_BELOW, F.lit("CRITICAL"))
               .when(F.col("valid_pct") < R.SLA_WARNING_BELOW, F.lit("WARNING"))
               .otherwise(F.lit("OK")))
    return q.select("table_name", "valid_pct", "rejected_rows", status.alias("sla_status"),
                    (F.col("rejected_rows") > R.SLA_INVESTIGATE_REJECTS).alias("investigate"))


def error_histogram(lake: Lake) -> DataFrame:
    t = lake.tickets
    return (t.flagged.groupBy(Q.first_failure(t.rules).alias("first_error"))
                     .agg(F.count(F.lit(1)).alias("n_rows")))


def client_history(lake: Lake) -> S.Silver:
    return S.silver_client(lake.bronze("b_clients"), history=True)


def reject_growth(lake: Lake) -> DataFrame:
    h = client_history(lake).flagged
    per_batch = h.groupBy("dt_ingestion").agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col(Q.VERDICT) != Q.OK).alias("rejected_rows"))
    prev = F.lag("rejected_rows").over(Window.orderBy("dt_ingestion"))
    return per_batch.select(
        F.to_date("dt_ingestion").alias("batch_day"), "total_rows", "rejected_rows",
        prev.alias("prev_rejected_rows"),
        F.round(F.col("rejected_rows") / prev, 6).alias("growth_ratio"),
        (F.col("rejected_rows") > prev * R.SLA_GROWTH_FACTOR).alias("growth_alert"))


def reject_recurrence(lake: Lake) -> DataFrame:
    h = client_history(lake).flagged
    g = h.groupBy("cd_cliente").agg(
        F.count_distinct(F.when(F.col(Q.VERDICT) != Q.OK, F.col("dt_ingestion"))).alias("n_batches_rejected"))
    return g.filter(F.col("n_batches_rejected") >= 2)


def time_to_fix(lake: Lake) -> DataFrame:
    """Per key: first rejected batch, first later batch where it is valid."""
    h = client_history(lake).flagged.select("cd_cliente", "dt_ingestion", Q.VERDICT)
    bad = F.when(F.col(Q.VERDICT) != Q.OK, F.col("dt_ingestion"))
    good = F.when(F.col(Q.VERDICT) == Q.OK, F.col("dt_ingestion"))
    g = h.groupBy("cd_cliente").agg(F.min(bad).alias("first_rejected"), F.collect_set(good).alias("valid_in"))  # one stamp per batch
    fixed = g.withColumn("first_fixed", F.array_min(F.filter("valid_in", lambda t: t > F.col("first_rejected"))))
    fixed = fixed.filter(F.col("first_fixed").isNotNull() & F.col("cd_cliente").isNotNull())
    return fixed.select("cd_cliente", F.to_date("first_rejected").alias("first_rejected"),
                        F.to_date("first_fixed").alias("first_fixed"),
                        F.datediff(F.col("first_fixed"), F.col("first_rejected")).alias("days_to_fix"))


def negative_duration_check(lake: Lake) -> DataFrame:
    t = lake.tickets.valid()
    return t.agg(
        F.count(F.lit(1)).alias("n_tickets"),
        F.count_if(F.col("tm_espera") < 0).alias("n_negative_wait"),
        F.count_if(F.col("tm_duracao") < 0).alias("n_negative_duration"),
        F.count_if(F.col("tm_espera").isNull()).alias("n_missing_times"))


def client_checks_ext(lake: Lake) -> DataFrame:
    f = lake.clients.flagged
    return f.select("cd_cliente", F.col("cd_cliente").isNotNull().alias("flag_id_valido"),
                    (F.col("nm_cliente").isNotNull() & (F.trim("nm_cliente") != "")).alias("flag_nome_valido"),
                    (F.col("nu_idade") >= 0).alias("flag_idade_valida"),
                    Q.VERDICT)


#: Raw key of each table: what one silver row stands for.
_RAW_KEYS = {"tb_atendente": "id_agent", "tb_canal": "channel_name", "tb_cliente": "id_client", "tb_chamado_log": "id_ticket",
             "tb_custo_chamado": "id_cost", "tb_motivo": "id_reason", "tb_pesquisa": "id_survey", "tb_chamado": "id_ticket"}
_NO_KEY = "<null>"


def _raw_key(table: str) -> Column:
    raw = _RAW_KEYS[table]
    if table == "tb_canal":
        key = N.canonical_channel(raw)
    elif table == "tb_cliente":
        key = F.col(raw).cast("string")
    else:
        key = N.to_number(raw, "bigint").cast("string")
    return F.coalesce(key, F.lit(_NO_KEY))


def reconcile(silver: list[S.Silver], bronze: dict[str, DataFrame]) -> DataFrame:
    """Rows of each layer per table. ``balanced``: silver, valid and rejected, has exactly one row
    for each distinct raw key, counted in bronze on its own (NULL is one key)."""
    parts = []
    for s in silver:
        counted = bronze[s.name].agg(F.count(F.lit(1)).alias("bronze_rows"), F.count_distinct(_raw_key(s.name)).alias("bronze_keys"))
        parts.append(counted.select(F.lit(s.name).alias("table_name"), "bronze_rows", "bronze_keys",
                                    *(F.lit(None).cast("bigint").alias(c) for c in ("valid_rows", "rejected_rows"))))
        parts.append(s.counts().select("table_name", *(F.lit(None).cast("bigint").alias(c) for c in ("bronze_rows", "bronze_keys")),
                                       "valid_rows", "rejected_rows"))
    u = _union(parts).groupBy("table_name").agg(*(F.max(c).alias(c) for c in ("bronze_rows", "bronze_keys", "valid_rows", "rejected_rows")))
    return u.select("table_name", "bronze_rows", "valid_rows", "rejected_rows",
                    (F.col("bronze_rows") - F.col("bronze_keys")).alias("duplicates_dropped"),
                    (F.col("bronze_keys") == F.col("valid_rows") + F.col("rejected_rows")).alias("balanced"),
                    (F.col("bronze_rows") > 0).alias("bronze_loaded"))


def reconcile_layers(lake: Lake) -> DataFrame:
    return reconcile(lake.all_silver(), {t: latest_batch(lake.bronze(b)) for t, b in _BRONZE.items()})


def freshness_lag(lake: Lake) -> DataFrame:
    t = lake.times.valid()
    lag = F.unix_timestamp("dt_ingestion") - F.unix_timestamp("dh_fim")
    return t.agg(F.min(lag).alias("min_lag_sec"), F.max(lag).alias("max_lag_sec"),
                 F.round(F.avg(lag), 6).alias("avg_lag_sec"), F.count(F.lit(1)).alias("n_rows"))


# -- oracle SQL ------------------------------------------------------------------
def _counts_sql() -> str:
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS total_rows, count(*) FILTER (WHERE flag_qualidade = 'OK') AS valid_rows, "
        f"count(*) FILTER (WHERE flag_qualidade <> 'OK') AS rejected_rows FROM {f}" for t, f, _ in _SILVER_SQL)


_RATE_SQL = f"SELECT *, {O.rate('valid_rows', 'total_rows')} AS valid_pct FROM ({_counts_sql()}) c"
_TICKET_LABELS = ["missing id", "missing client", "unknown reason", "unknown channel"]
_HIST = O.flagged(O.client_base("bb_clients"), "cd_cliente, dt_ingestion", [], O.CLIENT_FLAGS)


def _key_sql(table: str) -> str:
    raw = _RAW_KEYS[table]
    if table == "tb_canal":
        return O.canon(raw)
    return f"CAST({raw} AS VARCHAR)" if table == "tb_cliente" else f"CAST({O.num(raw, 'BIGINT')} AS VARCHAR)"


def register_all(register) -> None:
    fs = [f for _, f, _ in _SILVER_SQL]
    register("quality_rate", "Q-11 IO-15", fs, _RATE_SQL)(quality_rate)
    register("quality_sla", "Q-12", fs,
             f"SELECT table_name, valid_pct, rejected_rows, CASE WHEN valid_pct < {R.SLA_CRITICAL_BELOW} THEN 'CRITICAL' "
             f"WHEN valid_pct < {R.SLA_WARNING_BELOW} THEN 'WARNING' ELSE 'OK' END AS sla_status, "
             f"rejected_rows > {R.SLA_INVESTIGATE_REJECTS} AS investigate FROM ({_RATE_SQL}) q")(quality_sla)
    first = "CASE " + " ".join(f"WHEN NOT coalesce({n}, false) THEN '{lab}'"
                               for (n, _), lab in zip(O.TICKET_FLAGS, _TICKET_LABELS)) + " ELSE 'none' END"
    register("error_histogram", "Q-13 A-10 SL-1", ["f_tickets"],
             f"SELECT {first} AS first_error, count(*) AS n_rows FROM f_tickets GROUP BY 1")(error_histogram)
    register("reject_growth", "W-2 Q-12", ["bb_clients"],
             f"SELECT {O.dfmt('dt_ingestion')} AS batch_day, total_rows, rejected_rows, "
             f"lag(rejected_rows) OVER (ORDER BY dt_ingestion) AS prev_rejected_rows, "
             f"round(rejected_rows / lag(rejected_rows) OVER (ORDER BY dt_ingestion), 6) AS growth_ratio, "
             f"rejected_rows > lag(rejected_rows) OVER (ORDER BY dt_ingestion) * {R.SLA_GROWTH_FACTOR} AS growth_alert "
             f"FROM (SELECT dt_ingestion, count(*) AS total_rows, count(*) FILTER (WHERE flag_qualidade <> 'OK') "
             f"AS rejected_rows FROM ({_HIST}) h GROUP BY dt_ingestion) g")(reject_growth)
    register("reject_recurrence", "W-4 Q-15", ["bb_clients"],
             f"SELECT cd_cliente, count(DISTINCT CASE WHEN flag_qualidade <> 'OK' THEN dt_ingestion END) AS n_batches_rejected "
             f"FROM ({_HIST}) h GROUP BY cd_cliente HAVING n_batches_rejected >= 2")(reject_recurrence)
    register("time_to_fix", "Q-14", ["bb_clients"],
             f"WITH h AS ({_HIST}), b AS (SELECT cd_cliente, min(dt_ingestion) AS first_rejected FROM h "
             f"WHERE flag_qualidade <> 'OK' GROUP BY 1) "
             f"SELECT h.cd_cliente, {O.dfmt('b.first_rejected')} AS first_rejected, {O.dfmt('min(h.dt_ingestion)')} AS first_fixed, "
             f"CAST(date_diff('day', CAST(b.first_rejected AS DATE), CAST(min(h.dt_ingestion) AS DATE)) AS INTEGER) AS days_to_fix "
             f"FROM h JOIN b ON h.cd_cliente = b.cd_cliente WHERE h.flag_qualidade = 'OK' AND h.dt_ingestion > b.first_rejected "
             f"GROUP BY h.cd_cliente, b.first_rejected")(time_to_fix)
    register("negative_duration_check", "Q-16", ["v_tickets"],
             "SELECT count(*) AS n_tickets, count(*) FILTER (WHERE tm_espera < 0) AS n_negative_wait, "
             "count(*) FILTER (WHERE tm_duracao < 0) AS n_negative_duration, "
             "count(*) FILTER (WHERE tm_espera IS NULL) AS n_missing_times FROM v_tickets")(negative_duration_check)
    register("client_checks_ext", "Q-17", ["f_clients"],
             "SELECT cd_cliente, cd_cliente IS NOT NULL AS flag_id_valido, nm_cliente IS NOT NULL AND trim(nm_cliente) <> '' AS flag_nome_valido, "
             "nu_idade >= 0 AS flag_idade_valida, flag_qualidade FROM f_clients")(client_checks_ext)
    recon = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, (SELECT count(*) FROM {O.latest(b)} x) AS bronze_rows, "
        f"(SELECT count(DISTINCT coalesce({_key_sql(t)}, '{_NO_KEY}')) FROM {O.latest(b)} x) AS bronze_keys, "
        f"count(*) FILTER (WHERE flag_qualidade = 'OK') AS valid_rows, "
        f"count(*) FILTER (WHERE flag_qualidade <> 'OK') AS rejected_rows, count(*) AS total_rows FROM {f}"
        for t, f, b in _SILVER_SQL)
    register("reconcile_layers", "Q-18 IO-15 A-3", fs + [b for _, _, b in _SILVER_SQL],
             f"SELECT table_name, bronze_rows, valid_rows, rejected_rows, bronze_rows - bronze_keys AS duplicates_dropped, "
             f"bronze_keys = valid_rows + rejected_rows AS balanced, "
             f"bronze_rows > 0 AS bronze_loaded FROM ({recon}) r")(reconcile_layers)
    lag = "CAST(epoch(dt_ingestion) - epoch(dh_fim) AS BIGINT)"
    register("freshness_lag", "Q-19", ["v_times"],
             f"SELECT min({lag}) AS min_lag_sec, max({lag}) AS max_lag_sec, {O.r6(f'avg({lag})')} AS avg_lag_sec, "
             f"count(*) AS n_rows FROM v_times")(freshness_lag)
