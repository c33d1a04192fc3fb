"""Registered queries: one Spark builder and one oracle SQL per operator.

Each Spark builder takes ``(spark, sf_dir)`` and returns a DataFrame over the
whole input tables. ``report`` renders timestamps/dates as text and money as
DOUBLE so results compare across engines; the oracle SQL does the same.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callstar.functions import keys as K
from callstar.functions import normalize as N
from callstar.functions import rules as R
from callstar.operators import quality as Q
from callstar.operators.dedup import drop_duplicates_any, keep_latest
from callstar.operators.lookup import BROADCAST_MAX_BYTES, fk_flag, lookup, orphans
from callstar.operators.upsert import upsert
from callstar.plans import gold as G
from callstar.plans import kpi
from callstar.plans import oracle as O
from callstar.plans import quality_kpi as QK
from callstar.plans import silver as S
from callstar.plans.lake import Lake, StoredLake
from callstar.session import apply_conf, checkpoint_root
from callstar.sources import sinks
from callstar.sources.batches import as_of, batch_diff, latest_batch
from callstar.sources.ingest import DEFAULT_BATCH, ingest_status, stamp
from callstar.sources.landing import LANDING


def report(df: DataFrame) -> DataFrame:
    """Engine-neutral rendering of timestamps, dates and decimals."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        cols.append(c.alias(f.name))
    return df.select(*cols)


@dataclass
class Entry:
    build: Callable[[Lake], DataFrame]
    deps: list[str] | None = None
    sql: str | None = None
    ids: str = ""
    only: dict[str, str] | None = None


REGISTRY: dict[str, Entry] = {}


def register(name: str, ids: str, deps: list[str] | None = None, sql: str | None = None, only: dict[str, str] | None = None):
    def deco(fn):
        REGISTRY[name] = Entry(fn, deps, sql, ids, only)
        return fn
    return deco


def lake_for(spark: SparkSession, sf_dir: str) -> Lake:
    """A lazily built star schema over the files that are there now."""
    return Lake(spark, sf_dir)


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_conf(spark)
    return report(REGISTRY[name].build(lake_for(spark, sf_dir)))


def oracle(name: str) -> str | None:
    e = REGISTRY[name]
    if e.sql is None:
        return None
    return O.with_ctes(e.deps or [], e.sql, e.only)


TS = O.tsfmt
DF = O.dfmt

# ---------------------------------------------------------------------------
# sources: stamp, ingest, batches
# ---------------------------------------------------------------------------


@register("ingest_stamp", "IO-1 IO-5 PF-2 IO-9", [],
          f"SELECT *, {TS(O.BATCH)} AS ingestion_timestamp, 'landing.supplier' AS origem FROM supplier")
def _ingest_stamp(lake: Lake):
    return stamp(lake.table("supplier"), DEFAULT_BATCH, "landing.supplier")


@register("ingest_status", "IO-13", list(LANDING),
          " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS row_count, 'LOADED' AS status FROM {n}"
                             for n in LANDING))
def _ingest_status(lake: Lake):
    return ingest_status({n: lake.landing(n) for n in LANDING})


_BCOLS = "id_client, client_name, email, region, age"


@register("latest_batch", "PF-3 A-1", ["bb_clients"],
          f"SELECT {_BCOLS}, {DF('batch_day')} AS batch_day, {TS('ingestion_timestamp')} AS ingestion_timestamp, origem "
          f"FROM {O.latest('bb_clients')} x")
def _latest_batch(lake: Lake):
    return latest_batch(lake.bronze("b_clients"))


@register("latest_batch_fallback", "PF-4", ["l_clients"], "SELECT * FROM l_clients")
def _latest_batch_fallback(lake: Lake):
    return latest_batch(lake.landing("l_clients"))


@register("asof_batch", "IO-18", ["bb_clients"],
          f"SELECT {_BCOLS}, {DF('batch_day')} AS batch_day, {TS('ingestion_timestamp')} AS ingestion_timestamp, origem "
          f"FROM bb_clients WHERE ingestion_timestamp <= TIMESTAMP '2024-02-01 00:00:00' "
          f"QUALIFY row_number() OVER (PARTITION BY id_client ORDER BY ingestion_timestamp DESC) = 1")
def _asof_batch(lake: Lake):
    return as_of(lake.bronze("b_clients"), ["id_client"], "2024-02-01 00:00:00")


_DIFF_COLS = ["client_name", "email", "region", "age"]
_diff_sel = ", ".join(f"CASE WHEN n.id_client IS NULL THEN o.{c} ELSE n.{c} END AS {c}" for c in _DIFF_COLS)
_diff_chg = " OR ".join(f"o.{c} IS DISTINCT FROM n.{c}" for c in _DIFF_COLS)


@register("asof_two_batches", "IO-18", ["bb_clients"],
          f"SELECT {_BCOLS}, {DF('batch_day')} AS batch_day, {TS('ingestion_timestamp')} AS ingestion_timestamp, origem "
          f"FROM bb_clients WHERE ingestion_timestamp <= TIMESTAMP '2024-02-03 00:00:00' "
          f"QUALIFY row_number() OVER (PARTITION BY id_client ORDER BY ingestion_timestamp DESC, client_name DESC NULLS LAST, email DESC NULLS LAST, region DESC NULLS LAST, age DESC NULLS LAST) = 1")
def _asof_two_batches(lake: Lake):
    """Both batches are visible: the latest row of each key wins."""
    return as_of(lake.bronze("b_clients"), ["id_client"], "2024-02-03 00:00:00")


@register("batch_diff", "IO-17", ["b_clients"],
          f"SELECT * FROM (SELECT coalesce(n.id_client, o.id_client) AS id_client, "
          f"CASE WHEN o.id_client IS NULL THEN 'INSERT' WHEN n.id_client IS NULL THEN 'DELETE' "
          f"WHEN {_diff_chg} THEN 'UPDATE' END AS change_type, {_diff_sel} "
          f"FROM (SELECT DISTINCT {_BCOLS} FROM b_clients WHERE batch_day = DATE '2024-02-01') o "
          f"FULL OUTER JOIN (SELECT DISTINCT {_BCOLS} FROM b_clients WHERE batch_day = DATE '2024-02-02') n "
          f"ON o.id_client = n.id_client) d WHERE change_type IS NOT NULL")
def _batch_diff(lake: Lake):
    b = lake.landing("b_clients")
    cols = ["id_client", *_DIFF_COLS]

    def day(d):
        return keep_latest(b.filter(F.col("batch_day") == F.lit(d).cast("date")).select(*cols), ["id_client"], [])
    return batch_diff(day("2024-02-01"), day("2024-02-02"), ["id_client"], _DIFF_COLS)


def _client_batch_sql(day: str) -> str:
    src = f"(SELECT * FROM bb_clients WHERE ingestion_timestamp = TIMESTAMP '{day} 00:00:00')"
    return O.flagged(O.client_base(src), "cd_cliente", [], O.CLIENT_FLAGS)


_CLIENT_COLS = ", ".join(S.CLIENT_COLS).replace("dt_ingestion", TS("dt_ingestion") + " AS dt_ingestion")


@register("reprocess_batch", "IO-19 J-7", ["bb_clients"],
          f"SELECT {_CLIENT_COLS} FROM ({_client_batch_sql('2024-02-01')}) f WHERE flag_qualidade = 'OK'")
def _reprocess_batch(lake: Lake):
    return S.silver_client(lake.bronze("b_clients"), batch="2024-02-01 00:00:00").valid()


@register("upsert_clients", "J-7 IO-12", ["bb_clients"],
          f"WITH t AS (SELECT {', '.join(S.CLIENT_COLS)} FROM ({_client_batch_sql('2024-02-01')}) f WHERE flag_qualidade = 'OK'), "
          f"s AS (SELECT {', '.join(S.CLIENT_COLS)} FROM ({_client_batch_sql('2024-02-02')}) f WHERE flag_qualidade = 'OK') "
          f"SELECT {_CLIENT_COLS} FROM (SELECT * FROM t WHERE cd_cliente IS NULL OR NOT EXISTS "
          f"(SELECT 1 FROM s WHERE s.cd_cliente = t.cd_cliente) UNION ALL SELECT * FROM s) u")
def _upsert_clients(lake: Lake):
    b = lake.bronze("b_clients")
    target = S.silver_client(b, batch="2024-02-01 00:00:00").valid()
    source = S.silver_client(b, batch="2024-02-02 00:00:00").valid()
    return upsert(target, source, ["cd_cliente"])


# ---------------------------------------------------------------------------
# normalisers
# ---------------------------------------------------------------------------


@register("regex_fold_channel", "PF-9 N-6 F-6", ["l_tickets"],
          f"SELECT id_ticket, channel, {O.canon('channel')} AS nm_canal FROM l_tickets")
def _regex_fold_channel(lake: Lake):
    return lake.landing("l_tickets").select("id_ticket", "channel", N.canonical_channel("channel").alias("nm_canal"))


@register("regex_fold_reason", "PF-9 N-7 F-6", ["l_tickets"],
          f"SELECT id_ticket, reason, {O.reason_fix('reason')} AS reason_fixed FROM l_tickets")
def _regex_fold_reason(lake: Lake):
    return lake.landing("l_tickets").select("id_ticket", "reason", N.repair_reason("reason").alias("reason_fixed"))


@register("email_alias_strip", "N-1", ["l_clients"],
          f"SELECT id_client, email, regexp_replace(email, '{R.EMAIL_ALIAS}', '@', 'g') AS ds_email FROM l_clients")
def _email_alias_strip(lake: Lake):
    return lake.landing("l_clients").select("id_client", "email", N.strip_email_alias("email").alias("ds_email"))


@register("money_parse", "N-2 F-7 F-19", ["l_costs"],
          f"SELECT id_cost, cost_text, CAST({O.money('cost_text')} AS DOUBLE) AS vl_custo FROM l_costs")
def _money_parse(lake: Lake):
    return lake.landing("l_costs").select("id_cost", "cost_text", N.money("cost_text").alias("vl_custo"))


@register("dirty_timestamp_parse", "N-3 F-20", ["l_ticket_times"],
          f"SELECT id_ticket, opened_at, {TS(O.ts_parse('opened_at'))} AS dh_abertura, "
          f"{TS(O.ts_parse('started_at'))} AS dh_inicio, {TS(O.ts_parse('finished_at'))} AS dh_fim FROM l_ticket_times")
def _dirty_timestamp_parse(lake: Lake):
    return lake.landing("l_ticket_times").select(
        "id_ticket", "opened_at", N.dirty_timestamp("opened_at").alias("dh_abertura"),
        N.dirty_timestamp("started_at").alias("dh_inicio"), N.dirty_timestamp("finished_at").alias("dh_fim"))


@register("status_map", "N-4 F-10", ["l_channels"],
          f"SELECT seq, channel_status, {O.status('channel_status')} AS st_ativo FROM l_channels")
def _status_map(lake: Lake):
    return lake.landing("l_channels").select("seq", "channel_status", N.status_flag("channel_status").alias("st_ativo"))


@register("yes_no_map", "N-5", ["l_tickets"],
          f"SELECT id_ticket, resolved, {O.yes_no('resolved')} AS st_resolvido FROM l_tickets")
def _yes_no_map(lake: Lake):
    return lake.landing("l_tickets").select("id_ticket", "resolved", N.yes_no("resolved").alias("st_resolvido"))


_RNAME = O.reason_fix("trim(reason_name)")


@register("category_classify", "N-9 N-8 F-8", ["l_reasons"],
          f"SELECT seq, reason_name, {_RNAME} AS ds_motivo, {O.category(_RNAME)} AS ds_categoria FROM l_reasons")
def _category_classify(lake: Lake):
    name = N.repair_reason(F.trim("reason_name"))
    return lake.landing("l_reasons").select("seq", "reason_name", name.alias("ds_motivo"),
                                            N.category(name).alias("ds_categoria"))


@register("criticality_map", "N-10", ["l_reasons"],
          f"SELECT seq, criticality, {O.criticality('criticality')} AS ds_criticidade FROM l_reasons")
def _criticality_map(lake: Lake):
    return lake.landing("l_reasons").select("seq", "criticality", N.criticality("criticality").alias("ds_criticidade"))


@register("blank_to_null_cast", "N-11 F-19", ["l_surveys", "l_tickets"],
          f"SELECT 'survey' AS source, id_survey AS id, score AS raw_value, CAST({O.num('score', 'SMALLINT')} AS BIGINT) AS value "
          f"FROM l_surveys UNION ALL SELECT 'ticket_agent', id_ticket, id_agent, {O.num('id_agent', 'BIGINT')} FROM l_tickets")
def _blank_to_null_cast(lake: Lake):
    s = lake.landing("l_surveys").select(F.lit("survey").alias("source"), F.col("id_survey").alias("id"),
                                         F.col("score").alias("raw_value"),
                                         N.to_number("score", "smallint").cast("bigint").alias("value"))
    t = lake.landing("l_tickets").select(F.lit("ticket_agent").alias("source"), F.col("id_ticket").alias("id"),
                                         F.col("id_agent").alias("raw_value"),
                                         N.to_number("id_agent", "bigint").alias("value"))
    return s.unionByName(t)


@register("pseudonymise", "N-12 F-14 F-5", ["l_clients"],
          f"SELECT {O.sha('id_client')} AS cd_cliente, trim(client_name) AS nm_cliente FROM l_clients")
def _pseudonymise(lake: Lake):
    return lake.landing("l_clients").select(K.pseudonym("id_client").alias("cd_cliente"),
                                            F.trim("client_name").alias("nm_cliente"))


@register("name_hash_key", "N-13 F-16 N-14", ["l_channels"],
          f"SELECT seq, channel_name, {O.key60(O.canon('channel_name'))} AS cd_canal FROM l_channels")
def _name_hash_key(lake: Lake):
    return lake.landing("l_channels").select("seq", "channel_name",
                                             K.key60(N.canonical_channel("channel_name")).alias("cd_canal"))


@register("durations", "N-15 F-21", ["l_ticket_times"],
          f"SELECT id_ticket, CAST(epoch({O.ts_parse('started_at')}) - epoch({O.ts_parse('opened_at')}) AS BIGINT) AS tm_espera, "
          f"CAST(epoch({O.ts_parse('finished_at')}) - epoch({O.ts_parse('started_at')}) AS BIGINT) AS tm_duracao "
          f"FROM l_ticket_times")
def _durations(lake: Lake):
    o, s, f = (N.dirty_timestamp(c) for c in ("opened_at", "started_at", "finished_at"))
    return lake.landing("l_ticket_times").select("id_ticket", N.seconds_between(o, s).alias("tm_espera"),
                                                 N.seconds_between(s, f).alias("tm_duracao"))


@register("letters_only", "N-16 F-27", ["l_tickets"],
          f"SELECT id_ticket, channel, upper(regexp_replace(channel, '{R.NON_LETTERS}', '', 'g')) AS channel_letters "
          f"FROM l_tickets")
def _letters_only(lake: Lake):
    return lake.landing("l_tickets").select("id_ticket", "channel", N.letters_only("channel").alias("channel_letters"))


# ---------------------------------------------------------------------------
# dedup
# ---------------------------------------------------------------------------


@register("dedup_keep_latest", "W-1", ["l_costs"],
          f"SELECT id_cost, id_ticket, cost_text, {TS('tie_1')} AS tie_1, tie_2, tie_3 FROM l_costs "
          f"QUALIFY row_number() OVER (PARTITION BY id_cost ORDER BY tie_1 DESC NULLS LAST, tie_2 DESC NULLS LAST, "
          f"tie_3 DESC NULLS LAST, cost_text DESC NULLS LAST) = 1")
def _dedup_keep_latest(lake: Lake):
    return keep_latest(lake.landing("l_costs"), ["id_cost"], ["tie_1", "tie_2", "tie_3", "cost_text"])


@register("dedup_any", "A-5", ["l_costs"], "SELECT DISTINCT id_cost FROM l_costs")
def _dedup_any(lake: Lake):
    return drop_duplicates_any(lake.landing("l_costs"), ["id_cost"]).select("id_cost")


# ---------------------------------------------------------------------------
# validation and silver tables
# ---------------------------------------------------------------------------

_SILVER = {  # short name: (Lake attribute, oracle CTE, flags, extra audit columns, validate ids, silver ids)
    "agent": ("agents", "f_agents", O.AGENT_FLAGS, [], "Q-1", "T-1"),
    "channel": ("channels", "f_channels", O.CHANNEL_FLAGS, ["st_ativo_raw"], "Q-2", "T-2 N-13 N-14"),
    "client": ("clients", "f_clients", O.CLIENT_FLAGS, [], "Q-3", "T-3 N-12"),
    "ticket_times": ("times", "f_times", O.TIMES_FLAGS, [], "Q-5", "T-4"),
    "cost": ("costs", "f_costs", O.COST_FLAGS, [], "Q-6", "T-5"),
    "reason": ("reasons", "f_reasons", O.REASON_FLAGS, [], "Q-7", "T-6"),
    "survey": ("surveys", "f_surveys", O.SURVEY_FLAGS, [], "Q-8", "T-7"),
    "ticket": ("tickets", "f_tickets", O.TICKET_FLAGS, [], "Q-4", "T-8 J-1 J-2 J-3"),
}
_TS_COLS = {"dt_ingestion", "dh_abertura", "dh_inicio", "dh_fim"}
_MONEY_COLS = {"vl_custo"}


def _sql_cols(cols: list[str]) -> str:
    out = []
    for c in cols:
        if c in _TS_COLS:
            out.append(f"{TS(c)} AS {c}")
        elif c in _MONEY_COLS:
            out.append(f"CAST({c} AS DOUBLE) AS {c}")
        else:
            out.append(c)
    return ", ".join(out)


def _audit(s: S.Silver) -> DataFrame:
    return s.flagged.select(*s.columns, *s.extra_reject_cols, *[r.flag for r in s.rules], Q.VERDICT)


def _make_silver(short: str, attr: str, cte_name: str, flags, extra, q_ids: str, t_ids: str):
    cols = O.SILVER_COLS[attr]
    flag_names = [n for n, _ in flags]
    register(f"validate_{short}", f"{q_ids} PF-5 PF-10 A-5", [cte_name],
             f"SELECT {_sql_cols(cols + extra + flag_names)}, flag_qualidade FROM {cte_name}")(
        lambda lake: _audit(getattr(lake, attr)))
    register(f"silver_{short}", f"{t_ids} IO-2 IO-3 PF-1 PF-3", [cte_name],
             f"SELECT {_sql_cols(cols)} FROM {cte_name} WHERE flag_qualidade = 'OK'")(
        lambda lake: getattr(lake, attr).valid())


for _short, _spec in _SILVER.items():
    _make_silver(_short, *_spec)

_REASON_LABELS = [(n, lab) for (n, _), lab in zip(O.REASON_FLAGS, ["missing id", "blank name", "blank category",
                                                                    "unknown criticality"])]
_reject_text = "concat_ws('; ', " + ", ".join(
    f"CASE WHEN NOT coalesce({n}, false) THEN '{lab}' END" for n, lab in _REASON_LABELS) + ")"


@register("reject_reason_text", "Q-9 F-18 IO-11", ["f_reasons"],
          "SELECT " + ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in O.SILVER_COLS["reasons"] if c != "dt_ingestion")
          + f", CAST({TS('dt_ingestion')} AS VARCHAR) AS dt_ingestion, flag_qualidade, {_reject_text} AS motivo_rejeicao "
          f"FROM f_reasons WHERE flag_qualidade <> 'OK'")
def _reject_reason_text(lake: Lake):
    return S.reason_rejects(lake.reasons)


@register("schema_enforce", "IO-7 PF-1 PF-7 PF-8", ["f_tickets"],
          f"SELECT {_sql_cols(O.SILVER_COLS['tickets'])} FROM f_tickets WHERE flag_qualidade = 'OK'")
def _schema_enforce(lake: Lake):
    from callstar.plans import schemas
    return schemas.enforce(lake.tickets.flagged.filter(F.col(Q.VERDICT) == Q.OK), schemas.SILVER["tb_chamado"])


@register("route_valid_rejects", "Q-10 PF-5 IO-10", ["f_clients"],
          "SELECT cd_cliente, flag_qualidade, CASE WHEN flag_qualidade = 'OK' THEN 'tb_cliente' "
          "ELSE 'tb_cliente_invalidos' END AS destination FROM f_clients")
def _route_valid_rejects(lake: Lake):
    """Written split by verdict and read back from the two sides."""
    path = f"{checkpoint_root(lake.spark)}/route/{uuid.uuid4().hex}"
    valid, rejected = sinks.write_flagged(lake.clients.flagged, path)
    return (valid.select("cd_cliente", F.lit(Q.OK).alias(Q.VERDICT), F.lit("tb_cliente").alias("destination"))
            .unionByName(rejected.select("cd_cliente", F.col(Q.VERDICT), F.lit("tb_cliente_invalidos").alias("destination"))))


_TWO_COLS = ("cd_chamado, cd_cliente, cd_motivo, cd_canal, cd_atendente, val_tempo_espera, val_tempo_atendimento, "
             "CAST(val_custo AS DOUBLE) AS val_custo, val_nota_csat, fl_experiencia_negativa, st_resolvido")


@contextmanager
def _loaded(lake: Lake, days: list[dict[str, DataFrame]]):
    """A warehouse of its own with one daily load a batch; gives the batch stamps."""
    from callstar.plans import daily_load
    spark, key = lake.spark, "callstar.warehouse"
    before = spark.conf.get(key, None)
    spark.conf.set(key, f"{checkpoint_root(spark)}/batches/{uuid.uuid4().hex}")
    stamps = [f"2024-03-0{k + 1} 02:00:00" for k in range(len(days))]
    try:
        for part, stamp_text in zip(days, stamps):
            failed = daily_load.run(spark, part, stamp_text).filter("status = 'FAILED' AND error <> 'no landing table'").collect()
            if failed:
                raise RuntimeError(str(failed))
        yield stamps
    finally:
        spark.conf.set(key, before) if before else spark.conf.unset(key)


#: What comes on the first day; the rest of these tables comes later.
_FIRST_DAY = {"l_tickets": "id_ticket % 3 <> 0", "l_ticket_times": "id_ticket % 2 = 0", "l_costs": "id_ticket % 5 <> 0", "l_surveys": "id_ticket % 7 <> 0"}


def _two_days(lake: Lake) -> list[dict[str, DataFrame]]:
    landing = {n: lake.landing(n) for n in LANDING}
    return [{n: df.filter(_FIRST_DAY[n]) if n in _FIRST_DAY else df for n, df in landing.items()},
            {n: df.filter(f"not coalesce({_FIRST_DAY[n]}, false)") if n in _FIRST_DAY else df for n, df in landing.items()}]


@register("load_two_batches", "IO-9 IO-12 IO-13 T-14", ["ft_service"], f"SELECT {_TWO_COLS} FROM ft_service")
def _load_two_batches(lake: Lake):
    """The stored service fact after two daily loads: later tickets, times, costs and surveys come on the second day."""
    with _loaded(lake, _two_days(lake)):
        return StoredLake(lake.spark).fact_service.selectExpr(*_TWO_COLS.split(", "))


@register("withdraw_batch", "IO-19 IO-18", ["ft_service", "d_client"],
          f"SELECT {_TWO_COLS}, nm_regiao, ds_faixa_etaria FROM ft_service LEFT JOIN d_client USING (cd_cliente)", only=_FIRST_DAY)
def _withdraw_batch(lake: Lake):
    """Two daily loads, the second taken back: the stored star is that of the first day.

    The second day also renames every region and drops a reason's spelling, so
    dimensions, lookups and ticket rows have to come back, not only to go.
    """
    from callstar.plans import replay
    first, second = _two_days(lake)
    second = second | {"l_clients": second["l_clients"].withColumn("region", F.lit("Elsewhere")),
                       "l_reasons": second["l_reasons"].withColumn("reason_name", F.when(F.col("id_reason") == 5, F.lit("Another debt")).otherwise(F.col("reason_name"))),
                       "l_tickets": second["l_tickets"].unionByName(first["l_tickets"].filter("id_ticket % 4 = 0").withColumn("id_agent", F.lit("1")))}
    with _loaded(lake, [first, second]) as stamps:
        failed = replay.withdraw(lake.spark, {n: df.schema for n, df in first.items()}, stamps[1]).filter("status = 'FAILED'").collect()
        if failed:
            raise RuntimeError(str(failed))
        star = StoredLake(lake.spark)
        return (star.fact_service.join(star.dim_client.select("cd_cliente", "nm_regiao", "ds_faixa_etaria"), "cd_cliente", "left")
                .selectExpr(*_TWO_COLS.split(", "), "nm_regiao", "ds_faixa_etaria"))


@register("kept_aggregates", "A-11 A-12 IO-12", ["ft_cost", "ft_service"],
          f"SELECT 'cost' AS fact, cd_motivo AS key, cd_canal AS other_key, count(*) AS n_rows, CAST(sum(val_custo_total) AS DOUBLE) AS total, "
          f"CAST(NULL AS BIGINT) AS score_sum, CAST(NULL AS BIGINT) AS n_scores, CAST(NULL AS BIGINT) AS n_resolved FROM ft_cost GROUP BY cd_motivo, cd_canal "
          f"UNION ALL SELECT 'agent', cd_atendente, CAST(NULL AS BIGINT), count(*), CAST(sum(val_tempo_atendimento) AS DOUBLE), "
          f"CAST(coalesce(sum(val_nota_csat), 0) AS BIGINT), count(val_nota_csat), CAST(sum(st_resolvido) AS BIGINT) "
          f"FROM ft_service WHERE cd_atendente IS NOT NULL GROUP BY cd_atendente")
def _kept_aggregates(lake: Lake):
    """The stored cost and agent-day aggregates after three daily loads, kept up by the differences of each, summed over days.

    The third day brings tickets again with another agent and channel than the
    second day had, so groups lose rows as well as gain them. (A batch's day is
    part of the date of some tickets, so the dates themselves are left to the tests.)
    """
    from callstar.plans import aggregates as A
    first, second = _two_days(lake)
    again = {"l_tickets": first["l_tickets"].filter("id_ticket % 2 = 0")}
    wrong = (again["l_tickets"].filter("channel <> 'carrier pigeon'").withColumn("id_agent", F.lit("3"))
             .withColumn("channel", F.expr("CASE WHEN channel = 'u.r.a.' THEN 'chat bot' ELSE 'u.r.a.' END")))
    second = second | {"l_tickets": second["l_tickets"].unionByName(wrong)}
    with _loaded(lake, [first, second, again]):
        cost = A.COST.read(lake.spark).groupBy("cd_motivo", "cd_canal").agg(F.sum("qtd_custos").alias("n"), F.sum("val_custo_total").alias("total"))
        agent = A.AGENT_DAILY.read(lake.spark).groupBy("cd_atendente").agg(
            F.sum("qtd_chamados_atendidos").alias("n"), *(F.sum(c).alias(c) for c in ("val_tempo_trabalhado_seg", "soma_notas", "qtd_notas", "qtd_resolvidos")))
        none = F.lit(None).cast("bigint")
        return cost.select(F.lit("cost").alias("fact"), F.col("cd_motivo").alias("key"), F.col("cd_canal").alias("other_key"), F.col("n").alias("n_rows"),
                           F.col("total").cast("double").alias("total"), none.alias("score_sum"), none.alias("n_scores"), none.alias("n_resolved")).unionByName(
            agent.select(F.lit("agent").alias("fact"), F.col("cd_atendente").alias("key"), none.alias("other_key"), F.col("n").alias("n_rows"),
                         F.col("val_tempo_trabalhado_seg").cast("double").alias("total"), F.col("soma_notas").alias("score_sum"),
                         F.col("qtd_notas").alias("n_scores"), F.col("qtd_resolvidos").alias("n_resolved")))


@register("upsert_null_keys", "J-7 IO-12", [],
          "WITH t AS (SELECT CASE WHEN s_suppkey % 5 <> 0 THEN s_suppkey END AS k, s_name AS v FROM supplier), "
          "n AS (SELECT CASE WHEN s_suppkey % 7 <> 0 THEN s_suppkey + 3 END AS k, concat('new ', s_name) AS v FROM supplier WHERE s_suppkey % 3 = 0) "
          "SELECT k, v FROM t WHERE k IS NULL OR k NOT IN (SELECT k FROM n WHERE k IS NOT NULL) UNION ALL SELECT k, v FROM n")
def _upsert_null_keys(lake: Lake):
    """Stored upsert: rows without key are kept on both sides and never match."""
    s = lake.table("supplier")
    target = s.selectExpr("CASE WHEN s_suppkey % 5 <> 0 THEN s_suppkey END AS k", "s_name AS v")
    source = s.filter("s_suppkey % 3 = 0").selectExpr("CASE WHEN s_suppkey % 7 <> 0 THEN s_suppkey + 3 END AS k", "concat('new ', s_name) AS v")
    path = f"{checkpoint_root(lake.spark)}/null_keys/{uuid.uuid4().hex}"
    for batch in (target, source):
        out = sinks.upsert_partitioned(batch, path, ["k"], sinks.BUCKET_COL, sinks.hash_bucket(["k"], 8),
                                       key_determines_partition=True, layout="hash k 8")
    return out.drop(sinks.BUCKET_COL)


# ---------------------------------------------------------------------------
# rules against expected values written out by hand
# ---------------------------------------------------------------------------


def _cases(n: str, texts: list) -> str:
    """SQL CASE that picks the n-th text (a literal) of a list."""
    lit = lambda t: "NULL" if t is None else f"'{t}'" if isinstance(t, str) else str(t).lower()
    return f"CASE {n} % {len(texts)} " + " ".join(f"WHEN {i} THEN {lit(t)}" for i, t in enumerate(texts)) + " END"


# dirty text and what the folds must make of it, in order: wildcards for broken accents, a greedy tail,
# a swallowed tail, a case that must not match, and two rules that meet in one text
_REASON_CASES = [
    ("Bloqueio de cart?o", "Bloqueio de cartão"), ("Bloqueio de cartao e do aplicativo novo hoje", "Bloqueio de cartãoje"),
    ("bloqueio de cartao", "bloqueio de cartao"), ("Contesta??o de fatura", "Contestação de fatura"),
    ("D?vidas gerais sobre programa de pontos", "Dúvidas gerais sobre programa de pontos"), ("Compra n@o autorizada", "Compra não autorizada"),
    ("Contrata??o de cart?o adicional", "Contratação de cartão adicional"),
    ("Altera??o de dados cadastrais e mais", "Alteração de dados cadastrais (vencimento da fatura, telefone, email)"),
    ("Desbloqueio de cart?o", "Desbloqueio de cartão"), ("Transfer?ncia de ag?ncia", "Transferência de agência"),
    ("Renegocia??o de d?vida", "Renegociação de dívida"), ("Altera??o de dados cadastrais: Problema com aplicativo", "Alteração de dados cadastrais (vencimento da fatura, telefone, email)"),
    ("Bloqueio de cart?o, depois Desbloqueio de cart?o", "Bloqueio de cartão"), ("card blxck", "Card block"), ("", ""), (None, None),
]


@register("regex_fold_expected", "N-7 F-1", [],
          f"SELECT p_partkey, {_cases('p_partkey', [d for d, _ in _REASON_CASES])} AS reason, "
          f"{_cases('p_partkey', [c for _, c in _REASON_CASES])} AS folded FROM part")
def _regex_fold_expected(lake: Lake):
    dirty = F.expr(_cases("p_partkey", [d for d, _ in _REASON_CASES])).cast("string")
    return lake.table("part").select("p_partkey", dirty.alias("reason"), N.repair_reason(dirty).alias("folded"))


_STATUS_CASES = [
    ("ativo", True), ("ativoo", True), ("atvo", True), ("atvivo", True), ("atvio", True), ("ativ", True), ("atv", True), ("at1vo", True),
    ("a tivo", True), ("ATIVO", True), ("inativo", False), ("inatvo", False), ("invativo", False), ("inativoo", False), ("inativ", False),
    ("inativ0", False), ("in ativo", False), ("inat1vo", False), ("in at1vo", False), ("InAtivo", False), (" ativo", None), ("talvez", None), (None, None),
]


@register("status_spellings", "N-4", [],
          f"SELECT p_partkey, {_cases('p_partkey', [d for d, _ in _STATUS_CASES])} AS spelling, "
          f"CAST({_cases('p_partkey', [c for _, c in _STATUS_CASES])} AS BOOLEAN) AS active FROM part")
def _status_spellings(lake: Lake):
    dirty = F.expr(_cases("p_partkey", [d for d, _ in _STATUS_CASES])).cast("string")
    return lake.table("part").select("p_partkey", dirty.alias("spelling"), N.status_flag(dirty).alias("active"))


_EMAIL_CASES = [("a@x.com", True), ("a.b%c+d@x-y.co.uk", True), ("a@x..com", True), ("a@.x.com", True), ("a@x.c", False), ("a@x", False),
                ("a b@x.com", False), ("@x.com", False), ("a@x.com ", False), ("a@x_y.com", False), ("a@x.c0m", False)]


@register("email_expected", "Q-3", [],
          f"SELECT p_partkey, {_cases('p_partkey', [d for d, _ in _EMAIL_CASES])} AS email, "
          f"{_cases('p_partkey', [c for _, c in _EMAIL_CASES])} AS valid FROM part")
def _email_expected(lake: Lake):
    email = F.expr(_cases("p_partkey", [d for d, _ in _EMAIL_CASES])).cast("string")
    return lake.table("part").select("p_partkey", email.alias("email"), email.rlike(R.EMAIL_VALID).alias("valid"))


@register("reject_sample", "IO-20 SL-2", ["f_tickets"],
          f"SELECT {_sql_cols(O.SILVER_COLS['tickets'])}, flag_qualidade FROM f_tickets "
          f"WHERE flag_qualidade <> 'OK' ORDER BY cd_chamado LIMIT 10")
def _reject_sample(lake: Lake):
    r = lake.tickets.rejects()
    return r.orderBy("cd_chamado").limit(10).select(*S.TICKET_COLS, Q.VERDICT)


# ---------------------------------------------------------------------------
# FK checks
# ---------------------------------------------------------------------------


@register("fk_orphans", "J-8", ["br_tickets", "v_reasons", "v_channels"],
          f"SELECT 'reason' AS kind, reason AS raw_value, count(*) AS n_tickets FROM br_tickets t "
          f"WHERE NOT EXISTS (SELECT 1 FROM v_reasons r WHERE lower(trim(r.ds_motivo)) = lower(trim({O.reason_fix('t.reason')}))) "
          f"GROUP BY reason UNION ALL "
          f"SELECT 'channel', channel, count(*) FROM br_tickets t "
          f"WHERE NOT EXISTS (SELECT 1 FROM v_channels c WHERE c.nm_canal = {O.canon('t.channel')}) GROUP BY channel")
def _fk_orphans(lake: Lake):
    t = lake.bronze("l_tickets")
    r = lake.reasons.valid().select(N.text_key("ds_motivo").alias("k"))
    c = lake.channels.valid().select(F.col("nm_canal").alias("k"))
    ro = orphans(t.withColumn("_k", N.text_key(N.repair_reason("reason"))), r, "_k", "k")
    co = orphans(t.withColumn("_k", N.canonical_channel("channel")), c, "_k", "k")
    return (ro.groupBy(F.col("reason").alias("raw_value")).agg(F.count(F.lit(1)).alias("n_tickets"))
              .select(F.lit("reason").alias("kind"), "raw_value", "n_tickets")
              .unionByName(co.groupBy(F.col("channel").alias("raw_value")).agg(F.count(F.lit(1)).alias("n_tickets"))
                           .select(F.lit("channel").alias("kind"), "raw_value", "n_tickets")))


@register("lookup_bounds", "J-11 J-2", ["l_tickets", "v_reasons"],
          f"SELECT side, r.cd_motivo, count(*) AS n_tickets FROM l_tickets t LEFT JOIN (SELECT lower(trim(ds_motivo)) AS k, min(cd_motivo) AS cd_motivo "
          f"FROM v_reasons GROUP BY 1) r ON r.k = lower(trim({O.reason_fix('t.reason')})) CROSS JOIN (VALUES ('broadcast'), ('shuffle')) s(side) GROUP BY 1, 2")
def _lookup_bounds(lake: Lake):
    """The reason lookup below and above its byte bound: a broadcast and a shuffled join with the same rows."""
    def side(name: str, max_bytes: int):
        found = lookup(lake.landing("l_tickets"), lake.reasons.valid(), N.text_key(N.repair_reason("reason")), N.text_key("ds_motivo"),
                       ["cd_motivo"], max_bytes=max_bytes)
        return found.groupBy("cd_motivo").agg(F.count(F.lit(1)).alias("n_tickets")).select(F.lit(name).alias("side"), "cd_motivo", "n_tickets")
    return side("broadcast", BROADCAST_MAX_BYTES).unionByName(side("shuffle", 1))


@register("fk_check_ext", "J-9", ["v_tickets", "v_agents", "v_clients"],
          "SELECT t.cd_chamado, t.cd_atendente, (t.cd_atendente IS NULL OR EXISTS (SELECT 1 FROM v_agents a "
          "WHERE a.cd_atendente = t.cd_atendente)) AS flag_fk_atendente_valida, "
          "EXISTS (SELECT 1 FROM v_clients c WHERE c.cd_cliente = t.cd_cliente) AS flag_fk_cliente_existe "
          "FROM v_tickets t")
def _fk_check_ext(lake: Lake):
    t = lake.tickets.valid().select("cd_chamado", "cd_atendente", "cd_cliente")
    t = fk_flag(t, lake.agents.valid(), "cd_atendente", "cd_atendente", "_agent_hit")
    t = fk_flag(t, lake.clients.valid(), "cd_cliente", "cd_cliente", "flag_fk_cliente_existe")
    return t.select("cd_chamado", "cd_atendente",
                    (F.col("cd_atendente").isNull() | F.col("_agent_hit")).alias("flag_fk_atendente_valida"),
                    "flag_fk_cliente_existe")


# ---------------------------------------------------------------------------
# gold
# ---------------------------------------------------------------------------


@register("dim_agent", "T-9 F-11", ["d_agent"], "SELECT * FROM d_agent")
def _dim_agent(lake: Lake):
    return lake.dim_agent


@register("dim_channel", "T-10 F-9", ["d_channel"], "SELECT * FROM d_channel")
def _dim_channel(lake: Lake):
    return lake.dim_channel


@register("dim_client", "T-11", ["d_client"], "SELECT * FROM d_client")
def _dim_client(lake: Lake):
    return lake.dim_client


@register("dim_reason", "T-12 F-9", ["d_reason"], "SELECT * FROM d_reason")
def _dim_reason(lake: Lake):
    return lake.dim_reason


@register("dim_ticket", "T-13 F-12", ["d_ticket"], "SELECT * FROM d_ticket")
def _dim_ticket(lake: Lake):
    return lake.dim_ticket


@register("fact_service", "T-14 J-4 F-15 F-22 F-23", ["ft_service"],
          f"SELECT * EXCLUDE (dt_referencia, val_custo), {DF('dt_referencia')} AS dt_referencia, "
          f"CAST(val_custo AS DOUBLE) AS val_custo FROM ft_service")
def _fact_service(lake: Lake):
    return lake.fact_service


@register("fact_cost", "T-15 J-5", ["ft_cost"],
          f"SELECT * EXCLUDE (dt_referencia, val_custo_total), {DF('dt_referencia')} AS dt_referencia, "
          f"CAST(val_custo_total AS DOUBLE) AS val_custo_total FROM ft_cost")
def _fact_cost(lake: Lake):
    return lake.fact_cost


@register("fact_agent", "T-16 J-6 A-2 PF-6", ["ft_agent"],
          "SELECT * EXCLUDE (val_nota_media), CAST(val_nota_media AS DOUBLE) AS val_nota_media FROM ft_agent")
def _fact_agent(lake: Lake):
    return lake.fact_agent


@register("fact_service_fanout", "T-14 J-4 (source-exact fan-out and key)", ["v_tickets", "v_times", "v_costs", "v_surveys"],
          f"SELECT md5(concat({O.SOURCE_IDS})) AS pk, t.cd_cliente, t.cd_motivo, t.cd_canal, t.cd_atendente, t.cd_chamado, "
          f"{DF('CAST(coalesce(tt.dh_inicio, t.dt_ingestion) AS DATE)')} AS dt_referencia, "
          f"CAST(hour(coalesce(tt.dh_inicio, t.dt_ingestion)) AS SMALLINT) AS nu_hora_dia, "
          f"CAST(coalesce(t.tm_espera, 0) AS BIGINT) AS val_tempo_espera, "
          f"CAST(coalesce(t.tm_duracao, 0) AS BIGINT) AS val_tempo_atendimento, "
          f"CAST(coalesce(c.vl_custo, 0) AS DOUBLE) AS val_custo, CAST(s.nu_nota AS SMALLINT) AS val_nota_csat, "
          f"CAST(CASE WHEN t.tm_espera > {R.NEGATIVE_WAIT_SECONDS} OR s.nu_nota <= {R.NEGATIVE_SCORE_MAX} THEN 1 ELSE 0 END "
          f"AS SMALLINT) AS fl_experiencia_negativa, CAST(CASE WHEN t.st_resolvido THEN 1 ELSE 0 END AS SMALLINT) AS st_resolvido "
          f"FROM v_tickets t LEFT JOIN v_times tt ON t.cd_chamado = tt.cd_chamado "
          f"LEFT JOIN v_costs c ON t.cd_chamado = c.cd_chamado LEFT JOIN v_surveys s ON t.cd_chamado = s.cd_chamado")
def _fact_service_fanout(lake: Lake):
    return G.fact_service_fanout(lake.tickets.valid(), lake.times.valid(), lake.costs.valid(), lake.surveys.valid())


@register("fact_agent_fanout", "T-16 J-6 (source-exact fan-out and key)", ["v_tickets", "v_surveys"],
          "SELECT md5(CAST(cd_atendente AS VARCHAR)) AS pk_performance, cd_atendente, qtd_chamados_atendidos, "
          "val_tempo_trabalhado_seg, CAST(CAST(CASE WHEN n > 0 THEN floor((s * 200 + n) / (n * 2)) END / 100 AS DECIMAL(3,2)) "
          "AS DOUBLE) AS val_nota_media FROM (SELECT t.cd_atendente, count(*) AS qtd_chamados_atendidos, "
          "CAST(sum(t.tm_duracao) AS BIGINT) AS val_tempo_trabalhado_seg, CAST(sum(s.nu_nota) AS BIGINT) AS s, "
          "count(s.nu_nota) AS n FROM v_tickets t LEFT JOIN v_surveys s ON t.cd_chamado = s.cd_chamado "
          "WHERE t.cd_atendente IS NOT NULL GROUP BY t.cd_atendente) g")
def _fact_agent_fanout(lake: Lake):
    return G.fact_agent_fanout(lake.tickets.valid(), lake.surveys.valid())


@register("fact_cost_agg", "A-11", ["ft_cost"],
          f"SELECT cd_motivo, cd_canal, {DF('dt_referencia')} AS dt_referencia, "
          f"CAST(sum(val_custo_total) AS DOUBLE) AS val_custo_total, count(*) AS qtd_custos, "
          f"{O.r6('avg(CAST(val_custo_total AS DOUBLE))')} AS val_custo_medio FROM ft_cost GROUP BY 1, 2, 3")
def _fact_cost_agg(lake: Lake):
    return G.fact_cost_agg(lake.fact_cost)


@register("fact_agent_daily", "A-12", ["served", "v_times"],
          f"SELECT cd_atendente, {DF('dt_referencia')} AS dt_referencia, count(*) AS qtd_chamados_atendidos, "
          f"CAST(sum(tm_duracao) AS BIGINT) AS val_tempo_trabalhado_seg, {O.r6('avg(nu_nota)')} AS val_nota_media, "
          f"count(*) FILTER (WHERE st_resolvido) AS qtd_resolvidos, "
          f"{O.rate('count(*) FILTER (WHERE st_resolvido)', 'count(*)')} AS pct_resolvidos "
          f"FROM (SELECT s.*, CAST(coalesce(tt.dh_inicio, s.dt_ingestion) AS DATE) AS dt_referencia FROM served s "
          f"LEFT JOIN v_times tt ON s.cd_chamado = tt.cd_chamado) x GROUP BY cd_atendente, dt_referencia")
def _fact_agent_daily(lake: Lake):
    return G.fact_agent_daily(lake.tickets.valid(), lake.times.valid(), lake.surveys.valid())


_VIEWS = {"vw_dm_atendente": ("dim_agent", "d_agent"), "vw_dm_canal": ("dim_channel", "d_channel"), "vw_dm_cliente": ("dim_client", "d_client"),
          "vw_dm_motivo": ("dim_reason", "d_reason"), "vw_dm_chamado": ("dim_ticket", "v_tickets"), "vw_ft_atendimento_geral": ("fact_service", "ft_service"),
          "vw_ft_custo_operacional": ("fact_cost", "ft_cost"), "vw_ft_performance_agente": ("fact_agent", "ft_agent")}


@register("published_view", "IO-14 IO-16 A-4", [t for _, t in _VIEWS.values()],
          " UNION ALL ".join(f"SELECT '{v}' AS view_name, count(*) AS row_count FROM {t}" for v, (_, t) in _VIEWS.items()))
def _published_view(lake: Lake):
    """All eight gold views, read through their names."""
    sinks.publish_views(lake.spark, {v: getattr(lake, attr) for v, (attr, _) in _VIEWS.items()})
    return lake.spark.sql(" UNION ALL ".join(f"SELECT '{v}' AS view_name, count(*) AS row_count FROM {v}" for v in _VIEWS))


@register("fact_cost_source_key", "T-15 F-17", ["ft_cost"],
          f"SELECT md5(concat(CAST(cd_chamado AS VARCHAR), 'CUSTO')) AS pk_custo, cd_custo, cd_chamado, CAST(val_custo_total AS DOUBLE) AS val_custo_total FROM ft_cost")
def _fact_cost_source_key(lake: Lake):
    return G.fact_cost_source_key(lake.tickets.valid(), lake.costs.valid()).select("pk_custo", "cd_custo", "cd_chamado", F.col("val_custo_total").cast("double").alias("val_custo_total"))


# ---------------------------------------------------------------------------
# KPIs
# ---------------------------------------------------------------------------

_FS = "ft_service f"
_J_R = " LEFT JOIN d_reason r ON f.cd_motivo = r.cd_motivo"
_J_C = " LEFT JOIN d_channel c ON f.cd_canal = c.cd_canal"
_J_A = " LEFT JOIN d_agent a ON f.cd_atendente = a.cd_atendente"
_J_CL = " LEFT JOIN d_client cl ON f.cd_cliente = cl.cd_cliente"
_WASTE = f"(r.ds_criticidade = 'BAIXA' AND c.ds_tipo_interacao = '{R.CHANNEL_HUMAN}')"


@register("kpi_cost_by_reason", "K-1 W-3 SL-1 A-6 J-10", ["ft_cost", "d_reason"],
          "SELECT cd_motivo, ds_motivo, n_costs, CAST(total_cost AS DOUBLE) AS total_cost, "
          f"{O.rate('total_cost', 'sum(total_cost) OVER ()')} AS share_pct, "
          f"{O.rate('sum(total_cost) OVER (ORDER BY total_cost DESC, cd_motivo ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)', 'sum(total_cost) OVER ()')} AS cum_share_pct "
          "FROM (SELECT f.cd_motivo, r.ds_motivo, sum(f.val_custo_total) AS total_cost, count(*) AS n_costs "
          "FROM ft_cost f LEFT JOIN d_reason r ON f.cd_motivo = r.cd_motivo GROUP BY 1, 2) g ORDER BY total_cost DESC, cd_motivo")
def _kpi_cost_by_reason(lake: Lake):
    return kpi.cost_by_reason(lake)


@register("kpi_waste", "K-2 J-10", ["ft_service", "d_reason", "d_channel"],
          f"SELECT *, {O.rate('waste_cost', 'total_cost')} AS waste_cost_pct, "
          f"{O.rate('waste_tickets', 'total_tickets')} AS waste_ticket_pct FROM ("
          f"SELECT CAST(sum(CASE WHEN {_WASTE} THEN f.val_custo END) AS DOUBLE) AS waste_cost, "
          f"count(*) FILTER (WHERE {_WASTE}) AS waste_tickets, CAST(sum(f.val_custo) AS DOUBLE) AS total_cost, "
          f"count(*) AS total_tickets FROM {_FS}{_J_R}{_J_C}) g")
def _kpi_waste(lake: Lake):
    return kpi.waste(lake)


@register("kpi_top_avoidable", "K-3 SL-3", ["ft_service", "d_reason", "d_channel"],
          f"SELECT cd_motivo, ds_motivo, CAST(waste_cost AS DOUBLE) AS waste_cost, waste_tickets, "
          f"{O.rate('waste_cost', 'sum(waste_cost) OVER ()')} AS share_pct FROM ("
          f"SELECT f.cd_motivo, r.ds_motivo, sum(f.val_custo) AS waste_cost, count(*) AS waste_tickets "
          f"FROM {_FS}{_J_R}{_J_C} WHERE {_WASTE} GROUP BY 1, 2) g ORDER BY waste_cost DESC, cd_motivo LIMIT 3")
def _kpi_top_avoidable(lake: Lake):
    return kpi.top_avoidable(lake)


@register("kpi_mean_csat", "K-4", ["ft_service"],
          f"SELECT {O.r6('avg(val_nota_csat)')} AS avg_csat, count(val_nota_csat) AS n_rated, count(*) AS n_tickets "
          f"FROM ft_service")
def _kpi_mean_csat(lake: Lake):
    return kpi.mean_csat(lake)


@register("kpi_negative_experience", "K-5", ["ft_service"],
          f"SELECT *, {O.rate('n_negative', 'n_tickets')} AS negative_pct FROM (SELECT "
          f"CAST(sum(fl_experiencia_negativa) AS BIGINT) AS n_negative, count(*) AS n_tickets FROM ft_service) g")
def _kpi_negative_experience(lake: Lake):
    return kpi.negative_experience(lake)


_BUCKET = "CASE " + " ".join(f"WHEN val_tempo_espera < {u} THEN '{lab}'" for u, lab in R.WAIT_BUCKETS) + \
          f" ELSE '{R.WAIT_BUCKET_ELSE}' END"


@register("kpi_csat_by_wait", "K-6", ["ft_service"],
          f"SELECT {_BUCKET} AS wait_bucket, count(*) AS n_tickets, count(val_nota_csat) AS n_rated, "
          f"{O.r6('avg(val_nota_csat)')} AS avg_csat FROM ft_service GROUP BY 1")
def _kpi_csat_by_wait(lake: Lake):
    return kpi.csat_by_wait(lake)


@register("kpi_wait_score_corr", "K-7", ["ft_service"],
          f"SELECT {O.r6('corr(CAST(val_tempo_espera AS DOUBLE), CAST(val_nota_csat AS DOUBLE))')} AS corr_wait_score, "
          f"count(*) AS n_rated FROM ft_service WHERE val_nota_csat IS NOT NULL")
def _kpi_wait_score_corr(lake: Lake):
    return kpi.wait_score_corr(lake)


@register("kpi_wait_by_channel_type", "K-8 A-8", ["ft_service", "d_channel"],
          f"SELECT c.ds_tipo_interacao, {O.r6('avg(f.val_tempo_espera)')} AS avg_wait_sec, count(*) AS n_tickets "
          f"FROM {_FS}{_J_C} GROUP BY 1 UNION ALL SELECT 'ALL', {O.r6('avg(val_tempo_espera)')}, count(*) FROM ft_service")
def _kpi_wait_by_channel_type(lake: Lake):
    return kpi.wait_by_channel_type(lake)


@register("kpi_specialist_low_criticality", "K-9", ["ft_service", "d_agent", "d_reason"],
          f"SELECT *, {O.rate('low_crit_sec', 'total_sec')} AS low_crit_pct FROM (SELECT "
          f"CAST(sum(f.val_tempo_atendimento) AS BIGINT) AS total_sec, "
          f"CAST(coalesce(sum(CASE WHEN r.ds_criticidade = 'BAIXA' THEN f.val_tempo_atendimento END), 0) AS BIGINT) AS low_crit_sec, "
          f"count(*) AS n_tickets, count(*) FILTER (WHERE r.ds_criticidade = 'BAIXA') AS n_low_crit "
          f"FROM {_FS}{_J_A}{_J_R} WHERE f.cd_atendente IS NOT NULL AND a.nu_nivel = 2) g")
def _kpi_specialist_low_criticality(lake: Lake):
    return kpi.specialist_low_criticality(lake)


_AUTO = f"c.ds_tipo_interacao = '{R.CHANNEL_AUTOMATED}'"


@register("kpi_overflow_rate", "K-10 A-9", ["ft_service", "d_channel"],
          f"SELECT *, {O.rate('overflow_tickets', 'automated_tickets')} AS overflow_pct, "
          f"{O.rate('tickets_with_agent', 'all_tickets')} AS agent_share_pct FROM (SELECT "
          f"count(*) FILTER (WHERE {_AUTO}) AS automated_tickets, "
          f"count(*) FILTER (WHERE {_AUTO} AND f.cd_atendente IS NOT NULL) AS overflow_tickets, count(*) AS all_tickets, "
          f"count(*) FILTER (WHERE f.cd_atendente IS NOT NULL) AS tickets_with_agent FROM {_FS}{_J_C}) g")
def _kpi_overflow_rate(lake: Lake):
    return kpi.overflow_rate(lake)


@register("kpi_overflow_by_age", "K-11", ["ft_service", "d_channel", "d_client"],
          f"SELECT *, {O.rate('overflow_tickets', 'automated_tickets')} AS overflow_pct FROM (SELECT cl.ds_faixa_etaria, "
          f"count(*) AS automated_tickets, count(*) FILTER (WHERE f.cd_atendente IS NOT NULL) AS overflow_tickets "
          f"FROM {_FS}{_J_C}{_J_CL} WHERE {_AUTO} GROUP BY 1) g")
def _kpi_overflow_by_age(lake: Lake):
    return kpi.overflow_by_age(lake)


@register("kpi_peak_hours", "K-12", ["ft_service"],
          f"SELECT nu_hora_dia, count(*) AS n_tickets, {O.r6('avg(val_tempo_espera)')} AS avg_wait_sec "
          f"FROM ft_service GROUP BY 1")
def _kpi_peak_hours(lake: Lake):
    return kpi.peak_hours(lake)


@register("kpi_resolution_by_channel", "K-13", ["ft_service", "d_channel"],
          f"SELECT *, {O.rate('n_resolved', 'n_tickets')} AS resolved_pct FROM (SELECT f.cd_canal, c.nm_canal, "
          f"count(*) AS n_tickets, CAST(sum(f.st_resolvido) AS BIGINT) AS n_resolved FROM {_FS}{_J_C} GROUP BY 1, 2) g")
def _kpi_resolution_by_channel(lake: Lake):
    return kpi.resolution_by_channel(lake)


@register("kpi_cost_per_ticket_by_type", "K-14", ["ft_service", "d_channel"],
          f"SELECT c.ds_tipo_interacao, CAST(sum(f.val_custo) AS DOUBLE) AS total_cost, count(*) AS n_tickets, "
          f"{O.r6('CAST(sum(f.val_custo) AS DOUBLE) / count(*)')} AS avg_cost_per_ticket FROM {_FS}{_J_C} GROUP BY 1")
def _kpi_cost_per_ticket_by_type(lake: Lake):
    return kpi.cost_per_ticket_by_type(lake)


@register("kpi_cost_per_ticket_by_channel", "K-14", ["ft_service", "d_channel"],
          f"SELECT f.cd_canal, c.nm_canal, CAST(sum(f.val_custo) AS DOUBLE) AS total_cost, count(*) AS n_tickets, "
          f"{O.r6('CAST(sum(f.val_custo) AS DOUBLE) / count(*)')} AS avg_cost_per_ticket FROM {_FS}{_J_C} GROUP BY 1, 2")
def _kpi_cost_per_ticket_by_channel(lake: Lake):
    return kpi.cost_per_ticket_by_channel(lake)


@register("kpi_resolution_by_agent", "K-13", ["ft_service", "d_agent"],
          f"SELECT *, {O.rate('n_resolved', 'n_tickets')} AS resolved_pct FROM (SELECT f.cd_atendente, a.nm_atendente, "
          f"count(*) AS n_tickets, CAST(sum(f.st_resolvido) AS BIGINT) AS n_resolved FROM {_FS}{_J_A} WHERE f.cd_atendente IS NOT NULL GROUP BY 1, 2) g")
def _kpi_resolution_by_agent(lake: Lake):
    return kpi.resolution_by_agent(lake)


@register("kpi_csat_over_time", "K-15 A-7", ["ft_service"],
          f"SELECT {DF('dt_referencia')} AS dt_referencia, {O.r6('avg(val_nota_csat)')} AS avg_csat, "
          f"count(val_nota_csat) AS n_rated, count(*) AS n_tickets FROM ft_service GROUP BY dt_referencia")
def _kpi_csat_over_time(lake: Lake):
    return kpi.csat_over_time(lake)


@register("kpi_agent_ranking", "K-16", ["ft_agent", "d_agent"],
          "SELECT f.cd_atendente, a.nm_atendente, a.nu_nivel, f.qtd_chamados_atendidos, f.val_tempo_trabalhado_seg, "
          "CAST(f.val_nota_media AS DOUBLE) AS val_nota_media, row_number() OVER (ORDER BY f.qtd_chamados_atendidos DESC, "
          "f.val_nota_media DESC NULLS LAST, f.cd_atendente) AS rank FROM ft_agent f "
          "LEFT JOIN d_agent a ON f.cd_atendente = a.cd_atendente")
def _kpi_agent_ranking(lake: Lake):
    return kpi.agent_ranking(lake)


@register("kpi_load_by_level", "K-17", ["ft_service", "d_agent"],
          f"SELECT *, {O.rate('n_tickets', 'sum(n_tickets) OVER ()')} AS ticket_share_pct, "
          f"{O.rate('handling_sec', 'sum(handling_sec) OVER ()')} AS handling_share_pct FROM (SELECT a.nu_nivel, "
          f"count(*) AS n_tickets, CAST(sum(f.val_tempo_atendimento) AS BIGINT) AS handling_sec "
          f"FROM {_FS}{_J_A} WHERE f.cd_atendente IS NOT NULL GROUP BY 1) g")
def _kpi_load_by_level(lake: Lake):
    return kpi.load_by_level(lake)


@register("kpi_problems_by_profile", "K-18", ["ft_service", "d_client", "d_reason"],
          f"SELECT cl.ds_faixa_etaria, cl.nm_regiao, r.ds_categoria, count(*) AS n_tickets "
          f"FROM {_FS}{_J_CL}{_J_R} GROUP BY 1, 2, 3")
def _kpi_problems_by_profile(lake: Lake):
    return kpi.problems_by_profile(lake)


@register("kpi_reasons_by_profile", "K-18", ["ft_service", "d_client", "d_reason"],
          f"SELECT cl.ds_faixa_etaria, cl.nm_regiao, f.cd_motivo, r.ds_motivo, count(*) AS n_tickets "
          f"FROM {_FS}{_J_CL}{_J_R} GROUP BY 1, 2, 3, 4")
def _kpi_reasons_by_profile(lake: Lake):
    return kpi.reasons_by_profile(lake)


# quality KPIs are registered from their own module
QK.register_all(register)
