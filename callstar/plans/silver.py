"""Silver builders: bronze batch -> cleaned, deduplicated, validated table.

Each builder returns a ``Silver`` holding the *flagged* frame (house
columns + one flag per rule + verdict). Valid rows, rejects and counters
are all filters/aggregates of that one frame, so a job that writes both
sides should materialise it once (``publish.write_flagged``) instead of
re-running the lineage per output.

Shuffles per table: one for the keep-latest dedup (hash on the key); the
ticket builder adds one for the ticket-times join. Reason and channel
lookups are broadcast behind a row bound.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callstar.functions import keys as K
from callstar.functions import normalize as N
from callstar.operators import quality as Q
from callstar.operators.dedup import keep_latest
from callstar.operators.lookup import lookup
from callstar.sources.batches import latest_batch
from callstar.sources.ingest import ORIGIN_COL, STAMP_COL


@dataclass
class Silver:
    name: str
    flagged: DataFrame
    columns: list[str]
    rules: list[Q.Rule]
    extra_reject_cols: list[str] = field(default_factory=list)

    def valid(self) -> DataFrame:
        return self.flagged.filter(F.col(Q.VERDICT) == Q.OK).select(*self.columns)

    def rejects(self) -> DataFrame:
        cols = self.columns + self.extra_reject_cols + [r.flag for r in self.rules] + [Q.VERDICT]
        return self.flagged.filter(F.col(Q.VERDICT) != Q.OK).select(*cols)

    def counts(self) -> DataFrame:
        return Q.verdict_counts(self.flagged, self.name)


def _batch(bronze: DataFrame, batch, history: bool = False) -> DataFrame:
    """Latest batch by default; an explicit batch stamp reprocesses that one; ``history`` takes all of them."""
    if history:
        return bronze
    if batch is None:
        return latest_batch(bronze)
    return bronze.filter(F.col(STAMP_COL) == F.lit(batch).cast("timestamp"))


def _num(bronze: DataFrame, name: str, to: str) -> Column:
    """A number: an integer column as it is (filters on it reach the scan), text without blanks, try-cast."""
    if isinstance(bronze.schema[name].dataType, T.IntegralType):
        return F.col(name).try_cast(to)
    return N.to_number(name, to)


def _stamp_cols(origin_default: str | None = None) -> list[Column]:
    origin = F.col(ORIGIN_COL)
    if origin_default is not None:
        origin = F.coalesce(origin, F.lit(origin_default))
    return [F.col(STAMP_COL).alias("dt_ingestion"), origin.alias("dc_origem")]


def _not_blank(c: str) -> Column:
    return F.col(c).isNotNull() & (F.trim(F.col(c)) != "")


def _finish(name, df, key, order, rules, columns, extra=(), history: bool = False, only: DataFrame | None = None) -> Silver:
    """``history`` keeps a row for each key and batch; ``only`` (one column, the key) drops other keys before the shuffle."""
    if only is not None:
        df = df.join(only, only.columns, "left_semi")
    keys = [key, "dt_ingestion"] if history else [key]
    deduped = keep_latest(df, keys, [c for c in ("dt_ingestion", *order) if c not in keys])
    deduped = deduped.drop(*order)
    flagged = Q.validate(deduped, rules)
    return Silver(name, flagged, columns, Q.as_rules(rules), list(extra))


AGENT_COLS = ["cd_atendente", "nm_atendente", "nu_nivel", "dt_ingestion", "dc_origem"]


def silver_agent(bronze: DataFrame, batch=None, history: bool = False, only: DataFrame | None = None) -> Silver:
    df = _batch(bronze, batch, history).select(
        _num(bronze, "id_agent", "bigint").alias("cd_atendente"),
        F.trim("agent_name").alias("nm_atendente"),
        _num(bronze, "support_level", "smallint").alias("nu_nivel"),
        *_stamp_cols())
    rules = [
        Q.Rule("flag_id_valido", F.col("cd_atendente").isNotNull(), "missing id"),
        Q.Rule("flag_nome_valido", F.col("nm_atendente").isNotNull() & (F.length("nm_atendente") > 1), "invalid name"),
        Q.Rule("flag_nivel_valido", F.col("nu_nivel").isNotNull() & F.col("nu_nivel").between(1, 2), "invalid level"),
    ]
    return _finish("tb_atendente", df, "cd_atendente", [], rules, AGENT_COLS, history=history, only=only)


CHANNEL_COLS = ["cd_canal", "nm_canal", "st_ativo", "dt_ingestion", "dc_origem"]


def silver_channel(bronze: DataFrame, batch=None, history: bool = False, only: DataFrame | None = None) -> Silver:
    name = N.canonical_channel("channel_name")
    df = _batch(bronze, batch, history).select(
        K.key60(name).alias("cd_canal"),
        name.alias("nm_canal"),
        N.status_flag("channel_status").alias("st_ativo"),
        F.col("channel_status").alias("st_ativo_raw"),
        *_stamp_cols(), "seq")
    rules = [
        Q.Rule("flag_nome_valido", _not_blank("nm_canal"), "blank name"),
        Q.Rule("flag_status_valido", F.col("st_ativo").isNotNull(), "unknown status"),
    ]
    return _finish("tb_canal", df, "cd_canal", ["seq"], rules, CHANNEL_COLS, ["st_ativo_raw"], history=history, only=only)


CLIENT_COLS = ["cd_cliente", "nm_cliente", "ds_email", "nm_regiao", "nu_idade", "dt_ingestion", "dc_origem"]


def silver_client(bronze: DataFrame, batch=None, history: bool = False, only: DataFrame | None = None) -> Silver:
    """``history=True`` validates every batch (dedup per key and batch),
    for batch-over-batch quality tracking."""
    df = _batch(bronze, batch, history).select(
        K.pseudonym("id_client").alias("cd_cliente"),
        F.trim("client_name").alias("nm_cliente"),
        N.strip_email_alias("email").alias("ds_email"),
        F.trim("region").alias("nm_regiao"),
        _num(bronze, "age", "smallint").alias("nu_idade"),
        *_stamp_cols())
    rules = [
        Q.Rule("flag_id_valido", F.col("cd_cliente").isNotNull(), "missing id"),
        Q.Rule("flag_email_valido", F.col("ds_email").rlike(N.R.EMAIL_VALID), "invalid e-mail"),
        Q.Rule("flag_maior_idade", F.col("nu_idade") >= 18, "under age"),
    ]
    return _finish("tb_cliente", df, "cd_cliente", [], rules, CLIENT_COLS, history=history, only=only)


TIMES_COLS = ["cd_chamado", "cd_cliente", "dh_abertura", "dh_inicio", "dh_fim", "dt_ingestion", "dc_origem"]


def silver_ticket_times(bronze: DataFrame, batch=None, history: bool = False, only: DataFrame | None = None) -> Silver:
    df = _batch(bronze, batch, history).select(
        _num(bronze, "id_ticket", "bigint").alias("cd_chamado"),
        K.pseudonym("id_client").alias("cd_cliente"),
        N.dirty_timestamp("opened_at").alias("dh_abertura"),
        N.dirty_timestamp("started_at").alias("dh_inicio"),
        N.dirty_timestamp("finished_at").alias("dh_fim"),
        *_stamp_cols())
    rules = [
        Q.Rule("flag_chamado_valido", F.col("cd_chamado").isNotNull(), "missing ticket"),
        Q.Rule("flag_cliente_valido", F.col("cd_cliente").isNotNull(), "missing client"),
        Q.Rule("flag_timestamps_validos", F.col("dh_abertura").isNotNull() & F.col("dh_inicio").isNotNull()
               & F.col("dh_fim").isNotNull(), "unparsed timestamp"),
    ]
    return _finish("tb_chamado_log", df, "cd_chamado", [], rules, TIMES_COLS, history=history, only=only)


COST_COLS = ["cd_custo", "cd_chamado", "vl_custo", "dt_ingestion", "dc_origem"]


def silver_cost(bronze: DataFrame, batch=None, history: bool = False, only: DataFrame | None = None) -> Silver:
    df = _batch(bronze, batch, history).select(
        _num(bronze, "id_cost", "bigint").alias("cd_custo"),
        _num(bronze, "id_ticket", "bigint").alias("cd_chamado"),
        N.money("cost_text").alias("vl_custo"),
        *_stamp_cols(), "tie_1", "tie_2", "tie_3", "cost_text")
    rules = [
        Q.Rule("flag_id_valido", F.col("cd_custo").isNotNull(), "missing id"),
        Q.Rule("flag_chamado_valido", F.col("cd_chamado").isNotNull(), "missing ticket"),
        Q.Rule("flag_valor_valido", F.col("vl_custo").isNotNull() & (F.col("vl_custo") > 0), "invalid amount"),
    ]
    return _finish("tb_custo_chamado", df, "cd_custo", ["tie_1", "tie_2", "tie_3", "cost_text"], rules, COST_COLS, history=history, only=only)


REASON_COLS = ["cd_motivo", "ds_motivo", "ds_categoria", "ds_criticidade", "dt_ingestion", "dc_origem"]
REASON_REJECT_TEXT = "motivo_rejeicao"


def silver_reason(bronze: DataFrame, batch=None, history: bool = False, only: DataFrame | None = None) -> Silver:
    name = N.repair_reason(F.trim("reason_name"))
    df = _batch(bronze, batch, history).select(
        _num(bronze, "id_reason", "bigint").alias("cd_motivo"),
        name.alias("ds_motivo"),
        N.category(name).alias("ds_categoria"),
        N.criticality("criticality").alias("ds_criticidade"),
        *_stamp_cols("base_motivos"), "seq")
    rules = [
        Q.Rule("flag_id_valido", F.col("cd_motivo").isNotNull(), "missing id"),
        Q.Rule("flag_nome_valido", _not_blank("ds_motivo"), "blank name"),
        Q.Rule("flag_categoria_valida", _not_blank("ds_categoria"), "blank category"),
        Q.Rule("flag_criticidade_valida", _not_blank("ds_criticidade"), "unknown criticality"),
    ]
    return _finish("tb_motivo", df, "cd_motivo", ["seq"], rules, REASON_COLS, history=history, only=only)


def reason_rejects(s: Silver) -> DataFrame:
    """Reason audit rows: base columns as text, verdict and rejection text."""
    return (s.flagged.filter(F.col(Q.VERDICT) != Q.OK)
             .select(*[F.col(c).cast("string").alias(c) for c in s.columns], Q.VERDICT,
                     Q.rejection_text(s.rules).alias(REASON_REJECT_TEXT)))


SURVEY_COLS = ["cd_pesquisa", "cd_chamado", "nu_nota", "dt_ingestion", "dc_origem"]


def silver_survey(bronze: DataFrame, batch=None, history: bool = False, only: DataFrame | None = None) -> Silver:
    df = _batch(bronze, batch, history).select(
        _num(bronze, "id_survey", "bigint").alias("cd_pesquisa"),
        _num(bronze, "id_ticket", "bigint").alias("cd_chamado"),
        _num(bronze, "score", "smallint").alias("nu_nota"),
        *_stamp_cols("pesquisa_satisfacao"))
    rules = [
        Q.Rule("flag_pk_valida", F.col("cd_pesquisa").isNotNull(), "missing id"),
        Q.Rule("flag_fk_valida", F.col("cd_chamado").isNotNull(), "missing ticket"),
        Q.Rule("flag_nota_valida", F.col("nu_nota").isNull() | F.col("nu_nota").between(1, 5), "score out of range"),
    ]
    return _finish("tb_pesquisa", df, "cd_pesquisa", [], rules, SURVEY_COLS, history=history, only=only)


def with_durations(tickets: DataFrame, times: DataFrame) -> DataFrame:
    """Tickets with waiting and handling time recomputed from ``times`` (unique per ticket)."""
    tt = times.select("cd_chamado", "dh_abertura", "dh_inicio", "dh_fim")
    return (tickets.drop("tm_espera", "tm_duracao").join(tt, "cd_chamado", "left")
            .select(*[c for c in tickets.columns if c not in ("tm_espera", "tm_duracao")],
                    N.seconds_between("dh_abertura", "dh_inicio").alias("tm_espera"),
                    N.seconds_between("dh_inicio", "dh_fim").alias("tm_duracao")))


TICKET_COLS = ["cd_chamado", "cd_cliente", "cd_motivo", "cd_canal", "st_resolvido", "tm_espera",
               "tm_duracao", "cd_atendente", "dt_ingestion", "dc_origem"]


def silver_ticket(bronze: DataFrame, reasons: DataFrame, channels: DataFrame,
                  times: DataFrame, batch=None, lookup_max_bytes: int | None = None, selected: bool = False,
                  history: bool = False) -> Silver:
    """Tickets with reason/channel ids looked up by normalised text and
    durations from ticket times. ``reasons``/``channels``/``times`` are the
    *valid* silver tables (full tables, not only their latest batch).

    Raw ticket records are deduplicated first (newest stamp, then every raw
    column as tie-break), so a hot ticket id is cut to one row per map task
    before the first shuffle, and the ticket-times join sees unique keys that
    are already hash-partitioned on the ticket id. ``lookup_max_bytes`` (for
    stored lookup tables) broadcasts a lookup only after proving it has at
    most that many bytes; otherwise AQE decides from the measured size.
    ``selected`` takes all given records instead of one batch of them, ``history`` with a row for each ticket and batch.
    """
    t = _batch(bronze, batch, selected or history).withColumn("_id", _num(bronze, "id_ticket", "bigint"))
    t = keep_latest(t, ["_id", STAMP_COL], []) if history else keep_latest(t, ["_id"], [STAMP_COL])
    t = lookup(t, reasons, N.text_key(N.repair_reason("reason")), N.text_key("ds_motivo"), ["cd_motivo"],
               max_bytes=lookup_max_bytes)
    t = lookup(t, channels, N.canonical_channel("channel"), F.col("nm_canal"), ["cd_canal"],
               max_bytes=lookup_max_bytes)
    tt = times.select(F.col("cd_chamado").alias("_tid"), "dh_abertura", "dh_inicio", "dh_fim")
    t = t.join(tt, t["_id"] == tt["_tid"], "left")
    df = t.select(
        F.col("_id").alias("cd_chamado"),
        K.pseudonym("id_client").alias("cd_cliente"),
        "cd_motivo", "cd_canal",
        N.yes_no("resolved").alias("st_resolvido"),
        N.seconds_between("dh_abertura", "dh_inicio").alias("tm_espera"),
        N.seconds_between("dh_inicio", "dh_fim").alias("tm_duracao"),
        _num(bronze, "id_agent", "bigint").alias("cd_atendente"),
        *_stamp_cols("chamados"))
    rules = [
        Q.Rule("flag_pk_valida", F.col("cd_chamado").isNotNull(), "missing id"),
        Q.Rule("flag_fk_cliente_valida", F.col("cd_cliente").isNotNull(), "missing client"),
        Q.Rule("flag_fk_motivo_valida", F.col("cd_motivo").isNotNull(), "unknown reason"),
        Q.Rule("flag_fk_canal_valida", F.col("cd_canal").isNotNull(), "unknown channel"),
    ]
    return Silver("tb_chamado", Q.validate(df, rules), TICKET_COLS, Q.as_rules(rules))
