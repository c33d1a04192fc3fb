"""Independent SQL statement of every registered query (DuckDB dialect).

Used as the correctness oracle: the same landing fixtures (shared SQL
text), then every silver/gold/KPI step written again as plain SQL from the
stated semantics. Output conventions match ``catalog.report``: timestamps
as 'YYYY-MM-DD HH:MM:SS' text, dates as 'YYYY-MM-DD', money as DOUBLE.
"""

from __future__ import annotations

from callstar.functions import rules as R
from callstar.sources.ingest import DEFAULT_BATCH
from callstar.sources.landing import FIXTURE_SQL, LANDING, fixture_ctes

BATCH = f"TIMESTAMP '{DEFAULT_BATCH}'"


# -- expression helpers ------------------------------------------------------
def num(x: str, t: str) -> str:
    """Blank/non-integer text -> NULL, else the integer (as Spark try_cast)."""
    v = f"CAST({x} AS VARCHAR)"
    return f"TRY_CAST(CASE WHEN regexp_matches({v}, '^\\s*-?\\d+\\s*$') THEN {v} END AS {t})"


def fold(x: str, folds, prepare=None) -> str:
    for p, r in folds:
        if prepare:
            x = prepare(x)
        x = f"regexp_replace({x}, '{p}', '{r}', 'g')"
    return x


def up(x: str) -> str:
    return f"upper(trim({x}))"


def canon(x: str) -> str:
    return up(fold(x, R.CHANNEL_FOLDS, up))


def reason_fix(x: str) -> str:
    return fold(x, R.REASON_FOLDS + R.ENGLISH_REASON_FOLDS)


def key60(x: str) -> str:
    return f"('0x' || substr(md5({x}), 1, 15))::BIGINT"


def sha(x: str) -> str:
    return f"sha256(CAST({x} AS VARCHAR))"


def ts_parse(x: str) -> str:
    y = f"regexp_replace({x}, '{R.TS_NOISE}', ' ', 'g')"
    return (f"CASE WHEN regexp_matches({y}, '^\\d{{2}}/\\d{{2}}/\\d{{4}} \\d{{2}}:\\d{{2}}:\\d{{2}}$') "
            f"THEN try_strptime({y}, '%d/%m/%Y %H:%M:%S') END")


def money(x: str) -> str:
    return f"TRY_CAST(replace(regexp_replace({x}, '{R.MONEY_TOKENS}', '', 'g'), ',', '.') AS DECIMAL(12,10))"


def yes_no(x: str) -> str:
    w = f"upper(regexp_replace({x}, '{R.NO_PATTERN}', '{R.NO_WORD}', 'g'))"
    return f"CASE WHEN {w} = '{R.YES_WORD}' THEN true WHEN {w} = '{R.NO_WORD}' THEN false END"


def status(x: str) -> str:
    act = ", ".join(f"'{s}'" for s in R.STATUS_ACTIVE)
    ina = ", ".join(f"'{s}'" for s in R.STATUS_INACTIVE)
    return f"CASE WHEN lower({x}) IN ({ina}) THEN false WHEN lower({x}) IN ({act}) THEN true END"


def category(x: str) -> str:
    whens = " ".join(f"WHEN regexp_matches(lower({x}), '{p}') THEN '{c}'" for c, p in R.CATEGORY_RULES + R.ENGLISH_CATEGORY_RULES)
    return f"CASE {whens} ELSE '{R.DEFAULT_CATEGORY}' END"


def criticality(x: str) -> str:
    whens = " ".join(f"WHEN {up(x)} = '{s}' THEN '{c}'" for s, c in R.CRITICALITY_MAP)
    return f"CASE {whens} END"


def tsfmt(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S')"


def dfmt(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d')"


def r6(x: str) -> str:
    return f"round(CAST({x} AS DOUBLE), 6)"


def rate(n: str, d: str) -> str:
    return f"round(CAST({n} AS DOUBLE) * 100.0 / {d}, 6)"


def latest(t: str) -> str:
    return f"(SELECT * FROM {t} WHERE ingestion_timestamp = (SELECT max(ingestion_timestamp) FROM {t}))"


def flagged(base: str, key: str, order: list[str], flags: list[tuple[str, str]], drop: list[str] = ()) -> str:
    """keep-latest dedup on ``key`` then flags and verdict."""
    ob = ", ".join(f"{c} DESC NULLS LAST" for c in ["dt_ingestion", *order])
    excl = f" EXCLUDE ({', '.join(drop)})" if drop else ""
    fl = ", ".join(f"{e} AS {n}" for n, e in flags)
    ok = " AND ".join(n for n, _ in flags)
    return (f"SELECT *, CASE WHEN {ok} THEN 'OK' ELSE 'ERRO' END AS flag_qualidade FROM ("
            f"SELECT *, {fl} FROM (SELECT *{excl} FROM ({base}) b "
            f"QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY {ob}) = 1) d) v")


# -- CTE library ---------------------------------------------------------------
CTES: dict[str, str] = {}
DEPS: dict[str, list[str]] = {}


def cte(name: str, deps: list[str], sql: str) -> None:
    CTES[name] = sql
    DEPS[name] = deps


for _n in LANDING:
    cte(f"br{_n[1:]}", [_n], f"SELECT *, {BATCH} AS ingestion_timestamp, 'landing.{_n}' AS origem FROM {_n}")
cte("bb_clients", ["b_clients"],
    "SELECT *, CAST(batch_day AS TIMESTAMP) AS ingestion_timestamp, 'landing.clientes' AS origem FROM b_clients")

AGENT_FLAGS = [
    ("flag_id_valido", "cd_atendente IS NOT NULL"),
    ("flag_nome_valido", "nm_atendente IS NOT NULL AND length(nm_atendente) > 1"),
    ("flag_nivel_valido", "nu_nivel IS NOT NULL AND nu_nivel BETWEEN 1 AND 2"),
]
cte("f_agents", ["br_agents"], flagged(
    f"SELECT {num('id_agent', 'BIGINT')} AS cd_atendente, trim(agent_name) AS nm_atendente, "
    f"{num('support_level', 'SMALLINT')} AS nu_nivel, ingestion_timestamp AS dt_ingestion, origem AS dc_origem "
    f"FROM {latest('br_agents')} x", "cd_atendente", [], AGENT_FLAGS))

CHANNEL_FLAGS = [
    ("flag_nome_valido", "nm_canal IS NOT NULL AND trim(nm_canal) <> ''"),
    ("flag_status_valido", "st_ativo IS NOT NULL"),
]
cte("f_channels", ["br_channels"], flagged(
    f"SELECT {key60(canon('channel_name'))} AS cd_canal, {canon('channel_name')} AS nm_canal, "
    f"{status('channel_status')} AS st_ativo, channel_status AS st_ativo_raw, "
    f"ingestion_timestamp AS dt_ingestion, origem AS dc_origem, seq FROM {latest('br_channels')} x",
    "cd_canal", ["seq"], CHANNEL_FLAGS, ["seq"]))


def client_base(src: str) -> str:
    return (f"SELECT {sha('id_client')} AS cd_cliente, trim(client_name) AS nm_cliente, "
            f"regexp_replace(email, '{R.EMAIL_ALIAS}', '@', 'g') AS ds_email, trim(region) AS nm_regiao, "
            f"{num('age', 'SMALLINT')} AS nu_idade, ingestion_timestamp AS dt_ingestion, origem AS dc_origem "
            f"FROM {src} x")


CLIENT_FLAGS = [
    ("flag_id_valido", "cd_cliente IS NOT NULL"),
    ("flag_email_valido", f"regexp_matches(ds_email, '{R.EMAIL_VALID}')"),
    ("flag_maior_idade", "nu_idade >= 18"),
]
cte("f_clients", ["br_clients"], flagged(client_base(latest("br_clients")), "cd_cliente", [], CLIENT_FLAGS))

TIMES_FLAGS = [
    ("flag_chamado_valido", "cd_chamado IS NOT NULL"),
    ("flag_cliente_valido", "cd_cliente IS NOT NULL"),
    ("flag_timestamps_validos", "dh_abertura IS NOT NULL AND dh_inicio IS NOT NULL AND dh_fim IS NOT NULL"),
]
cte("f_times", ["br_ticket_times"], flagged(
    f"SELECT {num('id_ticket', 'BIGINT')} AS cd_chamado, {sha('id_client')} AS cd_cliente, "
    f"{ts_parse('opened_at')} AS dh_abertura, {ts_parse('started_at')} AS dh_inicio, "
    f"{ts_parse('finished_at')} AS dh_fim, ingestion_timestamp AS dt_ingestion, origem AS dc_origem "
    f"FROM {latest('br_ticket_times')} x", "cd_chamado", ["dh_abertura", "dh_inicio", "dh_fim", "cd_cliente"],
    TIMES_FLAGS))

COST_FLAGS = [
    ("flag_id_valido", "cd_custo IS NOT NULL"),
    ("flag_chamado_valido", "cd_chamado IS NOT NULL"),
    ("flag_valor_valido", "vl_custo IS NOT NULL AND vl_custo > 0"),
]
cte("f_costs", ["br_costs"], flagged(
    f"SELECT {num('id_cost', 'BIGINT')} AS cd_custo, {num('id_ticket', 'BIGINT')} AS cd_chamado, "
    f"{money('cost_text')} AS vl_custo, ingestion_timestamp AS dt_ingestion, origem AS dc_origem, "
    f"tie_1, tie_2, tie_3, cost_text FROM {latest('br_costs')} x",
    "cd_custo", ["tie_1", "tie_2", "tie_3", "cost_text"], COST_FLAGS, ["tie_1", "tie_2", "tie_3", "cost_text"]))

REASON_FLAGS = [
    ("flag_id_valido", "cd_motivo IS NOT NULL"),
    ("flag_nome_valido", "ds_motivo IS NOT NULL AND trim(ds_motivo) <> ''"),
    ("flag_categoria_valida", "ds_categoria IS NOT NULL AND trim(ds_categoria) <> ''"),
    ("flag_criticidade_valida", "ds_criticidade IS NOT NULL AND trim(ds_criticidade) <> ''"),
]
_rname = reason_fix("trim(reason_name)")
cte("f_reasons", ["br_reasons"], flagged(
    f"SELECT {num('id_reason', 'BIGINT')} AS cd_motivo, {_rname} AS ds_motivo, {category(_rname)} AS ds_categoria, "
    f"{criticality('criticality')} AS ds_criticidade, ingestion_timestamp AS dt_ingestion, "
    f"coalesce(origem, 'base_motivos') AS dc_origem, seq FROM {latest('br_reasons')} x",
    "cd_motivo", ["seq"], REASON_FLAGS, ["seq"]))

SURVEY_FLAGS = [
    ("flag_pk_valida", "cd_pesquisa IS NOT NULL"),
    ("flag_fk_valida", "cd_chamado IS NOT NULL"),
    ("flag_nota_valida", "nu_nota IS NULL OR nu_nota BETWEEN 1 AND 5"),
]
cte("f_surveys", ["br_surveys"], flagged(
    f"SELECT {num('id_survey', 'BIGINT')} AS cd_pesquisa, {num('id_ticket', 'BIGINT')} AS cd_chamado, "
    f"{num('score', 'SMALLINT')} AS nu_nota, ingestion_timestamp AS dt_ingestion, "
    f"coalesce(origem, 'pesquisa_satisfacao') AS dc_origem FROM {latest('br_surveys')} x",
    "cd_pesquisa", [], SURVEY_FLAGS))

SILVER_COLS = {
    "agents": ["cd_atendente", "nm_atendente", "nu_nivel", "dt_ingestion", "dc_origem"],
    "channels": ["cd_canal", "nm_canal", "st_ativo", "dt_ingestion", "dc_origem"],
    "clients": ["cd_cliente", "nm_cliente", "ds_email", "nm_regiao", "nu_idade", "dt_ingestion", "dc_origem"],
    "times": ["cd_chamado", "cd_cliente", "dh_abertura", "dh_inicio", "dh_fim", "dt_ingestion", "dc_origem"],
    "costs": ["cd_custo", "cd_chamado", "vl_custo", "dt_ingestion", "dc_origem"],
    "reasons": ["cd_motivo", "ds_motivo", "ds_categoria", "ds_criticidade", "dt_ingestion", "dc_origem"],
    "surveys": ["cd_pesquisa", "cd_chamado", "nu_nota", "dt_ingestion", "dc_origem"],
    "tickets": ["cd_chamado", "cd_cliente", "cd_motivo", "cd_canal", "st_resolvido", "tm_espera",
                "tm_duracao", "cd_atendente", "dt_ingestion", "dc_origem"],
}
for _t in ["agents", "channels", "clients", "times", "costs", "reasons", "surveys"]:
    cte(f"v_{_t}", [f"f_{_t}"], f"SELECT {', '.join(SILVER_COLS[_t])} FROM f_{_t} WHERE flag_qualidade = 'OK'")

TICKET_FLAGS = [
    ("flag_pk_valida", "cd_chamado IS NOT NULL"),
    ("flag_fk_cliente_valida", "cd_cliente IS NOT NULL"),
    ("flag_fk_motivo_valida", "cd_motivo IS NOT NULL"),
    ("flag_fk_canal_valida", "cd_canal IS NOT NULL"),
]
_RAW_TICKET_ORDER = ", ".join(f"{c} DESC NULLS LAST" for c in
                              ["ingestion_timestamp", "id_ticket", "id_client", "reason", "channel", "resolved",
                               "id_agent", "origem"])
_TICKET_FLAGS_SQL = ", ".join(f"{e} AS {n}" for n, e in TICKET_FLAGS)
cte("f_tickets", ["br_tickets", "v_reasons", "v_channels", "v_times"],
    f"SELECT *, CASE WHEN {' AND '.join(n for n, _ in TICKET_FLAGS)} THEN 'OK' ELSE 'ERRO' END AS flag_qualidade FROM ("
    f"SELECT *, {_TICKET_FLAGS_SQL} FROM ("
    f"SELECT t._id AS cd_chamado, {sha('t.id_client')} AS cd_cliente, r.cd_motivo, c.cd_canal, "
    f"{yes_no('t.resolved')} AS st_resolvido, "
    f"CAST(epoch(tt.dh_inicio) - epoch(tt.dh_abertura) AS BIGINT) AS tm_espera, "
    f"CAST(epoch(tt.dh_fim) - epoch(tt.dh_inicio) AS BIGINT) AS tm_duracao, "
    f"{num('t.id_agent', 'BIGINT')} AS cd_atendente, t.ingestion_timestamp AS dt_ingestion, "
    f"coalesce(t.origem, 'chamados') AS dc_origem "
    f"FROM (SELECT * FROM (SELECT *, {num('id_ticket', 'BIGINT')} AS _id FROM {latest('br_tickets')} x) y "
    f"QUALIFY row_number() OVER (PARTITION BY _id ORDER BY {_RAW_TICKET_ORDER}) = 1) t "
    f"LEFT JOIN (SELECT lower(trim(ds_motivo)) AS k, min(cd_motivo) AS cd_motivo FROM v_reasons GROUP BY 1) r "
    f"ON lower(trim({reason_fix('t.reason')})) = r.k "
    f"LEFT JOIN (SELECT nm_canal AS k, min(cd_canal) AS cd_canal FROM v_channels GROUP BY 1) c "
    f"ON {canon('t.channel')} = c.k "
    f"LEFT JOIN v_times tt ON t._id = tt.cd_chamado) b) v")
cte("v_tickets", ["f_tickets"], f"SELECT {', '.join(SILVER_COLS['tickets'])} FROM f_tickets WHERE flag_qualidade = 'OK'")

# -- gold ------------------------------------------------------------------
cte("d_agent", ["v_agents"],
    f"SELECT cd_atendente, nm_atendente, CAST(nu_nivel AS SMALLINT) AS nu_nivel, CASE WHEN nu_nivel = 2 "
    f"THEN '{R.PROFILE_SPECIALIST}' ELSE '{R.PROFILE_GENERALIST}' END AS ds_perfil FROM v_agents")
_auto = " OR ".join(f"upper(nm_canal) LIKE '{p}'" for p in R.AUTOMATED_CHANNEL_LIKE)
cte("d_channel", ["v_channels"],
    f"SELECT cd_canal, nm_canal, st_ativo, CASE WHEN {_auto} THEN '{R.CHANNEL_AUTOMATED}' "
    f"ELSE '{R.CHANNEL_HUMAN}' END AS ds_tipo_interacao FROM v_channels")
_bands = " ".join(f"WHEN nu_idade <= {u} THEN '{lab}'" for u, lab in R.AGE_BANDS)
cte("d_client", ["v_clients"],
    f"SELECT cd_cliente, nm_cliente, ds_email, nm_regiao, CAST(nu_idade AS SMALLINT) AS nu_idade, "
    f"CASE {_bands} ELSE '{R.AGE_BAND_ELSE}' END AS ds_faixa_etaria FROM v_clients")
_pot = " ".join(f"WHEN upper(ds_criticidade) LIKE '{p}' THEN '{lab}'" for p, lab in R.AUTOMATION_POTENTIAL)
cte("d_reason", ["v_reasons"],
    f"SELECT cd_motivo, ds_motivo, ds_categoria, ds_criticidade, CASE {_pot} ELSE '{R.AUTOMATION_POTENTIAL_ELSE}' "
    f"END AS ds_potencial_automacao FROM v_reasons")
cte("d_ticket", ["v_tickets"],
    "SELECT cd_chamado, CAST(coalesce(tm_espera, 0) AS BIGINT) AS tm_espera, "
    "CAST(coalesce(tm_duracao, 0) AS BIGINT) AS tm_duracao FROM v_tickets")
cte("cost_pt", ["v_costs"],
    "SELECT cd_chamado, CAST(sum(vl_custo) AS DECIMAL(22,10)) AS vl_custo_total FROM v_costs GROUP BY cd_chamado")
cte("survey_pt", ["v_surveys"],
    "SELECT cd_chamado, nu_nota FROM v_surveys QUALIFY row_number() OVER (PARTITION BY cd_chamado "
    "ORDER BY dt_ingestion DESC NULLS LAST, cd_pesquisa DESC NULLS LAST, nu_nota DESC NULLS LAST) = 1")
SOURCE_IDS = ", ".join(f"coalesce(CAST(t.{c} AS VARCHAR), '0')" for c in ("cd_cliente", "cd_motivo", "cd_canal", "cd_atendente", "cd_chamado"))
SERVICE_IDS = ", ".join(f"coalesce(CAST(t.{c} AS VARCHAR), '')"
                 for c in ["cd_cliente", "cd_motivo", "cd_canal", "cd_atendente", "cd_chamado"])
cte("ft_service", ["v_tickets", "v_times", "cost_pt", "survey_pt"],
    f"SELECT md5(concat_ws('|', {SERVICE_IDS})) AS pk, t.cd_cliente, t.cd_motivo, t.cd_canal, t.cd_atendente, t.cd_chamado, "
    f"CAST(coalesce(tt.dh_inicio, t.dt_ingestion) AS DATE) AS dt_referencia, "
    f"CAST(hour(coalesce(tt.dh_inicio, t.dt_ingestion)) AS SMALLINT) AS nu_hora_dia, "
    f"CAST(coalesce(t.tm_espera, 0) AS BIGINT) AS val_tempo_espera, "
    f"CAST(coalesce(t.tm_duracao, 0) AS BIGINT) AS val_tempo_atendimento, "
    f"CAST(coalesce(c.vl_custo_total, 0) AS DECIMAL(22,10)) AS val_custo, "
    f"CAST(s.nu_nota AS SMALLINT) AS val_nota_csat, "
    f"CAST(CASE WHEN t.tm_espera > {R.NEGATIVE_WAIT_SECONDS} OR s.nu_nota <= {R.NEGATIVE_SCORE_MAX} THEN 1 ELSE 0 END AS SMALLINT) "
    f"AS fl_experiencia_negativa, CAST(CASE WHEN t.st_resolvido THEN 1 ELSE 0 END AS SMALLINT) AS st_resolvido "
    f"FROM v_tickets t LEFT JOIN v_times tt ON t.cd_chamado = tt.cd_chamado "
    f"LEFT JOIN cost_pt c ON t.cd_chamado = c.cd_chamado LEFT JOIN survey_pt s ON t.cd_chamado = s.cd_chamado")
cte("ft_cost", ["v_tickets", "v_costs"],
    "SELECT md5(concat_ws('|', coalesce(CAST(c.cd_chamado AS VARCHAR), ''), coalesce(CAST(c.cd_custo AS VARCHAR), ''))) "
    "AS pk_custo, c.cd_custo, c.cd_chamado, t.cd_motivo, t.cd_canal, c.vl_custo AS val_custo_total, "
    "CAST(t.dt_ingestion AS DATE) AS dt_referencia FROM v_costs c JOIN v_tickets t ON c.cd_chamado = t.cd_chamado")
cte("served", ["v_tickets", "survey_pt"],
    "SELECT t.*, s.nu_nota FROM v_tickets t LEFT JOIN survey_pt s ON t.cd_chamado = s.cd_chamado "
    "WHERE t.cd_atendente IS NOT NULL")
cte("ft_agent", ["served"],
    "SELECT md5(CAST(cd_atendente AS VARCHAR)) AS pk_performance, cd_atendente, qtd_chamados_atendidos, "
    "val_tempo_trabalhado_seg, CAST(CASE WHEN n > 0 THEN floor((s * 200 + n) / (n * 2)) END / 100 AS DECIMAL(3,2)) "
    "AS val_nota_media FROM (SELECT cd_atendente, count(*) AS qtd_chamados_atendidos, "
    "CAST(sum(tm_duracao) AS BIGINT) AS val_tempo_trabalhado_seg, CAST(sum(nu_nota) AS BIGINT) AS s, "
    "count(nu_nota) AS n FROM served GROUP BY cd_atendente) g")


def with_ctes(deps: list[str], body: str, only: dict[str, str] | None = None) -> str:
    """WITH clause holding every CTE ``deps`` needs, in dependency order; ``only`` restricts landing tables by a condition."""
    order: list[str] = []

    def visit(n):
        if n in order:
            return
        if n in CTES:
            for d in DEPS[n]:
                visit(d)
            order.append(n)
        elif n in FIXTURE_SQL:
            order.append(n)

    for d in deps:
        visit(d)
    parts = []
    done = set()
    for n in order:
        if n in FIXTURE_SQL:
            for fn, fsql in fixture_ctes([n]):
                if fn not in done:
                    parts.append(f"{fn} AS (SELECT * FROM ({fsql}) x WHERE {only[fn]})" if only and fn in only else f"{fn} AS ({fsql})")
                    done.add(fn)
        elif n not in done:
            parts.append(f"{n} AS ({CTES[n]})")
            done.add(n)
    if not parts:
        return body
    if body.lstrip().upper().startswith("WITH "):
        return "WITH " + ",\n".join(parts) + ",\n" + body.lstrip()[5:]
    return "WITH " + ",\n".join(parts) + "\n" + body
