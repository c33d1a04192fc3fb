"""Landing tables derived from the driver's parquet tables.

The reference's source system is outside its repository, so the eight
landing tables (plus a two-batch client feed) are derived from the TPC-H-ish
tables with deliberate dirt. Each derivation is one SQL text with ``{name}``
placeholders: Spark binds them to DataFrames (``spark.sql(text, name=df)``),
and the DuckDB oracle binds them to table / CTE names, so both engines start
from identical inputs. Every derivation reads whole tables.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The input table as a DataFrame; each call lists the files anew."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _ts_text(col: str) -> str:
    sep = "CASE WHEN event_id % 3 = 0 THEN ' às ' WHEN event_id % 41 = 7 THEN ' as ' ELSE ' ' END"
    return (f"concat(lpad(CAST(day({col}) AS STRING),2,'0'),'/',lpad(CAST(month({col}) AS STRING),2,'0'),'/',"
            f"CAST(year({col}) AS STRING),{sep},lpad(CAST(hour({col}) AS STRING),2,'0'),':',"
            f"lpad(CAST(minute({col}) AS STRING),2,'0'),':',lpad(CAST(CAST(second({col}) AS INT) AS STRING),2,'0'))")


FIXTURE_SQL: dict[str, str] = {
    # agents: padded names, one-letter name, level 3, NULL level
    "l_agents": """
SELECT s_suppkey AS id_agent,
 CASE WHEN s_suppkey % 17 = 3 THEN ' X ' ELSE concat('  ', s_name, ' ') END AS agent_name,
 CASE WHEN s_suppkey % 13 = 5 THEN 3 WHEN s_suppkey % 11 = 4 THEN NULL ELSE 1 + s_nationkey % 2 END AS support_level
FROM {supplier}""",
    # reasons: a change feed of the reason catalogue, one record per part;
    # spelling/case/padding variants; unmapped criticality; blank name
    "l_reasons": """
SELECT id_reason,
 CASE WHEN v % 3 = 0 THEN upper(base_name) WHEN v % 3 = 1 THEN concat(' ', base_name, ' ') ELSE base_name END AS reason_name,
 CASE WHEN v % 2 = 0 THEN base_crit ELSE upper(base_crit) END AS criticality,
 seq
FROM (SELECT 1 + p_partkey % 12 AS id_reason, p_size AS v, p_partkey AS seq,
  CASE p_partkey % 12 WHEN 0 THEN 'Card block' WHEN 1 THEN 'Purchase not authorised' WHEN 2 THEN 'Invoice dispute'
   WHEN 3 THEN 'Debt renegotiation' WHEN 4 THEN 'Address data change' WHEN 5 THEN 'Branch transfer' WHEN 6 THEN 'App problem'
   WHEN 7 THEN 'Points programme question' WHEN 8 THEN 'Additional card request' WHEN 9 THEN 'Limit enquiry'
   WHEN 10 THEN 'Other matter' ELSE ' ' END AS base_name,
  CASE p_partkey % 12 WHEN 0 THEN 'alta' WHEN 1 THEN 'Alta ' WHEN 2 THEN 'Média' WHEN 3 THEN 'MEDIA' WHEN 4 THEN 'baixa'
   WHEN 5 THEN 'Baixa' WHEN 6 THEN 'média' WHEN 7 THEN 'BAIXA' WHEN 8 THEN 'media' WHEN 9 THEN 'baixa'
   WHEN 10 THEN 'urgente' ELSE 'alta' END AS base_crit
 FROM {part}) p""",
    # channels: a change feed of the channel catalogue, one record per customer;
    # status typos, unmapped status, duplicate after canonicalisation, padding
    "l_channels": """
SELECT CASE c_custkey % 7 WHEN 0 THEN 'Chatbot' WHEN 1 THEN ' URA ' WHEN 2 THEN 'Atendimento Inicial'
   WHEN 3 THEN 'Atendimento Especializado' WHEN 4 THEN 'Fax' WHEN 5 THEN 'Kiosk' ELSE ' chatbot' END AS channel_name,
 CASE c_custkey % 7 WHEN 0 THEN 'ativo' WHEN 1 THEN 'atvio' WHEN 2 THEN 'ATIVO' WHEN 3 THEN 'at1vo'
   WHEN 4 THEN 'invativo' WHEN 5 THEN 'talvez' ELSE 'inativo' END AS channel_status,
 c_custkey AS seq
FROM {customer}""",
    # clients: NULL / malformed / +alias e-mail, NULL age, under 18, padded region
    "l_clients": """
SELECT c_custkey AS id_client, concat(' ', c_name) AS client_name,
 CASE WHEN c_custkey % 23 = 11 THEN NULL WHEN c_custkey % 19 = 7 THEN concat('user', CAST(c_custkey AS STRING), '#mail')
      WHEN c_custkey % 5 = 0 THEN concat('user', CAST(c_custkey AS STRING), '+promo@mail.example.com')
      ELSE concat('user', CAST(c_custkey AS STRING), '@mail.example.com') END AS email,
 concat(' ', r_name, ' ') AS region, CASE WHEN c_custkey % 29 = 13 THEN NULL ELSE 15 + c_custkey % 60 END AS age
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey""",
    # tickets: broken accent, case, padding, tail text, unknown reason/channel,
    # NULL client, blank/NULL agent, accented/blank yes-no, agent on bot channel
    "l_tickets": """
SELECT o_orderkey AS id_ticket, CASE WHEN o_orderkey % 97 = 5 THEN NULL ELSE o_custkey END AS id_client,
 CASE o_orderkey % 11 WHEN 0 THEN 'Card bl?ck' WHEN 1 THEN 'purchase NOT authorised' WHEN 2 THEN ' Invoice dispute ' WHEN 3 THEN 'Debt renegotiation'
   WHEN 4 THEN 'Address data change (phone)' WHEN 5 THEN 'Branch transfer' WHEN 6 THEN 'App problem' WHEN 7 THEN 'Points programme question'
   WHEN 8 THEN 'Additional card request' WHEN 9 THEN 'Limit enquiry' ELSE 'Unknown thing' END AS reason,
 CASE o_custkey % 6 WHEN 0 THEN 'u.r.a.' WHEN 1 THEN 'chat bot' WHEN 2 THEN 'ChatBot ' WHEN 3 THEN 'atend. inicial' WHEN 4 THEN 'Atendimento Especializado' ELSE 'carrier pigeon' END AS channel,
 CASE o_orderstatus WHEN 'F' THEN 'Sim' WHEN 'O' THEN 'Não' ELSE CASE WHEN o_orderkey % 2 = 0 THEN 'nao' ELSE '' END END AS resolved,
 CASE WHEN o_custkey % 6 IN (3, 4) OR o_orderkey % 8 = 1 THEN CAST(o_custkey % 10 AS STRING) WHEN o_orderkey % 2 = 0 THEN ' ' ELSE NULL END AS id_agent
FROM {orders}""",
    # ticket times: ' às ' and plain separators parse, ' as ' does not; NULL finish
    "l_ticket_times": f"""
SELECT event_id AS id_ticket, user_id AS id_client,
 {_ts_text('opened')} AS opened_at,
 {_ts_text('started')} AS started_at,
 CASE WHEN event_id % 53 = 9 THEN NULL ELSE {_ts_text('finished')} END AS finished_at
FROM (SELECT event_id, user_id, ts AS opened, ts + INTERVAL '1' SECOND * ((user_id * 7 + event_id * 13) % 900) AS started,
 ts + INTERVAL '1' SECOND * ((user_id * 7 + event_id * 13) % 900 + 30 + event_id % 600) AS finished FROM {{events}}) e""",
    # costs: one record per line item; R$, reais, comma; n/a; >= 100 overflows
    # DECIMAL(12,10); duplicate ids (keep-latest by tie_1, tie_2, tie_3, cost_text)
    "l_costs": """
SELECT l_orderkey * 10 + l_linenumber AS id_cost, l_orderkey AS id_ticket,
 CASE WHEN l_suppkey % 31 = 1 THEN concat('R$ ', CAST(100 + l_partkey % 900 AS STRING), ',00')
      WHEN l_partkey % 4 = 0 THEN concat('R$ ', CAST(CAST(l_quantity AS BIGINT) AS STRING), ',', lpad(CAST(l_partkey % 100 AS STRING), 2, '0'))
      WHEN l_partkey % 4 = 1 THEN concat(CAST(CAST(l_quantity AS BIGINT) AS STRING), ',50 reais')
      WHEN l_partkey % 97 = 2 THEN 'n/a' ELSE CAST(CAST(l_quantity AS BIGINT) AS STRING) END AS cost_text,
 l_shipdate AS tie_1, l_partkey AS tie_2, l_suppkey AS tie_3
FROM {lineitem}""",
    # surveys: NULL, blank, out-of-range 9, 1-5
    "l_surveys": """
SELECT event_id + 1000000 AS id_survey, event_id AS id_ticket,
 CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 7 = 0 THEN ' ' WHEN event_id % 13 = 0 THEN '9' ELSE CAST(1 + user_id % 5 AS STRING) END AS score
FROM {events}""",
    # two daily batches of clients: changed region/age, deleted keys (in day 1
    # only), inserted keys (day 2 only), repaired e-mails, duplicated records
    "b_clients": """
SELECT id_client, client_name, email, 'OLD' AS region, age - 1 AS age, DATE '2024-02-01' AS batch_day FROM {l_clients} WHERE id_client % 4 <> 0
UNION ALL
SELECT id_client, client_name, CASE WHEN id_client % 19 = 7 AND id_client % 2 = 0 THEN concat('user', CAST(id_client AS STRING), '@mail.example.com') ELSE email END AS email,
 region, age, DATE '2024-02-02' AS batch_day FROM {l_clients} WHERE id_client % 3 <> 0 OR id_client % 4 = 0
UNION ALL
SELECT id_client, client_name, email, region, age, DATE '2024-02-02' AS batch_day FROM {l_clients} WHERE id_client % 50 = 1""",
}

LANDING = ["l_agents", "l_reasons", "l_channels", "l_clients", "l_tickets",
           "l_ticket_times", "l_costs", "l_surveys"]


def dependencies(name: str) -> list[str]:
    return sorted(set(re.findall(r"\{(\w+)\}", FIXTURE_SQL[name])))


def landing(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The landing DataFrame ``name`` derived from the tables in ``sf_dir``."""
    deps = {}
    for d in dependencies(name):
        deps[d] = read_table(spark, sf_dir, d) if d in TABLES else landing(spark, sf_dir, d)
    return spark.sql(FIXTURE_SQL[name], **deps)


def fixture_ctes(names: list[str]) -> list[tuple[str, str]]:
    """(name, SQL) pairs in dependency order, for the SQL oracle."""
    out: list[tuple[str, str]] = []

    def visit(n):
        if n in TABLES or any(n == x for x, _ in out):
            return
        for d in dependencies(n):
            visit(d)
        out.append((n, FIXTURE_SQL[n].format(**{d: d for d in dependencies(n)})))

    for n in names:
        visit(n)
    return out
