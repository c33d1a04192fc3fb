"""The worked star schema over one data directory, built lazily.

``Lake`` wires landing -> bronze -> silver -> gold for one ``sf_dir`` and
memoises each frame, so one query plan reuses the same sub-plans (Spark's
exchange reuse then computes a shared sub-plan once per query).

The single-batch bronze frames are stamped here with a known batch, so the
silver builders are given that batch explicitly (the reprocess path): the
filter folds to TRUE at plan time instead of running a max() subquery per
table. Stored bronze history goes through the latest-batch subquery
(``daily_load``).
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from callstar.plans import gold as G
from callstar.plans import silver as S
from callstar.sources import sinks
from callstar.sources.ingest import DEFAULT_BATCH, stamp, stamp_from
from callstar.sources.landing import landing, read_table


class Lake:
    def __init__(self, spark: SparkSession, sf_dir: str, batch_ts: str = DEFAULT_BATCH):
        self.spark = spark
        self.sf_dir = sf_dir
        self.batch_ts = batch_ts
        self._landing: dict[str, DataFrame] = {}

    # -- landing / bronze -------------------------------------------------
    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    def landing(self, name: str) -> DataFrame:
        if name not in self._landing:
            self._landing[name] = landing(self.spark, self.sf_dir, name)
        return self._landing[name]

    def bronze(self, name: str) -> DataFrame:
        if name == "b_clients":
            return stamp_from(self.landing(name), "batch_day", "landing.clientes")
        return stamp(self.landing(name), self.batch_ts, f"landing.{name}")

    # -- silver ------------------------------------------------------------
    @cached_property
    def agents(self) -> S.Silver:
        return S.silver_agent(self.bronze("l_agents"), batch=self.batch_ts)

    @cached_property
    def channels(self) -> S.Silver:
        return S.silver_channel(self.bronze("l_channels"), batch=self.batch_ts)

    @cached_property
    def clients(self) -> S.Silver:
        return S.silver_client(self.bronze("l_clients"), batch=self.batch_ts)

    @cached_property
    def times(self) -> S.Silver:
        return S.silver_ticket_times(self.bronze("l_ticket_times"), batch=self.batch_ts)

    @cached_property
    def costs(self) -> S.Silver:
        return S.silver_cost(self.bronze("l_costs"), batch=self.batch_ts)

    @cached_property
    def reasons(self) -> S.Silver:
        return S.silver_reason(self.bronze("l_reasons"), batch=self.batch_ts)

    @cached_property
    def surveys(self) -> S.Silver:
        return S.silver_survey(self.bronze("l_surveys"), batch=self.batch_ts)

    @cached_property
    def tickets(self) -> S.Silver:
        return S.silver_ticket(self.bronze("l_tickets"), self.reasons.valid(),
                               self.channels.valid(), self.times.valid(), batch=self.batch_ts)

    def all_silver(self) -> list[S.Silver]:
        return [self.agents, self.channels, self.clients, self.times, self.costs,
                self.reasons, self.surveys, self.tickets]

    # -- gold --------------------------------------------------------------
    @cached_property
    def dim_agent(self) -> DataFrame:
        return G.dim_agent(self.agents.valid())

    @cached_property
    def dim_channel(self) -> DataFrame:
        return G.dim_channel(self.channels.valid())

    @cached_property
    def dim_client(self) -> DataFrame:
        return G.dim_client(self.clients.valid())

    @cached_property
    def dim_reason(self) -> DataFrame:
        return G.dim_reason(self.reasons.valid())

    @cached_property
    def dim_ticket(self) -> DataFrame:
        return G.dim_ticket(self.tickets.valid())

    @cached_property
    def fact_service(self) -> DataFrame:
        return G.fact_service(self.tickets.valid(), self.times.valid(),
                              self.costs.valid(), self.surveys.valid())

    @cached_property
    def fact_cost(self) -> DataFrame:
        return G.fact_cost(self.tickets.valid(), self.costs.valid())

    @cached_property
    def fact_agent(self) -> DataFrame:
        return G.fact_agent(self.tickets.valid(), self.surveys.valid())


class StoredLake:
    """The star schema as the daily load stored it: the same frames as ``Lake``, read from the gold tables."""

    TABLES = {"dim_agent": "dm_atendente", "dim_channel": "dm_canal", "dim_client": "dm_cliente", "dim_reason": "dm_motivo",
              "dim_ticket": "dm_chamado", "fact_service": "ft_atendimento_geral", "fact_cost": "ft_custo_operacional",
              "fact_agent": "ft_performance_agente"}

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def __getattr__(self, name: str) -> DataFrame:
        if name not in self.TABLES:
            raise AttributeError(name)
        df = sinks.read_current(self.spark, sinks.table_path(self.spark, "gold", self.TABLES[name]))
        if df is None:
            raise RuntimeError(f"{self.TABLES[name]} has not been loaded yet")
        return df
