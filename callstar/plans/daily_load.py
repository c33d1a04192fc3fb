"""Daily load: landing -> bronze -> silver -> gold -> views, with writes.

Every hop reads the previous layer from storage, so lineage is cut at each
layer by a written table in the shared warehouse folder (never by a local
checkpoint): a lost executor only recomputes the current hop.

* bronze: the stamped batch is one partition, replaced if it is loaded again;
  silver reads exactly that partition, with the landing table's schema;
* silver: compute the flagged frame once, write it split by verdict, then
  upsert the valid side into the bucketed table (range buckets for tables
  keyed by increasing ids, hash buckets otherwise; only touched buckets are
  rewritten) and overwrite the audit table with the rejected side;
  lookups (reason, channel, ticket times) are built before tickets;
* tickets also follow what arrives late: raw tickets whose reason or channel
  was unknown wait in a pending table and are tried again with every batch, and
  stored tickets whose times arrive or change get their durations anew;
* gold: per-ticket tables (service fact, cost fact, ticket dimension) are
  recomputed only for the tickets the batch touched, the per-agent fact for
  the agents of those tickets, and replaced (only touched partitions are
  rewritten, including the old date of a ticket whose date moved); costs and
  surveys, which are stored by their own ids, are read through an index from
  ticket to bucket, the facts through one from ticket to date; the aggregate
  facts take the difference; the small dimensions are rebuilt as versioned
  tables;
* views: one published view per gold table.

A table that fails at any hop is reported with its error and keeps its stored
state; the others go on.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callstar.operators.quality import OK, VERDICT
from callstar.plans import aggregates
from callstar.plans import gold as G
from callstar.plans import schemas
from callstar.plans import silver as S
from callstar.session import load_conf, side_by_side
from callstar.sources import sinks
from callstar.sources.ingest import BATCH_COL, PART_COL, STAMP_COL, WITHDRAWN, append_batch, batch_id, bronze_schema, read_batches, stamp

# landing name -> (silver table, key, builder)
SILVER_PLAN = [
    ("l_agents", "tb_atendente", ["cd_atendente"], S.silver_agent),
    ("l_channels", "tb_canal", ["cd_canal"], S.silver_channel),
    ("l_clients", "tb_cliente", ["cd_cliente"], S.silver_client),
    ("l_ticket_times", "tb_chamado_log", ["cd_chamado"], S.silver_ticket_times),
    ("l_costs", "tb_custo_chamado", ["cd_custo"], S.silver_cost),
    ("l_reasons", "tb_motivo", ["cd_motivo"], S.silver_reason),
    ("l_surveys", "tb_pesquisa", ["cd_pesquisa"], S.silver_survey),
]
# stored reason/channel tables are broadcast only when proven this small
LOOKUP_BROADCAST_BYTES = 32 << 20
# large gold tables: partition column for touched-partition upserts
GOLD_PARTITION = {"ft_atendimento_geral": "dt_referencia", "ft_custo_operacional": "dt_referencia",
                  "dm_chamado": sinks.BUCKET_COL}
# gold tables with one row per ticket (or per cost of a ticket): recomputed
# only for the tickets a batch touched
PER_TICKET = {"dm_chamado", "ft_atendimento_geral", "ft_custo_operacional"}
TICKET_TABLES = ("tb_chamado", "tb_chamado_log", "tb_custo_chamado", "tb_pesquisa")
GOLD_KEYS = {
    "dm_atendente": ["cd_atendente"], "dm_canal": ["cd_canal"], "dm_cliente": ["cd_cliente"],
    "dm_motivo": ["cd_motivo"], "dm_chamado": ["cd_chamado"],
    "ft_atendimento_geral": ["cd_chamado"], "ft_custo_operacional": ["pk_custo"],
    "ft_performance_agente": ["cd_atendente"],
}


# silver tables of a ticket's rows that are stored by their own id, with an index from ticket to bucket
INDEXED = ("tb_custo_chamado", "tb_pesquisa")
# silver tables keyed by ever-increasing ids: range buckets (a daily batch of
# new records touches only the newest buckets); the others: hash buckets
RANGE_BUCKETED = {"tb_chamado", "tb_chamado_log", "tb_custo_chamado", "tb_pesquisa"}


def _bucket(spark: SparkSession, table: str, keys: list[str]):
    """Bucket expression of a silver table and the layout to keep with it (deployment settings at its creation)."""
    if table in RANGE_BUCKETED and len(keys) == 1:
        width = _width(spark)
        return sinks.range_bucket(keys[0], width), f"range {keys[0]} {width}"
    n = int(spark.conf.get("callstar.silver.buckets", "16"))
    return sinks.hash_bucket(keys, n), f"hash {' '.join(keys)} {n}"


def _width(spark: SparkSession) -> int:
    """Ticket ids of a range bucket, also in the indexes."""
    return int(spark.conf.get("callstar.silver.range_width", "100000"))


def _index(spark: SparkSession, layer: str, table: str) -> str:
    return sinks.table_path(spark, layer, f"_index_{table}")


def _note_places(spark: SparkSession, layer: str, table: str, rows: DataFrame, place: str) -> None:
    """Bring the index of a table up to ``rows``; built from the whole table where an older load left none."""
    path, index = sinks.table_path(spark, layer, table), _index(spark, layer, table)
    if not sinks._has_data(spark, index) and sinks._has_data(spark, path):
        sinks.index_add(spark, index, spark.read.parquet(path), "cd_chamado", place, _width(spark))
    sinks.index_add(spark, index, rows, "cd_chamado", place, _width(spark))


def _tickets_places(spark: SparkSession, layer: str, table: str, tickets: DataFrame, place: str) -> list[str | None]:
    """Partitions of an indexed table in which rows of ``tickets`` may live."""
    path = sinks.table_path(spark, layer, table)
    if not sinks._has_data(spark, _index(spark, layer, table)) and sinks._has_data(spark, path):
        sinks.index_add(spark, _index(spark, layer, table), spark.read.parquet(path), "cd_chamado", place, _width(spark))
    return sinks.places(spark, _index(spark, layer, table), tickets, _width(spark))


def _tickets_rows(spark: SparkSession, layer: str, table: str, tickets: DataFrame, place: str, found: list[str | None] | None = None) -> DataFrame | None:
    """Stored rows of ``tickets`` (cd_chamado), from the partitions they live in (``found``, where a caller has looked them up)."""
    path = sinks.table_path(spark, layer, table)
    if place == sinks.BUCKET_COL and table not in INDEXED:  # stored by ticket
        rows = sinks.in_buckets(spark, path, tickets.select(sinks.range_bucket("cd_chamado", _width(spark))))
        return None if rows is None else rows.join(tickets, "cd_chamado", "left_semi")
    return sinks.rows_of(spark, path, _tickets_places(spark, layer, table, tickets, place) if found is None else found, tickets, place)


def _current(spark: SparkSession, layer: str, table: str) -> DataFrame | None:
    return sinks.read_current(spark, sinks.table_path(spark, layer, table))


def _staging(spark: SparkSession, table: str, batch_ts: str) -> str:
    return sinks.table_path(spark, "_staging", f"{table}/batch={batch_id(batch_ts)}")


def load_bronze(spark: SparkSession, landing: dict[str, DataFrame], batch_ts: str) -> DataFrame:
    """Write every landing table's batch; one status row per table (errors isolated, in full)."""
    rows = []
    sinks._delete(spark, sinks.table_path(spark, "bronze", f"{WITHDRAWN}/{batch_id(batch_ts)}"))  # a batch loaded again counts again
    for name, df in landing.items():
        try:
            append_batch(stamp(df, batch_ts, f"landing.{name}"), sinks.table_path(spark, "bronze", name), batch_ts)
            rows.append((name, "LOADED", None))
        except Exception as e:  # one bad table must not stop the others
            rows.append((name, "FAILED", str(e)))
    return spark.createDataFrame(rows, "table_name string, status string, error string")


def bronze_batch(spark: SparkSession, name: str, schema: T.StructType, batch_ts: str) -> DataFrame:
    """Bronze rows of one batch (daily and streamed parts), by a static partition filter."""
    df = read_batches(spark, sinks.table_path(spark, "bronze", name), bronze_schema(schema))
    return df.filter(F.col(BATCH_COL) == batch_id(batch_ts)).drop(BATCH_COL, PART_COL)


def _publish_silver(spark: SparkSession, s: S.Silver, table: str, keys: list[str], batch_ts: str) -> tuple[DataFrame, DataFrame]:
    valid, rejected = sinks.write_flagged(s.flagged, _staging(spark, table, batch_ts))
    if table in INDEXED:
        _note_moved(spark, table, keys[0], valid, batch_ts)
    store_silver(spark, table, keys, valid)
    store_audit(spark, S.Silver(s.name, rejected, s.columns, s.rules), table)
    return valid, rejected


def store_silver(spark: SparkSession, table: str, keys: list[str], valid: DataFrame, remove: DataFrame | None = None) -> None:
    """Upsert valid rows (read from staged files) into a silver table; rows whose key is in ``remove`` go."""
    path = sinks.table_path(spark, "silver", table)
    sinks.recover(spark, path)
    bucket, layout = _bucket(spark, table, keys)
    typed = schemas.enforce(valid, schemas.SILVER[table])
    if table in INDEXED:
        _note_places(spark, "silver", table, typed.withColumn(sinks.BUCKET_COL, bucket), sinks.BUCKET_COL)
    sinks.upsert_partitioned(typed, path, keys, sinks.BUCKET_COL, bucket, key_determines_partition=True, layout=layout, remove=remove, stored=True,
                             live=None if remove is None else [r[0] for r in remove.select(bucket.cast("string")).distinct().collect()])


def store_audit(spark: SparkSession, rejected: S.Silver, table: str) -> None:
    """Overwrite the audit table with the rejected rows of ``rejected.flagged``."""
    audit = S.reason_rejects(rejected) if table == "tb_motivo" else rejected.flagged
    audit = schemas.enforce(audit, schemas.AUDIT[f"{table}_invalidos"])
    sinks.overwrite(audit, sinks.table_path(spark, "silver", f"{table}_invalidos"))


def _note_moved(spark: SparkSession, table: str, key: str, valid: DataFrame, batch_ts: str) -> None:
    """Tickets that the stored rows of the batch's costs or surveys belong to before the batch: their facts change too."""
    bucket, _ = _bucket(spark, table, [key])
    stored = sinks.in_buckets(spark, sinks.table_path(spark, "silver", table), valid.select(bucket))
    if stored is not None:
        moved = stored.join(valid.select(key), key, "left_semi").select("cd_chamado").distinct()
        moved.write.mode("append").option("compression", sinks.CODEC).parquet(_staging(spark, f"{table}_moved", batch_ts))


def _load_tickets(spark: SparkSession, schema: T.StructType, batch_ts: str) -> None:
    """Tickets of the batch and those still pending; then late times of stored tickets."""
    raw = bronze_batch(spark, "l_tickets", schema, batch_ts)
    pending_path = sinks.table_path(spark, "silver", "_pending_tickets")
    pending = sinks.read_current(spark, pending_path)
    if pending is not None:
        raw = raw.unionByName(pending)  # keep-latest prefers the batch's own record of a ticket
    need = {t: _current(spark, "silver", t) for t in ("tb_motivo", "tb_canal", "tb_chamado_log")}
    missing = [t for t, df in need.items() if df is None]
    if missing:
        raise RuntimeError(f"tickets need {', '.join(missing)}, which no batch has loaded yet")
    tickets = S.silver_ticket(raw, need["tb_motivo"], need["tb_canal"], need["tb_chamado_log"],
                              lookup_max_bytes=LOOKUP_BROADCAST_BYTES, selected=True)
    # a pending ticket keeps its own stamp; the newest record of a ticket wins
    _, rejected = _publish_silver(spark, tickets, "tb_chamado", ["cd_chamado"], batch_ts)
    waiting = rejected.filter(F.col("cd_chamado").isNotNull() & ~(F.col("flag_fk_motivo_valida") & F.col("flag_fk_canal_valida"))).select("cd_chamado")
    number = S._num(raw, "id_ticket", "bigint")
    still = raw.withColumn("_id", number).join(waiting, F.col("_id") == F.col("cd_chamado"), "left_semi").drop("_id")
    sinks.replace_table(still, pending_path)
    sinks.vacuum_versions(spark, pending_path, keep=2)

    # stored tickets whose times this batch brought: durations anew
    if not sinks._exists(spark, _staging(spark, "tb_chamado_log", batch_ts)):
        return
    late = (spark.read.schema("cd_chamado bigint, flag_qualidade string").parquet(_staging(spark, "tb_chamado_log", batch_ts))
            .filter(F.col(VERDICT) == OK).select("cd_chamado").distinct())
    bucket, layout = _bucket(spark, "tb_chamado", ["cd_chamado"])
    path = sinks.table_path(spark, "silver", "tb_chamado")
    stored = sinks.in_buckets(spark, path, late.select(bucket))
    if stored is None:
        return
    old = stored.join(late, "cd_chamado", "left_semi")
    was = {"_espera": F.col("tm_espera"), "_duracao": F.col("tm_duracao")}
    new = S.with_durations(old.withColumns(was), need["tb_chamado_log"].join(late, "cd_chamado", "left_semi"))
    same = F.col("tm_espera").eqNullSafe(F.col("_espera")) & F.col("tm_duracao").eqNullSafe(F.col("_duracao"))
    sinks.upsert_partitioned(schemas.enforce(new.filter(~same).select(old.columns), schemas.SILVER["tb_chamado"]), path, ["cd_chamado"],
                             sinks.BUCKET_COL, bucket, key_determines_partition=True, layout=layout)


def load_silver(spark: SparkSession, landing: dict[str, T.StructType], batch_ts: str) -> dict[str, str]:
    """Silver for exactly the batch just loaded (``landing``: the tables that bronze took, with their schemas).

    Returns the error of each silver table that failed; it keeps its stored rows.
    """
    def publish_table(name, table, keys, build):
        return lambda: _publish_silver(spark, build(bronze_batch(spark, name, landing[name], batch_ts), batch=batch_ts), table, keys, batch_ts)

    done = side_by_side({table: publish_table(name, table, keys, build) for name, table, keys, build in SILVER_PLAN if name in landing}, spark)
    if "l_tickets" in landing:  # they look the others up
        done |= side_by_side({"tb_chamado": lambda: _load_tickets(spark, landing["l_tickets"], batch_ts)}, spark)
    return {table: str(e) for table, e in done.items() if isinstance(e, Exception)}


def touched_tickets(spark: SparkSession, batch_ts: str) -> DataFrame:
    """Ticket ids whose silver rows this batch inserted or replaced: the
    valid side of the batch's staged tickets, times, costs and surveys."""
    out = None
    for table in TICKET_TABLES:
        if not sinks._exists(spark, _staging(spark, table, batch_ts)):
            continue  # it brought nothing, or failed
        staged = spark.read.schema("cd_chamado bigint, flag_qualidade string").parquet(_staging(spark, table, batch_ts))
        ids = staged.filter(F.col("flag_qualidade") == "OK").select("cd_chamado")
        out = ids if out is None else out.unionByName(ids)
        if sinks._exists(spark, _staging(spark, f"{table}_moved", batch_ts)):
            out = out.unionByName(spark.read.schema("cd_chamado bigint").parquet(_staging(spark, f"{table}_moved", batch_ts)))
    if out is None:
        return spark.createDataFrame([], "cd_chamado bigint")
    return out.filter(F.col("cd_chamado").isNotNull()).distinct()


def load_gold(spark: SparkSession, batch_ts: str | None = None, touched: DataFrame | None = None, replace: bool = False) -> dict[str, str]:
    """Dimensions and facts from current silver; returns the error of each table that failed.

    With ``batch_ts`` and an existing gold layer, the per-ticket tables are
    recomputed only for the tickets the batch touched (each with all of its
    silver rows) and take the place of those tickets' stored rows; the
    per-agent fact for their agents (those before and after the batch).
    Untouched dates and buckets are neither read nor rewritten. ``touched``
    names the tickets instead of a batch. The small dimensions are rebuilt
    whole: upserted, or with ``replace`` put in place of what was stored.
    """
    def silver(t):
        df = _current(spark, "silver", t)
        if df is None:
            raise RuntimeError(f"{t} has not been loaded yet")
        return df

    for t in GOLD_KEYS:
        sinks.recover(spark, sinks.table_path(spark, "gold", t))
    incremental = (touched is not None or batch_ts is not None) and _current(spark, "gold", "ft_atendimento_geral") is not None
    if incremental:
        ids = (touched_tickets(spark, batch_ts) if touched is None else touched).select("cd_chamado")
        staged = _staging(spark, "touched", batch_ts or "given")
        sinks.overwrite(ids, staged)
        touched = spark.read.schema("cd_chamado bigint").parquet(staged)
    else:
        touched = None

    # looked up once for all the tables that are computed from them
    stored = side_by_side({t: (lambda t=t: _tickets_rows(spark, "silver", t, touched, sinks.BUCKET_COL)) for t in TICKET_TABLES}, spark) if incremental else {}

    def tickets_of(t):
        if not incremental:
            return silver(t)
        if isinstance(stored[t], Exception):
            raise stored[t]
        return silver(t).limit(0) if stored[t] is None else stored[t]

    moved = None
    if incremental:  # agents of the touched tickets, before and after
        before = _tickets_rows(spark, "gold", "ft_atendimento_geral", touched, "dt_referencia").select("cd_atendente")
        now = tickets_of("tb_chamado").select("cd_atendente")
        path = _staging(spark, "moved_agents", batch_ts or "given")
        sinks.overwrite(before.unionByName(now).filter("cd_atendente is not null").distinct(), path)
        moved = spark.read.schema("cd_atendente bigint").parquet(path)

    def agents():
        tickets, surveys = silver("tb_chamado"), silver("tb_pesquisa")
        return G.fact_agent(tickets if moved is None else tickets.join(moved, "cd_atendente", "left_semi"), surveys)

    outputs: dict[str, Callable[[], DataFrame]] = {
        "ft_performance_agente": agents,
        "dm_atendente": lambda: G.dim_agent(silver("tb_atendente")),
        "dm_canal": lambda: G.dim_channel(silver("tb_canal")),
        "dm_cliente": lambda: G.dim_client(silver("tb_cliente")),
        "dm_motivo": lambda: G.dim_reason(silver("tb_motivo")),
        "dm_chamado": lambda: G.dim_ticket(tickets_of("tb_chamado")),
        "ft_atendimento_geral": lambda: G.fact_service(*(tickets_of(t) for t in TICKET_TABLES)),
        "ft_custo_operacional": lambda: G.fact_cost(tickets_of("tb_chamado"), tickets_of("tb_custo_chamado")),
    }
    def store(name, build):
        typed, path = schemas.enforce(build(), schemas.GOLD[name]), sinks.table_path(spark, "gold", name)
        if name == "dm_chamado":
            bucket, layout = _bucket(spark, "tb_chamado", ["cd_chamado"])
            live = None if touched is None else [r[0] for r in touched.select(bucket.cast("string")).distinct().collect()]
            sinks.upsert_partitioned(typed, path, GOLD_KEYS[name], sinks.BUCKET_COL, bucket,
                                     key_determines_partition=True, layout=layout, remove=touched, live=live)
        elif name in GOLD_PARTITION:
            _store_fact(spark, name, typed, touched, batch_ts)
        else:
            if name == "ft_performance_agente" or not replace:
                sinks.upsert_table(typed, path, GOLD_KEYS[name], remove=moved if name == "ft_performance_agente" else None)
            else:
                sinks.replace_table(typed, path)
            sinks.vacuum_versions(spark, path, keep=2)

    done = side_by_side({name: (lambda n=name, b=build: store(n, b)) for name, build in outputs.items()}, spark)
    return {name: str(e) for name, e in done.items() if isinstance(e, Exception)}


def _store_fact(spark: SparkSession, name: str, rows: DataFrame, touched: DataFrame | None, batch_ts: str | None) -> None:
    """Replace the touched tickets' rows of a fact, and carry the difference into the aggregates kept from it, in one commit."""
    path, place = sinks.table_path(spark, "gold", name), GOLD_PARTITION[name]
    staged = _staging(spark, f"{name}_rows", batch_ts or "given")
    sinks.overwrite(rows, staged)
    rows = spark.read.schema(rows.schema).parquet(staged)
    tickets = rows.select("cd_chamado").distinct() if touched is None else touched
    live = _tickets_places(spark, "gold", name, tickets, place)
    before = _tickets_rows(spark, "gold", name, tickets, place, live)
    live = None if before is None else live
    _note_places(spark, "gold", name, rows, place)
    swaps = [sinks.prepare_upsert(rows, path, GOLD_KEYS[name], place, remove=None if before is None else tickets, live=live,
                                  stored=True, replaces=before is not None)]  # the keys of both facts hold the ticket
    for kept in aggregates.KEPT:
        if kept.fact == name:
            known = kept.read(spark) is not None
            delta = kept.delta(before if known else None, rows)
            if before is not None and not known:  # facts stored before the aggregate was: all of them count
                whole = spark.read.parquet(path)
                delta = kept.delta(None, whole.join(tickets, "cd_chamado", "left_anti").select(rows.columns).unionByName(rows))
            changes = _staging(spark, f"{kept.name}_delta", batch_ts or "given")
            sinks.overwrite(delta, changes)
            swaps.append(kept.prepare(spark, spark.read.schema(kept.schema).parquet(changes)))
    sinks.commit(spark, swaps)


def publish(spark: SparkSession) -> list[str]:
    """A view for each gold table that exists."""
    views = {f"vw_{t}": _current(spark, "gold", t) for t in GOLD_KEYS}
    views = {n: df for n, df in views.items() if df is not None}
    sinks.publish_views(spark, views)
    return sorted(views)


def recover(spark: SparkSession) -> int:
    """Finish what an earlier run left half swapped, in all stored tables."""
    tables = [("silver", t) for t in ("tb_chamado", *(t for _, t, _, _ in SILVER_PLAN))] + [("gold", t) for t in (*GOLD_KEYS, *(k.name for k in aggregates.KEPT))]
    return sum(sinks.recover(spark, sinks.table_path(spark, layer, t)) for layer, t in tables)


def layer_status(spark: SparkSession) -> DataFrame:
    """Post-run check: every gold table exists and holds rows."""
    rows = []
    for t in GOLD_KEYS:
        df = _current(spark, "gold", t)
        rows.append((t, df is not None, df is not None and df.limit(1).count() > 0))
    return spark.createDataFrame(rows, "table_name string, exists boolean, loaded boolean")


def run(spark: SparkSession, landing: dict[str, DataFrame], batch_ts: str) -> DataFrame:
    """One daily run: a row per landing table (as its silver table) and gold table with
    layer, status (LOADED, FAILED), error and, for silver, the counts read back from storage."""
    with load_conf(spark):
        recover(spark)
        bronze = {r["table_name"]: r for r in load_bronze(spark, landing, batch_ts).collect()}  # a row per table
        loaded = {n: df.schema for n, df in landing.items() if bronze[n]["status"] == "LOADED"}
        silver_errors = load_silver(spark, loaded, batch_ts)
        gold_errors = load_gold(spark, batch_ts)
        publish(spark)
    names = [(n, t) for n, t, _, _ in SILVER_PLAN] + [("l_tickets", "tb_chamado")]
    rows, counts = [], None
    for name, table in names:
        error = silver_errors.get(table) or (bronze[name]["error"] if name in bronze else "no landing table")
        rows.append((table, "silver", "FAILED" if error else "LOADED", error))
        if not error:
            staging = spark.read.schema("flag_qualidade string").parquet(_staging(spark, table, batch_ts))
            part = staging.agg(F.count_if(F.col("flag_qualidade") == "OK").alias("valid_rows"),
                               F.count_if(F.col("flag_qualidade") != "OK").alias("rejected_rows"))
            part = part.select(F.lit(table).alias("table_name"), "valid_rows", "rejected_rows")
            counts = part if counts is None else counts.unionByName(part)
    rows += [(t, "gold", "FAILED" if t in gold_errors else "LOADED", gold_errors.get(t)) for t in GOLD_KEYS]
    status = spark.createDataFrame(rows, "table_name string, layer string, status string, error string")
    if counts is None:
        counts = spark.createDataFrame([], "table_name string, valid_rows bigint, rejected_rows bigint")
    return (status.join(counts, "table_name", "left").withColumn("batch", F.lit(batch_ts))
            .withColumn(STAMP_COL, F.to_timestamp(F.lit(batch_ts))))
