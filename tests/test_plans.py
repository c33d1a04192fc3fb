"""Plan shape: the properties the scale design relies on."""
from pyspark.sql import functions as F

from callstar.operators.dedup import keep_latest
from callstar.plans.lake import Lake


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_keep_latest_limits_before_shuffle_with_hot_key(spark):
    # one key holds a third of the rows
    df = spark.range(0, 30000).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
                                      F.col("id").alias("ts"))
    out = keep_latest(df, ["k"], ["ts"])
    plan = _plan(out)
    partial = plan.index("WindowGroupLimit", plan.index("Exchange"))
    assert "Partial" in plan[partial:partial + 400]
    assert out.filter(F.col("k") == 0).first()["ts"] == 29997
    assert out.count() == 20001


def test_scan_prunes_columns(spark, sf_small):
    lake = Lake(spark, sf_small)
    plan = lake.tickets.valid().select("cd_chamado")._jdf.queryExecution().executedPlan().toString()
    # the orders scan reads only the columns the ticket derivation uses
    assert "o_totalprice" not in plan and "o_orderpriority" not in plan


def test_kpis_join_dimensions_after_aggregating(spark, sf_small):
    """With broadcasts off, no exchange of fact rows on a dimension key: each such exchange carries an aggregate."""
    import re

    from callstar.plans import kpi
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        lake = Lake(spark, sf_small)
        for frame in (kpi.waste(lake), kpi.cost_by_reason(lake), kpi.wait_by_channel_type(lake), kpi.overflow_rate(lake), kpi.resolution_by_channel(lake)):
            lines = _plan(frame).split("\n")
            for i, line in enumerate(lines):
                keys = re.search(r"Exchange hashpartitioning\((cd_motivo|cd_canal)#", line)
                if keys and "vl_custo" not in "".join(lines[i:i + 2]):
                    below = next(x for x in lines[i + 1:] if re.search("Aggregate|Join|Scan|Window", x))
                    assert re.search("Aggregate|Window|Join", below), (line, below)
            assert re.search(r"HashAggregate\(keys=\[(cd_motivo|cd_canal)#", _plan(frame))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
