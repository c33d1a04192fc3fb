"""Typed house schemas: by-name enforcement, bronze extension, bootstrap."""
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callstar.plans import schemas
from callstar.sources.ingest import bronze_schema


def test_enforce_reorders_and_casts(spark):
    df = spark.createDataFrame([("x", 7, 2)], "nm_atendente string, cd_atendente int, nu_nivel int")
    df = df.withColumn("dt_ingestion", F.current_timestamp()).withColumn("dc_origem", F.lit("t"))
    out = schemas.enforce(df, schemas.SILVER["tb_atendente"])
    assert out.columns[:3] == ["cd_atendente", "nm_atendente", "nu_nivel"]
    assert dict(out.dtypes)["nu_nivel"] == "smallint"


def test_enforce_fails_on_missing_column(spark):
    df = spark.createDataFrame([(1,)], "cd_atendente long")
    with pytest.raises(Exception):
        schemas.enforce(df, schemas.SILVER["tb_atendente"]).collect()


def test_bronze_schema_adds_lineage(spark, sf_small):
    s = spark.read.parquet(f"{sf_small}/supplier.parquet").schema  # metadata only, no scan
    b = bronze_schema(s)
    assert b.fieldNames()[-2:] == ["ingestion_timestamp", "origem"]
    assert isinstance(b["ingestion_timestamp"].dataType, T.TimestampType)


def test_layer_bootstrap_is_idempotent(spark):
    assert sorted(schemas.ensure_databases(spark)) == sorted(schemas.LAYERS)
    assert sorted(schemas.ensure_databases(spark)) == sorted(schemas.LAYERS)


def test_varchar_limit_raises(spark):
    df = spark.createDataFrame([(1, "x" * 51, True)], "cd_canal long, nm_canal string, st_ativo boolean")
    df = df.withColumn("dt_ingestion", F.current_timestamp()).withColumn("dc_origem", F.lit("t"))
    with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH"):
        schemas.enforce(df, schemas.SILVER["tb_canal"]).collect()
    ok = df.withColumn("nm_canal", F.lit("URA"))
    assert schemas.enforce(ok, schemas.SILVER["tb_canal"]).count() == 1


def test_create_if_absent_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "tb_canal")
    assert schemas.create_if_absent(spark, path, schemas.SILVER["tb_canal"]) is True
    assert schemas.create_if_absent(spark, path, schemas.SILVER["tb_canal"]) is False
    assert spark.read.parquet(path).count() == 0
