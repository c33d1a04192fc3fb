"""Normalisers: one case per documented trap."""
from decimal import Decimal

from pyspark.sql import functions as F

from callstar.functions import keys as K
from callstar.functions import normalize as N


def one(spark, col, value, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(col.alias("y")).first()["y"]


def test_channel_fold_examples(spark):
    for raw, want in [("chat bot", "CHATBOT"), ("ChatBot", "CHATBOT"), ("Chatbot", "CHATBOT"),
                      ("U.R.A", "URA"), ("ura", "URA"), ("u.r.a.", "URA"), ("atend. inicial", "ATENDIMENTO INICIAL"),
                      ("U R A", "U R A")]:
        assert one(spark, N.canonical_channel("x"), raw) == want, raw


def test_reason_fold_is_ordered_and_tolerates_broken_accent(spark):
    assert one(spark, N.repair_reason("x"), "Card bl?ck") == "Card block"
    assert one(spark, N.repair_reason("x"), "card blck") == "Card block"
    assert one(spark, N.repair_reason("x"), "Address data change (phone)") == "Address data change"


def test_email_alias(spark):
    assert one(spark, N.strip_email_alias("x"), "user+alias@domain.com") == "user@domain.com"
    assert one(spark, N.strip_email_alias("x"), "plain@domain.com") == "plain@domain.com"


def test_money(spark):
    assert one(spark, N.money("x"), "R$ 1,50") == Decimal("1.5")
    assert one(spark, N.money("x"), "2,50 reais") == Decimal("2.5")
    assert one(spark, N.money("x"), "100,00") is None          # DECIMAL(12,10) overflow
    assert one(spark, N.money("x"), "1.234,56") is None
    assert one(spark, N.money("x"), "n/a") is None


def test_dirty_timestamp(spark):
    assert str(one(spark, N.dirty_timestamp("x"), "01/02/2024 às 10:11:12")) == "2024-02-01 10:11:12"
    assert str(one(spark, N.dirty_timestamp("x"), "01/02/2024 10:11:12")) == "2024-02-01 10:11:12"
    assert one(spark, N.dirty_timestamp("x"), "01/02/2024 as 10:11:12") is None
    assert one(spark, N.dirty_timestamp("x"), "31/02/2024 10:11:12") is None
    assert one(spark, N.dirty_timestamp("x"), "1/2/2024 10:11:12") is None


def test_status_and_yes_no(spark):
    assert one(spark, N.status_flag("x"), "ATIVO") is True
    assert one(spark, N.status_flag("x"), "invativo") is False
    assert one(spark, N.status_flag("x"), " ativo") is None       # not trimmed
    assert one(spark, N.yes_no("x"), "Não") is False
    assert one(spark, N.yes_no("x"), "sim") is True
    assert one(spark, N.yes_no("x"), " SIM") is None


def test_category_first_match_wins(spark):
    assert one(spark, N.category("x"), "Card invoice problem") == "CARTAO"
    assert one(spark, N.category("x"), "Other matter") == "NAO CLASSIFICADO"
    for raw, want in [("Alteração de dados cadastrais (vencimento da fatura, telefone, email)", "CADASTRAL"), ("Bloqueio de cartão", "CARTAO"),
                      ("Transferência de agência", "CADASTRAL"), ("Compra não autorizada", "CARTAO"), ("Contestação de fatura", "FINANCEIRO"),
                      ("Renegociação de dívida", "FINANCEIRO"), ("Problema com aplicativo", "ATENDIMENTO"), ("SUPORTE TÉCNICO", "ATENDIMENTO"),
                      ("Dúvidas gerais sobre programa de pontos", "BENEFICIOS"), ("Contratação de cartão adicional", "CARTAO"),
                      ("Cancelamento de cartão", "CADASTRAL"), ("Limite do contrato", "FINANCEIRO"), ("transferencia", "NAO CLASSIFICADO"), ("", "NAO CLASSIFICADO")]:
        assert one(spark, N.category("x"), raw) == want, raw
    assert one(spark, N.category("x"), None) == "NAO CLASSIFICADO"


def test_criticality(spark):
    assert one(spark, N.criticality("x"), " média ") == "MEDIA"
    assert one(spark, N.criticality("x"), "Alta ") == "ALTA"
    assert one(spark, N.criticality("x"), "urgente") is None


def test_blank_to_null_and_safe_casts(spark):
    assert one(spark, N.to_number("x", "smallint"), " ") is None
    assert one(spark, N.to_number("x", "smallint"), "4.6") is None   # never throws under ANSI
    assert one(spark, N.to_number("x", "smallint"), "abc") is None
    assert one(spark, N.to_number("x", "smallint"), "3") == 3


def test_keys(spark):
    assert one(spark, K.pseudonym("x"), None) is None
    assert len(one(spark, K.pseudonym("x"), "42")) == 64
    assert one(spark, K.key60("x"), "abc") == 648541476951500027
    a = one(spark, K.surrogate(F.lit("1"), F.lit("23")), None)
    b = one(spark, K.surrogate(F.lit("12"), F.lit("3")), None)
    assert a != b


def test_murmur_key_matches_spark_hash_and_never_overflows(spark):
    df = spark.createDataFrame([(" Chatbot ",), ("chatbot",), (None,)], "x string")
    got = [r["k"] for r in df.select(K.murmur_key("x").alias("k")).collect()]
    expected = spark.sql("SELECT abs(CAST(hash('chatbot') AS BIGINT)) AS k").first()["k"]
    assert got[0] == got[1] == expected
    assert got[2] == 42
    assert all(0 <= k < 2 ** 31 + 1 for k in got)
