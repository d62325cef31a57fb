"""Edge cases of the operators behind the domain reports: nulls, repeats, empty sides."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerly.operators import agg as G
from ledgerly.operators import joins as J
from ledgerly.operators import rules as R
from ledgerly.plans.finance import FinanceRules, redemptions


def test_unused_flagged_equals_unused(spark):
    x = spark.createDataFrame([(1, True), (1, False), (2, False), (2, None), (None, False), (3, False), (3, False)], "k int, u boolean")
    want = sorted(tuple(r) for r in J.unused(x.select("k"), "k", x.where("u").select("k")).collect())
    got = sorted((r.k,) for r in J.unused_flagged(x, "k", F.col("u")).collect())
    assert got == want == [(2,), (2,), (3,), (3,)]


def test_online_split_fallback_negative_class_and_null_method(spark):
    pay = spark.createDataFrame([("a", R.ONLINE_METHOD, Decimal("100.00")), ("b", R.ONLINE_METHOD, Decimal("50.00")),
                                 ("c", R.ONLINE_METHOD, Decimal("0.00")), ("a", None, Decimal("7.00"))], "m string, pay_method string, v decimal(18,2)")
    online = spark.createDataFrame([("a", "pix", Decimal("30")), ("a", "credit", Decimal("60")), ("a", "other", Decimal("-30"))],
                                   "m string, c string, amt decimal(18,2)")
    got = {(r.m, r.pay_method): r.v for r in G.split_online(pay, online, ["m"], "pay_method", "v", "c", "amt", R.ONLINE_METHOD,
                                                            R.ONLINE_LABELS, "Mercado Pago - Outro").collect()}
    assert got == {("a", None): 7.0, ("a", "Mercado Pago - Pix"): 50.0, ("a", "Mercado Pago - Cartão Crédito"): 100.0,
                   ("b", "Mercado Pago - Outro"): 50.0}


def test_redemptions_window_sign_and_null_texts(spark):
    d = dt.date
    bank = spark.createDataFrame([
        (d(2026, 6, 30), "INVESTIMENTO", "Resgate", None, Decimal("10.00")), (d(2026, 6, 1), "PIX", None, "CDB", Decimal("5.00")),
        (d(2026, 6, 2), "INVESTIMENTO", None, None, Decimal("9.00")), (d(2026, 6, 3), "PIX", "Resgate", None, Decimal("-4.00")),
        (d(2026, 7, 1), "PIX", "Resgate", None, Decimal("8.00")), (d(2026, 5, 31), "PIX", "Resgate", None, Decimal("8.00"))],
        "data_movimento date, tipo_transacao_inter string, descricao string, titulo string, valor_com_sinal decimal(18,2)")
    rows = redemptions(bank, FinanceRules(redemptions=("2026-06-01", "2026-07-01"))).collect()
    assert sorted(float(r.value) for r in rows) == [5.0, 10.0] and {r.flow for r in rows} == {"fci"}
