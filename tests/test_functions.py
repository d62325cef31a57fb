"""Helper semantics and operator edge cases on ten-row frames."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerly.functions import dates as D
from ledgerly.functions import num as N
from ledgerly.functions import text as T
from ledgerly.operators import alloc as A
from ledgerly.operators import rules as R


def one(spark, expr, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_js_or_zero_null_nan_fall_through(spark):
    got = one(spark, N.js_or("x", 7.0), [("0",), (None,), ("abc",), ("2.5",)], "x string")
    assert got == [7.0, 7.0, 7.0, 2.5]


def test_round2_ties_toward_positive_infinity(spark):
    got = one(spark, N.round2("x"), [(-0.125,), (0.125,), (2.5,)], "x double")
    assert got == [-0.12, 0.13, 2.5]


def test_safe_div_zero_and_null(spark):
    got = one(spark, N.safe_div("a", "b"), [(1.0, 0.0), (1.0, None), (3.0, 2.0)], "a double, b double")
    assert got == [0.0, 0.0, 1.5]


def test_day_of_week_numbering(spark):
    # 2024-01-06 is a Saturday
    rows = [(dt.date(2024, 1, 6),), (dt.date(2024, 1, 7),)]
    assert one(spark, D.isodow("d"), rows, "d date") == [6, 7]
    assert one(spark, D.js_dow("d"), rows, "d date") == [6, 0]


def test_period_of_day_20_and_21(spark):
    rows = [(dt.date(2024, 1, 20),), (dt.date(2024, 1, 21),)]
    assert one(spark, D.period_of("d"), rows, "d date") == [1, 2]


def test_group_or_null(spark):
    rows = [("Aula Prof: Ana  Lima (2/4)",), ("sem nada",), (None,)]
    got = one(spark, T.group_or_null("s", R.TEACHER_FALLBACK_RE), rows, "s string")
    assert got == ["Ana Lima", None, None]


def test_span_dates_invalid_is_null(spark):
    rows = [("x 01/07/2026-15/07/2026",), ("31/02/2026-01/03/2026",), ("none",)]
    df = T.with_span(spark.createDataFrame(rows, "s string"), "s")
    got = [(r.span_start, r.span_end) for r in df.collect()]
    assert got == [(dt.date(2026, 7, 1), dt.date(2026, 7, 15)), (None, dt.date(2026, 3, 1)), (None, None)]


def test_full_month_proration(spark):
    rows = [(150.0, "01/07/2026-15/07/2026"), (10.0, "05/02/2026-05/02/2026"), (99.0, "no span")]
    df = A.to_full_month(spark.createDataFrame(rows, "v double, s string"), "v", "s")
    got = [float(r.full_value) for r in df.collect()]
    # 150 * 31 / 15 = 310; one-day span in February: 10 * 28 / 1 = 280
    assert got == [310.0, 280.0, 99.0]


def test_money_and_date_text(spark):
    rows = [("R$ 1.234,56",), ("1234,5",), ("1234.5",), ("",)]
    assert one(spark, T.parse_money_text("s"), rows, "s string") == [1234.56, 1234.5, 1234.5, None]
    rows = [("5/7/26",), ("05-07-2026",), ("2026-07-05",), ("46208",), ("x",)]
    got = one(spark, T.parse_date_text("s"), rows, "s string")
    assert got[:3] == [dt.date(2026, 7, 5)] * 3
    assert got[3] == dt.date(1899, 12, 30) + dt.timedelta(days=46208)
    assert got[4] is None


def test_band_edges(spark):
    rows = [(10.0,), (3.0,), (2.99,), (-3.0,), (-10.0,)]
    assert one(spark, R.band("x"), rows, "x double") == ["MUITO ACIMA", "ACIMA", "NO ALVO", "ABAIXO", "MUITO ABAIXO"]


def test_off_peak_hours_10_and_15(spark):
    rows = [(dt.date(2024, 1, 8), 10), (dt.date(2024, 1, 8), 15), (dt.date(2024, 1, 8), 16),
            (dt.date(2024, 1, 6), 12)]
    assert one(spark, R.is_off_peak("d", "h"), rows, "d date, h int") == [True, True, False, False]


def test_frequency_discount(spark):
    assert one(spark, R.freq_discount("n"), [(1,), (2,), (3,), (4,)], "n int") == [0.0, 0.05, 0.07, 0.07]


def test_capacity_class(spark):
    rows = [("Turma (2 / 4)", "clase_colectiva"), ("(1/1)", "clase_colectiva"), ("x", "clase_suelta"),
            ("x", "clase_colectiva"), ("(3/ 2)", "clase_colectiva")]
    got = one(spark, R.capacity_class("d", "t"), rows, "d string, t string")
    assert got == ["GRUPO", "INDIVIDUAL", "INDIVIDUAL", "GRUPO", "DUPLA"]


def test_infer_plan_bands(spark):
    prices = [("INDIVIDUAL", 720.0), ("DUPLA", 430.0), ("TRIO", 395.0), ("GRUPO", 335.0), ("GRUPO", 245.0)]
    rows = [(720.0,), (40.0,), (1440.0,), (335.0,)]
    got = one(spark, A.infer_plan("v", prices), rows, "v double")
    assert got[0] == "INDIVIDUAL" and got[1] is None and got[2] == "INDIVIDUAL" and got[3] == "GRUPO"


def test_refund_null_type_passes_and_null_key_never_matches(spark):
    """coalesce(type,'') <> 'refund' keeps null; N5: a null key never survives NOT IN."""
    from ledgerly.operators import filters as FL
    from ledgerly.operators import joins as J
    df = spark.createDataFrame([(1, False, False, None, 5.0, "Aulas", None), (2, False, False, "refund", 5.0, "Aulas", None),
                                (3, False, False, "sale", 0.0, "Aulas", None), (4, False, False, "sale", 5.0, "Bar", None)],
                               "k int, ic boolean, sc boolean, t string, v double, c string, s string")
    kept = [r.k for r in FL.valid_items(df, "ic", "sc", "t", "v", "c", ["Aulas"], "s", "X").collect()]
    assert kept == [1]
    items = spark.createDataFrame([(1,), (None,), (3,)], "k int")
    used = spark.createDataFrame([(3,)], "k int")
    assert sorted(r.k for r in J.unused(items, "k", used).collect()) == [1]


def test_nearest_ties_go_to_earlier_date_then_lower_id(spark):
    from ledgerly.operators import joins as J
    a = spark.createDataFrame([(1, dt.date(2024, 1, 10)), (2, dt.date(2024, 1, 1))], "c int, d date")
    b = spark.createDataFrame([(1, dt.date(2024, 1, 8), 7, "x"), (1, dt.date(2024, 1, 12), 5, "y"),
                               (1, dt.date(2024, 1, 8), 6, "z")], "c int, bd date, id int, lbl string")
    got = {r.c: (r.lbl, r.nearest_days) for r in J.nearest(a, b, ["c"], "d", "bd", ["lbl"], "id").collect()}
    assert got[1] == ("z", 2) and got[2] == (None, None)


def test_bracket_rate_continuity_at_edges(spark):
    from ledgerly.plans.q_reports import BRACKETS
    def eff(r):
        for hi, rate, ded in BRACKETS:
            if hi is None or r <= hi:
                return rate if r <= BRACKETS[0][0] else (r * rate - ded) / r
    for edge in (180000.0, 360000.0, 720000.0):
        assert abs(eff(edge) - eff(edge + 0.01)) < 1e-6
    assert eff(1800000.01) < eff(1800000.0) and eff(3600000.01) < eff(3600000.0)


def test_accents_go_as_a_decomposition_drops_them(spark):
    import re
    import unicodedata

    from ledgerly.functions import text as T
    words = ["plain", "", None, "Ação", "Ãção", "Řeďţ Ǻ Ẅ ở", "й ё Ώ", "ｱ①", "́", "ǖ ẋ̣", "straße", "naïve 日本"]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    got = [r.x for r in df.select(T.strip_accents("w").alias("x")).collect()]
    want = [None if w is None else unicodedata.normalize("NFC", re.sub("[̀-ͯ]", "", unicodedata.normalize("NFD", w))) for w in words]
    assert got == want
    names = [r.x for r in df.select(T.norm_name("w").alias("x")).collect()]
    assert names[3] == names[4] == "ACAO" and names[2] == ""
