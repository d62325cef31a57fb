"""RP-19 on domain fixtures: seeds from prices, payments, occupancy, items, ledger."""

import datetime as dt
from decimal import Decimal

from ledgerly.plans.projection_domain import project_months


def test_project_months_first_month_by_hand(spark):
    prices = spark.createDataFrame([("A", 720.0), ("B", 430.0)], "student string, monthly_price double")
    payments = spark.createDataFrame([(dt.datetime(2026, 7, 3), "pix", Decimal("300")),
                                      (dt.datetime(2026, 7, 4), "Cartão Crédito", Decimal("700"))],
                                     "payment_date timestamp, pay_method string, amount decimal(18,2)")
    occupancy = spark.createDataFrame([(dt.date(2026, 7, 1), "Aulas - Regular", 100.0),
                                       (dt.date(2026, 7, 1), "Manutenção", 10.0),
                                       (dt.date(2026, 7, 1), "Locação - Quadra Avulsa", 20.0)],
                                      "month date, kind string, hours double")
    items = spark.createDataFrame([(dt.datetime(2026, 7, 5), Decimal("200"), "Bar", "Lanche")],
                                  "pay_date timestamp, valor_faturamento decimal(18,2), category string, description string")
    ledger = spark.createDataFrame([
        (dt.date(2026, 7, 10), True, "expense", Decimal("1000"), "Operação"),
        (dt.date(2026, 8, 10), False, "expense", Decimal("500"), "Operação"),
        (dt.date(2026, 8, 11), False, "expense", Decimal("300"), "Investimentos"),
    ], "due_date date, paid boolean, transaction_type string, amount decimal(18,2), cost_center_descricao string")
    schedule = spark.createDataFrame([], "release_date date, value decimal(18,2)")
    rows = project_months(prices, payments, occupancy, items, ledger, schedule, "2026-07-01", 10000.0).collect()
    assert [str(r.month) for r in rows] == ["2026-08-01", "2026-09-01", "2026-10-01"]
    first = rows[0]
    assert abs(first.inflow - 11362.5) < 0.011
    assert first.provision == 100.0   # 10% of the mean past cost: the ledger has one month, of 1000
    assert abs(first.out_ops - 740.93) < 0.011
    assert abs(first.net - 10321.57) < 0.011
    assert abs(first.final - 20321.57) < 0.011
    assert rows[1].initial == first.final   # next month opens where this one closed


def test_project_days_balance_and_first_day_items(spark):
    from ledgerly.plans.projection_domain import project_days
    ledger = spark.createDataFrame([
        (dt.date(2026, 8, 5), False, "expense", Decimal("100"), "Operação"),      # overdue -> first day
        (dt.date(2026, 8, 12), False, "expense", Decimal("40"), "Investimentos"),
        (dt.date(2026, 8, 10), True, "revenue", Decimal("30"), "Operação"),       # received on the as-of day
    ], "due_date date, paid boolean, transaction_type string, amount decimal(18,2), cost_center_descricao string")
    schedule = spark.createDataFrame([], "release_date date, value decimal(18,2)")
    rows = project_days(ledger, schedule, "2026-08-01", "2026-08-10", 1000.0, d30_remaining=2200.0,
                        d0_expected=0.0, commission_p1=50.0, commission_p2=70.0, card_fee=0.0).collect()
    assert len(rows) == 22 and str(rows[0].day) == "2026-08-10"
    # remaining weight: 22 days from the 10th, 3 Sundays at 0.5 -> 20.5
    first = rows[0]
    assert abs(first.inflow - (round(2200 * 1.0 / 20.5, 2) - 30.0)) < 0.011
    assert first.outflow_ops == 100.0
    d20 = [r for r in rows if r.day == dt.date(2026, 8, 20)][0]
    assert d20.outflow_ops == 50.0
    last = rows[-1]
    assert last.outflow_ops == 70.0
    assert abs(last.closing - (1000.0 + sum(r.net for r in rows))) < 0.01


def test_debit_card_fee_per_slot_of_customers_who_ever_paid_by_debit(spark):
    from ledgerly.operators import projection as P
    prices = spark.createDataFrame([("a", 100.333), ("a", 50.126), ("b", 70.0), (None, 9.0)], "customer_code string, monthly_price double")
    pays = spark.createDataFrame([("a", "CARTÃO DÉBITO"), ("a", "pix"), ("a", "Cartão Débito"), ("b", "pix"), (None, "Cartão Débito"), ("c", None)],
                                 "customer_code string, pay_method string")
    got = P.debit_base(prices, pays, [], 0.02).first().debit_base
    assert got == round(round(100.333 * 1.02, 2) + round(50.126 * 1.02, 2), 2)  # each slot rounded, each counted once
    entity = spark.createDataFrame([(1, 0.0, 0.0, 0.0, 0.5, 0.5, 0.0, 0.0, 0.0, 1.0, 0.0, got)], "k int, base_tuition double, other_base double, "
                                   "fixed_hours double, r0 double, r30 double, pt0 double, pv0 double, roll_sum double, roll_cnt double, opening double, debit_base double")
    entity = entity.selectExpr("*", "array(struct(date'2026-08-01' as month, 0d as open_hours, 0d as sched_ops, 0d as sched_inv, cast(null as double) as imported)) as months")
    row = P.month_projection(entity, "k").first()
    assert row.out_ops == round(got * 0.5 * 0.0099, 2) and P.month_projection(entity.drop("debit_base"), "k").first().out_ops == 0.0


def test_opening_of_the_days_from_bank_and_ledger(spark):
    from ledgerly.plans.projection_domain import days_opening, in_investments
    ledger = spark.createDataFrame([
        (dt.date(2026, 7, 3), True, "revenue", Decimal("100"), "Operação", None, "2026-07-29T10", 500_00),
        (dt.date(2026, 7, 4), True, "expense", Decimal("30"), "Operação", "Investimentos", "2026-07-30T09", 700_00),
        (dt.date(2026, 7, 5), True, "transfer", Decimal("7"), "Operação", None, "2026-07-30T09", 650_00),
        (dt.date(2026, 7, 20), True, "revenue", Decimal("1"), "Operação", None, None, 900_00),      # not before the as-of day
        (dt.date(2026, 7, 6), False, "revenue", Decimal("2"), "Operação", None, None, None),        # not paid
    ], "due_date date, paid boolean, transaction_type string, amount decimal(18,2), cost_center_descricao string, cost_center_name string, "
       "synced_at string, bank_account_balance_cents long")
    bank = spark.createDataFrame([
        (dt.date(2026, 7, 2), None, "Aplicação CDB", None, Decimal("-40")), (dt.date(2026, 7, 8), "INVESTIMENTO", None, None, Decimal("15")),
        (dt.date(2026, 6, 9), None, "Resgate", None, Decimal("11")), (dt.date(2026, 7, 9), "PIX", "Padaria", None, Decimal("3"))],
        "data_movimento date, tipo_transacao_inter string, descricao string, titulo string, valor_com_sinal decimal(18,2)")
    args = dict(month_opening=1000.0, default_balance=17.0, investments="111.79")
    opening = lambda month, as_of, since, led=ledger: days_opening(led, bank, month, as_of, since=since, **args).first().opening
    assert opening("2026-07-01", "2026-07-15", "2026-07-01") == 836.79   # latest sync, larger of two, with investments
    assert opening("2026-07-01", "2026-07-15", "2026-08-01") == 700.0                      # not yet consolidated
    assert opening("2026-07-01", "2026-07-15", "2026-08-01", ledger.limit(0)) == 17.0
    assert opening("2026-07-01", "2026-08-15", "2026-07-01") == 1000.0 + 100 - 30 + 1       # a past month; transfers stay out
    assert opening("2026-07-01", "2026-07-15", "2026-07-01", ledger.limit(0)) == 153.79
    assert opening("2026-06-01", "2026-07-15", "2026-07-01") == 1000.0 + 11                 # before: redemptions are receipts
    assert [r.x for r in ledger.select(in_investments(ledger).alias("x")).collect()] == [False, True, False, False, False]
