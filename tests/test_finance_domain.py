"""RP-13 / RP-14 on domain fixtures."""

import datetime as dt
from decimal import Decimal

from ledgerly.plans.finance import FinanceRules, cash_flow_statement, income_statement


def test_income_and_cash_flow_statements(spark):
    items = spark.createDataFrame([
        (dt.datetime(2026, 7, 3), Decimal("1000.00"), "0012", "Agua 500ml", Decimal("10")),
        (dt.datetime(2026, 7, 9), Decimal("500.00"), "77", "Mensalidade", None),
        (dt.datetime(2026, 8, 1), Decimal("200.00"), "12", "agua  500ML", Decimal("0")),
    ], "pay_date timestamp, valor_faturamento decimal(18,2), sku string, item_description string, quantity decimal(18,2)")
    costs = spark.createDataFrame([
        ("12", "Agua 500ml", None, dt.date(2026, 7, 31), Decimal("1.50")),
        ("12", "Agua 500ml", dt.date(2026, 8, 1), None, Decimal("2.00")),
    ], "sku string, description string, data_inicio date, data_fim date, custo_unitario decimal(18,2)")
    detail = spark.createDataFrame([
        (dt.date(2026, 7, 5), dt.datetime(2026, 7, 6), True, "Dan", 300.0, 0.0, False),
        (dt.date(2026, 7, 6), None, True, "Eve", 100.0, 150.0, True),
        (dt.date(2026, 7, 7), dt.datetime(2026, 7, 8), False, "Dan", 999.0, 0.0, False),
    ], "booking_date date, pay_date timestamp, is_paid boolean, professor string, booking_value double, "
       "booking_commission_base double, is_socio_benefit boolean")
    ledger = spark.createDataFrame([
        (dt.date(2026, 7, 10), True, "expense", Decimal("100.00"), "Energia Elétrica", "Operação", "Luz", None),
        (dt.date(2026, 7, 11), True, "expense", Decimal("50.00"), "Limpeza", "Operação", "Produtos", None),
        (dt.date(2026, 7, 12), True, "expense", Decimal("70.00"), "Comissão professores", "Operação", "x", None),
        (dt.date(2026, 7, 13), True, "revenue", Decimal("900.00"), "Vendas", "Operação", "x", None),
        (dt.date(2026, 7, 14), True, "expense", Decimal("30.00"), "Equipamento", "Investimentos", "x", None),
        (dt.date(2026, 7, 15), False, "expense", Decimal("40.00"), "Limpeza", "Operação", "Zeta Payroll", None),
    ], "due_date date, paid boolean, transaction_type string, amount decimal(18,2), category_name string, "
       "cost_center_descricao string, name string, description string")
    payments = spark.createDataFrame([(dt.datetime(2026, 7, 3), "Cartão Débito", Decimal("1000.00"))],
                                     "payment_date timestamp, pay_method string, amount decimal(18,2)")
    r = FinanceRules(text_exclusions=[("zeta payroll", "2026-07-01")], teacher_rates=[("Eve", 0.2)],
                     accruals=[("staff", "2026-07-16", None, "3100.00")])
    st = {(str(x.month), x.line): x.value for x in
          income_statement(items, detail, ledger, costs, payments, "2026-06-01", "2026-08-01", r).collect()}
    assert st[("2026-06-01", "gross_revenue")] == 0.0 and st[("2026-06-01", "net_income")] == 0.0
    assert st[("2026-07-01", "gross_revenue")] == 1500.0
    assert st[("2026-07-01", "cogs")] == 15.0                 # code '0012' = '12', 10 x 1.50; 'Mensalidade' no cost
    assert st[("2026-07-01", "commission")] == 60.0           # 300 x 10% + 150 x 20%
    assert st[("2026-07-01", "energy")] == 100.0
    assert st[("2026-07-01", "operating_expenses")] == 50.0 + 1600.0   # payee exclusion and commissions excluded; accrual 16/31
    assert st[("2026-07-01", "fees")] == 9.9
    assert st[("2026-08-01", "cogs")] == 2.0                  # quantity 0 counts as 1, August price
    # first month: trailing base = 12 x base; (1440 x 12 = 17280) <= 180000 -> 6%
    assert st[("2026-07-01", "taxes")] == round(1440 * 0.06 * 0.96, 2)
    long, summary = cash_flow_statement(ledger, "2026-07-01", "2026-07-01",
                                        FinanceRules(opening=1000.0, extra_openings=[("2026-07-01", 500.0)]))
    row = summary.collect()[0]
    assert float(row.fco) == 900.0 - 100.0 - 50.0 - 70.0 and float(row.fci) == -30.0
    assert float(row.closing) == 1000.0 + 500.0 + float(row.net)
