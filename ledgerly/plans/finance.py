"""RP-13 and RP-14 on the domain tables: cash-flow and income statements.

Inputs have the reference's shapes (FIXTURES.md): the ledger
(``due_date, paid, transaction_type, amount, category_name,
cost_center_descricao`` plus free-text columns), paid sale items
(``pay_date, valor_faturamento, sku, item_description, quantity``), the
commission detail (output of :mod:`ledgerly.plans.commission`), dated unit
costs (``sku, description, data_inicio, data_fim, custo_unitario``) and
payments (``payment_date, pay_method, amount``). Months, rates, brackets,
exclusions and openings are parameters; nothing reads the clock.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerly.functions import dates as D
from ledgerly.functions import text as T
from ledgerly.functions.num import js_or, money
from ledgerly.operators import filters as FL
from ledgerly.operators import joins as J
from ledgerly.operators import rules as R
from ledgerly.operators import windows as W
from ledgerly.operators.common import rule_table
from ledgerly.operators.projection import r2
from ledgerly.plans.q_reports import BRACKETS, bracket_tax


@dataclass
class FinanceRules:
    cost_since: str | None = "2026-01-01"   # where a cost row without a start begins
    ops_centre: str = "Operação"
    energy_category: str = "Energia Elétrica"
    skip_categories: list = field(default_factory=lambda: ["Estoque Bar/Lanchonete", "Simples - Imposto"])
    commission_words: list = field(default_factory=lambda: ["comissão", "comissao"])
    # (word in the ledger's free text, first month it is excluded): payees counted elsewhere
    text_exclusions: list = field(default_factory=list)
    text_columns: list = field(default_factory=lambda: ["name", "description", "contact_name", "payee", "notes",
                                                        "observacao"])
    commission_rate: float = 0.10
    teacher_rates: list = field(default_factory=list)          # (teacher, rate)
    # CL-16: (name part 1, name part 2, from date, factor) on the participant name
    multipliers: list = field(default_factory=list)
    fee_rates: list = field(default_factory=lambda: list(R.FEE_RATES))
    depreciation: float = 0.0                                  # per active month
    brackets: list = field(default_factory=lambda: list(BRACKETS))
    income_tax_share: float = 0.04
    # accruals (JN-19): (category, from, to or None, monthly amount)
    accruals: list = field(default_factory=list)
    # cash flow (RP-13)
    flows: list = field(default_factory=lambda: list(R.FLOW_CLASSES))
    transfers_excluded_from: str | None = None
    # bank side (fixed values: the words and the category): redemptions count as investment inflow from the first month up to, not with, the second
    redemptions: tuple | None = None
    redemption_words: list = field(default_factory=lambda: ["resgate", "cdb"])
    redemption_category: str = "Resgate de Aplicação Financeira (CDB)"
    opening: float = 0.0
    extra_openings: list = field(default_factory=list)         # (from month, amount)


LINES = ["gross_revenue", "taxes", "net_revenue", "cogs", "commission", "energy", "fees", "gross_profit",
         "operating_expenses", "ebitda", "depreciation", "ebit", "income_tax", "net_income"]


def income_statement(items: DataFrame, detail: DataFrame, ledger: DataFrame, costs: DataFrame,
                     payments: DataFrame, first_month: str, last_month: str,
                     r: FinanceRules = FinanceRules(), vouchers: DataFrame | None = None,
                     online: DataFrame | None = None) -> DataFrame:
    """RP-14: the monthly statement, long form ``(month, line, value, pct_of_net)``.

    Gross revenue by pay month; COGS by the effective-dated cost of each item
    (JN-12, AG-17); commission from paid bookings at the teacher's rate
    (CL-20, N1 base fall-through, CL-16 on the participant name) and from
    valid ``vouchers`` (FL-6: ``description, total, pay_date``); energy and
    operating expenses from the ledger's operations centre after the
    exclusions (FL-9) plus accruals (JN-19); card fees by method (CL-19,
    AG-18) and the provider's own fees (``online``: ``date_approved,
    fee_amount``); bracket tax on the trailing base (RP-15, WN-5); a month
    with no revenue is all zero. Sums run on decimals.
    """
    spark = items.sparkSession
    # from the first paid month on, as the trailing tax base looks back beyond the report
    since = items.agg(F.least(D.month_start(F.min("pay_date")), F.lit(first_month).cast("date")).alias("lo"))
    months = since.select(F.explode(D.month_sequence("lo", F.lit(last_month))).alias("month"))
    z = F.lit(0).cast("decimal(18,2)")

    it = items.where(F.col("pay_date").isNotNull()).withColumn("month", D.month_start("pay_date"))
    gross = it.groupBy("month").agg(F.sum(money("valor_faturamento")).alias("gross_revenue"))
    # "first cost row wins" needs a total order over cost rows (N10): the row's own
    # values, compared as a struct — no global row numbering
    c2 = costs.withColumn("__ord", F.struct("sku", "description", "data_inicio", "data_fim", "custo_unitario"))
    priced = J.effective_lookup(it, c2, "sku", "item_description", "pay_date", "sku", "description",
                                "data_inicio", "data_fim", "__ord", ["custo_unitario"], default_start=r.cost_since)
    qty = F.coalesce(F.nullif(money("quantity"), z), F.lit(1).cast("decimal(18,2)"))
    cogs = priced.groupBy("month").agg(F.sum(F.coalesce(F.col("custo_unitario").cast("decimal(18,2)") * qty, z))
                                       .alias("cogs"))

    paid = detail.where(F.col("is_paid")) \
                 .withColumn("month", D.month_start(F.coalesce(F.to_date("pay_date"), F.col("booking_date"))))
    base = js_or("booking_commission_base", F.when(F.col("is_socio_benefit"), F.col("booking_value") * 2)
                 .otherwise(js_or("booking_value", 0.0)))
    mult = R.dated_multiplier(r.multipliers, "participant_name", "booking_date") if r.multipliers else F.lit(1.0)
    earned = paid.select("month", "professor", (base * mult).alias("base"))
    if vouchers is not None:
        v = FL.valid_vouchers(vouchers, "description", "total", "description")
        earned = earned.unionAll(v.select(D.month_start("pay_date"), "voucher_name", F.col("total").cast("double")))
    rates = rule_table(spark, r.teacher_rates or [("", 0.0)], "p string, r double")
    comm = R.rate_for(earned, rates, "professor", r.commission_rate).groupBy("month").agg(
        F.sum((F.col("base") * F.col("rate")).cast("decimal(28,8)")).alias("commission"))

    led = ledger.where((F.col("cost_center_descricao") == r.ops_centre) & (F.col("transaction_type") != "revenue")) \
                .withColumn("month", D.month_start("due_date")) \
                .withColumn("category", F.coalesce("category_name", F.lit("Outras Despesas")))
    led = FL.expense_lines(led, [(None, word, since, "month") for word, since in r.text_exclusions]
                           + [("category", [w], None, None) for w in r.commission_words], r.text_columns)
    is_energy = F.col("category") == r.energy_category
    led = led.where(is_energy | ~F.col("category").isin(r.skip_categories))
    exp = led.groupBy("month").agg(F.sum(F.when(is_energy, money("amount")).otherwise(z)).alias("energy"),
                                   F.sum(F.when(~is_energy, money("amount")).otherwise(z)).alias("opex"))
    if r.accruals:
        acc = rule_table(spark, [(c, s, e, str(a)) for c, s, e, a in r.accruals],
                         "category string, s string, e string, amount string") \
                   .select("category", F.col("s").cast("date").alias("s"), F.col("e").cast("date").alias("e"),
                           F.col("amount").cast("decimal(18,2)").alias("amount"))
        dim = F.dayofmonth(F.last_day("month"))
        acc_m = months.join(acc, (F.col("s") <= F.last_day("month"))
                            & (F.col("e").isNull() | (F.col("e") >= F.col("month")))) \
            .select("month", F.when(F.col("s") > F.col("month"),
                                    F.col("amount") * (dim - F.dayofmonth("s") + 1) / dim).otherwise(F.col("amount"))
                    .cast("decimal(18,2)").alias("acc"))
        exp = exp.join(acc_m.groupBy("month").agg(F.sum("acc").alias("acc")), "month", "full_outer") \
                 .select("month", F.coalesce("energy", z).alias("energy"),
                         (F.coalesce("opex", z) + F.coalesce("acc", z)).alias("opex"))
    rate = R.fee_rate("pay_method", r.fee_rates).cast("decimal(6,4)")
    fee_rows = payments.where(F.coalesce(F.col("pay_method") != R.ONLINE_METHOD, F.lit(True))) \
        .select(D.month_start("payment_date").alias("month"), (money("amount") * rate).cast("decimal(28,8)").alias("fee"))
    if online is not None:
        fee_rows = fee_rows.unionAll(online.select(D.month_start("date_approved"), money("fee_amount").cast("decimal(28,8)")))
    fees = fee_rows.groupBy("month").agg(F.sum("fee").alias("fees"))

    s = months.join(gross, "month", "left").join(cogs, "month", "left").join(comm, "month", "left") \
              .join(exp, "month", "left").join(fees, "month", "left")
    dbl = lambda c: r2(F.coalesce(F.col(c).cast("double"), F.lit(0.0)))
    s = s.select("month", *[dbl(c).alias(c) for c in ("gross_revenue", "cogs", "commission", "energy", "opex", "fees")],
                 F.lit(1).alias("__k"))
    s = s.withColumn("base", F.greatest(F.lit(0.0), F.col("gross_revenue") - F.col("commission")).cast("decimal(18,2)"))
    s = bracket_tax(s, "base", keys=["__k"], brackets=r.brackets, income_share=r.income_tax_share)
    s = s.where(F.col("month") >= F.lit(first_month).cast("date"))
    active = F.col("gross_revenue") != 0
    t = (s.withColumn("taxes", F.col("taxes")).withColumn("income_tax", F.col("ir"))
          .withColumn("net_revenue", r2(F.col("gross_revenue") - F.col("taxes")))
          .withColumn("gross_profit", r2(F.col("net_revenue") - F.col("cogs") - F.col("commission")
                                         - F.col("energy") - F.col("fees")))
          .withColumn("operating_expenses", F.col("opex"))
          .withColumn("ebitda", r2(F.col("gross_profit") - F.col("operating_expenses")))
          .withColumn("depreciation", F.lit(float(r.depreciation)))
          .withColumn("ebit", r2(F.col("ebitda") - F.col("depreciation")))
          .withColumn("net_income", r2(F.col("ebit") - F.col("income_tax"))))
    vals = [F.struct(F.lit(k).alias("line"), F.when(active, F.col(k)).otherwise(F.lit(0.0)).alias("value"))
            for k in LINES]
    u = t.select("month", F.when(active, F.col("net_revenue")).otherwise(F.lit(0.0)).alias("__net"),
                 F.explode(F.array(*vals)).alias("x")).select("month", "__net", "x.*")
    pct = F.coalesce(F.when(F.col("__net") != 0, F.col("value") * 100 / F.col("__net")), F.lit(0.0))
    return u.select("month", "line", "value", r2(pct).alias("pct_of_net"))


def redemptions(bank: DataFrame, r: FinanceRules) -> DataFrame:
    """Bank side of RP-13 (FL-7): redemptions of investments as ``(month, flow, category, value)``.

    Of the bank's investment moves, those that name a redemption and bring
    money in, within ``r.redemptions``; later ones move money between own
    accounts and stay out.
    """
    since, until = r.redemptions
    moves = FL.investment_moves(bank, "tipo_transacao_inter", "INVESTIMENTO", ["descricao", "titulo"],
                                ["resgate", "cdb", "firf", "aplicação", "aplicacao"])
    text = F.concat_ws(" ", F.coalesce("descricao", F.lit("")), F.coalesce("titulo", F.lit("")))
    month = D.month_start("data_movimento")
    return moves.where(T.ilike_any(text, r.redemption_words) & (F.col("valor_com_sinal") > 0)
                       & (month >= F.lit(since).cast("date")) & (month < F.lit(until).cast("date"))) \
        .select(month.alias("month"), F.lit("fci").alias("flow"), F.lit(r.redemption_category).alias("category"),
                money("valor_com_sinal").alias("value"))


def cash_flow_statement(ledger: DataFrame, first_month: str, last_month: str, r: FinanceRules = FinanceRules(),
                        bank: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """RP-13: paid ledger rows by month, activity (CL-9) and category, signed
    (PJ-3), long form (AG-11); and per month the three activities with
    opening and closing cash (WN-3) from an opening and dated extra openings."""
    spark = ledger.sparkSession
    x = ledger.where(F.col("paid")).withColumn("month", D.month_start("due_date")) \
              .where((F.col("month") >= F.lit(first_month).cast("date")) & (F.col("month") <= F.lit(last_month).cast("date")))
    if r.transfers_excluded_from:
        x = x.where(~((F.col("transaction_type") == "transfer")
                      & (F.col("month") >= F.lit(r.transfers_excluded_from).cast("date"))))
    x = x.withColumn("flow", R.flow_class("cost_center_descricao", r.flows)).where(F.col("flow").isNotNull()) \
         .withColumn("category", F.coalesce("category_name", F.lit("Sem Categoria"))) \
         .withColumn("value", F.when(F.col("transaction_type") == "revenue", money("amount")).otherwise(-money("amount")))
    x = x.select("month", "flow", "category", "value")
    if bank is not None and r.redemptions:
        x = x.unionByName(redemptions(bank, r).where((F.col("month") >= F.lit(first_month).cast("date"))
                                                     & (F.col("month") <= F.lit(last_month).cast("date"))))
    long = x.groupBy("month", "flow", "category").agg(F.sum("value").alias("net"))
    months = spark.range(1).select(F.explode(D.month_sequence(F.lit(first_month), F.lit(last_month))).alias("month"))
    z = F.lit(0).cast("decimal(18,2)")
    per = long.groupBy("month").agg(*[F.coalesce(F.sum(F.when(F.col("flow") == f, F.col("net"))), z).alias(f)
                                      for _, f in r.flows])
    m = months.join(per, "month", "left").select("month", *[F.coalesce(F.col(f), z).alias(f) for _, f in r.flows])
    net = None
    for _, f in r.flows:
        net = F.col(f) if net is None else net + F.col(f)
    extra = z
    for since, amount in r.extra_openings:
        # once, in its month; one from before the report opens the first month
        at = F.greatest(F.trunc(F.lit(since).cast("date"), "MM"), F.lit(first_month).cast("date"))
        extra = extra + F.when(F.col("month") == at, F.lit(str(amount)).cast("decimal(18,2)")) \
                         .otherwise(z)
    m = m.withColumn("net", net).withColumn("step", F.col("net") + extra) \
         .withColumn("seed", F.lit(str(r.opening)).cast("decimal(18,2)")).withColumn("__k", F.lit(1))
    m = W.running_balance(m, ["__k"], "month", "step", "seed")
    summary = m.select("month", *[F.col(f) for _, f in r.flows], "net",
                       (F.col("closing") - F.col("net")).alias("opening"), "closing")
    return long, summary
