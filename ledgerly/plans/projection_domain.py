"""RP-19 on the domain tables: the three-month cash projection of the club.

Seeds come from the reference's table shapes: recurring monthly prices
(AL-10 output, a row per slot: ``monthly_price`` and, for the debit-card fee,
``customer_code``), payments (``payment_date, pay_method, amount`` and
``customer_code``) for the settlement mix (AG-20), occupancy rows
(``month, kind, hours``) classified by CL-10, paid sale items (``pay_date,
valor_faturamento, category, description``, classed by CL-5) for the other variable
revenue, the ledger (``due_date, paid, transaction_type, amount,
cost_center_descricao``) for scheduled costs and the expense history, and the
imported receivables schedule (``release_date, value``). The recurrence runs
in :func:`ledgerly.operators.projection.month_projection`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerly.functions import dates as D
from ledgerly.functions.num import money
from ledgerly.operators import agg as G
from ledgerly.operators import joins as J
from ledgerly.operators import projection as P
from ledgerly.operators import rules as R
from ledgerly.operators import windows as W
from ledgerly.plans.q_agg import OPEN_HOURS

# Methods settled the same day; the investment cost centre.
IMMEDIATE_METHODS = ["pix", "Pix", "Dinheiro", "Cartão Débito"]
INVESTMENT_CENTRE = "Investimentos"


def in_investments(ledger: DataFrame) -> Column:
    """Whether a row belongs to the investment centre, by whichever of its two names the ledger has."""
    out = F.lit(False)
    for c in ("cost_center_name", "cost_center_descricao"):
        if c in ledger.columns:
            out = out | F.coalesce(F.col(c) == INVESTMENT_CENTRE, F.lit(False))
    return out


#: Words of a bank row's text or title that make it an investment move.
INVESTMENT_WORDS = ["resgate", "cdb", "firf", "aplicação", "aplicacao"]


def investment_account(bank: DataFrame, opening: str, since: str, upto: str | None = None) -> DataFrame:
    """One row, ``balance``: ``opening`` plus applications less redemptions from ``since`` on (to ``upto``)."""
    low = lambda c: F.lower(F.coalesce(F.col(c), F.lit("")))
    is_inv = F.coalesce(F.col("tipo_transacao_inter") == "INVESTIMENTO", F.lit(False))
    for w in INVESTMENT_WORDS:
        is_inv = is_inv | F.contains(low("descricao"), F.lit(w)) | F.contains(low("titulo"), F.lit(w))
    v = F.coalesce(money("valor_com_sinal"), F.lit(0).cast("decimal(18,2)"))
    credit = v > 0
    if "tipo_movimento" in bank.columns:
        credit = credit | F.coalesce(F.col("tipo_movimento") == "entrada", F.lit(False))
    rows = bank.where(is_inv & (F.col("data_movimento") >= F.lit(since).cast("date")))
    if upto is not None:
        rows = rows.where(F.col("data_movimento") <= F.lit(upto).cast("date"))
    moved = F.coalesce(F.sum(F.when(credit, -F.abs(v)).otherwise(F.abs(v))), F.lit(0).cast("decimal(18,2)"))
    return rows.agg((F.lit(opening).cast("decimal(18,2)") + moved).alias("balance"))


def days_opening(ledger: DataFrame, bank: DataFrame, month: str, as_of: str, month_opening: float, default_balance: float,
                 investments: str, since: str) -> DataFrame:
    """RP-18's opening cash, one row ``opening`` (AG-26, AG-27).

    In the as-of month itself, the bank balance of the row synced last
    (``synced_at``, ``bank_account_balance_cents``; ties by the larger balance;
    ``default_balance`` without any), and from the month of ``since`` on the
    investment account with it. In another month, ``month_opening`` with the
    month's paid rows before the as-of day, transfers out from ``since`` on;
    before ``since`` redemptions of the bank count as receipts.
    """
    consolidated = month[:7] >= since[:7]
    if month[:7] == as_of[:7]:
        cents = F.max_by("bank_account_balance_cents", F.struct(F.coalesce("synced_at", F.lit("")), "bank_account_balance_cents"))
        out = ledger.agg(F.coalesce(cents / 100, F.lit(float(default_balance))).cast("decimal(18,2)").alias("cash"))
        if consolidated:
            inv = investment_account(bank, investments, since)
            out = out.withColumn("__k", F.lit(1)).join(inv.withColumn("__k", F.lit(1)), "__k").withColumn("cash", F.col("cash") + F.col("balance"))
        return out.select(F.col("cash").cast("double").alias("opening"))
    m, a = F.lit(month).cast("date"), F.lit(as_of).cast("date")
    z = F.lit(0).cast("decimal(18,2)")
    paid = F.col("paid") & D.in_month("due_date", m) & (F.col("due_date") < a)
    if consolidated:
        paid = paid & (F.coalesce(F.col("transaction_type"), F.lit("")) != "transfer")
    signed = F.when(F.col("transaction_type") == "revenue", money("amount")).otherwise(-money("amount"))
    out = ledger.agg(F.coalesce(F.sum(F.when(paid, signed)), z).alias("moved")).withColumn("__k", F.lit(1))
    if consolidated:
        back = ledger.sparkSession.range(1).select(z.alias("redeemed"))
    else:
        d, t = (F.lower(F.coalesce(F.col(c), F.lit(""))) for c in ("descricao", "titulo"))
        redeemed = (F.contains(d, F.lit("resgate")) | F.contains(d, F.lit("cdb")) | F.contains(t, F.lit("resgate"))) \
            & D.in_month("data_movimento", m) & (F.col("data_movimento") < a)
        back = bank.agg(F.coalesce(F.sum(F.when(redeemed, F.abs(money("valor_com_sinal")))), z).alias("redeemed"))
    out = out.join(back.withColumn("__k", F.lit(1)), "__k")
    return out.select((F.lit(month_opening).cast("decimal(18,2)") + F.col("moved") + F.col("redeemed")).cast("double").alias("opening"))


def project_months(prices: DataFrame, payments: DataFrame, occupancy: DataFrame, items: DataFrame,
                   ledger: DataFrame, schedule: DataFrame, base_month: str, opening: float,
                   horizon: int = 3, history: int | None = None, p: P.ProjectionParams = P.ProjectionParams()) -> DataFrame:
    """RP-19 for the club. ``history``: how many months of paid costs up to the
    base month count, all that the ledger holds if None; their mean is over the
    months that have any. Unpaid costs of the base month fall due in the first
    projected month. Where prices name their customer, slots of customers who
    have paid by debit card bear its fee."""
    spark = prices.sparkSession
    base = F.lit(base_month).cast("date")
    in_base = lambda c: D.in_month(c, base)
    z = F.lit(0).cast("decimal(18,2)")
    tuition = prices.agg(F.coalesce(F.sum("monthly_price").cast("double"), F.lit(0.0)).alias("base_tuition"))
    pay = payments.where(in_base(F.to_date("payment_date")))
    mix = pay.agg(F.sum(F.when(F.col("pay_method").isin(IMMEDIATE_METHODS), money("amount")).otherwise(z)).alias("i"),
                  F.sum(money("amount")).alias("t"))
    mix = mix.select(F.coalesce(F.try_divide(F.col("i").cast("double"), F.col("t").cast("double")), F.lit(0.0)).alias("r0"))
    mix = mix.withColumn("r30", F.when(F.col("r0") > 0, F.lit(1.0) - F.col("r0")).otherwise(F.lit(0.0)))
    occ = occupancy.where(F.col("month") == base).withColumn("kind", F.col("kind")) \
                   .withColumn("cls", R.hours_class())
    hours = occ.agg(F.sum(F.when(F.col("cls") == "fixed", F.col("hours")).otherwise(0.0)).cast("double").alias("fixed_hours"),
                    F.sum(F.when(F.col("cls").isin("maintenance", "single"), F.col("hours")).otherwise(0.0))
                    .cast("double").alias("static_hours"))
    other = items.where(in_base(F.to_date("pay_date"))) \
                 .withColumn("__c", R.revenue_class(R.REVENUE_CASH, "other").alias("c")) \
                 .agg(F.sum(F.when(F.col("__c") == "other", money("valor_faturamento")).otherwise(z)).cast("double")
                      .alias("other_base"))
    led = ledger.withColumn("month", D.month_start("due_date"))
    hist = led.where(F.col("paid") & (F.col("transaction_type") != "revenue")
                     & ~in_investments(led)
                     & (F.lit(history is None) | (F.col("month") > F.add_months(base, -(history or 0)))) & (F.col("month") <= base)) \
              .agg(F.coalesce(F.sum(money("amount")), z).cast("double").alias("roll_sum"),
                   F.greatest(F.countDistinct("month"), F.lit(1)).cast("int").alias("roll_cnt"))
    # one-row seeds: all inputs are global aggregates (single rows), combined in-row
    one = spark.range(1).select(F.lit(1).alias("club"))
    debit = []
    if "customer_code" in prices.columns:
        debit = [P.debit_base(prices, payments, [], p.growth).select(F.coalesce("debit_base", F.lit(0.0)).alias("debit_base"))]
    for part in (tuition, mix, hours, other, hist, *debit):
        one = one.join(part.withColumn("club", F.lit(1)), "club")
    one = one.withColumn("fixed_hours", F.coalesce("fixed_hours", F.lit(0.0))) \
             .withColumn("static_hours", F.coalesce("static_hours", F.lit(0.0))) \
             .withColumn("pt0", P.r2(F.col("base_tuition") * F.col("r30"))) \
             .withColumn("pv0", P.r2(F.col("other_base") * F.col("r30"))) \
             .withColumn("opening", F.lit(float(opening)))
    months = spark.range(1).select(F.explode(F.sequence(F.add_months(base, 1), F.add_months(base, horizon),
                                                        F.expr("interval 1 month"))).alias("month"))
    oh = W.open_hours(W.calendar(months), OPEN_HOURS)
    due = led.where(~F.col("paid") & (F.col("transaction_type") != "revenue")) \
             .withColumn("month", F.when(F.col("month") == base, F.add_months(base, 1)).otherwise(F.col("month")))
    inv = in_investments(led)
    sched = due.groupBy("month").agg(F.sum(F.when(~inv, money("amount")).otherwise(z)).cast("double").alias("sched_ops"),
                                     F.sum(F.when(inv, money("amount")).otherwise(z)).cast("double").alias("sched_inv"))
    imp = schedule.groupBy(D.month_start("release_date").alias("month")) \
                  .agg(F.sum(money("value")).cast("double").alias("imported"))
    m = months.join(oh, "month").join(sched, "month", "left").join(imp, "month", "left") \
              .select(F.struct("month", "open_hours", F.coalesce("sched_ops", F.lit(0.0)).alias("sched_ops"),
                               F.coalesce("sched_inv", F.lit(0.0)).alias("sched_inv"), "imported").alias("m"))
    arr = m.agg(F.array_sort(F.collect_list("m")).alias("months")).withColumn("club", F.lit(1))
    ent = one.join(arr, "club")
    return P.month_projection(ent, "club", p, static_hours="static_hours").drop("club")


# Weekday weights of the daily model (Sunday first).
DOW_WEIGHTS = [0.5, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0]


def overridden(ledger: DataFrame, overrides: DataFrame, month: str) -> DataFrame:
    """JN-13 on the ledger: edits by id (``custom_due_date, custom_amount, custom_name, custom_flow``), tombstones
    dropped, and the month's manual rows (``is_manual``, ``month_key``) added as unpaid expenses."""
    fields = {"due_date": "custom_due_date", "amount": "custom_amount", "name": "custom_name", "cost_center_descricao": "custom_flow"}
    kinds = dict(ledger.dtypes)
    manual = overrides.where(F.coalesce("is_manual", F.lit(False)) & ~F.coalesce("is_deleted", F.lit(False))
                             & (F.col("month_key") == month[:7]))
    rows = manual.select("id", *[F.col(v).cast(kinds[k]).alias(k) for k, v in fields.items()], F.lit(False).alias("paid"),
                         F.lit("expense").alias("transaction_type"))
    return J.apply_overrides(ledger, overrides, "id", fields, "is_deleted", "is_manual", rows)


def project_days(ledger: DataFrame, schedule: DataFrame, month: str, as_of: str, opening: float | DataFrame,
                 d30_remaining: float, d0_expected: float, commission_p1: float, commission_p2: float,
                 pace: float = 1.0, card_fee: float = 0.025, day_provision: float = 0.0,
                 period_cut: int = 20, base_costs: float | None = None, safety: float = 0.05,
                 overrides: DataFrame | None = None) -> DataFrame:
    """RP-18 for the club: one row per day from ``as_of`` to the month end.

    Receipts: the imported schedule's releases of the day when the month has
    any, else the month's remaining 30-day money spread by weekday weight over
    the remaining days (WN-8, CA-5); plus expected same-day sales by weight
    and pace; the as-of day nets what was already received. Outflows: daily
    provision and fees, ledger items due that day, overdue items (FL-10) on
    the as-of day, commission for the first period on ``period_cut`` and for
    the second on the last day. Running balance from ``opening`` (WN-4), a
    number or the one row of :func:`days_opening`.

    With ``base_costs``, the base month's fixed costs, the daily provision is
    their gap to the month's unpaid operating costs, earlier ones included,
    plus the ``safety`` share (AG-33); else it is ``day_provision``.
    ``overrides`` are laid over the ledger first (:func:`overridden`).
    """
    spark = ledger.sparkSession
    if overrides is not None:
        ledger = overridden(ledger, overrides, month)
    m = F.lit(month).cast("date")
    a = F.greatest(F.lit(as_of).cast("date"), m)  # CA-6: a later month starts at day 1, an earlier one has no days left
    warr = F.array(*[F.lit(x) for x in DOW_WEIGHTS])
    weight = lambda c: F.element_at(warr, F.dayofweek(c))
    all_days = F.sequence(m, F.last_day(m))
    total_w = F.aggregate(F.transform(all_days, weight), F.lit(0.0), lambda x, y: x + y)
    rem_w = F.greatest(F.aggregate(F.transform(all_days, lambda c: F.when(c >= a, weight(c)).otherwise(F.lit(0.0))),
                                   F.lit(0.0), lambda x, y: x + y), F.lit(1.0))
    days = spark.range(1).select(F.explode(D.open_days(m, F.lit(as_of))).alias("day"), total_w.alias("total_w"),
                                 rem_w.alias("rem_w")).withColumn("w", weight(F.col("day")))
    z = F.lit(0).cast("decimal(18,2)")
    sched = schedule.where(D.in_month("release_date", m)).groupBy(F.col("release_date").alias("day")) \
                    .agg(F.sum(money("value")).cast("double").alias("imported"))
    inv = in_investments(ledger)
    cost = F.col("transaction_type") != "revenue"
    # one pass over the ledger; what follows reads one row per day of it
    by_day = ledger.groupBy(F.col("due_date").alias("day")).agg(*[
        F.sum(F.when(c, money("amount")).otherwise(z)).alias(n) for n, c in (
            ("ops", ~F.col("paid") & cost & ~inv), ("inv", ~F.col("paid") & cost & inv), ("received", F.col("paid") & ~cost))])
    early = F.col("day") < a
    totals = by_day.agg(F.sum(F.when(early, F.col("ops"))).cast("double").alias("over_ops"),
                        F.sum(F.when(early, F.col("inv"))).cast("double").alias("over_inv"),
                        F.coalesce(F.sum(F.when(F.col("day") <= F.last_day(m), F.col("ops"))), z).cast("double").alias("scheduled"))
    n_imp = sched.agg(F.count(F.lit(1)).alias("n_imported"))
    x = days.withColumn("__k", F.lit(1))
    for one_row in (totals, n_imp):
        x = x.join(one_row.withColumn("__k", F.lit(1)), "__k")
    x = x.join(sched, "day", "left").join(by_day.select("day", *[F.col(c).cast("double").alias(c) for c in ("ops", "inv", "received")]),
                                          "day", "left")
    r2 = P.r2
    block1 = F.when(F.col("n_imported") > 0, F.coalesce("imported", F.lit(0.0))) \
              .otherwise(r2(F.lit(float(d30_remaining)) * (F.col("w") / F.col("rem_w"))))
    block2 = r2(F.lit(float(d0_expected)) * F.col("w") / F.col("total_w") * F.lit(float(pace)))
    first = F.col("day") == a
    raw = r2(block1 + block2)
    inflow = F.when(first, r2(F.greatest(F.lit(0.0), raw - r2(F.coalesce("received", F.lit(0.0)))))).otherwise(raw)
    last = F.col("day") == F.last_day("day")
    start_day = int(as_of[-2:]) if as_of[:7] == month[:7] else 1
    comm = F.when(F.dayofmonth("day") == period_cut, F.lit(float(commission_p1) if start_day <= period_cut else 0.0)) \
            .otherwise(F.lit(0.0)) \
        + F.when(last, F.lit(float(commission_p2) + (float(commission_p1) if start_day > period_cut else 0.0))) \
           .otherwise(F.lit(0.0))
    provided = F.lit(float(day_provision))
    if base_costs is not None:
        provided = r2(G.provision(F.lit(float(base_costs)) - F.col("scheduled"), F.col("scheduled"), safety, F.dayofmonth(F.last_day(m))))
    out_ops = r2(r2(provided + r2(block1 * F.lit(card_fee))) + F.coalesce("ops", F.lit(0.0))
                 + F.when(first, F.coalesce("over_ops", F.lit(0.0))).otherwise(F.lit(0.0)) + comm)
    out_inv = r2(F.coalesce("inv", F.lit(0.0)) + F.when(first, F.coalesce("over_inv", F.lit(0.0))).otherwise(F.lit(0.0)))
    y = x.select("day", inflow.alias("inflow"), out_ops.alias("outflow_ops"), out_inv.alias("outflow_inv"),
                 F.lit(1).alias("__k"), *([] if isinstance(opening, DataFrame) else [F.lit(float(opening)).alias("opening")]))
    if isinstance(opening, DataFrame):
        y = y.join(opening.withColumn("__k", F.lit(1)), "__k")
    y = y.withColumn("receipts", F.col("inflow")).withColumn("outflows", F.col("outflow_ops") + F.col("outflow_inv"))
    return P.daily_projection(y, "__k", "opening").drop("__k", "receipts", "outflows")
