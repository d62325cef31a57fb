"""RP-2 (and RP-22) on the domain tables: the commission dashboard for a month,
for every teacher at once.

Inputs: the commission detail (:mod:`ledgerly.plans.commission`), vouchers
(sales rows ``description, total, pay_date, customer_name``) and payouts
(``professor, amount, reference_period``). Rates, multipliers and the month
are parameters.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerly.functions import dates as D
from ledgerly.functions.num import js_or
from ledgerly.operators import agg as G
from ledgerly.operators import estimate as X
from ledgerly.operators import filters as FL
from ledgerly.operators import joins as J
from ledgerly.operators import rules as R


@dataclass
class DashboardRules:
    rate: float = 0.10
    # CL-16: (name part 1, name part 2, from date, factor) on the participant name
    multipliers: list = field(default_factory=list)
    period_cut: int = 20
    periods_by_pay_date: bool = False      # RP-22: the earlier dashboard split periods by pay date


def commission_dashboard(detail: DataFrame, vouchers: DataFrame, payouts: DataFrame, month: str,
                         r: DashboardRules = DashboardRules()) -> tuple[DataFrame, DataFrame]:
    """Returns ``(students, summary)``.

    * paid: paid rows with pay date in the month and a positive value (FL-5,
      N1); base falls back to the value and takes the dated multiplier
      (CL-16); period by class date (CL-17), or by pay date for RP-22;
    * vouchers: valid vouchers (FL-6) whose teacher name matches a teacher by
      folded two-way containment (JN-14), period by pay date;
    * pending: unpaid rows with class date in the month, estimated per
      student (AL-9);
    * per student (AG-8) and per teacher: billed, commission base, commission
      at the rate, payouts of the month's reference period and balance
      (AG-24); a teacher with payouts only has a row, too.
    """
    m = F.lit(month).cast("date")
    d = detail.withColumn("__val", js_or("booking_value", 0.0))
    paid = d.where(F.col("is_paid") & D.in_month(F.to_date("pay_date"), m) & (F.col("__val") > 0))
    mult = R.dated_multiplier(r.multipliers, "participant_name", "booking_date") if r.multipliers else F.lit(1.0)
    paid = paid.withColumn("__base", js_or("booking_commission_base", F.col("__val")) * mult) \
               .withColumn("__period", D.period_of("pay_date" if r.periods_by_pay_date else "booking_date", r.period_cut))
    paid_rows = paid.select("professor", F.col("participant_name").alias("student"), F.col("__val").alias("billed"),
                            F.col("__base").alias("base"), "__period", F.col("is_socio_benefit").alias("is_socio"))

    teachers = detail.select("professor").where(F.col("professor").isNotNull()).distinct()
    vv = FL.valid_vouchers(vouchers, "description", "total", "description") \
           .where(D.in_month(F.to_date("pay_date"), m))
    vm = J.fuzzy_contains(vv, "voucher_name", teachers, "professor")
    v_rows = vm.select("professor", F.concat(F.coalesce("customer_name", F.lit("Voucher")), F.lit(" (voucher)"))
                       .alias("student"), F.col("total").cast("double").alias("billed"),
                       F.col("total").cast("double").alias("base"),
                       D.period_of("pay_date", r.period_cut).alias("__period"), F.lit(False).alias("is_socio"))
    # sums run on decimals, so they do not depend on addition order
    all_paid = paid_rows.unionByName(v_rows).withColumns({c: F.col(c).cast(X.EXACT) for c in ("billed", "base")})

    pend = d.where(~F.col("is_paid") & D.in_month("booking_date", m)).select(
        F.struct("professor", "participant_name").alias("student"), "booking_id", "booking_date",
        "start_time", "description", "booking_type", F.col("is_socio_benefit").alias("is_socio"),
        F.col("booking_commission_base").alias("commission_base"), mult.cast("double").alias("multiplier"))
    per_b, per_s = X.estimate_pending(pend)
    first = D.period_of("booking_date", r.period_cut) == 1
    pend_p = per_b.where(~F.col("is_free")).groupBy(F.col("student.professor").alias("professor")).agg(*[
        F.sum(F.when(first if p == 1 else ~first, F.col(c).cast(X.EXACT)).otherwise(F.lit(0).cast(X.EXACT))).alias(f"pending_p{p}_{n}")
        for p in (1, 2) for n, c in (("billed", "estimated_value"), ("base", "comm_base"))])
    pend_rows = per_s.select(F.col("student.professor").alias("professor"),
                             F.col("student.participant_name").alias("student"),
                             F.col("total_billed").cast("double").alias("billed"),
                             F.col("commission_base").cast("double").alias("base"),
                             F.col("n_bookings").alias("classes"), "is_socio")

    students = all_paid.groupBy("professor", "student").agg(
        F.count(F.lit(1)).alias("classes"), F.sum("billed").cast("double").alias("billed"), F.sum("base").cast("double").alias("base"),
        F.bool_or("is_socio").alias("is_socio")).withColumn("status", F.lit("paid")) \
        .unionByName(pend_rows.withColumn("status", F.lit("pending")))

    p1, none = F.col("__period") == 1, F.lit(0).cast(X.EXACT)
    paid_t = all_paid.groupBy("professor").agg(
        F.sum("billed").alias("paid_billed"), F.sum("base").alias("paid_base"),
        F.sum(F.when(p1, F.col("billed")).otherwise(none)).alias("p1_billed"),
        F.sum(F.when(p1, F.col("base")).otherwise(none)).alias("p1_base"),
        F.sum(F.when(~p1, F.col("billed")).otherwise(none)).alias("p2_billed"),
        F.sum(F.when(~p1, F.col("base")).otherwise(none)).alias("p2_base"))
    pend_t = pend_rows.groupBy("professor").agg(F.sum("billed").alias("pending_billed"),
                                                F.sum("base").alias("pending_base"))
    out_t = payouts.where(D.in_month("reference_period", m)).groupBy("professor") \
        .agg(F.sum(F.col("amount").cast("decimal(18,2)")).cast("double").alias("paid_out"))
    summary = paid_t.join(pend_t, "professor", "full_outer").join(out_t, "professor", "full_outer")
    summary = summary.join(pend_p, "professor", "left")
    z = F.lit(0.0)
    summary = summary.select(
        "professor", *[F.round(F.coalesce(F.col(c).cast("double"), z), 2).alias(c) for c in
                       ("paid_billed", "paid_base", "p1_billed", "p1_base", "p2_billed", "p2_base",
                        "pending_billed", "pending_base", "pending_p1_billed", "pending_p1_base", "pending_p2_billed",
                        "pending_p2_base", "paid_out")])
    rate = F.lit(str(r.rate)).cast("decimal(9,6)")

    def share(base):
        return F.round(F.col(base).cast("decimal(18,2)") * rate, 2).cast("double")
    summary = summary.withColumn("commission", share("paid_base")).withColumn("pending_commission", share("pending_base")) \
                     .withColumn("balance", F.round(F.col("commission") - F.col("paid_out"), 2))
    return students, summary


#: Sections of the student table.
MEMBERS, REGULARS = "Sócios", "Regulares"


def student_table(students: DataFrame) -> DataFrame:
    """The student rows of RP-2 with their totals (AG-8, AG-10), in one ``GROUPING SETS`` pass.

    ``students``: the first result of :func:`commission_dashboard`. Rows of
    ``level`` student (per teacher, section, student and status), section
    (members or regular students of a teacher), teacher and total; what a row
    sums over is null. Columns ``level, professor, section, student, status,
    classes, billed, base``.
    """
    rows = students.select("professor", F.when(F.col("is_socio"), MEMBERS).otherwise(REGULARS).alias("section"), "student", "status",
                           "classes", *[F.col(c).cast(X.EXACT).alias(c) for c in ("billed", "base")])
    sets = [["professor", "section", "student", "status"], ["professor", "section"], ["professor"], []]
    by = [F.col(c) for c in sets[0]]
    out = rows.groupingSets([[F.col(c) for c in s] for s in sets], *by).agg(
        F.grouping("student").alias("__s"), F.grouping("section").alias("__c"), F.grouping("professor").alias("__p"),
        F.sum("classes").alias("classes"), F.round(F.sum("billed"), 2).cast("double").alias("billed"),
        F.round(F.sum("base"), 2).cast("double").alias("base"))
    level = F.when(F.col("__s") == 0, "student").when(F.col("__c") == 0, "section").when(F.col("__p") == 0, "teacher").otherwise("total")
    return out.select(level.alias("level"), *sets[0], "classes", "billed", "base")


def teacher_table(detail: DataFrame, vouchers: DataFrame, month: str, r: DashboardRules = DashboardRules(),
                  unknown: str = "Desconhecido", total: str = "Total Geral") -> DataFrame:
    """The teacher table of RP-21 (AG-9): classes, billed and commission of what was paid in the month, with a total row.

    Paid classes count whatever their value; valid vouchers (FL-6) paid in the
    month count as a class of the teacher that they name. Columns ``professor,
    is_total, classes, billed, commission``.
    """
    m = F.lit(month).cast("date")
    val = js_or("booking_value", 0.0)
    mult = R.dated_multiplier(r.multipliers, "participant_name", "booking_date") if r.multipliers else F.lit(1.0)
    paid = detail.where(F.col("is_paid") & D.in_month(F.to_date("pay_date"), m)).select(
        F.coalesce("professor", F.lit(unknown)).alias("professor"), val.alias("billed"),
        (js_or("booking_commission_base", val) * mult).alias("base"))
    vv = FL.valid_vouchers(vouchers, "description", "total", "description").where(D.in_month(F.to_date("pay_date"), m))
    rows = paid.unionAll(vv.select("voucher_name", F.col("total").cast("double"), F.col("total").cast("double")))
    rows = rows.withColumns({c: F.col(c).cast(X.EXACT) for c in ("billed", "base")})
    rate = F.lit(str(r.rate)).cast("decimal(9,6)")
    t = G.with_total(rows, ["professor"], [F.count(F.lit(1)).alias("classes"), F.sum("billed").alias("billed"),
                                           F.sum("base").alias("base")], total)
    return t.select("professor", "is_total", "classes", F.round("billed", 2).cast("double").alias("billed"),
                    F.round(F.col("base") * rate, 2).cast("double").alias("commission"))
