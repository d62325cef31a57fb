"""RP-1 on ten-row domain fixtures (FIXTURES.md): three tiers, loose match by
text, unallocated item labelled by the nearest group booking, share split."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerly.plans.commission import CommissionRules, commission_detail


def _tables(spark):
    participants = spark.createDataFrame(
        [(1, "C1", "Alice Example"), (2, "C1", "Alice Example"), (3, "C2", "Bruno Sample"), (4, "C1", "Alice Example"),
         (5, "C3", "Carla Tester"), (6, "C1", "Alice Example")],
        "booking_id bigint, customer_code string, participant_name string")
    bookings = spark.createDataFrame([
        (1, dt.date(2026, 7, 6), "18:00", "ACTIVE", "clase_colectiva", "Turma (2 / 4) Prof: Dan", "club", "Court 1"),
        (2, dt.date(2026, 7, 13), "18:00", "ACTIVE", "clase_colectiva", "Turma (2 / 4) Prof: Dan", "club", "Court 1"),
        (3, dt.date(2026, 7, 7), "09:00", "ACTIVE", "clase_suelta", "Aula avulsa Prof: Eve", "club", "Court 2"),
        (4, dt.date(2026, 7, 8), "10:00", "ACTIVE", "clase_colectiva", "Dupla (1 / 2) Prof: Fay", "club", "Court 2"),
        (5, dt.date(2026, 7, 18), "10:00", "ACTIVE", "clase_colectiva", "Grupo Prof: Gus", "club", "Court 3"),
        (6, dt.date(2026, 7, 20), "18:00", "CANCELLED", "clase_colectiva", "Turma (2 / 4) Prof: Dan", "club", "Court 1"),
    ], "booking_id bigint, booking_date date, start_time string, status string, booking_type string, "
       "description string, venue string, resource_name string")
    booking_payments = spark.createDataFrame([(99, dt.datetime(2026, 7, 1), Decimal("1.00"))],
                                             "booking_id bigint, payment_date timestamp, amount decimal(18,2)")
    sales = spark.createDataFrame([
        ("V1", "C1", True, False, "sale", dt.datetime(2026, 7, 2, 10), dt.date(2026, 7, 1)),
        ("V2", "C2", True, False, None, dt.datetime(2026, 7, 7, 9, 30), dt.date(2026, 7, 7)),
        ("V3", "C3", False, False, "sale", None, dt.date(2026, 7, 3)),
        ("V4", "C1", True, False, "refund", dt.datetime(2026, 7, 3), dt.date(2026, 7, 3)),
    ], "external_id string, customer_code string, paid boolean, is_canceled boolean, tipo string, "
       "pay_date timestamp, data_venda date")
    items = spark.createDataFrame([
        ("I1", "V1", "Mensalidade GRUPO julho 26", "Aulas", None, Decimal("300.00"), Decimal("335.00"), False),
        ("I2", "V2", "Aula avulsa 07/07/2026 09:00", "Aulas", "Avulsa - Particular", Decimal("120.00"), None, False),
        ("I3", "V3", "Plano DUPLA 01/07/2026-31/07/2026", "Aulas", None, Decimal("430.00"), None, False),
        ("I4", "V1", "Aula extra", "Outros", None, Decimal("50.00"), None, False),
        ("I5", "V1", "Mensalidade agosto 26 TRIO", "Aulas", None, Decimal("395.00"), None, False),
        ("I6", "V4", "Mensalidade GRUPO julho 26", "Aulas", None, Decimal("300.00"), None, False),
    ], "item_key string, venda_external_id string, description string, categoria string, subcategoria string, "
       "valor_faturamento decimal(18,2), valor_bruto decimal(18,2), is_canceled boolean")
    clients = spark.createDataFrame([("C1", "Alice E."), ("C2", "Bruno S."), ("C3", "Carla T.")],
                                    "customer_code string, name string")
    return participants, bookings, booking_payments, sales, items, clients


def test_commission_detail_on_domain_fixtures(spark):
    rules = CommissionRules(split_rules=[(6, "10:00", "Gus", "Hal", 0.5)])
    rows = commission_detail(*_tables(spark), rules).collect()
    got = sorted((r.booking_id or 0, r.booking_type, r.professor, round(r.booking_value, 2), bool(r.is_paid))
                 for r in rows)
    assert got == sorted([
        (1, "clase_colectiva", "Dan", 150.0, True),     # tier a: GRUPO item on the GRUPO slot, 2 bookings
        (2, "clase_colectiva", "Dan", 150.0, True),
        (4, "clase_colectiva", "Fay", 0.0, True),       # DUPLA slot gets nothing of the GRUPO item
        (3, "clase_suelta", "Eve", 120.0, True),        # matched by date and time in the item text
        (5, "clase_colectiva", "Gus", 215.0, False),    # tier b (no DUPLA slot, uncovered GRUPO slot), split
        (5, "clase_colectiva", "Hal", 215.0, False),
        (0, "unallocated_payment", "Dan", 395.0, True),  # August: no slot; nearest group booking is Dan's
    ])
    un = [r for r in rows if r.booking_type == "unallocated_payment"][0]
    assert un.participant_name == "Alice E." and un.booking_date == dt.date(2026, 7, 2)


def test_commission_detail_tiers_payment_match_member_and_null_teacher(spark):
    participants = spark.createDataFrame(
        [(1, "C1", "Alice Example"), (2, "C1", "Alice Example"), (3, "C1", "Alice Example"),
         (4, "C2", "Bruno Sample"), (5, "C2", "Bruno Sample"), (6, "C3", "Carla Tester")],
        "booking_id bigint, customer_code string, participant_name string")
    bookings = spark.createDataFrame([
        (1, dt.date(2026, 7, 6), "18:00", "ACTIVE", "clase_colectiva", "Turma (2 / 4) Prof: Dan", "c", "r"),
        (2, dt.date(2026, 7, 8), "10:00", "ACTIVE", "clase_colectiva", "Dupla (1 / 2) Prof: Fay", "c", "r"),
        (3, dt.date(2026, 7, 20), "18:00", "ACTIVE", "clase_colectiva", "Turma (2 / 4)", "c", "r"),
        (4, dt.date(2026, 7, 7), "08:00", "ACTIVE", "clase_colectiva", "Turma (3 / 6) Prof: Ian", "c", "r"),
        (5, dt.date(2026, 7, 9), "08:00", "ACTIVE", "clase_colectiva", "Dupla (2 / 2) Prof: Jo", "c", "r"),
        (6, dt.date(2026, 7, 9), "11:00", "ACTIVE", "clase_suelta", "Aula Prof: Kim", "c", "r"),
    ], "booking_id bigint, booking_date date, start_time string, status string, booking_type string, "
       "description string, venue string, resource_name string")
    booking_payments = spark.createDataFrame([(6, dt.datetime(2026, 7, 9, 11, 30), Decimal("90.00"))],
                                             "booking_id bigint, payment_date timestamp, amount decimal(18,2)")
    sales = spark.createDataFrame([
        ("V1", "C1", True, False, "sale", dt.datetime(2026, 7, 2, 10), dt.date(2026, 7, 1)),
        ("V2", "C2", True, False, "sale", dt.datetime(2026, 7, 3, 10), dt.date(2026, 7, 3)),
        ("V3", "C3", True, False, "sale", dt.datetime(2026, 7, 9, 11, 30), dt.date(2026, 7, 9)),
    ], "external_id string, customer_code string, paid boolean, is_canceled boolean, tipo string, "
       "pay_date timestamp, data_venda date")
    items = spark.createDataFrame([
        ("I1", "V1", "Plano TRIO julho 26", "Aulas", None, Decimal("200.00"), None, False),
        ("I2", "V1", "Mensalidade GRUPO julho 26 Sócio", "Aulas", None, Decimal("100.00"), Decimal("150.00"), False),
        ("I3", "V2", "Mensalidade GRUPO julho 26", "Aulas", None, Decimal("335.00"), None, False),
        ("I4", "V2", "Mensalidade DUPLA julho 26", "Aulas", None, Decimal("430.00"), None, False),
        ("I5", "V2", "Plano INDIVIDUAL julho 26", "Aulas", None, Decimal("720.00"), None, False),
        ("I6", "V3", "Aula particular", "Aulas", None, Decimal("90.00"), None, False),
    ], "item_key string, venda_external_id string, description string, categoria string, subcategoria string, "
       "valor_faturamento decimal(18,2), valor_bruto decimal(18,2), is_canceled boolean")
    clients = spark.createDataFrame([("C1", "Alice E.")], "customer_code string, name string")
    rules = CommissionRules(member_patterns=["Sócio"])
    rows = commission_detail(participants, bookings, booking_payments, sales, items, clients, rules).collect()
    got = {r.booking_id: (r.professor, round(r.booking_value, 2), round(r.booking_commission_base, 2)) for r in rows}
    assert got[1] == ("Dan", 50.0, 75.0)            # tier a, GRUPO shared with the teacher-less slot; member base
    assert got[3] == ("Sem professor", 0.0, 0.0)    # null teacher never joins its slot (N4)
    assert got[2] == ("Fay", 200.0, 200.0)          # tier b: TRIO has no slot, DUPLA slot is uncovered
    assert got[4] == ("Ian", round(335 + 720 * 335 / 765, 2), round(335 + 720 * 335 / 765, 2))  # tier c
    assert got[5] == ("Jo", round(430 + 720 * 430 / 765, 2), round(430 + 720 * 430 / 765, 2))
    assert got[6] == ("Kim", 90.0, 90.0)            # matched through the booking payment row
    assert not [r for r in rows if r.booking_type == "unallocated_payment"]


def test_dashboard_paid_pending_vouchers_and_balance(spark):
    from ledgerly.plans.dashboard import DashboardRules, commission_dashboard
    detail = spark.createDataFrame([
        (1, dt.date(2026, 7, 6), "18:00", "clase_colectiva", "Turma (1 / 4)", "Dan", "Alice Example",
         150.0, 0.0, False, True, dt.datetime(2026, 7, 2)),
        (2, dt.date(2026, 7, 22), "18:00", "clase_colectiva", "Turma (1 / 4)", "Dan", "Alice Example",
         150.0, 200.0, True, True, dt.datetime(2026, 7, 2)),
        (3, dt.date(2026, 7, 8), "11:00", "clase_colectiva", "Dupla (1 / 2)", "Dan", "Bruno Sample",
         0.0, 0.0, False, False, None),
        (4, dt.date(2026, 7, 15), "11:00", "clase_colectiva", "Dupla (1 / 2)", "Dan", "Bruno Sample",
         0.0, 0.0, False, False, None),
    ], "booking_id bigint, booking_date date, start_time string, booking_type string, description string, "
       "professor string, participant_name string, booking_value double, booking_commission_base double, "
       "is_socio_benefit boolean, is_paid boolean, pay_date timestamp")
    vouchers = spark.createDataFrame([
        ("Voucher INTENSIVÃO - 4 aulas - dan", 400.0, dt.datetime(2026, 7, 25), "Carla"),
        ("Voucher INTENSIVÃO - 4 aulas - Dan ANULADO", 300.0, dt.datetime(2026, 7, 25), "Dora"),
    ], "description string, total double, pay_date timestamp, customer_name string")
    payouts = spark.createDataFrame([("Dan", Decimal("20.00"), dt.date(2026, 7, 1)), ("Dan", Decimal("500.00"), dt.date(2026, 6, 1)),
                                     ("Eva", Decimal("7.00"), dt.date(2026, 7, 1))],
                                    "professor string, amount decimal(18,2), reference_period date")
    students, summary = commission_dashboard(detail, vouchers, payouts, "2026-07-01", DashboardRules(rate=0.10))
    by = {r.professor: r for r in summary.collect()}
    assert by["Eva"].paid_out == 7.0 and by["Eva"].balance == -7.0   # payouts only; June's payout belongs to June
    s = by["Dan"]
    assert s.paid_billed == 700.0 and s.paid_base == 750.0       # 150 + 150 + voucher 400; base 150 + 200 + 400
    assert s.p1_billed == 150.0 and s.p2_billed == 550.0          # class day 6 | class day 22, voucher day 25
    # pending: one DUPLA slot on Wednesdays at 11:00 (5 Wednesdays in July 2026), 2 bookings:
    # 2/5 x 430, off-peak (weekday, 10..15h) so 12% off instead of a frequency discount
    assert s.pending_billed == round(2 / 5 * 430 * 0.88, 2)
    assert s.pending_p1_billed == s.pending_billed and s.pending_p2_billed == 0.0   # 8 and 15 July
    assert s.commission == 75.0 and s.balance == 55.0
    st = {(x.student, x.status) for x in students.collect()}
    assert ("Bruno Sample", "pending") in st and ("Carla (voucher)", "paid") in st


def test_pending_slots_are_keyed_by_start_time_and_take_the_multiplier(spark):
    from ledgerly.operators import estimate as X
    rows = [(1, "a", dt.date(2026, 7, 7), "18:00"), (2, "a", dt.date(2026, 7, 7), "18:30"), (3, "b", dt.date(2026, 7, 7), None)]
    b = spark.createDataFrame(rows, "booking_id int, student string, booking_date date, start_time string") \
        .withColumn("description", F.lit("Turma (1 / 4)")).withColumn("booking_type", F.lit("clase_colectiva")) \
        .withColumn("is_socio", F.lit(False)).withColumn("commission_base", F.lit(0.0))
    _, per = X.estimate_pending(b)
    got = {r.student: r for r in per.collect()}
    assert got["a"].n_slots == 2 and got["b"].n_slots == 1 and got["b"].total_billed > 0


def test_nearest_booking_may_be_denied_or_without_text(spark):
    participants, bookings, pays, sales, items, clients = _tables(spark)
    more = spark.createDataFrame([
        (7, dt.date(2026, 8, 1), "18:00", "ACTIVE", "clase_colectiva", "RESERVA MENSAL Prof: Zoe", "club", "Court 1"),
        (8, dt.date(2026, 9, 1), "18:00", "ACTIVE", "clase_colectiva", None, "club", "Court 1")], bookings.schema)
    booked = spark.createDataFrame([(7, "C1", "Alice Example"), (8, "C2", "Bruno Sample")], participants.schema)
    late = spark.createDataFrame([("V5", "C1", True, False, "sale", dt.datetime(2026, 8, 3), dt.date(2026, 8, 3)),
                                  ("V6", "C2", True, False, "sale", dt.datetime(2026, 9, 3), dt.date(2026, 9, 3))], sales.schema)
    sold = spark.createDataFrame([("I7", "V5", "Mensalidade agosto 26 GRUPO", "Aulas", None, Decimal("10.00"), None, False),
                                  ("I8", "V6", "Mensalidade setembro 26 GRUPO", "Aulas", None, Decimal("20.00"), None, False)], items.schema)
    rows = commission_detail(participants.unionAll(booked), bookings.unionAll(more), pays, sales.unionAll(late), items.unionAll(sold), clients).collect()
    un = {r.booking_value: r.professor for r in rows if r.booking_type == "unallocated_payment"}
    assert un[10.0] == "Zoe" and un[20.0] == "Sem professor"  # the booking without a text names nobody
    assert 7 not in {r.booking_id for r in rows}


def test_sponsor_lines_count_twice_in_the_commission_base_only(spark):
    participants, bookings, pays, sales, items, clients = _tables(spark)
    items = items.withColumn("description", F.when(F.col("item_key") == "I1", "Patrocínio GRUPO julho 26").otherwise(F.col("description")))
    rows = commission_detail(participants, bookings, pays, sales, items, clients, CommissionRules(double_patterns=["Patrocínio"])).collect()
    own = [r for r in rows if r.booking_id in (1, 2)]
    assert {(r.booking_value, r.booking_commission_base, r.booking_commission_base_monthly) for r in own} == {(150.0, 300.0, 167.5)}
