"""Estimates of unpaid and recurring revenue (AL-9, AL-10).

Input is a bookings frame with the columns
``student, booking_id, booking_date, hour, description, booking_type, is_socio``
(plus an optional ``commission_base``). Slots are (student, month, weekday,
hour[, price category]); a student's slots are few (a weekly timetable), so
each step is a grouped aggregate on the student key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerly.functions import dates as D
from ledgerly.functions.num import js_or
from ledgerly.operators import rules as R
from ledgerly.operators import windows as W
from ledgerly.session import stage

# The off-peak rate that replaces the frequency discount.
OFF_PEAK_RATE = 0.88
EXACT = "decimal(24,6)"


def _prepared(b: DataFrame) -> DataFrame:
    price = R.price_for("description", "booking_type")
    # a slot is keyed by its start time; a missing time is midnight
    if "start_time" in b.columns:
        b = b.withColumn("start_time", F.coalesce("start_time", F.lit("00:00"))) \
             .withColumn("hour", F.coalesce(F.split("start_time", ":").getItem(0).try_cast("int"), F.lit(0)))
    else:
        b = b.withColumn("start_time", F.coalesce(F.col("hour"), F.lit(0)).cast("string"))
    return (b.withColumn("month", F.trunc("booking_date", "MM"))
             .withColumn("dow", D.js_dow("booking_date"))
             .withColumn("is_free", R.is_free("description", "booking_type"))
             .withColumn("price", price))


def estimate_pending(bookings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """AL-9: expected value of unpaid bookings per student and month.

    Free bookings are worth 0. The rest form slots (weekday, start time, price
    category); a monthly slot is worth ``n / weekday occurrences x price``, a
    single-lesson slot ``n x price``; an off-peak slot takes 12% off
    **instead of** the frequency discount (2 slots 5%, 3+ 7%). Each booking
    gets its slot's value over its bookings. The commission base of a booking
    is its own base, else twice the estimate for members, else the estimate;
    a student whose bases sum to zero falls back to the billed total.

    Returns (per booking, per student-month).
    """
    b = stage(_prepared(bookings))  # texts and prices are read once, by slots, bookings and students
    paying = b.where(~F.col("is_free"))
    slots = paying.groupBy("student", "month", "dow", "start_time", "hour", F.col("price.category").alias("category"),
                           F.col("price.price").alias("unit_price"),
                           F.col("price.is_monthly").alias("is_monthly")) \
                  .agg(F.count(F.lit(1)).alias("n"))
    nslots = slots.groupBy("student", "month").agg(F.count(F.lit(1)).alias("n_slots"))
    cal = W.weekday_count(W.calendar(slots.select("month").distinct())) \
           .select("month", F.col("js_dow").alias("dow"), "occurrences")
    s = slots.join(nslots, ["student", "month"]).join(cal, ["month", "dow"], "left")
    pro = F.when(F.col("is_monthly"), F.col("n") / F.col("occurrences") * F.col("unit_price")) \
           .otherwise(F.col("n") * F.col("unit_price"))
    off = (F.col("dow") >= 1) & (F.col("dow") <= 5) & (F.col("hour") >= 10) & (F.col("hour") <= 15)
    s = s.withColumn("slot_value", F.when(off, pro * OFF_PEAK_RATE)
                                    .otherwise(pro * (F.lit(1.0) - R.freq_discount("n_slots"))))
    s = s.withColumn("per_booking", F.col("slot_value") / F.col("n"))
    # sums run on 6-decimal values so they do not depend on addition order
    s = s.withColumn("slot_value_dec", F.col("slot_value").cast(EXACT))
    per_b = b.withColumn("category", F.col("price.category")) \
             .join(s.select("student", "month", "dow", "start_time", "category", "per_booking"),
                   on=["student", "month", "dow", "start_time", "category"], how="left")
    est = F.when(F.col("is_free"), F.lit(0.0)).otherwise(F.col("per_booking"))
    cb_col = F.col("commission_base") if "commission_base" in bookings.columns else F.lit(None)
    # CL-16: a booking's own multiplier, whatever its base comes from
    factor = F.coalesce(F.col("multiplier"), F.lit(1.0)) if "multiplier" in bookings.columns else F.lit(1.0)
    per_b = per_b.withColumn("estimated_value", est) \
                 .withColumn("comm_base", (js_or(cb_col, F.when(F.col("is_socio"), F.col("estimated_value") * 2)
                                                       .otherwise(F.col("estimated_value"))) * factor).cast(EXACT))
    billed = s.groupBy("student", "month").agg(F.sum("slot_value_dec").alias("total_billed"),
                                               F.max("n_slots").alias("n_slots"))
    base = per_b.groupBy("student", "month").agg(F.count(F.lit(1)).alias("n_bookings"),
                                                 F.sum("comm_base").alias("__cb"),
                                                 F.bool_or("is_socio").alias("is_socio"))
    per_s = base.join(billed, ["student", "month"], "left") \
                .withColumn("total_billed", F.coalesce("total_billed", F.lit(0).cast(EXACT))) \
                .withColumn("n_slots", F.coalesce("n_slots", F.lit(0)).cast("bigint")) \
                .withColumn("commission_base", F.when(F.col("__cb") == 0, F.col("total_billed"))
                                                .otherwise(F.col("__cb"))).drop("__cb")
    return per_b.drop("price"), per_s


# Monthly package price by class for 1, 2 and 3+ weekly slots.
PACKAGES = [("Individual", 720.0, 1296.0, 1836.0), ("Dupla", 430.0, 774.0, 1096.50),
            ("Trio", 395.0, 711.0, 1007.25), ("Grupo", 335.0, 603.0, 854.25)]


def package_price(category, n_slots):
    """Package price of the main category for the number of weekly slots."""
    cat = F.col(category) if isinstance(category, str) else category
    n = F.col(n_slots) if isinstance(n_slots, str) else n_slots

    def pick(p1, p2, p3):
        return F.when(n == 1, F.lit(p1)).when(n == 2, F.lit(p2)).otherwise(F.lit(p3))
    out = pick(*PACKAGES[-1][1:])
    for name, p1, p2, p3 in reversed(PACKAGES[:-1]):
        out = F.when(F.contains(cat, F.lit(name)), pick(p1, p2, p3)).otherwise(out)
    return out


def recurring_price(bookings: DataFrame, history: DataFrame, ts_order: str = "booking_id") -> DataFrame:
    """AL-10: monthly price per student.

    ``history`` = (student, latest_sum) from AG-21. A student with history
    takes that sum when positive (none otherwise). A new student takes the
    package price of the category of their earliest paying slot for 1, 2 or
    3+ distinct (weekday, start time) slots, less the strongest discount of any
    booking (member 50% over off-peak 12%, CL-14)."""
    b = _prepared(bookings).where(F.col("booking_type") != "clase_suelta")
    d = F.upper(F.coalesce(F.col("description"), F.lit("")))
    member = F.contains(d, F.lit("SÓCIO")) | F.contains(d, F.lit("SOCIO")) | F.coalesce(F.col("is_socio"), F.lit(False))
    offp = F.contains(d, F.lit("HORA LIGHT")) | R.is_off_peak("booking_date", "hour")
    b = b.withColumn("__member", member).withColumn("__off", ~member & offp)
    flags = b.groupBy("student").agg(F.bool_or("__member").alias("has_member"),
                                     F.bool_or("__off").alias("has_off_peak"))
    paying = b.where(~F.col("is_free"))
    nsl = paying.select("student", "dow", "start_time").distinct().groupBy("student") \
                .agg(F.count(F.lit(1)).alias("n_slots"))
    main = paying.groupBy("student").agg(F.min_by(F.col("price.category"),
                                                  F.struct("booking_date", "start_time", ts_order)).alias("main_category"))
    new = nsl.join(main, "student").join(flags, "student")
    rate = R.discount_rate(F.col("has_member"), F.col("has_off_peak"))
    new = new.withColumn("package_price", package_price("main_category", "n_slots") * (F.lit(1.0) - rate))
    students = b.select("student").distinct()
    out = students.join(history.select("student", "latest_sum"), "student", "left") \
                  .join(new.select("student", "n_slots", "main_category", "package_price"), "student", "left")
    hist = F.col("latest_sum").isNotNull()
    return out.select("student",
                      hist.alias("is_historical"),
                      F.when(hist, F.when(F.col("latest_sum") > 0, F.col("latest_sum").cast("double")))
                       .otherwise(F.col("package_price")).alias("monthly_price"),
                      F.when(~hist, F.col("n_slots")).alias("n_slots"),
                      F.when(~hist, F.col("main_category")).alias("main_category"))
