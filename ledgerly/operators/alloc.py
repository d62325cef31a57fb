"""Allocation and inference operators (AL-1 .. AL-8, ST-5).

The central one is :func:`allocate`, the three-tier weighted allocation of
payments (items) over recurring slots of the same key (customer and month).

Scale notes
-----------
* Items are pre-aggregated to one row per (key, item type, carried columns)
  before they meet the slots. The allocation only depends on an item's key
  and type, so this is exact, and the pair join becomes
  ``slots x types`` per key instead of ``slots x items``: a customer holding a
  third of all items produces a handful of rows, not a third of the table.
* Partial aggregation happens map-side, so the hot key never crosses the
  shuffle as raw rows.
* Window sums run on the already aggregated slot rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerly.functions import text as T
from ledgerly.functions.num import MONEY
from ledgerly.operators.common import checked_broadcast


def with_weight(slots: DataFrame, type_col: str, weights: DataFrame,
                count_col: str | None = None, count_weighted: Column | None = None,
                weight_col: str = "slot_weight", default_weight: int | None = None) -> DataFrame:
    """AL-1: weight per slot from its class type (broadcast weight table
    ``(type, weight)``); where ``count_weighted`` holds, the weight is
    multiplied by the slot's booking count."""
    w = weights.withColumnRenamed(weights.columns[0], "__wtype") \
               .withColumnRenamed(weights.columns[1], "__wval")
    out = slots.join(checked_broadcast(w), F.col(type_col) == F.col("__wtype"), "left")
    base = F.col("__wval")
    if default_weight is not None:
        base = F.coalesce(base, F.lit(default_weight))
    mult = F.lit(1)
    if count_col is not None and count_weighted is not None:
        mult = F.when(count_weighted, F.col(count_col)).otherwise(F.lit(1))
    return out.withColumn(weight_col, (base * mult).cast("bigint")).drop("__wtype", "__wval")


def allocate(slots: DataFrame, items: DataFrame, keys: Sequence[str], slot_cols: Sequence[str],
             slot_type: str, item_type: str, weight: str, measures: Sequence[str],
             carry: Sequence[str] = (), date_col: str | None = None,
             flags: Sequence[str] = ()) -> DataFrame:
    """AL-2: three-tier weighted allocation.

    For each item and each slot of the same ``keys``:

    a. if any slot of the item's type exists, the item is shared among the
       slots of that type only, by weight;
    b. else, if slots exist that no item of their own type covers, it is
       shared among those;
    c. else it is shared among all slots of the key.

    Returns one row per slot and ``carry`` value with the allocated sums of
    ``measures`` (DOUBLE, unrounded), the latest ``date_col`` among items that
    gave the slot a positive share, and ``bool_or`` of ``flags`` over all
    items of the key. Items whose key has no slot are not in the output
    (see :func:`ledgerly.operators.joins.unused`).
    """
    keys, slot_cols, carry = list(keys), list(slot_cols), list(carry)
    # 1. one row per key, item type and carried columns (map-side partial agg).
    aggs = [F.sum(m).alias(m) for m in measures]
    if date_col:
        aggs.append(F.max(date_col).alias(date_col))
    aggs += [F.bool_or(f).alias(f) for f in flags]
    grp = items.groupBy(*keys, F.col(item_type).alias("__type"), *carry).agg(*aggs)

    # 2. slots and item groups in one frame, hash-partitioned once by the key.
    #    Every later step (windows by key and by key+type, the pair join, the
    #    final aggregate) is clustered by a superset of the key, so it reuses
    #    this partitioning instead of shuffling again.
    # null keys never meet
    for k in keys:
        slots, grp = slots.where(F.col(k).isNotNull()), grp.where(F.col(k).isNotNull())
    s_cols = [F.col(c) for c in slot_cols]
    u = slots.select(*keys, F.col(slot_type).alias("__type"), F.lit(0).alias("__kind"),
                     F.col(weight).cast("bigint").alias("__w"),
                     F.struct(*s_cols).alias("__slot"), F.lit(None).alias("__item"))
    item_struct = F.struct(*[F.col(c) for c in carry + list(measures)
                             + ([date_col] if date_col else []) + list(flags)])
    g = grp.select(*keys, "__type", F.lit(1).alias("__kind"), F.lit(None).cast("bigint").alias("__w"),
                   F.lit(None).cast(u.schema["__slot"].dataType).alias("__slot"), item_struct.alias("__item"))
    u = u.withColumn("__item", F.lit(None).cast(g.schema["__item"].dataType))
    u = u.unionByName(g).repartition(*keys)
    by_key = Window.partitionBy(*keys)
    by_type = Window.partitionBy(*keys, "__type")
    is_slot = F.col("__kind") == 0
    # one sort by key and type; a pass over the types, then one over the keys
    u = u.withColumns({"__has_slot": F.max(is_slot).over(by_type),            # WN-2 / JN-6
                       "__has_item": F.max(~is_slot).over(by_type),
                       "__w_type": F.sum("__w").over(by_type)})               # WN-1

    # 3. pairs of one key (JN-7). A key's item groups are at most
    #    (item types x carried values), so each slot row takes them as a
    #    small array from a whole-key window and explodes it: no self-join,
    #    and the union above is computed once.
    info = F.when(~is_slot, F.struct(F.col("__type").alias("t"), F.col("__has_slot").alias("hm"),
                                     F.col("__item").alias("i")))
    open_weight = F.when(is_slot & ~F.col("__has_item"), F.col("__w")).otherwise(F.lit(0))
    u = u.withColumns({"__w_total": F.sum("__w").over(by_key), "__w_unc": F.sum(open_weight).over(by_key),
                       "__items": F.collect_list(info).over(by_key)})
    p = (u.where(is_slot)
          .select(*keys, F.col("__type").alias("__stype"), "__w", "__slot", "__w_total", "__w_type",
                  "__w_unc", F.col("__has_item").alias("__covered"), F.explode("__items").alias("__x"))
          .select("*", F.col("__x.t").alias("__itype"), F.col("__x.hm").alias("__has_match"),
                  F.col("__x.i").alias("__item"))
          .drop("__x"))
    den = (F.when(F.col("__has_match"),
                  F.when(F.col("__itype") == F.col("__stype"), F.col("__w_type")))
            .when(F.col("__w_unc") > 0, F.when(~F.col("__covered"), F.col("__w_unc")))
            .otherwise(F.col("__w_total")))
    p = p.withColumn("__den", den)
    out_aggs = []
    for m in measures:
        alloc = F.when(F.col("__den").isNotNull(),
                       F.col(f"__item.{m}").cast("double") * F.col("__w") / F.col("__den")).otherwise(F.lit(0.0))
        out_aggs.append(F.sum(alloc).alias(m))
    if date_col:
        out_aggs.append(F.max(F.when(F.col("__den").isNotNull() & (F.col(f"__item.{measures[0]}") > 0),
                                     F.col(f"__item.{date_col}"))).alias(date_col))
    out_aggs += [F.bool_or(F.col(f"__item.{f}")).alias(f) for f in flags]
    grouped = [F.col(f"__slot.{c}").alias(c) for c in slot_cols] + [F.col(f"__item.{c}").alias(c) for c in carry]
    return p.groupBy(*keys, *grouped).agg(*out_aggs)


def spread(df: DataFrame, value: str, count: str, out: str) -> DataFrame:
    """AL-3: a slot's value spread evenly over its bookings (zero when no count)."""
    return df.withColumn(out, F.coalesce(F.try_divide(F.col(value).cast("double"),
                                                      F.nullif(F.col(count), F.lit(0))),
                                         F.lit(0.0)))


def equal_split(bookings: DataFrame, payments: DataFrame, keys: Sequence[str],
                booking_id: str, value: str) -> DataFrame:
    """AL-6: the month total of a key divided over its distinct bookings.

    ``payments`` is summed per key, bookings are counted distinct per key,
    and each booking gets ``total / n``.
    """
    keys = list(keys)
    totals = payments.groupBy(*keys).agg(F.sum(value).alias("__total"))
    counts = bookings.groupBy(*keys).agg(F.countDistinct(booking_id).alias("__n"))
    per = counts.join(totals, keys, "left") \
                .withColumn("value_per_booking",
                            F.coalesce(F.try_divide(F.col("__total").cast("double"),
                                                    F.col("__n").cast("double")), F.lit(0.0)))
    return bookings.select(*keys, booking_id).distinct() \
                   .join(per.select(*keys, "__n", "value_per_booking"), keys, "left") \
                   .withColumnRenamed("__n", "bookings_in_key")


def full_month_value(value, start, end) -> Column:
    """AL-7: value x days in the span's month / days covered, at least one day,
    rounded half away from zero to cents; rows without both span dates keep
    the value. ``start``/``end`` come from :func:`ledgerly.functions.text.with_span`.

    Computed on integer cents so the rounding is exact.
    """
    v = F.col(value) if isinstance(value, str) else value
    s, e = F.col(start), F.col(end)
    dim = F.dayofmonth(F.last_day(s)).cast("bigint")
    span = F.greatest(F.datediff(e, s) + 1, F.lit(1)).cast("bigint")
    cents = (v.cast(MONEY) * 100).cast("bigint")
    num = F.abs(cents) * dim * 2 + span
    q = F.floor(num / (span * 2)).cast("bigint")  # exact: operands are bigints < 2^53
    rounded = (F.signum(cents).cast("bigint") * q).cast("decimal(20,0)") / 100
    return F.when(s.isNotNull() & e.isNotNull(), rounded.cast(MONEY)).otherwise(v.cast(MONEY))


def to_full_month(df: DataFrame, value: str, text: str, out: str = "full_value") -> DataFrame:
    """AL-7 on a DataFrame: parse the span of ``text`` and add ``out``."""
    return T.with_span(df, text, "__fs", "__fe") \
            .withColumn(out, full_month_value(value, "__fs", "__fe")).drop("__fs", "__fe")


# Month names written in sale lines (with the plain spelling of março).
MONTH_WORDS = [("janeiro", 1), ("fevereiro", 2), ("março", 3), ("marco", 3), ("abril", 4),
               ("maio", 5), ("junho", 6), ("julho", 7), ("agosto", 8), ("setembro", 9),
               ("outubro", 10), ("novembro", 11), ("dezembro", 12)]


MONTH_WORD_RE = "(" + "|".join(w for w, _ in MONTH_WORDS) + r") (\d{2})"


def named_month(text) -> Column:
    """The first ``<month name> <yy>`` in the text -> first day of that month, else null.

    One regex with an alternation plus a literal map lookup, so the
    expression stays small enough for whole-stage codegen.
    """
    t = F.lower(F.col(text) if isinstance(text, str) else text)
    name = F.regexp_extract(t, MONTH_WORD_RE, 1)
    yy = F.regexp_extract(t, MONTH_WORD_RE, 2)
    m = F.element_at(F.create_map(*[x for w, n in MONTH_WORDS for x in (F.lit(w), F.lit(n))]), name)
    return F.when(name != "", F.make_date(F.concat(F.lit("20"), yy).cast("int"), m, F.lit(1)))


def item_period(df: DataFrame, text: str, pay_date: str, sale_date: str) -> DataFrame:
    """AL-8: the period an item pays for: the span in its text, else a
    ``<month> <yy>`` name, else the month of payment (or sale)."""
    fallback = F.trunc(F.to_date(F.coalesce(F.col(pay_date), F.col(sale_date).cast("timestamp_ntz"))), "MM")
    out = (T.with_span(df, text, "__ss", "__se")
             .withColumn("__nm", named_month(text)).withColumn("__fb", fallback))
    out = out.withColumn("item_start", F.coalesce("__ss", "__nm", "__fb")) \
             .withColumn("item_end", F.coalesce(F.col("__se"), F.last_day("__nm"), F.last_day("__fb")))
    return out.withColumn("plan_month", F.trunc("item_start", "MM")).drop("__ss", "__se", "__nm", "__fb")


def infer_plan(value, prices: Sequence[tuple], low: float = 50.0,
               band=(0.15, 1.05), double_band=(0.85, 1.15), halve_over: float = 1.3,
               step: float = 20.0) -> Column:
    """AL-5: infer the plan type from a full-month value and a price list.

    Price rows ``(type, base)`` qualify when ``value/base`` is inside ``band``
    or ``value/(2*base)`` is inside ``double_band``; values below ``low`` get
    none. Preference: ratio within the upper band edge first, then the ratio
    (against double price when above ``halve_over``) nearest a multiple of
    ``1/step``, then the order of the list. Evaluated per row on a literal
    array: no join, no shuffle.
    """
    v = (F.col(value) if isinstance(value, str) else value).cast("double")
    arr = F.array(*[F.struct(F.lit(i).alias("ord"), F.lit(t).alias("type"),
                             F.lit(float(b)).alias("base")) for i, (t, b) in enumerate(prices)])

    def cand(p):
        r = v / p["base"]
        r2 = v / (F.lit(2.0) * p["base"])
        ok = ((r >= band[0]) & (r <= band[1])) | ((r2 >= double_band[0]) & (r2 <= double_band[1]))
        pref = F.when(r <= band[1], F.lit(1)).otherwise(F.lit(2))
        k = F.when(r > halve_over, F.lit(2.0)).otherwise(F.lit(1.0))
        x = v / (k * p["base"]) * step
        dist = F.abs(F.round(x) - x)
        return F.struct(pref.alias("pref"), dist.alias("dist"), p["ord"].alias("ord"),
                        p["type"].alias("type"), ok.alias("ok"))

    cands = F.filter(F.transform(arr, cand), lambda c: c["ok"])
    best = F.array_min(cands)
    return F.when(v >= low, best["type"])


def share_split(df: DataFrame, cond: Column, person_col: str, other_person: str,
                measures: Sequence[str], factor: float = 0.5) -> DataFrame:
    """ST-5: a row matching ``cond`` becomes two rows at ``factor`` of its
    measures, one for its own person and one for ``other_person``; one scan."""
    parts = F.when(cond, F.array(F.struct(F.col(person_col).alias("p"), F.lit(factor).alias("f")),
                                 F.struct(F.lit(other_person).alias("p"), F.lit(factor).alias("f")))) \
             .otherwise(F.array(F.struct(F.col(person_col).alias("p"), F.lit(1.0).alias("f"))))
    out = df.withColumn("__part", F.explode(parts))
    for m in measures:
        out = out.withColumn(m, F.col(m).cast("double") * F.col("__part.f"))
    return out.withColumn(person_col, F.col("__part.p")).drop("__part")
