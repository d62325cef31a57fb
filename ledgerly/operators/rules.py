"""Rule-based classification (CL-1 .. CL-20).

One engine: an ordered rule list ``[(label, condition), ...]`` where a
condition is a small data structure (so rule sets are rows, not code):

* ``("contains", col, word)``   case-insensitive literal substring
* ``("equals", col, value)``    case-insensitive equality
* ``("starts", col, prefix)``   case-insensitive prefix
* ``("regex", col, pattern)``   Java regex (case-sensitive unless ``(?i)``)
* ``("in", col, [values])``     exact membership
* ``("any", [cond, ...])`` / ``("all", [cond, ...])`` / ``("not", cond)``

The list folds into one ``CASE WHEN`` (first match wins) evaluated inside
whole-stage codegen: no join, no shuffle. Rule lists are bounded by
``MAX_RULE_ROWS``; data-sized label tables go through
:func:`classify_by_table` (keyed containment join).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerly.functions import dates as D
from ledgerly.functions import text as T
from ledgerly.operators.common import MAX_RULE_ROWS, checked_broadcast, when_chain
from ledgerly.session import stage


def _low(col: str) -> Column:
    return F.lower(F.coalesce(F.col(col).cast("string"), F.lit("")))


def cond(spec) -> Column:
    kind = spec[0]
    if kind == "contains":
        return F.contains(_low(spec[1]), F.lit(spec[2].lower()))
    if kind == "equals":
        return _low(spec[1]) == F.lit(spec[2].lower())
    if kind == "starts":
        return F.startswith(_low(spec[1]), F.lit(spec[2].lower()))
    if kind == "regex":
        return F.coalesce(F.col(spec[1]).rlike(spec[2]), F.lit(False))
    if kind == "in":
        return F.coalesce(F.col(spec[1]).isin(list(spec[2])), F.lit(False))
    if kind == "isnull":
        return F.col(spec[1]).isNull()
    if kind == "col":
        return F.coalesce(F.col(spec[1]).cast("boolean"), F.lit(False))
    if kind in ("any", "all"):
        parts = [cond(s) for s in spec[1]]
        out = parts[0]
        for p in parts[1:]:
            out = (out | p) if kind == "any" else (out & p)
        return out
    if kind == "not":
        return ~cond(spec[1])
    raise ValueError(f"unknown condition {kind}")


def classify(rules: Sequence[tuple], default=None) -> Column:
    """Fold ``[(label, condition), ...]`` into one first-match CASE WHEN."""
    if len(rules) > MAX_RULE_ROWS:
        raise ValueError("rule list too long for a CASE chain; use classify_by_table")
    return when_chain([(cond(c), lbl) for lbl, c in rules], default)


def classify_by_table(df: DataFrame, text_col: str, rules: DataFrame, key_cols: Sequence[str],
                      out: str, default: str | None = None) -> DataFrame:
    """Data-driven rule table ``(priority, pattern, label)``: the label of the
    lowest-priority pattern contained in ``text_col``, case folded.

    One plan at every size: the distinct texts meet the distinct patterns in
    the keyed containment join, texts and patterns are compared as they are,
    and the winner per text joins back to its rows. Null and empty patterns
    match nothing; rows keep their repeats. ``key_cols`` name the row, as
    before; the result does not depend on them."""
    from ledgerly.operators.joins import contains_join
    pats = rules.select(F.lower("pattern").alias("__pat"), F.col("priority").alias("p"), F.col("label").alias("l")) \
        .where(F.length("__pat") > 0).groupBy("__pat").agg(F.min(F.struct("p", "l")).alias("__win"))
    rows = df.withColumn("__t", F.lower(F.col(text_col)))
    texts = rows.select("__t").where(F.col("__t").isNotNull()).distinct()
    pairs = contains_join(texts, "__t", "__t", pats, "__pat", "__pat").where(F.contains(F.col("__t"), F.col("__pat")))
    hit = pairs.join(pats, "__pat").groupBy("__t").agg(F.min("__win")["l"].alias(out))
    res = rows.join(hit, "__t", "left").drop("__t")
    if default is not None:
        res = res.withColumn(out, F.coalesce(F.col(out), F.lit(default)))
    return res


#: One condition of a rule a row. Conditions of one (ruleset, priority) must all hold; the date range is that of the rule.
RULES_SCHEMA = ("ruleset string, priority int, column string, predicate string, pattern string, date_from date, date_to date, label string")


def label_by_rules(df: DataFrame, rules: DataFrame, columns: Sequence[str], date_col: str | None, rulesets: Sequence[str]) -> DataFrame:
    """CL-1 from a table of rules: one column per ruleset with the label of its first rule that holds, else null.

    ``rules`` (``RULES_SCHEMA``) may be any size. ``predicate`` is equals,
    contains or starts, case folded, on one of ``columns``, or always (with no
    column). A rule with a date range holds only on dates within it, ends
    included, an open end being null; a null value or pattern meets nothing.
    Of rules with one priority the smallest label counts.

    Plan: the distinct values of the columns meet the patterns by equality or in
    the keyed containment join, and values that meet the same conditions share
    one profile. A row is then known by the profiles of its values and the first
    day of its period (no rule begins or ends within one), so rules are met by
    the few distinct sets of these: the conditions that hold are counted per
    rule, the winner is ``min_by(label, priority)``, and labels come back to the
    rows. Rows are shuffled only to meet the profiles of a column with many
    values; no rule is evaluated per row.
    """
    from ledgerly.operators.joins import contains_join
    df = stage(df)  # read for its values, its days and its rows
    value = {c: F.lower(F.col(c).cast("string")) for c in columns}
    texts = df.select(F.explode(F.array_distinct(F.array(*value.values()))).alias("__v")).where(F.col("__v").isNotNull()).distinct()
    always = F.col("predicate") == "always"
    conds = stage(rules.where(F.col("ruleset").isin(list(rulesets))).select(
        "ruleset", "priority", "predicate", "date_from", "date_to", "label", F.when(always, "*").otherwise(F.col("column")).alias("__c"),
        F.when(always, "").otherwise(F.lower("pattern")).alias("__p"), F.monotonically_increasing_id().alias("__id")))

    # the profile of a value: the conditions that it meets; that of no value, those that always hold
    pats = conds.where(F.col("predicate").isin("contains", "starts") & (F.length("__p") > 0)).select("__p").distinct()
    found = contains_join(texts, "__v", "__v", pats, "__p", "__p").where(F.contains("__v", "__p"))
    part = found.join(checked_broadcast(conds.where(F.col("predicate").isin("contains", "starts"))), "__p") \
        .where((F.col("predicate") == "contains") | F.startswith("__v", "__p")).select("__c", "__v", "__id")
    equal = conds.where(F.col("predicate").isin("equals", "always")).select("__c", F.col("__p").alias("__v"), "__id")
    met = stage(part.unionByName(equal).groupBy("__c", "__v").agg(F.array_sort(F.collect_set("__id")).alias("__ids")))
    profiles = stage(met.select("__ids").distinct().withColumn("__profile", F.monotonically_increasing_id()))
    met = stage(met.join(checked_broadcast(profiles), "__ids").select("__c", "__v", "__profile"))

    # a day's period begins at the last day on which a rule began or had just ended
    bounds = conds.select(F.explode(F.array("date_from", F.date_add("date_to", 1))).alias("b")).agg(F.collect_set("b").alias("__bounds"))
    day = F.to_date(date_col) if date_col else F.lit(None).cast("date")
    period = F.coalesce(F.array_max(F.filter("__bounds", lambda b: b <= F.col("__day"))), F.date_sub(F.array_min("__bounds"), 1), F.lit("1970-01-01").cast("date"))
    periods = df.select(day.alias("__day")).where(F.col("__day").isNotNull()).distinct().crossJoin(F.broadcast(bounds)).select("__day", period.alias("__period"))
    keyed = df.withColumn("__day", day).join(checked_broadcast(periods), "__day", "left")
    for i, c in enumerate(columns):
        own = met.where(F.col("__c") == c).select(F.col("__v").alias(f"__v{i}"), F.col("__profile").alias(f"__p{i}"))
        keyed = keyed.withColumn(f"__v{i}", value[c]).join(checked_broadcast(own), f"__v{i}", "left").drop(f"__v{i}")
    held_by = [f"__p{i}" for i in range(len(columns))]
    keyed = stage(keyed.select(*df.columns, F.struct(F.array(*held_by).alias("p"), F.col("__period").alias("d")).alias("__k")))

    sets = keyed.select("__k").distinct()
    open_ = met.where(F.col("__c") == "*").agg(F.min("__profile").alias("__always"))
    met_by = profiles.select("__profile", F.explode("__ids").alias("__id")).join(checked_broadcast(conds), "__id")
    held = sets.crossJoin(F.broadcast(open_)).select("__k", F.explode(F.array_append("__k.p", F.col("__always"))).alias("__profile")) \
        .join(checked_broadcast(met_by), "__profile") \
        .where((F.col("date_from").isNull() | (F.col("__k.d") >= F.col("date_from"))) & (F.col("date_to").isNull() | (F.col("__k.d") <= F.col("date_to"))))
    one = F.struct("__c", "predicate", "__p")
    need = conds.groupBy("ruleset", "priority").agg(F.countDistinct(one).alias("__need"))
    whole = held.groupBy("__k", "ruleset", "priority").agg(F.countDistinct(one).alias("__held"), F.min("label").alias("label")) \
        .join(need, ["ruleset", "priority"]).where("__held = __need")
    best = whole.groupBy("__k").agg(*[F.min_by(F.when(F.col("ruleset") == r, F.col("label")), F.when(F.col("ruleset") == r, F.col("priority"))).alias(r)
                                      for r in rulesets])
    return keyed.join(checked_broadcast(stage(best)), "__k", "left").drop("__k")


# ---------------------------------------------------------------- CL-1
def resolve_label(rules: Sequence[tuple], fallback_col: str | None = None,
                  fallback_re: str | None = None, default: str | None = None) -> Column:
    """CL-1: first matching rule, else the regex group of the fallback text
    (N13: spaces collapsed, empty -> null), else ``default``."""
    out = classify(rules)
    parts = [out]
    if fallback_col and fallback_re:
        parts.append(T.group_or_null(fallback_col, fallback_re, 1))
    if default is not None:
        parts.append(F.lit(default))
    return F.coalesce(*parts) if len(parts) > 1 else out


# The teacher fallback pattern and the "no teacher" sentinel.
TEACHER_FALLBACK_RE = r"(?i)prof[:.]?\s*([^.(]+)"
NO_TEACHER = "Sem professor"


# ---------------------------------------------------------------- CL-2
# Class size from an "(n / m)" capacity text.
CAPACITY_CLASSES = [(1, "INDIVIDUAL"), (2, "DUPLA"), (3, "TRIO")]


def capacity_class(desc: str, booking_type: str, single_type: str = "clase_suelta") -> Column:
    """CL-2: INDIVIDUAL/DUPLA/TRIO/GRUPO from ``(n / m)``; default by type."""
    d = F.coalesce(F.col(desc), F.lit(""))
    cases = [(d.rlike(r"\(\s*\d+\s*/\s*%d\s*\)" % m), lbl) for m, lbl in CAPACITY_CLASSES]
    cases.append((d.rlike(r"\(\s*\d+\s*/\s*[456789]\d*\s*\)"), "GRUPO"))
    cases.append((F.col(booking_type) == single_type, "INDIVIDUAL"))
    return when_chain(cases, "GRUPO")


def capacity_number(desc: str, booking_type: str, single_type: str = "clase_suelta",
                    default: int = 4) -> Column:
    """The ``m`` of ``(n / m)``; 1 for single lessons, else ``default``."""
    m = F.regexp_extract(F.coalesce(F.col(desc), F.lit("")), r"\(\s*\d+\s*/\s*(\d+)\s*\)", 1)
    return F.when(m != "", m.cast("int")) \
            .when(F.col(booking_type) == single_type, F.lit(1)).otherwise(F.lit(default))


# ---------------------------------------------------------------- CL-4
# Monthly package prices (adult and kids) and the single-lesson price.
PRICING = [("ADULTO", "GRUPO", 335.0), ("ADULTO", "TRIO", 395.0), ("ADULTO", "DUPLA", 430.0),
           ("ADULTO", "INDIVIDUAL", 720.0), ("KIDS", "BABY", 255.0), ("KIDS", "NORMAL", 255.0),
           ("KIDS", "INDIVIDUAL", 450.0)]
SINGLE_LESSON_PRICE = 120.0


def price_for(desc: str, booking_type: str, single_type: str = "clase_suelta") -> Column:
    """CL-4: ``struct(price, is_monthly, category)`` of a booking."""
    d = F.upper(F.coalesce(F.col(desc), F.lit("")))
    cap = capacity_number(desc, booking_type, single_type)
    kids = F.contains(d, F.lit("KIDS")) | F.contains(d, F.lit("BABY"))
    p = {(a, b): v for a, b, v in PRICING}

    def s(price, monthly, cat):
        return F.struct(F.lit(price).alias("price"), F.lit(monthly).alias("is_monthly"),
                        F.lit(cat).alias("category"))
    return when_chain([
        (kids & ((cap == 1) | F.contains(d, F.lit("INDIVIDUAL"))), s(p[("KIDS", "INDIVIDUAL")], True, "Kids Individual")),
        (kids & F.contains(d, F.lit("BABY")), s(p[("KIDS", "BABY")], True, "Baby Tennis")),
        (kids, s(p[("KIDS", "NORMAL")], True, "Kids Normal")),
        (F.col(booking_type) == single_type, s(SINGLE_LESSON_PRICE, False, "Adulto Avulso")),
        (cap == 1, s(p[("ADULTO", "INDIVIDUAL")], True, "Adulto Individual")),
        (cap == 2, s(p[("ADULTO", "DUPLA")], True, "Adulto Dupla")),
        (cap == 3, s(p[("ADULTO", "TRIO")], True, "Adulto Trio")),
    ], s(p[("ADULTO", "GRUPO")], True, "Adulto Grupo"))


# ---------------------------------------------------------------- CL-5..7
# Keyword rule sets of the three revenue classifications, over the
# sale-line columns description / category / subcategory.
LESSON_WORDS = ["aula", "tênis", "tenis", "kids", "baby"]
REVENUE_CASH = [
    ("lesson", ("any", [("regex", "description", "(?i)INTENSIV"),
                        *[("contains", "description", w) for w in LESSON_WORDS],
                        ("equals", "category", "aulas")])),
    ("rental", ("all", [("not", ("any", [("contains", "description", w) for w in LESSON_WORDS])),
                        ("any", [("equals", "category", "locação"), ("contains", "description", "locação"),
                                 ("contains", "description", "reserva")])])),
]
# The operations and goals sets also read the column product.
MONTHLY_RENTAL = ("any", [("contains", "subcategory", "reserva mensal"), ("contains", "product", "reserva mensal")])
SINGLE_RENTAL = ("any", [("equals", "category", "locação"), ("contains", "description", "vouchers desconto 1º reserva"),
                         ("contains", "description", "voucher desconto 1º reserva")])
LESSON = ("any", [("equals", "category", "aulas"), ("contains", "description", "tênis"), ("contains", "description", "aula"),
                  ("contains", "description", "kids"), ("contains", "description", "baby")])
REVENUE_OPS = [
    ("Locação - Reserva Mensal", MONTHLY_RENTAL),
    ("Locação - Quadra Avulsa", SINGLE_RENTAL),
    ("Aulas - Avulsas", ("all", [LESSON, ("any", [("contains", "description", "avulsa"),
                                                  ("contains", "subcategory", "avulsa")])])),
    ("Aulas - Regular", LESSON),
]
REVENUE_OPS_DEFAULT = "Lanchonete"
REVENUE_GOALS = [("Aulas", LESSON), ("Locação", ("any", [MONTHLY_RENTAL, SINGLE_RENTAL]))]
REVENUE_GOALS_DEFAULT = "Lanchonete"


def revenue_class(ruleset: Sequence[tuple], default: str) -> Column:
    """CL-5/6/7: first matching class of a keyword rule set."""
    return classify(ruleset, default)


# ---------------------------------------------------------------- CL-8
def pay_class(type_col: str, method_col: str) -> Column:
    """CL-8: online payment class by type and method."""
    t, m = F.col(type_col), F.col(method_col)
    return when_chain([((t == "bank_transfer") | (m == "pix"), "pix"),
                       (t == "credit_card", "credit"),
                       (t == "account_money", "balance")], "other")


# Names of the payment methods taken at the club, and of the online one.
LOCAL_PAY_RULES = [
    ("credit", ("any", [("contains", "pay_method", "credito"), ("contains", "pay_method", "crédito")])),
    ("card", ("equals", "pay_method", "tarjeta")),
    ("debit", ("any", [("contains", "pay_method", "debito"), ("contains", "pay_method", "débito")])),
    ("cash", ("equals", "pay_method", "efectivo")),
    ("transfer", ("any", [("equals", "pay_method", "transferencia"), ("equals", "pay_method", "pix")])),
    ("online", ("equals", "pay_method", "pagamento online")),
]
ONLINE_METHOD = "Pagamento online"
ONLINE_LABELS = [("pix", "Mercado Pago - Pix"), ("credit", "Mercado Pago - Cartão Crédito"),
                 ("balance", "Mercado Pago - Saldo MP"), ("other", "Mercado Pago - Outro")]


def local_pay_class(rules: Sequence[tuple] = LOCAL_PAY_RULES) -> Column:
    """CL-8: class of a payment method's name (column ``pay_method``); null for names outside the rules."""
    return classify(rules)


# ---------------------------------------------------------------- CL-9
# Cost-centre descriptions of the three cash-flow activities.
FLOW_CLASSES = [("Operação", "fco"), ("Investimentos", "fci"), ("Sócios", "fcs")]


def flow_class(col: str, mapping: Sequence[tuple] = FLOW_CLASSES) -> Column:
    """CL-9: cash-flow activity from a cost-centre text (null when unmapped)."""
    return when_chain([(F.col(col) == k, v) for k, v in mapping])


# ---------------------------------------------------------------- CL-10
# Keywords of the hours classes.
HOURS_RULES = [
    ("maintenance", ("any", [("contains", "kind", "manutenção"), ("contains", "kind", "bloqueio"),
                             ("contains", "kind", "manutencao")])),
    ("fixed", ("any", [("starts", "kind", "aulas - regular"), ("contains", "kind", "reserva mensal"),
                       ("starts", "kind", "aulas - adulto"), ("starts", "kind", "aulas - kids"),
                       ("equals", "kind", "outros")])),
    ("rental", ("contains", "kind", "locação - quadra avulsa")),
    ("single", ("contains", "kind", "aulas - avulsa particular")),
]


def hours_class(rules: Sequence[tuple] = HOURS_RULES) -> Column:
    """CL-10: hours class of an occupancy row (column ``kind``)."""
    return classify(rules)


# ---------------------------------------------------------------- CL-11
def band(col, cuts=(3.0, 10.0), labels=("MUITO ACIMA", "MUITO ABAIXO", "ABAIXO", "ACIMA", "NO ALVO")) -> Column:
    """CL-11: deviation band, tested in the reference's order:
    >= +hi, <= -hi, <= -lo, >= +lo, else on target."""
    c = F.col(col) if isinstance(col, str) else col
    lo, hi = cuts
    return when_chain([(c >= hi, labels[0]), (c <= -hi, labels[1]), (c <= -lo, labels[2]),
                       (c >= lo, labels[3])], labels[4])


# ---------------------------------------------------------------- CL-12..15
# Words that make a class free of charge.
FREE_WORDS = ["REPOSIÇÃO", "REPOSICAO", "EXPERIMENTAL", "CORTESIA", "TESTE"]


def is_free(desc: str, booking_type: str, single_type: str = "clase_suelta",
            words: Sequence[str] = FREE_WORDS) -> Column:
    """CL-12: free class (single-lesson type or any free word)."""
    d = F.upper(F.coalesce(F.col(desc), F.lit("")))
    out = F.col(booking_type) == single_type
    for w in words:
        out = out | F.contains(d, F.lit(w.upper()))
    return F.coalesce(out, F.lit(False))


def is_off_peak(date_col, hour_col, first: int = 10, last: int = 15) -> Column:
    """CL-13: weekday (Mon..Fri) and start hour in [first, last]."""
    dow = D.js_dow(date_col)
    h = F.col(hour_col) if isinstance(hour_col, str) else hour_col
    return (dow >= 1) & (dow <= 5) & (h >= first) & (h <= last)


# Member and off-peak discount rates, and their keywords.
MEMBER_DISCOUNT, OFF_PEAK_DISCOUNT = 0.50, 0.12
MEMBER_WORDS, OFF_PEAK_WORDS = ["SÓCIO", "SOCIO"], ["HORA LIGHT"]


def discount_rate(has_member: Column, has_off_peak: Column) -> Column:
    """CL-14: the strongest discount of a customer (aggregate the flags with ``bool_or`` first)."""
    return F.when(has_member, F.lit(MEMBER_DISCOUNT)).when(has_off_peak, F.lit(OFF_PEAK_DISCOUNT)) \
            .otherwise(F.lit(0.0))


def freq_discount(n) -> Column:
    """CL-15: 2 weekly slots -> 5%, 3 or more -> 7%."""
    c = F.col(n) if isinstance(n, str) else n
    return F.when(c == 2, F.lit(0.05)).when(c >= 3, F.lit(0.07)).otherwise(F.lit(0.0))


# ---------------------------------------------------------------- CL-16..20
def dated_multiplier(rules: Sequence[tuple], name_col: str, date_col: str) -> Column:
    """CL-16: multiplier of the first rule ``(part1, part2, start_date, multiplier)``
    whose two name parts are both in the row's name (case folded) and whose
    start date is reached; 1 otherwise."""
    low = F.lower(F.coalesce(F.col(name_col), F.lit("")))
    cases = [(F.contains(low, F.lit(a.lower())) & F.contains(low, F.lit(b.lower())) &
              (F.col(date_col) >= F.lit(start).cast("date")), float(m)) for a, b, start, m in rules]
    return when_chain(cases, 1.0)


def period_of(d, cut: int = 20) -> Column:
    """CL-17: half-month period."""
    return D.period_of(d, cut)


def line_flags(desc: str, sub: str) -> tuple[Column, Column]:
    """CL-18: (is_single, is_single_fixed_group) flags of a sale line, never null."""
    d = F.col(desc)
    single = F.coalesce(T.ilike_any(d, ["AULA AVULSA"]) |
                        F.col(sub).isin("Avulsa - Grupo Fixo", "Avulsa - Particular"), F.lit(False))
    fixed = F.coalesce(T.ilike_any(d, ["AULA AVULSA - GRUPO FIXO"]) |
                       (F.col(sub) == "Avulsa - Grupo Fixo"), F.lit(False))
    return single, fixed


# Card fee rates per payment method.
FEE_RATES = [("tarjeta", 0.0193), ("Cartão Crédito", 0.0193), ("Cartão Débito", 0.0099)]


def fee_rate(method: str, rates: Sequence[tuple] = FEE_RATES) -> Column:
    """CL-19: card fee rate of a payment method (0 when not a card)."""
    return when_chain([(F.col(method) == m, float(r)) for m, r in rates], 0.0)


def rate_for(df: DataFrame, rates: DataFrame, person: str, default: float) -> DataFrame:
    """CL-20: commission rate per person (left join), default rate otherwise."""
    r = checked_broadcast(rates.select(F.col(rates.columns[0]).alias("__p"), F.col(rates.columns[1]).alias("rate")))
    return df.join(r, F.col(person) == F.col("__p"), "left") \
             .withColumn("rate", F.coalesce(F.col("rate"), F.lit(default))).drop("__p")
