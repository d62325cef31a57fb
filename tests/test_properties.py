"""Property tests: operators against brute force on random small
fixtures, and invariants of the registered reports on the smallest tables."""

import datetime as dt
import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as E
from ledgerly.operators import alloc as A
from ledgerly.operators import joins as J

SF = "/root/testdata/sf0.001"
Q = E.queries()
SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(st.integers(min_value=0, max_value=10_000))
def test_allocation_conserves_every_item_with_a_slot(spark, seed):
    rnd = random.Random(seed)
    types = ["A", "B", "C"]
    slots = [(k, f"s{k}_{i}", rnd.choice(types), rnd.randint(1, 5)) for k in range(4) for i in range(rnd.randint(0, 3))]
    items = [(rnd.randint(0, 4), rnd.choice(types), round(rnd.uniform(1, 100), 2)) for _ in range(rnd.randint(1, 12))]
    if not slots:
        return
    s = spark.createDataFrame(slots, "k int, slot string, stype string, w bigint")
    i = spark.createDataFrame(items, "k int, itype string, value double") \
             .withColumn("value", F.col("value").cast("decimal(18,2)"))
    got = sum(r.value for r in A.allocate(s, i, ["k"], ["slot"], "stype", "itype", "w", ["value"]).collect())
    keys = {k for k, *_ in slots}
    want = sum(v for k, _, v in items if k in keys)
    assert abs(got - want) < 1e-6


@SETTINGS
@given(st.integers(min_value=0, max_value=10_000))
def test_nearest_matches_brute_force(spark, seed):
    rnd = random.Random(seed)
    base = dt.date(2024, 1, 1)
    a = [(rnd.randint(0, 2), base + dt.timedelta(days=rnd.randint(0, 40))) for _ in range(10)]
    b = [(rnd.randint(0, 2), base + dt.timedelta(days=rnd.randint(0, 40)), i, f"l{i}") for i in range(rnd.randint(0, 8))]
    adf = spark.createDataFrame(a, "c int, d date")
    bdf = spark.createDataFrame(b, "c int, bd date, id int, lbl string") if b else \
        spark.createDataFrame([], "c int, bd date, id int, lbl string")
    got = sorted((r.c, r.d, r.lbl) for r in J.nearest(adf, bdf, ["c"], "d", "bd", ["lbl"], "id").collect())
    want = []
    for c, d in a:
        cands = sorted((abs((bd - d).days), bd, i, lbl) for cc, bd, i, lbl in b if cc == c)
        want.append((c, d, cands[0][3] if cands else None))
    assert got == sorted(want)


@SETTINGS
@given(st.lists(st.text(alphabet="ab c", min_size=0, max_size=12), min_size=1, max_size=6),
       st.lists(st.text(alphabet="ab c", min_size=1, max_size=6), min_size=1, max_size=5))
def test_contains_join_matches_brute_force(spark, texts, patterns):
    from ledgerly.functions.text import fold_spaces  # noqa: F401  (same folding as below)
    import re

    def fold(s):
        return re.sub(r"\s+", " ", s).strip().lower()
    a = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    b = spark.createDataFrame(list(enumerate(patterns)), "bid int, bt string")
    got = sorted((r.id, r.bid) for r in J.contains_join(a, "id", "t", b, "bid", "bt").collect())
    want = sorted((i, j) for i, t in enumerate(texts) for j, p in enumerate(patterns)
                  if fold(p) and fold(p) in fold(t))
    assert got == want


def test_running_balance_chains(spark):
    rows = Q["running_balance"](spark, SF).orderBy("nation", "month").collect()
    prev = {}
    for r in rows:
        assert abs(r.closing - (r.opening + r.net)) < 1e-6
        if r.nation in prev:
            assert abs(r.opening - prev[r.nation]) < 1e-6
        prev[r.nation] = r.closing


def test_reconciliation_residual_and_split_totals(spark):
    for r in Q["cash_reconciliation"](spark, SF).collect():
        assert abs(r.lesson + r.rental + r.other + r.residual - r.total) < 1e-6
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    total = li.agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)"))).first()[0]
    split = Q["share_split"](spark, SF).agg(F.sum("value")).first()[0]
    assert abs(float(total) - split) < 0.01 * li.count()  # each half is rounded to cents


def test_rescale_parts_sum_to_control_total(spark):
    got = {r.segment: r.s for r in Q["rescale"](spark, SF).groupBy("segment").agg(F.sum("rescaled").alias("s")).collect()}
    o = spark.read.parquet(f"{SF}/orders.parquet")
    c = spark.read.parquet(f"{SF}/customer.parquet")
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    tot = li.join(o, li.l_orderkey == o.o_orderkey).join(c, o.o_custkey == c.c_custkey) \
            .groupBy("c_mktsegment").agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("t")).collect()
    for r in tot:
        assert abs(got[r.c_mktsegment] - float(r.t)) < 0.05


def test_unallocated_are_the_complement(spark):
    """AL-4 / JN-9: unallocated payment rows of the detail are exactly the lines whose
    customer-month has no slot."""
    d = Q["commission_detail"](spark, SF)
    n_un = d.where(F.col("booking_type") == "unallocated_payment").count()
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    o = spark.read.parquet(f"{SF}/orders.parquet")
    x = li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.col("o_custkey").alias("c"), F.trunc(F.to_date("l_shipdate"), "MM").alias("m"))
    slots = o.select(F.col("o_custkey").alias("c"), F.trunc(F.to_date("o_orderdate"), "MM").alias("m")).distinct()
    assert n_un == x.join(slots, ["c", "m"], "left_anti").count()


def test_name_matching_does_not_depend_on_the_number_of_names(spark):
    """JN-14 and rule tables give the same pairs for a few names and for 20,000; inner double spaces count."""
    from ledgerly.operators import joins as JJ
    from ledgerly.operators import rules as RR
    a = spark.createDataFrame([(1, "Ana Lúcia Souza"), (2, "joão"), (3, "Professor Nation_1"), (4, ""), (5, None),
                               (6, "xx a b yy"), (7, "xx a  b yy"), (1, "Ana Lúcia Souza")], "id int, name string")
    few = [(10, "ANA LUCIA"), (11, "João Pedro Alves"), (12, "nation_1"), (13, "x"), (14, "A  B"), (15, None), (16, " ")]
    want = [(1, 10), (1, 10), (2, 11), (3, 12), (6, 13), (7, 13), (7, 14)]
    for more in (0, 20_000):
        b = spark.createDataFrame(few + [(100 + k, f"somebody else {k:05d}") for k in range(more)], "bid int, bname string")
        assert sorted((r.id, r.bid) for r in JJ.fuzzy_contains(a, "name", b, "bname").collect()) == want
        rules = spark.createDataFrame([(1, "lúcia", "L"), (2, "nation", "N"), (0, "ana", "A"), (0, "", "E"), (3, "a  b", "S")]
                                      + [(9, f"somebody else {k:05d}", "M") for k in range(more)], "priority int, pattern string, label string")
        got = sorted((r.id, r.lbl) for r in RR.classify_by_table(a, "name", rules, ["id"], "lbl", "none").collect())
        assert got == [(1, "A"), (1, "A"), (2, "none"), (3, "N"), (4, "none"), (5, "none"), (6, "none"), (7, "S")]


def test_short_names_with_a_common_first_name_are_no_hot_key(spark):
    """JN-5 short patterns: one first name in a third of the texts and in all names still gives exactly the containing pairs."""
    from ledgerly.operators import joins as JJ
    names = [(k, f"maria {chr(97 + k % 26)}{chr(97 + k // 26)}lves") for k in range(200)]
    texts = [(k, f"aula com maria {chr(97 + k % 26)}{chr(97 + k // 26)}lves no sábado" if k % 3 == 0 else f"aula {k}") for k in range(600)]
    a = spark.createDataFrame(texts, "id int, t string")
    b = spark.createDataFrame(names, "nid int, n string")
    got = sorted((r.id, r.nid) for r in JJ.contains_join(a, "id", "t", b, "nid", "n").collect())
    assert got == sorted((i, j) for i, t in texts for j, n in names if n in t)


def test_containment_under_hot_words(spark):
    """JN-5: patterns of every length over few words, one of them in nearly all texts, with keys split into parts."""
    import random

    from ledgerly.operators import joins as JJ
    r = random.Random(5)
    words = ["com", "maria", "ana", "da", "silva", "é", "x", "aula", "marias"]
    say = lambda n: " ".join(r.choices(words, [20, 3, 2, 2, 2, 1, 1, 1, 1], k=n))
    texts = [(k, say(r.randint(1, 14)).replace("aula", "AULA\t ")) for k in range(400)] + [(900, ""), (901, None), (902, " ")]
    pats = [(k, say(1 + k % 7)) for k in range(120)] + [(500, "aria si"), (501, "om da s"), (502, "nowhere to be found"), (503, ""), (504, None), (505, "a")]
    a = spark.createDataFrame(texts, "id int, t string")
    b = spark.createDataFrame(pats, "pid int, p string")
    flat = lambda t: " ".join((t or "").lower().split())
    want = sorted((i, j) for i, t in texts for j, p in pats if flat(p) and t is not None and flat(p) in flat(t))
    for split in (7, 200_000):
        got = [(x.id, x.pid) for x in JJ.contains_join(a, "id", "t", b, "pid", "p", split=split).collect()]
        assert sorted(got) == want


def test_a_hot_middle_word_makes_no_large_task(spark):
    """JN-5: a third of the texts hold the patterns' middle word; keys by frequency, and parts of a hot key, keep tasks even."""
    from ledgerly.operators import joins as JJ
    texts = spark.range(9000).selectExpr("id", "if(id % 3 = 0, concat('aula com ', chr(97 + id % 26), 'ana'), concat('outra ', id)) as t")
    pats = spark.createDataFrame([(k, f"aula com {chr(97 + k)}ana") for k in range(26)], "pid int, p string")
    found = JJ.contains_join(texts, "id", "t", pats, "pid", "p", split=50)
    assert found.count() == 3000
    per_key = found.groupBy("pid").count().collect()
    assert len(per_key) == 26 and max(r["count"] for r in per_key) <= 120
    # the middle word alone would have made 26 x 3000 candidates; the keys in use show each text to one pattern
    keys = JJ._pattern_keys(F.col("p"), F.split("p", " "))
    assert {len(r.k) for r in pats.select(keys.alias("k")).collect()} == {3}


def test_null_keys_never_allocate(spark):
    """AL-2 / JN-10 / JN-12: null keys meet nothing; a null code keeps its match by text; empty codes match nothing."""
    from ledgerly.operators import joins as JJ
    facts = spark.createDataFrame([(1, None, "ball", "2024-01-02"), (2, "000", "none", "2024-01-02"), (3, " 007", None, "2024-01-02"),
                                   (4, None, None, "2024-01-02")], "id int, code string, txt string, d string")
    costs = spark.createDataFrame([(1, "7", "racket", 5.0), (2, "0", "x", 6.0), (3, None, " Ball ", 7.0), (4, None, None, 8.0)],
                                  "ord int, sku string, descr string, c double") \
        .selectExpr("*", "cast(null as date) as s", "cast(null as date) as e")
    got = {r.id: r.c for r in JJ.effective_lookup(facts, costs, "code", "txt", "d", "sku", "descr", "s", "e", "ord", ["c"]).collect()}
    assert got == {1: 7.0, 2: None, 3: 5.0, 4: None}
    a = spark.createDataFrame([(1, "k", "2024-01-03"), (2, None, "2024-01-03"), (3, "k", None)], "id int, k string, d string")
    b = spark.createDataFrame([("k", "2024-01-01", 9), (None, "2024-01-03", 8)], "k string, bd string, v int")
    got = {r.id: (r.v, r.nearest_days) for r in JJ.nearest(a, b, ["k"], "d", "bd", ["v"], "v").collect()}
    assert got == {1: (9, 2), 2: (None, None), 3: (None, None)}


def test_effective_lookup_against_the_first_row_found(spark):
    """JN-12: overlapping, open, empty and equal ranges, both rules, accents, a default start; the first cost row that fits wins."""
    import datetime as dt
    import random
    import re

    from ledgerly.operators import joins as JJ
    r = random.Random(12)
    day = lambda k: dt.date(2026, 1, 1) + dt.timedelta(days=k)
    codes, texts = ["7", "007", " 8", "0", "", None], ["Café curto", "cafe  curto", "CAFÉ\tcurto ", "Chá", "", None]
    costs = [(i, r.choice(codes), r.choice(texts), r.choice([None, day(r.randint(-9, 40))]), r.choice([None, day(r.randint(-9, 40))]), float(i)) for i in range(120)]
    facts = [(i, r.choice(codes), r.choice(texts), None if i % 50 == 0 else day(r.randint(-15, 50))) for i in range(400)]
    clean = lambda c: (c or "").strip().lstrip("0")
    plain = lambda t: re.sub(r"\s+", " ", (t or "").lower().strip())

    def first(code, text, d, since):
        for o, sku, descr, s, e, c in costs:
            if d and (s or since) <= d <= (e or dt.date(9999, 12, 31)) and (
                    clean(code) and clean(code) == clean(sku) or plain(text) and plain(text) == plain(descr)):
                return o, c
        return None, None
    a = spark.createDataFrame(facts, "id int, code string, txt string, d date").withColumn("c", F.lit("kept"))
    b = spark.createDataFrame(costs, "ord int, sku string, descr string, s date, e date, unit double")
    for default, since in ((None, dt.date(1, 1, 1)), ("2026-01-10", dt.date(2026, 1, 10))):
        got = JJ.effective_lookup(a, b, "code", "txt", "d", "sku", "descr", "s", "e", "ord", ["unit"], default_start=default)
        assert got.columns == ["id", "code", "txt", "d", "c", "cost_ordinal", "unit"]
        assert {x.id: (x.cost_ordinal, x.unit) for x in got.collect()} == {i: first(k, t, d, since) for i, k, t, d in facts}
        assert JJ.effective_lookup(a, b.limit(0), "code", "txt", "d", "sku", "descr", "s", "e", "ord", ["unit"]).where("unit is not null").count() == 0


def test_disjoint_ranges_of_one_popular_key(spark):
    from ledgerly.operators import joins as JJ
    rows = [("k", k % 500, k % 500 + 1 + k % 7, 5000 - k) for k in range(5000)]
    df = spark.createDataFrame(rows, "k string, s int, e int, o int")
    got = [(r["__from"], r.o) for r in JJ.disjoint_ranges(df, ["k"], "s", "e", "o", []).orderBy("__from").collect()]
    best = {d: min((o for _, s, e, o in rows if s <= d <= e), default=None) for d in range(510)}
    assert got == [(d, best[d]) for d in range(510) if d == 0 or best[d] != best[d - 1]]


def test_running_cash_takes_the_extra_opening_once(spark):
    """RP-13: three months after the extra opening, a month without rows between them."""
    from ledgerly.plans.finance import FinanceRules, cash_flow_statement
    rows = [("2026-06-10", "100", "Operacional"), ("2026-08-10", "10", "Operacional")]
    led = spark.createDataFrame([(True, d, "revenue", a, "c", f) for d, a, f in rows],
                                "paid boolean, due_date string, transaction_type string, amount string, category_name string, "
                                "cost_center_descricao string").withColumn("due_date", F.to_date("due_date"))
    r = FinanceRules(opening=1000, extra_openings=[("2026-07-01", 500)])
    _, s = cash_flow_statement(led, "2026-06-01", "2026-09-01", r)
    got = [(str(x.month)[:7], float(x.opening), float(x.closing)) for x in s.orderBy("month").collect()]
    net = [float(x.net) for x in s.orderBy("month").collect()]
    assert [m for m, _, _ in got] == ["2026-06", "2026-07", "2026-08", "2026-09"]
    assert got[1][1] - got[0][2] == 500 and got[2][1] == got[1][2] and got[3][1] == got[2][2] and net[1] == net[3] == 0


def test_balance_keeps_keys_without_a_movement(spark):
    from ledgerly.operators import agg as GG
    df = spark.createDataFrame([("a", "2024-01-01", 5), ("b", "2024-02-10", 7)], "k string, d string, v int") \
        .selectExpr("k", "cast(d as date) as d", "cast(v as decimal(18,2)) as v")
    got = {r.k: float(r.balance) for r in GG.investment_balance(df, ["k"], "d", "v", 100, "2024-02-01", "2024-02-28").collect()}
    assert got == {"a": 100.0, "b": 107.0}


def test_provision_takes_safety_on_scheduled_and_gap(spark):
    from ledgerly.operators import agg as GG
    row = spark.range(1).select(GG.provision(F.lit(200.0), F.lit(800.0), 0.05, F.lit(30)).alias("p"),
                                GG.provision(F.lit(-50.0), F.lit(900.0), 0.05, F.lit(30)).alias("q")).first()
    assert row.p == 250.0 / 30 and row.q == 45.0 / 30


def test_open_days_of_past_current_and_later_months(spark):
    from ledgerly.functions import dates as D
    rows = spark.createDataFrame([("2026-06-01",), ("2026-07-01",), ("2026-09-01",)], "m string") \
        .select(D.open_days(F.col("m").cast("date"), F.lit("2026-07-30")).alias("days")).collect()
    assert [[str(d) for d in r["days"][:2]] for r in rows] == [[], ["2026-07-30", "2026-07-31"], ["2026-09-01", "2026-09-02"]]
    assert [len(r["days"]) for r in rows] == [0, 2, 30]


def test_labels_by_a_table_of_rules(spark):
    """CL-1: several conditions, dates, nulls and ties; every row against a plain evaluation of the table."""
    from ledgerly.operators import rules as RR
    r = random.Random(8)
    day = lambda k: dt.date(2026, 1, 1) + dt.timedelta(days=k)
    rules = [("a", 1, "x", "equals", "Ana", None, day(10), "one"), ("a", 1, "y", "contains", "VI", None, None, "one"),
             ("a", 2, "y", "starts", "da", day(3), None, "two"), ("a", 2, "y", "starts", "da", day(3), None, "also"),
             ("a", 3, "x", "contains", None, None, None, "never"), ("a", 9, None, "always", None, day(15), None, "late"),
             ("b", 5, "y", "contains", "a", None, None, "b5"), ("b", 4, "x", "equals", "bob", day(0), day(20), "b4"), ("c", 1, None, "always", None, None, None, "c")]
    rows = [(i, r.choice(["ana", "Bob", "", None]), r.choice(["Davi", "vida", "da vi", None, "x"]), r.choice([None, *map(day, range(25))])) for i in range(300)]

    def holds(rule, x, y, d):
        _, _, c, predicate, p, since, upto, _ = rule
        v = {"x": x, "y": y}.get(c)
        if (since or upto) and d is None or since and d < since or upto and d > upto:
            return False
        return predicate == "always" or v is not None and p is not None and {
            "equals": v.lower() == p.lower(), "contains": p.lower() in v.lower(), "starts": v.lower().startswith(p.lower())}[predicate]

    def label(name, x, y, d):
        for p in sorted({k[1] for k in rules if k[0] == name}):
            own = [k for k in rules if k[:2] == (name, p)]
            if all(holds(k, x, y, d) for k in own):
                return min(k[7] for k in own)
        return None
    df = spark.createDataFrame(rows, "id int, x string, y string, d date")
    table = spark.createDataFrame(rules, RR.RULES_SCHEMA)
    got = {g.id: (g.a, g.b, g.c) for g in RR.label_by_rules(df, table, ["x", "y"], "d", ["a", "b", "c"]).collect()}
    assert got == {i: tuple(label(n, x, y, d) for n in "abc") for i, x, y, d in rows}


def test_keywords_are_taken_as_they_are_written(spark):
    """FL-7, FL-9, FL-11: words with signs that a pattern would read otherwise; text rules over several columns."""
    from ledgerly.operators import filters as FF
    df = spark.createDataFrame([(1, "x", "Fundo C.D.B.", None), (2, "x", "fundo cxdxb", "(a"), (3, "INV", None, None), (4, None, "b", "C.d.b. (x)")],
                               "id int, kind string, t string, u string")
    ids = lambda d: sorted(r.id for r in d.collect())
    assert ids(FF.investment_moves(df, "kind", "INV", ["t", "u"], ["c.d.b"])) == [1, 3, 4]
    assert ids(FF.investment_moves(df, "kind", "INV", ["t", "u"], ["("])) == [2, 3, 4]
    assert ids(FF.future_plan(df, "kind", "u", ["(x"])) == [4]
    assert ids(FF.expense_lines(df, [(None, "c.d.b", None, None)], ["t", "u", "absent"])) == [2, 3]
    assert ids(FF.expense_lines(df, [("t", ["FUNDO"], None, None), ("kind", "INV", None, None)])) == [4]
