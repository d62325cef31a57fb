"""Plans whose work grows no faster than the rows: findings of round 3."""

import time

from pyspark.sql import functions as F

from ledgerly.operators import estimate as X
from ledgerly.operators import joins as J
from ledgerly.operators import rules as R
from ledgerly.session import CLEAN_SHUFFLES, stage


def shuffle_files(spark) -> set:
    import pathlib
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for d in folders for f in pathlib.Path(d).rglob("shuffle_*.data")}


def plan(df) -> str:
    return df._jdf.queryExecution().toString().split("== Physical Plan ==")[-1]


def test_names_that_begin_alike_are_keyed_by_their_ends(spark):
    """JN-5: keys from the whole of a short pattern; texts with text ids, some twice."""
    names = spark.createDataFrame([(f"Customer#{k:09d}",) for k in range(300)], "n string")
    keys = names.select(J._pattern_keys(F.lower("n"), F.split("n", " ")).alias("k"))
    assert keys.select(F.element_at("k", -1).alias("k")).distinct().count() == 300
    assert {len(r.k) for r in keys.collect()} == {J.CANDIDATES}
    texts = spark.createDataFrame([(f"Aula - Customer#{k:09d}",) for k in range(0, 600, 7)] + [(None,), ("",)], "t string")
    got = sorted(tuple(r) for r in J.contains_join(texts, "t", "t", names, "n", "n").collect())
    assert got == [(f"Aula - Customer#{k:09d}", f"Customer#{k:09d}") for k in range(0, 300, 7)]


def test_rules_are_met_by_profiles_not_by_rows(spark):
    """CL-1: days around the ends of rules, days without rules and no day; the rows are shuffled for no rule."""
    from datetime import date, timedelta
    days = [None, *[date(2023, 12, 29) + timedelta(k) for k in range(12)]]
    df = spark.createDataFrame([(w, d) for w in ("Aula x", "other", None) for d in days], "t string, d date")
    rules = spark.createDataFrame([("a", 1, "t", "contains", "aula", date(2024, 1, 1), date(2024, 1, 3), "in"), ("a", 2, "t", "equals", "other", None, date(2024, 1, 5), "upto"),
                                   ("a", 3, None, "always", None, date(2024, 1, 8), None, "from"), ("a", 9, None, "always", None, None, None, "else")], R.RULES_SCHEMA)
    out = R.label_by_rules(df, rules, ["t"], "d", ["a"])

    def want(t, d):
        if t and "aula" in t.lower() and d and date(2024, 1, 1) <= d <= date(2024, 1, 3):
            return "in"
        if t == "other" and d and d <= date(2024, 1, 5):
            return "upto"
        return "from" if d and d >= date(2024, 1, 8) else "else"
    rows = out.collect()
    assert len(rows) == 39 and all(r.a == want(r.t, r.d) for r in rows)
    assert "Exchange hashpartitioning" not in plan(out)


def test_nearest_leaves_out_rows_with_a_row_in_their_month(spark):
    """JN-10 with JN-9 in one pass: the same as an anti join by month before; null keys and days stay."""
    a = spark.createDataFrame([(k, "xyz"[k % 3] if k % 11 else None, f"2024-{1 + k % 9:02d}-{1 + k % 28:02d}" if k % 13 else None) for k in range(200)], "id int, k string, d string")
    b = spark.createDataFrame([(k, "xy"[k % 2], f"2024-{1 + 2 * k % 9:02d}-{1 + 5 * k % 28:02d}") for k in range(12)], "v int, k string, bd string")
    month = lambda c: F.trunc(F.to_date(c), "MM").alias("m")
    left = a.select("*", month("d")).join(b.select("k", month("bd")).distinct(), ["k", "m"], "left_anti").drop("m")
    want = sorted(map(str, J.nearest(left, b, ["k"], "d", "bd", ["v"], "v").select("id", "k", "d", "v", "nearest_days").collect()))
    got = J.nearest(a, b, ["k"], "d", "bd", ["v"], "v", apart="MM").select("id", "k", "d", "v", "nearest_days").collect()
    assert sorted(map(str, got)) == want and 0 < len(want) < 200


def test_pending_bookings_are_priced_once(spark):
    """AL-9: texts are read before the stage table, not by each of its readers."""
    rows = spark.createDataFrame([("s", k, "Aula (1 / 2)", "clase_colectiva", "10:00", False) for k in range(4)],
                                 "student string, booking_id int, description string, booking_type string, start_time string, is_socio boolean")
    per_b, per_s = X.estimate_pending(rows.withColumn("booking_date", F.date_add(F.lit("2024-01-01"), F.col("booking_id"))))
    assert per_b.count() == 4 and per_s.count() == 1
    assert "regexp" not in plan(per_s).lower() and "(1 / 2)" not in plan(per_s)


def test_facts_are_not_sorted_to_meet_dated_costs(spark, monkeypatch):
    """JN-12: many keys are the hashed side of a join; few texts are broadcast, however many the codes."""
    facts = spark.createDataFrame([(k, str(k % 50), "ball", "2024-01-02") for k in range(100)], "id int, code string, txt string, d string")
    costs = spark.createDataFrame([(k, str(k), "ball", float(k)) for k in range(50)], "ord int, sku string, descr string, c double") \
        .selectExpr("*", "cast(null as date) as s", "cast(null as date) as e")
    sizes = []
    monkeypatch.setattr(J, "fits_broadcast", lambda df, max_rows: sizes.append(df.count()) or sizes[-1] < 10)
    out = J.effective_lookup(facts, costs, "code", "txt", "d", "sku", "descr", "s", "e", "ord", ["c"])
    p = plan(out)
    assert sizes == [49, 1]  # codes without zeros, and texts
    assert "ShuffledHashJoin" in p and "BroadcastHashJoin" in p and "SortMergeJoin" not in p
    assert {r.id: r.c for r in out.collect()} == {k: 0.0 for k in range(100)}


def test_a_stage_table_leaves_no_shuffle_files(spark):
    """The files of its shuffles go with its writing, and other queries' settings stay."""
    before, setting = shuffle_files(spark), spark.conf.get(CLEAN_SHUFFLES, "false")
    out = stage(spark.range(1000).repartition(3, "id").groupBy((F.col("id") % 7).alias("k")).count())
    for _ in range(100):  # files are removed in the background
        left = shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.1)
    assert not left and spark.conf.get(CLEAN_SHUFFLES, "false") == setting
    assert out.agg(F.sum("count")).first()[0] == 1000


def test_rows_that_meet_nothing_are_told_by_a_filter(spark, monkeypatch):
    """No row that meets one is flagged false, whatever the filter's size; joins behind it are exact, nulls and repeats included."""
    a = spark.createDataFrame([(None if k % 41 == 0 else f"k{k % 300}", k, k % 3) for k in range(900)] + [("", -1, 0)], "key string, v int, g int")
    b = spark.createDataFrame([(f"k{k}", k) for k in range(0, 600, 5)] + [("k10", 7), (None, 1)], "key string, w int")
    rows = lambda df: sorted(map(str, df.select(sorted(df.columns)).collect()))
    for bits in (J.FILTER_BITS, J.ROW_BITS, 3):
        monkeypatch.setattr(J, "FILTER_BITS", bits)
        marked = J.may_meet(a, b, ["key"])
        assert marked.columns == [*a.columns, "__may"] and marked.count() == a.count()
        assert marked.where("not __may").join(b, "key").count() == 0 and marked.where("key is null and __may").count() == 0
        assert rows(J.left_join_met(a, b, ["key"])) == rows(a.join(b, "key", "left"))
        assert rows(J.unused(a, "key", b, a.where("g = 1"))) == rows(a.where("key is not null").join(b.select("key").union(a.where("g = 1").select("key")), "key", "left_anti"))
    monkeypatch.setattr(J, "FILTER_BITS", 28)
    assert J.may_meet(a, b, ["key"]).where("__may").count() < 400
    # equal values of two types have two hashes: all rows are flagged
    assert J.may_meet(a, b.withColumn("v", F.col("w").cast("long")), ["v"]).where("__may").count() == a.count()


def test_nearest_shuffles_rows_by_key_alone(spark):
    """JN-10: one row of days a key; days before, between, on and after the candidates, null days and keys, as by all pairs."""
    a = spark.createDataFrame([(k, "xyz"[k % 3] if k % 11 else None, f"2024-{1 + k % 12:02d}-{1 + k % 28:02d}" if k % 13 else None) for k in range(150)], "id int, k string, d string")
    b = spark.createDataFrame([(k, "xy"[k % 2], f"2024-{2 + k * k % 9:02d}-{1 + 5 * k % 28:02d}" if k % 7 else None) for k in range(40)], "v int, k string, bd string")
    out = J.nearest(a, b, ["k"], "d", "bd", ["v"], "v")
    days = F.datediff(F.to_date("bd"), F.to_date("d"))
    best = a.join(b, "k").where("d is not null and bd is not null").groupBy("id").agg(F.min(F.struct(F.abs(days).alias("n"), F.to_date("bd").alias("bd"), "v")).alias("x"))
    want = {r.id: (r.v, r.n) for r in a.join(best, "id", "left").select("id", "x.v", "x.n").collect()}
    assert {r.id: (r.v, r.nearest_days) for r in out.collect()} == want and len(want) == 150
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(J.nearest(a, b, ["k"], "d", "bd", ["v"], "v"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Window" not in p and p.count("Exchange hashpartitioning(k#") == 3  # the rows, the days, the days of a key
