"""AL-2 invariants: every item with a slot in its key is fully allocated; each tier is hit."""

from pyspark.sql import functions as F

from ledgerly.operators import alloc as A


def test_three_tiers_and_conservation(spark):
    slots = spark.createDataFrame([
        # key 1: type A exists -> tier a
        (1, "s1", "A", 2), (1, "s2", "B", 1),
        # key 2: item type C has no slot; s4 (type D) uncovered -> tier b
        (2, "s3", "E", 1), (2, "s4", "D", 3),
        # key 3: no uncovered slot -> tier c (item type F has no slot, G is covered)
        (3, "s5", "G", 1), (3, "s6", "G", 3),
    ], "k int, slot string, stype string, w bigint")
    items = spark.createDataFrame([
        (1, "A", 100.0), (2, "C", 60.0), (2, "E", 10.0), (3, "F", 40.0), (3, "G", 8.0), (4, "A", 5.0),
    ], "k int, itype string, value double").withColumn("value", F.col("value").cast("decimal(18,2)"))
    out = A.allocate(slots, items, ["k"], ["slot"], "stype", "itype", "w", ["value"])
    got = {r.slot: round(r.value, 6) for r in out.collect()}
    assert got["s1"] == 100.0 and got["s2"] == 0.0             # tier a
    assert got["s4"] == 60.0 and got["s3"] == 10.0             # tier b for C, own type for E
    assert got["s5"] == 10.0 + 2.0 and got["s6"] == 30.0 + 6.0  # tier c for F, type G for G
    assert round(sum(got.values()), 6) == 100.0 + 60.0 + 10.0 + 40.0 + 8.0  # key 4 has no slot


def test_share_split_keeps_totals(spark):
    df = spark.createDataFrame([("a", 10.0, True), ("b", 5.0, False)], "p string, v double, c boolean")
    out = A.share_split(df, F.col("c"), "p", "z", ["v"])
    rows = sorted((r.p, r.v) for r in out.collect())
    assert rows == [("a", 5.0), ("b", 5.0), ("z", 5.0)]


def test_contains_join_substring_semantics(spark):
    from ledgerly.operators.joins import contains_join
    a = spark.createDataFrame([(1, "xthe Cat  sat on the mat"), (2, "the cat satisfied"), (3, "abc"),
                               (4, "nothing here")], "id int, t string")
    b = spark.createDataFrame([(10, "the cat sat"), (11, "cat sat"), (12, "b"), (13, "at on the m"),
                               (14, "zzz")], "bid int, bt string")
    got = sorted((r.id, r.bid) for r in contains_join(a, "id", "t", b, "bid", "bt").collect())
    want = sorted((i, j) for i, t in [(1, "xthe cat sat on the mat"), (2, "the cat satisfied"), (3, "abc"),
                                      (4, "nothing here")]
                  for j, u in [(10, "the cat sat"), (11, "cat sat"), (12, "b"), (13, "at on the m"), (14, "zzz")]
                  if u in t)
    assert got == want
