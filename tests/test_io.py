"""Sources and sinks: schedule ingest, month replacement, append, delete, optional source,
override merge, and the streaming ingest (files written to a fresh temp folder)."""

import os
import tempfile

from pyspark.sql import functions as F

from ledgerly.operators import joins as J
from ledgerly.sources import io

CSV1 = "Relatorio\n\nData;Bandeira;Valor\n05/07/2026;visa;R$ 1.234,56\n05/07/2026;master;10,00\nx;y;z\n2026-08-01;visa;5\n"
CSV2 = "Data;Valor\n10/07/2026;7,5\n"


def _write(d, name, text):
    with open(os.path.join(d, name), "w") as f:
        f.write(text)


def test_ingest_and_replace_months(spark):
    d = tempfile.mkdtemp(prefix="ledgerly-in-")
    _write(d, "a.csv", CSV1)
    rows = io.ingest_schedule(spark, d + "/*.csv", "acq")
    got = sorted((str(r.release_date), r.value) for r in rows.collect())
    assert got == [("2026-07-05", 1244.56), ("2026-08-01", 5.0)]
    out = tempfile.mkdtemp(prefix="ledgerly-out-") + "/sched"
    io.replace_months(rows, out, "release_date", ["release_date", "acquirer"], "value")
    _write(d, "b.csv", CSV2)
    new = io.ingest_schedule(spark, d + "/b.csv", "acq")
    io.replace_months(new, out, "release_date", ["release_date", "acquirer"], "value")
    back = sorted((str(r.release_date), r.value) for r in spark.read.parquet(out).collect())
    # July replaced by the new file, August untouched
    assert back == [("2026-07-10", 7.5), ("2026-08-01", 5.0)]


def test_schedule_aliases_quotes_and_replacement(spark):
    """SR-4: quoted cells and other header names; sums stay within a file, of two files of a month the newest counts."""
    d = tempfile.mkdtemp(prefix="ledgerly-in-")
    _write(d, "a.csv", 'Data Prevista;"Valor Líquido; final"\n05/07/2026;"1.234,56"\n05/07/2026;1\n09/08/2026;2\n')
    _write(d, "b.csv", "obs;net_amount;Vencimento em\nx;7;05/07/2026\n")
    _write(d, "c.csv", "nothing;here\n1;2\n")
    _write(d, "e.csv", "Data;Valor\nx;y\n")
    for name, at in (("a", 1000), ("b", 2000), ("c", 2000), ("e", 2000)):
        os.utime(os.path.join(d, name + ".csv"), (at, at))
    got = sorted((str(r.release_date), r.value) for r in io.ingest_schedule(spark, d, "acq").collect())
    assert got == [("2026-07-05", 7.0), ("2026-08-09", 2.0)]
    os.utime(os.path.join(d, "a.csv"), (3000, 3000))
    got = sorted((str(r.release_date), r.value) for r in io.ingest_schedule(spark, d, "acq").collect())
    assert got == [("2026-07-05", 1235.56), ("2026-08-09", 2.0)]
    bad = {os.path.basename(r.file): r.reason for r in io.rejected_files(spark, d).collect()}
    assert bad == {"c.csv": io.NO_HEADER, "e.csv": io.NO_ROWS}


def _files(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_append_twice_and_optional_source(spark):
    base = tempfile.mkdtemp(prefix="ledgerly-sk-")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    io.append(df, base + "/t", "first")
    io.append(df.where("id = 1"), base + "/t", "second")
    io.append(df.where("id = 1"), base + "/t", "second")  # the job is retried
    assert sorted(r.id for r in io.appended(spark, base + "/t").collect()) == [1, 1, 2] and io.appended(spark, base + "/t").columns == ["id", "v"]
    empty = io.read_or_empty(spark, base + "/missing", "id int, v string")
    assert empty.count() == 0 and empty.columns == ["id", "v"]


def test_delete_rewrites_touched_partitions_only(spark):
    path = tempfile.mkdtemp(prefix="ledgerly-del-") + "/t"
    rows = [(k, f"2026-{1 + k % 4:02d}", None if k == 9 else k % 5) for k in range(40)] + [(99, "2026-12", 99)]
    spark.createDataFrame(rows, "id int, month string, v int").write.partitionBy("month").parquet(path)
    before = _files(path)
    assert io.delete_where(spark, path, F.col("v") == 99, "month") == 1
    assert before - _files(path) == {f for f in before if "2026-12" in f} and not os.path.exists(path + "/month=2026-12")
    assert io.delete_where(spark, path, (F.col("v") == 3) & (F.col("month") == "2026-02"), "month") == 1
    assert {f for f in before & _files(path)} == {f for f in before if "2026-12" not in f and "2026-02" not in f}
    left = {(r.id, r.month) for r in spark.read.parquet(path).collect()}
    assert left == {(k, m) for k, m, v in rows if v != 99 and not (v == 3 and m == "2026-02")}
    assert io.delete_where(spark, path, F.col("v") == 1000, "month") == 0


def test_a_delete_that_died_between_partitions_is_run_again(spark):
    path = tempfile.mkdtemp(prefix="ledgerly-del-") + "/t"
    spark.createDataFrame([(k, k % 3) for k in range(30)], "id int, p int").write.partitionBy("p").parquet(path)
    table, gone = spark.read.parquet(path), F.col("id") < 15
    io.rewrite_partitions(spark, path, "p", [0], table.where((F.col("p") == 0) & ~gone))  # one of three was done
    assert io.delete_where(spark, path, F.col("id") < 15, "p") == 2
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == list(range(15, 30))


def test_upsert_of_overrides_touches_their_buckets(spark):
    path = tempfile.mkdtemp(prefix="ledgerly-up-") + "/t"
    schema = "k int, ts int, is_deleted boolean, amt double"
    io.upsert(spark, path, spark.createDataFrame([(k, 1, False, float(k)) for k in range(50)], schema), "k", "ts", ["amt"], buckets=16)
    before, delta = _files(path), spark.createDataFrame([(3, 2, False, None), (7, 2, True, None), (60, 1, False, 6.0), (4, 0, False, 99.0)], schema)
    for _ in range(2):  # the same again changes nothing
        io.upsert(spark, path, delta, "k", "ts", ["amt"], buckets=16)
        rows = {r.k: (r.ts, r.is_deleted, r.amt) for r in spark.read.parquet(path).collect()}
        assert len(rows) == 51 and rows[3] == (2, False, None) and rows[7] == (2, True, 7.0) and rows[60] == (1, False, 6.0) and rows[4] == (1, False, 4.0)
    assert len(before & _files(path)) >= len(before) - 4
    io.upsert(spark, path, delta.limit(0), "k", "ts", ["amt"], buckets=16)


def test_merge_overrides_tombstone_keeps_fields(spark):
    cur = spark.createDataFrame([(1, 1, False, 10.0, "x")], "k int, ts int, is_deleted boolean, amt double, name string")
    delta = spark.createDataFrame([(1, 2, True, None, None), (2, 1, False, 5.0, "y")],
                                  "k int, ts int, is_deleted boolean, amt double, name string")
    m = {r.k: r for r in J.merge_overrides(cur, delta, "k", "ts", ["amt", "name"]).collect()}
    assert m[1].is_deleted is True and m[1].amt == 10.0 and m[1].name == "x"
    assert m[2].amt == 5.0


def test_merge_overrides_edit_clears_fields(spark):
    cur = spark.createDataFrame([(1, 1, False, 9.0, "x")], "k int, ts int, is_deleted boolean, amt double, name string")
    delta = spark.createDataFrame([(1, 2, False, None, "y"), (1, 3, True, None, None)], cur.schema)
    one = J.merge_overrides(cur, delta.limit(1), "k", "ts", ["amt", "name"]).first()
    assert one.amt is None and one.name == "y" and one.is_deleted is False
    two = J.merge_overrides(cur, delta, "k", "ts", ["amt", "name"]).first()
    assert two.is_deleted is True and two.amt is None and two.name == "y"


def test_schedule_stream(spark):
    from ledgerly.streaming.ingest import start_schedule_stream
    d = tempfile.mkdtemp(prefix="ledgerly-stream-in-")
    _write(d, "a.csv", CSV1)
    out = tempfile.mkdtemp(prefix="ledgerly-stream-out-") + "/sched"
    # a stream resumes from its checkpoint, so each test run takes a new query name
    name = "sched_test_" + os.path.basename(d).replace("-", "_")
    q = start_schedule_stream(spark, d, out, "acq", name=name)
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    got = sorted((str(r.release_date), r.value) for r in spark.read.parquet(out).collect())
    assert got == [("2026-07-05", 1244.56), ("2026-08-01", 5.0)]


def test_stream_reads_its_own_files_and_late_ones_undo_nothing(spark, monkeypatch):
    from ledgerly.streaming.ingest import start_schedule_stream
    d, out = tempfile.mkdtemp(prefix="ledgerly-stream-in-"), tempfile.mkdtemp(prefix="ledgerly-stream-out-") + "/sched"
    name = "sched_late_" + os.path.basename(d).replace("-", "_")
    seen, days = [], io.schedule_days
    monkeypatch.setattr(io, "schedule_days", lambda lines, *a, **b: seen.append(sorted(
        os.path.basename(r.file) for r in lines.select("file").distinct().collect())) or days(lines, *a, **b))

    def run():  # each time a restart from the checkpoint
        q = start_schedule_stream(spark, d, out, "acq", name=name)
        try:
            q.processAllAvailable()
        finally:
            q.stop()
        return sorted((str(r.release_date), r.value) for r in spark.read.parquet(out).collect())

    def put(file, at, text):
        tmp = tempfile.mkdtemp(prefix="ledgerly-tmp-") + "/" + file
        with open(tmp, "w") as f:
            f.write(text)
        os.utime(tmp, (at, at))
        os.rename(tmp, os.path.join(d, file))
    put("b.csv", 2000, "Data;Valor\n05/07/2026;7\n06/07/2026;1\n01/08/2026;5\n")
    assert run() == [("2026-07-05", 7.0), ("2026-07-06", 1.0), ("2026-08-01", 5.0)]
    august = _files(out + "/month=2026-08")
    put("a.csv", 1000, "Data;Valor\n05/07/2026;99\n01/09/2026;3\n")   # older, but its September is new
    put("c.csv", 3000, "Data;Valor\n09/07/2026;4\n")                    # newer: July as a whole
    assert run() == [("2026-07-09", 4.0), ("2026-08-01", 5.0), ("2026-09-01", 3.0)]
    put("e.csv", 4000, "no;header\n1;2\n")
    assert run() == [("2026-07-09", 4.0), ("2026-08-01", 5.0), ("2026-09-01", 3.0)]
    assert _files(out + "/month=2026-08") == august and seen == [["b.csv"], ["a.csv", "c.csv"], ["e.csv"]]


def test_monthly_report_equals_the_single_queries(spark):
    from ledgerly.plans import registry
    from ledgerly.plans.report import INPUTS, REPORTS, monthly_report
    from ledgerly.sources import tables
    out, sf, read = tempfile.mkdtemp(prefix="ledgerly-report-"), "/root/testdata/sf0.001", []
    names = ["operations_kpis", "goals", "payables", "commission_dashboard", "paid_dashboard", "teacher_balances", "statement_lines", "daily_cash"]
    import ledgerly.plans.report as report
    keep = report.table
    report.table = lambda s, d, n: read.append((d, n)) or tables.table(s, d, n)
    try:
        paths = monthly_report(spark, sf, out, names)
    finally:
        report.table = keep
    assert sorted(read) == sorted((sf, n) for n in INPUTS)  # each input once
    assert set(names) <= set(REPORTS) <= set(registry.QUERIES)
    for n, p in paths.items():
        assert sorted(map(repr, spark.read.parquet(p).collect())) == sorted(map(repr, registry.QUERIES[n](spark, sf).collect())), n


def test_read_table_prunes_and_pushes_down(spark):
    from pyspark.sql import functions as F
    df = io.read_table(spark, "/root/testdata/sf0.001/orders.parquet", ["o_orderkey", "o_orderdate"],
                       F.col("o_orderkey") < 100, order=[F.col("o_orderkey").desc()], limit=5)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderkey), LessThan(o_orderkey,100)]" in plan
    assert "o_totalprice" not in plan.split("ReadSchema")[1].split("\n")[0]
    assert [r.o_orderkey for r in df.collect()] == sorted([r.o_orderkey for r in df.collect()], reverse=True)


def test_schedule_header_must_be_in_the_first_rows(spark):
    d = tempfile.mkdtemp(prefix="ledgerly-hdr-")
    late = "\n".join(["x"] * 16) + "\nData;Valor\n05/07/2026;10,00\n"
    _write(d, "late.csv", late)
    _write(d, "ok.csv", "titulo\nValor;Data\n1.234,50;2026-07-06\n;2026-07-07\nabc;2026-07-08\n")
    rows = io.ingest_schedule(spark, d + "/*.csv", "acq")
    got = sorted((str(r.release_date), r.value) for r in rows.collect())
    # the late header (row 17) is not found; columns are found by position in any order;
    # empty and non-numeric values are skipped
    assert got == [("2026-07-06", 1234.5)]
