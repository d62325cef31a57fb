"""Sources and sinks (SR-1 .. SR-4, SK-1 .. SK-3; SK-4 is ``joins.merge_overrides``).

Paging and retry loops of a REST client become partitioned parquet reads;
writes are whole-partition overwrites, so a retried task or a lost executor
rewrites the same files instead of appending twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerly.functions import text as T
from ledgerly.operators.joins import merge_overrides
from ledgerly.session import cut_lineage


def read_table(spark: SparkSession, path: str, cols: Sequence[str] | None = None,
               where: Column | None = None, fmt: str = "parquet", order: Sequence[Column] | None = None,
               limit: int | None = None, offset: int = 0) -> DataFrame:
    """SR-1 / SR-2: a table with a column list and a predicate; both reach the
    scan. SO-5 / SO-7: an order, an offset and a limit, only where the report asks for them."""
    df = spark.read.format(fmt).load(path)
    if cols:
        df = df.select(*cols)
    if where is not None:
        df = df.where(where)
    if order:
        df = df.orderBy(*order)
    if offset:
        df = df.offset(offset)
    if limit is not None:
        df = df.limit(limit)
    return df


def read_or_empty(spark: SparkSession, path: str, schema: str, fmt: str = "parquet") -> DataFrame:
    """SR-3: an optional source. A missing path gives an empty frame of the
    schema so reports that union or join it still run."""
    jvm = spark._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(hpath):
        return spark.createDataFrame([], schema)
    return spark.read.format(fmt).schema(schema).load(path)


# Header cells of a receivables schedule's date and value columns, equal to or containing one of these.
DATE_ALIASES = ["data", "date", "data prevista", "prevision_payment_date", "data_liberacao", "liberacao"]
DATE_PARTS = ["data previsto", "vencimento"]
VALUE_ALIASES = ["valor", "valor liquido", "liquido", "net_amount", "valor_recebido", "valor_pago", "valor_liquido",
                 "valor bruto", "bruto", "gross_amount", "amount"]
VALUE_PARTS = ["valor líq", "líquido"]
NO_HEADER, NO_ROWS = "no date and value columns", "no row with a date and a value"


def csv_cells(line: Column, sep: str = ";") -> Column:
    """The cells of a CSV line: separators inside quotes do not cut, quotes around a cell go, doubled ones become one."""
    cells = F.split(line, sep + r'(?=(?:[^"]*"[^"]*")*[^"]*$)')
    return F.transform(cells, lambda c: F.replace(F.regexp_replace(F.trim(c), r'^"(.*)"$', "$1"), F.lit('""'), F.lit('"')))


def _position(cells: Column, equal: Sequence[str], parts: Sequence[str]) -> Column:
    """Place of the first cell that equals or contains an alias; null without one."""
    def hit(c):
        found = c.isin(list(equal))
        for part in parts:
            found = found | F.contains(c, F.lit(part))
        return found
    return F.aggregate(F.transform(cells, lambda c, i: F.when(hit(c), i)), F.lit(None).cast("int"),
                       lambda acc, x: F.coalesce(acc, x))


def _headers(lines: DataFrame, date_aliases, value_aliases, max_header_row: int, sep: str) -> DataFrame:
    """Per file its first header line: file, hpos, di, vi."""
    cells = F.transform(csv_cells(F.col("line"), sep), F.lower)
    heads = (lines.where(F.col("pos") < max_header_row)
                  .select("file", "pos", _position(cells, date_aliases, DATE_PARTS).alias("di"),
                          _position(cells, value_aliases, VALUE_PARTS).alias("vi"))
                  .where(F.col("di").isNotNull() & F.col("vi").isNotNull()))
    return heads.groupBy("file").agg(F.min(F.struct("pos", "di", "vi")).alias("h")) \
                .select("file", F.col("h.pos").alias("hpos"), "h.di", "h.vi")


def parse_schedule_lines(lines: DataFrame, date_aliases: Sequence[str] = DATE_ALIASES,
                         value_aliases: Sequence[str] = VALUE_ALIASES, max_header_row: int = 15,
                         sep: str = ";") -> DataFrame:
    """SR-4 core: ``lines`` = (file, pos, line). Per file the header is the
    first of the first ``max_header_row`` lines with a date and a value
    column; rows after it give (date, value) by the header's column
    positions; rows whose date or value does not parse are skipped."""
    heads = _headers(lines, date_aliases, value_aliases, max_header_row, sep)
    body = lines.join(heads, "file").where(F.col("pos") > F.col("hpos"))
    raw = csv_cells(F.col("line"), sep)
    out = body.select("file", F.try_element_at(raw, F.col("di") + 1).alias("d_txt"),
                      F.try_element_at(raw, F.col("vi") + 1).alias("v_txt"))
    out = out.select("file", T.parse_date_text("d_txt").alias("release_date"),
                     T.parse_money_text("v_txt").alias("value"))
    return out.where(F.col("release_date").isNotNull() & F.col("value").isNotNull() & ~F.isnan("value"))


def schedule_lines(spark: SparkSession, glob: str) -> DataFrame:
    """Numbered lines of the schedule files: file, changed (when the file was), pos, line."""
    files = spark.read.text(glob, wholetext=True).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_modification_time").alias("changed"))
    return files.select("file", "changed", F.posexplode(F.split(F.col("value"), r"\r?\n")).alias("pos", "line"))


def schedule_days(lines: DataFrame, acquirer: str, **kw) -> DataFrame:
    """Numbered lines of schedule files -> release_date, acquirer, value, source_file, changed, month.

    Duplicate dates are summed within a file (AG-29). Of several files with
    rows of one month the newest counts (by change time, then name).
    """
    rows = parse_schedule_lines(lines, **kw)
    month = F.date_format("release_date", "yyyy-MM").alias("month")
    days = rows.groupBy("file", "release_date", month).agg(F.round(F.sum("value"), 2).alias("value")) \
               .join(lines.select("file", "changed").distinct(), "file")
    newest = days.groupBy("month").agg(F.max(F.struct("changed", "file"))["file"].alias("file"))
    return days.join(newest, ["month", "file"]).select("release_date", F.lit(acquirer).alias("acquirer"), "value",
                                                       F.col("file").alias("source_file"), "changed", "month")


def ingest_schedule(spark: SparkSession, glob: str, acquirer: str, **kw) -> DataFrame:
    """SR-4: schedule CSVs -> (release_date, acquirer, value, source_file).

    A file replaces the whole months that it holds, so of several files with
    rows of one month the newest counts, whatever order they came in.
    """
    return schedule_days(schedule_lines(spark, glob), acquirer, **kw).drop("changed", "month")


SCHEDULE = "release_date date, acquirer string, value double, source_file string, changed timestamp, month string"


def merge_schedule(spark: SparkSession, new: DataFrame, path: str) -> None:
    """SK-1 with the newest file per month as its state: ``new`` (:func:`schedule_days`) into the table at ``path``.

    The table itself tells which file each of its months came from, so only
    the partitions of the months in ``new`` are read, and only those are
    written that a newer file (or the same one again) replaces. Months in
    ``new`` are calendar months, few enough to be named in the filter.
    """
    new = cut_lineage(new)
    months = [r.month for r in new.select("month").distinct().collect()]
    if not months:
        return
    held = read_or_empty(spark, path, SCHEDULE).where(F.col("month").isin(months)) \
        .groupBy("month").agg(F.max(F.struct("changed", "source_file")).alias("held"))
    fresh = new.join(held, "month", "left").where(F.col("held").isNull() | (F.struct("changed", "source_file") >= F.col("held"))).drop("held")
    (fresh.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(path))


def rejected_files(spark: SparkSession, glob: str, max_header_row: int = 15, sep: str = ";") -> DataFrame:
    """Files that ``ingest_schedule`` takes nothing from: file, reason."""
    lines = schedule_lines(spark, glob)
    heads = _headers(lines, DATE_ALIASES, VALUE_ALIASES, max_header_row, sep).select("file", F.lit(True).alias("has_header"))
    used = parse_schedule_lines(lines, max_header_row=max_header_row, sep=sep).select("file", F.lit(True).alias("has_rows")).distinct()
    files = lines.select("file").distinct().join(heads, "file", "left").join(used, "file", "left")
    return files.where(F.col("has_rows").isNull()).select(
        "file", F.when(F.col("has_header").isNull(), NO_HEADER).otherwise(NO_ROWS).alias("reason"))


def replace_months(df: DataFrame, path: str, date_col: str, keys: Sequence[str], value: str) -> None:
    """SK-1: upsert by ``keys`` after replacing every month present in ``df``.

    Rows are summed per key and written partitioned by month with dynamic
    partition overwrite: months not in ``df`` are untouched, months in it are
    replaced as a whole (idempotent under task retries).
    """
    out = df.groupBy(*keys).agg(F.sum(value).alias(value)) \
            .withColumn("month", F.date_format(F.trunc(F.col(date_col), "MM"), "yyyy-MM"))
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("month").parquet(path))


def append(df: DataFrame, path: str, batch: str) -> None:
    """SK-2: append rows (e.g. one payout), once.

    ``batch`` names what is appended. Its rows are a partition of their own,
    which a retried job replaces instead of adding them again. Read the table
    with :func:`appended`.
    """
    (df.withColumn("batch", F.lit(batch)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy("batch").parquet(path))


def appended(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all batches."""
    return spark.read.parquet(path).drop("batch")


def rewrite_partitions(spark: SparkSession, path: str, by: str, names: Sequence, kept: DataFrame) -> None:
    """Copy-on-write: the partitions ``names`` of the table at ``path`` become what ``kept`` has of them.

    All other files stay as they are. A partition that loses its last row is
    removed after the others have been written, so a job that dies in between
    leaves whole partitions, old or new, and can simply be run again.
    """
    fresh = cut_lineage(kept)
    left = {r[0] for r in fresh.select(by).distinct().collect()}  # at most ``names``
    fresh.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for name in names:
        if name not in left:
            folder = jvm.org.apache.hadoop.fs.Path(f"{path}/{by}={name}")
            folder.getFileSystem(conf).delete(folder, True)


def delete_where(spark: SparkSession, path: str, pred: Column, by: str) -> int:
    """SK-3: delete by predicate from a table partitioned by ``by``; how many partitions were rewritten.

    Rows for which the predicate is null stay. Only partitions that hold a row
    to delete are read again and written.
    """
    table, gone = spark.read.parquet(path), F.coalesce(pred, F.lit(False))
    names = [r[0] for r in table.where(gone).select(by).distinct().collect()]  # partitions, not rows
    if names:
        rewrite_partitions(spark, path, by, names, table.where(F.col(by).isin(names) & ~gone))
    return len(names)


def upsert(spark: SparkSession, path: str, delta: DataFrame, key: str, ts: str, cols: Sequence[str],
           deleted: str = "is_deleted", buckets: int = 64) -> None:
    """SK-4: merge override rows into the table at ``path``, partitioned by a hash bucket of the key.

    Rows merge as :func:`ledgerly.operators.joins.merge_overrides` says; only
    the buckets of the delta's keys are read and written. The same delta again
    changes nothing.
    """
    place = F.expr(f"cast(pmod(xxhash64(`{key}`), {buckets}) as int)")
    delta = cut_lineage(delta.select(key, ts, deleted, *cols))
    names = [r[0] for r in delta.select(place.alias("bucket")).distinct().collect()]  # at most ``buckets``
    if not names:
        return
    held = read_or_empty(spark, path, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in delta.schema) + ", bucket int")
    merged = merge_overrides(held.where(F.col("bucket").isin(names)), delta, key, ts, cols, deleted)
    rewrite_partitions(spark, path, "bucket", names, merged.withColumn("bucket", place))
