"""Join operators whose plan shape is chosen by hand (JN-4, 5, 6, 9, 10, 11,
12, 13, 14, 15, 16, 17, 18, 19, 20).

Plain equi-joins are left to Catalyst; the functions here exist where the
reference's form (correlated subquery, text containment, nearest match,
range match) would otherwise become a nested loop or an all-pairs group.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StringType

from ledgerly.functions import text as T
from ledgerly.operators.common import checked_broadcast, fits_broadcast
from ledgerly.session import stage


def with_exists(a: DataFrame, b: DataFrame, on: Sequence[str], flag: str) -> DataFrame:
    """JN-6 / JN-15: boolean column telling whether any row of ``b`` shares ``on``.

    ``b`` is reduced to its distinct keys first, so the join never fans out.
    """
    keys = b.select(*on).distinct().withColumn(flag, F.lit(True))
    return a.join(keys, list(on), "left").withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


# Bits of the filter that another table's keys make (log 2): sixteen a key, 32 MB at most; and those of one row of it.
FILTER_BITS, ROW_BITS = 28, 15


def may_meet(df: DataFrame, other: DataFrame, on: Sequence[str], rows: int | None = None, flag: str = "__may") -> DataFrame:
    """``df`` with a flag that is false only where no row of ``other`` has the row's ``on`` (nulls meet nothing).

    The keys' hashes set bits of a bitmap of bounded size, which is broadcast: a
    true flag promises nothing, an exact join follows, which rows that meet
    nothing need not be shuffled for. ``rows``: about how many ``other`` has, at
    most; counted where not given.
    """
    on = list(on)
    if any(df.schema[k].dataType.simpleString() != other.schema[k].dataType.simpleString() for k in on):
        return df.withColumn(flag, F.lit(True))  # equal values of two types differ in their hashes
    rows = other.count() if rows is None else rows
    place = F.pmod(F.xxhash64(*on), F.lit(1 << min(max((16 * rows).bit_length(), ROW_BITS), FILTER_BITS)))
    known = F.forall(F.array(*[F.col(k).isNotNull() for k in on]), lambda x: x)
    bits = other.select(*on).where(known).select(place.alias("__place")) \
        .groupBy(F.shiftright("__place", ROW_BITS).alias("__row")) \
        .agg(F.bitmap_construct_agg(F.col("__place").bitwiseAND(F.lit((1 << ROW_BITS) - 1))).alias("__bits"))
    at = f"(__place & {(1 << ROW_BITS) - 1})"
    bit = F.expr(f"(cast(conv(hex(substring(__bits, cast({at} div 8 as int) + 1, 1)), 16, 10) as int) >> cast({at} % 8 as int)) & 1 = 1")
    marked = df.withColumn("__place", place).withColumn("__row", F.shiftright("__place", ROW_BITS)).join(F.broadcast(bits), "__row", "left")
    return marked.select(*df.columns, (known & F.coalesce(bit, F.lit(False))).alias(flag))


def _flagged(marked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows that may meet, rows that meet nothing) of what :func:`may_meet` has marked."""
    return marked.where("__may").drop("__may"), marked.where("not __may").drop("__may")


def left_join_met(a: DataFrame, b: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join of which only those rows of ``a`` are shuffled that may meet a row of ``b``; for a ``b`` that few rows meet."""
    met, rest = _flagged(may_meet(a, b, on))
    return met.join(b, list(on), "left").unionByName(rest, allowMissingColumns=True)


def unused_flagged(items: DataFrame, key: str | Sequence[str], used: Column) -> DataFrame:
    """JN-9 / ST-2 where the rows themselves tell whether they are used: rows whose key no row uses.

    Same result as :func:`unused` with the used rows filtered out of ``items``,
    in one pass: one shuffle on the key, which must be near unique. A null key
    never survives; a null flag is no use.
    """
    keys = [key] if isinstance(key, str) else list(key)
    flag = F.bool_or(F.coalesce(used, F.lit(False))).over(Window.partitionBy(*keys))
    return items.dropna(subset=keys).withColumn("__used", flag).where(~F.col("__used")).drop("__used")


def unused(items: DataFrame, key: str | Sequence[str], *used: DataFrame) -> DataFrame:
    """JN-9 / ST-2: rows of ``items`` whose key is in none of ``used``.

    Like ``NOT IN`` (N5), a null key never survives. The used keys are a stage
    table. Rows that meet none of them by :func:`may_meet` are unused as they
    are; of the others only the keys are compared with the used ones, and the
    rows of the few that none uses follow.
    """
    keys = [key] if isinstance(key, str) else list(key)
    nn = None
    for k in keys:
        t = F.col(k).isNotNull()
        nn = t if nn is None else nn & t
    u = None
    for x in used:
        x = x.select(*keys).where(nn)
        u = x if u is None else u.unionByName(x)
    base = items.where(nn)
    if u is None:
        return base
    u = stage(u)
    met, rest = _flagged(may_meet(base, u, keys))
    left = stage(met.select(*keys).distinct().join(u.distinct(), keys, "left_anti"))
    return rest.unionByName(_flagged(may_meet(met, left, keys))[0].join(left, keys, "left_semi"))


def lookup_one(a: DataFrame, b: DataFrame, a_key: str, b_key: str, col: str,
               order: Column | None = None, out: str | None = None) -> DataFrame:
    """JN-11 / AG-1: one value of ``b`` per key (lowest ``order``, else lowest
    value), left-joined to ``a``. ``b`` is deduplicated with ``min_by`` first."""
    order = order if order is not None else F.col(col)
    one = b.groupBy(F.col(b_key).alias("__k")).agg(F.min_by(F.col(col), order).alias(out or col))
    return a.join(one, F.col(a_key) == F.col("__k"), "left").drop("__k")


def nearest(a: DataFrame, b: DataFrame, on: Sequence[str], a_date: str, b_date: str,
            b_cols: Sequence[str], b_order: str, apart: str | None = None) -> DataFrame:
    """JN-10: as-of join, nearest in either direction.

    For each row of ``a``, the row of ``b`` with the same ``on`` whose
    ``b_date`` is closest to ``a_date``; ties go to the earlier date, then to
    the lowest ``b_order``. Adds ``b_cols`` and ``nearest_days`` (null when
    ``b`` has no row for the key). With ``apart`` (a unit of ``trunc``, say
    MM) rows of ``a`` are left out that have a row of ``b`` with the same ``on``
    in the same period (JN-9, which then needs no join of its own): it is the
    one before or the one after, if there is any.

    Plan: ``b`` is reduced to one row per key that holds its distinct days in
    order, at most one per calendar day even where a key has a third of all
    rows. A row of ``a`` meets its key's row by plain equality and finds its
    place among the days by halving: ``a`` is shuffled once, by the key alone,
    and no pairs within a key are formed.
    """
    on = list(on)
    best = F.min(F.struct(F.col(b_order).alias("__o"),
                          *[F.col(c).alias(c) for c in b_cols]))
    known = F.forall(F.array(*[F.col(k).isNotNull() for k in on]), lambda x: x) & F.col("__d").isNotNull()  # null keys never match (N4)
    days = (b.select(*on, F.to_date(b_date).alias("__d"), b_order, *b_cols).where(known)
             .groupBy(*on, "__d").agg(best.alias("__b"))
             .groupBy(*on).agg(F.array_sort(F.collect_list(F.struct(F.col("__d").alias("d"), F.col("__b").alias("b")))).alias("__days")))
    u = a.withColumn("__qd", F.to_date(a_date)).join(days, on, "left")

    def halved(s: Column, _: Column) -> Column:
        mid = F.shiftright(s["lo"] + s["hi"], 1)
        after = F.get("__days", mid)["d"] <= F.col("__qd")
        return F.when(s["lo"] >= s["hi"], s).when(after, F.struct((mid + 1).alias("lo"), s["hi"].alias("hi"))) \
                .otherwise(F.struct(s["lo"].alias("lo"), mid.alias("hi")))

    # how many of the days are not after the row's own
    n = F.aggregate(F.sequence(F.lit(1), F.length(F.bin(F.size("__days")))),
                    F.struct(F.lit(0).alias("lo"), F.size("__days").alias("hi")), halved, lambda s: s["lo"])
    n = F.when(F.col("__qd").isNotNull() & F.col("__days").isNotNull(), n)
    found = F.transform(F.array(n), lambda n: F.struct(F.get("__days", n - 1).alias("prev"), F.get("__days", n).alias("next")))
    if apart:
        same = lambda c: F.coalesce(F.trunc(c["d"], apart) == F.trunc("__qd", apart), F.lit(False))
        found = F.filter(found, lambda x: ~(same(x["prev"]) | same(x["next"])))
    # exploded, the one element is made once, however often it is read, and a row without one is left out
    u = u.withColumn("__x", F.explode(found))
    prev, after = F.col("__x.prev"), F.col("__x.next")
    dp = F.datediff("__qd", prev["d"])
    dn = F.datediff(after["d"], "__qd")
    pick = F.when(prev.isNull(), after).when(after.isNull(), prev).when(dp <= dn, prev).otherwise(after)
    u = u.withColumn("__p", pick)
    return u.select(*on, *[c for c in a.columns if c not in on], *[F.col("__p.b")[c].alias(c) for c in b_cols],
                    F.abs(F.datediff(F.col("__p.d"), F.col("__qd"))).alias("nearest_days"))


def _sortable(v):
    """A value of any column type as Python can compare it, in Spark's order (nulls first)."""
    if v is None:
        return (0,)
    return (1, tuple(map(_sortable, v.values())) if isinstance(v, dict) else v)


class _Sweep:
    """Turns the ranges of one key, fed by rising start, into disjoint segments.

    Only the ranges that are open at the current day are held: a heap with the
    lowest ordinal on top, cleared of ended ranges when they come up.
    """

    def __init__(self):
        self.heap: list[tuple] = []      # (place in the order, end, number, values)
        self.segments: list[tuple] = []  # (first day, number of the range that wins, or None, its values)
        self.number = 0

    def _show(self, day: int) -> None:
        number, values = self.heap[0][2:] if self.heap else (None, None)
        if self.segments and self.segments[-1][0] == day:
            self.segments.pop()
        if (self.segments[-1][1] if self.segments else None) != number:
            self.segments.append((day, number, values))

    def upto(self, day: int) -> None:
        """Close the ranges that end before ``day``."""
        while self.heap and self.heap[0][1] < day:
            ended = self.heap[0][1]
            while self.heap and self.heap[0][1] <= ended:
                heapq.heappop(self.heap)
            self._show(ended + 1)

    def add(self, start: int, end: int, values: tuple) -> None:
        """``values``: the ordinal first."""
        self.upto(start)
        self.number += 1
        heapq.heappush(self.heap, (_sortable(values[0]), end, self.number, values))
        self._show(start)


#: Days that no date reaches: an open start and an open end.
FIRST_DAY, LAST_DAY = -(1 << 31), (1 << 31) - 1


def disjoint_ranges(ranges: DataFrame, keys: Sequence[str], start: str, end: str, ordinal: str, cols: Sequence[str]) -> DataFrame:
    """Overlapping ranges of days -> for each key the days on which the winner changes.

    One row per change: ``keys``, ``__from`` (first day, as days since 1970),
    ``ordinal`` and ``cols`` of the range with the lowest ordinal from that day
    on, null where no range is open. Starts and ends are days since 1970, ends
    included; ranges that end before they start are none. The ranges are
    shuffled once by key and sorted by start; a key's open ranges are held, not
    its rows.
    """
    keys, cols = list(keys), list(cols)
    kept = ranges.select(*keys, F.col(start).alias("__s"), F.col(end).alias("__e"), F.col(ordinal).alias(ordinal), *cols) \
        .where((F.col("__s") <= F.col("__e")) & F.col(ordinal).isNotNull())
    schema = kept.select(*keys, F.col("__s").alias("__from"), ordinal, *cols).schema

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, now, held = None, _Sweep(), []

        def ended() -> None:
            now.upto(LAST_DAY)
            held.extend((*key, day, *(values or (None,) * (len(cols) + 1))) for day, _, values in now.segments)

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                own, (s, e), values = row[:len(keys)], row[len(keys):len(keys) + 2], row[len(keys) + 2:]
                if own != key:
                    if key is not None:
                        ended()
                    key, now = own, _Sweep()
                now.add(s, e, values)
            if len(held) > 10_000:
                yield _rows(held, schema)
                held = []
        if key is not None:
            ended()
        if held:
            yield _rows(held, schema)

    return kept.repartition(*keys).sortWithinPartitions(*keys, "__s", ordinal).mapInArrow(sweep, schema)


def _rows(rows: list[tuple], schema) -> pa.RecordBatch:
    kinds = to_arrow_schema(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), kinds)], schema=kinds)


def effective_lookup(facts: DataFrame, costs: DataFrame, fact_code: str, fact_text: str,
                     fact_date: str, cost_code: str, cost_text: str, start: str, end: str,
                     ordinal: str, cost_cols: Sequence[str], default_start: str | None = None) -> DataFrame:
    """JN-12: effective-dated lookup with two match rules.

    A cost row matches a fact when its code equals the fact's code once
    spaces around it and leading zeros are dropped, **or** its text equals the
    fact's text, both in lower case with runs of spaces collapsed (accents
    count; null and empty codes and texts match nothing), and the fact's date
    is within ``[start, end]`` (an open start begins at ``default_start``, if
    one is given). The cost row with the lowest ``ordinal`` wins. Adds
    ``cost_ordinal`` and ``cost_cols``.

    Plan: the ranges of each match key become disjoint segments
    (:func:`disjoint_ranges`) and then one row per key that holds them in
    order, so a fact meets one row for its code and one for its text, by plain
    equality, and looks its day up in it: no range condition, no fan-out, and
    a popular product's facts can be split wherever they are too many. Facts are
    never sorted: the keys' rows are the hashed side of either join.
    """
    def ncode(c):
        return F.nullif(F.regexp_replace(F.trim(F.col(c).cast("string")), "^0+", ""), F.lit(""))

    def ntext(c):
        return F.nullif(F.lower(T.squeeze_spaces(F.col(c))), F.lit(""))

    cols = list(cost_cols)
    opens = F.lit(FIRST_DAY) if default_start is None else F.unix_date(F.lit(default_start).cast("date"))
    ranges = costs.select(
        F.explode(F.array(F.struct(F.lit("c").alias("k"), ncode(cost_code).alias("m")),
                          F.struct(F.lit("t").alias("k"), ntext(cost_text).alias("m")))).alias("__x"),
        F.coalesce(F.unix_date(F.to_date(start)), opens).alias("__s"),
        F.coalesce(F.unix_date(F.to_date(end)), F.lit(LAST_DAY)).alias("__e"), F.col(ordinal).alias("__ord"), *cols) \
        .select(F.col("__x.k").alias("__kind"), F.col("__x.m").alias("__m"), "__s", "__e", "__ord", *cols).where(F.col("__m").isNotNull())
    # equal ranges of one key collapse to their lowest ordinal before anything is sorted
    ranges = ranges.groupBy("__kind", "__m", "__s", "__e").agg(F.min(F.struct("__ord", *cols)).alias("__w")) \
        .select("__kind", "__m", "__s", "__e", "__w.*")
    segments = disjoint_ranges(ranges, ["__kind", "__m"], "__s", "__e", "__ord", cols)
    by_key = stage(segments.groupBy("__kind", "__m").agg(
        F.array_sort(F.collect_list(F.struct("__from", "__ord", *cols))).alias("__segs")))
    out = facts.withColumn("__code", ncode(fact_code)).withColumn("__text", ntext(fact_text)) \
               .withColumn("__d", F.unix_date(F.to_date(fact_date)))
    for kind, key in (("c", "__code"), ("t", "__text")):
        side = by_key.where(F.col("__kind") == kind).select(F.col("__m").alias(key), F.col("__segs").alias(f"__{kind}"))
        # the codes may be many and the texts few; facts of a few hot texts must not be sorted into a few tasks
        out = out.join(F.broadcast(side) if fits_broadcast(side, max_rows=100_000) else side.hint("shuffle_hash"), key, "left")
        past = F.filter(f"__{kind}", lambda x: x["__from"] <= F.col("__d"))
        hit = F.try_element_at(past, F.lit(-1))
        out = out.withColumn(f"__{kind}", F.when(hit["__ord"].isNotNull(), F.struct(hit["__ord"].alias("__ord"), *[hit[c].alias(c) for c in cols])))
    first = F.when(F.col("__t").isNull() | (F.col("__c.__ord") <= F.col("__t.__ord")), F.col("__c")).otherwise(F.col("__t"))
    out = out.withColumn("__win", first)
    return out.select(*[F.col(c) for c in facts.columns], F.col("__win.__ord").alias("cost_ordinal"), *[F.col(f"__win.{c}").alias(c) for c in cols])


def apply_overrides(base: DataFrame, ov: DataFrame, key: str, fields: dict[str, str],
                    deleted: str, manual: str, manual_rows: DataFrame | None = None) -> DataFrame:
    """JN-13: overlay an override table on base rows.

    ``fields`` maps base column -> override column; a non-null override value
    replaces the base value; rows whose override is a tombstone are dropped;
    manual override rows (no base row) are appended via ``manual_rows``. A
    repeated override key counts once (its largest row), so base rows never
    fan out; ``merge_overrides`` gives one row per key.
    """
    o = ov.where(~F.coalesce(F.col(manual), F.lit(False)))
    o = o.groupBy(F.col(key).alias("__ok")).agg(F.max(F.struct(
        F.col(deleted).alias("__del"), *[F.col(v).alias(f"__ov_{k}") for k, v in fields.items()])).alias("__o")) \
        .select("__ok", "__o.*")
    j = base.join(o, base[key] == F.col("__ok"), "left")
    for k in fields:
        j = j.withColumn(k, F.coalesce(F.col(f"__ov_{k}"), F.col(k)))
    j = j.where(~F.coalesce(F.col("__del"), F.lit(False)))
    j = j.drop("__ok", "__del", *[f"__ov_{k}" for k in fields])
    if manual_rows is not None:
        j = j.unionByName(manual_rows, allowMissingColumns=True)
    return j


def merge_overrides(current: DataFrame, delta: DataFrame, key: str, ts: str,
                    cols: Sequence[str], deleted: str = "is_deleted") -> DataFrame:
    """SK-4: upsert override rows by key; the latest ``ts`` wins as a whole row.

    An edit replaces every column, so it can clear one. A tombstone
    (``deleted`` true) carries few columns: those of the latest version that
    was no tombstone stay. Of two versions of one time the delta's counts, so
    the same delta again changes nothing. One shuffle on the key.
    """
    new = F.lit(True).alias("__new")
    u = current.select(key, ts, deleted, *cols, ~new).toDF(key, ts, deleted, *cols, "__new") \
        .unionByName(delta.select(key, ts, deleted, *cols, new))
    live = ~F.coalesce(F.col(deleted), F.lit(False))
    # a tombstone's columns are those of what it buried, which the current rows keep
    row = F.max_by(F.struct(*cols), F.struct(live, F.col(ts), F.col("__new") == live)).alias("__row")
    u = u.groupBy(key).agg(row, F.max_by(F.col(deleted), F.struct(ts, "__new")).alias(deleted), F.max(ts).alias(ts))
    return u.select(key, *[F.col("__row")[c].alias(c) for c in cols], deleted, ts)


# Lengths of the substrings that key short texts, longest first.
GRAMS = (8, 5, 3, 2, 1)
# Candidate keys of one pattern, and letters of a neighbouring word that a key of three-word patterns takes.
CANDIDATES, EDGE = 8, 3
# Texts of one key that meet its patterns in one task.
SPLIT = 200_000

# A token pair starting at a token boundary (overlapping matches).
PAIR_RE = r"(?<![^ ])(?=([^ ]+ [^ ]+))"


def _grams(text: Column, k: int) -> Column:
    return F.regexp_extract_all(text, F.lit("(?s)(?=(.{%d}))" % k), 1)


def _spread(keys: Column, n: int) -> Column:
    """``n`` of the keys, the first, the last and evenly between: where all patterns begin alike, their ends differ."""
    size = F.size(keys)
    picked = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.get(keys, F.floor(i * (size - 1) / F.lit(n - 1)).cast("int")))
    return F.when(size <= n, keys).otherwise(picked)


def _tagged(tag: str, keys: Column) -> Column:
    return F.transform(keys, lambda k: F.concat(F.lit(tag), k))


def _pattern_keys(text: Column, words: Column) -> Column:
    """Keys that every text holding the pattern must emit, at most ``CANDIDATES``, tagged by kind."""
    n = F.size(words)
    interior = F.slice(words, 2, n - 2)
    pairs = F.transform(F.sequence(F.lit(1), F.size(interior) - 1),
                        lambda i: F.concat_ws(" ", F.try_element_at(interior, i), F.try_element_at(interior, i + 1)))
    longest = F.slice(F.sort_array(F.transform(F.array_distinct(pairs), lambda p: F.struct(F.length(p).alias("n"), p.alias("p"))), False), 1, CANDIDATES)
    first, middle, last = (F.try_element_at(words, F.lit(i)) for i in (1, 2, 3))
    three = F.filter(F.array(
        F.concat(F.lit("w"), middle),
        F.when(F.length(last) >= EDGE, F.concat(F.lit("f"), middle, F.lit(" "), F.left(last, F.lit(EDGE)))),
        F.when(F.length(first) >= EDGE, F.concat(F.lit("s"), F.right(first, F.lit(EDGE)), F.lit(" "), middle))), lambda k: k.isNotNull())
    short = None
    for k in GRAMS:
        # the keys are made once and bound to a name, however often they are read
        own = F.get(F.transform(F.array(F.array_distinct(_tagged(str(k), _grams(text, k)))), lambda keys: _spread(keys, CANDIDATES)), 0)
        short = F.when(F.length(text) >= k, own) if short is None else short.when(F.length(text) >= k, own)
    return F.when(n >= 4, F.transform(longest, lambda x: F.concat(F.lit("p"), x["p"]))).when(n == 3, three).otherwise(short)


def _text_keys(text: Column, kinds: Sequence[str]) -> Column:
    """All distinct keys of the kinds in use that a text emits."""
    cut = lambda p: F.instr(p, " ")

    def emitted(pairs: Column) -> Column:
        emit = {"p": lambda: _tagged("p", pairs), "w": lambda: _tagged("w", F.split(text, " ")),
                "f": lambda: F.transform(pairs, lambda p: F.concat(F.lit("f"), F.left(p, cut(p) + EDGE))),
                "s": lambda: F.transform(pairs, lambda p: F.concat(F.lit("s"), F.right(F.left(p, cut(p) - 1), F.lit(EDGE)), F.substr(p, cut(p))))}
        return F.array_distinct(F.concat(*[emit[k]() if k in emit else _tagged(k, _grams(text, int(k))) for k in kinds]))
    if not {"p", "f", "s"} & set(kinds):
        return emitted(F.lit(None))
    # the pairs are found once and bound to a name, whichever kinds read them
    return F.get(F.transform(F.array(F.regexp_extract_all(text, F.lit(PAIR_RE), 1)), emitted), 0)


def contains_join(a: DataFrame, a_id: str, a_text: str, b: DataFrame, b_id: str, b_text: str, split: int = SPLIT) -> DataFrame:
    """JN-5: pairs ``(a_id, b_id)`` where b's folded text is a substring of a's
    folded text (lower case, whitespace runs collapsed) — plain substring
    semantics, like ``ILIKE '%' || b || '%'``.

    Plan (all equi-joins, exact). A pattern has a few candidate keys that every
    text holding it must show:

    * four or more words: its interior words sit between two spaces, so two
      adjacent ones are adjacent tokens of the text; its longest such pairs;
    * three words: the middle word, alone and with the next word's first or the
      last word's letters before it;
    * one or two words: substrings of one length, from the first to the last.

    Texts emit only keys that some pattern has as a candidate (a semi join, a
    broadcast one where the candidates are few, else behind :func:`may_meet`:
    a text has far more keys than patterns ask for). Each pattern is then keyed by
    the candidate that the fewest **texts** show; a pattern with a candidate
    that no text shows matches nothing and drops out. A key that is still
    shown by more than ``split`` texts is salted: its texts are dealt to
    several parts by hash, its patterns go to each. Candidates carry ids only
    and are verified with ``contains`` on the whole texts, which are joined
    back once; nothing is truncated. Ids that are texts travel as their hash:
    texts that share one are all verified.
    """
    hashed = isinstance(a.schema[a_id].dataType, StringType)
    raw = a.select(F.col(a_id).alias("__id"), (F.xxhash64(a_id) if hashed else F.col(a_id)).alias("__a"), F.col(a_text).alias("__raw")) \
        .where(F.col(a_id).isNotNull())
    fa = raw.select("__a", T.fold_spaces("__raw").alias("__fa"))
    fb = stage(b.select(F.col(b_id).alias("__b"), T.fold_spaces(b_text).alias("__fb")).where(F.length("__fb") > 0)
                     .withColumn("__keys", _pattern_keys(F.col("__fb"), F.split("__fb", " "))))
    cands = fb.select("__b", F.explode("__keys").alias("__key"))
    kinds = sorted(r.k for r in cands.select(F.left("__key", F.lit(1)).alias("k")).distinct().collect())  # at most nine
    if not kinds:
        return a.sparkSession.createDataFrame([], f"{a_id} {a.schema[a_id].dataType.simpleString()}, "
                                                  f"{b_id} {b.schema[b_id].dataType.simpleString()}")
    wanted = cands.select("__key").distinct()
    emitted = fa.select("__a", F.explode(_text_keys(F.col("__fa"), kinds)).alias("__key"))
    if fits_broadcast(wanted, max_rows=100_000):
        wanted = F.broadcast(wanted)
    else:
        emitted = may_meet(emitted, wanted, ["__key"]).where("__may").drop("__may")
    shown = stage(emitted.join(wanted, "__key", "left_semi"))
    often = shown.groupBy("__key").agg(F.count(F.lit(1)).alias("__n"))
    best = F.min(F.struct(F.coalesce("__n", F.lit(0)).alias("n"), F.col("__key").alias("key")))
    chosen = cands.join(often, "__key", "left").groupBy("__b").agg(best.alias("__best")).where("__best.n > 0") \
        .select("__b", F.col("__best.key").alias("__key"), F.ceil(F.col("__best.n") / split).cast("int").alias("__parts"))
    hot = checked_broadcast(often.where(F.col("__n") > split).select("__key", F.ceil(F.col("__n") / split).cast("int").alias("__hot")))
    dealt = shown.join(hot, "__key", "left").withColumn("__part", F.expr("cast(pmod(xxhash64(__a), coalesce(__hot, 1)) as int)"))
    keyed = chosen.withColumn("__part", F.explode(F.sequence(F.lit(0), F.col("__parts") - 1)))
    cand = dealt.join(keyed, ["__key", "__part"]).select("__a", "__b")
    cand = cand.distinct() if hashed else cand
    # verification folds only the candidate texts (joined back by id)
    hits = cand.join(raw, "__a").join(fb.select("__b", "__fb"), "__b") \
               .where(F.contains(T.fold_spaces("__raw"), F.col("__fb"))).select("__id", "__b")
    return hits.select(F.col("__id").alias(a_id), F.col("__b").alias(b_id))


def fuzzy_contains(a: DataFrame, a_name: str, b: DataFrame, b_name: str) -> DataFrame:
    """JN-14: two-way containment of accent- and case-folded names.

    One plan at every size: both sides are reduced to their distinct folded
    names, the keyed containment join finds candidate pairs of names in both
    directions, the names themselves are compared as they are (inner spaces
    count), and the pairs join back to the rows of either side. Null and empty
    names never match; repeated rows keep their repeats.
    """
    fa = a.select(T.norm_name(a_name).alias("__na"), F.struct(*a.columns).alias("__ra"))
    fb = b.select(T.norm_name(b_name).alias("__nb"), F.struct(*b.columns).alias("__rb"))
    xa = fa.select("__na").where(F.length("__na") > 0).distinct()
    xb = fb.select("__nb").where(F.length("__nb") > 0).distinct()
    # contains_join collapses runs of spaces, so it finds at least every pair that contains as it is
    pairs = contains_join(xa, "__na", "__na", xb, "__nb", "__nb").unionByName(
        contains_join(xb, "__nb", "__nb", xa, "__na", "__na").select("__na", "__nb")).distinct()
    pairs = pairs.where(F.contains(F.col("__na"), F.col("__nb")) | F.contains(F.col("__nb"), F.col("__na")))
    return fa.join(pairs, "__na").join(fb, "__nb").select("__ra.*", "__rb.*")


def month_spine(df: DataFrame, end_month, n: int, keys_df: DataFrame | None = None) -> DataFrame:
    """JN-17: the ``n`` months ending at ``end_month`` (optionally times each
    key of ``keys_df``) left-joined to ``df`` on ``month``; missing months
    are filled by the caller with ``coalesce(.., 0)``."""
    end = F.trunc(F.lit(end_month).cast("date"), "MM")
    seq = F.explode(F.sequence(F.add_months(end, -(n - 1)), end, F.expr("interval 1 month")))
    if keys_df is None:
        base = df.sparkSession.range(1).select(seq.alias("month"))
        on = ["month"]
    else:
        # each key row carries its own n months: no cross join
        base = keys_df.select("*", seq.alias("month"))
        on = ["month"] + list(keys_df.columns)
    return base.join(df, on, "left")


# The date and time tokens a sale line may carry (overlapping matches).
DATE_TOKEN_RE = r"(?=(\d{2}/\d{2}/\d{4}))"
TIME_TOKEN_RE = r"(?=(\d{2}:\d{2}))"


def match_payments(bookings: DataFrame, items: DataFrame, pays: DataFrame, b_id: str, b_cust: str, b_date: str,
                   b_time: str, i_key: str, i_cust: str, i_text: str, i_paydate: str, i_value: str,
                   p_booking: str, p_date: str, p_amount: str) -> DataFrame:
    """JN-4: (booking, item) pairs of the same customer where the item text
    holds the booking's ``dd/mm/yyyy`` date **and** its ``HH:MM`` time, **or**
    a payment row of the booking has the item's pay date and amount.

    Plan: instead of testing every booking of a customer against every item
    (``LIKE`` under ``OR``), both ways become keys of one equi-join. An item
    gives a key for every date and time token of its text (overlapping
    matches, so containment is exact) and one for its pay date and amount; a
    booking gives its own date and time, each of its payments, with the
    booking's customer, its date and amount. Items are read once, and of their
    keys only those are shuffled that some booking may have (:func:`may_meet`).
    Amounts meet as doubles, whatever their scale. The result is distinct.
    """
    def key(kind: str, day=None, time=None, paid=None, amount=None) -> Column:
        return F.struct(F.lit(kind).alias("k"), *[(F.lit(None) if c is None else c).cast(t).alias(n) for n, c, t in (
            ("d", day, "string"), ("t", time, "string"), ("p", paid, "timestamp"), ("a", amount, "double"))])

    b = bookings.select(F.col(b_id).alias("__b"), F.col(b_cust).alias("__c"),
                        F.date_format(F.col(b_date), "dd/MM/yyyy").alias("__dt"), F.col(b_time).alias("__tm"))
    paid = pays.select(F.col(p_booking).alias("__b"), F.col(p_date).alias("__pd"), F.col(p_amount).alias("__v")) \
               .dropna().join(b.select("__b", "__c"), "__b")
    asked = b.dropna(subset=["__dt", "__tm"]).select("__b", "__c", key("text", F.col("__dt"), F.col("__tm")).alias("__key")) \
        .unionByName(paid.select("__b", "__c", key("pay", paid=F.col("__pd"), amount=F.col("__v")).alias("__key")))
    tokens = lambda pattern: F.array_distinct(F.regexp_extract_all(F.coalesce(F.col(i_text), F.lit("")), F.lit(pattern), 1))
    texts = F.flatten(F.transform(tokens(DATE_TOKEN_RE), lambda d: F.transform(tokens(TIME_TOKEN_RE), lambda t: key("text", d, t))))
    none = F.array().cast("array<struct<k:string,d:string,t:string,p:timestamp,a:double>>")
    # few texts hold both a date and a time
    texts = F.when(F.contains(F.col(i_text), F.lit("/")) & F.contains(F.col(i_text), F.lit(":")), texts).otherwise(none)
    money = F.when(F.col(i_paydate).isNotNull() & F.col(i_value).isNotNull(), F.array(key("pay", paid=F.col(i_paydate), amount=F.col(i_value)))) \
        .otherwise(none)
    shown = items.select(F.col(i_key).alias("__i"), F.col(i_cust).alias("__c"), F.explode(F.concat(texts, money)).alias("__key"))
    shown = may_meet(shown, asked, ["__c", "__key"], bookings.count() + pays.count()).where("__may").drop("__may")
    return shown.join(asked, ["__c", "__key"]).select("__b", "__i", "__c").distinct() \
                .select(F.col("__b").alias(b_id), F.col("__i").alias(i_key), F.col("__c").alias(i_cust))
