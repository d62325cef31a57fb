"""Mixing sources to target weights by weighted sampling without replacement (DataFrame functions only).

Efraimidis and Spirakis: a row of weight w gets the key -ln(u) / w with u
uniform; taking rows by ascending key draws them one by one in proportion to
their weights. Whole epochs of a source come first. What is left of its budget
is filled in rounds: rows go by ascending key while they fit, and a row that
does not fit is passed over for those behind it that do; at last, one row more
if that brings the source closer to its target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerly.llm.common import row_key, word_count, written

#: Keys are dealt to this many ranges per source, of about as many rows each; only the one range that a budget ends in is sorted.
RANGES = 1024
#: Coarse steps that a row's range is looked up in before the fine ones.
COARSE = 32
#: Rounds of filling: all rows, those that fit the rest, and two more passes over those, for sources whose long rows do not fit.
ROUNDS = 4
#: Fixed value: punctuation and digits that lower a document's quality weight.
NOISE = r"[!-@\[-`{-~]"


def uniform(seed: int, *parts: Column) -> Column:
    """A number in (0, 1) fixed by the seed and the parts: 52 bits of their MD5."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(p.cast("string"), F.lit("-")) for p in parts])
    return (F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def quality_weight(text: Column) -> Column:
    """Share of the characters that are no punctuation and no digits, at least 0.05; 1 for an empty text."""
    t = F.coalesce(text, F.lit(""))
    share = F.length(F.regexp_replace(t, NOISE, "")) / F.length(t)
    return F.when(F.length(t) == 0, F.lit(1.0)).otherwise(F.greatest(share, F.lit(0.05)))


def targets(sizes: DataFrame, weights: list[float], max_epochs: float) -> DataFrame:
    """Adds ``target``: shares of all sizes by weight, capped at ``max_epochs`` times the source's size.

    What a capped source leaves is reshared by weight until none is above its
    cap. That end state gives every source min(cap, weight x level) for one
    level; with sources in ascending order of cap / weight, the level follows
    from two running sums. One row per source takes part.
    """
    by_name = W.orderBy("key")
    n = len(weights)
    place = (F.row_number().over(by_name) - 1) % n
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place + 1).cast("int"))
    s = sizes.withColumn("weight", weight).withColumn("cap", F.col("source_size") * float(max_epochs))
    by_ratio = W.orderBy(F.col("cap") / F.col("weight"), "key")
    whole = W.partitionBy()
    s = (s.withColumn("cap_before", F.sum("cap").over(by_ratio) - F.col("cap"))
         .withColumn("weight_left", F.sum("weight").over(whole) - F.sum("weight").over(by_ratio) + F.col("weight"))
         .withColumn("total", F.sum("source_size").over(whole).cast("double")))
    s = s.withColumn("level", (F.col("total") - F.col("cap_before")) / F.col("weight_left"))
    fits = F.col("level") <= F.col("cap") / F.col("weight")
    level = F.min(F.when(fits, F.struct(F.col("cap") / F.col("weight"), F.col("level").alias("level")))).over(whole)
    return s.withColumn("target", F.least("cap", F.col("weight") * F.coalesce(level["level"], F.lit(float("inf"))))) \
        .select("key", "source_size", "target")


def ranged(rows: DataFrame) -> DataFrame:
    """``rows`` with ``range``: their place among ``RANGES`` quantiles of the source's keys, so ranges are even for any weights."""
    shares = [k / RANGES for k in range(1, RANGES)]
    cuts = rows.groupBy("key").agg(F.percentile_approx("draw", shares, 20 * RANGES).alias("cuts"))
    step = RANGES // COARSE
    coarse = F.transform(F.sequence(F.lit(step - 1), F.lit(RANGES - 2), F.lit(step)), lambda k: F.get("cuts", k))
    cuts = written(cuts.withColumn("coarse", coarse), "cuts")
    below = lambda array: F.size(F.filter(array, lambda c: c < F.col("draw")))
    found = rows.join(cuts, "key").withColumn("step", below(F.col("coarse")) * step)
    return found.withColumn("range", F.col("step") + below(F.slice("cuts", F.col("step") + 1, F.lit(step)))).drop("cuts", "coarse", "step")


#: Order of the rows of a source; ``at`` tells repeated rows apart.
ORDER = ("draw", "none", "id", "size", "at")


def place() -> Column:
    return F.struct("range", *ORDER)


def fill(rows: DataFrame, state: DataFrame, max_epochs: int, number: int) -> tuple[DataFrame, DataFrame]:
    """One round: (rows with those taken counted in ``times``, state with what is then left of each budget).

    ``state``: key and ``rest``, a row per source. Rows that fit the rest and
    have epochs left (in the second round, also were not taken in the first)
    go by ascending key up to the first that is too much. Ranges below that
    one are taken by their sums, so one range per source is sorted, and all
    that the rows need to know is the last place taken.
    """
    open_rows = (F.col("size") > 0) & (F.col("size") <= F.col("rest")) & (F.col("times") < max_epochs)
    if number < 2:
        open_rows &= F.col("times") == F.col("epochs")
    if number == 0:
        open_rows = (F.col("size") > 0) & (F.col("times") < max_epochs)
    here = rows.join(state, "key").filter(open_rows).select("key", place().alias("place"), "rest")
    sums = here.groupBy("key", F.col("place.range").alias("range"), "rest").agg(F.sum("place.size").alias("sum"))
    upto = F.sum("sum").over(W.partitionBy("key").orderBy("range"))
    sums = written(sums.withColumn("upto", upto), f"ranges{number}")
    whole = sums.filter("upto <= rest").groupBy("key").agg(F.max("range").alias("full"), F.max("upto").alias("sure"))
    edges = written(sums.filter("upto > rest").groupBy("key").agg(F.min("range").alias("edge")).join(whole, "key", "full_outer"), f"edges{number}")
    within = F.sum("place.size").over(W.partitionBy("key").orderBy("place").rowsBetween(W.unboundedPreceding, 0))
    ends = (here.join(edges.select("key", "edge", F.coalesce("sure", F.lit(0)).alias("sure")), "key").filter("place.range = edge")
            .withColumn("upto", within + F.col("sure")).filter("upto <= rest")
            .groupBy("key").agg(F.max("place").alias("last"), F.max("upto").alias("more")))
    bounds = edges.join(ends, "key", "left").select(
        "key", F.coalesce("full", F.lit(-1)).alias("full"), "last", F.coalesce("more", "sure", F.lit(0)).alias("got"))
    bounds = written(state.join(bounds, "key", "left").withColumn("got", F.coalesce("got", F.lit(0))), f"bounds{number}")
    taken = open_rows & ((F.col("range") <= F.col("full")) | F.coalesce(place() <= F.col("last"), F.lit(False)))
    out = rows.join(bounds, "key").withColumn("times", F.col("times") + F.coalesce(taken, F.lit(False)).cast("int")).drop("rest", "full", "last", "got")
    return out, bounds.select("key", (F.col("rest") - F.col("got")).alias("rest"))


def top_up(rows: DataFrame, state: DataFrame, max_epochs: int) -> DataFrame:
    """One row more of each source, the one that comes closest to the rest of its budget, if that is closer than none."""
    off = F.abs(F.col("rest") - F.col("size"))
    best = (rows.join(state, "key").filter((F.col("size") > 0) & (F.col("times") < max_epochs) & (off < F.col("rest")))
            .groupBy("key").agg(F.min(F.struct(off.alias("off"), place().alias("place")))["place"].alias("best")))
    out = rows.join(written(best, "best"), "key", "left")
    return out.withColumn("times", F.col("times") + F.coalesce(place() == F.col("best"), F.lit(False)).cast("int")).drop("best")


def mix(docs: DataFrame, weights: list[float] = (1.0, 2.0, 3.0), max_epochs: float = 3.0, seed: int = 42,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", quality: Column | None = None) -> DataFrame:
    """One row per input row: id, source, row (a digest of id and text), size, source_size, target, epochs, selected, taken.

    Sizes are words. Sources in code-point order (null last) take the weights
    in turn. ``quality`` is a row's weight in the draw, for example a score
    of the quality classifier (at least 0.05 is taken; null counts as 1); without
    it, see ``quality_weight``. ``taken`` is size x (epochs + selected), at most
    ``max_epochs`` times the size, where ``epochs`` are whole passes over the
    source and ``selected`` how often the rounds of ``fill`` and ``top_up`` took
    the row beyond them. Null or empty texts have size 0 and take 0; ties of
    keys go by id, null ids last; repeated rows share a key and are taken one
    after another. A null source is a source of its own. Other columns are not
    read. An empty table gives no rows.
    """
    size = word_count(F.col(text_col))
    key = F.struct(F.col(source_col).isNull().alias("none"), F.coalesce(F.col(source_col), F.lit("")).alias("name"))
    weight = quality_weight(F.col(text_col)) if quality is None else F.greatest(F.coalesce(quality.cast("double"), F.lit(1.0)), F.lit(0.05))
    draw = -F.log(uniform(seed, F.col(id_col), F.col(source_col), size)) / weight
    rows = written(docs.select(F.col(id_col).alias("id"), F.col(id_col).isNull().alias("none"), row_key(F.col(id_col), F.col(text_col)).alias("row"),
                               key.alias("key"), size.alias("size"), draw.alias("draw"), F.monotonically_increasing_id().alias("at")), "sizes")
    sources = written(targets(rows.groupBy("key").agg(F.sum("size").alias("source_size")), list(weights), max_epochs), "targets")
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    state = sources.select("key", F.least(epochs, F.lit(int(max_epochs))).cast("int").alias("epochs"), "source_size", "target")
    rows = written(ranged(rows).join(state.select("key", "epochs"), "key").withColumn("times", F.col("epochs")), "ranged")
    rest = written(state.select("key", (F.col("target") - F.col("epochs") * F.col("source_size")).alias("rest")), "rest")
    for number in range(ROUNDS):
        rows, rest = fill(rows, rest, int(max_epochs), number)
    out = top_up(rows, rest, int(max_epochs)).join(sources, "key")
    return out.select(F.col("id").alias(id_col), F.when(~F.col("key.none"), F.col("key.name")).alias(source_col), "row", "size",
                      "source_size", "target", "epochs", (F.col("times") - F.col("epochs")).alias("selected"),
                      (F.col("size") * F.col("times")).cast("long").alias("taken"))


def take(docs: DataFrame, weights: list[float] = (1.0, 2.0, 3.0), max_epochs: float = 3.0, seed: int = 42,
         id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``docs`` as ``mix`` takes them: a row is repeated once for each epoch and left out where nothing of it is taken.

    Decisions come back to rows by the digest of id and text; repeated rows
    are numbered on both sides, so each gets one decision. Empty texts have no
    words to take and are left out.
    """
    number = F.row_number().over(W.partitionBy("row").orderBy(F.lit(0)))
    times = (F.col("epochs") + F.col("selected")) * (F.col("size") > 0).cast("int")
    chosen = (mix(docs, weights, max_epochs, seed, id_col, text_col, source_col).select("row", times.alias("times"))
              .withColumn("number", F.row_number().over(W.partitionBy("row").orderBy("times"))).filter("times > 0"))
    rows = docs.select(row_key(F.col(id_col), F.col(text_col)).alias("row"), F.struct("*").alias("doc")).withColumn("number", number)
    taken = rows.join(chosen, ["row", "number"]).withColumn("copy", F.explode(F.array_repeat(F.lit(1), F.col("times"))))
    return taken.select(*[F.col(f"doc.`{c}`") for c in docs.columns])
