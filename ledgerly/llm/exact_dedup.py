"""Exact dedup by deterministic block naming (DataFrame functions only).

A text is cut into blocks of a fixed number of characters. The distinct blocks
of all texts are sorted, by digest and then by the block itself, and their ranks
are their integer names. Then, round by
round, adjacent names are paired, the distinct pairs are sorted and named again,
until one name is left for each document. Two texts share (rounds, name) exactly
when they are equal: every name stands for one string, so nothing can collide.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerly.llm.common import collapse_ws, dense_names, written


def normalised(text: Column) -> Column:
    return collapse_ws(F.coalesce(text, F.lit("")))


def blocks_of(norm: Column, block_chars: int) -> Column:
    """The text cut every ``block_chars`` characters; an empty text is one empty block."""
    blocks = F.regexp_extract_all(norm, F.lit(f"(?s).{{1,{block_chars}}}"), F.lit(0))
    return F.when(F.size(blocks) == 0, F.array(F.lit(""))).otherwise(blocks)


#: From short to long; a longer one is used only when two different blocks share a shorter digest.
DIGESTS = (("md5", lambda c: F.unhex(F.md5(c))), ("sha256", lambda c: F.unhex(F.sha2(c, 256))),
           ("sha512", lambda c: F.unhex(F.sha2(c, 512))))


def block_names(docs: DataFrame, text_col: str, block_chars: int):
    """Names of all distinct blocks: (digest function, table of digest and name).

    The naming itself compares whole blocks; digests come first in the order
    only to deal the blocks out evenly, whatever they have in common. Rows find
    the name of their block by its digest, after a count has shown that no two
    blocks share one.
    """
    blocks = blocks_of(normalised(F.col(text_col)), block_chars)
    for label, digest in DIGESTS:
        distinct = docs.select(F.explode(blocks).alias("block")).distinct()
        names = dense_names(distinct.withColumn("digest", digest(F.col("block"))), ["digest"], ["block"], ["digest"], f"blocks-{label}")
        if names.groupBy("digest").count().filter("count > 1").isEmpty():
            return digest, names
    raise ValueError("different blocks share every digest")


def name_texts(docs: DataFrame, id_col: str, text_col: str, block_chars: int) -> DataFrame:
    """One row per input row: rid, id, sha256 of the normalised text, and the identity (rounds, name)."""
    digest, names = block_names(docs, text_col, block_chars)
    norm = normalised(F.col(text_col))
    rows = written(docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("id"),
                               F.sha2(norm, 256).alias("sha"), F.transform(blocks_of(norm, block_chars), digest).alias("digests")), "rows")
    longest = rows.agg(F.max(F.size("digests"))).first()[0] or 0
    rest = (rows.select("rid", F.size("digests").alias("n"), F.posexplode("digests").alias("pos", "digest"))
            .join(names, "digest").select("rid", "n", "pos", "name"))
    if longest > 1:
        rest = written(rest, "names")
    done = rest.filter("n = 1").select("rid", F.lit(0).alias("rounds"), "name")
    for k in range(1, math.ceil(math.log2(longest)) + 1 if longest > 1 else 1):
        rest = rest.filter("n > 1")
        even = F.col("pos") % 2 == 0
        pairs = (rest.groupBy("rid", "n", F.floor(F.col("pos") / 2).cast("int").alias("pos"))
                 .agg(F.max(F.when(even, F.col("name"))).alias("a"),
                      F.coalesce(F.max(F.when(~even, F.col("name"))), F.lit(-1)).alias("b")))
        pairs = written(pairs, f"pairs{k}")
        named = dense_names(pairs.select("a", "b").distinct(), ["a", "b"], [], ["a", "b"], f"names{k}")
        rest = written(pairs.join(named, ["a", "b"])
                       .select("rid", F.ceil(F.col("n") / 2).cast("int").alias("n"), "pos", "name"), f"round{k}")
        done = done.unionAll(rest.filter("n = 1").select("rid", F.lit(k).alias("rounds"), "name"))
    return done.join(rows.select("rid", "id", "sha"), "rid")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_chars: int = 4096) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after each run of white space is replaced
    by one space; null counts as empty, and all empty texts are one group. The
    row with the smallest id stays, null ids last; of repeated rows with that
    id, exactly one is marked kept. Other columns of ``docs`` are not read, so
    their names cannot clash. An empty table gives no rows.
    """
    rows = written(name_texts(docs, id_col, text_col, block_chars), "identities")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"), F.col("rid").alias("rid")))
    groups = written(rows.groupBy("rounds", "name").agg(first.alias("first"), F.count("*").alias("group_size")), "groups")
    return rows.join(groups, ["rounds", "name"]).select(
        F.col("id").alias(id_col), F.col("first.id").alias("keep_id"), "group_size",
        (F.col("rid") == F.col("first.rid")).alias("kept"), F.col("sha").alias("text_sha256"))
