"""SimHash near-dedup with deletion-variant signatures.

Fingerprints that differ in at most three bits have a half that differs in at
most one. Each half is indexed 32 times, each time with another bit as the
wildcard, so halves that differ by at most one bit share a key. Fingerprints
that meet under a key are compared; those within the distance are linked, and a
key gives no more links than a spanning forest of its fingerprints needs. A key
with many fingerprints is not compared as a whole: its fingerprints get longer
keys, with the other half cut and indexed in the same way, and so on. Under the
longest key only 2 ** 11 different fingerprints can meet, so all work stays
bounded and no link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerly.llm.common import row_key, written
from ledgerly.llm.components import components

BITS = np.array([[(b >> k) & 1 for k in range(8)] for b in range(256)], dtype=np.int64)
#: Most distinct fingerprints that are compared under one key before it is made longer.
MOST = 2048


def fingerprint(text: bytes | None, words: int, seed: int) -> int:
    """Unsigned fingerprint of the shingles' XXH64, each occurrence counted; 0 without words."""
    parts = (text or b"").lower().split()  # of bytes: A-Z only, and the six ASCII white spaces only
    if not parts:
        return 0
    if len(parts) <= words:
        return xxhash.xxh64_intdigest(b" ".join(parts), seed)
    flat = b" ".join(parts)
    sizes = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
    ends = np.cumsum(sizes + 1) - 1
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(flat[a:b], seed) for a, b in zip((ends - sizes)[:len(parts) - words + 1].tolist(),
                                                              ends[words - 1:].tolist())], dtype="<u8")
    if len(hashes) < 1024:
        ones = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    else:
        by_byte = hashes.view(np.uint8).reshape(-1, 8)
        ones = np.concatenate([np.bincount(by_byte[:, k], minlength=256) @ BITS for k in range(8)])
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint_column(text: Column, words: int = 3, seed: int = 42) -> Column:
    """The fingerprint as a signed 64-bit column."""
    @F.arrow_udf("long")
    def prints(texts: pa.Array) -> pa.Array:
        out = np.fromiter((fingerprint(t, words, seed) for t in texts.cast(pa.binary()).to_pylist()), dtype=np.uint64,
                          count=len(texts))
        return pa.array(out.view(np.int64))
    return prints(text)


def variants(rows: DataFrame, width: int) -> DataFrame:
    """Rows (k1, k2, start, fp): the ``width`` bits from ``start`` on are cut in two and either half is indexed.

    A key holds which half, which of its bits is the wildcard, and the half
    without that bit; it is added to the keys that the row has already.
    """
    half = width // 2
    rows = rows.withColumn("place", F.explode(F.sequence(F.lit(0), F.lit(width - 1))))
    side = F.expr(f"place div {half}").cast("int")
    value = F.expr(f"shiftrightunsigned(fp, cast(start + (place div {half}) * {half} as int)) & {(1 << half) - 1}L"
                   f" & ~shiftleft(1L, cast(place % {half} as int))")
    key = F.shiftleft(F.col("place").cast("long"), half).bitwiseOR(value)
    if width == 64:
        keys = [key.alias("k1"), F.lit(0).cast("long").alias("k2")]
    else:
        keys = [F.col("k1"), F.shiftleft("k2", half + 6).bitwiseOR(key).alias("k2")]
    return rows.select(*keys, (F.col("start") + (1 - side) * half).cast("int").alias("start"), "fp")


def forest(prints: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links of a spanning forest of the fingerprints within ``distance`` bits of each other, by position."""
    unseen, links = np.ones(len(prints), dtype=bool), []
    for seed in range(len(prints)):
        todo = [seed] if unseen[seed] else []
        unseen[seed] = False
        while todo:
            at = todo.pop()
            near = np.flatnonzero(unseen & (np.bitwise_count(prints ^ prints[at]) <= distance))
            unseen[near] = False
            links += [(at, k) for k in near.tolist()]
            todo += near.tolist()
    return links


def verify(distance: int, most: int = MOST):
    """Over rows sorted by key: links (a, b) within a key, or, where too many meet, the rows again with b null."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry, passing = [np.empty(0, np.int64)] * 4, None
        for batch in chain(batches, [None]):
            rows = carry if batch is None else [np.concatenate([c, batch.column(n).to_numpy()])
                                                for c, n in zip(carry, ("k1", "k2", "start", "fp"))]
            k1, k2, _, fp = rows
            if not len(fp):
                continue
            starts = np.concatenate([[0], np.flatnonzero((k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])) + 1])
            sizes = np.diff(np.append(starts, len(fp)))
            prints = fp.view(np.uint64)
            crowded = sizes > most
            crowded[0] |= passing == (k1[0], k2[0])  # the rest of a key that was handed on goes the same way, however short
            links, again = [], [np.arange(at, at + n) for at, n in zip(starts[crowded].tolist(), sizes[crowded].tolist())]
            if batch is not None:  # the last key may go on in the next batch
                at = starts[-1]
                if crowded[-1]:
                    passing, at = (k1[at], k2[at]), len(fp)
                carry, starts, sizes, crowded = [c[at:] for c in rows], starts[:-1], sizes[:-1], crowded[:-1]
            pairs = starts[(sizes == 2) & ~crowded]
            pairs = pairs[np.bitwise_count(prints[pairs] ^ prints[pairs + 1]) <= distance]
            links.append(np.stack([fp[pairs], fp[pairs + 1]]))
            several = (sizes > 2) & ~crowded
            for at, n in zip(starts[several].tolist(), sizes[several].tolist()):
                if found := forest(prints[at:at + n], distance):
                    links.append(fp[at + np.array(found).T])
            a, b = np.concatenate(links, axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)] + [pa.nulls(len(a), t) for t in (
                pa.int64(), pa.int64(), pa.int32())], names=["a", "b", "k1", "k2", "start"])
            if again:
                at = np.concatenate(again)
                yield pa.RecordBatch.from_arrays([pa.array(fp[at]), pa.nulls(len(at), pa.int64())] + [pa.array(c[at]) for c in (
                    k1, k2, rows[2].astype(np.int32))], names=["a", "b", "k1", "k2", "start"])
    return run


def links(prints: DataFrame, distance: int = 3, most: int = MOST) -> DataFrame:
    """Links (u, v) of distinct fingerprints ``fp`` that connect all those reachable by steps of ``distance`` bits or less."""
    if distance > 3:
        raise ValueError("a half that differs in at most one bit is sure for distances up to 3")
    rows, found = prints.select(F.lit(0).cast("long").alias("k1"), F.lit(0).cast("long").alias("k2"), F.lit(0).alias("start"), "fp"), []
    for width in (64, 32, 16):
        most = most if width > 16 else 1 << 11  # the longest keys are never split further
        met = variants(rows, width).repartition("k1", "k2").sortWithinPartitions("k1", "k2", "fp")
        level = written(met.mapInArrow(verify(distance, most), "a long, b long, k1 long, k2 long, start int"), f"links{width}")
        found.append(level.filter("b is not null").select(F.col("a").alias("u"), F.col("b").alias("v")))
        rows = level.filter("b is null").select("k1", "k2", "start", F.col("a").alias("fp"))
        if rows.isEmpty():
            break
    return reduce(DataFrame.unionAll, found)


def near_duplicates(docs: DataFrame, words: int = 3, distance: int = 3, seed: int = 42, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per input row: row (a digest of id and text), id, fingerprint (16 hex digits), component_id, root.

    Texts with fewer words than a shingle are one shingle; texts without
    words, null ones too, have fingerprint zero and are linked like any other.
    Fingerprints within ``distance`` bits are linked, and links connect over
    any number of steps. ``component_id`` is the smallest id of the connected
    documents (null if none has one); ``root`` tells components apart even if
    ids repeat. Copies meet by their fingerprint before links are searched.
    Other columns are not read. An empty table gives no rows.
    """
    rows = written(docs.select(row_key(F.col(id_col), F.col(text_col)).alias("row"), F.col(id_col).alias("id"),
                               fingerprint_column(F.col(text_col), words, seed).alias("fp")), "prints")
    prints = written(rows.groupBy("fp").agg(F.min("id").alias("first")), "distinct")
    roots = written(components(links(prints, distance)), "roots")
    prints = prints.join(roots, prints["fp"] == roots["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    ids = written(prints.groupBy("root").agg(F.min("first").alias("component_id")), "ids")
    known = written(prints.join(ids, "root").select("fp", "root", "component_id"), "known")
    return rows.join(known, "fp").select("row", F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                                         "component_id", "root")


def keep_one(docs: DataFrame, words: int = 3, distance: int = 3, seed: int = 42, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each component: that with the smallest id (null last); one row of repeated ones."""
    groups = near_duplicates(docs, words, distance, seed, id_col, text_col)
    first = F.min(F.struct(F.col(id_col).isNull(), F.col(id_col), F.col("row").alias("row")))
    keep = written(groups.groupBy("root").agg(first["row"].alias("row")).select("row"), "keep")
    rows = docs.select(row_key(F.col(id_col), F.col(text_col)).alias("row"), F.struct("*").alias("doc")).join(keep, "row")
    one = rows.withColumn("n", F.row_number().over(W.partitionBy("row").orderBy(F.lit(0)))).filter("n = 1")
    return one.select(*[F.col(f"doc.`{c}`") for c in docs.columns])
