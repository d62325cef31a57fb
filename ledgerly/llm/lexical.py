"""Ranked lexical search over posting lists in geometric blocks, exact.

Documents that look alike go to one block: each is held against a fixed number
of pivot documents and joins those with the same nearest two, and crowded
groups are dealt out further. Every posting list is so cut into blocks of
similar documents, and each block of a list keeps the greatest value that one
of its documents has there. The maxima of all lists at one block are its
summary: the coordinatewise maximum of its documents. For a query, the summary
bounds the score of any document in the block, and the summary of the terms from
some place on bounds every document that no earlier term's list has shown. A
block of a list is skipped only when such a bound stays below the k-th best
score known, so results are those of a scan of all lists.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerly.llm.common import written

#: Bytes of a text to its terms: A-Z lower-cased, all of ASCII but digits and letters a space, the rest as it is.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))
#: A value of 1 in fixed point, and the share of length in a document's weight, in hundredths.
ONE, LENGTH = 1_000_000_000, 75
#: Dimensions that terms are folded to when documents are compared.
FOLD = 512
#: A pivot has at most this many characters, so that the pivots are bounded.
PIVOT_CHARS = 20_000


def count_terms(text: str | None) -> Counter:
    """Terms, as bytes, and how often they stand in the text."""
    counts = Counter((text or "").encode().translate(TERM_BYTES).split(b" "))
    counts.pop(b"", None)
    return counts


def folded(counts: list[Counter]) -> np.ndarray:
    """Documents as unit vectors of ``FOLD`` dimensions; repeats of a term count by their logarithm."""
    out = np.zeros((len(counts), FOLD), dtype=np.float32)
    rows = np.repeat(np.arange(len(counts)), [len(c) for c in counts])
    place = np.fromiter((zlib.crc32(t) for c in counts for t in c), dtype=np.int64, count=len(rows))
    tf = np.fromiter((n for c in counts for n in c.values()), dtype=np.float32, count=len(rows))
    np.add.at(out, (rows, place % FOLD), np.where(place >> 20 & 1, 1, -1) * (1 + np.log(tf)))
    return out / np.maximum(np.linalg.norm(out, axis=1), 1e-9)[:, None]


def pivot_vectors(docs: DataFrame, pivots: int, id_col: str, text_col: str) -> np.ndarray:
    """At most ``pivots`` documents of at most ``PIVOT_CHARS`` characters, drawn by a hash of the id, as vectors."""
    drawn = (docs.filter(F.length(text_col).between(1, PIVOT_CHARS)).orderBy(F.xxhash64(F.col(id_col), F.lit(5)), F.col(id_col))
             .limit(pivots).select(F.col(text_col).alias("text")).collect())
    return folded([count_terms(r.text) for r in drawn] or [Counter()])


#: A document's terms joined by spaces, which no term holds, and how often each stands in it, as 32-bit integers.
VECTOR = "id {kind}, n long, terms string, tfs binary, cell long"


def vectors_of(rows: DataFrame, id_col: str, text_col: str, pivots: np.ndarray | None = None) -> DataFrame:
    """``VECTOR`` of every row; ``cell`` tells the two nearest pivots (0 without pivots). Null texts have no terms."""
    schema = VECTOR.format(kind=rows.schema[id_col].dataType.simpleString())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p in range(0, batch.num_rows, 512):  # few texts at once: they may be long
                part = batch.slice(p, 512)
                counts = [count_terms(t.as_py()) for t in part.column("text")]
                cells = np.zeros(len(counts), dtype=np.int64)
                if pivots is not None:
                    like = folded(counts) @ pivots.T
                    best = like.argmax(axis=1)
                    like[np.arange(len(like)), best] = -2
                    cells = best * len(pivots) + like.argmax(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array([sum(c.values()) for c in counts], pa.int64()), pa.array([b" ".join(c) for c in counts], pa.binary()).cast(pa.string()),
                     pa.array([np.fromiter(c.values(), "<u4", len(c)).tobytes() for c in counts], pa.binary()), pa.array(cells)],
                    ["id", "n", "terms", "tfs", "cell"])

    return rows.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


#: Per block: its documents and their lengths; its terms, joined as above, and of each list the greatest value and where it
#: starts; of all lists the members' places, as 16-bit integers (32 where a block is larger), and term counts, as 32-bit ones.
BLOCK = "block long, ids array<{kind}>, lengths array<long>, terms string, maxima array<int>, starts array<int>, members binary, tfs binary"


def values_of(tfs: np.ndarray, lengths: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """(10^9 tf) div (1000 tf + 8 m), m the document's length in hundredths of the mean; the term's weight is left to the query."""
    if LENGTH * int(lengths.max(initial=0)) * n_docs < 1 << 62:
        m = 100 - LENGTH + LENGTH * lengths * n_docs // n_terms
    else:
        m = np.array([100 - LENGTH + LENGTH * int(n) * n_docs // n_terms for n in lengths], dtype=np.int64)
    return ONE * tfs // (1000 * tfs + 8 * m)


def block_rows(docs: DataFrame, n_docs: int, n_terms: int) -> DataFrame:
    """One row per block, see ``BLOCK``."""
    kind = docs.schema["id"].dataType.simpleString()

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        names = [t.split(" ") for t in table.column("terms").to_pylist()]
        member = np.repeat(np.arange(len(names)), [len(t) for t in names])
        words = pa.array([w for t in names for w in t], pa.string()).dictionary_encode()
        tf = np.frombuffer(b"".join(table.column("tfs").to_pylist()), "<u4").astype(np.int64)
        value = values_of(tf, table.column("n").to_numpy()[member], n_docs, n_terms)
        place = words.indices.to_numpy()
        order = np.lexsort((member, place))
        starts = np.searchsorted(place[order], np.arange(len(words.dictionary) + 1))
        lists = lambda x, kind: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x, kind))
        return pa.Table.from_arrays(
            [pa.array([key[0].as_py()], pa.int64()), lists(table.column("id").combine_chunks(), None), lists(table.column("n").to_numpy(), pa.int64()),
             pa.array([" ".join(words.dictionary.to_pylist())]), lists(np.maximum.reduceat(value[order], starts[:-1]), pa.int32()), lists(starts, pa.int32()),
             pa.array([member[order].astype("<u2" if len(names) <= 1 << 16 else "<u4").tobytes()]), pa.array([tf[order].astype("<u4").tobytes()])],
            ["block", "ids", "lengths", "terms", "maxima", "starts", "members", "tfs"])

    return docs.select("block", "id", "n", "terms", "tfs").groupBy("block").applyInArrow(run, BLOCK.format(kind=kind))


def weight(n_docs: int, df: Column) -> Column:
    """A term's weight: floor(1000 ln((2N + 2) / (2 df + 1)))."""
    return F.floor(F.lit(1000.0) * F.log(F.lit(2.0 * n_docs + 2) / (F.lit(2.0) * df + 1))).cast("long")


def walk(weights: np.ndarray, maxima: np.ndarray, values: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Scores of a block's documents for some queries, -1 for those that a skipped block of a list has left out.

    ``weights``: queries by lists; ``values``: lists by documents, 0 where a
    document is not in the list; ``maxima`` and ``least`` go with the lists
    and the queries. A query's lists come by falling bound; from the first
    place on at which all bounds left add up to less than its ``least``, lists
    bring no new documents.
    """
    bounds = weights * maxima
    order = np.argsort(-bounds, axis=1, kind="stable")
    left = np.cumsum(np.take_along_axis(bounds, order, 1)[:, ::-1], axis=1)[:, ::-1]
    brings = np.zeros(weights.shape, dtype=np.float32)
    np.put_along_axis(brings, order, (left >= least[:, None]) & (left > 0), 1)
    shown = (brings * (weights > 0)) @ (values > 0).astype(np.float32) > 0
    if bounds.sum(axis=1).max(initial=0) < 1 << 53:  # then sums of float64 products are exact
        score = (weights.astype(np.float64) @ values.astype(np.float64)).astype(np.int64)
    else:
        score = weights @ values
    return np.where(shown & (score >= np.maximum(least, 1)[:, None]), score, -1)


#: Cells of the matrices that are held at once.
CELLS = 2_000_000


class Index(NamedTuple):
    blocks: DataFrame
    n_docs: int
    n_terms: int


def scored(hits: DataFrame, pairs: DataFrame, index: Index, k: int, chunks: int) -> DataFrame:
    """q, id, score: the k best documents of each (query, block) of ``pairs`` that reach the pair's ``least``."""
    blocks, n_docs, n_terms = index
    kind = blocks.schema["ids"].dataType.elementType.simpleString()
    pairs = pairs.select("q", "block", "least", F.expr(f"pmod(xxhash64(q), {chunks})").cast("int").alias("chunk"))
    asked = hits.join(pairs, ["q", "block"]).select("block", "chunk", "q", "place", "weight", "least")
    wanted = blocks.select(F.col("block").alias("of"), F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("part"),
                           "ids", "lengths", "maxima", "starts", "members", "tfs")

    def run(asked: pa.Table, block: pa.Table) -> pa.Table:
        found: list[tuple[np.ndarray, ...]] = []
        ids = block.column("ids")[0].values if block.num_rows else pa.array([], pa.int64())
        if block.num_rows and asked.num_rows:
            lengths, maxima, starts = (np.asarray(block.column(c)[0].values, dtype=np.int64) for c in ("lengths", "maxima", "starts"))
            tfs = np.frombuffer(block.column("tfs")[0].as_py(), "<u4").astype(np.int64)
            members = np.frombuffer(block.column("members")[0].as_py(), "<u2" if len(ids) <= 1 << 16 else "<u4")
            by_id = np.argsort(pc.sort_indices(ids, null_placement="at_end").to_numpy())
            q, place, weight, least = (asked.column(c).to_numpy() for c in ("q", "place", "weight", "least"))
            lists, column = np.unique(place, return_inverse=True)
            sizes = starts[lists + 1] - starts[lists]
            at = np.arange(sizes.sum()) + np.repeat(starts[lists] - np.cumsum(sizes) + sizes, sizes)
            dense = np.zeros((len(lists), len(ids)), dtype=np.int64)
            dense[np.repeat(np.arange(len(lists)), sizes), members[at]] = values_of(tfs[at], lengths[members[at]], n_docs, n_terms)
            queries, first, row = np.unique(q, return_index=True, return_inverse=True)
            step = max(1, CELLS // max(len(lists), len(ids)))
            for p in range(0, len(queries), step):
                own = (row >= p) & (row < p + step)
                weights = np.zeros((min(step, len(queries) - p), len(lists)), dtype=np.int64)
                weights[row[own] - p, column[own]] = weight[own]
                score = walk(weights, maxima[lists], dense, least[first[p:p + step]])
                r, c = np.nonzero(score >= 0)
                best = np.lexsort((by_id[c], -score[r, c], r))
                r, c = r[best], c[best]
                best = np.arange(len(r)) - np.searchsorted(r, r) < k
                found.append((queries[p + r[best]], c[best], score[r[best], c[best]]))
        q, c, score = (np.concatenate(x).astype(np.int64) for x in zip(*found)) if found else [np.empty(0, np.int64)] * 3
        return pa.Table.from_arrays([pa.array(q), ids.take(pa.array(c)), pa.array(score)], ["q", "id", "score"])

    return asked.groupBy("block", "chunk").cogroup(wanted.groupBy("of", "part")).applyInArrow(run, f"q long, id {kind}, score long")


def top(rows: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(W.partitionBy("q").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last()))
    return rows.withColumn("rank", rank).filter(F.col("rank") <= k)


def index(docs: DataFrame, block_docs: int = 64, pivots: int = 64, id_col: str = "doc_id", text_col: str = "text") -> Index:
    """The blocks of every row that has a term, texts whole, and how many documents and terms there are.

    ``pivots`` bounds the documents that blocks form around; they shape the
    blocks alone and change no result. A cell of more than ``block_docs``
    documents is dealt out by hash, whatever its documents have in common.
    """
    vectors = written(vectors_of(docs, id_col, text_col, pivot_vectors(docs, pivots, id_col, text_col)).filter("n > 0")
                      .withColumn("rid", F.monotonically_increasing_id()), "terms", "zstd")
    n_docs, n_terms = vectors.agg(F.count("*"), F.sum("n")).first()
    parts = written(vectors.groupBy("cell").agg(F.ceil(F.count("*") / block_docs).alias("parts")), "cells")
    placed = vectors.join(parts, "cell").withColumn("block", F.xxhash64("cell", F.expr("pmod(xxhash64(rid), parts)")))
    return Index(written(block_rows(placed, n_docs, n_terms or 1), "blocks", "zstd"), n_docs, n_terms or 1)


def search(index: Index, items: DataFrame, k: int = 10, seeds: int = 4, item_chunk: int = 4096,
           id_col: str = "doc_id", item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """item id, rank, document id, score: each item's k documents of the highest score above 0.

    Equal scores go by ascending document id, null ids last; repeated rows
    are documents of their own. Items without terms, or without a term that a
    document has, get no rows; repeated item rows get theirs each. Other
    columns are not read. An empty table on either side gives no rows.

    A query's ``seeds`` blocks of the highest bound are scored first; the k-th
    best score found there is what other blocks must reach. Items are dealt
    to tasks ``item_chunk`` at a time.
    """
    asked = written(vectors_of(items, item_col, text_col).withColumn("q", F.monotonically_increasing_id()), "items")
    times = F.transform(F.sequence(F.lit(0), F.size("names") - 1), lambda k: F.conv(F.hex(F.reverse(F.substring("tfs", k * 4 + 1, F.lit(4)))), 16, 10).cast("long"))
    words = asked.filter("n > 0").select("q", F.split("terms", " ").alias("names"), "tfs")
    words = words.select("q", F.explode(F.arrays_zip("names", times.alias("times"))).alias("t")).select("q", F.col("t.names").alias("term"), "t.times")
    lists = index.blocks.select("block", F.split("terms", " ").alias("names"), "maxima", "starts")
    zipped = F.arrays_zip("names", "maxima", F.slice("starts", F.lit(1), F.size("names")).alias("a"), F.slice("starts", F.lit(2), F.size("names")).alias("b"))
    lists = (lists.select("block", F.posexplode(zipped).alias("place", "l"))
             .select("block", "place", F.col("l.names").alias("term"), F.col("l.maxima").alias("most"), (F.col("l.b") - F.col("l.a")).alias("n"))
             .join(written(words.select("term").distinct(), "asked"), "term", "left_semi"))
    lists = written(lists, "lists")
    weights = lists.groupBy("term").agg(weight(index.n_docs, F.sum("n")).alias("weight"))
    weighted = words.join(weights, "term").select("q", "term", (F.col("times") * F.col("weight")).alias("weight")).filter("weight > 0")
    hits = weighted.join(lists, "term").select("q", "block", "place", "weight", "most")
    pairs = written(hits.groupBy("q", "block").agg(F.sum(F.col("weight") * F.col("most")).alias("bound")), "bounds")
    chunks = max(1, -(-asked.count() // item_chunk))
    place = F.row_number().over(W.partitionBy("q").orderBy(F.col("bound").desc(), "block"))
    first = written(pairs.withColumn("seed", place).filter(F.col("seed") <= seeds).select("q", "block", F.lit(0).cast("long").alias("least")), "seeds")
    seeded = index._replace(blocks=index.blocks.join(first.select("block").distinct(), "block", "left_semi"))
    known = written(top(scored(hits, first, seeded, k, chunks), k), "known")
    least = known.groupBy("q").agg(F.when(F.count("*") >= k, F.min("score")).otherwise(F.lit(0)).cast("long").alias("least"))
    rest = written(pairs.join(first.select("q", "block"), ["q", "block"], "left_anti").join(least, "q")
                   .filter(F.col("bound") >= F.col("least")).select("q", "block", "least"), "rest")
    best = top(known.select("q", "id", "score").unionAll(scored(hits, rest, index, k, chunks)), k)
    return best.join(asked.select("q", F.col("id").alias("item")), "q").select(
        F.col("item").alias(item_col), "rank", F.col("id").alias(id_col), "score")
