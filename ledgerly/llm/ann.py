"""Maximum inner product search with randomly rotated one-bit codes.

Every vector, less a common centre, is rotated at random and kept as one bit
per dimension with two scalars: its length, and how well its bits stand for
its direction. From these the inner product with any query is estimated, with
a bound for the error that the rotation makes likely. Only vectors whose upper
bound reaches the query's k-th best product so far are compared in full.

Queries go in blocks against shares of the vectors: one task streams the codes
of one share past one block, so memory is bounded by the block, and each task
gives k rows per query.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerly.llm.common import written

#: Vectors whose products with a block of queries are estimated at once.
STEP = 1024


def rotation(dim: int, seed: int) -> np.ndarray:
    """A random rotation of ``dim`` dimensions, the same for a seed on every machine."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def usable(vector: Column) -> Column:
    """Vectors that take part: not null, no null or non-finite component, not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def encode(vectors: np.ndarray, centre: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(packed bits, length of vector less centre, product of its direction with its own code)."""
    rest = vectors - centre
    length = np.linalg.norm(rest, axis=1)
    turned = rest @ turn.T / np.where(length == 0, 1, length)[:, None]
    return np.packbits(turned > 0, axis=1), length, np.abs(turned).sum(axis=1) / np.sqrt(vectors.shape[1])


#: The signs that the eight bits of each byte stand for, highest bit first.
SIGNS = (np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.float32) * 2 - 1)


def byte_tables(queries: np.ndarray, turn: np.ndarray) -> np.ndarray:
    """For each byte of a code and each of its 256 values, what it adds to the product with each rotated query."""
    turned = (queries @ turn.T).astype(np.float32)
    turned = np.pad(turned, ((0, 0), (0, -turned.shape[1] % 8)))  # the bits beyond the last dimension add nothing
    return np.stack([SIGNS @ turned[:, p:p + 8].T for p in range(0, turned.shape[1], 8)])


def estimate(bits: np.ndarray, length: np.ndarray, fit: np.ndarray, tables: np.ndarray, queries: np.ndarray, centre: np.ndarray,
             epsilon: float) -> tuple[np.ndarray, np.ndarray]:
    """(estimated inner products, error bounds), vectors by queries; codes are read as packed bytes, see ``byte_tables``."""
    dim = len(centre)
    products = tables[0][bits[:, 0]]
    for p in range(1, bits.shape[1]):
        products += tables[p][bits[:, p]]
    fit = np.where(fit == 0, 1, fit)
    guess = products * (length / fit / np.sqrt(dim)).astype(np.float32)[:, None] + (queries @ centre).astype(np.float32)
    lost = np.sqrt(np.maximum(1 - fit * fit, 0)) / fit * length * epsilon / np.sqrt(max(dim - 1, 1))
    return guess, np.outer(lost, np.linalg.norm(queries, axis=1)).astype(np.float32) + np.float32(1e-6)


class Block:
    """A block of queries and their k best vectors so far."""

    def __init__(self, ids: np.ndarray, queries: np.ndarray, k: int, centre: np.ndarray, seed: int, epsilon: float):
        self.ids, self.queries, self.k, self.epsilon = ids, queries, k, epsilon
        self.tables = byte_tables(queries, rotation(queries.shape[1], seed))
        self.centre = centre if len(centre) == queries.shape[1] else np.zeros(queries.shape[1])
        self.found = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)  # query, vec_id, score
        self.least = np.full(len(ids), -np.inf)

    def add(self, ids: np.ndarray, vectors: np.ndarray, bits: np.ndarray, length: np.ndarray, fit: np.ndarray) -> None:
        guess, error = estimate(bits, length, fit, self.tables, self.queries, self.centre, self.epsilon)
        least = self.least
        if np.isinf(least).any() and len(ids) > self.k:  # before k are known, the k-th best lower bound serves; one more for the query itself
            lower = np.partition(guess - error, len(ids) - self.k - 1, axis=0)[len(ids) - self.k - 1]
            least = np.maximum(least, lower)
        near, at = np.nonzero(guess + error >= least.astype(np.float32) - np.float32(1e-5))
        other = ids[near] != self.ids[at]
        near, at = near[other], at[other]
        scores = np.concatenate([np.einsum("ij,ij->i", vectors[near[p:p + 65536]], self.queries[at[p:p + 65536]])
                                 for p in range(0, len(near), 65536)] or [np.empty(0)])
        q, v, s = (np.concatenate(x) for x in zip(self.found, (at, ids[near], scores)))
        order = np.lexsort((v, -s, q))
        q, v, s = q[order], v[order], s[order]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        best = place < self.k
        self.found = q[best], v[best], s[best]
        full = np.flatnonzero(place == self.k - 1)
        self.least[q[full]] = s[full]

    def rows(self) -> pa.RecordBatch:
        q, v, s = self.found
        return pa.RecordBatch.from_arrays([pa.array(self.ids[q]), pa.array(v), pa.array(s)], ["query_id", "vec_id", "score"])


def _matrix(column: pa.Array, dtype) -> np.ndarray:
    return np.array(column.flatten().to_numpy(zero_copy_only=False), dtype=dtype).reshape(len(column), -1)


def search(vectors: DataFrame, k: int = 20, every: int = 20, epsilon: float = 2.2, seed: int = 7, block_queries: int = 2048,
           share_vectors: int = 16_384, centre_sample: int = 2000, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: for each id divisible by ``every``, its ``k`` nearest other vectors.

    Nearness is the inner product in double precision on the original vectors,
    ties to the smaller id; a query with fewer than k candidates gets all.
    Vectors that are null, zero or hold null or non-finite components take no
    part, nor do rows without an id; vectors meet only those of their own
    length. Rows that repeat an id are one vector, the smallest. Every vector
    is coded; the centre is the mean of at most ``centre_sample`` vectors and
    only makes the codes tighter. Other columns are not read. An empty table
    gives no rows.
    """
    spark = vectors.sparkSession
    clean = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v")) \
        .filter(F.col("vec_id").isNotNull() & usable(F.col("v"))).groupBy("vec_id").agg(F.min("v").alias("v"))
    clean = written(clean.withColumn("dim", F.size("v")), "vectors")
    n, dim, queries = clean.agg(F.count("*"), F.max("dim"), F.count(F.when(F.col("vec_id") % every == 0, 1))).first()
    if not queries:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    drawn = clean.filter(F.col("dim") == dim).orderBy(F.xxhash64("vec_id"), "vec_id").limit(centre_sample).collect()
    centre = np.mean([r.v for r in drawn], axis=0)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for d in np.unique(dims).tolist():
                part = batch.filter(pa.array(dims == d))
                bits, length, fit = encode(_matrix(part.column("v"), np.float64), centre if d == dim else np.zeros(d), rotation(d, seed))
                yield pa.RecordBatch.from_arrays([part.column("vec_id"), part.column("v"), part.column("dim"),
                                                  pa.array([b.tobytes() for b in bits], pa.binary()), pa.array(length), pa.array(fit)],
                                                 ["vec_id", "v", "dim", "bits", "length", "fit"])

    blocks, shares = -(-queries // block_queries), -(-n // share_vectors)
    coded = clean.mapInArrow(code, "vec_id long, v array<double>, dim int, bits binary, length double, fit double")
    coded = written(coded.withColumn("hash", F.xxhash64("vec_id")), "codes")
    all_of = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    asked = (coded.filter(F.col("vec_id") % every == 0).withColumn("kind", F.lit(0))
             .withColumn("block", F.expr(f"pmod(hash, {blocks})")).withColumn("share", all_of(shares)))
    given = (coded.withColumn("kind", F.lit(1)).withColumn("share", F.expr(f"pmod(shiftright(hash, 20), {shares})"))
             .withColumn("block", all_of(blocks)))
    columns = ["dim", "block", "share", "kind", "vec_id", "v", "bits", "length", "fit"]
    both = asked.select(*[F.col(c).cast("int") if c in columns[:4] else F.col(c) for c in columns]).unionAll(
        given.select(*[F.col(c).cast("int") if c in columns[:4] else F.col(c) for c in columns]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, asked_ids, asked_vectors, block = None, [], [], None
        for batch in chain(batches, [None]):
            if batch is None:
                if block is not None:
                    yield block.rows()
                return
            keys = np.stack([batch.column(c).to_numpy() for c in columns[:4]], axis=1)
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(keys)]):
                part, here, kind = batch.slice(a, b - a), tuple(keys[a, :3]), keys[a, 3]
                if here != key:
                    if block is not None:
                        yield block.rows()
                    key, asked_ids, asked_vectors, block = here, [], [], None
                vectors = _matrix(part.column("v"), np.float64)
                if kind == 0:
                    asked_ids.append(part.column("vec_id").to_numpy())
                    asked_vectors.append(vectors)
                    continue
                if not asked_ids:
                    continue  # no query in this block has this length
                if block is None:
                    block = Block(np.concatenate(asked_ids), np.concatenate(asked_vectors), k, centre, seed, epsilon)
                ids, length, fit = (part.column(c).to_numpy() for c in ("vec_id", "length", "fit"))
                bits = np.frombuffer(b"".join(part.column("bits").to_pylist()), dtype=np.uint8).reshape(len(ids), -1)
                for p in range(0, len(ids), STEP):
                    block.add(*(x[p:p + STEP] for x in (ids, vectors, bits, length, fit)))

    dealt = both.repartition(*columns[:3]).sortWithinPartitions(*columns[:4], "vec_id")
    found = dealt.mapInArrow(scan, "query_id long, vec_id long, score double")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
