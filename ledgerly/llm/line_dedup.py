"""Line dedup: drop the lines that many documents share.

Lines are normalised and hashed to 128 bits where the text is read; Spark
counts the documents of each hash (partial sums before the shuffle), keeps the
hashes over the threshold, brings them back to their documents by hash and then
by document, and the documents are put together again from the lines left.
"""

from __future__ import annotations

from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerly.llm.common import row_key, written

#: Fixed value: the white space stripped from both ends of a line.
STRIP = b"\x20\x09\x0a\x0b\x0c\x0d"


def _key(line: bytes) -> bytes:
    """A line's key: ends stripped, A-Z lower-cased (bytes.lower changes ASCII letters only)."""
    return line.strip(STRIP).lower()


def _hash(key: bytes) -> bytes:
    return blake2b(key, digest_size=16).digest()


def _long_enough(key: bytes, least: int) -> bool:
    return len(key) >= least and (least <= 1 or len(key.decode("utf-8", "replace")) >= least)


def line_hashes(text: Column, min_chars: int) -> Column:
    """The distinct hashes of a text's line keys of at least ``min_chars`` characters."""
    @F.arrow_udf("array<binary>")
    def hashes(texts: pa.Array) -> pa.Array:
        out = []
        for t in texts.cast(pa.binary()).to_pylist():
            keys = {_key(line) for line in (t or b"").split(b"\n")}
            out.append([_hash(k) for k in keys if _long_enough(k, min_chars)])
        return pa.array(out, pa.list_(pa.binary()))
    return hashes(text)


def without_lines(text: Column, hot: Column) -> Column:
    """struct<text, dropped>: the text without the lines whose hash is in ``hot``; null where ``text`` is null."""
    @F.arrow_udf("text string, dropped long")
    def rebuild(texts: pa.Array, hots: pa.Array) -> pa.Array:
        kept, dropped = [], []
        for t, h in zip(texts.cast(pa.binary()).to_pylist(), hots.to_pylist()):
            if t is None:
                kept.append(None)
                dropped.append(None)
                continue
            lines, gone = t.split(b"\n"), set(h or ())
            left = [line for line in lines if _hash(_key(line)) not in gone]
            kept.append(b"\n".join(left))
            dropped.append(len(lines) - len(left))
        return pa.StructArray.from_arrays([pa.array(kept, pa.binary()).cast(pa.string()), pa.array(dropped, pa.int64())],
                                          ["text", "dropped"])
    return rebuild(text, hot)


def line_dedup(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """``docs`` with shared lines taken out of the text, and n_lines and n_dropped added.

    A line's key is the line stripped of white space at both ends with A-Z
    lower-cased. Keys of at least ``min_chars`` code points that occur in at
    least ``min_docs`` documents lose all their lines in every row. Null and
    empty texts are one empty line; null stays null and empty stays empty, as
    an empty key is shorter than ``min_chars``. An id is one document, however
    many rows have it, and so are all rows without an id. All other columns are kept
    (input columns named n_lines or n_dropped are replaced). An empty table
    gives no rows.
    """
    key = row_key(F.col(id_col), F.col(text_col))
    lines = written(docs.select(key.alias("row"), F.col(id_col).alias("id"),
                                F.explode(line_hashes(F.col(text_col), max(1, min_chars))).alias("hash")), "lines")
    # rows are at least as many as documents, so the rows of the few hashes left tell the documents
    often = written(lines.groupBy("hash").count().filter(F.col("count") >= min_docs).select("hash"), "often")
    shared = written(lines.join(often, "hash"), "shared")
    hot = written(shared.select("hash", "id").distinct().groupBy("hash").count().filter(F.col("count") >= min_docs).select("hash"), "hot")
    drops = shared.join(hot, "hash").groupBy("row").agg(F.collect_set("hash").alias("hot"))
    out = docs.select(key.alias("row"), F.struct("*").alias("doc")).join(drops, "row", "left")
    out = out.withColumn("old", F.col(f"doc.`{text_col}`"))
    fixed = without_lines(F.when(F.col("hot").isNotNull(), F.col("old")), F.col("hot"))
    out = out.withColumn("fixed", fixed).withColumn("old_text", F.coalesce(F.col("old"), F.lit("")))
    breaks = F.length("old_text") - F.length(F.replace(F.col("old_text"), F.lit("\n"), F.lit("")))
    return out.select(
        *[F.coalesce(F.col("fixed.text"), F.col("old")).alias(c) if c == text_col else F.col(f"doc.`{c}`")
          for c in docs.columns if c not in ("n_lines", "n_dropped")],
        (breaks + 1).cast("long").alias("n_lines"),
        F.coalesce(F.col("fixed.dropped"), F.lit(0)).cast("long").alias("n_dropped"))
