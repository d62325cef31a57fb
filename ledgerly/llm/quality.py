"""Document quality from the line model: training on a bounded sample of labelled rows, scoring of every row."""

from __future__ import annotations

import warnings

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerly.llm.common import written
from ledgerly.llm.line_crf import LineCrf, line_features


def fold(row_id: Column, folds: int = 3) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.crc32(row_id.cast("string")) % folds


def usable_labels(labels: DataFrame, held_out: int) -> DataFrame:
    """id, quality: labels 0 and 1 of ids outside the held-out fold, without contradictions."""
    return (labels.select(F.col("doc_id").alias("id"), F.col("quality").alias("quality")).dropna()
            .filter(fold(F.col("id")) != held_out).groupBy("id").agg(F.min("quality").alias("quality"), F.max("quality").alias("other"))
            .filter("quality = other and quality in (0, 1)").select("id", "quality"))


def chosen(sizes: list[tuple], max_lines: int, document_lines: int) -> list:
    """Ids of documents, given as (turn, draw, id, lines), that fill ``max_lines`` as whole ones.

    In the order of the draw, each document of at most ``document_lines`` that
    still fits is taken and the others are passed over; then longer ones, the
    shortest first, as far as there is room.
    """
    out, room = [], max_lines
    rows = sorted(sizes)
    for row in [r for r in rows if r[3] <= document_lines] + sorted((r for r in rows if r[3] > document_lines), key=lambda r: (r[3], r)):
        if row[3] <= room:
            out.append(row[2])
            room -= row[3]
    return out


def training_sample(docs: DataFrame, labels: DataFrame, held_out: int, per_label: int, max_lines: int, document_lines: int,
                    id_col: str, text_col: str) -> DataFrame:
    """At most ``per_label`` documents of each label and ``max_lines`` lines in all: doc_id, quality, text.

    Rows whose fold is ``held_out`` and ids with contradicting labels are left
    out before anything is drawn. The draw is by a hash of the id, so it is
    the same in every run, and takes the labels in turn. Documents are taken
    whole or not at all, see ``chosen``: one of more than ``document_lines``
    lines cannot shut out others.
    """
    known = usable_labels(labels, held_out).withColumn("draw", F.xxhash64("id"))
    drawn = known.filter("quality = 0").orderBy("draw", "id").limit(per_label).unionAll(
        known.filter("quality = 1").orderBy("draw", "id").limit(per_label))
    # drawn has at most 2 x per_label rows, and so have the sizes that come to the driver
    texts = written(docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
                    .join(F.broadcast(drawn), "id").groupBy("id", "quality", "draw").agg(F.min("text").alias("text")), "labelled")
    lines = F.length("text") - F.length(F.replace(F.col("text"), F.lit("\n"), F.lit(""))) + 1
    sizes = texts.select("id", "quality", "draw", lines.alias("lines")).withColumn(
        "turn", F.row_number().over(W.partitionBy("quality").orderBy("draw", "id")))
    ids = chosen([tuple(r) for r in sizes.select("turn", "draw", "id", "lines").collect()], max_lines, document_lines)
    fit = docs.sparkSession.createDataFrame([(i,) for i in ids], T.StructType([T.StructField("id", texts.schema["id"].dataType)]))
    return texts.join(F.broadcast(fit), "id").select(F.col("id").alias("doc_id"), "quality", "text")


def train(docs: DataFrame, labels: DataFrame, held_out: int = 1, per_label: int = 1500, max_lines: int = 60_000,
          document_lines: int = 3000, id_col: str = "doc_id", text_col: str = "text") -> LineCrf | None:
    """The line model learnt from a bounded sample; None if the labels lack one of the two classes.

    Only the sample's line features come to the driver, at most ``max_lines``
    rows of 40 numbers.
    """
    def features(batches):
        for batch in batches:
            texts = [t.encode() for t in batch.column("text").to_pylist()]
            x, sizes, counts = line_features(texts)
            cuts = np.cumsum(counts)[:-1]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), batch.column("quality").cast(pa.int64()),
                 pa.array([p.astype("<f4").tobytes() for p in np.split(x, cuts)], pa.binary()),
                 pa.array([p.astype("<i8").tobytes() for p in np.split(sizes, cuts)], pa.binary())], ["doc_id", "quality", "x", "sizes"])
    sample = training_sample(docs, labels, held_out, per_label, max_lines, document_lines, id_col, text_col)
    rows = sorted(sample.mapInArrow(features, "doc_id long, quality long, x binary, sizes binary").collect())
    if len({r.quality for r in rows}) < 2:
        if usable_labels(labels, held_out).select("quality").distinct().count() == 2:
            warnings.warn("labels of both classes, but the sampled documents have not both: every score is 0.5", stacklevel=2)
        return None
    sizes = [np.frombuffer(r.sizes, dtype="<i8") for r in rows]
    x = np.concatenate([np.frombuffer(r.x, dtype="<f4") for r in rows]).reshape(sum(map(len, sizes)), -1).astype(np.float64)
    counts = np.array([len(s) for s in sizes])
    return LineCrf().fit(x, np.concatenate(sizes), counts, np.array([r.quality for r in rows]))


def score_column(text: Column, model: LineCrf | None) -> Column:
    """Score of each text from 0 to 1, higher for likelier good; 0.5 everywhere without a model."""
    if model is None:
        return F.lit(0.5)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(model.score([t or b"" for t in texts.cast(pa.binary()).to_pylist()]), pa.float64())
    return score(text)


def classify(docs: DataFrame, labels: DataFrame, held_out: int = 1, threshold: float = 0.5, per_label: int = 1500,
             max_lines: int = 60_000, document_lines: int = 3000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with held_out, score and predicted added (columns of these names are replaced).

    A null text scores as an empty one, which is a document of one empty line.
    Repeated rows score alike; a row without an id is never held out and never
    learnt from. Labels, sources and ids are no inputs of a score. Without
    labels of both classes every score is 0.5. Texts are scored whole, in
    blocks of lines, whatever their length; the sample's bounds (per_label,
    max_lines, document_lines) hold for training alone. An empty table gives
    no rows.
    """
    model = train(docs, labels, held_out, per_label, max_lines, document_lines, id_col, text_col)
    new = ("held_out", "score", "predicted")
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in new]
    scored = docs.select(*kept, F.coalesce(fold(F.col(id_col)) == held_out, F.lit(False)).alias("held_out"),
                         score_column(F.col(text_col), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
