"""Token ids in Arrow stream files with fixed-size-list batches.

A file is one Arrow stream: every row is a sequence of the same length, with
its mask and the marks of document ends, and every batch but the last has the
same number of rows. Mapped into memory, sequence i lies in batch i // rows at
a known place, so it is read without copying. Documents are dealt to tasks by
ranges of their ids and stay whole within a file; Spark's writer commits the
files, so a lost task is simply run again.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerly.llm.common import written
from ledgerly.llm.pieces import Units, gather, rounds

#: Most words that go to the tokenizer as one text, and the word between them.
JOINED, MARK = 2_000, "\x00"


#: Fixed value: the splitter's pattern that cuts words as ``PieceEncoder`` does, white space being dropped.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def by_words(config: dict) -> bool:
    """Whether a tokenizer lower-cases, drops white space, never joins what it separates, and cuts letters from punctuation."""
    steps = (config.get("normalizer") or {}).get("normalizers") or []
    cut = ((config.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
    return ([n["type"] for n in steps] == ["NFC", "Replace", "Lowercase"] and steps[1]["pattern"] == {"Regex": r"\s+"} and steps[1]["content"] == " "
            and cut.get("type") == "Split" and cut["behavior"] == "Removed" and cut["invert"] and cut["pattern"] == {"Regex": WORDS}
            and config.get("post_processor") is None)


class PieceEncoder:
    """Encodes texts by the words of their space-separated pieces; each distinct word of a round goes to the tokenizer once.

    That holds for tokenizers that ``by_words`` knows; with any other, whole
    texts go to the tokenizer. The first ``most`` words are remembered, later
    ones for one round only, so memory stays bounded.
    """

    def __init__(self, path: str, most: int = 800_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.by_words = by_words(json.loads(self.tokenizer.to_str()))
        self.mark = self._ids(MARK)
        self.most, self.memo = most, {"": b""}

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=self.dtype)

    def _new(self, pieces: list[str]) -> dict[str, bytes]:
        """Ids of each piece. Pieces are encoded together with a word of one id between them, at which the ids are cut."""
        alone = [p for p in pieces if MARK in p] if len(self.mark) == 1 else pieces
        out, width = {p: self._ids(p).tobytes() for p in alone}, self.dtype.itemsize
        rest = [p for p in pieces if p not in out]
        for at in range(0, len(rest), JOINED):
            some = rest[at:at + JOINED]
            ids = self._ids(f" {MARK} ".join(some))
            cuts = (np.flatnonzero(ids == self.mark[0]) * width).tolist()
            packed = ids.tobytes()
            out.update(zip(some, (packed[a:b] for a, b in zip([0, *(c + width for c in cuts)], [*cuts, len(packed)])), strict=True))
        return out

    def encode(self, texts: pa.Array) -> Iterator[bytes]:
        """The ids of each text as packed integers of ``dtype``; null is empty."""
        if not self.by_words:
            yield from (self._ids(t.as_py() or "").tobytes() for t in texts)
            return
        for some in rounds(texts):
            units = Units(pc.replace_substring(some, "\n", " "), lower=True)
            words, memo = units.heads + units.tails, self.memo
            found = list(map(memo.get, words))
            late = self._new([w for w in dict.fromkeys(words) if w not in memo])
            if len(memo) < self.most:
                memo.update(late)
            ids, ends = gather([late[w] if f is None else f for w, f in zip(words, found)], units.codes.ravel(), self.dtype)
            ends = np.append(0, ends[1::2])[units.before]
            packed, cuts = ids.tobytes(), (ends * self.dtype.itemsize).tolist()
            yield from (packed[a:b] for a, b in zip(cuts, cuts[1:]))


_encoders: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """One encoder per worker process and tokenizer."""
    if path not in _encoders:
        _encoders[path] = PieceEncoder(path)
    return _encoders[path]


def file_schema(length: int, ids: np.dtype, **notes) -> pa.Schema:
    return pa.schema([("ids", pa.list_(pa.from_numpy_dtype(ids), length)), ("mask", pa.list_(pa.bool_(), length)),
                      ("ends", pa.list_(pa.bool_(), length)), ("doc_ids", pa.list_(pa.int64()))],
                     metadata={"sequences": json.dumps(notes | {"length": length})})


def make_file(doc_ids: list, ids: list[bytes], dtype: np.dtype, length: int, rows: int, **notes) -> bytes:
    """An Arrow stream of whole documents, in order: the last sequence is padded with 0, masked out.

    ``doc_ids`` of a row are the documents whose last id lies in it.
    """
    flat = np.frombuffer(b"".join(ids), dtype=dtype)
    sizes = np.fromiter((len(x) // dtype.itemsize for x in ids), dtype=np.int64, count=len(ids))
    last = np.cumsum(sizes) - 1
    n = -(-len(flat) // length)
    mask = np.arange(n * length) < len(flat)
    ends = np.zeros(n * length, dtype=bool)
    ends[last] = True
    def lists(values):
        return pa.FixedSizeListArray.from_arrays(pa.array(values), length)
    per_row = np.searchsorted(last, np.arange(n + 1) * length)
    columns = [lists(np.pad(flat, (0, n * length - len(flat)))), lists(mask), lists(ends),
               pa.ListArray.from_arrays(pa.array(per_row, pa.int32()), pa.array(doc_ids, pa.int64()))]
    schema = file_schema(length, dtype, rows=rows, **notes)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, schema) as out:
        out.write_table(pa.Table.from_arrays(columns, schema=schema), max_chunksize=rows)
    return sink.getvalue().to_pybytes()


class Sequences:
    """Random access to the sequences of one file, without copies: views of the mapped bytes."""

    def __init__(self, source):
        """``source``: a local path, which is mapped, or a buffer."""
        reader = pa.ipc.open_stream(pa.memory_map(source) if isinstance(source, str) else pa.BufferReader(source))
        self.notes = json.loads(reader.schema.metadata[b"sequences"])
        self.batches = list(reader)

    def __len__(self) -> int:
        return sum(b.num_rows for b in self.batches)

    def __getitem__(self, i: int):
        """(ids as a numpy view, mask, ends) of sequence ``i``; the masks are Arrow slices, a bit per token."""
        batch, row = divmod(i, self.notes["rows"])
        at = row * self.notes["length"]
        ids, mask, ends = (self.batches[batch].column(k).values.slice(at, self.notes["length"]) for k in range(3))
        return ids.to_numpy(zero_copy_only=True), mask, ends

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(doc_id, place of its first id in the file, its ids) in order."""
        if not self.batches:
            return
        ids, mask, ends = (np.concatenate([b.column(k).values.to_numpy(zero_copy_only=k == 0) for b in self.batches]) for k in range(3))
        doc_ids = [d for b in self.batches for d in b.column(3).values.to_pylist()]
        start = 0
        for doc, end in zip(doc_ids, (np.flatnonzero(ends & mask) + 1).tolist(), strict=True):
            yield doc, start, ids[start:end]
            start = end


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, length: int = 2048, rows: int = 64,
                 file_tokens: int = 1 << 23, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every whole text, append ``end_id``, and write the ids in ascending order of document id.

    A null text is empty and gives the end id alone; null ids come last;
    repeated rows are written as often as they occur, equal ids in the order
    of their texts. A file holds about ``file_tokens`` ids, or one longer
    document. ``tokenizer`` is the path of a tokenizers file, the same on all
    machines. Other columns are not read. An empty table gives empty files.
    """
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_all = encoder(tokenizer)
        dtype = encode_all.dtype
        end, part, place = np.array([end_id], dtype=dtype).tobytes(), TaskContext.get().partitionId(), 0
        held: tuple[list, list] = ([], [])
        size = 0
        def file():
            return pa.RecordBatch.from_arrays([pa.array([make_file(*held, dtype, length, rows, part=part, place=place)], pa.binary())], ["f"])
        for batch in batches:
            for doc, ids in zip(batch.column("id").to_pylist(), encode_all.encode(batch.column("text"))):
                if held[0] and size + len(ids) > file_tokens * dtype.itemsize:
                    yield file()
                    held, size, place = ([], []), 0, place + 1
                held[0].append(doc)
                held[1].append(ids + end)
                size += len(ids) + len(end)
        if held[0]:
            yield file()

    order = [F.col("id").isNull(), F.col("id")]
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    dealt = texts.repartitionByRange(*order).sortWithinPartitions(*order, "text")
    # a stream ends by itself; the line end that the writer adds lies behind it
    (dealt.mapInArrow(encode, "f binary").select(F.col("f").cast("string").alias("value"))
     .write.option("maxRecordsPerFile", 1).text(path))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of the files under ``path``: doc_id, start (ids of all documents before it), n_tokens, ids_crc32.

    Each file is read by itself; their lengths are summed up over one row per file.
    """
    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for content in (c.as_buffer() for batch in batches for c in batch.column("content")):
            if content.size:
                file = Sequences(content)
                found = [(file.notes["part"], file.notes["place"], doc, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()))
                         for doc, start, ids in file.documents()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), (
                    pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()))],
                    ["part", "place", "doc_id", "start", "n_tokens", "ids_crc32"])
    read = spark.read.format("binaryFile").load(path).select("content").mapInArrow(
        parse, "part int, place int, doc_id long, start long, n_tokens long, ids_crc32 long")
    rows = written(read, "tokens")
    sizes = rows.groupBy("part", "place").agg(F.sum("n_tokens").alias("size"))
    before = F.sum("size").over(W.orderBy("part", "place")) - F.col("size")
    files = sizes.select("part", "place", before.alias("before"))
    return rows.join(files, ["part", "place"]).select("doc_id", (F.col("before") + F.col("start")).alias("start"), "n_tokens", "ids_crc32")
