"""Texts as codes of their space-separated pieces, so that the distinct pieces of a round are tokenized once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text per round, which bounds the arrays made from them; a longer text is a round of its own.
ROUND = 8 << 20
#: Latin letters, which are letters in every version of Unicode and have one lower case, and ASCII punctuation after them.
SIMPLE = r"\A(?P<head>[A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{12F}\x{131}-\x{24F}]+)(?P<tail>[!-/:-@\[-`{-~]*)\z"


def rounds(texts: pa.Array) -> Iterator[pa.Array]:
    """Slices of a batch's texts; nulls as empty texts."""
    texts, at = texts.fill_null(""), 0
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    while at < len(texts):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + ROUND, side="right")))
        yield texts.slice(at, stop - at)
        at = stop


def _coded(values: pa.Array) -> tuple[list[str], np.ndarray]:
    coded = values.dictionary_encode()
    return coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy().astype(np.int64)


class Units:
    """The space-separated pieces of some texts, each as a head and a tail.

    Where every splitter cuts a piece, between its letters and the ASCII
    punctuation after them, the head is the letters and the tail the rest; any
    other piece is all head. ``heads`` and ``tails`` are the distinct ones,
    ``codes`` has two numbers for every piece in order, into heads followed by
    tails, and ``before`` the number of pieces before each text and after the
    last.
    """

    def __init__(self, texts: pa.Array, lower: bool = False):
        lists = pc.split_pattern(texts, " ")
        pieces = lists.flatten().dictionary_encode()
        counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
        self.before = np.concatenate([[0], np.cumsum(counts)])
        parts = pc.extract_regex(pieces.dictionary, SIMPLE)
        heads, tails = (pc.if_else(parts.is_valid(), pc.struct_field(parts, k), other) for k, other in ((0, pieces.dictionary), (1, "")))
        if lower:
            heads = pc.if_else(parts.is_valid(), pc.utf8_lower(heads), heads)
        self.heads, head = _coded(heads)
        self.tails, tail = _coded(tails)
        self.codes = np.stack([head, tail + len(self.heads)], axis=1)[pieces.indices.to_numpy()]


def gather(values: list[bytes], codes: np.ndarray, dtype: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """The packed integers of ``values[code]`` for all codes joined, and the end of each code's part."""
    sizes = np.fromiter(map(len, values), dtype=np.int64, count=len(values)) // dtype.itemsize
    starts, flat = np.cumsum(sizes) - sizes, np.frombuffer(b"".join(values), dtype=dtype)
    n = sizes[codes]
    ends = np.cumsum(n)
    short = np.int32 if len(flat) < 1 << 31 and (not len(ends) or ends[-1] < 1 << 31) else np.int64
    at = np.repeat((starts[codes] - ends + n).astype(short), n)
    at += np.arange(len(at), dtype=short)
    return flat[at], ends
