"""Exact byte-level BPE encoding by dynamic programming over prefixes, and decoding.

For every prefix of a word exactly one token can be the last one of its
encoding. An automaton over the vocabulary finds the tokens that end at each
byte; a candidate is the last token there if the prefix before it ends in a
token that it may follow. Two tokens may follow each other if merging their
joined bytes gives these two again. Back-pointers from the end give the ids.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Iterator


import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from ledgerly.llm.pieces import Units, gather, rounds

#: Unicode white space and the pattern that splits text before merging.
SPACE = "\t-\r \x85\xa0  -     　"
WORDS = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
#: Pieces at whose borders the pattern above always splits: white space with the rest that follows it.
PIECES = regex.compile(rf"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
#: From this character on, the library's own splitter is asked, as tables of letters differ with their Unicode version.
LATE = "\u0530"
#: Most pairs of tokens whose test is remembered.
PAIRS = 300_000
#: The same white space before a space, for RE2.
ODD_SPACE = "[" + "".join(f"\\x{{{ord(c):x}}}" if c != "-" else c for c in SPACE) + "] "


def byte_of_char() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for.

    Printable Latin-1 characters stand for themselves; the other bytes, in
    order, for the characters from 256 on.
    """
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class ByteBpe:
    """A byte-level BPE vocabulary read from a tokenizers file.

    The first ``most`` words are remembered with their ids, so memory stays
    bounded; later ones are encoded anew in every round that they occur in.
    """

    def __init__(self, path: str, most: int = 600_000):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        to_byte = byte_of_char()
        vocab = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        as_bytes = {token: bytes(to_byte[c] for c in token) for token in vocab if token not in self.special}
        self.text = {i: content.encode() for content, i in self.special.items()} | {vocab[t]: b for t, b in as_bytes.items()}
        self.size = {i: len(b) for i, b in self.text.items()}
        self.most, self.pairs, self.words, self.edges = most, {}, {}, ({}, {})
        self.rank, self.parts, self.made = {}, {}, {}
        for rank, merge in enumerate(spec["model"]["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            pair, whole = (vocab[left], vocab[right]), vocab[left + right]
            self.rank.setdefault(pair, rank)
            if whole not in self.parts:
                self.parts[whole], self.made[whole] = pair, rank
        self.ids = {}
        for token, b in as_bytes.items():
            if self._whole(vocab[token]):
                self.ids[b.decode("latin-1")] = vocab[token]
        self.automaton = ahocorasick.Automaton()
        for key, i in self.ids.items():
            self.automaton.add_word(key, i)
        self.automaton.make_automaton()
        self.splits = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.splitter = Tokenizer.from_file(path).pre_tokenizer
        self.to_byte = to_byte
        top = max(self.text)
        in_order = [self.text.get(i, b"") for i in range(top + 1)]
        self.blob = np.frombuffer(b"".join(in_order), dtype=np.uint8)
        self.sizes = np.fromiter(map(len, in_order), dtype=np.int64, count=top + 1)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.dtype, self.code = (np.dtype("<u2"), "H") if top < 1 << 16 else (np.dtype("<u4"), "I")

    def _edge(self, token: int, side: int) -> list[tuple[int, float]]:
        """The tokens at one end of ``token`` while it is built, from the whole on, each with the rank of the merge that ends it."""
        out = self.edges[side].get(token)
        if out is None:
            out, part, until = [(token, float("inf"))], token, float("inf")
            while part in self.parts:
                until = self.made[part]
                part = self.parts[part][side]
                out.append((part, until))
            self.edges[side][token] = out
        return out

    def _crossed(self, left: int, right: int, before: float) -> bool:
        """Whether some merge would join the end of ``left`` and the start of ``right`` before rank ``before``."""
        for a, a_until in self._edge(left, 1):
            for b, b_until in self._edge(right, 0):
                rank = self.rank.get((a, b))
                # at equal rank the leftmost merge comes first: that inside the left token, then this one
                if rank is not None and rank < before and rank < a_until and rank <= b_until:
                    return True
        return False

    def _whole(self, token: int) -> bool:
        """Whether merging the token's own bytes gives the token, as for all single bytes."""
        if token not in self.parts:
            return len(self.text[token]) == 1
        left, right = self.parts[token]
        return self._whole(left) and self._whole(right) and not self._crossed(left, right, self.made[token])

    def may_follow(self, left: int, right: int) -> bool:
        return not self._crossed(left, right, float("inf"))

    def last_tokens(self, word: str) -> list[int]:
        """The unique last token of every prefix of ``word`` (its bytes as Latin-1 characters); -1 where none is known yet."""
        last = [-1] * (len(word) + 1)
        size, pairs = self.size, self.pairs
        for at, token in self.automaton.iter(word):
            if last[at + 1] < 0:
                start = at + 1 - size[token]
                if start:
                    pair = last[start] << 32 | token
                    follows = pairs.get(pair)
                    if follows is None:
                        if len(pairs) >= PAIRS:
                            pairs.clear()
                        follows = pairs[pair] = self.may_follow(last[start], token)
                    if not follows:
                        continue
                last[at + 1] = token
        return last

    def encode_word(self, word: str) -> list[int]:
        whole = self.ids.get(word)
        if whole is not None:
            return [whole]
        last, ids, at = self.last_tokens(word), [], len(word)
        while at:
            ids.append(last[at])
            at -= self.size[last[at]]
        return ids[::-1]

    def _words(self, piece: str) -> list[str]:
        if max(piece) < LATE:
            return WORDS.findall(piece)
        return [bytes(self.to_byte[c] for c in w).decode() for w, _ in self.splitter.pre_tokenize_str(piece)]

    def _word(self, word: str, memo: dict[str, bytes]) -> bytes:
        """Packed ids of one word, kept in the lasting memo while that has room and else in ``memo``."""
        ids = self.encode_word(word.encode().decode("latin-1"))
        packed = struct.pack(f"<{len(ids)}{self.code}", *ids)
        (self.words if len(self.words) < self.most else memo)[word] = packed
        return packed

    def _ids(self, piece: str, space: str, memo: dict[str, bytes]) -> bytes:
        """Packed ids of a piece after ``space``."""
        words = self._words(space + piece) if space + piece else []
        lasting, round_ = self.words.get, memo.get
        return b"".join([lasting(w) or round_(w) or self._word(w, memo) for w in words])

    def _plain(self, text: str) -> bytes:
        """Packed ids of a text without special tokens."""
        memo: dict[str, bytes] = {}
        return b"".join([self._ids(p, "", memo) for p in PIECES.findall(text)])

    def encode(self, text: str) -> bytes:
        """Packed little-endian ids of ``dtype``; special tokens' strings give their ids."""
        if not any(s in text for s in self.special):
            return self._plain(text)
        out = []
        for part in self.splits.split(text):
            if part in self.special:
                out.append(np.array([self.special[part]], dtype=self.dtype).tobytes())
            elif part:
                out.append(self._plain(part))
        return b"".join(out)

    def encode_all(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text; null is empty. Where every space starts a piece, pieces are looked up once a round."""
        for some in rounds(texts):
            odd = pc.match_substring_regex(some, ODD_SPACE)
            for special in self.special:
                odd = pc.or_(odd, pc.match_substring(some, special))
            odd = odd.to_numpy(zero_copy_only=False)
            units, memo = Units(pc.if_else(pa.array(odd), "", some)), {}
            lasting = self.words.get
            values = [lasting(" " + h) or self._ids(h, " ", memo) for h in units.heads] + [self._ids(t, "", memo) for t in units.tails]
            firsts, inverse = np.unique(units.codes[units.before[:-1], 0], return_inverse=True)  # of each text, without a space before it
            codes = units.codes
            codes[units.before[:-1], 0] = len(values) + inverse
            values += [self._ids(units.heads[k], "", memo) for k in firsts]
            ids, ends = gather(values, codes.ravel(), self.dtype)
            cuts = np.append(0, ends[1::2])[units.before].tolist()
            for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                yield np.frombuffer(self.encode(some[k].as_py()), dtype=self.dtype) if odd[k] else ids[a:b]

    def decode(self, ids: np.ndarray) -> str:
        """The tokens' bytes as text; bytes that are no UTF-8 become replacement characters."""
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        at = np.repeat(self.starts[ids] - ends + sizes, sizes) + np.arange(ends[-1] if len(ids) else 0)
        return self.blob[at].tobytes().decode("utf-8", "replace")


_loaded: dict[str, ByteBpe] = {}


def vocabulary(path: str) -> ByteBpe:
    """One vocabulary per worker process and file."""
    if path not in _loaded:
        _loaded[path] = ByteBpe(path)
    return _loaded[path]


def encode_documents(docs: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids",
                     decoded_col: str | None = None) -> DataFrame:
    """``docs`` with ``ids_col`` in place of the text: its ids as packed little-endian 32-bit integers.

    With ``decoded_col``, also the text that these ids decode to. A null or
    empty text has no ids. Other columns are kept (those named like the new
    ones are replaced) and repeated rows stay. Rows leave a task a round of
    texts at a time. An empty table gives no rows. ``path`` is a byte-level
    tokenizers file, the same on all machines.
    """
    new = [ids_col] + [decoded_col] * (decoded_col is not None)
    kept = [c for c in docs.columns if c not in (text_col, *new)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        for batch in batches:
            at, texts = 0, batch.column(text_col)
            for some in rounds(texts):
                ids = list(bpe.encode_all(some))
                columns = [batch.column(c).slice(at, len(some)) for c in kept] + [
                    pa.array([i.astype("<u4").tobytes() for i in ids], pa.binary())]
                if decoded_col is not None:
                    columns.append(pa.array([bpe.decode(i) for i in ids], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, [*kept, *new])
                at += len(some)
    kinds = T.StructType([docs.schema[c] for c in kept] + [T.StructField(ids_col, T.BinaryType())]
                         + [T.StructField(c, T.StringType()) for c in new[1:]])
    return docs.select(*[F.col(f"`{c}`") for c in (*kept, text_col)]).mapInArrow(run, kinds)


def decode_column(ids: Column, path: str) -> Column:
    """The text of packed ids; null stays null."""
    @F.arrow_udf("string")
    def texts(packed: pa.Array) -> pa.Array:
        bpe = vocabulary(path)
        return pa.array([None if p is None else bpe.decode(np.frombuffer(p, dtype="<u4")) for p in packed.to_pylist()],
                        pa.string())
    return texts(ids)
