"""Quality classifier: a linear-chain conditional random field over a document's lines.

Every line is good or bad. Its features describe its own characters and those
of the lines before and after it; the chain adds how states follow each other.
Forward-backward gives each line's probability of being good; their mean,
weighted by line length, is the document's share of good text; the score is a
logistic curve of a fixed slope over it, whose middle is the share that parts
the labels with the fewest errors.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np

#: The classes of bytes that line features count.
LETTER, UPPER, DIGIT, BLANK, MARK, SYMBOL, BANG = range(7)
PLAIN_MARKS = b".,;:'\"?()-"
#: Lines whose features are held at once.
MOST_LINES = 1 << 15


def _classes() -> np.ndarray:
    table = np.zeros((7, 256), dtype=np.uint8)
    codes = np.arange(256)
    upper = (codes >= 65) & (codes <= 90)
    table[UPPER] = upper
    table[LETTER] = upper | ((codes >= 97) & (codes <= 122)) | (codes >= 128)
    table[DIGIT] = (codes >= 48) & (codes <= 57)
    table[BLANK] = np.isin(codes, [9, 10, 11, 12, 13, 32])
    table[MARK] = np.isin(codes, list(PLAIN_MARKS))
    table[BANG] = codes == 33
    table[SYMBOL] = (codes > 32) & (codes < 127) & (table[[LETTER, DIGIT, MARK, BANG]].sum(axis=0) == 0)
    return table


CLASSES = _classes()


def word_hashes(flat: np.ndarray, at: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A polynomial hash, modulo 2 ** 64, of the bytes of each word, wherever it stands."""
    base, inverse = np.uint64(0x9E3779B97F4A7C15), np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
    def powers(of, n):
        return np.cumprod(np.concatenate([[np.uint64(1)], np.full(max(n - 1, 0), of, dtype=np.uint64)]), dtype=np.uint64)[:n]
    sums = np.concatenate([[np.uint64(0)], np.cumsum((flat.astype(np.uint64) + np.uint64(1)) * powers(base, len(flat)), dtype=np.uint64)])
    return (sums[ends] - sums[at]) * powers(inverse, len(flat))[at]


def own_features(flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(features, lengths in bytes) of some lines, each with its line break."""
    breaks = np.flatnonzero(flat == 10)
    starts = np.concatenate([[0], breaks[:-1] + 1])
    sizes = breaks - starts
    blank = CLASSES[BLANK][flat]
    begins = np.empty_like(blank)  # first byte of a word
    begins[0], begins[1:] = 1 - blank[0], (1 - blank[1:]) & blank[:-1]
    last = np.empty_like(blank)  # last byte of a word
    last[-1], last[:-1] = 0, (1 - blank[:-1]) & blank[1:]

    def total(flags):
        sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return (sums[breaks] - sums[starts]).astype(np.float64)
    per = {k: total(CLASSES[k][flat]) for k in (LETTER, UPPER, DIGIT, BLANK, MARK, SYMBOL, BANG)}
    words = total(begins)
    odd_end = total(last & (CLASSES[SYMBOL] | CLASSES[BANG])[flat])
    twin = np.zeros_like(blank)
    twin[1:] = (flat[1:] == flat[:-1]) & (1 - blank[1:])
    again = np.zeros_like(blank)  # first byte of a word that repeats the one before it
    at, ends = np.flatnonzero(begins), np.flatnonzero(last) + 1
    if len(at) > 1:
        hashes, line = word_hashes(flat, at, ends), np.searchsorted(breaks, at)
        again[at[1:]] = (hashes[1:] == hashes[:-1]) & (line[1:] == line[:-1])  # words of one line only, whatever stands around it
    n, w = np.maximum(sizes, 1), np.maximum(words, 1)
    ascii_letters = np.maximum(total(((flat < 128) & (CLASSES[LETTER][flat] == 1)).astype(np.uint8)), 1)
    own = np.stack([per[LETTER] / n, per[UPPER] / ascii_letters, per[DIGIT] / n, per[BLANK] / n, per[MARK] / n,
                    per[SYMBOL] / n, per[BANG] / n, np.minimum((sizes - per[BLANK]) / w / 20, 2), odd_end / w,
                    total(twin) / n, total(again) / (words + 4), np.log1p(sizes) / 8, (sizes == 0) * 1.0], axis=1)
    return own, sizes


def line_features(texts: list[bytes], step: int = 1 << 21) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, lengths in bytes, number of lines of each text) over the lines of all texts, in order.

    A text without line breaks, an empty one too, is one line. The columns are
    the line's own features, the same of the previous and of the next line of
    the text (zeros at its ends), and a constant. About ``step`` bytes, or one
    longer line, are looked at at a time.
    """
    flat = b"\n".join(texts) + b"\n"
    counts = np.fromiter((t.count(b"\n") + 1 for t in texts), dtype=np.int64, count=len(texts))
    found, at = [], 0
    while at < len(flat):
        stop = flat.rfind(b"\n", at, at + step) + 1 or flat.index(b"\n", at) + 1
        found.append(own_features(np.frombuffer(flat, dtype=np.uint8, count=stop - at, offset=at)))
        at = stop
    own, sizes = (np.concatenate(x) for x in zip(*found))
    first = np.zeros(len(sizes), dtype=bool)
    first[np.cumsum(counts) - counts] = True
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:] = own[:-1]
    before[first] = 0
    after[:-1] = own[1:]
    after[np.append(np.flatnonzero(first)[1:] - 1, len(own) - 1)] = 0
    return np.hstack([own, before, after, np.ones((len(own), 1))]), sizes, counts


def marginals(logits: np.ndarray, counts: np.ndarray, trans: np.ndarray, start: float, pairs: bool = False):
    """P(line is good) for lines of chains of ``counts``; with ``pairs`` also the expected transitions and log-partition sum.

    ``logits``: a line's evidence for good over bad; ``trans[a, b]``: weight of
    state b after a (1 is good); ``start``: weight of a good first line. All
    chains advance together, one line a step.
    """
    order = np.argsort(-counts, kind="stable")
    begin, sizes = (np.cumsum(counts) - counts)[order], counts[order]
    emit = np.stack([np.zeros_like(logits), logits], axis=1)
    fore, back = np.empty_like(emit), np.zeros_like(emit)
    fore[begin] = emit[begin] + [0, start]
    active = np.searchsorted(-sizes, -np.arange(1, sizes[0] + 1), side="right") if len(sizes) else []
    for t in range(1, len(active)):
        at = begin[:active[t]] + t
        step = fore[at - 1][:, :, None] + trans
        fore[at] = np.logaddexp(step[:, 0], step[:, 1]) + emit[at]
    for t in range(len(active) - 1, 0, -1):
        at = begin[:active[t]] + t
        step = trans + (emit[at] + back[at])[:, None, :]
        back[at - 1] = np.logaddexp(step[:, :, 0], step[:, :, 1])
    both = fore + back
    good = 1 / (1 + np.exp(np.clip(both[:, 0] - both[:, 1], -500, 500)))
    if not pairs:
        return good
    ends = begin + sizes - 1
    whole = np.repeat(np.logaddexp(fore[ends, 0], fore[ends, 1])[np.argsort(order)], counts)
    inner = np.ones(len(logits), dtype=bool)
    inner[begin] = False
    at = np.flatnonzero(inner)
    joint = np.exp(fore[at - 1][:, :, None] + trans + (emit[at] + back[at])[:, None, :] - whole[at][:, None, None])
    return good, joint, whole


@dataclass
class LineCrf:
    """A trained model: feature means, scales and weights, transitions, start weight, and the curve from good share to score."""

    mean: np.ndarray = field(default_factory=lambda: np.zeros(1))
    scale: np.ndarray = field(default_factory=lambda: np.ones(1))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(1))
    trans: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    start: float = 0.0
    slope: float = 1.0
    shift: float = 0.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.weights

    def fit(self, x: np.ndarray, sizes: np.ndarray, counts: np.ndarray, labels: np.ndarray, rounds: int = 3,
            steps: int = 200, ridge: float = 1e-3) -> LineCrf:
        """Learn from documents' labels (1 good). Lines first take their document's label.

        In later rounds a bad document's lines that look good to the model are
        taken as good, all but its worst ones, as bad documents may hold good
        passages; a good document's lines stay good.
        """
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-6
        self.mean[-1], self.scale[-1] = 0, 1
        z, doc = (x - self.mean) / self.scale, np.repeat(np.arange(len(counts)), counts)
        weight = len(labels) / 2 / np.maximum(np.bincount(labels, minlength=2), 1)
        share = (weight[labels] / np.maximum(counts, 1))[doc] * len(doc) / len(labels)  # documents count alike, and so do both labels
        y = labels[doc].astype(np.float64)
        self.weights, self.trans, self.start = np.zeros(x.shape[1]), np.array([[1.0, -1], [-1, 1]]), 0.0
        for k in range(rounds):
            self._descend(z, counts, y, share, steps, ridge)
            good = marginals(z @ self.weights, counts, self.trans, self.start)
            worst = np.full(len(counts), 2.0)
            np.minimum.at(worst, doc, good)
            y = np.where(labels[doc] == 1, 1.0, (good > 0.5) & (good > worst[doc] + 1e-9))
        self._calibrate(self.shares(good, sizes, counts), labels, weight)
        return self

    def _descend(self, z, counts, y, share, steps, ridge) -> None:
        """Adam on the conditional log-likelihood of the line states ``y``."""
        state = np.concatenate([self.weights, self.trans.ravel(), [self.start]])
        m, v, n, d = np.zeros_like(state), np.zeros_like(state), share.sum(), z.shape[1]
        begin = np.cumsum(counts) - counts
        inner = np.ones(len(y), dtype=bool)
        inner[begin] = False
        at = np.flatnonzero(inner)
        hits = np.zeros((len(at), 2, 2))
        hits[np.arange(len(at)), y[at - 1].astype(int), y[at].astype(int)] = 1
        for k in range(1, steps + 1):
            trans = state[d:d + 4].reshape(2, 2)
            good, joint, _ = marginals(z @ state[:d], counts, trans, state[-1], pairs=True)
            off = share * (good - y)
            grad = np.concatenate([z.T @ off, np.einsum("i,ijk->jk", share[at], joint - hits).ravel(), [off[begin].sum()]]) / n
            grad += ridge * state
            m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
            state = state - 0.1 * (m / (1 - 0.9 ** k)) / (np.sqrt(v / (1 - 0.99 ** k)) + 1e-9)
        self.weights, self.trans, self.start = state[:d], state[d:d + 4].reshape(2, 2), float(state[-1])

    @staticmethod
    def shares(good: np.ndarray, sizes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Share of good text in each document: mean of the lines' marginals by length (an empty line counts as one byte)."""
        begin, w = np.cumsum(counts) - counts, np.maximum(sizes, 1)
        return np.add.reduceat(good * w, begin) / np.add.reduceat(w, begin) if len(counts) else np.empty(0)

    def _calibrate(self, shares: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> None:
        """Logistic curve over the share: the cut with the fewest weighted errors gets score 0.5."""
        order = np.argsort(shares, kind="stable")
        s, bad = shares[order], (labels[order] == 0) * weight[0]
        fine = (labels[order] == 1) * weight[1]
        errors = np.concatenate([[0], np.cumsum(fine)]) + np.concatenate([[bad.sum()], bad.sum() - np.cumsum(bad)])
        edges = np.concatenate([[0], (s[1:] + s[:-1]) / 2, [1]])
        best = np.flatnonzero(errors <= errors.min() + 1e-9)
        cut = float(np.mean(edges[[best[0], best[-1]]])) if len(best) else 0.5
        self.slope, self.shift = 12.0, -12.0 * min(max(cut, 0.02), 0.98)

    def score(self, texts: list[bytes], most_lines: int = MOST_LINES) -> np.ndarray:
        """Score of every text from 0 to 1; whole texts, a bounded number of lines at a time."""
        out = []
        for some in chunks(texts, most_lines=most_lines):
            if len(some) == 1 and some[0].count(b"\n") >= most_lines:
                shares = np.array([self.long_share(some[0], most_lines)])
            else:
                x, sizes, counts = line_features(some)
                shares = self.shares(marginals(self.logits(x), counts, self.trans, self.start), sizes, counts)
            out.append(1 / (1 + np.exp(-(self.slope * shares + self.shift))))
        return np.concatenate(out) if out else np.empty(0)

    def long_share(self, text: bytes, most_lines: int) -> float:
        """``shares`` of one text, features and both passes of the chain in blocks of lines.

        The way forward keeps its state at the start of each block; on the way
        back a block's features are made again, so only one block is held.
        """
        starts, states, state = blocks(text, most_lines), [], None
        for begin, end in starts:
            states.append(state)
            state = self._forward(self._block(text, begin, end)[0], state)[-1]
        good = total = 0.0
        after = None  # log-odds that the lines behind give to the state of the block's last line
        for (begin, end), before in zip(reversed(starts), reversed(states)):
            logits, sizes = self._block(text, begin, end)
            ahead = self._forward(logits, before)
            back = np.empty_like(ahead)
            now = 0.0 if after is None else after
            (t00, t01), (t10, t11) = self.trans.tolist()
            for k in range(len(logits) - 1, -1, -1):
                back[k] = now
                y = logits[k] + now
                now = _log_add(t11 + y, t10) - _log_add(t01 + y, t00)
            after = now
            w = np.maximum(sizes, 1)
            good += float((w / (1 + np.exp(-np.clip(ahead + back, -500, 500)))).sum())
            total += float(w.sum())
        return good / total

    def _block(self, text: bytes, begin: int, end: int) -> tuple[np.ndarray, np.ndarray]:
        """(logits, sizes) of the lines of text[begin:end], which see the lines around the block."""
        first = text.rfind(b"\n", 0, begin - 1) + 1 if begin else 0
        last = text.find(b"\n", end)
        part = text[first:len(text) if last < 0 else last] if end <= len(text) else text[first:]
        x, sizes, _ = line_features([part])
        skip, n = int(begin > 0), text.count(b"\n", begin, end) + (end > len(text))
        return self.logits(x[skip:skip + n]), sizes[skip:skip + n]

    def _forward(self, logits: np.ndarray, state: float | None) -> np.ndarray:
        """Log-odds of good for each line, given the lines up to it."""
        out = np.empty(len(logits))
        (t00, t01), (t10, t11) = self.trans.tolist()
        for k, e in enumerate(logits.tolist()):
            state = e + (self.start if state is None else _log_add(state + t11, t01) - _log_add(state + t10, t00))
            out[k] = state
        return out


def _log_add(a: float, b: float) -> float:
    return max(a, b) + math.log1p(math.exp(-abs(a - b)))


def blocks(text: bytes, most_lines: int, most: int = 1 << 21) -> list[tuple[int, int]]:
    """(begin, end) of runs of whole lines, breaks included, of at most ``most_lines`` lines and ``most`` bytes or one longer line.

    The last end lies one beyond the text, as if its last line had a break.
    """
    out, begin = [], 0
    while begin <= len(text):
        end = begin
        for _ in range(most_lines):
            stop = text.find(b"\n", end) + 1 or len(text) + 1
            if end > begin and stop - begin > most:
                break
            end = stop
            if end > len(text):
                break
        out.append((begin, end))
        begin = end
    return out


def chunks(texts: list[bytes], most: int = 1 << 22, most_lines: int = MOST_LINES) -> Iterator[list[bytes]]:
    """Runs of texts of at most ``most`` bytes and ``most_lines`` lines, or one longer text."""
    held, n, lines = [], 0, 0
    for t in texts:
        own = t.count(b"\n") + 1
        if held and (n + len(t) > most or lines + own > most_lines):
            yield held
            held, n, lines = [], 0, 0
        held.append(t)
        n, lines = n + len(t) + 1, lines + own
    if held:
        yield held
