"""Lexical search, whitening and license scans against brute force, and on nulls, empty, long, tied and repeated rows."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerly.llm import lexical, license_scan, whitening

DOCS = "doc_id long, text string, block long, term string, q long, id string, rid long, n long"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x", 2, "y", 3, 4) for i, t in rows], DOCS)


# Lexical search

def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in text or ""))


def ranked(docs, items, k):
    """Brute force: [(item, rank, document, score)] over rows of (id, text)."""
    docs = [(i, Counter(terms(t))) for i, t in docs]
    docs = [(i, c) for i, c in docs if c]
    n, total = len(docs), sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    out = []
    for item, text in items:
        rows = []
        for i, c in docs:
            m = 25 + 75 * sum(c.values()) * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in terms(text) if t in c)
            if s > 0:
                rows.append((-s, i is None, i or 0))
        out += [(item, r + 1, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(rows)[:k])]
    return out


def found(spark, docs, items, **more):
    index = lexical.index(docs, **{k: v for k, v in more.items() if k in ("block_docs", "pivots")})
    items = spark.createDataFrame(items, "item_id long, text string").withColumn("score", F.lit("clash")).withColumn("block", F.lit(1))
    rows = lexical.search(index, items, **{k: v for k, v in more.items() if k not in ("block_docs", "pivots")})
    assert rows.columns == ["item_id", "rank", "doc_id", "score"]
    return [tuple(r) for r in rows.collect()]


@pytest.mark.parametrize("seed, block_docs, pivots, seeds", [(1, 4, 8, 1), (2, 1000, 1, 1), (3, 3, 200, 2)])
def test_search_finds_what_a_full_scan_finds(spark, seed, block_docs, pivots, seeds):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(120)]
    pick = lambda n: " ".join(r.choices(words, [1 / (i + 1) for i in range(120)], k=n))
    rows = [(i, pick(r.randint(1, 60))) for i in range(150)]
    rows += [(1000 + i, rows[0][1]) for i in range(40)] + rows[:5] + [(None, rows[1][1]), (9000, pick(5000)), (9001, ""), (9002, None), (9003, "?!")]
    items = [(i, pick(r.randint(1, 25))) for i in range(20)] + [(50, rows[0][1] + " " + rows[0][1]), (51, None), (52, "nowhere to be found"), (53, ""), (3, "w7 W7")]
    got = found(spark, docs_of(spark, rows), items, k=10, block_docs=block_docs, pivots=pivots, seeds=seeds)
    key = lambda x: tuple((v is None, v or 0) for v in x)
    assert sorted(got, key=key) == sorted(ranked(rows, items, 10), key=key)


def test_search_over_nothing(spark):
    assert found(spark, docs_of(spark, []), [(1, "a")]) == []
    assert found(spark, docs_of(spark, [(1, "a"), (2, None)]), []) == []
    assert found(spark, docs_of(spark, [(1, None), (2, "..")]), [(1, "a")]) == []


def test_blocks_hold_every_posting_and_its_maximum(spark):
    rows = [(i, f"a b{i % 3} c{i}") for i in range(30)]
    index = lexical.index(docs_of(spark, rows), block_docs=5, pivots=3)
    assert index.n_docs == 30 and index.n_terms == 90
    seen, sizes = Counter(), []
    for b in index.blocks.collect():
        members, tfs = np.frombuffer(b.members, "<u2"), np.frombuffer(b.tfs, "<u4").astype(np.int64)
        values = lexical.values_of(tfs, np.array(b.lengths)[members], 30, 90)
        sizes.append(len(b.ids))
        for place, term in enumerate(b.terms.split(" ")):
            own = slice(b.starts[place], b.starts[place + 1])
            assert values[own].max() == b.maxima[place]
            seen.update((b.ids[m], term) for m in members[own])
    assert seen == Counter((i, t) for i, text in rows for t in terms(text)) and max(sizes) < 20


def test_a_list_is_skipped_only_below_the_bound():
    r = np.random.default_rng(4)
    for _ in range(200):
        values = r.integers(0, 5, (6, 9)) * r.integers(0, 2, (6, 9))
        weights = r.integers(0, 4, (3, 6))
        exact = weights @ values
        least = r.integers(0, 40, 3)
        got = lexical.walk(weights, values.max(axis=1), values, least)
        assert (got == np.where(exact >= np.maximum(least, 1)[:, None], exact, -1)).all()


# Whitening

def vectors_of(spark, rows):
    return spark.createDataFrame([(i, v, "x", "y") for i, v in rows], "vec_id long, embedding array<float>, x string, component string")


@pytest.mark.parametrize("spread", [[9, 5, 3, 1, 1], [4, 4, 4, 4, 0.1]])
def test_whitening_against_numpy(spark, spread):
    r = np.random.default_rng(5)
    data = (r.standard_normal((300, 5)) * spread @ np.linalg.qr(r.standard_normal((5, 5)))[0]).astype(np.float32) + np.float32(3)
    rows = [(i, v.tolist()) for i, v in enumerate(data)] + [(i, data[7].tolist()) for i in range(400, 460)] + [(None, data[8].tolist())]
    rows += [(600, None), (601, [1.0, None, 1.0, 1.0, 1.0]), (602, [math.nan] * 5), (603, [math.inf] * 5), (604, [1.0]), (605, [])]
    got = whitening.whiten(vectors_of(spark, rows)).collect()
    x = np.floor(256 * data.astype(np.float64))
    fit = np.unique(x, axis=0)
    mean, n = fit.mean(axis=0), len(fit)
    value, vector = np.linalg.eigh((fit - mean).T @ (fit - mean) / n)
    want = (x - mean) @ vector[:, ::-1][:, :4] / np.sqrt(value[::-1][:4])
    by = {(g.vec_id, g.component): g for g in got}
    assert {g.vec_id for g in got} == {*range(300), *range(400, 460), None} and len(got) == 4 * 361
    mine = np.array([[by[i, k].whitened for k in (1, 2, 3, 4)] for i in range(300)])
    assert np.abs(mine * np.sign((mine * want).sum(axis=0)) - want).max() < 1e-9
    sums = fit.sum(axis=0)
    for i in (0, 7, 299):
        assert by[i, 1].n == n and by[i, 1].deviation == sum((n * int(a) - int(s)) ** 2 for a, s in zip(x[i], sums))
    assert all(abs(by[0, k].explained - value[-k] / value.sum()) < 1e-9 for k in (1, 2, 3, 4))
    assert len({g.identity_error for g in got}) == 1 and got[0].identity_error < 1e-9
    assert by[400, 2].whitened == by[7, 2].whitened and by[None, 3].whitened == by[8, 3].whitened


@pytest.mark.parametrize("gap", [0.0, 1e-13, 1e-9, 1e-6, 1e-3])
def test_refined_vectors_of_clustered_eigenvalues(gap):
    r = np.random.default_rng(6)
    q = np.linalg.qr(r.standard_normal((40, 40)))[0]
    value = np.concatenate([np.linspace(1, 2, 34), 5 + gap * np.arange(6)])
    a = (q * value) @ q.T
    a = (a + a.T) / 2
    e, x = whitening.refined(a)
    assert np.abs(x.T @ x - np.eye(40)).max() < 1e-15
    assert np.abs(a.astype(np.longdouble) @ x - x * e).max() < 1e-14
    assert np.abs(e.astype(float) - np.linalg.eigvalsh(a)).max() < 1e-13


def test_whitening_of_few_vectors(spark):
    assert whitening.whiten(vectors_of(spark, [])).count() == 0
    assert whitening.whiten(vectors_of(spark, [(1, None), (2, [])])).count() == 0
    assert whitening.whiten(vectors_of(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0  # no variance
    two = whitening.whiten(vectors_of(spark, [(1, [0.0, 0.0]), (2, [3.0, 4.0]), (2, [3.0, 4.0])])).collect()
    assert [g.component for g in two] == [1, 1, 1] and {g.n for g in two} == {2}
    assert sorted(abs(round(g.whitened, 12)) for g in two) == [1.0, 1.0, 1.0]
    assert {g.deviation for g in two} == {768**2 + 1024**2}


def test_moments_are_exact_for_large_entries(spark):
    rows = [(i, [2.0**40 + i, float(i * i)]) for i in range(50)]
    fit = vectors_of(spark, rows).select(whitening.scaled(F.col("embedding")).alias("x")).distinct()
    x = [[int(math.floor(256 * float(np.float32(c)))) for c in v] for _, v in rows]
    x = [list(t) for t in {tuple(v) for v in x}]
    n, sums, v = whitening.moments(fit, 2)
    assert n == len(x) and sums == [sum(r[j] for r in x) for j in (0, 1)]
    assert all(v[i, j] == sum((n * r[i] - sums[i]) * (n * r[j] - sums[j]) for r in x) // n for i in (0, 1) for j in (0, 1))


# License scans

def scanned(text, rules, base):
    """Brute force: every rule at every place of its keyword, then all pairs of detections."""
    ws = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in text or ""))

    def places(rules):
        for r in rules:
            for i, w in enumerate(ws):
                if w == r.keyword:
                    window = [*ws[max(0, i - 16):i], "<" + w, *ws[i + 1:i + 25]]
                    if m := re.search(f"(?:^| )({r.pattern})(?: |$)", " ".join(window)):
                        start = i - m[1].split("<")[0].count(" ")
                        yield start, start + len(m[1].split(" ")), r.level, r.rule, r.label
    own = list(places(rules))
    beats = lambda o, d: o[0] <= d[0] and o[1] >= d[1] and (o[2] < d[2] or o[2] == d[2] and (o[1] - o[0] > d[1] - d[0] or o[3] < d[3]))
    return len(ws), sorted(places(base)), sorted(d for d in own if not any(beats(o, d) for o in own))


LICENSES = [(1, "Released under the MIT License."), (2, "Licensed under the Apache License, Version 2.0; all rights RESERVED"),
            (3, "CC-BY-SA 4.0, CC BY, cc by nd"), (4, None), (5, ""), (6, "..."), (7, "GNU General Public License v3 or later. " * 3000),
            (7, "GNU General Public License v3 or later. " * 3000), (None, "Copyright (c) 2020 Acme. All rights reserved."),
            (8, "réservés tous droits réservés; K license"), (9, "licensemit license"), (10, "cc\x00by\x7fGENERAL\npublic\tlicense all rights all rights reserved")]


def test_license_scan_against_all_places(spark):
    r = random.Random(7)
    words = sorted({w for rule in license_scan.RULES for w in re.findall(r"[a-z0-9]+", rule.pattern)})
    rows = LICENSES + [(100 + i, " ".join(r.choice(words) for _ in range(60)) if i % 2 else
                        ". ".join(re.sub(r"\([^()]*\)\??|[<?]|\[[^\]]*\]\S*", "", r.choice(license_scan.RULES).pattern) for _ in range(8))) for i in range(60)]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, scan string, n_words int")
    got = license_scan.scan(docs).collect()
    plain = lambda d: [tuple(x) for x in d]
    key = lambda x: repr(x)
    mine = sorted(((g.doc_id, g.n_words, sorted(plain(g.base)), sorted(plain(g.detections))) for g in got), key=key)
    want = sorted(((i, *scanned(t, license_scan.RULES, license_scan.BASE)) for i, t in rows if t is None or len(t) < 10_000), key=key)
    assert [m for m in mine if m[1] < 10_000] == want
    long = [g for g in got if g.doc_id == 7]
    assert len(long) == 2 and all(len(g.base) == 3000 and len(g.detections) == 3000 and {d.label for d in g.detections} == {"gpl-3.0"} for g in long)


def test_license_digest(spark):
    docs = spark.createDataFrame(LICENSES, "doc_id long, text string")
    rows = {r.doc_id: r for r in license_scan.digest(license_scan.scan(docs)).collect()}
    assert tuple(rows[1])[1:] == (5, 0, None, None, "", "mit", 1.0)
    assert rows[2].base_labels == "reserved" and rows[2].labels == "apache-2.0,reserved" and rows[2].first_word == 8
    assert (rows[3].n_base, rows[3].first_word, rows[3].last_word) == (3, 0, 7) and rows[3].labels == "cc-by,cc-by-nd,cc-by-sa-4.0"
    assert [tuple(rows[i])[1:] for i in (4, 5, 6)] == [(0, 0, None, None, "", "", 0.0)] * 3
    assert (rows[10].base_labels, rows[10].n_base, rows[10].last_word) == ("cc-by,gpl,reserved", 3, 7)
    assert license_scan.digest(license_scan.scan(docs.limit(0))).count() == 0


def test_every_rule_is_bounded_and_finds_its_own_words():
    assert len(license_scan.RULES) >= 200
    for bad in ("a 1 no keyword", "a 1 <two <keywords", "a 1 <open .* end", "a 1 <plural(s)?"):
        with pytest.raises(ValueError):
            license_scan.license_rules.parse(bad)
    for rule in license_scan.RULES:
        words = re.sub(r"\[0-9\]\{4\}", "2020", re.sub(r"\[a-z0-9\]\+", "acme", rule.pattern))
        words = re.sub(r"\( [^()]*\)\?|\([^()]* \)\?", "", re.sub(r"\([^()]*\([^()]*\)\?[^()]*\)\?", "", words))
        words = re.sub(r"\(([^()|]*)\|[^()]*\)", r"\1", re.sub(r"\([^()]*\)\?|.\?", "", words))
        assert re.search(f"(?:^| )({rule.pattern})(?: |$)", words.strip()), (rule, words)
        assert len(words.split()) <= license_scan.BEFORE + license_scan.AFTER
        assert rule.pattern.split("<")[0].count(" ") <= license_scan.BEFORE and rule.pattern.split("<")[1].count(" ") <= license_scan.AFTER
