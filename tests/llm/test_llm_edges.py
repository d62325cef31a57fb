"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names for every operator and stage."""

import gzip
import itertools
import random
import re
import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as P
from ledgerly.llm import ann, bpe, chat, components, exact_dedup, line_crf, line_dedup, mixing, quality, simhash, token_files, warc
from ledgerly.llm.common import shared_path

settings.register_profile("llm", deadline=None)  # the first call loads a vocabulary
settings.load_profile("llm")

WORD, BYTE = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))
LIBRARY = Tokenizer.from_file(BYTE)
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHES = ("row", "doc", "key", "name", "hash", "hot", "fp", "id", "size", "n", "score", "kept", "n_lines", "ids", "number", "root", "old")
LONG = "\n".join(f"line {i} of a long text" for i in range(4000))
ROWS = [(1, "a b c d", "en", "s", 7), (2, "a  b\tc d", None, None, None), (3, None, "en", "s", None), (4, "", "en", "t", 0),
        (5, " \n \n", "en", "t", 4), (5, " \n \n", "en", "t", 4), (None, "a b c d", "en", "s", 7), (6, LONG, "en", "", len(LONG)),
        (7, LONG + " ", "en", "u", None), (8, "é日本 <|endoftext|> x", "fr", "u", 1), (9, "shared\nown", "en", "s", 1)]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    return df.select("*", *[F.lit("x").alias(c) for c in CLASHES])


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_exact_dedup(docs, none):
    rows = exact_dedup.exact_dedup(docs, block_chars=5).collect()
    assert len(rows) == len(ROWS)
    by = {(r.doc_id, r.kept): r for r in rows}
    assert by[2, False].keep_id == 1 and by[None, False].keep_id == 1 and by[1, True].group_size == 3
    assert by[3, True].group_size == 2 and by[4, False].keep_id == 3
    assert {r.kept for r in rows if r.doc_id == 5} == {True, False}  # repeated rows: exactly one stays
    assert by[6, True].group_size == 1 and by[7, True].group_size == 1
    assert exact_dedup.exact_dedup(none).count() == 0


def test_exact_dedup_random_groups(spark):
    r = random.Random(3)
    texts = ["".join(r.choice("ab ") for _ in range(r.randint(0, 12))) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    flat = [re.sub(" +", " ", t) for t in texts]
    for x in exact_dedup.exact_dedup(df, block_chars=2).collect():
        assert x.keep_id == flat.index(flat[x.doc_id]) and x.group_size == flat.count(flat[x.doc_id])


def test_line_dedup(spark, docs, none):
    out = line_dedup.line_dedup(docs, min_docs=2, min_chars=1)
    assert set(out.columns) == {*docs.columns, "n_lines", "n_dropped"}
    rows = {r.doc_id: r for r in out.collect()}
    assert rows[3].text is None and (rows[3].n_lines, rows[3].n_dropped) == (1, 0)
    assert rows[5].text == " \n \n" and rows[5].n_lines == 3
    assert rows[1].text == "" and rows[1].n_dropped == 1 and rows[2].text == "a  b\tc d" and rows[None].text == ""
    assert rows[6].n_dropped == 4000 and rows[6].text == "" and rows[7].n_dropped == 4000
    assert rows[9].text == "shared\nown"
    assert line_dedup.line_dedup(none).count() == 0
    repeated = spark.createDataFrame([(1, "x\ny")] * 9 + [(None, "x")] * 9 + [(2, "y")], "doc_id long, text string")
    rows = line_dedup.line_dedup(repeated, min_docs=3, min_chars=1).collect()  # two documents have x, two have y
    assert {(r.doc_id, r.text) for r in rows} == {(1, "x\ny"), (None, "x"), (2, "y")} and len(rows) == 19
    rows = line_dedup.line_dedup(repeated, min_docs=2, min_chars=1).collect()
    assert {r.text for r in rows} == {""} and sum(r.n_dropped for r in rows) == 28
    mixed = spark.createDataFrame([(1, "\tHeÉ x \r\nkeep1"), (2, "heÉ X"), (3, "heé x")], "doc_id long, text string")
    rows = {r.doc_id: r.text for r in line_dedup.line_dedup(mixed, min_docs=2).collect()}
    assert rows == {1: "keep1", 2: "", 3: "heé x"}  # only A-Z are folded


def test_simhash(spark, docs, none):
    rows = simhash.near_duplicates(docs).collect()
    assert len(rows) == len(ROWS)
    assert {r.doc_id for r in rows if r.fingerprint == "0" * 16} == {3, 4, 5}
    assert {r.component_id for r in rows if r.doc_id in (1, 2, None)} == {1}
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 3, 6, 8, 9]
    assert simhash.near_duplicates(none).count() == 0 and simhash.keep_one(none).count() == 0
    nameless = spark.createDataFrame([(None, "x"), (None, "x")], "doc_id long, text string")
    assert [r.component_id for r in simhash.near_duplicates(nameless).collect()] == [None, None]
    assert simhash.keep_one(nameless).count() == 1


@pytest.mark.parametrize("most", [2, 7, 2048])
def test_simhash_links_under_crowded_keys(spark, most):
    r = np.random.default_rng(most)
    centre = r.integers(0, 1 << 63, 4, dtype=np.uint64)
    flips = [sum(1 << int(b) for b in r.choice(64, r.integers(0, 5), replace=False)) for _ in range(400)]
    prints = sorted({int(centre[k % 4]) ^ f for k, f in enumerate(flips)})
    df = spark.createDataFrame([(int(np.uint64(p).astype(np.int64)),) for p in prints], "fp long")
    edges = [(x.u, x.v) for x in simhash.links(df, 3, most).collect()]
    bits = {p: np.uint64(p).astype(np.int64).item() for p in prints}
    assert all(((a ^ b) & (1 << 64) - 1).bit_count() <= 3 for a, b in edges)

    def groups(links):
        root = {b: b for b in bits.values()}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x
        for a, b in links:
            x, y = sorted((find(a), find(b)))
            root[y] = x
        return {b: find(b) for b in root}
    want = [(bits[a], bits[b]) for a, b in itertools.combinations(prints, 2) if (a ^ b).bit_count() <= 3]
    assert groups(edges) == groups(want)


@pytest.mark.parametrize("rest", [0, 1, 2, 3])
def test_all_of_a_crowded_key_goes_on_whatever_the_batches(rest):
    keys, prints = [5] * 8 + [6, 6], [*range(100, 108), 200, 201]  # key 5 is crowded, 6 is not
    rows = pa.RecordBatch.from_arrays([pa.array(keys), pa.array([0] * 10), pa.array([32] * 10, pa.int32()), pa.array(prints)],
                                      names=["k1", "k2", "start", "fp"])
    out = pa.Table.from_batches(simhash.verify(3, most=4)(iter([rows[:8 - rest], rows[8 - rest:]]))).to_pylist()
    assert sorted(r["a"] for r in out if r["b"] is None) == prints[:8]
    assert all((r["k1"], r["k2"], r["start"]) == (5, 0, 32) for r in out if r["b"] is None)
    assert [(r["a"], r["b"]) for r in out if r["b"] is not None] == [(200, 201)]


def test_components_of_a_path_and_a_star(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(1, 30)] + [(7, 7)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {k: 0 for k in range(41)} | {k: 100 for k in range(100, 130)}


def test_quality(spark, docs, none):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (None, 1, 0), (6, None, 0), (9, 0, 0), (9, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    rows = quality.classify(docs, labels, held_out=9).collect()
    assert len(rows) == len(ROWS) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert not any(r.held_out for r in rows if r.doc_id is None)
    assert {r.score for r in quality.classify(docs, labels.limit(0)).collect()} == {0.5}
    assert quality.classify(none, labels).count() == 0


def test_a_very_long_document_shuts_out_no_other(spark):
    ids = [r.id for r in spark.range(12).orderBy(F.xxhash64("id"), "id").collect()]  # in the order of the draw
    texts = [(i, "x\n" * 5000 if i == ids[0] else f"text {i}\nmore") for i in ids]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(k < 10)) for k, i in enumerate(ids)], "doc_id long, quality int")

    def drawn(max_lines, document_lines):
        return {r.doc_id: r.text for r in quality.training_sample(df, labels, 9, 1500, max_lines, document_lines, "doc_id", "text").collect()}
    others = {i: t for i, t in texts if i != ids[0]}
    assert drawn(1000, 50) == others and drawn(5000, 50) == others
    assert drawn(6000, 50) == dict(texts) and drawn(6000, 6000) == dict(texts)  # whole, and last of all
    assert len(drawn(7, 50)) == 3 and all(t == others[i] for i, t in drawn(7, 50).items())


def test_texts_are_chosen_whole_in_the_order_of_the_draw():
    rows = [(1, 5, "a", 9), (1, 7, "b", 40), (2, 1, "c", 3), (2, 9, "d", 8), (3, 0, "e", 20)]
    assert quality.chosen(rows, 12, 30) == ["a", "c"]
    assert quality.chosen(rows, 20, 30) == ["a", "c", "d"]
    assert quality.chosen(rows, 80, 5) == ["c", "d", "a", "e", "b"]
    assert quality.chosen([], 5, 5) == [] and quality.chosen(rows, 2, 5) == []


def _model(texts):
    x, sizes, counts = line_crf.line_features(texts)
    return line_crf.LineCrf().fit(x, sizes, counts, np.arange(len(texts)) % 2, rounds=1, steps=20)


@pytest.mark.parametrize("most_lines", [1, 2, 3, 50])
def test_scores_do_not_depend_on_blocks_of_lines(most_lines):
    r = random.Random(most_lines)
    texts = ["\n".join("".join(r.choices("ab C1!.$ é", k=r.randint(0, 12))) for _ in range(r.choice([1, 2, 50, 333]))).encode() for _ in range(40)]
    texts += [b"", b"\n", b"\n\n\n", b"same same\nsame", b"same"]
    model = _model(texts)
    want = np.concatenate([model.score([t]) for t in texts])
    assert np.allclose(model.score(texts, most_lines=most_lines), want, atol=1e-12)
    assert np.allclose(model.score(texts), want, atol=1e-12)


def test_a_text_of_line_breaks_is_scored_in_little_memory():
    model = _model([b"a b\nc", b"$$"])
    tracemalloc.start()
    try:
        model.score([b"\n" * 200_000])
        assert tracemalloc.get_traced_memory()[1] < 50e6
    finally:
        tracemalloc.stop()


def test_forward_backward_against_all_paths():
    r = np.random.default_rng(1)
    counts = np.array([3, 1, 5, 2])
    logits, trans, start = r.normal(size=counts.sum()), r.normal(size=(2, 2)), 0.3
    good, joint, _ = line_crf.marginals(logits, counts, trans, start, pairs=True)
    at, pairs = 0, 0
    for n in counts:
        weight, hit, steps = 0.0, np.zeros(n), np.zeros((max(n - 1, 0), 2, 2))
        for path in itertools.product((0, 1), repeat=int(n)):
            w = np.exp(path[0] * start + sum(y * logits[at + t] for t, y in enumerate(path)) + sum(trans[a, b] for a, b in itertools.pairwise(path)))
            weight, hit = weight + w, hit + w * np.array(path)
            for t, (a, b) in enumerate(itertools.pairwise(path)):
                steps[t, a, b] += w
        assert np.allclose(good[at:at + n], hit / weight) and np.allclose(joint[pairs:pairs + n - 1], steps / weight)
        at, pairs = at + n, pairs + n - 1


def test_line_features_see_their_neighbours():
    x, sizes, counts = line_crf.line_features([b"", b"AB!! c\n\n123", "é".encode()])
    assert counts.tolist() == [1, 3, 1] and sizes.tolist() == [0, 6, 0, 3, 2]
    own = (x.shape[1] - 1) // 3
    assert (x[1, 2 * own:3 * own] == x[2, :own]).all() and (x[3, own:2 * own] == x[2, :own]).all()
    assert (x[1, own:2 * own] == 0).all() and (x[3, 2 * own:3 * own] == 0).all()


def test_warc(spark, none):
    pages = [(1, "http://a/ b\r\nX: y", "same"), (2, None, "same"), (3, "u", None), (4, "u", ""), (5, "u", "x\r\n\r\nWARC/1.1\r\n" * 3),
             (None, "u", "same"), (6, "u", "big" * 200_000)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("sha", F.lit(1)).withColumn("first", F.lit(2))
    path = shared_path(spark, "test")
    warc.write_archives(df, path, archive_bytes=1000)
    rows = warc.read_archives(spark, path).collect()
    assert {r.kind for r in rows} == {"record"}
    by = {r.page_id: r for r in rows}
    assert by[2].refers_to == 1 and by[None].refers_to == 1 and by[4].refers_to == 3 and by[4].payload_bytes == 0
    assert by[1].payload == b"same" and by[2].payload is None and by[2].payload_bytes == 4
    assert by[5].payload.decode() == pages[4][2] and by[6].payload_bytes == 600_000
    path = shared_path(spark, "test")
    warc.write_archives(df, path, min_bytes=4)
    assert {r.page_id: r.refers_to for r in warc.read_archives(spark, path).collect()} == {1: None, 2: 1, 3: None, 4: None, 5: None, None: 1, 6: None}
    path = shared_path(spark, "test")
    warc.write_archives(df.limit(0), path)
    assert warc.read_archives(spark, path).count() == 0


def _records(n=6):
    return [warc.make_record(k, f"http://h/{k}", b"payload %d" % k * 5, warc.base32_sha1(b"payload %d" % k * 5), 45) + warc.END for k in range(n)]


@pytest.mark.parametrize("zipped", [False, True])
def test_salvage_recovers_what_follows_damage(zipped):
    parts = [gzip.compress(r, mtime=0) if zipped else r for r in _records()]
    data = b"".join(parts)
    whole = list(warc.salvage(data))
    assert [w["page_id"] for k, _, _, w in whole if k == "record"] == list(range(6)) and len(whole) == 6
    at = len(parts[0]) + len(parts[1]) - 20  # in the payload or its checksum; plain headers have none
    broken = bytearray(data)
    broken[at] ^= 0x55
    broken = b"??" + bytes(broken) + parts[0][:40]
    found = list(warc.salvage(broken))
    assert [w["page_id"] for k, _, _, w in found if k == "record"] == [0, 2, 3, 4, 5]
    gaps = [(o, n) for k, o, n, _ in found if k == "gap"]
    assert gaps == [(0, 2), (2 + len(parts[0]), len(parts[1])), (2 + len(data), 40)]
    assert sum(n for _, _, n, _ in found) == len(broken)  # every byte is a record's or a gap's


def _ids(data, **more):
    return [w["page_id"] for k, _, _, w in warc.salvage(data, **more) if k == "record"]


def test_salvage_goes_on_within_a_member():
    records = _records(100)
    broken = [r if k != 41 else r[:-30] + b"?" + r[-29:] for k, r in enumerate(records)]
    found = list(warc.salvage(gzip.compress(b"".join(broken), mtime=0)))
    assert [w["page_id"] for k, _, _, w in found if k == "record"] == [k for k in range(100) if k != 41]
    inner = [(o, w) for k, o, _, w in found if k == "inner gap"]
    assert len(inner) == 1 and inner[0][0] == 0 and inner[0][1].startswith(f"{len(records[41])} bytes from {len(b''.join(records[:41]))} on")
    last = gzip.compress(b"".join(records[:-1]) + b"WARC/1.1\r\nhalf a record", mtime=0)
    assert _ids(last) == list(range(99))


def test_salvage_keeps_what_a_broken_member_gave():
    r = random.Random(3)  # payloads that do not compress, so that a fault's place decides what comes before it
    payloads = [bytes(r.choices(range(256), k=3000)) for _ in range(100)]
    records = [warc.make_record(k, None, p, warc.base32_sha1(p), len(p)) + warc.END for k, p in enumerate(payloads)]
    whole = gzip.compress(b"".join(records), mtime=0)
    assert _ids(whole[:-4]) == list(range(100))  # cut within the checksum
    cut = list(warc.salvage(whole[:len(whole) // 2] + gzip.compress(records[7], mtime=0)))
    ids = [w["page_id"] for k, _, _, w in cut if k == "record"]
    assert ids[-1] == 7 and ids[:-1] == list(range(len(ids) - 1)) and 45 <= len(ids) <= 52
    assert [(o, n) for k, o, n, _ in cut if k == "gap"] == [(0, len(whole) // 2)]
    assert sum(n for k, _, n, _ in cut if k != "inner gap") == len(whole) // 2 + len(gzip.compress(records[7], mtime=0))


@pytest.mark.parametrize("member_records", [0, 1, 3])
def test_torn_records_are_gaps_and_nothing_is_lost(spark, member_records):
    df = spark.createDataFrame([(k, "u", f"payload {k} " * (k % 7)) for k in range(60)] + [(3, "u", "payload 3 " * 3)] * 2,
                               "page_id long, url string, html string")
    path = shared_path(spark, "test")
    warc.write_archives(df, path, member_records=member_records, torn_every=5, archive_bytes=4000)
    rows = warc.read_archives(spark, path).collect()
    records = [r for r in rows if r.kind == "record"]
    assert sorted(r.page_id for r in records) == sorted([*range(60), 3, 3])
    assert len([r for r in rows if r.kind != "record"]) >= 8
    assert {r.page_id: r.payload_bytes for r in records} == {k: len(f"payload {k} " * (k % 7)) for k in range(60)}
    assert len({r.archive for r in rows}) > 1


@given(st.binary(max_size=80), st.integers(0, 5), st.integers(0, 200))
def test_salvage_never_fails(noise, k, at):
    data = b"".join(_records(3))
    data = data[:at] + noise + data[at + k:]
    spans = sorted((o, n) for _, o, n, _ in warc.salvage(data))
    assert sum(n for _, n in spans) == len(data)


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_piece_encoder_with_any_tokenizer(path):
    texts = [r[1] for r in ROWS] + ["Don't  SAY\tit's  <|endoftext|>", "ÀÉ e\u0301 1234 ...!", " lead", "x" * 300]
    made, t = token_files.PieceEncoder(path), Tokenizer.from_file(path)
    assert made.by_words == (path == WORD)
    got = [np.frombuffer(b, made.dtype).tolist() for b in made.encode(pa.array(texts, pa.string()))]
    assert got == [t.encode(x or "", add_special_tokens=False).ids for x in texts]


def test_token_files(spark, docs, none, tmp_path):
    path = shared_path(spark, "test")
    token_files.write_tokens(docs, path, WORD, length=16, rows=4, file_tokens=100)
    rows = token_files.read_tokens(spark, path).orderBy("start").collect()
    assert [r.doc_id for r in rows] == [1, 2, 3, 4, 5, 5, 6, 7, 8, 9, None]
    assert [r.n_tokens for r in rows][2:6] == [1, 1, 1, 1]
    assert [r.start for r in rows] == [sum(r.n_tokens for r in rows[:k]) for k in range(len(rows))]
    path = shared_path(spark, "test")
    token_files.write_tokens(none, path, WORD)
    assert token_files.read_tokens(spark, path).count() == 0


def test_sequences_are_views(tmp_path):
    ids = [np.arange(n, dtype="<u2").tobytes() for n in (5, 12, 1)]
    (tmp_path / "f").write_bytes(token_files.make_file([1, None, 3], ids, np.dtype("<u2"), 4, 2, part=0, place=0) + b"\n")
    s = token_files.Sequences(str(tmp_path / "f"))
    flat = np.concatenate([np.arange(n) for n in (5, 12, 1)])
    assert len(s) == 5
    for i in range(5):
        row, mask, ends = s[i]
        assert not row.flags.owndata and row[:len(flat[4 * i:4 * i + 4])].tolist() == flat[4 * i:4 * i + 4].tolist()
        assert sum(mask.to_pylist()) == len(flat[4 * i:4 * i + 4]) and len(ends) == 4
    assert [(d, a, i.tolist()) for d, a, i in s.documents()] == [(1, 0, list(range(5))), (None, 5, list(range(12))), (3, 17, [0])]


@given(st.text(max_size=60))
def test_piece_encoder_like_the_library(text):
    e = token_files.encoder(WORD)
    [got] = e.encode(pa.array([text]))
    assert np.frombuffer(got, e.dtype).tolist() == e.tokenizer.encode(text, add_special_tokens=False).ids


TEXTS = st.text(max_size=60) | st.text("ab  \n'sdl<|endoftext|>é1", max_size=60) | st.sampled_from(["<|endoftext|> a<|endoftext|>", "  ", " a", "a  "])


@given(st.lists(TEXTS | st.none(), max_size=5))
def test_bpe_like_the_library(texts):
    library, own = LIBRARY, bpe.vocabulary(BYTE)
    for text, ids in zip(texts, own.encode_all(pa.array(texts, pa.string())), strict=True):
        want = library.encode(text or "", add_special_tokens=False).ids
        assert ids.tolist() == want and np.frombuffer(own.encode(text or ""), own.dtype).tolist() == want
        assert own.decode(ids) == library.decode(want, skip_special_tokens=False)


def test_every_prefix_has_one_last_token():
    own = bpe.vocabulary(BYTE)
    for word in ("unbelievable", "aaaaaaaa", "thndnttiing"):
        for n, last in enumerate(own.last_tokens(word)[1:], 1):
            assert own.encode_word(word[:n])[-1] == last


@given(st.text("<>/s[]INTYS\\ a\n", max_size=40), st.text("<s>\\[INST]\n", max_size=12))
def test_turns_can_be_read_back(text, role):
    assert chat.unescape(chat.escape(text)) == text
    one, begin, end = chat.format_turn(role, text)
    assert chat.parse_turns(one + one) == [(role, text, begin, end), (role, text, len(one) + begin, len(one) + end)]


def test_chat_windows(spark):
    rows = [(1, 0, "system", "be kind"), *[(1, k, "user" if k % 2 else "assistant", f"turn {k} " + "w " * 10) for k in range(1, 12)],
            (2, 0, None, None), (2, 0, None, None), (None, 3, "assistant", "x" * 5000), (None, None, "tool", "</s>"), (3, 1, "system", "only")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("window", F.lit(0))
    windows = chat.format_chats(df, BYTE, budget=100, history=45).collect()
    one = sorted((r for r in windows if r.conv_id == 1), key=lambda r: r.window)
    assert len(one) > 2 and all(chat.parse_turns(r.text)[0][:2] == ("system", "be kind") for r in one)
    assert one[0].repeated == 0 and all(r.repeated >= 2 for r in one[1:])  # the system turn and some history
    fresh = [t[:2] for r in one for t in chat.parse_turns(r.text)[r.repeated:]]
    assert fresh == [(r[2], r[3]) for r in rows[:12]]
    said = [chat.unescape(r.text[t.start:t.end]) for r in one for t in r.targets]
    assert said == [r[3] for r in rows[:12] if r[2] == "assistant"]
    short = spark.createDataFrame([(1, k, "user" if k % 2 else "assistant", "[/INST]</s> ok") for k in range(400)], "conv_id long, turn long, role string, text string")
    for budget in (100, 1024):
        sizes = [len(LIBRARY.encode(r.text, add_special_tokens=False).ids) for r in chat.format_chats(short, BYTE, budget=budget).collect()]
        assert max(sizes) <= budget and max(sizes) > 0.7 * budget
    path = shared_path(spark, "test")
    chat.write_chats(df, path, BYTE, budget=100, history=45)
    got = {r.conv_id: r for r in chat.read_chats(spark, path).collect()}
    assert {c: r.n_turns for c, r in got.items()} == {1: 12, 2: 2, None: 2, 3: 1}
    assert got[None].loss_chars == 5000 and got[2].loss_chars == 0
    assert chat.format_chats(df.limit(0), BYTE).count() == 0


@pytest.mark.parametrize("dim", [1, 8, 13, 64])
def test_estimates_from_packed_bits(dim):
    r = np.random.default_rng(dim)
    vectors, queries = r.standard_normal((300, dim)), r.standard_normal((40, dim))
    centre, turn = vectors.mean(axis=0), ann.rotation(dim, 7)
    bits, length, fit = ann.encode(vectors, centre, turn)
    guess, error = ann.estimate(bits, length, fit, ann.byte_tables(queries, turn), queries, centre, 2.2)
    signs = np.sign((vectors - centre) @ turn.T)
    code = signs / np.sqrt(dim)
    want = (code @ (queries @ turn.T).T) * (length / fit)[:, None] + queries @ centre
    assert np.abs(guess - want).max() < 1e-4
    assert (np.abs(guess - vectors @ queries.T) <= error + 1e-4).mean() > 0.9


def test_ann(spark):
    inf, nan = float("inf"), float("nan")
    vectors = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]),
               (20, [0.0, 1.0]), (20, [0.0, 1.0]), (40, [1.0, 1.0, 1.0]), (None, [1.0, 1.0]), (8, []), (9, [-1.0, -1.0])]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>").withColumn("bits", F.lit(1)).withColumn("block", F.lit(1))
    got = [tuple(r) for r in ann.search(df, k=3).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1, 2.0), (0, 2, 2, 2.0), (0, 3, 20, 0.0), (20, 1, 0, 0.0), (20, 2, 1, 0.0), (20, 3, 2, 0.0)]
    assert ann.search(df.limit(0)).count() == 0


def test_ann_over_blocks_and_shares(spark):
    m = np.random.default_rng(5).standard_normal((600, 24)).astype(np.float32)
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(m)], "vec_id long, embedding array<float>")
    got = ann.search(df, k=5, every=10, block_queries=13, share_vectors=100).collect()
    s = m.astype(np.float64) @ m.astype(np.float64).T
    np.fill_diagonal(s, -np.inf)
    want = {(q, int(v)) for q in range(0, 600, 10) for v in np.argsort(-s[q])[:5]}
    assert len(got) == 300 and len(want & {(r.query_id, r.vec_id) for r in got}) >= 285


def test_mixing(spark, docs, none):
    rows = mixing.mix(docs).collect()
    assert len(rows) == len(ROWS) and all(r.taken <= 3 * r.size for r in rows)
    assert {r.source_size for r in rows if r.source is None} == {4} and all(r.taken == 0 for r in rows if r.doc_id in (3, 4, 5))
    taken = mixing.take(docs)
    assert taken.columns == docs.columns
    assert taken.count() == sum(r.taken // r.size for r in rows if r.size)
    assert mixing.mix(none).count() == 0 and mixing.take(none).count() == 0


def taken_of(rows):
    return sum(r.taken for r in rows)


def test_a_long_document_shuts_out_no_other_from_the_mix(spark):
    short = [(k, "w " * (100 + k), "s") for k in range(100)]
    for long in (80_000, 30_000):
        df = spark.createDataFrame([*short, (1000, "w " * long, "s"), (2000, "w " * 60_000, "t")], "doc_id long, text string, source string")
        rows = [r for r in mixing.mix(df, weights=[1.0, 1.5]).collect() if r.source == "s"]
        assert abs(taken_of(rows) - rows[0].target) <= 0.28 * rows[0].target and all(r.taken <= 3 * r.size for r in rows)


@pytest.mark.parametrize("seed", range(3))
def test_a_mix_comes_near_its_targets(spark, seed):
    r = random.Random(seed)
    rows = [(k, "w " * min(int(r.paretovariate(0.8) * 5), 20_000), r.choice("abcd")) for k in range(2000)]
    rows += [rows[5]] * 500 + [(None, "w w", "a")] * 20
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), seed=seed).collect()
    for s in "abcd":
        own = [g for g in got if g.source == s]
        assert abs(taken_of(own) - own[0].target) <= max(5, 0.001 * own[0].target)
        assert all(g.taken == g.size * (g.epochs + g.selected) <= 3 * g.size and g.selected >= 0 for g in own)


def test_ranges_are_even_for_any_weights(spark):
    df = spark.range(60_000).selectExpr("id as doc_id", "'a b' as text", "if(id % 3 = 0, 'x', 'y') as source", "if(id % 10 < 4, 0.05, 1.0) as q")
    keyed = mixing.ranged(df.select(F.struct(F.lit(False).alias("none"), F.col("source").alias("name")).alias("key"),
                                    (-F.log(mixing.uniform(1, F.col("doc_id"))) / F.col("q")).alias("draw")))
    sizes = [r["count"] / (20 if r.key.name == "x" else 40) for r in keyed.groupBy("key", "range").count().collect()]
    assert max(sizes) < 2 * 1000 / mixing.RANGES


def test_a_row_of_more_quality_is_drawn_more_often(spark):
    df = spark.range(4000).selectExpr("id as doc_id", "'a b' as text", "if(id % 2 = 0, 'x', 'y') as source", "if(id % 4 < 2, 0.1d, 1.0d) as q")
    drawn = {r.q: r.n for r in mixing.mix(df, weights=[1.0, 3.0], quality=F.col("q")).filter("source = 'x' and selected > 0").join(
        df.select("doc_id", "q"), "doc_id").groupBy("q").agg(F.count("*").alias("n")).collect()}
    assert 3 * drawn[0.1] < drawn[1.0] and sum(drawn.values()) == 1000


def test_targets_reshare_what_capped_sources_leave(spark):
    sizes = spark.createDataFrame([((False, c), n) for c, n in (("a", 100), ("b", 1), ("c", 10), ("d", 40))],
                                  "key struct<none: boolean, name: string>, source_size long")
    got = {r.key.name: r.target for r in mixing.targets(sizes, [1.0, 2.0, 3.0], 3.0).collect()}
    assert got["b"] == 3.0 and got["c"] == 30.0 and got["a"] == pytest.approx(59.0) and got["d"] == pytest.approx(59.0)


@pytest.mark.parametrize("stage", [s for _, s in P.STAGES], ids=[n for n, _ in P.STAGES])
def test_stages(spark, docs, none, stage):
    sf = "/root/testdata/sf0.001"
    out = stage(spark, docs, sf)
    out.collect()
    if stage is not P.STAGES[-1][1]:
        assert tuple(out.columns) == P.COLUMNS
    assert stage(spark, none, sf).count() == 0
