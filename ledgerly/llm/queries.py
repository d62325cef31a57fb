"""The registered queries of this subpackage, each over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerly.llm import (ann, bpe, chat, exact_dedup, lexical, license_scan, line_dedup, mixing, quality, simhash, token_files,
                          warc, whitening)
from ledgerly.llm.common import shared_path, written
from ledgerly.sources.tables import table


def op1_warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as WARC records, payloads once, with torn records among them, and read back through the salvage reader.

    Members hold four records and every 50th record stands torn before its
    whole copy, so what comes back went through the search behind failed
    checks; the log of the quarantined gaps is a table beside the archives.
    """
    path = shared_path(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path, min_bytes=0, member_records=4, torn_every=50)
    found = warc.read_archives(spark, path)
    gaps = ("archive", "kind", "offset", "length", "reason")
    written(found.filter("kind <> 'record'").select(*gaps), "gaps")
    records = found.filter("kind = 'record'")
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines found in ten or more documents are dropped."""
    kept = line_dedup.line_dedup(table(spark, sf_dir, "documents"), min_docs=10, min_chars=1)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents equal but for white space; the smallest id stays."""
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Connected components of documents whose SimHash fingerprints differ in at most three bits."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, distance=3, seed=42)
    return found.select("doc_id", "fingerprint", "component_id")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document from the line model, learnt from two of three folds of the labels."""
    scored = quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as token ids in Arrow stream files, read back."""
    path = shared_path(spark, "tokens")
    token_files.write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return token_files.read_tokens(spark, path)


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations in budgeted windows, written and read back."""
    path = shared_path(spark, "chat")
    probe = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", probe), (-7, 1, "assistant", probe)], "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select(*extra.columns).unionAll(extra)
    chat.write_chats(turns, path, public_tokenizers.path("byte_bpe_50k.json"))
    return chat.read_chats(spark, path)


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents encoded to token ids and decoded again."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    both = bpe.encode_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), path, decoded_col="decoded")
    return both.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


def op9_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twenty nearest vectors of every twentieth vector."""
    return ann.search(table(spark, sf_dir, "embeddings"), k=20, every=20).select("query_id", "rank", "vec_id", "score")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources mixed to weights 1, 2, 3 in turn over all words, three epochs at most."""
    mixed = mixing.mix(table(spark, sf_dir, "documents"), weights=[1, 2, 3], max_epochs=3)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op11_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten highest-scoring documents of every benchmark item, through posting lists in geometric blocks."""
    index = lexical.index(table(spark, sf_dir, "documents"))
    return lexical.search(index, table(spark, sf_dir, "benchmark"), k=10).select("item_id", "rank", "doc_id", "score")


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding on the four strongest components, scaled to variance one."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"), components=4)


def op13_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices, names and hints of every document."""
    return license_scan.digest(license_scan.scan(table(spark, sf_dir, "documents")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_warc_salvage, op2_line_dedup, op3_exact_dedup, op4_simhash, op5_quality, op6_token_files, op7_chat, op8_bpe, op9_ann,
    op10_mixing, op11_lexical, op12_whitening, op13_licenses)}


def _rules_sql() -> str:
    """The rules of the license scan as SQL rows."""
    rows = [(r, base) for base, rules in ((True, license_scan.BASE), (False, license_scan.RULES)) for r in rules]
    return ",\n".join(f"({r.rule}, '{r.label}', {r.level}, '{r.keyword}', '(?:^| )({r.pattern})(?: |$)', {base})" for r, base in rows)


ORACLES: dict[str, str] = {
    "op1_warc_salvage": r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, octet_length(encode(body)) AS payload_bytes, sha1(body) AS h, min(page_id) OVER (PARTITION BY body) AS first FROM p)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
  list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((('0x' || substr(h, 1 + 5 * (i // 4), 5))::INT >> (15 - 5 * (i % 4)))::INT & 31), 1)), 'string_agg', '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM d""",
    "op2_line_dedup": r"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
k AS (SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
hot AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) + max(CASE WHEN doc_id IS NULL THEN 1 ELSE 0 END) >= 10)
SELECT doc_id, count(*) AS n_lines, count(hot.key) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (hot.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN hot USING (key) GROUP BY doc_id""",
    "op3_exact_dedup": r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept,
  sha256(t) AS text_sha256 FROM n WINDOW w AS (PARTITION BY t)""",
    "op10_mixing": r"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size
    FROM documents),
e AS (SELECT doc_id, source, size::BIGINT AS size,
    -ln((('0x' || substr(md5('42|' || coalesce(doc_id::VARCHAR, '-') || '|' || coalesce(source, '-') || '|' || size), 1, 13))::BIGINT::DOUBLE
      + 0.5) / 4503599627370496.0)
    / CASE WHEN t = '' THEN 1.0 ELSE greatest(length(regexp_replace(t, '[!-@\[-`{-~]', '', 'g')) / length(t), 0.05) END AS draw FROM d),
s AS (SELECT source, sum(size)::BIGINT AS source_size, [1.0, 2.0, 3.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE
    AS w FROM e GROUP BY source),
c AS (SELECT *, 3.0::DOUBLE * source_size AS cap, 3.0::DOUBLE * source_size / w AS ratio FROM s),
v AS (SELECT *, (sum(source_size) OVER () - (sum(cap) OVER o - cap)) / (sum(w) OVER () - sum(w) OVER o + w) AS level
    FROM c WINDOW o AS (ORDER BY ratio, source NULLS LAST)),
t AS (SELECT source, source_size, least(cap, w * (SELECT arg_min(level, ratio) FROM v WHERE level <= ratio)) AS target FROM v),
x0 AS (SELECT e.*, t.source_size, t.target, least(CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END, 3)::INT AS epochs,
    epochs AS times, t.target - epochs * t.source_size AS rest FROM e JOIN t ON e.source IS NOT DISTINCT FROM t.source),
""" + "".join(f"""
p{k} AS (SELECT *, size > 0 AND times < 3 AND {cond} AS fits, sum(CASE WHEN size > 0 AND times < 3 AND {cond} THEN size ELSE 0 END)
    OVER (PARTITION BY source ORDER BY draw, doc_id NULLS LAST, size ROWS UNBOUNDED PRECEDING) AS upto FROM x{k}),
x{k + 1} AS (SELECT * EXCLUDE (times, rest, fits, upto), times + CASE WHEN fits AND upto <= rest THEN 1 ELSE 0 END AS times,
    rest - coalesce(sum(CASE WHEN fits AND upto <= rest THEN size END) OVER (PARTITION BY source), 0) AS rest FROM p{k}),"""
    for k, cond in enumerate(("times = epochs", "times = epochs AND size <= rest", "size <= rest", "size <= rest"))) + r"""
z AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY CASE WHEN size > 0 AND times < 3 AND abs(rest - size) < rest THEN abs(rest - size) END
    NULLS LAST, draw, doc_id NULLS LAST, size) AS k FROM x4)
SELECT doc_id, size, source_size, target,
  (size * (times + CASE WHEN k = 1 AND size > 0 AND times < 3 AND abs(rest - size) < rest THEN 1 ELSE 0 END))::BIGINT AS taken FROM z""",
    "op11_lexical": r"""
WITH dt AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
lens AS (SELECT rid, doc_id, len(ts)::HUGEINT AS n FROM dt WHERE len(ts) > 0),
tot AS (SELECT count(*)::HUGEINT AS nd, sum(n)::HUGEINT AS l FROM lens),
post AS (SELECT rid, t, count(*)::HUGEINT AS tf FROM (SELECT rid, unnest(ts) AS t FROM dt) GROUP BY rid, t),
it AS (SELECT row_number() OVER () AS q, item_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM benchmark),
qt AS (SELECT q, item_id, t, count(*)::HUGEINT AS qtf FROM (SELECT q, item_id, unnest(ts) AS t FROM it) GROUP BY q, item_id, t),
w AS (SELECT t, floor(1000 * ln((2 * any_value(nd) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::HUGEINT AS w
    FROM post CROSS JOIN tot WHERE t IN (SELECT t FROM qt) GROUP BY t),
s AS (SELECT q, item_id, rid, sum(qtf * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * nd) // l))))::BIGINT AS score, any_value(doc_id) AS doc_id
    FROM qt JOIN w USING (t) JOIN post USING (t) JOIN lens USING (rid) CROSS JOIN tot GROUP BY q, item_id, rid),
r AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10""",
    "op13_licenses": r"""
WITH rules(rule, label, level, keyword, pattern, base) AS (VALUES
""" + _rules_sql() + r"""),
d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
s AS (SELECT rid, w, p FROM (SELECT rid, unnest(ws) AS w, generate_subscripts(ws, 1) AS p FROM d) WHERE w IN (SELECT keyword FROM rules)),
f AS (SELECT s.rid, s.p - 1 AS place, r.*, regexp_extract(concat_ws(' ', nullif(array_to_string(ws[greatest(1, s.p - 16):s.p - 1], ' '), ''),
    '<' || array_to_string(ws[s.p:s.p + 24], ' ')), r.pattern, 1) AS m FROM s JOIN d USING (rid) JOIN rules r ON r.keyword = s.w),
x AS (SELECT rid, rule, label, level, base, place - (length(split_part(m, '<', 1)) - length(replace(split_part(m, '<', 1), ' ', ''))) AS a,
    length(m) - length(replace(m, ' ', '')) + 1 AS n FROM f WHERE m <> ''),
i AS (SELECT *, a + n AS b FROM x),
kept AS (SELECT * FROM i WHERE base OR NOT EXISTS (SELECT 1 FROM i AS o WHERE o.rid = i.rid AND NOT o.base AND o.a <= i.a AND o.b >= i.b
    AND (o.level < i.level OR o.level = i.level AND (o.n > i.n OR o.rule < i.rule)))),
g AS (SELECT rid, count(*) FILTER (base) AS n_base, min(a) FILTER (base) AS first_word, max(a) FILTER (base) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels,
    max([0.5, 1.0, 0.9, 0.6, 0.3][level + 1]) AS score FROM kept GROUP BY rid)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0)::DOUBLE AS score FROM d LEFT JOIN g USING (rid)""",
}
