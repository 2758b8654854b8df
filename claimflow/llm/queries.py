"""The queries of this package and, where SQL can say it, equivalent SQL."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimflow.llm import (
    exact_dedup,
    hard_negatives,
    html_extract,
    language_id,
    license_scan,
    merkle,
    mixing,
    online_packing,
    packing,
    simhash,
    token_output,
    vector_search,
    warc,
)
from claimflow.llm.common import ship, tables_of

HELD_OUT = 2  # of four parts by the checksum of the doc_id this one is never learned from


def held_out() -> F.Column:
    return F.crc32(F.col("doc_id").cast("string")) % 4 == HELD_OUT


def language_model(documents: DataFrame) -> language_id.Model | None:
    return language_id.fit(documents.where(~held_out()))


def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    documents = tables_of(spark, folder, "documents", ["doc_id", "text", "lang"])
    guessed = language_id.identify(documents, language_model(documents))
    return guessed.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score")


def op2_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_groups(tables_of(spark, folder, "documents", ["doc_id", "text"]))


def op3_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.repetitions(tables_of(spark, folder, "documents", ["doc_id", "text", "source"]))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "times")


def op4_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(tables_of(spark, folder, "documents", ["doc_id", "text"]))


def op5_token_output(spark: SparkSession, folder: str) -> DataFrame:
    return token_output.segments(token_output.pack_tokens(tables_of(spark, folder, "documents", ["doc_id", "text"])))


def op6_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return html_extract.extract(tables_of(spark, folder, "pages", ["page_id", "url", "html"]))


def op7_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.scan_licences(tables_of(spark, folder, "documents", ["doc_id", "text"]))


def op8_warc_archives(spark: SparkSession, folder: str) -> DataFrame:
    archives = warc.write_archives(tables_of(spark, folder, "pages", ["page_id", "url", "html"]))
    records = warc.read_archives(archives, payloads=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    vectors = tables_of(spark, folder, "embeddings", ["vec_id", "embedding"])
    return vector_search.top_k(vectors.where(F.col("vec_id") % 20 == 0), vectors)


def op10_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_groups(tables_of(spark, folder, "documents", ["doc_id", "text"]))


def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    documents = tables_of(spark, folder, "documents", list(merkle.COLUMNS))
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    return merkle.manifest(documents, {"n_chars": F.col("n_chars").cast("decimal(20,0)") + 1}, tampered)


def op12_online_packing(spark: SparkSession, folder: str) -> DataFrame:
    return online_packing.pieces(online_packing.pack_online(tables_of(spark, folder, "documents", ["doc_id", "text"])))


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    vectors = tables_of(spark, folder, "embeddings", ["vec_id", "label", "embedding"])
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(vectors.withColumn("label", moved), F.col("vec_id") % 100 == 0)


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


def _shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @functools.wraps(query)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        ship(spark)
        return query(spark, folder)

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    ops = (
        op1_language_id,
        op2_simhash_near_dedup,
        op3_mix_sources,
        op4_best_fit_packing,
        op5_token_output,
        op6_html_extraction,
        op7_license_scan,
        op8_warc_archives,
        op9_exact_top_k,
        op10_exact_dedup,
        op11_merkle_manifest,
        op12_online_packing,
        op13_hard_negatives,
        pipeline,
    )
    return {f.__name__: _shipped(f) for f in ops}


def _licence_sql() -> str:
    table = ", ".join(f"('{s}', '{i}')" for s, i in license_scan.sentence_table().items())
    plain = (
        f"regexp_replace(replace(regexp_replace(regexp_replace({{}}, '{license_scan.ENTRY}', '\n', 'g'), '([.!?])[ \\t]+', '\\1\n', 'g'), chr(1), '\n'), '[^a-z0-9\n]+', ' ', 'g')"
    )
    joined = "replace(regexp_replace(low, '\n[ \\t]*\n', chr(1), 'g'), '\n', ' ')"
    steps, last = [], "s0"
    for n, (licence, ids) in enumerate(license_scan.RULES, 1):
        pattern = license_scan.rule_pattern(ids)
        steps.append(
            f"s{n} AS (SELECT rid, regexp_replace(\"left\", '{pattern}', ' ', 'g') AS \"left\", "
            f"CASE WHEN regexp_matches(\"left\", '{pattern}') THEN list_append(found, '{licence}') ELSE found END AS found FROM {last})"
        )
        last = f"s{n}"
    return f"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, 
  regexp_replace('\n' || replace(lower(coalesce(text, '')), '\r', ''), '{license_scan.MARKS}', '\n', 'g') AS low FROM documents),
read AS (SELECT rid, 0 AS reading, string_split({plain.format("low")}, '\n') AS parts FROM docs
  UNION ALL SELECT rid, 1, string_split({plain.format(joined)}, '\n') FROM docs),
cut AS (SELECT rid, reading, trim(unnest(parts)) AS s, unnest(range(len(parts))) AS k FROM read),
kept AS (SELECT * FROM cut WHERE reading = 0
  UNION ALL SELECT rid, 1, s, min(k) FROM cut c WHERE reading = 1
    AND NOT EXISTS (SELECT 1 FROM cut b WHERE b.rid = c.rid AND b.reading = 0 AND b.s = c.s) GROUP BY rid, s),
known(s, id) AS (VALUES {table}),
cored AS (SELECT rid, reading, k, s, regexp_replace(regexp_replace(s, '{license_scan.REFERENCE}', 'licensed under '),
  '{license_scan.IDENTIFIER}', 'licensed under ') AS core, regexp_replace(s, '{license_scan.NUMBER}', '') AS numbered FROM kept),
named AS (SELECT c.rid, c.reading, c.k, coalesce(a.id, b.id, n.id,
  CASE WHEN regexp_matches(c.s, '{license_scan.COPYRIGHT}') THEN 'copyright' END) AS id
  FROM cored c LEFT JOIN known a ON a.s = c.s LEFT JOIN known b ON b.s = c.core LEFT JOIN known n ON n.s = c.numbered),
ids AS (SELECT rid, string_agg(id, ' ' ORDER BY reading, k) AS ids FROM named WHERE id IS NOT NULL GROUP BY rid),
s0 AS (SELECT rid, ' ' || ids || ' ' AS "left", CAST([] AS VARCHAR[]) AS found FROM ids),
{", ".join(steps)}
SELECT d.doc_id, coalesce(i.ids, '') AS sentence_ids,
  CASE WHEN regexp_matches(' ' || i.ids || ' ', '{license_scan.PROPRIETARY}') THEN 'Proprietary'
    ELSE coalesce(array_to_string(list_sort(list_distinct(f.found)), ','), '') END AS licences
FROM docs d LEFT JOIN ids i USING (rid) LEFT JOIN {last} f USING (rid)"""


def _payload_sql() -> str:
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    part = "CAST('0x' || substr(hex, 5 * g + 1, 5) AS BIGINT)"
    digits = " || ".join(f"substr('{letters}', 1 + CAST(({part} >> {shift}) & 31 AS BIGINT), 1)" for shift in (15, 10, 5, 0))
    return f"""
WITH payloads AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
digits AS (SELECT hex, string_agg({digits}, '' ORDER BY g) AS digest
  FROM (SELECT DISTINCT hex FROM payloads), range(8) AS r(g) GROUP BY hex),
firsts AS (SELECT html, min(page_id) AS first FROM payloads GROUP BY html)
SELECT p.page_id, CAST(octet_length(encode(p.html)) AS BIGINT) AS payload_bytes, d.digest AS payload_digest,
  CASE WHEN p.page_id = f.first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN p.page_id <> f.first THEN f.first END AS refers_to
FROM payloads p JOIN digits d USING (hex) JOIN firsts f USING (html)"""


SEARCH_SQL = """
WITH whole AS (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.rid, q.vec_id AS query_id, c.vec_id AS vec_id,
    CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v))
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 20"""

DEDUP_SQL = """
WITH bodies AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body
  FROM documents),
groups AS (SELECT body, max(doc_id) AS keep_id, count(*) AS group_size FROM bodies GROUP BY body)
SELECT b.doc_id, g.keep_id, g.group_size, b.doc_id = g.keep_id AS kept, sha256(b.body) AS text_sha256
FROM bodies b JOIN groups g USING (body)"""


NEGATIVES_SQL = """
WITH used AS (
  SELECT row_number() OVER () AS rid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.rid, a.vec_id AS anchor_id, c.rid AS other, c.vec_id AS other_id, a.label = c.label AS same,
    CAST(list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * c.v[i])) AS BIGINT) AS score
  FROM used a JOIN used c ON a.vec_id % 100 = 0 AND a.rid <> c.rid AND len(a.v) = len(c.v)),
positives AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY score DESC, other_id, other) AS place FROM scored WHERE same)
  WHERE place <= 5),
hard AS (
  SELECT p.rid, p.anchor_id, p.place, p.other_id AS positive_id, n.other_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
    row_number() OVER (PARTITION BY p.rid, p.place ORDER BY n.score DESC, n.other_id, n.other) AS rank
  FROM positives p JOIN scored n ON n.rid = p.rid AND NOT n.same AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM hard WHERE rank <= 5"""

_LEAF = "sha256(" + " || ".join(
    f"coalesce(CAST(octet_length(encode({c})) AS VARCHAR) || ':' || {c}, '-')"
    for c in ("CAST(doc_id AS VARCHAR)", "source", "lang", "CAST({n} AS VARCHAR)", "text")
) + ")"
_CRC = """xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
  list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT))),
  lambda x, b: list_reduce(list_prepend(xor(x, b), CAST([0, 0, 0, 0, 0, 0, 0, 0] AS BIGINT[])),
    lambda y, z: CASE WHEN y & 1 = 1 THEN xor(y >> 1, 3988292384) ELSE y >> 1 END)), 4294967295)"""
MANIFEST_SQL = f"""
WITH RECURSIVE placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p, row_number() OVER () AS rid
  FROM (SELECT doc_id, lang, {_LEAF.format(n="n_chars")} AS leaf,
    CASE WHEN {_CRC} % 7 = 0 THEN {_LEAF.format(n="(n_chars + 1)")} ELSE {_LEAF.format(n="n_chars")} END AS found FROM documents)),
levels(lang, level, nodes) AS (
  SELECT lang, 0, list(leaf ORDER BY p) FROM placed GROUP BY lang
  UNION ALL SELECT lang, level + 1,
    list_transform(range(0, len(nodes), 2), lambda i: sha256(nodes[i + 1] || coalesce(nodes[i + 2], '')))
  FROM levels WHERE len(nodes) > 1),
trees AS (SELECT lang, nodes[1] AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS p FROM levels WHERE len(nodes) = 1),
tops(level, nodes) AS (
  SELECT 0, list(subroot ORDER BY p) FROM trees
  UNION ALL SELECT level + 1,
    list_transform(range(0, len(nodes), 2), lambda i: sha256(nodes[i + 1] || coalesce(nodes[i + 2], '')))
  FROM tops WHERE len(nodes) > 1),
steps AS (
  SELECT rid, level, (d.p >> level) % 2 AS slot, nodes[xor(d.p >> level, 1) + 1] AS sibling
  FROM placed d JOIN levels l ON d.lang IS NOT DISTINCT FROM l.lang AND len(nodes) > 1
  UNION ALL SELECT rid, 1000 + level, (t.p >> level) % 2, nodes[xor(t.p >> level, 1) + 1]
  FROM placed d JOIN trees t ON d.lang IS NOT DISTINCT FROM t.lang JOIN tops ON len(nodes) > 1),
proofs AS (
  SELECT rid, string_agg(sibling, '' ORDER BY level) AS siblings,
    list(CAST(slot AS VARCHAR) || coalesce(sibling, '') ORDER BY level) AS path FROM steps GROUP BY rid),
folded AS (
  SELECT d.*, t.subroot, (SELECT nodes[1] FROM tops WHERE len(nodes) = 1) AS root,
    sha256(coalesce(p.siblings, '')) AS proof_sha256,
    list_reduce(list_prepend(d.found, coalesce(p.path, [])),
      lambda x, s: CASE WHEN s[1] = '0' THEN sha256(x || s[2:]) ELSE sha256(s[2:] || x) END) AS folded_root
  FROM placed d JOIN trees t ON d.lang IS NOT DISTINCT FROM t.lang LEFT JOIN proofs p USING (rid))
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM folded"""


def oracle_sql() -> dict[str, str]:
    return {
        "op7_license_scan": _licence_sql(),
        "op8_warc_archives": _payload_sql(),
        "op9_exact_top_k": SEARCH_SQL,
        "op10_exact_dedup": DEDUP_SQL,
        "op11_merkle_manifest": MANIFEST_SQL,
        "op13_hard_negatives": NEGATIVES_SQL,
    }
