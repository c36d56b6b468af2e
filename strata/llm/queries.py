"""The operators over the test tables, and the SQL of those that SQL can express."""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from strata.llm import alignment, bagminhash, contamination, gramjoin, language, lexicon, packing, passages, prefixtrie, quality, repeats, rules, sampling, warc
from strata.llm.store import ship_package

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def _query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @functools.wraps(function)
    def shipped(spark: SparkSession, folder: str) -> DataFrame:
        ship_package(spark)
        return function(spark, folder)

    QUERIES[function.__name__] = shipped
    return shipped


def _table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet").select(*columns)


@_query
def op1_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents", "doc_id", "text", "lang")
    scored = language.predict(docs.drop("lang"), language.fit(docs), keep_text=False)
    return scored.select("doc_id", sampling.held_out().alias("held_out"), "lang_pred", "score")


@_query
def op2_repeats(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents", "doc_id", "text")
    return repeats.remove_repeats(docs, keep_text=False)


@_query
def op3_rules(spark: SparkSession, folder: str) -> DataFrame:
    return rules.judge(_table(spark, folder, "documents", "doc_id", "text")).select(*_OP3)


@_query
def op4_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents", "doc_id", "text")
    forest = quality.fit(docs, _table(spark, folder, "labels", "doc_id", "quality"))
    return quality.score(docs, forest, keep_text=False).select("doc_id", sampling.held_out().alias("held_out"), "score", "predicted")


@_query
def op5_passages(spark: SparkSession, folder: str) -> DataFrame:
    return passages.find(_table(spark, folder, "documents", "doc_id", "text"), keep_text=False)


@_query
def op6_bagminhash(spark: SparkSession, folder: str) -> DataFrame:
    return bagminhash.classify(_table(spark, folder, "documents", "doc_id", "text")).select("doc_id", "class_id")


@_query
def op7_lexicon(spark: SparkSession, folder: str) -> DataFrame:
    return lexicon.round_trip_digests(_table(spark, folder, "documents", "doc_id", "text"), VOCABULARY)


@_query
def op8_contamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents", "doc_id", "text")
    found = contamination.find_contamination(docs, _table(spark, folder, "benchmark", "item_id", "text"), keep_text=False)
    return found.drop("items")


@_query
def op9_warc(spark: SparkSession, folder: str) -> DataFrame:
    records = warc.archived(_table(spark, folder, "pages", "page_id", "url", "html"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@_query
def op10_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(_table(spark, folder, "documents", "doc_id", "text"), VOCABULARY, digests=True)


@_query
def op11_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.align(_table(spark, folder, "documents", "doc_id", "text"), VOCABULARY, PIECES, digests=True)


@_query
def op12_gramjoin(spark: SparkSession, folder: str) -> DataFrame:
    return gramjoin.join(_table(spark, folder, "documents", "doc_id", "text"), keep_text=False)


@_query
def op13_prefixtrie(spark: SparkSession, folder: str) -> DataFrame:
    return prefixtrie.trie(prefixtrie.reassembled(_table(spark, folder, "conversations", "conv_id", "turn", "role", "text")))


_OP3 = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]

_STOPS = ", ".join(f"'{w}'" for w in sorted({w for many in rules.STOP_WORDS.values() for w in many}))

ORACLE_SQL["op3_rules"] = rf"""
WITH texts AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents
), split AS (
  SELECT row, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
    list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines FROM texts
), grams AS (
  SELECT row, i, array_to_string(list_slice(words, i, i + {rules.REPEAT_WINDOW - 1}), ' ') AS gram
  FROM (SELECT row, words, unnest(range(1, len(words) - {rules.REPEAT_WINDOW - 2})) AS i FROM split WHERE len(words) >= {rules.REPEAT_WINDOW})
), twice AS (
  SELECT row, i FROM (SELECT row, i, count(*) OVER (PARTITION BY row, gram) AS n FROM grams) WHERE n > 1
), repeated AS (
  SELECT row, count(DISTINCT i + k) AS n FROM twice, (SELECT unnest(range(0, {rules.REPEAT_WINDOW})) AS k) GROUP BY row
), figures AS (
  SELECT doc_id, cast(len(words) AS BIGINT) AS n_words,
    cast(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
    cast(length(text) - length(translate(text, '{rules.SYMBOLS}', '')) AS BIGINT) AS n_symbols,
    cast(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    cast(coalesce(n, 0) AS BIGINT) AS n_repeat_words, cast(len(lines) AS BIGINT) AS n_lines,
    cast(length(text) - length(translate(text, '!', '')) AS BIGINT) AS n_marks,
    cast(len(list_filter(words, lambda w: lower(w) IN ({_STOPS}))) AS BIGINT) AS n_stop_words
  FROM split LEFT JOIN repeated USING (row)
), judged AS (SELECT *, {rules.BASE_FAILED} AS base_failed FROM figures)
SELECT {", ".join(_OP3[:-1])}, NOT base_failed AND {" AND ".join(r.condition() for r in rules.RULES)} AS kept FROM judged
"""

_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE_SQL["op8_contamination"] = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all({_LOWERED}, '{_WORD}') AS words FROM documents
), items AS (
  SELECT item_id, regexp_extract_all({_LOWERED}, '{_WORD}') AS words FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(len(words), {contamination.WINDOW}) AS size,
    array_to_string(list_slice(words, i, i + {contamination.WINDOW - 1}), ' ') AS gram
  FROM (SELECT item_id, words, unnest(range(1, greatest(len(words) - {contamination.WINDOW - 2}, 2))) AS i FROM items WHERE len(words) > 0)
), places AS (
  SELECT row, i, size, array_to_string(list_slice(words, i, i + size - 1), ' ') AS gram
  FROM (SELECT row, words, size, unnest(range(1, len(words) - size + 2)) AS i
        FROM docs, (SELECT DISTINCT size FROM windows) WHERE len(words) >= size)
), found AS (
  SELECT row, i, size, item_id FROM places JOIN windows USING (size, gram)
), words_hit AS (
  SELECT row, count(DISTINCT p) AS n FROM (SELECT row, unnest(range(i, i + size)) AS p FROM found) GROUP BY row
), items_hit AS (
  SELECT row, count(*) AS n, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT row, cast(item_id AS VARCHAR) AS item FROM found WHERE item_id IS NOT NULL) GROUP BY row
)
SELECT doc_id, cast(len(words) AS BIGINT) AS n_words, cast(coalesce(w.n, 0) AS BIGINT) AS n_hit, cast(coalesce(i.n, 0) AS BIGINT) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(w.n, 0) > 0 AND {contamination.PART} * coalesce(w.n, 0) >= len(words) AS contaminated
FROM docs LEFT JOIN words_hit w USING (row) LEFT JOIN items_hit i USING (row)
"""

ORACLE_SQL["op9_warc"] = f"""
WITH payloads AS (
  SELECT page_id, cast(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), last AS (
  SELECT payload_digest, max(page_id) AS last FROM payloads WHERE payload_bytes >= {warc.REVISIT_BYTES} GROUP BY payload_digest
), linked AS (
  SELECT p.*, CASE WHEN last IS NOT NULL AND last IS DISTINCT FROM page_id THEN last END AS refers_to FROM payloads p LEFT JOIN last USING (payload_digest)
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to FROM linked
"""

ORACLE_SQL["op12_gramjoin"] = rf"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all({_LOWERED}, '[^\x20\x09-\x0D]+') AS words FROM documents
), sets AS (
  SELECT DISTINCT row, array_to_string(list_slice(words, i, i + {gramjoin.SHINGLE - 1}), ' ') AS gram
  FROM (SELECT row, words, unnest(range(1, greatest(len(words) - {gramjoin.SHINGLE - 2}, 2))) AS i FROM docs WHERE len(words) > 0)
), sizes AS (SELECT row, count(*) AS n FROM sets GROUP BY row), links AS (
  SELECT a.row AS a, b.row AS b FROM sets a JOIN sets b ON a.gram = b.gram AND a.row != b.row
  JOIN sizes m ON m.row = a.row JOIN sizes n ON n.row = b.row
  GROUP BY a.row, b.row, m.n, n.n HAVING 100 * count(*) >= 85 * (m.n + n.n - count(*))
), reach(row, other) AS (
  SELECT row, row FROM docs UNION SELECT r.row, l.b FROM reach r JOIN links l ON r.other = l.a
)
SELECT d.doc_id, cast(coalesce(any_value(s.n), 0) AS BIGINT) AS n_shingles, min(o.doc_id) AS component_id
FROM docs d LEFT JOIN sizes s USING (row) JOIN reach r ON r.row = d.row JOIN docs o ON o.row = r.other GROUP BY d.row, d.doc_id
"""

ORACLE_SQL["op13_prefixtrie"] = f"""
WITH RECURSIVE ids AS (SELECT DISTINCT conv_id AS c FROM conversations WHERE conv_id IS NOT NULL), crc(c, bit, v) AS (
  SELECT c, 0, 4294967295 FROM ids
  UNION ALL
  SELECT c, bit + 1, CASE WHEN w & 1 = 1 THEN xor(w >> 1, 3988292384) ELSE w >> 1 END
  FROM (SELECT c, bit, CASE WHEN bit % 8 = 0 THEN xor(v, ord(substr(cast(c AS VARCHAR), bit // 8 + 1, 1))) ELSE v END AS w
        FROM crc WHERE bit < 8 * length(cast(c AS VARCHAR)))
), shared AS (
  SELECT c, xor(v, 4294967295) % {prefixtrie.SHARED} AS h FROM crc WHERE bit = 8 * length(cast(c AS VARCHAR))
), own AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS pos,
    coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), rebuilt AS (
  SELECT s.c, 0 AS part, pos, role, text FROM shared s JOIN own o ON o.c = s.c - s.c % {prefixtrie.GROUP} AND o.pos < s.h
  UNION ALL SELECT s.c, 1, pos, role, text FROM shared s JOIN own o ON o.c = s.c AND o.pos >= s.h
), turns AS (
  SELECT c, row_number() OVER (PARTITION BY c ORDER BY part, pos) AS depth, role, text FROM rebuilt
), places AS (
  SELECT c, 0 AS depth, '' AS name, 0 AS size FROM ids
  UNION ALL
  SELECT c, depth, string_agg(md5(length(role) || ':' || role || text), '/') OVER (PARTITION BY c ORDER BY depth), strlen(text) FROM turns
), nodes AS (
  SELECT depth, name, min(c) AS conv_id, count(*) AS n_convs, max(size) AS size FROM places GROUP BY depth, name
), placed AS (
  SELECT p.c, p.depth, n.conv_id, p.depth = max(p.depth) OVER (PARTITION BY p.c) AS ends FROM places p JOIN nodes n USING (depth, name)
), linked AS (
  SELECT n.*, p.conv_id AS parent_conv_id FROM nodes n LEFT JOIN placed p ON p.c = n.conv_id AND p.depth = n.depth - 1
), children AS (
  SELECT depth - 1 AS depth, parent_conv_id AS conv_id, count(*) AS n FROM linked WHERE depth > 0 GROUP BY ALL
), figures AS (
  SELECT l.*, coalesce(c.n, 0) AS n_children FROM linked l LEFT JOIN children c ON c.depth = l.depth AND c.conv_id = l.conv_id
), totals AS (
  SELECT p.depth, p.conv_id, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum((n_convs - 1) * size) AS saved
  FROM figures f JOIN placed p ON p.c = f.conv_id AND p.depth <= f.depth GROUP BY ALL
), ends AS (
  SELECT depth, conv_id, sha256(string_agg(cast(c AS VARCHAR), ',' ORDER BY c)) AS digest FROM placed WHERE ends GROUP BY ALL
)
SELECT f.conv_id, cast(f.depth AS BIGINT) AS depth, f.parent_conv_id, cast(f.n_convs AS BIGINT) AS n_convs, cast(f.n_children AS BIGINT) AS n_children,
  cast(t.n_leaves AS BIGINT) AS n_leaves, cast(t.saved AS BIGINT) AS saved_tokens, coalesce(e.digest, sha256('')) AS ends_sha256
FROM figures f JOIN totals t ON t.depth = f.depth AND t.conv_id = f.conv_id LEFT JOIN ends e ON e.depth = f.depth AND e.conv_id = f.conv_id
"""
