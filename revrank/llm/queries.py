"""The registered query of every operator of this folder, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from revrank.llm import language, licenses, minhash, packing, phrases, pieces, quality, secrets, spotsigs, toolcalls, toxicity, tries, vectors
from revrank.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_spot_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    return spotsigs.report(spotsigs.compared(table(spark, sf_dir, "documents")))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents and the texts decoded from them, as digests."""
    return pieces.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices of all documents."""
    return licenses.report(licenses.scan(table(spark, sf_dir, "documents")))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of all documents, told apart by the sources that share them."""
    return secrets.report(secrets.scan(table(spark, sf_dir, "documents")))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents, learned from the labels that are not held out."""
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All turns of all conversations as linked, ordered and validated calls."""
    calls, results, context = toolcalls.from_turns(table(spark, sf_dir, "conversations"))
    return toolcalls.linked_calls(calls, results, toolcalls.REPLY, context)


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8_vector_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all vectors within their labels."""
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 4096 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents by a classifier chain."""
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prefix trie over all conversations."""
    return tries.prefix_trie(table(spark, sf_dir, "conversations"))


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 best phrases of every language over all documents."""
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op13_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents, learned from those that are not held out."""
    return language.classify(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_spot_signatures": op1_spot_signatures,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_license_scan": op3_license_scan,
    "op4_secret_scan": op4_secret_scan,
    "op5_quality": op5_quality,
    "op6_tool_calls": op6_tool_calls,
    "op7_minhash_near_dedup": op7_minhash_near_dedup,
    "op8_vector_near_dedup": op8_vector_near_dedup,
    "op9_packing": op9_packing,
    "op10_toxicity": op10_toxicity,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_phrase_collocations": op12_phrase_collocations,
    "op13_language": op13_language,
}

ORACLES: dict[str, str] = {
    "op6_tool_calls": """
WITH asked AS (
  SELECT conv_id, turn, text, 'call_' || turn AS call_id, CASE WHEN conv_id IS NOT NULL THEN min(turn) OVER (PARTITION BY conv_id) END AS first_turn
  FROM conversations WHERE role = 'user'),
numbered AS (
  SELECT conv_id, turn, text, 'call_' || (turn - 1) AS call_id, conv_id IS NOT NULL AND turn IS NOT NULL AS known,
         row_number() OVER (PARTITION BY conv_id, turn ORDER BY text NULLS FIRST) AS nth, count(*) OVER (PARTITION BY conv_id, turn) AS n
  FROM conversations WHERE role = 'assistant'),
answers AS (SELECT * FROM numbered WHERE known AND nth = 1 UNION ALL SELECT * REPLACE (1 AS n) FROM numbered WHERE NOT known),
linked AS (
  SELECT coalesce(a.conv_id, r.conv_id) AS conversation, coalesce(a.call_id, r.call_id) AS call_id, a.turn,
         r.turn AS result_turn, CASE WHEN a.is_call THEN 'reply' END AS name,
         CASE WHEN a.is_call IS NULL THEN 'orphan' WHEN r.n IS NULL THEN 'unanswered'
              WHEN r.turn < a.turn THEN 'early' ELSE 'linked' END AS status,
         coalesce(r.n, 0) AS n_results,
         CASE WHEN a.is_call AND a.conv_id IS NOT NULL AND a.call_id IS NOT NULL THEN CAST(a.turn > first_turn AS INTEGER) END AS level,
         CASE WHEN a.is_call IS NULL THEN NULL ELSE concat_ws('; ', CASE WHEN a.text IS NULL THEN 'missing: text' END, CASE WHEN a.turn IS NULL THEN 'missing: turn' END) END AS problems,
         a.text, first_turn, r.text AS answer
  FROM (SELECT *, true AS is_call FROM asked) a FULL JOIN answers r ON a.conv_id = r.conv_id AND a.call_id = r.call_id
  UNION ALL
  SELECT conv_id, call_id, NULL, turn, NULL, 'extra', 0, NULL, NULL, NULL, NULL, text FROM numbered WHERE known AND nth > 1
  UNION ALL
  SELECT conv_id, NULL, turn, NULL, role, 'context', 0, NULL, NULL, NULL, NULL, text FROM conversations WHERE role IS NULL OR role NOT IN ('user', 'assistant')),
written AS (
  SELECT *, '{' || concat_ws(',',
      CASE WHEN problems IS NOT NULL THEN '"arguments":{' || concat_ws(',', '"text":' || CAST(to_json(text) AS VARCHAR),
        CASE WHEN level = 1 THEN '"topic":{"$call":"call_' || first_turn || '"}' END, '"turn":' || turn) || '}' END,
      '"id":"' || call_id || '"', '"level":' || level, '"name":"' || name || '"',
      '"result":' || CAST(to_json(answer) AS VARCHAR), '"status":"' || status || '"',
      '"valid":' || (problems = '')) || '}' AS json
  FROM linked)
SELECT conversation, call_id, turn, result_turn, name, status, n_results, level, problems, json,
       row_number() OVER (ORDER BY conversation NULLS FIRST, coalesce(level, 2147483647), coalesce(turn, result_turn) NULLS FIRST, call_id NULLS FIRST, json NULLS FIRST) AS position
FROM written""",
    "op11_prefix_trie": r"""
WITH turns AS (
  SELECT conv_id AS c, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS tid,
         strlen(coalesce(text, '')) AS size, turn
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT c, list(tid ORDER BY turn NULLS FIRST, tid) AS ids, list(size ORDER BY turn NULLS FIRST, tid) AS sizes, CAST(c AS VARCHAR) AS s
  FROM turns GROUP BY c),
sums AS (
  SELECT *, xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], range(0, 8 * length(s))), lambda crc, i:
    CASE WHEN (CASE WHEN i % 8 = 0 THEN xor(crc, ord(substr(s, i // 8 + 1, 1))::BIGINT) ELSE crc END) & 1 = 1
         THEN xor((CASE WHEN i % 8 = 0 THEN xor(crc, ord(substr(s, i // 8 + 1, 1))::BIGINT) ELSE crc END) >> 1, 3988292384)
         ELSE (CASE WHEN i % 8 = 0 THEN xor(crc, ord(substr(s, i // 8 + 1, 1))::BIGINT) ELSE crc END) >> 1 END)) % 9 AS h
  FROM own),
rebuilt AS (
  SELECT a.c, list_concat(coalesce(list_slice(b.ids, 1, a.h), []), list_slice(a.ids, a.h + 1, len(a.ids))) AS ids,
         list_concat(coalesce(list_slice(b.sizes, 1, a.h), []), list_slice(a.sizes, a.h + 1, len(a.sizes))) AS sizes
  FROM sums a LEFT JOIN own b ON b.c = a.c - a.c % 5),
prefixes AS (SELECT c, ids, sizes, unnest(range(0, len(ids) + 1)) AS d FROM rebuilt),
nodes AS (
  SELECT list_slice(ids, 1, d) AS path, d, min(c) AS conv_id, count(*) AS n_convs,
         CASE WHEN d = 0 THEN 0 ELSE (count(*) - 1) * any_value(sizes[d]) END AS own_saved,
         sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE len(ids) = d), '')) AS ends_sha256
  FROM prefixes GROUP BY list_slice(ids, 1, d), d),
kids AS (SELECT list_slice(path, 1, d - 1) AS path, d - 1 AS d, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL),
full_nodes AS (SELECT n.*, coalesce(k.n_children, 0) AS n_children FROM nodes n LEFT JOIN kids k ON k.path = n.path AND k.d = n.d),
upward AS (SELECT path, unnest(range(0, d + 1)) AS up, own_saved, CAST(n_children = 0 AS INTEGER) AS leaf FROM full_nodes),
sums_up AS (SELECT list_slice(path, 1, up) AS path, up AS d, sum(own_saved) AS saved, sum(leaf) AS leaves FROM upward GROUP BY ALL)
SELECT n.conv_id, n.d AS depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, CAST(u.leaves AS BIGINT) AS n_leaves,
       CAST(u.saved AS BIGINT) AS saved_tokens, n.ends_sha256
FROM full_nodes n JOIN sums_up u ON u.path = n.path AND u.d = n.d
LEFT JOIN nodes p ON n.d > 0 AND p.d = n.d - 1 AND p.path = list_slice(n.path, 1, n.d - 1)""",
    "op12_phrase_collocations": r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents WHERE text IS NOT NULL),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words),
totals AS (SELECT lang, count(*) AS n FROM starts GROUP BY lang),
grams AS (
  SELECT lang, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS phrase, count(*) AS f
  FROM starts, (VALUES (1), (2), (3), (4)) AS sizes(k)
  WHERE i + k - 1 <= len(w) GROUP BY ALL),
often AS (SELECT *, string_split(phrase, ' ') AS w FROM grams WHERE f >= 30),
above AS (
  SELECT lang, array_to_string(list_slice(w, i, i + m - 1), ' ') AS phrase, max(f) AS longer
  FROM (SELECT *, unnest(range(1, k - m + 2)) AS i FROM often, (VALUES (2), (3)) AS sizes(m) WHERE m < k)
  GROUP BY ALL),
kept AS (
  SELECT o.* FROM often o LEFT JOIN above a ON o.lang = a.lang AND o.phrase = a.phrase
  WHERE o.k > 1 AND (a.longer IS NULL OR 100::HUGEINT * a.longer < 80::HUGEINT * o.f)),
cuts AS (SELECT *, unnest(range(1, k)) AS cut FROM kept),
scored AS (
  SELECT c.lang, c.phrase, c.f AS a, x.f AS l, y.f AS r, c.cut, (2000000::HUGEINT * c.f) // (x.f + y.f) AS score
  FROM cuts c
  JOIN often x ON x.lang = c.lang AND x.phrase = array_to_string(list_slice(c.w, 1, c.cut), ' ')
  JOIN often y ON y.lang = c.lang AND y.phrase = array_to_string(list_slice(c.w, c.cut + 1, c.k), ' ')),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000""",
}
