"""The registered queries of this subpackage and SQL for the same results."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowsift.llm import (
    conversation_repair,
    exact_dedup,
    html_text,
    language_id,
    license_scan,
    merkle,
    mixing,
    near_dedup,
    prefix_bpe,
    quality_rules,
    quality_votes,
    sentence_pieces,
    token_counts,
)
from flowsift.llm.common import read_table


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE tokens of every document."""
    return token_counts.count_tokens(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base statistics, log-likelihood ratio and verdict of every document."""
    return quality_rules.judge(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents whose sets of 3-word shingles are similar by 85 % or more."""
    found = near_dedup.find_groups(read_table(spark, sf_dir, "documents"), length=3, percent=85, stored=True)
    first = F.col("doc_id").eqNullSafe(F.col("component_id"))
    return found.select("doc_id", "n_shingles", "component_id", first.alias("kept"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact copies among all documents: which row of each group stays."""
    found = exact_dedup.find_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", exact_dedup.DIGEST)


OP4_SQL = """
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)
"""


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_text.extract(read_table(spark, sf_dir, "pages"))


def op6_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every document, a digest of their ids, and whether they decode to the text."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    docs = read_table(spark, sf_dir, "documents")
    return sentence_pieces.checked(docs, model)


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document by its nearest labelled neighbours."""
    return quality_votes.score(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every page; texts are judged by what all labelled documents show."""
    return language_id.identify(read_table(spark, sf_dir, "pages"), read_table(spark, sf_dir, "documents"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes from every document."""
    taken = mixing.taken_per_document(read_table(spark, sf_dir, "documents"))
    return taken.select("doc_id", "size", "source_size", "target", "taken", "first_slot", "n_slots")


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices in documents, with matched coverage and spans."""
    return license_scan.scan(read_table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle manifest of all documents by language, and what its proofs say of tampered ones."""
    found = merkle.check(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


# Levels are added and proofs folded one step a pass; the CRC-32 is that of the decimal id.
OP11_SQL = """
WITH RECURSIVE
crc_table AS (
  SELECT list(list_reduce(list_concat([i], [0, 0, 0, 0, 0, 0, 0, 0]),
                          lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM (SELECT CAST(unnest(range(256)) AS BIGINT) AS i)),
fields AS (
  SELECT doc_id, lang, n_chars,
         coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') AS f_id,
         coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') AS f_place,
         coalesce(strlen(text) || ':' || text, '-') AS f_text
  FROM documents),
hashed AS (
  SELECT doc_id, lang, sha256(f_id || f_place || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') || f_text) AS leaf,
         CASE WHEN n_chars IS NOT NULL AND xor(list_reduce(
                list_concat([CAST(4294967295 AS BIGINT)], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda ch: CAST(ascii(ch) AS BIGINT))),
                lambda c, b: xor(c >> 8, t[CAST((xor(c, b) & 255) + 1 AS BIGINT)])), 4294967295) % 7 = 0
              THEN sha256(f_id || f_place || strlen(CAST(n_chars + 1 AS VARCHAR)) || ':' || (n_chars + 1) || f_text) END AS changed
  FROM fields, crc_table),
groups AS (SELECT lang, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree, count(*) AS n FROM hashed GROUP BY lang),
placed AS (
  SELECT g.tree, g.n, h.doc_id, h.leaf, coalesce(h.changed, h.leaf) AS now,
         row_number() OVER (PARTITION BY g.tree ORDER BY h.doc_id NULLS FIRST, h.leaf) - 1 AS pos
  FROM hashed h JOIN groups g ON h.lang IS NOT DISTINCT FROM g.lang),
nodes AS (
  SELECT tree, 0 AS level, pos, leaf AS h, n FROM placed
  UNION ALL
  SELECT tree, level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (max(n) + 1) // 2
  FROM nodes WHERE n > 1 GROUP BY tree, level, pos // 2),
tops AS (
  SELECT 0 AS level, tree AS pos, h, (SELECT count(*) FROM groups) AS n FROM nodes WHERE n = 1
  UNION ALL
  SELECT level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (max(n) + 1) // 2
  FROM tops WHERE n > 1 GROUP BY level, pos // 2),
climbed AS (
  SELECT tree, pos AS leaf_pos, 0 AS level, pos, now AS h, '' AS proof, n FROM placed
  UNION ALL
  SELECT c.tree, leaf_pos, c.level + 1, c.pos // 2,
         sha256(CASE WHEN s.h IS NULL THEN c.h WHEN c.pos % 2 = 1 THEN s.h || c.h ELSE c.h || s.h END),
         proof || coalesce(s.h, ''), (c.n + 1) // 2
  FROM climbed c LEFT JOIN nodes s ON s.tree = c.tree AND s.level = c.level AND s.pos = xor(c.pos, 1)
  WHERE c.n > 1),
out AS (
  SELECT tree, leaf_pos, 0 AS level, tree AS pos, h, proof, (SELECT count(*) FROM groups) AS n FROM climbed WHERE n = 1
  UNION ALL
  SELECT o.tree, leaf_pos, o.level + 1, o.pos // 2,
         sha256(CASE WHEN s.h IS NULL THEN o.h WHEN o.pos % 2 = 1 THEN s.h || o.h ELSE o.h || s.h END),
         proof || coalesce(s.h, ''), (o.n + 1) // 2
  FROM out o LEFT JOIN tops s ON s.level = o.level AND s.pos = xor(o.pos, 1)
  WHERE o.n > 1)
SELECT p.doc_id, p.leaf, (SELECT h FROM nodes r WHERE r.n = 1 AND r.tree = p.tree) AS subroot,
       (SELECT h FROM tops WHERE n = 1) AS root, sha256(o.proof) AS proof_sha256,
       o.h AS folded_root, o.h = (SELECT h FROM tops WHERE n = 1) AS verified
FROM placed p JOIN out o ON o.tree = p.tree AND o.leaf_pos = p.pos AND o.n = 1
"""


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every damaged conversation."""
    found = conversation_repair.repair_damaged(read_table(spark, sf_dir, "conversations"))
    return found.select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"
    )


# One pass per row: the least (cost, audit) that reaches each state, with the lines it leaves.
# The VALUES list what inserted rows and then one edit of a row can do between states.
OP12_SQL = """
WITH RECURSIVE
crc_table AS (
  SELECT list(list_reduce(list_concat([i], [0, 0, 0, 0, 0, 0, 0, 0]),
                          lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM (SELECT CAST(unnest(range(256)) AS BIGINT) AS i)),
given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(list_reduce(
           list_concat([CAST(4294967295 AS BIGINT)],
             list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
                            lambda ch: CAST(ascii(ch) AS BIGINT))),
           lambda c, b: xor(c >> 8, t[CAST((xor(c, b) & 255) + 1 AS BIGINT)])), 4294967295) % 20 AS k
  FROM conversations, crc_table),
harmed AS (
  SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN k = 1 THEN '' WHEN k = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM given, (VALUES (0), (1)) AS copies(copy) WHERE k <> 0 AND (copy = 0 OR k = 3)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(concat(length(role), ':', role, text))) AS i,
         right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS last
  FROM harmed),
judged AS (
  SELECT *, left(role, 1) AS initial, lag(left(role, 1)) OVER c AS earlier,
         CASE WHEN last = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
              WHEN last NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
  FROM placed WINDOW c AS (PARTITION BY conv_id ORDER BY i)),
counted AS (
  SELECT conv_id, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (earlier IS NOT NULL AND earlier || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY conv_id),
goes(state, gap, cost, audit, lines) AS (
  VALUES ('-', '-', 0, '', []), ('-', 'u', 3, 'I', ['user:']), ('-', 'a', 6, 'II', ['user:', 'assistant:']),
         ('s', 's', 0, '', []), ('s', 'u', 3, 'I', ['user:']), ('s', 'a', 6, 'II', ['user:', 'assistant:']),
         ('u', 'u', 0, '', []), ('u', 'a', 3, 'I', ['assistant:']),
         ('a', 'a', 0, '', []), ('a', 'u', 3, 'I', ['user:'])),
edits(gap, edit, state, initial, cost) AS (
  VALUES ('-', 'D', '-', NULL, 4), ('s', 'D', 's', NULL, 4), ('u', 'D', 'u', NULL, 4), ('a', 'D', 'a', NULL, 4),
         ('-', 'R', 'u', NULL, 3), ('s', 'R', 'u', NULL, 3), ('u', 'R', 'a', NULL, 3), ('a', 'R', 'u', NULL, 3),
         ('-', 'K', 's', 's', 0), ('-', 'K', 'u', 'u', 0), ('s', 'K', 'u', 'u', 0), ('a', 'K', 'u', 'u', 0), ('u', 'K', 'a', 'a', 0),
         ('-', 'K', '-', '', 0), ('s', 'K', 's', '', 0), ('u', 'K', 'u', '', 0), ('a', 'K', 'a', '', 0)),
found AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, '-' AS state, {'cost': 0, 'audit': '', 'lines': CAST([] AS VARCHAR[])} AS best
  FROM counted
  UNION ALL
  SELECT f.conv_id, f.i + 1, e.state,
         min({'cost': f.best.cost + g.cost + e.cost + CASE WHEN e.edit <> 'D' AND r.fault = 'truncated' THEN 3 ELSE 0 END,
              'audit': f.best.audit || g.audit || e.edit,
              'lines': list_concat(f.best.lines, g.lines, CASE e.edit WHEN 'D' THEN [] WHEN 'K' THEN [r.role || ':' || r.text]
                         ELSE [CASE e.state WHEN 'u' THEN 'user:' ELSE 'assistant:' END || r.text] END)})
  FROM found f JOIN judged r ON r.conv_id IS NOT DISTINCT FROM f.conv_id AND r.i = f.i + 1
       JOIN goes g ON g.state = f.state
       JOIN edits e ON e.gap = g.gap AND (e.edit = 'D' OR r.fault NOT IN ('blank', 'duplicate')) AND (e.edit <> 'K' OR e.initial = r.initial)
  GROUP BY f.conv_id, f.i, e.state),
ended AS (
  SELECT c.conv_id, min({'cost': f.best.cost + g.cost, 'audit': f.best.audit || g.audit, 'lines': list_concat(f.best.lines, g.lines)}) AS best
  FROM counted c JOIN found f ON f.conv_id IS NOT DISTINCT FROM c.conv_id AND f.i = c.n
       JOIN goes g ON g.state = f.state AND g.gap IN ('-', 'a')
  GROUP BY c.conv_id)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(e.best.cost, 0) AS BIGINT) AS cost,
       coalesce(e.best.audit, '') AS audit, sha256(coalesce(array_to_string(e.best.lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
     LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
     LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM o.conv_id
"""


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of every document and the bytes that they decode to, as digests."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return prefix_bpe.round_trip(read_table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


# Sources that stop at their limit are found by repeated passes here. Points are exact in
# 128-bit numbers; a slot takes the block of its rank, and slots that are missing come last.
OP9_SQL = """
WITH RECURSIVE d AS (
  SELECT doc_id, source,
         CAST(len(list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')) AS BIGINT) AS size,
         md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS key
  FROM documents),
s AS (
  SELECT source, sum(size) AS source_size,
         CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS DOUBLE) AS weight
  FROM d GROUP BY source),
t AS (SELECT CAST(sum(source_size) AS DOUBLE) AS total FROM s),
pass AS (
  SELECT 0 AS step, (SELECT total FROM t) / (SELECT sum(weight) FROM s) AS level
  UNION ALL
  SELECT step + 1, (SELECT (t.total - coalesce(sum(3 * source_size) FILTER (p.level * weight > 3 * source_size), 0))
                         / sum(weight) FILTER (NOT p.level * weight > 3 * source_size) FROM s, t GROUP BY t.total)
  FROM pass p WHERE step < 40),
goal AS (
  SELECT source, CAST(source_size AS BIGINT) AS source_size, least(CAST(3 * source_size AS DOUBLE), weight * (SELECT max(level) FROM pass)) AS target FROM s),
line AS (
  SELECT *, CAST(floor(target) AS BIGINT) AS n, sum(target) OVER (ORDER BY source NULLS LAST ROWS UNBOUNDED PRECEDING) AS upto,
         sum(target) OVER () AS whole, CAST(ceil(source_size / 256) AS BIGINT) AS n_blocks
  FROM goal),
need AS (
  SELECT *, n // nullif(source_size, 0) * n_blocks + CAST(ceil(n % nullif(source_size, 0) / 256) AS BIGINT) AS wanted FROM line),
points AS (
  SELECT slot, CAST((CAST(slot + 1 AS HUGEINT) * 11400714819323198485) % 18446744073709551616 AS DOUBLE) / 18446744073709551616.0 AS x
  FROM range(CAST((SELECT floor(max(whole) / 256) + 1 FROM line) AS BIGINT)) AS r(slot)),
hit AS (
  SELECT slot, source, row_number() OVER (PARTITION BY source ORDER BY slot) - 1 AS rank
  FROM points JOIN need ON x >= (upto - target) / whole AND x < upto / whole),
late AS (
  SELECT source, unnest(range(coalesce(served, 0), wanted)) AS rank
  FROM need LEFT JOIN (SELECT source AS s, count(*) AS served FROM hit GROUP BY source) ON s IS NOT DISTINCT FROM source
  WHERE n > 0 AND coalesce(served, 0) < wanted),
slots AS (
  SELECT slot, source, rank FROM hit
  UNION ALL
  SELECT (SELECT count(*) FROM points) + row_number() OVER (ORDER BY rank, source NULLS LAST) - 1, source, rank FROM late),
used AS (
  SELECT slot, h.source, rank % n_blocks AS block,
         least(256, source_size - rank % n_blocks * 256, n - (rank // n_blocks * source_size + rank % n_blocks * 256)) AS take
  FROM slots h JOIN need g ON h.source IS NOT DISTINCT FROM g.source WHERE rank < wanted),
goal_n AS (SELECT source, source_size, target, n FROM line),
placed AS (
  SELECT d.*, g.source_size, g.target, g.n,
         CAST(coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY key, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
  FROM d JOIN goal_n g ON d.source IS NOT DISTINCT FROM g.source),
pieces AS (
  SELECT doc_id, source, start, size, unnest(range(start // 256, (start + size - 1) // 256 + 1)) AS block FROM placed WHERE size > 0),
taken AS (
  SELECT doc_id, p.source, p.start, min(slot) AS first_slot, count(*) AS n_slots,
         sum(least(p.start + size, p.block * 256 + take) - greatest(p.start, p.block * 256)) AS taken
  FROM pieces p JOIN used u ON u.source IS NOT DISTINCT FROM p.source AND u.block = p.block
  WHERE least(p.start + size, p.block * 256 + take) > greatest(p.start, p.block * 256)
  GROUP BY doc_id, p.source, p.start)
SELECT p.doc_id, p.size, p.source_size, p.target, CAST(coalesce(t.taken, 0) AS BIGINT) AS taken,
       first_slot, CAST(coalesce(n_slots, 0) AS BIGINT) AS n_slots
FROM placed p LEFT JOIN taken t ON p.doc_id IS NOT DISTINCT FROM t.doc_id AND p.source IS NOT DISTINCT FROM t.source AND p.start = t.start AND p.size > 0
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_quality_rules": op2_quality_rules,
    "op3_near_dedup": op3_near_dedup,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_html_extraction": op5_html_extraction,
    "op6_sentence_pieces": op6_sentence_pieces,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_language_id": op8_language_id,
    "op9_mixing": op9_mixing,
    "op10_license_scan": op10_license_scan,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_byte_bpe": op13_byte_bpe,
}

SQL: dict[str, str] = {
    "op4_exact_dedup": OP4_SQL,
    "op9_mixing": OP9_SQL,
    "op11_merkle_manifest": OP11_SQL,
    "op12_conversation_repair": OP12_SQL,
}
