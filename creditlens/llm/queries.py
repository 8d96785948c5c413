"""The operators on the driver tables: ``QUERIES`` (name -> fn(spark, sf_dir)) and ``ORACLE`` SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditlens.llm import (chat, decontaminate, exact_dedup, html_text, language, lm, mixing, prefix_trie, quality, simhash,
                            substring_dedup, token_align, token_files)
from creditlens.sources.tables import Tables


def op1_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash.near_duplicates(Tables(spark, sf_dir).documents, shingle=4, max_bits=4)
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(Tables(spark, sf_dir).conversations)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(Tables(spark, sf_dir).documents, modulus=4, remainder=2)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    return quality.score(t.documents, t.labels)


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    found = decontaminate.find(t.documents, t.benchmark, window=10)
    n_hit = F.aggregate("ranges", F.lit(0), lambda a, r: a + r["end"] - r["start"]).cast("long")
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(Tables(spark, sf_dir).documents, window=35)


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(Tables(spark, sf_dir).pages)


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.write_and_read(Tables(spark, sf_dir).documents)


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.mix(Tables(spark, sf_dir).documents)
    return rows.select("doc_id", "size", F.get("source_sizes", F.lit(0)).alias("source_size"),
                       F.get("targets", F.lit(0)).alias("target"), "taken")


def op10_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(Tables(spark, sf_dir).documents)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(Tables(spark, sf_dir).conversations)


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = token_align.align(Tables(spark, sf_dir).documents)
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2(F.col("groups").cast("binary"), 256))
    return rows.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", digest.alias("groups_sha256"))


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = exact_dedup.find_duplicates(Tables(spark, sf_dir).documents)
    return rows.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


QUERIES = {f.__name__: f for f in (
    op1_simhash_dedup, op2_chat_format, op3_language_id, op4_quality_rules, op5_decontaminate, op6_substring_dedup,
    op7_html_text, op8_token_files, op9_mix_sources, op10_lm_scores,
    op11_prefix_trie, op12_token_alignment, op13_exact_dedup)}

_FOLDED = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), " \
          "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

ORACLE = {
    "op2_chat_format": """
WITH conv AS (
    SELECT conv_id, count(*) AS n_turns,
           list(struct_pack(r := coalesce(role, ''), t := coalesce(text, '')) ORDER BY turn NULLS FIRST) AS turns
    FROM conversations GROUP BY conv_id),
whole AS (SELECT turns, n_turns, min(conv_id) AS conv_id, count(*) AS n_copies FROM conv GROUP BY turns, n_turns),
proper AS (
    SELECT DISTINCT turns[1:k] AS turns
    FROM (SELECT turns, unnest(range(1, len(turns))) AS k FROM conv))
SELECT conv_id, n_turns, n_copies,
       array_to_string(list_transform(turns, lambda x: '<|im_start|>' || x.r || chr(10) || x.t || '<|im_end|>' || chr(10)), '') AS text
FROM whole ANTI JOIN proper USING (turns)""",
    "op6_substring_dedup": r"""
WITH doc AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (
    SELECT doc_id, i, array_to_string(w[i:i + 34], ' ') AS k
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM doc WHERE len(w) >= 35)),
rep AS (SELECT k FROM win GROUP BY k HAVING count(*) > 1),
hit AS (
    SELECT doc_id, list(DISTINCT j) AS js
    FROM (SELECT doc_id, unnest(range(i, i + 35)) AS j FROM win SEMI JOIN rep USING (k)) GROUP BY doc_id)
SELECT doc.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(js), 0) AS BIGINT) AS n_removed,
       sha256(array_to_string(CASE WHEN js IS NULL THEN w
           ELSE list_transform(list_filter(range(1, len(w) + 1), lambda j: NOT list_contains(js, j)), lambda j: w[j]) END, ' '))
       AS kept_sha256
FROM doc LEFT JOIN hit USING (doc_id)""",
    "op5_decontaminate": f"""
WITH item AS (SELECT item_id, {_FOLDED} AS w FROM benchmark),
win AS (
    SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS k
    FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM item WHERE len(w) > 0)),
doc AS (SELECT doc_id, {_FOLDED} AS w FROM documents),
starts AS (
    SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS k
    FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
          FROM doc, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
hit AS (SELECT DISTINCT doc_id, i, starts.n, item_id FROM starts JOIN win USING (n, k)),
words AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM hit) GROUP BY ALL),
items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hit) GROUP BY ALL)
SELECT doc.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)""",
    # crc32 of a decimal id: the table-driven form, one step per digit
    "op11_prefix_trie": """
WITH own AS (
    SELECT conv_id, list(struct_pack(r := coalesce(role, ''), t := coalesce(text, '')) ORDER BY turn NULLS FIRST) AS turns
    FROM conversations GROUP BY conv_id),
crc AS (
    SELECT list(list_reduce(list_prepend(i, range(8)),
                            lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS tab
    FROM range(256) AS t(i)),
opening AS (
    SELECT conv_id, turns, xor(4294967295, list_reduce(
        list_prepend(4294967295, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
        lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1]))) % 6 AS h
    FROM own, crc),
conv AS (
    SELECT o.conv_id, list_concat(coalesce(b.turns, o.turns[1:0])[1:o.h], o.turns[o.h + 1:]) AS turns
    FROM opening o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 100),
pre AS (
    SELECT conv_id, len(turns) AS n, k AS depth, turns[1:k] AS p
    FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS k FROM conv)),
node AS (
    SELECT p, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * coalesce(length(p[depth].t), 0) AS own,
           sha256(coalesce(string_agg(CASE WHEN n = depth THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id), '')) AS ends_sha256
    FROM pre GROUP BY p, depth),
kids AS (SELECT p[1:depth - 1] AS p, depth - 1 AS depth, count(*) AS n_children FROM node WHERE depth > 0 GROUP BY ALL),
below AS (
    SELECT p[1:k] AS p, k AS depth, CAST(sum(own) AS BIGINT) AS saved_tokens, count(*) FILTER (n_children IS NULL) AS n_leaves
    FROM (SELECT node.*, n_children, unnest(range(0, node.depth + 1)) AS k FROM node LEFT JOIN kids USING (p, depth))
    GROUP BY ALL)
SELECT node.conv_id, node.depth, up.conv_id AS parent_conv_id, node.n_convs, coalesce(n_children, 0) AS n_children,
       n_leaves, saved_tokens, node.ends_sha256
FROM node LEFT JOIN kids USING (p, depth) JOIN below USING (p, depth)
LEFT JOIN node up ON up.depth = node.depth - 1 AND up.p = node.p[1:node.depth - 1] AND node.depth > 0""",
    "op13_exact_dedup": """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
}
