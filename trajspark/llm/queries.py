"""Registered queries of this package and their SQL counterparts."""

from __future__ import annotations

import string

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trajspark.llm.byte_bpe import token_digests
from trajspark.llm.common import read_table
from trajspark.llm.conversation_repair import damaged, repair_conversations
from trajspark.llm.decontamination import contamination
from trajspark.llm.exact_dedup import exact_duplicates
from trajspark.llm.hard_negatives import hard_negatives
from trajspark.llm.html_text import extract_text
from trajspark.llm.quality import score_documents, train
from trajspark.llm.sharding import shard_documents
from trajspark.llm.simhash import near_duplicates
from trajspark.llm.substring_dedup import remove_repeats
from trajspark.llm.suffix_dedup import remove_repeated_windows
from trajspark.llm.token_files import token_file_digests
from trajspark.llm.url_filter import judge_urls

RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))


def lpt_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(read_table(spark, sf_dir, "documents"), shards=40)


def html_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(read_table(spark, sf_dir, "pages"))


def de_bruijn_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read_table(spark, sf_dir, "documents"))


def url_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.sql("SELECT * FROM VALUES " + ", ".join(map(str, RULES)) + " AS r(host, path, verdict)")
    return judge_urls(read_table(spark, sf_dir, "pages"), rules, default="allow")


def co_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return score_documents(docs, train(docs, read_table(spark, sf_dir, "labels")))


def exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(read_table(spark, sf_dir, "documents"))


def positional_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def golay_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"))


def byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def huffman_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_file_digests(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), added_tokens=True)


def threshold_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(read_table(spark, sf_dir, "embeddings"), label=label, is_anchor=lambda i: i % 50 == 0)


def dawg_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_conversations(read_table(spark, sf_dir, "conversations"), damage=damaged)


def radix_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_windows(read_table(spark, sf_dir, "documents"), length=100)


QUERIES = {
    "op1_lpt_shards": lpt_shards, "op2_html_blocks": html_blocks,
    "op3_de_bruijn_repeats": de_bruijn_repeats, "op4_url_cascade": url_cascade,
    "op5_positional_index": positional_index, "op6_byte_bpe": byte_bpe, "op7_co_training": co_training,
    "op8_exact_dedup": exact_dedup, "op9_golay_simhash": golay_simhash,
    "op10_huffman_files": huffman_files, "op11_threshold_negatives": threshold_negatives,
    "op12_radix_suffixes": radix_suffixes, "op13_dawg_repair": dawg_repair,
}

_LOWER = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_FITS = " ".join(
    f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{h}{p}'"
    for h, p, _ in sorted(RULES, key=lambda r: -len(r[0] + r[1]))
)
_VERDICTS = " ".join(f"WHEN '{h}{p}' THEN '{v}'" for h, p, v in RULES)

def _edit(cost: int | str, letter: str, rest: str) -> str:
    """A value of ten digits of cost and the audit, after one more edit before it."""
    return f"printf('%010d', CAST(left({rest}, 10) AS BIGINT) + {cost}) || '{letter}' || substr({rest}, 11)"


def _first(state: int, keeps: list[tuple[str, int]]) -> str:
    """The best of delete, rerole and keep of a row in one grammar state; ``keeps`` are the initials it takes and where they lead."""
    after = (2, 2, 3, 2)[state]
    kept = " ".join(f"WHEN ini = '{i}' THEN {_edit('t', 'K', f'v{to}')}" for i, to in keeps)
    rerole = _edit("2 + t", "R", f"v{after}")
    return f"least({_edit(3, 'D', f'v{state}')}, CASE WHEN NOT gone THEN {rerole} END, CASE WHEN NOT gone THEN CASE {kept} END END)"


ORACLES = {
    "op3_de_bruijn_repeats": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
runs AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS run FROM (SELECT *, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i
         FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY run) AS first_id FROM runs) WHERE first_id < doc_id),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
marked AS (SELECT doc_id, word, i, gone.i IS NOT NULL AS removed FROM words LEFT JOIN gone USING (doc_id, i)),
kept AS (SELECT doc_id, count(*) FILTER (removed) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (NOT removed) AS kept
         FROM marked GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)""",
    "op4_url_cascade": f"""
WITH cut AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (SELECT page_id, translate(coalesce(regexp_extract(rest, '^[^/?#]*'), ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS host,
                 coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM cut),
ruled AS (SELECT *, CASE {_FITS} END AS rule FROM parts)
SELECT page_id, host, path, rule, CASE rule {_VERDICTS} ELSE 'allow' END AS verdict FROM ruled""",
    "op5_positional_index": f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_ALNUM}') AS w FROM documents),
items AS (SELECT item_id, regexp_extract_all({_LOWER}, '{_ALNUM}') AS w FROM benchmark),
phrases AS (SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS phrase
            FROM (SELECT *, unnest(range(1, greatest(len(w) - 10 + 1, 1) + 1)) AS i FROM items WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM phrases),
runs AS (SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS phrase
         FROM (SELECT doc_id, w, size, unnest(range(1, greatest(len(w) - size + 1, 0) + 1)) AS i FROM d, sizes)),
hits AS (SELECT DISTINCT doc_id, item_id, size, i FROM runs JOIN phrases USING (size, phrase)),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hits) GROUP BY 1),
names AS (SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS name FROM hits) GROUP BY 1)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN names USING (doc_id)""",
    "op8_exact_dedup": f"""
WITH d AS (SELECT doc_id, {_LOWER} AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256 FROM d""",
    "op12_radix_suffixes": r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
cut AS (SELECT doc_id, len(h) // 2 AS n, j, substr(h, 2 * j + 1, 1198) AS part FROM (SELECT *, unnest(range(0, len(h) // 2, 500)) AS j FROM d)),
b AS (SELECT doc_id, n, j + k AS i, substr(part, 2 * k + 1, 200) AS win FROM (SELECT *, unnest(range(0, least(500, n - j))) AS k FROM cut)),
firsts AS (SELECT win, min((doc_id, i)) AS f FROM b WHERE len(win) = 200 GROUP BY win HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 100)) AS i FROM b JOIN firsts USING (win) WHERE (doc_id, i) > f),
spans AS (SELECT doc_id, count(*) AS n_removed, count(*) FILTER (before IS NULL OR before < i - 1) AS n_spans
          FROM (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM gone) GROUP BY 1),
kept AS (SELECT doc_id, string_agg(left(win, 2), '' ORDER BY i) AS k FROM b ANTI JOIN gone USING (doc_id, i) GROUP BY 1)
SELECT doc_id, len(h) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(k, ''))) AS kept_sha256
FROM d LEFT JOIN spans USING (doc_id) LEFT JOIN kept USING (doc_id)""",
    "op11_threshold_negatives": """
WITH own AS (SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
             FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
               AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (SELECT a.vec_id AS anchor_id, a.label AS anchor_label, b.vec_id AS other_id, b.label AS other_label,
                  CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
           FROM own a JOIN own b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
near AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scores WHERE anchor_label = other_label
         QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, other_id AS negative_id, positive_score, score AS negative_score
FROM near JOIN scores USING (anchor_id)
WHERE anchor_label <> other_label AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id)
QUALIFY row_number() OVER w <= 3""",
    "op13_dawg_repair": rf"""
WITH RECURSIVE
tab AS (SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab),
shown AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                 coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
dealt AS (SELECT conv_id, turn, role, text, xor(list_reduce(list_prepend(4294967295, list_transform(str_split(key, ''), lambda x: CAST(ord(x) AS BIGINT))),
                 lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS fate FROM shown, tab),
alive AS (SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
                 CASE fate WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
                 unnest(CASE WHEN fate = 3 THEN [1, 2] ELSE [1] END) AS copy FROM dealt WHERE fate <> 0),
seen AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) AS seen FROM alive),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, seen) AS i, left(role, 1) AS ini,
                  CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN seen > 1 THEN 'duplicate'
                       WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' END AS fault FROM seen),
rows AS (SELECT *, coalesce(fault IN ('blank', 'duplicate'), false) AS gone, CASE WHEN fault = 'truncated' THEN 1 ELSE 0 END AS t,
                lag(role) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM placed),
facts AS (SELECT conv_id, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
                 count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
                 count(*) FILTER (before IS NOT NULL AND left(before, 1) || ini NOT IN ('su', 'ua', 'au')) AS illegal FROM rows GROUP BY 1),
back AS (
  SELECT conv_id, n + 1 AS i, '0000000000' AS v0, '0000000004II' AS v1, '0000000002I' AS v2, '0000000000' AS v3 FROM facts
  UNION ALL
  SELECT conv_id, i, least(w0, {_edit(2, 'I', 'x2')}) AS v0, least(w1, {_edit(2, 'I', 'x2')}) AS v1, x2 AS v2, least(w3, {_edit(2, 'I', 'w2')}) AS v3
  FROM (SELECT *, least(w2, {_edit(2, 'I', 'w3')}) AS x2
        FROM (SELECT back.conv_id, back.i - 1 AS i, {_first(0, [('s', 1), ('u', 2)])} AS w0, {_first(1, [('u', 2)])} AS w1,
                     {_first(2, [('a', 3)])} AS w2, {_first(3, [('u', 2)])} AS w3
              FROM back JOIN rows ON rows.conv_id = back.conv_id AND rows.i = back.i - 1))),
best AS (SELECT conv_id, CAST(left(v0, 10) AS BIGINT) AS cost, substr(v0, 11) AS audit FROM back WHERE i = 1),
edits AS (SELECT conv_id, k, substr(audit, k, 1) AS edit FROM (SELECT *, unnest(range(1, len(audit) + 1)) AS k FROM best)),
used AS (SELECT *, count(*) FILTER (edit <> 'I') OVER w AS i, count(*) FILTER (edit <> 'D') OVER w AS j
         FROM edits WINDOW w AS (PARTITION BY conv_id ORDER BY k)),
met AS (SELECT used.*, rows.role, rows.text, rows.ini FROM used LEFT JOIN rows ON used.conv_id = rows.conv_id AND used.i = rows.i AND edit <> 'I' WHERE edit <> 'D'),
starts AS (SELECT conv_id, max(CASE WHEN j = 1 AND edit = 'K' AND ini = 's' THEN 1 ELSE 0 END) AS s FROM met GROUP BY 1),
lines AS (SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN (j - s) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' ||
                                     CASE WHEN edit = 'I' THEN '' ELSE text END, chr(10) ORDER BY k) AS repaired FROM met JOIN starts USING (conv_id) GROUP BY 1)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(repaired, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) LEFT JOIN facts USING (conv_id) LEFT JOIN best USING (conv_id) LEFT JOIN lines USING (conv_id)""",
}
