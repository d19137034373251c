"""Registered queries of the text-pipeline operators and their DuckDB SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.llm import (
    chat,
    decontam,
    exact_dedup,
    html_extract,
    line_dedup,
    minhash,
    mixing,
    negatives,
    spelling,
    substring_dedup,
    token_output,
    toxicity,
    warc,
)
from cohortlens.llm.common import ship_package

TOKENIZER = "byte_bpe_50k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_dedup(_table(spark, sf_dir, "documents")).drop("node")


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_main_text(_table(spark, sf_dir, "pages"))


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = chat.with_control_example(_table(spark, sf_dir, "conversations"))
    return chat.format_and_read_back(rows, public_tokenizers.path(TOKENIZER))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(_table(spark, sf_dir, "pages"))


def op5_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output.token_round_trip(_table(spark, sf_dir, "documents"),
                                         public_tokenizers.path(TOKENIZER))


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(_table(spark, sf_dir, "documents"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_dedup(_table(spark, sf_dir, "documents"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(_table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(_table(spark, sf_dir, "documents"),
                                 _table(spark, sf_dir, "benchmark"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(_table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings").withColumn("label", F.when(
        F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return negatives.hard_negatives(rows, F.col("id") % 100 == 0)


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.line_dedup(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped",
                        F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {f.__name__: f for f in (
    op1_minhash_near_dedup, op2_html_extraction, op3_chat_formatting, op4_warc, op5_token_output, op6_source_mixing, op7_substring_dedup, op8_exact_dedup,
    op9_toxicity, op10_decontamination, op11_spelling_variants, op12_hard_negatives,
    op13_line_dedup)}

_SAID = "'</s>[INST] ok [/INST]'"
# the template: <|im_start|>role\ntext<|im_end|>\n, with \ doubled and \, inside control strings
_ESCAPED = """regexp_replace(replace({text}, chr(92), chr(92) || chr(92)),
  '(<|\\[)(\\|im_start\\|>|\\|im_end\\|>|\\|endoftext\\|>|s>|/s>|INST\\]|/INST\\]|<SYS>>|</SYS>>)',
  '\\1' || chr(92) || chr(92) || ',\\2', 'g')"""

# base32 of a SHA-1 in hex: four letters for every five hex digits
_BASE32 = "array_to_string(list_transform(range(0, 32), lambda k: substr(" \
          "'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(((('0x' || substr(sha1(html)," \
          " CAST(k // 4 AS INTEGER) * 5 + 1, 5))::BIGINT >> (15 - 5 * (k % 4))) & 31) + 1 AS" \
          " INTEGER), 1)), '')"

ORACLE = {
    "op3_chat_formatting": f"""
        WITH rows AS (
          SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
          FROM conversations
          UNION ALL VALUES (-1, 0, 'user', {_SAID}), (-1, 1, 'assistant', {_SAID}))
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY {{order}}))
                 AS turns_sha256,
               CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT)
                 AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY {{order}})
                 FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
               CAST(sum(24 + length(replace({_ESCAPED.format(text="role")}, chr(10), '\\n'))
                        + length({_ESCAPED.format(text="text")})) AS BIGINT) AS formatted_chars
        FROM rows GROUP BY conv_id""".replace("{order}", "turn NULLS FIRST, role, text"),
    "op4_warc": f"""
        WITH rows AS (SELECT page_id, url, coalesce(html, '') AS html FROM pages),
        firsts AS (SELECT *, min(page_id) OVER (PARTITION BY html) AS first FROM rows)
        SELECT page_id, url, CAST(strlen(html) AS BIGINT) AS payload_bytes,
               {_BASE32} AS payload_digest,
               CASE WHEN first <> page_id OR page_id IS NULL AND first IS NOT NULL
                    THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN first IS DISTINCT FROM page_id THEN first END AS refers_to
        FROM firsts""",
    "op7_substring_dedup": """
        WITH words AS (
          SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''),
                   '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w FROM documents),
        windows AS (
          SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h
          FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM words)),
        early AS (SELECT h, min(doc_id) AS first FROM windows GROUP BY h
                  HAVING min(doc_id) < max(doc_id)),
        gone AS (SELECT doc_id, list(DISTINCT p) AS places
                 FROM (SELECT doc_id, unnest(range(i, i + 50)) AS p
                       FROM windows JOIN early USING (h) WHERE first < doc_id)
                 GROUP BY doc_id)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
               CAST(coalesce(len(places), 0) AS BIGINT) AS n_removed,
               sha256(CASE WHEN places IS NULL THEN array_to_string(w, ' ')
                      ELSE array_to_string(list_transform(list_filter(range(1, len(w) + 1),
                        lambda k: NOT list_contains(places, k)), lambda k: w[k]), ' ') END)
                 AS kept_sha256
        FROM words LEFT JOIN gone USING (doc_id)""",
    "op8_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
    # the crc32 is taken byte by byte from its table, itself made by the eight shifts
    "op11_spelling_variants": """
        WITH RECURSIVE crc_table AS (
          SELECT list(v ORDER BY i) AS t
          FROM (SELECT i, list_reduce([CAST(i AS BIGINT)] || range(8), lambda c, k:
                  CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
                FROM range(256) AS r(i))),
        runs AS (
          SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                   'abcdefghijklmnopqrstuvwxyz') AS run
          FROM (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''),
                                                         '[A-Za-zÀ-ÿ]+')) AS run FROM documents)),
        counted AS (SELECT doc_id, run, count(*) AS n FROM runs GROUP BY ALL),
        bytes AS (
          SELECT run, n, flatten(list_transform(string_split(
                   coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''), lambda c:
                   CASE WHEN unicode(c) < 128 THEN [CAST(unicode(c) AS BIGINT)]
                        ELSE [195, CAST(unicode(c) - 64 AS BIGINT)] END)) AS b
          FROM counted),
        summed AS (
          SELECT run, n, xor(4294967295, list_reduce([4294967295] || b, lambda c, x:
                   xor(c >> 8, t[(xor(c, x) & 255) + 1]))) AS h
          FROM bytes, crc_table),
        read AS (
          SELECT n, CASE WHEN h % 31 = 0 THEN left(run, CAST(h % length(run) AS BIGINT))
                             || substr(run, CAST(h % length(run) AS BIGINT) + 2)
                    ELSE run END AS word
          FROM summed),
        words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM read
                  WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
        cut AS (SELECT word, i, left(word, i) || '.' || substr(word, i + 2) AS gap,
                       left(word, i) || substr(word, i + 2) AS shorter
                FROM (SELECT word, unnest(range(0, length(word))) AS i FROM words)),
        near AS (
          SELECT a.word, b.word AS other FROM cut a JOIN cut b USING (gap) WHERE a.word <> b.word
          UNION SELECT c.word, w.word FROM cut c JOIN words w ON c.shorter = w.word
          UNION SELECT w.word, c.word FROM cut c JOIN words w ON c.shorter = w.word),
        best AS (
          SELECT near.word, count(*) AS n_near,
                 first(other ORDER BY o.n DESC, other) AS other, max(o.n) AS other_n
          FROM near JOIN words o ON o.word = near.other GROUP BY near.word),
        forms AS (
          SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
                 CASE WHEN other_n >= 10 * w.n THEN other END AS form,
                 CASE WHEN other_n >= 10 * w.n THEN other_n END AS form_n
          FROM words w LEFT JOIN best USING (word)),
        chain AS (
          SELECT word, word AS root FROM forms
          UNION ALL SELECT c.word, f.form FROM chain c JOIN forms f ON f.word = c.root
          WHERE f.form IS NOT NULL),
        ends AS (SELECT c.word, c.root FROM chain c JOIN forms f ON f.word = c.root
                 WHERE f.form IS NULL)
        SELECT word, n, n_near, form, form_n, root FROM forms JOIN ends USING (word)""",
    "op12_hard_negatives": """
        WITH rows AS (
          SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                 list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS codes
          FROM embeddings
          WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding,
                  lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0),
        scored AS (
          SELECT a.vec_id AS anchor_id, r.vec_id AS id, a.label = r.label AS same,
                 CAST(list_dot_product(a.codes, r.codes) AS BIGINT) AS score
          FROM rows a JOIN rows r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id),
        positives AS (
          SELECT anchor_id, id, score FROM scored WHERE same
          QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
        ranked AS (
          SELECT p.anchor_id, p.id AS positive_id, s.id AS negative_id,
                 p.score AS positive_score, s.score AS negative_score,
                 row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY s.score DESC, s.id)
                   AS rank
          FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
           AND 100 * s.score BETWEEN 30 * p.score AND 90 * p.score)
        SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id,
               positive_score, negative_score
        FROM ranked WHERE rank <= 10""",
    "op13_line_dedup": """
        WITH lines AS (
          SELECT doc_id, i, l[i] AS line,
                 translate(trim(l[i], chr(32) || chr(9) || chr(10) || chr(11) || chr(12)
                                || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                           'abcdefghijklmnopqrstuvwxyz') AS key
          FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i
                FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l
                      FROM documents))),
        frequent AS (SELECT key FROM lines WHERE key <> ''
                     GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
        SELECT doc_id, count(*) AS n_lines, count(f.key) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY i)
                               FILTER (WHERE f.key IS NULL), '')) AS kept_sha256
        FROM lines l LEFT JOIN frequent f ON f.key = l.key GROUP BY doc_id""",
}
