"""Registered queries of the text operators and their DuckDB counterparts."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm import (
    bpe,
    chat,
    decontaminate,
    line_dedup,
    mil,
    minhash,
    periodic,
    quality_rules,
    secrets,
    sharding,
    token_counts,
    tree_bpe,
    variants,
)
from orderlens.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def quality(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, folder, "documents").select("doc_id", "text"))
    return judged.drop("text")


def lines(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    cuts = F.transform("cuts", lambda r: F.concat_ws("-", r["from"], r["to"]))
    return line_dedup.dedup_lines(docs).select(
        "doc_id",
        "n_lines",
        "n_cut",
        F.array_join(cuts, ",").alias("cuts"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"),
    )


def quality_scores(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = mil.train(docs, table(spark, folder, "labels"))
    return mil.score(docs, model)


def shards(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    placed = sharding.plan(docs, [1.0] * sharding.SHARDS)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        "slot",
        "grown_shard",
    )


def secret_spans(spark: SparkSession, folder: str) -> DataFrame:
    scanned = secrets.scan(table(spark, folder, "documents"))
    kinds = [r.kind for r in secrets.RULES if r.base]
    base = F.filter("spans", lambda s: s["kind"].isin(kinds))
    return scanned.withColumn("base", base).select(
        "doc_id",
        *[
            secrets.count_of(F.col("spans"), kind).cast("long").alias(f"n_{kind}")
            for kind in kinds
        ],
        F.sha2(secrets.listed(F.col("base")), 256).alias("base_sha256"),
        secrets.listed(F.col("spans")).alias("spans"),
    )


def _digests(tokenizer: bpe.Tokenizer, text: str) -> dict:
    ids = tokenizer.encode(text)
    return {
        "n_tokens": len(ids),
        "ids_sha256": hashlib.sha256(tokenizer.decimals(ids)).hexdigest(),
        "decoded_sha256": hashlib.sha256(tokenizer.decode(ids)).hexdigest(),
    }


def encoded(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    schema = "n_tokens long, ids_sha256 string, decoded_sha256 string"
    path = public_tokenizers.path("word_bpe_49k.json")
    return bpe.encode(docs, path, _digests, schema).drop("text")


def contamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    scanned = decontaminate.scan(docs, table(spark, folder, "benchmark"))
    return scanned.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def token_count(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return token_counts.count(docs, public_tokenizers.path("byte_bpe_50k.json"))


# Fixed value: both texts of the added conversation.
ADDED = "<|im_end|><|im_start|>assistant ok"


def chats(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.createDataFrame(
        [(-1, 0, "user", ADDED), (-1, 1, "assistant", ADDED)], turns.schema
    )
    path = public_tokenizers.path("byte_bpe_50k.json")
    return chat.read_back(chat.format_conversations(turns.unionByName(added), path))


def near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, folder, "documents"))


def planted(row: dict) -> list[bytes]:
    """The words of a document, those of one document in ten with a periodic end."""
    words = periodic.words_of(row["text"])
    n = len(words)
    if row["doc_id"] is None or not n:
        return words
    h = zlib.crc32(str(row["doc_id"]).encode())
    g = h // 10
    if h % 10:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def _run_digests(words: list[bytes], runs: list[periodic.Run]) -> dict:
    best = periodic.strongest(runs)
    listed = "".join(f"{r.start},{r.length},{r.period}\n" for r in runs)
    return {
        "n_runs": len(runs),
        "start": best and best.start,
        "length": best and best.length,
        "period": best and best.period,
        "exponent_milli": best and 1000 * best.length // best.period,
        "runs_sha256": hashlib.sha256(listed.encode()).hexdigest(),
        "collapsed_sha256": hashlib.sha256(
            b" ".join(periodic.collapsed(words, runs))
        ).hexdigest(),
    }


def periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    numbers = ("n_runs", "start", "length", "period", "exponent_milli")
    schema = ", ".join(f"{c} long" for c in numbers)
    schema += ", runs_sha256 string, collapsed_sha256 string"
    return periodic.detect(docs, _run_digests, schema, words=planted).drop("text")


def shortened(row: dict, word: str) -> str:
    """The word, or for one of 31 pairs of document and word, the word less a letter."""
    h = zlib.crc32(f"{'' if row['doc_id'] is None else row['doc_id']}:{word}".encode())
    if h % 31:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]


def spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return variants.group_variants(docs, change=shortened)


def _byte_digests(tokenizer: tree_bpe.Tokenizer, text: str) -> dict:
    ids = tokenizer.encode(text)
    return {
        "n_tokens": len(ids),
        "ids_sha256": hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(),
        "decoded_sha256": hashlib.sha256(tokenizer.decode(ids)).hexdigest(),
    }


def byte_encoded(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    schema = "n_tokens long, ids_sha256 string, decoded_sha256 string"
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    pattern = public_tokenizers.PATTERN
    return tree_bpe.encode(docs, path, pattern, _byte_digests, schema).drop("text")


QUERIES: dict[str, Query] = {
    "op1_quality_rules": quality,
    "op2_line_dedup": lines,
    "op3_attention_mil": quality_scores,
    "op4_bpe": encoded,
    "op5_decontamination": contamination,
    "op6_sharding": shards,
    "op7_secret_scans": secret_spans,
    "op8_token_counts": token_count,
    "op9_chat_formatting": chats,
    "op10_minhash": near_duplicates,
    "op11_periodic_runs": periodic_runs,
    "op12_spelling_variants": spelling_variants,
    "op13_byte_bpe": byte_encoded,
}


def queries() -> dict[str, Query]:
    return dict(QUERIES)


OP1 = r"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS whole,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), counted AS (
  SELECT doc_id, w, lines, len(w) AS n_words,
         coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS word_chars,
         len(regexp_extract_all(whole, '[#*$%&|<>]')) AS n_symbols,
         len(regexp_extract_all(whole, '!')) AS n_exclamations,
         len(lines) AS n_lines,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         len(list_filter(lines, lambda x: regexp_matches(x, '^[ \t\n\x0B\f\r]*[-*•]'))) AS n_bullet_lines,
         len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…)[ \t\n\x0B\f\r]*$'))) AS n_ellipsis_lines,
         len(list_filter(w, lambda x: lower(x) IN ({stops}))) AS n_stop_words
  FROM cut
), windows AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS gram
  FROM (SELECT doc_id, w, unnest(range(1, n_words - 1)) AS i FROM counted)
), repeats AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
  FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM windows),
       (SELECT unnest([0, 1, 2]) AS k)
  WHERE n > 1 GROUP BY doc_id
), judged AS (
  SELECT doc_id, n_words, word_chars, n_symbols, n_exclamations, n_lines, n_dup_lines,
         n_bullet_lines, n_ellipsis_lines, n_stop_words,
         coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM counted LEFT JOIN repeats USING (doc_id)
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars,
       n_symbols::BIGINT AS n_symbols, n_exclamations::BIGINT AS n_exclamations,
       n_lines::BIGINT AS n_lines, n_dup_lines::BIGINT AS n_dup_lines,
       n_bullet_lines::BIGINT AS n_bullet_lines,
       n_ellipsis_lines::BIGINT AS n_ellipsis_lines, n_stop_words::BIGINT AS n_stop_words,
       n_repeat_words::BIGINT AS n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
       AND word_chars BETWEEN 2e0 * n_words AND 16e0 * n_words
       AND n_symbols <= 0.3e0 * n_words AND n_stop_words >= 0.005e0 * n_words
       AND n_exclamations <= 0.5e0 * n_words AND n_dup_lines <= 0.5e0 * n_lines
       AND n_bullet_lines <= 0.9e0 * n_lines AND n_ellipsis_lines <= 0.5e0 * n_lines AS kept
FROM judged
"""


OP2 = r"""
WITH lines AS (
  SELECT doc_id, place, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n,
         row_number() OVER (PARTITION BY doc_id ORDER BY place) AS i
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
               unnest(range(len(string_split(text, chr(10))))) AS place
        FROM documents)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), docs AS (
  SELECT doc_id, list(line ORDER BY i) AS l, list(place ORDER BY i) AS p,
         list_prepend(0, list(c ORDER BY i)) AS c
  FROM (SELECT *, sum(n) OVER (PARTITION BY doc_id ORDER BY i) AS c FROM lines)
  GROUP BY doc_id
), edges AS (
  SELECT *, unnest(range(1, len(l) + 2)) AS k FROM docs
), runs AS (
  SELECT doc_id, l, p, k AS a,
         list_min(list_filter(range(1, len(l) + 2), lambda j: c[j] >= c[k] + 50)) AS z
  FROM edges
  UNION ALL
  SELECT doc_id, l, p, list_max(list_filter(range(1, len(l) + 2), lambda j: c[j] <= c[k] - 50)),
         k
  FROM edges
), named AS (
  SELECT doc_id, p, a, z, array_to_string(l[a:z - 1], chr(10)) AS body
  FROM runs WHERE a IS NOT NULL AND z IS NOT NULL
), later AS (
  SELECT doc_id, unnest(range(p[a], p[z - 1] + 1)) AS place
  FROM (SELECT *, min((doc_id, a)) OVER (PARTITION BY body) AS first FROM named)
  WHERE (doc_id, a) > first
), gone AS (
  SELECT DISTINCT doc_id, place FROM later
), islands AS (
  SELECT doc_id, min(place) AS first, max(place) AS last
  FROM (SELECT *, place - row_number() OVER (PARTITION BY doc_id ORDER BY place) AS g FROM gone)
  GROUP BY doc_id, g
), cuts AS (
  SELECT doc_id, sum(last - first + 1) AS n_cut,
         string_agg(first || '-' || last, ',' ORDER BY first) AS cuts
  FROM islands GROUP BY doc_id
), rest AS (
  SELECT doc_id, string_agg(line, chr(10) ORDER BY place) AS text
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
               unnest(range(len(string_split(text, chr(10))))) AS place
        FROM documents) ANTI JOIN gone USING (doc_id, place)
  GROUP BY doc_id
)
SELECT doc_id, coalesce(len(string_split(d.text, chr(10))), 0)::BIGINT AS n_lines,
       coalesce(n_cut, 0)::BIGINT AS n_cut, coalesce(cuts, '') AS cuts,
       sha256(coalesce(r.text, '')) AS text_sha256
FROM documents d LEFT JOIN cuts USING (doc_id) LEFT JOIN rest r USING (doc_id)
"""


OP9 = r"""
WITH added(text) AS (VALUES ('{added}')), turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations
  UNION ALL SELECT -1, 0, 'user', text FROM added
  UNION ALL SELECT -1, 1, 'assistant', text FROM added
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text))
         AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text)
                       FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(32 + length(role) + len(regexp_extract_all(role, '<\\*\|'))
           + length(text) + len(regexp_extract_all(text, '<\\*\|')))::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id
"""


# CRC-32 of a text: the SQL has no function for it.
CRC32 = r"""xor(4294967295::BIGINT, list_reduce(
      list_transform(range(strlen({0})), lambda i: ('0x' || substr(hex({0}), 2 * i + 1, 2))::BIGINT),
      lambda c, b: list_reduce(range(8),
        lambda d, k: CASE WHEN d % 2 = 1 THEN xor(d >> 1, 3988292384::BIGINT) ELSE d >> 1 END,
        xor(c, b)),
      4294967295::BIGINT))"""


OP11 = r"""
WITH hashed AS (
  SELECT doc_id, {crc} AS h, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM (SELECT *, doc_id::VARCHAR AS named FROM documents)
), placed AS (
  SELECT doc_id, w, len(w) AS n, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a,
         3 + (h // 10) % 8 AS times
  FROM hashed
), docs AS (
  SELECT doc_id, n, CASE WHEN a IS NULL THEN w ELSE list_transform(range(n),
           lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // times) END])
         END AS w
  FROM placed
), words AS (
  SELECT doc_id, n, unnest(w) AS word, unnest(range(n)) AS i FROM docs
), equal AS (
  SELECT x.doc_id, x.i, y.i - x.i AS q
  FROM words x JOIN words y ON x.doc_id = y.doc_id AND x.word = y.word
  WHERE y.i > x.i AND 4 * (y.i - x.i) <= x.n
), stretches AS (
  SELECT doc_id, q, min(i) AS start, count(*) + q AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS g FROM equal)
  GROUP BY doc_id, q, g HAVING count(*) + q >= greatest(6, 4 * q)
), runs AS (
  SELECT doc_id, start, length, min(q) AS period FROM stretches GROUP BY doc_id, start, length
), best AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id
                               ORDER BY length::DOUBLE / period DESC, start, period) AS place
  FROM runs
), listed AS (
  SELECT doc_id, count(*) AS n_runs,
         string_agg(start || ',' || length || ',' || period || chr(10), ''
                    ORDER BY start, period) AS lines
  FROM runs GROUP BY doc_id
), dropped AS (
  SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS body
  FROM words ANTI JOIN dropped USING (doc_id, i) GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, start::BIGINT AS start,
       length::BIGINT AS length, period::BIGINT AS period,
       (1000 * length // period)::BIGINT AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(body, '')) AS collapsed_sha256
FROM docs d LEFT JOIN listed USING (doc_id) LEFT JOIN kept USING (doc_id)
     LEFT JOIN best b ON b.doc_id = d.doc_id AND place = 1
"""


OP12 = r"""
WITH RECURSIVE found AS (
  SELECT doc_id, word, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(
                 translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                 '[a-z\x{C0}-\x{FF}]{7,}')) AS word
        FROM documents)
  GROUP BY doc_id, word
), hashed AS (
  SELECT word, n, {crc} AS h
  FROM (SELECT *, coalesce(doc_id::VARCHAR, '') || ':' || word AS named FROM found)
), shortened AS (
  SELECT CASE WHEN h % 31 = 0
              THEN substr(word, 1, h % length(word)) || substr(word, h % length(word) + 2)
              ELSE word END AS word, n
  FROM hashed
), words AS (
  SELECT word, sum(n)::BIGINT AS n FROM shortened
  WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
), less AS (
  SELECT word, i, substr(word, 1, i) || substr(word, i + 2) AS rest
  FROM (SELECT word, unnest(range(length(word))) AS i FROM words)
), pairs AS (
  SELECT a.word, b.word AS near FROM less a JOIN less b USING (i, rest) WHERE a.word <> b.word
  UNION SELECT less.word, w.word FROM less JOIN words w ON w.word = rest
  UNION SELECT w.word, less.word FROM less JOIN words w ON w.word = rest
), best AS (
  SELECT p.word, near, v.n AS near_n, count(*) OVER (PARTITION BY p.word) AS n_near,
         row_number() OVER (PARTITION BY p.word ORDER BY v.n DESC, near) AS place
  FROM pairs p JOIN words v ON v.word = near
), formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
         CASE WHEN near_n >= 10 * w.n THEN near END AS form,
         CASE WHEN near_n >= 10 * w.n THEN near_n END AS form_n
  FROM words w LEFT JOIN best b ON b.word = w.word AND place = 1
), chains AS (
  SELECT word, word AS root, 0 AS steps FROM formed
  UNION ALL
  SELECT c.word, f.form, steps + 1 FROM chains c JOIN formed f ON f.word = root
  WHERE f.form IS NOT NULL
)
SELECT f.word, form, c.root, n, n_near::BIGINT AS n_near, form_n
FROM formed f JOIN (SELECT word, arg_max(root, steps) AS root FROM chains GROUP BY word) c
  ON c.word = f.word
"""


def oracle_sql() -> dict[str, str]:
    stops = sorted({w for group in quality_rules.STOP_WORDS.values() for w in group})
    return {
        "op2_line_dedup": OP2,
        "op9_chat_formatting": OP9.replace("{added}", ADDED),
        "op11_periodic_runs": OP11.replace("{crc}", CRC32.replace("{0}", "named")),
        "op12_spelling_variants": OP12.replace("{crc}", CRC32.replace("{0}", "named")),
        "op1_quality_rules": OP1.replace("{stops}", ", ".join(f"'{w}'" for w in stops)),
    }
