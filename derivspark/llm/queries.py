"""The operators' queries, ``(spark, sf_dir) -> DataFrame``, and their DuckDB SQL."""

from __future__ import annotations

import re
import zlib

import numpy as np
from pyspark.sql import functions as F

from . import (chat_format, conversation_repair, decontaminate, gru_lm, hyperminhash, mixing, ngram_join, periodic_runs,
               quality, sharding, token_count, toxicity, url_filter)
from .common import crc_mod, stage, table

SPACE_SQL = "[\\x20\\x09-\\x0D]+"


def op1_sharding(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return sharding.shard_documents(docs.select("doc_id", "text")).drop("text")


def op2_quality_lines(spark, sf_dir):
    return quality.quality(table(spark, sf_dir, "documents")).drop("clean_text")


def op3_toxicity_ftrl(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    train = toxicity.training_rows(docs, table(spark, sf_dir, "labels"), keep=crc_mod("doc_id", 5) != 0)
    weights = toxicity.fit(train)
    return docs.select("doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"),
                       toxicity.score(docs, weights).alias("score")) \
               .withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op4_latent_decontamination(spark, sf_dir):
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_url_filter(spark, sf_dir):
    return url_filter.filter_urls(table(spark, sf_dir, "pages"))


def op6_gru_lm(spark, sf_dir):
    scored = gru_lm.score(table(spark, sf_dir, "documents"), train_on=crc_mod("doc_id", 7) != 2)
    return scored.withColumn("held_out", F.coalesce(crc_mod("doc_id", 7) == 2, F.lit(False)))


def op7_curriculum_mix(spark, sf_dir):
    plan = mixing.mix_plan(table(spark, sf_dir, "documents"))
    return (plan.withColumn("first_position", F.get("positions", F.lit(0))).drop("positions")
            .withColumnRenamed("source", "mix_source").orderBy("first_position", "doc_id"))


def op8_chat_format(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").cast("long").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                  F.lit(probe).alias("text"))
    return chat_format.conversation_digests(chat_format.format_conversations(rows.unionByName(extra)))


def op9_token_counts(spark, sf_dir):
    return token_count.count_tokens(table(spark, sf_dir, "documents"))


def op10_hyperminhash(spark, sf_dir):
    return hyperminhash.near_duplicates(table(spark, sf_dir, "documents"), k=4)


def op11_ngram_join(spark, sf_dir):
    return ngram_join.ngram_join(table(spark, sf_dir, "documents"), k=3, percent=90)


def _damaged(rows):
    """Conversation rows with a fault planted in five of twenty, chosen by a checksum of conversation
    and turn: dropped, emptied, without full stops, repeated, said by the user. Nulls are one space."""
    def shown(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    d = rows.select("conv_id", "turn", shown("role").alias("role"), shown("text").alias("text"),
                    (F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20).alias("h"))
    d = d.filter("h <> 0")
    text = F.when(F.col("h") == 1, "").when(F.col("h") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("h") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.expr("sequence(1, if(h = 3, 2, 1))"))
    return d.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


def op12_conversation_repair(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations")
    faults = conversation_repair.with_faults(_damaged(rows), originals=rows)
    return conversation_repair.repair_digests(stage(conversation_repair.repaired_rows(faults), "repair-edits"))


def _made_periodic(doc_id, n):
    """Every tenth id's words repeat a stretch of them from some word on (the others: None)."""
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    i = np.arange(n)
    return np.where(i < a, i, a + (i - a) % (1 + (n - a) // (3 + g % 8)))


def op13_periodic_runs(spark, sf_dir):
    found = periodic_runs.periodic_runs(table(spark, sf_dir, "documents"), places=_made_periodic)
    return periodic_runs.run_digests(found)


QUERIES = {f.__name__: f for f in (
    op1_sharding, op2_quality_lines, op3_toxicity_ftrl, op4_latent_decontamination, op5_url_filter, op6_gru_lm, op7_curriculum_mix, op8_chat_format,
    op9_token_counts, op10_hyperminhash, op11_ngram_join, op12_conversation_repair,
    op13_periodic_runs)}

_RULES = ", ".join(f"('{v}', '{h}', '{p}', {i})" for i, (v, h, p) in enumerate(url_filter.RULES))
_BAD = " OR ".join([f"contains(host, '{w}')" for w in ("casino", "porn", "ads-track", "malware")])

# Words and shingles in SQL.
_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _words(text):
    return f"list_filter(regexp_split_to_array({text}, '{SPACE_SQL}'), lambda v: v <> '')"


def _joined(k, percent, last):
    """Documents linked by equal shares of k-word shingles, by an exact join, and ``last`` from them."""
    window = " || ' ' || ".join(f"w[i + {j}]" for j in range(k))
    return f"""
WITH RECURSIVE d AS (SELECT doc_id, {_words(_LOWERED)} AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {k} THEN [array_to_string(w, ' ')]
                          ELSE list_distinct(list_transform(range(1, len(w) - {k - 2}), lambda i: {window})) END AS held FROM d),
n AS (SELECT doc_id, len(held)::BIGINT AS n_shingles FROM s),
x AS (SELECT doc_id, unnest(held) AS g FROM s),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM x a JOIN x b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM pairs JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b
          WHERE 100 * c >= {percent} * (p.n_shingles + q.n_shingles - c)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM n UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
comp AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, n_shingles, component_id, {last} FROM n JOIN comp USING (doc_id)
"""


_CONTROL = "|".join(re.escape(c[0]) + "[\\\\]*" + re.escape(c[1:]) for c in chat_format.CONTROLS)
_FURNITURE = quality.BOILERPLATE.replace("'", "''")
_FURNITURE_LINE = quality.BOILERPLATE_LINE.replace("'", "''")

ORACLE = {
    "op1_sharding": f"""
WITH d AS (SELECT doc_id, text, coalesce(strlen(text), 0)::BIGINT AS n_bytes,
                  ('0x' || substr(md5(doc_id::VARCHAR), 1, 15))::BIGINT AS a FROM documents),
lv AS (SELECT d.*, l AS depth, a >> (60 - l) AS prefix FROM d, (SELECT unnest(range(0, 61)) AS l) r),
s AS (SELECT depth, prefix, sum(n_bytes)::BIGINT AS shard_bytes, count(*) AS shard_rows FROM lv GROUP BY ALL),
leaf AS (SELECT doc_id, min(lv.depth) AS depth FROM lv JOIN s USING (depth, prefix)
         WHERE shard_bytes <= {sharding.MAX_BYTES} OR lv.depth = 60 GROUP BY doc_id)
SELECT lv.doc_id, lv.n_bytes,
       CASE WHEN lv.depth = 0 THEN 'root' ELSE right(lv.prefix::BIT::VARCHAR, lv.depth::INT) END AS shard,
       lv.depth::INT AS shard_depth, s.shard_bytes, s.shard_rows
FROM lv JOIN leaf USING (doc_id, depth) JOIN s USING (depth, prefix)
""",
    "op5_url_filter": f"""
WITH u AS (SELECT page_id, coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), '') AS raw_host,
                  coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages),
h AS (SELECT page_id, translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path FROM u),
r(verdict, rule_host, rule_path, i) AS (VALUES {_RULES}),
m AS (SELECT page_id, first(rule_host || rule_path ORDER BY length(rule_host || rule_path) DESC, i) AS rule,
             first(r.verdict ORDER BY length(rule_host || rule_path) DESC, i) AS rule_verdict
      FROM h JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
      GROUP BY page_id)
SELECT h.page_id, host, path, rule,
       coalesce(rule_verdict, CASE WHEN host = '' OR (({_BAD}) AND starts_with(path, '/'))
           OR contains(host || path, '/wp-login.php') OR ends_with(host || path, '.exe') THEN 'block' ELSE 'allow' END) AS verdict
FROM h LEFT JOIN m USING (page_id)
""",
    "op2_quality_lines": f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, {_words("coalesce(text, '')")} AS w FROM documents),
l AS (SELECT doc_id, x AS line, i, len(regexp_extract_all(x, '[^\\x20\\x09-\\x0D]+')) AS n
      FROM (SELECT doc_id, unnest(a) AS x, unnest(range(len(a))) AS i FROM (SELECT doc_id, string_split(t, chr(10)) AS a FROM d) b) c
      WHERE regexp_matches(x, '[^\\x20\\x09-\\x0D]')),
m AS (SELECT *, len(regexp_extract_all(line, '[|»›•·→]')) AS marks,
             len(regexp_extract_all(line || ' ', '!![\\x20\\x09-\\x0D]')) AS shouts,
             len(regexp_extract_all(line, '[^\\pL\\pM\\pN\\x20\\x09-\\x0D]')) AS symbols,
             len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]')) AS chars FROM l),
r AS (SELECT *, CASE WHEN marks >= 3 AND marks * 5 >= n THEN 'navigation'
                     WHEN n <= {quality.BOILERPLATE_WORDS} AND (contains(line, '©') OR regexp_matches(' ' || lower(line) || ' ', '{_FURNITURE}')
                          OR (n <= {quality.LINE_WORDS} AND regexp_matches(lower(line), '{_FURNITURE_LINE}'))) THEN 'boilerplate'
                     WHEN symbols * 4 > chars OR (shouts >= 3 AND shouts * 2 > n) THEN 'punctuation'
                     WHEN n >= 20 AND NOT regexp_matches(line, '[.!?:;…]') THEN 'punctuation'
                     WHEN n >= 20 AND len(list_distinct({_words("line")})) * 4 < n THEN 'repetition' END AS reason FROM m),
g AS (SELECT doc_id, count(*) AS n_lines, count(reason) AS n_removed_lines, count(*) - count(DISTINCT line) AS n_dup_lines,
             count(*) FILTER (reason = 'navigation') AS n_navigation_lines, count(*) FILTER (reason = 'boilerplate') AS n_boilerplate_lines,
             count(*) FILTER (reason = 'punctuation') AS n_punctuation_lines, count(*) FILTER (reason = 'repetition') AS n_repetition_lines,
             length(string_agg(line, chr(10) ORDER BY i)) AS whole,
             coalesce(length(string_agg(line, chr(10) ORDER BY i) FILTER (reason IS NULL)), 0) AS good FROM r GROUP BY doc_id),
win AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS x
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d) u),
again AS (SELECT doc_id, x FROM win GROUP BY ALL HAVING count(*) > 1),
rep AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM win JOIN again USING (doc_id, x), (SELECT unnest([0, 1, 2]) AS j) k GROUP BY doc_id),
b AS (SELECT d.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
             len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
             coalesce(rep.n, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed_lines, 0) AS n_removed_lines,
             coalesce(n_navigation_lines, 0) AS n_navigation_lines, coalesce(n_boilerplate_lines, 0) AS n_boilerplate_lines,
             coalesce(n_punctuation_lines, 0) AS n_punctuation_lines, coalesce(n_repetition_lines, 0) AS n_repetition_lines,
             coalesce(1 - good::DOUBLE / nullif(whole, 0), 0) AS lost_fraction
      FROM d LEFT JOIN g USING (doc_id) LEFT JOIN rep USING (doc_id))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND lost_fraction <= {quality.MAX_LOST_FRACTION} AS kept
FROM b
""",
    "op8_chat_format": f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -1, i, r, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) v(i, r)),
t AS (SELECT *, len(regexp_extract_all(role, '{_CONTROL}')) + len(regexp_extract_all(text, '{_CONTROL}')) AS controls FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum({len(chat_format.START) + len(chat_format.END) + 2} + length(role) + length(text) + controls)::BIGINT AS formatted_chars,
       count(*) FILTER (controls > 0) AS escaped_turns
FROM t GROUP BY conv_id
""",
    "op10_hyperminhash": _joined(4, 80, "doc_id = component_id AS kept"),
    "op11_ngram_join": _joined(3, 90, "(SELECT count(*) FROM links WHERE a = doc_id) AS n_links"),
}
