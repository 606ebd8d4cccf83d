"""Registered queries of the operators, one per operator, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.llm import (chat, decontam, html, huffman, linededup, neardup, packing, phrases, quality, secrets,
                          sharding, toxicity, whitening)
from kerbside.llm.common import table

QUERIES: dict = {}
ORACLE: dict = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn
    return register


@query("op1_sharding")
def op1(spark: SparkSession, base: str) -> DataFrame:
    d = table(spark, base, "documents")
    return sharding.shards(d, ["doc_id"], F.coalesce(F.octet_length("text"), F.lit(0)))


@query("op2_near_duplicates")
def op2(spark: SparkSession, base: str) -> DataFrame:
    return neardup.classes(table(spark, base, "documents")).select("doc_id", "class_id", "class_size")


@query("op3_decontamination", r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, array_to_string(w[s:s + 9], ' ') AS g, least(len(w), 10) AS n
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
grams AS (
  SELECT doc_id, s, n, array_to_string(w[s:s + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, sizes WHERE len(w) >= n)),
occ AS (SELECT DISTINCT doc_id, s, win.n, item_id FROM grams JOIN win ON grams.g = win.g AND grams.n = win.n),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM occ) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM occ) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
""")
def op3(spark: SparkSession, base: str) -> DataFrame:
    r = decontam.decontaminate(table(spark, base, "documents"), table(spark, base, "benchmark"))
    return r.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@query("op4_secret_scan")
def op4(spark: SparkSession, base: str) -> DataFrame:
    return secrets.scan(table(spark, base, "documents"))


@query("op5_packing")
def op5(spark: SparkSession, base: str) -> DataFrame:
    return packing.pack(table(spark, base, "documents")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query("op6_line_dedup", r"""
WITH l AS (
  SELECT doc_id, coalesce(source, '') AS site, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents),
t AS (SELECT *, trim(line, ' ' || chr(9) || chr(13)) AS s FROM l),
boiler AS (SELECT s, min(doc_id) AS keeper FROM t WHERE s <> '' GROUP BY s HAVING count(DISTINCT site) >= 10),
marked AS (SELECT t.doc_id, t.pos, t.line, boiler.s IS NOT NULL AND t.doc_id <> boiler.keeper AS gone
           FROM t LEFT JOIN boiler ON t.s = boiler.s)
SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS text,
       count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed
FROM marked GROUP BY doc_id
UNION ALL
SELECT doc_id, NULL, 0, 0 FROM documents WHERE text IS NULL
""")
def op6(spark: SparkSession, base: str) -> DataFrame:
    return linededup.dedup_lines(table(spark, base, "documents")).select("doc_id", "text", "n_lines", "n_removed")


@query("op7_token_files")
def op7(spark: SparkSession, base: str) -> DataFrame:
    return huffman.round_trip(table(spark, base, "documents"))


@query("op8_quality_rules", r"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
tri AS (
  SELECT doc_id, s, w[s] || ' ' || w[s + 1] || ' ' || w[s + 2] AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS s FROM w WHERE len(w) >= 3)),
rep AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words
        FROM (SELECT doc_id, unnest([s, s + 1, s + 2]) AS p
              FROM (SELECT doc_id, s, count(*) OVER (PARTITION BY doc_id, g) AS c FROM tri) WHERE c > 1) GROUP BY doc_id),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM w),
dup AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines,
               count(*) FILTER (WHERE regexp_matches(line, '^[\x20\x09-\x0D]*[-*\x{2022}]')) AS n_bullet,
               count(*) FILTER (WHERE regexp_matches(line, '(\.\.\.|\x{2026})[\x20\x09-\x0D]*$')) AS n_cut
        FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
m AS (
  SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
         coalesce(n_lines, 0) AS n_lines,
         length(regexp_replace(text, '[^A-Za-z\x{80}-\x{10FFFF}]', '', 'g')) AS n_letters,
         coalesce(n_bullet, 0) AS n_bullet, coalesce(n_cut, 0) AS n_cut
  FROM w LEFT JOIN rep USING (doc_id) LEFT JOIN dup USING (doc_id)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 4 * n_symbols > n_words OR (n_dup_lines >= 3 AND 10 * n_dup_lines > 3 * n_lines)
            OR (n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 25 * n_words))
            OR (n_words > 0 AND 2 * n_letters < word_chars)) AS kept,
       CAST((n_words < 50)::INT + 2 * (100 * n_repeat_words > 50 * n_words)::INT + 4 * (4 * n_symbols > n_words)::INT
            + 8 * (n_dup_lines >= 3 AND 10 * n_dup_lines > 3 * n_lines)::INT
            + 16 * (n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 25 * n_words))::INT
            + 32 * (n_words > 0 AND 2 * n_letters < word_chars)::INT + 64 * (n_words > 0 AND 10 * n_bullet > 9 * n_lines)::INT
            + 128 * (n_words > 0 AND 10 * n_cut > 3 * n_lines)::INT AS INT) AS failed
FROM f
""")
def op8(spark: SparkSession, base: str) -> DataFrame:
    led = quality.ledger(table(spark, base, "documents"))
    return led.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      (~quality.kept("base")).alias("base_failed"), quality.kept().alias("kept"), "failed")


@query("op9_chat", r"""
WITH t AS (SELECT conv_id, turn, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS i
           FROM conversations),
c AS (SELECT conv_id, list({'r': role, 't': text} ORDER BY i) AS x FROM t GROUP BY conv_id),
u AS (SELECT min(conv_id) AS conv_id, x, count(*) AS n_copies FROM c GROUP BY x),
p AS (SELECT DISTINCT x[1:k] AS x FROM (SELECT x, unnest(range(1, len(x))) AS k FROM u)),
m AS (SELECT u.* FROM u ANTI JOIN p ON u.x = p.x)
SELECT conv_id, CAST(len(x) AS BIGINT) AS n_turns, n_copies,
       array_to_string(list_transform(x, lambda e: '<|im_start|>' || replace(coalesce(e.r, 'unknown'), '<|', '< |') || chr(10)
                                      || replace(coalesce(e.t, ''), '<|', '< |') || '<|im_end|>'), chr(10)) AS rendered
FROM m
""")
def op9(spark: SparkSession, base: str) -> DataFrame:
    return chat.rendered(table(spark, base, "conversations"))


@query("op10_html_text")
def op10(spark: SparkSession, base: str) -> DataFrame:
    return html.extract(table(spark, base, "pages"))


@query("op11_toxicity")
def op11(spark: SparkSession, base: str) -> DataFrame:
    return toxicity.score(table(spark, base, "documents"), table(spark, base, "labels"))


@query("op12_whitening")
def op12(spark: SparkSession, base: str) -> DataFrame:
    return whitening.whiten(table(spark, base, "embeddings"))


@query("op13_phrases", r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
grams AS (SELECT lang, w[s:s + k - 1] AS g
          FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM w, (SELECT unnest([1, 2, 3, 4]) AS k))),
f AS (SELECT lang, g, count(*) AS f FROM grams GROUP BY lang, g HAVING count(*) >= 30),
c AS (SELECT lang, g, f AS a FROM f WHERE len(g) >= 2),
subs AS (SELECT lang, a, g[i:i + m - 1] AS s
         FROM (SELECT lang, g, a, m, unnest(range(1, len(g) - m + 2)) AS i FROM c, (SELECT unnest([2, 3]) AS m) WHERE len(g) > m)),
cover AS (SELECT lang, s, max(a) AS cover FROM subs GROUP BY lang, s),
kept AS (SELECT c.* FROM c LEFT JOIN cover ON c.lang = cover.lang AND c.g = cover.s
         WHERE cover IS NULL OR 100 * cover < 80 * a),
cuts AS (SELECT lang, g, a, unnest(range(1, len(g))) AS k FROM kept),
x AS (SELECT cuts.*, fl.f AS l, fr.f AS r,
             CAST(2000000::HUGEINT * a // (fl.f + fr.f) AS BIGINT) AS score
      FROM cuts JOIN f fl ON cuts.lang = fl.lang AND cuts.g[1:k] = fl.g
                JOIN f fr ON cuts.lang = fr.lang AND cuts.g[k + 1:] = fr.g),
best AS (SELECT *, array_to_string(g, ' ') AS phrase FROM x
         QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
""")
def op13(spark: SparkSession, base: str) -> DataFrame:
    return phrases.mine(table(spark, base, "documents"))
