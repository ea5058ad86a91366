"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from genoframe.llm import (
    attention,
    conversations,
    exact,
    fim,
    html,
    jaccard,
    langid,
    mixing,
    packing,
    quality,
    tokens,
    toxicity,
    urls,
)

Query = Callable[[SparkSession, str], DataFrame]


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/pages.parquet")


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken = mixing.assign_copies(_documents(spark, sf_dir))
    return taken.select(
        "doc_id", "size", "source_size", "target",
        (F.col("size") * F.col("copies")).alias("taken"),
    )


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(_documents(spark, sf_dir)).drop("rejected_by")


def op3_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract_text(_pages(spark, sf_dir))


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(_documents(spark, sf_dir), words=3, percent=90)


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(_documents(spark, sf_dir), tokens.vocabulary(), limit=2048)


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.filter_urls(_pages(spark, sf_dir))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(_documents(spark, sf_dir), _labels(spark, sf_dir))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_documents(spark, sf_dir), tokens.vocabulary())


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predict_language(_documents(spark, sf_dir))


def op11_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attention.score_quality(_documents(spark, sf_dir), _labels(spark, sf_dir))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.fill_in_middle(_documents(spark, sf_dir), digests=True)


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return conversations.repair_digests(conversations.damaged(turns))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_duplicates(_documents(spark, sf_dir))


QUERIES: tuple[Query, ...] = (
    op1_mixing, op2_quality, op3_html, op4_ngram_jaccard, op5_token_counts, op6_url_filters,
    op7_toxicity, op8_packing, op9_exact_dedup, op10_language_id,
    op11_quality_classifier, op12_fill_in_middle, op13_conversation_repair, pipeline,
)


def queries() -> dict[str, Query]:
    return {query.__name__: query for query in QUERIES}


OP1_SQL = r"""
WITH sized AS (
  SELECT doc_id, source,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents
),
sums AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CAST([1, 2, 3][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS DOUBLE)
           AS weight
  FROM sized GROUP BY source
),
caps AS (
  SELECT *, source_size * CAST(3 AS DOUBLE) AS cap,
         CAST(sum(source_size) OVER () AS DOUBLE) AS total, sum(weight) OVER () AS weights
  FROM sums
),
levels AS (
  SELECT *, (total - coalesce(sum(cap) OVER before, 0)) / (weights - coalesce(sum(weight) OVER before, 0))
           AS level_here,
         row_number() OVER (ORDER BY cap / weight, source NULLS LAST) AS rank
  FROM caps
  WINDOW before AS (ORDER BY cap / weight, source NULLS LAST
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
fitting AS (SELECT min(rank) AS first_fit FROM levels WHERE level_here * weight <= cap),
targets AS (
  SELECT source, source_size,
         CASE WHEN first_fit IS NULL OR rank < first_fit THEN cap
              ELSE least(cap, (SELECT level_here FROM levels, fitting WHERE rank = first_fit) * weight)
         END AS target
  FROM levels, fitting
),
rated AS (
  SELECT doc_id, size, source_size, target,
         least(CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END, 3) AS rate,
         CAST('0x' || substr(md5('20240229:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT)
           / CAST(4503599627370496 AS DOUBLE) AS draw
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source
)
SELECT doc_id, size, source_size, target,
       CAST(size * (floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT)
         AS taken
FROM rated
"""

OP2_SQL = r"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
),
read AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
         [x FOR x IN string_split(text, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines
  FROM texts
),
windows AS (
  SELECT r, i, words[i:i + 4] AS gram
  FROM (SELECT r, words, unnest(range(1, len(words) - 3)) AS i FROM read)
),
places AS (
  SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, gram) > 1
),
repeats AS (
  SELECT r, count(DISTINCT i + k) AS n
  FROM places, (SELECT unnest(range(0, 5)) AS k) GROUP BY r
),
measured AS (
  SELECT doc_id, text, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(text) - len(regexp_extract_all(text, '[\x20\x09-\x0D]')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         len(lines) AS n_lines,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
  FROM read LEFT JOIN repeats USING (r)
),
judged AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM measured
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > 3 * n_words OR 100 * n_dup_lines > 30 * n_lines
            OR word_chars < 2 * n_words OR word_chars > 25 * n_words
            OR 2 * len(regexp_extract_all(text, '\p{Lu}')) > len(regexp_extract_all(text, '\p{L}'))
            OR 10 * len(regexp_extract_all(text, '!!')) > 3 * n_words
            OR NOT regexp_matches(text, '\p{L}')) AS kept
FROM judged
"""

OP9_SQL = r"""
WITH texts AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm
  FROM documents
)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY norm ORDER BY doc_id) = 1 AS kept,
       sha256(norm) AS text_sha256
FROM texts WINDOW same AS (PARTITION BY norm)
"""


OP6_SQL = r"""
WITH parts AS (
  SELECT page_id,
         CASE WHEN url LIKE '%://%' THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages
),
split AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM parts
),
rules AS (
  SELECT * FROM (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'),
    ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block'))
    AS r(rule_host, rule_path, rule_verdict)
),
fitting AS (
  SELECT split.*, rule_host || rule_path AS rule, rule_verdict,
         row_number() OVER (PARTITION BY page_id, host, path
                            ORDER BY length(rule_host || rule_path) DESC NULLS LAST) AS place
  FROM split LEFT JOIN rules
    ON (host = rule_host OR host LIKE '%.' || rule_host) AND starts_with(path, rule_path)
)
SELECT page_id, host, path, rule,
       coalesce(rule_verdict,
         CASE WHEN host = '' OR regexp_matches('.' || translate(host, '-_:', '...') || '.',
                '\.(casinos?|cheap|cialis|escorts?|jackpot|levitra|malware|phishing|pills|poker|porno?|roulette|spam|spammers?|viagra|xanax|xxx)\.')
              THEN 'block' ELSE 'allow' END) AS verdict
FROM fitting WHERE place = 1
"""

OP4_SQL = r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x20\x09-\x0D]+') AS words
  FROM documents
),
sets AS (
  SELECT doc_id,
         CASE WHEN len(words) >= 3
              THEN list_distinct([array_to_string(words[i:i + 2], ' ')
                                  FOR i IN range(1, len(words) - 1)])
              WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END AS grams
  FROM texts
),
incidence AS (SELECT doc_id, len(grams) AS n, unnest(grams) AS gram FROM sets),
pairs AS (
  SELECT a.doc_id AS u, b.doc_id AS v, a.n AS nu, b.n AS nv, count(*) AS shared
  FROM incidence a JOIN incidence b
    ON a.gram = b.gram AND a.doc_id < b.doc_id
   AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
  GROUP BY ALL
),
links AS (
  SELECT u, v FROM pairs WHERE 100 * shared >= 90 * (nu + nv - shared)
),
sides AS (SELECT u, v FROM links UNION SELECT v, u FROM links),
reach(u, v) AS (
  SELECT u, v FROM sides
  UNION SELECT reach.u, sides.v FROM reach JOIN sides ON reach.v = sides.u
)
SELECT sets.doc_id, CAST(len(grams) AS BIGINT) AS n_shingles,
       least(sets.doc_id, coalesce(min(reach.v), sets.doc_id)) AS component_id
FROM sets LEFT JOIN reach ON sets.doc_id = reach.u
GROUP BY sets.doc_id, grams
"""


OP12_SQL = r"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''),
           '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units,
         sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS draw
  FROM documents
),
drawn AS (
  SELECT *, len(units) AS n, CAST('0x' || draw[1:8] AS BIGINT) AS h1,
         CAST('0x' || draw[9:16] AS BIGINT) AS h2, CAST('0x' || draw[17:24] AS BIGINT) AS h3,
         CAST('0x' || draw[25:32] AS BIGINT) AS h4
  FROM texts
),
cuts AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS low, greatest(h1 % (n + 1), h2 % (n + 1)) AS high,
         CASE WHEN text = '' OR h3 % 100 >= 50 OR regexp_matches(text, '<[PSM]>') THEN 'plain'
              WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn
),
parts AS (
  SELECT *, array_to_string(units[1:low], '') AS prefix,
         array_to_string(units[low + 1:high], '') AS middle,
         array_to_string(units[high + 1:], '') AS suffix
  FROM cuts
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
              WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""


OP13_SQL = r"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], [0, 0, 0, 0, 0, 0, 0, 0]),
           lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS codes
),
keyed AS (
  SELECT dense_rank() OVER (ORDER BY conv_id) AS c, conv_id, turn, coalesce(role, ' ') AS role,
         coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key
  FROM conversations
),
parts AS (
  SELECT keyed.*, xor(4294967295, list_reduce(
           list_concat([4294967295], list_transform(string_split(key, ''), lambda k: ascii(k))),
           lambda x, y: xor(x >> 8, codes[1 + (xor(x, y) & 255)]))) % 20 AS part
  FROM keyed, crc
),
hurt AS (
  SELECT c, turn, CASE part WHEN 4 THEN 'user' ELSE role END AS role,
         CASE part WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE part WHEN 0 THEN [] WHEN 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM parts
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i,
         role[1:1] AS initial,
         NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
         NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS unended
  FROM hurt
),
repeats AS (
  SELECT *, NOT blank AND row_number() OVER (PARTITION BY c, role, text ORDER BY i) > 1 AS duplicate,
         lag(initial) OVER (PARTITION BY c ORDER BY i) AS before
  FROM placed
),
rows AS (
  SELECT *, NOT blank AND NOT duplicate AND unended AS truncated, blank OR duplicate AS forced,
         i > 1 AND before || initial NOT IN ('su', 'ua', 'au') AS illegal
  FROM repeats
),
totals AS (
  SELECT c, max(i) AS n, count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate,
         count(*) FILTER (truncated) AS truncated, count(*) FILTER (illegal) AS illegal,
         coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps
  FROM rows GROUP BY c
),
back(c, i, b0, b1, b2, b3) AS (
  SELECT c, n + 1, 0, 10, 5, 0 FROM totals
  UNION ALL
  SELECT c, i, least(e0, 5 + e2, 10 + e3), least(e1, 5 + e2, 10 + e3), least(e2, 5 + e3), least(e3, 5 + e2)
  FROM (
    SELECT r.c, r.i,
           least(2 + b0, CASE WHEN forced THEN 999 ELSE least(1 + b2, CASE initial WHEN 's' THEN b1 WHEN 'u' THEN b2 ELSE 999 END) + CASE WHEN truncated THEN 5 ELSE 0 END END) AS e0,
           least(2 + b1, CASE WHEN forced THEN 999 ELSE least(1 + b2, CASE initial WHEN 'u' THEN b2 ELSE 999 END) + CASE WHEN truncated THEN 5 ELSE 0 END END) AS e1,
           least(2 + b2, CASE WHEN forced THEN 999 ELSE least(1 + b3, CASE initial WHEN 'a' THEN b3 ELSE 999 END) + CASE WHEN truncated THEN 5 ELSE 0 END END) AS e2,
           least(2 + b3, CASE WHEN forced THEN 999 ELSE least(1 + b2, CASE initial WHEN 'u' THEN b2 ELSE 999 END) + CASE WHEN truncated THEN 5 ELSE 0 END END) AS e3
    FROM back JOIN rows r ON r.c = back.c AND r.i = back.i - 1
  )
),
places AS (
  SELECT b.c, b.i, [b.b0, b.b1, b.b2, b.b3] AS here, [a.b0, a.b1, a.b2, a.b3] AS after, r.* EXCLUDE (c, i)
  FROM back b LEFT JOIN back a ON a.c = b.c AND a.i = b.i + 1 LEFT JOIN rows r ON r.c = b.c AND r.i = b.i
),
walk(c, i, s, audit, lines) AS (
  SELECT c, CAST(1 AS BIGINT), 0, '', CAST([] AS VARCHAR[]) FROM totals
  UNION ALL
  SELECT c, CASE op WHEN 'I' THEN i ELSE i + 1 END,
         CASE op WHEN 'D' THEN s WHEN 'K' THEN kept_to ELSE turn_to END, audit || op,
         CASE op WHEN 'D' THEN lines WHEN 'K' THEN lines || [role || ':' || text]
           WHEN 'R' THEN lines || [turn_name || ':' || text] ELSE lines || [turn_name || ':'] END
  FROM (
    SELECT *, CASE WHEN after IS NULL THEN 'I'
                WHEN here[s + 1] = 2 + after[s + 1] THEN 'D'
                WHEN here[s + 1] = 5 + here[turn_to + 1] THEN 'I'
                WHEN here[s + 1] = CASE WHEN truncated THEN 5 ELSE 0 END + after[kept_to + 1] THEN 'K'
                ELSE 'R' END AS op
    FROM (
      SELECT walk.*, p.* EXCLUDE (c, i), CASE s WHEN 2 THEN 3 ELSE 2 END AS turn_to,
             CASE s WHEN 2 THEN 'assistant' ELSE 'user' END AS turn_name,
             CASE WHEN s = 0 AND initial = 's' THEN 1 WHEN s <> 2 AND initial = 'u' THEN 2
                  WHEN s = 2 AND initial = 'a' THEN 3 END AS kept_to
      FROM walk JOIN places p USING (c, i)
      WHERE after IS NOT NULL OR s IN (1, 2)
    )
  )
),
ends AS (
  SELECT walk.c, audit, array_to_string(lines, chr(10)) AS text
  FROM walk JOIN totals ON walk.c = totals.c AND walk.i = n + 1 WHERE s IN (0, 3)
),
costs AS (SELECT back.c, CAST(b0 AS BIGINT) AS cost FROM back WHERE i = 1)
SELECT conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank,
       coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit,
       sha256(coalesce(text, '')) AS repaired_sha256
FROM (SELECT DISTINCT c, conv_id FROM keyed) LEFT JOIN totals USING (c) LEFT JOIN ends USING (c)
     LEFT JOIN costs USING (c)
"""


def oracle_sql() -> dict[str, str]:
    found = {
        "op1_mixing": OP1_SQL,
        "op2_quality": OP2_SQL,
        "op4_ngram_jaccard": OP4_SQL,
        "op6_url_filters": OP6_SQL,
        "op9_exact_dedup": OP9_SQL,
        "op12_fill_in_middle": OP12_SQL,
        "op13_conversation_repair": OP13_SQL,
    }
    if corpus_pipeline.ORACLE_SQL:
        found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found
