"""SQL twins of the operators that SQL can express, for DuckDB over the same tables."""

from __future__ import annotations

LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
TERMS = rf"regexp_extract_all(translate(coalesce(text, ''), {LETTERS}), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

RANKED_SEARCH = f"""
WITH words AS (SELECT doc_id, unnest({TERMS}) AS term FROM documents),
held AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY doc_id, term),
sizes AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM held GROUP BY doc_id),
corpus AS (SELECT count(*) AS documents, sum(n)::BIGINT AS length FROM sizes),
lengths AS (SELECT doc_id, 50 + (50 * n * documents) // length AS m FROM sizes, corpus),
asked AS (SELECT DISTINCT item_id, term FROM (SELECT item_id, unnest({TERMS}) AS term FROM benchmark)),
weights AS (
  SELECT term, floor(1000 * ln((2 * any_value(documents) + 2) / (2 * count(*) + 1)))::BIGINT AS w
  FROM held, corpus WHERE term IN (SELECT term FROM asked) GROUP BY term),
scores AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN held USING (term) JOIN lengths USING (doc_id) GROUP BY item_id, doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
SELECT item_id, rank::INT AS rank, doc_id, score FROM ranked WHERE rank <= 50
"""

FILTER_AUDIT = r"""
WITH words AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
failing AS (
  SELECT doc_id, part,
         (len(words) < 200)::INT + 2 * (100 * len(list_distinct(words)) < 50 * len(words))::INT
         + 4 * (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text))::INT
         + 8 * regexp_matches(text, '[#$%&*|]')::INT
         + 16 * (doc_id > min(doc_id) OVER (PARTITION BY text))::INT AS mask FROM words),
marks AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
counts AS (
  SELECT part, mask, count(*) AS n, count(*) FILTER (WHERE good = 1) AS good, count(*) FILTER (WHERE toxic = 1) AS toxic
  FROM failing LEFT JOIN marks USING (doc_id) GROUP BY part, mask),
letters AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS t(l, b)),
orders AS (
  SELECT v.l || w.l || x.l || y.l || z.l AS filter_order, [v.b, w.b, x.b, y.b, z.b] AS bits
  FROM letters v, letters w, letters x, letters y, letters z WHERE v.b | w.b | x.b | y.b | z.b = 31),
steps AS (
  SELECT filter_order, step, bits[step] AS own, list_sum(bits[1:step])::INT - bits[step] AS before
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
report AS (
  SELECT part, filter_order, step, own,
         sum(CASE WHEN mask & (own | before) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
         sum(CASE WHEN mask & own <> 0 AND mask & before = 0 THEN n ELSE 0 END)::BIGINT AS removed,
         sum(CASE WHEN mask & own <> 0 AND mask & before <> 0 THEN n ELSE 0 END)::BIGINT AS redundant,
         sum(CASE WHEN mask = own THEN n ELSE 0 END)::BIGINT AS unique_fails,
         sum(CASE WHEN mask & own <> 0 AND mask & before = 0 THEN good ELSE 0 END)::BIGINT AS good_lost,
         sum(CASE WHEN mask & own <> 0 AND mask & before = 0 THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM counts, steps GROUP BY part, filter_order, step, own)
SELECT part, filter_order, step::INT AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM report
"""
