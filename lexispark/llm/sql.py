"""SQL twins of the queries that DuckDB can express."""

from __future__ import annotations

# All pairs of equal label, and the components by walking their links: for small tables only.
EMBEDDING_DEDUP = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
), fine AS (
  SELECT vec_id, label, e, sqrt(list_dot_product(e, e)) AS len FROM v
  WHERE label IS NOT NULL AND e IS NOT NULL AND len(e) > 0
    AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_dot_product(e, e) > 0
), link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM fine a JOIN fine b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_dot_product(a.e, b.e) >= 0.93 * a.len * b.len
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM v
  UNION
  SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a
), part AS (
  SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a
), degree AS (
  SELECT a AS vec_id, count(*) AS n FROM link GROUP BY a
)
SELECT v.vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, v.vec_id = component_id AS kept
FROM v JOIN part USING (vec_id) LEFT JOIN degree USING (vec_id)
"""

# What a step does, from the failures of each document: bit 0 is filter A, bit 4 filter E.
FILTER_AUDIT = """
WITH texts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents
), words AS (
  SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS w, min(doc_id) OVER (PARTITION BY t) AS least FROM texts
), failures AS (
  SELECT doc_id, part,
    CASE WHEN len(w) < 200 THEN 1 ELSE 0 END
    + CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 2 ELSE 0 END
    + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
    + CASE WHEN doc_id > least THEN 16 ELSE 0 END AS failed
  FROM words
), marks AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id
), counts AS (
  SELECT part, failed, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
  FROM failures LEFT JOIN marks USING (doc_id) GROUP BY part, failed
), letters AS (
  SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS l(letter, bit)
), orders AS (
  SELECT [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits, a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND len(list_distinct([a.bit, b.bit, c.bit, d.bit, e.bit])) = 5
), steps AS (
  SELECT filter_order, step::INTEGER AS step, bits[step] AS own, coalesce(list_sum(bits[1:step - 1]), 0)::INTEGER AS before
  FROM orders, range(1, 6) AS r(step)
), results AS (
  SELECT part, filter_order, step, own,
    sum(CASE WHEN failed & own = 0 AND failed & before = 0 THEN n ELSE 0 END)::BIGINT AS kept,
    sum(CASE WHEN failed & own <> 0 AND failed & before = 0 THEN n ELSE 0 END)::BIGINT AS removed,
    sum(CASE WHEN failed & own <> 0 AND failed & before <> 0 THEN n ELSE 0 END)::BIGINT AS redundant,
    sum(CASE WHEN failed = own THEN n ELSE 0 END)::BIGINT AS unique_fails,
    sum(CASE WHEN failed & own <> 0 AND failed & before = 0 THEN good ELSE 0 END)::BIGINT AS good_lost,
    sum(CASE WHEN failed & own <> 0 AND failed & before = 0 THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM counts, steps GROUP BY part, filter_order, step, own
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM results
"""

# The checksum goes byte by byte, bit by bit; near words meet where one letter is left out.
SPELLING_VARIANTS = """
WITH RECURSIVE runs AS (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]+')) AS raw FROM documents
  ), LATERAL (SELECT translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run) GROUP BY doc_id, run
), crc_table AS (
  SELECT list(list_reduce(list_prepend(b, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY b) AS entries
  FROM range(256) AS r(b)
), bytes AS (
  SELECT doc_id, run, n, list_transform(range(1, strlen(key) + 1), lambda k: ('0x' || hex(key)[2 * k - 1 : 2 * k])::BIGINT) AS b
  FROM (SELECT *, coalesce(doc_id::VARCHAR, '') || ':' || run AS key FROM runs)
), sums AS (
  SELECT run, n, xor(list_reduce(list_prepend(4294967295::BIGINT, b), lambda c, x: xor(c >> 8, entries[(xor(c, x) & 255) + 1])), 4294967295::BIGINT) AS h
  FROM bytes, crc_table
), words AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word, n FROM sums
), vocab AS (
  SELECT word, sum(n)::BIGINT AS n FROM words WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), cut AS (
  SELECT word, n, k, substr(word, 1, k - 1) || substr(word, k + 1) AS rest FROM vocab, LATERAL (SELECT unnest(range(1, length(word) + 1)) AS k)
), near AS (
  SELECT DISTINCT a.word, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.rest = b.rest AND a.k = b.k AND a.word <> b.word
  UNION SELECT c.word, v.word, v.n FROM cut c JOIN vocab v ON c.rest = v.word
  UNION SELECT v.word, c.word, c.n FROM cut c JOIN vocab v ON c.rest = v.word
), best AS (
  SELECT word, other, other_n, row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) AS r, count(*) OVER (PARTITION BY word) AS n_near FROM near
), forms AS (
  SELECT v.word, v.n, coalesce(b.n_near, 0)::BIGINT AS n_near, CASE WHEN other_n >= 2 * v.n THEN other END AS form, CASE WHEN other_n >= 2 * v.n THEN other_n END AS form_n
  FROM vocab v LEFT JOIN best b ON v.word = b.word AND b.r = 1
), chain AS (
  SELECT word, word AS root, form AS following FROM forms
  UNION ALL
  SELECT chain.word, forms.word, forms.form FROM chain JOIN forms ON chain.following = forms.word
)
SELECT forms.word, n, n_near, form, form_n, root FROM forms JOIN chain USING (word) WHERE following IS NULL
"""


def oracle_sql() -> dict[str, str]:
    return {"op5_embedding_dedup": EMBEDDING_DEDUP, "op11_filter_audit": FILTER_AUDIT, "op12_spelling_variants": SPELLING_VARIANTS}
