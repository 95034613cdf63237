"""The operators' results in plain SQL over the test tables, where SQL can say them."""

from __future__ import annotations

# Every window of 13 aligned words with two differences at most, and of 8 with one, has four equal words in a row, so
# pairs are looked for on the diagonals that such runs mark. `eq` has an entry for each place of the
# item, and two more on either side, on one diagonal.
_WORDS = r"list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{M}\p{N}]+'), lambda x: x <> '')"
OVERLAPS = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT DISTINCT item_id, {_WORDS} AS w FROM benchmark),
item AS (SELECT item_id, w, len(w) AS n, least(len(w), 4) AS run, least(len(w), 13) AS size,
    CASE WHEN len(w) >= 13 THEN 2 WHEN len(w) >= 8 THEN 1 ELSE 0 END AS pad FROM b WHERE len(w) > 0),
runs AS (SELECT DISTINCT run FROM item),
item_run AS (SELECT item_id, run, j, array_to_string(w[j + 1:j + run], ' ') AS g
  FROM (SELECT item_id, run, w, unnest(range(0, n - run + 1)) AS j FROM item)),
doc_run AS (SELECT doc_id, run, i, array_to_string(w[i + 1:i + run], ' ') AS g
  FROM (SELECT doc_id, run, w, unnest(range(0, len(w) - run + 1)) AS i FROM d, runs WHERE len(w) >= run)),
diagonal AS (SELECT DISTINCT doc_id, item_id, i - j AS shift FROM doc_run JOIN item_run USING (run, g)),
compared AS (
  SELECT doc_id, item_id, shift, n, size, pad, len(d.w) AS words,
    list_transform(range(-pad, n + pad), lambda j: CASE WHEN j >= 0 AND j < n AND j + shift >= 0
      AND item.w[greatest(j, 0) + 1] = d.w[greatest(j + shift, 0) + 1] THEN 1 ELSE 0 END) AS eq
  FROM diagonal JOIN item USING (item_id) JOIN d USING (doc_id)),
windows AS (
  SELECT doc_id, item_id, words, size, pad, shift + k - pad AS first, list_sum(eq[k + 1:k + size]) AS equal
  FROM (SELECT *, unnest(range(0, n + 2 * pad - size + 1)) AS k FROM compared))
SELECT doc_id, item_id, CAST(max(equal) AS INT) AS equal_words, CAST(greatest(min(first), 0) AS INT) AS first_word,
  CAST(max(least(first + size, words) - 1) AS INT) AS last_word
FROM windows WHERE equal >= size - pad GROUP BY doc_id, item_id
"""

NEGATIVES = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pair AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
    CAST(list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
positive AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM pair WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT anchor_id, positive_id,
  CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) AS INT) AS rank,
  other_id AS negative_id, positive_score, score AS negative_score
FROM positive JOIN pair USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""

ORACLE_SQL: dict[str, str] = {"op3_spaced_seeds": OVERLAPS, "op12_secondary_sort_negatives": NEGATIVES}
