"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

# Texts grow by a backslash per control string and backslash; a turn has 4 + 2 + 8
# characters and its label around its text.
OP1_CHAT = r"""
WITH planted AS (
  SELECT * FROM (VALUES
    (-7::BIGINT, 0::BIGINT, 'user', '\### Assistant: </turn> ok'),
    (-7::BIGINT, 1::BIGINT, 'assistant', '\### Assistant: </turn> ok')
  ) AS v(conv_id, turn, role, text)
), turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM (SELECT conv_id, turn, role, text FROM conversations UNION ALL FROM planted)
)
SELECT conv_id,
  count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text))
    AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), ''))
    AS loss_sha256,
  sum(14 + length(role) + length(regexp_replace(text, '(\\|###|</turn>)', '\\\1', 'g')))::BIGINT
    AS formatted_chars
FROM turns GROUP BY conv_id
"""

OP10_TOPK = """
WITH v AS (
  SELECT DISTINCT vec_id,
    list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    list_dot_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
  FROM scored
) WHERE rank <= 10
"""

OP11_DIVERGENCE = r"""
WITH d AS (
  SELECT row_number() OVER () AS i, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), words AS (
  SELECT i, lang, source, term, count(*) AS n
  FROM (SELECT i, lang, source, unnest(terms) AS term FROM d) GROUP BY ALL
), kept AS (
  SELECT lang, term, sum(n)::HUGEINT AS n FROM words GROUP BY lang, term HAVING count(*) >= 10
), langs AS (
  SELECT lang, count(term)::HUGEINT AS v, coalesce(sum(n), 0)::HUGEINT AS total
  FROM (SELECT DISTINCT lang FROM d) LEFT JOIN kept USING (lang) GROUP BY lang
), counted AS (
  SELECT lang, source, term, sum(words.n)::HUGEINT AS n
  FROM words JOIN kept USING (lang, term) GROUP BY ALL
), sources AS (
  SELECT lang, source, v, langs.total AS lang_total, coalesce(sum(n), 0)::HUGEINT AS total
  FROM (SELECT DISTINCT lang, source FROM d) JOIN langs USING (lang)
  LEFT JOIN counted USING (lang, source) GROUP BY ALL
), shares AS (
  SELECT s.lang, s.source, kept.term, coalesce(c.n, 0) AS n,
    1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 2) // (s.total + 2 * v) AS p,
    1 + 1000000000::HUGEINT * (kept.n + 2) // (lang_total + 2 * v) AS q
  FROM sources s JOIN kept USING (lang)
  LEFT JOIN counted c ON c.lang = s.lang AND c.source = s.source AND c.term = kept.term
), items AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
    coalesce(sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)), 0)::BIGINT AS value
  FROM sources a JOIN sources b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN shares x ON x.lang = a.lang AND x.source = a.source
  LEFT JOIN shares y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
  GROUP BY ALL
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q) // (p + q))::BIGINT
  FROM shares WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY lang, source, part ORDER BY value DESC, item COLLATE "binary")::INTEGER AS rank
  FROM items
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""

LLM_ORACLES: dict[str, str] = {
    "op1_chat": OP1_CHAT,
    "op10_topk": OP10_TOPK,
    "op11_divergence": OP11_DIVERGENCE,
}
