"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations


EMBEDDING_LINKS = """
WITH RECURSIVE good AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b
    ON a.label = b.label AND len(a.v) = len(b.v) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= 0.98
), reached(node, other) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION
  SELECT r.node, l.b FROM reached r JOIN links l ON l.a = r.other
), component AS (SELECT node, min(other) AS component_id FROM reached GROUP BY node)
SELECT e.vec_id, coalesce(n.n_links, 0) AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e JOIN component c ON c.node = e.vec_id
LEFT JOIN (SELECT a, count(*) AS n_links FROM links GROUP BY a) n ON n.a = e.vec_id
"""


FILL_IN_MIDDLE = r"""
WITH lines AS (
  SELECT doc_id, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS units,
    sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents
), drawn AS (
  SELECT *, len(units) AS n, ('0x' || substr(h, 1, 8))::BIGINT % (len(units) + 1) AS c1,
    ('0x' || substr(h, 9, 8))::BIGINT % (len(units) + 1) AS c2,
    ('0x' || substr(h, 17, 8))::BIGINT % 100 AS r3, ('0x' || substr(h, 25, 8))::BIGINT % 100 AS r4
  FROM lines
), cut AS (
  SELECT doc_id, text, n,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR r3 >= 100
      THEN 'plain' WHEN r4 < 50 THEN 'spm' ELSE 'psm' END AS form,
    array_to_string(units[1:least(c1, c2)], '') AS p,
    array_to_string(units[least(c1, c2) + 1:greatest(c1, c2)], '') AS m,
    array_to_string(units[greatest(c1, c2) + 1:], '') AS s
  FROM drawn
)
SELECT doc_id, n, form,
  CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
    ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM cut
"""


def all_oracles() -> dict[str, str]:
    return {"op1_embedding_links": EMBEDDING_LINKS, "op13_fill_in_middle": FILL_IN_MIDDLE}
