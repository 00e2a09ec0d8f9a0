"""The registered queries of this subpackage and, where SQL can express them, their DuckDB SQL."""

from __future__ import annotations

from tallgrass.llm.bpe import op9_bpe
from tallgrass.llm.chat import op2_chat
from tallgrass.llm.exact_dedup import op5_exact_dedup
from tallgrass.llm.mixing import op3_mix
from tallgrass.llm.near_dedup import op1_near_dedup
from tallgrass.llm.quality import op8_quality
from tallgrass.llm.substring_dedup import op7_substring_dedup
from tallgrass.llm.token_counts import op4_token_counts
from tallgrass.llm.top_k import op6_top_k
from tallgrass.llm.warc import op10_warc

QUERIES = {f.__name__: f for f in (op1_near_dedup, op2_chat, op3_mix, op4_token_counts, op5_exact_dedup, op6_top_k, op7_substring_dedup, op8_quality, op9_bpe, op10_warc)}

ORACLE_SQL: dict[str, str] = {
    "op5_exact_dedup": r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM n JOIN g USING (t)
""",
    "op7_substring_dedup": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20),
v AS (SELECT doc_id, i, array_to_string(list_slice(w, i, i + 19), ' ') AS t FROM s),
f AS (SELECT doc_id, i, row_number() OVER (PARTITION BY t ORDER BY doc_id, i) AS r FROM v),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM f WHERE r > 1),
p AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d),
k AS (SELECT p.doc_id, string_agg(p.x, ' ' ORDER BY p.p) AS t, count(*) AS n FROM p ANTI JOIN c ON p.doc_id = c.doc_id AND p.p = c.p GROUP BY p.doc_id)
SELECT d.doc_id, len(d.w) AS n_words, len(d.w) - coalesce(k.n, 0) AS n_removed, sha256(coalesce(k.t, '')) AS kept_sha256 FROM d LEFT JOIN k USING (doc_id)
""",
    "op2_chat": r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, t, r, '<|im_end|><|im_start|>assistant ok' FROM (VALUES (0, 'user'), (1, 'assistant')) v(t, r)),
e AS (SELECT *, length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g')) + length(role) AS n FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(n + 24)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
""",
    "op10_warc": r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
f AS (SELECT html, min(page_id) AS first FROM p GROUP BY html),
h AS (SELECT page_id, html, first, from_hex(sha1(html))::BIT::VARCHAR AS b FROM p JOIN f USING (html))
SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + 16 * substr(b, 5 * i + 1, 1)::INT + 8 * substr(b, 5 * i + 2, 1)::INT
    + 4 * substr(b, 5 * i + 3, 1)::INT + 2 * substr(b, 5 * i + 4, 1)::INT + substr(b, 5 * i + 5, 1)::INT, 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to
FROM h
""",
    "op6_top_k": r"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
""",
    "op1_near_dedup": r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(list_slice(w, i, i + 4), ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS x FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT a AS node, a AS label FROM e UNION SELECT e.b, r.label FROM r JOIN e ON r.node = e.a)
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, coalesce(min(r.label), d.doc_id) AS component_id, coalesce(min(r.label), d.doc_id) = d.doc_id AS kept
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN r ON r.node = d.doc_id GROUP BY d.doc_id
""",
}
