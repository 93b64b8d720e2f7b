"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ORACLE = {
    "op2_warc_index_first": """
  WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
  m AS (SELECT *, strlen(html) AS n, max(page_id) OVER (PARTITION BY html) AS last FROM p)
  SELECT page_id, n::BIGINT AS payload_bytes, sha1(html) AS payload_digest,
         CASE WHEN n >= 1000 AND page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
         CASE WHEN n >= 1000 AND page_id < last THEN last END AS refers_to FROM m""",
    # A text is escaped only if it holds a control string or an escape mark.
    "op6_chat_round_trip": r"""
  WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
             UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
  e AS (SELECT *, regexp_replace(regexp_replace(regexp_replace(text, '%(25|3C|5B|0A)', '%25\1', 'g'), '<(/?s>)', '%3C\1', 'g'),
                                 '\[(/?INST\])', '%5B\1', 'g') AS escaped FROM t),
  g AS (SELECT conv_id, count(*) AS n_turns,
               string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS said,
               coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '') AS loss,
               sum(length(role) + 1 + length(escaped) + CASE WHEN role = 'assistant' THEN length('<s></s>') ELSE length('<s>[INST][/INST]</s>') END) AS n
        FROM e GROUP BY conv_id)
  SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256,
         n::BIGINT AS formatted_chars FROM g""",
    "op10_minhash_near_dedup": f"""
  WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format(f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')")} AS w FROM documents),
  s AS (SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
          ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))) END) AS shingle FROM w),
  n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
  pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
  one AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 85 * (x.n + y.n - shared)),
  links AS (SELECT a, b FROM one UNION ALL SELECT b, a FROM one),
  reach AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other),
  c AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
  SELECT c.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id, c.doc_id = component_id AS kept FROM c LEFT JOIN n USING (doc_id)""",
    "op11_occurrence_join": f"""
  WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format(f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')")} AS w FROM documents),
  s AS (SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
          ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END) AS shingle FROM w),
  n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
  pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
  one AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 85 * (x.n + y.n - shared)),
  links AS (SELECT a, b FROM one UNION ALL SELECT b, a FROM one),
  reach AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other),
  c AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
  SELECT c.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id FROM c LEFT JOIN n USING (doc_id)""",
    # CRC-32 of the decimal conv_id: eight shifts per character.
    "op13_prefix_trie": """
  WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
               row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
             FROM conversations WHERE conv_id IS NOT NULL),
  c AS (SELECT conv_id, conv_id - conv_id % 5 AS base, xor(list_reduce(
          list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(conv_id::VARCHAR, ''), lambda s: [ascii(s)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
          lambda x, b: xor(xor(x, b) >> 1, CASE WHEN xor(x, b) % 2 = 1 THEN 3988292384 ELSE 0 END)), 4294967295::BIGINT) % 9 AS h
        FROM (SELECT DISTINCT conv_id FROM t)),
  r AS (SELECT c.conv_id, t.role, t.text, t.place, 0 AS own FROM c JOIN t ON t.conv_id = c.base AND t.place <= c.h
        UNION ALL SELECT c.conv_id, t.role, t.text, t.place, 1 FROM c JOIN t ON t.conv_id = c.conv_id AND t.place > c.h),
  d AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY own, place) AS depth FROM r),
  p AS (SELECT conv_id, depth, strlen(text) AS bytes,
          string_agg(sha256(length(role) || ':' || role || text), '') OVER (PARTITION BY conv_id ORDER BY depth) AS path FROM d
        UNION ALL SELECT conv_id, 0, 0, '' FROM c),
  k AS (SELECT conv_id, depth, bytes, sha256(path) AS key, sha256(left(path, length(path) - 64)) AS up FROM p),
  n AS (SELECT depth, key, min(conv_id) AS conv_id, count(*) AS n_convs, max(bytes) AS bytes, min(up) AS up FROM k GROUP BY 1, 2),
  kids AS (SELECT depth - 1 AS depth, up AS key, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1, 2),
  v AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN kids USING (depth, key)),
  s AS (SELECT a.depth, a.key, sum(CASE WHEN v.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((v.n_convs - 1) * v.bytes) AS saved
        FROM v JOIN k a ON a.conv_id = v.conv_id AND a.depth <= v.depth GROUP BY 1, 2),
  last AS (SELECT conv_id, max(depth) AS depth FROM k GROUP BY 1),
  ends AS (SELECT depth, key, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS ends FROM k JOIN last USING (conv_id, depth) GROUP BY 1, 2)
  SELECT v.conv_id, v.depth::BIGINT AS depth, q.conv_id AS parent_conv_id, v.n_convs::BIGINT AS n_convs, v.n_children::BIGINT AS n_children,
         n_leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, coalesce(ends, sha256('')) AS ends_sha256
  FROM v JOIN s USING (depth, key) LEFT JOIN ends USING (depth, key) LEFT JOIN n q ON q.depth = v.depth - 1 AND q.key = v.up""",
}
