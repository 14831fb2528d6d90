"""DuckDB SQL for the queries that SQL can express on whole tables."""

CHAT = r"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length('### ' || role || ':' || chr(10) || chr(10) || '</turn>' || chr(10))
      + length(regexp_replace(text, '(\\*(?:###|</turn>))', '\\\1', 'g')))::BIGINT AS formatted_chars
FROM said GROUP BY conv_id
"""

TOP_K = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.x, c.x)::BIGINT AS score
  FROM whole q JOIN whole c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

WARC = """
WITH page AS (
  SELECT page_id, coalesce(html, '') AS payload FROM pages
), first AS (
  SELECT payload, min(page_id) AS page_id FROM page WHERE strlen(payload) >= 100 GROUP BY payload
)
SELECT p.page_id, strlen(p.payload)::BIGINT AS payload_bytes, sha256(p.payload) AS payload_digest,
  CASE WHEN f.page_id < p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN f.page_id < p.page_id THEN f.page_id END AS refers_to
FROM page p LEFT JOIN first f ON p.payload = f.payload
"""

CONTAMINATION = r"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), item AS (
  SELECT coalesce(item_id::VARCHAR, '') AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), cut AS (
  SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item WHERE len(w) > 0
), windows AS (
  SELECT DISTINCT item, array_to_string(w[i:i + 9], ' ') AS words, len(w[i:i + 9]) AS size FROM cut
), place AS (
  SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM doc, (SELECT DISTINCT size FROM windows) WHERE len(w) >= size
), hit AS (
  SELECT p.r, p.i, p.size, x.item FROM place p JOIN windows x ON x.size = p.size AND x.words = array_to_string(p.w[p.i:p.i + p.size - 1], ' ')
), covered AS (
  SELECT r, count(DISTINCT pos) AS n_hit FROM (SELECT r, unnest(range(i, i + size)) AS pos FROM hit) GROUP BY r
), named AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM hit) GROUP BY r
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(c.n_hit, 0)::BIGINT AS n_hit, coalesce(n.n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(n.items, '')) AS items_sha256, coalesce(c.n_hit, 0) > 0 AS contaminated
FROM doc d LEFT JOIN covered c USING (r) LEFT JOIN named n USING (r)
"""

# CRC-32 bit by bit, over the bytes of a decimal number.
CRC32 = """xor(list_reduce(flatten(list_transform(range(1, length(%s) + 1), lambda i: [ord((%s)[i])::BIGINT, 0, 0, 0, 0, 0, 0, 0])),
    lambda c, b: xor(xor(c, b) >> 1, 3988292384 * (xor(c, b) & 1)), 4294967295::BIGINT), 4294967295)"""

_FIELD = "coalesce(strlen(%s)::VARCHAR || ':' || %s, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_FIELD % (f, f) for f in ("doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text)) + ")"


MERKLE = f"""
WITH RECURSIVE leaf AS (
  SELECT doc_id, source, {_leaf('text')} AS leaf,
    CASE WHEN {CRC32 % ('doc_id::VARCHAR', 'doc_id::VARCHAR')} % 2 = 0 THEN {_leaf("replace(text, chr(10), '')")} ELSE {_leaf('text')} END AS shown
  FROM documents
), placed AS (
  SELECT *, row_number() OVER () AS r, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaf
), up AS (
  SELECT source, 0 AS lvl, pos, leaf AS node, count(*) OVER (PARTITION BY source) AS n FROM placed
  UNION ALL
  SELECT source, lvl + 1, pos // 3, sha256(string_agg(node, '' ORDER BY pos)), (n + 2) // 3 FROM up WHERE n > 1 GROUP BY source, lvl, pos // 3, n
), subroot AS (
  SELECT source, node, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place FROM up WHERE n = 1
), above AS (
  SELECT 0 AS lvl, place AS pos, node, count(*) OVER () AS n FROM subroot
  UNION ALL
  SELECT lvl + 1, pos // 3, sha256(string_agg(node, '' ORDER BY pos)), (n + 2) // 3 FROM above WHERE n > 1 GROUP BY lvl, pos // 3, n
), run AS (
  SELECT source, 0 AS part, lvl, pos // 3 AS run, list(node ORDER BY pos) AS nodes FROM up WHERE n > 1 GROUP BY source, lvl, pos // 3
  UNION ALL
  SELECT NULL, 1, lvl, pos // 3, list(node ORDER BY pos) FROM above WHERE n > 1 GROUP BY lvl, pos // 3
), heights AS (
  SELECT source, max(lvl) AS height FROM up GROUP BY source
), fold AS (
  SELECT r, source, 0 AS part, 0 AS lvl, pos, shown AS node, '' AS proof FROM placed
  UNION ALL
  SELECT f.r, f.source, CASE WHEN f.part = 0 AND f.lvl = h.height THEN 1 ELSE f.part END, CASE WHEN f.part = 0 AND f.lvl = h.height THEN 0 ELSE f.lvl + 1 END,
    CASE WHEN f.part = 0 AND f.lvl = h.height THEN s.place ELSE f.pos // 3 END,
    CASE WHEN f.part = 0 AND f.lvl = h.height THEN f.node
         ELSE sha256(array_to_string(x.nodes[:f.pos % 3], '') || f.node || array_to_string(x.nodes[f.pos % 3 + 2:], '')) END,
    CASE WHEN f.part = 0 AND f.lvl = h.height THEN f.proof
         ELSE f.proof || array_to_string(x.nodes[:f.pos % 3], '') || array_to_string(x.nodes[f.pos % 3 + 2:], '') END
  FROM fold f JOIN heights h ON f.source IS NOT DISTINCT FROM h.source JOIN subroot s ON f.source IS NOT DISTINCT FROM s.source
    LEFT JOIN run x ON x.part = f.part AND x.lvl = f.lvl AND x.run = f.pos // 3 AND (f.part = 1 OR x.source IS NOT DISTINCT FROM f.source)
  WHERE f.part = 0 OR f.lvl < (SELECT max(lvl) FROM above)
), root AS (
  SELECT node AS root FROM above WHERE n = 1
)
SELECT p.doc_id, p.leaf, s.node AS subroot, root, sha256(f.proof) AS proof_sha256, f.node AS folded_root, f.node = root AS verified
FROM placed p JOIN fold f ON p.r = f.r AND f.part = 1 AND f.lvl = (SELECT max(lvl) FROM above)
  JOIN subroot s ON p.source IS NOT DISTINCT FROM s.source CROSS JOIN root
"""

_BLANKS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
# (state, insertions, state after them, lines inserted); states: start, after system, after user, after assistant.
_INSERTIONS = """(0, 0, 0, []), (0, 1, 2, ['user:']), (0, 2, 3, ['user:', 'assistant:']), (0, 3, 2, ['user:', 'assistant:', 'user:']),
  (1, 0, 1, []), (1, 1, 2, ['user:']), (1, 2, 3, ['user:', 'assistant:']), (1, 3, 2, ['user:', 'assistant:', 'user:']),
  (2, 0, 2, []), (2, 1, 3, ['assistant:']), (2, 2, 2, ['assistant:', 'user:']), (2, 3, 3, ['assistant:', 'user:', 'assistant:']),
  (3, 0, 3, []), (3, 1, 2, ['user:']), (3, 2, 3, ['user:', 'assistant:']), (3, 3, 2, ['user:', 'assistant:', 'user:'])"""
_KEY = "(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))"

REPAIR = f"""
WITH RECURSIVE fated AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {CRC32 % (_KEY, _KEY)} % 20 AS fate FROM conversations
), kept AS (
  SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN fate = 1 THEN '' WHEN fate = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN fate = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM fated WHERE fate <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i, rtrim(text, {_BLANKS}) AS shown FROM kept
), coded AS (
  SELECT *, left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS earlier,
    CASE WHEN shown = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
      WHEN right(shown, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'sound' END AS fault
  FROM placed
), ins(s, k, t, lines) AS (VALUES {_INSERTIONS}
), way AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS i, 0 AS s, {{'cost': 0, 'audit': '', 'lines': []::VARCHAR[]}} AS best FROM coded
  UNION ALL
  SELECT w.conv_id, w.i + 1, e.to_state, min({{'cost': w.best.cost + 5 * x.k + e.cost, 'audit': w.best.audit || repeat('I', x.k) || e.letter,
      'lines': list_concat(list_concat(w.best.lines, x.lines::VARCHAR[]), CASE WHEN e.letter = 'D' THEN []::VARCHAR[] ELSE [e.role || ':' || c.text] END)}})
  FROM way w JOIN coded c ON w.conv_id IS NOT DISTINCT FROM c.conv_id AND c.i = w.i + 1 JOIN ins x ON x.s = w.s
    CROSS JOIN LATERAL (
      SELECT 'D' AS letter, 2 AS cost, x.t AS to_state, '' AS role
      UNION ALL SELECT 'K', CASE WHEN c.fault = 'truncated' THEN 5 ELSE 0 END, CASE c.initial WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END, c.role
        WHERE c.fault IN ('sound', 'truncated') AND ((x.t = 0 AND c.initial = 's') OR (x.t <> 2 AND c.initial = 'u') OR (x.t = 2 AND c.initial = 'a'))
      UNION ALL SELECT 'R', CASE WHEN c.fault = 'truncated' THEN 6 ELSE 1 END, CASE WHEN x.t = 2 THEN 3 ELSE 2 END, CASE WHEN x.t = 2 THEN 'assistant' ELSE 'user' END
        WHERE c.fault IN ('sound', 'truncated')
    ) e
  GROUP BY w.conv_id, w.i, e.to_state
), counted AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (i > 1 AND earlier || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM coded GROUP BY conv_id
), ended AS (
  SELECT w.conv_id, min({{'cost': w.best.cost + 5 * x.k, 'audit': w.best.audit || repeat('I', x.k), 'lines': list_concat(w.best.lines, x.lines::VARCHAR[])}}) AS best
  FROM way w JOIN counted c ON w.conv_id IS NOT DISTINCT FROM c.conv_id AND w.i = c.n JOIN ins x ON x.s = w.s AND x.t IN (0, 3)
  GROUP BY w.conv_id
)
SELECT o.conv_id, coalesce(c.gaps, 0)::BIGINT AS gaps, coalesce(c.blank, 0) AS blank, coalesce(c.duplicate, 0) AS duplicate, coalesce(c.truncated, 0) AS truncated,
  coalesce(c.illegal, 0) AS illegal, coalesce(e.best.cost, 0)::BIGINT AS cost, coalesce(e.best.audit, '') AS audit,
  sha256(coalesce(array_to_string(e.best.lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counted c ON o.conv_id IS NOT DISTINCT FROM c.conv_id
  LEFT JOIN ended e ON o.conv_id IS NOT DISTINCT FROM e.conv_id
"""
