"""SQL with the results of the registered queries, where SQL can express them on whole tables."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

# White space as the contracts define it (space, tab to carriage return).
_BLANK = r"[\x20\x09-\x0D]"
_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES["op3_line_dedup"] = rf"""
WITH lines AS (
  SELECT d.doc_id, u.i, u.line,
         {_LOWER.format(rf"regexp_replace(regexp_replace(u.line, '^{_BLANK}+', ''), '{_BLANK}+$', '')")} AS k
  FROM documents d,
       (SELECT doc_id AS id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
        FROM documents) u
  WHERE u.id = d.doc_id),
often AS (
  SELECT k, max(doc_id) AS keeper FROM lines WHERE length(k) >= 40
  GROUP BY k HAVING count(DISTINCT doc_id) >= 5)
SELECT l.doc_id, count(*) AS n_lines,
       count(*) FILTER (WHERE l.doc_id <> o.keeper) AS n_dropped,
       sha256(coalesce(string_agg(l.line, chr(10) ORDER BY l.i)
                       FILTER (WHERE o.keeper IS NULL OR l.doc_id = o.keeper), '')) AS kept_sha256
FROM lines l LEFT JOIN often o ON l.k = o.k
GROUP BY l.doc_id
"""

_WORDS = rf"""regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

ORACLES["op8_decontamination"] = rf"""
WITH items AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, list_slice(w, i, i + least(len(w), 10) - 1) AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i
        FROM items WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT len(g) AS n FROM windows),
docs AS (SELECT doc_id, {_WORDS} AS w FROM documents),
grams AS (
  SELECT doc_id, i, n, list_slice(w, i, i + n - 1) AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM docs), sizes
  WHERE i + n - 1 <= len(w)),
hits AS (SELECT doc_id, i, n, item_id FROM grams JOIN windows USING (g)),
places AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
found AS (
  SELECT doc_id, count(*) AS n_items,
         sha256(string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR))) AS h
  FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, coalesce(h, sha256('')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN places USING (doc_id) LEFT JOIN found USING (doc_id)
"""

# A control string, broken by any number of backslashes after its first character, grows by one.
_CONTROL = (
    r"<\\*s>|<\\*\|role\|>|<\\*\|text\|>|<\\*\|end\|>|<\\*/s>|\[\\*INST\]|\[\\*/INST\]"
)

ORACLES["op1_chat_format"] = rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text))
         AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT)
         AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, text)
                       FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(length('<s></s>') + sum(
         length('<|role|><|text|><|end|>') + length(role) + length(text)
         + len(regexp_extract_all(role, '{_CONTROL}'))
         + len(regexp_extract_all(text, '{_CONTROL}'))) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""

ORACLES["op4_url_filter"] = rf"""
WITH parts AS (
  SELECT page_id, coalesce(regexp_matches(url, '[?&](utm_[a-z]+|ref)='), FALSE) AS tracked,
         CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3)
              ELSE '' END AS rest FROM pages),
hosts AS (
  SELECT page_id, tracked, {_LOWER.format("regexp_extract(rest, '^[^/?#]*')")} AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parts),
listed AS (
  SELECT host FROM hosts WHERE host <> '' GROUP BY host
  HAVING CAST(count(*) FILTER (WHERE tracked) AS DOUBLE) / count(*)
       > (SELECT CAST(count(*) FILTER (WHERE tracked) AS DOUBLE) / count(*) FROM hosts)),
rules (action, h, p) AS (VALUES
  ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
  ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
best AS (
  SELECT page_id, arg_max(h || p, length(h || p)) AS rule, arg_max(action, length(h || p)) AS action
  FROM hosts JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
  GROUP BY page_id)
SELECT page_id, host, path, rule,
       coalesce(action, CASE WHEN host IN (SELECT host FROM listed)
                             THEN 'block' ELSE 'allow' END) AS verdict
FROM hosts LEFT JOIN best USING (page_id)
"""

ORACLES["op6_imatch"] = rf"""
WITH ordered AS (
  SELECT doc_id, coalesce(text, '') AS text,
         coalesce(lead(doc_id) OVER w, first_value(doc_id) OVER w) AS next_id,
         coalesce(lead(coalesce(text, '')) OVER w, first_value(coalesce(text, '')) OVER w) AS nxt
  FROM documents
  WINDOW w AS (ORDER BY doc_id DESC ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
cut AS (
  SELECT *, length(text) AS n, length(text) // 3 AS third FROM ordered),
edited AS (
  SELECT *, left(text, n - third) || left(nxt, third) AS changed FROM cut),
texts AS (
  SELECT doc_id, 0 AS kind, text FROM edited
  UNION ALL SELECT doc_id, 1, changed FROM edited),
terms AS (
  SELECT DISTINCT doc_id, kind, unnest({_WORDS}) AS term FROM texts),
lexicon AS (
  SELECT term FROM terms WHERE kind = 0 GROUP BY term
  HAVING count(*) * 1024 >= (SELECT count(*) FROM documents)
     AND count(*) * 4 <= (SELECT count(*) FROM documents)),
subsets AS (
  SELECT term, k FROM lexicon, range(0, 54) r (k)
  WHERE (CAST('0x' || left(md5(term), 15) AS BIGINT)
         & (((2::BIGINT << (k % 9)::INTEGER) - 1) << (10 * (k // 9))::INTEGER)) = 0),
marks AS (
  SELECT doc_id, kind, k, left(md5(string_agg(term, ' ' ORDER BY term COLLATE "C")), 8) AS h
  FROM terms JOIN subsets USING (term) GROUP BY ALL),
whole AS (
  SELECT doc_id, kind, md5(string_agg(term, ' ' ORDER BY term COLLATE "C")) AS all_terms
  FROM terms GROUP BY ALL),
hashed AS (
  SELECT doc_id, kind, list(coalesce(h, '') ORDER BY k) AS f
  FROM (SELECT doc_id, kind, k FROM texts, range(0, 54) r (k)) LEFT JOIN marks USING (doc_id, kind, k)
  GROUP BY ALL),
prints AS (
  SELECT doc_id, kind,
         list_append(f, CASE WHEN array_to_string(f, '') = '' THEN coalesce(all_terms, '') ELSE '' END) AS f
  FROM hashed LEFT JOIN whole USING (doc_id, kind)),
sides AS (
  SELECT e.doc_id, e.n, e.changed, a.f AS own, b.f AS edited, c.f AS following
  FROM edited e JOIN prints a ON a.doc_id = e.doc_id AND a.kind = 0
  JOIN prints b ON b.doc_id = e.doc_id AND b.kind = 1
  JOIN prints c ON c.doc_id = e.next_id AND c.kind = 0),
shares AS (
  SELECT *,
    coalesce(list_sum([2 << ((i - 1) % 9)::INTEGER FOR i IN range(1, 56) IF own[i] <> '' OR edited[i] <> '']), 0) AS n1,
    coalesce(list_sum([2 << ((i - 1) % 9)::INTEGER FOR i IN range(1, 56) IF own[i] <> '' AND own[i] = edited[i]]), 0) AS m1,
    coalesce(list_sum([2 << ((i - 1) % 9)::INTEGER FOR i IN range(1, 56) IF own[i] <> '' OR following[i] <> '']), 0) AS n2,
    coalesce(list_sum([2 << ((i - 1) % 9)::INTEGER FOR i IN range(1, 56) IF own[i] <> '' AND own[i] = following[i]]), 0) AS m2
  FROM sides)
SELECT doc_id, n AS n_chars, sha256(changed) AS edited_sha256,
       array_to_string(own, '.') AS fingerprint, array_to_string(edited, '.') AS edited_fingerprint,
       CASE WHEN n1 = 0 THEN 1.0 ELSE CAST(m1 AS DOUBLE) / n1 END AS near_edited,
       CASE WHEN n2 = 0 THEN 1.0 ELSE CAST(m2 AS DOUBLE) / n2 END AS near_next
FROM shares
"""

ORACLES["op13_hard_negatives"] = """
WITH rows AS (
  SELECT vec_id,
         CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label::BIGINT END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS id, a.label = r.label AS same,
         CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
  FROM rows a JOIN rows r ON a.vec_id % 50 = 0 AND a.vec_id <> r.vec_id AND len(a.v) = len(r.v)),
positives AS (
  SELECT anchor_id, id, score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, p.id AS positive_id,
       CAST(row_number() OVER (
         PARTITION BY anchor_id, p.id ORDER BY s.score DESC, s.id) AS INTEGER) AS rank,
       s.id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM positives p JOIN scores s USING (anchor_id)
WHERE NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score
QUALIFY rank <= 3
"""
