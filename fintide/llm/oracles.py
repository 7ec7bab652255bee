"""DuckDB SQL of the queries that SQL can express."""

OP1 = r"""
WITH parts AS (
  SELECT page_id, CASE WHEN url LIKE '%://%' THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
split AS (
  SELECT page_id,
    translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
    regexp_extract(rest, '^[^?#]*(\?[^#]*)', 1) AS query
  FROM parts),
ruled AS (
  SELECT *,
    CASE WHEN host <> '' THEN
      regexp_replace(regexp_replace(host, ':(80|443)$', ''), '^www\.', '') || regexp_replace(path, '/+$', '')
      || regexp_replace(regexp_replace(query, '([?&])(?:utm_[^&]*(?:&|$))+', '\1', 'g'), '[?&]+$', '') END AS canonical,
    CASE WHEN (host = 'example.org' OR host LIKE '%.example.org') AND path LIKE '/en/1%' THEN 'example.org/en/1'
         WHEN (host = 'example.org' OR host LIKE '%.example.org') AND path LIKE '/es/%' THEN 'example.org/es/'
         WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/fr/%' THEN 'com/fr/'
         WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/de/%' THEN 'com/de/'
         WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/%' THEN 'org/' END AS rule
  FROM split),
listing AS (
  SELECT DISTINCT canonical AS on_list FROM ruled
  WHERE regexp_matches(host, '(^|\.)(ads-track|adult-x|casino-win|cheap-pills|free-bets|spam-farm)\.'))
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
       WHEN on_list IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict,
  canonical, on_list IS NOT NULL AS listed
FROM ruled LEFT JOIN listing ON canonical = on_list
"""

OP3 = r"""
WITH RECURSIVE lines AS (
  SELECT conv_id, turn, m, unnest(parts) AS line, generate_subscripts(parts, 1) AS i
  FROM (SELECT conv_id, turn, row_number() OVER () AS m, string_split(text, chr(10)) AS parts FROM conversations
        WHERE conv_id IS NOT NULL AND turn IS NOT NULL AND text IS NOT NULL)),
parsed AS (
  SELECT conv_id, turn, m, i, length(regexp_replace(regexp_extract(line, '^[ \t]*((?:>[ \t]*)*)', 1), '[ \t]', '', 'g')) AS level,
    trim(regexp_replace(translate(
      CASE WHEN regexp_matches(line, '^[ \t]*>') THEN regexp_replace(line, '^[ \t]*((?:>[ \t]*)*)', '') ELSE line END,
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+', ' ', 'g')) AS content
  FROM lines),
islands AS (
  SELECT *, sum(opens) OVER (PARTITION BY m ORDER BY i) AS block
  FROM (SELECT *, CASE WHEN level = lag(level) OVER (PARTITION BY m ORDER BY i) THEN 0 ELSE 1 END AS opens FROM parsed)),
blocks AS (
  SELECT conv_id, turn, level, list_filter(string_split(string_agg(content, ' ' ORDER BY i), ' '), lambda x: x <> '') AS w
  FROM islands GROUP BY conv_id, turn, level, m, block),
passages AS (
  SELECT DISTINCT conv_id, turn, level, array_to_string(list_slice(w, k, k + 4), ' ') AS passage
  FROM (SELECT *, unnest(range(1, len(w) - 3)) AS k FROM blocks WHERE len(w) >= 5)
  UNION SELECT conv_id, turn, level, array_to_string(w, ' ') FROM blocks WHERE len(w) BETWEEN 1 AND 4
  UNION SELECT conv_id, turn, level, content FROM parsed WHERE content <> '' AND len(string_split(content, ' ')) < 5),
said AS (SELECT conv_id, passage, min(turn) AS quoted_turn FROM passages WHERE level = 0 GROUP BY ALL),
votes AS (
  SELECT q.conv_id, q.turn, q.level, s.quoted_turn, count(*) AS n
  FROM passages q JOIN said s ON q.conv_id = s.conv_id AND q.passage = s.passage AND s.quoted_turn < q.turn
  WHERE q.level > 0 GROUP BY ALL),
linked AS (SELECT conv_id, turn, level, arg_max(quoted_turn, (n, quoted_turn)) AS quoted_turn FROM votes GROUP BY ALL),
replies AS (SELECT conv_id, turn, quoted_turn AS reply_to FROM linked WHERE level = 1),
told AS (SELECT conv_id, turn, string_agg(level || ':' || quoted_turn, ',' ORDER BY level) AS quoted FROM linked GROUP BY ALL),
walk AS (
  SELECT conv_id, turn, reply_to, reply_to AS up, 1 AS depth, [turn] AS path FROM replies
  UNION ALL
  SELECT w.conv_id, w.turn, w.reply_to, r.reply_to, w.depth + 1, list_concat([w.up], w.path)
  FROM walk w JOIN replies r ON r.conv_id = w.conv_id AND r.turn = w.up),
chain AS (
  SELECT conv_id, turn, any_value(reply_to) AS reply_to, arg_max(up, depth) AS thread_turn, max(depth) AS depth, arg_max(path, depth) AS path
  FROM walk GROUP BY conv_id, turn),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id, thread_turn ORDER BY path) AS place FROM chain),
clean AS (
  SELECT *,
    CASE WHEN regexp_matches(text, '(?m)^[ \t]*>') THEN trim(array_to_string(
      list_filter(string_split(text, chr(10)), lambda x: NOT regexp_matches(x, '^[ \t]*>')), chr(10)), chr(10))
    ELSE text END AS bare,
    coalesce(len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '^[ \t]*>'))), 0) AS n_quoted
  FROM conversations)
SELECT c.conv_id, c.turn, c.role, c.bare AS text, c.n_quoted::BIGINT AS n_quoted, coalesce(t.quoted, '') AS quoted, h.reply_to,
  coalesce(h.thread_turn, c.turn) AS thread_turn, coalesce(h.place, 0)::BIGINT AS place, coalesce(h.depth, 0)::BIGINT AS depth,
  '<|' || coalesce(c.role, '') || '|>' || chr(10) || coalesce(c.bare, '') || chr(10) || '<|end|>' AS chat
FROM clean c LEFT JOIN placed h ON c.conv_id = h.conv_id AND c.turn = h.turn
LEFT JOIN told t ON c.conv_id = t.conv_id AND c.turn = t.turn
"""

OP6 = r"""
WITH pages AS (SELECT DISTINCT source, text FROM documents),
totals AS (SELECT source, count(*) AS host_pages FROM pages GROUP BY source),
lines AS (
  SELECT DISTINCT source, text, trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare
  FROM (SELECT source, text, unnest(string_split(text, chr(10))) AS line FROM pages) t),
boilerplate AS (
  SELECT l.source, list(l.bare) AS bad
  FROM (SELECT source, bare, count(*) AS pages FROM lines WHERE bare <> '' GROUP BY ALL) l
  JOIN totals t ON l.source IS NOT DISTINCT FROM t.source
  WHERE pages >= 3 AND pages > 0.05::DOUBLE * host_pages GROUP BY l.source),
cut AS (
  SELECT doc_id, d.source, text, bad, string_split(text, chr(10)) AS parts,
    list_filter(string_split(text, chr(10)), lambda x:
      NOT list_contains(bad, trim(x, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)))) AS good
  FROM documents d LEFT JOIN boilerplate b ON d.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, source, CASE WHEN bad IS NULL THEN text ELSE array_to_string(good, chr(10)) END AS text,
  coalesce(len(parts), 0)::BIGINT AS n_lines,
  CASE WHEN bad IS NULL OR text IS NULL THEN 0 ELSE len(parts) - len(good) END::BIGINT AS n_dropped
FROM cut
"""

OP12 = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
split AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM split),
ones AS (SELECT lang, w[i] AS p, count(*) AS f FROM places GROUP BY ALL),
twos AS (SELECT lang, w[i] AS w1, w[i + 1] AS w2, count(*) AS f FROM places WHERE i + 1 <= len(w) GROUP BY ALL HAVING count(*) >= 10),
threes AS (
  SELECT lang, w[i] AS w1, w[i + 1] AS w2, w[i + 2] AS w3, count(*) AS f FROM places WHERE i + 2 <= len(w)
  GROUP BY ALL HAVING count(*) >= 10),
total AS (SELECT lang, sum(f)::BIGINT AS n FROM ones GROUP BY lang),
held AS (
  SELECT lang, w1, w2, max(f) AS f FROM (
    SELECT lang, w1, w2, f FROM threes UNION ALL SELECT lang, w2, w3, f FROM threes) GROUP BY ALL),
cuts AS (
  SELECT t.lang, t.w1 || ' ' || t.w2 AS phrase, 1 AS k, t.f AS a, x.f AS l, y.f AS r
  FROM twos t JOIN ones x ON x.lang = t.lang AND x.p = t.w1 JOIN ones y ON y.lang = t.lang AND y.p = t.w2
  LEFT JOIN held h ON h.lang = t.lang AND h.w1 = t.w1 AND h.w2 = t.w2
  WHERE h.f IS NULL OR 100 * h.f < 50 * t.f
  UNION ALL
  SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, 1, t.f, x.f, y.f
  FROM threes t JOIN ones x ON x.lang = t.lang AND x.p = t.w1 JOIN twos y ON y.lang = t.lang AND y.w1 = t.w2 AND y.w2 = t.w3
  UNION ALL
  SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, 2, t.f, x.f, y.f
  FROM threes t JOIN twos x ON x.lang = t.lang AND x.w1 = t.w1 AND x.w2 = t.w2 JOIN ones y ON y.lang = t.lang AND y.p = t.w3),
scored AS (
  SELECT *, (1000000::HUGEINT * a::HUGEINT * a::HUGEINT // (l::HUGEINT * r::HUGEINT))::BIGINT AS score FROM cuts
  QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM scored)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""

OP13 = r"""
WITH rows AS (
  SELECT DISTINCT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT a.id AS anchor_id, a.label AS anchor_label, b.id, b.label, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM rows a JOIN rows b ON a.id <> b.id WHERE a.id % 100 = 0),
positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scores WHERE label = anchor_label
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
near AS (
  SELECT anchor_id, positive_id, positive_score, id AS negative_id, score AS negative_score,
    row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS rank
  FROM positives JOIN scores USING (anchor_id)
  WHERE label <> anchor_label AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM near WHERE rank <= 10
"""
