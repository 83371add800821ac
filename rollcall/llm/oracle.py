"""SQL for the operators that SQL can express, run by DuckDB over the same tables."""

from __future__ import annotations

MIXING = r"""
WITH sized AS (
  SELECT doc_id, text, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents
), graded AS (
  SELECT doc_id, avg(quality) AS quality FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id
), keyed AS (
  SELECT s.doc_id, s.source, s.size,
    -ln((('0x' || substr(md5(coalesce(s.doc_id::VARCHAR, '') || '/' || md5(coalesce(s.text, ''))), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0)
      / coalesce(0.5 + 1.5 * g.quality, 1.0) AS key
  FROM sized s LEFT JOIN graded g USING (doc_id)
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM sized GROUP BY source
), limits AS (
  SELECT *, (source_size * 2)::DOUBLE AS most, (source_size * 2)::DOUBLE / weight AS per, sum(source_size) OVER ()::DOUBLE AS total FROM sources
), levels AS (
  SELECT *, (total * 1.5 - (sum(most) OVER (ORDER BY per, source NULLS LAST) - most))
    / sum(weight) OVER (ORDER BY per, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM limits
), level AS (
  SELECT arg_min(level, per) AS level FROM levels WHERE level <= per
), aims AS (
  SELECT source, source_size, coalesce(least(most, level.level * weight), most) AS target FROM levels, level
), rests AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs FROM aims
), placed AS (
  SELECT k.doc_id, k.size, r.source_size, r.target, r.epochs, r.target - r.epochs * r.source_size AS rest,
    sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.doc_id) - k.size AS before
  FROM keyed k JOIN rests r ON k.source IS NOT DISTINCT FROM r.source
)
SELECT doc_id, size, source_size, target,
  CASE WHEN size = 0 THEN 0 ELSE size * (epochs + greatest(0, least(1, floor((rest - before) / size + 0.5)))) END::BIGINT AS taken
FROM placed
"""

LINES = r"""
WITH cut AS (
  SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS raw FROM documents
), placed AS (
  SELECT *, NOT regexp_matches(line, '^\s*$') AS is_full, row_number() OVER (PARTITION BY line ORDER BY doc_id, raw) > 1 AS is_later FROM cut
), texts AS (
  SELECT doc_id, count(*) FILTER (is_full) AS n_lines, count(*) FILTER (is_full AND is_later) AS n_removed,
    coalesce(string_agg(line, chr(10) ORDER BY raw) FILTER (NOT is_full OR NOT is_later), '') AS kept
  FROM placed GROUP BY doc_id
)
SELECT d.doc_id, coalesce(t.n_lines, 0) AS n_lines, coalesce(t.n_removed, 0) AS n_removed,
  CASE WHEN d.text IS NULL THEN NULL WHEN t.n_removed = 0 THEN sha256(d.text) WHEN t.n_removed = t.n_lines THEN sha256('') ELSE sha256(t.kept) END AS kept_sha256
FROM documents d LEFT JOIN texts t USING (doc_id)
"""

_ASSIGN = r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
_SCANS = " UNION ALL ".join(
    f"SELECT doc_id, source, text, {kind} AS kind, regexp_extract_all(text, '{pattern}') AS hits, string_split_regex(text, '{pattern}') AS gaps FROM texts"
    for kind, pattern in enumerate((_ASSIGN, "AKIA[A-Z0-9]+", "[0-9a-f]{32,}", "[A-Za-z0-9+/_-]{20,}"))
)
SECRETS = rf"""
WITH texts AS (
  SELECT doc_id, source, coalesce(text, '') AS text FROM documents
), scans AS (
  {_SCANS}
), numbered AS (
  SELECT doc_id, source, kind, hits, gaps, unnest(range(1, len(hits) + 1)) AS i FROM scans WHERE len(hits) > 0
), placed AS (
  SELECT doc_id, source, kind, hits[i] AS hit,
    (list_sum(list_transform(gaps[1:i], lambda g: len(g))) + list_sum(list_transform(hits[1:i], lambda h: len(h))))::BIGINT AS stop FROM numbered
), valued AS (
  SELECT *, CASE kind WHEN 0 THEN regexp_extract(hit, '{_ASSIGN}', 1) ELSE hit END AS value, stop - len(hit) AS start FROM placed
), kept AS (
  SELECT *, len(value) >= 16 AND regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Za-z]') AND list_unique(string_split(value[1:64], '')) >= 8
    AND NOT regexp_matches(value, '(?i)example|sample|dummy|changeme|placeholder|your_?|test|x{{4}}|1234567') AS looks_live
  FROM valued WHERE CASE kind WHEN 0 THEN len(value) >= 8 WHEN 1 THEN len(value) >= 16 ELSE true END
), held AS (
  SELECT value, count(DISTINCT coalesce(source, '<null>')) AS owners, count(DISTINCT (source, doc_id)) AS repositories, bool_or(looks_live) AS looks_live
  FROM kept GROUP BY value
), standing AS (
  SELECT value, CASE WHEN owners >= 3 OR repositories > 100 THEN 'copied' WHEN looks_live THEN 'live' ELSE 'weak' END AS standing FROM held
), spans AS (
  SELECT doc_id, kind, start, stop, standing FROM kept JOIN standing USING (value) WHERE kind < 3
  UNION SELECT doc_id, 4, stop - len(value), stop, standing FROM kept JOIN standing USING (value) WHERE standing = 'live'
), listed AS (
  SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
    string_agg(['assign', 'access', 'hex'][kind + 1] || ':' || start || ':' || stop, ',' ORDER BY start, kind) FILTER (kind < 3) AS base,
    string_agg(['assign', 'access', 'hex', '', 'live'][kind + 1] || ':' || start || ':' || stop, ',' ORDER BY start, kind, stop) AS spans,
    count(*) FILTER (kind = 4) AS n_live, count(*) FILTER (kind < 3 AND standing = 'copied') AS n_copied
  FROM spans GROUP BY doc_id
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
  coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_copied, 0) AS n_copied
FROM documents LEFT JOIN listed USING (doc_id)
"""

SEARCH = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), sized AS (
  SELECT doc_id, terms, len(terms)::BIGINT AS n FROM words WHERE len(terms) > 0
), counts AS (
  SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS total FROM sized
), postings AS (
  SELECT doc_id, n, term, count(*)::BIGINT AS tf FROM (SELECT doc_id, n, unnest(terms) AS term FROM sized) GROUP BY doc_id, n, term
), weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM postings GROUP BY term), counts
), asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), scored AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // total))))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN postings USING (term), counts GROUP BY item_id, doc_id
), ranked AS (
  SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score FROM scored WHERE score > 0
)
SELECT * FROM ranked WHERE rank <= 10
"""

AUDIT = r"""
WITH texts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), said AS (
  SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id
), failing AS (
  SELECT doc_id, part, (len(words) < 200)::INT + 2 * (100 * list_unique(words) < 50 * len(words))::INT
    + 4 * (100 * len(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * len(text))::INT + 8 * regexp_matches(text, '[#$%&*|]')::INT
    + 16 * coalesce(min(doc_id) OVER (PARTITION BY text) < doc_id, false)::INT AS mask
  FROM texts
), cells AS (
  SELECT part, mask, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic FROM failing LEFT JOIN said USING (doc_id) GROUP BY part, mask
), letters AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter, unnest([1, 2, 4, 8, 16]) AS bit
), orders AS (
  SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM letters a, letters b, letters c, letters d, letters e WHERE (a.bit | b.bit | c.bit | d.bit | e.bit) = 31
), steps AS (
  SELECT filter_order, step::INT AS step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS before FROM orders, range(1, 6) s(step)
), taken AS (
  SELECT part, filter_order, step, bit,
    coalesce(sum(n) FILTER (mask & (before | bit) = 0), 0)::BIGINT AS kept, coalesce(sum(n) FILTER (mask & before = 0 AND mask & bit <> 0), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (mask & before <> 0 AND mask & bit <> 0), 0)::BIGINT AS redundant, coalesce(sum(n) FILTER (mask = bit), 0)::BIGINT AS unique_fails,
    coalesce(sum(good) FILTER (mask & before = 0 AND mask & bit <> 0), 0)::BIGINT AS good_lost,
    coalesce(sum(toxic) FILTER (mask & before = 0 AND mask & bit <> 0), 0)::BIGINT AS toxic_lost
  FROM cells, steps GROUP BY part, filter_order, step, bit, before
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM taken
"""


SHARDS = r"""
WITH RECURSIVE shards AS (
  SELECT k, 'shard-' || lpad(k::VARCHAR, 3, '0') AS name FROM range(64) r(k)
), orders AS (
  SELECT k, name, ('0x' || substr(md5('offset ' || name), 1, 13))::BIGINT % 6421 AS first, ('0x' || substr(md5('step ' || name), 1, 13))::BIGINT % 6420 + 1 AS step FROM shards
), turns AS (
  SELECT -1 AS turn, -1::BIGINT AS slot, bitstring('0', 6421) AS taken
  UNION ALL
  SELECT turn, slot, set_bit(taken, slot::INTEGER, 1) FROM (
    SELECT t.turn + 1 AS turn, t.taken, list_transform(list_filter(range(6421), lambda j: get_bit(t.taken, ((o.first + j * o.step) % 6421)::INTEGER) = 0)[1:1],
      lambda j: (o.first + j * o.step) % 6421)[1] AS slot
    FROM turns t JOIN orders o ON o.k = (t.turn + 1) % 64 WHERE t.turn < 6420
  )
), placed AS (
  SELECT slot, name AS shard FROM turns JOIN shards ON k = turn % 64 WHERE turn >= 0
)
SELECT doc_id, slot, shard FROM (SELECT doc_id, ('0x' || substr(md5(doc_id::VARCHAR), 1, 13))::BIGINT % 6421 AS slot FROM documents) JOIN placed USING (slot)
"""

NEAR_TEXTS = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(words[i:i + 4], ' ') AS shingle FROM (SELECT doc_id, words, unnest(range(1, greatest(2, len(words) - 3))) AS i FROM words WHERE len(words) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS (
  SELECT a, b FROM (SELECT l.doc_id AS a, r.doc_id AS b, count(*) AS shared FROM shingles l JOIN shingles r ON l.shingle = r.shingle AND l.doc_id <> r.doc_id GROUP BY 1, 2)
  JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * shared >= 85 * (x.n + y.n - shared)
), reached AS (
  SELECT doc_id, doc_id AS other FROM documents UNION SELECT reached.doc_id, links.b FROM reached JOIN links ON links.a = reached.other
), lowest AS (
  SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM lowest LEFT JOIN sizes USING (doc_id)
"""

NEAR_VECTORS = r"""
WITH RECURSIVE vectors AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings WHERE label IS NOT NULL
), sized AS (
  SELECT *, sqrt(list_dot_product(v, v)) AS size FROM vectors WHERE list_dot_product(v, v) > 0
), links AS (
  SELECT l.vec_id AS a, r.vec_id AS b FROM sized l JOIN sized r ON l.label = r.label AND l.vec_id <> r.vec_id WHERE list_dot_product(l.v, r.v) / (l.size * r.size) >= 0.98
), reached AS (
  SELECT vec_id, vec_id AS other FROM embeddings UNION SELECT reached.vec_id, links.b FROM reached JOIN links ON links.a = reached.other
), counted AS (
  SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a
)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM (SELECT vec_id, min(other) AS component_id FROM reached GROUP BY vec_id) LEFT JOIN counted USING (vec_id)
"""

TOP_SCORES = r"""
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score FROM vectors q JOIN vectors c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0
)
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank FROM scored
) WHERE rank <= 5
"""

SUBSTRINGS = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), windows AS (
  SELECT doc_id, i, md5(array_to_string(words[i:i + 34], ' ')) AS name FROM (SELECT doc_id, words, unnest(range(1, len(words) - 33)) AS i FROM words WHERE len(words) >= 35)
), repeated AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY name) AS n FROM windows) WHERE n > 1
), gone AS (
  SELECT DISTINCT doc_id, place FROM (SELECT doc_id, unnest(range(i, i + 35)) AS place FROM repeated)
), left_over AS (
  SELECT w.doc_id, w.place, w.word, g.place IS NOT NULL AS is_gone
  FROM (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM words) w LEFT JOIN gone g USING (doc_id, place)
), counted AS (
  SELECT doc_id, count(*) AS n_words, count(*) FILTER (is_gone) AS n_removed, coalesce(string_agg(word, ' ' ORDER BY place) FILTER (NOT is_gone), '') AS kept FROM left_over GROUP BY doc_id
)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM documents LEFT JOIN counted USING (doc_id)
"""

SQL: dict[str, str] = {
    "op1_sharding": SHARDS, "op2_minhash_near_dedup": NEAR_TEXTS, "op3_embedding_near_dedup": NEAR_VECTORS, "op5_mixing": MIXING, "op6_exact_top_k": TOP_SCORES,
    "op7_substring_dedup": SUBSTRINGS, "op9_line_dedup": LINES, "op11_secret_scans": SECRETS, "op12_lexical_search": SEARCH, "op13_filter_audit": AUDIT,
}
