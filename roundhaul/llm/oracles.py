"""The operators that SQL can express, written against the whole tables for an independent engine."""

from __future__ import annotations

import re

from roundhaul.llm import chat, mixing

#: What every control string starts with or is; none overlaps another, so matches can be counted.
CONTROL = re.sub(r"^\((\[.*?\])\)\(\?=(.*)\)$", r"\1(?:\2)", chat.CONTROL)

CHAT = rf"""
WITH given AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), sized AS (
  SELECT *, row_number() OVER turns AS place, count(*) OVER (PARTITION BY conv_id) AS n,
         length('{chat.START}') + length('{chat.END}') + 2
         + length(role) + length(role) - length(replace(replace(role, '\', ''), chr(10), ''))
         + length(text) + length(text) - length(replace(text, '\', ''))
         + len(regexp_extract_all(role, '{CONTROL}')) + len(regexp_extract_all(text, '{CONTROL}')) AS written
  FROM given WINDOW turns AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), summed AS (
  SELECT *, sum(written) OVER (PARTITION BY conv_id ORDER BY place) AS so_far FROM sized
), read AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY place) AS told,
         coalesce(string_agg(text, '' ORDER BY place) FILTER (WHERE role = '{chat.TRAINED_ROLE}'), '') AS loss,
         sum(so_far) FILTER (WHERE role = '{chat.TRAINED_ROLE}' OR place = n) AS formatted_chars
  FROM summed GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(told) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
       CAST(formatted_chars AS BIGINT) AS formatted_chars
FROM read"""

# Rows are numbered by id, so a component's smallest row has its smallest id. A path from it meets
# larger rows only, so smaller ones need not be followed.
VECTORS = """
WITH RECURSIVE usable AS (
  SELECT vec_id, label, embedding, CAST(embedding AS DOUBLE[]) AS v, row_number() OVER (ORDER BY vec_id) AS node
  FROM (SELECT DISTINCT vec_id, label, embedding FROM embeddings)
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0 AND list_count(embedding) = len(embedding)
    AND list_bool_and(list_transform(embedding, lambda x: isfinite(x)))
    AND list_bool_or(list_transform(embedding, lambda x: x <> 0))
), links AS (
  SELECT a.node AS a, b.node AS b FROM usable a JOIN usable b
    ON a.label = b.label AND len(a.v) = len(b.v) AND a.node <> b.node
  WHERE list_cosine_similarity(a.v, b.v) >= 0.98
), reached(node, root) AS (
  SELECT DISTINCT a, a FROM links
  UNION
  SELECT b, root FROM reached JOIN links ON a = node WHERE root < b
), found AS (SELECT node, min(root) AS root FROM reached GROUP BY node),
counted AS (SELECT a AS node, count(*) AS n FROM links GROUP BY a),
named AS (
  SELECT u.vec_id, u.label, u.embedding, n, r.vec_id AS root_id
  FROM usable u JOIN found USING (node) JOIN counted USING (node) JOIN usable r ON r.node = root
)
SELECT e.vec_id, coalesce(n, 0) AS n_links, coalesce(root_id, e.vec_id) AS component_id,
       coalesce(root_id = e.vec_id, true) AS kept
FROM embeddings e LEFT JOIN named ON named.vec_id = e.vec_id AND named.label = e.label AND named.embedding = e.embedding"""

DOCUMENTS = r"""
WITH RECURSIVE told AS (
  SELECT row_number() OVER (ORDER BY doc_id) AS node, doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x20\x09-\x0D]+') AS words
  FROM documents
), placed AS (
  SELECT node, len(words) AS n_words, unnest(words) AS word, generate_subscripts(words, 1) AS place FROM told
), runs AS (
  SELECT node, n_words, place, concat_ws(' ', word, lead(word, 1) OVER w, lead(word, 2) OVER w, lead(word, 3) OVER w) AS shingle
  FROM placed WINDOW w AS (PARTITION BY node ORDER BY place)
), held AS (
  SELECT DISTINCT node, shingle FROM runs WHERE place <= greatest(n_words - 3, 1)
), sizes AS (SELECT node, count(*) AS n FROM held GROUP BY node),
common AS (
  SELECT x.node AS a, y.node AS b, count(*) AS n
  FROM held x JOIN held y ON x.shingle = y.shingle AND x.node <> y.node GROUP BY ALL
), links AS (
  SELECT a, b FROM common c JOIN sizes x ON x.node = a JOIN sizes y ON y.node = b
  JOIN told s ON s.node = a JOIN told t ON t.node = b
  WHERE 100 * c.n >= 80 * (x.n + y.n - c.n) AND s.doc_id IS NOT NULL AND t.doc_id IS NOT NULL
), reached(node, root) AS (
  SELECT DISTINCT a, a FROM links
  UNION
  SELECT b, root FROM reached JOIN links ON a = node WHERE root < b
), found AS (SELECT node, min(root) AS root FROM reached GROUP BY node)
SELECT told.doc_id, coalesce(n, 0) AS n_shingles, coalesce(first.doc_id, told.doc_id) AS component_id,
       coalesce(first.doc_id = told.doc_id, true) AS kept
FROM told LEFT JOIN sizes USING (node) LEFT JOIN found USING (node) LEFT JOIN told first ON first.node = root"""

# Sources in the order in which growing shares would meet their limits: the first one whose share fits ends the rounds.
MIX = rf"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS s, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS w
  FROM sized GROUP BY source
), ordered AS (
  SELECT *, sum(s) OVER () AS wanted, sum(3 * s) OVER so_far - 3 * s AS held,
         sum(w) OVER () - sum(w) OVER so_far + w AS open
  FROM sources WINDOW so_far AS (ORDER BY 3 * s / w, source NULLS LAST ROWS UNBOUNDED PRECEDING)
), fits AS (
  SELECT wanted - held AS rest, open FROM ordered WHERE w * (wanted - held) <= 3 * s * open
  ORDER BY 3 * s / w, source NULLS LAST LIMIT 1
), targets AS (
  SELECT source, s, least(CAST(3 * s AS DOUBLE), CAST(w * rest AS DOUBLE) / CAST(open AS DOUBLE)) AS target FROM sources, fits
), rated AS (
  SELECT *, CASE WHEN s > 0 THEN least(target / s, 3.0) ELSE 0.0 END AS rate FROM targets
), drawn AS (
  SELECT doc_id, size, s, target, rate,
         CAST(CAST('0x' || substr(md5('mix {mixing.SEED}:' || doc_id), 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496.0 AS draw
  FROM sized JOIN rated ON sized.source IS NOT DISTINCT FROM rated.source
)
SELECT doc_id, size, s AS source_size, target,
       CAST(size * (floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM drawn"""

NEGATIVES = """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND list_count(embedding) = len(embedding)
    AND coalesce(list_bool_and(list_transform(embedding, lambda x: isfinite(x))), true)
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS vec_id, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM rows a JOIN rows b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER best AS INTEGER) AS rank, vec_id AS negative_id, positive_score,
       score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW best AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) QUALIFY rank <= 10"""

ORACLES = {
    "op1_near_duplicate_vectors": VECTORS,
    "op3_minhash_near_duplicates": DOCUMENTS,
    "op10_chat_examples": CHAT,
    "op11_mixed_sources": MIX,
    "op12_hard_negatives": NEGATIVES,
}
