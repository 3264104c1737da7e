"""SQL for the text queries that SQL can express, from the definition of their results."""

from __future__ import annotations

MIXING = r"""
WITH sized AS (
  SELECT doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5(concat_ws('|', coalesce(doc_id::VARCHAR, ''), md5(coalesce(text, '')))) AS digest
  FROM documents),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id, source, size, digest) AS copy FROM sized),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, (2 * sum(size))::DOUBLE AS most,
         ([3, 1, 2])[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight
  FROM sized GROUP BY source),
levelled AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(most) OVER fuller, 0))
            / (sum(weight) OVER () - coalesce(sum(weight) OVER fuller, 0)) AS level
  FROM sources
  WINDOW fuller AS (ORDER BY most / weight, source NULLS LAST
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
reached AS (
  SELECT level FROM levelled WHERE most > weight * level
  ORDER BY most / weight, source NULLS LAST LIMIT 1),
targets AS (
  SELECT source, source_size,
         least(most, coalesce(weight * (SELECT level FROM reached), most)) AS target
  FROM levelled),
queued AS (
  SELECT n.*, source_size, target,
         sum(size) OVER (PARTITION BY n.source ORDER BY digest, doc_id, copy
                         ROWS UNBOUNDED PRECEDING) AS upto
  FROM numbered n JOIN targets t ON n.source IS NOT DISTINCT FROM t.source),
turns AS (
  SELECT *, CASE WHEN target > 0 THEN (turn * source_size + upto)::DOUBLE / target
                 ELSE 0 END AS finish
  FROM (SELECT *, unnest([0, 1]) AS turn FROM queued)),
cut AS (
  SELECT *, sum(size) OVER (ORDER BY finish, source NULLS LAST, digest, doc_id, copy, turn
                            ROWS UNBOUNDED PRECEDING)
            <= (SELECT sum(target) FROM targets) AS within
  FROM turns)
SELECT doc_id, size, first(source_size) AS source_size, first(target) AS target,
       sum(CASE WHEN within THEN size ELSE 0 END)::BIGINT AS taken
FROM cut GROUP BY doc_id, source, size, digest, copy
"""

QUALITY = r"""
WITH split AS (
  SELECT doc_id, row_number() OVER () AS row_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda line: regexp_matches(line, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
windows AS (
  SELECT row_id, i, words[i:i + 4] AS gram
  FROM (SELECT row_id, words, unnest(range(1, len(words) - 3)) AS i FROM split)),
counted AS (SELECT *, count(*) OVER (PARTITION BY row_id, gram) AS n FROM windows),
covered AS (
  SELECT row_id, count(DISTINCT place) AS n
  FROM (SELECT row_id, unnest(range(i, i + 5)) AS place FROM counted WHERE n > 1)
  GROUP BY row_id),
measured AS (
  SELECT s.doc_id, len(words)::BIGINT AS n_words,
         coalesce(list_sum([length(w) for w in words]), 0)::BIGINT AS word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(c.n, 0)::BIGINT AS n_repeat_words, len(lines) AS n_lines,
         len(list_filter(words, lambda w:
             regexp_matches(w, '[^\x00-\x40\x5B-\x60\x7B-\x7F]'))) AS n_letter_words,
         len(list_filter(lines, lambda line:
             regexp_matches(line, '(\.\.\.|…)[\x20\x09-\x0D]*\z'))) AS n_cut_lines,
         len(list_filter(lines, lambda line:
             regexp_matches(line, '\A[\x20\x09-\x0D]*[-*•]'))) AS n_bullet_lines
  FROM split s LEFT JOIN covered c USING (row_id)),
judged AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > 3 * n_words OR 10 * n_dup_lines > 7 * n_lines
            OR word_chars < 2 * n_words OR word_chars > 20 * n_words
            OR 2 * n_letter_words < n_words
            OR (n_cut_lines > 1 AND 10 * n_cut_lines > 3 * n_lines)
            OR (n_bullet_lines > 1 AND 10 * n_bullet_lines > 9 * n_lines)) AS kept
FROM judged
"""

# Every word of a repeated window, by its place; windows are lists of words.
SUBSTRINGS = r"""
WITH split AS (
  SELECT doc_id, row_number() OVER () AS row_id,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
windows AS (
  SELECT row_id, i, md5(array_to_string(words[i:i + 34], ' ')) AS digest
  FROM (SELECT row_id, words, unnest(range(1, len(words) - 33)) AS i FROM split)),
repeated AS (
  SELECT row_id, i FROM (SELECT *, count(*) OVER (PARTITION BY digest) AS n FROM windows)
  WHERE n > 1),
gone AS (
  SELECT row_id, list(DISTINCT place) AS places
  FROM (SELECT row_id, unnest(range(i, i + 35)) AS place FROM repeated) GROUP BY row_id),
numbered AS (SELECT row_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM split),
kept AS (
  SELECT n.row_id, string_agg(word, ' ' ORDER BY place) AS text, count(*) AS n
  FROM numbered n LEFT JOIN gone g USING (row_id)
  WHERE NOT coalesce(list_contains(g.places, place), false) GROUP BY n.row_id)
SELECT doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(k.n, 0))::BIGINT AS n_removed,
       sha256(coalesce(k.text, '')) AS kept_sha256
FROM split LEFT JOIN kept k USING (row_id)
"""

NEAREST = """
WITH usable AS (
  SELECT vec_id, embedding::DOUBLE[] AS vec, row_number() OVER () AS place FROM embeddings
  WHERE vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    AND len(list_filter(embedding, lambda x: isfinite(x))) = len(embedding)),
measured AS (
  SELECT q.place, q.vec_id AS query_id, c.vec_id,
         sqrt(list_reduce([(q.vec[i] - c.vec[i]) * (q.vec[i] - c.vec[i])
                           for i in range(1, len(q.vec) + 1)], lambda a, b: a + b)) AS score
  FROM usable q JOIN usable c ON q.place <> c.place AND len(q.vec) = len(c.vec)
  WHERE q.vec_id % 100 = 0)
SELECT query_id, rank::INT AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY place ORDER BY score, vec_id) AS rank FROM measured)
WHERE rank <= 10
"""

RANKED_SEARCH = r"""
WITH split AS (
  SELECT row_number() OVER () AS place, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                      'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
totals AS (SELECT count(*)::BIGINT AS n, sum(len(terms))::BIGINT AS l FROM split WHERE len(terms) > 0),
counted AS (
  SELECT place, any_value(doc_id) AS doc_id, term, count(*)::BIGINT AS tf, any_value(size) AS size
  FROM (SELECT place, doc_id, len(terms)::BIGINT AS size, unnest(terms) AS term FROM split)
  GROUP BY place, term),
wanted AS (
  SELECT DISTINCT item, item_id, term FROM (
    SELECT row_number() OVER () AS item, item_id,
           unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                               'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark)),
weighed AS (
  SELECT term, floor(1000 * ln((2 * n + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
  FROM (SELECT term, count(*)::BIGINT AS df FROM counted
        WHERE term IN (SELECT term FROM wanted) GROUP BY term), totals),
scored AS (
  SELECT item, item_id, place, doc_id,
         sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * size * n) // l))))::BIGINT
           AS score
  FROM wanted JOIN counted USING (term) JOIN weighed USING (term), totals
  GROUP BY item, item_id, place, doc_id)
SELECT item_id, rank::INT AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank
      FROM scored WHERE score > 0)
WHERE rank <= 10
"""

HARD_NEGATIVES = """
WITH usable AS (
  SELECT row_number() OVER () AS place, vec_id,
         CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS vec
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: isfinite(x))) = len(embedding)),
measured AS (
  SELECT a.place AS anchor, a.vec_id AS anchor_id, c.place, c.vec_id, a.label = c.label AS alike,
         coalesce(list_sum([a.vec[i] * c.vec[i] for i in range(1, len(a.vec) + 1)]), 0)::BIGINT
           AS score
  FROM usable a JOIN usable c ON a.place <> c.place AND len(a.vec) = len(c.vec)
  WHERE a.vec_id % 50 = 0),
positives AS (
  SELECT anchor, place, vec_id AS positive_id, score AS positive_score
  FROM (SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id) AS rank
        FROM measured WHERE alike)
  WHERE rank <= 5)
SELECT anchor_id, positive_id, rank::INT AS rank, negative_id, positive_score, negative_score
FROM (SELECT m.anchor_id, positive_id, m.vec_id AS negative_id, positive_score,
             m.score AS negative_score,
             row_number() OVER (PARTITION BY anchor, p.place ORDER BY m.score DESC, m.vec_id) AS rank
      FROM positives p JOIN measured m USING (anchor)
      WHERE NOT m.alike AND 50 * positive_score <= 100 * m.score
        AND 100 * m.score <= 95 * positive_score)
WHERE rank <= 3
"""
