"""DuckDB statements for the queries that SQL can express."""

from __future__ import annotations

ORACLES = {
    "op6_level_doubling": r"""
        WITH split AS (
            SELECT doc_id, list_filter(
                       regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'),
                       lambda w: w <> '') AS words
            FROM documents
        ), windows AS (
            SELECT doc_id, start,
                   sha256(array_to_string(words[start:start + 19], ' ')) AS words_of
            FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS start FROM split)
        ), later AS (
            SELECT doc_id, start
            FROM (SELECT doc_id, start,
                         first_value(doc_id) OVER same AS first_id,
                         first_value(start) OVER same AS first_start
                  FROM windows
                  WINDOW same AS (PARTITION BY words_of ORDER BY doc_id, start))
            WHERE (doc_id, start) <> (first_id, first_start)
        ), removed AS (
            SELECT DISTINCT doc_id, unnest(range(start, start + 20)) AS word FROM later
        ), gone AS (
            SELECT doc_id, list(word) AS gone FROM removed GROUP BY doc_id
        )
        SELECT split.doc_id, len(words)::BIGINT AS n_words,
               coalesce(len(gone), 0)::BIGINT AS n_removed,
               sha256(coalesce(array_to_string(
                   CASE WHEN gone IS NULL THEN words
                        ELSE list_filter(words, lambda w, i: NOT list_contains(gone, i)) END,
                   ' '), '')) AS kept_sha256
        FROM split LEFT JOIN gone USING (doc_id)
    """,
    "op8_suffix_array_search": r"""
        WITH doc AS (
            SELECT doc_id, list_filter(regexp_split_to_array(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                 'abcdefghijklmnopqrstuvwxyz'),
                       '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words
            FROM documents
        ), item AS (
            SELECT item_id::VARCHAR AS item_id, list_filter(regexp_split_to_array(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                 'abcdefghijklmnopqrstuvwxyz'),
                       '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words
            FROM benchmark
        ), passage AS (
            SELECT DISTINCT item_id, least(len(words), 10) AS size,
                   array_to_string(words[start:start + least(len(words), 10) - 1], ' ') AS key
            FROM (SELECT item_id, words,
                         unnest(range(1, len(words) - least(len(words), 10) + 2)) AS start
                  FROM item WHERE len(words) > 0)
        ), place AS (
            SELECT doc_id, start, size, array_to_string(words[start:start + size - 1], ' ') AS key
            FROM (SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS start
                  FROM doc, (SELECT DISTINCT size FROM passage))
        ), hit AS (
            SELECT doc_id, start, size, item_id FROM place JOIN passage USING (size, key)
        ), words_hit AS (
            SELECT doc_id, count(*) AS n_hit
            FROM (SELECT DISTINCT doc_id, unnest(range(start, start + size)) AS word FROM hit)
            GROUP BY doc_id
        ), items_hit AS (
            SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
            FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id
        )
        SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
               coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
               n_hit IS NOT NULL AS contaminated
        FROM doc LEFT JOIN words_hit USING (doc_id) LEFT JOIN items_hit USING (doc_id)
    """,
    "op9_digest_run_dedup": r"""
        WITH digests AS (
            SELECT doc_id,
                   sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g'))
                       AS text_sha256
            FROM documents
        ), keepers AS (
            SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size
            FROM digests GROUP BY text_sha256
        )
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
        FROM digests JOIN keepers USING (text_sha256)
    """,
    "op12_two_bloom_lines": r"""
        WITH split AS (
            SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
        ), line AS (
            SELECT doc_id, number, lines[number] AS line,
                   translate(regexp_replace(lines[number],
                                            '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
            FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS number FROM split)
        ), repeated AS (
            SELECT key FROM line WHERE length(key) >= 1
            GROUP BY key HAVING count(DISTINCT doc_id) >= 10
        )
        SELECT doc_id, count(*) AS n_lines,
               count(*) FILTER (repeated.key IS NOT NULL) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY number)
                               FILTER (repeated.key IS NULL), '')) AS kept_sha256
        FROM line LEFT JOIN repeated USING (key) GROUP BY doc_id
    """,
    "op13_quotient_filters": r"""
        WITH piece AS (
            SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'),
                                     lambda w: w <> '') AS words
            FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                       'abcdefghijklmnopqrstuvwxyz'),
                             '[.,;:!?\x0A-\x0D]')) AS piece
                  FROM documents)
        ), counts AS (
            SELECT lang, size, words[start:start + size - 1] AS phrase, count(*) AS f
            FROM (SELECT lang, words, size, unnest(range(1, len(words) - size + 2)) AS start
                  FROM piece, (VALUES (1), (2), (3)) AS sizes(size))
            GROUP BY ALL
        ), totals AS (
            SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE size = 1 GROUP BY lang
        ), candidate AS (
            SELECT lang, size, phrase, f AS a FROM counts WHERE size >= 2 AND f >= 10
        ), scored AS (
            SELECT c.lang, c.size, c.phrase, c.a, k, l.f AS l, r.f AS r,
                   ((1000000::HUGEINT * c.a * c.a) // (l.f::HUGEINT * r.f))::BIGINT AS score
            FROM (SELECT *, unnest(range(1, size)) AS k FROM candidate) c
            JOIN counts l ON l.lang = c.lang AND l.phrase = c.phrase[1:k]
            JOIN counts r ON r.lang = c.lang AND r.phrase = c.phrase[k + 1:c.size]
            QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, k) = 1
        ), covered AS (
            SELECT lang, part, max(a) AS a
            FROM (SELECT lang, unnest([phrase[1:2], phrase[2:3]]) AS part, a
                  FROM candidate WHERE size = 3)
            GROUP BY lang, part
        ), ranked AS (
            SELECT s.lang, array_to_string(s.phrase, ' ') AS phrase, s.a, s.l, s.r, s.score
            FROM scored s LEFT JOIN covered c ON c.lang = s.lang AND c.part = s.phrase
            WHERE c.a IS NULL OR 100 * c.a < 50 * s.a
        )
        SELECT lang, row_number() OVER (PARTITION BY lang
                                        ORDER BY score DESC, a DESC, phrase) AS rank,
               phrase, a, l, r, n, score
        FROM ranked JOIN totals USING (lang)
        QUALIFY rank <= 2000
    """,
}
