"""DuckDB forms of the queries that SQL can express on whole tables."""

FILTER_AUDIT = r"""
WITH texts AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
words AS (
    SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY text) AS least FROM texts),
labelled AS (
    SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
    FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
failing AS (
    SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
        [len(words) < 100, 100 * list_unique(words) < 80 * len(words),
         100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text),
         regexp_matches(text, '[#$%&*|]'), coalesce(words.doc_id > least, false)] AS fails
    FROM words LEFT JOIN labelled ON words.doc_id = labelled.doc_id),
counts AS (
    SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM failing GROUP BY part, fails),
letters(letter, i) AS (VALUES ('A', 1), ('B', 2), ('C', 3), ('D', 4), ('E', 5)),
orders AS (
    SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order, [a.i, b.i, c.i, d.i, e.i] AS places
    FROM letters a, letters b, letters c, letters d, letters e
    WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
firsts AS (
    SELECT part, filter_order, places, fails, n, good, toxic,
        coalesce(nullif(list_position(list_transform(places, lambda i: fails[i]), true), 0), 6) AS gone
    FROM counts, orders),
steps AS (
    SELECT part, filter_order, unnest([1, 2, 3, 4, 5]) AS step, places, fails, n, good, toxic, gone FROM firsts),
sums AS (
    SELECT part, filter_order, step, places[step] AS filter,
        sum(CASE WHEN gone > step THEN n ELSE 0 END) AS kept,
        sum(CASE WHEN gone = step THEN n ELSE 0 END) AS removed,
        sum(CASE WHEN gone < step AND fails[places[step]] THEN n ELSE 0 END) AS redundant,
        sum(CASE WHEN fails[places[step]] AND len(list_filter(fails, lambda x: x)) = 1 THEN n ELSE 0 END) AS unique_fails,
        sum(CASE WHEN gone = step THEN good ELSE 0 END) AS good_lost,
        sum(CASE WHEN gone = step THEN toxic ELSE 0 END) AS toxic_lost
    FROM steps GROUP BY part, filter_order, step, places[step])
SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
    unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
    (sum(removed) OVER (PARTITION BY part, filter))::BIGINT AS shapley
FROM sums
"""

LEXICAL_SEARCH = r"""
WITH docs AS (
    SELECT row_number() OVER () AS row, doc_id,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents),
items AS (
    SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark),
wanted AS (SELECT item_id, term, count(*) AS times FROM items GROUP BY item_id, term),
corpus AS (SELECT count(*) FILTER (WHERE len(terms) > 0) AS n_docs, sum(len(terms))::BIGINT AS length FROM docs),
each AS (SELECT row, doc_id, len(terms) AS n, unnest(terms) AS term FROM docs),
postings AS (
    SELECT row, doc_id, n, term, count(*) AS tf FROM each
    WHERE term IN (SELECT term FROM wanted) GROUP BY row, doc_id, n, term),
weights AS (
    SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS w
    FROM (SELECT term, count(*) AS df FROM postings GROUP BY term), corpus),
scores AS (
    SELECT item_id, row, doc_id,
        sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * n_docs) // length))))::BIGINT AS score
    FROM wanted JOIN postings USING (term) JOIN weights USING (term), corpus
    GROUP BY item_id, row, doc_id)
SELECT item_id, rank::INTEGER AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
WHERE rank <= 20
"""
