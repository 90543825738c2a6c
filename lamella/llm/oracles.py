"""SQL that corpus queries are compared with (DuckDB)."""

#: crc32 of a text of ASCII characters: bytes are folded in one by one, bits are shifted out one by one.
_CRC32 = """
    xor(list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(string_split({text}, ''), lambda ch: ascii(ch)::BIGINT)),
        lambda crc, byte: list_reduce(
            list_prepend(xor(crc, byte), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
            lambda v, s: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END)
    ), 4294967295)"""

PREFIX_TRIE = f"""
WITH turns AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS pos
    FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
    SELECT conv_id, conv_id - conv_id % 20 AS base, {_CRC32.format(text="conv_id::VARCHAR")} % 4 AS taken
    FROM (SELECT DISTINCT conv_id FROM turns)
), rebuilt AS (
    SELECT c.conv_id, t.pos, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.base AND t.pos < c.taken
    UNION ALL
    SELECT c.conv_id, t.pos, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.pos >= c.taken
), sequences AS (
    SELECT c.conv_id, coalesce(s.turns, []) AS turns
    FROM convs c LEFT JOIN (
        SELECT conv_id, list(sha256(length(role)::VARCHAR || ':' || role || text) ORDER BY pos) AS turns FROM rebuilt GROUP BY conv_id
    ) s USING (conv_id)
), words AS (
    SELECT DISTINCT sha256(length(role)::VARCHAR || ':' || role || text) AS turn,
           len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS words
    FROM rebuilt
), members AS (
    SELECT conv_id, len(turns) AS turns, d AS depth, turns[1:d] AS path
    FROM (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS d FROM sequences)
), nodes AS (
    SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
           sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE turns = depth), '')) AS ends_sha256
    FROM members GROUP BY path, depth
), costed AS (
    SELECT n.path, n.depth, n.conv_id, n.n_convs, n.ends_sha256, (n.n_convs - 1) * coalesce(w.words, 0) AS saved,
           (SELECT count(*) FROM nodes k WHERE k.depth = n.depth + 1 AND k.path[1:n.depth] = n.path) AS n_children
    FROM nodes n LEFT JOIN words w ON n.depth > 0 AND w.turn = n.path[n.depth]
), below AS (
    SELECT path[1:d] AS path, d AS depth, sum((n_children = 0)::INT) AS n_leaves, sum(saved) AS saved_tokens
    FROM (SELECT path, n_children, saved, unnest(range(0, depth + 1)) AS d FROM costed) GROUP BY 1, 2
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, b.n_leaves::BIGINT AS n_leaves,
       b.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM costed n JOIN below b ON b.depth = n.depth AND b.path = n.path
LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.path = n.path[1:n.depth - 1]
"""

#: Written for the markup of the given pages, whose articles hold headings, paragraphs, bold type and line breaks only.
MAIN_TEXT = r"""
WITH cut AS (
    SELECT page_id, url, regexp_split_to_array(
        regexp_replace(regexp_replace(regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)(</article>|$)', 1), '</?b>', '', 'g'), '<br>', ' ', 'g'),
        '</?(p|h1)>') AS parts
    FROM pages
), decoded AS (
    SELECT page_id, url, list_transform(parts, lambda x: trim(regexp_replace(
        regexp_replace(replace(replace(replace(x, '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&amp;?', '&', 'g'), '\s+', ' ', 'g'))) AS parts
    FROM cut
), texts AS (
    SELECT page_id, url, array_to_string(list_filter(parts, lambda x: x <> ''), chr(10)) AS text FROM decoded
)
SELECT page_id, url, text, length(text)::BIGINT AS n_chars FROM texts
"""

#: Sets of three-word shingles, links of 90 % and what they reach.
NGRAM_GROUPS = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ') || ' ' || len(w)]
        ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS grams
    FROM words
), classes AS (
    SELECT list_sort(grams) AS grams, min(doc_id) AS rep, len(any_value(grams)) AS n FROM sets WHERE len(grams) > 0 GROUP BY 1
), postings AS (
    SELECT rep, n, unnest(grams) AS gram FROM classes
), links AS (
    SELECT a.rep AS a, b.rep AS b FROM postings a JOIN postings b ON a.gram = b.gram AND a.rep < b.rep AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
    GROUP BY a.rep, b.rep HAVING 100 * count(*) >= 90 * (min(a.n) + min(b.n) - count(*))
), reach(node, seen) AS (
    SELECT rep, rep FROM classes
    UNION SELECT r.node, e.b FROM reach r JOIN (SELECT a, b FROM links UNION ALL SELECT b, a FROM links) e ON r.seen = e.a
), labels AS (
    SELECT node, min(seen) AS component_id FROM reach GROUP BY node
)
SELECT s.doc_id, len(s.grams)::BIGINT AS n_shingles, coalesce(l.component_id, s.doc_id) AS component_id
FROM sets s LEFT JOIN classes c ON len(s.grams) > 0 AND c.grams = list_sort(s.grams) LEFT JOIN labels l ON l.node = c.rep
"""

#: Turns, what is learnt of them, and the length of the template with its escapes; conversation -7 is added.
CHAT_FORMAT = r"""
WITH own AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), turns AS (
    SELECT *, row_number() OVER w AS pos, lag(role) OVER w IS NOT DISTINCT FROM role AS goes_on,
           replace(replace(text, '\', '\\'), '<|', '<\|') AS body,
           replace(replace(replace(role, '\', '\\'), '<|', '<\|'), chr(10), '\n') AS head
    FROM own WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length(body) + CASE WHEN goes_on THEN length('<|next|>') ELSE length('<|start|>') + length(head) + 1 + length('<|end|>') + 1 END)::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id
"""
