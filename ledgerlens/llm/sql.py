"""DuckDB twins of the queries that SQL can express."""

from __future__ import annotations

OP1 = r"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents
), w AS (
    SELECT r, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d
), starts AS (
    SELECT r, ws, unnest(range(1, len(ws) - 3)) AS i FROM w
), windows AS (
    SELECT r, i, count(*) OVER (PARTITION BY r, ws[i:i + 4]) AS n FROM starts
), covered AS (
    SELECT r, count(DISTINCT p) AS n_repeat_words
    FROM (SELECT r, unnest(range(i, i + 5)) AS p FROM windows WHERE n > 1) GROUP BY r
), lines AS (
    SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
    FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d)
    WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r
), m AS (
    SELECT doc_id, len(ws)::BIGINT AS n_words,
           length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
           (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
           coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
           coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
           coalesce(n_lines, 0)::BIGINT AS n_lines,
           (length(t) - length(regexp_replace(t, '[0-9]', '', 'g')))::BIGINT AS n_digits
    FROM w LEFT JOIN covered USING (r) LEFT JOIN lines USING (r)
), f AS (
    SELECT *, ((n_words < 10)::INT + 2 * (100 * n_repeat_words > 20 * n_words)::INT
               + 4 * (10 * n_symbols > n_words)::INT + 8 * (100 * n_dup_lines > 50 * n_lines)::INT
               + 16 * (word_chars < 2 * n_words)::INT + 32 * (word_chars > 15 * n_words)::INT
               + 64 * (100 * n_digits > 50 * word_chars)::INT)::BIGINT AS failed FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (failed & 3) != 0 AS base_failed, failed = 0 AS kept, n_lines, n_digits, failed FROM f
"""

OP6 = r"""
WITH p AS (
    SELECT page_id, coalesce(url, 'about:blank') AS url, strlen(coalesce(html, ''))::BIGINT AS payload_bytes,
           sha1(coalesce(html, '')) AS payload_digest FROM pages
), m AS (
    SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) END AS top FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN top > page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN top > page_id THEN top END AS refers_to, url FROM m
"""

OP7 = r"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), words AS (
    SELECT r, len(ws) AS n, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS i FROM d
), grams AS (
    SELECT r, n, i, w, lag(w) OVER own || ' ' || w AS b, lag(w, 2) OVER own || ' ' || lag(w) OVER own || ' ' || w AS t
    FROM words WINDOW own AS (PARTITION BY r ORDER BY i)
), counts AS (
    SELECT r, i, (SELECT count(*) FROM words) - n AS e0,
           count(*) OVER (PARTITION BY w) - count(*) OVER (PARTITION BY r, w) AS e1,
           CASE WHEN b IS NOT NULL THEN count(*) OVER (PARTITION BY b) - count(*) OVER (PARTITION BY r, b) ELSE 0 END AS e2,
           CASE WHEN t IS NOT NULL THEN count(*) OVER (PARTITION BY t) - count(*) OVER (PARTITION BY r, t) ELSE 0 END AS e3
    FROM grams
), contexts AS (
    SELECT *, lag(e1) OVER own AS c1, lag(e2) OVER own AS c2, least(3, i) AS most
    FROM counts WINDOW own AS (PARTITION BY r ORDER BY i)
), scores AS (
    SELECT r, CASE WHEN e3 > 0 THEN 3 WHEN e2 > 0 THEN 2 WHEN e1 > 0 THEN 1 ELSE 0 END AS k,
           CASE WHEN e3 > 0 THEN ln(e3 / c2) WHEN e2 > 0 THEN ln(e2 / c1) + (most - 2) * ln(0.4)
                WHEN e1 > 0 THEN ln(e1 / e0) + (most - 1) * ln(0.4)
                ELSE most * ln(0.4) - ln(greatest(e0, 1)) END AS s FROM contexts
), sums AS (
    SELECT r, fsum(s) AS s, count(*) FILTER (k = 0) AS n0, count(*) FILTER (k = 1) AS n1,
           count(*) FILTER (k = 2) AS n2, count(*) FILTER (k = 3) AS n3 FROM scores GROUP BY r
)
SELECT doc_id, len(ws)::BIGINT AS n_words, round(coalesce(s, 0), 6) AS log_score,
       round(s / nullif(len(ws), 0), 6) AS mean_log_score, coalesce(n0, 0) AS n_unseen,
       coalesce(n1, 0) AS n_order1, coalesce(n2, 0) AS n_order2, coalesce(n3, 0) AS n_order3
FROM d LEFT JOIN sums USING (r)
"""

OP10 = r"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
), items AS (
    SELECT coalesce(item_id::VARCHAR, '') AS item,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark
), windows AS (
    SELECT DISTINCT item, size, array_to_string(ws[i:i + size - 1], ' ') AS win
    FROM (SELECT item, ws, least(len(ws), 10) AS size, unnest(range(1, len(ws) - least(len(ws), 10) + 2)) AS i
          FROM items WHERE len(ws) > 0)
), starts AS (
    SELECT r, ws, size, unnest(range(1, len(ws) - size + 2)) AS i
    FROM d, (SELECT DISTINCT size FROM windows)
), hits AS (
    SELECT r, i, s.size, item FROM starts s JOIN windows w
    ON s.size = w.size AND array_to_string(ws[i:i + s.size - 1], ' ') = win
), words AS (
    SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + size)) AS p FROM hits) GROUP BY r
), named AS (
    SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
    FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r
)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN named USING (r)
"""

_UPPER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def _crc32(text: str) -> str:
    """The unsigned CRC-32 of a text's UTF-8 bytes, bit by bit."""
    code = f"hex(encode({text}))"
    digit = "instr('0123456789ABCDEF', {0}[{1}]) - 1"
    byte = f"(16 * ({digit.format(code, '2 * p - 1')}) + {digit.format(code, '2 * p')})::BIGINT"
    octets = f"list_transform(range(1, strlen({text}) + 1), lambda p: {byte})"
    turn = "list_reduce([xor(c, o), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))"
    step = f"xor(c >> 8, {turn.replace('xor(c, o)', 'xor(c, o) & 255')})"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {octets}), lambda c, o: {step}), 4294967295)"


def _tree(name: str, levels: int) -> str:
    """Tables ``{name}0`` (tree, rank, h, c) up to the top; ``{name}s{k}`` adds a node's siblings."""
    parts = []
    for k in range(levels):
        run = f"PARTITION BY tree, rank // 8 ORDER BY rank ROWS BETWEEN"
        parts.append(f"""{name}s{k} AS (
    SELECT *, coalesce(string_agg(h, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
           coalesce(string_agg(h, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {name}{k}
), {name}{k + 1} AS (
    SELECT tree, rank // 8 AS rank, count(*) OVER (PARTITION BY tree) AS c,
           CASE WHEN any_value(c) > 1 THEN sha256(string_agg(h, '' ORDER BY rank)) ELSE any_value(h) END AS h
    FROM {name}{k} GROUP BY tree, rank // 8
)""")
    return ", ".join(parts)


def _climb(name: str, levels: int, start: str, rank: str, tree: str, keep: str) -> str:
    """Folds ``f`` and gathers ``p`` from the table ``start`` up the levels of a tree."""
    parts, now = [], start
    for k in range(levels):
        parts.append(f"""{name}f{k} AS (
    SELECT {keep}, p || l || r AS p, CASE WHEN c > 1 THEN sha256(l || f || r) ELSE f END AS f
    FROM {now} JOIN {name}s{k} s ON s.tree = {now}.{tree} AND s.rank = {now}.{rank} // {8**k}
)""")
        now = f"{name}f{k}"
    return ", ".join(parts)


#: Up to 8^5 documents of a language and 8^2 languages.
OP11 = f"""
WITH d AS (
    SELECT row_number() OVER () AS id, doc_id, coalesce('=' || lang, '') AS name, text,
           concat(coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-'),
                  coalesce(strlen(source) || ':' || source, '-'), coalesce(strlen(lang) || ':' || lang, '-'),
                  coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-')) AS head,
           coalesce({_crc32("doc_id::VARCHAR")} % 3 = 0, false) AS chosen FROM documents
), hashed AS (
    SELECT id, doc_id, name, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
           CASE WHEN chosen THEN sha256(head || coalesce(strlen(text) || ':' || translate(text, {_UPPER}), '-'))
                END AS tampered FROM d
), leaves AS (
    SELECT *, row_number() OVER (PARTITION BY name ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM hashed
), a0 AS (
    SELECT name AS tree, place AS rank, leaf AS h, count(*) OVER (PARTITION BY name) AS c FROM leaves
), {_tree("a", 5)}, b0 AS (
    SELECT '' AS tree, row_number() OVER (ORDER BY tree) - 1 AS rank, h, count(*) OVER () AS c, tree AS name FROM a5
), {_tree("b", 2)}, start AS (
    SELECT id, doc_id, leaf, name, place, '' AS p, coalesce(tampered, leaf) AS f FROM leaves
), {_climb("a", 5, "start", "place", "name", "id, doc_id, leaf, name, place")}, middle AS (
    SELECT id, doc_id, leaf, p, f, b0.rank AS place, b0.tree AS top, b0.h AS subroot
    FROM af4 JOIN b0 ON b0.name = af4.name
), {_climb("b", 2, "middle", "place", "top", "id, doc_id, leaf, subroot, place, top")}
SELECT doc_id, leaf, subroot, b2.h AS root, sha256(p) AS proof_sha256, f AS folded_root, f = b2.h AS verified
FROM bf1, b2
"""

OP12 = f"""
WITH RECURSIVE runs AS (
    SELECT coalesce(doc_id::VARCHAR, '') || ':' || run AS named, run, count(*) AS n
    FROM (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), {_UPPER}),
              '[A-Za-z\u00C0-\u00FF]+')) AS run FROM documents) GROUP BY ALL
), hashed AS (
    SELECT run, n, {_crc32("named")} AS h FROM runs
), kept AS (
    SELECT CASE WHEN h % 97 = 0 THEN run[1:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, n
    FROM hashed
), words AS (
    SELECT word, sum(n)::BIGINT AS n FROM kept WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), cut AS (
    SELECT word, n, i, word[1:i] || word[i + 2:] AS rest
    FROM (SELECT *, unnest(range(0, length(word))) AS i FROM words)
), near AS (
    SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM cut a JOIN cut b USING (i, rest) WHERE a.word <> b.word
    UNION SELECT a.word, a.n, b.word, b.n FROM words a JOIN cut b ON b.rest = a.word
    UNION SELECT b.word, b.n, a.word, a.n FROM words a JOIN cut b ON b.rest = a.word
), counts AS (
    SELECT word, count(*) AS n_near FROM near GROUP BY word
), best AS (
    SELECT word, other AS form, other_n AS form_n,
           row_number() OVER (PARTITION BY word ORDER BY other_n DESC, encode(other)) AS place
    FROM near WHERE other_n >= 2 * n
), forms AS (
    SELECT word, form, form_n FROM best WHERE place = 1
), ways AS (
    SELECT word, word AS last FROM words
    UNION ALL SELECT w.word, f.form FROM ways w JOIN forms f ON f.word = w.last
), ends AS (
    SELECT w.word, w.last AS root FROM ways w WHERE w.last NOT IN (SELECT word FROM forms)
)
SELECT word, form, root, n, coalesce(n_near, 0) AS n_near, form_n
FROM words LEFT JOIN forms USING (word) LEFT JOIN counts USING (word) JOIN ends USING (word)
"""

#: The given pages hold their main text in one article element of headings and paragraphs.
OP13 = r"""
WITH a AS (
    SELECT page_id, url, regexp_replace(regexp_extract(coalesce(html, ''), '<article>(.*?)</article>', 1, 's'),
                                        '\s+', ' ', 'g') AS inside FROM pages
), b AS (
    SELECT page_id, url, regexp_replace(regexp_replace(regexp_replace(inside,
               '</?(p|h1)>', chr(10), 'g'), '<br>', ' ', 'g'), '<[^>]*>', '', 'g') AS lines FROM a
), c AS (
    SELECT page_id, url, replace(replace(replace(replace(lines, '&quot;', '"'), '&lt;', '<'), '&gt;', '>'),
                                 '&#x27;', chr(39)) AS lines FROM b
), d AS (
    SELECT page_id, url, array_to_string(list_filter(list_transform(string_split(regexp_replace(lines, '&amp;?', '&', 'g'),
               chr(10)), lambda x: trim(x)), lambda x: x <> ''), chr(10)) AS text FROM c
)
SELECT page_id, url, text, length(text)::BIGINT AS n_chars FROM d
"""

ORACLES = {"op1_quality": OP1, "op6_warc": OP6, "op7_lm": OP7, "op10_decontaminate": OP10, "op11_manifest": OP11, "op12_spelling": OP12, "op13_extraction": OP13}
