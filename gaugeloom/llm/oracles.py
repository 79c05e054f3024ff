"""The queries that SQL can express, in DuckDB's dialect, over whole tables."""

from __future__ import annotations

_SPACE = r"[\x20\x09-\x0D]"

LINES = rf"""
WITH lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
    FROM documents
), keys AS (
    SELECT *, translate(regexp_replace(line, '^{_SPACE}+|{_SPACE}+$', '', 'g'),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines
), common AS (
    SELECT key, max(doc_id) AS keeper FROM keys WHERE length(key) >= 20
    GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), marked AS (
    SELECT k.doc_id, k.line, k.place, c.key IS NOT NULL AND k.doc_id < c.keeper AS dropped
    FROM keys k LEFT JOIN common c ON k.key = c.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

SUBSTRINGS = """
WITH bytes AS (
    SELECT doc_id, hex(encode(coalesce(text, ''))) AS body,
           octet_length(encode(coalesce(text, ''))) AS n FROM documents
), windows AS (
    SELECT doc_id, place, md5_number(substr(body, (2 * place + 1)::BIGINT, 800)) AS gram
    FROM bytes, unnest(range(n - 399)) AS t(place) WHERE n >= 400
), starts AS (
    SELECT doc_id, place FROM windows
    WHERE gram IN (SELECT gram FROM windows GROUP BY gram HAVING count(*) > 1)
), steps AS (
    SELECT doc_id, place, lag(place) OVER (PARTITION BY doc_id ORDER BY place) AS before FROM starts
), marked AS (
    SELECT doc_id, place,
           sum(CASE WHEN before IS NULL OR place > before + 400 THEN 1 ELSE 0 END)
               OVER (PARTITION BY doc_id ORDER BY place) AS run FROM steps
), runs AS (
    SELECT doc_id, run, min(place) AS low, max(place) + 400 AS high FROM marked GROUP BY doc_id, run
), edges AS (
    SELECT doc_id, low, high, coalesce(lag(high) OVER (PARTITION BY doc_id ORDER BY low), 0) AS before FROM runs
), kept AS (
    SELECT e.doc_id, string_agg(substr(body, (2 * before + 1)::BIGINT, (2 * (low - before))::BIGINT), '' ORDER BY low) AS head,
           max(high) AS last, sum(high - low) AS n_removed, count(*) AS n_spans
    FROM edges e JOIN bytes b ON e.doc_id = b.doc_id GROUP BY e.doc_id
)
SELECT b.doc_id, b.n AS n_bytes, coalesce(k.n_removed, 0)::BIGINT AS n_removed, coalesce(k.n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(k.head, '') || substr(b.body, (2 * coalesce(k.last, 0) + 1)::BIGINT))) AS kept_sha256
FROM bytes b LEFT JOIN kept k ON b.doc_id = k.doc_id
"""

PHRASES = r"""
WITH words AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
    SELECT doc_id, place, array_to_string(w[place:place + 12], ' ') AS phrase
    FROM words, unnest(range(1, len(w) - 11)) AS t(place)
), firsts AS (
    SELECT phrase, min(doc_id) AS first FROM windows GROUP BY phrase
), gone AS (
    SELECT DISTINCT doc_id, place + step AS place
    FROM windows JOIN firsts USING (phrase), unnest(range(13)) AS t(step) WHERE first < doc_id
), single AS (
    SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS place FROM words
), left_over AS (
    SELECT s.doc_id, count(g.place) AS n_removed,
           string_agg(s.word, ' ' ORDER BY s.place) FILTER (g.place IS NULL) AS kept
    FROM single s LEFT JOIN gone g ON s.doc_id = g.doc_id AND s.place = g.place GROUP BY s.doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM words LEFT JOIN left_over USING (doc_id)
"""

MIXING = r"""
WITH RECURSIVE sized AS (
    SELECT doc_id, source, text,
           len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents
), sources AS (
    SELECT source, sum(size)::BIGINT AS source_size,
           [5, 2, 1][((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1)::BIGINT] AS weight
    FROM sized GROUP BY source
), totals AS (
    SELECT sum(source_size) AS size, sum(weight) AS weight FROM sources
), rounds AS (
    SELECT 0 AS step, 0::HUGEINT AS size, 0::HUGEINT AS weight
    UNION ALL
    SELECT r.step + 1,
           (SELECT coalesce(sum(3 * s.source_size), 0) FROM sources s
            WHERE (t.size - r.size)::DOUBLE * s.weight > 3 * s.source_size * (t.weight - r.weight)::DOUBLE),
           (SELECT coalesce(sum(s.weight), 0) FROM sources s
            WHERE (t.size - r.size)::DOUBLE * s.weight > 3 * s.source_size * (t.weight - r.weight)::DOUBLE)
    FROM rounds r, totals t WHERE r.step < 60 AND t.weight > r.weight
), settled AS (
    SELECT (t.size - r.size)::DOUBLE AS size, greatest(t.weight - r.weight, 1)::DOUBLE AS weight
    FROM rounds r, totals t ORDER BY r.step DESC LIMIT 1
), targets AS (
    SELECT source, source_size, least(c.size * weight_of / c.weight, (3 * source_size)::DOUBLE) AS target
    FROM (SELECT source, source_size, weight AS weight_of FROM sources), settled c
)

, ranked AS (
    SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate,
           row_number() OVER (PARTITION BY sized.source ORDER BY size, doc_id) AS place,
           ('0x' || substr(md5((sized.source IS NULL)::INT || ':' || coalesce(sized.source, '')), 1, 8))::BIGINT
               / 4294967296.0::DOUBLE AS shift
    FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source
)
SELECT doc_id, size, source_size, target,
       (size * (floor(rate * place + shift) - floor(rate * (place - 1) + shift)))::BIGINT AS taken
FROM ranked
"""

JACCARD = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, md5_number(array_to_string(w[place:place + 4], ' ')) AS s
    FROM words, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS t(place) WHERE len(w) > 0
), sizes AS (
    SELECT doc_id, count(*) AS n, list_sort(list(s)) AS members FROM shingles GROUP BY doc_id
), pairs AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS (
    SELECT a, b, y.members AS other, x.members <> y.members AS differs
    FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 5 * common >= 4 * (x.n + y.n - common)
), reach AS (
    SELECT a, b FROM links
    UNION
    SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), classes AS (
    SELECT a, min(b) AS least FROM reach GROUP BY a
), counts AS (
    SELECT a, count(*) AS n_links, count(DISTINCT other) FILTER (differs) AS n_linked_texts FROM links GROUP BY a
)
SELECT d.doc_id, least(d.doc_id, coalesce(c.least, d.doc_id)) AS class_id,
       coalesce(n.n_links, 0) AS n_links, coalesce(n.n_linked_texts, 0) AS n_linked_texts
FROM documents d LEFT JOIN classes c ON c.a = d.doc_id LEFT JOIN counts n ON n.a = d.doc_id
"""

FILL_MIDDLE = r"""
WITH units AS (
    SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS l,
           [('0x' || substr(sha256('7:' || doc_id), 8 * i + 1, 8))::BIGINT FOR i IN range(4)] AS h
    FROM documents
), cuts AS (
    SELECT *, len(l) AS n, least(h[1] % (len(l) + 1), h[2] % (len(l) + 1)) AS low,
           greatest(h[1] % (len(l) + 1), h[2] % (len(l) + 1)) AS high,
           CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                     OR h[3] % 100 >= 100 THEN 'plain'
                WHEN h[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM units
), parts AS (
    SELECT *, coalesce(array_to_string(l[1:low], ''), '') AS prefix,
           coalesce(array_to_string(l[low + 1:high], ''), '') AS middle,
           coalesce(array_to_string(l[high + 1:n], ''), '') AS suffix FROM cuts
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""

ORACLES = {
    "op13_fill_middle": FILL_MIDDLE,
    "op3_suffix_dedup": SUBSTRINGS,
    "op5_line_dedup": LINES,
    "op6_jaccard_join": JACCARD,
    "op7_phrase_dedup": PHRASES,
    "op8_source_mixing": MIXING,
}
