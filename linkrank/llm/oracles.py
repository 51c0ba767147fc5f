"""SQL for DuckDB with the rows of the registered queries, where SQL can express them."""

WARC = """
WITH d AS (
    SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS h
    FROM pages
), k AS (SELECT h, max(page_id) AS keeper FROM d GROUP BY h)
SELECT page_id, payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + ((('0x' || substr(h, 1 + 5 * (i // 4), 5))::INT >> (15 - 5 * (i % 4))) & 31)::INT, 1)
           for i in range(32)], '') AS payload_digest,
       CASE WHEN page_id < keeper THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < keeper THEN keeper END AS refers_to
FROM d JOIN k USING (h)
"""

WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
    "'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+')"
)

MINHASH = f"""
WITH RECURSIVE w AS (SELECT doc_id, {WORDS} AS ws FROM documents),
s AS (
    SELECT DISTINCT doc_id, array_to_string(ws[i : i + 4], ' ') AS sh
    FROM w, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS t(i)
    WHERE len(ws) > 0
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
    FROM s x JOIN s y ON x.sh = y.sh AND x.doc_id <> y.doc_id GROUP BY 1, 2
),
e AS (
    SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
    WHERE 100 * c >= 75 * (na.n + nb.n - c)
),
r AS (
    SELECT doc_id AS a, doc_id AS b FROM documents
    UNION
    SELECT r.a, e.b FROM r JOIN e ON r.b = e.a
),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a)
SELECT c.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, c.doc_id = component_id AS kept
FROM c LEFT JOIN n USING (doc_id)
"""

ALNUM = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
    "'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
)

DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, {ALNUM} AS ws FROM documents),
b AS (SELECT item_id, {ALNUM} AS ws FROM benchmark),
bw AS (
    SELECT DISTINCT item_id, least(len(ws), 13) AS l, array_to_string(ws[i : i + least(len(ws), 13) - 1], ' ') AS k
    FROM b, unnest(range(1, len(ws) - least(len(ws), 13) + 2)) AS t(i)
    WHERE len(ws) > 0
),
dw AS (
    SELECT doc_id, l, i, array_to_string(ws[i : i + l - 1], ' ') AS k
    FROM d, (SELECT DISTINCT l FROM bw), unnest(range(1, len(ws) - l + 2)) AS t(i)
    WHERE len(ws) >= l
),
h AS (SELECT DISTINCT doc_id, i, l, item_id FROM dw JOIN bw USING (l, k)),
n AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit
    FROM (SELECT DISTINCT doc_id, i, l FROM h), unnest(range(i, i + l)) AS t(p) GROUP BY doc_id
),
m AS (
    SELECT doc_id, count(*) AS n_items, sha256(string_agg(item_id, ',' ORDER BY item_id)) AS s
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM h) GROUP BY doc_id
)
SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(s, sha256('')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN m USING (doc_id)
"""

RULES = """
WITH w AS (
    SELECT doc_id, lang, source, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws
    FROM documents
),
l AS (
    SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines
    FROM w, unnest(string_split(text, chr(10))) AS t(line)
    WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id
),
g AS (
    SELECT doc_id, i, array_to_string(ws[i : i + 7], ' ') AS k
    FROM w, unnest(range(1, len(ws) - 6)) AS t(i) WHERE len(ws) >= 8
),
r AS (
    SELECT doc_id, count(DISTINCT p) AS n_repeat_words
    FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, k) AS c FROM g), unnest(range(i, i + 8)) AS t(p)
    WHERE c > 1 GROUP BY doc_id
),
c AS (
    SELECT doc_id, lang, source, len(ws) AS n_words,
           length(array_to_string(ws, '')) AS word_chars,
           length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
           length(regexp_replace(text, '[^!-/:-@\\[-`{-~]', '', 'g')) AS n_marks,
           coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
    FROM w LEFT JOIN l USING (doc_id) LEFT JOIN r USING (doc_id)
),
f AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM c),
m AS (
    SELECT doc_id, lang, source, unnest([
        {'m': 'marks', 'v': 1000 * n_marks // word_chars},
        {'m': 'repeats', 'v': 1000 * n_repeat_words // n_words},
        {'m': 'lines', 'v': 1000 * n_dup_lines // n_words},
        {'m': 'length', 'v': least(1000, 10 * word_chars // n_words)}]) AS x
    FROM f WHERE NOT base_failed
),
p(m, above_zero, two, a, b, c, reach, slack) AS (
    VALUES ('marks', false, false, 25, 50, 75, 10, 20), ('repeats', true, false, 50, 75, 90, 3, 20),
           ('lines', true, false, 50, 75, 90, 3, 20), ('length', false, true, 25, 50, 75, 10, 0)
),
v AS (SELECT lang, source, x.m AS m, x.v AS v, count(*) AS n FROM m GROUP BY ALL),
s AS (
    SELECT 'group' AS part, lang, source, m, v, n FROM v
    UNION ALL SELECT 'language', lang, NULL, m, v, sum(n) FROM v GROUP BY lang, m, v
    UNION ALL SELECT 'corpus', NULL, NULL, m, v, sum(n) FROM v GROUP BY m, v
),
t AS (
    SELECT part, lang, source, m, v, a, b, c, u, sum(n) OVER own AS total, sum(u) OVER own AS size,
           sum(u) OVER (PARTITION BY part, lang, source, m ORDER BY v) AS upto
    FROM (SELECT *, CASE WHEN above_zero AND v = 0 THEN 0 ELSE n END AS u FROM s JOIN p USING (m))
    WINDOW own AS (PARTITION BY part, lang, source, m)
),
q AS (
    SELECT part, lang, source, m, max(total)::BIGINT AS total, max(size)::BIGINT AS size,
           coalesce(min(v) FILTER (u > 0 AND 100 * upto >= a * size), 0) AS q0,
           coalesce(min(v) FILTER (u > 0 AND 100 * upto >= b * size), 0) AS q1,
           coalesce(min(v) FILTER (u > 0 AND 100 * upto >= c * size), 0) AS q2
    FROM t GROUP BY part, lang, source, m
),
h AS (
    SELECT q.*, k.size / k.total AS share,
           least(q.size, floor(2.0::DOUBLE * q.total * (k.size / k.total))::BIGINT) AS voice
    FROM q JOIN q AS k ON q.m = k.m AND k.part = 'corpus'
),
y AS (
    SELECT h.lang, h.m, (h.voice * h.q0 + (100 + h.size - h.voice) * k.q0) // (100 + h.size) AS q0,
           (h.voice * h.q1 + (100 + h.size - h.voice) * k.q1) // (100 + h.size) AS q1,
           (h.voice * h.q2 + (100 + h.size - h.voice) * k.q2) // (100 + h.size) AS q2
    FROM h JOIN h AS k ON h.m = k.m AND h.part = 'language' AND k.part = 'corpus'
),
z AS (
    SELECT h.lang, h.source, h.m, (h.voice * h.q0 + (100 + h.size - h.voice) * y.q0) // (100 + h.size) AS q0,
           (h.voice * h.q1 + (100 + h.size - h.voice) * y.q1) // (100 + h.size) AS q1,
           (h.voice * h.q2 + (100 + h.size - h.voice) * y.q2) // (100 + h.size) AS q2
    FROM h JOIN y ON h.m = y.m AND h.part = 'group' AND h.lang IS NOT DISTINCT FROM y.lang
),
o AS (
    SELECT doc_id, bool_or(x.v > q1 + reach * (q1 - q0 + 1) + q1 // 10 + slack
                           OR (two AND x.v < q1 - reach * (q2 - q1 + 1) - q1 // 10 - slack)) AS out_of_fences
    FROM m JOIN z ON m.lang IS NOT DISTINCT FROM z.lang AND m.source IS NOT DISTINCT FROM z.source AND m.x.m = z.m
    JOIN p ON p.m = z.m GROUP BY doc_id
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT coalesce(out_of_fences, true) AS kept
FROM f LEFT JOIN o USING (doc_id)
"""


SEARCH = f"""
WITH u AS (SELECT doc_id, unnest({ALNUM}) AS t FROM documents),
n AS (SELECT doc_id, count(*) AS n FROM u GROUP BY doc_id),
g AS (SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM n),
m AS (SELECT doc_id, 25 + (75 * n * docs) // total AS m FROM n, g),
i AS (SELECT item_id, unnest({ALNUM}) AS t FROM benchmark),
q AS (SELECT item_id, t, count(*) AS q FROM i GROUP BY ALL),
f AS (SELECT doc_id, t, count(*) AS tf FROM u WHERE t IN (SELECT t FROM q) GROUP BY ALL),
w AS (
    SELECT t, floor(1000 * ln((2 * docs + 2) / (2 * df + 1)))::BIGINT AS w
    FROM (SELECT t, count(*) AS df FROM f GROUP BY t), g
),
s AS (
    SELECT item_id, doc_id, sum(q * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
    FROM q JOIN f USING (t) JOIN w USING (t) JOIN m USING (doc_id) GROUP BY ALL
)
SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INT AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 10
"""

MIXING = """
WITH d AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
           ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS draw
    FROM documents
),
s AS (
    SELECT source, sum(size)::BIGINT AS source_size,
           1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS w
    FROM d GROUP BY source
),
o AS (
    SELECT *, 3 * source_size AS cap, (sum(source_size) OVER ())::BIGINT AS words, (sum(w) OVER ())::BIGINT AS weights,
           coalesce(sum(3 * source_size) OVER b, 0)::BIGINT AS spent, coalesce(sum(w) OVER b, 0)::BIGINT AS gone,
           row_number() OVER (ORDER BY source_size / w, source NULLS LAST) AS i
    FROM s WINDOW b AS (ORDER BY source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
l AS (
    SELECT (words - spent) / (weights - gone) AS level FROM o
    WHERE cap >= (words - spent) / (weights - gone) * w ORDER BY i LIMIT 1
),
t AS (SELECT source, source_size, least(cap::DOUBLE, coalesce(level, 0) * w) AS target FROM o LEFT JOIN l ON true),
e AS (
    SELECT d.*, source_size, target, (sum(size) OVER (
        PARTITION BY d.source ORDER BY draw, doc_id, size ROWS UNBOUNDED PRECEDING))::BIGINT - size AS begin
    FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target, source,
       list_sum([greatest(0, least(size, floor(target)::BIGINT - (k * source_size + begin))) for k in range(3)])::BIGINT AS taken
FROM e
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op4_warc": WARC,
        "op6_minhash": MINHASH,
        "op7_decontamination": DECONTAMINATION,
        "op8_quality_rules": RULES,
        "op11_search": SEARCH,
        "op12_mixing": MIXING,
    }
