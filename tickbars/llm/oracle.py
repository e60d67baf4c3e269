"""DuckDB SQL for the queries of this package that SQL can express."""

OP1 = r"""
WITH words AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), grams AS (
    SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS gram
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM words)
), firsts AS (SELECT gram, min(doc_id) AS first_id FROM grams GROUP BY gram HAVING count(*) > 1),
removed AS (
    SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS j
    FROM grams JOIN firsts USING (gram) WHERE first_id < doc_id
), kept AS (
    SELECT doc_id, word, j FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS j FROM words)
    ANTI JOIN removed USING (doc_id, j)
), left_over AS (
    SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY j) AS text FROM kept GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(left_over.text, '')) AS kept_sha256
FROM words LEFT JOIN left_over USING (doc_id)
"""

OP3 = r"""
WITH sized AS (
    SELECT doc_id, coalesce('a' || source, 'b') AS source,
           coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
           (('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':20'), 1, 13))::BIGINT + 0.5::DOUBLE)
               / 4503599627370496::DOUBLE AS u
    FROM documents
), sources AS (
    SELECT source, sum(size)::BIGINT AS source_size, 3 * sum(size)::BIGINT AS cap,
           (row_number() OVER (ORDER BY source) - 1) % 3 + 1 AS weight
    FROM sized GROUP BY source
), ordered AS (
    SELECT *, coalesce(sum(cap) OVER before, 0)::BIGINT AS capped, sum(weight) OVER after AS free,
           (SELECT sum(size) FROM sized) AS total
    FROM sources
    WINDOW before AS (ORDER BY cap / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
           after AS (ORDER BY cap / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
), level AS (
    SELECT (total - capped)::BIGINT AS up, free::BIGINT AS down FROM ordered
    WHERE (total - capped)::DOUBLE * weight / free::DOUBLE < cap
    ORDER BY cap / weight, source LIMIT 1
), targets AS (
    SELECT source, source_size,
           CASE WHEN down IS NULL THEN cap::DOUBLE
                ELSE least(up::DOUBLE * weight / down::DOUBLE, cap::DOUBLE) END AS target
    FROM sources LEFT JOIN level ON true
), expected AS (
    SELECT *, least(coalesce(target / nullif(source_size, 0), 0), 3) AS copies, floor(copies) AS whole,
           copies - whole AS rest
    FROM sized JOIN targets USING (source)
), ranked AS (
    SELECT *, CASE WHEN rest > 0 AND size > 0 THEN u * (1 - rest) / (u * (1 - rest) + rest * (1 - u)) END AS rank,
           target - sum(whole * size) OVER (PARTITION BY source) AS missing
    FROM expected
), running AS (
    SELECT *, sum(CASE WHEN rank IS NOT NULL THEN size END)
                  OVER (PARTITION BY source ORDER BY rank NULLS LAST, doc_id) - size / 2 AS middle
    FROM ranked
)
SELECT doc_id, size, source_size, target,
       ((whole + CASE WHEN rank IS NOT NULL AND middle <= missing THEN 1 ELSE 0 END) * size)::BIGINT AS taken
FROM running
"""

OP5 = r"""
WITH words AS (
    SELECT doc_id, w
    FROM (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents)
), items AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), windows AS (
    SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS gram
    FROM items, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS t(i) WHERE len(w) > 0
), lengths AS (SELECT DISTINCT n FROM windows),
grams AS (
    SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS gram
    FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM words, lengths)
), hits AS (SELECT doc_id, i, n, item_id FROM grams JOIN windows USING (n, gram)),
covered AS (
    SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM hits) GROUP BY doc_id
), found AS (
    SELECT doc_id, count(DISTINCT item_id) AS n_items,
           string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS item_ids
    FROM hits GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(item_ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * n_hit >= len(w) AS contaminated
FROM words LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
"""

OP9 = r"""
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

OP11 = r"""
WITH vectors AS (
    SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
    SELECT a.id AS anchor_id, a.label AS own, b.id, b.label, list_inner_product(a.v, b.v)::BIGINT AS score
    FROM vectors AS a JOIN vectors AS b ON a.id % 100 = 0 AND b.id <> a.id
), positives AS (
    SELECT * FROM scores WHERE label = own
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT p.anchor_id, p.id AS positive_id, (row_number() OVER best)::INTEGER AS rank, n.id AS negative_id,
       p.score AS positive_score, n.score AS negative_score
FROM positives AS p JOIN scores AS n
     ON n.anchor_id = p.anchor_id AND n.label <> n.own AND 100 * n.score BETWEEN 30 * p.score AND 90 * p.score
WINDOW best AS (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id)
QUALIFY row_number() OVER best <= 10
"""

OP12 = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
grams AS (
    SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
    FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words, range(1, 6) AS sizes(k))
), counts AS (SELECT lang, k, phrase, count(*) AS a FROM grams GROUP BY lang, k, phrase),
totals AS (SELECT lang, sum(a)::BIGINT AS n FROM counts WHERE k = 1 GROUP BY lang),
many AS (SELECT * FROM counts WHERE a >= 100),
candidates AS (
    SELECT * FROM many AS c
    WHERE k > 1 AND NOT EXISTS (
        SELECT 1 FROM many AS longer
        WHERE longer.lang = c.lang AND longer.k > c.k AND 100 * longer.a >= 100 * c.a
              AND contains(' ' || longer.phrase || ' ', ' ' || c.phrase || ' '))
), cuts AS (
    SELECT lang, k, phrase, a, j, array_to_string(string_split(phrase, ' ')[1:j], ' ') AS first,
           array_to_string(string_split(phrase, ' ')[j + 1:], ' ') AS rest
    FROM candidates, range(1, 5) AS cut(j) WHERE j < k
), scored AS (
    SELECT cuts.lang, cuts.phrase, cuts.a, f.a AS l, r.a AS r, n, j,
           (1000::HUGEINT * cuts.a * n) // (f.a::HUGEINT * r.a) AS score
    FROM cuts JOIN totals USING (lang)
    JOIN many AS f ON f.lang = cuts.lang AND f.phrase = first JOIN many AS r ON r.lang = cuts.lang AND r.phrase = rest
), lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1)
SELECT lang, row_number() OVER best AS rank, phrase, a, l, r, n, score::BIGINT AS score
FROM lowest
WINDOW best AS (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)
QUALIFY rank <= 2000
"""

ORACLE = {
    "op1_substring_dedup": OP1,
    "op3_mixing": OP3,
    "op5_decontamination": OP5,
    "op9_exact_dedup": OP9,
    "op11_hard_negatives": OP11,
    "op12_collocations": OP12,
}
