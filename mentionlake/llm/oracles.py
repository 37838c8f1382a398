"""SQL twins of the operators' queries, written for DuckDB from the contracts."""

OP5 = r"""
WITH words AS (
    SELECT kind, id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w
    FROM (SELECT 'd' AS kind, doc_id AS id, text FROM documents
          UNION ALL SELECT 'i', item_id, text FROM benchmark WHERE item_id IS NOT NULL)
), sizes AS (
    SELECT DISTINCT least(len(w), 5) AS k FROM words WHERE kind = 'i' AND len(w) > 0 UNION SELECT 5
), grams AS (
    SELECT kind, id, md5(array_to_string(list_slice(w, i, i + k - 1), ' ')) AS g
    FROM words JOIN sizes ON len(w) >= k AND (kind = 'd' OR k = least(len(w), 5)), unnest(range(1, len(w) - k + 2)) AS t(i)
), items AS (SELECT DISTINCT id, g FROM grams WHERE kind = 'i'),
n AS (SELECT id, count(*) AS n FROM items GROUP BY id),
docs AS (SELECT DISTINCT id, g FROM grams WHERE kind = 'd')
SELECT d.id AS doc_id, i.id AS item_id, n.n AS n_shingles, count(*) AS n_shared, count(*) / n.n AS containment
FROM docs d JOIN items i USING (g) JOIN n ON n.id = i.id
GROUP BY d.id, i.id, n.n HAVING count(*) >= 0.8 * n.n
"""

OP6 = r"""
WITH d AS (
    SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), text, '')) AS h,
           len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS size
    FROM documents
), s AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
    FROM d GROUP BY source
), w AS (
    SELECT *, CASE place % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight, 2 * source_size AS cap FROM s
), l AS (
    SELECT *, (1.5::DOUBLE * (SELECT sum(source_size) FROM s)
               - coalesce(sum(cap) OVER (ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
              / sum(weight) OVER (ORDER BY cap / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM w
), f AS (
    SELECT arg_min(level, (cap / weight, place)) AS final FROM l WHERE level <= cap / weight
), t AS (
    SELECT source, source_size, place, least(CAST(cap AS DOUBLE), coalesce(final * weight, cap)) AS target FROM w, f
), p AS (
    SELECT doc_id, size, source_size, target, place,
           coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY h, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
    FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), q AS (
    SELECT *, floor(target / greatest(source_size, 1)) AS whole FROM p
), r AS (
    SELECT *, CASE WHEN size > 0 THEN least(whole + CASE WHEN start + size / 2 <= target - whole * source_size THEN 1 ELSE 0 END, 2) ELSE 0 END AS passes,
           least(start / greatest(target, 1.0), 1.0) AS part,
           CASE place % 3 WHEN 0 THEN 1.5::DOUBLE WHEN 1 THEN 1 ELSE 0.5 END AS a,
           CASE place % 3 WHEN 0 THEN 0.5::DOUBLE WHEN 1 THEN 1 ELSE 1.5 END AS b
    FROM q
)
SELECT doc_id, size, source_size, target, CAST(passes * size AS BIGINT) AS taken,
       CASE WHEN passes > 0 THEN round(CASE WHEN a = b THEN part ELSE (sqrt(a * a + (b - a) * (a + b) * part) - a) / (b - a) END, 9) END AS position
FROM r
"""

OP7 = r"""
WITH p AS (
    SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages
), b AS (
    SELECT *, CAST(unhex(hex) AS BIT)::VARCHAR AS bits, max(page_id) OVER (PARTITION BY hex) AS largest FROM p
)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + CAST(list_sum(list_transform(range(0, 5), lambda j: CAST(substr(bits, CAST(5 * i + j + 1 AS BIGINT), 1) AS INT) * CAST(pow(2, 4 - j) AS INT))) AS INT), 1)), '') AS payload_digest,
       CASE WHEN page_id < largest THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < largest THEN largest END AS refers_to
FROM b
"""

OP10 = r"""
WITH d AS (
    SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), words AS (
    SELECT doc_id, generate_subscripts(w, 1) AS p, unnest(w) AS x FROM d
), runs AS (
    SELECT doc_id, p, count(*) OVER run AS c, md5(string_agg(x, ' ') OVER run) AS g FROM words
    WINDOW run AS (PARTITION BY doc_id ORDER BY p ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING)
), f AS (
    SELECT doc_id, p, row_number() OVER (PARTITION BY g ORDER BY doc_id, p) AS r FROM runs WHERE c = 20
), gone AS (
    SELECT DISTINCT doc_id, u.q AS p FROM f, unnest(range(p, p + 20)) AS u(q) WHERE r > 1
), kept AS (
    SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS s FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
), n AS (SELECT doc_id, count(*) AS n_removed FROM gone GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(s, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN n USING (doc_id)
"""

# crc32 byte by byte: its table of 256 entries by the rule, then one step per byte of a word.
OP13 = r"""
WITH RECURSIVE rounds AS (
    SELECT i, 0 AS k, CAST(i AS BIGINT) AS c FROM range(256) AS t(i)
    UNION ALL
    SELECT i, k + 1, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM rounds WHERE k < 8
), steps AS (SELECT list(c ORDER BY i) AS step FROM rounds WHERE k = 8),
words AS (
    SELECT kind, id, w FROM (
        SELECT 'd' AS kind, row_number() OVER () AS id, text FROM documents
        UNION ALL SELECT 'b', 0, text FROM benchmark
    ), unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS t(w)
), buckets AS (
    SELECT w, xor(list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(range(0, strlen(w)), lambda i: CAST('0x' || substr(hex(encode(w)), 2 * i + 1, 2) AS BIGINT))),
        lambda c, b: xor(step[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) % 10000 AS bucket
    FROM (SELECT DISTINCT w FROM words), steps
), counts AS (
    SELECT bucket, count(*) FILTER (kind = 'd') AS s, count(*) FILTER (kind = 'b') AS t FROM words JOIN buckets USING (w) GROUP BY bucket
), gains AS (
    SELECT bucket, floor(1000 * ln((CAST(t + 1 AS DOUBLE) * CAST((SELECT sum(s) FROM counts) + 10000 AS DOUBLE))
                                   / (CAST(s + 1 AS DOUBLE) * CAST((SELECT sum(t) FROM counts) + 10000 AS DOUBLE)))) AS gain FROM counts
), weights AS (
    SELECT id, count(*) AS n, CAST(sum(gain) AS BIGINT) AS weight FROM words JOIN buckets USING (w) JOIN gains USING (bucket) WHERE kind = 'd' GROUP BY id
), scores AS (
    SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
           coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5::DOUBLE)
                                                          / 4294967296::DOUBLE))) AS BIGINT) AS score
    FROM (SELECT doc_id, row_number() OVER () AS id FROM documents) LEFT JOIN weights USING (id)
), ranks AS (
    SELECT *, CASE WHEN n_features >= 20 THEN row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS FIRST) END AS r,
           count(*) FILTER (n_features >= 20) OVER () AS able
    FROM scores
)
SELECT doc_id, n_features, weight, score, CASE WHEN r <= 10 * able // 100 THEN r END AS rank FROM ranks
"""

ORACLES: dict[str, str] = {"op5_decontaminate": OP5, "op6_mix": OP6, "op7_warc": OP7, "op10_substrings": OP10, "op13_resampling": OP13}
