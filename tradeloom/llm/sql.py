"""DuckDB SQL for the queries that SQL can express."""

SQL = {
    "op1_poisson_mixing": """
WITH mass AS (
    SELECT source, sum(coalesce(length(text), 0) + 1) AS mass FROM documents GROUP BY source
), weights AS (
    SELECT source, mass, pow(mass, 0.5) AS weight FROM mass
), rate AS (
    SELECT source, weight / (SELECT sum(weight) FROM weights) * (SELECT sum(mass) FROM mass) / mass AS rate
    FROM weights
), parts AS (
    SELECT source, rate, greatest(1, ceil(rate / 500.0))::BIGINT AS parts FROM rate
), steps AS (
    SELECT source, parts, rate / parts AS r,
           unnest(generate_series(0, ceil(rate / parts + 10 * sqrt(rate / parts) + 20)::BIGINT)) AS k
    FROM parts
), below AS (
    SELECT source, parts, k,
           sum(exp(-r + k * ln(r) - lgamma(k + 1))) OVER (PARTITION BY source ORDER BY k) AS p
    FROM steps
), draws AS (
    SELECT d.doc_id, d.source, d.text, d.lang, d.n_chars, p.part,
           ('0x' || substr(md5('mix:' || d.doc_id::VARCHAR || ':' || p.part::VARCHAR), 1, 12))::BIGINT
               / 281474976710656.0::DOUBLE AS u
    FROM documents d
    JOIN (SELECT source, unnest(generate_series(1, parts)) AS part FROM parts) p
      ON d.source IS NOT DISTINCT FROM p.source
), counted AS (
    SELECT d.doc_id, d.source, d.text, d.lang, d.n_chars, count(b.k)::INTEGER AS n_copies
    FROM draws d JOIN below b ON d.source IS NOT DISTINCT FROM b.source AND b.p <= d.u
    GROUP BY ALL
), copies AS (
    SELECT *, unnest(generate_series(1, n_copies))::INTEGER AS copy FROM counted
)
SELECT doc_id, source, text, lang, n_chars, n_copies, copy,
       md5('mix:order:' || doc_id::VARCHAR || ':' || copy::VARCHAR) AS shuffle_key
FROM copies
""",
    "op3_exact_dedup": """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
""",
    "op6_url_range_join": """
WITH parsed AS (
    SELECT page_id,
           translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
    FROM pages
), rules(rule_host, rule_path, verdict) AS (
    VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
           ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), best AS (
    SELECT page_id, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
           arg_max(verdict, length(rule_host || rule_path)) AS verdict
    FROM parsed JOIN rules
      ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
    GROUP BY page_id
)
SELECT p.page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM parsed p LEFT JOIN best ON best.page_id = p.page_id
""",
    "op8_minmax_near_dedup": """
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x20\\x09-\\x0D]+') AS w
    FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, unnest(CASE
        WHEN len(w) = 0 THEN []
        WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_transform(generate_series(1, len(w) - 2), lambda i: array_to_string(w[i:i + 2], ' '))
    END) AS s
    FROM words
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id
    GROUP BY ALL
), links AS (
    SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * shared.n >= 85 * (x.n + y.n - shared.n)
), edges AS (
    SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
    SELECT doc_id, doc_id AS seen FROM documents
    UNION
    SELECT reach.doc_id, edges.b FROM reach JOIN edges ON edges.a = reach.seen
), parts AS (
    SELECT doc_id, min(seen) AS component_id FROM reach GROUP BY doc_id
)
SELECT d.doc_id, coalesce(sizes.n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN parts ON parts.doc_id = d.doc_id LEFT JOIN sizes ON sizes.doc_id = d.doc_id
""",
    "op11_norm_sorted_top_k": """
WITH v AS (
    SELECT row_number() OVER () AS r, vec_id,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS parts
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.r, q.vec_id AS query_id, c.vec_id, list_dot_product(q.parts, c.parts)::BIGINT AS score
    FROM v q JOIN v c ON c.vec_id IS DISTINCT FROM q.vec_id AND len(c.parts) = len(q.parts)
    WHERE q.vec_id % 50 = 0
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST)::INTEGER AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
""",
    "op12_prefix_trie": """
WITH turns AS (
    SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place
    FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
    SELECT c, count(*) AS own, c - c % 5 AS base,
           list_reduce(list_prepend(4294967295::BIGINT, list_transform(split(c::VARCHAR, ''), lambda s: ascii(s)::BIGINT)),
               lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
                   lambda x, y: xor(x >> 1, (x & 1) * 3988292384::BIGINT))) AS inverse
    FROM turns GROUP BY c
), cut AS (
    SELECT x.c, x.base, xor(x.inverse, 4294967295::BIGINT) % 9 AS h, x.own, coalesce(y.own, 0) AS there
    FROM convs x LEFT JOIN convs y ON y.c = x.base
), rebuilt AS (
    SELECT cut.c, place AS d, role, text FROM cut JOIN turns ON turns.c = cut.base WHERE place <= h
    UNION ALL
    SELECT cut.c, place - h + least(h, there), role, text FROM cut JOIN turns ON turns.c = cut.c WHERE place > h
), sized AS (
    SELECT c, d, strlen(text) AS size, list(sha256(strlen(role)::VARCHAR || ':' || role || text)) OVER (
        PARTITION BY c ORDER BY d) AS steps
    FROM rebuilt
), paths AS (
    SELECT c, d, size, sha256(array_to_string(steps, ',')) AS node FROM sized
    UNION ALL SELECT c, 0, 0, '' FROM cut
), nodes AS (
    SELECT node, any_value(d) AS d, any_value(size) AS size, count(*) AS n, min(c) AS c FROM paths GROUP BY node
), above AS (
    SELECT DISTINCT p.node, q.node AS parent FROM paths p JOIN paths q ON q.c = p.c AND q.d = p.d - 1
), children AS (
    SELECT parent AS node, count(*) AS n FROM above GROUP BY parent
), below AS (
    SELECT DISTINCT p.node AS top, q.node FROM paths p JOIN paths q ON q.c = p.c AND q.d >= p.d
), sums AS (
    SELECT top AS node, sum((nodes.n - 1) * size)::BIGINT AS saved, count(*) FILTER (children.n IS NULL) AS leaves
    FROM below JOIN nodes ON nodes.node = below.node LEFT JOIN children ON children.node = below.node GROUP BY top
), lasts AS (
    SELECT c, max(d) AS d FROM paths GROUP BY c
), ends AS (
    SELECT node, string_agg(c::VARCHAR, ',' ORDER BY c) AS ids FROM paths JOIN lasts USING (c, d) GROUP BY node
)
SELECT nodes.c AS conv_id, nodes.d AS depth, up.c AS parent_conv_id, nodes.n AS n_convs,
       coalesce(children.n, 0) AS n_children, sums.leaves AS n_leaves, sums.saved AS saved_tokens,
       sha256(coalesce(ends.ids, '')) AS ends_sha256
FROM nodes JOIN sums ON sums.node = nodes.node LEFT JOIN children ON children.node = nodes.node
LEFT JOIN above ON above.node = nodes.node LEFT JOIN nodes up ON up.node = above.parent
LEFT JOIN ends ON ends.node = nodes.node
""",
}
