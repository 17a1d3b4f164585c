"""Checking SQL (DuckDB) for the queries of this package that SQL can express."""

SQL = {
    "op1_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
        d AS (SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes, sha1(html) AS hexed,
                     max(page_id) OVER (PARTITION BY html) AS original FROM p)
        SELECT page_id, payload_bytes,
               array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   CAST(list_sum(list_transform(range(5), lambda b: CAST((instr('0123456789abcdef', substr(hexed, CAST((5*i+b)//4 AS INT) + 1, 1)) - 1) >> (3 - (5*i+b) % 4) & 1 AS BIGINT) << (4 - b))) AS INT) + 1, 1)), '') AS payload_digest,
               CASE WHEN page_id = original THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> original THEN original END AS refers_to, CAST(NULL AS VARCHAR) AS error
        FROM d""",
    "op10_url_filters": r"""
        WITH p AS (SELECT page_id, lower(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), '')) AS host,
                          coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path FROM pages),
        r(h, p, verdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
             ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
        m AS (SELECT p.page_id, p.host, p.path, max({'n': length(r.h), 'k': length(r.p), 'rule': r.h || r.p, 'verdict': r.verdict}) AS best
              FROM p LEFT JOIN r ON (p.host = r.h OR ends_with(p.host, '.' || r.h)) AND starts_with(p.path, r.p)
              GROUP BY ALL)
        SELECT page_id, host, path, best.rule AS rule, coalesce(best.verdict, 'allow') AS verdict FROM m""",
    "op11_lexical_search": r"""
        WITH words AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
        tf AS MATERIALIZED (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
        size AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY ALL),
        whole AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM size),
        df AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, whole GROUP BY term),
        m AS (SELECT doc_id, 25 + (75 * n * docs) // terms AS m FROM size, whole),
        asked AS (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
        scored AS (SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
                   FROM asked JOIN tf USING (term) JOIN df USING (term) JOIN m USING (doc_id) GROUP BY ALL),
        ranked AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
                   FROM scored WHERE score > 0)
        SELECT * FROM ranked WHERE rank <= 10""",
    "op13_vector_codes": """
        WITH kept AS MATERIALIZED (
            SELECT vec_id, label, CAST(length(embedding) // 16 AS INT) AS width, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings WHERE length(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        part AS MATERIALIZED (SELECT vec_id, p, v[p * width + 1:(p + 1) * width] AS x FROM kept, range(16) AS parts(p)),
        seed AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept ORDER BY vec_id LIMIT 64),
        book0 AS MATERIALIZED (SELECT p, e, x FROM part JOIN seed USING (vec_id)),
        code1 AS MATERIALIZED (SELECT vec_id, p, any_value(part.x) AS x, min([list_sum(list_transform(list_zip(part.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), e]) AS best
                  FROM part JOIN book0 b USING (p) GROUP BY vec_id, p),
        mean1 AS (SELECT p, e, list(m ORDER BY i) AS x FROM (
                  SELECT p, best[2] AS e, i, CAST((sum(x[i]) - ((sum(x[i]) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS m FROM code1, range(1, 65) AS place(i) WHERE i <= len(x) GROUP BY ALL) GROUP BY ALL),
        book1 AS MATERIALIZED (SELECT p, e, coalesce(n.x, o.x) AS x FROM book0 o LEFT JOIN mean1 n USING (p, e)),
        code2 AS MATERIALIZED (SELECT vec_id, p, any_value(part.x) AS x, min([list_sum(list_transform(list_zip(part.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), e]) AS best
                  FROM part JOIN book1 b USING (p) GROUP BY vec_id, p),
        mean2 AS (SELECT p, e, list(m ORDER BY i) AS x FROM (
                  SELECT p, best[2] AS e, i, CAST((sum(x[i]) - ((sum(x[i]) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS m FROM code2, range(1, 65) AS place(i) WHERE i <= len(x) GROUP BY ALL) GROUP BY ALL),
        book2 AS MATERIALIZED (SELECT p, e, coalesce(n.x, o.x) AS x FROM book1 o LEFT JOIN mean2 n USING (p, e)),
        code3 AS MATERIALIZED (SELECT vec_id, p, min([list_sum(list_transform(list_zip(part.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), e]) AS best
                  FROM part JOIN book2 b USING (p) GROUP BY vec_id, p),
        whole AS (SELECT vec_id, string_agg(printf('%02x', CAST(best[2] AS INT)), '' ORDER BY p) AS code, CAST(sum(best[1]) AS BIGINT) AS error FROM code3 GROUP BY vec_id),
        sha AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book2)
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
        FROM whole JOIN kept USING (vec_id), sha""",
}
