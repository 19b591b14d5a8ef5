"""The queries that SQL can express, in DuckDB's SQL, written separately from the Spark code."""

ORACLES = {
    "op3_url_filters": r"""
        WITH rules(rule_host, rule_path, rule_verdict) AS (
            VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'),
                   ('org', '/fr/', 'allow')),
        rest AS (SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r
                 FROM pages),
        raw AS (SELECT page_id, url, regexp_extract(r, '^([^/?#]*)([^?#]*)', ['h', 'p']) AS x FROM rest),
        parts AS (SELECT page_id, translate(coalesce(x.h, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                         coalesce(x.p, '') AS path, row_number() OVER () AS n FROM raw)
        SELECT page_id, host, path, rule_host || rule_path AS rule, coalesce(rule_verdict, 'allow') AS verdict
        FROM parts LEFT JOIN rules
          ON (host = rule_host OR suffix(host, '.' || rule_host)) AND prefix(path, rule_path)
        QUALIFY row_number() OVER (PARTITION BY n ORDER BY length(rule_host || rule_path) DESC NULLS LAST) = 1""",
    "op7_quality_rules": r"""
        WITH docs AS (SELECT doc_id, source, coalesce(text, '') AS t, row_number() OVER () AS n FROM documents),
        split AS (SELECT n, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
                         list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS l FROM docs),
        spots AS (SELECT n, w, unnest(range(1, len(w) - 3)) AS i FROM split),
        windows AS (SELECT n, i, count(*) OVER (PARTITION BY n, w[i:i + 4]) AS found FROM spots),
        again AS (SELECT n, count(DISTINCT i + k) AS words
                  FROM (SELECT n, i, unnest(range(5)) AS k FROM windows WHERE found > 1) GROUP BY n),
        m AS (SELECT d.doc_id, d.source, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
                     length(d.t) - length(regexp_replace(d.t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
                     len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(words, 0) AS n_repeat_words
              FROM docs d JOIN split USING (n) LEFT JOIN again USING (n)),
        failed AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m),
        rules AS (SELECT *, base_failed OR 10 * n_symbols > n_words OR 2 * n_dup_lines > n_lines
                            OR word_chars < 2 * n_words OR word_chars > 15 * n_words AS rule_failed FROM failed),
        hosts AS (SELECT source, count(*) AS docs, count(*) FILTER (rule_failed) AS bad FROM rules GROUP BY source),
        sums AS (SELECT sum(docs) AS n, sum(bad) / sum(docs) AS mean, count(*) AS hosts,
                        sum(bad * (bad / docs)) / sum(docs) AS square FROM hosts),
        spread AS (SELECT mean, mean * (1 - mean) AS noise, square - mean * mean - hosts * (mean * (1 - mean)) / n AS between
                   FROM sums),
        prior AS (SELECT mean, CASE WHEN between > 0 THEN greatest(2.0, least(1000.0, noise / between - 1)) ELSE 1000.0 END AS weight
                  FROM spread),
        rates AS (SELECT source, (bad + mean * weight) / (docs + weight) AS rate FROM hosts, prior)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
               NOT rule_failed AND rate <= 0.5 AS kept
        FROM rules JOIN rates ON rules.source IS NOT DISTINCT FROM rates.source""",
    "op6_warc": r"""
        WITH payloads AS (SELECT page_id, encode(coalesce(html, '')) AS p FROM pages),
        raw AS (SELECT page_id, octet_length(p) AS payload_bytes, sha1(p) AS digest,
                       max(page_id) OVER (PARTITION BY p) AS last FROM payloads),
        -- base 32: 40 hex digits are 32 groups of five bits
        letters AS (SELECT digest, string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + v, 1), '' ORDER BY i) AS payload_digest
                    FROM (SELECT DISTINCT digest FROM raw),
                         LATERAL (SELECT i, CAST(('0x' || substr(digest, 1 + 2 * (5 * i // 8), 2)) AS INTEGER) * 256
                                         + CAST(('0x' || coalesce(nullif(substr(digest, 3 + 2 * (5 * i // 8), 2), ''), '00'))
                                                AS INTEGER) AS w FROM range(32) t(i)),
                         LATERAL (SELECT (w // CAST(pow(2, 11 - 5 * i % 8) AS INTEGER)) % 32 AS v)
                    GROUP BY digest)
        SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN page_id < last THEN last END AS refers_to
        FROM raw JOIN letters USING (digest)""",
    "op12_prefix_trie": r"""
        WITH turns AS (SELECT conv_id, coalesce(role, '') AS r, coalesce(text, '') AS t,
                              row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS at
                       FROM conversations WHERE conv_id IS NOT NULL),
        sizes AS (SELECT conv_id, count(*) AS n FROM turns GROUP BY conv_id),
        -- CRC-32 bit by bit: the register first, then each byte of the decimal id
        crc AS (SELECT conv_id, n, list_reduce(
                    list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
                    lambda register, byte: list_reduce(
                        list_prepend(xor(register, byte), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
                        lambda a, k: xor(a >> 1, CASE WHEN a & 1 = 1 THEN 3988292384::BIGINT ELSE 0::BIGINT END))) AS c FROM sizes),
        convs AS (SELECT conv_id, n, conv_id - conv_id % 20 AS base, xor(c, 4294967295::BIGINT) % 4 AS h FROM crc),
        rebuilt AS (
            SELECT c.conv_id, b.at AS pos, b.r, b.t FROM convs c JOIN turns b ON b.conv_id = c.base AND b.at < c.h
            UNION ALL
            SELECT c.conv_id, o.at - c.h + least(c.h, coalesce(b.n, 0)), o.r, o.t
            FROM convs c JOIN turns o ON o.conv_id = c.conv_id AND o.at >= c.h LEFT JOIN sizes b ON b.conv_id = c.base),
        paths AS (SELECT conv_id, pos + 1 AS depth, t, string_agg(sha256(r) || sha256(t), '/') OVER w AS path,
                         lead(pos) OVER (PARTITION BY conv_id ORDER BY pos) IS NULL AS ends
                  FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY pos ROWS UNBOUNDED PRECEDING)
                  UNION ALL
                  SELECT conv_id, 0, '', '', conv_id NOT IN (SELECT conv_id FROM rebuilt) FROM convs),
        marked AS (SELECT *, lag(path) OVER (PARTITION BY conv_id ORDER BY depth) AS above FROM paths),
        nodes AS (SELECT path, min(above) AS above, min(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
                         (count(*) - 1) * len(regexp_extract_all(min(t), '[^\x20\x09-\x0D]+')) AS saved,
                         coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '') AS ids
                  FROM marked GROUP BY path),
        children AS (SELECT above AS path, count(*) AS n FROM nodes WHERE above IS NOT NULL GROUP BY above),
        below AS (SELECT a.path, sum(n.saved) AS saved, sum(CASE WHEN c.n IS NULL THEN 1 ELSE 0 END) AS leaves
                  FROM nodes n JOIN marked a ON a.conv_id = n.conv_id AND a.depth <= n.depth LEFT JOIN children c ON c.path = n.path
                  GROUP BY a.path)
        SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n, 0) AS n_children,
               b.leaves::BIGINT AS n_leaves, b.saved::BIGINT AS saved_tokens, sha256(n.ids) AS ends_sha256
        FROM nodes n JOIN below b USING (path) LEFT JOIN nodes p ON p.path = n.above LEFT JOIN children c ON c.path = n.path""",
}
