"""DuckDB SQL for those queries that SQL can express."""

_HOST = "translate(coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)([^?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PATH = "coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)([^?#]*)', 2), '')"

ORACLE = {
    "op6_url_rules": f"""
        WITH p AS (SELECT page_id, {_HOST} AS host, {_PATH} AS path FROM pages),
        r(rule, h, q, action) AS (VALUES ('com/', 'com', '/', 'allow'), ('example.com/en/', 'example.com', '/en/', 'block'),
            ('www.example.com/en/', 'www.example.com', '/en/', 'allow'), ('net/es/', 'net', '/es/', 'block'), ('net/fr/', 'net', '/fr/', 'block'))
        SELECT page_id, host, path, w.rule AS rule, coalesce(w.action, 'allow') AS verdict
        FROM p LEFT JOIN LATERAL (SELECT rule, action FROM r WHERE (p.host = h OR ends_with(p.host, '.' || h)) AND starts_with(p.path, q)
                                  ORDER BY length(rule) DESC LIMIT 1) w ON true""",
    "op8_line_dedup": """
        WITH d AS (SELECT doc_id, source, text, string_split(text, chr(10)) AS ls FROM documents),
        n AS (SELECT source, count(DISTINCT text) AS total FROM d GROUP BY source),
        l AS (SELECT doc_id, source, text, trim(ls[i], ' ') AS line, i, ls[i] AS raw FROM d, unnest(range(1, len(ls) + 1)) t(i)),
        b AS (SELECT l.source, line FROM l JOIN n ON l.source IS NOT DISTINCT FROM n.source WHERE line <> ''
              GROUP BY l.source, line, total HAVING count(DISTINCT text) >= 2 AND count(DISTINCT text) > 0.1 * total),
        k AS (SELECT doc_id, count(*) AS n_dropped, list(i) AS places FROM l SEMI JOIN b ON l.source IS NOT DISTINCT FROM b.source AND l.line = b.line GROUP BY doc_id)
        SELECT d.doc_id, coalesce(len(ls), 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped,
               CASE WHEN places IS NULL THEN text ELSE coalesce(array_to_string([ls[i] FOR i IN range(1, len(ls) + 1) IF NOT list_contains(places, i)], chr(10)), '') END AS text
        FROM d LEFT JOIN k USING (doc_id)""",
    "op11_infill": """
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
        g AS (SELECT doc_id, t, length(t) AS n, ('0x' || h[1:8])::BIGINT % (length(t) + 1) AS c1, ('0x' || h[9:16])::BIGINT % (length(t) + 1) AS c2,
                     CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR ('0x' || h[17:24])::BIGINT % 100 >= 90 THEN 'plain'
                          WHEN ('0x' || h[25:32])::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM d),
        s AS (SELECT doc_id, t, n, form, least(c1, c2) AS a, greatest(c1, c2) AS b, substring(t, 1, least(c1, c2)) AS p,
                     substring(t, least(c1, c2) + 1, abs(c1 - c2)) AS m, substring(t, greatest(c1, c2) + 1, n) AS q FROM g)
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || q || '<M>' || m ELSE '<S>' || q || '<P>' || p || '<M>' || m END) AS output_sha256,
               sha256(t) AS restored_sha256 FROM s""",
    "op12_filter_audit": r"""
        WITH w AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
        f AS (SELECT part, [len(words) < 200, 100 * len(list_distinct(words)) < 50 * len(words), 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t),
                            regexp_matches(t, '[#$%&*|]'), coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)] AS fails,
                     coalesce(doc_id IN (SELECT doc_id FROM labels WHERE quality = 1 AND doc_id IS NOT NULL), false) AS good,
                     coalesce(doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1 AND doc_id IS NOT NULL), false) AS toxic FROM w),
        c AS (SELECT part, fails, good, toxic, count(*) AS n FROM f GROUP BY ALL),
        l(x) AS (VALUES (1), (2), (3), (4), (5)),
        o AS (SELECT [a.x, b.x, c.x, d.x, e.x] AS p FROM l a, l b, l c, l d, l e WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
        r AS (SELECT part, array_to_string([('ABCDE')[i] FOR i IN p], '') AS filter_order, x AS step, n, good, toxic, fails[p[x]] AS now,
                     list_contains([fails[p[j]] FOR j IN range(1, x)], true) AS before, len([b FOR b IN fails IF b]) = 1 AS alone, ('ABCDE')[p[x]] AS letter FROM c, o, l),
        s AS (SELECT part, filter_order, step, letter, sum(CASE WHEN NOT now AND NOT before THEN n ELSE 0 END)::BIGINT AS kept,
                     sum(CASE WHEN now AND NOT before THEN n ELSE 0 END)::BIGINT AS removed, sum(CASE WHEN now AND before THEN n ELSE 0 END)::BIGINT AS redundant,
                     sum(CASE WHEN now AND alone THEN n ELSE 0 END)::BIGINT AS unique_fails,
                     sum(CASE WHEN now AND NOT before AND good THEN n ELSE 0 END)::BIGINT AS good_lost,
                     sum(CASE WHEN now AND NOT before AND toxic THEN n ELSE 0 END)::BIGINT AS toxic_lost FROM r GROUP BY part, filter_order, step, letter)
        SELECT part, filter_order, step::INTEGER AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
               (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley FROM s""",
}
