"""SQL that gives the same rows as the queries of the text problems."""

_WS = r"[\s\x0b\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
_UNITS = f"""
        WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS u, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents WHERE text IS NOT NULL),
        o AS (SELECT *, coalesce(sum(length(u) + 1) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::bigint AS s, lower(trim(regexp_replace(u, '{_WS}', ' ', 'g'))) AS k FROM l),
        f AS (SELECT *, first_value(doc_id) OVER w AS first_id, first_value(s) OVER w AS first_start FROM o WHERE length(k) >= 40 WINDOW w AS (PARTITION BY k ORDER BY doc_id, s)),
        r AS (SELECT * FROM f WHERE doc_id <> first_id OR s <> first_start)"""
_SIMILAR = r"""
        WITH n AS (SELECT quote_no, trim(regexp_replace(lower(text), '[\s\x0b\x{85}\x{a0}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{3000}]+', ' ', 'g')) AS norm, regexp_extract_all(lower(text), '[\pL\pN]+') AS w FROM quotes WHERE text IS NOT NULL),
        k AS (SELECT * FROM n WHERE len(w) >= 12), u AS (SELECT norm, min(quote_no) AS u, any_value(w) AS w FROM k GROUP BY norm),
        s AS (SELECT DISTINCT u, unnest(list_transform(generate_series(1, len(w) - 2), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS s FROM u),
        z AS (SELECT u, count(*) AS n FROM s GROUP BY u),
        p AS (SELECT a.u AS x, b.u AS y, count(*) AS o FROM s a JOIN s b ON a.s = b.s AND a.u < b.u GROUP BY 1, 2),
        good AS (SELECT x, y FROM p JOIN z zx ON zx.u = x JOIN z zy ON zy.u = y WHERE 2 * o >= zx.n + zy.n - o)"""

SQL = {
    "p4_folded": """
        WITH t AS (UNPIVOT (SELECT source_id, work_title, publisher, occasion FROM sources) ON work_title, publisher, occasion INTO NAME field VALUE v),
        k AS (SELECT source_id, field, v, lower(trim(regexp_replace(v, ' +', ' ', 'g'))) AS k FROM t WHERE regexp_full_match(v, '[A-Za-z0-9 ]*[A-Za-z0-9][A-Za-z0-9 ]*')),
        c AS (SELECT field, lower(trim(regexp_replace(canonical, ' +', ' ', 'g'))) AS k, min(ref_id) AS ref_id FROM canon_items WHERE regexp_full_match(canonical, '[A-Za-z0-9 ]*[A-Za-z0-9][A-Za-z0-9 ]*') GROUP BY ALL)
        SELECT source_id, k.field, ref_id FROM k JOIN c ON c.field = k.field AND c.k = k.k WHERE NOT EXISTS (SELECT 1 FROM canon_items i WHERE i.field = k.field AND i.canonical = k.v)""",
    "p6_classes": f"""{_SIMILAR},
        b AS (SELECT x AS u FROM good UNION ALL SELECT y FROM good), d AS (SELECT u, count(*) AS n FROM b GROUP BY u)
        SELECT k.quote_no, u.u AS class_id, coalesce(d.n, 0) AS n_links FROM k JOIN u ON u.norm = k.norm LEFT JOIN d ON d.u = u.u""",
    "p7_reordered": """
        WITH t AS (SELECT agent_id, 'name' AS field, name AS v FROM agents WHERE kind IN ('person', 'unknown') UNION ALL SELECT agent_id, 'played_by', played_by FROM agents),
        k AS (SELECT agent_id, field, contains(v, ',') AS c, lower(regexp_replace(v, '^([^,]+), ([^,]+)$', '\\2 \\1')) AS k FROM t WHERE regexp_full_match(v, '[A-Za-z]{3,} [A-Za-z]{3,}|[A-Za-z]{3,}, [A-Za-z]{3,}'))
        SELECT a.field, least(a.agent_id, b.agent_id) AS agent_id_1, greatest(a.agent_id, b.agent_id) AS agent_id_2 FROM k a JOIN k b ON a.field = b.field AND a.k = b.k AND a.c AND NOT b.c""",
    "p8_round_trip": "SELECT doc_id, md5(coalesce(text, '')) AS text_md5 FROM documents",
    "p9_invariants": """
        SELECT capacity_id, (SELECT count(DISTINCT doc_id) FROM documents) AS n_documents, 0::bigint AS n_cut, 0::bigint AS n_incomplete, 0::bigint AS n_overfull, 0::bigint AS n_overlapping FROM pack_capacity""",
    "p10_lines": f"{_UNITS} SELECT doc_id, s AS unit_start, s + length(u) AS unit_end, first_id, first_start FROM r",
    "p10_kept": f"""{_UNITS},
        k AS (SELECT doc_id, string_agg(u, chr(10) ORDER BY i) AS t, count(*)::int AS n FROM o ANTI JOIN r USING (doc_id, s) GROUP BY doc_id)
        SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN md5(coalesce(k.t, '')) END AS text_md5, coalesce(k.n, 0) AS n_kept FROM documents d LEFT JOIN k ON k.doc_id = d.doc_id""",
    "p6_found": f"""{_SIMILAR}
        SELECT least(a.quote_no, b.quote_no) AS quote_no_1, greatest(a.quote_no, b.quote_no) AS quote_no_2
        FROM good JOIN u ux ON ux.u = x JOIN u uy ON uy.u = y JOIN k a ON a.norm = ux.norm JOIN k b ON b.norm = uy.norm""",
    "p10_found": """
        WITH w AS (SELECT doc_id, i, md5(substring(text, i + 1, 160)) AS h FROM (SELECT doc_id, text, unnest(generate_series(0, length(text) - 160)) AS i FROM documents WHERE length(text) >= 160)),
        g AS (SELECT h FROM w GROUP BY h HAVING min(doc_id) <> max(doc_id)),
        c AS (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 160 THEN 0 ELSE 1 END AS new FROM w SEMI JOIN g ON g.h = w.h),
        r AS (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM c)
        SELECT doc_id, min(i) AS span_start, max(i) + 160 AS span_end FROM r GROUP BY doc_id, run""",
}
