"""The same queries in SQL for DuckDB; dating by phrases and matching by ratio can't be expressed in it."""

from __future__ import annotations

from potsherd.functions import geo

TREE = """
    SELECT (r_regionkey + 1)::BIGINT AS primary_key, 0::BIGINT AS parentID, r_name AS concept FROM region
    UNION ALL SELECT n_nationkey + 100, n_regionkey + 1, n_name FROM nation
    UNION ALL SELECT s_suppkey + 1000, s_nationkey + 100, s_name FROM supplier
"""
TITLE = "array_to_string(list_transform(string_split(regexp_replace(regexp_replace(lower({0}), '(\\p{{L}}+)', chr(1) || '\\1', 'g'), chr(1) || '(\\p{{L}}+)', chr(1) || '\\1', 'g'), chr(1)), lambda p: upper(p[1]) || p[2:]), '')"


def polynomial(terms: tuple[tuple[int, int, float], ...], x: str, y: str) -> str:
    return " + ".join("*".join([f"({f!r})::DOUBLE", *[x] * p, *[y] * q]) for p, q, f in terms)


def bm25(rows: str, terms: str) -> str:
    """Rows (id, term, size) with one row for each occurrence; the terms that are asked for."""
    return f"""
        r AS ({rows}),
        size AS (SELECT id, max(size) AS size FROM r GROUP BY id),
        total AS (SELECT count(*) AS n, avg(size) AS mean FROM size),
        tf AS (SELECT id, term, count(*) AS tf FROM r WHERE term IN ({terms}) GROUP BY id, term),
        df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
        hits AS (SELECT tf.id, sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * size / mean))) AS score
                 FROM tf JOIN df USING (term) JOIN size USING (id) CROSS JOIN total GROUP BY tf.id)
    """


WORDS = "list_filter(regexp_split_to_array(lower(coalesce({0}, '')), '[^\\p{{L}}\\p{{N}}]+'), lambda t: t <> '')"

ORACLES: dict[str, str] = {
    "coalesce_chain": """
        SELECT c_custkey, coalesce(max(o_orderpriority), any_value(c_mktsegment)) AS label, 'constant' AS fixed
        FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey
    """,
    "harmonised_entities": """
        SELECT 'Verkoper' AS soort, s_suppkey AS number, s_name AS name, s_nationkey::BIGINT AS nation, NULL AS segment FROM supplier
        UNION ALL SELECT 'Koper', c_custkey, c_name, c_nationkey::BIGINT, 'known' FROM customer
    """,
    "table_routing": "SELECT p_partkey, p_type FROM part WHERE regexp_matches(p_type, 'econ|^s', 'i') AND NOT regexp_matches(p_type, 'standard', 'i')",
    "drop_sentinels": """
        SELECT nullif(o_orderstatus, 'F') AS o_orderstatus, count(nullif(o_orderpriority, '5-LOW')) AS priorities, count(*) AS n FROM orders GROUP BY 1
    """,
    "code_rewrite": """
        SELECT CASE WHEN o_orderpriority LIKE '1-%' OR o_orderpriority LIKE '2-%' THEN 'HIGH'
                    WHEN regexp_matches(o_orderpriority, '^[345]-') THEN 'LATER' ELSE o_orderpriority END AS code, count(*) AS n
        FROM orders GROUP BY 1
    """,
    "ui_filters": """
        SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders
        WHERE o_orderstatus IN ('O', 'F') AND o_orderpriority NOT LIKE '1-%' AND lower(o_orderpriority) LIKE '%h%' AND o_totalprice > 1000 AND o_custkey <> 1
    """,
    "ui_filters_each": """
        WITH o AS (SELECT *, nullif(o_orderpriority, '5-LOW') AS p FROM orders),
        n AS (SELECT {'equal': count(*) FILTER (o_orderstatus = 'O'), 'not_equal': count(*) FILTER (p <> '1-URGENT'), 'starts_with': count(*) FILTER (p ILIKE '2-h%'), 'not_starts_with': count(*) FILTER (p NOT ILIKE '2-h%'),
                      'ends_with': count(*) FILTER (p ILIKE '%high'), 'not_ends_with': count(*) FILTER (p NOT ILIKE '%high'), 'contains': count(*) FILTER (p ILIKE '%edi%'), 'not_contains': count(*) FILTER (p NOT ILIKE '%edi%'),
                      'greater': count(*) FILTER (o_totalprice > 200000), 'smaller': count(*) FILTER (o_totalprice < 200000), 'in': count(*) FILTER (p IN ('2-HIGH', '3-MEDIUM')), 'not_in': count(*) FILTER (p NOT IN ('2-HIGH', '3-MEDIUM')),
                      'not_in_or_missing': count(*) FILTER (p IS NULL OR p NOT IN ('2-HIGH', '3-MEDIUM')), 'exists': count(p), 'relation': count(*) FILTER (o_custkey = 7), 'not_relation': count(*) FILTER (o_custkey <> 7),
                      'function': count(*) FILTER (o_orderstatus = 'F'), 'matches': count(*) FILTER (p = '3-MEDIUM')} AS s FROM o),
        w AS (SELECT unnest(s) FROM n)
        SELECT name AS filter, value AS n FROM (UNPIVOT w ON COLUMNS(*) INTO NAME name VALUE value)
    """,
    "relation_filter": "SELECT p_partkey, p_name FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_suppkey = 3)",
    "discriminator_view": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'P'",
    "material_validation": """
        WITH allowed AS (SELECT DISTINCT p_brand, p_size FROM part WHERE p_size < 20 AND p_brand < 'Brand#3')
        SELECT p_brand AS kind, count(*) AS n FROM part
        WHERE p_brand IN (SELECT p_brand FROM allowed) AND (p_brand, p_size) NOT IN (SELECT p_brand, p_size FROM allowed) GROUP BY 1
    """,
    "key_builder": """
        WITH l AS (SELECT *, CASE WHEN l_linenumber <> 2 THEN l_partkey END AS part, CASE WHEN l_linenumber <> 3 THEN l_suppkey END AS supp FROM lineitem)
        SELECT l_orderkey, l_linenumber, 'P' || l_orderkey || coalesce('P' || part, '') || 'V' || supp AS key,
               'P' || l_orderkey || (CASE WHEN l_returnflag = 'R' THEN 'P' || part ELSE '' END) || 'V' || l_linenumber AS key_vondst
        FROM l
    """,
    "project_code_normalise": """
        SELECT c_custkey, upper(substr(c_mktsegment, 1, 2)) || lpad(c_custkey::VARCHAR, greatest(3, length(c_custkey::VARCHAR))::INT, '0') AS projectcd FROM customer
    """,
    "label_clean": f"""
        SELECT p_partkey, {TITLE.format("trim(replace(' ?' || p_type || '-' || p_name || '? ', '?', ''))")} AS label FROM part
    """,
    "int_coerce": """
        SELECT p_partkey, CASE WHEN p_partkey % 3 <> 0 THEN trunc(p_retailprice::DECIMAL(12, 2)::DOUBLE)::BIGINT END AS forced,
               CASE WHEN p_partkey % 3 = 0 THEN p_brand ELSE p_size::VARCHAR END AS kept
        FROM part
    """,
    "bool_coerce": """
        SELECT CASE WHEN o_orderkey % 11 <> 0 THEN (o_orderkey % 7 IN (0, 2, 3, 4))::BIGINT END AS flag, count(*) AS n FROM orders GROUP BY 1
    """,
    "date_coerce": "SELECT o_orderkey, CASE WHEN o_orderkey % 4 <> 3 THEN strftime(o_orderdate, '%Y-%m-%d') END AS day FROM orders",
    "rd_to_wgs": f"""
        WITH c AS (SELECT c_custkey, ((20000 + c_custkey % 250000)::DOUBLE - {geo.X0}) * 1e-5::DOUBLE AS dx, ((310000 + c_custkey * 7 % 300000)::DOUBLE - {geo.Y0}) * 1e-5::DOUBLE AS dy FROM customer)
        SELECT c_custkey, round(({polynomial(geo.TO_PHI, "dx", "dy")}) / 3600 + {geo.PHI0}::DOUBLE, 6) AS lat,
               round(({polynomial(geo.TO_LAMBDA, "dx", "dy")}) / 3600 + {geo.LAMBDA0}::DOUBLE, 6) AS lon FROM c
    """,
    "located_points": f"""
        WITH c AS (SELECT c_custkey, c_custkey % 5 <> 0 AND c_custkey % 7 <> 0 AS valid, ((20000 + c_custkey % 250000)::DOUBLE - {geo.X0}) * 1e-5::DOUBLE AS dx, ((310000 + c_custkey * 7 % 300000)::DOUBLE - {geo.Y0}) * 1e-5::DOUBLE AS dy FROM customer)
        SELECT c_custkey, valid, CASE WHEN valid THEN 'Point' END AS type, CASE WHEN valid THEN round(({polynomial(geo.TO_PHI, "dx", "dy")}) / 3600 + {geo.PHI0}::DOUBLE, 6) END AS lat,
               CASE WHEN valid THEN round(({polynomial(geo.TO_LAMBDA, "dx", "dy")}) / 3600 + {geo.LAMBDA0}::DOUBLE, 6) END AS lon FROM c
    """,
    "toponym_names": f"SELECT p_partkey, CASE WHEN p_partkey % 3 = 2 THEN p_name ELSE {TITLE.format('p_type')} END AS name FROM part",
    "default_values": """
        SELECT CASE WHEN o_orderkey % 4 IN (0, 1) THEN 'Onbekend' ELSE coalesce(nullif(o_orderpriority, ''), 'Onbekend') END AS priority, count(*) AS n FROM orders GROUP BY 1
    """,
    "wgs_to_rd": f"""
        WITH c AS (SELECT c_custkey, (51.0::DOUBLE + (c_custkey % 1000)::DOUBLE / 500 - {geo.PHI0}::DOUBLE) * 0.36::DOUBLE AS a, (4.0::DOUBLE + (c_custkey % 900)::DOUBLE / 400 - {geo.LAMBDA0}::DOUBLE) * 0.36::DOUBLE AS b FROM customer)
        SELECT c_custkey, round({polynomial(geo.TO_X, "a", "b")} + {geo.X0}, 2) AS x, round({polynomial(geo.TO_Y, "a", "b")} + {geo.Y0}, 2) AS y FROM c
    """,
    "year_range_quarters": """
        WITH o AS (
            SELECT o_orderkey, o_orderkey % 3 AS kind, o_orderkey % 12 + 8 AS century, substr('abcd', (o_orderkey % 4 + 1)::INT, 1) AS letter, o_orderkey % 4 AS q,
                   ['XVII', 'XIV', 'IX', 'XIX', 'XVI'][(o_orderkey % 5 + 1)::INT] AS numeral, [17, 14, 9, 19, 16][(o_orderkey % 5 + 1)::INT] AS value, year(o_orderdate) AS y, o_orderkey % 9 AS more
            FROM orders
        )
        SELECT o_orderkey, CASE kind WHEN 0 THEN century || letter WHEN 1 THEN y || '-' || (y + more) ELSE numeral || letter END AS code,
               (CASE kind WHEN 0 THEN 100 * century + 25 * q WHEN 1 THEN y ELSE 100 * value + 25 * q END)::BIGINT AS vanaf,
               (CASE kind WHEN 0 THEN 100 * century + 25 * q + 25 WHEN 1 THEN y + more ELSE 100 * value + 25 * q + 25 END)::BIGINT AS tot
        FROM o
    """,
    "filename_classifier": """
        WITH o AS (SELECT o_orderkey, o_orderkey % 7 AS k, ltrim(o_custkey::VARCHAR, '0') AS c FROM orders)
        SELECT o_orderkey, ['Foto', 'Tekening', 'Foto', 'Rapport', 'Tekening', 'Rapport', 'Bestand'][k + 1] AS soort, ['H', 'C', 'G', 'R', 'T', 'R', 'N'][k + 1] AS fototype,
               ['Objectfoto', 'Overzichtstekeningen', 'Opgravingsfoto', 'Archeologische_Rapportage', 'Overige_tekening', 'Overige_Rapportage', 'Bestand_Overige'][k + 1] AS bestandsoort,
               CASE k WHEN 0 THEN 'DB10' WHEN 1 THEN 'DC' || (o_orderkey % 90 + 10) WHEN 2 THEN 'DC20' WHEN 4 THEN 'DB33' WHEN 6 THEN 'DB33' END AS projectcd,
               CASE WHEN k = 0 THEN c END AS vondstnr, CASE k WHEN 0 THEN '1' WHEN 2 THEN c || 'b' END AS fotonr,
               CASE k WHEN 1 THEN 'C' || lpad((o_orderkey % 50)::VARCHAR, 3, '0') WHEN 4 THEN '/DB33/L Fotos/Glas/overzicht tekening.tif' END AS tekeningcd,
               CASE k WHEN 3 THEN 'DAR' || lpad((o_orderkey % 90 + 10)::VARCHAR, 3, '0') WHEN 5 THEN '/DB33/L Fotos/Glas/brief.docx' END AS rapportnr,
               CASE WHEN k = 0 THEN 'Glas' END AS artefactsoort
        FROM o
    """,
    "photo_sorts": """
        SELECT c_custkey, CASE WHEN c_custkey % 5 = 1 THEN 'Velddocument' WHEN c_custkey % 5 = 0 OR c_mktsegment LIKE 'B%' OR c_mktsegment LIKE 'H%' THEN 'Objectfoto' WHEN c_mktsegment LIKE 'A%' OR c_mktsegment LIKE 'G%' THEN 'Opgravingsfoto' ELSE 'Overige_afbeelding' END AS fotosoort FROM customer
    """,
    "first_known": """
        SELECT CASE WHEN l_partkey % 2 <> 0 THEN '1' WHEN l_suppkey % 3 = 1 THEN 'b' ELSE l_returnflag END AS value, count(*) AS n FROM lineitem GROUP BY 1
    """,
    "drawing_codes": """
        SELECT c_custkey, substr(c_mktsegment, 1, 1) || CASE WHEN c_custkey % 7 = 0 THEN c_custkey || 'x' ELSE lpad(c_custkey::VARCHAR, greatest(3, length(c_custkey::VARCHAR))::INT, '0') END AS tekeningcd FROM customer
    """,
    "artefact_kinds": """
        SELECT ['Aardewerk', 'Glas', 'Glas', 'Kleipijp', 'Aardewerk', NULL, NULL][(p_partkey % 7 + 1)::INT] AS kind, count(*) AS n FROM part GROUP BY 1
    """,
    "table_objects": """
        SELECT CASE WHEN p_type LIKE 'ECON%' THEN 'A' WHEN p_type LIKE 'SMALL%' OR p_type LIKE 'STAND%' THEN 'B' ELSE 'Geen' END AS object, count(*) AS n FROM part GROUP BY 1
    """,
    "report_numbers": """
        SELECT c_custkey, CASE c_custkey % 3 WHEN 2 THEN 'zondernr' ELSE (CASE c_custkey % 3 WHEN 0 THEN 'dar' ELSE 'DAN' END) || lpad(c_custkey::VARCHAR, greatest(3, length(c_custkey::VARCHAR))::INT, '0') END AS rapportnr FROM customer
    """,
    "range_labels": """
        SELECT p_partkey, CASE WHEN p_size % 4 > 0 AND p_size % 3 > 0 THEN (p_size % 4) || ' - ' || (p_size % 3) WHEN p_size % 4 > 0 THEN (p_size % 4) || ' -' WHEN p_size % 3 > 0 THEN '- ' || (p_size % 3) ELSE '' END AS label FROM part
    """,
    "generate_missing": """
        SELECT o_orderkey AS nr, 'C' || o_orderkey AS key, 'Klant' AS soort, 'Gegenereerd' AS herkomst FROM orders WHERE o_orderkey <> 0 AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
    """,
    "set_reference": """SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_nationkey END::BIGINT AS nationID FROM customer""",
    "unique_match_only": """
        SELECT p_brand || '|' || p_size AS want, CASE WHEN count(*) = 1 THEN max(p_partkey) END AS partID FROM part GROUP BY p_brand, p_size
    """,
    "fallback_reference": """
        SELECT o_orderkey, coalesce(max(l_partkey) FILTER (l_linenumber = 2), CASE WHEN count(l_partkey) = 1 THEN max(l_partkey) END) AS partID
        FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey
    """,
    "update_join": """
        WITH n AS (SELECT l_orderkey, arg_max({'s': CASE WHEN l_linenumber <> 3 THEN l_returnflag END}, l_linenumber::BIGINT * 1000000000000000 + l_partkey * 100000000 + l_suppkey) AS new FROM lineitem WHERE l_linenumber > 2 GROUP BY l_orderkey)
        SELECT o_orderkey, CASE WHEN n.l_orderkey IS NOT NULL THEN new.s ELSE o_orderstatus END AS o_orderstatus, o_orderpriority FROM orders LEFT JOIN n ON l_orderkey = o_orderkey
    """,
    "photo_merge": """
        SELECT c_custkey AS nr, c_name || '.jpg' AS fileName, CASE WHEN c_acctbal >= 0 THEN 'A' || c_custkey END AS abcd_nr,
               CASE WHEN c_acctbal >= 0 AND c_mktsegment <> 'BUILDING' THEN c_name END AS omschrijving FROM customer
    """,
    "sample_project_codes": """
        SELECT s_suppkey, 'P' || s_suppkey % 40 AS project, CASE WHEN s_suppkey % 40 < 25 THEN 'P' || (s_suppkey % 40 + 10) WHEN s_suppkey % 40 < 35 THEN 'P' || s_suppkey % 40 ELSE 'Unknown' END AS projectcd FROM supplier
    """,
    "outer_join_counts": "SELECT n_name, count(s_suppkey) AS n_finds FROM supplier FULL JOIN nation ON s_nationkey = n_nationkey WHERE n_regionkey < 4 GROUP BY n_name",
    "map_markers": """
        SELECT n_name, CASE WHEN count(s_suppkey) > 0 THEN 8 ELSE 4 END::BIGINT AS radius, CASE WHEN count(s_suppkey) > 0 THEN 'red' ELSE 'blue' END AS color
        FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey WHERE n_regionkey < 4 GROUP BY n_name
    """,
    "merge_specific": """
        WITH g AS (SELECT l_orderkey, arg_min({'status': CASE WHEN l_linestatus = 'O' THEN l_returnflag END, 'part': l_partkey}, l_linenumber::BIGINT * 1000000000000000 + l_partkey * 100000000 + l_suppkey) AS first FROM lineitem GROUP BY l_orderkey)
        SELECT o_orderkey AS k, coalesce(first.status, o_orderstatus) AS status, first.part AS part FROM orders LEFT JOIN g ON l_orderkey = o_orderkey
    """,
    "close_match_levenshtein": """
        WITH a AS (SELECT n_name AS name FROM nation UNION SELECT r_name FROM region)
        SELECT name, n_name AS match, levenshtein(name, n_name) AS distance FROM a JOIN nation ON levenshtein(name, n_name) < 4
    """,
    "merge_duplicates": """
        SELECT user_id AS u, event_type, arg_max(value, event_id) FILTER (event_id % 3 <> 0 AND value IS NOT NULL) AS value,
               floor(epoch(arg_max(ts, event_id) FILTER (event_id % 2 = 0 AND ts IS NOT NULL)))::BIGINT AS ts, max(event_id) AS _seq
        FROM events WHERE user_id IS NOT NULL AND event_type IS NOT NULL GROUP BY user_id, event_type
    """,
    "lineage_set": """
        SELECT l_orderkey, string_agg(s, ',' ORDER BY s) AS lineage, count(*) AS brondata_count FROM (SELECT DISTINCT l_orderkey, l_returnflag || ':' || l_linestatus AS s FROM lineitem) GROUP BY l_orderkey
    """,
    "uniqueness_flags": """
        SELECT l_suppkey, count(p) = count(DISTINCT p) AS is_unique FROM (SELECT l_suppkey, CASE WHEN l_quantity > 5 THEN l_partkey END AS p FROM lineitem) GROUP BY l_suppkey
    """,
    "multi_parent_having": "SELECT l_partkey, count(DISTINCT l_suppkey) AS n_parents FROM lineitem GROUP BY l_partkey HAVING count(DISTINCT l_suppkey) > 1",
    "denormalised_counts": "SELECT c_custkey, count(o_orderkey) AS n_orders FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey",
    "chart_counts": "SELECT o_orderstatus, o_orderpriority, count(o_orderkey) AS n FROM orders GROUP BY ALL",
    "next_numbers": "SELECT coalesce(max(o_orderkey), 0) + 1 AS next_number FROM orders",
    "two_level_rollup": """
        WITH a AS (SELECT (l_suppkey % 10)::VARCHAR AS supp, l_returnflag, count(*) AS n FROM lineitem GROUP BY ALL)
        SELECT l_returnflag, string_agg(supp, ',' ORDER BY supp) AS projects, sum(n)::BIGINT AS n_rows, count(*) AS n_projects, 'loaded' AS stage FROM a GROUP BY l_returnflag
    """,
    "fill_rate_unpivot": """
        WITH w AS (SELECT c_mktsegment, count(*) AS n_rows, count(o_orderkey) AS a, count(o_orderdate) AS b, count(c_custkey) AS c FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY 1),
        l AS (SELECT c_mktsegment, 'o_orderkey' AS attribute, a AS filled, n_rows FROM w UNION ALL SELECT c_mktsegment, 'o_orderdate', b, n_rows FROM w UNION ALL SELECT c_mktsegment, 'c_custkey', c, n_rows FROM w)
        SELECT *, round_even(100.0::DOUBLE * filled / n_rows, 0) AS fill_percent FROM l
    """,
    "data_profile": " UNION ALL ".join(
        f"SELECT '{c}' AS attribute, count(*) AS n_rows, count(*) - count({c}) AS nulls, count(DISTINCT {c}) AS n_distinct, min({c})::VARCHAR AS low, max({c})::VARCHAR AS high FROM orders" for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    ),
    "pushed_lists": "SELECT p_brand, array_to_string(list_sort(list(p_size)), ',') AS items, count(*) AS n, count(*) AS n_items FROM part GROUP BY p_brand",
    "flattened_lists": "SELECT p_brand, string_agg(w, ',' ORDER BY w) AS items FROM (SELECT DISTINCT p_brand, unnest(string_split(p_type, ' ')) AS w FROM part) GROUP BY p_brand",
    "longest_text": "SELECT p_brand, p_name AS longest FROM part QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY length(p_name) DESC, p_name) = 1",
    "frequency_table": "SELECT event_type, count(*) AS n FROM events GROUP BY 1",
    "stage_reconciliation": """
        SELECT source, count(*) AS staged, count(*) FILTER (lang = 'en') AS single, count(*) FILTER (n_chars > 1000) AS clean, count(*) FILTER (n_chars > 20000) AS loaded, count(*) FILTER (lang <> 'fr') AS meta FROM documents GROUP BY source
    """,
    "stage_mismatch": """
        WITH a AS (SELECT source, lang, count(*) AS n FROM documents GROUP BY ALL), b AS (SELECT source, lang, count(*) AS n FROM documents WHERE n_chars < 8000 GROUP BY ALL)
        (SELECT *, 'left' AS side FROM (SELECT * FROM a EXCEPT SELECT * FROM b)) UNION ALL (SELECT *, 'right' FROM (SELECT * FROM b EXCEPT SELECT * FROM a))
    """,
    "data_meta_status": """
        SELECT coalesce(c_custkey, s.nr) AS nr, CASE WHEN s.nr IS NULL THEN 'data' WHEN c_custkey IS NULL THEN 'meta' ELSE 'both' END AS status
        FROM customer FULL JOIN (SELECT s_suppkey * 40 AS nr FROM supplier) s ON c_custkey = s.nr
    """,
    "surrogate_key": "SELECT c_mktsegment AS soort, c_custkey, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_custkey) - 1 AS ID FROM customer",
    "page_topk": "SELECT o_orderkey, o_custkey, o_orderpriority FROM orders ORDER BY o_orderpriority ASC NULLS LAST, o_custkey DESC NULLS FIRST, o_orderkey LIMIT 25 OFFSET 75",
    "keep_first": "SELECT o_custkey, min(o_orderkey) AS o_orderkey FROM orders GROUP BY o_custkey",
    "union_missing_columns": "SELECT s_suppkey AS nr, s_name AS name, NULL AS segment FROM supplier UNION ALL SELECT c_custkey, NULL, c_mktsegment FROM customer",
    "set_intersect": "SELECT c_nationkey AS nr FROM customer INTERSECT SELECT s_nationkey FROM supplier",
    "set_difference": """SELECT o_orderkey AS nr FROM orders EXCEPT SELECT l_orderkey FROM lineitem""",
    "file_selection": """
        WITH p AS (SELECT '/d' || page_id // 6 || '/n' || page_id // 3 % 2 || CASE page_id % 3 WHEN 0 THEN '.tif' WHEN 1 THEN '.jpg' ELSE '.exe' END AS f FROM pages),
        a AS (SELECT f FROM p UNION ALL SELECT replace(f, 'n0.tif', 'n2.tif') FROM p WHERE f LIKE '%0.tif'),
        j AS (SELECT replace(f, '.jpg', '') AS stem FROM a WHERE f LIKE '%.jpg')
        SELECT f AS fullFileName, regexp_extract(f, '[^/]*$') AS fileName, regexp_replace(f, '/[^/]*$', '') AS directory, right(f, 4) AS fileType FROM a
        WHERE f NOT LIKE '%.exe' AND f NOT LIKE '%d1%' AND NOT (f LIKE '%.tif' AND replace(f, '.tif', '') IN (SELECT stem FROM j))
    """,
    "upsert_keep_existing": """
        SELECT l_orderkey AS nr, sum(l_quantity::BIGINT)::BIGINT AS value FROM lineitem GROUP BY l_orderkey
        UNION ALL SELECT o_orderkey, floor(o_totalprice)::BIGINT FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
    """,
    "upsert_replace": """
        SELECT l_orderkey AS nr, sum(l_quantity::BIGINT)::BIGINT AS value FROM lineitem GROUP BY l_orderkey
        UNION ALL SELECT o_orderkey, floor(o_totalprice)::BIGINT FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
    """,
    "upsert_set": """
        WITH n AS (
            SELECT l_orderkey AS nr, arg_max(l_quantity::BIGINT, l_linenumber::BIGINT * 1000000000000000 + l_partkey * 100000000 + l_suppkey) FILTER (l_returnflag <> 'R') AS value, max(l_linenumber::BIGINT * 1000000000000000 + l_partkey * 100000000 + l_suppkey) AS line
            FROM lineitem GROUP BY l_orderkey
        )
        SELECT coalesce(o_orderkey, nr) AS nr, coalesce(value, floor(o_totalprice))::BIGINT AS value, o_orderstatus AS status, line FROM orders FULL JOIN n ON o_orderkey = nr
    """,
    "load_coercion": """
        SELECT c_custkey, trunc(c_acctbal)::BIGINT AS c_acctbal, CASE WHEN c_custkey % 5 <> 0 THEN substr(c_name, 1, 12) ELSE '' END AS c_name, c_mktsegment FROM customer
    """,
    "explode_lineage": "SELECT DISTINCT l_partkey, l_returnflag, l_linestatus FROM lineitem",
    "json_recordset": "SELECT n_nationkey::BIGINT AS pk, n_name AS name FROM nation",
    "nested_map_filter": """
        SELECT o_orderkey, concat_ws(',', 'o_orderkey', CASE WHEN o_orderpriority <> '5-LOW' THEN 'o_orderpriority' END, CASE WHEN o_orderstatus <> 'F' THEN 'o_orderstatus' END) AS names FROM orders
    """,
    "hierarchy_descendants": f"""
        WITH RECURSIVE t AS ({TREE}), b AS (SELECT primary_key, concept, 0 AS depth FROM t WHERE concept = 'ASIA' UNION ALL SELECT t.primary_key, t.concept, depth + 1 FROM t JOIN b ON t.parentID = b.primary_key)
        SELECT primary_key, concept, depth::BIGINT AS depth FROM b
    """,
    "hierarchy_filter": f"""
        WITH RECURSIVE t AS ({TREE}), b AS (SELECT primary_key FROM t WHERE concept = 'EUROPE' UNION SELECT t.primary_key FROM t JOIN b ON t.parentID = b.primary_key)
        SELECT c_custkey, c_nationkey::BIGINT + 100 AS ref FROM customer WHERE c_nationkey + 100 IN (SELECT primary_key FROM b)
    """,
    "hierarchy_intervals": f"""
        WITH RECURSIVE t AS ({TREE}),
        p AS (SELECT primary_key AS k, [primary_key] AS path FROM t WHERE parentID NOT IN (SELECT primary_key FROM t)
              UNION ALL SELECT primary_key, list_append(path, primary_key) FROM t JOIN p ON parentID = k),
        n AS (SELECT k, path, row_number() OVER (ORDER BY path) AS first FROM p),
        below AS (SELECT unnest(path) AS k, count(*) AS size FROM p GROUP BY 1)
        SELECT k AS primary_key, first::BIGINT AS first, (first + size - 1)::BIGINT AS last, (len(path) - 1)::BIGINT AS depth FROM n JOIN below USING (k)
    """,
    "hierarchy_range_filter": """
        SELECT l_suppkey + 1000 AS ref, count(*) AS n, sum(l_orderkey)::BIGINT AS orders FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey
        WHERE r_name IN ('EUROPE', 'ASIA') GROUP BY l_suppkey
    """,
    "page_stored": """
        WITH p AS (SELECT (count(*) // 2 // 25)::BIGINT AS page FROM orders), o AS (SELECT o_orderkey, o_custkey, o_orderpriority, row_number() OVER (ORDER BY o_orderpriority ASC NULLS LAST, o_custkey DESC NULLS FIRST, o_orderkey) - 1 AS place FROM orders)
        SELECT o_orderkey, o_custkey, o_orderpriority, page FROM o, p WHERE place // 25 = page
    """,
    "outline_ranges": """
        WITH a AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 500 = 0 THEN 0 WHEN o_orderkey % 10 = 0 THEN 1 ELSE 2 END AS level FROM orders),
        b AS (SELECT *, max(CASE WHEN level = 0 THEN k END) OVER w AS l0, max(CASE WHEN level = 1 THEN k END) OVER w AS l1 FROM a WINDOW w AS (ORDER BY k)),
        c AS (SELECT k, level, l0, CASE WHEN level > 0 AND l1 > coalesce(l0, -1) THEN l1 END AS l1 FROM b),
        d AS (SELECT k, list_filter([l0, l1, CASE WHEN level = 2 THEN k END], lambda x: x IS NOT NULL) AS path FROM c)
        SELECT k AS o_orderkey, array_to_string(path, '/') AS uris, CASE WHEN len(path) > 1 THEN path[-2] END::VARCHAR AS parent_uri FROM d
    """,
    "hierarchy_children": f"SELECT primary_key, concept FROM ({TREE}) WHERE parentID = 2",
    "hierarchy_parent": f"WITH t AS ({TREE}) SELECT t.primary_key, t.concept, p.concept AS parent_concept FROM t LEFT JOIN t p ON t.parentID = p.primary_key",
    "outline_ancestors": """
        WITH a AS (SELECT p_partkey AS k, p_brand, CASE WHEN p_partkey % 10 = 0 THEN 0 WHEN p_partkey % 3 = 0 THEN 1 ELSE 2 END AS level FROM part),
        b AS (SELECT *, max(CASE WHEN level = 0 THEN k END) OVER w AS l0, max(CASE WHEN level = 1 THEN k END) OVER w AS l1 FROM a WINDOW w AS (PARTITION BY p_brand ORDER BY k)),
        c AS (SELECT k, level, l0, CASE WHEN level > 0 AND l1 > coalesce(l0, -1) THEN l1 END AS l1 FROM b),
        d AS (SELECT k, list_filter([l0, l1, CASE WHEN level = 2 THEN k END], lambda x: x IS NOT NULL) AS path FROM c)
        SELECT k AS p_partkey, array_to_string(path, '/') AS uris, CASE WHEN len(path) > 1 THEN path[-2] END::VARCHAR AS parent_uri FROM d
    """,
    "fulltext_bm25": f"""
        WITH w AS (SELECT doc_id AS id, {WORDS.format("text")} AS w FROM documents),
        {bm25("SELECT id, unnest(w) AS term, len(w) AS size FROM w UNION ALL SELECT id, NULL, 0 FROM w WHERE false", "'the', 'license'")}
        SELECT id AS doc_id, round(score, 6) AS score FROM hits
    """,
    "fulltext_boolean": """
        SELECT p_partkey FROM part WHERE regexp_matches(p_type, '\\beco', 'i') AND NOT regexp_matches(p_type, '\\bred\\b', 'i') AND NOT regexp_matches(p_name, '\\bred\\b', 'i')
    """,
    "fulltext_top": f"""
        WITH w AS (SELECT doc_id AS id, {WORDS.format("text")} AS w FROM documents WHERE lang = 'en'),
        {bm25("SELECT id, unnest(w) AS term, len(w) AS size FROM w", "'license'")}
        SELECT id AS primary_key, round(score, 6) AS score, (6 * len(list_filter(w, lambda t: t = 'license')))::BIGINT AS marks
        FROM hits JOIN w USING (id) ORDER BY hits.score DESC, id LIMIT 10
    """,
    "postings_update": f"""
        WITH w AS (SELECT p_partkey, unnest({WORDS.format("CASE WHEN p_partkey % 10 = 0 THEN p_type || ' nieuw nieuw' ELSE p_type END")}) AS term FROM part)
        SELECT term, count(DISTINCT p_partkey) AS n, count(*) AS tf FROM w GROUP BY term
    """,
    "dating_precedence": "SELECT l_orderkey, l_linenumber, coalesce(nullif(l_partkey % 3, 0), nullif(l_suppkey % 2, 0), l_quantity::BIGINT) AS vanaf FROM lineitem",
    "dating_denormalised": """
        SELECT l_orderkey AS vondstID, l_linenumber::BIGINT AS nr, l_partkey AS artefactdatering_vanaf, l_suppkey AS artefactdatering_tot, year(o_orderdate) AS vondstdatering_vanaf, month(o_orderdate) AS vondstdatering_tot,
               c_nationkey::BIGINT AS spoordatering_vanaf, CASE WHEN c_custkey IS NOT NULL THEN 7 END::BIGINT AS spoordatering_tot, l_partkey AS datering_vanaf, l_suppkey AS datering_tot
        FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey LEFT JOIN customer ON c_custkey = o_custkey
    """,
    # a wildcard stands for each of its words; the phrase's rarity is the sum of its words'
    "fulltext_phrase": r"""
        WITH w AS (SELECT p_partkey AS id, list_filter(regexp_split_to_array(lower(p_type), '[^\p{L}\p{N}]+'), lambda t: t <> '') AS w FROM part),
        size AS (SELECT id, len(w) AS size FROM w WHERE len(w) > 0),
        total AS (SELECT count(*) AS n, avg(size) AS mean FROM size),
        t AS (SELECT id, unnest(w) AS term FROM w),
        p AS (SELECT id, len(list_filter(range(1, len(w)), lambda i: w[i] = 'anodized' AND w[i + 1] = 'steel')) AS good, len(list_filter(range(1, len(w)), lambda i: w[i] = 'plated' AND w[i + 1] = 'tin')) AS bad FROM w),
        tf AS (SELECT id, term, count(*) AS tf FROM t WHERE starts_with(term, 'promo') GROUP BY ALL UNION ALL SELECT id, '#', good FROM p WHERE good > 0),
        df AS (SELECT term, count(DISTINCT id) AS df FROM t GROUP BY term),
        rare AS (SELECT term, ln(1 + (n - df + 0.5) / (df + 0.5)) AS r FROM df, total),
        r AS (SELECT term, r FROM rare UNION ALL SELECT '#', sum(r) FROM rare WHERE term IN ('anodized', 'steel'))
        SELECT id AS p_partkey, round(sum(r * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * size / mean))), 6) AS score
        FROM tf JOIN r USING (term) JOIN size USING (id) JOIN p USING (id), total WHERE bad = 0 GROUP BY id
    """,
    "fulltext_segments": r"""
        WITH d AS (
            SELECT doc_id AS id, CASE WHEN lang <> 'en' THEN 'the license ' || text ELSE text END AS text FROM documents
            WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 0)
        ),
        w AS (SELECT id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda t: t <> '') AS w FROM d),
        size AS (SELECT id, len(w) AS size FROM w WHERE len(w) > 0),
        total AS (SELECT count(*) AS n, avg(size) AS mean FROM size),
        p AS (SELECT id, len(list_filter(range(1, len(w)), lambda i: w[i] = 'the' AND w[i + 1] = 'license')) AS good, len(list_filter(w, lambda x: x = 'software')) AS other FROM w),
        tf AS (SELECT id, 'software' AS term, other AS tf FROM p WHERE other > 0 UNION ALL SELECT id, '#', good FROM p WHERE good > 0),
        df AS (SELECT x.term, count(*) AS df FROM w, (VALUES ('the'), ('license'), ('software')) x(term) WHERE list_contains(w, x.term) GROUP BY x.term),
        rare AS (SELECT term, ln(1 + (n - df + 0.5) / (df + 0.5)) AS r FROM df, total),
        r AS (SELECT term, r FROM rare UNION ALL SELECT '#', sum(r) FROM rare WHERE term IN ('the', 'license'))
        SELECT id AS doc_id, round(sum(r * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * size / mean))), 6) AS score FROM tf JOIN r USING (term) JOIN size USING (id), total GROUP BY id
    """,
    "bucket_upserts": """
        WITH c AS (
            SELECT o_orderkey AS nr, floor(o_totalprice)::BIGINT AS value, o_orderstatus AS status, 0::BIGINT AS line, false AS gone FROM orders
            UNION ALL SELECT l_orderkey, l_quantity::BIGINT, CASE WHEN l_linestatus = 'O' THEN 'L' END, l_linenumber::BIGINT * 1000000000000000 + l_partkey * 100000000 + l_suppkey, l_returnflag = 'R' FROM lineitem
        ),
        g AS (SELECT *, max(CASE WHEN gone THEN line END) OVER (PARTITION BY nr) AS until FROM c),
        t AS (
            SELECT nr, arg_max(value, line) FILTER (value IS NOT NULL) AS value, arg_max(status, line) FILTER (status IS NOT NULL) AS status, max(line) AS line
            FROM g WHERE until IS NULL OR line > until GROUP BY nr
        )
        SELECT *, count(*) OVER (PARTITION BY status) AS status_rows FROM t
    """,
    "published_tables": """
        WITH l AS (SELECT l_orderkey AS nr, sum(l_quantity::BIGINT)::BIGINT AS value FROM lineitem GROUP BY l_orderkey)
        SELECT o_orderkey AS nr, floor(o_totalprice)::BIGINT AS value, value * 2 AS doubled, value AS first FROM orders LEFT JOIN l ON nr = o_orderkey
    """,
    "export_round_trip": """
        WITH t AS (
            SELECT 'DC1' AS projectcd, 'documents' AS mdbfile, doc_id AS nr, (CASE WHEN trim(coalesce(lang, '')) <> '' THEN 1 ELSE 0 END) + 1 AS n, replace(text, chr(13) || chr(10), chr(10)) AS text FROM documents
            UNION ALL SELECT 'DC2', 'orders', o_orderkey, (CASE WHEN trim(coalesce(o_orderstatus, '')) <> '' THEN 1 ELSE 0 END) + 1, o_orderpriority FROM orders
        ),
        v AS (SELECT projectcd, mdbfile, nr, n, CASE WHEN trim(text) <> '' THEN text END AS text FROM t)
        SELECT projectcd, mdbfile, nr, (n + (text IS NOT NULL)::INTEGER)::BIGINT AS n_values, length(text) AS n_chars, md5(text) AS digest FROM v
    """,
    "references_one_pass": """
        WITH one AS (SELECT p_brand || '|' || p_size AS label, min(p_partkey) AS partID FROM part GROUP BY label HAVING count(*) = 1)
        SELECT 'N' AS soort, n_nationkey::BIGINT AS nr, NULL::BIGINT AS nationID, NULL::BIGINT AS customerID, NULL::BIGINT AS orderID, NULL::BIGINT AS supplierID, NULL::BIGINT AS partID FROM nation
        UNION ALL SELECT 'C', c_custkey, n_nationkey, NULL, NULL, NULL, NULL FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
        UNION ALL SELECT 'S', s_suppkey, n_nationkey, NULL, NULL, NULL, NULL FROM supplier LEFT JOIN nation ON s_acctbal >= 0 AND s_nationkey = n_nationkey
        UNION ALL SELECT 'P', p_partkey, NULL, NULL, NULL, NULL, NULL FROM part
        UNION ALL SELECT 'O', o_orderkey, NULL, c_custkey, NULL, NULL, NULL FROM orders LEFT JOIN customer ON o_custkey = c_custkey
        UNION ALL SELECT 'L', l_linenumber::BIGINT * 1000000000000000 + l_partkey * 100000000 + l_suppkey, NULL, NULL, o_orderkey, s_suppkey, one.partID
        FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN one ON one.label = p_brand || '|' || p_size
    """,
    "folder_facts": """
        WITH p AS (SELECT c_custkey AS k FROM customer WHERE c_acctbal >= 0)
        SELECT o_orderkey, CASE WHEN o_custkey % 7 = 0 THEN 'eigen' WHEN b.k IS NOT NULL THEN 'C' || b.k ELSE 'C' || a.k END AS projectcd,
               CASE o_orderstatus WHEN 'F' THEN 'Objectfoto' WHEN 'O' THEN 'Opgravingsfoto' ELSE 'Velddocument' END AS fotosoort, CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS materiaal
        FROM orders LEFT JOIN p a ON a.k = o_custkey LEFT JOIN p b ON b.k = o_custkey % 100
    """,
    "key_registry": """
        WITH s AS (SELECT 'n' || s_nationkey AS soort, s_name AS _id, 'k' || s_name AS name FROM supplier),
        a AS (SELECT *, row_number() OVER (PARTITION BY soort ORDER BY name) - 1 AS nr FROM s),
        n AS (SELECT soort, count(*) AS n FROM a GROUP BY soort),
        c AS (SELECT 'n' || c_nationkey AS soort, c_name AS _id, CASE WHEN c_acctbal >= 0 THEN 'k' ELSE 'i' END || c_name AS name FROM customer)
        SELECT soort, _id, nr, nr AS first FROM a
        UNION ALL SELECT c.soort, _id, row_number() OVER (PARTITION BY c.soort ORDER BY name) - 1 + coalesce(n, 0), NULL FROM c LEFT JOIN n USING (soort)
    """,
    "export_fields": """
        SELECT p_partkey, replace(p_name, 'e', '"') || ', ' AS c0, p_partkey::VARCHAR AS c1, 'a' || chr(10) || p_type AS c2, '' AS c3, 4::BIGINT AS n FROM part
    """,
    "lookup_lists": """
        SELECT d.doc_id, coalesce(string_agg(quality || '/' || toxic, ',' ORDER BY quality, toxic) FILTER (l.doc_id IS NOT NULL), '') AS labels, count(l.doc_id) AS n
        FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id GROUP BY d.doc_id
    """,
    "nested_lists": """
        WITH e AS (SELECT l_orderkey, unnest([CASE WHEN l_returnflag <> 'N' THEN l_returnflag END, CASE WHEN l_quantity > 10 AND l_linestatus <> 'N' THEN l_linestatus END]) AS v FROM lineitem)
        SELECT l_orderkey, count(v) AS entries, coalesce(string_agg(v, ',' ORDER BY v), '') AS told FROM e GROUP BY l_orderkey
    """,
    "list_text_rows": "SELECT p_partkey, unnest(string_split(p_type || ' ' || p_size, ' ')) AS item FROM part",
    "remarks_by_group": """
        SELECT p_brand, array_to_string(list_sort(list_distinct(flatten(list(string_split(p_type, ' '))))), ',') AS items, string_agg(p_name, ',' ORDER BY p_name) AS remarks FROM part GROUP BY p_brand
    """,
    "outline_members": "SELECT p_partkey FROM part WHERE p_brand = 'Brand#13'",
    "table_types": "SELECT CASE WHEN p_size > 25 THEN 'Spijker' END AS type, count(*) AS n FROM part GROUP BY 1",
    "described_rows": """
        SELECT o_orderkey, 'Order nr ' || o_orderkey || coalesce(', klant ' || nullif(o_custkey, 1), '') || ', ' || o_orderstatus AS label, lower(o_orderstatus) || '_vondstnr' AS name FROM orders
    """,
}
