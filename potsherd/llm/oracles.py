"""SQL for DuckDB that is too long to stand among the queries."""

from __future__ import annotations

from potsherd.llm import warc as w


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def replaced(sql: str, pattern: str, by: str) -> str:
    return f"regexp_replace({sql}, {quoted(pattern)}, {quoted(by)}, 'g')"


def warc() -> str:
    def squeeze(sql: str) -> str:
        lines = replaced(replaced(sql, r"[ \t\r\f\x0B]+", " "), r" ?\n[ \n]*", "\n")
        return replaced(lines, r"\A[ \n]+|[ \n]+\z", "")

    def resolve(sql: str) -> str:
        table = "MAP {" + ", ".join(f"{quoted(k)}: {quoted(v)}" for k, v in w.ENTITIES.items()) + "}"
        name = "split_part(p, ';', 1)"
        number = f"CASE WHEN substr({name}, 2, 1) IN ('x', 'X') THEN ('0x' || substr({name}, 3))::BIGINT ELSE substr({name}, 2)::BIGINT END"
        coded = f"CASE WHEN {number} = 160 THEN ' ' WHEN ({number} BETWEEN 1 AND 55295) OR ({number} BETWEEN 57344 AND 1114111) THEN chr(({number})::INTEGER) END"
        found = f"CASE WHEN i > 1 AND regexp_matches(p, {quoted(w.REFERENCE)}) THEN CASE WHEN p[1] = '#' THEN {coded} ELSE {table}[{name}] END END"
        return f"array_to_string(list_transform(string_split({sql}, '&'), lambda p, i: CASE WHEN i = 1 THEN p ELSE coalesce({found} || substr(p, length({name}) + 2), '&' || p) END), '')"

    def record_id(sql: str) -> str:
        h = f"sha256({sql})"
        return "'<urn:uuid:' || " + " || '-' || ".join(f"substr({h}, {a}, {n})" for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))) + " || '>'"

    # what is hidden, one kind after the other: from a begin to the next end, or to the text's end
    shown = "payload"
    for begin, close in [("<!--", "-->"), *[(rf"<{name}[\s/>]", rf"</{name}\s*>") for name in w.HIDDEN]]:
        for pattern in (rf"(?is){begin}.*?{close}", rf"(?is){begin}.*\z", *[f"(?i){close}"] * (begin != "<!--")):
            shown = replaced(shown, pattern, " ")
    plain = squeeze(resolve(replaced(replaced(f"replace({shown}, chr(10), ' ')", w.LINED, "\n"), w.TAG, "")))
    inside = "regexp_split_to_array(regexp_split_to_array(payload, '(?i)</title\\s*>')[1], '(?i)<title')[2]"
    content = f"CASE WHEN regexp_matches(payload, '(?i)</title\\s*>') AND contains({inside}, '>') THEN substr({inside}, instr({inside}, '>') + 1) ELSE '' END"
    title = squeeze(resolve(replaced(f"replace({content}, chr(10), ' ')", w.TAG, "")))
    end = "chr(13) || chr(10)"
    return f"""
        WITH a AS (SELECT page_id, coalesce(url, '') AS target_uri, coalesce(html, '') AS payload FROM pages),
        b AS (SELECT *, 'sha256:' || sha256(payload) AS source_payload_digest, 'sha256:' || sha256('HTTP/1.1 200 OK' || {end} || 'Content-Type: text/html; charset=utf-8' || {end} || 'Content-Length: ' || strlen(payload) || {end} || {end} || payload) AS source_block_digest FROM a),
        c AS (SELECT *, {record_id(f"'response ' || coalesce(page_id::VARCHAR, '') || ' ' || target_uri || ' {w.DATE} ' || source_payload_digest")} AS refers_to, {plain} AS plain, {title} AS title FROM b),
        d AS (
            SELECT *, 'metadata' AS record_type, 'application/warc-fields' AS content_type,
                   'http-status: 200 OK' || {end} || 'http-content-type: text/html; charset=utf-8' || {end} || 'http-content-length: ' || strlen(payload) || {end} || 'title: ' || title || {end} || 'outlinks: ' || len(regexp_extract_all(payload, '(?i)<a\\s[^<>]*href=')) || {end} || 'html-octets: ' || strlen(payload) || {end} || 'text-octets: ' || strlen(plain) || {end} || 'text-digest: sha256:' || sha256(plain) || {end} AS block FROM c
            UNION ALL SELECT *, 'conversion', 'text/plain; charset=utf-8', plain FROM c
        )
        SELECT page_id, record_type, {record_id("record_type || ' ' || refers_to")} AS record_id, refers_to, target_uri, '{w.DATE}' AS date, content_type, block,
               'sha256:' || sha256(block) AS block_digest, source_payload_digest, source_block_digest
        FROM d
    """


def jaccard(n: int, upper: int, lower: int) -> str:
    """All links by brute force over shared n-grams (shared * upper >= lower * (sizes)), and the classes that they connect."""
    return rf"""
        WITH RECURSIVE
        w AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{{L}}\p{{M}}\p{{N}}_]+'), lambda x: x <> '') AS w FROM documents),
        g AS (
            SELECT doc_id, CASE WHEN len(w) < {n} THEN [array_to_string(w, ' ')] ELSE list_sort(list_distinct(list_transform(generate_series(1, len(w) - {n - 1}), lambda k: array_to_string(w[k : k + {n - 1}], ' ')))) END AS grams
            FROM w WHERE len(w) > 0
        ),
        s AS (SELECT min(doc_id) AS rep, count(*) AS copies, any_value(grams) AS grams, len(any_value(grams)) AS size FROM g GROUP BY sha256(array_to_string(grams, chr(10)))),
        member AS (SELECT g.doc_id, s.rep, s.copies FROM g JOIN s ON sha256(array_to_string(g.grams, chr(10))) = sha256(array_to_string(s.grams, chr(10)))),
        t AS (SELECT rep, size, unnest(grams) AS gram FROM s),
        link AS (
            SELECT a.rep AS a, b.rep AS b FROM t a JOIN t b ON a.gram = b.gram AND a.rep <> b.rep
            GROUP BY a.rep, b.rep, a.size, b.size HAVING count(*) * {upper} >= {lower} * (a.size + b.size)
        ),
        reach AS (SELECT rep AS node, rep AS met FROM s UNION SELECT reach.node, link.b FROM reach JOIN link ON reach.met = link.a),
        class AS (SELECT node, min(met) AS class_id FROM reach GROUP BY node),
        degree AS (SELECT a AS node, count(*) AS links FROM link GROUP BY a)
        SELECT documents.doc_id, coalesce(class_id, documents.doc_id) AS class_id, coalesce(links, 0) AS links, coalesce(copies, 1) AS copies
        FROM documents LEFT JOIN member USING (doc_id) LEFT JOIN class ON rep = class.node LEFT JOIN degree ON rep = degree.node
    """


def lloyd(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Plain Lloyd rounds, all distances measured in each; ties go to the lower entry."""
    floored = lambda s, n: f"(({s} - ((({s} % {n}) + {n}) % {n})) // {n})"
    steps = []
    for k in range(rounds + 1):
        far = "list_sum(list_transform(list_zip(x.part, b.entry), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT"
        steps.append(f"a{k} AS MATERIALIZED (SELECT vec_id, p, any_value(part) AS part, min({{'far': {far}, 'e': b.e}}) AS best FROM x JOIN b{k} b USING (p) GROUP BY vec_id, p)")
        if k < rounds:
            steps.append(f"s{k} AS (SELECT p, e, list({floored('s', 'n')} ORDER BY i) AS entry FROM (SELECT p, best.e AS e, i, sum(part[i])::BIGINT AS s, count(*) AS n FROM a{k}, generate_series(1, len(part)) g(i) GROUP BY ALL) GROUP BY p, e)")
            steps.append(f"b{k + 1} AS MATERIALIZED (SELECT b.p, b.e, coalesce(s.entry, b.entry) AS entry FROM b{k} b LEFT JOIN s{k} s ON b.p = s.p AND b.e = s.e)")
    return f"""
        WITH k AS MATERIALIZED (
            SELECT vec_id, label, list_transform(embedding, lambda v: floor(4096 * v::DOUBLE)::BIGINT) AS vec FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0
        ),
        x AS MATERIALIZED (SELECT vec_id, p, list_slice(vec, p * len(vec) // {parts} + 1, (p + 1) * len(vec) // {parts}) AS part FROM k, range({parts}) r(p)),
        f AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM k QUALIFY e < {entries}),
        b0 AS MATERIALIZED (SELECT p, e, part AS entry FROM x JOIN f USING (vec_id)),
        {", ".join(steps)},
        c AS (SELECT vec_id, string_agg(lpad(lower(hex(best.e)), 2, '0'), '' ORDER BY p) AS code, sum(best.far)::BIGINT AS error FROM a{rounds} GROUP BY vec_id),
        l AS (SELECT label, sum(error)::BIGINT AS label_error FROM c JOIN k USING (vec_id) GROUP BY label),
        d AS (SELECT sha256(string_agg(array_to_string(entry, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b{rounds})
        SELECT c.vec_id, code, error, label_error, codebooks_sha256 FROM c JOIN k USING (vec_id) JOIN l ON k.label IS NOT DISTINCT FROM l.label, d
    """


def spelling() -> str:
    """Near words by leaving each letter out, and by a blank in its place; the checksum bit by bit from its polynomial."""
    step = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    octets = "list_transform(range(strlen(s)), lambda i: ('0x' || substr(hex(s), (2 * i + 1)::INTEGER, 2))::BIGINT)"
    return rf"""
        WITH RECURSIVE
        t AS (SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, k: {step})) AS crc),
        o AS (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]{{7,}}')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
        e AS (SELECT doc_id || ':' || run AS s, run, count(*) AS n FROM o GROUP BY ALL),
        h AS (SELECT run, n, xor(list_reduce(list_prepend(4294967295, {octets}), lambda c, x: xor(c >> 8, crc[(xor(c, x) & 255) + 1])), 4294967295) AS h FROM e, t),
        d AS (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM h),
        v AS MATERIALIZED (SELECT word, sum(n)::BIGINT AS n FROM d WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
        each AS (SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS less, substr(word, 1, i) || '_' || substr(word, i + 2) AS blank FROM v, range(length(word)) r(i)),
        near AS (
            SELECT a.word, b.word AS near FROM each a JOIN each b USING (blank) WHERE a.word <> b.word
            UNION SELECT v.word, b.word FROM v JOIN each b ON v.word = b.less
            UNION SELECT b.word, v.word FROM v JOIN each b ON v.word = b.less
        ),
        best AS (SELECT near.word, count(*) AS n_near, min({{'less': -v.n, 'near': near.near}}) AS best FROM near JOIN v ON v.word = near.near GROUP BY near.word),
        f AS MATERIALIZED (
            SELECT v.word, v.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN -best.less >= 10 * v.n THEN best.near END AS form, CASE WHEN -best.less >= 10 * v.n THEN -best.less END AS form_n
            FROM v LEFT JOIN best b ON v.word = b.word
        ),
        way AS (SELECT word, word AS root FROM f UNION ALL SELECT way.word, f.form FROM way JOIN f ON way.root = f.word WHERE f.form IS NOT NULL),
        r AS (SELECT way.word, root FROM way JOIN f ON way.root = f.word WHERE f.form IS NULL)
        SELECT f.word, form, root, n, n_near, form_n FROM f JOIN r ON f.word = r.word
    """
