"""DuckDB SQL for the queries that SQL can express."""

SOURCE_MIX = r"""
WITH RECURSIVE sized AS (
    SELECT doc_id, source,
        CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
        coalesce((length(text) - length(regexp_replace(text, '\p{L}+', '', 'g')) + 1) / (length(text) + 1), 1.0) AS weight,
        (CAST('0x' || substr(md5('mix-1|' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 13) AS BIGINT) + 0.5)
            / 4503599627370496.0 AS u
    FROM documents
), drawn AS (SELECT doc_id, source, size, -ln(u) / weight AS draw FROM sized),
totals AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM drawn GROUP BY source),
weighted AS (
    SELECT source, source_size,
        [3.0, 1.0, 2.0][1 + (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3]::DOUBLE AS weight
    FROM totals
), rounds AS (
    SELECT 0 AS round, source, source_size, weight, false AS capped,
        1.5 * sum(source_size) OVER () * weight / sum(weight) OVER () AS target
    FROM weighted
    UNION ALL
    SELECT round + 1, source, source_size, weight, capped OR target > 2.0 * source_size,
        CASE WHEN capped OR target > 2.0 * source_size THEN 2.0 * source_size
        ELSE (1.5 * sum(source_size) OVER ()
                - sum(CASE WHEN capped OR target > 2.0 * source_size THEN 2.0 * source_size ELSE 0 END) OVER ())
            * weight / sum(CASE WHEN capped OR target > 2.0 * source_size THEN 0 ELSE weight END) OVER () END
    FROM rounds WHERE round < 40
), shares AS (SELECT source, source_size, target FROM rounds WHERE round = 40),
placed AS (
    SELECT d.doc_id, d.source, d.size, s.source_size, s.target,
        CASE WHEN s.source_size = 0 THEN 0 ELSE floor(s.target / s.source_size) END AS epochs,
        coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.draw, d.doc_id, d.size
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
    FROM drawn d JOIN shares s ON d.source IS NOT DISTINCT FROM s.source
)
SELECT doc_id, source, size, source_size, round(target, 6) AS target,
    CAST(size * (epochs + CASE WHEN 2 * start + size <= 2 * (target - epochs * source_size) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM placed
"""

TOP_K = """
WITH cells AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id,
        CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM cells q JOIN cells c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
), ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

_FAMILIES, _STEPS = range(12), (1, 3, 5, 7, 9)
_LEVELS = ", ".join(
    f"CAST('0x' || substr(sha256(term), {4 * f + 1}, 4) AS BIGINT)" for f in _FAMILIES
)
_COMPONENT = """CASE WHEN count(*) FILTER (draws[{f}] < {bound}) = 0 THEN ''
    ELSE list_reduce(list(rank ORDER BY rank) FILTER (draws[{f}] < {bound}),
        lambda s, r: (s * 1000003 + r) % 2147483647, 2147483648)::VARCHAR END"""
_SIZES = " || '/' || ".join(
    "concat_ws('.', " + ", ".join(_COMPONENT.format(f=f + 1, bound=65536 >> step) for f in _FAMILIES) + ")"
    for step in _STEPS
)
_LIKENESS = """CASE WHEN {a} = {b} THEN 1.0 WHEN {a}[1] = '=' OR {b}[1] = '=' THEN 0.0 ELSE list_max(list_transform(
    list_zip(string_split({a}, '/'), string_split({b}, '/')),
    lambda z: len(list_filter(list_zip(string_split(z[1], '.'), string_split(z[2], '.')), lambda p: p[1] <> '' AND p[1] = p[2]))
        / (len(list_filter(list_zip(string_split(z[1], '.'), string_split(z[2], '.')), lambda p: p[1] <> '' OR p[2] <> '')) + 1.0)
    )) END"""

FINGERPRINTS = f"""
WITH texts AS (
    SELECT row_number() OVER (ORDER BY doc_id DESC NULLS LAST, md5(coalesce(text, ''))) AS place,
        doc_id, coalesce(text, '') AS text FROM documents
), followed AS (
    SELECT *, coalesce(lead(text) OVER (ORDER BY place), first(text) OVER (ORDER BY place)) AS next_text FROM texts
), edits AS (
    SELECT *, length(text) AS n,
        substr(text, 1, length(text) - length(text) // 2) || substr(next_text, 1, length(text) // 2) AS edited
    FROM followed
), variants AS (
    SELECT place, 0 AS which, text FROM edits UNION ALL SELECT place, 1, edited FROM edits
), held AS (
    SELECT place, which, unnest(list_distinct(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+'))) AS term FROM variants
), lexicon AS (
    SELECT term, row_number() OVER (ORDER BY encode(term)) AS rank, [{_LEVELS}] AS draws
    FROM (SELECT term FROM held WHERE which = 0 GROUP BY term
        HAVING ln((SELECT count(*) FROM documents) / count(*)) BETWEEN ln(5) AND ln(1000))
), printed AS (
    SELECT place, which, {_SIZES} AS fingerprint FROM held JOIN lexicon USING (term) GROUP BY place, which
), whole AS (
    SELECT v.place, v.which, coalesce(p.fingerprint, '=' || md5(v.text)) AS fingerprint
    FROM variants v LEFT JOIN printed p ON v.place = p.place AND v.which = p.which
), joined AS (
    SELECT e.place, e.doc_id, CAST(e.n AS BIGINT) AS n_chars, sha256(e.edited) AS edited_sha256,
        a.fingerprint AS fingerprint, b.fingerprint AS edited_fingerprint,
        coalesce(lead(a.fingerprint) OVER (ORDER BY e.place), first(a.fingerprint) OVER (ORDER BY e.place)) AS next_print
    FROM edits e JOIN whole a ON e.place = a.place AND a.which = 0 JOIN whole b ON e.place = b.place AND b.which = 1
)
SELECT doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    CAST({_LIKENESS.format(a="fingerprint", b="edited_fingerprint")} AS DOUBLE) AS near_edited,
    CAST({_LIKENESS.format(a="fingerprint", b="next_print")} AS DOUBLE) AS near_next
FROM joined
"""

SUFFIX_DEDUP = """
WITH texts AS (
    SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, length(hex(encode(coalesce(text, '')))) // 2 AS n FROM documents
), windows AS (
    SELECT doc_id, s, md5(substr(h, 2 * s + 1, 200)) AS k FROM texts, unnest(range(0, n - 99)) AS u(s) WHERE n >= 100
), repeated AS (
    SELECT doc_id, s FROM windows QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id, s) > 1
), marked AS (
    SELECT doc_id, s, s > lag(s, 1, -1000) OVER (PARTITION BY doc_id ORDER BY s) + 100 AS opens FROM repeated
), numbered AS (
    SELECT doc_id, s, count(*) FILTER (opens) OVER (PARTITION BY doc_id ORDER BY s) AS run FROM marked
), spans AS (
    SELECT doc_id, run, min(s) AS a, max(s) + 100 AS b FROM numbered GROUP BY doc_id, run
), pieces AS (
    SELECT doc_id, run, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS before FROM spans
), cut AS (
    SELECT t.doc_id, any_value(t.n) AS n, sum(p.b - p.a) AS n_removed, count(p.a) AS n_spans,
        coalesce(string_agg(substr(t.h, 2 * p.before + 1, 2 * (p.a - p.before)), '' ORDER BY p.a), '')
            || substr(any_value(t.h), 2 * coalesce(max(p.b), 0) + 1) AS kept
    FROM texts t LEFT JOIN pieces p ON t.doc_id = p.doc_id GROUP BY t.doc_id
)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
    CAST(n_spans AS BIGINT) AS n_spans, sha256(unhex(kept)) AS kept_sha256
FROM cut
"""

FILL_MIDDLE = r"""
WITH drawn AS (
    SELECT doc_id, coalesce(text, '') AS text, CAST(length(coalesce(text, '')) AS BIGINT) AS n,
        sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS h
    FROM documents
), cuts AS (
    SELECT doc_id, text, n,
        CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                OR CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 >= 90 THEN 'plain'
            WHEN CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 < 20 THEN 'spm' ELSE 'psm' END AS form,
        least(CAST('0x' || substr(h, 1, 8) AS BIGINT) % (n + 1), CAST('0x' || substr(h, 9, 8) AS BIGINT) % (n + 1)) AS a,
        greatest(CAST('0x' || substr(h, 1, 8) AS BIGINT) % (n + 1), CAST('0x' || substr(h, 9, 8) AS BIGINT) % (n + 1)) AS b
    FROM drawn
), written AS (
    SELECT doc_id, n, form,
        CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
        CASE form WHEN 'plain' THEN text
            WHEN 'psm' THEN '<P>' || substr(text, 1, a) || '<S>' || substr(text, b + 1) || '<M>' || substr(text, a + 1, b - a)
            ELSE '<S>' || substr(text, b + 1) || '<P>' || substr(text, 1, a) || '<M>' || substr(text, a + 1, b - a) END AS output
    FROM cuts
), parted AS (
    SELECT *, CASE WHEN form <> 'plain' THEN string_split_regex(output, '<P>|<S>|<M>') END AS p FROM written
)
SELECT doc_id, n, form, prefix_chars, middle_chars, sha256(output) AS output_sha256,
    sha256(CASE form WHEN 'plain' THEN output WHEN 'psm' THEN p[2] || p[4] || p[3] ELSE p[3] || p[4] || p[2] END) AS restored_sha256
FROM parted
"""

DECONTAMINATION = r"""
WITH texts AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), held AS (
    SELECT r, doc_id, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM texts
), items AS (
    SELECT coalesce(CAST(item_id AS VARCHAR), 'null') AS item, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark WHERE text IS NOT NULL
), windows AS (
    SELECT DISTINCT item, least(len(w), 10) AS size, array_to_string(w[s : s + least(len(w), 10) - 1], ' ') AS k
    FROM items, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS u(s) WHERE len(w) > 0
), sizes AS (SELECT DISTINCT size FROM windows),
places AS (
    SELECT r, s, size, array_to_string(w[s : s + size - 1], ' ') AS k
    FROM held, sizes, unnest(range(1, len(w) - size + 2)) AS u(s) WHERE len(w) >= size
), found AS (
    SELECT DISTINCT p.r, p.s, p.size, item FROM places p JOIN windows v ON p.size = v.size AND p.k = v.k
), hit AS (
    SELECT r, count(DISTINCT s + i) AS n_hit FROM found, unnest(range(0, size)) AS u(i) GROUP BY r
), told AS (
    SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed FROM (SELECT DISTINCT r, item FROM found) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
    CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM held LEFT JOIN hit USING (r) LEFT JOIN told USING (r)
"""

_SIZED = "coalesce(strlen(CAST({0} AS VARCHAR)) || ':' || CAST({0} AS VARCHAR), '-')"
_LEAF = "sha256(" + " || ".join(_SIZED.format(name) for name in ("doc_id", "source", "lang", "n_chars", "{text}")) + ")"
_CRC_STEP = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"

MANIFEST = f"""
WITH RECURSIVE steps AS (
    SELECT list_transform(range(256), lambda x: list_reduce(range(8), lambda c, i: {_CRC_STEP}, x)) AS t
), rows AS (
    SELECT doc_id, lang, {_LEAF.format(text="text")} AS leaf,
        {_LEAF.format(text="translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS altered,
        xor(list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda d: CAST(ascii(d) AS BIGINT)),
            lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)]), 4294967295), 4294967295) AS crc
    FROM documents, steps
), leaves AS (
    SELECT *, row_number() OVER () AS r, dense_rank() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS tree,
        row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
        count(*) OVER (PARTITION BY lang) AS n
    FROM rows
), nodes AS (
    SELECT 0 AS level, tree, idx, n, leaf AS digest FROM leaves
    UNION ALL
    SELECT DISTINCT level + 1, tree, idx // 8, (n + 7) // 8,
        sha256(string_agg(digest, '') OVER (PARTITION BY tree, idx // 8 ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
    FROM nodes WHERE n > 1
), subroots AS (
    SELECT tree, level, digest, tree AS idx, count(*) OVER () AS n FROM nodes WHERE n = 1
), top AS (
    SELECT 0 AS level, idx, n, digest FROM subroots
    UNION ALL
    SELECT DISTINCT level + 1, idx // 8, (n + 7) // 8,
        sha256(string_agg(digest, '') OVER (PARTITION BY idx // 8 ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
    FROM top WHERE n > 1
), levels AS (
    SELECT l.r, o.level AS step, coalesce(string_agg(o.digest, '' ORDER BY o.idx) FILTER (o.idx < l.idx // pow(8, o.level)::BIGINT), '') AS before,
        coalesce(string_agg(o.digest, '' ORDER BY o.idx) FILTER (o.idx > l.idx // pow(8, o.level)::BIGINT), '') AS after
    FROM leaves l JOIN nodes o ON l.tree = o.tree AND o.n > 1 AND l.idx // pow(8, o.level + 1)::BIGINT = o.idx // 8 GROUP BY ALL
    UNION ALL
    SELECT l.r, 1000 + o.level, coalesce(string_agg(o.digest, '' ORDER BY o.idx) FILTER (o.idx < l.tree // pow(8, o.level)::BIGINT), ''),
        coalesce(string_agg(o.digest, '' ORDER BY o.idx) FILTER (o.idx > l.tree // pow(8, o.level)::BIGINT), '')
    FROM leaves l JOIN top o ON o.n > 1 AND l.tree // pow(8, o.level + 1)::BIGINT = o.idx // 8 GROUP BY ALL
), proofs AS (
    SELECT r, list(before || '|' || after ORDER BY step) AS proof, string_agg(before || after, '' ORDER BY step) AS siblings FROM levels GROUP BY r
), folded AS (
    SELECT l.doc_id, l.leaf, s.digest AS subroot, (SELECT digest FROM top WHERE n = 1) AS root,
        sha256(coalesce(p.siblings, '')) AS proof_sha256,
        list_reduce(coalesce(p.proof, CAST([] AS VARCHAR[])), lambda d, x: sha256(split_part(x, '|', 1) || d || split_part(x, '|', 2)),
            CASE WHEN l.crc % 3 = 0 THEN l.altered ELSE l.leaf END) AS folded_root
    FROM leaves l JOIN subroots s ON l.tree = s.tree LEFT JOIN proofs p ON l.r = p.r
)
SELECT *, folded_root = root AS verified FROM folded
"""

LLM_ORACLES = {
    "op1_suffix_dedup": SUFFIX_DEDUP,
    "op2_fingerprints": FINGERPRINTS,
    "op4_top_k": TOP_K,
    "op10_source_mix": SOURCE_MIX,
    "op11_fill_middle": FILL_MIDDLE,
    "op12_decontamination": DECONTAMINATION,
    "op13_manifest": MANIFEST,
}
