"""DuckDB SQL for the operators whose whole result SQL can state; each is written from the contract, not from the Spark code."""

#: Words of a text, and a document's words, as SQL.
_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
#: lower() of SQL also lowers other letters; only A-Z may change.
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP10 = rf"""
WITH d AS (SELECT doc_id, {_WORDS.format(_LOWER.format("coalesce(text, '')"))} AS w FROM documents),
     i AS (SELECT item_id, {_WORDS.format(_LOWER.format("coalesce(text, '')"))} AS w FROM benchmark),
     item AS (SELECT DISTINCT item_id, array_to_string(w[k:k + 4], ' ') AS s FROM (SELECT item_id, w, unnest(range(1, len(w) - 3)) AS k FROM i)),
     n AS (SELECT item_id, count(*) AS n_item FROM item GROUP BY item_id),
     doc AS (SELECT DISTINCT doc_id, array_to_string(w[k:k + 4], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS k FROM d))
SELECT doc.doc_id, item.item_id, count(*) AS shared, any_value(n.n_item) AS n_item
FROM doc JOIN item USING (s) JOIN n ON n.item_id = item.item_id
GROUP BY doc.doc_id, item.item_id HAVING 100 * count(*) >= 80 * any_value(n.n_item)
"""

#: Every group against every kept term, as the contract words it.
OP11 = rf"""
WITH d AS (SELECT doc_id, row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source, {_LOWER.format("coalesce(text, '')")} AS text FROM documents),
     w AS (SELECT row, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
     kept AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT row) >= 30),
     v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
     own AS (SELECT lang, source, term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY lang, source, term),
     grp AS (SELECT DISTINCT lang, source FROM d),
     ng AS (SELECT lang, source, sum(n) AS total FROM own GROUP BY lang, source),
     nl AS (SELECT lang, sum(n) AS total FROM own GROUP BY lang),
     cell AS (SELECT lang, source, term, coalesce(n, 0) AS n,
                     1 + (1000000000::HUGEINT * (coalesce(n, 0) + 5)) // (coalesce(total, 0) + 5 * v)::HUGEINT AS p
              FROM grp JOIN kept USING (lang) JOIN v USING (lang) LEFT JOIN own USING (lang, source, term) LEFT JOIN ng USING (lang, source)),
     whole AS (SELECT lang, term, 1 + (1000000000::HUGEINT * (sum(n) + 5)) // (any_value(total) + 5 * any_value(v))::HUGEINT AS q
               FROM own JOIN v USING (lang) JOIN nl USING (lang) GROUP BY lang, term),
     pair AS (SELECT a.lang, a.source, b.source AS item, sum(abs(x.p - y.p)) AS value
              FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
              LEFT JOIN cell x ON x.lang = a.lang AND x.source = a.source LEFT JOIN cell y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
              WHERE x.term IS NULL OR y.term IS NOT NULL GROUP BY ALL),
     term AS (SELECT lang, source, term AS item, p - q AS value FROM cell JOIN whole USING (lang, term) WHERE n > 0 AND p > q),
     parts AS (SELECT lang, source, 'pair' AS part, item, coalesce(value, 0) AS value FROM pair UNION ALL SELECT lang, source, 'term', item, value FROM term)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM parts QUALIFY part = 'pair' OR rank <= 50
"""

#: The text as a list of units, cut by list slices.
OP12 = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
                  sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
     g AS (SELECT *, len(u) AS n, list_transform(range(0, 4), lambda i: list_reduce(list_transform(range(1, 9), lambda k:
                  strpos('0123456789abcdef', substr(h, i * 8 + k, 1)) - 1), lambda a, b: a * 16 + b)) AS r FROM d),
     c AS (SELECT *, least(r[1] % (n + 1), r[2] % (n + 1)) AS i, greatest(r[1] % (n + 1), r[2] % (n + 1)) AS j,
                  CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR r[3] % 100 >= 90 THEN 'plain'
                       WHEN r[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM g),
     p AS (SELECT *, array_to_string(u[1:i], '') AS prefix, array_to_string(u[i + 1:j], '') AS middle, array_to_string(u[j + 1:], '') AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(text) AS restored_sha256
FROM p
"""

#: Windows of 8 words found twice mark their words; a window of 101 words found twice is a repeat of over 100.
OP2 = rf"""
WITH d AS (SELECT doc_id, row_number() OVER () AS row, coalesce(text, '') AS text, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
     k8 AS (SELECT row, k, hash(array_to_string(w[k:k + 7], ' ')) AS h FROM (SELECT row, w, unnest(range(1, len(w) - 6)) AS k FROM d)),
     twice AS (SELECT row, k FROM k8 QUALIFY count(*) OVER (PARTITION BY row, h) > 1),
     marked AS (SELECT row, count(DISTINCT k + i) AS n FROM twice, range(0, 8) t(i) GROUP BY row),
     k101 AS (SELECT DISTINCT row FROM (SELECT row, hash(array_to_string(w[k:k + 100], ' ')) AS h FROM (SELECT row, w, unnest(range(1, len(w) - 99)) AS k FROM d)) GROUP BY row, h HAVING count(*) > 1),
     lines AS (SELECT row, unnest(string_split(text, chr(10))) AS line FROM d),
     dup AS (SELECT row, count(*) - count(DISTINCT line) AS n FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY row),
     b AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
                  CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines,
                  CAST(coalesce(marked.n, 0) AS BIGINT) AS n_repeat_words, k101.row IS NOT NULL AS long
           FROM d LEFT JOIN dup USING (row) LEFT JOIN marked USING (row) LEFT JOIN k101 USING (row))
SELECT * EXCLUDE (long), n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND NOT (n_repeat_words > 0.15 * n_words OR long) AS kept
FROM b
"""

#: The given pages hold no canonical link and no refresh, so a page without a rule is allowed; links are tested in tests/llm.
OP5 = """
WITH p AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
     h AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
     r(rh, rp, said) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
     f AS (SELECT h.*, rh || rp AS rule, said FROM h LEFT JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp))
SELECT page_id, host, path, rule, coalesce(said, 'allow') AS verdict FROM f QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(rule) DESC NULLS LAST) = 1
"""

#: All pairs that share a shingle, then the least id that links reach.
OP8 = rf"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS.format(_LOWER.format("coalesce(text, '')"))} AS w FROM documents),
     s AS (SELECT DISTINCT doc_id, hash(array_to_string(w[k:k + 3], ' ')) AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS k FROM d WHERE len(w) > 0)),
     n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
     pair AS (SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id
              WHERE 100 * least(x.n, y.n) >= 80 * greatest(x.n, y.n)
              GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 80 * (any_value(x.n) + any_value(y.n) - count(*))),
     reach(doc_id, other) AS (SELECT a, b FROM pair UNION SELECT reach.doc_id, pair.b FROM reach JOIN pair ON pair.a = reach.other),
     least_id AS (SELECT doc_id, min(other) AS c FROM reach GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, least(d.doc_id, coalesce(c, d.doc_id)) AS component_id, least(d.doc_id, coalesce(c, d.doc_id)) = d.doc_id AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN least_id USING (doc_id)
"""

ORACLES = {"op2_repetition": OP2, "op5_redirect_filter": OP5, "op8_odd_sketch": OP8, "op10_containment": OP10, "op11_source_divergence": OP11, "op12_fill_in_middle": OP12}
