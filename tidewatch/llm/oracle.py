"""DuckDB equivalents of the queries that SQL can express.

The others (XXH64 fingerprints, tokenizer ids, learned models, page structure, rolling hashes) are tested
against brute-force versions in tests/llm.
"""

from __future__ import annotations

from . import license_scan

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _secrets() -> str:
    rules = (("assign", r"""((?i:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
             ("access", r"AKIA[A-Z0-9]+", 0, 16), ("hex", r"[0-9a-f]+", 0, 32))
    parts = [f"""SELECT doc_id, {k} AS k, '{kind}' AS kind, string_split_regex(t, '{p}') AS pieces,
        regexp_extract_all(t, '{p}', 0) AS m, regexp_extract_all(t, '{p}', {g}) AS v, {n} AS n FROM d""" for k, (kind, p, g, n) in enumerate(rules)]
    # hex and access runs: only texts that have a long enough one
    parts[1] += " WHERE regexp_matches(t, 'AKIA[A-Z0-9]{12}')"
    parts[2] += " WHERE regexp_matches(t, '[0-9a-f]{32}')"
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
m AS ({' UNION ALL '.join(parts)}),
e AS (SELECT *, unnest(generate_series(1, len(m))) AS i FROM m),
p AS (SELECT doc_id, k, kind, n, length(v[i]) AS vl, length(m[i]) AS ml,
        sum(length(pieces[i]) + length(m[i])) OVER (PARTITION BY doc_id, k ORDER BY i) AS e FROM e),
s AS (SELECT doc_id, k, kind, (e - ml)::BIGINT AS st, e::BIGINT AS en FROM p WHERE vl >= n),
a AS (SELECT doc_id, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
        string_agg(kind || ':' || st || ':' || en, ',' ORDER BY st, k) AS spans FROM s GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
    coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN a USING (doc_id)"""


_LINES = """
WITH l AS (SELECT doc_id, unnest(generate_series(0, len(ls) - 1)) AS no, ls FROM
        (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL)),
w AS (SELECT doc_id, no, ls[no + 1] AS line, string_split(trim(ls[no + 1]), ' ') AS ws FROM l),
i AS (SELECT doc_id, no, ws, trim(line) AS norm FROM w WHERE len(ws) >= 5),
f AS (SELECT *, row_number() OVER (ORDER BY doc_id, no) AS lid FROM
        (SELECT *, row_number() OVER (PARTITION BY norm ORDER BY doc_id, no) AS copy FROM i) WHERE copy = 1),
s AS (SELECT DISTINCT lid, unnest(list_transform(generate_series(1, len(ws) - 4), lambda j: array_to_string(ws[j:j + 4], ' '))) AS s FROM f),
c AS (SELECT lid, count(*) AS n FROM s GROUP BY lid),
p AS (SELECT a.lid AS a, b.lid AS b, count(*) AS x FROM s a JOIN s b ON a.s = b.s AND a.lid < b.lid GROUP BY 1, 2),
late AS (SELECT DISTINCT b AS lid FROM p JOIN c ca ON ca.lid = a JOIN c cb ON cb.lid = b WHERE x >= 0.8 * (ca.n + cb.n - x) - 1e-9),
gone AS (SELECT i.doc_id, i.no FROM i JOIN f USING (norm) LEFT JOIN late USING (lid)
        WHERE late.lid IS NOT NULL OR i.doc_id <> f.doc_id OR i.no <> f.no),
r AS (SELECT doc_id, count(*) AS n_removed, string_agg(no::VARCHAR, ',' ORDER BY no) AS removed FROM gone GROUP BY doc_id),
k AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY no) AS kept FROM w ANTI JOIN gone USING (doc_id, no) GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(removed, '') AS removed,
    length(coalesce(kept, ''))::BIGINT AS n_chars, sha256(coalesce(kept, '')) AS text_sha256
FROM documents d LEFT JOIN r USING (doc_id) LEFT JOIN k USING (doc_id)"""


def _words(text: str) -> str:
    return rf"regexp_extract_all(translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def _contamination() -> str:
    return f"""
WITH d AS (SELECT doc_id, {_words('text')} AS w FROM documents),
b AS (SELECT item_id::VARCHAR AS item, {_words('text')} AS w, least(13, len(w)) AS n FROM benchmark),
g AS (SELECT DISTINCT item, n, array_to_string(w[p:p + n - 1], ' ') AS gram FROM
        (SELECT item, n, w, unnest(generate_series(1, len(w) - n + 1)) AS p FROM b WHERE n > 0)),
ns AS (SELECT DISTINCT n FROM g),
o AS (SELECT DISTINCT doc_id, p, x.n, item FROM
        (SELECT doc_id, n, w, unnest(generate_series(1, len(w) - n + 1)) AS p FROM d, ns WHERE len(w) >= n) x
        JOIN g ON g.n = x.n AND g.gram = array_to_string(x.w[p:p + x.n - 1], ' ')),
h AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(generate_series(p, p + n - 1)) AS q FROM o) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM o) GROUP BY doc_id),
t AS (SELECT DISTINCT item, unnest(w) AS term FROM b),
tf AS (SELECT term, count(DISTINCT item) AS seen FROM t GROUP BY term),
lead AS (SELECT item, term FROM (SELECT item, term, row_number() OVER (PARTITION BY item ORDER BY seen, strlen(term) DESC, term) AS rn
        FROM t JOIN tf USING (term)) WHERE rn = 1),
bag AS (SELECT item, list(DISTINCT term) AS terms, max(len(w)) AS n FROM b JOIN t USING (item) GROUP BY item),
near AS (SELECT doc_id, count(DISTINCT item) AS n_near FROM (SELECT doc_id, w, unnest(generate_series(1, len(w))) AS p FROM d) x
        JOIN lead ON lead.term = x.w[p] JOIN bag USING (item)
        WHERE list_has_all(x.w[greatest(1, p - 2 * bag.n):p + 2 * bag.n], bag.terms) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
    sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated,
    coalesce(n_near, 0)::BIGINT AS n_near
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN it USING (doc_id) LEFT JOIN near USING (doc_id)"""


def _licenses() -> str:
    index = license_scan.TemplateIndex()
    idf = ", ".join(f"('{t}', {v!r}::DOUBLE)" for t, v in index.idf.items())
    weights = ", ".join(f"('{t}', {k}, {v!r}::DOUBLE)" for t, ws in index.weight.items() for k, v in enumerate(ws) if v)
    names = ", ".join(f"({k}, '{n}')" for k, n in enumerate(index.names))
    stop = ", ".join(f"'{t}'" for t in sorted(license_scan.STOP_WORDS))
    # folders of DOC_PATH have two or three levels
    return rf"""
WITH idf(term, idf) AS (VALUES {idf}), wt(term, k, w) AS (VALUES {weights}), names(k, license) AS (VALUES {names}),
f AS (SELECT concat(coalesce(source, 'none'), '/', coalesce(doc_id, 0) // 10000, '/',
        CASE WHEN doc_id % 100 = 0 THEN '' ELSE concat((coalesce(doc_id, 0) // 1000) % 10, '/') END,
        CASE WHEN doc_id % 10 = 0 THEN 'LICENSE-' ELSE 'doc-' END, coalesce(doc_id, -1), '.txt') AS path, coalesce(text, '') AS t FROM documents),
u AS (SELECT path, 0 AS unit, t FROM f UNION ALL
      SELECT path, unnest(generate_series(1, len(ls))) AS unit, unnest(ls) AS t FROM (SELECT path, string_split(t, chr(10)) AS ls FROM f)),
x AS (SELECT path, unit, unnest(string_split_regex(lower(t), '{license_scan.SEPARATOR}')) AS term FROM u),
tf AS (SELECT path, unit, term, count(*) AS tf FROM x WHERE term <> '' AND term NOT IN ({stop}) GROUP BY 1, 2, 3),
hit AS (SELECT DISTINCT path, unit FROM tf JOIN idf USING (term)),
n AS (SELECT path, unit, sqrt(sum((tf * coalesce(idf, {index.other!r})) ** 2)) AS norm
      FROM tf SEMI JOIN hit USING (path, unit) LEFT JOIN idf USING (term) GROUP BY 1, 2),
sc AS (SELECT path, unit, k, round(sum(tf * idf * w) / any_value(norm), 9) AS score
       FROM tf JOIN idf USING (term) JOIN wt USING (term) JOIN n USING (path, unit) GROUP BY 1, 2, 3),
best AS (SELECT path, unit, license, score FROM (SELECT *, row_number() OVER (PARTITION BY path, unit ORDER BY score DESC, k) AS rn FROM sc)
         JOIN names USING (k) WHERE rn = 1 AND score >= {license_scan.THRESHOLD}),
own AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY path ORDER BY unit = 0 DESC, score DESC, unit, license DESC) AS rn FROM best) WHERE rn = 1),
lic AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY regexp_extract(path, '^(.*)/', 1) ORDER BY score DESC, path) AS r2,
        regexp_extract(path, '^(.*)/', 1) AS folder FROM own WHERE regexp_matches(path, '/LICENSE[^/]*$')) WHERE r2 = 1),
up AS (SELECT * FROM (SELECT f.path, lic.license AS l, lic.score AS s, lic.path AS p,
        row_number() OVER (PARTITION BY f.path ORDER BY length(lic.folder) DESC) AS rn
       FROM f JOIN lic ON starts_with(f.path, lic.folder || '/')) WHERE rn = 1)
SELECT f.path, coalesce(own.license, up.l) AS license,
    CASE WHEN own.path IS NOT NULL THEN CASE WHEN own.unit = 0 THEN 'file' ELSE 'header' END WHEN up.l IS NOT NULL THEN 'inherited' END AS basis,
    CASE WHEN own.path IS NOT NULL THEN own.score ELSE up.s END AS score,
    CASE WHEN own.path IS NOT NULL THEN own.path ELSE up.p END AS found_in
FROM f LEFT JOIN own ON own.path = f.path LEFT JOIN up ON up.path = f.path"""


def _merkle() -> str:
    def code(value: str, text: str | None = None) -> str:
        text = text or f"{value}::VARCHAR"
        return f"CASE WHEN {value} IS NULL THEN '-' ELSE concat(strlen({text}), ':', {text}) END"

    def leaf(text: str) -> str:
        return f"sha256(concat({code('doc_id')}, {code('source')}, {code('lang')}, {code('n_chars')}, {code('text', text)}))"

    # CRC-32 of a decimal number: its bytes are added in turn, each followed by eight shifts (-1)
    steps = "flatten([[ascii(c), -1, -1, -1, -1, -1, -1, -1, -1] for c in string_split(coalesce(doc_id::VARCHAR, ''), '') if c <> ''])"
    crc = f"xor(list_reduce(list_concat([4294967295::BIGINT], {steps}), lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END), 4294967295)"
    return rf"""
WITH RECURSIVE d AS (SELECT *, coalesce('=' || source, '') AS tree, {leaf('text')} AS leaf,
    {leaf("CASE WHEN " + crc + " % 2 = 0 THEN replace(text, chr(10), '') ELSE text END")} AS claim FROM documents),
p AS (SELECT doc_id, tree, leaf, claim, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY tree) AS n FROM d),
v AS (SELECT 0 AS lv, tree, i, leaf AS h, n FROM p UNION ALL
      SELECT lv + 1, tree, i // 3, sha256(string_agg(h, '' ORDER BY i)), (n + 2) // 3 FROM v WHERE n > 1 GROUP BY lv, tree, n, i // 3),
s AS (SELECT tree, h AS subroot, row_number() OVER (ORDER BY tree) - 1 AS j, count(*) OVER () AS m FROM v WHERE n = 1),
u AS (SELECT 0 AS lv, j AS i, subroot AS h, m AS n FROM s UNION ALL
      SELECT lv + 1, i // 3, sha256(string_agg(h, '' ORDER BY i)), (n + 2) // 3 FROM u WHERE n > 1 GROUP BY lv, n, i // 3),
r AS (SELECT h AS root FROM u WHERE n = 1),
lo AS (SELECT a.tree, a.lv, a.i, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS le, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS ri
       FROM v a JOIN v b ON a.tree = b.tree AND a.lv = b.lv AND a.i // 3 = b.i // 3 WHERE a.n > 1 GROUP BY 1, 2, 3),
hi AS (SELECT a.lv, a.i, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS le, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS ri
       FROM u a JOIN u b ON a.lv = b.lv AND a.i // 3 = b.i // 3 WHERE a.n > 1 GROUP BY 1, 2),
st AS (SELECT p.tree, p.i, lo.lv, lo.le, lo.ri FROM p JOIN lo ON lo.tree = p.tree AND lo.i = p.i // (3 ** lo.lv)::BIGINT
       UNION ALL SELECT p.tree, p.i, 1000 + hi.lv, hi.le, hi.ri FROM p JOIN s USING (tree) JOIN hi ON hi.i = s.j // (3 ** hi.lv)::BIGINT),
ls AS (SELECT tree, i, list(struct_pack(le := le, ri := ri) ORDER BY lv) AS steps, string_agg(le || ri, '' ORDER BY lv) AS sib FROM st GROUP BY 1, 2),
f AS (SELECT tree, i, 1 AS k, claim AS h FROM p UNION ALL
      SELECT f.tree, f.i, k + 1, sha256(steps[k].le || h || steps[k].ri) FROM f JOIN ls ON ls.tree = f.tree AND ls.i = f.i WHERE k <= len(steps)),
e AS (SELECT tree, i, arg_max(h, k) AS folded_root FROM f GROUP BY 1, 2)
SELECT doc_id, leaf, subroot, root, sha256(coalesce(sib, '')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM p JOIN s USING (tree) JOIN e ON e.tree = p.tree AND e.i = p.i LEFT JOIN ls ON ls.tree = p.tree AND ls.i = p.i, r"""


_COLLOCATIONS = r"""
WITH t AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?\n\x0B\x0C\r]')) AS piece FROM documents),
p AS (SELECT lang, list_filter(string_split_regex(piece, '[ \t]+'), lambda x: x <> '') AS w FROM t),
f1 AS (SELECT lang, word, count(*)::HUGEINT AS f FROM (SELECT lang, unnest(w) AS word FROM p) GROUP BY 1, 2),
f2 AS (SELECT lang, w[i] AS w1, w[i + 1] AS w2, count(*)::HUGEINT AS a FROM (SELECT lang, w, unnest(range(1, len(w))) AS i FROM p) GROUP BY 1, 2, 3),
f3 AS (SELECT lang, w[i] AS w1, w[i + 1] AS w2, w[i + 2] AS w3, count(*)::HUGEINT AS a
       FROM (SELECT lang, w, unnest(range(1, len(w) - 1)) AS i FROM p) GROUP BY 1, 2, 3, 4),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f1 GROUP BY 1),
three AS (SELECT c.lang, c.w1, c.w2, c.w3, c.a, x.f AS l1, y.a AS r1, z.a AS l2, u.f AS r2, 1000000 * c.a * c.a // (x.f * y.a) AS s1, 1000000 * c.a * c.a // (z.a * u.f) AS s2
       FROM f3 c JOIN f1 x ON x.lang = c.lang AND x.word = c.w1 JOIN f1 u ON u.lang = c.lang AND u.word = c.w3
       JOIN f2 y ON y.lang = c.lang AND y.w1 = c.w2 AND y.w2 = c.w3 JOIN f2 z ON z.lang = c.lang AND z.w1 = c.w1 AND z.w2 = c.w2 WHERE c.a >= 10),
up AS (SELECT lang, w1, w2, max(a) AS m FROM (SELECT lang, w1, w2, a FROM three UNION ALL SELECT lang, w2, w3, a FROM three) GROUP BY 1, 2, 3),
two AS (SELECT c.lang, concat(c.w1, ' ', c.w2) AS phrase, c.a, x.f AS l, y.f AS r, 1000000 * c.a * c.a // (x.f * y.f) AS score
       FROM f2 c JOIN f1 x ON x.lang = c.lang AND x.word = c.w1 JOIN f1 y ON y.lang = c.lang AND y.word = c.w2
       LEFT JOIN up ON up.lang = c.lang AND up.w1 = c.w1 AND up.w2 = c.w2 WHERE c.a >= 10 AND NOT coalesce(100 * up.m >= 50 * c.a, false)),
al AS (SELECT * FROM two UNION ALL SELECT lang, concat(w1, ' ', w2, ' ', w3), a, CASE WHEN s1 <= s2 THEN l1 ELSE l2 END, CASE WHEN s1 <= s2 THEN r1 ELSE r2 END, least(s1, s2) FROM three),
rk AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM al)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score FROM rk JOIN n USING (lang) WHERE rank <= 2000"""


SQL = {"op11_merkle": _merkle(), "op12_collocations": _COLLOCATIONS, "op5_secrets": _secrets(), "op6_line_dedup": _LINES, "op8_decontamination": _contamination(), "op10_licenses": _licenses()}
