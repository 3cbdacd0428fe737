"""DuckDB SQL twins of the operators that SQL can express, over whole tables."""

from __future__ import annotations

from strata.llm.license_scan import KNOWN, SPELLINGS
from strata.llm.url_filter import RULES

_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _canonical(text: str) -> str:
    t = f"lower({text})"
    t = (f"regexp_replace({t}, '(?m)^[ \\t*#/;-]*(?:copyright[ \\t]*(?:\\(c\\)|©|[0-9:])|\\(c\\)|©)[^\\n]*$', ' ', 'g')")
    for a, b in SPELLINGS:
        t = f"replace({t}, {_q(a)}, {_q(b)})"
    return f"regexp_replace({t}, '[\\x00-\\x09\\x0B-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+', ' ', 'g')"


def _digest(lines: str) -> str:
    return f"md5(nullif(trim(regexp_replace(replace({lines}, chr(10), ' '), '  +', ' ', 'g')), ''))"


_KNOWN = ", ".join(f"({_q(k)}, {_q(t)})" for k, t in KNOWN)
OP1 = f"""
WITH known AS (SELECT {_digest(_canonical('t'))} AS digest, min(k) AS license FROM (VALUES {_KNOWN}) v(k, t) GROUP BY 1),
d AS (SELECT row_number() OVER () AS row, doc_id, {_canonical('text')} AS c FROM documents),
units AS (SELECT row, false AS wrapped, unnest(string_split(c, chr(10))) AS unit FROM d
          UNION ALL SELECT row, true, unnest(list_filter(string_split_regex(c, '\\n *(?:\\n *)+'), lambda x: contains(x, chr(10)))) FROM d),
hits AS (SELECT row, wrapped, array_to_string(list_sort(list(DISTINCT license)), ',') AS licenses, count(*) AS n
         FROM units JOIN known ON {_digest('unit')} = known.digest GROUP BY row, wrapped)
SELECT d.doc_id, known.license AS whole_license, coalesce(l.licenses, '') AS line_licenses,
       CAST(coalesce(l.n, 0) AS BIGINT) AS n_lines_matched, coalesce(p.licenses, '') AS paragraph_licenses,
       CAST(coalesce(p.n, 0) AS BIGINT) AS n_paragraphs_matched
FROM d LEFT JOIN known ON {_digest('c')} = known.digest LEFT JOIN hits l ON l.row = d.row AND NOT l.wrapped
     LEFT JOIN hits p ON p.row = d.row AND p.wrapped"""

#: Closure of a symmetric relation links(a, b): the smallest node reachable from each node.
_CLOSURE = """
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT a, b FROM both_ways UNION SELECT r.a, e.b FROM reach r JOIN both_ways e ON r.b = e.a),
root AS (SELECT a, min(b) AS root FROM reach GROUP BY a)"""

OP4 = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), {_LOWER}), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
                ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s FROM words),
classes AS (SELECT min(doc_id) AS rep, list_sort(s) AS s, len(any_value(s)) AS n FROM sets WHERE len(s) > 0 GROUP BY list_sort(s)),
grams AS (SELECT rep, n, unnest(s) AS g FROM classes),
rare AS (SELECT rep, n, g FROM (SELECT rep, n, g, row_number() OVER (PARTITION BY rep ORDER BY df, g) AS p
         FROM grams JOIN (SELECT g, count(*) AS df FROM grams GROUP BY g) USING (g)) WHERE p <= n - (80 * n + 99) // 100 + 1),
pairs AS (SELECT DISTINCT x.rep AS a, y.rep AS b FROM rare x JOIN rare y ON x.g = y.g AND x.rep < y.rep
          AND 100 * least(x.n, y.n) >= 80 * greatest(x.n, y.n)),
links AS (SELECT a, b FROM pairs JOIN classes x ON x.rep = a JOIN classes y ON y.rep = b
          WHERE 100 * len(list_intersect(x.s, y.s)) >= 80 * (x.n + y.n - len(list_intersect(x.s, y.s)))),
{_CLOSURE},
member AS (SELECT d.doc_id, len(d.s) AS n_shingles,
                  coalesce(least(root, rep), rep, d.doc_id) AS component_id
           FROM sets d LEFT JOIN classes c ON c.s = list_sort(d.s) LEFT JOIN root ON root.a = c.rep)
SELECT doc_id, CAST(n_shingles AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept FROM member"""

OP5 = """
WITH lines AS (
  SELECT doc_id, i, line, list_distinct(list_filter(string_split_regex(lower(line), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')) AS w
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i
        FROM documents)),
classes AS (SELECT row_number() OVER (ORDER BY f) AS id, f, w, len(w) AS n
            FROM (SELECT min((doc_id, i)) AS f, list_sort(w) AS w FROM lines WHERE len(w) >= 5 GROUP BY list_sort(w))),
toks AS (SELECT id, n, unnest(w) AS t FROM classes),
rare AS (SELECT id, n, t FROM (SELECT id, n, t, row_number() OVER (PARTITION BY id ORDER BY df, t) AS p
         FROM toks JOIN (SELECT t, count(*) AS df FROM toks GROUP BY t) USING (t)) WHERE p <= n - (80 * n + 99) // 100 + 1),
pairs AS (SELECT DISTINCT x.id AS a, y.id AS b FROM rare x JOIN rare y ON x.t = y.t AND x.id < y.id
          AND 100 * least(x.n, y.n) >= 80 * greatest(x.n, y.n)),
gone AS (SELECT DISTINCT b AS id FROM pairs JOIN classes x ON x.id = a JOIN classes y ON y.id = b
         WHERE 100 * len(list_intersect(x.w, y.w)) >= 80 * (x.n + y.n - len(list_intersect(x.w, y.w)))),
marked AS (SELECT l.doc_id, l.i, l.line,
                  c.id IS NOT NULL AND ((l.doc_id, l.i) <> c.f OR g.id IS NOT NULL) AS out
           FROM lines l LEFT JOIN classes c ON len(l.w) >= 5 AND c.w = list_sort(l.w) LEFT JOIN gone g ON g.id = c.id)
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (WHERE out) AS BIGINT) AS n_removed,
       coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT out), '') AS clean
FROM marked GROUP BY doc_id
UNION ALL SELECT doc_id, 0, 0, NULL FROM documents WHERE text IS NULL"""

_FINITE = "{0} IS NOT NULL AND len(list_filter({0}, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len({0}) > 0"
OP7 = f"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q FROM embeddings
           WHERE {_FINITE.format('embedding')}),
s AS (SELECT a.vec_id AS query_id, b.vec_id, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5"""

_RULES = ", ".join(f"({_q(a)}, {_q(r)})" for a, r in RULES)
_HOST = "translate(regexp_extract({0}, '(?s)^.*?://([^/?#]*)', 1), " + _LOWER + ")"
_PATH = "regexp_extract({0}, '(?s)^.*?://[^/?#]*([^?#]*)', 1)"
_KEY = ("nullif(translate(regexp_extract({0}, '(?s)^(.*?://[^/?#]*)', 1), " + _LOWER
        + ") || regexp_extract({0}, '(?s)^.*?://[^/?#]*([^#]*)', 1), '')")
_LINK = "regexp_extract({1}, '(?is)\\bhref\\s*=\\s*(?:\"([^\"]*)\"|''([^'']*)''|([^\\s\"''>]+))', {0})"
_HREF = "trim(replace(" + " || ".join(_LINK.replace("{0}", str(n)) for n in (1, 2, 3)).replace("{1}", "{0}") + ", '&amp;', '&'))"
_REL = ("'(?is)\\srel\\s*=\\s*(?:\"(?:[^\"]*\\s)?canonical(?:\\s[^\"]*)?\"|''(?:[^'']*\\s)?canonical(?:\\s[^'']*)?''|canonical[\\s/>])'")


def _plain(path: str) -> str:
    """A path without dot segments."""
    parts = f"string_split(substr({path}, 2), '/')"
    return (f"('/' || array_to_string(list_concat(list_reduce(list_transform({parts}, lambda x: [x]), lambda done, x: "
            "CASE x[1] WHEN '.' THEN done WHEN '..' THEN done[1:len(done) - 1] ELSE list_concat(done, x) END, CAST([] AS VARCHAR[])), "
            f"CASE WHEN {parts}[-1] IN ('.', '..') THEN [''] ELSE CAST([] AS VARCHAR[]) END), '/'))")


def _resolved(ref: str, base: str) -> str:
    origin = f"regexp_extract({base}, '(?s)^(.*?://[^/?#]*)', 1)"
    here = f"regexp_extract({base}, '(?s)^.*?://[^/?#]*([^?#]*)', 1)"
    path, tail = f"regexp_extract({ref}, '(?s)^([^?#]*)', 1)", f"regexp_extract({ref}, '(?s)^[^?#]*(.*)$', 1)"
    folder = f"coalesce(nullif(regexp_extract({here}, '(?s)^(.*/)', 1), ''), '/')"
    return f"""CASE WHEN {ref} = '' OR starts_with({ref}, '#') THEN NULL
    WHEN regexp_matches({ref}, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN {ref}
    WHEN regexp_matches({ref}, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN NULL
    WHEN starts_with({ref}, '//') THEN regexp_extract({base}, '(?s)^(.*?:)//', 1) || {ref}
    WHEN starts_with({ref}, '?') THEN {origin} || {here} || {ref}
    WHEN starts_with({ref}, '/') THEN {origin} || {_plain(path)} || {tail}
    ELSE {origin} || {_plain(f'({folder} || {path})')} || {tail} END"""


OP8 = f"""
WITH RECURSIVE found AS (
  SELECT url, regexp_extract_all(regexp_replace(html, '(?is)<!--.*?-->|<script\\b.*?</script\\s*>', ' ', 'g'),
                                 '(?is)<(?:link|meta|base)\\s(?:[^>"'']|"[^"]*"|''[^'']*'')*>') AS tags
  FROM pages WHERE regexp_matches(html, '(?i)canonical|http-equiv') AND contains(url, '://')),
bases AS (
  SELECT url, tags, {_HREF.format('own')} AS ref
  FROM (SELECT *, list_filter(tags, lambda t: regexp_matches(t, '(?is)^<base') AND regexp_matches(t, '(?is)\\bhref\\s*='))[1] AS own FROM found)),
tags AS (SELECT url, coalesce({_resolved('ref', 'url')}, url) AS base, unnest(tags) AS tag FROM bases),
targets AS (
  SELECT url, base, CASE
    WHEN regexp_matches(tag, '(?is)^<link') AND regexp_matches(tag, {_REL}) THEN {_HREF.format('tag')}
    WHEN regexp_matches(tag, '(?is)^<meta') AND regexp_matches(tag, '(?is)\\bhttp-equiv\\s*=\\s*["'']?refresh\\b')
      THEN trim(replace(regexp_extract(tag, '(?is)\\bcontent\\s*=\\s*["'']?\\s*[0-9.]*\\s*[;,]?\\s*url\\s*=\\s*[''"]?([^"''>]+)', 1), '&amp;', '&')) END AS t
  FROM tags),
full_urls AS (SELECT url, {_resolved('t', 'base')} AS t FROM targets WHERE t IS NOT NULL),
links AS (SELECT DISTINCT {_KEY.format('url')} AS a, {_KEY.format('t')} AS b FROM full_urls
          WHERE {_KEY.format('t')} IS NOT NULL AND {_KEY.format('t')} <> {_KEY.format('url')}),
{_CLOSURE},
rules AS (SELECT action, rule, regexp_extract(rule, '^([^/]*)', 1) AS rh, regexp_extract(rule, '^[^/]*(.*)$', 1) AS rp
          FROM (VALUES {_RULES}) v(action, rule)),
p AS (SELECT page_id, coalesce({_HOST.format('url')}, '') AS host, coalesce({_PATH.format('url')}, '') AS path,
             {_KEY.format('url')} AS key FROM pages),
nodes AS (SELECT a AS key, least(a, root) AS root, {_HOST.format('a')} AS host, {_PATH.format('a')} AS path FROM root),
judged AS (SELECT host, path, arg_max(rule, (length(rule), action = 'allow')) AS rule,
                  arg_max(action, (length(rule), action = 'allow')) AS action
           FROM (SELECT host, path FROM p UNION SELECT host, path FROM nodes) u
           JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY host, path),
blocked AS (SELECT DISTINCT root FROM nodes JOIN judged USING (host, path) WHERE action = 'block')
SELECT page_id, p.host, p.path, rule, coalesce(action,
       CASE WHEN key IN (SELECT n.key FROM nodes n JOIN blocked USING (root)) THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN judged j ON j.host = p.host AND j.path = p.path"""

OP9 = f"""
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
           WHERE {_FINITE.format('embedding')} AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id < b.vec_id AND len(a.x) = len(b.x)
          AND list_cosine_similarity(a.x, b.x) >= 0.95),
{_CLOSURE},
degree AS (SELECT a, count(*) AS n FROM both_ways GROUP BY a)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, least(vec_id, coalesce(root, vec_id)) AS component_id,
       vec_id = least(vec_id, coalesce(root, vec_id)) AS kept
FROM embeddings LEFT JOIN degree ON degree.a = vec_id LEFT JOIN root ON root.a = vec_id"""



def _codes(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Rounds of exact assignment and rounded-down means, one pair of steps after the other."""
    near = """{a} AS MATERIALIZED (
  SELECT vec_id, label, part, x, arg_min(e, (d, e)) AS e, min(d) AS d FROM (
    SELECT p.*, c.e, list_sum(list_transform(list_zip(p.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
    FROM p JOIN {c} c USING (part)) GROUP BY ALL)"""
    step = """{n} AS MATERIALIZED (
  SELECT c.part, c.e, coalesce(m.x, c.x) AS x FROM {c} c LEFT JOIN (
    SELECT part, e, list(y ORDER BY i) AS x FROM (
      SELECT part, e, i, CAST(floor(CAST(sum(v) AS DOUBLE) / count(*)) AS BIGINT) AS y
      FROM (SELECT part, e, unnest(x) AS v, generate_subscripts(x, 1) AS i FROM {a}) GROUP BY part, e, i) GROUP BY part, e) m USING (part, e))"""
    ctes = [near.format(a="a0", c="c0")]
    for r in range(rounds):
        ctes += [step.format(n=f"c{r + 1}", c=f"c{r}", a=f"a{r}"), near.format(a=f"a{r + 1}", c=f"c{r + 1}")]
    return f"""
WITH v AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
           FROM embeddings WHERE {_FINITE.format('embedding')}),
p AS (SELECT vec_id, label, part, q[part * (len(q) // {parts}) + 1:(part + 1) * (len(q) // {parts})] AS x FROM v, range({parts}) t(part)),
c0 AS (SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS e, x FROM p
       WHERE vec_id IN (SELECT vec_id FROM v ORDER BY vec_id LIMIT {entries})),
{", ".join(ctes)},
rows AS (SELECT vec_id, any_value(label) AS label, string_agg(format('{{:02x}}', e), '' ORDER BY part) AS code,
                CAST(sum(d) AS BIGINT) AS error FROM a{rounds} GROUP BY vec_id)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, e)) FROM c{rounds}) AS codebooks_sha256
FROM rows"""


OP11 = _codes()

OP12 = """
WITH h AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
g AS (SELECT r, i, md5(substr(h, 2 * i + 1, 400)) AS m
      FROM (SELECT r, h, unnest(range(0, length(h) // 2 - 199)) AS i FROM h)),
hits AS (SELECT r, i FROM g WHERE m IN (SELECT m FROM g GROUP BY m HAVING count(*) > 1)),
islands AS (SELECT r, i, sum(CAST(fresh AS INTEGER)) OVER (PARTITION BY r ORDER BY i) AS s
            FROM (SELECT r, i, coalesce(i > lag(i) OVER (PARTITION BY r ORDER BY i) + 200, true) AS fresh FROM hits)),
spans AS (SELECT r, min(i) AS lo, max(i) + 200 AS hi FROM islands GROUP BY r, s),
ends AS (SELECT r, lo, hi FROM spans UNION ALL SELECT r, length(h) // 2, length(h) // 2 FROM h),
kept AS (SELECT r, string_agg(substr(h, 2 * last + 1, 2 * (lo - last)), '' ORDER BY lo, hi) AS k
         FROM (SELECT r, lo, hi, coalesce(lag(hi) OVER (PARTITION BY r ORDER BY lo, hi), 0) AS last FROM ends) JOIN h USING (r) GROUP BY r),
n AS (SELECT r, count(*) AS n_spans, sum(hi - lo) AS n_removed FROM spans GROUP BY r)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(k)) AS kept_sha256
FROM h JOIN kept USING (r) LEFT JOIN n USING (r)"""

OP13 = f"""
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
           FROM embeddings WHERE label IS NOT NULL AND {_FINITE.format('embedding')}),
s AS MATERIALIZED (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
pos AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM pos JOIN s USING (anchor_id) WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) <= 3"""

ORACLE = {
    "op1_license_scan": OP1, "op4_minhash_dedup": OP4, "op5_line_dedup": OP5, "op7_topk_search": OP7,
    "op8_url_filter": OP8, "op9_embedding_dedup": OP9, "op11_vector_codes": OP11, "op12_suffix_dedup": OP12,
    "op13_hard_negatives": OP13,
}
