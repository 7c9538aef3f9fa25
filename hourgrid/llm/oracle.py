"""The same results as SQL, written plainly: every window, every pair, every page."""

from __future__ import annotations

import string

SPACED = r"[^\x20\x09-\x0D]+"
PLAIN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lowered(column: str) -> str:
    return f"translate(coalesce({column}, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"


OP2 = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{SPACED}') AS w FROM documents),
win AS (
  SELECT doc_id, p, md5(array_to_string(w[p:p + 49], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS p FROM d)
),
first AS (SELECT h, min(doc_id) AS m FROM win GROUP BY h),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(p, p + 50)) AS i FROM win JOIN first USING (h) WHERE doc_id > m
),
words AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM d),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(x, ' ' ORDER BY i) AS t
  FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

OP3 = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({lowered("text")}, '{SPACED}') AS w FROM documents),
grams AS (
  SELECT DISTINCT doc_id, array_to_string(w[p:p + 3], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS p FROM d WHERE len(w) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
pairs AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared
  FROM grams x JOIN grams y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL
),
links AS (
  SELECT a, b FROM pairs JOIN sizes s ON s.doc_id = a JOIN sizes t ON t.doc_id = b
  WHERE 100 * shared >= 85 * (s.n + t.n - shared)
),
reached(doc_id, other) AS (
  SELECT doc_id, doc_id FROM d UNION SELECT r.doc_id, l.b FROM reached r JOIN links l ON l.a = r.other
)
SELECT doc_id, coalesce(max(n), 0)::BIGINT AS n_shingles, min(other) AS component_id
FROM reached LEFT JOIN sizes USING (doc_id) GROUP BY doc_id
"""

_RECORD = (
    "(strlen('WARC/1.1') + strlen('WARC-Type: resource') + strlen('WARC-Record-ID: <urn:page:') + strlen(page_id::VARCHAR) "
    "+ strlen('>') + strlen('WARC-Date: 1970-01-01T00:00:00Z') + strlen('WARC-Target-URI: ') + strlen(url) "
    "+ strlen('Content-Type: text/html') + strlen('Content-Length: ') + strlen(strlen(html)::VARCHAR) + strlen(html) + 2 * 10)"
)

OP4 = f"""
WITH first AS (SELECT page_id, html, {_RECORD}::BIGINT AS bytes,
                      (sum({_RECORD}) OVER (ORDER BY page_id) - {_RECORD})::BIGINT AS start, url FROM pages),
kept AS (
  SELECT page_id, url, CASE WHEN page_id % 97 = 13 THEN '#' || substr(html, 2)
                            WHEN page_id % 389 = 11 THEN substr(html, 1, length(html) // 2) ELSE html END AS html,
         CASE WHEN page_id % 401 = 9 THEN start + 7 ELSE start END AS start
  FROM first WHERE page_id % 211 <> 7
  UNION ALL SELECT -page_id - 1, url, html, start + bytes FROM first WHERE page_id % 307 = 5
),
second AS (SELECT *, {_RECORD}::BIGINT AS bytes FROM kept),
here AS (
  SELECT a.page_id AS pa, b.page_id AS pb, a.start AS offset_a, b.start AS offset_b, a.bytes AS bytes_a, b.bytes AS bytes_b,
         a.html AS html_a, b.html AS html_b
  FROM first a FULL JOIN second b ON a.page_id = b.page_id AND a.start = b.start
),
gone AS (SELECT pa, offset_a, bytes_a, html_a FROM here WHERE pb IS NULL),
fresh AS (SELECT pb, offset_b, bytes_b, html_b FROM here WHERE pa IS NULL),
found AS (
  SELECT pa AS page_id, 'altered' AS status, offset_a, bytes_a, offset_b, bytes_b FROM here WHERE pa = pb AND html_a <> html_b
  UNION ALL
  SELECT coalesce(pa, pb), CASE WHEN pb IS NULL THEN 'missing' WHEN pa IS NULL THEN 'added' ELSE 'moved' END,
         offset_a, bytes_a, offset_b, bytes_b
  FROM gone FULL JOIN fresh ON pa = pb AND html_a = html_b
)
SELECT page_id, status, CASE WHEN offset_a IS NOT NULL THEN 1::BIGINT END AS records_a, offset_a, bytes_a,
       CASE WHEN offset_b IS NOT NULL THEN 1::BIGINT END AS records_b, offset_b, bytes_b
FROM found
"""


def op7(rules: list[tuple[str, str]], tail: float, strengths: tuple[float, float], suffixes) -> str:
    """Rules, and the shrinkage from suffix over domain to host; beta distributions as cells over the angle."""
    fits = []
    for verdict, rule in rules:
        name, _, rest = rule.partition("/")
        fits.append(
            f"SELECT page_id, '{rule}' AS rule, '{verdict}' AS action FROM p "
            f"WHERE (host = '{name}' OR ends_with(host, '.{name}')) AND starts_with(path, '/{rest}')"
        )
    low, high = strengths
    two = ", ".join(f"'{s}'" for s in suffixes)
    name = r"regexp_replace(host, '^.*@|:[0-9]*$|\.$', '', 'g')"
    parts, above = [], "everything"
    keys: list[str] = []
    for level in ("suffix", "domain", "host"):
        upper, keys = list(keys), [*keys, level]
        k = ", ".join(keys)
        same = " AND ".join(f"g.{c} = u.{c}" for c in upper) or "true"
        parts.append(f"""
g_{level} AS (
  SELECT {", ".join("g." + c for c in keys)}, g.n, g.bad,
         (u.bad - g.bad + u.strength * u.prior) / (u.n - g.n + u.strength) AS prior
  FROM (SELECT {k}, sum(n) AS n, sum(bad) AS bad FROM counted GROUP BY {k}) g JOIN {above} u ON {same}
),
s_{level} AS (
  SELECT least(greatest(coalesce(CASE WHEN weight > chance THEN
           CASE WHEN scatter <= chance THEN {high} ELSE (weight - chance) / (scatter - chance) - 1 END END, {high}),
           {low}), {high}) AS strength
  FROM (SELECT sum(n * power(bad / n - prior, 2)) AS scatter, sum(prior * (1 - prior)) AS chance,
               sum(n * prior * (1 - prior)) AS weight FROM g_{level} WHERE n > 0)
),
k_{level} AS (SELECT * FROM g_{level} CROSS JOIN s_{level})""")
        above = f"k_{level}"
    return rf"""
WITH p AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1),
                            '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS host,
         regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
),
named AS (
  SELECT DISTINCT host, {name} AS name, string_split({name}, '.') AS l FROM p
),
placed AS (
  SELECT host,
    CASE WHEN regexp_matches(name, '^[0-9.]+$|^\[') THEN name
         WHEN array_to_string(l[-2:], '.') IN ({two}) THEN array_to_string(l[-3:], '.')
         ELSE array_to_string(l[-2:], '.') END AS domain,
    CASE WHEN regexp_matches(name, '^[0-9.]+$|^\[') THEN ''
         WHEN array_to_string(l[-2:], '.') IN ({two}) THEN array_to_string(l[-2:], '.') ELSE l[-1] END AS suffix
  FROM named
),
seen AS (
  SELECT host, count(*) AS n, sum((quality = 0 OR toxic = 1)::INT) AS bad
  FROM p JOIN labels ON doc_id = TRY_CAST(regexp_extract(path, '/([0-9]+)', 1) AS BIGINT)
  WHERE (quality = 0 OR toxic = 1) IS NOT NULL GROUP BY host
),
counted AS (SELECT host, domain, suffix, coalesce(n, 0) AS n, coalesce(bad, 0) AS bad FROM placed LEFT JOIN seen USING (host)),
everything AS (SELECT sum(n) AS n, sum(bad) AS bad, 0.5::DOUBLE AS prior, 1.0::DOUBLE AS strength FROM counted),{",".join(parts)},
m_host AS (SELECT host, n, bad, bad + strength * prior AS a, n + strength - (bad + strength * prior) AS b FROM k_host),
bounds AS (
  SELECT *, greatest(asin(sqrt(a / (a + b))) - 4 / sqrt(a + b + 1), 0) AS lo,
         least(asin(sqrt(a / (a + b))) + 4 / sqrt(a + b + 1), pi() / 2) AS hi FROM m_host
),
angles AS (SELECT *, (hi - lo) / 256 AS h, unnest(range(256)) AS k FROM bounds),
logs AS (
  SELECT *, (2 * a - 1) * ln(sin(lo + (k + 0.5::DOUBLE) * h)) + (2 * b - 1) * ln(cos(lo + (k + 0.5::DOUBLE) * h)) AS f FROM angles
),
cells AS (SELECT *, exp(f - max(f) OVER (PARTITION BY host)) AS w FROM logs),
runs AS (
  SELECT *, sum(w) OVER (PARTITION BY host ORDER BY k) AS run, {tail}::DOUBLE * sum(w) OVER (PARTITION BY host) AS goal FROM cells
),
known AS (
  SELECT host, any_value(n) AS n, any_value(bad) AS bad, any_value(a / (a + b)) AS share,
         arg_min(pow(sin(lo + (k + (goal - run + w) / w) * h), 2), k) AS low
  FROM runs WHERE run >= goal GROUP BY host
),
rules AS ({" UNION ALL ".join(fits)}),
best AS (SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(action, length(rule)) AS action FROM rules GROUP BY page_id)
SELECT page_id, host, path, rule,
       coalesce(action, CASE WHEN low > (SELECT sum(bad) / sum(n) FROM known) THEN 'block' ELSE 'allow' END) AS verdict,
       round(share, 6) AS share, round(low, 6) AS low
FROM p JOIN known USING (host) LEFT JOIN best USING (page_id)
"""


OP10 = f"""
WITH d AS (SELECT doc_id, regexp_extract_all({lowered("text")}, '{PLAIN}') AS w FROM documents),
i AS (SELECT item_id, regexp_extract_all({lowered("text")}, '{PLAIN}') AS w FROM benchmark),
phrases AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[p:p + 9], ' ') AS t
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 8, 2))) AS p FROM i WHERE len(w) > 0)
),
win AS (
  SELECT doc_id, k, p, array_to_string(w[p:p + k - 1], ' ') AS t
  FROM (SELECT doc_id, k, w, unnest(range(1, len(w) - k + 2)) AS p FROM d CROSS JOIN (SELECT DISTINCT k FROM phrases))
),
hits AS (SELECT doc_id, win.k, p, item_id FROM win JOIN phrases USING (k, t)),
words AS (
  SELECT doc_id, count(DISTINCT x) AS n FROM (SELECT doc_id, unnest(range(p, p + k)) AS x FROM hits) GROUP BY doc_id
),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(listed, '')) AS items_sha256, coalesce(n, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""


OP11 = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scores AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS alike,
         list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
),
positives AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM scores WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5
)
SELECT anchor_id, positive_id,
       row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other)::INT AS rank,
       other AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scores USING (anchor_id)
WHERE NOT alike AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5
"""

OP12 = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '{SPACED}') AS w
  FROM documents
),
marks AS (SELECT doc_id, max(quality) FILTER (quality = 1) AS good, max(toxic) FILTER (toxic = 1) AS toxic FROM labels GROUP BY 1),
failed AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         (len(w) < 50)::INT AS a, (100 * len(list_distinct(w)) < 65 * len(w))::INT AS b,
         (100 * len(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * len(t))::INT AS c,
         regexp_matches(t, '[#$%&*|]')::INT AS d,
         coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)::INT AS e
  FROM d LEFT JOIN marks USING (doc_id)
),
cells AS (
  SELECT part, a + 2 * b + 4 * c + 8 * d + 16 * e AS mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic
  FROM failed GROUP BY ALL
),
filters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter, unnest([1, 2, 4, 8, 16]) AS bit),
orders(name, bits) AS (
  SELECT '', 0 UNION ALL SELECT name || letter, bits | bit FROM orders JOIN filters ON bits & bit = 0
),
steps AS (
  SELECT o.name AS filter_order, s.step::INT AS step, f.letter, f.bit, b.bits AS before
  FROM orders o, range(1, 6) s(step), filters f, orders b
  WHERE length(o.name) = 5 AND f.letter = o.name[s.step] AND b.name = o.name[1:s.step - 1]
),
done AS (
  SELECT part, filter_order, step, letter,
         sum(CASE WHEN mask & (before | bit) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
         sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN n ELSE 0 END)::BIGINT AS removed,
         sum(CASE WHEN mask & bit <> 0 AND mask & before <> 0 THEN n ELSE 0 END)::BIGINT AS redundant,
         sum(CASE WHEN mask = bit THEN n ELSE 0 END)::BIGINT AS unique_fails,
         sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN good ELSE 0 END)::BIGINT AS good_lost,
         sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM steps, cells GROUP BY ALL
)
SELECT * EXCLUDE (letter), (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley FROM done
"""


def op13(phrases, templates, percent: int, block: int, step: int) -> str:
    """Every block against every template."""
    quoted = lambda text: "'" + text.replace("'", "''") + "'"
    table = lambda rows: ", ".join(f"({quoted(a)}, {quoted(b)})" for a, b in rows)
    return rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({lowered("text")}, '{PLAIN}') AS w FROM documents),
phrases AS (
  SELECT label, regexp_extract_all({lowered("phrase")}, '{PLAIN}') AS p FROM (VALUES {table(phrases)}) x(label, phrase)
),
templates AS (
  SELECT label, list_distinct(regexp_extract_all({lowered("phrase")}, '{PLAIN}')) AS t
  FROM (VALUES {table(templates)}) x(label, phrase)
),
starts AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS s FROM d),
places AS (SELECT doc_id, label, s - 1 AS s FROM starts JOIN phrases ON w[s] = p[1] AND w[s:s + len(p) - 1] = p),
base AS (
  SELECT doc_id, count(*) AS n, min(s) AS low, max(s) AS high, list(DISTINCT label) AS labels FROM places GROUP BY doc_id
),
blocks AS (
  SELECT doc_id, w[s + 1:s + {block}] AS b
  FROM (SELECT doc_id, w, unnest(range(0, greatest(ceil((len(w) - {block}) / {step}), 0)::BIGINT * {step} + 1, {step})) AS s FROM d)
),
matches AS (
  SELECT doc_id, label, len(list_intersect(b, t)) AS shared, len(t) AS size FROM blocks, templates
  WHERE 100 * len(list_intersect(b, t)) >= {percent} * len(t)
),
method AS (SELECT doc_id, list(DISTINCT label) AS labels, max(shared / size) AS score FROM matches GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_base, low::BIGINT AS first_word, high::BIGINT AS last_word,
       array_to_string(list_sort(coalesce(base.labels, [])), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(coalesce(base.labels, []) || coalesce(method.labels, []))), ',') AS labels,
       coalesce(score, 0)::DOUBLE AS score
FROM d LEFT JOIN base USING (doc_id) LEFT JOIN method USING (doc_id)
"""
