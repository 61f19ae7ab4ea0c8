"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from gridpulse.llm import manifest, mixing, urls

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

MIXING = f"""
WITH RECURSIVE sized AS (
  SELECT source, sum(greatest(coalesce(strlen(text), 0), 1)) AS bytes FROM documents GROUP BY source
), weighted AS (
  SELECT source, bytes, pow(bytes::DOUBLE, {mixing.EXPONENT}) AS weight FROM sized
), rates AS (
  SELECT source, weight / (SELECT sum(weight) FROM weighted) * (SELECT sum(bytes) FROM sized)::DOUBLE / bytes AS rate
  FROM weighted
), steps(source, rate, k, p, s) AS (
  SELECT source, rate, 0, exp(-rate), exp(-rate) FROM rates
  UNION ALL
  SELECT source, rate, k + 1, p * rate / (k + 1), s + p * rate / (k + 1) FROM steps
  WHERE k < ceil(rate + 12 * sqrt(rate) + 30)
), drawn AS (
  SELECT *, (('0x' || substr(md5('{mixing.SEED}:' || doc_id || ':0'), 1, 13))::BIGINT + 0.5) / {mixing._UNIT}::DOUBLE AS u
  FROM documents
), counted AS (
  SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, count(t.s) AS n
  FROM drawn d LEFT JOIN steps t ON t.source IS NOT DISTINCT FROM d.source AND t.s < d.u
  GROUP BY ALL
), copies AS (
  SELECT doc_id, text, lang, source, n_chars, unnest(range(1, n + 1))::INTEGER AS copy FROM counted
)
SELECT *, md5('{mixing.SEED}:' || doc_id || ':' || copy) AS shuffle_key FROM copies
"""


def _model(order: int) -> str:
    """The n-grams of one order, smoothed by the order below."""
    context = f"left(right(gram, {order}), {order - 1})"
    if order == 1:
        lower, join = f"1.0 / {urls.ALPHABET}", ""
        sides = {side: lower for side in "ab"}
    else:
        sides = {side: f"l.p{side}" for side in "ab"}
        join = f"JOIN order_{order - 1} l ON l.gram = right(g.gram, {order - 1})"
    p = {
        side: f"(g.{side} + {urls.SMOOTHING}::DOUBLE * {sides[side]}) / (c.{side} + {urls.SMOOTHING}::DOUBLE)" for side in "ab"
    }
    return f"""
, order_{order} AS (
  SELECT g.gram, {p["a"]} AS pa, {p["b"]} AS pb
  FROM (SELECT right(gram, {order}) AS gram, sum(a) AS a, sum(b) AS b FROM counts GROUP BY 1) g
  JOIN (SELECT {context} AS context, sum(a) AS a, sum(b) AS b FROM counts GROUP BY 1) c
    ON c.context = left(g.gram, {order - 1})
  {join}
  WHERE g.a + g.b >= {urls.MIN_GRAMS}
)"""


def _rule_cases() -> tuple[str, str]:
    longest_first = sorted(urls.RULES, key=lambda r: -len(r.name))
    fits = [
        f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN "
        for r in longest_first
    ]
    names = " ".join(f"{f}'{r.name}'" for f, r in zip(fits, longest_first))
    verdicts = " ".join(f"{f}'{r.verdict}'" for f, r in zip(fits, longest_first))
    return f"CASE {names} END", f"CASE {verdicts} END"


_NAMES, _VERDICTS = _rule_cases()
_ORDERS = range(1, urls.ORDER + 1)
_LLR = "coalesce(" + ", ".join(f"round(ln(m{k}.pa / m{k}.pb) * {urls.MICRO})::BIGINT" for k in reversed(_ORDERS)) + ", 0)"

URLS = f"""
WITH rest AS (
  SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), parts AS (
  SELECT page_id, url, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rest
), ruled AS (
  SELECT *, {_NAMES} AS rule, {_VERDICTS} AS ruled FROM parts
), urls AS (
  SELECT DISTINCT url, ruled AS verdict, left(md5(url), 1) IN {urls.HELD_OUT} AS held_out FROM ruled WHERE url <> ''
), padded AS (
  SELECT *, repeat(chr(1), {urls.ORDER - 1}) || translate(url, '{_UPPER}', '{_LOWER}') || chr(2) AS padded FROM urls
), positions AS (
  SELECT url, verdict, held_out, substr(padded, i, {urls.ORDER}) AS gram
  FROM padded, unnest(range(1, length(url) + 2)) AS t(i)
), counts AS (
  SELECT gram, sum((verdict = 'allow')::INTEGER) AS a, sum((verdict = 'block')::INTEGER) AS b
  FROM positions WHERE verdict IS NOT NULL AND NOT held_out GROUP BY gram
)
{"".join(_model(k) for k in _ORDERS)}
, totals AS (
  SELECT url, sum({_LLR}) AS total, count(*) AS n FROM positions p
  {" ".join(f"LEFT JOIN order_{k} m{k} ON m{k}.gram = right(p.gram, {k})" for k in _ORDERS)}
  GROUP BY url
), scores AS (
  SELECT url, greatest(-{urls.BINS}, least({urls.BINS}, floor(total / (n * {urls.BIN}::DOUBLE)))) AS bin FROM totals
), bins AS (
  SELECT bin, sum((verdict = 'allow')::INTEGER) AS a, sum((verdict = 'block')::INTEGER) AS b
  FROM urls JOIN scores USING (url) WHERE verdict IS NOT NULL AND held_out GROUP BY bin
), ranked AS (
  SELECT bin, sum(a) OVER () AS all_a, sum(b) OVER () AS all_b,
    coalesce(sum(a) OVER below, 0) AS a_below, coalesce(sum(b) OVER below, 0) AS b_below
  FROM bins WINDOW below AS (ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), threshold AS (
  SELECT coalesce((SELECT bin FROM ranked WHERE all_a > 0 AND all_b > 0
    ORDER BY (all_a - a_below) * all_b + b_below * all_a DESC, bin LIMIT 1), 0) AS bin
)
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, rule,
  coalesce(ruled, CASE WHEN s.bin >= (SELECT bin FROM threshold) THEN 'allow' ELSE 'block' END) AS verdict
FROM ruled LEFT JOIN scores s USING (url)
"""


def _framed(*fields: str) -> str:
    texts = [f"CAST({f} AS VARCHAR)" for f in fields]
    return " || ".join(f"coalesce(strlen({t}) || ':' || {t}, '-')" for t in texts)


def _manifest(text: str) -> str:
    return f"sha256({_framed('doc_id', 'source', 'lang', 'n_chars', text)})"


_STEP = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"

# Trees grow by ARITY until a group has one node; ``nodes`` has every node of every level.
MANIFEST = f"""
WITH RECURSIVE bits(byte, k, c) AS (
  SELECT range, 0, range FROM range(256)
  UNION ALL
  SELECT byte, k + 1, {_STEP} FROM bits WHERE k < 8
), crc_table AS (
  SELECT list(c ORDER BY byte) AS crcs FROM bits WHERE k = 8
), digits(doc_id, place, c) AS (
  SELECT DISTINCT doc_id, 0, 4294967295::BIGINT FROM documents WHERE doc_id IS NOT NULL
  UNION ALL
  SELECT doc_id, place + 1, xor(c >> 8, (SELECT crcs FROM crc_table)[(xor(c, ascii(substr(doc_id::VARCHAR, place + 1, 1))) & 255) + 1])
  FROM digits WHERE place < length(doc_id::VARCHAR)
), altered AS (
  SELECT doc_id FROM digits WHERE place = length(doc_id::VARCHAR) AND xor(c, 4294967295) % 2 = 0
), leaves AS (
  SELECT coalesce('=' || source, '-') AS grp, doc_id, {_manifest("text")} AS leaf,
    CASE WHEN doc_id IN (SELECT doc_id FROM altered) THEN {_manifest("replace(text, chr(10), '')")} END AS changed
  FROM documents
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS slot FROM leaves
), nodes(grp, level, slot, node, n) AS (
  SELECT grp, 0, slot, leaf, count(*) OVER (PARTITION BY grp) FROM placed
  UNION ALL
  SELECT grp, level + 1, slot // {manifest.ARITY}, sha256(string_agg(node, '' ORDER BY slot)), max((n + {manifest.ARITY - 1}) // {manifest.ARITY})
  FROM nodes WHERE n > 1 GROUP BY grp, level + 1, slot // {manifest.ARITY}
), subroots AS (
  SELECT grp, node AS subroot, row_number() OVER (ORDER BY encode(grp)) - 1 AS rank FROM nodes WHERE n = 1
), tops(level, slot, node, n) AS (
  SELECT 0, rank, subroot, count(*) OVER () FROM subroots
  UNION ALL
  SELECT level + 1, slot // {manifest.ARITY}, sha256(string_agg(node, '' ORDER BY slot)), max((n + {manifest.ARITY - 1}) // {manifest.ARITY})
  FROM tops WHERE n > 1 GROUP BY level + 1, slot // {manifest.ARITY}
), steps AS (
  SELECT p.grp, p.slot, n.level, coalesce(string_agg(n.node, '' ORDER BY n.slot) FILTER (n.slot < p.slot // t.size), '') AS lefts,
    coalesce(string_agg(n.node, '' ORDER BY n.slot) FILTER (n.slot > p.slot // t.size), '') AS rights
  FROM placed p JOIN nodes n ON n.grp = p.grp AND n.n > 1
  JOIN (SELECT range AS level, CAST(pow({manifest.ARITY}, range) AS BIGINT) AS size FROM range(30)) t
    ON t.level = n.level AND n.slot // {manifest.ARITY} = p.slot // t.size // {manifest.ARITY}
  GROUP BY p.grp, p.slot, n.level
  UNION ALL
  SELECT p.grp, p.slot, 100 + n.level, coalesce(string_agg(n.node, '' ORDER BY n.slot) FILTER (n.slot < s.rank // t.size), ''),
    coalesce(string_agg(n.node, '' ORDER BY n.slot) FILTER (n.slot > s.rank // t.size), '')
  FROM placed p JOIN subroots s ON s.grp = p.grp JOIN tops n ON n.n > 1
  JOIN (SELECT range AS level, CAST(pow({manifest.ARITY}, range) AS BIGINT) AS size FROM range(30)) t
    ON t.level = n.level AND n.slot // {manifest.ARITY} = s.rank // t.size // {manifest.ARITY}
  GROUP BY p.grp, p.slot, n.level
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY grp, slot ORDER BY level) AS k FROM steps
), folds(grp, slot, k, node) AS (
  SELECT grp, slot, 0, coalesce(changed, leaf) FROM placed
  UNION ALL
  SELECT f.grp, f.slot, f.k + 1, sha256(s.lefts || f.node || s.rights) FROM folds f
  JOIN numbered s ON s.grp = f.grp AND s.slot = f.slot AND s.k = f.k + 1
), proofs AS (
  SELECT grp, slot, sha256(string_agg(lefts || rights, '' ORDER BY k)) AS proof, max(k) AS n FROM numbered GROUP BY grp, slot
), whole AS (
  SELECT node AS root FROM tops WHERE n = 1
)
SELECT p.doc_id, p.leaf, s.subroot, w.root, coalesce(q.proof, sha256('')) AS proof_sha256, f.node AS folded_root, f.node = w.root AS verified
FROM placed p JOIN subroots s USING (grp) CROSS JOIN whole w LEFT JOIN proofs q USING (grp, slot)
JOIN folds f ON f.grp = p.grp AND f.slot = p.slot AND f.k = coalesce(q.n, 0)
"""

_WORDS = "list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')"

AUDIT = f"""
WITH RECURSIVE texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents
), counted AS (
  SELECT *, {_WORDS} AS words, min(doc_id) OVER (PARTITION BY t) AS first FROM texts
), judged AS (
  SELECT part, (len(words) < 100)::INTEGER AS a, (100 * len(list_distinct(words)) < 80 * len(words))::INTEGER AS b,
    (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t))::INTEGER AS c,
    regexp_matches(t, '[#$%&*|]')::INTEGER AS d, coalesce(doc_id > first, false)::INTEGER AS e,
    doc_id IN (SELECT doc_id FROM labels WHERE quality = 1 AND doc_id IS NOT NULL) AS good,
    doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1 AND doc_id IS NOT NULL) AS toxic
  FROM counted
), sets AS (
  SELECT part, a + 2 * b + 4 * c + 8 * d + 16 * e AS failed, count(*) AS n,
    count(*) FILTER (good) AS n_good, count(*) FILTER (toxic) AS n_toxic
  FROM judged GROUP BY 1, 2
), orders(filter_order) AS (
  SELECT '' UNION ALL
  SELECT filter_order || f FROM orders, unnest(['A', 'B', 'C', 'D', 'E']) AS t(f) WHERE strpos(filter_order, f) = 0
), steps AS (
  SELECT filter_order, step::INTEGER AS step, 1 << (ascii(substr(filter_order, step, 1)) - 65) AS own,
    list_sum(list_transform(range(1, step), lambda k: 1 << (ascii(substr(filter_order, k, 1)) - 65))) AS earlier
  FROM (SELECT filter_order, unnest(range(1, 6)) AS step FROM orders WHERE length(filter_order) = 5)
), results AS (
  SELECT part, filter_order, step, own,
    coalesce(sum(n) FILTER (failed & (own | earlier) = 0), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (failed & own <> 0 AND failed & earlier = 0), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (failed & own <> 0 AND failed & earlier <> 0), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (failed = own), 0)::BIGINT AS unique_fails,
    coalesce(sum(n_good) FILTER (failed & own <> 0 AND failed & earlier = 0), 0)::BIGINT AS good_lost,
    coalesce(sum(n_toxic) FILTER (failed & own <> 0 AND failed & earlier = 0), 0)::BIGINT AS toxic_lost
  FROM sets, (SELECT filter_order, step, own::BIGINT AS own, coalesce(earlier, 0)::BIGINT AS earlier FROM steps)
  GROUP BY part, filter_order, step, own, earlier
)
SELECT * EXCLUDE (own), sum(removed) OVER (PARTITION BY part, own)::BIGINT AS shapley FROM results
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_mixing": MIXING, "op9_url_filters": URLS, "op11_merkle_manifest": MANIFEST, "op12_filter_audit": AUDIT}
