"""DuckDB SQL for the rows of the queries that SQL can express."""

from __future__ import annotations

OP1_MIXING = r"""
WITH sized AS (
  SELECT doc_id, source,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), turned AS (
  SELECT *, ([3.0, 1.0, 2.0]::DOUBLE[])[
      ((row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1)::INT] AS weight,
    source_size * 2.0::DOUBLE AS cap
  FROM sources
), levels AS (
  SELECT *, row_number() OVER w AS place,
    (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(cap) OVER (
        ORDER BY cap / weight, encode(source) NULLS LAST
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
      / sum(weight) OVER (ORDER BY cap / weight, encode(source) NULLS LAST
        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM turned WINDOW w AS (ORDER BY cap / weight, encode(source) NULLS LAST)
), opened AS (
  SELECT min(place) AS place, min_by(level, place) AS level FROM levels
  WHERE level * weight < cap
), targets AS (
  SELECT source, source_size,
    CASE WHEN l.place >= o.place THEN o.level * weight ELSE cap END AS target
  FROM levels l CROSS JOIN opened o
), rated AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM targets
)
SELECT doc_id, size, source_size, target,
  size * (floor(rate)::BIGINT + (
    ('0x' || substr(md5('mix|' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT
      / 4503599627370496.0 < rate - floor(rate))::BIGINT) AS taken
FROM sized JOIN rated ON sized.source IS NOT DISTINCT FROM rated.source
"""

OP2_TOP_K = r"""
WITH usable AS (
  SELECT vec_id::BIGINT AS vec_id,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM usable q JOIN usable c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
    AND len(q.v) = len(c.v)
)
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INT AS rank
  FROM pairs)
WHERE rank <= 5
"""

def _url_filter() -> str:
    levels = range(1, 6)
    joins = "\n  ".join(
        f"LEFT JOIN counts c{n} ON c{n}.gram = right(g.gram, {n})\n"
        f"  LEFT JOIN contexts x{n} ON x{n}.context = left(right(g.gram, {n}), {n - 1})"
        for n in levels
    )

    def chance(kind: str) -> str:
        found = "(SELECT 1.0::DOUBLE / (count(*) + 1) FROM counts WHERE length(gram) = 1)"
        for n in levels:
            found = (f"((coalesce(c{n}.{kind}, 0) + 2.0::DOUBLE * {found})"
                     f" / (coalesce(x{n}.{kind}, 0) + 2.0::DOUBLE))")
        return found

    return rf"""
WITH parts AS (
  SELECT page_id, coalesce(url, '') AS url,
    translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)([^?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '://([^/?#]*)([^?#]*)', 2) AS path FROM pages
), ruled AS (
  SELECT *, CASE
    WHEN ('.' || host) LIKE '%.example.org' AND path LIKE '/en/1%' THEN 'example.org/en/1'
    WHEN ('.' || host) LIKE '%.example.org' AND path LIKE '/es/%' THEN 'example.org/es/'
    WHEN ('.' || host) LIKE '%.com' AND path LIKE '/fr/%' THEN 'com/fr/'
    WHEN ('.' || host) LIKE '%.com' AND path LIKE '/de/%' THEN 'com/de/'
    WHEN ('.' || host) LIKE '%.org' AND path LIKE '/%' THEN 'org/' END AS rule
  FROM parts
), urls AS (
  SELECT DISTINCT url, rule IN ('org/', 'com/fr/') AS allowed,
    ('0x' || substr(md5(url), 1, 7))::BIGINT % 5 = 0 AS kept_out FROM ruled
), grams AS (
  SELECT url, allowed, kept_out,
    unnest(list_transform(range(1, length(url) + 2),
      lambda i: substr(repeat(chr(2), 4) || url || chr(3), i, 5))) AS gram FROM urls
), counts AS (
  SELECT right(gram, n) AS gram, count(*) FILTER (WHERE allowed) AS allowed,
    count(*) FILTER (WHERE NOT allowed) AS blocked
  FROM grams, range(1, 6) r(n) WHERE allowed IS NOT NULL AND NOT kept_out GROUP BY ALL
), contexts AS (
  SELECT left(gram, length(gram) - 1) AS context, sum(allowed) AS allowed, sum(blocked) AS blocked
  FROM counts GROUP BY ALL
), gains AS (
  SELECT g.gram, ln({chance("allowed")}) - ln({chance("blocked")}) AS gain
  FROM (SELECT DISTINCT gram FROM grams) g
  {joins}
), scores AS (
  SELECT url, any_value(allowed) AS allowed, any_value(kept_out) AS kept_out,
    round(sum(gain) / count(*), 6) AS score
  FROM grams JOIN gains USING (gram) GROUP BY url
), bins AS (
  SELECT round(score, 2) AS edge, count(*) FILTER (WHERE allowed) AS a,
    count(*) FILTER (WHERE NOT allowed) AS b
  FROM scores WHERE allowed IS NOT NULL AND kept_out GROUP BY 1
), leads AS (
  SELECT edge, lead(edge) OVER (ORDER BY edge DESC) AS lower, sum(a) OVER () AS all_a,
    sum(b) OVER () AS all_b, sum(a) OVER w * sum(b) OVER () - sum(b) OVER w * sum(a) OVER () AS ahead
  FROM bins WINDOW w AS (ORDER BY edge DESC ROWS UNBOUNDED PRECEDING)
), limits AS (
  SELECT coalesce((SELECT (edge + coalesce(lower, edge)) / 2 FROM leads WHERE all_a > 0 AND all_b > 0
    ORDER BY ahead DESC, edge LIMIT 1), 0) AS least
)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow'
  WHEN rule IS NOT NULL OR score < least THEN 'block' ELSE 'allow' END AS verdict
FROM ruled JOIN scores USING (url) CROSS JOIN limits
"""


# The prefix filter with the tokens in the order of their exact counts.
OP9_LINE_DEDUP = r"""
WITH docs AS (
  SELECT doc_id, string_split(text, chr(10)) AS parts, text FROM documents
), lines AS (
  SELECT doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS no FROM docs
), tokened AS (
  SELECT doc_id, no, line, list_sort(list_distinct(list_filter(
    regexp_split_to_array(line, '[\x20\x09-\x0D]+'), lambda w: w <> ''))) AS tokens
  FROM lines
), sets AS (
  SELECT tokens, len(tokens) AS n, min(struct_pack(d := doc_id, no := no)) AS place,
    row_number() OVER () AS id
  FROM tokened WHERE len(tokens) > 0 GROUP BY tokens
), items AS (
  SELECT id, n, place, unnest(tokens) AS token FROM sets
), counted AS (
  SELECT token, count(*) AS f FROM items GROUP BY token
), prefixes AS (
  SELECT id, n, place, token FROM items JOIN counted USING (token)
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY f, token) <= n - (4 * n + 4) // 5 + 1
), pairs AS (
  SELECT DISTINCT a.id AS a, b.id AS b FROM prefixes a JOIN prefixes b
    ON a.token = b.token AND a.place < b.place AND 5 * a.n >= 4 * b.n AND 5 * b.n >= 4 * a.n
), near AS (
  SELECT DISTINCT b.id FROM pairs JOIN sets a ON a.id = pairs.a JOIN sets b ON b.id = pairs.b
  WHERE 9 * len(list_intersect(a.tokens, b.tokens)) >= 4 * (a.n + b.n)
), decided AS (
  SELECT t.doc_id, t.no, t.line, len(t.tokens) = 0
    OR (s.place = struct_pack(d := t.doc_id, no := t.no)
        AND s.id NOT IN (SELECT id FROM near)) AS kept
  FROM tokened t LEFT JOIN sets s ON s.tokens = t.tokens
), results AS (
  SELECT doc_id, count(*)::INT AS n_lines, count(*) FILTER (WHERE kept)::INT AS n_kept,
    coalesce(string_agg(line, chr(10) ORDER BY no) FILTER (WHERE kept), '') AS text
  FROM decided GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_kept, 0) AS n_kept,
  CASE WHEN d.text IS NOT NULL THEN md5(r.text) END AS text_md5
FROM docs d LEFT JOIN results r USING (doc_id)
"""

OP11_PREFIX_TRIE = r"""
WITH turns AS (
    SELECT conv_id AS c, list({'role': coalesce(role, ''), 'said': coalesce(text, '')}
        ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS t
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), taken AS (
    -- The checksum bit by bit: a character is mixed in, then eight steps.
    SELECT c, t, xor(4294967295, list_reduce(
        [4294967295] || flatten(list_transform(string_split(c::VARCHAR, ''),
            lambda s: [ascii(s)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
        lambda crc, step: CASE WHEN step >= 0 THEN xor(crc, step)
            ELSE xor(crc >> 1, 3988292384 * (crc & 1)) END)) % 9 AS h
    FROM turns
), whole AS (
    SELECT own.c, coalesce(first.t, [])[1:own.h] || own.t[own.h + 1:] AS t
    FROM taken own LEFT JOIN turns first ON first.c = own.c - own.c % 5
), nodes AS MATERIALIZED (
    SELECT d, p, min(c) AS conv_id, count(*) AS n,
        array_to_string(list(c ORDER BY c) FILTER (size = d), ',') AS ended
    FROM (SELECT c, size, d, t[1:d] AS p
          FROM (SELECT c, t, len(t) AS size, unnest(range(0, len(t) + 1)) AS d FROM whole))
    GROUP BY d, p
), children AS (
    SELECT p[1:d - 1] AS p, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1
), weighed AS (
    SELECT nodes.d, nodes.p, children.p IS NULL AS leaf,
        CASE WHEN d > 0 THEN (nodes.n - 1) * strlen(nodes.p[d].said) ELSE 0 END AS saved
    FROM nodes LEFT JOIN children ON children.p = nodes.p
), sums AS (
    SELECT p[1:k] AS p, sum(saved) AS saved, count(*) FILTER (leaf) AS leaves
    FROM (SELECT p, saved, leaf, unnest(range(0, d + 1)) AS k FROM weighed) GROUP BY 1
)
SELECT nodes.conv_id, nodes.d AS depth, above.conv_id AS parent_conv_id, nodes.n AS n_convs,
    coalesce(children.n, 0) AS n_children, sums.leaves AS n_leaves,
    sums.saved::BIGINT AS saved_tokens, sha256(coalesce(nodes.ended, '')) AS ends_sha256
FROM nodes JOIN sums ON sums.p = nodes.p
LEFT JOIN children ON children.p = nodes.p
LEFT JOIN nodes above ON nodes.d > 0 AND above.p = nodes.p[1:nodes.d - 1]
"""

OP12_SUFFIX_DEDUP = r"""
WITH texts AS (
    SELECT doc_id, strlen(coalesce(text, '')) AS n, hex(encode(coalesce(text, ''))) AS h
    FROM documents
), windows AS (
    SELECT doc_id, start, substr(h, 2 * start + 1, 200) AS content
    FROM (SELECT doc_id, h, unnest(range(0, n - 99)) AS start FROM texts)
), later AS (
    SELECT doc_id, start FROM windows
    QUALIFY row_number() OVER (PARTITION BY content ORDER BY doc_id, start) > 1
), opened AS (
    SELECT doc_id, start, start > coalesce(lag(start) OVER place, -101) + 100 AS opens
    FROM later WINDOW place AS (PARTITION BY doc_id ORDER BY start)
), spans AS (
    SELECT doc_id, min(start) AS low, max(start) + 100 AS high
    FROM (SELECT *, sum(opens::INT) OVER (PARTITION BY doc_id ORDER BY start) AS span FROM opened)
    GROUP BY doc_id, span
), before AS (
    SELECT *, lag(high, 1, 0) OVER (PARTITION BY doc_id ORDER BY low) AS since FROM spans
), cut AS (
    SELECT doc_id, sum(high - low) AS removed, count(*) AS spans, max(high) AS after,
        string_agg(substr(h, 2 * since + 1, 2 * (low - since)), '' ORDER BY low) AS kept
    FROM before JOIN texts USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, n AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed,
    coalesce(spans, 0) AS n_spans,
    sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(after, 0) + 1))) AS kept_sha256
FROM texts LEFT JOIN cut USING (doc_id)
"""

OP13_PHRASES = r"""
WITH words AS MATERIALIZED (
    SELECT coalesce(lang, 'und') AS lang, list_filter(string_split_regex(piece, '[ \t]+'), lambda w: w <> '') AS w
    FROM (SELECT lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)
), totals AS (
    SELECT lang, sum(len(w))::HUGEINT AS n FROM words GROUP BY lang
), grams AS MATERIALIZED (
    SELECT lang, size, array_to_string(list_slice(w, i, i + size - 1), ' ') AS phrase, count(*)::HUGEINT AS a
    FROM (SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM words, (SELECT unnest([1, 2, 3, 4, 5]) AS size))
    GROUP BY ALL HAVING count(*) >= 100
), cuts AS (
    SELECT lang, size, phrase, a, unnest(range(1, size)) AS k, string_split(phrase, ' ') AS w FROM grams WHERE size > 1
), scored AS (
    SELECT c.lang, c.size, c.phrase, c.a, c.k, x.a AS l, y.a AS r, t.n, (1000 * c.a * t.n) // (x.a * y.a) AS score
    FROM cuts c JOIN totals t USING (lang)
    JOIN grams x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:c.k], ' ')
    JOIN grams y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.k + 1:], ' ')
), weakest AS (
    SELECT lang, size, phrase, a, n, min({'score': score, 'k': k, 'l': l, 'r': r}) AS cut FROM scored GROUP BY ALL
), inner_phrases AS (
    SELECT DISTINCT lang, array_to_string(list_slice(string_split(phrase, ' '), i, i + s - 1), ' ') AS phrase, a
    FROM (SELECT lang, size, phrase, a, s, unnest(range(1, size - s + 2)) AS i
          FROM (SELECT lang, size, phrase, a, unnest(range(2, size)) AS s FROM grams WHERE size > 2))
), ranked AS (
    SELECT lang, phrase, a, cut.l AS l, cut.r AS r, n, cut.score AS score,
           row_number() OVER (PARTITION BY lang ORDER BY cut.score DESC, a DESC, phrase) AS rank
    FROM weakest ANTI JOIN inner_phrases USING (lang, phrase, a)
)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM ranked WHERE rank <= 2000
"""

ORACLES: dict[str, str] = {
    "op1_mixing": OP1_MIXING,
    "op2_top_k": OP2_TOP_K,
    "op8_url_filter": _url_filter(),
    "op9_line_dedup": OP9_LINE_DEDUP,
    "op11_prefix_trie": OP11_PREFIX_TRIE,
    "op12_suffix_dedup": OP12_SUFFIX_DEDUP,
    "op13_phrases": OP13_PHRASES,
}
