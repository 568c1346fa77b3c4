"""DuckDB SQL for the queries that SQL can express. The others are tested against brute force."""

from __future__ import annotations

import string

UPPER, LOWER = string.ascii_uppercase, string.ascii_lowercase
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
TOKEN = r"[^\x20\x09-\x0D]+"

OP3 = rf"""
WITH items AS (
  SELECT coalesce(item_id::VARCHAR, 'null') AS item,
         regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w
  FROM benchmark
), cut AS (
  SELECT item, unnest(list_transform(range(1, greatest(len(w) - 10, 0) + 2),
                                     lambda i: w[i:i + 9])) AS win
  FROM items WHERE len(w) > 0
), wins AS (SELECT DISTINCT item, len(win) AS n, array_to_string(win, ' ') AS win FROM cut),
docs AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w
  FROM documents
), places AS (
  SELECT r, l.n, unnest(list_transform(range(1, len(w) - l.n + 2),
                        lambda i: {{'i': i, 's': array_to_string(w[i:i + l.n - 1], ' ')}})) AS p
  FROM docs, (SELECT DISTINCT n FROM wins) l WHERE len(w) >= l.n
), found AS (
  SELECT r, p.i AS i, places.n AS n, item FROM places JOIN wins ON wins.win = p.s AND wins.n = places.n
), covered AS (
  SELECT r, count(DISTINCT j) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS j FROM found) GROUP BY r
), named AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT r, item FROM found) GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN covered USING (r) LEFT JOIN named USING (r)
"""

OP5 = rf"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{TOKEN}'))::BIGINT AS size,
         ('0x' || md5('0:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, '')))[1:8])::BIGINT AS place
  FROM documents
), sizes AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS no
  FROM sized GROUP BY source
), weighed AS (SELECT *, (no % 3 + 1)::DOUBLE AS weight FROM sizes),
lefts AS (
  SELECT *, sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER before, 0) AS rest,
         sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS weight_left
  FROM weighed
  WINDOW before AS (ORDER BY source_size / weight, no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), aimed AS (
  SELECT *, least(max(rest / weight_left) OVER () * weight, (3 * source_size)::DOUBLE) AS target
  FROM lefts
), spans AS (
  SELECT *, (sum(target) OVER upto - target) / sum(target) OVER () AS lo,
         sum(target) OVER upto / sum(target) OVER () AS hi
  FROM aimed WINDOW upto AS (ORDER BY no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
), slots AS (
  SELECT unnest(range(greatest(65536, 64 * (SELECT count(*) FROM sizes)))) AS slot
), points AS (SELECT slot, slot * 0.6180339887498949::DOUBLE - floor(slot * 0.6180339887498949::DOUBLE) AS u FROM slots),
ranked AS (
  SELECT no, row_number() OVER (PARTITION BY no ORDER BY slot) - 1 AS rank FROM points JOIN spans ON lo <= u AND u < hi
), blocked AS (
  SELECT a.no, source_size, coalesce(n, 0) AS n, round(target)::BIGINT AS wanted, round(target)::BIGINT // (coalesce(n, 0) + 1) AS block
  FROM aimed a LEFT JOIN (SELECT no, count(*) AS n FROM ranked GROUP BY no) USING (no)
), blocks AS (
  SELECT no, rank * block AS since, (rank + 1) * block AS until, source_size FROM ranked JOIN blocked USING (no)
  UNION ALL SELECT no, n * block, wanted, source_size FROM blocked
), epochs AS (
  SELECT no, source_size, since, until, unnest(range(since // source_size, (until - 1) // source_size + 1)) AS e
  FROM blocks WHERE until > since
), cut AS (
  SELECT no, greatest(since - e * source_size, 0) AS lo, least(until - e * source_size, source_size) AS hi FROM epochs
), runs AS (
  -- Blocks follow one another: the words before each border that are in an epoch's blocks.
  SELECT no, b, sum(d) OVER (PARTITION BY no ORDER BY b) AS times,
         lead(b, 1, b) OVER (PARTITION BY no ORDER BY b) AS next
  FROM (SELECT no, b, sum(d) AS d FROM (SELECT no, lo AS b, 1 AS d FROM cut UNION ALL SELECT no, hi, -1 FROM cut) GROUP BY ALL)
), streamed AS (
  SELECT row_number() OVER () AS r, d.*, no, source_size, target,
         sum(size) OVER (PARTITION BY no ORDER BY place, doc_id NULLS FIRST, size
                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT - size AS start
  FROM sized d JOIN spans s ON d.source IS NOT DISTINCT FROM s.source
), taken AS (
  SELECT r, sum((least(start + size, next) - greatest(start, b)) * times)::BIGINT AS taken
  FROM streamed JOIN runs ON runs.no = streamed.no AND b < start + size AND next > start GROUP BY r
)
SELECT doc_id, size, source_size, target, coalesce(taken, 0)::BIGINT AS taken, source
FROM streamed LEFT JOIN taken USING (r)
"""

ORACLES = {"op3_decontamination": OP3, "op5_mixing": OP5}

OP2 = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes,
         sha1(coalesce(html, '')) AS payload_digest
  FROM pages
), m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id < last THEN last END AS refers_to
FROM m
"""

ORACLES |= {"op2_warc": OP2}

_MD5 = "('0x' || md5({})[1:8])::BIGINT"
_DAY = "(DATE '2024-01-01' + ({} % 360)::INTEGER)::TIMESTAMP"
_URL = r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)(?::[0-9]*)?([^?#]*)"


def _day(text: str) -> str:
    return _DAY.format(_MD5.format(text))


OP8 = rf"""
WITH parts AS (
  SELECT page_id, url, {_day("'fetch:' || coalesce(page_id::VARCHAR, '')")} AS fetched_at,
         translate(regexp_extract(coalesce(url, ''), '{_URL}', 1), '{UPPER}', '{LOWER}') AS host,
         list_filter(string_split(regexp_extract(coalesce(url, ''), '{_URL}', 2), '/'),
                     lambda s: s <> '') AS steps
  FROM pages
), keyed AS (
  SELECT *, string_split(host, '.') AS labels,
         list_transform(range(1, len(steps) + 1),
                        lambda i: host || '/' || array_to_string(steps[1:i], '/')) AS paths
  FROM parts
), entries AS (
  SELECT DISTINCT 'hosts' AS l, host AS k, {_day("'add:' || host")} AS since,
         {_day("'remove:' || host")} AS until
  FROM parts WHERE host <> '' AND {_MD5.format("'list:' || host")} % 4 = 0
  UNION SELECT DISTINCT 'spam', host, TIMESTAMP '2024-01-01', NULL FROM parts WHERE contains(host, 'spam')
  UNION SELECT DISTINCT 'paths', list_max(paths), {_day("'add:' || list_max(paths)")}, NULL
  FROM keyed WHERE host <> '' AND len(paths) > 0 AND {_MD5.format("'path:' || list_max(paths)")} % 8 = 0
), keys AS (
  SELECT page_id, fetched_at, unnest(list_distinct(list_concat(paths,
           list_transform(range(1, greatest(len(labels) - 1, 1) + 1), lambda i: array_to_string(labels[i:], '.'))))) AS k
  FROM keyed WHERE host <> ''
), matched AS (
  SELECT page_id, string_agg(DISTINCT l || ':' || k, ',' ORDER BY l || ':' || k) AS matches
  FROM keys JOIN entries USING (k)
  WHERE fetched_at >= since AND (until IS NULL OR until <= since OR fetched_at < until)
    AND (until IS NULL OR since <> until) GROUP BY page_id
)
SELECT page_id, fetched_at, host, coalesce(matches, '') AS matches, matches IS NOT NULL AS blocked
FROM parts LEFT JOIN matched USING (page_id)
"""

ORACLES |= {"op8_url_filters": OP8}


def _clustering(rounds: int = 10) -> str:
    """Rounds of assigning and averaging, written out one after the other."""
    steps = [
        """
v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id,
         list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS x
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
), c0 AS MATERIALIZED (
  SELECT (row_number() OVER (ORDER BY h) - 1)::INTEGER AS c, x
  FROM (SELECT x, sha256('3:' || vec_id::VARCHAR) AS h FROM v ORDER BY h LIMIT 8)
)"""
    ]
    for i in range(rounds + 1):
        steps.append(
            f"""a{i} AS MATERIALIZED (
  SELECT r, arg_min(c, d * 8 + c) AS c, (min(d * 8 + c) // 8)::BIGINT AS d FROM (
    SELECT r, c, list_sum(list_transform(list_zip(v.x, k.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d
    FROM v, c{i} k) GROUP BY r
)"""
        )
        if i < rounds:
            steps.append(
                f"""m{i} AS (
  SELECT c, p, sum(y)::BIGINT AS s, count(*)::BIGINT AS n
  FROM (SELECT c, unnest(x) AS y, unnest(range(64)) AS p FROM a{i} JOIN v USING (r)) GROUP BY c, p
), c{i + 1} AS MATERIALIZED (
  SELECT k.c, coalesce(g.x, k.x) AS x FROM c{i} k LEFT JOIN (
    SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY p) AS x FROM m{i} GROUP BY c) g USING (c)
)"""
            )
    last = f"""
SELECT vec_id, a.c AS cluster, d AS distance, sum(d) OVER (PARTITION BY a.c)::BIGINT AS cluster_inertia,
       sum(d) OVER ()::BIGINT AS inertia, sha256(array_to_string(k.x, ',')) AS centroid_sha256
FROM a{rounds} a JOIN v USING (r) JOIN c{rounds} k ON k.c = a.c
"""
    return "WITH " + ", ".join(steps) + last


OP12 = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), worded AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), grams AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
  FROM worded, (SELECT unnest(range(1, 6)) AS k) WHERE len(w) >= k
), f AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL),
words AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
frequent AS MATERIALIZED (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE f >= 100),
held AS (
  SELECT DISTINCT lang, f, unnest([array_to_string(w[1:k - 1], ' '), array_to_string(w[2:k], ' ')]) AS phrase
  FROM frequent WHERE k > 2
), cuts AS (
  SELECT lang, phrase, f AS a, w, k, unnest(range(1, k)) AS cut
  FROM frequent ANTI JOIN held USING (lang, phrase, f) WHERE k > 1
), scored AS (
  SELECT c.lang, c.phrase, c.a, cut, l.f AS l, r.f AS r, n,
         (1000::HUGEINT * c.a * n // (l.f::HUGEINT * r.f))::BIGINT AS score
  FROM cuts c JOIN words USING (lang)
  JOIN frequent l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:cut], ' ')
  JOIN frequent r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[cut + 1:c.k], ' ')
), worst AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)::BIGINT AS rank,
       phrase, a, l, r, n, score
FROM worst QUALIFY rank <= 2000
"""

OP13 = rf"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{TOKEN}') AS w FROM documents
), shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) < 2 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s FROM docs WHERE len(w) > 0
), sizes AS MATERIALIZED (SELECT doc_id, count(*)::BIGINT AS n FROM shingles GROUP BY doc_id),
pairs AS MATERIALIZED (
  SELECT a, b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM shingles x JOIN shingles y USING (s)
    WHERE x.doc_id < y.doc_id GROUP BY ALL)
  JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * common >= 80 * (p.n + q.n - common)
), edges AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
reach AS (
  SELECT DISTINCT a AS node, a AS met FROM edges
  UNION SELECT reach.node, edges.b FROM reach JOIN edges ON edges.a = reach.met
), lowest AS (SELECT node, min(met) AS low FROM reach GROUP BY node)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(low, doc_id) AS component_id,
       coalesce(low, doc_id) = doc_id AS kept
FROM docs LEFT JOIN sizes USING (doc_id) LEFT JOIN lowest ON node = doc_id
"""

ORACLES |= {"op11_clustering": _clustering(), "op12_phrases": OP12, "op13_minhash": OP13}
