"""SQL with the same result for the document queries that SQL can express."""

from __future__ import annotations

# Code points as the contracts name them: blanks are space and 0x09 to 0x0D.
BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
ASCII_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

LINE_DEDUP = f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
), keyed AS (
  SELECT *, {ASCII_LOWER.format(f"trim(line, {BLANKS})")} AS k FROM lines
), shared AS (
  SELECT k, max(doc_id) AS kept FROM keyed WHERE length(k) >= 40
  GROUP BY k HAVING count(DISTINCT doc_id) >= 5
), marked AS (
  SELECT keyed.*, shared.k IS NOT NULL AND doc_id <> kept AS gone FROM keyed LEFT JOIN shared USING (k)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

WORDS = "regexp_extract_all({0}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')".format(ASCII_LOWER.format("coalesce(text, '')"))

DECONTAMINATE = f"""
WITH docs AS (SELECT doc_id, {WORDS} AS w FROM documents),
items AS (SELECT item_id, {WORDS} AS w FROM benchmark),
sizes AS (SELECT item_id, w, least(10, len(w)) AS size FROM items WHERE len(w) > 0),
windows AS (
  SELECT DISTINCT item_id, size, array_to_string(w[i : i + size - 1], ' ') AS win
  FROM (SELECT item_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM sizes)
),
spots AS (
  SELECT doc_id, size, i, array_to_string(w[i : i + size - 1], ' ') AS win
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
        FROM docs, (SELECT DISTINCT size FROM sizes) WHERE len(w) >= size)
),
hits AS (SELECT doc_id, i, spots.size, item_id FROM spots JOIN windows USING (size, win)),
hit_words AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hits) GROUP BY 1),
hit_items AS (SELECT doc_id, list_sort(list(DISTINCT item_id::VARCHAR)) AS ids FROM hits GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0) AS n_hit, coalesce(len(ids), 0)::BIGINT AS n_items,
       sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256, n IS NOT NULL AS contaminated
FROM docs LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""

WARC = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages
), f AS (
  SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first IS NULL OR first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM f
"""

SEARCH = f"""
WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents),
t AS (SELECT doc_id, word, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS word FROM d) GROUP BY ALL),
df AS (SELECT word, count(*) AS df FROM t GROUP BY 1),
n AS (SELECT count(*) AS docs, avg(len(w)) AS mean FROM d),
s AS (
  SELECT q.doc_id AS query_id, t.doc_id,
         round(sum(q.tf * ln(1 + (docs - df + 0.5) / (df + 0.5)) * t.tf * 2.2 / (t.tf + 1.2 * (0.25 + 0.75 * len(w) / mean))), 6) AS score
  FROM t q JOIN t USING (word) JOIN df USING (word) JOIN d ON d.doc_id = t.doc_id CROSS JOIN n
  WHERE q.doc_id % 50 = 0 GROUP BY ALL
)
SELECT query_id, doc_id, score, rank::INTEGER AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM s) WHERE rank <= 10
"""

# Patterns of the secret scan for an engine without look-around: whole runs first, conditions on them after.
_KEYWORD = "|".join(
    "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word) for word in ("password", "passwd", "secret", "token", "api_?key")
)
_LEAD = "(?:" + _KEYWORD + r")[\x22\x27]?\x20*[:=]\x20*[\x22\x27]?"
_SECRET_RUNS = {
    # name: kind number, pattern of a run, condition on the run r
    "assign": (0, _LEAD + "[A-Za-z0-9+/_.=-]+", f"length(regexp_replace(r, '^{_LEAD}', '')) >= 6"),
    "access": (1, "AKIA[A-Z0-9]+", "length(r) >= 20"),
    "hex": (2, "[0-9a-f]{24,}", "true"),
    "weak_id": (3, "[A-Za-z0-9_]{16,}", "regexp_full_match(r, '[A-Z][A-Z0-9]{15,}') AND regexp_matches(r, '[0-9]')"),
    "weak_secret": (
        4,
        "[A-Za-z0-9+/_=-]{20,}",
        "regexp_full_match(r, '[A-Za-z0-9+/_-]{20,}={0,2}') AND regexp_matches(r, '[0-9]')"
        " AND regexp_matches(r, '[A-Z]') AND regexp_matches(r, '[a-z]')",
    ),
    "endpoint": (5, "[Hh][Tt][Tt][Pp][Ss]?://[A-Za-z0-9.-]+(?::[0-9]{1,5})?", "true"),
}


def _runs(name: str) -> str:
    """Spans of one kind: the texts between matches, and the matches before, add up to a start."""
    number, pattern, condition = _SECRET_RUNS[name]
    return f"""
SELECT doc_id, {number} AS kind, a AS "start", a + length(r) AS "end" FROM (
  SELECT doc_id, m[i] AS r,
         length(array_to_string(g[1:i], '')) + coalesce(length(array_to_string(m[1:i - 1], '')), 0) AS a
  FROM (SELECT doc_id, m, g, unnest(range(1, len(m) + 1)) AS i FROM (
    SELECT doc_id, regexp_extract_all(t, '{pattern}') AS m, regexp_split_to_array(t, '{pattern}') AS g FROM texts)))
WHERE {condition}"""


_NAME = "['assign', 'access', 'hex', 'weak_id', 'weak_secret', 'endpoint'][kind + 1]"
_LISTED = f"""string_agg({_NAME} || ':' || "start"::BIGINT || ':' || "end"::BIGINT, ',' ORDER BY "start", kind, "end")"""
SECRETS = f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
base AS ({" UNION ALL ".join(_runs(n) for n in ("assign", "access", "hex"))}),
weak AS (
  SELECT w.* FROM ({" UNION ALL ".join(_runs(n) for n in ("weak_id", "weak_secret", "endpoint"))}) w
  WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = w.doc_id AND b."start" < w."end" AND w."start" < b."end")
),
parts AS (
  SELECT *, CASE WHEN kind IN (0, 2, 4) THEN 'secret' WHEN kind IN (1, 3) THEN 'id' ELSE 'endpoint' END AS role
  FROM (SELECT * FROM base UNION ALL SELECT * FROM weak)
),
added AS (
  SELECT w.doc_id, w.kind, w."start", w."end" FROM weak w JOIN parts p
  ON p.doc_id = w.doc_id AND abs(p."start" - w."start") <= 240
  GROUP BY ALL
  HAVING CASE w.kind WHEN 3 THEN bool_or(p.role = 'secret') WHEN 4 THEN bool_or(p.role = 'id')
         ELSE bool_or(p.role = 'secret') AND bool_or(p.role = 'id') END
),
b AS (SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access,
             count(*) FILTER (kind = 2) AS n_hex, {_LISTED} AS listed FROM base GROUP BY 1),
e AS (SELECT doc_id, {_LISTED} AS listed FROM (SELECT * FROM base UNION ALL SELECT * FROM added) GROUP BY 1)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(b.listed, '')) AS base_sha256, coalesce(e.listed, '') AS spans
FROM texts LEFT JOIN b USING (doc_id) LEFT JOIN e USING (doc_id)
"""

# CRC-32 of a list of bytes, by its defining table.
_CRC_TABLE = """
SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n::UBIGINT, range(8)::UBIGINT[]),
         lambda c, step: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384::UBIGINT) ELSE c // 2 END)) AS crc_table
"""
SHARDING = f"""
WITH RECURSIVE crc AS ({_CRC_TABLE}),
rows AS (SELECT doc_id, encode(coalesce(text, '')) AS data, md5(coalesce(text, '')) AS grp FROM documents),
codes AS (
  SELECT grp, octet_length(data)::BIGINT + 1 AS size,
         xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(regexp_extract_all(hex(data), '..'), lambda h: ('0x' || h)::UBIGINT)),
           lambda c, b: xor(c // 256, crc_table[(xor(c, b) % 256 + 1)::INTEGER])), 4294967295::UBIGINT)::BIGINT AS text_crc32
  FROM (SELECT grp, any_value(data) AS data FROM rows GROUP BY 1), crc
),
groups AS (SELECT grp, size * (SELECT count(*) FROM rows r WHERE r.grp = codes.grp) AS bytes FROM codes),
ordered AS (SELECT bytes::BIGINT AS bytes, row_number() OVER (ORDER BY bytes DESC, grp) AS i FROM groups),
steps(i, bytes, shard, loads) AS (
  SELECT 0::BIGINT, NULL::BIGINT, NULL::INTEGER, list_transform(range(16), lambda x: 0::BIGINT)
  UNION ALL
  SELECT ordered.i, ordered.bytes, pick - 1, list_transform(loads, lambda x, j: CASE WHEN j = pick THEN x + ordered.bytes ELSE x END)
  FROM (SELECT i, loads, list_position(loads, list_min(loads))::INTEGER AS pick FROM steps) s JOIN ordered ON ordered.i = s.i + 1
),
dealt AS (
  SELECT grp, shard FROM (SELECT grp, bytes, row_number() OVER (PARTITION BY bytes ORDER BY grp) AS r FROM groups)
  JOIN (SELECT bytes, shard, row_number() OVER (PARTITION BY bytes ORDER BY shard) AS r FROM steps WHERE i > 0) USING (bytes, r)
)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, grp) - 1 AS slot, NULL::INTEGER AS grown_shard
FROM rows JOIN codes USING (grp) JOIN dealt USING (grp)
"""


def _vectors(factor: int, condition: str) -> str:
    return f"""
every AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor({factor} * x::DOUBLE)::BIGINT) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
),
kept AS (SELECT row_number() OVER (ORDER BY vec_id, q) AS r, * FROM every WHERE {condition}),"""


def _floored(total: str, n: str) -> str:
    return f"(({total} - (({total} % {n}) + {n}) % {n}) // {n})::BIGINT"


def _cluster_round(number: int) -> str:
    return f"""
a{number} AS MATERIALIZED (
  SELECT r, min(d * 64 + c) % 64 AS c, min(d * 64 + c) // 64 AS d
  FROM (SELECT r, c, sum((x - v) * (x - v))::BIGINT AS d FROM parts JOIN c{number} USING (p) GROUP BY r, c) GROUP BY r
),
c{number + 1} AS MATERIALIZED (
  SELECT c, p, coalesce({_floored("s", "n")}, v) AS v FROM c{number} LEFT JOIN (
    SELECT c, p, sum(x)::BIGINT AS s, count(*) AS n FROM a{number} JOIN parts USING (r) GROUP BY c, p) USING (c, p)
),"""


CLUSTERS = f"""
WITH {_vectors(256, "len(q) = 64")}
parts AS MATERIALIZED (SELECT r, unnest(q) AS x, generate_subscripts(q, 1) AS p FROM kept),
first AS (SELECT r, row_number() OVER (ORDER BY sha256('2:' || vec_id), q) - 1 AS c FROM kept QUALIFY c < 40),
c0 AS MATERIALIZED (SELECT c, p, x AS v FROM first JOIN parts USING (r)),
{"".join(_cluster_round(i) for i in range(6))}
names AS (SELECT c, sha256(string_agg(v::VARCHAR, ',' ORDER BY p)) AS centroid_sha256 FROM c5 GROUP BY c)
SELECT vec_id, c::INTEGER AS cluster, d::BIGINT AS distance, (sum(d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
       (sum(d) OVER ())::BIGINT AS inertia, centroid_sha256
FROM a5 JOIN kept USING (r) JOIN names USING (c)
"""


def _code_round(number: int) -> str:
    return f"""
a{number} AS MATERIALIZED (
  SELECT r, part, min(d * 16 + c) % 16 AS c, min(d * 16 + c) // 16 AS d
  FROM (SELECT r, part, c, sum((x - v) * (x - v))::BIGINT AS d FROM parts JOIN c{number} USING (part, p) GROUP BY r, part, c) GROUP BY r, part
),
c{number + 1} AS MATERIALIZED (
  SELECT part, c, p, coalesce({_floored("s", "n")}, v) AS v FROM c{number} LEFT JOIN (
    SELECT part, c, p, sum(x)::BIGINT AS s, count(*) AS n FROM a{number} JOIN parts USING (r, part) GROUP BY part, c, p) USING (part, c, p)
),"""


VECTOR_CODES = f"""
WITH {_vectors(4096, "len(q) = (SELECT len(q) FROM every WHERE len(q) > 0 AND len(q) % 8 = 0 GROUP BY 1 ORDER BY count(*) DESC, 1 DESC LIMIT 1)")}
parts AS MATERIALIZED (
  SELECT r, x, (i - 1) // (width // 8) AS part, (i - 1) % (width // 8) AS p
  FROM (SELECT r, len(q) AS width, unnest(q) AS x, generate_subscripts(q, 1) AS i FROM kept)
),
c0 AS MATERIALIZED (SELECT part, r - 1 AS c, p, x AS v FROM parts WHERE r <= 16),
{"".join(_code_round(i) for i in range(7))}
books AS (SELECT sha256(string_agg(v::VARCHAR, ',' ORDER BY part, c, p)) AS codebooks_sha256 FROM c6),
codes AS (SELECT r, string_agg(printf('%02x', c), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM a6 GROUP BY r)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM codes JOIN kept USING (r), books
"""

ORACLES: dict[str, str] = {
    "op3_line_dedup": LINE_DEDUP,
    "op5_search": SEARCH,
    "op6_warc": WARC,
    "op7_decontaminate": DECONTAMINATE,
    "op9_secrets": SECRETS,
    "op11_sharding": SHARDING,
    "op12_clustering": CLUSTERS,
    "op13_vector_codes": VECTOR_CODES,
}
