"""DuckDB SQL for those queries that SQL can express in whole."""

from __future__ import annotations

from ledgerlake.llm import sharding

ROUNDS = 6


def _vector_codes() -> str:
    """Assignments and means as joins of (row, part, position, value) with
    (part, entry, position, value), a pair of tables for each round."""
    steps = ["""
rows AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) AS r, vec_id, label, embedding FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
cells AS MATERIALIZED (
  SELECT r, (spot - 1) * 8 // len(embedding) AS part, spot, CAST(floor(4096 * CAST(embedding[spot] AS DOUBLE)) AS BIGINT) AS x
  FROM (SELECT r, embedding, unnest(range(1, len(embedding) + 1)) AS spot FROM rows)),
book0 AS MATERIALIZED (SELECT r - 1 AS entry, part, spot, x AS c FROM cells WHERE r <= 16)"""]
    for k in range(ROUNDS + 1):
        steps.append(f"""
near{k} AS MATERIALIZED (
  SELECT r, part, arg_min(entry, d * 16 + entry) AS entry, min(d) AS d
  FROM (SELECT r, part, entry, CAST(sum((x - c) * (x - c)) AS BIGINT) AS d FROM cells JOIN book{k} USING (part, spot) GROUP BY ALL)
  GROUP BY r, part)""")
        if k < ROUNDS:
            steps.append(f"""
book{k + 1} AS MATERIALIZED (
  SELECT entry, part, spot, coalesce(m, c) AS c FROM book{k} LEFT JOIN (
    SELECT entry, part, spot, CAST((s - ((s % n) + n) % n) // n AS BIGINT) AS m
    FROM (SELECT entry, part, spot, sum(x) AS s, count(*) AS n FROM cells JOIN near{k} USING (r, part) GROUP BY ALL)
  ) USING (entry, part, spot))""")
    return f"""WITH {",".join(steps)},
coded AS (SELECT r, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM near{ROUNDS} GROUP BY r)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(c, ',' ORDER BY part, entry, spot)) FROM book{ROUNDS}) AS codebooks_sha256
FROM coded JOIN rows USING (r)"""


_COLLOCATIONS = r"""WITH
pieces AS (
  SELECT row_number() OVER () AS p, coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
lists AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
grams AS MATERIALIZED (
  SELECT lang, k, list_slice(w, i, i + k - 1) AS g, count(*) AS f
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM lists, (VALUES (1), (2), (3)) AS sizes(k))
  GROUP BY ALL),
candidates AS MATERIALIZED (SELECT lang, k, g, f AS a FROM grams WHERE k >= 2 AND f >= 10),
cuts AS (
  SELECT c.lang, c.g, c.a, cut, x.f AS l, y.f AS r, CAST((1000000::HUGEINT * c.a * c.a) // (x.f::HUGEINT * y.f) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM candidates) c
  JOIN grams x ON x.lang = c.lang AND x.g = list_slice(c.g, 1, c.cut)
  JOIN grams y ON y.lang = c.lang AND y.g = list_slice(c.g, c.cut + 1, c.k)),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, cut) = 1),
inside AS (
  SELECT DISTINCT t.lang, t.g FROM (
    SELECT lang, a, list_slice(g, i, i + 1) AS g FROM (SELECT *, unnest([1, 2]) AS i FROM candidates WHERE k = 3)) t
  JOIN candidates s ON s.lang = t.lang AND s.g = t.g WHERE 100 * t.a >= 50 * s.a),
ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(g, ' ')) AS rank, array_to_string(g, ' ') AS phrase, a, l, r, score
  FROM best ANTI JOIN inside USING (lang, g))
SELECT lang, rank, phrase, a, l, r, CAST((SELECT sum(f) FROM grams WHERE k = 1 AND grams.lang = ranked.lang) AS BIGINT) AS n, score
FROM ranked WHERE rank <= 2000"""


def _sharding() -> str:
    """The slots' shards as one list."""
    shards = ", ".join(f"'{sharding.SHARDS[i]}'" for i in sharding.lookup_table())
    return f"""SELECT doc_id, slot, ([{shards}])[slot + 1] AS shard
FROM (SELECT doc_id, CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) % {sharding.TABLE_SIZE} AS slot FROM documents)"""


#: Sets of shingles, links between different sets, and the smallest id that
#: links reach, a set's documents counting as one.
_JACCARD = r"""WITH RECURSIVE words AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY doc_id, text) AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
grams AS MATERIALIZED (
  SELECT DISTINCT r, list_slice(w, k, k + 4) AS g
  FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS k FROM words WHERE len(w) > 0)),
sizes AS MATERIALIZED (SELECT r, count(*) AS n FROM grams GROUP BY r),
sets AS MATERIALIZED (SELECT min(r) AS s, n, list(r) AS rs FROM (SELECT r, count(*) AS n, list(g ORDER BY g) AS key FROM grams GROUP BY r) GROUP BY key, n),
few AS MATERIALIZED (SELECT s, n, g FROM sets JOIN grams ON r = s),
links AS MATERIALIZED (
  SELECT s AS a, t AS b FROM (
    SELECT x.s AS s, y.s AS t, x.n AS n, y.n AS m, count(*) AS shared FROM few x JOIN few y ON x.g = y.g AND x.s <> y.s AND 4 * x.n >= 3 * y.n AND 4 * y.n >= 3 * x.n GROUP BY ALL)
  WHERE 100 * shared >= 75 * (n + m - shared)),
reach(a, b) AS (
  SELECT s, s FROM sets UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
roots AS (SELECT a, min(doc_id) AS root FROM reach JOIN sets ON s = b JOIN words ON list_contains(rs, r) GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(root, doc_id) AS component_id
FROM words LEFT JOIN sizes USING (r)
LEFT JOIN (SELECT unnest(rs) AS r, root FROM sets JOIN roots ON a = s) USING (r)"""


ORACLES: dict[str, str] = {
    "op4_jaccard": _JACCARD,
    "op8_sharding": _sharding(),
    "op11_vector_codes": _vector_codes(),
    "op12_collocations": _COLLOCATIONS,
}
