"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP4 = rf"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all({_LOWERED}, '{_WORD}') AS w
  FROM documents
), item AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_LOWERED}, '{_WORD}') AS w
  FROM benchmark
), pattern AS (
  SELECT DISTINCT item, least(len(w), 10) AS n,
    unnest(list_transform(range(1, greatest(len(w) - 10, 0) + 2),
      lambda i: array_to_string(w[i : i + least(len(w), 10) - 1], ' '))) AS p
  FROM item WHERE len(w) > 0
), place AS (
  SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM doc
), spot AS (
  SELECT r, i, n, array_to_string(w[i : i + n - 1], ' ') AS p, i + n - 1 <= len(w) AS fits
  FROM place, (SELECT DISTINCT n FROM pattern)
), hit AS (
  SELECT r, i, s.n, item FROM spot s JOIN pattern q ON s.n = q.n AND s.p = q.p WHERE fits
), word AS (
  SELECT r, count(DISTINCT j) AS n_hit
  FROM (SELECT r, unnest(range(i, i + n)) AS j FROM hit) GROUP BY r
), named AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT r, item FROM hit) GROUP BY r
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  n_hit IS NOT NULL AS contaminated
FROM doc LEFT JOIN word USING (r) LEFT JOIN named USING (r)
"""

# Pairs without a common shingle can't be linked, so the join on shingles finds all.
OP9 = rf"""
WITH RECURSIVE doc AS (
  SELECT doc_id, regexp_extract_all({_LOWERED}, '[^\x20\x09-\x0D]+') AS w FROM documents
), shingle AS (
  SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(w) - 5, 0) + 2),
    lambda i: array_to_string(w[i : i + 4], ' '))) AS s
  FROM doc WHERE len(w) > 0
), size AS (
  SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id
), pair AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared
  FROM shingle x JOIN shingle y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL
), link AS (
  SELECT a, b FROM pair JOIN size p ON p.doc_id = a JOIN size q ON q.doc_id = b
  WHERE 100 * shared >= 75 * (p.n + q.n - shared)
), edge AS (
  SELECT a, b FROM link UNION SELECT b, a FROM link
), reach AS (
  SELECT doc_id, doc_id AS r FROM documents
  UNION
  SELECT reach.doc_id, edge.b FROM reach JOIN edge ON reach.r = edge.a
), least AS (
  SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, component_id = doc_id AS kept
FROM doc JOIN least USING (doc_id) LEFT JOIN size USING (doc_id)
"""


_GOOD = "len(list_filter({v}, lambda x: x IS NULL OR NOT isfinite(x))) = 0"

OP13 = f"""
WITH RECURSIVE v AS MATERIALIZED (
  SELECT vec_id, label, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS n
  FROM (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)
  WHERE e IS NOT NULL AND label IS NOT NULL AND {_GOOD.format(v='e')}
), link AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE a.n > 0 AND b.n > 0 AND list_dot_product(a.e, b.e) / (a.n * b.n) >= 0.98
), reach AS (
  SELECT vec_id, vec_id AS r FROM embeddings
  UNION
  SELECT reach.vec_id, link.b FROM reach JOIN link ON reach.r = link.a
), least AS (
  SELECT vec_id, min(r) AS component_id FROM reach GROUP BY vec_id
), number AS (
  SELECT a AS vec_id, count(*) AS n FROM link GROUP BY a
)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, component_id = vec_id AS kept
FROM embeddings JOIN least USING (vec_id) LEFT JOIN number USING (vec_id)
"""


def _op11(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Every part against every entry, a pair of common tables per round."""
    steps = [
        f"""WITH kept AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding,
    lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings WHERE embedding IS NOT NULL AND {_GOOD.format(v='embedding')}
), piece AS MATERIALIZED (
  SELECT vec_id, label, k, e[k * len(e) // {parts} + 1 : (k + 1) * len(e) // {parts}] AS p
  FROM kept, (SELECT unnest(range(0, {parts})) AS k)
), book0 AS MATERIALIZED (
  SELECT k, n - 1 AS i, p AS c
  FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY vec_id) AS n FROM piece)
  WHERE n <= {entries}
)"""
    ]
    for r in range(rounds + 1):
        steps.append(
            f"""near{r} AS MATERIALIZED (
  SELECT vec_id, label, k, p, min(d) AS d, arg_min(i, d * {entries} + i) AS i FROM (
    SELECT vec_id, label, piece.k, p, i, list_sum(list_transform(range(1, len(p) + 1),
      lambda j: CAST((p[j] - c[j]) * (p[j] - c[j]) AS BIGINT))) AS d
    FROM piece JOIN book{r} b ON piece.k = b.k)
  GROUP BY vec_id, label, k, p
)"""
        )
        if r < rounds:
            steps.append(
                f"""book{r + 1} AS MATERIALIZED (
  SELECT b.k, b.i, coalesce(m.c, b.c) AS c FROM book{r} b LEFT JOIN (
    SELECT k, i, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY j) AS c FROM (
      SELECT k, i, j, CAST(sum(x) AS BIGINT) AS s, count(*) AS n
      FROM (SELECT k, i, unnest(p) AS x, unnest(range(1, len(p) + 1)) AS j FROM near{r})
      GROUP BY k, i, j)
    GROUP BY k, i) m ON b.k = m.k AND b.i = m.i
)"""
            )
    steps.append(
        f"""coded AS MATERIALIZED (
  SELECT vec_id, label, string_agg(printf('%02x', i), '' ORDER BY k) AS code,
    CAST(sum(d) AS BIGINT) AS error
  FROM near{rounds} GROUP BY vec_id, label
), total AS (
  SELECT label, CAST(sum(error) AS BIGINT) AS label_error FROM coded GROUP BY label
)
SELECT vec_id, code, error, label_error, (
  SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY k, i)) FROM book{rounds}
) AS codebooks_sha256
FROM coded JOIN total ON coded.label IS NOT DISTINCT FROM total.label"""
    )
    return ",\n".join(steps)


def _op12() -> str:
    """The damage by a checksum built from its rule, the cheapest edits by a recursion over
    rows with the least (cost, audit) of each state (0 start, 1 after s, 2 after u, 3 after
    a), and the repaired lines from the audit's letters."""
    step = "i"
    for _ in range(8):
        step = f"list_transform([{step}], lambda c: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)[1]"
    return rf"""
WITH RECURSIVE sums AS MATERIALIZED (
  SELECT list_transform(CAST(range(0, 256) AS BIGINT[]), lambda i: {step}) AS t
), raw AS (
  SELECT *, encode(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')) AS key
  FROM conversations
), hashed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce(list_transform(range(1, octet_length(key) + 1),
      lambda i: CAST(('0x' || hex(key)[2 * i - 1 : 2 * i]) AS BIGINT)),
      lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8), CAST(4294967295 AS BIGINT)), 4294967295) % 20 AS kind
  FROM raw, sums
), damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(0, CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM hashed
), placed AS (
  SELECT conv_id, turn, role, text, role[1:1] AS c,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
    regexp_extract(text, '([^ 	-])[ 	-]*\z', 1) AS shown
  FROM damaged
), judged AS MATERIALIZED (
  SELECT *, CASE WHEN shown = '' THEN 'blank'
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
      WHEN shown NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    lag(c) OVER (PARTITION BY conv_id ORDER BY i) || c AS pair
  FROM placed
), number AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM judged GROUP BY conv_id
), gap(p, q, price, letters) AS (
  VALUES (0, 0, 0, ''), (1, 1, 0, ''), (2, 2, 0, ''), (3, 3, 0, ''), (0, 2, 5, 'I'), (0, 3, 10, 'II'),
    (1, 2, 5, 'I'), (1, 3, 10, 'II'), (2, 3, 5, 'I'), (3, 2, 5, 'I')
), move(p, symbol, q) AS (
  VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)
), edit AS MATERIALIZED (
  SELECT conv_id, i, p, p AS q, 2 AS price, 'D' AS letter FROM judged, (VALUES (0), (1), (2), (3)) AS x(p)
  UNION ALL
  SELECT conv_id, i, p, q, CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END, 'K'
  FROM judged JOIN move ON symbol = c WHERE fault NOT IN ('blank', 'duplicate')
  UNION ALL
  SELECT conv_id, i, p, q, CASE WHEN fault = 'truncated' THEN 6 ELSE 1 END, 'R'
  FROM judged JOIN move ON symbol IN ('u', 'a') WHERE fault NOT IN ('blank', 'duplicate')
), best AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, 0 AS state, CAST(0 AS BIGINT) AS cost, '' AS audit FROM number
  UNION ALL
  SELECT conv_id, i, q, least.cost, least.audit FROM (
    SELECT b.conv_id, e.i, e.q, min({{'cost': b.cost + g.price + e.price, 'audit': b.audit || g.letters || e.letter}}) AS least
    FROM best b JOIN gap g ON g.p = b.state
      JOIN edit e ON e.conv_id IS NOT DISTINCT FROM b.conv_id AND e.i = b.i + 1 AND e.p = g.q
    GROUP BY b.conv_id, e.i, e.q)
), final AS MATERIALIZED (
  SELECT n.conv_id, min({{'cost': cost + price, 'audit': audit || letters}}) AS least
  FROM number n JOIN best b ON n.conv_id IS NOT DISTINCT FROM b.conv_id AND n.n = b.i
    JOIN gap g ON g.p = b.state AND g.q IN (0, 3)
  GROUP BY n.conv_id
), letter AS (
  SELECT conv_id, j, l, count(*) FILTER (l <> 'I') OVER w AS i, count(*) FILTER (l <> 'D') OVER w AS k,
    count(*) FILTER (l <> 'D') OVER (PARTITION BY conv_id) AS m
  FROM (SELECT conv_id, unnest(range(1, length(least.audit) + 1)) AS j, least.audit[j:j] AS l FROM final)
  WINDOW w AS (PARTITION BY conv_id ORDER BY j)
), line AS (
  SELECT l.conv_id, string_agg(CASE WHEN l = 'K' THEN role
      WHEN (k + m) % 2 = 1 THEN 'user' ELSE 'assistant' END
    || ':' || CASE WHEN l = 'I' THEN '' ELSE text END, chr(10) ORDER BY j) AS lines
  FROM letter l JOIN judged r ON l.conv_id IS NOT DISTINCT FROM r.conv_id AND r.i = greatest(l.i, 1)
  WHERE l <> 'D' GROUP BY l.conv_id
)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank,
  coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(least.cost, 0) AS cost, coalesce(least.audit, '') AS audit,
  sha256(coalesce(lines, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
  LEFT JOIN number n ON c.conv_id IS NOT DISTINCT FROM n.conv_id
  LEFT JOIN final f ON c.conv_id IS NOT DISTINCT FROM f.conv_id
  LEFT JOIN line l ON c.conv_id IS NOT DISTINCT FROM l.conv_id
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op4_benchmark_decontamination": OP4,
        "op9_minhash_near_dedup": OP9,
        "op11_vector_code_compression": _op11(),
        "op12_conversation_structure_repair": _op12(),
        "op13_embedding_near_dedup": OP13,
    }
