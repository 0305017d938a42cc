"""DuckDB SQL for the queries that SQL can express, over whole tables."""

from loanloom.llm.license_scan import BASE, NOTICES

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _lower(text: str) -> str:
    return f"translate(coalesce({text}, ''), '{UPPER}', '{UPPER.lower()}')"


_CONTENT = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
_WORD = r"'[^\x20\x09-\x0D]+'"

SUFFIX_DEDUP = """
WITH b AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS hx FROM documents),
s AS (SELECT doc_id, j, substr(hx, 2 * j + 1, 100) AS k FROM b, unnest(range(0, len(hx) // 2 - 49)) t(j)),
m AS (SELECT k, min(doc_id) AS f FROM s GROUP BY k),
r AS (SELECT doc_id, j, lag(j) OVER (PARTITION BY doc_id ORDER BY j) AS p FROM s JOIN m USING (k) WHERE f < doc_id),
g AS (SELECT doc_id, j, sum(CASE WHEN p IS NULL OR j > p + 50 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY j) AS run FROM r),
runs AS (SELECT doc_id, run, min(j) AS a, max(j) + 50 AS b FROM g GROUP BY 1, 2),
marks AS (SELECT doc_id, a, b FROM runs UNION ALL SELECT doc_id, len(hx) // 2, NULL FROM b),
gaps AS (SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a, b NULLS LAST), 0) AS x, a AS y FROM marks),
kept AS (SELECT doc_id, string_agg(substr(hx, 2 * x + 1, 2 * (y - x)), '' ORDER BY x) AS hx FROM gaps JOIN b USING (doc_id) GROUP BY 1),
n AS (SELECT doc_id, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans FROM runs GROUP BY 1)
SELECT doc_id, len(b.hx) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(kept.hx)) AS kept_sha256
FROM b JOIN kept USING (doc_id) LEFT JOIN n USING (doc_id)"""

JACCARD_JOIN = f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_lower('text')}, {_WORD}) AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS s FROM w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) t(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY 1),
o AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM sh x JOIN sh y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM o JOIN n p ON a = p.doc_id JOIN n q ON b = q.doc_id WHERE 100 * c >= 85 * (p.n + q.n - c)),
reach(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY 1) LEFT JOIN n USING (doc_id)"""

WINNOWING = f"""
WITH w AS (SELECT doc_id, regexp_extract_all({_lower('text')}, {_CONTENT}) AS w FROM documents),
iw AS (SELECT item_id, regexp_extract_all({_lower('text')}, {_CONTENT}) AS w FROM benchmark),
iwn AS (SELECT item_id, w, least(len(w), 10) AS n FROM iw WHERE len(w) > 0),
p AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS pane FROM iwn, unnest(range(1, len(w) - n + 2)) t(i)),
lens AS (SELECT DISTINCT n FROM p),
d AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS pane FROM w, lens, unnest(range(1, len(w) - n + 2)) t(i)),
h AS (SELECT doc_id, i, d.n, item_id FROM d JOIN p ON d.pane = p.pane AND d.n = p.n),
c AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM h, unnest(range(i, i + n)) u(pos) GROUP BY 1),
k AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS x FROM h) GROUP BY 1)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN c USING (doc_id) LEFT JOIN k USING (doc_id)"""


def _centroids(k: int = 40, rounds: int = 5) -> str:
    """Lloyd's rounds, unrolled; one list of components per centroid."""
    parts = ["""WITH v AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64)""",
             f"""c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h NULLS LAST, v) - 1 AS cluster, v AS c
  FROM (SELECT sha256('2:' || vec_id) AS h, v FROM v ORDER BY h NULLS LAST, v LIMIT {k}))"""]
    distance = "list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT"
    for i in range(rounds + 1):
        parts.append(f"""d{i} AS MATERIALIZED (SELECT r, vec_id, v, min(struct_pack(distance := {distance}, cluster := cluster)) AS near
  FROM (SELECT *, row_number() OVER () AS r FROM v), c{i} GROUP BY r, vec_id, v)""")
        if i < rounds:
            parts.append(f"""m{i} AS MATERIALIZED (SELECT cluster, list(m ORDER BY j) AS c FROM (
  SELECT near.cluster AS cluster, j, ((sum(v[j]) - ((sum(v[j]) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS m
  FROM d{i}, range(1, 65) t(j) GROUP BY 1, 2) GROUP BY cluster)""")
            parts.append(f"c{i + 1} AS MATERIALIZED (SELECT c{i}.cluster, coalesce(m{i}.c, c{i}.c) AS c FROM c{i} LEFT JOIN m{i} USING (cluster))")
    return ",\n".join(parts) + f"""
SELECT vec_id, near.cluster::INT AS cluster, near.distance AS distance, (sum(near.distance) OVER (PARTITION BY near.cluster))::BIGINT AS cluster_inertia,
  (sum(near.distance) OVER ())::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM d{rounds} JOIN c{rounds} ON c{rounds}.cluster = d{rounds}.near.cluster"""


CENTROIDS = _centroids()


def _license_scan() -> str:
    """Every run of words within reach of a notice's length is compared with it in full."""
    notices = ", ".join(f"('{p}', '{label}', {k}, {p.count(' ') + 1}, {p in BASE})" for p, label, k in NOTICES)
    longest = max(p.count(" ") + 1 + k for p, _, k in NOTICES)
    return f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_lower('text')}, {_CONTENT}) AS w FROM documents),
notice(phrase, label, k, z, base) AS (VALUES {notices}),
start AS MATERIALIZED (SELECT r, unnest(range(len(w))) AS i, unnest(list_transform(range(len(w)), lambda i: w[i + 1:i + {longest}])) AS w FROM d),
runs AS (SELECT r, i, z, array_to_string(w[1:z], ' ') AS t FROM start, range(1, {longest + 1}) b(z) WHERE z <= len(w)),
near AS (SELECT r, i, phrase, label, base, levenshtein(t, phrase) AS e, k FROM runs JOIN notice ON runs.z BETWEEN notice.z - k AND notice.z + k
  AND strlen(t) BETWEEN strlen(phrase) - k AND strlen(phrase) + k),
hit AS (SELECT * FROM near WHERE e <= k),
sums AS (SELECT r, count(*) FILTER (e = 0 AND base) AS n_base, min(i) FILTER (e = 0 AND base) AS first_word, max(i) FILTER (e = 0 AND base) AS last_word,
  string_agg(DISTINCT label, ',' ORDER BY label) FILTER (e = 0 AND base) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels,
  max(1 - e / strlen(phrase)::DOUBLE) AS score FROM hit GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels,
  coalesce(labels, '') AS labels, coalesce(score, 0)::DOUBLE AS score FROM d LEFT JOIN sums USING (r)"""


LICENSE_SCAN = _license_scan()

CONVERSATION_REPAIR = r"""
WITH RECURSIVE
bytes AS (SELECT list(v ORDER BY i) AS t FROM (SELECT i, list_reduce(range(8), lambda c, _: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, i) AS v
  FROM range(256) r(i))),
named AS (SELECT *, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS s FROM conversations),
src AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  xor(list_reduce(list_transform(range(1, strlen(s) + 1), lambda i: ascii(s[i])::BIGINT), lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1]), 4294967295), 4294967295) % 20 AS kind
  FROM named, bytes),
damage AS (SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM (SELECT *, unnest(CASE kind WHEN 3 THEN [0, 1] ELSE [0] END) FROM src WHERE kind <> 0)),
conv AS (SELECT row_number() OVER () AS c, conv_id FROM (SELECT DISTINCT conv_id FROM conversations)),
keyed AS (SELECT c, turn, role, text, sha256(strlen(role) || ':' || role || text) AS k FROM damage JOIN conv ON conv.conv_id IS NOT DISTINCT FROM damage.conv_id),
placed AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, k) AS i FROM keyed),
line AS (SELECT *, row_number() OVER (PARTITION BY c, k ORDER BY i) AS seen,
  CASE WHEN left(role, 1) IN ('s', 'u', 'a') THEN left(role, 1) ELSE 'o' END AS f FROM placed),
judged AS (SELECT *, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank, seen > 1 AS again, NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS open FROM line),
step AS MATERIALIZED (SELECT *, blank OR again AS x, CASE WHEN open THEN 5 ELSE 0 END AS e FROM judged),
ends AS (SELECT c, count(*) AS n FROM step GROUP BY c),
back(c, i, v) AS (SELECT c, n + 1, [0, 10, 5, 0] FROM ends
  UNION ALL SELECT c, i, [least(g0, 5 + g2, 10 + g3), least(g1, 5 + g2, 10 + g3), least(g2, 5 + g3), least(g3, 5 + g2)] FROM (
    SELECT step.c, step.i,
      CASE WHEN x THEN 2 + v[1] ELSE least(2 + v[1], 1 + e + v[3], CASE f WHEN 's' THEN e + v[2] WHEN 'u' THEN e + v[3] END) END AS g0,
      CASE WHEN x THEN 2 + v[2] ELSE least(2 + v[2], 1 + e + v[3], CASE f WHEN 'u' THEN e + v[3] END) END AS g1,
      CASE WHEN x THEN 2 + v[3] ELSE least(2 + v[3], 1 + e + v[4], CASE f WHEN 'a' THEN e + v[4] END) END AS g2,
      CASE WHEN x THEN 2 + v[4] ELSE least(2 + v[4], 1 + e + v[3], CASE f WHEN 'u' THEN e + v[3] END) END AS g3
    FROM back JOIN step ON step.c = back.c AND step.i = back.i - 1)),
togo AS MATERIALIZED (SELECT * FROM back),
walk(c, i, q, audit, lines) AS (SELECT c, 1::BIGINT, 1, '', []::VARCHAR[] FROM ends
  UNION ALL SELECT c, CASE a WHEN 'I' THEN i ELSE i + 1 END, CASE a WHEN 'D' THEN q WHEN 'K' THEN kq ELSE nq END, audit || a,
    CASE a WHEN 'D' THEN lines WHEN 'K' THEN list_append(lines, role || ':' || text)
      ELSE list_append(lines, CASE nq WHEN 3 THEN 'user:' ELSE 'assistant:' END || CASE a WHEN 'I' THEN '' ELSE text END) END
  FROM (SELECT *, CASE WHEN 2 + w[q] = v[q] THEN 'D' WHEN 5 + v[nq] = v[q] THEN 'I' WHEN NOT x AND kq > 0 AND e + w[kq] = v[q] THEN 'K' WHEN NOT x THEN 'R' END AS a
    FROM (SELECT walk.c, walk.i, q, audit, lines, here.v, after.v AS w, role, text, x, e, [3, 3, 4, 3][q] AS nq,
      CASE WHEN f = 's' AND q = 1 THEN 2 WHEN f = 'u' AND q <> 3 THEN 3 WHEN f = 'a' AND q = 3 THEN 4 ELSE 0 END AS kq
      FROM walk JOIN togo here ON here.c = walk.c AND here.i = walk.i LEFT JOIN togo after ON after.c = walk.c AND after.i = walk.i + 1
      LEFT JOIN step ON step.c = walk.c AND step.i = walk.i WHERE here.v[q] > 0 OR after.v IS NOT NULL))),
ended AS (SELECT walk.c, audit, array_to_string(lines, chr(10)) AS kept FROM walk JOIN ends ON ends.c = walk.c AND i = n + 1 WHERE q IN (1, 4)),
facts AS (SELECT c, CASE WHEN count(turn) > 0 THEN max(turn) - min(turn) + 1 - count(DISTINCT turn) ELSE 0 END AS gaps, count(*) FILTER (blank) AS blank,
  count(*) FILTER (again AND NOT blank) AS duplicate, count(*) FILTER (open AND NOT x) AS truncated FROM step GROUP BY c),
pairs AS (SELECT c, count(*) AS illegal FROM (SELECT c, lag(f) OVER (PARTITION BY c ORDER BY i) || f AS p FROM step) WHERE p NOT IN ('su', 'ua', 'au') GROUP BY c)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(togo.v[1], 0)::BIGINT AS cost, coalesce(audit, '') AS audit, sha256(coalesce(kept, '')) AS repaired_sha256
FROM conv LEFT JOIN facts USING (c) LEFT JOIN pairs USING (c) LEFT JOIN ended USING (c) LEFT JOIN togo ON togo.c = conv.c AND togo.i = 1"""
