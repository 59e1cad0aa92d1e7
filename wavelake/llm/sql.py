"""SQL that gives the same rows as the queries, by other and plainer means; for the correctness gate only."""

from wavelake.llm import mixing, pieces, quota

# A path below its dataset's root, for layouts written without a root of their own.
_CLEAN = r"""
lower(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
  array_to_string(list_filter(string_split(replace(trim(nfc_normalize(url_decode(trim({0}, chr(32) || chr(9) || chr(10) || chr(13)))), chr(32) || chr(9) || chr(10) || chr(13)), chr(92), '/'), '/'), lambda x: x NOT IN ('', '.')), '/'),
  '[^/]+/[.][.](/|$)', ''), '[^/]+/[.][.](/|$)', ''), '[^/]+/[.][.](/|$)', ''), '[^/]+/[.][.](/|$)', ''))
"""

_ENTRIES = f"""
ent AS (SELECT entry_id, dataset, split, start, "end", coalesce(dataset, '') || '|' || {_CLEAN.format("audio_path")} AS rec,
    regexp_replace(regexp_replace({_CLEAN.format("audio_path").replace("lower(", "(", 1)}, '^.*/', ''), '[.][A-Za-z0-9]+$', '') AS stem,
    lower(string_split({_CLEAN.format("audio_path")}, '/')[-2]) AS folder
  FROM (SELECT *, row_number() OVER (PARTITION BY entry_id ORDER BY received_at DESC) AS rn FROM split_entries) WHERE rn = 1 AND audio_path IS NOT NULL)"""

_OVERLAPS = f"""
WITH {_ENTRIES},
dur AS (SELECT coalesce(dataset, '') || '|' || {_CLEAN.format("audio_path")} AS rec, duration_sec AS d FROM (
    SELECT *, row_number() OVER (PARTITION BY audio_path ORDER BY received_at DESC, duration_sec DESC NULLS LAST) AS rn FROM recordings) WHERE rn = 1),
iv AS (SELECT entry_id, dataset, split, ent.rec, start AS s, CASE WHEN d > 0 THEN least("end", d) ELSE "end" END AS e FROM ent LEFT JOIN dur ON ent.rec = dur.rec
  WHERE start IS NOT NULL AND NOT isnan(start) AND "end" IS NOT NULL AND NOT isnan("end")),
ok AS (SELECT * FROM iv WHERE e > s),
pairs AS (SELECT DISTINCT t.entry_id AS t, v.entry_id AS v FROM ok t JOIN ok v ON t.rec = v.rec AND t.split = 'train' AND v.split IN ('validation', 'test')
  WHERE least(t.e, v.e) - greatest(t.s, v.s) >= 0.8::DOUBLE * (v.e - v.s) - 1e-9),
ms AS (SELECT *, floor(least(s, 9e12::DOUBLE) * 1000)::BIGINT AS a, ceil(least(e, 9e12::DOUBLE) * 1000)::BIGINT AS b FROM ok),
seen AS (SELECT rec, a, b, max(b) OVER (PARTITION BY rec ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM ms WHERE split = 'train'),
num AS (SELECT *, sum(CASE WHEN m >= a THEN 0 ELSE 1 END) OVER (PARTITION BY rec ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS k FROM seen),
busy AS (SELECT rec, min(a) AS a, max(b) AS b FROM num GROUP BY rec, k),
cov AS (SELECT v.entry_id AS eval_id, v.dataset, v.split, any_value(v.b - v.a) AS size_ms, sum(least(v.b, busy.b) - greatest(v.a, busy.a))::BIGINT AS covered_ms
  FROM ms v JOIN busy ON v.rec = busy.rec AND v.a < busy.b AND v.b > busy.a WHERE v.split IN ('validation', 'test') GROUP BY ALL),
coverage AS (SELECT cov.*, coalesce(n, 0) AS n_train FROM cov LEFT JOIN (SELECT v, count(*) AS n FROM pairs GROUP BY v) ON eval_id = v)
"""

_GROUPS = f"""
WITH RECURSIVE {_ENTRIES},
who AS (SELECT DISTINCT regexp_extract(fname, '^[ ]*0*([0-9]+)([.][A-Za-z0-9]+)?[ ]*$', 1) AS sound, lower(trim(uploader)) AS who FROM dev WHERE lower(trim(uploader)) NOT IN ('', 'unknown', 'n/a')),
unit AS (SELECT entry_id, split, rec, CASE dataset WHEN 'fsd50k' THEN 'sound:' || ltrim(stem, '0') WHEN 'urbansound8k' THEN 'sound:' || ltrim(string_split(stem, '-')[1], '0')
    WHEN 'audioset_strong' THEN 'video:' || stem[1:11] WHEN 'hyenaset' THEN 'collar:' || folder ELSE 'rec:' || rec END AS unit FROM ent),
ids AS (SELECT unit, min(entry_id) AS uid FROM unit GROUP BY unit),
node AS (SELECT DISTINCT uid, rec, ids.unit FROM unit JOIN ids ON unit.unit = ids.unit),
hub AS (SELECT DISTINCT uid, 'r' || rec AS hub FROM node UNION SELECT uid, 'w' || who FROM ids JOIN who ON unit = 'sound:' || sound),
edge AS (SELECT DISTINCT a.uid AS a, b.uid AS b FROM hub a JOIN (SELECT hub, min(uid) AS uid FROM hub GROUP BY hub) b ON a.hub = b.hub),
both_ways AS (SELECT a, b FROM edge UNION SELECT b, a FROM edge),
reach AS (SELECT uid AS a, uid AS b FROM ids UNION SELECT reach.a, both_ways.b FROM reach JOIN both_ways ON reach.b = both_ways.a),
root AS (SELECT a AS uid, min(b) AS group_id FROM reach GROUP BY a),
grp AS (SELECT entry_id, split, group_id FROM unit JOIN ids ON unit.unit = ids.unit JOIN root ON ids.uid = root.uid)
"""

# The eight most similar of every twentieth vector, over all pairs.
_SIMILAR = """
WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY received_at DESC) AS rn FROM emb_cache)
  WHERE rn = 1 AND len(embedding) = 64 AND len(list_filter(embedding, lambda x: NOT coalesce(isfinite(x), false))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
r AS (SELECT p.vec_id AS qid, v.vec_id, list_cosine_similarity(p.e, v.e) AS c, row_number() OVER (PARTITION BY p.vec_id ORDER BY list_cosine_similarity(p.e, v.e) DESC, v.vec_id) AS rank
  FROM v p JOIN v ON p.vec_id <> v.vec_id WHERE p.vec_id % 20 = 0)
SELECT qid, vec_id, round(c, 6) AS similarity, rank FROM r WHERE rank <= 8
"""

SQL = {
    "p1_found": _OVERLAPS + "SELECT DISTINCT least(t, v) AS entry_a, greatest(t, v) AS entry_b FROM pairs",
    "p1_coverage": _OVERLAPS + "SELECT eval_id, dataset, split, n_train, size_ms, covered_ms FROM coverage",
    "p1_report": _OVERLAPS
    + """SELECT split, dataset, count(*) AS n_overlapped, count(*) FILTER (WHERE covered_ms >= 0.8::DOUBLE * size_ms) AS n_covered, count(*) FILTER (WHERE n_train > 0) AS n_records,
    sum(n_train)::BIGINT AS n_pairs, sum(covered_ms)::BIGINT AS covered_ms FROM coverage GROUP BY ALL""",
    "p2_found": _GROUPS + "SELECT group_id, entry_id FROM grp WHERE group_id IN (SELECT group_id FROM grp GROUP BY group_id HAVING count(DISTINCT split) > 1)",
    "p2_check": _GROUPS + "SELECT group_id, count(*) AS n_entries, count(DISTINCT split) AS n_old_splits, 1 AS n_new_splits FROM grp GROUP BY group_id",
    "p2_near": "SELECT split AS new_split, max(target_share) > 0 AS near FROM split_targets GROUP BY split",
    "p3_found": """
WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY received_at DESC) AS rn FROM emb_cache)
  WHERE rn = 1 AND len(embedding) = 64 AND len(list_filter(embedding, lambda x: NOT coalesce(isfinite(x), false))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
r AS (SELECT p.vec_id AS q, v.vec_id AS o, row_number() OVER (PARTITION BY p.vec_id ORDER BY list_cosine_similarity(p.e, v.e) DESC, v.vec_id) AS rn
  FROM v p JOIN v ON p.vec_id <> v.vec_id WHERE p.vec_id IN (SELECT vec_id FROM probe_vectors))
SELECT DISTINCT least(q, o) AS vec_a, greatest(q, o) AS vec_b FROM r WHERE rn <= 8
""",
    "p3_similar": _SIMILAR,
    "p3_exact": _SIMILAR,
    **pieces.SQL,
    **quota.SQL,
    **mixing.SQL,
    "p8_found": r"""
WITH i AS (SELECT item_id, regexp_extract_all(replace(lower(nfc_normalize(text)), 'ß', 'ss'), '[\p{L}\p{N}]+') AS w FROM eval_items),
n AS (SELECT *, least(12, len(w)) AS n FROM i WHERE len(w) > 0),
g AS (SELECT DISTINCT item_id, n, array_to_string(w[a : a + n - 1], ' ') AS gram FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS a FROM n)),
d AS (SELECT doc_id, regexp_extract_all(replace(lower(nfc_normalize(text)), 'ß', 'ss'), '[\p{L}\p{N}]+') AS w FROM documents WHERE text IS NOT NULL),
h AS (SELECT doc_id, n, array_to_string(w[a : a + n - 1], ' ') AS gram FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS a FROM d, (SELECT DISTINCT n FROM n) WHERE len(w) >= n))
SELECT DISTINCT item_id, doc_id FROM g JOIN h USING (n, gram)
""",
}
