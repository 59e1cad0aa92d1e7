"""Queries over recordings, entries and events: segments, labels, joins, splits, checks."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wavelake.models.encoders import frame_grid
from wavelake.operators import generators, geometry, labels, ranks, splits
from wavelake.operators.segments import empty_regions, plan_segments
from wavelake.plans import pipeline
from wavelake.queries.base import CACHE, ENT, EV, REC, SEG, SEGS, cache, entries, events, recordings
from wavelake.session import table
from wavelake.sources import annotations as an
from wavelake.sources import files, manifest

QUERIES: dict = {}
SQL: dict = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def segments(spark: SparkSession, d: str, seg: float = SEG) -> DataFrame:
    r = recordings(spark, d)
    return plan_segments(r, F.lit(0.0), F.lit(float("inf")), F.col("duration"), seg, seg)


@query(f"WITH {REC}, {SEGS} SELECT audio_path, segment_id, seg_start, valid_sec FROM segs")
def q01_segment_plan_full(spark: SparkSession, d: str) -> DataFrame:
    return segments(spark, d).select("audio_path", "segment_id", "seg_start", "valid_sec")


@query(
    f"""WITH {REC}, {ENT}, j AS (
  SELECT entry_id, start, least("end", duration) AS til FROM ent JOIN rec USING (audio_path) WHERE isfinite(start) AND NOT isnan("end") AND least("end", duration) > start),
s AS (SELECT *, unnest(range(0, ceil((til - start) / 5.0::DOUBLE)::BIGINT)) AS segment_id FROM j),
v AS (SELECT entry_id, segment_id, start + 5.0::DOUBLE * segment_id AS seg_start, least(10.0::DOUBLE, til - (start + 5.0::DOUBLE * segment_id)) AS valid_sec FROM s)
SELECT * FROM v WHERE segment_id = 0 OR valid_sec > 1.0"""
)
def q02_segment_plan_region_tol(spark: SparkSession, d: str) -> DataFrame:
    e = entries(spark, d).join(recordings(spark, d).select("audio_path", "duration"), "audio_path")
    e = e.where(F.col("end").isNotNull() & ~F.isnan("end"))
    return plan_segments(e, F.col("start"), F.col("end"), F.col("duration"), 10.0, 5.0, 1.0).select("entry_id", "segment_id", "seg_start", "valid_sec")


@query(f"WITH {ENT} SELECT audio_path, dense_rank() OVER (ORDER BY audio_path) - 1 AS audio_id FROM (SELECT DISTINCT audio_path FROM ent WHERE audio_path IS NOT NULL)")
def q03_audio_id_rank(spark: SparkSession, d: str) -> DataFrame:
    return ranks.global_rank(entries(spark, d), "audio_path", "audio_id")


@query("SELECT class_name, dense_rank() OVER (ORDER BY class_name) - 1 AS label_idx FROM (SELECT DISTINCT class_name FROM strong_events)")
def q04_label_index(spark: SparkSession, d: str) -> DataFrame:
    return ranks.global_rank(table(spark, d, "strong_events"), "class_name", "label_idx")


def _weak(spark: SparkSession, d: str) -> an.Annotation:
    """Class names of the sounds of two datasets as an annotation: one per urbansound8k recording, several per fsd50k recording."""
    names = table(spark, d, "label_index").select("label_idx", "class_name")
    c = cache(spark, d)
    one = c.where(F.col("label_idx").isNotNull()).groupBy("audio_path").agg(F.min("label_idx").alias("i")).select("audio_path", F.array("i").alias("i"))
    several = c.where(F.size("label_idxs") > 0).groupBy("audio_path").agg(F.min("label_idxs").alias("i"))
    each = one.unionByName(several).select("audio_path", F.explode(F.array_distinct(F.array_compact("i"))).alias("label_idx"))
    named = an.named_codes(each, names, ["label_idx"], "class_name", "class_name", strict=False).where(F.col("class_name").isNotNull())
    return an.Annotation("multilabel", "weak", names.select("class_name"), weak=named.groupBy("audio_path").agg(F.collect_set("class_name").alias("classes")))


_WEAK = f"""{CACHE}, one AS (SELECT audio_path, [min(label_idx)] AS i FROM cache WHERE label_idx IS NOT NULL GROUP BY 1),
several AS (SELECT audio_path, min(label_idxs) AS i FROM cache WHERE len(label_idxs) > 0 GROUP BY 1),
each AS (SELECT DISTINCT audio_path, class_name FROM (SELECT audio_path, unnest(i) AS label_idx FROM (FROM one UNION ALL FROM several)) JOIN label_index USING (label_idx)),
idx AS (SELECT class_name, row_number() OVER (ORDER BY class_name) - 1 AS target FROM label_index)"""


@query(f"WITH {_WEAK} SELECT audio_path, min(target) AS label FROM each JOIN idx USING (class_name) WHERE audio_path LIKE 'audio/fold%' GROUP BY 1")
def q05_weak_multiclass_join(spark: SparkSession, d: str) -> DataFrame:
    """Recordings with one label: its class by rank."""
    a = _weak(spark, d)
    index = pipeline._index_df(spark, pipeline.class_index(a))
    e = a.weak.where(F.col("audio_path").startswith("audio/fold"))
    return pipeline.weak_labels(e, a, index, "multiclass", index.count())


@query(f"""WITH {_WEAK} SELECT p AS audio_path, idx.target AS label_idx, CASE WHEN each.class_name IS NULL THEN 0.0 ELSE 1.0 END AS hot
FROM (SELECT DISTINCT audio_path AS p FROM each WHERE audio_path LIKE 'FSD50K%') CROSS JOIN idx LEFT JOIN each ON each.audio_path = p AND each.class_name = idx.class_name""")
def q48_weak_multilabel_join(spark: SparkSession, d: str) -> DataFrame:
    """Recordings with several labels: every class, 1 where the recording has it."""
    a = _weak(spark, d)
    index = pipeline._index_df(spark, pipeline.class_index(a))
    e = a.weak.where(F.col("audio_path").startswith("FSD50K"))
    hot = pipeline.weak_labels(e, a, index, "multilabel", index.count())
    return hot.select("audio_path", F.posexplode("label").alias("label_idx", "hot")).withColumns({"label_idx": F.col("label_idx").cast("bigint"), "hot": F.col("hot").cast("double")})


@query(f"WITH {REC} SELECT audio_path FROM rec WHERE dataset IN ('hyenaset', 'datased') AND audio_path NOT IN (SELECT audio_path FROM strong_events)")
def q06_missing_annotations(spark: SparkSession, d: str) -> DataFrame:
    r = recordings(spark, d).where(F.col("dataset").isin("hyenaset", "datased"))
    return pipeline.unannotated(r, table(spark, d, "strong_events"))


@query(f"WITH {REC} SELECT audio_path FROM rec WHERE dataset = 'urbansound8k' AND audio_path NOT IN (SELECT audio_path FROM raw_cache WHERE audio_path IS NOT NULL) ORDER BY audio_path LIMIT 5")
def q49_first_missing(spark: SparkSession, d: str) -> DataFrame:
    r = recordings(spark, d).where(F.col("dataset") == "urbansound8k")
    return pipeline.unannotated(r, table(spark, d, "raw_cache")).orderBy("audio_path").limit(5)


@query(
    f"""WITH {CACHE}, n AS (SELECT max(label_idx) + 1 AS c FROM label_index)
SELECT row_id, i AS label_idx, CASE WHEN list_contains(label_idxs, i) THEN 1.0 ELSE 0.0 END::FLOAT AS hot
FROM (SELECT row_id, label_idxs, unnest(range(0, c)) AS i FROM cache, n WHERE label_idxs IS NOT NULL)"""
)
def q07_multihot_long(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "label_index").agg(F.max("label_idx")).first()[0] + 1
    c = cache(spark, d).where(F.col("label_idxs").isNotNull())
    return c.select("row_id", F.posexplode(labels.multihot(F.col("label_idxs"), n)).alias("label_idx", "hot")).withColumn("label_idx", F.col("label_idx").cast("bigint"))


def _clipped(spark: SparkSession, d: str) -> DataFrame:
    return labels.clip_events(segments(spark, d).select("audio_path", "segment_id", "seg_start", "seg_end", "valid_sec"), events(spark, d))


_CLIPPED = f"""{REC}, {EV}, {SEGS}, hits AS (
  SELECT segs.audio_path, segment_id, valid_sec, ord, class_name, greatest(ev_start, seg_start) - seg_start AS ev_start, least(ev_end, seg_start + valid_sec) - seg_start AS ev_end, value,
         CASE WHEN value IS NULL OR isnan(value) THEN 1 ELSE 2 END AS code
  FROM segs JOIN ev ON segs.audio_path = ev.audio_path AND ev_start < seg_start + valid_sec AND ev_end > seg_start)"""


@query(f"WITH {_CLIPPED} SELECT audio_path, segment_id, ord, class_name, ev_start, ev_end, code FROM hits")
def q08_strong_clip_events(spark: SparkSession, d: str) -> DataFrame:
    return _clipped(spark, d).select("audio_path", "segment_id", "ord", "class_name", "ev_start", "ev_end", labels.state_code(F.col("value")).alias("code"))


@query(f"WITH {_CLIPPED} SELECT audio_path, segment_id, class_name, max(code) AS code FROM hits GROUP BY ALL")
def q09_strong_to_weak_code(spark: SparkSession, d: str) -> DataFrame:
    return labels.weak_codes(_clipped(spark, d), ["audio_path", "segment_id", "class_name"])


@query(f"WITH {REC}, {EV} SELECT rec.audio_path, count(ev.ord) AS n_events, coalesce(min(ev.ord), -1) AS first_ord FROM rec LEFT JOIN ev ON rec.audio_path = ev.audio_path GROUP BY rec.audio_path")
def q10_event_list_left_join(spark: SparkSession, d: str) -> DataFrame:
    """Events of every recording as an array in order; none where there are none."""
    a = labels.event_array(events(spark, d).withColumn("target", F.col("ord")))
    e = recordings(spark, d).select("audio_path").join(a, "audio_path", "left")
    return e.select("audio_path", F.coalesce(F.size("events"), F.lit(0)).cast("bigint").alias("n_events"), F.coalesce(F.get("events", 0)["target"], F.lit(-1)).alias("first_ord"))


def _strong(spark: SparkSession, d: str, mode: str) -> tuple[DataFrame, int]:
    """Segments with the labels that a build gives them."""
    ev = events(spark, d).select("audio_path", "ord", "class_name", F.col("ev_start").alias("start"), F.col("ev_end").alias("end"), "value")
    a = an.Annotation("multilabel", "strong", table(spark, d, "strong_events").select("class_name").distinct(), events=ev)
    index = pipeline.class_index(a)
    seg = segments(spark, d).select(F.lit("train").alias("split"), F.xxhash64("audio_path").alias("entry_idx"), "audio_path", "segment_id", "seg_start", "seg_end", "valid_sec")
    return pipeline.strong_labels(seg, a, pipeline._index_df(spark, index), mode, len(index)), len(index)


_IDX = "idx AS (SELECT class_name, row_number() OVER (ORDER BY class_name) - 1 AS target FROM (SELECT DISTINCT class_name FROM strong_events))"


@query(f"""WITH {_CLIPPED}, {_IDX}, one AS (SELECT audio_path, segment_id, row_number() OVER (PARTITION BY audio_path, segment_id ORDER BY ord) - 1 AS k, target, round(ev_start, 6) + 0.0 AS ev_start, round(ev_end, 6) AS ev_end, code FROM hits JOIN idx USING (class_name))
SELECT segs.audio_path, segs.segment_id, coalesce(k, -1) AS k, coalesce(target, -1) AS target, coalesce(ev_start, -1) AS ev_start, coalesce(ev_end, -1) AS ev_end, coalesce(code, -1) AS code FROM segs LEFT JOIN one ON one.audio_path = segs.audio_path AND one.segment_id = segs.segment_id""")
def q50_strong_labels(spark: SparkSession, d: str) -> DataFrame:
    """The clipped events of every segment in order, as the build stores them; a segment without events has an empty list."""
    seg, _ = _strong(spark, d, "strong")
    e = seg.select("audio_path", "segment_id", F.posexplode_outer("label").alias("k", "e"))
    code = F.when(F.col("e").isNotNull(), labels.state_code(F.col("e.value")))
    cells = {"k": F.col("k").cast("bigint"), "target": F.col("e.target"), "ev_start": F.round("e.start", 6) + 0.0, "ev_end": F.round("e.end", 6), "code": code}
    return e.select("audio_path", "segment_id", *(F.coalesce(v, F.lit(-1)).alias(n) for n, v in cells.items()))


@query(f"WITH {_CLIPPED}, {_IDX} SELECT audio_path, segment_id, target AS label_idx, max(code) AS code FROM hits JOIN idx USING (class_name) GROUP BY ALL")
def q51_strong_to_weak_vector(spark: SparkSession, d: str) -> DataFrame:
    """The states of every segment's classes as the build stores them, absent ones left out."""
    seg, _ = _strong(spark, d, "strong_to_weak")
    e = seg.select("audio_path", "segment_id", F.posexplode("label").alias("label_idx", "v")).where(F.isnan("v") | (F.col("v") != 0))
    return e.select("audio_path", "segment_id", F.col("label_idx").cast("bigint").alias("label_idx"), F.when(F.isnan("v"), 1).otherwise(2).alias("code"))


@query(f"WITH {_CLIPPED}, n AS (SELECT audio_path, segment_id, class_name, max(code) AS code FROM hits GROUP BY ALL) SELECT class_name, code, count(*) AS n_segments FROM n GROUP BY ALL")
def q11_clip_equals_strong_to_weak(spark: SparkSession, d: str) -> DataFrame:
    """Segments per class and state, from the clipped events' arrays."""
    seg, _ = _strong(spark, d, "strong_to_weak")
    names = pipeline.class_index(an.Annotation("multilabel", "strong", table(spark, d, "strong_events").select("class_name").distinct()))
    e = seg.select(F.posexplode("label").alias("target", "v")).where(F.isnan("v") | (F.col("v") != 0))
    e = e.groupBy(F.col("target").cast("bigint").alias("target"), F.when(F.isnan("v"), 1).otherwise(2).alias("code")).agg(F.count(F.lit(1)).alias("n_segments"))
    return an.named_codes(e, pipeline._index_df(spark, names), ["target"], "class_name", "class_name").select("class_name", "code", "n_segments")


STEP = 0.16
FRAMES = 62
_GRID = f"""grid AS (SELECT audio_path, segment_id, valid_sec, v, unnest(range(0, {FRAMES})) AS t FROM (
    SELECT *, valid_sec::FLOAT AS v, least({FRAMES}, greatest(1, ((greatest((round_even((valid_sec::FLOAT * 16000::FLOAT)::DOUBLE, 0))::BIGINT, 2800) - 400) // 160 + 1) // 16)) AS k FROM segs) WHERE true),
frames AS (SELECT g.audio_path, g.segment_id, t,
    CASE WHEN t < k THEN t::FLOAT * {STEP}::FLOAT ELSE 0::FLOAT END AS f_start,
    CASE WHEN t = k - 1 THEN g.v WHEN t < k THEN least((t + 1)::FLOAT * {STEP}::FLOAT, g.v) ELSE 0::FLOAT END AS f_end
  FROM grid g JOIN (SELECT audio_path, segment_id, least({FRAMES}, greatest(1, ((greatest((round_even((valid_sec::FLOAT * 16000::FLOAT)::DOUBLE, 0))::BIGINT, 2800) - 400) // 160 + 1) // 16)) AS k FROM segs) USING (audio_path, segment_id))"""


def _valid_frames():
    return F.least(F.lit(FRAMES), F.greatest(F.lit(1), geometry.beats_tokens(geometry.samples(F.col("valid_sec"), 16000))))


def _frames(spark: SparkSession, d: str) -> DataFrame:
    return segments(spark, d).withColumn("geometry", geometry.frame_geometry(FRAMES, STEP, _valid_frames(), F.col("valid_sec")))


@query(f"WITH {REC}, {SEGS}, {_GRID} SELECT audio_path, segment_id, t AS frame, f_start, f_end FROM frames")
def q12_frame_geometry(spark: SparkSession, d: str) -> DataFrame:
    g = _frames(spark, d).select("audio_path", "segment_id", F.posexplode("geometry").alias("frame", "g"))
    return g.select("audio_path", "segment_id", F.col("frame").cast("bigint").alias("frame"), F.col("g.start").alias("f_start"), F.col("g.end").alias("f_end"))


@query(
    f"""WITH {REC}, {EV}, {SEGS}, {_GRID}, hits AS (
  SELECT segs.audio_path, segment_id, class_name, (greatest(ev_start, seg_start) - seg_start)::FLOAT AS a, (least(ev_end, seg_start + valid_sec) - seg_start)::FLOAT AS b,
         CASE WHEN value IS NULL OR isnan(value) THEN 1 ELSE 2 END AS code
  FROM segs JOIN ev ON segs.audio_path = ev.audio_path AND ev_start < seg_start + valid_sec AND ev_end > seg_start)
SELECT audio_path, segment_id, t AS frame, class_name, max(code) AS code FROM frames JOIN hits USING (audio_path, segment_id) WHERE a < f_end AND b > f_start GROUP BY ALL"""
)
def q13_frame_label_code(spark: SparkSession, d: str) -> DataFrame:
    c = _clipped(spark, d)
    hits = labels.frame_hits(c, STEP, _valid_frames(), F.col("valid_sec"))
    return hits.groupBy("audio_path", "segment_id", "frame", "class_name").agg(F.max(labels.state_code(F.col("value"))).alias("code"))


@query(
    f"""WITH {_CLIPPED}, {_GRID}, {_IDX}, fhits AS (SELECT audio_path, segment_id, class_name, ev_start::FLOAT AS a, ev_end::FLOAT AS b, code FROM hits)
SELECT audio_path, segment_id, t AS frame, target AS label_idx, max(code) AS code FROM frames JOIN fhits USING (audio_path, segment_id) JOIN idx USING (class_name) WHERE a < f_end AND b > f_start GROUP BY ALL"""
)
def q52_frame_state_matrix(spark: SparkSession, d: str) -> DataFrame:
    """The states of every frame's classes as the build of frame embeddings makes them, absent ones left out."""
    seg, classes = _strong(spark, d, "strong")

    def run(batches):
        for pdf in batches:
            out = []
            for p, k, sec, n, ev in zip(pdf["audio_path"], pdf["segment_id"], pdf["valid_sec"], pdf["n"], pdf["label"]):
                m = pipeline.state_matrix(frame_grid(FRAMES, STEP, int(n), float(sec)), list(ev), classes)
                for t, c in zip(*np.nonzero(m)):  # NaN counts as not zero
                    out.append((p, k, t, c, 2 if m[t, c] == 1 else 1))
            yield pd.DataFrame(out, columns=["audio_path", "segment_id", "frame", "label_idx", "code"])

    s = seg.where(F.size("label") > 0).select("audio_path", "segment_id", "valid_sec", _valid_frames().alias("n"), "label")
    return s.mapInPandas(run, "audio_path string, segment_id bigint, frame bigint, label_idx bigint, code int")


@query(
    """SELECT l_orderkey AS file, coalesce(max(CASE WHEN l_linenumber = 1 THEN p END), max(p)) AS present
FROM (SELECT *, CASE WHEN l_discount > 0.05 THEN 1 ELSE 0 END AS p FROM lineitem) GROUP BY l_orderkey"""
)
def q14_annotator_precedence(spark: SparkSession, d: str) -> DataFrame:
    """The verified annotator (line 1) overrides the vote of the others."""
    rows = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("audio_filename"), (F.col("l_linenumber") - 1).alias("annotator_id"), F.when(F.col("l_discount") > 0.05, 1).otherwise(-1).alias("present"))
    return an.presence(rows, ["present"]).withColumnRenamed("audio_filename", "file")


_STATE = "CASE WHEN {0} < 0.02 THEN 'POS' WHEN {0} < 0.06 THEN 'UNK' ELSE 'NEG' END"


@query(
    f"""WITH wide AS (SELECT row_number() OVER () AS rid, l_orderkey AS row_key, l_linenumber AS line, {_STATE.format('l_discount')} AS c1, {_STATE.format('l_tax')} AS c2,
    {_STATE.format('abs(l_discount - l_tax)')} AS c3 FROM lineitem),
long AS (SELECT rid, row_key, line, unnest([1, 2, 3]) AS col, unnest(['alarm', 'call', 'alarm']) AS class_name, unnest([c1, c2, c3]) AS state FROM wide),
ranked AS (SELECT *, row_number() OVER (PARTITION BY rid, class_name ORDER BY CASE state WHEN 'POS' THEN 0 ELSE 1 END, col) AS rn FROM long WHERE state <> 'NEG')
SELECT row_key::VARCHAR AS audio_path, line * 3 + col - 1 AS ord, class_name, CASE state WHEN 'POS' THEN 2 ELSE 1 END AS code FROM ranked WHERE rn = 1"""
)
def q15_unpivot_tristate_dedupe(spark: SparkSession, d: str) -> DataFrame:
    """Columns of states to events: two columns share a class; POS before UNK, then the first column."""
    state = lambda c: F.when(c < 0.02, "POS").when(c < 0.06, "UNK").otherwise("NEG")
    wide = table(spark, d, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("audio_path"), F.col("l_linenumber").cast("bigint").alias("row"), F.lit(0.0).alias("start"), F.lit(1.0).alias("end"),
        state(F.col("l_discount")).alias("c1"), state(F.col("l_tax")).alias("c2"), state(F.abs(F.col("l_discount") - F.col("l_tax"))).alias("c3"),
    )
    ev = an.matrix_events(wide, {"c1": "alarm", "c2": "call", "c3": "alarm"})
    return ev.select("audio_path", "ord", "class_name", labels.state_code(F.col("value")).alias("code"))


@query(
    f"""WITH {REC}, a AS (SELECT audio_path, duration FROM rec WHERE dataset = 'datased'), b AS (SELECT audio_path, dataset FROM rec WHERE dataset <> 'datased')
SELECT audio_path, duration, NULL AS dataset FROM a UNION ALL SELECT audio_path, NULL, dataset FROM b WHERE audio_path IN ('audio/fold1/100000-1-0-0.wav', 'FSD50K.dev_audio/100001.wav', 'FSD50K.dev_audio/100010.wav')"""
)
def q16_patch_union(spark: SparkSession, d: str) -> DataFrame:
    """One table, and of another the rows of some recordings, with the columns of both."""
    r = recordings(spark, d)
    a = r.where(F.col("dataset") == "datased").select("audio_path", "duration")
    return an.patched(a, r.where(F.col("dataset") != "datased").select("dataset", "audio_path"), "audio_path", ["audio/fold1/100000-1-0-0.wav", "FSD50K.dev_audio/100001.wav", "FSD50K.dev_audio/100010.wav"])


@query("SELECT class_name, count(*) AS n FROM audioset_train_strong a LEFT JOIN label_index l ON a.label = l.mid GROUP BY 1")
def q17_code_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Events per class name, by the code of their label; null for codes without a name."""
    a = table(spark, d, "audioset_train_strong").withColumnRenamed("label", "mid")
    named = an.named_codes(a, table(spark, d, "label_index").select("mid", F.col("class_name").alias("n")), ["mid"], "n", "class_name", strict=False)
    return named.groupBy("class_name").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {REC}, {ENT} SELECT entry_id, duration FROM ent LEFT JOIN rec ON ent.dataset = rec.dataset AND ent.audio_path = rec.audio_path")
def q18_composite_key_lookup(spark: SparkSession, d: str) -> DataFrame:
    """The duration of every entry's recording, by dataset and path together."""
    return an.named_codes(entries(spark, d).select("entry_id", "dataset", "audio_path"), recordings(spark, d), ["dataset", "audio_path"], "duration", "duration", strict=False).select("entry_id", "duration")


@query(
    f"""WITH {REC}, last AS (SELECT * FROM (SELECT segment_id, label, row_number() OVER (PARTITION BY segment_id ORDER BY received_at DESC, label DESC) AS rn FROM audioset_train_strong) WHERE rn = 1)
SELECT audio_path, label FROM rec JOIN last ON segment_id = regexp_replace(regexp_extract(audio_path, '[^/]*$'), '[.]wav$', '') WHERE dataset = 'audioset_strong'"""
)
def q19_basename_key_last_wins(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "audioset_train_strong").withColumn("o", F.struct("received_at", "label"))
    r = recordings(spark, d).where(F.col("dataset") == "audioset_strong").withColumn("segment_id", an.video_key(F.col("audio_path")))
    return r.join(an.last_wins(t, "segment_id", "o", "label"), "segment_id").select("audio_path", "label")


@query(f"WITH {REC} SELECT audio_path, string_split(audio_path, '/')[1] AS region, CASE WHEN len(string_split(audio_path, '/')) > 2 THEN string_split(audio_path, '/')[3] END AS species FROM rec")
def q20_path_label_extract(spark: SparkSession, d: str) -> DataFrame:
    p = F.col("audio_path")
    return recordings(spark, d).select("audio_path", an.path_part(p, 0).alias("region"), an.path_part(p, 2).alias("species"))


@query("SELECT string_split(audio_path, '/')[2] AS folder, count(*) AS n FROM recordings GROUP BY 1")
def q53_count_by_folder(spark: SparkSession, d: str) -> DataFrame:
    return files.count_by_folder(table(spark, d, "recordings"), 1)


@query(
    f"""WITH {REC}, f AS (SELECT audio_path, regexp_extract(audio_path, '^audio/fold([0-9]+)/', 1)::INT AS fold FROM rec WHERE dataset = 'urbansound8k')
SELECT audio_path, fold, CASE WHEN fold <= 8 THEN 'train' WHEN fold = 9 THEN 'validation' ELSE 'test' END AS split FROM f"""
)
def q21_fold_split(spark: SparkSession, d: str) -> DataFrame:
    r = recordings(spark, d).where(F.col("dataset") == "urbansound8k").withColumn("fold", F.regexp_extract("audio_path", r"^audio/fold([0-9]+)/", 1).cast("int"))
    folds = {k: "train" for k in range(1, 9)} | {9: "validation", 10: "test"}
    return r.select("audio_path", "fold", splits.fold_split(F.col("fold"), folds).alias("split"))


@query("SELECT fname, CASE split WHEN 'train' THEN 'train' WHEN 'val' THEN 'validation' END AS split, count(*) AS n FROM dev GROUP BY 1, 2")
def q22_split_column_map(spark: SparkSession, d: str) -> DataFrame:
    v = table(spark, d, "dev").select("fname", splits.mapped_split(F.col("split"), {"train": "train", "val": "validation"}).alias("split"))
    return v.groupBy("fname", "split").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {REC} SELECT audio_path, duration FROM rec WHERE dataset = 'fsd50k' AND NOT duration > 30.0")
def q23_over_length_filter(spark: SparkSession, d: str) -> DataFrame:
    return generators.up_to(recordings(spark, d).where(F.col("dataset") == "fsd50k"), 30.0).select("audio_path", "duration")


@query(f"WITH {REC}, {ENT} SELECT entry_id FROM ent JOIN rec USING (audio_path) WHERE start IS NULL OR \"end\" IS NULL OR NOT least(\"end\", duration) > start OR isnan(start) OR isnan(\"end\")")
def q54_empty_regions(spark: SparkSession, d: str) -> DataFrame:
    """Entries that give no segment."""
    e = entries(spark, d).join(recordings(spark, d).select("audio_path", "duration"), "audio_path")
    return empty_regions(e, F.col("start"), F.col("end"), F.col("duration")).select("entry_id")


@query(f"WITH {ENT} SELECT entry_id, audio_path FROM ent WHERE audio_path IN (SELECT audio_path FROM recordings)")
def q24_on_disk_semi(spark: SparkSession, d: str) -> DataFrame:
    return files.existing(entries(spark, d), table(spark, d, "recordings")).select("entry_id", "audio_path")


@query("SELECT user_id, min(event_id) AS first_seen FROM events GROUP BY user_id")
def q25_ordered_distinct(spark: SparkSession, d: str) -> DataFrame:
    return ranks.ordered_distinct(table(spark, d, "events"), "user_id", "event_id").withColumnRenamed("event_id", "first_seen")


@query(
    f"""WITH {REC}, k AS (SELECT audio_path, dataset, row_number() OVER (PARTITION BY dataset ORDER BY md5('0:' || dataset || ':' || audio_path), audio_path) AS r,
    count(*) OVER (PARTITION BY dataset) AS n FROM rec),
p AS (SELECT *, round_even(n * 0.8::DOUBLE, 0) AS a, round_even(n * 0.1::DOUBLE, 0) AS b FROM k)
SELECT audio_path, dataset, CASE WHEN r <= a THEN 'train' WHEN r <= a + least(b, n - a) THEN 'validation' ELSE 'test' END AS split FROM p"""
)
def q26_stratified_split_md5(spark: SparkSession, d: str) -> DataFrame:
    r = splits.stratified_split(recordings(spark, d), "audio_path", "dataset")
    return r.select("audio_path", "dataset", "split")


@query(
    f"""WITH {REC}, n AS (SELECT dataset, count(*) AS n FROM rec GROUP BY 1), p AS (SELECT *, round_even(n * 0.8::DOUBLE, 0)::BIGINT AS a, least(round_even(n * 0.1::DOUBLE, 0), n - round_even(n * 0.8::DOUBLE, 0))::BIGINT AS b FROM n)
SELECT dataset, split, k AS n FROM (SELECT dataset, unnest(['train', 'validation', 'test']) AS split, unnest([a, b, n - a - b]) AS k FROM p) WHERE k > 0"""
)
def q27_stratified_split_rng(spark: SparkSession, d: str) -> DataFrame:
    """Recordings per dataset and split of the split in the generator's order."""
    r = splits.stratified_split_shuffled(recordings(spark, d), "audio_path", "dataset")
    return r.groupBy("dataset", "split").agg(F.count(F.lit(1)).alias("n"))


@query(
    f"""WITH {REC}, {EV}, c AS (SELECT DISTINCT audio_path, class_name FROM ev JOIN rec USING (audio_path)), n AS (SELECT class_name, count(*) AS n FROM c GROUP BY 1)
SELECT class_name, n AS n_files, n >= 3 AS everywhere FROM n"""
)
def q28_greedy_duration_split(spark: SparkSession, d: str) -> DataFrame:
    """Files per class, and whether the greedy split has each class of three files or more in validation and test."""
    sets = events(spark, d).groupBy("audio_path").agg(F.collect_set("class_name").alias("classes"))
    timed = recordings(spark, d).join(sets, "audio_path", "left")
    placed = splits.greedy_split(timed, "audio_path", "classes", "duration").join(timed, "audio_path").select("split", F.explode("classes").alias("class_name"))
    per = placed.groupBy("class_name").agg(F.count(F.lit(1)).alias("n_files"), F.array_sort(F.collect_set("split")).alias("s"))
    return per.select("class_name", "n_files", ((F.col("n_files") >= 3) & F.array_contains("s", "validation") & F.array_contains("s", "test")).alias("everywhere"))


@query(
    f"""WITH {ENT}, two AS (SELECT entry_id, split FROM ent WHERE split IN ('train', 'validation'))
SELECT entry_id, split FROM two UNION ALL SELECT entry_id, 'test' FROM two WHERE split = 'validation'"""
)
def q29_copy_rule(spark: SparkSession, d: str) -> DataFrame:
    two = entries(spark, d).where(F.col("split").isin("train", "validation")).select("entry_id", "split")
    return splits.copy_missing(two)


@query(
    f"""WITH {ENT}, p AS (SELECT DISTINCT split, audio_path FROM ent WHERE audio_path IS NOT NULL)
SELECT a.split AS split_a, b.split AS split_b, count(*) AS n_shared FROM p a JOIN p b ON a.audio_path = b.audio_path AND a.split <= b.split GROUP BY ALL"""
)
def q30_verify_summary(spark: SparkSession, d: str) -> DataFrame:
    """Paths per split and shared by splits."""
    return manifest.shared_paths(entries(spark, d))


@query(f"""WITH {ENT}, ok AS (SELECT audio_path, split, start, least("end", 1e14::DOUBLE) AS e FROM ent WHERE audio_path IS NOT NULL AND start < "end" AND NOT isnan("end"))
SELECT a.audio_path, a.split AS split_a, a.start AS start_a, a.e AS end_a, b.split AS split_b, b.start AS start_b, b.e AS end_b
FROM ok a JOIN ok b ON a.audio_path = b.audio_path AND a.split < b.split AND a.start < b.e AND a.e > b.start AND NOT (a.start = b.start AND a.e = b.e)""")
def q55_manifest_overlaps(spark: SparkSession, d: str) -> DataFrame:
    """Entries of one path in different splits that overlap, as a manifest's check finds them."""
    return manifest.cross_split_overlaps(entries(spark, d)).select("audio_path", "split_a", "start_a", "end_a", "split_b", "start_b", "end_b")


@query(
    f"""WITH {REC}, {ENT}, t AS (SELECT entry_id, split, audio_path, start AS s, least("end", duration) AS e FROM ent JOIN rec USING (audio_path) WHERE isfinite(start) AND NOT isnan("end")),
u AS (SELECT * FROM t WHERE s < e)
SELECT a.entry_id AS entry_a, b.entry_id AS entry_b FROM u a JOIN u b ON a.audio_path = b.audio_path AND a.split <> b.split AND a.entry_id < b.entry_id AND a.s < b.e AND a.e > b.s AND NOT (a.s = b.s AND a.e = b.e)"""
)
def q31_cross_split_overlap(spark: SparkSession, d: str) -> DataFrame:
    """Entries of different splits that overlap on one recording without being the same interval."""
    t = entries(spark, d).join(recordings(spark, d).select("audio_path", "duration"), "audio_path").where(F.col("end").isNotNull() & ~F.isnan("end"))
    t = t.select("audio_path", "entry_id", "split", F.col("start").alias("s"), F.least("end", "duration").alias("e"))
    side = lambda x: t.select("audio_path", *(F.col(c).alias(f"{c}_{x}") for c in ("entry_id", "split", "s", "e")))
    m = labels.interval_join(side("a"), side("b"), ["audio_path"], ("s_a", "e_a"), ("s_b", "e_b"), 60.0)
    m = m.where("split_a <> split_b and entry_id_a < entry_id_b and not (s_a = s_b and e_a = e_b)")
    return m.select(F.col("entry_id_a").alias("entry_a"), F.col("entry_id_b").alias("entry_b"))


@query(f"WITH {ENT} SELECT split, audio_path, count(*) AS n FROM ent WHERE audio_path IS NOT NULL GROUP BY ALL HAVING count(*) > 1")
def q32_duplicate_in_split(spark: SparkSession, d: str) -> DataFrame:
    return manifest.repeated_paths(entries(spark, d).where(F.col("audio_path").isNotNull()))


@query(f"""WITH {ENT} SELECT entry_id FROM ent WHERE start IS NULL OR "end" IS NULL OR isnan(start) OR isnan("end") OR NOT start < "end" """)
def q33_interval_sanity(spark: SparkSession, d: str) -> DataFrame:
    return manifest.broken_entries(entries(spark, d)).select("entry_id")
