"""The two builds: recordings to a table of segments, segments to a table of embeddings."""

from __future__ import annotations

import logging
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from wavelake.models.registry import create_model
from wavelake.operators import labels as lab
from wavelake.operators.ranks import global_rank
from wavelake.operators.segments import empty_regions, plan_segments
from wavelake.operators.splits import SPLITS
from wavelake.plans.config import EMB_MARKER, LABELS, RAW_MARKER, EmbConfig, PrepConfig
from wavelake.plans.storage import Folder, decide
from wavelake.session import cut
from wavelake.sources.annotations import Annotation, load_annotation, video_key
from wavelake.sources.manifest import read_manifest
from wavelake.sources.wav import decode, durations, list_array, raw_type

log = logging.getLogger(__name__)
EVENTS = "array<struct<target:bigint,start:double,end:double,value:float>>"
#: Most classes of one dataset.
MAX_CLASSES = 100_000


#: Subfolder of the rows; side files lie beside it.
ROWS = "rows"


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a table that either build made."""
    return spark.read.parquet(f"{path.rstrip('/')}/{ROWS}")


def out_mode(a: Annotation, label_type: str) -> str:
    """multiclass, multilabel, strong or strong_to_weak."""
    if a.annotation_kind == "weak":
        if label_type == "strong":
            raise ValueError("the dataset has weak labels only")
        return a.label_kind
    return "strong" if label_type == "strong" else "strong_to_weak"


def class_index(a: Annotation) -> dict[str, int]:
    """Class names by rank; a name that comes twice is an error."""
    names = [r[0] for r in a.classes.limit(MAX_CLASSES + 1).collect()]
    if len(names) > MAX_CLASSES:
        raise ValueError(f"more than {MAX_CLASSES} classes")
    if len(set(names)) != len(names):
        raise ValueError("a class name comes twice")
    return {n: i for i, n in enumerate(sorted(names))}


def _index_df(spark: SparkSession, index: dict[str, int]) -> DataFrame:
    return spark.createDataFrame(sorted(index.items()), "class_name string, target bigint")


def unannotated(entries: DataFrame, annotated: DataFrame, by_video: bool = False) -> DataFrame:
    """``audio_path`` of the entries without an annotation, each once; with ``by_video`` annotations are keyed by video."""
    key = video_key(F.col("audio_path")) if by_video else F.col("audio_path")
    return entries.select("audio_path").distinct().withColumn("_key", key).join(annotated.select(F.col("audio_path").alias("_key")), "_key", "left_anti").select("audio_path")


def need_annotations(entries: DataFrame, annotated: DataFrame, by_video: bool = False) -> None:
    """An error that names the first five entries without annotation, if there are any."""
    missing = [r[0] for r in unannotated(entries, annotated, by_video).orderBy("audio_path").limit(5).collect()]
    if missing:
        raise ValueError(f"entries without annotation: {missing}")


def weak_labels(entries: DataFrame, a: Annotation, index: DataFrame, mode: str, classes: int, by_video: bool = False) -> DataFrame:
    """``audio_path, label`` of every entry that is annotated (see ``need_annotations``)."""
    key = video_key(F.col("audio_path")) if by_video else F.col("audio_path")
    want = entries.select("audio_path").distinct().withColumn("_key", key)
    each = a.weak.select(F.col("audio_path").alias("_key"), F.explode("classes").alias("class_name")).join(F.broadcast(index), "class_name")  # at most MAX_CLASSES rows
    idx = each.groupBy("_key").agg(F.array_sort(F.collect_list("target")).alias("idx"))  # the labels of one recording
    got = want.join(a.weak.select(F.col("audio_path").alias("_key")).distinct(), "_key").join(idx, "_key", "left")
    label = F.get("idx", 0) if mode == "multiclass" else lab.multihot(F.col("idx"), classes)
    return got.select("audio_path", label.alias("label"))


def strong_labels(segments: DataFrame, a: Annotation, index: DataFrame, mode: str, classes: int) -> DataFrame:
    """Adds ``label`` to segments: their clipped events in order, or the state of every class."""
    key = ["split", "entry_idx", "segment_id"]
    ev = a.events.join(F.broadcast(index), "class_name").select("audio_path", "ord", "target", F.col("start").alias("ev_start"), F.col("end").alias("ev_end"), "value")
    hit = lab.clip_events(segments.select(*key, "audio_path", "seg_start", "seg_end"), ev)
    got = hit.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("ord", "target", "ev_start", "ev_end", "value"))).alias("e"))
    items = F.transform("e", lambda x: F.struct(x["target"].alias("target"), x["ev_start"].alias("start"), x["ev_end"].alias("end"), x["value"].alias("value"))).cast(EVENTS)
    out = segments.join(got.select(*key, items.alias("label")), key, "left").withColumn("label", F.coalesce("label", F.array().cast(EVENTS)))
    return out if mode == "strong" else out.withColumn("label", lab.tri_state(F.col("label"), classes))


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of so many rows while something is written; the session's setting holds again afterwards."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, rows)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def prepare_dataset(spark: SparkSession, cfg: PrepConfig, annotation: Annotation | None = None) -> str:
    """Builds the table of segments and returns its folder; a complete one with the same settings is kept."""
    folder = Folder(spark, cfg.cache_dir)
    if not decide(folder, RAW_MARKER, cfg.overwrite, cfg.config_hash):
        log.info("%s is complete", folder.path)
        return folder.path
    a = annotation or load_annotation(spark, cfg.dataset_name, cfg.dataset_dir)
    mode = out_mode(a, cfg.label_type)
    index = class_index(a)
    index_df = _index_df(spark, index)
    entries = read_manifest(spark, cfg.split_json)
    have = {r[0] for r in entries.select("split").distinct().collect()}
    for s in SPLITS:
        if s not in have:
            raise ValueError(f"split {s} is empty")
    ids = global_rank(entries, "audio_path", "audio_id")
    timed = cut(entries.join(durations(entries, cfg.dataset_dir), "audio_path"))  # heads of files are read once
    span = (F.col("start"), F.col("end"), F.col("duration"))
    none = empty_regions(timed, *span).limit(5).collect()
    if none:
        raise ValueError(f"entries without a segment: {[r['audio_path'] for r in none]}")
    seg = plan_segments(timed, *span, cfg.seg_sec, cfg.hop_sec, cfg.tol_sec).join(ids, "audio_path")
    seg = seg.select("split", "entry_idx", "audio_path", "audio_id", "segment_id", "seg_start", "seg_end", "valid_sec")
    by_video = cfg.dataset_name == "AudioSetWeak"
    known = a.annotated if a.weak is None else a.weak
    if known is not None:
        need_annotations(entries, known, by_video)
    if mode in ("strong", "strong_to_weak"):
        seg = strong_labels(seg, a, index_df, mode, len(index))
    else:
        seg = seg.join(weak_labels(entries, a, index_df, mode, len(index), by_video), "audio_path")
    seg = seg.select("split", "entry_idx", "audio_path", "audio_id", "segment_id", F.lit(cfg.sr).cast("bigint").alias("sr"), F.col("seg_start").alias("start"), F.col("seg_end").alias("end"), "valid_sec", "label")
    order = ["split", "entry_idx", "audio_path", "audio_id", "segment_id", "raw", "sr", "start", "end", "valid_sec", "label"]
    kinds = {f.name: f.dataType for f in seg.schema.fields} | {"raw": T.StructType.fromDDL(f"x {raw_type(cfg.mono)}")["x"].dataType}
    schema = T.StructType([T.StructField(c, kinds[c]) for c in order])
    # A recording's segments stay together, so its file is opened in one place.
    rows = decode(seg.repartition("audio_path", (F.col("segment_id") / 64).cast("int")), cfg.dataset_dir, cfg.sr, cfg.mono, round(cfg.seg_sec * cfg.sr), schema)
    with batches_of(spark, cfg.batch_size):
        rows.write.partitionBy("split").parquet(f"{folder.path}/{ROWS}")
    folder.write_json(LABELS, index)
    folder.write_json(RAW_MARKER, cfg.sidecar() | {"out_mode": mode, "num_classes": len(index)})
    return folder.path


def label_mode(schema: T.StructType) -> str:
    """What the stored labels are, from their type."""
    t = schema["label"].dataType
    if isinstance(t, T.LongType):
        return "multiclass"
    return "strong" if isinstance(t.elementType, T.StructType) else "multilabel"


def state_matrix(spans: np.ndarray, events: list, classes: int) -> np.ndarray:
    """States (spans x classes) of events over spans; bounds are compared in single precision."""
    code = np.zeros((len(spans), classes), np.int8)
    for e in events:
        a, b = np.float32(e["start"]), np.float32(e["end"])
        hit = (a < spans[:, 1]) & (b > spans[:, 0])
        np.maximum.at(code, (np.flatnonzero(hit), int(e["target"])), 1 if e["value"] is None or np.isnan(e["value"]) else 2)
    return np.where(code == 2, 1.0, np.where(code == 1, np.nan, 0.0)).astype(np.float32)


def prepare_embeddings(spark: SparkSession, cfg: EmbConfig) -> str:
    """Builds the table of embeddings and returns its folder; a complete one is kept."""
    folder, raw = Folder(spark, cfg.output_dir), Folder(spark, cfg.raw_dir)
    if not decide(folder, EMB_MARKER, cfg.overwrite):
        log.info("%s is complete", folder.path)
        return folder.path
    build = dict(granularity=cfg.granularity, pretrained=cfg.pretrained, pretrained_dir=cfg.pretrained_dir, **cfg.model_kwargs)
    model = create_model(cfg.model_name, **build)  # fails here rather than in the tasks
    if cfg.sr < model.front.rate:
        log.warning("segments have %d Hz, the model takes %d Hz", cfg.sr, model.front.rate)
    classes = len(raw.read_json(LABELS))
    df = read_table(spark, raw.path)
    mode = label_mode(df.schema)
    frame = cfg.granularity == "frame"
    longest = model.frame_count(cfg.seg_sec) if frame else 0
    kept = ["split", "entry_idx", "audio_path", "audio_id", "segment_id", "start", "end", "valid_sec"]
    vector = "array<array<float>>" if frame else "array<float>"
    label = df.schema["label"].dataType.simpleString() if mode != "strong" else vector
    ddl = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in kept) + f", embedding {vector}, label {label}"
    if frame:
        ddl += ", geometry array<array<float>>, valid_mask array<boolean>"
    schema = T.StructType.fromDDL(ddl)
    name, rate = cfg.model_name, cfg.sr
    mono = not isinstance(df.schema["raw"].dataType.elementType, T.ArrayType)
    loaded: dict = {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if "model" not in loaded:
            loaded["model"] = create_model(name, **build)
        for b in batches:
            if not b.num_rows:
                continue
            raw, valid = b.column("raw"), b.column("valid_sec").to_numpy(zero_copy_only=False).astype(np.float32)
            flat = raw
            while pa.types.is_list(flat.type) or pa.types.is_large_list(flat.type):
                flat = flat.flatten()
            wave = flat.to_numpy(zero_copy_only=False).astype(np.float32)
            wave = wave.reshape(b.num_rows, -1) if mono else wave.reshape(b.num_rows, len(raw[0]), -1)
            out = loaded["model"].embed(wave, rate, valid)
            cols = {c: b.column(c) for c in kept}
            if frame:
                pad = lambda x: np.concatenate([x, np.zeros((len(x), longest - x.shape[1], *x.shape[2:]), x.dtype)], 1)
                out = {k: pad(v) for k, v in out.items()}
                cols |= {"geometry": list_array(out["geometry"]), "valid_mask": list_array(out["valid_mask"])}
                spans = out["geometry"]
            else:
                spans = np.broadcast_to(np.array([[[-np.inf, np.inf]]], np.float32), (b.num_rows, 1, 2))
            cols["embedding"] = list_array(out["embedding"].astype(np.float32))
            cols["label"] = b.column("label")
            if mode == "strong":
                states = np.stack([state_matrix(s, e, classes) for s, e in zip(spans, cols["label"].to_pylist())])
                cols["label"] = list_array(states if frame else states[:, 0])
            yield pa.RecordBatch.from_arrays([cols[f.name].cast(f.type) for f in arrow], schema=arrow)

    arrow = to_arrow_schema(schema)
    with batches_of(spark, cfg.batch_size):
        df.select(*kept, "raw", "label").sortWithinPartitions("valid_sec").mapInArrow(run, schema).write.partitionBy("split").parquet(f"{folder.path}/{ROWS}")
    raw.copy(LABELS, folder)
    folder.write_json(EMB_MARKER, cfg.sidecar())
    return folder.path
