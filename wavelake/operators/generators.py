"""Default split manifests of the known datasets, as entries (split, audio_path)."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wavelake.operators.splits import copy_missing, fold_split, greedy_split, mapped_split, stratified_split_shuffled
from wavelake.sources import annotations as an
from wavelake.sources import manifest as mf
from wavelake.sources.files import existing, first_column, list_parts, list_wavs, read_manifest_lines, read_table
from wavelake.sources.wav import durations

GENERATORS: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register_generator(name: str, f: Callable[[SparkSession, str], DataFrame]) -> None:
    GENERATORS[name] = f


def generator(*names: str):
    def add(f):
        for n in names:
            register_generator(n, f)
        return f

    return add


def _named(paths: DataFrame, split: str) -> DataFrame:
    return paths.select(F.lit(split).alias("split"), "audio_path")


def _folds(table: str, prefix, folds: dict[int, str], name: str):
    def make(spark: SparkSession, root: str) -> DataFrame:
        t = read_table(spark, f"{root}/{table}").where(F.col(name) != ".DS_Store")
        fold = F.col("fold").cast("double").cast("int")
        rows = t.select(fold_split(fold, folds).alias("split"), prefix(fold, F.col(name)).alias("audio_path"))
        return existing(rows, list_wavs(spark, root, "audio", recursive=True)).select("split", "audio_path")

    return make


register_generator("ESC-50", _folds("meta/esc50.csv", lambda fold, n: F.concat(F.lit("audio/"), n), {1: "train", 2: "train", 3: "train", 4: "validation", 5: "test"}, "filename"))
register_generator("UrbanSound8K", _folds("metadata/UrbanSound8K.csv", lambda fold, n: F.concat(F.lit("audio/fold"), fold, F.lit("/"), n), {k: "train" for k in range(1, 9)} | {9: "validation", 10: "test"}, "slice_file_name"))


@generator("FSD50K")
def fsd50k(spark: SparkSession, root: str, longest: float = 30.0) -> DataFrame:
    dev = read_table(spark, f"{root}/FSD50K.ground_truth/dev.csv")
    split = F.coalesce(mapped_split(F.col("split"), {"train": "train", "val": "validation"}), F.raise_error(F.concat(F.lit("unknown split value: "), F.coalesce("split", F.lit("null")))))
    rows = dev.select(split.alias("split"), F.concat(F.lit("FSD50K.dev_audio/"), "fname", F.lit(".wav")).alias("audio_path"))
    ev = read_table(spark, f"{root}/FSD50K.ground_truth/eval.csv").select(F.lit("test").alias("split"), F.concat(F.lit("FSD50K.eval_audio/"), "fname", F.lit(".wav")).alias("audio_path"))
    disk = list_wavs(spark, root, "FSD50K.dev_audio").unionByName(list_wavs(spark, root, "FSD50K.eval_audio"))
    have = existing(rows.unionByName(ev), disk)
    return up_to(have.join(durations(have, root), "audio_path"), longest).select("split", "audio_path")


def up_to(timed: DataFrame, longest: float) -> DataFrame:
    """The recordings whose ``duration`` is not over ``longest``."""
    return timed.where(F.col("duration") <= longest)


@generator("FSDnoisy18k")
def fsdnoisy18k(spark: SparkSession, root: str) -> DataFrame:
    parts = []
    for x in ("train", "test"):
        t = read_table(spark, f"{root}/FSDnoisy18k.meta/{x}.csv").select(F.concat(F.lit(f"FSDnoisy18k.audio_{x}/"), "fname").alias("audio_path"))
        parts.append(_named(existing(t, list_wavs(spark, root, f"FSDnoisy18k.audio_{x}")), x))
    return copy_missing(parts[0].unionByName(parts[1]))


def _bsd(table: str):
    def make(spark: SparkSession, root: str) -> DataFrame:
        t = read_table(spark, f"{root}/metadata/{table}").select(F.concat(F.lit("audio/"), "sound_id", F.lit(".wav")).alias("audio_path"), F.col("class").alias("label"))
        return stratified_split_shuffled(existing(t.select("audio_path", "label"), list_wavs(spark, root, "audio")), "audio_path", "label").select("split", "audio_path")

    return make


for _name, _table in an.BSD_TABLES.items():
    register_generator(_name, _bsd(_table))


@generator("SONYC-UST")
def sonyc_ust(spark: SparkSession, root: str) -> DataFrame:
    t = read_table(spark, f"{root}/annotations.csv")
    rows = t.select(mapped_split(F.col("split"), {"train": "train", "validate": "validation", "test": "test"}).alias("split"), F.concat(F.lit("audio/"), "audio_filename").alias("audio_path"))
    return existing(rows.where(F.col("split").isNotNull()).distinct(), list_wavs(spark, root, "audio")).select("split", "audio_path")


@generator("DESED")
def desed(spark: SparkSession, root: str) -> DataFrame:
    parts = []
    for split, (path, folder) in an.DESED_PARTS.items():
        names = first_column(spark, f"{root}/{path}", "filename", "\t").select(F.concat(F.lit(f"{folder}/"), "filename").alias("audio_path"))
        parts.append(_named(existing(names, list_wavs(spark, root, folder)), split))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@generator("RealDESED")
def realdesed(spark: SparkSession, root: str) -> DataFrame:
    out = None
    for split in ("train", "validation", "test"):
        names = first_column(spark, f"{root}/{split}/annotations.csv", "filename", ",").select(F.concat(F.lit(f"{split}/audio/"), "filename").alias("audio_path"))
        part = _named(existing(names, list_wavs(spark, root, f"{split}/audio")), split)
        out = part if out is None else out.unionByName(part)
    return out


@generator("AudioSetStrong")
def audioset_strong(spark: SparkSession, root: str) -> DataFrame:
    return copy_missing(_named(list_wavs(spark, root, "audio/train"), "train").unionByName(_named(list_wavs(spark, root, "audio/eval"), "test")))


@generator("AudioSetWeak")
def audioset_weak(spark: SparkSession, root: str) -> DataFrame:
    """The parts of the unbalanced set are found by their names."""
    train = list_wavs(spark, root, "balanced_train_segments").unionByName(list_parts(spark, root, "unbalanced_train_segments_part", "_partial"))
    return copy_missing(_named(train, "train").unionByName(_named(list_wavs(spark, root, "eval_segments"), "test")))


@generator("BirdVox-14SD")
def birdvox(spark: SparkSession, root: str) -> DataFrame:
    a = an.load_annotation(spark, "BirdVox-14SD", root)
    return stratified_split_shuffled(a.weak.select("audio_path", F.get("classes", 0).alias("label")), "audio_path", "label").select("split", "audio_path")


@generator("DB3V")
def db3v(spark: SparkSession, root: str) -> DataFrame:
    a = an.load_annotation(spark, "DB3V", root)
    return stratified_split_shuffled(a.weak.select("audio_path", F.get("classes", 0).alias("label")), "audio_path", "label").select("split", "audio_path")


@generator("DCASE-2024-Task-5")
def dcase_fewshot(spark: SparkSession, root: str) -> DataFrame:
    out = None
    for part, split in (("Training_Set", "train"), ("Validation_Set", "validation")):
        w = list_wavs(spark, root, f"Development_Set/{part}", recursive=True, any_case=True)
        w = _named(w.where(F.split("audio_path", "/")[2].isin(*an.FEWSHOT_SITES[part])), split)
        out = w if out is None else out.unionByName(w)
    return copy_missing(out)


@generator("HyenaSET")
def hyenaset(spark: SparkSession, root: str) -> DataFrame:
    disk = list_wavs(spark, root, "wav", recursive=True, any_case=True)
    out = None
    for name, split in (("train_0_specific_indiv.tsv", "train"), ("valid_0_specific_indiv.tsv", "validation")):
        t = read_manifest_lines(spark, f"{root}/manifests/{name}").select(F.concat(F.lit("wav/"), F.regexp_replace("audio_path", "^wav/", "")).alias("audio_path"))
        p = _named(existing(t, disk), split)
        out = p if out is None else out.unionByName(p)
    return copy_missing(out)


@generator("DataSED")
def datased(spark: SparkSession, root: str) -> DataFrame:
    w = list_wavs(spark, root, "SED_wav")
    sets = an.datased_truth(spark, root).groupBy(F.concat(F.lit("SED_wav/"), "sound_name").alias("audio_path")).agg(F.collect_set("class_name").alias("classes"))
    files = w.join(sets, "audio_path", "left").join(durations(w, root), "audio_path")
    return greedy_split(files, "audio_path", "classes", "duration").select("split", "audio_path")


def generate(spark: SparkSession, name: str, root: str, path: str) -> dict:
    """Makes, writes and checks a dataset's default manifest; returns the check's summary."""
    if name not in GENERATORS:
        raise KeyError(f"no split generator for {name}; known: {', '.join(sorted(GENERATORS))}")
    e = GENERATORS[name](spark, root)
    mf.to_manifest(e.withColumns({"start": F.lit(0.0), "end": F.lit(float("inf"))}), path)
    summary = mf.verify(mf.read_manifest(spark, path))
    print(json.dumps(summary))
    return summary
