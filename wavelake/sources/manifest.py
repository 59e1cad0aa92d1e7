"""Split manifests: reading, checking, writing."""

from __future__ import annotations

import json
import math
import os
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wavelake.operators.interval_join import interval_join
from wavelake.operators.splits import SPLITS
from wavelake.session import cut

_ENTRY = "array<struct<audio_path:string,start:string,end:string>>"
ENTRY_SCHEMA = "split string, entry_idx int, audio_path string, start double, end double"


def read_manifest(spark: SparkSession, path: str, check: bool = True) -> DataFrame:
    """``split, entry_idx, audio_path, start, end`` of a manifest; the text "inf" is an infinite end.

    With ``check``: a missing split, a path that comes twice in a split, an interval that does not last, and intervals of one path
    that overlap across splits without being equal are errors.
    """
    # One document is one task, so it is parsed once and kept as a table.
    raw = cut(spark.read.option("multiLine", "true").schema(", ".join(f"{s} {_ENTRY}" for s in SPLITS)).json(path))
    row = raw.select(*(F.col(s).isNull().alias(s) for s in SPLITS)).first()
    missing = [s for s in SPLITS if row is None or row[s]]
    if missing:
        raise ValueError(f"the manifest is missing split {missing[0]}")
    parts = [raw.select(F.lit(s).alias("split"), F.posexplode(s).alias("entry_idx", "e")) for s in SPLITS]
    df = parts[0].unionByName(parts[1]).unionByName(parts[2])
    df = df.select("split", "entry_idx", "e.audio_path", F.col("e.start").cast("double").alias("start"), F.col("e.end").cast("double").alias("end"))
    if check:
        check_entries(df)
    return df


def broken_entries(df: DataFrame) -> DataFrame:
    """Entries whose start is not below their end, or unknown."""
    return df.where(~F.coalesce((F.col("start") < F.col("end")) & ~F.isnan("start") & ~F.isnan("end"), F.lit(False)))


def repeated_paths(df: DataFrame) -> DataFrame:
    """``split, audio_path, n``: paths that a split holds more than once."""
    return df.groupBy("split", "audio_path").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def check_entries(df: DataFrame) -> None:
    """Raises on the first kind of broken entry found."""
    bad = broken_entries(df).limit(1).collect()
    if bad:
        raise ValueError(f"start is not below end: {bad[0].asDict()}")
    twice = repeated_paths(df).limit(1).collect()
    if twice:
        raise ValueError(f"{twice[0]['audio_path']} is in {twice[0]['split']} more than once")
    clash = cross_split_overlaps(df).limit(1).collect()
    if clash:
        raise ValueError(f"intervals of {clash[0]['audio_path']} overlap across splits")


def cross_split_overlaps(df: DataFrame, far: float = 1e14, bucket: float = 600.0) -> DataFrame:
    """Pairs of entries of one path in different splits that overlap and are not the same interval; an infinite end is ``far``."""
    side = lambda x: df.select("audio_path", *(F.col(c).alias(f"{c}_{x}") for c in ("split", "start")), F.least("end", F.lit(far)).alias(f"end_{x}"))
    m = interval_join(side("a"), side("b"), ["audio_path"], ("start_a", "end_a"), ("start_b", "end_b"), bucket)
    return m.where("split_a < split_b and not (start_a = start_b and end_a = end_b)")


def entry_path(path: Column) -> Column:
    """A manifest's path: forward slashes, none at the front."""
    return F.regexp_replace(F.regexp_replace(path, r"\\", "/"), "^/+", "")


def entry(audio_path: str, start: float = 0.0, end: float = math.inf) -> dict:
    return {"audio_path": audio_path.replace(os.sep, "/").lstrip("/"), "start": float(start), "end": float(end)}


def write_manifest(splits: dict[str, list[dict]], path: str) -> None:
    """Writes the three splits; an infinite end becomes the text "inf". The file appears whole or not at all."""
    for s in SPLITS:
        if s not in splits:
            raise AssertionError(f"split {s} is missing")
    out = {}
    for s in SPLITS:
        out[s] = []
        for e in splits[s]:
            if set(e) != {"audio_path", "start", "end"} or not e["start"] < e["end"]:
                raise AssertionError(f"broken entry {e}")
            out[s].append({**e, "end": "inf" if math.isinf(e["end"]) else e["end"]})
    os.makedirs(os.path.dirname(os.path.abspath(path)), exist_ok=True)
    fd, tmp = tempfile.mkstemp(dir=os.path.dirname(os.path.abspath(path)), suffix=".tmp")
    try:
        with os.fdopen(fd, "w", encoding="utf-8") as f:
            json.dump(out, f, indent=2, ensure_ascii=False)
        os.replace(tmp, path)
    except BaseException:
        os.unlink(tmp)
        raise


def to_manifest(df: DataFrame, path: str, most: int = 10_000_000) -> None:
    """Writes entries (split, audio_path, start, end) as a manifest in order of audio_path; at most ``most`` entries."""
    rows = df.select("split", "audio_path", "start", "end").orderBy("split", "audio_path").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} entries; keep the manifest as a table")
    splits: dict[str, list[dict]] = {s: [] for s in SPLITS}
    for r in rows:
        splits[r["split"]].append(entry(r["audio_path"], r["start"], r["end"]))
    write_manifest(splits, path)


def shared_paths(df: DataFrame) -> DataFrame:
    """``split_a, split_b, n_shared``: paths that two splits share, and of each split its paths (split_a = split_b). Null paths do not count."""
    sets = df.where(F.col("audio_path").isNotNull()).groupBy("audio_path").agg(F.array_sort(F.collect_set("split")).alias("s"))  # at most the three splits
    pair = sets.select(F.explode("s").alias("split_a"), "s").select("split_a", F.explode("s").alias("split_b")).where(F.col("split_a") <= F.col("split_b"))
    return pair.groupBy("split_a", "split_b").agg(F.count(F.lit(1)).alias("n_shared"))


def verify(df: DataFrame) -> dict:
    """Counts per split, and how many paths the splits share."""
    n = {(r["split_a"], r["split_b"]): int(r["n_shared"]) for r in shared_paths(df.where(F.col("split").isin(*SPLITS))).collect()}
    shared = lambda a, b: n.get((min(a, b), max(a, b)), 0)
    paths = {s: shared(s, s) for s in SPLITS}
    both = {"train_validation": shared("train", "validation"), "train_test": shared("train", "test"), "validation_test": shared("validation", "test")}
    return {"paths": paths, **both, "validation_is_test": paths["validation"] == paths["test"] == both["validation_test"]}
