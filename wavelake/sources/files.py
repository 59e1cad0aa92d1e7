"""Listings of files as DataFrames, and readers of the delivered table formats."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def list_files(spark: SparkSession, root: str, folder: str = "", pattern: str = "*", recursive: bool = False) -> DataFrame:
    """``audio_path``: files of ``root/folder`` relative to ``root``, in no order.

    Only names are read, never contents. Folders of archive debris (``__MACOSX``) and ``.DS_Store`` are left out.
    """
    base = root.rstrip("/")
    r = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", str(recursive).lower())
    marker = f"{base}/".split("://", 1)[-1].lstrip("/")
    rel = F.element_at(F.split("path", F.lit("\\Q" + marker + "\\E"), 2), 2)
    got = r.load(f"{base}/{folder}" if folder else base).select(rel.alias("audio_path"))
    return got.where(~F.col("audio_path").rlike(r"(^|/)(__MACOSX/|\.DS_Store$)"))


def list_wavs(spark: SparkSession, root: str, folder: str, recursive: bool = False, any_case: bool = False) -> DataFrame:
    return list_files(spark, root, folder, "*.[wW][aA][vV]" if any_case else "*.wav", recursive)


def list_parts(spark: SparkSession, root: str, prefix: str, suffix: str) -> DataFrame:
    """Wave files of all folders of ``root`` that begin and end so."""
    marker = root.rstrip("/").split("://", 1)[-1].lstrip("/") + "/"
    rel = F.element_at(F.split("path", F.lit("\\Q" + marker + "\\E"), 2), 2)
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.wav").load(f"{root.rstrip('/')}/{prefix}*{suffix}").select(rel.alias("audio_path"))


def read_table(spark: SparkSession, path: str | list[str], sep: str = ",", columns: list[str] | None = None, comment: str | None = None, header: bool = True) -> DataFrame:
    """A delimited table with every column as a string, so that ids keep their spelling; cast what is a number.

    With ``columns`` the file has no header and they name its columns. Blanks after a separator do not count.
    """
    r = spark.read.option("sep", sep).option("header", str(header and columns is None).lower()).option("ignoreLeadingWhiteSpace", "true").option("escape", '"')
    if comment:
        r = r.option("comment", comment)
    if columns is not None:
        r = r.schema(", ".join(f"`{c}` string" for c in columns))
    return r.csv(path)


def read_vocabulary(spark: SparkSession, path: str, column: int = 1) -> DataFrame:
    """``class_name``: one column of a table without header."""
    return spark.read.option("header", "false").csv(path).select(F.col(f"_c{column}").alias("class_name"))


def read_manifest_lines(spark: SparkSession, path: str) -> DataFrame:
    """``audio_path, position``: the first field of every line that has a tab (the first line names a folder and has none)."""
    t = spark.read.text(path).withColumn("position", F.monotonically_increasing_id())
    return t.where(F.instr("value", "\t") > 0).select(F.split("value", "\t")[0].alias("audio_path"), "position")


def first_column(spark: SparkSession, path: str, expected: str, sep: str) -> DataFrame:
    """Different values of the first column by first appearance; a header that does not name it so is an error."""
    t = read_table(spark, path, sep)
    if not t.columns or t.columns[0] != expected:
        raise ValueError(f"{path}: the first column is {t.columns[:1]}, not {expected}")
    return t.select(F.col(f"`{expected}`")).withColumn("position", F.monotonically_increasing_id()).groupBy(expected).agg(F.min("position").alias("position"))


def existing(entries: DataFrame, files: DataFrame) -> DataFrame:
    """The entries whose audio_path is among the files."""
    return entries.join(files.select("audio_path"), "audio_path", "left_semi")


def count_by_folder(entries: DataFrame, depth: int = 2) -> DataFrame:
    """``folder, n``: entries by the part of their path at ``depth`` (from 0)."""
    return entries.groupBy(F.get(F.split("audio_path", "/"), depth).alias("folder")).agg(F.count(F.lit(1)).alias("n"))
