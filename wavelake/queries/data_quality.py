"""Queries of the general data-processing operators: rejected lines, merged intervals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wavelake.operators.intervals import merge_intervals, periods_and_gaps, whole_ms
from wavelake.operators.rejects import load_lines, rejects, valid_rows
from wavelake.session import table

#: Longest stretch between two periods that counts as a gap.
MAX_GAP_MS = 1_200_000


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """One row per rejected line of raw_lines and reason."""
    return rejects(load_lines(table(spark, d, "raw_lines"), table(spark, d, "label_index")))


def p5_valid(spark: SparkSession, d: str) -> DataFrame:
    """The lines of raw_lines that load, typed; labels as one text."""
    rows = valid_rows(load_lines(table(spark, d, "raw_lines"), table(spark, d, "label_index")))
    return rows.withColumn("labels", F.array_join("labels", ","))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """Continuous periods of two or more intervals, and the gaps of at most MAX_GAP_MS between periods.

    Both tables go through one merge, as one keyed set of intervals.
    """
    ev = table(spark, d, "strong_events").select(
        F.lit(1).cast("tinyint").alias("t"), F.col("audio_path").alias("entity"), F.col("class_name").alias("label"), whole_ms(F.col("start")).alias("s"), whole_ms(F.col("end")).alias("e")
    )
    au = table(spark, d, "audioset_train_strong").select(
        F.lit(2).cast("tinyint").alias("t"), F.col("segment_id").alias("entity"), "label", whole_ms(F.col("start_time_seconds")).alias("s"), whole_ms(F.col("end_time_seconds")).alias("e")
    )
    keys = ["t", "entity", "label"]
    out = periods_and_gaps(merge_intervals(ev.unionByName(au), keys, "s", "e"), keys, MAX_GAP_MS)
    name = F.when(F.col("t") == 1, "strong_events").otherwise("audioset_train_strong")
    return out.select(name.alias("table_name"), "entity", "label", "kind", "from_ms", "to_ms")


QUERIES = {"p5_found": p5_found, "p5_valid": p5_valid, "p6_found": p6_found}

_ISLANDS = """
WITH raw AS (
  SELECT 'strong_events' AS table_name, audio_path AS entity, class_name AS label, start AS a, "end" AS b FROM strong_events
  UNION ALL
  SELECT 'audioset_train_strong', segment_id, label, start_time_seconds, end_time_seconds FROM audioset_train_strong
), iv AS (
  SELECT DISTINCT table_name, entity, label, CAST(round_even(a * 1000, 0) AS BIGINT) AS s, CAST(round_even(b * 1000, 0) AS BIGINT) AS e
  FROM raw WHERE isfinite(a) AND isfinite(b)
), ordered AS (
  SELECT *, max(e) OVER (PARTITION BY table_name, entity, label ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m
  FROM iv WHERE s < e
), numbered AS (
  SELECT *, sum(CASE WHEN m >= s THEN 0 ELSE 1 END) OVER (PARTITION BY table_name, entity, label ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS island FROM ordered
), periods AS (
  SELECT table_name, entity, label, island, min(s) AS from_ms, max(e) AS to_ms, count(*) AS n FROM numbered GROUP BY ALL
), led AS (
  SELECT *, lead(from_ms) OVER (PARTITION BY table_name, entity, label ORDER BY from_ms) AS next_ms FROM periods
)
SELECT table_name, entity, label, 'period' AS kind, from_ms, to_ms FROM led WHERE n >= 2
UNION ALL
SELECT table_name, entity, label, 'gap', to_ms, next_ms FROM led WHERE next_ms - to_ms <= 1200000
"""

# The reject reasons by regular expressions over one line at a time.
_FIELD = '(?:"(?:[^"]|"")*"|[^"{d}]*)'
_PARSE = """
WITH lines AS (
  SELECT line_id, line_no, file_name, coalesce(line, '') AS line,
         CASE WHEN file_name = 'dev.csv' THEN regexp_full_match(coalesce(line, ''), '{f1}(?:,{f1})*')
              ELSE regexp_full_match(coalesce(line, ''), '{f2}(?:\t{f2})*') END AS quoted_well
  FROM raw_lines
), cut AS (
  SELECT *, CASE WHEN NOT quoted_well THEN NULL
    WHEN file_name = 'dev.csv' THEN regexp_extract_all(',' || line, ',({f1})', 1)
    ELSE regexp_extract_all('\t' || line, '\t({f2})', 1) END AS f0
  FROM lines
), fields AS (
  SELECT *, len(f0) AS n, list_transform(f0, lambda x: CASE WHEN x LIKE '"%' THEN replace(x[2:-2], '""', '"') ELSE x END) AS f FROM cut
), judged AS (
  SELECT line_id, line_no, file_name, f,
    CASE WHEN NOT quoted_well THEN ['quoting']
         WHEN n <> CASE WHEN file_name = 'dev.csv' THEN 3 ELSE 4 END THEN ['column_count']
         WHEN file_name = 'dev.csv' THEN list_filter([
           CASE WHEN NOT regexp_full_match(f[1], '[0-9]+') THEN 'fname_value' END,
           CASE WHEN NOT list_has_all((SELECT list(class_name) FROM label_index), string_split(f[2], ',')) THEN 'labels_value' END,
           CASE WHEN f[3] NOT IN ('train', 'val') THEN 'split_value' END], lambda x: x IS NOT NULL)
         ELSE list_filter([
           CASE WHEN regexp_full_match(f[2], '(?:[0-9]+(?:[.][0-9]*)?|[.][0-9]+)(?:[eE][+-]?[0-9]+)?')
                 AND regexp_full_match(f[3], '(?:[0-9]+(?:[.][0-9]*)?|[.][0-9]+)(?:[eE][+-]?[0-9]+)?')
                 AND coalesce(try_cast(f[2] AS DOUBLE) < try_cast(f[3] AS DOUBLE) AND isfinite(try_cast(f[3] AS DOUBLE)), false) THEN NULL ELSE 'time_value' END,
           CASE WHEN f[4] NOT IN (SELECT mid FROM label_index) THEN 'label_value' END], lambda x: x IS NOT NULL) END AS reasons
  FROM fields
)
""".format(f1=_FIELD.format(d=","), f2=_FIELD.format(d="\t"))

SQL = {
    "p5_found": _PARSE + "SELECT line_id, unnest(reasons) AS reason FROM judged",
    "p5_valid": _PARSE
    + """SELECT line_id, file_name, line_no, CASE WHEN file_name = 'dev.csv' THEN f[1] END AS fname, CASE WHEN file_name = 'dev.csv' THEN f[2] END AS labels,
       CASE WHEN file_name = 'dev.csv' THEN f[3] END AS split, CASE WHEN file_name <> 'dev.csv' THEN f[1] END AS segment_id,
       CASE WHEN file_name <> 'dev.csv' THEN CAST(f[2] AS DOUBLE) END AS start_time_seconds, CASE WHEN file_name <> 'dev.csv' THEN CAST(f[3] AS DOUBLE) END AS end_time_seconds,
       CASE WHEN file_name <> 'dev.csv' THEN f[4] END AS label
FROM judged WHERE len(reasons) = 0""",
    "p6_found": _ISLANDS,
}
