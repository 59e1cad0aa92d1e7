"""Session settings, table access and lineage cuts shared by all operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Settings used where the caller has no session of its own.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", partitions: int = 8, memory: str = "4g") -> SparkSession:
    """A local session for tests and benches; on a cluster the submitter's session is used."""
    b = SparkSession.builder.master(f"local[{cores}]").config("spark.sql.shuffle.partitions", str(partitions))
    b = b.config("spark.driver.memory", memory)
    for k, v in DEFAULTS.items():
        b = b.config(k, v)
    return b.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table: a Parquet file or a folder of them."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir. Where it is unset, a local session takes a temporary one; elsewhere that is an error."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    current = sc._jsc.sc().getCheckpointDir()
    if not current.isDefined():
        if not named and not is_local(sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="wavelake-"))
        current = sc._jsc.sc().getCheckpointDir()
    return named or current.get()


def is_local(master: str) -> bool:
    """Whether driver and tasks are one process on one machine."""
    return master == "local" or master.startswith("local[")


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    Cuts the lineage, survives the loss of executors, and fixes the rows of whatever is
    read more than once. Parquet instead of ``checkpoint()``: compressed and column-pruned on reading.
    """
    path = f"{shared_dir(df.sparkSession).rstrip('/')}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
