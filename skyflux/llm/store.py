"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


#: Paths of the tables that this process has written and not deleted, in order.
MADE: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder. Where none is configured, a local folder in local mode (tests), and an error on a cluster, whose machines wouldn't share it."""
    known = spark.conf.get("spark.checkpoint.dir", None)
    if known:
        return known.rstrip("/")
    at = spark.sparkContext._jsc.sc().getCheckpointDir()
    if at.isDefined():
        return at.get().rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
    made = f"file://{tempfile.gettempdir()}/checkpoints/skyflux"
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def written(df: DataFrame, label: str) -> DataFrame:
    """Writes df as a Parquet table in the shared folder and reads it back, which cuts its lineage:
    an executor that is lost later costs a reread, not a recomputation."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/skyflux-{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    MADE.append(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._skyflux_path = path
    return back


def _delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    if path in MADE:
        MADE.remove(path)


def dropped(df: DataFrame) -> None:
    """Deletes a table made by written() once nothing reads it any more."""
    path = getattr(df, "_skyflux_path", None)
    if path:
        _delete(df.sparkSession, path)


def drop_all_but(kept: DataFrame, since: int) -> None:
    """Deletes the tables written since MADE had so many, except kept: kept no longer reads them once it is written itself."""
    for path in MADE[since:]:
        if path != kept._skyflux_path:
            _delete(kept.sparkSession, path)
