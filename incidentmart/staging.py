"""Scratch tables in the shared folder of the session."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables.

    ``spark.checkpoint.dir`` of the session, or the checkpoint folder of its
    context; where neither is set, a folder in the session's warehouse.  On a
    cluster a warehouse in a local folder is refused: other machines do not see
    what one writes there.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return folder.rstrip("/") if folder else warehouse_scratch(spark.conf.get("spark.sql.warehouse.dir"), spark.sparkContext.master)


def warehouse_scratch(warehouse: str, master: str) -> str:
    if not master.startswith("local") and warehouse.startswith(("/", "file:")):
        raise ValueError(f"spark.checkpoint.dir is not set and the warehouse {warehouse} is a local folder; set spark.checkpoint.dir to a shared one")
    return f"{warehouse.rstrip('/')}/_scratch"


def new_scratch(spark: SparkSession, label: str) -> str:
    return f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage (a lost executor costs a re-read of files) and fixes what
    a recomputation could decide differently, such as row ids and ranges.
    """
    path = new_scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder through Hadoop's file system, so any store works."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
