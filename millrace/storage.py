"""Shared storage: tables that are written once and read again, which cuts lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share (spark.checkpoint.dir); one of our own only where it is unset in a local session."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.conf.get("spark.master", "local")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        path = getattr(shared_dir, "own", None)
        if path is None:
            path = shared_dir.own = "file://" + tempfile.mkdtemp(prefix="millrace-")
    return path.rstrip("/")


def new_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_dir(spark)}/millrace-{tag}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Writes df to shared storage and reads it back: lineage is cut and a lost executor costs nothing."""
    path = new_path(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
