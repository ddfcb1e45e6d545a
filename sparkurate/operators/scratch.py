"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def work_folder(spark: SparkSession, label: str) -> str:
    """A new folder in the one that spark.checkpoint.dir names; a temporary one on a single machine where it is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = "file://" + tempfile.gettempdir()
    return f"{base.rstrip('/')}/sparkurate/{label}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, label: str = "step") -> DataFrame:
    """df as a written table, which cuts the lineage and survives lost executors."""
    path = work_folder(df.sparkSession, label)
    schema = df.schema
    df.write.parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)
