"""Where intermediate tables are kept: in the folder that the cluster shares."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; one of our own only on a local master, as in tests."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if named is None:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
        named = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """df, computed once and kept there, its lineage cut."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def settled(df: DataFrame) -> DataFrame:
    """df, computed once and kept there as files, so that its size is known. A checkpoint carries the planner's estimate along, and a loop that joins
    a table with itself squares that each round: after twenty rounds it is a number of millions of digits, and planning takes all the time."""
    df.write.parquet(path := f"{shared_folder(df.sparkSession)}/kept-{uuid.uuid4().hex}")
    return df.sparkSession.read.schema(df.schema).parquet(path)
