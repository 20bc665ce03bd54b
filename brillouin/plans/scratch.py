"""Tables that cut lineage, in the folder that the whole cluster sees."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_dir(spark: SparkSession) -> str:
    """A new folder under spark.checkpoint.dir. Where that is unset, a local session gets a temporary one; a cluster has to set it."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="spark-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/scratch-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """`df` written as a table in the shared folder and read back: survives lost executors."""
    spark = df.sparkSession
    path = scratch_dir(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
