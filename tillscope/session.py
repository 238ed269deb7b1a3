"""Session helpers.

On a cluster the session comes from the cluster's own configuration and nothing
here overrides it; ``local_session`` is for tests and the benchmark.
"""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(
    cores: int | str = "*",
    shuffle_partitions: int = 8,
    memory: str = "8g",
    conf: dict[str, str] | None = None,
) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tillscope")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
    )
    for name, value in (conf or {}).items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``.

    Where it is unset, a local folder is made once per session, but only for a
    master whose driver and executors are one process.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        shared = tempfile.mkdtemp(prefix="tillscope-shared-")
        atexit.register(shutil.rmtree, shared, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", shared)
    return shared.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df`` as a table in the shared folder, computed once; lineage ends there."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Sets the folder for ``checkpoint()`` where none is set yet."""
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    shared = shared_folder(spark)
    spark.sparkContext.setCheckpointDir(shared)
    return shared
