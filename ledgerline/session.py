"""Session and table helpers shared by the operators."""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table, read lazily so that filters and columns reach the scan."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def local_session(cores: str = "8", shuffle: int = 8) -> SparkSession:
    """A session for tests and benches; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("ledgerline")
        .config("spark.sql.shuffle.partitions", str(shuffle))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; where that is unset, one of our own, in local mode only."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder and not re.match(r"local($|\[)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return folder or _own_folder()


@lru_cache(1)
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="ledgerline-")


def own_place(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, which is removed when the driver ends."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written once to the shared folder and read back: what is made of it later makes it no more, and lost executors lose nothing."""
    path = own_place(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
