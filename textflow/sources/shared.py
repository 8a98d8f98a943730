"""The folder that driver and executors share, and tables that cut lineage there."""

from __future__ import annotations

import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL: dict[str, str] = {}


def hadoop_path(spark: SparkSession, folder: str):
    """(file system, path) of a folder, as Spark itself resolves it."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def qualified(spark: SparkSession, folder: str) -> str:
    """A folder with its scheme, that of the default file system if it names none; file:/a as file:///a."""
    system, path = hadoop_path(spark, folder)
    uri = system.makeQualified(path).toString().rstrip("/")
    scheme, _, rest = uri.partition(":")
    return uri if rest.startswith("//") else f"{scheme}://{rest}"


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir, as a URI; where it is unset, in local mode only, one temporary folder a session."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return qualified(spark, named)
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    key = spark.sparkContext.applicationId
    if key not in _LOCAL:
        _LOCAL[key] = Path(tempfile.mkdtemp(prefix="textflow-")).as_uri()
    return _LOCAL[key]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/textflow/{uuid.uuid4().hex}/{name}"


def cut(df: DataFrame, name: str = "cut") -> DataFrame:
    """df written once as Parquet in the shared folder and read again: later actions, and retries after a lost
    executor, start from the files."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, *tables: DataFrame) -> None:
    """Delete the files of tables made by cut() that nothing reads any more."""
    for table in tables:
        for name in {f.rpartition("/")[0] for f in table.inputFiles()}:
            system, path = hadoop_path(spark, name)
            system.delete(path, True)


def small_side(df: DataFrame, limit: int) -> DataFrame:
    """df with a broadcast hint if it has no more than `limit` rows (counted), else as it is, for a shuffled join."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df
