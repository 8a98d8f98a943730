"""Tables with versions: a version is whole or not there, one of two writers at once wins, and gates decide on what was written.

Rows go to a folder of their own first. A version exists once its manifest, a small file named by its number, does; the manifest
is written aside and renamed to its name, which fails if another writer took the number. So a reader of the newest manifest never
sees a part, and a writer that lost finds out. This holds on every Hadoop file system whose rename refuses a target that exists.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from textflow.sources.shared import hadoop_path, qualified


class Conflict(Exception):
    """Another writer made the version first."""


class Refused(Exception):
    """A gate didn't hold; metrics has what was measured."""

    def __init__(self, failed: list[str], metrics: dict):
        super().__init__(f"gates that don't hold: {', '.join(failed)}; measured: {metrics}")
        self.failed, self.metrics = failed, metrics


@dataclass(frozen=True)
class Version:
    number: int
    folder: str
    metrics: dict


def _manifests(spark: SparkSession, path: str) -> dict[int, str]:
    system, place = hadoop_path(spark, f"{path}/_versions")
    if not system.exists(place):
        return {}
    names = [x.getPath().getName() for x in system.listStatus(place)]
    return {int(n[:-5]): f"{path}/_versions/{n}" for n in names if n.endswith(".json") and n[:-5].isdigit()}


def _read(spark: SparkSession, path: str) -> str:
    system, place = hadoop_path(spark, path)
    stream = system.open(place)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def _create(spark: SparkSession, path: str, content: str) -> bool:
    """Whether the file could be created whole, under a name that wasn't there."""
    system, aside = hadoop_path(spark, f"{path}.{uuid.uuid4().hex}.tmp")
    stream = system.create(aside, False)
    stream.write(bytearray(content.encode()))
    stream.close()
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(system.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    options = gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
    try:
        context.rename(aside, hadoop_path(spark, path)[1], options)
        return True
    except Py4JJavaError as e:
        system.delete(aside, False)
        if "FileAlreadyExists" in e.java_exception.getClass().getName():
            return False
        raise


def newest(spark: SparkSession, path: str, at: int | None = None) -> Version | None:
    """The newest version, or version `at`; None if there is none."""
    found = _manifests(spark, path)
    number = max(found, default=None) if at is None else at if at in found else None
    if number is None:
        return None
    told = json.loads(_read(spark, found[number]))
    return Version(number, f"{path}/{told['folder']}", told["metrics"])


def read(spark: SparkSession, path: str, at: int | None = None) -> DataFrame | None:
    """The rows of the newest version, or of version `at`; None if there is none."""
    version = newest(spark, path, at)
    return version and spark.read.parquet(version.folder)


def commit(df: DataFrame, path: str, base: int | None = -1, metrics: dict[str, Column] | None = None, gates: dict[str, str] | None = None) -> Version:
    """Writes df as the next version of path and returns it.

    base: the number of the version that df was made from (None: there was none; -1: whatever is newest when the commit
    begins); if there is a newer one by then, Conflict is raised and nothing changes. metrics: aggregates of df, taken while it is
    written, in one pass, and kept with the version. gates: conditions on the metrics in SQL; if one isn't true, Refused is
    raised and the rows are deleted: they never were visible."""
    spark = df.sparkSession
    path = qualified(spark, path)
    before = newest(spark, path)
    number = before.number if before else None
    if base not in (-1, number):
        raise Conflict(f"version {number} is newer than {base}")
    folder = f"data/{uuid.uuid4().hex}"
    told = {}
    if metrics:
        seen = Observation()
        df.observe(seen, *(c.alias(n) for n, c in metrics.items())).write.parquet(f"{path}/{folder}")
        told = dict(seen.get)
    else:
        df.write.parquet(f"{path}/{folder}")
    failed = _failing(spark, told, gates or {})
    if not failed:
        next_ = 0 if number is None else number + 1
        if _create(spark, f"{path}/_versions/{next_:08d}.json", json.dumps({"folder": folder, "metrics": told}, default=str)):
            return Version(next_, f"{path}/{folder}", told)
    system, place = hadoop_path(spark, f"{path}/{folder}")
    system.delete(place, True)
    if failed:
        raise Refused(failed, told)
    raise Conflict(f"another writer made the version after {number}")


def _failing(spark: SparkSession, told: dict, gates: dict[str, str]) -> list[str]:
    if not gates:
        return []
    row = spark.range(1).select(*(F.lit(v).alias(n) for n, v in told.items()))
    held = row.select(*(F.coalesce(F.expr(c), F.lit(False)).alias(n) for n, c in gates.items())).first()
    return [n for n in gates if not held[n]]


def prune(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Removes all versions but the newest `keep`, manifests first, and folders that no version names; for when no writer and no
    reader of old versions is at work."""
    found = _manifests(spark, path)
    for number in sorted(found)[:-keep]:
        hadoop_path(spark, path)[0].delete(hadoop_path(spark, found.pop(number))[1], False)
    used = {json.loads(_read(spark, name))["folder"].rpartition("/")[2] for name in found.values()}
    system, place = hadoop_path(spark, f"{path}/data")
    for x in system.listStatus(place) if system.exists(place) else ():
        if x.getPath().getName() not in used:
            system.delete(x.getPath(), True)
