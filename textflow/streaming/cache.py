"""Keyed caches kept by a stream, the last value of each key: as keyed state with a log of changes (follow, current), or, for small
ones, as a whole new version for each micro-batch (keyed_cache, lookup)."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.types import BooleanType, StructField, StructType

from textflow.operators.lookup import last_wins
from textflow.sources.shared import hadoop_path


def versions(spark: SparkSession, path: str) -> list[int]:
    """The versions that were written in full, ascending."""
    system, place = hadoop_path(spark, path)
    if not system.exists(place):
        return []
    found = [str(x.getPath().getName()) for x in system.listStatus(place)]
    whole = [int(x.partition("=")[2]) for x in found if x.startswith("version=")]
    return sorted(v for v in whole if system.exists(hadoop_path(spark, f"{path}/version={v}/_SUCCESS")[1]))


def latest(spark: SparkSession, path: str, before: int | None = None) -> DataFrame | None:
    """The newest version, or the newest under `before`; None if there is none."""
    some = [v for v in versions(spark, path) if before is None or v < before]
    return spark.read.parquet(f"{path}/version={some[-1]}") if some else None


def keyed_cache(stream: DataFrame, path: str, checkpoint: str, keys: list[str], seq: str, keep: int = 2):
    """Each micro-batch is merged over the version before it (the row with the largest seq wins) and written as a version of
    its own; a replayed batch writes the same version again. Versions but the last `keep` are removed."""

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        old = latest(spark, path, batch_id)
        rows = batch if old is None else old.select(*batch.columns).unionByName(batch)
        last_wins(rows, keys, seq).select(*batch.columns).write.mode("overwrite").parquet(f"{path}/version={batch_id}")
        for version in versions(spark, path)[:-keep]:
            system, place = hadoop_path(spark, f"{path}/version={version}")
            system.delete(place, True)

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def lookup(items: DataFrame, path: str, keys: list[str]) -> DataFrame:
    """items with the cached columns of their keys, null where there are none; items without any if no version exists."""
    cache = latest(items.sparkSession, path)
    return items if cache is None else items.join(cache.withColumn("cached", F.lit(True)), keys, "left")


#: The state store that keeps keyed state on disk and uploads only what a batch changed.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Latest(StatefulProcessor):
    """Keeps the row with the largest seq of each key (of equal ones the first that came) and tells each change; with expire, a key
    is forgotten, and told as expired, when the watermark passes its last row's time by so many milliseconds."""

    def __init__(self, schema: StructType, seq: str, ts: str | None, expire: int | None):
        self.schema, self.seq, self.ts, self.expire = schema, seq, ts, expire

    def init(self, handle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", self.schema)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        names = self.schema.names
        old = Row(*names)(*self.last.get()) if self.last.exists() else None
        new = old
        for row in rows:
            if row[self.seq] is not None and (new is None or row[self.seq] > new[self.seq]):
                new = Row(*names)(*(row[c] for c in names))
        if new is not old:
            self.last.update(tuple(new))
            if self.expire is not None:
                for timer in list(self.handle.listTimers()):
                    self.handle.deleteTimer(timer)
                self.handle.registerTimer(int(new[self.ts].timestamp() * 1000) + self.expire)
            yield Row(*names, "expired")(*new, False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.last.exists():
            names = self.schema.names
            old = self.last.get()
            self.last.clear()
            yield Row(*names, "expired")(*old, True)

    def close(self) -> None:
        pass


def changes(stream: DataFrame, keys: list[str], seq: str, ts: str | None = None, expire: int | None = None, late: str = "0 seconds") -> DataFrame:
    """A stream of rows -> the stream of changes of a keyed cache: the columns and expired. State is one row for each key, in the
    state store; a batch touches its own keys only. expire: milliseconds after ts, by the watermark, that is `late` behind."""
    session = stream.sparkSession
    session.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    rows = stream if expire is None else stream.withWatermark(ts, late)
    out = StructType([*stream.schema.fields, StructField("expired", BooleanType())])
    return rows.groupBy(*keys).transformWithState(Latest(stream.schema, seq, ts, expire), out, "update", "none" if expire is None else "eventTime")


def follow(stream: DataFrame, path: str, checkpoint: str, keys: list[str], seq: str, ts: str | None = None, expire: int | None = None, late: str = "0 seconds"):
    """Starts a query that writes the changes() of each micro-batch as a version of its own, and nothing else; a replayed batch
    starts from the state before it and writes the same version again."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/version={batch_id}")

    told = changes(stream, keys, seq, ts, expire, late)
    return told.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current(spark: SparkSession, path: str, keys: list[str], before: int | None = None) -> DataFrame | None:
    """The cache as of the newest version (or the newest under `before`): each key's last change, if that isn't its expiry; None if
    there is no version. Only versions that were written in full count."""
    some = [v for v in versions(spark, path) if before is None or v < before]
    if not some:
        return None
    rows = spark.read.option("basePath", path).parquet(*(f"{path}/version={v}" for v in some))
    rest = [c for c in rows.columns if c not in keys and c != "version"]
    # a batch may tell a key's new row and its expiry: rows are forgotten when the watermark moves, after the batch's own rows
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct("version", "expired")).alias("row"))
    return last.select(*keys, "row.*").where("not expired").drop("expired")


def compact(spark: SparkSession, path: str, keys: list[str]) -> None:
    """Merges the versions before the newest into the last of them; for between runs of follow(), with no reader at work. What is
    merged is written aside first; stopped at any point, no change is lost: the merged rows repeat what older versions said."""
    some = versions(spark, path)[:-1]
    if len(some) < 2:
        return
    system, place = hadoop_path(spark, f"{path}/merged")
    current(spark, path, keys, before=some[-1] + 1).withColumn("expired", F.lit(False)).write.mode("overwrite").parquet(f"{path}/merged")
    _, last = hadoop_path(spark, f"{path}/version={some[-1]}")
    system.rename(last, hadoop_path(spark, f"{path}/before")[1])
    system.rename(place, last)
    for name in ["before", *(f"version={v}" for v in reversed(some[:-1]))]:
        system.delete(hadoop_path(spark, f"{path}/{name}")[1], True)
