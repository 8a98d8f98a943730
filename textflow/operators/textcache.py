"""Lookups by text in a cache that is laid out for them: bucketed by a digest of the text, so that it is never shuffled.

The cache is a bucketed table, one row for each text. Items are dealt out by the digest of their text into as many parts, and each
part reads its bucket. A text that many items have would burden its part: such texts are counted, looked up once each, and
reach their items by broadcast; there are few of them, since each has a share of all items. Digests have 128 bits and texts are
compared as well, so a collision only costs a comparison.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textflow.operators.lookup import latest

#: A text is frequent with more than 1 / PARTS of all items, and at least LEAST of them.
PARTS, LEAST = 200, 1000


def digest(c: Column) -> Column:
    """128 bits of a text; null for null."""
    return F.unhex(F.md5(F.encode(c, "UTF-8")))


def save(cache: DataFrame, table: str, buckets: int) -> None:
    """Writes the latest() rows of cache (source, target, and seq if there) as a table of `buckets` buckets by digest. Of an existing
    table everything is replaced."""
    rows = latest(cache.where("source is not null")).select(digest(F.col("source")).alias("digest"), "source", "target")
    rows.repartition(buckets, "digest").write.mode("overwrite").format("parquet").bucketBy(buckets, "digest").sortBy("digest").saveAsTable(table)


def bucket_count(spark: SparkSession, table: str) -> int:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Num Buckets'").collect()
    if not rows:
        raise ValueError(f"{table} isn't bucketed")
    return int(rows[0].data_type)


def looked_up(items: DataFrame, table: str, key: str = "source", parts: int = PARTS, least: int = LEAST) -> DataFrame:
    """items with target and hit from the table that save() wrote. A null text has none. Repeated items each have a row; columns of
    items named target, hit or like the helpers here are replaced."""
    spark = items.sparkSession
    buckets = bucket_count(spark, table)
    cache = spark.table(table).select(F.col("digest").alias("__digest"), F.col("source").alias("__source"), F.col("target").alias("__target"))
    rows = items.drop("target", "hit").withColumn("__digest", digest(F.col(key)))
    counts = rows.where("__digest is not null").groupBy("__digest").agg(F.count("*").alias("__n"))  # combined before the shuffle
    limit = max(least, items.count() // parts)
    hot = counts.where(F.col("__n") > limit).select("__digest")
    hot_rows = cache.join(F.broadcast(hot), "__digest", "left_semi")  # fewer than `parts` texts, and digests that collide with them
    hot_keys = F.broadcast(hot.select("__digest", F.lit(True).alias("__hot")))
    marked = rows.join(hot_keys, "__digest", "left")
    names = [c for c in rows.columns if c != "__digest"]
    # texts are compared as a pair of bounds: an equality would become a join key, which the buckets don't have
    same = lambda a, b: (a["__digest"] == b["__digest"]) & (a[key] <= b["__source"]) & (a[key] >= b["__source"])
    few, rest = marked.where("__hot"), marked.where("__hot is null").repartition(buckets, "__digest")
    few = few.join(F.broadcast(hot_rows), same(few, hot_rows), "left").select(*names, "__target")
    rest = rest.join(cache.hint("shuffle_merge"), same(rest, cache), "left").select(*names, "__target")
    return few.unionByName(rest).withColumnRenamed("__target", "target").withColumn("hit", F.col("target").isNotNull())


def missed(items: DataFrame, table: str, key: str = "source") -> DataFrame:
    """The items that the table has no target for."""
    return looked_up(items, table, key).where("not hit").drop("target", "hit")
