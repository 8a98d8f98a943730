"""Readers. Where identity or the last-wins rule depends on position, the position is a column from the start."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textflow import schemas
from textflow.sources import json_arrays


def json_array(spark: SparkSession, path: str, schema: str, index: str = "idx") -> DataFrame:
    """Objects of a JSON array document, with their position; a large document is read by several tasks, a broken one is an error."""
    row = F.from_json("text", f"struct<{_colons(schema)}>", {"mode": "FAILFAST"})
    return json_arrays.elements(spark, path).select(F.col("number").cast("int").alias(index), row.alias("row")).select(index, "row.*")


def _colons(schema: str) -> str:
    out, depth, start, parts = [], 0, 0, []
    for i, c in enumerate(schema):
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            parts.append(schema[start:i])
            start = i + 1
    for part in [*parts, schema[start:]]:
        name, kind = part.strip().split(" ", 1)
        out.append(f"{name}: {kind}")
    return ", ".join(out)


def groups(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """Evaluation groups with group_idx from 0. strict: raise if a group has no positive or no negative candidate."""
    out = json_array(spark, path, schemas.GROUP, "group_idx")
    if strict:
        bad = out.where("coalesce(size(positive), 0) <= 0 or coalesce(size(negative), 0) <= 0").limit(1).count()
        if bad:
            raise ValueError("a group has no positive or no negative candidate")
    return out


def jsonl(spark: SparkSession, path: str, schema: str, seq: str = "seq") -> DataFrame:
    """JSON lines (blank lines are skipped) with a sequence column: a struct that orders rows by file name, then by their place
    in the file, however Spark packs and splits the files."""
    lines = spark.read.text(path).select("value", "_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("line"))
    place = F.struct(F.col("file_path").alias("file"), F.col("file_block_start").alias("start"), "line")
    return lines.where("trim(value) <> ''").select(place.alias(seq), F.from_json("value", schema).alias("row")).select(seq, "row.*")


def cache(spark: SparkSession, path: str, form: str = "jsonl") -> DataFrame:
    """(source, target), last line wins, lines without either are ignored. form: jsonl (with key aliases) or object."""
    if form == "object":
        whole = spark.read.text(path, wholetext=True)
        return whole.select(F.explode(F.from_json("value", "map<string, string>")).alias("source", "target")).where("trim(target) <> ''")
    rows = jsonl(spark, path, schemas.CACHE_LINE).select("seq", F.coalesce("source_idn", "idn").alias("source"), F.coalesce("msa_raw", "msa").alias("target"))
    rows = rows.where("source is not null and trim(coalesce(target, '')) <> ''")
    return rows.groupBy("source").agg(F.max_by("target", "seq").alias("target"))


def faq(spark: SparkSession, path: str) -> DataFrame:
    """FAQ rows keyed by question, last wins; raise if one has no variants."""
    rows = json_array(spark, path, schemas.FAQ)
    last = rows.groupBy("Question").agg(F.max_by(F.struct(*[c for c in rows.columns if c != "Question"]), "idx").alias("row")).select("Question", "row.*")
    if last.where("coalesce(size(Question_cluster), 0) <= 0").limit(1).count():
        raise ValueError("a question has no variants")
    return last


def dialogues(spark: SparkSession, path: str) -> DataFrame:
    return json_array(spark, path, schemas.DIALOGUE)


def reports(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Partial evaluation reports, with their ordinal in the list."""
    parts = [spark.read.schema(schemas.REPORT).option("multiLine", True).json(p).withColumn("ordinal", F.lit(i)) for i, p in enumerate(paths)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def word_list(path: str) -> list[str]:
    """Words of a text file, without blanks and # comments (a rule file, read on the driver)."""
    lines = (x.strip() for x in Path(path).read_text(encoding="utf-8").splitlines())
    return [x for x in lines if x and not x.startswith("#")]


def settings(path: str) -> dict:
    """A YAML file of rules or settings (read on the driver), such as those of triage and of skipped turns; empty if it is."""
    import yaml

    return yaml.safe_load(Path(path).read_text(encoding="utf-8")) or {}


def skip_list(path: str) -> tuple[list[str], list[str]]:
    """Exact entries and patterns of turns that aren't translated: exact_skip and pattern_skip of a YAML file."""
    data = settings(path)
    return [str(x).strip() for x in data.get("exact_skip") or [] if str(x).strip()], [str(x) for x in data.get("pattern_skip") or []]


def vectors(spark: SparkSession, path: str, run: str | None = None) -> DataFrame:
    """A score or vector cache, Parquet partitioned by run; `run` prunes the partitions."""
    df = spark.read.parquet(path)
    return df if run is None else df.where(F.col("run") == run)


def matrix(spark: SparkSession, path: str) -> DataFrame:
    """Rows of NumPy files (.npy, up to two dimensions; no pickles) as file, row, values: a file is read by one task, 1,000 rows
    at a time."""

    def run(batches):
        import io

        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                data = np.atleast_2d(np.load(io.BytesIO(content), allow_pickle=False))
                for i in range(0, len(data), 1000):
                    rows = data[i : i + 1000].astype(float)
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(rows)), pa.array(np.arange(i, i + len(rows))), pa.array(rows.tolist(), pa.list_(pa.float64()))], ["file", "row", "values"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, "file string, row long, values array<double>")


def rows_between(df: DataFrame, index: str, start: int = 0, most: int | None = None) -> DataFrame:
    """Offset and limit on a materialised index, not on row order."""
    return df.where(F.col(index) >= start) if most is None else df.where((F.col(index) >= start) & (F.col(index) < start + most))
