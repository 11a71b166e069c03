"""Writers: tables, partitions, rejects, single JSON objects."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str, by: list[str] | None = None, sort: list[str] | None = None, max_records: int = 0) -> None:
    """Replace a Parquet table; ``by`` partitions it, ``sort`` orders rows within files so that their statistics prune."""
    out = df.sortWithinPartitions(*sort) if sort else df
    w = out.write.mode("overwrite")
    if max_records:
        w = w.option("maxRecordsPerFile", max_records)
    (w.partitionBy(*by) if by else w).parquet(path)


def write_annotated(df: DataFrame, path: str) -> None:
    """Annotated pages as line-JSON, those without sentences left out."""
    df.where(F.size("sentences") > 0).write.mode("overwrite").json(path)


def write_rejects(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("sep", "\t").csv(path)


def write_json_object(pairs: DataFrame, path: str, key: str = "k", value: str = "v", limit: int = 1_000_000) -> None:
    """A small mapping as one JSON object in one file; larger ones belong in a table and are refused."""
    n = pairs.count()
    if n > limit:
        raise ValueError(f"{n} entries are too many for a single object; write a table")
    whole = pairs.agg(F.array_sort(F.collect_list(F.struct(F.col(key), F.col(value)))).alias("e"))
    whole.select(F.to_json(F.map_from_entries("e")).alias("value")).coalesce(1).write.mode("overwrite").text(path)
