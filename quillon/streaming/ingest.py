"""Streams of dump records: entity lines as they arrive, each entity once, and running link counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.operators.nested import parse_entity_lines
from quillon.schemas import PAGE


def stream_pages(spark: SparkSession, path: str, late: str = "30 days") -> DataFrame:
    """Page records from Parquet files as they appear, each id once within the watermark."""
    schema = PAGE + ", revised_at timestamp_ntz, loaded_at timestamp_ntz"
    pages = spark.readStream.schema(schema).parquet(path).withColumn("loaded_at", F.col("loaded_at").cast("timestamp"))
    return pages.withWatermark("loaded_at", late).dropDuplicatesWithinWatermark(["id"])


def stream_entities(spark: SparkSession, path: str) -> DataFrame:
    """Entities from text files of dump lines as they appear."""
    return parse_entity_lines(spark.readStream.text(path), "value")


def running_link_counts(pages: DataFrame) -> DataFrame:
    """``(title, n)``: links to each title so far; for complete or update output."""
    return pages.select(F.explode("links.title").alias("title")).where("title is not null").groupBy("title").agg(F.count("*").alias("n"))
