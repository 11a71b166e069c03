"""Readers of the dump formats."""

from __future__ import annotations

import bz2
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from quillon.functions import wikitext
from quillon.functions.text import is_disambiguation
from quillon.operators.nested import parse_entity_lines
from quillon.schemas import LANGLINK, PAGE, PARSED_PAGE, RAW_PAGE

# Fixed value: files of a site's dump.
DUMP_FILES = (
    "-latest-pages-articles-multistream-index.txt.bz2", "-latest-pages-articles-multistream.xml.bz2", "-latest-page.sql.gz",
    "-latest-langlinks.sql.gz", "-latest-site_stats.sql.gz", "-latest-image.sql.gz", "-latest-imagelinks.sql.gz",
)


def dump_urls(sites: DataFrame, base: str, label: str) -> DataFrame:
    """``(site, url, file)`` of each dump file of each site; nothing is downloaded.

    The address always asks for the latest dump, only the file name carries the label.
    """
    suffix = F.explode(F.array(*[F.lit(x) for x in DUMP_FILES])).alias("suffix")
    return sites.select("site", suffix).select(
        "site", F.concat(F.lit(base.rstrip("/") + "/"), "site", F.lit("/latest/"), "site", "suffix").alias("url"),
        F.concat("site", F.replace("suffix", F.lit("latest"), F.lit(label))).alias("file"),
    )


# ---- pages -------------------------------------------------------------------------------------


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """``(offset, page_id, title)`` of a multistream index (text, any compression)."""
    line = spark.read.text(path)
    parts = lambda n: F.regexp_extract("value", r"^(\d+):(\d+):(.*)$", n)
    return line.select(parts(1).cast("bigint").alias("offset"), parts(2).alias("page_id"), parts(3).alias("title")).where("offset is not null")


def plan_chunks(index: DataFrame, every: int = 100) -> DataFrame:
    """``(beg, end)``: byte ranges of every ``every`` distinct streams, the last one open (-1).

    Distinct offsets are few (one a hundred pages), so one ordered window is enough.
    """
    w = Window.orderBy("offset")
    starts = index.select("offset").distinct().withColumn("n", F.row_number().over(w) - 1).where(F.col("n") % every == 0)
    return starts.select(F.col("offset").alias("beg"), F.lead("offset", 1, -1).over(w).alias("end"))


def chunks_of(spec: str) -> list[tuple[int, int]]:
    """Ranges of an explicit ``a:b[:c…]`` list of offsets."""
    at = sorted(int(x) for x in spec.split(":"))
    return list(zip(at, at[1:]))


def _opened(path: str):
    """A seekable file: a local path, or a URI of any file system Arrow knows (file, hdfs, s3, gs, abfs)."""
    if "://" not in path:
        return open(path, "rb")
    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri(path)
    return system.open_input_file(inner)


class _Chunk(InputPartition):
    def __init__(self, beg: int, end: int):
        self.beg, self.end = beg, end


class _ChunkReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.ranges = options["path"], options["ranges"]

    def partitions(self) -> list[InputPartition]:
        return [_Chunk(*map(int, r.split("-", 1)) if not r.endswith("-") else (int(r[:-1]), -1)) for r in self.ranges.split(",")]

    def read(self, partition: _Chunk) -> Iterator[tuple]:
        from xml.etree import ElementTree

        with _opened(self.path) as f:
            f.seek(partition.beg)
            raw = f.read() if partition.end < 0 else f.read(partition.end - partition.beg)
        text, rest = [], raw
        while rest:
            d = bz2.BZ2Decompressor()
            text.append(d.decompress(rest))
            rest = d.unused_data
        body = b"".join(text).decode("utf-8")
        if partition.end < 0 and (tail := body.rfind("</mediawiki>")) >= 0:
            body = body[:tail]
        parser = ElementTree.XMLPullParser(["end"])
        parser.feed("<chunk>")
        parser.feed(body)
        parser.feed("</chunk>")
        for _, node in parser.read_events():
            if node.tag == "page":
                redirect = node.find("redirect")
                yield (
                    node.findtext("id"), node.findtext("title"), node.findtext("ns"), None if redirect is None else redirect.get("title"),
                    node.findtext("revision/text") or "",
                )
                node.clear()


class MultistreamPages(DataSource):
    """Pages of a multistream bz2 file by byte ranges: options ``path`` and ``ranges`` (``a-b,b-c,c-``).

    The path, or URI, must be readable on every executor.
    """

    @classmethod
    def name(cls) -> str:
        return "multistream_pages"

    def schema(self) -> str:
        return RAW_PAGE

    def reader(self, schema) -> DataSourceReader:
        return _ChunkReader(self.options)


def read_multistream(spark: SparkSession, path: str, ranges: list[tuple[int, int]]) -> DataFrame:
    spark.dataSource.register(MultistreamPages)
    text = ",".join(f"{a}-{b if b >= 0 else ''}" for a, b in ranges)
    return spark.read.format("multistream_pages").option("path", path).option("ranges", text).load()


def read_pages_xml(spark: SparkSession, path: str) -> DataFrame:
    """Pages of an XML dump (plain or compressed) through the built-in XML reader."""
    schema = "id string, title string, ns string, redirect struct<_title:string>, revision struct<text:struct<_VALUE:string>>"
    raw = spark.read.format("xml").option("rowTag", "page").option("ignoreSurroundingSpaces", False).schema(schema).load(path)
    return raw.select(F.trim("id").alias("id"), "title", F.trim("ns").alias("ns"), F.col("redirect._title").alias("redirect"), F.coalesce("revision.text._VALUE", F.lit("")).alias("markup"))


def parse_pages(raw: DataFrame) -> DataFrame:
    """Full page records of raw ones; a page that cannot be parsed keeps its row, with ``error``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ("article", "infobox", "categories", "sections", "links", "external_links")
        for pdf in batches:
            rows = []
            for markup in pdf["markup"]:
                try:
                    found, error = wikitext.parse_page(markup), None
                except Exception as e:  # noqa: BLE001
                    found, error = dict.fromkeys(names), repr(e)
                s, k, x = found["sections"] or [], found["links"] or [], found["external_links"] or []
                rows.append((
                    found["article"], found["infobox"], found["categories"], [dict(zip(("text", "start_pos", "end_pos", "title", "level"), a)) for a in s],
                    [dict(zip(("text", "start_pos", "end_pos", "title"), a)) for a in k], [dict(zip(("text", "start_pos", "end_pos", "url"), a)) for a in x], error,
                ))
            out = pd.DataFrame(rows, columns=[*names, "error"])
            for c in ("id", "title", "redirect", "disambiguation"):
                out[c] = pdf[c].to_numpy()
            yield out[["id", "title", "redirect", "disambiguation", *names[:1], "infobox", "categories", "sections", "links", "external_links", "error"]]

    rows = raw.select("id", "title", "redirect", is_disambiguation("markup", "redirect").alias("disambiguation"), "markup")
    return rows.mapInPandas(run, PARSED_PAGE)


# ---- other dumps -------------------------------------------------------------------------------


def read_entities(spark: SparkSession, path: str) -> DataFrame:
    """Entities of a line-JSON dump (brackets, trailing commas and broken lines are passed over)."""
    return parse_entity_lines(spark.read.text(path), "value").withColumn("properties", F.coalesce(F.map_keys("claims"), F.array().cast("array<string>")))


def read_langlinks(spark: SparkSession, path: str) -> DataFrame:
    """``(ll_from, ll_lang, ll_title)`` of the INSERT tuples of a MySQL dump; empty titles have no row.

    The file is cut at tuple borders, so a single INSERT line of any length is many rows.
    """
    tuples = spark.read.option("lineSep", "),(").text(path)
    body = F.regexp_replace("value", r"(?s)^.*VALUES \(", "")
    part = lambda n: F.regexp_extract(body, r"^(\d+),'(\S+?)','(.+?)'(?:\);?\s*(?s:.*))?$", n)
    # The compressed file is one split: spread what comes out of it.
    return tuples.select(part(1).alias("ll_from"), part(2).alias("ll_lang"), part(3).alias("ll_title")).where("ll_from <> ''").repartition(spark.sparkContext.defaultParallelism)


def read_blocks(spark: SparkSession, path: str, schema: str = PAGE) -> DataFrame:
    """Line-JSON block files with the file's name as ``_chunk_id``."""
    return spark.read.schema(schema).json(path).withColumn("_chunk_id", F.col("_metadata.file_name"))


def read_json_map(spark: SparkSession, path: str, many: bool = False) -> DataFrame:
    """``(k, v)`` or ``(k, pos, v)`` of a file holding a single JSON object."""
    value = "array<string>" if many else "string"
    pairs = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", f"map<string,{value}>")).alias("k", "v"))
    return pairs.select("k", F.posexplode("v").alias("pos", "v")) if many else pairs


def langlink_schema() -> str:
    return LANGLINK
