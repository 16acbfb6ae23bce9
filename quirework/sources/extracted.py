"""What tools outside Spark have extracted from editions: page blocks, outlines, page maps, file information, page texts.

Each reader declares its schema, so Spark reads the fields that a query asks for and no others; files are read in parallel
from whatever store Spark reaches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirework.functions import text as T

_BLOCK = "array<struct<id:string,number:int,bbox:array<double>,text:string,clean_text:string>>"
_RAW = f"""work_id string, page_count int, metadata map<string,string>,
    toc array<struct<index:int,level:int,title:string,page:int>>,
    pages array<struct<pdf_page:int,width:double,height:double,text:string,blocks:{_BLOCK}>>"""


def raw_works(spark: SparkSession, path: str) -> DataFrame:
    """One row for each extracted work (a JSON document of one or more lines)."""
    return spark.read.schema(_RAW).option("multiLine", True).json(path)


def blocks(works: DataFrame) -> DataFrame:
    """(work_id, pdf_page, width, height, block_id, number, x0, y0, x1, y1, text) of every block, in reading order.

    A block without an id gets one from its work, page and number; without a cleaned text, its own is cleaned.
    """
    page = works.select("work_id", F.explode("pages").alias("p")).select("work_id", "p.pdf_page", "p.width", "p.height", F.posexplode("p.blocks").alias("_at", "b"))
    number = F.coalesce("b.number", F.col("_at") + 1)
    box = [F.get("b.bbox", F.lit(k)).alias(c) for k, c in enumerate(("x0", "y0", "x1", "y1"))]
    own = T.block_id(F.col("work_id"), F.col("pdf_page"), number)
    return page.select(
        "work_id", "pdf_page", "width", "height", F.coalesce("b.id", own).alias("block_id"), number.alias("number"), *box,
        F.coalesce("b.clean_text", T.clean_extracted(F.col("b.text"))).alias("text"),
    )


def outline(works: DataFrame) -> DataFrame:
    """(work_id, index, level, title, page, key) of every entry of a work's outline, from 1."""
    entry = works.select("work_id", F.posexplode("toc").alias("_at", "e"))
    title = T.clean_extracted(F.col("e.title"))
    return entry.select("work_id", F.coalesce("e.index", F.col("_at") + 1).alias("index"), "e.level", title.alias("title"), "e.page", T.match_key(F.col("e.title")).alias("key"))


def page_entries(spark: SparkSession, path: str) -> DataFrame:
    """(id, page, physical_page) of the passages in a typesetter's metadata (an array of ``{"value": {kind, id, page, …}}``).

    The same passage may stand there several times; its first page counts. Other metadata is left out.
    """
    schema = "value struct<kind:string,id:string,page:int,physical_page:int>"
    found = spark.read.schema(schema).option("multiLine", True).json(path).select("value.*")
    kept = found.where((F.col("kind") == "passage") & (F.coalesce("id", F.lit("")) != "") & F.col("page").isNotNull())
    return kept.groupBy("id").agg(F.min(F.struct("page", "physical_page")).alias("p")).select("id", "p.page", F.coalesce("p.physical_page", "p.page").alias("physical_page"))


def file_info(spark: SparkSession, path: str) -> DataFrame:
    """(path, info): the ``key: value`` lines that a file inspector prints, as a map for each file; the first of equal keys counts."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("path"), F.monotonically_increasing_id().alias("_at"), "value").where(F.contains("value", F.lit(":")))
    pair = lines.select("path", "_at", F.trim(F.substring_index("value", ":", 1)).alias("k"), F.trim(F.regexp_extract("value", "^[^:]*:(.*)$", 1)).alias("v"))
    first = pair.groupBy("path", "k").agg(F.min_by("v", "_at").alias("v"))
    return first.groupBy("path").agg(F.map_from_entries(F.collect_list(F.struct("k", "v"))).alias("info"))


def page_texts(spark: SparkSession, path: str) -> DataFrame:
    """(path, page, text) of files of extracted text, in which a form feed ends each page; what follows the last one counts
    as a page if it has any words."""
    read = spark.read.text(path, lineSep="\f").select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("_split"), F.monotonically_increasing_id().alias("_id"), "value")
    return _numbered(read).where(~F.col("_last") | (T.strip(F.col("value")) != "")).select("path", "page", F.col("value").alias("text"))


def _numbered(read: DataFrame) -> DataFrame:
    from pyspark.sql import Window

    splits = read.groupBy("path", "_split").agg(F.count("*").alias("_n"), F.min("_id").alias("_first"))
    by = Window.partitionBy("path").orderBy("_split")
    before = F.coalesce(F.sum("_n").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = splits.withColumns({"_ahead": before, "_all": F.sum("_n").over(Window.partitionBy("path"))})
    page = F.col("_ahead") + F.col("_id") - F.col("_first") + 1
    return read.join(placed, ["path", "_split"]).withColumns({"page": page, "_last": page == F.col("_all")})


def as_documents(spark: SparkSession, given: str | list[str] | DataFrame, id_col: str = "id", text_col: str = "text") -> DataFrame:
    """(id, text) of what an extraction is given: a table, a list of texts, or one text; a URL of any store that Spark reads
    gives its files, one document each. Texts get their place in the list as id."""
    if isinstance(given, DataFrame):
        return given.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    if isinstance(given, str) and "://" in given and not any(c.isspace() for c in given):
        return spark.read.text(given, wholetext=True).select(F.col("_metadata.file_path").alias("id"), F.col("value").alias("text"))
    listed = [given] if isinstance(given, str) else given
    return spark.createDataFrame([(str(k), t) for k, t in enumerate(listed)], "id string, text string")
