"""Readers and writers: JSON lines (strict and tolerant), manuscripts, page markup, rule tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StringType, StructType

from quirework.operators.sequence import body_lines, section_paths, segments


def read_jsonl(spark: SparkSession, path: str, schema: StructType, strict: bool = True) -> DataFrame:
    """Rows of JSON lines with a given schema. Strict: a bad line fails the query. Else it stays in ``_corrupt_record``."""
    if strict:
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    kept = StructType([*schema.fields, StructField("_corrupt_record", StringType())])
    return spark.read.schema(kept).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").json(path)


def read_json(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Whole-file JSON documents."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_flat_config(spark: SparkSession, path: str) -> DataFrame:
    """(key, value) of ``key: value`` lines; indented lines and comments are skipped."""
    lines = spark.read.text(path).where(~F.col("value").rlike("^\\s") & F.contains("value", F.lit(":")) & ~F.col("value").startswith("#"))
    return lines.select(F.trim(F.substring_index("value", ":", 1)).alias("key"), F.trim(F.regexp_extract("value", "^[^:]*:(.*)$", 1)).alias("value"))


def read_partitioned(spark: SparkSession, pattern: str, schema: StructType, name: str) -> DataFrame:
    """JSON lines below ``.../<value>/file`` with the folder's name as column ``name``."""
    return spark.read.schema(schema).json(pattern).withColumn(name, F.regexp_extract(F.col("_metadata.file_path"), "([^/]+)/[^/]+$", 1))


def text_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, line_no, line) of each line, from 1."""
    return docs.where(F.col(text).isNotNull()).select(key, F.posexplode(F.split(text, "\n")).alias("line_no", "line")).withColumn("line_no", (F.col("line_no") + 1).cast("long"))


def manuscript_passages(lines: DataFrame, key: str = "work_id") -> DataFrame:
    """(key, segment_id, text) of a manuscript's lines: front matter off, each passage under its directive."""
    return segments(body_lines(lines, key, "line_no", "line"), key, "line_no", "line", '^::passage\\{id="([^"]+)"\\}')


def page_blocks(pages: DataFrame, tags: tuple[str, ...] = ("h1", "h2", "h3", "p", "li")) -> DataFrame:
    """(page_id, block_no, tag, text) of the text blocks of page markup, in order; nested tags are taken out."""
    names = "|".join(tags)
    whole = F.regexp_extract_all("html", F.lit(f"(?is)<((?:{names})\\b[^>]*>.*?)</(?:{names})>"), 1)
    block = pages.where("html is not null").select("page_id", F.posexplode(whole).alias("block_no", "b"))
    text = F.trim(F.regexp_replace(F.regexp_replace(F.regexp_extract("b", "(?s)^[^>]*>(.*)$", 1), "<[^>]*>", " "), "\\s+", " "))
    return block.select("page_id", F.col("block_no").cast("long").alias("block_no"), F.lower(F.regexp_extract("b", "^(\\w+)", 1)).alias("tag"), text.alias("text"))


def write_jsonl(rows: DataFrame, path: str) -> None:
    """JSON lines with keys in alphabetical order and nulls kept; an existing path is an error."""
    rows.select(*sorted(rows.columns)).write.option("ignoreNullFields", "false").json(path)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether anything is at a path (a glob), in whatever store holds it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place)
    return found is not None and len(found) > 0


def read_jsonl_or_empty(spark: SparkSession, path: str, schema: StructType, strict: bool = True) -> DataFrame:
    """As ``read_jsonl``; a path without a file gives no rows."""
    if exists(spark, path):
        return read_jsonl(spark, path, schema, strict)
    kept = schema if strict else StructType([*schema.fields, StructField("_corrupt_record", StringType())])
    return spark.createDataFrame([], kept)


def read_jsonl_with_errors(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """(line_no, row, error) of every line that is not blank: ``row`` as the schema says, or null with an error.

    A missing file is one error of line 0. Lines are numbered within their file, which is read as one text: meant for the
    files of a work, not for those of a lake.
    """
    if not exists(spark, path):
        return spark.createDataFrame([(0, None, f"missing file: {path}")], StructType.fromDDL("line_no long, row " + schema.simpleString() + ", error string"))
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", "\r?\n")).alias("line_no", "line")).where(F.trim("line") != "")
    valid = F.try_parse_json("line").isNotNull()
    return lines.select(
        (F.col("line_no") + 1).cast("long").alias("line_no"),
        F.when(valid, F.from_json("line", schema)).alias("row"),
        F.when(~valid, F.lit("invalid JSON")).alias("error"),
    )


#: Headings and directives of a manuscript.
HEADING, DIRECTIVE = r"^(#{1,6})[ \t]+(.+?)\s*$", '^::passage\\{id="([^"]+)"\\}\\s*$'


def manuscript_elements(lines: DataFrame, key: str = "work_id") -> DataFrame:
    """(key, at, kind, id, level, title, section_path, text) of a manuscript's headings and passages, in order of ``at``.

    Front matter is left out, a passage ends at the next directive or heading, and passages without words are dropped.
    """
    body = body_lines(lines, key, "line_no", "line")
    so_far = Window.partitionBy(key).orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    marks, found = F.regexp_extract("line", HEADING, 1), F.regexp_extract("line", DIRECTIVE, 1)
    marked = body.withColumns({"_level": F.length(marks), "_id": F.when(found != "", found)})
    opens = (F.col("_level") > 0) | F.col("_id").isNotNull()
    grouped = marked.withColumns({"_group": F.sum(opens.cast("int")).over(so_far), "_head": F.max(F.when(F.col("_level") > 0, F.col("line_no"))).over(so_far), "_opens": opens})
    parts = grouped.groupBy(key, "_group").agg(
        F.min("line_no").alias("at"),
        F.max("_id").alias("id"),
        F.max("_head").alias("_head"),
        F.max("_level").alias("level"),
        F.max(F.when(F.col("_level") > 0, F.regexp_extract("line", HEADING, 2))).alias("title"),
        F.array_sort(F.collect_list(F.when(~F.col("_opens"), F.struct(F.col("line_no").alias("o"), F.col("line").alias("l"))))).alias("_lines"),
    )
    text = F.trim(F.array_join(F.transform("_lines", lambda x: x["l"]), "\n"), F.lit(" \n\t\r"))
    parts = parts.withColumn("text", text)
    headings = parts.where("level > 0").select(key, "at", "level", "title")
    paths = section_paths(headings, key, "at", "level", "title")
    none = F.array().cast("array<string>")
    heads = headings.join(paths, [key, "at"]).select(key, "at", F.lit("heading").alias("kind"), F.lit(None).cast("string").alias("id"), "level", "title", "section_path", F.lit(None).cast("string").alias("text"))
    passages = parts.where("id is not null and text <> ''").join(paths.withColumnRenamed("at", "_head"), [key, "_head"], "left")
    return heads.unionByName(
        passages.select(key, "at", F.lit("passage").alias("kind"), "id", F.lit(None).cast("int").alias("level"), F.lit(None).cast("string").alias("title"), F.coalesce("section_path", none).alias("section_path"), "text")
    )


def manuscript_sections(elements: DataFrame, key: str = "work_id") -> DataFrame:
    """(key, section_path, at, passage_ids, text_parts) of each heading: the passages under it, in order."""
    own = Window.partitionBy(key).orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    placed = elements.withColumn("_head", F.max(F.when(F.col("kind") == "heading", F.col("at"))).over(own)).where("_head is not null")
    held = F.array_sort(F.collect_list(F.when(F.col("kind") == "passage", F.struct("at", "id", "text"))))
    grouped = placed.groupBy(key, "_head").agg(F.first(F.when(F.col("kind") == "heading", F.col("section_path")), ignorenulls=True).alias("section_path"), held.alias("h"))
    return grouped.select(key, "section_path", F.col("_head").alias("at"), F.transform("h", lambda x: x["id"]).alias("passage_ids"), F.transform("h", lambda x: x["text"]).alias("text_parts"))


def manuscript_profile(elements: DataFrame, key: str = "work_id") -> DataFrame:
    """(key, headings, h1 … h6, passages, skipped_levels, adjacent_duplicates): equal titles count within four lines."""
    heads = elements.where("kind = 'heading'")
    before = Window.partitionBy(key).orderBy("at")
    flagged = heads.withColumns({"_level": F.lag("level").over(before), "_title": F.lag("title").over(before), "_at": F.lag("at").over(before)})
    counts = flagged.groupBy(key).agg(
        F.count("*").alias("headings"),
        *(F.count_if(F.col("level") == k).alias(f"h{k}") for k in range(1, 7)),
        F.count_if(F.col("level") > F.col("_level") + 1).alias("skipped_levels"),
        F.count_if((F.col("title") == F.col("_title")) & (F.col("at") - F.col("_at") <= 4)).alias("adjacent_duplicates"),
    )
    return counts.join(elements.where("kind = 'passage'").groupBy(key).agg(F.count("*").alias("passages")), key, "full").na.fill(0)


def heading_levels(toc: DataFrame, rules: list[tuple[int | None, str, int]], key: str = "work_id", start: str | None = None, before: int | None = None, after: int | None = None) -> DataFrame:
    """``toc`` (key, index, level, title) with the level that a profile gives each entry, and where it comes from.

    The first rule (source level or None, pattern, level) that fits wins. Without one, an entry has the level ``before`` or
    ``after`` the first title that matches ``start``, if they are given, else its own; levels stay within 1 and 6.
    """
    fits = [(F.lit(True) if source is None else F.col("level") == source) & F.col("title").rlike(pattern) for source, pattern, _ in rules]
    by_rule = F.coalesce(*(F.when(fit, F.lit(level)) for fit, (_, _, level) in zip(fits, rules)), F.lit(None).cast("int"))
    seen = F.lit(False)
    if start:
        so_far = Window.partitionBy(key).orderBy("index").rowsBetween(Window.unboundedPreceding, 0)
        seen = F.max(F.coalesce(F.col("title").rlike(start), F.lit(False))).over(so_far)
    by_mode = F.when(seen, F.lit(after).cast("int")).otherwise(F.lit(before).cast("int"))
    out = toc.withColumns({"_rule": by_rule, "_mode": by_mode})
    level = F.least(F.greatest(F.coalesce("_rule", "_mode", "level"), F.lit(1)), F.lit(6)).cast("int")
    source = F.when(F.col("_rule").isNotNull(), "rule").when(F.col("_mode").isNotNull(), "default").otherwise("source")
    return out.withColumns({"source_level": F.col("level"), "level_source": source}).withColumn("level", level).drop("_rule", "_mode")


def manuscript_lines(elements: DataFrame, key: str = "work_id") -> DataFrame:
    """(key, at, part, line): the lines of a manuscript from its elements, ready to be written in order."""
    mark = F.concat(F.repeat(F.lit("#"), F.col("level")), F.lit(" "), F.col("title"))
    open_ = F.concat(F.lit('::passage{id="'), F.col("id"), F.lit('"}'))
    lines = F.when(F.col("kind") == "heading", F.array(mark, F.lit(""))).otherwise(F.concat(F.array(open_), F.split("text", "\n"), F.array(F.lit(""))))
    return elements.select(key, "at", F.posexplode(lines).alias("part", "line"))


def write_new_version(rows: DataFrame, path: str, version: str) -> str:
    """Write ``rows`` beside what is there, never over it (they may be read from it), and give the new path."""
    target = f"{path.rstrip('/')}/version={version}"
    rows.write.mode("error").parquet(target)
    return target
