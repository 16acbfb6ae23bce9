"""Folders of works: their configuration, what files they have, and single documents written beside them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quirework.sources.readers import exists, read_flat_config, read_json


def work_files(spark: SparkSession, root: str, pattern: str, name: str) -> DataFrame:
    """(work, name, path) of the files ``root/<work>/<pattern>``; of a pattern with a ``*`` as folder, that folder's name as
    ``name`` (an edition's or a language's). Contents are not read; no file gives no rows."""
    if not exists(spark, f"{root}/*/{pattern}"):
        return spark.createDataFrame([], f"work string, {name} string, path string")
    files = spark.read.format("binaryFile").load(f"{root}/*/{pattern}").select("path")
    parts = pattern.split("/")
    inner = "/".join("([^/]+)" if p == "*" else p.replace(".", "\\.").replace("*", "[^/]*") for p in parts)
    pick = F.regexp_extract("path", f"/([^/]+)/{inner}$", 2) if "*" in parts else F.lit(None).cast("string")
    return files.select(F.regexp_extract("path", f"/([^/]+)/{inner}$", 1).alias("work"), pick.alias(name), "path")


def read_json_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Whole-file JSON documents; a missing file is one document whose fields are all null."""
    return read_json(spark, path, schema) if exists(spark, path) else spark.createDataFrame([tuple(None for _ in schema)], schema)


def read_config(spark: SparkSession, path: str) -> DataFrame:
    """(key, value) of a flat configuration; a missing file has none."""
    return read_flat_config(spark, path) if exists(spark, path) else spark.createDataFrame([], "key string, value string")


def upserted_config(held: DataFrame, defaults: dict[str, str | None], forced: tuple[str, ...] = ()) -> tuple[DataFrame, int]:
    """(entries, changed): a configuration (key, value) with the defaults that it lacks, and the ``forced`` ones as they are
    given; ``changed`` counts entries that are new or another value. Other entries stay."""
    given = held.sparkSession.createDataFrame([(k, v, k in forced) for k, v in defaults.items()], "key string, _default string, _forced boolean")
    here, value = F.col("_had").isNotNull(), F.when(F.col("_had").isNull() | F.coalesce("_forced", F.lit(False)), F.col("_default")).otherwise(F.col("value"))
    out = held.withColumn("_had", F.lit(1)).join(given, "key", "full").select("key", value.alias("new"), F.col("value").alias("old"), here.alias("here"))
    changed = out.where(~F.col("here") | ~F.col("new").eqNullSafe(F.col("old"))).count()
    return out.select("key", F.col("new").alias("value")), changed


def front_matter(works: DataFrame) -> DataFrame:
    """(work_id, at, line): what a manuscript begins with. ``works``: work_id, title, and heading_profile, which may be null."""
    lines = F.array(
        F.lit("---"),
        F.concat(F.lit("work_id: "), "work_id"),
        F.concat(F.lit("title_ar: "), F.coalesce("title", F.lit(""))),
        F.lit("schema_version: 0.1"),
        F.lit("edition_status: draft_extraction"),
        F.lit("source_policy: source_pdf_used_as_raw_material_only"),
        F.when(F.col("heading_profile").isNotNull(), F.concat(F.lit("heading_profile: "), "heading_profile")),
        F.lit("---"),
        F.lit(""),
    )
    return works.select("work_id", F.posexplode(F.array_compact(lines)).alias("at", "line"))


def write_document(document: DataFrame, path: str) -> None:
    """One row as one readable JSON document below ``path``, which must not exist; more rows are an error."""
    if len(document.limit(2).collect()) != 1:
        raise ValueError("a document is one row")
    document.select(F.to_json(F.struct(*document.columns), {"pretty": "true", "ignoreNullFields": "false"}).alias("value")).write.text(path)


#: What every passage must have as a key of its JSON, whatever its value.
REQUIRED = ("id", "work_id", "sequence", "text", "section_path", "source_blocks")


def missing_keys(raw: Column, required: tuple[str, ...] = REQUIRED) -> Column:
    """array<string>: keys that a JSON object lacks, in order; one that is there with null is not missing. Null for no object."""
    keys = F.json_object_keys(raw)
    return F.when(keys.isNotNull(), F.array_except(F.array(*map(F.lit, required)), keys))
