"""Numbered lines of text files that are read in splits: no file is a task of its own, whatever its size.

Each split of a file counts its lines; running sums over a file's splits, of which there are few, say how many lines stand
before each. A line's number is that sum and its place in its split. So a file is read twice, and nothing is sorted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quirework.session import shared_path
from quirework.sources.readers import exists

#: Splits whose counts (about 100 bytes each) may be sent to all executors; more are joined.
_SENT = 1 << 18


def numbered_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, line_no, line) of every line, from 1 in each file; an empty file has none."""
    read = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("_split"),
        F.monotonically_increasing_id().alias("_id"),
        F.col("value").alias("line"),
    )
    splits = read.groupBy("path", "_split").agg(F.count("*").alias("_n"), F.min("_id").alias("_first"))
    ahead = Window.partitionBy("path").orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    held = shared_path(spark, "splits")
    splits.withColumn("_ahead", F.coalesce(F.sum("_n").over(ahead), F.lit(0))).drop("_n").write.parquet(held)
    placed = spark.read.schema("path string, _split long, _first long, _ahead long").parquet(held)
    few = placed.count() <= _SENT
    joined = read.join(F.broadcast(placed) if few else placed, ["path", "_split"])
    return joined.select("path", (F.col("_ahead") + F.col("_id") - F.col("_first") + 1).alias("line_no"), "line")


def jsonl_rows(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """(path, line_no, row, error) of every line that is not blank: ``row`` as the schema says, or null with an error.

    A missing file is one error of line 0.
    """
    if not exists(spark, path):
        kinds = f"path string, line_no long, row {schema.simpleString()}, error string"
        return spark.createDataFrame([(path, 0, None, f"missing file: {path}")], kinds)
    valid = F.try_parse_json("line").isNotNull()
    rows = numbered_lines(spark, path).where(F.trim("line") != "")
    return rows.select("path", "line_no", F.when(valid, F.from_json("line", schema)).alias("row"), F.when(~valid, F.lit("invalid JSON")).alias("error"))


def strict_jsonl(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The rows of JSON lines; the first bad line met fails the query with its path and number. A missing file has no rows."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    rows = jsonl_rows(spark, path, schema)
    where = F.concat_ws(":", "path", "line_no", F.concat(F.lit(" "), "error"))
    return rows.select(F.when(F.col("error").isNull(), F.col("row")).otherwise(F.raise_error(where)).alias("r")).select("r.*")


def error_findings(rows: DataFrame, code: str, severity: str = "fail", samples: int = 5) -> DataFrame:
    """(path, code, severity, n, samples) of the files of ``jsonl_rows`` with error lines: their number and the first of them."""
    bad = rows.where("error is not null")
    first = F.slice(F.array_sort(F.collect_list(F.when(F.col("_rank") <= samples, F.struct("line_no", "error")))), 1, samples)
    ranked = bad.withColumn("_rank", F.row_number().over(Window.partitionBy("path").orderBy("line_no"))).where(F.col("_rank") <= samples)
    shown = ranked.groupBy("path").agg(first.alias("samples"))
    counts = bad.groupBy("path").agg(F.count("*").alias("n"))
    return counts.join(shown, "path").select("path", F.lit(code).alias("code"), F.lit(severity).alias("severity"), "n", "samples")
