"""What the operators share: scratch tables on shared storage and Arrow batch slicing."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Where one split needs more than one word separator: ASCII space and \t \n \v \f \r.
BLANKS = r"[\x20\x09-\x0D]+"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def scratch_dir(spark: SparkSession) -> str:
    """The folder that all executors share, as the session names it.

    Only a single-JVM session (``local[...]``) may fall back to a local folder.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found
    if not spark.sparkContext.master.startswith(("local[", "local")) or "cluster" in spark.sparkContext.master:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return "file:///tmp/checkpoints"


def stage(df: DataFrame, what: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Later steps then start from files instead of recomputing, or depending on blocks of executors that may be lost. The
    shuffle files of the write are deleted with its end, as nothing reads them again.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/quirework/{what}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_at = path
    return out


def release(*tables: DataFrame) -> None:
    """Delete tables that ``stage`` wrote, once all that reads them is written itself."""
    for held in tables:
        spark = held.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(held.staged_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(col, _UPPER, _LOWER)


def word_count(text: Column) -> Column:
    """Number of runs of non-blank characters; null counts as no text."""
    fenced = F.concat(F.lit("a "), F.coalesce(text, F.lit("")), F.lit(" a"))
    return (F.size(F.split(fenced, BLANKS)) - 2).cast("long")


def crc_remainder(id_col: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; the folds of the supervised operators."""
    return F.crc32(id_col.cast("string").cast("binary")) % modulus


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that the text in each holds about ``limit`` bytes (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(text))), 0).to_numpy(
            zero_copy_only=False
        )
        part = size.cumsum() // limit
        begin = 0
        for k in range(1, batch.num_rows + 1):
            if k == batch.num_rows or part[k] != part[begin]:
                yield batch.slice(begin, k - begin)
                begin = k


def fixed_bitmap(hashes: DataFrame, col: str, bits: int = 24) -> np.ndarray:
    """A bitmap of 2**bits places, one set for the top bits of each hash: its size does not grow with the input.

    It only ever lets too much through; an exact join follows wherever it is used.
    """
    place = F.shiftrightunsigned(F.col(col), 64 - bits)
    held = (
        hashes.select(F.shiftright(place, 6).alias("at"), F.expr(f"shiftleft(1L, cast(shiftrightunsigned({col}, {64 - bits}) & 63 as int))").alias("bit"))
        .groupBy("at")
        .agg(F.bit_or("bit").alias("bits"))
        .toArrow()
    )
    out = np.zeros(1 << max(0, bits - 6), np.int64)
    out[held.column("at").to_numpy()] = held.column("bits").to_numpy()
    return out.view(np.uint64)


def in_bitmap(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes have their place set."""
    bits = np.uint64(len(bitmap).bit_length() - 1 + 6)
    place = hashes >> (np.uint64(64) - bits)
    return (bitmap[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) != 0


def without_ids(docs: DataFrame, ids: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``docs`` without the rows whose id is in ``ids`` (one column, ``id``); null ids compare as equal.

    Ids go into a bitmap first, so only rows that may be in ``ids`` are joined: their texts are shuffled, the others
    pass by.
    """
    listed = stage(ids.select(F.col("id").alias("_quirework_gone")).distinct(), "ids")
    kind = listed.schema["_quirework_gone"].dataType
    listed_id = id_mask(listed.select(F.xxhash64("_quirework_gone").alias("h")), "h", listed.count())
    suspect = listed_id(F.xxhash64(F.col(id_col).cast(kind)))
    same = F.col(id_col).cast(kind).eqNullSafe(F.col("_quirework_gone"))
    return docs.where(~suspect).unionByName(docs.where(suspect).join(listed, same, "left_anti"))


def id_mask(ids: DataFrame, col: str, count: int) -> Callable[[Column], Column]:
    """A test whether a 64-bit hash may be among those in ``col``, by a bitmap: it only ever lets too much through.

    The bitmap has about 16 places for each of ``count`` hashes, 2**26 (16 MB) at most.
    """
    bits = min(26, max(12, (16 * count).bit_length()))
    place = F.shiftrightunsigned(F.col(col), 64 - bits)
    held = ids.groupBy(F.shiftright(place, 5).alias("at")).agg(F.bit_or(_bit(place)).alias("bits"))
    mask = fixed_table(held, "bits", 1 << (bits - 5), "long")

    def among(value: Column) -> Column:
        place = F.shiftrightunsigned(value, 64 - bits)
        return F.get(mask, F.shiftright(place, 5).cast("int")).bitwiseAND(_bit(place)) != 0

    return among


def _bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(F.lit(31).cast("long")).cast("int"))


def fixed_table(rows: DataFrame, value: str, size: int, kind: str) -> Column:
    """Rows (at, value) as one array of ``size`` places, 0 where there is no row; values are positive."""
    pairs = rows.select(F.struct(F.col("at").cast("int").alias("at"), F.col(value).cast(kind).alias("v")).alias("p"))
    full = rows.sparkSession.range(size).select(F.struct(F.col("id").cast("int").alias("at"), F.lit(0).cast(kind).alias("v")).alias("p"))
    top = pairs.unionByName(full).groupBy("p.at").agg(F.max("p.v").alias("v"))
    out = top.agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "v"))), lambda x: x["v"]).alias("t"))
    return stage(out, "table").scalar()
