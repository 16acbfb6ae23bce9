"""Operators on ordered rows: heading stacks, segments, gaps, breaks and de-duplication.

All of them work within a document or work whose size is bounded; what is global (gaps, keep-last) is an aggregate or an
anti join, so that no order over the whole table is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quirework.functions.folds import fold
from quirework.session import shared_path


def section_paths(headings: DataFrame, key: str, order: str, level: str, title: str) -> DataFrame:
    """(key, order, section_path) of every heading: at level L the path is cut to L - 1 titles and the title added.

    One fold over each work's headings in order gives all of its paths; skipped levels lengthen a path by one only.
    """
    each = headings.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(level).alias("l"), F.col(title).alias("t")))).alias("h"))
    kind = "struct<o:bigint,path:array<string>>"

    def paths(held: Column) -> Column:
        def step(stack: Column, i: Column) -> tuple[Column, Column]:
            h = F.get(held, i)
            path = F.concat(F.slice(stack, F.lit(1), F.greatest(h["l"] - 1, F.lit(0)).cast("int")), F.array(h["t"]))
            return path, F.array(F.struct(h["o"].cast("bigint").alias("o"), path.alias("path")))

        return fold(F.size(held), F.array().cast("array<string>"), kind, step)

    folded = each.select(key, F.explode(paths(F.col("h"))).alias("x"))
    return folded.select(key, F.col("x.o").alias(order), F.col("x.path").alias("section_path"))


def body_lines(lines: DataFrame, key: str, order: str, line: str, fence: str = "---") -> DataFrame:
    """Lines outside the front matter: the first two fences enclose it, later ones are text."""
    seen = F.sum((F.col(line) == fence).cast("int")).over(Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    closing = (F.col("_fences") == 2) & (F.col(line) == fence)
    return lines.withColumn("_fences", seen).where((F.col("_fences") == 0) | ((F.col("_fences") >= 2) & ~closing)).drop("_fences")


def segments(lines: DataFrame, key: str, order: str, line: str, directive: str, heading: str = "^#{1,6} ") -> DataFrame:
    """(key, segment_id, text): lines after a directive, up to the next directive or heading, joined in order.

    ``directive`` is a pattern whose first group is the id. Lines after a heading without a directive belong to none.
    """
    found = F.regexp_extract(line, directive, 1)
    opens = (found != "") | F.col(line).rlike(heading)
    so_far = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    parts = lines.withColumn("_id", F.when(found != "", found)).withColumn("_group", F.sum(opens.cast("int")).over(so_far))
    owned = parts.groupBy(key, "_group").agg(
        F.max("_id").alias("segment_id"), F.array_sort(F.collect_list(F.when(~opens, F.struct(F.col(order).alias("o"), F.col(line).alias("l"))))).alias("ls")
    )
    text = F.array_join(F.transform("ls", lambda x: x["l"]), "\n")
    return owned.where("segment_id is not null and size(ls) > 0").select(key, "segment_id", text.alias("text"))


def level_skips(headings: DataFrame, key: str, order: str, level: str) -> DataFrame:
    """Headings more than one level below the one before, with that level as ``previous_level``."""
    before = F.lag(level).over(Window.partitionBy(key).orderBy(order))
    return headings.withColumn("previous_level", before).where(F.col(level) > F.col("previous_level") + 1)


def adjacent_duplicates(rows: DataFrame, key: str, order: str, value: str, reach: int = 1) -> DataFrame:
    """Rows whose value equals that of the row before, at most ``reach`` places apart."""
    each = Window.partitionBy(key).orderBy(order)
    return rows.withColumn("_v", F.lag(value).over(each)).withColumn("_o", F.lag(order).over(each)).where(
        (F.col(value) == F.col("_v")) & (F.col(order) - F.col("_o") <= reach)
    ).drop("_v", "_o")


def _ranged(rows: DataFrame, order: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` in ranges of ``order`` (``_cell``), and one row for each range: its rows, least and largest number.

    Ranges are those that Spark deals rows out by, so they hold about as many rows each, however far apart the numbers are;
    the table is written once, so that they stay what they are.
    """
    spark = rows.sparkSession
    path = shared_path(spark, "ranges")
    rows.repartitionByRange(order).sortWithinPartitions(order).write.parquet(path)
    held = spark.read.schema(rows.schema).parquet(path).withColumn("_cell", F.col("_metadata.file_path"))
    cells = held.groupBy("_cell").agg(F.count("*").alias("_n"), F.min(order).alias("_low"), F.max(order).alias("_high"))
    return held, cells


def sequence_gaps(rows: DataFrame, seq: str, low: int = 1) -> DataFrame:
    """(first_missing, last_missing): runs of numbers from ``low`` to the largest that no row has.

    Each number looks at the next one within its range of the data; the ranges' ends are compared among themselves, so
    neither a global sort nor the sequence of all numbers is needed.
    """
    seen = rows.where(F.col(seq) >= low).select(F.col(seq).cast("long").alias("v")).distinct()
    held, cells = _ranged(seen, "v")
    inside = held.withColumn("next", F.lead("v").over(Window.partitionBy("_cell").orderBy("v"))).select("v", "next")
    # one row for each range: as many as tasks that dealt them out
    across = cells.select(F.col("_high").alias("v"), F.lead("_low").over(Window.orderBy("_low")).alias("next"))
    head = cells.agg(F.min("_low").alias("next")).select(F.lit(low - 1).cast("long").alias("v"), "next")
    steps = inside.unionByName(across).unionByName(head)
    return steps.where("next > v + 1").select((F.col("v") + 1).alias("first_missing"), (F.col("next") - 1).alias("last_missing"))


def breaks(rows: DataFrame, key: str, order: str, opens: Column, name: str = "group_no") -> DataFrame:
    """Number the groups of a sequence: a row for which ``opens`` holds begins a new one (sessionization)."""
    so_far = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn(name, F.sum(F.coalesce(opens, F.lit(True)).cast("long")).over(so_far))


def seen_before(rows: DataFrame, key: str, order: str, flag: Column, name: str = "seen") -> DataFrame:
    """Whether the flag held in this row or an earlier one."""
    so_far = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn(name, F.max(flag).over(so_far))


def keep_last(rows: DataFrame, keys: list[str], *order: str) -> DataFrame:
    """The last row of each key by ``order``: an aggregate with partial results, so a hot key is no burden."""
    names = rows.columns
    best = rows.groupBy(*keys).agg(F.max_by(F.struct(*names), F.struct(*order)).alias("_r"))
    return best.select(*(F.col(f"_r.{c}").alias(c) for c in names))


def keep_first(rows: DataFrame, keys: list[str], *order: str) -> DataFrame:
    """The first row of each key by ``order``."""
    names = rows.columns
    best = rows.groupBy(*keys).agg(F.min_by(F.struct(*names), F.struct(*order)).alias("_r"))
    return best.select(*(F.col(f"_r.{c}").alias(c) for c in names))


def first_k(rows: DataFrame, keys: list[str], order: list[str], k: int, fan: int = 64) -> DataFrame:
    """The first ``k`` rows of each key by ``order``, which must tell a key's rows apart.

    Rank filters are limits to Spark: each task passes on ``k`` rows of a key at most. A key's rows are ranked in ``fan``
    parts first, so at any size one task gets ``fan * k`` rows of a key, never the whole key.
    """
    part = F.pmod(F.xxhash64(*order), F.lit(fan))
    rank = lambda by: F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    some = rows.withColumn("_part", part).withColumn("_rank", rank([*keys, "_part"])).where(F.col("_rank") <= k)
    return some.withColumn("_rank", rank(keys)).where(F.col("_rank") <= k).drop("_part", "_rank")


def spread_sample(rows: DataFrame, order: str, limit: int) -> DataFrame:
    """About ``limit`` rows, evenly spaced over the ordered numbers: the first of each of ``limit`` equal ranges."""
    low, high = rows.agg(F.min(order).alias("v")).scalar(), rows.agg(F.max(order).alias("v")).scalar()
    cell = F.floor((F.col(order) - low) * limit / (high - low + 1))
    return keep_first(rows.withColumn("_cell", cell), ["_cell"], order).drop("_cell")


#: What opens a passage, and how far a block stands from the one before or from the margin.
PASSAGE_OPENERS = ["(فائدة", ")فائدة", "فائدة", "(أما بعد", ")أما بعد", "قال ", "وفي "]
GAP, INDENT = 18, 150


def new_passage(text: Column, y0: Column, previous_y1: Column, previous_x0: Column) -> Column:
    """Whether a block opens a passage: none before it, a gap above it, an indented block before it, or an opener."""
    opener = F.coalesce(*(F.when(text.startswith(o), True) for o in PASSAGE_OPENERS), F.lit(False))
    return previous_x0.isNull() | F.coalesce(y0 - previous_y1 > GAP, F.lit(False)) | (previous_x0 > INDENT) | opener


def placed(rows: DataFrame, order: str, name: str = "place") -> DataFrame:
    """(order, place): the position of every number in ascending order, from 0; equal numbers have positions of their own.

    Places are counted within ranges of the data, after all rows of the ranges before.
    """
    held, cells = _ranged(rows.where(F.col(order).isNotNull()).select(order), order)
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_low").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = cells.select("_cell", before.alias("_before"))  # one row for each range
    within = held.withColumn("_own", F.row_number().over(Window.partitionBy("_cell").orderBy(order)) - 1)
    return within.join(starts, "_cell").withColumn(name, F.col("_before") + F.col("_own")).drop("_cell", "_before", "_own")


def spread_fill(rows: DataFrame, chosen: DataFrame, order: str, limit: int) -> DataFrame:
    """``chosen`` numbers and, until there are ``limit``, every n-th row's number that is not among them: n is the number of
    rows over one more than what is missing, and the first n-th row is not the first row."""
    have = chosen.select(order).distinct()
    missing = limit - have.count()
    if missing <= 0:
        return have
    step = max(rows.count() // (missing + 1), 1)
    more = placed(rows, order).where((F.col("place") > 0) & (F.col("place") % step == 0)).select(order)
    return have.unionByName(more.join(have, order, "left_anti").orderBy(order).limit(missing))
