"""Choosing rows: by lists of ids, slices, reasons, caps and positions in another list."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quirework.operators.sequence import placed
from quirework.operators.source_spans import QUOTE_PHRASES

#: Signals that make a passage a candidate for enrichment, with the reason.
SCRIPTURE_SIGNALS = ["قال تعالى", "قوله تعالى", "} "]
REPORT_SIGNALS = ["قال رسول", "رواه", "روى", "أخرج"]
POEM_SECTION, POEM_WORD = "القصيدة", "قصيدة"


def parse_ids(values: list[str]) -> list[str]:
    """Ids from arguments that may hold several, parted by commas: in order, each once."""
    return list(dict.fromkeys(x.strip() for v in values for x in v.split(",") if x.strip()))


def by_ids(rows: DataFrame, ids: list[str], key: str = "id", strict: bool = False, requested_order: bool = False, order: str = "sequence") -> DataFrame:
    """The rows of the ids, in the order of the rows or of the request; ``strict`` fails for ids without a row."""
    wanted = rows.sparkSession.createDataFrame([(x, k) for k, x in enumerate(ids)], f"{key} string, _at int")  # as many rows as the caller named
    if strict:
        lost = [r[0] for r in wanted.join(rows, key, "left_anti").orderBy("_at").select(key).collect()]
        if lost:
            raise ValueError(f"unknown ids: {', '.join(lost)}")
    found = rows.join(F.broadcast(wanted), key)
    return (found.orderBy("_at") if requested_order else found.orderBy(order)).drop("_at")


def sliced(rows: DataFrame, order: str, offset: int = 0, limit: int | None = None) -> DataFrame:
    """Rows from ``offset`` on, ``limit`` of them, in order."""
    found = rows.orderBy(order).offset(offset)
    return found if limit is None else found.limit(limit)


def without_front_pages(pages: DataFrame, toc: DataFrame, page: str = "page", keep: Column | None = None) -> DataFrame:
    """Pages from the first one of the table of contents on; before it only those that ``keep`` names (an author's page)."""
    first = toc.agg(F.min(page)).scalar()
    late = F.coalesce(F.col(page) >= first, F.lit(True))
    return pages.where(late if keep is None else late | keep)


def least_confident(rows: DataFrame, below: float = 0.65, limit: int = 25, order: str = "sequence") -> DataFrame:
    """The first ``limit`` rows with a confidence under ``below``."""
    return rows.where(F.col("confidence") < below).orderBy(order).limit(limit)


def sections_with_passages(sections: DataFrame, levels: list[int]) -> DataFrame:
    """Sections of some levels that hold a passage."""
    return sections.where(F.col("level").isin(*levels) & (F.size("passage_ids") > 0))


def with_warnings(rows: DataFrame) -> DataFrame:
    return rows.where(F.size("warnings") > 0)


def grounded_only(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("start_pos").isNotNull() & F.col("end_pos").isNotNull())


def pruned(entries: Column) -> Column:
    """A map without null and blank values."""
    return F.map_filter(entries, lambda _, v: v.isNotNull() & (F.trim(v) != ""))


def candidate_reason(text: Column, role: Column, section: Column) -> Column:
    """Why a passage is worth enriching: the first of six reasons, or null."""
    has = lambda words: reduce(lambda a, b: a | b, (F.contains(text, F.lit(w)) for w in words))
    return (
        F.when(role.isin("matn", "quote", "poem", "ayat"), F.concat(F.lit("heuristic role="), role))
        .when(has(SCRIPTURE_SIGNALS), "contains Qur'an-like signal")
        .when(has(REPORT_SIGNALS), "contains hadith/transmission signal")
        .when(has(QUOTE_PHRASES), "contains quote/source attribution signal")
        .when(F.contains(section, F.lit(POEM_SECTION)) | F.contains(text, F.lit(POEM_WORD)), "poetry/qasidah context")
        .when(F.length(text) > 2500, "long passage may need split/table/editorial treatment")
    )


def candidates(rows: DataFrame, reason: Column, order: str, limit: int, offset: int = 0) -> DataFrame:
    """``limit`` rows from ``offset`` on, with their reason: those with one in order, then every n-th of all rows that is
    not among them. Order is by a number. At most ``limit + offset`` rows of either kind are ever held."""
    need = limit + offset
    first = rows.withColumn("reason", reason).where("reason is not null").orderBy(order).limit(need)
    first = first.withColumn("_rank", F.row_number().over(Window.orderBy(order)))
    total = rows.agg(F.count("*")).scalar()
    step = F.greatest(F.floor(total / F.lit(max(need, 1))), F.lit(1))
    every = placed(rows, order).where(F.col("place") % step == 0).select(order)
    spread = every.join(first.select(order), order, "left_anti").orderBy(order).limit(need).join(rows, order)
    spread = spread.withColumn("reason", F.lit("sequence spread sample")).withColumn("_rank", F.row_number().over(Window.orderBy(order)) + need).select(*first.columns)
    return first.unionByName(spread).orderBy("_rank").limit(need).orderBy("_rank").offset(offset).drop("_rank")


def by_list(rows: DataFrame, key: str, positions: DataFrame, *ties: str) -> DataFrame:
    """Rows in the order that ``positions`` (key, place) gives their keys; others come last."""
    return rows.join(positions.select(key, "place"), key, "left").orderBy(F.coalesce("place", F.lit(10**12)), *ties).drop("place")


def capped(rows: DataFrame, limits: dict[str, int], kind: str, *order: Column | str) -> DataFrame:
    """The first rows of each kind, as many as its limit; kinds without one are left out."""
    parts = [rows.where(F.col(kind) == k).orderBy(*order).limit(n) for k, n in limits.items()]
    return reduce(DataFrame.unionByName, parts)


def numeric_order(key: str) -> list[Column]:
    """Sort keys for keys that are numbers held as text; others come after, as text."""
    return [F.col(key).try_cast("long").asc_nulls_last(), F.col(key)]


def top_sections(passages: DataFrame, section: str, order: str, limit: int = 15) -> DataFrame:
    """(section, n): the sections with most passages; of equal ones the earlier first."""
    counts = passages.groupBy(section).agg(F.count("*").alias("n"), F.min(order).alias("_first"))
    return counts.orderBy(F.desc("n"), "_first").limit(limit).drop("_first")


def first_page(blocks: Column) -> Column:
    """The first whole page number among a passage's blocks, malformed ones passed over."""
    return F.get(F.filter(F.transform(blocks, lambda b: b["pdf_page"].try_cast("int")), lambda p: p.isNotNull()), F.lit(0))


def model_summary(results: DataFrame) -> DataFrame:
    """(model, tried, succeeded, avg_latency, latencies) of trials (sample_id, model, ok, latency_seconds); all latencies are
    listed, in order of the samples. Ranges of samples are joined into text first, so a model's row gathers texts of ranges."""
    order = ["model", "sample_id", "latency_seconds"]
    ranged = results.where("latency_seconds is not null").select(*order).repartitionByRange(*order).withColumn("_range", F.spark_partition_id())
    said = lambda each: F.transform(F.array_sort(each), lambda x: x["latency_seconds"].cast("string"))
    texts = ranged.groupBy("model", "_range").agg(F.array_join(said(F.collect_list(F.struct("sample_id", "latency_seconds"))), " / ").alias("text"))
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_range", "text"))), lambda x: x["text"]), " / ")
    lists = texts.groupBy(F.col("model").alias("_model")).agg(whole.alias("latencies"))
    counts = results.groupBy("model").agg(
        F.count("*").alias("tried"),
        F.count_if("ok").alias("succeeded"),
        F.round(F.avg(F.when(F.col("ok"), F.col("latency_seconds"))), 1).alias("avg_latency"),
    )
    return counts.join(lists, F.col("model").eqNullSafe(F.col("_model")), "left").drop("_model")
