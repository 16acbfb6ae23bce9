"""Editions and translations: page maps, citations, and how translations cover and follow their source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirework.functions import text as T
from quirework.operators.matching import upsert_map
from quirework.operators.quality import Rule, findings, is_blank


def locator(page: Column, label: Column) -> Column:
    """A page locator; the label falls back to the page number."""
    return F.struct(F.lit("page").alias("type"), F.coalesce(label, page.cast("string")).alias("label"), page.alias("page"))


def page_map(placed: DataFrame, edition: str) -> DataFrame:
    """(edition, id, page, label) of each passage: the first page it stands on."""
    return placed.groupBy("id").agg(F.min_by(F.struct("page", "label"), F.struct("page")).alias("p")).select(F.lit(edition).alias("edition"), "id", "p.page", "p.label")


def sync_refs(passages: DataFrame, pages: DataFrame, edition: str) -> DataFrame:
    """``passages`` (with a map ``edition_refs``) updated from a page map; others keep what they have."""
    placed = pages.where(F.col("edition") == edition).select("id", locator(F.col("page"), F.col("label")).alias("_ref"))
    joined = passages.join(placed, "id", "left")
    updated = upsert_map(F.col("edition_refs"), F.lit(edition), F.col("_ref"))
    return joined.withColumn("edition_refs", F.when(F.col("_ref").isNull(), F.col("edition_refs")).otherwise(updated)).drop("_ref")


def on_page(pages: DataFrame) -> DataFrame:
    """(edition, page, ids): the passages that begin on each page, in order."""
    return pages.groupBy("edition", "page").agg(F.array_join(F.array_sort(F.collect_list("id")), ",").alias("ids"), F.count("*").alias("n"))


def translation_findings(translations: DataFrame, passages: DataFrame) -> DataFrame:
    """Findings on translations (id, source_id, lang, status, text, source_sequence) against passages (id, sequence, text)."""
    source = passages.select(F.col("id").alias("source_id"), F.col("text").alias("_text"), F.col("sequence").alias("_sequence"), F.lit(True).alias("_known"))
    rows = translations.join(source, "source_id", "left")
    known = F.col("_known").isNotNull()
    return findings(
        rows,
        "id",
        [
            Rule("missing_source", "fail", ~known),
            Rule("empty_text", "warn", is_blank(F.col("text"))),
            Rule("unknown_status", "warn", ~F.coalesce(F.col("status").isin("machine_draft", "draft", "reviewed", "published"), F.lit(False))),
            Rule("sequence_drift", "warn", known & ~F.col("source_sequence").eqNullSafe(F.col("_sequence"))),
            Rule("id_shape", "warn", F.col("id") != F.concat_ws(".", "source_id", "lang")),
            Rule("source_letters_left", "warn", (F.col("lang") != "ar") & (T.arabic_letters(F.col("text")) > 0)),
            Rule("length_ratio", "warn", known & ~is_blank(F.col("text")) & T.length_outlier(F.col("text"), F.col("_text"))),
        ],
    )


def packet(passages: DataFrame, langs: list[str], translations: DataFrame) -> DataFrame:
    """Every passage in every language of a list, with its translation where there is one."""
    wanted = passages.select("id", "text").withColumn("lang", F.explode(F.array(*map(F.lit, langs))))
    return wanted.join(translations.select(F.col("source_id").alias("id"), "lang", F.col("text").alias("translation")), ["id", "lang"], "left")
