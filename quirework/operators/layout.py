"""Checks on the pages of a typeset edition, from the text and the source that its tools give."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirework.functions import text as T
from quirework.functions.tokens import Phrases

#: Words of the workshop that no reader should see, and where the source sets the width of a code.
TECHNICAL_TERMS = ["API", "RAG", "Graph", "PDF", "Typst", "QR", "role", "matn", "pipeline"]
CODE_WIDTH = r"qrcode\([\s\S]{0,500}?width:\s*([0-9.]+)mm"
WIDEST, FEWEST = 30, 8


def page_lines(pages: DataFrame, *keys: str) -> DataFrame:
    """(keys, page, line_no, line) of every line of pages (keys, page, text), from 1 in each page."""
    lines = pages.select(*keys, "page", F.posexplode(F.split("text", "\r?\n")).alias("line_no", "line"))
    return lines.withColumn("line_no", (F.col("line_no") + 1).cast("long"))


def latin_lines(lines: DataFrame) -> DataFrame:
    """Lines with Latin letters."""
    return lines.where(F.col("line").rlike("[A-Za-z]"))


def technical_lines(lines: DataFrame, terms: list[str] | None = None) -> DataFrame:
    """Lines that hold a term as a word, with the terms (``terms``: array<string>, in order of the alphabet)."""
    found = Phrases(TECHNICAL_TERMS if terms is None else terms, fold=False).at(F.col("line"))
    held = lines.withColumn("terms", F.array_sort(F.array_distinct(F.transform(found, lambda p: p["text"]))))
    return held.where(F.size("terms") > 0)


def wide_codes(sources: DataFrame, text: str = "text") -> Column:
    """array<double>: the widths in the source that are too wide."""
    widths = F.transform(F.regexp_extract_all(F.col(text), F.lit(CODE_WIDTH), 1), lambda w: w.try_cast("double"))
    return F.filter(widths, lambda w: w > WIDEST)


def blank_pages(pages: DataFrame) -> DataFrame:
    """Pages with hardly any text."""
    return pages.where(F.length(T.strip(F.coalesce(F.col("text"), F.lit("")))) < FEWEST)


def layout_findings(pages: DataFrame, sources: DataFrame, key: str = "work_id", terms: list[str] | None = None) -> DataFrame:
    """(key, code, severity, n) of editions: ``pages`` (key, page, text) and ``sources`` (key, text); codes without any are
    left out."""
    lines = page_lines(pages, key)
    parts = [
        (latin_lines(lines), "latin_letters_visible", "warn"),
        (technical_lines(lines, terms), "technical_terms_visible", "warn"),
        (sources.select(key, F.explode(wide_codes(sources)).alias("w")), "code_too_wide", "warn"),
        (blank_pages(pages), "blank_page", "info"),
    ]
    found = [rows.groupBy(key).agg(F.count("*").alias("n")).select(key, F.lit(code).alias("code"), F.lit(severity).alias("severity"), "n") for rows, code, severity in parts]
    return reduce(DataFrame.unionByName, found)


def section_index_lines(blocks: DataFrame, titles: DataFrame, page: str = "page", suffix: str | None = None) -> DataFrame:
    """Blocks (page, block_no, text) that are lines of a section index: they end with a section number, and their key holds
    that of a title (page, title) of their page."""
    from quirework.operators.fuzzy import INDEX_SUFFIX

    ended = blocks.where(T.strip(F.col("text")).rlike(suffix or INDEX_SUFFIX)).withColumn("_key", T.match_key(F.col("text")))
    keys = titles.select(page, T.match_key(F.col("title")).alias("_title")).where("_title <> ''").distinct()
    met = ended.join(keys, page).where(F.contains("_key", F.col("_title")))
    return met.select(*blocks.columns).distinct()


def is_body_noise(text: Column) -> Column:
    """Nothing but blanks, digits and punctuation once the text is cleaned."""
    clean = T.clean_extracted(F.coalesce(text, F.lit("")))
    return (F.replace(clean, F.lit(" "), F.lit("")) == "") | T.is_noise(clean)
