"""What reviewers are shown: categories of passages, themes of sections, problem pages, tasks with their passages, entities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quirework.functions import text as T
from quirework.operators.quality import problem_scores
from quirework.operators.selection import first_page

#: What marks a passage for a category, and a section for a theme.
REPORTS = "قال\\s+رسول|روى|رواه|الحديث|الأحاديث".replace("\\s", T.SPACE)
BLESSINGS = "(?:اللَّهُمَّ|اللهم)\\s+صَل|صلى\\s+الل".replace("\\s", T.SPACE)
HEADING_WORDS = "الفصل|القسم|الصلاة"
LIST_OPENERS = ("ومنها", "ومن ذلك")
CATEGORIES = [
    "already_translated",
    "author_context",
    "basmalah",
    "muqaddimah_long",
    "heading_like",
    "short_edge",
    "benefit_list",
    "hadith_discussion",
    "salawat_short",
    "salawat_long",
    "poetry",
]
#: Themes in order, as (theme, words of the section's path or title, counts of kinds); the first that fits wins.
THEMES = [
    ("biographical_preface", ["عن المؤلف"], []),
    ("opening_invocation", ["مقدمة"], []),
    ("friday_salawat", ["الجمعة"], []),
    ("hope_and_intercession", ["شفاع"], []),
    ("serious_admonition", ["التحذير"], []),
    ("benefits_and_fruits", ["الفوائد", "المنافع"], []),
    ("quranic_reflection", ["تفسير", "آية"], ["segment:ayah"]),
    ("hadith_transmission", ["الأحاديث"], ["hadith", "segment:hadith"]),
    ("salawat_formula", ["الصلاة"], []),
    ("poetic_closing", ["القصيدة"], ["poem"]),
    ("book_structure", ["القسم"], []),
]
DEFAULT_THEME = "modern_turath"


def categories(text: Column, section: Column, translated: Column) -> Column:
    """array<string>: all categories that a passage falls into, in their order. ``section``: its path as one text."""
    text, section = F.coalesce(text, F.lit("")), F.coalesce(section, F.lit(""))
    n = F.length(text)
    has = lambda col, word: F.contains(col, F.lit(word))
    tests = {
        "already_translated": translated,
        "author_context": has(section, "عن المؤلف") & (n >= 80),
        "basmalah": has(text, "بسم") & has(text, "الل"),
        "muqaddimah_long": has(section, "مقدمة") & (n >= 450),
        "heading_like": (n <= 180) & text.rlike(HEADING_WORDS),
        "short_edge": n < 12,
        "benefit_list": (text.startswith(LIST_OPENERS[0]) | text.startswith(LIST_OPENERS[1])) & n.between(40, 500),
        "hadith_discussion": n.between(300, 1800) & text.rlike(REPORTS),
        "salawat_short": n.between(80, 700) & text.rlike(BLESSINGS),
        "salawat_long": (n > 1800) & text.rlike(BLESSINGS),
        "poetry": has(section, "القصيدة") & n.between(80, 800),
    }
    return F.array_compact(F.array(*(F.when(tests[c], F.lit(c)) for c in CATEGORIES)))


def longest(passages: DataFrame, key: str = "id", text: str = "text", k: int = 3) -> DataFrame:
    """(key, category) of the ``k`` longest passages: ``longest_1`` and so on, of equal ones the smaller key first."""
    top = passages.select(key, F.coalesce(F.length(text), F.lit(0)).alias("_n")).orderBy(F.desc("_n"), key).limit(k)
    rank = F.row_number().over(Window.orderBy(F.desc("_n"), key))  # of k rows
    return top.select(key, F.concat(F.lit("longest_"), rank.cast("string")).alias("category"))


def theme(title: Column, path: Column, counts: Column) -> Column:
    """A section's theme, by the words of its path (array) and title, and by the counts of kinds in it (map)."""
    words = F.concat_ws(" ", path, title)
    out = F.lit(DEFAULT_THEME)
    for name, held, kinds in reversed(THEMES):
        tests = [F.contains(words, F.lit(w)) for w in held] + [F.coalesce(F.try_element_at(counts, F.lit(k)), F.lit(0)) > 0 for k in kinds]
        fits = tests[0]
        for more in tests[1:]:
            fits = fits | more
        out = F.when(fits, F.lit(name)).otherwise(out)
    return out


def problem_pages(passages: DataFrame, unmatched: DataFrame, artifact: Column, limit: int = 25, short: int = 12, long: int = 3000) -> DataFrame:
    """(page, score, reasons): the pages with most problems, of equal ones the first. ``passages``: text, source_blocks;
    ``unmatched``: page of the outline's entries that found no heading; ``artifact``: whether a passage shows one."""
    text = F.coalesce("text", F.lit(""))
    flags = F.array_compact(
        F.array(
            F.when(F.length(text) < short, "short_passage"),
            F.when(F.length(text) > long, "long_passage"),
            F.when(T.is_noise(text), "numeric_only"),
            F.when(artifact, "artifact"),
        )
    )
    own = passages.select(first_page(F.col("source_blocks")).alias("page"), F.explode(flags).alias("reason"))
    rows = own.unionByName(unmatched.select(F.col("page").cast("int").alias("page"), F.lit("toc_not_found").alias("reason"))).where("page is not null")
    return problem_scores(rows, "page").orderBy(F.desc("score"), "page").limit(limit)


def sample_tasks(samples: DataFrame, passages: DataFrame) -> DataFrame:
    """Tasks of suspicious samples (work_id, passage_id, line_no, pattern, text), with section and citation of their passage
    (id, section_path, citation); a sample of an unknown passage, or of none, is a task too."""
    known = passages.select(F.col("id").alias("passage_id"), "section_path", F.col("citation").alias("source_citation_label"))
    met = samples.join(known, "passage_id", "left")
    name, none = F.coalesce(F.col("passage_id").cast("string"), F.lit("None")), F.array().cast("array<string>")
    key = F.concat(F.lit("cleaning:"), F.col("line_no").cast("string"), F.lit(":"), name, F.lit(":"), "pattern")
    return _task(met, "cleaning_suspicious", "medium", key, F.concat(F.lit("Review cleaning artifact in "), name), F.coalesce("section_path", none))


def length_tasks(found: DataFrame, passages: DataFrame, kind: str) -> DataFrame:
    """Tasks of passages that are too ``long`` or ``short`` (work_id, passage_id, length, text), with their section and citation."""
    known = passages.select(F.col("id").alias("passage_id"), "section_path", F.col("citation").alias("source_citation_label"))
    met = found.join(known, "passage_id", "left")
    key = F.concat(F.lit(f"{kind}:"), F.col("passage_id").cast("string"), F.lit(":"), F.col("length").cast("string"))
    title = F.concat(F.lit(f"Review {kind} passage "), F.col("passage_id").cast("string"))
    return _task(met, f"{kind}_passage_review", "low", key, title, F.coalesce("section_path", F.array().cast("array<string>")))


def _task(rows: DataFrame, kind: str, priority: str, source_key: Column, title: Column, path: Column) -> DataFrame:
    return rows.select(
        T.stable_id(F.col("work_id"), F.lit(kind), source_key).alias("task_id"),
        "work_id",
        F.lit(kind).alias("task_type"),
        source_key.alias("source_key"),
        F.lit(priority).alias("priority"),
        title.alias("title"),
        "passage_id",
        path.alias("section_path"),
        F.coalesce("source_citation_label", F.lit("")).alias("source_citation_label"),
        T.truncate(F.coalesce("text", F.lit("")), 220).alias("text_preview"),
    )


def entity_profiles(extractions: DataFrame, limit: int = 10) -> DataFrame:
    """(extraction_text, n, attributes): the entities with most mentions, of equal ones the first by text, and every
    ``key: value`` that they are given (``attributes``: map), in order."""
    counts = extractions.groupBy("extraction_text").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "extraction_text").limit(limit)
    pair = extractions.select("extraction_text", F.explode(F.map_entries("attributes")).alias("e")).select("extraction_text", F.concat_ws(": ", "e.key", "e.value").alias("a")).distinct()
    held = pair.join(counts.select("extraction_text"), "extraction_text", "left_semi").groupBy("extraction_text").agg(F.array_sort(F.collect_list("a")).alias("attributes"))
    return counts.join(held, "extraction_text", "left").select("extraction_text", "n", F.coalesce("attributes", F.array().cast("array<string>")).alias("attributes"))


def grouped_by_attribute(extractions: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """(groups, warnings): extractions counted by the value of an attribute, and those that lack it."""
    value = F.try_element_at("attributes", F.lit(name))
    groups = extractions.where(value.isNotNull()).groupBy(value.alias("group")).agg(F.count("*").alias("n"), F.countDistinct("extraction_text").alias("texts"))
    warned = extractions.where(value.isNull()).groupBy("extraction_text").agg(F.count("*").alias("n"))
    return groups, warned.select(F.concat(F.lit(f"missing {name}: "), "extraction_text").alias("warning"), "n")


def sections(passages: DataFrame, level: int | None = None, prefix: str | None = None) -> DataFrame:
    """(work_id, id, title, level, path, first_passage_id, passage_count) of sections: those of a level, and those whose path,
    its parts joined by `` > ``, begins with ``prefix``. ``passages``: work_id, id, sequence, section_path."""
    path = F.col("section_path")
    rows = passages.where(F.size(path) > 0)
    if level is not None:
        rows = rows.where(F.size(path) == level)
    if prefix is not None:
        rows = rows.where(F.array_join(path, " > ").startswith(prefix))
    found = rows.groupBy("work_id", "section_path").agg(F.min_by("id", F.struct("sequence", "id")).alias("first_passage_id"), F.count("*").alias("passage_count"))
    return found.select(
        "work_id",
        T.stable_id(F.col("work_id"), F.lit("section"), F.array_join(path, " > ")).alias("id"),
        F.element_at(path, -1).alias("title"),
        F.size(path).alias("level"),
        path.alias("path"),
        "first_passage_id",
        "passage_count",
    )


def translations_of(translations: DataFrame, passages: DataFrame, lang: str, source: str | None = None, status: str | None = None, cursor: int | None = None, limit: int = 50) -> DataFrame:
    """A page of translations in a language, in the order of their source passages (work_id, id, sequence): of one source
    passage, of a status, after a sequence. Translations of unknown passages are left out."""
    rows = translations.where(F.col("lang") == lang)
    for name, value in (("source_passage_id", source), ("status", status)):
        if value is not None:
            rows = rows.where(F.col(name) == value)
    known = passages.select(F.col("id").alias("source_passage_id"), "sequence")
    placed = rows.join(known if cursor is None else known.where(F.col("sequence") > cursor), "source_passage_id")
    return placed.orderBy("sequence", "id").limit(min(limit, 200))


def with_context(chunks: DataFrame, key: str, context: int) -> DataFrame:
    """``chunks`` (key, chunk_no, start, chunk) with ``before``: the last ``context`` characters of the chunk before."""
    last = F.lag("chunk").over(Window.partitionBy(key).orderBy("chunk_no"))
    return chunks.withColumn("before", F.coalesce(F.right(last, F.lit(context)), F.lit("")))
