"""Quality report of works: every rule gives (work_id, code, severity, n), n being the rows that break it.

Rules that test rows of one table share one aggregation over it; rules that compare tables are joins on ids. Nothing is
gathered per work, so a work may be of any size.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirework.functions import text as T
from quirework.operators.quality import is_blank, status

#: States of works and translations, fields that translations need, artifacts of extraction and cleaning.
WORK_STATES = ["raw_extraction", "draft_extraction", "draft", "reviewed", "published"]
TRANSLATION_STATES = ["machine_draft", "draft", "reviewed", "published"]
TRANSLATION_FIELDS = [
    "id",
    "work_id",
    "lang",
    "source_lang",
    "source_passage_id",
    "source_sequence",
    "section_path",
    "source_citation",
    "translation_status",
    "translation_type",
    "translator",
    "model",
    "text",
]
PASSAGE_FIELDS = ["id", "work_id", "sequence", "lang", "text", "review_status"]
ARTIFACTS = {"shamela": "Shamela", "contents": "المحتويات", "bad_allah_glyph": "᧦", "bidi_control": T.BIDI}
#: What a clean manuscript must not show any more.
CLEAN_ARTIFACTS = {
    "bad_allah_glyph": "᧦",
    "bidi_control": T.BIDI,
    "legacy_print_marker": "(?:^|[\\s،.؛:])-?ط\\([،.]?\\)?-?".replace("[\\s", f"[{T.SPACE}"),
    "runtime_error": T.RUNTIME_ERROR,
    "star_leftover": "\\*",
    "tatweel_leftover": "ـ",
}
SEVERITY = {
    "unknown_status": "warn",
    "missing_schema_version": "warn",
    "raw_manuscript_missing": "fail",
    "json_errors": "fail",
    "duplicate_ids": "fail",
    "sequence_gaps_or_duplicates": "warn",
    "numeric_only": "warn",
    "artifacts_left": "warn",
    "clean_manuscript_missing": "warn",
    "clean_artifacts_left": "warn",
    "cleaning_report_missing": "warn",
    "clean_ids_differ_from_passages": "fail",
    "clean_ids_differ_from_raw": "fail",
    "page_map_ids_wrong": "fail",
    "edition_refs_wrong": "fail",
    "public_citation_wrong": "fail",
    "translation_json_errors": "fail",
    "translation_duplicates": "fail",
    "translation_source_unknown": "fail",
    "translation_incomplete": "warn",
    "translation_source_uncited": "warn",
    "source_citation_drift": "fail",
    "translation_drift": "warn",
    "source_letters_left": "warn",
    "length_ratio_outlier": "warn",
    "block_provenance": "fail",
    "missing_review_status": "warn",
    "missing_lang": "warn",
    "flat_outline": "info",
    "detailed_outline": "info",
    "adjacent_duplicate_headings": "warn",
    "toc_unmatched": "warn",
    "long_passages": "info",
}


def counted(rows: DataFrame, tests: dict[str, Column], work: str = "work_id") -> DataFrame:
    """(work_id, code, n) of the rows that fulfil each test, for n above 0: one aggregation for all tests."""
    flat = rows.groupBy(work).agg(*(F.count_if(test).alias(code) for code, test in tests.items()))
    return flat.unpivot([work], list(tests), "code", "n").where("n > 0").select(F.col(work).alias("work_id"), "code", "n")


def report(parts: list[DataFrame]) -> DataFrame:
    """The parts as one table, with the severity of each code."""
    whole = reduce(DataFrame.unionByName, parts)
    known = F.coalesce(*(F.when(F.col("code") == c, F.lit(s)) for c, s in SEVERITY.items()), F.lit("metric"))
    given = F.col("severity") if "severity" in whole.columns else known
    return whole.select("work_id", "code", given.alias("severity"), "n")


def missing(works: DataFrame, held: DataFrame, code: str) -> DataFrame:
    """Works without a row in ``held``."""
    return works.join(held.select("work_id").distinct(), "work_id", "left_anti").select("work_id", F.lit(code).alias("code"), F.lit(1).cast("long").alias("n"))


def ids_differ(left: DataFrame, right: DataFrame, code: str) -> DataFrame:
    """Works with rows on both sides, and how many (work_id, id) only one side has."""
    a, b = (x.select("work_id", "id").distinct().withColumn("side", F.lit(s)) for x, s in ((left, 1), (right, 2)))
    each = a.unionByName(b).groupBy("work_id", "id").agg(F.sum("side").alias("sides"))
    whole = each.groupBy("work_id").agg(F.count_if(F.col("sides") != 3).alias("n"), F.min(F.when(F.col("sides") != 2, 1)).alias("l"), F.min(F.when(F.col("sides") != 1, 1)).alias("r"))
    return whole.where("n > 0 and l = 1 and r = 1").select("work_id", F.lit(code).alias("code"), "n")


def works_report(works: DataFrame, manuscripts: DataFrame, cleaned: DataFrame) -> list[DataFrame]:
    """``works``: work_id, status, schema_version; ``manuscripts``: work_id, layer; ``cleaned``: work_id of cleaning reports."""
    own = {"unknown_status": ~F.coalesce(F.col("status").isin(*WORK_STATES), F.lit(False)), "missing_schema_version": is_blank(F.col("schema_version"))}
    layer = lambda name: manuscripts.where(F.col("layer") == name)
    return [
        counted(works, own),
        missing(works, layer("raw"), "raw_manuscript_missing"),
        missing(works, layer("clean"), "clean_manuscript_missing"),
        missing(works, cleaned, "cleaning_report_missing"),
    ]


def json_errors(rows: DataFrame, code: str = "json_errors") -> DataFrame:
    """Works with lines that are no JSON, and how many: ``rows`` as ``sources.lines.jsonl_rows`` gives them, with work_id."""
    return rows.where("error is not null").groupBy("work_id").agg(F.count("*").alias("n")).select("work_id", F.lit(code).alias("code"), "n")


def clean_artifacts(lines: DataFrame) -> DataFrame:
    """Works whose clean manuscript (work_id, line) still shows artifacts, and how many."""
    hits = reduce(lambda a, b: a + b, (F.regexp_count("line", F.lit(p)) for p in CLEAN_ARTIFACTS.values()))
    n = lines.groupBy("work_id").agg(F.sum(hits).alias("n")).where("n > 0")
    return n.select("work_id", F.lit("clean_artifacts_left").alias("code"), "n")


def malformed_block(block: Column) -> Column:
    """A block of a passage without an id, or whose box has not four numbers."""
    return is_blank(block["block_id"]) | block["bbox"].isNull() | (F.size(block["bbox"]) != 4)


def passages_report(passages: DataFrame) -> list[DataFrame]:
    """``passages``: work_id, id, sequence, lang, text, review_status, source_blocks[block_id, bbox, pdf_page]."""
    text, blocks = F.col("text"), F.col("source_blocks")
    has = lambda p: F.coalesce(text.rlike(p), F.lit(False))
    rows = counted(
        passages,
        {
            "numeric_only": F.coalesce(T.is_noise(text), F.lit(False)),
            "artifacts_left": reduce(lambda a, b: a | b, (has(p) for p in ARTIFACTS.values())),
            "block_provenance": blocks.isNull() | (F.size(blocks) <= 0) | F.exists(blocks, malformed_block),
            "missing_review_status": is_blank(F.col("review_status")),
            "missing_lang": is_blank(F.col("lang")),
            "long_passages": F.coalesce(F.length(text) > 3000, F.lit(False)),
            "short_passages": F.coalesce(F.length(text) < 12, F.lit(False)),
            "missing_fields": reduce(lambda a, b: a | b, (F.col(c).isNull() for c in PASSAGE_FIELDS)),
        },
    )
    doubled = passages.groupBy("work_id", "id").agg(F.count("*").alias("n")).where("n > 1")
    doubled = doubled.groupBy("work_id").agg(F.count("*").alias("n")).select("work_id", F.lit("duplicate_ids").alias("code"), "n")
    # numbers 1 to the count that no passage has, and numbers that several have
    placed = passages.groupBy("work_id", "sequence").agg(F.count("*").alias("k"))
    sizes = passages.groupBy("work_id").agg(F.count("*").alias("size"))
    seen = placed.join(sizes, "work_id").groupBy("work_id", "size").agg(F.count_if(F.col("sequence").between(1, F.col("size"))).alias("within"), F.count_if((F.col("k") > 1) & F.col("sequence").isNotNull()).alias("twice"))
    gaps = seen.select("work_id", F.lit("sequence_gaps_or_duplicates").alias("code"), (F.col("size") - F.col("within") + F.col("twice")).alias("n")).where("n > 0")
    return [rows, doubled, gaps]


def editions_report(works: DataFrame, passages: DataFrame, pages: DataFrame) -> list[DataFrame]:
    """``works``: work_id, default_edition; ``passages``: work_id, id, edition_refs (map to struct<page,label>), citation
    (struct<edition_id,label>); ``pages``: work_id, edition, id, page, label."""
    known = passages.select("work_id", "id", "edition_refs", "citation").dropDuplicates(["work_id", "id"])
    editions = pages.select("work_id", "edition").distinct()
    mapped = pages.groupBy("work_id", "edition", "id").agg(F.count("*").alias("k"), F.min(F.struct("page", "label")).alias("ref"))
    wanted = editions.join(known, "work_id")
    both = wanted.join(mapped.withColumn("mapped", F.lit(True)), ["work_id", "edition", "id"], "full")
    stray = both.where("mapped and citation is null and edition_refs is null").join(known.select("work_id", "id"), ["work_id", "id"], "left_anti")
    ref = F.element_at("edition_refs", F.col("edition"))
    differs = ~F.struct(ref["page"], ref["label"]).eqNullSafe(F.struct(F.col("ref.page"), F.col("ref.label")))
    held = both.join(known.select("work_id", "id", F.lit(True).alias("known")), ["work_id", "id"], "left")
    ids = counted(both.select("work_id", F.coalesce("k", F.lit(0)).alias("k")), {"page_map_ids_wrong": F.col("k") != 1})
    extra = stray.where("k = 1").groupBy("work_id").agg(F.count("*").alias("n")).select("work_id", F.lit("page_map_ids_wrong").alias("code"), "n")
    ids = ids.unionByName(extra).groupBy("work_id", "code").agg(F.sum("n").alias("n"))
    refs = counted(held.where("mapped and known"), {"edition_refs_wrong": F.col("edition_refs").isNull() | ref.isNull() | differs})
    public = held.join(works.select("work_id", F.col("default_edition").alias("edition")), ["work_id", "edition"], "left_semi").where("mapped and known")
    cited = F.col("citation.edition_id").eqNullSafe(F.col("edition")) & F.col("citation.label").eqNullSafe(F.col("ref.label"))
    return [ids, refs, counted(public, {"public_citation_wrong": F.col("citation").isNull() | ~cited})]


def translations_report(translations: DataFrame, passages: DataFrame) -> list[DataFrame]:
    """``translations``: the fields above and dir_lang, the language of the folder; ``passages``: work_id, id, sequence, text, citation."""
    source = passages.select("work_id", F.col("id").alias("source_passage_id"), F.col("sequence").alias("_sequence"), F.col("text").alias("_text"), F.col("citation").alias("_citation"), F.lit(True).alias("_known"))
    rows = translations.join(source.dropDuplicates(["work_id", "source_passage_id"]), ["work_id", "source_passage_id"], "left")
    known, lang = F.coalesce("_known", F.lit(False)), F.coalesce("lang", "dir_lang")
    blank = reduce(lambda a, b: a | b, (is_blank(F.col(c)) for c in TRANSLATION_FIELDS if c not in ("section_path", "source_citation", "source_sequence")))
    blank = blank | F.col("section_path").isNull() | F.col("source_citation").isNull() | F.col("source_sequence").isNull()
    incomplete = blank | ~F.coalesce(F.col("lang") == F.col("dir_lang"), F.lit(False)) | ~F.coalesce(F.col("translation_status").isin(*TRANSLATION_STATES), F.lit(False))
    tests = {
        "translation_source_unknown": ~known,
        "translation_incomplete": incomplete,
        "translation_source_uncited": known & F.col("_citation").isNull(),
        "source_citation_drift": known & ~F.col("source_citation").eqNullSafe(F.col("_citation")),
        "translation_drift": known & ~F.col("source_sequence").eqNullSafe(F.col("_sequence")) | ~F.coalesce(F.col("id") == F.concat_ws(".", "source_passage_id", "dir_lang"), F.lit(False)),
        "source_letters_left": F.coalesce((lang != "ar") & (T.arabic_letters(F.col("text")) > 0), F.lit(False)),
        "length_ratio_outlier": known & ~is_blank(F.col("text")) & F.coalesce(T.length_outlier(F.col("text"), F.coalesce("_text", F.lit(""))), F.lit(False)),
    }
    twice = lambda c: translations.groupBy("work_id", "dir_lang", F.col(c).alias("ref")).agg(F.count("*").alias("k")).where("k > 1 and ref is not null").select("work_id")
    doubled = twice("id").unionByName(twice("source_passage_id")).groupBy("work_id").agg(F.count("*").alias("n"))
    return [counted(rows, tests), doubled.select("work_id", F.lit("translation_duplicates").alias("code"), "n")]


def outline_report(headings: DataFrame, toc: DataFrame, skipped: DataFrame, doubled: DataFrame) -> list[DataFrame]:
    """``headings``: work_id, level, key; ``toc``: work_id, key; ``skipped``, ``doubled``: work_id of skipped levels and of
    adjacent duplicates. A table of contents counts as a warning when more than 5 entries and 3 % find no heading."""
    levels = headings.groupBy("work_id").agg(*(F.count_if(F.col("level") == k).alias(f"h{k}") for k in (1, 2, 3)))
    shape = counted(levels, {"flat_outline": (F.col("h1") > 40) & (F.col("h2") < 5), "detailed_outline": (F.col("h2") > 1000) & (F.col("h3") > 1000)})
    count = lambda rows, code: rows.groupBy("work_id").agg(F.count("*").alias("n")).select("work_id", F.lit(code).alias("code"), "n")
    a, b = (x.groupBy("work_id", "key").agg(F.count("*").alias(n)) for x, n in ((toc, "entries"), (headings, "found")))
    left = a.join(b, ["work_id", "key"], "left").groupBy("work_id").agg(F.sum("entries").alias("entries"), F.sum(F.greatest(F.col("entries") - F.coalesce("found", F.lit(0)), F.lit(0))).alias("n"))
    level = F.when((F.col("n") > 5) & (F.col("n") / F.col("entries") > 0.03), "warn").otherwise("info")
    entries = left.where("n > 0").select("work_id", F.lit("toc_unmatched").alias("code"), "n", level.alias("severity"))
    rest = report([shape, count(skipped, "skipped_levels"), count(doubled, "adjacent_duplicate_headings")])
    return [rest, report([entries])]


def index(found: DataFrame, works: DataFrame, passages: DataFrame, headings: DataFrame) -> DataFrame:
    """One row a work: status, passages, headings, shortest and longest text, and findings by severity."""
    ended = status(found.where("severity <> 'metric'"), "work_id").withColumnRenamed("status", "worst")
    sizes = passages.groupBy("work_id").agg(F.count("*").alias("passages"), F.min(F.length("text")).cast("long").alias("len_min"), F.max(F.length("text")).cast("long").alias("len_max"))
    titles = headings.groupBy("work_id").agg(F.count("*").alias("headings"))
    out = works.select("work_id").join(sizes, "work_id", "left").join(titles, "work_id", "left").join(ended, "work_id", "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return out.select("work_id", F.coalesce("worst", F.lit("ok")).alias("status"), zero("passages"), zero("headings"), "len_min", "len_max", zero("n_fail"), zero("n_warn"), zero("n_info"))


def work_index(found: DataFrame, works: DataFrame, counts: dict[str, DataFrame]) -> DataFrame:
    """One row a work: status, number of findings, and a column for each entry of ``counts``, a table (work_id, n) of which
    the n of a work are summed; a work without any has 0. Every entry is aggregated first, so nothing multiplies."""
    out = works.select("work_id").join(status(found.where("severity <> 'metric'"), "work_id"), "work_id", "left")
    out = out.select("work_id", F.coalesce("status", F.lit("ok")).alias("status"), F.coalesce(F.col("n_fail") + F.col("n_warn") + F.col("n_info"), F.lit(0)).alias("findings"))
    for name, rows in counts.items():
        n = rows.groupBy("work_id").agg(F.sum("n").cast("long").alias("_n"))
        out = out.join(n, "work_id", "left").withColumn(name, F.coalesce("_n", F.lit(0))).drop("_n")
    return out
