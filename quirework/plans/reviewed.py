"""Queries on what reviewers and readers are shown; documents are passages, with cases planted by their ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quirework.functions import markup
from quirework.functions import text as T
from quirework.operators import cleaning, report, review, selection, sequence, spans
from quirework.plans.registry import register
from quirework.plans.reports import _WORK, _works
from quirework.session import shared_path, table
from quirework.sources import lines as numbered
from quirework.sources import works
from quirework.sources.readers import text_lines

_PIECES = ["", "بسم الله ", "الفصل ", "ومنها ", "ومن ذلك ", "قال  رسول ", "روى ", "اللهم صل ", "صلى الله ", "كلمة", "الحديث "]
_SECTIONS = ["", "عن المؤلف", "مقدمة الكتاب", "القصيدة", "الصلاة على"]
_CUTS = [100000, 40, 120, 400, 700, 1700, 5]


def _sql_list(values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


@register(
    "review_categories",
    f"""
    WITH d AS (SELECT doc_id, {_sql_list(_PIECES)}[doc_id % {len(_PIECES)} + 1] || substring(coalesce(text, ''), 1, {_CUTS}[doc_id % {len(_CUTS)} + 1]) AS t, {_sql_list(_SECTIONS)}[doc_id // 7 % {len(_SECTIONS)} + 1] AS s FROM documents),
    f AS (SELECT doc_id, unnest(list_filter([
      CASE WHEN doc_id % 9 = 1 THEN 'already_translated' END, CASE WHEN contains(s, 'عن المؤلف') AND length(t) >= 80 THEN 'author_context' END, CASE WHEN contains(t, 'بسم') AND contains(t, 'الل') THEN 'basmalah' END,
      CASE WHEN contains(s, 'مقدمة') AND length(t) >= 450 THEN 'muqaddimah_long' END, CASE WHEN length(t) <= 180 AND regexp_matches(t, 'الفصل|القسم|الصلاة') THEN 'heading_like' END, CASE WHEN length(t) < 12 THEN 'short_edge' END,
      CASE WHEN (starts_with(t, 'ومنها') OR starts_with(t, 'ومن ذلك')) AND length(t) BETWEEN 40 AND 500 THEN 'benefit_list' END, CASE WHEN length(t) BETWEEN 300 AND 1800 AND regexp_matches(t, 'قال\\s+رسول|روى|رواه|الحديث|الأحاديث') THEN 'hadith_discussion' END,
      CASE WHEN length(t) BETWEEN 80 AND 700 AND regexp_matches(t, '(?:اللَّهُمَّ|اللهم)\\s+صَل|صلى\\s+الل') THEN 'salawat_short' END, CASE WHEN length(t) > 1800 AND regexp_matches(t, '(?:اللَّهُمَّ|اللهم)\\s+صَل|صلى\\s+الل') THEN 'salawat_long' END,
      CASE WHEN contains(s, 'القصيدة') AND length(t) BETWEEN 80 AND 800 THEN 'poetry' END], lambda x: x IS NOT NULL)) AS category FROM d
      UNION ALL SELECT doc_id, 'longest_' || row_number() OVER (ORDER BY length(t) DESC, doc_id) FROM (SELECT * FROM d ORDER BY length(t) DESC, doc_id LIMIT 3))
    SELECT category, count(*)::BIGINT AS n, min(doc_id)::BIGINT AS first_id, sum(doc_id)::BIGINT AS ids FROM f GROUP BY category
    """,
)
def review_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every category of every passage, counted, and the three longest."""
    docs = table(spark, sf_dir, "documents")
    pick = lambda values, at: F.get(F.array(*map(F.lit, values)), at.cast("int"))
    cut = F.substring(F.coalesce("text", F.lit("")), F.lit(1), pick(_CUTS, F.col("doc_id") % len(_CUTS)))
    rows = docs.select("doc_id", F.concat(pick(_PIECES, F.col("doc_id") % len(_PIECES)), cut).alias("text"), pick(_SECTIONS, F.floor(F.col("doc_id") / 7) % len(_SECTIONS)).alias("section"))
    each = rows.select("doc_id", F.explode(review.categories(F.col("text"), F.col("section"), F.col("doc_id") % 9 == 1)).alias("category"))
    found = each.unionByName(review.longest(rows, "doc_id"))
    return found.groupBy("category").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_id"), F.sum("doc_id").alias("ids"))


_TITLES = ["", "عن المؤلف", "مقدمة", "يوم الجمعة", "شفاعة", "التحذير", "الفوائد", "المنافع", "تفسير", "آية", "الأحاديث", "الصلاة", "القصيدة", "القسم"]


@register(
    "section_themes",
    f"""
    WITH s AS (SELECT doc_id, {_sql_list(_TITLES)}[doc_id % {len(_TITLES)} + 1] AS t, {_sql_list(_TITLES)}[doc_id // 14 % {len(_TITLES)} + 1] AS p, doc_id % 8 AS k FROM documents),
    j AS (SELECT *, p || ' ' || t AS x FROM s)
    SELECT theme, count(*)::BIGINT AS n, sum(doc_id)::BIGINT AS ids FROM (SELECT doc_id, CASE WHEN contains(x, 'عن المؤلف') THEN 'biographical_preface' WHEN contains(x, 'مقدمة') THEN 'opening_invocation' WHEN contains(x, 'الجمعة') THEN 'friday_salawat'
      WHEN contains(x, 'شفاع') THEN 'hope_and_intercession' WHEN contains(x, 'التحذير') THEN 'serious_admonition' WHEN contains(x, 'الفوائد') OR contains(x, 'المنافع') THEN 'benefits_and_fruits'
      WHEN contains(x, 'تفسير') OR contains(x, 'آية') OR k = 1 THEN 'quranic_reflection' WHEN contains(x, 'الأحاديث') OR k IN (2, 3) THEN 'hadith_transmission' WHEN contains(x, 'الصلاة') THEN 'salawat_formula'
      WHEN contains(x, 'القصيدة') OR k = 4 THEN 'poetic_closing' WHEN contains(x, 'القسم') THEN 'book_structure' ELSE 'modern_turath' END AS theme FROM j) GROUP BY theme
    """,
)
def section_themes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Themes of sections by title, path and the kinds of passages in them."""
    k, pick = F.col("doc_id") % 8, lambda at: F.get(F.array(*map(F.lit, _TITLES)), at.cast("int"))
    kind = F.when(k == 1, "segment:ayah").when(k == 2, "hadith").when(k == 3, "segment:hadith").when(k == 4, "poem").otherwise("body")
    counts = F.create_map(kind, F.when(k == 5, 0).otherwise(2))
    rows = table(spark, sf_dir, "documents").select("doc_id", pick(F.col("doc_id") % len(_TITLES)).alias("title"), F.array(pick(F.floor(F.col("doc_id") / 14) % len(_TITLES))).alias("path"), counts.alias("counts"))
    themed = rows.select("doc_id", review.theme(F.col("title"), F.col("path"), F.col("counts")).alias("theme"))
    return themed.groupBy("theme").agg(F.count("*").alias("n"), F.sum("doc_id").alias("ids"))


@register(
    "problem_pages",
    """
    WITH p AS (SELECT CASE WHEN doc_id % 11 = 4 THEN NULL ELSE doc_id // 6 + 1 END AS page, doc_id, CASE WHEN doc_id % 37 = 5 THEN '12. (3)' WHEN doc_id % 37 = 6 THEN 'Shamela ' || text ELSE coalesce(text, '') END AS t FROM documents),
    r AS (SELECT page, unnest(list_filter([CASE WHEN length(t) < 12 THEN 'short_passage' END, CASE WHEN length(t) > 3000 THEN 'long_passage' END, CASE WHEN regexp_matches(replace(t, ' ', ''), '^[0-9.()،؛:؟!\\-ـ]+$') THEN 'numeric_only' END, CASE WHEN contains(t, 'Shamela') THEN 'artifact' END], lambda x: x IS NOT NULL)) AS reason FROM p
      UNION ALL SELECT doc_id // 6 + 1, 'toc_not_found' FROM documents WHERE doc_id % 13 = 2),
    n AS (SELECT page, reason, count(*) AS n FROM r WHERE page IS NOT NULL GROUP BY ALL)
    SELECT page::INTEGER AS page, sum(n)::BIGINT AS score, string_agg(reason || '=' || n, ', ' ORDER BY reason || '=' || n) AS reasons FROM n GROUP BY page ORDER BY score DESC, page LIMIT 25
    """,
)
def problem_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 25 pages with most problems, of five kinds."""
    docs = table(spark, sf_dir, "documents")
    page = (F.floor(F.col("doc_id") / 6) + 1).cast("string")
    k = F.col("doc_id") % 37
    text = F.when(k == 5, "12. (3)").when(k == 6, F.concat(F.lit("Shamela "), "text")).otherwise(F.col("text"))
    blocks = F.array(F.struct(F.when(F.col("doc_id") % 11 == 4, "none").otherwise(page).alias("pdf_page")))
    rows = docs.select("doc_id", text.alias("text"), blocks.alias("source_blocks"))
    unmatched = docs.where("doc_id % 13 = 2").select(page.alias("page"))
    return review.problem_pages(rows, unmatched, F.coalesce(F.contains("text", F.lit("Shamela")), F.lit(False)))


@register(
    "cleaning_tasks",
    f"""
    WITH l AS (SELECT {_WORK} AS work_id, doc_id, lang, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS n FROM documents),
    h AS (SELECT *, unnest(list_filter([CASE WHEN contains(line, '*') THEN 'star_leftover' END, CASE WHEN regexp_matches(line, '[{{}}]') THEN 'brace_marker' END], lambda x: x IS NOT NULL)) AS pattern FROM l),
    k AS (SELECT *, CASE WHEN doc_id % 5 = 1 THEN 'lost' ELSE 'D' || doc_id END AS pid FROM h)
    SELECT work_id || '__cleaning_suspicious__' || substring(sha1(work_id || ':cleaning_suspicious:cleaning:' || n || ':' || pid || ':' || pattern), 1, 16) AS task_id, work_id, 'Review cleaning artifact in ' || pid AS title,
      CASE WHEN doc_id % 5 <> 1 THEN coalesce(lang, '') ELSE '' END AS section, CASE WHEN doc_id % 5 <> 1 THEN 'p. ' || doc_id ELSE '' END AS citation FROM k
    """,
)
def cleaning_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suspicious lines as tasks, with section and citation of the passages that are known."""
    docs = table(spark, sf_dir, "documents").withColumn("work_id", F.expr(_WORK))
    name = F.when(F.col("doc_id") % 5 == 1, "lost").otherwise(F.concat(F.lit("D"), F.col("doc_id").cast("string")))
    lines = text_lines(docs.select(F.struct("work_id", "doc_id").alias("k"), "text"), "k")
    marks = F.array_compact(F.array(F.when(F.contains("line", F.lit("*")), "star_leftover"), F.when(F.col("line").rlike("[{}]"), "brace_marker")))
    found = lines.select("k.work_id", "k.doc_id", "line_no", F.explode(marks).alias("pattern"), F.col("line").alias("text")).withColumn("passage_id", name)
    passages = docs.select(F.concat(F.lit("D"), F.col("doc_id").cast("string")).alias("id"), F.array(F.coalesce("lang", F.lit(""))).alias("section_path"), F.concat(F.lit("p. "), F.col("doc_id").cast("string")).alias("citation")).dropDuplicates(["id"])
    tasks = review.sample_tasks(found, passages)
    return tasks.select("task_id", "work_id", "title", F.array_join("section_path", " > ").alias("section"), F.col("source_citation_label").alias("citation"))


@register(
    "report_inputs",
    f"""
    WITH d AS (SELECT *, {_WORK} AS work_id FROM documents),
    l AS (SELECT work_id, unnest(string_split(CASE WHEN doc_id % 19 = 3 THEN '᧦ ـ * ' || text ELSE text END, chr(10))) AS line FROM d),
    c AS (SELECT work_id, sum(len(regexp_extract_all(line, '[᧦ـ*]')) + len(regexp_extract_all(line, '[\\x{{200E}}\\x{{200F}}\\x{{202A}}-\\x{{202E}}\\x{{2066}}-\\x{{2069}}\\x{{FEFF}}]'))
      + len(regexp_extract_all(line, '(?i)runtime\\s+(?:VBScript|Script)|Microsoft.*error|Subscript.*out\\s+of\\s+range|/Tafseer/'))) AS n FROM l GROUP BY work_id)
    SELECT work_id, code, severity, n::BIGINT AS n FROM (SELECT work_id, 'json_errors' AS code, 'fail' AS severity, count(*) AS n FROM d WHERE doc_id % 29 = 3 GROUP BY work_id
      UNION ALL SELECT work_id, 'translation_json_errors', 'fail', count(*) FROM d WHERE doc_id % 31 = 3 GROUP BY work_id UNION ALL SELECT work_id, 'clean_artifacts_left', 'warn', n FROM c WHERE n > 0)
    """,
)
def report_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Broken lines of passages and translations as read from files, and artifacts left in clean manuscripts."""
    docs = table(spark, sf_dir, "documents").withColumn("work_id", F.expr(_WORK))

    def read(modulus: int) -> DataFrame:
        good = F.to_json(F.struct(F.col("doc_id").alias("id"), "text"))
        broken = F.when(F.col("doc_id") % modulus == 3, F.substring(good, F.lit(1), F.length(good) - 1)).otherwise(good)
        path = shared_path(spark, "report-inputs")
        docs.select("work_id", broken.alias("value")).write.partitionBy("work_id").text(path)
        rows = numbered.jsonl_rows(spark, f"{path}/*", StructType.fromDDL("id long, text string"))
        return rows.withColumn("work_id", F.url_decode(F.regexp_extract("path", "/work_id=([^/]*)/", 1)))

    marked = F.when(F.col("doc_id") % 19 == 3, F.concat(F.lit("᧦ ـ * "), "text")).otherwise(F.col("text"))
    lines = text_lines(docs.select("work_id", marked.alias("text")), "work_id")
    return report.report([report.json_errors(read(29)), report.json_errors(read(31), "translation_json_errors"), report.clean_artifacts(lines)])


_COUNTS = ["passages", "raw_headings", "clean_headings", "clean_artifacts", "clean_suspicious", "page_maps", "page_refs", "citations", "translations", "toc_missing", "source_pages"]


@register(
    "work_index",
    f"""
    WITH d AS (SELECT *, {_WORK} AS work_id FROM documents), w AS (SELECT DISTINCT work_id, CAST(coalesce(nullif(regexp_extract(work_id, '[0-9]+'), ''), '0') AS INTEGER) AS no FROM d)
    SELECT w.work_id, CASE WHEN no % 5 = 1 OR no % 7 = 1 THEN 'warn' ELSE 'ok' END AS status, ((no % 5 = 1)::INTEGER + (no % 7 = 1)::INTEGER)::BIGINT AS findings, count(*)::BIGINT AS passages,
      count(*) FILTER (WHERE doc_id % 4 = 1)::BIGINT AS raw_headings, count(*) FILTER (WHERE doc_id % 4 = 1 AND doc_id % 8 <> 1)::BIGINT AS clean_headings, coalesce(sum(length(text) - length(replace(text, '*', ''))), 0)::BIGINT AS clean_artifacts,
      count(*) FILTER (WHERE contains(text, '{{'))::BIGINT AS clean_suspicious, (no % 3)::BIGINT AS page_maps, count(*) FILTER (WHERE doc_id % 6 <> 2)::BIGINT AS page_refs, count(*) FILTER (WHERE doc_id % 6 = 3)::BIGINT AS citations,
      count(*) FILTER (WHERE doc_id % 10 < 7)::BIGINT AS translations, count(*) FILTER (WHERE doc_id % 23 = 1)::BIGINT AS toc_missing, count(DISTINCT doc_id // 4)::BIGINT AS source_pages FROM w JOIN d USING (work_id) GROUP BY w.work_id, no
    """,
)
def work_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a work with the index's metrics, each from a table of its own."""
    all_works, docs = _works(spark, sf_dir), table(spark, sf_dir, "documents").withColumn("work_id", F.expr(_WORK))
    layers = all_works.select("work_id", F.explode(F.array(F.lit("raw"), F.lit("clean"))).alias("layer"))
    found = report.report(report.works_report(all_works, layers, all_works))
    rows = lambda test, n=F.lit(1): docs.where(test).select("work_id", n.alias("n"))
    counts = {
        "passages": rows("true"),
        "raw_headings": rows("doc_id % 4 = 1"),
        "clean_headings": rows("doc_id % 4 = 1 AND doc_id % 8 <> 1"),
        "clean_artifacts": rows("true", F.coalesce(T.count_pattern(F.col("text"), "*", literal=True), F.lit(0))),
        "clean_suspicious": rows("contains(text, '{')"),
        "page_maps": all_works.select("work_id", (F.col("no") % 3).alias("n")),
        "page_refs": rows("doc_id % 6 <> 2"),
        "citations": rows("doc_id % 6 = 3"),
        "translations": rows("doc_id % 10 < 7"),
        "toc_missing": rows("doc_id % 23 = 1"),
        "source_pages": docs.select("work_id", F.floor(F.col("doc_id") / 4).alias("page")).distinct().select("work_id", F.lit(1).alias("n")),
    }
    return report.work_index(found, all_works, {name: counts[name] for name in _COUNTS})


@register(
    "entity_profiles",
    """
    WITH e AS (SELECT user_id::VARCHAR AS t, event_type AS a, (props->>'k') AS k FROM events),
    c AS (SELECT t, count(*) AS n FROM e GROUP BY t ORDER BY n DESC, t LIMIT 10),
    p AS (SELECT DISTINCT t, x FROM (SELECT t, 'type: ' || a AS x FROM e UNION ALL SELECT t, 'k: ' || k FROM e WHERE k IS NOT NULL))
    SELECT t AS extraction_text, n::BIGINT AS n, string_agg(x, ', ' ORDER BY x) AS attributes FROM c JOIN p USING (t) GROUP BY t, n
    """,
)
def entity_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten users with most events, with everything their events say of them."""
    k = F.get_json_object("props", "$.k")
    given = F.map_filter(F.create_map(F.lit("type"), F.col("event_type"), F.lit("k"), k), lambda n, v: v.isNotNull())
    rows = table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("extraction_text"), given.alias("attributes"))
    return review.entity_profiles(rows).withColumn("attributes", F.array_join("attributes", ", "))


@register(
    "attribute_warnings",
    """
    WITH e AS (SELECT event_type AS t, CASE WHEN event_id % 3 <> 0 THEN (event_id % 7)::VARCHAR END AS g FROM events)
    SELECT g AS "group", count(*)::BIGINT AS n FROM e WHERE g IS NOT NULL GROUP BY g UNION ALL SELECT 'missing group: ' || t, count(*)::BIGINT FROM e WHERE g IS NULL GROUP BY t
    """,
)
def attribute_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by an attribute that two in three have, and warnings for those that lack it."""
    given = F.when(F.col("event_id") % 3 != 0, F.create_map(F.lit("group"), (F.col("event_id") % 7).cast("string"))).otherwise(F.create_map().cast("map<string,string>"))
    groups, warned = review.grouped_by_attribute(table(spark, sf_dir, "events").select(F.col("event_type").alias("extraction_text"), given.alias("attributes")), "group")
    return groups.select("group", "n").unionByName(warned.select(F.col("warning").alias("group"), "n"))


@register(
    "sections_of_level",
    """
    WITH p AS (SELECT 'w' AS work_id, doc_id, CASE WHEN doc_id % 3 = 0 THEN [lang] WHEN doc_id % 3 = 1 THEN [lang, source] ELSE [lang, source, 'end'] END AS path FROM documents WHERE lang IS NOT NULL AND source IS NOT NULL)
    SELECT work_id || '__section__' || substring(sha1(work_id || ':section:' || array_to_string(path, ' > ')), 1, 16) AS id, path[-1] AS title, len(path)::INTEGER AS level, array_to_string(path, ' > ') AS path, 'D' || min(doc_id) AS first_passage_id, count(*)::BIGINT AS passage_count
    FROM p WHERE len(path) = 2 AND starts_with(array_to_string(path, ' > '), 'e') GROUP BY work_id, path
    """,
)
def sections_of_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sections of the second level whose path begins with a prefix."""
    k = F.col("doc_id") % 3
    path = F.when(k == 0, F.array("lang")).when(k == 1, F.array("lang", "source")).otherwise(F.array(F.col("lang"), F.col("source"), F.lit("end")))
    rows = table(spark, sf_dir, "documents").where("lang is not null and source is not null").select(F.lit("w").alias("work_id"), F.concat(F.lit("D"), F.col("doc_id").cast("string")).alias("id"), F.col("doc_id").alias("sequence"), path.alias("section_path"))
    return review.sections(rows, level=2, prefix="e").drop("work_id").withColumn("path", F.array_join("path", " > "))


@register(
    "translations_page",
    """
    WITH q AS (SELECT conv_id || '.' || turn AS id, conv_id * 1000 + turn AS seq FROM conversations WHERE role = 'user'),
    t AS (SELECT conv_id || '.' || (turn - 1) AS src, conv_id || '.' || turn AS id, CASE WHEN turn % 4 = 1 THEN 'draft' ELSE 'reviewed' END AS status FROM conversations WHERE role = 'assistant')
    SELECT t.id AS id, q.id AS source_passage_id, seq::BIGINT AS sequence FROM t JOIN q ON q.id = t.src WHERE status = 'draft' AND seq > 3000 ORDER BY seq, t.id LIMIT 50
    """,
)
def translations_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page of draft answers as translations, in the order of their questions, after a cursor."""
    turns = table(spark, sf_dir, "conversations")
    key = lambda turn: F.concat_ws(".", F.col("conv_id").cast("string"), turn.cast("string"))
    asked = turns.where("role = 'user'").select(key(F.col("turn")).alias("id"), (F.col("conv_id") * 1000 + F.col("turn")).alias("sequence"))
    status = F.when(F.col("turn") % 4 == 1, "draft").otherwise("reviewed")
    told = turns.where("role = 'assistant'").select(key(F.col("turn") - 1).alias("source_passage_id"), key(F.col("turn")).alias("id"), status.alias("status"), F.lit("en").alias("lang"))
    return review.translations_of(told, asked, "en", status="draft", cursor=3000).select("id", "source_passage_id", "sequence")


@register(
    "chunk_contexts",
    f"""
    WITH c AS (SELECT doc_id, regexp_extract_all(text, '(?s)(.{{1,399}}(?:{T.SPACE}|$)|.{{1,400}})') AS p FROM documents WHERE text IS NOT NULL),
    e AS (SELECT doc_id, p, unnest(range(1, len(p) + 1)) AS i FROM c)
    SELECT doc_id, (i - 1)::BIGINT AS chunk_no, sha1(p[i]) AS digest, CASE WHEN i = 1 THEN '' ELSE right(p[i - 1], 30) END AS before FROM e
    """,
)
def chunk_contexts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks of 400 characters at most, each with the end of the one before."""
    cut = spans.chunks(table(spark, sf_dir, "documents").select("doc_id", "text").where("text is not null"), "doc_id", "text", 400)
    return review.with_context(cut, "doc_id", 30).select("doc_id", F.col("chunk_no").cast("long").alias("chunk_no"), F.sha1("chunk").alias("digest"), "before")


@register(
    "opened_passages",
    """
    WITH b AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS n FROM documents),
    p AS (SELECT *, n * 20 + CASE WHEN (doc_id + n) % 5 = 0 THEN 9 ELSE 0 END AS y0, CASE WHEN (doc_id + n) % 7 = 0 THEN 160 ELSE 90 END AS x0 FROM b),
    l AS (SELECT *, lag(y0 + 10) OVER w AS y1, lag(x0) OVER w AS px FROM p WINDOW w AS (PARTITION BY doc_id ORDER BY n))
    SELECT doc_id, n::BIGINT AS line_no FROM l WHERE px IS NULL OR y0 - y1 > 18 OR px > 150 OR starts_with(line, 'قال ')
    """,
)
def opened_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as blocks of a page that open a passage: the first, after a gap, after an indented one, or by their words."""
    from pyspark.sql import Window

    lines = text_lines(table(spark, sf_dir, "documents")).withColumns(
        {
            "y0": F.col("line_no") * 20 + F.when((F.col("doc_id") + F.col("line_no")) % 5 == 0, 9).otherwise(0),
            "x0": F.when((F.col("doc_id") + F.col("line_no")) % 7 == 0, 160).otherwise(90),
        }
    )
    by = Window.partitionBy("doc_id").orderBy("line_no")
    before = lines.withColumns({"_y1": F.lag(F.col("y0") + 10).over(by), "_x0": F.lag("x0").over(by)})
    return before.where(sequence.new_passage(F.col("line"), F.col("y0"), F.col("_y1"), F.col("_x0"))).select("doc_id", "line_no")


@register(
    "first_suspicious",
    """
    WITH l AS (SELECT lang, doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS n FROM documents),
    h AS (SELECT lang, doc_id * 1048576 + n AS line_no, (regexp_matches(line, '\\*'))::INTEGER + regexp_matches(line, '[A-Za-z]{3,}')::INTEGER + regexp_matches(line, '[{}]')::INTEGER AS k FROM l),
    c AS (SELECT *, coalesce(sum(k) OVER (PARTITION BY lang ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM h WHERE k > 0)
    SELECT lang, count(*)::BIGINT AS lines, sum(k)::BIGINT AS hits, max(line_no)::BIGINT AS last_line FROM c WHERE before < 40 GROUP BY lang
    """,
)
def first_suspicious(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first suspicious lines of each language, while those before have fewer than 40 hits."""
    lines = text_lines(table(spark, sf_dir, "documents").select(F.struct("lang", "doc_id").alias("k"), "text"), "k")
    placed = lines.select("k.lang", (F.col("k.doc_id") * (1 << 20) + F.col("line_no")).alias("line_no"), "line")
    found = cleaning.suspicious(placed, "lang", "line_no", "line", limit=40).where(F.col("pattern").isin("star_leftover", "latin_word", "brace_marker"))
    return found.groupBy("lang").agg(F.countDistinct("line_no").alias("lines"), F.count("*").alias("hits"), F.max("line_no").alias("last_line"))


_SIGNALS = ["", "قال تعالى", "قال رسول الله", "قال النووي", "", "كلمة"]
_ROLES = ["body", "matn", "quote", "body", "body", "body", "poem", "body", "ayat", "body", "body"]


@register(
    "candidate_reasons",
    f"""
    WITH d AS (SELECT doc_id, {_sql_list(_SIGNALS)}[doc_id % 6 + 1] || ' ' || coalesce(text, '') AS t, {_sql_list(_ROLES)}[doc_id % 11 + 1] AS r, CASE WHEN doc_id % 13 = 3 THEN 'القصيدة' ELSE '' END AS s FROM documents),
    c AS (SELECT doc_id, CASE WHEN r <> 'body' THEN 'heuristic role=' || r WHEN contains(t, 'قال تعالى') THEN 'contains Qur''an-like signal' WHEN contains(t, 'قال رسول الله') THEN 'contains hadith/transmission signal'
      WHEN contains(t, 'قال النووي') THEN 'contains quote/source attribution signal' WHEN contains(s, 'القصيدة') THEN 'poetry/qasidah context' WHEN length(t) > 2500 THEN 'long passage may need split/table/editorial treatment' ELSE 'none' END AS reason FROM d)
    SELECT reason, count(*)::BIGINT AS n, sum(doc_id)::BIGINT AS ids FROM c GROUP BY reason
    """,
)
def candidate_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All branches of what makes a passage worth enriching, counted."""
    pick = lambda values, n: F.get(F.array(*map(F.lit, values)), (F.col("doc_id") % n).cast("int"))
    text = F.concat(pick(_SIGNALS, 6), F.lit(" "), F.coalesce("text", F.lit("")))
    section = F.when(F.col("doc_id") % 13 == 3, "القصيدة").otherwise("")
    reason = selection.candidate_reason(F.col("text"), F.col("role"), F.col("section"))
    rows = table(spark, sf_dir, "documents").select("doc_id", text.alias("text"), pick(_ROLES, 11).alias("role"), section.alias("section"))
    return rows.groupBy(F.coalesce(reason, F.lit("none")).alias("reason")).agg(F.count("*").alias("n"), F.sum("doc_id").alias("ids"))


@register(
    "spread_fill",
    """
    WITH n AS (SELECT count(*) AS n FROM documents), c AS (SELECT doc_id FROM documents WHERE doc_id % 100 = 7 ORDER BY doc_id LIMIT 5), m AS (SELECT 25 - count(*) AS missing FROM c),
    p AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS place FROM documents),
    f AS (SELECT doc_id FROM p, n, m WHERE place > 0 AND place % greatest(n // (missing + 1), 1) = 0 AND doc_id NOT IN (SELECT doc_id FROM c) ORDER BY doc_id)
    SELECT doc_id FROM c UNION ALL SELECT doc_id FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS r FROM f), m WHERE r <= missing
    """,
)
def spread_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five chosen documents, filled up to 25 by every n-th row (a sampling operator)."""
    rows = table(spark, sf_dir, "documents").select("doc_id")
    return sequence.spread_fill(rows, rows.where("doc_id % 100 = 7").orderBy("doc_id").limit(5), "doc_id", 25)


@register(
    "missing_keys",
    """
    WITH d AS (SELECT doc_id, list_filter([CASE WHEN doc_id % 5 = 1 THEN 'work_id' END, CASE WHEN doc_id % 7 = 2 THEN 'text' END, CASE WHEN doc_id % 11 = 3 THEN 'source_blocks' END], lambda x: x IS NOT NULL) AS m FROM documents WHERE doc_id % 13 <> 4)
    SELECT array_to_string(m, ',') AS missing, count(*)::BIGINT AS n FROM d WHERE len(m) > 0 GROUP BY m UNION ALL SELECT 'no object', count(*)::BIGINT FROM documents WHERE doc_id % 13 = 4 HAVING count(*) > 0
    """,
)
def missing_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that passages as JSON lack; a key with null is none of them."""
    without = lambda name, n, k: F.when(F.col("doc_id") % n != k, F.lit(name))
    names = F.array_compact(F.array(F.lit("id"), without("work_id", 5, 1), F.lit("sequence"), without("text", 7, 2), F.lit("section_path"), without("source_blocks", 11, 3)))
    values = F.transform(names, lambda n: F.when(n == "sequence", F.lit(None).cast("string")).otherwise(F.lit("x")))
    raw = F.when(F.col("doc_id") % 13 == 4, "[1, 2]").otherwise(F.to_json(F.map_from_arrays(names, values), {"ignoreNullFields": "false"}))
    missing = works.missing_keys(F.col("raw"))
    said = table(spark, sf_dir, "documents").select(raw.alias("raw")).select(F.coalesce(F.array_join(missing, ","), F.lit("no object")).alias("missing"))
    return said.where("missing <> ''").groupBy("missing").agg(F.count("*").alias("n"))


@register(
    "escaped_texts",
    r"""
    SELECT doc_id, sha1(regexp_replace(text, '([\\#\[\]$*_`@<>])', '\\\1', 'g')) AS typeset, sha1(replace(replace(text, '\', '\\'), '"', '\"')) AS quoted,
      sha1(replace(replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&#x27;')) AS html, sha1(replace(coalesce(text, ''), '```', '` ` `')) AS fenced FROM documents
    """,
)
def escaped_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of texts as they would be written into four kinds of output."""
    text = F.col("text")
    forms = {"typeset": markup.typeset_text(text), "quoted": markup.typeset_string(text), "html": markup.html(text), "fenced": markup.fenced(text)}
    return table(spark, sf_dir, "documents").select("doc_id", *(F.sha1(c).alias(n) for n, c in forms.items()))
