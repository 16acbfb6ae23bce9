"""Queries of the quality report: documents as passages of works (their sources), with faults by their ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirework.operators import report, sequence
from quirework.plans.registry import register
from quirework.session import table

_WORK = "coalesce(source, 'none')"


def _works(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = "cast(coalesce(nullif(regexp_extract(work_id, '[0-9]+', 0), ''), '0') AS int)"
    return table(spark, sf_dir, "documents").selectExpr(f"{_WORK} AS work_id").distinct().selectExpr(
        "work_id", f"CASE WHEN {n} % 5 = 1 THEN 'lost' ELSE 'draft' END AS status", f"CASE WHEN {n} % 7 <> 1 THEN '0.1' END AS schema_version", "'print' AS default_edition", f"{n} AS no"
    )


_WORKS = f"""
    d AS (SELECT *, {_WORK} AS work_id FROM documents),
    w AS (SELECT DISTINCT work_id, CAST(coalesce(nullif(regexp_extract(work_id, '[0-9]+'), ''), '0') AS INTEGER) AS no FROM d)
"""


@register(
    "report_works",
    f"""
    WITH {_WORKS}
    SELECT work_id, code, severity, 1::BIGINT AS n FROM (SELECT work_id, unnest(list_filter([CASE WHEN no % 5 = 1 THEN ['unknown_status', 'warn'] END, CASE WHEN no % 7 = 1 THEN ['missing_schema_version', 'warn'] END,
      CASE WHEN no % 6 = 2 THEN ['raw_manuscript_missing', 'fail'] END, CASE WHEN no % 4 = 3 THEN ['clean_manuscript_missing', 'warn'] END, CASE WHEN no % 3 = 1 THEN ['cleaning_report_missing', 'warn'] END], lambda x: x IS NOT NULL)) AS f FROM w),
      LATERAL (SELECT f[1] AS code, f[2] AS severity)
    """,
)
def report_works(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings on works: state, version, and what they lack."""
    works = _works(spark, sf_dir)
    layer = lambda name, test: works.where(test).select("work_id", F.lit(name).alias("layer"))
    held = layer("raw", "no % 6 <> 2").unionByName(layer("clean", "no % 4 <> 3"))
    return report.report(report.works_report(works, held, works.where("no % 3 <> 1")))


def _passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbered within their work, with doubled ids and numbers, broken blocks and blank fields by their id."""
    block = "named_struct('pdf_page', 1, 'block_id', CASE WHEN doc_id % 41 = 3 THEN ' ' ELSE 'b' END, 'bbox', CASE WHEN doc_id % 43 = 3 THEN array(1.0D) ELSE array(1.0D, 2.0D, 3.0D, 4.0D) END)"
    return table(spark, sf_dir, "documents").selectExpr(
        f"{_WORK} AS work_id",
        "concat('D', CASE WHEN doc_id % 50 = 49 THEN doc_id - 1 ELSE doc_id END) AS id",
        f"cast(row_number() OVER (PARTITION BY {_WORK} ORDER BY doc_id) AS long) + CASE WHEN doc_id % 31 = 5 THEN 1 ELSE 0 END AS sequence",
        "CASE WHEN doc_id % 19 = 4 THEN '' ELSE lang END AS lang",
        "CASE WHEN doc_id % 53 = 5 THEN '12. (3)' WHEN doc_id % 53 = 6 THEN concat('Shamela ', text) ELSE text END AS text",
        "CASE WHEN doc_id % 23 = 4 THEN NULL ELSE 'draft' END AS review_status",
        f"CASE WHEN doc_id % 47 = 3 THEN NULL ELSE array({block}) END AS source_blocks",
        "doc_id",
    )


_PASSAGES = f"""
    p AS (SELECT {_WORK} AS work_id, 'D' || CASE WHEN doc_id % 50 = 49 THEN doc_id - 1 ELSE doc_id END AS id, doc_id,
      row_number() OVER (PARTITION BY {_WORK} ORDER BY doc_id) + CASE WHEN doc_id % 31 = 5 THEN 1 ELSE 0 END AS seq, coalesce(trim(lang), '') = '' OR doc_id % 19 = 4 AS no_lang, lang IS NULL AND doc_id % 19 <> 4 AS null_lang,
      CASE WHEN doc_id % 53 = 5 THEN '12. (3)' WHEN doc_id % 53 = 6 THEN 'Shamela ' || text ELSE text END AS t FROM documents)
"""


@register(
    "report_passages",
    f"""
    WITH {_PASSAGES},
    f AS (SELECT work_id, code FROM (SELECT work_id, unnest(list_filter([CASE WHEN regexp_matches(replace(t, ' ', ''), '^[0-9.()،؛:؟!\\-ـ]+$') THEN 'numeric_only' END,
      CASE WHEN regexp_matches(t, 'Shamela|المحتويات|᧦|[\\x{{200E}}\\x{{200F}}\\x{{202A}}-\\x{{202E}}\\x{{2066}}-\\x{{2069}}\\x{{FEFF}}]') THEN 'artifacts_left' END,
      CASE WHEN doc_id % 41 = 3 OR doc_id % 43 = 3 OR doc_id % 47 = 3 THEN 'block_provenance' END, CASE WHEN doc_id % 23 = 4 THEN 'missing_review_status' END, CASE WHEN no_lang THEN 'missing_lang' END,
      CASE WHEN length(t) > 3000 THEN 'long_passages' END, CASE WHEN length(t) < 12 THEN 'short_passages' END, CASE WHEN doc_id % 23 = 4 OR null_lang OR t IS NULL THEN 'missing_fields' END], lambda x: x IS NOT NULL)) AS code FROM p)),
    g AS (SELECT work_id, seq, count(*) AS k FROM p GROUP BY ALL), s AS (SELECT work_id, count(*) AS size FROM p GROUP BY ALL),
    a AS (SELECT work_id, code, count(*) AS n FROM f GROUP BY ALL
      UNION ALL SELECT work_id, 'duplicate_ids', count(*) FROM (SELECT work_id, id FROM p GROUP BY ALL HAVING count(*) > 1) GROUP BY work_id
      UNION ALL SELECT work_id, 'sequence_gaps_or_duplicates', size - count(*) FILTER (WHERE seq BETWEEN 1 AND size) + count(*) FILTER (WHERE k > 1) FROM g JOIN s USING (work_id) GROUP BY work_id, size)
    SELECT work_id, code, CASE WHEN code IN ('short_passages', 'missing_fields') THEN 'metric' WHEN code = 'long_passages' THEN 'info' WHEN code IN ('duplicate_ids', 'block_provenance') THEN 'fail' ELSE 'warn' END AS severity, n::BIGINT AS n FROM a WHERE n > 0
    """,
)
def report_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings on passages, counted by work."""
    return report.report(report.passages_report(_passages(spark, sf_dir)))


@register(
    "report_ids",
    f"""
    WITH {_WORKS},
    c AS (SELECT work_id, count(*) FILTER (WHERE doc_id % 13 = 2) AS n, count(*) FILTER (WHERE doc_id % 13 <> 2) AS m FROM d GROUP BY ALL),
    r AS (SELECT work_id, count(*) FILTER (WHERE (doc_id % 13 = 2) <> (doc_id % 11 = 2)) AS n, count(*) FILTER (WHERE doc_id % 13 <> 2) AS m, count(*) FILTER (WHERE doc_id % 11 <> 2) AS k FROM d GROUP BY ALL)
    SELECT work_id, 'clean_ids_differ_from_passages' AS code, 'fail' AS severity, n::BIGINT AS n FROM c WHERE n > 0 AND m > 0
    UNION ALL SELECT work_id, 'clean_ids_differ_from_raw', 'fail', n::BIGINT FROM r WHERE n > 0 AND m > 0 AND k > 0
    """,
)
def report_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of the cleaned manuscript against the passages' and the raw manuscript's."""
    rows = table(spark, sf_dir, "documents").selectExpr(f"{_WORK} AS work_id", "doc_id", "concat('D', doc_id) AS id")
    clean = rows.where("doc_id % 13 <> 2")
    return report.report([report.ids_differ(clean, rows, "clean_ids_differ_from_passages"), report.ids_differ(clean, rows.where("doc_id % 11 <> 2"), "clean_ids_differ_from_raw")])


@register(
    "report_editions",
    f"""
    WITH {_WORKS},
    e AS (SELECT work_id, 'print' AS edition FROM w UNION ALL SELECT work_id, 'web' FROM w WHERE no % 2 = 0),
    x AS (SELECT work_id, edition, doc_id FROM e JOIN d USING (work_id)),
    has AS (SELECT DISTINCT work_id, edition FROM x WHERE doc_id % 17 <> 3),
    y AS (SELECT x.* FROM x JOIN has USING (work_id, edition)),
    i AS (SELECT work_id, count(*) FILTER (WHERE doc_id % 17 = 3 OR doc_id % 19 = 3) + count(*) FILTER (WHERE doc_id % 17 <> 3 AND doc_id % 29 = 5) AS n FROM y GROUP BY ALL),
    v AS (SELECT work_id, count(*) FILTER (WHERE doc_id % 23 = 5 OR doc_id % 37 = 5) AS n FROM y WHERE doc_id % 17 <> 3 GROUP BY ALL),
    z AS (SELECT work_id, count(*) FILTER (WHERE doc_id % 31 = 7 OR doc_id % 41 = 7) AS n FROM y WHERE doc_id % 17 <> 3 AND edition = 'print' GROUP BY ALL)
    SELECT work_id, code, 'fail' AS severity, n::BIGINT AS n FROM (SELECT work_id, 'page_map_ids_wrong' AS code, n FROM i UNION ALL SELECT work_id, 'edition_refs_wrong', n FROM v UNION ALL SELECT work_id, 'public_citation_wrong', n FROM z) WHERE n > 0
    """,
)
def report_editions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page maps of two editions against the ids, references and citations of the passages."""
    works, docs = _works(spark, sf_dir), table(spark, sf_dir, "documents").selectExpr(f"{_WORK} AS work_id", "doc_id", "concat('D', doc_id) AS id", "doc_id div 4 + 1 AS page")
    ref = "named_struct('page', page + CASE WHEN doc_id % 23 = 5 THEN 1 ELSE 0 END, 'label', cast(page AS string))"
    passages = docs.selectExpr(
        "work_id",
        "id",
        f"map('print', {ref}, 'web', {ref}) AS both",
        "CASE WHEN doc_id % 31 <> 7 THEN named_struct('edition_id', 'print', 'label', CASE WHEN doc_id % 41 = 7 THEN 'other' ELSE cast(page AS string) END) END AS citation",
        "doc_id % 37 = 5 AS bare",
    ).selectExpr("work_id", "id", "citation", "map_filter(both, (k, v) -> NOT bare) AS edition_refs")
    editions = works.selectExpr("work_id", "'print' AS edition").unionByName(works.where("no % 2 = 0").selectExpr("work_id", "'web' AS edition"))
    entry = docs.where("doc_id % 17 <> 3").join(editions, "work_id").selectExpr("work_id", "edition", "id", "page", "cast(page AS string) AS label", "doc_id")
    twice = entry.where("doc_id % 19 = 3")
    stray = entry.where("doc_id % 29 = 5").withColumn("id", F.concat(F.lit("X"), "id"))
    return report.report(report.editions_report(works, passages, entry.unionByName(twice).unionByName(stray).drop("doc_id")))


@register(
    "report_translations",
    f"""
    WITH {_WORKS},
    t AS (SELECT work_id, doc_id, doc_id % 60 AS k, text AS src, CASE WHEN doc_id % 60 = 6 THEN '' WHEN doc_id % 60 = 9 THEN text || ' ـا ب' WHEN doc_id % 60 = 12 THEN substring(text, 1, length(text) // 8) ELSE text END AS txt FROM d WHERE doc_id % 3 = 0 AND text IS NOT NULL),
    f AS (SELECT work_id, code FROM (SELECT work_id, unnest(list_filter([CASE WHEN k = 15 THEN 'translation_source_unknown' END,
      CASE WHEN trim(txt) = '' OR regexp_matches(txt, '^\\s*$') OR k IN (18, 21, 24) THEN 'translation_incomplete' END, CASE WHEN k = 27 THEN 'translation_source_uncited' END, CASE WHEN k IN (27, 30) THEN 'source_citation_drift' END,
      CASE WHEN k IN (33, 36) THEN 'translation_drift' END, CASE WHEN regexp_matches(txt, '[\\x{{0621}}-\\x{{064A}}]') THEN 'source_letters_left' END,
      CASE WHEN k <> 15 AND NOT regexp_matches(txt, '^\\s*$') AND CASE WHEN length(src) >= 80 THEN length(txt) < 0.25 * length(src) OR length(txt) > 4.0 * length(src) ELSE length(txt) > 400 END THEN 'length_ratio_outlier' END], lambda x: x IS NOT NULL)) AS code FROM t)),
    a AS (SELECT work_id, code, count(*) AS n FROM f GROUP BY ALL UNION ALL SELECT work_id, 'translation_duplicates', 2 * count(*) FILTER (WHERE k = 39) FROM t GROUP BY ALL)
    SELECT work_id, code, CASE WHEN code IN ('translation_source_unknown', 'source_citation_drift', 'translation_duplicates') THEN 'fail' ELSE 'warn' END AS severity, n::BIGINT AS n FROM a WHERE n > 0
    """,
)
def report_translations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Translations of every third passage, with faults by their id, against their source."""
    docs = table(spark, sf_dir, "documents").where("text is not null").selectExpr(f"{_WORK} AS work_id", "doc_id", "doc_id % 60 AS k", "concat('D', doc_id) AS id", "text")
    cite = "named_struct('label', cast(doc_id AS string))"
    passages = docs.selectExpr("work_id", "id", "doc_id AS sequence", "text", f"CASE WHEN k <> 27 THEN {cite} END AS citation")
    made = docs.where("doc_id % 3 = 0").selectExpr(
        "work_id",
        "CASE WHEN k = 15 THEN 'Y' || id ELSE id END AS source_passage_id",
        "CASE WHEN k = 15 THEN 'Y' || id || '.id' WHEN k = 33 THEN id ELSE id || '.id' END AS id",
        "CASE WHEN k = 18 THEN 'en' ELSE 'id' END AS lang",
        "'id' AS dir_lang",
        "'ar' AS source_lang",
        "CASE WHEN k = 36 THEN -1L ELSE doc_id END AS source_sequence",
        "array('A') AS section_path",
        f"CASE WHEN k = 30 THEN named_struct('label', 'old') ELSE {cite} END AS source_citation",
        "CASE WHEN k = 21 THEN 'lost' ELSE 'draft' END AS translation_status",
        "'full' AS translation_type",
        "'machine' AS translator",
        "CASE WHEN k = 24 THEN ' ' ELSE 'm' END AS model",
        "CASE WHEN k = 6 THEN '' WHEN k = 9 THEN text || ' ـا ب' WHEN k = 12 THEN substring(text, 1, length(text) div 8) ELSE text END AS text",
        "k",
    )
    # a doubled row counts once as id and once as reference; its own tests hold once, so it is whole otherwise
    whole = report.translations_report(made.drop("k"), passages)[:1] + report.translations_report(made.unionByName(made.where("k = 39")).drop("k"), passages)[1:]
    return report.report(whole)


@register(
    "report_outline",
    """
    WITH h AS (SELECT conv_id % 7 AS work_id, conv_id, turn, role, CASE role WHEN 'system' THEN 1 WHEN 'user' THEN 2 ELSE 3 END AS level, substring(text, 1, 3) AS key FROM conversations),
    o AS (SELECT *, lag(level) OVER w AS pl, lag(key) OVER w AS pk FROM h WINDOW w AS (PARTITION BY work_id ORDER BY conv_id, turn)),
    t AS (SELECT work_id, key, sum(CASE WHEN conv_id % 2 = 0 THEN 2 ELSE 1 END) AS e, count(*) AS f FROM h GROUP BY ALL),
    u AS (SELECT work_id, sum(e) AS e, sum(greatest(e - f, 0)) AS n FROM t GROUP BY ALL), l AS (SELECT work_id, count(*) FILTER (WHERE level = 1) AS h1, count(*) FILTER (WHERE level = 2) AS h2, count(*) FILTER (WHERE level = 3) AS h3 FROM h GROUP BY ALL)
    SELECT work_id::VARCHAR AS work_id, code, severity, n::BIGINT AS n FROM (
      SELECT work_id, 'flat_outline' AS code, 'info' AS severity, 1 AS n FROM l WHERE h1 > 40 AND h2 < 5 UNION ALL SELECT work_id, 'detailed_outline', 'info', 1 FROM l WHERE h2 > 1000 AND h3 > 1000
      UNION ALL SELECT work_id, 'skipped_levels', 'metric', count(*) FROM o WHERE level > pl + 1 GROUP BY work_id UNION ALL SELECT work_id, 'adjacent_duplicate_headings', 'warn', count(*) FROM o WHERE key = pk GROUP BY work_id
      UNION ALL SELECT work_id, 'toc_unmatched', CASE WHEN n > 5 AND n / e > 0.03 THEN 'warn' ELSE 'info' END, n FROM u WHERE n > 0)
    """,
)
def report_outline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as headings of works: shape, skipped levels, neighbours with equal keys, and a table of contents against them."""
    rows = table(spark, sf_dir, "conversations").selectExpr(
        "cast(conv_id % 7 AS string) AS work_id", "conv_id", "struct(conv_id, turn) AS place", "CASE role WHEN 'system' THEN 1 WHEN 'user' THEN 2 ELSE 3 END AS level", "substring(text, 1, 3) AS key"
    )
    before = sequence.Window.partitionBy("work_id").orderBy("place")
    doubled = rows.withColumn("_before", F.lag("key").over(before)).where("key = _before")
    toc = rows.select("work_id", "key", F.explode(F.sequence(F.lit(1), F.when(F.col("conv_id") % 2 == 0, 2).otherwise(1))))
    return report.report(report.outline_report(rows, toc, sequence.level_skips(rows, "work_id", "place", "level"), doubled))


@register(
    "report_index",
    f"""
    WITH {_PASSAGES}, d AS (SELECT *, {_WORK} AS work_id FROM documents), w AS (SELECT DISTINCT work_id FROM d),
    c AS (SELECT work_id, count(*) AS n, count(DISTINCT CASE WHEN doc_id % 31 = 5 THEN 1 END) AS x FROM p GROUP BY ALL),
    s AS (SELECT work_id, count(*)::BIGINT AS passages, min(length(t))::BIGINT AS len_min, max(length(t))::BIGINT AS len_max, bool_or(length(t) > 3000) AS long, bool_or(no_lang) AS lang, bool_or(doc_id % 23 = 4) AS state FROM p GROUP BY ALL)
    SELECT work_id, CASE WHEN lang OR state THEN 'warn' ELSE 'ok' END AS status, passages, len_min, len_max, (lang::INTEGER + state::INTEGER)::BIGINT AS n_warn, long::INTEGER::BIGINT AS n_info FROM s
    """,
)
def report_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a work, from three of the passage rules: status, sizes and findings by severity."""
    passages = _passages(spark, sf_dir)
    found = report.report(report.passages_report(passages)).where(F.col("code").isin("missing_lang", "missing_review_status", "long_passages"))
    none = passages.limit(0).select("work_id")
    return report.index(found, _works(spark, sf_dir), passages, none).select("work_id", "status", "passages", "len_min", "len_max", "n_warn", "n_info")
