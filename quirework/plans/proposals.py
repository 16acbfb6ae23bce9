"""Queries on the chain from drafts and machine proposals to findings, merged annotations and the review queue.

Passages are documents with an opener and a section by their id; proposals are made from them as JSON text, each with one
fault by its id, or none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quirework.functions import text as T
from quirework.operators import annotations
from quirework.plans.registry import register
from quirework.session import table

_OPENERS = ["", "قال تعالى", "فقال تعالى", "اللهم", "صل", "بسم الله", "قال النبي", "قال الله"]
_SECTIONS = ["قصيدة", "الصلاة على", ""]
_BLANK = T.SPACE


def _pick(values: list[str], by: Column) -> Column:
    return F.get(F.array(*map(F.lit, values)), by.cast("int"))


_OPENED = f"""
    o AS (SELECT doc_id, doc_id % 8 AS o, doc_id % 3 AS s, ltrim(list_value({', '.join(repr(x) for x in _OPENERS)})[doc_id % 8 + 1] || ' ' || coalesce(text, ''), ' ') AS t FROM documents),
    p AS (SELECT *, trim(regexp_replace(t, '{_BLANK}+', ' ', 'g'), ' ') AS flat,
      list_filter(list_transform(regexp_split_to_array(t, '[\\n\\r]+'), lambda x: regexp_replace(regexp_replace(x, '^{_BLANK}+', ''), '{_BLANK}+$', '')), lambda x: x <> '') AS ls FROM o),
    n AS (SELECT *, length(flat) AS n, regexp_matches(flat, '[}}][^{{}}\\n]{{5,220}}[{{]') OR o IN (1, 2, 7) AS quoted,
      len(ls) >= 2 AND list_max(list_transform(ls, lambda x: length(x))) <= 90 AND len(list_filter(ls, lambda x: contains(x, ' '))) >= 2 AS verse FROM p),
    b AS (SELECT *, CASE WHEN o = 1 THEN 'ayat' WHEN o = 3 AND n <= 1800 OR s = 1 AND o IN (3, 4) AND n <= 1600 OR o = 5 AND n <= 220 THEN 'matn' ELSE 'body' END AS base FROM n),
    c AS (SELECT doc_id, CASE WHEN o = 3 AND n <= 1400 THEN 'matn' WHEN s = 0 AND n <= 1200 AND verse THEN 'poem' WHEN o = 6 AND n <= 900 THEN 'quote' WHEN quoted AND o IN (1, 2) AND n <= 420 THEN 'ayat' ELSE base END AS role,
      greatest(0.52, CASE WHEN base = 'matn' THEN 0.78 ELSE 0 END, CASE WHEN o IN (1, 2) AND n <= 420 THEN 0.68 ELSE 0 END, CASE WHEN o = 6 AND n <= 900 THEN 0.72 ELSE 0 END,
        CASE WHEN s = 0 AND n <= 1200 AND verse THEN 0.64 ELSE 0 END, CASE WHEN o = 3 AND n <= 1400 THEN 0.80 ELSE 0 END)::DOUBLE AS confidence,
      list_filter([CASE WHEN base = 'matn' THEN 'matn_opening_or_shalawat_section' END, CASE WHEN quoted THEN 'contains_quran_signal' END, CASE WHEN o = 6 AND n <= 900 THEN 'short_hadith_or_report_opening' END,
        CASE WHEN s = 0 AND n <= 1200 AND verse THEN 'poetry_section' END, CASE WHEN o = 3 AND n <= 1400 THEN 'short_devotional_opening' END], lambda x: x IS NOT NULL) AS g FROM b)
"""


@register(
    "draft_annotations",
    f"""
    WITH {_OPENED}
    SELECT doc_id, CASE role WHEN 'ayat' THEN 'ayah' ELSE role END AS kind, CASE role WHEN 'ayat' THEN 'ayah_text_block' WHEN 'body' THEN 'body' ELSE role || '_block' END AS layout, confidence,
      CASE WHEN len(g) = 0 THEN 'default_body' ELSE array_to_string(g, ',') END AS signals FROM c
    """,
)
def draft_annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kind, layout, confidence and signals of every passage by rule."""
    docs = table(spark, sf_dir, "documents")
    opened = F.ltrim(F.concat(_pick(_OPENERS, F.pmod("doc_id", F.lit(8))), F.lit(" "), F.coalesce("text", F.lit(""))))
    rows = docs.select("doc_id", opened.alias("text"), F.array(_pick(_SECTIONS, F.pmod("doc_id", F.lit(3)))).alias("section_path"))
    return annotations.draft(rows, section="section_path").select("doc_id", "kind", "layout", "confidence", F.array_join("signals", ",").alias("signals"))


def _proposals(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(proposals as JSON text, passages): the fault of each proposal by its id modulo 26."""
    docs = table(spark, sf_dir, "documents").selectExpr("cast(doc_id % 26 AS int) AS k", "concat('P', doc_id) AS id", "coalesce(text, '') AS text")
    fields = {
        "id": "concat('\"', CASE k WHEN 1 THEN '' WHEN 2 THEN 'X' || id ELSE id END, '\"')",
        "primary_kind": "CASE k WHEN 3 THEN '\"unknown\"' WHEN 11 THEN '\"ayah\"' ELSE '\"quote\"' END",
        "layout_component": "CASE k WHEN 4 THEN '\"dua_block\"' ELSE '\"quote_block\"' END",
        "confidence": "CASE k WHEN 5 THEN '\"0.5\"' WHEN 6 THEN '1.5' ELSE '0.5' END",
        "reason_ar": "CASE k WHEN 7 THEN '\"see API\"' ELSE '\"plain\"' END",
        "enhancements": "CASE k WHEN 8 THEN '[{\"title_ar\":\"QR code\",\"reason_ar\":\" \"}]' ELSE '[{\"title_ar\":\"plain\"}]' END",
        "review_notes": "CASE k WHEN 9 THEN '[\"the graph\"]' ELSE '[\"plain\"]' END",
    }
    of_segment = {
        "kind": "CASE k WHEN 14 THEN '\"heading\"' WHEN 19 THEN '\"ayah\"' WHEN 20 THEN '\"ayah\"' WHEN 21 THEN '\"hadith\"' ELSE '\"quote\"' END",
        "text": "substring(to_json(named_struct('t', CASE k WHEN 15 THEN substring(text, 1, 5) || '#§#' WHEN 19 THEN '' ELSE substring(text, 1, 5) END)), 6)",
        "ref": "CASE WHEN k IN (19, 20) THEN '\"\"' ELSE '\"ref\"' END",
        "review_required": "CASE WHEN k IN (19, 21) THEN 'false' ELSE 'true' END",
        "validation_error": "CASE k WHEN 13 THEN '\"span_not_found\"' ELSE '\"\"' END",
        "source_span": "CASE k WHEN 16 THEN '{\"start\":3,\"end\":1}' WHEN 17 THEN '{\"start\":\"0\",\"end\":5}' WHEN 18 THEN '{\"start\":1,\"end\":6}' WHEN 19 THEN 'null' ELSE '{\"start\":0,\"end\":5}' END",
    }
    pair = lambda name, value: f"'\"{name}\":', {value}"
    # the text ends with the brace of its own JSON object, which the segment's last field makes use of
    segment = "concat('{', " + ", ',', ".join(pair(n, v) for n, v in of_segment.items() if n != "text") + ", ',', " + pair("text", of_segment["text"]) + ")"
    body = ", ',', ".join(pair(n, v) for n, v in fields.items())
    raw = f"CASE k WHEN 0 THEN '[1]' ELSE concat('{{', {body}, ',\"segments\":', CASE k WHEN 10 THEN '\"x\"' WHEN 11 THEN '[]' WHEN 12 THEN '[5]' ELSE concat('[', {segment}, ']') END, '}}') END"
    made = docs.selectExpr(f"{raw} AS raw", "explode(sequence(1, CASE k WHEN 22 THEN 2 ELSE 1 END)) AS copy")
    return made.select("raw"), docs.select("id", "text")


_FAULTS = """
    d AS (SELECT doc_id % 26 AS k, doc_id, coalesce(text, '') AS t FROM documents),
    f AS (SELECT k, doc_id, t, unnest(CASE k WHEN 0 THEN ['invalid_proposal_row'] WHEN 1 THEN ['missing_proposal_id'] WHEN 2 THEN ['unknown_passage_id'] WHEN 3 THEN ['invalid_primary_kind']
      WHEN 4 THEN ['invalid_layout_component'] WHEN 5 THEN ['invalid_confidence'] WHEN 6 THEN ['invalid_confidence'] WHEN 7 THEN ['latin_technical_term_in_arabic_label']
      WHEN 8 THEN ['latin_technical_term_in_arabic_label'] WHEN 9 THEN ['latin_technical_term_in_arabic_label'] WHEN 10 THEN ['invalid_segments'] WHEN 11 THEN ['scripture_without_segments']
      WHEN 12 THEN ['invalid_segment'] WHEN 13 THEN ['span_not_found'] WHEN 14 THEN ['invalid_segment_kind']
      WHEN 15 THEN CASE WHEN t = '' THEN ['source_span_text_mismatch'] ELSE ['segment_text_not_exact_source_substring', 'source_span_text_mismatch'] END
      WHEN 16 THEN ['invalid_source_span_range'] WHEN 17 THEN ['invalid_source_span_range'] WHEN 18 THEN CASE WHEN substring(t, 2, 5) <> substring(t, 1, 5) THEN ['source_span_text_mismatch'] ELSE [] END
      WHEN 19 THEN ['scripture_segment_empty', 'scripture_segment_missing_ref', 'scripture_segment_not_marked_for_review']
      WHEN 20 THEN ['scripture_segment_missing_ref'] WHEN 21 THEN ['scripture_segment_not_marked_for_review'] WHEN 22 THEN ['duplicate_proposal_id'] ELSE [] END) AS code FROM d)
"""


@register(
    "proposal_findings",
    f"""
    WITH {_FAULTS}
    SELECT CASE WHEN k < 2 THEN NULL WHEN k = 2 THEN 'XP' || doc_id ELSE 'P' || doc_id END AS id, code,
      CASE WHEN k IN (5, 6, 7, 8, 9, 11, 19, 20, 21) THEN 'warn' ELSE 'fail' END AS severity, CASE WHEN k BETWEEN 12 AND 21 THEN 0 END::BIGINT AS segment_index FROM f
    """,
)
def proposal_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fault of every proposal, held against its passage."""
    found = annotations.proposal_findings(*_proposals(spark, sf_dir))
    return found.select(F.nullif(F.col("id"), F.lit("")).alias("id"), "code", "severity", "segment_index")


@register(
    "review_queue",
    f"""
    WITH {_FAULTS},
    q AS (SELECT 'P' || doc_id AS passage_id, code, k, CASE WHEN k BETWEEN 12 AND 21 THEN 0 END AS i, t FROM f WHERE k > 2)
    SELECT passage_id || ':' || coalesce('s' || i, 'row') || ':' || code AS queue_id, CASE code WHEN 'scripture_segment_missing_ref' THEN 'missing_reference' WHEN 'scripture_segment_not_marked_for_review' THEN 'review_flag'
        WHEN 'segment_text_not_exact_source_substring' THEN 'source_mismatch' WHEN 'source_span_text_mismatch' THEN 'source_mismatch' WHEN 'latin_technical_term_in_arabic_label' THEN 'arabic_label_cleanup' ELSE code END AS issue_type,
      CASE code WHEN 'scripture_segment_missing_ref' THEN 20 WHEN 'segment_text_not_exact_source_substring' THEN 10 WHEN 'source_span_text_mismatch' THEN 10 WHEN 'latin_technical_term_in_arabic_label' THEN 70 ELSE 40 END::BIGINT AS priority_rank,
      CASE WHEN k = 12 THEN NULL WHEN i = 0 THEN CASE k WHEN 14 THEN 'heading' WHEN 19 THEN 'ayah' WHEN 20 THEN 'ayah' WHEN 21 THEN 'hadith' ELSE 'quote' END END AS segment_kind FROM q
    """,
)
def review_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings with issue type, rank and the segment they stand at."""
    raw, passages = _proposals(spark, sf_dir)
    found = annotations.proposal_findings(raw, passages).where("id <> '' and id not like 'X%'")
    v, none = F.col("v"), F.array().cast("array<struct<kind:string,ref:string,text:string>>")
    segments = F.transform(F.try_variant_get(v, "$.segments", "array<variant>"), lambda s: F.struct(*(F.try_variant_get(s, f"$.{c}", "string").alias(c) for c in ("kind", "ref", "text"))))
    parsed = annotations.parsed_proposals(raw).where("is_object and id <> ''").select("id", "kind", F.coalesce(segments, none).alias("segments")).dropDuplicates(["id"])
    numbered = passages.select("id", F.regexp_extract("id", "[0-9]+", 0).cast("long").alias("sequence"))
    return annotations.queue_items(found, parsed, numbered).select("queue_id", "issue_type", "priority_rank", "segment_kind")


@register(
    "merged_annotations",
    f"""
    WITH {_OPENED}, {_FAULTS},
    w AS (SELECT doc_id, bool_or(k NOT IN (5, 6, 7, 8, 9, 11, 19, 20, 21)) AS failed, true AS found FROM f GROUP BY doc_id),
    a AS (SELECT c.*, (w.found IS NULL OR NOT w.failed AND c.doc_id % 2 = 0) AND c.doc_id % 26 > 2 AS taken, c.doc_id % 26 AS k FROM c LEFT JOIN w USING (doc_id))
    SELECT doc_id, CASE WHEN taken THEN CASE WHEN k = 11 THEN 'ayah' ELSE 'quote' END WHEN role = 'ayat' THEN 'ayah' ELSE role END AS kind,
      CASE WHEN taken AND k <> 11 THEN 'quote_block' WHEN taken THEN 'ayah_text_block' WHEN role = 'ayat' THEN 'ayah_text_block' WHEN role = 'body' THEN 'body' ELSE role || '_block' END AS layout,
      CASE WHEN NOT taken THEN 'draft' WHEN doc_id % 2 = 0 THEN 'reviewed' ELSE 'machine_validated' END AS status,
      array_to_string(CASE WHEN taken THEN list_sort(list_concat(CASE WHEN len(g) = 0 THEN ['default_body'] ELSE g END, ['llm_semantic_proposal', 'llm_component:quote_block'])) WHEN len(g) = 0 THEN ['default_body'] ELSE g END, ',') AS signals FROM a
    """,
)
def merged_annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drafts with the accepted proposals in their place; even ids are approved, which lifts warnings."""
    docs = table(spark, sf_dir, "documents")
    opened = F.ltrim(F.concat(_pick(_OPENERS, F.pmod("doc_id", F.lit(8))), F.lit(" "), F.coalesce("text", F.lit(""))))
    drafts = annotations.draft(docs.select("doc_id", opened.alias("text"), F.array(_pick(_SECTIONS, F.pmod("doc_id", F.lit(3)))).alias("section_path")), section="section_path")
    drafts = drafts.withColumn("id", F.concat(F.lit("P"), F.col("doc_id").cast("string")))
    raw, passages = _proposals(spark, sf_dir)
    found = annotations.proposal_findings(raw, passages).where("id <> ''")
    even = F.regexp_extract("id", "[0-9]+", 0).cast("long") % 2 == 0
    # approval lifts warnings: those of even ids do not count
    gate = annotations.merge_gate(drafts, annotations.parsed_proposals(raw).where("is_object and id <> ''").select("id"), found.where(~(even & (F.col("severity") == "warn"))))
    parsed = annotations.parsed_proposals(raw).where("is_object").select("id", "kind", "layout", F.try_variant_get("confidence", "$", "double").alias("confidence")).dropDuplicates(["id"])
    out = annotations.merged(drafts, parsed, gate)
    status = F.when((F.col("status") == "machine_validated") & even, "reviewed").otherwise(F.col("status"))
    return out.select(F.substring("id", 2, 20).cast("long").alias("doc_id"), "kind", "layout", status.alias("status"), F.array_join("signals", ",").alias("signals"))
