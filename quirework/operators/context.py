"""What surrounds a model call: context and guidance for a prompt, routing, cached answers, and answers parsed and checked.

The call itself is not here; these are the joins and projections before and after it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirework.functions import text as T
from quirework.operators.annotations import first_match

#: Guidance for translating a passage, by what it holds.
GUIDANCE = [
    "Use the semantic_context only as translation guidance; do not add it as commentary.",
    "Do not translate or mention internal fields such as kind, role, layout, span_id, or review_required.",
]
GUIDANCE_BY_KIND = [
    (
        "ayah",
        "For Qur'an segments, translate the meaning carefully and do not assert a surah/ayah reference unless it is explicitly reviewed in the source metadata.",
    ),
    (
        "hadith",
        "For hadith/report segments, translate the source wording only; do not add takhrij, grading, isnad claims, or source claims that are not in the Arabic.",
    ),
]
GUIDANCE_REVIEW = (
    "If a source phrase looks damaged or OCR-corrupted, do not silently reconstruct it from memory; "
    "translate the visible wording as faithfully as possible and put uncertainty in warnings."
)
GUIDANCE_PRAYER = "For du'a or salawat, preserve devotional tone and repeated invocations."
GUIDANCE_QUOTE = "For quoted scholarly material, preserve attribution if it appears in the Arabic text."


def semantic_context(segments: Column) -> Column:
    """Segments (span_id, kind, ref, review_required, start, end, reason, text) as a prompt shows them: texts cut at 120."""
    return F.transform(
        segments,
        lambda s: F.struct(
            s["span_id"].alias("span_id"),
            s["kind"].alias("kind"),
            F.coalesce(s["ref"], F.lit("")).alias("ref"),
            F.coalesce(s["review_required"], F.lit(False)).alias("review_required"),
            F.struct(s["start"].alias("start"), s["end"].alias("end"), s["reason"].alias("reason")).alias("source_span"),
            T.truncate(F.coalesce(s["text"], F.lit("")), 120, "...").alias("text_preview"),
        ),
    )


def guidance(segments: Column, role: Column) -> Column:
    """array<string>: what a translator is told about a passage with these segments and this role; none without a role."""
    kinds = F.transform(segments, lambda s: s["kind"])
    has = lambda kind: F.coalesce(F.array_contains(kinds, kind), F.lit(False))
    review = F.coalesce(F.exists(segments, lambda s: F.coalesce(s["review_required"], F.lit(False))), F.lit(False))
    lines = [
        *(F.lit(x) for x in GUIDANCE),
        *(F.when(has(kind), F.lit(x)) for kind, x in GUIDANCE_BY_KIND),
        F.when(review, F.lit(GUIDANCE_REVIEW)),
        F.when(has("dua") | F.coalesce(role == "matn", F.lit(False)), F.lit(GUIDANCE_PRAYER)),
        F.when(has("quote") | F.coalesce(role == "quote", F.lit(False)), F.lit(GUIDANCE_QUOTE)),
    ]
    return F.when(role.isNull(), F.array().cast("array<string>")).otherwise(F.array_compact(F.array(*lines)))


def messages(system: Column, user: Column) -> Column:
    """A prompt: array<struct(role, content)>, the user's part (a struct) as JSON."""
    entry = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    return F.array(entry("system", system), entry("user", F.to_json(user)))


def section_counts(sections: DataFrame, annotations: DataFrame, section: str = "section") -> DataFrame:
    """(section, counts): of the passages of each section (passage_ids), their kinds (annotations: id, kind, segments[kind])
    as ``kind:x`` and their segments' kinds as ``segment:x``."""
    held = sections.select(section, F.explode("passage_ids").alias("id")).join(annotations, "id")
    names = F.concat(F.array(F.concat(F.lit("kind:"), "kind")), F.transform(F.coalesce(F.col("segments"), F.array().cast(annotations.schema["segments"].dataType)), lambda s: F.concat(F.lit("segment:"), s["kind"])))
    n = held.select(section, F.explode(F.array_compact(names)).alias("name")).groupBy(section, "name").agg(F.count("*").alias("n"))
    return n.groupBy(section).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("name", "n")))).alias("counts"))


def routed(rows: DataFrame, model: str, routes: list[tuple[str, str]], default: str = "none") -> DataFrame:
    """``rows`` with the provider whose pattern is the first to fit the model's id."""
    return rows.withColumn("provider", first_match(F.col(model), routes, default))


def split_by_cache(requests: DataFrame, cache: DataFrame, fields: list[str], least_batch: int = 1) -> tuple[DataFrame, DataFrame, bool]:
    """(answered, open, batch): requests with a cached answer (cache: key, answer), those without, and whether the open ones
    are enough for a batch. The key is a digest of the request's fields."""
    keyed = requests.withColumn("key", F.sha2(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}), 256))
    known = cache.select("key", "answer").dropDuplicates(["key"])
    answered = keyed.join(known, "key")
    left = keyed.join(known.select("key"), "key", "left_anti")
    return answered, left, left.limit(least_batch).count() >= least_batch


def checked_examples(aligned: DataFrame, level: str = "WARNING", strict: bool = False) -> DataFrame:
    """Findings on examples (aligned: …, status as alignment gives it): those not found in their text, and with ``strict``
    those found by common words only. ``OFF`` finds none; ``ERROR`` makes failures of them."""
    severity = {"WARNING": "warn", "ERROR": "fail"}.get(level)
    wrong = (F.col("status") == "none") | (F.lit(strict) & (F.col("status") == "fuzzy"))
    found = aligned.where(wrong if severity else F.lit(False))
    code = F.when(F.col("status") == "none", "example_not_in_text").otherwise("example_not_exact")
    return found.withColumns({"code": code, "severity": F.lit(severity or "info")})


def extractions(answers: DataFrame, key: str, answer: str, suppress: bool = True, index_suffix: str = "_index") -> DataFrame:
    """(key, extraction_class, extraction_text, position) from answers ``{"extractions": [{class: text, class_index: n}, …]}``,
    in order of their index. Answers that do not parse are dropped, or fail the query without ``suppress``."""
    v = F.try_parse_json(answer) if suppress else F.parse_json(answer)
    each = answers.select(key, F.posexplode(F.try_variant_get(v, "$.extractions", "array<map<string,string>>")).alias("_at", "e"))
    names = F.filter(F.map_keys("e"), lambda k: ~k.endswith(index_suffix))
    flat = each.select(key, "_at", "e", F.explode(names).alias("extraction_class"))
    order = F.coalesce(F.element_at("e", F.concat("extraction_class", F.lit(index_suffix))).try_cast("int"), F.col("_at") + 1)
    return flat.select(key, "extraction_class", F.element_at("e", F.col("extraction_class")).alias("extraction_text"), order.alias("position"))


def stale_revisions(revisions: DataFrame, current: DataFrame) -> DataFrame:
    """Revisions (passage_id, target, base_value, …) whose base is no longer the current value (passage_id, target, value)."""
    return revisions.join(current, ["passage_id", "target"], "left").where(~F.col("base_value").eqNullSafe(F.col("value"))).drop("value")
