"""Classification of passages, and the chain from machine proposals to reviewed annotations and review tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirework.functions import text as T
from quirework.operators.quality import Rule, findings, rank

#: Allowed kinds and layouts of proposals, technical words, openers of passages, maps of roles and layouts.
KINDS = ["body", "ayah", "hadith", "quote", "matn", "dua", "poem", "list", "biography", "source_catalog"]
SEGMENT_KINDS = [*KINDS, "prose", "list_item"]
LAYOUTS = ["body", "ayah_block", "hadith_block", "quote_block", "matn_block", "poem_block", "table_block", "editor_note_block"]
SCRIPTURE = ["ayah", "hadith"]
TECHNICAL = r"(?i)\b(?:API|RAG|Graph|PDF|Typst|QR|role|matn|pipeline)\b"
SCRIPTURE_OPENERS = ["قال تعالى", "قوله تعالى"]
QUOTED_OPENERS = [*SCRIPTURE_OPENERS, "فقال تعالى"]
PRAYER_OPENERS = ["اللَّهُمَّ", "اللهم", "إِ نَّ اللّٰه", "إِنَّ اللّٰه", "إن الله"]
SECTION_MARK, SECTION_OPENERS = "الصلاة ", [*PRAYER_OPENERS, "صَلِّ", "صل"]
BASMALAH = ["بسم اللّٰه", "بسم الله"]
DEVOTIONAL_OPENERS = ["اللَّهُمَّ", "اللهم", "إِ نَّ اللّٰه", "إِنَّ اللّٰه", "إن اللّٰه", "إن الله", "صَلِّ"]
REPORT_OPENERS = [
    "قال رسول اللّٰه",
    "قال رسول الله",
    "وقال رسول اللّٰه",
    "وقال رسول الله",
    "قال النبي",
    "وقال النبي",
    "وكان صلى اللّٰه عليه وسلم يقول",
    "وكان صلى الله عليه وسلم يقول",
    "وقال صلى اللّٰه عليه وسلم",
    "وقال صلى الله عليه وسلم",
]
SCRIPTURE_SIGNAL = r"(?:قال تعالى|قوله تعالى|فقال تعالى|لقوله تعالى|قال اللّٰه|قال الله|[}][^{}\n]{5,220}[{])"
POEM_SECTION = "قصيدة"
KIND_TO_ROLE = {
    "ayah": "ayat",
    "ayat": "ayat",
    "body": "body",
    "biography": "body",
    "dua": "matn",
    "hadith": "quote",
    "list": "body",
    "matn": "matn",
    "poem": "poem",
    "quote": "quote",
    "source_catalog": "body",
}
ROLE_TO_LAYOUT = {"ayat": "ayah_text_block", "body": "body", "matn": "matn_block", "poem": "poem_block", "quote": "quote_block"}
SEGMENT_TO_KIND = {
    "ayah": "ayah",
    "ayat": "ayah",
    "body": "body",
    "dua": "dua",
    "hadith": "hadith",
    "matn": "matn",
    "poem": "poem",
    "prose": "body",
    "quote": "quote",
}
#: Issue code: (type, priority, action); what other codes get; ranks of priorities.
ISSUES = {
    "scripture_segment_missing_ref": ("missing_reference", "high", "Cari rujukan ayat/hadits yang tepat. Isi verified_ref sebelum status reviewed."),
    "scripture_segment_not_marked_for_review": ("review_flag", "medium", "Pastikan segmen ayat/hadits tetap butuh review sampai rujukan diverifikasi."),
    "segment_text_not_exact_source_substring": ("source_mismatch", "blocker", "Jangan merge. Regenerate proposal dengan span_id exact dari source."),
    "source_span_text_mismatch": ("source_mismatch", "blocker", "Jangan merge. Periksa source_span start/end terhadap manuscript canonical."),
    "latin_technical_term_in_arabic_label": ("arabic_label_cleanup", "low", "Ganti label Arab agar tidak memuat istilah teknis Latin."),
}
DEFAULT_PRIORITY, DEFAULT_ACTION = "medium", "Review manual berdasarkan finding validator."
PRIORITY_RANK = {"blocker": 10, "high": 20, "medium": 40, "low": 70}


def starts_with_any(text: Column, openers: list[str]) -> Column:
    return F.coalesce(*(F.when(text.startswith(o), True) for o in openers), F.lit(False))


def lookup(table: dict[str, str], key: Column, default: str | None = None) -> Column:
    """The value of a small fixed table."""
    found = F.get(F.filter(F.array(*(F.struct(F.lit(k).alias("k"), F.lit(v).alias("v")) for k, v in table.items())), lambda e: e["k"] == key), F.lit(0))["v"]
    return found if default is None else F.coalesce(found, F.lit(default))


def passage_role(flat: Column, section: Column | None = None) -> Column:
    """The first role whose opener and length fit: ayat, matn or body. ``flat`` has single blanks; ``section`` is the path."""
    n = F.length(flat)
    within = F.contains(F.coalesce(section, F.lit("")), F.lit(SECTION_MARK)) if section is not None else F.lit(False)
    return (
        F.when(starts_with_any(flat, SCRIPTURE_OPENERS), "ayat")
        .when(starts_with_any(flat, PRAYER_OPENERS) & (n <= 1800), "matn")
        .when(within & (n <= 1600) & starts_with_any(flat, SECTION_OPENERS), "matn")
        .when(starts_with_any(flat, BASMALAH) & (n <= 220), "matn")
        .otherwise("body")
    )


def is_verse(lines: Column) -> Column:
    """Of stripped lines that are not empty: two or more, none longer than 90 characters, two or more with a blank."""
    return (F.size(lines) >= 2) & (F.array_max(F.transform(lines, lambda x: F.length(x))) <= 90) & (F.size(F.filter(lines, lambda x: F.contains(x, F.lit(" ")))) >= 2)


def draft(rows: DataFrame, key: str = "doc_id", text: str = "text", section: str | None = None) -> DataFrame:
    """(key, kind, role, layout, confidence, signals): overrides follow each other, the confidence is the highest of them.

    Each step reads the role that the steps before it left; the text is brought into shape once.
    """
    path = F.lit("") if section is None else F.coalesce(F.array_join(section, " / "), F.lit(""))
    bare = F.coalesce(F.col(text), F.lit(""))
    out = rows.select(key, bare.alias("_text"), path.alias("_path")).withColumn("_flat", T.normalize_space(F.col("_text"))).withColumn("_n", F.length("_flat"))
    flat, n, role = F.col("_flat"), F.col("_n"), F.col("role")
    out = out.withColumn("role", passage_role(flat, F.col("_path"))).withColumn("_quoted", flat.rlike(SCRIPTURE_SIGNAL))
    poem = F.contains("_path", F.lit(POEM_SECTION)) & (n <= 1200)
    lines = F.filter(F.transform(F.split("_text", "[\n\r]+"), lambda x: T.strip(x)), lambda x: x != "")
    out = out.withColumn("_lines", F.when(poem, lines))
    steps = [
        (role == "matn", None, "matn_opening_or_shalawat_section", 0.78),
        (F.col("_quoted") & (n <= 420) & starts_with_any(flat, QUOTED_OPENERS), "ayat", None, 0.68),
        (starts_with_any(flat, REPORT_OPENERS) & (n <= 900), "quote", "short_hadith_or_report_opening", 0.72),
        (poem & F.coalesce(is_verse(F.col("_lines")), F.lit(False)), "poem", "poetry_section", 0.64),
        (starts_with_any(flat, DEVOTIONAL_OPENERS) & (n <= 1400), "matn", "short_devotional_opening", 0.80),
    ]
    out = out.withColumns({f"_s{k}": test for k, (test, *_) in enumerate(steps)})
    final, confidence = role, F.lit(0.52)
    for k, (_, new, _, score) in enumerate(steps):
        final = F.when(F.col(f"_s{k}"), new).otherwise(final) if new else final
        confidence = F.greatest(confidence, F.when(F.col(f"_s{k}"), score).otherwise(0.52))
    named = [F.when(F.col(f"_s{k}"), F.lit(signal)) for k, (_, _, signal, _) in enumerate(steps) if signal]
    signals = F.array_compact(F.array(named[0], F.when(F.col("_quoted"), "contains_quran_signal"), *named[1:]))
    out = out.select(key, final.alias("role"), confidence.alias("confidence"), F.when(F.size(signals) > 0, signals).otherwise(F.array(F.lit("default_body"))).alias("signals"))
    return out.select(key, F.when(role == "ayat", "ayah").otherwise(role).alias("kind"), "role", lookup(ROLE_TO_LAYOUT, role, "body").alias("layout"), "confidence", "signals")


def resolved_role(role: Column, kind: Column, layout: Column) -> Column:
    """The role of an annotation: its own if it is one, else its kind's, else (without a kind) its layout's; null if none."""
    known = sorted(set(KIND_TO_ROLE.values()))
    return F.when(role.isin(*known), role).when(kind.isNotNull(), lookup(KIND_TO_ROLE, kind)).otherwise(lookup(KIND_TO_ROLE, F.regexp_replace(layout, "_block$", "")))


def first_match(value: Column, table: list[tuple[str, str]], default: str) -> Column:
    """The result of the first pattern that matches: a rule table as one expression."""
    return F.coalesce(*(F.when(value.rlike(p), out) for p, out in table), F.lit(default))


def _at(value: Column, path: str, kind: str = "string") -> Column:
    return F.try_variant_get(value, path, kind)


def _type(value: Column) -> Column:
    """The variant's type as text; null for what is not there."""
    return F.schema_of_variant(value)


_NUMBER, _WHOLE = "^(TINYINT|SMALLINT|INT|BIGINT|FLOAT|DOUBLE|DECIMAL)", "^(TINYINT|SMALLINT|INT|BIGINT)"


def parsed_proposals(rows: DataFrame, raw: str = "raw") -> DataFrame:
    """Raw proposals (JSON text) as ``v`` and the fields that the rules test, types untouched."""
    v = F.col("v")
    parsed = rows.withColumn("v", F.try_parse_json(raw))
    return parsed.select(
        *rows.columns,
        "v",
        F.coalesce(_type(v).startswith("OBJECT"), F.lit(False)).alias("is_object"),
        _at(v, "$.id").alias("id"),
        _at(v, "$.primary_kind").alias("kind"),
        _at(v, "$.layout_component").alias("layout"),
        _at(v, "$.confidence", "variant").alias("confidence"),
        _at(v, "$.segments", "variant").alias("segments"),
    )


def label_texts(v: Column) -> Column:
    """All label texts of a proposal that are not blank, as structs (path, value)."""
    entry = lambda path, value: F.struct(path.alias("path"), value.alias("value"))
    name = lambda head, i, tail: F.concat(F.lit(f"{head}["), i.cast("string"), F.lit(f"]{tail}"))
    none = F.array().cast("array<struct<path:string,value:string>>")
    each = F.coalesce(_at(v, "$.enhancements", "array<variant>"), F.array().cast("array<variant>"))
    notes = F.coalesce(_at(v, "$.review_notes", "array<variant>"), F.array().cast("array<variant>"))
    field = lambda k: F.transform(each, lambda e, i: entry(name("enhancements", i, f".{k}"), _at(e, f"$.{k}")))
    fields = [field(k) for k in ("title_ar", "reason_ar")]
    noted = F.transform(notes, lambda e, i: entry(name("review_notes", i, ""), F.when(_type(e) == "STRING", _at(e, "$"))))
    whole = F.concat(F.array(entry(F.lit("reason_ar"), _at(v, "$.reason_ar"))), *(F.coalesce(f, none) for f in fields), F.coalesce(noted, none))
    return F.filter(whole, lambda e: T.strip(F.coalesce(e["value"], F.lit(""))) != "")


def proposal_findings(proposals: DataFrame, passages: DataFrame) -> DataFrame:
    """(id, code, severity, segment_index, sample): all that is wrong with raw proposals (``raw``: JSON text), held against
    their passages (id, text). Values are tested as the types they have in the JSON."""
    rows = parsed_proposals(proposals)
    segments = F.col("segments")
    rows = rows.withColumns(
        {
            "listed": F.coalesce(_type(segments).startswith("ARRAY"), F.lit(False)),
            "none": segments.isNull() | (_type(segments) == "VOID"),
            "certain": F.coalesce(_type(F.col("confidence")).rlike(_NUMBER), F.lit(False)) & F.coalesce(_at(F.col("confidence"), "$", "double").between(0, 1), F.lit(False)),
        }
    )
    whole = rows.where("is_object")
    named = whole.where(F.coalesce("id", F.lit("")) != "").join(passages.select("id", F.coalesce("text", F.lit("")).alias("_text"), F.lit(True).alias("_known")), "id", "left")
    listed, empty, number = F.col("listed"), F.col("none"), F.col("certain")
    count = F.when(listed, F.size(_at(segments, "$", "array<variant>"))).otherwise(0)
    member = lambda value, allowed: F.coalesce(value.isin(*allowed), F.lit(False))
    known = named.where("_known")
    of_row = [
        findings(rows.where("not is_object").withColumn("id", F.lit(None).cast("string")), "id", [Rule("invalid_proposal_row", "fail", F.lit(True))]),
        findings(whole, "id", [Rule("missing_proposal_id", "fail", F.coalesce("id", F.lit("")) == "")]),
        findings(named, "id", [Rule("unknown_passage_id", "fail", F.col("_known").isNull())]),
        findings(
            known,
            "id",
            [
                Rule("invalid_primary_kind", "fail", ~member(F.col("kind"), KINDS)),
                Rule("invalid_layout_component", "fail", ~member(F.col("layout"), LAYOUTS)),
                Rule("invalid_confidence", "warn", ~number),
                Rule("invalid_segments", "fail", ~empty & ~listed),
                Rule("scripture_without_segments", "warn", member(F.col("kind"), SCRIPTURE) & (count == 0)),
            ],
        ),
        findings(known.select("id", F.explode(label_texts(F.col("v"))).alias("l")), "id", [Rule("latin_technical_term_in_arabic_label", "warn", F.col("l.value").rlike(TECHNICAL), F.col("l.value"))]),
        findings(named.groupBy("id").agg(F.count("*").alias("n")), "id", [Rule("duplicate_proposal_id", "fail", F.col("n") > 1)]),
    ]
    each = known.where(listed).select("id", "_text", F.posexplode(_at(segments, "$", "array<variant>")).alias("segment_index", "s"))
    s, text = F.col("s"), F.col("seg_text")
    each = each.select(
        "id",
        "_text",
        F.col("segment_index").cast("long").alias("segment_index"),
        F.coalesce(_type(s).startswith("OBJECT"), F.lit(False)).alias("is_object"),
        _at(s, "$.kind").alias("seg_kind"),
        F.coalesce(_at(s, "$.text"), F.lit("")).alias("seg_text"),
        F.coalesce(_at(s, "$.validation_error"), F.lit("")).alias("carried"),
        F.coalesce(_at(s, "$.ref"), F.lit("")).alias("ref"),
        F.coalesce(_at(s, "$.review_required", "boolean"), F.lit(False)).alias("review"),
        F.coalesce(_type(_at(s, "$.source_span", "variant")).startswith("OBJECT"), F.lit(False)).alias("spanned"),
        *(F.when(_type(_at(s, f"$.source_span.{x}", "variant")).rlike(_WHOLE), _at(s, f"$.source_span.{x}", "int")).alias(x) for x in ("start", "end")),
    )
    start, end, spanned = F.col("start"), F.col("end"), F.col("spanned")
    inside = F.coalesce((start >= 0) & (end >= start), F.lit(False))
    scripture = member(F.col("seg_kind"), SCRIPTURE)
    ok = F.col("is_object")
    of_segment = findings(
        each,
        ["id", "segment_index"],
        [
            Rule("invalid_segment", "fail", ~ok),
            Rule(F.col("carried"), "fail", ok & (F.col("carried") != ""), text),
            Rule("invalid_segment_kind", "fail", ok & ~member(F.col("seg_kind"), SEGMENT_KINDS)),
            Rule("segment_text_not_exact_source_substring", "fail", ok & (text != "") & (F.col("_text") != "") & (F.instr(F.col("_text"), text) == 0), text),
            Rule("invalid_source_span_range", "fail", ok & spanned & ~inside),
            Rule("source_span_text_mismatch", "fail", ok & spanned & inside & (F.substring(F.col("_text"), start + 1, end - start) != text), text),
            Rule("scripture_segment_empty", "warn", ok & scripture & (text == "")),
            Rule("scripture_segment_missing_ref", "warn", ok & scripture & (F.col("ref") == ""), text),
            Rule("scripture_segment_not_marked_for_review", "warn", ok & scripture & ~F.col("review"), text),
        ],
    )
    out = of_segment
    for part in of_row:
        out = out.unionByName(part.withColumn("segment_index", F.lit(None).cast("long")))
    return out.select("id", "code", "severity", "segment_index", F.nullif(F.col("sample"), F.lit("")).alias("sample"))


def merge_gate(draft_rows: DataFrame, proposals: DataFrame, found: DataFrame, key: str = "id", approved: list | None = None, allow_warnings: bool = False) -> DataFrame:
    """(key, accepted, reason): what the merge would do with each proposal.

    Failures are never accepted; warnings only where they are allowed or the id is approved.
    """
    worst = found.groupBy(key).agg(F.max(rank(F.col("severity"))).alias("_worst"))
    rows = proposals.select(key).distinct().join(draft_rows.select(key, F.lit(True).alias("_draft")).distinct(), key, "left").join(worst, key, "left")
    waved = F.lit(allow_warnings) | (F.col(key).isin(*approved) if approved else F.lit(False))
    level = F.coalesce("_worst", F.lit(0))
    reason = F.when(F.col("_draft").isNull(), "no_draft").when(level == 3, "has_failures").when((level == 2) & ~waved, "needs_approval").otherwise("accepted")
    return rows.select(key, (reason == "accepted").alias("accepted"), reason.alias("reason"))


def merged(draft_rows: DataFrame, proposals: DataFrame, gate: DataFrame, approved: list | None = None, key: str = "id") -> DataFrame:
    """The drafts (key, kind, role, layout, confidence, signals), those with an accepted proposal (key, kind, layout,
    confidence) replaced by it: (…, status, review_decision). Signals are united and sorted."""
    taken = gate.where("accepted").select(key)
    new = proposals.join(taken, key, "left_semi").select(key, F.col("kind").alias("_kind"), F.col("layout").alias("_component"), F.col("confidence").alias("_confidence"), F.lit(True).alias("_new"))
    fresh = F.col("_new").isNotNull()
    kind = F.coalesce(F.nullif("_kind", F.lit("")), "kind", F.lit("body"))
    role = F.when(fresh, lookup(KIND_TO_ROLE, kind, "body")).otherwise(F.col("role"))
    decision = F.when(F.col(key).isin(*approved), "approved").otherwise("auto") if approved else F.lit("auto")
    given = F.array(F.lit("llm_semantic_proposal"), F.concat(F.lit("llm_component:"), F.coalesce(F.nullif("_component", F.lit("")), F.lit("body"))))
    return draft_rows.join(new, key, "left").select(
        key,
        F.when(fresh, kind).otherwise(F.col("kind")).alias("kind"),
        role.alias("role"),
        F.when(fresh, lookup(ROLE_TO_LAYOUT, role, "body")).otherwise(F.col("layout")).alias("layout"),
        F.coalesce("_confidence", "confidence").alias("confidence"),
        F.when(fresh, F.array_sort(F.array_union(F.coalesce("signals", F.array().cast("array<string>")), given))).otherwise(F.col("signals")).alias("signals"),
        F.when(fresh, F.when(decision == "approved", "reviewed").otherwise("machine_validated")).otherwise("draft").alias("status"),
        F.when(fresh, decision).alias("review_decision"),
    )


def issue_table(spark) -> DataFrame:
    """The issue codes as rows (a few dozen at most)."""
    return spark.createDataFrame([(c, *v) for c, v in ISSUES.items()], "code string, issue_type string, priority string, action string")


def review_queue(found: DataFrame, key: str) -> DataFrame:
    """``found`` (key, code, …) with issue_type, priority, action and priority_rank; unknown codes are their own type."""
    dim = F.broadcast(issue_table(found.sparkSession))  # bounded by the length of ISSUES
    rows = found.join(dim, "code", "left")
    priority = F.coalesce("priority", F.lit(DEFAULT_PRIORITY))
    given = [c for c in found.columns if c not in (key, "code")]
    return rows.select(
        key,
        "code",
        *given,
        F.coalesce("issue_type", "code").alias("issue_type"),
        priority.alias("priority"),
        F.coalesce("action", F.lit(DEFAULT_ACTION)).alias("action"),
        lookup({k: str(v) for k, v in PRIORITY_RANK.items()}, priority).cast("long").alias("priority_rank"),
    )


def queue_items(found: DataFrame, proposals: DataFrame, passages: DataFrame) -> DataFrame:
    """The review queue: findings (id, code, severity, segment_index, sample) with their proposal (id, kind, segments:
    array<struct<kind,ref,text>>) and passage (id, sequence), and the segment at the finding's place if there is one."""
    rows = review_queue(found, "id").join(proposals.select("id", F.col("kind").alias("proposal_kind"), "segments"), "id", "left").join(passages.select("id", "sequence"), "id", "left")
    at = F.when(F.col("segment_index") >= 0, F.get("segments", F.col("segment_index").cast("int")))
    text = F.coalesce(F.nullif(at["text"], F.lit("")), "sample", F.lit(""))
    place = F.coalesce(F.concat(F.lit("s"), F.col("segment_index").cast("string")), F.lit("row"))
    return rows.select(
        F.concat_ws(":", "id", place, "code").alias("queue_id"),
        F.col("id").alias("passage_id"),
        F.coalesce("sequence", F.lit(0)).cast("long").alias("sequence"),
        "proposal_kind",
        "severity",
        "code",
        "issue_type",
        "priority",
        "action",
        "priority_rank",
        "segment_index",
        at["kind"].alias("segment_kind"),
        F.coalesce(at["ref"], F.lit("")).alias("segment_ref"),
        T.truncate(text, 220).alias("text_preview"),
        F.lit("needs_review").alias("status"),
    )


def queue_order() -> list[Column]:
    """Sort keys of the review queue: missing sequences first, findings on a whole row after those on its segments."""
    return [F.coalesce("sequence", F.lit(0)), F.coalesce("segment_index", F.lit(9999)), F.col("code")]


def review_tasks(queue: DataFrame, key: str, work: Column) -> DataFrame:
    """Tasks with a stable id; a finding that stands in the queue twice is one task."""
    text = F.concat_ws(":", F.col(key).cast("string"), "code")
    return queue.withColumn("task_id", T.stable_id(work, F.col("issue_type"), text)).dropDuplicates(["task_id"])
