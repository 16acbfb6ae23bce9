"""Constraints on documents of an editorial store: each document is JSON, and what it breaks is a list of reasons."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from quirework.functions import text as T

_TYPES = {"string": "^STRING", "number": "^(TINYINT|SMALLINT|INT|BIGINT|FLOAT|DOUBLE|DECIMAL)", "list": "^ARRAY", "map": "^OBJECT", "bool": "^BOOLEAN", "timestamp": "^(STRING|TIMESTAMP)"}


@dataclass(frozen=True)
class Field:
    """A field of a document: its type, the most characters or entries, allowed values; optional ones may be null."""

    name: str
    kind: str = "string"
    most: int | None = None
    filled: bool = False
    required: bool = True
    values: tuple[str, ...] | None = None
    between: tuple[float, float] | None = None


#: Kinds of tasks, priorities, states, targets of revisions, and the bounds of every field.
PRIORITIES = ("blocker", "high", "medium", "low")
TASK = (
    Field("schema_version", values=("0.1",)),
    Field("work_id", most=120),
    Field("task_id", most=180),
    Field("passage_id", most=80, required=False),
    Field(
        "task_type",
        values=(
            "semantic_reference_review",
            "cleaning_suspicious",
            "toc_unmatched_heading",
            "long_passage_review",
            "short_passage_review",
            "translation_warning",
            "translation_qa",
            "manual_review",
        ),
    ),
    Field("priority", values=PRIORITIES),
    Field("priority_rank", "number", between=(0, 100)),
    Field("status", values=("open", "claimed", "in_review", "blocked", "done", "cancelled")),
    Field("assigned_to", most=128, required=False),
    Field("title", most=180, filled=True),
    Field("reason", most=1200),
    Field("recommended_action", most=1200),
    Field("section_path", "list", most=12, required=False),
    Field("source_citation_label", most=400, required=False),
    Field("text_preview", most=2500, required=False),
    Field("source", "map"),
    Field("created_by", most=128),
    Field("created_at", "timestamp"),
    Field("updated_at", "timestamp"),
    Field("claimed_at", "timestamp", required=False),
    Field("done_at", "timestamp", required=False),
)
REVISION = (
    Field("schema_version", values=("0.1",)),
    Field("work_id", most=120),
    Field("passage_id", most=80),
    Field("task_id", most=180, required=False),
    Field(
        "target",
        values=(
            "passage.text",
            "passage.section_path",
            "passage.review_status",
            "semantic.kind",
            "semantic.role",
            "semantic.layout",
            "semantic.segment.ref",
            "translation.text",
            "translation.notes",
            "translation.warnings",
            "heading.title",
            "toc.entry",
        ),
    ),
    Field("base_version", most=120, required=False),
    Field("base_value", most=200_000, required=False),
    Field("proposed_value", most=200_000, required=False),
    Field("status", values=("draft", "submitted", "approved", "rejected", "applied", "superseded")),
    Field("created_by", most=128),
    Field("created_at", "timestamp"),
    Field("updated_at", "timestamp"),
    Field("submitted_at", "timestamp", required=False),
    Field("reviewed_by", most=128, required=False),
    Field("reviewed_at", "timestamp", required=False),
    Field("admin_notes", most=4000, required=False),
    Field("editor_notes", most=4000, required=False),
)
COMMENT = (
    Field("target_type", values=("reviewTask", "revision")),
    Field("target_id", most=180),
    Field("work_id", most=120),
    Field("passage_id", most=80, required=False),
    Field("body", most=8000, filled=True),
    Field("status", values=("active", "resolved", "hidden")),
    Field("created_by", most=128),
    Field("created_at", "timestamp"),
    Field("updated_at", "timestamp"),
)
USER = (
    Field("uid"),
    Field("email", most=320),
    Field("display_name", most=120, filled=True),
    Field("photo_url", most=2048, required=False),
    Field("created_at", "timestamp"),
    Field("updated_at", "timestamp"),
)
PUBLIC_USER = (Field("uid"), Field("display_name", most=120, filled=True), Field("photo_url", most=2048, required=False))
ROLES = ("end_user", "editor", "admin")
USER_ROLE = (Field("uid"), Field("roles", "map"), Field("active", "bool"), Field("created_at", "timestamp"), Field("updated_at", "timestamp"))
BOOK = (
    Field("work_id"),
    Field("title_ar", most=240),
    Field("title_id", most=240),
    Field("status", values=("raw_extraction", "draft_extraction", "draft", "reviewed", "published")),
    Field("default_edition", most=80),
    Field("canonical_repo_path", most=240),
    Field("updated_at", "timestamp"),
)


def _broken(v: Column, f: Field) -> Column:
    """The reason for which a field is wrong, or null. ``v``: the document as a variant."""
    held = F.struct(F.try_variant_get(v, f"$.{f.name}", "variant").alias("value"), F.try_variant_get(v, f"$.{f.name}", "string").alias("text"))
    typed = lambda x: F.struct(x["value"].isNull().alias("absent"), F.schema_of_variant(x["value"]).alias("kind"), x["text"].alias("text"))
    return T.bind(held, lambda x: T.bind(typed(x), lambda t: _reason(v, f, t["absent"], t["kind"], t["text"])))


def _reason(v: Column, f: Field, absent: Column, kind: Column, text: Column) -> Column:
    null = F.coalesce(kind == "VOID", F.lit(False)) & F.lit(f.kind != "list")
    wrong = ~F.coalesce(kind.rlike(_TYPES[f.kind]), F.lit(False))
    if f.kind == "timestamp":
        wrong = wrong | F.try_to_timestamp(text).isNull()
    reason = F.when(wrong, f"type:{f.name}")
    if f.values:
        reason = reason.when(~text.isin(*f.values), f"value:{f.name}")
    if f.most is not None:
        size = F.size(F.try_variant_get(v, f"$.{f.name}", "array<variant>")) if f.kind == "list" else F.length(text)
        reason = reason.when(size > f.most, f"size:{f.name}")
    if f.filled:
        reason = reason.when(F.length(text) == 0, f"empty:{f.name}")
    if f.between:
        reason = reason.when(~F.try_variant_get(v, f"$.{f.name}", "double").between(*f.between), f"range:{f.name}")
    return F.when(absent, F.lit(f"missing:{f.name}") if f.required else None).when(null & F.lit(not f.required), None).otherwise(reason)


def violations(raw: Column, fields: tuple[Field, ...]) -> Column:
    """array<string> of what a JSON document breaks: unknown keys, missing or wrong fields; empty when it is valid."""
    return T.bind(F.try_parse_json(raw), lambda v: _violations(v, fields))


def _violations(v: Column, fields: tuple[Field, ...]) -> Column:
    keys = F.coalesce(F.map_keys(F.try_variant_get(v, "$", "map<string,variant>")), F.array().cast("array<string>"))
    unknown = F.transform(F.array_sort(F.array_except(keys, F.array(*(F.lit(f.name) for f in fields)))), lambda k: F.concat(F.lit("unknown:"), k))
    broken = F.array_compact(F.array(*(_broken(v, f) for f in fields)))
    return F.when(F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False)), F.concat(unknown, broken)).otherwise(F.array(F.lit("not_an_object")))


def role_violations(raw: Column) -> Column:
    """Those of a role document, with each role that is unknown or no truth value."""
    roles = F.coalesce(F.try_variant_get(F.try_parse_json(raw), "$.roles", "map<string,variant>"), F.create_map().cast("map<string,variant>"))
    wrong = F.map_filter(roles, lambda k, v: ~k.isin(*ROLES) | ~F.coalesce(F.schema_of_variant(v) == "BOOLEAN", F.lit(False)))
    return F.concat(violations(raw, USER_ROLE), F.transform(F.array_sort(F.map_keys(wrong)), lambda k: F.concat(F.lit("role:"), k)))


def may_claim(old_status: Column, new_status: Column, new_assignee: Column, uid: Column, changed: Column) -> Column:
    """Claiming a task: from open to claimed or in review, for oneself, changing only the four fields of a claim."""
    fields = F.array(*map(F.lit, ("status", "assigned_to", "claimed_at", "updated_at")))
    return F.coalesce((old_status == "open") & new_status.isin("claimed", "in_review") & (new_assignee == uid), F.lit(False)) & (F.size(F.array_except(changed, fields)) == 0)


#: Fields of a revision that its author may not change.
FROZEN = ("schema_version", "work_id", "passage_id", "task_id", "target", "created_by", "created_at", "reviewed_by", "reviewed_at", "admin_notes")


def may_edit_revision(old: Column, new: Column, uid: Column) -> Column:
    """Editing an own revision (JSON texts): it was and stays the author's, draft or submitted, its frozen fields untouched."""
    a, b = F.try_parse_json(old), F.try_parse_json(new)
    get = lambda v, name: F.try_variant_get(v, f"$.{name}", "string")
    own = (get(a, "created_by") == uid) & (get(b, "created_by") == uid)
    open_ = get(a, "status").isin("draft", "submitted") & get(b, "status").isin("draft", "submitted")
    same = F.lit(True)
    for name in FROZEN:
        same = same & get(a, name).eqNullSafe(get(b, name))
    return F.coalesce(own & open_, F.lit(False)) & same
