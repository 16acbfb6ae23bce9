"""Read queries: listings with keyset paging, lexical search, task boards and histories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def page_after(rows: DataFrame, key: str, cursor: object | None, limit: int = 50) -> DataFrame:
    """The next ``limit`` rows after ``cursor`` in key order; the filter reaches the scan, the limit is a top-k."""
    found = rows if cursor is None else rows.where(F.col(key) > cursor)
    return found.orderBy(key).limit(min(limit, 200))


def lexical_search(rows: DataFrame, key: str, text: str, terms: list[str], limit: int = 20, reach: int = 40) -> DataFrame:
    """(key, score, snippet): texts with all terms, most occurrences first; the snippet begins before the first term."""
    low = F.lower(F.col(text))
    counts = [F.regexp_count(low, F.lit(f"\\Q{t.lower()}\\E")).cast("long") for t in terms]
    score = sum(counts[1:], counts[0])
    found = rows
    for t in terms:
        found = found.where(F.contains(low, F.lit(t.lower())))
    first = F.greatest(F.instr(low, F.lit(terms[0].lower())) - reach, F.lit(1))
    scored = found.select(key, score.alias("score"), F.substring(F.col(text), first, F.lit(2 * reach)).alias("snippet"))
    return scored.orderBy(F.desc("score"), key).limit(limit)


def sections(passages: DataFrame, path: str, key: str) -> DataFrame:
    """(path, first_id, n_passages) of each section."""
    return passages.groupBy(path).agg(F.min(key).alias("first_id"), F.count("*").alias("n_passages"))


def board(tasks: DataFrame, statuses: list[str], *order: Column, limit: int = 50, **equal: object) -> DataFrame:
    """Tasks of some statuses and given fields, ordered and cut: every index-backed task, revision and audit query."""
    found = tasks.where(F.col("status").isin(*statuses))
    for name, value in equal.items():
        found = found.where(F.col(name) == value)
    return found.orderBy(*order).limit(limit)


def share_of_total(rows: DataFrame, key: str) -> DataFrame:
    """(key, n, share): mentions of each entity and their share of all."""
    n = rows.groupBy(key).agg(F.count("*").alias("n"))
    total = n.agg(F.sum("n").alias("total")).scalar()
    return n.select(key, "n", (F.col("n") / total).alias("share"))


def thread(rows: DataFrame, *order: Column, limit: int = 50, **equal: object) -> DataFrame:
    """Rows of given fields in order: comments on a target, log entries of an actor or a target."""
    found = rows
    for name, value in equal.items():
        found = found.where(F.col(name) == value)
    return found.orderBy(*order).limit(limit)


def passages(
    rows: DataFrame,
    equal: dict[str, object],
    key: str,
    cursor: object | None = None,
    limit: int = 50,
    semantic: DataFrame | None = None,
    translations: DataFrame | None = None,
) -> DataFrame:
    """A page of passages of given fields; what to include is joined to the page, not to the table."""
    found = rows
    for name, value in equal.items():
        found = found.where(F.col(name) == value)
    page = page_after(found, key, cursor, limit)
    for more in (semantic, translations):
        if more is not None:
            page = page.join(more, key, "left")
    return page


def edition_citation(refs: Column, edition: Column, default: Column) -> Column:
    """The entry of an edition in a map of references; of the work's default edition where none is asked for."""
    return F.try_element_at(refs, F.coalesce(edition, default))


def listed(rows: DataFrame, key: str, status: str | None = None, cursor: object | None = None, limit: int = 50) -> DataFrame:
    """A page of works or editions in key order; ``status`` lists the states wanted, parted by commas."""
    states = [s.strip() for s in (status or "").split(",") if s.strip()]
    found = rows.where(F.col("status").isin(*states)) if states else rows
    return page_after(found, key, cursor, limit)


def annotated_passages(rows: DataFrame, semantic: DataFrame, key: str, kind: str | None = None, role: str | None = None, section: str | None = None, cursor: object | None = None, limit: int = 50) -> DataFrame:
    """A page of passages (key, section_path, …) of a section and of a kind and role, which ``semantic`` (key, kind, role)
    gives them. Only the annotations that fit meet the passages; without a kind or role all passages are listed."""
    found = rows if section is None else rows.where(F.array_contains("section_path", section))
    wanted = semantic.select(key, "kind", "role")
    for name, value in (("kind", kind), ("role", role)):
        if value is not None:
            wanted = wanted.where(F.col(name) == value)
    if cursor is not None:  # before the join, so that it reaches both scans
        found, wanted = found.where(F.col(key) > cursor), wanted.where(F.col(key) > cursor)
    how = "left" if kind is None and role is None else "inner"
    return found.join(wanted, key, how).orderBy(key).limit(min(limit, 200))


#: Fields that no query filters or orders by, by collection.
UNINDEXED = {"reviewTasks": ["text_preview", "source"], "revisions": ["base_value", "proposed_value"], "comments": ["body"], "auditLogs": ["metadata"]}


def light(rows: DataFrame, collection: str) -> DataFrame:
    """``rows`` without the large fields of their collection: a board then reads none of their bytes."""
    return rows.drop(*UNINDEXED.get(collection, []))
