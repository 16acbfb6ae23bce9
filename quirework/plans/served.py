"""Read queries as a reader or editor would ask them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirework.operators import serve
from quirework.plans.registry import register
from quirework.session import table


@register("page_keyset", "SELECT doc_id, lang, source FROM documents WHERE doc_id > 120 ORDER BY doc_id LIMIT 50")
def page_keyset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page of 50 passages after a cursor."""
    return serve.page_after(table(spark, sf_dir, "documents").select("doc_id", "lang", "source"), "doc_id", 120)


@register(
    "search_lexical",
    """
    WITH m AS (SELECT doc_id, lower(text) AS t, text FROM documents WHERE contains(lower(text), 'the') AND contains(lower(text), 'and'))
    SELECT doc_id, ((length(t) - length(replace(t, 'the', ''))) // 3 + (length(t) - length(replace(t, 'and', ''))) // 3)::BIGINT AS score,
      substring(text, greatest(instr(t, 'the') - 40, 1), 80) AS snippet FROM m ORDER BY score DESC, doc_id LIMIT 20
    """,
)
def search_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty texts that hold two terms most often."""
    return serve.lexical_search(table(spark, sf_dir, "documents"), "doc_id", "text", ["the", "and"])


@register("sections_listing", "SELECT lang || ' > ' || source AS section, min(doc_id)::BIGINT AS first_id, count(*)::BIGINT AS n_passages FROM documents GROUP BY 1")
def sections_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sections with their first passage and number of passages."""
    rows = table(spark, sf_dir, "documents").select("doc_id", F.concat_ws(" > ", "lang", "source").alias("section"))
    return serve.sections(rows, "section", "doc_id")


_STATUS = "CASE event_type WHEN 'click' THEN 'open' WHEN 'view' THEN 'claimed' WHEN 'error' THEN 'in_review' WHEN 'purchase' THEN 'blocked' ELSE 'done' END"


@register(
    "task_board",
    f"SELECT event_id, user_id, status, prio FROM (SELECT event_id, user_id, ts, {_STATUS} AS status, (event_id % 4)::BIGINT AS prio FROM events) WHERE status IN ('open', 'claimed', 'in_review') ORDER BY prio, ts DESC, event_id LIMIT 50",
)
def task_board(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open tasks by rank, then latest first."""
    tasks = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", F.expr(_STATUS).alias("status"), (F.col("event_id") % 4).alias("prio"))
    found = serve.board(tasks, ["open", "claimed", "in_review"], F.col("prio"), F.desc("ts"), F.col("event_id"))
    return found.select("event_id", "user_id", "status", "prio")


@register(
    "my_tasks",
    f"SELECT event_id, status, prio FROM (SELECT event_id, user_id, ts, {_STATUS} AS status, (event_id % 4)::BIGINT AS prio FROM events) WHERE user_id = 8 AND status IN ('claimed', 'in_review', 'blocked') ORDER BY prio, ts DESC, event_id LIMIT 50",
)
def my_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One editor's tasks; the filter on the editor reaches the scan."""
    tasks = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", F.expr(_STATUS).alias("status"), (F.col("event_id") % 4).alias("prio"))
    return serve.board(tasks, ["claimed", "in_review", "blocked"], F.col("prio"), F.desc("ts"), F.col("event_id"), user_id=8).select("event_id", "status", "prio")


@register("passage_history", "SELECT event_id, event_type, value FROM events WHERE user_id = 46 ORDER BY ts DESC, event_id LIMIT 50")
def passage_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest revisions of one passage."""
    rows = table(spark, sf_dir, "events").where("user_id = 46").orderBy(F.desc("ts"), "event_id").limit(50)
    return rows.select("event_id", "event_type", "value")


@register("entity_share", "SELECT event_type, count(*)::BIGINT AS n, count(*) / (SELECT count(*) FROM events)::DOUBLE AS share FROM events GROUP BY event_type")
def entity_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mentions of each entity and their share of all."""
    return serve.share_of_total(table(spark, sf_dir, "events"), "event_type")


@register("attribute_groups", "SELECT (props->>'k')::BIGINT AS k, count(*)::BIGINT AS n, count(DISTINCT user_id)::BIGINT AS users FROM events GROUP BY 1")
def attribute_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events grouped by an attribute inside their JSON properties."""
    k = F.from_json("props", "k bigint")["k"]
    return table(spark, sf_dir, "events").groupBy(k.alias("k")).agg(F.count("*").alias("n"), F.countDistinct("user_id").alias("users"))


@register(
    "rag_chunks",
    "SELECT doc_id || ':' || lang AS chunk_id, sha1(text) AS digest FROM documents UNION ALL SELECT 'c' || conv_id || '.' || turn || ':en', sha1(text) FROM conversations WHERE role = 'assistant'",
)
def rag_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages and answers as chunks for retrieval, with stable ids."""
    docs = table(spark, sf_dir, "documents").select(F.concat_ws(":", "doc_id", "lang").alias("chunk_id"), F.sha1("text").alias("digest"))
    turns = table(spark, sf_dir, "conversations").where("role = 'assistant'")
    return docs.unionByName(turns.select(F.format_string("c%d.%d:en", "conv_id", "turn").alias("chunk_id"), F.sha1("text").alias("digest")))


_BOOK = "CASE (no % 4) WHEN 0 THEN 'draft' WHEN 1 THEN 'reviewed' WHEN 2 THEN 'published' ELSE 'raw_extraction' END"


@register(
    "books_of_states",
    f"""
    WITH w AS (SELECT DISTINCT source AS id, CAST(coalesce(nullif(regexp_extract(source, '[0-9]+'), ''), '0') AS INTEGER) AS no FROM documents WHERE source IS NOT NULL)
    SELECT id, {_BOOK} AS status FROM w WHERE {_BOOK} IN ('draft', 'published') ORDER BY id LIMIT 50
    """,
)
def books_of_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Works in one of two states, in order."""
    no = "cast(coalesce(nullif(regexp_extract(id, '[0-9]+', 0), ''), '0') AS int) AS no"
    works = table(spark, sf_dir, "documents").where("source is not null").select(F.col("source").alias("id")).distinct().selectExpr("id", no).selectExpr("id", f"{_BOOK} AS status")
    return serve.listed(works, "id", status="draft, published")


@register(
    "passages_of_kind",
    """
    SELECT d.doc_id AS id, d.lang, 'quote' AS kind, CASE WHEN d.doc_id % 2 = 0 THEN 'matn' ELSE 'body' END AS role FROM documents d JOIN labels l USING (doc_id)
    WHERE l.toxic = 1 AND d.doc_id % 2 = 0 AND d.doc_id > 20 AND d.source IS NOT NULL ORDER BY d.doc_id LIMIT 50
    """,
)
def passages_of_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of a kind and a role after a cursor, within any section."""
    docs = table(spark, sf_dir, "documents").where("source is not null").selectExpr("doc_id AS id", "lang", "array('all', source) AS section_path")
    marks = table(spark, sf_dir, "labels").selectExpr("doc_id AS id", "CASE toxic WHEN 1 THEN 'quote' WHEN 0 THEN 'body' END AS kind", "CASE WHEN doc_id % 2 = 0 THEN 'matn' ELSE 'body' END AS role")
    return serve.annotated_passages(docs, marks, "id", kind="quote", role="matn", section="all", cursor=20).select("id", "lang", "kind", "role")


@register(
    "work_tasks",
    f"""
    SELECT event_id, status, prio FROM (SELECT event_id, user_id, ts, {_STATUS} AS status, (event_id % 4)::BIGINT AS prio FROM events) WHERE user_id % 10 = 3 AND status = 'open' ORDER BY prio, ts DESC, event_id LIMIT 50
    """,
)
def work_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open tasks of a work by rank, then latest first; their large fields are not read."""
    rows = table(spark, sf_dir, "events").select("event_id", "ts", (F.col("user_id") % 10).alias("work_id"), F.expr(_STATUS).alias("status"), (F.col("event_id") % 4).alias("prio"), F.col("props").alias("source"), F.col("event_type").alias("text_preview"))
    tasks = serve.light(rows, "reviewTasks")
    return serve.board(tasks, ["open"], F.col("prio"), F.desc("ts"), F.col("event_id"), work_id=3).select("event_id", "status", "prio")
