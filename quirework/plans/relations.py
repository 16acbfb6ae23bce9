"""Queries on relations between tables: set differences, coverage, multisets, drift, upserts and breaks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quirework.functions import text as T
from quirework.operators import matching, sequence
from quirework.plans.registry import register
from quirework.session import table


@register(
    "id_set_difference",
    """
    SELECT 'left' AS side, doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
    UNION ALL SELECT 'right', doc_id FROM (SELECT DISTINCT doc_id FROM labels) WHERE doc_id NOT IN (SELECT doc_id FROM documents)
    """,
)
def id_set_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids that only the documents or only the labels have."""
    return matching.id_difference(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "doc_id")


@register(
    "annotation_coverage",
    """
    SELECT lang, count(*)::BIGINT AS total, count(l.doc_id)::BIGINT AS covered, count(l.doc_id) / count(*)::DOUBLE AS share
    FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l USING (doc_id) GROUP BY lang
    """,
)
def annotation_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of documents with a label, per language."""
    return matching.coverage(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "doc_id", "lang")


@register(
    "toc_multiset_match",
    """
    WITH t AS (SELECT lower(string_split(text, ' ')[1]) AS title, count(*) AS a FROM documents GROUP BY 1),
    h AS (SELECT lower(string_split(text, ' ')[1]) AS title, count(*) AS b FROM conversations GROUP BY 1)
    SELECT title, coalesce(a, 0)::BIGINT AS n_left, coalesce(b, 0)::BIGINT AS n_right, least(coalesce(a, 0), coalesce(b, 0))::BIGINT AS matched,
      (coalesce(a, 0) - least(coalesce(a, 0), coalesce(b, 0)))::BIGINT AS unmatched FROM t FULL JOIN h USING (title)
    """,
)
def toc_multiset_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First words of documents matched with those of turns, each used once."""
    first = F.lower(F.get(F.split("text", " "), F.lit(0))).alias("title")
    left, right = (table(spark, sf_dir, t).select(first) for t in ("documents", "conversations"))
    return matching.multiset_match(left, right, "title")


@register(
    "heading_level_skips",
    """
    WITH h AS (SELECT conv_id, turn, CASE role WHEN 'system' THEN 1 WHEN 'user' THEN 2 ELSE 4 END AS level FROM conversations),
    w AS (SELECT *, lag(level) OVER (PARTITION BY conv_id ORDER BY turn) AS p FROM h)
    SELECT conv_id, turn, level::BIGINT AS level, p::BIGINT AS previous_level FROM w WHERE level > p + 1
    """,
)
def heading_level_skips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns that skip a level, with roles as heading levels."""
    level = F.when(F.col("role") == "system", 1).when(F.col("role") == "user", 2).otherwise(4).cast("long")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", level.alias("level"))
    return sequence.level_skips(rows, "conv_id", "turn", "level")


@register(
    "upsert_keep_last",
    """
    SELECT user_id, event_id, event_type, value FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1
    """,
)
def upsert_keep_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last event of each user wins."""
    rows = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type", "value")
    return sequence.keep_last(rows, ["user_id"], "ts", "event_id").select("user_id", "event_id", "event_type", "value")


@register(
    "keep_first_by_key",
    "SELECT lang, n_chars, min(doc_id)::BIGINT AS doc_id FROM documents GROUP BY lang, n_chars",
)
def keep_first_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first document of each language and length."""
    rows = table(spark, sf_dir, "documents").select("lang", "n_chars", "doc_id")
    return sequence.keep_first(rows, ["lang", "n_chars"], "doc_id")


@register(
    "break_heuristic",
    """
    WITH g AS (SELECT *, CASE WHEN lag(ts) OVER w IS NULL OR ts > lag(ts) OVER w + INTERVAL 6 HOUR OR event_type = 'signup' THEN 1 ELSE 0 END AS opens
      FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    s AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS group_no FROM g)
    SELECT user_id, group_no::BIGINT AS group_no, count(*)::BIGINT AS n, min(event_id)::BIGINT AS first_event FROM s GROUP BY user_id, group_no
    """,
)
def break_heuristic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of events: a gap of six hours or a sign-up begins a new one."""
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", F.struct("ts", "event_id").alias("o"))
    before = F.lag("o.ts").over(Window.partitionBy("user_id").orderBy("o"))
    marked = rows.withColumn("opens", before.isNull() | (F.col("o.ts") > before + F.expr("INTERVAL 6 HOURS")) | (F.col("event_type") == "signup"))
    grouped = sequence.breaks(marked, "user_id", "o", F.col("opens"))
    return grouped.groupBy("user_id", "group_no").agg(F.count("*").alias("n"), F.min("event_id").alias("first_event"))


@register(
    "field_drift",
    """
    WITH c AS (SELECT c_custkey, c_mktsegment, c_nationkey::VARCHAR AS c_nationkey FROM customer),
    n AS (SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN lower(c_mktsegment) ELSE c_mktsegment END AS c_mktsegment,
      CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_nationkey END AS c_nationkey FROM c)
    SELECT c_custkey, 'c_mktsegment' AS field, c.c_mktsegment AS expected, n.c_mktsegment AS actual FROM c JOIN n USING (c_custkey) WHERE c.c_mktsegment IS DISTINCT FROM n.c_mktsegment
    UNION ALL SELECT c_custkey, 'c_nationkey', c.c_nationkey, n.c_nationkey FROM c JOIN n USING (c_custkey) WHERE c.c_nationkey IS DISTINCT FROM n.c_nationkey
    """,
)
def field_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields that differ between two versions of a table; null equals null."""
    old = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    new = old.select(
        "c_custkey",
        F.when(F.col("c_custkey") % 5 == 0, F.lower("c_mktsegment")).otherwise(F.col("c_mktsegment")).alias("c_mktsegment"),
        F.when(F.col("c_custkey") % 7 != 0, F.col("c_nationkey")).alias("c_nationkey"),
    )
    return matching.field_drift(old, new, "c_custkey", ["c_mktsegment", "c_nationkey"])


@register("dangling_references", "SELECT doc_id, toxic::BIGINT AS toxic FROM labels WHERE doc_id NOT IN (SELECT item_id FROM benchmark)")
def dangling_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels whose id is no benchmark item's."""
    rows = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").cast("long").alias("toxic"))
    return matching.dangling(rows, "doc_id", table(spark, sf_dir, "benchmark"), "item_id").select("doc_id", "toxic")


@register("todo_rows", "SELECT doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id) AND lang = 'en'")
def todo_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Selected documents that still lack a label."""
    chosen = table(spark, sf_dir, "documents").where("lang = 'en'").select("doc_id")
    return matching.to_do(chosen, table(spark, sf_dir, "labels"), "doc_id")


@register(
    "length_ratio_outliers",
    """
    WITH t AS (SELECT conv_id, turn, role, text, lead(role) OVER w AS nr, lead(text) OVER w AS nt FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
    SELECT conv_id, turn, length(nt)::BIGINT AS n_answer, length(text)::BIGINT AS n_question FROM t
    WHERE role = 'user' AND nr = 'assistant' AND CASE WHEN length(text) >= 80 THEN length(nt) > 4.0 * length(text) OR length(nt) < 0.25 * length(text) ELSE length(nt) > 400 END
    """,
)
def length_ratio_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers much longer or shorter than their question."""
    each = Window.partitionBy("conv_id").orderBy("turn")
    rows = table(spark, sf_dir, "conversations").withColumn("nr", F.lead("role").over(each)).withColumn("nt", F.lead("text").over(each))
    odd = rows.where((F.col("role") == "user") & (F.col("nr") == "assistant") & T.length_outlier(F.col("nt"), F.col("text")))
    return odd.select("conv_id", "turn", F.length("nt").cast("long").alias("n_answer"), F.length("text").cast("long").alias("n_question"))


@register(
    "order_revenue",
    """
    SELECT r_name, o_orderpriority, count(DISTINCT o_orderkey)::BIGINT AS n_orders, sum((l_quantity)::BIGINT)::BIGINT AS quantity
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    GROUP BY r_name, o_orderpriority
    """,
)
def order_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Star join with a distinct count: lines are summed per order first, so the join moves one row an order."""
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sum(F.col("l_quantity").cast("long")).alias("quantity"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    places = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    places = places.join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("c_custkey", "r_name")
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(places, F.col("o_custkey") == F.col("c_custkey"))
    return joined.groupBy("r_name", "o_orderpriority").agg(F.count("*").alias("n_orders"), F.sum("quantity").alias("quantity"))
