"""Queries on selection, spans, editorial documents and the listings of the store."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirework.functions import text as T
from quirework.operators import records, selection, serve, source_spans
from quirework.plans.registry import register
from quirework.session import table

_TASK = {
    "schema_version": "'0.1'",
    "work_id": "CASE WHEN k = 1 THEN repeat('w', 121) ELSE 'w' END",
    "task_id": "'t' || event_id",
    "task_type": "CASE WHEN k = 2 THEN 'other' ELSE 'manual_review' END",
    "priority": "CASE WHEN k = 3 THEN 'urgent' ELSE 'high' END",
    "priority_rank": "CASE WHEN k = 4 THEN 101 ELSE 20 END",
    "status": "CASE WHEN k = 5 THEN 'lost' ELSE 'open' END",
    "title": "CASE WHEN k = 6 THEN '' ELSE 'title' END",
    "reason": "'r'",
    "recommended_action": "'a'",
    "section_path": "CASE WHEN k = 7 THEN sequence(1, 13) ELSE sequence(1, 2) END",
    "source": "named_struct('a', 1)",
    "created_by": "'u'",
    "created_at": "CASE WHEN k = 8 THEN 'yesterday' ELSE '2024-01-01T00:00:00Z' END",
    "updated_at": "'2024-01-01T00:00:00Z'",
}


@register(
    "record_violations",
    """
    SELECT event_id, CASE event_id % 12 WHEN 1 THEN 'size:work_id' WHEN 2 THEN 'value:task_type' WHEN 3 THEN 'value:priority' WHEN 4 THEN 'range:priority_rank' WHEN 5 THEN 'value:status' WHEN 6 THEN 'empty:title'
      WHEN 7 THEN 'size:section_path' WHEN 8 THEN 'type:created_at' WHEN 9 THEN 'unknown:extra' WHEN 10 THEN 'missing:source' ELSE 'not_an_object' END AS reason FROM events WHERE event_id % 12 > 0
    """,
)
def record_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Review tasks as documents, each with one fault by its id, held against the constraints of the store."""
    rows = table(spark, sf_dir, "events").selectExpr("event_id", "event_id % 12 AS k")
    fields = ", ".join(f"'{name}', {value}" for name, value in _TASK.items())
    made = rows.selectExpr("event_id", "k", f"to_json(named_struct({fields})) AS raw")
    r, k = F.col("raw"), F.col("k")
    spoilt = F.when(k == 9, F.regexp_replace(r, "^[{]", '{"extra":1,')).when(k == 10, F.regexp_replace(r, '"source":[{]"a":1[}],', "")).when(k == 11, "[]").otherwise(r)
    return made.select("event_id", spoilt.alias("raw")).select("event_id", F.explode(records.violations(F.col("raw"), records.TASK)).alias("reason"))


@register(
    "task_claims",
    """
    SELECT event_id, event_id % 3 = 0 AND event_id % 5 <> 0 AND event_id % 7 <> 0 AND event_id % 11 <> 0 AS allowed FROM events
    """,
)
def task_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which claims the store would let pass: open tasks, claimed for oneself, nothing else changed."""
    rows = table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "CASE WHEN event_id % 3 = 0 THEN 'open' ELSE 'done' END AS old",
        "CASE WHEN event_id % 5 = 0 THEN 'done' WHEN event_id % 2 = 0 THEN 'claimed' ELSE 'in_review' END AS new",
        "CASE WHEN event_id % 7 = 0 THEN 'other' ELSE 'me' END AS assignee",
        "CASE WHEN event_id % 11 = 0 THEN array('status', 'title') ELSE array('status', 'claimed_at') END AS changed",
    )
    return rows.select("event_id", records.may_claim(F.col("old"), F.col("new"), F.col("assignee"), F.lit("me"), F.col("changed")).alias("allowed"))


_PIECES = ["قال رسول الله هذا قول طويل يكفي للشرط.", "اللهم صل وسلم على من نحب دائما؛", "} كلام بين الأقواس هنا {", "قال الله كلاما وهذا آخره."]


_BRACED = "} كلام آخر بين الأقواس {"


def _quoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a sentence of one kind of span after them, by their id, and every eighth with a braced one before."""
    before = F.when(F.col("doc_id") % 8 == 5, F.lit(_BRACED + "\n")).otherwise("")
    docs = table(spark, sf_dir, "documents").where("text is not null").select("doc_id", F.concat(before, "text").alias("text"))
    return docs.select("doc_id", F.concat("text", F.lit("\n"), F.get(F.array(*map(F.lit, _PIECES)), (F.col("doc_id") % 4).cast("int"))).alias("text"), F.length("text").alias("n"))


@register(
    "source_spans",
    f"""
    WITH f AS (SELECT doc_id, CASE WHEN doc_id % 8 = 5 THEN '{_BRACED}' || chr(10) || text ELSE text END AS text FROM documents WHERE text IS NOT NULL),
    d AS (SELECT doc_id, doc_id % 4 AS k, text, length(text) AS n, text || chr(10) || list_value({', '.join(repr(x) for x in _PIECES)})[doc_id % 4 + 1] AS t FROM f),
    b AS (SELECT *, regexp_replace(regexp_replace(t, '^{T.SPACE}+', ''), '{T.SPACE}+$', '') AS bare FROM d),
    s AS (SELECT doc_id, 0 AS o, 'short_whole_passage' AS reason, length(t) - length(regexp_replace(t, '^{T.SPACE}+', '')) AS a, length(t) AS b FROM b WHERE length(bare) <= 260
      UNION ALL SELECT doc_id, 1, 'brace_quran_candidate', 2, {len(_BRACED) - 2} FROM b WHERE doc_id % 8 = 5
      UNION ALL SELECT doc_id, 2, CASE k WHEN 0 THEN 'hadith_opener' WHEN 1 THEN 'dua_opener' WHEN 2 THEN 'brace_quran_candidate' ELSE 'quran_signal:قال الله' END, n + 1 + CASE k WHEN 2 THEN 2 ELSE 0 END, length(t) - CASE k WHEN 2 THEN 2 ELSE 0 END FROM b)
    SELECT doc_id, 'S' || row_number() OVER (PARTITION BY doc_id ORDER BY o) AS span_id, reason, a::BIGINT AS span_start, b::BIGINT AS span_end FROM (SELECT DISTINCT ON (doc_id, a, b) * FROM s ORDER BY o)
    """,
)
def source_spans_(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans that a proposal on a passage may point at, numbered as found."""
    found = _quoted(spark, sf_dir).select("doc_id", F.explode(source_spans.source_spans(F.col("text"))).alias("s"))
    return found.select("doc_id", "s.span_id", "s.reason", F.col("s.start").cast("long").alias("span_start"), F.col("s.end").cast("long").alias("span_end"))


@register(
    "normalized_segments",
    f"""
    WITH d AS (SELECT doc_id, doc_id % 4 AS k, list_value({', '.join(repr(x) for x in _PIECES)})[doc_id % 4 + 1] AS p FROM documents WHERE text IS NOT NULL)
    SELECT doc_id, i::BIGINT AS place, CASE WHEN i = 2 THEN true ELSE k IN (0, 1) END AS review_required, CASE i WHEN 0 THEN '' WHEN 1 THEN '' ELSE CASE WHEN k = 3 THEN 'invalid_source_span_id' ELSE 'segment_text_not_exact_source_substring' END END AS error,
      CASE i WHEN 0 THEN 'segment_text_ignored_for_span_id' WHEN 1 THEN '' ELSE CASE WHEN k = 3 THEN 'invalid_source_span_id' ELSE 'segment_text_not_exact_source_substring' END END AS warning FROM d, (VALUES (0), (1), (2)) AS v(i)
    """,
)
def normalized_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments that name their last span with other words, hold words of the text, or name a span that is not there."""
    rows = _quoted(spark, sf_dir).withColumn("spans", source_spans.source_spans(F.col("text")))
    kind = F.when(F.col("doc_id") % 4 < 2, "hadith").otherwise("quote")
    segment = lambda span, words: F.struct(kind.alias("kind"), span.alias("span_id"), F.lit("").alias("ref"), F.lit(False).alias("review_required"), words.alias("text"))
    last = F.get("spans", F.size("spans") - 1)["span_id"]
    gone = F.when(F.col("doc_id") % 4 == 3, "S99").otherwise("")
    words = F.when(F.col("doc_id") % 4 == 3, "").otherwise("\u0001 not there")
    segments = F.array(segment(last, F.lit("other words")), segment(F.lit(""), F.substring("text", F.col("n") + 2, F.lit(5))), segment(gone, words))
    shaped = rows.select("doc_id", F.posexplode(source_spans.normalized_segments(F.col("text"), segments, F.col("spans"))).alias("at", "s"))
    blank = lambda c: F.coalesce(F.col(f"s.{c}"), F.lit(""))
    return shaped.select("doc_id", F.col("at").cast("long").alias("place"), "s.review_required", blank("validation_error").alias("error"), blank("warning").alias("warning"))


@register(
    "enrichment_candidates",
    """
    WITH d AS (SELECT doc_id, text, row_number() OVER (ORDER BY doc_id) - 1 AS place FROM documents), n AS (SELECT count(*) AS n FROM d),
    c AS (SELECT doc_id, CASE WHEN doc_id % 40 = 0 THEN 'heuristic role=matn' WHEN contains(text, '} ') THEN 'contains Qur''an-like signal' WHEN length(text) > 2500 AND doc_id % 4 = 0 THEN 'long passage may need split/table/editorial treatment' END AS reason FROM d),
    f AS (SELECT *, row_number() OVER (ORDER BY doc_id) AS r FROM c WHERE reason IS NOT NULL QUALIFY r <= 60),
    s AS (SELECT d.doc_id, 'sequence spread sample' AS reason, 60 + row_number() OVER (ORDER BY d.doc_id) AS r FROM d, n WHERE place % greatest(n.n // 60, 1) = 0 AND d.doc_id NOT IN (SELECT doc_id FROM f)),
    u AS (SELECT * FROM f UNION ALL SELECT * FROM s)
    SELECT doc_id, reason FROM u ORDER BY r LIMIT 50 OFFSET 10
    """,
)
def enrichment_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fifty passages worth enriching after the first ten, filled up by an even spread."""
    rows = table(spark, sf_dir, "documents").select("doc_id", "text")
    role = F.when(F.col("doc_id") % 40 == 0, "matn").otherwise("body")
    text = F.when((F.length("text") > 2500) & (F.col("doc_id") % 4 != 0), "").otherwise(F.col("text"))
    seen = F.when(F.contains("text", F.lit("} ")), F.lit("} ")).otherwise(text)
    return selection.candidates(rows, selection.candidate_reason(seen, role, F.lit("")), "doc_id", 50, 10).select("doc_id", "reason")


@register(
    "length_tasks",
    """
    WITH d AS (SELECT doc_id, length(text) AS n FROM documents WHERE text IS NOT NULL)
    SELECT * FROM (SELECT doc_id, 'long' AS kind, n::BIGINT AS n FROM d WHERE n > 3000 ORDER BY n DESC, doc_id LIMIT 13) UNION ALL SELECT * FROM (SELECT doc_id, 'short', n::BIGINT FROM d WHERE n < 40 ORDER BY doc_id LIMIT 10)
    """,
)
def length_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tasks from the thirteen longest and ten short passages."""
    rows = table(spark, sf_dir, "documents").where("text is not null").select("doc_id", F.length("text").cast("long").alias("n"))
    kinds = rows.withColumn("kind", F.when(F.col("n") > 3000, "long").when(F.col("n") < 40, "short"))
    order = F.when(F.col("kind") == "long", -F.col("n")).otherwise(0)
    return selection.capped(kinds, {"long": 13, "short": 10}, "kind", order, "doc_id").select("doc_id", "kind", "n")


@register("top_sections", "SELECT source, count(*)::BIGINT AS n FROM documents GROUP BY source ORDER BY n DESC, min(doc_id) LIMIT 15")
def top_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fifteen sources with most passages."""
    return selection.top_sections(table(spark, sf_dir, "documents"), "source", "doc_id")


@register(
    "model_summary",
    """
    SELECT event_type AS model, count(*)::BIGINT AS tried, count(*) FILTER (WHERE user_id % 3 > 0)::BIGINT AS succeeded, avg(CASE WHEN user_id % 3 > 0 THEN event_id % 97 END)::DOUBLE AS avg_latency,
      sha1(string_agg((event_id % 97)::VARCHAR, ' / ' ORDER BY event_id)) AS latencies FROM events GROUP BY 1
    """,
)
def model_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trials by model: successes, mean latency and the latencies in order of the samples."""
    rows = table(spark, sf_dir, "events").selectExpr("event_id AS sample_id", "event_type AS model", "user_id % 3 > 0 AS ok", "event_id % 97 AS latency_seconds")
    exact = rows.groupBy(F.col("model").alias("_exact")).agg(F.avg(F.when(F.col("ok"), F.col("latency_seconds"))).alias("mean"))
    found = selection.model_summary(rows).join(exact, F.col("model").eqNullSafe(F.col("_exact")))
    return found.select("model", "tried", "succeeded", F.col("mean").alias("avg_latency"), F.sha1("latencies").alias("latencies"))


_STATE = "CASE event_type WHEN 'click' THEN 'submitted' WHEN 'view' THEN 'draft' ELSE 'applied' END"


@register("revision_queue", f"SELECT event_id, user_id FROM (SELECT *, {_STATE} AS status FROM events) WHERE status = 'submitted' ORDER BY ts DESC, event_id LIMIT 50")
def revision_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Submitted revisions, latest first."""
    rows = table(spark, sf_dir, "events").withColumn("status", F.expr(_STATE))
    return serve.board(rows, ["submitted"], F.desc("ts"), F.col("event_id")).select("event_id", "user_id")


@register("own_revisions", f"SELECT event_id, ts::VARCHAR AS at FROM (SELECT *, {_STATE} AS status FROM events) WHERE user_id = 8 AND status = 'draft' ORDER BY ts DESC, event_id LIMIT 50")
def own_revisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One author's drafts, latest first."""
    rows = table(spark, sf_dir, "events").withColumn("status", F.expr(_STATE))
    return serve.board(rows, ["draft"], F.desc("ts"), F.col("event_id"), user_id=8).select("event_id", F.col("ts").cast("string").alias("at"))


@register("comment_thread", "SELECT event_id, event_type FROM events WHERE user_id = 8 ORDER BY ts, event_id LIMIT 50")
def comment_thread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comments on one target, oldest first."""
    return serve.thread(table(spark, sf_dir, "events"), F.col("ts"), F.col("event_id"), user_id=8).select("event_id", "event_type")


@register("audit_log", "SELECT event_id, user_id FROM events WHERE event_type = 'error' ORDER BY ts DESC, event_id LIMIT 50")
def audit_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log entries of one action, latest first."""
    return serve.thread(table(spark, sf_dir, "events"), F.desc("ts"), F.col("event_id"), event_type="error").select("event_id", "user_id")


@register(
    "book_counts",
    "SELECT coalesce(source, 'none') AS work_id, count(*)::BIGINT AS passages, count(DISTINCT lang)::BIGINT AS languages, count(l.doc_id)::BIGINT AS annotated FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY 1",
)
def book_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A work with what it holds."""
    docs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels").select("doc_id", F.lit(1).alias("held")), "doc_id", "left")
    return docs.groupBy(F.coalesce("source", F.lit("none")).alias("work_id")).agg(F.count("*").alias("passages"), F.countDistinct("lang").alias("languages"), F.count("held").alias("annotated"))


@register(
    "passages_listing",
    """
    SELECT d.doc_id AS id, d.lang, CASE l.toxic WHEN 1 THEN 'quote' WHEN 0 THEN 'body' END AS kind, (1 + d.doc_id // 4)::BIGINT AS page FROM documents d LEFT JOIN labels l USING (doc_id)
    WHERE d.lang = 'en' AND d.doc_id > 60 ORDER BY d.doc_id LIMIT 50
    """,
)
def passages_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of a language after a cursor, with their annotation and their page in an edition."""
    docs = table(spark, sf_dir, "documents").selectExpr("doc_id AS id", "lang", "map('print', doc_id div 4 + 1) AS edition_refs")
    kinds = table(spark, sf_dir, "labels").selectExpr("doc_id AS id", "CASE toxic WHEN 1 THEN 'quote' WHEN 0 THEN 'body' END AS kind")
    found = serve.passages(docs, {"lang": "en"}, "id", 60, 50, semantic=kinds)
    return found.select("id", "lang", "kind", serve.edition_citation(F.col("edition_refs"), F.lit(None).cast("string"), F.lit("print")).alias("page"))
