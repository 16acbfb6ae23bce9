"""Queries on annotations: segments, paths, spans, drafts, gates, queues and tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirework.functions import text as T
from quirework.operators import annotations, editions, fuzzy, sequence, spans
from quirework.plans.registry import register
from quirework.session import table
from quirework.sources.readers import page_blocks, text_lines


@register(
    "passage_segments",
    """
    WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS n FROM documents),
    g AS (SELECT *, sum(CASE WHEN regexp_matches(line, '^([A-Z][a-z]*)[^.]*[.]$') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY n ROWS UNBOUNDED PRECEDING) AS grp FROM l),
    o AS (SELECT doc_id, grp, max(CASE WHEN regexp_matches(line, '^([A-Z][a-z]*)[^.]*[.]$') THEN regexp_extract(line, '^([A-Z][a-z]*)[^.]*[.]$', 1) END) AS segment_id,
      string_agg(CASE WHEN NOT regexp_matches(line, '^([A-Z][a-z]*)[^.]*[.]$') THEN line END, chr(10) ORDER BY n) AS body FROM g GROUP BY doc_id, grp)
    SELECT doc_id, segment_id, sha1(body) AS digest FROM o WHERE segment_id IS NOT NULL AND body IS NOT NULL
    """,
)
def passage_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of one sentence open a segment; the lines after each belong to it."""
    lines = text_lines(table(spark, sf_dir, "documents"))
    return sequence.segments(lines, "doc_id", "line_no", "line", "^([A-Z][a-z]*)[^.]*[.]$", "^#{1,6} ").select("doc_id", "segment_id", F.sha1("text").alias("digest"))


_LEVEL = "CASE role WHEN 'system' THEN 1 WHEN 'user' THEN 2 ELSE 3 + turn % 2 END"


@register(
    "section_paths",
    f"""
    WITH RECURSIVE h AS (SELECT conv_id, turn, {_LEVEL} AS level, substring(text, 1, 12) AS title, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n FROM conversations),
    p AS (SELECT conv_id, turn, n, [title] AS path FROM h WHERE n = 1 UNION ALL
      SELECT h.conv_id, h.turn, h.n, list_append(p.path[1:h.level - 1], h.title) FROM p JOIN h ON h.conv_id = p.conv_id AND h.n = p.n + 1)
    SELECT conv_id, turn, array_to_string(path, ' > ') AS section_path FROM p
    """,
)
def section_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Heading stack of every conversation, its turns being headings by role; levels skip."""
    rows = table(spark, sf_dir, "conversations").selectExpr("conv_id", "turn", f"cast({_LEVEL} AS int) AS level", "substring(text, 1, 12) AS title")
    return sequence.section_paths(rows, "conv_id", "turn", "level", "title").select("conv_id", "turn", F.array_join("section_path", " > ").alias("section_path"))


_OVERLAPPING = ("[0-9]{2,}[^ ]*", "[^ ]*[0-9]{3,}", "[A-Z]{2,}[^a-z]*")
_OFFSETS = """SELECT doc_id, {k} AS k, list_sum(list_transform(b[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(w[1:i - 1], lambda x: length(x))), 0) AS a, length(w[i]) AS n
  FROM (SELECT doc_id, w, b, unnest(range(1, len(w) + 1)) AS i FROM (SELECT doc_id, regexp_extract_all(text, '{p}') AS w, string_split_regex(text, '{p}') AS b FROM documents WHERE regexp_matches(text, '{p}')))"""


@register(
    "non_overlap_spans",
    f"""
    WITH RECURSIVE s AS (SELECT DISTINCT doc_id AS id, a, a + n AS b FROM ({' UNION ALL '.join(_OFFSETS.format(k=k, p=p) for k, p in enumerate(_OVERLAPPING))})),
    o AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY a, b) AS rn FROM s),
    k AS (SELECT id, a, b, rn, b AS cursor, true AS kept FROM o WHERE rn = 1 UNION ALL
      SELECT o.id, o.a, o.b, o.rn, CASE WHEN o.a >= k.cursor THEN o.b ELSE k.cursor END, o.a >= k.cursor FROM k JOIN o ON o.id = k.id AND o.rn = k.rn + 1)
    SELECT id AS doc_id, a::BIGINT AS span_start, b::BIGINT AS span_end FROM k WHERE kept
    """,
)
def non_overlap_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of three patterns in every text, swept: each is kept if it begins where the last one ended, or later."""
    docs = table(spark, sf_dir, "documents").where("text is not null")
    found = F.concat(*(spans.spans_of(F.col("text"), p, "any") for p in _OVERLAPPING))
    each = docs.select("doc_id", F.transform(found, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))).alias("s")).where(F.size("s") > 0)
    kept = each.select("doc_id", F.explode(spans.non_overlapping(F.array_distinct("s"))).alias("k"))
    return kept.select("doc_id", F.col("k.start").cast("long").alias("span_start"), F.col("k.end").cast("long").alias("span_end"))


@register(
    "pattern_spans",
    """
    WITH m AS (SELECT doc_id, regexp_extract_all(text, '[0-9]{3,}') AS w, string_split_regex(text, '[0-9]{3,}') AS b FROM documents WHERE regexp_matches(text, '[0-9]{3,}')),
    e AS (SELECT doc_id, w, b, unnest(range(1, len(w) + 1)) AS i FROM m),
    s AS (SELECT doc_id, w[i] AS span_text, list_sum(list_transform(b[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(w[1:i - 1], lambda x: length(x))), 0) AS span_start FROM e)
    SELECT doc_id, span_start::BIGINT AS span_start, (span_start + length(span_text))::BIGINT AS span_end, span_text FROM s
    """,
)
def pattern_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers of three digits or more with their places, widened to nothing else."""
    docs = table(spark, sf_dir, "documents").where(F.col("text").rlike("[0-9]{3,}"))
    found = docs.select("doc_id", F.explode(spans.spans_of(F.col("text"), "[0-9]{3,}", "number")).alias("s"))
    return found.select("doc_id", F.col("s.start").cast("long").alias("span_start"), F.col("s.end").cast("long").alias("span_end"), F.col("s.text").alias("span_text"))


@register(
    "span_grounding",
    """
    SELECT doc_id, item_id, (instr(d.text, b.text) - 1)::BIGINT AS start, (instr(d.text, b.text) - 1 + length(b.text))::BIGINT AS "end"
    FROM documents d JOIN benchmark b ON contains(d.text, b.text) WHERE regexp_matches(b.text, '\\S')
    """,
)
def span_grounding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where benchmark items stand in documents, word for word."""
    return spans.grounded(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))


@register(
    "text_chunks",
    f"""
    WITH c AS (SELECT doc_id, regexp_extract_all(text, '(?s)(.{{1,399}}(?:{T.SPACE}|$)|.{{1,400}})') AS p FROM documents WHERE text IS NOT NULL),
    e AS (SELECT doc_id, p, unnest(range(1, len(p) + 1)) AS i FROM c)
    SELECT doc_id, (i - 1)::BIGINT AS chunk_no, coalesce(list_sum(list_transform(p[1:i - 1], lambda x: length(x))), 0)::BIGINT AS start, sha1(p[i]) AS digest FROM e
    """,
)
def text_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks of 400 characters at most, cut at blanks, with their place."""
    cut = spans.chunks(table(spark, sf_dir, "documents").select("doc_id", "text").where("text is not null"), "doc_id", "text", 400)
    return cut.select("doc_id", F.col("chunk_no").cast("long").alias("chunk_no"), F.col("start").cast("long").alias("start"), F.sha1("chunk").alias("digest"))


@register(
    "merge_gate",
    """
    SELECT d.doc_id AS id, (l.doc_id IS NOT NULL AND l.toxic = 0 AND (l.quality = 1 OR d.doc_id % 10 = 0)) AS accepted,
      CASE WHEN l.doc_id IS NULL THEN 'no_draft' WHEN l.toxic = 1 THEN 'has_failures' WHEN l.quality = 0 AND d.doc_id % 10 <> 0 THEN 'needs_approval' ELSE 'accepted' END AS reason
    FROM documents d LEFT JOIN labels l USING (doc_id)
    """,
)
def merge_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as proposals: toxic ones fail, those of low quality need approval, which round ids have."""
    proposals = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"))
    labels = table(spark, sf_dir, "labels").withColumnRenamed("doc_id", "id")
    waved = (F.col("quality") == 0) & (F.col("id") % 10 != 0)
    severity = F.when(F.col("toxic") == 1, "fail").when(waved, "warn")
    found = labels.select("id", severity.alias("severity")).where("severity is not null")
    return annotations.merge_gate(labels, proposals, found)


@register(
    "citation_structs",
    """
    SELECT doc_id AS id, 'print' AS edition, (1 + doc_id // 4)::BIGINT AS page, CASE WHEN doc_id % 3 = 0 THEN 'p. ' || (1 + doc_id // 4) ELSE (1 + doc_id // 4)::VARCHAR END AS label,
      CASE WHEN doc_id % 2 = 0 THEN 2 ELSE 1 END::BIGINT AS n_refs FROM documents
    """,
)
def citation_structs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page map synced into edition references; flattened for comparison."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"))
    page = F.floor(F.col("id") / 4) + 1
    placed = docs.select("id", page.alias("page"), F.when(F.col("id") % 3 == 0, F.concat(F.lit("p. "), page.cast("string"))).alias("label"))
    old = editions.locator(F.lit(0).cast("long"), F.lit("old"))
    empty = F.map_filter(F.create_map(F.lit("web"), old), lambda k, v: F.lit(False))
    before = docs.withColumn("edition_refs", F.when(F.col("id") % 2 == 0, F.create_map(F.lit("web"), old)).otherwise(empty))
    synced = editions.sync_refs(before, editions.page_map(placed, "print"), "print")
    ref = F.col("edition_refs")["print"]
    return synced.select("id", F.lit("print").alias("edition"), ref["page"].alias("page"), ref["label"].alias("label"), F.size("edition_refs").cast("long").alias("n_refs"))


@register(
    "page_passages",
    "SELECT 'print' AS edition, (1 + doc_id // 4)::BIGINT AS page, string_agg(doc_id::VARCHAR, ',' ORDER BY doc_id) AS ids, count(*)::BIGINT AS n FROM documents GROUP BY 2",
)
def page_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages that begin on each page of an edition."""
    placed = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), (F.floor(F.col("doc_id") / 4) + 1).alias("page"), F.lit(None).cast("string").alias("label"))
    return editions.on_page(editions.page_map(placed, "print"))


@register(
    "translation_findings",
    """
    WITH t AS (SELECT a.conv_id, a.turn, a.text AS src, b.text AS tgt, b.turn AS bt FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1 WHERE a.role = 'user' AND b.role = 'assistant'),
    f AS (SELECT 'length_ratio' AS code FROM t WHERE trim(tgt) <> '' AND CASE WHEN length(src) >= 80 THEN length(tgt) < 0.25 * length(src) OR length(tgt) > 4.0 * length(src) ELSE length(tgt) > 400 END
      UNION ALL SELECT 'sequence_drift' FROM t WHERE bt % 3 = 0 UNION ALL SELECT 'empty_text' FROM t WHERE trim(tgt) = '')
    SELECT code, count(*)::BIGINT AS n FROM f GROUP BY code
    """,
)
def translation_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers as translations of their question: coverage, drift of the sequence, odd lengths."""
    turns = table(spark, sf_dir, "conversations")
    key = lambda turn: F.concat_ws(".", F.col("conv_id"), turn)
    passages = turns.where("role = 'user'").select(key(F.col("turn")).alias("id"), "text", F.col("turn").alias("sequence"))
    answers = turns.where("role = 'assistant'").select(
        key(F.col("turn") - 1).alias("source_id"),
        F.concat(key(F.col("turn") - 1), F.lit(".en")).alias("id"),
        F.lit("en").alias("lang"),
        F.lit("draft").alias("status"),
        "text",
        F.when(F.col("turn") % 3 == 0, -1).otherwise(F.col("turn") - 1).alias("source_sequence"),
    )
    answers = answers.join(passages.select(F.col("id").alias("source_id")), "source_id", "left_semi")
    return editions.translation_findings(answers, passages).groupBy("code").agg(F.count("*").alias("n"))


def heading_blocks(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(titles, blocks) of all pages: the headings, and all blocks, headings among them altered by their page's id."""
    blocks = page_blocks(table(spark, sf_dir, "pages")).withColumnRenamed("page_id", "page")
    titles = blocks.where("tag = 'h1'").select("page", F.col("block_no").alias("toc_index"), F.col("text").alias("title"))
    k, text = F.col("page") % 5, F.col("text")
    altered = F.when(k == 1, F.concat(F.lit(". "), text)).when(k == 2, F.concat(text, F.lit(" 1.2"))).when(k == 3, F.concat(F.lit("On "), text)).when(k == 4, F.regexp_replace(text, "a", "o")).otherwise(text)
    return titles, blocks.select("page", "block_no", F.when(F.col("tag") == "h1", altered).otherwise(text).alias("text"))


@register("page_headings")
def page_headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles of pages matched with the blocks that resemble them, greedily and by page (no SQL: alignment ratio)."""
    titles, blocks = heading_blocks(spark, sf_dir)
    return fuzzy.assign_titles(fuzzy.scored_titles(titles, blocks, least=0.62))


@register("fuzzy_grounding")
def fuzzy_grounding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First sentences of answers, with a word changed, aligned with their turn (no SQL: alignment)."""
    turns = table(spark, sf_dir, "conversations")
    quote = F.regexp_replace(F.regexp_extract("text", "^[^.]*", 0), "^([^ ]+) [^ ]+", "$1 changed")
    return fuzzy.align(turns.select("conv_id", "turn", "text", quote.alias("quote"))).drop("text", "quote")
