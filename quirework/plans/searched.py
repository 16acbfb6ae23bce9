"""Queries on an inverted index, on tokens of any script, on alignments of items with documents, and on layout."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirework.functions.tokens import Phrases, phrase_counts, tokens_at
from quirework.operators import align, layout, quality
from quirework.operators.search_index import SearchIndex, write_index
from quirework.plans.annotated import heading_blocks
from quirework.plans.passages import _FLAT, _PATTERNS
from quirework.plans.registry import register
from quirework.session import shared_path, table
from quirework.sources.readers import exists, text_lines

#: Tokens of scripts that part words, as DuckDB writes them.
_WORD = "(?:[\\p{L}\\p{N}_]\\p{M}*)+"
_OUTSIDE = "[^\\p{L}\\p{N}_\\p{M}]"


#: Indexes written by this application, by application and input: an index is written once and searched often.
_WRITTEN: dict[tuple[str, str], SearchIndex] = {}


def indexed(spark: SparkSession, sf_dir: str) -> SearchIndex:
    """The index of all documents, as passages with a kind, a path and a citation; written by whoever asks first."""
    known = _WRITTEN.get((spark.sparkContext.applicationId, sf_dir))
    if known is not None and exists(spark, f"{known.path}/rows"):
        return known
    rows = table(spark, sf_dir, "documents").select(
        "doc_id",
        "text",
        "lang",
        F.col("source").alias("kind"),
        F.concat_ws(" > ", "lang", "source").alias("path"),
        F.concat(F.lit("p. "), (F.floor(F.col("doc_id") / 4) + 1).cast("string")).alias("citation"),
    )
    made = write_index(rows, shared_path(spark, "search-index"), "doc_id", "text")
    _WRITTEN[spark.sparkContext.applicationId, sf_dir] = made
    return made


def _search_oracle(terms: list[str], where: str, limit: int) -> str:
    counts = [f"len(list_filter(w, lambda x: x = '{t}'))" for t in terms]
    return f"""
    WITH d AS (SELECT *, lower(text) AS t, regexp_extract_all(lower(text), '{_WORD}') AS w FROM documents WHERE text IS NOT NULL AND {where}),
    m AS (SELECT *, {' + '.join(counts)} AS score, length(regexp_extract(t, '(?s)^(|.*?{_OUTSIDE})(?:{'|'.join(terms)})(?:{_OUTSIDE}|$)', 1)) AS first
      FROM d WHERE {' AND '.join(f'{c} > 0' for c in counts)})
    SELECT doc_id, lang, source AS kind, concat_ws(' > ', lang, source) AS path, 'p. ' || (doc_id // 4 + 1) AS citation, score::BIGINT AS score,
      substring(text, greatest(first - 39, 1), 80) AS snippet FROM m ORDER BY score DESC, doc_id LIMIT {limit}
    """


@register("search_index", _search_oracle(["the", "and"], "true", 20))
def search_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty texts that hold two words most often, by their postings, with kind, path and citation."""
    return indexed(spark, sf_dir).search("The AND")


@register("search_index_filtered", _search_oracle(["de"], "lang = 'es'", 50))
def search_index_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The texts of one language that hold a word most often."""
    return indexed(spark, sf_dir).search("de", limit=50, lang="es")


@register(
    "index_terms",
    f"""
    SELECT term, count(*)::BIGINT AS rows, sum(n)::BIGINT AS occurrences FROM (
      SELECT doc_id, term, count(*) AS n FROM (SELECT doc_id, lower(unnest(regexp_extract_all(text, '{_WORD}'))) AS term FROM documents) GROUP BY ALL) GROUP BY term
    """,
)
def index_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every term of the index with its texts and occurrences."""
    return indexed(spark, sf_dir).terms()


_KANA = ("aeiou", "あえいおう")


@register(
    "unspaced_tokens",
    f"""
    WITH d AS (SELECT doc_id, translate(text, '{_KANA[0]}', '{_KANA[1]}') AS t FROM documents WHERE text IS NOT NULL AND text <> ''),
    p AS (SELECT doc_id, regexp_extract_all(t, '(?s)[\\x{{3041}}-\\x{{309F}}]\\p{{M}}*|(?:(?:[^\\P{{L}}\\x{{3041}}-\\x{{309F}}]|[\\p{{N}}_])\\p{{M}}*)+|.') AS p FROM d),
    e AS (SELECT doc_id, unnest(p) AS x, generate_subscripts(p, 1) AS i FROM p),
    o AS (SELECT *, sum(length(x)) OVER (PARTITION BY doc_id ORDER BY i) AS till FROM e),
    k AS (SELECT * FROM o WHERE regexp_matches(x, '^[\\p{{L}}\\p{{N}}_]'))
    SELECT doc_id, count(*)::BIGINT AS n, sha1(string_agg((till - length(x))::BIGINT || ':' || till::BIGINT || ':' || x, ' ' ORDER BY i)) AS digest FROM k GROUP BY doc_id
    """,
)
def unspaced_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens with their places where vowels are kana: each kana is a token, runs of other letters are."""
    worded = table(spark, sf_dir, "documents").where(F.col("text").rlike("[\\p{L}\\p{N}_]"))  # a filter on tokens would make them twice
    docs = worded.select("doc_id", tokens_at(F.translate("text", *_KANA)).alias("t"))
    said = F.transform("t", lambda x: F.concat_ws(":", x["start"].cast("string"), x["end"].cast("string"), x["text"]))
    return docs.select("doc_id", F.size("t").cast("long").alias("n"), F.sha1(F.array_join(said, " ")).alias("digest"))


@register("aligned_items")
def aligned_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All benchmark items, every third with a word changed and every third with words added, aligned with all documents
    (no SQL: chains of anchors)."""
    k = F.col("item_id") % 3
    changed = F.regexp_replace("text", "^(\\S+\\s+\\S+\\s+\\S+\\s+)\\S+", "$1altered")
    text = F.when(k == 1, changed).when(k == 2, F.concat(F.col("text"), F.lit(" and words that the source does not have at all"))).otherwise(F.col("text"))
    return align.align_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark").select("item_id", text.alias("text")))


_HITS = " UNION ALL ".join(f"SELECT source, doc_id, n, line, {k} AS place, '{name}' AS pattern FROM l WHERE regexp_matches(line, '{p}')" for k, (name, p) in enumerate(_PATTERNS.items()))
_CUT = _FLAT.replace("(text,", "(line,")


@register(
    "artifact_samples",
    f"""
    WITH l AS (SELECT source, doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS n FROM documents),
    h AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id, n, place) AS r FROM ({_HITS}))
    SELECT source, (doc_id * 1048576 + n)::BIGINT AS line_no, pattern, CASE WHEN length({_CUT}) <= 180 THEN {_CUT} ELSE concat(rtrim(substring({_CUT}, 1, 179)), '…') END AS text FROM h WHERE r <= 25
    """,
)
def artifact_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 25 lines of each source that show an artifact."""
    docs = table(spark, sf_dir, "documents")
    lines = text_lines(docs.select(F.struct("source", "doc_id").alias("k"), "text"), "k")
    placed = lines.select("k.source", (F.col("k.doc_id") * (1 << 20) + F.col("line_no")).alias("line_no"), "line")
    return quality.artifact_samples(placed, "source", "line_no", "line", _PATTERNS)


_TERMS = ["The", "and", "in the", "de la", "QR", "of", "thion"]


@register(
    "phrase_table",
    " UNION ALL ".join(
        f"SELECT lang, '{t}' AS phrase, sum(len(regexp_extract_all(regexp_replace(lower(text), '([^\\p{{L}}\\p{{N}}_])', '\\1\\1', 'g'), '(?:^|[^\\p{{L}}\\p{{N}}_]){t.lower().replace(' ', '  ')}(?:[^\\p{{L}}\\p{{N}}_]|$)')))::BIGINT AS hits FROM documents GROUP BY lang HAVING hits > 0"
        for t in _TERMS
    ),
)
def phrase_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Occurrences of the phrases of a table, as whole words, from one reading of each text."""
    return phrase_counts(table(spark, sf_dir, "documents"), "text", Phrases(_TERMS), "lang")


_PLANTED = "regexp_replace(regexp_replace(text, '\\\\bthe\\\\b', 'QR'), '\\\\band\\\\b', 'role')"


@register(
    "layout_findings",
    """
    WITH d AS (SELECT coalesce(source, 'none') AS work_id, doc_id, CASE WHEN doc_id % 17 = 3 THEN ' . ' || chr(10) WHEN text IS NOT NULL THEN regexp_replace(regexp_replace(text, '\\bthe\\b', 'QR', 'g'), '\\band\\b', 'role', 'g') END AS t FROM documents),
    l AS (SELECT work_id, unnest(string_split_regex(t, '\\r?\\n')) AS line FROM d),
    f AS (SELECT work_id, 'latin_letters_visible' AS code, 'warn' AS severity FROM l WHERE regexp_matches(line, '[A-Za-z]')
      UNION ALL SELECT work_id, 'technical_terms_visible', 'warn' FROM l WHERE regexp_matches(line, '(^|[^\\p{L}\\p{N}_])(QR|role)([^\\p{L}\\p{N}_]|$)')
      UNION ALL SELECT work_id, 'code_too_wide', 'warn' FROM d WHERE doc_id % 60 > 30
      UNION ALL SELECT work_id, 'blank_page', 'info' FROM d WHERE length(regexp_replace(coalesce(t, ''), '^\\s+|\\s+$', '', 'g')) < 8)
    SELECT work_id, code, severity, count(*)::BIGINT AS n FROM f GROUP BY ALL
    """,
)
def layout_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as pages of editions, with planted terms and blank pages, and the sources that set their codes."""
    docs = table(spark, sf_dir, "documents")
    text = F.when(F.col("doc_id") % 17 == 3, " . \n").otherwise(F.expr(_PLANTED))
    work = F.coalesce("source", F.lit("none")).alias("work_id")
    code = F.concat(F.lit('#qrcode("https://a.org",\n  width: '), (F.col("doc_id") % 60).cast("string"), F.lit("mm)"))
    return layout.layout_findings(docs.select(work, F.col("doc_id").alias("page"), text.alias("text")), docs.select(work, code.alias("text")))


@register(
    "section_index_lines",
    """
    WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS n FROM documents),
    b AS (SELECT doc_id, n, CASE WHEN (doc_id + n) % 3 = 0 THEN line || ' ' || n || '.1' ELSE line END AS t FROM l),
    t AS (SELECT doc_id, regexp_replace(substring(line, 1, 15), '[^\\p{L}\\p{N}_]', '', 'g') AS k FROM l WHERE n % 4 = 1)
    SELECT DISTINCT b.doc_id AS page, b.n::BIGINT AS block_no FROM b JOIN t USING (doc_id)
    WHERE regexp_matches(b.t, '\\s+[0-9٠-٩]+(?:\\.[0-9٠-٩]+)+\\s*$') AND k <> '' AND contains(regexp_replace(b.t, '[^\\p{L}\\p{N}_]', '', 'g'), k)
    """,
)
def section_index_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as blocks of their document's page, some of them ending like an index's; titles begin every fourth line."""
    lines = text_lines(table(spark, sf_dir, "documents")).withColumnsRenamed({"doc_id": "page", "line_no": "block_no"})
    ended = F.when((F.col("page") + F.col("block_no")) % 3 == 0, F.concat(F.col("line"), F.lit(" "), F.col("block_no").cast("string"), F.lit(".1"))).otherwise(F.col("line"))
    titles = lines.where("block_no % 4 = 1").select("page", F.substring("line", 1, 15).alias("title"))
    return layout.section_index_lines(lines.select("page", "block_no", ended.alias("text")), titles).select("page", "block_no")


@register("page_index_lines")
def page_index_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks of all pages that are lines of an index of their page's headings (no SQL: blocks of markup)."""
    titles, blocks = heading_blocks(spark, sf_dir)
    return layout.section_index_lines(blocks, titles.select("page", "title")).select("page", "block_no")
