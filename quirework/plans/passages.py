"""Queries on passages: profiles, cleaning, quality rules, duplicates and sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirework.functions import text as T
from quirework.operators import cleaning, matching, quality, sequence
from quirework.plans.registry import register
from quirework.session import table
from quirework.sources.readers import text_lines


@register(
    "passage_length_stats",
    """
    SELECT lang, count(*)::BIGINT AS n_passages, min(length(text))::BIGINT AS len_min,
      quantile_disc(length(text), 0.5)::BIGINT AS len_p50, quantile_disc(length(text), 0.9)::BIGINT AS len_p90,
      quantile_disc(length(text), 0.95)::BIGINT AS len_p95, max(length(text))::BIGINT AS len_max,
      sum(length(text))::BIGINT AS len_sum,
      count(*) FILTER (WHERE length(text) < 12)::BIGINT AS n_short,
      count(*) FILTER (WHERE length(text) > 3000)::BIGINT AS n_long
    FROM documents GROUP BY lang
    """,
)
def passage_length_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length profile per language: count, extremes, nearest-rank percentiles, short and long passages."""
    n = F.length("text")
    return (
        table(spark, sf_dir, "documents")
        .groupBy("lang")
        .agg(
            F.count("*").alias("n_passages"),
            F.min(n).cast("long").alias("len_min"),
            *(
                F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY length(text))").cast("long").alias(f"len_p{k}")
                for k, p in ((50, 0.5), (90, 0.9), (95, 0.95))
            ),
            F.max(n).cast("long").alias("len_max"),
            F.sum(n).cast("long").alias("len_sum"),
            F.count_if(n < 12).alias("n_short"),
            F.count_if(n > 3000).alias("n_long"),
        )
    )


_FLAT = "trim(regexp_replace(text, '[\\t\\n\\x0B\\f\\r \\x{1C}-\\x{1F}\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]+', ' ', 'g'))"


@register(
    "short_long_passages",
    f"""
    SELECT doc_id, length(text)::BIGINT AS n,
      CASE WHEN length({_FLAT}) <= 180 THEN {_FLAT} ELSE concat(rtrim(substring({_FLAT}, 1, 179)), '…') END AS excerpt
    FROM documents WHERE length(text) < 12 OR length(text) > 3000
    """,
)
def short_long_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of unusual length, with an excerpt."""
    n = F.length("text")
    docs = table(spark, sf_dir, "documents").where((n < 12) | (n > 3000))
    return docs.select("doc_id", n.cast("long").alias("n"), T.truncate(F.col("text"), 180).alias("excerpt"))


@register(
    "clean_star_runs",
    """
    WITH t AS (SELECT page_id, html, len(regexp_extract_all(html, '\\*+')) AS runs FROM pages),
    c AS (SELECT *, regexp_replace(regexp_replace(regexp_replace(html, '[\\s\\x{A0}]*\\*+[\\s\\x{A0}]*', '، ', 'g'),
      '(?:، *){2,}', '، ', 'g'), '[\\s\\x{A0}]+،', '،', 'g') AS tidy FROM t)
    SELECT page_id, runs::BIGINT AS runs, sha1(CASE WHEN runs > 0 THEN regexp_replace(regexp_replace(tidy, '^[\\s\\x{A0}]+', ''), '[\\s\\x{A0}]+$', '') ELSE html END) AS digest FROM c
    """,
)
def clean_star_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of stars become commas: number of runs and digest of the cleaned markup."""
    clean, runs = T.replace_stars(F.col("html"))
    return table(spark, sf_dir, "pages").select("page_id", runs.cast("long").alias("runs"), F.sha1(clean).alias("digest"))


@register(
    "text_normalize_keys",
    """
    SELECT doc_id, sha1(regexp_replace(regexp_replace(translate(translate(
      regexp_replace(regexp_replace(text, '[\\x{200E}\\x{200F}\\x{202A}-\\x{202E}\\x{2066}-\\x{2069}\\x{FEFF}]', '', 'g'), '᧦', '', 'g'), chr(160), ' '),
      '٠١٢٣٤٥٦٧٨٩', '0123456789'), '[\\x{0610}-\\x{061A}\\x{064B}-\\x{065F}\\x{0670}\\x{06D6}-\\x{06ED}]', '', 'g'),
      '[^\\p{L}\\p{N}_]', '', 'g')) AS key_digest
    FROM documents
    """,
)
def text_normalize_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest of each text's comparison key."""
    return table(spark, sf_dir, "documents").select("doc_id", F.sha1(T.match_key(F.col("text"))).alias("key_digest"))


_PATTERNS = {"stars": "\\*+", "hashes": "#+", "braces": "[{}]", "digits": "[0-9]+", "capitals": "[A-Z]{2,}", "doubled_stops": "[.!?]{2,}"}


@register(
    "artifact_scan",
    "SELECT lang, pattern, hits::BIGINT AS hits FROM ("
    + " UNION ALL ".join(
        f"SELECT lang, '{n}' AS pattern, sum(len(regexp_extract_all(text, '{p}'))) AS hits FROM documents GROUP BY lang" for n, p in _PATTERNS.items()
    )
    + ") WHERE hits > 0",
)
def artifact_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Occurrences of artifact patterns per language, from one scan."""
    return quality.artifact_counts(table(spark, sf_dir, "documents"), "text", _PATTERNS, "lang")


def _cleaning_oracle() -> str:
    """The cleaning as a chain of subqueries, one for each step."""
    q = lambda x: x.replace("'", "''")
    old = [(n, p, new) for n, p, new in [*cleaning.FIRST_STEPS, ("stars_replaced", None, None), *cleaning.STEPS]]
    sql = f"""s0 AS (SELECT doc_id, n, CASE WHEN m <> '' THEN regexp_extract(line, '^(#{{1,6}}){T.SPACE}+(.+?){T.SPACE}*$', 2) ELSE line END AS t0 FROM
      (SELECT *, regexp_extract(line, '^(#{{1,6}}){T.SPACE}+(.+?){T.SPACE}*$', 1) AS m FROM l)),
    b0 AS (SELECT doc_id, n, regexp_matches(t0, '{T.BIDI}')::BIGINT AS c0, regexp_replace(t0, '{T.BIDI}', '', 'g') AS t FROM s0)"""
    last, columns = "b0", [("bidi_controls_removed", "c0")]
    for k, (name, pattern, new) in enumerate(old, 1):
        if pattern is None:
            tidy = f"regexp_replace(regexp_replace(regexp_replace(t, '{T.SPACE}*\\*+{T.SPACE}*', '، ', 'g'), '(?:،{T.SPACE}*){{2,}}', '، ', 'g'), '{T.SPACE}+،', '،', 'g')"
            strip = f"regexp_replace(regexp_replace({tidy}, '^{T.SPACE}+', ''), '{T.SPACE}+$', '')"
            count, text = "len(regexp_extract_all(t, '\\*+'))", f"CASE WHEN NOT contains(t, '*') THEN t WHEN regexp_matches(t, '^{T.SPACE}*\\*+{T.SPACE}*$') THEN '' ELSE {strip} END"
        else:
            p = q(pattern.replace("\\s", T.SPACE))
            count, text = f"len(regexp_extract_all(t, '{p}'))", f"regexp_replace(t, '{p}', '{new.replace('$', chr(92))}', 'g')"
        sql += f",\n    b{k} AS (SELECT * EXCLUDE (t), {count} AS c{k}, {text} AS t FROM {last})"
        last = f"b{k}"
        columns.append((name, f"c{k}"))
    sql += f",\n    d AS (SELECT *, regexp_matches(t, '{T.RUNTIME_ERROR}') AS dropped FROM {last})"
    names = list(dict.fromkeys(n for n, _ in columns))
    parts = [f"SELECT '{n}' AS counter, sum({' + '.join(c for m, c in columns if m == n)})::BIGINT AS n FROM d" for n in names]
    parts += ["SELECT 'drop_runtime_error_lines', count(*) FILTER (WHERE dropped)::BIGINT FROM d", "SELECT 'lines', count(*)::BIGINT FROM d"]
    always = ", ".join(f"'{n}'" for n in ["lines", *cleaning.ALWAYS])
    return f"""
    WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS n FROM documents),
    {sql}
    SELECT * FROM ({' UNION ALL '.join(parts)}) WHERE n > 0 OR counter IN ({always})"""


@register("cleaning_report", _cleaning_oracle())
def cleaning_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters of the line cleaning, summed over all lines; visited counters stay at 0."""
    return cleaning.change_report(cleaning.clean_lines(text_lines(table(spark, sf_dir, "documents"))))


@register(
    "suspicious_lines",
    "WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS line_no FROM documents) SELECT doc_id, line_no::BIGINT AS line_no, pattern, digest FROM ("
    + " UNION ALL ".join(
        f"SELECT doc_id, line_no, '{n}' AS pattern, sha1(substring(line, 1, 220)) AS digest FROM l WHERE regexp_matches(line, '{p.replace('[' + chr(92) + 's', '[' + T.SPACE[1:-1])}')" for n, p in cleaning.SUSPICIOUS
    )
    + ")",
)
def suspicious_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every suspicious pattern of every line; a report would stop at 250 rows a work."""
    found = cleaning.suspicious(text_lines(table(spark, sf_dir, "documents")), "doc_id", "line_no", "line", limit=None)
    return found.select("doc_id", "line_no", "pattern", F.sha1("text").alias("digest"))


@register("duplicate_texts", "SELECT sha1(text) AS digest, count(*)::BIGINT AS n, min(doc_id)::BIGINT AS first_id FROM documents GROUP BY text HAVING count(*) > 1")
def duplicate_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts that stand in several rows; digests are shuffled, not texts."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.sha1("text").alias("digest"))
    return docs.groupBy("digest").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_id")).where("n > 1")


@register(
    "adjacent_duplicate_lines",
    """
    WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS line_no FROM documents),
    w AS (SELECT *, lag(line) OVER (PARTITION BY doc_id ORDER BY line_no) AS p FROM l)
    SELECT doc_id, line_no::BIGINT AS line_no, sha1(line) AS digest FROM w WHERE line = p
    """,
)
def adjacent_duplicate_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines equal to the line before them."""
    lines = text_lines(table(spark, sf_dir, "documents"))
    return sequence.adjacent_duplicates(lines, "doc_id", "line_no", "line").select("doc_id", "line_no", F.sha1("line").alias("digest"))


@register(
    "sequence_gaps",
    """
    WITH s AS (SELECT DISTINCT doc_id AS v FROM labels UNION SELECT -1), w AS (SELECT v, lead(v) OVER (ORDER BY v) AS nx FROM s)
    SELECT (v + 1)::BIGINT AS first_missing, (nx - 1)::BIGINT AS last_missing FROM w WHERE nx > v + 1
    """,
)
def sequence_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of document numbers without a label."""
    return sequence.sequence_gaps(table(spark, sf_dir, "labels"), "doc_id", low=0)


@register(
    "quality_findings",
    """
    SELECT code, severity, count(*)::BIGINT AS n, min(doc_id)::BIGINT AS first_id FROM (
      SELECT doc_id, 'short_passage' AS code, 'info' AS severity FROM documents WHERE length(text) < 12
      UNION ALL SELECT doc_id, 'long_passage', 'info' FROM documents WHERE length(text) > 3000
      UNION ALL SELECT doc_id, 'star_leftover', 'warn' FROM documents WHERE contains(text, '*')
      UNION ALL SELECT doc_id, 'brace_marker', 'warn' FROM documents WHERE regexp_matches(text, '[{}]')
      UNION ALL SELECT doc_id, 'missing_text', 'fail' FROM documents WHERE text IS NULL OR regexp_matches(text, '^\\s*$')
      UNION ALL SELECT doc_id, 'numeric_only', 'warn' FROM documents WHERE regexp_matches(replace(text, ' ', ''), '^[0-9.()،؛:؟!\\-ـ]+$')
      UNION ALL SELECT doc_id, 'missing_lang', 'warn' FROM documents WHERE coalesce(trim(lang), '') = ''
      UNION ALL SELECT doc_id, 'missing_source', 'warn' FROM documents WHERE coalesce(trim(source), '') = ''
    ) GROUP BY code, severity
    """,
)
def quality_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings of all passage rules, counted by code."""
    found = quality.findings(table(spark, sf_dir, "documents"), "doc_id", quality.passage_rules())
    return found.groupBy("code", "severity").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_id"))


@register(
    "quality_status",
    """
    WITH f AS (
      SELECT lang, 'info' AS s FROM documents WHERE length(text) < 12 UNION ALL SELECT lang, 'info' FROM documents WHERE length(text) > 3000
      UNION ALL SELECT lang, 'warn' FROM documents WHERE contains(text, '*') UNION ALL SELECT lang, 'warn' FROM documents WHERE regexp_matches(text, '[{}]')
      UNION ALL SELECT lang, 'warn' FROM documents WHERE regexp_matches(replace(text, ' ', ''), '^[0-9.()،؛:؟!\\-ـ]+$'))
    SELECT lang, count(*) FILTER (WHERE s = 'info')::BIGINT AS n_info, count(*) FILTER (WHERE s = 'warn')::BIGINT AS n_warn, 0::BIGINT AS n_fail,
      CASE WHEN count(*) FILTER (WHERE s = 'warn') > 0 THEN 'warn' ELSE 'ok' END AS status FROM f GROUP BY lang
    """,
)
def quality_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings per language rolled up to one status."""
    rules = [r for r in quality.passage_rules() if r.code in {"short_passage", "long_passage", "star_leftover", "brace_marker", "numeric_only"}]
    docs = table(spark, sf_dir, "documents")
    found = quality.findings(docs.withColumn("k", F.struct("doc_id", "lang")), "k", rules).select("k.lang", "severity")
    return quality.status(found, "lang")


@register(
    "problem_sources",
    """
    WITH r AS (SELECT source, 'long' AS reason FROM documents WHERE length(text) > 3000 UNION ALL SELECT source, 'short' FROM documents WHERE length(text) < 12
      UNION ALL SELECT source, 'star' FROM documents WHERE contains(text, '*')),
    n AS (SELECT source, reason, count(*) AS n FROM r GROUP BY ALL)
    SELECT source, sum(n)::BIGINT AS score, string_agg(reason || '=' || n, ', ' ORDER BY reason || '=' || n) AS reasons FROM n GROUP BY source
    """,
)
def problem_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of each source: all of its problems, uncapped."""
    n = F.length("text")
    reasons = F.array_compact(F.array(F.when(n > 3000, "long"), F.when(n < 12, "short"), F.when(F.contains("text", F.lit("*")), "star")))
    return quality.problem_scores(table(spark, sf_dir, "documents").select("source", F.explode(reasons).alias("reason")), "source")


@register(
    "spread_sample",
    """
    WITH b AS (SELECT min(doc_id) AS lo, max(doc_id) AS hi FROM documents),
    c AS (SELECT doc_id, lang, floor((doc_id - lo) * 25 / (hi - lo + 1)) AS cell FROM documents, b)
    SELECT min(doc_id)::BIGINT AS doc_id, arg_min(lang, doc_id) AS lang FROM c GROUP BY cell
    """,
)
def spread_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """25 documents, evenly spread over the ids (a sampling operator)."""
    return sequence.spread_sample(table(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id", 25)


@register(
    "first_per_category",
    """
    WITH c AS (SELECT doc_id, 'long' AS category FROM documents WHERE length(text) > 3000 UNION ALL SELECT doc_id, 'short' FROM documents WHERE length(text) < 12
      UNION ALL SELECT doc_id, 'many_lines' FROM documents WHERE len(string_split(text, chr(10))) > 20 UNION ALL SELECT doc_id, 'question' FROM documents WHERE contains(text, '?'))
    SELECT category, min(doc_id)::BIGINT AS doc_id, count(*)::BIGINT AS n FROM c GROUP BY category
    """,
)
def first_per_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several review categories per passage; the first passage of each."""
    text, n = F.col("text"), F.length("text")
    flags = F.array_compact(
        F.array(F.when(n > 3000, "long"), F.when(n < 12, "short"), F.when(F.size(F.split(text, "\n")) > 20, "many_lines"), F.when(F.contains(text, F.lit("?")), "question"))
    )
    rows = table(spark, sf_dir, "documents").select("doc_id", F.explode(flags).alias("category"))
    return rows.groupBy("category").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n"))


@register(
    "overlay_changed",
    f"""
    SELECT lang, count(*)::BIGINT AS n, count(*) FILTER (WHERE {_FLAT} <> text)::BIGINT AS changed FROM documents GROUP BY lang
    """,
)
def overlay_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages whose cleaned text differs from the first one, per language."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    cleaned = docs.select("doc_id", T.normalize_space(F.col("text")).alias("text"))
    joined = matching.overlay(docs, cleaned, "doc_id", "text")
    return joined.groupBy("lang").agg(F.count("*").alias("n"), F.count_if("changed").alias("changed"))
