"""Declarative quality rules: each is a predicate with a code and a severity; all of them read the table in one pass."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirework.functions import text as T
from quirework.operators.sequence import first_k

SEVERITIES = ("info", "warn", "fail")


@dataclass(frozen=True)
class Rule:
    """A row breaks the rule when ``broken`` holds; null counts as not broken."""

    code: str | Column
    severity: str
    broken: Column
    sample: Column | None = None


def is_blank(col: Column) -> Column:
    """Null, or nothing but blanks."""
    return col.isNull() | (T.strip(col.cast("string")) == "")


def findings(rows: DataFrame, key: str | list[str], rules: list[Rule]) -> DataFrame:
    """(key, code, severity, sample): one row for each broken rule of a row, from one scan without a shuffle."""
    keys = [key] if isinstance(key, str) else key
    none = F.lit(None).cast("string")
    code = lambda r: F.lit(r.code) if isinstance(r.code, str) else r.code
    hits = F.array(
        *(
            F.when(
                r.broken,
                F.struct(code(r).alias("code"), F.lit(r.severity).alias("severity"), (none if r.sample is None else r.sample).alias("sample")),
            )
            for r in rules
        )
    )
    return rows.select(*keys, F.explode(F.array_compact(hits)).alias("f")).select(*keys, "f.*")


def rank(severity: Column) -> Column:
    return F.when(severity == "fail", 3).when(severity == "warn", 2).when(severity == "info", 1).otherwise(0)


def status(found: DataFrame, *keys: str) -> DataFrame:
    """Per key: number of findings by severity, and ``fail``, ``warn`` or ``ok``."""
    worst = F.max(rank(F.col("severity")))
    counts = (F.count_if(F.col("severity") == s).alias(f"n_{s}") for s in SEVERITIES)
    return found.groupBy(*keys).agg(*counts, F.when(worst == 3, "fail").when(worst == 2, "warn").otherwise("ok").alias("status"))


def summary(found: DataFrame, *keys: str) -> DataFrame:
    """``code=count`` pairs in code order, joined by commas."""
    n = found.groupBy(*keys, "code").agg(F.count("*").alias("n"))
    pair = F.concat(F.col("code"), F.lit("="), F.col("n"))
    return n.groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_list(pair)), ", ").alias("summary"))


def artifact_counts(rows: DataFrame, text: str, patterns: dict[str, str], *keys: str) -> DataFrame:
    """(keys, pattern, hits): occurrences of each pattern; patterns without any are left out."""
    sums = [F.sum(T.count_pattern(F.col(text), p)).alias(name) for name, p in patterns.items()]
    wide = rows.groupBy(*keys).agg(*sums)
    return wide.unpivot(list(keys), list(patterns), "pattern", "hits").where("hits > 0")


def artifact_samples(lines: DataFrame, work: str, line_no: str, line: str, patterns: dict[str, str], limit: int = 25) -> DataFrame:
    """(work, line_no, pattern, text): the first ``limit`` hits of each work, by line and then by the patterns' order.

    A line counts once for each pattern it shows; no task holds more of a work than the limit asks for.
    """
    hits = F.array_compact(F.array(*(F.when(F.col(line).rlike(p), F.struct(F.lit(k).alias("at"), F.lit(name).alias("pattern"))) for k, (name, p) in enumerate(patterns.items()))))
    found = lines.select(work, line_no, F.explode(hits).alias("h"), F.col(line).alias("text")).select(work, line_no, "h.at", "h.pattern", "text")
    first = first_k(found, [work], [line_no, "at"], limit)
    return first.select(work, line_no, "pattern", T.truncate(F.col("text"), 180).alias("text"))


def length_profile(rows: DataFrame, text: str, *keys: str) -> DataFrame:
    """Count, extremes, mean and nearest-rank percentiles of text lengths."""
    n = F.length(text)
    ranks = (F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY length({text}))").cast("long").alias(f"len_p{k}") for k, p in ((50, 0.5), (90, 0.9), (95, 0.95)))
    return rows.groupBy(*keys).agg(
        F.count("*").alias("n"), F.min(n).cast("long").alias("len_min"), F.max(n).cast("long").alias("len_max"), F.avg(n).alias("len_avg"), *ranks
    )


def passage_rules(short: int = 12, long: int = 3000) -> list[Rule]:
    """Rules for passages: doc_id, text, lang, source."""
    text = F.col("text")
    return [
        Rule("missing_text", "fail", is_blank(text)),
        Rule("missing_lang", "warn", is_blank(F.col("lang"))),
        Rule("missing_source", "warn", is_blank(F.col("source"))),
        Rule("numeric_only", "warn", T.is_noise(text), T.truncate(text, 60)),
        Rule("short_passage", "info", F.length(text) < short, T.truncate(text, 60)),
        Rule("long_passage", "info", F.length(text) > long, T.truncate(text, 60)),
        Rule("star_leftover", "warn", F.contains(text, F.lit("*")), T.truncate(text, 60)),
        Rule("brace_marker", "warn", text.rlike("[{}]"), T.truncate(text, 60)),
        Rule("bidi_control", "warn", text.rlike(T.BIDI)),
        Rule("runtime_error", "warn", text.rlike(T.RUNTIME_ERROR)),
    ]


def outline_rules(counts: DataFrame) -> DataFrame:
    """Findings on outlines (work, h1, h2, h3): flat ones, and very detailed ones."""
    return findings(
        counts,
        "work",
        [
            Rule("flat_outline", "info", (F.col("h1") > 40) & (F.col("h2") < 5)),
            Rule("detailed_outline", "info", (F.col("h2") > 1000) & (F.col("h3") > 1000)),
        ],
    )


def problem_scores(reasons: DataFrame, key: str, reason: str = "reason") -> DataFrame:
    """(key, score, reasons): how many problems a page or source has, and their numbers by reason."""
    n = reasons.groupBy(key, reason).agg(F.count("*").alias("n"))
    pair = F.concat(F.col(reason), F.lit("="), F.col("n"))
    return n.groupBy(key).agg(F.sum("n").alias("score"), F.array_join(F.array_sort(F.collect_list(pair)), ", ").alias("reasons"))


def frozen_fields(before: DataFrame, after: DataFrame, key: str, free: list[str]) -> DataFrame:
    """(key, field) of changes to fields that may not change, for documents in both tables."""
    from quirework.operators.matching import field_drift

    held = [c for c in before.columns if c != key and c not in free]
    return field_drift(before, after, key, held).select(key, "field")


def key_check(keys: Column, allowed: list[str], required: list[str]) -> Column:
    """struct(unknown, missing): keys of a document that are not allowed, and required ones it lacks."""
    return F.struct(
        F.array_sort(F.array_except(keys, F.array(*map(F.lit, allowed)))).alias("unknown"),
        F.array_sort(F.array_except(F.array(*map(F.lit, required)), keys)).alias("missing"),
    )
