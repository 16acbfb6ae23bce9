"""Queries of the training-data operators, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from quirework.llm.class_lm import class_scores
from quirework.llm.decontamination import containment_pairs
from quirework.llm.fill_middle import fill_in_middle, restored
from quirework.llm.kneser_ney import perplexity_filter
from quirework.llm.license_scan import license_scan
from quirework.llm.line_dedup import removed_lines
from quirework.llm.mixing import pareto_mix
from quirework.llm.pii import personal_spans, span_strings
from quirework.llm.quality_rules import quality_rules
from quirework.llm.toxicity import toxicity_scores
from quirework.llm.url_filters import link_verdicts
from quirework.llm.vertical_join import jaccard_components
from quirework.llm.wavelet_search import ranked_search
from quirework.session import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, mixed over their sources with weights 1, 2, 3 in turn and at most three copies each."""
    mixed = pareto_mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages: rules first, then trust and distrust of the host."""
    return link_verdicts(table(spark, sf_dir, "pages"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: the base counts, the base verdict and the n-gram model's verdict."""
    return quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the component that three-word shingles at a similarity of 0.9 put them in."""
    return jaccard_components(table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, scored by trees that learn from the labels of three folds in four."""
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, scored by a class bigram model of four folds in five."""
    return class_scores(table(spark, sf_dir, "documents"))


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (document, benchmark item) pair where the document holds 80% of the item's five-word shingles or more."""
    return containment_pairs(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their perplexity under the model of trusted text and their language's verdict."""
    return perplexity_filter(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the counts and spans of personal data, and of the terms that give it away."""
    found = personal_spans(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", span_strings(F.col("base"), F.col("terms")).alias("spans")
    )


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of all documents that an earlier line makes superfluous; ``exact`` if its token set was seen before."""
    return removed_lines(table(spark, sf_dir, "documents")).select("doc_id", "line_no", "exact")


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the places of the base phrases and the labels of all templates found."""
    found = license_scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, cut between lines and put out with the middle last: digests of output and of the restored text."""
    made = fill_in_middle(table(spark, sf_dir, "documents"))
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")).cast("binary"), 256).alias("restored_sha256"),
    )


#: Whole results in SQL.
_ORACLES = {
    "op12_ranked_search": r"""
        WITH docs AS (
            SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x{00}-\x{2F}\x{3A}-\x{40}\x{5B}-\x{60}\x{7B}-\x{7F}]+') AS terms
            FROM documents WHERE text IS NOT NULL),
        held AS (SELECT *, len(terms) AS n FROM docs WHERE len(terms) > 0),
        totals AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM held),
        asked AS (
            SELECT item_id, term, count(*) AS times FROM (
                SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[^\x{00}-\x{2F}\x{3A}-\x{40}\x{5B}-\x{60}\x{7B}-\x{7F}]+')) AS term FROM benchmark)
            GROUP BY item_id, term),
        posted AS (
            SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(terms) AS term FROM held)
            WHERE term IN (SELECT term FROM asked) GROUP BY row, term),
        weighed AS (
            SELECT term, floor(1000 * ln((2 * (SELECT docs FROM totals) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM posted GROUP BY term),
        scored AS (
            SELECT item_id, row, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * (SELECT docs FROM totals)) // (SELECT terms FROM totals)))))::BIGINT AS score
            FROM posted JOIN weighed USING (term) JOIN held USING (row) JOIN asked USING (term) GROUP BY item_id, row),
        ranked AS (
            SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank
            FROM scored JOIN held USING (row) WHERE score > 0)
        SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10""",
    "op13_fill_in_middle": r"""
        WITH cut AS (
            SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS units,
                sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS digest
            FROM documents),
        drawn AS (
            SELECT *, len(units)::BIGINT AS n, ('0x' || substr(digest, 1, 8))::BIGINT % (len(units) + 1) AS a, ('0x' || substr(digest, 9, 8))::BIGINT % (len(units) + 1) AS b,
                text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') AS plain,
                ('0x' || substr(digest, 25, 8))::BIGINT % 100 < 50 AS spm
            FROM cut),
        parted AS (
            SELECT *, array_to_string(units[:least(a, b)], '') AS prefix, array_to_string(units[least(a, b) + 1:greatest(a, b)], '') AS middle,
                array_to_string(units[greatest(a, b) + 1:], '') AS suffix
            FROM drawn)
        SELECT doc_id, n, CASE WHEN plain THEN 'plain' WHEN spm THEN 'spm' ELSE 'psm' END AS form,
            CASE WHEN NOT plain THEN length(prefix)::BIGINT END AS prefix_chars, CASE WHEN NOT plain THEN length(middle)::BIGINT END AS middle_chars,
            sha256(CASE WHEN plain THEN text WHEN spm THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle
                ELSE '<P>' || prefix || '<S>' || suffix || '<M>' || middle END) AS output_sha256,
            sha256(text) AS restored_sha256
        FROM parted""",
}

_OPERATORS = (
    op1_pareto_mix,
    op2_url_filters,
    op3_quality_rules,
    op4_ngram_jaccard_join,
    op5_toxicity,
    op6_class_lm,
    op7_benchmark_decontamination,
    op8_quality_classifier,
    op9_pii,
    op10_line_dedup,
    op11_license_scan,
    op12_ranked_search,
    op13_fill_in_middle,
)


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in _OPERATORS} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLES)
