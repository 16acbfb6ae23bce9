"""Lexical search over an inverted index: texts are read once, to write it; a search reads its terms' postings alone.

The index is a folder with two tables. ``postings`` (bucket, hash, term, key, n, first) is partitioned by the term's hash
and sorted by it within its files, so a search opens the partitions of its terms and, by the footers' ranges, the row
groups that hold them. A text's tokens are counted where it is read, and each bucket is dealt out by a hash of the
key: a term that stands in every text fills as many files as its bucket has parts. ``rows`` holds what a hit shows (text, kind, path, citation and any other columns), sorted by key.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quirework.functions.tokens import token_counts


#: Parts of a bucket, by hash of the key: what the postings of one term may spread over.
_PARTS = 32


def terms_of(text: Column) -> Column:
    """The distinct lower-cased tokens of a text, in order."""
    return F.transform(token_counts(text), lambda t: t["text"])


def term_bucket(term: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


@dataclass(frozen=True)
class SearchIndex:
    """An index that ``write_index`` wrote at ``path``."""

    spark: SparkSession
    path: str
    key: str
    text: str
    buckets: int
    key_type: str

    def postings(self, terms: list[str] | None = None) -> DataFrame:
        """All postings, or those of some terms: by partition, then by the terms' ranges in the files."""
        found = self.spark.read.schema(f"hash long, term string, key {self.key_type}, n long, first int, bucket int").parquet(f"{self.path}/postings")
        if terms is None:
            return found.drop("hash")
        wanted = self.spark.range(1).select(F.explode(F.array(*(F.struct(F.xxhash64(F.lit(t)).alias("h"), term_bucket(F.lit(t), self.buckets).alias("b")) for t in terms))).alias("x"))
        hashes, buckets = (sorted({r[c] for r in wanted.select("x.*").collect()}) for c in ("h", "b"))
        return found.where(F.col("bucket").isin(*buckets) & F.col("hash").isin(*hashes) & F.col("term").isin(*terms)).drop("hash")

    def rows(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/rows")

    def terms(self) -> DataFrame:
        """(term, rows, occurrences) of every term."""
        return self.postings().groupBy("term").agg(F.count("*").alias("rows"), F.sum("n").alias("occurrences"))

    def search(self, query: str, limit: int = 20, cursor: tuple[int, object] | None = None, reach: int = 40, **equal: object) -> DataFrame:
        """Rows that hold all terms of ``query``, most occurrences first, then by key: their columns, ``score`` and ``snippet``.

        ``equal`` gives columns that a hit must have (language, kind, work). ``cursor`` is the (score, key) that the page
        before ended with. A page has 200 hits at most; only theirs are looked up for the snippet, which begins ``reach``
        characters before the first term.
        """
        terms = [r["t"] for r in self.spark.range(1).select(F.explode(terms_of(F.lit(query))).alias("t")).collect()]
        shown = self.rows()
        if not terms:
            return shown.limit(0).withColumns({"score": F.lit(0).cast("long"), "snippet": F.col(self.text)}).drop(self.text)
        held = self.postings(terms).groupBy("key").agg(F.count("*").alias("_terms"), F.sum("n").alias("score"), F.min("first").alias("_first"))
        found = held.where(F.col("_terms") == len(terms)).select(F.col("key").alias(self.key), "score", "_first")
        if equal:
            kept = shown
            for name, value in equal.items():
                kept = kept.where(F.col(name).isNull() if value is None else F.col(name) == value)
            found = found.join(kept.select(self.key), self.key, "left_semi")
        if cursor is not None:
            score, key = cursor
            found = found.where((F.col("score") < score) | ((F.col("score") == score) & (F.col(self.key) > key)))
        page = found.orderBy(F.desc("score"), self.key).limit(min(limit, 200)).collect()
        top = self.spark.createDataFrame(page, found.schema)
        wanted = shown.where(F.col(self.key).isin([r[self.key] for r in page])) if page else shown.limit(0)
        begin = F.greatest(F.col("_first") - reach + 1, F.lit(1))
        snippet = F.substring(F.col(self.text), begin, F.lit(2 * reach))
        return wanted.join(F.broadcast(top), self.key).withColumn("snippet", snippet).drop(self.text, "_first")


def write_index(rows: DataFrame, path: str, key: str, text: str, buckets: int = 64) -> SearchIndex:
    """Write the index of ``rows``; rows without terms are kept, but found by no search. Keys should be unique: the postings of
    rows that share one are summed, by a shuffle of their own."""
    spark = rows.sparkSession
    held = rows.where(F.col(key).isNotNull())
    token = held.select(F.col(key).alias("key"), F.explode(token_counts(F.col(text))).alias("t"))
    posted = token.select(F.xxhash64("t.text").alias("hash"), F.col("t.text").alias("term"), "key", F.col("t.n").cast("long").alias("n"), F.col("t.start").alias("first"))
    if not held.groupBy(key).count().where("count > 1").isEmpty():
        posted = posted.groupBy("hash", "term", "key").agg(F.sum("n").alias("n"), F.min("first").alias("first"))
    dealt = posted.withColumn("bucket", term_bucket(F.col("term"), buckets)).repartition("bucket", F.pmod(F.xxhash64("key"), F.lit(_PARTS)))
    dealt.sortWithinPartitions("bucket", "hash").write.partitionBy("bucket").parquet(f"{path}/postings")
    rows.repartitionByRange(key).sortWithinPartitions(key).write.parquet(f"{path}/rows")
    return SearchIndex(spark, path, key, text, buckets, dict(rows.dtypes)[key])
