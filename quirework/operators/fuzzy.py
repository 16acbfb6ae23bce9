"""Fuzzy matching of titles and quotations, in Arrow batches where alignment needs it."""

from __future__ import annotations

from collections.abc import Iterator
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from quirework.functions import text as T


@F.pandas_udf(DoubleType())
def matching_ratio(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """Ratcliff-Obershelp similarity of two strings, 0 to 1."""
    for a, b in batches:
        yield pd.Series([SequenceMatcher(None, x, y).ratio() if x and y else 0.0 for x, y in zip(a, b)])


#: Titles of one family match as a whole only; the numbers that end a line of an index.
EXACT_FAMILY = "الصلاة "
INDEX_SUFFIX = r"\s+[0-9٠-٩]+(?:\.[0-9٠-٩]+)+\s*$"


def title_facts(title: Column) -> Column:
    """What scores need to know of a title: struct(key, bare)."""
    return F.struct(T.match_key(title).alias("key"), T.strip(title).alias("bare"))


def text_facts(text: Column, index_suffix: str = INDEX_SUFFIX) -> Column:
    """What scores need to know of a block's text: struct(key, bare, numbered)."""
    bare = T.strip(text)
    return F.struct(T.match_key(text).alias("key"), bare.alias("bare"), bare.rlike(index_suffix).alias("numbered"))


def _needs_ratio(title: Column, text: Column) -> Column:
    """Whether nothing but the matching ratio decides."""
    decided = (title["key"] == "") | (text["key"] == "") | title["bare"].startswith(EXACT_FAMILY)
    around = F.contains(title["key"], text["key"]) & (F.length(text["key"]) >= 8)
    return ~(decided | F.contains(text["key"], title["key"]) | around)


def _score(title: Column, text: Column, ratio: Column) -> Column:
    title_key, wanted, key, bare, numbered = title["key"], title["bare"], text["key"], text["bare"], text["numbered"]
    n, m = F.length(title_key), F.length(key)
    begins = bare.startswith(wanted)
    held = 1 - F.least(F.lit(0.35), (m - n) / F.greatest(n, F.lit(1)) * 0.12)
    inside, around = F.contains(key, title_key), F.contains(title_key, key) & (m >= 8)
    base = F.when(inside, held).when(around, 0.88).otherwise(ratio)
    named = F.when(bare == wanted, 1.0).when(begins & ~numbered, F.greatest(base, F.lit(0.99))).otherwise(base)
    moved = named - F.when(bare.startswith("."), 0.35).otherwise(0.0) - F.when(numbered, 0.55).otherwise(0.0) + F.when(m <= n + 8, 0.08).otherwise(0.0)
    return (
        F.when((title_key == "") | (key == ""), 0.0)
        .when(wanted.startswith(EXACT_FAMILY), F.when(bare == wanted, 1.0).when(begins & ~numbered, 0.99).otherwise(0.0))
        .when((n <= 14) & inside & (m > n + 6), 0.0)
        .otherwise(F.greatest(F.lit(0.0), F.least(moved, F.lit(1.0))))
    )


def title_score(title: Column, text: Column, index_suffix: str = INDEX_SUFFIX) -> Column:
    """How well a block's text fits a title, 0 to 1.

    By their keys: containment loses by the surplus, being contained gives 0.88, else the matching ratio counts. Texts that
    are or begin with the title count as such; leading dots and index numbers cost, similar lengths gain. Short titles
    within longer texts, and near misses of the family whose titles all resemble each other, count for nothing.
    """
    a, b = title_facts(title), text_facts(text, index_suffix)
    return _score(a, b, matching_ratio(a["key"], b["key"]))


def scored_titles(titles: DataFrame, blocks: DataFrame, page: str = "page", least: float = 0.0) -> DataFrame:
    """Every title (page, toc_index, title) with every block (page, block_no, text) of its page, and ``score``.

    Keys are made once for each title and block, and only pairs that nothing else decides are aligned. With ``least``, pairs
    whose lengths alone keep them below it aren't either: their score is too low by then, but it would be below ``least``.
    """
    a = titles.select(page, "toc_index", title_facts(F.col("title")).alias("_title"))
    b = blocks.select(page, "block_no", text_facts(F.col("text")).alias("_text"))
    met = a.join(b, page)
    n, m = F.length("_title.key"), F.length("_text.key")
    near = 2 * F.least(n, m) >= (least - 0.08) * (n + m)
    open_ = _needs_ratio(F.col("_title"), F.col("_text")) & (near | F.col("_text.bare").startswith(F.col("_title.bare")))
    ratio = matching_ratio(F.when(open_, F.col("_title.key")), F.when(open_, F.col("_text.key")))
    scored = met.withColumn("_ratio", ratio)
    return scored.select(page, "toc_index", "block_no", _score(F.col("_title"), F.col("_text"), F.col("_ratio")).alias("score"))


def inline_title(texts: DataFrame, titles: DataFrame, page: str = "page") -> DataFrame:
    """``texts`` (page, block_no, text) with the longest title (page, toc_index, title) of their page that they hold: at
    their beginning, or anywhere for the family that matches as a whole. (page, block_no, toc_index, start, end)"""
    met = texts.join(titles.withColumn("title", T.strip(F.col("title"))).where("title <> ''"), page)
    start = F.instr(F.col("text"), F.col("title")) - 1
    found = met.withColumn("start", start).where((F.col("start") == 0) | ((F.col("start") > 0) & F.col("title").startswith(EXACT_FAMILY)))
    best = found.groupBy(page, "block_no").agg(F.max(F.struct(F.length("title").alias("n"), (-F.col("toc_index")).alias("first"), "start")).alias("b"))
    return best.select(page, "block_no", (-F.col("b.first")).alias("toc_index"), "b.start", (F.col("b.start") + F.col("b.n")).alias("end"))


def assign_titles(scored: DataFrame, least: float = 0.62) -> DataFrame:
    """Greedy assignment per page (page, toc_index, block_no, score): in title order, each takes its best unused block.

    A page holds a few titles and blocks, so a fold over its sorted candidates is small.
    """
    row = F.struct("toc_index", (-F.col("score")).alias("cost"), "block_no")
    each = scored.where(F.col("score") >= least).groupBy("page").agg(F.array_sort(F.collect_list(row)).alias("c"))
    none = F.filter("c", lambda x: F.lit(False))

    def step(acc: Column, x: Column) -> Column:
        taken = F.exists(acc, lambda k: (k["toc_index"] == x["toc_index"]) | (k["block_no"] == x["block_no"]))
        return F.when(taken, acc).otherwise(F.concat(acc, F.array(x)))

    return each.select("page", F.explode(F.aggregate("c", none, step)).alias("x")).select("page", "x.toc_index", "x.block_no", (-F.col("x.cost")).alias("score"))


_ALIGNED = "start int, end int, status string"


def _align(text: str, quote: str, coverage: float) -> tuple[int | None, int | None, str]:
    at = text.find(quote)
    if quote and at >= 0:
        return at, at + len(quote), "exact"
    words, spots, here = quote.lower().split(), [], 0
    for w in text.split():
        here = text.index(w, here)
        spots.append((here, here + len(w), w.lower()))
        here += len(w)
    blocks = [b for b in SequenceMatcher(None, [s[2] for s in spots], words, autojunk=False).get_matching_blocks() if b.size]
    if words and blocks and sum(b.size for b in blocks) >= coverage * len(words):
        first, last = blocks[0].a, blocks[-1].a + blocks[-1].size
        if len(words) >= (last - first) / 3:
            return spots[first][0], spots[last - 1][1], "fuzzy"
    return None, None, "none"


def align(pairs: DataFrame, text: str = "text", quote: str = "quote", coverage: float = 0.75) -> DataFrame:
    """Add ``start``, ``end`` and ``status``: where a quote stands in its text, exactly or by common words in order.

    A fuzzy place must hold ``coverage`` of the quote's words, on a stretch of three times their number at most.
    """
    @F.pandas_udf(_ALIGNED)
    def run(texts: pd.Series, quotes: pd.Series) -> pd.DataFrame:
        out = [_align(t or "", q or "", coverage) for t, q in zip(texts, quotes)]
        return pd.DataFrame(out, columns=["start", "end", "status"]).astype({"start": "Int32", "end": "Int32"})

    return pairs.withColumn("_a", run(text, quote)).select(*pairs.columns, "_a.*")
