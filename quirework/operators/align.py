"""Alignment of short texts (items) with long ones, by seeds and chains: no text is compared with another unless they
share enough windows of ``k`` tokens.

1. Windows of ``k`` tokens that an item and a text share are anchors (place in the item, place in the text). They come
   from one join on the windows' hashes.
2. Anchors are grouped by stretches of the text, each twice as long as an alignment may be and half overlapping the next,
   so every alignment lies within one stretch and no group grows with the text. In each, the longest chain of anchors that
   rises in both places is found; it must hold ``seeds`` of the item's windows.
3. The text around an item's best chain is aligned token by token: the longest common subsequence of the item's tokens
   and those around it (a chain again, of single tokens).

``exact``: all tokens of the item, one after the other. ``fuzzy``: at least ``coverage`` of them in order, in a stretch
where at least ``density`` of the tokens are theirs. ``lesser``: neither, but at least ``lesser`` of them one after the
other. Anything less gives no row. Tokens are those of ``functions.tokens`` in lower case, of any script. Null and empty
texts and items have none and give no row; items of fewer than ``k`` tokens have one window, all of them.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from quirework.functions.tokens import split, tokens_at

#: How much longer than its item an alignment may be is 1 / density; what is read around a chain, in parts of the item.
_MARGIN = 0.25


def rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest chain of (i, j) pairs that rises in both, of several the one that ends first (by j)."""
    pairs = sorted(set(pairs), key=lambda p: (p[1], -p[0]))
    ends: list[int] = []
    at: list[int] = []
    before: list[int] = []
    reached: list[int] = []
    for n, (i, _) in enumerate(pairs):
        size = bisect_left(ends, i)
        before.append(at[size - 1] if size else -1)
        if size == len(ends):
            ends.append(i)
            at.append(n)
            reached.append(n)
        else:
            ends[size], at[size] = i, n
    out = []
    n = reached[-1] if reached else -1
    while n >= 0:
        out.append(pairs[n])
        n = before[n]
    return out[::-1]


_ENDS = ("size", "first_i", "first_j", "last_i", "last_j")


@F.arrow_udf(StructType([StructField(c, IntegerType()) for c in _ENDS]))
def _chain(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        out = []
        for anchors in batch.to_pylist():
            found = rising([(a["i"], a["j"]) for a in anchors])
            out.append({"size": len(found), "first_i": found[0][0], "first_j": found[0][1], "last_i": found[-1][0], "last_j": found[-1][1]})
        yield pa.array(out, pa.struct([(c, pa.int32()) for c in _ENDS]))


def common(item: list[str], text: list[str]) -> tuple[list[tuple[int, int]], tuple[int, int]]:
    """The longest common subsequence as (place in item, place in text), and the longest common run as (place, size)."""
    where: dict[str, list[int]] = {}
    for i, word in enumerate(item):
        where.setdefault(word, []).append(i)
    pairs, runs, best = [], {}, (0, 0)
    for j, word in enumerate(text):
        now = {}
        for i in where.get(word, ()):
            pairs.append((i, j))
            now[i] = runs.get(i - 1, 0) + 1
            if now[i] > best[1]:
                best = (j + 1 - now[i], now[i])
        runs = now
    return rising(pairs), best


_ALIGNED = [("first", pa.int32()), ("last", pa.int32()), ("status", pa.string()), ("matched", pa.int32())]


def _alignment(coverage: float, density: float, lesser: float):
    @F.arrow_udf("struct<first:int,last:int,status:string,matched:int>")
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for items, texts in batches:
            out = []
            for item, text in zip(items.to_pylist(), texts.to_pylist()):
                found, (at, size) = common(item, text)
                span = found[-1][1] + 1 - found[0][1] if found else 0
                if size == len(item):
                    out.append({"first": at, "last": at + size - 1, "status": "exact", "matched": size})
                elif len(found) >= coverage * len(item) and len(found) >= density * span:
                    out.append({"first": found[0][1], "last": found[-1][1], "status": "fuzzy", "matched": len(found)})
                elif size >= lesser * len(item):
                    out.append({"first": at, "last": at + size - 1, "status": "lesser", "matched": size})
                else:
                    out.append(None)
            yield pa.array(out, pa.struct(_ALIGNED))

    return run


def _windows(k: int):
    """The hashes of all runs of ``k`` tokens of a text, as a function of the text."""

    @F.arrow_udf(ArrayType(LongType()))
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            ends, out = [0], []
            for text in batch.to_pylist():
                h = np.array([xxhash.xxh3_64_intdigest(t.lower()) for _, _, t in split(text or "")], np.uint64)
                n = max(0, len(h) - k + 1)
                rolled = np.zeros(n, np.uint64)
                for x in range(k):
                    rolled = (rolled ^ (rolled >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + h[x : x + n]
                out.append(rolled.view(np.int64))
                ends.append(ends[-1] + n)
            yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int64), *out])))

    return run


def align_items(
    docs: DataFrame,
    items: DataFrame,
    doc_key: str = "doc_id",
    item_key: str = "item_id",
    text: str = "text",
    k: int = 3,
    seeds: float = 0.2,
    coverage: float = 0.75,
    density: float = 1 / 3,
    lesser: float = 0.5,
) -> DataFrame:
    """(doc, item, start, end, status, matched, coverage): the best alignment of each item with each text that has one."""
    low = lambda at: F.transform(at, lambda t: F.lower(t["text"]))
    asked = items.select(F.col(item_key).alias("_item"), F.col(text).alias("_text"), low(tokens_at(F.col(text))).alias("_words")).where(F.size("_words") > 0)
    asked = asked.select("*", F.size("_words").alias("_m"), F.least(F.size("_words"), F.lit(k)).alias("_k"))
    sizes = sorted(r["_k"] for r in asked.select("_k").distinct().collect())  # k numbers at most
    if not sizes:
        kinds = dict(docs.dtypes) | dict(items.dtypes)
        return docs.sparkSession.createDataFrame([], f"{doc_key} {kinds[doc_key]}, {item_key} {kinds[item_key]}, start long, end long, status string, matched int, coverage double")
    met = []
    for size in sizes:
        seed = asked.where(F.col("_k") == size).select("_item", "_m", "_k", F.posexplode(_windows(size)("_text")).alias("i", "h"))
        probe = docs.select(F.col(doc_key).alias("_doc"), F.posexplode(_windows(size)(text)).alias("j", "h"))
        met.append(probe.join(seed, "h"))
    anchored = reduce(DataFrame.unionByName, met)
    reach = F.ceil(F.col("_m") / density + 2 * _MARGIN * F.col("_m")).cast("int")
    stretch = F.floor(F.col("j") / reach)
    anchors = anchored.select("_doc", "_item", "_m", "_k", "i", "j", F.explode(F.array(stretch, stretch - 1)).alias("s"))
    needed = F.ceil(seeds * (F.col("_m") - F.col("_k") + 1) - 1e-9)
    grouped = anchors.groupBy("_doc", "_item", "_m", "_k", "s").agg(F.collect_list(F.struct("i", "j")).alias("a")).where(F.size("a") >= needed)
    chained = grouped.withColumn("c", _chain("a")).where(F.col("c.size") >= needed)
    best = chained.groupBy("_doc", "_item").agg(F.max(F.struct("c.size", (-F.col("c.first_j")).alias("f"), (-F.col("c.last_j")).alias("l"), "c", "_k")).alias("b"))
    place = best.select("_doc", "_item", "b.c.*", "b._k").join(asked.select("_item", "_words", "_m"), "_item")
    margin = F.ceil(_MARGIN * F.col("_m")).cast("int")
    begin = F.greatest(F.col("first_j") - F.col("first_i") - margin, F.lit(0))
    until = F.col("last_j") + F.col("_m") - F.col("last_i") + margin
    around = place.select("_doc", "_item", "_m", F.col("_words").alias("_asked"), begin.alias("_begin"), until.alias("_until"))
    read = around.join(docs.select(F.col(doc_key).alias("_doc"), F.col(text).alias("_text")), "_doc").withColumn("_at", tokens_at("_text"))
    near = read.withColumn("_near", F.slice("_at", F.col("_begin") + 1, F.col("_until") - F.col("_begin")))
    aligned = near.withColumn("x", _alignment(coverage, density, lesser)(F.col("_asked"), low(F.col("_near")))).where("x is not null")
    return aligned.select(
        F.col("_doc").alias(doc_key),
        F.col("_item").alias(item_key),
        F.get("_near", F.col("x.first"))["start"].cast("long").alias("start"),
        F.get("_near", F.col("x.last"))["end"].cast("long").alias("end"),
        "x.status",
        "x.matched",
        (F.col("x.matched") / F.col("_m")).alias("coverage"),
    )
