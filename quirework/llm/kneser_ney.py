"""Quality classifier: an interpolated modified Kneser-Ney model of trusted text.

Trusted documents (label 1) with words fall into two folds by hash of their text, so equal texts stay together: about one
in ``folds`` sets thresholds, all others train the model. Each language has a trusted document among those that set
thresholds, and one that trains if it has two different ones. The model's counts are tables keyed by 64-bit n-gram hash:
raw counts for the highest order, continuation counts below, with the three discounts of each order from its counts of
counts; joins of those tables, sharded by hash, give every n-gram's probability. As interpolation is
P(w | uv) = max(c(uvw) - D, 0) / c(uv) + g(uv) P(w | v), the log probability of a text is a sum with one term for each
n-gram in it that the model knows:

    base(w) + [v known] log g(v) + [vw known] (log P(w|v) - log g(v) P(w)) + [uv known] log g(uv)
    + [uvw known] (log P(w|uv) - log g(uv) P(w|v))

so each n-gram has two terms, its own and the one it gives as a context. The table of terms grows with the trusted text
and stays in shared storage; each document's n-grams are counted and joined with it by hash. Only what has a fixed size
is sent around: the ``head`` most frequent n-grams, whose terms are added without a join, and a bitmap that keeps most
n-grams the model does not know out of the shuffle. Terms are whole multiples of 2**-30, so sums do not depend on order.
A document is kept when its perplexity is at most the ``quantile`` of the threshold fold's documents of its language (of
the whole threshold fold where the language has no trusted document).

Defined results: null and blank texts have no perplexity and are not kept; a null language is a language of its own;
without trusted documents every document has perplexity by the uniform model, no threshold and is kept; repeated rows are
scored each, and learnt from each if they are trusted; thresholds are ``percentile_approx`` at an accuracy of 10000, so a
rank off by 1 in 10000 at most; a text of any length is one row of a batch; n-grams are equal if 64 bits of their hashes
are; empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirework.llm import tokens
from quirework.llm.shared import fixed_bitmap, id_mask, in_bitmap, release, slices, stage


#: Terms are held as whole multiples of 1 / UNIT.
UNIT = 1 << 30
#: Places of the bitmap, as a power of 2.
BITS = 27


@dataclass
class Model:
    """``terms``: key, own and context of every n-gram but the head's; the head as sorted arrays; ``bitmap`` of the keys."""

    terms: DataFrame
    head: tuple[np.ndarray, np.ndarray, np.ndarray]
    bitmap: np.ndarray
    unseen: int


def _grams(w: tokens.Words) -> list[np.ndarray]:
    """Hashes of the 1-, 2- and 3-grams that end at each word; 0 where the row begins later."""
    h = w.hash
    out = [h]
    for n in (2, 3):
        full = np.zeros(len(h), np.uint64)
        if len(h) >= n:
            inside = w.row[: len(h) - n + 1] == w.row[n - 1 :]
            rolled, _ = tokens.shingles(w, n)
            full[n - 1 :][inside] = rolled
        out.append(full)
    return out


def _trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(w, v, vw, uv, uvw, n): every trigram of a slice with the n-grams it is made of; short rows give their bigrams."""
    for batch in slices(batches):
        w = tokens.words(batch.column("text"))
        one, two, three = _grams(w)
        at = np.arange(len(one))
        before = np.where(two != 0, one[np.maximum(at - 1, 0)], 0)
        prefix = np.where(three != 0, two[np.maximum(at - 1, 0)], 0)
        key = np.zeros(len(one), np.dtype([(x, np.uint64) for x in ("w", "v", "vw", "uv", "uvw")]))
        key["w"], key["v"], key["vw"], key["uv"], key["uvw"] = one, before, two, prefix, three
        deciding = np.where(three != 0, three, np.where(two != 0, two, one))
        order = np.argsort(deciding, kind="stable")
        fresh = np.ones(len(order), bool)
        fresh[1:] = deciding[order][1:] != deciding[order][:-1]
        begin = np.flatnonzero(fresh)
        n = np.diff(np.append(begin, len(order)))
        key = key[order][begin]
        names = ["w", "v", "vw", "uv", "uvw"]
        yield pa.RecordBatch.from_arrays([pa.array(key[x].view(np.int64)) for x in names] + [pa.array(n.astype(np.int64))], [*names, "n"])


def _discounts(table: DataFrame, count: str) -> list[float]:
    """D1, D2, D3+ of modified Kneser-Ney from the counts of counts."""
    c = table.agg(*(F.count_if(F.col(count) == k).alias(f"n{k}") for k in range(1, 5))).first()
    n1, n2, n3, n4 = (float(x) for x in c)
    if min(n1, n2, n3) == 0:
        return [0.5, 0.5, 0.5]
    y = n1 / (n1 + 2 * n2)
    raw = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return [min(max(d, 0.05), k - 0.05) for k, d in enumerate(raw, 1)]


def _minus(count: str, d: list[float]):
    return F.when(F.col(count) == 1, d[0]).when(F.col(count) == 2, d[1]).otherwise(d[2])


def train(trusted: DataFrame, head: int = 1 << 18) -> Model:
    """Model of all texts of ``trusted``: every table is a count, grouped or joined by n-gram hash."""
    grams = stage(
        trusted.mapInArrow(_trigrams, "w long, v long, vw long, uv long, uvw long, n long")
        .groupBy("w", "v", "vw", "uv", "uvw")
        .agg(F.sum("n").alias("n")),
        "trigrams",
    )
    three = grams.where("uvw <> 0").select("w", "v", "vw", "uv", "uvw", "n")
    # a bigram's continuation count is the number of trigrams that end in it; one that only begins rows counts once
    two = stage(grams.where("vw <> 0").groupBy("w", "v", "vw").agg(F.greatest(F.count_if(F.col("uvw") != 0), F.lit(1)).cast("long").alias("n")), "bigrams")
    one = stage(grams.select("w", "vw").distinct().groupBy("w").agg(F.greatest(F.count_if(F.col("vw") != 0), F.lit(1)).cast("long").alias("n")), "unigrams")
    d1, d2, d3 = _discounts(one, "n"), _discounts(two, "n"), _discounts(three, "n")

    mass = one.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("s"), F.coalesce(F.sum(_minus("n", d1)), F.lit(0.0)).alias("left"), F.count("*").alias("v")).first()
    kinds = int(mass["v"]) + 1
    whole = float(mass["s"]) or 1.0
    gamma = float(mass["left"]) / whole if mass["s"] else 1.0
    p1 = one.select("w", "n", ((F.col("n") - _minus("n", d1)) / whole + gamma / kinds).alias("p1"))
    context1 = two.groupBy("v").agg(F.sum("n").alias("s"), F.sum(_minus("n", d2)).alias("left")).select("v", "s", (F.col("left") / F.col("s")).alias("g"))
    p2 = stage(
        two.join(context1, "v").join(p1.select("w", "p1"), "w").select(
            "vw", "n", F.col("g").alias("g1"), "p1", ((F.col("n") - _minus("n", d2)) / F.col("s") + F.col("g") * F.col("p1")).alias("p2")
        ),
        "p2",
    )
    context2 = three.groupBy("uv").agg(F.sum("n").alias("s"), F.sum(_minus("n", d3)).alias("left")).select("uv", "s", (F.col("left") / F.col("s")).alias("g"))
    p3 = three.join(context2, "uv").join(p2.select("vw", "p2"), "vw").select(
        "uvw", "n", (F.log((F.col("n") - _minus("n", d3)) / F.col("s") + F.col("g") * F.col("p2")) - F.log(F.col("g") * F.col("p2"))).alias("own")
    )
    # an unknown word has the term ``unseen``, which every word of a text gets; the unigrams' own terms are what they add
    unseen = float(np.log(gamma / kinds))
    zero = F.lit(0.0)
    unigrams = p1.join(context1.select(F.col("v").alias("w"), "g"), "w", "left").select(
        F.col("w").alias("key"), "n", (F.log("p1") - unseen).alias("own"), F.coalesce(F.log("g"), zero).alias("context")
    )
    bigrams = p2.join(context2.select(F.col("uv").alias("vw"), "g"), "vw", "left").select(
        F.col("vw").alias("key"), "n", (F.log("p2") - F.log(F.col("g1") * F.col("p1"))).alias("own"), F.coalesce(F.log("g"), zero).alias("context")
    )
    trigrams = p3.select(F.col("uvw").alias("key"), "n", "own", zero.alias("context"))
    fixed = lambda c: F.round(F.col(c) * UNIT).cast("long").alias(c)
    table = stage(unigrams.unionByName(bigrams).unionByName(trigrams).select("key", "n", fixed("own"), fixed("context")), "model")
    release(grams, two, one, p2)
    top = table.orderBy(F.desc("n"), "key").limit(head).toArrow()
    key = top.column("key").to_numpy().view(np.uint64)
    order = np.argsort(key)
    held = (key[order], top.column("own").to_numpy()[order], top.column("context").to_numpy()[order])
    return Model(table.select("key", "own", "context"), held, fixed_bitmap(table, "key", BITS), round(unseen * UNIT))


def _counted(w: tokens.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, hash, own, context): how often each n-gram stands in each row, and how often as the context of a longer one."""
    grams = _grams(w)
    rows, hashes, contexts = [], [], []
    for k, h in enumerate(grams):
        after = np.zeros(len(h), np.int64)
        if k < 2 and len(h):
            after[:-1] = grams[k + 1][1:] != 0
        real = h != 0
        rows.append(w.row[real])
        hashes.append(h[real])
        contexts.append(after[real])
    row, h, context = np.concatenate(rows), np.concatenate(hashes), np.concatenate(contexts)
    order = np.lexsort((h, row))
    row, h, context = row[order], h[order], context[order]
    fresh = np.ones(len(h), bool)
    fresh[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    begin = np.flatnonzero(fresh)
    own = np.diff(np.append(begin, len(h)))
    return row[begin], h[begin], own, np.add.reduceat(context, begin) if len(begin) else context


_ENTRIES = "at_row long, key long, own int, context int, doc_id long, lang_key long, n_words long, part long"


def _entries(model):
    """One row a document with what the head gives, and one for each other n-gram that the model may know."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (keys, head_own, head_context), bitmap, unseen = model.value
        for batch in slices(batches):
            w = tokens.words(batch.column("text"))
            row, h, own, context = _counted(w)
            n = w.counts.astype(np.int64)
            part = n * unseen
            rest = in_bitmap(bitmap, h)
            if len(keys):
                place = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
                hit = keys[place] == h
                np.add.at(part, row[hit], own[hit] * head_own[place[hit]] + context[hit] * head_context[place[hit]])
                rest &= ~hit
            at_row = batch.column("at_row").to_numpy()
            row, k, m = row[rest], int(rest.sum()), batch.num_rows
            no = pa.nulls(k, pa.int64())
            none = np.zeros(m, np.int32)
            # a document's own row meets no n-gram: any key will do, and these spread
            spread = tokens.mix(at_row.astype(np.uint64))
            columns = [
                pa.array(np.concatenate([at_row, at_row[row]])),
                pa.array(np.concatenate([spread, h[rest]]).view(np.int64)),
                pa.array(np.concatenate([none, own[rest]]).astype(np.int32)),
                pa.array(np.concatenate([none, context[rest]]).astype(np.int32)),
                pa.concat_arrays([batch.column("doc_id"), no]),
                pa.concat_arrays([batch.column("lang_key"), no]),
                pa.concat_arrays([pa.array(n), no]),
                pa.concat_arrays([pa.array(part), no]),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["at_row", "key", "own", "context", "doc_id", "lang_key", "n_words", "part"])

    return run


def perplexities(rows: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang, n_words and perplexity of each of ``rows`` (doc_id, lang, text)."""
    sent = rows.sparkSession.sparkContext.broadcast((model.head, model.bitmap, model.unseen))
    keyed = rows.select("doc_id", F.xxhash64("lang").alias("lang_key"), "text", F.monotonically_increasing_id().alias("at_row"))
    terms = model.terms.select("key", F.col("own").alias("own_term"), F.col("context").alias("context_term"))
    zero = F.lit(0).cast("long")
    value = F.coalesce("part", zero) + F.coalesce(F.col("own") * F.col("own_term") + F.col("context") * F.col("context_term"), zero)
    sums = (
        keyed.mapInArrow(_entries(sent), _ENTRIES)
        .join(terms, "key", "left")
        .groupBy("at_row")
        .agg(F.max("doc_id").alias("doc_id"), F.max("lang_key").alias("lang_key"), F.max("n_words").alias("n_words"), F.sum(value).alias("logs"))
    )
    langs = stage(rows.select("lang").distinct().select("lang", F.xxhash64("lang").alias("lang_key")), "languages")
    per_word = -F.col("logs") / UNIT / F.col("n_words")
    return sums.join(langs, "lang_key").select(
        "doc_id", "lang", "n_words", F.when(F.col("n_words") > 0, F.exp(F.least(per_word, F.lit(700.0)))).alias("perplexity")
    )


def perplexity_filter(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str = "quality",
    quantile: float = 0.995,
    folds: int = 5,
) -> DataFrame:
    """doc_id, lang, n_words, perplexity, threshold (of the language) and kept for each document."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), "text")
    good = labels.where((F.col(label_col) == 1) & F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    hashed = rows.select("doc_id", "lang", F.xxhash64("text").alias("h"), F.col("text").rlike(r"[^\x20\x09-\x0D]").alias("has_words"))
    trusted = stage(hashed.where("has_words").join(good, "doc_id", "left_semi").select("doc_id", "lang", "h"), "trusted")
    ends = trusted.groupBy(F.col("lang").alias("_lang")).agg(F.min("h").alias("low"), F.max("h").alias("high"))
    sets = (F.pmod("h", F.lit(folds)) == 0) | (F.col("h") == F.col("low"))
    # the fold of a text: a language's smallest hash sets thresholds, its largest trains
    fold = stage(
        trusted.join(F.broadcast(ends), F.col("lang").eqNullSafe(F.col("_lang"))).select("doc_id", "lang", "h", (sets & ((F.col("h") != F.col("high")) | (F.col("low") == F.col("high")))).alias("sets")),
        "fold",
    )
    learnt = fold.where("not sets").select("doc_id", "h")
    # only texts that may be learnt from are shuffled
    listed = id_mask(learnt.select(F.xxhash64("doc_id", "h").alias("k")), "k", learnt.count())
    suspect = listed(F.xxhash64("doc_id", F.xxhash64("text")))
    model = train(rows.where(suspect).withColumn("h", F.xxhash64("text")).join(learnt, ["doc_id", "h"], "left_semi").select("text"))
    scored = stage(perplexities(rows, model), "perplexity")
    fresh = scored.where("perplexity is not null").join(fold.where("sets").select("doc_id").distinct(), "doc_id", "left_semi")
    limits = fresh.rollup("lang").agg(F.percentile_approx("perplexity", quantile, 10000).alias("threshold"), F.grouping_id().alias("level"))
    limits = stage(limits, "limits")
    overall = limits.where("level = 1").select("threshold").limit(1).collect()
    default = F.lit(overall[0][0] if overall else None).cast("double")
    by_lang = limits.where("level = 0").select(F.col("lang").alias("_lang"), "threshold")
    limit = F.coalesce("threshold", default)
    return scored.join(by_lang, F.col("lang").eqNullSafe(F.col("_lang")), "left").select(
        "doc_id",
        "lang",
        "n_words",
        "perplexity",
        limit.alias("threshold"),
        F.coalesce(F.col("perplexity") <= limit, F.col("perplexity").isNotNull()).alias("kept"),
    )
