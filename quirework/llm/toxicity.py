"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

Two lexicons are used. One is given; the other is learnt, as insults differ by language: of the words and word beginnings
(four to eight bytes) in ``lexicon_sample`` labelled rows of either class, those that stand in far more toxic than other
contexts, by likelihood ratio. A context is the word with its neighbours, so copies of a text add nothing.

Features of a text (mostly shares, so length alone does not decide): given lexicon words, their number up to three, those
found only after undoing substitutions (``1d10t``, ``i.d.i.o.t``), those within five words of a second-person pronoun;
learnt lexicon words, their number up to five, the highest weight; second-person pronouns, all-capital words, capital
letters, punctuation, exclamation and question marks, doubled marks, words that mix letters with digits or symbols,
letters held for three or more places, and the log of the word count.

The trees are fitted on a bounded sample of labelled rows (``sample``); a quarter of it, by hash of the id, is kept from
the trees and fits the isotonic curve. ``labels``, ``lang``, ``source`` and ``doc_id`` are never inputs of a score.

Defined results: null and empty texts have all features 0 and get a score as any other; labels that are null, in the
held-out fold or without a document are not learnt from; with fewer than two classes of label every score is the share
of label 1 (0.0 without labels); repeated rows are scored each; empty tables give an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirework.llm import tokens
from quirework.llm.shared import BLANKS, crc_remainder, slices, stage, without_ids

LEXICON = (
    "idiot moron stupid dumb loser scum trash garbage clown fool pathetic worthless disgusting ugly filthy vermin pig "
    "retard imbecile cretin jerk bastard hate kill scumbag lowlife maggot parasite creep"
).split()
SECOND_PERSON = (
    "you your yours yourself u ur du dich dir dein deine euch euer tu te toi ton ta tes vous votre vos usted ustedes tú ti "
    "tus vosotros"
).split()
FEATURES = [
    "lexicon", "lexicon_any", "hidden", "near_second", "learnt", "learnt_any", "learnt_weight", "second", "capital_words", "capitals", "punctuation", "marks",
    "doubled_marks", "mixed", "held_letters", "log_words",
]
_REACH = 5
_BEGINNINGS = (4, 5, 6, 7, 8)

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_PUNCT = np.zeros(256, bool)
_PUNCT[33:48] = _PUNCT[58:65] = _PUNCT[91:97] = _PUNCT[123:127] = True
#: What stands for a letter in disguised words: fixed values.
_DISGUISE = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "|": "i"}
_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[65:91] += 32
_OPENED = _PLAIN.copy()
for _from, _to in _DISGUISE.items():
    _OPENED[ord(_from)] = ord(_to)


def _squeezed(data: np.ndarray, keep: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the words over their kept bytes only."""
    upto = np.concatenate([[0], np.cumsum(keep, dtype=np.int64)])
    return tokens.hashed(data[keep], upto[start], upto[end])


def _member(hashes: np.ndarray, known: np.ndarray) -> np.ndarray:
    place = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    return known[place] == hashes


def _lexicon_hashes(words: list[str]) -> np.ndarray:
    return np.unique(tokens.hash_words(words))


@dataclass
class Lexicon:
    """Learnt keys (hashes of words and word beginnings, sorted) and their log odds."""

    key: np.ndarray
    weight: np.ndarray

    def weights(self, keys: list[np.ndarray]) -> np.ndarray:
        """The highest weight of each word's keys, 0 without one."""
        out = np.zeros(len(keys[0]))
        if len(self.key):
            for h in keys:
                place = np.minimum(np.searchsorted(self.key, h), len(self.key) - 1)
                out = np.maximum(out, np.where(self.key[place] == h, self.weight[place], 0))
        return out


def _lowered(data: np.ndarray) -> np.ndarray:
    """A-Z and the capital letters of Latin-1 in lower case."""
    out = _PLAIN[data]
    if len(out) > 1:
        accented = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
        out[1:][accented] += 32
    return out


def _keys(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> list[np.ndarray]:
    """Hashes of each word (letters and digits, lower-cased) and of its beginnings; whole words come first."""
    keep = _LETTER[data] | _DIGIT[data]
    held = _lowered(data)[keep]
    upto = np.concatenate([[0], np.cumsum(keep, dtype=np.int64)])
    a, b = upto[start], upto[end]
    whole = tokens.hashed(held, a, b)
    out = [whole]
    for n in _BEGINNINGS:
        long = b - a > n
        cut = np.where(long, a + n, b)
        out.append(np.where(long, tokens.mix(tokens.hashed(held, a, cut) + np.uint64(n)), whole))
    return out


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, context, label) once for each slice."""
    for batch in slices(batches):
        text = tokens.Text.of(batch.column("text"))
        row, start, end, _ = tokens.spans(text)
        keys = _keys(text.data, start, end)
        whole = keys[0]
        around = np.zeros(len(whole), np.uint64)
        around[1:] += np.where(row[1:] == row[:-1], whole[:-1], 0)
        around[:-1] += np.where(row[1:] == row[:-1], tokens.mix(whole[1:]), 0)
        label = batch.column("label").to_numpy()[row].astype(np.int8)
        for k, key in enumerate(keys):
            new = np.ones(len(key), bool) if k == 0 else key != whole
            found = np.zeros(int(new.sum()), np.dtype([("k", np.uint64), ("c", np.uint64), ("l", np.int8)]))
            found["k"], found["c"], found["l"] = key[new], tokens.mix(around[new] + whole[new]), label[new]
            yield pa.RecordBatch.from_arrays(
                [pa.array(found["k"].copy().view(np.int64)), pa.array(found["c"].copy().view(np.int64)), pa.array(found["l"].astype(np.int32))],
                ["key", "context", "label"],
            )


def fit_lexicon(docs: DataFrame, labelled: DataFrame, sample: int, least: float = 25.0, ratio: float = 5.0, size: int = 2048) -> Lexicon:
    """``labelled``: doc_id, label (0 or 1); at most ``sample`` rows of either label are read, ``size`` keys kept."""
    by_hash = [F.xxhash64("doc_id"), "doc_id"]
    chosen = stage(
        labelled.where("label = 1").orderBy(*by_hash).limit(sample).unionByName(labelled.where("label = 0").orderBy(*by_hash).limit(sample)), "lexicon-rows"
    )
    rows = docs.join(F.broadcast(chosen), "doc_id").select("label", "text")
    seen = rows.mapInArrow(_contexts, "key long, context long, label int").distinct()
    counts = stage(
        seen.groupBy("key").agg(F.sum("label").alias("n1"), F.sum(1 - F.col("label")).alias("n0")).where("n1 >= 4"), "lexicon-counts"
    )
    totals = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.sum(F.size(F.split("text", BLANKS))).alias("n")).collect()}
    t1, t0 = float(totals.get(1.0) or 1), float(totals.get(0.0) or 1)
    n = F.col("n1") + F.col("n0")
    gain = 2 * (F.col("n1") * F.log(F.col("n1") * (t1 + t0) / (n * t1)) + F.when(F.col("n0") > 0, F.col("n0") * F.log(F.col("n0") * (t1 + t0) / (n * t0))).otherwise(0.0))
    odds = F.log((F.col("n1") + 0.5) / t1) - F.log((F.col("n0") + 0.5) / t0)
    top = counts.select("key", odds.alias("odds"), gain.alias("gain")).where((F.col("gain") >= least) & (F.col("odds") >= float(np.log(ratio)))).orderBy(F.desc("gain"), "key").limit(size).toPandas()
    key = top["key"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(key)
    return Lexicon(key[order], top["odds"].to_numpy(float)[order])


def dense_features(column: pa.Array, learnt: Lexicon) -> np.ndarray:
    """(rows, features) of a text column, in the order of FEATURES."""
    text = tokens.Text.of(column)
    row, start, end, _ = tokens.spans(text)
    rows, data = text.rows, text.data
    out = np.zeros((rows, len(FEATURES)))
    if not len(start):
        return out
    insults, second = _lexicon_hashes(LEXICON), _lexicon_hashes(SECOND_PERSON)
    n = np.bincount(row, minlength=rows)
    plain_hash = _squeezed(_PLAIN[data], _LETTER[data] | _DIGIT[data], start, end)
    opened = _OPENED[data]
    last = end - 1  # marks at a word's end close a sentence and stand for no letter
    closing = np.zeros(len(data), bool)
    closing[last[data[last] == ord("!")]] = True
    opened_hash = _squeezed(opened, (_LETTER[opened]) & ~closing, start, end)
    plain = _member(plain_hash, insults)
    hidden = ~plain & _member(opened_hash, insults)
    spoken = _member(plain_hash, second)
    hits, persons = np.flatnonzero(plain | hidden), np.flatnonzero(spoken)
    near = np.zeros(len(hits), bool)
    if len(persons):
        after = np.searchsorted(persons, hits)
        for at in (np.maximum(after - 1, 0), np.minimum(after, len(persons) - 1)):
            near |= (np.abs(persons[at] - hits) <= _REACH) & (row[persons[at]] == row[hits])

    weight = learnt.weights(_keys(data, start, end))
    heaviest = np.zeros(rows)
    np.maximum.at(heaviest, row[weight > 0], weight[weight > 0])

    def inside(mask: np.ndarray) -> np.ndarray:
        upto = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
        return upto[end] - upto[start]

    def whole(mask: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])[text.offsets])

    letters, upper = inside(_LETTER[data]), inside(_UPPER[data])
    others = inside(_DIGIT[data] | _PUNCT[data]) - _PUNCT[data[last]] - (_PUNCT[data[start]] & (last > start))
    same = np.zeros(len(data), bool)
    if len(data) > 2:
        same[2:] = (_PLAIN[data[2:]] == _PLAIN[data[1:-1]]) & (_PLAIN[data[2:]] == _PLAIN[data[:-2]]) & _LETTER[data[2:]]
    mark = (data == 33) | (data == 63)
    doubled = np.zeros(len(data), bool)
    doubled[1:] = mark[1:] & mark[:-1]
    size = np.maximum(np.diff(text.offsets), 1)

    def share(flags: np.ndarray, owner: np.ndarray = row, of: np.ndarray | None = None) -> np.ndarray:
        return np.bincount(owner, flags, minlength=rows) / np.maximum(n if of is None else of, 1)

    columns = [
        share(plain), np.minimum(np.bincount(row, plain | hidden, minlength=rows), 3), share(hidden),
        share(near, row[hits]), share(weight > 0), np.minimum(np.bincount(row, weight > 0, minlength=rows), 5), heaviest,
        share(spoken), share((upper >= 2) & (upper == letters)),
        whole(_UPPER[data]) / np.maximum(whole(_LETTER[data]), 1), whole(_PUNCT[data]) / size, whole(mark) / size,
        whole(doubled) / size, share((letters > 0) & (others > 0)), share(inside(same) > 0), np.log1p(n),
    ]
    return np.stack(columns, 1)


def _extract(lexicon):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = dense_features(batch.column("text"), lexicon.value)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(found[:, k]) for k in range(len(FEATURES)))], ["doc_id", *FEATURES]
            )

    return run


def toxicity_scores(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str = "toxic",
    held_out: Column | None = None,
    threshold: float = 0.3,
    sample: int = 20000,
    lexicon_sample: int = 2000,
    trees: int = 15,
    depth: int = 3,
) -> DataFrame:
    """doc_id, held_out, score (0 to 1), predicted (score >= ``threshold``) for each document.

    ``held_out`` marks rows whose labels are never learnt from (by default crc32 of the id mod 4 is 2).
    """
    fold = crc_remainder(F.col("doc_id"), 4) == 2 if held_out is None else held_out
    rows = docs.select("doc_id", "text")
    labelled = labels.where(F.col(label_col).isNotNull() & F.col("doc_id").isNotNull() & ~fold).select(
        "doc_id", F.col(label_col).cast("double").alias("label")
    )
    lexicon = docs.sparkSession.sparkContext.broadcast(fit_lexicon(rows, labelled, lexicon_sample))
    table = stage(rows.mapInArrow(_extract(lexicon), "doc_id long, " + ", ".join(f"{x} double" for x in FEATURES)), "toxicity")
    chosen = labelled.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(sample)
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="features")
    train = stage(
        table.join(F.broadcast(chosen), "doc_id").select(
            "label", (F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(4)) == 0).alias("calibrates"), *FEATURES
        ),
        "toxicity-train",
    )
    seen = {(r["calibrates"], r["label"]): r["n"] for r in train.groupBy("calibrates", "label").agg(F.count("*").alias("n")).collect()}
    kinds = {label for _, label in seen}
    marked = table.withColumn("held_out", F.coalesce(fold, F.lit(False)))
    if len(kinds) < 2:
        total = sum(seen.values())
        share = sum(n for (_, label), n in seen.items() if label == 1) / total if total else 0.0
        scored = marked.select("doc_id", "held_out", F.lit(float(share)).alias("score"))
    else:
        split = all((part, label) in seen for part in (True, False) for label in kinds)
        rows = assembler.transform(train).select("label", "features", "calibrates").coalesce(4)
        model = GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=0.3, seed=11, maxBins=32).fit(
            rows.where("not calibrates") if split else rows
        )
        chance = vector_to_array(F.col("probability"))[1]
        kept_out = model.transform(rows.where("calibrates") if split else rows).select("label", chance.alias("raw"))
        curve = IsotonicRegression(featuresCol="raw", labelCol="label", predictionCol="score").fit(kept_out)
        raw = model.transform(assembler.transform(marked)).select("doc_id", "held_out", chance.alias("raw"))
        scored = curve.transform(raw)
    score = F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("score")))
    return scored.select("doc_id", "held_out", score.alias("score")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int")
    )


def reject_toxic(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows that ``toxicity_scores`` calls toxic; all columns stay. Rows that share an id go together."""
    bad = toxicity_scores(docs, labels, **options).where("predicted = 1").select(F.col("doc_id").alias("id"))
    return without_ids(docs, bad)
