"""Quality rules: counts of a text, and a hashed n-gram logistic regression with calibrated probabilities.

The model reads word n-grams (one and two words) and character n-grams (three code points), hashed to a fixed number of
places and weighed by their share of the text. It is fitted on a bounded sample of labelled rows (``sample`` rows, those
with the smallest hash of their id), calibrated by Platt scaling on a fold of that sample kept out of the fit, and
applied to all whole texts in Arrow batches. A text is kept when its probability of being good reaches ``threshold``.

Defined results: null texts have no words; rows with labels but no document, or null labels, are not learnt from;
with fewer than two classes of label every text gets the share of good labels (1.0 without labels); repeated ids are
scored row by row; empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirework.llm import tokens
from quirework.llm.shared import slices

#: Characters that count as symbols, and limits of the base rules: fixed values.
SYMBOLS = "#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 10, 20, 5

_BITS = 17
_DIMS = 3 << _BITS
_U = np.uint64


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def probability(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -40, 40)))


def _per_row(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])[offsets])


def repeated_words(w: tokens.Words, size: int = WINDOW) -> np.ndarray:
    """For each row, how many words lie in a window of ``size`` words that the row holds twice or more."""
    total = len(w.hash) - size + 1
    if total <= 0:
        return np.zeros(w.text.rows, np.int64)
    rolled = w.row[:total].astype(np.uint64)
    for k in range(size):
        rolled = rolled * _U(0x9E3779B97F4A7C15) + w.hash[k : k + total]
        rolled ^= rolled >> _U(29)
    at = np.flatnonzero(w.row[:total] == w.row[size - 1 :])
    key = tokens.mix(rolled[at])
    ordered = np.sort(key)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return np.zeros(w.text.rows, np.int64)
    place = np.minimum(np.searchsorted(twice, key), len(twice) - 1)
    found = at[twice[place] == key]
    edge = np.zeros(len(w.hash) + 1, np.int64)
    np.add.at(edge, found, 1)
    np.add.at(edge, found + size, -1)
    return np.bincount(w.row[np.cumsum(edge[:-1]) > 0], minlength=w.text.rows)


def duplicate_lines(w: tokens.Words) -> np.ndarray:
    """For each row, the lines with a word that equal an earlier line."""
    text = w.text
    ends = np.flatnonzero(text.data == 10)
    begin = np.unique(np.concatenate([text.offsets[:-1], ends + 1]))
    begin = begin[begin < len(text.data)]
    row = np.searchsorted(text.offsets, begin, side="right") - 1
    stop = np.minimum(np.append(ends, len(text.data))[np.searchsorted(ends, begin)], text.offsets[row + 1])
    used = np.searchsorted(w.start, stop) > np.searchsorted(w.start, begin)
    begin, stop, row = begin[used], stop[used], row[used]
    key = tokens.hashed(text.data, begin, stop)
    order = np.lexsort((key, row))
    same = (key[order][1:] == key[order][:-1]) & (row[order][1:] == row[order][:-1])
    return np.bincount(row[order][1:][same], minlength=text.rows)


def _hashed_features(w: tokens.Words) -> list[tuple[np.ndarray, np.ndarray]]:
    """(place, row) of every n-gram, for one word, two words and three characters."""
    shift = _U(64 - _BITS)
    pair, pair_row = tokens.shingles(w, 2)
    char, char_row = tokens.characters(w.text)
    factor = np.uint32(0x9E3779B1)
    three = (char[:-2] * factor + char[1:-1]) * factor + char[2:]
    inside = char_row[: len(three)] == char_row[2:]
    chars = (three[inside] * factor) >> np.uint32(32 - _BITS)
    return [
        ((w.hash >> shift).astype(np.int64), w.row),
        ((pair >> shift).astype(np.int64) + (1 << _BITS), pair_row),
        (chars.astype(np.int64) + (2 << _BITS), char_row[: len(three)][inside]),
    ]


def _margins(w: tokens.Words, model: Model) -> np.ndarray:
    total = np.full(w.text.rows, model.bias)
    for place, row in _hashed_features(w):
        n = np.bincount(row, minlength=w.text.rows)
        total += np.bincount(row, model.weights[place], minlength=w.text.rows) / np.maximum(n, 1)
    return total


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        w = tokens.words(batch.column("text"), fold=False)
        keys, values = [], []
        for place, row in _hashed_features(w):
            key, n = np.unique(row.astype(np.int64) * _DIMS + place, return_counts=True)
            keys.append(key)
            values.append(n / np.maximum(np.bincount(row, minlength=batch.num_rows), 1)[key // _DIMS])
        key, value = np.concatenate(keys), np.concatenate(values)
        order = np.argsort(key, kind="stable")
        row, place = key[order] // _DIMS, (key[order] % _DIMS).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("good"),
                batch.column("fold"),
                tokens.lists(place, row, batch.num_rows, pa.int32()),
                tokens.lists(value[order].astype(np.float32), row, batch.num_rows, pa.float32()),
            ],
            ["good", "fold", "place", "share"],
        )


def _fit(rows: list, epochs: int = 15, batch: int = 32, rate: float = 0.5) -> Model:
    """Adagrad on mini-batches of one part of the sample, then Platt scaling on the other."""
    rng = np.random.default_rng(7)
    good = np.array([r[0] for r in rows], float)
    known = good.mean() if len(good) else 1.0
    if not len(rows) or len(set(good)) < 2:
        prior = min(max(known, 1e-6), 1 - 1e-6)
        return Model(np.zeros(_DIMS), 0.0, 0.0, float(np.log(prior / (1 - prior))))
    fold = np.array([r[1] for r in rows])
    parts = [np.flatnonzero(fold != 0), np.flatnonzero(fold == 0)]
    if any(len(set(good[p])) < 2 for p in parts):
        parts = [np.arange(len(rows))] * 2
    weight = np.where(good == 1, 0.5 / known, 0.5 / (1 - known))
    w, bias, seen, seen_bias = np.zeros(_DIMS), 0.0, np.full(_DIMS, 1e-8), 1e-8

    def margins(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        place = np.concatenate([rows[i][2] for i in ids])
        share = np.concatenate([rows[i][3] for i in ids])
        owner = np.repeat(np.arange(len(ids)), [len(rows[i][2]) for i in ids])
        return np.bincount(owner, w[place] * share, minlength=len(ids)) + bias, place, share, owner

    for _ in range(epochs):
        for ids in np.array_split(rng.permutation(parts[0]), max(1, len(parts[0]) // batch)):
            z, place, share, owner = margins(ids)
            slope = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - good[ids]) * weight[ids]
            at, back = np.unique(place, return_inverse=True)
            step = np.bincount(back, slope[owner] * share) / len(ids)
            seen[at] += step**2
            w[at] -= rate * step / np.sqrt(seen[at])
            seen_bias += slope.mean() ** 2
            bias -= rate * slope.mean() / np.sqrt(seen_bias)
    z = np.concatenate([margins(ids)[0] for ids in np.array_split(parts[1], max(1, len(parts[1]) // 256))])
    y = good[parts[1]]
    # Platt targets keep the scale finite when the folds separate
    goal = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / (len(y) - y.sum() + 2))
    x = np.stack([z, np.ones(len(z))], 1)
    scale = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ scale, -40, 40)))
        curve = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        move = np.linalg.solve(curve, x.T @ (p - goal))
        scale -= np.clip(move, -2, 2)
        if np.abs(move).max() < 1e-8:
            break
    return Model(w, bias, float(scale[0]), float(scale[1]))


def fit_quality_model(docs: DataFrame, labels: DataFrame, label_col: str = "quality", sample: int = 4000) -> Model:
    """Fit on at most ``sample`` labelled rows: the bound on what reaches the driver."""
    chosen = (
        labels.where(F.col(label_col).isNotNull() & F.col("doc_id").isNotNull())
        .select(F.col("doc_id").alias("_id"), F.col(label_col).cast("double").alias("good"))
        .orderBy(F.xxhash64("_id"), "_id", "good")
        .limit(sample)
    )
    rows = (
        docs.join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))
        .select("good", (F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(4))).alias("fold"), "text")
        .mapInArrow(_features, "good double, fold long, place array<int>, share array<float>")
    )
    held = rows.toArrow()
    out = []
    for batch in held.to_batches():
        place, share = batch.column("place"), batch.column("share")
        for i in range(batch.num_rows):
            out.append(
                (
                    batch.column("good")[i].as_py(),
                    batch.column("fold")[i].as_py(),
                    place[i].values.to_numpy(),
                    share[i].values.to_numpy(),
                )
            )
    out.sort(key=lambda r: (r[1], r[0], len(r[2]), r[2].tobytes()))
    return _fit(out)


def _score(model, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = model.value
        symbol = np.zeros(256, bool)
        symbol[[ord(c) for c in SYMBOLS]] = True
        for batch in slices(batches):
            w = tokens.words(batch.column("text"), fold=False)
            text, n = w.text, w.counts
            inside = np.zeros(len(text.data) + 1, np.int8)
            inside[w.start] += 1
            inside[w.end] -= 1
            chars = _per_row((np.cumsum(inside[:-1], dtype=np.int8) > 0) & ((text.data & 0xC0) != 0x80), text.offsets)
            repeat = repeated_words(w)
            failed = (n < MIN_WORDS) | (100 * repeat > MAX_REPEAT_PERCENT * n)
            chance = held.probability(_margins(w, held))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id")]
                + [pa.array(x) for x in (n, chars, _per_row(symbol[text.data], text.offsets), duplicate_lines(w), repeat)]
                + [pa.array(failed), pa.array(~failed & (chance >= threshold)), pa.array(chance)],
                ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "probability"],
            )

    return run


def quality_rules(docs: DataFrame, labels: DataFrame, sample: int = 4000, threshold: float = 0.5) -> DataFrame:
    """One row per document with its counts, the base rules' verdict, the model's probability and ``kept``."""
    rows = docs.select("doc_id", "text")
    model = docs.sparkSession.sparkContext.broadcast(fit_quality_model(rows, labels, sample=sample))
    return rows.mapInArrow(
        _score(model, threshold),
        "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "base_failed boolean, kept boolean, probability double",
    )
