"""Language-model scoring with Brown class-based n-grams.

A text's probability is the product over its tokens (words and one end) of P(class | class before) * P(token | class).
Classes come from exchange clustering, which moves words to the class that raises the class-bigram likelihood most:

1. The ``frequent`` most frequent words seed the classes. They are exchanged one after the other until a pass moves none
   (at most ``passes``), on their bigram counts, a table of fixed size.
2. Every other word seen ``least`` times or more is exchanged in ``rounds`` parallel rounds: a shuffle brings together how
   often each class stands before and after a word, and the word takes the class under which these counts are likeliest,
   all others staying where they are. The number of classes grows with the number of such words.

Rarer words and unseen ones belong to the class of their form, by their last two bytes. The classes of words are held in
a table by hash, with four places for each clustered word (2**24 places of a byte at most); words that meet in a place
are one unit for the clustering. Class transitions are smoothed by interpolation with the class frequencies. Within a
class, unseen words have the mass of the words seen once there (at least half a count), shared evenly by as many words
as Chao's estimate gives from the words seen once and twice; seen words share the rest by count.

What depends on the corpus grows with it and stays distributed: counts of all words are summed by a shuffle, and scoring
joins the words that are not in the head of the lexicon (``head`` most frequent words, sent around) with their counts.

Defined results: null, empty and blank texts score their end alone; without training rows all counts are 0; rows are
learnt from unless their fold is held out; repeated rows count and are scored each; words of equal count are ordered by
hash; a text of any length is one row of a batch; words compare by 64-bit hash; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirework.llm import tokens
from quirework.llm.shared import crc_remainder, release, slices, stage

FORMS = 61
_U = np.uint64
#: Hash of the end token: not the hash of any word, as words are not empty.
END = int(tokens.mix(np.array([0x5851F42D4C957F2D], np.uint64))[0])


@dataclass
class Head:
    """Some most frequent words, by hash: sorted hashes and their counts."""

    hash: np.ndarray
    count: np.ndarray

    @classmethod
    def of(cls, h: np.ndarray, count: np.ndarray) -> Head:
        order = np.argsort(h)
        return cls(h[order], count[order])

    def find(self, h: np.ndarray) -> np.ndarray:
        """Place in ``hash`` of each word, -1 if it is not there."""
        if not len(self.hash):
            return np.full(len(h), -1)
        place = np.minimum(np.searchsorted(self.hash, h), len(self.hash) - 1)
        return np.where(self.hash[place] == h, place, -1)


@dataclass
class Classes:
    """The class of every word: ``table`` has 1 + the class of each place, or 0 where words have the class of their form."""

    table: np.ndarray
    number: int

    @property
    def size(self) -> int:
        """All classes: the clustered ones, those of form and the end's."""
        return self.number + FORMS + 1

    def place(self, h: np.ndarray) -> np.ndarray:
        return (h >> _U(65 - len(self.table).bit_length())).astype(np.int64)

    def of(self, w: tokens.Words) -> np.ndarray:
        return self.of_hashes(w.hash, _form(w))

    def of_hashes(self, h: np.ndarray, form: np.ndarray) -> np.ndarray:
        held = self.table[self.place(h)].astype(np.int64)
        return np.where(held > 0, held - 1, self.number + form)


def _form(w: tokens.Words) -> np.ndarray:
    """Form class of each word: a hash of its last two bytes, A-Z lower-cased."""
    data = tokens._FOLD[w.text.data]
    last = data[w.end - 1].astype(np.uint64)
    before = np.where(w.end - w.start > 1, data[np.maximum(w.end - 2, 0)], 0).astype(np.uint64)
    return (tokens.mix(last * _U(257) + before) % _U(FORMS)).astype(np.int64)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, form, n) with one row a word for each slice; the end of each row is a word of its own."""
    rows = 0
    kind = np.dtype([("h", np.uint64), ("f", np.int16)])
    for batch in slices(batches):
        w = tokens.words(batch.column("text"))
        out = np.zeros(len(w.hash), kind)
        out["h"], out["f"] = w.hash, _form(w)
        order = np.argsort(w.hash, kind="stable")
        out = out[order]
        fresh = np.ones(len(out), bool)
        fresh[1:] = out["h"][1:] != out["h"][:-1]
        begin = np.flatnonzero(fresh)
        n = np.diff(np.append(begin, len(out)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(out["h"][begin].view(np.int64)), pa.array(out["f"][begin].astype(np.int32)), pa.array(n.astype(np.int64))], ["word", "form", "n"]
        )
        rows += batch.num_rows
    if rows:
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.array([END], np.uint64).view(np.int64)), pa.array([FORMS], pa.int32()), pa.array([rows], pa.int64())], ["word", "form", "n"]
        )


def _sequence(w: tokens.Words, ids: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, id before, id) of all tokens with each row's end; the first follows an end."""
    rows = w.text.rows
    at = np.arange(len(ids)) + w.row
    total = len(ids) + rows
    seq, row = np.full(total, end), np.zeros(total, np.int64)
    seq[at] = ids
    row[at] = w.row
    ends = w.first[1:] + np.arange(rows)
    row[ends] = np.arange(rows)
    before = np.concatenate([[end], seq[:-1]]) if total else seq
    return row, before, seq


def _summed(sent, kind, width):
    """(pair, n): how often each id follows each other one, before * width + id; ids by ``kind(model, words)``, the last is the end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        total = np.zeros(width * width, np.int64)
        for batch in slices(batches):
            w = tokens.words(batch.column("text"))
            _, before, now = _sequence(w, kind(known, w), width - 1)
            pair, n = np.unique(before * width + now, return_counts=True)
            total[pair] += n
        pair = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(pair.astype(np.int32)), pa.array(total[pair])], ["pair", "n"])

    return run


def _bigrams(rows: DataFrame, sent, kind, width: int) -> np.ndarray:
    """The counts of ``_summed`` as a matrix; width * width rows at most come to the driver."""
    held = rows.mapInArrow(_summed(sent, kind, width), "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(width * width)
    out[held.column("pair").to_numpy()] = held.column("n").to_numpy()
    return out.reshape(width, width)


def _rank_or_form(seeds: Head, w: tokens.Words) -> np.ndarray:
    place = seeds.find(w.hash)
    return np.where(place >= 0, place, len(seeds.hash) + _form(w))


def _neighbours(sent, clustered):
    """(place, slot, n): how often the units of ``clustered`` places stand before (slot: the class after) and after each
    class (slot: size + the class before)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, wanted = sent.value, clustered.value
        size = classes.size
        for batch in slices(batches, limit=4 << 20):
            w = tokens.words(batch.column("text"))
            ids = classes.of(w)
            at = np.arange(len(ids)) + w.row
            _, before, now = _sequence(w, ids, size - 1)
            place = classes.place(w.hash)
            mine = np.flatnonzero(wanted[place])
            after = now[at[mine] + 1]
            key = np.concatenate([place[mine] * (2 * size) + after, place[mine] * (2 * size) + size + before[at[mine]]])
            key, n = np.unique(key, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array((key // (2 * size)).astype(np.int32)), pa.array((key % (2 * size)).astype(np.int16)), pa.array(n.astype(np.int32))], ["place", "slot", "n"]
            )

    return run


def _likeliest(weights):
    """(place, class) from rows (place, slot, n) sorted by place: the class with the highest sum of n * weight of the slot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = weights.value
        last, held = -1, None

        def best(places: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(places.astype(np.int32)), pa.array(sums.argmax(1).astype(np.int32))], ["place", "class"])

        for batch in batches:
            if not batch.num_rows:
                continue
            place = batch.column("place").to_numpy()
            part = table[batch.column("slot").to_numpy()] * batch.column("n").to_numpy()[:, None]
            begin = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
            places, sums = place[begin], np.add.reduceat(part, begin, axis=0)
            if last == places[0]:
                sums[0] += held
            elif held is not None:
                yield best(np.array([last]), held[None])
            yield best(places[:-1], sums[:-1])
            last, held = places[-1], sums[-1].copy()
        if held is not None:
            yield best(np.array([last]), held[None])

    return run


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def exchange(pairs: np.ndarray, frequent: int, classes: int, passes: int = 6) -> np.ndarray:
    """Class of each id: exchange clustering of the first ``frequent`` ids; the others keep a class of their own.

    ``pairs``: counts of id bigrams. The likelihood is sum N(c,d) log N(c,d) - sum N(c.) log N(c.) - sum N(.d) log N(.d).
    """
    width = len(pairs)
    group = np.concatenate([np.arange(frequent) % classes, classes + np.arange(width - frequent)])
    size = classes + width - frequent
    one = np.zeros((width, size))
    one[np.arange(width), group] = 1
    right, left = pairs @ one, pairs.T @ one  # by class after, by class before
    table = one.T @ right
    self_count = np.diag(pairs).copy()
    used = [w for w in range(frequent) if pairs[w].any() or pairs[:, w].any()]
    for _ in range(passes):
        moved = 0
        for w in used:
            a = group[w]
            r, l, s = right[w].copy(), left[w].copy(), self_count[w]
            r[a] -= s
            l[a] -= s
            table[a] -= right[w]
            table[:, a] -= left[w]
            table[a, a] += s
            out, into = table.sum(1) + l, table.sum(0) + r  # as neighbours of w, wherever it goes
            n_out, n_in = r.sum() + s, l.sum() + s
            row = _xlogx(table[:classes] + r) - _xlogx(table[:classes])
            col = _xlogx(table[:, :classes].T + l) - _xlogx(table[:, :classes].T)
            both = np.arange(classes)
            cell = table[both, both]
            gain = row.sum(1) + col.sum(1) - row[both, both] - col[both, both]
            gain += _xlogx(cell + r[both] + l[both] + s) - _xlogx(cell)
            gain -= _xlogx(out[:classes] + n_out) - _xlogx(out[:classes]) + _xlogx(into[:classes] + n_in) - _xlogx(into[:classes])
            b = int(np.argmax(gain))
            if gain[b] <= gain[a] + 1e-9:
                b = a
            table[b] += r
            table[:, b] += l
            table[b, b] += s
            if b != a:
                moved += 1
                group[w] = b
                # w now stands in another class for all its neighbours
                right[:, a] -= pairs[:, w]
                right[:, b] += pairs[:, w]
                left[:, a] -= pairs[w]
                left[:, b] += pairs[w]
        if not moved:
            break
    return group


def _steps(table: np.ndarray) -> np.ndarray:
    """P(class | class before), interpolated with the class frequencies."""
    n = table.sum(0)
    spread = (table > 0).sum(1) + 1.0
    prior = (n + 0.5) / (n.sum() + 0.5 * len(table))
    return (table + spread[:, None] * prior[None, :]) / (table.sum(1) + spread)[:, None]


@dataclass
class Model:
    head: Head
    classes: Classes
    step: np.ndarray  # log10 P(class | class before)
    seen: np.ndarray  # by class: what log10 of a seen word's count is raised by
    unseen: np.ndarray  # by class: log10 of what an unseen word has
    total: int  # N
    distinct: int  # V

    @property
    def base_scale(self) -> float:
        return float(np.log10(self.total + 0.5 * (self.distinct + 1)))


def _of_classes(sent):
    """(class, once, twice): words seen once and twice, of some counted words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = sent.value
        for batch in batches:
            h, c = batch.column("word").to_numpy().view(np.uint64), batch.column("c").to_numpy()
            of = classes.of_hashes(h, batch.column("form").to_numpy())
            once, twice = (np.bincount(of[c == k], minlength=classes.size) for k in (1, 2))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(classes.size, dtype=np.int32)), pa.array(once), pa.array(twice)], ["class", "once", "twice"])

    return run


def cluster(rows: DataFrame, counts: DataFrame, frequent: int, classes: int | None, least: int, rounds: int) -> tuple[Classes, np.ndarray]:
    """The classes of all words, and their bigram counts."""
    spark = rows.sparkSession
    words = counts.where(F.col("form") < FORMS)
    enough = words.where(F.col("c") >= least)
    several = enough.count()
    number = classes or min(160, max(16, round(several ** (1 / 3))))
    bits = min(24, max(10, (4 * several).bit_length()))
    found = Classes(np.zeros(1 << bits, np.uint8), number)
    top = words.orderBy(F.desc("c"), "word").limit(frequent).toArrow()
    seeds = Head.of(top.column("word").to_numpy().view(np.uint64), top.column("c").to_numpy())
    width = len(seeds.hash) + FORMS + 1
    pairs = _bigrams(rows, spark.sparkContext.broadcast(seeds), _rank_or_form, width)
    # exchange() takes the most frequent first, so ids are put in that order and back
    order = np.concatenate([np.argsort(-seeds.count, kind="stable"), np.arange(len(seeds.hash), width)])
    group = np.empty(width, np.int64)
    group[order] = exchange(pairs[np.ix_(order, order)], len(seeds.hash), number)
    one = np.zeros((width, found.size))
    one[np.arange(width), group] = 1
    table = one.T @ pairs @ one
    fixed = order[: len(seeds.hash)][::-1]  # the more frequent seed has a place that two meet in
    found.table[found.place(seeds.hash[fixed])] = group[fixed] + 1
    seeded = found.table.copy()
    held = np.zeros(1 << bits, bool)
    place = F.shiftrightunsigned("word", 64 - bits).cast("int")
    held[enough.select(place.alias("at")).distinct().toArrow().column("at").to_numpy()] = True  # 2**bits rows at most
    wanted = spark.sparkContext.broadcast(held & (seeded == 0))
    for _ in range(rounds):
        step, n = np.log(_steps(table)), np.log(table.sum(0) + 1)
        # as the class before b stands step[b, c], as the class after c: step[c, b], and the word's share of b is 1 / n
        weights = np.concatenate([step[:number].T, step[:, :number] - n[None, :number]]).astype(np.float32)
        sent = spark.sparkContext.broadcast(found)
        met = rows.mapInArrow(_neighbours(sent, wanted), "place int, slot short, n int")
        moved = met.repartition("place").sortWithinPartitions("place").mapInArrow(_likeliest(spark.sparkContext.broadcast(weights)), "place int, class int")
        moved = stage(moved, "classes")
        best = moved.toArrow()  # 2**bits rows at most
        found = Classes(seeded.copy(), number)
        found.table[best.column("place").to_numpy()] = best.column("class").to_numpy() + 1
        release(moved)
        table = _bigrams(rows, spark.sparkContext.broadcast(found), Classes.of, found.size)
    return found, table


def fit(rows: DataFrame, counts: DataFrame, head: int, frequent: int, classes: int | None, least: int, rounds: int) -> Model:
    """``rows``: training texts; ``counts``: word, form, c over them."""
    spark = rows.sparkSession
    totals = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    found, table = cluster(rows, counts, frequent, classes, least, rounds)
    top = counts.where(F.col("form") < FORMS).orderBy(F.desc("c"), "word").limit(head).toArrow()
    lexicon = Head.of(top.column("word").to_numpy().view(np.uint64), top.column("c").to_numpy())
    rare = counts.where((F.col("form") < FORMS) & (F.col("c") <= 2)).mapInArrow(_of_classes(spark.sparkContext.broadcast(found)), "class int, once long, twice long")
    rare = rare.groupBy("class").agg(F.sum("once").alias("once"), F.sum("twice").alias("twice")).toArrow()
    once, twice = np.zeros(found.size), np.zeros(found.size)
    once[rare.column("class").to_numpy()] = rare.column("once").to_numpy()
    twice[rare.column("class").to_numpy()] = rare.column("twice").to_numpy()
    n = table.sum(0)
    mass = np.where(n > 0, np.clip(np.maximum(once, 0.5) / np.maximum(n, 1), 0, 0.9), 1.0)
    kinds = np.maximum(1.0, once * (once - 1) / (2 * (twice + 1)))
    seen = np.log10(np.maximum(1 - mass, 1e-12)) - np.log10(np.maximum(n, 1))
    return Model(lexicon, found, np.log10(_steps(table)), seen, np.log10(mass / kinds), int(totals[0]), int(totals[1]))


def _score(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for batch in slices(batches):
            w = tokens.words(batch.column("text"))
            rows = batch.num_rows
            ids, place = m.classes.of(w), m.head.find(w.hash)
            row, before, now = _sequence(w, ids, m.classes.size - 1)
            score = _by_row(row, m.step[before, now], rows)
            known = place >= 0
            count = m.head.count[place[known]] if known.any() else np.zeros(0)
            base = _by_row(w.row[known], np.log10(count + 0.5), rows)
            score += _by_row(w.row[known], np.log10(count) + m.seen[ids[known]], rows)
            tail = np.flatnonzero(~known)
            key = np.zeros(len(tail), np.dtype([("r", np.int32), ("h", np.uint64), ("f", np.int16)]))
            key["r"], key["h"], key["f"] = w.row[tail], w.hash[tail], ids[tail]
            order = np.lexsort((key["h"], key["r"]))
            key = key[order]
            fresh = np.ones(len(key), bool)
            fresh[1:] = (key["h"][1:] != key["h"][:-1]) | (key["r"][1:] != key["r"][:-1])
            begin = np.flatnonzero(fresh)
            n = np.diff(np.append(begin, len(key)))
            offsets = pa.array(np.searchsorted(key["r"][begin], np.arange(rows + 1)).astype(np.int32))
            entry = pa.StructArray.from_arrays(
                [pa.array(key["h"][begin].view(np.int64)), pa.array(key["f"][begin].astype(np.int32)), pa.array(n.astype(np.int32))], ["word", "class", "n"]
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("held_out"),
                    pa.array((w.counts + 1).astype(np.int64)),
                    pa.array(np.bincount(w.row[known], minlength=rows).astype(np.int64)),
                    pa.array(base),
                    pa.array(score),
                    pa.ListArray.from_arrays(offsets, entry),
                ],
                ["doc_id", "held_out", "n_tokens", "n_known", "base", "score", "tail"],
            )

    return run


def _by_row(row: np.ndarray, value: np.ndarray, rows: int) -> np.ndarray:
    """Sums by row, as floats even where there is nothing to sum."""
    return np.bincount(row, value, minlength=rows).astype(float)


def class_scores(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    held_out: Column | None = None,
    head: int = 1 << 18,
    frequent: int = 1 << 11,
    classes: int | None = None,
    least: int = 3,
    rounds: int = 1,
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score for each document."""
    spark = docs.sparkSession
    fold = crc_remainder(F.col(id_col), 5) == 1 if held_out is None else held_out
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(fold, F.lit(False)).alias("held_out"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    train = rows.where("not held_out").select("text")
    counts = stage(
        train.mapInArrow(_count_words, "word long, form int, n long").groupBy("word", "form").agg(F.sum("n").alias("c")), "counts"
    )
    model = fit(train, counts, head, frequent, classes, least, rounds)
    end_count = counts.where(F.col("form") == FORMS).agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0]
    parts = stage(
        rows.mapInArrow(
            _score(spark.sparkContext.broadcast(model)),
            "doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double, tail array<struct<word:long,class:int,n:int>>",
        ).withColumn("at_row", F.monotonically_increasing_id()),
        "scores",
    )
    shares = spark.createDataFrame([(k, float(m), float(u)) for k, (m, u) in enumerate(zip(model.seen, model.unseen))], "class int, scale double, unseen double")
    tail = parts.select("at_row", F.explode("tail").alias("t")).select("at_row", "t.*")
    met = tail.join(counts.select("word", "c"), "word", "left").join(F.broadcast(shares), "class")  # 222 rows at most
    seen = F.col("c").isNotNull()
    sums = met.groupBy("at_row").agg(
        F.sum(F.when(seen, F.col("n")).otherwise(0)).alias("known"),
        F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("base"),
        F.sum(F.col("n") * F.when(seen, F.log10("c") + F.col("scale")).otherwise(F.col("unseen"))).alias("score"),
    )
    zero = F.lit(0.0)
    end_known = 1 if end_count else 0
    return (
        parts.drop("tail")
        .alias("p")
        .join(sums.alias("s"), "at_row", "left")
        .select(
            "p.doc_id",
            "p.held_out",
            "p.n_tokens",
            (F.col("p.n_known") + F.coalesce("s.known", F.lit(0)) + end_known).cast("long").alias("n_known"),
            F.lit(model.total).cast("long").alias("train_tokens"),
            (F.col("p.base") + F.coalesce("s.base", zero) + float(np.log10(end_count + 0.5)) - F.col("p.n_tokens") * model.base_scale).alias("base_score"),
            (F.col("p.score") + F.coalesce("s.score", zero)).alias("score"),
        )
    )
