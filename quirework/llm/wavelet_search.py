"""Ranked lexical search over dual-sorted wavelet trees, one for each shard of documents.

A shard is a run of documents that one task reads, about ``shard_bytes`` of text. Its index holds, for each term, the
postings in order of falling impact; the documents of all postings, one after the other, are one sequence, kept as a
wavelet tree over document places (places are in order of id). So the same postings are sorted by impact within each
tree node and can be navigated by document:

* A node stands for a range of documents. Each term's postings in the range are an interval of the node's sequence, and
  two ranks give the interval in each child.
* The parts keep their order, so the first posting of an interval has the term's largest impact in the range. Summed over
  a query's terms, first postings bound the score of every document below the node; in a leaf the sum is the score.
* Search expands the nodes of the largest bounds first and stops when no bound reaches the k-th best score. A task goes
  on with the best of its former shards, so most later shards end near their roots.

The steps: a scan counts documents and terms (N and L, which impacts need); a second one writes the index; the index
gives the number of documents that hold each query term; queries run in blocks of ``block_terms`` terms against all
shards, and the best of all tasks are merged. A term's weight is floor(1000 * ln((2N + 2) / (2 df + 1))); a document of
n terms has m = 25 + (75 n N) div L; its score sums weight * ((10**9 tf) div (1000 tf + 8 m)) over the query's terms.

Terms are runs of ASCII letters, digits and all characters from U+0080 on, A-Z lower-cased, held as 64-bit hashes.

Defined results: null and empty texts, and those without terms, are never found and don't count in N; null and empty
queries find nothing; repeated rows are documents (or queries) of their own; equal scores go by ascending id, a null id
last; a text of any length is one document (a shard has one document at least); empty tables give an empty result;
columns of the inputs besides id and text are ignored.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quirework.llm import tokens
from quirework.llm.shared import release, slices, stage

#: Documents of a shard: places are 16-bit numbers.
_MOST = 1 << 16
#: Nodes that one step of a search expands together.
_STEP = 192
_INDEX = "ids binary, unnamed binary, lengths binary, terms binary, ends binary, tf binary, bits binary"
_NO_ID = np.iinfo(np.int64).max


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents that have a term, and terms of all."""
    for batch in slices(batches):
        text = tokens.Text.of(batch.column("text"))
        row = tokens.spans(text, tokens.PUNCTUATION)[0]
        held = int((np.bincount(row, minlength=text.rows) > 0).sum())
        yield pa.RecordBatch.from_pydict({"n": pa.array([held], pa.int64()), "l": pa.array([len(row)], pa.int64())})


def _counted(text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(terms of each row, row, term, occurrences), ascending by row and term."""
    w = tokens.words(text, separators=tokens.PUNCTUATION)
    order = np.lexsort((w.hash, w.row))
    h, r = w.hash[order], w.row[order]
    fresh = np.ones(len(h), bool)
    fresh[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
    at = np.flatnonzero(fresh)
    return w.counts, r[at], h[at], np.diff(np.append(at, len(h)))


def impacts(tf: np.ndarray, length: np.ndarray, n: int, total: int) -> np.ndarray:
    """(10**9 tf) div (1000 tf + 8 m) in documents of ``length`` terms, of ``n`` documents with ``total`` terms."""
    return 1_000_000_000 * tf // (1000 * tf + 8 * (25 + 75 * length * n // total))


def build(ids: np.ndarray, unnamed: np.ndarray, lengths: np.ndarray, row: np.ndarray, term: np.ndarray, tf: np.ndarray, n: int, total: int) -> dict:
    """The index of one shard: places by id, terms with the ends of their lists, occurrences, bits of each level."""
    by_id = np.lexsort((ids, unnamed))
    place = np.empty(len(ids), np.int64)
    place[by_id] = np.arange(len(ids))
    doc = place[row]
    order = np.lexsort((doc, -impacts(tf, lengths[row], n, total), term))
    term, tf, doc = term[order], tf[order], doc[order].astype(np.uint16)
    last = np.append(np.flatnonzero(term[1:] != term[:-1]), len(term) - 1)
    height = max(1, (len(ids) - 1).bit_length())
    bits = []
    for down in range(height, 0, -1):
        there = doc[np.argsort(doc >> down, kind="stable")] if down < 16 else doc
        bits.append(np.packbits(there >> (down - 1) & 1))
    return {
        "ids": ids[by_id],
        "unnamed": unnamed[by_id],
        "lengths": lengths[by_id].astype(np.int64),
        "terms": term[last],
        "ends": last + 1,
        "tf": tf.astype(np.int32),
        "bits": np.concatenate(bits),
    }


def _index(n: int, total: int, shard_bytes: int):
    def shard(held: list) -> pa.RecordBatch:
        first = np.cumsum([0, *(len(h[0]) for h in held)])
        ids, unnamed, lengths, term, tf = (np.concatenate([h[k] for h in held]) for k in (0, 1, 2, 4, 5))
        row = np.concatenate([h[3] + begin for h, begin in zip(held, first)])
        made = build(ids, unnamed, lengths, row, term, tf, n, total)
        return pa.RecordBatch.from_pydict({name: pa.array([x.tobytes()], pa.binary()) for name, x in made.items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, rows = [], 0, 0
        for batch in slices(batches):
            for part in (batch.slice(k, _MOST) for k in range(0, batch.num_rows, _MOST)):
                lengths, row, term, tf = _counted(part.column("text"))
                some = np.flatnonzero(lengths)
                if held and (rows + len(some) > _MOST or size >= shard_bytes):
                    yield shard(held)
                    held, size, rows = [], 0, 0
                if len(some):
                    anew = np.cumsum(lengths > 0) - 1
                    named = part.column("doc_id").take(pa.array(some))
                    ids, unnamed = named.fill_null(_NO_ID).to_numpy(), named.is_null().to_numpy(zero_copy_only=False)
                    held.append((ids, unnamed, lengths[some], anew[row], term, tf))
                    rows += len(some)
                    size += part.column("text").nbytes
        if held:
            yield shard(held)

    return run


@dataclass(frozen=True)
class Best:
    """Documents by falling score, equal scores by ascending id, those without an id last."""

    score: np.ndarray
    id: np.ndarray
    unnamed: np.ndarray

    @classmethod
    def none(cls) -> Best:
        return cls(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool))

    def with_more(self, score: np.ndarray, ids: np.ndarray, unnamed: np.ndarray, k: int) -> Best:
        score, ids, unnamed = (np.concatenate(x) for x in ((self.score, score), (self.id, ids), (self.unnamed, unnamed)))
        top = np.lexsort((ids, unnamed, -score))[:k]
        return Best(score[top], ids[top], unnamed[top])


class Shard:
    """One shard's tree in memory: at each level the zeros before each posting, and the impacts in its order."""

    def __init__(self, made: dict, n: int, total: int):
        self.terms = np.frombuffer(made["terms"], np.uint64)
        self.ends = np.concatenate([[0], np.frombuffer(made["ends"], np.int64)])
        self.unnamed = np.frombuffer(made["unnamed"], bool)
        tf, lengths = np.frombuffer(made["tf"], np.int32).astype(np.int64), np.frombuffer(made["lengths"], np.int64)
        size, docs = len(tf), len(lengths)
        self.height = max(1, (docs - 1).bit_length())
        bits = np.frombuffer(made["bits"], np.uint8).reshape(self.height, -1)
        self.zeros = np.zeros((self.height, size + 1), np.int32)
        self.impact = np.zeros((self.height + 1, size + 1), np.int32)
        doc, orders = np.zeros(size, np.uint16), []
        for level in range(self.height):
            bit = np.unpackbits(bits[level], count=size)
            np.cumsum(bit == 0, out=self.zeros[level, 1:])
            orders.append(np.argsort(doc, kind="stable").astype(np.int32))
            doc[orders[-1]] = doc[orders[-1]] << 1 | bit
        orders.append(np.argsort(doc, kind="stable"))
        impact = impacts(tf, lengths[doc], n, total).astype(np.int32)
        for level, order in enumerate(orders):
            self.impact[level, :-1] = impact[order]
        #: Postings of all documents before each place, and the id at each.
        self.before = np.searchsorted(doc[orders[-1]], np.arange((1 << self.height) + 1)).astype(np.int64)
        self.ids = np.full(1 << self.height, _NO_ID)
        self.ids[:docs] = np.frombuffer(made["ids"], np.int64)

    def best(self, terms: np.ndarray, weights: np.ndarray, k: int, held: Best) -> Best:
        """The k best of ``held`` and this shard's documents."""
        at = np.searchsorted(self.terms, terms)
        there = np.flatnonzero(self.terms[np.minimum(at, len(self.terms) - 1)] == terms)
        if not len(there):
            return held
        weights, at = weights[there], at[there]
        level, node = np.zeros(1, np.int64), np.zeros(1, np.int64)
        begin, end = self.ends[at][None, :], self.ends[at + 1][None, :]
        bound = (weights * self.impact[0, begin]).sum(1)
        while True:
            live = bound > 0
            if len(held.score) == k:  # of equal scores only smaller ids can still come in
                smallest = self.ids[node << (self.height - level)]
                live = (bound > held.score[-1]) | (bound == held.score[-1]) & (smallest <= held.id[-1])
            if not live.all():
                level, node, begin, end, bound = level[live], node[live], begin[live], end[live], bound[live]
            if not len(node):
                return held
            now, later = np.arange(len(node)), np.zeros(0, np.int64)
            if len(node) > _STEP:
                now, later = np.split(np.argpartition(-bound, _STEP), [_STEP])
            depth, here, s, e = level[now], node[now], begin[now], end[now]
            down = self.height - depth
            base, right = self.before[here << down], self.before[(2 * here + 1) << (down - 1)]
            s0, e0, b0 = (self.zeros[depth[:, None], x] for x in (s, e, base[:, None]))
            # left: zeros since the node's begin; right: ones since it
            child_s = np.concatenate([base[:, None] + s0 - b0, right[:, None] + (s - s0) - (base[:, None] - b0)])
            child_e = np.concatenate([base[:, None] + e0 - b0, right[:, None] + (e - e0) - (base[:, None] - b0)])
            child_level, child = np.concatenate([depth + 1] * 2), np.concatenate([2 * here, 2 * here + 1])
            child_bound = (np.where(child_s < child_e, self.impact[child_level[:, None], child_s], 0) * weights).sum(1)
            leaf = (child_level == self.height) & (child_bound > 0)
            if leaf.any():
                held = held.with_more(child_bound[leaf], self.ids[child[leaf]], self.unnamed[child[leaf]], k)
            grown = np.flatnonzero((child_level < self.height) & (child_bound > 0))
            level, node, bound = (np.concatenate([x[later], y[grown]]) for x, y in ((level, child_level), (node, child), (bound, child_bound)))
            begin, end = np.concatenate([begin[later], child_s[grown]]), np.concatenate([end[later], child_e[grown]])


def _queries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct terms of each query with their occurrences."""
    for batch in slices(batches):
        _, row, term, times = _counted(batch.column("text"))
        of = [tokens.lists(x, row, batch.num_rows, pa.int64()) for x in (term.view(np.int64), times.astype(np.int64))]
        yield pa.RecordBatch.from_arrays([batch.column("query"), *of], names=["query", "terms", "times"])


def _frequencies(wanted):
    """How many of a shard's documents hold each wanted term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(wanted.value), np.int64)
        for batch in batches:
            for k in range(batch.num_rows):
                terms = np.frombuffer(batch.column("terms")[k].as_buffer(), np.uint64)
                count = np.diff(np.frombuffer(batch.column("ends")[k].as_buffer(), np.int64), prepend=0)
                at = np.minimum(np.searchsorted(terms, wanted.value), len(terms) - 1)
                total += np.where(terms[at] == wanted.value, count[at], 0)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"term": pa.array(wanted.value[some].view(np.int64)), "df": pa.array(total[some])})

    return run


def _search(asked, k: int, n: int, total: int):
    """Each query's best documents in all shards of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [Best.none() for _ in asked.value]
        for batch in batches:
            for i in range(batch.num_rows):
                shard = Shard({name: batch.column(name)[i].as_buffer() for name in batch.schema.names}, n, total)
                for q, (_, terms, weights) in enumerate(asked.value):
                    held[q] = shard.best(terms, weights, k, held[q])
        for (query, _, _), found in zip(asked.value, held):
            if len(found.score):
                ids = pa.array(found.id, mask=found.unnamed)
                yield pa.RecordBatch.from_pydict({"query": pa.array([query] * len(ids), pa.int64()), "doc_id": ids, "score": pa.array(found.score)})

    return run


def ranked_search(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    k: int = 10,
    shard_bytes: int = 16 << 20,
    block_terms: int = 1 << 18,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of every item, of those with a score above 0."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    found = rows.select("text").mapInArrow(_totals, "n long, l long").agg(F.sum("n").alias("n"), F.sum("l").alias("l")).first()
    n, total = found.n or 0, max(1, found.l or 0)
    index = stage(rows.mapInArrow(_index(n, total, shard_bytes), _INDEX), "wavelet-index")
    listed = stage(items.select(F.monotonically_increasing_id().alias("query"), F.col(item_id_col).alias("item_id"), F.col(item_text_col).alias("text")), "queries")
    queries = stage(listed.select("query", "text").mapInArrow(_queries, "query long, terms array<long>, times array<long>"), "query-terms")
    blocks = -(-(queries.agg(F.sum(F.size("terms"))).first()[0] or 1) // block_terms)
    best = []
    for block in range(blocks):  # a block has about ``block_terms`` terms, so what is sent around is bounded
        some = queries.where((F.pmod(F.xxhash64("query"), F.lit(blocks)) == block) & (F.size("terms") > 0)).collect()
        terms = [np.array(q.terms, np.int64).view(np.uint64) for q in some]
        wanted = np.unique(np.concatenate([np.zeros(0, np.uint64), *terms]))
        sent = spark.sparkContext.broadcast(wanted)
        counted = index.select("terms", "ends").mapInArrow(_frequencies(sent), "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
        df = np.zeros(len(wanted), np.int64)
        df[np.searchsorted(wanted, counted.column("term").to_numpy().view(np.uint64))] = counted.column("df").to_numpy()
        weight = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
        asked = [(q.query, t, weight[np.searchsorted(wanted, t)] * np.array(q.times)) for q, t in zip(some, terms)]
        kinds = "query long, doc_id long, score long"
        best.append(stage(index.mapInArrow(_search(spark.sparkContext.broadcast(asked), k, n, total), kinds), "best"))
    release(index, queries)
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = functools.reduce(DataFrame.unionByName, best).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.join(listed.select("query", "item_id"), "query").select("item_id", "rank", "doc_id", "score")
