"""Set-similarity join of documents on word n-grams by vertical partitioning.

All n-grams have one global order. Each document's set is cut along it: a leading piece finds candidates, and the whole
set, in ``fragments`` ranges of the order, verifies them: every fragment counts its part of a pair's overlap by itself
and the parts are summed per pair.

* The order is (heat, hash). Heat is 0 for n-grams that few documents hold among their lowest hashes, and grows with the
  logarithm of their number; it is read from a table of fixed size, so it is the same for equal n-grams everywhere.
* For similarity t and a set of size s, let p = s - ceil(t * s) + 1. Two similar sets share at least l n-grams among the
  p - 1 + l lowest hashes of each (``low`` holds them). A set therefore offers all of ``low`` but its l - 1 last in
  (heat, hash): one shared n-gram is left in both offers, whatever their heat.
* Documents with equal sets form one node from the start.
* Nodes that offer the same n-gram are candidates if the lengths of their fragments allow it: the overlap within a
  fragment is at most the length of the shorter part, and these bounds are summed per pair over ``_CELLS`` fine fragments
  before any set is moved. Short lists give their pairs. The nodes of long lists are ordered
  anew, by how many of these nodes hold each n-gram: what is peculiar to a node comes first, so that of large families
  of copies only those with few changes share n-grams in their prefixes, and the place of the first one bounds the
  overlap.
* Links are only needed to the extent that they join components. In each of the new lists, all nodes are compared with
  the least peculiar one; then nodes of different components are compared in pairs.

Defined results: null, empty and blank texts have no n-grams, size 0 and are their own component; a text of fewer than n
words has its whole sequence as its one n-gram; a null id takes part and is never the smallest of a component that has
another; repeated rows are equal sets; a text of any length is one set, held whole by one task while it is cut; n-grams
and sets are equal if 64 bits of their hashes are; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirework.llm import tokens
from quirework.llm.set_join import close, enough, first_in_common, rare_prefixes
from quirework.llm.shared import fixed_bitmap, id_mask, in_bitmap, release, slices, stage, without_ids

_HEAT_BITS, _WARM = 20, 5
#: Fine fragments (a power of 2) whose lengths bound the overlap of a pair.
_CELLS = 64
#: Lists of candidates up to this length give all their pairs; longer ones are ordered anew.
_SHORT = 16
#: Halves of p by which the low piece exceeds the prefix: it holds about three tenths of a set at 90 and at 80 percent.
_SPARE = {90: 4, 80: 1}
_U = np.uint64


def _prefix(size: np.ndarray, percent: int) -> np.ndarray:
    return size - -(-percent * size // 100) + 1


def _reach(size: np.ndarray, percent: int) -> np.ndarray:
    """l: how many shared n-grams the low pieces of two similar sets hold, at least."""
    p = _prefix(size, percent)
    return np.minimum(p * _SPARE.get(percent, 1) // 2 + 1, size - p + 1)


def _nodes(w: tokens.Words, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, row) of the sets, and size and 64-bit fingerprint of each row's set."""
    h, row = tokens.sets(w, n)
    size = np.bincount(row, minlength=w.text.rows)
    edge = np.concatenate([[0], np.cumsum(size)])
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(tokens.mix(h), dtype=np.uint64)])
    turned = np.concatenate([np.zeros(1, np.uint64), np.cumsum(tokens.mix(h ^ _U(0xA24BAED4963EE407)), dtype=np.uint64)])
    first, second = total[edge[1:]] - total[edge[:-1]], turned[edge[1:]] - turned[edge[:-1]]
    return h, row, size, tokens.mix(first + tokens.mix(second + size.astype(np.uint64)))


def _low(n: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            h, row, size, node = _nodes(tokens.words(batch.column("text")), n)
            held = np.minimum(_prefix(size, percent) - 1 + _reach(size, percent), size)
            rank = np.arange(len(row)) - np.concatenate([[0], np.cumsum(size)])[row]
            low = rank < held[row]
            cell = (h >> _U(64 - _CELLS.bit_length() + 1)).astype(np.int64)
            lengths = np.bincount(row * _CELLS + cell, minlength=batch.num_rows * _CELLS).astype(np.int32)
            edges = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * _CELLS)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(size.astype(np.int64)),
                    pa.array(node.view(np.int64)),
                    tokens.lists(h[low].view(np.int64), row[low], batch.num_rows, pa.int64()),
                    pa.ListArray.from_arrays(edges, pa.array(lengths)),
                ],
                ["doc_id", "n_shingles", "node", "low", "lengths"],
            )

    return run


def _offers(heat, percent: int, wanted=None):
    """(token, node) that each set offers; with ``wanted``, a bitmap, only tokens that may be in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = heat.value
        for batch in batches:
            low = batch.column("low")
            h = low.flatten().to_numpy().view(np.uint64)
            owner = pc.list_parent_indices(low).to_numpy()
            size = batch.column("n_shingles").to_numpy()
            held = np.bincount(owner, minlength=len(size))
            order = np.lexsort((h, table[h >> _U(64 - _HEAT_BITS)], owner))
            rank = np.arange(len(h)) - np.concatenate([[0], np.cumsum(held)])[owner]
            least = -(-percent * size // 100)
            left_out = np.minimum(_reach(size, percent), _reach(least, percent)) - 1
            offered = order[rank < (held - left_out)[owner]]
            if wanted is not None:
                offered = offered[in_bitmap(wanted.value, h[offered])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(h[offered].view(np.int64)), batch.column("node").take(pa.array(owner[offered]))], ["token", "node"]
            )

    return run


def _fragments(n: int, fragments: int, bitmap):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = bitmap.value
        for batch in slices(batches):
            batch = batch.filter(pa.array(in_bitmap(wanted, batch.column("id_hash").to_numpy().view(np.uint64))))
            if not batch.num_rows:
                continue
            h, row, size, node = _nodes(tokens.words(batch.column("text")), n)
            piece = (h >> _U(32)) * _U(fragments) >> _U(32)
            key = row * fragments + piece.astype(np.int64)  # ascending, as hashes ascend within a row
            at, begin = np.unique(key, return_index=True)
            offsets = pa.array(np.append(begin, len(h)).astype(np.int32))
            owner = at // fragments
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(owner)),
                    pa.array(node.view(np.int64)[owner]),
                    pa.array((at % fragments).astype(np.int32)),
                    pa.ListArray.from_arrays(offsets, pa.array(h.view(np.int64))),
                ],
                ["doc_id", "node", "fragment", "piece"],
            )

    return run


def components(links: DataFrame) -> DataFrame:
    """(node, label) for each node of ``links`` (a, b): label is the smallest node of its component.

    Every round takes the smallest label among the neighbours and then the label of that label, so paths halve.
    """
    edges = stage(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = stage(edges.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("label")).withColumnRenamed("a", "node"), "labels")
    while True:
        near = (
            edges.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("label").alias("near")).withColumnRenamed("a", "node")
        )
        lower = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("next"))
        jump = labels.select(F.col("node").alias("next"), F.col("label").alias("jump"))
        moved = stage(
            lower.join(jump, "next", "left").select("node", "label", F.least("next", F.coalesce("jump", "next")).alias("next")), "labels"
        )
        if not moved.where("next <> label").limit(1).count():
            release(edges, moved)
            return labels
        before, labels = labels, stage(moved.select("node", F.col("next").alias("label")), "labels")
        release(before, moved)


def jaccard_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    n: int = 3,
    percent: int = 90,
    fragments: int = 16,
) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id that links reach) for each document.

    Two documents link when 100 * intersection >= ``percent`` * union of their sets.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    base = stage(rows.mapInArrow(_low(n, percent), "doc_id long, n_shingles long, node long, low array<long>, lengths array<int>"), "low")
    real = base.where("n_shingles > 0")
    classes = stage(real.groupBy("node").agg(F.min("doc_id").alias("min_id"), F.max("n_shingles").alias("size"), F.first("lengths").alias("lengths")), "classes")

    warm = real.select(F.explode("low").alias("token")).groupBy("token").agg(F.count("*").alias("n")).where(F.col("n") > _WARM)
    level = (F.log2(F.col("n") / _WARM) + 1).cast("int")
    held = (
        warm.groupBy(F.shiftrightunsigned("token", 64 - _HEAT_BITS).alias("at")).agg(F.max(level).alias("level")).toArrow()
    )  # one row for each of 2**20 places at most
    heat = np.zeros(1 << _HEAT_BITS, np.uint8)
    heat[held.column("at").to_numpy()] = held.column("level").to_numpy()
    sent, low = spark.sparkContext.broadcast(heat), real.select("n_shingles", "node", "low")
    offers = low.mapInArrow(_offers(sent, percent), "token long, node long")
    lists = stage(
        offers.groupBy("token").agg(F.min("node").alias("lo"), F.max("node").alias("hi"), F.count("*").alias("n")).where("lo <> hi").select("token", "n"), "tokens"
    )
    several = spark.sparkContext.broadcast(fixed_bitmap(lists, "token"))
    offers = low.mapInArrow(_offers(sent, percent, several), "token long, node long")
    listed = stage(offers.join(lists, "token").distinct(), "lists")
    members = stage(base.select("doc_id", "n_shingles", "node"), "members")
    release(base, lists)
    sizes = classes.select("node", "size")
    short = listed.where(F.col("n") <= _SHORT).join(sizes, "node")
    left, right = (short.select("token", F.col("node").alias(x), F.col("size").alias(f"size_{x}")) for x in ("a", "b"))
    met = left.join(right, "token").where((F.col("a") < F.col("b")) & close(F.col("size_a"), F.col("size_b"), percent)).select("a", "b")
    pairs = _possible(stage(met.distinct(), "met"), classes, percent)
    crowd = stage(listed.where(F.col("n") > _SHORT).select("node").distinct(), "crowd")
    release(listed)
    needed = crowd.unionByName(pairs.select(F.col("a").alias("node"))).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    needed = stage(needed.join(classes, "node").select("node", F.col("min_id").alias("doc_id")), "needed")
    pieces = _pieces(rows, needed, n, fragments)
    again = stage(rare_prefixes(pieces.join(crowd, "node", "left_semi").select("node", "piece"), sizes, percent), "prefixes")
    release(needed, crowd)
    hubs = again.groupBy("token").agg(F.min(F.struct("at", "node", "size")).alias("hub")).select("token", F.col("hub.node").alias("b"), F.col("hub.size").alias("size_b"), F.col("hub.at").alias("at_b"))
    mine = again.select("token", F.col("node").alias("a"), F.col("size").alias("size_a"), F.col("at").alias("at_a"))
    fits = close(F.col("size_a"), F.col("size_b"), percent) & first_in_common(F.col("size_a"), F.col("at_a"), F.col("size_b"), F.col("at_b"), percent)
    starred = mine.join(hubs, "token").where((F.col("a") != F.col("b")) & fits).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    starred = _possible(stage(starred.distinct(), "starred"), classes, percent)
    links = _verified(pieces, sizes, pairs.unionByName(starred).distinct(), percent)
    release(pairs, starred)
    labels = components(links)
    held = stage(again.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")), "labelled")
    release(again)
    mixed = held.groupBy("token").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("token")
    several = held.join(mixed, "token")
    left, right = (several.select("token", *(F.col(c).alias(f"{c}_{x}") for c in ("node", "label", "size", "at"))) for x in ("a", "b"))
    across = left.join(right, "token").where((F.col("node_a") < F.col("node_b")) & (F.col("label_a") != F.col("label_b")) & fits)
    across = stage(across.select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct(), "across")
    across = _possible(across, classes, percent)
    found = _verified(pieces, sizes, across, percent)
    release(pieces, held, across)
    if not found.isEmpty():
        release(labels)
        labels = components(links.unionByName(found))
    release(links, found)

    named = classes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    smallest = named.groupBy("label").agg(F.min("min_id").alias("component_id"))
    of_node = stage(named.join(smallest, "label").select("node", "component_id"), "components")
    release(classes, labels)
    empty = members.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return members.where("n_shingles > 0").join(of_node, "node").select("doc_id", "n_shingles", "component_id").unionByName(empty)


def drop_near_duplicates(docs: DataFrame, n: int = 5, percent: int = 80, **options) -> DataFrame:
    """``docs`` with one document of each component: the smallest id stays, of repeated rows one; all columns stay.

    Documents without words are in no group and stay. Rows that share an id but not a text go or stay by their id.
    """
    id_col, text_col = options.get("id_col", "doc_id"), options.get("text_col", "text")
    groups = stage(jaccard_components(docs, n=n, percent=percent, **options), "groups")
    later = groups.where(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("id"))
    repeated = stage(groups.where("n_shingles > 0").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select(F.col("doc_id").alias("_quirework_id")), "repeated")
    kept = without_ids(docs, later, id_col)
    if not repeated.limit(1).count():
        return kept
    same = F.col(id_col).cast("long").eqNullSafe(F.col("_quirework_id"))
    once = kept.join(repeated, same, "left_semi").dropDuplicates([id_col, text_col])
    return kept.join(repeated, same, "left_anti").unionByName(once)


def _pieces(rows: DataFrame, needed: DataFrame, n: int, fragments: int) -> DataFrame:
    """(node, fragment, piece): the sets of the nodes in ``needed`` (node, doc_id), cut into fragments."""
    hashed = F.xxhash64("doc_id")
    bitmap = rows.sparkSession.sparkContext.broadcast(fixed_bitmap(needed.select(hashed.alias("id_hash")), "id_hash"))
    cut = rows.select("doc_id", hashed.alias("id_hash"), "text").mapInArrow(
        _fragments(n, fragments, bitmap), "doc_id long, node long, fragment int, piece array<long>"
    )
    # written so that only the node is a join key: repeated rows are then dropped without another shuffle
    same_id = F.expr("coalesce(c.doc_id = w.doc_id, c.doc_id is null and w.doc_id is null)")
    return stage(
        cut.alias("c").join(needed.alias("w"), same_id & (F.col("c.node") == F.col("w.node")), "left_semi").select("node", "fragment", "piece").dropDuplicates(["node", "fragment"]), "pieces"
    )


def _possible(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose fragments are long enough for the overlap that similarity takes; ``pairs`` is used up."""
    a, b = (classes.select(F.col("node").alias(x), F.col("size").alias(f"size_{x}"), F.col("lengths").alias(f"lengths_{x}")) for x in ("a", "b"))
    most = F.aggregate(F.zip_with("lengths_a", "lengths_b", lambda x, y: F.least(x, y)), F.lit(0), lambda total, part: total + part)
    out = stage(pairs.join(a, "a").join(b, "b").where(enough(most, F.col("size_a"), F.col("size_b"), percent)).select("a", "b"), "possible")
    release(pairs)
    return out


def _verified(pieces: DataFrame, sizes: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes whose sets are similar: overlaps counted by fragment, summed per pair."""
    a, b = (sizes.select(F.col("node").alias(x), F.col("size").alias(f"size_{x}")) for x in ("a", "b"))
    pairs = stage(pairs.join(a, "a").join(b, "b").where(close(F.col("size_a"), F.col("size_b"), percent)), "pairs")
    n_pairs = pairs.count()

    def side(x: str) -> DataFrame:
        """The pieces of the nodes that stand on this side of a pair; a bitmap keeps most others out of the shuffle."""
        here = id_mask(pairs.select(F.col(x).alias("h")), "h", n_pairs)
        return pieces.where(here(F.col("node"))).select(F.col("node").alias(x), "fragment", F.col("piece").alias(f"piece_{x}"))

    part_a, part_b = side("a"), side("b")
    overlap = F.size(F.array_intersect("piece_a", "piece_b"))
    counted = pairs.join(part_b, "b").join(part_a, ["a", "fragment"]).select("a", "b", "size_a", "size_b", overlap.alias("shared"))
    links = stage(
        counted.groupBy("a", "b", "size_a", "size_b")
        .agg(F.sum("shared").alias("shared"))
        .where(enough(F.col("shared"), F.col("size_a"), F.col("size_b"), percent))
        .select("a", "b"),
        "links",
    )
    release(pairs)
    return links
