"""Benchmark decontamination by size-partitioned MinHash containment search.

A document contains an item when it holds at least ``threshold`` of the item's distinct word shingles. Items are short
and documents long, so the sketch is one-sided: of each item, the k shingles with the smallest hashes (a bottom-k
MinHash). An item of size s may miss m = floor((1 - threshold) * s) shingles, so k = m + 1 + ``extra`` sketch shingles
leave at least 1 + ``extra`` of them in every document that contains it: no match is lost. Items are partitioned by
size (powers of two); each partition has a bitmap of fixed size of its sketches, and a document probes only the
partitions whose items are small enough for it. Hits are joined with the sketches, candidates with enough hits are
verified by their exact number of shared shingles. Words are lower-cased (all letters) and split at ASCII blanks.

Defined results: null or blank texts and items have no shingles and match nothing; items of fewer than ``n`` words are
one shingle of all their words, looked up among windows of that many words; repeated rows of a document or item give
one pair; empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirework.llm import tokens
from quirework.llm.shared import fixed_bitmap, in_bitmap, slices, stage, without_ids

_HITS = "at_row long, doc_id long, size long, sketch array<struct<part:int,hash:long>>, shared array<long>"


def _item_sets(n: int, threshold: float, extra: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            w = tokens.words(batch.column("text"))
            h, row = tokens.sets(w, n)
            size = np.bincount(row, minlength=batch.num_rows)
            missing = np.floor((1 - threshold) * size + 1e-9).astype(np.int64)
            rank = np.arange(len(row)) - np.concatenate([[0], np.cumsum(size)])[row]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("item_id").take(pa.array(row)),
                    pa.array(h.view(np.int64)),
                    pa.array(size[row]),
                    pa.array(np.minimum(w.counts, n)[row]),
                    pa.array(rank <= (missing + extra)[row]),
                    pa.array(np.minimum(1 + extra, size - missing)[row]),
                    pa.array((np.ceil(np.log2(np.maximum(size, 1))).astype(np.int32))[row]),
                ],
                ["item_id", "hash", "size", "words", "in_sketch", "needed", "part"],
            )

    return run


def _probe(n: int, threshold: float, lengths: dict[int, list[int]], sketches: dict[int, np.ndarray], members: np.ndarray):
    """Documents with sketch hits: the hits by partition, and all shingles that may be an item's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            w = tokens.words(batch.column("text"))
            rows = batch.num_rows
            full, full_row = tokens.sets(w, n)
            size = np.bincount(full_row, minlength=rows)
            parts, hits, hit_rows, mem, mem_rows = [], [], [], [], []
            for length in sorted({x for found in lengths.values() for x in found}):
                h, row = (full, full_row) if length == n else tokens.windows(w, length, n)
                if not len(h):
                    continue
                for part, bitmap in sketches.items():
                    if length not in lengths[part]:
                        continue
                    least = threshold * (2 ** (part - 1) + (part > 0)) if length == n and part else 0
                    found = np.flatnonzero(in_bitmap(bitmap, h) & (size[row] >= least - 1e-9))
                    parts.append(np.full(len(found), part, np.int32))
                    hits.append(h[found])
                    hit_rows.append(row[found])
                found = np.flatnonzero(in_bitmap(members, h))
                mem.append(h[found])
                mem_rows.append(row[found])
            if not hits or not sum(map(len, hits)):
                continue
            part, hit, hit_row = map(np.concatenate, (parts, hits, hit_rows))
            m, m_row = np.concatenate(mem), np.concatenate(mem_rows)
            order, m_order = np.argsort(hit_row, kind="stable"), np.argsort(m_row, kind="stable")
            kind = pa.struct([("part", pa.int32()), ("hash", pa.int64())])
            pairs = pa.StructArray.from_arrays([pa.array(part[order]), pa.array(hit[order].view(np.int64))], fields=list(kind))
            ends = pa.array(np.searchsorted(hit_row[order], np.arange(rows + 1)).astype(np.int32))
            out = pa.RecordBatch.from_arrays(
                [
                    batch.column("at_row"),
                    batch.column("doc_id"),
                    pa.array(size.astype(np.int64)),
                    pa.ListArray.from_arrays(ends, pairs),
                    tokens.lists(m[m_order].view(np.int64), m_row[m_order], rows, pa.int64()),
                ],
                ["at_row", "doc_id", "size", "sketch", "shared"],
            )
            yield out.filter(pa.array(np.bincount(hit_row, minlength=rows) > 0))

    return run


def containment_pairs(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    n: int = 5,
    threshold: float = 0.8,
    extra: int = 3,
) -> DataFrame:
    """Pairs (doc_id, item_id, item_size, shared, containment) with containment of at least ``threshold``."""
    item_rows = items.select(F.col(item_id_col).cast("long").alias("item_id"), F.lower(F.col(item_text_col)).alias("text"))
    sets = stage(
        item_rows.mapInArrow(
            _item_sets(n, threshold, extra),
            "item_id long, hash long, size long, words long, in_sketch boolean, needed long, part int",
        ),
        "items",
    )
    sketch = sets.where("in_sketch")
    shapes = sets.select("part", "words").distinct().collect()  # at most 64 partitions times n lengths
    lengths = {r.part: sorted(x.words for x in shapes if x.part == r.part) for r in shapes}
    bitmaps = {part: fixed_bitmap(sketch.where(F.col("part") == part), "hash") for part in sorted(lengths)}
    members = fixed_bitmap(sets, "hash")
    rows = docs.select(
        F.monotonically_increasing_id().alias("at_row"), F.col(id_col).cast("long").alias("doc_id"), F.lower(F.col(text_col)).alias("text")
    )
    found = stage(rows.mapInArrow(_probe(n, threshold, lengths, bitmaps, members), _HITS), "hits")
    hits = found.select("at_row", "doc_id", "size", F.explode("sketch").alias("hit")).select(
        "at_row", "doc_id", F.col("size").alias("doc_size"), "hit.part", "hit.hash"
    )
    candidates = (
        hits.distinct()
        .join(sketch.select("item_id", "hash", "part", "size", "words", "needed").distinct(), ["part", "hash"])
        .groupBy("at_row", "doc_id", "item_id", "size", "needed")
        .agg(F.count("*").alias("n_hits"))
        .where("n_hits >= needed")
        .select("at_row", "doc_id", "item_id", F.col("size").alias("item_size"))
    )
    shared = found.select("at_row", F.explode(F.array_distinct("shared")).alias("hash"))
    counted = (
        candidates.join(shared, "at_row")
        .join(sets.select("item_id", "hash", F.col("size").alias("item_size")).distinct(), ["item_id", "hash", "item_size"])
        .groupBy("at_row", "doc_id", "item_id", "item_size")
        .agg(F.count("*").alias("shared"))
        .where(F.col("shared") >= F.lit(threshold) * F.col("item_size") - 1e-9)
    )
    best = counted.groupBy("doc_id", "item_id").agg(F.max(F.struct((F.col("shared") / F.col("item_size")).alias("containment"), "item_size", "shared")).alias("b"))
    return best.select("doc_id", "item_id", "b.item_size", "b.shared", "b.containment")


def decontaminate(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """``docs`` without those that contain an item; all columns stay. Rows with a null id go together if one of them does."""
    bad = containment_pairs(docs, items, **options).select(F.col("doc_id").alias("id"))
    return without_ids(docs, bad, options.get("id_col", "doc_id"))
