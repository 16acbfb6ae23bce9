"""License scan by diagonal voting.

Templates are phrases, notices and license texts. All rolling windows of ``k`` words, in documents and templates, are
hashed; windows are joined with the template places that hold the same words. A match at word i of the document and word
j of the template votes for the diagonal i - j: a copy of the template puts all its windows on one diagonal, and words
put in or left out move the rest of it to a neighbouring one. Steps:

1. Each document's windows are hashed, and those that a bitmap of the templates' hashes lets through are kept with their
   words (the bitmap is sized by the templates and only lets too much through).
2. They are joined with the template places by hash and by their words, so a match is exact; votes are counted by
   (document, template, diagonal).
3. A diagonal that holds all windows of a template is a place where its words stand consecutively. Templates that ask for
   100 percent stop here.
4. For the others, diagonals up to ``drift`` words apart are merged (a merged span drifts by ``reach`` words at most,
   which bounds what is gathered for it) and verified: the template's words that matched windows cover are counted, and
   the span must hold at least the template's ``percent`` of its words and be no more than twice as long as they are.

Words are runs of ASCII letters, digits and all characters from U+0080 on; A-Z are lower-cased.

Defined results: null and empty texts, and those of fewer than ``k`` words, have no places and empty labels; a phrase
counts at every place, overlapping ones too; repeated rows are documents of their own; of equal scores nothing is
dropped, as labels are a set; a text of any length is scanned as a whole; empty tables give an empty result; columns of
the input besides id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quirework.llm import tokens
from quirework.llm.shared import fixed_bitmap, in_bitmap, slices, stage

#: Template windows that a join may send to all executors, about 100 bytes each.
_SENT = 1 << 18


@dataclass(frozen=True)
class Template:
    """A phrase or text that gives ``label`` where ``percent`` of its words stand; ``base`` places are counted."""

    label: str
    text: str
    percent: int = 75
    base: bool = False


#: The base phrases, and well-known notices and license texts.
TEMPLATES = (
    Template("mit", "under the mit license", 100, True),
    Template("apache-2", "apache license version 2", 100, True),
    Template("cc-by-nc", "cc by nc", 100, True),
    Template(
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the Software), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, "
        "and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The "
        "above copyright notice and this permission notice shall be included in all copies or substantial portions of "
        "the Software.",
    ),
    Template(
        "apache-2",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software "
        "distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
        "either express or implied.",
    ),
    Template(
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: Redistributions of source code must retain the above copyright notice, this "
        "list of conditions and the following disclaimer.",
    ),
    Template(
        "bsd-3-clause",
        "may be used to endorse or promote products derived from this software without specific prior written permission.",
    ),
    Template(
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    Template("gpl", "GNU General Public License", 100),
    Template("lgpl", "GNU Lesser General Public License", 100),
    Template("agpl", "GNU Affero General Public License", 100),
    Template(
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ),
    Template("mpl-2", "subject to the terms of the Mozilla Public License, v. 2.0", 75),
    Template("unlicense", "free and unencumbered software released into the public domain", 75),
    Template("cc-by", "Creative Commons Attribution 4.0", 100),
    Template("cc-by", "licensed under CC BY 4.0", 100),
    Template("cc-by-sa", "Creative Commons Attribution ShareAlike", 100),
    Template("cc-by-sa", "CC BY SA", 100),
    Template("cc-by-nc", "Creative Commons Attribution NonCommercial", 100),
    Template("cc-by-nd", "CC BY ND", 100),
    Template("cc0", "CC0 1.0 Universal", 100),
    Template("all-rights-reserved", "All rights reserved. No part of this", 100),
)


def _windows(k: int, bitmap: np.ndarray | None):
    """(row, id, number of words, windows) of each text; with a bitmap, of the windows that it lets through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            w = tokens.words(batch.column("text"), separators=tokens.PUNCTUATION)
            total = max(0, len(w.hash) - k + 1)
            whole = np.flatnonzero(w.row[:total] == w.row[len(w.row) - total :])
            hashes, row = tokens.shingles(w, k)
            if bitmap is not None:
                held = in_bitmap(bitmap, hashes)
                whole, hashes, row = whole[held], hashes[held], row[held]
            folded, begin, end = tokens.folded(w.text.data), w.start, w.end
            said = [" ".join(folded[begin[j] : end[j]].tobytes().decode() for j in range(i, i + k)) for i in whole.tolist()]
            kind = pa.struct([("at", pa.int64()), ("hash", pa.int64()), ("words", pa.string())])
            grams = pa.StructArray.from_arrays(
                [pa.array(whole - w.first[row], pa.int64()), pa.array(hashes.view(np.int64)), pa.array(said, pa.string())], fields=list(kind)
            )
            ends = pa.array(np.searchsorted(row, np.arange(batch.num_rows + 1)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("doc_id"), pa.array(w.counts.astype(np.int64)), pa.ListArray.from_arrays(ends, grams)],
                names=["row", "doc_id", "n_words", "grams"],
            )

    return run


_WINDOWS = "row long, doc_id long, n_words long, grams array<struct<at:long,hash:long,words:string>>"


def template_places(spark, templates: tuple[Template, ...], k: int) -> DataFrame:
    """(template, label, percent, base, length, place, hash, words): every window of every template."""
    rows = [(i, i, t.text, t.label, t.percent, t.base) for i, t in enumerate(templates)]
    given = spark.createDataFrame(rows, "row long, doc_id long, text string, label string, percent int, base boolean")
    cut = given.select("row", "doc_id", "text").mapInArrow(_windows(k, None), _WINDOWS)
    one = cut.select(F.col("row").alias("template"), F.col("n_words").alias("length"), F.explode("grams").alias("g"))
    told = given.select(F.col("row").alias("template"), "label", "percent", "base")
    return one.join(told, "template").select("template", "label", "percent", "base", "length", F.col("g.at").alias("place"), "g.hash", "g.words")


def license_spans(places: DataFrame, windows: DataFrame, k: int, drift: int, reach: int) -> DataFrame:
    """Verified spans (row, label, base, first, last, coverage); ``last`` is the place after the last word."""
    gram = windows.select("row", F.explode("grams").alias("g")).select("row", "g.at", "g.hash", "g.words")
    voted = (
        gram.join(places, ["hash", "words"])
        .groupBy("row", "template", "label", "percent", "base", "length", (F.col("at") - F.col("place")).alias("diagonal"))
        .agg(F.min("at").alias("first"), (F.max("at") + k).alias("last"), F.collect_set("place").alias("seen"))
    )
    complete = (F.size("seen") == F.col("length") - k + 1) & (F.col("percent") == 100)
    exact = voted.where(complete).select("row", "label", "base", "first", "last", F.lit(1.0).alias("coverage"))
    each = Window.partitionBy("row", "template").orderBy("diagonal")
    fresh = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(each) > drift, F.lit(True))
    chained = voted.where("percent < 100").withColumn("chain", F.sum(fresh.cast("long")).over(each))
    begun = F.min("diagonal").over(Window.partitionBy("row", "template", "chain"))
    merged = (
        chained.withColumn("piece", F.floor((F.col("diagonal") - begun) / reach))
        .groupBy("row", "template", "label", "percent", "base", "length", "chain", "piece")
        .agg(F.min("first").alias("first"), F.max("last").alias("last"), F.array_distinct(F.flatten(F.collect_list("seen"))).alias("seen"))
    )
    covered = F.size(F.array_distinct(F.flatten(F.transform("seen", lambda x: F.sequence(x, x + k - 1)))))
    verified = merged.withColumn("covered", covered).where("100 * covered >= percent * length and last - first <= 2 * covered")
    near = verified.select("row", "label", "base", "first", "last", (F.col("covered") / F.col("length")).alias("coverage"))
    return exact.unionByName(near)


def license_scan(
    docs: DataFrame,
    templates: tuple[Template, ...] = TEMPLATES,
    id_col: str = "doc_id",
    text_col: str = "text",
    k: int = 3,
    drift: int = 8,
    reach: int = 64,
) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans) of every document.

    ``spans`` lists (label, first, last, coverage) by place; ``score`` is the largest coverage of a template, 0 without
    one. Templates must have ``k`` words or more, and base templates ask for 100 percent.
    """
    spark = docs.sparkSession
    places = stage(template_places(spark, templates, k), "license-templates")
    size = places.agg(F.count("*").alias("n"), F.countDistinct("template").alias("t"), F.max(F.expr("base and percent < 100")).alias("loose")).first()
    if size.t < len(templates) or size.loose:
        raise ValueError(f"templates need {k} words or more, base templates 100 percent")
    bitmap = fixed_bitmap(places, "hash", min(26, max(12, (64 * size.n).bit_length())))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    windows = stage(rows.mapInArrow(_windows(k, bitmap), _WINDOWS), "license-windows")
    found = license_spans(F.broadcast(places) if size.n <= _SENT else places, windows, k, drift, reach)
    said = lambda kept: F.concat_ws(",", F.array_sort(F.collect_set(kept)))
    base = F.when(F.col("base"), F.col("first"))
    spans = found.groupBy("row").agg(
        F.count(base).alias("n_base"),
        F.min(base).alias("first_word"),
        F.max(base).alias("last_word"),
        said(F.when(F.col("base"), F.col("label"))).alias("base_labels"),
        said(F.col("label")).alias("labels"),
        F.max("coverage").alias("score"),
        F.array_sort(F.collect_list(F.struct("first", "last", "label", "coverage"))).alias("spans"),
    )
    return windows.select("row", "doc_id", "n_words").join(spans, "row", "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
        "spans",
    )
