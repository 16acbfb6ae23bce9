"""Spans within one text, as array folds: offsets are code points, ends exclusive."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quirework.functions import text as T
from quirework.functions.folds import fold
from quirework.functions.tokens import MOST_PHRASES, Phrases


def spans_of(text: Column, pattern: str, kind: str) -> Column:
    """array<struct(start, end, kind, text)> of all matches.

    Splitting at the matches gives the pieces between them, so the offsets are running sums of lengths.
    """

    def placed(found: Column, between: Column) -> Column:
        def step(at: Column, i: Column) -> tuple[Column, Column]:
            word, start = F.get(found, i), at + F.length(F.get(between, i))
            end = start + F.length(word)
            return end, F.array(F.struct(start.alias("start"), end.alias("end"), F.lit(kind).alias("kind"), word.alias("text")))

        return fold(F.size(found), F.lit(0), "struct<start:int,end:int,kind:string,text:string>", step)

    pieces = F.split(text, pattern, -1)
    return T.bind(F.regexp_extract_all(text, F.lit(f"({pattern})"), 1), lambda found: T.bind(pieces, lambda between: placed(found, between)))


def stripped(text: Column, start: Column, end: Column) -> Column:
    """struct(start, end, text) without blanks at the ends of the span."""
    raw = F.substring(text, start + 1, end - start)
    bare = T.strip(raw)
    first = start + F.length(raw) - F.length(F.regexp_replace(raw, f"^{T.SPACE}+", ""))
    return F.struct(first.alias("start"), (first + F.length(bare)).alias("end"), bare.alias("text"))


def sentence_window(text: Column, start: Column, end: Column, stops: str = ".!?؟؛\n", limit: int = 900) -> Column:
    """struct(start, end): the span widened to the sentence around it, its final stop included, ``limit`` characters at most."""
    left = F.length(F.regexp_extract(F.substring(text, F.lit(1), start), f"[^{stops}]*$", 0))
    right = F.length(F.regexp_extract(F.substring(text, end + 1, F.length(text)), f"^[^{stops}]*[{stops}]?", 0))
    first = start - left
    return F.struct(first.alias("start"), F.least(end + right, first + limit).alias("end"))


def non_overlapping(spans: Column, kind: str = "struct<start:int,end:int>") -> Column:
    """Spans (of type ``kind``) in order of (start, end), each kept if it begins at or after the end of the last one kept."""

    def swept(ordered: Column) -> Column:
        def step(at: Column, i: Column) -> tuple[Column, Column]:
            span = F.get(ordered, i)
            free = span["start"] >= at
            return F.when(free, span["end"]).otherwise(at), F.when(free, F.array(span)).otherwise(F.array().cast(f"array<{kind}>"))

        return fold(F.size(ordered), F.lit(0), kind, step)

    return T.bind(F.array_sort(spans), swept)


def valid_spans(text: Column, spans: Column, kinds: list[str]) -> Column:
    """Spans of a known kind, within the text, whose words stand exactly there."""
    return F.filter(
        spans,
        lambda s: s["kind"].isin(*kinds)
        & (s["start"] >= 0)
        & (s["end"] > s["start"])
        & (s["end"] <= F.length(text))
        & (F.substring(text, s["start"] + 1, s["end"] - s["start"]) == s["text"]),
    )


def interleaved(text: Column, spans: Column) -> Column:
    """The whole text as an array of struct(kind, text): spans (ordered, apart) and the gaps between them."""
    piece = lambda kind, words: F.struct(kind.alias("kind"), words.alias("text"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<kind:string,text:string>>").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        gap = F.when(s["start"] > acc["at"], F.array(piece(F.lit("gap"), F.substring(text, acc["at"] + 1, s["start"] - acc["at"])))).otherwise(
            F.array().cast("array<struct<kind:string,text:string>>")
        )
        return F.struct(s["end"].alias("at"), F.concat(acc["out"], gap, F.array(piece(s["kind"], s["text"]))).alias("out"))

    def close(acc: Column) -> Column:
        rest = F.substring(text, acc["at"] + 1, F.length(text))
        return F.when(rest == "", acc["out"]).otherwise(F.concat(acc["out"], F.array(piece(F.lit("gap"), rest))))

    return F.aggregate(spans, start, step, close)


def merged_passes(passes: DataFrame, key: str) -> DataFrame:
    """Extractions of several passes (pass, start, end, kind, text): the first pass wins where they overlap."""
    row = F.struct("pass", "start", "end", "kind", "text")

    def step(acc: Column, s: Column) -> Column:
        clash = F.exists(acc, lambda k: (k["start"] < s["end"]) & (s["start"] < k["end"]))
        return F.when(clash, acc).otherwise(F.concat(acc, F.array(s)))

    each = passes.groupBy(key).agg(F.array_sort(F.collect_list(row)).alias("all"))
    none = F.filter("all", lambda s: F.lit(False))
    return each.select(key, F.explode(F.aggregate("all", none, step)).alias("s")).select(key, "s.*")


def chunks(rows: DataFrame, key: str, text: str, limit: int = 1000) -> DataFrame:
    """(key, chunk_no, start, chunk): texts cut at blanks into pieces of ``limit`` characters at most (longer words are cut)."""
    pieces = F.regexp_extract_all(F.col(text), F.lit(f"(?s)(.{{1,{limit - 1}}}(?:{T.SPACE}|$)|.{{1,{limit}}})"), 1)
    cut = rows.select(key, F.posexplode(pieces).alias("chunk_no", "chunk"))
    before = Window.partitionBy(key).orderBy("chunk_no").rowsBetween(Window.unboundedPreceding, -1)
    return cut.withColumn("start", F.coalesce(F.sum(F.length("chunk")).over(before), F.lit(0))).select(key, "chunk_no", "start", "chunk")


def grounded(docs: DataFrame, quotes: DataFrame, doc_key: str = "doc_id", quote_key: str = "item_id", text: str = "text") -> DataFrame:
    """(doc, quote, start, end): first exact occurrence of each quote in each text.

    Words are parted by any blanks. A quote's first and last word may be part of longer words in a text, those between
    stand there as they are: quotes and texts meet on the first six of them, or all if there are fewer. Quotes of one or
    two words have none: an automaton of all of them reads every text once (more than it may hold are searched one by one);
    blank quotes give no row.
    """
    lead = 6
    blanks = r"\s+"
    words = F.split(F.col(text), blanks)
    keyed = quotes.where(F.col(text).rlike(r"\S")).select(quote_key, F.col(text).alias("_quote"), F.slice(words, F.lit(2), F.greatest(F.size(words) - 2, F.lit(0))).alias("_inner"))
    keyed = keyed.select(quote_key, "_quote", F.xxhash64(F.slice("_inner", 1, lead)).alias("_lead"), F.least(F.size("_inner"), F.lit(lead)).alias("_size"))
    sizes = sorted(r["_size"] for r in keyed.select("_size").distinct().collect() if r["_size"])

    def windows(n: int) -> Column:
        at = F.sequence(F.lit(1), F.greatest(F.size("_ws") - n + 1, F.lit(1)))
        return F.transform(at, lambda i: F.xxhash64(F.slice("_ws", i, n)))

    grams = [windows(n) for n in sizes]
    met = []
    if grams:
        probes = docs.select(doc_key, F.split(F.col(text), blanks).alias("_ws")).select(doc_key, F.explode(F.array_distinct(F.concat(*grams))).alias("_lead"))
        met.append(probes.join(keyed.where("_size > 0"), "_lead").select(doc_key, quote_key, "_quote").distinct())
    short = keyed.where("_size = 0").select(quote_key, "_quote")
    few = [r["_quote"] for r in short.select("_quote").distinct().limit(MOST_PHRASES + 1).collect()]
    if len(few) > MOST_PHRASES:
        held = docs.join(short.select("_quote").distinct(), F.contains(F.col(text), F.col("_quote")))
        met.append(held.select(doc_key, "_quote").join(short, "_quote").select(doc_key, quote_key, "_quote"))
    elif few or not met:
        hits = F.array_distinct(F.transform(Phrases(few, whole=False, fold=False).at(F.col(text)), lambda p: p["text"]))
        met.append(docs.select(doc_key, F.explode(hits).alias("_quote")).join(short, "_quote").select(doc_key, quote_key, "_quote"))
    pairs = reduce(DataFrame.unionByName, met)
    found = pairs.join(docs.select(doc_key, F.col(text).alias("_text")), doc_key)
    start = F.instr(F.col("_text"), F.col("_quote"))
    return found.where(start > 0).select(doc_key, quote_key, (start - 1).cast("long").alias("start"), (start - 1 + F.length("_quote")).cast("long").alias("end"))
