"""Line deduplication by an exact set-similarity join, with DataFrame operations only.

A line's tokens are its distinct words, lower-cased. A line is removed when an earlier line (by doc_id, then line number)
has a token set of Jaccard similarity ``percent`` / 100 or more; lines without words stay. Steps:

1. Words are counted over all lines. Tokens are ordered by rarity: by the logarithm of their count, then by hash. The
   logarithms come from a table by hash that is sized by the number of frequent words, so the order is the same for equal
   tokens everywhere, and no token is shuffled to be ordered.
2. Lines with equal sets form one class; only the first of a class can stay. Classes of one line are not shuffled.
3. Two sets of similarity t share a token of the s - ceil(t * s) + 1 rarest of the larger set's s tokens and of the
   s - ceil(2t / (1 + t) * s) + 1 rarest of the smaller one's. The former are joined with the latter; pairs are candidates
   if their lengths, the places of that token and sketches of their sets allow the similarity. A sketch holds the parity
   of the number of tokens at each of 64 places (128 if both sets have more than ``_LONG`` tokens), so what two sets share
   cancels out, and the places where two sketches differ are no more than the tokens that only one has. Tokens are joined
   in ``passes`` ranges one after the other, which bounds the scratch space; both sides of a join read one shuffle.
4. Before, of the classes that share one of their first ``_HUBS`` frequent prefix tokens, all are compared with the earliest
   one. Lines that this settles (copies of one line with changes here and there, mostly) take no part as later lines in the
   join that follows over all tokens; two settled lines never meet in it.
5. Candidates are verified by their exact overlap; of a match, the later line goes.

Defined results: null and empty texts have no lines to remove; rows equal in id and text are one document; a null id
sorts first; lines of equal ids and numbers in different texts are ordered by the hash of their set; a line of any length
is one row, its words one array; words are equal if 58 bits of their hashes are, sets if 128 bits of theirs are; a text
that loses all its words by removal leaves the corpus in ``dedup_documents``; empty tables give empty results;
``dedup_documents`` keeps all other columns and recomputes ``n_chars`` where there is one.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirework.llm.set_join import close, enough, first_in_common
from quirework.llm.shared import BLANKS, fixed_table, id_mask, release, stage

#: Words seen up to this often are all equally rare.
_WARM = 16
#: Prefix tokens of this level (seen 64 times or more) count as frequent; so many of a class ask for a hub.
_HOT, _HUBS = 5, 4
#: Larger sets have a second half of their sketch.
_LONG = 64


def _words(line: Column) -> Column:
    """The words of a line, and empty strings where blanks meet or begin or end it."""
    return F.when(line.rlike(r"[\x09-\x0D]"), F.split(line, BLANKS)).otherwise(F.split(line, " "))


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Every line that has a word, lower-cased."""
    text = F.col(text_col)
    lines = docs.where(text.isNotNull()).select(
        F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("doc_hash"), F.posexplode(F.split(F.lower(text), "\n")).alias("line_no", "line")
    )
    return lines.where(F.ltrim("line", F.lit(" \t\n\v\f\r")) != "")


def _rarity(lines: DataFrame) -> tuple[Column, int]:
    """A table by word hash (the level of the most frequent word of each place) and its number of places."""
    words = lines.select(F.explode(_words(F.col("line"))).alias("word")).where("word <> ''").groupBy(F.xxhash64("word").alias("token")).agg(F.count("*").alias("n"))
    common = stage(words.where(F.col("n") > _WARM), "common")
    places = 1 << min(22, max(10, (4 * common.count()).bit_length()))
    level = F.least((2 * F.log2("n")).cast("int") - 7, F.lit(31))
    table = fixed_table(common.groupBy(F.pmod("token", F.lit(places)).alias("at")).agg(F.max(level).alias("level")), "level", places, "byte")
    release(common)
    return table, places


def _with_tokens(lines: DataFrame, rarity: tuple[Column, int]) -> DataFrame:
    """``lines`` with their sets as ``set``: tokens in order of rarity, a token being its level and 58 bits of its hash."""
    table, places = rarity
    hashes = F.array_remove(F.array_distinct(F.transform(_words(F.col("line")), lambda word: F.xxhash64(word))), F.xxhash64(F.lit("")))
    level = lambda t: F.coalesce(F.get(F.col("levels"), F.pmod(t, F.lit(places)).cast("int")), F.lit(0).cast("byte")).cast("long")
    token = lambda t: F.shiftleft(level(t), 58).bitwiseOR(F.shiftrightunsigned(t, 6))
    return lines.withColumn("hashes", hashes).withColumn("levels", table).withColumn("set", F.sort_array(F.transform("hashes", token))).drop("hashes", "levels", "line")


def _sketch(tokens: str) -> tuple[Column, Column]:
    """The parity of a set's tokens at each of 64 places, and of those of a second half in sets of more than ``_LONG``."""
    none = F.lit(0).cast("long")
    one = lambda t: F.call_function("shiftleft", F.lit(1).cast("long"), t.bitwiseAND(63).cast("int"))
    whole = F.aggregate(tokens, none, lambda held, t: held.bitwiseXOR(one(t)))
    half = F.aggregate(tokens, none, lambda held, t: F.when(F.getbit(t, F.lit(6)) == 1, held.bitwiseXOR(one(t))).otherwise(held))
    return whole, F.when(F.size(tokens) > _LONG, half).otherwise(none)


def removed_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    percent: int = 80,
    passes: int = 2,
) -> DataFrame:
    """(doc_id, doc_hash, line_no, exact) of every line to remove; ``exact``: an earlier line has the same set."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rarity = _rarity(_lines(rows, "doc_id", "text"))
    size = F.size("set")
    whole, half = _sketch("set")
    lines = stage(
        _with_tokens(_lines(rows, "doc_id", "text"), rarity).select(
            F.struct("doc_id", "line_no", "doc_hash").alias("place"),
            F.xxhash64("set").alias("node"),
            F.xxhash64(F.lit(percent), "set").alias("check"),
            size.alias("size"),
            F.slice("set", F.lit(1), size - F.ceil(size * percent / 100).cast("int") + 1).alias("prefix"),
            whole.alias("whole"),
            half.alias("half"),
        ),
        "lines",
    )
    several = stage(lines.groupBy("node", "check").agg(F.min("place").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"), "several")
    listed = id_mask(several, "node", several.count())
    again = stage(lines.where(listed(F.col("node"))).join(several, ["node", "check"], "left"), "again")
    firsts = again.where(F.col("first").isNull() | (F.col("place") == F.col("first"))).drop("first").dropDuplicates(["node", "check"])
    classes = lines.where(~listed(F.col("node"))).unionByName(stage(firsts, "firsts"))

    # a prefix ends with its most frequent tokens
    starry = classes.where(F.element_at("prefix", -1) >= _HOT << 58).withColumn("cold", F.size(F.filter("prefix", lambda t: t < _HOT << 58)))
    shared = F.posexplode(F.slice("prefix", F.col("cold") + 1, F.lit(_HUBS))).alias("k", "token")
    part = starry.select(*_carried(), "cold", shared).withColumn("at", F.col("cold") + F.col("k")).drop("cold", "k").where("node is not null and size is not null and whole is not null").repartition("token")  # once for both sides
    each = F.min(F.struct(*_PLACE, "size", "at", "whole", "half")).alias("x")
    hubs = part.groupBy("token").agg(each, F.count("*").alias("n")).where("n > 1").select("token", "x.*")
    starred = part.alias("a").join(hubs.alias("b").hint("shuffle_hash"), "token").where((F.col("a.node") != F.col("b.node")) & _fits(percent))
    gone = _verified(rows, rarity, classes, [stage(_ordered(starred), "starred")], percent)

    n_gone = gone.count()
    settled = id_mask(gone, "node", n_gone)
    checked = stage(classes.where(settled(F.col("node"))).join(gone.select("node", F.lit(True).alias("gone")), "node", "left").withColumn("gone", F.coalesce("gone", F.lit(False))), "checked")
    flagged = classes.where(~settled(F.col("node"))).withColumn("gone", F.lit(False)).unionByName(checked)
    fits = ((F.col("a.size") > F.col("b.size")) | ((F.col("a.size") == F.col("b.size")) & (F.col("a.node") > F.col("b.node")))) & _fits(percent)
    rest = []
    for k in range(passes):
        # the filters stay above the shuffle, so that all sides read the same one
        part = _listed(flagged, passes, k).repartition("token")
        small = F.col("at") <= F.col("size") - F.ceil(F.col("size") * (2 * percent) / (100 + percent)).cast("int")
        side = lambda condition: part.where(_above(condition))  # noqa: B023, E731
        pairs = _ordered(side(~F.col("gone")).alias("a").join(side(small).alias("b").hint("shuffle_hash"), "token").where(fits & (~F.col("b.gone") | _later("a"))))
        if n_gone:  # a settled class as the larger, earlier one meets what is not settled
            settled_first = side(F.col("gone")).alias("a").hint("shuffle_hash").join(side(small & ~F.col("gone")).alias("b"), "token").where(fits & _later("b"))
            pairs = pairs.unionByName(_ordered(settled_first))
        rest.append(stage(pairs, "rest"))
    more = _verified(rows, rarity, classes, rest, percent)
    release(lines, checked)

    later = again.where(F.col("place") != F.col("first")).select("place.*", F.lit(True).alias("exact"))
    matched = gone.unionByName(more).select("place.*", F.lit(False).alias("exact"))
    return later.unionByName(matched).select("doc_id", "doc_hash", "line_no", "exact").distinct()


#: Which of two classes is the earlier one.
_PLACE = ("doc_id", "line_no", "node")


def _carried() -> list[Column]:
    """What the filters need of a class."""
    return [F.col("place.doc_id"), F.col("place.line_no"), F.col("node"), F.col("size"), F.col("whole"), F.col("half")]


def _both(c: str) -> Column:
    return F.col(f"a.{c}") + F.col(f"b.{c}")


def _unequal() -> Column:
    """The number of places where the sketches of ``a`` and ``b`` differ."""
    whole, half = (F.col(f"a.{c}").bitwiseXOR(F.col(f"b.{c}")) for c in ("whole", "half"))
    half = F.when(F.least("a.size", "b.size") > _LONG, half).otherwise(F.lit(0).cast("long"))
    return F.bit_count(whole.bitwiseXOR(half)) + F.bit_count(half)


def _fits(percent: int) -> Column:
    """Whether lengths, places and sketches of ``a`` and ``b`` allow the similarity."""
    return (
        close(F.col("a.size"), F.col("b.size"), percent)
        & first_in_common(F.col("a.size"), F.col("a.at"), F.col("b.size"), F.col("b.at"), percent)
        & ((100 + percent) * (_both("size") - _unequal()) >= 2 * percent * _both("size"))
    )


def _at(side: str) -> Column:
    return F.struct(*(F.col(f"{side}.{c}").alias(c) for c in _PLACE))


def _later(side: str) -> Column:
    return _at(side) > _at("b" if side == "a" else "a")


def _ordered(pairs: DataFrame) -> DataFrame:
    """(later, earlier): the nodes of each pair of ``a`` and ``b``."""
    a, b = F.col("a.node"), F.col("b.node")
    return pairs.select(F.when(_later("a"), a).otherwise(b).alias("later"), F.when(_later("a"), b).otherwise(a).alias("earlier")).distinct()


def _above(condition: Column) -> Column:
    """A condition that Spark does not move below a shuffle, as it counts as one that may change."""
    return F.when(F.spark_partition_id() >= 0, condition)


def _listed(classes: DataFrame, passes: int, k: int) -> DataFrame:
    """The prefix tokens of one range, with what the filters need of their class."""
    kept = classes.select(*_carried(), "gone", F.posexplode("prefix").alias("at", "token"))
    return kept.where(F.pmod("token", F.lit(passes)) == k)


def _verified(rows: DataFrame, rarity: tuple[Column, int], classes: DataFrame, candidates: list[DataFrame], percent: int) -> DataFrame:
    """(node, place): the later of each of ``candidates`` (later, earlier) whose sets, read again from the texts, are similar."""
    pairs = stage(functools.reduce(DataFrame.unionByName, candidates).distinct(), "pairs")
    release(*candidates)
    wanted = stage(pairs.select(F.col("later").alias("node")).unionByName(pairs.select(F.col("earlier").alias("node"))).distinct(), "wanted")
    count = wanted.count()
    named = id_mask(wanted, "node", count)
    needed = stage(classes.where(named(F.col("node"))).select("node", "place").join(wanted, "node").select("node", "place.*"), "needed")
    place = F.xxhash64("doc_id", "doc_hash", F.col("line_no").cast("long"))
    of_doc, of_line = id_mask(needed.select(F.xxhash64("doc_id").alias("h")), "h", count), id_mask(needed.select(place.alias("h")), "h", count)
    lines = _lines(rows.where(of_doc(F.xxhash64("doc_id"))), "doc_id", "text").where(of_line(place))
    same = F.col("l.doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("l.doc_hash") == F.col("w.doc_hash")) & (F.col("l.line_no") == F.col("w.line_no"))
    texts = lines.alias("l").join(needed.alias("w"), same).select("w.node", "l.line").dropDuplicates(["node"])
    sets = stage(_with_tokens(texts, rarity), "sets")
    a, b = (sets.select(F.col("node").alias(x), F.col("set").alias(f"{x}_set")) for x in ("later", "earlier"))
    shared = F.size(F.array_intersect("later_set", "earlier_set"))
    both = pairs.join(a, "later").join(b, "earlier")
    similar = both.where(enough(shared, F.size("later_set"), F.size("earlier_set"), percent)).select(F.col("later").alias("node")).distinct()
    out = stage(similar.join(needed.select("node", F.struct("doc_id", "line_no", "doc_hash").alias("place")), "node"), "gone")
    release(pairs, wanted, needed, sets)
    return out


def dedup_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the lines of ``removed_lines``; texts left without words go, all columns stay."""
    cut = stage(
        removed_lines(docs, id_col, text_col, **options)
        .groupBy(F.col("doc_id").alias("_quirework_id"), F.col("doc_hash").alias("_quirework_hash"))
        .agg(F.collect_list("line_no").alias("_quirework_cut")),
        "cut",
    )
    listed = id_mask(cut.select(F.xxhash64("_quirework_id").alias("h")), "h", cut.count())
    touched = listed(F.xxhash64(id_col)) & F.col(text_col).isNotNull()
    same = F.col(id_col).eqNullSafe(F.col("_quirework_id")) & (F.xxhash64(text_col) == F.col("_quirework_hash"))
    kept = F.filter(F.split(text_col, "\n"), lambda line, i: ~F.array_contains("_quirework_cut", i))
    text = F.when(F.col("_quirework_cut").isNull(), F.col(text_col)).otherwise(F.array_join(kept, "\n"))
    names = docs.columns
    changed = (
        docs.where(touched)
        .join(cut, same, "left")
        .withColumn(text_col, text)
        .where(F.col("_quirework_cut").isNull() | F.col(text_col).rlike(r"[^\x20\x09-\x0D]"))
        .select(*names)
    )
    if "n_chars" in names:
        changed = changed.withColumn("n_chars", F.length(text_col).cast(docs.schema["n_chars"].dataType))
    return docs.where(~touched).unionByName(changed)
