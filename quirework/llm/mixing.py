"""Mixing sources to target weights by Pareto order sampling.

Each source gets a target in words. A document's expected number of copies grows with a power of its size; the whole
part is certain, the fraction is its inclusion probability p in a sample without replacement. The sample ranks the
documents of a source by (u / (1 - u)) / (p / (1 - p)), u uniform by hash of the id, and goes down that order: a document
that fits into the words left to the target is taken, one that does not is passed over, until none fits.

Defined results: null text has size 0 and is never taken; a null source is a source of its own, ordered last; repeated
rows are documents of their own; documents of equal rank are taken in order of id, size and row; a text of any length is
one document; an empty table gives an empty result; sources of size 0 get target 0. Columns of the input besides id, text
and source are ignored.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quirework.llm.shared import stage, word_count


def targets(totals: DataFrame, weights: tuple[float, ...], cap: float) -> DataFrame:
    """Target words of each source; ``totals`` has one row a source: source, source_size.

    Sources in code point order, null last, take the weights in turn and share the whole. A target stops at ``cap``
    times its source's size and the excess is reshared by weight, which is the same as raising one level L until the
    targets min(cap * size, L * weight) sum to the whole.
    """
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*(F.lit(float(x)) for x in weights)), (turn % len(weights) + 1).cast("int"))
    by_limit = Window.orderBy(F.col("limit_at"), F.col("source").asc_nulls_last())
    upto = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_limit.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy()
    level = (F.sum("source_size").over(whole) - cap * F.coalesce(F.sum("source_size").over(upto), F.lit(0))) / F.sum(
        "weight"
    ).over(onward)
    return (
        totals.withColumn("weight", weight)
        .withColumn("limit_at", cap * F.col("source_size") / F.col("weight"))
        .withColumn("at", F.row_number().over(by_limit))
        .withColumn("level", level)
        .withColumn("open_at", F.min(F.when(F.col("level") <= F.col("limit_at"), F.col("at"))).over(whole))
        .withColumn("final", F.max(F.when(F.col("at") == F.col("open_at"), F.col("level"))).over(whole))
        .select(
            "source",
            "source_size",
            F.when(F.col("at") < F.col("open_at"), cap * F.col("source_size"))
            .otherwise(F.least(F.col("weight") * F.col("final"), cap * F.col("source_size")))
            .cast("double")
            .alias("target"),
        )
    )


def _copy_rates(sizes: DataFrame, power: float, cap: float) -> DataFrame:
    """The factor c of each source for which min(cap, c * size ** power) copies of every document give its target.

    ``sizes``: source, size, n, target. Larger documents reach the cap first, so the first size in falling order
    whose factor leaves it below the cap settles c.
    """
    falling = Window.partitionBy("source").orderBy(F.desc("size"))
    above = F.coalesce(
        F.sum(F.col("n") * F.col("size")).over(falling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    rest = F.sum(F.col("n") * F.pow("size", F.lit(1 + power))).over(
        falling.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    )
    return (
        sizes.withColumn("c", (F.col("target") - cap * above) / rest)
        .where(F.col("c") * F.pow("size", F.lit(power)) <= cap)
        .groupBy("source")
        .agg(F.max_by("c", "size").alias("rate"))
    )


def pareto_mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[float, ...] = (1, 2, 3),
    max_copies: int = 3,
    size_power: float = 0.25,
    cells: int = 1 << 16,
    seed: int = 20011,
) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken.

    ``cells`` is the number of ranges of the Pareto rank for which words are summed per source; only documents of the
    range in which the room of a source ends are ordered one by one, so no source is gathered in one task. Each round
    goes on to the next document that does not fit, with those behind it that are small enough for the room then left.
    """
    same: Column = F.col("d.source").eqNullSafe(F.col("s.source"))
    sized = stage(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.col(source_col).alias("source"),
            word_count(F.col(text_col)).alias("size"),
            F.xxhash64(F.col(id_col).cast("string"), F.lit(seed)).alias("draw"),
            F.monotonically_increasing_id().alias("at_row"),
        ),
        "mix-sizes",
    )
    by_size = sized.groupBy("source", "size").agg(F.count("*").alias("n"))
    totals = by_size.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"))
    goals = stage(targets(totals, tuple(weights), float(max_copies)), "mix-targets")
    with_goal = by_size.where("size > 0").alias("d").join(goals.alias("s"), same).select("d.*", "s.target")
    rates = _copy_rates(with_goal, size_power, float(max_copies))
    plan = stage(
        goals.alias("d").join(rates.alias("s"), same, "left").select("d.*", F.coalesce("s.rate", F.lit(max_copies * 1.0)).alias("rate")),
        "mix-rates",
    )
    copies = F.least(F.lit(float(max_copies)), F.col("rate") * F.pow("size", F.lit(size_power)))
    uniform = (F.shiftrightunsigned(F.col("draw"), 11) + 0.5) / F.lit(float(1 << 53))
    odds = (F.col("u") / (1 - F.col("u"))) / (F.col("p") / (1 - F.col("p")))
    drawn = (
        sized.alias("d")
        .join(plan.alias("s"), same)
        .select("d.doc_id", "d.source", "d.size", "d.at_row", "s.source_size", "s.target", copies.alias("m"), uniform.alias("u"), F.xxhash64("d.source").alias("key"))
        .withColumn("whole", F.when(F.col("size") > 0, F.floor(F.col("m") + 1e-9)).otherwise(0))
        .withColumn("p", F.when(F.col("size") > 0, F.greatest(F.col("m") - F.col("whole"), F.lit(0.0))).otherwise(0.0))
        .withColumn("q", F.when(F.col("p") > 1e-9, odds))
        .withColumn("cell", F.floor(F.col("q") / (1 + F.col("q")) * cells))
    )
    certain = drawn.groupBy("source", "target").agg(F.sum(F.col("whole") * F.col("size")).alias("certain"))
    room = certain.select("source", (F.col("target") - F.col("certain")).alias("room"))
    place = F.struct("d.q", "d.doc_id", "d.size", "d.at_row").alias("place")
    left = stage(
        drawn.where(F.col("q").isNotNull()).alias("d").join(stage(room, "mix-room").alias("s"), same & (F.col("d.size") <= F.col("s.room"))).select("d.source", "d.size", "d.cell", place, "s.room"),
        "mix-left",
    )
    since = left.select("source", F.col("place").alias("since")).limit(0)  # where each source's round begins
    rounds = []
    while not left.isEmpty():
        running = Window.partitionBy("source").orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
        edges = stage(
            left.groupBy("source", "room", "cell")
            .agg(F.sum("size").alias("words"))
            .withColumn("upto", F.sum("words").over(running))
            .groupBy("source", "room")
            .agg(
                F.min(F.when(F.col("upto") > F.col("room"), F.col("cell"))).alias("edge"),
                F.coalesce(F.max(F.when(F.col("upto") <= F.col("room"), F.col("upto"))), F.lit(0)).alias("before"),
            ),
            "mix-edges",
        )
        inner = Window.partitionBy("source").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
        at_edge = (
            left.alias("d")
            .join(edges.alias("s"), same & (F.col("d.cell") == F.col("s.edge")))
            .select("d.source", "d.size", "d.place", "s.room", "s.before")
            .withColumn("upto", F.col("before") + F.sum("size").over(inner))
        )
        # the first document that does not fit, and the room left before it
        stops = stage(
            at_edge.groupBy("source").agg(
                F.min(F.when(F.col("upto") > F.col("room"), F.col("place"))).alias("stop"),
                (F.max("room") - F.coalesce(F.max(F.when(F.col("upto") <= F.col("room"), F.col("upto"))), F.max("before"))).alias("room"),
            ),
            "mix-stops",
        )
        done = edges.alias("d").join(stops.alias("s"), same, "left").select("d.source", "d.room", "s.stop")
        done = done.alias("d").join(since.alias("s"), same, "left").select("d.source", F.struct("d.room", "s.since", "d.stop").alias("round"))
        rounds.append(stage(done, "mix-round"))
        since = stops.select("source", F.col("stop").alias("since"))
        behind = (F.col("d.place") > F.col("s.stop")) & (F.col("d.size") <= F.col("s.room"))
        left = stage(left.alias("d").join(stops.alias("s"), same & behind).select("d.source", "d.size", "d.cell", "d.place", "s.room"), "mix-left")
    drawn = drawn.alias("d")
    if not rounds:
        extra = F.lit(0)
    else:
        took = functools.reduce(DataFrame.unionByName, rounds).groupBy("source").agg(F.collect_list("round").alias("rounds"))
        drawn = drawn.join(stage(took, "mix-took").alias("s"), same, "left")
        fits = F.exists(
            "s.rounds",
            lambda r: (F.col("d.size") <= r["room"])
            & (r["since"].isNull() | (F.struct("d.q", "d.doc_id", "d.size", "d.at_row") > r["since"]))
            & (r["stop"].isNull() | (F.struct("d.q", "d.doc_id", "d.size", "d.at_row") < r["stop"])),
        )
        extra = F.when(F.col("d.q").isNotNull() & fits, 1).otherwise(0)
    return drawn.withColumn("copies", (F.col("d.whole") + extra).cast("long")).select(
        "d.doc_id", "d.source", "d.size", "d.source_size", "d.target", "copies", (F.col("copies") * F.col("d.size")).alias("taken")
    )
