"""Steps that the set-similarity joins share: prefixes in order of rarity, and the filters on length and position."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quirework.llm.shared import id_mask, stage


def rare_prefixes(sets: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """(token, node, size, at): the tokens that other sets hold too within each set's prefix, with their place.

    ``sets``: node, piece (an array of some of the node's distinct tokens); ``sizes``: node, size. The order is
    (number of sets that hold the token, token). Tokens of one set only come first, so they take places but no row.
    """
    token = sets.select("node", F.explode("piece").alias("token"))
    several = stage(token.groupBy("token").agg(F.count("*").alias("n")).where("n > 1"), "several")
    listed = id_mask(several, "token", several.count())
    shared = token.where(listed(F.col("token"))).join(several, "token")
    each = Window.partitionBy("node")
    placed = shared.withColumn("rank", F.row_number().over(each.orderBy("n", "token"))).withColumn("shared", F.count("*").over(each))
    least = F.ceil(F.col("size") * percent / 100)
    return (
        placed.join(sizes, "node")
        .withColumn("at", F.col("size") - F.col("shared") + F.col("rank") - 1)
        .where(F.col("at") <= F.col("size") - least)
        .select("token", "node", "size", "at")
    )


def close(size_a: Column, size_b: Column, percent: int) -> Column:
    """Length filter: sets further apart in size cannot be similar."""
    return 100 * F.least(size_a, size_b) >= percent * F.greatest(size_a, size_b)


def first_in_common(size_a: Column, at_a: Column, size_b: Column, at_b: Column, percent: int) -> Column:
    """Position filter: whether a similar pair can have its first common token at these places."""
    return (100 + percent) * F.least(size_a - at_a, size_b - at_b) >= percent * (size_a + size_b)


def enough(shared: Column, size_a: Column, size_b: Column, percent: int) -> Column:
    """Whether an overlap makes two sets similar."""
    return 100 * shared >= percent * (size_a + size_b - shared)
