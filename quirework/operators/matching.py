"""Joins, set operations and drift checks between two versions of a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def overlay(base: DataFrame, newer: DataFrame, key: str, value: str) -> DataFrame:
    """``base`` with ``value`` from ``newer`` where it has one, and whether that changed it."""
    other = newer.select(key, F.col(value).alias("_new"))
    joined = base.join(other, key, "left")
    return joined.withColumn("changed", F.col("_new").isNotNull() & ~F.col("_new").eqNullSafe(F.col(value))).withColumn(
        value, F.coalesce("_new", value)
    ).drop("_new")


def id_difference(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """(side, id): ids that only one of the two has."""
    a, b = (x.select(key).distinct() for x in (left, right))
    only = lambda x, y, side: x.join(y, key, "left_anti").select(F.lit(side).alias("side"), F.col(key))
    return only(a, b, "left").unionByName(only(b, a, "right"))


def multiset_match(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Per key: rows of either side, how many of the left find a partner when each right row is used once, and the rest.

    Counts stand for the pairs, so a key with many rows on both sides gives one row, not their product.
    """
    a, b = (x.groupBy(key).agg(F.count("*").alias(n)) for x, n in ((left, "n_left"), (right, "n_right")))
    both = a.join(b, key, "full").na.fill(0, ["n_left", "n_right"])
    matched = F.least("n_left", "n_right")
    return both.select(key, "n_left", "n_right", matched.alias("matched"), (F.col("n_left") - matched).alias("unmatched"))


def duplicates(rows: DataFrame, *keys: str | Column) -> DataFrame:
    """Keys that stand in more than one row, with their number ``n``."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def coverage(whole: DataFrame, part: DataFrame, key: str, group: str) -> DataFrame:
    """Per group: ids of ``whole``, how many of them ``part`` has, and the share."""
    have = part.select(key).distinct().withColumn("_has", F.lit(1))
    joined = whole.select(key, group).distinct().join(have, key, "left")
    return joined.groupBy(group).agg(F.count("*").alias("total"), F.count("_has").alias("covered")).withColumn("share", F.col("covered") / F.col("total"))


def field_drift(left: DataFrame, right: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(key, field, expected, actual) of every field that differs between the rows of a key; null equals null."""
    a, b = (x.select(key, *(F.col(f).cast("string").alias(f"_{side}_{f}") for f in fields)) for x, side in ((left, "l"), (right, "r")))
    each = F.array(*(F.struct(F.lit(f).alias("field"), F.col(f"_l_{f}").alias("expected"), F.col(f"_r_{f}").alias("actual")) for f in fields))
    moved = F.filter(each, lambda x: ~x["expected"].eqNullSafe(x["actual"]))
    return a.join(b, key).select(key, F.explode(moved).alias("d")).select(key, "d.*")


def dangling(rows: DataFrame, ref: str, known: DataFrame, key: str) -> DataFrame:
    """Rows whose reference is missing or names no known id."""
    return rows.join(known.select(F.col(key).alias(ref)).distinct(), ref, "left_anti")


def to_do(selected: DataFrame, done: DataFrame, key: str, force: bool = False) -> DataFrame:
    """Rows that still need work: all of them when forced."""
    return selected if force else selected.join(done.select(key).distinct(), key, "left_anti")


def upsert_map(col: Column, key: Column, value: Column) -> Column:
    """A map with ``key`` set; an old entry of that key is taken out first."""
    return F.map_concat(F.map_filter(col, lambda k, _: k != key), F.create_map(key, value))


def synced(before: DataFrame, after: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Ids whose fields a sync would change: its dry run."""
    return field_drift(before, after, key, fields).select(key).distinct()
