"""Numbering and running sums over whole tables, without a task that holds them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from graphloom.plans.materialize import materialized


def running(rows: DataFrame, keys: list[str], order: list[str | Column], values: dict[str, Column]) -> DataFrame:
    """rows with, for each name of values, the sum of that value over the key's rows before this one.

    Rows are dealt out by range of (keys, order), so that a key of any size spreads over tasks; what a part starts with
    is the sum of the key's parts before it. Only keys that cross from one part to the next need that, at most two a
    part, so that table is broadcast. The order has to be total, nulls of keys are a key.
    """
    plain = [F.col(o) if isinstance(o, str) else o for o in order]
    dealt = rows.repartitionByRange(*[F.col(k) for k in keys], *plain).select("*", F.spark_partition_id().alias("__part"), *[F.coalesce(v, F.lit(0)).cast("long").alias(f"__v{i}") for i, v in enumerate(values.values())])
    dealt = materialized(dealt)
    by = W.partitionBy("__part", *keys).orderBy(*plain).rowsBetween(W.unboundedPreceding, -1)
    sums = dealt.groupBy("__part", *keys).agg(*[F.sum(f"__v{i}").alias(f"__s{i}") for i in range(len(values))])
    ends = sums.groupBy("__part").agg(F.min(F.struct(*keys)).alias("low"), F.max(F.struct(*keys)).alias("high")) if keys else None
    if keys:
        edge = sums.join(F.broadcast(ends), "__part").filter(F.struct(*keys).eqNullSafe(F.col("low")) | F.struct(*keys).eqNullSafe(F.col("high"))).drop("low", "high")
    else:
        edge = sums
    over = W.partitionBy(*keys).orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    before = edge.select(F.col("__part").alias("__p"), *[F.col(k).alias(f"__k_{k}") for k in keys], *[F.coalesce(F.sum(f"__s{i}").over(over), F.lit(0)).alias(f"__b{i}") for i in range(len(values))])
    own = dealt.select(*rows.columns, "__part", *[F.coalesce(F.sum(f"__v{i}").over(by), F.lit(0)).alias(f"__o{i}") for i in range(len(values))])
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in keys], F.col("__part") == F.col("__p"))
    met = own.join(F.broadcast(before), on, "left")
    return met.select(*rows.columns, *[(F.col(f"__o{i}") + F.coalesce(f"__b{i}", F.lit(0))).alias(name) for i, name in enumerate(values)])


def numbered(rows: DataFrame, keys: list[str], order: list[str | Column], name: str) -> DataFrame:
    """rows with a number from 0 within each key, in order."""
    return running(rows, keys, order, {name: F.lit(1)})
