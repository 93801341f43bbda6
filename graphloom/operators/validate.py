"""Validation of outputs against sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def compare_sources(output: DataFrame, source: DataFrame, keys: list[str], body: str = "body") -> DataFrame:
    """Rows that one side lacks or whose bodies differ, with kind."""
    a = output.select(*keys, F.col(body).alias("__out"), F.lit(True).alias("__in_out"))
    b = source.select(*keys, F.col(body).alias("__src"), F.lit(True).alias("__in_src"))
    kind = F.when(F.col("__in_out").isNull(), "source_only").when(F.col("__in_src").isNull(), "output_only").when(~F.col("__out").eqNullSafe(F.col("__src")), "differs")
    return a.join(b, keys, "full_outer").withColumn("kind", kind).filter("kind is not null").select(*keys, "kind")


def mismatch_positions(left: Column, right: Column) -> Column:
    """(position, left, right) where two arrays differ, also behind the end of the shorter one."""
    zipped = F.zip_with(left, right, lambda x, y: F.struct(x.alias("left"), y.alias("right")))
    marked = F.transform(zipped, lambda p, i: F.struct(i.alias("position"), p["left"].alias("left"), p["right"].alias("right")))
    return F.filter(marked, lambda p: ~p["left"].eqNullSafe(p["right"]))


def progress(listed: DataFrame, present: DataFrame, key: str) -> DataFrame:
    """How many listed paths are present, and their share."""
    joined = listed.select(key).distinct().join(present.select(key, F.lit(1).alias("__p")).distinct(), key, "left")
    return joined.agg(F.count("*").alias("n_listed"), F.count("__p").alias("n_present")).withColumn("share", F.col("n_present") / F.col("n_listed"))


def pair_consistency(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys that only one of two sidecars has."""
    a, b = left.select(key, F.lit("left").alias("l")).distinct(), right.select(key, F.lit("right").alias("r")).distinct()
    return a.join(b, key, "full_outer").filter("l is null or r is null").select(key, F.coalesce("l", "r").alias("only_in"))


def missing_outputs(wanted: DataFrame, done: DataFrame, key: str, kinds: int) -> DataFrame:
    """Inputs whose outputs aren't complete. done: key, kind; complete is `kinds` distinct kinds."""
    complete = done.groupBy(key).agg(F.countDistinct("kind").alias("n")).filter(F.col("n") >= kinds)
    return wanted.join(complete.select(key), key, "left_anti")


def require_members(members: DataFrame, indexes: DataFrame, key: str, skip: bool) -> DataFrame:
    """Members that have an index; with skip=False a missing one is an error."""
    joined = members.join(indexes.select(key, F.lit(True).alias("__has")).distinct(), key, "left")
    if skip:
        return joined.filter("__has").drop("__has")
    return joined.filter(F.when(F.col("__has").isNull(), F.raise_error(F.concat(F.lit("no index for "), F.col(key).cast("string"))).cast("boolean")).otherwise(True)).drop("__has")
