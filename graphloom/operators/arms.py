"""Classification of functions into arms, and dedup of bodies and identities.

Functions are rows (program, vkey, func_name, ord, ...): vkey names the variant's stream and ord is
the unique order of emission.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Names of local labels begin so.
LOCAL_LABEL = ".L"
#: Characters of a canonical suffix, its longest form, and where a longer one is cut; fixed values of the name format.
ALLOWED, LONGEST, CUT_AT = r"A-Za-z0-9_.:<>()*&", 200, 192


def drop_local_labels(functions: DataFrame) -> DataFrame:
    return functions.filter(~F.coalesce(F.col("func_name").startswith(LOCAL_LABEL), F.lit(False)))


def classify(functions: DataFrame) -> DataFrame:
    """functions with is_duplicated and arm.

    A name with two rows in one stream is duplicated and unmatched in all streams; one that is in two
    or more streams is matched; any other is unmatched. One shuffle, by (program, func_name).
    """
    name = W.partitionBy("program", "func_name")
    rows = functions.withColumn("__in_stream", F.count("*").over(W.partitionBy("program", "func_name", "vkey")))
    rows = rows.withColumn("is_duplicated", F.max("__in_stream").over(name) > 1)
    streams = F.size(F.collect_set("vkey").over(name))  # as many as variants
    return rows.withColumn("arm", F.when(~F.col("is_duplicated") & (streams > 1), "matched").otherwise("unmatched")).drop("__in_stream")


def reroute_identical(classified: DataFrame, body: str = "body") -> DataFrame:
    """A matched function whose variants all share one body is unmatched."""
    name = W.partitionBy("program", "func_name")
    same = F.min(body).over(name).eqNullSafe(F.max(body).over(name))
    return classified.withColumn("arm", F.when((F.col("arm") == "matched") & same, "unmatched").otherwise(F.col("arm")))


def body_key(*columns: str) -> Column:
    """Content hash of the arrays of a body."""
    return F.sha2(F.concat_ws("|", *[F.coalesce(F.to_json(F.struct(c)), F.lit("")) for c in columns]), 256)


def dedup_bodies(functions: DataFrame, body: str = "body") -> DataFrame:
    """One row per (program, arm, body): body_ord is the first emission, n_uses the rows that share it."""
    return functions.groupBy("program", "arm", body).agg(F.min("ord").alias("body_ord"), F.count("*").alias("n_uses"))


def semantic_dedup(rows: DataFrame, identity: list[str], body: str = "body", order: str = "ord") -> DataFrame:
    """Drops later rows whose body equals the first body of their identity; others stay, with slot 0, 1, ...

    A later row is compared with the first body only, so A, B, B keeps three rows. diverges marks a row
    whose body differs from the first. Null identity parts equal each other.
    """
    by = W.partitionBy(*identity).orderBy(order)
    marked = rows.withColumn("__first", F.first(body).over(by)).withColumn("__n", F.row_number().over(by))
    marked = marked.withColumn("diverges", ~F.col(body).eqNullSafe(F.col("__first")))
    return marked.filter((F.col("__n") == 1) | F.col("diverges")).withColumn("slot", F.row_number().over(by) - 1).drop("__first", "__n")


def occurrence(rows: DataFrame, stream: list[str], name: str = "func_name", order: str = "ord") -> DataFrame:
    """0-based number of a row among those of one stream and name, in order of emission."""
    return rows.withColumn("occurrence", (F.row_number().over(W.partitionBy(*stream, name).orderBy(order)) - 1).cast("int"))


def _suffix(text: Column) -> Column:
    clean = F.regexp_replace(F.regexp_replace(text, f"[^{ALLOWED}]+", "_"), "^_+|_+$", "")
    short = F.concat(F.substring(clean, 1, CUT_AT), F.lit("~"), F.substring(F.sha1(F.encode(text, "UTF-8")), 1, 7))
    return F.when(F.length(clean) > LONGEST, short).otherwise(clean)


def canonical_name(name: Column, comment: Column, thunk_key: Column) -> Column:
    """name@comment; else thunk_key:thunk; else name. Empty comments count as null."""
    comment = F.nullif(comment, F.lit(""))
    return F.when(comment.isNotNull(), F.concat(name, F.lit("@"), _suffix(comment))).when(
        thunk_key.isNotNull(), F.concat(_suffix(thunk_key), F.lit(":thunk"))).otherwise(name)


def compare_outputs(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows that one side has more often than the other, with side."""
    return left.exceptAll(right).withColumn("side", F.lit("left")).unionByName(right.exceptAll(left).withColumn("side", F.lit("right")))


def placeholder_names(rows: DataFrame, body: str = "body") -> DataFrame:
    """rows with name: 'unnamed @' and eight hex digits of the body's hash; bodies whose digits collide are numbered in order of emission."""
    digits = F.substring(F.sha2(F.col(body).cast("string"), 256), 1, 8)
    first = rows.groupBy("program", body).agg(F.min("ord").alias("__first")).withColumn("__d", digits)
    nth = F.row_number().over(W.partitionBy("program", "__d").orderBy("__first"))
    named = first.select("program", F.col(body).alias("__body"), F.concat(F.lit("unnamed @"), "__d", F.when(nth > 1, F.concat(F.lit("_"), nth.cast("string"))).otherwise("")).alias("name")).withColumnRenamed("program", "__program")
    return rows.join(named, (F.col("program") == F.col("__program")) & F.col(body).eqNullSafe(F.col("__body"))).drop("__program", "__body")
