"""Constants of instructions against the address ranges of their program."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.functions import constants as rules
from graphloom.operators.catalog import address_lookup

KNOWN = ["kind", "is_vtable", "tls", "base", "offset", "target_rule", "target"]


def classified(constants: DataFrame, ranges: DataFrame) -> DataFrame:
    """constants with rule (the first that holds) and emitted, the tokens that it makes.

    constants: program, value, is_arithmetic, fp_type, fp_postfix and further columns. ranges: program, start, end
    (exclusive), and columns of KNOWN; of several that hold a value, the shortest counts, then the first. Each distinct address
    is looked up once; arithmetic values and those outside of all ranges are looked up in vain or not at all.
    """
    wanted = constants.filter("not coalesce(is_arithmetic, false)").select("program", F.col("value").alias("addr")).distinct()
    known = [c for c in KNOWN if c in ranges.columns]
    met = address_lookup(wanted, ranges.select("program", "start", "end", *known))
    of = met.groupBy("program", F.col("addr").alias("value")).agg(F.min(F.struct((F.col("end") - F.col("start")).alias("n"), "start", *known)).alias("of"))
    rows = constants.join(of, ["program", "value"], "left")
    none = {c: "boolean" if c in ("is_vtable", "tls") else "string" if c in ("kind", "target_rule") else "bigint" for c in KNOWN}
    fields = [F.col(f"of.{c}").alias(c) if c in known else F.lit(None).cast(none[c]).alias(c) for c in KNOWN]
    c = F.struct("value", "is_arithmetic", "fp_type", "fp_postfix", F.col("of.start").alias("start"), *fields)
    ruled = rows.withColumn("__c", c).withColumn("rule", rules.first_match(rules.rules(F.col("__c"))))
    return ruled.withColumn("emitted", rules.emitted(F.col("__c"), F.col("rule"))).drop("__c", "of")
