"""Sections, registries, call targets and call entries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from graphloom.operators.order import numbered

LOCAL, PLT, EXTERN = 0, 1, 2
#: Written instead of a callee variant that is missing; fixed values of the format.
MISSING, UNRESOLVED = 0xFFFE, 0xFFFF
#: Parts of a kind of corruption that are sampled before the kind is.
SAMPLE_PARTS = 256


def names_registry(names: DataFrame) -> DataFrame:
    """(program, func_name, fid): 1-based line of each distinct name in sorted order."""
    return numbered(names.select("program", "func_name").distinct(), ["program"], ["func_name"], "fid").withColumn("fid", (F.col("fid") + 1).cast("int"))


def providers_registry(libraries: DataFrame) -> DataFrame:
    """(program, library, pid): 1-based, in the order of first encounter. libraries: program, library, ord."""
    first = libraries.filter("library is not null").groupBy("program", "library").agg(F.min("ord").alias("first_ord"))
    return first.withColumn("pid", F.row_number().over(W.partitionBy("program").orderBy("first_ord", "library")))


def sectioned_names(matched: DataFrame, unmatched: DataFrame) -> DataFrame:
    return matched.select("program", "func_name").unionByName(unmatched.select("program", "func_name")).distinct()


def typed_union(called: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct (callee, type) of all variants, by type and then first encounter; called_idx from 0.

    called: keys, variant, pos, callee, type.
    """
    first = called.groupBy(*keys, "callee", "type").agg(F.min(F.struct("variant", "pos")).alias("first"))
    order = W.partitionBy(*keys).orderBy("type", "first")
    return first.withColumn("called_idx", F.row_number().over(order) - 1).select(*keys, "callee", "type", "called_idx")


def merge_extern_libraries(libraries: DataFrame, keys: list[str]) -> DataFrame:
    """Library of each callee from the lowest variant, and whether variants disagree. libraries: keys, variant, callee, library."""
    return libraries.groupBy(*keys, "callee").agg(F.min_by("library", F.struct("variant", "library")).alias("library"), (F.countDistinct("library") > 1).alias("conflict"))


def group_unmatched(rows: DataFrame) -> DataFrame:
    """Variants of each (program, func_name, occurrence), in order of emission."""
    return rows.groupBy("program", "func_name", "occurrence").agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", "vkey"))), lambda x: x["vkey"]).alias("vkeys"))


def drop_ambiguous(called: DataFrame, keys: list[str]) -> DataFrame:
    """Callees with one occurrence only; those with conflicting ones go."""
    return called.groupBy(*keys, "callee").agg(F.min("occurrence").alias("occurrence"), F.countDistinct("occurrence").alias("__n")).filter("__n <= 1").drop("__n")


def call_targets(union: DataFrame, sections: DataFrame, keys: list[str]) -> DataFrame:
    """Targets with eff_type: local and linked callees without a section become external; ordered by (eff_type, called_idx).

    union: program, keys, callee, type, called_idx; sections: program, func_name, section_id.
    """
    known = sections.select("program", F.col("func_name").alias("callee"), F.col("section_id").alias("callee_section"))
    joined = union.join(known, ["program", "callee"], "left")
    demoted = F.when(F.col("type").isin(LOCAL, PLT) & F.col("callee_section").isNull(), EXTERN).otherwise(F.col("type"))
    by = W.partitionBy(*keys).orderBy("eff_type", "called_idx")
    return joined.withColumn("eff_type", demoted).withColumn("target_idx", F.row_number().over(by) - 1)


def call_entries(calls: DataFrame, variants: DataFrame) -> DataFrame:
    """Callee variant with the caller's vkey, as j; MISSING if there is none or the callee's name is duplicated.

    calls: section_id, variant_idx, vkey, called_idx, callee_section, callee_duplicated; callees without a
    section have no entry. variants: section_id, variant_idx, vkey.
    """
    target = variants.select(F.col("section_id").alias("callee_section"), "vkey", F.col("variant_idx").alias("__j"))
    joined = calls.filter("callee_section is not null").join(target, ["callee_section", "vkey"], "left")
    return joined.withColumn("j", F.when(F.col("callee_duplicated"), MISSING).otherwise(F.coalesce("__j", F.lit(MISSING)))).drop("__j")


def lookup_table(matched: DataFrame, unmatched: DataFrame) -> DataFrame:
    """(program, func_name, vkey) -> body; an unmatched row wins over a matched one."""
    rows = matched.withColumn("is_matched", F.lit(True)).unionByName(unmatched.withColumn("is_matched", F.lit(False)))
    best = F.max_by(F.struct("body", "is_matched"), F.struct(~F.col("is_matched"), F.col("body")))
    return rows.groupBy("program", "func_name", "vkey").agg(best.alias("b")).select("program", "func_name", "vkey", "b.body", "b.is_matched")


def usable(entries: DataFrame) -> DataFrame:
    """entries with own: j, or null where it is a sentinel."""
    return entries.withColumn("own", F.when(F.col("j").isin(MISSING, UNRESOLVED), None).otherwise(F.col("j")))


def resolve_variants(entries: DataFrame) -> DataFrame:
    """Edges with callee_variant: the own usable j, else that of the lowest variant of the section for the slot.

    entries: section_id, variant_idx, called_idx, callee_section, j. Slots without any usable j go; of
    repeated slots the least one of a node's entries stays.
    """
    slot = W.partitionBy("section_id", "called_idx")
    sibling = F.min(F.when(F.col("own").isNotNull(), F.struct("variant_idx", "own"))).over(slot)
    chosen = usable(entries).withColumn("callee_variant", F.coalesce("own", sibling["own"]))
    edges = chosen.filter("callee_variant is not null and callee_section is not null")
    return edges.groupBy("section_id", "variant_idx", "called_idx").agg(
        F.min(F.struct("callee_section", "callee_variant")).alias("e")).select("section_id", "variant_idx", "called_idx", "e.callee_section", "e.callee_variant")


def called_by(entries: DataFrame, selection: DataFrame) -> DataFrame:
    """Selected variants that call each slot. selection: section_id, variant_idx."""
    return entries.join(selection, ["section_id", "variant_idx"], "left_semi").groupBy("section_id", "called_idx").agg(F.array_sort(F.collect_set("variant_idx")).alias("variants"))


def narrow_vkeys(entries: DataFrame, selection: DataFrame, variants: DataFrame) -> DataFrame:
    """Distinct vkeys of the callees that selected variants reach."""
    reached = usable(entries).filter("own is not null").join(selection, ["section_id", "variant_idx"], "left_semi").select(
        "section_id", "called_idx", "callee_section", F.col("own").alias("callee_variant"))
    keyed = variants.select(F.col("section_id").alias("callee_section"), F.col("variant_idx").alias("callee_variant"), "vkey")
    return reached.join(keyed, ["callee_section", "callee_variant"]).select("section_id", "called_idx", "callee_section", "vkey").distinct()


def order_variants(variants: DataFrame) -> DataFrame:
    """variant_idx from 0 within a section, by variant_ref."""
    return variants.withColumn("variant_idx", F.row_number().over(W.partitionBy("section_id").orderBy("variant_ref")) - 1)


def resolve_refs(rows: DataFrame, variants: DataFrame) -> DataFrame:
    """Variant identity of each row's variant_ref; missing ones stay, with nulls."""
    return rows.join(variants, "variant_ref", "left")


def corruption(entries: DataFrame, variants: DataFrame, sizes: DataFrame) -> DataFrame:
    """Entries whose j is out of range or whose callee has another vkey than the caller, with kind.

    entries as for resolve_variants; variants: section_id, variant_idx, vkey; sizes: section_id, n_variants.
    """
    mine = variants.select("section_id", "variant_idx", F.col("vkey").alias("own_vkey"))
    theirs = variants.select(F.col("section_id").alias("callee_section"), F.col("variant_idx").alias("own"), F.col("vkey").alias("callee_vkey"))
    counted = sizes.select(F.col("section_id").alias("callee_section"), "n_variants")
    rows = usable(entries).filter("own is not null").join(counted, "callee_section", "left").join(mine, ["section_id", "variant_idx"], "left").join(theirs, ["callee_section", "own"], "left")
    kind = F.when(F.col("n_variants").isNull() | (F.col("own") >= F.col("n_variants")), "out_of_range").when(F.col("own_vkey") != F.col("callee_vkey"), "vkey_mismatch")
    return rows.withColumn("kind", kind).filter("kind is not null").select("section_id", "variant_idx", "called_idx", "callee_section", F.col("own").alias("j"), "kind")


def corruption_report(found: DataFrame, samples: int = 10) -> DataFrame:
    """Count of each kind and its first samples: the first of each of many parts of a kind, and of those the first."""
    order = ["section_id", "variant_idx", "called_idx"]
    parted = found.withColumn("__part", F.pmod(F.xxhash64(*order), F.lit(SAMPLE_PARTS)))
    some = parted.withColumn("__n", F.row_number().over(W.partitionBy("kind", "__part").orderBy(*order))).filter(F.col("__n") <= samples)
    few = some.withColumn("__n", F.row_number().over(W.partitionBy("kind").orderBy(*order))).filter(F.col("__n") <= samples)
    at = few.groupBy("kind").agg(F.array_sort(F.collect_list(F.struct(*order))).alias("samples"))
    return found.groupBy("kind").agg(F.count("*").alias("n")).join(at, "kind")


def address_lookup(addresses: DataFrame, ranges: DataFrame, width: int = 4096) -> DataFrame:
    """addresses (program, addr, ...) with the ranges (program, start, end, ...) that hold them, end exclusive.

    Both sides are cut into bins of `width`, so this is an equi-join on (program, bin) with a filter. A
    range costs one row for each bin that it touches; choose a width near the usual length.
    """
    cut = ranges.filter("`end` > start").withColumn("__bin", F.explode(F.sequence(F.floor(F.col("start") / width), F.floor((F.col("end") - 1) / width))))
    return addresses.withColumn("__bin", F.floor(F.col("addr") / width)).join(cut, ["program", "__bin"]).filter((F.col("addr") >= F.col("start")) & (F.col("addr") < F.col("end"))).drop("__bin")
