"""Vocabulary unification and counting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from graphloom.plans.materialize import materialized

#: Ids below are the same in every vocabulary; fixed values of the format.
RESERVED, LEGACY_RESERVED, FIRST_FREE, MOST_IDS = 257, 256, 272, 65535
#: Tokens of a row that are put in order at a time.
PIECE = 10_000


def definition_tokens(cell: Column) -> Column:
    """Tokens of a vocabulary-definition cell; an empty cell has none."""
    return F.when(F.coalesce(F.length(cell), F.lit(0)) == 0, F.array().cast("array<string>")).otherwise(F.split(cell, ","))


def vocab_count(cell: Column) -> Column:
    """Number of serialized tokens; null, not 0, for a missing cell."""
    return F.when(cell.isNull(), None).otherwise(F.size(definition_tokens(cell)))


def load(definitions: DataFrame, reserved: int = RESERVED) -> DataFrame:
    """(binary, local_id, token) of definitions (binary, cell)."""
    return definitions.select("binary", F.posexplode(definition_tokens(F.col("cell"))).alias("pos", "token")).select("binary", (F.col("pos") + reserved).alias("local_id"), "token")


def unify(local: DataFrame, axes: DataFrame | None = None) -> DataFrame:
    """(token, unified_id): first seen in order of (file_ord, local_id) from FIRST_FREE, then axis tokens by (axis_ord, token).

    local: file_ord, local_id, token. axes: axis_ord, token. One row per distinct token is numbered; their
    number has a ceiling of 65535, so the numbering is small whatever the corpus.
    """
    first = local.groupBy("token").agg(F.min(F.struct("file_ord", "local_id")).alias("first")).select("token", F.lit(0).alias("tail"), F.struct("first.file_ord", "first.local_id", F.lit("").alias("t")).alias("o"))
    if axes is not None:
        tail = axes.groupBy("token").agg(F.min("axis_ord").alias("a")).join(first.select("token"), "token", "left_anti")
        first = first.unionByName(tail.select("token", F.lit(1).alias("tail"), F.struct(F.col("a").cast(local.schema["file_ord"].dataType).alias("file_ord"), F.lit(0).cast(local.schema["local_id"].dataType).alias("local_id"), F.col("token").alias("t")).alias("o")))
    return first.select("token", (F.row_number().over(W.partitionBy(F.lit(0)).orderBy("tail", "o")) + FIRST_FREE - 1).alias("unified_id"))


def mapping(local: DataFrame, unified: DataFrame, reserved: int = RESERVED) -> DataFrame:
    """(binary, local_id, unified_id): -1 where a token is unknown; reserved ids keep theirs."""
    joined = local.join(unified, "token", "left")
    kept = F.when(F.col("local_id") < reserved, F.col("local_id")).otherwise(F.coalesce("unified_id", F.lit(-1)))
    return joined.select("binary", "local_id", kept.alias("unified_id"))


def complete_files(mapped: DataFrame) -> DataFrame:
    """Files all of whose ids are mapped."""
    return mapped.groupBy("binary").agg(F.count_if(F.col("unified_id") < 0).alias("n_missing"), F.count("*").alias("n_ids")).withColumn("is_complete", F.col("n_missing") == 0)


def check_ceiling(unified: DataFrame) -> DataFrame:
    """One row: the number of ids, an error if they exceed 65535."""
    n = (F.count("*") + FIRST_FREE).alias("n_ids")
    out = unified.agg(n)
    return out.withColumn("n_ids", F.when(F.col("n_ids") > MOST_IDS, F.raise_error(F.lit("vocabulary exceeds 65535 ids")).cast("bigint")).otherwise(F.col("n_ids")))


def remap_tokens(rows: DataFrame, mapped: DataFrame, keys: list[str], tokens: str = "tokens") -> DataFrame:
    """tokens as unified ids, -1 where an id has none; rows of files without a mapping are left out.

    Tokens and mapping meet by (binary, local_id), so work is linear in both, and each row's tokens are put back in order
    from pieces of PIECE. A file that maps an id twice is an error.
    """
    held = materialized(rows.join(mapped.select("binary").distinct(), "binary", "left_semi").withColumn("__row", F.monotonically_increasing_id()))
    cells = held.select("__row", "binary", F.posexplode(tokens).alias("__pos", "local_id"))
    twice = F.raise_error(F.lit("an id is mapped twice")).cast(mapped.schema["unified_id"].dataType)
    once = mapped.groupBy("binary", "local_id").agg(F.when(F.count("*") > 1, twice).otherwise(F.first("unified_id")).alias("__id"))
    found = cells.join(once, ["binary", "local_id"], "left").select("__row", F.floor(F.col("__pos") / PIECE).alias("__piece"), F.struct("__pos", F.coalesce("__id", F.lit(-1)).alias("__id")).alias("__c"))
    pieces = found.groupBy("__row", "__piece").agg(F.sort_array(F.collect_list("__c"))["__id"].alias("__ids"))
    whole = pieces.groupBy("__row").agg(F.flatten(F.sort_array(F.collect_list(F.struct("__piece", "__ids")))["__ids"]).alias("__t"))
    none = F.when(F.col(tokens).isNotNull(), F.array().cast(whole.schema["__t"].dataType))
    return held.join(whole, "__row", "left").select(*keys, F.coalesce("__t", none).alias("tokens"))


def frequency_vocab(tokens: DataFrame, max_size: int, min_freq: int) -> DataFrame:
    """(token, id, n): most common first, ties by token, from id 2; ids 0 and 1 are the pad and the unknown token."""
    counts = tokens.groupBy("token").agg(F.count("*").alias("n")).filter(F.col("n") >= min_freq).orderBy(F.desc("n"), "token").limit(max_size - 2)
    own = counts.withColumn("id", F.row_number().over(W.partitionBy(F.lit(0)).orderBy(F.desc("n"), "token")) + 1)
    specials = tokens.sparkSession.createDataFrame([("<pad>", 0, 0), ("<unk>", 1, 0)], "token string, id int, n bigint")
    return own.select("token", "id", "n").unionByName(specials)


def inventory(axes: DataFrame) -> DataFrame:
    """Distinct axis tokens in axis-grouped order, with their place."""
    rows = axes.select("axis_ord", "token").distinct()
    return rows.withColumn("place", F.row_number().over(W.partitionBy(F.lit(0)).orderBy("axis_ord", "token")) - 1)


def valid_definitions(rows: DataFrame) -> DataFrame:
    """Definition rows (cell, types array) that have a cell and as many types as tokens."""
    n = F.size(definition_tokens(F.col("cell")))
    return rows.withColumn("is_valid", F.col("cell").isNotNull() & F.coalesce(n == F.size("types"), F.lit(False)))


def frequency_remap(uses: DataFrame, keys: list[str], token: str = "token") -> DataFrame:
    """(keys, token, rank): ids renumbered from 0 by falling use within keys, ties by the old id."""
    counts = uses.groupBy(*keys, token).agg(F.count("*").alias("n"))
    by = W.partitionBy(*keys).orderBy(F.desc("n"), token)
    return counts.withColumn("rank", F.row_number().over(by) - 1)


def saved_rows(vocabulary: DataFrame, types: DataFrame) -> DataFrame:
    """(binary, cell, types, runs) of a vocabulary row: tokens behind the reserved ids in order, and their types as runs.

    vocabulary: binary, local_id, token. types: token, type_id. A vocabulary has at most 65535 ids, so each is one row.
    """
    own = vocabulary.filter(F.col("local_id") >= RESERVED).join(types, "token", "left").withColumn("type_id", F.coalesce("type_id", F.lit(-1)))
    by = W.partitionBy("binary").orderBy("local_id")
    island = F.row_number().over(by) - F.row_number().over(W.partitionBy("binary", "type_id").orderBy("local_id"))
    runs = own.withColumn("__g", island).groupBy("binary", "type_id", "__g").agg(F.min("local_id").alias("at"), F.count("*").alias("n"))
    run = runs.groupBy("binary").agg(F.array_sort(F.collect_list(F.struct("at", "type_id", "n"))).alias("r"))
    cells = own.groupBy("binary").agg(F.array_sort(F.collect_list(F.struct("local_id", "token"))).alias("t"))
    return cells.join(run, "binary").select("binary", F.array_join(F.transform("t", lambda x: x["token"]), ",").alias("cell"), F.transform("r", lambda x: x["type_id"]).alias("types"), F.transform("r", lambda x: x["n"]).alias("runs"))


def ids_of(tokens: DataFrame, unified: DataFrame, token: str = "token") -> DataFrame:
    """tokens with unified_id; an unknown token is an error."""
    missing = F.raise_error(F.concat(F.lit("unknown token "), F.coalesce(F.col(token), F.lit("null")))).cast("int")
    return tokens.join(unified.withColumnRenamed("token", token), token, "left").withColumn("unified_id", F.coalesce("unified_id", missing))


def tokens_of(ids: DataFrame, unified: DataFrame) -> DataFrame:
    """ids with token; an id without one has null."""
    return ids.join(unified, "unified_id", "left")


def encode_records(records: DataFrame, unified: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, ids): ids of each record's axis tokens, in order; an unknown token is an error. records: keys, tokens (array, a few)."""
    rows = records.select(*keys, F.posexplode("tokens").alias("pos", "token"))
    return ids_of(rows, unified).groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "unified_id"))), lambda x: x["unified_id"]).alias("ids"))


def decode_records(records: DataFrame, unified: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, tokens): the inverse of encode_records; an unknown id is an error."""
    rows = tokens_of(records.select(*keys, F.posexplode("ids").alias("pos", "unified_id")), unified)
    known = F.coalesce("token", F.raise_error(F.lit("unknown id")).cast("string"))
    return rows.withColumn("token", known).groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "token"))), lambda x: x["token"]).alias("tokens"))


def cross_check(records: DataFrame, sources: DataFrame, unified: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, kind) of records whose tokens aren't those of the source, and of those that one side lacks."""
    a = decode_records(records, unified, keys).select(*keys, F.col("tokens").alias("__a"))
    b = sources.select(*keys, F.col("tokens").alias("__b"))
    kind = F.when(F.col("__a").isNull(), "source_only").when(F.col("__b").isNull(), "record_only").when(F.col("__a") != F.col("__b"), "differs")
    return a.join(b, keys, "full_outer").withColumn("kind", kind).filter("kind is not null").select(*keys, "kind")


def gate_version(header: DataFrame, version: int, fingerprint: str) -> DataFrame:
    """header (version, fingerprint), an error where one of them isn't as expected or is missing."""
    good = F.coalesce((F.col("version") == version) & (F.col("fingerprint") == fingerprint), F.lit(False))
    return header.filter(F.when(good, F.lit(True)).otherwise(F.raise_error(F.lit("vocabulary of another version")).cast("boolean")))


def readable_axes(names: DataFrame, parsed: Column) -> tuple[DataFrame, DataFrame]:
    """Rows whose axes could be read, as axes, and the others as warnings. parsed: a struct with comp, null where unreadable."""
    rows = names.withColumn("axes", parsed)
    return rows.filter("axes.comp is not null"), rows.filter("axes.comp is null").drop("axes").withColumn("warning", F.lit("axes are not readable"))
