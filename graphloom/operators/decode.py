"""Decoding of token streams: units, expansion, geometry, cutoff, padding and row assembly.

Raw ids: 0-255 digits, 256 sign, 257 integer, 258-263 floats, 264-271 identities, from 272 instructions.
Decoded ids are raw ids less 256.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from graphloom.operators.order import numbered
from graphloom.operators.sampling import draw

# Bands of raw ids; fixed values of the token format.
SIGN, INTEGER, FLOAT128, FIRST_IDENTITY, FIRST_INSTRUCTION = 256, 257, 263, 264, 272
#: Raw identity id -> name and kind; fixed values of the token format.
IDENTITIES = {264: ("BLOCK", "COUNTER"), 265: ("LOCAL_FUNC", "FUNCTION"), 266: ("PLT_FUNC", "FUNCTION"), 267: ("EXT_FUNC", "FUNCTION"),
              268: ("STRING_PTR", "COUNTER"), 269: ("JUMP_TABLE", "COUNTER"), 270: ("RO_DATA_PTR", "COUNTER"), 271: ("RW_DATA_PTR", "COUNTER")}
COUNTERS = [k for k, v in IDENTITIES.items() if v[1] == "COUNTER"]
LOCAL_SELF, PLT_SELF = 9, 10


def band(token: Column) -> Column:
    return F.when(token < SIGN, "digit").when(token == SIGN, "sign").when(token < FIRST_IDENTITY, "number").when(token < FIRST_INSTRUCTION, "identity").otherwise("instruction")


def is_carrier(token: Column) -> Column:
    return token.between(INTEGER, FIRST_INSTRUCTION - 1)


def units(tokens: Column) -> Column:
    """Array of (id, payload, negative): every raw id above 256 with the digits up to the next one.

    negative: the run behind the carrier holds a sign. Digits before the first such id belong to none.
    """
    at = F.filter(F.sequence(F.lit(1), F.size(tokens)), lambda i: F.element_at(tokens, i) > SIGN)
    at = F.when(F.size(tokens) > 0, at).otherwise(F.array().cast("array<int>"))

    def unit(i: Column, k: Column) -> Column:
        until = F.coalesce(F.get(at, k + 1), F.size(tokens) + 1)
        run = F.slice(tokens, i + 1, until - i - 1)
        return F.struct(F.element_at(tokens, i).alias("id"), F.filter(run, lambda x: x < SIGN).alias("payload"), F.exists(run, lambda x: x == SIGN).alias("negative"))

    return F.transform(at, unit)


def slots(unit: Column) -> Column:
    """Decoded slots of a unit: one for each 8 payload bytes of an integer, two for a finite 128-bit float, else one."""
    payload = unit["payload"]
    chunks = F.greatest(F.lit(1), F.ceil(F.size(payload) / 8).cast("int"))
    finite = ~((F.get(payload, F.lit(0)).bitwiseAND(F.lit(127)) == 127) & (F.get(payload, F.lit(1)) == 255))
    return F.when(unit["id"] == INTEGER, chunks).when((unit["id"] == FLOAT128) & F.coalesce(finite, F.lit(False)), 2).otherwise(1)


def expand_tokens(units_: Column, self_token: Column | None = None) -> Column:
    """Decoded ids in order, carriers repeated over their slots, behind the self token if given."""
    body = F.flatten(F.transform(units_, lambda u: F.array_repeat(u["id"] - SIGN, slots(u))))
    return body if self_token is None else F.concat(F.array(self_token.cast("int")), body)


def body_length(units_: Column) -> Column:
    return F.aggregate(units_, F.lit(0), lambda acc, u: acc + slots(u))


def geometry(bodies: DataFrame, tokens: str = "tokens") -> DataFrame:
    """bodies with body_len, id_count and value_count. Meant for distinct bodies, joined back afterwards."""
    with_units = bodies.withColumn("__u", units(F.col(tokens)))
    ids = F.size(F.filter("__u", lambda u: u["id"].between(FIRST_IDENTITY, FIRST_INSTRUCTION - 1)))
    values = F.aggregate(F.filter("__u", lambda u: u["id"].between(INTEGER, FLOAT128)), F.lit(0), lambda acc, u: acc + slots(u))
    return with_units.withColumn("body_len", body_length(F.col("__u"))).withColumn("id_count", ids).withColumn("value_count", values).drop("__u")


def payload_value(payload: Column) -> Column:
    """Big-endian value of an identity's payload; wider ones than two bytes are an error."""
    value = F.aggregate(payload, F.lit(0), lambda acc, x: acc * 256 + x)
    return F.when(F.size(payload) <= 2, value).otherwise(F.raise_error(F.lit("identity payload wider than two bytes")).cast("int"))


def category_distinct(bodies: DataFrame, keys: list[str], tokens: str = "tokens") -> DataFrame:
    """Distinct ids of each counting category, per body."""
    rows = bodies.select(*keys, F.explode(units(F.col(tokens))).alias("u")).filter(F.col("u.id").isin(COUNTERS))
    return rows.groupBy(*keys, F.col("u.id").alias("category")).agg(F.countDistinct(payload_value(F.col("u.payload"))).alias("n_ids"))


def cutoff(entries: DataFrame, keys: list[str], order: list[str], budget: Column, length: str = "length") -> DataFrame:
    """entries with start, surviving and is_cut: what of each fits the budget, in order.

    The cut entry is the first whose end lies beyond the budget; at an exact boundary that is the next
    one, with nothing of it left.
    """
    by = W.partitionBy(*keys).orderBy(*order)
    start = F.coalesce(F.sum(length).over(by.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    rows = entries.withColumn("start", start)
    fits = F.greatest(F.lit(0), F.least(F.col(length), budget - F.col("start")))
    return rows.withColumn("surviving", fits).withColumn("is_cut", (F.col("start") <= budget) & (F.col("start") + F.col(length) > budget))


def surviving_counts(expanded: Column, surviving: Column) -> Column:
    """(numbers, identities) within the surviving prefix of decoded ids."""
    head = F.slice(expanded, F.lit(1), surviving)
    return F.struct(F.size(F.filter(head, lambda x: x.between(1, 7))).alias("numbers"), F.size(F.filter(head, lambda x: x.between(8, 15))).alias("identities"))


def exclusive_prefix(rows: DataFrame, keys: list[str], order: list[str], value: str, name: str = "offset") -> DataFrame:
    by = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    return rows.withColumn(name, F.coalesce(F.sum(value).over(by), F.lit(0)))


def segmented_rank(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return rows.withColumn("rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order)) - 1)


def run_lengths(rows: DataFrame, keys: list[str], position: str, flag: str) -> DataFrame:
    """(keys, start, run): maximal runs of consecutive positions with the flag."""
    kept = rows.filter(flag)
    island = F.col(position) - F.row_number().over(W.partitionBy(*keys).orderBy(position))
    return kept.withColumn("__g", island).groupBy(*keys, "__g").agg(F.min(position).alias("start"), F.count("*").alias("run")).drop("__g")


def _ends(runs: Column) -> Column:
    """Where each run ends, in one pass."""
    none = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("ends"))
    return F.aggregate(runs, none, lambda a, n: F.struct((a["at"] + n).cast("int").alias("at"), F.concat(a["ends"], F.array((a["at"] + n).cast("int"))).alias("ends")), lambda a: a["ends"])


def rebase_runs(tokens_per_insn: Column, tokens_per_block: Column) -> Column:
    """Instructions of each block, from both run lengths over the same tokens: those that end in it. batch.block_runs does it for long bodies."""
    insns, blocks = _ends(tokens_per_insn), _ends(tokens_per_block)
    until = F.transform(blocks, lambda e: F.size(F.filter(insns, lambda x: x <= e)))
    return F.transform(until, lambda n, i: n - F.when(i > 0, F.get(until, i - 1)).otherwise(0))


def split_blocks(strings: Column, tokens_per_block: Column) -> Column:
    """Token strings as one text per block."""
    ends = _ends(tokens_per_block)
    return F.transform(tokens_per_block, lambda n, i: F.array_join(F.slice(strings, F.get(ends, i) - n + 1, n), " "))


def variant_prefix(prefix: Column) -> Column:
    return F.transform(prefix, lambda x: x - SIGN)


def assemble(parts: DataFrame, keys: list[str], order: list[str], context_len: int, prefix: str | None = None, tokens: str = "tokens") -> DataFrame:
    """(keys, tokens): prefix and the parts in order, cut and zero-padded to context_len.

    A row holds at most context_len tokens, so parts that start beyond it are dropped before they are gathered.
    """
    sized = parts.withColumn("__n", F.size(tokens))
    room = cutoff(sized, keys, order, F.lit(context_len), "__n").filter("start < %d" % context_len)
    pieces = F.array_sort(F.collect_list(F.struct(*order, F.slice(F.col(tokens), F.lit(1), F.lit(context_len)).alias("__t"))))
    head = F.first(prefix) if prefix else F.array().cast("array<int>")
    rows = room.groupBy(*keys).agg(F.flatten(F.transform(pieces, lambda p: p["__t"])).alias("__body"), head.alias("__head"))
    row = F.slice(F.concat(F.coalesce("__head", F.array().cast("array<int>")), F.col("__body")), 1, context_len)
    return rows.withColumn("__row", row).select(*keys, F.concat("__row", F.array_repeat(F.lit(0), F.lit(context_len) - F.size("__row"))).alias("tokens"))


def remap_functions(mentions: DataFrame, keys: list[str]) -> DataFrame:
    """mentions (keys, category, fid, ord) with dense_id: 0-based order of first mention in the row and category."""
    first = mentions.groupBy(*keys, "category", "fid").agg(F.min("ord").alias("__first"))
    dense = first.withColumn("dense_id", F.row_number().over(W.partitionBy(*keys, "category").orderBy("__first")) - 1).drop("__first")
    return mentions.join(dense, [*keys, "category", "fid"])


def remap_counters(nodes: DataFrame, keys: list[str]) -> DataFrame:
    """nodes (keys, category, ord, n_ids) with base: ids of the row's earlier nodes."""
    return exclusive_prefix(nodes, [*keys, "category"], ["ord"], "n_ids", "base")


def pad_null(sections: DataFrame, slots_: int) -> DataFrame:
    """(section_id, slot, variant_idx): a fixed number of slots, null where a section has fewer variants."""
    return sections.select("section_id", F.explode(F.sequence(F.lit(0), F.lit(slots_ - 1))).alias("slot"), "n_variants").select(
        "section_id", "slot", F.when(F.col("slot") < F.col("n_variants"), F.col("slot")).alias("variant_idx"))


def pad_resample(sections: DataFrame, slots_: int, seed: int) -> DataFrame:
    """Missing slots draw again from the section's variants, by a seeded hash; a section without variants stays null."""
    again = (draw(seed, "section_id", "slot") % F.col("n_variants")).cast("int")
    rows = sections.select("section_id", F.explode(F.sequence(F.lit(0), F.lit(slots_ - 1))).alias("slot"), "n_variants")
    drawn = F.when(F.col("slot") < F.col("n_variants"), F.col("slot")).when(F.col("n_variants") > 0, again)
    return rows.select("section_id", "slot", drawn.alias("variant_idx"))


def pad_ragged(sections: DataFrame, slots_: int) -> DataFrame:
    """Real rows only."""
    return pad_null(sections, slots_).filter("variant_idx is not null")


def pad_redistribute(sections: DataFrame, slots_: int, key: Column) -> DataFrame:
    """Missing slots, in order of (section, slot), take the surplus variants in order of key; the rest stay null.

    sections: section_id, n_variants of a batch; key: a Column over section_id and variant_idx. Ranks run over the
    whole batch, by ranges.
    """
    base = pad_null(sections, slots_)
    holes = base.filter("variant_idx is null")
    holes = numbered(holes, [], ["section_id", "slot"], "n")
    spare = sections.filter(F.col("n_variants") > slots_).select("section_id", F.explode(F.sequence(F.lit(slots_), F.col("n_variants") - 1)).alias("variant_idx"))
    donors = numbered(spare.withColumn("__key", key), [], ["__key", "section_id", "variant_idx"], "n").select(F.col("section_id").alias("donor"), F.col("variant_idx").alias("given"), "n")
    filled = holes.join(donors, "n", "left").select("section_id", "slot", F.coalesce("donor", "section_id").alias("source"), F.col("given").alias("variant_idx"))
    return base.filter("variant_idx is not null").select("section_id", "slot", F.col("section_id").alias("source"), "variant_idx").unionByName(filled)


def allocate_identities(mentions: DataFrame, keys: list[str]) -> DataFrame:
    """mentions (keys, category, addr, ord) with identity: numbers from 0 in the order of first mention; one address keeps its number."""
    return remap_functions(mentions.withColumnRenamed("addr", "fid"), keys).withColumnsRenamed({"fid": "addr", "dense_id": "identity"})


def concat_results(results: DataFrame) -> DataFrame:
    """Rows of several programs as one batch, programs in alphabetical order: binary_id and row_id, both from 0.

    results: program, row, ...; widths of tokens must agree. Rows are numbered by ranges.
    """
    widest = results.agg(F.max(F.size("tokens")).alias("__w"))
    checked = F.when(F.size("tokens") == F.col("__w"), F.lit(True)).otherwise(F.raise_error(F.lit("rows differ in width")).cast("boolean"))
    programs = numbered(results.select("program").distinct(), [], ["program"], "binary_id")
    rows = numbered(results.join(F.broadcast(widest)).filter(checked).drop("__w"), [], ["program", "row"], "row_id")  # one row beside each
    return rows.join(programs, "program").withColumns({c: F.col(c).cast("int") for c in ("binary_id", "row_id")})
