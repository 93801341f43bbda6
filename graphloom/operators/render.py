"""Blocks of functions as text: one line per instruction, calls and jumps by name, and what a line refers to.

Every token finds its instruction, its block and its text by joins on positions; one ordered concatenation per
instruction is all that is gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from graphloom.operators import decode

KEYS = ["section_id", "variant_idx"]
# Decoded ids, and words for what they name; fixed values of the format.
BLOCK, FUNCTIONS = 8, {9: "local", 10: "plt", 11: "ext"}
#: Tokens that are shown as a character; fixed values of the format.
SHOWN = {"MEM_OPEN_BRACKET": "[", "mem[": "[", "MEM_CLOSE_BRACKET": "]", "]mem": "]", "REG_LIST_OPEN_BRACE": "{", "reglist{": "{", "REG_LIST_CLOSE_BRACE": "}", "}reglist": "}",
         "asm_writeback_detect": "!", "asm_post_index_separator": ","}
NO_NAME = "?"


def shown(text: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in SHOWN.items() for x in pair])
    return F.coalesce(F.element_at(table, text), text)


def call_label(category: Column, number: Column, name: Column, provider: Column) -> Column:
    word = F.element_at(F.create_map(*[F.lit(x) for pair in FUNCTIONS.items() for x in pair]), category)
    base = F.concat(word, F.lit(" function "), number.cast("string"), F.lit(": "), F.coalesce(name, F.lit(NO_NAME)))
    return F.when(category == 11, F.concat(base, F.lit("@"), F.coalesce(provider, F.lit(NO_NAME)))).otherwise(base)


def jump_label(block: Column) -> Column:
    return F.concat(F.lit("jump block: "), block.cast("string"))


def positions(bodies: DataFrame) -> DataFrame:
    """(keys, at, id, payload, negative, block, insn): every unit of a body, with the numbers of its block and of the instruction in that.

    bodies: keys, tokens, block_rl and insn_rl. A unit belongs to the first run that ends where it ends or later; one
    behind all runs has none. Ends are found by windows, so that a long body costs no more than its length.
    """
    tokens = F.col("tokens").cast("array<int>")
    held = bodies.select(*KEYS, F.size(tokens).alias("__n"), F.posexplode(tokens).alias("p", "t")).filter(F.col("t") > decode.SIGN)
    by = W.partitionBy(*KEYS).orderBy("p")
    held = held.select(*KEYS, (F.row_number().over(by) - 1).alias("at"), F.coalesce(F.lead("p").over(by), F.col("__n")).cast("long").alias("end"))
    units = bodies.select(*KEYS, F.posexplode(decode.units(tokens)).alias("at", "u")).join(held, [*KEYS, "at"])

    def runs(column: str, kind: int) -> DataFrame:
        rows = decode.exclusive_prefix(bodies.select(*KEYS, F.posexplode(column).alias("i", "n")), KEYS, ["i"], "n")
        return rows.select(*KEYS, (F.col("offset") + F.col("n")).cast("long").alias("end"), F.lit(kind).alias("kind"), F.col("i").alias("i"))

    marked = units.select(*KEYS, "end", F.lit(0).alias("kind"), F.col("at").alias("i"), "at", "u").unionByName(runs("insn_rl", 1), allowMissingColumns=True).unionByName(runs("block_rl", 2), allowMissingColumns=True)
    following = W.partitionBy(*KEYS).orderBy("end", "kind", "i").rowsBetween(0, W.unboundedFollowing)
    for name, kind in (("insn", 1), ("block", 2)):
        marked = marked.withColumn(name, F.first(F.when(F.col("kind") == kind, F.col("i")), ignorenulls=True).over(following))
    first = marked.filter("kind = 1").groupBy(*KEYS, "block").agg(F.min("i").alias("__first"))
    placed = marked.filter("kind = 0 and insn is not null and block is not null").join(first, [*KEYS, "block"])
    return placed.select(*KEYS, "at", "u.id", "u.payload", "u.negative", "block", (F.col("insn") - F.col("__first")).alias("insn"))


def lines(bodies: DataFrame, vocab: DataFrame, calls: DataFrame) -> DataFrame:
    """(keys, block, insn, text, refers): a line per instruction that has tokens, in order of block and instruction.

    vocab: id (raw), token. calls: keys, category (9 to 11), place, name, provider, the place counted within the category as
    bodies count their functions; names and providers that aren't known are `?`. refers: (kind, number) of calls and jumps,
    in order. Numbers are shown in decimal as v:, with their sign; other identities by their name and number; an id that
    the vocabulary lacks as #id.
    """
    every = positions(bodies)
    identity = F.col("id").between(decode.FIRST_IDENTITY, decode.FIRST_INSTRUCTION - 1)
    number = F.when(identity, decode.payload_value(F.col("payload")))
    rows = every.withColumn("category", (F.col("id") - decode.SIGN).cast("int")).withColumn("number", number)
    known = calls.select(*KEYS, F.col("category").cast("int").alias("category"), F.col("place").cast("int").alias("number"), "name", "provider")
    called = F.col("category").isin(list(FUNCTIONS))
    met = rows.filter(called).join(known, [*KEYS, "category", "number"], "left").unionByName(rows.filter(~called), allowMissingColumns=True)
    met = met.join(F.broadcast(vocab.select("id", "token")), "id", "left")  # at most 65,536 ids of two bytes
    value = F.aggregate(F.col("payload"), F.lit(0).cast("decimal(38,0)"), lambda a, x: (a * 256 + x).cast("decimal(38,0)"))
    wide = F.concat(F.lit("0x"), F.lower(F.array_join(F.transform("payload", lambda x: F.lpad(F.hex(x), 2, "0")), "")))
    integer = F.concat(F.lit("v:"), F.when(F.col("negative"), "-").otherwise(""), F.when(F.size("payload") <= 15, value.cast("string")).otherwise(wide))
    floating = F.concat(F.lit("f"), (F.size("payload") * 8).cast("string"), F.lit(":"), wide)
    names = F.create_map(*[F.lit(x) for k, (name, _) in decode.IDENTITIES.items() for x in (k, name)])
    text = (F.when(called, call_label(F.col("category"), F.col("number"), F.col("name"), F.col("provider"))).when(F.col("category") == BLOCK, jump_label(F.col("number")))
            .when(identity, F.concat(F.element_at(names, F.col("id")), F.lit(":"), F.col("number").cast("string"))).when(F.col("id") == decode.INTEGER, integer).when(F.col("id") <= decode.FLOAT128, floating)
            .otherwise(shown(F.coalesce("token", F.concat(F.lit("#"), F.col("id").cast("string"))))))
    refer = F.when(called | (F.col("category") == BLOCK), F.struct(F.when(called, F.lit("call")).otherwise("jump").alias("kind"), "category", "number"))
    held = F.array_sort(F.collect_list(F.struct("at", text.alias("text"), refer.alias("refer"))))
    out = met.groupBy(*KEYS, "block", "insn").agg(held.alias("h"))
    return out.select(*KEYS, "block", "insn", F.array_join(F.transform("h", lambda x: x["text"]), " ").alias("text"), F.filter(F.transform("h", lambda x: x["refer"]), lambda r: r.isNotNull()).alias("refers"))
