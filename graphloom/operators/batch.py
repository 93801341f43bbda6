"""Batches decoded end to end: from sections to rows of tokens, with identities, numbers and function ids beside them.

One plan serves: lengths come from the stored geometry, so that the walk and the cutoff read no tokens, and only
the bodies of nodes that survive are joined. A row (root, lane) holds at most context_len tokens.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from graphloom.functions import numbers
from graphloom.operators import decode, graph, order, sampling
from graphloom.plans.materialize import materialized

ROW = ["root", "lane"]
#: Raw id of a float carrier -> its kind; fixed values of the token format.
FLOATS = {258: "f16", 259: "bf16", 260: "f32", 261: "f64", 262: "f80", 263: "f128"}
#: Decoded ids of local, linked and external functions; fixed values of the token format.
FUNCTIONS = [9, 10, 11]


def resolve(sections: DataFrame, variants: DataFrame, slots: int, seed: int, padding: str = "null") -> DataFrame:
    """(root, lane, variant_idx): slots lanes per distinct section, at most slots of its variants drawn.

    sections may have max_depth, which its lanes keep. Lanes that a section has no variant for, by padding: `null`: are
    null; `ragged`: are left out; `resample`: draw one of the section's variants again; `redistribute`: take, in order of
    (section, lane), what sections have left, drawn likewise: the root is that section then, the lane a number from slots on,
    and place and slot tell the section and lane that took it; lanes beyond what is left are null.
    """
    given = ["max_depth"] if "max_depth" in sections.columns else []
    batch = sections.select("section_id", *given).distinct()
    few = sampling.cap_variants(variants.select("section_id", "variant_idx"), slots, seed)
    lanes = few.withColumn("lane", F.row_number().over(W.partitionBy("section_id").orderBy("variant_idx")) - 1)
    every = batch.select("section_id", *given, F.explode(F.sequence(F.lit(0), F.lit(slots - 1))).alias("lane"))
    rows = every.join(lanes, ["section_id", "lane"], "left")
    if padding == "ragged":
        rows = rows.filter("variant_idx is not null")
    elif padding == "resample":
        ranked = variants.select("section_id", "variant_idx").join(batch, "section_id", "left_semi")
        ranked = ranked.withColumn("__k", F.row_number().over(W.partitionBy("section_id").orderBy("variant_idx")) - 1).withColumn("__n", F.count("*").over(W.partitionBy("section_id")))
        again = rows.filter("variant_idx is null").drop("variant_idx").join(ranked.select("section_id", "__n").distinct(), "section_id", "left").withColumn("__k", sampling.draw(seed, "section_id", "lane") % F.col("__n"))
        rows = rows.filter("variant_idx is not null").unionByName(again.join(ranked.drop("__n"), ["section_id", "__k"], "left").select(*rows.columns))
    elif padding == "redistribute":
        holes = order.numbered(rows.filter("variant_idx is null").drop("variant_idx", *given), [], ["section_id", "lane"], "__k")
        left = variants.select("section_id", "variant_idx").join(batch, "section_id").join(few, ["section_id", "variant_idx"], "left_anti").withColumn("__m", sampling.draw_key(seed, "section_id", "variant_idx"))
        spare = order.numbered(left, [], ["__m", "section_id", "variant_idx"], "__k").drop("__m").withColumnRenamed("section_id", "__s")
        moved = holes.join(spare, "__k", "left").select(
            F.coalesce("__s", "section_id").alias("root"), F.when(F.col("__s").isNull(), F.col("lane")).otherwise(slots + F.col("__k")).cast("int").alias("lane"), "variant_idx", *given, F.col("section_id").alias("place"), F.col("lane").alias("slot"))
        own = rows.filter("variant_idx is not null").select(F.col("section_id").alias("root"), "lane", "variant_idx", *given, F.col("section_id").alias("place"), F.col("lane").alias("slot"))
        return own.unionByName(moved, allowMissingColumns=True)
    elif padding != "null":
        raise ValueError(f"unknown padding {padding}")
    return rows.select(F.col("section_id").alias("root"), "lane", "variant_idx", *given)


def surviving_nodes(rows: DataFrame, nodes: DataFrame, geometry: DataFrame, context_len: int) -> DataFrame:
    """Nodes with node (their number in the row), start and surviving; those of which nothing is left are gone.

    rows may have a prefix array, which takes its part of context_len. geometry: section_id, variant_idx,
    body_len; a node's own token comes before its body.
    """
    taken = F.size("prefix") if "prefix" in rows.columns else F.lit(0)
    nodes = nodes if "type" in nodes.columns else nodes.withColumn("type", F.lit(graph.LOCAL_CALL))
    sized = nodes.join(geometry.select("section_id", "variant_idx", "body_len"), ["section_id", "variant_idx"], "left").join(rows.select(*ROW, taken.alias("__p")), ROW)
    sized = sized.withColumn("length", 1 + F.coalesce("body_len", F.lit(0)).cast("long")).withColumn("node", F.row_number().over(W.partitionBy(*ROW).orderBy("depth", "ord")) - 1)
    cut = decode.cutoff(sized, ROW, ["node"], F.lit(context_len).cast("long") - F.col("__p"))
    return cut.filter("surviving > 0").select(*ROW, "node", "section_id", "variant_idx", "type", "start", "surviving")


def filled(rows: DataFrame, nodes: DataFrame, full: DataFrame, geometry: DataFrame, context_len: int) -> DataFrame:
    """nodes and, behind each row's own, those of its pool that fit wholly into what they leave of context_len, in pool order.

    full: nodes of the walk over all variants of a root (lane is the variant there). A row's pool is what its variant has
    there and the row hasn't. Pool nodes that couldn't fit alone aren't gathered; a row's pool is at most its closure.
    """
    body = geometry.select("section_id", "variant_idx", F.coalesce("body_len", F.lit(0)).cast("long").alias("__len"))
    taken = F.size("prefix").cast("long") if "prefix" in rows.columns else F.lit(0).cast("long")
    sums = nodes.join(body, ["section_id", "variant_idx"], "left").groupBy(*ROW).agg(F.sum(1 + F.coalesce("__len", F.lit(0))).alias("__sum"))
    left = rows.filter("variant_idx is not null").select(*ROW, F.col("variant_idx").alias("__own"), taken.alias("__p")).join(sums, ROW).withColumn("__left", F.lit(context_len) - F.col("__p") - F.col("__sum")).filter("__left > 0")
    pool = full.filter("depth > 0").select("root", F.col("lane").alias("__own"), "depth", "ord", "section_id", "variant_idx", "type")
    fits = left.join(pool, ["root", "__own"]).join(nodes.select(*ROW, "section_id"), [*ROW, "section_id"], "left_anti").join(body, ["section_id", "variant_idx"], "left")
    fits = fits.withColumn("length", 1 + F.coalesce("__len", F.lit(0))).filter("length <= __left")
    pools = fits.groupBy(*ROW, "__left").agg(F.array_sort(F.collect_list(F.struct("depth", "ord", "section_id", "variant_idx", "type", "length"))).alias("pool"))
    chosen = pools.select(*ROW, F.posexplode(graph.backfill(F.col("pool"), F.col("__left"), lambda x: x)["taken"]).alias("ord", "n"))
    deepest = nodes.groupBy(*ROW).agg(F.max("depth").alias("depth"))
    more = chosen.join(deepest, ROW).select(*ROW, (F.col("depth") + 1).alias("depth"), F.col("ord").cast("long").alias("ord"), "n.section_id", "n.variant_idx", F.lit(-1).alias("via"), "n.type")
    return nodes.select(*more.columns).unionByName(more)


def block_runs(bodies: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, block, n_insns, slots): instructions of each block, and decoded slots of each of those.

    bodies: keys, tokens, and block_rl and insn_rl, raw tokens of each block and instruction. What ends where a longer run
    ends belongs to it; each is found by a window over the ends, so long bodies cost no more than their length.
    """
    def ends(runs: str, kind: int) -> DataFrame:
        rows = bodies.select(*keys, F.posexplode(runs).alias("at", "n"))
        return decode.exclusive_prefix(rows, keys, ["at"], "n").select(*keys, (F.col("offset") + F.col("n")).cast("long").alias("end"), F.lit(kind).alias("kind"), "at")

    tokens = F.col("tokens").cast("array<int>")
    raw = bodies.select(*keys, F.posexplode(tokens).alias("at", "t"), F.size(tokens).alias("n")).filter(F.col("t") > decode.SIGN)
    raw = raw.withColumn("k", F.row_number().over(W.partitionBy(*keys).orderBy("at")) - 1).withColumn("end", F.coalesce(F.lead("at").over(W.partitionBy(*keys).orderBy("at")), F.col("n")).cast("long"))
    units = bodies.select(*keys, F.posexplode(F.transform(decode.units(tokens), decode.slots)).alias("k", "slots"))
    units = raw.join(units, [*keys, "k"]).select(*keys, "end", F.lit(0).alias("kind"), F.col("k").alias("at"), "slots")
    insns, blocks = ends("insn_rl", 1), ends("block_rl", 2)
    none = F.lit(None)
    met = units.unionByName(insns.withColumn("slots", none.cast("int")))
    following = W.partitionBy(*keys).orderBy("end", "kind", "at").rowsBetween(0, W.unboundedFollowing)
    owner = met.withColumn("insn", F.first(F.when(F.col("kind") == 1, F.col("at")), ignorenulls=True).over(following))
    sums = owner.filter("insn is not null").groupBy(*keys, "insn").agg(F.coalesce(F.sum("slots"), F.lit(0)).cast("int").alias("slots"))
    sized = insns.join(sums.withColumnRenamed("insn", "at"), [*keys, "at"])
    both = sized.select(*keys, "end", "kind", "at", "slots").unionByName(blocks.withColumn("slots", none.cast("int")))
    placed = both.withColumn("block", F.first(F.when(F.col("kind") == 2, F.col("at")), ignorenulls=True).over(following)).filter("block is not null")
    held = F.array_sort(F.collect_list(F.when(F.col("kind") == 1, F.struct("at", "slots"))))
    return placed.groupBy(*keys, "block").agg(held.alias("h")).select(*keys, "block", F.size("h").alias("n_insns"), F.transform("h", lambda x: x["slots"]).alias("slots"))


def run_lengths(alive: DataFrame, bodies: DataFrame) -> DataFrame:
    """(root, lane, block_runs, insn_runs): instructions of each surviving block and slots of each instruction, in order.

    The block in which a node's body is cut is the last of it, and is whole; the self token is in no run.
    """
    body = ["section_id", "variant_idx"]
    known = bodies.select(*body, "tokens", "block_rl", "insn_rl").join(alive.select(*body).distinct(), body, "left_semi")
    blocks = block_runs(known, body).withColumn("n", F.aggregate("slots", F.lit(0), lambda a, x: a + x))
    blocks = decode.exclusive_prefix(decode.exclusive_prefix(blocks, body, ["block"], "n", "start"), body, ["block"], "n_insns", "insns")
    met = alive.select(*ROW, "node", *body, "surviving").filter("surviving > 1").join(blocks, body).filter(F.col("start") < F.col("surviving") - 1)
    some = met.withColumn("some", F.max(F.col("insns") + F.col("n_insns")).over(W.partitionBy(*ROW, "node"))).filter("some > 0")
    held = F.array_sort(F.collect_list(F.struct("node", "block", "n_insns", "slots")))
    return some.groupBy(*ROW).agg(held.alias("h")).select(*ROW, F.transform("h", lambda x: x["n_insns"]).alias("block_runs"), F.flatten(F.transform("h", lambda x: x["slots"])).alias("insn_runs"))


def decoded_slots(nodes: DataFrame, bodies: DataFrame) -> DataFrame:
    """A row per surviving slot: (root, lane, node, section_id, variant_idx, at, token, chunk, payload, negative).

    at is the place in the row. chunk counts the slots of one carrier. The token of a node itself has no payload.
    """
    def unit_slots(u: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), decode.slots(u) - 1), lambda k: F.struct(
            (u["id"] - decode.SIGN).cast("int").alias("token"), k.cast("int").alias("chunk"), u["payload"].alias("payload"), u["negative"].alias("negative")))

    own = F.array(F.struct(F.when(F.col("type") == graph.PLT_CALL, decode.PLT_SELF).otherwise(decode.LOCAL_SELF).alias("token"), F.lit(0).alias("chunk"), F.lit(None).cast("array<int>").alias("payload"), F.lit(False).alias("negative")))
    joined = nodes.join(bodies.select("section_id", "variant_idx", F.col("tokens").cast("array<int>").alias("tokens")), ["section_id", "variant_idx"], "left")
    tokens = F.coalesce("tokens", F.array().cast("array<int>"))
    slots = F.slice(F.concat(own, F.flatten(F.transform(decode.units(tokens), unit_slots))), F.lit(1), F.col("surviving").cast("int"))
    return joined.select(*ROW, "node", "section_id", "variant_idx", "start", F.posexplode(slots).alias("i", "s")).select(
        *ROW, "node", "section_id", "variant_idx", (F.col("start") + F.col("i")).alias("at"), "s.*")


def function_ids(nodes: DataFrame, slots: DataFrame, targets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Identities of function slots, (root, lane, at, identity), and what stands behind them, (root, lane, category, identity, fid).

    Identities are dense per row and category, by first mention: the root is local 0; each node in order mentions all its
    targets, then its body's other ids in ascending order, which are nobody else's and have fid 0. targets:
    section_id, variant_idx, category, place (from 0 within these), fid. A node is a function of the category of its
    own token, linked or local, with fid = section_id; one that no node before it mentions is mentioned by itself.
    """
    placed = F.concat_ws(":", F.lit("n"), "node", "place")
    local = F.lit(decode.LOCAL_SELF)
    known = F.concat_ws(":", F.lit("f"), "fid")
    root = nodes.filter("node = 0").select(*ROW, F.lit(-1).alias("node"), local.alias("category"), F.lit(0).alias("late"), F.lit(0).cast("long").alias("place"), F.col("root").cast("long").alias("fid"))
    called = nodes.select(*ROW, "node", "section_id", "variant_idx").join(targets, ["section_id", "variant_idx"]).select(
        *ROW, "node", "category", F.lit(0).alias("late"), F.col("place").cast("long").alias("place"), F.col("fid").cast("long").alias("fid"))
    used = slots.filter(F.col("token").isin(FUNCTIONS) & F.col("payload").isNotNull()).select(*ROW, "node", "at", F.col("token").alias("category"), decode.payload_value(F.col("payload")).cast("long").alias("place"))
    target = called.select(*ROW, "node", "category", "place", "fid")
    met = used.join(target, [*ROW, "node", "category", "place"], "left")
    other = met.filter("fid is null").select(*ROW, "node", "category", F.lit(1).alias("late"), "place", F.lit(0).cast("long").alias("fid")).distinct()
    linked = F.when(F.col("type") == graph.PLT_CALL, decode.PLT_SELF).otherwise(decode.LOCAL_SELF)
    self = nodes.select(*ROW, "node", linked.alias("category"), F.lit(-1).alias("late"), F.lit(0).cast("long").alias("place"), F.col("section_id").cast("long").alias("fid"))
    mentions = root.withColumn("key", known).unionByName(self.withColumn("key", known)).unionByName(called.withColumn("key", known)).unionByName(other.withColumn("key", placed))
    first = mentions.groupBy(*ROW, "category", "key").agg(F.min(F.struct("node", "late", "place")).alias("f"), F.first("fid").alias("fid"))
    dense = first.select(*ROW, "category", "key", "fid", (F.row_number().over(W.partitionBy(*ROW, "category").orderBy("f")) - 1).alias("identity"))
    own = slots.filter("payload is null").select(*ROW, "at", F.col("token").alias("category"), F.concat_ws(":", F.lit("f"), "section_id").alias("key"))
    body = met.select(*ROW, "at", "category", F.when(F.col("fid").isNull(), placed).otherwise(known).alias("key"))
    return own.unionByName(body).join(dense, [*ROW, "category", "key"]).select(*ROW, "at", "identity"), dense.select(*ROW, "category", "identity", "fid")


def counter_ids(slots: DataFrame) -> DataFrame:
    """(root, lane, at, identity) of counter slots: a body's own id behind as many as the row's earlier nodes have of the category."""
    own = slots.filter((F.col("token") + decode.SIGN).isin(decode.COUNTERS)).select(*ROW, "node", "at", F.col("token").alias("category"), decode.payload_value(F.col("payload")).alias("id"))
    counts = own.groupBy(*ROW, "category", "node").agg(F.countDistinct("id").alias("n_ids"))
    based = decode.exclusive_prefix(counts, [*ROW, "category"], ["node"], "n_ids", "base").drop("n_ids")
    return own.join(based, [*ROW, "category", "node"]).select(*ROW, "at", (F.col("base") + F.col("id")).cast("int").alias("identity"))


def _chunks(token: pd.Series, payload: pd.Series, negative: pd.Series, chunk: pd.Series) -> pd.DataFrame:
    def one(t: int, p: list, minus: bool, k: int) -> tuple[str, int]:
        raw = bytes(int(x) for x in p)
        kind = FLOATS.get(t + decode.SIGN)
        parts = numbers.integer_chunks(raw, minus) if kind is None else numbers.from_float(int.from_bytes(raw, "big"), kind)
        return (str(parts[k][0]), parts[k][1])

    return pd.DataFrame([one(*r) for r in zip(token, payload, negative, chunk, strict=True)], columns=["sig", "word"])


def number_slots(slots: DataFrame) -> DataFrame:
    """(root, lane, at, sig, word) of number slots: unsigned significand as a decimal text, and the word of sign and exponent."""
    own = slots.filter(F.col("token").between(1, 7))
    chunk = F.pandas_udf(_chunks, "struct<sig: string, word: bigint>")
    return own.select(*ROW, "at", chunk("token", "payload", "negative", "chunk").alias("c")).select(*ROW, "at", "c.sig", "c.word")


def _in_order(rows: DataFrame, by: list[str], value: Column, name: str) -> DataFrame:
    """value of each row's slots as one array, in order; at most context_len of them, or a row's function ids."""
    return rows.groupBy(*ROW).agg(F.transform(F.array_sort(F.collect_list(F.struct(*by, value.alias("v")))), lambda x: x["v"]).alias(name))


def batch_decode(sections: DataFrame, variants: DataFrame, edges: DataFrame, targets: DataFrame, bodies: DataFrame, context_len: int, max_depth: int, slots: int, seed: int = 0, rows: DataFrame | None = None,
                 padding: str = "null", unmatched_hops: int | None = None, fill: bool = False) -> DataFrame:
    """(root, lane, variant_idx, n_tokens, tokens, identities, numbers, fids) of the sections, slots rows each.

    tokens: context_len of them, zeros behind n_tokens. identities and numbers: in the order of their slots.
    fids: (category, identity, fid) in order. A lane without a variant has zeros and empty arrays. rows
    takes the place of the drawn ones where given (root, lane, variant_idx and perhaps prefix, max_depth and further columns,
    which are kept). bodies: section_id, variant_idx, body_len, tokens (raw ids); with block_rl and insn_rl, block_runs and
    insn_runs stand beside. Sections or rows with max_depth have depths of their own, all in one walk; sections of both
    arms may be mixed, as ids tell them apart. edges may have type and matched, see graph.included. fill: what a row
    leaves of context_len takes functions that the walk over all variants includes.
    """
    rows = resolve(sections, variants, slots, seed, padding) if rows is None else rows
    rows = materialized(rows)
    depth = ["max_depth"] if "max_depth" in rows.columns else []
    edges = edges if "type" in edges.columns else edges.withColumn("type", F.lit(graph.LOCAL_CALL))
    nodes = graph.included(rows.filter("variant_idx is not null").select(*ROW, "variant_idx", *depth), edges, max_depth, unmatched_hops)
    if fill:
        every = rows.filter("variant_idx is not null").select("root", *depth).distinct().join(variants.select(F.col("section_id").alias("root"), "variant_idx"), "root")
        full = graph.included(every.select("root", F.col("variant_idx").alias("lane"), "variant_idx", *depth), edges, max_depth, unmatched_hops)
        nodes = filled(rows, nodes, full, bodies, context_len)
    alive = materialized(surviving_nodes(rows, nodes, bodies, context_len))
    found = materialized(decoded_slots(alive, bodies))
    functions, behind = function_ids(alive, found, targets)
    parts = [_in_order(found, ["at"], F.col("token"), "tokens"), _in_order(functions.unionByName(counter_ids(found)), ["at"], F.col("identity").cast("int"), "identities"),
             _in_order(number_slots(found), ["at"], F.struct("sig", "word"), "numbers"), _in_order(behind, ["category", "identity"], F.struct("category", "identity", "fid"), "fids")]
    if {"block_rl", "insn_rl"} <= set(bodies.columns):
        parts.append(run_lengths(alive, bodies))
    out = rows
    for p in parts:
        out = out.join(p, ROW, "left")
    prefix = F.col("prefix").cast("array<int>") if "prefix" in rows.columns else F.array().cast("array<int>")
    own = F.slice(F.concat(prefix, F.coalesce("tokens", F.array().cast("array<int>"))), 1, context_len)
    out = out.withColumn("__own", F.when(F.col("variant_idx").isNotNull(), own).otherwise(F.array().cast("array<int>")))
    empty = {c: F.coalesce(c, F.array().cast(p.schema[c].dataType)) for p in parts[1:] for c in p.columns[2:]}
    kept = [c for c in rows.columns if c not in (*ROW, "variant_idx", "prefix")]
    return out.select(*ROW, "variant_idx", *kept, F.size("__own").alias("n_tokens"), F.concat("__own", F.array_repeat(F.lit(0), F.lit(context_len) - F.size("__own"))).alias("tokens"), *[c.alias(n) for n, c in empty.items()])


def with_prefix(rows: DataFrame, prefixes: DataFrame) -> DataFrame:
    """rows with the axis tokens of their variant in front. prefixes: section_id, variant_idx, axes (raw ids)."""
    own = prefixes.select(F.col("section_id").alias("root"), "variant_idx", decode.variant_prefix(F.col("axes")).alias("prefix"))
    return rows.join(own, ["root", "variant_idx"], "left").withColumn("prefix", F.coalesce("prefix", F.array().cast(own.schema["prefix"].dataType)))


def load_batch(index: DataFrame, target: tuple[int, int], batch_size: int, seed: int, variants: DataFrame, edges: DataFrame, targets: DataFrame, bodies: DataFrame, context_len: int, max_depth: int | None, slots: int,
               padding: str = "null", prefixes: DataFrame | None = None, unmatched_hops: int | None = None, fill: bool = False) -> DataFrame:
    """batch_decode of batch_size sections drawn from those with a length in the band.

    max_depth None: the index holds cells (mode, depth, section_id, length), sections are drawn across them, and each is
    decoded to the depth of its cell. A section drawn from cells of several depths has rows of each.
    """
    if max_depth is None:
        drawn = sampling.sample_sections(index, *target, batch_size, seed, ["mode", "depth"])
        drawn = drawn.select("section_id", F.col("depth").alias("max_depth")).distinct()
    else:
        drawn = sampling.sample_sections(index, *target, batch_size, seed, [])
    rows = resolve(drawn, variants, slots, seed, padding)
    if max_depth is None:  # rows of one root and lane at several depths are lanes of their own
        rows = rows.withColumn("lane", F.col("lane") + F.lit(slots) * F.col("max_depth").cast("int"))
    rows = rows if prefixes is None else with_prefix(rows, prefixes)
    return batch_decode(drawn, variants, edges, targets, bodies, context_len, max_depth, slots, seed, rows, padding, unmatched_hops, fill)


def row_offsets(rows: DataFrame, order_: list[str], length: str) -> DataFrame:
    """(…, offset): where each row's entries start among those of all rows; a padding row (null length) has none."""
    return order.running(rows, [], order_, {"offset": F.col(length)})


def dense_reservation(nodes: DataFrame, keys: list[str], values: list[str], order_: list[str]) -> DataFrame:
    """Per row the sum of each value over its nodes, and the offset at which the row's part starts."""
    sums = nodes.groupBy(*keys).agg(*[F.sum(v).alias(v) for v in values])
    return order.running(sums, [], order_, {f"{v}_offset": F.col(v) for v in values})


def digits_before(rows: DataFrame, keys: list[str], position: str = "pos", token: str = "token") -> DataFrame:
    """For each token (a row) the number of digits before it in its body."""
    marked = rows.withColumn("__d", (F.col(token) < decode.SIGN).cast("int"))
    return decode.exclusive_prefix(marked, keys, [position], "__d", "digits_before").drop("__d")


def record_sections(sections: DataFrame) -> DataFrame:
    """(section_id, variant_idx): a row per record of the sections, in their order; sections without variants have none."""
    return sections.filter("n_variants > 0").select("section_id", F.explode(F.sequence(F.lit(0), F.col("n_variants") - 1)).alias("variant_idx"))


def measured_once(uses: DataFrame, bodies: DataFrame, key: str) -> DataFrame:
    """uses with the geometry of their bodies, each distinct body measured once."""
    wanted = bodies.join(uses.select(key).distinct(), key, "left_semi").dropDuplicates([key])
    return uses.join(decode.geometry(wanted).drop("tokens"), key, "left")
