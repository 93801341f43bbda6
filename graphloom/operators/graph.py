"""Call-graph operators: closure, once-only inclusion, spliced lengths, pools and backfill.

Edges are rows (section_id, variant_idx, called_idx, callee_section, callee_variant). A walk starts at
roots (root, lane, variant_idx): lane is one of the root's variants that take part. All state is keyed by
root, so a level is joins and aggregations on it; levels are few and each is materialised.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from graphloom.plans.materialize import materialized


def expand(frontier: DataFrame, edges: DataFrame) -> DataFrame:
    """Direct children of the frontier's nodes; of a repeated slot the first entry wins."""
    return frontier.join(edges, ["section_id", "variant_idx"])


def closure(roots: DataFrame, edges: DataFrame, max_depth: int) -> DataFrame:
    """(root, section_id, depth): sections within max_depth hops, at their least depth."""
    hop = edges.select("section_id", "callee_section").distinct()
    level = roots.select("root", F.col("root").alias("section_id")).distinct().withColumn("depth", F.lit(0))
    found = [level]
    for depth in range(1, max_depth + 1):
        step = level.join(hop, "section_id").select("root", F.col("callee_section").alias("section_id")).distinct()
        seen = reduce(DataFrame.unionByName, found)
        level = materialized(step.join(seen, ["root", "section_id"], "left_anti").withColumn("depth", F.lit(depth)))
        found.append(level)
    return reduce(DataFrame.unionByName, found)


#: Type of an edge: the raw id, less 256, of the function category that names its callee; fixed values of the format.
LOCAL_CALL, PLT_CALL, EXTERN_CALL = 9, 10, 11
#: Up to so many called sections' variants (some 200 bytes each with their calls) are broadcast; lanes whose walks make one part.
BROADCAST_CALLS, LANES_A_PART = 100_000, 20_000


def _resolved(edges: DataFrame) -> DataFrame:
    """Edges to bodies: type is LOCAL_CALL and matched true unless given; extern callees have no body."""
    kind = F.col("type") if "type" in edges.columns else F.lit(LOCAL_CALL)
    matched = F.col("matched") if "matched" in edges.columns else F.lit(True)
    return edges.select("section_id", "variant_idx", "called_idx", "callee_section", "callee_variant", kind.cast("int").alias("type"), matched.alias("matched")).filter(F.col("type") != EXTERN_CALL)


def behind_unmatched(level: DataFrame, edges: DataFrame, keys: list[str], hops: int) -> DataFrame:
    """Matched callees behind unmatched ones, through at most `hops` of those: (keys, order, path, callee_section, callee_variant, type).

    level: keys, order, path (slots taken so far), section_id and variant_idx of an unmatched callee. edges: as of
    _resolved. A way never returns to an unmatched section on it. Of ways that may go on alike, only the first in
    order of (order, path) does: a state is the section and, while another unmatched hop may follow, those before it,
    so with three hops there are no more states than edges between unmatched callees.
    """
    level = level.select(*keys, "order", "path", "section_id", "variant_idx", F.array().cast("array<bigint>").alias("before"))
    found = []
    for i in range(hops):
        step = level.join(edges, ["section_id", "variant_idx"]).select(*keys, "order", F.concat("path", F.array("called_idx")).alias("path"), "before", "section_id", "callee_section", "callee_variant", "type", "matched")
        found.append(step.filter("matched").select(*keys, "order", "path", "callee_section", "callee_variant", "type"))
        if i + 1 == hops:
            break
        on = step.filter(~F.col("matched") & (F.col("callee_section") != F.col("section_id")) & ~F.array_contains("before", F.col("callee_section").cast("long")))
        held = F.concat("before", F.array(F.col("section_id").cast("long"))) if i + 2 < hops else F.array().cast("array<bigint>")
        least = on.withColumn("before", held).groupBy(*keys, "before", F.col("callee_section").alias("section_id"), F.col("callee_variant").alias("variant_idx")).agg(F.min(F.struct("order", "path")).alias("w"))
        level = materialized(least.select(*keys, "w.order", "w.path", "section_id", "variant_idx", "before"))
    return reduce(DataFrame.unionByName, found) if found else level.join(edges, ["section_id", "variant_idx"]).filter(F.lit(False)).select(*keys, "order", "path", "callee_section", "callee_variant", "type")


def _walk_by_level(lanes: DataFrame, edges: DataFrame, deepest: int, unmatched_hops: int) -> list[DataFrame]:
    """The levels of included, each materialised, for walks that pass unmatched callees."""
    rows = lanes.groupBy("root", "reach").agg(F.countDistinct("lane").alias("n_lanes"))
    level = lanes.select("root", "lane", "reach", F.lit(0).alias("depth"), F.lit(0).cast("long").alias("ord"), F.col("root").alias("section_id"), "variant_idx", F.lit(-1).alias("via"), F.lit(LOCAL_CALL).alias("type"))
    seen = lanes.select("root", "lane", "reach", F.col("root").alias("section_id")).distinct()
    found, keys = [level], ["root", "lane", "reach"]
    for depth in range(1, deepest + 1):
        step = level.filter(F.col("reach") >= depth).select(*keys, F.col("ord").alias("order"), "section_id", "variant_idx").join(edges, ["section_id", "variant_idx"]).select(
            *keys, "order", F.array("called_idx").alias("path"), "callee_section", "callee_variant", "type", "matched")
        children = step.filter("matched").drop("matched")
        start = step.filter("not matched").select(*keys, "order", "path", F.col("callee_section").alias("section_id"), F.col("callee_variant").alias("variant_idx"))
        children = children.unionByName(behind_unmatched(start, edges, keys, unmatched_hops))
        first = children.groupBy(*keys, F.col("callee_section").alias("section_id")).agg(F.min(F.struct("order", "path", F.col("callee_variant").alias("variant_idx"), "type")).alias("f"))
        met = materialized(first.join(seen, [*keys, "section_id"], "left_anti").select(*keys, "section_id", "f.order", "f.path", "f.variant_idx", "f.type"))
        seen = seen.unionByName(met.select(*keys, "section_id"))  # met pairs are new, so all stay distinct
        common = seen.groupBy("root", "reach", "section_id").agg(F.count("*").alias("n")).join(rows, ["root", "reach"]).filter("n = n_lanes").select("root", "reach", "section_id")
        fresh = met.join(common, ["root", "reach", "section_id"], "left_anti")
        number = F.row_number().over(W.partitionBy("root", "lane").orderBy("order", "path")).cast("long") - 1
        level = materialized(fresh.withColumn("ord", number).select(*keys, F.lit(depth).alias("depth"), "ord", "section_id", "variant_idx", F.col("path")[0].alias("via"), "type"))
        found.append(level)
    return found


def _walk_by_root(lanes: DataFrame, edges: DataFrame, deepest: int) -> list[DataFrame]:
    """The roots and the deeper nodes of included, from one shuffle by root.

    A row is a section that a lane has seen, with its place where it is included. At each level every row gives itself
    and its calls, so that what is new is told by an aggregation, and all windows are within a root. Calls of
    callees are broadcast while there are few of them, else joined by key, with a shuffle by root for each level.
    """
    level = lanes.select("root", "lane", "reach", F.lit(0).alias("depth"), F.lit(0).cast("long").alias("ord"), F.col("root").alias("section_id"), "variant_idx", F.lit(-1).alias("via"), F.lit(LOCAL_CALL).alias("type"))
    if not deepest:
        return [level]
    call = F.struct("called_idx", "callee_variant", "type", "callee_section")
    calls = materialized(edges.groupBy("section_id", "variant_idx").agg(F.collect_set(call).alias("calls"))).toDF("__s", "__v", "calls")
    met = edges.select(F.col("callee_section").alias("__s")).distinct()
    deeper = materialized(calls.join(met, "__s", "left_semi")) if deepest > 1 else None
    few = deeper is None or deeper.count() <= BROADCAST_CALLS
    n = lanes.count()
    width = max(1, min(int(lanes.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n // 1000)), -(-n // LANES_A_PART))
    n_lanes = F.size(F.collect_set("lane").over(W.partitionBy("root", "reach"))).alias("n_lanes")
    keys = ["root", "lane", "reach", "n_lanes"]
    state = level.select("root", "lane", "reach", n_lanes, "section_id", F.struct("depth", "ord", "variant_idx", "via", "type").alias("own"))
    none = F.lit(None)
    for depth in range(1, deepest + 1):
        held = calls if depth == 1 else F.broadcast(deeper) if few else deeper
        goes = (F.col("own.depth") == depth - 1) & (F.col("reach") >= depth)
        stepped = state.join(held, (F.col("section_id") == F.col("__s")) & (F.col("own.variant_idx") == F.col("__v")) & goes, "left")
        if depth == 1 or not few:
            stepped = stepped.repartition(width, "root")
        found = F.struct(*[F.lit(None).cast(t).alias(c) for c, t in [("order", "bigint"), ("called_idx", edges.schema["called_idx"].dataType), ("callee_variant", edges.schema["callee_variant"].dataType), ("type", "int")]])
        child = F.transform("calls", lambda c: F.struct(c["callee_section"].cast("long").alias("section_id"), none.cast(state.schema["own"].dataType).alias("own"),
                                                        F.struct(F.col("own.ord").alias("order"), c["called_idx"].alias("called_idx"), c["callee_variant"].alias("callee_variant"), c["type"].alias("type")).alias("new")))
        self = F.array(F.struct(F.col("section_id").cast("long").alias("section_id"), F.col("own"), F.when(F.lit(False), found).alias("new")))
        rows = stepped.select(*keys, F.explode(F.concat(self, F.coalesce(child, F.array().cast(stepped.select(child).schema[0].dataType)))).alias("r")).select(*keys, "r.*")
        # of a section that was seen before, excluded or not, calls are dropped; was tells such rows of no place
        once = rows.groupBy(*keys, "section_id").agg(F.max("own").alias("own"), F.min("new").alias("new"), F.max(F.col("new").isNull()).alias("was"))
        common = F.count("*").over(W.partitionBy("root", "reach", "section_id")) == F.col("n_lanes")
        fresh = once.withColumn("fresh", ~F.col("was") & ~common)
        number = F.row_number().over(W.partitionBy("root", "lane", "reach", "fresh").orderBy("new")).cast("long") - 1
        placed = F.struct(F.lit(depth).alias("depth"), number.alias("ord"), F.col("new.callee_variant").alias("variant_idx"), F.col("new.called_idx").alias("via"), F.col("new.type").alias("type"))
        state = fresh.withColumn("own", F.when(F.col("fresh"), placed).otherwise(F.col("own"))).select(*keys, "section_id", "own")
    return [level, state.filter("own.depth > 0").select("root", "lane", "reach", "own.depth", "own.ord", "section_id", "own.variant_idx", "own.via", "own.type")]


def included(roots: DataFrame, edges: DataFrame, max_depth: int | None = None, unmatched_hops: int | None = None) -> DataFrame:
    """(root, lane, depth, ord, section_id, variant_idx, via, and type if edges have it): nodes that each lane splices, the root itself at depth 0.

    At each level a child is included for a lane if that lane hasn't seen its section, it is the first such
    child of the level, and not all lanes of the root have seen the section by then. Seen pairs stay seen
    even when excluded; the root is seen by all lanes from the start. ord numbers a lane's nodes of a level
    in the order of (parent, slot).

    roots may have a depth of their own for each lane, max_depth: one walk serves all, as a lane's nodes leave it at its
    depth, and lanes of one root and depth decide together. edges may have type (a root is LOCAL_CALL) and matched.
    Unmatched callees are dropped, or with unmatched_hops replaced by the matched ones behind them, in place.
    """
    typed, given = "type" in edges.columns, "max_depth" in roots.columns
    lanes = roots.select("root", "lane", "variant_idx", (F.col("max_depth") if given else F.lit(max_depth)).cast("int").alias("reach"))
    deepest = (lanes.agg(F.max("reach")).first()[0] or 0) if given else max_depth
    edges = materialized(_resolved(edges))
    found = _walk_by_level(lanes, edges, deepest, unmatched_hops) if unmatched_hops else _walk_by_root(lanes, edges.filter("matched").drop("matched"), deepest)
    nodes = reduce(DataFrame.unionByName, found).drop("reach")
    return nodes if typed else nodes.drop("type")


def spliced_lengths(nodes: DataFrame, bodies: DataFrame, depths: list[int]) -> DataFrame:
    """(root, lane, depth, length): 1 and the body of every node up to each depth, from one walk to the greatest.

    bodies: section_id, variant_idx, body_len.
    """
    own = nodes.join(bodies, ["section_id", "variant_idx"], "left").groupBy("root", "lane", "depth").agg(F.sum(1 + F.coalesce("body_len", F.lit(0))).alias("own"))
    at = own.select("root", "lane", F.col("depth").alias("d"), "own", F.explode(F.array(*[F.lit(d) for d in depths])).alias("depth")).filter("d <= depth")
    total = at.groupBy("root", "lane", "depth").agg(F.sum("own").alias("length"))
    return total.withColumn("length", F.when(F.col("length") < 1 << 30, F.col("length")).otherwise(F.raise_error(F.lit("spliced length out of range"))))


def excluded_pool(full: DataFrame, sampled: DataFrame) -> DataFrame:
    """Nodes that the walk over all variants includes and the sampled one doesn't, in the full walk's order."""
    return full.join(sampled.select("root", "lane", "section_id"), ["root", "lane", "section_id"], "left_anti")


def surface_matched(start: DataFrame, edges: DataFrame, matched: DataFrame, max_hops: int = 3) -> DataFrame:
    """(root, section_id, hops): matched sections behind unmatched ones, through at least and at most so many (max_hops) of those.

    start: root, section_id of unmatched callees; matched: section_id. The state is (root, section): the shortest
    way to an unmatched section serves all that lies behind it.
    """
    hop = edges.select("section_id", "callee_section").distinct()
    known = matched.select("section_id", F.lit(True).alias("m")).distinct()
    level = seen = start.select("root", "section_id").distinct()
    found = []
    for hops in range(1, max_hops + 1):
        step = level.join(hop, "section_id").select("root", F.col("callee_section").alias("section_id")).distinct()
        step = materialized(step.join(seen, ["root", "section_id"], "left_anti").join(known, "section_id", "left"))
        found.append(step.filter("m").select("root", "section_id", F.lit(hops).alias("hops")))
        level = step.filter("m is null").select("root", "section_id")
        seen = seen.unionByName(level)
    return reduce(DataFrame.unionByName, found).groupBy("root", "section_id").agg(F.min("hops").alias("hops"))


def backfill(pool: Column, budget: Column, kept=lambda x: x["length"]) -> Column:
    """Items of the pool array (struct with length) that fit wholly into what is left of the budget, in pool order: (left, taken).

    An item that doesn't fit is passed over and later, smaller ones are still tried. kept: what of an item is taken.
    """
    def step(acc: Column, x: Column) -> Column:
        fits = x["length"] <= acc["left"]
        return F.struct(F.when(fits, acc["left"] - x["length"]).otherwise(acc["left"]).alias("left"),
                        F.when(fits, F.concat(acc["taken"], F.array(kept(x)))).otherwise(acc["taken"]).alias("taken"))

    return F.aggregate(pool, F.struct(budget.cast("long").alias("left"), F.slice(F.transform(pool, kept), 1, 0).alias("taken")), step)
