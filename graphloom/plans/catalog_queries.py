"""Registered queries: every operator on the driver's tables, and the SQL that each equals.

The tables stand for a machine-code corpus as the comments say. `{name}` is a table; the same base
SQL feeds Spark and DuckDB.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.functions import axes, codecs, metadata, numbers
from graphloom.operators import arms, catalog, decode, graph, inspect, lengths, sampling, stats, validate, vocab
from graphloom.plans.materialize import materialized

FLAGSHIP = "d3_gated_length_histogram"
QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def base(spark: SparkSession, d: str, sql: str) -> DataFrame:
    names = set(re.findall(r"\{(\w+)\}", sql))
    return spark.sql(sql, **{n: spark.read.parquet(f"{d}/{n}.parquet") for n in names})


def duck(sql: str) -> str:
    return re.sub(r"\{(\w+)\}", r"\1", sql)


def query(name: str, sql: str | None = None):
    def register(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLE[name] = duck(sql)
        return f

    return register


# orders as function rows: customer groups are programs, priorities the variants' streams.
FUNCS = """SELECT concat('p', CAST(o_custkey % 7 AS STRING)) AS program, substr(o_orderpriority, 1, 1) AS vkey,
  concat(CASE WHEN o_custkey % 11 = 0 THEN '.L' ELSE 'f' END, CAST(o_custkey % 500 AS STRING)) AS func_name,
  o_orderkey AS ord, CAST(floor(o_totalprice / 60000) AS BIGINT) AS body FROM {orders}"""
# lineitem as variants of sections: an order is a section, a part its body, the quantity its length.
NODES = "SELECT l_orderkey AS section_id, l_partkey AS body_id, CAST(l_quantity AS BIGINT) AS length FROM {lineitem}"
# part as sections with up to four variants.
FOUR, THREE = "(VALUES (0), (1), (2), (3)) AS t(v)", "(VALUES (0), (1), (2)) AS u(s)"
VARS = f"""SELECT p_partkey AS section_id, v AS variant_idx, concat('v', CAST(v AS STRING)) AS vkey, CAST((p_size * 7 + v * 3) % 40 AS BIGINT) AS body_len
  FROM {{part}} CROSS JOIN {FOUR} WHERE v <= p_size % 4"""
CALLS = f"""SELECT p_partkey AS section_id, v AS variant_idx, concat('v', CAST(v AS STRING)) AS vkey, s AS called_idx,
  (p_partkey * (s + 2) + p_size * 5 + s) % 2000 AS callee_section, p_size % 13 = 0 AND s = 1 AS callee_duplicated
  FROM {{part}} CROSS JOIN {FOUR} CROSS JOIN {THREE} WHERE v <= p_size % 4 AND (p_partkey + v + s) % 3 <> 0"""
ENTRIES = f"""SELECT c.section_id, c.variant_idx, c.called_idx, c.callee_section, CASE WHEN c.callee_duplicated THEN 65534 ELSE coalesce(v.variant_idx, 65534) END AS j
  FROM ({CALLS}) c LEFT JOIN ({VARS}) v ON v.section_id = c.callee_section AND v.vkey = c.vkey"""
EDGES = f"""SELECT section_id, variant_idx, called_idx, callee_section, coalesce(own, sibling) AS callee_variant FROM (
  SELECT *, arg_min(own, variant_idx) FILTER (WHERE own IS NOT NULL) OVER (PARTITION BY section_id, called_idx) AS sibling
  FROM (SELECT *, CASE WHEN j >= 65534 THEN NULL ELSE j END AS own FROM ({ENTRIES}))) WHERE coalesce(own, sibling) IS NOT NULL"""


def entries(spark, d):
    return catalog.call_entries(base(spark, d, CALLS), base(spark, d, VARS))


def edges(spark, d):
    return catalog.resolve_variants(entries(spark, d))


# --- arms

CLASSIFIED = f"""SELECT program, vkey, func_name, ord, body, worst > 1 AS is_duplicated, CASE WHEN worst = 1 AND streams > 1 THEN 'matched' ELSE 'unmatched' END AS arm
  FROM (SELECT f.*, max(c) OVER n AS worst, approx.streams FROM (SELECT *, count(*) OVER (PARTITION BY program, func_name, vkey) AS c FROM ({FUNCS})) f
        JOIN (SELECT program, func_name, count(DISTINCT vkey) AS streams FROM ({FUNCS}) GROUP BY ALL) approx USING (program, func_name) WINDOW n AS (PARTITION BY program, func_name))"""
REROUTED = f"""SELECT * REPLACE (CASE WHEN arm = 'matched' AND min(body) OVER n = max(body) OVER n THEN 'unmatched' ELSE arm END AS arm) FROM ({CLASSIFIED}) WINDOW n AS (PARTITION BY program, func_name)"""


@query("c1_lockstep_classification", CLASSIFIED)
def _(spark, d):
    return arms.classify(base(spark, d, FUNCS))


@query("d8_identical_variants_rerouted", REROUTED)
def _(spark, d):
    return arms.reroute_identical(arms.classify(base(spark, d, FUNCS)))


@query("b6_local_labels", f"SELECT program, func_name, count(*) AS n FROM ({FUNCS}) WHERE func_name NOT LIKE '.L%' GROUP BY ALL")
def _(spark, d):
    return arms.drop_local_labels(base(spark, d, FUNCS)).groupBy("program", "func_name").agg(F.count("*").alias("n"))


@query("g1_body_dedup", f"SELECT program, arm, body, min(ord) AS body_ord, count(*) AS n_uses FROM ({CLASSIFIED}) GROUP BY ALL")
def _(spark, d):
    return arms.dedup_bodies(arms.classify(base(spark, d, FUNCS)))


@query("e2_occurrence", f"SELECT program, func_name, vkey, ord, CAST(row_number() OVER (PARTITION BY program, vkey, func_name ORDER BY ord) - 1 AS INTEGER) AS occurrence FROM ({FUNCS})")
def _(spark, d):
    return arms.occurrence(base(spark, d, FUNCS), ["program", "vkey"]).select("program", "func_name", "vkey", "ord", "occurrence")


@query("g2_semantic_dedup", """
SELECT doc_id, source, lang, CAST(row_number() OVER w - 1 AS INTEGER) AS slot, diverges FROM (
  SELECT doc_id, source, lang, text IS DISTINCT FROM first_value(text) OVER w AS diverges, row_number() OVER w AS n FROM {documents} WINDOW w AS (PARTITION BY source, lang ORDER BY doc_id))
WHERE n = 1 OR diverges WINDOW w AS (PARTITION BY source, lang ORDER BY doc_id)""")
def _(spark, d):
    docs = base(spark, d, "SELECT doc_id, source, lang, text FROM {documents}")
    return arms.semantic_dedup(docs, ["source", "lang"], "text", "doc_id").select("doc_id", "source", "lang", "slot", "diverges")


@query("g3_canonical_names", """
SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN concat(p_name, '@', trim(regexp_replace(concat(p_type, ', ', p_brand, ' /"x"'), '[^A-Za-z0-9_.:<>()*&]+', '_', 'g'), '_'))
  WHEN p_size % 3 = 1 THEN concat(regexp_replace(p_brand, '[^A-Za-z0-9_.:<>()*&]+', '_', 'g'), ':thunk') ELSE p_name END AS canonical FROM {part}""")
def _(spark, d):
    p = base(spark, d, "SELECT * FROM {part}")
    comment = F.when(F.col("p_size") % 3 == 0, F.concat("p_type", F.lit(", "), "p_brand", F.lit(' /"x"')))
    key = F.when(F.col("p_size") % 3 == 1, F.col("p_brand"))
    return p.select("p_partkey", arms.canonical_name(F.col("p_name"), comment, key).alias("canonical"))


@query("g9_output_comparison", "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM {orders} WHERE o_orderkey % 2 = 1 GROUP BY ALL")
def _(spark, d):
    o = base(spark, d, "SELECT o_orderkey, o_orderstatus, o_orderpriority FROM {orders}")
    return arms.compare_outputs(o, o.filter("o_orderkey % 2 = 0")).groupBy("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n"))


# --- lengths

GATED = f"SELECT section_id, count(*) AS n_variants, count(DISTINCT body_id) AS n_bodies FROM ({NODES}) GROUP BY section_id HAVING count(*) >= 2 AND count(DISTINCT body_id) >= 2"


def _percentile_sql(q: int, source: str = NODES, key: str = "section_id") -> str:
    return f"SELECT {key}, list_sort(list(length))[CAST(floor((count(*) - 1) * ({q} / 100.0::DOUBLE)) AS INTEGER) + 1] AS length FROM ({source}) GROUP BY {key}"


@query("b7_variant_gate", GATED)
def _(spark, d):
    return lengths.gate(base(spark, d, NODES), ["section_id"], "body_id", 2, 2)


@query("d1_reduce_max", f"SELECT section_id, max(length) AS length FROM ({NODES}) GROUP BY section_id")
def _(spark, d):
    return lengths.reduce_lengths(base(spark, d, NODES), ["section_id"], "max")


for _q in (5, 29, 75, 95):
    @query(f"d1_reduce_p{_q:02d}", _percentile_sql(_q))
    def _(spark, d, q=_q):
        return lengths.reduce_lengths(base(spark, d, NODES), ["section_id"], f"p{q}")


SUPPLIERS = "SELECT l_suppkey AS section_id, l_partkey % 50 AS body_id, CAST(l_quantity AS BIGINT) AS length FROM {lineitem}"


@query("d2_duplicate_adjusted_p75", f"SELECT section_id, CAST(trunc(length) AS BIGINT) AS length FROM ({_percentile_sql(75, f'SELECT section_id, avg(length) AS length FROM ({SUPPLIERS}) GROUP BY section_id, body_id')})")
def _(spark, d):
    return lengths.reduce_grouped(base(spark, d, SUPPLIERS), ["section_id"], "body_id", "p75")


@query("d2_duplicate_adjusted_max", f"SELECT section_id, max(length) AS length FROM ({SUPPLIERS}) GROUP BY section_id")
def _(spark, d):
    return lengths.reduce_grouped(base(spark, d, SUPPLIERS), ["section_id"], "body_id", "max")


GATED_P75 = f"SELECT section_id, length FROM ({_percentile_sql(75)}) SEMI JOIN ({GATED}) USING (section_id)"
HISTOGRAM = f"""WITH l AS ({GATED_P75}) SELECT r.length, count(l.section_id) AS n
  FROM (SELECT unnest(range((SELECT min(length) FROM l WHERE length > 0), (SELECT max(length) FROM l) + 1)) AS length) r LEFT JOIN l USING (length) GROUP BY r.length"""


def gated_p75(spark, d):
    nodes = base(spark, d, NODES)
    one = nodes.groupBy("section_id").agg(F.count("*").alias("n"), F.countDistinct("body_id").alias("b"), F.collect_list("length").alias("x")).filter("n >= 2 and b >= 2")
    return one.select("section_id", lengths.percentile_lower(F.col("x"), 75).alias("length"))  # gate and reduction in one shuffle


@query(FLAGSHIP, HISTOGRAM)
def _(spark, d):
    return lengths.histogram(gated_p75(spark, d))


@query("d4_band_count", f"SELECT count(*) AS n FROM ({GATED_P75}) WHERE length BETWEEN 10 AND 30")
def _(spark, d):
    return lengths.count_in_band(gated_p75(spark, d), 10, 30)


@query("f1_length_index", f"SELECT section_id, length, CAST(row_number() OVER (ORDER BY length, section_id) - 1 AS INTEGER) AS position FROM (SELECT l_suppkey AS section_id, CAST(max(l_quantity) AS BIGINT) AS length FROM {{lineitem}} GROUP BY l_suppkey) WHERE length > 0")
def _(spark, d):
    one = lengths.reduce_lengths(base(spark, d, SUPPLIERS), ["section_id"], "max").withColumn("mode", F.lit("max"))
    return lengths.length_index(one, ["mode"]).select("section_id", "length", "position")


@query("d9_unique_bodies", f"SELECT section_id, count(DISTINCT body_id) AS n_bodies FROM ({SUPPLIERS}) GROUP BY section_id")
def _(spark, d):
    return lengths.gate(base(spark, d, SUPPLIERS), ["section_id"], "body_id", 1, 1).select("section_id", "n_bodies")


@query("d13_auto_size", f"SELECT max(n) AS num_variants, max(m) + 64 AS context_len FROM (SELECT count(*) AS n, max(length) AS m FROM ({NODES}) GROUP BY section_id)")
def _(spark, d):
    return lengths.auto_size(base(spark, d, NODES), ["section_id"])


@query("d14_statistics", f"SELECT section_id, count(*) AS n_total, count(*) FILTER (length BETWEEN 10 AND 20) AS n_in_range FROM ({SUPPLIERS}) GROUP BY section_id")
def _(spark, d):
    return lengths.statistics(base(spark, d, SUPPLIERS), ["section_id"], 10, 20)


# --- catalog

@query("a23_function_names", f"SELECT program, func_name, CAST(row_number() OVER (PARTITION BY program ORDER BY func_name) AS INTEGER) AS fid FROM (SELECT DISTINCT program, func_name FROM ({FUNCS}))")
def _(spark, d):
    return catalog.names_registry(base(spark, d, FUNCS))


LIBS = "SELECT concat('p', CAST(l_suppkey % 5 AS STRING)) AS program, concat('lib', CAST(l_partkey % 37 AS STRING)) AS library, l_orderkey * 1000 + l_partkey AS ord FROM {lineitem}"


@query("a24_extern_providers", f"SELECT program, library, min(ord) AS first_ord, CAST(row_number() OVER (PARTITION BY program ORDER BY min(ord), library) AS INTEGER) AS pid FROM ({LIBS}) GROUP BY program, library")
def _(spark, d):
    return catalog.providers_registry(base(spark, d, LIBS))


CALLED = """SELECT concat('p', CAST(l_suppkey % 5 AS STRING)) AS program, l_suppkey AS section_id, ascii(l_returnflag) AS variant, l_orderkey AS pos, concat('f', CAST(l_partkey % 40 AS STRING)) AS callee,
  CAST(l_partkey % 3 AS INTEGER) AS type, concat('lib', CAST(l_partkey % 7 AS STRING)) AS library, CAST(l_quantity AS BIGINT) % 2 AS occurrence FROM {lineitem}"""
UNION_ = f"""SELECT program, section_id, callee, type, CAST(row_number() OVER (PARTITION BY program, section_id ORDER BY type, variant, pos, callee) - 1 AS INTEGER) AS called_idx FROM (
  SELECT program, section_id, callee, type, arg_min(variant, (variant, pos)) AS variant, arg_min(pos, (variant, pos)) AS pos FROM ({CALLED}) GROUP BY ALL)"""


def union(spark, d):
    # ties of one position between callees are broken by the callee's name
    rows = base(spark, d, CALLED).withColumn("pos", F.struct("pos", "callee"))
    return catalog.typed_union(rows, ["program", "section_id"])


@query("d5_typed_called_union", UNION_)
def _(spark, d):
    return union(spark, d)


@query("d6_extern_libraries", f"""SELECT section_id, callee, arg_min(library, (variant, library)) AS library, count(DISTINCT library) > 1 AS conflict FROM ({CALLED}) GROUP BY section_id, callee""")
def _(spark, d):
    return catalog.merge_extern_libraries(base(spark, d, CALLED), ["section_id"])


@query("d7_unmatched_groups", f"""SELECT program, func_name, occurrence, string_agg(vkey, ',' ORDER BY ord) AS vkeys FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY program, vkey, func_name ORDER BY ord) - 1 AS INTEGER) AS occurrence FROM ({FUNCS})) GROUP BY ALL""")
def _(spark, d):
    rows = arms.occurrence(base(spark, d, FUNCS), ["program", "vkey"])
    return catalog.group_unmatched(rows).withColumn("vkeys", F.array_join("vkeys", ","))


@query("g8_ambiguous_callees", f"SELECT section_id, callee, min(occurrence) AS occurrence FROM ({CALLED}) GROUP BY section_id, callee HAVING count(DISTINCT occurrence) <= 1")
def _(spark, d):
    return catalog.drop_ambiguous(base(spark, d, CALLED), ["section_id"])


SECTIONS = f"SELECT DISTINCT program, callee AS func_name, CAST(substr(callee, 2) AS BIGINT) AS section_id FROM ({CALLED}) WHERE type = 0 AND CAST(substr(callee, 2) AS BIGINT) % 4 <> 1"


@query("c5_call_targets", f"""SELECT *, CAST(row_number() OVER (PARTITION BY program, section_id ORDER BY eff_type, called_idx) - 1 AS INTEGER) AS target_idx FROM (
  SELECT u.*, s.section_id AS callee_section, CASE WHEN u.type IN (0, 1) AND s.section_id IS NULL THEN 2 ELSE u.type END AS eff_type
  FROM ({UNION_}) u LEFT JOIN ({SECTIONS}) s ON s.program = u.program AND s.func_name = u.callee)""")
def _(spark, d):
    return catalog.call_targets(union(spark, d), base(spark, d, SECTIONS), ["program", "section_id"])


@query("g4_sectioned_names", f"SELECT DISTINCT program, func_name FROM ({FUNCS})")
def _(spark, d):
    rows = arms.classify(base(spark, d, FUNCS))
    return catalog.sectioned_names(rows.filter("arm = 'matched'"), rows.filter("arm = 'unmatched'"))


@query("c3_lookup_table", f"""SELECT program, func_name, vkey, max(CASE WHEN ok THEN body END) AS body, bool_and(is_matched) AS is_matched FROM (
  SELECT *, arm = 'matched' AS is_matched, is_matched = bool_and(arm = 'matched') OVER (PARTITION BY program, func_name, vkey) AS ok FROM ({CLASSIFIED})) GROUP BY program, func_name, vkey""")
def _(spark, d):
    rows = arms.classify(base(spark, d, FUNCS))
    return catalog.lookup_table(rows.filter("arm = 'matched'").select("program", "func_name", "vkey", "body"), rows.filter("arm = 'unmatched'").select("program", "func_name", "vkey", "body"))


@query("c4_call_entries", ENTRIES)
def _(spark, d):
    return entries(spark, d).select("section_id", "variant_idx", "called_idx", "callee_section", "j")


@query("c6_callee_variants", EDGES)
def _(spark, d):
    return edges(spark, d)


SELECTION = f"SELECT section_id, variant_idx FROM ({VARS}) WHERE variant_idx < 2"


@query("c7_called_by", f"""SELECT section_id, called_idx, string_agg(CAST(variant_idx AS STRING), ',' ORDER BY variant_idx) AS variants FROM ({ENTRIES}) WHERE variant_idx < 2 GROUP BY ALL""")
def _(spark, d):
    return catalog.called_by(entries(spark, d), base(spark, d, SELECTION)).withColumn("variants", F.array_join("variants", ","))


@query("c8_narrow_vkeys", f"""SELECT DISTINCT e.section_id, e.called_idx, e.callee_section, v.vkey FROM ({ENTRIES}) e JOIN ({VARS}) v ON v.section_id = e.callee_section AND v.variant_idx = e.j WHERE e.j < 65534 AND e.variant_idx < 2""")
def _(spark, d):
    return catalog.narrow_vkeys(entries(spark, d), base(spark, d, SELECTION), base(spark, d, VARS))


@query("f8_variant_order", "SELECT l_orderkey AS section_id, ref AS variant_ref, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY ref) - 1 AS INTEGER) AS variant_idx FROM (SELECT DISTINCT l_orderkey, l_partkey AS ref FROM {lineitem})")
def _(spark, d):
    return catalog.order_variants(base(spark, d, "SELECT DISTINCT l_orderkey AS section_id, l_partkey AS variant_ref FROM {lineitem}"))


@query("c11_variant_refs", "SELECT o_custkey AS variant_ref, o_orderkey, c_name, c_mktsegment FROM {orders} LEFT JOIN (SELECT * FROM {customer} WHERE c_custkey % 3 <> 0) ON c_custkey = o_custkey")
def _(spark, d):
    rows = base(spark, d, "SELECT o_custkey AS variant_ref, o_orderkey FROM {orders}")
    return catalog.resolve_refs(rows, base(spark, d, "SELECT c_custkey AS variant_ref, c_name, c_mktsegment FROM {customer} WHERE c_custkey % 3 <> 0"))


PLANTED = f"SELECT section_id, variant_idx, called_idx, callee_section, CASE WHEN section_id % 17 = 0 THEN j + 1 WHEN section_id % 19 = 0 AND j < 65534 THEN 9 ELSE j END AS j FROM ({ENTRIES})"


@query("i9_corruption", f"""SELECT * FROM (SELECT e.section_id, e.variant_idx, e.called_idx, e.callee_section, e.j, CASE WHEN s.n IS NULL OR e.j >= s.n THEN 'out_of_range' WHEN m.vkey <> o.vkey THEN 'vkey_mismatch' END AS kind
  FROM ({PLANTED}) e LEFT JOIN (SELECT section_id, count(*) AS n FROM ({VARS}) GROUP BY section_id) s ON s.section_id = e.callee_section
  LEFT JOIN ({VARS}) m ON m.section_id = e.section_id AND m.variant_idx = e.variant_idx LEFT JOIN ({VARS}) o ON o.section_id = e.callee_section AND o.variant_idx = e.j WHERE e.j NOT IN (65534, 65535)) WHERE kind IS NOT NULL""")
def _(spark, d):
    bad = entries(spark, d).select("section_id", "variant_idx", "called_idx", "callee_section", F.expr("CASE WHEN section_id % 17 = 0 THEN j + 1 WHEN section_id % 19 = 0 AND j < 65534 THEN 9 ELSE j END").alias("j"))
    v = base(spark, d, VARS)
    return catalog.corruption(bad, v, v.groupBy("section_id").agg(F.count("*").alias("n_variants")))


@query("d20_corruption_report", ORACLE["i9_corruption"].replace("SELECT * FROM (", "SELECT kind, count(*) AS n, least(count(*), 10) AS n_samples FROM (", 1) + " GROUP BY kind")
def _(spark, d):
    return catalog.corruption_report(QUERIES["i9_corruption"](spark, d)).select("kind", "n", F.size("samples").cast("long").alias("n_samples"))


# --- graph

def levels_sql(depth: int, select: str, start: str = "SELECT section_id AS root, variant_idx AS lane, variant_idx FROM v") -> str:
    """Once-only inclusion from the rows of start, unrolled."""
    out = [f"WITH v AS MATERIALIZED ({VARS})", f"e AS MATERIALIZED ({EDGES})", f"rows AS MATERIALIZED ({start})", "k AS (SELECT root, count(*) AS n FROM rows WHERE variant_idx IS NOT NULL GROUP BY root)",
           "l0 AS (SELECT root, lane, 0 AS depth, CAST(0 AS BIGINT) AS ord, root AS section_id, variant_idx, -1 AS via FROM rows WHERE variant_idx IS NOT NULL)", "s0 AS (SELECT DISTINCT root, lane, root AS section_id FROM l0)"]
    for i in range(1, depth + 1):
        out.append(f"""f{i} AS MATERIALIZED (SELECT l.root, l.lane, l.ord AS parent, e.called_idx AS via, e.callee_section AS section_id, e.callee_variant AS variant_idx FROM l{i - 1} l JOIN e ON e.section_id = l.section_id AND e.variant_idx = l.variant_idx
  QUALIFY row_number() OVER (PARTITION BY l.root, l.lane, e.callee_section ORDER BY l.ord, e.called_idx, e.callee_variant) = 1)""")
        out.append(f"s{i} AS MATERIALIZED (SELECT * FROM s{i - 1} UNION SELECT root, lane, section_id FROM f{i})")
        out.append(f"x{i} AS (SELECT root, section_id FROM s{i} JOIN k USING (root) GROUP BY root, section_id HAVING count(*) = max(n))")
        out.append(f"""l{i} AS MATERIALIZED (SELECT root, lane, {i} AS depth, row_number() OVER (PARTITION BY root, lane ORDER BY parent, via) - 1 AS ord, section_id, variant_idx, via
  FROM f{i} ANTI JOIN s{i - 1} USING (root, lane, section_id) ANTI JOIN x{i} USING (root, section_id))""")
    every = " UNION ALL ".join(f"SELECT * FROM l{i}" for i in range(depth + 1))
    return ", ".join(out) + f", every AS ({every}) {select}"


def roots(spark, d):
    return base(spark, d, f"SELECT section_id AS root, variant_idx AS lane, variant_idx FROM ({VARS})")


@query("c9_frontier_expansion", f"SELECT section_id, variant_idx, called_idx, callee_section, callee_variant FROM ({EDGES}) WHERE variant_idx < 2")
def _(spark, d):
    return graph.expand(base(spark, d, SELECTION), edges(spark, d))


@query("c10_inclusion_closure", f"""WITH h AS MATERIALIZED (SELECT DISTINCT section_id, callee_section FROM ({EDGES})), a AS (SELECT DISTINCT section_id AS root, section_id FROM ({VARS})),
  b AS (SELECT DISTINCT a.root, h.callee_section AS section_id FROM a JOIN h USING (section_id)), c AS (SELECT DISTINCT b.root, h.callee_section AS section_id FROM b JOIN h USING (section_id))
  SELECT root, section_id, min(depth) AS depth FROM (SELECT *, 0 AS depth FROM a UNION ALL SELECT *, 1 FROM b UNION ALL SELECT *, 2 FROM c) GROUP BY root, section_id""")
def _(spark, d):
    return graph.closure(roots(spark, d).select("root").distinct(), edges(spark, d), 2)


@query("i1_once_only_inclusion", levels_sql(2, "SELECT * FROM every"))
def _(spark, d):
    return graph.included(roots(spark, d), edges(spark, d), 2)


@query("i3_spliced_lengths", levels_sql(3, "SELECT root, lane, d.depth, CAST(sum(1 + body_len) AS BIGINT) AS length FROM every x JOIN v USING (section_id, variant_idx) JOIN (VALUES (0), (1), (3)) d(depth) ON x.depth <= d.depth GROUP BY root, lane, d.depth"))
def _(spark, d):
    nodes = graph.included(roots(spark, d), edges(spark, d), 3)
    return graph.spliced_lengths(nodes, base(spark, d, VARS).select("section_id", "variant_idx", "body_len"), [0, 1, 3])


@query("i5_excluded_pool", f"""SELECT root, lane, depth, section_id, variant_idx FROM ({levels_sql(2, "SELECT * FROM every WHERE lane < 2")})
  ANTI JOIN ({levels_sql(2, "SELECT * FROM every", "SELECT section_id AS root, variant_idx AS lane, variant_idx FROM v WHERE variant_idx < 2")}) USING (root, lane, section_id)""")
def _(spark, d):
    e = materialized(edges(spark, d))
    some = roots(spark, d).filter("lane < 2")
    return graph.excluded_pool(graph.included(roots(spark, d), e, 2).filter("lane < 2"), graph.included(some, e, 2)).select("root", "lane", "depth", "section_id", "variant_idx")


@query("i7_surfaced_matched", f"""WITH h AS MATERIALIZED (SELECT DISTINCT section_id, callee_section FROM ({EDGES})), m AS (SELECT DISTINCT section_id FROM ({VARS}) WHERE section_id % 3 = 0),
  s AS (SELECT DISTINCT section_id AS root, callee_section AS section_id FROM h WHERE callee_section % 3 <> 0),
  p1 AS (SELECT root, callee_section AS section_id, [s.section_id, callee_section] AS path FROM s JOIN h USING (section_id) WHERE callee_section <> s.section_id),
  p2 AS (SELECT DISTINCT root, callee_section AS section_id, list_append(path, callee_section) AS path FROM p1 ANTI JOIN m USING (section_id) JOIN h USING (section_id) WHERE NOT list_contains(path, callee_section))
  SELECT root, section_id, min(hops) AS hops FROM (SELECT root, section_id, 1 AS hops FROM p1 SEMI JOIN m USING (section_id) UNION ALL SELECT root, section_id, 2 FROM p2 SEMI JOIN m USING (section_id)) GROUP BY root, section_id""")
def _(spark, d):
    e = edges(spark, d)
    start = e.select(F.col("section_id").alias("root"), F.col("callee_section").alias("section_id")).filter("section_id % 3 <> 0").distinct()
    return graph.surface_matched(start, e, base(spark, d, VARS).filter("section_id % 3 = 0").select("section_id").distinct(), 2)


@query("i8_backfill", """WITH RECURSIVE o AS (SELECT l_orderkey, list(CAST(l_quantity AS BIGINT) ORDER BY l_partkey, l_suppkey, l_quantity) AS q FROM {lineitem} GROUP BY l_orderkey),
  w AS (SELECT l_orderkey, q, 1 AS i, CAST(60 AS BIGINT) AS rest, CAST(0 AS BIGINT) AS taken FROM o
        UNION ALL SELECT l_orderkey, q, i + 1, CASE WHEN q[i] <= rest THEN rest - q[i] ELSE rest END, taken + CASE WHEN q[i] <= rest THEN 1 ELSE 0 END FROM w WHERE i <= len(q))
  SELECT l_orderkey, rest AS left_over, taken AS n_taken FROM w WHERE i = len(q) + 1""")
def _(spark, d):
    rows = base(spark, d, "SELECT l_orderkey, l_partkey, l_suppkey, l_quantity, CAST(l_quantity AS BIGINT) AS length FROM {lineitem}")
    pools = rows.groupBy("l_orderkey").agg(F.transform(F.array_sort(F.collect_list(F.struct("l_partkey", "l_suppkey", "l_quantity", "length"))), lambda x: F.struct(x["length"].alias("length"))).alias("pool"))
    return pools.withColumn("r", graph.backfill(F.col("pool"), F.lit(60))).select("l_orderkey", F.col("r.left").alias("left_over"), F.size("r.taken").cast("long").alias("n_taken"))


# --- decode: a text's word lengths and character codes stand for raw token ids.
ITEMS = "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, CAST(l_quantity AS BIGINT) AS length FROM {lineitem}"
TOTAL = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
RUNNING = f"coalesce(sum(length) OVER (PARTITION BY l_orderkey ORDER BY {', '.join(TOTAL)} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)"


@query("e3_context_cutoff", f"""SELECT l_orderkey, l_partkey, l_suppkey, length, start, greatest(0, least(length, 64 - start)) AS surviving, start <= 64 AND start + length > 64 AS is_cut
  FROM (SELECT *, CAST({RUNNING} AS BIGINT) AS start FROM ({ITEMS}))""")
def _(spark, d):
    return decode.cutoff(base(spark, d, ITEMS), ["l_orderkey"], TOTAL, F.lit(64).cast("long")).select("l_orderkey", "l_partkey", "l_suppkey", "length", "start", F.col("surviving").cast("long"), "is_cut")


@query("e1_exclusive_prefix", f"SELECT l_orderkey, l_partkey, l_suppkey, length, CAST({RUNNING} AS BIGINT) AS csr FROM ({ITEMS})")
def _(spark, d):
    return decode.exclusive_prefix(base(spark, d, ITEMS), ["l_orderkey"], TOTAL, "length", "csr").select("l_orderkey", "l_partkey", "l_suppkey", "length", "csr")


@query("e4_segmented_rank", f"SELECT l_orderkey, l_partkey, l_suppkey, length, CAST(row_number() OVER (PARTITION BY l_suppkey, l_linenumber ORDER BY l_orderkey, {', '.join(TOTAL[1:])}) - 1 AS INTEGER) AS rank FROM ({ITEMS})")
def _(spark, d):
    return decode.segmented_rank(base(spark, d, ITEMS), ["l_suppkey", "l_linenumber"], ["l_orderkey", *TOTAL[1:]]).select("l_orderkey", "l_partkey", "l_suppkey", "length", "rank")


FLAGS = "SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS pos, event_type = 'click' OR value > 50 AS flag FROM {events}"


@query("d21_run_lengths", f"""SELECT user_id, min(pos) AS start, count(*) AS run FROM (SELECT user_id, CAST(pos AS BIGINT) AS pos, pos - row_number() OVER (PARTITION BY user_id ORDER BY pos) AS g FROM ({FLAGS}) WHERE flag) GROUP BY user_id, g""")
def _(spark, d):
    return decode.run_lengths(base(spark, d, FLAGS).withColumn("pos", F.col("pos").cast("long")), ["user_id"], "pos", "flag")


#: A stream per conversation: numbers of characters, folded into all bands.
STREAM = "SELECT conv_id, turn, CASE WHEN turn % 4 = 0 THEN 257 WHEN turn % 4 = 1 THEN length(text) % 256 WHEN turn % 4 = 2 AND length(text) % 5 = 0 THEN 256 WHEN turn % 4 = 2 THEN length(text) % 256 ELSE 264 + length(text) % 40 END AS token FROM {conversations}"


def streams(spark, d):
    rows = base(spark, d, STREAM).groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "token"))).alias("ts"))
    return rows.select("conv_id", F.transform("ts", lambda t: t["token"].cast("int")).alias("tokens"))


_UNITS = f"""SELECT conv_id, unit, max(CASE WHEN token > 256 THEN token END) AS id, count(*) FILTER (token < 256) AS n_digits, bool_or(token = 256) AS negative FROM (
  SELECT *, sum(CASE WHEN token > 256 THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn) AS unit FROM ({STREAM})) GROUP BY conv_id, unit HAVING max(token) > 256"""


@query("e5_units_and_signs", f"SELECT conv_id, count(*) AS n_units, CAST(sum(n_digits) AS BIGINT) AS n_digits, count(*) FILTER (negative) AS n_negative FROM ({_UNITS}) GROUP BY conv_id")
def _(spark, d):
    rows = streams(spark, d).withColumn("u", decode.units(F.col("tokens"))).filter(F.size("u") > 0)
    return rows.select("conv_id", F.size("u").cast("long").alias("n_units"), F.aggregate("u", F.lit(0).cast("long"), lambda a, u: a + F.size(u["payload"])).alias("n_digits"), F.size(F.filter("u", lambda u: u["negative"])).cast("long").alias("n_negative"))


@query("h26_token_expansion", f"SELECT conv_id, string_agg(CAST(id - 256 AS STRING), ',' ORDER BY unit) AS tokens FROM ({_UNITS}) GROUP BY conv_id")
def _(spark, d):
    rows = streams(spark, d).withColumn("u", decode.units(F.col("tokens"))).filter(F.size("u") > 0)
    return rows.select("conv_id", F.array_join(decode.expand_tokens(F.col("u")), ",").alias("tokens"))


@query("d11_realized_geometry", f"SELECT conv_id, count(*) AS body_len, count(*) FILTER (id BETWEEN 264 AND 271) AS id_count, count(*) FILTER (id BETWEEN 257 AND 263) AS value_count FROM ({_UNITS}) GROUP BY conv_id")
def _(spark, d):
    return decode.geometry(streams(spark, d)).filter("body_len > 0").select("conv_id", *[F.col(c).cast("long") for c in ("body_len", "id_count", "value_count")])


@query("d10_category_distinct", f"""SELECT conv_id, id AS category, count(DISTINCT value) AS n_ids FROM (SELECT conv_id, unit, max(token) FILTER (token > 256) AS id, coalesce(sum(token * 256 ** back) FILTER (token < 256), 0) AS value FROM (
  SELECT *, count(*) FILTER (token < 256) OVER (PARTITION BY conv_id, unit ORDER BY turn DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS back FROM (
    SELECT *, sum(CASE WHEN token > 256 THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn) AS unit FROM ({STREAM}))) GROUP BY conv_id, unit) WHERE id IN (264, 268, 269, 270, 271) GROUP BY conv_id, id""")
def _(spark, d):
    return decode.category_distinct(streams(spark, d), ["conv_id"])


@query("m5_row_assembly", f"""SELECT conv_id, string_agg(CAST(id - 256 AS STRING), ',' ORDER BY unit) FILTER (n <= 8) || repeat(',0', CAST(greatest(0, 8 - count(*)) AS INTEGER)) AS tokens
  FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY unit) AS n FROM ({_UNITS})) GROUP BY conv_id""")
def _(spark, d):
    parts = streams(spark, d).withColumn("u", decode.units(F.col("tokens"))).filter(F.size("u") > 0).select("conv_id", F.lit(0).alias("part"), decode.expand_tokens(F.col("u")).alias("tokens"))
    return decode.assemble(parts, ["conv_id"], ["part"], 8).select("conv_id", F.array_join("tokens", ",").alias("tokens"))


MENTIONS = "SELECT conv_id, role AS category, CAST(length(text) % 7 AS BIGINT) AS fid, turn AS ord FROM {conversations}"


@query("i10_identity_remap", f"""SELECT m.conv_id, m.category, m.fid, m.ord, CAST(d.dense_id AS INTEGER) AS dense_id FROM ({MENTIONS}) m JOIN (
  SELECT conv_id, category, fid, row_number() OVER (PARTITION BY conv_id, category ORDER BY min(ord)) - 1 AS dense_id FROM ({MENTIONS}) GROUP BY conv_id, category, fid) d USING (conv_id, category, fid)""")
def _(spark, d):
    return decode.remap_functions(base(spark, d, MENTIONS), ["conv_id"]).select("conv_id", "category", "fid", "ord", "dense_id")


@query("i10_counter_remap", "SELECT conv_id, role AS category, turn AS ord, length(text) AS n_ids, CAST(coalesce(sum(length(text)) OVER (PARTITION BY conv_id, role ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS base FROM {conversations}")
def _(spark, d):
    rows = base(spark, d, "SELECT conv_id, role AS category, turn AS ord, CAST(length(text) AS BIGINT) AS n_ids FROM {conversations}")
    return decode.remap_counters(rows, ["conv_id"])


SIZES = "SELECT p_partkey AS section_id, CAST(p_size % 7 AS INTEGER) AS n_variants FROM {part}"


@query("j8_pad_null", f"SELECT section_id, s AS slot, CASE WHEN s < n_variants THEN s END AS variant_idx FROM ({SIZES}) CROSS JOIN (VALUES (0), (1), (2), (3)) t(s)")
def _(spark, d):
    return decode.pad_null(base(spark, d, SIZES), 4)


@query("j10_pad_ragged", f"SELECT section_id, s AS slot, s AS variant_idx FROM ({SIZES}) CROSS JOIN (VALUES (0), (1), (2), (3)) t(s) WHERE s < n_variants")
def _(spark, d):
    return decode.pad_ragged(base(spark, d, SIZES), 4)


@query("j9_pad_resample", f"""SELECT section_id, CAST(s AS INTEGER) AS slot, CASE WHEN s < n_variants THEN s WHEN n_variants > 0 THEN CAST(('0x' || substr(md5(concat_ws('|', '7', section_id, s)), 1, 8)) AS BIGINT) % n_variants END::INTEGER AS variant_idx
  FROM ({SIZES}) CROSS JOIN (VALUES (0), (1), (2), (3)) t(s)""")
def _(spark, d):
    return decode.pad_resample(base(spark, d, SIZES), 4, 7)


@query("j11_pad_redistribute", f"""WITH z AS ({SIZES}), g AS (SELECT section_id, s AS slot, CASE WHEN s < n_variants THEN s END AS variant_idx FROM z CROSS JOIN (VALUES (0), (1), (2), (3)) t(s)),
  h AS (SELECT *, row_number() OVER (ORDER BY section_id, slot) AS n FROM g WHERE variant_idx IS NULL),
  o AS (SELECT section_id AS donor, v AS given, row_number() OVER (ORDER BY md5(concat_ws('|', '7', section_id, v)), section_id, v) AS n FROM z CROSS JOIN (VALUES (4), (5), (6)) t(v) WHERE v < n_variants)
  SELECT section_id, slot, section_id AS source, variant_idx FROM g WHERE variant_idx IS NOT NULL UNION ALL SELECT h.section_id, h.slot, coalesce(o.donor, h.section_id), o.given FROM h LEFT JOIN o USING (n)""")
def _(spark, d):
    return decode.pad_redistribute(base(spark, d, SIZES), 4, sampling.draw_key(7, "section_id", "variant_idx"))


# --- sampling

INDEX = "SELECT concat('p', CAST(l_suppkey % 5 AS STRING)) AS program, l_orderkey AS section_id, CAST(max(l_quantity) AS BIGINT) AS length FROM {lineitem} GROUP BY l_suppkey % 5, l_orderkey"
DRAWN = f"SELECT program, section_id, length FROM ({INDEX}) WHERE length BETWEEN 20 AND 40 ORDER BY md5(concat_ws('|', '11', program, section_id)), program, section_id LIMIT 500"


@query("j2_band_sample", DRAWN)
def _(spark, d):
    return sampling.sample_sections(base(spark, d, INDEX), 20, 40, 500, 11, ["program"])


@query("j1_urn_counts", f"SELECT program, count(*) AS n FROM ({DRAWN}) GROUP BY program")
def _(spark, d):
    return sampling.cell_counts(base(spark, d, INDEX), 20, 40, 500, 11, ["program"])


@query("j4_band_enumeration", f"SELECT program, section_id, length FROM ({INDEX}) WHERE length BETWEEN 20 AND 25")
def _(spark, d):
    return sampling.enumerate_in_band(base(spark, d, INDEX), 20, 25)


@query("f6_variant_cap", f"""SELECT section_id, variant_idx FROM ({VARS}) QUALIFY row_number() OVER (PARTITION BY section_id ORDER BY md5(concat_ws('|', '5', section_id, variant_idx)), variant_idx) <= 2""")
def _(spark, d):
    return sampling.cap_variants(base(spark, d, VARS), 2, 5).select("section_id", "variant_idx")


@query("j6_exhaustive", """SELECT section_id, n_variants, CAST(floor((row_number() OVER (ORDER BY section_id) - 1) / 16.0) AS BIGINT) AS group_id FROM (SELECT p_partkey AS section_id, CAST(p_size % 7 AS INTEGER) AS n_variants FROM {part})""")
def _(spark, d):
    rows = base(spark, d, "SELECT 'all' AS program, p_partkey AS section_id, CAST(p_size % 7 AS INTEGER) AS n_variants, 1 AS length FROM {part}")
    return sampling.exhaustive(rows, 16, ["program"]).select("section_id", F.size("variants").alias("n_variants"), "group_id")


@query("j5_validation_batches")
def _(spark, d):
    return sampling.validation_batches(base(spark, d, SIZES), 2, 42)


# --- vocabulary: words of documents, a language being a file

WORDS = "SELECT lang AS file, doc_id, text FROM {documents}"


@query("d18_frequency_vocab", """SELECT token, CAST(row_number() OVER (ORDER BY n DESC, token) + 1 AS INTEGER) AS id, n FROM (SELECT token, count(*) AS n FROM (SELECT unnest(string_split(text, ' ')) AS token FROM {documents}) GROUP BY token HAVING count(*) >= 3 ORDER BY n DESC, token LIMIT 998)
  UNION ALL SELECT '<pad>', 0, 0 UNION ALL SELECT '<unk>', 1, 0""")
def _(spark, d):
    return vocab.frequency_vocab(base(spark, d, WORDS).select(F.explode(F.split("text", " ", -1)).alias("token")), 1000, 3)


LOCAL = "SELECT o_orderpriority AS binary, CAST(ascii(o_orderpriority) AS BIGINT) AS file_ord, 257 + o_orderkey AS local_id, concat('t', CAST(o_custkey % 700 AS STRING)) AS token FROM {orders}"
UNIFIED = f"""SELECT token, CAST(row_number() OVER (ORDER BY tail, f, l, token) + 271 AS INTEGER) AS unified_id FROM (
  SELECT token, 0 AS tail, arg_min(file_ord, (file_ord, local_id)) AS f, arg_min(local_id, (file_ord, local_id)) AS l FROM ({LOCAL}) GROUP BY token
  UNION ALL SELECT DISTINCT concat('axis:', r_name), 1, r_regionkey, 0 FROM {{region}})"""


def unified(spark, d):
    return vocab.unify(base(spark, d, LOCAL), base(spark, d, "SELECT CAST(r_regionkey AS BIGINT) AS axis_ord, concat('axis:', r_name) AS token FROM {region}"))


@query("o1_unify_vocab", UNIFIED)
def _(spark, d):
    return unified(spark, d)


@query("o2_vocab_mapping", f"SELECT l.binary, l.local_id, coalesce(u.unified_id, -1)::BIGINT AS unified_id FROM ({LOCAL}) l LEFT JOIN ({UNIFIED}) u USING (token)")
def _(spark, d):
    return vocab.mapping(base(spark, d, LOCAL), unified(spark, d))


@query("n7_vocab_ceiling", f"SELECT count(*) + 272 AS n_ids FROM ({UNIFIED})")
def _(spark, d):
    return vocab.check_ceiling(unified(spark, d))


@query("d22_axis_inventory", "SELECT axis_ord, token, CAST(row_number() OVER (ORDER BY axis_ord, token) - 1 AS INTEGER) AS place FROM (SELECT DISTINCT 0 AS axis_ord, p_brand AS token FROM {part} UNION SELECT DISTINCT 1, p_type FROM {part})")
def _(spark, d):
    return vocab.inventory(base(spark, d, "SELECT 0 AS axis_ord, p_brand AS token FROM {part} UNION ALL SELECT 1, p_type FROM {part}"))


@query("a8_vocab_load", "SELECT user_id AS binary, CAST(257 + row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS INTEGER) AS local_id, concat(event_type, event_id) AS token FROM {events}")
def _(spark, d):
    rows = base(spark, d, "SELECT user_id AS binary, event_id, concat(event_type, event_id) AS token FROM {events}")
    cells = rows.groupBy("binary").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("event_id", "token"))), lambda x: x["token"]), ",").alias("cell"))
    return vocab.load(cells)


@query("d17_vocab_count", "SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN NULL WHEN p_size % 5 = 1 THEN 0 ELSE len(string_split(replace(p_name, ' ', ','), ',')) END AS n FROM {part}")
def _(spark, d):
    cell = F.expr("CASE WHEN p_size % 5 = 0 THEN NULL WHEN p_size % 5 = 1 THEN '' ELSE replace(p_name, ' ', ',') END")
    return base(spark, d, "SELECT * FROM {part}").select("p_partkey", vocab.vocab_count(cell).cast("long").alias("n"))


# --- statistics: parts as binaries

BINARIES = """SELECT p_partkey AS id, p_brand AS program, p_type AS isa_exact, split_part(p_type, ' ', 1) AS isa_family, p_brand AS comp, concat('O', CAST(p_size % 4 AS STRING)) AS optim_level,
  CASE WHEN p_size % 9 = 0 THEN NULL ELSE CAST(p_size * 1000 AS BIGINT) END AS raw_size, CASE WHEN p_size % 8 = 0 THEN NULL ELSE p_size END AS vocab_size FROM {part}"""
PHASE1 = "SELECT l_partkey AS binary_id, CASE WHEN l_linenumber % 2 = 0 THEN 'strings_bin' ELSE 'output_csv' END AS kind, CAST(l_quantity AS BIGINT) AS size_bytes FROM {lineitem}"
PHASE3 = "SELECT CASE WHEN l_partkey % 10 = 0 THEN concat('only', CAST(l_partkey % 7 AS STRING)) ELSE p_brand END AS program, CASE WHEN l_returnflag = 'A' THEN 'data_bin' ELSE 'sections_bin' END AS kind, CAST(l_quantity AS BIGINT) AS size_bytes FROM {lineitem} JOIN {part} ON p_partkey = l_partkey"


def _share_sql(axis: str) -> str:
    return f"""WITH known AS (SELECT id, {axis}, raw_size FROM ({BINARIES}) WHERE raw_size > 0),
  texts AS (SELECT binary_id, size_bytes FROM ({PHASE1}) WHERE kind = 'strings_bin')
SELECT {axis}, count(*) AS files, avg(size_bytes / raw_size) AS mean_share FROM texts, known WHERE id = binary_id GROUP BY ALL"""


for _name, _axis in (("c12_strings_ratio_by_family", "isa_family"), ("d15_strings_ratio_by_isa", "isa_exact")):
    @query(_name, _share_sql(_axis))
    def _(spark, d, axis=_axis):
        texts = base(spark, d, PHASE1).filter("kind = 'strings_bin'")
        return stats.share_by(base(spark, d, BINARIES), texts, [axis], "id", "binary_id", "raw_size", "size_bytes")


@query("c13_raw_against_phase3", f"""WITH units AS ({BINARIES}), files AS ({PHASE3}), programs AS (SELECT program FROM units UNION SELECT program FROM files)
SELECT program, u.n AS units, u.known, u.bytes AS whole_total, f.data AS data_bin, f.bytes - f.data AS rest, f.bytes AS total, CASE WHEN u.bytes > 0 THEN f.bytes / u.bytes END AS growth
FROM programs LEFT JOIN (SELECT program, count(*) AS n, count(raw_size) AS known, CAST(sum(raw_size) AS BIGINT) AS bytes FROM units GROUP BY program) u USING (program)
LEFT JOIN (SELECT program, CAST(sum(size_bytes) AS BIGINT) AS bytes, CAST(coalesce(sum(size_bytes) FILTER (kind = 'data_bin'), 0) AS BIGINT) AS data FROM files GROUP BY program) f USING (program)""")
def _(spark, d):
    built = stats.sums_by_kind(base(spark, d, PHASE3), "program", "kind", "size_bytes", ["data_bin"])
    return stats.against(base(spark, d, BINARIES), built, "program", "raw_size")


@query("d15b_vocab_by_compiler", f"SELECT comp, optim_level, count(vocab_size) AS known, avg(vocab_size) AS mean FROM ({BINARIES}) GROUP BY ALL HAVING known > 0")
def _(spark, d):
    return stats.mean_by(base(spark, d, BINARIES), ["comp", "optim_level"], "vocab_size")


@query("c14_two_candidate_join", """WITH a AS (SELECT concat('c', CAST(o_custkey AS STRING)) AS parent, concat('n', CAST(o_orderkey % 200 AS STRING)) AS stem, CAST(o_orderkey AS STRING) AS path, CAST(floor(o_totalprice) AS BIGINT) AS size_bytes FROM {orders}),
  s AS (SELECT concat('c', CAST(c_custkey AS STRING)) AS source, CAST(c_nationkey + 1 AS BIGINT) AS b FROM {customer} WHERE c_custkey % 2 = 0 UNION ALL SELECT concat('n', CAST(s_suppkey AS STRING)), CAST(s_nationkey AS BIGINT) FROM {supplier}),
  p AS (SELECT a.path, a.size_bytes, coalesce(x.source, y.source) AS source, coalesce(x.b, y.b) AS source_bytes FROM a LEFT JOIN s x ON x.source = a.parent LEFT JOIN s y ON y.source = a.stem),
  r AS (SELECT * FROM p UNION ALL SELECT NULL, NULL, s.source, s.b FROM s WHERE s.source NOT IN (SELECT source FROM p WHERE source IS NOT NULL))
  SELECT *, CASE WHEN source_bytes > 0 THEN size_bytes / source_bytes END AS ratio, CASE WHEN source IS NULL THEN 'no_source' WHEN path IS NULL THEN 'no_artifact' ELSE 'paired' END AS status FROM r""")
def _(spark, d):
    a = base(spark, d, "SELECT concat('c', CAST(o_custkey AS STRING)) AS parent, concat('n', CAST(o_orderkey % 200 AS STRING)) AS stem, CAST(o_orderkey AS STRING) AS path, CAST(floor(o_totalprice) AS BIGINT) AS size_bytes FROM {orders}")
    s = base(spark, d, "SELECT concat('c', CAST(c_custkey AS STRING)) AS path, CAST(c_nationkey + 1 AS BIGINT) AS size_bytes FROM {customer} WHERE c_custkey % 2 = 0 UNION ALL SELECT concat('n', CAST(s_suppkey AS STRING)), CAST(s_nationkey AS BIGINT) FROM {supplier}")
    return stats.pair_sizes(a, s)


@query("c15_covered_raw", "SELECT count(*) AS n_files, CAST(sum(p_size) AS BIGINT) AS raw_total FROM {part} WHERE p_partkey IN (SELECT l_partkey FROM {lineitem} WHERE l_returnflag = 'R')")
def _(spark, d):
    return stats.covered_raw(base(spark, d, "SELECT p_partkey AS program, CAST(p_size AS BIGINT) AS size_bytes FROM {part}"), base(spark, d, "SELECT l_partkey AS program FROM {lineitem} WHERE l_returnflag = 'R'"))


@query("c16_qualified_names", """SELECT folder, name, CASE WHEN k = 1 THEN name ELSE concat(folder, '/', name) END AS label, m > 1 AS is_collision FROM (
  SELECT c_mktsegment AS folder, concat('n', CAST(c_custkey % 900 AS STRING)) AS name, count(*) AS m FROM {customer} GROUP BY ALL) JOIN (SELECT concat('n', CAST(c_custkey % 900 AS STRING)) AS name, count(DISTINCT c_mktsegment) AS k FROM {customer} GROUP BY ALL) USING (name)""")
def _(spark, d):
    return stats.qualified_names(base(spark, d, "SELECT c_mktsegment AS folder, concat('n', CAST(c_custkey % 900 AS STRING)) AS name FROM {customer}"))


@query("d23_size_summary", "SELECT l_returnflag, count(*) AS n, min(l_quantity) AS least, avg(l_quantity) AS mean, max(l_quantity) AS most FROM {lineitem} GROUP BY l_returnflag")
def _(spark, d):
    return stats.size_summary(base(spark, d, "SELECT l_returnflag, l_quantity AS ratio FROM {lineitem}"), ["l_returnflag"])


@query("a33_first_root", "SELECT concat('b', CAST(o_custkey AS STRING)) AS base, min(o_orderkey) AS root_ord, arg_min(o_orderstatus, o_orderkey) AS path, arg_min(o_totalprice, o_orderkey) AS size_bytes FROM {orders} GROUP BY o_custkey")
def _(spark, d):
    return stats.first_root(base(spark, d, "SELECT concat('b', CAST(o_custkey AS STRING)) AS base, o_orderkey AS root_ord, o_orderstatus AS path, o_totalprice AS size_bytes FROM {orders}"))


@query("f7_size_deal", "SELECT p_partkey AS path, CAST((row_number() OVER (ORDER BY p_retailprice DESC, p_partkey) - 1) % 6 AS INTEGER) AS list_id FROM {part}")
def _(spark, d):
    return stats.deal_by_size(base(spark, d, "SELECT p_partkey AS path, p_retailprice AS size_bytes FROM {part}"), 6).select("path", "list_id")


# --- inspection: parts as variants

PARTS = "SELECT p_partkey, p_name, p_brand, p_type, CASE WHEN p_size % 10 = 0 THEN NULL ELSE p_size END AS p_size FROM {part}"


@query("b9_axis_filter", f"SELECT * FROM ({PARTS}) WHERE coalesce(CAST(p_size AS STRING), '?') NOT IN ('?', '7', '11') AND coalesce(p_brand, '?') NOT IN ('Brand#11', 'Brand#22')")
def _(spark, d):
    return inspect.axis_filter(base(spark, d, PARTS), {"p_size": ["?", "7", "11"], "p_brand": ["Brand#11", "Brand#22"]})


@query("b10_function_filter", f"SELECT * FROM (SELECT DISTINCT p_type FROM {{part}}) WHERE p_type IN (SELECT p_type FROM ({PARTS}) WHERE coalesce(CAST(p_size AS STRING), '?') NOT IN ('?', '1'))")
def _(spark, d):
    return inspect.functions_passing(base(spark, d, "SELECT DISTINCT p_type FROM {part}"), base(spark, d, PARTS), {"p_size": ["?", "1"]}, "p_type")


@query("b11_name_search", "SELECT p_partkey, p_name FROM {part} WHERE contains(lower(p_name), 'll w')")
def _(spark, d):
    return inspect.name_search(base(spark, d, "SELECT p_partkey, p_name FROM {part}"), "LL W", "p_name")


@query("f2_natural_sort", f"SELECT p_partkey, CAST(row_number() OVER (ORDER BY p_brand, p_size NULLS LAST, p_partkey) - 1 AS INTEGER) AS place FROM (SELECT p_partkey, CAST(substr(p_brand, 7) AS INTEGER) AS p_brand, p_size FROM ({PARTS}))")
def _(spark, d):
    return inspect.natural_sort(base(spark, d, PARTS), ["p_brand", "p_size", "p_partkey"]).select("p_partkey", "place")


@query("m18_group_tree", f"SELECT p_brand, coalesce(CAST(p_size AS STRING), '?') AS p_size, count(*) AS n, string_agg(CAST(p_partkey AS STRING), ',' ORDER BY p_type, p_partkey) AS leaves FROM ({PARTS}) GROUP BY ALL")
def _(spark, d):
    return inspect.group_tree(base(spark, d, PARTS), ["p_brand", "p_size"], ["p_type"], "p_partkey").withColumn("leaves", F.array_join("leaves", ","))


@query("m18b_group_leaves", f"SELECT p_brand, coalesce(CAST(p_size AS STRING), '?') AS p_size, CAST(row_number() OVER (PARTITION BY p_brand, p_size ORDER BY p_type, p_partkey) - 1 AS INTEGER) AS place, p_partkey AS leaf FROM ({PARTS})")
def _(spark, d):
    return inspect.group_leaves(base(spark, d, PARTS), ["p_brand", "p_size"], ["p_type"], "p_partkey")


@query("g7_axis_values", f"SELECT DISTINCT 'p_brand' AS axis, p_brand AS value FROM ({PARTS}) UNION SELECT DISTINCT 'p_size', coalesce(CAST(p_size AS STRING), '?') FROM ({PARTS})")
def _(spark, d):
    return inspect.axis_values(base(spark, d, PARTS), ["p_brand", "p_size"])


# --- scalar functions

NAMES = """SELECT p_partkey, concat(CASE p_size % 5 WHEN 0 THEN 'x86_64' WHEN 1 THEN 'armv7l-hf' WHEN 2 THEN 'mips64el' WHEN 3 THEN 'x64' ELSE 'vax' END, '-', CASE WHEN p_partkey % 2 = 0 THEN 'gcc' ELSE 'clang' END,
  CASE WHEN p_partkey % 11 = 0 THEN '' ELSE concat('-', CAST(p_size AS STRING), CASE WHEN p_partkey % 3 = 0 THEN '-rc1' ELSE '' END) END, '-O', CAST(p_partkey % 4 AS STRING), '_prog_', CAST(p_partkey % 9 AS STRING)) AS name FROM {part}"""


@query("h1_axes_parse", rf"""WITH n AS ({NAMES}), i AS (SELECT *, nullif(regexp_extract(name, '^(x86_64|armv7l-hf|mips64el|x64)-', 1), '') AS isa FROM n),
  r AS (SELECT *, CASE WHEN isa IS NULL THEN name ELSE substr(name, length(isa) + 2) END AS rest FROM i), s AS (SELECT *, string_split(split_part(rest, '_', 1), '-') AS p FROM r), t AS (SELECT *, isa IS NOT NULL AND len(p) >= 3 AS ok FROM s)
  SELECT p_partkey, substr(rest, length(split_part(rest, '_', 1)) + 2) AS program, CASE WHEN ok THEN isa END AS isa_exact,
    CASE WHEN ok THEN CASE isa WHEN 'x86_64' THEN 'x86' WHEN 'x64' THEN 'x86' WHEN 'armv7l-hf' THEN 'arm' ELSE 'mips' END END AS isa_family, CASE WHEN ok THEN CASE WHEN isa = 'armv7l-hf' THEN 32 ELSE 64 END END AS bitness,
    CASE WHEN ok THEN p[1] END AS comp, CASE WHEN ok THEN array_to_string(p[2:len(p) - 1], '-') END AS comp_version, CASE WHEN ok THEN p[len(p)] END AS optim_level FROM t""")
def _(spark, d):
    return base(spark, d, NAMES).select("p_partkey", axes.parse_axes(F.col("name")).alias("a")).select("p_partkey", "a.*")


@query("h4_axis_tokens", "SELECT p_partkey, concat('arch:', CASE WHEN p_size % 2 = 0 THEN 'x64' ELSE 'arm64' END, ' comp:gcc cver:gcc:', CAST(p_size AS STRING), ' opt:O2 flag:a flag:', p_brand) AS tokens FROM {part}")
def _(spark, d):
    p = base(spark, d, "SELECT p_partkey, p_brand, CASE WHEN p_size % 2 = 0 THEN 'amd64' ELSE 'aarch64' END AS arch, CAST(p_size AS STRING) AS version FROM {part}")
    extra = F.create_map(F.lit("flag"), F.array(F.lit("a"), F.lower("p_brand")))
    tokens = axes.axis_tokens(axes.variant_arch(F.col("arch")), F.lit("gcc"), F.col("version"), F.lit("-O2"), extra)
    return p.select("p_partkey", F.replace(F.array_join(tokens, " "), F.lower("p_brand"), F.col("p_brand")).alias("tokens"))


@query("h7_output_names", "SELECT p_partkey, concat('x64-gcc-', CAST(p_size AS STRING), '-O2_', p_brand, CASE WHEN p_partkey % 3 = 0 THEN '' ELSE concat('__', lpad(lower(printf('%x', p_partkey % 3 * 1000 + p_partkey)), 8, '0')) END) AS name FROM {part}")
def _(spark, d):
    p = base(spark, d, "SELECT p_partkey, p_brand, CAST(p_size AS STRING) AS version, CASE WHEN p_partkey % 3 = 0 THEN 0 ELSE p_partkey % 3 * 1000 + p_partkey END AS id FROM {part}")
    return p.select("p_partkey", axes.output_basename(F.lit("x64"), F.lit("gcc"), F.col("version"), F.lit("O2"), F.col("p_brand"), F.col("id")).alias("name"))


@query("h6_variant_id_suffix", "SELECT p_partkey, p_brand AS pkg, CASE WHEN p_partkey % 3 = 0 THEN 0 ELSE p_partkey + 4096 END AS variant_id FROM {part}")
def _(spark, d):
    p = base(spark, d, "SELECT p_partkey, p_brand, CASE WHEN p_partkey % 3 = 0 THEN 0 ELSE p_partkey + 4096 END AS id FROM {part}")
    name = F.when(F.col("id") == 0, F.col("p_brand")).otherwise(F.concat("p_brand", F.lit("__"), F.lower(F.lpad(F.hex("id"), 8, "0"))))
    return p.select("p_partkey", axes.split_variant_id(name).alias("s")).select("p_partkey", "s.pkg", "s.variant_id")


@query("b1_template_selection", rf"""SELECT p_partkey, s.a AS platform, s.b AS compiler, s.d AS level FROM (SELECT p_partkey, regexp_extract(name, '^([^-_]+(?:-hf)?)-([^-_]+)-([^-_]+)-([oO]?[0-3sz])_(.+)$', ['a', 'b', 'c', 'd', 'e']) AS s FROM ({NAMES}))
  WHERE s.a IN ('x64', 'mips64el') AND s.d IN ('O1', 'O2')""")
def _(spark, d):
    rows = base(spark, d, NAMES).withColumn("f", axes.parse_template(F.col("name"), "platform-compiler-version-optimisationlevel_binaryname"))
    kept = rows.filter(axes.selected(F.col("f"), {"platform": ["x64", "mips64el"], "optimisationlevel": ["O1", "O2"]}))
    return kept.select("p_partkey", "f.platform", "f.compiler", F.col("f.optimisationlevel").alias("level"))


@query("b3_opt_levels", "SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN 'O1' WHEN 1 THEN 'O2' WHEN 2 THEN 'fast' ELSE 'Os' END AS level FROM {part}")
def _(spark, d):
    p = base(spark, d, "SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN 'o1' WHEN 1 THEN 'O2' WHEN 2 THEN 'fast' ELSE 'os' END AS level FROM {part}")
    return p.select("p_partkey", axes.normalize_opt(F.col("level")).alias("level"))


@query("h8_metadata_callees", "SELECT event_id, concat_ws(',', event_type || ':0', 'k' || CAST(user_id % 5 AS STRING) || ':0', event_type || ':2:libc') AS callees FROM {events}")
def _(spark, d):
    e = base(spark, d, """SELECT event_id, concat('{{"local_funcs":[{{"name":"', event_type, '"}},{{"name":"k', CAST(user_id % 5 AS STRING), '"}},{{"name":"', event_type, '"}}],"ext_funcs":[{{"name":"', event_type, '","library":"libc"}}]}}') AS cell FROM {events}""".replace("{{", "\x01").replace("}}", "\x02"))
    cell = F.replace(F.replace(F.col("cell"), F.lit("\x01"), F.lit("{")), F.lit("\x02"), F.lit("}"))
    found = metadata.callees(metadata.parse(cell))
    return e.select("event_id", F.array_join(F.transform(found, lambda c: F.concat_ws(":", c["name"], c["type"].cast("string"), c["library"])), ",").alias("callees"))


@query("h12_escaped_names", "SELECT p_partkey, concat(replace(p_name, ' ', '\\,'), ',', p_brand) AS cell, 2 AS n, p_brand AS last FROM {part}")
def _(spark, d):
    p = base(spark, d, "SELECT p_partkey, p_name, p_brand FROM {part}")
    cell = codecs.join_names(F.array(F.replace("p_name", F.lit(" "), F.lit(",")), F.col("p_brand")))
    return p.select("p_partkey", cell.alias("cell")).withColumn("n", F.size(codecs.split_names(F.col("cell")))).withColumn("last", F.element_at(codecs.split_names(F.col("cell")), -1))


@query("h11_line_numbers", """SELECT p_partkey, p_partkey + 1 AS back, translate(rtrim(to_base64(unhex(CASE WHEN length(h) % 2 = 1 THEN '0' || h ELSE h END)), '='), '+/', '-_') AS cell
  FROM (SELECT p_partkey, printf('%x', p_partkey + 1) AS h FROM {part})""")
def _(spark, d):
    p = base(spark, d, "SELECT p_partkey, p_partkey + 1 AS n FROM {part}")
    return p.withColumn("cell", codecs.encode_line_no(F.col("n"))).select("p_partkey", codecs.decode_line_no(F.col("cell")).alias("back"), "cell")


@query("h14_inline_indexer", "SELECT p_partkey, p_partkey * 16 AS back, substr(h, 7, 2) || substr(h, 5, 2) || substr(h, 3, 2) || substr(h, 1, 2) AS cell FROM (SELECT p_partkey, printf('%08x', p_partkey) AS h FROM {part})")
def _(spark, d):
    p = base(spark, d, "SELECT p_partkey, p_partkey * 16 AS n FROM {part}")
    return p.withColumn("cell", codecs.inline_indexer(F.col("n"))).select("p_partkey", codecs.decode_inline_indexer(F.col("cell")).alias("back"), "cell")


@query("h16_least_bytes", "SELECT o_orderkey, o_orderkey * 977 AS back, CASE WHEN o_orderkey = 0 THEN 0 ELSE CAST(ceil(length(printf('%x', o_orderkey * 977)) / 2.0) AS INTEGER) END AS n FROM {orders}")
def _(spark, d):
    o = base(spark, d, "SELECT o_orderkey, o_orderkey * 977 AS v FROM {orders}").withColumn("b", codecs.least_bytes(F.col("v")))
    return o.select("o_orderkey", codecs.from_bytes(F.col("b")).alias("back"), F.size("b").alias("n"))


# The written form, bit by bit: width - 2, size of the length field (one unit for up to 15 values), length, values.
@query("a11_array_codec", """WITH a AS (SELECT l_orderkey, list(l_partkey ORDER BY l_linenumber, l_partkey) AS x, greatest(2, length(bin(max(l_partkey)))) AS w FROM {lineitem} GROUP BY l_orderkey),
  b AS (SELECT *, lpad(bin(w - 2), 5, '0') || '000' || lpad(bin(len(x)), 4, '0') || array_to_string(list_transform(x, lambda v: lpad(bin(v), CAST(w AS INTEGER), '0')), '') AS bits FROM a)
  SELECT l_orderkey, array_to_string(x, ',') AS back, to_base64(unhex(array_to_string(list_transform(range(0, CAST(ceil(length(bits) / 8.0) AS BIGINT)), lambda i: printf('%02x', CAST(list_sum(list_transform(range(1, 9), lambda j: CASE WHEN substr(bits, i * 8 + j, 1) = '1' THEN 1 << CAST(8 - j AS INTEGER) ELSE 0 END)) AS INTEGER))), ''))) AS cell FROM b""")
def _(spark, d):
    rows = base(spark, d, "SELECT l_orderkey, l_linenumber, l_partkey FROM {lineitem}").groupBy("l_orderkey").agg(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))), lambda x: x["l_partkey"]).alias("x"))
    cells = rows.select("l_orderkey", codecs.array_to_text("x").alias("cell"))
    return cells.select("l_orderkey", F.array_join(codecs.text_to_array("cell"), ",").alias("back"), "cell")


@query("h19_long_chunks", "SELECT o_orderkey, CASE WHEN v = 0 THEN 0 ELSE 64 - length(bin(abs(v))) END AS shift, v < 0 AS negative, CASE WHEN v = 0 THEN 0 ELSE CAST(CAST(abs(v) AS HUGEINT) * CAST(pow(2, 64 - length(bin(abs(v)))) AS HUGEINT) - 18446744073709551616 AS BIGINT) END AS sig FROM (SELECT o_orderkey, CAST(o_custkey AS BIGINT) * 7919 - 1000000 AS v FROM {orders})")
def _(spark, d):
    o = base(spark, d, "SELECT o_orderkey, CAST(o_custkey AS BIGINT) * 7919 - 1000000 AS v FROM {orders}").withColumn("c", numbers.long_chunk(F.col("v")))
    return o.select("o_orderkey", numbers.unpack(F.col("c.sign_exp")).alias("u"), "c.sig").select("o_orderkey", (-F.col("u.exponent")).cast("long").alias("shift"), "u.negative", "sig")


@query("h33_text_sanitize", "SELECT doc_id, md5(regexp_replace(replace(replace(replace(text, chr(10), ' '), chr(13), ''), '\"', ''''), '\\s+', ' ', 'g')) AS clean FROM {documents}")
def _(spark, d):
    return base(spark, d, "SELECT doc_id, text FROM {documents}").select("doc_id", F.md5(metadata.single_space(metadata.sanitize(F.col("text")))).alias("clean"))


# --- validation

@query("n1_source_comparison", """SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN 'source_only' WHEN o_orderkey % 7 = 0 THEN 'output_only' ELSE 'differs' END AS kind FROM {orders} WHERE (o_orderkey % 10 = 0) <> (o_orderkey % 7 = 0) OR (o_orderkey % 10 <> 0 AND o_orderkey % 13 = 0)""")
def _(spark, d):
    o = base(spark, d, "SELECT o_orderkey, o_custkey AS body FROM {orders}")
    changed = F.when(F.col("o_orderkey") % 13 == 0, F.col("body") + 1).otherwise(F.col("body"))
    return validate.compare_sources(o.filter("o_orderkey % 10 <> 0").withColumn("body", changed), o.filter("o_orderkey % 7 <> 0"), ["o_orderkey"])


@query("n4_mismatch_positions", f"""SELECT a.conv_id, CAST(a.n AS INTEGER) AS position, a.token AS "left", b.token AS "right" FROM (SELECT conv_id, token, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS n FROM ({STREAM})) a
  JOIN (SELECT conv_id, token, row_number() OVER (PARTITION BY conv_id ORDER BY token) - 1 AS n FROM ({STREAM})) b USING (conv_id, n) WHERE a.token <> b.token""")
def _(spark, d):
    rows = streams(spark, d)
    return rows.select("conv_id", F.explode(validate.mismatch_positions(F.col("tokens"), F.sort_array("tokens"))).alias("m")).select("conv_id", "m.position", "m.left", "m.right")


@query("n8_progress", "SELECT count(*) AS n_listed, count(l) AS n_present, count(l) / count(*) AS share FROM (SELECT DISTINCT p_partkey FROM {part}) LEFT JOIN (SELECT DISTINCT l_partkey AS l FROM {lineitem} WHERE l_returnflag = 'R') ON l = p_partkey")
def _(spark, d):
    return validate.progress(base(spark, d, "SELECT p_partkey AS k FROM {part}"), base(spark, d, "SELECT l_partkey AS k FROM {lineitem} WHERE l_returnflag = 'R'"), "k")


@query("b5_missing_outputs", "SELECT p_partkey FROM {part} WHERE p_partkey NOT IN (SELECT l_partkey FROM {lineitem} GROUP BY l_partkey HAVING count(DISTINCT l_returnflag) >= 3)")
def _(spark, d):
    return validate.missing_outputs(base(spark, d, "SELECT p_partkey FROM {part}"), base(spark, d, "SELECT l_partkey AS p_partkey, l_returnflag AS kind FROM {lineitem}"), "p_partkey", 3)


# --- further operators

RANGES = "SELECT concat('p', CAST(p_size % 3 AS STRING)) AS program, p_partkey * 10 AS start, p_partkey * 10 + p_size AS `end`, p_name AS section FROM {part}"
ADDRESSES = "SELECT concat('p', CAST(o_custkey % 3 AS STRING)) AS program, o_orderkey AS addr FROM {orders}"


@query("p2_address_lookup", f"SELECT a.program, a.addr, r.start, r.section FROM ({ADDRESSES}) a JOIN ({RANGES.replace('`end`', 'stop')}) r ON r.program = a.program AND a.addr >= r.start AND a.addr < r.stop")
def _(spark, d):
    return catalog.address_lookup(base(spark, d, ADDRESSES), base(spark, d, RANGES), 64).select("program", "addr", "start", "section")


USES = "SELECT user_id, event_id AS ord, event_type AS category, CAST(value AS BIGINT) % 20 AS addr FROM {events}"


@query("p5_identity_allocation", f"""SELECT e.user_id, e.ord, e.category, e.addr, CAST(i.n AS INTEGER) AS identity FROM ({USES.replace('CAST(value AS BIGINT)', 'CAST(floor(value) AS BIGINT)')}) e JOIN (
  SELECT user_id, category, addr, row_number() OVER (PARTITION BY user_id, category ORDER BY min(ord)) - 1 AS n FROM ({USES.replace('CAST(value AS BIGINT)', 'CAST(floor(value) AS BIGINT)')}) GROUP BY user_id, category, addr) i USING (user_id, category, addr)""")
def _(spark, d):
    return decode.allocate_identities(base(spark, d, USES.replace("CAST(value AS BIGINT)", "CAST(floor(value) AS BIGINT)")), ["user_id"]).select("user_id", "ord", "category", "addr", "identity")


@query("h36_frequency_remap", "SELECT l_suppkey, token, n, CAST(row_number() OVER (PARTITION BY l_suppkey ORDER BY n DESC, token) - 1 AS INTEGER) AS rank FROM (SELECT l_suppkey, l_partkey % 20 AS token, count(*) AS n FROM {lineitem} GROUP BY ALL)")
def _(spark, d):
    return vocab.frequency_remap(base(spark, d, "SELECT l_suppkey, l_partkey % 20 AS token FROM {lineitem}"), ["l_suppkey"])


@query("h31_placeholder_names", f"SELECT program, ord, concat('unnamed @', substr(sha256(CAST(body AS STRING)), 1, 8)) AS name FROM ({FUNCS})")
def _(spark, d):
    return arms.placeholder_names(base(spark, d, FUNCS)).select("program", "ord", "name")


@query("c19_batch_concat", "SELECT concat('p', CAST(p_size AS STRING)) AS program, p_partkey AS row, CAST(dense_rank() OVER (ORDER BY concat('p', CAST(p_size AS STRING))) - 1 AS INTEGER) AS binary_id, CAST(row_number() OVER (ORDER BY concat('p', CAST(p_size AS STRING)), p_partkey) - 1 AS INTEGER) AS row_id FROM {part}")
def _(spark, d):
    rows = base(spark, d, "SELECT concat('p', CAST(p_size AS STRING)) AS program, p_partkey AS row FROM {part}").withColumn("tokens", F.array(F.lit(9), F.lit(0)))
    return decode.concat_results(rows).select("program", "row", "binary_id", "row_id")


RUNS = "SELECT l_orderkey, l_partkey, l_suppkey, l_quantity, CAST(l_quantity AS BIGINT) % 4 + 1 AS run FROM {lineitem}"


@query("e8_instructions_per_block", f"""SELECT l_orderkey, CAST(max(until) AS BIGINT) AS n_tokens, CASE WHEN max(until) > 3 THEN count(*) FILTER (until <= 3) || ',' || count(*) FILTER (until > 3) ELSE CAST(count(*) AS VARCHAR) END AS n_insns
  FROM (SELECT l_orderkey, sum(run) OVER (PARTITION BY l_orderkey ORDER BY l_partkey, l_suppkey, l_quantity ROWS UNBOUNDED PRECEDING) AS until FROM ({RUNS})) GROUP BY l_orderkey""")
def _(spark, d):
    runs = F.transform(F.array_sort(F.collect_list(F.struct("l_partkey", "l_suppkey", "l_quantity", "run"))), lambda x: x["run"].cast("int"))
    rows = base(spark, d, RUNS).groupBy("l_orderkey").agg(runs.alias("insn")).withColumn("total", F.aggregate("insn", F.lit(0), lambda a, x: a + x))
    blocks = F.when(F.col("total") > 3, F.array(F.lit(3), F.col("total") - 3)).otherwise(F.array("total"))
    per = rows.select("l_orderkey", F.col("total").cast("long").alias("n_tokens"), decode.rebase_runs(F.col("insn"), blocks).alias("per"))
    return per.select("l_orderkey", "n_tokens", F.array_join("per", ",").alias("n_insns"))


@query("h28_block_texts", """SELECT doc_id, CASE WHEN len(w) > 8 THEN 3 WHEN len(w) > 3 THEN 2 ELSE 1 END AS n_blocks, md5(concat(array_to_string(w[1:3], ' '),
  CASE WHEN len(w) > 3 THEN concat(chr(10), array_to_string(w[4:8], ' ')) ELSE '' END, CASE WHEN len(w) > 8 THEN concat(chr(10), array_to_string(w[9:], ' ')) ELSE '' END)) AS blocks_md5
FROM (SELECT doc_id, string_split(text, ' ') AS w FROM {documents} WHERE text IS NOT NULL)""")
def _(spark, d):
    words = base(spark, d, "SELECT doc_id, split(text, ' ', -1) AS w FROM {documents} WHERE text IS NOT NULL")
    n = F.size("w")
    sizes = F.filter(F.array(F.least(n, F.lit(3)), F.least(n - 3, F.lit(5)), n - 8), lambda x: x > 0)
    blocks = words.select("doc_id", decode.split_blocks(F.col("w"), sizes).alias("blocks"))
    return blocks.select("doc_id", F.size("blocks").alias("n_blocks"), F.md5(F.array_join("blocks", "\n")).alias("blocks_md5"))


@query("b18_broken_floats", f"""SELECT conv_id, string_agg(CAST(turn AS STRING), ',' ORDER BY turn) AS positions FROM (SELECT conv_id, turn, token, lead(token) OVER (PARTITION BY conv_id ORDER BY turn) AS following FROM ({STREAM})) WHERE token = 257 AND coalesce(following, 256) >= 256 GROUP BY conv_id""")
def _(spark, d):
    rows = streams(spark, d).select("conv_id", metadata.broken_floats(F.col("tokens"), [257]).alias("p")).filter("size(p) > 0")
    return rows.select("conv_id", F.array_join("p", ",").alias("positions"))


@query("b17_token_patterns", f"""SELECT conv_id, regexp_matches(string_agg(CASE WHEN token < 256 THEN 'd' WHEN token = 256 THEN 's' WHEN token < 264 THEN 'n' WHEN token < 272 THEN 'i' ELSE 'c' END, '' ORDER BY turn), 'nd(d|s)?c') AS hit FROM ({STREAM}) GROUP BY conv_id""")
def _(spark, d):
    letters = F.transform("tokens", lambda t: F.element_at(F.create_map(*[F.lit(x) for p in (("digit", "d"), ("sign", "s"), ("number", "n"), ("identity", "i"), ("instruction", "c")) for x in p]), decode.band(t)))
    return streams(spark, d).select("conv_id", metadata.matches_pattern(letters, "nd(d|s)?c").alias("hit"))


@query("h17_literal_frames", "SELECT p_partkey, concat(p_brand, '_Lit_Start ', p_brand, '_', upper(lpad(printf('%x', p_size), 2, '0')), ' ', p_brand, '_Lit_End') AS frame FROM {part}")
def _(spark, d):
    p = base(spark, d, "SELECT p_partkey, p_brand, p_size FROM {part}")
    return p.select("p_partkey", codecs.frame_literal(F.col("p_brand"), F.array("p_size")).alias("frame"))


@query("h13_call_target_cells", "SELECT p_partkey, concat(CAST(p_size AS STRING), ',', printf('%x', p_partkey), ',1;0,ff,0') AS cell, p_partkey AS start FROM {part}")
def _(spark, d):
    p = base(spark, d, "SELECT p_partkey, p_size, CAST(p_partkey AS BIGINT) AS k FROM {part}")
    targets = F.array(F.struct(F.col("p_size").alias("idx"), F.col("k").alias("start"), F.lit(1).alias("is_matched")), F.struct(F.lit(0).alias("idx"), F.lit(255).cast("long").alias("start"), F.lit(0).alias("is_matched")))
    cells = p.select("p_partkey", codecs.join_targets(targets).alias("cell"))
    return cells.select("p_partkey", "cell", F.get(codecs.split_targets(F.col("cell")), F.lit(0))["start"].alias("start"))


@query("h35_tagged_blocks", "SELECT doc_id, len(string_split(text, '|')) AS n FROM {documents}")
def _(spark, d):
    rows = base(spark, d, "SELECT doc_id, concat('x<LDIS>', text, '</LDIS>y') AS cell FROM {documents}")
    return rows.select("doc_id", F.size(metadata.tagged_blocks(F.col("cell"))).cast("long").alias("n"))


@query("h34_toolchains", "SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN 'x86_64' WHEN 1 THEN 'ARM' ELSE 'Unknown' END AS architecture, CASE p_partkey % 3 WHEN 0 THEN 'GCC' WHEN 1 THEN 'Clang' ELSE 'Unknown' END AS compiler, CASE WHEN p_partkey % 2 = 0 THEN '-O2' ELSE 'Unknown' END AS optimization FROM {part}")
def _(spark, d):
    p = base(spark, d, "SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN 'ELF x86-64' WHEN 1 THEN 'ELF ARM' ELSE 'data' END AS f, concat(CASE p_partkey % 3 WHEN 0 THEN 'GCC: 9' WHEN 1 THEN 'clang 12' ELSE '' END, CASE WHEN p_partkey % 2 = 0 THEN ' -O2' ELSE ' -Ofast' END) AS s FROM {part}")
    return p.select("p_partkey", axes.toolchain(F.col("f"), F.col("s")).alias("t")).select("p_partkey", "t.*")


@query("j3_cross_spec_sample", f"SELECT program, mode, section_id, length FROM (SELECT *, 'max' AS mode FROM ({INDEX}) UNION ALL SELECT program, section_id, length - 1, 'p50' FROM ({INDEX})) WHERE length BETWEEN 20 AND 40 ORDER BY md5(concat_ws('|', '3', program, mode, section_id)), program, mode, section_id LIMIT 300")
def _(spark, d):
    one = base(spark, d, INDEX)
    both = one.withColumn("mode", F.lit("max")).unionByName(one.withColumn("length", F.col("length") - 1).withColumn("mode", F.lit("p50")))
    return sampling.sample_sections(both, 20, 40, 300, 3, ["program", "mode"]).select("program", "mode", "section_id", "length")


@query("j14_first_sections", f"SELECT section_id, n_variants FROM ({SIZES}) WHERE section_id < 100")
def _(spark, d):
    return sampling.first_sections(base(spark, d, SIZES), 100)


@query("n5_sidecar_pairs", "SELECT coalesce(a, b) AS k, CASE WHEN b IS NULL THEN 'left' ELSE 'right' END AS only_in FROM (SELECT DISTINCT o_custkey AS a FROM {orders}) FULL JOIN (SELECT c_custkey AS b FROM {customer}) ON a = b WHERE a IS NULL OR b IS NULL")
def _(spark, d):
    return validate.pair_consistency(base(spark, d, "SELECT o_custkey AS k FROM {orders}"), base(spark, d, "SELECT c_custkey AS k FROM {customer}"), "k")


@query("d19_rollup", "SELECT l_returnflag, count(*) AS n, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity, CAST(sum(l_linenumber) AS BIGINT) AS lines FROM {lineitem} GROUP BY l_returnflag")
def _(spark, d):
    return stats.rollup(base(spark, d, "SELECT l_returnflag, CAST(l_quantity AS BIGINT) AS quantity, CAST(l_linenumber AS BIGINT) AS lines FROM {lineitem}"), ["l_returnflag"], ["quantity", "lines"])


@query("b12_axis_projection", "SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN 64 WHEN 1 THEN 32 WHEN 2 THEN 64 ELSE NULL END AS bitness FROM {part}")
def _(spark, d):
    p = base(spark, d, "SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN 'amd64' WHEN 1 THEN 'armhf' WHEN 2 THEN 'ppc64le' ELSE NULL END AS arch FROM {part}")
    return p.select("p_partkey", axes.bitness_of(axes.platform_of(F.col("arch"))).alias("bitness"))


@query("m14_load_batch", f"""SELECT program, section_id, array_to_string(list_resize(list_slice(list(CAST(tok AS INTEGER) ORDER BY tok), 1, 6), 6, 0), ',') AS tokens FROM (
  SELECT d.program, d.section_id, 16 + l_partkey % 100 AS tok FROM ({DRAWN}) d JOIN {{lineitem}} ON l_orderkey = d.section_id) GROUP BY program, section_id""")
def _(spark, d):
    """Sample a band, join the bodies of the drawn sections only, and assemble rows of fixed width."""
    drawn = sampling.sample_sections(base(spark, d, INDEX), 20, 40, 500, 11, ["program"])
    bodies = base(spark, d, "SELECT l_orderkey AS section_id, CAST(16 + l_partkey % 100 AS INTEGER) AS tok FROM {lineitem}")
    parts = drawn.join(bodies, "section_id").groupBy("program", "section_id").agg(F.array_sort(F.collect_list("tok")).alias("tokens")).withColumn("part", F.lit(0))
    return decode.assemble(parts, ["program", "section_id"], ["part"], 6).select("program", "section_id", F.array_join("tokens", ",").alias("tokens"))
