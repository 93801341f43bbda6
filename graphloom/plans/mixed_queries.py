"""Registered queries of batches with linked callees, mixed depths, unmatched callees and run lengths."""

from __future__ import annotations

from pyspark.sql import functions as F

from graphloom.functions import constants as constant_rules
from graphloom.functions import numbers, patterns
from graphloom.operators import batch, constants, decode, graph, render
from graphloom.plans.batch_queries import LANES, SPAN, STEP_ROWS, as_text
from graphloom.plans.catalog_queries import EDGES, QUERIES, VARS, base, edges, query
from graphloom.plans.materialize import materialized
from graphloom.sources import stored


#: Type and arm of an edge: every third callee is linked, every eleventh external; every fifth section is unmatched.
TYPE, MATCHED = "CASE WHEN callee_section % 11 = 0 THEN 11 WHEN callee_section % 3 = 0 THEN 10 ELSE 9 END", "callee_section % 5 <> 0"
REACH = "section_id % 3"
CATEGORY = "9 + (section_id + i) % 2"
TOKENS = f"""SELECT section_id, variant_idx, i * 3 AS pos, CASE kind WHEN 0 THEN 257 WHEN 1 THEN 256 + {CATEGORY} WHEN 2 THEN 264 WHEN 3 THEN 270 ELSE 257 END AS token FROM ({STEP_ROWS})
  UNION ALL SELECT section_id, variant_idx, i * 3 + 1, first FROM ({STEP_ROWS})
  UNION ALL SELECT section_id, variant_idx, i * 3 + 2, CASE WHEN kind IN (1, 2, 3) THEN 272 + first WHEN minus THEN 256 ELSE second END FROM ({STEP_ROWS})"""


def typed(spark, d):
    return edges(spark, d).withColumn("type", F.expr(TYPE).cast("int")).withColumn("matched", F.expr(MATCHED))


def bodies(spark, d):
    rows = base(spark, d, TOKENS).groupBy("section_id", "variant_idx").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "token"))), lambda x: x["token"].cast("int")).alias("tokens"))
    known = base(spark, d, f"SELECT section_id, variant_idx FROM ({VARS})").join(rows, ["section_id", "variant_idx"], "left")
    return decode.geometry(known.withColumn("tokens", F.coalesce("tokens", F.array().cast("array<int>")))).select("section_id", "variant_idx", "body_len", "tokens")


def walk_sql(depth: int, select: str, start: str, matched: str, behind: bool = False) -> str:
    """Inclusion of the rows of start (root, lane, variant_idx, reach), unrolled; behind: callees behind up to two unmatched ones."""
    out = [f"WITH v AS MATERIALIZED ({VARS})", f"e AS MATERIALIZED (SELECT *, {TYPE} AS type, {matched} AS matched FROM ({EDGES}) WHERE callee_section % 11 <> 0)", f"rows AS MATERIALIZED ({start})",
           "k AS (SELECT root, reach, count(*) AS n FROM rows WHERE variant_idx IS NOT NULL GROUP BY ALL)",
           "l0 AS (SELECT root, lane, reach, 0 AS depth, CAST(0 AS BIGINT) AS ord, root AS section_id, variant_idx, 9 AS type FROM rows WHERE variant_idx IS NOT NULL)", "s0 AS (SELECT DISTINCT root, lane, reach, root AS section_id FROM l0)"]
    for i in range(1, depth + 1):
        out.append(f"""d{i} AS MATERIALIZED (SELECT l.root, l.lane, l.reach, l.ord AS parent, [e.called_idx] AS path, e.callee_section, e.callee_variant, e.type, e.matched FROM l{i - 1} l JOIN e ON e.section_id = l.section_id AND e.variant_idx = l.variant_idx WHERE l.reach >= {i})""")
        every = f"SELECT * EXCLUDE (matched) FROM d{i} WHERE matched"
        if behind:
            out.append(f"""u{i} AS MATERIALIZED (SELECT d.root, d.lane, d.reach, d.parent, list_append(d.path, e.called_idx) AS path, e.callee_section, e.callee_variant, e.type, e.matched, d.callee_section AS before FROM d{i} d JOIN e ON e.section_id = d.callee_section AND e.variant_idx = d.callee_variant WHERE NOT d.matched)""")
            out.append(f"""w{i} AS MATERIALIZED (SELECT u.root, u.lane, u.reach, u.parent, list_append(u.path, e.called_idx) AS path, e.callee_section, e.callee_variant, e.type, e.matched FROM u{i} u JOIN e ON e.section_id = u.callee_section AND e.variant_idx = u.callee_variant WHERE NOT u.matched AND u.callee_section <> u.before)""")
            every += f" UNION ALL SELECT * EXCLUDE (matched, before) FROM u{i} WHERE matched UNION ALL SELECT * EXCLUDE (matched) FROM w{i} WHERE matched"
        out.append(f"""f{i} AS MATERIALIZED (SELECT root, lane, reach, parent, path, callee_section AS section_id, callee_variant AS variant_idx, type FROM ({every}) QUALIFY row_number() OVER (PARTITION BY root, lane, reach, callee_section ORDER BY parent, path) = 1)""")
        out.append(f"s{i} AS MATERIALIZED (SELECT * FROM s{i - 1} UNION SELECT root, lane, reach, section_id FROM f{i})")
        out.append(f"x{i} AS (SELECT root, reach, section_id FROM s{i} JOIN k USING (root, reach) GROUP BY ALL HAVING count(*) = max(n))")
        out.append(f"""l{i} AS MATERIALIZED (SELECT root, lane, reach, {i} AS depth, row_number() OVER (PARTITION BY root, lane ORDER BY parent, path) - 1 AS ord, section_id, variant_idx, type
  FROM f{i} ANTI JOIN s{i - 1} USING (root, lane, reach, section_id) ANTI JOIN x{i} USING (root, reach, section_id))""")
    nodes = " UNION ALL ".join(f"SELECT * FROM l{i}" for i in range(depth + 1))
    return ", ".join(out) + f", every AS MATERIALIZED ({nodes}) {select}"


DRAWN = f"""SELECT s.section_id AS root, CAST(t.lane AS INTEGER) AS lane, p.variant_idx, s.{REACH} AS reach FROM (SELECT DISTINCT section_id FROM v) s CROSS JOIN (VALUES {', '.join(f'({i})' for i in range(LANES))}) t(lane)
  LEFT JOIN (SELECT section_id, variant_idx, row_number() OVER (PARTITION BY section_id ORDER BY variant_idx) - 1 AS lane FROM (
    SELECT section_id, variant_idx FROM v QUALIFY row_number() OVER (PARTITION BY section_id ORDER BY md5(concat_ws('|', '3', section_id, variant_idx)), variant_idx) <= {LANES})) p ON p.section_id = s.section_id AND p.lane = t.lane"""
MIXED = walk_sql(2, f"""SELECT r.root, r.lane, r.variant_idx, CAST(coalesce(t.n, 0) AS INTEGER) AS n_tokens,
  array_to_string(list_resize(coalesce(t.tokens, []), {SPAN}, 0), ',') AS tokens, coalesce(i.t, '') AS identities, coalesce(m.t, '') AS numbers, coalesce(b.t, '') AS fids
  FROM rows r LEFT JOIN (SELECT root, lane, count(*) AS n, list(CAST(token AS INTEGER) ORDER BY spot) AS tokens FROM own GROUP BY ALL) t USING (root, lane)
  LEFT JOIN (SELECT root, lane, string_agg(CAST(identity AS VARCHAR), ',' ORDER BY spot) AS t FROM ids GROUP BY ALL) i USING (root, lane)
  LEFT JOIN (SELECT root, lane, string_agg(sig || ':' || word, ',' ORDER BY spot) AS t FROM nums GROUP BY ALL) m USING (root, lane)
  LEFT JOIN (SELECT root, lane, string_agg(concat_ws(':', category, identity, fid), ',' ORDER BY category, identity) AS t FROM dense GROUP BY ALL) b USING (root, lane)""", DRAWN, MATCHED).replace(", every AS MATERIALIZED", f""", st AS MATERIALIZED (SELECT *, {CATEGORY} AS cat FROM ({STEP_ROWS})),
tg AS MATERIALIZED (SELECT section_id, variant_idx, type AS category, row_number() OVER (PARTITION BY section_id, variant_idx, type ORDER BY called_idx) - 1 AS place, callee_section AS fid FROM (SELECT *, {TYPE} AS type FROM ({EDGES}))), every AS MATERIALIZED""", 1).replace(") SELECT r.root", f"""), bl AS (
  SELECT section_id, variant_idx, i, kind, cat, first, second, minus, row_number() OVER (PARTITION BY section_id, variant_idx ORDER BY i, part) AS slot, part FROM st CROSS JOIN (VALUES (0), (1)) h(part) WHERE part = 0 OR kind IN (1, 2, 3)),
sz AS (SELECT section_id, variant_idx, count(*) AS n FROM bl GROUP BY ALL),
ln AS (SELECT root, lane, row_number() OVER (PARTITION BY root, lane ORDER BY depth, ord) - 1 AS node, section_id, variant_idx, type, 1 + coalesce(n, 0) AS n FROM every LEFT JOIN sz USING (section_id, variant_idx)),
cs AS (SELECT *, sum(n) OVER (PARTITION BY root, lane ORDER BY node) - n AS start FROM ln), alive AS MATERIALIZED (SELECT * FROM cs WHERE start < {SPAN}),
own AS MATERIALIZED (SELECT * FROM (SELECT root, lane, node, a.section_id, start AS spot, type AS token, -1 AS place, 0 AS kind, 0 AS second, false AS minus, true AS self FROM alive a
  UNION ALL SELECT root, lane, node, a.section_id, start + slot, CASE WHEN part = 1 THEN 16 + first ELSE CASE kind WHEN 1 THEN cat WHEN 2 THEN 8 WHEN 3 THEN 14 ELSE 1 END END, first, kind, second, minus, false
  FROM alive a JOIN bl ON bl.section_id = a.section_id AND bl.variant_idx = a.variant_idx) WHERE spot < {SPAN}),
nums AS (SELECT root, lane, spot, CASE WHEN value = 0 THEN '0' ELSE CAST(CAST(value AS HUGEINT) * CAST(pow(2, 64 - width) AS HUGEINT) AS VARCHAR) END AS sig,
  CAST((CASE WHEN minus THEN 2147483648 ELSE 0 END) + 1073741824 - CASE WHEN value = 0 THEN 0 ELSE 64 - width END AS BIGINT) AS word FROM (
    SELECT *, length(bin(value)) AS width FROM (SELECT root, lane, spot, minus, CASE WHEN minus THEN place ELSE place * 256 + second END AS value FROM own WHERE token = 1))),
hit AS (SELECT o.root, o.lane, o.node, o.spot, o.token AS category, o.place, tg.fid FROM own o JOIN alive a USING (root, lane, node) LEFT JOIN tg ON tg.section_id = a.section_id AND tg.variant_idx = a.variant_idx AND tg.category = o.token AND tg.place = o.place WHERE o.token IN (9, 10, 11) AND NOT self),
said AS (SELECT root, lane, -1 AS node, 0 AS late, 0 AS place, 9 AS category, root AS fid, 'f' || root AS key FROM alive WHERE node = 0
  UNION ALL SELECT root, lane, node, -1, 0, type, section_id, 'f' || section_id FROM alive
  UNION ALL SELECT root, lane, node, 0, tg.place, tg.category, tg.fid, 'f' || tg.fid FROM alive a JOIN tg USING (section_id, variant_idx)
  UNION ALL SELECT DISTINCT root, lane, node, 1, place, category, 0, 'n' || node || ':' || place FROM hit WHERE fid IS NULL),
dense AS MATERIALIZED (SELECT root, lane, category, key, any_value(fid) AS fid, row_number() OVER (PARTITION BY root, lane, category ORDER BY min((node, late, place))) - 1 AS identity FROM said GROUP BY root, lane, category, key),
cnt AS (SELECT root, lane, token, node, sum(count(DISTINCT place)) OVER (PARTITION BY root, lane, token ORDER BY node) - count(DISTINCT place) AS before FROM own WHERE token IN (8, 14) GROUP BY root, lane, token, node),
ids AS (SELECT root, lane, spot, identity FROM (SELECT root, lane, spot, token AS category, 'f' || section_id AS key FROM own WHERE self UNION ALL SELECT root, lane, spot, category, CASE WHEN fid IS NULL THEN 'n' || node || ':' || place ELSE 'f' || fid END FROM hit) JOIN dense USING (root, lane, category, key)
  UNION ALL SELECT root, lane, spot, CAST(before + place AS BIGINT) FROM own JOIN cnt USING (root, lane, token, node))
SELECT r.root""", 1)


@query("c18_mixed_depths", MIXED)
def _(spark, d):
    v, e = base(spark, d, VARS), typed(spark, d)
    targets = e.select("section_id", "variant_idx", F.col("type").alias("category"), "called_idx", F.col("callee_section").alias("fid"))
    targets = decode.segmented_rank(targets, ["section_id", "variant_idx", "category"], ["called_idx"]).withColumnRenamed("rank", "place")
    sections = v.select("section_id").distinct().withColumn("max_depth", F.expr(REACH).cast("int"))
    return as_text(batch.batch_decode(sections, v, e, targets, bodies(spark, d), SPAN, None, LANES, 3))


@query("m2_unmatched_arm", walk_sql(2, "SELECT root, lane, depth, ord, section_id, variant_idx, type FROM every", f"SELECT section_id AS root, variant_idx AS lane, variant_idx, 1 + {REACH} % 2 AS reach FROM v", MATCHED, True))
def _(spark, d):
    roots = base(spark, d, VARS).select(F.col("section_id").alias("root"), F.col("variant_idx").alias("lane"), "variant_idx", F.expr(f"CAST(1 + {REACH} % 2 AS INT)").alias("max_depth"))
    return graph.included(roots, typed(spark, d), unmatched_hops=2).select("root", "lane", "depth", "ord", "section_id", "variant_idx", "type")


RUNS = f"SELECT section_id, variant_idx, CASE WHEN body_len % 7 > 4 THEN [CAST(body_len % 7 AS INTEGER) * 3] ELSE [3, 0, CAST(body_len % 7 AS INTEGER) * 3 - 3] END AS block_rl FROM ({VARS}) WHERE body_len % 7 > 0"


@query("m12_block_runs", f"""WITH b AS (SELECT section_id, variant_idx, unnest(generate_series(0, len(block_rl) - 1)) AS block, unnest(block_rl) AS n FROM ({RUNS})),
  c AS (SELECT *, sum(n) OVER (PARTITION BY section_id, variant_idx ORDER BY block) AS until FROM b),
  i AS (SELECT section_id, variant_idx, i, CASE WHEN kind IN (1, 2, 3) THEN 2 ELSE 1 END AS slots, i * 3 + 3 AS until FROM ({STEP_ROWS})),
  m AS (SELECT i.section_id, i.variant_idx, i.i, i.slots, min(c.block) AS block FROM i JOIN c ON c.section_id = i.section_id AND c.variant_idx = i.variant_idx AND c.until >= i.until GROUP BY ALL)
  SELECT c.section_id, c.variant_idx, CAST(c.block AS INTEGER) AS block, CAST(count(m.i) AS INTEGER) AS n_insns, coalesce(string_agg(CAST(m.slots AS VARCHAR), ',' ORDER BY m.i), '') AS slots FROM c LEFT JOIN m USING (section_id, variant_idx, block) GROUP BY ALL""")
def _(spark, d):
    runs = base(spark, d, f"SELECT section_id, variant_idx, CASE WHEN body_len % 7 > 4 THEN array(CAST(body_len % 7 AS INT) * 3) ELSE array(3, 0, CAST(body_len % 7 AS INT) * 3 - 3) END AS block_rl, array_repeat(3, CAST(body_len % 7 AS INT)) AS insn_rl FROM ({VARS}) WHERE body_len % 7 > 0")
    rows = bodies(spark, d).withColumn("tokens", F.slice("tokens", 1, 1000)).join(runs, ["section_id", "variant_idx"]).withColumn("insn_rl", F.slice("insn_rl", 1, 6))
    return batch.block_runs(rows, ["section_id", "variant_idx"]).withColumn("slots", F.array_join("slots", ","))


KIND_OF = "CASE p_partkey % 12 WHEN 0 THEN 'PLT_FUNCTION' WHEN 1 THEN 'LOCAL_FUNCTION' WHEN 2 THEN 'LOCAL_FUNCTION' WHEN 3 THEN 'EXT_FUNCTION_REAL' WHEN 4 THEN 'EXT_FUNCTION_SYNTHETIC' WHEN 5 THEN 'STRING' WHEN 6 THEN 'JUMP_TABLE_SLOT' WHEN 7 THEN 'CODE_PTR_TABLE_SLOT' WHEN 8 THEN 'RODATA' WHEN 9 THEN 'BSS' WHEN 10 THEN 'UNKNOWN' ELSE 'DATA' END"
RANGES = f"""SELECT p_partkey % 3 AS program, p_partkey * 37 AS start, p_partkey * 37 + p_size AS "end", {KIND_OF} AS kind, p_size % 9 = 0 AS is_vtable, p_size % 2 = 0 AS tls, p_partkey * 1000 AS base, p_size * 8 AS "offset",
  CASE WHEN p_size % 4 = 0 THEN 'local function' END AS target_rule, p_partkey * 11 AS target FROM {{part}}"""
CONSTANTS = """SELECT l_orderkey, l_linenumber, l_partkey % 3 AS program, l_partkey * 37 + CAST(l_quantity AS INTEGER) % 45 - 60 * (l_linenumber % 2) AS value, l_linenumber = 4 AS is_arithmetic,
  CASE WHEN l_orderkey % 13 = 0 THEN 'f64' END AS fp_type, CASE WHEN l_orderkey % 5 = 0 THEN 'f32' END AS fp_postfix FROM {lineitem}"""


@query("b14_constant_rules", f"""WITH r AS ({RANGES}), k AS ({CONSTANTS}),
  m AS (SELECT k.*, r.start, r.kind, r.is_vtable, r.tls, r.base, r."offset", r.target_rule, r.target FROM k LEFT JOIN r ON r.program = k.program AND NOT k.is_arithmetic AND k.value >= r.start AND k.value < r."end"
    QUALIFY row_number() OVER (PARTITION BY k.l_orderkey, k.l_linenumber, k.program, k.value ORDER BY r."end" - r.start, r.start) = 1),
  n AS (SELECT *, CASE WHEN fp_type IS NOT NULL THEN 'float' WHEN kind IS NULL THEN 'value' WHEN kind = 'PLT_FUNCTION' THEN 'linked function' WHEN kind = 'LOCAL_FUNCTION' AND value = start THEN 'local function' WHEN kind = 'LOCAL_FUNCTION' THEN 'block'
    WHEN kind = 'EXT_FUNCTION_REAL' THEN 'external function' WHEN kind = 'EXT_FUNCTION_SYNTHETIC' THEN 'synthetic function' WHEN kind = 'STRING' THEN 'string' WHEN kind = 'JUMP_TABLE_SLOT' THEN 'jump table slot' WHEN kind = 'CODE_PTR_TABLE_SLOT' OR is_vtable THEN 'pointer slot'
    WHEN kind = 'RODATA' THEN 'read-only data' WHEN kind IN ('DATA', 'BSS', 'THREAD_LOCAL_DATA') THEN 'writable data' ELSE 'value' END AS rule FROM m)
  SELECT l_orderkey, l_linenumber, program, value, rule, CASE rule WHEN 'float' THEN 'FLOAT_f64:' || value WHEN 'linked function' THEN 'PLT_FUNC:' || value WHEN 'local function' THEN 'LOCAL_FUNC:' || value WHEN 'block' THEN 'BLOCK:' || value
    WHEN 'external function' THEN 'EXT_FUNC:' || value WHEN 'synthetic function' THEN 'EXT_FUNC:' || value WHEN 'string' THEN 'STRING_PTR:' || value WHEN 'jump table slot' THEN 'JUMP_TABLE:' || base || ',VALUED_CONST:' || "offset"
    WHEN 'pointer slot' THEN CASE WHEN is_vtable THEN 'VTABLE,' ELSE 'CODE_PTR_TABLE,' END || CASE WHEN target_rule IS NOT NULL THEN 'LOCAL_FUNC:' || target ELSE 'RO_DATA_PTR:' || start || ',VALUED_CONST:' || (value - start) END
    WHEN 'read-only data' THEN 'RO_DATA_PTR:' || value WHEN 'writable data' THEN CASE WHEN tls THEN 'THREAD_LOCAL,' ELSE '' END || 'RW_DATA_PTR:' || value ELSE 'VALUED_CONST:' || abs(value) || CASE WHEN value < 0 THEN ',VALUE_NEGATIVE' ELSE '' END END
    || CASE WHEN fp_postfix IS NOT NULL AND rule IN ('string', 'jump table slot', 'pointer slot', 'read-only data', 'writable data', 'value') THEN ',FLOAT_f32' ELSE '' END AS tokens FROM n""")
def _(spark, d):
    rows = constants.classified(base(spark, d, CONSTANTS), base(spark, d, RANGES.replace('"', "`")))
    text = F.array_join(F.transform("emitted", lambda t: F.concat_ws(":", t["token"], t["number"].cast("string"))), ",")
    return rows.select("l_orderkey", "l_linenumber", "program", "value", "rule", text.alias("tokens"))


@query("b15_resolved_targets", f"""SELECT l_orderkey, l_linenumber, CASE WHEN kind IN ('STRING', 'PLT_FUNCTION', 'LOCAL_FUNCTION', 'CODE_PTR_TABLE_SLOT') THEN 'anchor' WHEN target BETWEEN low AND low + 300 THEN 'own function' WHEN l_linestatus = 'O' THEN 'memory access'
  WHEN (arch = 'arm32' AND mnemonic = 'movt') OR (arch = 'mips' AND mnemonic IN ('ori', 'addi', 'daddi')) THEN 'address pair' END AS reason FROM (
  SELECT l_orderkey, l_linenumber, l_linestatus, l_partkey * 3 AS target, l_suppkey * 100 AS low, CASE WHEN l_partkey % 2 = 0 THEN 'arm32' ELSE 'mips' END AS arch, CASE l_linenumber % 4 WHEN 0 THEN 'movt' WHEN 1 THEN 'ori' WHEN 2 THEN 'csel' ELSE 'daddi' END AS mnemonic,
    {KIND_OF} AS kind FROM {{lineitem}} JOIN {{part}} ON p_partkey = l_partkey)""")
def _(spark, d):
    rows = base(spark, d, f"SELECT l_orderkey, l_linenumber, l_linestatus, l_partkey * 3 AS target, l_suppkey * 100 AS low, IF(l_partkey % 2 = 0, 'arm32', 'mips') AS arch, element_at(array('movt', 'ori', 'csel', 'daddi'), l_linenumber % 4 + 1) AS mnemonic, {KIND_OF} AS kind FROM {{lineitem}} JOIN {{part}} ON p_partkey = l_partkey")
    reason = constant_rules.target_reason(F.col("kind"), F.col("target"), F.col("low"), F.col("low") + 300, F.col("arch"), F.col("mnemonic"), F.col("l_linestatus") == "O")
    return rows.select("l_orderkey", "l_linenumber", reason.alias("reason"))


# An order's items, in order: flag and status as the kind of a token, the supplier as its value.
TOKEN_TEXT = "SELECT l_orderkey, string_agg(CONCAT(l_returnflag, l_linestatus, '=', CAST(l_suppkey % 4 AS VARCHAR), ';'), '' ORDER BY l_linenumber, l_partkey, l_suppkey) AS t FROM {lineitem} GROUP BY l_orderkey"


@query("b17_pattern_rules", f"""SELECT l_orderkey, CASE WHEN regexp_full_match(t, '(NO=[0-9];)+') THEN 'open' WHEN regexp_full_match(t, '(RF=[0-9];)?(AF=[0-9];|RF=2;)+') THEN 'returned' WHEN regexp_full_match(t, '[ANR][OF]=3;.*') AND regexp_full_match(t, '[ANR][OF]=[0-9];([ANR][OF]=[0-9];)?') THEN 'short' END AS rule,
  CASE WHEN regexp_full_match(t, '(NO=[0-9];)+') THEN regexp_extract(t, '=([0-9]);$', 1) END AS last_value FROM ({TOKEN_TEXT})""")
def _(spark, d):
    kind = F.concat("l_returnflag", "l_linestatus")
    rows = base(spark, d, "SELECT * FROM {lineitem}").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", kind.alias("kind"), (F.col("l_suppkey") % 4).cast("string").alias("value")))).alias("tokens"))
    t, of = patterns.as_text(F.col("tokens")), patterns.token
    opened = patterns.some(of("NO", name="last_value"))
    rules = {"open": opened, "returned": patterns.sequence(patterns.maybe(patterns.sequence(of("RF"), patterns.ahead(patterns.either(of("AF"), of("RF", "2"))))), patterns.some(patterns.either(of("AF"), of("RF", "2")))),
             "short": patterns.sequence(patterns.ahead(of(value="3")), of(), patterns.maybe(of()))}
    return rows.select("l_orderkey", patterns.first_rule(t, rules).alias("rule"), patterns.captured(t, opened)["last_value"].alias("last_value"))


@query("a28_stored_geometry", f"""SELECT v.section_id, v.variant_idx, CAST(coalesce(sum(CASE WHEN kind IN (1, 2, 3) THEN 2 WHEN kind IS NOT NULL THEN 1 END), 0) AS INTEGER) AS body_len, CAST(count(*) FILTER (kind IN (1, 2, 3)) AS INTEGER) AS id_count, CAST(count(*) FILTER (kind IN (0, 4)) AS INTEGER) AS value_count
  FROM ({VARS}) v LEFT JOIN ({STEP_ROWS}) s USING (section_id, variant_idx) GROUP BY ALL""")
def _(spark, d):
    nodes = base(spark, d, f"SELECT section_id, variant_idx FROM ({VARS})")
    geometry = decode.geometry(bodies(spark, d).drop("body_len")).drop("tokens")
    materialized(nodes.limit(1))  # so that the shared folder is set
    folder = spark.sparkContext._jsc.sc().getCheckpointDir().get()
    key = stored.publish({"nodes": nodes, "geometry": geometry}, f"{folder}/stored", 8)
    tables = stored.current(spark, f"{folder}/stored", key)
    return stored.with_stored(tables["nodes"], tables["geometry"])


# The text of every token of a step: a value, a function by name, a jump, data, then the instruction behind it.
@query("m17_rendered_lines", f"""WITH st AS (SELECT *, {CATEGORY} AS cat FROM ({STEP_ROWS})),
  tg AS (SELECT section_id, variant_idx, type AS cat, row_number() OVER (PARTITION BY section_id, variant_idx, type ORDER BY called_idx) - 1 AS place, 'f' || callee_section AS name FROM (SELECT *, {TYPE} AS type FROM ({EDGES})))
  SELECT st.section_id, st.variant_idx, CAST(i // 2 AS INTEGER) AS block, CAST(i % 2 AS INTEGER) AS insn, CASE WHEN kind IN (0, 4) THEN 'v:' || CASE WHEN minus THEN '-' || first ELSE CAST(first * 256 + second AS VARCHAR) END
    WHEN kind = 1 THEN CASE st.cat WHEN 9 THEN 'local' ELSE 'plt' END || ' function ' || first || ': ' || coalesce(name, '?') WHEN kind = 2 THEN 'jump block: ' || first ELSE 'RO_DATA_PTR:' || first END
    || CASE WHEN kind IN (1, 2, 3) THEN ' i' || first ELSE '' END AS text, CAST(CASE WHEN kind IN (1, 2) THEN 1 ELSE 0 END AS INTEGER) AS n_refers
  FROM st LEFT JOIN tg ON tg.section_id = st.section_id AND tg.variant_idx = st.variant_idx AND tg.cat = st.cat AND tg.place = st.first""")
def _(spark, d):
    e = typed(spark, d).select("section_id", "variant_idx", F.col("type").alias("category"), "called_idx", F.concat(F.lit("f"), F.col("callee_section").cast("string")).alias("name"))
    calls = decode.segmented_rank(e, ["section_id", "variant_idx", "category"], ["called_idx"]).withColumnRenamed("rank", "place").withColumn("provider", F.lit(None).cast("string"))
    steps = (F.size("tokens") / 3).cast("int")
    rows = bodies(spark, d).withColumn("insn_rl", F.array_repeat(F.lit(3), steps)).withColumn("block_rl", F.concat(F.array_repeat(F.lit(6), (steps / 2).cast("int")), F.array_repeat(F.lit(3), steps % 2)))
    vocab = spark.range(272, 277).select(F.col("id").cast("int").alias("id"), F.concat(F.lit("i"), (F.col("id") - 272).cast("string")).alias("token"))
    return render.lines(rows, vocab, calls).select("section_id", "variant_idx", "block", "insn", "text", F.size("refers").alias("n_refers"))


EIGHTHS = "SELECT o_orderkey, CAST(o_custkey % 1000 AS BIGINT) - 500 AS n FROM {orders}"


@query("h25_float_text", f"""SELECT o_orderkey, 'f64:' || CASE WHEN n = 0 THEN '0' ELSE CASE WHEN n < 0 THEN '-' ELSE '' END || '0.' || digits || ' E' || (length(digits) - k) END AS text, CAST(n // gcd(n, 8) AS VARCHAR) AS numerator, CAST(8 // gcd(n, 8) AS VARCHAR) AS denominator FROM (
  SELECT *, CAST(abs(n) * CAST(pow(10, k) AS BIGINT) // 8 AS VARCHAR) AS digits FROM (SELECT *, CASE WHEN n % 8 = 0 THEN 0 WHEN n % 4 = 0 THEN 1 WHEN n % 2 = 0 THEN 2 ELSE 3 END AS k FROM ({EIGHTHS})))""")
def _(spark, d):
    bits = F.expr("unhex(lpad(hex(CAST(reflect('java.lang.Double', 'doubleToLongBits', CAST(n AS DOUBLE) / 8) AS BIGINT)), 16, '0'))")
    rows = base(spark, d, EIGHTHS).select("o_orderkey", numbers.float_chunks("f64")(bits).alias("c"))
    return rows.select("o_orderkey", numbers.render_chunks("f64", "full")("c").alias("text"), numbers.exact_value("c").alias("v")).select("o_orderkey", "text", "v.numerator", "v.denominator")
