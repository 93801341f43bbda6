"""Registered queries of batches that are decoded end to end, and of the records below them."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from graphloom.functions import metadata
from graphloom.operators import batch, decode, lengths, vocab
from graphloom.plans.catalog_queries import EDGES, ITEMS, LOCAL, QUERIES, SIZES, STREAM, TOTAL, UNIFIED, VARS, base, edges, levels_sql, query, streams, unified
from graphloom.plans.materialize import materialized
from graphloom.sources import catalog_tables

# Body of each variant of a part: three ids a step, a carrier, its low digit, then a second digit, a sign or an instruction.
STEPS = "(VALUES (0), (1), (2), (3), (4), (5)) AS g(i)"
KIND = "(section_id + variant_idx + i) % 5"
STEP_ROWS = f"SELECT section_id, variant_idx, i, {KIND} AS kind, CAST((section_id * 3 + i) % 5 AS INTEGER) AS first, CAST((section_id + i * 7) % 256 AS INTEGER) AS second, (section_id + i) % 4 = 0 AS minus FROM ({VARS}) CROSS JOIN {STEPS} WHERE i < body_len % 7"
TOKENS = f"""SELECT section_id, variant_idx, i * 3 AS pos, CASE kind WHEN 0 THEN 257 WHEN 1 THEN 265 WHEN 2 THEN 264 WHEN 3 THEN 270 ELSE 257 END AS token FROM ({STEP_ROWS})
  UNION ALL SELECT section_id, variant_idx, i * 3 + 1, first FROM ({STEP_ROWS})
  UNION ALL SELECT section_id, variant_idx, i * 3 + 2, CASE WHEN kind IN (1, 2, 3) THEN 272 + first WHEN minus THEN 256 ELSE second END FROM ({STEP_ROWS})"""
TARGETS = f"SELECT section_id, variant_idx, 9 AS category, row_number() OVER (PARTITION BY section_id, variant_idx ORDER BY called_idx) - 1 AS place, callee_section AS fid FROM ({EDGES})"
SPAN, LANES = 20, 3


def bodies(spark, d):
    rows = base(spark, d, TOKENS).groupBy("section_id", "variant_idx").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "token"))), lambda x: x["token"]).alias("tokens"))
    known = base(spark, d, f"SELECT section_id, variant_idx FROM ({VARS})").join(rows, ["section_id", "variant_idx"], "left")
    return decode.geometry(known.withColumn("tokens", F.coalesce("tokens", F.array().cast("array<int>")))).select("section_id", "variant_idx", "body_len", "tokens")


def targets(spark, d, calls=None):
    place = F.row_number().over(W.partitionBy("section_id", "variant_idx").orderBy("called_idx")) - 1
    return (edges(spark, d) if calls is None else calls).select("section_id", "variant_idx", F.lit(9).alias("category"), place.alias("place"), F.col("callee_section").alias("fid"))


def as_text(rows):
    """Arrays as text, so that values compare alike everywhere."""
    def joined(c, *fields):
        return F.array_join(F.transform(c, lambda x: F.concat_ws(":", *[x[f].cast("string") for f in fields])), ",")

    return rows.select("root", "lane", "variant_idx", "n_tokens", F.array_join("tokens", ",").alias("tokens"), F.array_join("identities", ",").alias("identities"),
                       joined("numbers", "sig", "word").alias("numbers"), joined("fids", "category", "identity", "fid").alias("fids"))


def decoded_sql(start: str, seed: int) -> str:
    """The batch of the sections of start (section_id), as the operator defines it."""
    rows = f"""SELECT s.section_id AS root, t.lane, p.variant_idx FROM (SELECT DISTINCT section_id FROM ({start})) s CROSS JOIN (VALUES {', '.join(f'({i})' for i in range(LANES))}) t(lane)
      LEFT JOIN (SELECT section_id, variant_idx, row_number() OVER (PARTITION BY section_id ORDER BY variant_idx) - 1 AS lane FROM (
        SELECT section_id, variant_idx FROM v QUALIFY row_number() OVER (PARTITION BY section_id ORDER BY md5(concat_ws('|', '{seed}', section_id, variant_idx)), variant_idx) <= {LANES})) p ON p.section_id = s.section_id AND p.lane = t.lane"""
    return levels_sql(2, f"""SELECT r.root, CAST(r.lane AS INTEGER) AS lane, r.variant_idx, CAST(coalesce(t.n, 0) AS INTEGER) AS n_tokens,
  array_to_string(list_resize(coalesce(t.tokens, []), {SPAN}, 0), ',') AS tokens, coalesce(i.t, '') AS identities, coalesce(m.t, '') AS numbers, coalesce(b.t, '') AS fids
  FROM rows r LEFT JOIN (SELECT root, lane, count(*) AS n, list(CAST(token AS INTEGER) ORDER BY spot) AS tokens FROM own GROUP BY ALL) t USING (root, lane)
  LEFT JOIN (SELECT root, lane, string_agg(CAST(identity AS VARCHAR), ',' ORDER BY spot) AS t FROM ids GROUP BY ALL) i USING (root, lane)
  LEFT JOIN (SELECT root, lane, string_agg(sig || ':' || word, ',' ORDER BY spot) AS t FROM nums GROUP BY ALL) m USING (root, lane)
  LEFT JOIN (SELECT root, lane, string_agg(concat_ws(':', category, identity, fid), ',' ORDER BY category, identity) AS t FROM dense GROUP BY ALL) b USING (root, lane)""", rows).replace(", every AS", f""", st AS MATERIALIZED ({STEP_ROWS}), tg AS MATERIALIZED ({TARGETS}), every AS""", 1).replace(") SELECT r.root", f"""), bl AS (
  SELECT section_id, variant_idx, i, kind, first, second, minus, row_number() OVER (PARTITION BY section_id, variant_idx ORDER BY i, part) AS slot, part FROM st CROSS JOIN (VALUES (0), (1)) h(part) WHERE part = 0 OR kind IN (1, 2, 3)),
ln AS (SELECT root, lane, row_number() OVER (PARTITION BY root, lane ORDER BY depth, ord) - 1 AS node, section_id, variant_idx, 1 + (SELECT count(*) FROM bl WHERE bl.section_id = every.section_id AND bl.variant_idx = every.variant_idx) AS n FROM every),
cs AS (SELECT *, sum(n) OVER (PARTITION BY root, lane ORDER BY node) - n AS start FROM ln), alive AS MATERIALIZED (SELECT * FROM cs WHERE start < {SPAN}),
own AS MATERIALIZED (SELECT * FROM (SELECT root, lane, node, a.section_id, start AS spot, 9 AS token, -1 AS place, 0 AS kind, 0 AS second, false AS minus, true AS self FROM alive a
  UNION ALL SELECT root, lane, node, a.section_id, start + slot, CASE WHEN part = 1 THEN 16 + first ELSE CASE kind WHEN 1 THEN 9 WHEN 2 THEN 8 WHEN 3 THEN 14 ELSE 1 END END, first, kind, second, minus, false
  FROM alive a JOIN bl ON bl.section_id = a.section_id AND bl.variant_idx = a.variant_idx) WHERE spot < {SPAN}),
nums AS (SELECT root, lane, spot, CASE WHEN value = 0 THEN '0' ELSE CAST(CAST(value AS HUGEINT) * CAST(pow(2, 64 - width) AS HUGEINT) AS VARCHAR) END AS sig,
  CAST((CASE WHEN minus THEN 2147483648 ELSE 0 END) + 1073741824 - CASE WHEN value = 0 THEN 0 ELSE 64 - width END AS BIGINT) AS word FROM (
    SELECT *, length(bin(value)) AS width FROM (SELECT root, lane, spot, minus, CASE WHEN minus THEN place ELSE place * 256 + second END AS value FROM own WHERE token = 1))),
hit AS (SELECT o.root, o.lane, o.node, o.spot, o.place, tg.fid FROM own o JOIN alive a USING (root, lane, node) LEFT JOIN tg ON tg.section_id = a.section_id AND tg.variant_idx = a.variant_idx AND tg.place = o.place WHERE o.token = 9 AND NOT self),
said AS (SELECT root, lane, -1 AS node, 0 AS late, 0 AS place, root AS fid, 'f' || root AS key FROM alive WHERE node = 0
  UNION ALL SELECT root, lane, node, 0, tg.place, tg.fid, 'f' || tg.fid FROM alive a JOIN tg USING (section_id, variant_idx)
  UNION ALL SELECT DISTINCT root, lane, node, 1, place, 0, 'n' || node || ':' || place FROM hit WHERE fid IS NULL),
dense AS MATERIALIZED (SELECT root, lane, 9 AS category, key, any_value(fid) AS fid, row_number() OVER (PARTITION BY root, lane ORDER BY min((node, late, place))) - 1 AS identity FROM said GROUP BY root, lane, key),
cnt AS (SELECT root, lane, token, node, sum(count(DISTINCT place)) OVER (PARTITION BY root, lane, token ORDER BY node) - count(DISTINCT place) AS before FROM own WHERE token IN (8, 14) GROUP BY root, lane, token, node),
ids AS (SELECT root, lane, spot, identity FROM (SELECT root, lane, spot, 'f' || section_id AS key FROM own WHERE self UNION ALL SELECT root, lane, spot, CASE WHEN fid IS NULL THEN 'n' || node || ':' || place ELSE 'f' || fid END FROM hit) JOIN dense USING (root, lane, key)
  UNION ALL SELECT root, lane, spot, CAST(before + place AS BIGINT) FROM own JOIN cnt USING (root, lane, token, node))
SELECT r.root""", 1)


SECTIONS = f"SELECT DISTINCT section_id FROM ({VARS})"
LENGTHS = f"SELECT section_id, CAST(max(body_len) AS BIGINT) AS length FROM ({VARS}) GROUP BY section_id"


def parts_of(spark, d):
    v, e = base(spark, d, VARS), materialized(edges(spark, d))
    return v, e, targets(spark, d, e), materialized(bodies(spark, d))


@query("m6_batch_decode", decoded_sql(SECTIONS, 0))
def _(spark, d):
    v, e, t, b = parts_of(spark, d)
    return as_text(batch.batch_decode(v, v, e, t, b, SPAN, 2, LANES))


@query("m14_decoded_batch", decoded_sql(f"SELECT section_id FROM ({LENGTHS}) WHERE length BETWEEN 10 AND 30 ORDER BY md5(concat_ws('|', '5', section_id)), section_id LIMIT 64", 5))
def _(spark, d):
    v, e, t, b = parts_of(spark, d)
    return as_text(batch.load_batch(base(spark, d, LENGTHS), (10, 30), 64, 5, v, e, t, b, SPAN, 2, LANES))


@query("e6_digits_before", f"SELECT conv_id, turn, token, CAST(coalesce(count(*) FILTER (token < 256) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS digits_before FROM ({STREAM})")
def _(spark, d):
    return batch.digits_before(base(spark, d, STREAM), ["conv_id"], "turn").withColumn("digits_before", F.col("digits_before").cast("long"))


@query("e9_record_sections", f"SELECT section_id, CAST(s AS INTEGER) AS variant_idx FROM ({SIZES}) CROSS JOIN (VALUES (0), (1), (2), (3), (4), (5)) t(s) WHERE s < n_variants")
def _(spark, d):
    return batch.record_sections(base(spark, d, SIZES))


@query("e10_row_offsets", f"SELECT section_id, n_variants, CAST(coalesce(sum(n_variants) OVER (ORDER BY section_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start FROM ({SIZES})")
def _(spark, d):
    return batch.row_offsets(base(spark, d, SIZES), ["section_id"], "n_variants").withColumnRenamed("offset", "start")


@query("d12_dense_reservation", f"""SELECT l_orderkey, ids, vals, CAST(coalesce(sum(ids) OVER w, 0) AS BIGINT) AS ids_offset, CAST(coalesce(sum(vals) OVER w, 0) AS BIGINT) AS vals_offset FROM (
  SELECT l_orderkey, CAST(sum(length) AS BIGINT) AS ids, CAST(sum(l_linenumber) AS BIGINT) AS vals FROM ({ITEMS}) GROUP BY l_orderkey) WINDOW w AS (ORDER BY l_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""")
def _(spark, d):
    rows = base(spark, d, ITEMS).select("l_orderkey", F.col("length").cast("long").alias("ids"), F.col("l_linenumber").cast("long").alias("vals"))
    return batch.dense_reservation(rows, ["l_orderkey"], ["ids", "vals"], ["l_orderkey"])


@query("g5_measured_once", f"""SELECT turn_id, conv_id, coalesce(n, 0) AS body_len FROM (SELECT event_id AS turn_id, event_id % 500 AS conv_id FROM {{events}}) LEFT JOIN (
  SELECT conv_id, count(*) FILTER (token > 256) AS n FROM ({STREAM}) GROUP BY conv_id) USING (conv_id)""")
def _(spark, d):
    uses = base(spark, d, "SELECT event_id AS turn_id, event_id % 500 AS conv_id FROM {events}")
    return batch.measured_once(uses, streams(spark, d), "conv_id").select("turn_id", "conv_id", F.coalesce("body_len", F.lit(0)).cast("long").alias("body_len"))


@query("c21_remapped_streams", f"SELECT l.binary, string_agg(CAST(coalesce(u.unified_id, -1) AS VARCHAR), ',' ORDER BY l.local_id) AS tokens FROM ({LOCAL}) l LEFT JOIN ({UNIFIED}) u USING (token) GROUP BY l.binary")
def _(spark, d):
    local = base(spark, d, LOCAL)
    rows = local.groupBy("binary").agg(F.sort_array(F.collect_list("local_id")).alias("tokens"))
    return vocab.remap_tokens(rows, vocab.mapping(local, unified(spark, d)), ["binary"]).select("binary", F.array_join("tokens", ",").alias("tokens"))


@query("b8_eligible_sections", f"SELECT section_id, length FROM ({LENGTHS}) WHERE length BETWEEN 1 AND 6")
def _(spark, d):
    return lengths.in_band(base(spark, d, LENGTHS), 0, 6)


WORDS_OF = "SELECT p_partkey, string_split(p_name, ' ') AS tokens FROM {part}"
WORD_IDS = "SELECT token, CAST(row_number() OVER (ORDER BY token) + 271 AS INTEGER) AS unified_id FROM (SELECT DISTINCT unnest(string_split(p_name, ' ')) AS token FROM {part})"


def words_and_ids(spark, d):
    records = base(spark, d, "SELECT p_partkey, split(p_name, ' ') AS tokens FROM {part}")
    words = records.select(F.explode("tokens").alias("token")).withColumn("file_ord", F.lit(0)).withColumn("local_id", F.lit(0)).distinct()
    ordered = words.select("token", F.lit(0).alias("axis_ord"))
    return records, vocab.unify(words.limit(0), ordered)


@query("h5_axis_records", f"SELECT p_partkey, string_agg(CAST(unified_id AS VARCHAR), ',' ORDER BY pos) AS ids FROM (SELECT p_partkey, unnest(tokens) AS token, generate_subscripts(tokens, 1) AS pos FROM ({WORDS_OF})) JOIN ({WORD_IDS}) USING (token) GROUP BY p_partkey")
def _(spark, d):
    records, ids = words_and_ids(spark, d)
    return vocab.encode_records(records, ids, ["p_partkey"]).select("p_partkey", F.array_join("ids", ",").alias("ids"))


@query("h18_tokens_of_ids", f"SELECT k.unified_id, w.token FROM (SELECT DISTINCT CAST(270 + p_partkey % 30 AS INTEGER) AS unified_id FROM {{part}}) k LEFT JOIN ({WORD_IDS}) w USING (unified_id)")
def _(spark, d):
    _, ids = words_and_ids(spark, d)
    return vocab.tokens_of(base(spark, d, "SELECT DISTINCT CAST(270 + p_partkey % 30 AS INT) AS unified_id FROM {part}"), ids)


@query("n3_variant_cross_check", "SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN 'source_only' WHEN p_partkey % 7 = 0 THEN 'record_only' ELSE 'differs' END AS kind FROM {part} WHERE (p_partkey % 5 = 0) <> (p_partkey % 7 = 0) OR (p_partkey % 11 = 0 AND p_partkey % 5 <> 0 AND p_partkey % 7 <> 0)")
def _(spark, d):
    records, ids = words_and_ids(spark, d)
    encoded = vocab.encode_records(records, ids, ["p_partkey"]).filter("p_partkey % 5 <> 0")
    sources = records.filter("p_partkey % 7 <> 0").withColumn("tokens", F.when(F.col("p_partkey") % 11 == 0, F.concat("tokens", F.array(F.lit("x")))).otherwise(F.col("tokens")))
    return vocab.cross_check(encoded, sources, ids, ["p_partkey"])


@query("a9_saved_vocab", """WITH own AS (SELECT user_id AS b, event_id, concat(event_type, event_id) AS token, length(event_type) AS type_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM {events}),
  g AS (SELECT *, n - row_number() OVER (PARTITION BY b, type_id ORDER BY n) AS island FROM own),
  r AS (SELECT b, string_agg(type_id || 'x' || c, ',' ORDER BY least_n) AS runs FROM (SELECT b, type_id, island, min(n) AS least_n, count(*) AS c FROM g GROUP BY ALL) GROUP BY b)
  SELECT b AS binary, string_agg(token, ',' ORDER BY n) AS cell, any_value(runs) AS runs FROM own JOIN r USING (b) GROUP BY b""")
def _(spark, d):
    own = base(spark, d, "SELECT user_id AS binary, event_id, concat(event_type, event_id) AS token, length(event_type) AS type_id FROM {events}")
    local = own.select("binary", "token", (F.row_number().over(W.partitionBy("binary").orderBy("event_id")) + 256).alias("local_id"))
    reserved = own.select("binary", F.lit("reserved").alias("token"), F.lit(7).alias("local_id")).distinct()
    saved = vocab.saved_rows(local.unionByName(reserved), own.select("token", "type_id").distinct())
    return saved.select("binary", "cell", F.array_join(F.zip_with("types", "runs", lambda t, n: F.concat(t.cast("string"), F.lit("x"), n.cast("string"))), ",").alias("runs"))


@query("m13_collection", "SELECT s.program, t.mode, t.depth, i.program IS NOT NULL AS has_index FROM (SELECT DISTINCT p_brand AS program FROM {part}) s CROSS JOIN (VALUES ('max', 0), ('p50', 2)) t(mode, depth) LEFT JOIN (SELECT DISTINCT p_brand AS program, CASE WHEN p_size % 2 = 0 THEN 'max' ELSE 'p50' END AS mode, CAST(p_size % 4 AS INTEGER) AS depth FROM {part} WHERE p_size < 3) i ON i.program = s.program AND i.mode = t.mode AND i.depth = t.depth")
def _(spark, d):
    indexes = base(spark, d, "SELECT p_brand AS program, CASE WHEN p_size % 2 = 0 THEN 'max' ELSE 'p50' END AS mode, CAST(p_size % 4 AS INT) AS depth FROM {part} WHERE p_size < 3")
    return catalog_tables.collection(base(spark, d, "SELECT p_brand AS program FROM {part}"), indexes, [("max", 0), ("p50", 2)], "keep")


@query("a30_discovered_programs", "SELECT DISTINCT p_brand AS program FROM {part} WHERE p_brand IN ('Brand#11', 'Brand#23', 'Brand#31', 'Brand#44') ORDER BY program LIMIT 3")
def _(spark, d):
    return catalog_tables.discover(base(spark, d, "SELECT p_brand AS program FROM {part}"), ["Brand#44", "Brand#23", "Brand#11", "Brand#31"], 3)


@query("m16_function_by_name", f"SELECT o_orderkey AS section_id, l_linenumber AS variant_idx, l_partkey AS body_id FROM {{orders}} JOIN {{lineitem}} ON l_orderkey = o_orderkey WHERE o_orderpriority = '1-URGENT' AND o_custkey % 50 = 7")
def _(spark, d):
    sections = base(spark, d, "SELECT o_orderpriority AS program, o_orderkey AS section_id, concat('f', CAST(o_custkey % 50 AS STRING)) AS func_name FROM {orders}")
    variants = base(spark, d, "SELECT o_orderpriority AS program, l_orderkey AS section_id, l_linenumber AS variant_idx, l_partkey AS body_id FROM {lineitem} JOIN {orders} ON o_orderkey = l_orderkey")
    return catalog_tables.function_by_name(sections, variants, "1-URGENT", "f7").select("section_id", "variant_idx", "body_id")


@query("d24_float_inventory", f"""SELECT conv_id % 7 AS package, count(*) AS n_files, CAST(sum(n) AS BIGINT) AS n_found FROM (SELECT conv_id, count(*) AS n FROM (
  SELECT conv_id, token, lead(token) OVER (PARTITION BY conv_id ORDER BY turn) AS following FROM ({STREAM})) WHERE token BETWEEN 257 AND 263 AND coalesce(following, 256) >= 256 GROUP BY conv_id) GROUP BY ALL""")
def _(spark, d):
    broken = F.size(metadata.broken_floats(F.col("tokens"), list(range(257, 264)))).cast("long")
    return catalog_tables.files_with(streams(spark, d).withColumn("package", F.col("conv_id") % 7), "package", "conv_id", broken)


@query("f9_report_rows", f"SELECT * FROM ({SECTIONS}) ORDER BY section_id LIMIT 10")
def _(spark, d):
    return catalog_tables.report_rows(base(spark, d, f"SELECT DISTINCT section_id FROM ({VARS})"), ["section_id"])


@query("a13_records", "SELECT conv_id, n, kind FROM (SELECT conv_id, count(*) AS n, CASE WHEN conv_id % 3 = 0 THEN 'uneven' ELSE 'record' END AS kind FROM {conversations} GROUP BY conv_id)")
def _(spark, d):
    rows = base(spark, d, "SELECT conv_id, count(*) AS n FROM {conversations} GROUP BY conv_id")
    parsed = rows.select(F.lit("b").alias("binary"), F.col("conv_id").cast("string").alias("func_name"), F.array_repeat(F.lit(272), F.col("n").cast("int")).alias("tokens"),
                         F.array(F.col("n") + F.when(F.col("conv_id") % 3 == 0, 1).otherwise(0)).alias("block_rl"), F.array_repeat(F.lit(1), F.col("n").cast("int")).alias("insn_rl"))
    good, bad = catalog_tables.assemble_records(parsed)
    found = good.select("func_name", F.lit("record").alias("kind")).unionByName(bad.select("func_name", F.col("reason").alias("kind")))
    return rows.join(found, F.col("func_name") == F.col("conv_id").cast("string")).select("conv_id", "n", "kind")
