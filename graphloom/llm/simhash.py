"""SimHash near-dedup by covering locality-sensitive hashing."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from graphloom.llm._util import beside, connected_components, cut, let_go, row_key, sieve
from graphloom.llm.minhash import MIX, band_keys, in_groups, linked, minima

#: Shingles handled at a time, so that a very long text needs no more memory than this.
CHUNK = 1 << 15
#: Buckets of at most so many fingerprints are compared pair by pair; larger ones go through shared neighbours.
SMALL_BUCKET = 12
LOCAL_BUCKET = 4096
#: The same bound where all near pairs are asked for, as a ball of an odd radius has more points.
PAIR_BUCKET = 512
#: Bands of the MinHash signature of a shingle set, and values in each.
BANDS, ROWS = 22, 5
#: Bits that fingerprints of texts which meet may differ in.
RADIUS = 2
#: Up to so many ids (under 16 MB) are broadcast.
BROADCAST_IDS = 500_000
#: Byte -> eight counters, one in each byte of a 64-bit word.
LANES = np.array([sum(((b >> k) & 1) << (8 * k) for k in range(8)) for b in range(256)], dtype=np.uint64)


def shingle_hashes(text: str | None, width: int) -> list[int]:
    """XXH64 (seed 42) of the space-joined word shingles of the text, A-Z lower-cased."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return []
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= width:
        return [digest(joined, 42)]
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1
    ends = np.cumsum(sizes) - 1
    starts = (ends - sizes + 1)[: len(words) - width + 1].tolist()
    return [digest(joined[a:b], 42) for a, b in zip(starts, ends[width - 1 :].tolist(), strict=True)]


def simhash64(hashes: list[int] | np.ndarray) -> int:
    """A bit is 1 if it is set in over half the hashes; 0 for none."""
    n = len(hashes)
    if n == 0:
        return 0
    counts = np.zeros(64, dtype=np.int64)
    every = np.array(hashes, dtype=np.uint64)
    for at in range(0, n, CHUNK):
        lanes = LANES[every[at : at + CHUNK].view(np.uint8).reshape(-1, 8)]
        sums = np.add.reduceat(lanes, np.arange(0, len(lanes), 255), axis=0)
        counts += sums.view(np.uint8).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """(id, fp): the 64-bit SimHash of every text, as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            fps = [simhash64(shingle_hashes(t, width)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.array(fps, dtype=np.uint64).view(np.int64))], names=["id", "fp"])

    pruned = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    return pruned.mapInArrow(run, f"id {pruned.schema['id'].dataType.simpleString()}, fp long")


def covering_masks(radius: int, bits: int = 64, seed: int = 7) -> list[int]:
    """2**(radius + 1) - 1 masks such that any two words at most `radius` bits apart agree under one.

    Each bit position gets a non-zero vector of radius + 1 bits, dealt evenly; mask v keeps the
    positions whose vector has an odd product with v. For up to `radius` differing positions some
    non-zero v is orthogonal to all their vectors, so that mask drops every difference.
    """
    top, best = 1 << (radius + 1), []
    for attempt in range(64):  # keep the deal whose shortest key is longest
        rng = np.random.default_rng(seed + attempt)
        dealt = np.concatenate([rng.permutation(top - 1) for _ in range(-(-bits // (top - 1)))])[:bits] + 1
        masks = [sum(1 << p for p, x in enumerate(dealt.tolist()) if (x & v).bit_count() % 2) for v in range(1, top)]
        best = max(best, masks, key=lambda m: min((x.bit_count() for x in m), default=0))
    return best


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def pigeonhole_masks(radius: int, blocks: int, bits: int = 64) -> list[int]:
    """Every choice of blocks - radius of the blocks: words at most `radius` bits apart agree on one choice."""
    edges = [bits * i // blocks for i in range(blocks + 1)]
    own = [sum(1 << b for b in range(x, y)) for x, y in itertools.pairwise(edges)]
    return [sum(c) for c in itertools.combinations(own, blocks - radius)]


def _forest(rows: pa.Table, radius: int) -> pa.Table:
    """Edges of a spanning forest over the links among the fingerprints of one bucket."""
    left = rows.column("fp").to_numpy().astype(np.int64)
    us, vs, todo = [], [], []
    while len(left) or todo:
        if not todo:
            todo, left = [left[0]], left[1:]
        at = todo.pop()
        near = np.bitwise_count((left ^ at).view(np.uint64)) <= radius
        found = left[near]
        left = left[~near]
        us.append(np.full(len(found), at, dtype=np.int64))
        vs.append(found)
        todo.extend(found.tolist())
    return pa.table({"u": np.concatenate([*us, np.zeros(0, np.int64)]), "v": np.concatenate([*vs, np.zeros(0, np.int64)])})


def near_edges(fps: DataFrame, radius: int, masks: list[int] | None = None, every_pair: bool = False) -> DataFrame:
    """Edges (u, v) between distinct fingerprints at most `radius` bits apart.

    fps: one row per distinct fp. Fingerprints meet in the buckets of the masks (covering masks unless
    given). In a small bucket every pair is verified. A large bucket, of near copies, is linked through
    shared points instead: two words are within r bits if and only if the balls of floor(r / 2) bits
    around one and ceil(r / 2) around the other share a point, and within a bucket only the bits
    outside its mask can differ. A point has at most as many members as a ball has points, so the rows
    are linear in the bucket. every_pair: all near pairs, u < v; large buckets are first cut by finer masks. Otherwise just enough edges to connect
    the same components: for an even radius each member is tied to the least one at its points; and
    for a radius over 3, whose balls are large, buckets of up to LOCAL_BUCKET fingerprints (32 kB) are
    compared in one task each, which gives a spanning forest of the bucket's links.
    """
    masks = covering_masks(radius) if masks is None else masks
    return _links(fps, masks, None, radius, every_pair).distinct()


def _by_mask(masks: list[int], each) -> Column:
    """each(mask), an array of longs, of the row's mask number t."""
    out = F.lit(None).cast("array<bigint>")
    for t, m in enumerate(masks):
        out = F.when(F.col("t") == t, F.array(*[F.lit(_signed(x)).cast("long") for x in each(m)])).otherwise(out)
    return out


def _links(fps: DataFrame, masks: list[int], finer: list[list[int]] | None, radius: int, every_pair: bool) -> DataFrame:
    """Edges within the buckets of the masks. finer: the masks are those in each row's own list, numbered by t."""
    if finer is None:
        entries = fps.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(_signed(m))) for m in masks])).alias("t", "key"))
    else:
        masks = [m for group in finer for m in group]
        wide = len(finer[0])
        own = _by_mask([group[0] for group in finer], lambda m: next(g for g in finer if g[0] == m))
        entries = fps.withColumn("m", own).select("fp", "t", F.posexplode(F.transform("m", lambda m: F.col("fp").bitwiseAND(m))).alias("j", "key")).select(
            "fp", (F.col("t") * wide + F.col("j")).alias("t"), "key")
    sizes = entries.groupBy("t", "key").agg(F.count("*").alias("n")).filter("n > 1")
    met = cut(entries.join(sizes, ["t", "key"]))
    small = PAIR_BUCKET if every_pair else SMALL_BUCKET
    few = met.filter(F.col("n") <= small).select("t", "key", "fp")
    other = few.select("t", "key", F.col("fp").alias("fp2"))
    apart = F.bit_count(F.col("fp").bitwiseXOR(F.col("fp2")))
    pairs = few.join(other, ["t", "key"]).filter((F.col("fp") < F.col("fp2")) & (apart <= radius)).select(
        F.col("fp").alias("u"), F.col("fp2").alias("v"))
    local = not every_pair and radius > 3
    many = met.filter(F.col("n") > (LOCAL_BUCKET if local else small)).select("fp", "t")
    if local:
        mid = met.filter(F.col("n").between(SMALL_BUCKET + 1, LOCAL_BUCKET)).select("t", "key", "fp")
        pairs = pairs.unionByName(mid.groupBy("t", "key").applyInArrow(lambda rows: _forest(rows, radius), "u bigint, v bigint"))
    if every_pair and finer is None:
        return pairs.unionByName(_links(many, masks, [_finer(m, radius) for m in masks], radius, every_pair))
    many = cut(many)
    if many.isEmpty():
        return pairs
    spark = fps.sparkSession
    # The balls over each mask's free bits, as rows: as many as masks times a ball's points, whatever the input.
    balls = [spark.createDataFrame([(t, d) for t, m in enumerate(masks) for d in _ball(m, k)], "bt int, d bigint") for k in (radius // 2, (radius + 1) // 2)]
    near, far = (many.join(F.broadcast(ball), F.col("t") == F.col("bt")).select("t", "fp", F.col("fp").bitwiseXOR(F.col("d")).alias("point")) for ball in balls)
    if radius % 2 == 0 and not every_pair:
        low = F.min("fp").over(W.partitionBy("t", "point"))
        tied = near.select("fp", low.alias("low")).filter("fp <> low").select(F.col("fp").alias("u"), F.col("low").alias("v"))
    else:
        far = far.toDF("t2", "fp2", "point2")
        tied = near.join(far, (F.col("t") == F.col("t2")) & (F.col("point") == F.col("point2")) & (F.col("fp") < F.col("fp2"))).select(
            F.col("fp").alias("u"), F.col("fp2").alias("v"))
    return pairs.unionByName(tied)


def _ball(mask: int, radius: int) -> list[int]:
    """Sums of up to `radius` bits that the mask leaves free."""
    free = [1 << b for b in range(64) if not mask >> b & 1]
    return [_signed(sum(c)) for k in range(radius + 1) for c in itertools.combinations(free, k)]


def _finer(mask: int, radius: int) -> list[int]:
    """The mask with each of radius + 1 parts of its free bits: words of one bucket within the radius agree on a part."""
    free = [b for b in range(64) if not mask >> b & 1]
    return [mask | sum(1 << b for b in free[k :: radius + 1]) for k in range(radius + 1)]


def near_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, radius: int = 2) -> DataFrame:
    """One row per row of docs: id, fp (long) and component (the least id reachable over links).

    Documents link if their fingerprints differ in at most `radius` bits. Null and empty texts and
    texts without words have fingerprint zero and link as any other. Equal texts collapse to one
    fingerprint before any comparison. Null ids keep their rows; the component is the least
    non-null id of the group, null if it has none. Other columns of docs are not read.
    """
    marked = cut(fingerprints(docs, id_col, text_col, width))
    distinct = marked.groupBy("fp").agg(F.min("id").alias("least"))
    comps = connected_components(near_edges(distinct.select("fp"), radius))
    labelled = distinct.join(comps, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    least = labelled.groupBy("root").agg(F.min("least").alias("component"))
    by_fp = labelled.join(least, "root").select("fp", "component")
    return marked.join(by_fp, "fp").select("id", "fp", "component")


def fingerprint_keys(fps: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """Keys (signed longs; one row for each fingerprint) of the buckets of the covering masks: fingerprints at most `radius` bits apart share one."""
    masks = np.array(covering_masks(radius), dtype=np.uint64)
    keys = ((fps[:, None] & masks) ^ (np.arange(1, len(masks) + 1, dtype=np.uint64) * MIX)) * MIX
    return ((keys ^ (keys >> np.uint64(29))) * MIX).view(np.int64)


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """The distinct shingle hashes of the text, ascending."""
    return np.unique(np.array(shingle_hashes(text, width), dtype=np.uint64))


def marked_sets(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """(id, rk, node, size, keys) of every row: 64-bit hash and size of its shingle set, and the keys of the set's SimHash and MinHash bands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            sets = [shingle_set(t.as_py(), width) for t in batch.column(2)]
            nodes = np.array([xxhash.xxh3_64_intdigest(x.tobytes()) for x in sets], dtype=np.uint64).view(np.int64)
            sizes = np.fromiter(map(len, sets), dtype=np.int64, count=len(sets))
            own = np.flatnonzero(sizes)
            keys: list[list[int]] = [[] for _ in sets]
            fps = np.array([simhash64(sets[i]) for i in own.tolist()], dtype=np.uint64)
            for i, of_one in zip(own.tolist(), fingerprint_keys(fps).tolist(), strict=True):
                keys[i] = of_one
            for a, b in in_groups(sizes[own]):
                low = minima(np.concatenate([(sets[i] >> np.uint64(32)).astype(np.uint32) for i in own[a:b].tolist()]), sizes[own[a:b]], BANDS * ROWS)
                for i, of_one in zip(own[a:b].tolist(), band_keys(low, ROWS).T.tolist(), strict=True):
                    keys[i] = keys[i] + of_one
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(nodes), pa.array(sizes), pa.array(keys, pa.list_(pa.int64()))],
                                             names=["id", "rk", "node", "size", "keys"])

    given = docs.select(F.col(id_col).alias("id"), row_key(docs, id_col, text_col).alias("rk"), F.col(text_col).alias("t"))
    return given.mapInArrow(run, f"id {given.schema['id'].dataType.simpleString()}, rk binary, node bigint, size bigint, keys array<bigint>")


def similar_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, similar: float = 0.8) -> DataFrame:
    """One row per row of docs: id, rk (its row_key), fp (of its shingle set) and root, equal for the rows of a group.

    Texts link if the Jaccard similarity of their word shingles is `similar` or more, also through others; texts
    without words are one group. Candidates are texts whose SimHashes over the distinct shingles share a bucket of the
    covering masks, as all within RADIUS bits do, and those that share one of BANDS bands of ROWS MinHash values (which a
    pair of similarity 0.8 misses with a probability of 2e-4); each link is verified on the texts.
    """
    marked = cut(marked_sets(docs, id_col, text_col, width))
    sets = cut(marked.groupBy("node").agg(F.min("rk").alias("rk"), F.first("size").alias("size"), F.first("keys").alias("keys")))

    def alike(a: np.ndarray, b: np.ndarray) -> bool:
        both = len(np.intersect1d(a, b, assume_unique=True))
        return both >= similar * (len(a) + len(b) - both) - 1e-9

    def texts(rows: DataFrame) -> DataFrame:
        wanted = cut(rows.join(sets.select(F.col("node").alias("of"), F.col("rk").alias("__rk")), F.col("node") == F.col("of")))
        given = docs.select(row_key(docs, id_col, text_col).alias("rk"), F.col(text_col).alias("t"))
        places = wanted.agg(F.sum(F.size("places"))).first()[0] if "places" in rows.columns else wanted.count()
        if (places or 0) <= BROADCAST_IDS:
            wanted = F.broadcast(wanted)
        else:
            given = sieve(given, "rk", wanted.select("__rk")).filter("__maybe")
        return given.join(wanted, F.col("rk") == F.col("__rk")).select(*rows.columns, F.coalesce("t", F.lit("")).alias("text"))

    groups = linked(sets.select(F.explode("keys").alias("key"), "node", "size"), similar, texts, lambda text: shingle_set(text, width), alike).withColumnRenamed("node", "of")
    return marked.join(groups, F.col("node") == F.col("of"), "left").select("id", "rk", F.col("node").alias("fp"), F.coalesce("root", "node").alias("root"))


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, similar: float = 0.8) -> DataFrame:
    """One row of each group of similar_components. All columns stay.

    The row with the least id stays, nulls last, then the one with the least row key. Each row is decided by
    itself: an id that occurs with two texts, or no id, is no reason to go. Rows alike in id and text are told
    apart by their other columns only: the least as JSON stays. The keys that go are broadcast while they are
    few, else joined.
    """
    marked = cut(similar_components(docs, id_col, text_col, width, similar))
    docs_by = marked.groupBy("root", "rk").agg(F.min("id").alias("id"), F.count("*").alias("n"))
    order = F.struct(F.col("id").isNull().alias("none"), "id", "rk")
    stays = docs_by.groupBy("root").agg(F.min(order)["rk"].alias("stays")).withColumnRenamed("root", "of")
    judged = docs_by.join(stays, F.col("root") == F.col("of"))
    told = cut(judged.filter("rk <> stays or n > 1").select(F.col("rk").alias("__rk"), (F.col("rk") == F.col("stays")).alias("__stays")))
    joined = beside(docs.withColumn("__key", row_key(docs, id_col, text_col)), "__key", told, "__rk", told.count() <= BROADCAST_IDS)
    alone = joined.filter("__rk is null").select(*[F.col(f"`{c}`") for c in docs.columns])
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    repeated = joined.filter("__stays").groupBy("__key").agg(F.min_by(row, F.to_json(row)).alias("__row")).select("__row.*")
    return alone.unionByName(repeated)


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = near_components(docs, width=3, radius=2)
    return out.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                      F.col("component").alias("component_id"))
