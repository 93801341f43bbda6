"""Document fingerprints by I-Match with randomised lexicon subsets, in DataFrame expressions only.

Terms inside a band of document frequency make the lexicon. Fixed random sub-lexicons, the same for all
documents, hold one in 16, 64, ... 4096 of its terms. The terms that each sub-lexicon leaves of a document,
sorted and distinct, are hashed, so an edit changes only the hashes of the sub-lexicons that hold a changed
term: small ones tell near copies of long texts, large ones those of short texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from graphloom.llm._util import cut, let, shuffle_width

#: Share of documents that a term of the lexicon occurs in. At most (mean distinct terms a document) / LOW terms qualify.
LOW, HIGH = 0.0005, 0.01
#: A text is common if fewer than one in SPARSE of its terms from LOW on are in the band: then they all count, however frequent.
SPARSE = 8
#: Sub-lexicons of each rate, which are disjoint, and the rates: one in so many terms.
SUBSETS, RATES = 16, (16, 64, 256, 1024, 4096)
#: Up to so many terms (under 64 MB) are broadcast; a larger lexicon is joined by key.
BROADCAST_TERMS = 1_000_000
SPACES = "[\\x20\\x09-\\x0D]+"
#: Stands in every text, so that texts without terms keep their row.
MARK = "\x00"
#: Quantiles of the id that cut the order into ranges; each is cut evenly into narrower ones.
COARSE = 64


def terms(text: Column) -> Column:
    return F.array_distinct(F.split(F.lower(text), SPACES, -1))


def lexicon(docs: DataFrame) -> DataFrame:
    """(term, code, band) of the terms from LOW on, counted over distinct texts; band: whether at most HIGH."""
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text")).distinct()
    n = texts.count()
    df = texts.select(F.explode(terms(F.col("text"))).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    known = df.filter((F.col("df") >= LOW * n) & (F.col("term") != "") & (F.col("term") != MARK))
    return cut(known.select("term", F.hash("term").alias("code"), (F.col("df") <= max(HIGH * n, 1)).alias("band")))


def ranges(docs: DataFrame, width: int) -> Column:
    """Number of a row's range of ids, ascending; null ids come first."""
    key = F.col("doc_id").cast("long")
    points = [i / COARSE for i in range(1, COARSE)]
    row = docs.agg(F.min(key).alias("a"), F.max(key).alias("b"), F.percentile_approx(key, F.array(*[F.lit(p) for p in points]), 10_000).alias("q")).first()
    if row["a"] is None:
        return F.lit(0).cast("long")
    cuts = sorted({row["a"], *row["q"]}) + [row["b"] + 1]
    fine = max(1, -(-8 * width // COARSE))
    starts, sizes = F.array(*[F.lit(c).cast("long") for c in cuts]), [b - a for a, b in zip(cuts, cuts[1:], strict=False)]
    at = F.size(F.filter(starts, lambda s: s <= key)) - 1
    lengths = F.array(*[F.lit(s).cast("double") for s in sizes])
    inner = F.floor((key - F.get(starts, at)) * F.lit(float(fine)) / F.get(lengths, at))
    return F.coalesce(at.cast("long") * fine + F.least(inner, F.lit(fine - 1)), F.lit(-1).cast("long"))


def in_order(docs: DataFrame) -> DataFrame:
    """rng, rid, guest and next_text beside doc_id and text: the next document by ascending id, then text.

    Rows go to ranges of ids; the first document of the following range is a guest at the end of each,
    so one shuffle by range serves, and no task holds more than a range. The driver sees the least id
    of every range (eight ranges for each shuffle partition).
    """
    spark = docs.sparkSession
    width = shuffle_width(spark)
    placed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("rng", ranges(docs, width))
    firsts = sorted(placed.groupBy("rng").agg(F.min("doc_id").alias("doc_id")).collect(), key=lambda r: r["rng"])
    kind = docs.schema["doc_id"].dataType.simpleString()
    hosts = [(firsts[(i + 1) % len(firsts)]["doc_id"], r["rng"]) for i, r in enumerate(firsts)]
    hosts = spark.createDataFrame(hosts, f"first_id {kind}, host bigint")
    guests = placed.join(F.broadcast(hosts), F.col("doc_id").eqNullSafe(F.col("first_id"))).select("doc_id", "text", F.col("host").alias("rng"))
    rows = placed.withColumn("guest", F.lit(False)).unionByName(guests.withColumn("guest", F.lit(True)))
    by = W.partitionBy("rng").orderBy("guest", "doc_id", "text")
    return rows.withColumn("rid", F.row_number().over(by)).withColumn("next_text", F.lead("text").over(by))


def subset_hashes(codes: Column) -> Column:
    """For each rate and sub-lexicon, the hash of its terms in a sorted array of codes: 8 hex digits, '' for none. Empty for no codes."""

    def hashed(own: Column) -> Column:
        text = F.right(F.lpad(F.lower(F.hex(F.xxhash64(F.transform(own, lambda x: x["c"])))), 16, "0"), F.lit(8))
        return F.when(F.size(own) == 0, "").otherwise(text)

    def at(rate: int) -> Column:
        marked = F.transform(codes, lambda c: F.struct(F.pmod(F.xxhash64(c, F.lit(rate)), F.lit(rate)).alias("s"), c.alias("c")))
        used = F.filter(marked, lambda x: x["s"] < SUBSETS)
        return let(used, lambda m: F.transform(F.sequence(F.lit(0), F.lit(SUBSETS - 1)), lambda s: let(F.filter(m, lambda x: x["s"] == s), hashed)))

    return F.when(F.size(codes) == 0, F.array().cast("array<string>")).otherwise(F.concat(*[at(r) for r in RATES]))


def as_text(hashes: Column, text_hash: Column) -> Column:
    """The fingerprint as text: each rate's hashes; of a text without lexicon terms, a hash of the text."""
    return F.when(F.size(hashes) == 0, F.concat(F.lit("w:"), text_hash)).otherwise(
        F.concat_ws(" ", *[F.concat(F.lit(f"{r}:"), F.array_join(F.slice(hashes, SUBSETS * i + 1, SUBSETS), ".")) for i, r in enumerate(RATES)]))


def likeness(a: Column, b: Column, text_a: Column, text_b: Column) -> Column:
    """1 for equal fingerprints; else the share of equal hashes among the sub-lexicons with a term of either text."""
    same = F.filter(F.zip_with(a, b, lambda p, q: F.when((p != "") | (q != ""), p == q)), lambda v: v.isNotNull())
    share = let(same, lambda v: F.when(F.size(v) == 0, 0.0).otherwise(F.size(F.filter(v, lambda t: t)) / F.size(v)))
    return F.when(text_a == text_b, 1.0).when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(F.coalesce(share, F.lit(0.0)))


def fingerprint_pairs(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next for every row of docs.

    The edited text has its last quarter replaced by the beginning of the next document. Null texts are
    empty; null ids sort first, equal ids by text; a single document is its own next. Ids are whole numbers;
    others count as null for their place in the order. Equal texts have equal fingerprints. Other columns are
    not read. An empty table gives an empty one.
    """
    docs = docs.select("doc_id", "text")
    words = lexicon(docs)
    n, q = F.length("text"), F.floor(F.length("text") / 4).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - q), F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), q))
    rows = in_order(docs).withColumn("edited", edited)
    sides = F.array(F.col("text"), F.col("edited"))
    rows = rows.select("rng", "rid", "guest", "doc_id", n.cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
                       F.md5("text").alias("own"), F.md5("edited").alias("new"), F.posexplode(sides).alias("side", "t"))
    rows = rows.select("rng", "rid", "guest", "doc_id", "n_chars", "edited_sha256", "own", "new", "side", F.explode(F.concat(F.array(F.lit(MARK)), terms(F.col("t")))).alias("word"))
    known = words.unionByName(words.sparkSession.createDataFrame([(MARK, None, None)], "term string, code int, band boolean"))
    if words.count() <= BROADCAST_TERMS:
        known = F.broadcast(known)
    met = rows.join(known, F.col("word") == F.col("term"))
    one = met.groupBy("rng", "rid").agg(
        *[F.first(c).alias(c) for c in ("guest", "doc_id", "n_chars", "edited_sha256", "own", "new")],
        *[F.array_sort(F.collect_set(F.when(F.col("side") == i, F.col("code")))).alias(f"all{i}") for i in (0, 1)],
        *[F.array_sort(F.collect_set(F.when((F.col("side") == i) & F.col("band"), F.col("code")))).alias(f"codes{i}") for i in (0, 1)])
    common = [F.size(f"codes{i}") * SPARSE < F.size(f"all{i}") for i in (0, 1)]
    both = one.select("rng", "rid", "guest", "doc_id", "n_chars", "edited_sha256", subset_hashes(F.col("codes0")).alias("a"), subset_hashes(F.col("codes1")).alias("b"),
                      "all0", "all1", common[0].alias("common0"), common[1].alias("common1"), "own", "new")
    for i, band, name, text in ((0, "a", "fingerprint", "own"), (1, "b", "edited_fingerprint", "new")):
        both = both.withColumn(name, as_text(F.when(F.col(f"common{i}"), subset_hashes(F.col(f"all{i}"))).otherwise(F.col(band)), F.col(text)))
    by = W.partitionBy("rng").orderBy("rid")
    both = both.select("*", *[F.lead(c).over(by).alias(new) for c, new in (("a", "c"), ("all0", "all2"), ("common0", "common2"), ("fingerprint", "next_fingerprint"))]).filter("not guest")

    def near(band: str, i: int, text: str) -> Column:
        """Likeness by the band; by all terms where either text is common."""
        wide = likeness(subset_hashes(F.col("all0")), subset_hashes(F.col(f"all{i}")), F.col("fingerprint"), F.col(text))
        return F.when(F.col("common0") | F.col(f"common{i}"), wide).otherwise(likeness(F.col("a"), F.col(band), F.col("fingerprint"), F.col(text)))

    return both.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                       near("b", 1, "edited_fingerprint").alias("near_edited"), near("c", 2, "next_fingerprint").alias("near_next"))


def query(spark, sf_dir: str) -> DataFrame:
    return fingerprint_pairs(spark.read.parquet(f"{sf_dir}/documents.parquet"))
