"""Scores of texts by a gated recurrent language model that is trained on the corpus.

The corpus' word counts, all of them, give every word its class and its share in it. Frequent words have logits of
their own; the others share a class with words of like counts, and the rarest one class, within which counts decide.
The network learns data-parallel: in every round each task runs truncated backpropagation over its part of the
round's texts, and the tasks' weights are averaged. Untrained, a text has the probability that counts give it.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from graphloom.llm import gated_net
from graphloom.llm._util import PARTS, cut, part_rows, summed
from graphloom.llm.text_stats import SPACES
from graphloom.llm.word_codes import byte_table, words_of

#: Words with counts at the driver and all tasks (under 16 MB); the counts of rarer ones are joined by key.
KNOWN_WORDS = 1 << 19
#: Targets with logits of their own (the end is one), and their classes.
HEAD, CLASSES = 1024, 16
#: Parts of the corpus that the network learns one after another, averaging between them.
ROUNDS = 4
#: Blocks of words that are counted or looked up at a time: each lookup hashes all known words anew.
LOOKUP = 16
#: Tokens that are scored at a time; the last text may go beyond.
LOAD = 1 << 22
#: Held-out rows of the contract: CRC-32 of the id as text, modulo this, is that.
MODULUS, HELD = 7, 2
END = 0


def held_out(id_col: str = "doc_id") -> Column:
    """Null ids aren't held out."""
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % MODULUS == HELD, F.lit(False))


def _table() -> bytes:
    return byte_table(SPACES.encode())


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, c) of all words of the column text, A-Z lower-cased."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _table()
        for batch in batches:
            for blocks in itertools.batched(words_of(batch.column(0), table), LOOKUP):
                found = pc.value_counts(pa.chunked_array([words for words, _, _ in blocks]))
                yield pa.RecordBatch.from_arrays([found.field(0), found.field(1)], names=["word", "c"])

    return texts.select("text").mapInArrow(run, "word string, c bigint").groupBy("word").agg(F.sum("c").alias("c"))


@dataclass(frozen=True)
class Vocabulary:
    """The corpus' counts. tokens: N, distinct: V, ends: documents; words, most frequent first, and their counts.

    Word i is target i + 1 while that is below len(head); then it shares the class of its count's size in bits.
    """

    tokens: int
    distinct: int
    ends: int
    words: pa.Array
    counts: np.ndarray

    def layout(self) -> tuple[gated_net.Output, np.ndarray, np.ndarray, int, float]:
        """Output; of each word its target and log10 share within a shared class; the rarest words' target, and their class' mass."""
        head = np.concatenate([[self.ends], self.counts[: HEAD - 1]]).astype(np.float64) + 1
        rest = self.counts[HEAD - 1 :].astype(np.float64) + 1
        root = np.sqrt(head)
        places = np.minimum((np.cumsum(root) - root) / root.sum() * CLASSES, CLASSES - 1).astype(int)
        edges = np.concatenate([[0], np.flatnonzero(np.diff(places)) + 1, [len(head)]])
        masses = np.add.reduceat(head, edges[:-1])
        bits = np.frexp(rest)[1]
        bands, band = np.unique(-bits, return_inverse=True)
        shared = np.bincount(band, weights=rest, minlength=len(bands))
        rarest = max(self.tokens + self.distinct + 1 - masses.sum() - shared.sum(), 1.0)  # nothing is known without tokens
        prior = np.concatenate([masses, shared, [rarest]])
        bias = np.log(head / np.repeat(masses, np.diff(edges)))
        out = gated_net.Output(edges, np.log(prior / prior.sum()).astype(np.float32), bias.astype(np.float32))
        target = np.concatenate([np.arange(1, len(head)), len(head) + band]).astype(np.int32)
        share = np.concatenate([np.zeros(len(head) - 1), np.log10(rest / shared[band])])
        return out, target, share, out.targets - 1, float(rarest)


def vocabulary(counts: DataFrame, ends: int) -> Vocabulary:
    """Of the counts of all words, the totals, and the words of at least the count that leaves KNOWN_WORDS."""
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    size = F.floor(F.log2("c") * 8)
    least, held = 0, 0
    for row in sorted(counts.groupBy(size.alias("size")).count().collect(), key=lambda r: -r["size"]):
        held += row["count"]
        if held > KNOWN_WORDS:
            break
        least = row["size"]
    else:
        least = 0
    known = counts.filter(size >= least) if held else counts.limit(0)
    if held > KNOWN_WORDS and held == row["count"]:  # the most frequent size alone is too large
        known = counts.limit(0)
    known = known.toArrow().sort_by([("c", "descending"), ("word", "ascending")])
    return Vocabulary(total["n"] + ends, total["v"] + (ends > 0), ends, known["word"].combine_chunks(), known["c"].to_numpy())


@dataclass
class Coded:
    """Texts as targets, each ended by END. bounds: where each starts; base, share: log10 sums of what counts give."""

    ids: np.ndarray
    bounds: np.ndarray
    known: np.ndarray
    base: np.ndarray
    share: np.ndarray
    rare: list[tuple[np.ndarray, pa.Array, np.ndarray]]  # texts, words, times


class Coder:
    def __init__(self, words: Vocabulary):
        self.words, self.table = words, _table()
        self.out, target, share, self.rarest, _ = words.layout()
        self.target = np.append(target, self.rarest).astype(np.int32)  # the last is what an unknown word finds
        self.share = np.append(share, 0.0)
        self.base = np.append(np.log10(words.counts + 1.0) - np.log10(words.tokens + words.distinct + 1.0), 0.0)
        self.end = float(np.log10(words.ends + 1.0) - np.log10(words.tokens + words.distinct + 1.0))

    def code(self, texts: pa.Array) -> Coded:
        n, size = len(texts), len(self.words.words)
        parts, owners, rare = [], [], []
        known, base, share = np.full(n, int(self.words.ends > 0)), np.full(n, self.end), np.zeros(n)
        for blocks in itertools.batched(words_of(texts, self.table), LOOKUP):
            encoded = [words.dictionary_encode() for words, _, _ in blocks]
            every = pa.chunked_array([coded.dictionary for coded in encoded])
            at = pc.index_in(every, value_set=self.words.words).fill_null(size).to_numpy()
            ends = np.cumsum([len(coded.dictionary) for coded in encoded])
            for coded, end, (_, text, _) in zip(encoded, ends.tolist(), blocks, strict=True):
                own = coded.indices.to_numpy()
                number = at[end - len(coded.dictionary) : end][own]
                parts.append(self.target[number])
                owners.append(text)
                known += np.bincount(text, weights=number < size, minlength=n).astype(np.int64)
                base += np.bincount(text, weights=self.base[number], minlength=n)
                share += np.bincount(text, weights=self.share[number], minlength=n)
                lost = number == size
                pair, times = np.unique(text[lost].astype(np.int64) * len(coded.dictionary) + own[lost], return_counts=True)
                rare.append((pair // len(coded.dictionary), coded.dictionary.take(pa.array(pair % len(coded.dictionary))), times))
        text = np.concatenate(owners) if owners else np.zeros(0, dtype=np.int64)
        bounds = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=n) + 1)]).astype(np.int64)
        ids = np.full(int(bounds[-1]), END, dtype=np.int32)
        if len(text):
            ids[np.arange(len(text)) + text] = np.concatenate(parts)
        return Coded(ids, bounds, known, base, share, rare)


@dataclass(frozen=True)
class Model:
    words: Vocabulary
    weights: dict[str, np.ndarray]


def _round(texts: DataFrame, model: Model) -> np.ndarray:
    """The tasks' weights after a pass over the texts, times their tokens, and the tokens."""
    sent = texts.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(sent.value.words)
        net = gated_net.Net(coder.out, {k: v.copy() for k, v in sent.value.weights.items()})
        ids, bounds, size, total = [], [], 0, 0

        def learn() -> None:
            net.learn(np.concatenate(ids), np.concatenate([[0], *bounds]))

        for batch in batches:
            if not batch.num_rows:
                continue
            coded = coder.code(batch.column(0))
            ids.append(coded.ids)
            bounds.append(coded.bounds[1:] + size)
            size += len(coded.ids)
            if size >= LOAD:
                learn()
                ids, bounds, size, total = [], [], 0, total + size
        if size:
            learn()
            total += size
        if total:
            yield from part_rows(TaskContext.get().partitionId(), np.append(gated_net.flat(net.w).astype(np.float64) * total, total))

    found = summed(texts.mapInArrow(run, PARTS))
    sent.unpersist()
    return found


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[Model, DataFrame]:
    """The model of the rows that aren't held out, and their word counts (word, c)."""
    texts = docs.filter(~held_out(id_col)).select(F.col(f"`{text_col}`").alias("text"), F.pmod(F.xxhash64(F.col(f"`{id_col}`").cast("string"), f"`{text_col}`"), F.lit(ROUNDS)).alias("round"))
    counts = cut(word_counts(texts))
    words = vocabulary(counts, texts.count())
    model = Model(words, gated_net.fresh(words.layout()[0], gated_net.HIDDEN))
    for r in range(ROUNDS):
        found = _round(texts.filter(F.col("round") == r).select("text"), model)
        if len(found) and found[-1] > 0:
            model = Model(words, gated_net.shaped(found[:-1] / found[-1], model.weights))
    return model, counts


def _scored(docs: DataFrame, model: Model, keep: list[Column], text_col: str) -> DataFrame:
    """at (a row's number), row (what is kept of it), n_tokens, n_known, base, score without rare words; those, and how often each stands."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(sent.value.words)
        net = gated_net.Net(coder.out, sent.value.weights)
        at, held, size = TaskContext.get().partitionId() << 40, [], 0

        def rows() -> Iterator[pa.RecordBatch]:
            nonlocal at
            starts = np.cumsum([0, *[len(c.ids) for _, c in held]])
            ids = np.concatenate([c.ids for _, c in held])
            bounds = np.concatenate([c.bounds[:-1] + s for (_, c), s in zip(held, starts, strict=False)] + [starts[-1:]])
            found, done = net.score(ids, bounds) / np.log(10), 0
            for row, c in held:
                n = len(row)
                who = np.concatenate([x[0] for x in c.rare] or [np.zeros(0, dtype=np.int64)])
                order = np.argsort(who, kind="stable")
                names = pa.chunked_array([x[1] for x in c.rare], pa.string()).combine_chunks().take(pa.array(order))
                times = np.concatenate([x[2] for x in c.rare] or [np.zeros(0, dtype=np.int64)])[order].astype(np.int32)
                ends = pa.array(np.concatenate([[0], np.cumsum(np.bincount(who, minlength=n))]).astype(np.int32))
                columns = [pa.array(np.arange(at, at + n)), row, pa.array(np.diff(c.bounds)), pa.array(c.known), pa.array(c.base), pa.array(found[done : done + n] + c.share),
                           pa.ListArray.from_arrays(ends, names), pa.ListArray.from_arrays(ends, pa.array(times))]
                yield pa.RecordBatch.from_arrays(columns, names=["at", "row", "n_tokens", "n_known", "base", "score", "words", "times"])
                at, done = at + n, done + n

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append((batch.column(0), coder.code(batch.column(1))))
            size += len(held[-1][1].ids)
            if size >= LOAD:
                yield from rows()
                held, size = [], 0
        if held:
            yield from rows()

    given = docs.select(F.struct(*keep).alias("row"), F.col(f"`{text_col}`").alias("text"))
    fields = [("at", LongType()), ("row", given.schema["row"].dataType), ("n_tokens", LongType()), ("n_known", LongType()), ("base", DoubleType()), ("score", DoubleType()),
              ("words", ArrayType(StringType())), ("times", ArrayType(IntegerType()))]
    return given.mapInArrow(run, StructType([StructField(n, t) for n, t in fields]))


def score(docs: DataFrame, model: Model, counts: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row of docs; other columns don't matter.

    A null or empty text is one end. Repeated rows have a row each. Without rows to learn from, both scores are 0, as
    nothing is known: every text is one unseen word after another.
    """
    words = model.words
    _, _, _, _, rarest = words.layout()
    rows = cut(_scored(docs, model, [F.col(f"`{id_col}`").alias("id"), held_out(id_col).alias("held_out")], text_col))
    rare = rows.select("at", F.inline(F.arrays_zip("words", "times"))).withColumnRenamed("words", "word")
    log, times = F.log10(F.coalesce("c", F.lit(0)) + 1), F.col("times")
    met = rare.join(counts, "word", "left").groupBy("at").agg(
        F.sum(times * (log - F.log10(F.lit(float(words.tokens + words.distinct + 1))))).alias("more_base"),
        F.sum(times * (log - F.log10(F.lit(rarest)))).alias("more_score"), F.sum(F.when(F.col("c") > 0, times)).alias("more_known"))
    zero, some = F.lit(0.0), words.tokens > 0
    return rows.join(met, "at", "left").select(
        F.col("row.id").alias(id_col), F.col("row.held_out").alias("held_out"), "n_tokens", (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"), F.lit(words.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", zero) if some else zero).alias("base_score"), (F.col("score") + F.coalesce("more_score", zero) if some else zero).alias("score"))


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score(docs, *train(docs))
