"""Best-fit packing after Martello-Toth dominance reduction.

Piece lengths are integers up to the sequence length, so an instance of any size is a histogram of
at most that many sizes. The reduction and the best fit run on the histogram, many equal pieces at
a time; the driver holds sizes and groups of equal sequences, never pieces. Pieces then find their
place by their rank among those of their size.
"""

from __future__ import annotations

import bisect
import itertools
import json
import os
import re
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from graphloom.llm._util import cut, hand_back, keep
from graphloom.llm.byte_bpe import Merger

#: Words in one generation of a worker's cache of parts (some 150 bytes each), and words that a worker knows (some 50 bytes each).
CACHE, KNOWN = 250_000, 600_000
#: Characters that Python's split takes for white space and the tokenizer doesn't.
NOT_SPACE = "\x1c\x1d\x1e\x1f"
#: Words of letters whose class and lower case all versions of Unicode agree on, and closing marks, which are one piece; no
#: apostrophe, as it may begin another.
PLAIN = re.compile(r"^(?:([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)|.+)$", re.MULTILINE)
PLAIN_PART = re.compile("[a-zß-öø-ÿ]+")
#: Characters of the longest plain word that is merged here, and of texts that are encoded at a time.
PLAIN_SIZE, LOAD = 48, 1 << 23


class Recent:
    """A bounded cache of two generations: entries used since the last turn stay when it is full, the others go."""

    def __init__(self, compute):
        self.compute = compute
        self.now: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    def learn(self, keys: set[str]) -> dict[str, bytes]:
        """A dictionary that holds all of these keys."""
        new = keys - self.now.keys()
        if len(self.now) + len(new) > CACHE:
            self.now, self.before, new = {}, self.now, keys
        held = new & self.before.keys()
        self.now.update((k, self.before[k]) for k in held)
        fresh = list(new - held)
        self.now.update(zip(fresh, self.compute(fresh), strict=True))
        return self.now


class WordMerger(Merger):
    """Pair merging of plain words by the tokenizer's own vocabulary and merges, many words at a time.

    Needs what holds for such files: a merge's token has an id above those of all earlier merges, so that ids
    rank pairs.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab, suffix = model["vocab"], model["end_of_word_suffix"]
        shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]  # bytes that byte-level vocabularies write as themselves
        other = iter(range(256, 512))
        letters = [chr(b) if b in shown else chr(next(other)) for b in range(256)]
        self.bytes, self.last = (np.array([vocab[c + end] for c in letters], dtype=np.int64) for end in ("", suffix))
        self.base = 1 + max(vocab.values())
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        made = [vocab[a + b] for a, b in merges]
        if any(x >= y for x, y in itertools.pairwise(made)):
            raise ValueError("ids don't rank the merges")
        pairs = {vocab[a] * self.base + vocab[b]: i for (a, b), i in zip(merges, made, strict=True)}
        self.keys = np.array(sorted(pairs), dtype=np.int64)
        self.values = np.array([pairs[k] for k in self.keys.tolist()], dtype=np.int64)
        self.of_bytes, self.of_last = (self.rank(self.bytes[:, None], second[None, :]).ravel() for second in (self.bytes, self.last))

    def merge_all(self, words: list[str]) -> list[bytes]:
        out, by_size = [b""] * len(words), defaultdict(list)
        for i, w in enumerate(words):
            by_size[len(w) if w.isascii() else len(w.encode())].append(i)
        for size, at in by_size.items():
            raw = np.frombuffer("".join(words[i] for i in at).encode(), dtype=np.uint8).reshape(-1, size)
            ids = self.bytes[raw]
            ids[:, -1] = self.last[raw[:, -1]]
            pair = raw[:, :-1] * np.intp(256) + raw[:, 1:]
            ranks = self.of_bytes[pair]
            ranks[:, -1:] = self.of_last[pair[:, -1:]]
            for i, x in zip(at, self.rounds(ids, ranks), strict=True):
                out[i] = x
        return out


class WordTokens:
    """ids of texts by a tokenizer that drops white space and so works word by word."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.own = Tokenizer.from_file(path)
        self.merger = WordMerger(path)
        self.parts = Recent(self._parts)
        self.forget()

    def forget(self) -> None:
        """Known words, all their ids one after another, and the first and the number of each word's. The empty word has none."""
        self.known, self.ids = pa.array([""], pa.string()), np.zeros(0, dtype="<u4")
        self.starts, self.counts = np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64)

    def whole(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.own.encode_batch_fast(texts, add_special_tokens=False)]

    def _parts(self, parts: list[str]) -> list[bytes]:
        """Plain words by pair merging; all others by the library."""
        plain = [p for p in parts if len(p) <= PLAIN_SIZE and PLAIN_PART.fullmatch(p)]
        known = dict(zip(plain, self.merger.merge_all(plain), strict=True))
        other = [p for p in parts if p not in known]
        known.update(zip(other, self.whole(other), strict=True))
        return [known[p] for p in parts]

    def _words(self, words: list[str]) -> list[bytes]:
        """Forms that differ in case or closing marks share one call of the tokenizer, which folds case and splits marks off."""
        found = PLAIN.findall("\n".join(words))
        heads = [a.lower() if a else w for (a, _), w in zip(found, words, strict=True)]
        marks = {m for _, m in found if m}
        get = self.parts.learn({*heads, *marks}).__getitem__
        ends = {"": b"", **{m: get(m) for m in marks}}
        return [get(h) + ends[m] for h, (_, m) in zip(heads, found, strict=True)]

    def places(self, words: pa.Array) -> np.ndarray:
        """Where each of these distinct words stands among the known ones, which hold them all afterwards."""
        if len(self.known) + len(words) > KNOWN:
            self.forget()
        at = pc.index_in(words, value_set=self.known)
        if at.null_count:
            new = words.filter(at.is_null())
            ids = self._words(new.to_numpy(zero_copy_only=False).tolist())
            counts = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) // 4
            at = at.to_numpy(zero_copy_only=False)
            missing = np.isnan(at)
            at[missing] = len(self.known) + np.arange(len(ids))
            self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(counts) - counts])
            self.counts, self.ids = np.concatenate([self.counts, counts]), np.concatenate([self.ids, np.frombuffer(b"".join(ids), dtype="<u4")])
            self.known = pa.concat_arrays([self.known, new])
            return at.astype(np.int64)
        return at.to_numpy()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each distinct word of the texts is looked up once; ids of texts are gathered whole arrays at a time."""
        odd = {k for k, t in enumerate(texts) if any(c in t for c in NOT_SPACE)}
        split = pc.utf8_split_whitespace(pa.array(["" if k in odd else t for k, t in enumerate(texts)], pa.string()))
        coded = split.flatten().dictionary_encode()
        at = self.places(coded.dictionary)[coded.indices.to_numpy()]
        counts = self.counts[at]
        ends = np.cumsum(counts)
        own = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[at] - (ends - counts), counts)
        bounds = np.concatenate([[0], ends])[split.offsets.to_numpy()].tolist()
        ids = self.ids[own]
        return [self.whole([t])[0] if k in odd else ids[a:b].tobytes() for k, (t, (a, b)) in enumerate(zip(texts, itertools.pairwise(bounds), strict=True))]


def pieces(docs: DataFrame, path: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text",
           with_ids: bool = False) -> DataFrame:
    """Documents as token pieces: id, piece, start, length, ids_crc32 and, if asked for, ids.

    A document is its ids and the end id; only one longer than the capacity is cut. Null and empty
    texts are the end id alone.
    """
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = keep(("words", path), lambda: WordTokens(path))
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            at, rows = 0, []
            while at < len(texts):  # some million characters at a time, as merging words takes many short steps
                upto, held = at, 0
                while upto < len(texts) and (upto == at or held + len(texts[upto]) < LOAD):
                    held += len(texts[upto])
                    upto += 1
                for k, ids in enumerate(tokens.encode(texts[at:upto]), at):
                    ids += end
                    for p, b in enumerate(range(0, len(ids), 4 * capacity)):
                        own = ids[b : b + 4 * capacity]
                        rows.append((k, p, b // 4, len(own) // 4, zlib.crc32(own), own if with_ids else None))
                at = upto
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 6
            arrays = [batch.column(0).take(pa.array(cols[0], pa.int64())), pa.array(cols[1], pa.int32()), *[pa.array(c, pa.int64()) for c in cols[2:5]]]
            names = ["id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                arrays.append(pa.array([np.frombuffer(x, dtype="<i4") for x in cols[5]], type=pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names=names)
        hand_back()

    given = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    kind = given.schema["id"].dataType.simpleString()
    return given.mapInArrow(run, f"id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids array<int>" * with_ids)


class Plan:
    """Groups of equal sequences: [count, contents], contents being (size, how many)."""

    def __init__(self) -> None:
        self.groups: list[list] = []

    def add(self, count: int, contents: list[tuple[int, int]]) -> None:
        if count:
            self.groups.append([count, contents])


def _smallest(left: dict[int, int], sizes: list[int], big: int, k: int) -> list[int]:
    """The k smallest pieces beside one of `big`, or as many as there are."""
    out: list[int] = []
    for s in sizes:
        out += [s] * min(k - len(out), left[s] - (s == big))
        if len(out) == k:
            break
    return out


def _largest(left: dict[int, int], sizes: list[int], room: int, used: tuple[int, ...]) -> int:
    """The largest piece that fits into room beside those used; 0 if none does."""
    k = bisect.bisect_right(sizes, room) - 1
    while k >= 0 and left[sizes[k]] <= used.count(sizes[k]):
        k -= 1
    return sizes[k] if k >= 0 else 0


def _dominating(left: dict[int, int], sizes: list[int], big: int, capacity: int) -> tuple[int, ...] | None:
    """A set of one to three pieces with `big` that dominates every other set with it, if one is found.

    A set dominates another if each piece of the other, or some of them together, fit in the place of a piece of
    the set. Nothing fits beside: the piece alone. The largest that fits fills the sequence, or no two others fit:
    that pair. Where two others fit at most: the pair too, if no two others are larger together than the largest
    that fits; else the largest and the largest beside both, if that is no less than the lesser of any two that fit.
    """
    room = capacity - big
    mate = _largest(left, sizes, room, (big,))
    if not mate:
        return (big,)
    few = _smallest(left, sizes, big, 3)
    if mate == room or len(few) < 2 or sum(few[:2]) > room:
        return (big, mate)
    if len(few) == 3 and sum(few) <= room:
        return None
    best, lesser = _best_two(left, sizes, big, room)
    if best <= mate:
        return (big, mate)
    third = _largest(left, sizes, room - mate, (big, mate))
    return (big, mate, third) if third and third >= lesser else None


def reduce_dominated(left: dict[int, int], capacity: int, plan: Plan) -> None:
    """Fixes dominating sets, largest piece first, as often as their pieces allow; left is shrunk in place.

    Fixing a set only takes pieces away, so its copies stay dominating while all of its sizes are left. Some
    optimal packing holds all fixed sets.
    """
    sizes = sorted(s for s, n in left.items() if n)
    for big in reversed(sizes):
        while left[big]:
            found = _dominating(left, sizes, big, capacity)
            if found is None:
                break
            parts = [(s, found.count(s)) for s in dict.fromkeys(found)]
            take = min(left[s] // k for s, k in parts)
            plan.add(take, parts)
            for s, k in parts:
                left[s] -= take * k


def _best_two(left: dict[int, int], sizes: list[int], big: int, room: int) -> tuple[int, int]:
    """Of all two further pieces that fit into room together: the largest sum, and the largest lesser piece; zeros if none do."""
    best, lesser, i, j = 0, 0, 0, len(sizes) - 1
    have = lambda s: left[s] - (s == big)
    while i <= j:
        s, t = sizes[i], sizes[j]
        if have(s) < 1 or (i == j and have(s) < 2):
            i += 1
        elif have(t) < 1 or s + t > room:
            j -= 1
        else:
            best, lesser = max(best, s + t), max(lesser, s)
            i += 1
    return best, lesser


def best_fit(left: dict[int, int], capacity: int, plan: Plan) -> None:
    """Best fit, largest sizes first, of all that is left; equal pieces and equal sequences together."""
    open_: dict[int, list[list]] = {}
    rooms: list[int] = []

    def put(room: int, group: list) -> None:
        if room not in open_:
            open_[room] = []
            bisect.insort(rooms, room)
        open_[room].append(group)

    for size in sorted((s for s, n in left.items() if n), reverse=True):
        n = left[size]
        while n:
            k = bisect.bisect_left(rooms, size)
            if k == len(rooms):
                per = min(capacity // size, n)
                full = n // per
                put(capacity - per * size, [full, [(size, per)]])
                n -= full * per
                continue
            room = rooms[k]
            group = open_[room][-1]
            per = min(room // size, n)
            used = min(group[0], n // per)
            if used == group[0]:
                open_[room].pop()
                if not open_[room]:
                    del open_[room]
                    rooms.pop(k)
            else:
                group[0] -= used
            put(room - per * size, [used, [*group[1], (size, per)]])
            n -= used * per
        left[size] = 0
    for groups in open_.values():
        for count, contents in groups:
            plan.add(count, contents)


def _fullest(left: dict[int, int], room: int) -> list[tuple[int, int]]:
    """(size, how many) of the pieces left that fill room best: reachable sums are the bits of an integer."""
    within, reach, steps = (1 << room + 1) - 1, 1, []
    for size in sorted((s for s, n in left.items() if n and s <= room), reverse=True):
        n, part = min(left[size], room // size), 1
        while n:
            part = min(part, n)
            steps.append((reach, size, part))
            reach |= reach << size * part & within
            if reach >> room:
                break
            n, part = n - part, 2 * part
        if reach >> room:
            break
    total, out = reach.bit_length() - 1, {}
    for before, size, part in reversed(steps):
        if not before >> total & 1:
            out[size] = out.get(size, 0) + part
            total -= size * part
    return list(out.items())


def fill(left: dict[int, int], capacity: int, plan: Plan) -> None:
    """Best fit of sets: the largest piece left, with the pieces that fill its sequence best, as often as they allow."""
    for big in sorted((s for s, n in left.items() if n), reverse=True):
        while left[big]:
            left[big] -= 1
            beside = dict(_fullest(left, capacity - big))
            left[big] += 1
            beside[big] = beside.get(big, 0) + 1
            take = min(left[s] // k for s, k in beside.items())
            plan.add(take, sorted(beside.items(), reverse=True))
            for s, k in beside.items():
                left[s] -= take * k


def solve(histogram: dict[int, int], capacity: int) -> list[list]:
    """Groups [count, [(size, how many), ...]] that hold every piece of the histogram.

    Reduction, then best fit; if that needs more sequences than the pieces left fill, also best fit of sets, and
    the fewer of both.
    """
    plan, left = Plan(), dict(histogram)
    reduce_dominated(left, capacity, plan)
    ways = []
    for way in (best_fit, fill):
        own = Plan()
        way(dict(left), capacity, own)
        ways.append(own.groups)
        if sum(n for n, _ in own.groups) <= -(-sum(s * n for s, n in left.items()) // capacity):
            break
    return plan.groups + min(ways, key=lambda groups: sum(n for n, _ in groups))


def segments(groups: list[list]) -> list[tuple[int, int, int, int, int, int]]:
    """(size, first rank, after the last rank, first sequence, pieces of the size in each, offset of the first of them)."""
    out, ranks, base = [], {}, 0
    for count, contents in groups:
        offset = 0
        for size, per in contents:
            r = ranks.get(size, 0)
            out.append((size, r, r + count * per, base, per, offset))
            ranks[size] = r + count * per
            offset += per * size
        base += count
    return out


def pack(items: DataFrame, capacity: int = 2048) -> DataFrame:
    """items (a column length between 1 and the capacity, any others) with sequence_id and offset.

    Every row is placed once; no sequence holds more than the capacity, without gaps. Rows that are
    alike in all columns get places of their own. Columns named like the two are replaced. An empty table gives an empty one. The driver sees
    one count per size (at most `capacity`); groups and segments are fewer than a few per size.
    """
    spark = items.sparkSession
    fixed = cut(items).withColumn("__part", F.spark_partition_id())  # partitions of a checkpoint don't change
    parts = cut(fixed.groupBy("length", "__part").agg(F.count("*").alias("n")))
    histogram = {r["length"]: r["n"] for r in parts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    rows = segments(solve(histogram, capacity))
    schema = "__s_size bigint, __s_from bigint, __s_to bigint, __s_base bigint, __s_per bigint, __s_offset bigint"
    places = spark.createDataFrame(rows, schema)
    before = parts.select(F.col("length").alias("__b_length"), F.col("__part").alias("__b_part"), (F.sum("n").over(
        W.partitionBy("length").orderBy("__part").rowsBetween(W.unboundedPreceding, -1))).alias("__before"))
    order = [c for c in ("id", "piece") if c in items.columns] or ["length"]
    ranked = fixed.withColumn("__rank", F.row_number().over(W.partitionBy("length", "__part").orderBy(*order)) - 1)
    ranked = ranked.join(before, (F.col("length") == F.col("__b_length")) & (F.col("__part") == F.col("__b_part")))
    ranked = ranked.withColumn("__rank", F.col("__rank") + F.coalesce("__before", F.lit(0)))
    placed = ranked.join(F.broadcast(places), (F.col("length") == F.col("__s_size")) & (F.col("__rank") >= F.col("__s_from")) & (F.col("__rank") < F.col("__s_to")))
    nth = F.col("__rank") - F.col("__s_from")
    return placed.select(*[F.col(f"`{c}`") for c in items.columns if c not in ("sequence_id", "offset")], (F.col("__s_base") + F.floor(nth / F.col("__s_per"))).alias("sequence_id"),
                         (F.col("__s_offset") + (nth % F.col("__s_per")) * F.col("length")).alias("offset"))


def query(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = pack(pieces(docs, public_tokenizers.path("word_bpe_49k.json")))
    return out.withColumnRenamed("id", "doc_id")
