"""Phrase collocations by hierarchical pair naming.

Texts become chunks of unit numbers. On every level the distinct units of a chunk meet those of all chunks of the
corpus by buckets of their hash, which are shuffled compressed; frequent ones get one global id, and the ids go back to
the chunks that hold them; adjacent named units are
the units of the next level. A phrase of k words is so a pair of phrases of k-1 words, its parents, which give it
its words, the counts of all its first and last parts, and the shorter phrases that it holds.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from graphloom.llm._util import cut, release, shuffle_width
from graphloom.llm.word_codes import byte_table, words_of

#: Separators of words and of pieces; fixed values of the contract.
GAPS, BREAKS = b" \t", b".,;:!?\n\x0b\x0c\r"
#: Occurrences that make a candidate, words of the longest, share of occurrences in a longer candidate that drops it (in 100ths), and rows a language.
LEAST, LONGEST, SHARE, TOP = 100, 5, 100, 2000
#: Words of a chunk; the last block may go beyond, and so does a longer piece.
CHUNK = 1 << 20
#: A unit's handle: its chunk (task, chunk of the task) and its number there.
AT_BITS, SEQ_BITS = 30, 13
STATE = "chunk bigint, codes binary, held binary"
#: Units of a chunk go to this many buckets for each shuffle partition, compressed; one task sums a bucket at a time.
BUCKETS = 2
UNITS = "bucket int, chunk bigint, lang string, number binary, first binary, second binary, count binary"
NAMES = "chunk bigint, lang string, number binary, id binary, f binary, first binary, second binary"
#: Parts of one language's candidates that are ranked before all are.
SALTS = 64


def _pack(**arrays: np.ndarray | pa.Array) -> bytes:
    """Arrays of any lengths, compressed."""
    columns = [pa.array(a) if isinstance(a, np.ndarray) else a for a in arrays.values()]
    lists = [pa.LargeListArray.from_arrays(pa.array([0, len(c)], pa.int64()), c) for c in columns]
    batch = pa.RecordBatch.from_arrays(lists, names=list(arrays))
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _planes(a: np.ndarray) -> np.ndarray:
    """The first bytes of all numbers, then the second ones, ..., which compress better. -1 becomes 0."""
    return (np.ascontiguousarray(a) + a.dtype.type(1)).view(np.uint8).reshape(-1, a.dtype.itemsize).T.ravel()


def _joined(planes: np.ndarray, kind: type) -> np.ndarray:
    return np.ascontiguousarray(planes.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel() - kind(1)


def _unpack(held: bytes) -> dict[str, pa.Array]:
    batch = pa.ipc.open_stream(held).read_next_batch()
    return {name: batch.column(i).flatten() for i, name in enumerate(batch.schema.names)}


def _pairs(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lefts, rights and counts of the distinct pairs of adjacent codes, and of every place the number of the pair there, or -1."""
    n = int(codes.max(initial=-1)) + 1
    distinct, counts, at = _units(np.where((codes[:-1] >= 0) & (codes[1:] >= 0), codes[:-1].astype(np.int64) * n + codes[1:], -1))
    return distinct // max(n, 1), distinct % max(n, 1), counts, at


def _units(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct values from 0 on, how often each stands, and every place's number among them (-1 stays)."""
    real = codes >= 0
    distinct, number, counts = np.unique(codes[real], return_inverse=True, return_counts=True)
    at = np.full(len(codes), -1, dtype=np.int32)
    at[real] = number
    return distinct, counts.astype(np.int32), at


def _word_chunk(chunk: int, words: list[pa.Array], langs: list[np.ndarray], firsts: list[np.ndarray], names: list[str]) -> pa.RecordBatch:
    """Words by language, and their numbers in order with -1 between pieces."""
    coded = pa.chunked_array(words).combine_chunks().dictionary_encode()
    size = len(coded.dictionary)
    key = coded.indices.to_numpy()
    if len(names) > 1:
        key = np.concatenate(langs).astype(np.int64) * size + key
    if len(names) * size <= 16 * len(key):  # dense enough for a table
        bins = np.bincount(key, minlength=len(names) * size)
        distinct = np.flatnonzero(bins)
        counts, at = bins[distinct].astype(np.int32), (np.cumsum(bins > 0, dtype=np.int32) - 1)[key]
        del bins
    else:
        distinct, counts, at = _units(key)
    order = np.argsort(-counts, kind="stable")  # small numbers for frequent words
    rank = np.empty(len(order), dtype=np.int32)
    rank[order] = np.arange(len(order))
    distinct, counts, at = distinct[order], counts[order], rank[at]
    first = np.concatenate(firsts)
    codes = np.full(len(at) + int(first.sum()), -1, dtype=np.int32)
    codes[np.arange(len(at)) + np.cumsum(first)] = at
    held = _pack(word=coded.dictionary.take(pa.array(distinct % size)), lang=pa.array(names).take(pa.array(distinct // size)))
    return _rows([(chunk, _packed(codes), held)], STATE)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table, seq = byte_table(GAPS, BREAKS), TaskContext.get().partitionId() << SEQ_BITS
    words, langs, firsts, names, size = [], [], [], {}, 0
    for batch in batches:
        own = np.array([names.setdefault(x, len(names)) for x in batch.column(0).to_pylist()], dtype=np.int32)
        for block, text, first in words_of(batch.column(1), table):
            if size >= CHUNK and first[0]:
                yield _word_chunk(seq, words, langs, firsts, list(names))
                words, langs, firsts, size, seq = [], [], [], 0, seq + 1
                pa.default_memory_pool().release_unused()
            words.append(block)
            langs.append(own[text])
            firsts.append(first)
            size += len(block)
    if size:
        yield _word_chunk(seq, words, langs, firsts, list(names))


def _counted(codes: np.ndarray) -> np.ndarray:
    return np.bincount(codes[codes >= 0]).astype(np.int32)


def _lang_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of each language in a chunk."""
    for batch in batches:
        for codes, held in zip(batch.column(1), batch.column(2), strict=True):
            langs = _unpack(held.as_py())["lang"].dictionary_encode()
            sums = np.bincount(langs.indices.to_numpy(), weights=_counted(_numbers(codes.as_py(), np.int32)))
            yield _rows([(lang, int(n)) for lang, n in zip(langs.dictionary.to_pylist(), sums.tolist(), strict=True)], "lang string, count bigint")


def _packed(a: np.ndarray) -> bytes:
    return zstandard.compress(_planes(a).tobytes(), 1)


def _numbers(held: bytes, kind: type) -> np.ndarray:
    return _joined(np.frombuffer(zstandard.decompress(held), dtype=np.uint8), kind)


def _steps(numbers: np.ndarray) -> bytes:
    """Ascending numbers by their differences."""
    return _packed(np.diff(numbers, prepend=0).astype(np.int32))


def _mixed(a: np.ndarray) -> np.ndarray:
    """A hash of each number, unsigned."""
    a = a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (a ^ (a >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(16)


def _rows(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    fields = [f.split() for f in ddl.split(", ")]
    columns = list(zip(*rows, strict=True)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, (_, t) in zip(columns, fields, strict=True)], names=[n for n, _ in fields])


def _unit_rows(words: bool, buckets: int):
    """Rows UNITS of all units of a chunk: their numbers, keys and counts. A word's bucket follows its CRC-32."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, codes, held in zip(*batch.columns, strict=True):
                chunk, codes, out = chunk.as_py(), _numbers(codes.as_py(), np.int32), []
                if words:
                    count, got = _counted(codes), _unpack(held.as_py())
                    text = np.array(got["word"].cast(pa.large_binary()).to_pylist(), dtype=object)
                    langs = got["lang"].dictionary_encode()
                    kind, names = langs.indices.to_numpy(), langs.dictionary.to_pylist()
                    key = np.fromiter(map(zlib.crc32, text), dtype=np.int64, count=len(text)) % buckets * len(names) + kind
                else:
                    ids = _numbers(held.as_py(), np.int64)
                    left, right, count, _ = _pairs(codes)
                    left, right = ids[left], ids[right]
                    key = (_mixed(left) + _mixed(right + 1) * np.uint64(31)) % np.uint64(buckets)
                order = np.argsort(key, kind="stable")
                cuts = np.flatnonzero(np.diff(key[order])) + 1
                for part in np.split(order, cuts) if len(order) else []:
                    at = int(key[part[0]])
                    if words:
                        row = (at // len(names), chunk, names[at % len(names)], _steps(part), zstandard.compress(b"\n".join(text[part]), 1), None, _packed(count[part]))
                    else:
                        row = (at, chunk, None, _steps(part), _packed(left[part]), _packed(right[part]), _packed(count[part]))
                    out.append(row)
                yield _rows(out, UNITS)

    return run


def _named(words: bool, least: int):
    """Names the frequent units of a bucket: rows NAMES, one for each chunk that holds any. f and keys are of units that gave their id."""
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("chunk")
        chunks = rows["chunk"].to_pylist()
        numbers = [np.cumsum(_numbers(x.as_py(), np.int32)) for x in rows["number"]]
        sizes = np.array([len(x) for x in numbers])
        if words:
            texts = pa.array([w for x in rows["first"] for w in zstandard.decompress(x.as_py()).split(b"\n")], pa.binary()).dictionary_encode()
            langs = rows["lang"].combine_chunks().dictionary_encode().indices.to_numpy()
            codes = np.repeat(langs, sizes).astype(np.int64) * len(texts.dictionary) + texts.indices.to_numpy()
        else:
            keys = [np.concatenate([_numbers(x.as_py(), np.int64) for x in rows[c]]) for c in ("first", "second")]
            left, right = (np.unique(k, return_inverse=True)[1] for k in keys)
            codes = left.astype(np.int64) * (int(right.max()) + 1) + right
        handles = np.repeat(np.array(chunks, dtype=np.int64) << AT_BITS, sizes) + np.concatenate(numbers)
        counts = np.concatenate([_numbers(x.as_py(), np.int32) for x in rows["count"]])
        order = np.lexsort((handles, codes))
        starts = np.flatnonzero(np.concatenate([[True], np.diff(codes[order]) != 0]))
        f = np.add.reduceat(counts[order].astype(np.int64), starts)
        spread = np.diff(np.append(starts, len(order)))
        each = np.empty(len(order), dtype=np.int64)
        each[order] = np.repeat(f, spread)
        ids = np.empty(len(order), dtype=np.int64)
        ids[order] = np.repeat(handles[order][starts], spread)
        out, ends, langs = [], np.cumsum(sizes), rows["lang"].to_pylist()
        for i, end in enumerate(ends.tolist()):
            own = slice(end - int(sizes[i]), end)
            keep = each[own] >= least
            if keep.any():
                here = keep & (ids[own] == handles[own])
                if words:
                    first, second = zstandard.compress(b"\n".join(texts.take(pa.array(np.flatnonzero(here) + own.start)).to_pylist()), 1), None
                else:
                    first, second = (_packed(k[own][here]) for k in keys)
                out.append((chunks[i], langs[i], _steps(numbers[i][keep]), _packed(ids[own][keep]), _packed(each[own][here]), first, second))
        return pa.Table.from_batches([_rows(out, NAMES)])

    return run


def _next_level(words: bool):
    """Puts the names in the place of units: (chunk, codes, held, and what is named here). Codes that no other is beside are gone."""
    def run(key: tuple, states: pa.Table, names: pa.Table) -> pa.Table:
        chunk = key[0].as_py()
        number, ids, fresh = [], [], {"id": [], "f": [], **({"lang": [], "word": []} if words else {"left": [], "right": []})}
        for row in names.to_pylist():
            number.append(np.cumsum(_numbers(row["number"], np.int32)))
            ids.append(_numbers(row["id"], np.int64))
            own = ids[-1][ids[-1] == (chunk << AT_BITS) + number[-1]].tolist()
            fresh["id"] += own
            fresh["f"] += _numbers(row["f"], np.int64).tolist()
            if words and own:
                fresh["word"] += zstandard.decompress(row["first"]).decode("utf-8", "surrogatepass").split("\n")
                fresh["lang"] += [row["lang"]] * len(own)
            elif not words:
                fresh["left"] += _numbers(row["first"], np.int64).tolist()
                fresh["right"] += _numbers(row["second"], np.int64).tolist()
        codes = held = b""
        if number:
            number, ids = np.concatenate(number), np.concatenate(ids)
            order = np.argsort(number)
            at = _numbers(states["codes"][0].as_py(), np.int32)
            at = at if words else _pairs(at)[3]
            code = np.full(int(at.max(initial=-1)) + 2, -1, dtype=np.int32)  # the last is what -1 finds
            code[number[order]] = np.arange(len(number))
            new = code[at]
            real = new >= 0
            beside = np.zeros(len(new) + 2, dtype=bool)
            beside[:-2] |= real
            beside[2:] |= real
            real &= beside[1:-1]
            new = np.where(real, new, -1)[real | np.concatenate([[True], real[:-1]])]  # one -1 of a run
            if (new >= 0).any():
                codes, held = _packed(new), _packed(ids[order])
        made = _rows([(chunk, codes, held)], STATE)
        kinds = {"id": pa.int64(), "f": pa.int64(), "lang": pa.string(), "word": pa.string(), "left": pa.int64(), "right": pa.int64()}
        lists = {c: pa.array([v], pa.list_(kinds[c])) for c, v in fresh.items()}
        return pa.table({**{c: made[c] for c in made.schema.names}, **lists})

    return run


def _level(state: DataFrame, keys: list[str], kind: str, least: int) -> DataFrame:
    words = "word" in keys
    units = state.mapInArrow(_unit_rows(words, BUCKETS * shuffle_width(state.sparkSession)), UNITS)
    names = units.groupBy("bucket").applyInArrow(_named(words, least), NAMES)
    lists = ", ".join(f"{c} array<{t}>" for c, t in [("id", "bigint"), ("f", "bigint"), *[(k, kind) for k in keys]])
    return cut(state.select("chunk", "codes").groupBy("chunk").cogroup(names.groupBy("chunk")).applyInArrow(_next_level(words), f"{STATE}, {lists}"))


def _entries(level: DataFrame, keys: list[str]) -> DataFrame:
    return level.select(F.inline(F.arrays_zip("id", *keys, "f")))


def levels(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = LEAST, longest: int = LONGEST) -> tuple[DataFrame, list[DataFrame]]:
    """(lang, n), and for each number of words the frequent phrases.

    A phrase has id, lang, phrase, last (its last word), f, starts and ends: how often its first 1, 2, ... words stand,
    and its last ones; from two words on, left and right: the ids of the phrases without its last and first word.
    """
    texts = docs.select(F.coalesce(F.col(f"`{lang_col}`"), F.lit("und")).alias("lang"), F.col(f"`{text_col}`").alias("text"))
    state = cut(texts.mapInArrow(_chunks, STATE))
    totals = cut(state.mapInArrow(_lang_rows, "lang string, count bigint").groupBy("lang").agg(F.sum("count").alias("n")))
    keys, kind, found = ["lang", "word"], "string", []
    for k in range(1, longest + 1):
        level = _level(state, keys, kind, least)
        entries = _entries(level, keys)
        if k == 1:
            known = entries.select("id", "lang", F.col("word").alias("phrase"), F.col("word").alias("last"), "f", F.array("f").alias("starts"), F.array("f").alias("ends"))
        else:
            a = found[-1].select(F.col("id").alias("left"), "lang", "phrase", "starts")
            b = found[-1].select(F.col("id").alias("right"), "last", "ends")
            both = entries.join(a, "left").join(b, "right")
            known = both.select("id", "left", "right", "lang", F.concat_ws(" ", "phrase", "last").alias("phrase"), "last", "f",
                                F.concat("starts", F.array("f")).alias("starts"), F.concat("ends", F.array("f")).alias("ends"))
        found.append(cut(known))
        state, keys, kind = level.select("chunk", "codes", "held").filter(F.length("held") > 0), ["left", "right"], "bigint"
        del level, entries, known
        release(docs.sparkSession)
    return totals, found


#: The cut of least score, then fewest first words. Decimals of 38 digits hold 1000*a*n and l*r for counts up to 10**16.
CUT = """array_min(transform(sequence(1, size(starts) - 1), k -> named_struct(
    'score', (1000 * cast(f as decimal(17, 0)) * cast(n as decimal(17, 0))) div (cast(starts[k - 1] as decimal(19, 0)) * cast(ends[size(ends) - k - 1] as decimal(19, 0))),
    'k', k, 'l', starts[k - 1], 'r', ends[size(ends) - k - 1])))"""


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = LEAST, longest: int = LONGEST, share: int = SHARE, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's best phrases.

    A null or empty text has no words, and a null language is `und`; repeated rows count as often as they stand.
    No words or no candidates: no rows. Words may hold any character but separators, the NUL among them.
    """
    totals, found = levels(docs, lang_col, text_col, least, longest)
    kept = []
    for k in range(2, longest + 1):
        own = found[k - 1].select("id", "lang", "phrase", "f", "starts", "ends")
        if k < longest:  # a longer phrase that holds this one occurs no more often than one longer by a word
            longer = found[k].select(F.explode(F.array("left", "right")).alias("id"), F.col("f").alias("g")).groupBy("id").agg(F.max("g").alias("g"))
            own = own.join(longer, "id", "left").filter(F.coalesce(100 * F.col("g") < share * F.col("f"), F.lit(True)))
        kept.append(own.select("lang", "phrase", "f", "starts", "ends"))
    scored = reduce(DataFrame.unionByName, kept).join(F.broadcast(totals) if _few(totals) else totals, "lang").withColumn("c", F.expr(CUT))
    rows = scored.select("lang", "phrase", F.col("f").alias("a"), F.col("c.l").alias("l"), F.col("c.r").alias("r"), "n", F.col("c.score").alias("score"))
    order = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    best = rows.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    best = best.withColumn("rank", F.row_number().over(W.partitionBy("lang", "salt").orderBy(*order))).filter(F.col("rank") <= top)
    best = best.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    return best.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def _few(totals: DataFrame) -> bool:
    """Whether the languages are few enough to be broadcast (under 8 MB)."""
    return len(totals.select("lang").limit(100_001).collect()) <= 100_000


def query(spark, sf_dir: str) -> DataFrame:
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SQL = f"""
WITH pieces AS (
  SELECT d.lang, d.row, unnest(generate_series(1, len(d.parts))) AS piece, unnest(d.parts) AS part
  FROM (SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS row,
               string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?\\x0A-\\x0D]') AS parts FROM documents) d),
words AS (SELECT lang, list_filter(string_split_regex(part, '[\\x20\\x09]'), lambda w: w <> '') AS ws FROM pieces),
filled AS (SELECT lang, ws FROM words WHERE len(ws) > 0),
totals AS (SELECT lang, sum(len(ws))::HUGEINT AS n FROM filled GROUP BY lang),
grams AS (
  SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase
  FROM (SELECT lang, ws, k, unnest(generate_series(1, len(ws) - k + 1)) AS i FROM filled, (SELECT unnest([1, 2, 3, 4, 5]) AS k) WHERE len(ws) >= k)),
f AS (SELECT lang, k, phrase, count(*)::HUGEINT AS a FROM grams GROUP BY ALL HAVING count(*) >= 100),
cand AS (SELECT * FROM f WHERE k >= 2),
cuts AS (
  SELECT c.*, j, array_to_string(string_split(phrase, ' ')[1:j], ' ') AS head, array_to_string(string_split(phrase, ' ')[j + 1:], ' ') AS rest
  FROM (SELECT *, unnest(generate_series(1, k - 1)) AS j FROM cand) c),
scored AS (
  SELECT c.lang, c.k, c.phrase, c.a, x.a AS l, y.a AS r, t.n, (1000 * c.a * t.n) // (x.a * y.a) AS score, c.j
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = c.head AND x.k = c.j JOIN f y ON y.lang = c.lang AND y.phrase = c.rest AND y.k = c.k - c.j
  JOIN totals t ON t.lang = c.lang),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
parts AS (
  SELECT DISTINCT lang, array_to_string(string_split(phrase, ' ')[i:i + m - 1], ' ') AS phrase, a
  FROM (SELECT *, unnest(generate_series(1, k - m + 1)) AS i FROM (SELECT *, unnest(generate_series(2, k - 1)) AS m FROM cand WHERE k >= 3))),
held AS (SELECT lang, phrase, max(a) AS g FROM parts GROUP BY ALL),
left_over AS (SELECT b.* FROM best b LEFT JOIN held h ON h.lang = b.lang AND h.phrase = b.phrase WHERE h.g IS NULL OR 100 * h.g < 100 * b.a)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase::BLOB) AS rank FROM left_over) WHERE rank <= 2000
"""
