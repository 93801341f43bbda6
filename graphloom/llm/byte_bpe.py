"""Byte-level BPE encoding and decoding with vectorised pre-tokenisation.

A text becomes an array of codepoint classes. Each class, with the class or letters that follow
where the pattern looks ahead, is a transition function on a few automaton states; functions
compose associatively, so prefix composition (blocked, whole arrays at a time) gives the state
before every codepoint, and state and class tell whether a piece starts there. No regex runs.
The slices then go through pair merging, cached by slice.
"""

from __future__ import annotations

import base64
import bisect
import functools
import hashlib
import heapq
import itertools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.llm._util import keep

# Codepoint classes.
OTHER, LETTER, NUMBER, SPACE, BLANK, QUOTE, END = range(7)
# Symbols: classes after lookahead. GLUE: a blank that joins the piece after it; LAST: another
# space before a non-space; GAP: a space followed by a space or by the end.
S_OTHER, S_LETTER, S_NUMBER, S_QUOTE1, S_QUOTE2, S_GLUE, S_LAST, S_GAP, S_END = range(9)
# States: nothing open, a blank to join, inside letters, numbers, others, one or two letters of a
# contraction to come, inside spaces.
NONE, JOIN, IN_L, IN_N, IN_O, ONE, TWO, IN_S = range(8)
#: Contraction letters after the quote; fixed values of the pattern.
SHORT, LONG = "stmd", ("re", "ve", "ll")

SENTINEL = 0x110000
BLOCK, COLUMNS = 1 << 20, 256
CACHE = 400_000


@functools.lru_cache(maxsize=1)
def class_table() -> bytes:
    """Compressed class of every codepoint, with the same Unicode version as the tokenizer library."""
    import tiktoken

    points = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    out = np.zeros(SENTINEL + 1, dtype=np.uint8)
    for pattern, kind in ((r"\p{L}", LETTER), (r"\p{N}", NUMBER), (r"\s", SPACE)):
        own = tiktoken.Encoding("class", pat_str=pattern, mergeable_ranks={bytes([i]): i for i in range(256)}, special_tokens={})
        found = bytes(own.encode_ordinary(points)).decode()
        out[np.frombuffer(found.encode("utf-32-le"), dtype=np.uint32)] = kind
    out[0x20], out[0x27], out[SENTINEL] = BLANK, QUOTE, END
    return zlib.compress(out.tobytes())


def _automaton() -> tuple[np.ndarray, np.ndarray]:
    """next[state, symbol] and starts[state, symbol]: does a piece start at the symbol."""
    step, starts = np.zeros((8, 9), dtype=np.uint8), np.ones((8, 9), dtype=bool)
    for symbol, state in ((S_OTHER, IN_O), (S_LETTER, IN_L), (S_NUMBER, IN_N), (S_QUOTE1, ONE), (S_QUOTE2, TWO),
                          (S_GLUE, JOIN), (S_LAST, NONE), (S_GAP, IN_S), (S_END, NONE)):
        step[:, symbol] = state
    for symbol in (S_QUOTE1, S_QUOTE2):  # a quote that continues a piece is no contraction
        step[[JOIN, IN_O], symbol] = IN_O
    for symbol, inside in ((S_OTHER, IN_O), (S_LETTER, IN_L), (S_NUMBER, IN_N), (S_QUOTE1, IN_O), (S_QUOTE2, IN_O)):
        starts[[JOIN, inside], symbol] = False
    step[TWO, S_LETTER], step[ONE, S_LETTER] = ONE, NONE
    starts[[ONE, TWO], S_LETTER] = False
    starts[IN_S, S_GAP] = False
    return step, starts


def _monoid(step: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All compositions of the symbols' functions: values[f, state], product[f, g] (f first), and each symbol's f."""
    identity = tuple(range(len(step)))
    symbols = [tuple(int(x) for x in step[:, s]) for s in range(step.shape[1])]
    found, todo = {identity: 0}, [identity]
    while todo:
        f = todo.pop()
        for g in symbols:
            h = tuple(g[x] for x in f)
            if h not in found:
                found[h] = len(found)
                todo.append(h)
    functions = list(found)
    product = np.array([[found[tuple(g[x] for x in f)] for g in functions] for f in functions], dtype=np.int32)
    return np.array(functions, dtype=np.uint8), product, np.array([found[s] for s in symbols], dtype=np.int32)


STEP, STARTS = _automaton()
VALUES, PRODUCT, SYMBOL = _monoid(STEP)


def scan(functions: np.ndarray) -> np.ndarray:
    """Inclusive prefix composition of an array of monoid elements."""
    n = len(functions)
    if n <= 1:
        return functions
    rows = -(-n // COLUMNS)
    grid = np.zeros(rows * COLUMNS, dtype=np.int32)
    grid[:n] = functions
    grid = np.ascontiguousarray(grid.reshape(rows, COLUMNS).T)
    flat, m = PRODUCT.ravel(), len(PRODUCT)
    for k in range(1, min(n, COLUMNS)):
        grid[k] = flat[grid[k - 1] * m + grid[k]]
    if rows > 1:
        before = scan(grid[-1][:-1])
        grid[:, 1:] = flat[before[None, :] * m + grid[:, 1:]]
    return grid.T.ravel()[:n]


def piece_starts(points: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Positions where a piece or a sentinel starts. points: codepoints, each text followed by SENTINEL."""
    out, state = [], NONE
    letter = {c: ord(c) for c in "stmdrevl"}
    for at in range(0, len(points), BLOCK):
        p = points[at : at + BLOCK + 2]
        n = min(BLOCK, len(points) - at)
        kind = classes[p]
        kind = np.concatenate([kind, np.full(max(0, n + 2 - len(kind)), END, dtype=np.uint8)])
        here, after = kind[:n], kind[1 : n + 1]
        symbol = np.array([S_OTHER, S_LETTER, S_NUMBER, S_GAP, S_GAP, S_OTHER, S_END], dtype=np.uint8)[here]
        last = ((here == SPACE) | (here == BLANK)) & (after != SPACE) & (after != BLANK) & (after != END)
        symbol[last] = np.where(here[last] == BLANK, S_GLUE, S_LAST)
        quotes = np.flatnonzero(here == QUOTE)
        if len(quotes):
            q = np.concatenate([p, np.full(2, SENTINEL, dtype=p.dtype)])
            first, second = q[quotes + 1], q[quotes + 2]
            symbol[quotes[np.isin(first, [letter[c] for c in SHORT])]] = S_QUOTE1
            for a, b in LONG:
                symbol[quotes[(first == letter[a]) & (second == letter[b])]] = S_QUOTE2
        states = VALUES[scan(SYMBOL[symbol]), state]
        before = np.concatenate([np.array([state], dtype=np.uint8), states[:-1]])
        out.append(at + np.flatnonzero(STARTS[before, symbol]))
        state = int(states[-1])
    return np.concatenate(out) if out else np.zeros(0, dtype=np.int64)


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Repeatedly joins the leftmost pair of least rank; n log n by a heap over linked parts."""
    if piece in ranks:
        return [ranks[piece]]
    n = len(piece)
    if n <= 48:
        parts = [piece[i : i + 1] for i in range(n)]
        worst = len(ranks) + 1
        while len(parts) > 1:
            each = [ranks.get(a + b, worst) for a, b in zip(parts, parts[1:], strict=False)]
            low = min(each)
            if low == worst:
                break
            k = each.index(low)
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        return [ranks[p] for p in parts]
    end, following, previous = list(range(1, n + 1)), list(range(1, n + 1)), list(range(-1, n - 1))
    alive, heap = [True] * n, []

    def offer(i: int) -> None:
        j = following[i]
        if j < n and (r := ranks.get(piece[i : end[j]])) is not None:
            heapq.heappush(heap, (r, i, end[i], end[j]))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, i, e, f = heapq.heappop(heap)
        if not alive[i] or end[i] != e or following[i] >= n or end[following[i]] != f:
            continue
        j = following[i]
        alive[j], end[i], following[i] = False, f, following[j]
        if following[i] < n:
            previous[following[i]] = i
        offer(i)
        if previous[i] >= 0:
            offer(previous[i])
    return [ranks[piece[i : end[i]]] for i in range(n) if alive[i]]


class Merger:
    """Merges many pieces at a time, and caches them.

    Pieces of one byte length form a matrix of ids. Each round joins the leftmost pair of least
    rank in every row, so rows stay equally long; rows without a pair are done.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.cache: dict[str, bytes] = {}
        self.bytes = np.array([ranks[bytes([i])] for i in range(256)], dtype=np.int64)
        self.base = 1 + max(ranks.values())
        pairs = {}
        for token, rank in ranks.items():
            for k in range(1, len(token)):
                x, y = ranks.get(token[:k]), ranks.get(token[k:])
                if x is not None and y is not None:
                    pairs[x * self.base + y] = rank
        self.keys = np.array(sorted(pairs), dtype=np.int64)
        self.values = np.array([pairs[k] for k in self.keys.tolist()], dtype=np.int64)

    def rank(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Rank of each pair's join; base if there is none."""
        key = x * self.base + y
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.values[at], self.base)

    def rounds(self, ids: np.ndarray, ranks: np.ndarray | None = None) -> list[bytes]:
        """ranks: of the pairs of ids, where known."""
        out: list[bytes] = [b""] * len(ids)
        rows = np.arange(len(ids))
        ranks = self.rank(ids[:, :-1], ids[:, 1:]) if ranks is None else ranks
        while len(rows):
            if ids.shape[1] > 1:
                at = ranks.argmin(axis=1)
                low = np.take_along_axis(ranks, at[:, None], axis=1)[:, 0]
                done = low == self.base
            else:
                done = np.ones(len(rows), dtype=bool)
            if done.any():
                width = 4 * ids.shape[1]
                flat = ids[done].astype("<u4").tobytes()
                for i, r in enumerate(rows[done].tolist()):
                    out[r] = flat[i * width : (i + 1) * width]
                if done.all():
                    break
                ids, ranks, rows, at, low = ids[~done], ranks[~done], rows[~done], at[~done], low[~done]
            each = np.arange(len(rows))
            columns = np.arange(ids.shape[1] - 1)
            ids = np.take_along_axis(ids, columns + (columns > at[:, None]), axis=1)
            ids[each, at] = low
            if len(columns) > 1:
                columns = columns[:-1]
                ranks = np.take_along_axis(ranks, columns + (columns >= at[:, None]), axis=1)
                left, right = np.flatnonzero(at > 0), np.flatnonzero(at < len(columns))
                ranks[left, at[left] - 1] = self.rank(ids[left, at[left] - 1], ids[left, at[left]])
                ranks[right, at[right]] = self.rank(ids[right, at[right]], ids[right, at[right] + 1])
            else:
                ranks = ranks[:, :0]
        return out

    def learn(self, pieces: set[str]) -> dict[str, bytes]:
        """The cache, with all of these pieces in it; emptied before it holds over CACHE others."""
        new = pieces - self.cache.keys()
        if len(self.cache) + len(new) > CACHE:
            self.cache, new = {}, pieces
        by_size: dict[int, tuple[list[str], list[bytes]]] = {}
        for piece in new:
            raw = piece.encode("utf-8", "surrogatepass")
            if raw in self.ranks:
                self.cache[piece] = self.ranks[raw].to_bytes(4, "little")
            elif len(raw) > 48:
                self.cache[piece] = np.array(merge(raw, self.ranks), dtype="<u4").tobytes()
            else:
                own = by_size.setdefault(len(raw), ([], []))
                own[0].append(piece)
                own[1].append(raw)
        for size, (own, raws) in by_size.items():
            ids = self.bytes[np.frombuffer(b"".join(raws), dtype=np.uint8).reshape(-1, size)]
            self.cache.update(zip(own, self.rounds(ids), strict=True))
        return self.cache


class ByteBPE:
    """Encoder and decoder for one rank file. classes: compressed class_table()."""

    def __init__(self, path: str, classes: bytes):
        self.ranks = load_ranks(path)
        self.classes = np.frombuffer(zlib.decompress(classes), dtype=np.uint8)
        self.merger = Merger(self.ranks)
        self.tokens = {i: t for t, i in self.ranks.items()}
        self.decoded: dict[bytes, bytes] = {}

    def pieces(self, texts: list[str]) -> list[tuple[list[int], list[str]]]:
        """Starts and slices of each text's pieces."""
        joined = np.frombuffer("\x00".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).copy()
        stops = np.cumsum([len(t) + 1 for t in texts]) - 1
        joined[stops] = SENTINEL
        starts = piece_starts(joined, self.classes)
        out, a, base = [], 0, 0
        for t, b, stop in zip(texts, np.searchsorted(starts, stops).tolist(), stops.tolist(), strict=True):
            own = (starts[a:b] - base).tolist()
            out.append((own, [t[i:j] for i, j in zip(own, [*own[1:], len(t)], strict=False)]))
            a, base = b + 1, stop + 1
        return out

    def encode(self, texts: list[str]) -> Iterator[tuple[list[bytes], list[int]]]:
        """Each piece's ids (little-endian 32-bit), and the pieces' starts in codepoints."""
        group, held = [], 0
        for k, text in enumerate(texts):
            group.append(text)
            held += len(text) + 1
            if held < BLOCK and k + 1 < len(texts):
                continue
            found = self.pieces(group)
            get = self.merger.learn(set().union(*(own for _, own in found))).__getitem__
            for starts, own in found:
                yield list(map(get, own)), starts
            group, held = [], 0

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))

    def decode_pieces(self, ids: bytes, tokens: list[int]) -> list[bytes]:
        """The bytes of each piece of ids, whose pieces begin at the tokens of these numbers; a piece seen before is looked up."""
        out, known = [], self.decoded
        for a, b in itertools.pairwise([*tokens, len(ids) >> 2]):
            own = ids[4 * a : 4 * b]
            if (text := known.get(own)) is None:
                if len(known) >= CACHE:
                    known.clear()
                text = known[own] = self.decode(own)
            out.append(text)
        return out


def _coder(path: str, classes: bytes) -> ByteBPE:
    return keep(("bytes", path), lambda: ByteBPE(path, classes))


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, ids array<int>, piece_starts array<int> (codepoints), piece_tokens array<int> (index of the first token of each piece).

    Null and empty texts have empty arrays. The pattern is the one of the rank file's family; special
    tokens are not recognised. Rows keep their number and repeats; other columns are not read.
    """
    classes = class_table()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(path, classes)
        for batch in batches:
            ids, starts, tokens = [], [], []
            for encoded, own in coder.encode([t or "" for t in batch.column(1).to_pylist()]):
                ids.append(np.frombuffer(b"".join(encoded), dtype="<i4"))
                starts.append(np.array(own, dtype=np.int32))
                sizes = np.array([len(x) >> 2 for x in encoded], dtype=np.int32)
                tokens.append((np.cumsum(sizes) - sizes).astype(np.int32))
            lists = [pa.array(x, type=pa.list_(pa.int32())) for x in (ids, starts, tokens)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *lists], names=["id", "ids", "piece_starts", "piece_tokens"])

    given = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    kind = given.schema["id"].dataType.simpleString()
    return given.mapInArrow(run, f"id {kind}, ids array<int>, piece_starts array<int>, piece_tokens array<int>")


def decode(encoded: DataFrame, path: str, start: int = 0, end: int | None = None) -> DataFrame:
    """id and text of the rows of `encode`, or of the codepoints from start to end of each text.

    The offsets kept by encode name the pieces that hold the codepoints asked for; only their ids are decoded.
    Bytes that aren't UTF-8 become replacement characters. Null ids or offsets count as empty.
    """
    classes = class_table()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(path, classes)
        for batch in batches:
            texts = []
            for ids, starts, tokens in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
                ids, starts, tokens = ids or [], starts or [], tokens or []
                a = max(0, bisect.bisect_right(starts, start) - 1)
                b = len(starts) if end is None else bisect.bisect_left(starts, end)
                own = tokens[a:b]
                stop = tokens[b] if b < len(tokens) else len(ids)
                first = own[0] if own else stop
                raw = np.array(ids[first:stop], dtype="<u4").tobytes()
                text = b"".join(coder.decode_pieces(raw, [t - first for t in own])).decode("utf-8", "replace") if own else ""
                base = starts[a] if own else start
                texts.append(text[max(0, start - base) : None if end is None else max(0, end - base)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["id", "text"])

    given = encoded.select("id", "ids", "piece_starts", "piece_tokens")
    return given.mapInArrow(run, f"id {given.schema['id'].dataType.simpleString()}, text string")


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_tokens, ids_sha256, decoded_sha256: encodes, decodes the ids again by the pieces' offsets and digests both, in one pass."""
    classes = class_table()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(path, classes)
        for batch in batches:
            n, ids, decoded = [], [], []
            for pieces, _ in coder.encode([t or "" for t in batch.column(1).to_pylist()]):
                encoded, tokens = b"".join(pieces), list(itertools.accumulate((len(x) >> 2 for x in pieces[:-1]), initial=0)) if pieces else []
                n.append(len(encoded) // 4)
                ids.append(hashlib.sha256(encoded).hexdigest())
                decoded.append(hashlib.sha256(b"".join(coder.decode_pieces(encoded, tokens))).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())],
                                             names=["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    given = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    return given.mapInArrow(run, f"id {given.schema['id'].dataType.simpleString()}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def query(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken")).withColumnRenamed("id", "doc_id")
