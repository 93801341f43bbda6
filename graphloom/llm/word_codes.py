"""Words of many texts as Arrow arrays, cut from their bytes in blocks of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled at a time; only a single longer word makes a block longer.
BLOCK_BYTES = 1 << 20
GAP, BREAK = ord(" "), ord("\n")


def byte_table(gaps: bytes, breaks: bytes = b"") -> bytes:
    """Lower-cases A-Z; makes word separators GAP and piece separators BREAK."""
    table = bytearray(range(256))
    for b in range(65, 91):
        table[b] = b + 32
    for b in gaps:
        table[b] = GAP
    for b in breaks:
        table[b] = BREAK
    return bytes(table)


def _cut(data: memoryview, at: int, end: int, table: bytes) -> int:
    """The first position from `at` on that holds no word's byte; else the end."""
    for low in range(at, end, 1 << 16):
        part = bytes(data[low : min(low + (1 << 16), end)]).translate(table)
        found = [i for i in (part.find(b" "), part.find(b"\n")) if i >= 0]
        if found:
            return low + min(found)
    return end


def words_of(texts: pa.Array, table: bytes) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """Blocks of (words, number of each word's text, whether the word starts a piece). A null text has no words."""
    texts = texts.fill_null("") if texts.null_count else texts
    _, offsets, data = texts.buffers()
    if not len(texts) or data is None:
        return
    width = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    ends = np.frombuffer(offsets, dtype=width)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data, at, stop = memoryview(data), int(ends[0]), int(ends[-1])
    pieces, last = 0, (-1, -1)
    while at < stop:
        cut = stop
        if at + BLOCK_BYTES < stop:
            cut = min(_cut(data, at + BLOCK_BYTES, stop, table), int(ends[np.searchsorted(ends, at + BLOCK_BYTES)]))
        block = np.frombuffer(bytes(data[at:cut]).translate(table), dtype=np.uint8)
        broken = block == BREAK
        word = (block != GAP) & ~broken
        fresh = np.zeros(len(block) + 1, dtype=bool)
        fresh[ends[np.searchsorted(ends, at) : np.searchsorted(ends, cut, side="right")] - at] = True
        apart = ~word[:-1] | fresh[1:-1]
        starts = np.flatnonzero(word & np.concatenate([[True], apart]))
        apart = ~word[1:] | fresh[1:-1]
        sizes = np.flatnonzero(word & np.concatenate([apart, [True]])) + 1 - starts
        if len(starts):
            text = (np.searchsorted(ends, at + starts, side="right") - 1).astype(np.int32)
            piece = pieces + np.cumsum(broken, dtype=np.int32)[starts]
            first = np.ones(len(starts), dtype=bool)
            first[1:] = (text[1:] != text[:-1]) | (piece[1:] != piece[:-1])
            first[0] = (int(text[0]), int(piece[0])) != last
            last = (int(text[-1]), int(piece[-1]))
            marks = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            yield pa.Array.from_buffers(pa.utf8(), len(starts), [None, pa.py_buffer(marks), pa.py_buffer(block[word].tobytes())]), text, first
        pieces += int(broken.sum())
        at = cut
