"""Counts over whole texts that the quality rules and the quality classifier share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.llm._util import let_go

#: Word separators and symbol characters; fixed values of the contract.
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
UPPER = bytes(range(65, 91))
DIGITS = bytes(range(48, 58))

STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_digits",
         "n_marks", "n_stops", "n_distinct"]


def _repeats(words: list[bytes]) -> tuple[int, int]:
    """Words inside 3-word windows that occur twice or more, and distinct words."""
    numbers = {w: i for i, w in enumerate(dict.fromkeys(words))}
    v = len(numbers)
    if len(words) < 4:
        return 0, v
    ids = np.fromiter(map(numbers.__getitem__, words), dtype=np.int64, count=len(words))
    pair = ids[:-1] * v + ids[1:]
    if v >= 1 << 20:  # keep the window code within 63 bits
        pair = np.unique(pair, return_inverse=True)[1].astype(np.int64)
    code = pair[:-1] * v + ids[2:]
    order = np.argsort(code, kind="stable")
    ranked = code[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0, v
    twice = np.zeros(len(code), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    marked = np.zeros(len(words), dtype=bool)
    for k in range(3):
        marked[k : k + len(code)] |= twice
    return int(marked.sum()), v


def text_stats(text: str | None) -> tuple[int, ...]:
    """STATS of one whole text; a null text counts as one without words."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    dup, lines, seen = 0, 0, set()
    for line in text.split("\n"):
        if line.strip(SPACES):
            lines += 1
            if line in seen:
                dup += 1
            else:
                seen.add(line)
    repeat, distinct = _repeats(words)
    return (len(words), len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)), dup, repeat, lines,
            len(raw) - len(raw.translate(None, UPPER)), len(raw) - len(raw.translate(None, DIGITS)), text.count("!"),
            text.count("."), distinct)


def with_stats(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The kept columns of docs (default: all) and a struct column `stats`, in one pass over the text."""
    keep = docs.columns if keep is None else keep
    schema = docs.select(*keep).schema
    fields = ", ".join(f"{s}: bigint" for s in STATS)
    width = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            rows = [text_stats(t) for t in batch.column(width).to_pylist()]
            cols = zip(*rows, strict=True) if rows else [[] for _ in STATS]
            stats = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in cols], names=STATS)
            yield pa.RecordBatch.from_arrays([*batch.columns[:width], stats], names=[*names, "__stats"])

    names = [f"c{i}" for i in range(width)]
    given = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(keep, names, strict=True)], F.col(text_col).alias("__t"))
    ddl = ", ".join(f"{n} {f.dataType.simpleString()}" for n, f in zip(names, schema.fields, strict=True))
    out = given.mapInArrow(run, f"{ddl}{', ' if ddl else ''}__stats struct<{fields}>")
    return out.select(*[F.col(n).alias(c) for c, n in zip(keep, names, strict=True)], F.col("__stats").alias("stats"))
