"""Text and binary codecs of arrays, numbers, names and strings."""

from __future__ import annotations

import base64

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def encode_array(values: np.ndarray) -> str:
    """Base64 of 5 bits width - 2, 3 bits size of the length field / 4 - 1, the length, and the values, high bits first."""
    values = np.asarray(values, dtype=np.uint64)
    width = max(2, int(values.max()).bit_length()) if len(values) else 2
    if width > 33:
        raise ValueError("values wider than 33 bits")
    field = max(4, -(-len(values).bit_length() // 4) * 4)
    head = f"{width - 2:05b}{field // 4 - 1:03b}{len(values):0{field}b}"
    bits = (values[:, None] >> np.arange(width - 1, -1, -1, dtype=np.uint64)) & np.uint64(1)
    every = np.concatenate([np.frombuffer(head.encode(), dtype=np.uint8) - 48, bits.astype(np.uint8).ravel()])
    return base64.b64encode(np.packbits(every).tobytes()).decode()


def decode_array(text: str) -> np.ndarray:
    bits = np.unpackbits(np.frombuffer(base64.b64decode(text), dtype=np.uint8))
    if len(bits) < 12:
        raise ValueError("header incomplete")

    def number(a: int, b: int) -> int:
        return int("".join(map(str, bits[a:b])) or "0", 2)

    width, field = number(0, 5) + 2, 4 * (number(5, 8) + 1)
    n, at = number(8, 8 + field), 8 + field
    if len(bits) < at + n * width:
        raise ValueError("values incomplete")
    grid = bits[at : at + n * width].reshape(n, width).astype(np.int64)
    return grid @ (np.int64(1) << np.arange(width - 1, -1, -1, dtype=np.int64))


@F.pandas_udf(T.StringType())
def array_to_text(values: pd.Series) -> pd.Series:
    return values.map(encode_array, na_action="ignore")


@F.pandas_udf(T.ArrayType(T.LongType()))
def text_to_array(texts: pd.Series) -> pd.Series:
    return texts.map(decode_array, na_action="ignore")


#: Byte -> letter behind the backslash; fixed values of the format. Other control bytes are \\xhh.
LETTERS = {0x5C: "\\", 0x09: "t", 0x0A: "n", 0x0D: "r", 0x07: "a", 0x08: "b", 0x0B: "v", 0x0C: "f", 0x00: "0"}
_OUT = [f"\\{LETTERS[b]}".encode() if b in LETTERS else b"\\x%02x" % b if b < 0x20 or b == 0x7F else bytes([b]) for b in range(256)]
_BACK = {ord(v): k for k, v in LETTERS.items()}


def escape_bytes(raw: bytes) -> bytes:
    return b"".join(map(_OUT.__getitem__, raw))


def unescape_bytes(line: bytes) -> bytes:
    first, *parts = line.split(b"\\")
    out, literal = [first], False
    for i, part in enumerate(parts):
        if literal:  # an escaped backslash came just before
            out.append(part)
            literal = False
        elif not part:
            if i + 1 == len(parts):
                raise ValueError("trailing backslash")
            out.append(b"\\")
            literal = True
        elif part[0] in _BACK:
            out.append(bytes([_BACK[part[0]]]) + part[1:])
        elif part[:1] == b"x" and len(part) >= 3:
            out.append(bytes([int(part[1:3], 16)]) + part[3:])
        else:
            raise ValueError(f"no such escape: {part[:1]!r}")
    return b"".join(out)


@F.pandas_udf(T.BinaryType())
def escape_line(raw: pd.Series) -> pd.Series:
    return raw.map(escape_bytes, na_action="ignore")


@F.pandas_udf(T.BinaryType())
def unescape_line(lines: pd.Series) -> pd.Series:
    return lines.map(unescape_bytes, na_action="ignore")


def _even_hex(n: Column) -> Column:
    digits = F.hex(n.cast("long"))
    return F.when(F.length(digits) % 2 == 1, F.concat(F.lit("0"), digits)).otherwise(digits)


def encode_line_no(n: Column) -> Column:
    """Unpadded URL-safe base64 of the least big-endian bytes of a number from 1."""
    text = F.rtrim(F.base64(F.unhex(_even_hex(n))), F.lit("="))
    return F.when(n >= 1, F.translate(text, "+/", "-_")).otherwise(F.raise_error(F.lit("line numbers start at 1")).cast("string"))


def decode_line_no(text: Column) -> Column:
    padded = F.rpad(F.translate(text, "-_", "+/"), F.lit(4) * F.ceil(F.length(text) / 4).cast("int"), F.lit("="))
    return F.conv(F.hex(F.unbase64(padded)), 16, 10).cast("long")


def least_bytes(n: Column) -> Column:
    """Least big-endian bytes of a number as an array; none for 0."""
    digits = _even_hex(n)
    each = F.transform(F.sequence(F.lit(1), F.length(digits) - 1, F.lit(2)), lambda i: F.conv(F.substring(digits, i, F.lit(2)), 16, 10).cast("int"))
    return F.when(n == 0, F.array().cast("array<int>")).otherwise(each)


def from_bytes(digits: Column) -> Column:
    return F.aggregate(digits, F.lit(0).cast("long"), lambda acc, x: acc * 256 + x)


def join_names(names: Column) -> Column:
    """Comma-joined, commas inside names escaped."""
    return F.array_join(F.transform(names, lambda n: F.replace(n, F.lit(","), F.lit("\\,"))), ",")


def split_names(text: Column) -> Column:
    """Inverse of join_names; a trailing empty name is dropped and an empty text has none."""
    parts = F.transform(F.split(text, r"(?<!\\),", -1), lambda p: F.replace(p, F.lit("\\,"), F.lit(",")))
    cut = F.when(F.element_at(parts, -1) == "", F.slice(parts, F.lit(1), F.size(parts) - 1)).otherwise(parts)
    return F.when(F.length(text) == 0, F.array().cast("array<string>")).otherwise(cut)


def join_targets(targets: Column) -> Column:
    """idx,hex,matched triples, joined by semicolons, of structs (idx, start, is_matched)."""
    return F.array_join(F.transform(targets, lambda t: F.concat_ws(",", t["idx"].cast("string"), F.lower(F.hex(t["start"])), t["is_matched"].cast("string"))), ";")


def split_targets(text: Column) -> Column:
    parts = F.transform(F.filter(F.split(text, ";", -1), lambda p: p != ""), lambda p: F.split(p, ","))
    return F.transform(parts, lambda p: F.struct(F.get(p, F.lit(0)).cast("int").alias("idx"), F.conv(F.get(p, F.lit(1)), 16, 10).cast("long").alias("start"), F.get(p, F.lit(2)).cast("int").alias("is_matched")))


def inline_indexer(offset: Column) -> Column:
    """Eight hex digits of a 16-byte-aligned offset / 16, low byte first."""
    digits = F.lower(F.lpad(F.hex(F.shiftright(offset, 4)), 8, "0"))
    return F.concat(*[F.substring(digits, i, 2) for i in (7, 5, 3, 1)])


def decode_inline_indexer(text: Column) -> Column:
    return F.shiftleft(F.conv(F.concat(*[F.substring(text, i, 2) for i in (7, 5, 3, 1)]), 16, 10).cast("long"), 4)


def frame_literal(name: Column, digits: Column) -> Column:
    """name_Lit_Start name_hh ... name_Lit_End."""
    each = F.transform(digits, lambda d: F.concat(name, F.lit("_"), F.upper(F.lpad(F.hex(d.cast("long")), 2, "0"))))
    return F.array_join(F.concat(F.array(F.concat(name, F.lit("_Lit_Start"))), each, F.array(F.concat(name, F.lit("_Lit_End")))), " ")


def fingerprint(content: Column) -> Column:
    """First eight bytes of the SHA-256, in hex."""
    return F.substring(F.sha2(content, 256), 1, 16)
