"""Sampling of sections and variants. Draws order rows by a seeded hash: uniform without replacement, and repeatable."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from graphloom.operators.lengths import in_band
from graphloom.operators.order import numbered, running

MASK = (1 << 64) - 1


def draw_key(seed: int, *columns: str) -> Column:
    """Hex digest of seed and columns; also computable elsewhere."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in columns]))


def draw(seed: int, *columns: str) -> Column:
    """A number of 32 bits drawn from seed and columns."""
    return F.conv(F.substring(draw_key(seed, *columns), 1, 8), 16, 10).cast("long")


def sample_sections(index: DataFrame, low: int, high: int, k: int, seed: int, cells: list[str]) -> DataFrame:
    """k sections of the band, uniformly over all cells, in drawn order; fewer if the pool is smaller, none if it is empty.

    cells: the columns beside section_id that tell sections apart (program; or program, mode, depth). Only
    k rows of each task reach the final ordering.
    """
    pool = in_band(index, low, high).withColumn("__key", draw_key(seed, *cells, "section_id"))
    return pool.orderBy("__key", *cells, "section_id").limit(k).drop("__key")


def enumerate_in_band(index: DataFrame, low: int, high: int) -> DataFrame:
    return in_band(index, low, high).orderBy("length", "section_id")


def cell_counts(index: DataFrame, low: int, high: int, k: int, seed: int, cells: list[str]) -> DataFrame:
    """How many of the k draws fall into each cell."""
    return sample_sections(index, low, high, k, seed, cells).groupBy(*cells).agg(F.count("*").alias("n"))


def cap_variants(variants: DataFrame, k: int, seed: int) -> DataFrame:
    """At most k variants of each section, in order; sections with no more keep all."""
    by = W.partitionBy("section_id").orderBy(draw_key(seed, "section_id", "variant_idx"), "variant_idx")
    return variants.withColumn("__n", F.row_number().over(by)).filter(F.col("__n") <= k).drop("__n")


def select_variants(variants: DataFrame, wanted: DataFrame) -> DataFrame:
    """The listed variants, in the order of the list. wanted: section_id, variant_idx, pos."""
    return wanted.join(variants, ["section_id", "variant_idx"])


def exhaustive(sections: DataFrame, group_size: int, cells: list[str]) -> DataFrame:
    """Every eligible section once, with all variants, and its group within the cell."""
    rows = numbered(sections.filter("length > 0"), cells, ["section_id"], "__n")
    every = F.when(F.col("n_variants") > 0, F.sequence(F.lit(0), F.col("n_variants").cast("int") - 1)).otherwise(F.array().cast("array<int>"))
    return rows.select(*cells, "section_id", every.alias("variants"), F.floor(F.col("__n") / group_size).alias("group_id"))


class Xoshiro:
    """xoshiro256** seeded by splitmix64; unbiased draws below a bound by multiplication and rejection."""

    def __init__(self, seed: int):
        self.s, self.again = [], 0
        for _ in range(4):
            seed = (seed + 0x9E3779B97F4A7C15) & MASK
            z = seed
            z = ((z ^ z >> 30) * 0xBF58476D1CE4E5B9) & MASK
            z = ((z ^ z >> 27) * 0x94D049BB133111EB) & MASK
            self.s.append(z ^ z >> 31)

    def next(self) -> int:
        a, b, c, d = self.s
        x = b * 5 & MASK
        out = ((x << 7 | x >> 57) & MASK) * 9 & MASK
        c, d = c ^ a, d ^ b
        b, a = b ^ c, a ^ d
        c ^= (self.s[1] << 17) & MASK
        self.s = [a, b, c, (d << 45 | d >> 19) & MASK]
        return out

    def below(self, n: int) -> int:
        """High word of the product with n; low words under 2**64 mod n are drawn again."""
        least = (1 << 64) % n
        while True:
            high, low = divmod(self.next() * n, 1 << 64)
            if low >= least:
                return high
            self.again += 1


def shuffled_chunks(counts: list[int], size: int, seed: int) -> Iterator[tuple[int, list[int]]]:
    """(position, variants): each section's variants shuffled from one stream and dealt in chunks; a remainder is dropped."""
    rng = Xoshiro(seed)
    for at, n in enumerate(counts):
        order = list(range(n))
        for j in range(n - 1, 0, -1):
            k = rng.below(j + 1)
            order[j], order[k] = order[k], order[j]
        for b in range(0, n - n % size, size):
            yield at, order[b : b + size]


class Jumps:
    """States of a generator any number of steps ahead: its step is linear over bits, so 2**k steps are a matrix of bits."""

    def __init__(self, kind: type[Xoshiro]):
        self.kind, self.powers = kind, []

    def _column(self, bit: int) -> int:
        rng = self.kind(0)
        rng.s = [(1 << bit) >> 64 * i & MASK for i in range(4)]
        rng.next()
        return sum(x << 64 * i for i, x in enumerate(rng.s))

    @staticmethod
    def _times(columns: list[int], state: int) -> int:
        out = 0
        while state:
            low = state & -state
            out ^= columns[low.bit_length() - 1]
            state ^= low
        return out

    def ahead(self, seed: int, steps: int) -> Xoshiro:
        rng, k = self.kind(seed), 0
        state = sum(x << 64 * i for i, x in enumerate(rng.s))
        while steps >> k:
            if k == len(self.powers):
                last = self.powers[-1] if k else None
                self.powers.append([self._times(last, c) for c in last] if k else [self._column(bit) for bit in range(256)])
            if steps >> k & 1:
                state = self._times(self.powers[k], state)
            k += 1
        rng.s = [state >> 64 * i & MASK for i in range(4)]
        return rng


def validation_batches(sections: DataFrame, size: int, seed: int, kind: type[Xoshiro] = Xoshiro) -> DataFrame:
    """(section_id, batch, variants) by one sequential random stream over the sections in order.

    Sections are dealt out by range, and each task jumps to where its first section's draws start: a section of n variants
    takes n - 1 draws, and one more for each draw that is made again. Those are counted first. They are so rare that
    none is to be expected; each round that finds some puts right all sections up to the next of them.
    """
    import bisect

    import pandas as pd

    takes = {"draws": F.greatest(F.col("n_variants") - 1, F.lit(0)), "batch": F.floor(F.col("n_variants") / size)}
    rows = running(sections.select("section_id", "n_variants"), [], ["section_id"], takes).sortWithinPartitions("section_id")

    def walk(late: list[tuple[int, int]], only_late: bool):
        ids, sums = [i for i, _ in late], [0]
        for _, n in late:
            sums.append(sums[-1] + n)

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            jumps, rng, at = Jumps(kind), None, -1
            for batch in batches:
                out = []
                for section, n, draws, number in zip(*(batch[c].tolist() for c in ("section_id", "n_variants", "draws", "batch")), strict=True):
                    start = draws + sums[bisect.bisect_left(ids, section)]
                    if rng is None or at != start:
                        rng = jumps.ahead(seed, start)
                    before, dealt, order = rng.again, list(range(n)), []
                    for j in range(n - 1, 0, -1):
                        k = rng.below(j + 1)
                        dealt[j], dealt[k] = dealt[k], dealt[j]
                    again = rng.again - before
                    at = start + max(n - 1, 0) + again
                    if only_late:
                        order = [(section, again)] if again else []
                    else:
                        order = [(section, number + i, dealt[i * size : (i + 1) * size]) for i in range(n // size)]
                    out += order
                yield pd.DataFrame(out, columns=["section_id", "again"] if only_late else ["section_id", "batch", "variants"])

        return run

    late: list[tuple[int, int]] = []
    while (found := sorted((r["section_id"], r["again"]) for r in rows.mapInPandas(walk(late, True), "section_id bigint, again bigint").collect())) != late:
        late = found
    return rows.mapInPandas(walk(late, False), "section_id bigint, batch bigint, variants array<bigint>")


def near_length(index: DataFrame, target: int, n: int, seed: int) -> DataFrame:
    """n sections of the least radius around the target (0, 16, then half more each time, up to 1000) that holds enough; else of all."""
    radii, r = [0], 16.0
    while r <= 1000:
        radii.append(int(r))
        r *= 1.5
    counts = index.filter("length > 0").agg(*[F.count_if(F.col("length").between(max(1, target - r), target + r)).alias(str(r)) for r in radii]).first()
    radius = next((r for r in radii if counts[str(r)] >= n), None)
    low, high = (1, 1 << 30) if radius is None else (target - radius, target + radius)
    return sample_sections(index, low, high, n, seed, [])


def first_sections(sections: DataFrame, n: int) -> DataFrame:
    return sections.filter(F.col("section_id") < n)
