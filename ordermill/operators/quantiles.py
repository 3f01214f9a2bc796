"""Exact quantiles without bringing the values to one task.

The first scan brings extent, count and a sketch of every column, whose quantiles a little below and above
each wanted rank are the splitters of the second scan: it counts the few values between them in a fixed number
of equal-width bins, and all others in one bin below and one above (combined before the shuffle, so a scan
returns at most brackets x bins rows). A bin whose smallest and largest value agree, or whose edge is the
wanted rank, settles it; ordinary data, whose bins hold one value each by then, needs no more. Else the rank's
bin is the bracket of the next round, so a sketch that was wrong costs a round, never a wrong result.

The smallest and the largest value of a bracket never share a bin, infinities included, so every round
leaves a narrower bracket. The first rounds cut values into bins of equal width; whatever is still open after
``WIDTH_ROUNDS`` is cut by the values' bits instead, in which no range of doubles is wide: at most seven rounds
more with 2,048 bins.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass
from decimal import Decimal
from math import ceil, floor, isinf

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Rounds of bins of equal width, before bins of equal numbers of doubles.
WIDTH_ROUNDS = 4
#: The sketch's ranks are off by at most one in so many; its size in memory is proportional.
SKETCH_ACCURACY = 10_000


@dataclass(frozen=True)
class _Bracket:
    column: str
    low: float
    high: float
    below: int  # number of values smaller than ``low``
    splitters: tuple[float, float] | None = None  # values that are likely to enclose the rank


def _value(column: str) -> Column:
    """NaN is no value."""
    return F.nanvl(F.col(column).cast("double"), F.lit(None).cast("double"))


def _ordinal(value: float) -> int:
    """Place of a double among all doubles."""
    bits = struct.unpack("<q", struct.pack("<d", value + 0.0))[0]
    return bits if bits >= 0 else -(bits & 0x7FFF_FFFF_FFFF_FFFF)


def _ordinal_of(value: Column) -> Column:
    """The same for a column, from exponent and fraction; built-in functions only."""
    size = F.abs(value)
    # Subnormals have exponent 0; log2 may be off by one next to a power of two.
    guess = F.greatest(F.floor(F.log2(size)), F.lit(-1022)).cast("int")
    scale = lambda e: F.pow(F.lit(2.0), F.floor(e / 2)) * F.pow(F.lit(2.0), e - F.floor(e / 2))
    low = size < scale(guess)
    high = size / scale(guess) >= 2.0
    exponent = F.when(low & (guess > -1022), guess - 1).when(high, guess + 1).otherwise(guess)
    fraction = size / scale(exponent)  # in [1, 2), below 1 for subnormals
    normal = (exponent + 1022).cast("bigint") * F.lit(1 << 52) + (fraction * F.lit(float(1 << 52))).cast("bigint")
    place = F.when(size == 0, F.lit(0).cast("bigint")).when(size == F.lit(float("inf")), F.lit(0x7FF0 << 48)).otherwise(normal)
    return F.when(value < 0, -place).otherwise(place)


def _place(value: Column, b: _Bracket, bins: int, by_bits: bool) -> Column:
    """Bin of a value inside the bracket: 0 for its low end and ``bins - 1`` for its high end; with splitters these
    are the ends, and what is beyond them has a bin on either side.
    """
    if b.splitters:
        low, high = b.splitters
        between = _place(value, _Bracket(b.column, low, high, 0), bins, by_bits)
        return F.when(value < low, F.lit(-1)).when(value > high, F.lit(bins)).otherwise(between)
    if b.low == b.high:
        return F.lit(0).cast("bigint")
    if by_bits or isinf(b.low) or isinf(b.high):
        low, high = _ordinal(b.low), _ordinal(b.high)
        # Decimals hold the difference of any two.
        above = (_ordinal_of(value).cast("decimal(20,0)") - F.lit(Decimal(low))).cast("double")
        inner = F.floor(above / F.lit(float(high - low + 1)) * bins)
    else:
        # Halved, since the width may exceed the largest double.
        inner = F.floor((value / 2 - b.low / 2) / F.lit(b.high / 2 - b.low / 2) * bins)
    inside = F.least(F.greatest(inner.cast("bigint"), F.lit(0)), F.lit(bins - 1))
    return F.when(value == b.low, F.lit(0)).when(value == b.high, F.lit(bins - 1)).otherwise(inside)


def _histograms(df: DataFrame, brackets: list[_Bracket], bins: int, by_bits: bool) -> dict[int, list]:
    """Per bracket, its non-empty bins as (bin, count, smallest, largest), in order."""

    def entry(number: int, b: _Bracket):
        value = _value(b.column)
        place = _place(value, b, bins, by_bits)
        inside = F.struct(F.lit(number).alias("bracket"), place.cast("bigint").alias("bin"), value.alias("value"))
        return F.when(value.between(b.low, b.high), inside)

    rows = (
        df.select(F.explode(F.array_compact(F.array(*[entry(i, b) for i, b in enumerate(brackets)]))).alias("e"))
        .groupBy("e.bracket", "e.bin")
        .agg(F.count(F.lit(1)).alias("n"), F.min("e.value").alias("low"), F.max("e.value").alias("high"))
        .collect()
    )
    found: dict[int, list] = {}
    for row in sorted(rows, key=lambda r: (r["bracket"], r["bin"])):
        found.setdefault(row["bracket"], []).append((row["n"], row["low"], row["high"]))
    return found


def _settle(bracket: _Bracket, filled: list, rank: int) -> float | _Bracket:
    """The value at ``rank`` (0-based), or the narrower bracket that holds it."""
    below = bracket.below
    for n, low, high in filled:
        if rank < below + n:
            if low == high or rank == below:
                return low
            if rank == below + n - 1:
                return high
            narrower = _Bracket(bracket.column, low, high, below)
            if (low, high) == (bracket.low, bracket.high) and not bracket.splitters:
                raise RuntimeError(f"no progress between {low!r} and {high!r}")
            return narrower
        below += n
    raise ValueError("the input changed between passes; read it from a table or a checkpoint")


def exact_quantiles(
    df: DataFrame, columns: list[str], probabilities: list[float], bins: int = 2048
) -> dict[str, list[float | None]]:
    """``{column: [quantile, ...]}`` with linear interpolation; None where a column has no values.

    ``df`` is scanned once per round, so pass a stored table or a checkpoint, not a long plan.
    """
    # Twice the sketch's error on both sides of every rank.
    error = 2 / SKETCH_ACCURACY
    sides = [min(max(p + side, 0.0), 1.0) for p in probabilities for side in (-error, error)]

    def sketch(value: Column) -> Column:
        return F.percentile_approx(value, sides, SKETCH_ACCURACY)

    extent = df.agg(
        *[
            f(_value(c)).alias(f"{name}_{i}")
            for i, c in enumerate(columns)
            for name, f in (("n", F.count), ("low", F.min), ("high", F.max), ("near", sketch))
        ]
    ).first()

    settled: dict[tuple[str, int], float] = {}
    pending: dict[tuple[str, int], _Bracket] = {}
    positions: dict[str, list[float]] = {}
    for i, c in enumerate(columns):
        n = extent[f"n_{i}"]
        positions[c] = [p * (n - 1) for p in probabilities] if n else []
        near = extent[f"near_{i}"]
        for j, position in enumerate(positions[c]):
            for rank in (floor(position), ceil(position)):
                splitters = (near[2 * j], near[2 * j + 1])
                pending[(c, rank)] = _Bracket(c, extent[f"low_{i}"], extent[f"high_{i}"], 0, splitters)

    rounds = 0
    while pending:
        brackets = sorted(set(pending.values()), key=lambda b: (b.column, b.low, b.splitters or ()))
        found = _histograms(df, brackets, bins, rounds >= WIDTH_ROUNDS)
        rounds += 1
        for key, bracket in list(pending.items()):
            result = _settle(bracket, found[brackets.index(bracket)], key[1])
            if isinstance(result, _Bracket):
                pending[key] = result
            else:
                settled[key] = result
                del pending[key]

    def interpolated(c: str, position: float) -> float:
        lower, upper = settled[(c, floor(position))], settled[(c, ceil(position))]
        part = position - floor(position)
        if lower == upper or not part:
            return lower
        return lower * (1 - part) + upper * part if isinf(upper - lower) else lower + (upper - lower) * part

    return {c: [interpolated(c, p) for p in positions[c]] or [None] * len(probabilities) for c in columns}
