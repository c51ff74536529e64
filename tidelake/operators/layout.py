"""Order of rows along a space-filling curve, so that files are narrow in several columns at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

#: Values per column from which the bounds are taken, about; strings count by their first characters.
SAMPLED, CHARACTERS = 100_000, 64


def bucket_bounds(rows: DataFrame, columns: Sequence[str], bits: int) -> dict[str, list]:
    """For each column at most 2^bits - 1 ascending values that cut it into buckets of about as many rows each.

    Taken from about SAMPLED rows, as the bounds of a range partitioning are: they decide where rows lie, never which rows there are.
    """
    cut = [F.substring(c, 1, CHARACTERS).alias(c) if kind == "string" else F.col(c)
           for c, kind in rows.select(*columns).dtypes]
    total = rows.count()
    some = rows.select(*cut).sample(min(1.0, SAMPLED / total), 7) if total > SAMPLED else rows.select(*cut)
    row = some.agg(*[F.array_sort(F.collect_list(c)).alias(c) for c in columns]).first()
    out = {}
    for c in columns:
        values = row[c]
        places = [len(values) * k >> bits for k in range(1, 1 << bits)] if values else []
        out[c] = sorted({values[p] for p in places})
    return out


def bucket(column: str, bounds: list) -> Column:
    """Number of bounds that a value reaches, by bisection; a null reaches none."""
    def within(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(F.col(column) >= F.lit(bounds[middle]), within(middle + 1, high)).otherwise(within(low, middle))

    return within(0, len(bounds)).cast("long")


def curve(rows: DataFrame, columns: Sequence[str], bits: int = 6) -> Column:
    """Place of a row on the Z-order curve over the columns' buckets: their bits in turn, the first column's highest first.

    Any types that Spark orders will do. A value that holds many rows is one bucket of its column; the other columns part its rows.
    """
    if not 1 <= bits * len(columns) <= 62:
        raise ValueError("bits times columns must be between 1 and 62")
    bounds = bucket_bounds(rows, columns, bits)
    out = F.lit(0).cast("long")
    for i, c in enumerate(columns):
        place = bucket(c, bounds[c])
        for b in range(bits):
            bit = F.shiftright(place, b).bitwiseAND(F.lit(1).cast("long"))
            out = out.bitwiseOR(F.shiftleft(bit, b * len(columns) + len(columns) - 1 - i))
    return out
