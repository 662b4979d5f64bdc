"""Clustering along a space-filling curve, so that filters on any of several columns skip most of a table.

Each column is cut into ranks of about equal rows, and the bits of a row's ranks are interleaved into one number, highest bits first.
Rows with close numbers are close in every column, so a file or row group of them spans a small range of each.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 4
ACCURACY = 10_000


def rank_bounds(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> dict[str, list]:
    """The values that begin each rank but the first, by one pass over the columns: 2 ** bits - 1 values each at most, fewer
    where a value is frequent enough to fill ranks."""
    shares = [k / 2**bits for k in range(1, 2**bits)]
    found = df.agg(*[F.percentile_approx(c, shares, ACCURACY).alias(c) for c in columns]).first()
    return {c: sorted(set(found[c] or [])) for c in columns}


def rank_text(column: str, bounds: Sequence) -> str:
    """A row's rank as SQL text over numbers: comparisons only, so it stays in generated code."""
    return "(" + " + ".join(["0", *[f"IF({column} >= {b}, 1, 0)" for b in bounds]]) + ")"


def interleaved(ranks: Sequence[str], bits: int = BITS) -> str:
    """The interleaved number of ranks below 2 ** bits, the first rank's bit first, as SQL text."""
    parts = []
    for bit in range(bits):
        for place, rank in enumerate(ranks):
            to = bit * len(ranks) + len(ranks) - 1 - place
            parts.append(f"shiftleft(shiftright({rank}, {bit}) & 1, {to})")
    return "(" + " | ".join(parts) + ")"
