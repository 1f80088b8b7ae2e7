"""An exact split of rows into two parts, by distributed selection.

The rows are in the pseudo-random order of a seeded hash of their key. Part one takes
exactly its number of rows from the front of that order: the hash of its last row is
found by refining histograms (a count per digit of the hash, a few passes over narrow
rows), so nothing is sorted and no task or driver sees more than one histogram.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a hash, and of one digit of it: a histogram has at most 2 ** _DIGIT rows.
BITS, _DIGIT = 60, 15


def hash_order(cols: Sequence[str], seed: int) -> Column:
    """60 pseudo-random bits of the columns' values (NULL as the empty text)."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in cols])
    return F.conv(F.substring(F.md5(text), 1, BITS // 4), 16, 10).cast("long")


def kth_smallest(rows: DataFrame, column: str, k: int, bits: int = BITS) -> tuple[int, int, int]:
    """(value, rank, equal): the k-th smallest (from 1) of a column of numbers in [0, 2 ** bits), its place
    among the rows equal to it, and their number. Needs 1 <= k <= number of rows."""
    value, equal = 0, 0
    for shift in range(bits - _DIGIT, -1, -_DIGIT):
        digit = F.shiftright(column, shift).bitwiseAND(F.lit((1 << _DIGIT) - 1))
        same = F.shiftright(column, shift + _DIGIT) == F.lit(value) if shift + _DIGIT < bits else F.lit(True)
        counts = rows.where(same).groupBy(digit.alias("d")).agg(F.count(F.lit(1)).alias("n")).collect()  # <= 2 ** 15 rows
        for d, n in sorted((r["d"], r["n"]) for r in counts):
            if k <= n:
                value, equal = value << _DIGIT | d, n
                break
            k -= n
        else:
            raise ValueError("there are fewer than k rows")
    return value, k, equal


def exact_split(df: DataFrame, key: str, share: float, materialize: Callable[[DataFrame], DataFrame],
                names: tuple[str, str] = ("train", "test"), seed: int = 42, ties: Sequence[str] = (),
                column: str = "split") -> DataFrame:
    """``df`` with ``column``: exactly ``int(share * n)`` of the n rows are in the first part.

    Rows come in the order of a hash of ``key``, then of ``ties``; rows that are equal in both (a NULL or
    repeated key) by their place in the table that ``materialize`` writes, which makes the parts the same on
    every later read. The key alone decides but for the rows at the boundary."""
    if not 0.0 <= share <= 1.0:
        raise ValueError("share must be between 0 and 1")
    rows = materialize(df.withColumns({
        "_first": hash_order([key], seed), "_second": hash_order(list(ties), seed),
        "_third": F.monotonically_increasing_id()}))
    wanted = int(share * rows.count())
    first, second = F.lit(names[0]), F.lit(names[1])
    if wanted == 0:
        part = second
    else:
        # Down to the row itself, as far as rows are equal at the boundary.
        inside, at_bound, left, k = F.lit(False), F.lit(True), rows, wanted
        for name, bits in [("_first", BITS), *([("_second", BITS)] if ties else []), ("_third", 75)]:
            value, k, equal = kth_smallest(left.select("_first", "_second", "_third"), name, k, bits)
            inside = inside | (at_bound & (F.col(name) < value))
            at_bound = at_bound & (F.col(name) == value)
            if k == equal:
                break
            left = left.where(F.col(name) == value)
        part = F.when(inside | at_bound, first).otherwise(second)
    return rows.withColumn(column, part).drop("_first", "_second", "_third")
