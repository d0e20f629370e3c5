"""Running values over ordered rows without one task per key.

A window over a whole key puts a hot key into a single task. Here rows are
ordered by an integer and grouped by its leading bits, twice: 2**16 positions to a
bucket, 2**24 buckets to a group. Every window sees at most that many rows,
whatever the values of the order column: a bucket's rows, a group's buckets, and
(of the 23 bits left) a key's groups.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET_BITS = 16
GROUP_BITS = 24


def running_before(
    df: DataFrame, keys: Sequence[str], order: str, sums: dict[str, Column], *,
    at_last: dict[str, tuple[str, Column]] | None = None, bits: int = BUCKET_BITS,
) -> DataFrame:
    """Add, per row, sums over all earlier rows of its key (0 for the first).

    ``at_last`` adds the value such a sum had at the latest earlier row for
    which a condition holds, NULL if there is none; summands must not be
    negative. ``order`` is a non-negative BIGINT, unique within a key.
    """
    marks = at_last or {}
    rows = df.select(
        "*", *[v.cast("bigint").alias(f"__v_{n}") for n, v in sums.items()],
        *[F.when(c, F.lit(0).cast("bigint")).alias(f"__m_{m}") for m, (_, c) in marks.items()])
    return _running(rows, list(keys), order, list(sums), {m: n for m, (n, _) in marks.items()}, [bits, GROUP_BITS]).select(
        *df.columns, *[F.col(f"__r_{n}").alias(n) for n in sums], *[F.col(f"__a_{m}").alias(m) for m in marks])


def _running(rows: DataFrame, keys: list[str], order: str, sums: list[str], marks: dict[str, str], bits: list[int]) -> DataFrame:
    """Add ``__r_`` (sums before) and ``__a_`` (sum at the latest mark before) from ``__v_`` and ``__m_`` (a mark's place in its row)."""
    bucket = f"__b{len(bits)}"
    group = [*keys, bucket] if bits else keys
    cut = rows.withColumn(bucket, F.shiftright(order, bits[0])) if bits else rows
    before = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    local = cut.select("*", *[F.coalesce(F.sum(f"__v_{n}").over(before), F.lit(0)).alias(f"__r_{n}") for n in sums])
    local = local.select("*", *[F.max(F.col(f"__r_{n}") + F.col(f"__m_{m}")).over(before).alias(f"__a_{m}") for m, n in marks.items()])
    if not bits:
        return local
    totals = (local if marks else cut).groupBy(*group).agg(
        *[F.sum(f"__v_{n}").alias(f"__v_{n}") for n in sums],
        *[F.max(F.col(f"__r_{n}") + F.col(f"__m_{m}")).alias(f"__m_{m}") for m, n in marks.items()])
    starts = _running(totals, keys, bucket, sums, marks, bits[1:]).select(
        *group, *[F.col(f"__r_{n}").alias(f"__s_{n}") for n in sums], *[F.col(f"__a_{m}").alias(f"__e_{m}") for m in marks])
    kept = [c for c in rows.columns]
    return local.join(starts, group).select(
        *kept, *[(F.col(f"__s_{n}") + F.col(f"__r_{n}")).alias(f"__r_{n}") for n in sums],
        *[F.coalesce(F.col(f"__s_{n}") + F.col(f"__a_{m}"), F.col(f"__e_{m}")).alias(f"__a_{m}") for m, n in marks.items()])
