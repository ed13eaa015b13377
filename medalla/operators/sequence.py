"""Next value in a per-key sequence, safe under key skew.

``lead(seq) OVER (PARTITION BY key ORDER BY seq)`` sends every row of a key to
one task; a key holding a third of the table would stall the job in a single
sort.  Here a key's rows are cut into *slices* of the sequence (days of a
timestamp, runs of 4096 numbers), and a slice in which a key has more than its
share of the table - all its events in one day, say - once more, at quantiles of
that key's values there.  The quantiles come from a sample by hash; they decide
on nothing but how even the slices are, since any ascending slices give the
same result.  At most ``MOST_BUSY`` slices can have that share, which bounds
what is broadcast.  Then:

1. ``lead`` over (key, slice) finds the successor of every row but a slice's
   last one - a hot key is spread over as many groups as it has slices;
2. the first value of every (key, slice), a partial aggregate, is one row for
   each slice a key occurs in; ``lead`` over those few rows gives the slice's
   successor;
3. a join back on (key, slice), which is how step 1 left its rows, fills in the
   last row of each slice.

Everything is lazy JVM work: filters and pruned columns reach the scan, nothing
is written in between, and a lost executor recomputes its own partitions only.

Requires ``(key, seq)`` to be unique and non-NULL (make it so first).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLICE = "__slice"
PART = "__part"
NEXT_SLICE = "__next_slice"
NUMBERS_PER_SLICE = 4096

#: A slice is busy with more than 1 / MOST_BUSY of the table's rows for a key.
MOST_BUSY = 4096
PARTS = 256  # that a busy slice is cut into
SAMPLED = 64  # one row in so many tells where
LEAST_SAMPLE = 64  # sampled rows below which a slice is never busy


def slice_of(kind: T.DataType) -> Callable[[Column], Column]:
    """Slices of a sequence of that type, ascending with it."""
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return lambda c: F.date_trunc("day", c)
    if isinstance(kind, T.DateType):
        return lambda c: F.trunc(c, "month")
    return lambda c: F.floor(c / NUMBERS_PER_SLICE)


def busy_cuts(sliced: DataFrame, key: str, seq: str) -> DataFrame:
    """(key, slice, cuts) of the busy slices: ascending values of ``seq``."""
    sample = sliced.filter(F.pmod(F.xxhash64(key, seq), F.lit(SAMPLED)) == 0)
    quantiles = F.array(*[F.lit(i / PARTS) for i in range(1, PARTS)])
    cuts = F.percentile_approx(seq, quantiles, 16 * PARTS).alias("__cuts")
    groups = sample.groupBy(key, SLICE).agg(F.count(F.lit(1)).alias("__n"), cuts)
    total = sample.agg(F.count(F.lit(1))).scalar()
    return groups.filter((F.col("__n") >= LEAST_SAMPLE) & (F.col("__n") * MOST_BUSY > total)).drop("__n")


def sliced_rows(df: DataFrame, key: str, seq: str, slices: Callable[[Column], Column] | None = None) -> DataFrame:
    """``df`` with the slice of each row and, in a busy slice, its part."""
    kind = df.schema[seq].dataType
    rows = df.withColumn(SLICE, (slices or slice_of(kind))(F.col(seq)))
    if not isinstance(kind, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        return rows.withColumn(PART, F.lit(0))  # no quantiles of such values
    met = rows.join(F.broadcast(busy_cuts(rows, key, seq)), [key, SLICE], "left")
    part = F.when(F.col("__cuts").isNull(), F.lit(0)).otherwise(F.size(F.filter("__cuts", lambda c: c <= F.col(seq))))
    return met.withColumn(PART, part).drop("__cuts")


def next_in_sequence(
    df: DataFrame, key: str, seq: str, out: str, slices: Callable[[Column], Column] | None = None
) -> DataFrame:
    """``df`` with ``out``: the next larger ``seq`` of the same key, or NULL."""
    sliced = sliced_rows(df, key, seq, slices)
    within = sliced.withColumn(out, F.lead(seq).over(Window.partitionBy(key, SLICE, PART).orderBy(seq)))
    heads = sliced.groupBy(key, SLICE, PART).agg(F.min(seq).alias("__head"))
    following = F.lead("__head").over(Window.partitionBy(key).orderBy(SLICE, PART))
    after = heads.select(key, SLICE, PART, following.alias(NEXT_SLICE))
    joined = within.join(after, [key, SLICE, PART], "left")
    return joined.withColumn(out, F.coalesce(out, NEXT_SLICE)).select(*df.columns, out)
