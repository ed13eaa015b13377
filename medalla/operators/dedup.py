"""Deterministic duplicate removal.

``keep_first`` keeps, per key, the row that is smallest under a total order:
the given ordering columns first, then every remaining column (ascending,
NULLs first).  It is expressed as ``groupBy(key).agg(min(struct(...)))`` rather
than ``row_number()`` over a window: the aggregate runs a partial (map-side)
step, so even a key that holds a third of all rows leaves each map task as a
single row and no reducer ever holds the whole group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_PICK = "__pick"


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    keys = list(keys)
    cols = df.columns
    rest = [c for c in cols if c not in keys and c not in order]
    ranked = list(order) + rest
    packed = F.struct(*[F.col(c).alias(f"_{i}") for i, c in enumerate(ranked)])
    picked = df.groupBy(*keys).agg(F.min(packed).alias(_PICK))
    out = [F.col(k) for k in keys] + [F.col(f"{_PICK}._{i}").alias(c) for i, c in enumerate(ranked)]
    return picked.select(*out).select(*cols)


def keep_first_stream(df: DataFrame, keys: Sequence[str], watermark: str, event_time: str = "ingested_at") -> DataFrame:
    """Streaming form with bounded state: first arrival per key wins, and a key
    is forgotten once the event-time ``watermark`` (e.g. ``"30 days"``) passes
    its first arrival plus the delay, so a copy arriving later than that is let
    through.  ``operators.seen`` is the exact form, which holds no state."""
    return df.withWatermark(event_time, watermark).dropDuplicatesWithinWatermark(list(keys))
