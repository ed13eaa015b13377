"""Type-2 slowly changing history from an event log.

Every distinct ``(key, sequence)`` event opens a version that is valid from its
own sequence value up to the next event of the same key (``__END_AT`` NULL for
the newest one).  Late and out-of-order events split the interval they fall into, and a replayed
batch changes nothing (events are made unique on ``(key, sequence)`` first; the
latest-ingested copy wins, S18).  ``build_history`` derives the history from
the whole event log; ``patch_history`` gives the versions that new events add
to a stored history or change in it, and nothing else.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sequence import next_in_sequence

START_AT = "__START_AT"
END_AT = "__END_AT"


def unique_events(events: DataFrame, key: str, seq: str, tiebreak: Sequence[str], last: str | None = None) -> DataFrame:
    """One event per (key, seq): the greatest under (tiebreak..., row hash, row,
    ``last``, which is a column that is not part of the event).

    A partial aggregate: copies collapse on the map side first.
    """
    cols = events.columns
    rest = [c for c in cols if c not in (key, seq, last) and c not in tiebreak]
    hashed = F.xxhash64(*[F.col(c) for c in rest])
    rest += [last] if last else []
    packed = F.struct(
        *[F.col(c).alias(f"_t{i}") for i, c in enumerate(tiebreak)],
        hashed.alias("_h"),
        *[F.col(c).alias(f"_r{i}") for i, c in enumerate(rest)],
    )
    picked = events.groupBy(key, seq).agg(F.max(packed).alias("_p"))
    out = (
        [F.col(key), F.col(seq)]
        + [F.col(f"_p._t{i}").alias(c) for i, c in enumerate(tiebreak)]
        + [F.col(f"_p._r{i}").alias(c) for i, c in enumerate(rest)]
    )
    return picked.select(*out).select(*cols)


def patch_history(
    stored: DataFrame,
    events: DataFrame,
    key: str,
    seq: str,
    columns: Sequence[str],
    tiebreak: Sequence[str] = ("ingested_at", "source_file"),
) -> DataFrame:
    """The versions (columns, tiebreak, start, end) that differ from ``stored``,
    a history with the tiebreak columns, once ``events`` are in it: each event's
    own version and the one that now ends at it.

    Only keys that have new events are read back (a semi-join).  A new event
    with the key and sequence of a stored one replaces it if it is the later one;
    the same event again is no change.
    """
    cols = [*columns, *[c for c in tiebreak if c not in columns]]
    kept = stored.join(events.select(key).distinct(), key, "left_semi")
    kept = kept.select(*cols, F.struct(F.col(END_AT).alias("end")).alias("__was"))
    fresh = events.select(*cols, F.lit(None).cast(kept.schema["__was"].dataType).alias("__was"))
    # of equal copies the stored one stays: its struct is greater than NULL
    both = unique_events(kept.unionByName(fresh), key, seq, tiebreak, last="__was")
    after = next_in_sequence(both, key, seq, END_AT)
    changed = F.col("__was").isNull() | ~F.col("__was.end").eqNullSafe(F.col(END_AT))
    return after.filter(changed).select(*cols, F.col(seq).alias(START_AT), END_AT)


def merge_patches(base: DataFrame, patches: DataFrame, key: str, number: str) -> DataFrame:
    """``base`` with every version that ``patches`` have as the one with the
    greatest ``number`` has it.  The base is not grouped: versions that were
    patched are taken out of it by an anti-join with the few patches."""
    rest = [c for c in base.columns if c not in (key, START_AT)]
    newest = patches.groupBy(key, START_AT).agg(F.max(F.struct(F.col(number), F.struct(*rest).alias("row"))).alias("p"))
    newest = newest.select(key, START_AT, *[F.col(f"p.row.{c}").alias(c) for c in rest])
    return base.join(newest, [key, START_AT], "left_anti").unionByName(newest)


def build_history(
    events: DataFrame,
    key: str,
    seq: str,
    columns: Sequence[str],
    tiebreak: Sequence[str] = ("ingested_at", "source_file"),
) -> DataFrame:
    evs = unique_events(events.select(*columns, *[c for c in tiebreak if c not in columns]), key, seq, tiebreak)
    evs = evs.select(*columns)
    hist = next_in_sequence(evs, key, seq, END_AT)
    return hist.select(*columns, F.col(seq).alias(START_AT), END_AT)


def collapse_unchanged(history: DataFrame, key: str, tracked: Sequence[str]) -> DataFrame:
    """``history`` with consecutive versions of a key that agree in ``tracked``
    merged into one, from the first one's start to the last one's end (S19).

    Gaps and islands without a window over a whole key: a version's start is
    kept if the version that ends there differs (an equi-join on key and
    instant), and a kept version ends where the next kept one starts.  Other
    columns are those of the first version of a run.
    """
    same = F.struct(*tracked)
    before = history.select(F.col(key), F.col(END_AT).alias(START_AT), same.alias("__before"))
    opens = history.join(before.filter(F.col(START_AT).isNotNull()), [key, START_AT], "left")
    opens = opens.filter(F.col("__before").isNull() | ~F.col("__before").eqNullSafe(same)).drop("__before", END_AT)
    return next_in_sequence(opens, key, START_AT, END_AT).select(*history.columns)


def current_rows(history: DataFrame, kind_col: str, terminated: str) -> DataFrame:
    """Open versions whose event is not a termination.  A NULL event kind is
    excluded as well (three-valued ``!=``), as in the reference."""
    return history.filter(F.col(END_AT).isNull() & (F.col(kind_col) != F.lit(terminated)))
