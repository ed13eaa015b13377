"""Exact first arrivals of a stream without a state store.

``dropDuplicates`` on a stream keeps an entry for every key in a state store,
for ever, on the executors.  Here the keys taken so far are a table of runs
(``storage.publish_run``), one for each micro-batch, folded now and then.  A
micro-batch

1. groups its keys, without their rows, and writes them down, each with whether
   it has copies in the batch;
2. finds those that were taken.  A batch that is small beside the keys taken
   looks each key up in a bitmap of the hashes of all keys taken: most new keys
   are found new there, and no key that was taken is; only the keys whose bit is
   set are joined with the table.  A larger batch is joined with the table;
3. takes down the keys that are left, and their bits, as the batch's own run;
4. keeps the smallest row of each of these.  Rows of keys that come once in the
   batch are passed on as they are if few keys have copies; the others go through
   a partial aggregate (a key copied a million times leaves a map task once).
   Where few keys are new, the others' rows are dropped before the shuffle.

What a batch reads is as of the batches before it, so a replayed batch finds
the same keys new.  The bitmap has ``BITS_PER_KEY`` to ``16 * BITS_PER_KEY``
bits a key, up to ``MOST_BITS``: 4 KB rows, of which there are at most 2**15.
It is made anew, as many times 16 times larger as it takes, when the keys have
outgrown it; beyond the largest one more keys go through the join and results
stay right.  Everything is JVM work.

A NULL key is a key like any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources import storage
from . import dedup

LEAST_BITS, MOST_BITS = 20, 30  # powers of two
BITS_PER_KEY = 8
#: New keys of a batch up to which its rows are filtered by them before anything else,
#: and keys with copies up to which the others' rows are not shuffled.
FEW_KEYS = 100_000
#: A batch with more than this share of the keys taken is joined with them, without the bitmap.
LARGE_SHARE = 0.25
#: Runs that are folded into one.
MOST_RUNS = 24
#: Whether a key has more than one row in its batch.
COPIED = "__copied"

BITMAP = T.StructType([T.StructField("word", T.LongType()), T.StructField("bits", T.BinaryType())])


def _tag(batch_id: int, kind: str = "r") -> str:
    return f"{kind}{batch_id:012d}"


def _before(spark: SparkSession, path: str, batch_id: int) -> list[str]:
    """Live runs of the batches before this one."""
    tags = [t for t in storage.published_runs(spark, path) if int(t[1:]) < batch_id]
    return storage.live_runs(tags)


def _place(key: str, bits: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(1 << bits))


def _bitmap(keys: DataFrame, key: str, bits: int) -> DataFrame:
    place = _place(key, bits)
    words = keys.groupBy(F.bitmap_bucket_number(place).alias("word"))
    return words.agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))


def _bit_is_set(position: Column) -> Column:
    """Whether bit ``position`` of the binary column ``bits`` is set."""
    byte = F.conv(F.hex(F.substring("bits", (F.floor(position / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("long")
    return F.getbit(byte, (position % 8).cast("int")) == 1


def sizes(spark: SparkSession, path: str, batch_id: int) -> list[int]:
    """Bitmaps (as powers of two) that hold all keys before this batch, ascending."""
    return [b for b in range(LEAST_BITS, MOST_BITS + 1, 2) if _before(spark, f"{path}_bits{b}", batch_id)]


def first_arrivals(spark: SparkSession, path: str, rows: DataFrame, key: str, order: Sequence[str], batch_id: int) -> DataFrame:
    """The rows of a micro-batch whose key no earlier batch had, one for each key."""
    tag, tags = _tag(batch_id), _before(spark, path, batch_id)
    kind = T.StructType([rows.schema[key], T.StructField(COPIED, T.BooleanType())])
    keys = rows.groupBy(key).agg((F.count(F.lit(1)) > 1).alias(COPIED))
    n_taken = 0
    if tags:
        # written down: they are asked for more than once, and need not be grouped again
        storage.write_run(keys, f"{path}_asked", tag)
        keys = storage.read_runs(spark, f"{path}_asked", [tag], kind).drop("run")
        taken = storage.read_runs(spark, path, tags, kind).select(key)
        n_keys, n_taken = keys.count(), taken.count()
        if n_keys <= LARGE_SHARE * n_taken:
            maybe = _perhaps_taken(spark, path, keys, key, batch_id)
            taken = taken.join(maybe, taken[key].eqNullSafe(F.col("__key")), "left_semi")
        taken = taken.select(F.col(key).alias("__taken"))
        keys = keys.join(taken, keys[key].eqNullSafe(F.col("__taken")), "left_anti")
    storage.publish_run(keys, path, tag)
    own = storage.read_runs(spark, path, [tag], kind)
    n_own = own.count()
    _keep_bits(spark, path, own, key, kind, batch_id, n_taken + n_own)
    if tags:
        storage.remove_run(spark, f"{path}_asked", tag)
    if not tags or n_own == n_keys:  # every key of the batch is new
        return _one_row_each(rows, own, key, order)
    # by the keys taken down: they are settled, whatever is run again
    mine = own.select(F.col(key).alias("__mine"))
    if n_own <= FEW_KEYS:
        return dedup.keep_first(rows.join(F.broadcast(mine), F.col(key).eqNullSafe(F.col("__mine")), "left_semi"), [key], order)
    return dedup.keep_first(rows, [key], order).join(mine, F.col(key).eqNullSafe(F.col("__mine")), "left_semi")


def _perhaps_taken(spark: SparkSession, path: str, keys: DataFrame, key: str, batch_id: int) -> DataFrame:
    """The keys whose bit is set, as ``__key``: all that were taken and few others."""
    have = sizes(spark, path, batch_id)
    if not have:
        return keys.select(F.col(key).alias("__key"))
    bits_path, place = f"{path}_bits{have[-1]}", _place(key, have[-1])
    words = storage.read_runs(spark, bits_path, _before(spark, bits_path, batch_id), BITMAP)
    words = words.groupBy("word").agg(F.bitmap_or_agg("bits").alias("bits"))
    asked = keys.select(key, F.bitmap_bucket_number(place).alias("word"), F.bitmap_bit_position(place).alias("__at"))
    return asked.join(words, "word").filter(_bit_is_set(F.col("__at"))).select(F.col(key).alias("__key"))


def _one_row_each(rows: DataFrame, own: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The smallest row of each key of a batch that has new keys only."""
    copied = own.filter(COPIED).select(F.col(key).alias("__key"))
    n_copied = copied.count()
    if n_copied == 0:
        return rows
    if n_copied > FEW_KEYS:
        return dedup.keep_first(rows, [key], order)
    part = lambda how: rows.join(F.broadcast(copied), F.col(key).eqNullSafe(F.col("__key")), how)
    return part("left_anti").unionByName(dedup.keep_first(part("left_semi"), [key], order))


def _keep_bits(spark: SparkSession, path: str, own: DataFrame, key: str, kind: T.StructType, batch_id: int, n_keys: int) -> None:
    """Take down the bits of a batch's own keys, in a bitmap made anew if there
    is none that has room for all ``n_keys``; fold the runs before the batch once
    they are many."""
    tags, have = _before(spark, path, batch_id), sizes(spark, path, batch_id)
    bits = have[-1] if have else LEAST_BITS
    room = bits
    while room < MOST_BITS and n_keys * BITS_PER_KEY > 1 << room:
        room = min(MOST_BITS, room + 4)
    if len(tags) > MOST_RUNS:
        done = max(int(t[1:]) for t in tags)
        storage.publish_run(storage.read_runs(spark, path, tags, kind).drop("run").hint("rebalance"), path, _tag(done, "c"))
        if have and room == bits:
            bits_path = f"{path}_bits{bits}"
            words = storage.read_runs(spark, bits_path, _before(spark, bits_path, batch_id), BITMAP)
            whole = words.groupBy("word").agg(F.bitmap_or_agg("bits").alias("bits"))
            storage.publish_run(whole.hint("rebalance"), bits_path, _tag(done, "c"))
    if have and room == bits:
        storage.publish_run(_bitmap(own, key, bits), f"{path}_bits{bits}", _tag(batch_id))
        return
    tags = storage.live_runs([t for t in storage.published_runs(spark, path) if int(t[1:]) <= batch_id])
    whole = _bitmap(storage.read_runs(spark, path, tags, kind), key, room)
    storage.publish_run(whole, f"{path}_bits{room}", _tag(batch_id, "c"))
