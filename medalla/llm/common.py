"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
import sys
import types
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import checkpoint_root

#: Bytes of text that a Python task works on at once (one longer text is a block of its own).
BLOCK_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder under the cluster's shared ``spark.checkpoint.dir``."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as written to, and read from, a table in the shared folder: it
    cuts the lineage, and a lost executor costs no recomputation."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def worker_cache(owner: str) -> dict:
    """A dict that lives as long as the Python worker process, whatever task
    asks: the package's functions travel by value, so their module's globals
    are new in each task.  A reused worker holds things of one operator at a
    time: when another one asks, what the last one kept is given back.  What
    a task asked for and freed goes back to the system when the next one asks."""
    holder = sys.modules.setdefault("medalla_worker_cache", types.ModuleType("medalla_worker_cache"))
    if getattr(holder, "owner", None) != owner:
        holder.owner, holder.kept = owner, {}
        gc.collect()
    give_back()
    return holder.kept


def give_back() -> None:
    """Returns freed memory of this process, which its allocators keep, to the system."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def text_blocks(batches, column: str = "text", limit: int = BLOCK_BYTES) -> Iterator:
    """Each Arrow batch in slices of about ``limit`` bytes of text."""
    import numpy as np
    import pyarrow.compute as pc

    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            done = int(ends[at - 1]) if at else 0
            to = max(at + 1, int(np.searchsorted(ends, done + limit, side="right")))
            yield batch.slice(at, to - at)
            at = to


def in_slices(df: DataFrame, *order) -> DataFrame:
    """``df`` globally sorted in a checkpoint, with the column ``slice``: the
    number of its contiguous, ascending share of the rows.  Slices are about
    equally large whatever the keys are like, and read from the checkpoint
    they stay what they are when an executor is lost."""
    checkpoint_root(df.sparkSession)
    return df.sort(*order).checkpoint().withColumn("slice", F.spark_partition_id())


def numbered(df: DataFrame, group: str, *order) -> DataFrame:
    """``df`` with ``position``, a row's number from 0 among those with the same
    (non-null) ``group`` in that order, and ``size``, how many those are.
    Nothing is grouped but one row for each slice and group: a checkpoint of
    the sorted rows gives each row its number in its slice.  Rows equal in all
    of the order stand in any order."""
    checkpoint_root(df.sparkSession)
    kept = df.sort(group, *order, F.monotonically_increasing_id()).checkpoint()
    rows = kept.withColumn("__at", F.monotonically_increasing_id())
    rows = rows.withColumn("__slice", F.shiftright("__at", 33)).withColumn("__at", F.expr("__at & 8589934591"))
    runs = rows.groupBy("__slice", group).agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__n"))
    every = Window.partitionBy(group)
    before = F.sum("__n").over(every.orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.select(
        "__slice", group, (F.coalesce(before, F.lit(0)) - F.col("__first")).alias("__shift"), F.sum("__n").over(every).alias("size")
    )
    out = rows.join(runs, ["__slice", group])
    return out.select(*[F.col(c) for c in df.columns], (F.col("__at") + F.col("__shift")).alias("position"), "size")


def mark_first_k(df: DataFrame, k: int, *order) -> DataFrame:
    """``df`` with ``kept``: whether a row is among the first ``k`` in that
    order, exactly, without a task that sees all: every row of the slices
    before the one in which row ``k`` lies, and of that one those up to ``k``.
    The driver gets one count for each slice."""
    sliced = in_slices(df, *order)
    counts = sorted((r["slice"], r["count"]) for r in sliced.groupBy("slice").count().collect())
    left, at = k, None
    for at, n in counts:
        if n >= left:
            break
        left -= n
    here = F.col("slice") == F.lit(at)
    place = F.row_number().over(Window.partitionBy("slice").orderBy(*order))
    part = sliced.filter(here).withColumn("kept", place <= left)
    rest = sliced.filter(~here).withColumn("kept", F.col("slice") < F.lit(at))
    return rest.unionByName(part).drop("slice") if counts else df.withColumn("kept", F.lit(False))


def salted_join(many: DataFrame, few: DataFrame, keys: list[str], how: str = "left", salts: int = 16) -> DataFrame:
    """``many`` with ``few``, which has a row for each key at most: a hot key's
    rows of ``many`` are dealt over ``salts`` tasks, and ``few`` is repeated."""
    spread = F.pmod(F.xxhash64(*[F.col(c) for c in many.columns]), F.lit(salts)).cast("int")
    left = many.withColumn("__salt", spread)
    right = few.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, [*keys, "__salt"], how).drop("__salt")


#: Bits of the bitmap that stands for a set of ids: its table has at most 2**18 rows.
LEAST_BITS, MOST_BITS = 16, 24


def possibly_in(df: DataFrame, ids: DataFrame, column: str) -> DataFrame:
    """Rows of ``df`` as the struct ``row``, with ``id`` (the column) and
    ``possible``: false only if the id is surely not among ``ids`` (one column,
    any number of rows).  A bitmap of the ids' hashes of bounded size is
    broadcast; with more ids than it can tell apart more rows are possible."""
    bits = min(MOST_BITS, max(LEAST_BITS, (16 * ids.count()).bit_length()))
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(1 << bits))
    words = ids.select(place(ids.columns[0]).alias("p")).groupBy(F.expr("shiftright(p, 6)").alias("word"))
    words = words.agg(F.expr("bit_or(shiftleft(1L, cast(p & 63 as int)))").alias("bits"))
    rows = df.select(F.struct("*").alias("row"), F.col(column).alias("id"), place(column).alias("p"))
    met = rows.join(F.broadcast(words), F.expr("shiftright(p, 6) = word"), "left")
    return met.select("row", "id", F.coalesce(F.expr("bit_get(bits, cast(p & 63 as int)) = 1"), F.lit(False)).alias("possible"))


def without_ids(df: DataFrame, ids: DataFrame, column: str = "doc_id") -> DataFrame:
    """``df`` without the rows whose ``column`` is among ``ids``; only rows for
    which that is possible are shuffled."""
    ids = stored(ids.distinct(), "ids")
    marked = possibly_in(df, ids, column)
    rest = marked.filter("possible").join(ids.withColumnRenamed(ids.columns[0], "gone"), F.col("id") == F.col("gone"), "left_anti")
    return marked.filter("not possible").select("row").unionByName(rest.select("row")).select("row.*")


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for the nodes of undirected ``edges`` (a, b long):
    component is the smallest node reachable.

    Union-find over a table: each round hooks every root to the smallest root
    among its neighbours and then halves the paths to the roots.  Edges are
    rewritten to the roots of their ends, and those within one tree go, so the
    edge table shrinks from round to round.  Everything is grouped with partial
    aggregates and joined by key; rounds are cut by a checkpoint.
    """
    spark = edges.sparkSession
    checkpoint_root(spark)
    pair = lambda a, b: [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]
    live = edges.filter("a <> b").select(*pair(F.col("a"), F.col("b"))).distinct().checkpoint()
    nodes = live.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    parents = nodes.select("node", F.col("node").alias("component")).checkpoint()
    for _ in range(max_rounds):
        if live.isEmpty():
            break
        # each root's smallest neighbour: a hot root's edges meet as partial minima
        both = live.select("a", "b").unionByName(live.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = both.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("root"), F.least("a", "low").alias("low"))
        # a root that is nobody's smaller neighbour stays; the hooks point downwards, so follow them to their ends
        hook = hook.checkpoint()
        while True:
            nxt = hook.alias("h").join(hook.select(F.col("root").alias("r2"), F.col("low").alias("low2")), F.col("low") == F.col("r2"), "left")
            nxt = nxt.select("root", F.coalesce("low2", "low").alias("low2"), "low").checkpoint()
            moved = not nxt.filter("low2 <> low").isEmpty()
            hook = nxt.select("root", F.col("low2").alias("low"))
            if not moved:
                break
        parents = (
            parents.join(hook, F.col("component") == F.col("root"), "left")
            .select("node", F.coalesce("low", "component").alias("component"))
            .checkpoint()
        )
        one = live.join(hook.select(F.col("root").alias("a"), F.col("low").alias("la")), "a", "left")
        two = one.join(hook.select(F.col("root").alias("b"), F.col("low").alias("lb")), "b", "left")
        live = (
            two.select(*pair(F.coalesce("la", "a"), F.coalesce("lb", "b"))).filter("a <> b").distinct().checkpoint()
        )
    else:
        if not live.isEmpty():
            raise RuntimeError(f"components not settled after {max_rounds} rounds")
    return parents
