"""Near-duplicate documents by SuperMinHash, banding, verification and union-find.

A document's set is its distinct shingles of five words.  SuperMinHash gives
each shingle a random permutation of the signature's slots and, in that order,
ranks 0 + r, 1 + r', ...; a slot keeps the smallest rank any shingle gives it.
Ranks of one shingle are correlated, which lowers the variance of the
estimate, and no rank beyond the largest one kept can matter, so most sets
stop after a few of the slots.

1. One pass over the texts: set size, digest of the set, and the hashes of the
   signature's bands, written to the shared folder.
2. Documents with equal sets are one class, named by its smallest doc_id;
   only classes go on, so exact copies cost nothing further.
3. Classes that share a band meet in a bucket.  A bucket compares its members
   with its smallest one, not all with all.  These pairs are verified on the
   full shingle sets, computed anew for the classes concerned.
4. Union-find over the verified links.  In a bucket whose other members are in
   one component then, no further link can change a component.  The classes of
   mixed buckets are compared across components, and which ones of them is
   settled exactly, not by enumerating a bucket: with its shingles ordered from
   the rarest to the most common, a set similar enough to one no smaller shares
   a shingle of its first 1 - 2t/(1+t) part with the other's first 1 - t part,
   far enough in front for both.  Texts kept apart by what they have to
   themselves begin with that, and so meet nobody.

With 32 bands of 4 slots a pair at the similarity itself, 0.75, is missed with
probability 5e-6, a closer one less often.  No link is lost to a cap.

Scale: texts are never shuffled.  Bands travel as 16-byte rows, shingle sets
only for classes in a shared bucket, which a pass over the texts finds by a
bitmap of bounded size and a join then makes exact.  A hot bucket or class is
met by partial aggregates, by skew-joins, and by dealing the pairs of a busy
smallest member over salts.

Defined results: a document without words has an empty set and is linked with
nothing; with fewer than five words its sequence is its one shingle.  Rows
without a doc_id are linked with nothing, have no component and are kept.
Repeated rows share class and component.  Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, possibly_in, salted_join, stored, text_blocks, without_ids, worker_cache
from .shingles import SEGMENT, mix, shingle_sets

WORDS = 5
PERCENT = 75
BANDS, ROWS = 32, 4
#: Size of the table of shingle frequencies.
FREQUENCY_BITS = 20
#: Pairs of one smallest member that one task verifies.
PAIRS_PER_SALT = 256

SIGNED = "doc_id long, n_shingles long, digest binary, bands array<long>"


def super_min_hash(sets, slots: int):
    """The signature of each set: 64-bit ranks, step number above 32 random bits."""
    import numpy as np

    u = np.uint64
    unset = np.iinfo(u).max
    out = np.full((len(sets), slots), unset, dtype=u)
    flat = out.reshape(-1)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    all_elements = np.concatenate([np.empty(0, u), *sets])
    for at in range(0, len(all_elements), 1 << 16):  # any order of elements gives the same minima
        elements, own = all_elements[at : at + (1 << 16)], owner[at : at + (1 << 16)]
        order = np.tile(np.arange(slots, dtype=np.uint8 if slots <= 256 else np.uint16), (len(elements), 1))
        for step in range(slots):
            draw = mix(elements + u((step + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
            row = np.arange(len(elements))
            pick = step + ((draw & u(0xFFFFFFFF)) * u(slots - step) >> u(32)).astype(np.int64)
            slot = order[row, pick]
            order[row, pick] = order[:, step]
            np.minimum.at(flat, own * slots + slot, (u(step) << u(32)) | (draw >> u(32)))
            # a set whose largest rank lies below the next step is done
            going = out.max(axis=1)[own] >= u(step + 1) << u(32) if step < 2 or step % 4 == 3 else None
            if going is not None and not going.all():
                elements, own, order = elements[going], own[going], order[going]
                if not len(elements):
                    break
    return out


def _signer(words: int, bands: int, rows: int):
    def run(batches):
        import hashlib

        import numpy as np
        import pyarrow as pa

        worker_cache("near-duplicates")
        for batch in text_blocks(batches, limit=SEGMENT):
            sets = shingle_sets(batch.column("text"), words)
            ranks = super_min_hash(sets, bands * rows).reshape(len(sets), bands, rows)
            keys = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (len(sets), bands)).copy()
            for r in range(rows):
                keys = mix(keys * np.uint64(0xD6E8FEB86659FD93) + ranks[:, :, r])
            empty = [not len(s) for s in sets]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                    "digest": pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                    "bands": pa.array([None if e else k for e, k in zip(empty, keys.view(np.int64))], pa.list_(pa.int64())),
                }
            )

    return run


def _setter(words: int):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        worker_cache("near-duplicates")
        for batch in text_blocks(batches, limit=SEGMENT):
            sets = [s.view(np.int64) for s in shingle_sets(batch.column("text"), words)]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "set": pa.array(sets, pa.list_(pa.int64()))})

    return run


def _sets(docs: DataFrame, classes: DataFrame, words: int) -> DataFrame:
    """(class, set) of these classes.  The texts stay where they are read: a
    bitmap lets through the classes and a few others, the join drops those."""
    some = possibly_in(docs, classes.select("class"), "doc_id").filter("possible").select("row.doc_id", "row.text")
    found = some.mapInArrow(_setter(words), "doc_id long, set array<long>")
    found = found.join(classes.select("class"), F.col("doc_id") == F.col("class")).select("class", "set")
    return stored(found, "shingle-sets")


def _fits(a: str, b: str, percent: int) -> str:
    """Sets of these sizes can reach the similarity."""
    return f"100 * least({a}, {b}) >= {percent} * greatest({a}, {b})"


def _verified(sets: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of classes whose full sets are similar enough."""
    # the pairs of a busy class are dealt over salts, its set is repeated for each
    salts = pairs.groupBy("a").agg(F.ceil(F.count("*") / PAIRS_PER_SALT).cast("int").alias("salts"))
    left = (
        salts.join(sets.withColumnRenamed("class", "a").withColumnRenamed("set", "set_a"), "a")
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
        .drop("salts")
    )
    right = (
        pairs.join(salts, "a")
        .withColumn("salt", F.pmod(F.xxhash64("b"), F.col("salts")).cast("int"))
        .select("a", "salt", "b")
        .join(sets.withColumnRenamed("class", "b").withColumnRenamed("set", "set_b"), "b")
    )
    shared = F.size(F.array_intersect("set_a", "set_b"))
    both = right.join(left, ["a", "salt"]).withColumn("shared", shared)
    return both.filter(F.lit(100) * F.col("shared") >= percent * (F.size("set_a") + F.size("set_b") - F.col("shared"))).select(
        "a", "b"
    )


def _fronter(shared, percent: int):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        frequency = shared.value
        for batch in batches:
            names, values = ("class", "n", "token", "place", "short"), ([], [], [], [], [])
            for name, s in zip(batch.column("class").to_pylist(), batch.column("set")):
                s, n = s.values.to_numpy(), len(s)
                long = n - -(-percent * n // 100) + 1
                short = n - -(-2 * percent * n // (100 + percent)) + 1
                first = s[np.lexsort((s, frequency[s & (1 << FREQUENCY_BITS) - 1]))[:long]]
                columns = (np.full(long, name), np.full(long, n), first, np.arange(1, long + 1), np.arange(1, long + 1) <= short)
                for out, column in zip(values, columns):
                    out.append(column)
            if values[0]:
                yield pa.RecordBatch.from_pydict({k: pa.array(np.concatenate(v)) for k, v in zip(names, values)})

    return run


def _across(sets: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Every pair (a, b) of ``classes`` (class, component) in different
    components that can be similar enough, and few others."""
    import numpy as np

    each = sets.select(F.explode("set").alias("token")).groupBy(F.expr(f"token & {(1 << FREQUENCY_BITS) - 1}").alias("bucket"))
    counted = each.agg(F.count("*").alias("n")).toArrow()
    frequency = np.zeros(1 << FREQUENCY_BITS, np.int32)
    frequency[counted.column("bucket").to_numpy()] = np.minimum(counted.column("n").to_numpy(), np.iinfo(np.int32).max)
    shared = sets.sparkSession.sparkContext.broadcast(frequency)  # 4 MB whatever the input
    fronts = sets.mapInArrow(_fronter(shared, percent), "class long, n long, token long, place long, short boolean")
    fronts = stored(fronts.join(classes, "class"), "set-fronts")

    of_token = fronts.groupBy("token", "component").agg(F.count("*").alias("n"))
    mixed = of_token.groupBy("token").agg(F.max_by("component", "n").alias("major"), F.count("*").alias("parts")).filter("parts > 1")
    # at least one of a pair is outside the token's largest component, so that is never compared with itself
    x = fronts.join(mixed.select("token", "major"), "token")
    y = x.filter("component <> major").select("token", *[F.col(c).alias(f"{c}_2") for c in ("class", "n", "component", "place", "short")])
    met = x.join(y, "token").filter("component <> component_2 and (component = major or class < class_2)")
    met = met.filter("(short and n <= n_2) or (short_2 and n_2 <= n)")
    met = met.filter(f"(least(n - place, n_2 - place_2) + 1) * (100 + {percent}) >= {percent} * (n + n_2)").filter(_fits("n", "n_2", percent))
    return met.select(F.least("class", "class_2").alias("a"), F.greatest("class", "class_2").alias("b")).distinct()


def near_duplicates(
    docs: DataFrame, words: int = WORDS, percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (smallest doc_id reachable by
    links of at least ``percent`` % similarity) and kept (it is that one)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = stored(docs.mapInArrow(_signer(words, bands, rows), SIGNED), "signatures")
    named = signed.filter("n_shingles > 0 and doc_id is not null")
    first = named.groupBy("digest").agg(F.min("doc_id").alias("class"))
    classes = (
        named.join(first.withColumnRenamed("digest", "d"), (F.col("digest") == F.col("d")) & (F.col("doc_id") == F.col("class")))
        .select("class", F.col("n_shingles").alias("n"), "bands")
    )
    spread = classes.select("class", "n", F.explode("bands").alias("key"))
    met = spread.groupBy("key").agg(F.min("class").alias("least"), F.max("class").alias("most")).filter("least < most")
    members = stored(spread.join(met.select("key", "least"), "key"), "buckets")

    starred = members.filter("class <> least").select(F.col("least").alias("a"), F.col("class").alias("b"), "n").distinct()
    sizes = members.select(F.col("class").alias("a"), F.col("n").alias("n_a")).distinct()
    starred = stored(starred.join(sizes, "a").filter(_fits("n", "n_a", percent)).select("a", "b"), "pairs")
    needed = stored(starred.select(F.explode(F.array("a", "b")).alias("class")).distinct(), "classes-met")
    links = stored(_verified(_sets(docs, needed, words), starred, percent), "links")
    joined = components(links)

    # the smallest member is compared with all; others that aren't connected yet are compared across components
    others = members.filter("class <> least").join(joined.withColumnRenamed("node", "class"), "class", "left")
    others = others.select("key", "class", F.coalesce("component", "class").alias("component"))
    mixed = others.groupBy("key").agg(F.min("component").alias("one"), F.max("component").alias("other")).filter("one <> other")
    apart = stored(others.join(mixed.select("key"), "key").select("class", "component").distinct(), "classes-apart")
    if not apart.isEmpty():
        sets = _sets(docs, apart, words)
        more = stored(_across(sets, apart, percent).join(starred, ["a", "b"], "left_anti"), "pairs")
        links = links.unionByName(_verified(sets, more, percent))
        joined = components(links)

    of_set = first.join(joined, F.col("class") == F.col("node"), "left").select(
        "digest", F.coalesce("component", "class").alias("component_id")
    )
    placed = salted_join(signed.select("doc_id", "n_shingles", "digest"), of_set, ["digest"])
    # an empty set is linked with nothing
    placed = placed.withColumn("component_id", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")))
    placed = placed.withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.col("component_id")))
    return placed.select("doc_id", "n_shingles", "component_id", F.coalesce(F.expr("doc_id = component_id"), F.lit(True)).alias("kept"))


def deduplicated(docs: DataFrame) -> DataFrame:
    """``docs`` with the smallest doc_id of each group, all columns kept."""
    return without_ids(docs, near_duplicates(docs).filter(~F.col("kept")).select("doc_id"))
