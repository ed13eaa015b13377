"""Quality by importance resampling of hashed n-grams.

Two generative models over hashed n-grams are estimated: one of the target,
texts labelled good and not toxic, one of the raw text, all documents.  A text
has n-grams of three kinds, each kind a distribution of its own: runs of four
bytes; word shapes (length class, repeats the word before or the one before
that, upper case, ends in a letter), single and in pairs; and words, each once
a text.  The log importance weight adds up log p_target / p_raw over them, each
ratio capped at 1 beforehand: what is usual in good text earns nothing by
length, what the raw text has too much of costs.  Both models are smoothed
towards each other, so rare n-grams say nothing.  The sum over the first two
kinds is divided by the square root of their number, as its noise grows; the
weight is tempered.

Documents are then resampled without replacement by Gumbel top-k: weight plus
Gumbel noise drawn from the doc_id, of which the k largest stay.  k is the
number of documents whose weight is above a limit; the limit is where labelled
documents that took no part in the target model are told apart best.

Scale: two passes over the texts, which are never shuffled.  The target is a
sample of at most about ``target_docs`` good documents, chosen by a hash of the
doc_id, whose ids are broadcast (8 bytes each); the raw counts are of all
documents.  They are gathered as (bucket, count) rows, merged by bucket; the
driver gets one row for each bucket, histograms of weights and slice counts,
all of fixed size.  The k largest keys are found over 16-byte rows in slices of
equal size.

Defined results: a null or empty text has no n-grams and the weight 0.  Without
good labels there is no target: every weight is 0.  Without bad ones in the
held-out labels nothing is rejected.  Repeated rows share weight and key; where
they tie at the k-th place any of them goes.  A document labelled twice is
good only if all its labels are.  Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mark_first_k, possibly_in, stored, text_blocks, worker_cache
from .shingles import SEGMENT, mix, text_bytes, words

GRAM = 4
GRAM_BITS, SHAPE_BITS, WORD_BITS = 18, 12, 20
SHAPES, WORDS, BUCKETS = 1 << 18, (1 << 18) + (1 << 12), (1 << 18) + (1 << 12) + (1 << 20)
SMOOTHING = 5.0  # n-grams each model has seen of every bucket beforehand
TOLERANCE = 0.5  # a log ratio above minus this costs nothing
TEMPER = 50.0  # weights are that much wider than Gumbel noise
TARGET_DOCS = 100_000  # documents that the target model is fitted on, at most about
HELD_OUT = 4  # one labelled document in so many sets the limit
BIN = 0.05  # width of the histogram of weights, before tempering
LOWEST = -20.0  # lower weights share its last bin


def _kinds():
    """Bits of a byte: lower-case letter, upper-case letter."""
    import numpy as np

    byte = np.arange(256)
    return np.where((byte >= 97) & (byte <= 122), 1, np.where((byte >= 65) & (byte <= 90), 2, 0)).astype(np.uint8)


def grams(column):
    """(bucket of each byte n-gram, where each text's begin and end; two buckets
    of shapes for each word, -1 for none, where each text's begin and the last
    end; bucket of each text's words, where they begin and the last end)."""
    import numpy as np

    u = np.uint64
    data, bounds = text_bytes(column)
    lower = np.where((np.arange(256) >= 65) & (np.arange(256) <= 90), np.arange(256) + 32, np.arange(256)).astype(u)
    n = max(0, len(data) - GRAM + 1)
    code = np.zeros(n, dtype=u)
    for j in range(GRAM):
        code = (code << u(8)) | lower[data[j : j + n]]
    byte_gram = (mix(code + u(1)) >> u(64 - GRAM_BITS)).astype(np.int32)
    byte_starts = np.minimum(bounds[:-1], n)  # an empty text at the end has none
    byte_ends = np.maximum(byte_starts, np.minimum(bounds[1:] - GRAM + 1, n))  # none across texts

    hashes, first, sizes, bits, at = words(column, _kinds())
    again = lambda k: np.concatenate([np.zeros(min(k, len(hashes)), bool), hashes[k:] == hashes[:-k]])
    last = data[first + sizes - 1] if len(first) else np.empty(0, np.uint8)
    letter = (last >= 128) | ((last | 32) >= 97) & ((last | 32) <= 122)
    shape = ((np.minimum(sizes, 15) // 3 * 2 + again(1)) * 2 + again(2)) * 4 + (bits == 2) * 2 + letter
    pair = np.append(shape[:-1] * 1000 + shape[1:] + 1000, 0) if len(shape) else shape
    bucket = lambda x: (mix(x.astype(u) + u(1)) >> u(64 - SHAPE_BITS)).astype(np.int32)
    shapes = np.stack([bucket(shape), bucket(pair)], axis=1)
    if len(shapes):  # the last word of a text begins no pair
        shapes[at[1:][at[1:] > at[:-1]] - 1, 1] = -1
    hashes, *_, parts = words(column, letters=True)
    owner = np.repeat(np.arange(len(column), dtype=np.int64), np.diff(parts))
    once = np.unique((owner << WORD_BITS) | (hashes >> u(64 - WORD_BITS)).astype(np.int64))
    word = (once & (1 << WORD_BITS) - 1).astype(np.int32)
    return byte_gram, byte_starts, byte_ends, shapes, at, word, np.searchsorted(once >> WORD_BITS, np.arange(len(column) + 1))


def _counter(shared):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        worker_cache("quality")
        chosen_ids = shared.value
        raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in text_blocks(batches, limit=SEGMENT):
            ids = batch.column("doc_id")
            known = ids.is_valid().to_numpy(zero_copy_only=False)
            good = known & np.isin(ids.fill_null(0).to_numpy(), chosen_ids)
            byte_gram, a, b, shapes, at, word, parts = grams(batch.column("text"))
            for counts, chosen in ((raw, np.ones(len(good), bool)), (target, good)):
                if not chosen.any():
                    continue
                step = np.zeros(len(byte_gram) + 1, np.int8)
                np.add.at(step, a[chosen & (b > a)], 1)
                np.add.at(step, b[chosen & (b > a)], -1)
                inside = np.cumsum(step[:-1], dtype=np.int8) > 0
                counts[:SHAPES] += np.bincount(byte_gram[inside], minlength=SHAPES)
                of = np.repeat(chosen, np.diff(at))
                got = shapes[of].ravel()
                counts[SHAPES:WORDS] += np.bincount(got[got >= 0], minlength=WORDS - SHAPES)
                np.add.at(counts[WORDS:], word[np.repeat(chosen, np.diff(parts))], 1)
        found = np.flatnonzero(raw)
        for at in range(0, len(found), 65536):
            k = found[at : at + 65536]
            yield pa.RecordBatch.from_pydict({"bucket": pa.array(k, pa.int32()), "raw": raw[k], "target": target[k]})

    return run


def log_ratios(raw, target):
    """By bucket, the capped log ratio of the target's and the raw text's share."""
    import numpy as np

    out = np.zeros(len(raw), np.float32)
    for kind in (slice(0, SHAPES), slice(SHAPES, WORDS), slice(WORDS, BUCKETS)):
        if target[kind].sum():
            expected = raw[kind] * (target[kind].sum() / raw[kind].sum())
            ratio = np.log((target[kind] + SMOOTHING) / (expected + SMOOTHING))
            out[kind] = np.minimum(0, ratio + TOLERANCE)
    return out


def _weigher(shared):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        worker_cache("quality")
        ratio = shared.value
        sums = lambda values, a, b: np.append(0, np.cumsum(values))[np.stack([a, np.maximum(a, b)])]
        for batch in text_blocks(batches, limit=SEGMENT):
            byte_gram, a, b, shapes, at, word, parts = grams(batch.column("text"))
            low, high = sums(ratio[byte_gram].astype(np.float64), a, b)
            of = np.where(shapes >= 0, ratio[SHAPES + np.maximum(shapes, 0)], 0).sum(axis=1, dtype=np.float64)
            low2, high2 = sums(of, at[:-1], at[1:])
            low3, high3 = sums(ratio[WORDS + word].astype(np.float64), parts[:-1], parts[1:])
            n = np.maximum(0, b - a) + 2 * np.diff(at)
            weight = np.minimum(0, ((high - low) + (high2 - low2)) / np.sqrt(n + 1) + (high3 - low3))
            cols = {c: batch.column(c) for c in batch.schema.names if c != "text"}
            yield pa.RecordBatch.from_pydict(cols | {"weight": pa.array(np.round(weight, 9))})

    return run


def _limit(histogram) -> float:
    """The weight under which a document is rejected: fewest errors, as shares
    of the good and the bad; in the middle of equally good ones."""
    good, bad = {}, {}
    for r in histogram:
        (good if r["good"] else bad)[r["bin"]] = r["n"]
    if not good or not bad:
        return -math.inf
    n_good, n_bad = sum(good.values()), sum(bad.values())
    bins = range(min([*good, *bad]), max([*good, *bad]) + 2)
    lost, missed, best = 0, n_bad, []
    for at in bins:  # reject what lies in a bin below this one
        wrong = lost / n_good + missed / n_bad
        if not best or wrong < best[0]:
            best = [wrong, at]
        elif wrong == best[0] and at == best[-1] + 1:
            best.append(at)
        lost, missed = lost + good.get(at, 0), missed - bad.get(at, 0)
    return best[1 + (len(best) - 1) // 2] * BIN


def classify(docs: DataFrame, labels: DataFrame, target_docs: int = TARGET_DOCS, carried: tuple[str, ...] = ()) -> DataFrame:
    """Per row: doc_id, the columns ``carried`` (of longs), weight (log
    importance, 0 at best), key (weight, tempered, plus Gumbel noise) and kept
    (its key is among the k largest)."""
    import numpy as np

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *[F.col(c) for c in carried])
    known = (
        labels.filter("doc_id is not null and quality is not null")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg((F.min("quality") + F.min(-F.coalesce("toxic", F.lit(0))) >= 1).alias("good"))
        .withColumn("held", F.pmod(F.xxhash64("doc_id"), F.lit(HELD_OUT)) == 0)
    )
    target = known.filter("good and not held").select("doc_id")
    share = min(1.0, target_docs / max(1, target.count()))
    target = target.filter(F.pmod(F.xxhash64(F.lit("target"), "doc_id"), F.lit(1 << 40)) < int(share * (1 << 40)))
    chosen = docs.sparkSession.sparkContext.broadcast(np.sort(target.toArrow().column("doc_id").to_numpy()))
    counts = docs.mapInArrow(_counter(chosen), "bucket int, raw long, target long")
    got = counts.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toArrow()

    raw, wanted = (np.zeros(BUCKETS, np.int64) for _ in range(2))
    at = got.column("bucket").to_numpy()
    raw[at], wanted[at] = got.column("raw").to_numpy(), got.column("target").to_numpy()
    shared = docs.sparkSession.sparkContext.broadcast(log_ratios(raw, wanted))  # one float for each bucket
    columns = ", ".join(["doc_id long", *[f"{c} long" for c in carried], "weight double"])
    weighed = stored(docs.mapInArrow(_weigher(shared), columns), "weights")

    bins = F.floor(F.greatest("weight", F.lit(LOWEST)) / BIN).cast("int").alias("bin")
    limit = _limit(weighed.join(known.filter("held"), "doc_id").groupBy("good", bins).agg(F.count("*").alias("n")).collect())
    draw = (F.pmod(F.xxhash64(F.lit("gumbel"), "doc_id"), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    keyed = weighed.withColumn("key", F.col("weight") * TEMPER - F.log(-F.log(draw)))
    k = keyed.filter(F.col("weight") >= limit).count()
    return mark_first_k(keyed, k, F.col("key").desc(), F.col("doc_id").asc_nulls_last())


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rejected rows, all columns kept.  A decision is about
    a doc_id (null is one, too) and its text: another text of the same id has
    its own, rows equal in both go together."""
    text_hash = F.xxhash64(F.coalesce("text", F.lit("")))
    marked = classify(docs.select("doc_id", "text", text_hash.alias("text_hash")), labels, carried=("text_hash",))
    gone = marked.filter(~F.col("kept")).select(F.col("doc_id").alias("gone"), F.col("text_hash").alias("gone_hash"))
    gone = stored(gone.distinct(), "rejected")
    rows = possibly_in(docs, gone.select("gone"), "doc_id")
    own = F.xxhash64(F.coalesce(F.col("row.text"), F.lit("")))
    rest = rows.filter("possible").join(gone, F.col("id").eqNullSafe(F.col("gone")) & (own == F.col("gone_hash")), "left_anti")
    return rows.filter("not possible").select("row").unionByName(rest.select("row")).select("row.*")
