"""Document fingerprints from closed syncmers, in DataFrame functions only.

A text's units are its runs without white space, and each ideograph by itself.
Every k consecutive units are a k-mer; it is an anchor, a closed syncmer, if
the smallest hash among the s-mers inside it is that of its first or its last
one.  That depends on the k-mer alone and not on what surrounds it, so a
passage has the same anchors in whatever text it stands, and their unit
positions line passages of two texts up.  A share 2 / (k - s + 1) of all k-mers
are anchors, and no window of k - s + 1 k-mers is without one.

The fingerprint is a sketch of the whole text: the ``sketch`` smallest distinct
32-bit anchor hashes, ascending, as 8 hex digits each.  The likeness of two
fingerprints is the share of the ``sketch`` smallest hashes of both that both
have: the Jaccard similarity of the anchor sets, exact if they are no larger
than the sketch, an estimate from the smallest hashes otherwise.

Scale: a text is hashed where it is read.  For ``against_next`` the order of
the documents is settled over 24-byte rows in slices of equal size; the texts
are shuffled once by document and the lent beginnings, a third of them, once.

Defined results: a null or empty text, or one of white space, has no anchors
and the fingerprint ''; two such are alike (1.0), and unlike (0.0) any other;
fewer than k units are one anchor together.  Columns other than ``doc_id`` and
``text`` are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import in_slices

K, S = 4, 2
SKETCH = 128

#: Units: one ideograph, or a run of anything else without white space.
UNIT = r"\p{IsIdeographic}|[^\s\p{IsIdeographic}]+"


def _let(df: DataFrame, **columns: Column) -> DataFrame:
    """Columns computed once for each row: an expression that lambdas use
    would otherwise be merged into them and run for each element."""
    for name, column in columns.items():
        df = df.withColumn(name, F.explode(F.array(column)))
    return df


def with_anchors(df: DataFrame, text: str, out: str, k: int = K, s: int = S) -> DataFrame:
    """``df`` with ``out``: array<struct<position int, hash int>>, the anchors
    of the column ``text`` in order."""
    df = _let(df, __h=F.transform(F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(UNIT), F.lit(0)), lambda u: F.xxhash64(u)))
    up_to = lambda n: F.when(F.size("__h") >= n, F.sequence(F.lit(0), F.size("__h") - n)).otherwise(F.expr("array()"))
    hashed = lambda i, n: F.xxhash64(*[F.get(F.col("__h"), i + j) for j in range(n)])
    df = _let(df, __s=F.transform(up_to(s), lambda i: hashed(i, s)))
    at = lambda i, j: F.get(F.col("__s"), i + j)
    inner = range(1, k - s)

    def closed(i: Column) -> Column:
        edge = F.least(at(i, 0), at(i, k - s))
        found = F.lit(True)
        for j in inner:
            found = found & (edge <= at(i, j))
        return found

    short = F.array(F.struct(F.lit(0).alias("position"), F.shiftright(F.xxhash64("__h"), 32).cast("int").alias("hash")))
    many = F.transform(
        F.filter(up_to(k), closed),
        lambda i: F.struct(i.alias("position"), F.shiftright(hashed(i, k), 32).cast("int").alias("hash")),
    )
    anchors = F.when(F.size("__h") >= k, many).when(F.size("__h") > 0, short).otherwise(F.slice(short, 1, 0))
    return _let(df, **{out: anchors}).drop("__h", "__s")


def with_sketch(df: DataFrame, text: str, out: str, sketch: int = SKETCH, k: int = K, s: int = S) -> DataFrame:
    """``df`` with ``out``: array<int>, the smallest anchor hashes."""
    hashes = F.sort_array(F.array_distinct(F.col(f"__{out}.hash")))
    return _let(with_anchors(df, text, f"__{out}", k, s), **{out: F.slice(hashes, 1, sketch)}).drop(f"__{out}")


def fingerprint(sketch: str) -> Column:
    return F.array_join(F.transform(sketch, lambda h: F.lower(F.lpad(F.hex(h.cast("long").bitwiseAND(0xFFFFFFFF)), 8, "0"))), "")


def likeness(a: str, b: str, sketch: int = SKETCH) -> Column:
    least = F.slice(F.sort_array(F.array_union(a, b)), 1, sketch)
    both = F.size(F.array_intersect(F.array_intersect(F.col(a), F.col(b)), least))
    return F.when(F.size(least) == 0, F.lit(1.0)).otherwise(both / F.size(least))


def next_documents(keys: DataFrame) -> DataFrame:
    """``keys`` (doc_id, h, n; no row twice) with next_id and next_h: the row
    after it in descending order, for the last one the first."""
    order = [F.col("doc_id").desc_nulls_last(), F.col("h").desc()]
    sliced = in_slices(keys, *order)
    heads = sorted((r["slice"], r["head"]) for r in sliced.groupBy("slice").agg(F.max(F.struct("doc_id", "h")).alias("head")).collect())
    after = [(at, *heads[(i + 1) % len(heads)][1]) for i, (at, _) in enumerate(heads)]  # one for each slice
    after = keys.sparkSession.createDataFrame(after, "slice int, first_id long, first_h long")
    w = Window.partitionBy("slice").orderBy(*order)
    led = sliced.withColumn("led", F.lead(F.struct("doc_id", "h")).over(w)).join(F.broadcast(after), "slice")
    next_id = F.when(F.col("led").isNull(), F.col("first_id")).otherwise(F.col("led.doc_id"))
    next_h = F.when(F.col("led").isNull(), F.col("first_h")).otherwise(F.col("led.h"))
    return led.select("doc_id", "h", "n", next_id.alias("next_id"), next_h.alias("next_h"))


def against_next(docs: DataFrame, sketch: int = SKETCH) -> DataFrame:
    """Per row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited and near_next.  The edited text has its last third replaced by
    the beginning of the next document's; documents are ordered by descending
    doc_id (those without one last), then by a hash of the text, and equal
    rows are one document in that order."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    # id and h are never null, so that grouping and joins by them share one partitioning
    hashed = F.when(F.col("doc_id").isNull(), F.xxhash64(F.lit("no id"), "text")).otherwise(F.xxhash64("text"))
    following = next_documents(texts.select("doc_id", hashed.alias("h"), F.char_length("text").alias("n")).distinct())
    # read by two joins with the same columns, so that one shuffle of the texts serves both
    texts = texts.select(F.coalesce("doc_id", F.lit(0)).alias("id"), hashed.alias("h"), "text")
    # each document lends the one before it its beginning and its sketch
    asked = following.select(
        F.coalesce("next_id", F.lit(0)).alias("id"),
        F.col("next_h").alias("h"),
        F.coalesce("doc_id", F.lit(0)).alias("to_id"),
        F.col("h").alias("to_h"),
        F.col("doc_id").alias("to_doc"),
        F.floor(F.col("n") / 3).cast("int").alias("asked"),
    )
    lent = with_sketch(texts.join(asked, ["id", "h"]), "text", "next", sketch)
    lent = lent.select(
        F.col("to_id").alias("id"),
        F.col("to_h").alias("h"),
        F.col("to_doc").alias("doc_id"),
        F.substring("text", F.lit(1), F.col("asked")).alias("beginning"),
        "next",
    )
    lent = lent.groupBy("id", "h").agg(*[F.any_value(c).alias(c) for c in ("doc_id", "beginning", "next")])
    both = with_sketch(texts.join(lent, ["id", "h"]).drop("id", "h"), "text", "own", sketch)  # every document has a next one
    n = F.char_length("text")
    kept = F.substring(F.col("text"), F.lit(1), (n - F.floor(n / 3)).cast("int"))
    both = _let(both.withColumn("n_chars", n.cast("long")), edited=F.concat(kept, "beginning")).drop("text", "beginning")
    both = with_sketch(both, "edited", "new", sketch)
    return both.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint("own").alias("fingerprint"),
        fingerprint("new").alias("edited_fingerprint"),
        likeness("own", "new", sketch).alias("near_edited"),
        likeness("own", "next", sketch).alias("near_next"),
    )
