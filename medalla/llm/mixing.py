"""Mixing sources to target weights by Pareto order sampling.

Sources share a goal by their weights; none gets more than ``most_copies``
times its size, and what it can't take is shared among the others by weight,
until none is above.  A document's expected copies are its source's target
over the source's size (or in proportion to a weight of the document's own, at
most ``most_copies``).  The whole part are certain copies.  The rest is its
inclusion probability p for one copy more: with u uniform, from a hash of the
id, documents are ranked by their random odds u / (1 - u) divided by their
inclusion odds p / (1 - p), and the first in rank are taken up to a fixed size.
The size is fixed in words, not documents: one that would exceed what is left
of the source's target is passed over, so a source misses its target by less
than the smallest document passed over.  A document longer than all that the
certain copies leave gets no further copy.

Scale: texts are read once, for their sizes; what is sorted has a few numbers a
row.  The ranking is one global sort, so a source with a third of all rows is
cut into slices.  Taking in rank order goes by rounds: among the rows that
still fit, whole slices are taken by their sums and one slice is looked into,
up to the row that first exceeds the gap; passing it over starts the next round
with the smaller gap.  In a random order that takes about as many rounds as the
longest text has binary digits.  A source's rounds are a few numbers.

Defined results: a null or empty text has size 0, and so nothing of it is
taken; a null source is a source, the last one; a source without words has
target 0; rows with one id have one u and are ranked by their content; the
null id is an id; repeated rows are documents each; an empty table gives an
empty one.  Other columns may have any name.  Reruns agree.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import numbered, salted_join, stored

WEIGHTS = (3, 1, 2)  # of the sources in order, repeating
GOAL = 1.5  # times all sizes
MOST_COPIES = 2
MAX_ROUNDS = 200


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def uniform(key: Column, seed: str = "mix") -> Column:
    """A number between 0 and 1, both excluded, from 52 bits of a hash."""
    bits = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), key), 256), 1, 13), 16, 10).cast("long")
    return (bits + F.lit(0.5)) / F.lit(float(1 << 52))


def targets(sources: DataFrame, weights: Sequence[float] = WEIGHTS, goal: float = GOAL, most_copies: int = MOST_COPIES) -> DataFrame:
    """``sources`` (source, a non-null text, and source_size) with ``target``.
    The driver gets sums over all sources."""
    rows = numbered(sources.withColumn("all", F.lit("")), "all", "source").drop("all", "size")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("position") % len(weights) + 1).cast("int"))
    rows = stored(rows.withColumn("weight", weight), "sources")
    cap = F.col("source_size") * F.lit(most_copies)
    words, shares = rows.agg(F.sum("source_size"), F.sum("weight")).first()
    if words is None:
        return rows.select("source", "source_size", F.lit(0.0).alias("target"))
    level, full = goal * words / shares, None
    while True:  # the level rises, so a source once full stays full
        above = cap <= F.col("weight") * F.lit(level)
        n, held, rest = rows.agg(
            F.count_if(above), F.sum(F.when(above, cap).otherwise(0)), F.sum(F.when(~above, F.col("weight")).otherwise(0))
        ).first()
        if n == full or not rest:
            break
        level, full = (goal * words - held) / rest, n
    target = F.least(cap.cast("double"), F.col("weight") * F.lit(level))
    return rows.select("source", "source_size", target.alias("target"))


def expected_copies(rows: DataFrame, most_copies: int = MOST_COPIES) -> DataFrame:
    """``rows`` (source, size, weight, target) with ``expected``: copies in
    proportion to the weight, ``most_copies`` at most, that come to the target."""
    capped = F.col("weight") * F.col("rate") >= most_copies
    rates = None
    while True:
        now = rows.withColumn("rate", F.lit(0.0)) if rates is None else salted_join(rows, rates.select("source", "rate"), ["source"])
        held = F.sum(F.when(capped, F.col("size") * most_copies).otherwise(0))
        rest = F.sum(F.when(~capped, F.col("size") * F.col("weight")).otherwise(0.0))
        sums = now.groupBy("source").agg(held.alias("held"), rest.alias("rest"), F.max("target").alias("target"), F.count_if(capped).alias("n"))
        rate = F.when(F.col("rest") > 0, (F.col("target") - F.col("held")) / F.col("rest")).otherwise(F.lit(float(most_copies)))
        new = stored(sums.select("source", F.greatest(rate, F.lit(0.0)).alias("rate"), "n"), "rates")
        total = new.agg(F.sum("n")).first()[0]
        if rates is not None and total == rates.agg(F.sum("n")).first()[0]:
            return salted_join(rows, new.select("source", "rate"), ["source"]).withColumn(
                "expected", F.least(F.lit(float(most_copies)), F.col("weight") * F.col("rate"))
            ).drop("rate")
        rates = new


def take_in_rank(ranked: DataFrame, budgets: DataFrame) -> DataFrame:
    """``ranked`` (source, size, at: ascending in rank, its high bits a slice)
    with ``taken``: in each source, in rank order, whatever still fits into its
    budget (source, gap)."""
    state = stored(budgets.select("source", "gap", F.lit(-1).cast("long").alias("cut"), F.expr("array()").cast("array<struct<gap:long,since:long,to:long>>").alias("rounds"), F.lit(False).alias("done")), "gaps")
    slices = Window.partitionBy("source").orderBy("slice")
    for _ in range(MAX_ROUNDS):
        live = salted_join(ranked, state.filter("not done").select("source", "gap", "cut"), ["source"], "inner")
        fits = live.filter("at > cut and size <= gap").withColumn("slice", F.shiftright("at", 33))
        sums = fits.groupBy("source", "slice").agg(F.sum("size").alias("words"), F.first("gap").alias("gap"))
        upto = F.sum("words").over(slices.rowsBetween(Window.unboundedPreceding, 0))
        sums = stored(sums.withColumn("upto", upto), "slice-sums")
        # the first slice that does not fit as a whole
        over = sums.filter("upto > gap").groupBy("source").agg(F.min(F.struct("slice", F.expr("upto - words").alias("before"))).alias("o"))
        over = over.select("source", "o.slice", F.col("o.before").alias("before"))
        inside = fits.join(over, ["source", "slice"])
        run = F.sum("size").over(Window.partitionBy("source", "slice").orderBy("at").rowsBetween(Window.unboundedPreceding, 0))
        inside = inside.withColumn("run", run + F.col("before")).filter("run > gap")
        stop = inside.groupBy("source").agg(F.min(F.struct("at", F.expr("run - size").alias("words"))).alias("s"))
        stop = stop.select("source", F.col("s.at").alias("to"), F.col("s.words").alias("words"))
        new = state.join(stop, "source", "left")
        last = F.lit((1 << 63) - 1)
        step = F.struct(F.col("gap").alias("gap"), F.col("cut").alias("since"), F.coalesce("to", last).alias("to"))
        state = stored(
            new.select(
                "source",
                F.when(F.col("done"), F.col("gap")).otherwise(F.col("gap") - F.coalesce("words", F.lit(0))).alias("gap"),
                F.coalesce("to", "cut").alias("cut"),
                F.when(F.col("done"), F.col("rounds")).otherwise(F.concat("rounds", F.array(step))).alias("rounds"),
                (F.col("done") | F.col("to").isNull()).alias("done"),
            ),
            "gaps",
        )
        if state.filter("not done").isEmpty():
            break
    else:
        raise RuntimeError(f"still gaps to fill after {MAX_ROUNDS} rounds")
    met = salted_join(ranked, state.select("source", "rounds"), ["source"])
    return met.withColumn("taken", F.expr("exists(rounds, r -> at > r.since and at < r.to and size <= r.gap)")).drop("rounds")


def mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    goal: float = GOAL,
    most_copies: int = MOST_COPIES,
    document_weight: str | None = None,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, source_size, target, copies,
    taken (words) and ``content``, a hash of the whole row."""
    own = F.lit(1.0) if document_weight is None else F.greatest(F.coalesce(F.col(document_weight).cast("double"), F.lit(0.0)), F.lit(0.0))
    rows = docs.select(
        "doc_id",
        # ascending by code point, null last
        F.coalesce(F.concat(F.lit("0"), F.col("source")), F.lit("1")).alias("source"),
        n_words(F.col("text")).alias("size"),
        own.alias("weight"),
        F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]).alias("content"),
    )
    rows = stored(rows, "sizes")
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    goals = stored(targets(sources, weights, goal, most_copies), "targets")
    rows = salted_join(rows, goals, ["source"])
    if document_weight is None:  # never above most_copies: the target is not
        per_word = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
        rows = rows.withColumn("expected", per_word)
    else:
        rows = expected_copies(rows, most_copies)
    whole = F.floor("expected").cast("long")
    p = F.col("expected") - F.floor("expected")
    u = uniform(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    rows = rows.select(
        "doc_id", "source", "size", "source_size", "target", "content", whole.alias("certain"),
        F.when(p > 0, (u / (1 - u)) / (p / (1 - p))).alias("rank"),
    )
    rows = stored(rows, "expected")
    budgets = rows.groupBy("source").agg(F.floor(F.max("target") - F.sum(F.col("certain") * F.col("size"))).cast("long").alias("gap"))
    chosen = rows.filter("rank is not null and size > 0")
    order = ["source", "rank", F.col("doc_id").asc_nulls_first(), "content", F.monotonically_increasing_id()]
    ranked = stored(chosen.sort(*order).checkpoint().withColumn("at", F.monotonically_increasing_id()), "ranked")
    more = take_in_rank(ranked, budgets).withColumn("copies", F.col("certain") + F.col("taken").cast("long"))
    rest = rows.filter("rank is null or size = 0").withColumn("copies", F.col("certain"))
    cols = ["doc_id", "size", "source_size", "target", "copies", F.expr("copies * size").alias("taken"), "content"]
    return more.select(*cols).unionByName(rest.select(*cols))


def mixed(docs: DataFrame, plan: DataFrame) -> DataFrame:
    """The mixed rows themselves: each of ``docs`` as often as ``plan`` (of the
    same rows, by ``mix``) says, with ``copy`` from 0."""
    alike = plan.groupBy("content").agg(F.sum("copies").alias("n")).filter("n > 0")
    rows = docs.select(F.struct("*").alias("row"), F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]).alias("content"))
    out = rows.dropDuplicates(["content"]).join(alike, "content")
    copy = F.explode(F.sequence(F.lit(0), F.col("n").cast("int") - 1)).alias("copy")
    return out.select("row", copy).select("row.*", "copy")
