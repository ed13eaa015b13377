"""Line dedup by log templates: recurring templates across documents go.

A line's place in the template tree is its number of tokens, then its leading
``LEAD`` tokens, then the rest.  Tokens with a digit are variable fields from
the start.  Further variable fields are found by generalising: the tokens
after the leading ones are cut into ``FIELDS`` runs, and a line of at least
``LEAD`` + ``MIN_REST`` tokens also belongs to the templates that leave any
one of these runs open, so lines that differ within one run meet.  The tree is
of fixed depth and each node a hash of the path to it, so lines meet by
grouping, in any order, without a task that holds a part of the tree.

Shorter lines say less, so chance brings them together sooner.  They too belong
to templates with open fields, of one run or two after the leading tokens (of
which there are ``SHORT_LEAD`` from five tokens on), where half the tokens or
more stay fixed, but these ask for ``SHORT_FAMILIES`` families in place of two.
So does a line of less than ``MIN_TOKENS`` tokens as a whole; if all its tokens
have digits, they are none of them variable.

A template recurs if it is in two families of documents (or
``SHORT_FAMILIES``) or more, whatever the number of copies in each.  A family is what near-duplicate detection would put
together: a text's sketch is its smallest shingle in each of ``BANDS * ROWS``
random orders, texts with one sketch are a unit, and units that share a band of
``ROWS`` values and agree in ``AGREE`` values or more are joined, also through
others.  Of a recurring template, the lines in the family of the document with
the smallest doc_id stay, so that its copies are not taken line by line but
left to near-duplicate detection, and those in all other documents are dropped.
Two texts whose shingle sets are similar by 0.75 are one family in 98 of 100
cases, by 0.9 in all but one of a million, by 0.3 in one of 10,000.

Scale: texts are read once and only their lines' hashes are shuffled, grouped
with partial aggregates; after the first grouping only keys seen in two units
and the sketches of their texts go on.  Units of a band meet at the smallest
one, so a group of copies makes a row for each, not for each pair.  The line
numbers to drop come back to the texts by one join, which only texts that may
lose a line go through.
A template in a third of all documents is a hot key of small rows, dealt over
salts.

Defined results: a null text has one empty line and stays null; lines without
a token are never dropped; repeated lines within one
document are no recurrence; rows equal in doc_id and text are one document;
rows without a doc_id come after all others.  Only ``doc_id`` and ``text`` are
read; all columns are handed on in the struct ``row``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import components, possibly_in, salted_join, stored, text_blocks, worker_cache
from .shingles import SEGMENT, mix, text_bytes, words

LEAD, FIELDS, MIN_REST, MIN_TOKENS = 3, 4, 8, 3
SHINGLE = 5
SHORT_LEAD, SHORT_FAMILIES = 2, 10
NEWLINE = 10
BANDS, ROWS, AGREE = 12, 3, 22

LINES = "doc_id long, text_hash long, unit long, line int, keys array<long>, sketch array<int>"


def _digits():
    import numpy as np

    byte = np.arange(256)
    return ((byte >= 48) & (byte <= 57)).astype(np.uint8)


def sketches(hashes, at):
    """Of each text (a row) the smallest shingle in each of the orders; texts without a word are alike."""
    import numpy as np

    u = np.uint64
    rolled = np.zeros(len(hashes), dtype=u)
    for j in range(SHINGLE):  # shorter at the end: shingles across texts are cut off below
        n = max(0, len(hashes) - j)
        rolled[:n] = rolled[:n] * u(0xD6E8FEB86659FD93) + hashes[j:]
    at = np.asarray(at)
    n = np.diff(at)
    own = np.where(np.repeat(n < SHINGLE, n), hashes, rolled)  # a text shorter than a shingle has its words
    inside = np.arange(len(hashes)) - np.repeat(at[:-1], n) < np.repeat(np.where(n < SHINGLE, n, n - SHINGLE + 1), n)
    own = mix(own[inside])
    start = np.append(0, np.cumsum(np.where(n < SHINGLE, n, n - SHINGLE + 1)))[:-1][n > 0]
    low = np.zeros((len(n), BANDS * ROWS), dtype=u)
    factors = mix(np.arange(1, BANDS * ROWS + 1, dtype=u)) | u(1)  # of odd factors: each makes another order
    for order, factor in enumerate(factors):
        if len(start):
            low[n > 0, order] = np.minimum.reduceat(own * factor, start)
    return low


def units(low):
    """One number for each sketch."""
    import numpy as np

    u = np.uint64
    return mix((low * mix(np.arange(101, 101 + low.shape[1], dtype=u))).sum(axis=1, dtype=u))


def short_keys(hashes, digit, start, n):
    """(line, key) of the templates of short lines that ask for more families."""
    import numpy as np

    u = np.uint64
    longest = LEAD + MIN_REST - 1
    run_of = np.full((longest + 1, longest), -1)  # by number of tokens and place
    for size in range(LEAD + 1, longest + 1):
        lead = SHORT_LEAD if size > LEAD + 1 else LEAD
        rest = size - lead
        runs = min(FIELDS, rest)
        for r in range(runs):
            run_of[size, lead + rest * r // runs : lead + rest * (r + 1) // runs] = r
    rows = np.flatnonzero((n > 0) & (n <= longest))
    size, place = n[rows], np.arange(longest)
    inside = place < size[:, None]
    at = np.where(inside, start[rows][:, None] + place, 0)
    token = hashes[at] if len(hashes) else np.zeros(at.shape, u)
    fixed = inside & (digit[at] == 0) if len(hashes) else inside
    alone = (size < MIN_TOKENS) & ~fixed.any(axis=1)
    token = np.where(fixed | alone[:, None], token, u(0x2545F4914F6CDD1D))
    power = np.multiply.accumulate(np.full(longest, 0xD6E8FEB86659FD93, dtype=u))
    run, runs = run_of[size], run_of.max(axis=1)[size] + 1

    def key(chosen, opened):
        path = np.where(inside, np.where(opened, u(0x9E3779B97F4A7C15), token) * power, u(0)).sum(axis=1, dtype=u)
        return rows[chosen], mix(path + mix(size.astype(u) + u(1 << 32)))[chosen]

    def may(*which):
        opened = np.isin(run, which)
        return (runs > max(which)) & (2 * (fixed & ~opened).sum(axis=1) >= size), opened

    found = [key(size < MIN_TOKENS, np.zeros_like(inside))]
    in_pair = np.zeros((FIELDS, len(rows)), dtype=bool)
    for a in range(FIELDS):
        for b in range(a + 1, FIELDS):
            chosen, opened = may(a, b)
            in_pair[[a, b]] |= chosen
            found.append(key(chosen, opened))
    for a in range(FIELDS):  # lines that meet with one run open also do with two
        chosen, opened = may(a)
        found.append(key(chosen & ~in_pair[a], opened))
    return tuple(np.concatenate(x) for x in zip(*found))


def line_keys(column, short: bool = False):
    """(text, line, first key, number of keys) of each line with keys, the keys,
    and whether a key is the first such in its text; before them the sketch of
    each text.  Keys are even; with ``short``, odd ones are of ``short_keys``."""
    import numpy as np

    u = np.uint64
    hashes, first, _, digit, at = words(column, _digits())
    low = sketches(hashes, at)
    data, bounds = text_bytes(column)
    breaks = np.flatnonzero(data == NEWLINE)
    before = np.searchsorted(breaks, bounds)
    base = np.append(0, np.cumsum(np.diff(before) + 1))  # lines of the texts before
    text = np.repeat(np.arange(len(column)), np.diff(at))
    line = base[text] + np.searchsorted(breaks, first) - before[text]
    start = np.searchsorted(line, np.arange(base[-1] + 1))
    n = np.diff(start)
    place = np.arange(len(hashes)) - start[line]
    power = np.full(int(place.max()) + 1 if len(place) else 1, 0xD6E8FEB86659FD93, dtype=u)
    power[0] = 1
    power = np.multiply.accumulate(power)
    sums = np.append(u(0), np.cumsum(np.where(digit > 0, u(0x2545F4914F6CDD1D), hashes) * power[place], dtype=u))
    whole = sums[start[1:]] - sums[start[:-1]] + mix(n.astype(u))
    keys = np.zeros((len(n), 1 + FIELDS), dtype=u)
    keys[:, 0] = mix(whole)
    for f in range(FIELDS):
        a, b = (start[:-1] + LEAD + (n - LEAD) * k // FIELDS for k in (f, f + 1))
        a, b = (np.clip(x, 0, len(hashes)) for x in (a, b))
        keys[:, 1 + f] = mix(whole - (sums[b] - sums[a]) + u((f + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
    have = np.where(n < MIN_TOKENS, 0, np.where(n < LEAD + MIN_REST, 1, 1 + FIELDS))
    of_text = np.repeat(np.arange(len(column)), np.diff(base))
    chosen = np.arange(1 + FIELDS) < have[:, None]
    flat, line_of = keys[chosen] & ~u(1), np.repeat(np.arange(len(n)), have)
    if short:
        more_of, more = short_keys(hashes, digit, start, n)
        flat, line_of = np.append(flat, more | u(1)), np.append(line_of, more_of)
        order = np.argsort(line_of, kind="stable")
        flat, line_of = flat[order], line_of[order]
        have = np.bincount(line_of, minlength=len(n))
    flat, owner = flat.view(np.int64), of_text[line_of]
    order = np.lexsort((flat, owner))
    fresh = np.ones(len(flat), dtype=np.int32)
    same = (flat[order][1:] == flat[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    fresh[order[1:][same]] = 0
    rows = np.flatnonzero(have)
    return low, of_text[rows], (np.arange(base[-1]) - base[:-1][of_text])[rows], np.append(0, np.cumsum(have[rows])), flat, fresh


def _liner():
    def run(batches):
        import numpy as np
        import pyarrow as pa

        worker_cache("lines")
        for batch in text_blocks(batches, limit=SEGMENT):
            low, text, line, ends, keys, _ = line_keys(batch.column("text"), short=True)
            once = np.diff(text, prepend=-1) > 0  # a text's sketch goes with its first line
            part = (mix(low[text[once]]) >> np.uint64(32)).astype(np.uint32).view(np.int32)
            to = np.append(0, np.cumsum(once * low.shape[1]))
            sketch = pa.ListArray.from_arrays(pa.array(to, pa.int32()), pa.array(part.ravel()), mask=pa.array(~once))
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id").take(pa.array(text)),
                    "text_hash": batch.column("text_hash").take(pa.array(text)),
                    "unit": pa.array(units(low).view(np.int64)[text]),
                    "line": pa.array(line, pa.int32()),
                    "keys": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(keys)),
                    "sketch": sketch,
                }
            )

    return run


def _dropper():
    def run(batches):
        import pyarrow as pa

        worker_cache("lines")
        for batch in text_blocks(batches):
            texts, counts = [], []
            for text, dropped in zip(batch.column("text").to_pylist(), batch.column("dropped").to_pylist()):
                lines = (text or "").split("\n")
                counts.append(len(lines))
                if dropped:
                    gone = set(dropped)
                    text = "\n".join(x for i, x in enumerate(lines) if i not in gone)
                texts.append(text)
            cols = {c: batch.column(c) for c in batch.schema.names if c != "text"}
            cols |= {"kept_text": pa.array(texts, pa.string()), "n_lines": pa.array(counts, pa.int64())}
            yield pa.RecordBatch.from_pydict(cols)

    return run


def _hash(text: str):
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def families(sketched: DataFrame) -> DataFrame:
    """(unit, family) of the units that are not a family of their own;
    ``sketched``: unit, sketch, a row for each."""
    values = [F.col("sketch")[i] for i in range(BANDS * ROWS)]
    bands = F.array(*[F.xxhash64(F.lit(b), *values[b * ROWS : (b + 1) * ROWS]) for b in range(BANDS)])
    banded = sketched.select("unit", F.explode(bands).alias("band"))
    shared = banded.groupBy("band").agg(F.min("unit").alias("rep"), F.max("unit").alias("other")).filter("rep <> other")
    pairs = salted_join(banded, shared.select("band", "rep"), ["band"], "inner").filter("unit <> rep").select("unit", "rep").distinct()
    one = pairs.join(sketched, "unit")
    both = salted_join(one, sketched.select(F.col("unit").alias("rep"), F.col("sketch").alias("of_rep")), ["rep"], "inner")
    alike = F.size(F.filter(F.zip_with("sketch", "of_rep", lambda x, y: x == y), lambda x: x))
    joined = components(both.filter(alike >= AGREE).select(F.col("unit").alias("a"), F.col("rep").alias("b")))
    return joined.select(F.col("node").alias("unit"), F.col("component").alias("family"))


def recurring(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(recurring templates: key, n_families, first_family; the lines of all
    templates seen in two units, with their family)."""
    each = lines.select("doc_id", "text_hash", "unit", "line", F.explode("keys").alias("key"))
    spread = each.groupBy("key").agg(F.min("unit").alias("one"), F.max("unit").alias("other"))
    met = stored(salted_join(each, spread.filter("one <> other").select("key"), ["key"], "inner"), "template-lines")
    sketched = lines.filter("sketch is not null").groupBy("unit").agg(F.first("sketch").alias("sketch"))
    sketched = stored(sketched.join(met.select("unit").distinct(), "unit", "left_semi"), "sketches")
    met = salted_join(met, families(sketched), ["unit"], "left").withColumn("family", F.coalesce("family", "unit")).drop("unit")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("without"), "doc_id")).alias("first")
    by_family = met.groupBy("key", "family").agg(first)
    templates = (
        by_family.groupBy("key")
        .agg(F.count("*").alias("n_families"), F.min(F.struct("first", "family"))["family"].alias("first_family"))
        .filter(F.col("n_families") >= F.when(F.expr("key & 1 = 1"), SHORT_FAMILIES).otherwise(2))
    )
    return templates, met


def without_recurring_lines(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` with all columns but ``text`` as the struct ``row``, and
    kept_text, n_lines and ``dropped``, the numbers (from 0, ascending) of the
    lines left out."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", _hash("text").alias("text_hash"))
    lines = stored(texts.mapInArrow(_liner(), LINES), "lines")
    templates, met = recurring(lines)
    dropped = (
        salted_join(met, templates.select("key", "first_family"), ["key"], "inner")
        .filter("family <> first_family")
        .groupBy(F.col("doc_id").alias("d"), F.col("text_hash").alias("h"))
        .agg(F.sort_array(F.collect_set("line")).alias("dropped"))  # at most the lines of one document
    )
    dropped = stored(dropped, "dropped-lines")
    # only texts that may lose a line are shuffled
    others = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("row")
    rows = docs.select(others, "text", F.col("doc_id").cast("long").alias("id"))
    marked = possibly_in(rows, dropped.select("d"), "id").select("row.row", "row.text", "id", "possible")
    none = F.expr("cast(array() as array<int>)")
    whole = marked.filter("not possible").select("row", "text", none.alias("dropped"))
    some = marked.filter("possible").join(dropped, F.col("id").eqNullSafe(F.col("d")) & (_hash("text") == F.col("h")), "left")
    both = whole.unionByName(some.select("row", "text", F.coalesce("dropped", none).alias("dropped")))
    schema = T.StructType([f for f in both.schema.fields if f.name != "text"]).add("kept_text", "string").add("n_lines", "long")
    return both.mapInArrow(_dropper(), schema)


def deduplicated(docs: DataFrame) -> DataFrame:
    """``docs`` with the kept text, all columns kept; ``n_chars``, if there is
    such a column, follows.  Documents of which nothing but blanks is left go."""
    out = without_recurring_lines(docs)
    emptied = (F.size("dropped") > 0) & ~F.coalesce("kept_text", F.lit("")).rlike(r"\S")
    new = {"text": F.col("kept_text"), "n_chars": F.char_length("kept_text").cast("long")}
    return out.filter(~emptied).select(*[new[c].alias(c) if c in new else F.col(f"row.`{c}`") for c in docs.columns])
