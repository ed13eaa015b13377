"""Spelling variants by an index of variable-length grams.

Two words are near if one inserted, deleted or replaced code point makes one
of the other.  A word's form is its most frequent near word if that is at
least twice as frequent; following forms leads to its root.

A dictionary of grams is built from the words, ``^`` and ``$`` marking their
ends: every gram of ``SHORTEST`` code points, and, where a gram is frequent, in
its place those one code point longer, up to ``LONGEST``.  So rare grams stay
short and frequent ones are pruned away.  A word is decomposed into the
dictionary's gram at each of its places.  An edit of the code point at a place
affects the grams that cover it, so of a word with g grams, of which an edit
affects ``a`` at most, at least g - a stay, in the other word as well and at
most one place off.  Two near words therefore share one of each other's a + 1
rarest grams: only those are indexed, by gram, place and word length, and only
the lists of equal or next length, and equal or next place, are merged.  With
words of 5 code points or more and grams of 4 at most g - a is above zero, so
no word is beyond the index.  Candidates are verified by edit distance.

Scale: counts of runs are aggregated before they are shuffled; from there on
all tables are of distinct words.  The frequent grams are broadcast: shorter
than ``LONGEST``, over the 92 signs a word can have, there are fewer than
790,000.  Rarity is read from a table of ``RARITY_CELLS`` counts by hash: any
order does, as long as it is the same for all words.  A list longer than
``LONG_LIST`` is split exactly: near words have the first or the last half of
the shorter one in common, so these halves become part of the list's key.
Whether a list is long is read from a table of ``LIST_CELLS`` counts by hash.

Defined results: null and empty texts have no words; rows without an id or
with one id count like others (a null id is written as nothing before the
colon); repeated rows count as often as they stand; of equally frequent near
words the smallest in code-point order is the form; an empty table has no
words.  Other columns than ``doc_id`` and ``text`` may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

LETTERS = "[A-Za-zÀ-ÿ]+"
LEAST_LENGTH, LEAST_COUNT = 5, 3
RATIO = 2  # a form is at least that many times as frequent

SHORTEST, LONGEST = 2, 4
#: A gram in more places of words than this is frequent.
FREQUENT = 200
RARITY_CELLS = 1 << 17
LIST_CELLS = 1 << 18
LONG_LIST = 60

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def runs(docs: DataFrame) -> DataFrame:
    """(doc_id as text, run): lower-cased letter runs of at least the least length."""
    upper, lower = "".join(map(chr, LOWER)), "".join(map(chr, LOWER.values()))
    found = F.explode(F.regexp_extract_all(F.translate("text", upper, lower), F.lit(LETTERS), F.lit(0)))
    out = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), found.alias("run"))
    return out.filter(F.length("run") >= LEAST_LENGTH)


def slipped(doc: Column, run: Column, every: int = 97) -> Column:
    """The run, without one code point where the hash of both says so."""
    h = F.crc32(F.concat(doc, F.lit(":"), run).cast("binary"))
    at = F.pmod(h, F.length(run).cast("long")).cast("int")
    cut = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return F.when(h % every == 0, cut).otherwise(run)


def vocabulary(words: DataFrame) -> DataFrame:
    """(word, n) of the rows ``word``: long and frequent enough."""
    counts = words.filter(F.length("word") >= LEAST_LENGTH).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.filter(F.col("n") >= LEAST_COUNT)


def frequent_grams(vocab: DataFrame, least: int) -> frozenset[str]:
    """Grams shorter than ``LONGEST`` in more than ``least`` places; the prefixes
    of a frequent gram are frequent, so they are a tree."""
    marked = vocab.select(F.concat(F.lit("^"), "word", F.lit("$")).alias("t"))
    every = [
        f"transform(sequence(1, length(t) - {k - 1}), i -> substring(t, i, {k}))" for k in range(SHORTEST, LONGEST)
    ]
    grams = marked.select(F.explode(F.expr(f"flatten(array({', '.join(every)}))")).alias("gram"))
    rows = grams.groupBy("gram").count().filter(F.col("count") > least).select("gram").collect()
    return frozenset(r["gram"] for r in rows)


def decompose(word: str, frequent) -> list[str]:
    """The dictionary's gram at each place: the shortest that is not frequent."""
    t, out = f"^{word}$", []
    for p in range(len(t) - SHORTEST + 1):
        end = p + SHORTEST
        while end < len(t) and end - p < LONGEST and t[p:end] in frequent:
            end += 1
        out.append(t[p:end])
    return out


def affected(grams: list[str], length: int) -> int:
    """Grams that one edit affects at most: those that cover its place.  A
    gram is settled by its own signs alone, and a sign put in between two
    affects no gram that the replacing of the second does not."""
    change = [0] * (length + 3)
    for p, gram in enumerate(grams):
        change[p] += 1
        change[p + len(gram)] -= 1
    most = covering = 0
    for place in range(length + 1):
        covering += change[place]
        if place:  # the mark before the word stays
            most = max(most, covering)
    return most


def cell(gram: str) -> int:
    from zlib import crc32

    return crc32(gram.encode()) % RARITY_CELLS


def _count_cells(frequent):
    def run(frames):
        import numpy as np
        import pandas as pd

        counts = np.zeros(RARITY_CELLS, dtype=np.int64)
        for frame in frames:
            for word in frame["word"]:
                for gram in decompose(word, frequent.value):
                    counts[cell(gram)] += 1
        some = np.flatnonzero(counts)
        yield pd.DataFrame({"cell": some, "count": counts[some]})

    return run


def rarest(word: str, frequent, counts) -> list[tuple[str, int]]:
    """(gram, place) of the word's rarest grams, one more than an edit affects."""
    grams = decompose(word, frequent)
    order = sorted((int(counts[cell(g)]), g, p) for p, g in enumerate(grams))
    return [(g, p) for _, g, p in order[: affected(grams, len(word)) + 1]]


def _index(frequent, counts):
    def run(frames):
        import pandas as pd

        for frame in frames:
            rows = [(w, n, g, p) for w, n in zip(frame["word"], frame["n"]) for g, p in rarest(w, frequent.value, counts.value)]
            yield pd.DataFrame(rows, columns=["word", "n", "gram", "place"])

    return run


def index(vocab: DataFrame, least: int = FREQUENT) -> DataFrame:
    """(word, n, gram, place) of every word's rarest grams."""
    import numpy as np

    spark = vocab.sparkSession
    frequent = spark.sparkContext.broadcast(frequent_grams(vocab, least))
    cells = vocab.select("word").mapInPandas(_count_cells(frequent), "cell int, count long").groupBy("cell").agg(F.sum("count").alias("count"))
    counts = np.zeros(RARITY_CELLS, dtype=np.int64)
    for r in cells.collect():  # RARITY_CELLS rows at most
        counts[r["cell"]] = r["count"]
    return vocab.mapInPandas(_index(frequent, spark.sparkContext.broadcast(counts)), "word string, n long, gram string, place int")


def near_pairs(vocab: DataFrame, least: int = FREQUENT, long_list: int = LONG_LIST) -> DataFrame:
    """(word, n, other, other_n), each near pair once, ``word`` the shorter or
    the smaller one."""
    grams = stored(index(vocab, least), "gram-index")
    size = F.length("word")
    listed = lambda longer, place, length: F.struct(
        F.lit(longer).alias("longer"), F.xxhash64(F.lit(longer), "gram", place, length).alias("key")
    )
    # a list holds the words of one length with a gram at a place; "longer" ones are met by words one shorter
    entries = grams.select("word", "n", F.explode(F.array(listed(0, F.col("place"), size), listed(1, F.col("place"), size))).alias("l"))
    asking = F.array(listed(0, F.col("place"), size), listed(1, F.col("place"), size + 1), listed(1, F.col("place") + 1, size + 1))
    asked = grams.select("word", "n", F.explode(asking).alias("l"))

    in_cell = F.pmod("l.key", F.lit(LIST_CELLS))
    long_cells = entries.groupBy(in_cell.alias("cell")).count().filter(F.col("count") > long_list).select("cell")
    long_cells = stored(long_cells, "long-lists")  # LIST_CELLS rows at most

    def split(rows: DataFrame, shared: Column) -> DataFrame:
        """With a key for each half of a long list's words; ``shared`` is the
        length of the shorter word of a pair."""
        half = F.floor(shared / 2).cast("int")
        first = F.xxhash64("l.key", F.lit(0), F.substring("word", F.lit(1), half))
        last = F.xxhash64("l.key", F.lit(1), F.substring("word", size - shared + half + 1, shared))
        met = rows.join(F.broadcast(long_cells), in_cell == F.col("cell"), "left")
        keys = F.when(F.col("cell").isNull(), F.array("l.key")).otherwise(F.array(first, last))
        return met.select("word", "n", F.explode(keys).alias("key"), F.col("l.longer").alias("longer"))

    left = split(asked, size)
    right = split(entries, size - F.col("l.longer")).select(F.col("word").alias("other"), F.col("n").alias("other_n"), "key", "longer")
    met = left.join(right, ["key", "longer"]).filter((F.col("longer") == 1) | (F.col("word") < F.col("other")))
    return met.filter(F.levenshtein("word", "other", 1) == 1).select("word", "n", "other", "other_n").distinct()


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for ``forms`` (word, form): each link leads to a word at least
    twice as frequent, so they are paths, halved until they end."""
    now = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        new = now.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        new = stored(new, "roots")
        now = new.select("word", "root")
        if new.filter("moved").isEmpty():
            return now


def variants(vocab: DataFrame, least: int = FREQUENT, long_list: int = LONG_LIST) -> DataFrame:
    """``vocab`` (word, n) with form, root, n_near and form_n."""
    vocab = stored(vocab, "vocabulary")
    pairs = stored(near_pairs(vocab, least, long_list), "near-words")
    both = pairs.unionByName(pairs.select(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n")))
    best = both.groupBy("word", "n").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("n"), "other")).alias("best"))
    best = best.select(
        "word",
        "n_near",
        F.when(-F.col("best.n") >= RATIO * F.col("n"), F.struct(F.col("best.other").alias("form"), (-F.col("best.n")).alias("form_n"))).alias("to"),
    )
    best = stored(best, "best-near-words")
    ends = roots(best.filter("to is not null").select("word", F.col("to.form").alias("form")))
    out = vocab.join(best, "word", "left").join(ends, "word", "left")
    return out.select(
        "word",
        F.col("to.form").alias("form"),
        F.coalesce("root", "word").alias("root"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.col("to.form_n").alias("form_n"),
    )
