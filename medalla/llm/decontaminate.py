"""Benchmark decontamination: one Aho-Corasick automaton over test items.

Texts are normalised to words: A-Z lower-cased, then runs of letters, digits
and everything beyond ASCII.  A window is ``n`` consecutive words of an item;
an item of fewer words, but not none, is one window.  The automaton holds the
windows as sequences of word numbers, so a match always begins and ends at a
word, and a text's words are run through it once.  Every word inside an
occurrence is hit; runs of hit words are mapped back to code point offsets of
the original text.

Scale: the texts are read once and never shuffled.  The windows of the
benchmark are counted first and broadcast in blocks of at most about
``block_windows`` (window, item) pairs, each pair computed once; a larger
benchmark makes more passes in the same job, and hits add up exactly.

Defined results: a null or wordless text has no words, hits or items; repeated
rows each get their own result; items with a null or wordless text have no
windows; an item without an id is named ``null``; rows that share an item id
are one item.  An empty benchmark hits nothing.  Columns other than ``doc_id``
and ``text`` are not read and may have any name.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stored, text_blocks, worker_cache

#: Fixed by contract: what a word is, after A-Z are lower-cased.
WORD = rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORDS_SQL = (
    r"regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
    r" '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+', 0)"
)
#: (window, item) pairs of one automaton: it takes some hundred bytes for each.
BLOCK_WINDOWS = 100_000

_SPAN = T.StructType([T.StructField(c, T.IntegerType()) for c in ("start", "end", "words")])
SPANS = T.StructField("spans", T.ArrayType(_SPAN))


def item_windows(items: DataFrame, n: int) -> DataFrame:
    """Distinct (window, item): the window's words joined by blanks."""
    words = items.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"), F.expr(WORDS_SQL.format("text")).alias("w")
    ).filter("size(w) > 0")
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - n + 1, F.lit(1)))
    each = words.select("item", F.explode(F.transform(starts, lambda i: F.array_join(F.slice("w", i, n), " "))).alias("window"))
    return each.distinct()


def automaton(pairs: list[tuple[str, str]]):
    """(automaton over word numbers or None, word numbers, items of each window)."""
    import ahocorasick

    numbers: dict[bytes, int] = {}
    of: dict[tuple[int, ...], set[str]] = {}
    for window, item in pairs:
        key = tuple(numbers.setdefault(w, len(numbers) + 1) for w in window.encode().split(b" "))
        of.setdefault(key, set()).add(item)
    if not of:
        return None, numbers
    a = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    for key, named in of.items():
        a.add_word(key, (len(key), named))
    a.make_automaton()
    return a, numbers


def _merged(spans: list[tuple[int, int]]) -> list[int]:
    """Sorted, disjoint [a, b) runs of the spans, flat."""
    out: list[int] = []
    for a, b in sorted(spans):
        if out and a <= out[-1]:
            out[-1] = max(out[-1], b)
        else:
            out += [a, b]
    return out


def _spelled(raw: bytes, runs: list[int], word) -> list[dict]:
    """Runs of words as code point offsets [start, end) of the original text,
    with the number of their words."""
    at = [m.span() for m in word.finditer(raw.lower())]
    out, seen, chars = [], 0, 0
    for a, b in zip(runs[::2], runs[1::2]):
        begin, end = at[a][0], at[b - 1][1]
        chars += len(raw[seen:begin].decode())
        start, seen = chars, end
        chars += len(raw[begin:end].decode())
        out.append({"start": start, "end": chars, "words": b - a})
    return out


def _scanner(shared, app: str, number: int, last: bool):
    """Adds one block's hits to ``runs`` and ``items``; the last block's scan
    maps the runs back to the text."""

    def run(batches):
        import pyarrow as pa

        cache = worker_cache("decontaminate")
        key = ("automaton", app, number)
        if key not in cache:
            for old in [k for k in cache if k[0] == "automaton"]:
                del cache[old]  # one automaton in memory at a time
            cache[key] = automaton(shared.value)
        tree, numbers = cache[key]
        word, get = re.compile(WORD), numbers.get
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("words", pa.int32())]))
        for batch in text_blocks(batches):
            n_words, runs, items = [], batch.column("runs").to_pylist(), batch.column("items").to_pylist()
            for i, text in enumerate(batch.column("text")):
                words = word.findall((text.as_py() or "").encode().lower())  # bytes.lower: A-Z only
                n_words.append(len(words))
                if tree is None or not words:
                    continue
                found, named = [], set()
                for end, (size, of) in tree.iter(tuple([get(w, 0) for w in words])):
                    found.append((end - size + 1, end + 1))
                    named |= of
                if found:
                    runs[i] = _merged(found + list(zip(runs[i][::2], runs[i][1::2])))
                    items[i] = sorted(named.union(items[i]))
            cols = {c: batch.column(c) for c in batch.schema.names}
            cols |= {
                "n_words": pa.array(n_words, pa.int64()),
                "runs": pa.array(runs, pa.list_(pa.int32())),
                "items": pa.array(items, pa.list_(pa.string())),
            }
            if last:
                texts = batch.column("text")
                spans = [_spelled(texts[i].as_py().encode(), r, word) if r else [] for i, r in enumerate(runs)]
                cols |= {"spans": pa.array(spans, kind)}
                del cols["text"], cols["runs"]
            yield pa.RecordBatch.from_pydict(cols)

    return run


def decontaminate(docs: DataFrame, items: DataFrame, n: int = 10, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """Rows of ``docs`` as the struct ``row``, with n_words, n_hit (words inside
    an occurrence), items (ids, sorted as strings) and ``spans``: the hit runs
    as code point offsets [start, end) of the text, with their words."""
    spark, run = docs.sparkSession, uuid.uuid4().hex
    pairs = stored(item_windows(items, n), "windows")
    blocks = max(1, -(-pairs.count() // block_windows))
    state = docs.select(
        F.struct("*").alias("row"),
        "text",
        F.lit(0).cast("long").alias("n_words"),
        F.expr("cast(array() as array<int>)").alias("runs"),
        F.expr("cast(array() as array<string>)").alias("items"),
    )
    for number in range(blocks):
        block = pairs.filter(F.pmod(F.xxhash64("window", "item"), F.lit(blocks)) == number)
        shared = spark.sparkContext.broadcast([(r["window"], r["item"]) for r in block.collect()])
        last = number == blocks - 1
        kept = [f for f in state.schema.fields if not last or f.name not in ("text", "runs")]
        out = T.StructType([*kept, *([SPANS] if last else [])])
        state = state.mapInArrow(_scanner(shared, run, number, last), out)
    n_hit = F.expr("aggregate(spans, 0L, (n, s) -> n + s.words)")
    return state.select("row", "n_words", n_hit.alias("n_hit"), "items", "spans")


def clean(docs: DataFrame, items: DataFrame, n: int = 10) -> DataFrame:
    """``docs`` without the rows that hold a window of an item, all columns kept."""
    return decontaminate(docs, items, n).filter("n_hit = 0").select("row.*")
