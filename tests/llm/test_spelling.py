"""Spelling variants against plain Python."""

import random
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from medalla.llm import spelling

from . import odd

SCHEMA = "doc_id long, text string, word string, n long, run string, gram string"


def slip(doc, run):
    h = zlib.crc32(f"{doc}:{run}".encode())
    at = h % len(run)
    return run[:at] + run[at + 1 :] if h % 97 == 0 else run


def vocabulary(rows):
    words = Counter()
    for d, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            words[slip("" if d is None else d, run.translate(odd.UPPER))] += 1
    return {w: n for w, n in words.items() if len(w) >= 5 and n >= 3}


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[i + 1 :] == b[i + 1 :] or a[i:] == b[i + 1 :] or a[i + 1 :] == b[i:]


def expected(vocab):
    out = {}
    for w, n in vocab.items():
        others = [o for o in vocab if near(w, o)]
        best = min(others, key=lambda o: (-vocab[o], o), default=None)
        form = best if best is not None and vocab[best] >= 2 * n else None
        out[w] = [form, None, n, len(others), vocab[form] if form else None]
    for w in vocab:
        at = w
        while out[at][0]:
            at = out[at][0]
        out[w][1] = at
    return {w: tuple(v) for w, v in out.items()}


def got(df):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()}


def of(spark, rows):
    docs = spark.createDataFrame([(d, t, "w", 1, "r", "g") for d, t in rows], SCHEMA).repartition(4)
    return spelling.vocabulary(spelling.runs(docs).select(spelling.slipped(F.col("doc"), F.col("run")).alias("word")))


def test_odd_documents(spark):
    rng = random.Random(3)
    words = ["colour", "color", "colours", "Colors", "coloor", "honour", "honor", "éÀÿ×÷ab", "éÀÿ×÷ac", "aaaaa", "aaaaaa", "x" * 3000, "x" * 2999]
    text = " ".join(rng.choice(words[: rng.randint(1, len(words))]) for _ in range(900))
    rows = odd.documents() + [(d, text) for d in (1, 2, 2, None)] + [(3, text.replace(" ", "\n-"))]
    rows.append((9, "chainx " * 4 + "chaixx " * 12 + "chaxxx " * 40))
    want = expected(vocabulary(rows))
    assert got(spelling.variants(of(spark, rows))) == want
    assert any(v[0] for v in want.values()) and any(v[1] != v[0] for v in want.values() if v[0])


def test_slips_of_the_pen(spark):
    """About one id in 97 slips."""
    rows = [(i, "Straße übermorgen wichtig") for i in range(600)]
    vocab = vocabulary(rows)
    assert len(vocab) > 3 and {r["word"]: r["n"] for r in of(spark, rows).collect()} == vocab


@pytest.mark.parametrize("least, long_list", [(0, 0), (5, 3), (10**6, 10**6)])
def test_all_dictionaries_and_list_splits(spark, least, long_list):
    """Short and long grams, lists split or not: the same links."""
    rng = random.Random(7)
    stems = ["".join(rng.choice("abé") for _ in range(rng.randint(5, 8))) for _ in range(120)]
    vocab = {w: rng.choice([3, 4, 8, 20, 100]) for w in stems}
    df = spark.createDataFrame(list(vocab.items()), "word string, n long").repartition(3)
    assert got(spelling.variants(df, least, long_list)) == expected(vocab)


def test_empty_table(spark):
    assert got(spelling.variants(of(spark, []))) == {}


@settings(max_examples=300, deadline=None)
@given(st.text("ab", min_size=5, max_size=9), st.integers(0, 8), st.sampled_from("abc"), st.sampled_from("idr"), st.sets(st.text("ab^$", min_size=2, max_size=3)))
def test_near_words_share_rare_grams(word, at, sign, how, frequent):
    """The bound on affected grams holds for any edit and any dictionary."""
    frequent = {g for g in frequent if len(g) == 2 or g[:2] in frequent}
    at = min(at, len(word) - (how != "i"))
    other = word[:at] + {"i": sign, "d": "", "r": sign}[how] + word[at + (how != "i") :]
    if other == word or len(other) < 5:
        return
    lists = [spelling.decompose(w, frequent) for w in (word, other)]
    left = [len(g) - spelling.affected(g, len(w)) for g, w in zip(lists, (word, other))]
    assert min(left) > 0
    counts = [random.Random(1).randrange(9) for _ in range(spelling.RARITY_CELLS)]
    a, b = (set(spelling.rarest(w, frequent, counts)) for w in sorted((word, other), key=len))
    steps = (0, 1) if len(word) != len(other) else (0,)
    assert any((g, p + d) in b for g, p in a for d in steps)
