"""Mixing against plain Python."""

import hashlib
import random
import re
from collections import Counter, defaultdict
from math import floor

import pytest
from pyspark.sql import functions as F

from medalla.llm import mixing

from . import odd

SCHEMA = "doc_id long, source string, text string, size long, rank long, weight double, target string"


def table(spark, rows):
    return spark.createDataFrame([(d, s, t, 7, 1, 1.0, "t") for d, s, t in rows], SCHEMA).repartition(4)


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def plain_targets(sizes, weights=(3, 1, 2), goal=1.5, most=2):
    """The given rule, step by step."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, free, left = dict.fromkeys(names, 0.0), set(names), goal * sum(sizes.values())
    while left > 1e-9 and free:
        total = sum(weight[s] for s in free)
        for s in free:
            target[s] += left * weight[s] / total
        left = 0.0
        for s in sorted(free, key=names.index):
            if target[s] >= most * sizes[s]:
                left += target[s] - most * sizes[s]
                target[s] = most * sizes[s]
                free.discard(s)
    return target


def plain_mix(rows):
    sizes = defaultdict(int)
    for _, s, t in rows:
        sizes[s] += size(t)
    target, out = plain_targets(sizes), []
    for name in sizes:
        mine = [(d, size(t)) for d, s, t in rows if s == name]
        e = target[name] / sizes[name] if sizes[name] else 0.0
        certain, p = floor(e), e - floor(e)
        gap = floor(target[name] - certain * sizes[name])
        ranked = []
        for d, n in mine:
            key = "" if d is None else str(d)
            u = (int(hashlib.sha256(f"mix:{key}".encode()).hexdigest()[:13], 16) + 0.5) / (1 << 52)
            ranked.append(((u / (1 - u)) / (p / (1 - p)) if p > 1e-12 else 0.0, d, n))
        for _, d, n in sorted(ranked):
            more = p > 1e-12 and 0 < n <= gap
            gap -= n if more else 0
            out.append((d, n, sizes[name], round(target[name], 6), n * (certain + more)))
    return Counter(out)


def got(df):
    rows = df.select("doc_id", "size", "source_size", "target", "taken").collect()
    return Counter((r[0], r[1], r[2], round(r[3], 6), r[4]) for r in rows)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    out = [(i, f"s{min(i % 7, 3)}", odd.prose(i, rng.choice([1, 3, 20, 200]))) for i in range(300)]
    out += [(1000 + i, None, odd.prose(i, 5)) for i in range(9)] + [(2000, "S", "one"), (2001, "", None), (2002, "", "")]
    out += [(3000, "long", odd.prose(1, 20_000)), (3001, "long", "x y"), (3002, "long", "z" * 50_000)]
    return out


def test_against_plain_python(spark, rows):
    plan = mixing.mix(table(spark, rows)).cache()
    assert got(plan) == plain_mix(rows)
    # every source near its target, no document above twice its size, the same again
    sums = plan.groupBy("source_size", "target").agg(F.sum("taken").alias("t"), F.max("size").alias("m")).collect()
    assert all(0 <= r["target"] - r["t"] <= r["m"] for r in sums)
    assert plan.filter("taken > 2 * size").isEmpty()
    assert got(mixing.mix(table(spark, rows).repartition(7))) == got(plan)


def test_mixed_rows_and_repeats(spark):
    rows = [(1, "a", "x y z")] * 4 + [(1, "a", "other text"), (None, "a", "p q"), (2, "b", "r"), (3, "b", None)]
    docs = table(spark, rows)
    plan = mixing.mix(docs).cache()
    out = mixing.mixed(docs, plan)
    assert out.columns == [*docs.columns, "copy"]
    words = Counter()
    for r in out.collect():
        words[r["doc_id"], size(r["text"])] += size(r["text"])
    want = Counter()
    for r in plan.collect():
        want[r["doc_id"], r["size"]] += r["taken"]
    assert +words == +want


def test_targets_refill(spark):
    for sizes in ({"a": 10, "b": 1000, "c": 10, "d": 5}, {"a": 0, "b": 0}, {"a": 4}):
        df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        out = {r["source"]: r["target"] for r in mixing.targets(df).collect()}
        assert out == pytest.approx(plain_targets(sizes))


def test_unequal_probabilities(spark):
    """With weights of their own, heavier documents are taken more often."""
    rows = [(i, "a", "w " * 10, 7, 1, 4.0 if i % 2 else 1.0, "t") for i in range(400)]
    docs = spark.createDataFrame(rows, SCHEMA)
    plan = mixing.mix(docs, weights=[1], goal=0.5, document_weight="weight").collect()
    heavy = sum(r["copies"] for r in plan if r["doc_id"] % 2)
    assert sum(r["taken"] for r in plan) == 2000 and 140 <= heavy <= 180  # 160 expected
    # at most two copies each: the light ones get what the heavy ones can't take
    plan = mixing.mix(docs, weights=[1], goal=1.5, document_weight="weight").collect()
    assert sum(r["taken"] for r in plan) == 6000
    assert all(r["copies"] == 2 for r in plan if r["doc_id"] % 2)


def test_empty_table(spark):
    assert mixing.mix(table(spark, [])).count() == 0
