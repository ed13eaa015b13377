"""Merkle manifest against plain Python, level by level."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from medalla.llm import merkle

from . import odd

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, tree string, position long, path string"


def h(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row) -> str:
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row[:5]))


def levels(nodes: list[str]) -> list[list[str]]:
    out = [nodes]
    while len(out[-1]) > 1:
        last = out[-1]
        out.append([h(*last[i : i + 2]) for i in range(0, len(last), 2)])
    return out


def expected(rows, claim):
    trees = {}
    for r in rows:
        trees.setdefault("" if r[2] is None else "=" + r[2], []).append(r)
    keys = sorted(trees, key=lambda k: k.encode())
    built = {}
    for k in keys:
        trees[k].sort(key=lambda r: (r[0] is not None, r[0], leaf(r)) if r[0] is not None else (False, 0, leaf(r)))
        built[k] = levels([leaf(r) for r in trees[k]])
    top = levels([built[k][-1][0] for k in keys]) if keys else []
    out = []
    for i, k in enumerate(keys):
        for j, r in enumerate(trees[k]):
            siblings, node = [], leaf(claim(r))
            for lv, at in [(lv, j >> n) for n, lv in enumerate(built[k][:-1])] + [(lv, i >> n) for n, lv in enumerate(top[:-1])]:
                other = lv[at ^ 1] if at ^ 1 < len(lv) else ""
                siblings += [other] if other else []
                node = h(other, node) if at % 2 else h(node, other)
            out.append((r[0], leaf(r), built[k][-1][0], top[-1][0], h(*siblings), node, node == top[-1][0]))
    return sorted(out, key=str)


def result(df, bits=merkle.BLOCK_BITS):
    fields = [F.col(c) for c in merkle.FIELDS]
    claimed = merkle.leaf([F.col(c) + 1 if c == "n_chars" else F.col(c) for c in merkle.FIELDS])
    claimed = F.when(F.col("doc_id") % 3 == 0, claimed).otherwise(merkle.leaf(fields))
    out = merkle.verified(merkle.manifest(df, claimed=claimed, bits=bits))
    cols = ("leaf", "subroot", "root", "proof", "folded")
    return sorted(((r["doc_id"], *(bytes(r[c]).hex() for c in cols), r["verified"]) for r in out.collect()), key=str)


def claim(r):
    return (*r[:3], r[3] + 1, r[4]) if r[0] is not None and r[0] % 3 == 0 and r[3] is not None else r


def table(spark, rows):
    return spark.createDataFrame([(*r, "t", 1, "p") for r in rows], SCHEMA).repartition(5)


@pytest.mark.parametrize("bits", [2, merkle.BLOCK_BITS])
def test_odd_rows_ties_and_several_rounds(spark, bits):
    rng = random.Random(bits)
    rows = [(d, None if i % 5 else "web", [None, "", "de", "fr"][i % 4], None if t is None else len(t), t) for i, (d, t) in enumerate(odd.documents())]
    # one language with most rows, repeated rows, one row in a language of its own
    rows += [(rng.randrange(40), "s", "é", 3, "abc") for _ in range(37)] + [(1, "s", "zz", 1, "x")]
    assert result(table(spark, rows), bits) == expected(rows, claim)


def test_every_size_of_a_small_tree(spark):
    for n in (1, 3, 6):
        rows = [(i, "s", "en", i, f"text {i}") for i in range(n)]
        assert result(table(spark, rows), 1) == expected(rows, claim)


def test_empty_table(spark):
    assert result(table(spark, []).filter("doc_id is not null")) == []


def test_a_changed_row_is_found(spark):
    rows = [(i, "s", "en", i, f"text {i}") for i in range(50)]
    out = merkle.verified(merkle.manifest(table(spark, rows), claimed=merkle.leaf([F.lit("x")]), bits=2))
    assert not out.filter("verified").count() and out.count() == 50
    assert merkle.verified(merkle.manifest(table(spark, rows), bits=2)).filter("verified").count() == 50
