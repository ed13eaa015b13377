"""A small table with everything that trips operators, and plain-Python versions to hold results against."""

from __future__ import annotations

import random
import re

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, row string, items int, runs string, key long, slice int, class string, kept string"


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(n))


def documents() -> list[tuple[int | None, str | None]]:
    base, passage = prose(1, 200), prose(2, 60)
    near = base.replace(base.split()[100], "changed")
    return [
        (10, None),
        (11, ""),
        (12, " \t\n "),
        (13, "One."),
        (14, "one."),
        (15, "two words"),
        (16, base),
        (17, base),
        (18, near),
        (19, f"{prose(3, 80)}\n{passage}\n{prose(4, 80)}"),
        (20, f"{prose(5, 90)}\n{passage}\n{prose(6, 70)}"),
        (21, prose(7, 30_000)),
        (22, "x" * 70_000),
        (23, "日本語の文章です。 Été à Noël — don't, 12,5."),
        (24, prose(8, 40)),
        (24, prose(8, 40)),
        (None, prose(9, 50)),
        (None, None),
    ]


def frame(spark, rows=None):
    """The rows with columns whose names operators use themselves."""
    rows = documents() if rows is None else rows
    return spark.createDataFrame([(d, t, None, "r", 1, "u", 2, 3, "c", "k") for d, t in rows], SCHEMA)


def shingles(text: str | None, n: int = 5) -> frozenset:
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))) if words else frozenset()


def similar_components(rows, percent: int = 75) -> dict:
    """doc_id -> smallest doc_id reachable."""
    sets = {d: shingles(t) for d, t in rows if d is not None}
    of = {d: d for d in sets}

    def root(d):
        while of[d] != d:
            d = of[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((root(a), root(b)))
                of[y] = x
    return {d: root(d) for d in ids}
