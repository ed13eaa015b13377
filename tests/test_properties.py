"""Randomised checks of the custom operators against brute force in Python."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F
from medalla.operators import dedup, sequence

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

keys = st.sampled_from(["hot", "a", "b", "c", None])
rows_st = st.lists(
    st.tuples(keys, st.integers(0, 5), st.one_of(st.none(), st.text(alphabet="xyz", max_size=2))),
    min_size=1,
    max_size=60,
)


def _brute_keep_first(rows):
    best = {}
    for k, o, v in rows:
        # order: o then v, NULLs first
        rank = (o, (v is not None, v or ""))
        if k not in best or rank < best[k][0]:
            best[k] = (rank, (k, o, v))
    return sorted((r for _, r in best.values()), key=repr)


@SETTINGS
@given(rows=rows_st)
def test_keep_first_matches_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "k string, o int, v string").repartition(3)
    got = sorted((tuple(r) for r in dedup.keep_first(df, ["k"], ["o"]).collect()), key=repr)
    assert got == _brute_keep_first(rows)


seq_rows = st.lists(st.tuples(st.sampled_from(["hot", "hot", "hot", "a", "b"]), st.integers(0, 200)), min_size=1, max_size=80)


@SETTINGS
@given(rows=seq_rows, parts=st.integers(1, 9))
def test_next_in_sequence_matches_brute_force(spark, rows, parts):
    uniq = sorted(set(rows))
    df = spark.createDataFrame(uniq, "k string, s int")
    got = {(r.k, r.s): r.nxt for r in sequence.next_in_sequence(df, "k", "s", "nxt", slices=lambda c: F.floor(c / parts)).collect()}
    exp = {}
    for k, s in uniq:
        later = [t for kk, t in uniq if kk == k and t > s]
        exp[(k, s)] = min(later) if later else None
    assert got == exp
