"""The pipeline's stages, each on all its predecessor kept, against plain Python."""

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from medalla.llm.tokens import Encoder, default_tokenizer

from . import odd

SF = "/root/testdata/sf0.001"


def words(text, pattern=r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"):
    return re.findall(pattern, (text or "").translate(odd.UPPER))


def windows(texts, n=10):
    out = set()
    for t in texts:
        w = words(t)
        out |= {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()
    return out


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """(name, rows in, frame out) of each stage, tables between them."""
    folder = tmp_path_factory.mktemp("sf")
    given = spark.read.parquet(f"{SF}/documents.parquet")
    extra = [(None if d is None else 10_000_000 + d, t, None, None, None) for d, t in odd.documents()]
    more = spark.createDataFrame(extra, given.schema)
    given.unionByName(more).write.parquet(f"{folder}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    docs, out = spark.read.parquet(f"{folder}/documents.parquet"), []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        rows = docs.collect()
        stage(spark, docs, str(folder)).write.parquet(f"{folder}/stage{i}")
        docs = spark.read.parquet(f"{folder}/stage{i}")
        out.append((name, rows, docs))
    return given.columns, {name: (rows, df) for name, rows, df in out}, str(folder)


def bag(rows, *cols):
    return Counter(tuple(r[c] for c in cols) for r in rows)


def test_all_but_the_last_return_the_columns_of_documents(stages):
    columns, by_name, _ = stages
    assert list(by_name) == ["quality_classifier", "line_dedup", "near_dedup", "decontamination", "packing"]
    assert all(sorted(df.columns) == sorted(columns) for name, (_, df) in by_name.items() if name != "packing")


def test_rows_are_dropped_never_made_or_changed(stages):
    columns, by_name, _ = stages
    for name in ("quality_classifier", "near_dedup", "decontamination"):
        rows, df = by_name[name]
        assert not bag(df.collect(), *columns) - bag(rows, *columns), name


def test_line_dedup_takes_whole_lines_out(stages):
    rows, df = stages[1]["line_dedup"]
    before = {}
    for r in rows:
        before.setdefault((r["doc_id"], r["source"]), []).append(r["text"] or "")
    for r in df.collect():
        texts = before[r["doc_id"], r["source"]]
        left = Counter((r["text"] or "").split("\n"))
        assert any(not left - Counter(t.split("\n")) for t in texts)
        assert (r["text"] or "") in texts or r["n_chars"] == len(r["text"])


def test_near_dedup_keeps_one_of_each_group(stages):
    rows, df = stages[1]["near_dedup"]
    ids = Counter(r["doc_id"] for r in rows)
    once = [(r["doc_id"], r["text"]) for r in rows if r["doc_id"] is not None and ids[r["doc_id"]] == 1]
    root = odd.similar_components(once)
    kept = {r["doc_id"] for r in df.collect()}
    assert {d for d, _ in once} & kept == {d for d in root if root[d] == d}


def test_decontamination_drops_just_what_holds_a_window(stages, spark):
    rows, df = stages[1]["decontamination"]
    bad = windows(r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect())
    short = {len(w) for w in bad}

    def holds(text):
        w = words(text)
        return any(tuple(w[i : i + n]) in bad for n in short for i in range(len(w) - n + 1))

    clean = [r for r in rows if not holds(r["text"])]
    assert bag(df.collect(), "doc_id", "text") == bag(clean, "doc_id", "text")
    assert len(clean) < len(rows)


def test_packing_emits_every_id_once(stages):
    rows, df = stages[1]["packing"]
    encoder = Encoder(default_tokenizer())
    want = Counter()
    for r in rows:
        ids = np.append(np.frombuffer(encoder._ids(r["text"] or ""), "<u4"), 0).astype("<u2")
        for piece, at in enumerate(range(0, len(ids), 2048)):
            want[r["doc_id"], piece, ids[at : at + 2048].tobytes()] += 1
    got = df.collect()
    assert Counter((r["doc_id"], r["piece"], bytes(r["ids"])) for r in got) == want
    full = df.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end"))
    assert full.filter("n > 2048 or n <> end").isEmpty()


def test_run_is_the_stages_in_order(stages, spark):
    _, by_name, folder = stages
    got = corpus_pipeline.run(spark, folder)
    assert bag(got.collect(), "doc_id", "piece", "ids_crc32") == bag(by_name["packing"][1].collect(), "doc_id", "piece", "ids_crc32")
